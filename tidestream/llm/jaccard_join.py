"""Set-similarity self join of documents on word shingles, by prefix filters under several orders.

Two documents link when the Jaccard similarity of their distinct five-word shingles is at least
0.8. If that holds, then under *any* global order of the shingles the two share a shingle among
their first `n - ceil(0.8 n) + 1`. The join uses this three times:

1. Shingles that occur in one document only come first in the rarest-first order. Counting how
   many shingles of a document occur anywhere else (packed into buckets by hash, one shuffle of
   about six bytes per shingle) shows at once which documents cannot link: their prefix is all
   their own. Only the others go on. Shingles are combined within chunks of documents before the
   shuffle, so a bucket holds a shingle once per chunk and nothing that grows with the number of
   documents otherwise.
2. Their prefixes under the rarest-first order connect documents into candidate groups. A
   shingle's documents are tied to one of them, so a shingle shared by n documents costs n rows.
3. Inside a group, a pair must share a prefix shingle under three orders (rarest first and two
   hash orders) and have fitting sizes before its sets are intersected exactly. The search goes
   from document to document and drops every one that is already connected, so a group of
   thousands of near copies needs about as many comparisons as it has members. A group too
   large for one task is cut into blocks, and every pair of blocks is searched.

The result is exact: it holds the components of all links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestream.llm.exact_dedup import bit_is_set, bitmaps, filter_bits
from tidestream.llm.storage import components, packed, small_batches, text_bytes
from tidestream.llm.words import mix, pieces, shingle_sets, sums_by_text
from tidestream.session import stored

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
BUCKET_BYTES = 6 << 20
MAX_BUCKETS = 1 << 20
BLOCK_SHINGLES = 4_000_000
ROOM_SHINGLES = 500_000
CHUNK_SHINGLES = 400_000
CHUNK_SHINGLES_PER_BUCKET = 8  # so that a packed row holds several shingles also with many buckets
CHUNK_DOCS = 60_000
ORDERS = 3

_MANY = 0xFFFF  # in place of a document's number: several of the chunk have the shingle
_SCAN = "p int, chunk long, tokens binary, each binary, ids array<bigint>, hashes array<bigint>, facts binary, docs binary, times binary"
_FACTS = "doc_id long, h long, n_shingles long, sig_a long, sig_b long, alone boolean"


def prefix_length(n: np.ndarray, percent: int = SIMILARITY_PERCENT) -> np.ndarray:
    """How many of a document's first shingles must hold one of any partner's first."""
    return n - (n * percent + 99) // 100 + 1


def links(overlap, n, m, percent: int = SIMILARITY_PERCENT):
    """Whether sets of n and m shingles with this overlap are similar enough."""
    return 100 * overlap >= percent * (n + m - overlap)


def _signatures(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that are equal for equal sets."""
    return sums_by_text(values, first), sums_by_text(mix(values ^ np.uint64(0x5851F42D4C957F2D)), first)


class _Chunk:
    """Some hundred thousand shingles of documents on their way into the buckets.

    A shingle leaves a chunk once, however many of its documents have it, so one that a third of all
    documents share comes to its bucket as one entry per chunk.
    """

    def __init__(self, number: int, buckets: int):
        self.buckets, self.most = buckets, max(CHUNK_SHINGLES, CHUNK_SHINGLES_PER_BUCKET * buckets)
        self.number, self.ids, self.hashes, self.facts, self.tokens, self.docs, self.size = number, [], [], [], [], [], 0

    def room_for(self, ids: list, values: np.ndarray) -> bool:
        return not self.ids or (len(self.ids) + len(ids) <= CHUNK_DOCS and self.size + len(values) <= self.most)

    def add(self, ids: list, hashes: list, values: np.ndarray, first: np.ndarray) -> None:
        n = np.diff(first)
        self.facts.append(np.stack([n.astype(np.uint64), *_signatures(values, first)], axis=1))
        self.tokens.append(values)
        self.docs.append(np.repeat(np.arange(len(self.ids), len(self.ids) + len(ids), dtype=np.uint16), n))
        self.ids += ids
        self.hashes += hashes
        self.size += len(values)

    def batch(self, schema: pa.Schema, weigh: bool) -> pa.RecordBatch:
        """A row per bucket with its distinct shingles, and a row of facts about the documents.

        To count, a shingle goes with its document, if it has one only, and the facts say how many
        shared shingles each document has already. To `weigh`, it goes with the number of its
        documents, and the facts row keeps the documents of all shingles in their order.
        """
        tokens, docs = np.concatenate(self.tokens), np.concatenate(self.docs)
        order = np.argsort(tokens)
        tokens, docs = tokens[order], docs[order]
        starts = _starts(tokens)
        times = np.diff(np.append(starts, len(tokens))).astype(np.uint32)
        # Buckets are ranges of hashes, so the sorted shingles are sorted by bucket too.
        bucket = ((tokens[starts] >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)
        at = np.searchsorted(bucket, np.arange(self.buckets + 1))
        low = tokens[starts].astype(np.uint32)
        facts = np.concatenate(self.facts)
        if weigh:
            each = times
        else:
            each = np.where(times > 1, np.uint16(_MANY), docs[starts])
            # In the order of documents within a bucket their numbers compress to almost nothing.
            by_doc = np.argsort((bucket << 16) | each)
            low, each = low[by_doc], each[by_doc]
            known = np.bincount(docs[np.repeat(times > 1, times)], minlength=len(self.ids))
            facts = np.column_stack([facts, known.astype(np.uint64)])
        full = np.flatnonzero(np.diff(at))
        none = [None] * len(full)
        columns = [
            [*full.tolist(), self.number % self.buckets],
            [self.number] * (len(full) + 1),
            [*(low[at[p] : at[p + 1]].tobytes() for p in full), None],
            [*(each[at[p] : at[p + 1]].tobytes() for p in full), None],
            [*none, self.ids],
            [*none, self.hashes],
            [*none, facts.tobytes()],
            [*none, docs.tobytes() if weigh else None],
            [*none, times.tobytes() if weigh else None],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _text_sets(batch: pa.RecordBatch):
    ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    for piece in pieces(batch.column(2)):
        yield ids[piece.rows], hashes[piece.rows], *shingle_sets(piece, SHINGLE_WORDS)


def _stored_sets(batch: pa.RecordBatch):
    first, values = _flat(batch.column(1))
    for a in range(0, len(batch), 1000):
        b = min(a + 1000, len(batch))
        yield batch.column(0)[a:b].to_pylist(), [], values[first[a] : first[b]], first[a : b + 1] - first[a]


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    return first, lists.flatten().to_numpy().view(np.uint64)


def _scan(buckets: int, sets_of, weigh: bool):
    """Rows of ids and texts or sets as packed shingles per chunk and bucket, and a row of facts per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema, number = _arrow_schema(_SCAN), TaskContext.get().partitionId() << 32
        chunk = _Chunk(number, buckets)
        for batch in batches:
            for ids, hashes, values, first in sets_of(batch):
                if not chunk.room_for(ids, values):
                    yield chunk.batch(schema, weigh)
                    number += 1
                    chunk = _Chunk(number, buckets)
                chunk.add(ids, hashes, values, first)
        if chunk.ids:
            yield chunk.batch(schema, weigh)

    return run


class _Bucket:
    """The packed rows of one bucket: its shingles in order. What it holds is its own shingles only."""

    def __init__(self, table: pa.Table, each: type):
        self.tokens, self.each = ([self._read(x, kind) for x in table.column(name).to_pylist()] for name, kind in (("tokens", np.uint32), ("each", each)))
        self.upto = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])])
        tokens = np.concatenate([np.zeros(0, np.uint32), *self.tokens])
        self.order = np.argsort(tokens, kind="stable")
        self.sorted = tokens[self.order]

    @staticmethod
    def _read(packed: bytes | None, kind: type) -> np.ndarray:
        return np.frombuffer(packed or b"", kind)

    def _by_row(self, ordered: np.ndarray) -> list[np.ndarray]:
        """Values in the order of the shingles, as one array per packed row."""
        values = np.empty_like(ordered)
        values[self.order] = ordered
        return [values[a:b] for a, b in zip(self.upto, self.upto[1:])]

    def shared(self) -> list[bytes]:
        """For every packed row, the document of each shingle that another row has too."""
        same = self.sorted[1:] == self.sorted[:-1]
        again = np.zeros(len(self.sorted), bool)
        again[1:] |= same
        again[:-1] |= same
        return [docs[flags & (docs != _MANY)].tobytes() for docs, flags in zip(self.each, self._by_row(again))]

    def documents(self) -> list[bytes]:
        """For every packed row, in how many documents each of its shingles occurs."""
        starts = _starts(self.sorted)
        times = np.concatenate([np.zeros(0, np.uint32), *self.each])[self.order].astype(np.uint64)
        often = np.add.reduceat(times, starts) if len(starts) else times
        often = np.repeat(often, np.diff(np.append(starts, len(times))))
        return [x.astype(np.uint32).tobytes() for x in self._by_row(often)]


def _answered(answers, keep_tokens: bool):
    """For applyInArrow over a bucket: its rows with the bucket's answer in place of `each`."""

    def run(table: pa.Table) -> pa.Table:
        made = table.set_column(table.column_names.index("each"), "each", pa.array(answers(table), pa.binary()))
        if keep_tokens:
            return made
        return made.set_column(made.column_names.index("tokens"), "tokens", pa.nulls(len(made), pa.binary()))

    return run


_count_bucket = _answered(lambda table: _Bucket(table, np.uint16).shared(), keep_tokens=False)
_weigh_bucket = _answered(lambda table: _Bucket(table, np.uint32).documents(), keep_tokens=True)


def _prefix_chunk(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """The shingles in the rarest-first prefixes of a chunk's sets that other sets have too."""
        rows = sorted(table.to_pylist(), key=lambda r: r["p"])
        home = next(r for r in rows if r["ids"] is not None)
        n = np.frombuffer(home["facts"], np.uint64).reshape(-1, 3)[:, 0].astype(np.int64)
        doc = np.frombuffer(home["docs"], np.uint16).astype(np.int64)
        rows = [r for r in rows if r["tokens"] is not None]
        # A shingle is known by its bucket and 32 bits; more alike only means more candidates.
        none = np.zeros(0, np.int64)
        token = np.concatenate([none, *(np.frombuffer(r["tokens"], np.uint32).astype(np.int64) | (r["p"] << 32) for r in rows)])
        often = np.concatenate([none, *(np.frombuffer(r["each"], np.uint32) for r in rows)]).astype(np.int64)
        # The chunk's own documents of each shingle follow each other in `doc`.
        mine = np.frombuffer(home["times"], np.uint32)
        token, often = np.repeat(token, mine), np.repeat(often, mine)
        order = np.lexsort((token, often, doc))
        token, doc, often = token[order], doc[order], often[order]
        first = np.searchsorted(doc, np.arange(len(n)))
        kept = (np.arange(len(doc)) - first[doc] < prefix_length(n, percent)[doc]) & (often > 1)
        return pa.table({"node": pa.array(np.array(home["ids"])[doc[kept]]), "t": pa.array(token[kept])})

    return run


def _sum_chunk(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Add up a chunk's counts and tell which documents cannot have a partner."""
        home = next(r for r in table.select(["ids", "hashes", "facts"]).to_pylist() if r["ids"] is not None)
        facts = np.frombuffer(home["facts"], np.uint64).reshape(-1, 4)
        shared = facts[:, 3].astype(np.int64)
        for packed in table.column("each").to_pylist():
            shared += np.bincount(np.frombuffer(packed or b"", np.uint16), minlength=len(shared))
        n = facts[:, 0].astype(np.int64)
        alone = (n == 0) | (n - shared >= prefix_length(n, percent))
        columns = [home["ids"], home["hashes"], n, facts[:, 1].view(np.int64), facts[:, 2].view(np.int64), alone]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _arrow_schema(_FACTS))], schema=_arrow_schema(_FACTS))

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of the texts that represent a class (node)."""
    for batch in batches:
        node = batch.column(0).to_numpy(zero_copy_only=False)
        for piece in pieces(batch.column(1)):
            values, first = shingle_sets(piece, SHINGLE_WORDS)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(node[piece.rows]), pa.array(np.diff(first)), lists], names=["node", "n", "tokens"])


class _Order:
    """Prefixes of all sets of a unit under one global order, and which sets hold a token there."""

    def __init__(self, tokens: np.ndarray, owner: np.ndarray, first: np.ndarray, lengths: np.ndarray, key: np.ndarray, useful: np.ndarray):
        order = np.lexsort((key, owner))
        kept = (np.arange(len(tokens)) - first[owner] < lengths[owner]) & useful[tokens[order]]
        self.tokens, owner = tokens[order][kept], owner[kept]
        self.first = np.searchsorted(owner, np.arange(len(first)))
        by_token = np.argsort(self.tokens, kind="stable")
        self.owners, sorted_tokens = owner[by_token], self.tokens[by_token]
        self.at = np.searchsorted(sorted_tokens, np.arange(len(useful) + 1))

    def of(self, k: int) -> np.ndarray:
        return self.tokens[self.first[k] : self.first[k + 1]]

    def partners(self, k: int) -> np.ndarray:
        found = [self.owners[self.at[t] : self.at[t + 1]] for t in self.of(k)]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _hits(mark: np.ndarray, tokens: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """How many marked tokens each of the chosen sets has."""
    parts = [tokens[first[c] : first[c + 1]] for c in chosen]
    lengths = np.array([len(p) for p in parts])
    marked = np.concatenate([[0], np.cumsum(mark[np.concatenate(parts)])])
    ends = np.cumsum(lengths)
    return marked[ends] - marked[ends - lengths]


def connect(tokens: np.ndarray, first: np.ndarray, percent: int = SIMILARITY_PERCENT) -> np.ndarray:
    """For every set, the first set of its component of links."""
    n = np.diff(first)
    count = len(n)
    owner = np.repeat(np.arange(count), n)
    _, tokens = np.unique(tokens, return_inverse=True)
    often = np.bincount(tokens)
    useful = often > 1
    lengths = prefix_length(n, percent)
    hashed = [mix(np.arange(len(often), dtype=np.uint64) + np.uint64(k << 40)) for k in range(1, ORDERS)]
    keys = [(often.astype(np.uint64) << np.uint64(40)) | np.arange(len(often), dtype=np.uint64), *hashed]
    orders = [_Order(tokens, owner, first, lengths, key[tokens], useful) for key in keys]
    root = np.full(count, -1)
    mark = np.zeros(len(often), bool)
    for seed in range(count):
        if root[seed] >= 0:
            continue
        root[seed] = seed
        waiting = [seed]
        while waiting:
            k = waiting.pop()
            found = orders[0].partners(k)
            found = np.unique(found[root[found] < 0])
            found = found[(n[found] * 100 >= percent * n[k]) & (n[k] * 100 >= percent * n[found])]
            for order in orders[1:]:
                if len(found):
                    mark[order.of(k)] = True
                    found = found[_hits(mark, order.tokens, order.first, found) > 0]
                    mark[order.of(k)] = False
            if len(found):
                own = tokens[first[k] : first[k + 1]]
                mark[own] = True
                found = found[links(_hits(mark, tokens, first, found), n[k], n[found], percent)]
                mark[own] = False
                root[found] = seed
                waiting += found.tolist()
    return root


def _connect_unit(percent: int):
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        _, once = np.unique(node, return_index=True)
        table = table.take(pa.array(once))
        node = node[once]
        first, values = _flat(table.column("tokens"))
        root = connect(values, first, percent)
        return pa.table({"a": pa.array(node), "b": pa.array(node[root])})

    return run


_TEXT_KEY = ("nameless", "id", "h")


def _text_key(doc_id, h) -> list:
    """A document by its id and the hash of its text, without nulls."""
    return [doc_id.isNull().alias("nameless"), F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"), h.alias("h")]


def _chosen_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows (node, text) of the chosen documents (node, nameless, id, h), each once.

    A filter of at most 64 MB lets the chosen documents pass, and a few more; only the texts that
    pass are shuffled. Copies with the same id are reduced to one before the shuffle.
    """
    bits = filter_bits(chosen.count())
    cell = (F.pmod(F.xxhash64(*_TEXT_KEY), F.lit(bits)) + 1).alias("cell")
    found = stored(bitmaps(chosen.select(cell)), "jaccard-filter")
    keyed = docs.select(*_text_key(F.col("doc_id"), F.col("h")), "text").select("*", cell)
    near = keyed.join(F.broadcast(found), F.bitmap_bucket_number("cell") == F.col("bucket"))
    likely = near.where(bit_is_set("cells", F.col("cell"))).select(*_TEXT_KEY, "text")
    return likely.dropDuplicates([*_TEXT_KEY]).join(chosen, [*_TEXT_KEY]).select("node", "text")


def jaccard_components(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (its smallest linked doc_id).

    Nulls: a null text is empty; empty documents link with nothing. A null doc_id is never the
    smallest; a row without one gets the component's id, or null if it is alone. Repeated rows
    each give a row. Very short texts are one shingle, their whole word sequence; very long ones are
    read whole, one at a time. A similarity of exactly `percent` links. An empty table gives no
    rows. Other columns of `docs` are not read.
    """
    found = _linked(docs, percent)
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _linked(docs: DataFrame, percent: int) -> DataFrame:
    """One row per document row: doc_id, n_shingles, its set's signature, and its component.

    `root` tells components apart, also those without any id; it is null for sets that have no
    partner and no equal. `component_id` is the smallest doc_id, if there is one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.col("text"))
    small_batches(docs.sparkSession)
    buckets = min(MAX_BUCKETS, max(16, math.ceil(text_bytes(docs) / BUCKET_BYTES)))
    scanned = docs.mapInArrow(_scan(buckets, _text_sets, weigh=False), _SCAN)
    counted = scanned.groupBy("p").applyInArrow(_count_bucket, _SCAN)
    facts = stored(counted.groupBy("chunk").applyInArrow(_sum_chunk(percent), _FACTS), "jaccard-facts")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h")).alias("first")
    classes = facts.where("not alone").groupBy("sig_a", "sig_b", "n_shingles").agg(first)
    classes = classes.select("sig_a", "sig_b", F.col("first.doc_id").alias("rep"), F.col("first.h").alias("h"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    chosen = classes.select("node", *_text_key(F.col("rep"), F.col("h")))
    sets = stored(_chosen_texts(docs, chosen).mapInArrow(_sets, "node long, n long, tokens array<bigint>"), "jaccard-sets")

    weighed = sets.select("node", "tokens").mapInArrow(_scan(buckets, _stored_sets, weigh=True), _SCAN)
    weighed = weighed.groupBy("p").applyInArrow(_weigh_bucket, _SCAN)
    prefix = stored(weighed.groupBy("chunk").applyInArrow(_prefix_chunk(percent), "node long, t long"), "jaccard-prefixes")
    hubs = prefix.groupBy("t").agg(F.min("node").alias("hub"))
    groups = components(prefix.join(hubs, "t").select(F.col("node").alias("a"), F.col("hub").alias("b")), "jaccard-groups")
    groups = groups.union(groups.select("root", "root").distinct())

    weights = groups.join(sets.select("node", "n"), "node").groupBy("root").agg(F.sum("n").alias("weight"))
    weights = stored(weights.withColumn("blocks", F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")), "jaccard-weights")
    total, most = weights.agg(F.sum("weight"), F.max("blocks")).first()
    rooms = max(1, math.ceil((total or 0) / ROOM_SHINGLES))
    placed = groups.join(weights, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    whole = placed.where("blocks = 1").select(
        "node", F.lit(-1).cast("long").alias("unit"), F.pmod(F.xxhash64("root"), F.lit(rooms)).alias("i"), F.lit(0).cast("long").alias("j")
    )
    cut = placed.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("node", F.col("root").alias("unit"), F.least("block", "other").alias("i"), F.greatest("block", "other").cast("long").alias("j"))
    units = whole.union(cut).join(sets.select("node", "tokens"), "node").groupBy("unit", "i", "j")
    found = stored(units.applyInArrow(_connect_unit(percent), "a long, b long").where("a <> b"), "jaccard-links")
    # Only groups that were cut can have a document with several roots.
    roots = components(found, "jaccard-roots") if (most or 0) > 1 else found.select(F.col("a").alias("node"), F.col("b").alias("root"))

    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_class = named.join(smallest, "root").select("sig_a", "sig_b", "root", "component_id")
    return facts.join(by_class, ["sig_a", "sig_b"], "left").select("doc_id", "n_shingles", "sig_a", "sig_b", "root", "component_id")


def _signed(rows: DataFrame) -> DataFrame:
    """Rows (document) with the size and the signature of their texts' shingle sets: n, a, b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(pc.struct_field(batch.column(0), "text")):
                values, first = shingle_sets(piece, SHINGLE_WORDS)
                a, b = _signatures(values, first)
                columns = [pa.array(np.diff(first).astype(np.int64)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[piece.rows], *columns], names=["document", "n", "a", "b"])

    rows = rows.select("document")
    return rows.mapInArrow(run, rows.limit(0).withColumns({name: F.lit(0).cast("long") for name in ("n", "a", "b")}).schema)


def _one_without_id(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Of the rows without an id, one of every component that has no id at all, and empty ones."""
    signed = _signed(rows.where("doc_id is null").dropDuplicates(["t"])).withColumn("h", F.xxhash64("document.text"))
    nameless = found.where("doc_id is null and n_shingles > 0 and component_id is null").select("root", "sig_a", "sig_b").distinct()
    alone = nameless.where("root is null").select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b"))
    first = nameless.where("root is not null").groupBy("root").agg(F.min(F.struct("sig_a", "sig_b")).alias("s"))
    stays = alone.union(first.select("s.sig_a", "s.sig_b"))
    filled = signed.where("n > 0").join(stays, ["a", "b"], "left_semi")
    # Different texts can have the same set.
    least = filled.groupBy("a", "b").agg(F.min("h").alias("h"))
    kept = filled.join(least, ["a", "b", "h"], "left_semi")
    return kept.select("document").union(signed.where("n = 0").select("document"))


def keep_one_per_component(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """The documents without near duplicates: of each component, the one with the smallest id stays.

    A row without an id stays only if no row of its component has an id, and then one of them.
    Empty documents stay. Repeated rows of a document that stays are folded into one. An id that
    stands for several texts goes only if all of them go. Very short texts are one shingle, very
    long ones are compared whole, a similarity of exactly `percent` links, and an empty table gives
    no rows. Columns and their order are those of `docs`, whatever their names.
    """
    text = F.col("document.text")
    rows = packed(docs).withColumns({"doc_id": F.col("document.doc_id").cast("long"), "t": F.md5(text.cast("binary"))})
    found = _linked(rows.select("doc_id", text.alias("text")), percent)
    stays = F.max((F.col("n_shingles") == 0) | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    known = found.where("doc_id is not null").groupBy("doc_id")
    drop = known.agg(stays.alias("stays")).where("not stays").select("doc_id")
    kept = rows.where("doc_id is not null").join(drop, "doc_id", "left_anti").dropDuplicates(["doc_id", "t"])
    return kept.select("document").union(_one_without_id(rows, found)).select("document.*")
