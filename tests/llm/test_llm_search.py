"""Vector codes, ranked search and SimHash against plain versions."""

from __future__ import annotations

import hashlib
import math
import pathlib
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import differences, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parent))

import brute  # noqa: E402

from tidestream.llm import ranked_search, vector_codes  # noqa: E402
from tidestream.llm.catalog import QUERIES  # noqa: E402
from tidestream.llm.oracle import ORACLE  # noqa: E402
from tidestream.llm.simhash import fingerprints, links, simhash_components  # noqa: E402
from tidestream.llm.storage import join_hot  # noqa: E402
from tidestream.llm.words import pieces  # noqa: E402

DOCS = "doc_id long, text string, fingerprint long, n long, root string, variant string, terms string, rank int, rank2 int"


def documents(spark, rows):
    """Documents with other columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, 1, 2, "r", "v", "t", 3, 4) for d, t in rows], DOCS)


def odd_texts(seed=3, count=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Straße", "naïve", "日本", "x-y", "A_B", "a.b", "7", "—"]
    rows = [(k * 2, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for k in range(count)]
    rows += [(500 + k, rows[k][1].upper()) for k in range(5)] + [(600 + k, rows[10][1] + " tail") for k in range(6)]
    rows += [(700, None), (701, ""), (702, " \n\t"), (703, "one"), (704, "One TWO"), (705, "... --"), (706, "deep " * 4000)]
    rows += rows[:3] + [(None, rows[4][1]), (None, "w1 w2 w3"), (None, None)]
    return rows


# --- SimHash ---------------------------------------------------------------------------------


def plain_fingerprint(text):
    found = brute.words(text)
    if not found:
        return 0
    grams = [" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """The root of every position; linked are fingerprints within the radius."""
    values = np.array(prints, np.uint64)
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in zip(*np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= radius)):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab Z\n\té€\x0b", max_size=40), max_size=8))
def test_fingerprints_of_a_batch(texts):
    found = [int(x) for piece in pieces(pa.array(texts, pa.string())) for x in fingerprints(piece)]
    assert found == [plain_fingerprint(t) for t in texts]


def test_fingerprint_of_a_long_text():
    """More shingles than bits add up in a byte, between short texts."""
    rng = random.Random(1)
    texts = ["a b", " ".join(f"w{rng.randrange(900)}" for _ in range(3000)), "", "x " * 256, "y " * 257 + "z"]
    found = [int(x) for piece in pieces(pa.array(texts)) for x in fingerprints(piece)]
    assert found == [plain_fingerprint(t) for t in texts]


def test_simhash_components(spark):
    rows = odd_texts()
    got = simhash_components(documents(spark, rows).repartition(3)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    wanted = [(d, p, least.get(r)) for (d, _), p, r in zip(rows, prints, roots)]
    key = lambda row: tuple((x is None, x or 0) for x in row)
    assert sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got), key=key) == sorted(wanted, key=key)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_give_all_components(spark, radius):
    """Random families, tight clusters around one fingerprint, and both ends of the sign."""
    rng = random.Random(radius)
    values = {0, 1, 3, 7, 2**64 - 1, 2**63, 2**63 + 1}
    for _ in range(120):
        seed = rng.getrandbits(64)
        values.add(seed)
        for _ in range(3):
            values.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    centre = rng.getrandbits(64)
    values |= {centre ^ (1 << a) ^ (1 << b) for a, b in (rng.sample(range(64), 2) for _ in range(300))}
    values = sorted(values)
    table = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fingerprint long")
    edges = [(r.a % 2**64, r.b % 2**64) for r in links(table, radius).collect()]
    assert len(edges) == len(set(edges)) and all(1 <= (a ^ b).bit_count() <= radius for a, b in edges)
    at = {v: k for k, v in enumerate(values)}
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    assert [find(k) for k in range(len(values))] == plain_components(values, radius)


def test_every_pattern_of_differing_bits_meets(spark):
    """For pairs on their own, with the differing bits in every mixture of halves."""
    rng = random.Random(8)
    pairs = []
    for low in range(4):
        for _ in range(12):
            bits = rng.sample(range(32), low) + rng.sample(range(32, 64), 3 - low)
            value = rng.getrandbits(64)
            pairs.append((value, value ^ sum(1 << b for b in bits)))
    signed = [(v - 2**64 if v >> 63 else v,) for pair in pairs for v in pair]
    found = {frozenset((r.a % 2**64, r.b % 2**64)) for r in links(spark.createDataFrame(signed, "fingerprint long")).collect()}
    assert {frozenset(p) for p in pairs} <= found
    with pytest.raises(ValueError):
        links(spark.createDataFrame(signed, "fingerprint long"), 4)


def test_a_variant_gives_a_star(spark):
    """A fingerprint with all of its neighbours needs as many links as neighbours, not all pairs."""
    centre = 0x123456789ABCDEF
    table = spark.createDataFrame([(centre,)] + [(centre ^ (1 << b),) for b in range(63)], "fingerprint long")
    found = links(table, 1).collect()
    assert len(found) == 63


def test_simhash_of_nothing(spark):
    assert simhash_components(documents(spark, [])).collect() == []
    only = simhash_components(documents(spark, [(5, None), (3, ""), (None, " ")])).collect()
    assert sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in only) == [(0, 0, 3), (3, 0, 3), (5, 0, 3)]


def test_simhash_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints)
    got = QUERIES["op13_simhash"](spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == [(d, f"{p:016x}", rows[r][0]) for (d, _), p, r in zip(rows, prints, roots)]


def test_join_with_hot_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("key"), "id")
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("most")).where("key <> 1600")
    got = {r.id: r.most for r in join_hot(rows, lookup, "key", "n").collect()}
    assert got == {k: 1499 if k < 1500 else k for k in range(3000) if k != 1600}


# --- Vector codes ----------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, code string, error int, of int, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(v, e, n, "c", 1, 2, 3) for v, e, n in rows], VECTORS)


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, label, code, error, label_error, sha) of rows (vec_id, embedding, label) sorted by id."""
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in e] for _, e, _ in rows], object)
    width = x.shape[1] // parts
    cut = [x[:, k * width : (k + 1) * width] for k in range(parts)]
    books = [c[:entries].copy() for c in cut]

    def nearest(points, book):
        apart = [[sum((a - b) ** 2 for a, b in zip(p, e)) for e in book] for p in points]
        best = [min(range(len(book)), key=lambda k: (row[k], k)) for row in apart]
        return best, [row[k] for row, k in zip(apart, best)]

    for _ in range(rounds):
        for c, book in zip(cut, books):
            chosen, _ = nearest(c, book)
            for e in range(len(book)):
                own = [p for p, k in zip(c, chosen) if k == e]
                if own:
                    book[e] = [sum(column) // len(own) for column in zip(*own)]
    final = [nearest(c, book) for c, book in zip(cut, books)]
    codes = [bytes(row).hex() for row in zip(*(chosen for chosen, _ in final))]
    errors = [sum(row) for row in zip(*(error for _, error in final))]
    of = {}
    for (_, _, label), error in zip(rows, errors):
        of[label] = of.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return [(v, label, code, error, of[label], sha) for (v, _, label), code, error in zip(rows, codes, errors)]


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_codes_with_odd_rows(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(32)], k % 4 if k % 7 else None) for k in range(150)]
    rows += [(150 + k, rows[k][1], 9) for k in range(5)]  # equal vectors
    rows += [(160, [50_000.0] * 32, 1), (161, [-0.001] * 32, 1), (162, [3.0] * 16 + [-3.0] * 16, None)]
    rows += [rows[-1]]  # a repeated row
    bad = [(-5, None, 1), (-4, [float("nan")] * 32, 1), (-3, [1.0] * 31 + [None], 1), (-2, [float("inf")] * 32, 1), (-1, [], 1)]
    bad += [(170, [1.0] * 16, 1), (171, [1.0] * 33, 1)]
    got = vector_codes.compress(vectors(spark, rows + bad).repartition(3))
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted_rows(got.collect()) == sorted_rows(plain_codes(rows))


def test_codes_without_ids_and_with_few_vectors(spark):
    rows = [(3, [0.5] * 16, None), (8, [0.25] * 16, None), (None, [0.1] * 16, 2), (None, [0.1] * 16, 2)]
    assert sorted_rows(vector_codes.compress(vectors(spark, rows)).collect()) == sorted_rows(plain_codes(rows))
    assert vector_codes.compress(vectors(spark, [])).collect() == []
    assert vector_codes.compress(vectors(spark, [(1, None, 1), (2, [float("nan")] * 16, 1)])).collect() == []


@pytest.mark.parametrize("width, cells", [(1, 200_000), (3, 200_000), (4, 7)])
def test_memoised_cells_give_the_nearest(width, cells):
    """Ties, points far away, hash collisions and a memo that is full, in many batches."""
    rng = np.random.default_rng(width)
    entries = rng.integers(-40, 40, (20, width))
    entries[7] = entries[3]
    memo = vector_codes.CellMemo(entries, max_cells=cells)
    evaluated = 0
    for _ in range(6):
        points = np.concatenate([rng.integers(-60, 60, (300, width)), entries, rng.integers(-(10**6), 10**6, (3, width))])
        apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        found, distance = memo.nearest(points)
        assert (found == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
        evaluated += apart.size
    assert memo.evaluated < evaluated  # fewer than all were evaluated exactly
    memo.cells[:] = 10**9  # as if all known cells shared their hashes with others
    assert (memo.nearest(points)[0] == apart.argmin(axis=1)).all()


def test_huge_components_are_held(spark):
    """Components beyond the range of 64-bit distances do not wrap around."""
    rows = [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [0.0] * 16, 1)]
    got = {r.vec_id: (r.code, r.error) for r in vector_codes.compress(vectors(spark, rows)).collect()}
    assert got == {1: ("00" * 16, 0), 2: ("01" * 16, 0), 3: ("02" * 16, 0)}


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_ranked_search"])
def test_whole_tables_in_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name]) is None


# --- Ranked search ---------------------------------------------------------------------------


def plain_terms(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found, now = [], ""
    for c in folded + " ":
        if c.isascii() and not c.isalnum():
            if now:
                found.append(now)
            now = ""
        else:
            now += c
    return found


def plain_search(rows, items, k=10):
    terms = [plain_terms(t) for _, t in rows]
    documents, total = sum(bool(t) for t in terms), sum(map(len, terms))
    df = {}
    for found in terms:
        for t in set(found):
            df[t] = df.get(t, 0) + 1
    result = []
    for item, text in items:
        scores = []
        for (doc_id, _), found in zip(rows, terms):
            m = 25 + 75 * len(found) * documents // total if total else 0
            score = 0
            for t in plain_terms(text):
                tf = found.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        result += [(item, place, None if null else d, -s) for place, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return result


ITEMS = [
    (1, "w1 w2 w2 W3 x-y"),
    (2, "deep W7 w8 w9 w10 w11 w12"),
    (3, None),
    (4, "..."),
    (5, "nowhere to be found"),
    (6, "naïve STRASSE Straße 日本 — 7"),
    (None, "w5 w6"),
    (1, "w1 w2 w2 W3 x-y"),
    (8, "one TWO"),
]


@pytest.mark.parametrize("chunk, depth, block", [(2_000_000, 16, 1 << 22), (150, 1, 40)])
def test_search(spark, monkeypatch, chunk, depth, block):
    """Also in many small chunks, blocks of few queries and steps of one position."""
    monkeypatch.setattr(ranked_search, "CHUNK_POSTINGS", chunk)
    monkeypatch.setattr(ranked_search, "FIRST_DEPTH", depth)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    rows = odd_texts()
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, query int")
    got = ranked_search.search(documents(spark, rows).repartition(3), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted_rows(got.collect()) == sorted_rows(plain_search(rows, ITEMS))


def test_search_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.search(documents(spark, []), items).collect() == []
    assert ranked_search.search(documents(spark, odd_texts()), items.limit(0)).collect() == []
    assert ranked_search.search(documents(spark, [(1, None), (2, "--")]), items).collect() == []


def lists_of(impact_rows, size):
    """Lists from dense rows of impacts, one per document; 0 stands for absent."""
    table = np.array(impact_rows)
    owner, terms = np.nonzero(table)
    first = np.searchsorted(owner, np.arange(len(table) + 1))
    ids = np.stack([np.zeros(len(table), np.int64), np.arange(len(table))], axis=1)
    return ranked_search.Lists(ids, first, terms, table[owner, terms], size)


def test_best_positions_stop_early():
    """Documents far down all lists are not scored, and nothing is marked afterwards."""
    rng = np.random.default_rng(5)
    table = rng.integers(1, 100, (5000, 4))
    table[:40] += 1000
    lists = lists_of(table, 4)
    best = ranked_search.Best(10)
    scored = lists.search(np.arange(4), np.array([1, 2, 1, 1]), best)
    totals = table @ np.array([1, 2, 1, 1])
    order = np.lexsort((np.arange(5000), -totals))[:10]
    assert best.ids[:, 1].tolist() == order.tolist() and best.scores.tolist() == totals[order].tolist()
    assert scored < 500
    assert not lists.seen.any() and not lists.scored.any() and not lists.repeats.any()


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 3), min_size=3, max_size=3), min_size=1, max_size=40),
    st.lists(st.integers(1, 3), min_size=3, max_size=3),
    st.integers(1, 6),
)
def test_best_positions_with_ties(table, repeats, k):
    """Equal scores go by id, however the lists are ordered; the search goes on over two chunks."""
    wanted = sorted((-sum(a * b for a, b in zip(row, repeats)), d) for d, row in enumerate(table))
    wanted = [(d, -s) for s, d in wanted if s < 0][:k]
    best = ranked_search.Best(k)
    half = len(table) // 2
    for begin, rows in ((half, table[half:]), (0, table[:half])):
        if rows:
            lists = lists_of(rows, 3)
            lists.ids[:, 1] += begin
            lists.search(np.arange(3), np.array(repeats), best)
    assert [(int(d), int(s)) for (_, d), s in zip(best.ids, best.scores)] == wanted


def test_long_documents_do_not_overflow():
    found = ranked_search.impacts(np.array([5]), np.array([3]), np.array([10**9]), 10**10, 10**13)
    assert found.tolist() == [5 * ((3 * 10**9) // (3000 + 8 * (25 + 75 * 10**9 * 10**10 // 10**13)))]


# --- Hashes of words -------------------------------------------------------------------------


def test_words_that_beat_power_sums_have_different_hashes():
    """Thue-Morse words and their complements are equal under every power sum modulo 2**64."""
    for size in (8, 16, 64, 1024, 4096):
        word = "".join("ab"[k.bit_count() % 2] for k in range(size))
        other = word.translate(str.maketrans("ab", "ba"))
        (piece,) = pieces(pa.array([f"{word} {other}", f"x {word.upper()}"]))
        starts, ends, _ = piece.spans()
        a, b, _, c = piece.hash_spans(starts, ends, fold_case=True)
        assert a != b and a == c


def test_short_words_have_different_hashes():
    rng = random.Random(4)
    found = {"".join(rng.choices("abehinort", k=rng.randrange(1, 20))) for _ in range(60_000)}
    (piece,) = pieces(pa.array([" ".join(sorted(found))]))
    starts, ends, _ = piece.spans()
    assert len(set(piece.hash_spans(starts, ends).tolist())) == len(found)
