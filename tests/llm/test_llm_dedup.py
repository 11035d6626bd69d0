from __future__ import annotations

import hashlib
import pathlib
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from compare import differences, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidestream.llm import jaccard_join, license_scan, line_dedup  # noqa: E402
from tidestream.llm.catalog import QUERIES  # noqa: E402
from tidestream.llm.exact_dedup import exact_groups  # noqa: E402
from tidestream.llm.oracle import ORACLE  # noqa: E402
from tidestream.llm.words import pieces, shingle_sets  # noqa: E402

SCHEMA = "doc_id long, text string, source string, n long, key string, line string, row long"


def table(spark, rows):
    """Documents with other columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, s, 1, "k", "l", 2) for d, t, s in rows], SCHEMA)


def near_copies(seed=7, documents=40):
    """Base texts, edited copies, shared passages, odd texts."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for base in range(documents // 8):
        text = [f"w{rng.randrange(500)}" for _ in range(60)]
        rows += [(" ".join(text)), (" ".join(text).upper()), ("\t".join(text) + "\n")]
        for _ in range(4):
            changed = list(text)
            for _ in range(rng.randrange(1, 3)):
                changed[rng.randrange(60)] = f"x{rng.randrange(9999)}"
            rows.append(" ".join(changed))
        rows.append(" ".join(passage + [f"q{rng.randrange(9999)}" for _ in range(rng.randrange(4, 12))]))
    rows += [None, "", " \n ", "one two", "One  two", "one", "long " * 3000]
    rng.shuffle(rows)
    return [(k * 3, text, f"s{k % 3}") for k, text in enumerate(rows)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab Z\n\té€\x0b", max_size=30), max_size=8))
def test_shingles_of_a_batch(texts):
    """Set sizes and equality of sets agree with plain word lists."""
    found = []
    for piece in pieces(pa.array(texts, pa.string())):
        values, first = shingle_sets(piece)
        found += [frozenset(values[a:b].tolist()) for a, b in zip(first, first[1:])]
    wanted = [brute.shingles(t) for t in texts]
    assert [len(x) for x in found] == [len(x) for x in wanted]
    assert [[a & b == a for b in found] for a in found] == [[a & b == a for b in wanted] for a in wanted]


def test_sliced_batches_and_nulls():
    column = pa.array(["a b", None, "c d e f g h", "a b"]).slice(1)
    sizes = [n for piece in pieces(column) for n in np.diff(shingle_sets(piece)[1])]
    assert sizes == [0, 2, 1]


@pytest.mark.parametrize("block, megabytes", [(4_000_000, 0), (150, 0), (4_000_000, 500_000)])
def test_jaccard_components(spark, monkeypatch, block, megabytes):
    """All links, also where candidate groups are cut into blocks or there are very many buckets."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard_join, "text_bytes", lambda docs: megabytes << 20)
    rows = near_copies()
    rows += rows[:3] + [(None, rows[0][1], None), (None, "nothing like it at all here", None)]
    got = jaccard_join.jaccard_components(table(spark, rows).repartition(3)).collect()
    wanted = brute.jaccard_components([(d, t) for d, t, _ in rows])
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))


def test_jaccard_against_all_pairs_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = jaccard_join.jaccard_components(docs).collect()
    assert sorted(map(tuple, got)) == sorted(brute.jaccard_components(rows))


def test_threshold_is_exact():
    """8 of 10 shingles link, one less does not."""
    a, b, c = np.arange(9), np.arange(1, 10), np.arange(2, 11)
    tokens = np.concatenate([a, b, c]).astype(np.uint64)
    assert jaccard_join.connect(tokens, np.array([0, 9, 18, 27])).tolist() == [0, 0, 0]
    tokens = np.concatenate([a, c]).astype(np.uint64)
    assert jaccard_join.connect(tokens, np.array([0, 9, 18])).tolist() == [0, 1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 14), min_size=1, max_size=12), min_size=1, max_size=14))
def test_connect_finds_every_link(sets):
    tokens = np.array([t for s in sets for t in sorted(s)], np.uint64)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    root = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    assert jaccard_join.connect(tokens, first).tolist() == root


def test_one_document_per_component(spark):
    rows = near_copies()
    rows += rows[:2]
    rows.append((rows[-1][0], "a text of its own under an id that is taken", "s1"))
    kept = jaccard_join.keep_one_per_component(table(spark, rows))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    stays = {d for d, n, c in brute.jaccard_components([(d, t) for d, t, _ in rows]) if d == c or n == 0}
    wanted = {(d, t) for d, t, _ in rows if d in stays}
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, wanted))


def test_one_document_per_component_without_ids(spark):
    """A row without an id gives way to one with an id; of rows that all lack it one stays."""
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcd"]
    near = [f"{t} more" for t in texts]
    rows = [(7, near[0], "s"), (3, texts[0], "s"), (None, texts[0], "s"), (None, near[0].upper(), "s")]
    rows += [(None, texts[1], "s"), (None, texts[1].upper(), "s"), (None, near[1], "s"), (None, near[1], "s")]
    rows += [(None, texts[2], "s"), (9, texts[3], "s"), (None, "", "s"), (None, None, "s")]
    kept = jaccard_join.keep_one_per_component(table(spark, rows).repartition(3)).collect()
    assert [c for c in kept[0].asDict()] == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [3, 9]
    loose = [r.text for r in kept if r.doc_id is None]
    assert len(loose) == 4 and {"", None, texts[2]} < set(loose)
    assert sum(t in (texts[1], texts[1].upper(), near[1]) for t in loose) == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_operator_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name]) is None


@pytest.mark.parametrize("bits", [1 << 29, 1 << 16])
def test_exact_groups_on_odd_rows(spark, bits):
    rows = [(5, "a b", "s"), (2, "a\n\tb", "s"), (9, " a b", "s"), (1, None, "s"), (0, "", "s"), (7, "x" * 200_000, None)]
    rows += [(None, "a b", "s"), (2, "a b", "s")]
    found = exact_groups(table(spark, rows), bits).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.text_sha256, []).append(r)
    assert sorted(len(g) for g in groups.values()) == [1, 1, 2, 4]
    for group in groups.values():
        assert {r.group_size for r in group} == {len(group)}
        assert sum(r.kept for r in group) == 1
        assert {r.keep_id for r in group} == {min(r.doc_id for r in group if r.doc_id is not None)}
        assert all(r.doc_id == r.keep_id for r in group if r.kept)


def test_exact_groups_pass_unique_rows_without_shuffle(spark):
    rows = [(k, f"text {k}", "s") for k in range(200)]
    assert all(r.kept and r.group_size == 1 for r in exact_groups(table(spark, rows)).collect())


def test_a_full_filter_only_costs_time(spark):
    """A filter far too small lets everything through and the groups stay right."""
    rows = [(k, f"text {k % 5000}", "s") for k in range(6000)]
    found = exact_groups(spark.createDataFrame(rows, "doc_id long, text string, source string"), 1 << 16).collect()
    assert sum(r.kept for r in found) == 5000


def test_empty_tables(spark):
    nothing = table(spark, [])
    assert exact_groups(nothing).count() == 0
    assert jaccard_join.jaccard_components(nothing).count() == 0
    assert line_dedup.remove_boilerplate(nothing).count() == 0
    assert license_scan.scan_licenses(nothing).count() == 0


def test_line_dedup_by_sites(spark):
    """Lines on exactly the threshold go, lines on one site less stay, blank lines always stay."""
    rows = [(k, f"own line of {k}\nshared line here\n  padded shared line \n \nOf.", f"s{k}") for k in range(10)]
    rows += [(50 + k, f"nine sites only\ntext {k} stays here", f"s{k}") for k in range(9)]
    rows += [(90, "nine sites only", "s1"), (91, None, "s1"), (92, "", None), (93, "shared line here", "s2"), (93, "shared line here", "s2")]
    found = {}
    for r in line_dedup.clean_texts(table(spark, rows)).collect():
        found.setdefault(r.document.doc_id, []).append(r)
    assert found[3][0].text == "own line of 3\n " and (found[3][0].lines, found[3][0].removed) == (5, 3)
    assert found[55][0].text == "nine sites only\ntext 5 stays here"
    assert found[91][0].text is None and found[92][0].text == ""
    assert [r.text for r in found[93]] == ["", ""]
    assert found[3][0].document.key == "k"
    words = line_dedup.clean_texts(table(spark, rows), min_words=2).where("document.doc_id = 3").first()
    assert words.text == "own line of 3\n \nOf."


def test_pipeline_removes_short_lines_by_sites_alone(spark):
    """Labels of one or two words go at the threshold of sites, stay below it; blank lines stay."""
    rows = [(k, f"Read more\n\n  Of. \nown line of {k}\n ", f"s{k}") for k in range(10)]
    rows += [(50 + k, f"Nine sites\nNine\ntext {k} stays here", f"s{k}") for k in range(9)]
    docs = table(spark, rows).withColumn("n_chars", F.lit(0).cast("long"))
    found = {r.doc_id: r for r in corpus_pipeline.line_stage(spark, docs, "").collect()}
    assert found[3].text == "\nown line of 3\n " and found[3].n_chars == 16
    assert found[55].text == "Nine sites\nNine\ntext 5 stays here"


def test_line_dedup_counts_a_null_site_once(spark):
    rows = [(k, "shared line here", None if k < 5 else f"s{k}") for k in range(13)]
    found = line_dedup.boilerplate_lines(table(spark, rows)).count()
    assert found == 0  # 8 named sites and the null one
    rows.append((20, "shared line here", "s20"))
    assert line_dedup.boilerplate_lines(table(spark, rows)).count() == 1


def test_hot_line_spread_over_many_sites(spark):
    """Far more sites than a small sketch holds exactly."""
    rows = [(k, f"everywhere on the web\nonly in group {k % 700}", f"s{k}") for k in range(6300)]
    assert line_dedup.boilerplate_lines(table(spark, rows), min_sites=100).count() == 1


def license_brute(text, notice, share=0.8):
    import re

    found, wanted = re.findall("[a-z0-9]+", text.lower()), re.findall("[a-z0-9]+", notice.lower())
    have = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
    need = {tuple(wanted[k : k + 5]) for k in range(len(wanted) - 4)}
    length, step, _ = license_scan.window_plan(len(need))
    best = max((len(need & set(have[a : a + length])) / len(need) for a in range(0, len(have), step)), default=0)
    return best if best >= share else None


def test_license_scan_against_brute_force(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join(f"w{rng.randrange(50)}" for _ in range(n))
    rows = [(None, license_scan.NOTICES["mit"], "s"), (1, None, "s"), (2, "", "s"), (3, "four words only here", "s")]
    for k, notice in enumerate(license_scan.NOTICES.values()):
        words = notice.split()
        changed = list(words)
        changed[len(words) // 2] = "other"
        for j, text in enumerate((notice, notice.upper(), " ".join(changed), " ".join(words[1:]), " ".join(words[: len(words) // 2]))):
            rows.append((100 + 10 * k + j, f"{filler(rng.randrange(40))} {text}\n{filler(rng.randrange(40))}", "s"))
    rows += [rows[5], (9000, filler(5000), "s")]
    got = [(r.doc_id, r.license, round(r.containment, 9)) for r in license_scan.scan_licenses(table(spark, rows)).collect()]
    wanted = []
    for doc_id, text, _ in rows:
        for name, notice in license_scan.NOTICES.items():
            if (share := license_brute(text or "", notice)) is not None:
                wanted.append((doc_id, name, round(share, 9)))
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_license_scan_of_short_notices(spark):
    """A notice of fewer than five words is found wherever all its words stand in a row, and nowhere else."""
    notices = {**license_scan.NOTICES, **license_scan.SHORT_NOTICES, "unlicensed": "UNLICENSED"}
    texts = ["All rights reserved.", "(c) me. ALL  RIGHTS\nreserved! more", "all rights are reserved", "all rights", None, "", "unlicensed",
             "some words, all rights reserved, Released under the MIT License."]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    found = {tuple(r) for r in license_scan.scan_licenses(table(spark, rows), notices).collect()}
    assert found == {
        (0, "all-rights-reserved", 1.0, 0, 2),
        (1, "all-rights-reserved", 1.0, 2, 4),
        (6, "unlicensed", 1.0, 0, 0),
        (7, "all-rights-reserved", 1.0, 2, 4),
        (7, "mit", 1.0, 5, 9),
    }


def test_license_headers_and_texts(spark):
    """Standard headers are found, and no other version or license of the family with them."""
    gnu = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."
    headers = {
        "gpl-2.0-header": gnu.format("program", "", "2"),
        "gpl-3.0-header": gnu.format("program", "", "3"),
        "lgpl-2.0-header": gnu.format("library", "Library ", "2"),
        "lgpl-2.1-header": gnu.format("library", "Lesser ", "2.1"),
        "lgpl-3.0-header": gnu.format("library", "Lesser ", "3"),
        "agpl-3.0-header": gnu.format("program", "Affero ", "3"),
    }
    headers |= {k: v for k, v in license_scan.LICENSE_TEXTS.items() if k not in headers}
    rows = [(k, f"some words before\n{text} and after it", "s") for k, text in enumerate(headers.values())]
    found = license_scan.scan_licenses(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.license) for r in found) == list(enumerate(headers))


def test_band_settings_keep_their_promise():
    for m in (1, 3, 8, 50, 400):
        length, step, bands = license_scan.window_plan(m)
        least = 0.8 * m / (length + 0.2 * m)
        assert length == m + step - 1 and 1 - (1 - least) ** bands >= 0.9999


CLASHES = ("__t", "__gone", "__lines", "__removed", "__a", "__b", "__h", "__n", "__row", "__copy", "__copies", "__source", "a.b", "t", "gone",
           "document", "row", "copy", "copies", "n", "a", "b", "h", "key", "size", "root", "node", "stays")


def test_callers_columns_pass_whatever_their_names(spark):
    """Every filtering operator gives back the caller's columns, also those with a name used inside."""
    from tidestream.llm.mixing import take_mix

    rows = [(k, f"line shared by all\nown words of the document number {k} and some more", f"s{k % 12}") for k in range(24)]
    rows += [(None, "a text without an id but with words", "s1"), (7, rows[7][1], "s7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for at, name in enumerate(CLASHES):
        docs = docs.withColumn(name, F.concat(F.lit(f"{at}-"), F.coalesce(F.col("doc_id"), F.lit(-1))))
    for operator in (line_dedup.remove_boilerplate, jaccard_join.keep_one_per_component, take_mix, corpus_pipeline.mixing_stage, corpus_pipeline.near_duplicate_stage):
        made = operator(docs) if operator.__module__.startswith("tidestream") else operator(spark, docs, "")
        assert made.columns == docs.columns
        found = made.collect()
        assert found
        for r in found:
            assert [r[name] for name in CLASHES] == [f"{at}-{-1 if r.doc_id is None else r.doc_id}" for at in range(len(CLASHES))]
    with_counts = docs.withColumn("n_chars", F.lit(0).cast("long"))
    assert corpus_pipeline.line_stage(spark, with_counts, "").columns == with_counts.columns


def test_words_with_equal_power_sums_do_not_link(spark):
    """The Thue-Morse word and its complement had one hash, so their documents were one component."""
    word = "".join("ab"[k.bit_count() % 2] for k in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    found = jaccard_join.jaccard_components(table(spark, [(1, word, "s"), (2, other, "s")])).collect()
    assert sorted(map(tuple, found)) == [(1, 1, 1), (2, 1, 2)]


def near_pairs(pairs, ids):
    rng = random.Random(3)
    rows = []
    for k in range(pairs):
        text = [f"w{rng.randrange(10**6)}" for _ in range(30)]
        rows += [(2 * k if ids else None, " ".join(text), "s"), (2 * k + 1 if ids else None, " ".join([*text[:-1], "end"]), "s")]
    return rows


def test_near_pairs_without_ids_cost_no_more(spark):
    """Representatives are told apart by their texts, so rows without ids do not meet in masses."""
    import time

    took = {}
    for ids in (True, False):
        docs = table(spark, near_pairs(2000, ids)).repartition(4)
        start = time.perf_counter()
        found = jaccard_join.jaccard_components(docs).collect()
        took[ids] = time.perf_counter() - start
        assert len(found) == 4000
        if ids:
            assert all(r.component_id == r.doc_id // 2 * 2 for r in found)
    assert took[False] < 1.5 * took[True] + 3
    assert jaccard_join.keep_one_per_component(table(spark, near_pairs(50, False))).count() == 50


def test_one_id_for_many_texts(spark):
    rows = [(7, text, s) for _, text, s in near_pairs(300, False)] + [(7, "same text in many rows of one id", "s")] * 300
    found = jaccard_join.jaccard_components(table(spark, rows).repartition(4)).collect()
    assert len(found) == 900 and {r.component_id for r in found} == {7}
    assert jaccard_join.keep_one_per_component(table(spark, rows)).count() == 601


@pytest.mark.parametrize("chunk", [400_000, 40])
def test_shingle_in_every_document(spark, monkeypatch, chunk):
    """A shingle that all share leaves a chunk once, and is still known to be shared in every document."""
    monkeypatch.setattr(jaccard_join, "CHUNK_SHINGLES", chunk)
    monkeypatch.setattr(jaccard_join, "CHUNK_SHINGLES_PER_BUCKET", 1)
    rng = random.Random(9)
    rows = []
    for k in range(60):
        own = [f"w{rng.randrange(10**6)}" for _ in range(6)]
        rows += [(3 * k, " ".join(["the same five words here", *own]), "s"), (3 * k + 1, " ".join(["the same five words here", *own, "x"]), "s")]
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    wanted = brute.jaccard_components([(d, t) for d, t, _ in rows])
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_bucket_rows_hold_shingles_once_per_chunk():
    """2,000 documents of one chunk with one shingle: one entry, and all of them known to share it."""
    chunk = jaccard_join._Chunk(0, 16)
    chunk.add(list(range(2000)), [0] * 2000, np.full(2000, 77, np.uint64), np.arange(2001))
    rows = chunk.batch(jaccard_join._arrow_schema(jaccard_join._SCAN), weigh=False).to_pylist()
    assert [len(r["tokens"]) for r in rows if r["tokens"]] == [4]
    assert (np.frombuffer(rows[-1]["facts"], np.uint64).reshape(-1, 4)[:, 3] == 1).all()


@pytest.mark.parametrize("bits", [1 << 29, 1 << 13])
def test_exact_groups_by_slices(spark, bits):
    """A small filter cuts the hashes into slices; the groups are those of one filter, hot group included."""
    rng = random.Random(6)
    rows = [(k, f"text {rng.randrange(900)}", "s") for k in range(2500)] + [(5000 + k, "hot  text" if k % 2 else "hot\ttext", "s") for k in range(900)]
    rows += [(None, "text 1", "s"), (None, "hot text", "s"), (9000, None, "s"), (9001, "", "s")]
    found = exact_groups(table(spark, rows).repartition(5), bits)
    wanted = {}
    for d, t, _ in rows:
        wanted.setdefault(" ".join((t or "").split(" ")).replace("  ", " ").replace("\t", " "), []).append(d)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in wanted.items()}
    got = {}
    for r in found.collect():
        assert r.group_size == len(by_text[r.text_sha256]) and r.keep_id == min(d for d in by_text[r.text_sha256] if d is not None)
        got.setdefault(r.text_sha256, []).append((r.doc_id, r.kept))
    assert {t: sorted(map(str, (d for d, _ in rs))) for t, rs in got.items()} == {t: sorted(map(str, ids)) for t, ids in by_text.items()}
    assert all(sum(kept for _, kept in rs) == 1 for rs in got.values())
