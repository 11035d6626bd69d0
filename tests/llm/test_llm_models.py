from __future__ import annotations

import hashlib
import math
import os
import pathlib
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parent))

import brute  # noqa: E402

from tidestream.llm import features as features_of  # noqa: E402
from tidestream.llm import fingerprints as fp  # noqa: E402
from tidestream.llm import language_id, linear, quality, toxicity, words  # noqa: E402
from tidestream.llm.catalog import QUERIES  # noqa: E402
from tidestream.llm.features import DIMENSIONS  # noqa: E402
from tidestream.llm.language_id import PLACES, LanguageModel, fit_languages, identify, keep_known_languages, letter_vectors  # noqa: E402
from tidestream.llm.quality import score_quality, train  # noqa: E402
from tidestream.llm.toxicity import OrdinalModel, grades_from_labels, score_toxicity  # noqa: E402
from tidestream.llm.toxicity import train as train_ordinal  # noqa: E402

SF = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, score double, held_out string, label int"


def odd(spark):
    rows = [(1, None), (2, ""), (3, "123 ... !!"), (None, "the thing was here"), (4, "word " * 30_000), (4, "word " * 30_000)]
    return spark.createDataFrame([(d, t, None, 0.5, "x", 1) for d, t in rows], ODD)


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.mark.parametrize("name, column, label, least", [("op1_quality_classifier", "score", "quality", 0.95), ("op7_toxicity", "severity", "toxic", 0.85)])
def test_held_out_labels(spark, name, column, label, least):
    found = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held(d) for d, r in found.items())
    test = [(found[r.doc_id][column], r[label]) for r in labels if held(r.doc_id)]
    scores, truth = map(np.array, zip(*test))
    assert auc(scores, truth) > least


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    weights = np.random.default_rng(1).normal(size=DIMENSIONS)
    one, many = (sorted(map(tuple, score_quality(docs.repartition(n), weights).collect())) for n in (1, 7))
    assert [r[:2] for r in one] == [r[:2] for r in many]
    assert np.allclose([r[2] for r in one], [r[2] for r in many])


def test_training_separates_and_ignores_noise():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 400)
    features = [np.unique(np.append(rng.integers(10, 5000, 20), 1 + label)) for label in labels]
    weights = train(features, labels)
    assert weights[2] > 0.5 and weights[1] < -0.5 and (weights != 0).sum() < 2500


def test_ordinal_thresholds_stay_ordered_and_grades_rise():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 600)
    features = [np.unique(np.append(rng.integers(1000, 5000, 10), np.arange(1, 1 + 4 * g))) for g in grades]
    model = train_ordinal(features, grades)
    assert (np.diff(model.thresholds) > 0).all()
    sums = np.array([model.weights[f].sum() for f in features])
    means = [sums[grades == g].mean() for g in range(4)]
    assert means == sorted(means)


def test_grades_of_labels():
    features = [np.array([1]), np.array([1, 2]), np.array([1, 2, 3]), *[np.array([1, 2, 3])] * 4, *[np.array([9])] * 30]
    toxic = np.array([1] * 7 + [0] * 30)
    grades = grades_from_labels(features, toxic)
    assert grades[7:].max() == 0 and grades[0] == 1 and grades[:7].min() == 1 and (np.diff(grades[:3]) >= 0).all()


def test_odd_texts_get_scores(spark):
    rows = score_quality(odd(spark), np.zeros(DIMENSIONS)).collect()
    assert [r.score for r in rows] == [0.5] * 6 and not any(r.held_out for r in rows if r.doc_id is None)
    rows = score_toxicity(odd(spark), OrdinalModel(np.zeros(DIMENSIONS), np.array([1.0, 2.0, 3.0]))).collect()
    assert len({r.severity for r in rows}) == 1 and all(r.grade == 0 for r in rows)


def test_languages_on_held_out_documents(spark):
    found = QUERIES["op6_language_id"](spark, SF).collect()
    langs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    test = [r for r in found if r.held_out and len(langs[r.doc_id].text) >= 40]
    assert np.mean([r.lang_pred == langs[r.doc_id].lang for r in test]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_vectors_are_bound_and_bundled(spark):
    """Cosines equal those of vectors built letter by letter."""
    from tidestream.llm.language_id import Profiler
    from tidestream.llm.words import pieces
    import pyarrow as pa

    texts = ["Ab, ba", "été", "", "a"]
    found = np.concatenate([Profiler().vectors(p)[0] for p in pieces(pa.array(texts))])
    letters, classes = letter_vectors().astype(int), Profiler().classes
    for text, vector in zip(texts, found):
        symbols = [0]
        for c in text:
            k = int(classes[ord(c)])
            if k or symbols[-1]:
                symbols.append(k)
        symbols = symbols if symbols[-1] == 0 and len(symbols) > 1 else [*symbols, 0]
        total = np.zeros(PLACES)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            if b:
                total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
        norm = np.linalg.norm(total)
        assert np.allclose(vector, total / norm if norm else total, atol=1e-5)


def test_odd_texts_and_no_languages(spark):
    model = fit_languages(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = identify(odd(spark), model).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and [r.score for r in rows[:3]] == [0.0] * 3
    assert rows[3].lang_pred == "en"
    kept = keep_known_languages(odd(spark), model)
    assert kept.columns == [c.split()[0] for c in ODD.split(", ")] and {r.doc_id for r in kept.collect()} <= {None, 4}
    nothing = fit_languages(odd(spark))
    assert nothing.languages == [] and {r.lang_pred for r in identify(odd(spark), nothing).collect()} == {"und"}
    assert identify(odd(spark).limit(0), LanguageModel([], np.zeros((0, PLACES)))).count() == 0


def fingerprint_rows(spark, rows, **settings):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, n_chars int")
    return sorted(fp.fingerprint_documents(docs.repartition(3), **settings).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))


@pytest.mark.parametrize("rows_per_range", [1, 4, 1000])
def test_edits_take_from_the_next_document(spark, rows_per_range):
    rows = [(10 * k, f"text número {k} " * (k % 7)) for k in range(25)] + [(251, None), (252, "x" * 50_000), (None, "last of all")]
    found = fingerprint_rows(spark, rows, rows_per_range=rows_per_range)
    texts = [t or "" for _, t in rows]
    changed = [fp.edited(t, texts[(k + 1) % len(texts)]) for k, t in enumerate(texts)]
    assert [r.n_chars for r in found] == [len(t) for t in texts]
    assert [r.edited_sha256 for r in found] == [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    prints = {t: r.fingerprint for t, r in zip(texts, found)}
    assert all(prints[t] == r.fingerprint for t, r in zip(texts, found))
    same = lambda a, b: np.mean([a[k : k + 4] == b[k : k + 4] for k in range(0, len(a), 4)])
    assert all(r.near_edited == same(r.fingerprint, r.edited_fingerprint) for r in found)
    assert all(r.near_next == same(r.fingerprint, found[(k + 1) % len(found)].fingerprint) for k, r in enumerate(found))


def test_likeness_estimates_generalised_jaccard(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300").select("doc_id", "text").collect()
    rows = sorted((r.doc_id, r.text) for r in docs)
    found = fingerprint_rows(spark, rows)
    texts = [t for _, t in rows]
    errors = []
    for k, r in enumerate(found):
        following = texts[(k + 1) % len(texts)]
        errors.append(r.near_edited - brute.generalised_jaccard(texts[k], fp.edited(texts[k], following)))
        errors.append(r.near_next - brute.generalised_jaccard(texts[k], following))
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.3 and np.std(errors) < 0.07


def test_single_and_no_document(spark):
    assert fingerprint_rows(spark, [(1, "alone in here")])[0].near_next == 1.0
    assert fingerprint_rows(spark, []) == []


def test_repeated_ids_each_have_a_row(spark):
    found = fingerprint_rows(spark, [(1, "a b c"), (1, "a b c"), (1, "z y x"), (2, "q")])
    assert len(found) == 4


def test_equal_ids_in_masses_are_cut_into_ranges(spark):
    """Rows of one id, or of none, fill many ranges; each is followed by the next in the order of hashes."""
    import xxhash

    signed = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))
    for hot in (50, None):
        rows = [(k, f"document {k} here") for k in range(100)] + [(hot, f"hot words {k} and {k * 7 % 50}") for k in range(400)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = fp.fingerprint_documents(docs.repartition(3), rows_per_range=20).collect()
        order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, signed(r[1]), r[1]))
        after = {a: b[1] for a, b in zip(order, [*order[1:], order[0]])}
        made = sorted((r.doc_id is None, r.doc_id or 0, r.edited_sha256) for r in found)
        assert made == sorted((d is None, d or 0, hashlib.sha256(fp.edited(t, after[d, t]).encode()).hexdigest()) for d, t in rows)
        keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("key"), F.xxhash64("text").alias("h"))
        sizes = [r["count"] for r in fp._in_ranges(keyed, 20).groupBy("range").count().collect()]
        assert max(sizes) <= 60 and len(sizes) >= 20


# --- Bounded samples and plain versions of the models ------------------------------------------


def test_sample_is_bounded_for_repeated_rows(spark):
    """A labelled id with very many rows gives one row to learn from, whatever the order."""
    ids = [k for k in range(1, 400) if zlib.crc32(str(k).encode()) % 5]
    rows = [(ids[0], f"text {k}") for k in range(3000)] + [(k, f"other {k}") for k in ids[1:60]] + [(None, "x"), (ids[61], None)]
    labels = [(ids[0], 1), (ids[0], 0), (ids[61], 1), (None, 1), (ids[62], None), (10**9, 1)] + [(k, k % 2) for k in ids[1:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    sample = linear.labelled_sample(docs, table, "quality").collect()
    assert len(sample) == 61
    assert [r.label for r in sample if (r.text or "").startswith("text")] == [1.0]
    again = linear.labelled_sample(docs.repartition(7), table, "quality").collect()
    assert sorted(map(str, again)) == sorted(map(str, sample))


def test_models_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    nothing = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    blank = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for table, given in ((docs, labels), (docs, blank), (nothing, labels)):
        scores = quality.score_quality(table, quality.fit_quality(table, given)).collect()
        assert [r.score for r in scores] == [0.5] * table.count()
        graded = toxicity.score_toxicity(table, toxicity.fit_toxicity(table, given)).collect()
        assert len(graded) == table.count() and all(0 <= r.severity <= 3 for r in graded)
        found = language_id.identify(table, language_id.fit_languages(table.withColumn("lang", F.lit(None).cast("string")))).collect()
        assert all(r.lang_pred == "und" and r.score == 0 for r in found)


def plain_ftrl(rows, epochs, alpha=0.1, beta=1.0, l1=1.0, l2=0.0):
    """Per-coordinate FTRL for logistic regression, a feature at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(20240101)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            features, label = rows[k]
            at = [0, *features]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            for i in at:
                rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_against_plain_loops():
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        label = rng.random() < 0.4
        rows.append((sorted(rng.sample(range(1, 40) if label else range(20, 60), 8)), float(label)))
    weights = quality.train([np.array(f) for f, _ in rows], np.array([y for _, y in rows]))
    wanted = plain_ftrl(rows, quality.EPOCHS)
    assert {int(k) for k in np.flatnonzero(weights)} == set(wanted) and len(wanted) > 10
    assert all(weights[k] == pytest.approx(w, abs=1e-9) for k, w in wanted.items())


def test_ordinal_steps_against_numeric_gradients():
    """The update of the score is the gradient of -log P(grade), taken numerically."""
    thresholds = np.array([-1.0, 0.3, 1.2])

    def loss(f, grade):
        above = [1.0, *(1 / (1 + math.exp(-(f - t))) for t in thresholds), 0.0]
        return -math.log(above[grade] - above[grade + 1])

    for grade in range(4):
        for f in (-2.0, 0.1, 1.7):
            upper = float(linear.sigmoid(thresholds[grade] - f)) if grade < 3 else 1.0
            lower = float(linear.sigmoid(thresholds[grade - 1] - f)) if grade else 0.0
            numeric = (loss(f + 1e-6, grade) - loss(f - 1e-6, grade)) / 2e-6
            assert 1.0 - upper - lower == pytest.approx(-numeric, abs=1e-5) or 1.0 - upper - lower == pytest.approx(numeric, abs=1e-5)


def test_toxicity_scores_against_plain_sums(spark):
    """Expected grades from weights and thresholds, a feature at a time."""
    rng = np.random.default_rng(4)
    model = toxicity.OrdinalModel(rng.normal(0, 0.3, toxicity.DIMENSIONS).astype(np.float32).astype(float), np.array([-0.5, 0.4, 1.5]))
    texts = ["some plain words", "Other WORDS there", "", None, "x " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    (piece,) = words.pieces(pa.array(texts))
    features, first = features_of.word_and_prefix_features(piece)
    for k in range(len(texts)):
        f = sum(model.weights[i] for i in features[first[k] : first[k + 1]])
        above = [1 / (1 + math.exp(t - f)) for t in model.thresholds]
        assert found[k].severity == pytest.approx(sum(above), abs=1e-4) and found[k].score == pytest.approx(above[0], abs=1e-4)
        assert found[k].predicted == (above[0] >= 0.25) and found[k].toxic == bool(found[k].predicted)


# --- Languages --------------------------------------------------------------------------------


def plain_profile(text, classes, letters):
    """The sum of bound trigrams of a text, letter by letter, and its number of letters."""
    codes, last = [0], 0
    for c in text or "":
        k = int(classes[ord(c)])
        if k or last or len(codes) == 1:
            codes.append(k)
        last = k
    codes.append(0)
    total = np.zeros(language_id.PLACES, int)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return total / max(np.linalg.norm(total), 1e-9)


def test_language_predictions_against_plain_profiles(spark):
    """Prototypes and predictions, Latin and other scripts, from loops over letters."""
    rng = random.Random(12)
    kinds = {
        "en": ["the", "house", "of", "and", "there", "which"],
        "ru": ["дом", "который", "и", "на", "это", "человек"],
        "zh": ["你好", "世界", "我们", "中文", "文字"],
        "ko": ["안녕", "하세요", "우리", "한국어", "글자"],
    }
    rows = [(k, " ".join(rng.choices(kinds[lang], k=rng.randrange(4, 20))), lang) for k, lang in enumerate(sorted(kinds) * 12)]
    rows += [(100, "12 -- 34", "en"), (101, None, "ru"), (102, "", None), (103, "house и 你好 우리 there", None), (None, "дом и дом", "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_languages(docs)
    classes, letters = language_id.letter_classes(), language_id.letter_vectors().astype(int)
    learned = [(t, lang) for d, t, lang in rows if d is not None and lang and zlib.crc32(str(d).encode()) % 5]
    for k, lang in enumerate(model.languages):
        total = sum(plain_profile(t, classes, letters) for t, known in learned if known == lang)
        assert np.abs(model.prototypes[k] - total / np.linalg.norm(total)).max() < 1e-4
    found = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    for d, text, lang in rows:
        cosines = model.prototypes @ plain_profile(text, classes, letters)
        if any(c.isalpha() for c in text or ""):
            assert found[d].lang_pred == model.languages[int(cosines.argmax())]
            assert found[d].cosine == pytest.approx(cosines.max(), abs=1e-4)
        else:
            assert found[d].lang_pred == "und" and found[d].score == 0
    assert all(found[k].lang_pred == lang for k, (_, _, lang) in enumerate(rows[:48]))


def test_all_letters_have_a_class():
    import unicodedata

    classes = language_id.letter_classes()
    for code in [*range(0, 0x110000, 7), *range(0x3400, 0x3500), *range(0xD7A0, 0xD800), *range(0x323A0, 0x323C0)]:
        assert (classes[code] > 0) == (unicodedata.category(chr(code))[0] == "L"), hex(code)


def test_profiles_of_large_scripts_need_little_memory():
    """10 MB of Han, Hangul and mixed scripts, in a process of its own, stay far below 1 GB."""
    program = """
import random, resource, sys
import pyarrow as pa
from tidestream.llm.language_id import Profiler
from tidestream.llm.words import pieces
rng, profiler = random.Random(1), Profiler()
ranges = [(0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x61, 0x7A), (0x410, 0x44F)]
for kinds in (ranges[:1], ranges[1:2], ranges):
    texts = ["".join(chr(rng.randint(*rng.choice(kinds))) for _ in range(340)) for _ in range(3300)]
    for piece in pieces(pa.array(texts)):
        profiler.vectors(piece)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = str(pathlib.Path(__file__).parents[2])
    done = subprocess.run([sys.executable, "-c", program], cwd=root, capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": root})
    assert int(done.stdout) < 1000, done.stderr


def test_languages_and_bounds_are_learned_from_every_labelled_document(spark):
    """7,000 documents of one language, some of them in other letters: all that are not held out count."""
    rng = random.Random(31)
    kinds = ["the", "house", "of", "and", "there", "which", "under", "quick", "river"], ["ξψ", "ωφχ", "щжю", "ъэ", "ღყ", "ჭხ"]
    rows = [(k, " ".join(rng.choices(kinds[rng.random() < 0.03], k=rng.randrange(8, 40)))) for k in range(7000)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string").repartition(5)
    model = language_id.fit_languages(docs)
    learned = [t for k, t in rows if zlib.crc32(str(k).encode()) % 5]
    profiler = language_id.Profiler()
    total = sum(profiler.vectors(piece)[0].sum(axis=0, dtype=np.float64) for piece in words.pieces(pa.array(learned)))
    assert np.abs(model.prototypes[0] - total / np.linalg.norm(total)).max() < 1e-6

    cut = [{t[: (language_id.MIN_LETTERS << k) * 7 // 4] for k in range(language_id.LENGTH_CLASSES - 1)} | {t} for t in learned]
    found = [[] for _ in range(language_id.LENGTH_CLASSES)]
    for piece in words.pieces(pa.array([x for texts in cut for x in texts])):
        _, _, cosine, letters = language_id.predict(profiler, model, piece)
        for k, c in zip(language_id.length_class(letters), cosine):
            found[k].append(round(float(c), 6)) if k >= 0 else None
    expected = [min(language_id.NOISE, float(np.percentile(f, 1))) if f else None for f in found]
    bounds = language_id.fit_bounds(docs, model)
    assert any(e is not None and e < language_id.NOISE for e in expected)
    for e, bound in zip(expected, bounds):
        assert e is None or bound == pytest.approx(e, abs=2e-6)
