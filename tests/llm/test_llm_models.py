import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from agorakit.llm import language as L
from agorakit.llm import quality as Q

ALPHABETS = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "éèêçàùôî"}


def text_in(lang, rng, n=40):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(ALPHABETS))
        rows.append((i, text_in(lang, rng), lang))
    return rows


def docs_of(spark, rows):
    data = [(i, t, g, "s", 1.5) for i, t, g in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, h string, score double")


def test_languages_are_learned_and_held_out_rows_are_right(spark):
    rows = corpus()
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    # a wrong label of a held-out row must not matter, and null labels are not learned
    given = [(i, t, "zz" if i in held else (None if i % 10 == 0 else g)) for i, t, g in rows]
    given += [(900, None, "aa"), (901, "", "aa"), (902, "12 !! 34", "bb"), (3, rows[3][1], rows[3][2]), (None, rows[5][1], None)]
    found = L.languages(docs_of(spark, given)).collect()
    assert len(found) == len(given)
    truth = {i: g for i, _, g in rows}
    for r in found:
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred == truth[r.doc_id] and r.held_out == (r.doc_id in held)
        assert 0 <= r.score <= 1


def test_language_stage_keeps_columns_and_lettered_rows(spark):
    docs = docs_of(spark, [*corpus(), (900, None, "aa"), (901, "12 !!", "aa")])
    kept = L.recognised(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 240 and kept.where("doc_id >= 900").count() == 0


def test_no_labels_and_no_rows(spark):
    assert {r.lang_pred for r in L.languages(docs_of(spark, [(1, "abc", None), (2, "def", None)])).collect()} == {"und"}
    assert L.languages(docs_of(spark, [])).count() == 0


def test_language_stage_without_a_model_keeps_lettered_rows(spark):
    from corpus_pipeline import language_stage

    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    for lang, i in ((None, 1), ("aa", held)):
        docs = docs_of(spark, [(i, "abc def", lang), (200, None, None), (201, "", None), (202, "12 !!", None), (None, "é", None)])
        assert {r.text for r in language_stage(spark, docs, "").collect()} == {"abc def", "é"}


def test_grams_stay_inside_their_text():
    alone, _ = L.grams(pa.array(["Ab c"]))
    together, lettered = L.grams(pa.array(["xyz", "Ab c", None, "!!", "q"]))
    assert sorted(alone[0].tolist()) == sorted(together[1].tolist())
    assert lettered.tolist() == [True, True, False, False, True]
    upper, _ = L.grams(pa.array(["aB C"]))
    assert sorted(upper[0].tolist()) == sorted(alone[0].tolist())


def test_regularised_weights_are_sparse():
    rng = random.Random(1)
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(ALPHABETS))
        found, _ = L.grams(pa.array([text_in(lang, rng)]))
        rows.append((lang, *L.vector(found[0], np.ones(L.BUCKETS))))
    model = L.fit(rows)
    assert 0 < (model["weights"] != 0).mean() < 0.5


def quality_rows(n=600):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        t = text_in("aa", rng, rng.choice([10, 60, 200]))
        rows.append((i, " ".join(w.upper() + "!!" for w in t.split()) if bad else t, "en"))
        if rng.random() < 0.6:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels, [i for i, t, _ in rows if "!!" in t]


def test_quality_separates_held_out_rows(spark):
    rows, labels, bad = quality_rows()
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    # held-out labels are turned round: they must not be learned; labels may repeat or be null
    given = [(i, 1 - q if i in held else q, t) for i, q, t in labels] + labels[:5] + [(1, None, 0), (None, 1, 0)]
    extra = [(900, None, "en"), (901, "", "en"), (2, rows[2][1], "en"), (None, rows[3][1], "en")]
    docs = docs_of(spark, rows + extra)
    found = Q.quality_scores(docs, spark.createDataFrame(given, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == len(rows) + len(extra)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (1 if r.score >= 0.3 else 0)
        if r.doc_id is not None and r.doc_id < 900:
            assert r.predicted == (0 if r.doc_id in bad else 1) and r.held_out == (r.doc_id in held)


def test_quality_stage_drops_bad_rows_only(spark):
    rows, labels, bad = quality_rows()
    docs = docs_of(spark, rows)
    kept = Q.good(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _, _ in rows} - set(bad))


def test_quality_without_labels_keeps_everything(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.good(docs_of(spark, corpus(20)), none).count() == 20
    assert Q.quality_scores(docs_of(spark, []), none).count() == 0


def test_features_of_odd_texts():
    x = Q.features(pa.array([None, "", " ", "a", "ÉÉ\n\n" * 50, "x" * 200_000]))
    assert x.shape == (6, Q.N_FEATURES) and np.isfinite(x).all() and not x[:2].any()
    assert np.allclose(Q.features(pa.array(["zz!", "a b, a"]))[1], Q.features(pa.array(["a b, a"]))[0])


def blurred(n, share, rng):
    """Rows of statistics whose classes overlap, and their labels, with ``share`` of positives."""
    label = (rng.random(n) < share).astype(int)
    x = rng.standard_normal((n, Q.N_FEATURES)) * 0.5
    x[:, 0] += 2 * label
    return x.astype(np.float32), label


@pytest.mark.parametrize("share", [0.3, 0.6, 0.86])
def test_class_prior_comes_from_positives_and_unlabelled_rows(share):
    rng = np.random.default_rng(5)
    x, label = blurred(8000, share, rng)
    found = Q.class_prior(x[label == 1][: int(1500 * share + 500)].astype(float), x.astype(float))
    assert abs(found - share) < 0.06


def test_quality_needs_no_negative_labels(spark):
    rows, labels, bad = quality_rows()
    docs = docs_of(spark, rows)
    shape = "doc_id long, quality int, toxic int"
    given = {}
    for name, some in (("all", labels), ("positives", [x for x in labels if x[1] == 1])):
        found = Q.quality_scores(docs, spark.createDataFrame(some, shape)).collect()
        given[name] = {r.doc_id: r.score for r in found}
        assert all(r.predicted == (0 if r.doc_id in bad else 1) for r in found)
    assert given["all"] == given["positives"]


def test_quality_scores_do_not_depend_on_the_sample_size(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x, label = blurred(10_000, 0.86, rng)
    rows = [(i, int(h), x[i].tobytes()) for i, h in enumerate(rng.integers(-(1 << 63), 1 << 63, len(x)))]
    stats = spark.createDataFrame(rows, "doc_id long, h long, stats binary")
    labels = spark.createDataFrame([(i, int(q)) for i, q in enumerate(label)], "doc_id long, quality int")

    def scores():
        return Q.probability(Q.learn(stats, labels, Q.F.lit(True)), x.astype(np.float64))

    whole = scores()
    monkeypatch.setattr(Q, "SAMPLE", 3000)
    part = scores()
    # the scaling makes the mean score the estimated share of positives
    assert abs(whole.mean() - label.mean()) < 0.03
    assert abs(part.mean() - label.mean()) < 0.05
    assert ((part >= Q.THRESHOLD) == (whole >= Q.THRESHOLD)).mean() > 0.95


def test_language_scores_do_not_depend_on_the_sample_size():
    rng = random.Random(6)
    rows = []
    for _ in range(3000):
        # single letters shared by both languages: the text tells little, so the share of the language decides
        lang = "aa" if rng.random() < 0.9 else "bb"
        found, _ = L.grams(pa.array([" ".join(rng.choice("abcd" if lang == "aa" else "bcde") for _ in range(3))]))
        rows.append((lang, *L.vector(found[0], np.ones(L.BUCKETS))))
    rare = [r for r in rows if r[0] == "bb"]
    common = [r for r in rows if r[0] == "aa"]
    taken = common[: len(rare)] + rare
    rng.shuffle(taken)

    def mean_score(model):
        total = 0.0
        for _, at, value in rows:
            s = (value @ model["weights"][at] + 0.1 * model["weights"][L.BUCKETS]) / model["temperature"] + model["prior"]
            p = np.exp(s - s.max())
            total += p[model["names"].index("aa")] / p.sum()
        return total / len(rows)

    assert abs(mean_score(L.fit(rows)) - 0.9) < 0.03
    assert abs(mean_score(L.fit(taken, {"aa": len(rare) / len(common), "bb": 1.0})) - 0.9) < 0.05
