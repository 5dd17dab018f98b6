"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all learning rows in one pass, which also
collects a bounded sample for the fit: about ``SAMPLE`` documents of each language, picked by a hash of id and text.
The weights are learned by follow-the-regularised-leader with elastic-net
penalties, so most are zero; a temperature fitted on a part of the sample kept out of
the fit calibrates the scores. The model's size depends on the number of languages only.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agorakit.llm import arrays
from agorakit.llm.kernels import column, once, slices, utf8, with_text
from agorakit.llm.tokens import LETTER, _classes
from agorakit.session import materialize

BUCKETS = 1 << 15
GRAM_BYTES = 1 << 20  # bytes of text whose n-grams are held at a time, at least one text
SAMPLE = 2000  # learning documents of each language, about
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.01
UNKNOWN = "und"


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _lower() -> np.ndarray:
    table = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        if 0xD800 <= i < 0xE000:
            continue
        low = chr(i).lower()
        if len(low) == 1:
            table[i] = ord(low)
    return table


def grams(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket of every 1-, 2- and 3-gram of each text, and whether it has a letter.

    Letters are lower-cased; whatever lies between them is one separator.
    """
    data, offsets = utf8(texts)
    n = len(offsets) - 1
    if not len(data):
        return [np.zeros(0, np.int32)] * n, np.zeros(n, bool)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    letter = once("code point classes", _classes)[points] == LETTER
    codes = np.where(letter, once("lower case", _lower)[points], 0).astype(np.uint64)
    docs = np.searchsorted(place, offsets)
    keep = letter | np.r_[True, letter[:-1]]
    keep[docs[:-1][docs[:-1] < len(keep)]] = True
    kept = np.r_[0, np.cumsum(keep)]
    codes, ends = codes[keep], kept[docs]
    seen = np.r_[0, np.cumsum(letter)][docs]

    def bucket(order: int) -> np.ndarray:
        h = np.full(max(len(codes) - order + 1, 0), order, np.uint64)
        for j in range(order):
            h = (h ^ codes[j : j + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int32)

    one, two, three = (bucket(k) for k in (1, 2, 3))
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        out.append(np.concatenate([one[a:b], two[a : max(b - 1, a)], three[a : max(b - 2, a)]]))
    return out, seen[1:] > seen[:-1]


def vector(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of one text: log counts times inverse document frequencies, scaled to length 1."""
    counts = np.bincount(found, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at]) * idf[at]
    return at, value / max(float(np.sqrt(value @ value)), 1e-12)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], rates: dict[str, float] | None = None, seed: int = 1) -> dict:
    """Weights (buckets x languages), bias, languages, prior and temperature from (language, buckets, values) rows.

    ``rates`` has the rate at which each language's rows were sampled; without it the rows are all. The prior takes the
    log of the rate from a language's scores, after the temperature, so that a language sampled at a low rate
    is not taken for a rare one; the temperature weighs rows by one over the rate.

    Every fifth row is kept for the temperature. Follow-the-regularised-leader keeps a
    weight at zero while the sum of its gradients stays below ``L1``.
    """
    names = sorted({r[0] for r in rows})
    code = {x: i for i, x in enumerate(names)}
    learn = [r for i, r in enumerate(rows) if i % 5 or len(rows) < 50]
    check = [r for i, r in enumerate(rows) if i % 5 == 0]
    z, n = np.zeros((BUCKETS + 1, len(names))), np.zeros((BUCKETS + 1, len(names)))

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) <= L1, 0.0, -(own - np.sign(own) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(learn)):
            name, at, value = learn[i]
            at, value = np.r_[at, BUCKETS], np.r_[value, 0.1]
            w = weights(at)
            score = value @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[code[name]] -= 1
            g = value[:, None] * p[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(BUCKETS + 1)).astype(np.float32)

    scores = np.array([value @ w[at] + 0.1 * w[BUCKETS] for _, at, value in check])
    truth = np.array([code[name] for name, _, _ in check])
    each = np.array([1 / rates[name] if rates else 1.0 for name in names])
    prior = np.log(each)

    def loss(t: float) -> float:
        s = scores / t + prior
        top = s.max(axis=1, keepdims=True)
        return float(np.average(np.log(np.exp(s - top).sum(axis=1)) + top[:, 0] - s[np.arange(len(s)), truth], weights=each[truth]))

    grid = [2.0 ** (k / 4) for k in range(-16, 17)]
    return {"names": names, "weights": w, "prior": prior, "temperature": min(grid, key=loss) if len(check) else 1.0}


def learn(docs: DataFrame, usable: Column, sample: int = SAMPLE) -> dict | None:
    """The model from the rows of ``docs`` (doc_id, text, lang) for which ``usable`` holds and lang is not null.

    None if there are no such rows with a letter.
    """
    spark = docs.sparkSession
    rows = docs.where(usable & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    limits = {k: min(1.0, sample / n) for k, n in counts.items()}
    schema = pa.schema([("counts", pa.binary()), ("h", pa.int64()), ("lang", pa.string()), ("at", pa.binary()), ("times", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for part in slices(batches, limit=GRAM_BYTES):
            found, lettered = grams(column(part, "text"))
            langs, h = column(part, "lang").to_pylist(), column(part, "h").to_numpy()
            out = []
            for i in np.flatnonzero(lettered):
                c = np.bincount(found[i], minlength=BUCKETS)
                at = np.flatnonzero(c)
                total[at] += 1
                total[BUCKETS] += 1
                if (int(h[i]) + (1 << 63)) / 2.0**64 < limits[langs[i]]:
                    out.append((int(h[i]), langs[i], at.astype(np.uint16).tobytes(), c[at].astype(np.uint32).tobytes()))
            if out:
                h, lang, at, times = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(h), pa.binary()), pa.array(h, pa.int64()), pa.array(lang), pa.array(at, pa.binary()), pa.array(times, pa.binary())], schema=schema
                )
        nothing = [pa.nulls(1, schema.field(k).type) for k in range(1, 5)]
        yield pa.RecordBatch.from_arrays([pa.array([arrays.packed(total)], pa.binary()), *nothing], schema=schema)

    hashed = rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    found = materialize(hashed.mapInArrow(run, "counts binary, h long, lang string, at binary, times binary"), "grams")
    df = arrays.added(found, np.int64)
    if df is None or not df[BUCKETS]:
        return None
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for lang, at, times in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)]):
                where = np.frombuffer(at, np.uint16).astype(np.int64)
                value = np.log1p(np.frombuffer(times, np.uint32)) * idf[where]
                rows.append((lang, where, value / max(float(np.sqrt(value @ value)), 1e-12)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows, limits))], pa.binary())], names=["model"])

    # equal rows have equal hashes; the bound holds even where a language has more rows under its limit
    bound = 2 * sample * len(counts)
    picked = found.where("h is not null").dropDuplicates(["h"]).orderBy("h").limit(bound)
    model = picked.select("h", "lang", "at", "times").repartition(1).sortWithinPartitions("h").mapInArrow(train, "model binary").first()
    return None if model is None else {**pickle.loads(bytes(model[0])), "idf": idf}


def identify(docs: DataFrame, model: dict | None, keep: list[str]) -> DataFrame:
    """One row per row of ``docs``: ``_row`` (struct of the columns ``keep``), lang_pred, score, lettered.

    Whole texts are read. A null text, or one without letters, is ``und`` with score 0; so is every text if there is no model.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    struct = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    frame = docs.select(struct) if "text" in keep else docs.select(struct, F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in slices(with_text(batches), "_text", GRAM_BYTES):
            found, lettered = grams(column(part, "_text"))
            langs, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            for i in np.flatnonzero(lettered) if own else []:
                at, value = vector(found[i], own["idf"])
                s = (value @ own["weights"][at] + 0.1 * own["weights"][BUCKETS]) / own["temperature"] + own["prior"]
                best = int(np.argmax(s))
                langs[i], scores[i] = own["names"][best], 1 / float(np.exp(s - s[best]).sum())
            yield pa.RecordBatch.from_arrays([column(part, "_row"), pa.array(langs, pa.string()), pa.array(scores), pa.array(lettered)], names=["_row", "lang_pred", "score", "lettered"])

    fields = [frame.schema["_row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lettered", T.BooleanType())]
    return frame.mapInArrow(run, T.StructType(fields))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document (see ``identify``).

    Learned from text and non-null lang of rows whose crc32(doc_id as text) mod 4 is not 2. A null doc_id is
    not held out. Repeated rows each get a row; extra columns are ignored.
    """
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    out = held_out(F.col("doc_id"), 4, 2)
    found = identify(plain, learn(plain, ~out), ["doc_id"])
    return found.select("_row.doc_id", "lang_pred", "score").select("doc_id", out.alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose language is recognised: not ``und``, and with a score of at least ``least``.

    If no language can be learned from, all texts with a letter are kept.
    """
    named = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = learn(named, ~held_out(F.col("doc_id"), 4, 2))
    kept = identify(docs, model, docs.columns).where(F.col("lettered"))
    if model:
        kept = kept.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
