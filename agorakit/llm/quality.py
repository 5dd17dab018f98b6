"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all the fit needs: a small network over text
statistics minimises the non-negative unbiased risk ``prior * R+(positives) + max(0, R-(unlabelled) - prior *
R-(positives))``. The class prior and a last scaling of the scores to probabilities come from the same rows;
negative labels are not used.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agorakit.llm.kernels import Words, column, lower_ascii, slices, utf8, with_text
from agorakit.llm.language import held_out
from agorakit.session import materialize

SAMPLE = 20_000  # positives and unlabelled rows, each, that the prior, the fit and the scaling see at most, about
STEPS = 600
BATCH = 1024
HIDDEN = 16
RATE = 0.01
THRESHOLD = 0.3
PENALTY = 0.5  # on the slope and offset of standardised scores, over the root of the number of positives

# Byte groups: what a text is made of.
_GROUPS = ["lower", "upper", "digit", "space", "line", ".", ",", "!", "|", "#$%&*", "?;:", "other", "high", "rest"]


def _byte_groups() -> np.ndarray:
    group = np.full(256, _GROUPS.index("other"), np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 192:
            group[b] = _GROUPS.index("high")
        elif b >= 128 or b < 9:
            group[b] = _GROUPS.index("rest")
        elif "a" <= c <= "z":
            group[b] = _GROUPS.index("lower")
        elif "A" <= c <= "Z":
            group[b] = _GROUPS.index("upper")
        elif "0" <= c <= "9":
            group[b] = _GROUPS.index("digit")
        elif c in "\n\r":
            group[b] = _GROUPS.index("line")
        elif c in " \t\x0b\x0c":
            group[b] = _GROUPS.index("space")
        else:
            for i, name in enumerate(_GROUPS):
                if len(name) <= 5 and not name.isalpha() and c in name:
                    group[b] = i
    return group


N_FEATURES = len(_GROUPS) + 11


def features(texts: pa.Array) -> np.ndarray:
    """Rows of N_FEATURES statistics of whole texts; null reads as empty, and empty texts are all 0."""
    groups = _byte_groups()
    data, offsets = utf8(texts)
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES), np.float64)
    if not len(data):
        return out
    k = len(_GROUPS)
    size = np.diff(offsets)
    of = groups[data]
    owner = np.repeat(np.arange(n) * k, size)
    counts = np.bincount(owner + of, minlength=n * k).reshape(n, k)
    chars = np.maximum(counts.sum(axis=1) - counts[:, _GROUPS.index("rest")], 1)
    out[:, :k] = counts / chars[:, None]
    # words end with what, repeat how much
    plain = data.copy()
    words = Words(lower_ascii(data), offsets, ~((data == 32) | ((data >= 9) & (data <= 13))))
    first = words.first
    number = np.diff(first)
    last = groups[plain[words.starts + words.lengths - 1]] if len(words.starts) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(n), number)
    share = lambda mask: np.bincount(doc[mask], minlength=n) / np.maximum(number, 1)
    out[:, k] = share(np.isin(last, [_GROUPS.index(g) for g in ("!", "|", "#$%&*", "other")]))
    out[:, k + 1] = share(np.isin(last, [_GROUPS.index(g) for g in (".", ",", "?;:")]))
    same = np.zeros(len(doc), bool)
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (doc[1:] == doc[:-1])
    out[:, k + 2] = share(same)
    out[:, k + 3] = np.bincount(doc, weights=words.lengths, minlength=n) / np.maximum(number, 1) / 10
    for i in np.flatnonzero(number):
        _, times = np.unique(words.codes[first[i] : first[i + 1]], return_counts=True)
        out[i, k + 4] = len(times) / number[i]
        out[i, k + 5] = times.max() / number[i]
    out[:, k + 6] = np.log1p(size) / 10
    out[:, k + 7] = np.log1p(number) / 10
    out[:, k + 8] = np.log1p(number / (counts[:, _GROUPS.index("line")] + 1)) / 5
    out[:, k + 9] = share(words.lengths == 1) if len(doc) else 0
    out[:, k + 10] = share(words.lengths > 20) if len(doc) else 0
    return out


def _forward(net: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(((x - net["mean"]) / net["spread"]) @ net["w1"] + net["b1"])
    return hidden, hidden @ net["w2"] + net["b2"]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 3) -> dict:
    """The network that minimises the non-negative risk with logistic loss, by Adam on balanced batches.

    Where the estimated risk of negatives falls below zero, it counts as zero: the step is that of the positives.
    """
    rng = np.random.default_rng(seed)
    net = {
        "mean": unlabelled.mean(axis=0), "spread": unlabelled.std(axis=0) + 1e-3,
        "w1": rng.standard_normal((N_FEATURES, HIDDEN)) * 0.3, "b1": np.zeros(HIDDEN),
        "w2": rng.standard_normal(HIDDEN) * 0.3, "b2": 0.0,
    }
    names = ("w1", "b1", "w2", "b2")
    m = {k: np.zeros_like(net[k]) for k in names}
    v = {k: np.zeros_like(net[k]) for k in names}
    sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))
    for step in range(1, STEPS + 1):
        p = positive[rng.integers(0, len(positive), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        x = np.r_[p, u]
        hidden, score = _forward(net, x)
        sp, su = score[:BATCH], score[BATCH:]
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        g = np.zeros(len(x))
        if negative >= 0:
            g[:BATCH] = prior * (sigmoid(sp) - 1) / BATCH - prior * sigmoid(sp) / BATCH
            g[BATCH:] = sigmoid(su) / BATCH
        else:
            g[:BATCH] = prior * (sigmoid(sp) - 1) / BATCH
        back = g[:, None] * net["w2"][None, :] * (1 - hidden**2)
        scaled = (x - net["mean"]) / net["spread"]
        grad = {"w2": hidden.T @ g, "b2": g.sum(), "w1": scaled.T @ back, "b1": back.sum(axis=0)}
        for k in names:
            d = grad[k] + 1e-4 * net[k]
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.999 * v[k] + 0.001 * d * d
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            net[k] = net[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows, from positives and unlabelled rows only: the median of three splits.

    A network is fitted to tell the one half of the positives from the one half of the unlabelled rows. On the other
    halves, for each threshold, the share of unlabelled rows above it is at least the prior times the share of
    positives above it, since positives are among them; so the least ratio, with a margin of
    error on both shares, bounds the prior, and comes near it where hardly any negative scores that high.
    Classes that overlap everywhere make it too large. With fewer than four rows of a kind it is one half.
    """
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    return float(np.median([_prior_of_split(positive, unlabelled, seed) for seed in range(3)]))


def _prior_of_split(positive: np.ndarray, unlabelled: np.ndarray, seed: int) -> float:
    rng = np.random.default_rng(seed)
    p, u = positive[rng.permutation(len(positive))], unlabelled[rng.permutation(len(unlabelled))]
    margin = math.sqrt(math.log(20) / 2) * (1 / math.sqrt(len(p[1::2])) + 1 / math.sqrt(len(u[1::2])))
    found = 1.0
    # a network for each prior found so far: all ratios are bounds, a network nearer to the truth gives a closer one
    for assumed in (0.5, None, None):
        net = fit(p[::2], u[::2], min(max(found if assumed is None else assumed, 0.02), 0.98), seed)
        sp, su = np.sort(_forward(net, p[1::2])[1]), np.sort(_forward(net, u[1::2])[1])
        at = sp[: max(1, int(0.9 * len(sp)))]  # at least a tenth of the positives lies above
        ap, au = (1 - np.searchsorted(x, at, "left") / len(x) for x in (sp, su))
        best = int(np.argmin((au + margin) / ap))
        found = min(found, au[best] / ap[best])
    return float(min(max(found, 0.02), 0.98))


def scaled(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset that make scores log-odds, from positives, unlabelled rows and the prior.

    They minimise the unbiased risk of the logistic loss, which for that loss is convex: the mean of
    softplus over unlabelled rows less the prior times the mean score of positives (Newton steps). A penalty on
    standardised scores keeps the slope moderate, so that a small error of the prior moves all scores a little
    and not some across the threshold.
    """
    middle, spread = unlabelled.mean(), unlabelled.std() + 1e-12
    x = np.stack([(unlabelled - middle) / spread, np.ones(len(unlabelled))], axis=1)
    mean = prior * np.array([(positive.mean() - middle) / spread, 1.0])
    w = np.array([1.0, 0.0])
    small = PENALTY / math.sqrt(len(positive))  # as the error of the prior

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, x @ w).mean() - mean @ w) + small / 2 * float((w - [1.0, 0.0]) @ (w - [1.0, 0.0]))

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + small * np.eye(2)
        step = np.linalg.solve(h, x.T @ p / len(x) - mean + small * (w - [1.0, 0.0]))
        # a step that overshoots is halved
        size = next((k for k in 0.5 ** np.arange(30) if loss(w - k * step) < loss(w)), 0.0)
        w = w - size * step
        if not size:
            break
    slope = max(w[0], 1e-3) / spread
    return float(slope), float(w[1] - slope * middle)


def probability(net: dict, x: np.ndarray) -> np.ndarray:
    slope, offset = net["scale"]
    return 1 / (1 + np.exp(-np.clip(slope * _forward(net, x)[1] + offset, -30, 30)))


def learn(stats: DataFrame, labels: DataFrame, usable: Column) -> dict | None:
    """The model from ``stats`` (doc_id, h, stats) and ``labels`` (doc_id, quality), rows with ``usable`` only.

    Several labels of one doc_id count as their mean, 1 from one half up. Labels of null ids are ignored. Only
    trusted positives and unlabelled rows are used; rows labelled 0 are unlabelled rows to the fit, to the class
    prior and to the scaling. None if there is no positive row.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id")
    own = own.agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    rows = materialize(stats.where(usable).join(own, "doc_id", "left").select("h", "stats", "quality"), "stats")
    count = rows.agg(F.count_if(F.col("quality") == 1), F.count("*")).first()
    positives, every = (x or 0 for x in count)
    if not positives:
        return None
    limit = lambda n: F.lit(min(int(SAMPLE / max(n, SAMPLE) * 2.0**63), 2**63 - 1))
    h = F.shiftrightunsigned("h", 1)
    part = lambda kind, mask, n: rows.where(mask & (h <= limit(n))).orderBy("h").limit(2 * SAMPLE).select(F.lit(kind).alias("kind"), "stats", "h")
    picked = part("p", F.col("quality") == 1, positives).unionByName(part("u", F.lit(True), every))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[str] = []
        x = []
        for batch in batches:
            kinds += batch.column(0).to_pylist()
            x += [np.frombuffer(b, np.float32) for b in batch.column(1).to_pylist()]
        if not kinds:
            return
        x, kinds = np.array(x, np.float64), np.array(kinds)
        p, u = x[kinds == "p"], x[kinds == "u"]
        prior = class_prior(p, u)
        net = fit(p, u, prior)
        net["prior"] = prior
        net["scale"] = scaled(_forward(net, p)[1], _forward(net, u)[1], prior)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], names=["model"])

    found = picked.repartition(1).sortWithinPartitions("kind", "h", "stats").drop("h").mapInArrow(train, "model binary").first()
    return pickle.loads(bytes(found[0]))


def _stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``_row`` (struct of ``keep``) and the packed statistics of the text."""
    struct = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    frame = docs.select(struct) if "text" in keep else docs.select(struct, F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(with_text(batches), "_text", 1 << 20):
            x = features(column(part, "_text")).astype(np.float32)
            yield pa.RecordBatch.from_arrays([column(part, "_row"), pa.array([r.tobytes() for r in x], pa.binary())], names=["_row", "stats"])

    return frame.mapInArrow(run, T.StructType([frame.schema["_row"], T.StructField("stats", T.BinaryType())]))


def _score(frame: DataFrame, model: dict | None) -> DataFrame:
    """``_row`` and its score; without a model all scores are 1."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(column(batch, "stats").to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(np.float64)
            score = probability(shared.value, x) if shared.value and len(x) else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([column(batch, "_row"), pa.array(score)], names=["_row", "score"])

    return frame.mapInArrow(run, T.StructType([frame.schema["_row"], T.StructField("score", T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; predicted is 1 from a score of 0.3 up.

    Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0; a null doc_id is
    not held out. Null and empty texts are scored as texts whose statistics are all 0. Repeated
    rows each get a row; extra columns are ignored.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    stats = materialize(_stats(keyed, ["doc_id", "h"]).select("_row", "_row.doc_id", "_row.h", "stats"), "stats")
    out = held_out(F.col("doc_id"), 5, 0)
    found = _score(stats.select("_row", "stats"), learn(stats, labels, ~out)).select("_row.doc_id", "score")
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not rejected: a score of at least 0.3. All are kept if no label can be learned from."""
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    stats = _stats(keyed, ["doc_id", "h"]).select("_row.doc_id", "_row.h", "stats")
    model = learn(stats, labels, ~held_out(F.col("doc_id"), 5, 0))
    kept = _score(_stats(docs, docs.columns), model).where(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
