"""Benchmark decontamination with an FM-index per training shard.

A shard is a few MB of whole documents. Its words become numbers, its suffixes are
sorted, and the Burrows-Wheeler transform is kept in a wavelet matrix. Test
phrases (windows of the benchmark items) are found by backward search, all phrases
of a block at once, located through sampled suffix positions, and merged into
spans of words to remove. Nothing is shuffled: a document lies in one shard, and
shards are whatever part of the table a task reads.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agorakit.llm.kernels import alnum_words, column, slices, with_text
from agorakit.session import materialize

WINDOW = 13
SHARD_BYTES = 3 << 20
SAMPLE = 4  # every fourth text place keeps its suffix position
BLOCK_WORDS = 1 << 17  # benchmark words sent to the tasks at a time, at most
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


class RankBits:
    """A bit vector with rank in constant time."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.zeros = n - int(self.before[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before place i."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class Wavelet:
    """Wavelet matrix of a sequence of codes below ``2 ** depth``."""

    def __init__(self, codes: np.ndarray, depth: int):
        self.depth = depth
        self.levels = []
        for level in range(depth - 1, -1, -1):
            bits = ((codes >> level) & 1).astype(bool)
            self.levels.append(RankBits(bits))
            codes = np.concatenate([codes[~bits], codes[bits]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of code c before place i."""
        start = np.zeros_like(i)
        for k, level in enumerate(self.levels):
            one = ((c >> (self.depth - 1 - k)) & 1).astype(bool)
            ri, rs = level.ones(i), level.ones(start)
            i = np.where(one, level.zeros + ri, i - ri)
            start = np.where(one, level.zeros + rs, start - rs)
        return i - start

    def at(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for level in self.levels:
            one = level.at(i)
            r = level.ones(i)
            out = (out << 1) | one
            i = np.where(one, level.zeros + r, i - r)
        return out


def suffix_order(text: np.ndarray, width: int) -> np.ndarray:
    """Places of ``text`` (codes below ``2 ** width``, the last one 0 and unique as an end) in the order of their suffixes.

    The first sort packs as many codes as fit in 62 bits; after that only places still
    tied are sorted again, by doubled prefixes.
    """
    n = len(text)
    take = max(1, 62 // width)
    padded = np.concatenate([text, np.zeros(take, text.dtype)])
    key = np.zeros(n, np.int64)
    for j in range(take):
        key = (key << width) | padded[j : j + n]
    order = np.argsort(key)
    fresh = np.r_[True, key[order[1:]] != key[order[:-1]]]
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    tied = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))
    reach = take
    while len(tied):
        places = order[tied]
        beyond = places + reach
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)], -1)
        group = rank[places]
        by = np.lexsort((second, group))
        places, second, group = places[by], second[by], group[by]
        order[tied] = places
        fresh = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        rank[places] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
        tied = tied[~(fresh & np.r_[fresh[1:], True])]
        reach *= 2
    return order


class FMIndex:
    """FM-index of documents given as runs of word codes (2 and up; 1 ends a document, one 0 ends the text).

    The end must be a code of its own: the walk back from one document to the one before passes
    its 1, and only codes whose suffixes are all in the order of what follows them can be walked through.
    """

    def __init__(self, text: np.ndarray, n_codes: int):
        self.width = max(1, int(n_codes).bit_length())
        order = suffix_order(text, self.width)
        before = text[order - 1]
        self.wavelet = Wavelet(before, self.width)
        self.first = np.zeros(n_codes + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=n_codes + 1), out=self.first[1:])
        kept = order % SAMPLE == 0
        self.sampled = RankBits(kept)
        self.positions = order[kept]
        self.n = len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases: rows of word codes, filled to the right; -1 is a word that the shard lacks."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        known = np.array([(row[:m] > 0).all() for row, m in zip(phrases, lengths)], bool) if len(phrases) else np.zeros(0, bool)
        high[~known] = 0
        alive = np.flatnonzero(known & (lengths > 0))
        for step in range(phrases.shape[1]):
            alive = alive[(lengths[alive] > step) & (high[alive] > low[alive])]
            if not len(alive):
                break
            c = phrases[alive, lengths[alive] - 1 - step]
            low[alive] = self.first[c] + self.wavelet.rank(c, low[alive])
            high[alive] = self.first[c] + self.wavelet.rank(c, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows: walk back to a sampled one."""
        out = np.zeros(len(rows), np.int64)
        at, walked, left = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(left):
            found = self.sampled.at(at)
            out[left[found]] = self.positions[self.sampled.ones(at[found])] + walked[found]
            at, walked, left = at[~found], walked[~found] + 1, left[~found]
            if len(left):
                c = self.wavelet.at(at)
                at = self.first[c] + self.wavelet.rank(c, at)
        return out


class Phrases:
    """Distinct benchmark windows of one block."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        words = alnum_words(pa.array([t for _, t in items], pa.string()))
        self.vocabulary = pa.array(words.vocabulary, pa.large_binary())
        owners: dict[tuple[int, ...], set[str]] = {}
        codes = words.codes.tolist()
        for (name, _), a, b in zip(items, words.first[:-1], words.first[1:]):
            for k in range(a, max(b - window, a) + 1 if b > a else a):
                owners.setdefault(tuple(codes[k : min(k + window, b)]), set()).add(name)
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.codes = np.full((len(owners), window), -1, np.int64)
        for i, p in enumerate(owners):
            self.codes[i, : len(p)] = p
        self.items = [sorted(x) for x in owners.values()]


def _scan(part: pa.RecordBatch, phrases: Phrases) -> list[pa.Array]:
    """n_words, spans and items of every document of one shard."""
    # equal texts are indexed once
    coded = pc.fill_null(column(part, "_text"), "").dictionary_encode()
    rows = coded.indices.to_numpy()
    words = alnum_words(coded.dictionary.cast(pa.string()))
    n_docs = len(words.first) - 1
    counts = np.diff(words.first)
    starts = words.first[:-1] + np.arange(n_docs)
    text = np.ones(len(words.codes) + n_docs + 1, np.int64)
    text[-1] = 0
    inside = np.ones(len(text), bool)
    inside[starts + counts] = False
    inside[-1] = False
    text[inside] = words.codes.astype(np.int64) + 2
    spans: list[list[dict[str, int]]] = [[] for _ in range(n_docs)]
    items: list[list[str]] = [[] for _ in range(n_docs)]
    if "spans" in part.schema.names:
        _, at = np.unique(rows, return_index=True)
        spans = column(part, "spans").take(pa.array(at)).to_pylist()
        items = column(part, "items").take(pa.array(at)).to_pylist()
    vocabulary = pa.array(words.vocabulary, pa.large_binary())
    here = pc.fill_null(pc.add(pc.index_in(phrases.vocabulary, vocabulary).cast(pa.int64()), 2), -1).to_numpy(zero_copy_only=False)
    if len(phrases.lengths) and len(words.codes):
        asked = np.where(phrases.codes >= 0, here[phrases.codes], -1)
        possible = np.flatnonzero(((asked > 0) | (phrases.codes < 0)).all(axis=1))
        if len(possible):
            index = FMIndex(text, len(words.vocabulary) + 1)
            low, high = index.search(asked[possible], phrases.lengths[possible])
            found = np.flatnonzero(high > low)
            times = (high - low)[found]
            which = np.repeat(possible[found], times)
            base = np.repeat(np.cumsum(times) - times, times)
            places = index.locate(np.repeat(low[found], times) + np.arange(len(which)) - base)
            delta = np.zeros(len(text) + 1, np.int64)
            np.add.at(delta, places, 1)
            np.add.at(delta, places + phrases.lengths[which], -1)
            for doc, own in enumerate(spans):
                for x in own:
                    delta[starts[doc] + x["start"]] += 1
                    delta[starts[doc] + x["end"]] -= 1
            spans = [[] for _ in range(n_docs)]
            hit = np.cumsum(delta[:-1]) > 0
            edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
            for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)):
                doc = int(np.searchsorted(starts, a, side="right")) - 1
                spans[doc].append({"start": int(a - starts[doc]), "end": int(b - starts[doc])})
            owner = np.searchsorted(starts, places, side="right") - 1
            named: dict[int, set[str]] = {}
            for doc, phrase in {(int(d), int(w)) for d, w in zip(owner, which)}:
                named.setdefault(doc, set()).update(phrases.items[phrase])
            for doc, names in named.items():
                items[doc] = sorted(names.union(items[doc]))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return [
        pa.array(counts[rows], pa.int64()),
        pa.array(spans, kind).take(pa.array(rows)),
        pa.array(items, pa.list_(pa.string())).take(pa.array(rows)),
    ]


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _pieces(text: str, limit: int, window: int) -> Iterator[tuple[str, int]]:
    """(piece, words) of an item; one of more than ``limit`` words is cut so that every window lies whole in a piece."""
    ends = [m.span() for m in _WORD.finditer(text)]
    if len(ends) <= limit:
        yield text, len(ends)
        return
    for a in range(0, len(ends) - window + 1, limit - window + 1):
        own = ends[a : a + limit]
        yield text[own[0][0] : own[-1][1]], len(own)


def _blocks(benchmark: DataFrame, limit: int, window: int = WINDOW) -> Iterator[list[tuple[str, str]]]:
    """Benchmark items, long ones in pieces, in blocks of at most ``limit`` words (one window at least); the driver holds one block and the next."""
    limit = max(limit, window)
    own, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t"))
    for row in rows.where("i is not null and t is not null").toLocalIterator():
        for piece, words in _pieces(row.t, limit, window):
            if own and size + words > limit:
                yield own
                own, size = [], 0
            if words:
                own.append((row.i, piece))
                size += words
    if own:
        yield own


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: ``_row`` (struct of the columns ``keep``), n_words, spans, items.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. ``spans`` are the merged word
    ranges [start, end) covered by occurrences of ``window`` consecutive words of a benchmark item (all words
    of a shorter one); ``items`` are the distinct ids of those items. Null and empty texts have no words;
    items without words, or with a null id, find nothing. Repeated rows each get a row.

    The benchmark goes to the tasks in blocks of at most ``block_words`` words, long items cut with an overlap, so what is
    broadcast is bounded; with several blocks each pass is written to the shared folder and the next adds to it.
    """
    struct = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    # a text that is carried anyway is not sent twice
    inside = "text" in keep
    frame = docs.select(struct) if inside else docs.select(struct, F.col("text").cast("string").alias("_text"))
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, block_words, window)
    block, after = next(blocks, []), next(blocks, None)
    while True:
        shared = context.broadcast(Phrases(block, window))
        last = after is None

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for part in slices(with_text(batches), "_text", SHARD_BYTES):
                carried = ["_row"] if last or inside else ["_row", "_text"]
                columns = [column(part, c) for c in carried] + _scan(part, shared.value)
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, "n_words", "spans", "items"])

        fields = [f for f in frame.schema.fields if f.name == "_row" or (f.name == "_text" and not last)]
        found = frame.mapInArrow(run, T.StructType([*fields, *FOUND.fields]))
        if last:
            return found
        frame = materialize(found, "scan")
        shared.unpersist()
        block, after = after, next(blocks, None)


def verdict(n_words: Column, spans: Column) -> tuple[Column, Column]:
    """(n_hit, contaminated): at least one word in twenty is inside an occurrence."""
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return n_hit, (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (see ``scan``)."""
    n_hit, bad = verdict(F.col("n_words"), F.col("spans"))
    return scan(docs, benchmark, ["doc_id"]).select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        bad.alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows; all columns as they are."""
    _, bad = verdict(F.col("n_words"), F.col("spans"))
    kept = scan(docs, benchmark, docs.columns).where(~bad)
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
