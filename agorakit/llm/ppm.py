"""Language-model scoring by prediction by partial matching (PPM) over bytes.

The model is a byte-context trie: for every context of up to ``ORDER`` bytes, how often each byte followed it in the
learning texts. A byte is coded in its longest known context; if it never followed there, an escape is paid (method
D: a context seen T times with D different followers gives the escape D / 2T and a follower seen c times (2c - 1) / 2T) and
the next shorter context is asked, with the bytes of the longer one excluded from its counts. Below the empty context, the bytes that never occurred share
what is left. Text is lower-cased (A-Z) and ends with an end symbol, so the code lengths of a text add up to the log
probability of exactly this text.

Distribution. The code length of a byte depends on its last ``ORDER`` bytes and itself only (a gram), so each is computed once
per distinct gram, not once per place. Texts are dealt to slices of about ``SLICE`` bytes; each slice sends its distinct
grams and words, with their counts in learning texts, to the part of the trie that holds them; a part (all
contexts that end in the same two bytes) adds the counts up, builds its subtrees and sends every slice the lengths of the
slice's grams; the slices add them up by document. What is sent grows with the distinct grams of the slices.
Only the counts of the first two levels (256 x 256 numbers, whatever the data) are broadcast; no task holds the trie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from agorakit.llm import arrays
from agorakit.llm.kernels import lower_ascii, mix, slices, utf8
from agorakit.session import materialize, sweep

ORDER = 5  # bytes of context; grams of ORDER + 1 bytes fill 48 of 64 bits, 16 are left for a document's number
SLICE = 16 << 20  # bytes of text whose grams are made distinct together
BLOCK = 1 << 20  # places of a text handled at a time
CHUNK = 2 << 20  # bytes of text handled at a time, at least one document
DOCS = 1 << 16  # documents handled at a time
END, PAD = 0xFF, 0xFE  # neither occurs in UTF-8

_GATHERED = "slice int, part int, keys binary, counts binary, words array<binary>, n array<bigint>, first binary"
_SCORED = "slice int, keys binary, lengths binary, words array<binary>, n array<bigint>, distinct long"
_DOCS = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# --- grams --------------------------------------------------------------------------------------------------------


def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with ORDER pad bytes before and an end symbol behind every text, and where each of these begins."""
    n = len(offsets) - 1
    begin = offsets[:-1] + np.arange(n) * (ORDER + 1)
    out = np.full(len(data) + n * (ORDER + 1), PAD, np.uint8)
    for i in range(n):
        a = begin[i] + ORDER
        size = offsets[i + 1] - offsets[i]
        out[a : a + size] = data[offsets[i] : offsets[i + 1]]
        out[a + size] = END
    return out, begin


def gram_blocks(buffer: np.ndarray):
    """(places, keys) of at most BLOCK places each; a key holds the context, last byte first, and the byte itself."""
    for a in range(ORDER, len(buffer), BLOCK):
        b = min(a + BLOCK, len(buffer))
        wide = buffer[a - ORDER : b].astype(np.uint64)
        keys = wide[ORDER:].copy()
        for j in range(1, ORDER + 1):
            keys |= wide[ORDER - j : len(wide) - j] << np.uint64(8 * (ORDER + 1 - j))
        real = np.flatnonzero(buffer[a:b] != PAD)
        yield real + a, keys[real]


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with their summed counts."""
    if len(keys) == 0:
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


class Grams:
    """Distinct grams and counts, merged whenever what waits is as large as what is merged."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, learn: bool) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        self.waiting.append((keys, counts if learn else np.zeros(len(keys), np.int64)))
        self.size += len(keys)
        if self.size > max(BLOCK, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        both = [(self.keys, self.counts), *self.waiting]
        self.keys, self.counts = counted(np.concatenate([k for k, _ in both]), np.concatenate([c for _, c in both]))
        self.waiting, self.size = [], 0


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of the trie that holds a gram: by the last two bytes of its context."""
    return (mix((keys >> np.uint64(8 * (ORDER - 1))) + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def deltas(keys: np.ndarray) -> bytes:
    return arrays.packed(np.diff(keys, prepend=np.uint64(0)))


def undeltas(blob: bytes) -> np.ndarray:
    return np.cumsum(arrays.unpacked(blob, np.uint64), dtype=np.uint64)


# --- trie ---------------------------------------------------------------------------------------------------------


class Level:
    """Contexts of one length: ``ctx`` sorted, their total and number of different followers, and the (context, byte) pairs.

    ``rest`` and ``left`` are total and number of followers of the next shorter context without the bytes seen here.
    """

    def __init__(self, pair: np.ndarray, count: np.ndarray, below: Level | None):
        self.pair, self.count = pair, count
        owner = pair >> np.uint64(8)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(pair) else np.zeros(0, np.int64)
        self.ctx = owner[first]
        self.total = np.add.reduceat(count, first) if len(pair) else np.zeros(0, np.int64)
        self.distinct = np.diff(np.r_[first, len(pair)])
        if below is not None and len(pair):
            parent = np.searchsorted(below.ctx, self.ctx >> np.uint64(8))
            same = np.searchsorted(below.pair, (pair >> np.uint64(16) << np.uint64(8)) | (pair & np.uint64(255)))
            self.rest = below.total[parent] - np.add.reduceat(below.count[same], first)
            self.left = below.distinct[parent] - self.distinct


def find(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in the sorted values, -1 if it is not there."""
    if len(values) == 0:
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return np.where(values[at] == wanted, at, -1)


def code_lengths(keys: np.ndarray, counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 probability of every gram, given the counts of all learned grams of these parts and of the first two levels.

    ``keys`` are distinct and sorted and hold every gram whose context ends in the same two bytes as one of them.
    """
    seen = counts > 0
    known, count = keys[seen], counts[seen]
    zero = first.sum(axis=0)
    levels = [Level(np.flatnonzero(zero).astype(np.uint64), zero[zero > 0], None)]
    flat = first.ravel()
    levels.append(Level(np.flatnonzero(flat).astype(np.uint64), flat[flat > 0], levels[0]))
    for k in range(2, ORDER + 1):
        shorter = known >> np.uint64(8 * (ORDER + 1 - k)) << np.uint64(8)
        levels.append(Level(*counted(shorter | (known & np.uint64(255)), count), levels[-1]))

    out = np.zeros(len(keys))
    above = np.full(len(keys), -1)  # the context one longer, in which an escape was paid
    todo = np.arange(len(keys))
    for k in range(ORDER, -1, -1):
        level = levels[k]
        ctx = keys[todo] >> np.uint64(8 * (ORDER + 1 - k))
        at = find(level.ctx, ctx)
        here = at >= 0
        rows, node, up = todo[here], at[here], above[todo[here]]
        total, distinct = level.total[node], level.distinct[node]
        if k < ORDER and (came := up >= 0).any():
            total[came], distinct[came] = levels[k + 1].rest[up[came]], levels[k + 1].left[up[came]]
        pair = find(level.pair, (ctx[here] << np.uint64(8)) | (keys[rows] & np.uint64(255)))
        hit = pair >= 0
        out[rows[hit]] += np.log10((2 * level.count[pair[hit]] - 1) / (2 * total[hit]))
        miss = ~hit & (distinct > 0)  # where all followers are excluded, the escape is certain
        out[rows[miss]] += np.log10(distinct[miss] / (2 * total[miss]))
        above[rows] = node
        todo = np.setdiff1d(todo, rows[hit], assume_unique=True)
    out[todo] -= math.log10(max(256 - int((zero > 0).sum()), 1))
    return out


# --- words --------------------------------------------------------------------------------------------------------


def word_array(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of lower-cased texts and the number of the first word of each text."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begin[edge] = inside[edge]
    starts = np.flatnonzero(begin)
    # a word ends before a blank, the next word of an adjoining text, or the end
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begin[1:]
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(last) + 1 - starts, out=ends[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    return words, np.searchsorted(starts, offsets)


def word_parts(words: pa.Array, parts: int) -> np.ndarray:
    """The part that counts a word, from a hash of its bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    place = (np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))).astype(np.uint64)
    each = mix((data + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + place)
    return (mix(np.add.reduceat(each, offsets[:-1] - offsets[0])) % np.uint64(parts)).astype(np.int64) if len(words) else np.zeros(0, np.int64)


def cut(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """A list column: element i holds ``values[ends[i]:ends[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


# --- jobs ---------------------------------------------------------------------------------------------------------


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one slice in a batch as one compressed message, which halves what is shuffled."""
    packing = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        home = batch.column(3).to_numpy()
        order = np.argsort(home, kind="stable")
        edge = np.flatnonzero(np.r_[True, home[order][1:] != home[order][:-1]]) if len(order) else np.zeros(0, np.int64)
        rows = batch.select([0, 1, 2])
        for a, b in zip(edge, [*edge[1:], len(order)]):
            own = rows.take(pa.array(order[a:b]))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=packing) as writer:
                writer.write_batch(own)
            yield pa.RecordBatch.from_arrays([pa.array([int(home[order[a]])], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["slice", "docs"])


def _joined(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The rows of a slice's messages in batches of up to CHUNK bytes: a slice gets a message from each batch of input, so larger inputs send more and smaller ones."""
    held, size = [], 0
    for blob in table["docs"]:
        with pa.ipc.open_stream(blob.as_py()) as reader:
            for batch in reader:
                if held and size + batch.nbytes > CHUNK:
                    yield pa.concat_batches(held)
                    held, size = [], 0
                held.append(batch)
                size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _chunks(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, lower-cased bytes, offsets) of about CHUNK bytes of text and at most DOCS documents each."""
    for part in slices(_joined(table), limit=CHUNK):
        for k in range(0, part.num_rows, DOCS):
            some = part.slice(k, DOCS)
            data, offsets = utf8(some.column("text"))
            yield some, lower_ascii(data), offsets


def _added(words: pa.Array, n: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, their summed counts, and the place of every word among them."""
    coded = words.dictionary_encode()
    where = coded.indices.to_numpy()
    total = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(total, where, n)
    return coded.dictionary, total, where


def _owners(begin: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which text each place of a buffer belongs to; ``at`` ascends."""
    return np.repeat(np.arange(len(begin)), np.diff(np.r_[np.searchsorted(at, begin), len(at)]))


def _gather(parts: int):
    """One slice's distinct grams and words for every part of the trie, and its counts of the first two levels."""

    def run(table: pa.Table) -> pa.Table:
        own = table["slice"][0].as_py()
        grams, spelled, times = Grams(), [], []
        for batch, data, offsets in _chunks(table):
            learn = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            buffer, begin = laid_out(data, offsets)
            for at, keys in gram_blocks(buffer):
                mine = learn[_owners(begin, at)]
                grams.add(keys[mine], True)
                grams.add(keys[~mine], False)
            words, at = word_array(data, offsets)
            coded = words.dictionary_encode()
            spelled.append(coded.dictionary)
            times.append(np.bincount(coded.indices.to_numpy(), np.repeat(learn, np.diff(at)), minlength=len(coded.dictionary)).astype(np.int64))
        grams.merge()
        first = np.zeros(65536, np.int64)
        np.add.at(first, (grams.keys >> np.uint64(8 * ORDER) << np.uint64(8) | grams.keys & np.uint64(255)).astype(np.int64), grams.counts)
        spelled, number, _ = _added(pa.concat_arrays(spelled), np.concatenate(times))
        side = word_parts(spelled, parts)
        turn = np.argsort(side, kind="stable")
        word_ends = np.searchsorted(side[turn], np.arange(parts + 1))
        home = part_of(grams.keys, parts)
        order = np.argsort(home, kind="stable")
        ends = np.searchsorted(home[order], np.arange(parts + 1))
        each = [order[a:b] for a, b in zip(ends, ends[1:])]
        out = pa.table(
            {
                "slice": pa.array([own] * parts, pa.int32()),
                "part": pa.array(range(parts), pa.int32()),
                "keys": pa.array([deltas(grams.keys[x]) for x in each], pa.binary()),
                "counts": pa.array([arrays.packed(grams.counts[x]) for x in each], pa.binary()),
                "words": cut(spelled.take(pa.array(turn)).cast(pa.binary()), word_ends),
                "n": cut(pa.array(number[turn]), word_ends),
                "first": pa.nulls(parts, pa.binary()),
            }
        )
        last = {"slice": [own], "part": [-1], "keys": [None], "counts": [None], "words": [None], "n": [[int(number.sum())]], "first": [arrays.packed(first)]}
        return pa.concat_tables([out, pa.table(last, schema=out.schema)])

    return run


def _score(shared):
    """One part of the trie: code lengths of all its grams and counts of all its words, for every slice."""

    def run(table: pa.Table) -> pa.Table:
        first = arrays.unpacked(shared.value, np.int64).reshape(256, 256)
        asked = [undeltas(x.as_py()) for x in table["keys"]]
        keys, counts = counted(np.concatenate(asked), np.concatenate([arrays.unpacked(x.as_py(), np.int64) for x in table["counts"]]))
        lengths = code_lengths(keys, counts, first).astype(np.float32)
        table = table.combine_chunks()
        lists = table["words"].chunk(0)
        _, learned, where = _added(lists.flatten(), table["n"].chunk(0).flatten().to_numpy())
        ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]
        return pa.table(
            {
                "slice": table["slice"],
                "keys": table["keys"],
                "lengths": pa.array([arrays.packed(lengths[np.searchsorted(keys, x)]) for x in asked], pa.binary()),
                "words": table["words"],
                "n": cut(pa.array(learned[where] if len(where) else np.zeros(0, np.int64)), ends),
                "distinct": pa.array([int((learned > 0).sum())] * table.num_rows, pa.int64()),
            }
        )

    return run


def _add_up(tokens: int, ends: int):
    """One slice's documents: code lengths and word counts added up."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys = np.concatenate([undeltas(x.as_py()) for x in answers["keys"]])
        lengths = np.concatenate([arrays.unpacked(x.as_py(), np.float32) for x in answers["lengths"]])
        order = np.argsort(keys, kind="stable")
        keys, lengths = keys[order], lengths[order].astype(float)
        answers = answers.combine_chunks()
        known, count = answers["words"].chunk(0).flatten().cast(pa.large_binary()), answers["n"].chunk(0).flatten().to_numpy()
        smooth = math.log10(tokens + 0.5 * (pc.sum(answers["distinct"]).as_py() + (ends > 0) + 1))
        out, spelled, held = [], [], []
        for batch, data, offsets in _chunks(docs):
            buffer, begin = laid_out(data, offsets)
            score = np.zeros(batch.num_rows)
            for at, grams in gram_blocks(buffer):
                # sorted together with their documents, so that equal grams are looked up once
                both = np.sort(grams << np.uint64(16) | _owners(begin, at).astype(np.uint64))
                grams = both >> np.uint64(16)
                new = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
                each = np.repeat(lengths[np.searchsorted(keys, grams[new])], np.diff(np.r_[new, len(grams)]))
                score += np.bincount((both & np.uint64(DOCS - 1)).astype(np.int64), each, minlength=batch.num_rows)
            words, at = word_array(data, offsets)
            coded = words.dictionary_encode()
            spelled.append(coded.dictionary)
            held.append((batch.select(["doc_id", "held_out"]), score, coded.indices.to_numpy(), at))
        # the words of all chunks are looked up at once: every call makes a table of all that are known
        place = pc.index_in(pa.concat_arrays(spelled), value_set=known).to_numpy(zero_copy_only=False)
        starts = np.cumsum([0, *map(len, spelled)])
        for (batch, score, codes, at), start, end in zip(held, starts, starts[1:]):
            c = count[place[start:end][codes]] if len(codes) else np.zeros(0, np.int64)
            logs, seen = np.r_[0.0, np.cumsum(np.log10(c + 0.5))], np.r_[0, np.cumsum(c > 0)]
            a, b = at[:-1], at[1:]
            out.append(
                pa.table(
                    {
                        "doc_id": batch.column("doc_id"),
                        "held_out": batch.column("held_out"),
                        "n_tokens": pa.array(b - a + 1, pa.int64()),
                        "n_known": pa.array(seen[b] - seen[a] + (ends > 0), pa.int64()),
                        "train_tokens": pa.array(np.full(len(a), tokens), pa.int64()),
                        "base_score": pa.array(logs[b] - logs[a] + math.log10(ends + 0.5) - (b - a + 1) * smooth),
                        "score": pa.array(score),
                    }
                )
            )
        return pa.concat_tables(out)

    return run


def code_length(docs: DataFrame, held_out: Column) -> DataFrame:
    """Score whole texts with a PPM model and a word model learned from the rows for which ``held_out`` is not true.

    ``docs`` has doc_id and text; other columns are not read. One row per row of ``docs``: doc_id, held_out, n_tokens
    (words and the end), n_known (tokens that occur in learning texts), train_tokens, base_score (log10 probability by
    smoothed word counts), score (log10 probability by PPM of the lower-cased text and its end). A null text
    is empty; an empty text has the score of its end. A null doc_id is kept and its row learned from. Repeated
    rows each count. Without learning texts the model gives each of 256 symbols the same probability and base_score is 0.
    Rows that are equal in id and text share a slice; all else is dealt evenly. Texts of any length are read in blocks.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.xxhash64("doc_id", "text").alias("h"),
    )
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(at_least, math.ceil(size / SLICE))
    sliced = rows.select("doc_id", "text", "held_out", F.pmod("h", F.lit(number)).cast("int").alias("slice"))
    dealt = sliced.mapInArrow(_bundled, "slice int, docs binary")

    gathered = materialize(dealt.groupBy("slice").applyInArrow(_gather(number), _GATHERED), "grams")
    totals = gathered.where("part = -1")
    first = arrays.added(totals.select(F.col("first").alias("counts")), np.int64)
    if first is None:  # no rows
        return spark.createDataFrame([], _DOCS)
    ends = int(first.reshape(256, 256)[:, END].sum())
    tokens = totals.agg(F.sum(F.col("n")[0])).first()[0] + ends
    sweep(docs)  # the texts' first shuffle; they are dealt again for their answers
    shared = spark.sparkContext.broadcast(arrays.packed(first))
    scored = gathered.where("part >= 0").drop("first").groupBy("part").applyInArrow(_score(shared), _SCORED)
    return dealt.groupBy("slice").cogroup(scored.groupBy("slice")).applyInArrow(_add_up(tokens, ends), _DOCS)
