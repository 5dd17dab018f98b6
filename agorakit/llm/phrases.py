"""Phrase collocation mining: phrases of two to four words that occur together more often than their parts.

Phrases are counted in a HAT-trie per task: a shallow trie over word ids whose leaves are containers of hashed (word id)
suffixes with counts. A container that grows too large bursts into children by its next word. When the trie holds
``LIMIT`` entries, its largest subtrees are written out whole, as runs sorted by word id, one for each prefix partition (the buckets of
the first and the second word); the runs of a partition meet in one task, which merges them and keeps what occurs
``least`` times.

Three passes over the texts: words; pairs of frequent words; phrases of three and four words all of whose pairs are frequent. A
phrase is never more frequent than a part of it, so nothing that counts is left out. The passes know frequent words and pairs by a bit
map of bounded size, which lets some rare ones through; these only cost time.

A word id is a 64-bit hash of language and word. Ids of different words are compared once per run; should two be equal, all ids are made anew with
another seed, so counts are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from agorakit.llm import arrays
from agorakit.llm.kernels import Words, column, give_back, lower_ascii, mix, slices, utf8
from agorakit.session import batch_rows, discard, materialize

CHUNK = 1 << 20  # bytes of text handled at a time; longer texts are cut between pieces
SECOND = 8  # children of a trie node by the second word; first-word buckets times this are the prefix partitions
PART_BYTES = 16 << 20  # text for one prefix partition
BURST = 1 << 14  # entries of a container before it bursts
LIMIT = 1_200_000  # entries of a task's trie before subtrees are written out
RUN_BYTES = 4 << 20  # runs sent on at a time
ROWS = 1000  # rows of a batch of texts
WORDS = 400_000  # distinct words of a task before they are written out
MAX_BITS = 29  # 64 MB: the largest bit map of frequent words or pairs
LONGEST = 4  # words of a phrase

_STEP = np.uint64(0x9E3779B97F4A7C15)
_RUNS = "part int, ids binary, counts binary"


# --- words --------------------------------------------------------------------------------------------------------


def _breaks(data: np.ndarray) -> np.ndarray:
    """Bytes that end a piece: ``[.,;:!?\\x0A-\\x0D]``."""
    return np.isin(data, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """(bytes, offsets, language of each stretch), lower-cased, about ``limit`` bytes each.

    A text longer than that is cut behind piece ends, where no phrase can cross, so a stretch is longer than the limit only if one piece is.
    """
    limit = limit or CHUNK
    for batch in slices(batches):
        langs = column(batch, "lang").to_pylist()
        data, offsets = utf8(column(batch, "text"))
        lower_ascii(data)
        cuts, owner = [], []
        for i, lang in enumerate(langs):
            a, b = int(offsets[i]), int(offsets[i + 1])
            while b - a > limit:
                ends = np.flatnonzero(_breaks(data[a : a + limit]))
                if not len(ends):
                    after = np.flatnonzero(_breaks(data[a + limit : b]))
                    if not len(after):
                        break
                    cut = a + limit + int(after[0]) + 1
                else:
                    cut = a + int(ends[-1]) + 1
                cuts.append(a)
                owner.append(lang)
                a = cut
            cuts.append(a)
            owner.append(lang)
        cuts = np.array([*cuts, len(data)], np.int64)
        first = 0
        while first < len(owner):
            last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + limit, side="right")) - 1)
            yield data[cuts[first] : cuts[last]], cuts[first : last + 1] - cuts[first], owner[first:last]
            first = last


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words ``[^\\x20\\x09]+`` of the pieces, and whether the word behind a word belongs to the same piece."""
    ends = _breaks(data)
    words = Words(data, offsets, ~(ends | (data == 32) | (data == 9)))
    piece = np.r_[0, np.cumsum(ends, dtype=np.int32)][words.starts]
    joined = np.zeros(len(words.starts), bool)
    joined[:-1] = piece[1:] == piece[:-1]
    joined[words.first[1:][words.first[1:] > 0] - 1] = False
    return words, joined


def lang_hash(lang: str, seed: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode(), seed + 1)


def word_ids(words: Words, langs: list[str], seed: int) -> np.ndarray:
    """The id of every word occurrence."""
    import xxhash

    spelled = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.vocabulary), np.uint64, len(words.vocabulary))
    known = {lang: lang_hash(lang, seed) for lang in set(langs)}
    of_lang = np.fromiter((known[lang] for lang in langs), np.uint64, len(langs))
    return mix(spelled[words.codes] + np.repeat(of_lang, np.diff(words.first))) if len(words.codes) else np.zeros(0, np.uint64)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, id, f) of all words."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("id", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, waiting, size = None, [], 0

        def merged() -> pa.Table:
            both = pa.concat_tables([t for t in [kept, *waiting] if t is not None])
            return both.group_by(["lang", "word", "id"]).aggregate([("n", "sum")]).rename_columns(["lang", "word", "id", "n"])

        for data, offsets, langs in text_chunks(batches):
            words, _ = words_of(data, offsets)
            if not len(words.codes):
                continue
            ids = word_ids(words, langs, seed)
            unique, first, n = np.unique(ids, return_index=True, return_counts=True)
            owner = np.repeat(np.arange(len(langs)), np.diff(words.first))[first]
            waiting.append(
                pa.table(
                    {
                        "lang": pa.array(langs, pa.string()).take(pa.array(owner)),
                        "word": pa.array(words.vocabulary, pa.binary()).take(pa.array(words.codes[first])),
                        "id": pa.array(unique.view(np.int64)),
                        "n": pa.array(n.astype(np.int64)),
                    }
                )
            )
            size += len(unique)
            if size > max(WORDS, kept.num_rows if kept is not None else 0):
                kept, waiting, size = merged(), [], 0
                if kept.num_rows > WORDS:
                    yield from kept.cast(schema).to_batches(1 << 16)
                    kept = None
        if waiting or kept is not None:
            yield from merged().cast(schema).to_batches(1 << 16)
        del kept, waiting
        give_back()

    found = docs.mapInArrow(run, "lang string, word binary, id long, n long")
    return found.groupBy("lang", "word").agg(F.min("id").alias("id"), F.max("id").alias("other"), F.sum("n").alias("f"))


# --- bit maps -----------------------------------------------------------------------------------------------------


def bits_for(count: int) -> int:
    return int(np.clip(math.ceil(math.log2(max(count, 1) * 16)), 13, MAX_BITS))


def marked(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit map of the 64-bit keys in the one column of ``keys``: made in the tasks and joined by or."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - bits)
            np.bitwise_or.at(on, (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
        yield pa.RecordBatch.from_arrays([pa.array([arrays.packed(on)], pa.binary())], schema=arrays.ARROW)

    found = arrays.added(keys.mapInArrow(run, arrays.SCHEMA), np.uint8, union=True)
    return found if found is not None else np.zeros(1 << (bits - 3), np.uint8)


def is_marked(on: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = int(len(on)).bit_length() + 2
    at = keys >> np.uint64(64 - bits)
    return (on[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _STEP + second)


# --- trie ---------------------------------------------------------------------------------------------------------


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``keys`` (columns x entries), sorted, with their summed counts."""
    if keys.shape[1] == 0:
        return keys, counts
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys, counts = keys[:, order], counts[order]
    first = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
    return keys[:, first], np.add.reduceat(counts, first)


class Container:
    """Entries below one trie path: packed word codes (two to a number) with counts, made distinct as it grows."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = len(counts)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(counts)
        if self.size > 2 * len(self.counts) + 1024:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            self.keys, self.counts = summed(
                np.concatenate([self.keys, *[k for k, _ in self.waiting]], axis=1), np.concatenate([self.counts, *[c for _, c in self.waiting]])
            )
            self.waiting, self.size = [], len(self.counts)


class Trie:
    """Counts of phrases by word codes: root children by the first word's bucket, burst ones split by the second word's."""

    def __init__(self, buckets: int, width: int):
        self.buckets, self.width = buckets, width
        self.codes = np.zeros(0, np.uint64)  # ids, sorted
        self.code_of = np.zeros(0, np.uint64)  # their codes, from 1, in order of arrival
        self.ids = np.zeros(1, np.uint64)  # by code
        self.nodes: dict[int, Container | list[Container]] = {}

    def _code(self, ids: np.ndarray) -> np.ndarray:
        """Codes of distinct sorted ids."""
        at = np.searchsorted(self.codes, ids)
        new = ids[(at == len(self.codes)) | (self.codes[np.minimum(at, max(len(self.codes) - 1, 0))] != ids)] if len(self.codes) else ids
        if len(new):
            where = np.searchsorted(self.codes, new)
            self.code_of = np.insert(self.code_of, where, np.arange(len(self.ids), len(self.ids) + len(new)).astype(np.uint64))
            self.codes = np.insert(self.codes, where, new)
            self.ids = np.concatenate([self.ids, new])
        return self.code_of[np.searchsorted(self.codes, ids)]

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (self.ids[(keys[0] >> np.uint64(32)).astype(np.int64)] % np.uint64(self.buckets)).astype(np.int64)

    def _second(self, keys: np.ndarray) -> np.ndarray:
        return (self.ids[(keys[0] & np.uint64(0xFFFFFFFF)).astype(np.int64)] % np.uint64(SECOND)).astype(np.int64)

    @staticmethod
    def _parts(side: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        order = np.argsort(side, kind="stable")
        edge = np.flatnonzero(np.r_[True, side[order][1:] != side[order][:-1]])
        for a, b in zip(edge, [*edge[1:], len(order)]):
            yield int(side[order[a]]), keys[:, order[a:b]], counts[order[a:b]]

    def add(self, grams: list[np.ndarray | None], places: np.ndarray) -> None:
        """Phrases beginning at ``places``; ``grams[j]`` holds the id of the word j places on for every place, 0 for none."""
        if not len(places):
            return
        used, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        codes = np.zeros(len(used), np.uint64)
        real = used != 0
        codes[real] = self._code(used[real])
        codes = codes[inverse].reshape(len(grams), -1)
        keys = np.stack([codes[j] << np.uint64(32) | (codes[j + 1] if j + 1 < len(codes) else np.uint64(0)) for j in range(0, len(codes), 2)])
        keys, counts = summed(keys, np.ones(keys.shape[1], np.int64))
        for bucket, own, n in self._parts(self._first(keys), keys, counts):
            node = self.nodes.get(bucket)
            if node is None:
                self.nodes[bucket] = Container(own, n)
            elif isinstance(node, Container):
                node.add(own, n)
                if node.size > BURST:
                    node.settle()
                    if node.size > BURST:
                        self.nodes[bucket] = children = [Container(own[:, :0], n[:0]) for _ in range(SECOND)]
                        for side, keys_, counts_ in self._parts(self._second(node.keys), node.keys, node.counts):
                            children[side] = Container(keys_, counts_)
            else:
                for side, keys_, counts_ in self._parts(self._second(own), own, n):
                    node[side].add(keys_, counts_)

    def size_of(self, bucket: int) -> int:
        node = self.nodes[bucket]
        return node.size if isinstance(node, Container) else sum(c.size for c in node)

    def runs(self, bucket: int) -> Iterator[tuple[int, bytes, bytes]]:
        """Takes a subtree out: one sorted run of word ids for each prefix partition in it."""
        node = self.nodes.pop(bucket)
        if isinstance(node, Container):
            node.settle()
            pieces = list(self._parts(self._second(node.keys), node.keys, node.counts)) if node.size else []
        else:
            for child in node:
                child.settle()
            pieces = [(side, child.keys, child.counts) for side, child in enumerate(node) if child.size]
        for side, keys, counts in pieces:
            codes = np.stack([half for key in keys for half in (key >> np.uint64(32), key & np.uint64(0xFFFFFFFF))][: self.width])
            ids, counts = summed(self.ids[codes.astype(np.int64)], counts)
            yield bucket * SECOND + side, ids.tobytes(), counts.astype(np.uint32).tobytes()

    def emptied(self, down_to: int) -> Iterator[tuple[int, bytes, bytes]]:
        """Writes out whole subtrees, the largest first, until ``down_to`` entries are left."""
        size = {b: self.size_of(b) for b in self.nodes}
        left = sum(size.values())
        for bucket in sorted(size, key=size.get, reverse=True):
            if left <= down_to:
                return
            left -= size[bucket]
            yield from self.runs(bucket)
        if not self.nodes:
            self.codes, self.code_of, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(1, np.uint64)

    def total(self) -> int:
        return sum(self.size_of(b) for b in self.nodes)


# --- passes -------------------------------------------------------------------------------------------------------


def run_batches(runs: Iterator[tuple[int, bytes, bytes]], limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches (part, ids, counts) of about ``limit`` bytes, one run at least."""
    schema = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    for row in runs:
        rows.append(row)
        size += len(row[1]) + len(row[2])
        if size >= (limit or RUN_BYTES):
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def count_phrases(docs: DataFrame, words: np.ndarray, pairs: np.ndarray | None, buckets: int, seed: int, least: int) -> DataFrame:
    """(ids array<long>, f) of phrases that occur ``least`` times: pairs of marked words, or with ``pairs`` phrases of three and four words."""
    width = 2 if pairs is None else LONGEST
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((arrays.packed(words), None if pairs is None else arrays.packed(pairs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, couples = (None if x is None else arrays.unpacked(x, np.uint8) for x in shared.value)
        trie, waited = Trie(buckets, width), 0
        for data, offsets, langs in text_chunks(batches):
            found, joined = words_of(data, offsets)
            if len(found.codes) < 2:
                continue
            ids = word_ids(found, langs, seed)
            # whether a phrase of two words that can be frequent begins here
            two = joined.copy()
            often = is_marked(known, ids)
            two &= often
            two[:-1] &= often[1:]
            if couples is None:
                at = np.flatnonzero(two)
                trie.add([ids[at], ids[at + 1]], at)
            else:
                at = np.flatnonzero(two)
                two[at] = is_marked(couples, pair_key(ids[at], ids[at + 1]))
                three = two[:-1] & two[1:]
                at = np.flatnonzero(three)
                four = np.zeros(len(at), bool)
                inside = at + 2 < len(two)
                four[inside] = two[at[inside] + 2]
                long = at[four]
                none = np.zeros(len(at), np.uint64)
                trie.add(
                    [np.concatenate([ids[at + j], ids[long + j]]) for j in range(3)] + [np.concatenate([none, ids[long + 3]])], np.concatenate([at, long])
                )
            waited += 1
            if waited % 4 == 0 and trie.total() > LIMIT:
                yield from run_batches(trie.emptied(LIMIT // 2))
        yield from run_batches(trie.emptied(0))
        del trie
        give_back()

    def merge(table: pa.Table) -> pa.Table:
        ids = [np.frombuffer(x.as_py(), np.uint64).reshape(width, -1) for x in table["ids"]]
        counts = [np.frombuffer(x.as_py(), np.uint32).astype(np.int64) for x in table["counts"]]
        keys, n = summed(np.concatenate(ids, axis=1), np.concatenate(counts))
        often = np.flatnonzero(n >= least)
        keys, n = keys[:, often], n[often]
        size = (keys != 0).sum(axis=0)
        flat = keys.T.ravel()
        ends = np.r_[0, np.cumsum(size)].astype(np.int32)
        del ids, counts
        give_back()
        return pa.table({"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[flat != 0].view(np.int64))), "f": pa.array(n)})

    return docs.mapInArrow(run, _RUNS).groupBy("part").applyInArrow(merge, "ids array<bigint>, f long")


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): (lang, word, id, f) of all words, and (ids, f) of all phrases of two to four words with f >= ``least``."""
    with batch_rows(docs.sparkSession, ROWS):
        return _counted(docs, least)


def _counted(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / PART_BYTES), 64)
    buckets = math.ceil(parts / SECOND)
    for seed in range(0, 100, 2):
        words = materialize(word_counts(rows, seed), "words")
        if not words.groupBy("id").count().where("count > 1").limit(1).count() and not words.where("id = 0 or id != other").limit(1).count():
            break
        discard(words)
    often = words.where(F.col("f") >= least)
    word_map = marked(often.select("id"), bits_for(often.count()))
    pairs = materialize(count_phrases(rows, word_map, None, buckets, seed, least), "pairs")

    def pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, 2)
            key = pair_key(ids[:, 0], ids[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    pair_map = marked(pairs.select("ids").mapInArrow(pair_keys, "key long"), bits_for(pairs.count()))
    longer = materialize(count_phrases(rows, word_map, pair_map, buckets, seed, least), "longer")
    return words.drop("other"), pairs.unionByName(longer)


def collocations(docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """The best phrases of each language.

    ``docs`` has lang and text; other columns are not read. Text is lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
    blanks and tabs into words. A phrase of two to four words with ``a >= least`` occurrences has the score ``floor(2000000 a / (l + r))`` of
    its weakest cut into a first part (l occurrences) and a rest (r), of equal ones the first. Phrases inside a longer
    one with at least ``share`` percent of their occurrences go. The first ``top`` of each language by score, a (both descending) and phrase: lang, rank,
    phrase, a, l, r, n (words of the language), score. A null lang is ``und``, a null text empty; repeated rows count each
    time; without frequent phrases there are no rows.
    """
    words, phrases = frequent_phrases(docs, least)
    counts = phrases.unionByName(words.where(F.col("f") >= least).select(F.array("id").alias("ids"), "f"))
    cut = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", 1, F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail")
    )
    whole = "decimal(38,0)"
    scored = (
        cut.join(counts.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head")
        .join(counts.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
        .withColumn("score", F.expr(f"(cast(2000000 as decimal(18,0)) * cast(a as decimal(20,0))) div (cast(l as {whole}) + r)"))
        .groupBy("ids", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("weakest"))
    )
    inside = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), p -> slice(ids, p, m))))"
    )
    covered = phrases.where(F.size("ids") > 2).select(F.explode(inside).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    kept = scored.join(covered, "ids", "left").where(F.col("longer").isNull() | (F.col("longer") * F.lit(100).cast("decimal(18,0)") < F.col("a") * F.lit(share).cast("decimal(18,0)")))
    spelled = (
        kept.select("ids", "a", "weakest", F.posexplode("ids").alias("at", "id"))
        .join(words.select("id", "lang", "word"), "id")
        .groupBy("ids", "a", "weakest")
        .agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("w"))
        .select("ids", "a", "weakest", "lang", F.concat_ws(" ", F.col("w.word")).alias("phrase"))
    )
    order = [F.col("weakest.score").desc(), F.col("a").desc(), F.col("phrase")]
    best = (
        spelled.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(64)))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= top)
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("weakest.l").alias("l"), F.col("weakest.r").alias("r"), "n", F.col("weakest.score").cast("long").alias("score")
    )
