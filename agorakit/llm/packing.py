"""Packing along a space-filling curve.

Hashed document vectors are projected to a few dimensions; the place on a Hilbert curve through these is
the sort key. Documents are dealt to tasks by ranges of the key and packed in its order,
so that neighbours in a sequence are alike. Documents are cut freely: every
sequence of a task but its last few is full, and the rest is cut into sequences of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agorakit.llm.kernels import column, once, slices, utf8
from agorakit.llm.tokens import Vocabulary
from agorakit.session import materialize

LENGTH = 1024
DIMS = 4
BITS = 12  # bits of the key for each dimension
SALT_BITS = 15  # below them, so that equal documents can be dealt to several tasks
GROUPS = 512
SEED = 7


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Group of each byte pair, and the projection; both depend on the seed only."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, GROUPS, 1 << 16).astype(np.int64), rng.standard_normal((GROUPS, DIMS)) / np.sqrt(GROUPS)


def projections(texts: pa.Array) -> np.ndarray:
    """Rows of DIMS numbers: the vector of square-rooted counts of hashed byte pairs, scaled to length 1, projected. Empty texts are 0."""
    group, matrix = once("projection", _tables)
    data, offsets = utf8(texts)
    n = len(offsets) - 1
    if len(data) < 2:
        return np.zeros((n, DIMS))
    pairs = group[(data[:-1].astype(np.int64) << 8) | data[1:]]
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)[:-1]
    inside = np.ones(len(pairs), bool)
    edge = offsets[1:-1] - 1
    inside[edge[(edge >= 0) & (edge < len(inside))]] = False
    counts = np.bincount((owner * GROUPS + pairs)[inside], minlength=n * GROUPS).reshape(n, GROUPS)
    vectors = np.sqrt(counts)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(norm, 1e-12)) @ matrix


def hilbert(coordinates: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of rows of integer coordinates below ``2 ** bits`` (at most 63 bits in all).

    Undoes the curve's rotations bit by bit, from the highest, then reads the
    Gray code of the interleaved bits.
    """
    x = coordinates.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            x[0] ^= np.where(flip, low, 0)
            t = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= t
            x[i] ^= t
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        t ^= np.where((x[dims - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= t
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def sort_keys(points: np.ndarray, salt: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Hilbert place of standardised points in the high bits, salt in the low ones."""
    level = 1 / (1 + np.exp(-1.7 * np.clip((points - mean) / spread, -8, 8)))
    cells = np.minimum((level * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
    return (hilbert(cells) << SALT_BITS) | (salt & ((1 << SALT_BITS) - 1))


class Packer:
    """Cuts a stream of token runs into sequences; holds less than one sequence between calls."""

    def __init__(self, part: int, length: int, with_ids: bool):
        self.part, self.length, self.with_ids = part, length, with_ids
        self.sequence, self.ids, self.runs = 0, np.zeros(0, np.uint32), []

    def _cut(self, runs: list[tuple], ids: np.ndarray, limits: np.ndarray) -> tuple:
        """Pieces of ``ids``: ``limits`` are the ends of the sequences, runs (doc_id, start, doc_tokens, size)."""
        ends = np.cumsum([r[3] for r in runs])
        cuts = np.union1d(ends, limits)
        low = np.r_[0, cuts[:-1]]
        run = np.searchsorted(ends, low, side="right")
        sequence = np.searchsorted(limits, low, side="right")
        first = np.r_[0, ends[:-1]]
        begin = np.r_[0, limits[:-1]]
        raw = ids.astype("<u4").tobytes()
        return (
            [runs[r][0] for r in run],
            [runs[r][1] + int(a - first[r]) for r, a in zip(run, low)],
            cuts - low,
            [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(low.tolist(), cuts.tolist())],
            [runs[r][2] for r in run],
            (self.part << 40) + self.sequence + sequence,
            low - begin[sequence],
            [ids[a:b] for a, b in zip(low, cuts)] if self.with_ids else None,
        )

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> tuple | None:
        runs = [*self.runs, *[(d, 0, int(c), int(c)) for d, c in zip(doc_ids, counts)]]
        ids = np.concatenate([self.ids, ids])
        full = len(ids) // self.length
        ready = full * self.length
        held, left, now = [], len(ids) - ready, []
        for d, start, tokens, size in reversed(runs):
            take = min(left, size)
            left -= take
            if take:
                held.append((d, start + size - take, tokens, take))
            if size > take:
                now.append((d, start, tokens, size - take))
        self.runs, self.ids = held[::-1], ids[ready:]
        if not full:
            return None
        out = self._cut(now[::-1], ids[:ready], np.arange(1, full + 1) * self.length)
        self.sequence += full
        return out

    def close(self) -> tuple | None:
        """The rest, as sequences whose lengths are the powers of two of its binary form."""
        n = len(self.ids)
        if not n:
            return None
        sizes = [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]
        out = self._cut(self.runs, self.ids, np.cumsum(sizes))
        self.sequence += len(sizes)
        self.runs, self.ids = [], self.ids[:0]
        return out


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A document is the ids of its text by ``vocabulary`` (the JSON text of a byte-level BPE file) and one id 0; a
    null text is empty, so just the 0. ``start`` counts the document's ids before the piece, ``offset`` the ids
    before it in its sequence, ``ids_crc32`` is over the little-endian unsigned 32-bit ids. Every row of ``docs``
    is packed; rows that repeat a doc_id are documents of their own. Other columns are ignored. Sequences
    have ``length`` ids; at the end of a task they may be shorter, but then of a power-of-two
    length. No rows give no pieces.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    plain = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), salt.alias("salt"))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x = projections(column(part, "text"))
            yield pa.RecordBatch.from_arrays([column(part, "salt"), *[pa.array(x[:, i]) for i in range(DIMS)]], names=["salt", *[f"x{i}" for i in range(DIMS)]])

    axes = [f"x{i}" for i in range(DIMS)]
    points = materialize(plain.select("text", "salt").mapInArrow(project, "salt long, " + ", ".join(f"{a} double" for a in axes)), "points")
    row = points.agg(*[F.avg(a) for a in axes], *[F.stddev_pop(a) for a in axes]).first()
    mean = np.array([v or 0.0 for v in row[:DIMS]])
    spread = np.maximum(np.array([v or 0.0 for v in row[DIMS:]]), 1e-9)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([column(batch, a).to_numpy() for a in axes], axis=1) if batch.num_rows else np.zeros((0, DIMS))
            yield pa.RecordBatch.from_arrays([pa.array(sort_keys(x, column(batch, "salt").to_numpy(), mean, spread))], names=["key"])

    cuts = points.mapInArrow(keyed, "key long").agg(
        F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 20 * parts).alias("q")
    ).first()[0]
    borders = np.unique(np.array(cuts or [], np.int64)) if parts > 1 else np.zeros(0, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x = projections(column(part, "text"))
            key = sort_keys(x, column(part, "salt").to_numpy(), mean, spread)
            at = np.searchsorted(borders, key, side="right")
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "text"), pa.array(key), pa.array(at, pa.int32())], names=["doc_id", "text", "key", "part"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    dealt = plain.mapInArrow(deal, f"doc_id {id_type}, text string, key long, part int")
    ordered = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "doc_id", F.xxhash64("text"))
    shared = spark.sparkContext.broadcast(vocabulary)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = once("vocabulary " + str(zlib.crc32(shared.value.encode())), lambda: Vocabulary(shared.value))
        packer, kind = None, None

        def batch_of(pieces: tuple) -> pa.RecordBatch:
            columns = [pa.array(pieces[0], kind), *[pa.array(c, pa.int64()) for c in pieces[1:7]]]
            if with_ids:
                flat = np.concatenate(pieces[7]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(pieces[2])], pa.int32()), pa.array(flat)))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for part in slices(batches, "text", 2 << 20):
            kind = column(part, "doc_id").type
            where = column(part, "part").to_numpy()
            ids, counts = vocab.encode(column(part, "text"))
            ends = np.cumsum(counts)
            # an id 0 after each document
            closed = np.insert(ids, ends, 0) if len(ends) else ids
            counts = counts + 1
            ends = np.cumsum(counts)
            edges = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
            owners = column(part, "doc_id").to_pylist()
            for a, b in zip(edges, [*edges[1:], len(where)]):
                if packer is None or packer.part != where[a]:
                    rest = packer.close() if packer else None
                    if rest:
                        yield batch_of(rest)
                    packer = Packer(int(where[a]), length, with_ids)
                low = ends[a] - counts[a]
                pieces = packer.add(owners[a:b], counts[a:b], closed[low : ends[b - 1]])
                if pieces:
                    yield batch_of(pieces)
        rest = packer.close() if packer else None
        if rest:
            yield batch_of(rest)

    ddl = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ordered.mapInArrow(run, ddl + ", ids array<int>" * with_ids)
