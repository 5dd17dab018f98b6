"""Small numpy kernels over Arrow text buffers, used inside Spark tasks.

A kernel sees one slice of a batch (a few MB of text). Everything that has to
cross documents (counts, joins, orders) is Spark's work, not done here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``limit`` bytes of text, at least one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        first, base = 0, 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(first, last - first)
            first, base = last, int(ends[last - 1])
    give_back()


def give_back() -> None:
    """Workers live on for later stages: what a task has freed goes back to the system, Arrow's memory and the heap's."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def once(key: str, make: Callable[[], object]) -> object:
    """A value made once per Python worker and kept for its later tasks (tables that depend on no data)."""
    import sys

    kept = sys.__dict__.setdefault("_agorakit_once", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with a column ``_text``: where it is missing, it is the field ``text`` of ``_row``, not a copy."""
    for batch in batches:
        if "_text" not in batch.schema.names:
            text = pc.struct_field(column(batch, "_row"), "text").cast(pa.string())
            batch = pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "_text"])
        yield batch


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (a writable copy) and int64 offsets of a string column; null reads as empty."""
    values = pc.fill_null(values, "").cast(pa.large_string())
    values = pa.concat_arrays([values])
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]].copy() if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    return data


class Words:
    """Words of a slice: ``first[i]:first[i+1]`` are those of row i.

    ``starts``/``lengths`` are byte places in the slice; ``codes`` index the
    distinct words in ``vocabulary``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        begin[edge] = inside[edge]
        self.starts = np.flatnonzero(begin)
        order = np.cumsum(begin)[inside] - 1
        self.lengths = np.bincount(order, minlength=len(self.starts)).astype(np.int64)
        self.first = np.searchsorted(self.starts, offsets)
        packed = data[inside]
        ends = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.lengths, out=ends[1:])
        coded = pa.Array.from_buffers(
            pa.large_binary(), len(self.starts), [None, pa.py_buffer(ends), pa.py_buffer(packed)]
        ).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.vocabulary = coded.dictionary.to_pylist()


def space_words(values: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    data, offsets = utf8(values)
    lower_ascii(data)
    return Words(data, offsets, ~((data == 32) | ((data >= 9) & (data <= 13))))


def alnum_words(values: pa.Array) -> Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased: digits, letters, all non-ASCII."""
    data, offsets = utf8(values)
    lower_ascii(data)
    return Words(data, offsets, ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)) | (data >= 128))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, in place."""
    x ^= x >> _S33
    x *= _MIX1
    x ^= x >> _S33
    x *= _MIX2
    x ^= x >> _S33
    return x


def word_hashes(words: Words) -> np.ndarray:
    import xxhash

    hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.vocabulary), np.uint64, len(words.vocabulary))
    return hashed[words.codes] if len(hashed) else np.zeros(0, np.uint64)


def shingle_sets(values: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every row; fewer words than ``size`` make one shingle, none no shingle."""
    words = space_words(values)
    hashed = word_hashes(words)
    rolled = np.zeros(max(len(hashed) - size + 1, 0), np.uint64)
    for j in range(size):
        rolled *= _STEP
        rolled += hashed[j : j + len(rolled)]
    mix(rolled)
    out = []
    first = words.first
    for i in range(len(first) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            x = np.sort(rolled[a : b - size + 1])
            out.append(x[np.r_[True, x[1:] != x[:-1]]])
        elif b > a:
            one = np.array([b - a], np.uint64)
            for k in range(a, b):
                one *= _STEP
                one += hashed[k]
            out.append(mix(one))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def batches_of(schema: pa.Schema, columns: list[pa.Array], limit: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """A record batch, cut into pieces of at most ``limit`` rows."""
    whole = pa.RecordBatch.from_arrays(columns, schema=schema)
    for k in range(0, whole.num_rows, limit):
        yield whole.slice(k, limit)
