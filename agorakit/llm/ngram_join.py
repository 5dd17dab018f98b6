"""N-gram Jaccard join by R-trees over group-count vectors.

A document is the set of its distinct word shingles. Hashing the shingles into groups makes
it a point: how many of its shingles fall in each group. Two sets cannot share more than
the summed coordinate minima of their points, and two subtrees of an R-tree no more than
the summed minima of their upper corners. The join walks pairs of nodes, drops
those whose bound is below what the threshold needs, and checks the exact sets of what
survives.

Distribution. A tree over all documents has no selective region (hashed counts of
unrelated documents look alike at the upper levels), so documents are first dealt to groups: two
sets that reach the threshold must share one of the first ``n - ceil(t n) + 1`` shingles in
any common order of shingles, and be of one or of adjoining bands of size. A class's number begins with its band. The sets of a band
that share such a shingle go, with those of the next band that do, to the group of the smallest class of the lower band,
once, however many shingles say so; sets that share a shingle by chance are seldom of like size, so few of them travel. The order puts
shingles from crowded cells of a count sketch
last, so boilerplate seldom makes a group; it only affects cost, never the result. Groups over ``CHUNK``
members are cut into chunks, each with its own tree.

Links only have to connect components, so there are two passes: the first asks the trees of larger groups for
partners of the group's smallest class only, the second makes groups with connected centres one, deals them to bands, compares what is not
connected with the centre with all of the band, and skips pairs already connected. Points join the dealt rows last, so they
are sent once. The second pass names no pairs: a first tree finds the members of a block that have
a partner at all, these come back with their exact sets, and a finer tree, the exact check and the joining of
components happen inside the block, which returns fewer links than it has members. Equal sets are one class throughout and never paired.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from agorakit.llm import arrays
from agorakit.llm.components import components
from agorakit.llm.kernels import batches_of, binary, column, give_back, shingle_sets, slices
from agorakit.session import discard, materialize, sweep

SKETCH_BITS = 21  # cells of the count sketch; an order of shingles, not a filter
CHUNK = 1024  # members of a group that one tree holds
SMALL = 8  # groups up to this size are joined with themselves at once
LEAF = 8  # members of an R-tree leaf, children of a node
SLAB = 4096  # pairs of leaves whose members are compared at once
CHUNK_SHINGLES = 1 << 20  # shingles of a chunk, at most; never fewer than SMALL members
BAND_SHIFT, LAST_BAND = 52, 2047  # a class number holds its band in the bits above, 52 bits of its key below
FINER = 4  # times as many groups in the points of the second pass's exact step
MAX_BLOOM_BITS = 29  # 64 MB


# --- sets ---------------------------------------------------------------------------------------------------------


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _class_key(x: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(x.tobytes())


def _ratio(num: int, den: int) -> float:
    """Width of a band of sizes: sets over the threshold are in one band or in adjoining ones."""
    return den / num * 1.0001


def class_number(key: bytes, n: int, ratio: float) -> int:
    """The band of the size n, then the first bits of the class key; the last band holds all above it."""
    band = min(int(np.log(n) / np.log(ratio)), LAST_BAND)
    return band << BAND_SHIFT | int.from_bytes(key[:8], "big") >> (64 - BAND_SHIFT)


def scan_sets(docs: DataFrame, size: int, ratio: float) -> DataFrame:
    """(doc_id, text_hash, k, n, cls, point) of every row and one array of shingle counts per cell and task.

    ``text_hash`` tells rows of one doc_id apart. ``k`` is a 128-bit key of the shingle set and ``cls`` its class number, null for the empty set.
    """
    kind = "doc_id long, text_hash long, k binary, n long, cls long, point binary, counts binary"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("k", pa.binary()), ("n", pa.int64()), ("cls", pa.int64()), ("point", pa.binary()), ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        shift = np.uint64(64 - SKETCH_BITS)
        for part in slices(batches):
            sets = shingle_sets(column(part, "text"), size)
            joined = np.concatenate(sets)
            if len(joined):
                cells += np.bincount((joined >> shift).astype(np.int64), minlength=len(cells)).astype(np.uint32)
            keys = [_class_key(x) if len(x) else None for x in sets]
            columns = [
                column(part, "doc_id"),
                column(part, "text_hash"),
                pa.array(keys, pa.binary()),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([class_number(k, len(x), ratio) if len(x) else None for k, x in zip(keys, sets)], pa.int64()),
                pa.array([point(x).tobytes() if len(x) else None for x in sets], pa.binary()),
                pa.nulls(part.num_rows, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        empty = [pa.nulls(1, schema.field(i).type) for i in range(6)]
        yield pa.RecordBatch.from_arrays([*empty, binary([arrays.packed(cells.astype(np.uint64))])], schema=schema)

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return hashed.mapInArrow(run, kind)


def crowding(counts: np.ndarray | None) -> np.ndarray:
    """Class of each cell: 0 up to three deviations above the mean count, then one more for every doubling of the excess."""
    if counts is None:
        counts = np.zeros(1 << SKETCH_BITS, np.uint64)
    mean = counts.mean()
    margin = 3 * np.sqrt(mean) + 1
    excess = counts.astype(np.float64) - mean
    return np.where(excess > margin, np.floor(np.log2(np.maximum(excess, margin) / margin)) + 1, 0).astype(np.uint8)


# --- blocks -------------------------------------------------------------------------------------------------------


def route(docs: DataFrame, size: int, num: int, den: int, order: np.ndarray) -> DataFrame:
    """(token, cls): the leading shingles of every set, and its class number."""
    ratio = _ratio(num, den)
    shared = docs.sparkSession.sparkContext.broadcast(order)
    schema = pa.schema([("token", pa.int64()), ("cls", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        shift = np.uint64(64 - SKETCH_BITS)
        seen: set[bytes] = set()
        for part in slices(batches):
            tokens, owners = [], []
            for x in shingle_sets(column(part, "text"), size):
                if not len(x):
                    continue
                key = _class_key(x)
                if key in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                take = len(x) + (-num * len(x)) // den + 1
                by = rank[(x >> shift).astype(np.int64)]
                if by.any():
                    x = x[np.argsort(by, kind="stable")]
                tokens.append(x[:take])
                owners.append(np.full(take, class_number(key, len(x), ratio)))
            if tokens:
                yield from batches_of(schema, [_signed(np.concatenate(tokens)), pa.array(np.concatenate(owners))])

    return docs.select("text").mapInArrow(run, "token long, cls long")


def mates(routed: DataFrame) -> DataFrame:
    """(centre, cls, size): every class that shares a leading shingle with the smallest class, the centre, of its own band or the band below, and the centres.

    Rows arrive sorted by token and class, so by token, band and class: the first of a token and band is a centre, and a task holds no run.
    Any two classes of a run whose bands are the same or adjoin are in the group of the lower band's centre. ``size`` is the number of
    rows of the group.
    """
    schema = pa.schema([("centre", pa.int64()), ("cls", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros((2, 0), np.int64)  # the centres in force at the end of a batch, as rows that go before the next
        for batch in batches:
            t, c = np.concatenate([last, [batch.column(0).to_numpy(), batch.column(1).to_numpy()]], axis=1)
            if not len(t):
                continue
            band = c >> BAND_SHIFT
            starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (band[1:] != band[:-1])])
            adjoins = np.r_[False, (np.diff(t[starts]) == 0) & (np.diff(band[starts]) == 1)]
            each = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(t)]))
            own, above = c[starts][each], np.flatnonzero(adjoins[each])
            below = c[starts][each[above] - 1]
            keep = own != c
            last = np.stack([t, c])[:, starts[-2:] if adjoins[-1] else starts[-1:]]
            pairs = np.concatenate([np.stack([own[keep], c[keep]], axis=1), np.stack([below, c[above]], axis=1)])
            if len(pairs):
                pairs = np.unique(pairs, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    found = routed.repartition("token").sortWithinPartitions("token", "cls").mapInArrow(run, "centre long, cls long").distinct()
    found = materialize(found, "mates")
    sweep(routed)
    alone = found.select("centre", F.col("centre").alias("cls")).distinct()
    size = found.groupBy("centre").agg((F.count("*") + 1).alias("size"))
    members = materialize(found.unionByName(alone).join(size, "centre"), "members")
    discard(found)
    return members


def _at_most(band: Column, ratio: float) -> Column:
    """Members of a tree whose sets are of this band or smaller: CHUNK, fewer if the sets are long, never fewer than SMALL."""
    return F.least(F.lit(CHUNK), F.greatest(F.lit(SMALL), F.floor(F.lit(CHUNK_SHINGLES) / F.pow(F.lit(ratio), band + 1))))


def dealt_to_centres(members: DataFrame, num: int, den: int) -> DataFrame:
    """``members`` (centre, cls, size and more) as rows of the first pass's blocks: block, is_centre, small, late added.

    A group is a block, cut if it is large, with the centre in all chunks. ``late`` are the members of the band above the
    centre's; two of them are in a group of their own band, too.
    """
    rows = members.withColumn("is_centre", F.col("centre") == F.col("cls")).withColumn("small", F.col("size") <= SMALL)
    band = F.shiftright("centre", BAND_SHIFT)
    rows = rows.withColumn("late", F.shiftright("cls", BAND_SHIFT) > band)
    chunks = F.ceil(F.col("size") / _at_most(band + 1, _ratio(num, den))).cast("int")
    place = F.pmod(F.xxhash64("cls"), chunks).cast("int")
    rows = rows.withColumn("j", F.explode(F.when(F.col("is_centre"), F.sequence(F.lit(0), chunks - 1)).otherwise(F.array(place))))
    return rows.withColumn("block", F.xxhash64("centre", "j"))


def dealt(members: DataFrame, num: int, den: int) -> DataFrame:
    """``members`` (centre, cls, size, n, own and more) as rows of the second pass's blocks: block and late added.

    A block is a band of a group: sets whose sizes allow the threshold are in the same or the next band, and every member is in
    its own and the next. Groups over CHUNK members, fewer in bands of long sets, are cut: all members whose label is not the
    centre's (``own``: it is) go to all chunks, cut into chunks themselves.
    """
    ratio = _ratio(num, den)
    rows = members.withColumn("late", F.explode(F.array(F.lit(False), F.lit(True))))
    rows = rows.withColumn("band", F.floor(F.log(F.col("n")) / F.lit(float(np.log(ratio)))).cast("long") + F.col("late").cast("long"))
    limit = _at_most(F.col("band"), ratio)
    chunks = F.ceil(F.col("size") / limit).cast("int")
    place = F.pmod(F.xxhash64("cls"), chunks).cast("int")
    every = F.sequence(F.lit(0), chunks - 1)
    odd = members.where(~F.col("own")).groupBy("centre").agg(F.count("*").alias("odd"))
    rows = rows.join(odd, "centre")
    parts = F.ceil(F.col("odd") / limit).cast("int")
    slot = F.pmod(F.xxhash64("cls", F.lit(1)), parts).cast("int")
    as_member = rows.withColumn("i", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("j", place)
    as_odd = rows.where(~F.col("own") & (chunks * parts > 1)).withColumn("i", slot).withColumn("j", F.explode(every))
    return as_member.unionByName(as_odd).withColumn("block", F.xxhash64("centre", "band", "i", "j"))


# --- points and sets of classes ------------------------------------------------------------------------------------


def point(x: np.ndarray, finer: int = 1) -> np.ndarray:
    """Group counts; the number of groups is ``finer`` times the power of two in (n/4, n/2], at least 16. 255 stands for 255 or more."""
    groups = finer * max(16, 1 << max(int(len(x) // 2).bit_length() - 1, 0))
    return np.minimum(np.bincount((x & np.uint64(groups - 1)).astype(np.int64), minlength=groups), 255).astype(np.uint8)


def _places(keys: list[bytes], bits: int) -> list[np.ndarray]:
    c = np.array([int.from_bytes(k[:8], "little") for k in keys], np.uint64)
    mask = np.uint64((1 << bits) - 1)
    return [((c >> np.uint64(s)) & mask).astype(np.int64) for s in (0, 17, 34)]


def bloom(keys: DataFrame, count: int) -> np.ndarray:
    """Bit array of class keys, 16 bits for each up to 64 MB; past that it only lets more through."""
    bits = int(np.clip(np.ceil(np.log2(max(count, 1) * 16)), 13, MAX_BLOOM_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            for place in _places(batch.column(0).to_pylist(), bits):
                np.bitwise_or.at(own, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([binary([arrays.packed(own)])], schema=arrays.ARROW)

    filled = arrays.added(keys.mapInArrow(run, arrays.SCHEMA), np.uint8, union=True)
    return filled if filled is not None else np.zeros(1 << (bits - 3), np.uint8)


def sets_of(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """(k, shingles) of the classes in ``wanted`` (k), from the texts; a Bloom filter spares the others the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom(wanted, wanted.count()))
    schema = pa.schema([("k", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        bits = int(len(own)).bit_length() + 2
        seen: set[bytes] = set()
        for part in slices(batches):
            sets = [x for x in shingle_sets(column(part, "text"), size) if len(x)]
            keys = [_class_key(x) for x in sets]
            if not sets:
                continue
            inside = np.ones(len(keys), bool)
            for place in _places(keys, bits):
                inside &= ((own[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)
            rows = []
            for i in np.flatnonzero(inside):
                if keys[i] not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(keys[i])
                    rows.append((keys[i], sets[i].tobytes()))
            if rows:
                k, x = zip(*rows)
                yield pa.RecordBatch.from_arrays([binary(list(k)), binary(list(x))], schema=schema)

    found = docs.select("text").mapInArrow(run, "k binary, shingles binary")
    return materialize(found.dropDuplicates(["k"]), "shingles")


# --- the R-tree ---------------------------------------------------------------------------------------------------


def _folded(points: list[np.ndarray]) -> np.ndarray:
    """Points over the same groups: finer ones are added up, and 255 becomes an unlimited count."""
    groups = min(len(p) for p in points)
    out = np.empty((len(points), groups), np.int32)
    for i, p in enumerate(points):
        wide = p.astype(np.int32)
        wide[p == 255] = 1 << 24
        out[i] = wide.reshape(-1, groups).sum(axis=0)
    return out


class Tree:
    """A packed R-tree: members sorted by label and size, ``LEAF`` children to a node.

    A node keeps the upper corner of its box, its smallest and largest set size, and its label
    if all below share one (else -1).
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.levels = [(points, sizes, sizes, labels)]
        while len(self.levels[-1][0]) > 1:
            top, small, large, label = self.levels[-1]
            at = np.arange(0, len(top), LEAF)
            same = np.minimum.reduceat(label, at) == np.maximum.reduceat(label, at)
            self.levels.append(
                (
                    np.maximum.reduceat(top, at, axis=0),
                    np.minimum.reduceat(small, at),
                    np.maximum.reduceat(large, at),
                    np.where(same, label[at], -1),
                )
            )

    def _fits(self, level: int, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
        top, small, large, label = self.levels[level]
        keep = ~((label[a] == label[b]) & (label[a] >= 0))
        # a pair needs |A and B| >= num / (num + den) * (|A| + |B|), and sizes within num / den
        keep &= (den * large[b] >= num * small[a]) & (den * large[a] >= num * small[b])
        a, b = a[keep], b[keep]
        good = np.zeros(len(a), bool)
        for k in range(0, len(a), 4096):
            x, y = a[k : k + 4096], b[k : k + 4096]
            shared = np.minimum(top[x], top[y]).sum(axis=1, dtype=np.int64)
            most = np.minimum(shared, np.minimum(large[x], large[y]))
            good[k : k + 4096] = (num + den) * most >= num * (small[x] + small[y])
        keep[np.flatnonzero(keep)] = good
        return keep

    def _below(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of children (each once) of pairs of nodes of ``level``."""
        below = len(self.levels[level - 1][0])
        shape = (len(a), LEAF, LEAF)
        x = np.broadcast_to((a[:, None] * LEAF + np.arange(LEAF))[:, :, None], shape).ravel()
        y = np.broadcast_to((b[:, None] * LEAF + np.arange(LEAF))[:, None, :], shape).ravel()
        keep = (x < below) & (y < below) & ((x <= y) if level > 1 else (x < y))
        return x[keep], y[keep]

    def slabs(self, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of members (i < j, labels differ) whose bound reaches the threshold, those of some leaves at a time."""
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            keep = self._fits(level, a, b, num, den)
            a, b = a[keep], b[keep]
            if level > 1:
                a, b = self._below(level, a, b)
        for k in range(0, len(a) if len(self.levels) > 1 else 0, SLAB):
            x, y = self._below(1, a[k : k + SLAB], b[k : k + SLAB])
            keep = self._fits(0, x, y, num, den)
            yield x[keep], y[keep]

    def pairs(self, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """All of ``slabs`` at once."""
        found = list(self.slabs(num, den))
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *[x for x, _ in found]]), np.concatenate([empty, *[y for _, y in found]])

    def partners(self, i: int, num: int, den: int) -> np.ndarray:
        """Members whose bound with member ``i`` reaches the threshold."""
        found = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            top, small, large, _ = self.levels[level]
            own = self.levels[0]
            most = np.minimum(np.minimum(top[found], own[0][i]).sum(axis=1, dtype=np.int64), np.minimum(large[found], own[1][i]))
            keep = (den * large[found] >= num * own[1][i]) & (den * own[1][i] >= num * small[found])
            keep &= (num + den) * most >= num * (small[found] + own[1][i])
            found = found[keep]
            if level:
                found = (found[:, None] * LEAF + np.arange(LEAF)).ravel()
                found = found[found < len(self.levels[level - 1][0])]
        return found[found != i]


def by_block(rows: DataFrame, columns: list[str], work: Callable[[int, list[tuple]], list[tuple]], schema: pa.Schema, kind: str) -> DataFrame:
    """Rows that ``work`` returns for every block, given its id and its rows (``columns``); a task holds one block."""

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        arrays_ = [pa.array(values, field.type) for values, field in zip(zip(*found), schema)]
        return pa.RecordBatch.from_arrays(arrays_, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_block, held = None, []
        for batch in batches:
            ids = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else []
            out: list[tuple] = []
            for start, end in zip(edges, [*edges[1:], len(ids)]):
                if ids[start] != open_block:
                    out += work(open_block, held)
                    open_block, held = int(ids[start]), []
                own = batch.slice(start, end - start)
                held += zip(*[own.column(k).to_pylist() for k in range(1, len(columns) + 1)])
            if out:
                yield batch_of(out)
        out = work(open_block, held)
        if out:
            yield batch_of(out)
        give_back()

    return rows.select("block", *columns).repartition("block").sortWithinPartitions("block").mapInArrow(run, kind)


def _codes(labels: tuple) -> np.ndarray:
    codes = {x: i for i, x in enumerate(sorted(set(labels)))}
    return np.array([codes[x] for x in labels], np.int64)


def surviving_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a, b) of class keys that the trees of the first pass let through.

    ``members`` are rows of blocks (see ``dealt``). Blocks of groups that are not small are only asked for partners of their centre,
    so there are fewer pairs than members; those of small groups are joined with themselves.
    """

    def work(_: int, block: list[tuple]) -> list[tuple]:
        block = list({row[0]: row for row in block}.values())
        if len(block) < 2:
            return []
        keys, sizes, points, centres, small, late = zip(*block)
        size = np.array(sizes, np.int64)
        at = np.argsort(size, kind="stable")
        found = Tree(_folded([np.frombuffer(points[i], np.uint8) for i in at]), size[at], np.arange(len(at)))
        if not small[0]:
            if not any(centres):  # the centre is in no band of these
                return []
            i = int(np.flatnonzero(np.array(centres)[at])[0])
            y = found.partners(i, num, den)
            x = np.full(len(y), i)
        else:
            x, y = found.pairs(num, den)
        pairs = ((keys[i], keys[j]) for i, j in zip(at[x], at[y]) if not (late[i] and late[j]))
        return list({(min(p), max(p)) for p in pairs})

    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    return by_block(members, ["k", "n", "point", "is_centre", "small", "late"], work, schema, "a binary, b binary").distinct()


def with_partner(members: DataFrame, num: int, den: int) -> DataFrame:
    """(block, k, label, late): the rows of second-pass blocks that have a partner of another label by their block's tree."""

    def work(block: int, rows: list[tuple]) -> list[tuple]:
        rows = list({row[0]: row for row in rows}.values())
        if len(rows) < 2:
            return []
        keys, sizes, points, labels, late = zip(*rows)
        if len(set(labels)) < 2:
            return []
        size, label, old = np.array(sizes, np.int64), _codes(labels), np.array(late)
        at = np.lexsort((size, label))
        hit = np.zeros(len(at), bool)
        for x, y in Tree(_folded([np.frombuffer(points[i], np.uint8) for i in at]), size[at], label[at]).slabs(num, den):
            new = ~(old[at[x]] & old[at[y]])
            hit[at[x[new]]] = hit[at[y[new]]] = True
        return [(block, keys[i], labels[i], late[i]) for i in np.flatnonzero(hit)]

    schema = pa.schema([("block", pa.int64()), ("k", pa.binary()), ("label", pa.binary()), ("late", pa.bool_())])
    return by_block(members, ["k", "n", "point", "label", "late"], work, schema, "block long, k binary, label binary, late boolean")


def joining_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct links (a, b) that connect what the labels do not yet, from rows of blocks with their exact ``shingles``.

    Inside a block the tree's pairs are checked by their exact sets; a pair that labels or earlier links of the block connect is
    skipped. A block of m members returns at most m - 1 links, and connects all that its true links connect.
    """

    def work(_: int, rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        keys, labels, late, bodies = zip(*sorted(rows, key=lambda row: (row[1], len(row[3]))))
        sets = [np.frombuffer(x, np.uint64) for x in bodies]
        size, label, old = np.array([len(x) for x in sets], np.int64), _codes(labels), np.array(late)
        universe, place = np.unique(np.concatenate(sets), return_inverse=True)
        own = np.split(place, np.cumsum(size)[:-1])
        mark = np.zeros(len(universe), bool)
        group, out = label.copy(), []
        for x, y in Tree(_folded([point(s, FINER) for s in sets]), size, label).slabs(num, den):
            new = ~(old[x] & old[y]) & (group[x] != group[y])
            by = np.argsort(x[new], kind="stable")
            x, y = x[new][by], y[new][by]
            starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else []
            for start, end in zip(starts, [*starts[1:], len(x)]):
                i, others = x[start], y[start:end]
                others = others[group[others] != group[i]]
                if not len(others):
                    continue
                mark[own[i]] = True
                edges = np.cumsum(size[others]) - size[others]
                both = np.add.reduceat(mark[np.concatenate([own[j] for j in others])].astype(np.int64), edges)
                mark[own[i]] = False
                for j in others[den * both >= num * (size[i] + size[others] - both)]:
                    if group[j] != group[i]:
                        group[group == group[j]] = group[i]
                        out.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
        return out

    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    return by_block(members, ["k", "label", "late", "shingles"], work, schema, "a binary, b binary").distinct()


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose exact sets reach the threshold."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(k).to_pylist() for k in range(4))
            keep = []
            for i in range(len(a)):
                own, other = np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64)
                if len(own) > len(other):
                    own, other = other, own
                place = np.minimum(np.searchsorted(other, own), len(other) - 1)
                both = int((other[place] == own).sum())
                if den * both >= num * (len(own) + len(other) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([binary([a[i] for i in keep]), binary([b[i] for i in keep])], schema=schema)

    own = sets.select(F.col("k").alias("a"), F.col("shingles").alias("x"))
    other = sets.select(F.col("k").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(own, "a").join(other, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


# --- the operator -------------------------------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, num: int = 75, den: int = 100, size: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, and for ``keep_one`` text_hash and label.

    Two documents link when ``den * |A and B| >= num * |A or B|`` for their sets of distinct
    ``size``-word shingles. ``component_id`` is the smallest doc_id reachable by links, itself included.
    A text with fewer words is one shingle; null, empty and blank texts have no shingle and
    link with nothing, not even each other. Repeated rows each get a row; rows that repeat a doc_id with
    other text are documents of their own. A null doc_id links like any other, but is never the smallest
    unless its component has no other id. ``label`` names the component whatever its ids; it is null where a text
    has no shingle. Other columns are ignored. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = materialize(scan_sets(docs, size, _ratio(num, den)), "sets")
    order = crowding(arrays.added(scanned, np.uint64))
    sets = scanned.where("counts is null").select("doc_id", "text_hash", "k", "n")
    points = materialize(scanned.where("k is not null").select("k", "n", "cls", "point").dropDuplicates(["k"]), "points")
    members = mates(route(docs, size, num, den, order))
    sweep(docs)

    first = materialize(surviving_pairs(dealt_to_centres(members, num, den).join(points, "cls"), num, den), "pairs")
    sweep(docs)
    bodies = sets_of(docs, size, first.select(F.explode(F.array("a", "b")).alias("k")))
    links = materialize(verified(first, bodies, num, den), "links")
    discard(bodies, first)
    sweep(docs)
    label = components(links)
    named = points.drop("point").join(label.withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("label", "k"))
    heads = named.select(F.col("cls").alias("centre"), F.col("label").alias("head")).dropDuplicates(["centre"])
    # groups whose centres are connected by now are one group
    merged = members.where(F.col("size") > SMALL).join(heads, "centre").select(F.col("head").alias("centre"), "cls").distinct()
    merged = materialize(merged, "merged")
    sweep(docs)
    rest = merged.join(merged.groupBy("centre").agg(F.count("*").alias("size")), "centre").join(named, "cls")
    rest = rest.withColumn("own", F.col("label") == F.col("centre"))
    blocks = dealt(rest, num, den).select("block", "k", "n", "label", "late")
    open_ = materialize(with_partner(blocks.join(points.select("k", "point"), "k"), num, den), "open")
    sweep(docs)
    bodies = sets_of(docs, size, open_.select("k").distinct())
    joined = materialize(joining_links(open_.join(bodies, "k"), num, den), "links")
    discard(bodies, open_)
    sweep(docs)
    label = components(links.unionByName(joined))
    discard(members, merged, points, joined, links)
    sweep(docs)

    least = sets.where("k is not null").groupBy("k").agg(F.min("doc_id").alias("least"))
    joined = least.join(label.withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("label", "k"))
    ids = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = joined.select("k", "label").join(ids, "label").select("k", "label", "component_id")
    return sets.join(by_class, "k", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash", "label"
    )


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one row of each group: that of the smallest doc_id, then of the smallest text.

    ``groups`` is what ``jaccard_components`` returns for ``docs``. A null doc_id comes after all others: of a group
    without ids one row stays too. Texts without a shingle are no group: of rows with one doc_id and the same such text one
    stays, and all that have no doc_id.
    """
    # texts without a shingle: doc_id and text are the group
    alone = F.sha2(F.concat_ws(" ", "doc_id", "text_hash"), 256).cast("binary")
    least = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("label").isNotNull() | F.col("doc_id").isNotNull()))
    least = least.select(F.coalesce("label", alone).alias("_group"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    count = least.groupBy("_group").agg(F.count("*").alias("_n"), F.min("_id").alias("_id"), F.min("_hash").alias("_hash"))
    several = least.join(count.where("_n > 1").select("_group"), "_group").distinct()
    key = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash"))
    single = docs.join(count.where("_n = 1"), key, "left_semi")
    row = F.struct("text", *[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    once = docs.join(several, key).groupBy("_group").agg(F.min(row).alias("_row")).select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    unnamed = groups.where("doc_id is null and label is null").select(F.col("text_hash").alias("_hash")).distinct()
    rest = docs.where("doc_id is null").join(unnamed, F.xxhash64(F.col("text").cast("string")) == F.col("_hash"), "left_semi")
    return single.unionByName(once).unionByName(rest)
