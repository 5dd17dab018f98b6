"""Hard-negative mining with cover trees over norm-augmented vectors.

The score of a row for an anchor is their inner product of whole numbers. Appending ``sqrt(M^2 - |x|^2)`` to every candidate x puts all on a
sphere of radius M without changing a product with (anchor, 0), so a ball of candidates bounds their scores from both
sides. A cover tree holds such balls: the centres below a node of level L are more than 2^L apart, every point of the node
lies within 2^(L + 1) of its centre, and the ball used for bounds is the smallest around it. A search goes best bound first and leaves out nodes that lie wholly
above or below all score windows of an anchor, cannot beat what it has found, or hold no label it looks for. Points are verified by exact products.

Distribution. Candidates are dealt to cells by their nearest pivot (a bounded sample of rows), cells to chunks of about ``CHUNK`` rows, so
copies of one vector spread over as many chunks as they need; every row is in exactly one tree. Trees are a
table in the shared folder. Anchors come in blocks of about ``ANCHORS``; a task searches the trees of up to ``RANGE`` chunks for one block and
returns a few rows for each anchor, which a grouped top-k merges. Two such passes: positives, then negatives in the windows they set.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from agorakit.session import discard, materialize

CHUNK = 4096  # candidates of one tree, about
ANCHORS = 1024  # anchors of a block, about
RANGE = 16  # chunks that one task searches at most
PIVOTS = 1024  # at most; rows taken by hash
LEAF = 32  # points of a node that is not split
SCALE = 256

_LOWEST = np.iinfo(np.int64).min
_HIGHEST = np.iinfo(np.int64).max
_POINTS = "vec_id long, label long, vector binary, dim int, cell int, anchor boolean"
_FOUND = "anchor_id long, at int, vec_id long, score long"


# --- tree ---------------------------------------------------------------------------------------------------------


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers (rows of a by rows of b)."""
    most = max(1, int((a * a).sum(axis=1).max(initial=0))) * max(1, int((b * b).sum(axis=1).max(initial=0)))
    if most < 1 << 104:  # no partial sum passes 2^52
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class CoverTree:
    """A cover tree over whole-number vectors, their ids (ascending) and labels.

    A node has points (verified when it is opened) and children; ``centre``, ``angle`` (between a
    centre and its farthest point, seen from the origin), ``least`` (smallest id) and ``label`` (the only one, or None) describe a child.
    """

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.x, self.ids, self.labels = x, ids, labels
        norms = (x * x).sum(axis=1).astype(float)
        self.size = math.sqrt(norms.max(initial=0.0))
        scale = self.size or 1.0
        self._y = np.c_[x / scale, np.sqrt(np.maximum(1 - norms / scale**2, 0))]
        self.nodes: list[dict] = []
        self.root = self._node(np.arange(len(x)), 0)
        del self._y

    @classmethod
    def of(cls, state: dict) -> CoverTree:
        tree = cls.__new__(cls)
        vars(tree).update(state)
        return tree

    def _distance(self, rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (self._y[rows] @ self._y[centre]), 0))

    def _ball(self, rows: np.ndarray, centre: int) -> dict:
        same = (self.x[rows] == self.x[centre]).all()
        radius = 0.0 if same else float(self._distance(rows, centre).max()) + 1e-7
        one = (self.labels[rows] == self.labels[rows[0]]).all()
        return {
            "centre": centre,
            "angle": 2 * math.asin(min(1.0, radius / 2)),
            "least": int(self.ids[rows].min()),
            "label": int(self.labels[rows[0]]) if one else None,
            "has": np.unique(self.labels[rows]) if not one else None,
        }

    def _node(self, rows: np.ndarray, centre: int) -> dict:
        """The ball of a new node over these rows; nodes are made from the top down without recursion."""
        top = self._ball(rows, centre) | {"node": 0}
        self.nodes.append({})
        todo = [(0, rows, centre)]
        while todo:
            number, rows, centre = todo.pop()
            distance = self._distance(rows, centre)
            radius = float(distance.max(initial=0.0))
            if len(rows) <= LEAF or radius < 1e-7:
                self.nodes[number] = {"points": np.sort(rows), "children": []}
                continue
            apart = 2.0 ** (math.ceil(math.log2(radius)) - 1)  # below the radius, so the farthest point is a centre of its own
            centres, owner = [centre], np.zeros(len(rows), np.int64)
            while True:
                far = int(distance.argmax())
                if distance[far] <= apart:
                    break
                centres.append(int(rows[far]))
                other = self._distance(rows, centres[-1])
                other[far] = 0.0
                nearer = other < distance
                owner[nearer] = len(centres) - 1
                distance[nearer] = other[nearer]
            order = np.argsort(owner, kind="stable")
            edge = np.searchsorted(owner[order], np.arange(len(centres) + 1))
            single, children = [], []
            for k, c in enumerate(centres):
                own = rows[order[edge[k] : edge[k + 1]]]
                if len(own) == 1:
                    single.append(own[0])
                else:
                    self.nodes.append({})
                    children.append(self._ball(own, c) | {"node": len(self.nodes) - 1})
                    todo.append((len(self.nodes) - 1, own, c))
            self.nodes[number] = {"points": np.sort(np.array(single, np.int64)), "children": children}
        return top


class Search:
    """The best ``k`` rows in each score window of each anchor, over any number of trees.

    ``low`` and ``high`` (anchors x windows) are inclusive. ``same`` asks for the anchor's label, else for any other. Rows with the
    anchor's own id are not found. Higher scores come first, of equal ones the smaller id.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.q, self.ids, self.labels, self.low, self.high, self.k, self.same = vectors, ids, labels, low, high, k, same
        self.norm = np.sqrt((vectors * vectors).sum(axis=1).astype(float))
        self.score = np.full((*low.shape, k), _LOWEST)
        self.found = np.full((*low.shape, k), _HIGHEST)
        self.opened = self.verified = 0

    def _wanted(self, tree: CoverTree, ball: dict, active: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, float]:
        """The anchors that may find something in a ball, given the products with its centre, and the best upper bound."""
        if ball["angle"] == 0.0:
            low = high = centre.astype(float)
            exact = centre
        else:
            reach = self.norm[active] * tree.size
            angle = np.arccos(np.clip(centre / np.maximum(reach, 1e-300), -1, 1))
            slack = 1e-9 * reach + 1e-6
            high = reach * np.cos(np.maximum(angle - ball["angle"], 0)) + slack
            low = reach * np.cos(np.minimum(angle + ball["angle"], math.pi)) - slack
            exact = None
        last = self.score[active, :, -1]
        useful = (low[:, None] <= self.high[active]) & (high[:, None] >= self.low[active]) & (high[:, None] >= last)
        if exact is not None:
            useful &= (exact[:, None] > last) | (ball["least"] < self.found[active, :, -1])
        keep = useful.any(axis=1)
        if ball["label"] is not None:
            keep &= (self.labels[active] == ball["label"]) == self.same
        elif self.same:
            keep &= np.isin(self.labels[active], ball["has"])
        return active[keep], float(high[keep].max(initial=-np.inf))

    def _verify(self, tree: CoverTree, points: np.ndarray, active: np.ndarray, score: np.ndarray) -> None:
        self.verified += score.size
        fits = (tree.labels[points][None, :] == self.labels[active][:, None]) == self.same
        fits &= tree.ids[points][None, :] != self.ids[active][:, None]
        for w in range(self.low.shape[1]):
            worth = np.maximum(self.low[active, w], self.score[active, w, -1])
            inside = fits & (score <= self.high[active, w][:, None]) & (score >= worth[:, None])
            some = np.flatnonzero(inside.any(axis=1))
            if not len(some):
                continue
            left = np.where(inside[some], score[some], _LOWEST)
            rows = np.arange(len(some))
            scores, ids = [self.score[active[some], w]], [self.found[active[some], w]]
            for _ in range(min(self.k, len(points))):
                best = left.argmax(axis=1)  # points are sorted by id, so of equal scores the smallest comes first
                value = left[rows, best]
                scores.append(value[:, None])
                ids.append(np.where(value == _LOWEST, _HIGHEST, tree.ids[points][best])[:, None])
                left[rows, best] = _LOWEST
            scores, ids = np.concatenate(scores, axis=1), np.concatenate(ids, axis=1)
            order = np.lexsort((ids, -np.maximum(scores, _LOWEST + 1)), axis=-1)[:, : self.k]
            self.score[active[some], w] = np.take_along_axis(scores, order, 1)
            self.found[active[some], w] = np.take_along_axis(ids, order, 1)

    def run(self, trees: list[CoverTree]) -> None:
        queue: list[tuple] = []
        number = 0
        for tree in trees:
            centre = products(self.q, tree.x[[tree.root["centre"]]])[:, 0]
            active, best = self._wanted(tree, tree.root, np.arange(len(self.q)), centre)
            if len(active):
                heapq.heappush(queue, (-best, number, tree, tree.root, active, centre[active]))
                number += 1
        while queue:
            _, _, tree, ball, active, centre = heapq.heappop(queue)
            active, _ = self._wanted(tree, ball, active, centre)  # more may be known by now
            if not len(active):
                continue
            self.opened += 1
            node = tree.nodes[ball["node"]]
            if len(node["points"]):
                self._verify(tree, node["points"], active, products(self.q[active], tree.x[node["points"]]))
            if node["children"]:
                centres = products(self.q[active], tree.x[[c["centre"] for c in node["children"]]])
                for j, child in enumerate(node["children"]):
                    some, best = self._wanted(tree, child, active, centres[:, j])
                    if len(some):
                        heapq.heappush(queue, (-best, number, tree, child, some, centres[np.searchsorted(active, some), j]))
                        number += 1

    def results(self) -> pa.Table:
        a, w, r = np.nonzero(self.score > _LOWEST)
        return pa.table({"anchor_id": pa.array(self.ids[a]), "at": pa.array(w.astype(np.int32)), "vec_id": pa.array(self.found[a, w, r]), "score": pa.array(self.score[a, w, r])})


# --- jobs ---------------------------------------------------------------------------------------------------------


def whole_numbers(values: pa.Array) -> list[np.ndarray | None]:
    """Vectors as whole numbers, floor(SCALE x); None for vectors that take no part."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = np.diff(values.offsets.to_numpy()) if len(values) else np.zeros(0, np.int64)
    ends = np.r_[0, np.cumsum(size)]
    out = []
    for i in range(len(values)):
        x = flat[ends[i] : ends[i + 1]]
        with np.errstate(over="ignore", invalid="ignore"):
            y = np.floor(SCALE * x)
            out.append(y.astype(np.int64) if np.isfinite(x).all() and float(y @ y) < 2.0**62 else None)
    return out


def _points(pivots: dict[int, np.ndarray]):
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("dim", pa.int32()), ("cell", pa.int32()), ("anchor", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = whole_numbers(batch.column(2))
            keep = np.array([i for i, v in enumerate(vectors) if v is not None], np.int64)
            if not len(keep):
                continue
            dim = np.array([len(vectors[i]) for i in keep])
            cell = np.zeros(len(keep), np.int64)
            for d in np.unique(dim):
                if int(d) in pivots and d:
                    some = np.flatnonzero(dim == d)
                    p = pivots[int(d)]
                    x = np.stack([vectors[keep[i]] for i in some]).astype(float)
                    cell[some] = ((p * p).sum(axis=1)[None, :] - 2 * (x @ p.T)).argmin(axis=1)
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([vectors[i].tobytes() for i in keep], pa.binary()), pa.array(dim.astype(np.int32)), pa.array(cell.astype(np.int32)), batch.column(3).take(at)],
                schema=schema,
            )

    return run


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), dim)


def _tree(table: pa.Table) -> pa.Table:
    """One chunk's tree."""
    table = table.sort_by("vec_id")
    dim = table["dim"][0].as_py()
    tree = CoverTree(_matrix(table["vector"], dim), table["vec_id"].to_numpy(), table["label"].to_numpy())
    return pa.table({"dim": pa.array([dim], pa.int32()), "n": pa.array([table.num_rows], pa.int64()), "tree": pa.array([pickle.dumps(vars(tree))], pa.binary())})


def _searched(k: int, same: bool):
    def run(anchors: pa.Table, chunks: pa.Table) -> pa.Table:
        empty = pa.schema([("anchor_id", pa.int64()), ("at", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]).empty_table()
        if not anchors.num_rows or not chunks.num_rows:
            return empty
        windows = max(len(x) for x in anchors["low"].to_pylist())
        fill = lambda name, value: np.array([[*x, *[value] * (windows - len(x))] for x in anchors[name].to_pylist()], np.int64)
        search = Search(
            _matrix(anchors["vector"], anchors["dim"][0].as_py()), anchors["vec_id"].to_numpy(), anchors["label"].to_numpy(), fill("low", 1), fill("high", 0), k, same
        )
        search.run([CoverTree.of(pickle.loads(x.as_py())) for x in chunks["tree"]])
        return search.results()

    return run


def _search(anchors: DataFrame, trees: DataFrame, blocks: int, ranges: int, k: int, same: bool) -> DataFrame:
    """Every block of anchors (with the columns low and high) against every range of trees."""
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["dim", "block", "range"]
    left = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("range", each(ranges))
    right = trees.withColumn("block", each(blocks))
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_searched(k, same), _FOUND)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of other labels in the positive's window.

    ``vectors`` has vec_id, embedding (array of numbers) and label; other columns are not read. Scores are inner products of floor(256 x); a negative's score n lies in
    the window of a positive's score p when ``low p <= 100 n <= high p``. Higher scores come first, of equal ones the smaller vec_id.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null vec_id, label or vector, or a null or non-finite component take no part, nor do those so long (squared length of 2^62 or more, in steps of 1/256)
    that scores might not fit 64 bits. Vectors are compared with those of as many components only. Rows that share a vec_id count as one, the least label and vector of them. Fewer positives or negatives give
    fewer rows; no rows give none.
    """
    spark = vectors.sparkSession
    usable = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").where(
        "vec_id is not null and label is not null and embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    )
    single = usable.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("r")).select("vec_id", "r.label", "r.embedding", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = materialize(single, "vectors")
    number = rows.count()
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(PIVOTS, math.ceil(number / CHUNK))).select("embedding").collect()
    pivots: dict[int, list] = {}
    for r in some:
        pivots.setdefault(len(r.embedding), []).append(np.floor(SCALE * np.array(r.embedding, float)))
    pivots = {d: x[np.isfinite(x).all(axis=1)] for d, x in ((d, np.stack(x)) for d, x in pivots.items()) if np.isfinite(x).all(axis=1).any()}
    points = materialize(rows.mapInArrow(_points(pivots), _POINTS), "points")
    discard(rows)

    chunks = points.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks"))
    placed = points.join(chunks, ["dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("chunks")))
    grown = materialize(placed.groupBy("dim", "cell", "chunk").applyInArrow(_tree, "dim int, n long, tree binary"), "trees")
    total, anchors = grown.count(), points.where("anchor")
    blocks = max(1, math.ceil(anchors.count() / ANCHORS))
    ranges = max(1, math.ceil(total / RANGE), min(total, math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / blocks)))
    trees = grown.withColumn("range", F.pmod(F.xxhash64("tree"), F.lit(ranges)).cast("int"))

    best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    open_ended = anchors.withColumn("low", F.array(F.lit(_LOWEST + 1))).withColumn("high", F.array(F.lit(_HIGHEST)))
    near = (
        _search(open_ended, trees, blocks, ranges, positives, True)
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= positives)
        .select("anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    near = materialize(near, "positives")

    whole = "decimal(38,0)"
    bound = near.select(
        F.col("anchor_id").alias("vec_id"),
        "place",
        F.expr(f"cast(ceil(cast(positive_score as {whole}) * {low} / 100) as long)").alias("low"),
        F.expr(f"cast(floor(cast(positive_score as {whole}) * {high} / 100) as long)").alias("high"),
    )
    windows = bound.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("w")).select("vec_id", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    inside = Window.partitionBy("anchor_id", "at").orderBy(F.col("score").desc(), "vec_id")
    far = (
        _search(anchors.join(windows, "vec_id"), trees, blocks, ranges, negatives, False)
        .withColumn("rank", F.row_number().over(inside))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", (F.col("at") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    )
    return near.join(far, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
