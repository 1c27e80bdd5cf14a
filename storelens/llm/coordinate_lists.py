"""Hard negatives by inner product, with length buckets and sorted coordinates.

Components become whole numbers, floor(scale * x), so scores are exact. Per anchor
its best rows of the same label are positives; per positive the best rows of
another label, scored from ``low`` to ``high`` per cent of it, are its negatives.

Rows are dealt by length to shards of bounded size, anchors to blocks of bounded
size; a shard and a block meet in one task. There the shard is sorted by length
and cut into buckets. Whoever needs a score of t and a row of a bucket, whose
longest row measures l, must have a cosine of t / (length of the anchor * l) at
least: above 1 the bucket is skipped. Otherwise the cosine bounds every coordinate
of the row: with the anchor's coordinate a = cos x and the cosine cos y, to
cos(x + y) .. cos(x - y). For the anchor's largest coordinates, the focus, these
ranges are looked up in the bucket's sorted coordinate lists; the shortest list is
intersected with the ranges of the others, and what remains is multiplied out. An
anchor whose shortest list holds most of the bucket is multiplied with all of it,
together with others like it. The bound t rises with what the earlier buckets of
the shard gave.

Two passes: the positives first, then the negatives with the positives' scores as
bounds, for which an anchor is only sent to the shards long enough to reach them.
A shard returns a few rows an anchor, and the best of these are taken overall.

The search is exact. Rows with a null id, label, vector or component, or with one
that isn't finite, take no part. Other ids than the anchor's own are its other
rows; every row stands for itself, so a repeated row may come up repeatedly, but a
repeated anchor row is one anchor. Ties go to the smaller id. Of vectors of
different length, the missing components count as 0. Scores are longs; a larger
one ends the job. Columns other than the three named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.frames import prepared, rows_as, stage

#: Components a shard and a block of anchors hold at most, rows of a bucket.
SHARD_VALUES, BLOCK_VALUES, BUCKET_ROWS = 1 << 22, 1 << 20, 2048

#: Rows of a length class differ by this factor at most.
CLASS_RATIO = 1.1

#: How many coordinates of an anchor are looked up.
FOCUS = 4

#: Of a bucket, the share above which a list is no help.
DENSE = 0.4

#: Anchors multiplied with a whole bucket at a time.
TOGETHER = 256

_EXACT = float(1 << 53)
_SLACK = 1e-9  # of the bounds, for rounding


def matrix(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    """The vectors as whole numbers, one a row, short ones filled up with zeros."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(values * scale)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all anchors, as whole numbers."""
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    longest = [np.sqrt(np.square(m).sum(axis=1).max(initial=0)) for m in (rows, anchors)]
    if longest[0] * longest[1] < _EXACT:
        return (rows @ anchors.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (rows, anchors)]
    found = whole[0] @ whole[1].T
    return found.astype(np.int64)  # raises beyond a long


class Bucket:
    """Rows of like length with a sorted list per coordinate."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray):
        self.vectors = vectors
        self.longest = float(lengths[0])
        with np.errstate(invalid="ignore"):
            self.unit = np.where(lengths[:, None] > 0, vectors / lengths[:, None], 0.0)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The values of a coordinate in order, and their rows."""
        if f not in self._lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = self.unit[order, f], order
        return self._lists[f]

    def feasible(self, units: np.ndarray, cosines: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each anchor its focus coordinates, and per coordinate the range of
        values and of places in the sorted list."""
        width = min(units.shape[1], self.unit.shape[1])
        size = min(FOCUS, width)
        focus = np.argpartition(-np.abs(units[:, :width]), size - 1, axis=1)[:, :size]
        x = np.arccos(np.clip(np.take_along_axis(units, focus, axis=1), -1, 1))
        y = np.arccos(np.clip(cosines, -1, 1))[:, None]
        low = np.where(x + y >= np.pi, -1.0, np.cos(np.minimum(x + y, np.pi))) - _SLACK
        high = np.where(x <= y, 1.0, np.cos(np.maximum(x - y, 0.0))) + _SLACK
        first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            here = focus == f
            values, _ = self.sorted_list(int(f))
            first[here] = np.searchsorted(values, low[here], "left")
            last[here] = np.searchsorted(values, high[here], "right")
        return focus, low, high, first, last

    def reach(self, anchors: np.ndarray, lengths: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
        """(anchor, rows, scores), with every row of the bucket that reaches the
        anchor's bound among the rows."""
        everything = np.arange(len(self.vectors))
        with np.errstate(divide="ignore", invalid="ignore"):
            cosines = bounds / (lengths * self.longest)
        # bounds of 0 and below say nothing about a direction, nor does no length
        open_ = (bounds <= 0) | np.isnan(cosines)
        some = np.flatnonzero(~open_ & (cosines <= 1 + _SLACK))
        dense = list(np.flatnonzero(open_))
        if len(some) and self.unit.shape[1] and anchors.shape[1]:
            units = anchors[some] / lengths[some, None]
            focus, low, high, first, last = self.feasible(units, cosines[some] - _SLACK)
            sizes = last - first
            shortest = sizes.argmin(axis=1)
            for at, i in enumerate(some):
                s = shortest[at]
                if sizes[at, s] > DENSE * len(everything):
                    dense.append(i)
                    continue
                rows = self.sorted_list(int(focus[at, s]))[1][first[at, s] : last[at, s]]
                for g in range(focus.shape[1]):
                    if g != s and len(rows):
                        values = self.unit[rows, focus[at, g]]
                        rows = rows[(values >= low[at, g]) & (values <= high[at, g])]
                if len(rows):
                    yield i, rows, products(self.vectors[rows], anchors[i : i + 1])[:, 0]
        for start in range(0, len(dense), TOGETHER):
            group = dense[start : start + TOGETHER]
            scores = products(self.vectors, anchors[group])
            for at, i in enumerate(group):
                yield i, everything, scores[:, at]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, of equal ones the smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class _Leaders:
    """The k best (score, id) of each of several searches."""

    def __init__(self, n: int, k: int, bounds: np.ndarray):
        self.k = k
        self.bounds = bounds.astype(np.float64)  # what a row has to reach at least
        self.scores = [np.zeros(0, np.int64) for _ in range(n)]
        self.ids = [np.zeros(0, np.int64) for _ in range(n)]

    def offer(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[i], scores])
        ids = np.concatenate([self.ids[i], ids])
        best = _best(scores, ids, self.k)
        self.scores[i], self.ids[i] = scores[best], ids[best]
        if len(best) == self.k:
            self.bounds[i] = max(self.bounds[i], float(scores[best[-1]]))


def _columns(table: pa.Table, scale: float) -> tuple[np.ndarray, ...]:
    """Ids, labels, vectors and lengths, longest rows first."""
    vectors = matrix(table.column("vector"), scale)
    lengths = np.sqrt(np.square(vectors).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    plain = [table.column(c).to_numpy()[order] for c in ("id", "label")]
    return *plain, vectors[order], lengths[order]


def _search(positives: int, negatives: int, low: int, high: int, scale: float, first_pass: bool):
    def run(rows: pa.Table, block: pa.Table) -> pa.Table:
        ids, labels, vectors, lengths = _columns(rows, scale)
        anchors = matrix(block.column("vector"), scale)
        reach = np.sqrt(np.square(anchors).sum(axis=1))
        own_ids, own_labels = (block.column(c).to_numpy() for c in ("id", "label"))
        n = len(anchors)
        # of the first pass one search an anchor, of the second one a positive
        if first_pass:
            owner, wanted = np.arange(n), None
            leaders = _Leaders(n, positives, np.full(n, -np.inf))
        else:
            scores = block.column("scores").to_pylist()
            owner = np.repeat(np.arange(n), [len(s) for s in scores])
            wanted = [score for own in scores for score in own]
            leaders = _Leaders(len(owner), negatives, np.array([-(-low * w // 100) for w in wanted], np.float64))
        searches = np.split(np.arange(len(owner)), np.searchsorted(owner, np.arange(1, n))) if n else []
        for start in range(0, len(ids) if n else 0, BUCKET_ROWS):
            part = slice(start, start + BUCKET_ROWS)
            bucket, part_ids, part_labels = Bucket(vectors[part], lengths[part]), ids[part], labels[part]
            bounds = np.array([leaders.bounds[s].min() for s in searches])
            for i, found, scores in bucket.reach(anchors, reach, bounds):
                same = part_labels[found] == own_labels[i]
                if first_pass:
                    fit = same & (part_ids[found] != own_ids[i]) & (scores >= leaders.bounds[i])
                    if fit.any():
                        leaders.offer(i, scores[fit], part_ids[found][fit])
                    continue
                fit = ~same & (scores >= bounds[i])
                scores, found = scores[fit], part_ids[found][fit]
                for s in searches[i] if len(scores) else ():
                    # bounds are whole and start at the least score allowed
                    near = (scores >= leaders.bounds[s]) & (scores <= high * wanted[s] // 100)
                    if near.any():
                        leaders.offer(s, scores[near], found[near])
        sizes = [len(s) for s in leaders.scores]
        place = np.concatenate([np.arange(len(s)) for s in searches]) if n else np.zeros(0, np.int64)
        keys = block.column("anchor").to_numpy()
        return pa.table(
            {
                "anchor": pa.array(np.repeat(keys[owner], sizes), pa.int64()),
                "place": pa.array(np.repeat(place, sizes), pa.int32()),
                "id": pa.array(np.concatenate([np.zeros(0, np.int64), *leaders.ids]), pa.int64()),
                "score": pa.array(np.concatenate([np.zeros(0, np.int64), *leaders.scores]), pa.int64()),
            }
        )

    return run


def _numbered(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows per key with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``anchors`` is a condition on ``id``: which rows to search for."""
    spark = prepared(rows.sparkSession)
    base = rows_as(rows, id=id_col, label=label_col, vector=vector_col).withColumn("id", F.col("id").cast("long"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    base = base.where("id is not null and label is not null and vector is not null").where(~bad)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale), F.lit(2)))
    length = F.sqrt(square)
    step = float(np.log(CLASS_RATIO))
    klass = F.when(length > 0, F.floor(F.log(length) / step)).otherwise(-1).cast("long")
    sized = base.withColumn("length", length).withColumn("class", klass)

    # as many rows as ratios fit into the range of a double, whatever the input
    classes = sized.groupBy("class").agg(
        F.count("*").alias("n"), F.max("length").alias("longest"), F.max(F.size("vector")).alias("width")
    ).collect()
    chosen = stage(
        base.where(anchors).distinct().withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors"
    )
    n_anchors = chosen.count()
    result = "anchor long, place int, id long, score long"
    classes = classes or [{"class": -1, "n": 1, "longest": 0.0, "width": 1}]
    width = max([1, *(c["width"] for c in classes)])
    total = sum(c["n"] for c in classes)
    size = max(1, min(SHARD_VALUES // width, max(256, -(-total // (2 * spark.sparkContext.defaultParallelism)))))
    blocks = max(1, -(-n_anchors * width // BLOCK_VALUES))
    dealt, shards = [], []
    for c in classes:
        parts = -(-c["n"] // size)
        dealt.append((c["class"], len(shards), parts))
        shards += [c["longest"]] * parts
    dealing = spark.createDataFrame(dealt, "class long, first long, parts long")
    # a row's shard may be any of its class; the running id is the same after a retry
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts"))
    data = (
        sized.join(F.broadcast(dealing), "class")
        .select("id", "label", "vector", (F.col("first") + spread).alias("shard"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")
    every = F.explode(F.expr(f"sequence(0L, {len(shards) - 1}L)"))

    def meet(searching: DataFrame, first_pass: bool) -> DataFrame:
        run = _search(positives, negatives, low, high, scale, first_pass)
        keys = ["shard", "block"]
        return data.groupBy(*keys).cogroup(searching.groupBy(*keys)).applyInArrow(run, result)

    searching = chosen.withColumn("block", block).withColumn("shard", every)
    found = _numbered(meet(searching, True), ["anchor"], positives)
    pairs = stage(found.select("anchor", "rank", "id", "score"), "negatives-positives")

    # below 0 the lower bound lies above the upper one
    usable = pairs.where("score >= 0").groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p")
    )
    needed = chosen.join(usable, "anchor").withColumn("length", length)
    least = F.array_min(F.col("p.score")) * (low / 100)
    # class by class, whose shards have the same length
    long_enough = [
        F.when(
            F.col("length") * c["longest"] * (1 + _SLACK) + _SLACK >= least, F.expr(f"sequence({f}L, {f + p - 1}L)")
        ).otherwise(F.expr("cast(array() as array<bigint>)"))
        for (_, f, p), c in zip(dealt, classes)
    ]
    searching = needed.select(
        "anchor", "id", "label", "vector", F.col("p.score").alias("scores"), block.alias("block"),
        F.explode(F.concat(*long_enough)).alias("shard"),
    )
    found = _numbered(meet(searching, False), ["anchor", "place"], negatives)
    ranked = usable.select("anchor", F.posexplode("p.rank").alias("place", "positive"))
    positive = pairs.select(
        "anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    own = chosen.select("anchor", F.col("id").alias("anchor_id"))
    return (
        found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(ranked, ["anchor", "place"])
        .join(positive, ["anchor", "positive"])
        .join(own, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
