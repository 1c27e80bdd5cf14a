"""Hard negatives against all pairs, and the bounds that prune."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import coordinate_lists as lists

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, positives=5, negatives=5, every=100):
    fit = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for i, v, label in dict.fromkeys((i, tuple(v), label) for i, v, label in fit if i % every == 0):
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in fit]
        best = sorted(s for s in scored if s[2] == label and s[1] != i)[:positives]
        away = sorted(s for s in scored if s[2] != label)
        for p, j, _ in best:
            own = [s for s in away if -80 * p <= -100 * s[0] <= -100 * p][:negatives]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k, _) in enumerate(own, 1)]
    return sorted(out)


def by_spark(spark, rows, every=100):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("shard", F.lit(1))
    found = lists.hard_negatives(df, anchors=F.col("id") % every == 0)
    return sorted(tuple(r) for r in found.collect())


def clusters(seed, n=700, dims=12, lengths=(1.0,), labels=6):
    """Vectors around few directions, so that cosines are high."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(9)] + rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.3])
        v = v / np.linalg.norm(v) * rng.choice(lengths)
        rows.append((i, [float(x) for x in v], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("lengths", [(1.0,), (0.01, 0.1, 1.0, 7.0, 50.0)])
@pytest.mark.parametrize("bucket,values", [(2048, 1 << 22), (16, 600)])
def test_against_all_pairs(spark, monkeypatch, lengths, bucket, values):
    monkeypatch.setattr(lists, "SHARD_VALUES", values)
    monkeypatch.setattr(lists, "BLOCK_VALUES", 60)
    rows = clusters(len(lengths), lengths=lengths)
    assert by_spark(spark, rows, every=50) == by_hand(rows, every=50) != []


def test_rows_that_take_no_part_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 1), (3, [0.0, 0.0], 1), (4, [-1.0, 0.0], 1),
        (5, [0.9, 3.0], 2), (6, [0.9, 3.0], 2), (7, [0.9], 2), (8, [0.45, 9.0], 2), (9, [1.0, 0.0], 2),
        (10, [], 2), (11, None, 2), (12, [None, 1.0], 2), (13, [nan, 1.0], 2), (14, [inf, 1.0], 2),
        (15, [0.9, 0.0], None), (None, [0.9, 0.0], 2), (16, [0.9, 1.0, 5.0], 3), (17, [0.9, 0.0], 3),
        (100, [0.0, 0.0], 4), (200, [], 5), (300, None, 5), (400, [1.0, 1.0], None), (500, [1.0, 0.0], 6),
    ]
    found = by_spark(spark, rows)
    assert found == by_hand(rows)
    assert [r[3] for r in found if r[:2] == (0, 1)] == [9, 500, 5, 6, 7]
    copies = rows + [rows[0], rows[5], rows[5]]
    assert by_spark(spark, copies) == by_hand(copies)


def test_one_label_and_one_copy_hold_most_rows(spark, monkeypatch):
    monkeypatch.setattr(lists, "SHARD_VALUES", 400)
    rows = clusters(5, 300)
    rows += [(1000 + i, rows[7][1], 2) for i in range(400)] + [(7, rows[7][1], 2)] * 200
    assert by_spark(spark, rows) == by_hand(rows)


def test_whole_numbers_beyond_doubles_are_exact():
    rng = random.Random(3)
    rows = [[rng.randrange(-(1 << 30), 1 << 30) for _ in range(5)] for _ in range(6)]
    exact = [[sum(a * b for a, b in zip(r, s)) for s in rows] for r in rows]
    assert lists.products(np.array(rows, float), np.array(rows, float)).tolist() == exact
    with pytest.raises(OverflowError):
        lists.products(np.full((1, 4), 2.0**40), np.full((1, 4), 2.0**40))


def test_ranges_hold_every_row_and_leave_most_out():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(2000, 16))
    vectors[:40] = vectors[40] + rng.normal(size=(40, 16)) * 0.1
    lengths = np.linalg.norm(vectors, axis=1)
    order = np.argsort(-lengths)
    vectors, lengths = np.floor(vectors[order] * 1000), lengths[order]
    lengths = np.linalg.norm(vectors, axis=1)
    order = np.argsort(-lengths)
    bucket = lists.Bucket(vectors[order], lengths[order])
    anchors = bucket.vectors[:300]
    reach = np.linalg.norm(anchors, axis=1)
    scores = lists.products(bucket.vectors, anchors)
    for share in (-0.5, 0.0, 0.3, 0.9, 0.99):
        bounds = share * reach * bucket.longest
        met = {i: dict(zip(rows.tolist(), own.tolist())) for i, rows, own in bucket.reach(anchors, reach, bounds)}
        for i in range(len(anchors)):
            for row in np.flatnonzero(scores[:, i] >= bounds[i]):
                assert met[i][row] == scores[row, i]
        if share >= 0.99:
            assert sum(map(len, met.values())) < 0.1 * len(anchors) * len(vectors)
