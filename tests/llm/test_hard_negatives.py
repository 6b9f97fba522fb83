"""Hard negatives against all pairs, the curve, the bounds, and how few blocks are read on clustered vectors."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import hardneg


def plain(rows, anchors, positives=5, negatives=5, percent=80):
    out = []
    for a in anchors:
        label, vector = rows[a]
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, own) for i, (own, v) in rows.items() if i != a and len(v) == len(vector)]
        scored.sort()
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and percent * -minus <= 100 * -s[0] <= 100 * -minus]
            out += [(a, p, n + 1, i, -minus, -s) for n, (s, i, _) in enumerate(fits[:negatives])]
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame([(i, label, v, 7, "x") for i, label, v in rows], "vec_id bigint, label int, vector array<bigint>, block int, score string")


def clustered(rng, n, clusters=12, width=8):
    centres = [[rng.gauss(0, 60) for _ in range(width)] for _ in range(clusters)]
    return [(i, rng.randrange(4), [round(rng.gauss(c, 3)) for c in rng.choice(centres)]) for i in range(n)]


def found_in(frame):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in frame.collect())


@pytest.mark.parametrize("sizes", [(16, 3), (1024, 50)])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, sizes):
    monkeypatch.setattr(hardneg, "BLOCK", sizes[0])
    monkeypatch.setattr(hardneg, "GROUP", sizes[1])
    rng = random.Random(5)
    rows = clustered(rng, 400)
    # Equal vectors, a lone label, other lengths, a null of each kind.
    rows += [(1000 + i, i % 2, [40, -3, 5, 0, 9, 9, -7, 60]) for i in range(60)] + [(2000, 9, [3] * 8)]
    rows += [(3000 + i, i % 3, [rng.randrange(-9, 9) for _ in range(3)]) for i in range(40)] + [(3100 + i, i % 2, []) for i in range(4)]
    odd = [(None, 1, [1] * 8), (4000, None, [1] * 8), (4010, 1, None), (4020, 1, [1, None] * 4)]
    usable = hardneg.usable_rows(table_of(spark, rows + odd + rows[:5] + [(7, 3, [9] * 8), (8, 0, [0] * 8)]).repartition(5))
    data = {r["vec_id"]: (r["label"], list(r["vector"])) for r in usable.collect()}
    assert len(data) == len(rows) and data[8] == min((rows[8][1], rows[8][2]), (0, [0] * 8))
    anchors = [i for i in data if i % 10 == 0]
    found = hardneg.hard_negatives(usable, usable.filter("vec_id % 10 = 0"))
    assert found_in(found) == plain(data, anchors) and found.count() > 200
    few = hardneg.hard_negatives(usable, usable.filter("vec_id % 50 = 0"), positives=2, negatives=1, least_percent=95)
    assert found_in(few) == plain(data, [i for i in data if i % 50 == 0], 2, 1, 95)


def test_no_rows_and_no_anchors(spark):
    usable = hardneg.usable_rows(table_of(spark, [(1, 1, [1, 2]), (2, 2, [1, 1])]))
    assert hardneg.hard_negatives(usable.limit(0), usable.limit(0)).count() == 0
    assert hardneg.hard_negatives(usable, usable.limit(0)).count() == 0
    assert hardneg.hard_negatives(usable, usable).count() == 0


def test_products_that_do_not_fit_are_refused(spark):
    usable = hardneg.usable_rows(table_of(spark, [(1, 1, [2**40, 2**40]), (2, 2, [1, 1])]))
    with pytest.raises(Exception, match="64 bits"):
        hardneg.hard_negatives(usable, usable).count()


def test_few_blocks_are_read_on_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK", 32)
    monkeypatch.setattr(hardneg, "GROUP", 4)
    usable = hardneg.usable_rows(table_of(spark, clustered(random.Random(2), 3000, 40)))
    at = hardneg.placed(usable)
    blocks = hardneg.blocks_of(at)
    part = F.floor(F.col("block") / hardneg.GROUP).cast("bigint").alias("part")
    asking = at.filter("vec_id % 50 = 0").select(part, F.col("vec_id").alias("anchor_id"), "label", "vector", "length")
    limits = [F.lit(x).cast("bigint").alias(c) for x, c in ((0, "slot"), (hardneg._LEAST, "low"), (hardneg._MOST, "high"))]
    _, read = hardneg.best_in_windows(asking.select("*", *limits), blocks, 5, True)
    assert read.count() < 0.1 * blocks.count() * asking.count()


def test_curve_visits_every_point_by_steps_of_one():
    for axes, bits in ((2, 4), (3, 3), (5, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        places = hardneg.hilbert(points, bits)
        assert sorted(places.tolist()) == list(range(1 << bits * axes))
        walk = points[np.argsort(places)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_for_every_vector():
    rng = np.random.default_rng(9)
    anchors, vectors = rng.integers(-50, 50, (7, 6)), rng.integers(-50, 50, (200, 6))
    zones = [vectors[i : i + 20] for i in range(0, 200, 20)]
    low, high = (np.stack([f(z, axis=0) for z in zones]) for f in (np.min, np.max))
    least, most = hardneg.bounds(anchors, low, high)
    for z, zone in enumerate(zones):
        scores = anchors @ zone.T
        assert (least[:, z] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, z]).all()
    large = rng.integers(-(2**30), 2**30, (3, 4))
    assert (hardneg.products(large, large) == large @ large.T).all()
