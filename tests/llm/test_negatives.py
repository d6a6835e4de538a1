"""Hard negatives against a plain loop."""

import math
import random

import pytest

from pyspark.sql import functions as F

from shelfdiff.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score double, tile int, place long, row string"


def vectors(seed=0, n=240):
    """Rows in a few directions, so that scores tie; with awkward ones."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        v = [round(r.gauss(0.3 * (i % 4 == k), 0.4), 1) for k in range(6)]
        out.append((i, v, r.randrange(3)))
    out[60] = (60, out[50][1], out[50][2])  # an equal vector
    inf, nan = math.inf, math.nan
    out += [(400, None, 1), (401, [0.1, None, 0.2, 0.1, 0.1, 0.1], 1), (402, [nan] * 6, 1), (403, [inf] * 6, 1)]
    out += [(404, [0.5] * 6, None), (405, [], 1), (450, [0.4, 0.2], 2), (406, [0.4] * 9, 0), (None, [0.4] * 6, 1)]
    out += [(500, [0.0] * 6, 1), (550, [-0.5, 0.1, -0.5, 0.1, 0.1, -0.4], 9), (551, [0.5] * 6, 9)]
    out += [out[3], out[3], out[100]]  # repeated rows, an anchor among them
    return [(*x, 1.5, 2, 3, "x") for x in out]


def plain(data, positives=5, negatives=3):
    rows = []
    for i, v, label, *_ in data:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            rows.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for k, (i, v, label) in enumerate(rows):
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, own == label) for n, (j, w, own) in enumerate(rows) if n != k]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        for p, j, _ in [x for x in scored if x[2]][:positives]:
            fit = [x for x in scored if not x[2] and 50 * p <= 100 * x[0] <= 95 * p]
            out += [(i, j, rank, x[1], p, x[0]) for rank, x in enumerate(fit[:negatives], 1)]
    return sorted(map(str, out))


def as_floats(data):
    import numpy as np

    return [(x[0], None if x[1] is None else [None if c is None else float(np.float32(c)) for c in x[1]], *x[2:]) for x in data]


@pytest.mark.parametrize("tile_rows", [7, 1000])
def test_negatives_equal_a_plain_loop(spark, tile_rows):
    data = vectors()
    rows = spark.createDataFrame(data, SCHEMA).repartition(3)
    found = hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, tile_rows=tile_rows).collect()
    assert sorted(str(tuple(x)) for x in found) == plain(as_floats(data))
    assert len(found) > 60


def test_few_rows_and_none(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty, F.col("vec_id") % 50 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0], 1, *[None] * 4), (1, [0.9], 1, *[None] * 4), (2, [0.8], 2, *[None] * 4)], SCHEMA)
    assert [tuple(x) for x in hard_negatives.mine(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 2, 58880, 52224)]
    assert hard_negatives.mine(few, F.lit(False)).count() == 0


def test_large_components_stay_exact(spark):
    data = [(0, [2.0**20, 1.0], 1), (1, [2.0**20, 0.5], 1), (2, [2.0**19, 1.0], 2), (3, [2.0**19, 0.996], 2)]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    found = hard_negatives.mine(rows, F.col("vec_id") == 0).collect()
    assert [tuple(x) for x in found] == [(0, 1, 1, 2, 2**56 + 2**15, 2**55 + 2**16), (0, 1, 2, 3, 2**56 + 2**15, 2**55 + 256 * 254)]
    huge = spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="do not fit a long"):
        hard_negatives.mine(huge, F.col("vec_id") == 0).collect()
