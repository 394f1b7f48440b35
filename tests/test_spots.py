"""Queries about spots on keys of large tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glimmer.operators import extract
from glimmer.plans.queries import QUERIES

ITEM = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_returnflag string, l_linestatus string"


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    """A folder with 240 line items of 48 orders; half of the orders have keys as in tables of 6 GB, whose spots' numbers take more
    than 64 bits, and lie where the others do."""
    rng = np.random.default_rng(6)
    rows = []
    for o in range(24):
        for k in range(5):
            part, supplier, rest = int(rng.integers(0, 23)), int(rng.integers(1, 9)), (k + 1, float(rng.integers(1, 11)), "RAN"[int(rng.integers(3))], "FO"[int(rng.integers(2))])
            rows += [(o, part, supplier, *rest), (o + 44_100_000, part + 20160, supplier, *rest)]
    d = str(tmp_path_factory.mktemp("far"))
    spark.createDataFrame(rows, ITEM).write.parquet(f"{d}/lineitem.parquet")
    return d, rows


def numbers(rows):
    return {((o * 10**6 + p) * 10**5 + s) * 10 + n for o, p, s, n, *_ in rows}


@pytest.mark.parametrize(("name", "keys"), [("map_coords", ("fov", "spot_id", "round")), ("map_coords_flow", ("fov", "spot_id", "round")), ("box_sum", ("fov", "spot_id", "round", "channel")), ("spot_crop", ("fov", "spot_id", "round", "channel", "oy", "ox")), ("intensity_table", ("fov", "spot_id", "round_idx", "chan_idx"))])
def test_spots_of_far_keys_are_all_there(spark, far, name, keys):
    d, rows = far
    got = QUERIES[name](spark, d).collect()
    small = {n for n in numbers(rows) if n < 2**63}
    assert len(numbers(rows)) == 240 and len(small) == 120 and {r.spot_id for r in got if r.spot_id >= 0} <= small
    seen = [tuple(r[k] for k in keys) for r in got]
    assert len(set(seen)) == len(seen)
    # the orders of large keys lie as those of small ones do
    values = [sorted(tuple(r[c] for c in sorted(r.asDict()) if c != "spot_id") for r in got if (r.spot_id < 0) == negative) for negative in (True, False)]
    assert len(values[0]) > 50 and values[0] == values[1]


def test_traces_of_far_keys(spark, far):
    got = QUERIES["spot_traces"](spark, far[0]).collect()
    assert len({(r.fov, r.spot_id) for r in got}) == 5 and len(got) == 30


def test_each_crop_is_looked_up_where_its_spot_is(spark):
    """Radius 3 over edges of segments, with voxels before 0, against all pairs; a spot is one row until it has met its lines."""
    rng = np.random.default_rng(7)
    at = {tuple(map(int, p)): float(v) for p, v in zip(rng.integers([0, 0, -3, -4], [2, 3, 12, 40], (900, 4)), rng.integers(1, 200, 900))}
    voxels = spark.createDataFrame([(0, 1, *k, v) for k, v in at.items()], "fov int, round int, channel int, z int, y int, x int, v double")
    places = rng.integers([0, 0, 0], [3, 10, 36], (40, 3)) + rng.choice([0.0, 0.5, 0.4], (40, 3))
    points = spark.createDataFrame([(0, k, 1, *map(float, p)) for k, p in enumerate(places)], "fov int, spot_id long, round int, pz double, py double, px double")
    want = {}
    for k, p in enumerate(places):
        z0, y0, x0 = (round(c) for c in p)
        for (c, z, y, x), v in at.items():
            if abs(z - z0) <= 1 and abs(y - y0) <= 3 and abs(x - x0) <= 3:
                key = (k, c, y - y0, x - x0)
                want[key] = max(v, want.get(key, 0.0))
    out = extract.spot_crop(points, voxels, 3)
    assert {tuple(r): v for *r, v in out.select("spot_id", "channel", "oy", "ox", "v").collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Join Inner")
    assert out.agg(F.count("*")).first()[0] == len(want)
