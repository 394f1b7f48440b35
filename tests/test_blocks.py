"""Neighbourhoods worked out block by block: images wider than a block, and plans without joins of voxels."""

import numpy as np
import pytest

from glimmer.operators import preprocess
from glimmer.operators import stencil as st
from glimmer.operators.preprocess import Shape

KIND = "fov int, round int, channel int, z int, y int, x int, v double"
H, W = 4, 2 * st.SIDE + 90


def image(spark, a):
    return spark.createDataFrame([(0, 1, 2, 0, *map(int, p), float(v)) for p, v in np.ndenumerate(a)], KIND)


def array(df):
    out = np.full((H, W), np.nan)
    for r in df.collect():
        assert np.isnan(out[r.y, r.x]) and (r.fov, r["round"], r.channel, r.z) == (0, 1, 2, 0)
        out[r.y, r.x] = r.v
    return out


def plan_of(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


SHAPE = Shape(H, W)
SCENE = np.random.default_rng(2).random((H, W)) ** 3
OPENED = lambda a, r: st.over_disk(st.over_disk(a, r, False), r, True)
CLOSED = lambda a, r: st.over_disk(st.over_disk(a, r, True), r, False)
WHOLE = {
    "erosion": (lambda v: preprocess.erosion(v, SHAPE, 3), lambda a: st.over_disk(a, 3, False)),
    "dilation": (lambda v: preprocess.dilation(v, SHAPE, 3), lambda a: st.over_disk(a, 3, True)),
    "white_tophat": (lambda v: preprocess.white_tophat(v, SHAPE, 3), lambda a: a - OPENED(a, 3)),
    "black_tophat": (lambda v: preprocess.black_tophat(v, SHAPE, 3), lambda a: CLOSED(a, 3) - a),
    "gaussian": (lambda v: preprocess.gaussian_blur(v, SHAPE, 2.0), lambda a: st.blurred(a, 2.0)),
    "dog": (lambda v: preprocess.difference_of_gaussians(v, SHAPE, 1.0, 3.0), lambda a: np.maximum(st.blurred(a, 1.0) - st.blurred(a, 3.0), 0)),
}


@pytest.mark.parametrize("name", WHOLE)
def test_blocks_equal_the_whole_image(spark, name):
    f, whole = WHOLE[name]
    out = f(image(spark, SCENE))
    assert "Join" not in plan_of(out)
    np.testing.assert_allclose(array(out), whole(SCENE), atol=1e-12)


def test_brightness_grows_from_block_to_block(spark):
    marker, mask = np.zeros((H, W)), np.minimum(0.2 + SCENE, 0.9)
    marker[1, W - 3], mask[:, 100], mask[2, 100] = 1.0, 0.0, 0.5
    want = np.minimum(marker, mask)
    while not np.array_equal(now := np.minimum(st.grown(want), mask), want):
        want = now
    got = array(preprocess.reconstruction(image(spark, marker), image(spark, mask)))
    np.testing.assert_array_equal(got, want)
    assert (got[:, :100] <= 0.5).all() and (got[:, :95] > 0.2).all()


def test_contrast_of_a_wide_image(spark):
    f, r = 2, 4
    small = SCENE.reshape(H // f, f, W // f, f).mean((1, 3))
    top, now = small, st.over_disk(small, 2, False)
    while not np.array_equal(more := np.minimum(st.grown(now), top), now):
        now = more
    p = [np.clip((np.arange(n) + 0.5) / f - 0.5, 0, n // f - 1) for n in (H, W)]
    rows = np.array([np.interp(p[1], np.arange(W // f), row) for row in now])
    d = SCENE - np.array([np.interp(p[0], np.arange(H // f), c) for c in rows.T]).T
    want = np.clip(d + (d - OPENED(d, r)) - (CLOSED(d, r) - d), 0, 1)
    out = preprocess.morpho_reconstruction_contrast(image(spark, SCENE), SHAPE, r, 1 / f)
    assert "Join" not in plan_of(out)
    np.testing.assert_allclose(array(out), want, atol=1e-9)


def test_local_histograms_of_a_wide_image(spark):
    n, tw = 16, -(-W // 4)
    b = np.minimum(np.floor(SCENE * n), n - 1).astype(int)
    cdf = np.zeros((4, 4, n))
    for t in np.ndindex(4, 4):
        c = np.bincount(b[t[0], t[1] * tw : (t[1] + 1) * tw], minlength=n)
        kept = np.minimum(c, max(1.0, 0.05 * c.sum()))
        cdf[t] = (np.cumsum(kept) + (c.sum() - kept.sum()) * np.arange(1, n + 1) / n) / c.sum()
    want = np.zeros((H, W))
    for y, x in np.ndindex(H, W):  # rows are tiles, so only x is blended
        p = (x + 0.5) / tw - 0.5
        low, part = int(np.floor(p)), p - np.floor(p)
        want[y, x] = (1 - part) * cdf[y, max(low, 0), b[y, x]] + part * cdf[y, min(low + 1, 3), b[y, x]]
    out = preprocess.clahe(image(spark, SCENE), SHAPE, 0.05, n, 4)
    assert "Join" not in plan_of(out)
    np.testing.assert_allclose(array(out), want, atol=1e-12)


def test_slices_are_filled_up(spark):
    rows = [(0, 1, 2, 0, 1, W - 1, 0.5), (0, 1, 2, 0, 3, 7, None), (0, 1, 2, 0, H, 0, 9.0), (0, 1, 2, 0, 0, -1, 9.0)]
    out = st.densified(spark.createDataFrame(rows, KIND), H, W)
    want = np.zeros((H, W))
    want[1, W - 1] = 0.5
    assert "Join" not in plan_of(out)
    np.testing.assert_array_equal(array(out), want)
    deep = st.densified(spark.createDataFrame([(0, 1, 2, 1, 0, 0, 0.5), (0, 1, 2, 5, 0, 0, 9.0)], KIND), 2, 3, 2)
    assert sorted((r.z, r.y, r.x, r.v) for r in deep.collect()) == [(z, y, x, 0.5 if (z, y, x) == (1, 0, 0) else 0.0) for z in range(2) for y in range(2) for x in range(3)]


@pytest.mark.parametrize("f", [lambda v: preprocess.clip_percentile(v), lambda v: preprocess.min_max_normalize(v), lambda v: preprocess.robust_normalised(v)])
def test_voxels_are_not_broadcast(spark, f):
    plan = plan_of(f(st.densified(image(spark, SCENE), H, W)))
    assert "BroadcastHashJoin" not in plan and "BuildRight" in plan
