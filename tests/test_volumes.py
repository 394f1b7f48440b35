"""Shifts, fields, blobs, graphs and rescue against brute force."""

import itertools
import math
import random

import numpy as np
import pytest

from glimmer.operators import decode, extract, field, graph, preprocess, pyramid, register, spots
from glimmer.operators.preprocess import Shape

KIND = "fov int, round int, z int, y int, x int, v double"


def volume(spark, a, rnd=1, fov=0):
    return spark.createDataFrame([(fov, rnd, *map(int, p), float(v)) for p, v in np.ndenumerate(a) if v], KIND) if a.any() else spark.createDataFrame([], KIND)


def dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.z, r.y, r.x] = r.v
    return out


def plan_of(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


# shifts


@pytest.mark.parametrize("shift", [(4, 150, -90), (-3, -60, 201), (0, 0, 0)])
def test_a_long_shift_is_found(spark, shift):
    size, rng = (12, 400, 400), np.random.default_rng(5)
    scene = rng.integers([-12, -400, -400], [24, 800, 800], (9000, 3))
    bright = rng.integers(1, 9, len(scene)).astype(float)
    rows = []
    for rnd, d in ((1, (0, 0, 0)), (2, shift)):
        p = scene + np.array(d)
        rows += [(0, rnd, *map(int, q), float(b)) for q, b in zip(p, bright) if all(0 <= c < n for c, n in zip(q, size))]
    sizes = dict(zip("zyx", size))
    got = pyramid.pyramid_shift(spark.createDataFrame(rows, KIND), 1, sizes).collect()
    assert len(got) == 1 and np.allclose((got[0].dz, got[0].dy, got[0].dx), [-d for d in shift], atol=0.1)
    assert got[0].suspect == (math.dist(shift, (0, 0, 0)) > 200)
    levels = pyramid.block_sizes(sizes, 2000)
    assert math.prod(-(-n // levels[-1][c]) for c, n in sizes.items()) <= 2000 and levels[0] == {"z": 1, "y": 1, "x": 1}


def test_parts_of_a_pixel(spark):
    y = np.arange(40)
    bump = lambda c: np.exp(-((y[:, None] - c - 20) ** 2 + (y[None, :] - 20) ** 2) / 8)
    both = volume(spark, bump(0)[None]).unionByName(volume(spark, bump(2.4)[None], 2))
    got = pyramid.pyramid_shift(both, 1, {"z": 1, "y": 40, "x": 40}, most_offsets=100).first()
    assert (got.dz, got.dy, got.dx) == (0.0, pytest.approx(-2.4, abs=0.1), 0.0) and got.score > 0.7


def test_no_common_voxels(spark):
    a = np.zeros((1, 8, 8))
    a[0, 1, 1] = 1
    assert pyramid.pyramid_shift(volume(spark, a), 1, {"z": 1, "y": 8, "x": 8}).count() == 0


# rescue


@pytest.mark.parametrize(("weights", "most", "gap"), [(None, 1.0, 0.5), ([1.0, 0.5, 2.0, 0.25, 1.0], 1.5, 0.5), ([1.0, 0.0, 1.0, 1.0, 3.0], 2.0, 0.0), (None, 9.0, 1.0), (None, 0.0, 1.0)])
def test_rescue_equals_all_distances(spark, weights, most, gap):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("0123") for _ in range(5))
    codes = sorted({word() for _ in range(25)})
    codes.append(codes[3])  # one code twice: no gap
    book = spark.createDataFrame([(k, c, f"g{k}") for k, c in enumerate(codes)], "code_ix int, barcode string, gene string")
    seen = [word() for _ in range(300)] + ["", "01", "abcde", codes[0]]
    got = decode.rescue_table(spark.createDataFrame([(s,) for s in seen], "barcode string"), book, most, gap, weights)
    want, ws = set(), weights or [1.0] * 5
    for s in set(seen):
        if len(s) == 5 and s.isdigit():
            d = sorted((sum(w for a, b, w in zip(s, c, ws) if a != b), k) for k, c in enumerate(codes))
            if d[0][0] <= most and d[1][0] - d[0][0] >= gap:
                want.add((s, f"g{d[0][1]}", d[0][0], d[1][0] - d[0][0]))
    assert {tuple(r) for r in got.select("barcode", "new_gene", "distance", "gap").collect()} == want and (want or most == 0.0)


def test_codes_are_looked_up_by_equality(spark):
    book = spark.createDataFrame([(0, "01230", "a")], "code_ix int, code string, new_gene string")
    seen = spark.createDataFrame([("01231",)], "barcode string")
    plan = plan_of(decode.codes_within(seen, book, [1.0] * 5, 2.0))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert len(decode.masks_within([1.0] * 5, 2.0)) == 10 and decode.masks_within([1.0, 1.0], -1.0) == [()]


# fields


def test_tiles_find_their_offset(spark):
    rng = np.random.default_rng(3)
    a = rng.random((5, 22, 19)) * (rng.random((5, 22, 19)) < 0.6)
    d = (1, -2, 1)
    b = np.zeros_like(a)
    for p, v in np.ndenumerate(a):
        q = tuple(np.add(p, d))
        if all(0 <= c < n for c, n in zip(q, a.shape)):
            b[q] = v
    b += 0.01 * rng.random(b.shape)
    mask = rng.random(a.shape) < 0.9
    places = volume(spark, mask.astype(float)).select("fov", "z", "y", "x")
    tile, reach, size = {"z": 3, "y": 8, "x": 8}, {"z": 1, "y": 2, "x": 2}, dict(zip("zyx", a.shape))
    got = {(r.gz, r.gy, r.gx): (r.dz, r.dy, r.dx, r.r) for r in field.block_matched(volume(spark, a).unionByName(volume(spark, b, 2)), 1, tile, reach, size, places).collect()}
    own = a * mask
    for g in itertools.product(range(2), range(3), range(3)):
        box = tuple(slice(k * t, min((k + 1) * t, n)) for k, t, n in zip(g, tile.values(), a.shape))
        best = None
        for o in itertools.product(range(-1, 2), range(-2, 3), range(-2, 3)):
            moved = np.zeros_like(own[box])
            for p in np.ndindex(moved.shape):
                q = tuple(s.start + k + e for s, k, e in zip(box, p, o))
                moved[p] = b[q] if all(0 <= c < n for c, n in zip(q, b.shape)) else 0.0
            r = round(np.corrcoef(own[box].ravel(), moved.ravel())[0, 1], 9)
            key = (r, -sum(e * e for e in o), o)
            best = max(best, key) if best else key
        assert got[g][:3] == tuple(map(float, best[2])) and got[g][3] == pytest.approx(best[0], abs=2e-9)
    assert len(got) == 18 and sum(v[:3] == d for v in got.values()) >= 12


def test_gaps_are_filled_and_pull_nothing(spark):
    rng = np.random.default_rng(4)
    counts = {"z": 2, "y": 4, "x": 5}
    nodes = [g for g in np.ndindex(2, 4, 5) if rng.random() < 0.6]
    flat = spark.createDataFrame([(0, 2, *g, 0.5, -1.0, 2.0) for g in nodes], "fov int, round int, gz int, gy int, gx int, dz double, dy double, dx double")
    got = field.smoothed_nodes(flat, 1.0, counts).collect()
    assert len(got) == 40 and all(np.allclose((r.dz, r.dy, r.dx), (0.5, -1.0, 2.0)) for r in got)
    values = {g: rng.random(3) for g in nodes}
    bent = spark.createDataFrame([(0, 2, *g, *map(float, v)) for g, v in values.items()], flat.schema)
    want = {}
    for g in np.ndindex(2, 4, 5):
        w = {h: math.exp(-sum((a - b) ** 2 for a, b in zip(g, h)) / 2) for h in values if max(abs(a - b) for a, b in zip(g, h)) <= 3}
        want[g] = sum(w[h] * values[h] for h in w) / sum(w.values())
    for r in field.smoothed_nodes(bent, 1.0, counts).collect():
        assert np.allclose((r.dz, r.dy, r.dx), want[r.gz, r.gy, r.gx])
    # a volume reduced by two in y and x: its field is half as long and half as far apart
    places = spark.createDataFrame([(0, 2, 0.0, 7.5, 11.5)], "fov int, round int, z double, y double, x double")
    r = field.upscaled(flat, places, {"z": 1, "y": 2, "x": 2}, counts, 1.0, {"y": 2.0, "x": 2.0}).first()
    assert np.allclose((r.fz, r.fy, r.fx), (0.5, -2.0, 4.0))


def trilinear(a, p):
    low, total = np.floor(p).astype(int), 0.0
    for o in itertools.product((0, 1), repeat=3):
        q = low + o
        if all(0 <= c < n for c, n in zip(q, a.shape)):
            total += a[tuple(q)] * np.prod([x - l if k else 1 - (x - l) for x, l, k in zip(p, low, o)])
    return total


def test_values_between_voxels(spark):
    rng = np.random.default_rng(6)
    a = rng.random((3, 5, 35)) * (rng.random((3, 5, 35)) < 0.7)
    p = rng.uniform(-1.5, [3.5, 5.5, 35.5], (400, 3))
    points = spark.createDataFrame([(0, 1, k, *map(float, q)) for k, q in enumerate(p)], "fov int, round int, k int, z double, y double, x double")
    df = field.interpolated(points, volume(spark, a), ["k"])
    got = {r.k: r.v for r in df.collect()}
    want = {k: t for k, q in enumerate(p) if (t := trilinear(a, q))}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_shift_then_warp(spark):
    rng = np.random.default_rng(7)
    a, shift = rng.random((2, 6, 18)), (0.5, -1.0, 2.25)
    f = {p: rng.uniform(-1, 1, 3) for p in np.ndindex(a.shape)}
    places = spark.createDataFrame([(0, 1, *p, *map(float, d)) for p, d in f.items()], "fov int, round int, z int, y int, x int, fz double, fy double, fx double")
    shifts = spark.createDataFrame([(0, 1, *shift)], "fov int, round int, dz double, dy double, dx double")
    moved = np.array([trilinear(a, np.subtract(p, shift)) for p in np.ndindex(a.shape)]).reshape(a.shape)
    want = np.array([trilinear(moved, np.add(p, f[p])) for p in np.ndindex(a.shape)]).reshape(a.shape)
    got = field.transformed(volume(spark, a), shifts, places, {"z": 2, "y": 6, "x": 18})
    assert np.allclose(dense(got, a.shape), want)


# cleaning


def equalised(a, limit, nbins, tiles):
    h, w = a.shape
    th, tw = -(-h // tiles), -(-w // tiles)
    ny, nx = -(-h // th), -(-w // tw)
    b = np.minimum(np.floor(np.clip(a, 0, 1) * nbins), nbins - 1).astype(int)
    curves = {}
    for t in np.ndindex(ny, nx):
        n = np.bincount(b[t[0] * th : (t[0] + 1) * th, t[1] * tw : (t[1] + 1) * tw].ravel(), minlength=nbins).astype(float)
        kept = np.minimum(n, max(1.0, limit * n.sum()))
        curves[t] = (np.cumsum(kept) + (n.sum() - kept.sum()) * np.arange(1, nbins + 1) / nbins) / n.sum()
    out = np.zeros_like(a)
    for y, x in np.ndindex(h, w):
        py, px = (y + 0.5) / th - 0.5, (x + 0.5) / tw - 0.5
        y0, x0 = math.floor(py), math.floor(px)
        for i, j in itertools.product((0, 1), repeat=2):
            weight = (py - y0 if i else 1 - py + y0) * (px - x0 if j else 1 - px + x0)
            out[y, x] += weight * curves[min(max(y0 + i, 0), ny - 1), min(max(x0 + j, 0), nx - 1)][b[y, x]]
    return out


@pytest.mark.parametrize(("shape", "tiles"), [((17, 23), 4), ((6, 5), 1), ((9, 9), 3)])
def test_local_histograms(spark, shape, tiles):
    a = np.random.default_rng(8).random(shape) ** 2
    rows = [(0, 1, 0, 0, *p, float(v)) for p, v in np.ndenumerate(a)]
    df = preprocess.clahe(spark.createDataFrame(rows, "fov int, round int, channel int, z int, y int, x int, v double"), Shape(*shape), 0.05, 32, tiles)
    got = np.zeros(shape)
    for r in df.collect():
        got[r.y, r.x] = r.v
    assert np.allclose(got, equalised(a, 0.05, 32, tiles)) and df.count() == a.size


def test_histogram_of_another_image(spark):
    rng = np.random.default_rng(9)
    images = {1: rng.integers(0, 12, 400) / 11, 2: rng.random(400) ** 2, 3: rng.integers(3, 6, 400) / 9}
    rows = [(0, r, 0, 0, 0, x, float(v)) for r, a in images.items() for x, v in enumerate(a)]
    df = spark.createDataFrame(rows, "fov int, round int, channel int, z int, y int, x int, v double")
    out = preprocess.histogram_match(df, df, "inter_round", 1)
    plan = plan_of(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    values, n = np.unique(images[1], return_counts=True)
    for rnd, a in images.items():
        own, inverse, m = np.unique(a, return_inverse=True, return_counts=True)
        want = np.interp(np.cumsum(m) / m.sum(), np.cumsum(n) / n.sum(), values)[inverse]
        got = {r.x: r.v for r in out.filter(f"round = {rnd}").collect()}
        assert np.allclose([got[x] for x in range(400)], want)


# spots


def test_components_of_a_random_graph(spark):
    rnd = random.Random(10)
    edges = [(k, rnd.randrange(300), rnd.randrange(300)) for k in (1, 2) for _ in range(220)] + [(3, i, i + 1) for i in range(400)] + [(4, 5, 5)]
    got = {(r.k, r.node): r.label for r in graph.connected(spark.createDataFrame(edges, "k int, a int, b int"), ["k"]).collect()}
    parent = {}

    def root(n):
        while parent.setdefault(n, n) != n:
            n = parent[n]
        return n

    for k, a, b in (e for e in edges if e[1] != e[2]):
        x, y = sorted((root((k, a)), root((k, b))))
        parent[y] = x
    assert got == {n: root(n)[1] for n in parent}


@pytest.mark.parametrize("box", [(3, 3, 3), (1, 2, 5), (5, 1, 1)])
def test_sums_of_boxes(spark, box):
    rng = np.random.default_rng(11)
    a = rng.integers(0, 4, (4, 9, 37)).astype(float)
    vox = volume(spark, a).selectExpr("fov", "round", "0 as channel", "z", "y", "x", "v")
    p = rng.uniform(-2, [6, 11, 39], (300, 3))
    p[:20] = np.floor(p[:20]) + 0.5
    points = spark.createDataFrame([(0, 1, k, *map(float, q)) for k, q in enumerate(p)], "fov int, round int, spot_id int, pz double, py double, px double")
    got = {r.spot_id: r.v for r in extract.box_sums(points, vox, box).collect()}
    want = {}
    for k, q in enumerate(np.rint(p).astype(int)):
        cut = tuple(slice(max(c - b // 2, 0), max(c + b // 2 + 1, 0)) for c, b in zip(q, box))
        if a[cut].any():
            want[k] = a[cut].sum()
    assert got == want


def blobs(a, sigmas, threshold, overlap):
    """Blobs of a volume by loops over voxels."""
    axes = [k for k in range(3) if a.shape[k] > 1]
    ratio = sigmas[1][2] / sigmas[0][2]

    def blur(s):
        out = a
        for k in axes:
            w = np.array(spots.st.gaussian_weights(s[k]))
            r, n = len(w) // 2, a.shape[k]
            index = [[(m if (m := (i + j) % (2 * (n - 1))) < n else 2 * (n - 1) - m) for j in range(-r, r + 1)] for i in range(n)]
            out = np.moveaxis(np.tensordot(np.moveaxis(out, k, 0)[np.array(index)], w, (1, 0)), 0, k)
        return out

    planes = [blur(s) for s in sigmas]
    cube = np.stack([(p - q) / (ratio - 1) for p, q in zip(planes, planes[1:])], -1)
    found = []
    for p in np.ndindex(cube.shape):
        box = tuple(slice(max(c - 1, 0), c + 2) for c in p)
        if cube[p] > threshold and cube[p] == cube[box].max():
            found.append((p[3], cube[p], tuple(-c for c in p[:3])))
    kept, dims = [], len(axes)
    for b in sorted(found, reverse=True):
        radius = lambda x: math.sqrt(dims) * ratio ** x[0]

        def shared(x, b=b):
            d = math.sqrt(sum(((x[2][k] - b[2][k]) / sigmas[0][k]) ** 2 for k in axes))
            r, s = max(radius(x), radius(b)), min(radius(x), radius(b))
            if d >= r + s or d <= r - s:
                return float(d <= r - s)
            if dims == 3:
                return (r + s - d) ** 2 * (d * d + 2 * d * (r + s) - 3 * (r * r + s * s) + 6 * r * s) / (16 * d * s**3)
            angle = lambda p, q: math.acos((d * d + p * p - q * q) / (2 * d * p))
            return (s * s * angle(s, r) + r * r * angle(r, s) - math.sqrt((-d + r + s) * (d - s + r) * (d + s - r) * (d + r + s)) / 2) / (math.pi * s * s)

        if all(shared(x) <= overlap for x in kept):
            kept.append(b)
    return {(*(-c for c in p), k): v for k, v, p in kept}


@pytest.mark.parametrize(("shape", "sigmas"), [((8, 14, 15), spots.scales((0.7, 1.0, 1.0), (1.4, 2.0, 2.0))), ((1, 18, 20), spots.scales((1.0, 1.0, 1.5), (2.5, 2.5, 3.75), 1.4))])
def test_blobs_equal_loops(spark, shape, sigmas):
    rng = np.random.default_rng(12)
    a = rng.random(shape) ** 6
    rows = [(0, 1, 0, *p, float(v)) for p, v in np.ndenumerate(a)]
    df = spark.createDataFrame(rows, "fov int, round int, channel int, z int, y int, x int, v double")
    got = {(r.z, r.y, r.x, r.scale): r.v for r in spots.blob_dog(df, sigmas, 0.02, dict(zip("zyx", shape)), 0.3).collect()}
    want = blobs(a, sigmas, 0.02, 0.3)
    assert got.keys() == want.keys() and len(want) > 5 and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_blob_has_its_sigma(spark):
    z, y, x = np.mgrid[:15, :31, :31]
    a = np.exp(-((z - 7) ** 2 / (2 * 1.5**2) + ((y - 14) ** 2 + (x - 16) ** 2) / (2 * 3.0**2)))
    rows = [(0, 1, 0, *p, float(v)) for p, v in np.ndenumerate(a)]
    df = spark.createDataFrame(rows, "fov int, round int, channel int, z int, y int, x int, v double")
    got = spots.blob_dog(df, spots.scales((0.8, 1.6, 1.6), (2.5, 5.0, 5.0), 1.3), 0.05, {"z": 15, "y": 31, "x": 31}).collect()
    assert [(r.z, r.y, r.x) for r in got] == [(7, 14, 16)] and 0.6 < got[0].sigma_y / 3.0 < 1.3 and got[0].sigma_z == got[0].sigma_y / 2


def test_planes_count_before_volumes(spark):
    kind = "fov int, round int, gz int, gy int, gx int, dz double, dy double, dx double"
    spots_of = spark.createDataFrame([(0, 1, 1.0, 2.0, 3.0)], "fov int, spot_id int, z double, y double, x double")
    rounds = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "fov int, round int")
    shifts = spark.createDataFrame([(0, 2, 0.5, 0.0, 0.0)], "fov int, round int, dz double, dy double, dx double")
    planes = spark.createDataFrame([(0, 2, 0, 0, 0, 0.0, 1.0, 2.0)], kind)
    nodes = spark.createDataFrame([(0, r, 0, 0, 0, 3.0, 4.0, 5.0) for r in (2, 3)], kind)
    one = {"z": 1, "y": 1, "x": 1}
    got = extract.mapped_coordinates(spots_of, rounds, shifts, planes, 1, 1, 1, nodes, one, one).collect()
    assert {r["round"]: (r.pz, r.py, r.px) for r in got} == {1: (1.0, 2.0, 3.0), 2: (0.5, 3.0, 5.0), 3: (4.0, 6.0, 8.0)}
    assert register.VOLUME == ["fov", "round", "z", "y", "x"]
