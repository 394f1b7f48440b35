"""Imaging queries do the whole of their table, against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from glimmer.plans.queries import QUERIES


@pytest.fixture(scope="module")
def items(spark, tmp_path_factory):
    """A folder with 280 line items of 40 orders, and its rows; voxels lie where spots are."""
    rng = np.random.default_rng(4)
    parts = [p for p in range(1, 200) if p % 64 < 23]
    rows = [(o, int(rng.choice(parts)), int(rng.integers(1, 9)), k + 1, float(rng.integers(1, 11)), "RAN"[int(rng.integers(3))], "FO"[int(rng.integers(2))]) for o in [*range(1, 31), *range(90, 100)] for k in range(7)]
    d = str(tmp_path_factory.mktemp("items"))
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{d}/lineitem.parquet")
    return d, rows


def spots_of(rows):
    """(fov, spot_id, z, y, x, channel, algo) of each line item."""
    return [(s % 4, ((o * 1000000 + p) * 100000 + s) * 10 + n, p * 7 % 60 / 10, o * 3 % 490 / 10, (o + p) % 630 / 10, o % 3, "ab"[p % 2]) for o, p, s, n, *_ in rows]


def places_of(rows):
    """(fov, spot_id, round) and the place of each spot in each round."""
    return {(f, i, r): (z, y - (1.5 if r == 2 else 0), x + (0.75 if r == 2 else 0)) for f, i, z, y, x, *_ in spots_of(rows) for r in (1, 2)}


def volume_of(rows):
    """Values by (fov, round) and (z, y, x, channel)."""
    v = defaultdict(lambda: defaultdict(float))
    for _, p, s, n, q, flag, status in rows:
        at = v[s % 4, 1 if status == "F" else 2]
        key = (n - 1, int(q) - 1, p % 64, "AN".find(flag) if flag in "AN" else 2)
        at[key] = min(at[key] + 20.0, 255.0)
    return v


def test_each_line_item_has_places(spark, items):
    d, rows = items
    got = {(r.fov, r.spot_id, r["round"]): (r.pz, r.py, r.px) for r in QUERIES["map_coords"](spark, d).collect()}
    want = places_of(rows)
    assert len(want) == 560 and set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_each_line_item_has_sums_and_crops(spark, items):
    d, rows = items
    vol, sums, crops = volume_of(rows), defaultdict(float), {}
    for (f, i, r), p in places_of(rows).items():
        c = [round(q) for q in p]
        for (z, y, x, ch), v in vol[f, r].items():
            dz, dy, dx = z - c[0], y - c[1], x - c[2]
            if max(abs(dz), abs(dy), abs(dx)) <= 1:
                sums[f, i, r, ch] += v
            if abs(dz) <= 1 and max(abs(dy), abs(dx)) <= 2:
                crops[f, i, r, ch, dy, dx] = max(v, crops.get((f, i, r, ch, dy, dx), 0.0))
    assert any(i // 10**12 % 10 for _, i, _, _ in sums)
    assert {tuple(x)[:4]: x.v for x in QUERIES["box_sum"](spark, d).select("fov", "spot_id", "round", "channel", "v").collect()} == sums
    assert {tuple(x)[:6]: x.v for x in QUERIES["spot_crop"](spark, d).select("fov", "spot_id", "round", "channel", "oy", "ox", "v").collect()} == crops
    table = {tuple(x)[:4]: x.v for x in QUERIES["intensity_table"](spark, d).select("fov", "spot_id", "round_idx", "chan_idx", "v").collect()}
    assert table == {(f, i, r - 1, c): sums.get((f, i, r, c), 0.0) for f, i, r in places_of(rows) for c in range(3)}
    total = defaultdict(float)
    for (f, i, *_), v in table.items():
        total[f, i] += v
    best = sorted(total, key=lambda k: (-total[k], k))[:5]
    assert [(x.fov, x.spot_id, x.total) for x in QUERIES["top_intensity"](spark, d).collect()] == [(*k, total[k]) for k in best]
    assert {(x.fov, x.spot_id) for x in QUERIES["spot_traces"](spark, d).collect()} == set(best)
    assert QUERIES["debug_pivot"](spark, d).count() == 100
    first = np.array([[table[f, i, 0, c] for c in range(3)] for f, i in sorted(total)]).T
    for x in QUERIES["crosstalk"](spark, d).collect():
        assert x.r == pytest.approx(np.corrcoef(first[x.chan_a], first[x.chan_b])[0, 1], abs=1e-6)


def test_each_line_item_is_compared(spark, items):
    d, rows = items
    spots, n = spots_of(rows), defaultdict(int)
    for _, _, z, *_, algo in spots:
        n[algo, abs(z - 3) <= 0.5] += 1
    assert {(r.algo, r.on_plane): r.n for r in QUERIES["detector_compare"](spark, d).collect()} == n
    inside = {(f, i) for f, i, z, y, x, *_ in spots if 15 <= y < 35 and 20 <= x < 40 and abs(z - 3) <= 1}
    assert {(r.fov, r.spot_id) for r in QUERIES["roi_spots"](spark, d).collect()} == inside and inside


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """A folder with events of two types in three rounds and four FOVs: 24 images."""
    from datetime import datetime

    rng = np.random.default_rng(7)
    rows = [(k, int(u), datetime(2024, 1, 1 + int(day), int(hour)), ["click", "view"][int(t)]) for k, (u, day, hour, t) in enumerate(zip(rng.integers(0, 60, 9000), rng.integers(4, 24, 9000), rng.integers(3, 20, 9000), rng.integers(0, 2, 9000)))]
    d = str(tmp_path_factory.mktemp("events"))
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string").write.parquet(f"{d}/events.parquet")
    images = defaultdict(lambda: np.zeros((24, 31)))
    for k, u, ts, t in rows:
        images[k // 2500, 1 + u % 3, 0 if t == "click" else 4][ts.hour, ts.day - 1] += 1 / 8
    return d, {k: np.minimum(v, 1.0) for k, v in images.items()}


def over_disk(img, radius, f):
    h, w = img.shape
    inside = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius]
    return np.array([[f([img[y + a, x + b] for a, b in inside if 0 <= y + a < h and 0 <= x + b < w]) for x in range(w)] for y in range(h)])


def reconstructed(marker, mask):
    now = np.minimum(marker, mask)
    while True:
        p = np.pad(now, 1, constant_values=-np.inf)
        grown = np.minimum(np.max([p[a : a + now.shape[0], b : b + now.shape[1]] for a in range(3) for b in range(3)], axis=0), mask)
        if (grown == now).all():
            return now
        now = grown


def halves(img):
    h, w = -(-img.shape[0] // 2), -(-img.shape[1] // 2)
    return np.array([[img[2 * y : 2 * y + 2, 2 * x : 2 * x + 2].mean() for x in range(w)] for y in range(h)])


def doubled(small, shape):
    at = lambda n, m: (lambda p: (np.floor(p).astype(int), p - np.floor(p), m))((np.arange(n) + 0.5) / 2 - 0.5)
    (y0, fy, h), (x0, fx, w) = at(shape[0], small.shape[0]), at(shape[1], small.shape[1])
    get = lambda i, j: small[np.clip(y0 + i, 0, h - 1)][:, np.clip(x0 + j, 0, w - 1)] * np.outer(fy if i else 1 - fy, fx if j else 1 - fx)
    return get(0, 0) + get(0, 1) + get(1, 0) + get(1, 1)


def contrasted(img):
    small = halves(img)
    d = img - doubled(reconstructed(over_disk(small, 2, min), small), img.shape)
    white = d - over_disk(over_disk(d, 4, min), 4, max)
    black = over_disk(over_disk(d, 4, max), 4, min) - d
    return np.clip(d + white - black, 0.0, 1.0)


@pytest.mark.parametrize(("name", "f"), [("reconstruct", lambda v: reconstructed(over_disk(v, 2, min), v)), ("morpho_contrast", contrasted)])
def test_each_image_is_reconstructed(spark, events, name, f):
    d, images = events
    got = {k: np.full((24, 31), np.nan) for k in images}
    for r in QUERIES[name](spark, d).collect():
        got[r.fov, r["round"], r.channel][r.y, r.x] = r.v
    assert len(images) == 24
    for k, v in images.items():
        np.testing.assert_allclose(got[k], f(v), atol=2e-6, err_msg=str(k))
