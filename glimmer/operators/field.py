"""Displacement fields in three dimensions: block matching, smoothing, sampling and warping.

A field is a table of nodes ``fov, round, gz, gy, gx, dz, dy, dx``: the round's voxel at p + d is the reference's at p, for p in
the tile ``g``. Absent nodes are gaps.
"""

from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmer.operators import register

AXES = ("z", "y", "x")
NODE = ["fov", "round", "gz", "gy", "gx"]
SHIFT = ["dz", "dy", "dx"]
#: Places on the x axis that a row of a volume made of lines holds.
SEGMENT = 16


def halo_tiles(voxels: DataFrame, tile: dict[str, int], halo: dict[str, int]) -> DataFrame:
    """``voxels`` with ``gz, gy, gx`` of every tile that has the voxel in it or at most ``halo`` before or behind it: one row but
    for voxels near an edge."""
    for c in AXES:
        at = lambda k, c=c: F.floor((F.col(c) + k) / tile[c]).cast("int")
        voxels = voxels.withColumn(f"g{c}", F.explode(F.sequence(at(-halo[c]), at(halo[c]))) if halo[c] else at(0))
    return voxels


def block_matched(volume: DataFrame, reference_round: int, tile: dict[str, int], radius: dict[str, int], sizes: dict[str, int], places: DataFrame | None = None) -> DataFrame:
    """``fov, round, gz, gy, gx, dz, dy, dx, r``: for each tile of the reference the whole offset within ``radius`` at which the
    round correlates best (Pearson, to nine decimals, over all places of the tile in the volume of ``sizes``; absent
    voxels, and the round outside of the volume, are 0). Of equal ones the shortest, then the largest. Tiles without
    variance on either side have none.

    ``volume``: ``fov, round, z, y, x, v``. Of the reference only voxels at ``places`` (``fov, z, y, x``), if given, count; others
    are 0. Tiles with their halo come together as lists, which their size bounds; sums over the round's shifted tiles are
    eight look-ups in a table of running sums, and products are summed over a view of all offsets.
    """
    ref, moved = volume.filter(F.col("round") == reference_round).drop("round"), volume.filter(F.col("round") != reference_round)
    if places is not None:
        ref = ref.join(places.select("fov", *AXES), ["fov", *AXES], "left_semi")
    flat = lambda halo: reduce(lambda a, c: a * (tile[c] + 2 * halo[c]) + F.col(c) - F.col(f"g{c}") * tile[c] + halo[c], AXES, F.lit(0)).cast("int")
    none = dict.fromkeys(AXES, 0)
    g = ["gz", "gy", "gx"]
    a = halo_tiles(ref, tile, none).groupBy("fov", *g).agg(F.collect_list(F.struct(flat(none).alias("k"), F.col("v").cast("double").alias("v"))).alias("a"))
    b = halo_tiles(moved, tile, radius).groupBy("fov", "round", *g).agg(F.collect_list(F.struct(flat(radius).alias("k"), F.col("v").cast("double").alias("v"))).alias("b"))
    shape, reach, size = (np.array([d[c] for c in AXES]) for d in (tile, radius, sizes))
    offsets = np.array(list(product(*[range(-r, r + 1) for r in reach])))
    order = np.lexsort((-offsets[:, 2], -offsets[:, 1], -offsets[:, 0], (offsets**2).sum(axis=1)))  # of equal correlations the first counts

    def filled(cells, shape) -> np.ndarray:
        out, (k, v) = np.zeros(shape.prod()), cells.values.flatten()
        np.add.at(out, k.to_numpy(), v.to_numpy())
        return out.reshape(shape)

    def match(batches):
        for batch in batches:
            found = []
            for n in range(batch.num_rows):
                at = np.array([batch.column(c)[n].as_py() for c in g])
                inside = np.minimum(shape, size - at * shape)
                if (inside <= 0).any():
                    continue
                own = filled(batch.column("a")[n], shape)[tuple(slice(0, k) for k in inside)]
                other = filled(batch.column("b")[n], shape + 2 * reach)
                first = at * shape - reach  # places outside of the volume hold nothing
                other = other[tuple(slice(0, k) for k in inside + 2 * reach)]
                for axis in range(3):
                    cells = np.arange(other.shape[axis]) + first[axis]
                    other[tuple((cells < 0) | (cells >= size[axis]) if a == axis else slice(None) for a in range(3))] = 0
                views = np.lib.stride_tricks.sliding_window_view(other, own.shape)
                ab = np.einsum("ijkzyx,zyx->ijk", views, own)
                s, ss = (_box_sums(x, own.shape) for x in (other, other * other))
                m, sa, saa = own.size, own.sum(), (own * own).sum()
                var = (m * saa - sa * sa) * (m * ss - s * s)
                r = np.where(var > 1e-9, np.round((m * ab - sa * s) / np.sqrt(np.where(var > 1e-9, var, 1.0)), 9), -np.inf).ravel()[order]
                best = r.argmax()
                if np.isfinite(r[best]):
                    found.append((n, offsets[order[best]], r[best]))
            rows = pa.array([n for n, _, _ in found], pa.int32())
            keys = [batch.column(c).take(rows) for c in NODE]
            shifts = [pa.array([float(d[k]) for _, d, _ in found], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*keys, *shifts, pa.array([float(r) for _, _, r in found], pa.float64())], [*NODE, *SHIFT, "r"])

    met = b.join(a, ["fov", *g]).select(F.col("fov").cast("int").alias("fov"), F.col("round").cast("int").alias("round"), *g, "a", "b")
    return met.mapInArrow(match, ", ".join([*[f"{c} int" for c in NODE], *[f"{d} double" for d in SHIFT], "r double"]))


def _box_sums(a: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Sums over all boxes of ``shape`` in ``a``, from running sums along all axes."""
    run = np.pad(a, ((1, 0),) * 3).cumsum(0).cumsum(1).cumsum(2)
    for axis, n in enumerate(shape):
        run = np.take(run, range(n, run.shape[axis]), axis) - np.take(run, range(run.shape[axis] - n), axis)
    return run


def smoothed_nodes(flow: DataFrame, sigma: float, counts: dict[str, int], radius: int | None = None) -> DataFrame:
    """Every node within ``radius`` (three sigmas by default; on each axis of more than one node) of one that is there: the
    mean of the nodes about it with Gaussian weights, ``sigma`` in nodes.

    The convolution is normalised: weights of nodes that are there add up to 1, so a gap neither pulls its neighbours to 0
    nor spreads, and is filled from them.
    """
    r = max(1, int(3 * sigma + 0.5)) if radius is None else radius
    told = flow.select(*NODE, *SHIFT, F.lit(1.0).alias("w"))
    for c in AXES:  # values and presence are blurred alike, an axis at a time
        if counts[c] == 1:
            continue
        g = f"g{c}"
        near = told.withColumn("_k", F.explode(F.sequence(F.lit(-r), F.lit(r)))).withColumn(g, F.col(g) + F.col("_k")).filter(F.col(g).between(0, counts[c] - 1))
        weight = F.exp(-(F.col("_k") * F.col("_k")) / (2 * sigma * sigma))
        told = near.groupBy(*NODE).agg(*[F.sum(F.col(d) * weight).alias(d) for d in (*SHIFT, "w")])
    return told.select(*NODE, *[(F.col(d) / F.col("w")).alias(d) for d in SHIFT])


def sampled(points: DataFrame, flow: DataFrame, tile: dict[str, int], counts: dict[str, int], keys: list[str]) -> DataFrame:
    """``points`` (``fov, round, z, y, x`` and ``keys``, which name a point) as ``keys, fz, fy, fx``: the field there, linear between
    the centres of tiles on all axes, the place clamped to the outermost nodes (``counts`` of them); absent nodes are 0.

    A cell between eight nodes is one row that holds them all, so a point meets one row and nothing is added up after it.
    """
    corners = list(product((0, 1), repeat=3))
    cell = lambda s: F.struct(*[(F.col(f"g{c}") - k).alias(f"_c{c}") for c, k in zip(AXES, s)], F.lit(corners.index(s)).alias("q"))
    told = flow.select("fov", "round", F.struct(*SHIFT).alias("d"), F.inline(F.array(*[cell(s) for s in corners])))
    for c in AXES:
        told = told.filter(F.col(f"_c{c}").between(0, max(counts[c] - 2, 0)))
    cells = told.groupBy("fov", "round", "_cz", "_cy", "_cx").agg(F.array(*[F.max(F.when(F.col("q") == k, F.col("d"))) for k in range(8)]).alias("nodes"))
    asked = points.select(*dict.fromkeys(["fov", "round", *keys]), *[F.least(F.greatest((F.col(c) + 0.5) / tile[c] - 0.5, F.lit(0.0)), F.lit(float(counts[c] - 1))).alias(f"_u{c}") for c in AXES])
    asked = asked.withColumns({f"_c{c}": F.least(F.floor(f"_u{c}"), F.lit(max(counts[c] - 2, 0))).cast("int") for c in AXES})
    met = asked.join(cells.withColumnRenamed("nodes", "_nodes"), ["fov", "round", "_cz", "_cy", "_cx"], "left")
    part = lambda c, k: F.col(f"_u{c}") - F.col(f"_c{c}") if k else 1 - (F.col(f"_u{c}") - F.col(f"_c{c}"))
    value = lambda d: sum([part("z", s[0]) * part("y", s[1]) * part("x", s[2]) * F.coalesce(F.col("_nodes")[n][d], F.lit(0.0)) for n, s in enumerate(corners)], F.lit(0.0))
    return met.select(*keys, *[value(d).alias(f"f{d[1]}") for d in SHIFT])


def upscaled(flow: DataFrame, places: DataFrame, tile: dict[str, int], counts: dict[str, int], sigma: float = 3.0, scale: dict[str, float] | None = None, keys: list[str] | None = None) -> DataFrame:
    """The field smoothed (:func:`smoothed_nodes`) and sampled at ``places``, ``scale`` times each component: a field from a
    volume reduced by a factor has offsets and places that are as much shorter."""
    scale, keys = scale or {}, keys or ["fov", "round", *AXES]
    names = {k: f"_{k}" for k in keys}
    small = places.select("fov", "round", *[F.col(k).alias(n) for k, n in names.items()], *[((F.col(c) + 0.5) / scale.get(c, 1.0) - 0.5).alias(c) for c in AXES])
    found = sampled(small, smoothed_nodes(flow, sigma, counts), tile, counts, list(names.values()))
    return found.select(*[F.col(n).alias(k) for k, n in names.items()], *[(F.col(f"f{c}") * scale.get(c, 1.0)).alias(f"f{c}") for c in AXES])


def lines(volume: DataFrame, width: int = SEGMENT) -> DataFrame:
    """``fov, round, z, y, xb, q0, q1, q2, q3``: for the places x from ``xb * width`` to the first of the next segment the values of
    the lines (z, y), (z, y + 1), (z + 1, y) and (z + 1, y + 1), each null where absent: all that a linear interpolation
    between (z, y, x) and its upper neighbours needs is in one row."""
    ends = F.when(F.pmod("x", F.lit(width)) == 0, F.array(F.floor(F.col("x") / width) - 1, F.floor(F.col("x") / width))).otherwise(F.array(F.floor(F.col("x") / width)))
    parts = volume.select("fov", "round", "z", "y", "x", "v", F.explode(ends).alias("xb"))
    values = F.array(*[F.sum(F.when(F.col("x") - F.col("xb") * width == k, F.col("v"))) for k in range(width + 1)])
    rows = parts.groupBy("fov", "round", "z", "y", "xb").agg(values.alias("line"))
    told = rows.select("fov", "round", "xb", "line", F.inline(F.array(*[F.struct((F.col("z") - a).alias("z"), (F.col("y") - b).alias("y"), F.lit(2 * a + b).alias("q")) for a in (0, 1) for b in (0, 1)])))
    return told.groupBy("fov", "round", "z", "y", "xb").agg(*[F.max(F.when(F.col("q") == k, F.col("line"))).alias(f"q{k}") for k in range(4)])


def interpolated(points: DataFrame, volume: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, v`` of points (``fov, round, z, y, x`` as doubles, and ``keys``): the volume there, linear on three axes, absent
    voxels 0. A point sends one row to the line segment it lies in; points without a value other than 0 have no row."""
    low = {c: F.floor(c) for c in AXES}
    place = [low["z"].alias("_z0"), low["y"].alias("_y0"), F.floor(low["x"] / SEGMENT).alias("_xb"), F.pmod(low["x"], F.lit(SEGMENT)).cast("int").alias("_at")]
    asked = points.select(*dict.fromkeys(["fov", "round", *keys]), *place, *[(F.col(c) - low[c]).alias(f"_p{c}") for c in AXES])
    segments = lines(volume).withColumnsRenamed({"z": "_z0", "y": "_y0", "xb": "_xb", **{f"q{k}": f"_q{k}" for k in range(4)}})
    met = asked.join(segments, ["fov", "round", "_z0", "_y0", "_xb"])
    part = lambda c, k: F.col(f"_p{c}") if k else 1 - F.col(f"_p{c}")
    at = lambda a, b, c: F.coalesce(F.get(F.col(f"_q{2 * a + b}"), F.col("_at") + c), F.lit(0.0))
    value = sum([part("z", a) * part("y", b) * part("x", c) * at(a, b, c) for a, b, c in product((0, 1), repeat=3)], F.lit(0.0))
    return met.select(*keys, value.alias("v")).filter("v <> 0")


def warped(volume: DataFrame, field: DataFrame) -> DataFrame:
    """``fov, round, z, y, x, v`` with ``out(p) = in(p + f(p))`` for the places and offsets of ``field`` (``fov, round, z, y, x, fz, fy,
    fx``), linear on three axes, 0 outside; zeros have no row."""
    place = [F.col(c).alias(f"_{c}") for c in AXES]
    points = field.select("fov", "round", *place, *[(F.col(c) + F.col(f"f{c}")).alias(c) for c in AXES])
    return interpolated(points, volume, ["fov", "round", "_z", "_y", "_x"]).withColumnsRenamed({f"_{c}": c for c in AXES})


def transformed(volume: DataFrame, shifts: DataFrame, field: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The shift (``fov, round, dz, dy, dx``), then the warp at the places that ``field`` lists; each is a linear interpolation."""
    return warped(register.shifted(volume, shifts, sizes), field)
