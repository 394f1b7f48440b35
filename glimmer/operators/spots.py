"""Detection of spots in image volumes."""

import math
from functools import reduce
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glimmer.operators import stencil as st
from glimmer.operators.graph import connected
from glimmer.operators.stencil import IMAGE, VOXEL, staged


def local_maxima(voxels: DataFrame, threshold_rel: float = 0.0, full_scale: float | None = None, radius: int = 1) -> DataFrame:
    """Voxels equal to the largest of their neighbourhood and over ``threshold_rel`` times the full scale (255, 65535; the
    image's maximum if None)."""
    m = st.box_maximum(voxels.filter("v > 0"), radius, "xyz")
    if full_scale is not None:
        return m.filter((F.col("v") == F.col("m")) & (F.col("v") > threshold_rel * full_scale)).select(*VOXEL, "v")
    tops = voxels.groupBy(*IMAGE).agg(F.max("v").alias("_top"))
    return m.filter(F.col("v") == F.col("m")).join(tops, IMAGE).filter(F.col("v") > threshold_rel * F.col("_top")).select(*VOXEL, "v")


def components(mask: DataFrame) -> DataFrame:
    """``mask`` with ``label``: the first (z, y, x) of its component of 26-neighbours.

    Edges are found once, half of the neighbours of each voxel meeting by equality, and staged; only voxels that touch
    another one take part in the rounds of :func:`graph.connected`.
    """
    place = F.struct("z", "y", "x")
    half = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) > (0, 0, 0)]
    near = F.array(*[F.struct((F.col("z") + a).alias("z"), (F.col("y") + b).alias("y"), (F.col("x") + c).alias("x")) for a, b, c in half])
    asked = mask.select(*IMAGE, place.alias("a"), F.inline(near))
    edges = asked.join(mask.select(*VOXEL), VOXEL).select(*IMAGE, "a", place.alias("b"))
    labels = connected(edges, IMAGE).select(*IMAGE, "node.z", "node.y", "node.x", "label")
    return mask.select(*VOXEL, "v").join(labels, VOXEL, "left").withColumn("label", F.coalesce("label", place))


def component_spots(labelled: DataFrame) -> DataFrame:
    """``fov, round, channel, z, y, x, intensity``: intensity-weighted centre and largest value of each component."""
    centre = [(F.sum(F.col("v") * F.col(c)) / F.sum("v")).alias(f"_{c}") for c in "zyx"]
    found = labelled.groupBy(*IMAGE, "label").agg(*centre, F.max("v").alias("intensity"))
    return found.select(*IMAGE, *[F.col(f"_{c}").alias(c) for c in "zyx"], "intensity")


def maxima_spots(voxels: DataFrame, threshold_rel: float = 0.1, full_scale: float | None = None) -> DataFrame:
    return component_spots(components(local_maxima(voxels, threshold_rel, full_scale))).withColumn("algo", F.lit("local_max"))


def separated_peaks(voxels: DataFrame, min_distance: int, height: int, width: int, depth: int, threshold_rel: float = 0.0) -> DataFrame:
    """Local maxima over ``min_distance``, at least that far from the border; of equal ones, in order of
    place, each stays that has none that stays within the distance before it."""
    d = min_distance
    m = local_maxima(voxels, threshold_rel, None, d)
    inside = F.lit(True)
    for c, size in (("z", depth), ("y", height), ("x", width)):
        inside = inside & (F.col(c).between(d, size - 1 - d) if size > 2 * d else F.lit(c == "z" and size == 1))
    # ties: pairs of an earlier and a later equal peak within the distance, found in their own or neighbouring cells
    m = staged(m.filter(inside))
    cell = lambda c: F.floor(F.col(c) / (d + 1)).cast("int")
    keyed = m.withColumns({f"c{c}": cell(c) for c in "zyx"})
    near = F.array(*[F.struct((cell("z") + a).alias("cz"), (cell("y") + b).alias("cy"), (cell("x") + e).alias("cx")) for a in (-1, 0, 1) for b in (-1, 0, 1) for e in (-1, 0, 1)])
    other = m.select(*IMAGE, *[F.col(c).alias(f"o{c}") for c in "zyx"], F.col("v").alias("ov"), F.inline(near))
    close = reduce(lambda a, b: a & b, [F.abs(F.col(c) - F.col(f"o{c}")) <= d for c in "zyx"])
    earlier = (F.col("ov") == F.col("v")) & (F.struct("oz", "oy", "ox") < F.struct(F.col("z").alias("oz"), F.col("y").alias("oy"), F.col("x").alias("ox")))
    pairs = keyed.join(other, [*IMAGE, "cz", "cy", "cx"]).filter(close & earlier).select(*VOXEL, "oz", "oy", "ox")
    return m.join(beaten(pairs, IMAGE, ["z", "y", "x"]), VOXEL, "left_anti").withColumn("algo", F.lit("peak"))


def beaten(pairs: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``keys, names`` of what loses when all pairs are settled in order: the better one (``o`` before each name) beats the other
    unless it is beaten itself. Whatever is the worse one of no pair stays and beats its partners; pairs with a
    beaten one no longer count; until no pair is left. Each round is staged."""
    first, as_first = [*keys, *[f"o{c}" for c in names]], {c: f"o{c}" for c in names}
    pairs = staged(pairs.select(*first, *names))
    lost = pairs.select(*keys, *names).limit(0)
    while not pairs.isEmpty():
        stay = pairs.select(*first).distinct().join(pairs.select(*keys, *names).withColumnsRenamed(as_first), first, "left_anti")
        now = staged(pairs.join(stay, first, "left_semi").select(*keys, *names).distinct())
        lost = lost.unionByName(now)
        pairs = staged(pairs.join(now, [*keys, *names], "left_anti").join(now.withColumnsRenamed(as_first), first, "left_anti"))
    return lost


def scales(smallest: tuple[float, ...], largest: tuple[float, ...], ratio: float = 1.6) -> list[tuple[float, ...]]:
    """Sigmas by axis from the smallest on, each ``ratio`` times the one before, up to the first past the largest."""
    n = int(sum(math.log(b / a) / math.log(ratio) + 1 for a, b in zip(smallest, largest, strict=True)) / len(smallest))
    return [tuple(s * ratio**k for s in smallest) for k in range(n + 1)]


def blob_dog(voxels: DataFrame, sigmas: list[tuple[float, float, float]], threshold: float, sizes: dict[str, int], overlap: float = 0.5) -> DataFrame:
    """``fov, round, channel, z, y, x, v, scale, sigma_z, sigma_y, sigma_x, algo``: blobs of dense volumes in a scale space.

    ``sigmas``: by axis (z, y, x), ascending by one ratio. Differences of neighbouring blurs, over the ratio less 1, that are
    over ``threshold`` and the largest of their neighbours in space and scale are blobs: ellipsoids of the square root of the
    number of axes (those longer than 1) times sigma. Of two whose common part is more than ``overlap`` of the smaller one
    the better stays: the larger scale, then the larger value, then the first place; one that is beaten beats none.

    All scales are one array a voxel, so each axis takes one shuffle for the blurs and one for the maxima. Pairs are looked
    for in neighbouring cells as long as two blobs of the largest scale.
    """
    axes = [c for c in "zyx" if sizes[c] > 1]
    n, ratio, dims = len(sigmas) - 1, sigmas[1][2] / sigmas[0][2], len(axes)
    cube = voxels.select(*VOXEL, F.array(*[F.col("v").cast("double")] * (n + 1)).alias("v"))
    for c in axes:
        weights = [st.gaussian_weights(s["zyx".index(c)]) for s in sigmas]
        cube = st.mapped_lines(cube, c, lambda a, weights=weights: _blurred_lines(a, weights))
    cube = cube.select(*VOXEL, F.array(*[(F.col("v")[j] - F.col("v")[j + 1]) / (ratio - 1) for j in range(n)]).alias("v"))
    # the values themselves stay in the first half of the array, the largest of their neighbours are in the second
    around = [F.array_max(F.slice("v", max(1, j - 1), min(j + 1, n) - max(1, j - 1) + 1)) for j in range(1, n + 1)]
    cube = cube.select(*VOXEL, F.concat("v", F.array(*around)).alias("v"))
    for c in axes:
        cube = st.mapped_lines(cube, c, lambda a: _widened_lines(a, n))
    hits = F.filter(F.transform(F.slice("v", 1, n), lambda v, j: F.struct(v.alias("v"), F.get("v", n + j).alias("m"), j.alias("scale"))), lambda x: (x["v"] == x["m"]) & (x["v"] > threshold))
    peaks = staged(cube.select(*VOXEL, F.inline(hits)).drop("m"))
    # in units of each axis's sigma at the first scale blobs are balls
    unit, root = dict(zip("zyx", sigmas[0])), math.sqrt(dims)
    reach = {c: 2 * root * unit[c] * ratio ** (n - 1) for c in axes}
    cell = {c: F.floor(F.col(c) / reach[c]).cast("int") for c in axes}
    steps = list(product(*[(-1, 0, 1)] * dims))
    near = F.array(*[F.struct(*[(cell[c] + k).alias(f"c{c}") for c, k in zip(axes, s)]) for s in steps])
    other = peaks.select(*IMAGE, *[F.col(c).alias(f"o{c}") for c in ("z", "y", "x", "scale", "v")], F.inline(near))
    met = peaks.withColumns({f"c{c}": cell[c] for c in axes}).join(other, [*IMAGE, *[f"c{c}" for c in axes]])
    better = F.struct(F.col("oscale"), F.col("ov"), *[-F.col(f"o{c}") for c in "zyx"]) > F.struct(F.col("scale").alias("oscale"), F.col("v").alias("ov"), *[-F.col(c) for c in "zyx"])
    d = F.sqrt(reduce(lambda a, b: a + b, [F.pow((F.col(c) - F.col(f"o{c}")) / unit[c], 2) for c in axes]))
    r, o = root * F.pow(F.lit(ratio), F.col("scale")), root * F.pow(F.lit(ratio), F.col("oscale"))
    pairs = met.filter(better).select(*VOXEL, "scale", *[f"o{c}" for c in ("z", "y", "x", "scale")], d.alias("d"), F.greatest(r, o).alias("r"), F.least(r, o).alias("s"))
    lost = beaten(pairs.filter(_shared(dims) > overlap), IMAGE, ["z", "y", "x", "scale"])
    kept = peaks.join(lost, [*VOXEL, "scale"], "left_anti")
    size = [F.element_at(F.array(*[F.lit(float(s[k])) for s in sigmas]), F.col("scale") + 1).alias(f"sigma_{c}") for k, c in enumerate("zyx")]
    return kept.select(*VOXEL, "v", "scale", *size, F.lit("blob_dog").alias("algo"))


def _blurred_lines(a: np.ndarray, weights: list[list[float]]) -> np.ndarray:
    """Number j of each place blurred along the line with the j-th weights, mirrored at the ends."""
    out = np.zeros_like(a)
    for j, w in enumerate(weights):
        places = np.arange(a.shape[1])
        for k, x in enumerate(w, -(len(w) // 2)):
            m = np.mod(places + k, 2 * (a.shape[1] - 1))
            out[:, :, j] += x * a[:, np.minimum(m, 2 * (a.shape[1] - 1) - m), j]
    return out


def _widened_lines(a: np.ndarray, n: int) -> np.ndarray:
    """Numbers from ``n`` on replaced by the largest of the place and its two neighbours."""
    out = a.copy()
    out[:, 1:, n:] = np.maximum(out[:, 1:, n:], a[:, :-1, n:])
    out[:, :-1, n:] = np.maximum(out[:, :-1, n:], a[:, 1:, n:])
    return out


def _shared(dims: int) -> Column:
    """The common part of two balls (radii ``r`` >= ``s``, ``d`` apart) as a share of the smaller one: in a line, a plane or space."""
    d, r, s = F.col("d"), F.col("r"), F.col("s")
    if dims == 1:
        part = (r + s - d) / (2 * s)
    elif dims == 2:
        angle = lambda a, b: F.acos(F.least(F.greatest((d * d + a * a - b * b) / (2 * d * a), F.lit(-1.0)), F.lit(1.0)))
        kite = F.sqrt(F.greatest((-d + r + s) * (d - s + r) * (d + s - r) * (d + r + s), F.lit(0.0)))
        part = (s * s * angle(s, r) + r * r * angle(r, s) - 0.5 * kite) / (math.pi * s * s)
    else:
        part = math.pi * F.pow(r + s - d, 2) * (d * d + 2 * d * (r + s) - 3 * (r * r + s * s) + 6 * r * s) / (12 * d) / (4 / 3 * math.pi * F.pow(s, 3))
    return F.when(d >= r + s, 0.0).when(d <= r - s, 1.0).otherwise(part)


def united(*found: DataFrame) -> DataFrame:
    """Spots of several detectors; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def numbered(spots: DataFrame) -> DataFrame:
    """``spots`` with ``spot_id`` within the FOV in order of channel and place."""
    return spots.withColumn("spot_id", F.row_number().over(Window.partitionBy("fov").orderBy("channel", "z", "y", "x")).cast("long") - 1)


def compared(spots: DataFrame, z: float) -> DataFrame:
    """``algo, on_plane, n`` of spots, on the plane (half a step) or beside it."""
    return spots.groupBy("algo", (F.abs(F.col("z") - z) <= 0.5).alias("on_plane")).agg(F.count("*").alias("n"))


def profile(voxels: DataFrame, n_voxels: int) -> DataFrame:
    """``low, high, mean, std`` of each image of ``n_voxels``; absent voxels are 0."""
    s = voxels.groupBy(*IMAGE).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("ss"))
    mean = F.col("s") / n_voxels
    return s.select(*IMAGE, F.when(F.col("n") < n_voxels, F.least("low", F.lit(0.0))).otherwise(F.col("low")).alias("low"), "high", mean.alias("mean"), F.sqrt(F.greatest(F.col("ss") / n_voxels - mean * mean, F.lit(0.0))).alias("std"))
