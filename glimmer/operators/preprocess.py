"""Cleaning of image volumes: ``fov, round, channel, z, y, x, v`` with values from 0 to 1.

Each step takes and gives such a table. Steps on neighbourhoods need dense slices (see ``stencil.densified``).
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glimmer.operators import stencil as st
from glimmer.operators.stencil import IMAGE, VOXEL


@dataclass(frozen=True)
class Shape:
    height: int
    width: int


STEPS: dict[str, Callable[..., DataFrame]] = {}


def step(f):
    """Registers a preprocessing step by its function's name."""
    STEPS[f.__name__] = f
    return f


def scaled(voxels: DataFrame, kind: str = "uint8") -> DataFrame:
    """To [0, 1] from bytes or 16-bit values; floats stay. Done once, when voxels come in."""
    by = {"uint8": 255.0, "uint16": 65535.0, "float": 1.0}[kind]
    return voxels.withColumn("v", F.col("v") / by)


def quantised(voxels: DataFrame) -> DataFrame:
    """Clipped to [0, 1], times 255, rounded half to even."""
    return voxels.withColumn("v", F.rint(F.least(F.greatest("v", F.lit(0.0)), F.lit(1.0)) * 255))


def _per_image(voxels: DataFrame, **stats: Column) -> DataFrame:
    """``voxels`` with statistics of their image: one row an image. The hint says which side is small, since the size of rows that
    come from ``explode`` is estimated too low and voxels would be broadcast."""
    return voxels.join(voxels.groupBy(*IMAGE).agg(*[c.alias(k) for k, c in stats.items()]).hint("shuffle_hash"), IMAGE)


@step
def none(voxels: DataFrame, shape: Shape | None = None) -> DataFrame:
    return voxels


@step
def min_max_normalize(voxels: DataFrame, shape: Shape | None = None) -> DataFrame:
    """Range to [0, 1]; an image with a range under 1e-9 becomes 0."""
    s = _per_image(voxels, low=F.min("v"), high=F.max("v"))
    span = F.col("high") - F.col("low")
    return s.select(*VOXEL, F.when(span < 1e-9, 0.0).otherwise((F.col("v") - F.col("low")) / F.when(span < 1e-9, 1.0).otherwise(span)).alias("v"))


@step
def clip_percentile(voxels: DataFrame, shape: Shape | None = None, min_percentile: float = 0.1, max_percentile: float = 99.9) -> DataFrame:
    """Clip to the image's exact percentiles (linear interpolation)."""
    s = _per_image(voxels, p=F.percentile("v", F.array(F.lit(min_percentile / 100), F.lit(max_percentile / 100))))
    return s.select(*VOXEL, F.least(F.greatest("v", F.col("p")[0]), F.col("p")[1]).alias("v"))


@step
def gamma_correction(voxels: DataFrame, shape: Shape | None = None, gamma: float = 1.0) -> DataFrame:
    return voxels if gamma == 1.0 else voxels.withColumn("v", F.pow(F.greatest("v", F.lit(0.0)), gamma))


@step
def median_filter(voxels: DataFrame, shape: Shape, kernel_size: int = 3) -> DataFrame:
    """Median over a square on truncated bytes, borders repeated. An even size grows by one; under 3 nothing happens.

    Lines of the dense grid are arrays; a line meets its ``kernel_size`` neighbours, so lines are shuffled and never voxels.
    """
    k = kernel_size + (kernel_size % 2 == 0)
    if k < 3:
        return voxels
    r, line = k // 2, [*IMAGE, "z"]
    byte = F.floor(F.least(F.greatest("v", F.lit(0.0)), F.lit(1.0)) * 255)
    rows = voxels.groupBy(*line, "y").agg(F.transform(F.array_sort(F.collect_list(F.struct("x", byte.alias("b")))), lambda p: p["b"]).alias("bs"))
    asked = rows.select(*line, "y", F.explode(F.array(*[st.clamped(F.col("y") + a, shape.height) for a in range(-r, r + 1)])).alias("sy"))
    near = asked.join(rows.withColumnRenamed("y", "sy"), [*line, "sy"]).groupBy(*line, "y").agg(F.collect_list("bs").alias("ls"))
    window = lambda i: F.flatten(F.transform("ls", lambda bs: F.array(*[F.get(bs, st.clamped(i + b, shape.width)) for b in range(-r, r + 1)])))
    medians = F.transform(F.get("ls", F.lit(0)), lambda _, i: F.get(F.sort_array(window(i)), F.lit(k * k // 2)) / 255.0)
    return near.select(*line, "y", F.posexplode(medians).alias("x", "v")).select(*VOXEL, "v")


@step
def gaussian_blur(voxels: DataFrame, shape: Shape, sigma: float = 1.0) -> DataFrame:
    return st.by_block(voxels, len(st.gaussian_weights(sigma)) // 2, shape.height, shape.width, lambda a: st.blurred(a, sigma))


@step
def difference_of_gaussians(voxels: DataFrame, shape: Shape, spot_sigma: float = 1.0, bg_sigma: float = 5.0) -> DataFrame:
    halo = max(len(st.gaussian_weights(s)) // 2 for s in (spot_sigma, bg_sigma))
    return st.by_block(voxels, halo, shape.height, shape.width, lambda a: np.maximum(st.blurred(a, spot_sigma) - st.blurred(a, bg_sigma), 0.0))


def quantiles(voxels: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, v, q``: the share of values up to ``v``. Values are bytes at first, so an image has few distinct ones."""
    counts = voxels.groupBy(*keys, "v").count()
    w = Window.partitionBy(*keys)
    return counts.select(*keys, "v", (F.sum("count").over(w.orderBy("v")) / F.sum("count").over(w)).alias("q"))


def histogram_matched(voxels: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """Values replaced by those of ``reference`` (with ``keys``) at the same quantile, linear between its values.

    Quantiles of source and reference are bracketed by a union in order of q: the last reference value up to a source's
    quantile and the first from it on, so an image's distinct values are sorted once and meet no range of others. Below the
    least reference quantile its value counts. A source without a reference stays as it is.
    """
    images = voxels.select(*IMAGE).distinct()
    source = quantiles(voxels, IMAGE).select(*IMAGE, "q", "v", F.lit(None).cast("double").alias("rv"))
    ref = quantiles(reference, keys).withColumn("rv", F.col("v").cast("double")).drop("v").join(images, keys)
    both = source.unionByName(ref.select(*IMAGE, "q", F.lit(None).cast("double").alias("v"), "rv"))
    point = F.when(F.col("rv").isNotNull(), F.struct("q", F.col("rv").alias("v")))
    # of rows with one quantile the reference comes first, either way, and is both ends of the bracket
    up, down = (Window.partitionBy(*IMAGE).orderBy(q, F.col("rv").isNull()) for q in (F.asc("q"), F.desc("q")))
    low, high = (F.last(point, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for w in (up, down))
    met = both.withColumns({"low": low, "high": high}).filter("rv is null")
    between = F.col("low.v") + (F.col("high.v") - F.col("low.v")) * (F.col("q") - F.col("low.q")) / F.nullif(F.col("high.q") - F.col("low.q"), F.lit(0.0))
    table = met.select(*IMAGE, "v", F.coalesce(between, "low.v", "high.v").alias("_to"))
    return voxels.join(table, [*IMAGE, "v"], "left").select(*VOXEL, F.coalesce("_to", "v").alias("v"))


def histogram_match(voxels: DataFrame, calibrated: DataFrame, scope: str, reference_round: int = 1, first_channel: int = 0) -> DataFrame:
    """``inter_round``: to the same channel of the reference round. ``intra_round``: to the first channel of the round.
    The references come from ``calibrated``; those images themselves stay."""
    if scope == "inter_round":
        return histogram_matched(voxels, calibrated.filter(F.col("round") == reference_round), ["fov", "channel"])
    if scope == "intra_round":
        return histogram_matched(voxels, calibrated.filter(F.col("channel") == first_channel), ["fov", "round"])
    raise ValueError(f"unknown scope {scope}")


@step
def clahe(voxels: DataFrame, shape: Shape, clip_limit: float = 0.01, nbins: int = 256, tiles: int = 8) -> DataFrame:
    """Contrast-limited adaptive equalisation: per tile a histogram, clipped, its excess spread over all bins, and summed;
    a value takes the bilinear blend of its four nearest tiles' sums at its bin. Tiles divide the image evenly.

    Counts of tiles are told to the blocks near them, a row a value that occurs, and summed there; voxels are shuffled once
    for the counts and once for the blend, and no row is made for bins without voxels.
    """
    th, tw = -(-shape.height // tiles), -(-shape.width // tiles)
    last_y, last_x = (shape.height - 1) // th, (shape.width - 1) // tw
    bin_of = F.least(F.floor(F.least(F.greatest("v", F.lit(0.0)), F.lit(1.0)) * nbins), F.lit(nbins - 1)).cast("int")
    binned = voxels.select(*VOXEL, bin_of.alias("b"))
    counts = binned.groupBy(*IMAGE, "z", F.floor(F.col("y") / th).cast("int").alias("y"), F.floor(F.col("x") / tw).cast("int").alias("x"), "b").agg(F.count("*").cast("int").alias("n"))
    for c, t, n in (("y", th, shape.height), ("x", tw, shape.width)):
        counts = counts.withColumn(f"b{c}", st.blocks_of((F.col(c) - 1) * t, (F.col(c) + 2) * t - 1, n))

    def blend(by, bx, table):
        told = table.filter(table["n"].is_valid())
        (ty, ny), (tx, nx) = ((lambda t: (t, int(t.max()) - int(t.min()) + 1))(st.numbers(told, c)) for c in "yx")
        first_y, first_x = int(ty.min()), int(tx.min())
        n = np.zeros((ny, nx, nbins))
        n[ty - first_y, tx - first_x, st.numbers(told, "b")] = st.numbers(told, "n")
        total = n.sum(2, keepdims=True)
        kept = np.minimum(n, np.maximum(1.0, clip_limit * total))
        with np.errstate(invalid="ignore"):  # a tile without voxels
            cdf = (np.cumsum(kept, 2) + (total - kept.sum(2, keepdims=True)) * np.arange(1, nbins + 1) / nbins) / total
        asked = table.filter(table["n"].is_null())
        y, x, b = (st.numbers(asked, c) for c in ("y", "x", "b"))
        py, px = (y + 0.5) / th - 0.5, (x + 0.5) / tw - 0.5
        qy, qx = np.floor(py), np.floor(px)
        corner = lambda i, j: cdf[np.clip(qy + i, 0, last_y).astype(int) - first_y, np.clip(qx + j, 0, last_x).astype(int) - first_x, b]
        fy, fx = py - qy, px - qx
        return y, x, (1 - fy) * ((1 - fx) * corner(0, 0) + fx * corner(0, 1)) + fy * ((1 - fx) * corner(1, 0) + fx * corner(1, 1))

    cells = st.in_blocks(binned.withColumn("n", F.lit(None).cast("int")), 0, shape.height, shape.width)
    return st.block_by_block(cells.unionByName(counts), blend, "v double")


def erosion(voxels: DataFrame, shape: Shape, radius: int) -> DataFrame:
    return st.by_block(voxels, radius, shape.height, shape.width, lambda a: st.over_disk(a, radius, False))


def dilation(voxels: DataFrame, shape: Shape, radius: int) -> DataFrame:
    return st.by_block(voxels, radius, shape.height, shape.width, lambda a: st.over_disk(a, radius, True))


def _opened(a, radius: int):
    return st.over_disk(st.over_disk(a, radius, False), radius, True)


def _closed(a, radius: int):
    return st.over_disk(st.over_disk(a, radius, True), radius, False)


def white_tophat(voxels: DataFrame, shape: Shape, radius: int) -> DataFrame:
    """The image less its opening."""
    return st.by_block(voxels, 2 * radius, shape.height, shape.width, lambda a: a - _opened(a, radius))


def black_tophat(voxels: DataFrame, shape: Shape, radius: int) -> DataFrame:
    """The closing less the image."""
    return st.by_block(voxels, 2 * radius, shape.height, shape.width, lambda a: _closed(a, radius) - a)


def _reconstructed(by, bx, table):
    """Places of a block with marker and mask: the marker grown under the mask, the mask, and whether a neighbouring block sees
    a change."""
    y, x = st.numbers(table, "y"), st.numbers(table, "x")
    y0, x0 = y.min(), x.min()
    now, top = (np.full((y.max() - y0 + 1, x.max() - x0 + 1), np.nan) for _ in range(2))
    for a, name in ((now, "v"), (top, "top")):
        v = st.numbers(table, name)
        a[y[~np.isnan(v)] - y0, x[~np.isnan(v)] - x0] = v[~np.isnan(v)]
    there = ~(np.isnan(now) | np.isnan(top))
    top = np.where(there, top, -np.inf)
    now = before = np.where(there, np.minimum(now, top), -np.inf)
    while True:
        after = np.minimum(st.grown(now), top)
        if np.array_equal(after, now):
            break
        now = after
    ay, ax = np.nonzero(there)
    mine = st.own(by, bx, ay + y0, ax + x0)
    ay, ax = ay[mine], ax[mine]
    edge = np.isin((ay + y0) % st.SIDE, (0, st.SIDE - 1)) | np.isin((ax + x0) % st.SIDE, (0, st.SIDE - 1))
    seen = edge & (now[ay, ax] != before[ay, ax]) & (len(y) > st.own(by, bx, y, x).sum())
    return ay + y0, ax + x0, now[ay, ax], top[ay, ax], seen


def reconstruction(marker: DataFrame, mask: DataFrame) -> DataFrame:
    """The marker dilated by 3 x 3 again and again under the mask, until nothing changes.

    Each block is finished with its neighbours' edges as they are; where one changes an edge, blocks go another round. Rounds
    are staged, so lineage does not grow (see ``stencil.staged``).
    """
    none = F.lit(None).cast("double")
    now = marker.select(*VOXEL, F.col("v").cast("double").alias("v"), none.alias("top")).unionByName(mask.select(*VOXEL, none.alias("v"), F.col("v").cast("double").alias("top")))
    while True:
        now = st.staged(st.block_by_block(st.in_blocks(now, 1), _reconstructed, "v double, top double, seen boolean"))
        if now.filter("seen").isEmpty():
            return now.select(*VOXEL, "v")
        now = now.drop("seen")


def downsampled(voxels: DataFrame, factor: int) -> DataFrame:
    """Means of factor x factor blocks, in units of 2 ** -40: sums of whole numbers do not depend on the order of rows."""
    at = lambda c: F.floor(F.col(c) / factor).cast("int").alias(c)
    whole = F.rint(F.col("v") * float(1 << 40)).cast("decimal(38,0)")
    mean = F.sum(whole).cast("double") / F.count("*") / float(1 << 40)
    return voxels.groupBy(*IMAGE, "z", at("y"), at("x")).agg(mean.alias("v")).select(*VOXEL, "v")


def _upsampled(small, at, factor: int, sizes: tuple[int, int], first: tuple[int, int]):
    """``small`` (part of an image of ``sizes``, from ``first`` on) at places y and x (arrays) of the large image, by bilinear
    interpolation between block centres."""
    low, part = [], []
    for p, n, f0 in zip(at, sizes, first):
        p = (p + 0.5) / factor - 0.5
        part.append(p - np.floor(p))
        low.append([np.clip(np.floor(p).astype(int) + k, 0, n - 1) - f0 for k in (0, 1)])
    side = lambda k, i: part[k] if i else 1 - part[k]
    return sum(np.outer(side(0, i), side(1, j)) * small[np.ix_(low[0][i], low[1][j])] for i in (0, 1) for j in (0, 1))


@step
def morpho_reconstruction_contrast(voxels: DataFrame, shape: Shape, radius: int = 10, downsample_factor: float = 0.25) -> DataFrame:
    """Background (reconstruction of an eroded small image) taken off, then white top-hat added, black top-hat taken off.

    Places of the small image are told to the blocks near them, and the last steps are one pass over blocks."""
    f, halo = round(1 / downsample_factor), 2 * radius
    inner = Shape(-(-shape.height // f), -(-shape.width // f))
    small = st.staged(downsampled(voxels, f))
    base = reconstruction(erosion(small, inner, max(1, int(radius * downsample_factor))), small).select(*VOXEL, "v", F.lit(True).alias("small"))
    for c, n in (("y", shape.height), ("x", shape.width)):
        base = base.withColumn(f"b{c}", st.blocks_of((F.col(c) - 1) * f - halo, (F.col(c) + 2) * f - 1 + halo, n))

    def contrasted(by, bx, table):
        (image, y0, x0), (low, sy, sx) = (st.filled(*[st.numbers(t, c) for c in ("y", "x", "v")]) for t in (table.filter(pc.invert(table["small"])), table.filter(table["small"])))
        y, x = (np.arange(n) + first for n, first in zip(image.shape, (y0, x0)))
        d = image - _upsampled(low, (y, x), f, (inner.height, inner.width), (sy, sx))
        d = np.clip(d + ((d - _opened(d, radius)) - (_closed(d, radius) - d)), 0.0, 1.0)
        ay, ax = np.nonzero(~np.isnan(image) & st.own(by, bx, y[:, None], x[None, :]))
        return ay + y0, ax + x0, d[ay, ax]

    cells = st.in_blocks(voxels.select(*VOXEL, F.col("v").cast("double").alias("v"), F.lit(False).alias("small")), halo, shape.height, shape.width)
    return st.block_by_block(cells.unionByName(base), contrasted, "v double")


def robust_normalised(voxels: DataFrame, low: float = 1.0, high: float = 99.0) -> DataFrame:
    """Display range: percentiles to [0, 1], flat images to 0."""
    s = _per_image(voxels, p=F.percentile("v", F.array(F.lit(low / 100), F.lit(high / 100))))
    span = F.col("p")[1] - F.col("p")[0]
    value = F.when(span > 1e-9, F.least(F.greatest((F.col("v") - F.col("p")[0]) / F.when(span > 1e-9, span).otherwise(1.0), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return s.select(*VOXEL, value.alias("v"))


Step = tuple[str, dict]


def run_steps(voxels: DataFrame, steps: list[Step], shape: Shape) -> DataFrame:
    """Steps in order, as often as listed; an unknown name is an error."""
    if unknown := [n for n, _ in steps if n not in STEPS]:
        raise ValueError(f"unknown steps {unknown}")
    return reduce(lambda v, s: STEPS[s[0]](v, shape, **s[1]), steps, voxels)


def split_steps(steps: list[Step]) -> tuple[list[Step], list[Step]]:
    """Calibration and extraction: cut before the first step named after morphology or background."""
    cut = next((k for k, (n, _) in enumerate(steps) if "morpho" in n or "background" in n), len(steps))
    return steps[:cut], steps[cut:]


def cleaned(voxels: DataFrame, steps: list[Step], shape: Shape, reference_round: int = 1, first_channel: int = 0) -> DataFrame:
    """All images through all steps. Histogram matching needs calibrated references, so images go in three layers: the
    reference round's first channel; the rest of that round and the first channel of the others; all else. Each layer is
    one plan over all its images."""
    before, after = split_steps(steps)
    is_ref, is_first = F.col("round") == reference_round, F.col("channel") == first_channel
    layers = [is_ref & is_first, is_ref != is_first, ~is_ref & ~is_first]
    done: DataFrame | None = None
    for layer in layers:
        part = voxels.filter(layer)
        for name, params in before:
            if name == "histogram_match":
                part = part if done is None else histogram_match(part, done, params["scope"], reference_round, first_channel)
            else:
                part = run_steps(part, [(name, params)], shape)
        # later layers read this one as reference: it is computed once
        part = st.staged(part) if any(n == "histogram_match" for n, _ in before) else part
        done = part if done is None else done.unionByName(part)
    return run_steps(done, after, shape)
