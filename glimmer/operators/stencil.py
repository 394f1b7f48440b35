"""Neighbourhoods of voxels as blocks with a halo, lines and shifted keys."""

import math
import re
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAGE = ["fov", "round", "channel"]
VOXEL = [*IMAGE, "z", "y", "x"]


#: Places on a side of the blocks in which a slice is worked on, one in a task at a time.
SIDE = 256


def blocks_of(low: Column, high: Column, n: int | None = None) -> Column:
    """A row for each block, on an axis of ``n`` places, that has any of the places from ``low`` to ``high``."""
    at = lambda c: F.floor(c / SIDE).cast("int")
    return F.explode(F.sequence(F.greatest(at(low), F.lit(0)), at(high) if n is None else F.least(at(high), F.lit((n - 1) // SIDE))))


def in_blocks(cells: DataFrame, halo: int, height: int | None = None, width: int | None = None) -> DataFrame:
    """``cells`` with ``by, bx`` of each block that has the place in it or at most ``halo`` beyond an edge: one row but for places
    near an edge. Places outside of the image, which starts at 0, are left out."""
    for c, n in (("y", height), ("x", width)):
        at = F.col(c)
        cells = cells.filter(at >= 0) if n is None else cells.filter((at >= 0) & (at < n))
        cells = cells.withColumn(f"b{c}", F.lit(0) if n is not None and n <= SIDE else blocks_of(at - halo, at + halo, n))
    return cells


def block_by_block(cells: DataFrame, f, values: str) -> DataFrame:
    """``VOXEL`` and ``values`` (names with types): ``f(by, bx, cells)`` of each block, whose cells it gets as an Arrow table and
    for which it gives y, x and the values, arrays of one length. One shuffle by block, and no join."""
    kinds, keys = dict(cells.dtypes), [*IMAGE, "z"]

    def apply(table):
        y, x, *out = f(table["by"][0].as_py(), table["bx"][0].as_py(), table)
        columns = [*[pa.repeat(table[k][0], len(y)) for k in keys], *[pa.array(c, pa.int32()) for c in (y, x)], *[pa.array(c, from_pandas=True) for c in out]]
        return pa.Table.from_arrays(columns, names)

    names = [*VOXEL, *re.findall(r"(\w+) \w+", values)]
    done = cells.groupBy(*keys, "by", "bx").applyInArrow(apply, ", ".join([*[f"`{c}` {kinds[c]}" for c in keys], "y int, x int", values]))
    return done.select(*names)


def numbers(table, name: str):
    return table[name].to_numpy()


def own(by: int, bx: int, y, x):
    """Which places are in the block itself."""
    return (y // SIDE == by) & (x // SIDE == bx)


def filled(y, x, v):
    """An array of the least box about all places, NaN where there is none, and its first y and x."""
    y0, x0 = y.min(), x.min()
    out = np.full((y.max() - y0 + 1, x.max() - x0 + 1), np.nan)
    out[y - y0, x - x0] = v
    return out, y0, x0


def by_block(voxels: DataFrame, halo: int, height: int, width: int, f) -> DataFrame:
    """Dense slices with ``f`` applied block by block: it takes an array of the block and ``halo`` about it, which the image's
    borders cut, and gives one of the same shape, whose values in the block itself count."""

    def apply(by, bx, table):
        y, x = numbers(table, "y"), numbers(table, "x")
        block, y0, x0 = filled(y, x, numbers(table, "v"))
        mine = own(by, bx, y, x)
        y, x = y[mine], x[mine]
        return y, x, f(block)[y - y0, x - x0]

    cells = in_blocks(voxels.select(*VOXEL, F.col("v").cast("double").alias("v")), halo, height, width)
    return block_by_block(cells, apply, "v double")


def densified(voxels: DataFrame, height: int, width: int, depth: int | None = None) -> DataFrame:
    """Every (y, x) of every slice that has a voxel (or of all ``depth`` slices of every image): absent ones are 0.

    Voxels meet a row of their slice in their block and are filled up there, so no table of all places is joined."""
    slices = voxels.select(*IMAGE, "z").distinct() if depth is None else voxels.select(*IMAGE).distinct().withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(depth - 1))))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit((n - 1) // SIDE)))
    asked = slices.withColumn("by", all_of(height)).withColumn("bx", all_of(width)).withColumns({"y": F.lit(None).cast("int"), "x": F.lit(None).cast("int"), "v": F.lit(None).cast("double")})
    told = in_blocks(voxels.select(*IMAGE, "z", F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("v").cast("double").alias("v")).dropna(subset=VOXEL), 0, height, width)

    def apply(by, bx, table):
        there = table.filter(table["y"].is_valid())
        y, x = numbers(there, "y"), numbers(there, "x")
        if len(y) == len(table):  # of a slice that is not asked for
            return y[:0], x[:0], np.zeros(0)
        y0, x0 = by * SIDE, bx * SIDE
        absent = np.ones((min(SIDE, height - y0), min(SIDE, width - x0)), dtype=bool)
        absent[y - y0, x - x0] = False
        ay, ax = np.nonzero(absent)
        return np.concatenate([y, ay + y0]), np.concatenate([x, ax + x0]), np.concatenate([np.nan_to_num(numbers(there, "v"), posinf=np.inf, neginf=-np.inf), np.zeros(len(ay))])

    return block_by_block(told.select(*VOXEL, "v", "by", "bx").unionByName(asked), apply, "v double")


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut: written to the checkpoint folder, which all executors share.

    The folder is ``spark.checkpoint.dir``. Where that is not set, a local session gets a temporary folder of its own; on a
    cluster, where no other executor would see it, that is an error.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


def sparsified(voxels: DataFrame) -> DataFrame:
    return voxels.filter("v > 0")


def box_maximum(voxels: DataFrame, radius: int = 1, axes: str = "xyz", name: str = "m") -> DataFrame:
    """``voxels`` (sparse, values from 0) with ``name``: the largest value within ``radius`` on each axis.

    A window would miss a neighbour whose row or column has no voxel of its own, so each pass tells a voxel's value to its
    targets, present or not, and aggregates there; the partial aggregation merges most of them before the exchange.
    """
    told = voxels.select(*VOXEL, F.col("v").alias("_m"))
    for a in axes:
        near = F.explode(F.sequence(F.col(a) - radius, F.col(a) + radius))
        told = told.select(*[c for c in VOXEL if c != a], near.alias(a), "_m").groupBy(*VOXEL).agg(F.max("_m").alias("_m"))
    return voxels.join(told, VOXEL).withColumnRenamed("_m", name)


def mirrored(k, size: int):
    """Places outside the axis reflected at the borders, which are not repeated, as often as it takes."""
    m = k % max(2 * (size - 1), 1)
    return np.minimum(m, 2 * (size - 1) - m)


def clamped(c: Column, size: int) -> Column:
    return F.least(F.greatest(c, F.lit(0)), F.lit(size - 1))


def gaussian_weights(sigma: float, radius: int | None = None) -> list[float]:
    """Weights from -radius to radius (three sigmas by default) with the sum 1."""
    r = max(1, int(3 * sigma + 0.5)) if radius is None else radius
    w = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-r, r + 1)]
    return [x / sum(w) for x in w]


def mapped_lines(voxels: DataFrame, axis: str, f) -> DataFrame:
    """Dense data whose ``v`` is an array of numbers, with ``f`` applied to lines along ``axis``: it takes and gives a NumPy array
    (lines, places, numbers). For many numbers a voxel, where an expression for each would be slow; one shuffle by line."""
    rest = [c for c in ("z", "y", "x") if c != axis]
    cells = F.array_sort(F.collect_list(F.struct(axis, "v")))
    rows = voxels.groupBy(*IMAGE, *rest).agg(cells.alias("cells")).select(*IMAGE, *rest, F.transform("cells", lambda p: p[axis]).alias("at"), F.flatten(F.transform("cells", lambda p: p["v"])).alias("v"))
    keys = [*IMAGE, *rest]

    def apply(batches):
        for batch in batches:
            size = np.diff(np.asarray(batch.column("at").offsets))
            for n in np.unique(size):
                own = batch.filter(pa.array(size == n))
                values = own.column("v").flatten().to_numpy().reshape(own.num_rows, n, -1)
                for k in range(0, own.num_rows, 256):
                    out = f(values[k : k + 256])
                    part, width = own.slice(k, 256), out.shape[2]
                    which = pa.array(np.repeat(np.arange(part.num_rows), n))
                    ends = pa.array(np.arange(0, out.size + 1, width, dtype=np.int32))
                    columns = [*[part.column(c).take(which) for c in keys], part.column("at").flatten(), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))]
                    yield pa.RecordBatch.from_arrays(columns, [*keys, axis, "v"])

    kinds = dict(voxels.dtypes)
    return rows.mapInArrow(apply, ", ".join([*[f"`{c}` {kinds[c]}" for c in (*keys, axis)], "v array<double>"])).select(*VOXEL, "v")


def weighted(block, axis: int, weights: list[float]):
    """One pass of a separable blur over an array, mirrored at its borders."""
    r, n = len(weights) // 2, block.shape[axis]
    return sum((np.take(block, mirrored(np.arange(n) + (k - r), n), axis) * w for k, w in enumerate(weights)), np.zeros(block.shape))


def blurred(block, sigma: float, radius: int | None = None):
    """Gaussian blur of an array."""
    w = gaussian_weights(sigma, radius)
    return weighted(weighted(block, 1, w), 0, w)


def disk(radius: int) -> dict[int, int]:
    """Half-width of each row of a disk."""
    return {dy: math.isqrt(radius * radius - dy * dy) for dy in range(-radius, radius + 1)}


def over_disk(block, radius: int, largest: bool):
    """Maximum (dilation) or minimum (erosion) over a disk of an array; what is outside, and NaN, does not count."""
    f = np.fmax if largest else np.fmin
    (h, w), p = block.shape, np.pad(block, radius, constant_values=np.nan)
    out = np.full(block.shape, np.nan)
    for dy, half in disk(radius).items():
        for dx in range(-half, half + 1):
            out = f(out, p[radius + dy : radius + dy + h, radius + dx : radius + dx + w])
    return out


def grown(block):
    """Maximum over 3 x 3 of an array."""
    p = np.pad(block, 1, constant_values=-np.inf)
    rows = np.maximum(np.maximum(p[:-2], p[1:-1]), p[2:])
    return np.maximum(np.maximum(rows[:, :-2], rows[:, 1:-1]), rows[:, 2:])
