"""Alignment of rounds: shifts, displacement fields, warps and their scores."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glimmer.operators import stencil as st

PLANE = ["fov", "round", "y", "x"]
VOLUME = ["fov", "round", "z", "y", "x"]


def channel_projection(voxels: DataFrame) -> DataFrame:
    """Largest value over the channels of a round."""
    return voxels.groupBy(*VOLUME).agg(F.max("v").alias("v"))


def z_projection(volume: DataFrame) -> DataFrame:
    return volume.groupBy(*PLANE).agg(F.max("v").alias("v"))


def strided(volume: DataFrame, factor: int) -> DataFrame:
    """Every ``factor``-th y and x, all z."""
    at = lambda c: F.floor(F.col(c) / factor).cast("int")
    return volume.filter((F.col("y") % factor == 0) & (F.col("x") % factor == 0)).withColumns({"y": at("y"), "x": at("x")})


def cross_correlation(volume: DataFrame, reference_round: int, radius: int, sizes: dict[str, int] | None = None) -> DataFrame:
    """``fov, round, dz, dy, dx, cc``: sum of products of the reference at p and the round at p + d, for every d within
    ``radius`` on each axis. With ``sizes`` the axes are circular. Offsets are bounded, so voxels are multiplied by
    (2 radius + 1) ** axes and meet by equality."""
    axes = [c for c in ("z", "y", "x") if c in volume.columns]
    ref = volume.filter(F.col("round") == reference_round).select("fov", *axes, F.col("v").alias("rv"))
    moved = volume.filter(F.col("round") != reference_round)
    for c in axes:
        moved = moved.withColumn(f"d{c}", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
        p = F.col(c) - F.col(f"d{c}")
        moved = moved.withColumn(c, F.pmod(p, F.lit(sizes[c])) if sizes else p)
    return moved.join(ref, ["fov", *axes]).groupBy("fov", "round", *[f"d{c}" for c in axes]).agg(F.sum(F.col("rv") * F.col("v")).alias("cc"))


def global_shift(volume: DataFrame, reference_round: int, radius: int, sizes: dict[str, int] | None = None) -> DataFrame:
    """``fov, round, d*, cc, score, suspect``: the offset with the largest correlation, of equal ones the shortest.

    A round moved back by ``d`` matches the reference. ``score`` is 1 - sqrt(1 - cc**2 / (sum ref**2 * sum moving**2)).
    """
    axes = [c for c in ("z", "y", "x") if c in volume.columns]
    ds = [f"d{c}" for c in axes]
    far = reduce(lambda a, b: a + b, [F.col(d) * F.col(d) for d in ds])
    cc = cross_correlation(volume, reference_round, radius, sizes)
    best = cc.groupBy("fov", "round").agg(F.max_by(F.struct(*ds, "cc"), F.struct("cc", (-far).alias("near"), *[(-F.col(d)).alias(d) for d in ds])).alias("b"))
    power = volume.groupBy("fov", "round").agg(F.sum(F.col("v") * F.col("v")).alias("p"))
    ref = power.filter(F.col("round") == reference_round).select("fov", F.col("p").alias("rp"))
    joined = best.join(power, ["fov", "round"]).join(ref, "fov").select("fov", "round", *[F.col(f"b.{d}").alias(d) for d in ds], F.col("b.cc").alias("cc"), "p", "rp")
    match = F.coalesce(F.try_divide(F.col("cc") * F.col("cc"), F.col("p") * F.col("rp")), F.lit(0.0))
    return joined.withColumn("score", 1 - F.sqrt(F.greatest(1 - match, F.lit(0.0)))).withColumn("suspect", F.sqrt(far) > 200).drop("p", "rp")


def subpixel(cc: DataFrame, shift: DataFrame, axis: str) -> DataFrame:
    """``shift`` with the axis's offset refined by the parabola through the peak and its two neighbours."""
    d = f"d{axis}"
    others = [c for c in cc.columns if c.startswith("d") and c != d]
    w = Window.partitionBy("fov", "round", *others).orderBy(d)
    bent = cc.withColumns({"a": F.lag("cc").over(w), "c": F.lead("cc").over(w)})
    delta = F.coalesce(0.5 * F.try_divide(F.col("a") - F.col("c"), F.col("a") - 2 * F.col("cc") + F.col("c")), F.lit(0.0))
    fine = bent.select("fov", "round", d, *others, delta.alias("_delta"))
    return shift.join(fine, ["fov", "round", d, *others]).withColumn(d, F.col(d) + F.col("_delta")).drop("_delta")


def shifted(volume: DataFrame, shifts: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Each round translated by ``d*``: a voxel is spread over its 2 ** axes integer neighbours with linear weights; what
    leaves the volume is lost, what comes in is 0. Shifts are one row a round."""
    axes = list(sizes)
    out = volume.join(shifts.select("fov", "round", *[F.col(f"d{c}").cast("double").alias(f"_{c}") for c in axes]), ["fov", "round"])
    out = out.withColumn("w", F.lit(1.0))
    for c in axes:
        p = F.col(c) + F.col(f"_{c}")
        low = F.floor(p)
        out = out.withColumn("_to", F.array(F.struct(low.cast("int").alias("at"), (1 - (p - low)).alias("part")), F.struct((low + 1).cast("int").alias("at"), (p - low).alias("part"))))
        out = out.withColumn("_to", F.explode("_to")).filter("_to.part > 0").withColumns({c: F.col("_to.at"), "w": F.col("w") * F.col("_to.part")})
        out = out.filter((F.col(c) >= 0) & (F.col(c) < sizes[c]))
    return out.groupBy("fov", "round", *axes).agg(F.sum(F.col("w") * F.col("v")).alias("v"))


def in_overlap(height: int, width: int, dy="dy", dx="dx"):
    """Whether (y, x) is still covered after a shift cut to integers."""
    y, x = F.col(dy).cast("int"), F.col(dx).cast("int")
    rows = F.when(y > 0, F.col("y") >= y).when(y < 0, F.col("y") < height + y).otherwise(True)
    cols = F.when(x > 0, F.col("x") >= x).when(x < 0, F.col("x") < width + x).otherwise(True)
    return rows & cols


def quality_mask(plane: DataFrame, shifts: DataFrame, height: int, width: int, margin: int = 50, threshold: float = 1e-5) -> DataFrame:
    """Places with signal, in the overlap, and at least ``margin`` from the border."""
    s = plane.join(shifts.select("fov", "round", "dy", "dx"), ["fov", "round"])
    inner = F.col("y").between(margin, height - margin - 1) & F.col("x").between(margin, width - margin - 1)
    return s.filter((F.col("v") > threshold) & inner & in_overlap(height, width)).select(*PLANE, "v")


def block_flow(plane: DataFrame, reference_round: int, tile: int, radius: int) -> DataFrame:
    """``fov, round, gz, gy, gx, dz, dy, dx``: for each tile of the reference the offset (within ``radius``) where the
    round correlates best (Pearson, over places with both); of equal ones the shortest. Tiles without variance have none."""
    ref = plane.filter(F.col("round") == reference_round).select("fov", "y", "x", F.col("v").alias("rv"))
    moved = plane.filter(F.col("round") != reference_round)
    for c in ("y", "x"):
        moved = moved.withColumn(f"d{c}", F.explode(F.sequence(F.lit(-radius), F.lit(radius)))).withColumn(c, F.col(c) - F.col(f"d{c}"))
    met = moved.join(ref, ["fov", "y", "x"]).withColumns({"gy": F.floor(F.col("y") / tile).cast("int"), "gx": F.floor(F.col("x") / tile).cast("int")})
    a, b, n = F.col("rv"), F.col("v"), F.count("*")
    cov = n * F.sum(a * b) - F.sum(a) * F.sum(b)
    var = (n * F.sum(a * a) - F.sum(a) * F.sum(a)) * (n * F.sum(b * b) - F.sum(b) * F.sum(b))
    r = met.groupBy("fov", "round", "gy", "gx", "dy", "dx").agg(F.round(F.when(var > 1e-9, cov / F.sqrt(F.when(var > 1e-9, var).otherwise(1.0))), 9).alias("r")).filter("r is not null")
    far = F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")
    best = r.groupBy("fov", "round", "gy", "gx").agg(F.max_by(F.struct("dy", "dx"), F.struct("r", (-far).alias("near"), "dy", "dx")).alias("b"))
    return best.select("fov", "round", F.lit(0).alias("gz"), "gy", "gx", F.lit(0.0).alias("dz"), F.col("b.dy").cast("double").alias("dy"), F.col("b.dx").cast("double").alias("dx"))


def smoothed_flow(flow: DataFrame) -> DataFrame:
    """Each node's offset replaced by the median of its 3 x 3 nodes that are there."""
    near = F.array(*[F.struct((F.col("gy") + a).alias("gy"), (F.col("gx") + b).alias("gx")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    told = flow.select("fov", "round", "gz", "dz", "dy", "dx", F.inline(near))
    key = ["fov", "round", "gz", "gy", "gx"]
    return told.join(flow.select(*key), key, "left_semi").groupBy(*key).agg(*[F.percentile(c, 0.5).alias(c) for c in ("dz", "dy", "dx")])


def dense_flow(flow: DataFrame, places: DataFrame, tile: int, n_y: int, n_x: int) -> DataFrame:
    """``fov, round, y, x, fy, fx``: the field at ``places`` (``fov, round, y, x``), linear between tile centres."""
    return sampled_flow(places, flow, tile, n_y, n_x, PLANE)


def sampled_flow(points: DataFrame, flow: DataFrame, tile: int, n_y: int, n_x: int, keys: list[str]) -> DataFrame:
    """``keys, fy, fx``: the field at points (``fov, round, y, x``), the coordinate clamped to the nodes."""
    clamp = lambda p, n: F.least(F.greatest(p, F.lit(0.0)), F.lit(float(n - 1)))
    py, px = clamp((F.col("y") + 0.5) / tile - 0.5, n_y), clamp((F.col("x") + 0.5) / tile - 0.5, n_x)
    y0, x0 = F.floor(py), F.floor(px)
    corner = lambda i, j: F.struct(st.clamped(y0 + i, n_y).cast("int").alias("gy"), st.clamped(x0 + j, n_x).cast("int").alias("gx"), ((py - y0 if i else 1 - (py - y0)) * (px - x0 if j else 1 - (px - x0))).alias("w"))
    asked = points.select(*keys, F.inline(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)])))
    met = asked.join(flow.select("fov", "round", "gy", "gx", "dy", "dx"), ["fov", "round", "gy", "gx"], "left")
    total = lambda c: F.sum(F.col("w") * F.coalesce(c, F.lit(0.0)))
    return met.groupBy(*keys).agg(total("dy").alias("fy"), total("dx").alias("fx"))


def warped(plane: DataFrame, field: DataFrame) -> DataFrame:
    """``out(p) = in(p + field(p))``, linear, 0 outside: each target asks its four corners for their values."""
    py, px = F.col("y") + F.col("fy"), F.col("x") + F.col("fx")
    y0, x0 = F.floor(py), F.floor(px)
    corner = lambda i, j: F.struct((y0 + i).cast("int").alias("sy"), (x0 + j).cast("int").alias("sx"), ((py - y0 if i else 1 - (py - y0)) * (px - x0 if j else 1 - (px - x0))).alias("w"))
    asked = field.select(*PLANE, F.inline(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)]))).filter("w > 0")
    return asked.join(plane.withColumnsRenamed({"y": "sy", "x": "sx"}), ["fov", "round", "sy", "sx"]).groupBy(*PLANE).agg(F.sum(F.col("w") * F.col("v")).alias("v"))


def transformed(plane: DataFrame, shifts: DataFrame, field: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The shift, then the warp."""
    return warped(shifted(plane, shifts, sizes), field)


def correlations(plane: DataFrame, reference_round: int, height: int, width: int, crop: int = 1024) -> DataFrame:
    """``fov, round, corr``: Pearson of each round with the reference over all places (absent is 0); of images higher than
    ``crop`` only its centre counts. From sums, so that sparse planes need not be filled."""
    if height > crop:
        y0, x0 = (height - crop) // 2, max(0, (width - crop) // 2)
        plane = plane.filter(F.col("y").between(y0, y0 + crop - 1) & F.col("x").between(x0, x0 + crop - 1))
        height, width = crop, min(crop, width)
    n = height * width
    ref = plane.filter(F.col("round") == reference_round).select("fov", "y", "x", F.col("v").alias("rv"))
    own = plane.groupBy("fov", "round").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("ss"))
    r = own.filter(F.col("round") == reference_round).select("fov", F.col("s").alias("rs"), F.col("ss").alias("rss"))
    both = plane.join(ref, ["fov", "y", "x"]).groupBy("fov", "round").agg(F.sum(F.col("v") * F.col("rv")).alias("sp"))
    j = own.join(r, "fov").join(both, ["fov", "round"], "left")
    cov = n * F.coalesce("sp", F.lit(0.0)) - F.col("s") * F.col("rs")
    var = (n * F.col("ss") - F.col("s") * F.col("s")) * (n * F.col("rss") - F.col("rs") * F.col("rs"))
    return j.select("fov", "round", F.when(var > 0, cov / F.sqrt(F.when(var > 0, var).otherwise(1.0))).alias("corr"))


def gated(scores: DataFrame, least: float = 0.2) -> DataFrame:
    """``scores`` (``global_corr, local_corr``) with ``local_kept`` and ``final_corr``: no local step under ``least``, and
    none that makes it worse."""
    kept = F.coalesce((F.col("global_corr") >= least) & (F.col("local_corr") >= F.col("global_corr")), F.lit(False))
    return scores.withColumn("local_kept", kept).withColumn("final_corr", F.when(F.col("local_kept"), F.col("local_corr")).otherwise(F.col("global_corr")))


def kept_flow(flow: DataFrame, gates: DataFrame) -> DataFrame:
    return flow.join(gates.filter("local_kept").select("fov", "round"), ["fov", "round"], "left_semi")


def transform_table(gates: DataFrame, reference_round: int) -> DataFrame:
    """``fov, round, dz, dy, dx, global_corr, final_corr, local_kept`` with the reference round: no shift, scores 1."""
    names = ["dz", "dy", "dx"]
    rows = gates.select("fov", "round", *[F.col(c).cast("double").alias(c) for c in names], "global_corr", "final_corr", "local_kept")
    ref = gates.select("fov").distinct().select("fov", F.lit(reference_round).alias("round"), *[F.lit(0.0).alias(c) for c in names], F.lit(1.0).alias("global_corr"), F.lit(1.0).alias("final_corr"), F.lit(False).alias("local_kept"))
    return rows.unionByName(ref)


def overlay(before: DataFrame, after: DataFrame, reference_round: int, height: int, width: int) -> DataFrame:
    """``fov, round, corr_before, corr_after``."""
    a, b = (correlations(p, reference_round, height, width).withColumnRenamed("corr", n) for p, n in ((before, "corr_before"), (after, "corr_after")))
    return a.join(b, ["fov", "round"], "full_outer")
