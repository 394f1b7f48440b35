"""Alignment of whole rounds: shift, local field where it helps, and the table of what was kept."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmer.operators import field, pyramid, register
from glimmer.operators.stencil import staged


def places_of(rounds: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """``fov, round, z, y, x``: every place of the volume in each of ``rounds`` (``fov, round``)."""
    for c in field.AXES:
        rounds = rounds.withColumn(c, F.explode(F.sequence(F.lit(0), F.lit(sizes[c] - 1))))
    return rounds.select("fov", "round", *field.AXES)


def align(volume: DataFrame, reference_round: int, sizes: dict[str, int], tile: dict[str, int], radius: dict[str, int], *, least: float = 0.2, sigma: float = 1.0, crop: int = 1024, max_shift: float = 200.0, decimals: int = 1) -> tuple[DataFrame, DataFrame]:
    """``(table, flow)`` of ``volume`` (``fov, round, z, y, x, v``).

    ``table``: ``fov, round, dz, dy, dx, global_corr, final_corr, local_kept`` with the reference round, not moved. Each round is
    shifted onto the reference (:func:`pyramid.pyramid_shift`); ``global_corr`` is the correlation of the z projections after that.
    Rounds of at least ``least`` get a field (block matching, smoothed), which stays if it does not make the correlation worse;
    ``flow`` has the nodes of those that stay. Shifted volumes are staged, since three steps read them.
    """
    h, w = sizes["y"], sizes["x"]
    found = staged(pyramid.pyramid_shift(volume, reference_round, sizes, max_shift=max_shift, decimals=decimals))
    is_ref = F.col("round") == reference_round
    ref = volume.filter(is_ref).select("fov", "round", *field.AXES, "v")
    moved = staged(register.shifted(volume.filter(~is_ref), found, sizes).unionByName(ref))
    corr = lambda v: register.correlations(register.z_projection(v), reference_round, h, w, crop).filter(~is_ref)
    scores = staged(corr(moved).withColumnRenamed("corr", "global_corr"))
    good = scores.filter(F.col("global_corr") >= least).select("fov", "round")
    counts = {c: -(-sizes[c] // tile[c]) for c in field.AXES}
    near = moved.filter(~is_ref).join(good, ["fov", "round"], "left_semi")
    matched = field.block_matched(near.unionByName(ref), reference_round, tile, radius, sizes)
    nodes = staged(field.smoothed_nodes(matched, sigma, counts))
    there = places_of(good, sizes)
    dense = field.sampled(there, nodes, tile, counts, ["fov", "round", *field.AXES])
    local = corr(field.warped(near, dense).unionByName(ref)).withColumnRenamed("corr", "local_corr")
    gates = staged(register.gated(found.join(scores, ["fov", "round"]).join(local, ["fov", "round"], "left"), least))
    return register.transform_table(gates, reference_round), register.kept_flow(nodes, gates)
