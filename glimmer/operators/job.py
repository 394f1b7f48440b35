"""From voxels to gene counts: cleaning, alignment, spots, intensities and decoding of all FOVs in one job."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmer.operators import align, decode, extract, pyramid, register, rules, run, spots
from glimmer.operators import preprocess as pre
from glimmer.operators import stencil as st


@dataclass(frozen=True)
class Settings:
    """What a job needs to know. ``sizes``: the volume's extent by axis; ``steps``: cleaning steps, ``dense`` if one of them needs
    every voxel; ``scale``: what raw values are divided by (see ``preprocess.scaled``); ``tile``, ``radius``: by axis, of local
    fields, if there are to be any."""

    sizes: dict[str, int]
    steps: list = field(default_factory=list)
    scale: str = "uint8"
    dense: bool = False
    reference_round: int = 1
    threshold: float = 0.1
    box: tuple[int, int, int] = (3, 3, 3)
    rules: list = field(default_factory=list)
    max_soft_penalty: float | None = None
    rescue: dict | None = None
    max_shift: float = 200.0
    decimals: int = 1
    tile: dict[str, int] | None = None
    radius: dict[str, int] | None = None


@dataclass(frozen=True)
class Tables:
    """What a job leaves: each table but ``counts`` and ``report`` is staged."""

    clean: DataFrame
    shifts: DataFrame
    spots: DataFrame
    intensities: DataFrame
    decoded: DataFrame
    report: DataFrame
    counts: DataFrame


def clean(voxels: DataFrame, s: Settings) -> DataFrame:
    """Voxels (``fov, round, channel, z, y, x, v``) through all cleaning steps, as bytes, without zeros."""
    scaled = pre.scaled(voxels, s.scale)
    if s.dense:
        scaled = st.densified(scaled, s.sizes["y"], s.sizes["x"], s.sizes["z"])
    done = pre.cleaned(scaled, s.steps, pre.Shape(s.sizes["y"], s.sizes["x"]), s.reference_round)
    return st.sparsified(pre.quantised(done))


def aligned(voxels: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame | None]:
    """Each round's shift onto the reference round with its scores (see :func:`register.transform_table`), and, with tiles in the
    settings, the nodes of local fields that were kept."""
    volume = register.channel_projection(voxels)
    if s.tile:
        return align.align(volume, s.reference_round, s.sizes, s.tile, s.radius, max_shift=s.max_shift, decimals=s.decimals)
    found = pyramid.pyramid_shift(volume, s.reference_round, s.sizes, max_shift=s.max_shift, decimals=s.decimals)
    gates = register.gated(found.withColumnsRenamed({"score": "global_corr"}).withColumn("local_corr", F.lit(None).cast("double")))
    return register.transform_table(gates, s.reference_round), None


def run_job(voxels: DataFrame, manifest: DataFrame, codebook: DataFrame, s: Settings) -> Tables:
    """All tables of a job over all FOVs.

    ``manifest``: ``fov, round, channel, role``; only channels with the role seq are read. Spots are found in each of them in
    the reference round; a channel or round without voxels has none, and intensities 0. Stages are written to the
    checkpoint folder, so a lost executor costs no more than its own part of the stage that runs.
    """
    wanted = manifest.filter("role = 'seq'").select(*st.IMAGE)
    done = st.staged(clean(voxels.join(wanted, st.IMAGE, "left_semi"), s))
    moved, flow = aligned(done, s)
    moved = st.staged(moved)
    reference = done.filter(F.col("round") == s.reference_round)
    found = st.staged(spots.numbered(spots.maxima_spots(reference, s.threshold, 255.0)))
    rounds = manifest.select("fov", "round").distinct()
    counts_of = {c: -(-s.sizes[c] // s.tile[c]) for c in s.sizes} if s.tile else None
    places = extract.mapped_coordinates(found.drop("round"), rounds, moved, volume_flow=flow, tiles=s.tile, counts=counts_of)
    read = st.staged(extract.intensity_table(found, manifest, extract.box_sums(places, done, s.box)))
    matrices = decode.matrices(read, ["fov", "spot_id"])
    n_channels = wanted.select("channel").distinct().count()
    decoded = st.staged(run.decoded(matrices, codebook, s.rules, max_soft_penalty=s.max_soft_penalty, n_channels=n_channels, rescue=s.rescue))
    kept = run.after_rules(decoded)
    counts = kept.filter(F.col("gene") != decode.BACKGROUND).groupBy("fov", "gene").agg(F.count("*").alias("n"))
    return Tables(done, moved, found, read, decoded, run.report(decoded, s.rules, s.max_soft_penalty, s.rescue), counts)


def default_rules(segments: list, order: list[str], threshold: float = 0.5) -> list:
    return rules.with_defaults([], segments, order, threshold)
