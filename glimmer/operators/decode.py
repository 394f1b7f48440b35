"""Decoding of spots into genes."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glimmer.functions import calling
from glimmer.operators.stencil import staged

BACKGROUND = "background"
#: Codebooks up to this many rows are broadcast.
MOST_CODES = 1_000_000


def matrices(intensities: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, v`` (rounds of channels) from ``keys, round_idx, chan_idx, v``: one shuffle by spot."""
    rows = intensities.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("round_idx", "chan_idx", "v"))).alias("cells"))
    rounds = F.array_distinct(F.transform("cells", lambda c: c["round_idx"]))
    return rows.select(*keys, F.transform(rounds, lambda r: F.transform(F.filter("cells", lambda c: c["round_idx"] == r), lambda c: c["v"])).alias("v"))


def called(spots: DataFrame, bias: dict | None = None, n_channels: int = 4) -> DataFrame:
    """``spots`` (with ``v``) and ``normal, call, score, valid, quality, margin, intensity``. No shuffle.

    ``intensity`` is the largest raw value and replaces a column of that name; ``quality`` is the mean score, null if a
    round has no single largest channel. All are computed in one pass behind a generator: a later filter on them is not
    pushed below it, which would compute them again.
    """
    def every(normal, rounds, score):
        margin = F.transform(rounds, lambda x: x["margin"])
        call = F.transform(rounds, lambda x: x["call"])
        return F.struct(normal.alias("normal"), call.alias("call"), score.alias("score"), calling.all_valid(score).alias("valid"), calling.mean(score).alias("quality"), calling.mean(margin).alias("margin"))

    normal = calling.biased(calling.l2_normalised(F.col("v")), bias or {}, n_channels)
    of = lambda m: calling.let(calling.rounds(m), lambda r: calling.let(F.transform(r, lambda x: x["score"]), lambda score: every(m, r, score)))
    kept = [c for c in spots.columns if c not in ("normal", "call", "score", "valid", "quality", "margin", "intensity")]
    return spots.select(*kept, F.inline(F.transform(F.array(normal), of))).withColumn("intensity", calling.largest(F.col("v")))


def quality_filtered(spots: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Valid spots with a quality under ``threshold``, and their ``barcode``."""
    return spots.filter(F.col("valid") & (F.col("quality") < threshold)).withColumn("barcode", calling.barcode(F.col("call")))


def mapped(spots: DataFrame, codebook: DataFrame) -> DataFrame:
    """``spots`` with ``gene``, ``background`` where no code is the barcode. Codebooks of checked size are broadcast."""
    codes = codebook.select("barcode", "gene")
    codes = F.broadcast(codes) if codes.count() <= MOST_CODES else codes
    return spots.join(codes, "barcode", "left").withColumn("gene", F.coalesce("gene", F.lit(BACKGROUND)))


def lengths_match(codebook: DataFrame, n_rounds: int) -> bool:
    """Whether all codes are as long as there are rounds."""
    return codebook.filter(F.length("barcode") != n_rounds).isEmpty()


def round_quality(spots: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``fov, round_idx, quality, passed``: the mean score of each round, over spots given."""
    each = spots.select("fov", F.posexplode("score").alias("round_idx", "s"))
    return each.groupBy("fov", "round_idx").agg(F.avg("s").alias("quality")).withColumn("passed", F.col("quality") < threshold)


def mapping_rates(spots: DataFrame, by: str = "fov") -> DataFrame:
    """``by, n_total, n_valid, n_quality, n_rules, n_mapped, rate_quality, rate_rules`` from spots with ``valid``,
    ``quality_keep``, ``rule_keep`` and ``gene``."""
    hit = F.col("rule_keep") & (F.col("gene") != BACKGROUND)
    counts = spots.groupBy(by).agg(F.count("*").alias("n_total"), F.count_if("valid").alias("n_valid"), F.count_if("quality_keep").alias("n_quality"), F.count_if("rule_keep").alias("n_rules"), F.count_if(hit).alias("n_mapped"))
    return counts.withColumns({"rate_quality": F.coalesce(F.try_divide("n_mapped", "n_quality"), F.lit(0.0)), "rate_rules": F.coalesce(F.try_divide("n_mapped", "n_rules"), F.lit(0.0))})


def top_genes(spots: DataFrame, n: int = 10) -> DataFrame:
    """``gene, n``: the most frequent genes, without background."""
    return spots.filter(F.col("gene") != BACKGROUND).groupBy("gene").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "gene").limit(n)


def masks_within(weights: list[float], radius: float) -> list[tuple[int, ...]]:
    """Sets of positions of a total weight up to ``radius``, without those inside another one: codes whose distance is within
    the radius are alike outside of one of them."""
    found: list[tuple[int, ...]] = []

    def grow(at: int, chosen: tuple[int, ...], left: float) -> None:
        if at == len(weights):
            if all(k in chosen or w > left + 1e-9 for k, w in enumerate(weights)):
                found.append(chosen)
            return
        if weights[at] <= left + 1e-9:
            grow(at + 1, (*chosen, at), left - weights[at])
        grow(at + 1, chosen, left)

    grow(0, (), radius)
    return found


def codes_within(seen: DataFrame, codes: DataFrame, weights: list[float], radius: float) -> DataFrame:
    """``barcode, d, n, new_gene`` for each barcode of ``seen`` and each distance up to ``radius`` at which it has codes: how
    many, and the gene of the first. ``codes``: ``code_ix, code, new_gene``.

    The index: barcodes and codes with the positions of each mask left out meet by equality with the mask, so a barcode
    meets only the codes that are alike in all other digits. A code that is nearer meets it under several masks and counts once.
    """
    masks = masks_within(weights, radius)
    rest = lambda c: F.array(*[F.struct(F.lit(m).alias("mask"), F.concat(F.lit(""), *[F.substring(c, k + 1, 1) for k in range(len(weights)) if k not in out]).alias("rest")) for m, out in enumerate(masks)])
    met = seen.select("barcode", F.inline(rest("barcode"))).join(codes.select("code_ix", "code", "new_gene", F.inline(rest("code"))), ["mask", "rest"])
    differs = sum([F.when(F.substring("barcode", k + 1, 1) != F.substring("code", k + 1, 1), w).otherwise(0.0) for k, w in enumerate(weights)], F.lit(0.0))
    pairs = met.select("barcode", "code_ix", "new_gene", differs.alias("d")).dropDuplicates(["barcode", "code_ix"])
    return pairs.groupBy("barcode", "d").agg(F.count("*").alias("n"), F.min_by("new_gene", "code_ix").alias("new_gene"))


def rescue_table(barcodes: DataFrame, codebook: DataFrame, max_distance: float, min_gap: float, weights: list[float] | None = None) -> DataFrame:
    """``barcode, new_gene, distance, gap`` of distinct ``barcodes`` with a near enough and clear enough code.

    The distance is the weighted number of differing digits, the gap what the second nearest code is farther away. Codes are
    looked up by masked digits (see :func:`codes_within`), first up to ``max_distance``; barcodes that have one there, but
    less than two codes so far, are looked up again with a wider radius until the second is found. Wider rounds have
    more masks but fewer barcodes; no barcode is compared with all codes unless the codes leave no other way.
    """
    length = codebook.select(F.max(F.length("barcode"))).first()[0] or 0
    if weights is not None and len(weights) != length:
        raise ValueError("one weight for each digit is needed")
    weights = [float(w) for w in weights or [1.0] * length]
    if any(w < 0 for w in weights):
        raise ValueError("weights are not negative")
    seen = barcodes.select("barcode").distinct().filter((F.length("barcode") == length) & F.col("barcode").rlike("^[0-9]+$"))
    codes = codebook.filter(F.length("barcode") == length).select("code_ix", F.col("barcode").alias("code"), F.col("gene").alias("new_gene"))
    total, step, radius, found = sum(weights), max(weights, default=0.0), max_distance, None
    while True:
        near = codes_within(seen, codes, weights, min(radius, total)).groupBy("barcode").agg(F.array_sort(F.collect_list(F.struct("d", "n", "new_gene"))).alias("ds"))
        first, second = F.get("ds", F.lit(0)), F.get("ds", F.lit(1))["d"]
        gap = F.when(first["n"] > 1, 0.0).otherwise(second - first["d"])
        near = staged(near.select("barcode", first["new_gene"].alias("new_gene"), first["d"].alias("distance"), gap.alias("gap")).filter(F.col("distance") <= max_distance))
        last = radius >= total
        known = near.withColumn("gap", F.coalesce("gap", F.lit(0.0))) if last else near.filter("gap is not null")
        found = known if found is None else found.unionByName(known)
        seen = near.filter("gap is null").select("barcode")
        if last or seen.isEmpty():
            return found.filter(F.col("gap") >= min_gap)
        radius += step


def rescued(spots: DataFrame, codebook: DataFrame, max_distance: float = 1.0, min_gap: float = 1.0, weights: list[float] | None = None, target: str = BACKGROUND) -> DataFrame:
    """``spots`` with genes replaced from :func:`rescue_table` where they change, and ``rescue_applied``, ``rescue_rule`` (whether
    there is one for the barcode), ``rescue_prev_gene``, ``rescue_distance``, ``rescue_gap``. ``target``: background spots only, or "all"."""
    wanted = F.col("gene") == BACKGROUND if target == BACKGROUND else F.lit(True)
    table = rescue_table(spots.filter(wanted), codebook, max_distance, min_gap, weights)
    joined = spots.join(table, "barcode", "left")
    hit = F.coalesce(wanted & (F.col("new_gene") != F.col("gene")), F.lit(False))
    out = joined.withColumns({"rescue_applied": hit, "rescue_rule": F.coalesce(wanted & F.col("new_gene").isNotNull(), F.lit(False))})
    hit = F.col("rescue_applied")
    return out.withColumns({"rescue_prev_gene": F.when(hit, F.col("gene")), "rescue_distance": F.when(hit, F.col("distance")), "rescue_gap": F.when(hit, F.col("gap")), "gene": F.when(hit, F.col("new_gene")).otherwise(F.col("gene"))}).drop("new_gene", "distance", "gap")


def rescue_report(before: DataFrame, after: DataFrame, codebook: DataFrame, max_distance: float = 1.0, min_gap: float = 1.0) -> DataFrame:
    """``n_candidates, n_unique_barcodes, n_rescue_rules, n_rescued_spots``."""
    wanted = before.filter(F.col("gene") == BACKGROUND)
    a = wanted.agg(F.count("*").alias("n_candidates"), F.countDistinct("barcode").alias("n_unique_barcodes"))
    b = rescue_table(wanted, codebook, max_distance, min_gap).agg(F.count("*").alias("n_rescue_rules"))
    c = after.agg(F.count_if("rescue_applied").alias("n_rescued_spots"))
    return a.crossJoin(b).crossJoin(c)


def numbered(genes: DataFrame, key: str) -> DataFrame:
    """Genes with ``code_ix`` from 0 in the order of ``key``: a gene list is small and has one order."""
    return genes.withColumn("code_ix", F.row_number().over(Window.orderBy(key)) - 1)
