"""The whole decoding of spots as one table, and its report."""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glimmer.functions import calling
from glimmer.operators import decode, rules
from glimmer.operators.rules import Rule


def decoded(spots: DataFrame, codebook: DataFrame, ruleset: list[Rule], *, max_soft_penalty: float | None = None, bias: dict | None = None, n_channels: int = 4, rescue: dict | None = None) -> DataFrame:
    """Every spot (``v``: rounds of channels) with what became of it: ``valid, quality, margin, intensity``; ``spot_flags``,
    ``spot_keep``; of those kept ``barcode, gene, barcode_flags, barcode_keep``; of those kept again, with ``rescue`` (the
    parameters of :func:`decode.rescued`), ``gene_before, rescue_rule, rescue_applied, rescue_distance, rescue_gap``.

    Flags hold the verdict of each enabled rule of a stage, in order. A spot is kept if it is valid and all hard rules and
    the penalty gate hold. Stage the result where it is read more than once (tables, report).
    """
    flags = lambda stage: F.array(*[F.coalesce(k, F.lit(False)) for _, k, _ in rules.active(ruleset, stage)]).cast("array<boolean>")
    called = decode.called(spots, bias, n_channels)
    judged = rules.with_rules(called, ruleset, "spot", max_soft_penalty).withColumn("spot_flags", flags("spot"))
    kept = F.col("valid") & F.coalesce("keep", F.lit(False))
    read = judged.withColumns({"spot_keep": kept, "soft_penalty": F.col("penalty")}).drop("hard_keep", "penalty", "keep").withColumn("barcode", F.when(F.col("spot_keep"), calling.barcode(F.col("call"))))
    named = decode.mapped(read, codebook).withColumn("gene", F.when(F.col("spot_keep"), F.col("gene")))
    ended = rules.with_rules(named, ruleset, "barcode").withColumn("barcode_flags", F.when(F.col("spot_keep"), flags("barcode")))
    out = ended.withColumn("barcode_keep", F.col("spot_keep") & F.coalesce("keep", F.lit(False))).drop("hard_keep", "penalty", "keep")
    if rescue is None:
        return out
    saved = decode.rescued(out.filter("barcode_keep"), codebook, **rescue)
    return saved.withColumn("gene_before", F.coalesce("rescue_prev_gene", "gene")).drop("rescue_prev_gene").unionByName(out.filter(~F.col("barcode_keep")), allowMissingColumns=True)


def after_rules(run: DataFrame) -> DataFrame:
    """The spots that passed both stages."""
    return run.filter("barcode_keep")


def before_barcode_rules(run: DataFrame) -> DataFrame:
    """The spots that passed the first stage, with the genes they had there."""
    spots = run.filter("spot_keep")
    return spots.withColumn("gene", F.coalesce("gene_before", "gene")) if "gene_before" in run.columns else spots


def _lines(ruleset: list[Rule], stage: str, gate: float | None) -> Column:
    """One struct a rule: its settings, counts along the running hard verdict, and details of its own."""
    flags, here = F.col(f"{stage}_flags"), F.lit(True) if stage == "spot" else F.col("spot_keep")
    running, lines = here, []
    n = lambda c: F.count_if(F.coalesce(here & c, F.lit(False)))

    def line(name, hard, weight, before, after, failed, params, **details):
        kinds = {"threshold": "double", "n_total": "long", "n_valid_input": "long", "n_pass": "long", "avg_margin_valid": "double"}
        own = F.struct(*[details.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])
        return F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("name"), F.lit(hard).alias("hard"), F.lit(float(weight)).alias("weight"), n(before).alias("before"), n(after).alias("after"), n(failed).alias("failed_by_rule"), F.lit(json.dumps(params, default=str)).alias("params"), own.alias("details"))

    for k, (r, _, _) in enumerate(rules.active(ruleset, stage)):
        ok = flags[k]
        before, running = running, running & ok if r.hard else running
        details = {"n_pass": n(ok)}
        if r.name in ("quality_mean_lt", "channel_margin_mean_gt"):
            details |= {"threshold": F.lit(float(r.params.get("threshold", 0.5 if r.name == "quality_mean_lt" else 0.0))), "n_valid_input": n(F.col("valid"))}
        if r.name == "channel_margin_mean_gt":
            details["avg_margin_valid"] = F.avg(F.when(F.col("valid"), F.col("margin")))
        if r.name == "end_base_pattern":
            details["n_total"] = n(F.lit(True))
        lines.append(line(r.name, r.hard, r.weight, before, running, ~ok, {k: v for k, v in r.params.items() if k not in ("segments", "order")}, **details))
    if gate is not None and stage == "spot":
        ok = F.coalesce(F.col("soft_penalty") <= gate, F.lit(False))
        lines.append(line("soft_penalty_gate", True, 1.0, running, running & ok, ~ok, {"max_soft_penalty": gate}))
    return F.array(*lines)


def report(run: DataFrame, ruleset: list[Rule], max_soft_penalty: float | None = None, rescue: dict | None = None, by: str = "fov") -> DataFrame:
    """One row a FOV: ``n_total_spots, n_after_spot_rules, n_after_barcode_rules, spot_rules, barcode_rules``, and with
    ``rescue`` (as for :func:`decoded`) ``weighted_rescue``: all counts of the run in one aggregation."""
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    parts = [F.count("*").alias("n_total_spots"), count(F.col("spot_keep")).alias("n_after_spot_rules"), count(F.col("barcode_keep")).alias("n_after_barcode_rules"), _lines(ruleset, "spot", max_soft_penalty).alias("spot_rules"), _lines(ruleset, "barcode", None).alias("barcode_rules")]
    if rescue is not None:
        target = rescue.get("target", decode.BACKGROUND)
        asked = F.col("barcode_keep") & (F.col("gene_before") == decode.BACKGROUND if target == decode.BACKGROUND else F.lit(True))
        of = lambda c: F.count_distinct(F.when(c, F.col("barcode")))
        settings = [F.lit(True).alias("enabled"), F.lit(target).alias("target"), F.lit(float(rescue.get("max_distance", 1.0))).alias("max_weighted_distance"), F.lit(float(rescue.get("min_gap", 1.0))).alias("min_second_gap")]
        parts.append(F.struct(*settings, count(asked).alias("n_candidates"), of(asked).alias("n_unique_barcodes"), of(asked & F.col("rescue_rule")).alias("n_rescue_rules"), count(F.col("rescue_applied")).alias("n_rescued_spots")).alias("weighted_rescue"))
    return run.groupBy(by).agg(*parts)


def warnings(run: DataFrame, codebook: DataFrame, n_rounds: int, weak: float = 0.7, threshold: float = 0.5) -> DataFrame:
    """``fov, worst_round, worst_quality, weak, length_differs``: the round whose mean score over the spots that passed the first
    stage is the worst (highest); ``weak`` if the best round's is over ``weak``; ``length_differs`` if codes are not as long
    as there are rounds."""
    each = decode.round_quality(run.filter("spot_keep"), threshold)
    length = codebook.agg(F.coalesce(F.max(F.length("barcode") != n_rounds), F.lit(False)).alias("length_differs"))
    worst = each.groupBy("fov").agg(F.max_by("round_idx", F.struct("quality", -F.col("round_idx"))).alias("worst_round"), F.max("quality").alias("worst_quality"), (F.min("quality") > weak).alias("weak"))
    return worst.crossJoin(length)
