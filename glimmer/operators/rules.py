"""Decoding rules: columns that keep rows or give them a penalty."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glimmer.functions import calling
from glimmer.functions.codebook import ends_hold

Built = tuple[Column, Column]
REGISTRY: dict[str, dict[str, Callable[[dict], Built]]] = {"spot": {}, "barcode": {}}


@dataclass(frozen=True)
class Rule:
    name: str
    stage: str
    enabled: bool = True
    hard: bool = True
    weight: float = 1.0
    params: dict = field(default_factory=dict, hash=False)


def rule(name: str, *stages: str):
    """Registers a builder of (keep, penalty) columns from parameters."""
    def add(f):
        for s in stages:
            REGISTRY[s][name] = f
        return f
    return add


@rule("quality_mean_lt", "spot")
def quality_mean_lt(params: dict) -> Built:
    """Valid spots with a mean score under ``threshold``; the penalty is the excess. Needs ``quality`` and ``valid``."""
    t = float(params.get("threshold", 0.5))
    q = F.col("quality")
    return F.col("valid") & (q < t), F.when(F.col("valid"), F.greatest(q - t, F.lit(0.0))).otherwise(0.0)


@rule("channel_margin_mean_gt", "spot")
def channel_margin_mean_gt(params: dict) -> Built:
    """Valid spots with a mean margin between the two largest channels of at least ``threshold``; the penalty is what
    lacks. A spot that is not valid is not kept and has no penalty."""
    t = float(params.get("threshold", 0.0))
    m, valid = F.col("margin"), F.col("valid")
    return valid & (m >= t), F.when(valid, F.greatest(t - m, F.lit(0.0))).otherwise(0.0)


@rule("end_base_pattern", "barcode")
def end_base_pattern(params: dict) -> Built:
    ok = F.coalesce(ends_hold(F.col("barcode"), params["segments"], params["order"]), F.lit(False))
    return ok, F.when(ok, 0.0).otherwise(1.0)


@rule("keep_all", "spot", "barcode")
def keep_all(params: dict) -> Built:
    return F.lit(True), F.lit(0.0)


def active(rules: list[Rule], stage: str) -> list[tuple[Rule, Column, Column]]:
    """The enabled rules of a stage with their columns; an unknown name is an error, a blank one is skipped."""
    out = []
    for r in rules:
        if not r.name.strip() or not r.enabled or r.stage != stage:
            continue
        if r.name not in REGISTRY[stage]:
            raise ValueError(f"unknown rule {r.name} at stage {stage}")
        out.append((r, *REGISTRY[stage][r.name](r.params)))
    return out


def with_rules(df: DataFrame, rules: list[Rule], stage: str, max_soft_penalty: float | None = None) -> DataFrame:
    """``df`` with ``hard_keep``, ``penalty`` (over all rules, weighted) and ``keep``. The gate is for the spot stage."""
    keep, penalty = F.lit(True), F.lit(0.0)
    for r, k, p in active(rules, stage):
        keep = keep & k if r.hard else keep
        penalty = penalty + r.weight * p
    gate = penalty <= max_soft_penalty if max_soft_penalty is not None and stage == "spot" else F.lit(True)
    return df.withColumns({"hard_keep": keep, "penalty": penalty, "keep": keep & gate})


def rule_report(df: DataFrame, rules: list[Rule], stage: str, max_soft_penalty: float | None = None, by: str = "fov") -> DataFrame:
    """``by, stage, place, name, before, after, failed`` of each rule in order, and of the penalty gate, in one aggregation."""
    running, rows, penalty = F.lit(True), [], F.lit(0.0)
    for r, k, p in active(rules, stage):
        before, running = running, running & k if r.hard else running
        rows.append((r.name, before, running, ~k))
        penalty = penalty + r.weight * p
    if max_soft_penalty is not None and stage == "spot":
        gate = penalty <= max_soft_penalty
        rows.append(("soft_penalty_gate", running, running & gate, ~gate))
    lines = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(n).alias("name"), F.count_if(b).alias("before"), F.count_if(a).alias("after"), F.count_if(f).alias("failed")) for k, (n, b, a, f) in enumerate(rows)])
    return df.groupBy(by).agg(lines.alias("lines")).select(by, F.lit(stage).alias("stage"), F.inline("lines"))


DEFAULT = [Rule("quality_mean_lt", "spot"), Rule("end_base_pattern", "barcode")]


def with_defaults(rules: list[Rule], segments: list, order: list[str], threshold: float = 0.5) -> list[Rule]:
    """The rules as they are; without any, the quality and end-base rules."""
    return rules or [Rule("quality_mean_lt", "spot", params={"threshold": threshold}), Rule("end_base_pattern", "barcode", params={"segments": segments, "order": order})]
