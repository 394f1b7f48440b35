"""Quality rules combined by weak supervision."""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import documents, stage, table
from glimmer.llm.text_stats import keyed, only, ratios, with_stats


@dataclass(frozen=True)
class Vote:
    """A rule: "bad" where ``stat`` is under ``below`` or over ``above``, "good" from ``low`` to ``high``, else it abstains.

    ``fault``: what it looks for. Rules of one fault are expected to agree on bad texts. ``alarms``: the least and the most
    of sound texts that it may call bad, as it is written: a strict rule is never wrong about them, a graded one at times.
    """

    stat: str
    fault: str
    below: float | None = None
    above: float | None = None
    low: float = 0.0
    high: float = 1.0
    alarms: tuple[float, float] = (0.01, 0.05)


STRICT = (0.0001, 0.001)
RULES = {
    "symbols": Vote("other_symbols", "symbols", above=0.1, high=0.03, alarms=STRICT),
    "bars": Vote("bars", "table", above=0.1, high=0.01, alarms=STRICT),
    "marks": Vote("marks", "shouting", above=0.2, high=0.05, alarms=STRICT),
    "capitals": Vote("upper", "shouting", above=0.15, high=0.08),
    "long_repeats": Vote("repeats", "repetition", above=0.3, high=0.03, alarms=STRICT),
    "repeats": Vote("repeats", "repetition", above=0.15, high=0.05),
    "variety": Vote("distinct", "repetition", below=0.5, low=0.6, high=1.0),
    "dup_lines": Vote("dup_lines", "repetition", above=0.35, high=0.1),
    "word_length": Vote("word_length", "words", below=3.0, above=10.0, low=3.5, high=9.0),
}
#: Votes that are taken as seen before any data, of each rule in each class, whatever the number of texts.
PSEUDO_VOTES = 20.0
#: A rule calls at least so many of the texts with its fault bad; else such a class could come to mean sound texts.
LEAST_CAUGHT = 0.3
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def votes(rules: dict[str, Vote] = RULES) -> dict[str, Column]:
    """One column for each rule: 1 good, -1 bad, 0 abstains. Texts without words get no vote."""
    of, out = ratios(), {}
    for name, r in rules.items():
        x, bad = of[r.stat], F.lit(False)
        bad = bad | (x < r.below) if r.below is not None else bad
        bad = bad | (x > r.above) if r.above is not None else bad
        vote = F.when(F.col("n_words") == 0, 0).when(bad, -1).when((x >= r.low) & (x <= r.high), 1).otherwise(0)
        out[name] = vote.cast("int")
    return out


@dataclass(frozen=True)
class Model:
    """``shares`` of the classes, sound texts first, then one for each fault; ``bad``: by class and rule the chance that a
    vote is "bad"."""

    shares: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]


def estimate(counts: dict[tuple, int], rules: dict[str, Vote], rounds: int = 500, tolerance: float = 1e-9) -> Model:
    """The model of largest posterior probability for counts of vote patterns, by expectation-maximisation.

    Votes are independent within a class. Bad texts are a class for each fault, since rules of one fault agree on them beyond
    what a single class of bad texts allows, and rules of different faults do not. It starts from texts without a bad vote
    as sound and the others as of the faults their votes name, half sound if there is but one. A rule's false alarms stay
    within its ``alarms``, and it catches at least ``LEAST_CAUGHT`` of its fault; all else is estimated, with ``PSEUDO_VOTES`` for each rule and class. An abstention says nothing.
    """
    faults = list(dict.fromkeys(r.fault for r in rules.values()))
    patterns = np.array([p for p in counts] or [[0] * len(rules)])
    n = np.array([counts[p] for p in counts] or [0], float)
    is_bad, is_good = (patterns == -1).astype(float), (patterns == 1).astype(float)
    own = np.array([[r.fault == f for r in rules.values()] for f in faults], float)
    least, most = (np.array([r.alarms[k] for r in rules.values()]) for k in (0, 1))
    prior = np.vstack([(least + most) / 2, 0.6 * own + 0.1])
    weight = np.hstack([np.where(is_bad.sum(1) == 0, 1.0, np.where(is_bad.sum(1) == 1, 0.5, 0.02))[:, None], 0.02 + is_bad @ own.T])
    weight /= weight.sum(1, keepdims=True)
    for _ in range(rounds):
        of = weight * n[:, None]
        shares = (of.sum(0) + 1) / (of.sum() + len(faults) + 1)
        bad = (of.T @ is_bad + PSEUDO_VOTES * prior) / (of.T @ (is_bad + is_good) + PSEUDO_VOTES)
        bad[0] = np.clip(bad[0], least, most)
        bad[1:] = np.where(own > 0, np.maximum(bad[1:], LEAST_CAUGHT), bad[1:])
        logs = np.log(shares) + is_bad @ np.log(bad).T + is_good @ np.log(1 - bad).T
        was, weight = weight, np.exp(logs - logs.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        if np.abs(weight - was).max() < tolerance:
            break
    return Model(tuple(map(float, shares)), tuple(tuple(map(float, b)) for b in bad))


def posterior(pattern: tuple, model: Model) -> float:
    """Probability of sound given the votes."""
    logs = [math.log(s) + sum(math.log(b if v == -1 else 1 - b) for v, b in zip(pattern, bad, strict=True) if v) for s, bad in zip(model.shares, model.bad, strict=True)]
    top = max(logs)
    return math.exp(logs[0] - top) / sum(math.exp(x - top) for x in logs)


class Judge:
    """The rules with their accuracies, estimated over the votes of all rows of ``counts`` (see ``with_stats``).

    Only the counts of vote patterns, at most 3 ** rules however many rows there are, come to the driver.
    """

    def __init__(self, counts: DataFrame, rules: dict[str, Vote] = RULES, least_words: int = 50, most_repeats: float = 0.5, threshold: float = 0.5):
        self.votes, self.least_words, self.most_repeats, self.threshold = votes(rules), least_words, most_repeats, threshold
        voted = self.patterned(counts).groupBy("_pattern").count().collect()
        places = [3**k for k in range(len(rules))]
        found = {r["_pattern"]: r["count"] for r in sorted(voted)}
        patterns = {p: tuple(p // k % 3 - 1 for k in places) for p in found}
        self.model = estimate({patterns[p]: n for p, n in found.items()}, rules)
        self.posteriors = [(p, posterior(v, self.model)) for p, v in patterns.items()]

    def patterned(self, counts: DataFrame) -> DataFrame:
        """``counts`` with the votes as digits of one number, ``_pattern``."""
        digits = [(v + 1) * 3**k for k, v in enumerate(self.votes.values())]
        return counts.withColumn("_pattern", sum(digits, F.lit(0)))

    def verdict(self, counts: DataFrame) -> DataFrame:
        """``counts`` with ``posterior``, ``base_failed`` and ``kept``; the posteriors of the patterns that occur are broadcast."""
        known = counts.sparkSession.createDataFrame(self.posteriors, "_pattern int, posterior double")
        failed = (F.col("n_words") < self.least_words) | (F.col("n_repeat_words") > self.most_repeats * F.col("n_words"))
        judged = self.patterned(counts).join(F.broadcast(known), "_pattern").drop("_pattern").withColumn("base_failed", failed)
        return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= self.threshold))


def quality_rules(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, posterior`` of each row.

    ``base_failed``: fewer than ``least_words`` words, or more than the share ``most_repeats`` of words in repeated
    3-word windows. The other rules vote or abstain (see :class:`Judge`). ``posterior`` is the probability of good;
    ``kept`` needs at least ``threshold`` and no ``base_failed``.

    Null text is empty, has no words, and so fails. Null ids and repeated rows are rows of their own. An empty table
    gives an empty result. Other columns are ignored.
    """
    counts = stage(with_stats(documents(df, id_col, text_col)))
    return Judge(counts, **options).verdict(counts).select("doc_id", *BASE, "base_failed", "kept", "posterior")


def keep_good(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that :func:`quality_rules` keeps, all columns as they were."""
    counts = stage(with_stats(keyed(df, id_col, text_col), "th"))
    return only(df, Judge(counts, **options).verdict(counts).filter("kept"), id_col, text_col)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


QUERIES = {"op9_quality_rules": op9_quality_rules}
