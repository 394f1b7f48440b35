"""A sparse ensemble of rules that scores the quality of texts."""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import documents, stage, table
from glimmer.llm.text_stats import keyed, only, ratios, with_stats

#: A rule: (statistic, "<=" or ">", value) conditions that must all hold.
Rule = tuple[tuple[str, str, float], ...]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text has remainder 0; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def grow(x: np.ndarray, residual: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], depth: int, least: int, path: tuple = ()):
    """Paths of a regression tree on ``residual``: (column, "<=" or ">", value) conditions of every node but the root."""
    if path:
        yield path
    if depth == 0 or len(rows) < 2 * least:
        return
    y, best = residual[rows], (1e-9, -1, 0.0)
    total, n = y.sum(), len(y)
    for j, values in enumerate(cuts):
        if not len(values):
            continue
        place = np.searchsorted(values, x[rows, j])
        left_n = np.cumsum(np.bincount(place, minlength=len(values) + 1))[:-1]
        left = np.cumsum(np.bincount(place, weights=y, minlength=len(values) + 1))[:-1]
        fits = (left_n >= least) & (n - left_n >= least)
        gain = np.where(fits, left**2 / np.maximum(left_n, 1) + (total - left) ** 2 / np.maximum(n - left_n, 1) - total**2 / n, 0)
        k = int(gain.argmax())
        best = max(best, (float(gain[k]), j, float(values[k])))
    if best[1] < 0:
        return
    _, j, value = best
    low = x[rows, j] <= value
    yield from grow(x, residual, rows[low], cuts, depth - 1, least, (*path, (j, "<=", value)))
    yield from grow(x, residual, rows[~low], cuts, depth - 1, least, (*path, (j, ">", value)))


def holds(x: np.ndarray, path: tuple) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, sign, value in path:
        out &= x[:, j] <= value if sign == "<=" else x[:, j] > value
    return out


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of logistic regression with an L1 penalty, by accelerated proximal gradient steps."""
    n, k = x.shape
    step = 4 * n / (np.linalg.norm(x, 2) ** 2 + n) if k else 1.0
    w = v = np.zeros(k)
    b = c = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(x @ v + c))) - y
        moved = v - step * (x.T @ error / n)
        w_new, b_new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0), c - step * error.mean()
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, b


def fit(x: np.ndarray, y: np.ndarray, names: list[str], *, trees: int = 24, depth: int = 3, penalty: float = 0.001, seed: int = 7) -> tuple[list[tuple[Rule, float]], float]:
    """((rule, weight) of the rules with a weight, intercept). Without both labels there are no rules.

    Trees are boosted on half of the rows each; every path from a root is a candidate rule.
    """
    if len(set(y.tolist())) < 2:
        return [], float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    rng, score, paths = np.random.default_rng(seed), np.zeros(len(y)), {}
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])) for j in range(x.shape[1])]
    for _ in range(trees):
        residual = y - 1 / (1 + np.exp(-score))
        rows = rng.permutation(len(y))[: max(2, len(y) // 2)]
        own = [tuple(sorted(p)) for p in grow(x, residual, rows, cuts, depth, max(2, len(y) // 400))]
        paths.update(dict.fromkeys(own))
        leaves = [p for p in own if not any(set(p) < set(q) for q in own)]
        for p in leaves:
            inside = holds(x, p)
            score[inside] += 0.3 * np.clip(4 * residual[inside].mean(), -4, 4)
    kept, seen = [], set()
    for p in paths:  # rules that hold for the same rows are one
        if 0 < (h := holds(x, p)).sum() < len(y) and (key := h.tobytes()) not in seen:
            seen.add(key)
            kept.append((p, h))
    if not kept:
        return [], float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    w, b = lasso(np.stack([h for _, h in kept], 1).astype(float), y, penalty)
    return [(tuple((names[j], sign, v) for j, sign, v in p), float(a)) for (p, _), a in zip(kept, w, strict=True) if a], b


def compiled(rules: list[tuple[Rule, float]], intercept: float) -> Column:
    """The score as a column expression over the statistics."""
    logit = F.lit(intercept)
    for rule, weight in rules:
        all_of = F.lit(True)
        for name, sign, value in rule:
            all_of = all_of & ((F.col(name) <= value) if sign == "<=" else (F.col(name) > value))
        logit = logit + F.when(all_of, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def learn(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", most_rows: int = 20_000, **options) -> Column:
    """The score, as a column over the statistics, learned from labelled rows of ``stats`` that are not held out.

    At most ``most_rows`` rows are used, those with the smallest hash of the id: a bound on the driver's memory. Their
    number is counted first, so that tasks hand on little more than these. A row of ``labels`` with a null id or label is
    ignored; of repeated ids all labels count.
    """
    names = list(ratios())
    truth = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("_label")).dropna()
    known = stats.filter(~F.col("held_out")).join(truth, "doc_id")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    share = 1.1 * most_rows / max(known.count(), 1) + 0.001
    near = known.filter(place < int(share * (1 << 31))) if share < 1 else known
    rows = near.orderBy(place, "doc_id").limit(most_rows).select("_label", *names).toPandas()
    return compiled(*fit(rows[names].to_numpy(float), (rows["_label"].to_numpy(float) > 0).astype(float), names, **options))


def _stats(counts: DataFrame, *keep: str) -> DataFrame:
    return counts.select("doc_id", *keep, held_out(F.col("doc_id")).alias("held_out"), *[c.alias(k) for k, c in ratios().items()])


def classify(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``df``.

    Rules are learned from labelled rows that are not held out (see :func:`learn`); all rows are scored. Without labels
    every score is 0.5. Null text is empty and scored. A null id is held out. Repeated rows are rows of their own. An
    empty table gives an empty result. Other columns, labels among them, are never inputs of a score.
    """
    stats = stage(_stats(with_stats(documents(df, id_col, text_col))))
    scored = stats.select("doc_id", "held_out", learn(stats, labels, id_col=id_col, **options).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_predicted(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``df`` that :func:`classify` predicts as 1, all columns as they were."""
    stats = stage(_stats(with_stats(keyed(df, id_col, text_col), "th"), "th"))
    score = learn(stats, labels, id_col=id_col, **options)
    return only(df, stats.filter(score >= threshold), id_col, text_col)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
