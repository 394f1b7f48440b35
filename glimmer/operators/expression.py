"""Gene counts and their comparison with reference expression."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glimmer.operators.decode import BACKGROUND


def without_background(spots: DataFrame) -> DataFrame:
    return spots.filter(F.col("gene") != BACKGROUND)


def cleaned(gene: Column) -> Column:
    """The gene without a trailing ``_ntRNA`` or ``_rbRNA``."""
    return F.regexp_replace(gene, "_(nt|rb)RNA$", "")


def gene_counts(spots: DataFrame) -> DataFrame:
    """``gene, count`` by cleaned name, without background."""
    return without_background(spots).groupBy(cleaned(F.col("gene")).alias("gene")).agg(F.count("*").alias("count"))


def matrix(spots: DataFrame, by: str = "fov") -> DataFrame:
    """``by, gene, n`` with subtotals (null gene) and the total (both null)."""
    return without_background(spots).rollup(by, "gene").agg(F.count("*").alias("n"))


def nth_spot(spots: DataFrame, gene: str, n: int, order: list[str]) -> DataFrame:
    """The ``n``-th (from 1) spot of a gene, whatever its case; empty beyond the last. Needs no global sort: the first
    ``n`` come from a top-n of each task."""
    hits = spots.filter(F.upper("gene") == gene.upper()).orderBy(*order).limit(n)
    return hits.withColumn("_k", F.row_number().over(Window.orderBy(*order))).filter(F.col("_k") == n).drop("_k")


def reference(rows: DataFrame) -> DataFrame:
    """``gene, value_ref``: repeated genes are summed. ``gene`` and ``value`` must be there."""
    if missing := {"gene", "value"} - set(rows.columns):
        raise ValueError(f"reference lacks {sorted(missing)}")
    return rows.groupBy("gene").agg(F.sum("value").alias("value_ref"))


def joined(counts: DataFrame, ref: DataFrame, least: int = 5) -> DataFrame:
    """``gene, count, value_ref, log_count, log_ref`` of common genes; no rows if there are fewer than ``least``."""
    both = counts.join(ref, "gene").withColumns({"log_count": F.log1p("count"), "log_ref": F.log1p("value_ref")})
    enough = both.agg((F.count("*") >= least).alias("_enough")).filter("_enough")
    return both.join(F.broadcast(enough), F.lit(True)).drop("_enough")


def pearson(both: DataFrame) -> DataFrame:
    return both.agg(F.corr("count", "value_ref").alias("r"), F.corr("log_count", "log_ref").alias("r_log"), F.count("*").alias("n"))


def spearman(both: DataFrame) -> DataFrame:
    """Correlation of average ranks. Genes are a few ten thousand at most, so one window holds them."""
    rank = lambda c: F.rank().over(Window.orderBy(c)) + (F.count("*").over(Window.partitionBy(c)) - 1) / 2
    return both.select(rank("count").alias("a"), rank("value_ref").alias("b")).agg(F.corr("a", "b").alias("r"))


def top(both: DataFrame, n: int = 5) -> DataFrame:
    return both.orderBy(F.desc("count"), "gene").limit(n)
