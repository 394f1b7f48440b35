"""Shared pieces: staged tables, global order by key, and document columns."""

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share.

    Where the setting is absent, a local session (tests) uses a temporary folder of this machine and sets it; on a cluster,
    whose executors would not see that folder, it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/glimmer-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: this cuts the lineage, survives the loss
    of any executor, and lets later passes read single columns."""
    spark = df.sparkSession
    path = path or scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` of the input, null texts as empty; other columns are left out."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ordered(df: DataFrame, keys: list[str], path: str | None = None) -> DataFrame:
    """Stage ``df`` dealt out by ranges of ``keys`` and sorted within each, with the range's number as ``range_no``.

    ``repartitionByRange`` splits at sampled quantiles, so no range holds more than its share of rows unless
    rows tie in every key.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(k).asc_nulls_first() for k in keys]
    parted = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stage(parted.withColumn("range_no", F.spark_partition_id()), path)


def running_sum(staged: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """The sum of ``value`` over all rows before each row in the order of ``keys``.

    ``staged`` comes from :func:`ordered`. Every range is summed on its own; one row per range (as many as there
    are shuffle partitions, however many rows) gives the ranges' offsets.
    """
    totals = staged.groupBy("range_no").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("range_no", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    within = (
        Window.partitionBy("range_no")
        .orderBy(*[F.col(k).asc_nulls_first() for k in keys])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        staged.withColumn("_own", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(F.broadcast(offsets), "range_no")
        .withColumn(name, (F.col("_own") + F.col("_offset")).cast("long"))
        .drop("_own", "_offset")
    )
