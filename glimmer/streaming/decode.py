"""Decoding of spots that arrive as a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.operators import decode

SPOT = "fov long, spot_id long, v array<array<double>>"


def read_spots(spark: SparkSession, folder: str, schema: str = SPOT, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def decoded_stream(spots: DataFrame, codebook: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Spots of the stream with barcode, quality, intensity and gene. Calls are per spot and the codebook is a static table,
    so there is no state and each batch runs the plan of the batch job."""
    called = decode.quality_filtered(decode.called(spots), threshold)
    return decode.mapped(called, codebook).select("fov", "spot_id", "barcode", "quality", "intensity", "gene")


def write_decoded(decoded: DataFrame, path: str, checkpoint: str):
    """Append to Parquet by FOV, exactly once: offsets and commits are in ``checkpoint``."""
    return decoded.writeStream.format("parquet").partitionBy("fov").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def running_counts(decoded: DataFrame) -> DataFrame:
    """Genes counted over all batches; the state has one row for each gene."""
    return decoded.filter(F.col("gene") != decode.BACKGROUND).groupBy("gene").agg(F.count("*").alias("n"))
