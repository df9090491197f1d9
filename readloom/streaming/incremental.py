"""Files of alignments as they arrive: the measurements of a read depend on that read alone, so they stream as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.reads import QualityLimits, measure
from ..sources.tables import parse_sam


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return parse_sam(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)).drop("value")


def measure_stream(spark: SparkSession, folder: str, limits: QualityLimits | None = None) -> DataFrame:
    return measure(read_stream(spark, folder), limits or QualityLimits())


def write_split(measured: DataFrame, path: str, checkpoint: str):
    """Good and bad reads to Parquet, each file once; ends when what is there has been read."""
    return measured.writeStream.format("parquet").partitionBy("good").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
