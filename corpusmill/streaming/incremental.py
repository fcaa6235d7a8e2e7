"""A stream of documents through the row filters, each text once.

State is one key per distinct text within the watermark; files that arrive later than it are filtered but no longer
compared with what came before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.operators import dedup
from corpusmill.operators import filters as R


def read(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def kept_once(docs: DataFrame, rules: R.RowFilters, arrived: str, late: str = "1 hour") -> DataFrame:
    """Kept rows, the first of each text within the watermark on the column ``arrived``."""
    rows = R.kept(docs, rules, ["text"]).withColumn("text_key", dedup.exact_key(F.col("text")))
    return rows.withWatermark(arrived, late).dropDuplicatesWithinWatermark(["text_key"])


def run_available(docs: DataFrame, out: str, checkpoint: str) -> None:
    """Everything that is there now, then stop; started again it goes on where it ended."""
    docs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
