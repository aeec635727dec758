"""Raw string rows to the typed Bronze table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.schemas import BRONZE, SOURCE_COLUMNS


def bronze_typed(raw: DataFrame, batch_id: str, source_hash: str, ingested_at: datetime | Column) -> DataFrame:
    """One projection: the timestamp is parsed strictly, lineage is appended, unknown columns are dropped."""
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    cols = [F.to_timestamp_ntz(c, F.lit("yyyy-MM-dd HH:mm:ss")).alias(c) if c == "timestamp" else F.col(c).cast("string").alias(c) for c in SOURCE_COLUMNS]
    return raw.select(*cols, F.lit(batch_id).alias("batch_id"), at.cast("timestamp").alias("ingested_at"), F.lit(source_hash).alias("source_file_hash")).select(*BRONZE.fieldNames())


def unparsable_timestamps(raw: DataFrame) -> Column:
    """How many non-null timestamps can't be parsed, as a metric."""
    return F.count_if(F.col("timestamp").isNotNull() & F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd HH:mm:ss")).isNull()).alias("bad_timestamps")
