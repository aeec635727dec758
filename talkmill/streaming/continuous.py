"""The layers as one stream: new raw files become Bronze, Silver and Gold partitions, each micro-batch a batch.

The file source remembers paths, not contents, so the batch id is derived from the micro-batch's own rows: the
same rows delivered again land in the same partition and replace it. Partition writes are idempotent, so a
micro-batch that is repeated after a crash changes nothing.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from talkmill import schemas
from talkmill.control.layers import GOLD, Settings
from talkmill.operators import bronze, silver
from talkmill.sources import sinks


def content_id(raw: DataFrame) -> str:
    """12 hex digits from the rows, whatever their order: a sum and a count of row hashes."""
    h = F.xxhash64(*[F.col(c) for c in schemas.SOURCE_COLUMNS]).cast("decimal(38,0)")
    n, total = raw.agg(F.count(F.lit(1)), F.sum(h)).first()
    return hashlib.sha256(f"{n}:{total}".encode()).hexdigest()[:12]


def process(raw: DataFrame, settings: Settings) -> str | None:
    """All layers of one micro-batch; None without rows."""
    raw = raw.persist()
    try:
        if raw.isEmpty():
            return None
        batch_id, at = content_id(raw), datetime.now(timezone.utc)
        typed = bronze.bronze_typed(raw, batch_id, batch_id, at)
        sinks.write_partition(typed, settings.table("bronze"), batch_id, schemas.CLOSED)
        stored = raw.sparkSession.read.parquet(sinks.partition_path(settings.table("bronze"), batch_id)).withColumn("batch_id", F.lit(batch_id)).select(*schemas.BRONZE.fieldNames())
        valid, rejected = silver.partition_rows(stored, at)
        sinks.write_partition(silver.silver_transform(valid, settings.secret, at), settings.table("silver"), batch_id, {k: v for k, v in schemas.CLOSED.items() if k in schemas.SILVER.fieldNames()})
        sinks.write_rejected(rejected, settings.table("silver_rejected"), batch_id)
        table = raw.sparkSession.read.parquet(sinks.partition_path(settings.table("silver"), batch_id))
        for name, build in GOLD.items():
            sinks.write_partition(build(table), settings.table(f"gold/{name}"), batch_id)
        return batch_id
    finally:
        raw.unpersist()


def start(spark: SparkSession, settings: Settings, once: bool = True) -> StreamingQuery:
    """Starts the stream over `settings.source`; `once` takes in what is there and stops."""
    source = spark.readStream.schema(schemas.SOURCE).option("maxFilesPerTrigger", 16).parquet(settings.source)
    writer = source.writeStream.foreachBatch(lambda df, _: process(df, settings)).option("checkpointLocation", f"{settings.root}/.stream")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{int(settings.interval_s)} seconds")
    return writer.start()
