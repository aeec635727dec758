"""The three layers of one batch: what each reads, writes and records."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkmill import schemas
from talkmill.control import overrides
from talkmill.control.client import Calls
from talkmill.control.state import Manifest
from talkmill.functions import masking
from talkmill.operators import bronze, gold, model_lane, silver
from talkmill.sources import sinks
from talkmill.sources.batches import Batch
from talkmill.sources.tables import scan


@dataclass
class Settings:
    """Places, secrets and callers of an installation. Paths mustn't climb out of their root.

    `source` and `root` may be on any file system. `control` is a folder on the driver's disk for the manifest, the lock
    and the logs; it's `root` unless given, so it must be given where `root` isn't on a local disk.
    """

    source: str
    root: str
    secret: str = field(default_factory=lambda: os.environ.get("TALKMILL_LEAD_SECRET", ""), repr=False)
    retries: int = 3
    interval_s: float = 60.0
    stale_s: int = 3600
    control: str = ""
    #: Model calls that fill Silver's entity columns; none: they stay null.
    model: Calls | None = field(default=None, repr=False)
    #: Proposes a pattern from a broken one and the samples it misses; none: broken patterns are escalated.
    propose: Callable[[str, list[str]], str] | None = field(default=None, repr=False)
    #: Names the kind of a failure that the rules don't know, at most `diagnoses` times a pass.
    ask_kind: Callable[[str, str], str] | None = field(default=None, repr=False)
    diagnoses: int = 10
    #: Share of a batch's rows that may be rejected before somebody has to acknowledge it.
    most_rejected: float = 1.0

    def __post_init__(self):
        self.control = self.control or self.root
        if "://" in self.control:
            raise ValueError("control: a folder on the driver's disk")
        if any(".." in p.split("/") for p in (self.root, self.source, self.control)):
            raise ValueError("paths mustn't contain '..'")
        if not 1 <= self.retries <= 10:
            raise ValueError("retries: 1 to 10")

    @property
    def overrides(self) -> str:
        return f"{self.control}/overrides.json"

    @property
    def events(self) -> str:
        return f"{self.control}/events.jsonl"

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


GOLD = {"conversation_scores": gold.conversation_scores, "lead_profile": gold.lead_profile, "agent_performance": gold.agent_performance, "competitor_intel": gold.competitor_intel}


def outputs(settings: Settings, batch_id: str, layer: str) -> list[str]:
    """What must be there for a layer to count as done."""
    if layer != "gold":
        return [sinks.partition_path(settings.table(layer), batch_id)]
    return [*[sinks.partition_path(settings.table(f"gold/{t}"), batch_id) for t in GOLD], f"{settings.table('gold/insights')}/batch_id={batch_id}/summary.json"]


def run_bronze(spark: SparkSession, settings: Settings, manifest: Manifest, batch: Batch) -> dict:
    raw = scan(spark, batch.path, schemas.SOURCE_COLUMNS)
    at = datetime.now(timezone.utc)
    typed = schemas.assert_schema(bronze.bronze_typed(raw, batch.batch_id, batch.source_hash, at), schemas.BRONZE, "bronze")
    try:
        done = sinks.write_partition(typed, settings.table("bronze"), batch.batch_id, schemas.CLOSED)
    except PySparkException as e:
        if any(c in str(e) for c in ("CANNOT_PARSE_TIMESTAMP", "CAST_INVALID_INPUT")):
            raise schemas.SchemaDrift(str(e)[:300]) from e
        raise
    return {"rows_in": done.rows, "rows_out": done.rows}


def run_silver(spark: SparkSession, settings: Settings, manifest: Manifest, batch: Batch) -> dict:
    rows = schemas.assert_schema(spark.read.parquet(sinks.partition_path(settings.table("bronze"), batch.batch_id)).withColumn("batch_id", F.lit(batch.batch_id)).select(*schemas.BRONZE.fieldNames()), schemas.BRONZE, "bronze")
    at = datetime.now(timezone.utc)
    own = overrides.load(settings.overrides).get(batch.batch_id, {})
    seen = Observation()
    masked = [F.coalesce(F.sum(c), F.lit(0)).alias(f"masked_{k}") for k, c in masking.mask_counts(F.col("message_body")).items()]
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(silver.reject_reason().isNotNull()).alias("rows_rejected"), *masked)
    valid, rejected = silver.partition_rows(counted, at)[0], silver.partition_rows(rows, at)[1]
    patterns = {k: v for k, v in own.items() if k in masking.REPLACEABLE}
    out = schemas.assert_schema(silver.silver_transform(valid, settings.secret, at, patterns=patterns), schemas.SILVER, "silver")
    if settings.model:
        out = _with_entities(spark, settings, out)
    done = sinks.write_partition(out, settings.table("silver"), batch.batch_id, {k: v for k, v in schemas.CLOSED.items() if k in out.columns})
    sinks.write_rejected(rejected, settings.table("silver_rejected"), batch.batch_id)
    counts = seen.get | {"rows_out": done.rows}
    counts["rows_deduped"] = counts["rows_in"] - counts["rows_rejected"] - counts["rows_out"]
    if counts["rows_deduped"] < 0:
        raise sinks.RoundTripError(f"silver of {batch.batch_id} has more rows than it was given: {counts}")
    if counts["rows_rejected"] > settings.most_rejected * counts["rows_in"] and "acknowledged" not in own:
        raise schemas.OutOfRange(f"{counts['rows_rejected']} of {counts['rows_in']} rows rejected")
    return counts


def _with_entities(spark: SparkSession, settings: Settings, rows: DataFrame) -> DataFrame:
    """Silver rows with the entity columns filled; new answers are appended to the reply table, so no text is asked for twice."""
    calls, at = settings.model, settings.table("model_replies")
    schema = "key string, reply string"
    cache = spark.read.schema(schema).parquet(at) if sinks.exists(spark, at) else spark.createDataFrame([], schema)
    key = lambda c: model_lane.cache_key(calls.model, calls.system, c, calls.max_tokens, calls.temperature)
    filled, fresh = model_lane.fill_entities(rows, calls, cache, key, calls.budget, calls.concurrency)
    fresh.write.mode("append").parquet(at)
    return filled


def insights(table: DataFrame, batch_id: str) -> dict:
    """The insights document: four small results. Label and outcome are crossed for the plate's form, a label that needs no model."""
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731 - a bounded number of buckets, phrases and cells
    labels = table.where("lead_id IS NOT NULL").groupBy("lead_id").agg(F.mode("plate_format", True).alias("label"))
    matrix = gold.label_outcomes(table, labels, "label")
    return {
        "batch_id": batch_id,
        "generated_at": gold.anchor(table).first()["anchor"],
        "ghosting_taxonomy": rows(gold.ghosting(table)),
        "objections": rows(gold.objections(table)),
        "disengagement_moment": rows(gold.disengagement(table)),
        "label_outcome": rows(matrix.orderBy("label", "outcome")),
        "top_surprise": rows(gold.top_surprise(matrix)),
    }


def run_gold(spark: SparkSession, settings: Settings, manifest: Manifest, batch: Batch) -> dict:
    table = spark.read.parquet(sinks.partition_path(settings.table("silver"), batch.batch_id)).persist()
    try:
        out = 0
        for name, build in GOLD.items():
            out += sinks.write_partition(build(table), settings.table(f"gold/{name}"), batch.batch_id).rows
        sinks.write_json(spark, outputs(settings, batch.batch_id, "gold")[-1], insights(table, batch.batch_id))
        return {"rows_in": table.count(), "rows_out": out}
    finally:
        table.unpersist()


RUNNERS = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}


def run_layer(spark: SparkSession, settings: Settings, manifest: Manifest, batch: Batch, layer: str) -> dict:
    """Runs a layer and records it; an earlier completed run of the same layer is superseded."""
    for path in outputs(settings, batch.batch_id, layer):
        if path.endswith(f"batch_id={batch.batch_id}"):
            sinks.restore(spark, path.rsplit("/", 1)[0], batch.batch_id)
    if manifest.batch(batch.batch_id) is None or manifest.batch(batch.batch_id)["status"] == "FAILED":
        manifest.open_batch(batch)
    run = manifest.open_run(batch.batch_id, layer)
    try:
        rows = RUNNERS[layer](spark, settings, manifest, batch)
    except BaseException as e:
        manifest.end_run(run, error=f"{type(e).__name__}: {e}")
        raise
    manifest.end_run(run, output_path=outputs(settings, batch.batch_id, layer)[0], **rows)
    return rows
