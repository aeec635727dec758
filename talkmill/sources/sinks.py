"""Partition writes that are checked before they show, and small files written atomically."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkmill.schemas import SchemaDrift, out_of_set


class RoundTripError(RuntimeError):
    """A written partition doesn't hold the rows that went into it."""


@dataclass(frozen=True)
class Written:
    path: str
    rows: int
    metrics: dict


def filesystem(spark: SparkSession, path: str):
    """(file system, Path class) of a path of any scheme."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p(path))


def _safe(name: str) -> str:
    if not name or any(c in name for c in "/\\=\0") or name.startswith("."):
        raise ValueError(f"not a partition name: {name!r}")
    return name


def partition_path(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/batch_id={_safe(batch_id)}"


def _aside(batch_id: str) -> str:
    return f".replaced-{_safe(batch_id)}"


def restore(spark: SparkSession, root: str, batch_id: str) -> bool:
    """Ends a replacement that a crash cut short: the old partition comes back if there's no new one, else it goes. True if it came back."""
    fs, path = filesystem(spark, root)
    target, aside = path(partition_path(root, batch_id)), path(f"{root.rstrip('/')}/{_aside(batch_id)}")
    if not fs.exists(aside):
        return False
    if fs.exists(target):
        fs.delete(aside, True)
        return False
    if not fs.rename(aside, target):
        raise RoundTripError(f"{target} couldn't be brought back")
    return True


def write_partition(df: DataFrame, root: str, batch_id: str, closed: dict | None = None, metrics: list[Column] | None = None) -> Written:
    """Writes `df` beside the table, checks closed sets and row count, and only then puts it in place of the batch's partition.

    The metrics ride on the write itself, so no pruning can remove them. A failed check leaves what was there. The old
    partition is moved aside before the new one is moved in and deleted last, so a crash at any point loses nothing:
    `restore` brings it back.
    """
    spark = df.sparkSession
    restore(spark, root, batch_id)
    target, staging = partition_path(root, batch_id), f"{root.rstrip('/')}/.staging-{uuid.uuid4().hex}"
    aside = f"{root.rstrip('/')}/{_aside(batch_id)}"
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(out_of_set(closed) if closed else []), *(metrics or []))
    fs, path = filesystem(spark, root)
    try:
        observed.drop("batch_id").write.option("compression", "zstd").parquet(staging)
        got = seen.get
        if drifted := {k: v for k, v in got.items() if k.startswith("drift_") and v}:
            raise SchemaDrift(f"values outside their closed set: {drifted}")
        stored = spark.read.parquet(staging).count()
        if stored != got["rows"]:
            raise RoundTripError(f"{target}: {stored} rows stored, {got['rows']} written")
        fs.mkdirs(path(root))
        had = fs.exists(path(target))
        if had and not fs.rename(path(target), path(aside)):
            raise RoundTripError(f"{target} couldn't be moved aside")
        if not fs.rename(path(staging), path(target)):
            restore(spark, root, batch_id)
            raise RoundTripError(f"{target} couldn't be put in place")
        if had:
            fs.delete(path(aside), True)
    finally:
        fs.delete(path(staging), True)
    return Written(target, got["rows"], {k: v for k, v in got.items() if k != "rows"})


def write_rejected(df: DataFrame, root: str, batch_id: str) -> Written | None:
    """Rejected rows under a root of their own; nothing is written without any."""
    if df.isEmpty():
        return None
    return write_partition(df, root, batch_id)


def rejected_count(spark: SparkSession, root: str, batch_id: str) -> int:
    at = partition_path(root, batch_id)
    return spark.read.parquet(at).count() if exists(spark, at) else 0


def read_partition(spark: SparkSession, root: str, batch_id: str) -> DataFrame:
    """One batch by partition pruning."""
    return spark.read.parquet(root).where(F.col("batch_id") == batch_id)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """The whole document or none: a temporary file is renamed over the old one."""

    def plain(x):
        if isinstance(x, datetime):
            return x.isoformat()
        raise TypeError(type(x).__name__)

    text = json.dumps(value, default=plain, ensure_ascii=False, sort_keys=True, indent=1)
    fs, p = filesystem(spark, path)
    new = p(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
        out.hsync()
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, p(path), options)


def append_jsonl(path: str, record: dict) -> None:
    """One line, flushed; on the driver's disk."""
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(record, ensure_ascii=False, sort_keys=True, default=str) + "\n")
        f.flush()
