"""Event lines of the loop, without secrets, and timings with their statistics."""

from __future__ import annotations

import logging
import re
import resource
import time
from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.sources.sinks import append_jsonl

NAMES = frozenset("loop_started loop_finished layer_started layer_completed failure_detected fix_applied fix_failed escalated nothing_pending".split())
_SECRET_KEY = re.compile(r"(?:^|_)(?:key|token|secret|password|credential|authorization)s?$", re.I)
_SECRET_VALUE = re.compile(r"\bsk-[A-Za-z0-9_\-]{8,}|\bBearer\s+\S+")


def redacted(value, key: str = ""):
    """The value with secrets replaced, by the name of their key or by their looks, at any depth."""
    if _SECRET_KEY.search(key):
        return "***"
    if isinstance(value, dict):
        return {k: redacted(v, str(k)) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [redacted(v) for v in value]
    return _SECRET_VALUE.sub("***", value) if isinstance(value, str) else value


def emit(path: str | None, name: str, **fields) -> dict:
    """One known event, logged and, with a path, appended as a JSON line."""
    if name not in NAMES:
        raise ValueError(f"unknown event {name!r}")
    record = {"event": name, "at": datetime.now(timezone.utc).isoformat(timespec="seconds")} | redacted(fields)
    logging.getLogger("talkmill.events").info("%s", record)
    if path:
        append_jsonl(path, record)
    return record


@contextmanager
def timed(path: str, scenario: str, rows: int | None = None):
    """Appends a timing of the block, with the driver's peak memory; also when the block fails."""
    began, ok = time.perf_counter(), False
    try:
        yield
        ok = True
    finally:
        s = time.perf_counter() - began
        append_jsonl(path, {"scenario": scenario, "ms": round(s * 1000, 3), "ok": ok, "rows": rows, "rows_per_s": rows / s if rows and s else None, "peak_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024})


def summary(timings: DataFrame, by: str = "scenario", ms: str = "ms") -> DataFrame:
    """Count, min, max, mean, sample deviation and interpolated (inclusive) 50th and 95th percentiles per scenario."""
    return timings.groupBy(by).agg(F.count(ms).alias("n"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"), F.avg(ms).alias("mean_ms"), F.stddev(ms).alias("stddev_ms"), F.percentile(ms, F.lit(0.5)).alias("p50_ms"), F.percentile(ms, F.lit(0.95)).alias("p95_ms"))


def over_limit(stats: DataFrame, limits: dict[str, float]) -> list[str]:
    """Scenarios whose mean is over their limit; one row per scenario reaches the driver."""
    return sorted(r["scenario"] for r in stats.select("scenario", "mean_ms").collect() if r["mean_ms"] is not None and r["mean_ms"] > limits.get(r["scenario"], float("inf")))


Clock = Callable[[], float]
