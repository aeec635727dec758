"""Observe, plan, execute, diagnose, repair: one pass over the sources, or one after another."""

from __future__ import annotations

import logging
import os
import threading
import time
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from talkmill import schemas
from talkmill.control import events, layers, overrides
from talkmill.control.layers import Settings
from talkmill.control.state import DONE, FAILED, INTERRUPTED, LAYERS, OPEN, Manifest
from talkmill.functions import masking
from talkmill.sources import sinks
from talkmill.sources.batches import Batch, discover
from talkmill.sources.tables import MissingColumns, MissingSource

log = logging.getLogger("talkmill.loop")
KINDS = ("schema_drift", "regex_break", "partition_missing", "out_of_range", "corrupt_file", "unknown")
#: What somebody may try when a failure is escalated.
SUGGESTED = {
    "schema_drift": "compare the file's columns and values with the declared schema; correct the file or extend the schema",
    "regex_break": "put a pattern that finds the samples into the overrides and run the layer again",
    "partition_missing": "check that the batch's source file is still there and run the layers from bronze",
    "out_of_range": "look at the rejected rows of the batch and acknowledge them",
    "corrupt_file": "deliver the file again",
    "unknown": "read the error in the manifest's failures",
}
DRIFT = ("UNRESOLVED_COLUMN", "CAST_INVALID_INPUT", "CANNOT_PARSE_TIMESTAMP", "USER_RAISED_EXCEPTION", "FIELD_NOT_FOUND")


class Lock:
    """One loop per installation: a file with the owner's process id. It's stale if the owner is dead or the file is old."""

    def __init__(self, path: str, stale_s: int = 3600):
        self.path, self.stale_s, self.depth = Path(path), stale_s, 0

    def _alive(self) -> bool:
        try:
            pid = int(self.path.read_text() or 0)
            os.kill(pid, 0)
        except (ValueError, ProcessLookupError, FileNotFoundError):
            return False
        except PermissionError:
            pass
        return time.time() - self.path.stat().st_mtime < self.stale_s

    def __enter__(self):
        if self.depth == 0:
            self.path.parent.mkdir(parents=True, exist_ok=True)
            for _ in range(2):
                try:
                    with open(self.path, "x") as f:
                        f.write(str(os.getpid()))
                    break
                except FileExistsError:
                    if self._alive():
                        raise RuntimeError(f"{self.path} is held by process {self.path.read_text()}") from None
                    self.path.unlink(missing_ok=True)
        self.depth += 1
        return self

    def __exit__(self, *_):
        self.depth -= 1
        if self.depth == 0 and self.path.exists() and self.path.read_text() == str(os.getpid()):
            self.path.unlink()


def missing_outputs(spark: SparkSession, settings: Settings, batch_id: str, layer: str) -> list[str]:
    """What a layer lacks, after replacements that a crash cut short have been ended."""
    for p in layers.outputs(settings, batch_id, layer):
        if p.endswith(f"batch_id={batch_id}") and not sinks.exists(spark, p):
            sinks.restore(spark, p.rsplit("/", 1)[0], batch_id)
    return [p for p in layers.outputs(settings, batch_id, layer) if not sinks.exists(spark, p)]


def observe(spark: SparkSession, settings: Settings, manifest: Manifest) -> list[Batch]:
    """Batches with work left: unknown, failed, open for too long, or lacking a file. Launches no Spark job and reads only files that are new."""
    out = []
    for batch in discover(settings.source, spark, manifest):
        row = manifest.batch(batch.batch_id)
        if row and row["status"] == OPEN:
            try:
                age = (datetime.now(timezone.utc) - datetime.fromisoformat(row["started_at"])).total_seconds()
            except ValueError:
                age = settings.stale_s + 1
            if age <= settings.stale_s:
                continue
        if row is None or row["status"] != DONE or plan(spark, settings, manifest, batch):
            out.append(batch)
    return out


def plan(spark: SparkSession, settings: Settings, manifest: Manifest, batch: Batch) -> list[str]:
    """Layers to run, in order: from the first one that isn't completed or lacks a file. A completed run whose files are gone is marked failed."""
    todo: list[str] = []
    for layer in LAYERS:
        lacking = missing_outputs(spark, settings, batch.batch_id, layer) if manifest.completed(batch.batch_id, layer) else ["not run"]
        if lacking and lacking != ["not run"]:
            manifest.invalidate(batch.batch_id, layer, f"missing {lacking[0]}")
        if lacking or todo:
            todo.append(layer)
    return todo


def diagnose(error: BaseException) -> str:
    """The kind of a failure by its type or Spark error condition."""
    if isinstance(error, (schemas.SchemaDrift, MissingColumns)):
        return "schema_drift"
    if isinstance(error, overrides.PatternBroken):
        return "regex_break"
    if isinstance(error, schemas.OutOfRange):
        return "out_of_range"
    if isinstance(error, MissingSource):
        return "partition_missing"
    text = str(error)
    condition = (error.getCondition() or "") if isinstance(error, PySparkException) else ""
    if "INVALID_PARAMETER_VALUE.PATTERN" in condition or "PatternSyntaxException" in text:
        return "regex_break"
    if any(c in condition or c in text for c in DRIFT):
        return "schema_drift"
    if "PATH_NOT_FOUND" in condition or "PATH_NOT_FOUND" in text or "UNABLE_TO_INFER_SCHEMA" in text:
        return "partition_missing"
    if "FAILED_READ_FILE" in text or "is not a Parquet file" in text or "CANNOT_READ_FILE_FOOTER" in text:
        return "corrupt_file"
    return "unknown"


class Diagnosis:
    """Rules first; what they don't know is asked of the installation's `ask_kind`, at most `diagnoses` times a pass."""

    def __init__(self, settings: Settings):
        self.ask, self.left = settings.ask_kind, settings.diagnoses

    def __call__(self, error: BaseException, layer: str) -> str:
        kind = diagnose(error)
        if kind != "unknown" or self.ask is None or self.left <= 0:
            return kind
        self.left -= 1
        try:
            reply = self.ask(layer, events.redacted(f"{type(error).__name__}: {error}")[:2000])
        except Exception:  # noqa: BLE001 - a failed question leaves the kind unknown
            return "unknown"
        reply = reply.strip() if isinstance(reply, str) else ""
        return reply if reply in KINDS else "unknown"


def repair(spark: SparkSession, settings: Settings, manifest: Manifest, batch: Batch, layer: str, kind: str, error: BaseException | None = None) -> str | None:
    """What was repaired, or None if this kind can't be: drift by bringing the stored input into shape, a missing partition
    by making it anew, a broken pattern by a proposed one that passes its checks, rejected rows by acknowledging them."""
    if kind == "regex_break" and settings.propose and isinstance(error, overrides.PatternBroken) and error.name in masking.REPLACEABLE:
        built_in = masking.REPLACEABLE[error.name]
        old = overrides.pattern(settings.overrides, batch.batch_id, error.name, built_in)
        return f"new pattern {error.name}: {overrides.regenerate(spark, settings.overrides, batch.batch_id, error.name, old, [], error.failing, settings.propose)}"[:512]
    if kind == "out_of_range":
        n = sinks.rejected_count(spark, settings.table("silver_rejected"), batch.batch_id)
        if not n:
            raise ValueError("no rejected rows to acknowledge")
        overrides.save(settings.overrides, batch.batch_id, "acknowledged", str(n))
        return f"acknowledged {n} rejected rows"
    if kind == "schema_drift" and layer != "bronze":
        name, declared = ("bronze", schemas.BRONZE) if layer == "silver" else ("silver", schemas.SILVER)
        at = sinks.partition_path(settings.table(name), batch.batch_id)
        if not sinks.exists(spark, at):
            return None
        stored = spark.read.parquet(at)
        found = schemas.differences(stored.schema, schemas.T.StructType([f for f in declared if f.name != "batch_id"]))
        inner = schemas.T.StructType([f for f in declared if f.name != "batch_id"])
        sinks.write_partition(schemas.conform(stored, inner), settings.table(name), batch.batch_id)
        return f"conformed {name}: {'; '.join(found)}"[:512]
    if kind == "partition_missing" and layer != "bronze":
        before = LAYERS[LAYERS.index(layer) - 1]
        for name in LAYERS[: LAYERS.index(layer)]:
            if missing_outputs(spark, settings, batch.batch_id, name):
                layers.run_layer(spark, settings, manifest, batch, name)
        return f"made {before} anew"
    return None


@dataclass
class Pass:
    batches: int = 0
    layers: int = 0
    failures: int = 0
    escalated: list[tuple[str, str, str]] | None = None


def execute(spark: SparkSession, settings: Settings, manifest: Manifest, loop_id: int, batch: Batch, layer: str, diagnosis: Diagnosis | None = None) -> tuple[bool, str]:
    """Runs a layer, repairing and retrying within the budget of its kind of failure; (done, last kind)."""
    diagnosis, about = diagnosis or Diagnosis(settings), {"batch_id": batch.batch_id, "layer": layer}
    while True:
        events.emit(settings.events, "layer_started", **about)
        try:
            rows = layers.run_layer(spark, settings, manifest, batch, layer)
            events.emit(settings.events, "layer_completed", **about, **rows)
            return True, ""
        except Exception as e:  # noqa: BLE001 - every failure is recorded and either repaired or escalated
            kind = diagnosis(e, layer)
            events.emit(settings.events, "failure_detected", **about, kind=kind, error=f"{type(e).__name__}: {e}"[:512])
            failure = manifest.record_failure(loop_id, batch.batch_id, layer, kind, f"{type(e).__name__}: {e}")
            log.warning("%s of %s failed: %s", layer, batch.batch_id, kind)
            if kind in ("unknown", "corrupt_file") or manifest.attempts(batch.batch_id, layer, kind) >= settings.retries:
                manifest.stamp(failure, escalated=True)
                return False, kind
            try:
                fix = repair(spark, settings, manifest, batch, layer, kind, e)
            except Exception as again:  # noqa: BLE001 - a failed repair costs an attempt
                fix = f"repair failed: {again}"[:512]
                events.emit(settings.events, "fix_failed", **about, kind=kind, error=fix)
            else:
                if fix:
                    events.emit(settings.events, "fix_applied", **about, kind=kind, fix=fix)
            if fix is None:
                manifest.stamp(failure, escalated=True)
                return False, kind
            manifest.stamp(failure, fix=fix)


def escalate(settings: Settings, manifest: Manifest, batch: Batch, layer: str, kind: str) -> None:
    """Hands a failure to somebody: a line in the escalations, an event, and the batch and its latest run marked failed."""
    run = manifest.latest_run(batch.batch_id, layer) or {}
    payload = {"batch_id": batch.batch_id, "source": batch.path, "layer": layer, "kind": kind, "error": run.get("error"), "suggested": SUGGESTED[kind], "at": datetime.now(timezone.utc)}
    sinks.append_jsonl(f"{settings.control}/escalations.jsonl", events.redacted(payload))
    events.emit(settings.events, "escalated", batch_id=batch.batch_id, layer=layer, kind=kind, suggested=SUGGESTED[kind])
    log.warning("%s of %s escalated: %s", layer, batch.batch_id, kind)
    manifest.invalidate(batch.batch_id, layer, run.get("error") or kind)
    manifest.end_batch(batch.batch_id, error=f"{layer}: {kind}")


def run_once(spark: SparkSession, settings: Settings, manifest: Manifest) -> Pass:
    """One pass: batches don't disturb each other, and the pass is sealed whatever happens."""
    with Lock(f"{settings.control}/.loop.lock", settings.stale_s):
        loop_id, result, status = manifest.open_loop(), Pass(escalated=[]), FAILED
        events.emit(settings.events, "loop_started", loop_id=loop_id)
        diagnosis = Diagnosis(settings)
        try:
            found = observe(spark, settings, manifest)
            if not found:
                events.emit(settings.events, "nothing_pending", loop_id=loop_id)
            for batch in found:
                result.batches += 1
                for layer in plan(spark, settings, manifest, batch):
                    done, kind = execute(spark, settings, manifest, loop_id, batch, layer, diagnosis)
                    result.layers += done
                    if not done:
                        result.failures += 1
                        result.escalated.append((batch.batch_id, layer, kind))
                        escalate(settings, manifest, batch, layer, kind)
                        break
                else:
                    manifest.end_batch(batch.batch_id)
            status = DONE
        except KeyboardInterrupt:
            status = INTERRUPTED
            raise
        finally:
            manifest.end_loop(loop_id, result.batches, result.failures, status)
            events.emit(settings.events, "loop_finished", loop_id=loop_id, status=status, batches=result.batches, failures=result.failures)
    return result


def run_forever(spark: SparkSession, settings: Settings, manifest: Manifest, stop: threading.Event, passes: int | None = None) -> int:
    n = 0
    while not stop.is_set() and (passes is None or n < passes):
        run_once(spark, settings, manifest)
        n += 1
        stop.wait(settings.interval_s if passes is None or n < passes else 0)
    return n


__all__ = ["DONE", "FAILED", "KINDS", "Lock", "Pass", "Diagnosis", "diagnose", "escalate", "execute", "observe", "plan", "repair", "run_forever", "run_once"]
