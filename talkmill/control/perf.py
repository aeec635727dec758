"""Timed scenarios of the loop: each runs in a fresh installation, appends its timing and fails loudly."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.control import events, layers, loop
from talkmill.control.layers import Settings
from talkmill.control.state import Manifest
from talkmill.sources import sinks
from talkmill.sources.batches import discover

#: Longest mean time of a scenario in milliseconds.
LIMITS = {"noop": 1_000.0, "cold_start": 30_000.0, "warm": 900_000.0, "fault": 300_000.0, "concurrent_batch": 1_800_000.0}
SCENARIOS: dict[str, Callable[[SparkSession, Settings, str], None]] = {}


def scenario(run):
    SCENARIOS[run.__name__] = run
    return run


def _pass(spark: SparkSession, settings: Settings, least: int) -> None:
    manifest = Manifest(f"{settings.control}/manifest.db")
    try:
        done = loop.run_once(spark, settings, manifest)
    finally:
        manifest.close()
    if done.failures or done.layers < least:
        raise RuntimeError(f"a pass failed: {done}")


@scenario
def cold_start(spark, settings, log):
    """A first pass with empty tables."""
    with events.timed(log, "cold_start"):
        _pass(spark, settings, 3)


@scenario
def noop(spark, settings, log):
    """A pass with nothing to do."""
    _pass(spark, settings, 0)
    with events.timed(log, "noop"):
        _pass(spark, settings, 0)


@scenario
def warm(spark, settings, log):
    """All layers of all batches anew, with hashes and answers known."""
    _pass(spark, settings, 0)
    manifest = Manifest(f"{settings.control}/manifest.db")
    for batch in discover(settings.source, spark, manifest):
        manifest.invalidate(batch.batch_id, "bronze", "timed anew")
    manifest.close()
    with events.timed(log, "warm"):
        _pass(spark, settings, 3)


@scenario
def fault(spark, settings, log):
    """A lost Silver partition is noticed and made again."""
    _pass(spark, settings, 0)
    fs, path = sinks.filesystem(spark, settings.root)
    for batch in discover(settings.source, spark):
        fs.delete(path(sinks.partition_path(settings.table("silver"), batch.batch_id)), True)
    with events.timed(log, "fault"):
        _pass(spark, settings, 2)


@scenario
def concurrent_batch(spark, settings, log):
    """All batches of the source in one pass, in an installation of its own."""
    own = replace(settings, root=f"{settings.root}/concurrent", control=f"{settings.control}/concurrent")
    sinks.filesystem(spark, own.root)[0].mkdirs(sinks.filesystem(spark, own.root)[1](own.root))
    with events.timed(log, "concurrent_batch"):
        _pass(spark, own, 3)


@scenario
def overhead(spark, settings, log):
    """The layers called directly and by the loop: two records whose ratio is the loop's cost."""
    for name in ("overhead_direct", "overhead_loop"):
        own = replace(settings, root=f"{settings.root}/{name}", control=f"{settings.control}/{name}")
        sinks.filesystem(spark, own.root)[0].mkdirs(sinks.filesystem(spark, own.root)[1](own.root))
        with events.timed(log, name):
            if name == "overhead_loop":
                _pass(spark, own, 3)
                continue
            manifest = Manifest(f"{own.control}/manifest.db")
            for batch in discover(own.source, spark, manifest):
                for layer in layers.RUNNERS:
                    layers.run_layer(spark, own, manifest, batch, layer)
            manifest.close()


def run(spark: SparkSession, settings: Settings, log: str, names: list[str] | None = None) -> DataFrame:
    """Runs the named scenarios (all unless given) and returns their statistics; `log` has a line per timing."""
    for name in names or list(SCENARIOS):
        SCENARIOS[name](spark, settings, log)
    return events.summary(spark.read.json(log).where(F.col("ok")))
