"""Patterns that replace a built-in one for a batch: a small JSON file, and the repair that fills it.

An override is read on the driver before a plan is built, so the pattern is a literal of the plan. A proposed pattern is
kept only if it compiles in Spark's own engine, matches what the old one matched on a baseline, and matches the
samples on which the old one failed.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

LONGEST = 1000


class PatternBroken(ValueError):
    """A pattern no longer finds what it must, on the given samples."""

    def __init__(self, name: str, failing: list[str]):
        super().__init__(f"pattern {name} misses {len(failing)} samples")
        self.name, self.failing = name, failing


def load(path: str) -> dict[str, dict[str, str]]:
    """batch id -> name -> pattern; {} for a missing or unreadable file."""
    try:
        got = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return {}
    return {b: {n: p for n, p in v.items() if isinstance(p, str)} for b, v in got.items() if isinstance(v, dict)} if isinstance(got, dict) else {}


def pattern(path: str, batch_id: str, name: str, built_in: str) -> str:
    return load(path).get(batch_id, {}).get(name, built_in)


def save(path: str, batch_id: str, name: str, value: str) -> None:
    """Merged with what is there, written to a temporary file and renamed."""
    every = load(path)
    every.setdefault(batch_id, {})[name] = value
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    new = p.with_name(f".{p.name}.{uuid.uuid4().hex}")
    new.write_text(json.dumps(every, sort_keys=True, indent=1, ensure_ascii=False), encoding="utf-8")
    os.replace(new, p)


def compiles(spark: SparkSession, value: str) -> bool:
    """True in both engines; Spark's decides what a plan can run."""
    if not value or len(value) > LONGEST:
        return False
    try:
        re.compile(value)
        spark.range(1).select(F.lit("x").rlike(value)).collect()
    except (re.error, PySparkException):
        return False
    return True


def matches(spark: SparkSession, value: str, samples: list[str]) -> list[bool]:
    """Which of a bounded list of samples the pattern finds, by Spark's engine."""
    rows = spark.createDataFrame(list(enumerate(samples)), "i int, s string").select("i", F.col("s").rlike(value).alias("m")).collect()
    return [r["m"] for r in sorted(rows)]


def regenerate(spark: SparkSession, path: str, batch_id: str, name: str, old: str, baseline: list[str], failing: list[str], propose: Callable[[str, list[str]], str]) -> str:
    """Asks `propose` for a new pattern, checks it and keeps it; raises ValueError, leaving the file as it was, if it isn't good enough."""
    new = propose(old, failing)
    if not compiles(spark, new):
        raise ValueError("the proposed pattern doesn't compile")
    if baseline and matches(spark, new, baseline) != matches(spark, old, baseline):
        raise ValueError("the proposed pattern changes what the old one found")
    if failing and not all(matches(spark, new, failing)):
        raise ValueError("the proposed pattern misses samples")
    save(path, batch_id, name, new)
    return new
