"""Parquet scans with column checks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class MissingSource(FileNotFoundError):
    """The path of a source doesn't exist."""


class MissingColumns(ValueError):
    """A source lacks columns that it must have."""


def scan(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """Lazy scan; `required` is checked against the footer's schema only, extra columns are tolerated."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition() or e):
            raise MissingSource(path) from e
        raise
    lacking = sorted(set(required) - set(df.columns))
    if lacking:
        raise MissingColumns(f"{path}: missing columns {', '.join(lacking)}")
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")
