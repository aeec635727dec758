"""Every query of the library's core by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from talkmill.operators import delivery, features
from talkmill.plans import gold_queries, silver_queries

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "p2_features": features.p2_features,
        "p2_cells": features.p2_cells,
        "p2_totals": features.p2_totals,
        "p4_found": delivery.p4_found,
        "p4_unique": delivery.p4_unique,
        **silver_queries.QUERIES,
        **gold_queries.QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {**features.SQL, **delivery.SQL, **silver_queries.SQL, **gold_queries.SQL}
