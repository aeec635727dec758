"""A wide feature table per entity from long event rows, by dense numpy blocks.

Events are summed per (entity, type) in the JVM with partial aggregation before any shuffle, so an entity or a
type with a third of all rows sends one row per task. Entities are then hash-bucketed and each bucket's sorted
cells are scattered into dense blocks of at most BLOCK entities (bincount for counts and maximum.at for the
latest time), which are emitted as Arrow columns. Memory: one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entities in one dense block.
BLOCK = 2048
#: A wide table has two columns per type; more types than this raise an error, none is dropped. `entity_cells` gives the
#: same figures in long form for any number of types.
MAX_TYPES = 5000
NEVER = np.iinfo(np.int64).min


def event_types(events: DataFrame, kind: str, max_types: int = MAX_TYPES) -> list[str]:
    """The distinct non-null types in code point order; checked against `max_types` before they reach the driver."""
    found = [r[0] for r in events.select(kind).where(F.col(kind).isNotNull()).distinct().limit(max_types + 1).collect()]
    if len(found) > max_types:
        raise ValueError(f"{kind} has more than {max_types} values: too many columns for a wide table, take entity_cells")
    return sorted(found)


def _scatter(types: list[str], anchor: int | None):
    """mapInArrow over cells (entity, type, n, last) sorted by entity: yields one row per entity."""
    values = pa.array(types, pa.string())
    width = len(types)

    def block(t: pa.Table) -> pa.RecordBatch:
        entity = t.column("entity").combine_chunks().dictionary_encode()
        e = entity.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        many = len(entity.dictionary)
        n = t.column("n").to_numpy().astype(np.float64)
        last = pc.fill_null(t.column("last"), NEVER).to_numpy()
        which = pc.fill_null(pc.index_in(t.column("kind"), value_set=values), -1).to_numpy()
        typed = which >= 0
        cell = e[typed] * width + which[typed]
        counts = np.bincount(cell, weights=n[typed], minlength=many * width).astype(np.int64).reshape(many, width)
        latest = np.full(many * width, NEVER)
        np.maximum.at(latest, cell, last[typed])
        latest = latest.reshape(many, width)
        rows = np.bincount(e, weights=n, minlength=many).astype(np.int64)
        rows_last = np.full(many, NEVER)
        np.maximum.at(rows_last, e, last)

        def since(x: np.ndarray) -> pa.Array:
            never = x == NEVER
            return pa.array(np.where(never, 0, (anchor or 0) - np.where(never, 0, x)) // 1_000_000, pa.int64(), mask=never)

        cols = [entity.dictionary, pa.array(counts.sum(1)), since(latest.max(1) if width else np.full(many, NEVER)), pa.array(rows), since(rows_last)]
        for j in range(width):
            cols += [pa.array(np.ascontiguousarray(counts[:, j])), since(latest[:, j])]
        return pa.RecordBatch.from_arrays(cols, names=_names(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        entities = 0
        for batch in batches:
            held.append(batch)
            entities += batch.num_rows  # at least as many rows as entities
            if entities < BLOCK * 8:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            name = t.column("entity").combine_chunks()
            if len(name) < 2:
                continue
            starts = np.concatenate([[0], np.flatnonzero(pc.not_equal(name[1:], name[:-1]).to_numpy(zero_copy_only=False)) + 1])
            for a in range(0, len(starts) - 1, BLOCK):
                b = min(a + BLOCK, len(starts) - 1)
                yield block(t.slice(starts[a], starts[b] - starts[a]))
            held = t.slice(starts[-1]).to_batches()  # the last entity may go on
            entities = sum(x.num_rows for x in held)
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            name = t.column("entity").combine_chunks()
            if len(name):
                starts = np.concatenate([[0], np.flatnonzero(pc.not_equal(name[1:], name[:-1]).to_numpy(zero_copy_only=False)) + 1, [len(name)]])
                for a in range(0, len(starts) - 1, BLOCK):
                    b = min(a + BLOCK, len(starts) - 1)
                    yield block(t.slice(starts[a], starts[b] - starts[a]))

    return run


def _names(types: list[str]) -> list[str]:
    """Column names: totals carry a leading dot-free prefix that no type column has."""
    return ["entity", "total_n", "total_recency_s", "rows_n", "rows_recency_s", *[x for t in types for x in (f"{t}_n", f"{t}_recency_s")]]


def _latest(events: DataFrame, time: str) -> int | None:
    return events.agg(F.unix_micros(F.max(time).cast("timestamp"))).first()[0]  # one number


def _summed(events: DataFrame, entities: DataFrame, entity: str, link: tuple[str, ...], kind: str, time: str) -> DataFrame:
    """entity, kind, n, last: one row per cell, and one with a null kind and n = 0 or more for every entity."""
    pairs = entities.select(*[F.col(c).alias(f"l{i}") for i, c in enumerate(link)], F.col(entity).alias("entity")).where(" AND ".join(["entity IS NOT NULL", *[f"l{i} IS NOT NULL" for i in range(len(link))]])).distinct()
    lonely = entities.select(F.col(entity).alias("entity")).where("entity IS NOT NULL").distinct()
    keys = [f"l{i}" for i in range(len(link))]
    cells = (
        events.select(*[F.col(c).alias(f"l{i}") for i, c in enumerate(link)], F.col(kind).alias("kind"), F.unix_micros(F.col(time).cast("timestamp")).alias("at"))
        .where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        .groupBy(*keys, "kind")
        .agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"))
    )
    return (
        cells.join(pairs, keys)
        .select("entity", "kind", "n", "last")
        .unionByName(lonely.select("entity", F.lit(None).cast("string").alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("last")))
        .groupBy("entity", "kind")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    )


def entity_cells(events: DataFrame, entities: DataFrame, entity: str, link: tuple[str, ...], kind: str, time: str) -> DataFrame:
    """The filled cells of the feature table in long form, for any number of types: entity, type, n, recency_s (see `entity_features`)."""
    anchor = _latest(events, time)
    cells = _summed(events, entities, entity, link, kind, time).where("kind IS NOT NULL")
    recency = F.floor((F.lit(anchor or 0) - F.col("last")) / 1_000_000).cast("long")
    return cells.select(F.col("entity").alias(entity), F.col("kind").alias("type"), "n", recency.alias("recency_s"))


def entity_features(events: DataFrame, entities: DataFrame, entity: str, link: tuple[str, ...], kind: str, time: str, max_types: int = MAX_TYPES, buckets: int = 4096) -> DataFrame:
    """One row per non-null `entity` of `entities`, with `<type>_n` and `<type>_recency_s` for each value of `kind` among `events`.

    `entities` leads from `link` columns to the entity and may hold repeated rows: a pair counts once. Each event
    row counts, repeated ones too. Recency is whole seconds from the latest to the latest time of all events
    (null if the entity has no timed event of that type). total_n and total_recency_s are over all types,
    rows_n and rows_recency_s over all events, with or without a type. Entities without events get zeros and
    nulls. Events with a null in a link column belong to nobody; null types count in rows_n only; events without
    time count but have no recency. A type whose columns would clash (with the totals, with another type's
    in case-insensitive resolution) gets its position in code point order as a suffix: `total#3_n`. Extra columns
    of either table are ignored. No events: zeros and nulls, no type columns.
    """
    types = event_types(events, kind, max_types)
    anchor = _latest(events, time)
    summed = _summed(events, entities, entity, link, kind, time)
    placed = summed.withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(buckets))).repartition("bucket").sortWithinPartitions("bucket", "entity").drop("bucket")
    taken: set[str] = {n.lower() for n in [entity, *_names([])]}
    labels = []
    for j, t in enumerate(types):
        label = t if not {f"{t}_n".lower(), f"{t}_recency_s".lower()} & taken else f"{t}#{j}"
        taken |= {f"{label}_n".lower(), f"{label}_recency_s".lower()}
        labels.append(label)
    names = _names(labels)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType() if i == 0 else T.LongType()) for i in range(len(names))])
    scatter = _scatter(types, anchor)

    def run(batches):
        for b in scatter(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names=[f"c{i}" for i in range(b.num_columns)])

    return placed.mapInArrow(run, schema).toDF(entity, *names[1:])


def p2_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = spark.read.parquet(f"{sf_dir}/bronze.parquet"), spark.read.parquet(f"{sf_dir}/silver.parquet")
    return entity_features(bronze, silver, "lead_id", ("conversation_id", "message_id"), "conversation_outcome", "timestamp")


def p2_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled cells in long form: lead_id, type, n, recency_s."""
    bronze, silver = spark.read.parquet(f"{sf_dir}/bronze.parquet"), spark.read.parquet(f"{sf_dir}/silver.parquet")
    return entity_cells(bronze, silver, "lead_id", ("conversation_id", "message_id"), "conversation_outcome", "timestamp")


def p2_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table's totals, and what its type columns add up to: filled cells, their counts and their recencies."""
    wide = p2_features(spark, sf_dir)
    types = wide.columns[5:]
    numbers = F.array(*[F.col(f"`{c}`") for c in types if c.endswith("_n")])
    ages = F.array(*[F.col(f"`{c}`") for c in types if c.endswith("_recency_s")])
    sums = [F.size(F.filter(numbers, lambda x: x > 0)).alias("filled"), F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x).alias("cells_n"), F.aggregate(ages, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0))).alias("ages_s")]
    return wide.select(*wide.columns[:5], *sums)


SQL = {
    "p2_cells": """SELECT lead_id, conversation_outcome AS type, count(*) AS n, date_sub('second', max(timestamp), (SELECT max(timestamp) FROM bronze)) AS recency_s
FROM (SELECT DISTINCT lead_id, conversation_id, message_id FROM silver WHERE lead_id IS NOT NULL) JOIN bronze USING (conversation_id, message_id)
WHERE conversation_outcome IS NOT NULL GROUP BY lead_id, conversation_outcome""",
    "p2_totals": """
WITH pairs AS (SELECT DISTINCT lead_id, conversation_id, message_id FROM silver WHERE lead_id IS NOT NULL),
anchor AS (SELECT max(timestamp) AS latest FROM bronze),
own AS (SELECT p.lead_id, b.conversation_outcome, b.timestamp, latest, b.batch_id IS NOT NULL OR b.ingested_at IS NOT NULL AS there
        FROM pairs p LEFT JOIN bronze b USING (conversation_id, message_id) CROSS JOIN anchor),
totals AS (SELECT lead_id, count(conversation_outcome) AS total_n,
             date_sub('second', max(timestamp) FILTER (WHERE conversation_outcome IS NOT NULL), any_value(latest)) AS total_recency_s,
             count(*) FILTER (WHERE there) AS rows_n, date_sub('second', max(timestamp), any_value(latest)) AS rows_recency_s
           FROM own GROUP BY lead_id),
cells AS (SELECT lead_id, count(*) AS n, date_sub('second', max(timestamp), any_value(latest)) AS age FROM own WHERE conversation_outcome IS NOT NULL GROUP BY lead_id, conversation_outcome)
SELECT totals.*, coalesce(filled, 0)::INT AS filled, coalesce(cells_n, 0)::BIGINT AS cells_n, coalesce(ages_s, 0)::BIGINT AS ages_s
FROM totals LEFT JOIN (SELECT lead_id, count(*) AS filled, sum(n) AS cells_n, sum(age) AS ages_s FROM cells GROUP BY lead_id) USING (lead_id)""",
}
