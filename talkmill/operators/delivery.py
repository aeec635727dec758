"""At-least-once delivery made exactly-once: one row per identifier, across any number of loads.

Identifiers are encoded exactly: a shard (a hash of the identifier) keeps a dictionary from identifier to a dense code
and a compressed bitmap of the codes that were seen. Arrivals meet the bitmap one identifier at a time: where the bit
isn't set one arrival is admitted and the bit is set; all other arrivals are refused. The new bits are united with the
old ones by switching one pointer file.

Copies are combined before they are shuffled (`groupBy` with partial aggregation), so an identifier that holds any
share of the rows crosses the network once per task; only the keys and the rank of the best copy take part, and the
chosen rows are fetched by one join at the end. The encoding step streams over rows sorted within a shard: its memory
is one bit per identifier of the shard.

The dictionary is written before the bits are switched. A load that is lost in between leaves codes without bits: the
next one finds the codes and, as their bits aren't set, admits their arrivals. Of the stored dictionary a load shuffles
no more than the entries of its own identifiers (a semi-join by hash, no sort), and of the bitmaps those of its shards.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.session import written

#: Shards of the dictionary; a setting of the stored state, so it can't change between loads of one state folder. It
#: bounds the tasks of the encoding step, not their size.
SHARDS = 4096
BITS, KNOWN, ARRIVED = 0, 1, 2


class Bitmap:
    """Growing bitmap of dense codes: packed in memory, compressed where it's stored."""

    def __init__(self, blob: bytes | None = None):
        self.packed = np.frombuffer(zlib.decompress(blob), np.uint8).copy() if blob else np.zeros(128, np.uint8)

    def take(self, codes: np.ndarray) -> np.ndarray:
        """True for each code that wasn't seen; all given codes are seen from now on. `codes` are distinct."""
        at, bit = codes >> 3, (1 << (codes & 7)).astype(np.uint8)
        if len(codes) and (most := int(at.max())) >= len(self.packed):
            self.packed = np.concatenate([self.packed, np.zeros(max(len(self.packed), most + 1 - len(self.packed)), np.uint8)])
        fresh = (self.packed[at] & bit) == 0
        np.bitwise_or.at(self.packed, at, bit)
        return fresh

    def blob(self) -> bytes:
        return zlib.compress(self.packed.tobytes(), 1)


def _encode(keys: list[str]):
    """mapInArrow over rows sorted by shard, kind BITS first, then keys with KNOWN before ARRIVED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, bitmap, following, last_key, last_code, schema = None, None, 0, None, -1, None

        def stored() -> pa.RecordBatch:
            cols = {f.name: pa.nulls(1, f.type) for f in schema}
            cols |= {"shard": pa.array([shard], pa.int32()), "kind": pa.array([BITS], pa.int32()), "bits": pa.array([bitmap.blob()], pa.binary()), "code": pa.array([following], pa.int64())}
            return pa.RecordBatch.from_arrays([cols[f.name] for f in schema], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            fields = [*batch.schema, pa.field("is_new", pa.bool_()), pa.field("fresh", pa.bool_())]
            schema = schema or pa.schema(fields)
            shards = batch.column("shard").to_numpy(zero_copy_only=False)
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            n = len(shards)
            code = pc.fill_null(batch.column("code"), -1).to_numpy(zero_copy_only=False).copy()
            changed = np.zeros(n, bool)
            for k in keys:
                col = batch.column(k)
                if n > 1:
                    changed[1:] |= pc.fill_null(pc.not_equal(col[1:], col[:-1]), True).to_numpy(zero_copy_only=False)
            key0 = tuple(batch.column(k)[0].as_py() for k in keys)
            changed[0] = (shard, last_key) != (shards[0], key0)
            changed[1:] |= shards[1:] != shards[:-1]
            is_new, fresh = np.zeros(n, bool), np.zeros(n, bool)
            edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1), n]
            for a, b in zip(edges[:-1], edges[1:]):
                if shards[a] != shard:
                    if bitmap is not None:
                        yield stored()
                    shard, bitmap, following, last_code = int(shards[a]), Bitmap(), 0, -1
                if kinds[a] == BITS:
                    blob = batch.column("bits")[a].as_py()
                    bitmap, following = Bitmap(blob), int(code[a])
                    a += 1
                    if a == b:
                        continue
                known = kinds[a:b] == KNOWN
                fresh_key = changed[a:b] & ~known
                if a > 0 and kinds[a - 1] == BITS:
                    fresh_key[0] = not known[0]
                fresh[a:b] = fresh_key
                c = code[a:b]
                number = following + np.cumsum(fresh_key) - 1
                c[fresh_key] = number[fresh_key]
                following += int(fresh_key.sum())
                same = np.flatnonzero(~known & ~fresh_key)
                before = np.where(same > 0, c[same - 1], last_code)
                c[same] = before
                code[a:b] = c
                arrived = np.flatnonzero(~known)
                is_new[a:b][arrived] = bitmap.take(c[arrived])
                last_code = int(c[-1])
            last_key = tuple(batch.column(k)[n - 1].as_py() for k in keys)
            cols = {f.name: batch.column(f.name) for f in batch.schema} | {"code": pa.array(code, pa.int64()), "is_new": pa.array(is_new), "fresh": pa.array(fresh)}
            out = pa.RecordBatch.from_arrays([cols[f.name] for f in schema], schema=schema)
            yield out.filter(pa.array(kinds == ARRIVED))
        if bitmap is not None:
            yield stored()

    return run


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _current(spark: SparkSession, state: str) -> dict | None:
    fs, path = _filesystem(spark, state)
    at = path(f"{state}/CURRENT")
    if not fs.exists(at):
        return None
    return json.loads(spark.read.text(f"{state}/CURRENT", wholetext=True).first()[0])


def _switch(spark: SparkSession, state: str, content: dict) -> None:
    """One rename makes a load's dictionary and bits visible together; before it, the old ones hold."""
    fs, path = _filesystem(spark, state)
    new, at = path(f"{state}/.CURRENT.{content['load']}"), path(f"{state}/CURRENT")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    options = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    rename = spark.sparkContext._gateway.new_array(options, 1)
    rename[0] = options.OVERWRITE
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, at, rename)


def deliver_once(
    arrivals: DataFrame,
    keys: tuple[str, ...] = ("conversation_id", "message_id"),
    order: tuple[str, ...] = ("ingested_at", "batch_id"),
    state: str | None = None,
    payload: bool = True,
    shards: int = SHARDS,
) -> DataFrame:
    """One row per identifier of `arrivals`: the keys, n_rows (copies in this load), is_new (an arrival was admitted: its bit wasn't set), refused (arrivals that met a set bit) and, with `payload`, arrival (the whole chosen row as a struct).

    Rows with a null in any key take no part. Of several copies the one that is first by `order` (nulls last)
    remains; equal ones are told apart by a hash of the whole row, and if that is equal too they're the same row.
    `state` names a folder in which identifiers seen by earlier loads are kept; without it only this load counts.
    Keys must be strings. Extra columns are carried inside `arrival`, so their names can't clash. An empty input
    gives an empty result.
    """
    spark = arrivals.sparkSession
    keys_, order_ = list(keys), [c for c in order if c in arrivals.columns]
    names = [f"key_{i}" for i in range(len(keys_))]
    named = [F.col(f"`{k}`").alias(n) for k, n in zip(keys_, names)]
    rows = arrivals.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys_))
    plain = [F.col(f"`{f.name}`") for f in arrivals.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    print_ = F.xxhash64(*plain)
    rank = F.struct(*[x for c in order_ for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))], print_)
    aggs = [F.count(F.lit(1)).alias("n_rows"), *([F.min_by(print_, rank).alias("chosen")] if payload else [])]
    once = rows.groupBy(*named).agg(*aggs)
    shard = F.pmod(F.xxhash64(*names), F.lit(shards)).cast("int")
    none = {"code": F.lit(None).cast("long"), "bits": F.lit(None).cast("binary")}
    now = once.select(shard.alias("shard"), F.lit(ARRIVED).alias("kind"), *names, none["code"].alias("code"), none["bits"].alias("bits"), *[c for c in once.columns if c not in names])
    seen, load = (_current(spark, state) if state else None), None
    every = now
    if state:
        load = f"load-{(seen or {}).get('n', 0) + 1:06d}"
        if seen and (seen["shards"] != shards or seen["keys"] != keys_):
            raise ValueError(f"{state} was made with keys {seen['keys']} and {seen['shards']} shards")
        now = written(now, "arrivals")
        every = now
        if parts := _dictionaries(spark, state):
            known = spark.read.parquet(*parts).select("shard", *names, "code")
            known = known.join(now.select("shard", *names).hint("shuffle_hash"), ["shard", *names], "left_semi")
            every = every.unionByName(known.select("shard", F.lit(KNOWN).alias("kind"), *names, "code", none["bits"].alias("bits")), allowMissingColumns=True)
            ends = spark.read.parquet(*parts).groupBy("shard").agg((F.max("code") + 1).alias("code"))
            held = spark.read.parquet(f"{state}/{seen['bits']}").select("shard", "bits") if seen else spark.createDataFrame([], "shard int, bits binary")
            # at most one row per shard
            touched = ends.join(held, "shard", "left").join(now.select("shard").distinct(), "shard", "left_semi")
            every = every.unionByName(touched.select("shard", F.lit(BITS).alias("kind"), *[F.lit(None).cast("string").alias(n) for n in names], "code", "bits"), allowMissingColumns=True)
    placed = every.repartition("shard").sortWithinPartitions("shard", F.col("kind") != BITS, *names, "kind")
    added = [T.StructField("is_new", T.BooleanType()), T.StructField("fresh", T.BooleanType())]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in placed.schema], *added])
    coded = placed.mapInArrow(_encode(names), schema)
    if state:
        fs, path = _filesystem(spark, state)
        # what is left of a load that didn't come to its switch: its dictionary counts, its bits don't
        part = f"{load}-{len(_dictionaries(spark, state)):06d}"
        coded = written(coded, "coded")
        coded.where((F.col("kind") == ARRIVED) & F.col("fresh")).select("shard", *names, "code").write.parquet(f"{state}/dictionary/{part}")
        fresh_bits = coded.where(F.col("kind") == BITS).select("shard", "bits")
        if seen:
            kept = spark.read.parquet(f"{state}/{seen['bits']}").select("shard", "bits")
            fresh_bits = fresh_bits.unionByName(kept.join(fresh_bits.select("shard"), "shard", "left_anti"))
        fs.delete(path(f"{state}/bits/{load}"), True)
        fresh_bits.write.parquet(f"{state}/bits/{load}")
        _switch(spark, state, {"load": load, "n": (seen or {}).get("n", 0) + 1, "shards": shards, "keys": keys_, "bits": f"bits/{load}"})
    done = coded.where(F.col("kind") == ARRIVED)
    out = [F.col(n).alias(k) for n, k in zip(names, keys_)] + ["n_rows", "is_new", (F.col("n_rows") - F.col("is_new").cast("int")).alias("refused")]
    if not payload:
        return done.select(*out)
    whole = F.struct(*[F.col(f"`{c}`") for c in arrivals.columns])
    source = rows.select(*[F.col(f"`{k}`").alias(f"own_{i}") for i, k in enumerate(keys_)], print_.alias("own_print"), whole.alias("arrival"))
    same = " AND ".join(["own_print = chosen", *[f"own_{i} = key_{i}" for i in range(len(keys_))]])
    # copies that are equal in every column are one row
    return source.join(done.hint("merge"), F.expr(same)).dropDuplicates(names).select(*out, "arrival")


def _dictionaries(spark: SparkSession, state: str) -> list[str]:
    """Finished parts of the dictionary; a part that wasn't written to its end has no mark and counts for nothing."""
    fs, path = _filesystem(spark, state)
    home = path(f"{state}/dictionary")
    if not fs.exists(home):
        return []
    return sorted(x.getPath().toString() for x in fs.listStatus(home) if fs.exists(path(f"{x.getPath().toString()}/_SUCCESS")))


def unique_rows(arrivals: DataFrame, **options) -> DataFrame:
    """The rows of `arrivals` with exactly one copy of each identifier not seen before; same columns."""
    return deliver_once(arrivals, **options).where("is_new").select("arrival.*")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which the bitmap refused an arrival."""
    bronze = spark.read.parquet(f"{sf_dir}/bronze.parquet")
    return deliver_once(bronze, payload=False).where("refused > 0").select("conversation_id", "message_id")


def p4_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The remaining rows of bronze, with the columns by which the SQL check can tell the copies apart."""
    bronze = spark.read.parquet(f"{sf_dir}/bronze.parquet")
    return unique_rows(bronze).groupBy("conversation_id", "message_id").agg(F.count(F.lit(1)).alias("n"), F.min("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


SQL = {
    "p4_found": "SELECT conversation_id, message_id FROM bronze WHERE conversation_id IS NOT NULL AND message_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "p4_unique": "SELECT conversation_id, message_id, 1::BIGINT AS n, min(ingested_at)::TIMESTAMP AS ingested_at FROM bronze WHERE conversation_id IS NOT NULL AND message_id IS NOT NULL GROUP BY ALL",
}
