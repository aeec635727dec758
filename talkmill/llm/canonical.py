"""Freely typed values mapped to entries of a reference list.

Token-level repair: each distinct token of the typed values is joined to the reference vocabulary of its field
by edit distance (over shared deletions), and the entries that contain a repaired token are ranked by soft
TF-IDF: the cosine between the value's and the entry's token weights, each found token weighted by its similarity.
So a value that holds a longer entry means that one and not a shorter entry inside it. Everything runs over distinct
values; rows are joined to the result at the end.

Only the reference side is broadcast, and only if its rows were counted and are few (REFERENCE_ROWS); a longer list is
shuffled like everything else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkmill.llm.edits import close_pairs
from talkmill.llm.textnorm import folded
from talkmill.session import written

#: A value means an entry if at least this share of the entry's weight is found.
LEAST = 0.4
UNMATCHED = -1
#: Rows of the reference index up to which it's broadcast, and with it the keys of its words (some fifty of each).
REFERENCE_ROWS = 20_000
_INNER = re.compile(r"(?<=\w)[.\-'’](?=\w)")
_WORD = re.compile(r"[^\W_]+")


def entry_tokens(value: str) -> list[str]:
    """Folded words of an entry, in letters of any script, and of numbers."""
    return sorted({*_WORD.findall(folded(value))})


def value_tokens(value: str) -> list[str]:
    """Folded words, words with inner marks removed, and neighbours run together (a name may have been split)."""
    text = folded(value)
    words = _WORD.findall(text)
    solid = _WORD.findall(_INNER.sub("", text))
    return sorted({*words, *solid, *(a + b for a, b in zip(solid, solid[1:]))})


def _tokens(values: DataFrame, name: str, cut=value_tokens) -> DataFrame:
    """`values` with a row for each token."""
    schema = f"{values.schema.simpleString()[7:-1]},token:string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["token"] = [cut(v) for v in b[name]]
            yield b.explode("token").dropna(subset=["token"])

    return values.mapInPandas(run, ", ".join(x.replace(":", " ", 1) for x in schema.split(",")))


def index_entries(entries: DataFrame) -> DataFrame:
    """field, word, ref_id, parent, weight (squared idf) and norm (length of the entry's vector) as a written table."""
    words = _tokens(entries, "value", entry_tokens)
    sizes = entries.select("field", "value").distinct().groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    counts = words.select("field", "value", "token").distinct().groupBy("field", "token").agg(F.count(F.lit(1)).alias("k"))
    weights = counts.join(sizes, "field").select("field", "token", F.pow(F.log(1 + F.col("n") / F.col("k")), 2).alias("weight"))
    weighted = words.select("field", "ref_id", "parent", "token").distinct().join(weights, ["field", "token"])
    length = F.sqrt(F.sum("weight").over(Window.partitionBy("field", "ref_id")))
    return written(weighted.select("field", F.col("token").alias("word"), "ref_id", "parent", "weight", length.alias("norm")), "reference-index")


def match_values(values: DataFrame, reference: DataFrame, least: float = LEAST) -> DataFrame:
    """field, value and the candidates of each distinct value: ref_id, parent, score; best ones first by score.

    `values` has field and value, `reference` field, value, ref_id and parent. An entry is a candidate if at least
    `least` of its squared weight is found; of these, the ones with the best cosine are kept, so equal names of
    different parents stay together. Numbers are words that can't be repaired: they match exactly.
    """
    entries = reference.where("field IS NOT NULL AND value IS NOT NULL AND ref_id IS NOT NULL").select("field", F.col("ref_id").cast("long").alias("ref_id"), F.col("parent").cast("long").alias("parent"), "value")
    index = index_entries(entries)
    few = index.count() <= REFERENCE_ROWS
    small = F.broadcast if few else lambda df: df.hint("merge")
    typed = written(_tokens(values.select("field", "value").where("field IS NOT NULL AND value IS NOT NULL").distinct(), "value"), "typed-tokens")
    vocabulary = index.select("field", "word").distinct()
    repaired = close_pairs(typed.select("field", F.col("token").alias("word")), vocabulary, "field", small_right=few)
    numbers = F.col("a").rlike("^[0-9]+$") | F.col("b").rlike("^[0-9]+$")
    similar = repaired.where((F.col("d") == 0) | ~numbers).select("field", F.col("a").alias("token"), F.col("b").alias("word"), (1 - F.col("d") / F.greatest(F.length("a"), F.length("b"))).alias("sim"))
    words = typed.join(similar.hint("merge"), ["field", "token"]).groupBy("field", "value", "word").agg(F.max("sim").alias("sim"))
    vector = Window.partitionBy("field", "value")
    weights = index.select("field", "word", "weight").distinct()
    words = words.join(small(weights), ["field", "word"]).withColumn("length", F.sqrt(F.sum("weight").over(vector))).drop("weight")
    found = (
        words.join(small(index), ["field", "word"])
        .groupBy("field", "value", "ref_id", "parent")
        .agg(F.sum(F.col("weight") * F.col("sim")).alias("sum"), F.first("norm").alias("norm"), F.first("length").alias("length"))
        .where(F.col("sum") >= least * F.pow("norm", F.lit(2.0)))
        .withColumn("score", F.round(F.col("sum") / (F.col("norm") * F.col("length")), 6))
    )
    return found.withColumn("best", F.max("score").over(vector)).where("score = best").select("field", "value", "ref_id", "parent", "score")


def canonical_values(rows: DataFrame, reference: DataFrame, fields: tuple[str, ...], keys: tuple[str, ...], child: str | None = None, parent: str | None = None, least: float = LEAST) -> DataFrame:
    """keys, field_name, value, ref_id: one row for each distinct (keys, field, non-null value) of `rows`; ref_id is -1 if no entry is meant.

    Where several entries are equally near, the one whose parent_ref_id is the entry meant by the row's `parent`
    field decides (for the field `child`), else the lowest ref_id. Rows with a null value of a field have no row for
    it; null keys stay. Blank values and values without letters or digits are unmatched. Extra columns are ignored. An empty
    reference leaves every value unmatched.
    """
    ref = reference.select(F.col("field_name").alias("field"), F.col("canonical_value").alias("value"), "ref_id", F.col("parent_ref_id").alias("parent"))
    make = F.col(parent) if parent else F.lit(None).cast("string")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), F.when(F.lit(f == child), make).alias("make")) for f in fields]))
    long = rows.select(*[F.col(k) for k in keys], each.alias("x")).select(*keys, "x.*").where("value IS NOT NULL").distinct()
    long = written(long, "typed-values")
    distinct = long.select("field", "value", "make").distinct()
    candidates = written(match_values(distinct, ref, least), "typed-candidates")
    makes = candidates.where(F.col("field") == (parent or "")).groupBy("value").agg(F.min("ref_id").alias("make_ref")).withColumnRenamed("value", "make")
    chosen = (
        distinct.join(candidates.hint("merge"), ["field", "value"], "left")
        .join(makes.hint("merge"), "make", "left")
        .groupBy("field", "value", "make")
        .agg(F.min_by("ref_id", F.struct(~F.coalesce(F.col("parent") == F.col("make_ref"), F.lit(False)), "ref_id")).alias("ref_id"))
    )
    chosen = chosen.select(F.col("field").alias("f"), F.col("value").alias("v"), F.col("make").alias("m"), F.coalesce("ref_id", F.lit(UNMATCHED).cast("long")).alias("ref_id"))
    return long.join(chosen.hint("merge"), F.expr("field = f AND value = v AND make <=> m")).select(*keys, F.col("field").alias("field_name"), "value", "ref_id")


FIELDS = ("concorrente_mencionado", "veiculo_marca", "veiculo_modelo")


def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, reference = spark.read.parquet(f"{sf_dir}/silver.parquet"), spark.read.parquet(f"{sf_dir}/reference_values.parquet")
    return canonical_values(silver, reference, FIELDS, ("conversation_id", "message_id"), child="veiculo_modelo", parent="veiculo_marca")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = spark.read.parquet(f"{sf_dir}/reference_values.parquet")
    exact = reference.where("canonical_value IS NOT NULL").select("field_name", F.col("canonical_value").alias("value")).distinct()
    few = reference.count() <= REFERENCE_ROWS
    return p5_values(spark, sf_dir).join(F.broadcast(exact) if few else exact.hint("merge"), ["field_name", "value"], "left_anti").select("conversation_id", "message_id", "field_name", "ref_id").distinct()
