"""Calls to an outside model as a join: distinct texts, cached answers, a bounded number of new calls.

The model is an injected callable and never called from a projection. Answers are keyed by a hash of the whole
request; misses are ranked by key, so which ones are within the budget doesn't depend on partitioning, and their
answers are written before they're joined, so a retried task repeats at most its own calls.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.functions.text import strip
from talkmill.session import written

log = logging.getLogger("talkmill.model")
ENTITIES = {"concorrente_mencionado": str, "veiculo_marca": str, "veiculo_modelo": str, "veiculo_ano": int, "valor_pago_atual_brl": float, "sinistro_historico": bool}
ANSWER = "veiculo_marca string, veiculo_modelo string, veiculo_ano int, concorrente_mencionado string, valor_pago_atual_brl double, sinistro_historico boolean"
LONGEST_REPLY = 4096


def cache_key(model: str, system: str, user: Column, max_tokens: int, temperature: float) -> Column:
    """Hash of the request; a zero temperature's sign doesn't matter."""
    lines = [F.lit(f"model={model}"), F.lit(f"system={system}"), F.concat(F.lit("user="), user), F.lit(f"max_tokens={max_tokens}"), F.lit(f"temperature={temperature + 0.0:.6f}")]
    return F.sha2(F.concat_ws("\n", *lines).cast("binary"), 256)


def coerced(value, kind: type):
    """A reply's value as `kind`, or None: no truth values for numbers, only whole floats for ints, blank text is none."""
    if value is None:
        return None
    if kind is str:
        return (value.strip() or None) if isinstance(value, str) else None
    if kind is bool:
        return value if isinstance(value, bool) else None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    if kind is int:
        return int(value) if float(value).is_integer() else None
    return float(value)


def parse_reply(reply: str | None) -> dict:
    """All entities of a reply, or all None if it isn't an object with every key; a code fence around it is dropped."""
    none = dict.fromkeys(ENTITIES)
    if not reply or len(reply) > LONGEST_REPLY:
        return none
    text = reply.strip()
    if text.startswith("```"):
        text = text.strip("`").removeprefix("json")
    try:
        got = json.loads(text)
    except ValueError:
        return none
    if not isinstance(got, dict) or not ENTITIES.keys() <= got.keys():
        return none
    return {k: coerced(got[k], t) for k, t in ENTITIES.items()}


def missing_bodies(rows: DataFrame, cache: DataFrame, key: Callable[[Column], Column], budget: int, body: str = "message_body_masked") -> DataFrame:
    """key and body of the distinct non-blank texts without a cached answer, at most `budget` of them, by key."""
    texts = rows.select(F.col(body).alias("body")).where(F.length(strip(F.col("body"))) > 0).distinct().withColumn("key", key(F.col("body")))
    misses = texts.join(cache.select("key"), "key", "left_anti")
    return within_budget(misses, "key", budget).where("in_budget").drop("in_budget")


def fill_entities(rows: DataFrame, call: Callable[[str], str], cache: DataFrame, key: Callable[[Column], Column], budget: int, concurrency: int = 16, body: str = "message_body_masked") -> tuple[DataFrame, DataFrame]:
    """(`rows` with the entity columns filled, the new cache rows key and reply). A failed call leaves nulls and stays charged."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            replies = []
            for text in b["body"]:
                try:
                    replies.append(call(text))
                except Exception as e:  # noqa: BLE001 - the outside model may fail in any way; the row stays empty
                    log.warning("no reply for text %s: %s", hashlib.sha256(text.encode()).hexdigest()[:16], type(e).__name__)
                    replies.append(None)
            yield pd.DataFrame({"key": b["key"], "reply": replies})

    asked = missing_bodies(rows, cache, key, budget, body).repartition(concurrency).mapInPandas(ask, "key string, reply string")
    fresh = written(asked.where("reply IS NOT NULL"), "model-replies")
    answers = cache.select("key", "reply").unionByName(fresh)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parsed = pd.DataFrame([parse_reply(r) for r in b["reply"]], columns=list(ENTITIES), dtype=object)
            parsed.insert(0, "key", b["key"].to_numpy())
            yield parsed[["key", *[f.name for f in shape]]]

    shape = rows.schema
    shape = T.StructType([shape[c] for c in ("veiculo_marca", "veiculo_modelo", "veiculo_ano", "concorrente_mencionado", "valor_pago_atual_brl", "sinistro_historico")])
    known = answers.mapInPandas(parse, f"key string, {ANSWER}")
    names = [f.name for f in shape]
    known = known.toDF("__key", *[f"__{n}" for n in names])
    keyed = rows.withColumn("__key", key(F.col(body)))
    filled = keyed.join(known, "__key", "left").withColumns({n: F.coalesce(f"__{n}", n) for n in names})
    return filled.select(*rows.columns), fresh


def within_budget(misses: DataFrame, key: str, budget: int) -> DataFrame:
    """Marks the first `budget` rows by key: in_budget. Ranks are counted per range of keys (those with the same first two
    characters, 256 ranges for digests), so no task holds all rows."""
    w = Window.partitionBy("__range").orderBy(key)
    placed = misses.withColumn("__range", F.substring(F.col(key).cast("string"), 1, 2))
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))).drop("__n")  # one row per range
    ranked = placed.withColumn("__rank", F.row_number().over(w)).join(before, "__range")
    return ranked.withColumn("in_budget", F.coalesce("__before", F.lit(0)) + F.col("__rank") <= budget).drop("__range", "__rank", "__before")
