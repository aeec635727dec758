"""Queries for scans, Bronze and Silver operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill import schemas
from talkmill.functions import lead, masking, scoring, text
from talkmill.operators import bronze as b
from talkmill.operators import silver as s
from talkmill.sources.tables import table

SECRET = "test-secret"
AT = datetime(2025, 6, 1)
ID = ("conversation_id", "message_id", "batch_id")


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze")


def _column(name: str, make) -> tuple:
    """A query that projects the row's ids and one computed column, as distinct rows."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        return _bronze(spark, d).select(*ID, make().alias(name)).distinct()

    return query


def bronze_scan(spark, d):
    return _bronze(spark, d).select("message_id", "conversation_id", "direction", "status", "batch_id").where("direction = 'inbound'")


def raw(spark, d):
    """bronze as the raw table of strings that it came from."""
    t = _bronze(spark, d)
    return t.select(*[F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias(c) if c == "timestamp" else F.col(c) for c in schemas.SOURCE_COLUMNS])


def bronze_typed(spark, d):
    out = b.bronze_typed(raw(spark, d), "b1", "h1", AT)
    return schemas.assert_schema(out, schemas.BRONZE, "bronze").withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def quarantine_rejected(spark, d):
    return s.partition_rows(_bronze(spark, d), AT)[1].select("message_id", "conversation_id", "batch_id", "reject_reason", F.col("rejected_at").cast("timestamp_ntz").alias("rejected_at"))


def quarantine_valid(spark, d):
    return s.partition_rows(_bronze(spark, d), AT)[0].select(*ID, "status")


def silver_dedup(spark, d):
    valid = s.partition_rows(_bronze(spark, d), AT)[0]
    return s.dedup_events(valid).select("conversation_id", "message_id", "status", "timestamp", "batch_id")


def silver_metadata(spark, d):
    return _bronze(spark, d).select(*ID, s.parsed_metadata(F.col("metadata")).alias("m")).select(*ID, F.col("m").isNotNull().alias("parsed"), "m.*").distinct()


def silver_mask_counts(spark, d):
    counts = masking.mask_counts(F.col("message_body"))
    return _bronze(spark, d).agg(*[F.sum(c).cast("long").alias(n) for n, c in counts.items()])


def silver_reconcile_name(spark, d):
    rows = table(spark, d, "silver").select("conversation_id", "message_id", "silver_batch_id", "lead_id", "sender_name_normalized")
    return s.reconcile_names(rows)


def silver_full(spark, d):
    valid = s.partition_rows(_bronze(spark, d), AT)[0]
    out = schemas.assert_schema(s.silver_transform(valid, SECRET, AT), schemas.SILVER, "silver")
    return out.select("conversation_id", "message_id", "silver_batch_id", "lead_id", "has_content", "has_cpf", "cep_prefix", "email_domain", "audio_confidence", "status", F.col("metadata.state").alias("state"))


def schema_conform(spark, d):
    drifted = _bronze(spark, d).select("message_id", "conversation_id", F.col("direction"), F.when(F.col("status") == "sent", "lost").otherwise(F.col("status")).alias("status"), F.lit("x").alias("surplus"), F.when(F.length("message_body") > 20, "many").otherwise(F.length("message_body").cast("string")).alias("veiculo_ano"))
    shape = schemas.T.StructType([schemas.SILVER[c] for c in ("message_id", "conversation_id", "veiculo_ano", "direction", "status", "sinistro_historico")])
    return schemas.conform(drifted, shape)


def union_append(spark, d):
    t = _bronze(spark, d).select("message_id", "conversation_id", "status")
    return t.unionByName(table(spark, d, "rejected").select("message_id", "conversation_id", "status"))


def phrase_hits(spark, d):
    x = text.folded(F.col("message_body"))
    rows = _bronze(spark, d).select(*ID, x.alias("x"))
    groups = {"objections": text.OBJECTIONS, "haggling": text.HAGGLING, "closing": text.CLOSING, "evasive": text.EVASIVE, "technical": text.TECHNICAL}
    return rows.select(*ID, *[text.phrase_hits(F.col("x"), p, True).alias(n) for n, p in groups.items()]).distinct()


def score_cube(spark, d):
    cells = spark.range(3**4).select(*[(F.floor(F.col("id") / 3**i) % 3 / 2.0).alias(f"c{i}") for i in range(4)])
    return cells.select("*", scoring.weighted_score({f"c{i}": F.col(f"c{i}") for i in range(4)}, {"c0": 40, "c1": 35, "c2": 20, "c3": 5}).alias("score"))


_body = lambda f: lambda: f(F.col("message_body"))
QUERIES = {
    "bronze_scan": bronze_scan,
    "bronze_typed": bronze_typed,
    "quarantine_rejected": quarantine_rejected,
    "quarantine_valid": quarantine_valid,
    "silver_status_priority": _column("priority", lambda: s.status_priority(F.col("status"))),
    "silver_dedup": silver_dedup,
    "silver_metadata": silver_metadata,
    "silver_name_norm": _column("name", lambda: text.normalized_name(F.col("sender_name"))),
    "silver_mask_phone": _column("masked", lambda: masking.mask_sender(F.col("sender_phone"))),
    "silver_mask_email": _column("masked", _body(masking.mask_email)),
    "silver_mask_cpf": _column("masked", _body(masking.mask_cpf)),
    "silver_mask_cep": _column("masked", _body(masking.mask_cep)),
    "silver_mask_plate": _column("masked", _body(masking.mask_plates)),
    "silver_mask_body": _column("masked", _body(masking.mask_body)),
    "silver_mask_counts": silver_mask_counts,
    "silver_has_content": _column("has_content", _body(masking.has_content)),
    "silver_email_domain": _column("domain", _body(masking.email_domain)),
    "silver_has_cpf": _column("has_cpf", _body(masking.has_cpf)),
    "silver_cep_prefix": _column("prefix", _body(masking.cep_prefix)),
    "silver_has_phone": _column("has_phone", _body(masking.has_phone)),
    "silver_plate_format": _column("format", _body(masking.plate_format)),
    "silver_phone_norm": _column("digits", lambda: lead.phone_digits(F.col("sender_phone"))),
    "silver_lead_id": _column("lead", lambda: lead.lead_id(F.col("sender_phone"), SECRET)),
    "silver_audio_confidence": _column("confidence", lambda: masking.audio_confidence(F.col("message_type"), F.col("message_body"))),
    "silver_reconcile_name": silver_reconcile_name,
    "silver_full": silver_full,
    "schema_conform": schema_conform,
    "union_append": union_append,
    "phrase_hits": phrase_hits,
    "score_cube": score_cube,
}

# SQL -----------------------------------------------------------------------------------------------------------
_CPF, _CEP = r"\b\d{3}\.\d{3}\.\d{3}-?\d{2}\b", r"\b\d{5}-?\d{3}\b"
_EMAIL = r"\b([A-Za-z0-9._%+\-]+)@([A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*)\.([A-Za-z]{2,})\b"
_PHONE = r"(?:^|[^\d])(?:\+?55\s?-?)?\(?\d{2}\)?\s?-?9?\d{4}[\s\-]?\d{4}(?:[^\d]|$)"
_SPACE = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(column: str) -> str:
    return rf"regexp_replace({column}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


_CONTENT = f"coalesce(length({_strip('message_body')}) > 0, false)"
_DIGITS = "regexp_replace(sender_phone, '[^0-9]', '', 'g')"
_LOCAL = f"CASE WHEN length({_DIGITS}) IN (12, 13) AND {_DIGITS} LIKE '55%' THEN substr({_DIGITS}, 3) ELSE {_DIGITS} END"
_PHONE_DIGITS = f"CASE WHEN length({_LOCAL}) BETWEEN 10 AND 13 THEN {_LOCAL} END"
_PADS = ["".join(f"{x ^ p:02x}" for x in SECRET.encode().ljust(64, b"\0")) for p in (0x36, 0x5C)]
_LEAD = f"substr(sha256(unhex('{_PADS[1]}') || unhex(sha256(unhex('{_PADS[0]}') || ({_PHONE_DIGITS})::BLOB))), 1, 16)"
_DOMAIN = rf"CASE WHEN regexp_matches(message_body, '{_EMAIL}') THEN lower(regexp_extract(message_body, '{_EMAIL}', 2) || '.' || regexp_extract(message_body, '{_EMAIL}', 3)) END"
# Masks. RE2 has no look-around, so the borders of digit runs are marked first: \ue000 before a run, \ue001 after it.
_S, _E = "\ue000", "\ue001"
_marked = lambda x: f"regexp_replace(regexp_replace({x}, '([0-9])([^0-9]|$)', '\\1{_E}\\2', 'g'), '(^|[^0-9])([0-9])', '\\1{_S}\\2', 'g')"
_PHONE_MARKED = rf"(?:(^|[^{_E}])(?:\+{_S}55{_E}?\s?-?\(?{_S}?|\({_S})|{_S}55{_E}?\s?-?\(?{_S}?|{_S})[0-9]{{2}}{_E}?\)?\s?-?{_S}?9?[0-9]{{4}}{_E}?[\s\-]?{_S}?[0-9]{{2}}([0-9]{{2}}){_E}"
_stars = lambda x: f"substr({x}, 1, 1) || repeat('*', greatest(length({x}) - 1, 4))"
_parts = lambda x: ", ".join(f"regexp_extract_all({x}, '{_EMAIL}', {i})" for i in (1, 2, 3))


def _email_masked(x: str) -> str:
    label = "split_part(z[3], '.', 1)"
    return f"CASE WHEN {x} IS NOT NULL THEN array_to_string(list_transform(list_zip(string_split_regex({x}, '{_EMAIL}'), {_parts(x)}), lambda z: z[1] || coalesce({_stars('z[2]')} || '@' || {_stars(label)} || '.' || z[4], '')), '') END"


def _phone_masked(x: str) -> str:
    return f"regexp_replace(regexp_replace({_marked(x)}, '{_PHONE_MARKED}', '\\1+55 (**) *****-**\\2', 'g'), '[{_S}{_E}]', '', 'g')"


_cpf_masked = lambda x: f"regexp_replace({x}, '{_CPF}', '***.***.***-**', 'g')"
_cep_masked = lambda x: f"regexp_replace({x}, '{_CEP}', '*****-***', 'g')"
_PLATES = (r"\b([A-Z]{3})(\d)([A-Z])(\d{2})\b", r"\b[A-Z]{3}-?(\d{2})(\d{2})\b")
_new_masked = lambda x: f"regexp_replace({x}, '{_PLATES[0]}', '***\\2\\3**', 'g')"
_old_masked = lambda x: f"regexp_replace({x}, '{_PLATES[1]}', '***-**\\2', 'g')"


def _mask_steps() -> str:
    """The body after each mask, one subquery per step: columns t0 (as it is) to t6."""
    source = "(SELECT *, message_body AS t0 FROM bronze)"
    for i, step in enumerate((_email_masked, _cpf_masked, _cep_masked, _phone_masked, _new_masked, _old_masked)):
        source = f"(SELECT *, {step(f't{i}')} AS t{i + 1} FROM {source})"
    return source


def _mask_sums() -> str:
    found = {"email": ("t0", _EMAIL), "cpf": ("t1", _CPF), "cep": ("t2", _CEP), "phone": (_marked("t3"), _PHONE_MARKED), "plate_new": ("t4", _PLATES[0]), "plate_old": ("t5", _PLATES[1])}
    return ", ".join(f"sum(coalesce(len(regexp_extract_all({x}, '{p}')), 0))::BIGINT AS {n}" for n, (x, p) in found.items())


_AUDIO = (
    "CASE WHEN message_type = 'audio' THEN CASE WHEN "
    + " OR ".join(f"contains(lower(coalesce(message_body, '')), '{m}')" for m in masking.NOISE_MARKERS)
    + rf" OR regexp_matches(coalesce(message_body, ''), '\.{{3,}}') OR message_body IS NULL OR length({_strip('message_body')}) < 10 THEN 'low' ELSE 'high' END END"
)
_PRIORITY = "CASE status WHEN 'read' THEN 3 WHEN 'delivered' THEN 2 WHEN 'sent' THEN 1 ELSE 0 END"
_TIES = ", ".join(f"{c} NULLS LAST" for c in schemas.BRONZE.fieldNames() if c not in ("message_id", "conversation_id", "status", "timestamp", "batch_id"))
_DEDUP = f"(SELECT * FROM bronze WHERE conversation_id IS NOT NULL AND message_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conversation_id, message_id ORDER BY {_PRIORITY} DESC, timestamp DESC NULLS LAST, batch_id DESC NULLS LAST, {_TIES}) = 1)"
_META = "CASE WHEN kind = 'OBJECT' THEN {} END"
_JSON = "(SELECT * REPLACE (CASE WHEN json_valid(metadata) THEN metadata END AS metadata), CASE WHEN json_valid(metadata) THEN json_type(metadata) END AS kind FROM {})"


def _sql(name: str, expression: str) -> str:
    return f"SELECT DISTINCT conversation_id, message_id, batch_id, {expression} AS {name} FROM bronze"


def _hits(phrases: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"contains(x, '{text.fold(p)}')::INT" for p in phrases) + ")"


def _meta(field: str, cast: str = "VARCHAR") -> str:
    inner = f"metadata->>'$.{field}'"
    return _META.format(f"TRY_CAST({inner} AS {cast})" if cast != "VARCHAR" else inner)


SQL = {
    "bronze_scan": "SELECT message_id, conversation_id, direction, status, batch_id FROM bronze WHERE direction = 'inbound'",
    "bronze_typed": "SELECT message_id, conversation_id, timestamp, direction, sender_phone, sender_name, message_type, message_body, status, channel, campaign_id, agent_id, conversation_outcome, metadata, 'b1' AS batch_id, TIMESTAMP '2025-06-01' AS ingested_at, 'h1' AS source_file_hash FROM bronze",
    "quarantine_rejected": "SELECT message_id, conversation_id, batch_id, CASE WHEN message_id IS NULL THEN 'null_message_id' ELSE 'null_conversation_id' END AS reject_reason, TIMESTAMP '2025-06-01' AS rejected_at FROM bronze WHERE message_id IS NULL OR conversation_id IS NULL",
    "quarantine_valid": "SELECT conversation_id, message_id, batch_id, status FROM bronze WHERE message_id IS NOT NULL AND conversation_id IS NOT NULL",
    "silver_status_priority": _sql("priority", _PRIORITY),
    "silver_dedup": f"SELECT conversation_id, message_id, status, timestamp, batch_id FROM {_DEDUP}",
    "silver_metadata": f"SELECT DISTINCT conversation_id, message_id, batch_id, coalesce(kind = 'OBJECT', false) AS parsed, {_meta('device')} AS device, {_meta('city')} AS city, {_meta('state')} AS state, {_meta('response_time_sec', 'INT')} AS response_time_sec, {_meta('is_business_hours', 'BOOLEAN')} AS is_business_hours, {_meta('lead_source')} AS lead_source FROM {_JSON.format('bronze')}",
    "silver_name_norm": _sql("name", f"nullif(lower(strip_accents({_strip('sender_name')})), '')"),
    "silver_mask_phone": _sql("masked", f"CASE WHEN length(sender_phone) > 0 THEN CASE WHEN regexp_matches(sender_phone, '{_PHONE}') THEN {_phone_masked('sender_phone')} ELSE regexp_replace(sender_phone, '[0-9]', '*', 'g') END END"),
    "silver_mask_email": _sql("masked", _email_masked("message_body")),
    "silver_mask_body": f"SELECT DISTINCT conversation_id, message_id, batch_id, t6 AS masked FROM {_mask_steps()}",
    "silver_mask_counts": f"SELECT {_mask_sums()} FROM {_mask_steps()}",
    "silver_mask_cpf": _sql("masked", rf"regexp_replace(message_body, '{_CPF}', '***.***.***-**', 'g')"),
    "silver_mask_cep": _sql("masked", rf"regexp_replace(message_body, '{_CEP}', '*****-***', 'g')"),
    "silver_mask_plate": _sql("masked", r"regexp_replace(regexp_replace(message_body, '\b([A-Z]{3})(\d)([A-Z])(\d{2})\b', '***\2\3**', 'g'), '\b[A-Z]{3}-?(\d{2})(\d{2})\b', '***-**\2', 'g')"),
    "silver_has_content": _sql("has_content", _CONTENT),
    "silver_email_domain": _sql("domain", _DOMAIN),
    "silver_has_cpf": _sql("has_cpf", rf"coalesce(regexp_matches(message_body, '{_CPF}'), false)"),
    "silver_cep_prefix": _sql("prefix", r"nullif(regexp_extract(message_body, '\b(\d{5})-?\d{3}\b', 1), '')"),
    "silver_has_phone": _sql("has_phone", rf"coalesce(regexp_matches(message_body, '{_PHONE}'), false)"),
    "silver_plate_format": _sql("format", r"CASE WHEN regexp_matches(message_body, '\b[A-Z]{3}\d[A-Z]\d{2}\b') THEN 'mercosul' WHEN regexp_matches(message_body, '\b[A-Z]{3}-?\d{4}\b') THEN 'old' END"),
    "silver_phone_norm": _sql("digits", _PHONE_DIGITS),
    "silver_lead_id": _sql("lead", _LEAD),
    "silver_audio_confidence": _sql("confidence", _AUDIO),
    "silver_reconcile_name": """WITH votes AS (SELECT lead_id, sender_name_normalized AS name, count(*) AS n FROM silver WHERE lead_id IS NOT NULL AND sender_name_normalized IS NOT NULL GROUP BY ALL),
      winner AS (SELECT lead_id, name FROM votes QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY n DESC, length(name) DESC, name) = 1)
      SELECT conversation_id, message_id, silver_batch_id, lead_id, coalesce(name, sender_name_normalized) AS sender_name_normalized FROM silver LEFT JOIN winner USING (lead_id)""",
    "silver_full": f"SELECT conversation_id, message_id, batch_id AS silver_batch_id, {_LEAD} AS lead_id, {_CONTENT} AS has_content, coalesce(regexp_matches(message_body, '{_CPF}'), false) AS has_cpf, nullif(regexp_extract(message_body, '\\b(\\d{{5}})-?\\d{{3}}\\b', 1), '') AS cep_prefix, {_DOMAIN} AS email_domain, {_AUDIO} AS audio_confidence, status, {_meta('state')} AS state FROM {_JSON.format(_DEDUP)}",
    "schema_conform": "SELECT message_id, conversation_id, CASE WHEN length(message_body) > 20 THEN NULL ELSE length(message_body)::INT END AS veiculo_ano, CASE WHEN direction IN ('inbound', 'outbound') THEN direction END AS direction, CASE WHEN status IN ('delivered', 'read') THEN status END AS status, NULL::BOOLEAN AS sinistro_historico FROM bronze",
    "union_append": "SELECT message_id, conversation_id, status FROM bronze UNION ALL SELECT message_id, conversation_id, status FROM rejected",
    "phrase_hits": f"SELECT DISTINCT conversation_id, message_id, batch_id, {_hits(text.OBJECTIONS)} AS objections, {_hits(text.HAGGLING)} AS haggling, {_hits(text.CLOSING)} AS closing, {_hits(text.EVASIVE)} AS evasive, {_hits(text.TECHNICAL)} AS technical FROM (SELECT *, lower(strip_accents(coalesce(message_body, ''))) AS x FROM bronze)",
    "score_cube": "WITH c AS (SELECT a.x AS c0, b.x AS c1, c.x AS c2, d.x AS c3 FROM (VALUES (0.0::DOUBLE), (0.5), (1.0)) a(x), (VALUES (0.0::DOUBLE), (0.5), (1.0)) b(x), (VALUES (0.0::DOUBLE), (0.5), (1.0)) c(x), (VALUES (0.0::DOUBLE), (0.5), (1.0)) d(x)) SELECT *, round_even(c0 * 40 + c1 * 35 + c2 * 20 + c3 * 5, 0)::INT AS score FROM c",
}


# Manifest and model-lane queries ---------------------------------------------------------------------------------
def batch_pending(spark, d):
    from talkmill.sources.batches import pending

    sources = _bronze(spark, d).select("batch_id").where("batch_id IS NOT NULL").distinct()
    done = table(spark, d, "batches").select("batch_id", F.when(F.col("source_mtime") % 3 == 0, "FAILED").otherwise(F.col("status")).alias("status"))
    return pending(sources, done)


def manifest_latest_run(spark, d):
    """The latest run of each batch by start, then id."""
    runs = table(spark, d, "batches").select(F.substring("batch_id", 1, 1).alias("family"), "batch_id", F.col("started_at").cast("timestamp_ntz").alias("started_at"))
    return runs.groupBy("family").agg(F.max_by("batch_id", F.struct("started_at", "batch_id")).alias("batch_id"), F.max("started_at").alias("started_at"))


def model_cache_key(spark, d):
    from talkmill.operators.model_lane import cache_key

    texts = _bronze(spark, d).select("message_body").where("message_body IS NOT NULL").distinct()
    return texts.select("message_body", cache_key("m1", "system", F.col("message_body"), 256, -0.0).alias("key"))


BUDGET = 500


def model_pending(spark, d):
    """The calls that a budget allows, and how many it leaves out."""
    from talkmill.operators.model_lane import cache_key, within_budget

    texts = model_cache_key(spark, d)
    cached = texts.where("key < '8'").select("key")
    ranked = within_budget(texts.join(cached, "key", "left_anti").select("key"), "key", BUDGET)
    return ranked.groupBy("in_budget").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


def _replied(text: str) -> str:
    """A model's reply that depends on nothing but the text."""
    import json

    return json.dumps({"concorrente_mencionado": f" {text[:6]} ", "veiculo_marca": "", "veiculo_modelo": None, "veiculo_ano": float(1990 + len(text) % 30), "valor_pago_atual_brl": True, "sinistro_historico": len(text) % 2 == 0})


def entity_fill(spark, d):
    """Silver's entity columns after calls within the budget: an answer comes before what was there."""
    from talkmill.operators.model_lane import ENTITIES, cache_key, fill_entities

    rows = table(spark, d, "silver").select("conversation_id", "message_id", "silver_batch_id", "message_body_masked", *ENTITIES)
    key = lambda c: cache_key("m1", "system", c, 256, 0.0)
    filled, _ = fill_entities(rows, _replied, spark.createDataFrame([], "key string, reply string"), key, BUDGET)
    return filled.drop("message_body_masked")


def reply_parse(spark, d):
    """Replies of several forms, parsed: whole ones, ones in a fence, ones that lack a key and ones that aren't JSON."""
    from talkmill.operators.model_lane import ANSWER, ENTITIES, parse_reply

    t = table(spark, d, "silver").select("conversation_id", "message_id", "silver_batch_id", *ENTITIES)
    whole = F.to_json(F.struct(*ENTITIES), {"ignoreNullFields": "false"})
    form = F.pmod(F.coalesce(F.length("message_id"), F.lit(0)) + F.ascii(F.substring("message_id", -1, 1)), F.lit(4))
    made = F.when(form == 0, whole).when(form == 1, F.concat(F.lit("```json\n"), whole, F.lit("\n```"))).when(form == 2, F.to_json(F.struct("veiculo_marca"))).otherwise("no answer")
    replies = t.select("conversation_id", "message_id", "silver_batch_id", made.alias("reply"))

    def run(batches):
        import pandas as pd

        for b in batches:
            parsed = pd.DataFrame([parse_reply(r) for r in b["reply"]], columns=list(ENTITIES), dtype=object)
            yield pd.concat([b.drop(columns="reply").reset_index(drop=True), parsed[[x.split()[0] for x in ANSWER.split(", ")]]], axis=1)

    return replies.mapInPandas(run, f"conversation_id string, message_id string, silver_batch_id string, {ANSWER}")


def closed_sets(spark, d):
    """How many values of each column are outside its closed set, after some were made so."""
    drifted = _bronze(spark, d).withColumn("status", F.when(F.col("status") == "sent", "lost").otherwise(F.col("status"))).withColumn("direction", F.when(F.col("channel").isNull(), "sideways").otherwise(F.col("direction")))
    return drifted.agg(*schemas.out_of_set())


def silver_utc(spark, d):
    """Silver's times, and the columns that wait for a model."""
    valid = s.partition_rows(_bronze(spark, d), AT)[0]
    out = s.silver_transform(valid, SECRET, AT)
    return out.select("conversation_id", "message_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ssXXX").alias("timestamp"), "veiculo_marca", "veiculo_modelo", "veiculo_ano", "concorrente_mencionado", "valor_pago_atual_brl", "sinistro_historico")


def row_accounting(spark, d):
    """What became of the rows of each batch: read, rejected, dropped as copies, written."""
    rows = _bronze(spark, d)
    valid, rejected = s.partition_rows(rows, AT)
    count = lambda df, name: df.groupBy("batch_id").agg(F.count(F.lit(1)).alias(name))
    parts = count(rows, "rows_in").join(count(rejected, "rows_rejected"), "batch_id", "left").join(count(s.dedup_events(valid), "rows_out"), "batch_id", "left")
    parts = parts.select("batch_id", "rows_in", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_rejected", "rows_out")])
    return parts.withColumn("rows_deduped", F.col("rows_in") - F.col("rows_rejected") - F.col("rows_out"))


def timing_summary(spark, d):
    """The statistics of the timing records, over the response times of each channel."""
    from talkmill.control.events import summary

    t = table(spark, d, "silver").where("channel IS NOT NULL").select(F.col("channel").alias("scenario"), F.col("metadata.response_time_sec").cast("double").alias("ms"))
    out = summary(t)
    return out.select("scenario", "n", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


QUERIES |= {f.__name__: f for f in (batch_pending, manifest_latest_run, model_cache_key, model_pending, entity_fill, reply_parse, closed_sets, silver_utc, row_accounting, timing_summary)}
QUERIES["body_fingerprint"] = _column("fingerprint", _body(masking.fingerprint))
_KEY = "sha256('model=m1' || chr(10) || 'system=system' || chr(10) || 'user=' || message_body || chr(10) || 'max_tokens=256' || chr(10) || 'temperature=0.000000')"
SQL |= {
    "batch_pending": "SELECT DISTINCT batch_id FROM bronze WHERE batch_id IS NOT NULL AND batch_id NOT IN (SELECT batch_id FROM batches WHERE CASE WHEN source_mtime % 3 = 0 THEN 'FAILED' ELSE status END = 'COMPLETED')",
    "manifest_latest_run": "SELECT family, batch_id, started_at FROM (SELECT substr(batch_id, 1, 1) AS family, batch_id, started_at AT TIME ZONE 'UTC' AS started_at FROM batches) QUALIFY row_number() OVER (PARTITION BY family ORDER BY started_at DESC, batch_id DESC) = 1",
    "model_cache_key": f"SELECT DISTINCT message_body, {_KEY} AS key FROM bronze WHERE message_body IS NOT NULL",
    "model_pending": f"SELECT n <= {BUDGET} AS in_budget, count(*) AS n, min(key) AS first_key, max(key) AS last_key FROM (SELECT key, row_number() OVER (ORDER BY key) AS n FROM (SELECT DISTINCT {_KEY} AS key FROM bronze WHERE message_body IS NOT NULL) WHERE key >= '8') GROUP BY ALL",
    "entity_fill": f"""WITH asked AS (SELECT message_body, row_number() OVER (ORDER BY {_KEY}) AS n FROM (SELECT DISTINCT message_body_masked AS message_body FROM silver WHERE length({_strip('message_body_masked')}) > 0)),
        answers AS (SELECT message_body AS message_body_masked, nullif({_strip("substr(message_body, 1, 6)")}, '') AS competitor, 1990 + length(message_body) % 30 AS year, length(message_body) % 2 = 0 AS claim FROM asked WHERE n <= {BUDGET})
      SELECT conversation_id, message_id, silver_batch_id, coalesce(competitor, concorrente_mencionado) AS concorrente_mencionado, veiculo_marca, veiculo_modelo, coalesce(year, veiculo_ano)::INT AS veiculo_ano, valor_pago_atual_brl, coalesce(claim, sinistro_historico) AS sinistro_historico
      FROM silver LEFT JOIN answers USING (message_body_masked)""",
    "reply_parse": f"""WITH t AS (SELECT *, (coalesce(length(message_id), 0) + ascii(right(message_id, 1))) % 4 IN (0, 1) AS whole FROM silver)
      SELECT conversation_id, message_id, silver_batch_id, {', '.join(f"CASE WHEN whole THEN nullif({_strip(c)}, '') END AS {c}" for c in ("veiculo_marca", "veiculo_modelo", "concorrente_mencionado"))},
        {', '.join(f"CASE WHEN whole THEN {c} END AS {c}" for c in ("veiculo_ano", "valor_pago_atual_brl", "sinistro_historico"))} FROM t""",
    "closed_sets": "SELECT count(*) FILTER (WHERE channel IS NULL OR direction NOT IN ('inbound', 'outbound')) AS drift_direction, count(*) FILTER (WHERE message_type NOT IN ('audio', 'contact', 'document', 'image', 'location', 'sticker', 'text', 'video')) AS drift_message_type, count(*) FILTER (WHERE status NOT IN ('read', 'delivered')) AS drift_status FROM bronze",
    "silver_utc": f"SELECT conversation_id, message_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') || 'Z' AS timestamp, NULL::VARCHAR AS veiculo_marca, NULL::VARCHAR AS veiculo_modelo, NULL::INT AS veiculo_ano, NULL::VARCHAR AS concorrente_mencionado, NULL::DOUBLE AS valor_pago_atual_brl, NULL::BOOLEAN AS sinistro_historico FROM {_DEDUP}",
    "row_accounting": f"""SELECT batch_id, rows_in, coalesce(rows_rejected, 0) AS rows_rejected, coalesce(rows_out, 0) AS rows_out, rows_in - coalesce(rows_rejected, 0) - coalesce(rows_out, 0) AS rows_deduped
      FROM (SELECT batch_id, count(*) AS rows_in, count(*) FILTER (WHERE message_id IS NULL OR conversation_id IS NULL) AS rows_rejected FROM bronze GROUP BY batch_id) LEFT JOIN (SELECT batch_id, count(*) AS rows_out FROM {_DEDUP} GROUP BY batch_id) USING (batch_id)""",
    "timing_summary": "SELECT channel AS scenario, count(ms) AS n, min(ms) AS min_ms, max(ms) AS max_ms, round(avg(ms), 6) AS mean_ms, round(stddev_samp(ms), 6) AS stddev_ms, round(quantile_cont(ms, 0.5), 6) AS p50_ms, round(quantile_cont(ms, 0.95), 6) AS p95_ms FROM (SELECT channel, metadata.response_time_sec::DOUBLE AS ms FROM silver) WHERE channel IS NOT NULL GROUP BY channel",
    "body_fingerprint": _sql("fingerprint", "substr(sha256(message_body), 1, 16)"),
}
