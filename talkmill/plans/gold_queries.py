"""Queries for the analytic tables and insights, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill import schemas
from talkmill.functions import text
from talkmill.operators import gold as g
from talkmill.sources.tables import table


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "silver")


def _local(df: DataFrame) -> DataFrame:
    """Times without zone (UTC) and doubles rounded where sums depend on the order of their parts."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.simpleString() == "timestamp" else F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema])


def conv_pair_deltas(spark, d):
    return g.pair_deltas(_silver(spark, d)).where("response_sec IS NOT NULL").select("conversation_id", "message_id", "silver_batch_id", "response_sec")


def gold_conversation_scores(spark, d):
    return _local(schemas.assert_schema(g.conversation_scores(_silver(spark, d)), schemas.CONVERSATION_SCORES, "conversation_scores"))


def gold_lead_profile(spark, d):
    return _local(g.lead_profile(_silver(spark, d)))


def label_counts(spark, d):
    return g.label_counts(_silver(spark, d), ("plate_format", "audio_confidence"))


def gold_lead_aggregate(spark, d):
    return _local(g.lead_aggregate(_silver(spark, d)))


def gold_response_means(spark, d):
    return _local(g.response_means(_silver(spark, d)))


CATALOGUES = {"haggling": text.HAGGLING, "closing": text.CLOSING, "evasive": text.EVASIVE, "technical": text.TECHNICAL}


def gold_phrase_counts(spark, d):
    return g.phrase_counts(_silver(spark, d), CATALOGUES)


def gold_prompt_text(spark, d):
    return g.prompt_texts(_silver(spark, d))


def _labels(silver: DataFrame) -> DataFrame:
    """A label per lead for the matrix and agent queries: by what the lead wrote most of."""
    return silver.where("lead_id IS NOT NULL").groupBy("lead_id").agg(F.count_if(F.col("direction") == "inbound").alias("i"), F.count(F.lit(1)).alias("n")).select("lead_id", F.when(F.col("i") * 2 > F.col("n"), "asks").when(F.col("i") > 2, "listens").otherwise("silent").alias("persona"))


def gold_agent_performance(spark, d):
    t = _silver(spark, d)
    out = g.agent_performance(t, _labels(t))
    return _local(out.withColumn("outcome_mix", F.array_join(F.transform("outcome_mix", lambda e: F.concat(e["outcome"], F.lit(":"), e["count"].cast("string"))), ",")))


def gold_competitor_intel(spark, d):
    return _local(g.competitor_intel(_silver(spark, d)).withColumn("top_states", F.array_join("top_states", ",")))


def batch_anchor(spark, d):
    return _local(g.anchor(_silver(spark, d)))


def insight_ghosting(spark, d):
    return _local(g.ghosting(_silver(spark, d)))


def insight_objections(spark, d):
    return _local(g.objections(_silver(spark, d)))


def insight_disengagement(spark, d):
    return g.disengagement(_silver(spark, d))


def insight_label_outcome(spark, d):
    t = _silver(spark, d)
    return _local(g.label_outcomes(t, _labels(t)))


def insight_top_surprise(spark, d):
    t = _silver(spark, d)
    return _local(g.top_surprise(g.label_outcomes(t, _labels(t))))


QUERIES = {f.__name__: f for f in (conv_pair_deltas, gold_conversation_scores, gold_lead_profile, label_counts, gold_lead_aggregate, gold_response_means, gold_phrase_counts, gold_prompt_text, gold_agent_performance, gold_competitor_intel, batch_anchor, insight_ghosting, insight_objections, insight_disengagement, insight_label_outcome, insight_top_surprise)}

# SQL -----------------------------------------------------------------------------------------------------------
_S = "(SELECT *, timestamp AT TIME ZONE 'UTC' AS ts, coalesce(timestamp AT TIME ZONE 'UTC', TIMESTAMP '1900-01-01') AS o1, coalesce(message_id, '') AS o2, coalesce(silver_batch_id, '') AS o3 FROM silver)"
_O = "ORDER BY o1, o2, o3"
_LAST = f"last(conversation_outcome {_O}) FILTER (WHERE conversation_outcome IS NOT NULL)"
_DELTAS = f"""(SELECT *, CASE WHEN direction = 'inbound' AND lag(direction) OVER w = 'outbound' THEN date_sub('second', lag(ts) OVER w, ts) END::DOUBLE AS response_sec
  FROM {_S} WINDOW w AS (PARTITION BY conversation_id {_O}))"""
_HIT = "contains(lower(strip_accents(coalesce(message_body_masked, ''))), '{}')"


def _mode(key: str, column: str, name: str, source: str = _S) -> str:
    """CTE body: the most frequent non-null value per key, the lowest on ties."""
    return f"SELECT {key}, {column} AS {name} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {column}) = 1"


def _modes(key: str, columns: dict[str, str]) -> tuple[str, str]:
    ctes = ", ".join(f"m_{n} AS ({_mode(key, c, n)})" for n, c in columns.items())
    joins = " ".join(f"LEFT JOIN m_{n} ON m_{n}.{key} IS NOT DISTINCT FROM base.{key}" for n in columns)
    return ctes, joins


_CM, _CJ = _modes("conversation_id", {"concorrente_citado": "concorrente_mencionado", "veiculo_marca": "veiculo_marca", "veiculo_modelo": "veiculo_modelo", "veiculo_ano": "veiculo_ano"})
_LM, _LJ = _modes("lead_id", {"sender_name_normalized": "sender_name_normalized", "dominant_email_domain": "email_domain", "dominant_state": "metadata.state", "dominant_city": "metadata.city"})
_PER_LEAD = f"(SELECT lead_id, conversation_id, {_LAST} AS outcome, max((o1, o2, o3)) AS last_at FROM {_S} WHERE lead_id IS NOT NULL GROUP BY ALL)"
_LABELS = "(SELECT lead_id, CASE WHEN count(*) FILTER (WHERE direction = 'inbound') * 2 > count(*) THEN 'asks' WHEN count(*) FILTER (WHERE direction = 'inbound') > 2 THEN 'listens' ELSE 'silent' END AS persona FROM silver WHERE lead_id IS NOT NULL GROUP BY lead_id)"
_MATRIX = f"(SELECT persona AS label, outcome, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY persona) AS rate FROM {_PER_LEAD} JOIN {_LABELS} USING (lead_id) WHERE outcome IS NOT NULL GROUP BY persona, outcome)"


def _flags(name: str, phrases: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"max((direction IS NOT DISTINCT FROM 'inbound' AND {_HIT.format(text.fold(p))})::INT)" for p in phrases) + f") AS {name}"


def _any(phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(x, '{text.fold(p)}')" for p in phrases) + ")"


_TOPIC = f"CASE WHEN {_any(text.QUOTED)} THEN 'after first quote' WHEN {_any(text.PRICE_ASKED)} THEN 'after price ask' WHEN {_any(text.DATA_ASKED)} THEN 'after personal data ask' ELSE 'other' END"
SQL = {
    "conv_pair_deltas": f"SELECT conversation_id, message_id, silver_batch_id, response_sec FROM {_DELTAS} WHERE response_sec IS NOT NULL",
    "gold_conversation_scores": f"""WITH base AS (SELECT conversation_id, first(lead_id {_O}) AS lead_id, first(campaign_id {_O}) AS campaign_id, first(agent_id {_O}) AS agent_id,
        count(*) FILTER (WHERE direction = 'inbound')::INT AS msgs_inbound, count(*) FILTER (WHERE direction = 'outbound')::INT AS msgs_outbound, min(ts) AS first_message_at, max(ts) AS last_message_at,
        date_sub('second', min(ts), max(ts)) AS duration_sec, round(avg(response_sec), 6) AS avg_lead_response_sec, first(response_sec {_O}) FILTER (WHERE response_sec IS NOT NULL) AS time_to_first_response_sec,
        count(*) FILTER (WHERE metadata.is_business_hours = false)::INT AS off_hours_msgs, count(concorrente_mencionado) > 0 AS mencionou_concorrente,
        max(valor_pago_atual_brl) AS valor_pago_atual_brl, bool_or(sinistro_historico) AS sinistro_historico, {_LAST} AS conversation_outcome FROM {_DELTAS} GROUP BY conversation_id), {_CM}
      SELECT base.*, concorrente_citado, veiculo_marca, veiculo_modelo, veiculo_ano FROM base {_CJ}""",
    "gold_lead_profile": f"""WITH base AS (SELECT lead_id, count(*)::INT AS conversations, count(*) FILTER (WHERE outcome = 'venda_fechada')::INT AS closed_count FROM {_PER_LEAD} GROUP BY lead_id),
        times AS (SELECT lead_id, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM {_S} GROUP BY lead_id), {_LM}
      SELECT base.*, round(closed_count / conversations, 6) AS close_rate, sender_name_normalized, dominant_email_domain, dominant_state, dominant_city, NULL::VARCHAR AS engagement_profile, NULL::VARCHAR AS persona, NULL::DOUBLE AS persona_confidence, NULL::VARCHAR AS sentiment, NULL::DOUBLE AS sentiment_confidence, NULL::VARCHAR AS price_sensitivity, NULL::INT AS intent_score, first_seen_at, last_seen_at FROM base JOIN times USING (lead_id) {_LJ}""",
    "label_counts": "SELECT 'plate_format' AS label, plate_format AS value, count(*) AS count FROM silver GROUP BY ALL UNION ALL SELECT 'audio_confidence', audio_confidence, count(*) FROM silver GROUP BY ALL",
    "gold_lead_aggregate": f"""WITH c AS (SELECT lead_id, count(*) AS num_msgs, count(*) FILTER (WHERE direction = 'inbound') AS num_msgs_inbound, count(*) FILTER (WHERE direction = 'outbound') AS num_msgs_outbound,
        count(*) FILTER (WHERE metadata.is_business_hours = false) AS off_hours_msgs, count(concorrente_mencionado) > 0 AS mencionou_concorrente, count(DISTINCT nullif(lower(trim(concorrente_mencionado)), '')) AS competitor_count,
        coalesce(bool_or(has_cpf OR email_domain IS NOT NULL OR has_phone_mention), false) AS forneceu_dado_pessoal, max(ts) AS last_message_at, {_LAST} AS row_outcome FROM {_S} WHERE lead_id IS NOT NULL GROUP BY lead_id),
        p AS (SELECT lead_id, last(outcome ORDER BY last_at, conversation_id) FILTER (WHERE outcome IS NOT NULL) AS outcome FROM {_PER_LEAD} GROUP BY lead_id)
      SELECT c.*, outcome FROM c JOIN p USING (lead_id)""",
    "gold_response_means": f"SELECT lead_id, round(avg(m), 6) AS avg_lead_response_sec FROM (SELECT conversation_id, first(lead_id {_O}) AS lead_id, avg(response_sec) AS m FROM {_DELTAS} GROUP BY conversation_id) WHERE lead_id IS NOT NULL GROUP BY lead_id",
    "gold_phrase_counts": f"SELECT lead_id, {', '.join(_flags(n, p) for n, p in CATALOGUES.items())} FROM silver WHERE lead_id IS NOT NULL GROUP BY lead_id",
    "gold_prompt_text": f"""WITH r AS (SELECT lead_id, message_body_masked AS x, o1, o2, o3 FROM {_S} WHERE lead_id IS NOT NULL AND direction = 'inbound' AND message_body_masked IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY o1 DESC, o2 DESC, o3 DESC) <= 20),
        t AS (SELECT lead_id, substr(string_agg(x, chr(10) {_O}), 1, 2000) AS prompt_text FROM r GROUP BY lead_id)
      SELECT l.lead_id, coalesce(prompt_text, '') AS prompt_text FROM (SELECT DISTINCT lead_id FROM silver WHERE lead_id IS NOT NULL) l LEFT JOIN t USING (lead_id)""",
    "gold_agent_performance": f"""WITH per AS (SELECT agent_id, conversation_id, {_LAST} AS outcome, first(lead_id {_O}) AS lead_id FROM {_S} GROUP BY agent_id, conversation_id),
        base AS (SELECT agent_id, count(*)::INT AS conversations, count(*) FILTER (WHERE outcome = 'venda_fechada')::INT AS closed_count FROM per GROUP BY agent_id),
        answer AS (SELECT agent_id, round(avg(metadata.response_time_sec) FILTER (WHERE direction = 'outbound'), 6) AS avg_response_time_sec FROM silver GROUP BY agent_id),
        mix AS (SELECT agent_id, string_agg(outcome || ':' || n, ',' ORDER BY outcome) AS outcome_mix FROM (SELECT agent_id, outcome, count(*) AS n FROM per WHERE outcome IS NOT NULL GROUP BY ALL) GROUP BY agent_id),
        rated AS (SELECT agent_id, persona, count(*) FILTER (WHERE outcome = 'venda_fechada') AS k, count(*) AS n FROM per JOIN {_LABELS} USING (lead_id) GROUP BY ALL),
        top AS (SELECT agent_id, persona FROM rated QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY k / n DESC, k DESC, persona) = 1)
      SELECT base.*, round(closed_count / conversations, 6) AS close_rate, avg_response_time_sec, coalesce(mix.outcome_mix, '') AS outcome_mix, CASE WHEN closed_count > 0 THEN persona END AS top_persona_converted
      FROM base LEFT JOIN answer ON base.agent_id IS NOT DISTINCT FROM answer.agent_id LEFT JOIN mix ON base.agent_id = mix.agent_id LEFT JOIN top ON base.agent_id = top.agent_id""",
    "gold_competitor_intel": f"""WITH said AS (SELECT *, lower(trim(concorrente_mencionado)) AS competitor FROM {_S} WHERE concorrente_mencionado IS NOT NULL),
        base AS (SELECT competitor, count(*)::INT AS mention_count, round(avg(valor_pago_atual_brl), 6) AS avg_quoted_price_brl FROM said GROUP BY competitor),
        per AS (SELECT competitor, conversation_id, {_LAST} AS outcome FROM said GROUP BY ALL),
        loss AS (SELECT competitor, round(count(*) FILTER (WHERE outcome <> 'venda_fechada') / count(*), 6) AS loss_rate FROM per WHERE outcome IS NOT NULL GROUP BY competitor),
        states AS (SELECT competitor, state, n FROM (SELECT competitor, metadata.state AS state, count(*) AS n FROM said WHERE metadata.state IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY competitor ORDER BY n DESC, state) <= 3),
        best AS (SELECT competitor, string_agg(state, ',' ORDER BY n DESC, state) AS top_states FROM states GROUP BY competitor)
      SELECT base.*, loss_rate, coalesce(top_states, '') AS top_states FROM base LEFT JOIN loss USING (competitor) LEFT JOIN best USING (competitor)""",
    "batch_anchor": "SELECT coalesce(max(timestamp AT TIME ZONE 'UTC'), TIMESTAMP '1970-01-01') AS anchor FROM silver",
    "insight_ghosting": """WITH l AS (SELECT lead_id, count(*) AS n, count(conversation_outcome) AS known FROM silver GROUP BY lead_id),
        c AS (SELECT CASE WHEN n <= 2 THEN '1-2' WHEN n <= 4 THEN '3-4' WHEN n <= 9 THEN '5-9' ELSE '10+' END AS bucket, count(*) AS k FROM l WHERE known = 0 GROUP BY ALL)
      SELECT b.bucket, coalesce(k, 0) AS count, round(coalesce(k, 0) / (SELECT count(*) FROM l), 6) AS rate FROM (VALUES ('1-2'), ('3-4'), ('5-9'), ('10+')) b(bucket) LEFT JOIN c USING (bucket)""",
    "insight_objections": f"""WITH own AS (SELECT *, lower(strip_accents(coalesce(message_body_masked, ''))) AS x FROM {_S} WHERE direction = 'inbound' AND lead_id IS NOT NULL),
        o AS (SELECT lead_id, {_LAST} AS outcome FROM own GROUP BY lead_id),
        h AS (SELECT DISTINCT p.phrase, own.lead_id FROM (VALUES {', '.join(f"('{p}', '{text.fold(p)}')" for p in text.OBJECTIONS)}) p(phrase, plain) JOIN own ON contains(x, plain)),
        c AS (SELECT phrase, count(*) AS n, count(*) FILTER (WHERE outcome = 'venda_fechada') AS k FROM h JOIN o USING (lead_id) GROUP BY phrase)
      SELECT p.phrase, coalesce(n, 0) AS count, round(k / n, 6) AS close_rate FROM (VALUES {', '.join(f"('{p}')" for p in text.OBJECTIONS)}) p(phrase) LEFT JOIN c USING (phrase)""",
    "insight_disengagement": f"""WITH r AS (SELECT conversation_id, count(*) AS n, last(conversation_outcome {_O}) AS outcome, last(lower(strip_accents(coalesce(message_body_masked, ''))) {_O}) AS x FROM {_S} WHERE direction = 'outbound' GROUP BY conversation_id),
        c AS (SELECT CASE WHEN n <= 1 THEN 'first' WHEN n <= 3 THEN '2nd-3rd' ELSE '4th+' END AS turn, {_TOPIC} AS topic, count(*) AS k FROM r WHERE outcome IS NULL GROUP BY ALL)
      SELECT t.turn, p.topic, coalesce(k, 0) AS count FROM (VALUES ('first'), ('2nd-3rd'), ('4th+')) t(turn) CROSS JOIN (VALUES ('after first quote'), ('after price ask'), ('after personal data ask'), ('other')) p(topic) LEFT JOIN c USING (turn, topic)""",
    "insight_label_outcome": f"SELECT label, outcome, count, round(rate, 6) AS rate FROM {_MATRIX}",
    "insight_top_surprise": f"""WITH m AS (SELECT * FROM {_MATRIX}), o AS (SELECT sum(count) FILTER (WHERE outcome = 'venda_fechada') / sum(count) AS overall FROM m)
      SELECT label, outcome, round(rate, 6) AS rate, round(round(rate - overall, 9), 6) AS delta FROM m, o WHERE outcome = 'venda_fechada' ORDER BY abs(round(rate - overall, 9)) DESC, label LIMIT 1""",
}
