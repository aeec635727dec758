from datetime import datetime, timedelta

from pyspark.sql import functions as F

from talkmill import schemas
from talkmill.operators import gold

START = datetime(2025, 5, 1, 10)


def silver(spark, rows):
    made = []
    for i, r in enumerate(rows):
        base = dict.fromkeys(schemas.SILVER.fieldNames()) | {"message_id": f"m{i}", "conversation_id": "c", "lead_id": "L", "agent_id": "A", "direction": "inbound", "silver_batch_id": "b", "has_cpf": False, "has_phone_mention": False, "timestamp": START + timedelta(seconds=i * 10)}
        made.append(tuple((base | r).values()))
    return spark.createDataFrame(made, schemas.SILVER)


def test_empty_tables_keep_their_schema(spark):
    t = silver(spark, [])
    for build, shape in ((gold.conversation_scores, schemas.CONVERSATION_SCORES), (gold.lead_profile, schemas.LEAD_PROFILE), (gold.agent_performance, schemas.AGENT_PERFORMANCE), (gold.competitor_intel, schemas.COMPETITOR_INTEL)):
        out = build(t)
        assert schemas.differences(out.schema, shape) == [] and out.count() == 0
    assert gold.ghosting(t).count() == 4 and gold.disengagement(t).count() == 12 and gold.objections(t).count() == 5
    assert gold.anchor(t).first()["anchor"] == datetime(1970, 1, 1)


def test_scores_of_a_conversation(spark):
    t = silver(spark, [
        {"direction": "outbound", "lead_id": None},
        {"direction": "inbound", "concorrente_mencionado": "b", "sinistro_historico": False},
        {"direction": "inbound", "concorrente_mencionado": "a", "conversation_outcome": "x"},
        {"direction": "outbound", "valor_pago_atual_brl": 5.0},
        {"direction": "inbound", "timestamp": START + timedelta(seconds=35, milliseconds=900), "sinistro_historico": True, "metadata": ("d", None, "SP", None, False, None)},
        {"conversation_id": "d", "direction": "outbound"},
    ])
    r = {x["conversation_id"]: x for x in gold.conversation_scores(t).collect()}
    c = r["c"]
    assert c["lead_id"] is None and c["msgs_inbound"] == 3 and c["msgs_outbound"] == 2
    assert c["time_to_first_response_sec"] == 10.0 and c["avg_lead_response_sec"] == 7.5
    assert c["concorrente_citado"] == "a" and c["sinistro_historico"] is True and c["conversation_outcome"] == "x" and c["off_hours_msgs"] == 1 and c["duration_sec"] == 35
    assert r["d"]["avg_lead_response_sec"] is None and r["d"]["sinistro_historico"] is None and r["d"]["mencionou_concorrente"] is False


def test_one_exchange_for_window_and_aggregate(spark):
    plan = gold.conversation_scores(silver(spark, [{}]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_agents(spark):
    t = silver(spark, [{"conversation_outcome": "venda_fechada"}, {"conversation_id": "d", "conversation_outcome": "novo_valor", "lead_id": "M"}, {"conversation_id": "e", "lead_id": "N", "agent_id": None}, {"conversation_id": "d", "direction": "outbound", "metadata": (None, None, None, 30, None, None)}])
    personas = spark.createDataFrame([("L", "p"), ("M", "q"), ("N", None)], "lead_id string, persona string")
    r = {x["agent_id"]: x for x in gold.agent_performance(t, personas).collect()}
    assert r["A"]["conversations"] == 2 and r["A"]["close_rate"] == 0.5 and r["A"]["top_persona_converted"] == "p" and r["A"]["avg_response_time_sec"] == 30
    assert [(m["outcome"], m["count"]) for m in r["A"]["outcome_mix"]] == [("novo_valor", 1), ("venda_fechada", 1)]
    assert r[None]["outcome_mix"] == [] and r[None]["top_persona_converted"] is None


def test_competitors(spark):
    said = {"concorrente_mencionado": " Azul "}
    t = silver(spark, [said | {"conversation_outcome": "lost"}, said | {"conversation_outcome": "lost"}, said | {"conversation_id": "d", "conversation_outcome": "venda_fechada", "metadata": (None, None, "RJ", None, None, None)}, {"conversation_outcome": "venda_fechada"}])
    r = gold.competitor_intel(t).first()
    assert (r["competitor"], r["mention_count"], r["loss_rate"], r["top_states"]) == ("azul", 3, 0.5, ["RJ"])


def test_prompt_text_takes_the_last_messages_in_order(spark):
    t = silver(spark, [{"message_body_masked": f"t{i:02d}"} for i in range(25)] + [{"lead_id": "Q", "direction": "outbound", "message_body_masked": "x"}])
    r = {x["lead_id"]: x["prompt_text"] for x in gold.prompt_texts(t).collect()}
    assert r["L"].split("\n") == [f"t{i:02d}" for i in range(5, 25)] and r["Q"] == ""
    assert len(gold.prompt_texts(t, chars=7).where("lead_id = 'L'").first()["prompt_text"]) == 7


def test_results_do_not_depend_on_partitions(spark):
    rows = [{"lead_id": f"L{i % 5}", "conversation_id": f"c{i % 11}", "conversation_outcome": ["x", "y", None][i % 3], "timestamp": START, "direction": ["inbound", "outbound"][i % 2]} for i in range(60)]
    t = silver(spark, rows)
    a = sorted(map(str, gold.conversation_scores(t.repartition(7)).collect()))
    b = sorted(map(str, gold.conversation_scores(t.orderBy(F.desc("message_id")).coalesce(1)).collect()))
    assert a == b
