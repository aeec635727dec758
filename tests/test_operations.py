import json
import random

import pytest

from talkmill.control import client, events, loop, overrides
from talkmill.control.state import Manifest
from talkmill.operators.model_lane import cache_key
from talkmill.sources import batches, sinks
from tests import faults
from tests.test_control import place, raw  # noqa: F401


def test_override_store(spark, tmp_path):
    at = str(tmp_path / "o/overrides.json")
    assert overrides.load(at) == {} and overrides.pattern(at, "b", "cpf", "x") == "x"
    good = lambda old, failing: r"\d{3}[.]?\d{3}[.]?\d{3}-?\d{2}"
    old = r"\d{3}\.\d{3}\.\d{3}-\d{2}"
    new = overrides.regenerate(spark, at, "b", "cpf", old, ["123.456.789-01", "nada"], ["12345678901"], good)
    assert overrides.pattern(at, "b", "cpf", old) == new and overrides.pattern(at, "other", "cpf", old) == old
    for bad in ("(", "", "nada", r"(?P<x>\d)", "z" * 2000):
        with pytest.raises(ValueError):
            overrides.regenerate(spark, at, "b", "cpf", old, ["123.456.789-01", "nada"], ["12345678901"], lambda *_: bad)
    assert overrides.pattern(at, "b", "cpf", old) == new
    (tmp_path / "o/overrides.json").write_text("[")
    assert overrides.load(at) == {}


def test_events_hide_secrets(tmp_path):
    at = str(tmp_path / "e.jsonl")
    events.emit(at, "escalated", api_key="abc", note="uses sk-abcdefghijk now", inner={"auth_token": "t", "n": [1, "Bearer xyz"]})
    line = json.loads((tmp_path / "e.jsonl").read_text())
    assert line["api_key"] == "***" and "sk-" not in line["note"] and line["inner"] == {"auth_token": "***", "n": [1, "***"]}
    with pytest.raises(ValueError):
        events.emit(at, "other")


def test_timings(spark, tmp_path):
    at = str(tmp_path / "t.jsonl")
    with events.timed(at, "a", 10):
        pass
    with pytest.raises(KeyError), events.timed(at, "a"):
        raise KeyError
    assert [json.loads(x)["ok"] for x in open(at)] == [True, False]
    t = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)] + [("b", 9.0)], "scenario string, ms double")
    r = {x["scenario"]: x for x in events.summary(t).collect()}
    assert r["a"]["p50_ms"] == 2.5 and abs(r["a"]["p95_ms"] - 3.85) < 1e-9 and r["b"]["n"] == 1
    assert events.over_limit(events.summary(t), {"a": 2.0, "b": 10.0}) == ["a"]


def test_client(spark, tmp_path):
    m = Manifest(str(tmp_path / "m.db"))
    tries, paused = [], []

    def send(model, *request):
        tries.append(model)
        if model == "first":
            raise client.Transient
        return "answer"

    c = client.Client(send, m, "first", "second", sleep=paused.append, jitter=random.Random(1))
    assert c.ask("s", "u") == "answer" and tries == ["first"] * 3 + ["second"] and [int(p) for p in paused] == [1, 2]
    assert c.ask("s", "u") == "answer" and c.hits == 1 and len(tries) == 4
    alone = client.Client(send, m, "first", sleep=paused.append)
    with pytest.raises(client.Exhausted):
        alone.ask("s", "other")
    with pytest.raises(client.BadReply):
        client.Client(lambda *_: " ", m, "first").ask("s", "blank")
    assert c.pause(20) <= 33
    df = spark.createDataFrame([("u",)], "u string")
    assert df.select(cache_key("first", "s", df["u"], 256, -0.0).alias("k")).first()["k"] == client.request_key("first", "s", "u", 256, 0.0)
    m.close()


def test_faults(spark, place):  # noqa: F811
    settings, manifest, drop = place
    src = f"{settings.source}/a.parquet"
    faults.add_column(src)
    faults.odd_body(src)
    assert loop.run_once(spark, settings, manifest).failures == 0
    faults.append_row(src, message_id=None)
    assert loop.run_once(spark, settings, manifest).failures == 0
    newest = max(batches.discover(settings.source)).batch_id
    assert sinks.rejected_count(spark, settings.table("silver_rejected"), newest) == 1
    faults.append_row(src, timestamp="2025-99-99 00:00:00")
    assert loop.run_once(spark, settings, manifest).escalated[0][2] == "schema_drift"
    drop("a.parquet", raw(spark))
    faults.truncate(src)
    assert loop.run_once(spark, settings, manifest).escalated[0][2] in ("corrupt_file", "unknown")


def answer(model, system, text, max_tokens, temperature):
    return json.dumps({"concorrente_mencionado": text[:5], "veiculo_marca": None, "veiculo_modelo": None, "veiculo_ano": 2011, "valor_pago_atual_brl": None, "sinistro_historico": None})


def test_model_fills_silver_within_its_budget_and_asks_once(spark, place):  # noqa: F811
    settings, manifest, _ = place
    settings.model = client.Calls(answer, "m", "s", budget=4)
    assert loop.run_once(spark, settings, manifest).failures == 0
    silver = spark.read.parquet(settings.table("silver"))
    assert silver.where("veiculo_ano = 2011").count() == 4 and spark.read.parquet(settings.table("model_replies")).count() == 4
    batch = batches.discover(settings.source)[0].batch_id
    manifest.invalidate(batch, "silver", "again")
    loop.run_once(spark, settings, manifest)
    assert spark.read.parquet(settings.table("silver")).where("veiculo_ano = 2011").count() == 6
    run = manifest.latest_run(batch, "silver")
    assert (run["rows_in"], run["rows_rejected"], run["rows_deduped"], run["rows_out"]) == (6, 0, 0, 6) and run["output_path"].endswith(batch)
    names = [json.loads(x)["event"] for x in open(settings.events)]
    assert names[0] == "loop_started" and {"layer_started", "layer_completed", "loop_finished"} <= set(names)
    summary = json.loads(open(f"{settings.table('gold/insights')}/batch_id={batch}/summary.json").read())
    assert {"ghosting_taxonomy", "objections", "disengagement_moment", "label_outcome", "top_surprise", "generated_at", "batch_id"} == set(summary)


def test_overrides_reach_the_masks(spark, place):  # noqa: F811
    settings, manifest, drop = place
    drop("a.parquet", raw(spark, message_body="doc 12345678901"))
    batch = batches.discover(settings.source)[0].batch_id
    overrides.save(settings.overrides, batch, "cpf", r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b")
    loop.run_once(spark, settings, manifest)
    got = spark.read.parquet(settings.table("silver")).select("message_body_masked", "has_cpf").distinct().collect()
    assert [tuple(r) for r in got] == [("doc ***.***.***-**", True)]


def test_rejected_rows_beyond_the_limit_are_acknowledged_once(spark, place):  # noqa: F811
    settings, manifest, drop = place
    settings.most_rejected = 0.1
    path = f"{settings.source}/a.parquet"
    for i in range(3):
        faults.append_row(path, message_id=None, agent_id=f"x{i}")
    done = loop.run_once(spark, settings, manifest)
    assert done.failures == 0
    fixes = [(r["kind"], r["fix"]) for r in manifest.view(spark, "failures").collect()]
    assert fixes == [("out_of_range", "acknowledged 3 rejected rows")]


def test_broken_pattern_is_replaced_or_escalated(spark, place, monkeypatch):  # noqa: F811
    from talkmill.control import layers

    settings, manifest, _ = place
    settings.propose = lambda old, failing: r"\d{3}[. ]?\d{3}[. ]?\d{3}-?\d{2}"
    real = layers.RUNNERS["silver"]

    def silver(spark, settings, manifest, batch):
        if "cpf" not in overrides.load(settings.overrides).get(batch.batch_id, {}):
            raise overrides.PatternBroken("cpf", ["123 456 789-01"])
        return real(spark, settings, manifest, batch)

    monkeypatch.setitem(layers.RUNNERS, "silver", silver)
    assert loop.run_once(spark, settings, manifest).failures == 0
    settings.propose = None
    (__import__("pathlib").Path(settings.overrides)).unlink()
    manifest.invalidate(batches.discover(settings.source)[0].batch_id, "silver", "again")
    done = loop.run_once(spark, settings, manifest)
    assert done.escalated[0][1:] == ("silver", "regex_break")
    line = json.loads(open(f"{settings.control}/escalations.jsonl").readlines()[-1])
    assert line["suggested"] == loop.SUGGESTED["regex_break"] and "PatternBroken" in line["error"]


def test_unknown_failures_are_asked_about_within_a_budget(spark, place, monkeypatch):  # noqa: F811
    from talkmill.control import layers

    settings, manifest, drop = place
    drop("b.parquet", raw(spark, 3))
    asked = []
    settings.ask_kind, settings.diagnoses = lambda layer, text: asked.append(text) or "corrupt_file", 1

    def broken(*_):
        raise RuntimeError("strange sk-abcdefghijk")

    monkeypatch.setitem(layers.RUNNERS, "bronze", broken)
    done = loop.run_once(spark, settings, manifest)
    assert [k for _, _, k in done.escalated] == ["corrupt_file", "unknown"] and asked == ["RuntimeError: strange ***"]
    d = loop.Diagnosis(settings)
    d.ask = lambda *_: "nonsense"
    assert d(RuntimeError("x"), "bronze") == "unknown"


def test_interruption_is_recorded(spark, place, monkeypatch):  # noqa: F811
    from talkmill.control import layers

    settings, manifest, _ = place

    def stopped(*_):
        raise KeyboardInterrupt

    monkeypatch.setitem(layers.RUNNERS, "bronze", stopped)
    with pytest.raises(KeyboardInterrupt):
        loop.run_once(spark, settings, manifest)
    assert manifest.view(spark, "loop_runs").first()["status"] == "INTERRUPTED"


def test_older_manifest_gets_the_new_columns(tmp_path):
    import sqlite3

    at = str(tmp_path / "old.db")
    db = sqlite3.connect(at)
    db.execute("CREATE TABLE runs (run_id INTEGER PRIMARY KEY, batch_id TEXT NOT NULL, layer TEXT NOT NULL, status TEXT NOT NULL, rows_in INTEGER, rows_out INTEGER, rows_rejected INTEGER, error TEXT, started_at TEXT NOT NULL, finished_at TEXT)")
    db.execute("INSERT INTO runs (batch_id, layer, status, started_at) VALUES ('b', 'silver', 'COMPLETED', 'x')")
    db.commit()
    db.close()
    for _ in range(2):
        m = Manifest(at)
        assert m.latest_run("b", "silver")["rows_deduped"] is None
        m.close()


def test_scenarios(spark, place, tmp_path):  # noqa: F811
    from talkmill.control import perf

    settings, manifest, _ = place
    stats = perf.run(spark, settings, str(tmp_path / "t.jsonl"))
    assert {r["scenario"] for r in stats.collect()} == {*perf.SCENARIOS.keys() - {"overhead"}, "overhead_direct", "overhead_loop"}
    assert events.over_limit(stats, perf.LIMITS) == []


def test_scratch_and_shared_folder(spark, monkeypatch):
    from talkmill import session

    with session.scratch(spark):
        path = session.work_dir(spark, "x")
        spark.range(3).write.parquet(path)
        assert sinks.exists(spark, path)
    assert not sinks.exists(spark, path)
    import os
    import subprocess
    import sys
    import tempfile

    code = "from talkmill.session import local_session, written; s = local_session(1, 1); assert written(s.range(3), 'x').count() == 3"
    with tempfile.TemporaryDirectory() as empty:  # a session without any setting of its own
        done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(__file__)), env=os.environ | {"SPARK_CONF_DIR": empty}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
