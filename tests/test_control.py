import threading
import time

import pytest
from pyspark.sql import functions as F

from talkmill import schemas
from talkmill.control import cli, layers, loop
from talkmill.control.layers import Settings
from talkmill.control.state import Manifest
from talkmill.operators import model_lane as lane
from talkmill.sources import batches, sinks, tables
from talkmill.streaming import continuous


def raw(spark, n=6, **fixed):
    def value(c, i):
        return fixed.get(c) or {"message_id": f"m{i}", "conversation_id": f"c{i % 2}", "timestamp": f"2025-05-01 10:00:{i:02d}", "direction": ["inbound", "outbound"][i % 2], "message_type": "text", "status": "read", "sender_phone": "11987654321"}.get(c, f"{c}{i}")

    return spark.createDataFrame([tuple(value(c, i) for c in schemas.SOURCE_COLUMNS) for i in range(n)], schemas.SOURCE)


@pytest.fixture
def place(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()

    def drop(name, df):
        df.coalesce(1).toPandas().to_parquet(src / name)

    drop("a.parquet", raw(spark))
    settings = Settings(str(src), str(tmp_path / "lake"), secret="s", interval_s=0.01)
    (tmp_path / "lake").mkdir()
    manifest = Manifest(str(tmp_path / "lake/manifest.db"))
    yield settings, manifest, drop
    manifest.close()


def test_a_pass_makes_all_layers_and_the_next_does_nothing(spark, place):
    settings, manifest, drop = place
    done = loop.run_once(spark, settings, manifest)
    assert (done.batches, done.layers, done.failures) == (1, 3, 0)
    batch = batches.discover(settings.source)[0]
    assert all(sinks.exists(spark, p) for layer in ("bronze", "silver", "gold") for p in layers.outputs(settings, batch.batch_id, layer))
    began = time.time()
    again = loop.run_once(spark, settings, manifest)
    assert (again.batches, again.layers) == (0, 0) and time.time() - began < 1
    drop("b.parquet", raw(spark, 4))
    assert loop.run_once(spark, settings, manifest).batches == 1
    assert sinks.read_partition(spark, settings.table("bronze"), batch.batch_id).count() == 6
    assert loop.run_forever(spark, settings, manifest, threading.Event(), 2) == 2
    assert manifest.view(spark, "batches").where("status = 'COMPLETED'").count() == 2


def test_missing_partition_is_made_again(spark, place):
    settings, manifest, _ = place
    loop.run_once(spark, settings, manifest)
    batch = batches.discover(settings.source)[0]
    fs, p = sinks.filesystem(spark, settings.root)
    fs.delete(p(sinks.partition_path(settings.table("silver"), batch.batch_id)), True)
    done = loop.run_once(spark, settings, manifest)
    assert (done.batches, done.layers, done.failures) == (1, 2, 0)


def test_drifted_bronze_is_conformed(spark, place):
    settings, manifest, _ = place
    loop.run_once(spark, settings, manifest)
    batch = batches.discover(settings.source)[0]
    at = sinks.partition_path(settings.table("bronze"), batch.batch_id)
    bad = spark.createDataFrame(spark.read.parquet(at).drop("channel").toPandas())
    bad.write.mode("overwrite").parquet(at)
    manifest.invalidate(batch.batch_id, "silver", "test")
    manifest.end_batch(batch.batch_id, error="test")
    done = loop.run_once(spark, settings, manifest)
    fixes = [r["fix"] for r in manifest.view(spark, "failures").collect()]
    assert done.failures == 0 and any("missing column channel" in (f or "") for f in fixes)


def test_bad_values_and_files_are_escalated(spark, place):
    settings, manifest, drop = place
    drop("a.parquet", raw(spark, direction="sideways"))
    drop("b.parquet", raw(spark).drop("status"))
    with open(f"{settings.source}/c.parquet", "wb") as f:
        f.write(b"PAR1 broken")
    done = loop.run_once(spark, settings, manifest)
    assert done.batches == 3 and {k for _, _, k in done.escalated} == {"schema_drift", "corrupt_file"}
    assert not sinks.exists(spark, settings.table("silver"))


def test_failed_write_leaves_the_old_partition(spark, tmp_path):
    root = str(tmp_path / "t")
    good = raw(spark)
    sinks.write_partition(good, root, "x", schemas.CLOSED)
    with pytest.raises(schemas.SchemaDrift):
        sinks.write_partition(raw(spark, status="lost"), root, "x", schemas.CLOSED)
    assert spark.read.parquet(root).where("status = 'read'").count() == 6
    with pytest.raises(ValueError):
        sinks.write_partition(good, root, "../x")
    assert sinks.write_rejected(good.where("false"), root, "y") is None and sinks.rejected_count(spark, root, "y") == 0
    sinks.write_json(spark, str(tmp_path / "d/one.json"), {"a": 1})
    sinks.write_json(spark, str(tmp_path / "d/one.json"), {"a": 2})
    assert (tmp_path / "d/one.json").read_text().replace("\n", "").replace(" ", "") == '{"a":2}'


@pytest.mark.parametrize("moment", ["moved aside", "deleting the old one"])
def test_a_crash_while_a_partition_is_replaced_loses_nothing(spark, tmp_path, moment):
    root = str(tmp_path / "t")
    sinks.write_partition(raw(spark, 3), root, "x")
    fs, path = sinks.filesystem(spark, root)
    assert fs.rename(path(f"{root}/batch_id=x"), path(f"{root}/.replaced-x"))
    if moment == "moved aside":
        assert sinks.restore(spark, root, "x") and sinks.read_partition(spark, root, "x").count() == 3
        return
    raw(spark, 5).write.parquet(f"{root}/batch_id=x")
    assert not sinks.restore(spark, root, "x") and not fs.exists(path(f"{root}/.replaced-x"))
    assert sinks.read_partition(spark, root, "x").count() == 5


def test_a_failed_rename_brings_the_old_partition_back(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    sinks.write_partition(raw(spark, 3), root, "x")
    real, path = sinks.filesystem(spark, root)

    class Broken:
        def __getattr__(self, name):
            return getattr(real, name)

        def rename(self, a, b):
            return False if ".staging-" in a.toString() else real.rename(a, b)

    monkeypatch.setattr(sinks, "filesystem", lambda *_: (Broken(), path))
    with pytest.raises(sinks.RoundTripError):
        sinks.write_partition(raw(spark, 5), root, "x")
    assert spark.read.parquet(f"{root}/batch_id=x").count() == 3


def test_sources(spark, tmp_path):
    with pytest.raises(tables.MissingSource):
        tables.scan(spark, str(tmp_path / "none"))
    raw(spark).drop("status").write.parquet(str(tmp_path / "t"))
    with pytest.raises(tables.MissingColumns, match="status"):
        tables.scan(spark, str(tmp_path / "t"), schemas.SOURCE_COLUMNS)
    f = tmp_path / "f.parquet"
    f.write_bytes(b"abc")
    mine = batches.identify(str(f))
    own = tmp_path / "own"
    own.mkdir()
    (own / "f.parquet").write_bytes(b"abc")
    known = Manifest(str(tmp_path / "m.db"))
    there = batches.discover(f"file://{own}", spark, known)
    assert there == batches.discover(str(own)) == [batches.identify(str(own / "f.parquet"))] and there[0].source_hash == mine.source_hash
    known.db.execute("UPDATE files SET source_hash = 'remembered'")
    assert batches.discover(str(own), spark, known)[0].source_hash == "remembered"
    known.close()
    assert batches.discover(str(tmp_path / "none")) == batches.discover(str(tmp_path / "none"), spark) == []


def test_manifest_and_lock(tmp_path):
    m = Manifest(str(tmp_path / "m.db"))
    b = batches.Batch("0" * 12, "p", "h", 1)
    m.open_batch(b)
    run = m.open_run(b.batch_id, "silver")
    m.end_run(run, rows_in=5)
    m.end_run(run, rows_out=4)
    assert m.latest_run(b.batch_id, "silver")["rows_in"] == 5 and m.completed(b.batch_id, "silver")
    m.open_run(b.batch_id, "gold")
    m.keep_reply("ab_1", "x", "one")
    m.keep_reply("ab_1", "x", "two")
    m.keep_reply("abz1", "x", "three")
    assert m.reply("ab_1") == "one" and m.forget_replies("ab_") == 1 and m.reply("abz1") == "three"
    m.close()
    m = Manifest(str(tmp_path / "m.db"))
    assert m.batch(b.batch_id)["status"] == "FAILED" and m.latest_run(b.batch_id, "gold")["status"] == "FAILED"
    m.close()
    lock = loop.Lock(str(tmp_path / "l"))
    with lock, lock:
        assert (tmp_path / "l").exists()
    assert not (tmp_path / "l").exists()
    (tmp_path / "l").write_text("999999999")
    with lock:
        pass
    (tmp_path / "l").write_text("1")
    with pytest.raises(RuntimeError), loop.Lock(str(tmp_path / "l")):
        pass


def test_model_lane(spark):
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(["a", "a", "b", "c", None, " "])], "message_id string, message_body_masked string")
    for c, t in (("veiculo_marca", "string"), ("veiculo_modelo", "string"), ("veiculo_ano", "int"), ("concorrente_mencionado", "string"), ("valor_pago_atual_brl", "double"), ("sinistro_historico", "boolean")):
        rows = rows.withColumn(c, F.lit(None).cast(t))
    key = lambda c: lane.cache_key("m", "s", c, 10, 0.0)
    reply = '{{"concorrente_mencionado": " {} ", "veiculo_marca": null, "veiculo_modelo": "", "veiculo_ano": 2010.0, "valor_pago_atual_brl": true, "sinistro_historico": true}}'
    cache = rows.where("message_body_masked = 'c'").select(key(F.col("message_body_masked")).alias("key"), F.lit(reply.format("cached")).alias("reply"))

    def call(text):
        if text == "b":
            raise TimeoutError
        return reply.format(text)

    out, fresh = lane.fill_entities(rows, call, cache, key, budget=10)
    got = {r["message_id"]: r for r in out.collect()}
    assert [got[str(i)]["concorrente_mencionado"] for i in range(6)] == ["a", "a", None, "cached", None, None]
    assert got["0"]["veiculo_ano"] == 2010 and got["0"]["valor_pago_atual_brl"] is None and fresh.count() == 1
    assert lane.missing_bodies(rows, cache, key, 1).count() == 1
    assert set(lane.parse_reply("[]").values()) == {None} and lane.parse_reply("```json\n" + reply.format("z") + "\n```")["concorrente_mencionado"] == "z"
    ranked = lane.within_budget(rows.select("message_id"), "message_id", 2)
    assert ranked.where("in_budget").count() == 2
    assert {r["body"] for r in lane.missing_bodies(rows, cache, key, 10).collect()} == {"a", "b"}


def test_cli(spark, place, capsys):
    settings, manifest, _ = place
    args = ["--source", settings.source, "--root", settings.root]
    assert cli.main([*args, "ingest", f"{settings.source}/a.parquet"], spark) == 0
    assert cli.main([*args, "ingest", f"{settings.source}/a.parquet"], spark) == 0
    assert "there already" in capsys.readouterr().out
    assert cli.main([*args, "silver", "--batch-id", "0" * 12], spark) == 1
    with pytest.raises(SystemExit):
        cli.main([*args, "silver", "--batch-id", "../x"], spark)


def test_stream_takes_in_new_files_once(spark, place):
    settings, _, drop = place
    continuous.start(spark, settings).awaitTermination()
    assert spark.read.parquet(settings.table("silver")).count() == 6
    drop("b.parquet", raw(spark, 3))
    continuous.start(spark, settings).awaitTermination()
    assert spark.read.parquet(settings.table("silver")).select("batch_id").distinct().count() == 2
    drop("c.parquet", raw(spark, 3))
    continuous.start(spark, settings).awaitTermination()
    assert spark.read.parquet(settings.table("bronze")).count() == 9
