import hashlib
import hmac
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from talkmill import schemas
from talkmill.functions import lead, masking, scoring, text
from talkmill.operators import bronze, silver


def one(spark, make, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("body", "masked"),
    [
        ("fale com lead.um@foo.com.br já", "fale com l******@f****.br já"),
        ("a@b.co e cd@e.org", "a****@b****.co e c****@e****.org"),
        ("cpf 123.456.789-01", "cpf ***.***.***-**"),
        ("cep 01310-930", "cep *****-***"),
        ("11987654321", "+55 (**) *****-**21"),
        ("liga (11) 98765-4321 hoje", "liga +55 (**) *****-**21 hoje"),
        ("placa ABC1D23 ou XYZ-1234", "placa ***1D** ou ***-**34"),
        ("", ""),
        (None, None),
    ],
)
def test_body_masks_and_is_stable(spark, body, masked):
    got = one(spark, masking.mask_body, body)
    assert got == masked
    assert one(spark, masking.mask_body, got) == got


def test_sender_mask_hides_what_is_no_phone(spark):
    assert one(spark, masking.mask_sender, "12345") == "*****"
    assert one(spark, masking.mask_sender, "") is None
    assert one(spark, masking.mask_sender, "+55 11 98765-4321").endswith("21")


def test_extractions(spark):
    assert one(spark, masking.email_domain, "A@Foo.COM.br x@y.zz") == "foo.com.br"
    assert one(spark, masking.email_domain, "none") is None
    assert one(spark, masking.cep_prefix, "cep 01310-930") == "01310" and one(spark, masking.cep_prefix, "x") is None
    assert one(spark, masking.has_cpf, None) is False and one(spark, masking.has_phone, None) is False
    assert one(spark, masking.plate_format, "XYZ-1234 ABC1D23") == "mercosul"
    assert one(spark, masking.has_content, "\t  \n") is False and one(spark, masking.has_content, " x ") is True


@pytest.mark.parametrize(("kind", "body", "want"), [("text", "oi", None), ("audio", None, "low"), ("audio", "curto", "low"), ("audio", "um texto claro e longo..", "high"), ("audio", "um texto claro e longo...", "low"), ("audio", "[RUÍDO] um texto claro", "low")])
def test_audio_confidence(spark, kind, body, want):
    df = spark.createDataFrame([(kind, body)], "k string, b string")
    assert df.select(masking.audio_confidence(F.col("k"), F.col("b")).alias("r")).first()["r"] == want


def test_lead_id_is_hmac_of_digits(spark):
    want = hmac.new(b"s", b"11987654321", hashlib.sha256).hexdigest()[:16]
    for phone in ("+55 (11) 98765-4321", "11987654321", "5511987654321"):
        assert one(spark, lambda c: lead.lead_id(c, "s"), phone) == want
    assert one(spark, lambda c: lead.lead_id(c, "t"), "11987654321") != want
    long = "k" * 100
    assert one(spark, lambda c: lead.hmac_sha256(long, c), "x") == hmac.new(long.encode(), b"x", hashlib.sha256).hexdigest()
    for bad in ("123", "", None, "9" * 14):
        assert one(spark, lambda c: lead.lead_id(c, "s"), bad) is None
    with pytest.raises(ValueError):
        lead.lead_id(F.col("v"), "")


def test_names_and_phrases(spark):
    assert one(spark, text.normalized_name, " \tÂna  PÁULA ") == "ana  paula"
    assert one(spark, text.normalized_name, "  ") is None
    assert one(spark, lambda c: text.normalized_name(c, False), "ÂNA") == "ana"
    assert one(spark, text.normalized_name, "Straße ﬁ") == "strasse fi"
    assert one(spark, lambda c: text.phrase_hits(c, text.OBJECTIONS), "TA CARO, tá caro! vou pensar") == 2
    assert one(spark, lambda c: text.phrase_hits(c, text.OBJECTIONS), None) == 0


@pytest.mark.parametrize(("meta", "state"), [('{"state":"SP"}', "SP"), ('{"device":"x"}', None), ("{bad", "none"), ("42", "none"), ("", "none"), (None, "none"), ("[1]", "none")])
def test_metadata(spark, meta, state):
    got = one(spark, silver.parsed_metadata, meta)
    assert (got is None) if state == "none" else got["state"] == state


def event(m="m", c="c", status="sent", day=1, batch="b1", **kw):
    base = dict.fromkeys(schemas.BRONZE.fieldNames()) | {"message_id": m, "conversation_id": c, "status": status, "timestamp": datetime(2025, 5, day) if day else None, "batch_id": batch}
    return tuple((base | kw).values())


def test_dedup_order(spark):
    rows = [event(status="read", day=1), event(status="sent", day=9), event("m2", status="sent", day=1, batch="b9"), event("m2", status="sent", day=2, batch="b1"), event("m3", day=1, batch="b1"), event("m3", day=1, batch="b2"), event("m4", day=None), event("m4", day=1, status="odd"), event(None, day=3), event(None, day=4)]
    df = spark.createDataFrame(rows, schemas.BRONZE)
    got = {r["message_id"]: r for r in silver.dedup_events(df).collect()}
    assert got["m"]["status"] == "read" and got["m2"]["timestamp"].day == 2 and got["m3"]["batch_id"] == "b2" and got["m4"]["status"] == "sent" and got[None]["timestamp"].day == 4
    once = silver.dedup_events(df)
    assert sorted(map(str, silver.dedup_events(once).collect())) == sorted(map(str, once.collect()))
    assert "WindowGroupLimit" in once._jdf.queryExecution().executedPlan().toString()


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([event(), event(None), event("m", None), event(None, None)], schemas.BRONZE)
    valid, rejected = silver.partition_rows(df, datetime(2025, 1, 1))
    assert valid.count() + rejected.count() == 4
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["null_conversation_id", "null_message_id", "null_message_id"]
    assert schemas.differences(rejected.schema, schemas.REJECTED) == []


def test_reconcile(spark):
    rows = [("a", "ana"), ("a", "ana"), ("a", "ana paula"), ("b", "x"), ("b", "yy"), ("d", "aa"), ("d", "bb"), (None, "z"), ("e", None)]
    df = spark.createDataFrame(rows, "lead_id string, sender_name_normalized string")
    got = sorted((str(r[0]), str(r[1])) for r in silver.reconcile_names(df).collect())
    assert got == sorted([("a", "ana")] * 3 + [("b", "yy")] * 2 + [("d", "aa")] * 2 + [("None", "z"), ("e", "None")])


def test_full_schema_and_one_exchange_less(spark):
    df = spark.createDataFrame([event(sender_phone="11987654321", sender_name="Ána", message_body="oi", metadata="{}")], schemas.BRONZE)
    out = silver.silver_transform(df, "s", datetime(2025, 1, 1))
    schemas.assert_schema(out, schemas.SILVER, "silver")
    assert out.first()["sender_name_normalized"] == "ana"


def test_bronze_is_strict(spark):
    raw = spark.createDataFrame([tuple("2025-05-01 10:00:00" if c == "timestamp" else "x" for c in schemas.SOURCE_COLUMNS)], schemas.SOURCE)
    out = bronze.bronze_typed(raw.withColumn("surplus", F.lit(1)), "b", "h", datetime(2025, 1, 1))
    schemas.assert_schema(out, schemas.BRONZE, "bronze")
    bad = raw.withColumn("timestamp", F.lit("2025-13-45 10:00:00"))
    assert bad.agg(bronze.unparsable_timestamps(bad)).first()[0] == 1
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        bronze.bronze_typed(bad, "b", "h", datetime(2025, 1, 1)).collect()


def test_schema_drift_is_told(spark):
    df = spark.createDataFrame([(1, "x")], "message_id int, surplus string")
    with pytest.raises(schemas.SchemaDrift, match="missing column batch_id.*unexpected column surplus.*message_id: int instead of string"):
        schemas.assert_schema(df, schemas.BRONZE, "t")
    fixed = schemas.conform(spark.createDataFrame([("x", "sideways")], "veiculo_ano string, direction string"), schemas.SILVER)
    schemas.assert_schema(fixed, schemas.SILVER, "t")
    r = fixed.first()
    assert r["veiculo_ano"] is None and r["direction"] is None


def test_scores(spark):
    df = spark.range(1).select(F.lit(0.5).alias("a"), F.lit(1.0).alias("b"))
    score = scoring.weighted_score({"a": F.col("a"), "b": F.col("b"), "z": F.col("b")}, {"a": 5, "b": 10})
    assert df.select(score.alias("s")).first()["s"] == 12
    with pytest.raises(ValueError, match="missing components: q"):
        scoring.weighted_score({}, {"q": 1})
    label = scoring.first_match([(F.lit(None).cast("boolean"), "x"), (F.col("a") > 0, "y")], "z")
    assert df.select(label.alias("l")).first()["l"] == "y"
