from datetime import datetime

import pytest

from talkmill.operators.features import entity_cells, entity_features

EVENTS = "conversation_id string, message_id string, outcome string, at timestamp_ntz, surplus string"
PAIRS = "lead_id string, conversation_id string, message_id string, outcome string"


def at(s):
    return datetime(2025, 5, 1, 0, 0, s)


def features(spark, events, pairs, **kw):
    e = spark.createDataFrame(events, EVENTS)
    p = spark.createDataFrame(pairs, PAIRS)
    return entity_features(e, p, "lead_id", ("conversation_id", "message_id"), "outcome", "at", **kw)


def test_counts_recency_and_totals(spark):
    events = [("c", "m1", "sold", at(10), "x"), ("c", "m1", "sold", at(20), "x"), ("c", "m2", None, at(50), "x"), ("c", "m3", "lost", None, None), (None, "m1", "sold", at(55), "x"), ("z", "z", "other", at(59), "x")]
    pairs = [("L", "c", "m1", "sold"), ("L", "c", "m1", "again"), ("L", "c", "m2", None), ("L", "c", "m3", None), ("M", "n", "n", None), (None, "z", "z", None)]
    got = {r["lead_id"]: r.asDict() for r in features(spark, events, pairs).collect()}
    assert got["L"] == {"lead_id": "L", "total_n": 3, "total_recency_s": 39, "rows_n": 4, "rows_recency_s": 9, "lost_n": 1, "lost_recency_s": None, "other_n": 0, "other_recency_s": None, "sold_n": 2, "sold_recency_s": 39}
    assert got["M"]["rows_n"] == 0 and got["M"]["rows_recency_s"] is None and got["M"]["sold_n"] == 0
    assert set(got) == {"L", "M"}


def test_names_that_clash(spark):
    events = [("c", "m", t, at(1), None) for t in ("total", "Sold", "sold", "rows", "lead")]
    out = features(spark, events, [("L", "c", "m", None)])
    assert len({c.lower() for c in out.columns}) == len(out.columns) == 5 + 2 * 5
    assert out.first()["total_n"] == 5


def test_empty_and_bound(spark):
    assert features(spark, [], []).count() == 0
    out = features(spark, [], [("L", "c", "m", None)])
    assert out.columns == ["lead_id", "total_n", "total_recency_s", "rows_n", "rows_recency_s"] and out.first()["rows_n"] == 0
    with pytest.raises(ValueError, match="more than 2"):
        features(spark, [("c", "m", str(i), at(1), None) for i in range(3)], [], max_types=2)


def test_against_brute_force_over_many_blocks(spark):
    import random

    r = random.Random(1)
    pairs = [(f"L{i}", f"c{i}", "m", None) for i in range(5000)]
    events = [(f"c{r.randrange(5000) if r.random() < 0.6 else 7}", "m", f"t{r.randrange(20)}" if r.random() < 0.9 else None, at(r.randrange(60)), None) for _ in range(12000)]
    got = features(spark, events, pairs).toPandas().set_index("lead_id")
    assert len(got) == 5000
    for lead in ("L7", "L8", "L4999"):
        own = [e for e in events if e[0] == "c" + lead[1:]]
        assert got.loc[lead, "rows_n"] == len(own)
        assert got.loc[lead, "total_n"] == sum(e[2] is not None for e in own)
        for t in range(20):
            assert got.loc[lead, f"t{t}_n"] == sum(e[2] == f"t{t}" for e in own)
    assert got["rows_n"].sum() == len(events)


def test_wide_and_long_form_agree(spark):
    events = [("c", f"m{i % 7}", f"t{i % 5}" if i % 4 else None, at(i % 60) if i % 9 else None, None) for i in range(200)]
    pairs = [(f"L{i % 3}", "c", f"m{i}", None) for i in range(7)]
    wide = features(spark, events, pairs).toPandas().set_index("lead_id")
    cells = entity_cells(spark.createDataFrame(events, EVENTS), spark.createDataFrame(pairs, PAIRS), "lead_id", ("conversation_id", "message_id"), "outcome", "at").collect()
    assert {(r["lead_id"], r["type"]): r["n"] for r in cells} == {(k, t): wide.loc[k, f"{t}_n"] for k in wide.index for t in (f"t{i}" for i in range(5)) if wide.loc[k, f"{t}_n"]}
    assert all(r["recency_s"] == wide.loc[r["lead_id"], f"{r['type']}_recency_s"] for r in cells if r["recency_s"] is not None)
