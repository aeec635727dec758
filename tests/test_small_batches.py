"""Arrow batches of three rows: groups and shards straddle batches everywhere."""

import random
from collections import Counter
from datetime import datetime

import pytest

from talkmill.operators import delivery, features
from talkmill.session import work_dir

START = datetime(2025, 1, 1)


@pytest.fixture
def tiny(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield spark
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_delivery_over_loads(tiny):
    r, state, seen = random.Random(4), work_dir(tiny, "seen"), set()
    for _ in range(3):
        rows = [(f"c{r.randrange(6)}", f"m{r.randrange(9)}", START, "b") for _ in range(40)]
        df = tiny.createDataFrame(rows, "conversation_id string, message_id string, ingested_at timestamp, batch_id string")
        got = {(x["conversation_id"], x["message_id"]): (x["n_rows"], x["is_new"]) for x in delivery.deliver_once(df, state=state, shards=3).collect()}
        want = {k: (n, k not in seen) for k, n in Counter(x[:2] for x in rows).items()}
        assert got == want
        seen |= set(want)


def test_features_in_small_blocks(tiny, monkeypatch):
    monkeypatch.setattr(features, "BLOCK", 2)
    r = random.Random(5)
    events = [(f"c{r.randrange(30)}", "m", r.choice(["a", "b", None]), START.replace(second=r.randrange(60))) for _ in range(300)]
    pairs = [(f"L{i % 17}", f"c{i}", "m") for i in range(30)]
    e = tiny.createDataFrame(events, "conversation_id string, message_id string, outcome string, at timestamp_ntz")
    p = tiny.createDataFrame(pairs, "lead_id string, conversation_id string, message_id string")
    got = {x["lead_id"]: x for x in features.entity_features(e, p, "lead_id", ("conversation_id", "message_id"), "outcome", "at").collect()}
    lead, latest = {c: x for x, c, _ in pairs}, max(x[3] for x in events)
    assert len(got) == 17
    for name, row in got.items():
        own = [x for x in events if lead[x[0]] == name]
        assert row["rows_n"] == len(own)
        for t in "ab":
            times = [x[3] for x in own if x[2] == t]
            assert (row[f"{t}_n"], row[f"{t}_recency_s"]) == (len(times), (latest - max(times)).seconds if times else None)
