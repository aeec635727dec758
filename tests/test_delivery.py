from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from talkmill.operators.delivery import Bitmap, deliver_once, unique_rows
from talkmill.session import work_dir

SCHEMA = "conversation_id string, message_id string, ingested_at timestamp, batch_id string, body string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(c, m, day=1, batch="b", body="x"):
    from datetime import datetime

    return (c, m, datetime(2025, 5, day) if day else None, batch, body)


def test_one_copy_of_each(spark):
    rows = [row("c1", "m1", 2), row("c1", "m1", 1, body="first"), row("c2", "m1"), row("c1", "m2"), row("c1", "m2"), row("c1", "m2"), row(None, "m3"), row("c3", None), row("c4", "m9", None)]
    got = {(r["conversation_id"], r["message_id"]): r for r in deliver_once(table(spark, rows), shards=4).collect()}
    assert {k: r["n_rows"] for k, r in got.items()} == {("c1", "m1"): 2, ("c2", "m1"): 1, ("c1", "m2"): 3, ("c4", "m9"): 1}
    assert got["c1", "m1"]["arrival"]["body"] == "first"
    assert all(r["is_new"] for r in got.values()) and {k: r["refused"] for k, r in got.items() if r["refused"]} == {("c1", "m1"): 1, ("c1", "m2"): 2}


def test_empty_table(spark):
    assert deliver_once(table(spark, []), shards=4).count() == 0
    assert unique_rows(table(spark, []), shards=4).columns == SCHEMA.replace(" string", "").replace(" timestamp", "").split(", ")


def test_names_that_clash_and_long_keys(spark):
    long = "k" * 20_000
    df = table(spark, [row(long, long), row(long, long), row("", "")]).withColumnsRenamed({"body": "code"}).selectExpr("*", "1 AS shard", "'z' AS kind", "2 AS n_rows", "true AS is_new", "'q' AS arrival", "'k' AS key_0", "'b' AS bits")
    out = unique_rows(df, shards=2)
    assert out.columns == df.columns and out.count() == 2


def test_loads_share_a_state(spark):
    state = work_dir(spark, "seen")
    one = table(spark, [row("c", f"m{i}") for i in range(50)])
    two = table(spark, [row("c", f"m{i}", 2) for i in range(25, 90)] + [row("c", "m89", 3)])
    assert unique_rows(one, state=state, shards=4).count() == 50
    again = deliver_once(two, state=state, shards=4).collect()
    assert sum(r["is_new"] for r in again) == 40 and len(again) == 65
    assert {r["message_id"] for r in again if r["refused"]} == {*(f"m{i}" for i in range(25, 50)), "m89"}
    third = deliver_once(one.union(two), state=state, shards=4).collect()
    assert not any(r["is_new"] for r in third)
    assert unique_rows(table(spark, [row("d", "m1")]), state=state, shards=4).count() == 1


def test_load_that_stopped_before_its_switch_counts_for_nothing(spark, monkeypatch):
    from talkmill.operators import delivery

    state = work_dir(spark, "seen")
    df = table(spark, [row("c", "m1"), row("c", "m2")])
    with monkeypatch.context() as m:
        m.setattr(delivery, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            deliver_once(df, state=state, shards=2)
        except RuntimeError:
            pass
    assert len(delivery._dictionaries(spark, state)) == 1  # codes without bits: the bits decide
    assert unique_rows(df, state=state, shards=2).count() == 2
    assert unique_rows(df, state=state, shards=2).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.sampled_from("uvwxyz")), max_size=60))
def test_counts_against_brute_force(spark, keys):
    got = {(r["conversation_id"], r["message_id"]): r["n_rows"] for r in deliver_once(table(spark, [row(*k) for k in keys]), payload=False, shards=3).collect()}
    assert got == dict(Counter(keys))


def test_bitmap_round_trip():
    b = Bitmap()
    assert b.take(np.array([1, 5, 9000])).all()
    assert len(b.packed) < 3000  # bits, not bytes
    again = Bitmap(b.blob())
    assert again.take(np.array([1, 2, 9000])).tolist() == [False, True, False]
