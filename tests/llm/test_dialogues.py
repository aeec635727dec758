from datetime import datetime, timedelta

import pytest

from talkmill.llm import dialogues as d
from talkmill.session import work_dir
from tests import oracle

START = datetime(2025, 5, 1, 10)
SCHEMA = "conversation_id string, message_id string, timestamp timestamp_ntz, direction string, message_body string, ingested_at timestamp, turn string, role int"


def row(c, m, at=0, direction="inbound", body="oi", late=1):
    return (c, m, None if at is None else START + timedelta(minutes=at), direction, body, START + timedelta(days=late), "clash", 1)


def good(c):
    return [row(c, "1"), row(c, "2", 5, "outbound")]


def stored(spark, rows, path=None):
    path = path or work_dir(spark, "bronze")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


CASES = {
    "good": (good("good"), True),
    "unanswered": ([row("unanswered", "1"), row("unanswered", "2", 5)], False),
    "answered_before": ([row("answered_before", "1", 5), row("answered_before", "2", 0, "outbound")], False),
    "same_time": ([row("same_time", "1", 5), row("same_time", "2", 5, "outbound")], False),
    "blank_answer": ([row("blank_answer", "1"), row("blank_answer", "2", 5, "outbound", "​ 　\t")], False),
    "null_answer": ([row("null_answer", "1"), row("null_answer", "2", 5, "outbound", None)], False),
    "no_speaker": ([*good("no_speaker"), row("no_speaker", "3", 7, None)], False),
    "speaker_known_once": ([*good("speaker_known_once"), row("speaker_known_once", "3", 7, None), row("speaker_known_once", "3", 7, "inbound")], True),
    "two_speakers": ([*good("two_speakers"), row("two_speakers", "2", 5, "inbound")], False),
    "no_time": ([*good("no_time"), row("no_time", "3", None)], False),
    "time_known_once": ([*good("time_known_once"), row("time_known_once", "3", None), row("time_known_once", "3", 9)], True),
    "long": ([row("long", "1", body="x" * 200_000), row("long", "2", 5, "outbound")], True),
}


def test_cases_and_order(spark):
    rows = [r for rs, _ in CASES.values() for r in rs] + [row(None, "1"), row("c", None)] + good("good")
    c = d.rebuild(spark, stored(spark, rows))
    assert {r["conversation_id"]: r["valid"] for r in c.verdicts().collect()} == {k: v for k, (_, v) in CASES.items()}
    turns = [(r["turn"], r["role"], r["message_id"]) for r in c.dialogues().where("conversation_id = 'good'").orderBy("turn").collect()]
    assert turns == [(1, "inbound", "1"), (2, "outbound", "2")]


def test_empty_table(spark):
    c = d.rebuild(spark, stored(spark, []))
    assert c.verdicts().count() == 0 and c.dialogues().count() == 0


def test_late_deliveries_join_open_state_and_timeouts_emit(spark):
    path = stored(spark, [row("a", "1"), row("b", "1")])
    c = d.Conversations(spark, path, timeout="1 day", lateness="2 days")
    c.advance()
    assert c.messages().count() == 0
    stored(spark, [row("a", "2", 60 * 20, "outbound"), row("late", "1", -60 * 10), row("z", "1", 60 * 24 * 30)], path)
    c.advance()
    assert {(r[0], r[1]) for r in c.messages().select("conversation_id", "message_id").collect()} == {("a", "1"), ("a", "2"), ("b", "1"), ("late", "1")}
    c.close()
    assert {r["conversation_id"]: r["valid"] for r in c.verdicts().collect()} == {"a": True, "b": False, "late": False, "z": False}


def test_long_silence_does_not_split_a_closed_input(spark):
    far = 60 * 24 * 200
    rows = [row("paused", "1"), row("paused", "2", far, "outbound"), row("never", "1"), row("never", "2", far)]
    rows += [*good("copied"), row("copied", "3", 7, None, "b"), row("copied", "3", far, "inbound", "a", 0), row("copied", "4", far // 2, "outbound")]
    rows += [*good("clashing"), row("clashing", "2", far, "inbound")]
    c = d.rebuild(spark, stored(spark, rows))
    assert sorted((r["conversation_id"], r["n_messages"], r["valid"]) for r in c.verdicts().collect()) == [("clashing", 2, False), ("copied", 4, True), ("never", 2, False), ("paused", 2, True)]
    turns = [(r["message_id"], r["role"], r["text"]) for r in c.dialogues().where("conversation_id = 'copied'").orderBy("turn").collect()]
    assert turns == [("1", "inbound", "oi"), ("2", "outbound", "oi"), ("3", "inbound", "a"), ("4", "outbound", "oi")]


def test_rows_too_late_for_the_stream_are_counted_and_brought_in(spark):
    day = 60 * 24
    path = stored(spark, [row("q", "1"), row("w", "1"), row("w", "2", 5, "outbound"), row("k", "1"), row("k", "2", 5, "outbound"), row("new", "1", 400 * day), row("new", "2", 400 * day + 1, "outbound")])
    c = d.Conversations(spark, path)
    c.advance()
    c.advance()
    assert c.dropped().count() == 0 and {r["conversation_id"] for r in c.messages().collect()} == {"q", "w", "k"}
    # a late answer, a late copy that contradicts, a whole late conversation
    stored(spark, [row("q", "2", 5, "outbound"), row("w", "2", 5, "inbound"), *good("gone")], path)
    c.advance()
    assert c.dropped().count() > 0
    assert {(r[0], r[1]) for r in c.late().collect()} == {("w", "2")}  # not emitted yet, as the input is open: q 2 and gone
    c.close()
    assert {(r[0], r[1], r[2]) for r in c.late().collect()} == {("q", "2", 1), ("w", "2", 1), ("gone", "1", 1), ("gone", "2", 1)}
    assert {r["conversation_id"]: r["valid"] for r in c.verdicts().collect()} == {"q": True, "w": False, "k": True, "gone": True, "new": True}
    assert {(r["message_id"], r["role"]) for r in c.dialogues().where("conversation_id = 'q'").collect()} == {("1", "inbound"), ("2", "outbound")}


def test_one_current_verdict_while_the_input_is_open(spark):
    day = 60 * 24
    path = stored(spark, [row("p", "1"), row("x", "1", 10 * day)])
    c = d.Conversations(spark, path)
    c.advance()
    for at in (200, 400, 600, 800):
        stored(spark, [row("p", "2", 200 * day, "outbound")] if at == 200 else [], path)
        stored(spark, [row("x", str(at), at * day)], path)
        c.advance()
        c.advance()
    rows = [(r["n_messages"], r["valid"]) for r in c.verdicts().where("conversation_id = 'p'").collect()]
    assert rows == [(2, True)]


def test_hot_conversation(spark):
    rows = [row("hot", str(i), i, ["inbound", "outbound"][i % 2]) for i in range(3000)] + [r for i in range(50) for r in good(f"c{i}")]
    v = d.rebuild(spark, stored(spark, rows)).verdicts()
    assert v.where("valid").count() == 51 and v.where("conversation_id = 'hot'").first()["n_messages"] == 3000


@pytest.mark.parametrize("name", ["p1_found", "p1_dialogues"])
def test_equals_sql(spark, name):
    oracle.same(spark, getattr(d, name), d.SQL[name])
