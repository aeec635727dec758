"""Conversations rebuilt from message rows by keyed streaming state.

Two stateful streams in append mode, each with an event-time watermark and a table as its sink:

1. deliveries, keyed by (conversation, message): the copies of a message, early or late, are merged into one
   message, which is emitted when the watermark has passed its session's end;
2. messages, keyed by conversation: the few values that decide whether a conversation is whole (bad messages,
   first visible question, last visible answer) are merged, and the conversation is emitted when it times out,
   or earlier when the input is declared closed.

State is one small row per open message and one per open conversation (RocksDB, changelog in the shared folder),
so a conversation with any share of the rows is spread over all tasks; copies and sessions are merged within a
task before they're shuffled. Closing is a marker with a far event time that moves the watermark past every
open session. Results are corrected when they're read: sessions of one key are merged, and if a stream reports rows that
came behind its watermark, the messages that lack some of their deliveries are rebuilt. Rows are ordered within a conversation by a window over the emitted messages, whose sort spills.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.session import work_dir, written

#: A message or conversation is over when nothing of it came for this long, in event time. Sessions that a longer
#: silence split are put together again when the results are read, so there's one current verdict per conversation.
TIMEOUT = "120 days"
#: How late, in event time behind the latest row, a delivery may come and still be merged by the stream. What comes
#: later is dropped by it, counted in the table `dropped`, and brought in again from the source (see `late`).
LATENESS = "30 days"
#: White space and zero-width characters, as a character class of Java's and RE2's dialects.
BLANK_JAVA = r"\s\x1c-\x1f\x{85}\x{a0}\x{ad}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}"
BLANK_RE2 = r"\s\v\x1c-\x1f\x{85}\x{a0}\x{ad}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}"
#: Key of closing markers; no row that lacks an id gets this far.
MARKER = "\x00closed"
COLUMNS = ["conversation_id", "message_id", "timestamp", "direction", "message_body", "ingested_at"]


def visible(text):
    """True if the text holds a character that is neither white space nor zero-width."""
    return F.coalesce(text.rlike(f"[^{BLANK_JAVA}]"), F.lit(False))


@contextmanager
def _stateful(spark: SparkSession):
    own = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
        "spark.sql.streaming.numRecentProgressUpdates": "100000",
    }
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def merge_deliveries(deliveries: DataFrame, timeout: str = TIMEOUT, lateness: str = LATENESS) -> DataFrame:
    """One row per (conversation_id, message_id): timestamp (earliest), role (direction, null unless all non-null ones agree), visible, text, event_time.

    text is that of the earliest delivery with visible text, else of the earliest. `deliveries` must have event_time.
    """
    seen = visible(F.col("message_body"))
    came = F.coalesce("ingested_at", "event_time")
    order = F.struct(~seen, F.col("message_body").isNull(), came, "message_body")
    return (
        deliveries.withWatermark("event_time", lateness)
        .groupBy(F.session_window("event_time", timeout).alias("session"), "conversation_id", "message_id")
        .agg(
            F.min("timestamp").alias("timestamp"),
            F.min("direction").alias("least"),
            F.max("direction").alias("most"),
            F.bool_or(seen).alias("visible"),
            F.min_by("message_body", order).alias("text"),
            F.min_by(came, order).alias("text_at"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .select("conversation_id", "message_id", "timestamp", _role(), "visible", "text", F.col("session.start").alias("event_time"), "least", "most", "text_at", "n_rows")
    )


def _role():
    return F.when(F.col("least") == F.col("most"), F.col("least")).alias("role")


def _put_together(messages: DataFrame) -> DataFrame:
    """One row per message of the rows of `merge_deliveries` that several sessions gave for it; same columns."""
    order = F.struct(~F.col("visible"), F.col("text").isNull(), "text_at", "text")
    aggs = [F.min("timestamp").alias("timestamp"), F.min("least").alias("least"), F.max("most").alias("most"), F.bool_or("visible").alias("visible"), F.min_by("text", order).alias("text"), F.min("event_time").alias("event_time"), F.min_by("text_at", order).alias("text_at"), F.sum("n_rows").alias("n_rows")]
    return messages.groupBy("conversation_id", "message_id").agg(*aggs).withColumn("role", _role()).select(messages.columns)


def validate(messages: DataFrame, timeout: str = TIMEOUT, lateness: str = LATENESS) -> DataFrame:
    """One row per conversation: n_messages, n_bad (messages without one speaker or without time), answered, valid."""
    return _judged(messages.withWatermark("event_time", lateness).groupBy(F.session_window("event_time", timeout).alias("session"), "conversation_id"))


def _judged(conversations: GroupedData) -> DataFrame:
    return (
        conversations.agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.count_if(F.col("role").isNull() | F.col("timestamp").isNull()).alias("n_bad"),
            F.min(F.when(F.col("visible") & (F.col("role") == "inbound"), F.col("timestamp"))).alias("asked"),
            F.max(F.when(F.col("visible") & (F.col("role") == "outbound"), F.col("timestamp"))).alias("told"),
        )
        .select("conversation_id", "n_messages", "n_bad", F.coalesce(F.col("asked") < F.col("told"), F.lit(False)).alias("answered"))
        .withColumn("valid", F.col("answered") & (F.col("n_bad") == 0))
    )


def _drain(spark: SparkSession, stream: DataFrame, sink: str, checkpoint: str) -> int:
    """Processes what is there, then stops; called again it goes on where it stopped. Returns how many rows came too late."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"])


def _arranged(rows: DataFrame) -> DataFrame:
    """The identified deliveries with event_time."""
    return (
        rows.select(*COLUMNS)
        .where("conversation_id IS NOT NULL AND message_id IS NOT NULL")
        .withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
        .withColumn("event_time", F.coalesce("timestamp", "ingested_at", F.lit(datetime(1970, 1, 2)).cast("timestamp")))
    )


class Conversations:
    """The two streams over one source path and their tables under `home` (a folder that all executors share).

    `advance()` takes in what has arrived; `close()` declares the input complete, so that all that is open is
    emitted. Both may be called again after a crash: checkpoints and sinks make each row count once.
    """

    def __init__(self, spark: SparkSession, source: str, home: str | None = None, timeout: str = TIMEOUT, lateness: str = LATENESS):
        self.spark, self.timeout, self.lateness = spark, timeout, lateness
        self.source = self._listable(source)
        self.home = home or work_dir(spark, "conversations")
        schema = {f.name: f.dataType for f in spark.read.parquet(source).schema}
        lacking = [c for c in COLUMNS if c not in schema]
        if lacking:
            raise ValueError(f"{source}: missing columns {', '.join(lacking)}")
        self.schema = spark.read.parquet(source).schema
        self.markers = f"{self.home}/markers"
        self._marker_schema = T.StructType([T.StructField("conversation_id", T.StringType()), T.StructField("event_time", T.TimestampType()), T.StructField("of", T.StringType())])
        if not self._markers_there():
            spark.createDataFrame([], self._marker_schema).write.mode("append").parquet(self.markers)

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _listable(self, source: str) -> str:
        """A file source wants a folder or a pattern: a single file is named by a pattern that only it matches."""
        fs, path = self._path(source)
        return f"{source[:-1]}[{source[-1]}]" if fs.exists(path) and fs.getFileStatus(path).isFile() else source

    def _markers_there(self) -> bool:
        fs, path = self._path(self.markers)
        return fs.exists(path)

    def _markers(self, of: str) -> DataFrame:
        return self.spark.readStream.schema(self._marker_schema).parquet(self.markers).where(F.col("of") == of).select(F.lit(MARKER).alias("conversation_id"), "event_time")

    def _deliveries(self) -> DataFrame:
        return _arranged(self.spark.readStream.schema(self.schema).parquet(self.source)).unionByName(self._markers("deliveries"), allowMissingColumns=True)

    def _messages(self) -> DataFrame:
        rows = self.spark.readStream.schema(self._emitted().schema).parquet(f"{self.home}/messages")
        return rows.unionByName(self._markers("messages"), allowMissingColumns=True)

    def _step(self) -> None:
        with _stateful(self.spark):
            self._note("deliveries", _drain(self.spark, merge_deliveries(self._deliveries(), self.timeout, self.lateness), f"{self.home}/messages", f"{self.home}/deliveries-checkpoint"))

    def advance(self) -> None:
        self._step()
        self._judge()

    def _judge(self) -> None:
        with _stateful(self.spark):
            self._note("messages", _drain(self.spark, validate(self._messages(), self.timeout, self.lateness), f"{self.home}/verdicts", f"{self.home}/messages-checkpoint"))

    def _note(self, of: str, n: int) -> None:
        if n:
            self.spark.createDataFrame([(of, n)], "of string, n long").coalesce(1).write.mode("append").parquet(f"{self.home}/dropped")

    def dropped(self) -> DataFrame:
        """of (deliveries or messages) and n: what the streams reported as too late, one row per report."""
        fs, path = self._path(f"{self.home}/dropped")
        return self.spark.read.schema("of string, n long").parquet(f"{self.home}/dropped") if fs.exists(path) else self.spark.createDataFrame([], "of string, n long")

    def _too_late(self, of: str) -> bool:
        return self.dropped().where(F.col("of") == of).limit(1).count() > 0

    def _mark(self, of: str) -> None:
        far = datetime(9000, 1, 1) + timedelta(seconds=self.spark.read.schema(self._marker_schema).parquet(self.markers).count() + 1)
        self.spark.createDataFrame([(MARKER, far, of)], self._marker_schema).coalesce(1).write.mode("append").parquet(self.markers)

    def close(self) -> None:
        """Ends the input. Rows that arrive later than this are dropped by the streams and brought in like other late ones."""
        self._step()
        self._mark("deliveries")
        self._step()
        self._judge()
        self._mark("messages")
        self._judge()

    def _emitted(self) -> DataFrame:
        schema = "conversation_id string, message_id string, timestamp timestamp, role string, visible boolean, text string, event_time timestamp, least string, most string, text_at timestamp, n_rows long"
        return self.spark.read.schema(schema).parquet(f"{self.home}/messages")

    def _closed(self) -> bool:
        return self.spark.read.schema(self._marker_schema).parquet(self.markers).where("of = 'messages'").limit(1).count() > 0

    def late(self) -> DataFrame:
        """conversation_id, message_id and missing (deliveries) of the messages that the stream emitted without some of
        their deliveries, or not at all though the input is closed. Empty unless the stream reported late rows."""
        if not self._too_late("deliveries"):
            return self.spark.createDataFrame([], "conversation_id string, message_id string, missing long")
        there = _arranged(self.spark.read.schema(self.schema).parquet(self.source)).groupBy("conversation_id", "message_id").agg(F.count(F.lit(1)).alias("there"))
        merged = self._emitted().groupBy("conversation_id", "message_id").agg(F.sum("n_rows").alias("merged"))
        both = there.join(merged, ["conversation_id", "message_id"], "left" if self._closed() else "inner")
        return both.withColumn("missing", F.col("there") - F.coalesce("merged", F.lit(0))).where("missing > 0").select("conversation_id", "message_id", "missing")

    def _split(self) -> DataFrame:
        """Ids of the conversations with a silence that may have split them or one of their messages into sessions."""
        return self._emitted().groupBy("conversation_id").agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).where(f"b >= a + INTERVAL {self.timeout}").select("conversation_id")

    def _touched(self) -> DataFrame:
        """Ids of the conversations whose emitted rows need correction."""
        ids = self._split()
        if self._too_late("deliveries"):
            ids = ids.unionByName(self.late().select("conversation_id"))
        if self._too_late("messages"):
            judged = self._judged_once().groupBy("conversation_id").agg(F.sum("n_messages").alias("n"))
            held = self._emitted().groupBy("conversation_id").agg(F.count(F.lit(1)).alias("m"))
            ids = ids.unionByName(held.join(judged, "conversation_id", "left" if self._closed() else "inner").where("NOT n <=> m").select("conversation_id"))
        return ids.distinct()

    def _corrected(self, touched: DataFrame) -> DataFrame:
        """The messages of the touched conversations, each once, with the deliveries that came too late."""
        old = self._emitted().join(touched, "conversation_id", "left_semi")
        if not self._too_late("deliveries"):
            return _put_together(old)
        late = written(self.late(), "late-messages").select("conversation_id", "message_id")
        deliveries = _arranged(self.spark.read.schema(self.schema).parquet(self.source)).join(late, ["conversation_id", "message_id"], "left_semi")
        # one session per message: the watermark has no say in a table
        again = merge_deliveries(deliveries, "400000 days", self.lateness).select(old.columns)
        return _put_together(old.join(late, ["conversation_id", "message_id"], "left_anti").unionByName(again))

    def messages(self) -> DataFrame:
        """The messages emitted so far, each once, with all its deliveries."""
        touched = self._touched()
        return self._emitted().join(touched, "conversation_id", "left_anti").unionByName(self._corrected(touched))

    def _judged_once(self) -> DataFrame:
        return self.spark.read.schema("conversation_id string, n_messages long, n_bad long, answered boolean, valid boolean").parquet(f"{self.home}/verdicts")

    def verdicts(self) -> DataFrame:
        """The verdicts emitted so far: one row per conversation, as all its known messages have it."""
        emitted, touched = self._judged_once(), self._touched()
        again = _judged(self._corrected(touched).groupBy("conversation_id"))
        if not self._closed():
            again = again.join(emitted.select("conversation_id").distinct(), "conversation_id", "left_semi")
        return emitted.join(touched, "conversation_id", "left_anti").unionByName(again)

    def dialogues(self) -> DataFrame:
        """The turns of valid conversations: conversation_id, turn (from 1), timestamp, role, text. Equal times are ordered by message_id."""
        valid = self.verdicts().where("valid").select("conversation_id")
        turn = F.row_number().over(Window.partitionBy("conversation_id").orderBy("timestamp", "message_id"))
        return self.messages().join(valid, "conversation_id", "left_semi").select("conversation_id", turn.cast("long").alias("turn"), "message_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "role", "text")


def rebuild(spark: SparkSession, source: str, **options) -> Conversations:
    """All conversations of a parquet path, closed.

    Rows lacking an id take no part. Copies of a message count once. A conversation isn't valid if a message has
    no speaker (null in all deliveries, or different ones) or no time, or if no visible inbound message is followed,
    strictly later, by a visible outbound one; so empty and one-sided ones are out. Extra columns are ignored.
    An empty table gives no conversations.
    """
    c = Conversations(spark, source, **options)
    c.close()
    return c


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuild(spark, f"{sf_dir}/bronze.parquet").verdicts().where("NOT valid").select("conversation_id").distinct()


def p1_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuild(spark, f"{sf_dir}/bronze.parquet").dialogues()


_MESSAGES = rf"""
messages AS (
  SELECT conversation_id, message_id, min(timestamp) AS sent, CASE WHEN min(direction) = max(direction) THEN min(direction) END AS role,
         bool_or(coalesce(regexp_matches(message_body, '[^{BLANK_RE2}]'), false)) AS visible,
         arg_min(message_body, (NOT coalesce(regexp_matches(message_body, '[^{BLANK_RE2}]'), false), ingested_at, message_body)) AS text
  FROM bronze WHERE conversation_id IS NOT NULL AND message_id IS NOT NULL GROUP BY ALL),
judged AS (
  SELECT conversation_id, bool_or(role IS NULL OR sent IS NULL)
         OR NOT coalesce(min(sent) FILTER (WHERE visible AND role = 'inbound') < max(sent) FILTER (WHERE visible AND role = 'outbound'), false) AS bad
  FROM messages GROUP BY conversation_id)"""
SQL = {
    "p1_found": f"WITH {_MESSAGES} SELECT conversation_id FROM judged WHERE bad",
    "p1_dialogues": f"WITH {_MESSAGES} SELECT conversation_id, row_number() OVER (PARTITION BY conversation_id ORDER BY sent, message_id) AS turn, message_id, sent AS timestamp, role, text FROM messages WHERE conversation_id IN (SELECT conversation_id FROM judged WHERE NOT bad)",
}
