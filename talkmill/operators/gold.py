"""Silver rows to the analytic tables. Every "first", "last" and "top" has a total order: (timestamp, message_id, batch)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.functions import text
from talkmill.schemas import AGENT_PERFORMANCE, COMPETITOR_INTEL, CONVERSATION_SCORES, LABELS, LEAD_PROFILE

#: The outcome that counts as closed.
CLOSED = "venda_fechada"
LONG_AGO = "1900-01-01 00:00:00"


def moment() -> Column:
    """Total order of Silver rows; rows without time come first."""
    return F.struct(F.coalesce("timestamp", F.lit(LONG_AGO).cast("timestamp")).alias("t"), F.coalesce("message_id", F.lit("")).alias("m"), F.coalesce("silver_batch_id", F.lit("")).alias("b"))


def last_known(c: str, order: Column | None = None) -> Column:
    """Latest non-null value."""
    o = order if order is not None else moment()
    return F.max_by(c, F.when(F.col(c).isNotNull(), o))


def first_row(c: str) -> Column:
    """Value of the earliest row, null included."""
    return F.min_by(F.struct(F.col(c).alias("v")), moment())["v"]


def pair_deltas(silver: DataFrame) -> DataFrame:
    """response_sec: whole seconds from an outbound row to the inbound row right after it, else null."""
    w = Window.partitionBy("conversation_id").orderBy(moment())
    answered = (F.col("direction") == "inbound") & (F.lag("direction").over(w) == "outbound")
    seconds = F.timestamp_diff("SECOND", F.lag("timestamp").over(w), F.col("timestamp"))
    return silver.withColumn("response_sec", F.when(answered, seconds).cast("double"))


def conversation_scores(silver: DataFrame) -> DataFrame:
    """One row per conversation; window and aggregate share one exchange."""
    off = F.col("metadata.is_business_hours") == F.lit(False)
    out = (
        pair_deltas(silver)
        .groupBy("conversation_id")
        .agg(
            first_row("lead_id").alias("lead_id"),
            first_row("campaign_id").alias("campaign_id"),
            first_row("agent_id").alias("agent_id"),
            F.count_if(F.col("direction") == "inbound").cast("int").alias("msgs_inbound"),
            F.count_if(F.col("direction") == "outbound").cast("int").alias("msgs_outbound"),
            F.min("timestamp").alias("first_message_at"),
            F.max("timestamp").alias("last_message_at"),
            F.avg("response_sec").alias("avg_lead_response_sec"),
            F.min_by("response_sec", F.when(F.col("response_sec").isNotNull(), moment())).alias("time_to_first_response_sec"),
            F.count_if(off).cast("int").alias("off_hours_msgs"),
            F.coalesce(F.bool_or(F.col("concorrente_mencionado").isNotNull()), F.lit(False)).alias("mencionou_concorrente"),
            F.mode("concorrente_mencionado", True).alias("concorrente_citado"),
            F.mode("veiculo_marca", True).alias("veiculo_marca"),
            F.mode("veiculo_modelo", True).alias("veiculo_modelo"),
            F.mode("veiculo_ano", True).alias("veiculo_ano"),
            F.max("valor_pago_atual_brl").alias("valor_pago_atual_brl"),
            F.bool_or("sinistro_historico").alias("sinistro_historico"),
            last_known("conversation_outcome").alias("conversation_outcome"),
        )
    )
    return out.withColumn("duration_sec", F.timestamp_diff("SECOND", F.col("first_message_at"), F.col("last_message_at"))).select(*CONVERSATION_SCORES.fieldNames())


def conversation_outcomes(silver: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """keys, outcome (latest known one), last_at: one row per key."""
    return silver.groupBy(*keys).agg(last_known("conversation_outcome").alias("outcome"), F.max(moment()).alias("last_at"))


def lead_profile(silver: DataFrame) -> DataFrame:
    """One row per non-null lead: conversations, closed ones and rate, dominant values, first and last time."""
    own = silver.where(F.col("lead_id").isNotNull())
    closed = conversation_outcomes(own, ("lead_id", "conversation_id")).groupBy("lead_id").agg(F.count(F.lit(1)).cast("int").alias("conversations"), F.count_if(F.col("outcome") == CLOSED).cast("int").alias("closed_count"))
    shown = own.groupBy("lead_id").agg(
        F.mode("sender_name_normalized", True).alias("sender_name_normalized"),
        F.mode("email_domain", True).alias("dominant_email_domain"),
        F.mode("metadata.state", True).alias("dominant_state"),
        F.mode("metadata.city", True).alias("dominant_city"),
        F.min("timestamp").alias("first_seen_at"),
        F.max("timestamp").alias("last_seen_at"),
    )
    whole = closed.join(shown, "lead_id").withColumn("close_rate", F.col("closed_count") / F.col("conversations"))
    return whole.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in LABELS else F.col(f.name) for f in LEAD_PROFILE])


def label_counts(table: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """label, value, count: how often each value (null too) of the label columns occurs; one row per label and value."""
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).cast("string").alias("value")) for x in labels]))
    return table.select(each.alias("x")).groupBy("x.label", "x.value").agg(F.count(F.lit(1)).alias("count"))


def anchor(silver: DataFrame) -> DataFrame:
    """One row: the latest time of the data, the epoch if there's none."""
    return silver.agg(F.coalesce(F.max("timestamp"), F.lit("1970-01-01 00:00:00").cast("timestamp")).alias("anchor"))


def lead_aggregate(silver: DataFrame) -> DataFrame:
    """Counts, competitors, personal data and the latest conversation's outcome per non-null lead."""
    own = silver.where(F.col("lead_id").isNotNull())
    name = F.nullif(F.lower(text.strip(F.col("concorrente_mencionado"))), F.lit(""))
    counts = own.groupBy("lead_id").agg(
        F.count(F.lit(1)).alias("num_msgs"),
        F.count_if(F.col("direction") == "inbound").alias("num_msgs_inbound"),
        F.count_if(F.col("direction") == "outbound").alias("num_msgs_outbound"),
        F.count_if(F.col("metadata.is_business_hours") == F.lit(False)).alias("off_hours_msgs"),
        F.coalesce(F.bool_or(F.col("concorrente_mencionado").isNotNull()), F.lit(False)).alias("mencionou_concorrente"),
        F.count_distinct(name).alias("competitor_count"),
        F.coalesce(F.bool_or(F.col("has_cpf") | F.col("email_domain").isNotNull() | F.col("has_phone_mention")), F.lit(False)).alias("forneceu_dado_pessoal"),
        F.max("timestamp").alias("last_message_at"),
        last_known("conversation_outcome").alias("row_outcome"),
    )
    by_conversation = conversation_outcomes(own, ("lead_id", "conversation_id")).groupBy("lead_id").agg(F.max_by("outcome", F.when(F.col("outcome").isNotNull(), F.struct("last_at", "conversation_id"))).alias("outcome"))
    return counts.join(by_conversation, "lead_id")


def response_means(silver: DataFrame) -> DataFrame:
    """Mean over a lead's conversations of their mean response times."""
    means = pair_deltas(silver).groupBy("conversation_id").agg(first_row("lead_id").alias("lead_id"), F.avg("response_sec").alias("mean"))
    return means.where("lead_id IS NOT NULL").groupBy("lead_id").agg(F.avg("mean").alias("avg_lead_response_sec"))


def phrase_counts(silver: DataFrame, catalogues: dict[str, tuple[str, ...]], body: str = "message_body_masked") -> DataFrame:
    """Per non-null lead, how many phrases of each catalogue occur in its inbound texts.

    A phrase counts once per lead however many texts hold it; phrases can't straddle two messages. The flags are
    combined before the shuffle: no lead's texts are gathered.
    """
    own = silver.where(F.col("lead_id").isNotNull()).withColumn("__text", F.when(F.col("direction") == "inbound", F.coalesce(text.folded(F.col(body)), F.lit(""))).otherwise(F.lit("")))
    aggs, sums = [], {}
    for name, phrases in catalogues.items():
        flags = [f"__{name}_{i}" for i in range(len(phrases))]
        aggs += [F.max(F.col("__text").contains(text.fold(p)).cast("int")).alias(f) for p, f in zip(phrases, flags)]
        sums[name] = flags
    seen = own.groupBy("lead_id").agg(*aggs)
    return seen.select("lead_id", *[sum((F.col(f) for f in flags[1:]), F.col(flags[0])).alias(name) for name, flags in sums.items()])


def prompt_texts(silver: DataFrame, body: str = "message_body_masked", messages: int = 20, chars: int = 2000) -> DataFrame:
    """Each lead's last inbound texts in time order, a line each, cut to `chars`; '' without any. The rank bounds the rows of a lead before they're collected."""
    own = silver.where(F.col("lead_id").isNotNull())
    w = Window.partitionBy("lead_id").orderBy(moment().desc())
    last = own.where((F.col("direction") == "inbound") & F.col(body).isNotNull()).select("lead_id", moment().alias("o"), F.col(body).alias("x"), F.row_number().over(w).alias("r")).where(F.col("r") <= messages)
    lines = last.groupBy("lead_id").agg(F.array_sort(F.collect_list(F.struct("o", "x"))).alias("a")).select("lead_id", F.substring(F.array_join(F.transform("a", lambda e: e["x"]), "\n"), 1, chars).alias("prompt_text"))
    return own.select("lead_id").distinct().join(lines, "lead_id", "left").select("lead_id", F.coalesce("prompt_text", F.lit("")).alias("prompt_text"))


def agent_performance(silver: DataFrame, personas: DataFrame | None = None) -> DataFrame:
    """One row per agent (null is one too); top_persona_converted needs `personas` (lead_id, persona) and a closed conversation."""
    per = silver.groupBy("agent_id", "conversation_id").agg(last_known("conversation_outcome").alias("outcome"), first_row("lead_id").alias("lead_id"))
    counted = per.groupBy("agent_id").agg(F.count(F.lit(1)).cast("int").alias("conversations"), F.count_if(F.col("outcome") == CLOSED).cast("int").alias("closed_count"))
    answer = silver.groupBy("agent_id").agg(F.avg(F.when(F.col("direction") == "outbound", F.col("metadata.response_time_sec"))).alias("avg_response_time_sec"))
    mix = per.where("outcome IS NOT NULL").groupBy("agent_id", "outcome").agg(F.count(F.lit(1)).cast("int").alias("count")).groupBy("agent_id").agg(F.array_sort(F.collect_list(F.struct("outcome", "count"))).alias("outcome_mix"))
    out = counted.join(answer, counted["agent_id"].eqNullSafe(answer["agent_id"])).drop(answer["agent_id"]).join(mix, "agent_id", "left")
    if personas is None:
        top = out.select("agent_id", F.lit(None).cast("string").alias("top")).where("false")
    else:
        rated = per.join(personas.where("persona IS NOT NULL").select("lead_id", "persona"), "lead_id").groupBy("agent_id", "persona").agg(F.count_if(F.col("outcome") == CLOSED).alias("k"), F.count(F.lit(1)).alias("n"))
        top = rated.groupBy("agent_id").agg(F.min_by("persona", F.struct(-F.col("k") / F.col("n"), -F.col("k"), F.col("persona"))).alias("top"))
    none = F.array().cast(AGENT_PERFORMANCE["outcome_mix"].dataType)
    done = out.join(top, "agent_id", "left").withColumns({"close_rate": F.col("closed_count") / F.col("conversations"), "outcome_mix": F.coalesce("outcome_mix", none), "top_persona_converted": F.when(F.col("closed_count") > 0, F.col("top"))})
    return done.select(*AGENT_PERFORMANCE.fieldNames())


def competitor_intel(silver: DataFrame, top: int = 3) -> DataFrame:
    """Mentions, mean price, loss rate over conversations with a known outcome (taken from mentioning rows) and top states per competitor name."""
    name = F.lower(text.strip(F.col("concorrente_mencionado")))
    said = silver.where("concorrente_mencionado IS NOT NULL").withColumn("competitor", name)
    base = said.groupBy("competitor").agg(F.count(F.lit(1)).cast("int").alias("mention_count"), F.avg("valor_pago_atual_brl").alias("avg_quoted_price_brl"))
    per = said.groupBy("competitor", "conversation_id").agg(last_known("conversation_outcome").alias("outcome")).where("outcome IS NOT NULL")
    loss = per.groupBy("competitor").agg((F.count_if(F.col("outcome") != CLOSED) / F.count(F.lit(1))).alias("loss_rate"))
    states = said.where("metadata.state IS NOT NULL").groupBy("competitor", F.col("metadata.state").alias("state")).agg(F.count(F.lit(1)).alias("n"))
    best = states.groupBy("competitor").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "state"))), lambda e: e["state"]), 1, top).alias("top_states"))
    none = F.array().cast("array<string>")
    return base.join(loss, "competitor", "left").join(best, "competitor", "left").withColumn("top_states", F.coalesce("top_states", none)).select(*COMPETITOR_INTEL.fieldNames())


# Insights -----------------------------------------------------------------------------------------------------

GHOSTING_BUCKETS = ("1-2", "3-4", "5-9", "10+")
TURNS = ("first", "2nd-3rd", "4th+")
TOPICS = ("after first quote", "after price ask", "after personal data ask", "other")


def ghosting(silver: DataFrame) -> DataFrame:
    """Leads without any outcome by number of messages; rate over all leads (the null lead counts as one); empty buckets too."""
    leads = silver.groupBy("lead_id").agg(F.count(F.lit(1)).alias("n"), F.count("conversation_outcome").alias("known"))
    bucket = F.when(F.col("n") <= 2, "1-2").when(F.col("n") <= 4, "3-4").when(F.col("n") <= 9, "5-9").otherwise("10+")
    counts = leads.groupBy(bucket.alias("bucket")).agg(F.count_if(F.col("known") == 0).alias("n_leads"), F.count(F.lit(1)).alias("n_all"))
    every = silver.sparkSession.createDataFrame([(b,) for b in GHOSTING_BUCKETS], "bucket string")
    total = F.sum("n_all").over(Window.partitionBy(F.lit(1)))  # over the four buckets
    share = F.coalesce(F.try_divide(F.coalesce("n_leads", F.lit(0)), total), F.lit(0.0))
    return every.join(counts, "bucket", "left").select("bucket", F.coalesce("n_leads", F.lit(0)).alias("count"), share.alias("rate"))


def objections(silver: DataFrame, phrases: tuple[str, ...] = text.OBJECTIONS, body: str = "message_body_masked") -> DataFrame:
    """Per phrase: leads with an inbound message that holds it, and the share of them whose latest known inbound outcome is closed."""
    own = silver.where((F.col("direction") == "inbound") & F.col("lead_id").isNotNull()).withColumn("__text", F.coalesce(text.folded(F.col(body)), F.lit("")))
    flags = [F.max(F.col("__text").contains(text.fold(p)).cast("int")).alias(f"p{i}") for i, p in enumerate(phrases)]
    leads = own.groupBy("lead_id").agg(last_known("conversation_outcome").alias("outcome"), *flags)
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("phrase"), F.col(f"p{i}").alias("hit")) for i, p in enumerate(phrases)]))
    long = leads.select("outcome", pairs.alias("x")).groupBy("x.phrase").agg(F.sum("x.hit").alias("count"), F.count_if((F.col("x.hit") == 1) & (F.col("outcome") == CLOSED)).alias("closed"))
    every = silver.sparkSession.createDataFrame([(p,) for p in phrases], "phrase string")
    return every.join(long, "phrase", "left").select("phrase", F.coalesce("count", F.lit(0)).alias("count"), F.try_divide("closed", "count").alias("close_rate"))


def disengagement(silver: DataFrame, body: str = "message_body_masked") -> DataFrame:
    """Conversations whose last outbound row has no outcome, by that row's place among outbound rows and its topic; empty cells too."""
    out = silver.where((F.col("direction") == "outbound") & F.col("conversation_id").isNotNull())
    last = out.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n"), F.max_by(F.struct(F.col("conversation_outcome").alias("outcome"), F.col(body).alias("x")), moment()).alias("r")).where("r.outcome IS NULL").select("n", text.folded(F.col("r.x")).alias("x"))
    turn = F.when(F.col("n") <= 1, TURNS[0]).when(F.col("n") <= 3, TURNS[1]).otherwise(TURNS[2])
    hit = lambda p: text.any_phrase(F.col("x"), p, True)
    topic = F.when(hit(text.QUOTED), TOPICS[0]).when(hit(text.PRICE_ASKED), TOPICS[1]).when(hit(text.DATA_ASKED), TOPICS[2]).otherwise(TOPICS[3])
    cells = last.groupBy(turn.alias("turn"), topic.alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    every = silver.sparkSession.createDataFrame([(a, b) for a in TURNS for b in TOPICS], "turn string, topic string")
    return every.join(cells, ["turn", "topic"], "left").select("turn", "topic", F.coalesce("count", F.lit(0)).alias("count"))


def label_outcomes(silver: DataFrame, labels: DataFrame, label: str = "persona") -> DataFrame:
    """label, outcome, count, rate within the label: conversations (by lead and conversation) with a known outcome of labelled leads."""
    per = conversation_outcomes(silver.where("lead_id IS NOT NULL"), ("lead_id", "conversation_id")).where("outcome IS NOT NULL")
    cells = per.join(labels.where(F.col(label).isNotNull()).select("lead_id", F.col(label).alias("label")), "lead_id").groupBy("label", "outcome").agg(F.count(F.lit(1)).alias("count"))
    return cells.withColumn("rate", F.col("count") / F.sum("count").over(Window.partitionBy("label")))


def top_surprise(matrix: DataFrame) -> DataFrame:
    """The label whose closed rate is furthest from the overall one (first by name on ties), at most one row."""
    cells = Window.partitionBy(F.lit(1))  # over the matrix: a row per label and outcome
    overall = F.sum(F.when(F.col("outcome") == CLOSED, F.col("count")).otherwise(0)).over(cells) / F.sum("count").over(cells)
    shift = matrix.withColumn("overall", overall).where(F.col("outcome") == CLOSED).withColumn("delta", F.round(F.col("rate") - F.col("overall"), 9))
    return shift.orderBy(F.abs("delta").desc(), "label").limit(1).select("label", "outcome", "rate", "delta")
