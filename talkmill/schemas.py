"""Declared table schemas, closed value sets and the comparison that guards every write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The data contract's column names and closed sets.
DIRECTIONS = ("inbound", "outbound")
STATUSES = ("delivered", "read", "sent")
MESSAGE_TYPES = ("audio", "contact", "document", "image", "location", "sticker", "text", "video")
STATUS_PRIORITY = {"read": 3, "delivered": 2, "sent": 1}
SOURCE_COLUMNS = ("message_id", "conversation_id", "timestamp", "direction", "sender_phone", "sender_name", "message_type", "message_body", "status", "channel", "campaign_id", "agent_id", "conversation_outcome", "metadata")
CLOSED = {"direction": DIRECTIONS, "message_type": MESSAGE_TYPES, "status": STATUSES}
REJECT_REASONS = {"message_id": "null_message_id", "conversation_id": "null_conversation_id"}


class OutOfRange(ValueError):
    """More rows of a batch were rejected than the installation takes without somebody's knowing."""


class SchemaDrift(ValueError):
    """A table's columns, types or closed values differ from what is declared."""


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType()}


def _struct(spec: str, **nested: T.DataType) -> T.StructType:
    """A schema from `name type` pairs; types beyond the simple ones are given by column name."""
    pairs = [x.split() for x in spec.split(",")]
    return T.StructType([T.StructField(n, nested.get(n) or _TYPES[t]) for n, t in pairs])


SOURCE = _struct(", ".join(f"{c} string" for c in SOURCE_COLUMNS))
BRONZE = _struct(", ".join(f"{c} {'timestamp_ntz' if c == 'timestamp' else 'string'}" for c in SOURCE_COLUMNS) + ", batch_id string, ingested_at timestamp, source_file_hash string")
REJECTED = T.StructType([*BRONZE.fields, T.StructField("reject_reason", T.StringType()), T.StructField("rejected_at", T.TimestampType())])
METADATA = _struct("device string, city string, state string, response_time_sec int, is_business_hours boolean, lead_source string")
SILVER = _struct(
    "message_id string, conversation_id string, timestamp timestamp, sender_phone_masked string, sender_name_normalized string, lead_id string, message_body_masked string, has_content boolean, email_domain string,"
    " has_cpf boolean, cep_prefix string, has_phone_mention boolean, plate_format string, audio_confidence string, veiculo_marca string, veiculo_modelo string, veiculo_ano int, concorrente_mencionado string,"
    " valor_pago_atual_brl double, sinistro_historico boolean, campaign_id string, agent_id string, direction string, message_type string, status string, channel string, conversation_outcome string,"
    " metadata struct, ingested_at timestamp, silver_batch_id string, source_file_hash string, transformed_at timestamp",
    metadata=METADATA,
)
CONVERSATION_SCORES = _struct(
    "conversation_id string, lead_id string, campaign_id string, agent_id string, msgs_inbound int, msgs_outbound int, first_message_at timestamp, last_message_at timestamp, duration_sec bigint, avg_lead_response_sec double,"
    " time_to_first_response_sec double, off_hours_msgs int, mencionou_concorrente boolean, concorrente_citado string, veiculo_marca string, veiculo_modelo string, veiculo_ano int, valor_pago_atual_brl double, sinistro_historico boolean, conversation_outcome string"
)
LEAD_PROFILE = _struct("lead_id string, conversations int, closed_count int, close_rate double, sender_name_normalized string, dominant_email_domain string, dominant_state string, dominant_city string, engagement_profile string, persona string, persona_confidence double, sentiment string, sentiment_confidence double, price_sensitivity string, intent_score int, first_seen_at timestamp, last_seen_at timestamp")
#: Columns of the lead profile that an outside classifier fills; null until then, so "not judged" isn't zero.
LABELS = ("engagement_profile", "persona", "persona_confidence", "sentiment", "sentiment_confidence", "price_sensitivity", "intent_score")
AGENT_PERFORMANCE = _struct("agent_id string, conversations int, closed_count int, close_rate double, avg_response_time_sec double, outcome_mix array, top_persona_converted string", outcome_mix=T.ArrayType(_struct("outcome string, count int")))
COMPETITOR_INTEL = _struct("competitor string, mention_count int, avg_quoted_price_brl double, loss_rate double, top_states array", top_states=T.ArrayType(T.StringType()))


def differences(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Missing and unexpected columns (sorted), then type differences and order; nullability doesn't count."""
    have, want = {f.name: f.dataType for f in actual}, {f.name: f.dataType for f in declared}
    plain = lambda t: t.simpleString()
    out = [f"missing column {c}" for c in sorted(want.keys() - have.keys())]
    out += [f"unexpected column {c}" for c in sorted(have.keys() - want.keys())]
    out += [f"{c}: {plain(have[c])} instead of {plain(want[c])}" for c in have if c in want and plain(have[c]) != plain(want[c])]
    if not out and list(have) != list(want):
        out.append("columns in another order: " + ", ".join(have))
    return out


def assert_schema(df: DataFrame, declared: T.StructType, table: str) -> DataFrame:
    if found := differences(df.schema, declared):
        raise SchemaDrift(f"{table}: " + "; ".join(found))
    return df


def out_of_set(closed: dict[str, tuple[str, ...]] = CLOSED) -> list[Column]:
    """Counts of non-null values outside their closed set: metrics for `observe`, which no pruning removes."""
    return [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)).alias(f"drift_{c}") for c, v in closed.items()]


def conform(df: DataFrame, declared: T.StructType, closed: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """`df` in the declared shape: unknown columns dropped, lacking ones null, types by try_cast, values outside a closed set null."""
    sets = CLOSED if closed is None else closed
    cols = []
    for f in declared:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        same = df.schema[f.name].dataType.simpleString() == f.dataType.simpleString()
        c = c if same else F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        if f.name in sets:
            c = F.when(c.isin(*sets[f.name]), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
