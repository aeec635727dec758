"""Bronze rows to Silver: quarantine, one row per message, masks, extractions, lead identity and names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.functions import lead, masking, text
from talkmill.schemas import METADATA, REJECT_REASONS, SILVER, STATUS_PRIORITY

KEYS = ("conversation_id", "message_id")


def reject_reason() -> Column:
    """Null for valid rows; a missing message_id comes before a missing conversation_id."""
    return F.when(F.col("message_id").isNull(), REJECT_REASONS["message_id"]).when(F.col("conversation_id").isNull(), REJECT_REASONS["conversation_id"])


def partition_rows(bronze: DataFrame, rejected_at: datetime | Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): two filters over one input; rejected rows have a reason and a time."""
    at = rejected_at if isinstance(rejected_at, Column) else F.lit(rejected_at)
    reason = reject_reason()
    return bronze.where(reason.isNull()), bronze.where(reason.isNotNull()).withColumns({"reject_reason": reason, "rejected_at": at.cast("timestamp")})


def status_priority(c: Column) -> Column:
    out = F.lit(0)
    for value, rank in STATUS_PRIORITY.items():
        out = F.when(c == value, rank).otherwise(out)
    return out


def dedup_events(rows: DataFrame) -> DataFrame:
    """The row of highest status, then latest time, then highest batch per message; null keys form groups of their own.

    Rows that are equal in these are ordered by their other columns, so any input order gives the same row. The rank is bounded to one row per message before the
    shuffle (WindowGroupLimit), so a message with many copies sends one row per task.
    """
    used = (*KEYS, "status", "timestamp", "batch_id")
    others = [F.col(f"`{f.name}`").asc_nulls_last() for f in rows.schema if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [status_priority(F.col("status")).desc(), F.col("timestamp").desc_nulls_last(), F.col("batch_id").desc_nulls_last(), *others]
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*KEYS).orderBy(*order))).where("__rank = 1").drop("__rank")


def parsed_metadata(c: Column) -> Column:
    """Declared struct; null for null, blank, malformed or non-object text; unknown or mistyped fields are null."""
    return F.when(F.json_object_keys(c).isNotNull(), F.from_json(c, METADATA))


def reconcile_names(rows: DataFrame, key: str = "lead_id", name: str = "sender_name_normalized") -> DataFrame:
    """Each lead's name replaced by its most frequent one (then longest, then first); rows without lead stay."""
    votes = rows.where(F.col(key).isNotNull() & F.col(name).isNotNull()).groupBy(key, name).agg(F.count(F.lit(1)).alias("n"))
    winner = votes.groupBy(key).agg(F.min_by(name, F.struct(-F.col("n"), -F.length(name), F.col(name))).alias("__winner"))
    return rows.join(winner, key, "left").withColumn(name, F.coalesce("__winner", name)).drop("__winner").select(*rows.columns)


def silver_projection(rows: DataFrame, secret: str, transformed_at: datetime | Column, exact_names: bool = True, patterns: dict[str, str] | None = None) -> DataFrame:
    """All Silver columns in one select; model-extracted ones are typed nulls. `patterns` replace built-in ones (see `masking.REPLACEABLE`)."""
    own = masking.REPLACEABLE | (patterns or {})
    at = transformed_at if isinstance(transformed_at, Column) else F.lit(transformed_at)
    body = F.col("message_body")
    made = {
        "timestamp": F.col("timestamp").cast("timestamp"),
        "sender_phone_masked": masking.mask_sender(F.col("sender_phone")),
        "sender_name_normalized": text.normalized_name(F.col("sender_name"), exact_names),
        "lead_id": lead.lead_id(F.col("sender_phone"), secret),
        "message_body_masked": masking.mask_body(body, own),
        "has_content": masking.has_content(body),
        "email_domain": masking.email_domain(body),
        "has_cpf": masking.has_cpf(body, own["cpf"]),
        "cep_prefix": masking.cep_prefix(body),
        "has_phone_mention": masking.has_phone(body, own["phone"]),
        "plate_format": masking.plate_format(body),
        "audio_confidence": masking.audio_confidence(F.col("message_type"), body),
        "metadata": parsed_metadata(F.col("metadata")),
        "silver_batch_id": F.col("batch_id"),
        "transformed_at": at.cast("timestamp"),
    }
    model = {"veiculo_marca", "veiculo_modelo", "veiculo_ano", "concorrente_mencionado", "valor_pago_atual_brl", "sinistro_historico"}
    return rows.select(*[(F.lit(None).cast(f.dataType) if f.name in model else made.get(f.name, F.col(f.name))).alias(f.name) for f in SILVER])


def silver_transform(valid: DataFrame, secret: str, transformed_at: datetime | Column, exact_names: bool = True, patterns: dict[str, str] | None = None) -> DataFrame:
    return reconcile_names(silver_projection(dedup_events(valid), secret, transformed_at, exact_names, patterns)).select(*SILVER.fieldNames())
