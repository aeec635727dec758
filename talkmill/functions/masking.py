"""Masks and extractions over message bodies, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkmill.functions.text import strip

# The patterns of the data contract (Java dialect).
EMAIL = r"\b([A-Za-z0-9._%+\-]+)@([A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*)\.([A-Za-z]{2,})\b"
CPF = r"\b\d{3}\.\d{3}\.\d{3}-?\d{2}\b"
CEP = r"\b\d{5}-?\d{3}\b"
PHONE = r"(?<!\d)(?:\+?55\s?-?)?\(?\d{2}\)?\s?-?9?\d{4}[\s\-]?\d{4}(?!\d)"
PHONE_TAIL = r"(?<!\d)(?:\+?55\s?-?)?\(?\d{2}\)?\s?-?9?\d{4}[\s\-]?\d{2}(\d{2})(?!\d)"
PLATE_NEW = r"\b([A-Z]{3})(\d)([A-Z])(\d{2})\b"
PLATE_OLD = r"\b[A-Z]{3}-?(\d{2})(\d{2})\b"
NOISE_MARKERS = ("[inaudivel]", "[inaudível]", "[ruido]", "[ruído]", "[unintelligible]", "[...]", "???")
SHORTEST_CLEAR = 10


def mask_email(c: Column) -> Column:
    """First letter of the local part and of the host, stars (at least four) for the rest, the top domain kept."""
    gaps = F.split(c, EMAIL, -1)
    part = lambda i: F.regexp_extract_all(c, F.lit(EMAIL), F.lit(i))
    stars = lambda s: F.concat(F.substring(s, 1, 1), F.repeat(F.lit("*"), F.greatest(F.length(s) - 1, F.lit(4))))
    label = lambda h: F.element_at(F.split(h, r"\."), 1)
    found = F.zip_with(F.zip_with(part(1), part(2), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), part(3), lambda x, t: F.concat(stars(x["a"]), F.lit("@"), stars(label(x["b"])), F.lit("."), t))
    woven = F.zip_with(gaps, F.concat(found, F.array(F.lit(""))), lambda g, m: F.concat(g, m))
    return F.when(c.rlike(EMAIL), F.array_join(woven, "")).otherwise(c)


def mask_cpf(c: Column, pattern: str = CPF) -> Column:
    return F.regexp_replace(c, pattern, "***.***.***-**")


def mask_cep(c: Column, pattern: str = CEP) -> Column:
    return F.regexp_replace(c, pattern, "*****-***")


def mask_phone(c: Column) -> Column:
    return F.regexp_replace(c, PHONE_TAIL, r"+55 (**) *****-**$1")


def mask_plates(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, PLATE_NEW, r"***$2$3**"), PLATE_OLD, r"***-**$2")


#: Patterns that an override may replace for a batch.
REPLACEABLE = {"cpf": CPF, "cep": CEP, "phone": PHONE}


def mask_body(c: Column, patterns: dict[str, str] | None = None) -> Column:
    """All masks in the order that matters: formatted numbers before phones. `patterns` may replace those of `cpf` and `cep`."""
    own = REPLACEABLE | (patterns or {})
    return mask_plates(mask_phone(mask_cep(mask_cpf(mask_email(c), own["cpf"]), own["cep"])))


def mask_sender(c: Column) -> Column:
    """A phone column: masked; values without a phone lose all their digits; empty is null."""
    masked = mask_phone(c)
    return F.when(F.length(c) > 0, F.when(c.rlike(PHONE), masked).otherwise(F.regexp_replace(c, r"\d", "*")))


def mask_counts(c: Column) -> dict[str, Column]:
    """Matches of each class, counted on the text as the earlier masks left it."""
    steps = {"email": (EMAIL, mask_email), "cpf": (CPF, mask_cpf), "cep": (CEP, mask_cep), "phone": (PHONE, mask_phone), "plate_new": (PLATE_NEW, lambda x: F.regexp_replace(x, PLATE_NEW, r"***$2$3**")), "plate_old": (PLATE_OLD, None)}
    out, text = {}, c
    for name, (pattern, mask) in steps.items():
        out[name] = F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))
        text = mask(text) if mask else text
    return out


def has_content(c: Column) -> Column:
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def email_domain(c: Column) -> Column:
    return F.when(c.rlike(EMAIL), F.lower(F.concat(F.regexp_extract(c, EMAIL, 2), F.lit("."), F.regexp_extract(c, EMAIL, 3))))


def has_cpf(c: Column, pattern: str = CPF) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def cep_prefix(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\b(\d{5})-?\d{3}\b", 1), F.lit(""))


def has_phone(c: Column, pattern: str = PHONE) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def fingerprint(c: Column) -> Column:
    """16 hex digits that stand for a text in logs, where the text itself mustn't be."""
    return F.substring(F.sha2(c.cast("binary"), 256), 1, 16)


def plate_format(c: Column) -> Column:
    return F.when(c.rlike(PLATE_NEW), F.lit("mercosul")).when(c.rlike(PLATE_OLD), F.lit("old"))


def audio_confidence(kind: Column, body: Column) -> Column:
    """'low' or 'high' for audio, else null."""
    text = F.lower(F.coalesce(body, F.lit("")))
    noisy = text.rlike(r"\.{3,}")
    for m in NOISE_MARKERS:
        noisy = noisy | text.contains(m)
    short = body.isNull() | (F.length(strip(body)) < SHORTEST_CLEAR)
    return F.when(kind == "audio", F.when(noisy | short, "low").otherwise("high"))
