"""A lead's identity: the digits of a phone under a keyed hash, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def phone_digits(c: Column) -> Column:
    """Digits without the country code (only where 12 or 13 digits start with it); null unless 10 to 13 remain."""
    d = F.regexp_replace(c, "[^0-9]", "")
    d = F.when(F.length(d).isin(12, 13) & d.startswith("55"), F.substring(d, 3, 20)).otherwise(d)
    return F.when(F.length(d).between(10, 13), d)


def hmac_sha256(secret: str, message: Column) -> Column:
    """Hex HMAC-SHA256; the key's two pads are made on the driver."""
    import hashlib

    if not secret:
        raise ValueError("the secret must not be empty")
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (bytes(b ^ p for b in key) for p in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(F.lit(bytearray(inner)), message.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(bytearray(outer)), first), 256)


def lead_id(phone: Column, secret: str) -> Column:
    """First 16 hex digits; null where the phone is unusable."""
    return F.substring(hmac_sha256(secret, phone_digits(phone)), 1, 16)
