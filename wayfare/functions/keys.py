"""Identifiers and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def node_id(prefix: str, value: Column) -> Column:
    """`prefix:value`; NULL when the value is, so that it never becomes a shared node."""
    return F.concat(F.lit(prefix + ":"), value.cast("string"))


def email_hash(email: Column) -> Column:
    """The one place an e-mail becomes a pseudonym; staging and erasure share it."""
    return F.sha2(F.lower(F.trim(email)), 256)


def phone_hash(phone: Column) -> Column:
    """Hash of the E.164 form: a plus sign and the digits of the international number.

    A trunk zero in brackets and the dialling prefix 00 are no part of it; a
    text without digits has no number.
    """
    digits = F.regexp_replace(F.regexp_replace(phone, r"\(0\)", ""), "[^0-9]", "")
    number = F.regexp_replace(digits, "^00", "")
    return F.when(number != "", F.sha2(F.concat(F.lit("+"), number), 256))


def ip_prefix(ip: Column) -> Column:
    """IPv4 cut to its /24 network; NULL for anything that is not a clean IPv4 address."""
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return F.when(ip.rlike(rf"\A{octet}(\.{octet}){{3}}\z"), F.regexp_replace(ip, r"[0-9]+$", "0"))


def fixed(c: Column, digits: int) -> Column:
    """Round half up to `digits` by plain IEEE steps, the same in every engine."""
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
