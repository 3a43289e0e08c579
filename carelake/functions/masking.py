"""Masking expressions. Every one of them keeps null as null and is deterministic."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake import fixed_values as fx

#: bytes of a block of SHA-256
HMAC_BLOCK = 64


def mask_cpf(value: Column) -> Column:
    """Only the middle three digits of ``ddd.ddd.ddd-dd`` stay readable."""
    return F.concat(F.lit(fx.MASK_FILL), F.substring(value, 5, 3), F.lit(fx.MASK_FILL))


def keyed_hash(value: Column, key: str) -> Column:
    """Hex SHA-256 of value followed by key (plain concatenation, not an HMAC)."""
    return F.sha2(F.concat(value.cast("string"), F.lit(key)), 256)


def hmac_hash(value: Column, key: str | bytes) -> Column:
    """Hex HMAC-SHA-256 of the value under a key, as RFC 2104 says: unlike ``keyed_hash``, nobody can
    go on from a digest without the key, nor move characters between value and key."""
    secret = key.encode() if isinstance(key, str) else key
    secret = hashlib.sha256(secret).digest() if len(secret) > HMAC_BLOCK else secret
    inner, outer = (bytes(b ^ pad for b in secret.ljust(HMAC_BLOCK, b"\0")) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(F.lit(inner), value.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(outer), F.unhex(digest)), 256)


def mask_name(value: Column) -> Column:
    """Initial plus a six-digit digest: equal names keep equal pseudonyms."""
    digest = F.sha2(value, 256)
    return F.concat(F.substring(value, 1, 1), F.lit(fx.MASK_FILL + "_"), F.substring(digest, 1, 6))


def mask_email(value: Column) -> Column:
    """Initial plus domain; text without an ``@`` has no domain and becomes null."""
    domain = F.try_element_at(F.split(value, "@"), F.lit(2))
    return F.concat(F.substring(value, 1, 1), F.lit(fx.MASK_FILL + "@"), domain)


def mask_phone(value: Column) -> Column:
    return F.concat(F.lit(fx.PHONE_MASK_PREFIX), F.substring(value, -4, 4))


def mask_generic(value: Column, strict: bool = False) -> Column:
    """Three leading characters stay. Shorter values pass as they are unless ``strict``."""
    text = value.cast("string")
    kept = F.regexp_replace(text, fx.GENERIC_MASK_PATTERN, fx.GENERIC_MASK_REPLACEMENT)
    if not strict:
        return kept
    return F.when(F.length(text) < 3, F.lit(fx.MASK_FILL)).otherwise(kept)


def mask_for(column: str, value: Column, key: str, strict: bool = False) -> Column:
    """The technique that belongs to a column name."""
    techniques = {
        "cpf": mask_cpf,
        "nome": mask_name,
        "email": mask_email,
        "telefone": mask_phone,
        "patient_id": lambda v: keyed_hash(v, key),
        "medical_record_number": lambda v: keyed_hash(v, key),
    }
    technique = techniques.get(column, lambda v: mask_generic(v, strict))
    return technique(value)
