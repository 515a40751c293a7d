"""Pseudonymisation and generalisation as built-in column expressions."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

PSEUDONYM_PREFIX = "PSEUDO_"
PSEUDONYM_HEX_CHARS = 16

_BLOCK_BYTES = 64  # SHA-256 block size, which fixes the HMAC key length
# A key block printed as a binary literal would have 128 hex digits. Spark masks every match in plans.
REDACTION_PATTERN = "(?i)0x[0-9a-f]{64,}"

# White space as Python's str.strip understands it: Unicode spaces and the four separators 1C-1F.
_SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends (Spark's `trim` without characters removes blanks only).

    Only the ends are looked at; a regular expression would try each character of the text for the beginning of its end.
    """
    return F.btrim(text, F.lit(_SPACE))


def _key_blocks(secret: str) -> tuple[bytes, bytes]:
    key = secret.encode("utf-8")
    if len(key) > _BLOCK_BYTES:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK_BYTES, b"\0")
    # inner and outer pad bytes of RFC 2104
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def pseudonym_key(spark: SparkSession, secret: str) -> Column:
    """The padded key blocks, as a column to use in any query of the session.

    A scalar subquery over one row of data: plans, the UI and event logs name the subquery and never
    show what it returns. As literals the blocks would be printed, and they give the key away.
    """
    if not secret:
        raise ValueError("pseudonymisation needs a secret")
    inner, outer = _key_blocks(secret)
    # handed over as Arrow data, the row is a local table of the plan and takes no job to read
    blocks = spark.createDataFrame(pa.table({"inner": [inner], "outer": [outer]}))
    return blocks.select(F.struct("inner", "outer")).scalar()


def hmac_sha256_hex(message: Column, key: Column) -> Column:
    """HMAC-SHA256 of a text column, from Spark's own `sha2` so it stays in generated code."""
    inner = F.sha2(F.concat(key["inner"], F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(key["outer"], F.unhex(inner)), 256)


def pseudonymize(raw_id: Column, key: Column, hex_chars: int = PSEUDONYM_HEX_CHARS) -> Column:
    """Stable pseudonym of an identifier; a missing or empty one stays the empty string.

    Two patients who meet in `hex_chars` digits would become one: with 16, that is likely from about
    5 billion patients on; 64 digits are all there are. An identifier made of blanks only is hashed as the empty text, not treated as missing.
    """
    digest = hmac_sha256_hex(strip(raw_id), key)
    pseudonym = F.concat(F.lit(PSEUDONYM_PREFIX), F.left(digest, F.lit(hex_chars)))
    return F.when(F.coalesce(raw_id, F.lit("")) == "", F.lit("")).otherwise(pseudonym)


def birth_year(birth_date: Column) -> Column:
    """Year of a `yyyy-...` text, NULL unless the part before the first dash is four digits."""
    head = F.substring_index(strip(birth_date), "-", 1)
    return F.when(head.rlike(r"^[0-9]{4}\z"), head).try_cast("int")
