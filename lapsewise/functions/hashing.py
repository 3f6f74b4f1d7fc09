"""Pseudonymisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_hash(c) -> Column:
    """Unsalted MD5 hex digest (compatibility; guessable for names)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(c.cast("string"))


def salted_sha256(c, salt: str) -> Column:
    """Recommended pseudonym: SHA-256 of a secret salt plus the value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)
