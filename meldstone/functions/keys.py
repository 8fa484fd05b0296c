"""Entity identifiers and change hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def corporate_id(name: Column, address: Column) -> Column:
    """First 16 hex digits of SHA-256 over 'name|address'."""
    return F.substring(F.sha2(F.concat(name, F.lit("|"), address), 256), 1, 16)


def corporate_id_md5(name: Column, address: Column, city: Column) -> Column:
    """The alternative identifier: MD5 over name, address and city."""
    return F.md5(F.concat(name, address, city))


def entity_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the named columns.

    Each value is preceded by its length, so neither a separator inside of a value nor a
    NULL can be mistaken for something else.
    """
    texts = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def hash_fraction(key: Column) -> Column:
    """Evenly spread integer in [0, 2^32) that depends on the key alone."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
