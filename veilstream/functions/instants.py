"""ISO-8601 strings with an offset ("zoned" values): reading and shifting them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date, blank or T, time with optional fraction, Z or an offset with or without colon.
ZONED = r"^\s*\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*([Zz]|[+-]\d{2}:?\d{2})\s*$"


def read_instant(c: Column) -> Column:
    """A zoned string as timestamp; null where it cannot be read (no offset, impossible date, other text)."""
    tidy = F.upper(F.trim(c))
    tidy = F.regexp_replace(tidy, r"([+-]\d{2})(\d{2})$", "$1:$2")
    tidy = F.regexp_replace(tidy, r"([T ]\d{2}:\d{2})(Z|[+-]\d{2}:\d{2})$", "$1:00$2")
    return F.when(c.rlike(ZONED), tidy.try_cast("timestamp"))


def instant_micros(c: Column) -> Column:
    return F.unix_micros(read_instant(c))


def instant_millis(c: Column) -> Column:
    return F.unix_millis(read_instant(c))


def instant_seconds(c: Column) -> Column:
    """Whole epoch seconds, rounded down."""
    return F.unix_seconds(read_instant(c))
