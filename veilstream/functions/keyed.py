"""Keyed derivation inside the JVM: HMAC-SHA256, tokens and draws as column expressions.

The two HMAC pads reach a plan only through scalar subqueries over a local one-row table, so no plan
text, and no event log of plans, holds key material.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Separates purpose and message; no purpose contains it.
UNIT = b"\x1f"
#: What a null anchor hashes as.
NONE = b"\x00none"
BLOCK = 64


@dataclass(frozen=True)
class Keys:
    """Secret and clock of a run.  ``salt``: 16 bytes or more; ``reference_date``: the day ages refer to."""

    salt: bytes = field(repr=False)
    reference_date: date = date(2026, 8, 1)

    def __post_init__(self):
        if not isinstance(self.salt, (bytes, bytearray)) or len(self.salt) < 16:
            raise ValueError("the salt must be at least 16 bytes")
        if isinstance(self.reference_date, datetime):
            object.__setattr__(self, "reference_date", self.reference_date.date())
        if not isinstance(self.reference_date, date):
            raise ValueError("reference_date must be a date")

    def pads(self) -> tuple[bytes, bytes]:
        import hashlib

        key = bytes(self.salt)
        if len(key) > BLOCK:
            key = hashlib.sha256(key).digest()
        key = key.ljust(BLOCK, b"\x00")
        return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


class Kernel:
    """Column builders bound to a session and keys.

    Digests are helper columns: build all outputs first, then ``attach`` the helpers to the table the outputs are
    selected from.  Each digest is then computed once a row, however many draws and characters are cut from it, and
    the pads come in through one subquery.
    """

    PADS = "_veil_pads"

    def __init__(self, spark: SparkSession, keys: Keys, unicode: bool = True):
        """``unicode``: strings beyond ASCII are folded in Python (NFKC, casefold), which Spark has no function for."""
        self.keys, self.unicode = keys, unicode
        row = spark.createDataFrame([keys.pads()], "inner_pad binary, outer_pad binary")
        self._pads = row.select(F.struct("inner_pad", "outer_pad").alias("pads")).scalar()
        self._helpers: dict[tuple[str, str], tuple[str, Column]] = {}

    def canonical(self, c: Column, kind: T.DataType) -> Column:
        """The bytes a value hashes as: numbers as decimal text, strings folded, binary as it is; null stays null."""
        if isinstance(kind, T.BinaryType):
            return c
        if isinstance(kind, T.StringType):
            return F.encode(fold(c, self.unicode), "UTF-8")
        return F.encode(F.lower(c.cast("string")) if isinstance(kind, T.BooleanType) else c.cast("string"), "UTF-8")

    def digest(self, purpose: str, canonical: Column) -> Column:
        """HMAC-SHA256 of purpose and message as 64 hex digits; a helper column."""
        key = purpose, str(canonical)
        if key not in self._helpers:
            head = F.lit(purpose.encode() + UNIT)
            inside = F.unhex(F.sha2(F.concat(F.col(self.PADS)["inner_pad"], head, canonical), 256))
            self._helpers[key] = f"_veil_digest_{len(self._helpers)}", F.sha2(F.concat(F.col(self.PADS)["outer_pad"], inside), 256)
        return F.col(self._helpers[key][0])

    def anchor_digest(self, purpose: str, c: Column, kind: T.DataType) -> Column:
        """Digest of an entity's key; all null keys share one."""
        return self.digest(purpose, F.coalesce(self.canonical(c, kind), F.lit(NONE)))

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the helper columns of all digests asked for so far.

        They come out of a one-row generator: a join on tokens puts a null check on them below the projection, which
        would work out every digest again, and a filter on a generated column cannot sink below its generator.
        """
        if not self._helpers:
            return df
        digests = F.struct(*[c.alias(name) for name, c in self._helpers.values()])
        return df.withColumn(self.PADS, self._pads).select("*", F.inline(F.array(digests)))


def _python_fold(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFKC", v).strip().casefold().split()), na_action="ignore")


_FOLD = F.pandas_udf(_python_fold, T.StringType())
# The ASCII characters Python counts as white space.
_BLANKS = r"[\x09-\x0d\x1c-\x20]+"


def fold(c: Column, unicode: bool = True) -> Column:
    """NFKC, trimmed, inner white space collapsed, case folded.

    ASCII strings are folded in the JVM.  Others go through Arrow to Python; rows in ASCII are sent as null.
    Without ``unicode`` other characters are only lower-cased.
    """
    plain = F.trim(F.lower(F.regexp_replace(c, _BLANKS, " ")))
    if not unicode:
        return plain
    return F.coalesce(_FOLD(F.when(c.rlike(r"[^\x00-\x7f]"), c)), plain)


def token(hex_digest: Column) -> Column:
    """The first 120 bits in base 32: 24 characters."""

    def part(i: int) -> Column:
        digits = F.lpad(F.conv(F.substring(hex_digest, 10 * i + 1, 10), 16, 32), 8, "0")
        return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    return F.concat(part(0), part(1), part(2))


def draw(hex_digest: Column, slot: int, n: int) -> Column:
    """A number in [0, n) from one of eight 4-byte windows."""
    return F.conv(F.substring(hex_digest, 8 * slot + 1, 8), 16, 10).cast("bigint") % F.lit(n)


def signed_draw(hex_digest: Column, slot: int, span: int) -> Column:
    """A number in [-span, span]."""
    return draw(hex_digest, slot, 2 * span + 1) - F.lit(span)


def pick(hex_digest: Column, slot: int, choices: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in choices]), (draw(hex_digest, slot, len(choices)) + 1).cast("int"))


def clamp(c: Column, kind: T.DataType) -> Column:
    """A decimal kept inside the range of int or bigint; null stays null (greatest and least would skip it)."""
    low, high = (-(2**31), 2**31 - 1) if isinstance(kind, T.IntegerType) else (-(2**63), 2**63 - 1)
    wide = "decimal(38,0)"
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high).cast(wide)), F.lit(low).cast(wide)).cast(kind))
