"""Synthetic values drawn from a digest, by kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V
from .keyed import draw, pick

KINDS = ("first_name", "middle_name", "last_name", "full_name", "email", "phone", "street_address", "city", "postal_code", "company")


def _mailbox(names: list[str]) -> list[str]:
    return ["".join(c for c in n.casefold() if c.isascii() and (c.isalnum() or c == ".")) for n in names]


def _padded(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def synthetic(kind: str, digest: Column) -> Column:
    """A value of a kind; equal digests give equal values."""
    if kind in ("first_name", "middle_name"):
        return pick(digest, 0, V.FIRST_NAMES)
    if kind == "last_name":
        return pick(digest, 0, V.LAST_NAMES)
    if kind == "full_name":
        return F.concat_ws(" ", pick(digest, 0, V.FIRST_NAMES), pick(digest, 1, V.LAST_NAMES))
    if kind == "email":
        return F.concat(pick(digest, 0, _mailbox(V.FIRST_NAMES)), F.lit("."), pick(digest, 1, _mailbox(V.LAST_NAMES)), _padded(draw(digest, 2, 100), 2), F.lit("@"), pick(digest, 3, V.EMAIL_DOMAINS))
    if kind == "phone":
        return F.concat(F.lit("("), pick(digest, 0, V.AREA_CODES), F.lit(") 555-01"), _padded(draw(digest, 1, 100), 2))
    if kind == "street_address":
        return F.concat_ws(" ", (draw(digest, 0, 9999) + 1).cast("string"), pick(digest, 1, V.STREET_NAMES), pick(digest, 2, V.STREET_TYPES))
    if kind == "city":
        return pick(digest, 0, V.CITIES)
    if kind == "postal_code":
        return _padded(draw(digest, 0, 100_000), 5)
    if kind == "company":
        return F.concat_ws(" ", pick(digest, 0, V.COMPANY_HEADS), pick(digest, 1, V.COMPANY_TAILS))
    raise ValueError(f"unknown kind {kind!r}")
