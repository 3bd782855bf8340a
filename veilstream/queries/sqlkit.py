"""The keyed kernel in DuckDB's SQL, as the independent side of the comparison."""

from __future__ import annotations

from ..functions import vocabulary as V
from ..functions.keyed import Keys

#: Key of the test queries.
KEYS = Keys(b"0123456789abcdef0123456789abcdef")
_INNER, _OUTER = (p.hex() for p in KEYS.pads())
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def canonical(expr: str) -> str:
    return f"trim(lower(regexp_replace({expr}, '[\\x09-\\x0d\\x1c-\\x20]+', ' ', 'g')))"


def digest(purpose: str, message: str) -> str:
    """Hex HMAC-SHA256 of a VARCHAR expression."""
    inside = f"sha256(from_hex('{_INNER}') || encode('{purpose}' || chr(31) || {message}))"
    return f"sha256(from_hex('{_OUTER}') || from_hex({inside}))"


def token(h: str) -> str:
    return (
        f"array_to_string(list_transform(range(24), lambda i: substr('{_ALPHABET}', 1 + ((('0x' || substr({h}, (10 * (i // 8) + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), '')"
    )


def draw(h: str, slot: int, n: int) -> str:
    return f"(('0x' || substr({h}, {8 * slot + 1}, 8))::BIGINT % {n})"


def signed(h: str, span: int) -> str:
    return f"({draw(h, 0, 2 * span + 1)} - {span})"


def pick(h: str, slot: int, choices: list[str]) -> str:
    return f"[{', '.join(repr(c) for c in choices)}][{draw(h, slot, len(choices))} + 1]"


def _mailbox(names: list[str]) -> list[str]:
    return ["".join(c for c in n.casefold() if c.isascii() and (c.isalnum() or c == ".")) for n in names]


def synthetic(kind: str, h: str) -> str:
    return {
        "first_name": pick(h, 0, V.FIRST_NAMES), "middle_name": pick(h, 0, V.FIRST_NAMES), "last_name": pick(h, 0, V.LAST_NAMES), "city": pick(h, 0, V.CITIES),
        "full_name": f"{pick(h, 0, V.FIRST_NAMES)} || ' ' || {pick(h, 1, V.LAST_NAMES)}",
        "email": f"{pick(h, 0, _mailbox(V.FIRST_NAMES))} || '.' || {pick(h, 1, _mailbox(V.LAST_NAMES))} || lpad({draw(h, 2, 100)}::VARCHAR, 2, '0') || '@' || {pick(h, 3, V.EMAIL_DOMAINS)}",
        "phone": f"'(' || {pick(h, 0, V.AREA_CODES)} || ') 555-01' || lpad({draw(h, 1, 100)}::VARCHAR, 2, '0')",
        "street_address": f"({draw(h, 0, 9999)} + 1)::VARCHAR || ' ' || {pick(h, 1, V.STREET_NAMES)} || ' ' || {pick(h, 2, V.STREET_TYPES)}",
        "postal_code": f"lpad({draw(h, 0, 100_000)}::VARCHAR, 5, '0')",
        "company": f"{pick(h, 0, V.COMPANY_HEADS)} || ' ' || {pick(h, 1, V.COMPANY_TAILS)}",
    }[kind]


def zip3(expr: str) -> str:
    digits = f"regexp_replace({expr}, '[^0-9]', '', 'g')"
    areas = ", ".join(f"'{z}'" for z in V.RESTRICTED_ZIP3)
    return f"CASE WHEN length({digits}) >= 5 THEN CASE WHEN substr({digits}, 1, 3) IN ({areas}) THEN '000' ELSE substr({digits}, 1, 3) END END"


def icd10(expr: str) -> str:
    head = f"substr(upper(trim({expr}, E' \\t\\r\\n')), 1, 3)"
    return f"CASE WHEN regexp_full_match({head}, '[A-Z][0-9][A-Z0-9]') THEN {head} END"


def age_band(age: str, cap: int | None) -> str:
    band = f"(({age}) // 10 * 10)::VARCHAR || '-' || (({age}) // 10 * 10 + 9)::VARCHAR"
    top = f"WHEN {age} > {cap} THEN '{cap + 1}+' " if cap is not None else ""
    return f"CASE WHEN {age} < 0 OR {age} IS NULL THEN NULL {top}ELSE {band} END"


_ISO = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2})?(\.\d{1,9})?(Z|[+-]\d{2}:?\d{2})?)?$"


def shift_zoned(expr: str, days: str) -> str:
    """For strings with a time of day."""
    at = lambda i: f"regexp_extract({expr}, '{_ISO}', {i})"
    micros = f"rpad(substr({at(4)}, 2, 6), 6, '0')"
    return (
        f"CASE WHEN try_cast({at(1)} AS DATE) IS NOT NULL AND {at(2)} <> '' THEN strftime(try_cast({at(1)} AS DATE) + ({days})::INT, '%Y-%m-%d') || 'T' || {at(2)} || CASE WHEN {at(3)} = '' THEN ':00' ELSE {at(3)} END"
        f" || CASE WHEN {at(4)} = '' OR {micros} = '000000' THEN '' ELSE '.' || {micros} END || regexp_replace({at(5)}, '^([+-]\\d{{2}})(\\d{{2}})$', '\\1:\\2') END"
    )
