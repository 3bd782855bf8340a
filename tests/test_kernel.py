import base64
import hashlib
import hmac
import unicodedata
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilstream.functions import keyed, synthetic

KEYS = keyed.Keys(bytes(range(1, 33)), date(2026, 8, 1))


def canonical(v):
    if v is None:
        return b"\x00none"
    if isinstance(v, bool):
        return b"true" if v else b"false"
    if isinstance(v, int):
        return str(v).encode()
    return " ".join(unicodedata.normalize("NFKC", v).strip().casefold().split()).encode()


def model(purpose, v):
    return hmac.new(KEYS.salt, purpose.encode() + b"\x1f" + canonical(v), hashlib.sha256).digest()


TEXTS = ["MRN-000482", "  mrn-000482 ", "Straße", "ＡＢＣ", "a\t b\n c", "", "İstanbul", "é", "é", "ß ß", "x" * 5000, "Ω"]


@pytest.mark.parametrize("kind,values", [("string", TEXTS), ("bigint", [0, -1, 2**63 - 1, -(2**63), 42]), ("boolean", [True, False])])
def test_digest_equals_hmac(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    k = keyed.Kernel(spark, KEYS)
    d = k.digest("hmac:p", k.canonical(F.col("v"), df.schema["v"].dataType))
    outs = [d.alias("h"), keyed.token(d).alias("t"), keyed.draw(d, 3, 97).alias("d"), keyed.signed_draw(d, 0, 730).alias("s")]
    for r in k.attach(df).select("v", *outs).collect():
        want = model("hmac:p", r.v)
        assert r.h.lower() == want.hex()
        assert r.t == base64.b32encode(want[:15]).decode()
        assert r.d == int.from_bytes(want[12:16], "big") % 97
        assert r.s == int.from_bytes(want[:4], "big") % 1461 - 730


def test_null_anchor_shares_one_draw_and_null_value_stays_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    k = keyed.Kernel(spark, KEYS)
    a, b = k.anchor_digest("date_shift", F.col("v"), T.StringType()), k.digest("x", k.canonical(F.col("v"), T.StringType()))
    r = k.attach(df).select(a.alias("a"), b.alias("b")).first()
    assert r.a.lower() == model("date_shift", None).hex() and r.b is None


def test_no_plan_shows_key_material(spark, capsys):
    k = keyed.Kernel(spark, KEYS)
    df = spark.range(3)
    d = keyed.token(k.digest("hmac:p", k.canonical(F.col("id"), T.LongType())))
    out = k.attach(df).select(d.alias("t"))
    out.collect()
    out.explain("extended")
    out.explain("codegen")
    text = capsys.readouterr().out.lower()
    for pad in (*KEYS.pads(), KEYS.salt):
        assert pad.hex() not in text and pad.hex()[:24] not in text
    assert KEYS.salt.hex() not in repr(KEYS)


def test_keys_are_checked():
    with pytest.raises(ValueError):
        keyed.Keys(b"short")
    assert keyed.Keys(bytes(16), datetime(2026, 1, 2, 3)).reference_date == date(2026, 1, 2)


def test_every_kind_gives_a_value(spark):
    k = keyed.Kernel(spark, KEYS)
    df = spark.range(50)
    d = k.digest("fake", k.canonical(F.col("id"), T.LongType()))
    outs = [synthetic.synthetic(kind, d).alias(kind) for kind in synthetic.KINDS]
    for r in k.attach(df).select(*outs).collect():
        assert all(r[kind] for kind in synthetic.KINDS)
        assert r.phone[5:].startswith(" 555-01") and len(r.postal_code) == 5
        assert r.email.isascii() and r.email.count("@") == 1


def test_clamp(spark):
    df = spark.createDataFrame([(str(2**70),), (str(-(2**70)),), ("5",)], "v string")
    got = [tuple(r) for r in df.select(keyed.clamp(F.col("v").cast("decimal(38,0)"), T.IntegerType()), keyed.clamp(F.col("v").cast("decimal(38,0)"), T.LongType())).collect()]
    assert got == [(2**31 - 1, 2**63 - 1), (-(2**31), -(2**63)), (5, 5)]
