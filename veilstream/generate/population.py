"""A deterministic synthetic clinic: the same seed gives the same rows on any cluster and partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..operators.apportion import largest_remainder, spread_instants
from ..operators.identify import dense_ids
from ..session import cut

# How many of each, and the awkward cases that are always there.
AMOUNTS = ["0.00", "0.07", "1234.56", "0.10", "99999999.99"]
ODD_NAMES = ["Étienne", "Łucja", "Søren", "José", "Zoë", "Björk"]
SPECIALTIES = "cardiology dermatology pediatrics oncology neurology".split()
CODES = "E11.9 I10 J45.909 M54.5 G43.009 C4A.70 F32.1 N39.0".split()
PROCEDURES = "99213 99214 93000 80053 71046 36415".split()
STATUSES = ["scheduled", "checked_in", "completed", "cancelled", "no_show"]
STATES = "OH PA NC CO MA OR".split()
LOCATIONS = ["Main clinic, room 4", "North annex", "Lab building", None]


@dataclass(frozen=True)
class Size:
    providers: int = 12
    patients: int = 250
    appointments: int = 900
    claims: int = 500
    notes: int = 750
    null_emails: int = 8
    null_ssns: int = 10
    over_89: int = 3
    leading_zero_zips: int = 4
    empty_codes: int = 3


class Draws:
    """Draws that depend on seed, name and row number only."""

    def __init__(self, seed: int):
        self.seed = seed

    def number(self, name: str, row: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(f"{self.seed}:{name}"), row), F.lit(n))

    def choice(self, name: str, row: Column, values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (self.number(name, row, len(values)) + 1).cast("int"))


def _digits(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def npi(row: Column, d: Draws) -> Column:
    """Ten digits with the check digit of the prefix 80840."""
    body = _digits(d.number("npi", row, 100_000_000), 8)
    nine = F.concat(F.lit("1"), body)
    full = F.concat(F.lit("80840"), nine)
    total = F.lit(0)
    for i in range(14):
        x = F.substring(full, i + 1, 1).cast("int")
        if i % 2 == 1:
            x = F.when(x * 2 > 9, x * 2 - 9).otherwise(x * 2)
        total = total + x
    return F.concat(nine, F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))


def _ssn(row: Column, d: Draws) -> Column:
    """A social security number of an area never issued, in one of five spellings."""
    a, b, c = F.concat(F.lit("9"), _digits(d.number("s1", row, 100), 2)), _digits(d.number("s2", row, 99) + 1, 2), _digits(d.number("s3", row, 9999) + 1, 4)
    forms = [F.concat_ws("-", a, b, c), F.concat(a, b, c), F.concat_ws(" ", a, b, c), F.concat_ws(".", a, b, c), F.concat(F.lit("SSN "), F.concat_ws("-", a, b, c))]
    return F.element_at(F.array(*forms), (d.number("sf", row, len(forms)) + 1).cast("int"))


def _phone(row: Column, d: Draws) -> Column:
    """A telephone number of the range kept for fiction, in one of six spellings."""
    area, last = d.choice("pa", row, V.AREA_CODES), F.concat(F.lit("01"), _digits(d.number("pl4", row, 100), 2))
    forms = [
        F.concat(F.lit("("), area, F.lit(") 555-"), last), F.concat_ws("-", area, F.lit("555"), last), F.concat_ws(".", area, F.lit("555"), last), F.concat(area, F.lit("555"), last),
        F.concat(F.lit("+1 "), area, F.lit(" 555 "), last), F.concat(F.lit("1-"), area, F.lit("-555-"), last),
    ]
    return F.element_at(F.array(*forms), (d.number("pf6", row, len(forms)) + 1).cast("int"))


def _born(row: Column, d: Draws, size: Size) -> Column:
    """Some over 89, and of the others a fifth children, half grown up, the rest old, as of 2026."""
    days = F.when(d.number("age", row, 10) < 2, d.number("kid", row, 17 * 365)).when(d.number("age", row, 10) < 7, 17 * 365 + d.number("adult", row, 45 * 365)).otherwise(62 * 365 + d.number("old", row, 25 * 365))
    return F.when(row < size.over_89, F.date_add(F.lit("1930-03-01").cast("date"), row.cast("int"))).otherwise(F.date_sub(F.lit("2026-01-01").cast("date"), days.cast("int")))


def _intake(v: Column, d: Draws, name: Column, phone: Column) -> Column:
    """Answers of changing shape: none, empty, flat, nested with a contact, lists."""
    contact = F.struct(F.struct(name.alias("name"), phone.alias("phone")).alias("emergency_contact"), (d.number("pain", v, 11)).cast("int").alias("pain_scale"))
    flat = F.struct((d.number("smoke", v, 2) == 1).alias("smoker"), d.choice("why", v, ["cough", "rash", "check-up", "back pain"]).alias("reason"))
    listed = F.struct(F.array(d.choice("al1", v, ["dust", "latex", "nuts"]), d.choice("al2", v, ["pollen", "penicillin"])).alias("allergies"), F.struct(F.array(F.struct(d.choice("med", v, ["A", "B"]).alias("drug"), F.lit(10).alias("mg"))).alias("list")).alias("medication"))
    return F.element_at(F.array(F.lit(None).cast("string"), F.lit("{}"), F.to_json(flat), F.to_json(contact), F.to_json(listed)), (d.number("ia", v, 5) + 1).cast("int"))


def population(spark: SparkSession, seed: int = 42, size: Size = Size()) -> dict[str, DataFrame]:
    """providers, patients, appointments, claims, notes in exactly the asked sizes, consistent with each other.

    Claims and notes belong to existing visits and carry their patient; a few patients have many visits and some
    none; no two visits of a patient share an instant.  A visit has the instants its status calls for; an adjudicated
    claim's parts add up and a denied one pays nothing; a note that another amends says so.  Some notes name their
    patient.  ``violations`` checks all of this.
    """
    d = Draws(seed)
    i = F.col("id")
    day = lambda name, row, span, start="2023-01-01": F.date_add(F.lit(start).cast("date"), d.number(name, row, span).cast("int"))
    stamp = lambda name, row, span: F.timestamp_micros(F.unix_micros(day(name, row, span).cast("timestamp")) + (8 * 3600 + d.number(name + ":t", row, 36) * 900) * 1_000_000)
    later = lambda c, minutes: F.timestamp_micros(F.unix_micros(c) + minutes * 60_000_000)
    providers = spark.range(size.providers).select(
        (i + 1).alias("provider_id"), npi(i, d).alias("npi"), F.concat_ws(" ", d.choice("pf", i, V.FIRST_NAMES), d.choice("pl", i, V.LAST_NAMES)).alias("full_name"),
        d.choice("ps", i, SPECIALTIES).alias("specialty"), F.concat(F.lit("p"), i.cast("string"), F.lit("@example.org")).alias("email"), stamp("pc", i, 300).alias("created_at"), later(stamp("pc", i, 300), 60).alias("updated_at"),
    )
    odd = size.null_emails
    first = F.when(i.between(odd, odd + len(ODD_NAMES) - 1), F.element_at(F.array(*[F.lit(x) for x in ODD_NAMES]), (F.greatest(F.least(i - odd, F.lit(len(ODD_NAMES) - 1)), F.lit(0)) + 1).cast("int"))).otherwise(d.choice("f", i, V.FIRST_NAMES))
    zips = F.when(i < size.leading_zero_zips, _digits(d.number("z0", i, 9999) + 1, 5)).otherwise(_digits(d.number("z", i, 89_999) + 10_000, 5))
    patients = spark.range(size.patients).select(
        (i + 1).alias("patient_id"), F.concat(F.lit("MRN-"), _digits(i + 1, 6)).alias("mrn"), first.alias("first_name"), F.when(d.number("mid", i, 3) == 0, d.choice("m", i, V.FIRST_NAMES)).alias("middle_name"),
        d.choice("l", i, V.LAST_NAMES).alias("last_name"), _born(i, d, size).alias("date_of_birth"), F.when(i >= size.null_ssns, _ssn(i, d)).alias("ssn"),
        F.when(i >= size.null_emails, F.concat(F.lit("u"), i.cast("string"), F.lit("@example.com"))).alias("email"), F.when(d.number("nophone", i, 20) > 0, _phone(i, d)).alias("phone"),
        F.concat_ws(" ", (d.number("hn", i, 9000) + 1).cast("string"), d.choice("sn", i, V.STREET_NAMES), d.choice("st", i, V.STREET_TYPES)).alias("address_line1"),
        F.when(d.number("apt", i, 4) == 0, F.concat(F.lit("Apt "), (d.number("aptno", i, 40) + 1).cast("string"))).alias("address_line2"), d.choice("city", i, V.CITIES).alias("city"), d.choice("state", i, STATES).alias("state"),
        zips.alias("postal_code"), stamp("cr", i, 600).alias("created_at"), later(stamp("cr", i, 600), 5 + d.number("up", i, 90_000)).alias("updated_at"),
    )
    # a heavy head: weight falls with the square of the rank; the last tenth has no visit
    weight = F.when(i < size.patients * 9 / 10, 1 / ((i + 1) * (i + 1)) + F.lit(0.004)).otherwise(F.lit(0.0))
    visits = largest_remainder(spark.range(size.patients), "id", weight, size.appointments, "n")
    visits = visits.where("n > 0").select((i + 1).alias("patient_id"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k"))
    v = F.col("appointment_id")
    base = dense_ids(visits, ["patient_id", "k"], "appointment_id").select(v, "patient_id", (d.number("prov", v, size.providers) + 1).alias("provider_id"), stamp("at", v, 1000).alias("scheduled_at"), d.choice("st", v, STATUSES).alias("status"))
    base = cut(spread_instants(base, ["patient_id"], "scheduled_at", "appointment_id"))
    who = patients.select("patient_id", "mrn", F.concat_ws(" ", "first_name", "last_name").alias("_name"), "phone")
    at, status = F.col("scheduled_at"), F.col("status")
    arrived, left = later(at, d.number("in", v, 25) - 10), later(at, 15 + d.number("out", v, 90))
    appointments = base.join(who, "patient_id").select(
        v, "patient_id", "provider_id", "scheduled_at", F.when(status.isin("checked_in", "completed"), arrived).alias("checked_in_at"), F.when(status == "completed", left).alias("completed_at"),
        d.choice("dur", v, [15, 20, 30, 45, 60]).alias("duration_minutes"), "status", d.choice("loc", v, LOCATIONS).alias("location_name"), _intake(v, d, F.col("_name"), F.col("phone")).alias("intake_answers"),
        later(at, -1440 - d.number("bk", v, 40_000)).alias("created_at"), F.when(status == "completed", left).when(status == "checked_in", arrived).otherwise(later(at, -60)).alias("updated_at"),
    )
    owner = base.select("appointment_id", "patient_id", "provider_id", "scheduled_at")
    claims = spark.range(size.claims).withColumn("appointment_id", d.number("cv", i, size.appointments) + 1).join(owner, "appointment_id")
    amount = F.when(i < len(AMOUNTS), F.element_at(F.array(*[F.lit(a) for a in AMOUNTS]), (F.least(i, F.lit(len(AMOUNTS) - 1)) + 1).cast("int")).cast("decimal(12,2)")).otherwise((d.number("amt", i, 500_000) / 100).cast("decimal(12,2)"))
    codes = F.when(i < size.empty_codes, F.array().cast("array<string>")).otherwise(F.array(d.choice("c1", i, CODES), d.choice("c2", i, CODES)))
    judged, paid = F.col("claim_status").isin("paid", "denied"), F.col("claim_status") == "paid"
    claims = claims.withColumn("billed_amount", amount).withColumn("claim_status", d.choice("cs", i, ["submitted", "pending", "paid", "denied"]))
    money = lambda c: c.cast("decimal(12,2)")
    claims = claims.withColumn("allowed_amount", F.when(judged, money(F.col("billed_amount") * (60 + d.number("al", i, 41)) / 100)))
    claims = claims.withColumn("paid_amount", F.when(paid, money(F.col("allowed_amount") * (50 + d.number("pd", i, 51)) / 100)).when(judged, money(F.lit(0))))
    sent = later(F.col("scheduled_at"), 1440)
    claims = claims.select(
        (i + 1).alias("claim_id"), "patient_id", F.when(i % 20 != 19, F.col("appointment_id")).alias("appointment_id"), "billed_amount", "allowed_amount", "paid_amount",
        F.when(judged, money(F.col("allowed_amount") - F.col("paid_amount"))).alias("patient_responsibility"), codes.alias("diagnosis_codes"), d.choice("proc", i, PROCEDURES).alias("procedure_code"), "claim_status",
        sent.alias("submitted_at"), F.when(judged, later(sent, 2880 + d.number("ad", i, 20_000))).alias("adjudicated_at"), sent.alias("created_at"), F.when(judged, later(sent, 2880 + d.number("ad", i, 20_000))).otherwise(sent).alias("updated_at"),
    )
    notes = spark.range(size.notes).withColumn("appointment_id", d.number("nv", F.when(i % 25 == 24, i - 1).otherwise(i), size.appointments) + 1).join(owner, "appointment_id").join(who, "patient_id")
    seen = F.concat(F.lit("Seen for "), d.choice("nb", i, ["a cough.", "a rash.", "a check."]))
    body = F.element_at(F.array(
        seen, F.concat(seen, F.lit(" "), F.col("_name"), F.lit(" asks for a copy of the letter.")), F.concat(seen, F.lit(" Chart no. "), F.col("mrn"), F.lit(".")),
        F.concat(seen, F.lit(" Call back on "), F.coalesce("phone", F.lit("the number on file")), F.lit(".")),
    ), (d.number("bf", i, 4) + 1).cast("int"))
    amends = F.when(i % 25 == 24, i)  # the note before it, of the same visit
    notes = notes.select(
        (i + 1).alias("note_id"), "patient_id", "provider_id", "appointment_id", amends.alias("amends_note_id"), d.choice("nt", i, ["progress", "discharge", "telephone"]).alias("note_type"), body.alias("body"),
        F.col("scheduled_at").alias("authored_at"), F.when(d.number("sg", i, 10) > 0, later(F.col("scheduled_at"), 30)).alias("signed_at"), ((i % 25 == 23) & (i + 1 < size.notes)).alias("is_amended"),
        F.col("scheduled_at").alias("created_at"), later(F.col("scheduled_at"), 30).alias("updated_at"),
    )
    return {"providers": providers, "patients": patients, "appointments": appointments, "claims": claims, "notes": notes}


def violations(tables: dict[str, DataFrame], size: Size = Size()) -> DataFrame:
    """check, n_bad: what of a population is not as promised (all 0 for ``population``): counts, planted cases, consistency."""
    p, a, c, n = (tables[t] for t in ("patients", "appointments", "claims", "notes"))
    bad = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
    off = lambda cond, want: F.abs(F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)) - want)
    judged = F.col("claim_status").isin("paid", "denied")
    parts = [(t, df, {f"{t}_count": F.abs(F.count(F.lit(1)) - getattr(size, t))}) for t, df in tables.items()]
    parts += [
        ("patients", p, {
            "null_emails": off(F.col("email").isNull(), size.null_emails), "null_ssns": off(F.col("ssn").isNull(), size.null_ssns), "leading_zero_zips": off(F.col("postal_code").startswith("0"), size.leading_zero_zips),
            "over_89": off(F.col("date_of_birth") < F.lit("1936-01-01").cast("date"), size.over_89), "odd_names_missing": F.greatest(F.lit(0), len(ODD_NAMES) - F.count_if(F.col("first_name").isin(ODD_NAMES))),
            "ssn_forms_missing": 5 - F.count_distinct(F.regexp_replace("ssn", r"\d", "9")), "phone_forms_missing": 6 - F.count_distinct(F.regexp_replace("phone", r"\d", "9")), "mrn_repeated": F.count(F.lit(1)) - F.count_distinct("mrn"),
        }),
        ("appointments", a, {
            "status_and_arrival": bad(F.col("status").isin("checked_in", "completed") != F.col("checked_in_at").isNotNull()), "status_and_end": bad((F.col("status") == "completed") != F.col("completed_at").isNotNull()),
            "ends_before_arrival": bad(F.col("completed_at") < F.col("checked_in_at")), "instants_shared": F.count(F.lit(1)) - F.count_distinct("patient_id", "scheduled_at"),
        }),
        ("claims", c, {
            "judged_without_parts": bad(judged != (F.col("allowed_amount").isNotNull() & F.col("adjudicated_at").isNotNull())), "parts_do_not_add_up": bad(F.col("paid_amount") + F.col("patient_responsibility") != F.col("allowed_amount")),
            "denied_but_paid": bad((F.col("claim_status") == "denied") & (F.col("paid_amount") != 0)), "allowed_more_than_billed": bad(F.col("allowed_amount") > F.col("billed_amount")), "empty_codes": off(F.size("diagnosis_codes") == 0, size.empty_codes),
            "amounts_missing": F.greatest(F.lit(0), len(AMOUNTS) - F.count_distinct(F.when(F.col("billed_amount").cast("string").isin(AMOUNTS), F.col("billed_amount")))),
        }),
    ]
    out = None
    for _, df, checks in parts:
        one = df.agg(*[v.cast("bigint").alias(k) for k, v in checks.items()])
        one = one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n_bad")) for k in checks])).alias("c")).select("c.*")
        out = one if out is None else out.unionByName(one)
    owners = a.select("appointment_id", F.col("patient_id").alias("_p"))
    for t, df in (("claims", c), ("notes", n)):
        lost = df.where("appointment_id IS NOT NULL").join(owners, "appointment_id", "left").where("_p IS NULL OR _p <> patient_id")
        out = out.unionByName(lost.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit(f"{t}_of_other_patients").alias("check"), "n_bad"))
    amended = n.where("amends_note_id IS NOT NULL").select(F.col("amends_note_id").alias("note_id")).distinct().withColumn("_is", F.lit(True))
    other = n.select(F.col("note_id").alias("amends_note_id"), F.col("patient_id").alias("_p"))
    lost = n.where("amends_note_id IS NOT NULL").join(other, "amends_note_id", "left").where("_p IS NULL OR _p <> patient_id")
    out = out.unionByName(lost.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit("amended_notes_of_other_patients").alias("check"), "n_bad"))
    flags = n.select("note_id", "is_amended").join(amended, "note_id", "full").where("coalesce(is_amended, false) <> coalesce(_is, false)")
    return out.unionByName(flags.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit("amended_flags").alias("check"), "n_bad"))
