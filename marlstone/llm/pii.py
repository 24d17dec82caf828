"""Personal data: format-preserving Feistel pseudonyms [DataFrame operations only].

Values that look personal are found by pattern and *validated* (Luhn digit, IBAN remainder,
octets, calendar, social-security ranges). A valid number or date is permuted by a keyed
Feistel network inside its own format: a card stays a card of the same network, length and
separators with a right check digit, a date stays a date, written as it was. The permutation
depends on the key and the kind alone, so equal values stay equal across documents and
different values of a kind stay different; who has the key can go back.

Kinds: e-mail addresses (the whole address becomes a keyed pseudonym; not reversible),
telephone numbers, payment cards, IBANs, social-security numbers, IPv4 addresses, dates of
1800 to 2199, and hexadecimal secrets of 32 to 64 digits (in chunks of 12 digits).
Numbers that fail their validation are left alone.

Scale: one projection without a shuffle; texts without a digit and without '@' skip the
patterns.

The key is an argument, else the session's setting ``spark.marlstone.pii.key``. Without either a
random key is drawn once for the application: values stay linked within it, and nobody can go
back afterwards.

Defined cases: a null text stays null, an empty one empty; an empty table gives no rows; a very
long text or value takes time in proportion to its length (the patterns match without
recursion); a date that is valid month first is
read so, else day first; repeated documents come out alike; columns of the added names are
replaced; all other columns pass.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
KEY_SETTING = "spark.marlstone.pii.key"
_DRAWN: dict[str, str] = {}
#: Splits a string into its characters.
_CHARS = r"(?<!\A)(?!\z)"

# The patterns of the kinds.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z0-9])(?=[A-Fa-f0-9]*[A-Fa-f])[A-Fa-f0-9]{32,64}(?![A-Za-z0-9])"
CARD = r"(?<![\d])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,4}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
PHONE = r"(?<![\d])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
DATE = r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-])"
KINDS = (("email", EMAIL), ("iban", IBAN), ("secret", SECRET), ("card", CARD), ("ssn", SSN), ("date", DATE), ("ipv4", IPV4), ("phone", PHONE))
ANY = "|".join(p for _, p in KINDS)

#: Days of 1800-01-01 to 2199-12-31: one whole cycle of the calendar, 189 * 773 days.
DATE_SIDES = (189, 773)
#: Social-security areas 001-899 without 666, with groups 01-99; serials 0001-9999.
SSN_SIDES = (898 * 99, 9999)


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def permuted(left: Column, right: Column, a: Column, b: Column, tweak: Column, key: str, back: bool = False) -> Column:
    """The Feistel permutation of (left, right) in a * b as a struct, or its inverse.

    Each round adds a keyed hash of one side to the other, modulo that side's size.
    """

    def hashed(i: Column, side: Column) -> Column:
        return _number(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), side.cast("string")), 256), 1, 14))

    sign = -1 if back else 1

    def step(acc: Column, i: Column) -> Column:
        on_left = i % 2 == 0
        return F.struct(
            F.when(on_left, F.pmod(acc["l"] + sign * F.pmod(hashed(i, acc["r"]), a), a)).otherwise(acc["l"]).alias("l"),
            F.when(on_left, acc["r"]).otherwise(F.pmod(acc["r"] + sign * F.pmod(hashed(i, acc["l"]), b), b)).alias("r"),
        )

    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in order]), start, step)


def _with(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _power(base: int, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(base**k) for k in range(0, 18 if base == 10 else 14)]), n + 1)


def _permuted_digits(digits: Column, kind: str, key: str, back: bool, base: int = 10) -> Column:
    """A string of 2 digits or more (20 at most; 12 in base 16), permuted."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")

    def value(s: Column) -> Column:
        return s.try_cast("long") if base == 10 else _number(s)

    def text(v: Column, width: Column) -> Column:
        return F.lpad(v.cast("string") if base == 10 else F.lower(F.hex(v)), width, "0")

    tweak = F.concat(F.lit(f"{kind}:"), n.cast("string"))
    done = permuted(value(F.substring(digits, F.lit(1), half)), value(F.substring(digits, half + 1, n - half)), _power(base, half), _power(base, n - half), tweak, key, back)
    return _with(done, lambda d: F.concat(text(d["l"], half), text(d["r"], n - half)))


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _refilled(m: Column, digits: Column, pattern: str = r"\d") -> Column:
    """``m`` with its digits (characters of ``pattern``) replaced in turn by those of ``digits``."""
    return F.aggregate(
        F.split(m, _CHARS),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.struct(
            F.concat(acc["out"], F.when(c.rlike(f"^{pattern}$"), F.substring(digits, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["at"] + c.rlike(f"^{pattern}$").cast("int")).alias("at"),
        ),
        lambda acc: acc["out"],
    )


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, the last one as the check digit."""
    return F.aggregate(
        F.transform(
            F.split(F.reverse(digits), _CHARS),
            lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).when(c.try_cast("int") > 4, 2 * c.try_cast("int") - 9).otherwise(2 * c.try_cast("int")),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )


def _card(m: Column, key: str, back: bool) -> Column:
    digits = _only_digits(m)
    inner = _permuted_digits(F.substring(digits, F.lit(2), F.length(digits) - 2), "card", key, back)
    body = F.concat(F.substring(digits, 1, 1), inner)
    made = _with(body, lambda x: F.concat(x, F.pmod(-luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))
    return F.when(F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0) & ~digits.rlike(r"^0+$"), _with(made, lambda d: _refilled(m, d)))


def _mod97(text: Column) -> Column:
    """An IBAN's remainder: letters count from 10, country and check digits come last."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    return F.aggregate(F.split(moved, _CHARS), F.lit(0), lambda a, c: F.when(c.rlike(r"\d"), (10 * a + c.try_cast("int")) % 97).otherwise((100 * a + F.ascii(c) - 55) % 97))


def _iban(m: Column, key: str, back: bool) -> Column:
    plain = F.replace(m, F.lit(" "))
    digits = _only_digits(F.substring(plain, F.lit(5), F.length(plain)))
    new = F.when(F.length(digits) >= 2, F.concat(_permuted_digits(F.substring(digits, 1, 18), "iban", key, back), F.substring(digits, F.lit(19), F.length(digits))))
    body = _refilled(F.substring(plain, F.lit(5), F.length(plain)), new)
    made = _with(F.concat(F.substring(plain, 1, 2), F.lit("00"), body), lambda x: F.concat(F.substring(x, 1, 2), F.lpad((98 - _mod97(x)).cast("string"), 2, "0"), F.substring(x, F.lit(5), F.length(x))))
    fits = F.length(plain).between(15, 34) & (_mod97(plain) == 1)
    return F.when(fits, _with(made, lambda d: F.when(d.isNotNull(), _refilled(m, d, r"[A-Z0-9]"))))


def _ipv4(m: Column, key: str, back: bool) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.try_cast("int"))
    done = permuted(256 * octets[0] + octets[1], 256 * octets[2] + octets[3], F.lit(65536), F.lit(65536), F.lit("ipv4"), key, back)
    text = lambda v: F.concat_ws(".", F.floor(v / 256).cast("string"), (v % 256).cast("string"))
    return F.when(F.forall(octets, lambda x: x <= 255), _with(done, lambda d: F.concat_ws(".", text(d["l"]), text(d["r"]))))


def _ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = (F.substring(m, a, n).try_cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    rank = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1
    done = permuted(rank, serial - 1, F.lit(SSN_SIDES[0]), F.lit(SSN_SIDES[1]), F.lit("ssn"), key, back)

    def text(d: Column) -> Column:
        a = F.floor(d["l"] / 99).cast("int") + 1
        a = F.when(a >= 666, a + 1).otherwise(a)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((d["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((d["r"] + 1).cast("string"), 4, "0"))

    fits = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(fits, _with(done, text))


def _valid_date(y: Column, mo: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")


def _date(m: Column, key: str, back: bool) -> Column:
    mark = F.regexp_extract(m, r"[/.-]", 0)
    parts = F.split(m, r"[/.-]")
    year_first = F.length(parts[0]) == 4
    month_first = _valid_date(parts[2], parts[0], parts[1])
    slash_us = ~year_first & (mark == "/") & month_first.isNotNull()
    day = F.when(year_first, _valid_date(parts[0], parts[1], parts[2])).when(slash_us, month_first).otherwise(F.when(~year_first, _valid_date(parts[2], parts[1], parts[0])))
    number = F.date_diff(day, F.lit("1800-01-01").cast("date"))
    a, b = DATE_SIDES
    done = permuted(F.floor(number / b), number % b, F.lit(a), F.lit(b), F.lit("date"), key, back)

    def text(d: Column) -> Column:
        new = F.date_add(F.lit("1800-01-01").cast("date"), (d["l"] * b + d["r"]).cast("int"))
        y, mo, dd = F.lpad(F.year(new).cast("string"), 4, "0"), F.month(new).cast("string"), F.dayofmonth(new).cast("string")
        wide = F.length(m) == 10
        mo, dd = F.when(wide, F.lpad(mo, 2, "0")).otherwise(mo), F.when(wide, F.lpad(dd, 2, "0")).otherwise(dd)
        return F.when(year_first, F.concat_ws("-", y, mo, dd)).when(slash_us, F.concat_ws("-", mo, dd, y)).otherwise(F.concat_ws("-", dd, mo, y))

    return F.when(number.between(0, a * b - 1), F.replace(_with(done, text), F.lit("-"), mark))


def _phone(m: Column, key: str, back: bool) -> Column:
    digits = _only_digits(m)
    national = F.least(F.length(digits), F.lit(10))
    own = F.substring(digits, F.length(digits) - national + 1, national)
    made = F.concat(F.substring(digits, F.lit(1), F.length(digits) - national), _permuted_digits(own, "phone", key, back))
    return F.when(F.length(digits).between(7, 15), _with(made, lambda d: _refilled(m, d)))


def _secret(m: Column, key: str, back: bool) -> Column:
    low = F.lower(m)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.length(m) - 1) / 12).cast("int")), lambda k: F.substring(low, 12 * k + 1, F.lit(12)))
    new = F.array_join(F.transform(chunks, lambda c: F.when(F.length(c) >= 2, _permuted_digits(c, "secret", key, back, 16)).otherwise(c)), "")
    return F.when(m == low, new).otherwise(F.upper(new))


def _email(m: Column, key: str) -> Column:
    name = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16)
    return F.when(F.regexp_extract(m, r"\.\p{L}{2,}\.?$", 0) != "", F.concat(F.lit("u"), name, F.lit("@pseudonym.invalid")))


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """(kind, text) of one found value; null where it fails every validation.

    ``back`` undoes all kinds but e-mail addresses.
    """
    makers = {"iban": _iban, "secret": _secret, "card": _card, "ssn": _ssn, "date": _date, "ipv4": _ipv4, "phone": _phone}
    tries = []
    for kind, pattern in KINDS:
        made = _email(value, key) if kind == "email" else makers[kind](value, key, back)
        if kind == "email" and back:
            made = value
        tries.append(_labelled(F.when(value.rlike(f"^(?:{pattern})$"), made), kind))
    return F.coalesce(*tries)


def _labelled(text: Column, kind: str) -> Column:
    return _with(text, lambda t: F.when(t.isNotNull(), F.struct(F.lit(kind).alias("kind"), t.alias("text"))))


def session_key(spark: SparkSession) -> str:
    """The key of the session's settings, else one drawn at random for this application."""
    return spark.conf.get(KEY_SETTING, None) or _DRAWN.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def pseudonymised(docs: DataFrame, key: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with its text rewritten, and pii_kinds: the kinds replaced, in the text's order."""
    key = key or session_key(docs.sparkSession)
    text = F.col("text")
    order = [c for c in docs.columns if c != "pii_kinds"]
    touched = text.rlike("[0-9@]")
    found = docs.select(*order, F.when(touched, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("_found"))
    made = found.withColumn("_made", F.when(F.size("_found") > 0, F.transform("_found", lambda m: pseudonym(m, key, back))))
    between = F.split("text", ANY, -1)
    filled = F.zip_with("_found", "_made", lambda m, p: F.coalesce(p["text"], m))
    joined = F.array_join(F.flatten(F.zip_with(between, filled, lambda g, m: F.array(g, F.coalesce(m, F.lit(""))))), "")
    kinds = F.coalesce(F.transform(F.filter("_made", lambda p: p.isNotNull()), lambda p: p["kind"]), F.array().cast("array<string>"))
    changed = F.coalesce(F.exists("_made", lambda p: p.isNotNull()), F.lit(False))
    out = made.withColumn("text", F.when(changed, joined).otherwise(text)).withColumn("pii_kinds", kinds)
    return out.select(*order, "pii_kinds")
