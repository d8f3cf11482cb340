"""Format-preserving pseudonyms of personal values, in SQL functions only.

One expression finds candidates; a candidate counts only if it is valid (Luhn
check of card numbers, mod-97 check of account numbers, calendar days, octets up
to 255, issued ranges of social security numbers, 8 to 15 digits of phone
numbers), and everything else stays as it is.  Valid values go through a keyed
Feistel network over exactly their own domain A x B,

    L <- (L + F(round, R)) mod A,   R <- (R + F(round, L)) mod B   (ten rounds, F from SHA-256),

which is a permutation of the domain: equal values get equal pseudonyms in all
documents, different values different ones, and the pseudonym is as valid as the
value (check digits are recomputed, separators and country codes stay).  The
names of e-mail addresses go through the same network over characters, letters
staying letters and digits digits; their domains stay.  A value meets itself
with the chance of one in its domain (days: 73,049; all others over 10^6).

Defined cases: null text stays null with no values; empty texts stay empty;
texts are searched whole; repeated rows are treated alike; an empty table gives
no rows; ``pseudonymise`` passes all further columns on, also such as have the
names of its working columns or of its result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import fresh, table

ROUNDS = 10
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+[0-9]{8,15}(?![0-9])"
    r"|\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9]|[.-][0-9]))"
)
PHONE_US = r"(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DAY = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}(?:\.[0-9]{1,2}\.|/[0-9]{1,2}/)[0-9]{4})(?![0-9]|[./-][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9A-Za-z+])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
FOUND = "|".join((EMAIL, IBAN, PHONE, PHONE_US, IP, DAY, SSN, CARD))

# fixed values: country calling codes by length (1 and 7; the two-digit ones; all others have three digits)
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"

FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 1900-01-01 to 2099-12-31 is 17 * 4297 days
SSN_PARTS = (898, 99 * 9999)  # areas 001-665 and 667-899; groups 01-99; serials 0001-9999


def _long(c: Column) -> Column:
    return c.cast("long")


def _round_value(key: str, kind: str, i: Column, other: Column) -> Column:
    """60 bits of the keyed hash of a round and the other half."""
    h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other.cast("string")), 256)
    return _long(F.conv(F.substring(h, 1, 15), 16, 10))


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column, back: bool = False) -> Column:
    """struct(l, r): the permuted pair of 0 <= left < a, 0 <= right < b; ``back`` undoes it."""
    sign = -1 if back else 1

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        l = F.when(even, F.pmod(s["l"] + sign * F.pmod(_round_value(key, kind, i, s["r"]), a), a)).otherwise(s["l"])  # noqa: E741
        r = F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * F.pmod(_round_value(key, kind, i, s["l"]), b), b))
        return F.struct(_long(l).alias("l"), _long(r).alias("r"))

    rounds = F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if back else range(ROUNDS))])
    return F.aggregate(rounds, F.struct(_long(left).alias("l"), _long(right).alias("r")), step)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digits(key: str, kind: str, s: Column) -> Column:
    """A string of 2 to 34 digits, permuted among those of its length."""
    n = F.length(s)
    u = F.floor(n / 2).cast("int")
    a, b = _long(F.round(F.pow(F.lit(10.0), u))), _long(F.round(F.pow(F.lit(10.0), n - u)))
    kinds = f"{kind}"
    out = lambda p: F.concat(F.lpad(p["l"].cast("string"), u, "0"), F.lpad(p["r"].cast("string"), n - u, "0"))
    return _let(feistel(key, kinds, _long(F.substring(s, F.lit(1), u)), _long(F.substring(s, u + 1, n)), a, b), out)


def only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def refill(shape: Column, new: Column) -> Column:
    """``shape`` with its digits replaced by those of ``new`` in order."""
    step = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substring(new, s["k"], F.lit(1))).alias("out"), (s["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k")))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step)["out"]


def luhn_sum(s: Column, doubled: int) -> Column:
    """Luhn sum; digits at places of parity ``doubled`` from the right (0 is the last) count twice."""
    n = F.length(s)

    def add(acc: Column, i: Column) -> Column:
        v = F.substring(s, n - i, F.lit(1)).cast("int") * F.when(i % 2 == doubled, 2).otherwise(1)
        return acc + F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def card(key: str, m: Column) -> Column:
    """Issuer digit kept, middle permuted, check digit recomputed; null if not valid."""

    def make(d: Column) -> Column:
        n = F.length(d)
        body = F.concat(F.substring(d, 1, 1), digits(key, "card", F.substring(d, F.lit(2), n - 2)))
        whole = _let(body, lambda x: F.concat(x, ((10 - luhn_sum(x, 0) % 10) % 10).cast("string")))
        return F.when((n >= 13) & (n <= 19) & (luhn_sum(d, 1) % 10 == 0) & (only_zero(d) == F.lit(False)), refill(m, whole))

    return _let(only_digits(m), make)


def only_zero(d: Column) -> Column:
    return d.rlike("^0*$")


def mod97(s: Column) -> Column:
    """Account number remainder: first four characters last, letters as 10 to 35."""
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        v = F.ascii(c)
        return F.when(v >= 65, (acc * 100 + v - 55) % 97).otherwise((acc * 10 + v - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add)


def iban(key: str, m: Column) -> Column:
    def make(s: Column) -> Column:
        own = F.substring(s, F.lit(5), F.length(s))
        d = only_digits(own)
        new = F.concat(F.substring(s, 1, 2), F.lit("00"), refill(own, digits(key, "iban", d)))
        whole = _let(new, lambda x: F.concat(F.substring(x, 1, 2), F.lpad((98 - mod97(x)).cast("string"), 2, "0"), F.substring(x, F.lit(5), F.length(x))))
        valid = (F.length(s) >= 15) & (F.length(s) <= 34) & (mod97(s) == 1) & (F.length(d) >= 4)
        # letters keep their place, so only digits are put back into the spaced form
        return F.when(valid, refill(m, only_digits(whole)))

    return _let(F.replace(m, F.lit(" ")), make)


def phone(key: str, m: Column) -> Column:
    """A country's calling code is kept however the number is written, so its other
    digits are the same value with and without separators."""
    code = F.regexp_extract(m, rf"^(\+(?:{CALLING_CODES}))", 1)

    def make(c: Column) -> Column:
        rest = F.substring(m, F.length(c) + 1, F.length(m))
        n = F.length(only_digits(m))
        return F.when((n >= 8) & (n <= 15), F.concat(c, refill(rest, digits(key, "phone", only_digits(rest)))))

    return _let(code, make)


def ip(key: str, m: Column) -> Column:
    def make(p: Column) -> Column:
        v = [F.element_at(p, i).cast("int") for i in range(1, 5)]
        out = _let(feistel(key, "ip", v[0] * 256 + v[1], v[2] * 256 + v[3], F.lit(65536), F.lit(65536)), lambda x: F.concat_ws(".", *[F.floor(x[h] / d).cast("long") % 256 for h in "lr" for d in (256, 1)]))
        return F.when((v[0] < 256) & (v[1] < 256) & (v[2] < 256) & (v[3] < 256), out)

    return _let(F.split(m, r"\."), make)


def day(key: str, m: Column) -> Column:
    """Calendar days 1900 to 2099; ``d.m.y`` and ``d/m/y`` (where that is no day, ``m/d/y``)."""
    iso = m.contains("-")
    padded = m.rlike(r"^0|^..?[./]0") | (F.length(m) == 10)

    def make(p: Column) -> Column:
        a, b, c = (F.element_at(p, i) for i in (1, 2, 3))
        form = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
        dmy = form(c, b, a)
        swapped = ~iso & dmy.isNull() & m.contains("/")
        value = F.when(iso, form(a, b, c)).when(swapped, form(c, a, b)).otherwise(dmy)
        n = F.datediff(value, F.lit(FIRST_DAY).cast("date"))
        x = feistel(key, "day", F.floor(n / DAYS[1]), n % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]))
        new = _let(x, lambda v: F.date_add(F.lit(FIRST_DAY).cast("date"), (v["l"] * DAYS[1] + v["r"]).cast("int")))
        sep = F.when(m.contains("/"), "/").otherwise(".")
        two = lambda f, d: F.when(padded, F.lpad(f(d).cast("string"), 2, "0")).otherwise(f(d).cast("string"))
        out = _let(
            new,
            lambda d: F.when(iso, d.cast("string"))
            .when(swapped, F.concat(two(F.month, d), sep, two(F.dayofmonth, d), sep, F.year(d).cast("string")))
            .otherwise(F.concat(two(F.dayofmonth, d), sep, two(F.month, d), sep, F.year(d).cast("string"))),
        )
        return F.when((n >= 0) & (n < DAYS[0] * DAYS[1]), out)

    return _let(F.split(m, "[-./]"), make)


def ssn(key: str, m: Column) -> Column:
    area, group, serial = F.substring(m, 1, 3).cast("int"), F.substring(m, 5, 2).cast("int"), F.substring(m, 8, 4).cast("int")
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    x = feistel(key, "ssn", area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1, F.lit(SSN_PARTS[0]), F.lit(SSN_PARTS[1]))

    def out(v: Column) -> Column:
        first = v["l"] + 1 + F.when(v["l"] >= 665, 1).otherwise(0)
        parts = ((first, 3), (F.floor(v["r"] / 9999) + 1, 2), (v["r"] % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(c.cast("string"), w, "0") for c, w in parts])

    return F.when(valid, _let(x, out))


def _shift(s: Column, stream: Column) -> Column:
    """Every letter or digit of ``s`` moved within its class by the hex stream."""

    def one(i: Column) -> Column:
        c = F.substring(s, i, F.lit(1))
        k = F.conv(F.substring(stream, ((i - 1) % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        v = F.ascii(c)
        move = lambda base, size: F.char(F.lit(base) + (v - base + k) % size)
        return F.when(c.rlike("^[a-z]"), move(97, 26)).when(c.rlike("^[A-Z]"), move(65, 26)).when(c.rlike("^[0-9]"), move(48, 10)).otherwise(c)

    n = F.length(s)
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one), "")).otherwise(F.lit(""))


def email(key: str, m: Column) -> Column:
    """Name permuted by a Feistel network over its two halves, domain kept."""
    name = F.substring_index(m, "@", 1)
    u = F.floor((F.length(name) + 1) / 2).cast("int")
    stream = lambda i, x: F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), i.cast("string"), x), 512)

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        l = F.when(even, _let(stream(i, s["r"]), lambda k: _shift(s["l"], k))).otherwise(s["l"])  # noqa: E741
        r = F.when(even, s["r"]).otherwise(_let(stream(i, s["l"]), lambda k: _shift(s["r"], k)))
        return F.struct(l.alias("l"), r.alias("r"))

    start = F.struct(F.substring(name, F.lit(1), u).alias("l"), F.substring(name, u + 1, F.length(name)).alias("r"))
    mixed = F.aggregate(F.array(*[F.lit(i) for i in range(4)]), start, step)
    return _let(mixed, lambda x: F.concat(x["l"], x["r"], F.substring(m, F.length(name) + 1, F.length(m))))


#: kinds in the order in which a candidate is tried
KINDS: tuple[tuple[str, str, Callable[[str, Column], Column]], ...] = (
    ("email", "@", email),
    ("iban", "^[A-Z]", iban),
    ("phone", rf"^\+|^(?:{PHONE_US})$", phone),
    ("ip", r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$", ip),
    ("day", rf"^(?:{DAY})$", day),
    ("ssn", rf"^(?:{SSN})$", ssn),
    ("card", "^[0-9]", card),
)


def pseudonym(key: str, m: Column) -> Column:
    """struct(kind, value); the value is null where the candidate is not valid."""
    kind = value = None
    for name, shape, make in KINDS:
        test = m.rlike(shape)
        kind = F.when(test, name) if kind is None else kind.when(test, name)
        value = F.when(test, make(key, m)) if value is None else value.when(test, make(key, m))
    return F.struct(kind.alias("kind"), value.alias("value"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "pii") -> DataFrame:
    """``docs`` with the text rewritten and ``found_col``: the kind and pseudonym
    of every value replaced, in the order of the text.  ``found_col`` gets
    underscores in front while a column has that name."""
    text = F.col(text_col)
    maybe = text.rlike("[0-9@]")
    hits = F.when(maybe, F.regexp_extract_all(text, F.lit(FOUND), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found, new, found_col = (fresh(docs.columns, c) for c in ("_mf_found", "_mf_new", found_col))
    rows = docs.withColumn(found, hits)
    rows = rows.withColumn(new, F.transform(found, lambda m: pseudonym(key, m)))
    filled = F.zip_with(found, new, lambda m, p: F.coalesce(p["value"], m))
    parts = F.zip_with(F.split(text, FOUND, -1), filled, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    out = F.when(F.size(found) > 0, F.array_join(parts, "")).otherwise(text)
    return rows.withColumn(text_col, out).withColumn(found_col, F.filter(new, lambda p: p["value"].isNotNull())).drop(found, new)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced by pseudonyms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pseudonymise(docs, key="pseudonym-key-of-the-query")
    kinds = F.array_join(F.array_sort(F.transform("pii", lambda p: p["kind"])), ",")
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_values"), kinds.alias("kinds"))
