"""Personal data: format-preserving Feistel pseudonyms, in SQL expressions only.

Validated values are permuted within their own format by a keyed Feistel
network over a product of two ranges, Z_a x Z_b, chosen to hold exactly the
valid values, so a pseudonym is valid again, different values never meet, and
equal values stay linked across documents:

* payment cards (13-19 digits, or groups of 4-4-4-4 or 4-6-5; Luhn): all digits but the last, which is the
  check digit of the result;
* telephone numbers (three, three and four digits, with separators): the ten
  digits, the country code stays;
* IPv4 addresses: two halves of 16 bits;
* social security numbers (valid area, group and serial);
* dates of 1800-2199 (2001-02-03, 02/03/2001, 03.02.2001): the 146,097 days of
  one Gregorian cycle.

E-mail addresses and hexadecimal secrets (32 to 64 digits) have no number
format to permute; they become keyed hashes of the same shape. Numbers that
fail validation are not personal data and stay. A text is cut at its matches
and joined again within one projection: no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = r"[\p{L}\p{N}._%+-]"
# A local part is tried once for each run of its characters (or behind the last
# match), and no repeat gives anything back: linear time, constant stack.
_LABEL = r"[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}(?:\.{_LABEL})++"
SECRET = r"(?<![0-9A-Za-z])(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])"
ISO = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
US = r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])"
DOTTED = r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?!\.?[0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
CARD = (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5}|"
        r"[0-9]{4}-[0-9]{6}-[0-9]{5})(?![0-9])")
KINDS = {"email": EMAIL, "secret": SECRET, "ipv4": IPV4, "iso": ISO, "us": US, "dotted": DOTTED, "ssn": SSN, "phone": PHONE, "card": CARD}
ANY = "|".join(KINDS.values())
#: The days of one 400-year cycle are 189 * 773.
FIRST_DAY, DAYS_A, DAYS_B = "1800-01-01", 189, 773


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(x: Column, y: Column, a, b, tweak: Column) -> Column:
    """struct(x, y): the keyed permutation of a pair in Z_a x Z_b (longs)."""
    long = lambda v: v.cast("long") if isinstance(v, Column) else F.lit(v).cast("long")

    def turn(s, i):
        mixed = F.conv(F.substring(F.sha2(F.concat_ws("|", tweak, i.cast("string"), s["y"].cast("string")), 256), 1, 15), 16, 10)
        return F.struct(s["y"].alias("x"), ((s["x"] + mixed.cast("long") % s["a"]) % s["a"]).alias("y"), s["b"].alias("a"), s["a"].alias("b"))

    start = F.struct(long(x).alias("x"), long(y).alias("y"), long(a).alias("a"), long(b).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _permuted(digits: Column, tweak: Column) -> Column:
    """A digit string's permutation among the strings of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    pair = feistel(F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, n - half), power(half), power(n - half), tweak)
    return _let(pair, lambda p: F.concat(F.lpad(p["x"].cast("string"), half, "0"), F.lpad(p["y"].cast("string"), n - half, "0")))


def _filled(shape: Column, digits: Column) -> Column:
    """``shape`` with its last digits replaced by ``digits``, one for one."""
    behind = lambda i: F.length(_digits(F.substr(shape, i, F.length(shape))))
    at = lambda i: F.length(digits) - behind(i) + 1
    one = lambda c, i: F.when(c.rlike("[0-9]") & (at(i + 1) > 0), F.substr(digits, at(i + 1), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(shape, "(?<=.)(?=.)"), one), "")


def luhn_sum(digits: Column) -> Column:
    """The weighted digit sum of a digit string whose last digit has weight one."""
    def add(s, i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return s + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(m: Column, key: Column) -> Column:
    def made(d):
        body = _permuted(F.substr(d, F.lit(1), F.length(d) - 1), F.concat_ws("|", key, F.lit("card"), F.length(d).cast("string")))
        whole = _let(body, lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d) % 10 == 0, _let(whole, lambda w: _filled(m, w))).otherwise(m)
    return _let(_digits(m), made)


def _phone(m: Column, key: Column) -> Column:
    ten = lambda d: _permuted(F.substr(d, F.length(d) - 9, F.lit(10)), F.concat_ws("|", key, F.lit("phone")))
    return _let(_digits(m), lambda d: _let(ten(d), lambda p: _filled(m, p)))


def _ipv4(m: Column, key: Column) -> Column:
    def made(o):
        part = lambda i: F.element_at(o, i).cast("long")
        pair = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), 65536, 65536, F.concat_ws("|", key, F.lit("ipv4")))
        return _let(pair, lambda p: F.concat_ws(".", *(F.floor(v).cast("string") for v in (p["x"] / 256, p["x"] % 256, p["y"] / 256, p["y"] % 256))))
    return _let(F.split(m, r"\."), made)


def _ssn(m: Column, key: Column) -> Column:
    def made(d):
        part = lambda a, n: F.substr(d, F.lit(a), F.lit(n)).cast("long")
        area = part(1, 3) - F.when(part(1, 3) > 666, 2).otherwise(1)
        pair = feistel(area, (part(4, 2) - 1) * 9999 + part(6, 4) - 1, 898, 99 * 9999, F.concat_ws("|", key, F.lit("ssn")))
        pad = lambda v, n: F.lpad(v.cast("long").cast("string"), n, "0")
        return _let(pair, lambda p: F.concat_ws("-", pad(p["x"] + F.when(p["x"] >= 665, 2).otherwise(1), 3),
                                                pad(F.floor(p["y"] / 9999) + 1, 2), pad(p["y"] % 9999 + 1, 4)))
    return _let(_digits(m), made)


def _date(m: Column, pattern: str, key: Column) -> Column:
    def made(day):
        n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        pair = feistel(F.floor(n / DAYS_B), n % DAYS_B, DAYS_A, DAYS_B, F.concat_ws("|", key, F.lit("date")))
        moved = _let(pair, lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["x"] * DAYS_B + p["y"]).cast("int")), pattern))
        return F.when((n >= 0) & (n < DAYS_A * DAYS_B), moved).otherwise(m)
    return _let(F.try_to_timestamp(m, F.lit(pattern)).cast("date"), made)


def _hashed(kind: str, value: Column, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(kind), value), 256)


def _email(m: Column, key: Column) -> Column:
    return _let(_hashed("email", F.lower(m), key), lambda h: F.concat(F.lit("u"), F.substring(h, 1, 16), F.lit("@"), F.lit("p"), F.substring(h, 17, 8), F.lit(".invalid")))


def _secret(m: Column, key: Column) -> Column:
    hidden = F.substr(_hashed("secret", F.lower(m), key), F.lit(1), F.length(m))
    return F.when(m == F.upper(m), F.upper(hidden)).otherwise(hidden)


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def pseudonym(m: Column, key: Column) -> Column:
    """The pseudonym of one matched value; the value itself if it isn't valid."""
    made = {"email": _email(m, key), "secret": _secret(m, key), "ipv4": _ipv4(m, key), "iso": _date(m, "yyyy-MM-dd", key),
            "us": _date(m, "MM/dd/yyyy", key), "dotted": _date(m, "dd.MM.yyyy", key), "ssn": _ssn(m, key), "phone": _phone(m, key),
            "card": _card(m, key)}
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(m.rlike(_whole(pattern)), made[kind]).otherwise(out)
    return F.coalesce(out, m)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "n_pseudonyms") -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced, and ``found_col`` (long):
    how many. All rows and other columns stay; a column that already has the
    name ``found_col`` is replaced. A null text stays null and has none; texts
    are read whole, in time linear in their length. Rows are handled one by one,
    so repeated rows get equal pseudonyms; an empty table gives an empty one.
    """
    text = F.col(text_col).cast("string")
    parts = "__parts"
    while parts in docs.columns:
        parts += "_"
    cut = F.when(text.rlike("[0-9@]"), F.struct(
        F.split(text, ANY, -1).alias("rest"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found")))
    fresh = F.transform(F.col(f"{parts}.found"), lambda m: pseudonym(m, F.lit(key)))
    docs = docs.withColumn(parts, cut).withColumn(parts, F.when(F.size(f"{parts}.found") > 0, F.struct(
        F.col(f"{parts}.rest"), F.col(f"{parts}.found"), fresh.alias("fresh"))))
    joined = F.array_join(F.zip_with(f"{parts}.rest", f"{parts}.fresh", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with(f"{parts}.found", f"{parts}.fresh", lambda a, b: a != b), lambda c: c))
    return (docs.withColumn(found_col, F.when(F.col(parts).isNotNull(), changed).otherwise(0).cast("long"))
            .withColumn(text_col, F.coalesce(joined, text)).drop(parts))
