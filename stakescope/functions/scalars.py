"""Scalar functions as column expressions; all stay inside Catalyst, none throws on bad input."""

from __future__ import annotations

import ipaddress
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CDN_RANGES, CURRENCY, ConfigError

SUBSCRIBER_DIGITS = 9
#: Fixed value: the text that stands for a fingerprint that was not found.
NO_FINGERPRINT = "not-found"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: Column) -> Column:
    return F.when(x != "", x)


def normalize_phone(x: Column | str) -> Column:
    """Digits only; a leading country code 256 and then a leading 0 go while more than nine digits are left; empty: null."""
    digits = F.regexp_replace(col(x).cast("string"), r"\D", "")
    for head in ("256", "0"):  # a chain of calls, so that no part of it is copied
        digits = F.regexp_replace(digits, rf"^{head}(?=\d{{{SUBSCRIBER_DIGITS + 1 - len(head)}}})", "")
    return F.nullif(digits, F.lit(""))


def is_objectid_hex(x: Column | str) -> Column:
    return F.coalesce(col(x).cast("string").rlike("^[0-9a-fA-F]{24}$"), F.lit(False))


def looks_like_test_number(x: Column | str) -> Column:
    """A digit five times in a row, two digits three times, three digits twice, or at most two distinct characters. Advisory only."""
    p = col(x)
    found = p.rlike(r"(\d)\1{4}|(\d{2})\2{2}|(\d{3})\3") | (F.size(F.array_distinct(F.split(p, ""))) <= 2)
    return F.coalesce((p != "") & found, F.lit(False))


def split_chain(x: Column | str) -> Column:
    """Trimmed elements of a comma-separated chain, empty ones left out; null: none."""
    parts = F.transform(F.split(F.coalesce(col(x), F.lit("")), ","), lambda e: F.trim(e))
    return F.filter(parts, lambda e: e != "")


def ipv4_number(x: Column) -> Column:
    """A strict dotted quad as a number, else null."""
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    parts = F.split(x, r"\.")
    number = sum((F.try_element_at(parts, F.lit(i + 1)).try_cast("long") * F.lit(256 ** (3 - i)) for i in range(4)), F.lit(0).cast("long"))
    return F.when(x.rlike(rf"^{octet}(\.{octet}){{3}}$"), number)


def is_cdn(x: Column | str, ranges: Iterable[str] = CDN_RANGES) -> Column:
    """True if the address lies in one of the ranges; other text and other address families are not."""
    number = ipv4_number(col(x))
    inside = F.lit(False)
    for r in ranges:
        net = ipaddress.ip_network(r)
        inside = inside | number.between(int(net.network_address), int(net.broadcast_address))
    return F.coalesce(inside, F.lit(False))


def extract_client_ip(x: Column | str, ranges: Iterable[str] = CDN_RANGES) -> Column:
    """The first element of the chain that is no CDN address (it need not be an address at all); none: null."""
    ranges = tuple(ranges)
    return F.get(F.filter(split_chain(x), lambda e: ~is_cdn(e, ranges)), F.lit(0))


def utc(x: Column | str) -> Column:
    return F.try_to_timestamp(col(x).cast("string"))


def as_double(x: Column | str) -> Column:
    value = col(x).try_cast("double")
    return F.when(~F.isnan(value), value)


def has_number(x: Column | str) -> Column:
    return as_double(x).isNotNull()


def amount(x: Column | str) -> Column:
    return F.coalesce(as_double(x), F.lit(0.0))


def as_list(x: Column | str, scalar: bool = False) -> Column:
    """A list as it is, a scalar (scalar=True) as a list of one; null: an empty list."""
    value = F.when(col(x).isNotNull(), F.array(col(x).cast("string"))) if scalar else col(x)
    return F.coalesce(value, F.array().cast("array<string>"))


def lowered(x: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(col(x))), F.lit(""))


def optional_text(x: Column | str) -> Column:
    return blank_to_null(F.trim(col(x).cast("string")))


def valid_fingerprint(x: Column | str) -> Column:
    """Trimmed text of exactly 64 characters that is not the not-found mark, else null."""
    t = F.trim(col(x))
    return F.when((F.length(t) == 64) & (F.lower(t) != NO_FINGERPRINT), t)


def is_fingerprint_hex(x: Column | str) -> Column:
    return F.coalesce(col(x).rlike("^[0-9a-fA-F]{64}$"), F.lit(False))


def relabel_currency(x: Column | str, target: str = CURRENCY) -> Column:
    """INR becomes the target where that is UGX; everything else is trimmed."""
    t = F.trim(col(x))
    return F.when((F.upper(t) == "INR") & F.lit(target == "UGX"), F.lit(target)).otherwise(t)


def normalize_nin(x: Column | str) -> Column:
    return blank_to_null(F.upper(F.regexp_replace(col(x), r"\s", "")))


def normalize_email(x: Column | str) -> Column:
    return blank_to_null(F.lower(F.trim(col(x))))


def salted_hash(x: Column | str, salt: str) -> Column:
    """SHA-256 of salt, a zero byte and the value, in hexadecimal; null stays null."""
    return F.sha2(F.concat(F.lit(salt + "\0"), col(x)), 256)


def login_success(success: Column | str, operation: Column | str) -> Column:
    """The explicit flag, else true for the operation login, else unknown."""
    return F.coalesce(col(success), F.when(lowered(operation) == "login", F.lit(True)))


def variation(mean: Column, deviation: Column) -> Column:
    """Coefficient of variation; nothing measured or a mean of zero: 0."""
    return F.coalesce(F.when(mean == 0, F.lit(0.0)).otherwise(deviation / mean), F.lit(0.0))


def seconds_between(a: Column | str, b: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", col(a), col(b)) / F.lit(1e6)


def minutes_between(a: Column | str, b: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", col(a), col(b)) / F.lit(6e7)


def band(score: Column | str, medium: float, high: float) -> Column:
    return F.when(col(score) >= high, "high").when(col(score) >= medium, "medium").otherwise("low")


def condition(value: Column, op: str, threshold: float | None) -> Column:
    """A rule's condition, checked while the plan is built."""
    if op == "is_true":
        return value.cast("boolean")
    known = {"gt": value.__gt__, "gte": value.__ge__, "lt": value.__lt__, "lte": value.__le__, "eq": value.__eq__}
    if op not in known:
        raise ConfigError(f"unsupported rule condition: {op}")
    if threshold is None:
        raise ConfigError(f"condition {op} needs a threshold")
    return known[op](F.lit(threshold))


def json_text(x: Column) -> Column:
    return F.to_json(x, {"ignoreNullFields": "false"})


def sorted_distinct(x: Column) -> Column:
    return F.array_sort(F.array_distinct(x))


def list_text(x: Column) -> Column:
    """[a, b, c] of an array of strings; null counts as empty."""
    return F.concat(F.lit("["), F.coalesce(F.array_join(x, ", "), F.lit("")), F.lit("]"))


def _product_error(a: Column, b: Column, ab: Column) -> Column:
    """a * b - ab without loss, for doubles that do not overflow (Veltkamp's and Dekker's splits)."""
    high = lambda x: x * 134217729.0 - (x * 134217729.0 - x)
    a1, b1 = high(a), high(b)
    return ((a1 * b1 - ab) + a1 * (b - b1) + (a - a1) * b1) + (a - a1) * (b - b1)


def _untied(x: Column, times: Column, by: Column) -> Column:
    """x, or if it stands about halfway between two multiples of by / times, the one that its binary value is rounded to.

    Java's formats round the shortest decimal up, so 0.125 becomes 0.13 and 2.675 2.68; C, Python and SQL engines round the
    double itself, exact halves to even: 0.12 and 2.67. One of times and by must be 1, the other a power of ten up to 1e22.
    """

    def settled(v: Column) -> Column:
        a = F.abs(v)
        twice = times * 2.0
        p = a * twice
        r = F.rint(p / by)
        q = r * by
        off = (p - q) + (_product_error(a, twice, p) - _product_error(r, by, q))
        low = (r - 1.0) / 2.0
        m = low + F.when(off > 0, 1.0).when(off < 0, 0.0).otherwise(low % 2.0)
        tied = (r % 2.0 == 1.0) & (r < 2.0**53) & (F.abs(off) <= q * 2.0**-51)
        return F.when(tied, F.when(v < 0, -1.0).otherwise(1.0) * (m * by / times)).otherwise(v)

    return F.get(F.transform(F.array(x.cast("double")), settled), F.lit(0))


def fixed(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", _untied(x, F.lit(10.0**digits), F.lit(1.0)))


def general(x: Column) -> Column:
    """Six significant digits without trailing zeros, as a plain general format writes them (scientific from 1e6 or below 1e-4).

    Halves are decided by the double's binary value from 1e-17 to 1e28, beyond that by its shortest decimal.
    """
    power_of = lambda t: F.regexp_extract(t, "e(.*)$", 1).try_cast("int")
    tens = lambda k: F.get(F.array(*(F.lit(10.0**i) for i in range(23))), F.greatest(k, F.lit(0)))
    over = power_of(F.format_string("%.16e", x.cast("double"))) - 5
    x = F.when(F.abs(over) <= 22, _untied(x, tens(-over), tens(over))).otherwise(x.cast("double"))
    text = F.format_string("%.5e", x)  # d.ddddde+xx: rounded to six digits
    digits = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")

    def written(t: Column) -> Column:
        power = power_of(t)
        plain = digits(t.try_cast("double").try_cast("decimal(20,10)").cast("string"))
        science = F.concat(digits(F.regexp_extract(t, "^(.*)e", 1)), F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
        return F.when(t.try_cast("double") == 0, "0").when((power < -4) | (power >= 6), science).otherwise(plain)

    return F.get(F.transform(F.array(text), written), F.lit(0))  # the text is made once


def hashed_id(prefix: str, *parts: Column) -> Column:
    """A short id that depends on its parts only."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 20))
