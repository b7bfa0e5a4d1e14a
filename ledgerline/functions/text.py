"""Text, key, e-mail, URL, version and address helpers as pure column expressions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, functions as F

from .arith import col

# Placeholder for a missing part of a surrogate key, one per package generation.
NULL_KEY = "_dbt_utils_surrogate_key_null_"
NULL_KEY_OLD = ""


def blank_to_null(c: Column | str, *also: str) -> Column:
    out = F.nullif(F.trim(col(c)), F.lit(""))
    for word in also:
        out = F.nullif(out, F.lit(word))
    return out


def full_match(c: Column | str, pattern: str) -> Column:
    """The whole value matches, not only a part of it."""
    return col(c).rlike(f"^(?:{pattern})$")


def nth_match(c: Column | str, pattern: str, n: int = 1, group: int = 1) -> Column:
    """Group ``group`` of the ``n``-th match, NULL when there are fewer matches."""
    found = F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group))
    return F.get(found, F.lit(n - 1))


def first_match(c: Column | str, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def surrogate_key(*cols: Column | str, old: bool = False) -> Column:
    filler = F.lit(NULL_KEY_OLD if old else NULL_KEY)
    return F.md5(F.concat_ws("-", *[F.coalesce(col(c).cast("string"), filler) for c in cols]))


def uuid5(namespace: str, name: Column | str) -> Column:
    """Name-based UUID, version 5: SHA-1 of namespace bytes and name, version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(uuid.UUID(namespace).hex)), col(name).cast("binary")))
    variant_digit = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), variant_digit % 4 + 1)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


# ---------------------------------------------------------------- query strings and URLs


def parse_query_string(c: Column | str) -> Column:
    """``a=1&b=&a=2`` to ``{a: 1, b: ''}``: the first value of a key wins, blanks are kept."""
    decode = lambda x: F.try_url_decode(F.replace(x, F.lit("+"), F.lit(" ")))
    value = lambda p: F.when(F.instr(p, "=") > 0, F.substr(p, F.instr(p, "=") + 1)).otherwise("")
    pairs = F.filter(F.split(col(c), "&"), lambda p: p != "")
    names = F.transform(pairs, lambda p: F.substring_index(p, "=", 1))
    entries = F.transform(pairs, lambda p: F.struct(decode(F.substring_index(p, "=", 1)).alias("key"), decode(value(p)).alias("value")))
    firsts = F.filter(entries, lambda e, i: F.array_position(names, F.get(names, i)) == i + 1)
    return F.map_from_entries(firsts)


def query_string_field(c: Column | str, key: str) -> Column:
    return first_match(c, f"(?:^|[?&]){key}=([^&#]*)", 1)


def clean_host(c: Column | str) -> Column:
    """Host of a referrer without scheme, ``www.`` and path."""
    bare = F.regexp_replace(col(c), "^https?://", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^www\.", ""), "[/?#].*$", "")


# ---------------------------------------------------------------- e-mail

# Characters that make an address invalid (the two escapes also in their spelled-out form).
BAD_EMAIL_CHARS = ["\\", "/", "(", ")", "&", "$", "^", "!", " ", "<", ">", "“", "\u2006", "\u00a0", "`"]
# Fixed value: strict address pattern, applied to the upper-cased text.
STRICT_EMAIL = r"[A-Z0-9._%+-/!#$%&'*=?^_`{|}~]+@[A-Z0-9.-]+\.[A-Z]{2,4}"


def valid_email(c: Column | str) -> Column:
    """Text before a single ``@``, a dotted domain after it and none of the bad characters."""
    e = col(c)
    bad = reduce(lambda a, b: a | b, [F.contains(e, F.lit(ch)) for ch in BAD_EMAIL_CHARS])
    return F.coalesce(e.like("%_@__%.__%") & (F.size(F.split(e, "@")) == 2) & ~bad, F.lit(False))


def email_matches_pattern(c: Column | str) -> Column:
    return full_match(F.upper(col(c)), STRICT_EMAIL)


def email_domain(c: Column | str) -> Column:
    return F.lower(F.split_part(col(c), F.lit("@"), F.lit(2)))


def is_blocked_email(c: Column | str, tlds: list[str], domains: list[str]) -> Column:
    """Address that ends in one of the suffixes (case ignored) or belongs to one of the domains."""
    suffixes = [F.lower(col(c)).endswith(t.lower()) for t in tlds]
    listed = F.split_part(col(c), F.lit("@"), F.lit(2)).isin(domains)
    return F.coalesce(reduce(lambda a, b: a | b, suffixes, listed), F.lit(False))


# ---------------------------------------------------------------- versions and addresses


def version_part(c: Column | str, n: int) -> Column:
    """``n``-th dotted part as an integer, NULL when it is absent or not a number."""
    return F.split_part(col(c), F.lit("."), F.lit(n)).try_cast("int")


def version_number(c: Column | str) -> Column:
    """Comparable number of a dotted version."""
    parts = [F.coalesce(version_part(c, n), F.lit(0)) for n in (1, 2, 3)]
    return parts[0] * 1000000 + parts[1] * 1000 + parts[2]


def database_semver(c: Column | str) -> Column:
    """``12.3.1-x`` and ``12.3`` give ``12.3``; ``13beta1``, ``13devel`` and ``13rc1`` give ``13.0``."""
    major = F.regexp_extract(col(c), r"^(\d+)", 1)
    return (
        F.when(col(c).rlike(r"^\d+\.\d+"), F.regexp_extract(col(c), r"^(\d+\.\d+)", 1))
        .when(col(c).rlike(r"^\d+(?:beta|devel|rc)"), F.concat(major, F.lit(".0")))
    )


def ipv4_number(c: Column | str) -> Column:
    """Dotted address as a number, NULL when it is not an address."""
    octets = [F.split_part(col(c), F.lit("."), F.lit(n)).try_cast("bigint") for n in (1, 2, 3, 4)]
    ok = (F.size(F.split(col(c), r"\.")) == 4) & reduce(lambda a, b: a & b, [o.between(0, 255) for o in octets])
    return F.when(ok, octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3])


def cidr_bounds(c: Column | str) -> tuple[Column, Column]:
    """First and last address number of ``a.b.c.d/len``."""
    base = ipv4_number(F.split_part(col(c), F.lit("/"), F.lit(1)))
    bits = F.split_part(col(c), F.lit("/"), F.lit(2)).try_cast("int")
    size = F.pow(F.lit(2), 32 - bits).cast("bigint")
    low = base - base % size
    return low, low + size - 1


def seats_from_text(c: Column | str, patterns: list[str]) -> Column:
    """Number captured by the first pattern that matches, thousands commas removed."""
    hits = [F.nullif(F.regexp_extract(col(c), p, 1), F.lit("")) for p in patterns]
    return F.regexp_replace(F.coalesce(*hits), ",", "").try_cast("int")


def slug(name: str) -> str:
    """Column name from free text."""
    return "".join(ch if ch.isalnum() else "_" for ch in name.lower()).strip("_")
