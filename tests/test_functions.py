from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import agents, arith, dates, payload, text


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in cols.items())
    return spark.createDataFrame([tuple(v for _, v in cols.values())], schema).select(expr.alias("x")).first()[0]


@pytest.mark.parametrize("a,b,months,quarters,years,weeks", [
    (date(2024, 1, 31), date(2024, 2, 1), 1, 0, 0, 0),
    (date(2023, 12, 31), date(2024, 1, 1), 1, 1, 1, 1),
    (date(2024, 3, 15), date(2024, 1, 15), -2, 0, 0, -8),
])
def test_boundary_counts(spark, a, b, months, quarters, years, weeks):
    cols = {"a": ("date", a), "b": ("date", b)}
    assert one(spark, dates.months_crossed("a", "b"), **cols) == months
    assert one(spark, dates.quarters_crossed("a", "b"), **cols) == quarters
    assert one(spark, dates.years_crossed("a", "b"), **cols) == years
    assert one(spark, dates.weeks_crossed("a", "b"), **cols) == weeks


def test_hours_and_seconds_count_boundaries(spark):
    cols = {"a": ("timestamp_ntz", datetime(2024, 1, 1, 9, 59, 59)), "b": ("timestamp_ntz", datetime(2024, 1, 1, 10, 0, 0))}
    assert one(spark, dates.hours_crossed("a", "b"), **cols) == 1
    assert one(spark, dates.seconds_crossed("a", "b"), **cols) == 1


@pytest.mark.parametrize("day,expected", [(date(2024, 3, 8), date(2024, 3, 1)), (date(2024, 3, 9), date(2024, 3, 8)), (date(2024, 3, 7), date(2024, 3, 1))])
def test_previous_weekday_is_strictly_before(spark, day, expected):
    assert one(spark, dates.previous_weekday("d", "Fri"), d=("date", day)) == expected


@pytest.mark.parametrize("day,year,quarter,start,end", [
    (date(2024, 1, 31), 2024, 4, date(2023, 11, 1), date(2024, 1, 31)),
    (date(2024, 2, 1), 2025, 1, date(2024, 2, 1), date(2024, 4, 30)),
    (date(2024, 10, 31), 2025, 3, date(2024, 8, 1), date(2024, 10, 31)),
])
def test_fiscal_calendar(spark, day, year, quarter, start, end):
    d = {"d": ("date", day)}
    assert one(spark, dates.fiscal_year("d"), **d) == year
    assert one(spark, dates.fiscal_quarter("d"), **d) == quarter
    assert one(spark, dates.fiscal_quarter_start("d"), **d) == start
    assert one(spark, dates.fiscal_quarter_end("d"), **d) == end


def test_div0_and_strict_extremes(spark):
    assert one(spark, arith.div0("a", "b"), a=("int", 5), b=("int", 0)) == 0
    assert one(spark, arith.div0("a", "b"), a=("int", None), b=("int", 0)) is None
    assert one(spark, arith.div0("a", "b"), a=("int", 5), b=("int", 2)) == 2.5
    assert one(spark, arith.strict_least("a", "b"), a=("int", 5), b=("int", None)) is None
    assert one(spark, arith.strict_greatest("a", "b"), a=("int", 5), b=("int", 7)) == 7


@pytest.mark.parametrize("x,digits,expected", [(2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13), (None, 0, None)])
def test_half_up(spark, x, digits, expected):
    assert one(spark, arith.half_up("x", digits), x=("double", x)) == expected


# The truth table of invalid addresses: none may pass.
INVALID = [
    "test@user.c o", "te\\st@test.com", "t(est@test.com", "t(es)t@test.com", "a&b@test.com", "$user@test.com", "a/b@test.com", "a!b@test.com", "<user@test.com>", "a“b@test.com",
    "ab@test.co m", "ab@test.co ", "ab@test.com`", "no-at.com", "two@@test.com", "x@y",
]


@pytest.mark.parametrize("mail", INVALID)
def test_invalid_emails(spark, mail):
    assert one(spark, text.valid_email("e"), e=("string", mail)) is False


def test_valid_and_blocked_emails(spark):
    assert one(spark, text.valid_email("e"), e=("string", "a.b+c@firm.co.uk")) is True
    assert one(spark, text.valid_email("e"), e=("string", None)) is False
    assert one(spark, text.is_blocked_email("e", [".ru"], ["bad.com"]), e=("string", "x@site.RU")) is True
    assert one(spark, text.is_blocked_email("e", [".ru"], ["bad.com"]), e=("string", "x@bad.com")) is True
    assert one(spark, text.is_blocked_email("e", [".ru"], ["bad.com"]), e=("string", "x@verybad.com")) is False


def test_uuid5_equals_the_standard(spark):
    import uuid

    namespace = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
    for name in ("a", "python.org", "ünï", ""):
        assert one(spark, text.uuid5(namespace, "n"), n=("string", name)) == str(uuid.uuid5(uuid.UUID(namespace), name))


def test_surrogate_key_null_conventions(spark):
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    cols = {"a": ("int", 1), "b": ("string", None)}
    assert one(spark, text.surrogate_key("a", "b"), **cols) == md5("1-_dbt_utils_surrogate_key_null_")
    assert one(spark, text.surrogate_key("a", "b", old=True), **cols) == md5("1-")


def test_query_string_first_value_wins_and_blanks_stay(spark):
    got = one(spark, text.parse_query_string("q"), q=("string", "a=1&b=&a=2&c=x%20y+z&d"))
    assert got == {"a": "1", "b": "", "c": "x y z", "d": ""}


def test_payload_keeps_the_first_object_only(spark):
    import base64
    import json

    doc = {"id": "x", "name": "Ünï {brace} \"quote\"", "n": {"a": [1, {"b": 2}]}}
    raw = json.dumps(doc, ensure_ascii=False).encode() + b"\x00\xff}{\"tail\x80"
    got = one(spark, payload.decode_payload_json("p"), p=("string", base64.b64encode(raw).decode()))
    assert json.loads(got) == doc
    assert one(spark, payload.decode_payload_json("p"), p=("string", base64.b64encode(b"no json").decode())) is None


@pytest.mark.parametrize("v,expected", [("12.3.1-x", "12.3"), ("12.3", "12.3"), ("13beta1", "13.0"), ("13devel", "13.0"), ("9rc2", "9.0"), ("x", None)])
def test_database_semver(spark, v, expected):
    assert one(spark, text.database_semver("v"), v=("string", v)) == expected


@pytest.mark.parametrize("ip,expected", [("1.2.3.4", 16909060), ("255.255.255.255", 4294967295), ("1.2.3", None), ("1.2.3.256", None), ("a.b.c.d", None), ("", None)])
def test_ipv4_number(spark, ip, expected):
    assert one(spark, text.ipv4_number("ip"), ip=("string", ip)) == expected


def test_cidr_bounds(spark):
    low, high = text.cidr_bounds("c")
    assert one(spark, F.array(low, high), c=("string", "10.1.2.200/25")) == [167838208 + 128, 167838208 + 255]


def test_browser_rules_follow_their_order(spark):
    ua = "Mozilla/5.0 (Windows NT 10.0) Chrome/110.0 Electron/23.2 Desktop/5.3.1 Safari/537.36"
    assert one(spark, agents.browser("u"), u=("string", ua)) == "Electron"
    assert one(spark, agents.browser_version("u"), u=("string", ua)) == "5.3.1"
    assert one(spark, agents.operating_system("u"), u=("string", ua)) == "Windows"
