"""Pipelines on small frames whose results are worked out by hand or by brute force."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.functions.rules import WordRule, expand, first_word_rule
from ledgerline.plans import activity, crm, features, licenses, revenue, surveys, web


def d(text):
    return date.fromisoformat(text)


def at(text):
    return datetime.fromisoformat(text)


def test_user_spine_against_brute_force(spark):
    rnd = random.Random(2)
    days = sorted({(rnd.choice(["s1", "s2"]), rnd.choice(["u1", "u2", "u3"]), d("2024-01-01") + timedelta(days=rnd.randrange(40)), rnd.random() < 0.5) for _ in range(40)})
    seen, unique = set(), []
    for s, u, day, flag in days:
        if (s, u, day) not in seen:
            seen.add((s, u, day))
            unique.append((s, u, day, True, flag))
    df = spark.createDataFrame(unique, "server_id string, user_id string, activity_date date, is_active boolean, is_web boolean")
    got = {(r["server_id"], r["user_id"], r["activity_date"]): (r["is_web_today"], r["is_web_last_7_days"], r["is_active_last_30_days"])
           for r in activity.spine_flags(df, ["server_id", "user_id"], "activity_date", ["is_active", "is_web"], "2024-02-20").collect()}
    want = {}
    for key in {(s, u) for s, u, *_ in unique}:
        mine = [r for r in unique if r[:2] == key]
        day = min(r[2] for r in mine)
        while day <= d("2024-02-20"):
            web_on = lambda lo: any(r[4] for r in mine if lo <= r[2] <= day)
            want[(*key, day)] = (web_on(day), web_on(day - timedelta(days=6)), any(day - timedelta(days=29) <= r[2] <= day for r in mine))
            day += timedelta(days=1)
    assert got == want


def test_client_type_counts_once_per_arrival_day(spark):
    ua = "x Electron/1 y"
    data = [("s", "u", at("2024-01-01 10:00"), at("2024-01-01 11:00"), ua), ("s", "u", at("2024-01-01 12:00"), at("2024-01-01 13:00"), ua),
            ("s", "u", at("2024-01-01 12:00"), at("2024-01-02 13:00"), ua), ("s", None, at("2024-01-01 12:00"), at("2024-01-01 13:00"), ua),
            ("s", "u", at("2024-01-01 12:00"), at("2024-03-01 13:00"), "x Firefox/1")]
    df = spark.createDataFrame(data, "server_id string, user_id string, timestamp timestamp_ntz, received_at timestamp_ntz, context_user_agent string")
    row = activity.user_daily_activity(df, "2024-02-01", "2024-01-01").collect()
    assert len(row) == 1 and row[0]["is_desktop"] == 2 and row[0]["is_webapp"] == 0 and row[0]["received_at_date"] == d("2024-01-02")


def test_mau_segments_life_of_a_user(spark):
    days = ["2024-01-01", "2024-01-02", "2024-03-15"]
    df = spark.createDataFrame([("u", "s", "system_user", at(x + " 08:00"), "WebApp", "api") for x in days], "user_id string, server_id string, user_role string, received_at timestamp_ntz, client string, category string")
    got = {str(r["date"]): r["mau_segment"] for r in activity.mau_segments(df, "2024-06-01").collect()}
    assert got["2024-01-01"] == "First Time MAU" and got["2024-01-02"] == "Current MAU" and got["2024-02-01"] == "Current MAU"
    assert got["2024-02-02"] == "Newly Disengaged" and got["2024-02-03"] == "Disengaged" and got["2024-03-15"] == "Reengaged MAU"
    assert max(got) == "2024-05-31" and len(got) == 152


def test_attribution_needs_the_property(spark):
    events = spark.createDataFrame(
        [("1", "e", "c", "t", "x", "s", "u"), ("2", "e", "c", "t", None, "s", "u"), ("3", "e", "c", "t", "y", "s", "u"), ("4", "other", "c", "t", "x", "s", "u")],
        "event_id string, event_name string, category string, event_type string, prop string, server_id string, user_id string",
    ).withColumns({"timestamp": F.lit(at("2024-01-01 00:00")), "received_at": F.lit(at("2024-01-01 00:00"))})
    base = {"event_name": "e", "category": "c", "event_type": "t"}
    rules = [{**base, "property_name": "prop", "property_value": "x", "feature_name": "exact"}, {**base, "property_name": "prop", "property_value": None, "feature_name": "any"}]
    got = {r["event_id"]: r["feature_name"] for r in features.attribute_features(events, rules, "2024-02-01").collect()}
    assert got == {"1": "exact", "2": "unknown_features", "3": "any", "4": "unknown_features"}


@pytest.mark.parametrize("start,end,n", [("2023-03-01", "2024-02-28", 0), ("2023-03-01", "2024-02-29", 1), ("2024-02-29", "2024-02-29", 1), ("2024-03-01", "2025-02-28", 0), ("1900-01-01", "1900-12-31", 0), ("2020-01-01", "2024-12-31", 1)])
def test_leap_day_in_period(spark, start, end, n):
    df = spark.createDataFrame([(d(start), d(end))], "a date, b date")
    assert df.select(revenue.crosses_leap_day("a", "b")).first()[0] == n


def test_daily_arr_of_overlapping_lines(spark):
    deals = spark.createDataFrame([("o1", "a", True, True), ("o2", "a", True, True), ("o3", "a", False, True)], "opportunity_id string, account_id string, is_won boolean, is_closed boolean")
    lines = spark.createDataFrame(
        [("l1", "o1", d("2023-01-01"), d("2023-12-31"), 365, "Recurring"), ("l2", "o2", d("2023-06-01"), d("2024-05-30"), 730, "Recurring"), ("l3", "o3", d("2023-01-01"), d("2023-12-31"), 100, "Recurring"),
         ("l4", "o1", d("2023-01-01"), d("2023-12-31"), 999, "One-time")],
        "line_id string, opportunity_id string, start_date date, end_date date, total_price int, product_type string",
    )
    accounts = spark.createDataFrame([("a", None)], "account_id string, parent_id string")
    annual = revenue.annualised_lines(lines, deals)
    got = {str(r["day"]): r["total_arr"] for r in revenue.account_daily_arr(revenue.opportunity_arr_steps(annual, accounts)).collect()}
    # The second line spans 365 days of which one is a leap day: 365 * 730 / 364, rounded.
    assert got["2023-05-31"] == 365 and got["2023-06-01"] == 365 + 732 and got["2024-01-01"] == 732 and min(got) == "2023-01-01" and max(got) == "2024-05-30"


def test_expiry_and_renewal_pair_up(spark):
    deals = spark.createDataFrame(
        [("o1", "a", d("2022-01-01"), d("2022-12-31"), d("2021-12-20"), "New Subscription", "first", 1000.0, True, True), ("o2", "a", d("2023-01-01"), d("2023-12-31"), d("2023-01-10"), "Renewal", "renewal", 1500.0, True, True)],
        "opportunity_id string, account_id string, license_start date, license_end date, close_date date, type string, name string, amount double, is_won boolean, is_closed boolean",
    )
    accounts = spark.createDataFrame([("a", None, "A")], "account_id string, parent_id string, account_name string")
    t = revenue.arr_transactions(deals, accounts, "2024-06-30")
    got = [(r["opp_type"], r["arr_change"], r["ending_arr"]) for r in t.orderBy("trans_no").collect()]
    # Won, expired at the end of 2022, renewed ten days later, expired at the end of 2023.
    assert got == [("New Subscription", 1000, 1000), ("Expired", -1000, 0), ("Renewal", 1500, 1500), ("Expired", -1500, 0)]
    r = {str(x["report_mo"]): x for x in revenue.arr_reporting(t, "2024-06-30").collect()}
    assert r["2022-01-31"]["new"] == 1000 and r["2022-01-31"]["acct_end_arr"] == 1000
    assert r["2023-01-31"]["expanded"] == 500 and r["2023-01-31"]["renewed"] == 1000 and r["2024-01-31"]["churned"] == -1500


def test_known_licences_leave_out_ambiguous_reports(spark):
    cws = spark.createDataFrame([("k1", "C", "c@x.com", "E20", at("2024-01-01"), at("2025-01-01"), False, 10)], "license_id string, company_name string, customer_email string, sku_short_name string, starts_at timestamp_ntz, expire_at timestamp_ntz, is_trial boolean, licensed_seats int")
    legacy = spark.createDataFrame([("k1", "L", "l@x.com", at("2020-01-01"), at("2021-01-01")), ("k2", "L2", "l2@x.com", at("2020-01-01"), at("2021-01-01"))], "license_id string, company_name string, contact_email string, issued_at timestamp_ntz, expire_at timestamp_ntz")
    crm = spark.createDataFrame([("k2", "o1", at("2022-01-01"), at("2023-01-01"), 5, "S", 9.0, at("2022-01-01")), ("k2", "o2", at("2023-01-01"), at("2024-01-01"), 6, "S", 9.0, at("2023-01-01"))],
                                "license_id string, opportunity_id string, starts_at timestamp_ntz, expire_at timestamp_ntz, licensed_seats int, account_name string, account_arr double, created_at timestamp_ntz")
    reports = spark.createDataFrame([("k3", "E10", 3, at("2024-01-01"), at("2025-01-01"), "c"), ("k3", "E10", 4, at("2024-01-01"), at("2025-01-01"), "c"), ("k4", "odd", 7, at("2024-01-01"), at("2025-01-01"), "c")],
                                    "license_id string, license_name string, licensed_seats int, starts_at timestamp_ntz, expire_at timestamp_ntz, customer_id string")
    got = {r["license_id"]: r for r in licenses.known_licenses(cws, legacy, crm, reports).collect()}
    assert set(got) == {"k1", "k2", "k4"}
    assert got["k1"]["company_name"] == "C" and got["k1"]["in_legacy"] and not got["k1"]["in_telemetry"]
    assert got["k2"]["licensed_seats"] == 6 and got["k2"]["company_name"] == "L2" and got["k4"]["sku_short_name"] == "Unknown" and got["k4"]["license_name"] == "odd"


@pytest.mark.parametrize("text,score,expected", [
    ("Password reset fails again", 3, "Account Authorization"), ("It works well", 9, "Praise"), ("It works well", 3, "Invalid"), ("short", 9, "Invalid"), ("passwordless words but long", 2, "Manual Input Required"),
])
def test_feedback_rules(spark, text, score, expected):
    rules = [WordRule("Account Authorization", [expand("password(s)?")]), WordRule("Praise", [expand("work(s|ing)?"), ["well"]], min_score=7), WordRule("Invalid", shorter_than=14)]
    df = spark.createDataFrame([(d("2024-01-01"), "s", "u", text, score)], "last_feedback_date date, server_id string, user_id string, feedback string, score int")
    row = surveys.classify_feedback(df, rules, None, "2024-01-02 00:00:00").first()
    assert row["subcategory"] == expected
    assert row["category"] == {"Account Authorization": "UX Feedback", "Praise": "Praise", "Invalid": "Invalid", "Manual Input Required": "Manual Input Required"}[expected]


def test_word_rules_are_found_like_their_patterns(spark):
    """A thousand rules against plain patterns tried in order."""
    assert expand("fi(x|xes)|work(s|ing)?|sign on|a(b|c)d(e)?") == ["fix", "fixes", "works", "working", "work", "sign on", "abde", "abd", "acde", "acd"]
    rnd = random.Random(4)
    words = ["ab", "abs", "cd", "e", "fg", "x1", "mö", "on", "in", "up"]
    phrases = [f"{a}{sep}{b}" for a in words for b in words for sep in (" ", "-", ", ", "/", ": ")]
    rules = []
    for n in range(1000):
        groups = [rnd.sample(words, 2) + rnd.sample(phrases, 2) if n % 3 else [rnd.choice(phrases)] for _ in range(rnd.randint(2, 4))]
        rules.append(WordRule(str(n), groups, rnd.choice([None, 3]), rnd.choice([None, 8]), rnd.choice([None, 60]), rnd.choice([None, 20])))
    rules[700:700] = [WordRule("plain", [], longer_than=90), WordRule("none", [["zz", "(.*)"]])]
    texts = ["".join(rnd.choice(words) + rnd.choice([" ", "-", ", ", "/", "?", ": ", "! ", "\n", "'", "Z"]) for _ in range(rnd.randint(0, 30))).upper() for _ in range(150)] + [None, "", "(.*)", "a ? b"]
    rows_ = [(i, t, rnd.choice([None, 2, 5, 9])) for i, t in enumerate(texts)]

    def plain(text, score):
        for n, r in enumerate(rules):
            low = (text or "").lower()
            if text is None or (r.min_score and (score is None or score < r.min_score)) or (r.max_score and (score is None or score > r.max_score)):
                continue
            if (r.shorter_than and len(text) >= r.shorter_than) or (r.longer_than and len(text) <= r.longer_than):
                continue
            if all(any(re.search(rf"(?:^|[ .;,:\n\t\-\"'/]){re.escape(w)}(?:[.;, /\n\t\-\"'?!]|$)", low) for w in g) for g in r.groups):
                return n
        return None

    df = spark.createDataFrame(rows_, "i int, text string, score int")
    got = {r["i"]: r["position"] for r in first_word_rule(df, "text", "score", rules).collect()}
    assert got == {i: plain(t, sc) for i, t, sc in rows_} and len(set(got.values())) > 20


def test_carried_score_ends_after_ninety_days(spark):
    df = spark.createDataFrame([("s", "u", d("2024-01-01"), at("2024-01-01 10:00"), "9.0", 10, "user")], "server_id string, user_id string, event_date date, timestamp timestamp_ntz, server_version_full string, score int, user_role string")
    got = {str(r["activity_date"]): r["promoters_last90d"] for r in surveys.nps_user_spined(df, "2024-12-31", "2023-01-01").collect()}
    assert got["2024-03-30"] == 1 and got["2024-03-31"] == 0 and len(got) == 366


@pytest.mark.parametrize("uri,kind,system,version", [
    ("/5.1.2/x-team-linux.tar.gz", "team", "linux", "5.1.2"), ("/5.1.2/x-5.1.2-windows-amd64.zip", "enterprise", "windows", "5.1.2"), ("/desktop/4.2.0/app-win.exe", "desktop", "windows", "4.2.0"),
    ("/desktop/4.2.0/app-mac.zip", "desktop", "mac", "4.2.0"), ("/docs/5.1.2/x", None, None, None), ("/0.1.2/x-team", None, None, None),
])
def test_release_paths(spark, uri, kind, system, version):
    row = web.with_release(spark.createDataFrame([(uri,)], "uri string")).first()
    assert (row["download_type"], row["operating_system"], row["version"]) == (kind, system, version)


def test_hierarchy_and_clip(spark):
    licences = spark.createDataFrame([("k1", "c", "F", "E20", 1, d("2024-01-01"), d("2024-04-30")), ("k2", "c", "F", "E20", 2, d("2024-02-01"), d("2024-05-31"))], "license_id string, customer_id string, company string, edition string, users int, issued_date date, expire_date date")
    days = [d("2024-02-10")]
    reports = spark.createDataFrame([(k, "s", day, at("2024-02-10 01:00")) for k in ("k1", "k2") for day in days], "license_id string, server_id string, date date, timestamp timestamp_ntz")
    got = {(r["license_id"], r["server_id"], r["date"]): r["server_expire_date"] for r in licenses.license_days(licences, reports, "2024-12-31").collect()}
    assert got[("k1", "s", d("2024-02-10"))] == d("2024-01-31") and got[("k2", "s", d("2024-02-10"))] == d("2024-05-31")
    assert got[("k1", None, d("2024-01-05"))] == d("2024-04-30")
    assert rows(spark.createDataFrame([(1,)], "a int")) == [(1,)]


def test_sweep_counts_members_like_a_scan(spark):
    """Gaps of every length round the spans, flags that change, members of several servers, days after the end."""
    rnd = random.Random(11)
    start, last = date(2024, 1, 1), date(2024, 3, 20)
    data = [(f"s{sv}", f"u{u}", start + timedelta(days=n), rnd.random() < 0.7, rnd.random() < 0.2)
            for sv in range(3) for u in range(6) for n in sorted(rnd.sample(range(10 * sv, 90), rnd.choice([1, 3, 9, 40])))]
    data.append(("late", "u", date(2024, 3, 25), True, True))
    df = spark.createDataFrame(data, "server_id string, user_id string, day date, a boolean, b boolean")
    counters = {"a1": ("a", 1), "a7": ("a", 7), "a30": ("a", 30), "b1": ("b", 1), "b7": ("b", 7), "b30": ("b", 30)}
    got = {(r["server_id"], r["day"]): tuple(r[c] for c in counters) for r in activity.active_counts(df, ["server_id"], "user_id", "day", counters, "2024-03-20").collect()}
    want = {}
    for sv in ("s0", "s1", "s2"):
        day = min(x[2] for x in data if x[0] == sv)
        while day <= last:
            want[sv, day] = tuple(len({x[1] for x in data if x[0] == sv and 0 <= (day - x[2]).days < n and x[3 if m == "a" else 4]}) for m, n in counters.values())
            day += timedelta(days=1)
    assert got == want


def test_feature_steps_equal_trailing_sums(spark):
    rnd = random.Random(12)
    data = [(f"s{u % 2}", f"u{u}", date(2024, 1, 1) + timedelta(days=n), rnd.randint(0, 4), rnd.randint(0, 3)) for u in range(8) for n in sorted(rnd.sample(range(60), rnd.choice([1, 2, 12])))]
    df = spark.createDataFrame([(s, u, x, k, o, k + o) for s, u, x, k, o in data], "server_id string, user_id string, activity_date date, count_known_features int, count_x int, count_total int")
    got = {(r["server_id"], r["user_id"], r["activity_date"]): r for r in features.feature_spine(df, "2024-02-20", "2023-01-01", 9).collect()}
    known = {s for s, _, _, k, _ in data if k}
    n = 0
    for u in {x[:2] for x in data if x[0] in known}:
        own = {x[2]: x for x in data if x[:2] == u}
        day, end = min(own), min(date(2024, 2, 20), max(own) + timedelta(days=9))
        while day <= end:
            r = got[(*u, day)]
            month = [x for at, x in own.items() if 0 <= (day - at).days <= 9]
            assert (r["count_x_events_daily"], r["count_x_events_monthly"]) == (own[day][4] if day in own else 0, sum(x[4] for x in month))
            assert (r["is_active"], r["is_active_monthly"]) == (int(day in own), int(bool(month)))
            day, n = day + timedelta(days=1), n + 1
    assert len(got) == n


def test_each_relation_is_filtered_by_its_own_literal(spark, tmp_path):
    relations = {}
    for name in ("web", "portal"):
        spark.createDataFrame([(i, "e", at(f"2024-01-{i:02}")) for i in range(1, 21)], "id int, event string, received_at timestamp_ntz").write.parquet(f"{tmp_path}/{name}")
        relations[name] = spark.read.parquet(f"{tmp_path}/{name}")
    target = spark.createDataFrame([("web", at("2024-01-05")), ("portal", at("2024-01-15"))], "source_relation string, received_at timestamp_ntz")
    out = features.union_event_family(relations, target, [])
    assert out.groupBy("source_relation").count().orderBy("source_relation").collect() == [("portal", 5), ("web", 15)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"GreaterThan\(received_at,([^)]*)\)", plan))) == 2


def test_release_paths_are_worked_out_once(spark):
    logs = spark.createDataFrame([("r1", at("2024-01-01"), "/5.1.2/x-team-linux.tar.gz", 2_000_000, 200, "1", "GET", "a")] * 2 + [("r1", at("2023-12-31"), "/docs/5", 2_000_000, 200, "1", "GET", "a")],
                                 "request_id string, log_at timestamp_ntz, uri string, response_bytes long, status int, client_ip string, http_method string, user_agent string")
    out = web.downloads(web.release_log_entries(logs))
    assert [(r["request_id"], r["version"], str(r["log_at"])) for r in out.collect()] == [("r1", "5.1.2", "2024-01-01 00:00:00")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("/desktop/[") == 1


def test_server_days_span_gaps_and_prefer_telemetry(spark):
    day = lambda n: date(2024, 1, n)
    report = "server_id string, server_date date, version_full string, operating_system string, database_type string, database_version string, reported_versions array<string>"
    telemetry = spark.createDataFrame(
        [("s", day(3), "5.1", "linux", "pg", "14.2", ["5.1"], "E0", None, "1.1.1.1", "box"), (None, day(3), "9", None, None, None, None, None, None, None, None)],
        report + ", edition string, installation_id string, server_ip string, installation_type string",
    ).withColumn("edition", F.col("edition") == "E0")
    legacy = spark.createDataFrame([("s", day(1), "5.0", None, None, None, ["5.0"], False), ("s", day(3), "4.9", "bsd", None, None, ["4.9"], None)], report + ", edition boolean")
    diagnostics = spark.createDataFrame(
        [("s", day(5), "5.2", None, None, None, None, None, "2.2.2.2", 7, 9)], report + ", is_enterprise_ready boolean, server_ip string, count_active_users long, count_users long"
    )
    counts = "server_id string, server_date date, daily_active_users long, monthly_active_users long, count_registered_users long, count_registered_deactivated_users long"
    reports = spark.createDataFrame([("s", day(3), 4, 6, 10, 3), ("s", day(9), 1, 1, 1, 1), ("other", day(3), 1, 1, 1, 1)], counts)
    older = spark.createDataFrame([("s", day(2), 2, 3, 8, None)], counts)

    def rows(start):
        out = activity.server_activity_spined(telemetry, legacy, diagnostics, reports, older, start)
        names = ["activity_date", "age_in_days", "version_full", "server_ip", "daily_active_users", "count_registered_users", "count_registered_active_users", "has_legacy_telemetry_data", "is_missing_activity_data"]
        return [tuple(r) for r in out.orderBy("activity_date").select(*names).collect()]

    assert rows("2024-01-01") == [
        (day(1), 0, "5.0", None, 0, 0, None, True, True),
        (day(2), 1, None, None, 2, 8, None, False, False),
        (day(3), 2, "5.1", "1.1.1.1", 4, 10, 7, True, False),
        (day(4), 3, None, None, 0, 0, None, False, True),
        (day(5), 4, "5.2", "2.2.2.2", 7, 9, None, False, True),
    ]
    assert [r[:2] for r in rows("2024-01-02")] == [(day(3), 0), (day(4), 1), (day(5), 2)]
    assert rows("2024-01-06") == []


def test_deals_are_credited_to_the_last_lead_qualified_by_then(spark, monkeypatch):
    """Against brute force over all pairs of a contact; leads and deals of one contact never meet as pairs."""
    from ledgerline.operators import windows
    from ledgerline.plans import crm

    r = random.Random(7)
    day = lambda n, h=0: datetime(2024, 1, 1, h) + timedelta(days=n)
    leads = [(f"l{i:03}", f"m{i}", "open", None, None if i % 9 == 0 else day(r.randrange(40), r.randrange(24)), r.choice(["q1", "q2", "q3", None])) for i in range(150)]
    deals = [(f"o{i:03}", day(r.randrange(45)) if i % 11 else None, d("2024-06-01"), 10.0, "New") for i in range(150)]
    links = [(r.choice(["q1", "q2", "q3", "q4", None]), o[0]) for o in deals for _ in range(2)]
    want = {}
    for o in deals:
        fit = [(x[4], x[0]) for x in leads for c, k in links if k == o[0] and c is not None and c == x[5] and x[4] and o[1] and x[4].date() <= o[1].date()]
        if fit:
            want[max(fit)[1]] = max(want.get(max(fit)[1], ""), o[0])
    handed = []
    scan = windows.chunked_scan
    monkeypatch.setattr(windows, "chunked_scan", lambda df, *a, **k: (handed.append(df.count()), scan(df, *a, **k))[1])
    none = lambda fields: spark.createDataFrame([], fields)
    out = crm.lead_to_close(
        spark.createDataFrame(leads, "lead_id string, email string, status string, reason string, qualified_at timestamp_ntz, contact_id string"),
        none("email string, form_name string, form_fill_date date"), [("%x%", "X")], spark.createDataFrame(links, "contact_id string, opportunity_id string"),
        spark.createDataFrame(deals, "opportunity_id string, created_at timestamp_ntz, close_date date, amount double, type string"),
        none("opportunity_id string, min_start_date date, max_end_date date"), none("opportunity_id string, newvalue string, created_at timestamp_ntz"),
    )
    got = {x["lead_id"]: x["opportunity_id"] for x in out.collect()}
    assert len(got) == sum(x[4] is not None for x in leads)
    assert {k: v for k, v in got.items() if v} == want and handed[0] <= len(leads) + len(links)


def test_interval_marks_read_their_input_once(spark, folder):
    from ledgerline.operators import joins

    t = spark.read.parquet(f"{folder}/orders.parquet").select("o_custkey", F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), 9).alias("b"), F.lit(2).alias("n"))
    out = joins.interval_sums(t, ["o_custkey"], "a", "b", ["n"])
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    spent = lambda df, a, b: df.agg(F.sum(F.col("n") * (F.datediff(b, a) + 1))).first()[0]
    assert spent(out, "from_day", "to_day") == spent(t, "a", "b")


def test_licence_days_move_by_period_and_not_by_day(spark):
    """Against brute force per day; what is shuffled are rows per licence and period, and a day's scans need no further exchange."""
    r = random.Random(3)
    owned = [(f"k{i:03}", f"c{i % 9}", f"Firm {i % 5}" if i % 4 else None, r.choice(["E10", "E20 Trial", None]), r.choice([None, 1, 2]), s0, s0 + timedelta(days=r.randrange(-2, 60)))
             for i in range(60) for s0 in [d("2024-01-01") + timedelta(days=r.randrange(30))]]
    owned += [(*owned[0][:1], "c99", "Other -TRIAL", "E20", 5, *owned[0][5:])]
    reports = [(f"k{r.randrange(60):03}", r.choice(["v1", "v2", None]), d("2024-01-01") + timedelta(days=r.randrange(90)), at("2024-03-01 00:00:00")) for _ in range(400)]
    lic = spark.createDataFrame(owned, "license_id string, customer_id string, company string, edition string, users int, issued_date date, expire_date date")
    rep = spark.createDataFrame(reports, "license_id string, server_id string, date date, timestamp timestamp_ntz")
    out = licenses.license_days(lic, rep, "2024-02-20")
    editions = {k: max((x[3] for x in owned if x[0] == k and x[3]), default=None) for k in {x[0] for x in owned}}
    days = []
    for k, c, company, edition, users, a, b in owned:
        trial = bool(company and company.endswith(" -TRIAL")) or (b - a).days <= 35 or edition == "E20 Trial"
        for n in range((min(b, d("2024-02-20")) - a).days + 1):
            on = a + timedelta(days=n)
            for server in {x[1] for x in reports if x[0] == k and x[2] == on} or {None}:
                days.append((on, k, server, c, editions[k], trial, a, b, users))
    rank = lambda x: (x[6], x[8] is not None, x[8] or 0, x[1], x[3])

    def clip(x, same):
        later = [y for y in days if y is not x and y[0] == x[0] and y[2] == x[2] and y[5] == x[5] and same(y) and rank(y) > rank(x)]
        following = min(later, key=rank)[6] if later else None
        return following - timedelta(days=1) if following and following <= x[7] else x[7]

    want = {}
    for x in days:
        peers = {y[5] for y in days if y[0] == x[0] and y[2] == x[2]}
        want[x[:4]] = (x[4], x[5], clip(x, lambda y, x=x: y[3] == x[3]), clip(x, lambda y: True), x[2] is not None and len(peers) == 2)
    got = {(x["date"], x["license_id"], x["server_id"], x["customer_id"]): (x["edition"], x["trial"], x["server_expire_date"], x["server_expire_date_join"], x["has_trial_and_non_trial"]) for x in out.collect()}
    assert got == want
    plan = licenses.license_day_periods(lic, rep, "2024-02-20")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Repartition") > plan.index("Window") and plan.count("Repartition") == 1


def test_licence_days_appear_after_the_scans(spark):
    """A scan sees one row per licence, server and period, for all its days; licences that stand twice with a customer are merged per day."""
    r, start = random.Random(8), d("2024-01-03")
    owned = [(f"k{i % 40:02}", f"c{i % 8 % 3}", f"Firm {i % 7}", r.choice(["E10", "E20 Trial", None]), i, a, a + timedelta(days=r.choice([0, 7, 8, 33, 50]))) for i in range(55) for a in [start + timedelta(days=r.randrange(40))]]
    told = [(f"k{r.randrange(40):02}", r.choice(["v1", "v2", None]), start + timedelta(days=r.randrange(95)), at(f"2024-03-01 00:00:{n % 60:02}")) for n in range(600)] + [("k01", "v1", None, None), (None, "v1", start, None)]
    last = d("2024-03-09")
    editions = {k: max((x[3] for x in owned if x[0] == k and x[3]), default=None) for k in {x[0] for x in owned}}
    cells = {}
    for k, c, company, edition, users, a, b in owned:
        trial = (b - a).days <= 35 or edition == "E20 Trial"
        for on in [a + timedelta(days=n) for n in range((min(b, last) - a).days + 1)]:
            for server in {x[1] for x in told if x[0] == k and x[2] == on} or {None}:
                stamp = max((x[3] for x in told if x[:3] == (k, server, on)), default=None)
                cells.setdefault((on, server), []).append(((a, users, k, c), trial, b, company, stamp))
    want = {}
    for (on, server), group in cells.items():
        mixed = server is not None and len({x[1] for x in group}) == 2
        for x in group:
            clip = lambda same, x=x, group=group: min((y[0] for y in group if y[0] > x[0] and y[1] == x[1] and same(y)), default=None)
            ends = [n[0] - timedelta(days=1) if n else x[2] for n in (clip(lambda y, x=x: y[0][3] == x[0][3]), clip(lambda y: True))]
            row = (x[3], x[1], x[0][0], x[2], ends[0], x[0][1], x[4] or at("1970-01-01 00:00:00"), mixed, ends[1])
            key = (on, x[0][2], server, x[0][3])
            want[key] = tuple(map(max, want.get(key, row), row))
    lic = lambda x: spark.createDataFrame(x, "license_id string, customer_id string, company string, edition string, users int, issued_date date, expire_date date")
    rep = spark.createDataFrame(told, "license_id string, server_id string, date date, timestamp timestamp_ntz")
    got = licenses.license_days(lic(owned), rep, str(last)).collect()
    assert {(x["date"], x["license_id"], x["server_id"], x["customer_id"]): (x["company"], x["trial"], x["issued_date"], x["expire_date"], x["server_expire_date"], x["users"], x["timestamp"] or at("1970-01-01 00:00:00"),
            x["has_trial_and_non_trial"], x["server_expire_date_join"]) for x in got} == want and len(got) == len(want)
    assert all(x["edition"] == editions[x["license_id"]] for x in got)
    once = licenses.license_day_periods(lic(owned[:40]), rep, str(last))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in once[:once.index("Window")] and "Generate" in once[:once.index("Window")]
    assert licenses.license_days(lic(owned).limit(0), rep, str(last)).count() == 0


def test_won_deals_list_servers_in_tasks_by_pairs(spark, monkeypatch):
    """Lists lie on the heap, so their tasks follow the pairs of licence and server, and a list becomes text once per licence, not once per deal."""
    monkeypatch.setattr(crm, "PAIRS_PER_TASK", 100)
    servers = {f"k{k}": [f"v{n}" for n in range(k, 180, 1 + k)] for k in range(1, 6)}
    day = d("2024-01-01")
    deals = spark.createDataFrame([(f"o{i}", f"a{i % 3}", f"k{i % 7}" if i % 8 else None, d("2024-12-31"), i, i % 9 > 0) for i in range(40)], "opportunity_id string, account_id string, license_id string, license_end date, created_at int, is_won boolean")
    names = spark.createDataFrame([("a0", "A")], "account_id string, account_name string")
    paths = spark.createDataFrame([("a0", "r", "Root")], "id string, root_id string, root_name string")
    reports = spark.createDataFrame([(k, v, day + timedelta(days=n)) for k, vs in servers.items() for v in vs for n in range(2)], "license_id string, server_id string, date date")
    known = spark.createDataFrame([("k1", "E20", 5, None)], "license_id string, sku_short_name string, licensed_seats int, expire_at date")
    seen = spark.createDataFrame([(f"v{n}", day, n % 3) for n in range(0, 180, 2)] * 2, "server_id string, last_activity_date date, last_monthly_active_users int")
    of = lambda sep: crm.won_opportunities(deals, names, paths, reports, known, seen, "2024-02-01", sep=sep)
    texts, lists = of(","), of(None)
    got = {r["opportunity_id"]: r for r in texts.collect()}
    assert set(got) == {f"o{i}" for i in range(40) if i % 8 and i % 9}
    for r in got.values():
        own = sorted(servers.get(r["license_id"], []))
        active = [v for v in own if int(v[1:]) % 2 == 0 and int(v[1:]) % 3]
        assert (r["servers"], r["active_servers"], r["has_telemetry"], r["has_user_activity"]) == (",".join(own), ",".join(active), bool(own), bool(active))
        assert r["days_since_last_license_telemetry"] == (30 if own else None) and r["license_sku"] == ("E20" if r["license_id"] == "k1" else None)
    assert {r["opportunity_id"]: (",".join(r["servers"]), ",".join(r["active_servers"])) for r in lists.collect()} == {k: (r["servers"], r["active_servers"]) for k, r in got.items()}
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    pairs = sum(map(len, servers.values()))
    assert len(set(re.findall(r"RepartitionByExpression \[license_id#\d+\], (\d+)", plan))) == 1 and abs(int(re.findall(r"RepartitionByExpression .*, (\d+)", plan)[0]) - pairs // 100) <= 1
    assert plan.index("array_join") > plan.index("Join")


def test_rows_are_spread_by_their_number(spark):
    """Fifty rows of one partition go to as many tasks as asked, none is lost, and an empty table is one task."""
    from ledgerline.operators.aggregate import spread

    rows_ = spark.range(0, 50, 1, 1)
    assert spread(rows_, 10, "id").rdd.getNumPartitions() == 5 and sorted(r[0] for r in spread(rows_, 10, "id").collect()) == list(range(50))
    assert spread(rows_.where("id < 0"), 10, "id").rdd.getNumPartitions() == 1


def test_security_pick_takes_query_strings_apart_once_and_spread(spark, folder):
    """The fields are cut out behind an exchange by row number, and the pick reads them from the folder they were written to."""
    from ledgerline.catalog import web as queries
    from ledgerline.catalog.registry import QUERIES, Tables

    assert "Repartition" in queries.pings(Tables(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    plan = QUERIES["j43_daily_security_pick"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "&]uc=" not in plan and plan.count("regexp_extract(query") == 0


def test_contract_lines_lie_in_as_many_tasks_as_shuffles_have(spark, folder):
    from ledgerline.catalog import revenue as queries
    from ledgerline.catalog.registry import Tables

    plan = queries.annual(Tables(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"RepartitionByExpression \[opportunity_id#\d+\], {spark.conf.get('spark.sql.shuffle.partitions')}\b", plan)
