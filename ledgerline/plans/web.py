"""Access logs, downloads, page visits, geography and schema drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import agents, text
from ..functions.rules import first_match
from ..operators import aggregate, joins, merge, windows

# Path patterns of server and desktop releases.
SERVER_RELEASE = r"/[1-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}/.*"
DESKTOP_RELEASE = r"/desktop/[1-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}/.*"
DESKTOP_WINDOWS = r".*msi|.*win[0-9]{2}.*|.*-win-.*|.*-win\.[a-z]{3}"
DESKTOP_MAC = r".*mac\.[a-z]{3}|.*-osx\..*"
SERVER_WINDOWS = r".*-windows-.*"
# Formats of a regular build number.
BUILDS = [
    r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}",
    r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}",
    r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}\.cloud-[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]+",
    r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{10,}",
]


def security_log_entries(logs: DataFrame, as_of: str, agent_like: str = "Go-http-client/%", skip: Sequence[str] = ()) -> DataFrame:
    """Security pings of servers with the fields of their query string as typed columns.

    ``logs``: log_at, uri, method, user_agent, server_ip, query.
    """
    keep = (F.col("uri") == "/security") & (F.col("method") == "GET") & F.col("user_agent").like(agent_like) & (
        F.to_date("log_at") <= F.lit(as_of).cast("date")
    )
    for word in skip:
        keep = keep & ~F.contains("query", F.lit(word))
    # Only a dozen known fields are read, so each is cut out by pattern instead of building a map per row.
    q = {k: F.try_url_decode(text.query_string_field("query", k)) for k in ("id", "b", "be", "db", "os", "uc", "tc", "auc", "ut")}
    build = F.col("_build")
    part = lambda n: F.split_part(build, F.lit("."), F.lit(n))
    regular = text.full_match(build, BUILDS[0])
    for pattern in BUILDS[1:]:
        regular = regular | text.full_match(build, pattern)
    return logs.where(keep).withColumn("_build", q["b"]).select(
        F.to_date("log_at").alias("log_date"), "log_at", "server_ip", q["id"].alias("server_id"), text.version_part(build, 1).alias("version_major"),
        text.version_part(build, 2).alias("version_minor"), text.version_part(build, 3).alias("version_patch"),
        F.concat(part(1), F.lit("."), part(2), F.lit("."), part(3)).alias("version_full"), (q["be"] == "true").alias("is_enterprise_ready"),
        q["db"].alias("database_type"), q["os"].alias("operating_system"), q["uc"].cast("int").alias("count_users"), q["tc"].cast("int").alias("count_teams"),
        q["auc"].cast("int").alias("count_active_users"), (q["ut"].cast("int") == 1).alias("has_run_unit_tests"), (~regular).alias("is_custom_build_version_format"),
    )


def daily_security_pick(entries: DataFrame, licences: DataFrame, as_of: str, restricted_ips: Sequence[str] = ()) -> DataFrame:
    """One row per server and day: the ping with most active users, then the latest, with the licences valid that day.

    ``entries`` also carry a location; the location is the one most frequent among the server's pings of that
    hour, user count and address. ``licences``: server_id, license_id, trial, issued_date, expire_date.
    """
    clean = entries.where(
        ~F.col("has_run_unit_tests") & ~F.col("is_custom_build_version_format") & (F.col("count_users") >= F.col("count_active_users"))
        & (F.col("log_date") <= F.lit(as_of).cast("date")) & (F.coalesce("server_id", F.lit("")) != "")
    )
    if restricted_ips:
        clean = clean.where(~F.col("server_ip").isin(list(restricted_ips)))
    day = ["server_id", "log_date"]
    rank = F.struct("count_active_users", "log_at", "server_ip", "version_full")
    picked = clean.groupBy(*day).agg(
        F.max_by(F.struct("count_active_users", "count_users", "log_at", "server_ip", "version_full", "database_type", "operating_system", "is_enterprise_ready"), rank).alias("_top"),
        F.count("*").alias("occurrences"), F.countDistinct("server_ip").alias("ip_count"),
    ).select(*day, "_top.*", "occurrences", "ip_count")
    hour = F.date_trunc("hour", "log_at")
    spot = [*day, "count_active_users", "server_ip", "_hour"]
    places = aggregate.most_frequent(clean.withColumn("_hour", hour), spot, "location").drop("votes")
    placed = picked.withColumn("_hour", hour).join(places, spot, "left").drop("_hour")
    both = windows.group_stats(licences, ["server_id"], _trial=F.bool_or(F.col("trial")), _paid=F.bool_or(~F.col("trial")))
    spans = both.select(F.col("server_id").alias("_s"), "license_id", "trial", (F.col("_trial") & F.col("_paid")).alias("_mixed"), "issued_date", "expire_date")
    valid = placed.select(*day).join(
        spans, (F.col("server_id") == F.col("_s")) & F.col("log_date").between(F.col("issued_date"), F.col("expire_date"))
    ).groupBy(*day).agg(
        F.max(F.when(~F.col("_mixed") | ~F.col("trial"), F.col("license_id"))).alias("license_id1"),
        F.max(F.when(F.col("_mixed") & F.col("trial"), F.col("license_id"))).alias("license_id2"),
    )
    return placed.join(valid, day, "left").withColumn("id", text.surrogate_key("server_id", "log_date", old=True))


# ---------------------------------------------------------------- downloads


def with_release(logs: DataFrame, uri: str = "uri") -> DataFrame:
    """Type, operating system and version of a release download, from its path.

    The path rules are worked out once per row, behind a generator: a filter on their results is not moved below it, where
    it would repeat the patterns.
    """
    path = F.col(uri)
    server, desktop = text.full_match(path, SERVER_RELEASE), path.startswith("/desktop/") & text.full_match(path, DESKTOP_RELEASE)
    once = logs.withColumn("_kind", F.explode(F.array(F.when(path.startswith("/desktop/"), F.when(desktop, 2)).when(server, 1))))
    server, desktop = F.coalesce(F.col("_kind") == 1, F.lit(False)), F.coalesce(F.col("_kind") == 2, F.lit(False))
    has = lambda word: F.contains(path, F.lit(word))
    kind = first_match([(server & has("team"), "team"), (server & (has("enterprise") | (~path.ilike("%team%") & ~path.ilike("%enterprise%"))), "enterprise"), (desktop, "desktop")])
    rows = once.withColumn("download_type", kind)
    packaged = F.col("download_type").isNotNull() & ~desktop
    system = first_match([
        (desktop & has("linux"), "linux"), (desktop & text.full_match(path, DESKTOP_WINDOWS), "windows"), (desktop & text.full_match(path, DESKTOP_MAC), "mac"),
        (packaged & has("linux"), "linux"), (packaged & text.full_match(path, SERVER_WINDOWS), "windows"),
    ])
    version = F.when(server, F.split_part(path, F.lit("/"), F.lit(2))).when(desktop, F.split_part(path, F.lit("/"), F.lit(3)))
    return rows.withColumns({"operating_system": system, "version": version}).drop("_kind")


def release_log_entries(logs: DataFrame) -> DataFrame:
    """Logs with decoded agents and release columns. ``logs``: log_at, uri, user_agent, …"""
    agent = F.replace(F.replace("user_agent", F.lit("%2520"), F.lit(" ")), F.lit("%20"), F.lit(" "))
    return with_release(logs.withColumn("user_agent", agent)).withColumns({
        "log_date": F.to_date("log_at"), "version_major": text.version_part("version", 1), "version_minor": text.version_part("version", 2),
        "version_patch": text.version_part("version", 3), "ua_browser_family": F.when(F.col("user_agent").isNotNull(), agents.browser("user_agent")),
        "ua_os_family": F.when(F.col("user_agent").isNotNull(), agents.operating_system("user_agent")),
    })


def downloads(entries: DataFrame, min_bytes: int = 1_000_000) -> DataFrame:
    """Completed downloads of a release, one row per request."""
    done = entries.where(
        (F.col("response_bytes") > min_bytes) & F.col("status").cast("string").like("2%") & F.col("version").isNotNull() & (F.col("http_method") == "GET")
    )
    return windows.first_of_few(done, ["request_id"], "log_at", "client_ip", "uri").withColumns({
        "daily_ip_id": text.surrogate_key("log_date", "client_ip"), "client_fingerprint": text.surrogate_key("client_ip", "user_agent")
    })


def daily_first_downloads(entries: DataFrame) -> DataFrame:
    done = entries.where((F.col("response_bytes") > 0) & F.col("status").cast("string").like("2%") & F.col("version").isNotNull())
    return done.groupBy("log_date", "client_ip").agg(F.min("log_at").alias("first_download_timestamp")).withColumn(
        "daily_ip_id", text.surrogate_key("log_date", "client_ip")
    )


def downloads_outlier_filtered(entries: DataFrame, min_bytes: int = 1_000_000) -> DataFrame:
    """Downloads whose size is within one standard deviation of the mean size of their path.

    Mean and deviation come from an aggregate joined back: a path with a third of all downloads is no window.
    """
    done = entries.where((F.col("response_bytes") > 0) & F.col("status").cast("string").like("2%") & F.col("version").isNotNull())
    size = F.col("response_bytes")
    per_uri = windows.group_stats(
        done, ["uri"], _n=F.count("*"), _sum=F.sum(size).cast("double"), _squares=F.sum(size.cast("decimal(18,0)") * size).cast("double"), bytes_max=F.max(size)
    )
    gap = F.abs(size * F.col("_n") - F.col("_sum"))
    outside = gap * gap * (F.col("_n") - 1) > (F.col("_n") * F.col("_squares") - F.col("_sum") * F.col("_sum")) * F.col("_n")
    kept = per_uri.where((size > min_bytes) & ~(outside & (F.col("_n") > 1)))
    first = done.groupBy("client_ip").agg(F.min("log_at").alias("first_install_at"))
    return kept.join(first, "client_ip").select(
        *[F.col(c) for c in entries.columns], (F.col("_sum") / F.col("_n")).alias("bytes_uri_avg"), "first_install_at"
    )


# ---------------------------------------------------------------- requests and visits


def parse_request_line(logs: DataFrame, request: str = "request") -> DataFrame:
    """``METHOD url PROTOCOL`` in three columns; malformed lines are dropped."""
    part = lambda n: F.split_part(request, F.lit(" "), F.lit(n))
    return logs.where(F.size(F.split(request, " ")) == 3).withColumns({"http_method": part(1), "url": part(2), "protocol": part(3)})


# Counter name and end of the counted path.
PUSH_PATHS = {"count_send_push": "/api/v1/send_push", "count_send_ack": "/api/v1/ack"}


def hourly_request_counts(logs: DataFrame, start: str, paths: dict[str, str] = PUSH_PATHS) -> DataFrame:
    """Successful posts per hour and path. ``logs``: request_at, http_method, url, status."""
    ends = {n: F.col("url").endswith(p) for n, p in paths.items()}
    any_path = F.lit(False)
    for test in ends.values():
        any_path = any_path | test
    good = (F.col("http_method") == "POST") & any_path & (F.col("status") == 200) & (F.col("request_at") > F.lit(start).cast("timestamp_ntz"))
    hour = F.date_trunc("hour", "request_at").cast("timestamp_ntz")
    return logs.where(good).groupBy(hour.alias("request_date_hour")).agg(*[F.count_if(test).alias(n) for n, test in ends.items()])


def notification_stats(spine: DataFrame, hourly: dict[str, Sequence[DataFrame]], paths: Sequence[str] = tuple(PUSH_PATHS)) -> DataFrame:
    """Every hour of the spine with the counts of each region, its sources added up."""
    out = spine
    for region, frames in hourly.items():
        both = None
        for f in frames:
            both = f if both is None else both.unionByName(f)
        summed = both.groupBy(F.col("request_date_hour").alias("date_hour")).agg(
            *[F.sum(p).alias(p.replace("count_", f"count_{region}_")) for p in paths]
        )
        out = out.join(summed, "date_hour", "left")
    return out.fillna(0)


def page_visits(sites: dict[str, DataFrame], strip: dict[str, str] | None = None) -> DataFrame:
    """Views per site, period and page; a site's path prefix can be cut off."""
    out = None
    for site, df in sites.items():
        prefix = (strip or {}).get(site)
        path = F.split_part("pagepath", F.lit(prefix), F.lit(2)) if prefix else F.col("pagepath")
        part = df.groupBy(F.lit(site).alias("site"), "start_date", "end_date", path.alias("pagepath"), "pagetitle").agg(
            F.sum("uniquepageviews").alias("uniquepageviews"), F.sum("pageviews").alias("pageviews")
        )
        out = part if out is None else out.unionByName(part)
    return out


# Path segment, event type, funnel step.
SIGNUP_STEPS = [
    ("signup", "pageview_getting_started", "cloud_account_creation_start"),
    ("verify-email", "pageview_verify_email", "cloud_account_creation_verify"),
    ("company-name", "pageview_company_name", "cloud_account_creation_company"),
    ("create-workspace", "pageview_create_workspace", "cloud_account_creation_workspace"),
]


def signup_funnel_events(pages: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Sign-up page views with their funnel step that arrived after all that is loaded. ``pages``: id, path, received_at."""
    segment = F.split_part("path", F.lit("/"), F.lit(3))
    rows = pages.where(F.contains("path", F.lit("cloud"))).withColumns({
        "type": first_match([(segment == s, t) for s, t, _ in SIGNUP_STEPS]), "category": first_match([(segment == s, c) for s, _, c in SIGNUP_STEPS])
    }).where(F.col("type").isNotNull())
    mark = None if target is None else merge.high_water_mark(target, "received_at")
    return rows if mark is None else rows.where(F.col("received_at") > F.lit(mark))


# ---------------------------------------------------------------- geography

IP_BUCKET = 1 << 16  # A /16 block; wider ranges stand in each of theirs.


def country_ranges(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """Address ranges with their country. ``blocks``: network, geoname_id; ``locations``: geoname_id, country_name."""
    low, high = text.cidr_bounds("network")
    return blocks.withColumns({"range_start": low, "range_end": high}).join(locations.select("geoname_id", "country_name"), "geoname_id", "left").select(
        "country_name", "range_start", "range_end"
    )


def locate(df: DataFrame, ip: str, ranges: DataFrame, name: str = "country_name", default: str | None = None) -> DataFrame:
    """Country of an address column: each distinct address is looked up once and joined back."""
    known = df.select(F.col(ip).alias("_ip")).where(F.col(ip).isNotNull()).distinct().withColumn("_number", text.ipv4_number("_ip"))
    found = joins.range_bucket_join(known, ranges, "_number", "range_start", "range_end", IP_BUCKET, "inner").select("_ip", F.col("country_name").alias(name))
    out = df.join(found, F.col(ip) == F.col("_ip"), "left").drop("_ip")
    return out if default is None else out.withColumn(name, F.coalesce(name, F.lit(default)))


def ip_to_country(servers: DataFrame, ranges: DataFrame) -> DataFrame:
    """Country of each server's last address. ``servers``: server_id, last_server_ip."""
    return locate(servers.select("server_id", "last_server_ip"), "last_server_ip", ranges, "last_known_ip_country", "Unknown")


def docs_feedback_geo(feedback: DataFrame, ranges: DataFrame, ip: str = "client_ip", agent: str = "context_user_agent") -> DataFrame:
    located = locate(feedback, ip, ranges, "geolocated_country_name")
    parsed = agents.enrich_user_agents(located, agent)
    return parsed.withColumnsRenamed({"browser_family": "ua_browser_family", "os_family": "ua_os_family"}).drop("browser_version_major", "os_version")


# ---------------------------------------------------------------- schema drift


def table_drift(columns: DataFrame) -> DataFrame:
    """Snapshot days on which a table is new or its column count changed."""
    key = ["table_schema", "table_name"]
    counts = columns.groupBy(*key, "snapshot_date").agg(F.countDistinct("column_name").alias("column_count"))
    before = F.lag("column_count").over(windows.window(key, "snapshot_date"))
    out = counts.withColumn("prev_column_count", before)
    kind = F.when(F.col("prev_column_count").isNull(), "New Table").when(F.col("prev_column_count") != F.col("column_count"), "New Column")
    return out.withColumn("update_type", kind).where(F.col("update_type").isNotNull())


def column_drift(columns: DataFrame) -> DataFrame:
    """Columns first seen after the first snapshot of all, with the day they were added."""
    added = columns.groupBy("table_schema", "table_name", "column_name").agg(F.min("snapshot_date").alias("date_added"))
    start = columns.agg(F.min("snapshot_date")).first()[0]
    return added.where(F.col("date_added") > F.lit(start))
