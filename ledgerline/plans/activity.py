"""User and server activity: daily facts, dense spines, retention and server summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import agents, text
from ..functions.arith import band
from ..operators import aggregate, joins, windows

METRICS = [
    "is_active", "is_client_desktop", "is_client_webapp", "is_legacy_desktop", "is_legacy_webapp", "is_desktop", "is_webapp", "is_unknown",
]
SERVER_DAY = ["server_id", "activity_date"]

# Roles that make a user an administrator.
ADMIN_ROLES = [
    "system_admin", "system_admin, system_user", "system_administrator", "admin_user", "admin", "system_user, system_admin", "root_user",
    "super_user", "administrator",
]


# ---------------------------------------------------------------- users


def user_daily_activity(events: DataFrame, as_of: str, start: str, agent: str | None = "context_user_agent") -> DataFrame:
    """One row per day, server and user; with an agent column also counts per client type.

    A client type counts once per arrival day of its events. ``as_of`` cuts late clock readings.
    """
    day, received = F.to_date("timestamp"), F.to_date("received_at")
    valid = (
        F.col("user_id").isNotNull() & F.col("server_id").isNotNull() & F.col("timestamp").isNotNull()
        & (F.col("received_at") <= F.lit(as_of).cast("timestamp_ntz")) & (F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    )
    rows = events.where(valid)
    kinds: list[Column] = []
    if agent:
        family = F.when(F.col(agent).isNotNull(), agents.browser(agent))
        rows = rows.withColumn("client_type", agents.client_type(family))
        kinds = [F.col("client_type")]
    seen = rows.select(day.alias("activity_date"), "server_id", "user_id", received.alias("received_on"), *kinds).distinct()
    counts = [
        F.sum(F.when(F.col("client_type") == kind, 1).otherwise(0)).alias(kind.lower()) for kind in ("IS_DESKTOP", "IS_WEBAPP")
    ] if agent else []
    out = seen.groupBy("activity_date", "server_id", "user_id").agg(F.max("received_on").alias("received_at_date"), *counts)
    return out.select(
        text.surrogate_key("activity_date", "server_id", "user_id").alias("daily_user_id"), "activity_date", "server_id", "user_id",
        F.lit(True).alias("is_active"), "received_at_date", *[c for c in out.columns if c.startswith("is_")],
    )


def _merged_flags(current: DataFrame, legacy: DataFrame) -> DataFrame:
    keys = ["activity_date", "server_id", "user_id"]
    side = lambda df, tag: df.select(*keys, *[F.col(c).alias(f"{tag}_{c}") for c in ("is_active", "is_desktop", "is_webapp")], F.lit(True).alias(tag))
    both = side(current, "s").join(side(legacy, "l"), keys, "full")
    desktop = F.coalesce("s_is_desktop", "l_is_desktop")
    webapp = F.coalesce("s_is_webapp", "l_is_webapp")
    flags = {
        "is_active": F.coalesce("s_is_active", "l_is_active"),
        "is_client_desktop": F.col("s") & (F.col("s_is_desktop") > 0),
        "is_client_webapp": F.col("s") & (F.col("s_is_webapp") > 0),
        "is_legacy_desktop": F.col("l") & (F.col("l_is_desktop") > 0),
        "is_legacy_webapp": F.col("l") & (F.col("l_is_webapp") > 0),
        "is_desktop": desktop > 0,
        "is_webapp": webapp > 0,
        "is_unknown": (desktop == 0) & (webapp == 0),
    }
    return both.select(*keys, *[F.coalesce(e, F.lit(False)).alias(n) for n, e in flags.items()])


def spine_flags(active: DataFrame, keys: Sequence[str], day: str, metrics: Sequence[str], last_day: str,
                spans: Sequence[int] = (7, 30)) -> DataFrame:
    """Dense key-day rows from the first active day on, with today and trailing-span flags.

    The last day each metric held is found on the compact active rows; each active row is then
    spread over the days up to the next one. So the windows and the shuffle see active days only,
    and no join with a calendar is needed. A trailing span of n days is the day and the n - 1 before.
    """
    w = windows.running(keys, day)
    nxt = F.lead(day).over(windows.window(keys, day))
    compact = active.select(
        *keys, F.col(day).alias("_from"), F.coalesce(F.date_sub(nxt, 1), F.lit(last_day).cast("date")).alias("_to"),
        *[F.max(F.when(F.col(m), F.col(day))).over(w).alias(f"_last_{m}") for m in metrics],
    )
    dense = joins.dense_days(compact, "_from", "_to", day)
    out = [F.col(k) for k in [day, *keys]]
    for m in metrics:
        last = F.col(f"_last_{m}")
        out.append(F.coalesce(last == F.col(day), F.lit(False)).alias(f"{m}_today"))
        out += [F.coalesce(F.datediff(day, last) < n, F.lit(False)).alias(f"{m}_last_{n}_days") for n in spans]
    return dense.select(*out)


def user_activity_spined(current: DataFrame, legacy: DataFrame, as_of: str) -> DataFrame:
    """Dense user-server-day spine with 1-, 7- and 30-day flags for eight client metrics.

    Spans are taken per (server, user), the key of the spine.
    """
    return spine_flags(_merged_flags(current, legacy), ["server_id", "user_id"], "activity_date", METRICS, as_of)


def active_counts(active: DataFrame, keys: Sequence[str], member: str, day: str, counters: dict[str, tuple[str, int]], last_day: str) -> DataFrame:
    """Exact numbers of members per key and day, dense from the key's first day to ``last_day``, without a dense spine of members.

    ``counters`` names (metric, days): a member counts on a day if the metric held on it or the ``days - 1`` days before. ``active`` has
    one row per key, member and active day, with a flag per metric. An active day opens the counters that its predecessor no
    longer covers, and closes each at the end of its span if no later day has taken over: at most one opening and one closing row per active day and
    span, with a bit per counter. Their sums per key and day, added up over the key's days, are the counts.
    """
    rows = active.where(F.col(day) <= F.lit(last_day).cast("date"))
    metrics, spans = sorted({m for m, _ in counters.values()}), sorted({n for _, n in counters.values()})
    # the expressions are many and alike, so they are written as SQL text
    earlier = f"OVER (PARTITION BY {', '.join([*keys, member])} ORDER BY {day} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    # later days in falling order: a frame that ends with the partition would be added up anew for every row
    later = earlier.replace(f"ORDER BY {day}", f"ORDER BY {day} DESC")
    near = rows.selectExpr(
        *keys, day, *metrics, *[f"coalesce(datediff({day}, max(IF({m}, {day}, NULL)) {earlier}), {FOREVER}) AS _p_{m}" for m in metrics],
        *[f"coalesce(datediff(min(IF({m}, {day}, NULL)) {later}, {day}), {FOREVER}) AS _n_{m}" for m in metrics],
    )

    def uncovered(edge: str) -> str:
        """Bits of the counters whose span does not reach the neighbouring day; a longer gap uncovers the shorter spans as well."""
        each = []
        for m in metrics:
            own = {n: 1 << i for i, (x, n) in enumerate(counters.values()) if x == m}
            cases = " ".join(f"WHEN {edge}{m} >= {n} THEN {sum(b for k, b in own.items() if k <= n)}L" for n in sorted(own, reverse=True))
            each.append(f"IF({m}, CASE {cases} ELSE 0L END, 0L)")
        return " | ".join(each)

    edges = near.selectExpr(*keys, day, f"{uncovered('_p_')} AS _open", f"{uncovered('_n_')} AS _close")
    of = {n: sum(1 << i for i, (_, k) in enumerate(counters.values()) if k == n) for n in spans}
    mark = lambda at, sign, bits: f"named_struct('{day}', {at}, '_sign', {sign}, '_bits', {bits})"
    marks = [mark(day, 1, "_open"), *[mark(f"date_add({day}, {n})", -1, f"_close & {of[n]}L") for n in spans]]
    changes = edges.selectExpr(*keys, f"inline(array({', '.join(marks)}))")
    changes = changes.where((F.col("_bits") != 0) & (F.col(day) <= F.lit(last_day).cast("date")))
    # the days themselves are rows without bits, so no join with a calendar is needed
    first = rows.groupBy(*keys).agg(F.min(day).alias("_a"))
    days = joins.dense_days(first, "_a", F.lit(last_day).cast("date"), day).selectExpr(*keys, day, "1 AS _sign", "0L AS _bits")
    daily = changes.unionByName(days).groupBy(*keys, day).agg(*[F.expr(f"sum(IF(_bits & {1 << i}L != 0, _sign, 0)) AS {c}") for i, c in enumerate(counters)])
    # rows per key are its days
    running = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {day} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return daily.selectExpr(*keys, day, *[f"sum({c}) {running} AS {c}" for c in counters])


def product_user_activity(daily: DataFrame, as_of: str) -> DataFrame:
    """Daily, weekly and monthly active users per server-day of one product."""
    counters = {f"{span}_active_users": ("is_active", n) for span, n in SPAN_DAYS.items()}
    counted = active_counts(daily, ["server_id"], "user_id", "activity_date", counters, as_of)
    return counted.withColumn("daily_server_id", text.surrogate_key(*SERVER_DAY))


FACT_COLUMNS = {
    "is_active": "active_users", "is_client_desktop": "client_desktop_active_users", "is_client_webapp": "client_webapp_active_users",
    "is_legacy_desktop": "legacy_desktop_active_users", "is_legacy_webapp": "legacy_webapp_active_users", "is_desktop": "desktop_active_users",
    "is_webapp": "webapp_active_users", "is_unknown": "unknown_active_users",
}
SPANS = {"daily": "today", "weekly": "last_7_days", "monthly": "last_30_days"}
#: A gap longer than any span.
FOREVER = 1_000_000
SPAN_DAYS = {"daily": 1, "weekly": 7, "monthly": 30}
REPORTED = [
    "count_registered_users", "count_registered_deactivated_users", "count_public_channels", "count_private_channels", "count_teams",
    "count_slash_commands", "count_direct_message_channels", "count_posts",
]


def active_users_fact(current: DataFrame, legacy: DataFrame, as_of: str, server_spine: DataFrame | None = None) -> DataFrame:
    """Active users per server-day and client of both pipelines, next to the counts the server itself reported."""
    names = {f"{span}_{name}": (m, n) for m, name in FACT_COLUMNS.items() for span, n in SPAN_DAYS.items()}
    counted = active_counts(_merged_flags(current, legacy), ["server_id"], "user_id", "activity_date", names, as_of)
    if server_spine is None:
        return counted.withColumn("daily_server_id", text.surrogate_key(*SERVER_DAY))
    reported = [c for c in REPORTED if c in server_spine.columns]
    server = server_spine.select(
        *SERVER_DAY, F.col("daily_active_users").alias("server_daily_active_users"), F.col("monthly_active_users").alias("server_monthly_active_users"),
        *reported, "version_full", "is_missing_activity_data", F.lit(True).alias("_server"),
    )
    both = counted.withColumn("_user", F.lit(True)).join(server, SERVER_DAY, "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select(
        text.surrogate_key(*SERVER_DAY).alias("daily_server_id"), *SERVER_DAY, *[zero(n) for n in names],
        *[zero(c) for c in ["server_daily_active_users", "server_monthly_active_users", *reported]],
        text.surrogate_key("version_full").alias("version_id"), F.coalesce("is_missing_activity_data", F.lit(True)).alias("is_missing_server_activity_data"),
        F.col("_user").isNotNull().alias("has_user_telemetry_data"), F.col("_server").isNotNull().alias("has_server_telemetry_data"),
    )


# ---------------------------------------------------------------- servers


def latest_daily(df: DataFrame, columns: Sequence[str], as_of: str, key: str = "server_id", ts: str = "timestamp", tie: str | None = None,
                 reported: str | None = None) -> DataFrame:
    """Last record per key and day up to ``as_of``; with ``reported`` also the distinct values of that day.

    One aggregate that is combined before the shuffle, whatever the number of records of a key.
    """
    at = F.struct(ts, *([tie] if tie else []))
    day = F.to_date(ts)
    extra = []
    if reported:
        values = F.array_sort(F.collect_set(reported))
        extra = [values.alias("reported_versions"), F.size(values).alias("count_reported_versions")]
    rows = df.where(day <= F.lit(as_of).cast("date")).groupBy(key, day.alias("server_date")).agg(
        F.max_by(F.struct(*columns), at).alias("_top"), *extra
    )
    return rows.select(
        key, "server_date", text.surrogate_key(key, "server_date").alias("daily_server_id"), *[F.col(f"_top.{c}").alias(c) for c in columns],
        *(["reported_versions", "count_reported_versions"] if reported else []),
    )


def _life_span(frames: Sequence[DataFrame], key: str, day: str, start: str) -> DataFrame:
    spans = None
    for frame in frames:
        part = frame.where(F.col(day) >= F.lit(start).cast("date")).groupBy(key).agg(F.min(day).alias("first"), F.max(day).alias("last"))
        spans = part if spans is None else spans.unionByName(part)
    return spans.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def server_activity_spined(telemetry: DataFrame, legacy: DataFrame, diagnostics: DataFrame, activity: DataFrame, legacy_activity: DataFrame,
                           start: str) -> DataFrame:
    """Dense server-day rows over each server's life span, preferring telemetry over legacy over diagnostics.

    The sources hold one row per server and day (of several the greatest counts). They are stacked and moved once, by server; one
    sort serves the merge of a day's rows, the life span and the gaps, whose days repeat no source's values. A server holds
    at most five rows per day, so no partition of the windows grows beyond its days.
    """
    sources = {"t": telemetry, "l": legacy, "d": diagnostics, "a": activity, "b": legacy_activity}
    fields = {tag: [c for c in df.columns if c not in ("server_id", "server_date", "daily_server_id")] for tag, df in sources.items()}

    def side(tag: str) -> DataFrame:
        return sources[tag].where(F.col("server_id").isNotNull()).select(
            "server_id", F.col("server_date").alias("activity_date"), F.struct(F.lit(True).alias("is_there"), *fields[tag]).alias(tag)
        )

    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), map(side, sources)).where(F.col("activity_date") >= F.lit(start).cast("date"))
    daily = stacked.repartition("server_id").groupBy(*SERVER_DAY).agg(*[F.max(tag).alias(tag) for tag in sources])
    own_day = F.when(F.col("t").isNotNull() | F.col("l").isNotNull() | F.col("d").isNotNull(), F.col("activity_date"))
    server = Window.partitionBy("server_id")
    lived = daily.withColumns({"_first": F.min(own_day).over(server), "_last": F.max(own_day).over(server)}).where(F.col("activity_date").between(F.col("_first"), F.col("_last")))
    following = F.lead("activity_date").over(server.orderBy("activity_date"))
    until = lived.withColumns({"_from": F.col("activity_date"), "_to": F.coalesce(F.date_sub(following, 1), F.col("activity_date"))})
    dense = joins.dense_days(until, "_from", "_to")
    seen = F.col("activity_date") == F.col("_from")
    out = dense.select(
        *SERVER_DAY, F.datediff("activity_date", "_first").alias("age_in_days"),
        *[F.when(seen, F.col(f"{tag}.{c}")).alias(f"{tag}_{c}") for tag in sources for c in fields[tag]],
        *[F.when(seen, F.col(f"{tag}.is_there")).alias(f"_{tag}") for tag in sources],
    )

    def first_of(name: str, tags: str, default=None) -> Column:
        found = [F.col(f"{t}_{name}") for t in tags if f"{t}_{name}" in out.columns]
        if default is not None:
            found.append(F.lit(default))
        return F.coalesce(*found)

    has = lambda tag: F.col(f"_{tag}").isNotNull()
    enterprise = F.coalesce("t_edition", "l_edition", "d_is_enterprise_ready")
    database = F.coalesce("t_database_version", "l_database_version")
    semver = text.database_semver(database)
    empty = F.array().cast("array<string>")
    versions = F.array_distinct(F.concat(*[F.coalesce(F.col(f"{t}_reported_versions"), empty) for t in "tld"]))
    registered = first_of("count_registered_users", "ab")
    return out.select(
        text.surrogate_key(*SERVER_DAY).alias("daily_server_id"), *SERVER_DAY, first_of("version_full", "tld").alias("version_full"),
        first_of("operating_system", "tld").alias("operating_system"), first_of("database_type", "tld").alias("database_type"),
        database.alias("database_version"), semver.alias("database_version_semver"), text.version_part(semver, 1).alias("database_version_major"),
        text.version_part(semver, 2).alias("database_version_minor"), enterprise.alias("is_enterprise_ready"),
        F.when(enterprise, "E0").when(~enterprise, "TE").otherwise("Unknown").alias("binary_edition"), F.col("t_installation_id").alias("installation_id"),
        F.when(has("t"), F.col("t_installation_id").isNotNull()).alias("is_cloud"), first_of("server_ip", "td").alias("server_ip"),
        F.col("t_installation_type").alias("installation_type"), versions.alias("reported_versions"), F.size(versions).alias("count_reported_versions"),
        F.coalesce("a_daily_active_users", "b_daily_active_users", "d_count_active_users", F.lit(0)).alias("daily_active_users"),
        first_of("monthly_active_users", "ab", 0).alias("monthly_active_users"),
        F.coalesce(registered, F.col("d_count_users"), F.lit(0)).alias("count_registered_users"),
        first_of("count_registered_deactivated_users", "ab", 0).alias("count_registered_deactivated_users"),
        (registered - first_of("count_registered_deactivated_users", "ab")).alias("count_registered_active_users"),
        *[first_of(c, "ab", 0).alias(c) for c in REPORTED if c not in ("count_registered_users", "count_registered_deactivated_users", "count_teams")
          and any(f"{t}_{c}" in out.columns for t in "ab")],
        *([first_of("count_teams", "abd", 0).alias("count_teams")] if any(f"{t}_count_teams" in out.columns for t in "abd") else []),
        "age_in_days", has("t").alias("has_telemetry_data"), has("l").alias("has_legacy_telemetry_data"), has("d").alias("has_diagnostics_data"),
        (~has("a") & ~has("b")).alias("is_missing_activity_data"),
    )


def product_activity_spined(client: DataFrame, server: DataFrame, start: str) -> DataFrame:
    """Product usage per server-day from client events and from server reports, dense over the life span."""
    server = server.withColumnRenamed("server_date", "activity_date")
    spine = joins.dense_days(_life_span([client, server], "server_id", "activity_date", start), "first", "last").select(*SERVER_DAY)
    counts = ["daily_active_users", "weekly_active_users", "monthly_active_users"]
    c = client.select(*SERVER_DAY, *counts, F.lit(True).alias("_client"))
    s = server.select(
        *SERVER_DAY, *[F.col(x).alias(f"server_{x}") for x in counts if x in server.columns], "count_registered_users", F.lit(True).alias("_server")
    )
    out = spine.join(c, SERVER_DAY, "left").join(s, SERVER_DAY, "left")
    numbers = [x for x in out.columns if x.endswith("users")]
    return out.select(
        text.surrogate_key(*SERVER_DAY).alias("daily_server_id"), *SERVER_DAY, *[F.coalesce(x, F.lit(0)).alias(x) for x in numbers],
        F.col("_client").isNotNull().alias("has_client_data"), F.col("_server").isNotNull().alias("has_server_data"),
    )


# Upper bounds (exclusive) and labels of the registered-user bins.
USER_BINS = [(10, "< 10"), (100, "10-100"), (250, "100-250"), (500, "250-500"), (1000, "500-1000"), (2500, "1000-2500")]


def active_servers_fact(server_spine: DataFrame, licence_days: DataFrame) -> DataFrame:
    """Server-days with their size bin and whether a licence was reported that day."""
    known = licence_days.select(*SERVER_DAY).distinct().withColumn("_licence", F.lit(True))
    return server_spine.join(known, SERVER_DAY, "left").select(
        "daily_server_id", *SERVER_DAY, text.surrogate_key("version_full").alias("version_id"), "installation_type",
        band("count_registered_active_users", USER_BINS, ">=2500", "Unknown").alias("registered_user_bin"), "daily_active_users",
        "count_registered_active_users", "is_enterprise_ready", "count_reported_versions", "has_telemetry_data", "has_legacy_telemetry_data",
        "has_diagnostics_data", "is_missing_activity_data", F.col("_licence").isNull().alias("is_missing_license_data"),
    )


def retention_at_day(active_users: DataFrame, server_info: DataFrame, ages: DataFrame, day: int = 28) -> DataFrame:
    """Servers with their activity at a given age in days."""
    at = ages.where(F.col("age_in_days") == day).select("daily_server_id")
    found = active_users.join(at, "daily_server_id").select("server_id", "daily_active_users", "server_daily_active_users", F.lit(True).alias("_hit"))
    return server_info.join(found, "server_id", "left").select(
        "server_id", F.col("first_activity_date").alias("active_since_date"), F.col("daily_active_users").isNotNull().alias(f"is_active_at_day_{day}"),
        F.coalesce("daily_active_users", F.lit(0)).alias("daily_active_users"),
        F.coalesce("server_daily_active_users", F.lit(0)).alias("server_daily_active_users"),
    )


# ---------------------------------------------------------------- retention


def first_active(events: DataFrame, keys: Sequence[str] = ("user_id", "server_id")) -> DataFrame:
    return events.where(F.col("user_id").isNotNull()).groupBy(*keys).agg(F.min("timestamp").alias("first_active_timestamp")).withColumn(
        "id", text.surrogate_key(*keys, old=True)
    )


def _hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def retention_window(events: DataFrame, as_of: str, start_hours: int = 672, end_hours: int = 696) -> DataFrame:
    """Whether a user came back inside the window after the first event on a server.

    Return visits count on any server. Users whose window is still open at ``as_of`` are left out.
    The lookup is an equi join on the user, reduced to the window before the aggregate.
    """
    first = first_active(events)
    closed = first.where(F.col("first_active_timestamp") + _hours(end_hours) <= F.lit(as_of).cast("timestamp_ntz"))
    t0 = F.col("first_active_timestamp")
    inside = F.col("timestamp").between(t0 + _hours(start_hours), t0 + _hours(end_hours))
    visits = events.select("user_id", "timestamp")
    hits = visits.join(closed, "user_id").where(inside).groupBy("id").agg(F.max("timestamp").alias("retained_timestamp"))
    return closed.join(hits, "id", "left").select(
        t0, "server_id", "user_id", F.col("retained_timestamp").isNotNull().alias("is_retained"), "retained_timestamp", "id"
    )


# Flag name, first and last day after the first event.
RETENTION_BANDS = {"0day": (0, 1), "1day": (1, 2), "7day": (2, 7), "14day": (7, 14), "28day": (14, 28)}


def retention_flags(events: DataFrame) -> DataFrame:
    """One row per user and server with a flag per retention band (any visit of the user in the band)."""
    first = first_active(events)
    t0 = F.col("first_active_timestamp")
    age = lambda lo, hi: F.col("timestamp").between(t0 + _hours(24 * lo), t0 + _hours(24 * hi))
    visits = events.select("user_id", "timestamp").join(first.select("user_id", "id", t0), "user_id")
    return visits.groupBy("id").agg(
        F.first("user_id").alias("user_id"), F.first(t0).alias("first_active_timestamp"),
        *[F.max(age(lo, hi)).alias(f"retention_{n}_flag") for n, (lo, hi) in RETENTION_BANDS.items()],
    ).join(first.select("id", "server_id"), "id")


def retention_age_band(events: DataFrame) -> DataFrame:
    """Band of days between the first event on a server and the user's last event anywhere."""
    last = events.groupBy("user_id").agg(F.to_date(F.max("timestamp")).alias("last_active_date"))
    age = F.datediff("last_active_date", F.to_date("first_active_timestamp"))
    return first_active(events).join(last, "user_id").withColumn(
        "age", band(age, [(1, "AGE 0"), (7, "AGE 1 - 6"), (28, "AGE 7 - 27")], "AGE 28+")
    )


# ---------------------------------------------------------------- segments


def mau_segments(events: DataFrame, as_of: str, categories: Sequence[str] = ()) -> DataFrame:
    """Dense user-server-day rows before ``as_of`` with event counts, trailing totals and the monthly segment.

    ``events``: user_id, server_id, user_role, received_at, client, category. Segments are per user,
    over all servers, on the summed counts of the day.
    """
    today = F.lit(as_of).cast("date")
    key = ["user_id", "server_id"]
    used = events.where(F.col("user_id").isNotNull()).withColumn("date", F.to_date("received_at"))
    admin = F.coalesce("user_role", F.lit("none")).isin(ADMIN_ROLES)
    client = lambda name: F.count_if(F.col("client") == name)
    daily = used.groupBy(*key, "date").agg(
        F.bool_or(admin).alias("system_admin"), F.bool_or(~admin).alias("system_user"), F.count("*").alias("total_events"),
        client("Desktop").alias("desktop_events"), client("WebApp").alias("web_app_events"), client("Mobile").alias("mobile_events"),
        *[F.count_if(F.col("category") == c).alias(f"{text.slug(c)}_events") for c in categories], F.max("received_at").alias("max_timestamp"),
    )
    span = daily.groupBy(*key).agg(F.min("date").alias("_first"), F.greatest(F.max("date"), today).alias("_last"))
    dense = joins.dense_days(span, "_first", "_last", "date").join(daily, [*key, "date"], "left")
    counts = [c for c in daily.columns if c.endswith("_events")]
    dense = dense.select(
        "date", *key, "_first", F.coalesce("system_admin", F.lit(False)).alias("system_admin"), F.coalesce("system_user", F.lit(True)).alias("system_user"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "max_timestamp",
    ).where(F.col("date") < today)

    # Trailing totals are differences of running sums, so the length of the span costs nothing.
    dense = windows.trailing_sums(dense, key, "date", {
        "events_last_30_days": ("total_events", 31), "events_last_31_days": ("total_events", 32), "mobile_events_last_30_days": ("mobile_events", 31),
    })
    w = Window.partitionBy(*key).orderBy("date")
    ever = w.rowsBetween(Window.unboundedPreceding, 0)
    total, mobile, first_day = F.col("total_events"), F.col("mobile_events"), F.col("_first")
    quiet_before = (F.col("events_last_30_days") - total == 0) & (F.col("date") > first_day)
    segment = (
        F.when((first_day == F.col("date")) & (total > 0), "First Time MAU")
        .when(quiet_before & (total > 0), "Reengaged MAU")
        .when(F.col("events_last_30_days") > 0, "Current MAU")
        .when(F.lag(total, 31).over(w) > 0, "Newly Disengaged")
        .otherwise("Disengaged")
    )
    out = dense.withColumns({
        "mau_segment": segment, "events_alltime": F.sum(total).over(ever), "max_events": F.max(total).over(ever), "mobile_events_alltime": F.sum(mobile).over(ever),
        "max_mobile_events": F.max(mobile).over(ever), "last_active_date": F.max(F.when(total > 0, F.col("date"))).over(ever),
    })
    return out.withColumnRenamed("_first", "first_active_date").withColumns({
        "active": total > 0, "mau": F.col("mau_segment").isin("First Time MAU", "Reengaged MAU", "Current MAU"),
        "id": text.surrogate_key("date", "user_id", "server_id", old=True),
    })


def server_events_by_date(segments: DataFrame, events: DataFrame, posts: Sequence[str], invites: Sequence[str]) -> DataFrame:
    """Active users per segment and event totals per server-day; post and invite events come from the raw events."""
    special = events.where(F.col("event").isin([*posts, *invites])).groupBy(F.to_date("timestamp").alias("date"), "server_id").agg(
        F.count_if(F.col("event").isin(list(posts))).alias("post_events"), F.count_if(F.col("event").isin(list(invites))).alias("invite_members_events")
    )
    mau = F.col("mau")
    # A user has one row per server-day, so distinct users are plain conditional counts.
    count = lambda test: F.count_if(test)
    totals = [c for c in segments.columns if c.endswith("_events") and not c.startswith("max_")]
    daily = segments.groupBy("date", "server_id").agg(
        F.min("first_active_date").alias("first_active_date"), F.max("last_active_date").alias("last_active_date"), count(F.col("active")).alias("dau_total"),
        count(F.col("active") & (F.col("mobile_events") > 0)).alias("mobile_dau"), count(F.col("active") & F.col("system_admin")).alias("system_admin_dau"),
        count(mau).alias("mau_total"), *[count(F.col("mau_segment") == s).alias(f"{text.slug(s)}") for s in ("First Time MAU", "Reengaged MAU", "Current MAU")],
        count(mau & F.col("system_admin")).alias("system_admin_mau"), *[F.sum(c).alias(c) for c in totals],
        *[F.sum(c).alias(c) for c in ("events_last_30_days", "events_last_31_days", "events_alltime")], F.count("*").alias("users"),
    )
    return daily.join(special, ["date", "server_id"], "left").withColumn("id", text.surrogate_key("date", "server_id", old=True))


def user_events_by_date(current: DataFrame, legacy: DataFrame, as_of: str, agent: str = "context_user_agent") -> DataFrame:
    """Counts per user, day, event and agent; legacy events only before the server's first day on the new pipeline.

    Missing user or server ids are filled from a later row of the same day.
    """
    cut = current.groupBy("server_id").agg(F.to_date(F.min("timestamp")).alias("_cut"))
    old = legacy.join(cut, "server_id", "left").where(F.col("_cut").isNull() | (F.to_date("timestamp") < F.col("_cut"))).drop("_cut")
    both = current.withColumn("source", F.lit("current")).unionByName(old.withColumn("source", F.lit("legacy")))
    kind = F.when(F.contains(F.lower(agent), F.lit("electron")), "desktop").otherwise("web_app")
    daily = both.where(F.to_date("timestamp") < F.lit(as_of).cast("date")).groupBy(
        "source", F.to_date("timestamp").alias("date"), F.trim("server_id").alias("server_id"), F.trim("user_id").alias("user_id"),
        F.lower("event").alias("event_name"), agent,
    ).agg(F.count("*").alias("total_events"), F.max("timestamp").alias("max_timestamp"), F.min("timestamp").alias("min_timestamp"))
    daily = daily.select(
        "*", agents.browser(agent).alias("browser"), agents.operating_system(agent).alias("os"), agents.browser_version(agent).alias("browser_version"),
        agents.os_version(agent).alias("os_version"), kind.alias("event_type"),
    ).withColumns({
        "desktop_events": F.when(F.col("event_type") == "desktop", F.col("total_events")).otherwise(0),
        "web_app_events": F.when(F.col("event_type") == "web_app", F.col("total_events")).otherwise(0),
    })
    # A NULL key would gather all its rows in one window task, so only complete keys are scanned.
    later = lambda *keys: Window.partitionBy(*keys).orderBy("min_timestamp").rowsBetween(0, Window.unboundedFollowing)
    hour = F.date_trunc("hour", "min_timestamp")
    known_user = daily.where(F.col("user_id").isNotNull()).withColumn("server_id", F.coalesce("server_id", F.max("server_id").over(later("date", "user_id"))))
    no_user = daily.where(F.col("user_id").isNull())
    donors = daily.where(F.col("user_id").isNotNull()).groupBy("date", "server_id", agent, "min_timestamp").agg(F.max("user_id").alias("donor"))
    line = no_user.select("*", F.lit(None).cast("string").alias("donor")).unionByName(donors, allowMissingColumns=True)
    filled = windows.max_from_here(line, ["date", "server_id", agent], hour, "min_timestamp", "donor", "_fill").where(F.col("event_name").isNotNull()).withColumn(
        "user_id", F.col("_fill")
    ).drop("_fill", "donor")
    return known_user.unionByName(filled).withColumn("id", text.surrogate_key(
        "date", "user_id", "server_id", agent, "event_name", "os", "browser_version", "os_version", "min_timestamp", "max_timestamp", old=True
    ))


def user_daily_details(segments: DataFrame) -> DataFrame:
    """Running first and last days, active-day counts and totals per user."""
    w = windows.running(["user_id"], "date", "server_id")
    when_day = lambda test: F.when(test, F.col("date"))
    out = {}
    for name, c in {"active": "total_events", "webapp": "web_app_events", "desktop": "desktop_events", "mobile": "mobile_events"}.items():
        used = when_day(F.col(c) > 0)
        out[f"first_{name}_date"] = F.min(used).over(w)
        out[f"last_{name}_date"] = F.max(used).over(w)
        out[f"{name}_active_days"] = F.count(used).over(w)
    counted = {
        "days_in_mau": F.col("mau"), "reengaged_count": F.col("mau_segment") == "Reengaged MAU", "disengaged_count": F.col("mau_segment") == "Newly Disengaged",
        "days_not_in_mau": ~F.col("mau") & (F.col("events_alltime") > 0), "days_inactive": ~F.col("active") & (F.col("events_alltime") > 0),
    }
    out |= {n: F.count(when_day(test)).over(w) for n, test in counted.items()}
    days = F.nullif(F.count(when_day(F.col("events_alltime") > 0)).over(w), F.lit(0))
    for name, c in {"": "total_events", "webapp_": "web_app_events", "desktop_": "desktop_events", "mobile_": "mobile_events"}.items():
        total = F.sum(c).over(w)
        out[f"{name}events_alltime"] = total
        out[f"avg_{name}events_per_day"] = F.try_divide(total, days).cast("double")
    rows = segments.withColumns(out).withColumn("days_first_to_last_active", F.datediff("last_active_date", "first_active_date"))
    # The home server of a user is the largest id seen, over all days.
    home = segments.groupBy("user_id").agg(F.max("server_id").alias("server_id"))
    return rows.drop("server_id").join(home, "user_id").select("date", "user_id", "server_id", *out, "days_first_to_last_active").withColumnRenamed(
        "active_active_days", "days_active"
    )


ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"]


def user_fact(details: DataFrame, events: DataFrame) -> DataFrame:
    """Latest running row of each user, first server and the first ten events as columns."""
    last = windows.latest(details, ["user_id"], "date")
    first = details.groupBy("user_id").agg(F.min_by("server_id", "date").alias("first_server_id"), F.countDistinct("server_id").alias("server_count"))
    opening = windows.top_k(events, ["user_id"], [F.asc("timestamp"), F.asc("event_id")], 10, rank="_n")
    named = opening.groupBy("user_id").agg(
        *[F.max(F.when(F.col("_n") == i + 1, F.col("event"))).alias(f"{o}_event") for i, o in enumerate(ORDINALS)], F.count("*").alias("events_performed")
    )
    return last.join(first, "user_id").join(named, "user_id")


# ---------------------------------------------------------------- server history


def server_daily_details_filled(security: DataFrame, server: DataFrame, as_of: str, attributes: Sequence[str]) -> DataFrame:
    """Dense server-days from two sources; attributes keep their last known value, days without a report are flagged."""
    today = F.lit(as_of).cast("date")
    day = ["server_id", "date"]
    seen = security.select(*day).unionByName(server.select(*day)).where(F.col("date") <= today)
    span = seen.groupBy("server_id").agg(F.min("date").alias("_a"), F.least(F.max("date"), today).alias("_b"))
    tag = lambda df, t: df.select(*day, *[F.col(a).alias(f"{t}_{a}") for a in attributes if a in df.columns], F.lit(True).alias(f"_{t}"))
    dense = joins.dense_days(span, "_a", "_b", "date").select(*day).join(tag(server, "s"), day, "left").join(tag(security, "x"), day, "left")
    value = {a: F.coalesce(*[F.col(f"{t}_{a}") for t in "sx" if f"{t}_{a}" in dense.columns]) for a in attributes}
    rows = dense.select(*day, *[v.alias(a) for a, v in value.items()], F.col("_x").isNotNull().alias("in_security"), F.col("_s").isNotNull().alias("in_server"))
    filled = windows.forward_fill(rows, ["server_id"], "date", list(attributes), suffix="_known")
    return filled.select(
        *day, *[F.col(f"{a}_known").alias(a) for a in attributes], "in_security", "in_server",
        (~F.col("in_security") & ~F.col("in_server")).alias("tracking_disabled"), text.surrogate_key("date", "server_id", old=True).alias("id"),
    )


def server_upgrades(details: DataFrame, as_of: str) -> DataFrame:
    """Days on which a tracked server moved to a higher version or from the team to the enterprise edition."""
    w = windows.window(["server_id"], "date")
    moves = details.where(~F.col("tracking_disabled")).withColumns({
        "prev_version": F.lag("version").over(w), "prev_edition": F.lag("edition").over(w)
    })
    higher = text.version_number("version") > text.version_number(F.coalesce("prev_version", "version"))
    to_enterprise = (F.col("edition") == "true") & (F.coalesce("prev_edition", F.lit("true")) == "false")
    return moves.where((F.coalesce(higher, F.lit(False)) | F.coalesce(to_enterprise, F.lit(False))) & (F.col("date") <= F.lit(as_of).cast("date"))).select(
        "date", "server_id", "prev_version", F.col("version").alias("current_version"), "prev_edition", F.col("edition").alias("current_edition"),
        text.surrogate_key("date", "server_id", old=True).alias("id"),
    )


# Registered-user milestones.
MILESTONES = [(100, "100"), (500, "500"), (1000, "1k"), (2500, "2500"), (5000, "5k"), (10000, "10k")]
SERVER_BANDS = {**RETENTION_BANDS, "1week": (0, 7), "2week": (7, 14), "3week": (14, 21), "4week": (21, 28)}


def server_fact(details: DataFrame, reports: DataFrame, events: DataFrame, upgrades: DataFrame, licences: DataFrame, as_of: str) -> DataFrame:
    """One row per server: life span, first and last attributes, milestones, maxima, retention and licence dates.

    ``details`` as from :func:`server_daily_details_filled`; ``reports``: server_id, date, user_count,
    active_users, posts; ``events``: server_id, user_id, timestamp, category; ``licences``: server_id,
    trial, issued_date, expire_date, company.
    """
    active = F.col("in_security") | F.col("in_server")
    dated = lambda c: F.when(F.col(c).isNotNull(), F.col("date"))
    base = details.groupBy("server_id").agg(
        F.min(F.when(active, F.col("date"))).alias("first_active_date"), F.max(F.when(active, F.col("date"))).alias("last_active_date"),
        F.min(F.when(F.col("in_security"), F.col("date"))).alias("first_telemetry_active_date"),
        F.max(F.when(F.col("in_security"), F.col("date"))).alias("last_telemetry_active_date"),
        *[f(c, dated(c)).alias(n) for c, (lo, hi) in {"version": ("first_server_version", "version"), "edition": ("first_server_edition", "server_edition")}.items()
          for f, n in ((F.min_by, lo), (F.max_by, hi))],
    )
    sizes = reports.where(F.col("date") < F.lit(as_of).cast("date")).groupBy("server_id").agg(
        F.max("active_users").alias("max_active_user_count"), F.max("user_count").alias("max_registered_users"), F.max("posts").alias("max_posts"),
        *[F.min(F.when(F.col("user_count") > n, F.col("date"))).alias(f"first_{label}reg_users_date") for n, label in MILESTONES],
    )
    moved = upgrades.groupBy("server_id").agg(
        F.count_if(F.col("current_version") > F.col("prev_version")).alias("version_upgrade_count"),
        F.count_if((F.col("prev_edition") == "false") & (F.col("current_edition") == "true")).alias("edition_upgrade_count"),
    )
    t0 = F.col("first_active_date").cast("timestamp_ntz")
    retained = F.col("category") != "performance"

    def inside(lo: int, hi: int | None) -> Column:
        test = F.col("timestamp").between(t0 + _hours(24 * lo), t0 + _hours(24 * hi)) if hi else F.col("timestamp") > t0 + _hours(24 * lo)
        return retained & test

    bands = {**SERVER_BANDS, "28day_above": (28, None)}
    # Per user first (combined before the shuffle), then distinct users are counts of users.
    per_user = events.where(F.col("user_id").isNotNull()).join(base.select("server_id", "first_active_date"), "server_id").groupBy("server_id", "user_id").agg(
        *[F.bool_or(inside(lo, hi)).alias(f"_{n}") for n, (lo, hi) in bands.items()], F.max(F.to_date("timestamp")).alias("_last")
    )
    usage = per_user.groupBy("server_id").agg(
        *[F.bool_or(F.coalesce(f"_{n}", F.lit(False))).alias(f"retention_{n}_flag") for n in bands],
        *[F.count_if(F.col(f"_{n}")).alias(f"retention_{n}_users") for n in bands], F.count("*").alias("active_users_alltime"), F.max("_last").alias("last_event_date"),
    )
    days = events.where(F.col("user_id").isNotNull()).groupBy("server_id", F.to_date("timestamp").alias("d")).agg(F.count("*").alias("_n")).groupBy("server_id").agg(
        F.count("*").alias("days_active"), (F.datediff(F.lit(as_of).cast("date"), F.min("d")) - F.count("*")).alias("days_inactive")
    )
    paid = ~F.col("trial")
    bought = licences.groupBy("server_id").agg(
        *[f(F.when(test, F.col("issued_date"))).alias(f"{n}_{kind}_license_date") for kind, test in {"paid": paid, "trial": F.col("trial")}.items()
          for f, n in ((F.min, "first"), (F.max, "last"))],
        F.max("company").alias("company"), F.max(F.when(paid, F.col("expire_date"))).alias("paid_license_expire_date"),
    )
    out = base
    for part in (sizes, moved, usage, days, bought):
        out = out.join(part, "server_id", "left")
    users = F.greatest(F.coalesce("max_active_user_count", F.lit(0)), F.coalesce("active_users_alltime", F.lit(0)))
    out = out.withColumn("max_active_user_count", users).withColumn("_customer", F.coalesce(F.lower("company"), "server_id"))
    return windows.group_stats(
        out, ["_customer"], customer_first_active_date=F.min("first_active_date"), customer_first_paid_license_date=F.min("first_paid_license_date")
    ).drop("_customer")


def plugin_daily_usage(events: DataFrame, as_of: str, actions: dict[str, tuple[str, str]]) -> DataFrame:
    """Per server, plugin version and day: counts of the day and so far, and exact trailing users of the server.

    ``events``: id, server_id, plugin_version, user_id, timestamp, event, action. ``actions`` names a
    count per (event, action). Running counts are sums of daily sums; trailing users come from sweeps,
    so no event is compared with more than its own day.
    """
    today = F.lit(as_of).cast("date")
    rows = events.where(F.to_date("timestamp") <= today).withColumn("date", F.to_date("timestamp"))
    version = ["server_id", "plugin_version"]
    spans = rows.groupBy(*version).agg(F.min("timestamp").alias("_t")).withColumn("first_version_date", F.to_date("_t"))
    following = F.lead("_t").over(windows.window(["server_id"], "_t"))
    spans = spans.withColumn("last_version_date", F.coalesce(F.to_date(following - F.expr("interval 1 day")), today)).drop("_t")
    days = joins.dense_days(spans, "first_version_date", today, "date")

    daily = rows.groupBy(*version, "date").agg(
        *[F.count_if((F.col("event") == e) & (F.col("action") == a)).alias(n) for n, (e, a) in actions.items()],
        F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"),
    )
    users = rows.groupBy(*version, "user_id", "date").agg(F.count("*").alias("_n")).where(F.col("user_id").isNotNull())
    seen = joins.first_seen_running(users, version, "user_id", "date", "_users")
    out = days.join(daily, [*version, "date"], "left").join(seen, [*version, "date"], "left")
    for span, name in ((1, "daily_active_users"), (8, "weekly_active_users"), (31, "monthly_active_users")):
        out = out.join(joins.trailing_distinct(users, ["server_id"], "user_id", "date", span, name), ["server_id", "date"], "left")
        out = out.join(joins.trailing_distinct(users, version, "user_id", "date", span, f"{name}_version"), [*version, "date"], "left")
    w = windows.running(version, "date")
    numbers = [f"{n}_active_users{v}" for n in ("daily", "weekly", "monthly") for v in ("", "_version")]
    return out.select(
        "date", text.surrogate_key("date", *version, old=True).alias("id"), *version, "first_version_date", "last_version_date",
        F.min("_first").over(w).alias("first_active"), F.max("_last").over(w).alias("last_active"), F.max("_users").over(w).alias("version_users_to_date"),
        *[F.coalesce(n, F.lit(0)).alias(n) for n in actions], *[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"{n}_alltime") for n in actions],
        *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers],
    )


def plugin_fact(daily: DataFrame, actions: Sequence[str]) -> DataFrame:
    """One row per server: maxima over all days, counts at the last day of each version, active days."""
    closing = F.col("date") == F.col("last_version_date")
    return daily.groupBy("server_id").agg(
        F.min("date").alias("first_active_date"), F.max("last_active").alias("last_active_date"), F.max("plugin_version").alias("current_plugin_version"),
        F.max("version_users_to_date").alias("users_max"), *[F.max(f"{n}_active_users").alias(f"{n}_active_users_max") for n in ("daily", "weekly", "monthly")],
        *[F.sum(F.when(closing, F.col(f"{a}_alltime")).otherwise(0)).alias(a) for a in actions],
        F.countDistinct(F.when(F.col("daily_active_users") > 0, F.col("date"))).alias("days_active"),
    )


def server_summary(server_days: Sequence[DataFrame], user_days: Sequence[DataFrame], diagnostic_days: DataFrame) -> DataFrame:
    """Active days per signal over the union of server ids. Inputs: (server_id, date)."""

    def summary(frames: Sequence[DataFrame], count: str, prefix: str) -> DataFrame:
        days = None
        for f in frames:
            part = f.toDF("server_id", "date")
            days = part if days is None else days.unionByName(part)
        return days.groupBy("server_id").agg(
            F.countDistinct("date").alias(count), F.min("date").alias(f"{prefix}_first_date"), F.max("date").alias(f"{prefix}_last_date")
        )

    counts = ["count_server_active_days", "count_user_active_days", "count_diagnostics_active_days"]
    parts = [summary(server_days, counts[0], "server_telemetry"), summary(user_days, counts[1], "user_telemetry"), summary([diagnostic_days], counts[2], "diagnostics_telemetry")]
    return joins.presence_join(parts, ["server_id"]).fillna(0, counts)


def first_last_summary(spine: DataFrame, key: str, first: Sequence[str], last: Sequence[str], distinct: str | None = None) -> DataFrame:
    """First and last day and attribute values per key, one aggregate instead of a window over all days."""
    at_first = F.struct("activity_date", "daily_server_id")
    rows = spine.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(
        F.min("activity_date").alias("first_activity_date"), F.max("activity_date").alias("last_activity_date"),
        *[F.min_by(F.struct(c), at_first)[c].alias(f"first_{c}") for c in first], *[F.max_by(F.struct(c), at_first)[c].alias(f"last_{c}") for c in last],
        *([F.countDistinct(distinct).alias(f"count_{distinct}s")] if distinct else []),
    )


def hosting_type(server_spine: DataFrame, user_servers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Cloud or self-hosted when all days agree, else unknown; with the latest installation and its host name.

    ``subscriptions``: installation_id, hostname, created_at.
    """
    votes = server_spine.groupBy("server_id").agg(
        F.count_if(F.col("is_cloud")).alias("cloud"), F.count_if(~F.col("is_cloud")).alias("own"),
        F.max_by(F.struct("installation_id"), "activity_date").alias("_top"),
    )
    both = votes.join(user_servers.select("server_id").distinct(), "server_id", "full")
    cloud, own = F.coalesce("cloud", F.lit(0)), F.coalesce("own", F.lit(0))
    newest = windows.latest(subscriptions.where(F.col("installation_id").isNotNull()), ["hostname"], "created_at", "installation_id")
    typed = both.select(
        "server_id", F.when((cloud > 0) & (own == 0), "Cloud").when((cloud == 0) & (own > 0), "Self-hosted").otherwise("Unknown").alias("hosting_type"),
        F.col("_top.installation_id").alias("installation_id"),
    )
    return typed.join(newest.select("installation_id", F.col("hostname").alias("cloud_hostname")), "installation_id", "left").select(
        "server_id", "hosting_type", "installation_id", "cloud_hostname"
    )


def security_exclusions(logs: DataFrame, restricted_ips: Sequence[str]) -> DataFrame:
    """Servers with suspicious log lines: one row per server and reason."""
    flags = logs.select(
        "server_id", F.when(F.col("server_ip").isin(list(restricted_ips)), "Restricted IP").alias("restricted_ip"),
        F.when(F.col("has_run_unit_tests"), "Ran Tests").alias("ran_tests"),
        F.when(F.col("count_users") < F.col("count_active_users"), "Active Users > Registered Users").alias("user_count_sanity_check"),
        F.when(F.col("is_custom_build_version_format"), "Custom Build Version Format").alias("custom_build_version_format"),
    )
    return aggregate.melt(flags, ["server_id"], flags.columns[1:], "explanation", "reason").select("server_id", "reason").distinct()


def single_day_exclusions(summary: DataFrame) -> DataFrame:
    """Servers that reported on one day only. The third rule looks at server days alone, as the source models do."""
    server, user, diag = (F.col(f"count_{n}_active_days") for n in ("server", "user", "diagnostics"))
    reason = (
        F.when((server == 1) & (user == 0), "Single day server-side telemetry only").when((server == 0) & (user == 1), "Single day user telemetry only")
        .when(server == 1, "Single day telemetry only").when((server == 0) & (diag == 1), "Single day security only")
    )
    return summary.select("server_id", reason.alias("reason")).where(F.col("reason").isNotNull())


def invalid_id_exclusions(summary: DataFrame, length: int = 26) -> DataFrame:
    return summary.where(F.length("server_id") != length).select("server_id", F.lit("Invalid server id").alias("reason"))


def excludable_entities(rule_outputs: Sequence[DataFrame], reasons: Sequence[str] | None = None, key: str = "server_id", prefix: str = "has_reason_") -> DataFrame:
    """Union of rule outputs as one boolean column per reason; ``reasons`` names them, else they are read from the data."""
    rows = None
    for part in rule_outputs:
        clean = part.where(F.col(key).isNotNull()).select(F.trim(key).alias(key), F.trim("reason").alias("reason"))
        rows = clean if rows is None else rows.unionByName(clean)
    values = list(reasons) if reasons is not None else aggregate.pivot_values(rows, "reason")
    return rows.groupBy(key).agg(*[F.bool_or(F.col("reason") == v).alias(prefix + text.slug(v)) for v in values])


def server_info(summary: DataFrame, user_days: DataFrame, hosting: DataFrame, countries: DataFrame, licence_days: DataFrame, known_licences: DataFrame,
                customers: DataFrame) -> DataFrame:
    """Server dimension: life span over both signals, hosting, last country and company.

    ``summary`` from :func:`first_last_summary`; ``countries``: server_id, last_known_ip_country;
    ``licence_days``: server_id, license_id, date; ``customers``: installation_id, name, created_at.
    """
    users = user_days.groupBy("server_id").agg(F.min("activity_date").alias("_uf"), F.max("activity_date").alias("_ul"))
    licence = windows.latest(licence_days.where(F.col("license_id").isNotNull()), ["server_id"], "date", "license_id").select("server_id", "license_id")
    company = licence.join(known_licences.select("license_id", "company_name"), "license_id", "left").select("server_id", "company_name")
    customer = windows.latest(customers, ["installation_id"], "created_at", "name").select("installation_id", F.col("name").alias("_customer"))
    base = summary.join(users, "server_id", "full").withColumns({
        "first_activity_date": F.least("first_activity_date", "_uf"), "last_activity_date": F.greatest("last_activity_date", "_ul"),
    }).drop("_uf", "_ul")
    out = base.join(hosting, "server_id", "left").join(countries, "server_id", "left").join(company, "server_id", "left").join(customer, "installation_id", "left")
    name = (
        F.when(F.col("hosting_type") == "Self-hosted", F.coalesce("company_name", F.lit("Unknown")))
        .when(F.col("hosting_type") == "Cloud", F.coalesce("_customer", F.lit("Unknown")))
        .when(F.col("hosting_type") == "Unknown", F.coalesce("company_name", "_customer", F.lit("Unknown")))
    )
    return out.withColumns({"company_name": name, "last_known_ip_country": F.coalesce("last_known_ip_country", F.lit("Unknown"))}).drop("_customer")


def daily_config(spine: DataFrame, sections: dict[str, DataFrame], combined: DataFrame, as_of: str) -> DataFrame:
    """Settings per server-day: the combined source wins over the per-section one.

    Each section and ``combined`` is a raw frame (server_id, timestamp, settings…, has_segment, has_rudder).
    """
    marks = ("has_segment", "has_rudder")
    out = spine.select("daily_server_id", "server_id", F.col("activity_date"))
    settings: dict[str, list[str]] = {}
    for tag, df in [("all", combined), *sections.items()]:
        columns = [c for c in df.columns if c not in ("server_id", "timestamp")]
        day = latest_daily(df, columns, as_of).select("daily_server_id", *[F.col(c).alias(f"{tag}__{c}") for c in columns])
        out = out.join(day, "daily_server_id", "left")
        for c in columns:
            if c not in marks:
                settings.setdefault(c, []).append(f"{tag}__{c}")

    def any_of(mark: str) -> Column:
        flag = F.lit(False)
        for tag in sections:
            flag = flag | F.coalesce(f"{tag}__{mark}", F.lit(False))
        return flag.alias(f"{mark}_telemetry_data")

    return out.select("daily_server_id", "server_id", "activity_date", *[F.coalesce(*cs).alias(n) for n, cs in settings.items()], *[any_of(m) for m in marks])


def feature_flag_details(flags: DataFrame, columns: Sequence[str], as_of: str) -> DataFrame:
    """Latest feature-flag record per server and day."""
    return latest_daily(flags, columns, as_of, tie="id")
