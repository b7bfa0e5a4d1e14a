"""Feature attribution, usage spines, the event registry and event marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import agents, rules as rule, text
from ..functions.agent_patterns import AgentPattern, parse_by_patterns
from ..operators import aggregate, joins, merge, windows

UNKNOWN = "unknown_features"
USER_DAY = ["activity_date", "server_id", "user_id"]


def _valid(events: DataFrame, as_of: str) -> DataFrame:
    return events.where(
        F.col("user_id").isNotNull() & F.col("server_id").isNotNull() & F.col("timestamp").isNotNull()
        & (F.col("received_at") <= F.lit(as_of).cast("timestamp_ntz"))
    )


def load_rules(plan: DataFrame) -> list[dict]:
    """Rules of a tracking plan (a seed file) in a fixed order."""
    return [r.asDict() for r in plan.orderBy(*plan.columns).collect()]


def attribute_features(events: DataFrame, plan: list[dict], as_of: str) -> DataFrame:
    """First rule that matches event, category and type, and the rule's property if it names one."""
    tests = []
    for r in plan:
        test = rule.equals_all({"event_name": r["event_name"], "category": r["category"], "event_type": r["event_type"]})
        if r.get("property_name"):
            p = F.col(r["property_name"])
            test = test & (p.isNotNull() if r.get("property_value") is None else p == F.lit(r["property_value"]))
        tests.append((test, r["feature_name"]))
    return _valid(events, as_of).select(
        F.to_date("received_at").alias("received_at_date"), F.to_date("timestamp").alias("activity_date"), "server_id", "user_id", "event_id", "event_name",
        rule.first_match(tests, UNKNOWN).alias("feature_name"),
    )


def attribute_features_server(events: DataFrame, target: DataFrame | None, as_of: str, lookback_days: int = 2) -> DataFrame:
    """Newest copy of each event received since the target's mark minus the lookback, not yet in the target."""
    rows = _valid(events, as_of)
    columns = [
        F.to_date("received_at").alias("received_at_date"), F.to_date("timestamp").alias("activity_date"), "server_id", "user_id", "event_id", "event_name",
        "feature_name",
    ]
    if target is not None:
        mark = merge.high_water_mark(target, "received_at_date")
        since = F.lit(mark - timedelta(days=lookback_days))
        rows = rows.where(F.col("received_at") >= since.cast("timestamp_ntz"))
        rows = rows.join(target.where(F.col("received_at_date") >= since).select("event_id"), "event_id", "left_anti")
    return windows.latest(rows, ["event_id"], "timestamp", "received_at").select(*columns)


def feature_usage_per_user_day(attributed: DataFrame, features: Sequence[str] | None = None, since=None) -> DataFrame:
    """Events per user-day and feature; ``since`` limits a run to days received from then on."""
    rows = attributed if since is None else attributed.where(F.col("received_at_date") >= F.lit(since))
    names = list(features) if features is not None else aggregate.pivot_values(attributed, "feature_name")
    known = [n for n in names if n != UNKNOWN]
    out = aggregate.pivot_known(rows, USER_DAY, "feature_name", names, prefix="count_", extra=[F.count("event_id").alias("count_total")])
    total = reduce(lambda a, b: a + b, [F.col(f"count_{text.slug(n)}") for n in known], F.lit(0).cast("bigint"))
    return out.withColumn("count_known_features", total).withColumn("daily_user_id", text.surrogate_key(*USER_DAY))


def planned_usage_per_user_day(events: DataFrame, plan: DataFrame, feature: str, as_of: str) -> DataFrame:
    """Usage of one product: events in its plan (event and action, NULL action equal to NULL) and others."""
    known = plan.select("event_name", "event_action").distinct().withColumn("_known", F.lit(True))
    rows = _valid(events, as_of).select("event_id", "event_name", "event_action", "server_id", "user_id", F.to_date("timestamp").alias("activity_date"))
    matched = joins.null_safe_join(rows, known, ["event_name", "event_action"], "left")
    # Copies of an event collapse first, then all distinct counts are plain counts.
    once = matched.groupBy(*USER_DAY, "event_id").agg(F.bool_or(F.col("_known")).alias("_known"), F.bool_or(F.col("_known").isNull()).alias("_unknown"))
    return once.groupBy(*USER_DAY).agg(
        F.count_if(F.col("_known")).alias(f"count_{feature}"), F.count_if(F.col("_known")).alias("count_known_features"),
        F.count_if(F.col("_unknown")).alias("count_unknown_features"), F.count("*").alias("count_total"),
    ).withColumn("daily_user_id", text.surrogate_key(*USER_DAY))


SHARED = ["count_known_features", "count_unknown_features", "count_total"]


def merge_partial_usage(parts: dict[str, DataFrame]) -> DataFrame:
    """Usage of all products per user-day: own counters side by side, shared counters summed.

    Counters are additive, so the frames are stacked and summed once instead of joined one by one.
    """
    counters = sorted({c for df in parts.values() for c in df.columns if c.startswith("count_")} | set(SHARED))
    stacked = None
    for df in parts.values():
        own = df.select(*USER_DAY, *[(F.col(c) if c in df.columns else F.lit(0)).cast("bigint").alias(c) for c in counters])
        stacked = own if stacked is None else stacked.unionByName(own)
    out = stacked.groupBy(*USER_DAY).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters])
    return out.withColumn("daily_user_id", text.surrogate_key(*USER_DAY))


def feature_spine(usage: DataFrame, as_of: str, start: str, days: int = 29) -> DataFrame:
    """Dense user-server-days up to ``days`` after the last activity, with daily and trailing counts per feature.

    Only servers with at least one known feature. The trailing frame holds the day and the ``days`` before.
    """
    counters = [c for c in usage.columns if c.startswith("count_")]
    known = usage.where(F.col("count_known_features") > 0).select("server_id").distinct()
    used = usage.where(F.col("activity_date") >= F.lit(start).cast("date")).join(known, "server_id", "left_semi")
    last = F.least(F.lit(as_of).cast("date"), F.date_add(F.max("activity_date"), days))
    # A counter steps up on its day and down when the frame has passed it: two rows per active day, added up on these
    # rows only and spread over the days last.
    up = F.struct(F.col("activity_date").alias("_at"), F.lit(1).alias("_sign"))
    down = F.struct(F.date_add("activity_date", days + 1).alias("_at"), F.lit(-1).alias("_sign"))
    steps = used.select("server_id", "user_id", *counters, F.lit(1).alias("is_active"), F.explode(F.array(up, down)).alias("_m")).select("*", "_m.*")
    today = lambda c: F.sum(F.when(F.col("_sign") > 0, F.col(c)).otherwise(0))
    marks = steps.groupBy("server_id", "user_id", "_at").agg(
        *[today(c).alias(c) for c in [*counters, "is_active"]], *[F.sum(F.col(c) * F.col("_sign")).alias(f"_t_{c}") for c in [*counters, "is_active"]],
        F.max(F.when(F.col("_sign") > 0, F.col("_at"))).alias("_active"),
    )
    user = ["server_id", "user_id"]
    whole = windows.window(user, "_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.least(F.lit(as_of).cast("date"), F.date_add(F.max("_active").over(whole), days))
    spread = marks.select(
        *user, "_at", *counters, "is_active", *[F.sum(f"_t_{c}").over(windows.running(user, "_at")).alias(f"_t_{c}") for c in [*counters, "is_active"]],
        F.least(F.date_sub(F.lead("_at").over(windows.window(user, "_at")), 1), last).alias("_to"),
    )
    dense = joins.dense_days(spread, "_at", "_to")
    first = F.col("activity_date") == F.col("_at")
    dense = dense.withColumns({c: F.when(first, F.col(c)).otherwise(0) for c in counters} | {"is_active": F.when(first, F.col("is_active")).otherwise(0).cast("int")})
    out = [F.col(c) for c in ("server_id", "user_id", "activity_date")]
    flag = lambda c: F.when(F.col(c) > 0, 1).otherwise(0)
    for c in counters:
        out += [
            F.col(c).alias(f"{c}_events_daily"), F.col(f"_t_{c}").alias(f"{c}_events_monthly"), flag(c).alias(f"{c}_users_daily"), flag(f"_t_{c}").alias(f"{c}_users_monthly"),
        ]
    return dense.select(*out, "is_active", flag("_t_is_active").alias("is_active_monthly"))


def feature_daily_snapshot(spine: DataFrame, server_days: DataFrame, reported: Sequence[str]) -> DataFrame:
    """Feature spine rolled up to server-days, dense over each server's span, next to server-reported counts."""
    metrics = [c for c in spine.columns if c.startswith("count_")]
    key = ["server_id", "activity_date"]
    summed = spine.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in metrics], F.sum("is_active").alias("client_daily_active_users"), F.sum("is_active_monthly").alias("client_monthly_active_users")
    )
    span = summed.groupBy("server_id").agg(F.min("activity_date").alias("_a"), F.max("activity_date").alias("_b"))
    dense = joins.dense_days(span, "_a", "_b").select(*key)
    server = server_days.select(*key, *[F.col(c).alias(f"server_{c}" if c.endswith("active_users") else c) for c in reported])
    out = dense.join(summed, key, "left").join(server, key, "left")
    numbers = [c for c in out.columns if c not in key]
    return out.select(text.surrogate_key(*key).alias("daily_server_id"), *key, *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers])


# ---------------------------------------------------------------- event registry


def daily_event_count(events: DataFrame, by: Sequence[str], source: str, as_of: str) -> DataFrame:
    """Distinct events per arrival day and name, with keys for the day row and for the event."""
    counted = events.where(F.col("received_at") <= F.lit(as_of).cast("timestamp_ntz")).groupBy(
        F.to_date("received_at").alias("received_at_date"), *by
    ).agg(F.countDistinct("event_id").alias("event_count")).withColumn("source", F.lit(source))
    return counted.select(
        text.surrogate_key("received_at_date", "source", *by).alias("daily_event_id"), text.surrogate_key("source", *by).alias("event_id"),
        "received_at_date", "source", *by, "event_count",
    )


def event_registry(daily: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Dimension of events over all sources and the daily snapshot of their counts."""
    rows = merge.union_relations(daily)
    attributes = [c for c in rows.columns if c not in ("daily_event_id", "received_at_date", "event_count")]
    dim = rows.select(*attributes).distinct()
    fact = rows.select(F.col("daily_event_id").alias("id"), F.col("received_at_date").alias("event_date"), "event_id", "event_count").distinct()
    return dim, fact


def event_first_last_seen(sources: Sequence[DataFrame], as_of: str) -> DataFrame:
    """First and last day per event name and category (``actions`` counts as ``action``)."""
    seen = None
    for df in sources:
        category = F.lower("category")
        part = df.where(F.to_date("timestamp") <= F.lit(as_of).cast("date")).groupBy(
            F.lower("event").alias("event_name"), F.when(category == "actions", "action").otherwise(category).alias("event_category")
        ).agg(F.to_date(F.min("timestamp")).alias("date_added"), F.to_date(F.max("timestamp")).alias("last_triggered"))
        seen = part if seen is None else seen.unionByName(part)
    return seen.groupBy("event_name", "event_category").agg(F.min("date_added").alias("date_added"), F.max("last_triggered").alias("last_triggered")).withColumn(
        "event_id", text.surrogate_key("event_name", "event_category", old=True)
    )


def union_event_family(relations: dict[str, DataFrame], target: DataFrame | None, deny: Sequence[str], ts: str = "received_at") -> DataFrame:
    """One table from many event relations: column superset, names on the deny list dropped, rows newer than each relation's mark."""
    if target is not None:
        marks = merge.source_marks(target, "source_relation", ts)
        relations = {name: rows if marks.get(name) is None else rows.where(F.col(ts) > F.lit(marks[name])) for name, rows in relations.items()}
    rows = merge.union_relations(relations, source_column="source_relation")
    return rows.where(F.col("event").isNull() | ~F.col("event").isin(list(deny))) if deny else rows


def community_tracks(events: DataFrame, server_id: str, relation: str) -> DataFrame:
    """Events of one server, newest copy per event id."""
    rows = windows.latest(events.where(F.col("server_id") == server_id), ["event_id"], "timestamp", "received_at")
    return rows.drop("context_user_agent").withColumns({"source_relation": F.lit(relation), "received_at_date": F.to_date("received_at")})


def event_mart(relations: dict[str, DataFrame], target: DataFrame | None = None) -> DataFrame:
    """Union of event relations with their name and day; rows up to each relation's mark are skipped."""
    rows = union_event_family(relations, target, [])
    return rows.withColumn("event_date", F.to_date("timestamp"))


def user_agent_registry(
    sources: Sequence[DataFrame], registry: DataFrame | None, column: str = "context_user_agent", patterns: Sequence[AgentPattern] | None = None
) -> DataFrame:
    """Parsed rows of agent texts that the registry does not hold yet, by markers or by a table of patterns."""
    texts = None
    for df in sources:
        part = df.select(column).where(F.col(column).isNotNull()).distinct()
        texts = part if texts is None else texts.unionByName(part)
    new = texts.distinct().withColumn("user_agent_id", F.md5(column))
    if registry is not None:
        new = new.join(registry.select("user_agent_id"), "user_agent_id", "left_anti")
    parsed = parse_by_patterns(new, column, patterns) if patterns else agents.parse_agents(new.select(column), column)
    return parsed.withColumn("user_agent_id", F.md5(column))
