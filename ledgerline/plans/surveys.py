"""Survey scores and feedback: daily spines, score facts and rule-based classification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import payload, text
from ..functions.rules import WordRule, first_match, first_word_rule
from ..operators import aggregate, joins, merge, windows

USER = ["server_id", "user_id"]
GROUPS = ["promoters", "detractors", "passives", "nps_users"]


def nps_scores(sources: Sequence[DataFrame]) -> DataFrame:
    """Latest score per server, user and day of each source; equal rows of two sources count once."""
    parts = [windows.latest(df, [*USER, "event_date"], "timestamp", "score") for df in sources]
    return reduce(DataFrame.unionByName, parts).distinct()


def nps_feedback(sources: Sequence[DataFrame]) -> DataFrame:
    """Latest copy of each feedback text per server and user."""
    parts = [windows.latest(df.where(F.col("feedback").isNotNull()), [*USER, "feedback"], "timestamp", "event_date") for df in sources]
    return reduce(DataFrame.unionByName, parts).distinct()


def _flags(score: Column, suffix: str = "") -> list[Column]:
    one = lambda test, name: F.when(test, 1).otherwise(0).alias(name + suffix)
    return [
        one(score > 8, "promoters"), one(score < 7, "detractors"), one((score > 6) & (score < 9), "passives"), one(score.isNotNull(), "nps_users"),
    ]


def nps_user_spined(scores: DataFrame, as_of: str, start: str, carry_days: int = 90) -> DataFrame:
    """Dense user-days from the first score on, with today's score and the score carried for ``carry_days``.

    Latest known values are taken on the rows with scores, which are then spread up to the next
    score; the carry limit is a comparison of dates, so no frame runs over the dense rows.
    """
    daily = windows.latest(scores.where(F.col("event_date") >= F.lit(start).cast("date")), [*USER, "event_date"], "timestamp", "score")
    w = windows.running(USER, "event_date")
    scored = F.when(F.col("score").isNotNull(), F.struct("event_date", "score"))
    nxt = F.lead("event_date").over(windows.window(USER, "event_date"))
    compact = daily.select(
        *USER, F.col("event_date").alias("_from"), F.coalesce(F.date_sub(nxt, 1), F.lit(as_of).cast("date")).alias("_to"), F.col("score").alias("_score"),
        F.last("user_role", ignorenulls=True).over(w).alias("user_role"), F.last(scored, ignorenulls=True).over(w).alias("_known"),
    )
    dense = joins.dense_days(compact, "_from", "_to", "activity_date")
    today = F.when(F.col("activity_date") == F.col("_from"), F.col("_score"))
    carried = F.when(F.datediff("activity_date", F.col("_known.event_date")) < carry_days, F.col("_known.score"))
    return dense.select(
        "activity_date", *USER, today.alias("score"), "user_role", *_flags(today), carried.alias(f"score_last_{carry_days}d"),
        *_flags(carried, f"_last{carry_days}d"),
    )


def nps_server_version_spined(scores: DataFrame, as_of: str, start: str) -> DataFrame:
    """Dense server-days with the last reported version."""
    daily = scores.where(F.col("event_date") >= F.lit(start).cast("date")).groupBy("server_id", "event_date").agg(
        F.max_by("server_version_full", F.struct("timestamp", "server_version_full")).alias("_v")
    )
    nxt = F.lead("event_date").over(windows.window(["server_id"], "event_date"))
    known = F.last("_v", ignorenulls=True).over(windows.running(["server_id"], "event_date"))
    compact = daily.select(
        "server_id", F.col("event_date").alias("_from"), F.coalesce(F.date_sub(nxt, 1), F.lit(as_of).cast("date")).alias("_to"), known.alias("server_version_full")
    )
    return joins.dense_days(compact, "_from", "_to", "activity_date").select("activity_date", "server_id", "server_version_full")


def nps_score_fact(user_spine: DataFrame, versions: DataFrame, roles: Sequence[str] | None = None, carry_days: int = 90) -> DataFrame:
    """Counts per server-day for every role, group and span, with totals over roles and the version key."""
    roles = list(roles) if roles is not None else aggregate.pivot_values(user_spine, "user_role")
    spans = {"daily": "", f"last{carry_days}d": f"_last{carry_days}d"}
    cells = {
        f"count_{text.slug(r)}_{g}_{span}": F.sum(F.when(F.col("user_role") == r, F.col(g + suffix)).otherwise(0))
        for span, suffix in spans.items() for g in GROUPS for r in roles
    }
    daily = user_spine.groupBy("activity_date", "server_id").agg(*[e.alias(n) for n, e in cells.items()])
    totals = {
        f"count_{g}_{span}": reduce(lambda a, b: a + b, [F.col(f"count_{text.slug(r)}_{g}_{span}") for r in roles]) for span in spans for g in GROUPS
    }
    return daily.withColumns(totals).join(versions, ["activity_date", "server_id"]).select(
        *daily.columns, *totals, text.surrogate_key("server_id", "activity_date").alias("daily_server_id"), text.surrogate_key("server_version_full").alias("version_id")
    )


def nps_feedback_fact(feedback: DataFrame, scores: DataFrame) -> DataFrame:
    key = [*USER, "event_date"]
    score = scores.select(*key, "score", F.col("server_version_full").alias("_v"), F.col("event_date").alias("score_date"))
    return feedback.join(score, key, "left").select(
        text.surrogate_key(*USER, "feedback", "event_date").alias("nps_feedback_id"), text.surrogate_key("server_id", "event_date").alias("daily_server_id"),
        *USER, "feedback", "score", F.coalesce("server_version_full", "_v").alias("server_version_full"), "user_role", F.col("event_date").alias("feedback_date"), "score_date",
    )


# ---------------------------------------------------------------- cumulative scores


def nps_user_daily_score(responses: DataFrame, as_of: str) -> DataFrame:
    """Latest score and response counts so far, per server, user and day.

    ``responses``: nps_id, feedback_id, server_id, user_id, timestamp, score, feedback, server_version.
    Counts are summed on days with responses and carried over the days up to the next response.
    """
    today = F.lit(as_of).cast("date")
    day = F.to_date("timestamp")
    count = lambda test, name: F.count_if(test).alias(name)
    at = F.struct("timestamp", "nps_id")
    per_day = responses.where(day <= today).groupBy(*USER, day.alias("_day")).agg(
        F.count("nps_id").alias("responses"), count(F.col("score") > 8, "promoter_responses"), count(F.col("score") < 7, "detractor_responses"),
        F.count("feedback_id").alias("feedback_count"), F.max_by(F.struct("score", "server_version", "feedback"), at).alias("_top"),
    )
    w = windows.running(USER, "_day")
    nxt = F.lead("_day").over(windows.window(USER, "_day"))
    counts = ["responses", "promoter_responses", "detractor_responses", "feedback_count"]
    compact = per_day.withColumns({f"{c}_alltime": F.sum(c).over(w) for c in counts}).withColumn("_to", F.coalesce(F.date_sub(nxt, 1), today))
    dense = joins.dense_days(compact, "_day", "_to", "date")
    same = F.col("date") == F.col("_day")
    score = F.col("_top.score")
    return dense.select(
        "date", *USER, score.alias("score"), F.col("_top.server_version").alias("server_version"), F.col("_top.feedback").alias("feedback"),
        F.col("_day").alias("last_score_date"), F.when(score < 7, "Detractor").when(score < 9, "Passive").otherwise("Promoter").alias("promoter_type"),
        *[F.when(same, F.col(c)).otherwise(0).alias(c) for c in counts], *[F.col(f"{c}_alltime") for c in counts],
        text.surrogate_key("date", *USER, old=True).alias("id"),
    )


def nps_server_daily_score(users: DataFrame) -> DataFrame:
    """Promoters, detractors and the score 100 x (promoters - detractors) / users per server-day."""
    score, n = F.col("score"), F.count("*")
    promoters, detractors = F.count_if(score > 8), F.count_if(score <= 6)
    return users.groupBy("date", "server_id").agg(
        F.max("server_version").alias("server_version"), promoters.alias("promoters"), detractors.alias("detractors"),
        F.count_if((score > 6) & (score <= 8)).alias("passives"), n.alias("nps_users"), (F.sum("score").cast("double") / n).alias("avg_score"),
        ((promoters - detractors) * 100.0 / n).alias("nps_score"), F.sum("responses").alias("responses"), F.sum("responses_alltime").alias("responses_alltime"),
        F.sum("feedback_count").alias("feedback_responses"), F.sum("feedback_count_alltime").alias("feedback_responses_alltime"),
    ).withColumn("id", text.surrogate_key("date", "server_id", old=True))


def nps_server_feedback(users: DataFrame) -> DataFrame:
    """Distinct feedback texts of a server-day in order, joined to one text."""
    return users.where(F.col("feedback").isNotNull()).groupBy("date", "server_id").agg(aggregate.joined_set("feedback", "").alias("feedback"))


def nps_version_daily_score(users: DataFrame) -> DataFrame:
    """One row per day a score given on a version stays the user's latest score."""
    key = [*USER, "server_version", "last_score_date", "score", "promoter_type", "responses_alltime"]
    spans = users.groupBy(*key).agg(F.max("date").alias("last_date"), F.max("feedback").alias("feedback"))
    dense = joins.dense_days(spans, "last_score_date", "last_date", "date")
    return dense.select("date", *key, "feedback", text.surrogate_key("date", "user_id", "server_id", "server_version", old=True).alias("id"))


# ---------------------------------------------------------------- classification

# Category of each feedback subcategory.
CATEGORIES = {
    "Feature Requests": [
        "Audio/Video Calling", "Away Status", "Block User", "Channel Sidebar", "Corporate Slack Import", "Custom Statuses", "Emoji/GIF Options",
        "Group Mentions", "Integrations", "Mark as Unread", "Message Tagging", "Miscellaneous Features", "Read Receipts", "Reminderbot", "RN Multi-Server",
        "Share Message", "Snippets", "Text Editor", "Threading", "Voice Messages",
    ],
    "Invalid": ["Invalid"],
    "Miscellaneous": ["Miscellaneous"],
    "Praise": ["Praise"],
    "Reliability": [
        "Desktop Stability", "Message and Network Reliability", "Miscellaneous Bugs", "Mobile Stability", "Notifications Reliability",
    ],
    "UX Feedback": [
        "Account Authorization", "Be Slack", "Desktop UX", "Documentation", "Files/Attachments", "Group Message UX", "Logout Issues", "Messaging UX",
        "Miscellaneous UX", "Mobile UX", "Notifications UX", "Onboarding", "Performance", "Search UX", "System Administration", "Team Management", "Themes",
        "Translations", "UI/UX Polish", "Update UX",
    ],
    "Manual Input Required": ["Manual Input Required"],
}


def category_of(subcategory: Column | str, otherwise: Column | None = None) -> Column:
    c = F.col(subcategory) if isinstance(subcategory, str) else subcategory
    out = None
    for category, members in CATEGORIES.items():
        out = F.when(c.isin(members), category) if out is None else out.when(c.isin(members), category)
    return out if otherwise is None else out.otherwise(otherwise)


def classify_feedback(feedback: DataFrame, rules: Sequence[WordRule], done: DataFrame | None, categorized_at: str) -> DataFrame:
    """Subcategory by the first rule that holds and its category, for feedback not classified yet.

    ``feedback``: last_feedback_date, server_id, user_id, feedback, score. ``rules`` are ordered (:func:`load_word_rules` reads
    them from a seed file); whole texts are matched.
    """
    key = ["last_feedback_date", "server_id", "user_id"]
    rows = feedback if done is None else feedback.join(done.select(*key), key, "left_anti")
    named = feedback.sparkSession.createDataFrame([(n, r.value) for n, r in enumerate(rules)], "position int, subcategory string")
    out = first_word_rule(rows.select(*key, "feedback", "score"), "feedback", "score", rules).join(F.broadcast(named), "position", "left")
    out = out.withColumn("subcategory", F.coalesce("subcategory", F.lit("Manual Input Required")))
    return out.select(
        *key, category_of("subcategory").alias("category"), "subcategory", F.lit(categorized_at).cast("timestamp_ntz").alias("categorized_at"),
        F.lit("Automated Categorization").alias("categorized_by"), F.lit(False).alias("manually_categorized"),
    )


def manual_corrections(actions: DataFrame, done_ids: DataFrame | None) -> DataFrame:
    """Newest subcategory correction per feedback from JSON action records, without those applied before.

    ``actions``: data_action_id, data (JSON), form_params (JSON), received_at.
    """
    f = lambda path, kind="string": payload.json_field("data", f"$.{path}", kind)
    key = ["last_feedback_date", "server_id", "user_id"]
    rows = actions.where((f("table") == "nps_feedback_classification") & (f("field_name") == "subcategory")).select(
        f("last_feedback_date", "date").alias("last_feedback_date"), f("server_id").alias("server_id"), f("user_id").alias("user_id"),
        payload.json_field("form_params", "$.new_value").alias("subcategory"), F.col("received_at").alias("categorized_at"),
        f("action_performed_by").alias("categorized_by"), F.lit(True).alias("manually_categorized"), F.col("data_action_id").alias("manually_categorized_id"),
    )
    newest = windows.latest(rows, key, "categorized_at", "manually_categorized_id")
    return newest if done_ids is None else newest.join(done_ids.select("manually_categorized_id"), "manually_categorized_id", "left_anti")


def apply_manual_corrections(classified: DataFrame, corrections: DataFrame) -> DataFrame:
    """Classification with corrections added, categories refreshed and ranked: manual before automatic, then newest."""
    key = ["last_feedback_date", "server_id", "user_id"]
    rows = merge.union_relations([classified, corrections])
    rows = rows.withColumn("category", category_of("subcategory", F.col("category")))
    order = [F.col("manually_categorized").desc_nulls_last(), F.col("categorized_at").desc_nulls_last(), F.asc("subcategory")]
    # A feedback has a handful of classifications, so its window is small.
    return rows.withColumn("category_rank", F.row_number().over(windows.window(key, *order)))
