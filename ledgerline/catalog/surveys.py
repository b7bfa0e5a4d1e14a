"""Survey score and feedback queries."""

from __future__ import annotations

import csv
import os

from pyspark.sql import functions as F

from ..functions.rules import load_word_rules
from ..plans import surveys as plan
from ..session import scratch_path
from ..sources import files
from . import standins as s
from .registry import mart, query

AS_OF = "2024-01-31"
START = "2024-01-01"

s.define("answers", """
SELECT server_id, user_id, "timestamp"::DATE AS event_date, "timestamp", event_id, event, '9.' || (k % 4) AS server_version_full, CAST(event_id % 11 AS INTEGER) AS score,
 CASE k % 4 WHEN 0 THEN 'user' WHEN 1 THEN 'team_admin' WHEN 2 THEN 'system_admin' END AS user_role FROM tracks""", "tracks")


def answers(t):
    k = F.col("k")
    return s.tracks(t).select(
        "server_id", "user_id", F.to_date("timestamp").alias("event_date"), "timestamp", "event_id", "event", F.concat(F.lit("9."), k % 4).alias("server_version_full"),
        (F.col("event_id") % 11).cast("int").alias("score"), s.pick(k % 4, ["user", "team_admin", "system_admin"]).alias("user_role"),
    )


s.define("scores", """
SELECT DISTINCT server_id, user_id, event_date, "timestamp", server_version_full, score, user_role FROM (
SELECT * FROM answers WHERE event IN ('click', 'view') QUALIFY row_number() OVER (PARTITION BY server_id, user_id, event_date ORDER BY "timestamp" DESC, score DESC) = 1
UNION ALL SELECT * FROM answers WHERE event NOT IN ('click') QUALIFY row_number() OVER (PARTITION BY server_id, user_id, event_date ORDER BY "timestamp" DESC, score DESC) = 1)""", "answers")


def scores(t):
    rows = answers(t).drop("event_id")
    return plan.nps_scores([rows.where(F.col("event").isin("click", "view")).drop("event"), rows.where(F.col("event") != "click").drop("event")])


@query("j51_nps_scores", s.with_("scores") + "SELECT * FROM scores")
def _(t):
    return scores(t)


s.define("feedback", """
SELECT DISTINCT server_id, user_id, event_date, "timestamp", feedback, server_version_full, user_role FROM (SELECT a.*, 'text ' || (event_id % 3) AS feedback FROM answers a WHERE event = 'signup' QUALIFY row_number() OVER (PARTITION BY server_id, user_id, event_id % 3 ORDER BY "timestamp" DESC) = 1
UNION ALL SELECT a.*, 'text ' || (event_id % 3) FROM answers a WHERE event = 'error' QUALIFY row_number() OVER (PARTITION BY server_id, user_id, event_id % 3 ORDER BY "timestamp" DESC) = 1)""", "answers")


def feedback(t):
    rows = answers(t).withColumn("feedback", F.concat(F.lit("text "), F.col("event_id") % 3)).drop("event_id", "score")
    return plan.nps_feedback([rows.where(F.col("event") == e).drop("event") for e in ("signup", "error")])


@query("j51_nps_feedback", s.with_("feedback") + "SELECT * FROM feedback")
def _(t):
    return feedback(t)


def _sql_flags(c: str, suffix: str = "") -> str:
    return f"""CASE WHEN {c} > 8 THEN 1 ELSE 0 END AS promoters{suffix}, CASE WHEN {c} < 7 THEN 1 ELSE 0 END AS detractors{suffix}, CASE WHEN {c} IN (7, 8) THEN 1 ELSE 0 END AS passives{suffix}, CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END AS nps_users{suffix}"""


s.define("score_spine", f"""
SELECT *, {_sql_flags('score')}, {_sql_flags('score_last_10d', '_last10d')} FROM (
SELECT x.activity_date, x.server_id, x.user_id, d.score, last_value(d.user_role IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS user_role, last_value(d.score IGNORE NULLS) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS score_last_10d
FROM (SELECT server_id, user_id, unnest(generate_series(min(event_date)::TIMESTAMP, TIMESTAMP '{AS_OF}', INTERVAL 1 DAY))::DATE AS activity_date FROM scores GROUP BY server_id, user_id) x
LEFT JOIN (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY server_id, user_id, event_date ORDER BY "timestamp" DESC, score DESC) = 1) d ON d.server_id = x.server_id AND d.user_id = x.user_id AND d.event_date = x.activity_date
WINDOW w AS (PARTITION BY x.server_id, x.user_id ORDER BY x.activity_date))""", "scores")


def score_spine(t):
    return plan.nps_user_spined(scores(t), AS_OF, START, 10)


@query("j52_nps_user_spined", s.with_("score_spine") + "SELECT * FROM score_spine")
def _(t):
    return score_spine(t)


s.define("version_spine", f"""
SELECT x.activity_date, x.server_id, last_value(v IGNORE NULLS) OVER (PARTITION BY x.server_id ORDER BY x.activity_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS server_version_full
FROM (SELECT server_id, unnest(generate_series(min(event_date)::TIMESTAMP, TIMESTAMP '{AS_OF}', INTERVAL 1 DAY))::DATE AS activity_date FROM scores GROUP BY server_id) x
LEFT JOIN (SELECT server_id, event_date, arg_max(server_version_full, ("timestamp", server_version_full)) AS v FROM scores GROUP BY ALL) d ON d.server_id = x.server_id AND d.event_date = x.activity_date""", "scores")


@query("j53_nps_server_version_spined", s.with_("version_spine") + "SELECT * FROM version_spine")
def _(t):
    return plan.nps_server_version_spined(scores(t), AS_OF, START)


ROLES = ["system_admin", "team_admin", "user"]
_CELLS = ", ".join(
    f"sum(CASE WHEN user_role = '{r}' THEN {g}{x} ELSE 0 END)::BIGINT AS count_{r}_{g}_{n}" for n, x in (("daily", ""), ("last10d", "_last10d")) for g in plan.GROUPS for r in ROLES
)
_TOTALS = ", ".join(f"sum(CASE WHEN user_role IS NOT NULL THEN {g}{x} ELSE 0 END)::BIGINT AS count_{g}_{n}" for n, x in (("daily", ""), ("last10d", "_last10d")) for g in plan.GROUPS)


@query("j54_nps_score_fact", s.with_("score_spine", "version_spine") + f"""
, m AS (SELECT activity_date, server_id, {_CELLS}, {_TOTALS} FROM score_spine GROUP BY ALL)
SELECT m.*, md5(m.server_id || '-' || m.activity_date) AS daily_server_id, md5(coalesce(server_version_full, '_dbt_utils_surrogate_key_null_')) AS version_id FROM m JOIN version_spine v ON v.server_id = m.server_id AND v.activity_date = m.activity_date""")
def _(t):
    return plan.nps_score_fact(mart(score_spine(t), "score-spine"), plan.nps_server_version_spined(scores(t), AS_OF, START), ROLES, carry_days=10)


@query("j54_nps_feedback_fact", s.with_("feedback", "scores") + """
SELECT md5(f.server_id || '-' || f.user_id || '-' || feedback || '-' || f.event_date) AS nps_feedback_id, md5(f.server_id || '-' || f.event_date) AS daily_server_id, f.server_id, f.user_id, feedback, score, coalesce(f.server_version_full, c.server_version_full) AS server_version_full,
 f.user_role, f.event_date AS feedback_date, c.event_date AS score_date FROM feedback f LEFT JOIN scores c ON c.server_id = f.server_id AND c.user_id = f.user_id AND c.event_date = f.event_date""")
def _(t):
    return plan.nps_feedback_fact(feedback(t), scores(t))


s.define("responses", """
SELECT 'n' || event_id AS nps_id, CASE WHEN event = 'signup' THEN 'f' || event_id END AS feedback_id, server_id, user_id, "timestamp", score, CASE WHEN event = 'signup' THEN 'text ' || (event_id % 3) END AS feedback, server_version_full AS server_version FROM answers""", "answers")


def responses(t):
    e = F.col("event") == "signup"
    return answers(t).select(
        F.concat(F.lit("n"), "event_id").alias("nps_id"), F.when(e, F.concat(F.lit("f"), "event_id")).alias("feedback_id"), "server_id", "user_id", "timestamp", "score",
        F.when(e, F.concat(F.lit("text "), F.col("event_id") % 3)).alias("feedback"), F.col("server_version_full").alias("server_version"),
    )


s.define("user_daily", f"""
SELECT d.date, d.server_id, d.user_id, t.score, t.server_version, t.feedback, t."timestamp"::DATE AS last_score_date, CASE WHEN t.score < 7 THEN 'Detractor' WHEN t.score < 9 THEN 'Passive' ELSE 'Promoter' END AS promoter_type,
 d.responses, d.promoter_responses, d.detractor_responses, d.feedback_count, d.responses_alltime, d.promoter_responses_alltime, d.detractor_responses_alltime, d.feedback_count_alltime, md5(d.date || '-' || d.server_id || '-' || d.user_id) AS id
FROM (SELECT x.date, x.server_id, x.user_id, arg_max(r.nps_id, (r."timestamp", r.nps_id)) AS top, count(*) AS responses_alltime, count(*) FILTER (score > 8) AS promoter_responses_alltime, count(*) FILTER (score < 7) AS detractor_responses_alltime, count(feedback_id) AS feedback_count_alltime,
   count(*) FILTER (r."timestamp"::DATE = x.date) AS responses, count(*) FILTER (r."timestamp"::DATE = x.date AND score > 8) AS promoter_responses, count(*) FILTER (r."timestamp"::DATE = x.date AND score < 7) AS detractor_responses, count(feedback_id) FILTER (r."timestamp"::DATE = x.date) AS feedback_count
 FROM (SELECT server_id, user_id, unnest(generate_series(min("timestamp")::DATE::TIMESTAMP, TIMESTAMP '{AS_OF}', INTERVAL 1 DAY))::DATE AS date FROM responses GROUP BY server_id, user_id) x JOIN responses r ON r.server_id = x.server_id AND r.user_id = x.user_id AND r."timestamp"::DATE <= x.date GROUP BY ALL) d
JOIN responses t ON t.nps_id = d.top""", "responses")


def user_daily(t):
    return plan.nps_user_daily_score(responses(t), AS_OF)


@query("j55_nps_user_daily_score", s.with_("user_daily") + "SELECT * FROM user_daily")
def _(t):
    return user_daily(t)


@query("j55_nps_server_daily_score", s.with_("user_daily") + """
SELECT date, server_id, max(server_version) AS server_version, count(*) FILTER (score > 8) AS promoters, count(*) FILTER (score <= 6) AS detractors, count(*) FILTER (score IN (7, 8)) AS passives, count(DISTINCT user_id) AS nps_users, sum(score)::DOUBLE / count(*) AS avg_score,
 (count(*) FILTER (score > 8) - count(*) FILTER (score <= 6)) * 100.0::DOUBLE / count(*) AS nps_score, sum(responses)::BIGINT AS responses, sum(responses_alltime)::BIGINT AS responses_alltime, sum(feedback_count)::BIGINT AS feedback_responses, sum(feedback_count_alltime)::BIGINT AS feedback_responses_alltime,
 md5(date || '-' || server_id) AS id FROM user_daily GROUP BY date, server_id""")
def _(t):
    return plan.nps_server_daily_score(mart(user_daily(t), "user-daily"))


@query("j55_nps_server_feedback", s.with_("user_daily") + "SELECT date, server_id, string_agg(DISTINCT feedback, '' ORDER BY feedback) AS feedback FROM user_daily WHERE feedback IS NOT NULL GROUP BY ALL")
def _(t):
    return plan.nps_server_feedback(mart(user_daily(t), "user-daily"))


@query("j55_nps_version_daily_score", s.with_("user_daily") + """
SELECT date, server_id, user_id, server_version, last_score_date, score, promoter_type, responses_alltime, feedback, md5(date || '-' || user_id || '-' || server_id || '-' || server_version) AS id FROM user_daily""")
def _(t):
    return plan.nps_version_daily_score(mart(user_daily(t), "user-daily"))


SEED = os.path.join(os.path.dirname(os.path.abspath(__file__)), "seeds", "feedback_rules.csv")
SEED_COLUMNS = "rule int, grp int, words string, subcategory string, min_score double, max_score double, shorter_than int, longer_than int"

s.define("rule_seed", f"SELECT * FROM read_csv('{SEED}', header = true, columns = {{{', '.join(f"'{c.split()[0]}': '{c.split()[1].replace('string', 'varchar')}'" for c in SEED_COLUMNS.split(', '))}}})")
s.define("rule_hit", r"""
SELECT f.doc_id, r.rule FROM (SELECT doc_id, lower(text) AS low, text, doc_id % 11 AS score FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)) f, rule_seed r
WHERE (r.words IS NULL OR r.words = '' OR regexp_matches(low, '(?:^|[ .;,:\n\t\-"''/])(?:' || r.words || ')(?:[.;, /\n\t\-"''?!]|$)'))
 AND (r.min_score IS NULL OR score >= r.min_score) AND (r.max_score IS NULL OR score <= r.max_score) AND (r.shorter_than IS NULL OR length(text) < r.shorter_than) AND (r.longer_than IS NULL OR length(text) > r.longer_than)
GROUP BY f.doc_id, r.rule HAVING count(DISTINCT r.grp) = (SELECT count(*) FROM rule_seed x WHERE x.rule = r.rule)""", "rule_seed")
s.define("classified", f"""
SELECT DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS last_feedback_date, source AS server_id, 'u' || doc_id AS user_id, subcategory, CASE {' '.join(f"WHEN subcategory IN ({', '.join(repr(m) for m in members)}) THEN '{c}'" for c, members in plan.CATEGORIES.items())} END AS category
FROM (SELECT d.doc_id, d.source, coalesce((SELECT min(subcategory) FROM rule_seed WHERE rule = h.rule), 'Manual Input Required') AS subcategory FROM documents d LEFT JOIN (SELECT doc_id, min(rule) AS rule FROM rule_hit GROUP BY doc_id) h ON d.doc_id = h.doc_id
  WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))""", "rule_hit")


def classified(t):
    day = F.date_add(s.day("2024-01-01"), (F.col("doc_id") % 30).cast("int")).alias("last_feedback_date")
    key = [day, F.col("source").alias("server_id"), F.concat(F.lit("u"), "doc_id").alias("user_id")]
    rows = t.documents.select(*key, F.col("text").alias("feedback"), (F.col("doc_id") % 11).alias("score"))
    done = t.documents.join(t.labels.where(F.col("toxic") == 1), "doc_id", "left_semi").select(*key)
    # the seed comes with the package; executors read it from the shared folder
    path = scratch_path(t.spark, "feedback-rules")
    with open(SEED, newline="") as lines:
        listed = [tuple(v or None for v in r.values()) for r in csv.DictReader(lines)]
    t.spark.createDataFrame(listed, ", ".join(f"{c.split()[0]} string" for c in SEED_COLUMNS.split(", "))).write.csv(path, header=True)
    rules = load_word_rules(files.seed(t.spark, path, SEED_COLUMNS))
    return plan.classify_feedback(rows, rules, done, "2024-01-31 00:00:00")


@query("j56_classify_feedback", s.with_("classified") + "SELECT * FROM classified")
def _(t):
    return classified(t).select("last_feedback_date", "server_id", "user_id", "subcategory", "category")


@query("j57_apply_manual_corrections", s.with_("classified") + """
, fix AS (SELECT c.last_feedback_date, c.server_id, c.user_id, p.new_value, p.at FROM (SELECT doc_id, 'u' || doc_id AS user_id, CASE WHEN quality = 1 THEN 'Threading' ELSE 'Performance' END AS new_value, TIMESTAMP '2024-02-02 00:00:00' AS at FROM labels WHERE quality IS NOT NULL) p JOIN classified c USING (user_id))
SELECT last_feedback_date, server_id, user_id, subcategory, category, false AS manually_categorized, CASE WHEN (last_feedback_date, server_id, user_id) IN (SELECT (last_feedback_date, server_id, user_id) FROM fix) THEN 2 ELSE 1 END AS category_rank FROM classified
UNION ALL SELECT last_feedback_date, server_id, user_id, new_value, CASE new_value WHEN 'Threading' THEN 'Feature Requests' ELSE 'UX Feedback' END, true, 1 FROM fix""")
def _(t):
    rows = mart(classified(t), "classified")
    new = F.when(F.col("quality") == 1, "Threading").otherwise("Performance")
    # Two actions per label: the older one names another value and must lose.
    picked = rows.join(t.labels.select(F.concat(F.lit("u"), "doc_id").alias("user_id"), "doc_id", new.alias("new_value")), "user_id")
    info = F.to_json(F.struct(
        F.lit("nps_feedback_classification").alias("table"), F.lit("subcategory").alias("field_name"), "last_feedback_date", "server_id", "user_id",
        F.lit("ann").alias("action_performed_by"),
    ))
    action = lambda value, at, tag: picked.select(
        F.concat(F.lit(tag), "doc_id").alias("data_action_id"), info.alias("data"), F.to_json(F.struct(value.alias("new_value"))).alias("form_params"), s.ts(at).alias("received_at")
    )
    actions = action(F.lit("Themes"), "2024-02-01 00:00:00", "a").unionByName(action(F.col("new_value"), "2024-02-02 00:00:00", "b"))
    out = plan.apply_manual_corrections(rows, plan.manual_corrections(actions, None))
    return out.select("last_feedback_date", "server_id", "user_id", "subcategory", "category", "manually_categorized", "category_rank")
