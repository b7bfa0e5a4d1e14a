"""Licence, subscription and trial queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import licenses as plan
from . import standins as s
from .registry import mart, query

AS_OF = "2001-01-01"

# ---------------------------------------------------------------- shapes: conflicting licence records from orders

NAMES = ["E10", "E20", "enterprise", "professional"]
s.define("licence_rows", """
SELECT 'k' || o_custkey AS license_id, o_orderkey, o_orderdate AS issued_at, o_orderdate + INTERVAL 1 DAY AS starts_at, o_orderdate + to_days(CAST(365 + o_orderkey % 3 * 30 AS INTEGER)) AS expire_at, CAST(10 + o_orderkey % 2 AS INTEGER) AS licensed_seats,
 CASE o_orderkey % 5 WHEN 0 THEN 'E10' WHEN 1 THEN 'E20' WHEN 2 THEN 'enterprise' WHEN 3 THEN 'professional' ELSE 'other' END AS license_name, 'c' || o_custkey AS customer_id, o_custkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders""")


def licence_rows(t):
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    return t.orders.select(
        F.concat(F.lit("k"), "o_custkey").alias("license_id"), key, at.alias("issued_at"), (at + F.expr("interval 1 day")).alias("starts_at"),
        (at + F.make_dt_interval((365 + key % 3 * 30).cast("int"))).alias("expire_at"), (10 + key % 2).cast("int").alias("licensed_seats"),
        F.coalesce(s.pick((key % 5).cast("int"), NAMES), F.lit("other")).alias("license_name"), F.concat(F.lit("c"), "o_custkey").alias("customer_id"), "o_custkey",
        "o_orderpriority", "o_orderstatus", "o_totalprice",
    )


s.define("portal", """
SELECT license_id, issued_at, starts_at, expire_at, licensed_seats, license_name AS sku_short_name, customer_id, o_orderstatus = 'P' AS is_trial, CASE WHEN o_orderstatus = 'F' THEN 'p' || licensed_seats END AS product_id, 'Company ' || o_custkey AS company_name, 'mail' || o_custkey || '@firm.com' AS customer_email
FROM licence_rows WHERE o_orderpriority = '1-URGENT' QUALIFY row_number() OVER (PARTITION BY license_id ORDER BY issued_at DESC, o_orderkey DESC) = 1""", "licence_rows")
s.define("legacy_licences", """
SELECT license_id, issued_at, expire_at, 'Legacy ' || o_custkey AS company_name, 'old' || o_custkey || '@firm.com' AS contact_email, customer_id FROM licence_rows WHERE o_orderpriority = '2-HIGH' QUALIFY row_number() OVER (PARTITION BY license_id ORDER BY issued_at DESC, o_orderkey DESC) = 1""", "licence_rows")
s.define("crm_licences", """
SELECT license_id, 'o' || o_orderkey AS opportunity_id, starts_at, expire_at, licensed_seats, 'Account ' || o_custkey AS account_name, o_totalprice AS account_arr, issued_at AS created_at FROM licence_rows WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'""", "licence_rows")
s.define("reports", "SELECT * FROM licence_rows WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')", "licence_rows")


def _newest(rows, priority):
    from ..operators import windows

    return windows.latest(rows.where(F.col("o_orderpriority") == priority), ["license_id"], "issued_at", "o_orderkey")


def portal(t):
    named = lambda a, b="": F.concat(F.lit(a), "o_custkey", F.lit(b))
    return _newest(licence_rows(t), "1-URGENT").select(
        "license_id", "issued_at", "starts_at", "expire_at", "licensed_seats", F.col("license_name").alias("sku_short_name"), "customer_id",
        (F.col("o_orderstatus") == "P").alias("is_trial"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("p"), "licensed_seats")).alias("product_id"),
        named("Company ").alias("company_name"), named("mail", "@firm.com").alias("customer_email"),
    )


def legacy_licences(t):
    return _newest(licence_rows(t), "2-HIGH").select(
        "license_id", "issued_at", "expire_at", F.concat(F.lit("Legacy "), "o_custkey").alias("company_name"), F.concat(F.lit("old"), "o_custkey", F.lit("@firm.com")).alias("contact_email"),
        "customer_id",
    )


def crm_licences(t):
    return licence_rows(t).where((F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "F")).select(
        "license_id", F.concat(F.lit("o"), "o_orderkey").alias("opportunity_id"), "starts_at", "expire_at", "licensed_seats", F.concat(F.lit("Account "), "o_custkey").alias("account_name"),
        F.col("o_totalprice").alias("account_arr"), F.col("issued_at").alias("created_at"),
    )


def reports(t):
    return licence_rows(t).where(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"))


s.define("per_source", """
SELECT license_id, source, expire_at, count(*) OVER (PARTITION BY license_id, source) > 1 AS has_multiple_expiration_dates FROM (
SELECT license_id, expire_at, 'Portal' AS source FROM portal UNION SELECT license_id, expire_at, 'Legacy' FROM legacy_licences UNION SELECT license_id, expire_at, 'Telemetry' FROM reports)""", "portal", "legacy_licences", "reports")


def per_source(t):
    return plan.licenses_per_source({"Portal": portal(t), "Legacy": legacy_licences(t), "Telemetry": reports(t)})


@query("j58_licenses_per_source", s.with_("per_source") + "SELECT * FROM per_source")
def _(t):
    return per_source(t)


_RANGES = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}, CASE WHEN min({c}) = max({c}) THEN max({c}) END AS {c}" for c in ("issued_at", "starts_at", "expire_at", "licensed_seats"))
s.define("deduped", f"""
SELECT license_id, {_RANGES}, list_sort(list(DISTINCT license_name)) AS license_names, count(DISTINCT expire_at) AS count_expiration_dates FROM reports WHERE license_name <> 'other' GROUP BY 1""", "reports")


def deduped(t):
    return plan.dedupe_reported_licenses(reports(t), NAMES)


@query("j59_dedupe_reported_licenses", s.with_("deduped") + "SELECT * REPLACE (array_to_string(license_names, ',') AS license_names) FROM deduped")
def _(t):
    return deduped(t).withColumn("license_names", F.array_join("license_names", ","))


s.define("active", f"""
SELECT l.license_id, coalesce(c.issued_at, d.issued_at) AS issued_at, coalesce(c.starts_at, d.starts_at) AS starts_at, coalesce(c.expire_at, d.expire_at) AS expire_at, coalesce(sku_short_name, d.license_names[1]) AS license_name, is_trial, company_name, customer_id AS portal_customer_id,
 product_id, coalesce(c.licensed_seats, d.licensed_seats) AS licensed_seats, CAST(date_diff('day', coalesce(c.starts_at, d.starts_at), coalesce(c.expire_at, d.expire_at)) AS INTEGER) AS duration_days,
 CAST(date_diff('month', coalesce(c.starts_at, d.starts_at), coalesce(c.expire_at, d.expire_at)) AS INTEGER) AS duration_months, sources, several AS has_multiple_expiration_dates_across_sources
FROM (SELECT license_id, count(DISTINCT expire_at) > 1 AS several, list_sort(list(DISTINCT source)) AS sources FROM per_source GROUP BY 1 HAVING max(expire_at) >= DATE '{AS_OF}') l LEFT JOIN portal c USING (license_id) LEFT JOIN deduped d USING (license_id)""", "per_source", "deduped")


def active(t):
    return plan.active_licenses(per_source(t), portal(t), deduped(t), AS_OF)


@query("j60_active_licenses", s.with_("active") + "SELECT * REPLACE (array_to_string(sources, ',') AS sources) FROM active")
def _(t):
    return active(t).withColumn("sources", F.array_join("sources", ","))


@query("j60_active_production_licenses", s.with_("active") + """
SELECT license_id, CASE WHEN product_id IS NOT NULL THEN md5(product_id) ELSE 'Unknown' END AS license_type_id, md5(coalesce(portal_customer_id, '_dbt_utils_surrogate_key_null_') || '-' || license_id) AS customer_id, issued_at, starts_at, expire_at, is_trial, licensed_seats, duration_days, duration_months,
 has_multiple_expiration_dates_across_sources FROM active WHERE list_contains(sources, 'Portal')""")
def _(t):
    return plan.active_production_licenses(mart(active(t), "active"))


s.define("known", """
SELECT license_id, coalesce(c.company_name, l.company_name, f.account_name) AS company_name, coalesce(c.customer_email, l.contact_email) AS contact_email, coalesce(sku_short_name, CASE WHEN r.license_name IN ('E10', 'E20', 'starter', 'professional', 'enterprise') THEN r.license_name END, 'Unknown') AS sku_short_name,
 r.license_name, coalesce(c.starts_at, l.issued_at, f.starts_at, r.starts_at) AS starts_at, coalesce(c.expire_at, l.expire_at, f.expire_at, r.expire_at) AS expire_at, is_trial, coalesce(c.licensed_seats, f.licensed_seats, r.licensed_seats) AS licensed_seats,
 c.licensed_seats AS portal_licensed_seats, f.licensed_seats AS salesforce_licensed_seats, r.licensed_seats AS telemetry_licensed_seats, account_arr AS salesforce_account_arr, c.h IS NOT NULL AS in_portal, l.h IS NOT NULL AS in_legacy, f.h IS NOT NULL AS in_salesforce, r.h IS NOT NULL AS in_telemetry
FROM (SELECT *, 1 AS h FROM portal) c FULL JOIN (SELECT *, 1 AS h FROM legacy_licences) l USING (license_id) FULL JOIN (SELECT *, 1 AS h FROM crm_licences QUALIFY row_number() OVER (PARTITION BY license_id ORDER BY created_at DESC, opportunity_id DESC) = 1) f USING (license_id)
FULL JOIN (SELECT license_id, min(license_name) AS license_name, min(licensed_seats) AS licensed_seats, min(starts_at) AS starts_at, min(expire_at) AS expire_at, 1 AS h FROM reports GROUP BY 1 HAVING count(DISTINCT licensed_seats) = 1 AND count(DISTINCT starts_at) = 1 AND count(DISTINCT expire_at) = 1 AND count(DISTINCT customer_id) = 1) r USING (license_id)""",
         "portal", "legacy_licences", "crm_licences", "reports")


def known(t):
    return plan.known_licenses(portal(t), legacy_licences(t), crm_licences(t), reports(t))


@query("j61_known_licenses", s.with_("known") + f"SELECT *, expire_at < TIMESTAMP '{AS_OF}' AS has_expired FROM known")
def _(t):
    return plan.with_expiry(known(t), AS_OF)


s.define("server_licences", """
SELECT 'v' || (o_custkey % 200) AS server_id, issued_at::DATE AS license_date, license_id, customer_id, license_name, licensed_seats, starts_at, expire_at, issued_at + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "timestamp", CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'i' || (o_custkey % 40) END AS installation_id,
 CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderstatus = 'F' END AS is_feature_cloud_enabled FROM reports""", "reports")


def server_licences(t):
    rows = reports(t).select(
        F.concat(F.lit("v"), F.col("o_custkey") % 200).alias("server_id"), F.to_date("issued_at").alias("license_date"), "license_id", "customer_id", "license_name", "licensed_seats",
        "starts_at", "expire_at", (F.col("issued_at") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))).alias("timestamp"), "o_orderpriority", "o_custkey", "o_orderstatus",
    )
    old = rows.where(F.col("o_orderpriority") == "5-LOW").drop("o_orderpriority", "o_custkey", "o_orderstatus")
    new = rows.where(F.col("o_orderpriority") != "5-LOW").withColumns({
        "installation_id": F.concat(F.lit("i"), F.col("o_custkey") % 40), "is_feature_cloud_enabled": F.col("o_orderstatus") == "F"
    }).drop("o_orderpriority", "o_custkey", "o_orderstatus")
    return new, old


s.define("daily_licence", """
SELECT *, md5(server_id || '-' || license_date) AS daily_server_id, expire_at::DATE < license_date AS has_license_expired FROM (SELECT DISTINCT * FROM server_licences) QUALIFY row_number() OVER (PARTITION BY server_id, license_date ORDER BY "timestamp" DESC, license_id DESC) = 1""", "server_licences")


def daily_licence(t):
    return plan.daily_license(*server_licences(t))


@query("j62_daily_license", s.with_("daily_licence") + "SELECT * FROM daily_licence")
def _(t):
    return daily_licence(t)


@query("j62_dim_daily_license", s.with_("daily_licence", "known") + """
SELECT daily_server_id, d.license_id, d.license_name, d.licensed_seats, d.expire_at, has_license_expired, k.is_trial, coalesce(k.company_name, 'Unknown') AS company_name, coalesce(k.contact_email, 'Unknown') AS contact_email, coalesce(k.sku_short_name, 'Unknown') AS sku_short_name,
 coalesce(in_portal, false) AS in_portal, coalesce(in_legacy, false) AS in_legacy, coalesce(in_salesforce, false) AS in_salesforce, d.expire_at = k.expire_at AS is_matching_expiration_date, d.licensed_seats = k.licensed_seats AS is_matching_license_seats FROM daily_licence d LEFT JOIN known k USING (license_id)""")
def _(t):
    return plan.dim_daily_license(daily_licence(t), mart(known(t), "known"))


s.define("cloud_customers", """
SELECT 'i' || (c_custkey % 60) AS installation_id, c_name AS company_name, c_custkey || '@cloud.com' AS contact_email, c_mktsegment AS plan_name, 'cloud-' || c_nationkey AS sku, c_nationkey AS licensed_seats, DATE '2000-01-01' + CAST(c_custkey % 400 AS INTEGER) AS period_end FROM customer""")


def cloud_customers(t):
    key = F.col("c_custkey")
    return t.customer.select(
        F.concat(F.lit("i"), key % 60).alias("installation_id"), F.col("c_name").alias("company_name"), F.concat(key, F.lit("@cloud.com")).alias("contact_email"),
        F.col("c_mktsegment").alias("plan_name"), F.concat(F.lit("cloud-"), "c_nationkey").alias("sku"), F.col("c_nationkey").alias("licensed_seats"),
        F.date_add(s.day("2000-01-01"), (key % 400).cast("int")).alias("period_end"),
    )


@query("j63_latest_server_customer", s.with_("server_licences", "known", "cloud_customers") + """
, l AS (SELECT server_id, license_id, "timestamp"::DATE AS d FROM server_licences QUALIFY row_number() OVER (PARTITION BY server_id ORDER BY "timestamp" DESC, license_id DESC) = 1),
i AS (SELECT server_id, installation_id, "timestamp"::DATE AS d FROM server_licences WHERE installation_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY server_id ORDER BY "timestamp" DESC, installation_id DESC) = 1),
c AS (SELECT * FROM cloud_customers QUALIFY row_number() OVER (PARTITION BY installation_id ORDER BY period_end DESC, company_name DESC) = 1)
SELECT server_id, l.license_id, i.installation_id, coalesce(k.company_name, c.company_name) AS company_name, coalesce(k.contact_email, c.contact_email) AS contact_email, coalesce(k.sku_short_name, c.sku) AS sku, k.expire_at AS license_expire_at, coalesce(k.is_trial, false) AS is_trial_license, c.plan_name AS cloud_plan_name,
 l.license_id IS NOT NULL AS found_matching_license_data, i.installation_id IS NOT NULL AS found_matching_stripe_entry, l.d AS last_license_telemetry_date, i.d AS last_installation_id_date, coalesce(k.licensed_seats, c.licensed_seats) AS licensed_seats
FROM l FULL JOIN i USING (server_id) LEFT JOIN known k ON k.license_id = l.license_id LEFT JOIN c ON c.installation_id = i.installation_id""")
def _(t):
    new, old = server_licences(t)
    licences = new.select("server_id", "license_id", "timestamp").unionByName(old.select("server_id", "license_id", "timestamp"))
    return plan.latest_server_customer(licences, new, known(t), cloud_customers(t))


@query("j64_self_hosted_customers", s.with_("portal", "legacy_licences", "crm_licences") + """
SELECT DISTINCT license_id, account_name AS company_name, 'Stripe' AS source FROM crm_licences UNION SELECT license_id, company_name, 'Portal' FROM portal WHERE license_id NOT IN (SELECT license_id FROM crm_licences)
UNION SELECT license_id, company_name, 'Legacy' FROM legacy_licences WHERE license_id NOT IN (SELECT license_id FROM crm_licences) AND license_id NOT IN (SELECT license_id FROM portal)""")
def _(t):
    pick = lambda df, c="company_name": df.select("license_id", F.col(c).alias("company_name"))
    return plan.by_precedence({"Stripe": pick(crm_licences(t), "account_name"), "Portal": pick(portal(t)), "Legacy": pick(legacy_licences(t))})


@query("j64_license_server_bridge", s.with_("daily_licence") + """
SELECT md5(license_id || '-' || server_id || '-' || coalesce(installation_id, '_dbt_utils_surrogate_key_null_')) AS bdg_license_server_id, license_id, server_id, installation_id, min(license_date) AS first_telemetry_date, max(license_date) AS last_telemetry_date FROM daily_licence
WHERE license_id IN (SELECT license_id FROM daily_licence GROUP BY 1 HAVING count(DISTINCT licensed_seats) = 1 AND count(DISTINCT starts_at) = 1 AND count(DISTINCT expire_at) = 1 AND count(DISTINCT customer_id) = 1) GROUP BY license_id, server_id, installation_id""")
def _(t):
    return plan.license_server_bridge(mart(daily_licence(t), "daily-licence"))


@query("j64_product_customers", s.with_("server_licences", "cloud_customers") + """
SELECT server_id, b.installation_id, c.company_name AS customer_id, period_end AS created_at FROM (SELECT DISTINCT server_id, installation_id FROM server_licences WHERE installation_id IS NOT NULL) b JOIN cloud_customers c USING (installation_id)
WHERE server_id IN (SELECT server_id FROM server_licences WHERE licensed_seats = 11) QUALIFY row_number() OVER (PARTITION BY server_id ORDER BY period_end DESC, c.company_name DESC) = 1""")
def _(t):
    new, old = server_licences(t)
    bridge = new.select("server_id", "installation_id").distinct()
    rows = cloud_customers(t)
    subscriptions = rows.select("installation_id", F.col("company_name").alias("customer_id"), F.col("period_end").alias("created_at"))
    customers = rows.select(F.col("company_name").alias("customer_id"))
    users = new.select("server_id", "licensed_seats").unionByName(old.select("server_id", "licensed_seats")).where(F.col("licensed_seats") == 11)
    return plan.product_customers(bridge, subscriptions, customers, users)


# ---------------------------------------------------------------- older tables

s.define("overview", """
SELECT DISTINCT * FROM (SELECT license_id, 'old' AS feed, 'a' || o_custkey AS account_id, 'o' || o_orderkey AS opportunity_id, license_name AS edition FROM licence_rows WHERE o_orderpriority = '2-HIGH'
 UNION ALL SELECT unnest(['k' || o_custkey, 'k' || (o_custkey + 1)]), 'cloud', 'a' || o_custkey, 'o' || o_orderkey, license_name FROM licence_rows WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
 UNION ALL SELECT license_id, 'online', 'a' || o_custkey, 'o' || o_orderkey, license_name FROM licence_rows WHERE o_orderpriority = '3-MEDIUM' AND license_id NOT IN (SELECT license_id FROM licence_rows WHERE o_orderpriority = '2-HIGH')
 UNION ALL SELECT license_id, 'new', 'a' || o_custkey, 'o' || o_orderkey, license_name FROM licence_rows WHERE o_orderpriority = '1-URGENT' AND license_id NOT IN (SELECT license_id FROM licence_rows WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')))""", "licence_rows")


def overview(t):
    rows = licence_rows(t).select(
        "license_id", F.concat(F.lit("a"), "o_custkey").alias("account_id"), F.concat(F.lit("o"), "o_orderkey").alias("opportunity_id"), F.col("license_name").alias("edition"),
        "o_orderpriority", "o_orderstatus", "o_custkey",
    )
    part = lambda test: rows.where(test).drop("o_orderpriority", "o_orderstatus", "o_custkey")
    priority = F.col("o_orderpriority")
    cloud = rows.withColumn("license_id", F.concat("license_id", F.lit(" , k"), F.col("o_custkey") + 1)).where((priority == "5-LOW") & (F.col("o_orderstatus") == "F"))
    return plan.license_overview(part(priority == "2-HIGH"), part(priority == "1-URGENT"), cloud.drop("o_orderpriority", "o_orderstatus", "o_custkey"), part(priority == "3-MEDIUM"))


@query("j65_license_overview", s.with_("overview") + "SELECT * FROM overview")
def _(t):
    return overview(t)


@query("j65_account_mapping", s.with_("overview", "legacy_licences") + """
, m AS (SELECT license_id, 'm' || customer_id AS account_id, company_name AS company FROM legacy_licences)
SELECT DISTINCT coalesce(m.license_id, o.license_id) AS license_id, coalesce(m.account_id, o.account_id) AS account_id, o.opportunity_id, m.company, NULL::VARCHAR AS contact_id, o.edition, c_name AS account_name FROM m FULL JOIN overview o ON m.license_id = o.license_id
LEFT JOIN customer ON 'a' || c_custkey = coalesce(m.account_id, o.account_id)""")
def _(t):
    none = F.lit(None).cast("string")
    mapping = legacy_licences(t).select("license_id", F.concat(F.lit("m"), "customer_id").alias("account_id"), none.alias("opportunity_id"), F.col("company_name").alias("company"))
    rows = overview(t).drop("feed").withColumns({"company": none, "contact_id": none})
    accounts = t.customer.select(F.concat(F.lit("a"), "c_custkey").alias("account_id"), F.col("c_name").alias("account_name"))
    return plan.account_mapping(mapping, rows, accounts)


s.define("own_licences", """
SELECT 'k' || o_orderkey AS license_id, 'c' || (o_custkey % 500) AS customer_id, CASE WHEN o_orderkey % 7 = 0 THEN 'Firm -TRIAL' ELSE 'Firm ' || (o_custkey % 90) END AS company, CASE o_orderpriority WHEN '1-URGENT' THEN 'E20' WHEN '2-HIGH' THEN 'E20 Trial' WHEN '3-MEDIUM' THEN 'E10' END AS edition,
 CAST(o_orderkey % 50 AS INTEGER) AS users, o_orderdate::DATE AS issued_date, o_orderdate::DATE + CAST(20 + o_orderkey % 30 AS INTEGER) AS expire_date FROM orders""")
s.define("licence_reports", """
SELECT 'k' || l_orderkey AS license_id, 'v' || (l_suppkey % 15) AS server_id, l_shipdate::DATE AS date, max(l_shipdate + to_hours(CAST(l_linenumber AS INTEGER))) AS "timestamp" FROM lineitem GROUP BY ALL""")


def own_licences(t):
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    edition = F.when(F.col("o_orderpriority") == "1-URGENT", "E20").when(F.col("o_orderpriority") == "2-HIGH", "E20 Trial").when(F.col("o_orderpriority") == "3-MEDIUM", "E10")
    return t.orders.select(
        F.concat(F.lit("k"), key).alias("license_id"), F.concat(F.lit("c"), F.col("o_custkey") % 500).alias("customer_id"),
        F.when(key % 7 == 0, "Firm -TRIAL").otherwise(F.concat(F.lit("Firm "), F.col("o_custkey") % 90)).alias("company"), edition.alias("edition"),
        (key % 50).cast("int").alias("users"), day.alias("issued_date"), F.date_add(day, (20 + key % 30).cast("int")).alias("expire_date"),
    )


def licence_reports(t):
    at = F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))
    return t.lineitem.select(
        F.concat(F.lit("k"), "l_orderkey").alias("license_id"), F.concat(F.lit("v"), F.col("l_suppkey") % 15).alias("server_id"), F.to_date("l_shipdate").alias("date"), at.alias("timestamp")
    )


s.define("licence_days", f"""
SELECT date, license_id, server_id, customer_id, company, edition, trial, issued_date, start_date, expire_date, users, "timestamp",
 CASE WHEN lead(start_date) OVER a <= expire_date THEN lead(start_date) OVER a - 1 ELSE expire_date END AS server_expire_date, CASE WHEN lead(start_date) OVER b <= expire_date THEN lead(start_date) OVER b - 1 ELSE expire_date END AS server_expire_date_join,
 server_id IS NOT NULL AND count(*) FILTER (trial) OVER c BETWEEN 1 AND count(*) OVER c - 1 AS has_trial_and_non_trial
FROM (SELECT x.*, r.server_id, r."timestamp", coalesce(company LIKE '% -TRIAL' OR expire_date - start_date <= 35 OR edition = 'E20 Trial', company LIKE '% -TRIAL' OR expire_date - start_date <= 35) AS trial
  FROM (SELECT *, issued_date AS start_date, unnest(generate_series(issued_date::TIMESTAMP, least(expire_date, DATE '{AS_OF}')::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM own_licences) x LEFT JOIN licence_reports r ON r.license_id = x.license_id AND r.date = x.date)
WINDOW a AS (PARTITION BY date, server_id, customer_id, trial ORDER BY start_date, users, license_id, customer_id), b AS (PARTITION BY date, server_id, trial ORDER BY start_date, users, license_id, customer_id), c AS (PARTITION BY date, server_id)""", "own_licences", "licence_reports")


def licence_days(t):
    return plan.license_days(own_licences(t), licence_reports(t), AS_OF)


@query("j65_license_days", s.with_("licence_days") + "SELECT * FROM licence_days")
def _(t):
    return licence_days(t)


s.define("licence_daily", f"""
SELECT p.*, max(license_users) OVER k AS customer_users, max(license_server_dau) OVER k AS customer_server_dau, max(license_registered_users) OVER k AS customer_registered_users,
 CAST(row_number() OVER (PARTITION BY date, company, trial ORDER BY CASE WHEN license_users IS NOT NULL THEN expire_date ELSE start_date END DESC NULLS LAST, license_users DESC NULLS LAST, "timestamp"::DATE DESC NULLS LAST, edition DESC NULLS LAST, license_id, customer_id) AS INTEGER) AS customer_rank,
 md5(date || '-' || license_id || '-' || customer_id) AS id
FROM (SELECT l.date, license_id, customer_id, company, trial, min(issued_date) AS issued_date, min(start_date) AS start_date, max(server_expire_date) AS expire_date, max(edition) AS edition, max(users) AS license_users, count(DISTINCT l.server_id) AS servers, max("timestamp") AS "timestamp",
  sum(u.active_users)::BIGINT AS license_server_dau, sum(nullif(u.registered_users, 0))::BIGINT AS license_registered_users FROM licence_days l LEFT JOIN (SELECT 'v' || (l_suppkey % 15) AS server_id, l_shipdate::DATE AS date, max(l_quantity)::INTEGER AS active_users, min(l_linenumber) - 1 AS registered_users FROM lineitem GROUP BY ALL) u ON u.server_id = l.server_id AND u.date = l.date
  WHERE l.date < DATE '{AS_OF}' AND l.date <= server_expire_date GROUP BY ALL) p WINDOW k AS (PARTITION BY date, customer_id)""", "licence_days")


def licence_daily(t):
    usage = t.lineitem.groupBy(F.concat(F.lit("v"), F.col("l_suppkey") % 15).alias("server_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.max("l_quantity").cast("int").alias("active_users"), (F.min("l_linenumber") - 1).alias("registered_users")
    )
    return plan.license_daily_details(plan.license_day_periods(own_licences(t), licence_reports(t), AS_OF), usage, AS_OF)


@query("j65_license_daily_details", s.with_("licence_daily") + "SELECT * FROM licence_daily")
def _(t):
    return licence_daily(t)


s.define("fact_rows", """
SELECT 'id' || o_orderkey AS id, CASE WHEN o_orderkey % 4 > 0 THEN 'v' || (o_custkey % 120) END AS server_id, 'k' || (o_orderkey % 4000) AS license_id, CASE WHEN o_orderstatus = 'F' THEN 'a' || (o_custkey % 300) END AS account_id, CASE WHEN o_orderstatus = 'F' THEN 'Account ' || (o_custkey % 300) END AS account_name,
 CASE WHEN o_orderpriority <> '5-LOW' THEN 'Firm ' || (o_custkey % 50) || CASE WHEN o_orderkey % 6 = 0 THEN ' - trial' ELSE '' END END AS company, CASE WHEN o_orderkey % 3 = 0 THEN 'q' || (o_custkey % 77) END AS contact_id, 'c' || (o_custkey % 400) AS customer_id,
 'x' || o_custkey || '@' || CASE WHEN o_custkey % 2 = 0 THEN 'gmail.com' ELSE 'firm' || (o_custkey % 60) || '.com' END AS license_email, CASE o_orderpriority WHEN '1-URGENT' THEN 'E20' WHEN '2-HIGH' THEN 'E10' WHEN '3-MEDIUM' THEN 'E20' END AS edition, CAST(o_orderkey % 50 AS INTEGER) AS users,
 o_orderkey % 9 = 0 AS trial, o_orderdate::DATE AS issued_date, o_orderdate::DATE + 1 AS start_date, o_orderdate::DATE + CAST(60 + o_orderkey % 400 AS INTEGER) AS expire_date, CASE WHEN o_orderkey % 5 = 0 THEN 'o' || o_orderkey END AS opportunity_id, CASE WHEN o_orderkey % 8 > 0 THEN o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) END AS last_active_date FROM orders""")


def fact_rows(t):
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), F.to_date("o_orderdate")
    cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    won = F.col("o_orderstatus") == "F"
    p = F.col("o_orderpriority")
    return t.orders.select(
        cat("id", k).alias("id"), F.when(k % 4 > 0, cat("v", c % 120)).alias("server_id"), cat("k", k % 4000).alias("license_id"), F.when(won, cat("a", c % 300)).alias("account_id"),
        F.when(won, cat("Account ", c % 300)).alias("account_name"), F.when(p != "5-LOW", cat("Firm ", c % 50, F.when(k % 6 == 0, " - trial").otherwise(""))).alias("company"),
        F.when(k % 3 == 0, cat("q", c % 77)).alias("contact_id"), cat("c", c % 400).alias("customer_id"),
        cat("x", c, "@", F.when(c % 2 == 0, "gmail.com").otherwise(cat("firm", c % 60, ".com"))).alias("license_email"),
        F.when(p.isin("1-URGENT", "3-MEDIUM"), "E20").when(p == "2-HIGH", "E10").alias("edition"), (k % 50).cast("int").alias("users"), (k % 9 == 0).alias("trial"), day.alias("issued_date"),
        F.date_add(day, 1).alias("start_date"), F.date_add(day, (60 + k % 400).cast("int")).alias("expire_date"), F.when(k % 5 == 0, cat("o", k)).alias("opportunity_id"),
        F.when(k % 8 > 0, F.col("o_orderdate") + F.make_dt_interval((k % 90).cast("int"))).alias("last_active_date"),
    )


def _fill_sql(c: str) -> str:
    return (f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY coalesce(server_id, license_id) ORDER BY last_active_date DESC NULLS FIRST, id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), "
            f"max({c}) OVER (PARTITION BY coalesce(contact_id, license_id)), max({c}) OVER (PARTITION BY coalesce(dom, contact_id, license_id)), max({c}) OVER (PARTITION BY coalesce(customer_id, license_id)))")


@query("j65_license_server_fact", s.with_("fact_rows") + f"""
, f AS (SELECT *, {_fill_sql('account_id')} AS account_filled, {_fill_sql('account_name')} AS an, {_fill_sql('company')} AS cn FROM (SELECT *, nullif(split_part(license_email, '@', 2), 'gmail.com') AS dom FROM fact_rows)),
r AS (SELECT *, coalesce(account_filled, customer_id) AS ck, coalesce(an, cn) AS customer_name, row_number() OVER (PARTITION BY license_id ORDER BY last_active_date NULLS LAST, id) AS license_rank,
  row_number() OVER (PARTITION BY coalesce(server_id, license_id) ORDER BY last_active_date DESC NULLS LAST, id) AS license_priority_rank,
  coalesce({", ".join(f"CASE WHEN lead(start_date, {n}) OVER w <= expire_date THEN lead(start_date, {n}) OVER w - 1 END" for n in (4, 3, 2, 1))}, expire_date) AS license_retired_date,
  trial OR coalesce(lower(split_part(company, ' - ', 2)) IN ('trial', 'non-prod', 'stage license'), false) OR expire_date - start_date < 120 AS short
  FROM f WINDOW w AS (PARTITION BY coalesce(server_id, license_id) ORDER BY start_date, issued_date, id)),
e AS (SELECT *, short AND opportunity_id IS NULL AND (coalesce(edition = 'E20', false) OR (coalesce(edition = 'E10', true) AND account_filled IS NULL)) AS as_trial FROM r),
a AS (SELECT 'v' || (l_suppkey % 120) AS server_id, max(l_shipdate::DATE) AS last_server_telemetry, arg_max(u, l_shipdate) AS u FROM (SELECT l_suppkey % 120 AS l_suppkey, l_shipdate, max(l_quantity)::INTEGER AS u FROM lineitem WHERE l_shipdate <= TIMESTAMP '{AS_OF}' GROUP BY ALL) GROUP BY 1)
SELECT id, e.server_id, license_id, ck AS customer_id, customer_name, account_filled AS account_id, CASE WHEN as_trial THEN 'E20 Trial' ELSE edition END AS edition, users, as_trial AS trial, issued_date, start_date, expire_date, license_rank, license_priority_rank, license_retired_date, last_server_telemetry,
 max(CASE WHEN license_priority_rank = 1 THEN last_server_telemetry END) OVER g AS last_telemetry_date, (sum(CASE WHEN license_priority_rank = 1 AND last_server_telemetry >= DATE '{AS_OF}' - 7 THEN u END) OVER g)::BIGINT AS active_users,
 (sum(CASE WHEN license_priority_rank = 1 AND license_retired_date >= DATE '{AS_OF}' AND license_rank = 1 THEN users END) OVER g)::BIGINT AS customer_license_users FROM e LEFT JOIN a ON a.server_id = e.server_id WINDOW g AS (PARTITION BY ck, short)""")
def _(t):
    activity = t.lineitem.groupBy(F.concat(F.lit("v"), F.col("l_suppkey") % 120).alias("server_id"), F.to_date("l_shipdate").alias("date")).agg(F.max("l_quantity").cast("int").alias("active_users"))
    rows = fact_rows(t)
    public = rows.select(F.split_part("license_email", F.lit("@"), F.lit(2)).alias("domain")).where(F.col("domain") == "gmail.com").distinct()
    return plan.license_server_fact(rows, activity, public, AS_OF)


@query("j65_nonactivated_licenses", s.with_("own_licences", "licence_reports") + "SELECT license_id, customer_id, issued_date FROM own_licences WHERE license_id NOT IN (SELECT license_id FROM licence_reports)")
def _(t):
    return plan.nonactivated_licenses(own_licences(t), licence_reports(t)).select("license_id", "customer_id", "issued_date")


@query("j65b_trailing_average_vs_month_ago", """
WITH d AS (SELECT 'v' || l_suppkey AS server_id, l_shipdate::DATE AS date, max(l_quantity)::INTEGER AS dau FROM lineitem GROUP BY ALL), t AS (SELECT DATE '2000-06-30' AS today)
SELECT server_id, max(dau) FILTER (date = today - 1) AS current_max, sum(dau) FILTER (date BETWEEN today - 8 AND today - 1)::DOUBLE / nullif(count(*) FILTER (date BETWEEN today - 8 AND today - 1), 0) AS current_average,
 max(dau) FILTER (date = today - 31) AS month_ago_max, sum(dau) FILTER (date BETWEEN today - 38 AND today - 31)::DOUBLE / nullif(count(*) FILTER (date BETWEEN today - 38 AND today - 31), 0) AS month_ago_average FROM d, t GROUP BY 1""")
def _(t):
    daily = t.lineitem.groupBy(F.concat(F.lit("v"), "l_suppkey").alias("server_id"), F.to_date("l_shipdate").alias("date")).agg(F.max("l_quantity").cast("int").alias("dau"))
    return plan.trailing_average_vs_month_ago(daily, "2000-07-01 03:00:00", "America/Los_Angeles", "server_id", "dau")


# ---------------------------------------------------------------- subscriptions

s.define("subs", """
SELECT 's' || c_custkey AS subscription_id, 'c' || c_nationkey AS customer_id, CASE WHEN c_acctbal > 0 THEN 'i' || c_custkey END AS installation_id, c_nationkey AS quantity, DATE '1995-01-01' + CAST(c_custkey % 500 AS INTEGER) AS created_at, c_mktsegment AS product_id FROM customer""")


def subs(t):
    key = F.col("c_custkey")
    return t.customer.select(
        F.concat(F.lit("s"), key).alias("subscription_id"), F.concat(F.lit("c"), "c_nationkey").alias("customer_id"), F.when(F.col("c_acctbal") > 0, F.concat(F.lit("i"), key)).alias("installation_id"),
        F.col("c_nationkey").alias("quantity"), F.date_add(s.day("1995-01-01"), (key % 500).cast("int")).alias("created_at"), F.col("c_mktsegment").alias("product_id"),
    )


@query("j66_subscription_history", s.with_("subs") + """
SELECT h.event_id, s.subscription_id, customer_id, coalesce(h.licensed_seats, quantity) AS licensed_seats, h.created_at, s.created_at AS subscription_created_at, CASE WHEN product_id <> 'BUILDING' THEN 'Plan ' || product_id END AS product_name,
 h.subscription_id IS NULL OR row_number() OVER (PARTITION BY h.subscription_id ORDER BY h.created_at DESC, h.event_id DESC) = 1 AS is_latest
FROM (SELECT o_orderkey AS event_id, 's' || o_custkey AS subscription_id, o_orderdate AS created_at, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 90 AS INTEGER) END AS licensed_seats FROM orders WHERE o_totalprice > 300000) h RIGHT JOIN subs s ON s.subscription_id = h.subscription_id WHERE installation_id IS NOT NULL""")
def _(t):
    events = t.orders.where(F.col("o_totalprice") > 300000).select(
        F.col("o_orderkey").alias("event_id"), F.concat(F.lit("s"), "o_custkey").alias("subscription_id"), F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", (F.col("o_orderkey") % 90).cast("int")).alias("licensed_seats"),
    )
    products = t.customer.select(F.col("c_mktsegment").alias("product_id")).distinct().where(F.col("product_id") != "BUILDING").withColumn("product_name", F.concat(F.lit("Plan "), "product_id"))
    return plan.subscription_history(events, subs(t), products)


s.define("usage_days", """
SELECT 's' || user_id AS subscription_id, ts AS "timestamp", CAST(props ->> '$.k' AS INTEGER) // 3 AS active_users FROM events WHERE ts < TIMESTAMP '2024-01-25' + to_days(CAST(user_id % 7 AS INTEGER))""")
s.define("complete_day", """
SELECT u.subscription_id, max_date, usage_start, max(active_users) AS users FROM usage_days u JOIN (SELECT subscription_id, CASE WHEN max("timestamp"::DATE) = DATE '2024-01-28' THEN DATE '2024-01-27' WHEN max("timestamp"::DATE) = DATE '2024-01-27' THEN DATE '2024-01-27' WHEN max("timestamp"::DATE) > DATE '2024-01-28' THEN DATE '2024-01-27' END AS max_date,
  min("timestamp"::DATE) AS usage_start FROM usage_days GROUP BY 1) m ON m.subscription_id = u.subscription_id AND "timestamp"::DATE = max_date GROUP BY ALL""", "usage_days")


def usage_days(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.where(F.col("ts") < s.ts("2024-01-25 00:00:00") + F.make_dt_interval((F.col("user_id") % 7).cast("int"))).select(
        F.concat(F.lit("s"), "user_id").alias("subscription_id"), F.col("ts").alias("timestamp"), F.floor(k / 3).cast("int").alias("active_users")
    )


@query("j67_subscription_run_rate", s.with_("subs", "complete_day") + """
SELECT s.*, CASE WHEN installation_id IS NOT NULL THEN CASE WHEN users > 10 THEN users * 10 ELSE 0 END END AS runrate FROM subs s LEFT JOIN complete_day USING (subscription_id)""")
def _(t):
    return plan.subscription_run_rate(subs(t), usage_days(t), "2024-01-28")


@query("j67b_invoice_forecast", s.with_("complete_day") + """
, inv AS (SELECT 's' || c_custkey AS subscription_id, c_custkey AS invoice_id, CASE WHEN c_nationkey < 12 THEN DATE '2024-01-01' ELSE DATE '2023-12-01' END AS start_date, CASE WHEN c_nationkey < 12 THEN DATE '2024-01-31' ELSE DATE '2023-12-31' END AS end_date,
  CASE WHEN c_nationkey % 3 = 0 THEN 0 ELSE c_custkey * 100 END AS total, CASE WHEN c_nationkey % 6 = 0 THEN 5000 ELSE 0 END AS discounts_total FROM customer)
SELECT i.*, CASE WHEN end_date <= DATE '2024-01-28' THEN total / 100.0::DOUBLE ELSE round(CASE WHEN total = 0 THEN discounts_total / 100.0::DOUBLE ELSE total / 100.0::DOUBLE END + CASE WHEN discounts_total > 0 AND total = 0 THEN 0 WHEN users > 10 THEN users * 10 / 31::DOUBLE * 4 ELSE 0 END - discounts_total / 100.0::DOUBLE, 2) END AS forecasted_total
FROM inv i LEFT JOIN complete_day c ON c.subscription_id = i.subscription_id AND start_date = date_trunc('month', max_date)""")
def _(t):
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    current = nation < 12
    invoices = t.customer.select(
        F.concat(F.lit("s"), key).alias("subscription_id"), key.alias("invoice_id"), F.when(current, s.day("2024-01-01")).otherwise(s.day("2023-12-01")).alias("start_date"),
        F.when(current, s.day("2024-01-31")).otherwise(s.day("2023-12-31")).alias("end_date"), F.when(nation % 3 == 0, 0).otherwise(key * 100).alias("total"),
        F.when(nation % 6 == 0, 5000).otherwise(0).alias("discounts_total"),
    )
    return plan.invoice_forecast(invoices, usage_days(t), "2024-01-28")


# ---------------------------------------------------------------- trials

s.define("trials", """
SELECT o_orderkey AS trial_request_id, CASE WHEN o_orderkey % 10 = 0 THEN 'bad mail' || o_custkey ELSE 'User' || (o_custkey % 700) || CASE WHEN o_orderkey % 9 = 0 THEN '@test.com' ELSE '@firm' || (o_custkey % 40) || '.com' END END AS trial_email,
 'user' || (o_custkey % 700) || '@firm.com' AS contact_email, 'user' || (o_orderkey % 900) || '@firm.com' AS user_email, o_orderdate AS start_at, o_orderpriority, o_custkey FROM orders""")
s.define("leads", """
SELECT 'l' || c_custkey AS lead_id, 'user' || c_custkey || '@firm.com' AS email, ['SMB', 'Enterprise', 'Midmarket', 'Federal', 'Academic', 'MME', 'Non-Profit', 'Other'][CAST(c_custkey % 8 + 1 AS INTEGER)] AS company_type, c_acctbal < 0 AS is_deleted, DATE '1999-01-01' + CAST(c_custkey % 300 AS INTEGER) AS created_at FROM customer""")


def trials(t):
    key, c = F.col("o_orderkey"), F.col("o_custkey")
    good = F.concat(F.lit("User"), c % 700, F.when(key % 9 == 0, "@test.com").otherwise(F.concat(F.lit("@firm"), c % 40, F.lit(".com"))))
    return t.orders.select(
        key.alias("trial_request_id"), F.when(key % 10 == 0, F.concat(F.lit("bad mail"), c)).otherwise(good).alias("trial_email"),
        F.concat(F.lit("user"), c % 700, F.lit("@firm.com")).alias("contact_email"), F.concat(F.lit("user"), key % 900, F.lit("@firm.com")).alias("user_email"),
        F.col("o_orderdate").alias("start_at"), "o_orderpriority", "o_custkey",
    )


def leads(t):
    key = F.col("c_custkey")
    return t.customer.select(
        F.concat(F.lit("l"), key).alias("lead_id"), F.concat(F.lit("user"), key, F.lit("@firm.com")).alias("email"),
        F.get(F.array(*[F.lit(x) for x in [*plan.COMPANY_TYPES, "Other"]]), (key % 8).cast("int")).alias("company_type"), (F.col("c_acctbal") < 0).alias("is_deleted"),
        F.date_add(s.day("1999-01-01"), (key % 300).cast("int")).alias("created_at"),
    )


@query("j68_trial_request_history", s.with_("trials", "leads") + f"""
, p AS (SELECT DISTINCT trial_request_id, trial_email, start_at, lead_id, company_type FROM trials JOIN leads ON email = contact_email OR email = user_email WHERE NOT is_deleted),
a AS (SELECT trial_email, count(DISTINCT trial_request_id) AS total_trial_requests, min(start_at) AS first_trial_start_at, max(start_at) AS last_trial_start_at, count(DISTINCT company_type) AS num_company_types,
 {", ".join(f"count(*) FILTER (company_type = '{c}') > 0 AS marked_as_{c.lower().replace('-', '_')}" for c in plan.COMPANY_TYPES)} FROM p GROUP BY 1)
SELECT trial_request_id, t.trial_email, contact_email, user_email, start_at, a.* EXCLUDE (trial_email) FROM trials t LEFT JOIN a USING (trial_email) WHERE t.trial_email NOT LIKE 'bad mail%' AND t.trial_email NOT LIKE '%test.com'""")
def _(t):
    rows = trials(t)
    cloud = rows.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).drop("o_orderpriority", "o_custkey")
    own = rows.where(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).drop("o_orderpriority", "o_custkey")
    return plan.trial_request_history([cloud, own], leads(t), ["%test.com", "%.local", "test@mail.com"])


@query("j69_trial_to_lead", s.with_("trials", "leads") + """
, r AS (SELECT *, lower(coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN contact_email END, trial_email)) AS mail FROM trials QUALIFY row_number() OVER (PARTITION BY lower(coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN contact_email END, trial_email)) ORDER BY start_at DESC, trial_request_id DESC) = 1),
l AS (SELECT * FROM leads QUALIFY row_number() OVER (PARTITION BY email ORDER BY created_at, lead_id) = 1)
SELECT trial_request_id, left(trial_email, 40) AS name, mail AS normalized_email, CASE WHEN o_orderpriority = '1-URGENT' THEN split_part(mail, '@', 1) ELSE 'Ann' END AS first_name, split_part(mail, '@', 1) AS last_name, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 100 END AS company_size, 'Unknown' AS company_name,
 start_at AS trial_start_at, CASE o_orderpriority WHEN '2-HIGH' THEN 'Website' ELSE 'In-Product' END AS request_source, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'United States' WHEN n_name IS NOT NULL THEN n_name ELSE '' END AS country_name, l.lead_id, l.lead_id IS NOT NULL AS is_existing_lead,
 l.lead_id IS NOT NULL AND NOT is_deleted AS is_existing_campaign_member, 'camp' AS campaign_id, mail LIKE '%firm3.com' OR mail LIKE '%@firm5.com' AS is_blacklisted_email
FROM r LEFT JOIN l ON l.email = mail LEFT JOIN nation ON o_orderpriority <> '3-MEDIUM' AND n_nationkey = o_custkey WHERE mail NOT LIKE 'bad mail%'""")
def _(t):
    p, none = F.col("o_orderpriority"), F.lit(None).cast("string")
    requests = trials(t).select(
        "trial_request_id", none.alias("name"), F.col("trial_email").alias("email"), F.when(p == "5-LOW", F.col("contact_email")).alias("contact_email"),
        F.when(p == "1-URGENT", " ").otherwise("Ann").alias("first_name"), none.alias("last_name"), F.when(p == "1-URGENT", "ONE_TO_50").when(p == "2-HIGH", "ONE_HUNDRED_TO_500").alias("company_size_bucket"),
        none.alias("company_name"), F.when(p == "3-MEDIUM", "United States of America").when(F.col("o_custkey") < 25, F.concat(F.lit("N"), "o_custkey")).alias("country_name"),
        F.when(p == "2-HIGH", "https://Product.example").otherwise("https://own.example").alias("site_url"), "start_at",
    )
    members = leads(t).where(~F.col("is_deleted")).select("lead_id", F.concat(F.lit("m"), "lead_id").alias("campaign_member_id"), F.lit("camp").alias("campaign_id"))
    countries = t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("name"))
    return plan.trial_to_lead(requests, leads(t), members, countries, "camp", ["firm3.com"], ["firm5.com"], "https://product.example")


@query("j69_newsletter_leads", s.with_("trials", "leads") + """
, m AS (SELECT trial_request_id AS marketing_id, replace(contact_email, 'user', 'USER') AS email FROM trials WHERE o_orderpriority <> '4-NOT SPECIFIED' QUALIFY row_number() OVER (PARTITION BY contact_email ORDER BY start_at DESC, trial_request_id DESC) = 1)
SELECT marketing_id, m.email, lead_id, lead_id IS NOT NULL AS is_existing_lead, lead_id IS NOT NULL AND is_deleted AS is_existing_campaign_member FROM m LEFT JOIN leads l ON lower(l.email) = lower(m.email)""")
def _(t):
    content = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "offers").otherwise("security_newsletter")
    rows = trials(t).select(
        F.col("trial_request_id").alias("marketing_id"), F.replace("contact_email", F.lit("user"), F.lit("USER")).alias("email"), content.alias("subscribed_content"), F.col("start_at").alias("created_at")
    )
    members = leads(t).where("is_deleted").select("lead_id", F.concat(F.lit("m"), "lead_id").alias("campaign_member_id"), F.lit("news").alias("campaign_id"))
    return plan.newsletter_leads(rows, leads(t), members, "news", "security_newsletter")


@query("j70_cloud_conversion", s.with_("subs") + """
SELECT 'a' || (o_custkey % 200) AS account_id, 'Account ' || (o_custkey % 200) AS account_name, s.subscription_id, s.installation_id, md5('a' || (o_custkey % 200) || '-Account ' || (o_custkey % 200) || '-' || s.subscription_id) AS id, min(f) AS first_active_date, max(l) AS last_active_date, min(l_shipdate::DATE) AS paid_conversion_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN subs s ON s.subscription_id = 's' || l_partkey JOIN (SELECT 'i' || user_id AS installation_id, min(ts)::DATE AS f, max(ts)::DATE AS l FROM events GROUP BY 1) v ON v.installation_id = s.installation_id GROUP BY ALL""")
def _(t):
    lines = t.lineitem.select(F.concat(F.lit("o"), "l_orderkey").alias("opportunity_id"), F.concat(F.lit("s"), "l_partkey").alias("subscription_id"), F.to_date("l_shipdate").alias("created_date"))
    owner = F.col("o_custkey") % 200
    deals = t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("opportunity_id"), F.concat(F.lit("a"), owner).alias("account_id"))
    accounts = t.orders.select(F.concat(F.lit("a"), owner).alias("account_id"), F.concat(F.lit("Account "), owner).alias("account_name")).distinct()
    servers = t.events.select(F.concat(F.lit("i"), "user_id").alias("installation_id"), F.to_date("ts").alias("first_active_date"), F.to_date("ts").alias("last_active_date"))
    return plan.cloud_conversion(lines, deals, accounts, subs(t), servers)


@query("j70_onprem_conversion", s.with_("deals", "fact_rows") + f"""
, acc AS (SELECT 'a' || c_custkey AS account_id, c_name AS account_name, 'x' || (c_custkey + 1) || '@firm' || ((c_custkey + 1) % 60) || '.com' AS email FROM customer),
w AS (SELECT d.*, account_name, email, CASE WHEN stage = '3-MEDIUM' THEN 'partner' END AS partner, 'k' || (o_orderkey % 4000) AS license_id, e FROM deals d JOIN acc USING (account_id) JOIN (SELECT 'o' || l_orderkey AS opportunity_id, max(l_shipdate::DATE) + 364 AS e FROM lineitem GROUP BY 1) USING (opportunity_id) WHERE is_won),
m AS (SELECT w.*, f.license_id AS lid, f.server_id, f.edition, f.issued_date, f.start_date FROM w LEFT JOIN fact_rows f ON CASE WHEN partner IS NULL THEN w.email = f.license_email WHEN w.account_id IN ('a7', 'a9') THEN w.license_id = f.license_id ELSE w.account_id = f.account_id END)
SELECT account_id, account_name, min(start_date) AS first_telemetry_date, min(start_date) < min(close_date) AS free_to_paid, min(close_date) AS paid_conversion_date, max(close_date) AS last_won_opportunity_date, max(e) AS paid_expire_date, max(e) < DATE '{AS_OF}' AS churned, count(DISTINCT server_id) AS servers, min(lid) IS NOT NULL AS accountid_match,
 min(issued_date) FILTER (edition = 'E20') AS trial_date, coalesce(min(issued_date) FILTER (edition = 'E20') < min(close_date) FILTER (type = 'New Subscription'), false) AS trial_to_paid_conversion, max(amount)::DOUBLE AS amount, md5(account_id || '-' || account_name) AS id FROM m GROUP BY account_id, account_name""")
def _(t):
    deals = s.deals(t).select(
        "opportunity_id", "account_id", F.when(F.col("stage") == "3-MEDIUM", "partner").alias("partner"), F.concat(F.lit("k"), F.col("o_orderkey") % 4000).alias("license_id"),
        F.col("close_date").alias("created_date"), "type", F.col("amount").cast("double").alias("amount"), "is_won",
    )
    following = F.col("c_custkey") + 1
    accounts = t.customer.select(
        F.concat(F.lit("a"), "c_custkey").alias("account_id"), F.col("c_name").alias("account_name"), F.concat(F.lit("x"), following, F.lit("@firm"), following % 60, F.lit(".com")).alias("email")
    )
    licences = fact_rows(t).select(
        "license_id", "account_id", "license_email", F.when(F.col("edition") == "E20", "E20 Trial").otherwise(F.col("edition")).alias("edition"), "server_id", "issued_date",
        F.col("start_date").alias("activation_date"),
    )
    return plan.onprem_conversion(deals, s.lines(t), accounts, licences, AS_OF, ["a7", "a9"])


def _uuid_sql(expr: str) -> str:
    d = f"sha1(unhex('7815718982de4f4d9db388c601fbc22e') || encode({expr}))"
    return f"({d})[1:8] || '-' || ({d})[9:12] || '-5' || ({d})[14:16] || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', ({d})[17]), 1) || ({d})[18:20] || '-' || ({d})[21:32]"


@query("j71_billing_entities", f"""
WITH c AS (SELECT 'c' || c_custkey AS customer_id, 'u' || c_custkey || CASE WHEN c_nationkey % 3 = 0 THEN '@gmail.com' ELSE '@firm' || (c_custkey % 70) || '.com' END AS email, c_custkey, c_nationkey, c_mktsegment FROM customer),
s AS (SELECT 's' || o_orderkey AS subscription_id, 'n' || o_orderkey AS version_id, 'c' || o_custkey AS customer_id, 'h' || o_orderkey AS charge_id, o_orderdate AS created_at, CAST(o_totalprice * 100 AS BIGINT) AS total_cents, o_orderstatus, o_orderkey FROM orders),
x AS (SELECT s.*, email, CASE WHEN c_nationkey % 3 > 0 THEN 'firm' || (c_custkey % 70) || '.com' END AS domain, 'N' || c_nationkey AS country, CASE WHEN c_nationkey < 20 THEN 'state ' || c_nationkey END AS state_code, lag(version_id) OVER (PARTITION BY s.customer_id ORDER BY created_at, subscription_id) AS previous_version_id, c_custkey, c_mktsegment FROM s JOIN c USING (customer_id)),
y AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'deal-' || o_orderkey ELSE {_uuid_sql("version_id")} END AS opportunity_external_id FROM x)
SELECT subscription_id, customer_id, email, domain, country, state_code, previous_version_id, total_cents / 100.0::DOUBLE AS total, CASE WHEN domain IS NOT NULL THEN 'acc-' || domain END AS account_id, CASE WHEN domain IS NOT NULL THEN 'ext-' || domain ELSE {_uuid_sql("customer_id")} END AS account_external_id,
 CASE WHEN c_mktsegment = 'BUILDING' THEN 'con-' || c_custkey ELSE {_uuid_sql("customer_id || email")} END AS contact_external_id, opportunity_external_id, {_uuid_sql("opportunity_external_id || 'oli'")} AS opportunitylineitem_external_id FROM y""")
def _(t):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    firm = cat("firm", key % 70, ".com")
    customers = t.customer.select(cat("c", key).alias("customer_id"), cat("u", key, F.when(nation % 3 == 0, "@gmail.com").otherwise(cat("@", firm))).alias("email"))
    order = F.col("o_orderkey")
    subscriptions = t.orders.select(
        cat("s", order).alias("subscription_id"), cat("n", order).alias("version_id"), cat("c", F.col("o_custkey")).alias("customer_id"), cat("h", order).alias("charge_id"),
        F.col("o_orderdate").alias("created_at"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("total_cents"),
    )
    address = t.customer.select(cat("c", key).alias("customer_id"), cat("N", nation).alias("country"), cat("P", nation).alias("postal_code"), F.lit(1).alias("created_at"))
    older = address.withColumns({"country": F.lit("old"), "created_at": F.lit(0)})
    places = t.nation.where(F.col("n_nationkey") < 20).select(cat("N", F.col("n_nationkey")).alias("country"), cat("P", F.col("n_nationkey"), "-77").alias("postal_code"), cat("state ", F.col("n_nationkey")).alias("state_code"))
    accounts = t.customer.select(firm.alias("domain"), cat("ext-", firm).alias("account_external_id"), cat("acc-", firm).alias("account_id"), F.lit(1).alias("modified_at")).distinct()
    contacts = customers.join(t.customer.where(F.col("c_mktsegment") == "BUILDING"), F.col("customer_id") == cat("c", key)).select(
        "email", cat("con-", key).alias("contact_external_id"), F.lit(1).alias("modified_at")
    )
    deals = t.orders.where(F.col("o_orderstatus") == "F").select(cat("h", order).alias("charge_id"), cat("deal-", order).alias("opportunity_external_id"), F.lit(1).alias("modified_at"))
    return plan.billing_entities(customers, subscriptions, address.unionByName(older), places, accounts, contacts, deals)
