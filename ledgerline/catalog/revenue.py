"""Recurring revenue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import revenue as plan
from . import standins as s
from .registry import mart, query

AS_OF = "2000-06-30"

# Accounts are nations, their parents regions; contracts run 60 to 119 days from the ship date.
s.define("nation_deals", """
SELECT 'o' || o_orderkey AS opportunity_id, 'n' || c_nationkey AS account_id, o_orderstatus = 'F' AS is_won, o_orderstatus <> 'O' AS is_closed, CASE WHEN o_orderkey % 3 = 0 THEN 'o' || (o_orderkey // 3) END AS renewed_by FROM orders JOIN customer ON c_custkey = o_custkey""")
s.define("contract_lines", """
SELECT 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_id, 'o' || l_orderkey AS opportunity_id, l_shipdate::DATE AS start_date, l_shipdate::DATE + CAST(59 + l_partkey % 60 AS INTEGER) AS end_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS total_price,
 CAST(l_quantity AS INTEGER) AS quantity, CASE WHEN l_returnflag IN ('A', 'N') THEN 'Recurring' ELSE 'One-time' END AS product_type FROM lineitem""")
_LEAP = "CASE WHEN start_date <= DATE '1996-02-29' AND end_date >= DATE '1996-02-29' OR start_date <= DATE '2000-02-29' AND end_date >= DATE '2000-02-29' THEN 1 ELSE 0 END"
s.define("annual", f"""
SELECT line_id, opportunity_id, account_id, start_date, end_date, CASE WHEN is_won THEN v ELSE 0 END AS won_arr, CASE WHEN is_closed AND NOT is_won THEN v ELSE 0 END AS lost_arr, CASE WHEN NOT is_closed THEN v ELSE 0 END AS open_arr
FROM (SELECT *, CAST(floor(total_price::DOUBLE * 365 / (end_date - start_date + 1 - {_LEAP}) + 0.5) AS BIGINT) AS v FROM contract_lines WHERE product_type = 'Recurring') JOIN nation_deals USING (opportunity_id)""", "contract_lines", "nation_deals")
s.define("account_days", """
SELECT account_id, 'r' || (account_id[2:]::INTEGER % 5) AS master_account_id, day, sum(won)::BIGINT AS total_arr FROM (SELECT account_id, opportunity_id, day, sum(won_arr) AS won FROM (SELECT *, unnest(generate_series(start_date::TIMESTAMP, end_date::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM annual WHERE won_arr <> 0) GROUP BY ALL)
WHERE won <> 0 GROUP BY ALL""", "annual")


def nation_deals(t):
    key = F.col("o_orderkey")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("o"), key).alias("opportunity_id"), F.concat(F.lit("n"), "c_nationkey").alias("account_id"), (F.col("o_orderstatus") == "F").alias("is_won"),
        (F.col("o_orderstatus") != "O").alias("is_closed"), F.when(key % 3 == 0, F.concat(F.lit("o"), F.floor(key / 3))).alias("renewed_by"),
    )


def contract_lines(t):
    start = F.to_date("l_shipdate")
    return t.lineitem.select(
        F.concat(F.lit("l"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("line_id"), F.concat(F.lit("o"), "l_orderkey").alias("opportunity_id"),
        start.alias("start_date"), F.date_add(start, (59 + F.col("l_partkey") % 60).cast("int")).alias("end_date"), F.col("l_extendedprice").cast("decimal(18,2)").alias("total_price"),
        F.col("l_quantity").cast("int").alias("quantity"), F.when(F.col("l_returnflag").isin("A", "N"), "Recurring").otherwise("One-time").alias("product_type"),
    )


def nation_accounts(t):
    return t.nation.select(
        F.concat(F.lit("n"), "n_nationkey").alias("account_id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("account_name")
    )


def annual(t):
    return plan.annualised_lines(contract_lines(t), nation_deals(t))


def account_days(t):
    return mart(plan.account_daily_arr(plan.opportunity_arr_steps(annual(t), nation_accounts(t))), "account-days")


@query("j77_annualised_lines", s.with_("annual") + "SELECT * FROM annual")
def _(t):
    return annual(t)


@query("j77_daily_arr", s.with_("account_days") + "SELECT * FROM account_days")
def _(t):
    return account_days(t)


@query("j77_line_days_per_day", s.with_("annual") + """
SELECT day, count(*) AS lines, sum(won_arr)::BIGINT AS won_arr, sum(lost_arr)::BIGINT AS lost_arr, sum(open_arr)::BIGINT AS open_arr FROM (SELECT *, unnest(generate_series(start_date::TIMESTAMP, end_date::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM annual) GROUP BY 1""")
def _(t):
    return plan.line_daily_arr(annual(t)).groupBy("day").agg(F.count("*").alias("lines"), *[F.sum(m).alias(m) for m in plan.MEASURES])


s.define("current_arr", f"""
SELECT 'n' || n_nationkey AS account_id, greatest(coalesce(a, 0), 0)::DOUBLE AS total_arr, greatest(coalesce(q, 0), 0)::BIGINT AS seats FROM nation LEFT JOIN (SELECT account_id, sum(CAST(floor(total_price::DOUBLE * 365 / (end_date - start_date + 1 - {_LEAP}) * 100.0 + 0.5) / 100.0 AS DECIMAL(18,2))) AS a, sum(CASE WHEN product_type = 'Recurring' THEN quantity ELSE 0 END) AS q
  FROM contract_lines JOIN nation_deals USING (opportunity_id) WHERE is_won AND DATE '{AS_OF}' BETWEEN start_date AND end_date GROUP BY 1) x ON x.account_id = 'n' || n_nationkey""", "contract_lines", "nation_deals")


def current_arr(t):
    return plan.account_arr_and_seats(contract_lines(t), nation_deals(t), nation_accounts(t), AS_OF)


@query("j78_account_arr_and_seats", s.with_("current_arr") + "SELECT * FROM current_arr")
def _(t):
    return current_arr(t)


@query("j78_customer_type_sync", s.with_("current_arr") + """
, a AS (SELECT 'n' || n_nationkey AS account_id, CASE WHEN n_nationkey >= 5 THEN 'n' || n_regionkey END AS parent_id, ['Customer', 'Partner', 'Prospect'][n_nationkey % 3 + 1] AS type, CASE WHEN n_nationkey % 4 > 0 THEN total_arr ELSE 0 END AS arr, CASE WHEN n_nationkey % 4 > 0 THEN seats ELSE 0 END AS seats FROM nation JOIN current_arr ON account_id = 'n' || n_nationkey),
k AS (SELECT parent_id, sum(CAST(arr AS DECIMAL(18,2))) AS ca, sum(seats) AS cs FROM a GROUP BY 1),
w AS (SELECT a.account_id, c.total_arr AS arr, c.seats, CASE WHEN type NOT IN ('Vendor', 'Partner') AND (a.arr > 0 OR ca > 0 OR a.seats > 0 OR cs > 0) THEN 'Customer' WHEN type = 'Customer' THEN 'Customer (Attrited)' ELSE type END AS type FROM a JOIN current_arr c ON c.account_id = a.account_id LEFT JOIN k ON k.parent_id = a.account_id)
SELECT w.* FROM w JOIN a USING (account_id) WHERE (w.arr, w.seats, w.type) IS DISTINCT FROM (a.arr, a.seats, a.type)""")
def _(t):
    now = mart(current_arr(t), "current-arr")
    key = F.col("n_nationkey")
    held = key % 4 > 0
    accounts = t.nation.withColumn("account_id", F.concat(F.lit("n"), key)).join(now, "account_id").select(
        "account_id", F.when(key >= 5, F.concat(F.lit("n"), "n_regionkey")).alias("parent_id"), F.get(F.array(F.lit("Customer"), F.lit("Partner"), F.lit("Prospect")), key % 3).alias("type"),
        F.when(held, F.col("total_arr")).otherwise(0.0).alias("arr"), F.when(held, F.col("seats")).otherwise(0).alias("seats"),
    )
    return plan.customer_type_sync(accounts, now)


s.define("day_deltas", """
SELECT day AS new_day, day - 1 AS previous_day, master_account_id, account_id, coalesce(day = f, false) AS account_new_arr, day(day) = 1 AS month_start, day = last_day(day) AS month_end, now AS new_day_total_arr, CASE WHEN day = f THEN 0 ELSE before END AS previous_day_total_arr, now - CASE WHEN day = f THEN 0 ELSE before END AS total_arr_delta
FROM (SELECT x.day, x.account_id, 'r' || (x.account_id[2:]::INTEGER % 5) AS master_account_id, coalesce(a.total_arr, 0) AS now, coalesce(b.total_arr, 0) AS before, CASE WHEN a.account_id IS NOT NULL THEN f END AS f FROM (SELECT account_id, unnest(generate_series(min(start_date)::TIMESTAMP - INTERVAL 1 DAY, max(end_date)::TIMESTAMP + INTERVAL 2 DAY, INTERVAL 1 DAY))::DATE AS day FROM contract_lines JOIN nation_deals USING (opportunity_id) WHERE is_won GROUP BY account_id) x
 LEFT JOIN account_days a ON a.account_id = x.account_id AND a.day = x.day LEFT JOIN account_days b ON b.account_id = x.account_id AND b.day = x.day - 1 LEFT JOIN (SELECT account_id, min(day) AS f FROM account_days GROUP BY 1) m ON m.account_id = x.account_id)""", "account_days", "contract_lines", "nation_deals")
s.define("month_deltas", """
SELECT date_trunc('month', new_day)::DATE AS month_start, last_day(new_day) AS month_end, master_account_id, account_id, bool_or(account_new_arr) AS account_new_arr, max(CASE WHEN month_start THEN previous_day_total_arr ELSE 0 END) AS month_starting_arr, max(CASE WHEN month_end THEN new_day_total_arr ELSE 0 END) AS month_ending_arr,
 sum(total_arr_delta)::BIGINT AS total_arr_delta FROM day_deltas GROUP BY date_trunc('month', new_day)::DATE, last_day(new_day), master_account_id, account_id""", "day_deltas")


def day_deltas(t):
    return plan.account_daily_deltas(account_days(t), contract_lines(t), nation_deals(t), nation_accounts(t))


@query("j79_account_daily_deltas", s.with_("day_deltas") + "SELECT * FROM day_deltas")
def _(t):
    return day_deltas(t)


@query("j80_monthly_deltas", s.with_("month_deltas") + "SELECT * FROM month_deltas")
def _(t):
    return plan.monthly_deltas(day_deltas(t))


@query("j80_monthly_deltas_by_type", s.with_("month_deltas") + """
SELECT month_start, month_end, account_id, master_account_id, CASE WHEN account_new_arr THEN 'New ARR' WHEN month_starting_arr <> 0 AND total_arr_delta > 0 THEN 'Expansion ARR' WHEN month_starting_arr = 0 AND total_arr_delta > 0 THEN 'Resurrection ARR' WHEN total_arr_delta < 0 AND month_ending_arr <> 0 THEN 'Contraction ARR' WHEN total_arr_delta < 0 THEN 'Churn ARR' END AS arr_type,
 CASE WHEN account_new_arr THEN total_arr_delta ELSE 0 END AS total_arr_new, CASE WHEN NOT account_new_arr AND month_starting_arr <> 0 AND total_arr_delta > 0 THEN total_arr_delta ELSE 0 END AS total_arr_expansion, CASE WHEN NOT account_new_arr AND month_starting_arr = 0 AND total_arr_delta > 0 THEN total_arr_delta ELSE 0 END AS total_arr_resurrection,
 CASE WHEN total_arr_delta < 0 AND month_ending_arr <> 0 THEN total_arr_delta ELSE 0 END AS total_arr_contraction, CASE WHEN total_arr_delta < 0 AND month_ending_arr = 0 THEN total_arr_delta ELSE 0 END AS total_arr_churn, total_arr_delta FROM month_deltas WHERE total_arr_delta <> 0""")
def _(t):
    return plan.monthly_deltas_by_type(plan.monthly_deltas(mart(day_deltas(t), "day-deltas")))


# ---------------------------------------------------------------- transactions

s.define("licence_deals", """
SELECT 'o' || o_orderkey AS opportunity_id, 'a' || o_custkey AS account_id, o_orderdate::DATE AS license_start, o_orderdate::DATE + CAST(CASE o_orderkey % 4 WHEN 0 THEN 729 WHEN 1 THEN 180 ELSE 364 END AS INTEGER) AS license_end, o_orderdate::DATE + CAST(o_orderkey % 7 * 30 - 60 AS INTEGER) AS close_date,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'New Subscription' WHEN '2-HIGH' THEN 'Account Expansion' WHEN '3-MEDIUM' THEN 'Renewal' WHEN '4-NOT SPECIFIED' THEN 'Existing Business' ELSE 'Monthly Billing' END AS type, CASE WHEN o_orderkey % 5 = 0 THEN 'Yearly renewal' ELSE 'Deal' END AS name, o_totalprice AS amount, o_orderstatus = 'F' AS is_won, o_orderstatus <> 'O' AS is_closed,
 o_orderkey, o_orderstatus, o_orderpriority FROM orders""")


def licence_deals(t):
    key, day, p = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderpriority")
    length = F.when(key % 4 == 0, 729).when(key % 4 == 1, 180).otherwise(364)
    kind = F.when(p == "1-URGENT", "New Subscription").when(p == "2-HIGH", "Account Expansion").when(p == "3-MEDIUM", "Renewal").when(p == "4-NOT SPECIFIED", "Existing Business").otherwise("Monthly Billing")
    return t.orders.select(
        F.concat(F.lit("o"), key).alias("opportunity_id"), F.concat(F.lit("a"), F.col("o_custkey")).alias("account_id"), day.alias("license_start"), F.date_add(day, length).alias("license_end"),
        F.date_add(day, (key % 7 * 30 - 60).cast("int")).alias("close_date"), kind.alias("type"), F.when(key % 5 == 0, "Yearly renewal").otherwise("Deal").alias("name"),
        F.col("o_totalprice").alias("amount"), (F.col("o_orderstatus") == "F").alias("is_won"), (F.col("o_orderstatus") != "O").alias("is_closed"), key, "o_orderstatus", p,
    )


def deal_accounts(t):
    key = F.col("c_custkey")
    return t.customer.select(
        F.concat(F.lit("a"), key).alias("account_id"), F.when(F.col("c_nationkey") < 12, F.concat(F.lit("a"), F.col("c_nationkey"))).alias("parent_id"), F.col("c_name").alias("account_name"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).alias("tier"),
    )


s.define("deal_accounts", "SELECT 'a' || c_custkey AS account_id, CASE WHEN c_nationkey < 12 THEN 'a' || c_nationkey END AS parent_id, c_name AS account_name, CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS tier FROM customer")
_FY = "make_date(CASE WHEN month({d}) = 1 THEN year({d}) ELSE year({d}) + 1 END, 1, 31)"
_FQ = "last_day((date_trunc('quarter', {d} - INTERVAL 1 MONTH) + INTERVAL 3 MONTH)::DATE)"
_WEEK = "(date_trunc('week', {d}) + INTERVAL 6 DAY)::DATE"
s.define("won_deals", """
SELECT *, CASE WHEN term = 12 THEN bill_amt ELSE CAST(floor(bill_amt::DOUBLE / days * 365 + 0.5) AS BIGINT) END AS opportunity_arr FROM (SELECT *, CASE WHEN lower(name) LIKE '%renew%' THEN 'Renewal' ELSE type END AS opp_type, CAST(floor(days / (365 / 12) + 0.5) AS INTEGER) AS term, CAST(floor(amount + 0.5) AS BIGINT) AS bill_amt
 FROM (SELECT *, license_end - license_start AS days FROM licence_deals WHERE is_won AND type <> 'Monthly Billing'))""", "licence_deals")
s.define("transactions", f"""
SELECT account_id || '-' || trans_no AS unique_key, account_name, coalesce(parent_id, account_id) AS parent_id, account_id, opportunity_id, match_key, {_FY.format(d='report_month')} AS fiscal_year, {_FQ.format(d='report_month')} AS fiscal_quarter, report_month, report_date, {_WEEK.format(d='report_date')} AS report_week,
 last_day(closing_date) AS closing_month, {_WEEK.format(d='closing_date')} AS closing_week, {_FQ.format(d='closing_date')} AS closing_fiscal_quarter, {_FY.format(d='closing_date')} AS closing_fiscal_year, closing_date, license_start AS license_start_date, license_end AS license_end_date, account_start, max_license, trans_no, opp_type,
 term AS term_months, billing_amt, CASE WHEN term <= 12 THEN billing_amt::DOUBLE ELSE floor(billing_amt::DOUBLE / term * 12 * 100.0 + 0.5) / 100.0 END AS first_yr_bill, opportunity_arr, expire_arr, CASE WHEN trans_no = 1 THEN 0 ELSE renewal_arr END AS renew_arr, arr_change, sum(arr_change) OVER (PARTITION BY account_id ORDER BY trans_no)::BIGINT AS ending_arr,
 CASE WHEN trans_no = 1 THEN opportunity_arr ELSE 0 END AS new_arr, CASE WHEN opp_type <> 'Expired' AND license_end >= DATE '{AS_OF}' AND license_start <= DATE '{AS_OF}' AND is_won AND report_month <= DATE '{AS_OF}' THEN opportunity_arr ELSE 0 END AS active_arr,
 CAST(year(license_start) - year(account_start) AS INTEGER) AS beg_tenure_yr, CAST(year(license_end) - year(account_start) AS INTEGER) AS end_tenure_yr, is_won
FROM (SELECT *, last_day(report_date) AS report_month, CASE WHEN last_day(report_date) > DATE '{AS_OF}' THEN 0 ELSE opportunity_arr + expire_arr END AS arr_change FROM (SELECT m.*, greatest(closing_date, license_start) AS report_date, dense_rank() OVER (PARTITION BY account_id ORDER BY closing_date, coalesce(opportunity_id, '~')) AS trans_no, min(license_start) OVER (PARTITION BY account_id) AS account_start,
   max(CASE WHEN opp_type <> 'Expired' THEN license_end END) OVER (PARTITION BY account_id) AS max_license FROM (SELECT *, coalesce(close_date, license_start) AS closing_date FROM (
  SELECT match_key, account_id, opportunity_id, max(CASE WHEN is_won THEN close_date END) AS close_date, max(license_start) AS license_start, min(license_end) AS license_end, bool_or(is_won) AS is_won, max(CASE WHEN is_won THEN 'Renewal' ELSE 'Expired' END) AS opp_type, max(CASE WHEN is_won THEN term ELSE 0 END) AS term,
   sum(bill_amt)::BIGINT AS billing_amt, sum(opportunity_arr)::BIGINT AS opportunity_arr, sum(expire_arr)::BIGINT AS expire_arr, sum(renewal_arr)::BIGINT AS renewal_arr FROM (
   SELECT DISTINCT account_id, NULL::VARCHAR AS opportunity_id, NULL::DATE AS close_date, license_end + 1 AS license_start, (license_end + INTERVAL 1 YEAR)::DATE AS license_end, 12 AS term, false AS is_won, 0 AS bill_amt, 0 AS opportunity_arr, -opportunity_arr AS expire_arr, 0 AS renewal_arr,
     year(license_end) || '-' || rank() OVER (PARTITION BY account_id, year(license_end) ORDER BY date_trunc('month', license_end)) || '-' || account_id AS match_key FROM won_deals
   UNION ALL SELECT account_id, opportunity_id, close_date, license_start, license_end, term, is_won, bill_amt, opportunity_arr, 0, opportunity_arr, year(license_start) || '-' || rank() OVER (PARTITION BY account_id, year(license_start) ORDER BY date_trunc('month', license_start)) || '-' || account_id FROM won_deals WHERE opp_type = 'Renewal') GROUP BY 1, 2, 3
  UNION ALL SELECT NULL, account_id, opportunity_id, close_date, license_start, license_end, is_won, opp_type, term, bill_amt, opportunity_arr, 0, 0 FROM won_deals WHERE opp_type <> 'Renewal')) m)) LEFT JOIN deal_accounts USING (account_id)""", "won_deals", "deal_accounts")


def transactions(t):
    return plan.arr_transactions(licence_deals(t), deal_accounts(t), AS_OF)


@query("j81_arr_transactions", s.with_("transactions") + "SELECT * FROM transactions")
def _(t):
    return transactions(t)


_REPORTING = f"""
SELECT *, sum(arr_delta) OVER g::BIGINT AS total_end_arr, (sum(arr_delta) OVER g - arr_delta)::BIGINT AS total_beg_arr, sum(cnt_changed) OVER g::BIGINT AS active_customers, CASE WHEN latest_arr > 500000 THEN '1_AvgARR_above500K' WHEN latest_arr > 100000 THEN '2_AvgARR_100Kupto500K' WHEN latest_arr > 10000 THEN '3_AvgARR_10Kupto100K' ELSE '4_AvgARR_upto10K' END AS bin_avg_arr,
 {_FQ.format(d='cohort_month')} AS cohort_fiscal_qtr, {_FY.format(d='cohort_month')} AS cohort_fiscal_yr, CAST(year(fiscal_yr) - year({_FY.format(d='cohort_month')}) AS INTEGER) AS fiscal_year_no, tcv - arr AS multi_yr, tcv - renewed - late_renewal AS net_booking, account_id || '-' || report_mo AS unique_key
FROM (SELECT *, cnt_new + cnt_late_renewal + cnt_resurrected + cnt_churned AS cnt_changed, greatest(acct_beg_arr, acct_end_arr) AS ref_arr, last_value(greatest(acct_beg_arr, acct_end_arr)) OVER (PARTITION BY account_id ORDER BY license_beg, close_day, report_mo ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS latest_arr,
  CAST(row_number() OVER (PARTITION BY account_id ORDER BY license_beg, close_day, report_mo) AS INTEGER) AS trans_no
 FROM (SELECT *, CASE WHEN arr_renewed > 0 AND expire < 0 THEN -(expire - churned - contracted) ELSE 0 END AS renewed, CASE WHEN new > 0 THEN 1 ELSE 0 END AS cnt_new, CASE WHEN late_renewal > 0 THEN 1 ELSE 0 END AS cnt_late_renewal, CASE WHEN resurrected > 0 THEN 1 ELSE 0 END AS cnt_resurrected, CASE WHEN contracted < 0 THEN 1 ELSE 0 END AS cnt_contracted,
   CASE WHEN expanded > 0 THEN 1 ELSE 0 END AS cnt_expanded, CASE WHEN expire < 0 THEN -1 ELSE 0 END AS cnt_expired, CASE WHEN arr_renewed > 0 THEN 1 ELSE 0 END AS cnt_renewed, CASE WHEN churned < 0 THEN -1 ELSE 0 END AS cnt_churned
  FROM (SELECT *, -previous_expire AS late_renewal, CASE WHEN gross_late_renewal > 0 AND gross_late_renewal + previous_expire < 0 THEN gross_late_renewal + previous_expire WHEN arr_delta - new < 0 AND acct_end_arr <> 0 THEN arr_delta - new - resurrected ELSE 0 END AS contracted, CASE WHEN arr_delta - new < 0 AND acct_end_arr = 0 THEN arr_delta - new - resurrected ELSE 0 END AS churned,
    CASE WHEN gross_late_renewal > 0 AND gross_late_renewal + previous_expire > 0 THEN gross_late_renewal + previous_expire WHEN arr_delta - new + previous_expire > 0 THEN arr_delta - new - resurrected + previous_expire ELSE 0 END AS expanded
   FROM (SELECT * EXCLUDE (lg), CASE WHEN gross_late_renewal > 0 THEN coalesce(lg, 0) ELSE 0 END AS previous_expire
    FROM (SELECT *, CASE WHEN back AND closing_delay <= 90 THEN arr_delta - new ELSE 0 END AS gross_late_renewal, CASE WHEN back AND closing_delay > 90 THEN arr_delta - new ELSE 0 END AS resurrected
     FROM (SELECT *, arr_delta - new > 0 AND acct_beg_arr = 0 AND expire = 0 AS back FROM (SELECT *, acct_end_arr - arr_delta AS acct_beg_arr, CAST(close_day - license_beg AS INTEGER) AS closing_delay
      FROM (SELECT *, sum(arr_delta) OVER (PARTITION BY account_id ORDER BY license_beg, close_day, report_mo)::BIGINT AS acct_end_arr, lag(arr_delta) OVER (PARTITION BY account_id ORDER BY report_mo) AS lg
       FROM (SELECT report_month AS report_mo, account_id, max(fiscal_year) AS fiscal_yr, max(fiscal_quarter) AS fiscal_qtr, max(report_date) AS report_day, max(closing_date) AS close_day, min(parent_id) AS parent_id, max(license_start_date) AS license_beg, max(license_end_date) AS license_end, sum(billing_amt)::BIGINT AS tcv, sum(opportunity_arr)::BIGINT AS arr, sum(expire_arr)::BIGINT AS expire,
         sum(renew_arr)::BIGINT AS arr_renewed, sum(arr_change)::BIGINT AS arr_delta, sum(new_arr)::BIGINT AS new, last_day(min(account_start)) AS cohort_month FROM transactions WHERE report_month <= DATE '{AS_OF}' GROUP BY 1, 2))))))))) WINDOW g AS (ORDER BY report_mo, report_day, account_id)"""
s.define("reporting", _REPORTING, "transactions")


def reporting(t):
    return plan.arr_reporting(mart(transactions(t), "transactions"), AS_OF)


@query("j82_arr_reporting", s.with_("reporting") + "SELECT * EXCLUDE (back) FROM reporting")
def _(t):
    return reporting(t)


_FLOW_SQL = ", ".join(f"coalesce(sum({c}), 0)::BIGINT AS {n}" for c, n in plan.FLOWS.items())
s.define("vintages", f"""
SELECT *, sum(arr_delta) OVER w::BIGINT AS arr_os, sum(cnt_delta) OVER w::BIGINT AS active_cnt FROM (SELECT k.bin_avg_arr, k.cohort_yr, k.account_id, k.cohort_month, m.report_mo, m.fiscal_yr, {_FLOW_SQL}
 FROM (SELECT DISTINCT bin_avg_arr, cohort_fiscal_yr AS cohort_yr, account_id, cohort_month FROM reporting) k JOIN (SELECT report_mo, max(fiscal_yr) AS fiscal_yr FROM reporting GROUP BY 1) m ON m.report_mo >= k.cohort_month
 LEFT JOIN reporting r ON r.report_mo = m.report_mo AND r.bin_avg_arr = k.bin_avg_arr AND r.cohort_fiscal_yr = k.cohort_yr AND r.account_id = k.account_id GROUP BY ALL) WINDOW w AS (PARTITION BY cohort_yr, account_id ORDER BY report_mo)""", "reporting")


def vintages(t):
    return plan.arr_vintages(mart(reporting(t), "reporting"))


@query("j83_arr_vintages", s.with_("vintages") + """
SELECT * EXCLUDE (fiscal_yr), fiscal_yr, first_value(arr_os) OVER a AS first_arr, first_value(active_cnt) OVER a AS first_cnt, CAST(CASE WHEN month(cohort_month) = 1 THEN 12 ELSE month(cohort_month) - 1 END AS INTEGER) AS order_by_month, CAST(date_diff('month', cohort_month, report_mo) AS INTEGER) AS month_since_purchase,
 CASE WHEN date_diff('month', cohort_month, report_mo) = 0 THEN active_cnt ELSE 0 END AS initial_cohort_size, CAST(date_diff('quarter', cohort_month, report_mo) AS INTEGER) AS cohort_qtr_no, CAST(greatest(year(fiscal_yr) - year(cohort_yr), 0) AS INTEGER) AS fiscal_yearno, CASE WHEN month(report_mo) IN (4, 7, 10, 1) THEN 1 ELSE 0 END AS quarter_end
FROM vintages WINDOW a AS (PARTITION BY account_id ORDER BY report_mo ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def _(t):
    return vintages(t)


def _half(x: str, d: int = 0) -> str:
    k = f"{10 ** d}.0::DOUBLE"
    return f"(sign({x}) * floor(abs({x}) * {k} + 0.5) / {k})"


def _div(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE ({a})::DOUBLE / {b} END"


@query("j84_cohort_ltv", s.with_("vintages") + f"""
, v AS (SELECT bin_avg_arr, cohort_yr, report_mo, arr_os, active_cnt FROM vintages WHERE cohort_yr > DATE '1995-01-31' UNION ALL SELECT '0 - ALL', cohort_yr, report_mo, arr_os, active_cnt FROM vintages WHERE cohort_yr > DATE '1995-01-31'),
a AS (SELECT *, {_half(_div("end_arr", "end_customers"))} AS avg_arr FROM (SELECT bin_avg_arr, cohort_yr, CAST(date_diff('month', cohort_yr, report_mo) AS INTEGER) AS month_after, sum(arr_os)::BIGINT AS end_arr, sum(active_cnt)::BIGINT AS end_customers FROM v GROUP BY 1, 2, 3)),
x AS (SELECT a.*, {_half(_div("a.avg_arr", "b.avg_arr"), 2)} AS expand_rate, {_half(_div("a.end_arr", "b.end_arr"), 2)} AS ndr_pcnt, {_half(_div("a.end_customers", "b.end_customers"), 2)} AS cust_retention FROM a LEFT JOIN a b ON b.month_after = 0 AND b.bin_avg_arr = a.bin_avg_arr AND b.cohort_yr = a.cohort_yr WHERE a.month_after IN (0, 12, 24, 36, 48, 60, 72, 84)),
y AS (SELECT *, {_half(f"({_div('end_arr', 'end_customers')}) * cust_retention")} AS retained_ltv_arr FROM x), z AS (SELECT *, {_half("retained_ltv_arr * 0.97::DOUBLE")} AS cmargin_ltv_cashflow FROM y)
SELECT *, sum(cmargin_ltv_cashflow) OVER (PARTITION BY bin_avg_arr, cohort_yr ORDER BY month_after) AS cum_ltv FROM z""")
def _(t):
    return plan.cohort_ltv(mart(vintages(t), "vintages"), "1995-01-31")


# ---------------------------------------------------------------- billing, pipeline and targets


@query("j85_billing_fact", s.with_("transactions") + f"""
, i AS (SELECT 'i' || o_orderkey AS invoice_id, year(o_orderdate) * 12 + month(o_orderdate) AS period_no, o_orderdate::DATE AS invoice_date, CASE o_orderpriority WHEN '1-URGENT' THEN 'CSV' WHEN '2-HIGH' THEN 'Online' END AS source, o_totalprice * (1 + o_custkey % 3) AS usd_amount, o_custkey, 'o' || o_orderkey AS opportunity_id FROM orders WHERE o_orderstatus <> 'P'),
p AS (SELECT DISTINCT year(o_orderdate) * 12 + month(o_orderdate) AS period_no, strftime(o_orderdate, '%Y-%m') AS period_name, last_day(o_orderdate) AS report_month FROM orders), d AS (SELECT DISTINCT opportunity_id, account_id, parent_id FROM transactions WHERE opportunity_id IS NOT NULL)
SELECT invoice_id, period_name, report_month, {_WEEK.format(d='invoice_date')} AS report_week, {_FQ.format(d='report_month')} AS fiscal_quarter, {_FY.format(d='report_month')} AS fiscal_year, CASE WHEN source IS NULL OR source = 'CSV' THEN 'SalesServe' ELSE source END AS product, usd_amount, 'Firm' || (o_custkey % 30) AS domain, c_name AS company_name,
 i.opportunity_id, account_id, parent_id, invoice_date FROM i JOIN p USING (period_no) LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 LEFT JOIN d ON d.opportunity_id = i.opportunity_id WHERE report_month > DATE '1996-01-31'""")
def _(t):
    day, c = F.to_date("o_orderdate"), F.col("o_custkey")
    period = F.year(day) * 12 + F.month(day)
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "CSV").when(F.col("o_orderpriority") == "2-HIGH", "Online")
    invoices = t.orders.select(
        F.concat(F.lit("i"), "o_orderkey").alias("invoice_id"), period.alias("period_no"), day.alias("invoice_date"), source.alias("source"), F.col("o_totalprice").alias("amount"),
        (1 + c % 3).alias("fx_rate"), c.alias("customer_id"), F.concat(F.lit("x@firm"), c % 30, F.lit(".com")).alias("email"), F.concat(F.lit("o"), "o_orderkey").alias("opportunity_id"),
        (F.col("o_orderstatus") == "P").alias("is_void"),
    )
    periods = t.orders.select(period.alias("period_no"), F.date_format(day, "yyyy-MM").alias("period_name"), F.last_day(day).alias("end_date")).distinct()
    customers = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("company_name"))
    return plan.billing_fact(invoices, periods, customers, mart(transactions(t), "transactions").where(F.col("opportunity_id").isNotNull()), "1996-01-31")


@query("j86_funnel_opportunity", s.with_("licence_deals", "deal_accounts") + f"""
, a AS (SELECT account_id, coalesce(parent_id, account_id) AS parent_id, coalesce(tier, max(tier) OVER (PARTITION BY parent_id)) AS sibling_tier, tier, parent_id IS NULL AS top FROM deal_accounts),
x AS (SELECT d.*, {_half("(license_end - license_start) / 10")} * 10 / 30 AS term_mos, ['Closed', 'BestCase', 'Forecast', 'Pipeline', 'Omitted'][CAST(o_orderkey % 5 + 1 AS INTEGER)] AS forecast_category, o_orderkey % 101 AS probability, CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 END AS new_arr FROM licence_deals d WHERE type <> 'Monthly Billing' AND close_date > DATE '{AS_OF}' - INTERVAL 24 MONTH AND close_date <= DATE '{AS_OF}' + INTERVAL 6 MONTH),
y AS (SELECT *, CASE WHEN type = 'New Subscription' THEN coalesce(new_arr, 0)::DOUBLE ELSE {_half("amount / term_mos * 12", 2)} END AS arr FROM x)
SELECT opportunity_id, y.account_id, a.parent_id, CASE WHEN top THEN tier ELSE sibling_tier END AS customer_tier, close_date, last_day(close_date) AS close_month, date_trunc('week', close_date)::DATE AS close_week_beg, {_WEEK.format(d='close_date')} AS close_week_end, forecast_category,
 CASE forecast_category WHEN 'Closed' THEN 1 WHEN 'BestCase' THEN 2 WHEN 'Forecast' THEN 3 WHEN 'Pipeline' THEN 4 ELSE 5 END AS category_order, term_mos, amount AS booking, arr, {_half("probability * arr / 100", 2)} AS prob_weight_arr, CASE type WHEN 'New Subscription' THEN 'New' WHEN 'Account Expansion' THEN 'Expansion' WHEN 'Renewal' THEN 'Renewal' ELSE 'Undeclared' END AS deal_type
FROM y LEFT JOIN a ON a.account_id = y.account_id""")
def _(t):
    key = F.col("o_orderkey")
    names = F.array(*[F.lit(x) for x in ("Closed", "BestCase", "Forecast", "Pipeline", "Omitted")])
    deals = licence_deals(t).withColumns({"forecast_category": F.get(names, (key % 5).cast("int")), "probability": key % 101})
    won = licence_deals(t).where("is_won").select("opportunity_id", (key * 10).alias("new_arr"))
    return plan.funnel_opportunity(deals, deal_accounts(t), won, AS_OF)


@query("j89_target_vs_actual", f"""
WITH t AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) + 20 AS leads, count(*) FILTER (o_orderstatus = 'F') * 100 AS arr FROM orders GROUP BY 1), a AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS leads, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS arr FROM orders WHERE o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '2000-06-19' GROUP BY 1),
x AS (SELECT t.month, t.leads AS leads_target, t.arr AS arr_target, a.leads AS leads_actual, a.arr AS arr_actual, CAST(day(last_day(t.month)) AS INTEGER) AS n, CAST(CASE WHEN t.month = DATE '2000-06-01' THEN 18 WHEN last_day(t.month) < DATE '2000-06-19' THEN day(last_day(t.month)) ELSE 0 END AS INTEGER) AS done FROM t LEFT JOIN a USING (month))
SELECT month, n AS days_in_period, done AS days_completed_in_period, n - done AS days_left_in_period, done / n AS percent_completed,
 {", ".join(f"{m}_target, {_half(f'{m}_target * (done / n)')} AS {m}_target_prorated, {m}_actual, {_half(f'{m}_actual::DOUBLE / nullif(done, 0) * n')} AS {m}_projected, {m}_actual::DOUBLE / nullif({_half(f'{m}_target * (done / n)')}, 0) AS {m}_tva_prorated, {m}_actual::DOUBLE / nullif({m}_target, 0) AS {m}_tva_actual" for m in ("leads", "arr"))} FROM x""")
def _(t):
    month = F.trunc("o_orderdate", "month").alias("month")
    targets = t.orders.groupBy(month).agg((F.count("*") + 20).alias("leads"), (F.count_if(F.col("o_orderstatus") == "F") * 100).alias("arr"))
    open_deals = t.orders.where((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < s.ts("2000-06-19 00:00:00")))
    actuals = open_deals.groupBy(month).agg(F.count("*").alias("leads"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("arr"))
    return plan.target_vs_actual(targets, actuals, "2000-06-19", ["leads", "arr"])


_QTR = "(CASE WHEN month({d}) = 1 THEN year({d}) ELSE year({d}) + 1 END) || '-Q' || CASE WHEN month({d}) = 1 THEN 4 ELSE (month({d}) - 2) // 3 + 1 END"


@query("j89_target_vs_actual_by_quarter", s.with_("licence_deals") + f"""
, t AS (SELECT {_QTR.format(d='close_date')} AS qtr, (count(*) * 50000.0)::DOUBLE AS target FROM licence_deals GROUP BY 1), a AS (SELECT {_QTR.format(d='close_date')} AS qtr, sum(CAST(amount AS DECIMAL(18,2)))::DOUBLE AS a FROM licence_deals WHERE is_won AND type IN ('New Subscription', 'Account Expansion') GROUP BY 1)
SELECT qtr, target, coalesce(a, 0) AS actual, coalesce(a, 0) / target AS tva FROM t LEFT JOIN a USING (qtr)""")
def _(t):
    from ..functions import dates

    deals = licence_deals(t)
    qtr = F.concat(dates.fiscal_year("close_date"), F.lit("-Q"), dates.fiscal_quarter("close_date")).alias("qtr")
    targets = deals.groupBy(qtr).agg((F.count("*") * 50000.0).alias("target"))
    return plan.target_vs_actual_by_quarter(targets, deals, ["New Subscription", "Account Expansion"])


def _sum(test: str, c: str) -> str:
    return f"sum(CASE WHEN {test} THEN CAST({c} AS DECIMAL(18,2)) ELSE 0 END)::DOUBLE"


_SCRUB = ", ".join(
    [f"{_sum(st, c)} AS {n}_open_max, sum(CASE WHEN {st} THEN CAST({c} AS DECIMAL(18,2)) * probability ELSE 0 END)::DOUBLE / 100 AS {n}_open_weighted, " + ", ".join(f"{_sum(f'''category = '{l}' ''', c)} AS {n}_{x}_max" for l, x in plan.FORECAST.items())
     for c, n, st in (("net_new", "nn", "status = 'Open'"), ("renewal", "ren", "status <> 'Open'"))]
)


@query("j90_forecast_scrub", s.with_("licence_deals") + f"""
, d AS (SELECT close_date, CASE o_orderstatus WHEN 'F' THEN 'Won' WHEN 'O' THEN 'Open' ELSE 'Lost' END AS status, ['Commit', 'Best Case', 'Pipeline', 'Omitted'][CAST(o_orderkey % 4 + 1 AS INTEGER)] AS category, CAST(o_orderkey % 5 * 25 AS INTEGER) AS probability, amount AS net_new, amount * 2 AS renewal, license_end, o_orderkey, o_orderpriority AS segment FROM licence_deals),
m AS (SELECT {_QTR.format(d='close_date')} AS qtr, segment, {_SCRUB} FROM d WHERE CASE WHEN month(close_date) = 1 THEN year(close_date) ELSE year(close_date) + 1 END = 2000 GROUP BY 1, 2),
r AS (SELECT {_QTR.format(d='license_end')} AS qtr, segment, sum(CAST(net_new AS DECIMAL(18,2)))::DOUBLE AS ren_available, {_sum("license_end < DATE '2000-06-30'", "net_new")} AS ren_available_qtd, {_sum("status = 'Won'", "renewal")} AS ren_won, {_sum("status = 'Won' AND license_end < DATE '2000-06-30'", "renewal")} AS ren_won_qtd FROM d GROUP BY 1, 2),
f AS (SELECT {_QTR.format(d='close_date')} AS qtr, segment, count(*) AS commit_netnew FROM d GROUP BY 1, 2)
SELECT f.*, m.* EXCLUDE (qtr, segment), r.* EXCLUDE (qtr, segment), ren_won / nullif(ren_available, 0) AS ren_won_perc, ren_won_qtd / nullif(ren_available_qtd, 0) AS ren_won_qtd_perc FROM f LEFT JOIN m USING (qtr, segment) LEFT JOIN r USING (qtr, segment)""")
def _(t):
    from ..functions import dates

    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "Won").when(F.col("o_orderstatus") == "O", "Open").otherwise("Lost")
    d = licence_deals(t).select(
        "close_date", status.alias("status"), F.get(F.array(*[F.lit(x) for x in plan.FORECAST]), (key % 4).cast("int")).alias("category"), (key % 5 * 25).cast("int").alias("probability"),
        F.col("amount").alias("net_new"), (F.col("amount") * 2).alias("renewal"), "license_end", F.col("o_orderpriority").alias("segment"),
    )
    qtr = F.concat(dates.fiscal_year("close_date"), F.lit("-Q"), dates.fiscal_quarter("close_date")).alias("qtr")
    forecast = d.groupBy(qtr, "segment").agg(F.count("*").alias("commit_netnew"))
    renewals = d.select(F.col("license_end").alias("renewal_date"), "status", F.col("net_new").alias("available"), F.col("renewal").alias("won_gross"), "segment")
    return plan.forecast_scrub(d, forecast, renewals, 2000, AS_OF, ["segment"])


@query("j91_renewal_rate", f"""
WITH a AS (SELECT 'o' || o_orderkey AS opportunity_id, 'a' || o_custkey AS account_id, o_orderdate::DATE AS renewal_start, o_totalprice AS available, CASE o_orderstatus WHEN 'F' THEN 'Won' WHEN 'O' THEN 'Open' ELSE 'Lost' END AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS cap FROM orders), l AS (SELECT 'o' || l_orderkey AS opportunity_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY 1),
x AS (SELECT *, CASE WHEN status = 'Won' THEN coalesce(s, 0) ELSE 0 END AS won, CASE WHEN status = 'Open' THEN coalesce(s, 0) ELSE 0 END AS op, CASE WHEN status = 'Lost' THEN coalesce(s, 0) ELSE 0 END AS lost FROM a LEFT JOIN l USING (opportunity_id))
SELECT opportunity_id, account_id, renewal_start - 1 AS renewal_date, available AS available_renewal, won::DOUBLE AS won_renewal_net_total, op::DOUBLE AS open_renewal_net_total, lost::DOUBLE AS lost_renewal_net_total, least(won, cap)::DOUBLE AS won_renewal_gross_total, least(op, cap)::DOUBLE AS open_renewal_gross_total, CASE WHEN status = 'Lost' THEN available ELSE 0 END AS lost_renewal_gross_total,
 {_half("least(won, cap)::DOUBLE / available", 4)} AS renewal_rate, {_half("least(won + op, cap)::DOUBLE / available", 4)} AS max_renewal_rate FROM x""")
def _(t):
    status = F.when(F.col("o_orderstatus") == "F", "Won").when(F.col("o_orderstatus") == "O", "Open").otherwise("Lost")
    key = F.concat(F.lit("o"), "o_orderkey").alias("opportunity_id")
    available = t.orders.select(key, F.concat(F.lit("a"), "o_custkey").alias("account_id"), F.to_date("o_orderdate").alias("renewal_start"), F.col("o_totalprice").alias("available"))
    lines = t.lineitem.select(F.concat(F.lit("o"), "l_orderkey").alias("opportunity_id"), F.col("l_extendedprice").alias("renewal_amount"))
    return plan.renewal_rate(available, t.orders.select(key, status.alias("status")), lines)


@query("j96_ending_arr", s.with_("annual", "nation_deals") + """
, e AS (SELECT a.opportunity_id, renewed_by, sum(won_arr)::BIGINT AS ending_arr FROM annual a JOIN (SELECT opportunity_id, max(end_date) AS e FROM annual GROUP BY 1) m USING (opportunity_id) JOIN nation_deals d USING (opportunity_id) WHERE is_won AND e BETWEEN start_date AND end_date GROUP BY ALL)
SELECT e.opportunity_id, e.ending_arr, coalesce(sum(o.ending_arr), 0)::BIGINT AS original_opportunity_ending_arr FROM e LEFT JOIN e o ON o.renewed_by = e.opportunity_id GROUP BY 1, 2""")
def _(t):
    rows = mart(annual(t), "annual")
    return plan.ending_arr(plan.opportunity_arr_steps(rows, nation_accounts(t)), rows, nation_deals(t))


@query("j97_current_customers", s.with_("licence_deals", "deal_accounts") + f"""
SELECT opportunity_id, account_id, account_name, license_start AS license_starts_at, license_end AS license_ends_at, amount AS ending_arr, (sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY account_id))::DOUBLE AS total_ending_arr FROM licence_deals JOIN deal_accounts USING (account_id) WHERE is_won AND license_end >= DATE '{AS_OF}' AND type <> 'Monthly Billing'""")
def _(t):
    deals = licence_deals(t).withColumn("ending_arr", F.when(F.col("type") != "Monthly Billing", F.col("amount")))
    return plan.current_customers(deals, deal_accounts(t), AS_OF)


@query("j100_metering_cost", f"""
WITH u AS (SELECT user_id AS warehouse_id, ts AS start_time, ts + INTERVAL 90 MINUTE AS end_time, value AS credits_used FROM events), r AS (SELECT ts::DATE AS contract_date, max(value) AS rate FROM events WHERE event_type = 'purchase' GROUP BY 1),
i AS (SELECT *, coalesce(lead(contract_date) OVER (ORDER BY contract_date) - 1, DATE '2024-12-31')::DATE AS e FROM r)
SELECT warehouse_id, start_time, end_time, date_trunc('month', end_time)::DATE AS usage_month, end_time::DATE AS usage_day, date_diff('hour', start_time, end_time) AS usage_length, rate AS credit_rate, {_half("credits_used * rate", 2)} AS dollars_spent FROM u LEFT JOIN i ON end_time::DATE BETWEEN contract_date AND e""")
def _(t):
    usage = t.events.select(F.col("user_id").alias("warehouse_id"), F.col("ts").alias("start_time"), (F.col("ts") + F.expr("interval 90 minutes")).alias("end_time"), F.col("value").alias("credits_used"))
    rates = t.events.where(F.col("event_type") == "purchase").groupBy(F.to_date("ts").alias("contract_date")).agg(F.max("value").alias("rate"))
    return plan.metering_cost(usage, rates, "2024-12-31")
