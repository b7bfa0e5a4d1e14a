"""Recurring revenue: daily values, movements, transactions, cohorts, forecasts and costs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import dates
from ..functions.arith import band, div0, half_up, money
from ..functions.rules import first_match
from ..operators import joins, merge, windows
from ..session import materialize


def _today(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def crosses_leap_day(start: str, end: str) -> Column:
    """1 if a 29 February lies in the period, from calendar arithmetic alone."""
    def leap_days(d: Column) -> Column:
        y = F.year(d) - F.when(F.month(d) < 3, 1).otherwise(0)
        on = F.when((F.month(d) == 2) & (F.dayofmonth(d) == 29), 1).otherwise(0)
        return F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400) + on

    return F.when(leap_days(F.col(end)) > leap_days(F.date_sub(start, 1)), 1).otherwise(0)


def annualised_lines(lines: DataFrame, deals: DataFrame) -> DataFrame:
    """Recurring contract lines with their yearly value, split into won, lost and open.

    The value is 365 x price / days, the days without a leap day, rounded to whole units.
    """
    days = F.datediff("end_date", "start_date") + 1 - crosses_leap_day("start_date", "end_date")
    rows = lines.where((F.col("product_type") == "Recurring") & (F.col("end_date") != F.col("start_date"))).withColumn("_days", days).where(F.col("_days") != 0)
    value = half_up(F.col("total_price").cast("double") * 365 / F.col("_days")).cast("bigint")
    # As many tasks as shuffles have, not as few as the bytes allow: marks and steps of a deal are built in the task that holds its lines.
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    state = rows.repartition(tasks, "opportunity_id").join(deals.select("opportunity_id", "account_id", "is_won", "is_closed"), "opportunity_id")
    pick = lambda test, n: F.when(test, F.col("_arr")).otherwise(0).alias(n)
    return state.withColumn("_arr", value).select(
        "line_id", "opportunity_id", "account_id", "start_date", "end_date", pick(F.col("is_won"), "won_arr"),
        pick(F.col("is_closed") & ~F.col("is_won"), "lost_arr"), pick(~F.col("is_closed"), "open_arr"),
    )


MEASURES = ["won_arr", "lost_arr", "open_arr"]


def line_daily_arr(annual: DataFrame) -> DataFrame:
    """One row per contract line and day in force."""
    return joins.dense_days(annual, "start_date", "end_date", "day").select("line_id", "opportunity_id", "day", *MEASURES)


def opportunity_arr_steps(annual: DataFrame, accounts: DataFrame) -> DataFrame:
    """Value per deal as date steps, with the master account."""
    steps = joins.interval_sums(annual, ["account_id", "opportunity_id"], "start_date", "end_date", MEASURES)
    parents = accounts.select("account_id", F.coalesce("parent_id", "account_id").alias("master_account_id"))
    return steps.join(parents, "account_id").drop("_open")


def account_daily_arr(steps: DataFrame) -> DataFrame:
    """Won value per account and day, for days with at least one deal of non-zero value."""
    used = steps.where(F.col("won_arr") != 0)
    total = joins.interval_sums(used, ["account_id", "master_account_id"], "from_day", "to_day", ["won_arr"])
    return joins.dense_days(total, "from_day", "to_day", "day").select("account_id", "master_account_id", "day", F.col("won_arr").alias("total_arr"))


def account_arr_and_seats(lines: DataFrame, deals: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Value and licensed seats in force on a day, never below zero."""
    today = _today(as_of)
    live = lines.where(today.between(F.col("start_date"), F.col("end_date"))).join(deals.where("is_won").select("opportunity_id", "account_id"), "opportunity_id")
    days = F.datediff("end_date", "start_date") + 1 - crosses_leap_day("start_date", "end_date")
    value = F.when(F.col("end_date") != F.col("start_date"), half_up(F.col("total_price").cast("double") * 365 / days, 2).cast("decimal(18,2)"))
    seats = F.when(F.col("product_type") == "Recurring", F.col("quantity")).otherwise(0)
    per = live.groupBy("account_id").agg(F.sum(value).alias("_arr"), F.sum(seats).alias("_seats"))
    return accounts.select("account_id").join(per, "account_id", "left").select(
        "account_id", F.greatest(F.coalesce(F.col("_arr").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("total_arr"),
        F.greatest(F.coalesce("_seats", F.lit(0)), F.lit(0)).alias("seats"),
    )


def customer_type_sync(accounts: DataFrame, current: DataFrame) -> DataFrame:
    """Accounts whose value, seats or customer type differ from the CRM's record.

    ``accounts``: account_id, parent_id, type, arr, seats; a customer has value or seats, own or of a child.
    """
    kids = accounts.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("account_id")).agg(
        F.sum(money(F.coalesce("arr", F.lit(0)))).alias("_child_arr"), F.sum(F.coalesce("seats", F.lit(0))).alias("_child_seats")
    )
    x = accounts.join(kids, "account_id", "left").join(current.withColumnsRenamed({"total_arr": "_new_arr", "seats": "_new_seats"}), "account_id", "left")
    some = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(0)) > 0 for c in ("arr", "_child_arr", "seats", "_child_seats")])
    kind = F.when(~F.col("type").isin("Vendor", "Partner") & some, "Customer").when(F.col("type") == "Customer", "Customer (Attrited)").otherwise(F.col("type"))
    desired = x.select("account_id", half_up("_new_arr", 2).alias("arr"), F.col("_new_seats").alias("seats"), kind.alias("type"))
    held = accounts.select("account_id", half_up("arr", 2).alias("arr"), "seats", "type")
    return merge.sync_diff(desired, held, ["account_id"], ["arr", "seats", "type"])


def account_daily_deltas(daily: DataFrame, lines: DataFrame, deals: DataFrame, accounts: DataFrame) -> DataFrame:
    """Value, previous day's value and change per account and day of its won contracts (one day before to two after)."""
    won = lines.join(deals.where("is_won").select("opportunity_id", "account_id"), "opportunity_id")
    span = won.groupBy("account_id").agg(F.date_sub(F.min("start_date"), 1).alias("_a"), F.date_add(F.max("end_date"), 2).alias("_b"))
    parents = accounts.select("account_id", F.coalesce("parent_id", "account_id").alias("master_account_id"))
    days = joins.dense_days(span.join(parents, "account_id"), "_a", "_b", "new_day").select("account_id", "master_account_id", "new_day")
    values = daily.select("account_id", F.col("day").alias("new_day"), "total_arr")
    w = windows.window(["account_id"], "new_day")
    x = days.join(values, ["account_id", "new_day"], "left")
    first = F.min(F.when(F.col("total_arr").isNotNull(), F.col("new_day"))).over(windows.whole(["account_id"], "new_day"))
    x = x.withColumns({"_previous": F.coalesce(F.lag("total_arr").over(w), F.lit(0)), "account_new_arr": F.coalesce((F.col("new_day") == first) & F.col("total_arr").isNotNull(), F.lit(False))})
    before = F.when(F.col("account_new_arr"), 0).otherwise(F.col("_previous"))
    now = F.coalesce("total_arr", F.lit(0))
    return x.select(
        "new_day", F.date_sub("new_day", 1).alias("previous_day"), "master_account_id", "account_id", "account_new_arr", (F.dayofmonth("new_day") == 1).alias("month_start"),
        (F.col("new_day") == F.last_day("new_day")).alias("month_end"), now.alias("new_day_total_arr"), before.alias("previous_day_total_arr"), (now - before).alias("total_arr_delta"),
    )


def monthly_deltas(daily: DataFrame) -> DataFrame:
    on = lambda flag, c: F.max(F.when(F.col(flag), F.col(c)).otherwise(0))
    return daily.groupBy(F.trunc("new_day", "month").alias("month_start"), F.last_day("new_day").alias("month_end"), "master_account_id", "account_id").agg(
        F.bool_or("account_new_arr").alias("account_new_arr"), on("month_start", "previous_day_total_arr").alias("month_starting_arr"),
        on("month_end", "new_day_total_arr").alias("month_ending_arr"), F.sum("total_arr_delta").alias("total_arr_delta"),
    )


def monthly_deltas_by_type(monthly: DataFrame) -> DataFrame:
    """Movement of each account-month: new, expansion, resurrection, contraction or churn."""
    new, begin, end, change = (F.col(c) for c in ("account_new_arr", "month_starting_arr", "month_ending_arr", "total_arr_delta"))
    kinds = {
        "new": new, "expansion": ~new & (begin != 0) & (change > 0), "resurrection": ~new & (begin == 0) & (change > 0),
        "contraction": (change < 0) & (end != 0), "churn": (change < 0) & (end == 0),
    }
    label = first_match([(test, f"{n.title()} ARR") for n, test in kinds.items()])
    return monthly.where(change != 0).groupBy("month_start", "month_end", "account_id", "master_account_id", label.alias("arr_type")).agg(
        *[F.sum(F.when(test, change).otherwise(0)).alias(f"total_arr_{n}") for n, test in kinds.items()], F.sum(change).alias("total_arr_delta")
    )


# ---------------------------------------------------------------- transactions


def _month_rank(rows: DataFrame, day: str, name: str) -> DataFrame:
    """Rank of a row's month within its account and year: rows of earlier months plus one, from monthly counts."""
    year, month = F.year(day), F.trunc(day, "month")
    counts = rows.groupBy("account_id", year.alias("_y"), month.alias("_m")).agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(windows.window(["account_id", "_y"], "_m").rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select("account_id", "_y", "_m", (F.coalesce(before, F.lit(0)) + 1).alias(name))
    return rows.withColumns({"_y": year, "_m": month}).join(ranks, ["account_id", "_y", "_m"])


def arr_transactions(deals: DataFrame, accounts: DataFrame, as_of: str, excluded: DataFrame | None = None) -> DataFrame:
    """Life of each account's paid deals as transactions: new and expansion deals, expiries and renewals.

    An expiry and a renewal of one account, year and position within the year form one pair by key.
    ``deals``: opportunity_id, account_id, license_start, license_end, close_date, type, name, amount,
    is_won, is_closed; ``accounts``: account_id, parent_id, account_name. ``excluded`` lists deals left
    out (monthly billing).
    """
    today = _today(as_of)
    closed = deals.where("is_closed")
    paying = closed.groupBy("account_id").agg(F.sum(money(F.coalesce("amount", F.lit(0)))).alias("_paid")).where(F.col("_paid") >= 1)
    won = closed.where(F.col("is_won") & (F.col("type") != "Monthly Billing")).join(paying.select("account_id"), "account_id", "left_semi")
    if excluded is not None:
        won = won.join(excluded.select("opportunity_id"), "opportunity_id", "left_anti")
    days = F.datediff("license_end", "license_start")
    term = half_up(days / (365 / 12)).cast("int")
    bill = half_up(F.coalesce(F.col("amount").cast("double"), F.lit(2.0))).cast("bigint")
    d = won.withColumns({
        "opp_type": F.when(F.lower("name").contains("renew"), "Renewal").otherwise(F.col("type")), "term": term, "bill_amt": bill,
    }).withColumn("opportunity_arr", F.when(F.col("term") == 12, F.col("bill_amt")).otherwise(half_up(div0(F.col("bill_amt").cast("double"), days) * 365).cast("bigint")))
    d = materialize(d, "arr-deals")

    key = lambda rank: F.concat_ws("-", "_y", rank, "account_id")
    expired = _month_rank(d, "license_end", "_rank").select(
        "account_id", F.lit(None).cast("string").alias("opportunity_id"), F.lit(None).cast("date").alias("close_date"), F.date_add("license_end", 1).alias("license_start"),
        F.add_months("license_end", 12).alias("license_end"), F.lit(12).alias("term"), F.lit(False).alias("is_won"), F.lit(0).cast("bigint").alias("bill_amt"),
        F.lit(0).cast("bigint").alias("opportunity_arr"), (-F.col("opportunity_arr")).alias("expire_arr"), F.lit(0).cast("bigint").alias("renewal_arr"), key("_rank").alias("match_key"),
    ).distinct()
    renewals = _month_rank(d.where(F.col("opp_type") == "Renewal"), "license_start", "_rank").select(
        "account_id", "opportunity_id", "close_date", "license_start", "license_end", "term", "is_won", "bill_amt", "opportunity_arr", F.lit(0).cast("bigint").alias("expire_arr"),
        F.col("opportunity_arr").alias("renewal_arr"), key("_rank").alias("match_key"),
    )
    win = F.col("is_won")
    paired = expired.unionByName(renewals).groupBy("match_key", "account_id", "opportunity_id").agg(
        F.max(F.when(win, F.col("close_date"))).alias("close_date"), F.max("license_start").alias("license_start"), F.min("license_end").alias("license_end"), F.bool_or(win).alias("is_won"),
        F.max(F.when(win, "Renewal").otherwise("Expired")).alias("opp_type"), F.max(F.when(win, F.col("term")).otherwise(0)).alias("term"), F.sum("bill_amt").alias("billing_amt"),
        F.sum("opportunity_arr").alias("opportunity_arr"), F.sum("expire_arr").alias("expire_arr"), F.sum("renewal_arr").alias("renewal_arr"),
    )
    others = d.where(F.col("opp_type") != "Renewal").select(
        F.lit(None).cast("string").alias("match_key"), "account_id", "opportunity_id", "close_date", "license_start", "license_end", "is_won", "opp_type", "term",
        F.col("bill_amt").alias("billing_amt"), "opportunity_arr", F.lit(0).cast("bigint").alias("expire_arr"), F.lit(0).cast("bigint").alias("renewal_arr"),
    )
    master = paired.unionByName(others).withColumn("closing_date", F.coalesce("close_date", "license_start"))
    master = materialize(master, "arr-master")

    # Transaction numbers: distinct (closing date, deal) pairs ranked per account in yearly chunks.
    last = F.lit("~")
    pairs = master.select("account_id", "closing_date", F.coalesce("opportunity_id", last).alias("_o")).distinct()
    numbered = windows.chunked_scan(pairs, ["account_id"], F.year("closing_date"), ["closing_date", "_o"], row_number="trans_no")
    life = master.groupBy("account_id").agg(F.min("license_start").alias("account_start"), F.max(F.when(F.col("opp_type") != "Expired", F.col("license_end"))).alias("max_license"))
    x = master.withColumn("_o", F.coalesce("opportunity_id", last)).join(numbered, ["account_id", "closing_date", "_o"]).join(life, "account_id")
    report_date = F.greatest("closing_date", "license_start")
    x = x.withColumns({"report_date": report_date, "report_month": F.last_day(report_date)})
    change = F.when(F.col("report_month") > F.last_day(today), 0).otherwise(F.col("opportunity_arr") + F.col("expire_arr"))
    x = materialize(x.withColumn("arr_change", change), "arr-numbered")
    # Rows of one transaction number share the running total.
    per = x.groupBy("account_id", "trans_no").agg(F.sum("arr_change").alias("_c"))
    run = windows.chunked_scan(per, ["account_id"], F.floor(F.col("trans_no") / 1000), ["trans_no"], sums={"ending_arr": F.col("_c")}).select("account_id", "trans_no", "ending_arr")
    parents = accounts.select("account_id", F.coalesce("parent_id", "account_id").alias("parent_id"), "account_name")
    x = x.join(run, ["account_id", "trans_no"]).join(parents, "account_id", "left")
    first = F.col("trans_no") == 1
    active = (F.col("opp_type") != "Expired") & (F.col("license_end") >= F.last_day(today)) & (F.col("license_start") <= F.last_day(today))
    yearly = F.when(F.col("term") <= 12, F.col("billing_amt").cast("double")).otherwise(half_up(div0(F.col("billing_amt").cast("double"), F.col("term")) * 12, 2))
    return x.select(
        F.concat_ws("-", "account_id", "trans_no").alias("unique_key"), "account_name", "parent_id", "account_id", "opportunity_id", "match_key",
        dates.fiscal_year_end("report_month").alias("fiscal_year"), dates.fiscal_quarter_end("report_month").alias("fiscal_quarter"), "report_month", "report_date",
        dates.week_end("report_date").alias("report_week"), F.last_day("closing_date").alias("closing_month"), dates.week_end("closing_date").alias("closing_week"),
        dates.fiscal_quarter_end("closing_date").alias("closing_fiscal_quarter"), dates.fiscal_year_end("closing_date").alias("closing_fiscal_year"), "closing_date",
        F.col("license_start").alias("license_start_date"), F.col("license_end").alias("license_end_date"), "account_start", "max_license", "trans_no", "opp_type",
        F.col("term").alias("term_months"), "billing_amt", yearly.alias("first_yr_bill"), "opportunity_arr", "expire_arr", F.when(first, 0).otherwise(F.col("renewal_arr")).alias("renew_arr"),
        "arr_change", "ending_arr", F.when(first, F.col("opportunity_arr")).otherwise(0).alias("new_arr"),
        F.when(active & F.col("is_won") & (F.col("report_month") <= F.last_day(today)), F.col("opportunity_arr")).otherwise(0).alias("active_arr"),
        dates.years_crossed("account_start", "license_start").alias("beg_tenure_yr"), dates.years_crossed("account_start", "license_end").alias("end_tenure_yr"), "is_won",
    )


VALUE_BINS = [(10000.5, "4_AvgARR_upto10K"), (100000.5, "3_AvgARR_10Kupto100K"), (500000.5, "2_AvgARR_100Kupto500K")]


def arr_reporting(transactions: DataFrame, as_of: str) -> DataFrame:
    """Movements per account and report month: new, late renewal, resurrected, expanded, contracted, churned, renewed."""
    t = transactions.where(F.col("report_month") <= F.last_day(_today(as_of)))
    a = t.groupBy(F.col("report_month").alias("report_mo"), "account_id").agg(
        F.max("fiscal_year").alias("fiscal_yr"), F.max("fiscal_quarter").alias("fiscal_qtr"), F.max("report_date").alias("report_day"), F.max("closing_date").alias("close_day"),
        F.min("parent_id").alias("parent_id"), F.max("license_start_date").alias("license_beg"), F.max("license_end_date").alias("license_end"), F.sum("billing_amt").alias("tcv"),
        F.sum("opportunity_arr").alias("arr"), F.sum("expire_arr").alias("expire"), F.sum("renew_arr").alias("arr_renewed"), F.sum("arr_change").alias("arr_delta"),
        F.sum("new_arr").alias("new"), F.last_day(F.min("account_start")).alias("cohort_month"),
    )
    # One row per account and month: windows per account are bounded by its months.
    by_account = windows.window(["account_id"], "license_beg", "close_day", "report_mo")
    upto = by_account.rowsBetween(Window.unboundedPreceding, 0)
    a = a.withColumns({"acct_end_arr": F.sum("arr_delta").over(upto), "_lag": F.lag("arr_delta").over(windows.window(["account_id"], "report_mo"))})
    begin, end, delta, new, expire = F.col("acct_end_arr") - F.col("arr_delta"), F.col("acct_end_arr"), F.col("arr_delta"), F.col("new"), F.col("expire")
    delay = F.datediff("close_day", "license_beg")
    back = (delta - new > 0) & (begin == 0) & (expire == 0)
    a = a.withColumns({
        "acct_beg_arr": begin, "closing_delay": delay, "gross_late_renewal": F.when(back & (delay <= 90), delta - new).otherwise(0),
        "resurrected": F.when(back & (delay > 90), delta - new).otherwise(0),
    })
    gross = F.col("gross_late_renewal")
    a = a.withColumn("previous_expire", F.when(gross > 0, F.coalesce("_lag", F.lit(0))).otherwise(0))
    both, late, back_arr = gross + F.col("previous_expire"), -F.col("previous_expire"), F.col("resurrected")
    loss = delta - new < 0
    a = a.withColumns({
        "late_renewal": late, "contracted": F.when((gross > 0) & (both < 0), both).when(loss & (end != 0), delta - new - back_arr).otherwise(0),
        "churned": F.when(loss & (end == 0), delta - new - back_arr).otherwise(0),
        "expanded": F.when((gross > 0) & (both > 0), both).when(delta - new - late > 0, delta - new - back_arr - late).otherwise(0),
    })
    a = a.withColumn("renewed", F.when((F.col("arr_renewed") > 0) & (expire < 0), -(expire - F.col("churned") - F.col("contracted"))).otherwise(0))
    one = lambda test, sign=1: F.when(test, sign).otherwise(0)
    a = a.withColumns({
        "cnt_new": one(new > 0), "cnt_late_renewal": one(F.col("late_renewal") > 0), "cnt_resurrected": one(back_arr > 0), "cnt_contracted": one(F.col("contracted") < 0),
        "cnt_expanded": one(F.col("expanded") > 0), "cnt_expired": one(expire < 0, -1), "cnt_renewed": one(F.col("arr_renewed") > 0), "cnt_churned": one(F.col("churned") < 0, -1),
    })
    a = a.withColumn("cnt_changed", F.col("cnt_new") + F.col("cnt_late_renewal") + F.col("cnt_resurrected") + F.col("cnt_churned"))
    a = a.withColumn("ref_arr", F.greatest("acct_beg_arr", "acct_end_arr"))
    latest = F.last("ref_arr").over(by_account.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    a = materialize(a.withColumns({"latest_arr": latest, "trans_no": F.row_number().over(by_account)}).drop("_lag"), "arr-months")
    # Totals over all accounts run day by day; only one row per day is scanned alone.
    out = windows.chunked_scan(
        a.withColumn("_all", F.lit(1)), ["_all"], F.struct("report_mo", "report_day"), ["report_mo", "report_day", "account_id"],
        sums={"total_end_arr": F.col("arr_delta"), "active_customers": F.col("cnt_changed")},
    ).drop("_all")
    return out.withColumns({
        "total_beg_arr": F.col("total_end_arr") - F.col("arr_delta"), "bin_avg_arr": band("latest_arr", VALUE_BINS, "1_AvgARR_above500K"),
        "cohort_fiscal_qtr": dates.fiscal_quarter_end("cohort_month"), "cohort_fiscal_yr": dates.fiscal_year_end("cohort_month"),
        "fiscal_year_no": F.year("fiscal_yr") - F.year(dates.fiscal_year_end("cohort_month")), "multi_yr": F.col("tcv") - F.col("arr"),
        "net_booking": F.col("tcv") - F.col("renewed") - F.col("late_renewal"), "unique_key": F.concat_ws("-", "account_id", "report_mo"),
    })


FLOWS = {
    "new": "new", "late_renewal": "late_renew", "resurrected": "resurrect", "expanded": "expand", "contracted": "contract", "churned": "churn", "arr_delta": "arr_delta",
    "cnt_new": "cnt_new", "cnt_churned": "cnt_churned", "cnt_changed": "cnt_delta",
}


def arr_vintages(reporting: DataFrame) -> DataFrame:
    """Panel of accounts by report month from the cohort month on, with flows and running balances.

    The panel is spread per account over its months and matched with the months that occur, instead of
    comparing every account with every month.
    """
    key = ["bin_avg_arr", "cohort_yr", "account_id", "cohort_month"]
    a = reporting.withColumn("cohort_yr", F.col("cohort_fiscal_yr")).groupBy(*key, "report_mo").agg(*[F.sum(c).alias(n) for c, n in FLOWS.items()], F.max("fiscal_yr").alias("_fy"))
    months = a.groupBy("report_mo").agg(F.max("_fy").alias("fiscal_yr"))
    end = months.agg(F.max("report_mo")).first()[0]
    span = a.select(*key).distinct().where(F.col("cohort_month") <= F.lit(end)).withColumn(
        "report_mo", F.explode(F.transform(F.sequence(F.trunc("cohort_month", "month"), F.trunc(F.lit(end), "month"), F.expr("interval 1 month")), lambda d: F.last_day(d)))
    )
    panel = span.join(months, "report_mo").join(a.drop("_fy"), [*key, "report_mo"], "left").fillna(0, list(FLOWS.values()))
    w = windows.running(["cohort_yr", "account_id"], "report_mo")
    out = panel.withColumns({"arr_os": F.sum("arr_delta").over(w), "active_cnt": F.sum("cnt_delta").over(w)})
    whole = windows.whole(["account_id"], "report_mo")
    return out.withColumns({
        "first_arr": F.first("arr_os").over(whole), "first_cnt": F.first("active_cnt").over(whole), "order_by_month": dates.fiscal_month("cohort_month"),
        "month_since_purchase": dates.months_crossed("cohort_month", "report_mo"), "cohort_qtr_no": dates.quarters_crossed("cohort_month", "report_mo"),
        "fiscal_yearno": F.greatest(F.year("fiscal_yr") - F.year("cohort_yr"), F.lit(0)), "quarter_end": F.when(F.month("report_mo").isin(4, 7, 10, 1), 1).otherwise(0),
    }).withColumn("initial_cohort_size", F.when(F.col("month_since_purchase") == 0, F.col("active_cnt")).otherwise(0))


def cohort_ltv(vintages: DataFrame, after: str, margin: float = 0.97, months: Sequence[int] = (0, 12, 24, 36, 48, 60, 72, 84), where: Column | None = None) -> DataFrame:
    """Retention, expansion and cumulative lifetime value per value bin and fiscal cohort, and for all bins.

    ``where`` limits the accounts, for example to one region.
    """
    rows = vintages.where(F.col("cohort_yr") > F.lit(after).cast("date"))
    if where is not None:
        rows = rows.where(where)

    def by_bin(df: DataFrame) -> DataFrame:
        return df.groupBy("bin_avg_arr", "cohort_yr", dates.months_crossed("cohort_yr", "report_mo").alias("month_after")).agg(
            F.sum("arr_os").alias("end_arr"), F.sum("active_cnt").alias("end_customers")
        )

    a = by_bin(rows).unionByName(by_bin(rows.withColumn("bin_avg_arr", F.lit("0 - ALL")))).withColumn("avg_arr", half_up(div0(F.col("end_arr").cast("double"), "end_customers")))
    start = a.where(F.col("month_after") == 0).select(
        "bin_avg_arr", "cohort_yr", F.col("end_arr").alias("_max_arr"), F.col("avg_arr").alias("_start"), F.col("end_customers").alias("_max_customers")
    )
    x = a.where(F.col("month_after").isin(list(months))).join(start, ["bin_avg_arr", "cohort_yr"], "left")
    ratio = lambda n, m: half_up(div0(F.col(n).cast("double"), m), 2)
    x = x.withColumns({"expand_rate": ratio("avg_arr", "_start"), "ndr_pcnt": ratio("end_arr", "_max_arr"), "cust_retention": ratio("end_customers", "_max_customers")})
    x = x.withColumn("retained_ltv_arr", half_up(div0(F.col("end_arr").cast("double"), "end_customers") * F.col("cust_retention")))
    x = x.withColumn("cmargin_ltv_cashflow", half_up(F.col("retained_ltv_arr") * margin))
    w = windows.running(["bin_avg_arr", "cohort_yr"], "month_after")
    return x.withColumn("cum_ltv", F.sum("cmargin_ltv_cashflow").over(w)).drop("_max_arr", "_start", "_max_customers")


# ---------------------------------------------------------------- billing, pipeline and targets


def billing_fact(invoices: DataFrame, periods: DataFrame, customers: DataFrame, deals: DataFrame, after: str) -> DataFrame:
    """Invoices with reporting and fiscal periods, customer and deal account.

    ``invoices``: invoice_id, period_no, invoice_date, source, amount, fx_rate, customer_id, email, opportunity_id, is_void.
    """
    clean = invoices.where(~F.col("is_void"))
    domain = F.initcap(F.split_part(F.split_part("email", F.lit("@"), F.lit(2)), F.lit("."), F.lit(1)))
    product = F.when(F.col("source").isNull() | (F.col("source") == "CSV"), "SalesServe").otherwise(F.col("source"))
    x = clean.join(periods.select("period_no", "period_name", F.col("end_date").alias("report_month")), "period_no").where(F.col("report_month") > F.lit(after).cast("date"))
    x = x.join(customers.select("customer_id", "company_name"), "customer_id", "left").join(deals.select("opportunity_id", "account_id", "parent_id").distinct(), "opportunity_id", "left")
    return x.select(
        "invoice_id", "period_name", "report_month", dates.week_end("invoice_date").alias("report_week"), dates.fiscal_quarter_end("report_month").alias("fiscal_quarter"),
        dates.fiscal_year_end("report_month").alias("fiscal_year"), product.alias("product"), (F.col("amount") * F.col("fx_rate")).alias("usd_amount"), domain.alias("domain"),
        "company_name", "opportunity_id", "account_id", "parent_id", "invoice_date",
    )


CATEGORY_ORDER = ["Closed", "BestCase", "Forecast", "Pipeline"]
DEAL_TYPES = {
    "New": ["New Subscription", "New Business"], "Expansion": ["Contract Expansion", "Account Expansion", "Reduction"], "Renewal": ["Renewal"],
    "Monthly Billing": ["Monthly Billing"],
}


def funnel_opportunity(deals: DataFrame, accounts: DataFrame, transactions: DataFrame, as_of: str) -> DataFrame:
    """Deals around the day with yearly value, weighted value, ordering, calendar columns and filled account attributes.

    An account's missing tier is taken from its siblings. ``transactions``: opportunity_id, new_arr.
    """
    today = _today(as_of)
    siblings = accounts.where(F.col("parent_id").isNotNull()).groupBy("parent_id").agg(F.max("tier").alias("_sibling_tier"))
    a = accounts.join(siblings, "parent_id", "left").select("account_id", F.coalesce("parent_id", "account_id").alias("parent_id"), F.coalesce("tier", "_sibling_tier").alias("customer_tier"))
    x = deals.where(
        ~F.lower("name").contains("test") & (F.col("type") != "Monthly Billing") & (F.col("close_date") > F.add_months(today, -24)) & (F.col("close_date") <= F.add_months(today, 6))
    ).join(transactions.select("opportunity_id", "new_arr"), "opportunity_id", "left").join(a, "account_id", "left")
    term = half_up(F.datediff("license_end", "license_start") / 10) * 10 / 30
    amount = F.coalesce(F.col("amount").cast("double"), F.lit(0.0))
    is_new = F.col("type").isin(DEAL_TYPES["New"])
    arr = F.when(is_new, F.coalesce(F.col("new_arr").cast("double"), F.lit(0.0))).otherwise(half_up(div0(amount, F.coalesce(term, F.lit(12.0))) * 12, 2))
    kind = first_match([(F.col("type").isin(members), label) for label, members in DEAL_TYPES.items()], "Undeclared")
    order = first_match([(F.col("forecast_category") == c, i + 1) for i, c in enumerate(CATEGORY_ORDER)], 5)
    return x.select(
        "opportunity_id", "account_id", "parent_id", "customer_tier", "close_date", F.last_day("close_date").alias("close_month"), F.trunc("close_date", "week").alias("close_week_beg"),
        dates.week_end("close_date").alias("close_week_end"), "forecast_category", order.alias("category_order"), term.alias("term_mos"), amount.alias("booking"), arr.alias("arr"),
        half_up(F.coalesce("probability", F.lit(0)) * arr / 100, 2).alias("prob_weight_arr"), kind.alias("deal_type"),
    )


def target_vs_actual(targets: DataFrame, actuals: DataFrame, as_of: str, metrics: Sequence[str], period: str = "month") -> DataFrame:
    """Targets per month prorated by the share of days gone, actuals projected to the month's end, and their ratios.

    ``targets`` and ``actuals`` have a first-of-month ``month`` and one column per metric.
    """
    today = _today(as_of)
    month_end = F.last_day(period)
    days = F.dayofmonth(month_end)
    current = F.col(period) == F.trunc(today, "month")
    done = F.when(current, F.dayofmonth(today) - 1).when(month_end < today, days).otherwise(0)
    x = targets.join(actuals.select(period, *[F.col(m).alias(f"{m}_actual") for m in metrics]), period, "left").withColumns({
        "days_in_period": days, "days_completed_in_period": done, "days_left_in_period": days - done, "percent_completed": done / days,
    })
    out = [period, "days_in_period", "days_completed_in_period", "days_left_in_period", "percent_completed"]
    for m in metrics:
        actual = F.col(f"{m}_actual").cast("double")
        prorated = half_up(F.col(m) * F.col("percent_completed"))
        out += [
            F.col(m).alias(f"{m}_target"), prorated.alias(f"{m}_target_prorated"), f"{m}_actual",
            half_up(F.try_divide(actual, F.nullif("days_completed_in_period", F.lit(0))) * F.col("days_in_period")).alias(f"{m}_projected"),
            F.try_divide(actual, F.nullif(prorated, F.lit(0.0))).alias(f"{m}_tva_prorated"), F.try_divide(actual, F.nullif(F.col(m).cast("double"), F.lit(0.0))).alias(f"{m}_tva_actual"),
        ]
    return x.select(*out)


def target_vs_actual_by_quarter(targets: DataFrame, deals: DataFrame, types: Sequence[str]) -> DataFrame:
    """Won amount of the deal types per fiscal quarter against its target. ``targets``: qtr, target."""
    qtr = F.concat(dates.fiscal_year("close_date"), F.lit("-Q"), dates.fiscal_quarter("close_date"))
    won = deals.where(F.col("is_won") & F.col("type").isin(list(types))).groupBy(qtr.alias("qtr")).agg(F.sum(money("amount")).alias("_a"))
    return targets.join(won, "qtr", "left").select(
        "qtr", "target", F.coalesce(F.col("_a").cast("double"), F.lit(0.0)).alias("actual"), F.try_divide(F.coalesce(F.col("_a").cast("double"), F.lit(0.0)), F.col("target")).alias("tva")
    )


FORECAST = {"Commit": "commit", "Best Case": "best_case", "Pipeline": "pipeline", "Omitted": "omitted"}


def forecast_scrub(deals: DataFrame, forecast: DataFrame, renewals: DataFrame, fiscal_year: int, as_of: str, segment: Sequence[str] = ()) -> DataFrame:
    """Forecast of each fiscal quarter against open, committed and available renewal amounts.

    ``deals``: close_date, status, category, probability, net_new, renewal; ``forecast``: qtr and commitments;
    ``renewals``: renewal_date, status, available, won_gross. ``segment`` columns are added to the key.
    """
    quarter = lambda c: F.concat(dates.fiscal_year(c), F.lit("-Q"), dates.fiscal_quarter(c)).alias("qtr")
    key = ["qtr", *segment]
    total = lambda test, c: F.sum(F.when(test, money(c)).otherwise(0)).cast("double")
    weighted = lambda test, c: F.sum(F.when(test, money(c) * F.col("probability")).otherwise(0)).cast("double") / 100
    is_open = F.col("status") == "Open"
    cells = []
    for c, n, state in (("net_new", "nn", is_open), ("renewal", "ren", ~is_open)):
        cells += [total(state, c).alias(f"{n}_open_max"), weighted(state, c).alias(f"{n}_open_weighted")]
        cells += [total(F.col("category") == label, c).alias(f"{n}_{name}_max") for label, name in FORECAST.items()]
    amounts = deals.where(dates.fiscal_year("close_date") == fiscal_year).groupBy(quarter("close_date"), *segment).agg(*cells)
    past = F.col("renewal_date") < _today(as_of)
    won = F.col("status") == "Won"
    available = renewals.groupBy(quarter("renewal_date"), *segment).agg(
        F.sum(money("available")).cast("double").alias("ren_available"), total(past, "available").alias("ren_available_qtd"), total(won, "won_gross").alias("ren_won"),
        total(won & past, "won_gross").alias("ren_won_qtd"),
    )
    x = forecast.join(amounts, key, "left").join(available, key, "left")
    return x.withColumns({"ren_won_perc": F.try_divide("ren_won", F.nullif("ren_available", F.lit(0.0))), "ren_won_qtd_perc": F.try_divide("ren_won_qtd", F.nullif("ren_available_qtd", F.lit(0.0)))})


def renewal_rate(available: DataFrame, deals: DataFrame, lines: DataFrame) -> DataFrame:
    """Won, open and lost renewal amounts per renewal deal, capped by the amount up for renewal.

    ``available``: opportunity_id, account_id, renewal_start, available; ``deals``: opportunity_id, status;
    ``lines``: opportunity_id, renewal_amount.
    """
    per = lines.groupBy("opportunity_id").agg(F.sum(money("renewal_amount")).alias("_sum"))
    x = available.join(deals.select("opportunity_id", "status"), "opportunity_id", "left").join(per, "opportunity_id", "left")
    amount = lambda *states: F.coalesce(F.when(F.col("status").isin(*states), F.col("_sum")), F.lit(0)).cast("decimal(18,2)")
    cap = money("available")
    ratio = lambda c: half_up(F.try_divide(c.cast("double"), F.nullif(F.col("available").cast("double"), F.lit(0.0))), 4)
    won, still = F.least(amount("Won"), cap), F.least(amount("Won", "Open"), cap)
    return x.select(
        "opportunity_id", "account_id", F.date_sub("renewal_start", 1).alias("renewal_date"), F.col("available").alias("available_renewal"),
        *[amount(s).cast("double").alias(f"{s.lower()}_renewal_net_total") for s in ("Won", "Open", "Lost")], won.cast("double").alias("won_renewal_gross_total"),
        F.least(amount("Open"), cap).cast("double").alias("open_renewal_gross_total"), F.when(F.col("status") == "Lost", F.col("available")).otherwise(0.0).alias("lost_renewal_gross_total"),
        ratio(won).alias("renewal_rate"), ratio(still).alias("max_renewal_rate"),
    )


def ending_arr(steps: DataFrame, annual: DataFrame, deals: DataFrame) -> DataFrame:
    """Value of each won deal on its last contract day, and that of the deals it renews.

    ``deals``: opportunity_id, renewed_by, is_won.
    """
    last = annual.groupBy("opportunity_id").agg(F.max("end_date").alias("_end")).join(deals.where("is_won").select("opportunity_id", "renewed_by"), "opportunity_id")
    value = steps.select("opportunity_id", "from_day", "to_day", "won_arr").join(last, "opportunity_id").where(F.col("_end").between(F.col("from_day"), F.col("to_day")))
    ends = value.select("opportunity_id", "renewed_by", F.col("won_arr").alias("ending_arr"))
    before = ends.where(F.col("renewed_by").isNotNull()).groupBy(F.col("renewed_by").alias("opportunity_id")).agg(F.sum("ending_arr").alias("_before"))
    return ends.join(before, "opportunity_id", "left").select("opportunity_id", "ending_arr", F.coalesce("_before", F.lit(0)).alias("original_opportunity_ending_arr"))


def current_customers(deals: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Won deals still in force with the account's total."""
    live = deals.where(F.col("is_won") & (F.col("license_end") >= _today(as_of)) & F.col("ending_arr").isNotNull())
    x = windows.group_stats(live, ["account_id"], total_ending_arr=F.sum(money("ending_arr")).cast("double"))
    return x.join(accounts.select("account_id", "account_name"), "account_id").select(
        "opportunity_id", "account_id", "account_name", F.col("license_start").alias("license_starts_at"), F.col("license_end").alias("license_ends_at"), "ending_arr", "total_ending_arr"
    )


def metering_cost(usage: DataFrame, rates: DataFrame, last_day: str) -> DataFrame:
    """Usage priced with the rate in force on its day.

    ``usage``: warehouse_id, start_time, end_time, credits_used; ``rates``: contract_date, rate. A rate holds
    until the day before the next one.
    """
    line = windows.chunked_scan(rates.withColumn("_all", F.lit(1)), ["_all"], F.year("contract_date"), ["contract_date"], leads={"_next": "contract_date"})
    steps = line.select("contract_date", "rate", F.coalesce(F.date_sub("_next", 1), F.lit(last_day).cast("date")).alias("_end"))
    day = F.to_date("end_time")
    x = joins.contain_join(usage.withColumn("usage_day", day), steps, "usage_day", "contract_date", "_end", "left")
    return x.select(
        "warehouse_id", "start_time", "end_time", F.trunc("usage_day", "month").alias("usage_month"), "usage_day", dates.hours_crossed("start_time", "end_time").alias("usage_length"),
        F.col("rate").alias("credit_rate"), half_up(F.col("credits_used") * F.col("rate"), 2).alias("dollars_spent"),
    )
