"""Dashboard queries: filters, cards, trends, rankings, lists and coverage.

Every function takes the tables it reads and ordinary parameters, and returns a DataFrame. Periods
are inclusive. An optional parameter that is None adds no predicate. Rates are ratios of sums, never
means of rates; a card over no rows is null, not zero.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import rules as R

CONDITIONS = {
    "active": "active_employee_days", "checkin": "checkin_days", "checkout": "checkout_days", "no_checkin": "no_checkin_days",
    "no_checkout": "no_checkout_days", "leave": "leave_days",
}


def period(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return df.where(F.col("tanggal").between(F.lit(start), F.lit(end)))


def optional(df: DataFrame, **equal) -> DataFrame:
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def search(df: DataFrame, text: str | None, *columns: Column | str) -> DataFrame:
    """Rows of which some column holds the text, case ignored; nulls hold nothing."""
    if not text:
        return df
    hit = F.lit(False)
    for c in columns:
        c = F.col(c) if isinstance(c, str) else c
        hit = hit | F.coalesce(F.contains(F.lower(c.cast("string")), F.lit(text.lower())), F.lit(False))
    return df.where(hit)


def scope(df: DataFrame, role: str, department: int | None) -> DataFrame:
    """A manager sees one department only, and must have one; other roles see all."""
    if role == "manager":
        if department is None:
            raise PermissionError("a manager's queries need a department")
        return df.where(F.col("departemen_id") == department)
    return df


def condition(fact: DataFrame, name: str) -> DataFrame:
    return fact.where(F.col(CONDITIONS[name]) == 1)


def any_missing(fact: DataFrame) -> DataFrame:
    return fact.where((F.col("no_checkin_days") == 1) | (F.col("no_checkout_days") == 1))


def with_names(fact: DataFrame, dim_employee: DataFrame, dim_department: DataFrame) -> DataFrame:
    p = dim_employee.select(F.col("key").alias("pegawai_key"), F.col("name").alias("p_name"))
    d = dim_department.select(F.col("key").alias("departemen_key"), F.col("name").alias("d_name"))
    return fact.join(p, "pegawai_key").join(d, "departemen_key")


def card(fact: DataFrame, measure: str, start, end, department: int | None = None) -> DataFrame:
    return optional(period(fact, start, end), departemen_id=department).agg(F.sum(measure).alias(measure))


def trend(fact: DataFrame, start, end, department: int | None = None) -> DataFrame:
    rows = optional(period(fact, start, end), departemen_id=department)
    return rows.groupBy("tanggal").agg(F.sum("checkin_days").alias("checkin_days"), F.sum("checkout_days").alias("checkout_days")).orderBy("tanggal")


def employee_list(named: DataFrame, start, end, department: int | None = None, text: str | None = None, limit: int = 1000) -> DataFrame:
    rows = search(optional(period(named, start, end), departemen_id=department), text, "pegawai_id", "p_name", "departemen_id", "d_name")
    rows = rows.where("active_employee_days = 1").orderBy("tanggal", "pegawai_id").limit(limit)
    return rows.select(
        "pegawai_id", R.label("p_name", "pegawai_id", "Employee ").alias("employee"), "tanggal", "departemen_id", R.label("d_name", "departemen_id").alias("department"),
        "first_checkin_at", "last_checkout_at", "has_masuk", "has_pulang", "has_valid_leave", "has_excused_checkin", "has_excused_checkout", "perlu_review",
        (~F.col("is_date_final")).alias("is_provisional"),
    )


def department_summary(named: DataFrame, start, end, department: int | None = None, text: str | None = None, limit: int = 5000) -> DataFrame:
    rows = search(optional(period(named, start, end), departemen_id=department), text, "departemen_id", "d_name")
    sums = rows.groupBy("departemen_id").agg(
        F.max("d_name").alias("name"), *(F.sum(m).alias(m) for m in R.MEASURES), F.bool_or(F.col("perlu_review") | ~F.col("is_date_final")).alias("is_provisional")
    )
    out = sums.withColumn("department", R.label("name", "departemen_id")).withColumns(R.rates(2))
    out = out.select("departemen_id", "department", *R.MEASURES[:6], *R.rates(), "is_provisional")
    return out.orderBy(F.col("departemen_id").asc_nulls_last()).limit(limit)


def coverage(fact: DataFrame, state: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    rows = period(fact, start, end).join(state, "tanggal", "left")
    open_ = F.bool_or(F.col("perlu_review") | ~F.col("is_date_final"))
    return rows.agg(
        F.when(F.count("*") == 0, "NO DATA").when(open_, "PROVISIONAL").otherwise("FINAL").alias("status"), F.min("tanggal").alias("first_date"),
        F.max("tanggal").alias("last_date"),
        F.count_distinct("tanggal").alias("available_dates"), F.lit((end - start).days + 1).alias("requested_dates"),
        F.bool_and(R.true(F.col("population_complete") & F.col("curated_delivery_complete"))).alias("is_data_complete"),
    )


def people_rate(rows: DataFrame, affected: Column, eligible: Column, by: list[str]) -> DataFrame:
    """Distinct people affected and eligible, and their rate."""
    out = rows.groupBy(*by).agg(F.count_distinct(F.when(affected, F.col("pegawai_id"))).alias("affected"),
        F.count_distinct(F.when(eligible, F.col("pegawai_id"))).alias("eligible"))
    return out.where("eligible > 0").withColumn("rate", R.rate("affected", "eligible", 2))


RANK_ORDER = ("rate DESC", "affected DESC", "eligible DESC", "department", "departemen_id ASC NULLS LAST")


def ranked(rates: DataFrame, k: int) -> DataFrame:
    """The first k of a total order, numbered. Only k rows reach the window."""
    order = [F.expr(x.split()[0]) for x in RANK_ORDER]
    order = [order[0].desc(), order[1].desc(), order[2].desc(), order[3].asc(), order[4].asc_nulls_last()]
    top = rates.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def rank_lateness(late: DataFrame, start, end, department: int | None = None, k: int = 10) -> DataFrame:
    assessed = R.true("is_employee_active") & ~F.col("has_excused_checkin")
    rows = optional(period(late, start, end), departemen_id=department)
    rows = rows.withColumn("is_late", assessed & (F.col("lateness_status") == "LATE")).withColumn("is_assessed", assessed & F.col("lateness_status").isin("LATE", "ON_TIME"))
    names = rows.groupBy("departemen_id").agg(F.coalesce(F.max("nama_departemen"), F.lit("UNKNOWN")).alias("department")).withColumnRenamed("departemen_id", "_id")
    rates = people_rate(rows, F.col("is_late"), F.col("is_assessed"), ["departemen_id"])
    return ranked(rates.join(names, F.col("departemen_id").eqNullSafe(F.col("_id"))).drop("_id"), k)


def rank_leave(named: DataFrame, start, end, department: int | None = None, k: int = 10) -> DataFrame:
    rows = optional(period(named, start, end), departemen_id=department)
    active = F.col("active_employee_days") == 1
    rates = rows.groupBy("departemen_id").agg(
        F.coalesce(F.max("d_name"), F.lit("UNKNOWN")).alias("department"), F.count_distinct(F.when(active & (F.col("leave_days") == 1), F.col("pegawai_id"))).alias("affected"),
        F.count_distinct(F.when(active, F.col("pegawai_id"))).alias("eligible"),
    )
    return ranked(rates.where("eligible > 0").withColumn("rate", R.rate("affected", "eligible", 2)), k)


def missing_rates(agg: DataFrame, by: list[str]) -> DataFrame:
    sums = agg.groupBy(*by).agg(*(F.sum(m).alias(m) for m in ("no_checkin_days", "no_checkout_days", "required_checkin_days", "required_checkout_days")))
    return sums.select(*by, R.rate("no_checkin_days", "required_checkin_days").alias("missing_checkin_rate"),
        R.rate("no_checkout_days", "required_checkout_days").alias("missing_checkout_rate"))


def leave_proportion(agg: DataFrame, by: list[str]) -> DataFrame:
    sums = agg.groupBy(*by).agg(F.sum("leave_days").alias("n"), F.sum("active_employee_days").alias("d"))
    return sums.select(*by, R.rate("n", "d").alias("leave_rate"))


def unique_people(fact: DataFrame, start, end, department: int | None = None) -> DataFrame:
    rows = optional(period(fact, start, end), departemen_id=department).where("active_employee_days = 1")
    return rows.agg(F.count_distinct("pegawai_id").alias("people"))


def side_partition(agg: DataFrame) -> DataFrame:
    """Fulfilled, missing and exempt of each side; the parts of a side sum to the active employee-days."""
    parts = {("checkin", "fulfilled"): "required_checkin_present_days", ("checkin", "missing"): "no_checkin_days", ("checkin", "exempt"): "excused_checkin_days",
             ("checkout", "fulfilled"): "required_checkout_present_days", ("checkout", "missing"): "no_checkout_days", ("checkout", "exempt"): "excused_checkout_days"}
    one = agg.agg(*(F.sum(c).alias(c) for c in parts.values()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(s).alias("side"), F.lit(p).alias("part"), F.col(c).alias("value")) for (s, p), c in parts.items()))))


def department_dropdown(named: DataFrame) -> DataFrame:
    names = named.groupBy("departemen_id").agg(F.max("d_name").alias("name"))
    return names.select("departemen_id", R.label("name", "departemen_id").alias("department")).orderBy("department", F.col("departemen_id").asc_nulls_last())


def lateness_coverage(late: DataFrame, start, end) -> DataFrame:
    """People by status over a period; a person with several statuses counts in each."""
    return period(late, start, end).groupBy("lateness_status").agg(F.count_distinct("pegawai_id").alias("people"))


def review_workload(agg: DataFrame) -> DataFrame:
    return agg.agg(*(F.sum(c).alias(c) for c in ("review_rows", "excused_checkin_days", "excused_checkout_days", "fact_rows")))


def previous_period_change(fact: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Check-in rate of the period less that of the equally long period before, in percentage points."""
    days = (end - start).days + 1
    before = start - dt.timedelta(days=days)
    now = F.col("tanggal") >= F.lit(start)
    rows = period(fact, before, end)
    one = rows.agg(*(F.sum(F.when(w, F.col(c))).alias(f"{c}_{n}") for n, w in (("now", now), ("then", ~now)) for c in ("checkin_days", "active_employee_days")))
    rate_now, rate_then = (R.rate(f"checkin_days_{n}", f"active_employee_days_{n}") for n in ("now", "then"))
    return one.select(rate_now.alias("rate_now"), rate_then.alias("rate_then"), (rate_now - rate_then).alias("change"))


def share_of_total(agg: DataFrame) -> DataFrame:
    """Each department's share of all missing check-ins; the total is one row, joined to the groups."""
    per = agg.groupBy("departemen_key").agg(F.sum("no_checkin_days").alias("missing"))
    total = per.agg(F.sum("missing").alias("total"))
    return per.crossJoin(F.broadcast(total)).select("departemen_key", "missing", R.rate("missing", "total").alias("share"))


def grouping_sets_total(dept: DataFrame, day: dt.date) -> DataFrame:
    """Departments of a day and their total, in one pass; the total comes first."""
    rows = dept.where(F.col("tanggal") == F.lit(day))
    out = rows.rollup("departemen_key").agg(F.grouping("departemen_key").cast("int").alias("is_total"), *(F.sum(m).alias(m) for m in R.MEASURES[:6]))
    return out.orderBy(F.col("is_total").desc(), F.col("departemen_key").asc_nulls_first())


def page(df: DataFrame, order: list[Column], size: int, number: int) -> DataFrame:
    """Page ``number`` (from 1) under a total order."""
    return df.orderBy(*order).offset(size * (number - 1)).limit(size)


def page_after(df: DataFrame, order: list[str], after: dict | None, size: int, last_day: dt.date | None = None) -> DataFrame:
    """The page that follows the row ``after`` (its values of ``order``, none for the first page) under a total order of non-null columns.

    The bound on the leading column, and ``last_day`` if the page is known to end by then, reach the scan, so a late page costs what an early one does.
    """
    if after is not None:
        bound, equal = F.lit(False), F.lit(True)
        for c in order:
            bound = bound | (equal & (F.col(c) > F.lit(after[c])))
            equal = equal & (F.col(c) == F.lit(after[c]))
        df = df.where((F.col(order[0]) >= F.lit(after[order[0]])) & bound)
    if last_day is not None:
        df = df.where(F.col(order[0]) <= F.lit(last_day))
    return df.orderBy(*order).limit(size)


def page_ends(agg: DataFrame, after: dt.date | None, size: int) -> dt.date | None:
    """A date by which ``size`` facts follow the date ``after``, from the sums of departments; None if there are fewer."""
    rows = agg if after is None else agg.where(F.col("tanggal") > F.lit(after))
    upto = 0
    for r in rows.groupBy("tanggal").agg(F.sum("fact_rows").alias("n")).orderBy("tanggal").collect():  # one row a date
        upto += r["n"]
        if upto >= size:
            return r["tanggal"]
    return None


def department_search(options: DataFrame, text: str, role: str = "organization", department: int | None = None, limit: int = 20) -> DataFrame:
    return search(scope(options, role, department), text, "nama_departemen").orderBy("nama_departemen", "departemen_id").limit(limit)


def legacy_marts(fact: DataFrame) -> dict[str, DataFrame]:
    """Superseded aggregates by date and department, by lateness status as well, and by whether late."""
    key = ["tanggal", "departemen_key"]
    return {
        "attendance": fact.groupBy(*key).agg(*(F.sum(m).alias(m) for m in R.MEASURES[:6])),
        "status": fact.groupBy(*key, "lateness_status").agg(F.count("*").alias("n")),
        "late": fact.groupBy(*key, (F.col("lateness_status") == "LATE").alias("is_late")).agg(F.count("*").alias("n")),
    }
