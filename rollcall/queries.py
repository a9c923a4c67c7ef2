"""All attendance queries: name, Spark function over the tables, and the same in DuckDB SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.functions import rules as R
from rollcall.operators import checks, curated, hierarchy, incremental, mart, people, profiling, relational, search, views
from rollcall.plans import kpi, upkeep
from rollcall.plans.sql_views import RATES, SUMS, VIEWS
from rollcall.plans.tables import Served, Tables
from rollcall.sources import scans
from rollcall.sources.adapters import duckdb_sql
from rollcall.streaming import capture, delivery

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Queries that read the published mart; the others compute all from the source.
SERVED: set[str] = set()
A, B, DAY = dt.date(2024, 1, 5), dt.date(2024, 1, 20), dt.date(2024, 1, 8)
P = "tanggal BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"


def add(name: str, f: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = f
    if sql is not None:
        SQL[name] = sql


def serve(name: str, f: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    """A query that is answered from the published mart."""
    add(name, f, sql)
    SERVED.add(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f, of=Served if name in SERVED else Tables: f(of(spark, sf_dir))) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: duckdb_sql(sql, VIEWS) for name, sql in SQL.items()}


def named(t: Tables) -> DataFrame:
    return kpi.with_names(t.fact, t.dim_pegawai, t.dim_departemen)


NAMED = (
    "{fact} f JOIN (SELECT key AS pegawai_key, name AS p_name FROM {dim_pegawai}) p USING (pegawai_key) "
    "JOIN (SELECT key AS departemen_key, name AS d_name FROM {dim_departemen}) d USING (departemen_key)"
)

# Curated tables
add("event_enrich", lambda t: t.ev, "SELECT * FROM {ev}")
add("event_date_attribution", lambda t: t.ev.groupBy("date_status", "date_reason").agg(F.count("*").alias("n")),
    "SELECT date_status, date_reason, count(*) AS n FROM {ev} GROUP BY ALL")
add("event_review", lambda t: t.ev.groupBy("perlu_review", "alasan_review").agg(F.count("*").alias("n")),
    "SELECT perlu_review, alasan_review, count(*) AS n FROM {ev} GROUP BY ALL")
add("checkin_window", lambda t: t.ev.groupBy("checkin_window").agg(F.count("*").alias("n")), "SELECT checkin_window, count(*) AS n FROM {ev} GROUP BY ALL")
add("checkout_window", lambda t: t.ev.groupBy("checkout_window").agg(F.count("*").alias("n")), "SELECT checkout_window, count(*) AS n FROM {ev} GROUP BY ALL")
add("population_snapshot", lambda t: t.pop, "SELECT * FROM {pop}")
add("leave_validate", lambda t: t.lv, "SELECT * FROM {lv}")
add("leave_exemption", lambda t: t.lv.groupBy("tipe_ijin", "is_valid_leave", "excuses_checkin", "excuses_checkout").agg(F.count("*").alias("n")),
    "SELECT tipe_ijin, is_valid_leave, excuses_checkin, excuses_checkout, count(*) AS n FROM {lv} GROUP BY ALL")
add("leave_expand", lambda t: t.lvday, "SELECT * FROM {lvday}")
add("event_daily", lambda t: t.evday, "SELECT * FROM {evday}")
add("leave_daily", lambda t: t.lvsum, "SELECT * FROM {lvsum}")
add("unresolved_daily", lambda t: t.opened, "SELECT * FROM {opened}")
add("first_shift_event", lambda t: curated.first_shift_event(t.ev), "SELECT * FROM {firstev}")
add("all_inactive", lambda t: curated.checkin_shifts(t.ev).select("pegawai_id", "tanggal", "all_inactive"), "SELECT * FROM {inact}")
add("shift_ties", lambda t: relational.shift_ties(t.ev), "SELECT * FROM {ties}")
add("unified_daily", lambda t: t.daily, "SELECT * FROM {daily}")
add("daily_measures", lambda t: t.daily.select("pegawai_id", "tanggal", *R.MEASURES), f"SELECT pegawai_id, tanggal, {', '.join(R.MEASURES)} FROM {{daily}}")
add("lateness_decide", lambda t: t.daily.select("pegawai_id", "tanggal", "lateness_status", "lateness_reason", "lateness_event_id", "lateness_schedule_id"),
    "SELECT pegawai_id, tanggal, lateness_status, lateness_reason, lateness_event_id, lateness_schedule_id FROM {daily}")

# Mart
add("fact_daily", lambda t: t.fact, "SELECT * FROM {fact}")
add("department_day_sum", lambda t: t.agg, "SELECT * FROM {agg}")
serve("department_daily", lambda t: t.dept, "SELECT * FROM {dept}")
serve("institution_daily", lambda t: t.inst, "SELECT * FROM {inst}")
serve("institution_sums", lambda t: t.inst.select("tanggal", *R.MEASURES, "fact_rows", "review_rows"),
    f"SELECT tanggal, {', '.join(R.MEASURES)}, fact_rows, review_rows FROM {{inst}}")
serve("weighted_rate", lambda t: t.dept.agg(R.rate(F.sum("checkin_days"), F.sum("active_employee_days")).alias("rate")),
    "SELECT 100.0::DOUBLE * sum(checkin_days) / nullif(sum(active_employee_days), 0) AS rate FROM {dept}")
serve("department_options", lambda t: mart.department_options(t.dim_departemen),
    (
        "SELECT source_id AS departemen_id, name AS nama_departemen FROM (SELECT *, row_number() OVER (PARTITION BY source_id "
        "ORDER BY valid_from DESC, key DESC) AS n FROM {dim_departemen}) WHERE n = 1"
    ))
serve("lateness_employee_daily", lambda t: t.late, "SELECT * FROM {late}")
add("scd2_lookup", lambda t: mart.scd2_lookup(t.daily.select("pegawai_id", "tanggal", "departemen_id"), t.dim_departemen, "departemen_id", "departemen_key", how="left"),
    """SELECT d.pegawai_id, d.tanggal, d.departemen_id, m.key AS departemen_key FROM {daily} d LEFT JOIN {dim_departemen} m
       ON m.source_id = d.departemen_id AND d.tanggal >= m.valid_from AND (m.valid_to IS NULL OR d.tanggal < m.valid_to)""")  # fmt: skip
MISSING = """SELECT DISTINCT d.pegawai_id AS source_id, d.tanggal FROM {daily} d WHERE NOT EXISTS
       (SELECT 1 FROM {dim_pegawai} p WHERE p.source_id = d.pegawai_id AND d.tanggal >= p.valid_from AND (p.valid_to IS NULL OR d.tanggal < p.valid_to))"""
add("scd2_missing", lambda t: mart.scd2_missing(t.daily, t.dim_pegawai, "pegawai_id"), MISSING)
add("scd2_next_start", lambda t: mart.scd2_next_start(mart.scd2_missing(t.daily, t.dim_pegawai, "pegawai_id"), t.dim_pegawai),
    f"""SELECT source_id, min(tanggal) AS valid_from, valid_to FROM (SELECT m.source_id, m.tanggal, min(p.valid_from) AS valid_to FROM ({MISSING}) m
        LEFT JOIN {{dim_pegawai}} p ON p.source_id = m.source_id AND p.valid_from > m.tanggal GROUP BY ALL) GROUP BY source_id, valid_to""")  # fmt: skip
add("interval_overlap",
    lambda t: mart.interval_overlap(t.dim_departemen.unionByName(t.dim_departemen.where("source_id % 4 = 1").withColumn("valid_from",
        F.date_add("valid_from", 10)))).select("source_id", "valid_from", "valid_to", "next_from"),
    """SELECT source_id, valid_from, valid_to, next_from FROM (SELECT *, lead(valid_from) OVER (PARTITION BY source_id ORDER BY valid_from, valid_to NULLS LAST) AS next_from FROM
       (SELECT source_id, valid_from, valid_to FROM {dim_departemen} UNION ALL SELECT source_id, valid_from + 10, valid_to FROM {dim_departemen} WHERE source_id % 4 = 1))
       WHERE valid_to <= valid_from OR (next_from IS NOT NULL AND (valid_to IS NULL OR valid_to > next_from))""")  # fmt: skip
add("effective_name_refresh", lambda t: mart.effective_name_refresh(t.dim_departemen,
    t.m_departemen.where("id % 2 = 0").select(F.col("id").alias("source_id"), F.lower("nama_departemen").alias("name")), F.lit(A), F.lit(DAY)),
    """SELECT key, d.source_id, CASE WHEN valid_from <= DATE '2024-01-08' AND (valid_to IS NULL OR valid_to > DATE '2024-01-05')
        AND m.id IS NOT NULL THEN lower(m.nama_departemen) ELSE name END AS name,
       valid_from, valid_to FROM {dim_departemen} d LEFT JOIN {m_departemen} m ON m.id = d.source_id AND m.id % 2 = 0""")  # fmt: skip

# Dashboard
for _m in R.MEASURES[:6]:
    serve(f"kpi_card_{_m}", lambda t, m=_m: kpi.card(t.fact, m, A, B), f"SELECT CAST(sum({_m}) AS BIGINT) AS {_m} FROM {{fact}} WHERE {P}")
serve("filter_period", lambda t: kpi.period(t.fact, A, B).select("pegawai_id", "tanggal"), f"SELECT pegawai_id, tanggal FROM {{fact}} WHERE {P}")
serve("filter_optional", lambda t: kpi.optional(t.fact, departemen_id=7).select("pegawai_id", "tanggal"), "SELECT pegawai_id, tanggal FROM {fact} WHERE departemen_id = 7")
serve("filter_search", lambda t: search.search_facts(t, "nation_1").select("pegawai_id", "tanggal"),
    f"SELECT pegawai_id, tanggal FROM {NAMED} WHERE contains(lower(p_name), 'nation_1') OR contains(lower(d_name), 'nation_1')")
for _n, _text in (("number", "12"), ("name", "000012")):
    serve(f"filter_search_{_n}", lambda t, text=_text: search.search_facts(t, text).select("pegawai_id", "tanggal"),
        (
            f"SELECT pegawai_id, tanggal FROM {NAMED} WHERE concat_ws('|', pegawai_id, lower(p_name)) LIKE '%{_text}%' "
            f"OR contains(CAST(departemen_id AS VARCHAR), '{_text}') OR contains(lower(d_name), '{_text}')"
        ))
for _n, _m in kpi.CONDITIONS.items():
    serve(f"filter_condition_{_n}", lambda t, n=_n: kpi.condition(t.fact, n).select("pegawai_id", "tanggal"), f"SELECT pegawai_id, tanggal FROM {{fact}} WHERE {_m} = 1")
serve("filter_any_missing", lambda t: people.missing_people(t.people), "SELECT count(DISTINCT pegawai_id) AS people FROM {fact} WHERE no_checkin_days = 1 OR no_checkout_days = 1")
serve("scope_department", lambda t: kpi.scope(t.fact, "manager", 3).select("pegawai_id", "tanggal"), "SELECT pegawai_id, tanggal FROM {fact} WHERE departemen_id = 3")
serve("attendance_trend", lambda t: kpi.trend(t.fact, A, B),
    f"SELECT tanggal, CAST(sum(checkin_days) AS BIGINT) AS checkin_days, CAST(sum(checkout_days) AS BIGINT) AS checkout_days FROM {{fact}} WHERE {P} GROUP BY tanggal")
serve("employee_daily_list", lambda t: kpi.employee_list(named(t), A, B),
    f"""SELECT pegawai_id, coalesce(p_name, 'Employee ' || pegawai_id) AS employee, tanggal, departemen_id, coalesce(d_name,
        'Department ' || departemen_id, 'UNKNOWN') AS department, first_checkin_at,
        last_checkout_at, has_masuk, has_pulang, has_valid_leave, has_excused_checkin, has_excused_checkout, perlu_review, NOT is_date_final AS is_provisional
        FROM {NAMED} WHERE {P} AND active_employee_days = 1 ORDER BY tanggal, pegawai_id LIMIT 1000""")  # fmt: skip
_R2 = ", ".join(f"round({r.split(' AS ')[0].strip()}, 2) AS {r.split(' AS ')[1]}" for r in RATES.split(", 100.0") for r in ([r] if r.startswith("100.0") else ["100.0" + r]))
serve("department_summary", lambda t: kpi.department_summary(named(t), A, B),
    f"""SELECT departemen_id, coalesce(name, 'Department ' || departemen_id, 'UNKNOWN') AS department, {', '.join(R.MEASURES[:6])}, {_R2}, is_provisional FROM
        (SELECT departemen_id, max(d_name) AS name, {SUMS}, bool_or(perlu_review OR NOT is_date_final) AS is_provisional FROM {NAMED} WHERE {P}
            GROUP BY departemen_id)""")  # fmt: skip
COVER = """SELECT CASE WHEN count(*) = 0 THEN 'NO DATA' WHEN bool_or(perlu_review OR NOT is_date_final) THEN 'PROVISIONAL' ELSE 'FINAL' END AS status,
    min(tanggal) AS first_date, max(tanggal) AS last_date,
    count(DISTINCT tanggal) AS available_dates, 16 AS requested_dates, bool_and(coalesce(population_complete AND curated_delivery_complete, false)) AS is_data_complete
    FROM {fact} LEFT JOIN {date_state} USING (tanggal) WHERE """ + P
serve("date_coverage", lambda t: kpi.coverage(t.fact, t.date_state, A, B), COVER)
serve("data_coverage", lambda t: kpi.coverage(t.fact, t.date_state, A, B), COVER)
_RANK = (
    "SELECT departemen_id, department, affected, eligible, rate, CAST(row_number() OVER (ORDER BY rate DESC, affected DESC, "
    "eligible DESC, department, departemen_id NULLS LAST) AS INT) AS rank FROM (SELECT *, "
    "round(100.0::DOUBLE * affected / eligible, 2) AS rate FROM (%s) WHERE eligible > 0) ORDER BY rank LIMIT 10"
)
_LATE = f"""SELECT departemen_id, coalesce(max(nama_departemen), 'UNKNOWN') AS department, count(DISTINCT pegawai_id) FILTER (is_employee_active
    AND NOT has_excused_checkin AND lateness_status = 'LATE') AS affected,
    count(DISTINCT pegawai_id) FILTER (is_employee_active AND NOT has_excused_checkin AND lateness_status IN ('LATE', 'ON_TIME')) AS eligible
        FROM {{late}} WHERE {P} GROUP BY departemen_id"""
serve("rank_lateness", lambda t: people.rank_departments(t.people, t.dim_departemen, "late_assessed", "assessed", A, B), _RANK % _LATE)
serve("topk_departments", lambda t: people.rank_departments(t.people, t.dim_departemen, "late_assessed", "assessed", A, B), _RANK % _LATE)
serve("distinct_people_rate", lambda t: people.people_rate(t.people, "late", "known", ["tanggal"]),
    """SELECT *, round(100.0::DOUBLE * affected / eligible, 2) AS rate FROM (SELECT tanggal, count(DISTINCT pegawai_id) FILTER (lateness_status = 'LATE') AS affected,
       count(DISTINCT pegawai_id) FILTER (lateness_status IN ('LATE', 'ON_TIME')) AS eligible FROM {late} GROUP BY tanggal) WHERE eligible > 0""")  # fmt: skip
serve("rank_leave", lambda t: people.rank_departments(t.people, t.dim_departemen, "on_leave", "active", A, B),
    _RANK % f"""SELECT departemen_id, coalesce(max(d_name), 'UNKNOWN') AS department, count(DISTINCT pegawai_id) FILTER (active_employee_days = 1 AND leave_days = 1) AS affected,
    count(DISTINCT pegawai_id) FILTER (active_employee_days = 1) AS eligible FROM {NAMED} WHERE {P} GROUP BY departemen_id""")  # fmt: skip
serve("missing_rates", lambda t: kpi.missing_rates(t.agg, ["tanggal"]),
    """SELECT tanggal, 100.0::DOUBLE * sum(no_checkin_days) / nullif(sum(required_checkin_days), 0) AS missing_checkin_rate,
       100.0::DOUBLE * sum(no_checkout_days) / nullif(sum(required_checkout_days), 0) AS missing_checkout_rate FROM {agg} GROUP BY tanggal""")  # fmt: skip
serve("leave_proportion", lambda t: kpi.leave_proportion(t.agg, ["departemen_key"]),
    "SELECT departemen_key, 100.0::DOUBLE * sum(leave_days) / nullif(sum(active_employee_days), 0) AS leave_rate FROM {agg} GROUP BY departemen_key")
serve("unique_people_period", lambda t: people.unique_people(t.people, A, B), f"SELECT count(DISTINCT pegawai_id) AS people FROM {{fact}} WHERE active_employee_days = 1 AND {P}")
serve("side_partition", lambda t: kpi.side_partition(t.agg), " UNION ALL ".join(
    f"SELECT '{s}' AS side, '{p}' AS part, CAST(sum({c}) AS BIGINT) AS value FROM {{agg}}" for s in ("checkin", "checkout") for p,
    c in (("fulfilled", f"required_{s}_present_days"), ("missing", f"no_{s}_days"), ("exempt", f"excused_{s}_days"))))
serve("department_dropdown", lambda t: kpi.department_dropdown(named(t)),
    f"SELECT departemen_id, coalesce(max(d_name), 'Department ' || departemen_id, 'UNKNOWN') AS department FROM {NAMED} GROUP BY departemen_id")
serve("lateness_coverage", lambda t: people.lateness_coverage(t.people, A, B), f"SELECT lateness_status, count(DISTINCT pegawai_id) AS people FROM {{late}} WHERE {P} GROUP BY ALL")
serve("review_workload", lambda t: kpi.review_workload(t.agg),
    "SELECT " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("review_rows", "excused_checkin_days", "excused_checkout_days", "fact_rows")) + " FROM {agg}")
serve("previous_period_change", lambda t: kpi.previous_period_change(t.fact, dt.date(2024, 1, 15), B),
    """SELECT a AS rate_now, b AS rate_then, a - b AS change
        FROM (SELECT 100.0::DOUBLE * sum(checkin_days) FILTER (tanggal >= DATE '2024-01-15') / nullif(sum(active_employee_days) FILTER (tanggal >= DATE '2024-01-15'),
        0) AS a,
       100.0::DOUBLE * sum(checkin_days) FILTER (tanggal < DATE '2024-01-15') / nullif(sum(active_employee_days) FILTER (tanggal < DATE '2024-01-15'), 0) AS b
       FROM {fact} WHERE tanggal BETWEEN DATE '2024-01-09' AND DATE '2024-01-20')""")  # fmt: skip
serve("share_of_total", lambda t: kpi.share_of_total(t.agg),
    (
        "SELECT departemen_key, CAST(sum(no_checkin_days) AS BIGINT) AS missing, "
        "100.0::DOUBLE * sum(no_checkin_days) / nullif((SELECT sum(no_checkin_days) FROM {agg}), 0) AS share FROM {agg} "
        "GROUP BY departemen_key"
    ))
_S6 = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in R.MEASURES[:6])
serve("grouping_sets_total", lambda t: kpi.grouping_sets_total(t.dept, DAY),
    f"SELECT departemen_key, CAST(grouping(departemen_key) AS INT) AS is_total, {_S6} FROM {{dept}} WHERE tanggal = DATE '2024-01-08' GROUP BY ROLLUP (departemen_key)")
serve("limit_ordered", lambda t: t.fact.select("pegawai_id", "tanggal").orderBy("tanggal", "pegawai_id").limit(1000),
    "SELECT pegawai_id, tanggal FROM {fact} ORDER BY tanggal, pegawai_id LIMIT 1000")
serve("page", lambda t: kpi.page(t.fact.select("pegawai_id", "tanggal"), [F.col("tanggal"), F.col("pegawai_id")], 50, 3),
    "SELECT pegawai_id, tanggal FROM {fact} ORDER BY tanggal, pegawai_id LIMIT 50 OFFSET 100")


def third_page(t: Tables) -> DataFrame:
    """The third page of 50 facts, each page found from the last row of the one before."""
    order, rows, after = ["tanggal", "pegawai_id"], t.fact.select("pegawai_id", "tanggal"), None
    for number in (1, 2, 3):
        page = kpi.page_after(rows, order, after, 50, kpi.page_ends(t.agg, after and after["tanggal"], 50))
        if number < 3:
            after = page.orderBy(*(F.desc(c) for c in order)).first().asDict()
    return page


serve("page_after", third_page, "SELECT pegawai_id, tanggal FROM {fact} ORDER BY tanggal, pegawai_id LIMIT 50 OFFSET 100")
serve("department_search", lambda t: kpi.department_search(mart.department_options(t.dim_departemen), "a"),
    """SELECT departemen_id, nama_departemen FROM (SELECT source_id AS departemen_id, name AS nama_departemen,
        row_number() OVER (PARTITION BY source_id ORDER BY valid_from DESC, key DESC) AS n FROM {dim_departemen})
       WHERE n = 1 AND contains(lower(nama_departemen), 'a') ORDER BY nama_departemen, departemen_id LIMIT 20""")  # fmt: skip
serve("legacy_marts_status", lambda t: kpi.legacy_marts(t.fact)["status"], "SELECT tanggal, departemen_key, lateness_status, count(*) AS n FROM {fact} GROUP BY ALL")
serve("legacy_marts_late", lambda t: kpi.legacy_marts(t.fact)["late"],
    "SELECT tanggal, departemen_key, lateness_status = 'LATE' AS is_late, count(*) AS n FROM {fact} GROUP BY ALL")
serve("legacy_marts_attendance", lambda t: kpi.legacy_marts(t.fact)["attendance"], f"SELECT tanggal, departemen_key, {_S6} FROM {{fact}} GROUP BY ALL")

for _module in (scans, relational, views, incremental, profiling, hierarchy, upkeep, checks, delivery, capture):
    for _name, (_f, _sql) in _module.QUERIES.items():
        add(_name, _f, _sql)
