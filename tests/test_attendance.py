"""Attendance operators on small tables, and queries against DuckDB on the smallest test tables."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rollcall.functions import rules as R
from rollcall.operators import checks, curated, incremental, mart, profiling, relational, views
from rollcall.plans.tables import Served, Tables
from rollcall.sources import scans
from rollcall.sources.scratch import VersionedTables, scratch

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 8)
COMPARED = [
    "unified_daily", "institution_daily", "employee_daily_list", "department_summary", "rank_lateness", "previous_period_change", "event_quality_flags", "history_profile", "impact_sizing",
    "checkin_window_profile", "checkout_window_profile", "attendance_detail_view", "dim_employee", "schedule_for_day", "profile_export", "calendar_table", "csv_scan_sink", "versioned_publish",
    "hierarchy_chains", "page_after", "filter_search_name", "unique_people_period", "manifest_build", "row_change_audit", "block_sample", "changed_rows_by_digest", "reconcile_departments", "dimension_lookup_valid", "fingerprint", "row_constraints", "mutation_guard", "late_correction", "latest_payload_per_batch", "recompute_affected", "dense_cohort_number",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, duck, name):
    df, sql = entry.queries()[name](spark, SF), entry.oracle_sql()[name]
    cols, want = sorted(df.columns), duck.sql(sql)
    assert cols == sorted(want.columns)
    order = [want.columns.index(c) for c in cols]
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got and got == sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=repr)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_daily_records_of_nobody(spark):
    """Empty sides give no records; a null employee or time gives none either."""
    t = Tables(spark, SF)
    none = t.ev.where("false")
    assert curated.unified_daily(t.pop.where("false"), none, t.lvsum.where("false")).count() == 0
    lost = t.ev.where("pegawai_id is null")
    assert curated.event_summary(lost).count() == 0
    only_leave = curated.unified_daily(t.pop.where("false"), none, t.lvsum)
    assert only_leave.count() == t.lvsum.count() and only_leave.where("not perlu_review or lateness_status <> 'NOT_ASSESSED'").count() == 0


def test_one_exchange_of_events(spark):
    """Daily records shuffle the enriched events once."""
    t = Tables(spark, SF)
    plan = curated.event_summary(t.ev)._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert plan.count("hashpartitioning(pegawai_id") + plan.count("hashpartitioning(tanggal") <= 1 and plan.count("events.parquet") <= 1


def test_served_tables_are_published_once(spark):
    first, again = Served(spark, SF), Served(spark, SF)
    assert first.paths == again.paths and first.mart.version() == 1
    assert "PartitionFilters: [isnotnull(tanggal" in first.fact.where("tanggal = DATE '2024-01-08'")._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_snapshots(spark):
    tables = VersionedTables(spark, scratch(spark, "t"))
    assert tables.version() == 0 and tables.snapshot() == {}
    tables.publish({"a": spark.range(3), "b": spark.range(1)})
    old = tables.snapshot()
    tables.publish({"a": spark.range(5)})
    assert spark.read.parquet(old["a"]).count() == 3 and tables.read("a").count() == 5 and tables.read("b").count() == 1


def test_sample_is_reproducible(spark):
    t = Tables(spark, SF)
    one, two = (scans.sample_rows(t.t_checkinout, 10.0).select("id").collect() for _ in range(2))
    assert one == two and 0 < len(one) < t.t_checkinout.count() / 5
    assert scans.sample_rows(t.t_checkinout, 10.0, seed=1).select("id").collect() != one


def test_guard(spark):
    of = "batch_id long, snapshot_date date, today date"
    batches = spark.createDataFrame([(1, None, DAY), (2, DAY, DAY), (3, DAY, None), (4, dt.date(2024, 1, 9), dt.date(2024, 1, 9))], of)
    daily = spark.createDataFrame([(dt.date(2024, 1, 9), True), (DAY, False), (None, True)], "tanggal date, is_date_final boolean")
    full, empty = spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([], "id long")
    got = {r.batch_id: r.refused for r in incremental.mutation_guard(batches, daily, full).collect()}
    assert got == {1: None, 2: None, 3: "SNAPSHOT_NOT_TODAY", 4: "DATE_CLOSED"}
    assert {r.refused for r in incremental.mutation_guard(batches.where("batch_id = 2"), daily, empty).collect()} == {"EMPTY_MASTER"}
    with pytest.raises(ValueError, match="batch 3"):
        incremental.refuse(incremental.mutation_guard(batches, daily, full))
    incremental.refuse(incremental.mutation_guard(batches.limit(0), daily, full))


def test_payloads_of_any_age(spark):
    rows = spark.createDataFrame([('{"a": 1}', "k"), ('{"a": 2, "s": "x", "new": 1}', "k"), ("not json", "k"), (None, "k")], "payload string, a string")
    got = incremental.tolerant_payload(rows, "payload", "a INT, s STRING", {"s": "UNKNOWN"}).collect()
    assert [(r.a, r.s) for r in got] == [(1, "UNKNOWN"), (2, "x"), (None, "UNKNOWN"), (None, "UNKNOWN")]


def test_overlapping_versions_and_scd2(spark):
    d = lambda n: dt.date(2024, 1, n)
    dim = spark.createDataFrame([(1, 5, "a", d(1), d(9)), (2, 5, "b", d(9), None), (3, 6, "c", d(4), d(3))], "key long, source_id int, name string, valid_from date, valid_to date")
    rows = spark.createDataFrame([(5, d(8)), (5, d(9)), (6, d(3)), (None, d(3))], "departemen_id int, tanggal date")
    assert sorted((r.tanggal, r.k) for r in mart.scd2_lookup(rows, dim, "departemen_id", "k").collect()) == [(d(8), 1), (d(9), 2)]
    assert [r.key for r in mart.interval_overlap(dim).collect()] == [3]


def test_violations_are_found(spark):
    daily = spark.createDataFrame([(1, 1, 0, 1)], "active_employee_days int, required_checkin_days int, excused_checkin_days int, x int")
    assert checks.violations(daily, ("active_employee_days <> required_checkin_days + excused_checkin_days",)).count() == 0
    assert checks.violations(daily.withColumn("active_employee_days", R.F.lit(0)), ("active_employee_days <> required_checkin_days + excused_checkin_days",)).count() == 1


def test_profile_of_no_events(spark):
    t = Tables(spark, SF)
    none = profiling.event_quality(t.t_checkinout.where("false"), t.m_jadwal, t.m_pegawai, dt.date(2024, 1, 20))
    assert {(r.events, r.observed_events) for r in profiling.impact_sizing(none).collect()} == {("0", 0)}
    assert {r.value for r in profiling.history_profile(none).collect()} <= {"0"}


def test_numbers_without_gaps(spark):
    got = relational.dense_number(spark.range(100).selectExpr("id % 7 as a", "id"), R.F.col("a"), R.F.col("id"), partitions=5).collect()
    assert [r.n for r in sorted(got, key=lambda r: (r.a, r.id))] == list(range(1, 101))


@pytest.mark.parametrize("name", ["attendance_detail_view", "employee_view", "dim_employee"])
def test_employee_numbers_beyond_int_products(spark, name):
    """Identifiers of employees whose number times 7919 is no INT."""
    t = Tables(spark, SF)
    t._tables |= {n: t.table(n).withColumn(c, (F.col(c) + 5_000_000).cast("int")) for n, c in (("m_pegawai", "id"), ("t_checkinout", "pegawai_id"))}  # noqa: SLF001
    got = views.QUERIES[name][0](t).collect()
    number = "pegawai_id_sumber" if name == "dim_employee" else "pegawai_id"
    hidden = 5 if name == "attendance_detail_view" else 0
    nip = lambda i: ("19" * 9)[: 18 - len(str(i * 7919))] + str(i * 7919)
    assert got and all(r.nip == nip(r[number])[: 18 - hidden] + "*" * hidden for r in got)
