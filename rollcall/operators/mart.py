"""Effective-dated dimensions, the daily fact, department aggregates and their upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import rules as R

FACT_KEYS = ["pegawai_id", "tanggal"]
UNKNOWN_DEPARTMENT = 0


def covers(day: Column, dim: str = "") -> Column:
    """``day`` lies in the half-open validity interval of a dimension row."""
    return (day >= F.col(f"{dim}valid_from")) & (F.col(f"{dim}valid_to").isNull() | (day < F.col(f"{dim}valid_to")))


def scd2_lookup(rows: DataFrame, dim: DataFrame, id_col: str, key_col: str, dim_id: str = "source_id", how: str = "inner", day: str = "tanggal") -> DataFrame:
    """Adds the key of the dimension version in force on the row's day: an equi join with a range condition."""
    d = dim.select(F.col(dim_id).alias("_id"), F.col("key").alias(key_col), "valid_from", "valid_to")
    return rows.join(d, (F.col(id_col) == F.col("_id")) & covers(F.col(day)), how).drop("_id", "valid_from", "valid_to")


def scd2_missing(rows: DataFrame, dim: DataFrame, id_col: str, day: str = "tanggal", dim_id: str = "source_id") -> DataFrame:
    """Distinct (id, day) of ``rows`` that no version covers."""
    d = dim.select(F.col(dim_id).alias("_id"), "valid_from", "valid_to")
    want = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("source_id"), F.col(day).alias("tanggal")).distinct()
    return want.join(d, (F.col("source_id") == F.col("_id")) & covers(F.col("tanggal")), "left_anti")


def scd2_next_start(missing: DataFrame, dim: DataFrame, dim_id: str = "source_id") -> DataFrame:
    """Placeholder versions for uncovered days: from the first one up to the next known version's start."""
    d = dim.select(F.col(dim_id).alias("_id"), F.col("valid_from").alias("_from"))
    later = missing.join(d, (F.col("source_id") == F.col("_id")) & (F.col("_from") > F.col("tanggal")), "left")
    later = later.groupBy("source_id", "tanggal").agg(F.min("_from").alias("valid_to"))
    return later.groupBy("source_id", "valid_to").agg(F.min("tanggal").alias("valid_from")).select("source_id", "valid_from", "valid_to")


def surrogate_key(source_id: Column, valid_from: Column) -> Column:
    """The same key wherever it is computed; 0 stays free for the unknown member."""
    return F.when(source_id.isNotNull(), F.bitwise_not(F.shiftrightunsigned(F.xxhash64(source_id, valid_from), 1)).bitwiseAND(F.lit((1 << 62) - 1)) + 1).otherwise(0)


def interval_overlap(dim: DataFrame, dim_id: str = "source_id") -> DataFrame:
    """Versions that end after the next one of their id begins, or before they begin themselves."""
    w = Window.partitionBy(dim_id).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    d = dim.withColumn("next_from", F.lead("valid_from").over(w))
    bad = (F.col("valid_to") <= F.col("valid_from")) | (F.col("next_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_from"))))
    return d.where(R.true(bad))


def fact_daily(daily: DataFrame, dim_employee: DataFrame, dim_department: DataFrame) -> DataFrame:
    """Daily records with dimension keys: the employee must be known, an unknown department gets key 0.

    Employees grow with the data, so they are never broadcast, whatever their files' sizes say; departments may be.
    """
    f = scd2_lookup(daily, dim_employee.hint("shuffle_hash"), "pegawai_id", "pegawai_key")
    f = scd2_lookup(f, dim_department, "departemen_id", "departemen_key", how="left")
    return f.withColumn("departemen_key", F.coalesce("departemen_key", F.lit(UNKNOWN_DEPARTMENT)).cast("long"))


def sums(*more: Column) -> list[Column]:
    return [F.sum(m).alias(m) for m in R.MEASURES] + list(more)


def department_day_sum(fact: DataFrame) -> DataFrame:
    """Sums of the measures by date and department; partial sums are made before the shuffle."""
    return fact.groupBy("tanggal", "departemen_key").agg(
        *sums(F.count("*").alias("fact_rows"), F.count_if("perlu_review").alias("review_rows"), F.count_if(~F.col("is_date_final")).alias("nonfinal_rows"))
    )


def department_daily(agg: DataFrame, dim_department: DataFrame, state: DataFrame) -> DataFrame:
    """Department-days with name, rates, completeness and provisional flag."""
    d = dim_department.select(F.col("key").alias("departemen_key"), F.col("source_id").alias("departemen_id"), F.col("name").alias("nama_departemen"))
    complete = R.true(F.col("population_complete") & F.col("curated_delivery_complete"))
    closed = R.true(F.col("is_closed") & F.col("population_complete") & F.col("curated_delivery_complete"))
    provisional = (F.col("review_rows") > 0) | (F.col("nonfinal_rows") > 0) | ~closed
    out = agg.join(d, "departemen_key").join(state, "tanggal", "left").withColumns(R.rates()).withColumns({"is_data_complete": complete, "is_provisional": provisional})
    return out.select("tanggal", "departemen_key", "departemen_id", "nama_departemen", *R.MEASURES, "fact_rows", "review_rows", "nonfinal_rows",
        *R.rates(), "is_data_complete", "is_provisional")


def institution_daily(departments: DataFrame) -> DataFrame:
    """Sums over departments, then rates."""
    counts = [F.sum(c).alias(c) for c in ("fact_rows", "review_rows", "nonfinal_rows")]
    out = departments.groupBy("tanggal").agg(*sums(*counts, F.bool_and("is_data_complete").alias("is_data_complete"), F.bool_or("is_provisional").alias("is_provisional")))
    return out.withColumns(R.rates())


def department_options(dim_department: DataFrame) -> DataFrame:
    """The newest name of each source id, the unknown one included."""
    w = Window.partitionBy("source_id").orderBy(F.col("valid_from").desc(), F.col("key").desc())
    d = dim_department.withColumn("nth", F.row_number().over(w)).where("nth = 1")
    return d.select(F.col("source_id").alias("departemen_id"), F.col("name").alias("nama_departemen"))


def lateness_employee_daily(fact: DataFrame, dim_department: DataFrame, state: DataFrame) -> DataFrame:
    d = dim_department.select(F.col("key").alias("departemen_key"), F.col("name").alias("d_name"))
    closed = R.true(F.col("is_closed") & F.col("population_complete") & F.col("curated_delivery_complete"))
    out = fact.join(d, "departemen_key").join(state, "tanggal", "left")
    return out.select(
        "tanggal", "pegawai_id", "departemen_id", R.label("d_name", "departemen_id").alias("nama_departemen"), "is_employee_active", "lateness_status", "lateness_event_id",
        "lateness_schedule_id", "lateness_reason", "has_excused_checkin", "checkin_event_count",
        (~closed | ~F.col("is_date_final") | F.col("perlu_review")).alias("is_provisional"),
    )


def dirty_partitions(fact: DataFrame, changed: DataFrame, deleted: DataFrame) -> DataFrame:
    """Dates and departments, old and new, of changed and deleted facts."""
    keys = changed.select(*FACT_KEYS).union(deleted.select(*FACT_KEYS)).distinct()
    old = fact.join(keys, FACT_KEYS, "left_semi").select("tanggal", "departemen_key")
    return old.union(changed.select("tanggal", "departemen_key")).distinct()


def rebuild_partitions(fact: DataFrame, dirty: DataFrame, agg: DataFrame) -> DataFrame:
    """Aggregates with the dirty partitions summed anew; those without facts vanish."""
    keys = ["tanggal", "departemen_key"]
    return agg.join(dirty, keys, "left_anti").unionByName(department_day_sum(fact.join(dirty, keys, "left_semi")))


def reset_date_state(state: DataFrame, dirty: DataFrame) -> DataFrame:
    """A correction opens its date again; dates without a state get an open one."""
    days = dirty.select("tanggal").distinct().withColumn("hit", F.lit(True))
    s = state.join(days, "tanggal", "full")
    keep = ~R.true("hit")
    return s.select("tanggal", *((R.true(c) & keep).alias(c) for c in ("population_complete", "curated_delivery_complete", "is_closed")))


def effective_name_refresh(dim: DataFrame, names: DataFrame, start: Column, end: Column) -> DataFrame:
    """Versions that overlap the period [start, end] take the new name where it differs."""
    n = names.select(F.col("source_id"), F.col("name").alias("new_name"))
    overlap = (F.col("valid_from") <= end) & (F.col("valid_to").isNull() | (F.col("valid_to") > start))
    d = dim.join(n, "source_id", "left")
    change = overlap & F.col("new_name").isNotNull() & ~F.col("new_name").eqNullSafe(F.col("name"))
    return d.withColumn("name", F.when(change, F.col("new_name")).otherwise(F.col("name"))).select(*dim.columns)
