"""Distinct people of any period from bitmaps of each date and department, without reading facts.

A bitmap has one bit for each employee of a range of 32,768 numbers. Bitmaps of dates and departments are joined by OR
and counted, so the people of a period, of a department or of both follow from as many small rows as it has days and departments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import rules as R
from rollcall.plans.kpi import optional, period, ranked

UNIT = ["tanggal", "departemen_key", "departemen_id"]


def groups(c=F.col) -> dict[str, Column]:
    """The groups of people that are kept, as conditions of a fact."""
    active, status = c("active_employee_days") == 1, c("lateness_status")
    assessed = R.true("is_employee_active") & ~c("has_excused_checkin")
    known = status.isin("LATE", "ON_TIME")
    return {
        "active": active, "on_leave": active & (c("leave_days") == 1), "late": status == "LATE", "known": known,
        "late_assessed": assessed & (status == "LATE"), "assessed": assessed & known,
        "missing": (c("no_checkin_days") == 1) | (c("no_checkout_days") == 1), **{f"status_{s}": status == s for s in ("LATE", "ON_TIME", "UNKNOWN", "EXCUSED", "NOT_ASSESSED")},
    }


def people_bitmaps(fact: DataFrame) -> DataFrame:
    """``tanggal, departemen_key, departemen_id, kind, bucket, bits``: the people of each group.

    Rows meet as a bit and a mask of kinds before any bitmap is made: bitmaps made where the rows lie would be as many as tasks times
    groups, both of which grow with the data.
    """
    kinds = {n: (1 << i, x) for i, (n, x) in enumerate(groups().items())}
    mask = sum((F.when(x, m).otherwise(0) for m, x in kinds.values()), F.lit(0))
    bucket, bit = F.bitmap_bucket_number("pegawai_id"), F.bitmap_bit_position("pegawai_id")
    rows = fact.where("pegawai_id is not null").select(*UNIT, bucket.alias("bucket"), bit.alias("bit"), mask.alias("mask")).where("mask > 0")
    bits = (F.bitmap_construct_agg(F.when(F.col("mask").bitwiseAND(m) > 0, F.col("bit"))).alias(n) for n, (m, _) in kinds.items())
    wide = rows.repartition(*UNIT, "bucket").groupBy(*UNIT, "bucket").agg(*bits)
    each = F.inline(F.array(*(F.struct(F.lit(n).alias("kind"), F.col(n).alias("bits")) for n in kinds)))
    return wide.select(*UNIT, "bucket", each).where(F.bitmap_count("bits") > 0).select(*UNIT, "kind", "bucket", "bits")


def counted(bitmaps: DataFrame, kinds: list[str], by: list[str]) -> DataFrame:
    """Distinct people of each kind (0 where there are none) by ``by``, over the bitmaps given."""
    ored = bitmaps.where(F.col("kind").isin(kinds)).groupBy(*by, "bucket", "kind").agg(F.bitmap_or_agg("bits").alias("bits"))
    n = F.bitmap_count("bits")
    return ored.groupBy(*by).agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, n)), F.lit(0)).cast("long").alias(k) for k in kinds))


def unique_people(bitmaps: DataFrame, start, end, department: int | None = None) -> DataFrame:
    rows = optional(period(bitmaps, start, end), departemen_id=department)
    return counted(rows, ["active"], []).select(F.col("active").alias("people"))


def missing_people(bitmaps: DataFrame) -> DataFrame:
    return counted(bitmaps, ["missing"], []).select(F.col("missing").alias("people"))


def people_rate(bitmaps: DataFrame, affected: str, eligible: str, by: list[str]) -> DataFrame:
    """Distinct people affected and eligible, and their rate; groups without anybody eligible are left out."""
    out = counted(bitmaps, [affected, eligible], by).select(*by, F.col(affected).alias("affected"), F.col(eligible).alias("eligible"))
    return out.where("eligible > 0").withColumn("rate", R.rate("affected", "eligible", 2))


def lateness_coverage(bitmaps: DataFrame, start, end) -> DataFrame:
    rows = period(bitmaps, start, end).where("kind like 'status%'").groupBy("kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return rows.groupBy(F.substr("kind", F.lit(8)).alias("lateness_status")).agg(F.sum(F.bitmap_count("bits")).cast("long").alias("people"))


def rank_departments(bitmaps: DataFrame, dim_department: DataFrame, affected: str, eligible: str, start, end, department: int | None = None, k: int = 10) -> DataFrame:
    """The first ``k`` departments by the share of distinct people affected."""
    rows = optional(period(bitmaps, start, end), departemen_id=department)
    names = dim_department.select(F.col("key").alias("departemen_key"), F.col("name").alias("d_name"))
    label = F.coalesce(F.max("d_name"), F.lit("UNKNOWN")).alias("department")
    named = rows.select("departemen_key", "departemen_id").distinct().join(names, "departemen_key").groupBy("departemen_id").agg(label).withColumnRenamed("departemen_id", "_id")
    rates = people_rate(rows, affected, eligible, ["departemen_id"])
    return ranked(rates.join(named, F.col("departemen_id").eqNullSafe(F.col("_id"))).drop("_id"), k)
