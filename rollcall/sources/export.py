"""The profile export: sections of different shapes as rows of JSON, ordered over a set of files.

A section is a few columns of one source, or counts over it. Rows are sorted by ranges of section and record, so the part
files in the order of their names are the whole export in order, however many tasks write it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sources.scratch import scratch

#: Tables whose sizes are told.
TABLES = ("m_pegawai", "m_departemen", "m_shift", "m_jadwal", "m_user", "m_jenis_ijin", "m_tipe_ijin", "m_hari_libur", "t_libur_shift", "t_checkinout", "t_perizinan")
CSV = {"header": True, "escape": '"', "emptyValue": "", "nullValue": "\\N"}


def pick(df: DataFrame, names: str, **derived) -> DataFrame:
    """Columns by name (``old>new`` renames), then derived ones."""
    pairs = (n.partition(">") for n in names.split())
    return df.select(*(F.col(a).alias(b or a) for a, _, b in pairs), *(c.alias(n) for n, c in derived.items()))


def first(df: DataFrame, by: str, n: int) -> DataFrame:
    return df.orderBy(by).limit(n)


def last(df: DataFrame, n: int, by: str = "id") -> DataFrame:
    return df.orderBy(F.desc(by)).limit(n)


def text(*names: str) -> dict:
    return {n: F.col(n).cast("string") for n in names}


def time_range(df: DataFrame, name: str, at: str, newest: int = 1000) -> DataFrame:
    ends = {f"{f}_time": getattr(F, f)(at).cast("string") for f in ("min", "max")}
    return last(df, newest).agg(*(c.alias(n) for n, c in ends.items())).select(F.lit(name).alias("table_name"), *ends)


def sections(t) -> dict[str, DataFrame]:
    """Each section's rows, by its fixed name, in the order of the export."""
    size = lambda name: t.table(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
    shifts = pick(t.m_shift, "id>_s departemen_id nama>shift_name status>shift_is_active")
    planned = t.m_jadwal.join(shifts, F.col("jenis") == F.col("_s"), "left")
    of_shift = t.m_jadwal.select(F.col("id").alias("_j"), "jenis")
    coverage = t.m_shift.join(of_shift, F.col("id") == F.col("jenis"), "left").groupBy("departemen_id").agg(
        F.count_distinct("id").alias("shift_count"), F.count_distinct("_j").alias("schedule_count"),
        F.count_distinct(F.when(F.col("status"), F.col("id"))).alias("active_shift_count")
    )
    return {
        "database_info": t.region.agg(F.count("*").alias("regions")).select(F.lit("attendance").alias("database_name"), "regions"),
        "table_sizes": reduce(DataFrame.unionByName, map(size, TABLES)),
        "employee_sample": pick(first(t.m_pegawai, "id", 150), "id>pegawai_id departemen>departemen_id status"),
        "employee_status_distribution": t.m_pegawai.groupBy("status").agg(F.count("*").alias("employee_count")),
        "department_sample": pick(first(t.m_departemen, "id", 150), "id>departemen_id nama_departemen parent"),
        "shift_sample": pick(first(t.m_shift, "id", 150), "id>shift_id nama>shift_name status>is_active departemen_id"),
        "schedule_sample": pick(first(planned, "id", 200),
            "id>jadwal_id jenis>shift_id departemen_id shift_name shift_is_active hari jam_masuk jam_keluar jam_masuk_awal jam_keluar_akhir"),
        "user_employee_mapping_sample": pick(first(t.m_user.where("pegawai_id is not null"), "id", 150), "id>user_id pegawai_id"),
        "permission_kind_master": pick(t.m_jenis_ijin, "id>jenis_ijin_id nama tipe_id"),
        "permission_type_master": pick(t.m_tipe_ijin, "id>tipe_ijin_id nama"),
        "public_holidays": pick(t.m_hari_libur, "id", **text("tanggal", "keterangan")),
        "employee_shift_holiday_sample": pick(last(t.t_libur_shift, 100), "id departemen_id pegawai_id", **text("tanggal")),
        "attendance_sample_recent_id": pick(last(t.t_checkinout, 100), "id pegawai_id checktype is_wfh work_code jadwal_id jam_masuk jam_keluar is_manual", **text("created_at")),
        "permission_sample_recent_id": pick(last(t.t_perizinan, 100), "id user_id pegawai_id tipe_ijin jenis_ijin approval", **text("tgl_ijin", "tgl_ijin_sampai")),
        "shift_department_coverage_sample": first(coverage, "departemen_id", 100),
        "transaction_time_ranges": time_range(t.t_checkinout, "t_checkinout", "created_at").unionByName(time_range(t.t_perizinan, "t_perizinan", "tgl_ijin")),
    }


def records(parts: dict[str, DataFrame]) -> DataFrame:
    """``section_no, section, record``: each row as JSON that keeps nulls."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return reduce(DataFrame.unionByName, (df.select(F.lit(i).alias("section_no"), F.lit(name).alias("section"), record.alias("record")) for i, (name,
        df) in enumerate(parts.items(), 1)))


def write_ordered(df: DataFrame, path: str, *order: str, files: int | None = None) -> None:
    """CSV files whose rows, in the order of the files' names, are sorted by ``order``."""
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.csv(path, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **CSV)


def read_ordered(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """The rows of :func:`write_ordered` with ``file``, the name of the part that each came from."""
    rows = spark.read.schema(columns).csv(path, multiLine=True, **CSV)
    return rows.withColumn("file", F.col("_metadata.file_name"))


def profile_export(t, path: str | None = None) -> DataFrame:
    path = path or scratch(t.spark, "export")
    write_ordered(records(sections(t)), path, "section_no", "record")
    return read_ordered(t.spark, path, "section_no INT, section STRING, record STRING").drop("file")


# The same in SQL: each section as a JSON object written out key by key.
def _json(table: str, *pairs: str, tail: str = "") -> str:
    keys = ", ".join(f"'{name}', {value or name}" for value, _, name in (p.rpartition(" AS ") for p in pairs))
    return f"SELECT json_object({keys}) AS record FROM {table} {tail}"


_SHIFT_OF = (
    "(SELECT j.*, s.departemen_id, s.nama AS shift_name, s.status AS shift_is_active FROM {m_jadwal} j LEFT "
    "JOIN {m_shift} s ON s.id = j.jenis ORDER BY j.id LIMIT 200)"
)
_NEWEST = "(SELECT * FROM {%s} ORDER BY id DESC LIMIT %d)"
_FIRST = "(SELECT * FROM {%s} ORDER BY id LIMIT 150)"
_COVER = """(SELECT s.departemen_id, count(DISTINCT s.id) AS a, count(DISTINCT j.id) AS b, count(DISTINCT s.id) FILTER (s.status) AS c
    FROM {m_shift} s LEFT JOIN {m_jadwal} j ON j.jenis = s.id
    GROUP BY s.departemen_id ORDER BY s.departemen_id LIMIT 100)"""
_AS_TEXT = "CAST(%s AS VARCHAR) AS %s"


def _dates(*names: str) -> list[str]:
    return [_AS_TEXT % (n, n) for n in names]


def _range(table: str, at: str) -> str:
    ends = (f"CAST({f}({at}) AS VARCHAR) AS {f}_time" for f in ("min", "max"))
    return _json(_NEWEST % (table, 1000), f"'{table}' AS table_name", *ends)


_SQL = {
    "database_info": _json("{region}", "'attendance' AS database_name", "count(*) AS regions"),
    "table_sizes": " UNION ALL ".join(_json(f"{{{n}}}", f"'{n}' AS table_name", "count(*) AS n") for n in TABLES),
    "employee_sample": _json(_FIRST % "m_pegawai", "id AS pegawai_id", "departemen AS departemen_id", "status"),
    "employee_status_distribution": _json("{m_pegawai}", "status", "count(*) AS employee_count", tail="GROUP BY status"),
    "department_sample": _json(_FIRST % "m_departemen", "id AS departemen_id", "nama_departemen", "parent"),
    "shift_sample": _json(_FIRST % "m_shift", "id AS shift_id", "nama AS shift_name", "status AS is_active", "departemen_id"),
    "schedule_sample": _json(_SHIFT_OF, "id AS jadwal_id", "jenis AS shift_id", "departemen_id", "shift_name", "shift_is_active", "hari", "jam_masuk",
        "jam_keluar", "jam_masuk_awal", "jam_keluar_akhir"),
    "user_employee_mapping_sample": _json(_FIRST % "m_user", "id AS user_id", "pegawai_id"),  # no user lacks an employee
    "permission_kind_master": _json("{m_jenis_ijin}", "id AS jenis_ijin_id", "nama", "tipe_id"),
    "permission_type_master": _json("{m_tipe_ijin}", "id AS tipe_ijin_id", "nama"),
    "public_holidays": _json("{m_hari_libur}", "id", *_dates("tanggal"), "keterangan"),
    "employee_shift_holiday_sample": _json(_NEWEST % ("t_libur_shift", 100), "id", "departemen_id", "pegawai_id", *_dates("tanggal")),
    "attendance_sample_recent_id": _json(
        _NEWEST % ("t_checkinout", 100), "id", "pegawai_id", "checktype", "is_wfh", "work_code", "jadwal_id", "jam_masuk", "jam_keluar", "is_manual", *_dates("created_at")),
    "permission_sample_recent_id": _json(
        _NEWEST % ("t_perizinan", 100), "id", "user_id", "pegawai_id", "tipe_ijin", "jenis_ijin", "approval", *_dates("tgl_ijin", "tgl_ijin_sampai")),
    "shift_department_coverage_sample": _json(_COVER, "departemen_id", "a AS shift_count", "b AS schedule_count", "c AS active_shift_count"),
    "transaction_time_ranges": _range("t_checkinout", "created_at") + " UNION ALL " + _range("t_perizinan", "tgl_ijin"),
}
PROFILE_EXPORT_SQL = " UNION ALL ".join(f"SELECT {i} AS section_no, '{name}' AS section, CAST(record AS VARCHAR) AS record FROM ({sql}) q" for i,
    (name, sql) in enumerate(_SQL.items(), 1))
