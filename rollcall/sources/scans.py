"""Extracts, sinks, calendars, samples and JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import rules as R
from rollcall.sources import export
from rollcall.sources.scratch import VersionedTables, scratch


def raw_extract(source: DataFrame, run_id: str) -> DataFrame:
    return source.withColumns({"extracted_at": F.current_timestamp(), "pipeline_run_id": F.lit(run_id)})


def raw_extract_by_manifest(source: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is in a change list; Spark broadcasts the list if it is small."""
    return source.join(ids.select(key), key, "left_semi")


def append_batch(df: DataFrame, path: str, truncate: bool = False) -> None:
    df.write.mode("overwrite" if truncate else "append").parquet(path)


def master_upsert(new: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """The new snapshot's rows, and the target's rows that it lacks."""
    return new.unionByName(target.join(new.select(key), key, "left_anti"))


def write_csv(df: DataFrame, path: str) -> None:
    """Every value quoted: embedded line ends stay, and an empty text differs from null."""
    df.write.csv(path, header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"', emptyValue="", nullValue="\\N")


def read_csv(spark: SparkSession, path: str, of: T.StructType) -> DataFrame:
    return spark.read.schema(of).csv(path, header=True, multiLine=True, escape='"', emptyValue="", nullValue="\\N")


def json_recordset(df: DataFrame, col: str, of: T.StructType) -> DataFrame:
    """Items of a JSON array as rows; missing keys are null."""
    return df.select(F.inline(F.from_json(col, T.ArrayType(of))))


def json_record(df: DataFrame, col: str, of: T.StructType) -> DataFrame:
    return df.withColumn("_r", F.from_json(col, of)).select("*", "_r.*").drop("_r", col)


def calendar(bounds: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row a day over ``bounds`` (one row of ``first, last``). ``holidays`` has ``id, tanggal, keterangan``; a day may have several."""
    d = F.col("tanggal")
    days = bounds.where("first <= last").select(F.explode(F.sequence("first", "last")).alias("tanggal"))
    iso = F.extract(F.lit("DOW_ISO"), d).cast("int")
    out = days.select(
        d, R.calendar_key(d).alias("key"), F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"), iso.alias("iso_dow"),
        F.weekofyear(d).alias("iso_week"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"), F.quarter(d).alias("quarter"), (iso >= 6).alias("is_weekend"),
    )
    h = holidays.groupBy("tanggal").agg(R.distinct_texts("keterangan").alias("holiday_label"), F.array_sort(F.collect_set("id")).alias("holiday_ids"))
    return out.join(h, "tanggal", "left").withColumn("is_holiday", F.col("holiday_ids").isNotNull())


def calendar_from_facts(incoming: DataFrame, known: DataFrame) -> DataFrame:
    return incoming.select("tanggal").distinct().join(known.select("tanggal"), "tanggal", "left_anti")


def sample_rows(df: DataFrame, percent: float, seed: int = 417) -> DataFrame:
    """A reproducible sample of rows (not of blocks)."""
    return df.sample(fraction=percent / 100, seed=seed)


def sample_blocks(scan: DataFrame, percent: float, seed: int = 417, rows: int = 256) -> DataFrame:
    """A reproducible sample of whole blocks: each ``rows`` consecutive rows of a file stay or go together.

    ``scan`` reads Parquet files. A block is drawn by a hash of its file's name, its number and the seed, so the sample is the same
    however the scan is split. Blocks of a file that aren't drawn are skipped after decoding, not before.
    """
    block = F.floor(F.col("_metadata.row_index") / rows).cast("string")
    drawn = F.conv(F.substr(F.md5(F.concat_ws("/", F.col("_metadata.file_name"), block, F.lit(str(seed)))), F.lit(1), F.lit(8)), 16, 10).cast("double") / float(1 << 32)
    return scan.where(drawn < percent / 100)


def latest_n(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    return df.orderBy(F.desc(key)).limit(n)


def exclude_marked(df: DataFrame, prefixes: list[str], col: str = "keterangan") -> DataFrame:
    out = df
    for p in prefixes:
        out = out.where(~F.startswith(F.coalesce(F.col(col), F.lit("")), F.lit(p)))
    return out


_ITEM = T.StructType([T.StructField("pegawai_id", T.IntegerType()), T.StructField("lateness_status", T.StringType()), T.StructField("absent", T.StringType())])


def _payloads(t) -> DataFrame:
    return t.daily.select("tanggal", F.to_json(F.struct("pegawai_id", "lateness_status")).alias("payload"))


def _items(t) -> DataFrame:
    one = F.struct(F.col("id").alias("pegawai_id"), F.col("nama").alias("lateness_status"))
    return t.m_pegawai.groupBy("departemen").agg(F.to_json(F.collect_list(one)).alias("items"))


_NOTES = "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a' || chr(13) || chr(10) || '\"b\", c' WHEN 3 THEN 'x' || chr(10) ELSE nama END"


def _csv(t) -> DataFrame:
    rows = t.m_pegawai.select("id", F.expr(_NOTES).alias("note"))
    path = scratch(t.spark, "csv")
    write_csv(rows, path)
    return read_csv(t.spark, path, rows.schema)


def _appended(t) -> DataFrame:
    """Two batches appended to a table that a first write had filled with something else."""
    path = scratch(t.spark, "raw")
    append_batch(t.m_user.where("id < 5"), path)
    append_batch(t.m_user.where("id % 2 = 0"), path, truncate=True)
    append_batch(t.m_user.where("id % 3 = 0"), path)
    return t.spark.read.parquet(path)


def _published(t) -> DataFrame:
    """Two versions of two tables; a reader of the first snapshot keeps it."""
    tables = VersionedTables(t.spark, scratch(t.spark, "published"))
    tables.publish({"shift": t.m_shift.select("id", "status"), "schedule": t.m_jadwal.select("id", "jenis")})
    first = tables.snapshot()
    tables.publish({"shift": t.m_shift.where("status").select("id", "status")})
    second = tables.snapshot()
    read = lambda of, paths, label: t.spark.read.parquet(paths[of]).select(F.lit(label).alias("read"), "id")
    return read("shift", first, "shift 1").union(read("shift", second, "shift 2")).union(read("schedule", second, "schedule 1"))


QUERIES = {
    "raw_extract": (lambda t: raw_extract(t.m_jadwal, "run-1").drop("extracted_at"), "SELECT *, 'run-1' AS pipeline_run_id FROM {m_jadwal}"),
    "raw_extract_by_manifest": (lambda t: raw_extract_by_manifest(t.t_checkinout, t.t_perizinan.select("id")).select("id", "checktype"),
        "SELECT id, checktype FROM {t_checkinout} WHERE id IN (SELECT id FROM {t_perizinan})"),
    "project_columns_at_source": (lambda t: t.m_user.select("id", "pegawai_id"), "SELECT id, pegawai_id FROM {m_user}"),
    "master_upsert": (
        lambda t: master_upsert(t.m_pegawai.where("id % 3 = 0").withColumn("nama", F.upper("nama")), t.m_pegawai.where("id % 2 = 0")).select("id", "nama"),
        "SELECT id, CASE WHEN id % 3 = 0 THEN upper(nama) ELSE nama END AS nama FROM {m_pegawai} WHERE id % 3 = 0 OR id % 2 = 0",
    ),
    "profile_export": (export.profile_export, export.PROFILE_EXPORT_SQL),
    "raw_append_batch": (_appended, "SELECT id, pegawai_id FROM {m_user} WHERE id % 2 = 0 UNION ALL SELECT id, pegawai_id FROM {m_user} WHERE id % 3 = 0"),
    "csv_scan_sink": (_csv, f"SELECT id, {_NOTES} AS note FROM {{m_pegawai}}"),
    "versioned_publish": (
        _published, (
            "SELECT 'shift 1' AS read, id FROM {m_shift} UNION ALL SELECT 'shift 2', id FROM {m_shift} WHERE status UNION ALL "
            "SELECT 'schedule 1', id FROM {m_jadwal}"
        )),
    "json_recordset_scan": (lambda t: json_recordset(_items(t), "items", _ITEM),
        "SELECT id AS pegawai_id, nama AS lateness_status, CAST(NULL AS VARCHAR) AS absent FROM {m_pegawai}"),
    "json_record_populate": (lambda t: json_record(_payloads(t), "payload", _ITEM), "SELECT tanggal, pegawai_id, lateness_status, CAST(NULL AS VARCHAR) AS absent FROM {daily}"),
    "calendar_table": (
        lambda t: calendar(t.dates.agg(F.date_sub(F.min("tanggal"), 20).alias("first"), F.date_add(F.max("tanggal"), 40).alias("last")),
            t.m_hari_libur).withColumn("holiday_ids", F.array_join("holiday_ids", ",")),
        """SELECT CAST(d AS DATE) AS tanggal, CAST(strftime(d, '%Y%m%d') AS INT) AS key, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
            CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS iso_dow,
           CAST(week(d) AS INT) AS iso_week, CAST(isoyear(d) AS INT) AS iso_year, CAST(quarter(d) AS INT) AS quarter, isodow(d) >= 6 AS is_weekend,
               holiday_label, holiday_ids, holiday_ids IS NOT NULL AS is_holiday
           FROM (SELECT unnest(generate_series(CAST(min(tanggal) - 20 AS TIMESTAMP), CAST(max(tanggal) + 40 AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM {dates})
           LEFT JOIN (SELECT tanggal AS h, string_agg(DISTINCT keterangan, ';' ORDER BY keterangan) AS holiday_label, string_agg(CAST(id AS VARCHAR),
               ',' ORDER BY id) AS holiday_ids FROM {m_hari_libur} GROUP BY ALL)
             ON h = CAST(d AS DATE)""",
    ),
    "calendar_key": (lambda t: t.dates.select("tanggal", R.calendar_key("tanggal").alias("key")), "SELECT tanggal, CAST(strftime(tanggal, '%Y%m%d') AS INT) AS key FROM {dates}"),
    "period_start": (
        lambda t: t.dates.select("tanggal", *(R.period_start_column(p, "tanggal").alias(f"p_{p}") for p in ("3D", "7D", "1M", "3M", "6M", "1Y"))),
        "SELECT tanggal, tanggal - 2 AS p_3D, tanggal - 6 AS p_7D, " + ", ".join(f"CAST(tanggal - INTERVAL {n} MONTH AS DATE) + 1 AS {p}" for n,
            p in ((1, "p_1M"), (3, "p_3M"), (6, "p_6M"), (12, "p_1Y"))) + " FROM {dates}",
    ),
    "publication_status": (
        lambda t: t.dept.groupBy(R.publication_status("is_provisional").alias("status")).agg(F.count("*").alias("n"), F.sum("fact_rows").alias("fact_rows")),
        (
            "SELECT CASE WHEN is_provisional THEN 'PROVISIONAL' ELSE 'FINAL' END AS status, count(*) AS n, "
            "CAST(sum(fact_rows) AS BIGINT) AS fact_rows FROM {dept} GROUP BY ALL"
        ),
    ),
    "legacy_pair_status": (
        lambda t: t.evday.drop("perlu_review", "alasan_review").join(t.lvsum.select("pegawai_id", "tanggal", "has_valid_leave"), ["pegawai_id", "tanggal"], "full").select(
            "pegawai_id", "tanggal",
            R.legacy_pair_status(F.col("checkin_event_count"), F.col("checkout_event_count"), F.col("first_checkin_at"), F.col("last_checkout_at"),
                F.col("schedule_count"), F.col("has_valid_leave")).alias("status")),
        """SELECT pegawai_id, tanggal, CASE WHEN has_valid_leave THEN 'LEAVE' WHEN checkin_event_count = 1 AND checkout_event_count = 1
            AND last_checkout_at >= first_checkin_at AND schedule_count <= 1 THEN 'PAIRED'
           ELSE 'REVIEW' END AS status FROM {evday} FULL JOIN {lvsum} USING (pegawai_id, tanggal)""",
    ),
    "calendar_from_facts": (lambda t: calendar_from_facts(t.daily, t.dates), "SELECT DISTINCT tanggal FROM {daily} WHERE tanggal NOT IN (SELECT tanggal FROM {dates})"),
    "latest_n_by_id": (lambda t: latest_n(t.t_checkinout, 500).select("id", "checktype"), "SELECT id, checktype FROM {t_checkinout} ORDER BY id DESC LIMIT 500"),
    "exclude_marked_rows": (lambda t: exclude_marked(t.t_checkinout, ["MIGRASI"]).agg(F.count("*").alias("n")),
        "SELECT count(*) AS n FROM {t_checkinout} WHERE NOT starts_with(coalesce(keterangan, ''), 'MIGRASI')"),
    "row_sample": (lambda t: sample_rows(t.t_checkinout, 10.0).select("id"), None),
    "block_sample": (
        lambda t: sample_blocks(t.events, 10.0).select(F.col("event_id").alias("id")),
        """SELECT event_id AS id FROM (SELECT event_id, (row_number() OVER () - 1) // 256 AS block FROM {events})
           WHERE CAST('0x' || left(md5('events.parquet/' || block || '/417'), 8) AS BIGINT) / 4294967296.0 < 0.1""",
    ),
}
