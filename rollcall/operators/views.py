"""Views over the sources: event, employee and dimension records, manifest and schedule joins, ids of lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import rules as R
from rollcall.operators.relational import first_by, usable_schedules

#: Fixed labels of codes.
CATEGORY = {1: "PNS", 2: "PTT", 3: "PPPK", 4: "PPPK PW"}
SEX = {1: "L", 2: "P"}
KIND = {1: "Masuk", 2: "Keluar"}
PLATFORM = {"1": "Android", "2": "iOS"}


def decode(code: Column | str, labels: dict, other: str) -> Column:
    """The label of a code; ``other`` for unknown codes and null."""
    table = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.col(code) if isinstance(code, str) else code), F.lit(other))


def attendance_detail(events: DataFrame, pegawai: DataFrame, departemen: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Events of [start, end) with employee and department, codes decoded, the identifier masked, in order of time.

    Events without an employee or a department don't appear. The period reaches the scan of the events.
    """
    p = pegawai.select(F.col("id").alias("pegawai_id"), "nip", "nama", "status", "jenis_kelamin", "other_attr", F.col("departemen").alias("_d"))
    d = departemen.select(F.col("id").alias("_d"), F.col("kode").alias("kode_departemen"), F.col("kode_lengkap").alias("departemen"))
    e = events.where((F.col("created_at") >= F.lit(start)) & (F.col("created_at") < F.lit(end))).join(p, "pegawai_id").join(d, "_d")
    return e.select(
        F.to_date("created_at").alias("tanggal"), F.col("created_at").alias("waktu_absen"), R.mask_identifier("nip").alias("nip"), "nama", "pegawai_id",
        decode("status", CATEGORY, "Tidak Diketahui").alias("status"), decode("jenis_kelamin", SEX, "-").alias("jenis_kelamin"), "kode_departemen", "departemen",
        decode("checktype", KIND, "Lainnya").alias("jenis_absen"), "work_code", "jadwal_id", "jam_masuk", "jam_keluar", "jam_masuk_awal", "jam_keluar_akhir", "is_wfh", "is_manual",
        decode("other_attr", PLATFORM, "-").alias("platform"),
    ).orderBy("waktu_absen", "nama", "jenis_absen")


def employee_view(pegawai: DataFrame, departemen: DataFrame, categories: DataFrame) -> DataFrame:
    """Employees with the department's codes and the name of their category; those without either don't appear."""
    d = departemen.select(F.col("id").alias("departemen"), "kode", "kode_lengkap")
    c = categories.select(F.col("id").alias("status"), "previleges")
    return pegawai.join(d, "departemen").join(c, "status").select(F.col("id").alias("pegawai_id"), "nip", "nama", "kode", "kode_lengkap", "previleges")


def dim_department(departemen: DataFrame) -> DataFrame:
    """Departments as they are in the source; a parent of 0 or null stays for the audit of references."""
    return departemen.select(F.col("id").alias("departemen_id_sumber"), F.col("kode").alias("kode_departemen"), "nama_departemen", "kode_lengkap",
        F.col("parent").alias("parent_id_sumber"))


def dim_employee(pegawai: DataFrame, categories: DataFrame, departments: DataFrame) -> DataFrame:
    """All employees with category label and department key where there are any; whether one is active stays null."""
    c = categories.select(F.col("id").alias("status"), F.col("previleges").alias("kategori_pegawai"))
    d = departments.where("valid_to is null").select(F.col("source_id").alias("departemen"), F.col("key").alias("departemen_key"))
    rows = pegawai.join(c, "status", "left").join(d, "departemen", "left")
    return rows.select(
        F.col("id").alias("pegawai_id_sumber"), "nip", "nama", F.col("departemen").alias("departemen_id_sumber"), "departemen_key",
        F.col("status").alias("kategori_id_sumber"), "kategori_pegawai",
        F.col("jenis_kelamin").alias("jenis_kelamin_kode"), F.col("created_at").alias("source_created_at"), F.lit(None).cast("boolean").alias("status_aktif"),
    )


def dim_leave_kind(jenis: DataFrame, tipe: DataFrame) -> DataFrame:
    """Leave kinds with the name of their type where there is one."""
    t = tipe.select(F.col("id").alias("tipe_id"), F.col("nama").alias("nama_tipe_izin"))
    return jenis.join(t, "tipe_id", "left").select(F.col("id").alias("jenis_izin_id_sumber"), F.col("nama").alias("nama_jenis_izin"),
        F.col("tipe_id").alias("tipe_izin_id_sumber"), "nama_tipe_izin")


def join_manifest(raw: DataFrame, items: DataFrame, entity: str) -> DataFrame:
    """Raw rows that a batch lists as upserts of an entity; an id that is listed twice counts once."""
    mine = items.where((F.col("entity") == entity) & (F.col("operation") == "UPSERT")).select(F.col("source_id").alias("id"))
    return raw.join(mine, "id", "left_semi")


def schedule_for_day(pegawai: DataFrame, jadwal: DataFrame, shift: DataFrame, day: dt.date) -> DataFrame:
    """Employees with their department's usable schedule of the day's weekday; without one the schedule is null.

    Of several schedules of a department and weekday the one that starts first counts, then that of the smaller id.
    """
    usable = first_by(usable_schedules(jadwal, shift).where(F.col("iso_dow") == day.isoweekday()), ["departemen_id"], F.col("jam_masuk"), F.col("id"))
    s = usable.select(F.col("departemen_id").alias("departemen"), F.col("id").alias("schedule_id"), "jam_masuk", "jam_keluar")
    return pegawai.join(s, "departemen", "left").select(F.col("id").alias("pegawai_id"), "departemen", "schedule_id", "jam_masuk", "jam_keluar")


def array_to_rows(df: DataFrame, col: str, name: str) -> DataFrame:
    """The distinct items of all lists in a column, one row each; nulls and empty lists give none."""
    return df.select(F.explode(F.array_distinct(col)).alias(name)).where(F.col(name).isNotNull()).distinct()


# ---------------------------------------------------------------------------- the views over the test tables

_CODE = "CASE WHEN id % 9 = 8 THEN concat('HAPUS', nama_departemen) ELSE concat(substr(nama_departemen, 1, 3), '.', CAST(id AS STRING)) END"
_UNITS = f"SELECT id, nama_departemen, parent, {_CODE} AS kode, concat(substr(nama_departemen, 1, 1), ' - ', nama_departemen) AS kode_lengkap FROM {{m_departemen}}"
_STAFF = """SELECT id, nama, departemen, status, created_at, lpad(CAST(id * 7919 AS STRING), 18, '19') AS nip, CASE WHEN id % 5 < 3 THEN id % 5 END AS jenis_kelamin,
    CASE WHEN id % 4 > 0 THEN CAST(id % 4 AS STRING) END AS other_attr FROM {m_pegawai}"""
#: The same for Spark with a product that no number of an employee overflows; an INT one ends at employee 271,181.
_WIDE_STAFF = _STAFF.replace("id * 7919", "CAST(id AS BIGINT) * 7919")
_MANIFEST = """SELECT id AS source_id, CASE WHEN id % 3 = 0 THEN 'LEAVE' ELSE 'EVENT' END AS entity, CASE WHEN id % 7 = 0 THEN 'DELETE'
    ELSE 'UPSERT' END AS operation FROM {t_perizinan}
    UNION ALL SELECT id, 'EVENT', 'UPSERT' FROM {t_perizinan} WHERE id % 10 = 1"""
_START, _END, _MONDAY = dt.date(2024, 1, 5), dt.date(2024, 1, 20), dt.date(2024, 1, 8)


def _units(t) -> DataFrame:
    return t.spark.sql(_UNITS, m_departemen=t.m_departemen)


def _staff(t) -> DataFrame:
    return t.spark.sql(_WIDE_STAFF, m_pegawai=t.m_pegawai)


def _case(of: str, labels: dict, other: str) -> str:
    quoted = {k if isinstance(k, int) else f"'{k}'": v for k, v in labels.items()}
    return f"CASE {of} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in quoted.items()) + f" ELSE '{other}' END"


QUERIES = {
    "attendance_detail_view": (
        lambda t: attendance_detail(t.t_checkinout, _staff(t), _units(t), _START, _END),
        f"""SELECT CAST(e.created_at AS DATE) AS tanggal, e.created_at AS waktu_absen, concat(substr(nip, 1, length(nip) - 5), '*****') AS nip, nama,
            pegawai_id, {_case('p.status', CATEGORY, 'Tidak Diketahui')} AS status,
            {_case('jenis_kelamin', SEX, '-')} AS jenis_kelamin, kode AS kode_departemen, kode_lengkap AS departemen,
                {_case('checktype', KIND, 'Lainnya')} AS jenis_absen, work_code, jadwal_id, jam_masuk, jam_keluar,
            jam_masuk_awal, jam_keluar_akhir, is_wfh, is_manual, {_case('other_attr', PLATFORM, '-')} AS platform
            FROM {{t_checkinout}} e JOIN ({_STAFF}) p ON p.id = e.pegawai_id JOIN ({_UNITS}) d ON d.id = p.departemen
            WHERE e.created_at >= TIMESTAMP '{_START} 00:00:00' AND e.created_at < TIMESTAMP '{_END} 00:00:00'""",
    ),
    "employee_view": (
        lambda t: employee_view(_staff(t), _units(t), t.m_previleges),
        (
            f"SELECT p.id AS pegawai_id, nip, nama, kode, kode_lengkap, previleges FROM ({_STAFF}) p, ({_UNITS}) d, {{m_previleges}} c "
            f"WHERE d.id = p.departemen AND c.id = p.status"
        ),
    ),
    "dim_department": (lambda t: dim_department(_units(t)),
        f"SELECT id AS departemen_id_sumber, kode AS kode_departemen, nama_departemen, kode_lengkap, parent AS parent_id_sumber FROM ({_UNITS})"),
    "dim_employee": (
        lambda t: dim_employee(_staff(t), t.m_previleges, t.dim_departemen),
        f"""SELECT p.id AS pegawai_id_sumber, nip, nama, departemen AS departemen_id_sumber, m.key AS departemen_key, status AS kategori_id_sumber,
            previleges AS kategori_pegawai, jenis_kelamin AS jenis_kelamin_kode,
            created_at AS source_created_at, CAST(NULL AS BOOLEAN) AS status_aktif FROM ({_STAFF}) p LEFT JOIN {{m_previleges}} c ON c.id = p.status
            LEFT JOIN {{dim_departemen}} m ON m.source_id = p.departemen AND m.valid_to IS NULL""",
    ),
    "dim_leave_kind": (
        lambda t: dim_leave_kind(t.m_jenis_ijin, t.m_tipe_ijin),
        (
            "SELECT j.id AS jenis_izin_id_sumber, j.nama AS nama_jenis_izin, j.tipe_id AS tipe_izin_id_sumber, "
            "k.nama AS nama_tipe_izin FROM {m_jenis_ijin} j LEFT JOIN {m_tipe_ijin} k ON k.id = j.tipe_id"
        ),
    ),
    "join_manifest_inner": (
        lambda t: join_manifest(t.t_checkinout, t.spark.sql(_MANIFEST, t_perizinan=t.t_perizinan), "EVENT").select("id", "pegawai_id", "checktype"),
        f"SELECT id, pegawai_id, checktype FROM {{t_checkinout}} WHERE id IN (SELECT source_id FROM ({_MANIFEST}) WHERE entity = 'EVENT' AND operation = 'UPSERT')",
    ),
    "schedule_for_day": (
        lambda t: schedule_for_day(t.m_pegawai, t.m_jadwal, t.m_shift, _MONDAY),
        """SELECT p.id AS pegawai_id, departemen, schedule_id, jam_masuk, jam_keluar FROM {m_pegawai} p LEFT JOIN
           (SELECT DISTINCT ON (departemen_id) departemen_id, j.id AS schedule_id, jam_masuk, jam_keluar FROM {m_jadwal} j JOIN {m_shift} s ON s.id = j.jenis AND s.status
            WHERE lower(trim(hari)) IN ('senin', 'monday') AND jam_masuk_awal <= jam_masuk AND jam_masuk < jam_keluar
                AND jam_keluar <= jam_keluar_akhir AND jam_masuk <= 79200000000
            ORDER BY departemen_id, jam_masuk, j.id) u ON u.departemen_id = p.departemen""",
    ),
    "array_to_rows": (
        lambda t: array_to_rows(t.t_checkinout.groupBy("checktype").agg(F.collect_list("jadwal_id").alias("ids")), "ids", "jadwal_id"),
        "SELECT DISTINCT jadwal_id FROM {t_checkinout} WHERE jadwal_id IS NOT NULL",
    ),
}
