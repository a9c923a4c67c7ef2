"""Attendance tables derived from the generic test tables, in Spark and as DuckDB SQL.

The attendance operators take tables with the columns of an attendance system: employees,
departments, shifts, schedules, check-in/out events and leave requests. These views give such tables
over the star-schema test data, so that every operator runs at any scale and has SQL to compare with.
Times of day are microseconds since midnight. In the templates, names in braces are tables or
expressions that differ between the two engines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

HOUR = 3_600_000_000

#: Masters, events and leaves read all rows of their tables. Departments 23 and 24 are left out of the master so that some
#: employees' departments are unmapped; schedules come in hundreds, of which the first 20 numbers are their shifts.
VIEWS = {
    "m_departemen": "SELECT CAST(n_nationkey AS INT) AS id, n_name AS nama_departemen, CAST(n_regionkey AS INT) AS parent FROM {nation} WHERE n_nationkey < 23",
    # Units below departments, as a binary tree with units that end a chain early and circles of two and three.
    "m_unit": """
        SELECT CAST(c_custkey AS INT) + 1 AS id,
               CAST(CASE WHEN c_custkey % 101 = 5 THEN c_custkey + 1 WHEN c_custkey % 103 = 7 THEN c_custkey + 2 WHEN c_custkey % 103 = 8 THEN c_custkey
                    WHEN c_custkey % 107 IN (9, 10) THEN c_custkey + 2 WHEN c_custkey % 107 = 11 THEN c_custkey - 1 WHEN c_custkey % 89 = 3 THEN c_custkey + 1000000
                    WHEN c_custkey % 97 = 4 THEN NULL ELSE (c_custkey + 1 - (c_custkey + 1) % 2) / 2 END AS INT) AS parent
        FROM {customer}""",
    "m_pegawai": """
        SELECT CAST(c_custkey AS INT) AS id, c_name AS nama, CAST(c_nationkey AS INT) AS departemen,
               CASE WHEN c_custkey % 29 = 0 THEN 9 WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 WHEN c_mktsegment = 'BUILDING' THEN 2
                    WHEN c_mktsegment = 'FURNITURE' THEN 3 WHEN c_mktsegment = 'MACHINERY' THEN 5 ELSE 4 END AS status,
               TIMESTAMP '2024-01-03 00:00:00' AS created_at
        FROM {customer}""",
    "m_user": """
        SELECT CAST(c_custkey AS INT) AS id, CAST(CASE WHEN c_custkey % 17 = 0 THEN c_custkey + 1 ELSE c_custkey END AS INT) AS pegawai_id
        FROM {customer}""",
    "m_shift": """
        SELECT CAST(p_partkey AS INT) AS id, CASE WHEN p_partkey % 4 = 0 THEN concat('REGULER ', p_brand) ELSE p_name END AS nama,
               CASE WHEN p_partkey % 7 = 3 THEN false WHEN p_partkey % 11 = 5 THEN NULL ELSE true END AS status,
               CAST(p_partkey % 25 AS INT) AS departemen_id
        FROM {part}""",
    "m_jadwal": """
        SELECT CAST(p_partkey AS INT) AS id, CAST(p_partkey - p_partkey % 100 + p_partkey % 20 AS INT) AS jenis,
               CASE p_partkey % 9 WHEN 0 THEN 'Senin' WHEN 1 THEN 'tuesday' WHEN 2 THEN ' Rabu ' WHEN 3 THEN 'Thursday' WHEN 4 THEN 'JUMAT'
                    WHEN 5 THEN 'Sabtu' WHEN 6 THEN 'sunday' WHEN 7 THEN 'kapan' END AS hari,
               CAST(p_partkey % 4 AS INT) - 1 AS is_flexible,
               (5 + p_size % 14) * 3600000000 AS jam_masuk, (4 + p_size % 14) * 3600000000 AS jam_masuk_awal,
               ((13 + p_size % 14) % 24) * 3600000000 AS jam_keluar, ((17 + p_size % 14) % 24) * 3600000000 AS jam_keluar_akhir
        FROM {part}""",
    "t_checkinout": """
        SELECT e.event_id AS id, CAST(CASE WHEN e.event_id % 503 = 7 THEN NULL ELSE e.user_id END AS INT) AS pegawai_id, CAST(e.ts AS TIMESTAMP) AS created_at,
               {tod} AS jam, CASE WHEN e.event_type IN ('click', 'signup') THEN 1 WHEN e.event_type IN ('view', 'purchase') THEN 2 ELSE 9 END AS checktype,
               e.jadwal_id, CASE WHEN e.k % 31 = 30 THEN 99 ELSE e.k % 20 + e.hundred END AS work_code,
               CASE WHEN e.k % 13 = 12 THEN NULL ELSE j.jam_masuk END AS jam_masuk,
               CASE WHEN e.k % 13 = 12 THEN NULL ELSE j.jam_masuk_awal END AS jam_masuk_awal, j.jam_keluar, j.jam_keluar_akhir,
               CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE e.value > 150 END AS is_manual,
               CASE WHEN e.event_id % 5 < 2 THEN NULL ELSE {approval} END AS approval_at,
               CASE WHEN e.event_id % 23 = 0 THEN NULL WHEN e.event_id % 29 = 0 THEN 2 ELSE CAST(e.event_id % 2 AS INT) END AS is_wfh,
               CASE WHEN e.event_id % 7 = 0 THEN NULL WHEN e.event_id % 11 = 0 THEN {later} WHEN e.event_id % 37 = 0 THEN {earlier} ELSE CAST(e.ts AS TIMESTAMP) END AS updated_at,
               CASE WHEN e.event_id % 41 = 0 THEN 'MIGRASI lama' WHEN e.event_id % 3 = 0 THEN NULL ELSE 'ok' END AS keterangan
        FROM (SELECT *, CAST(CASE WHEN k >= 95 THEN NULL WHEN k >= 90 THEN -k ELSE k + hundred END AS INT) AS jadwal_id
              FROM (SELECT *, {k} AS k, CAST(user_id % 2 * 100 AS INT) AS hundred FROM {events}) x) e
        LEFT JOIN {m_jadwal} j ON j.id = e.jadwal_id""",
    "m_jenis_ijin": "SELECT CAST(r_regionkey AS INT) AS id, r_name AS nama, CAST(r_regionkey % 2 AS INT) AS tipe_id FROM {region}",
    "m_tipe_ijin": "SELECT CAST(r_regionkey AS INT) AS id, CASE r_regionkey WHEN 0 THEN 'SICK' ELSE 'DUTY' END AS nama FROM {region} WHERE r_regionkey < 2",
    "m_previleges": "SELECT CAST(r_regionkey AS INT) + 1 AS id, concat('Kategori ', r_name) AS previleges FROM {region} WHERE r_regionkey < 4",
    "m_hari_libur": "SELECT CAST(n_nationkey AS INT) AS id, {holiday} AS tanggal, concat('Libur ', n_name) AS keterangan FROM {nation} WHERE n_nationkey % 3 = 0",
    "t_libur_shift": "SELECT CAST(s_suppkey AS INT) AS id, s_nationkey AS departemen_id, CAST(s_suppkey AS INT) AS pegawai_id, {off} AS tanggal FROM {supplier}",
    "t_perizinan": """
        SELECT CAST(o_orderkey AS INT) AS id, CAST(CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS INT) AS pegawai_id,
               CAST(o_custkey AS INT) AS user_id,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 99 END AS tipe_ijin,
               CAST(o_orderkey % 6 AS INT) AS jenis_ijin, o_orderstatus = 'F' AS approval, {leave_from} AS tgl_ijin,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {leave_to} END AS tgl_ijin_sampai
        FROM {orders}""",
}

#: Expressions that the engines write differently.
SPARK = {
    "tod": "hour(e.ts) * 3600000000 + CAST(minute(e.ts) AS BIGINT) * 60000000 + CAST(extract(SECOND FROM e.ts) * 1000000 AS BIGINT)",
    "k": "CAST(get_json_object(props, '$.k') AS INT)",
    "approval": "CAST(e.ts AS TIMESTAMP) + make_dt_interval(CAST(e.event_id % 4 AS INT) - 1)",
    "later": "CAST(e.ts AS TIMESTAMP) + make_dt_interval(1)",
    "earlier": "CAST(e.ts AS TIMESTAMP) - make_dt_interval(1)",
    "holiday": "date_add(DATE '2024-01-01', CAST(n_nationkey % 8 AS INT))",
    "off": "date_add(DATE '2024-01-01', CAST(s_suppkey % 30 AS INT))",
    "leave_from": "date_add(DATE '2024-01-01', CAST((7 * o_orderkey) % 30 AS INT))",
    "leave_to": "date_add(DATE '2024-01-01', CAST((7 * o_orderkey) % 30 + o_orderkey % 4 - 1 AS INT))",
}
DUCKDB = {
    "tod": "hour(e.ts) * 3600000000 + minute(e.ts) * 60000000 + microsecond(e.ts)",
    "k": "CAST(json_extract_string(props, '$.k') AS INT)",
    "approval": "CAST(e.ts AS TIMESTAMP) + to_days(CAST(e.event_id % 4 AS INT) - 1)",
    "later": "CAST(e.ts AS TIMESTAMP) + to_days(1)",
    "earlier": "CAST(e.ts AS TIMESTAMP) - to_days(1)",
    "holiday": "DATE '2024-01-01' + CAST(n_nationkey % 8 AS INT)",
    "off": "DATE '2024-01-01' + CAST(s_suppkey % 30 AS INT)",
    "leave_from": "DATE '2024-01-01' + CAST((7 * o_orderkey) % 30 AS INT)",
    "leave_to": "DATE '2024-01-01' + CAST((7 * o_orderkey) % 30 + o_orderkey % 4 - 1 AS INT)",
}
_NAME = re.compile(r"\{(\w+)\}")


class Source:
    """Tables of a folder by name: attendance views, and the test tables beneath them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name in VIEWS:
                sql = _NAME.sub(lambda m: SPARK.get(m[1], m[0]), VIEWS[name])
                self._tables[name] = self.spark.sql(sql, **{n: self._beneath(n) for n in _NAME.findall(sql)})
            else:
                self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def _beneath(self, name: str) -> DataFrame:
        """A table as part of a view; a view that another one joins grows with the data and is never broadcast."""
        return self.table(name).hint("shuffle_hash") if name in VIEWS else self.table(name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)


def duckdb_sql(sql: str, views: dict[str, str]) -> str:
    """``sql`` with the views it names in braces, and those beneath them, as common table expressions."""
    need: dict[str, str] = {}

    def visit(text: str) -> str:
        text = _NAME.sub(lambda m: DUCKDB.get(m[1], m[0]), text)
        for n in _NAME.findall(text):
            if n in views and n not in need:
                body = visit(views[n])
                need[n] = body
        return _NAME.sub(lambda m: m[1], text)

    body = visit(sql).strip()
    if not need:
        return body
    ctes = ",\n".join(f"{n} AS ({b.strip()})" for n, b in need.items())
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    return f"WITH {ctes},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes}\n{body}"
