"""Data quality: each check returns the rows that violate it, so an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import rules as R

KEYS = ["pegawai_id", "tanggal"]
IDENTITIES = (
    "active_employee_days <> required_checkin_days + excused_checkin_days", "active_employee_days <> required_checkout_days + excused_checkout_days",
    "required_checkin_days <> required_checkin_present_days + no_checkin_days", "required_checkout_days <> required_checkout_present_days + no_checkout_days",
)
BOUNDS = (*IDENTITIES, "leave_days < 0", "leave_days > active_employee_days", "checkin_days < required_checkin_present_days", "checkin_days > active_employee_days")
ROWS = (
    "has_masuk <> (checkin_event_count > 0)", "has_masuk <> (first_checkin_at is not null)", "has_pulang <> (last_checkout_at is not null)",
    "has_full_day_leave and not has_valid_leave",
    "has_partial_day_leave and not has_valid_leave", "has_full_day_leave and not (has_excused_checkin and has_excused_checkout)",
)


def violations(df: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    return df.where(" or ".join(f"({r})" for r in rules))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def fingerprint(df: DataFrame, cols: list[str], by: str) -> DataFrame:
    """Rows and an order-free hash for each group: numbers from the rows' md5 add up across tasks, in any engine.

    Values are joined as text, null as a mark of its own.
    """
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols))
    number = F.conv(F.substr(F.md5(text), F.lit(1), F.lit(15)), 16, 10).cast("decimal(20,0)")
    return df.groupBy(by).agg(F.count("*").alias("n"), F.sum(number).cast("string").alias("hash"))


def reconcile_departments(fact: DataFrame, agg: DataFrame, dim: DataFrame) -> DataFrame:
    """Department-days whose stored sums differ from sums of the facts' own flags, each with the side it is from.

    The measures are derived from the flags again, not taken from the facts' measure columns.
    """
    a, came, left = F.coalesce("is_employee_active", F.lit(False)), F.col("has_masuk"), F.col("has_pulang")
    free_in, free_out = F.col("has_excused_checkin"), F.col("has_excused_checkout")
    derived = {
        "active_employee_days": a, "checkin_days": a & came, "checkout_days": a & left, "no_checkin_days": a & ~free_in & ~came,
        "no_checkout_days": a & ~free_out & ~left, "leave_days": a & F.col("has_valid_leave"),
        "required_checkin_days": a & ~free_in, "required_checkout_days": a & ~free_out, "excused_checkin_days": a & free_in, "excused_checkout_days": a & free_out,
        "required_checkin_present_days": a & ~free_in & came, "required_checkout_present_days": a & ~free_out & left,
    }
    keys = ["tanggal", "departemen_key"]
    mine = fact.groupBy(*keys).agg(*(F.count_if(c).alias(n) for n, c in derived.items()), F.count("*").alias("fact_rows"))
    stored = agg.select(*keys, *(F.col(c).cast("long").alias(c) for c in [*derived, "fact_rows"]))
    wrong = mine.exceptAll(stored).withColumn("side", F.lit("derived")).unionByName(stored.exceptAll(mine).withColumn("side", F.lit("stored")))
    return wrong.join(dim.select(F.col("key").alias("departemen_key"), F.col("source_id").alias("departemen_id")), "departemen_key", "left")


def dimension_lookup_valid(fact: DataFrame, dim_employee: DataFrame, dim_department: DataFrame) -> DataFrame:
    """Facts whose keys name a dimension row of another source id, or one that isn't in force on the fact's day, or none."""
    out = fact
    for name, dim in (("pegawai", dim_employee), ("departemen", dim_department)):
        d = dim.select(F.col("key").alias(f"{name}_key"), F.col("source_id").alias(f"_{name}"), F.col("valid_from").alias(f"{name}_from"),
            F.col("valid_to").alias(f"{name}_to"), F.lit(True).alias(f"{name}_here"))
        out = out.join(d, f"{name}_key", "left")
    bad = {}
    for name in ("pegawai", "departemen"):
        day, start, end = F.col("tanggal"), F.col(f"{name}_from"), F.col(f"{name}_to")
        same = F.col(f"_{name}").eqNullSafe(F.col(f"{name}_id"))
        if name == "departemen":  # the unknown member stands for every id without a version
            same = same | (F.col("departemen_key") == 0)
        bad[name] = ~(F.coalesce(f"{name}_here", F.lit(False)) & same & F.coalesce(day >= start, F.lit(False)) & (end.isNull() | (day < end)))
    out = out.select(*KEYS, *(c.alias(f"{name}_wrong") for name, c in bad.items()))
    return out.where("pegawai_wrong or departemen_wrong")


def cohort_coverage(daily: DataFrame, cohort: DataFrame, keys: list[str]) -> DataFrame:
    missing = cohort.select(*keys).join(daily.select(*keys), keys, "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(daily.select(*keys).join(cohort.select(*keys), keys, "left_anti").withColumn("side", F.lit("extra")))


def population_match(daily: DataFrame, population: DataFrame) -> DataFrame:
    p = population.select(*KEYS, F.col("departemen_id").alias("p_dep"), F.col("is_employee_active").alias("p_active"))
    same = F.col("departemen_id").eqNullSafe(F.col("p_dep")) & F.col("is_employee_active").eqNullSafe(F.col("p_active"))
    return daily.join(p, KEYS).where(~same).select(*KEYS)


# The test tables keep all rules, so each check looks at a copy in which some rows break them.
_HIT = "pegawai_id % 11 = 3"


def _broken_daily(t) -> DataFrame:
    return t.daily.withColumn("no_checkin_days", F.expr(f"CASE WHEN {_HIT} THEN no_checkin_days + 1 ELSE no_checkin_days END"))


def _broken_agg(t) -> DataFrame:
    return t.agg.withColumn("checkin_days", F.expr("CASE WHEN departemen_key % 8 = 3 THEN checkin_days + 1000 ELSE checkin_days END"))


def _broken_fact(t) -> DataFrame:
    return t.fact.withColumn("has_masuk", F.expr(f"CASE WHEN {_HIT} THEN NOT has_masuk ELSE has_masuk END"))


def _broken_keys(t) -> DataFrame:
    """Some facts point to the department's other version, some to an employee that isn't theirs."""
    return t.fact.withColumns({
        "departemen_key": F.expr("CASE WHEN pegawai_id % 13 = 5 AND departemen_key > 0 THEN departemen_key + 1 ELSE departemen_key END"),
        "pegawai_key": F.expr("CASE WHEN pegawai_id % 17 = 2 THEN pegawai_key + 1 ELSE pegawai_key END"),
    })


def _twice(t) -> DataFrame:
    """Facts' keys, those of some employees twice; the facts are computed once."""
    copies = F.when(F.col("pegawai_id") % 9 == 4, F.lit(2)).otherwise(F.lit(1))
    return t.fact.select(*KEYS, F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select(*KEYS)


def _pair(t) -> DataFrame:
    cols = ["pegawai_id", "tanggal", "departemen_id", "lateness_status", "lateness_event_id", "leave_days", "checkin_days", "alasan_review"]
    a = fingerprint(t.daily.join(t.fact.select(*KEYS), KEYS, "left_semi"), cols, "tanggal")
    b = fingerprint(t.fact.where("tanggal < DATE '2024-01-20' or pegawai_id <> 21"), cols, "tanggal").withColumnsRenamed({"n": "other_n", "hash": "other_hash"})
    return a.join(b, "tanggal").select("tanggal", "n", "hash", "other_n", (F.col("hash") == F.col("other_hash")).alias("equal"))


_TEXT = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in ("pegawai_id", "tanggal", "departemen_id", "lateness_status",
    "lateness_event_id", "leave_days", "checkin_days", "alasan_review")) + ")"
_PRINT = f"SELECT tanggal, count(*) AS n, CAST(sum(CAST('0x' || substr(md5({_TEXT}), 1, 15) AS HUGEINT)) AS VARCHAR) AS hash FROM {{fact}} %s GROUP BY tanggal"
_COUNTS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in R.MEASURES)
_STORED = "SELECT tanggal, departemen_key, " + ", ".join("CASE WHEN departemen_key % 8 = 3 THEN checkin_days + 1000 ELSE checkin_days END AS checkin_days" if m == "checkin_days" else m for m in R.MEASURES) + ", fact_rows FROM {agg}"
_OWN = f"SELECT tanggal, departemen_key, {_COUNTS}, count(*) AS fact_rows FROM {{fact}} GROUP BY ALL"
_MOVED_AGG = "SELECT * REPLACE (CASE WHEN departemen_key % 8 = 3 THEN checkin_days + 1000 ELSE checkin_days END AS checkin_days) FROM {agg}"
_MOVED_KEYS = """SELECT * REPLACE (CASE WHEN pegawai_id % 13 = 5 AND departemen_key > 0 THEN departemen_key + 1 ELSE departemen_key END AS departemen_key,
    CASE WHEN pegawai_id % 17 = 2 THEN pegawai_key + 1 ELSE pegawai_key END AS pegawai_key) FROM {fact}"""


def _in_force(dim: str, key: str, of: str, any_of: str = "false") -> str:
    return (
        f"NOT EXISTS (SELECT 1 FROM {{{dim}}} d WHERE d.key = f.{key} AND (d.source_id IS NOT DISTINCT FROM f.{of} OR {any_of}) "
        f"AND f.tanggal >= d.valid_from AND (d.valid_to IS NULL OR f.tanggal < d.valid_to))"
    )


QUERIES = {
    "kpi_identities": (
        lambda t: violations(_broken_daily(t), IDENTITIES).select(*KEYS),
        f"SELECT pegawai_id, tanggal FROM (SELECT * REPLACE (no_checkin_days + ({_HIT})::INT AS no_checkin_days) FROM {{daily}}) WHERE " + " OR ".join(IDENTITIES),
    ),
    "aggregate_bounds": (lambda t: violations(_broken_agg(t), BOUNDS).select("tanggal", "departemen_key"),
        f"SELECT tanggal, departemen_key FROM ({_MOVED_AGG}) WHERE " + " OR ".join(BOUNDS)),
    "row_constraints": (
        lambda t: violations(_broken_fact(t), ROWS).select(*KEYS),
        f"SELECT pegawai_id, tanggal FROM (SELECT * REPLACE (has_masuk <> ({_HIT}) AS has_masuk) FROM {{fact}}) WHERE " + " OR ".join(f"({r})" for r in ROWS)),
    "grain_unique": (
        lambda t: duplicates(_twice(t), KEYS),
        (
            "SELECT pegawai_id, tanggal, count(*) AS n FROM (SELECT pegawai_id, tanggal FROM {fact} UNION ALL SELECT pegawai_id, "
            "tanggal FROM {fact} WHERE pegawai_id % 9 = 4) GROUP BY ALL HAVING count(*) > 1"
        ),
    ),
    "population_match": (
        lambda t: population_match(t.daily.withColumn("departemen_id", F.expr(f"CASE WHEN {_HIT} THEN NULL ELSE departemen_id END")), t.pop),
        (
            f"SELECT d.pegawai_id, d.tanggal FROM {{daily}} d JOIN {{pop}} p USING (pegawai_id, tanggal) WHERE (CASE "
            f"WHEN d.{_HIT} THEN NULL ELSE d.departemen_id END) IS DISTINCT FROM p.departemen_id OR d.is_employee_active IS DISTINCT "
            f"FROM p.is_employee_active"
        ),
    ),
    "fingerprint": (
        _pair,
        (
            f"SELECT tanggal, a.n, a.hash, b.n AS other_n, a.hash = b.hash AS equal FROM ({_PRINT % ''}) a "
            f"JOIN ({_PRINT % "WHERE tanggal < DATE '2024-01-20' OR pegawai_id <> 21"}) b USING (tanggal)"
        ),
    ),
    "reconcile_departments": (
        lambda t: reconcile_departments(t.fact, _broken_agg(t), t.dim_departemen),
        f"""SELECT x.*, d.source_id AS departemen_id FROM (SELECT *, 'derived' AS side FROM ({_OWN} EXCEPT ALL {_STORED}) UNION ALL SELECT *, 'stored'
            FROM ({_STORED} EXCEPT ALL {_OWN})) x
            LEFT JOIN {{dim_departemen}} d ON d.key = x.departemen_key""",
    ),
    "dimension_lookup_valid": (
        lambda t: dimension_lookup_valid(_broken_keys(t), t.dim_pegawai, t.dim_departemen),
        f"""SELECT * FROM (SELECT pegawai_id, tanggal, {_in_force('dim_pegawai', 'pegawai_key', 'pegawai_id')} AS pegawai_wrong,
            {_in_force('dim_departemen', 'departemen_key', 'departemen_id', 'd.key = 0')} AS departemen_wrong
            FROM ({_MOVED_KEYS}) f) WHERE pegawai_wrong OR departemen_wrong""",
    ),
    "cohort_coverage": (lambda t: cohort_coverage(t.evday, t.pop, KEYS),
        (
            "SELECT *, 'missing' AS side FROM (SELECT pegawai_id, tanggal FROM {pop} EXCEPT SELECT pegawai_id, tanggal FROM {evday}) "
            "UNION ALL SELECT *, 'extra' FROM (SELECT pegawai_id, tanggal FROM {evday} EXCEPT SELECT pegawai_id, tanggal FROM {pop})"
        )),
}
