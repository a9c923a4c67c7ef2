"""The whole chain of tables over one source: source views, curated tables, mart tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import curated, mart, people, search
from rollcall.sources.adapters import Source
from rollcall.sources.scratch import VersionedTables, code_state, shared_folder, source_state


#: Employees whose records of all dates one task takes: half a million records of a month.
EMPLOYEES_A_TASK = 15_000


class Tables(Source):
    """Lazily built DataFrames; asking for one builds the plan of what it needs and runs nothing but a count of the employees' file."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)

    @cached_property
    def parts(self) -> int | None:
        """Tasks among which employees' records are dealt, where the session's own number would give a task too many."""
        need = -(-self.table("customer").count() // EMPLOYEES_A_TASK)
        return need if need > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else None

    def dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        """``df`` by its keys in :attr:`parts` partitions; as it is where Spark's own number will do."""
        return df if self.parts is None else df.repartition(self.parts, *keys)

    @cached_property
    def ev(self) -> DataFrame:
        return curated.event_enrich(self.t_checkinout, self.m_jadwal, self.m_shift)

    @cached_property
    def dates(self) -> DataFrame:
        return self.t_checkinout.select(F.to_date("created_at").alias("tanggal")).distinct()

    @cached_property
    def pop(self) -> DataFrame:
        return curated.population_snapshot(self.m_pegawai, self.m_departemen, self.dates)

    @cached_property
    def lv(self) -> DataFrame:
        return curated.leave_validate(self.t_perizinan, self.m_user, self.m_jenis_ijin, self.m_tipe_ijin)

    @cached_property
    def lvday(self) -> DataFrame:
        return curated.leave_expand(self.lv)

    @cached_property
    def evday(self) -> DataFrame:
        return curated.event_daily(self.ev)

    @cached_property
    def lvsum(self) -> DataFrame:
        return curated.leave_daily(self.lvday)

    @cached_property
    def opened(self) -> DataFrame:
        return curated.unresolved_daily(self.ev)

    @cached_property
    def daily(self) -> DataFrame:
        by_leave = curated.leave_daily(self.dealt(self.lvday, *curated.KEYS))
        return curated.unified_daily(self.dealt(self.pop, *curated.KEYS), self.dealt(self.ev, "pegawai_id", "tanggal_event"), by_leave)

    @cached_property
    def dim_departemen(self) -> DataFrame:
        d, day = self.m_departemen, lambda s: F.lit(s).cast("date")
        first = d.select((F.col("id") * 2 + 1).cast("long").alias("key"), F.col("id").alias("source_id"), F.col("nama_departemen").alias("name"),
            day("2023-12-01").alias("valid_from"), day("2024-01-15").alias("valid_to"))
        then = d.where("id % 5 <> 4").select((F.col("id") * 2 + 2).cast("long"), "id", F.concat("nama_departemen", F.lit(" B")), day("2024-01-15"), F.lit(None).cast("date"))
        none = self.region.where("r_regionkey = 0").select(F.lit(0).cast("long"), F.lit(None).cast("int"), F.lit("UNKNOWN"), day("1900-01-01"), F.lit(None).cast("date"))
        return first.union(then).union(none)

    @cached_property
    def dim_pegawai(self) -> DataFrame:
        start = F.when(F.col("id") % 7 == 3, F.lit("2024-01-10")).otherwise("2023-12-01").cast("date")
        return self.m_pegawai.select(F.col("id").cast("long").alias("key"), F.col("id").alias("source_id"), F.col("nama").alias("name"),
            start.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))

    @cached_property
    def date_state(self) -> DataFrame:
        day = F.dayofmonth("tanggal")
        flags = ((day % 2 == 0).alias("population_complete"), (day % 3 != 0).alias("curated_delivery_complete"), (day % 4 == 0).alias("is_closed"))
        return self.dates.where(day % 5 != 1).select("tanggal", *flags)

    @cached_property
    def fact(self) -> DataFrame:
        return mart.fact_daily(self.dealt(self.daily, "pegawai_id"), self.dim_pegawai, self.dim_departemen)

    @cached_property
    def agg(self) -> DataFrame:
        return mart.department_day_sum(self.fact)

    @cached_property
    def dept(self) -> DataFrame:
        return mart.department_daily(self.agg, self.dim_departemen, self.date_state)

    @cached_property
    def inst(self) -> DataFrame:
        return mart.institution_daily(self.dept)

    @cached_property
    def late(self) -> DataFrame:
        return mart.lateness_employee_daily(self.fact, self.dim_departemen, self.date_state)


    @cached_property
    def people(self) -> DataFrame:
        return people.people_bitmaps(self.fact)

    @cached_property
    def grams_pegawai(self) -> DataFrame:
        return search.postings(self.dim_pegawai, "key", "name", "source_id")

    @cached_property
    def grams_departemen(self) -> DataFrame:
        return search.postings(self.dim_departemen, "key", "name")


class Served(Tables):
    """The same tables, with those that dashboards read taken from a published mart.

    The mart is built once for a state of the source's files and of this code, and published as a whole: facts in a folder
    for each date, department-day sums, with their rates and states too, people, dimensions, postings and date states. Reading prunes dates and columns.
    """

    STORED = ("fact", "agg", "dept", "people", "dim_departemen", "dim_pegawai", "date_state", "grams_pegawai", "grams_departemen")

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.mart = VersionedTables(spark, f"{shared_folder(spark)}/mart-{source_state(spark, sf_dir)}-{code_state()}")
        if not self.mart.snapshot():
            try:
                build_mart(Tables(spark, sf_dir), self.mart)
            except Exception:
                if not self.mart.snapshot():  # somebody else published the same mart meanwhile
                    raise
        self.paths = self.mart.snapshot()

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths[name])

    fact = cached_property(lambda self: self._stored("fact"))
    agg = cached_property(lambda self: self._stored("agg"))
    dept = cached_property(lambda self: self._stored("dept"))
    people = cached_property(lambda self: self._stored("people"))
    grams_pegawai = cached_property(lambda self: self._stored("grams_pegawai"))
    grams_departemen = cached_property(lambda self: self._stored("grams_departemen"))
    dim_departemen = cached_property(lambda self: self._stored("dim_departemen"))
    dim_pegawai = cached_property(lambda self: self._stored("dim_pegawai"))
    date_state = cached_property(lambda self: self._stored("date_state"))


def build_mart(t: Tables, mart_tables: VersionedTables) -> int:
    """Compute and publish what :class:`Served` reads; sums are taken from the facts as they were written."""
    sums = {
        "agg": lambda done: mart.department_day_sum(done("fact")),
        "dept": lambda done: mart.department_daily(done("agg"), t.dim_departemen, t.date_state),
        "people": lambda done: people.people_bitmaps(done("fact")),
    }
    stored = {"fact": t.fact, **sums, **{n: getattr(t, n) for n in Served.STORED if n not in ("fact", *sums)}}
    return mart_tables.publish(stored, {"fact": ["tanggal"]})
