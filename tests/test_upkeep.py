"""Tables kept by date, captured changes, bitmaps of people, search, pages, chains of units, the ordered export."""

import datetime as dt
import itertools
import random
import types

import pytest
from pyspark.sql import functions as F

from rollcall.operators import checks, curated, hierarchy, incremental, mart, people, search
from rollcall.operators.incremental import KEYS
from rollcall.plans import kpi, tables, upkeep
from rollcall.plans.tables import Served, Tables
from rollcall.plans.upkeep import CuratedStore, MartStore
from rollcall.sources import export, scans
from rollcall.sources.dated import DatedTables, dates_of
from rollcall.sources.scratch import Files, VersionedTables, scratch, shared_folder, written
from rollcall.streaming.capture import ChangeCapture

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 8)


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="module")
def served(spark):
    return Served(spark, SF)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_masters_are_read_whole(spark, t):
    for view, table in (("m_pegawai", "customer"), ("m_user", "customer"), ("m_shift", "part"), ("m_jadwal", "part"), ("t_perizinan", "orders"), ("t_checkinout", "events")):
        assert t.table(view).count() == t.table(table).count(), view


def test_dates_are_replaced_alone(spark):
    """Other dates' files stay, a date without rows loses its folder, running again changes nothing, a crash leaves the old rows."""
    tables = DatedTables(spark, scratch(spark, "t"), {"x": "tanggal"})
    df = spark.range(60).select("id", F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("tanggal"))
    tables.write("x", df)
    before, a, b = tables.folders("x"), DAY, DAY + dt.timedelta(1)
    new = df.where(F.col("tanggal") == a).withColumn("id", F.col("id") + 100)
    for _ in range(2):
        tables.replace("x", new, [a, b])
        after = tables.folders("x")
        assert set(after) == {f"tanggal={a}", f"tanggal={DAY + dt.timedelta(2)}"} and after[f"tanggal={DAY + dt.timedelta(2)}"] == before[f"tanggal={DAY + dt.timedelta(2)}"]
        assert rows(tables.read("x")) == rows(new.unionByName(df.where(F.col("tanggal") > b)))
    with pytest.raises(Exception, match="boom"):
        tables.replace("x", tables.read("x", [a]).withColumn("id", F.raise_error(F.lit("boom")).cast("long")), [a])
    assert rows(tables.read("x")) == rows(new.unionByName(df.where(F.col("tanggal") > b)))
    assert tables.changed_dates("x", tables.read("x")) == [] and tables.changed_dates("x", df) == [a, b]
    tables.replace("x", tables.read("x", [a]).unionByName(new.withColumn("id", F.col("id") + 1000)), [a])  # reads what it replaces
    assert tables.read("x", [a]).count() == 2 * new.count()


def test_corrections_touch_their_dates(spark, t):
    """After late events, moved and withdrawn leaves the store is what a full build gives; only their dates are read and written."""
    store, days = CuratedStore(spark, scratch(spark, "c")), written(t.lvday, "lvday")
    late = (F.col("event_id") % 97 == 3) & (F.col("tanggal_event") <= dt.date(2024, 1, 4))
    moved = days.where("perizinan_id = 8").withColumn("tanggal", F.date_add("tanggal", 2))
    gone, rest = (F.col("perizinan_id") == 8), days.where("perizinan_id <> 8")
    store.build(t.ev.where(~late), rest.unionByName(moved), t.pop)
    before = store.folders("daily")
    touched = store.late_events(t.ev.where(late)) + store.late_leaves(days.where(gone))
    assert rows(store.read("daily").select(*t.daily.columns)) == rows(t.daily)
    after = store.folders("daily")
    assert touched and {d for d in after if after[d] != before[d]} == {f"tanggal={d}" for d in touched} < set(after)
    for name in ("events", "population", "leave_days", "daily"):
        assert store.days[name] in plan(store.read(name, [DAY])).split("PartitionFilters: [")[1].split("]")[0]
    assert store.recompute(t.pop.select(*KEYS).where("false")) == []


def test_delivery_rewrites_one_folder(spark, t):
    """A delivery on one date: facts, sums and people of this date only, and it may be applied again."""
    store, fact = MartStore(spark, scratch(spark, "m")), written(t.fact, "fact")
    day = F.col("tanggal") == DAY
    store.build(fact.where(~(day & (F.col("pegawai_id") % 3 == 0))))
    before = {n: store.folders(n) for n in store.days}
    items = fact.where("pegawai_id % 2 = 0").where(F.col("tanggal").isin(DAY, DAY + dt.timedelta(1))).select(*KEYS, F.lit("UPSERT").alias("operation"))
    items = items.unionByName(fact.where(day & (F.col("pegawai_id") == 1)).select(*KEYS, F.lit("DELETE").alias("operation")))
    assert store.deliver(items, fact) == [DAY]
    for n in store.days:
        after = store.folders(n)
        assert [d for d in after if after[d] != before[n].get(d)] == [f"tanggal={DAY}"], n
    want = fact.where(~day | (F.col("pegawai_id") % 3 != 0) | (F.col("pegawai_id") % 2 == 0)).where(~day | (F.col("pegawai_id") != 1))
    assert rows(store.read("fact").select(*fact.columns)) == rows(want)
    sums = mart.department_day_sum(want)
    assert rows(store.read("agg").select(*sums.columns)) == rows(sums)
    assert store.deliver(items, fact) == []


def test_people_of_any_period(spark, t):
    """Bitmaps against count(DISTINCT) over periods, departments and groups of people, and ids beyond one bitmap."""
    fact = written(t.fact.withColumn("pegawai_id", F.when(F.col("pegawai_id") % 5 == 0, F.col("pegawai_id") * 40_000).otherwise(F.col("pegawai_id")).cast("int")), "fact")
    bits = written(people.people_bitmaps(fact), "people")
    days = sorted(r[0] for r in fact.select("tanggal").distinct().collect())
    rng = random.Random(4)
    for _ in range(4):
        a, b = sorted(rng.sample(days, 2))
        some = kpi.period(fact, a, b)
        assert people.unique_people(bits, a, b).first().people == some.where("active_employee_days = 1").select("pegawai_id").distinct().count()
        dept = rng.randrange(25)
        assert people.unique_people(bits, a, b, dept).first().people == some.where(f"active_employee_days = 1 and departemen_id = {dept}").select("pegawai_id").distinct().count()
        assert rows(people.lateness_coverage(bits, a, b)) == rows(kpi.lateness_coverage(fact, a, b).select("lateness_status", "people"))
    assert people.unique_people(bits.where("false"), days[0], days[-1]).first().people == 0


def test_search_by_trigrams(spark, served):
    dim = spark.createDataFrame([(1, "Ana Banana", 12), (2, "BANAL", 120), (3, None, 3), (4, "an", None), (5, "İstanbul ünlü", 5)], "key long, name string, source_id int")
    index = search.postings(dim, "key", "name", "source_id")
    for text in ("ana", "BANAN", "nal", "an", "12", "120", "ünl", "zzz", "a b"):
        want = {r.key for r in dim.collect() if any(text.lower() in str(v).lower() for v in (r.name, r.source_id) if v is not None)}
        assert {r.key for r in search.find(index, dim, "key", text, "name", "source_id").collect()} == want, text
    assert "customer" not in plan(search.search_facts(served, "000012")) and search.search_facts(served, "000012").count() > 0


def test_pages_by_key(spark, served):
    """All pages of a table with ties in the leading column, in order and without gaps; the bound reaches the scan."""
    order, facts = ["tanggal", "pegawai_id"], served.fact.select("tanggal", "pegawai_id")
    want, got, after = [tuple(r) for r in facts.orderBy(*order).limit(1000).collect()], [], None
    while len(got) < 1000:
        upto = kpi.page_ends(served.agg, after and after["tanggal"], 250)
        page = kpi.page_after(facts, order, after, 250, upto)
        if after:
            assert "PartitionFilters: [isnotnull(tanggal" in plan(page)
        got += [tuple(r) for r in page.collect()]
        after = dict(zip(order, got[-1], strict=True))
    assert got == want
    last = facts.orderBy(*(F.desc(c) for c in order)).first().asDict()
    assert kpi.page_after(facts, order, last, 10).count() == 0 and kpi.page_ends(served.agg, last["tanggal"], 1) is None


def test_chains_against_a_walk(spark):
    rng = random.Random(9)
    for n in (1, 2, 40, 300):
        parent = {i: rng.choice([None, 0, i, rng.randrange(1, n + 1), rng.randrange(1, n + 1), rng.randrange(1, n + 1), n + 50]) for i in range(1, n + 1)}
        parent |= {i: i - 1 for i in range(2, n + 1) if n == 300}  # one long chain
        got = {r.id: (r.state, r.root, r.depth) for r in hierarchy.hierarchy_chains(spark.createDataFrame(list(parent.items()), "id int, parent int")).collect()}
        for i in parent:
            path = [i]
            while True:
                up = parent[path[-1]]
                if up in (None, 0, path[-1]) or up not in parent:
                    want = ("ROOTED", path[-1], len(path) - 1)
                    break
                if up in path:
                    circle = path[path.index(up) :]
                    want = ("CYCLE" if i in circle else "INTO_CYCLE", min(circle), None)
                    break
                path.append(up)
            assert got[i] == want


def test_export_is_in_order(spark, t):
    path = scratch(spark, "e")
    export.write_ordered(export.records(export.sections(t)), path, "section_no", "record", files=7)
    got = export.read_ordered(spark, path, "section_no INT, section STRING, record STRING").collect()
    files = [[(r.section_no, r.record) for r in got if r.file == f] for f in sorted({r.file for r in got})]
    flat = list(itertools.chain.from_iterable(files))
    assert len(files) > 1 and flat == sorted(flat) and {r.section_no for r in got} == set(range(1, 17))


def test_blocks_stay_whole(spark):
    path = scratch(spark, "b")
    spark.range(0, 10_000, 1, 4).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    got = {r.id for r in scans.sample_blocks(read(), 20.0, rows=100).collect()}
    assert {i // 100 for i in got} == {i // 100 for i in got if all(j in got for j in range(i // 100 * 100, i // 100 * 100 + 100))} and 500 < len(got) < 4000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    assert got == {r.id for r in scans.sample_blocks(read(), 20.0, rows=100).collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_last_write_wins(spark):
    """Three writes of a key before an acknowledgement are one change; a way there and back is none; old writes that come late count for nothing."""
    inbox, path = scratch(spark, "w"), scratch(spark, "c")
    of = "pegawai_id INT, tanggal DATE, v INT, note STRING, sequence BIGINT, deleted BOOLEAN"
    n = itertools.count()

    def put(*writes):
        spark.createDataFrame([(k, DAY, v, f"s{s}", s, v is None) for k, v, s in writes], of).write.parquet(f"{inbox}/{next(n)}")
        capture = ChangeCapture(spark, inbox, path, spark.createDataFrame([], of).schema, ignore=("note",))  # a new one each time: a restart
        capture.run()
        return capture

    pending = lambda c: {r.pegawai_id: (r.operation, r.payload and int(r.payload.split('"v":')[1].split(",")[0])) for r in c.pending().collect()}
    c = put((1, 10, 1), (2, 20, 1), (3, 30, 1))
    assert pending(c) == {1: ("UPSERT", 10), 2: ("UPSERT", 20), 3: ("UPSERT", 30)}
    c.acknowledge(c.batches())
    assert pending(c) == {}
    put((1, 11, 2), (2, 21, 2), (3, None, 2))
    put((1, 12, 4), (1, 11, 3), (2, 20, 3))
    c = put((1, 5, 1), (1, 13, 5), (4, None, 1))
    assert pending(c) == {1: ("UPSERT", 13), 3: ("DELETE", None)}
    with pytest.raises(ValueError, match="captured"):
        c.acknowledge(99)
    c.acknowledge(c.batches())
    c.acknowledge(1)
    assert pending(put((3, 31, 3), (1, 13, 6))) == {3: ("UPSERT", 31)}


def test_dates_of_nothing(spark, t):
    assert dates_of(t.daily.where("false")) == []
    assert curated.unified_daily(t.pop.where("false"), t.ev.where("false"), t.lvsum.where("false")).count() == 0


def test_mart_is_built_from_what_it_published(spark, t, tmp_path):
    """Facts are computed and written once; sums and people read them there."""
    from rollcall.plans.tables import build_mart

    before = set(Files(spark, shared_folder(spark)).names())
    tables = VersionedTables(spark, str(tmp_path))
    build_mart(t, tables)
    assert set(Files(spark, shared_folder(spark)).names()) == before
    assert set(tables.snapshot()) == set(Served.STORED)
    assert rows(tables.read("agg")) == rows(mart.department_day_sum(tables.read("fact")))
    assert rows(tables.read("fact").select(*t.fact.columns)) == rows(t.fact)


def test_plans_hold_at_size(spark, t):
    """No bitmaps before rows have met, no broadcast of employees, and of employees x dates the dates are broadcast."""
    bits = plan(people.people_bitmaps(t.spark.read.parquet(Served(spark, SF).paths["fact"])))
    assert "bitmap_construct_agg" not in bits.rsplit("Exchange", 1)[1]
    fact = plan(mart.fact_daily(written(t.daily, "daily"), t.dim_pegawai, t.dim_departemen))
    assert "ShuffledHashJoin" in fact and "BroadcastExchange" not in fact.split("ShuffledHashJoin")[1].split("dim_departemen")[0].split("customer")[0]
    pop = plan(t.pop)
    assert "BroadcastNestedLoopJoin BuildRight, Cross" in pop


def test_a_delivery_computes_its_facts_once(spark, t):
    """All parts of a delivery read staged facts."""
    assert "customer" not in plan(incremental._delivered(t, "agg"))  # noqa: SLF001


def test_deliveries_to_many_employees(spark, t):
    """Employees beyond a million keep their facts when rows of nobody are delivered away."""
    some = t.fact.where("pegawai_id < 30")
    fact = written(some.unionByName(some.withColumn("pegawai_id", F.col("pegawai_id") + 1_000_000)), "fact")
    got = upkeep._delivered(types.SimpleNamespace(spark=spark, fact=fact), "fact")  # noqa: SLF001
    assert rows(got.select(*fact.columns)) == rows(fact)


def test_capture_keeps_no_images_in_executors(spark):
    """The stream has no state store; a write older than the acknowledged image counts for nothing."""
    inbox, path = scratch(spark, "w"), scratch(spark, "c")
    of = "pegawai_id INT, tanggal DATE, v INT, sequence BIGINT, deleted BOOLEAN"

    def put(n, *writes):
        spark.createDataFrame([(k, DAY, v, s, False) for k, v, s in writes], of).write.parquet(f"{inbox}/{n}")
        capture = ChangeCapture(spark, inbox, path, spark.createDataFrame([], of).schema)
        capture.run()
        return capture

    c = put(1, (1, 10, 5), (2, 20, 5))
    c.acknowledge(c.batches())
    assert [r.pegawai_id for r in put(2, (1, 9, 4), (2, 21, 6)).pending().collect()] == [2]
    assert "state" not in Files(spark, f"{path}/checkpoint").names()


def test_corrections_of_both_kinds_are_computed_once(spark, t, monkeypatch):
    """Events and leaves that are corrected together: dates' daily records are rewritten once, digests are made when asked for."""
    store, late, moved = CuratedStore(spark, scratch(spark, "c")), F.col("event_id") % 50 == 3, F.col("perizinan_id") % 40 == 1
    store.build(t.ev.where(~late), t.lvday.withColumn("tanggal", F.when(moved, F.date_add("tanggal", 1)).otherwise(F.col("tanggal"))), t.pop)
    replaced, replace = [], store.replace
    monkeypatch.setattr(store, "replace", lambda name, *a: (replaced.append(name), replace(name, *a)))
    dates = store.correct(t.ev.where(late), t.lvday.where(moved))
    assert dates and replaced == ["events", "leave_days", "daily"]
    assert rows(store.read("daily").select(*t.daily.columns)) == rows(t.daily)
    assert Files(spark, f"{store.path}/daily-digests").names() == []
    assert store.changed_dates("daily", store.read("daily")) == [] and store.correct() == []


def test_digests_go_with_their_rows(spark):
    """Dates that are replaced or dropped lose their digests, also where the write fails; the others keep theirs."""
    tables = DatedTables(spark, scratch(spark, "t"), {"x": "tanggal"})
    df = spark.range(60).select("id", F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("tanggal"))
    a, b = DAY, DAY + dt.timedelta(1)
    tables.write("x", df)
    assert rows(tables.digests("x").select("rows")) == [(20,)] * 3
    kept = Files(spark, f"{tables.path}/x-digests/tanggal={b}").names()
    with pytest.raises(Exception, match="boom"):
        tables.replace("x", df.withColumn("id", F.raise_error(F.lit("boom")).cast("long")), [a])
    tables.replace("x", df.where((F.col("tanggal") == a) & (F.col("id") > 30)), [a])
    assert Files(spark, f"{tables.path}/x-digests").names().count(f"tanggal={a}") == 0
    assert rows(tables.digests("x").select("rows")) == [(20,), (20,), (9,)]
    assert Files(spark, f"{tables.path}/x-digests/tanggal={b}").names() == kept and tables.changed_dates("x", df) == [a]


def test_schedules_are_not_broadcast(t):
    """Schedules and shifts grow with the data; employees are dealt out before they are multiplied by dates."""
    assert "BroadcastHashJoin" not in plan(t.ev) and plan(t.ev).count("ShuffledHashJoin") == 3
    assert "Exchange hashpartitioning(pegawai_id" in plan(t.pop).split("BroadcastNestedLoopJoin")[1].split("BroadcastExchange")[0]


def test_records_of_many_employees_are_dealt_out(spark, t, monkeypatch):
    """Tasks grow in number with the employees, not in size; the check of the grain computes its facts once."""
    assert t.parts is None
    small = checks.QUERIES["grain_unique"][0](t)
    monkeypatch.setattr(tables, "EMPLOYEES_A_TASK", 10)
    many = Tables(spark, SF)
    assert many.parts == 15
    grain = checks.QUERIES["grain_unique"][0](many)
    assert plan(grain).count("BroadcastNestedLoopJoin") == 1 and plan(grain).count(", 15)") >= 4
    assert rows(grain) == rows(small)
    assert rows(many.daily) == rows(t.daily)
