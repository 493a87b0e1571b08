import datetime as dt

from pyspark.sql import functions as F

from martforge import params as P
from martforge.functions.calendar import lookback_start
from martforge.operators.maintenance import date_slice
from martforge.operators.quality import gate
from martforge.plans import movements as mv
from martforge.plans.run import STEPS, Loader, RunConfig, movement_family, run, stores
from martforge.plans.run import testdata_reports as build_reports
from martforge.schemas import SALES, widen
from martforge.sinks.ddl import create_table, create_table_sql, drop_table
from martforge.sinks.export import tsv_lines, write_tsv
from martforge.sinks.tables import MonthTable, Slice
from martforge.sources import reports as rp
from martforge.streaming.ingest import slice_loader, start_ingest


CONFIG = RunConfig(P.LOOKBACK_DAYS, P.ENTITY_RENAME, P.EXCLUDED_PRODUCER, P.ACTUALS_GROUP_TYPES, P.HOME_MILL,
                   P.CANDIDATE_EXCLUDE_TOKEN)


def test_run_is_idempotent_and_ordered(spark, small_dir, tmp_path):
    wh = str(tmp_path / "wh")
    full = build_reports(spark, small_dir)
    first = {r.step: r for r in run(spark, full, wh, as_of=P.AS_OF, config=CONFIG, first_load=True).collect()}
    assert tuple(first) == STEPS
    # Nothing of the first download is lost: what is not in the fact is a reject.
    loaded = stores(spark, wh)["sales"].read().count()
    from martforge.plans.sales import sales

    refused = spark.read.parquet(f"{wh}/_rejects/sales").count()
    assert loaded + refused == sales(full.carcass, full.loads).count()
    assert (first["sales"].accepted, first["sales"].rejected, first["sales"].replaced) == (loaded, refused, 0)
    assert stores(spark, wh)["sales"].read().agg(F.min("kill_date")).first()[0] < lookback_start(P.AS_OF, 2000)
    facts = ("ingredients", "movements", "deaths", "sales", "budget_init")
    again = {r.step: r for r in run(spark, full, wh, as_of=P.AS_OF, config=CONFIG, steps=facts).collect()}
    assert tuple(again) == facts
    assert spark.read.parquet(f"{wh}/_rejects/sales").where("reason like 'outside%'").count() > 0
    assert again["sales"].accepted == again["sales"].replaced > 0
    assert again["budget_init"].accepted == again["budget_init"].rejected == 0  # known rows are neither
    for r in (*first.values(), *again.values()):
        assert r.step in ("groups", "budget_init") or r.accepted + r.rejected == r.rows_in
    counts1 = {k: s.read().count() for k, s in stores(spark, wh).items()}
    window = lookback_start(P.AS_OF, P.LOOKBACK_DAYS["movements"])
    part = build_reports(spark, small_dir, window_start=window, with_budgets=False)
    run(spark, part, wh, as_of=P.AS_OF, config=CONFIG, steps=("groups", "movements", "sales"))
    counts2 = {k: s.read().count() for k, s in stores(spark, wh).items()}
    assert counts1 == counts2
    assert counts1["budgets"] > 0 and counts1["closeouts"] > 0
    b = stores(spark, wh)["budgets"].read()
    assert b.filter(F.col("budget_type") == "actual").count() > 0
    assert spark.read.parquet(f"{wh}/_runs").select("run").distinct().count() == 3


FACT = "id int, kind string, d date"


def files(table):
    return {f.split("/", 3)[-1] for f in table._stored().inputFiles()} if table.partitions() else set()


def month_table(spark, path, rows, family=True):
    t = MonthTable(spark, str(path), spark.createDataFrame([], FACT).schema, "d", F.col("kind") if family else None)
    t.append(spark.createDataFrame(rows, FACT))
    return t


def day(text):
    return dt.date.fromisoformat(text) if text else None


OLD = [(1, "a", day("2020-01-05")), (2, "a", day("2020-02-03")), (3, "a", day("2020-02-20")), (4, "a", day("2020-03-01")),
       (5, "b", day("2020-02-25")), (6, "a", None), (7, None, day("2020-03-02")), (8, "a", day("2020-05-09"))]


def test_a_slice_writes_only_its_months(spark, tmp_path):
    t = month_table(spark, tmp_path / "t", OLD)
    before = files(t)
    batch = spark.createDataFrame([(30, "a", day("2020-02-10")), (40, "a", day("2020-04-01"))], FACT)
    done = t.replace_slice(batch, Slice(day("2020-02-10"), "a"))
    after = files(t)
    assert sorted((r.id for r in t.read().collect())) == [1, 2, 5, 6, 7, 30, 40]
    assert (done.accepted, done.replaced) == (2, 3)
    assert done.written == ("a/2020-02", "a/2020-04") and done.dropped == ("a/2020-03", "a/2020-05")
    kept = {f for f in before if any(x in f for x in ("p_family=a/p_month=2020-01", "p_family=b/", "HIVE_DEFAULT"))}
    assert len(kept) == 4 and kept <= after  # January, the other family, no date and no kind: the same files
    assert not (before - kept) & after
    # The same batch again changes no row; a slice whose batch is empty goes.
    t.replace_slice(batch, Slice(day("2020-02-10"), "a"))
    assert sorted((r.id for r in t.read().collect())) == [1, 2, 5, 6, 7, 30, 40]
    t.replace_slice(batch.limit(0), Slice(day("2020-02-01"), "a"))
    assert sorted((r.id for r in t.read().collect())) == [1, 5, 6, 7]


def test_slices_of_all_families_and_of_tables_without(spark, tmp_path):
    rows = [r for r in OLD if r[1]]
    for family in (True, False):
        t = month_table(spark, tmp_path / f"t{family}", rows, family)
        t.replace_slice(spark.createDataFrame([(9, "a", day("2020-03-05"))], FACT), Slice(day("2020-02-10")))
        assert sorted((r.id for r in t.read().collect())) == [1, 2, 6, 9]


def test_a_batch_outside_its_slice_changes_nothing(spark, tmp_path):
    import pytest

    t = month_table(spark, tmp_path / "t", OLD)
    with pytest.raises(Exception, match="outside"):
        t.replace_slice(spark.createDataFrame([(9, "a", day("2020-01-31"))], FACT), Slice(day("2020-02-01"), "a"))
    assert t.read().count() == len(OLD)
    t.replace(t.read().filter("id < 5"))  # a table may be replaced by what was read from it
    assert sorted((r.id for r in t.read().collect())) == [1, 2, 3, 4]
    empty = MonthTable(spark, str(tmp_path / "none"), t.schema, "d")
    assert empty.read().count() == 0


def test_gate_of_a_keyed_load(spark):
    schema = spark.createDataFrame([], "k string, v decimal(4,1)").schema
    batch = spark.createDataFrame(
        [("a", "1.5"), ("a", "1.5"), ("b", "1.5"), ("b", "2.5"), (None, "1.5"), ("c", "9999.9"), ("d", "3.5"), ("e", "3.5"), ("toolong", "1.0")],
        "k string, v string").selectExpr("k", "CAST(v AS decimal(18,1)) AS v")
    stored = spark.createDataFrame([("d", "3.5"), ("e", "4.5")], "k string, v string").selectExpr("k", "CAST(v AS decimal(18,1)) AS v")
    got = {(r.k, str(r.v)): (r.n_rows, r.reason and r.reason.split(": ")[1], r.accepted)
           for r in gate(batch, schema, "k", max_len={"k": 3}, stored=stored).collect()}
    assert got == {
        ("a", "1.5"): (2, None, True), ("b", "1.5"): (1, "came 2 times with different values", False),
        ("b", "2.5"): (1, "came 2 times with different values", False), (None, "1.5"): (1, "NULL", False),
        ("c", "9999.9"): (1, "not decimal(4,1)", False), ("d", "3.5"): (1, None, False),
        ("e", "3.5"): (1, "stored with other values", False), ("toolong", "1.0"): (1, "over 3 chars", False)}


def test_tsv_export(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1.5)], "x string, y string, z double")
    assert tsv_lines(df).first().line == "a\t\t1.5"
    write_tsv(df, str(tmp_path / "out"))
    text = spark.read.text(str(tmp_path / "out")).first()[0]
    assert text == "a\t\t1.5"
    odd = spark.createDataFrame([("a\tb\nc\\", "q\"")], "x string, y string")
    write_tsv(odd, str(tmp_path / "odd"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "odd")).collect()] == [r.line for r in tsv_lines(odd).collect()]
    assert tsv_lines(odd).first().line == "a\\tb\\nc\\\\\tq\""


def test_ddl(spark, tmp_path):
    sql = create_table_sql("sales_t", SALES)
    assert "`avg_live_wt` decimal(4,1)" in sql and "`quantity` smallint" in sql
    create_table(spark, "sales_t", SALES, location=str(tmp_path / "sales_t"))
    assert spark.table("sales_t").schema == SALES
    drop_table(spark, "sales_t")
    assert not spark.catalog.tableExists("sales_t")


MOVE_NAMES = ["sow_unit", "group", "supplier", "customer", "plant", "event_category", "event_code", "event_name",
              "movement_id", "movement_date", "quantity", "weight", "cost"]


def _movement_file(path, rows):
    lines = ["Movement Report", "All Producers", ",".join(MOVE_NAMES)]
    lines += [",".join(r) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def test_streaming_ingest_processes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = MonthTable(spark, str(tmp_path / "movements"), mv.MOVEMENT_OUT, "movement_date", movement_family())

    def parse(lines):
        df = rp.parse_report_lines(lines, skip_rows=3, ordinals=list(range(13)), names=MOVE_NAMES)
        return df.select(*[F.col(c) for c in MOVE_NAMES[:9]], F.col("movement_date").cast("date").alias("movement_date"),
                         F.col("quantity").cast("int").alias("quantity"), F.col("weight").cast("int").alias("weight"),
                         F.col("cost").cast("decimal(18,2)").alias("cost"))

    loader = slice_loader(store, parse, lambda raw: mv.movements(raw),
                          lambda facts: Slice(dt.date(2020, 1, 1), "movements"))
    _movement_file(landing / "movements_1.csv", [
        ["", "G1", "", "", "", "Transfer", "E5", "t", "1-5", "2020-02-01", "10", "100", "5.00"]])
    q = start_ingest(spark, str(landing), loader, name="t1", name_token="movements",
                     checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination()
    assert store.read().count() == 1
    _movement_file(landing / "movements_2.csv", [
        ["", "G2", "", "", "", "Transfer", "E5", "t", "2-5", "2020-03-01", "-4", "100", "5.00"]])
    q = start_ingest(spark, str(landing), loader, name="t1", name_token="movements",
                     checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination()
    rows = store.read().collect()
    assert [r.group_num for r in rows] == ["G2"] and rows[0].movement_type == "out"


def test_parts_of_one_report_in_two_batches(spark, tmp_path):
    landing = tmp_path / "landing zone"
    landing.mkdir()
    store = MonthTable(spark, str(tmp_path / "movements"), mv.MOVEMENT_OUT, "movement_date", movement_family())

    def parse(lines):
        df = rp.parse_report_lines(lines, skip_rows=3, ordinals=list(range(13)), names=MOVE_NAMES)
        return df.select(*[F.col(c) for c in MOVE_NAMES[:9]], F.col("movement_date").cast("date").alias("movement_date"),
                         F.col("quantity").cast("int").alias("quantity"), F.col("weight").cast("int").alias("weight"),
                         F.col("cost").cast("decimal(18,2)").alias("cost"))

    loader = slice_loader(store, parse, lambda raw: mv.movements(raw), lambda facts: Slice(dt.date(2020, 1, 1), "movements"))

    def land(name, *groups):
        _movement_file(landing / name, [["", g, "", "", "", "Transfer", "E5", "t", f"{g}-5", "2020-02-01", "10", "100", "5.00"]
                                        for g in groups])
        start_ingest(spark, str(landing), loader, name="t2", name_token="movements",
                     checkpoint=str(tmp_path / "ckpt")).awaitTermination()
        return sorted(r.group_num for r in store.read().collect())

    assert land("movements_a_part0.csv", "G1", "G2") == ["G1", "G2"]
    assert land("movements_a_part1.csv", "G3") == ["G1", "G2", "G3"]
    assert land("movements_a_part2.csv", "G4") == ["G1", "G2", "G3", "G4"]
    # A later export of the same window, in parts too, replaces the first.
    assert land("movements_b_part0.csv", "G5") == ["G5"]
    assert land("movements_b_part1.csv", "G6") == ["G5", "G6"]


def test_run_routes_overflowing_rows_to_rejects(spark, tmp_path):
    load = Loader(spark, str(tmp_path))
    row = dict.fromkeys(mv.MOVEMENT_OUT.names) | {"event_category": "Transfer", "movement_date": dt.date(2020, 1, 1)}
    rows = [row | {"group_num": "G1", "quantity": 5}, row | {"group_num": "G2", "quantity": 70000}, row | {"group_num": "G3", "movement_date": dt.date(2019, 1, 1)}]
    batch = spark.createDataFrame([tuple(r[c] for c in mv.MOVEMENT_OUT.names) for r in rows], mv.MOVEMENT_OUT)
    load.replace_slice("movements", "movements", batch, Slice(dt.date(2020, 1, 1), "movements"))
    assert [r.group_num for r in load.tables["movements"].read().collect()] == ["G1"]
    rej = spark.read.parquet(str(tmp_path / "_rejects" / "movements"))
    assert sorted((r.group_num, r.reason.split(":")[0]) for r in rej.collect()) == [("G2", "quantity"), ("G3", "outside the slice that this load replaces")]
    assert load.report().first()[1:] == ("movements", 3, 1, 2, 0)


def test_slice_predicate_reaches_the_scan(spark, tmp_path):
    """Both sides of a slice replacement filter at the Parquet scan."""
    from martforge.operators.maintenance import replace_slice

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, None)], "id int, d date").write.parquet(path)
    t = spark.read.parquet(path)
    out = replace_slice(t, t.limit(0), date_slice("d", "2020-01-01"))
    assert [r.id for r in out.collect()] == [2]
    assert "LessThan(d" in out._jdf.queryExecution().executedPlan().toString()
