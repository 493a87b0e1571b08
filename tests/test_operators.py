import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martforge.functions.text import header_without_copy_suffix, header_without_unit
from martforge.operators import dedup, dimsync, maintenance as mt, quality as qa
from martforge.operators.reshape import pivot_fixed, unpivot_measures
from martforge.operators.stats import exact_ratio, load_stddev_avg
from martforge.plans import ingredients as ing
from martforge.plans import movements as mv
from martforge.schemas import GROUPS


def test_unpivot_then_pivot_restores_cells(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0)], "id string, `x.1` double, `y (lb)` double")
    long = unpivot_measures(df, ["id"], ["x.1", "y (lb)"], "name", "v", value_type="double")
    assert long.count() == 3  # the NULL cell is dropped
    wide = pivot_fixed(long, "id", "name", "v", ["x.1", "y (lb)"])
    got = {r["id"]: (r["x.1"], r["y (lb)"]) for r in wide.collect()}
    assert got == {"a": (1.0, None), "b": (2.0, 3.0)}


def test_repeated_headers_collapse_in_group_sum(spark):  # R3 + A1
    df = spark.createDataFrame([("o1", "G1", "D", dt.date(2020, 1, 1), "M", Decimal(1), Decimal(2))],
                               "`Order ID` string, `Group` string, `Diet` string, `Delivery Date` date, "
                               "`Mill` string, `Corn (lb)` decimal(18,4), `Corn (bu)` decimal(18,4)")
    out = ing.ingredient_long(df, "quantity", header_without_unit).collect()
    assert len(out) == 1 and out[0].quantity == Decimal(3) and out[0].ingredient == "Corn"


def _sheet(spark, rows):
    return spark.createDataFrame(rows, "`Order ID` string, `Group` string, `Diet` string, `Delivery Date` date, "
                                       "`Mill` string, `Corn` decimal(18,4)")


def test_short_key_fans_out_full_key_does_not(spark):  # Q4
    d = dt.date(2020, 1, 1)
    rows = [("o1", "G1", "D", d, "M", Decimal(10)), ("o1", "G2", "D", d, "M", Decimal(20))]
    q = _sheet(spark, rows)
    c = _sheet(spark, rows)
    assert ing.ingredients(q, c, full_key=True).count() == 2
    assert ing.ingredients(q, c, full_key=False).count() == 4


def test_ambiguous_concat_key_not_joined(spark):  # Q5
    left = spark.createDataFrame([("1", "2x", 5), ("12", "x", 7)], "a string, b string, v int")
    right = spark.createDataFrame([("1", "2x", "G1")], "a string, b string, g string")
    got = dedup.unique_key_join(left, right, ["a", "b"], ["g"]).collect()
    assert [(r.a, r.b, r.g) for r in got] == [("1", "2x", "G1")]


def test_duplicate_marks(spark):  # W1, W2
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 1), (2, "b", 1), (None, None, 1), (None, None, 2)],
                               "k int, j string, o int")
    dup = {(r.k, r.o): r.is_dup for r in dedup.mark_duplicate_keys(df, ["k", "j"]).collect()}
    assert dup[(1, 3)] and dup[(1, 1)] and not dup[(2, 1)] and dup[(None, 1)]
    later = {(r.k, r.o): r.is_later for r in dedup.mark_later_duplicates(df, ["k", "j"], ["o"]).collect()}
    assert later[(1, 3)] and not later[(1, 1)] and not later[(2, 1)] and later[(None, 2)]
    same = spark.createDataFrame([(1, "a", 1)] * 3, "k int, j string, o int")
    assert sorted(r.is_later for r in dedup.mark_later_duplicates(same, ["k"], ["o"]).collect()) == [False, True, True]


def _groups(spark, rows):
    return spark.createDataFrame(rows, GROUPS)


def test_dim_sync_of_itself_changes_nothing(spark):
    g = _groups(spark, [("G1", "F", "active", "p", "s", "b", dt.date(2020, 1, 1), None)])
    assert {r.action for r in dimsync.dim_diff(g, g).collect()} == {"keep"}
    assert sorted(dimsync.dim_sync(g, g).collect()) == sorted(g.collect())


def test_dim_sync_actions(spark):  # Q10, Q16, Q17
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    tgt = _groups(spark, [
        ("G1", "F", "active", "p", "s", "b", d1, None),   # close date NULL -> date: update
        ("G2", "F", "active", "p", "s", "b", d1, None),   # NULL -> NULL: keep
        ("G3", "F", "active", "p", "s", "b", d1, d2),     # only barn changes: keep (untracked)
        ("G4", "F", "active", "p", "s", "b", d1, None),   # gone from report: delete
    ])
    src = _groups(spark, [
        ("G1", "F", "closed", "p", "s", "b", d1, d2),
        ("G2", "F", "active", "p", "s", "b", d1, None),
        ("G3", "F", "active", "p", "s", "b2", d1, d2),
        ("G5", "F", "active", "p", "s", "b", d1, None),   # new: insert
        ("G6", "F", "active", "p", "s", "b", d1, None),   # new but listed twice: reject
        ("G6", "F", "active", "p", "s", "b", d2, None),
    ])
    acts = {r.group_num: r.action for r in dimsync.dim_diff(src, tgt).collect()}
    assert acts == {"G1": "update", "G2": "keep", "G3": "keep", "G4": "delete", "G5": "insert", "G6": "reject"}
    new = {r.group_num: r for r in dimsync.dim_sync(src, tgt).collect()}
    assert set(new) == {"G1", "G2", "G3", "G5"}
    assert new["G1"].status == "closed" and new["G1"].close_date == d2 and new["G3"].barn == "b"
    acts2 = {r.group_num: r.action for r in dimsync.dim_diff(src, tgt, tracked=("status", "barn")).collect()}
    assert acts2["G3"] == "update"


def test_replace_slice_null_category_and_idempotence(spark):  # Q13, U3
    d0, d1 = dt.date(2020, 1, 1), dt.date(2020, 3, 1)
    tgt = spark.createDataFrame([(1, d0, "Sale"), (2, d1, "Sale"), (3, d1, None), (4, d1, "Death")],
                                "id int, d date, c string")
    batch = spark.createDataFrame([(5, d1, "Sale"), (6, d0, "Sale")], "id int, d date, c string")
    pred = mt.date_slice("d", "2020-02-01") & mt.category_slice("c", ["Death"], inside=False)
    once = mt.replace_slice(tgt, batch, pred)
    assert sorted(r.id for r in once.collect()) == [1, 3, 4, 5, 6]  # NULL category survives
    strict = mt.replace_slice(tgt, batch, pred, strict=True)
    twice = mt.replace_slice(strict, batch, pred, strict=True)
    assert sorted(r.id for r in strict.collect()) == sorted(r.id for r in twice.collect()) == [1, 3, 4, 5]


def test_typed_load_splits_rows(spark):  # K3, K7
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.DecimalType(4, 1)),
                           T.StructField("t", T.ShortType())])
    df = spark.createDataFrame([("a", "12.5", "200"), ("b", "abc", "1"), ("c", "12345.6", "1"),
                                ("toolong", "1", "1"), ("e", "1", "99999")], "k string, n string, t string")
    ok, bad = qa.typed_load(df, schema, {"k": 3})
    assert ok.count() + bad.count() == df.count()
    assert [r.k for r in ok.collect()] == ["a"] and ok.collect()[0].t == 200
    reasons = {r.k: r.reason for r in bad.collect()}
    assert reasons["b"].startswith("n:") and reasons["c"].startswith("n:")
    assert reasons["toolong"].startswith("k:") and reasons["e"].startswith("t:")


def test_pk_and_fk_checks(spark):
    f = spark.createDataFrame([("G1", 1), ("G1", 2), ("G9", 3)], "group_num string, v int")
    g = spark.createDataFrame([("G1",)], "group_num string")
    assert [(r.group_num, r.n_rows) for r in qa.pk_violations(f, ["group_num"]).collect()] == [("G1", 2)]
    assert [(r.group_num, r.n_rows) for r in qa.fk_orphans(f, g).collect()] == [("G9", 1)]


def test_movement_sign_and_rename(spark):  # Q23, P4, P5
    raw = spark.createDataFrame(
        [("S1", None, None, "Long Name", None, "Sale", "E1", "n", "m1", dt.date(2020, 1, 1), -1, 5, Decimal(1)),
         ("S1", "G1", None, None, None, "Sale", "E1", "n", "m2", dt.date(2020, 1, 1), 0, 5, Decimal(1)),
         ("S1", "G1", None, None, None, "Sale", "E1", "n", "m3", dt.date(2020, 1, 1), None, 5, Decimal(1))],
        "sow_unit string, `group` string, supplier string, customer string, plant string, event_category string, "
        "event_code string, event_name string, movement_id string, movement_date date, quantity int, weight int, "
        "cost decimal(18,2)")
    out = mv.movements(raw, rename={"Long Name": "Short"}).collect()
    by = {(r.movement_id, r.entity_type): r for r in out}
    assert by[("m1", "customer")].group_num == "Short" and by[("m1", "customer")].movement_type == "out"
    assert by[("m1", "sow_unit")].quantity == 1
    assert ("m2", "sow_unit") not in by  # the sow unit only counts when no group is given
    assert by[("m2", "group")].movement_type == "in" and by[("m3", "group")].movement_type == "in"


@pytest.mark.parametrize("num,den,digits,want", [
    (107, 40, 2, "2.68"), (1, 8, 2, "0.12"), (3, 8, 2, "0.38"), (5, 2, 0, "2"), (7, 2, 0, "4"), (-5, 2, 0, "-2"),
])
def test_exact_half_even_ratio(spark, num, den, digits, want):
    got = spark.range(1).select(exact_ratio(F.lit(num), F.lit(den), digits, 0)).first()[0]
    assert got == Decimal(want)


def test_one_carcass_load_is_skipped(spark):  # A3
    df = spark.createDataFrame([("L1", "G", 100), ("L1", "G", 104), ("L2", "G", 90)],
                               "load_id string, group_num string, avg_carcass_wt int")
    r = load_stddev_avg(df).first()
    assert r.load_avg_std_dev_carcass_wt == pytest.approx(2.8284, abs=1e-4)
