import datetime as dt

from pyspark.sql import Row

from martforge.sources import catalog as cat
from martforge.sources import reports as rp
from martforge.sources.definitions import ReportDef


def test_dimension_ids_of_mixed_types(spark):
    docs = spark.createDataFrame([('{"North": {"value": 12}, "South": {"value": "13"}}',)], "text string")
    dim = cat.with_all_member(cat.parse_dimension(docs), "All Producers")
    assert sorted((r.name, r.value) for r in dim.collect()) == [
        ("All Producers", "0"), ("North", "12"), ("South", "13")]


def test_catalog_flatten_mixed_depth(spark):
    text = ('{"reports": {"value": "R", "option_type": "option", "options": {'
            '"a": 1, "b": {"value": 2}, "c": {"value": 3, "options": {"d": {"value": "x"}}}}}}')
    out = cat.flatten_catalog(spark.createDataFrame([(text,)], "text string"))
    got = sorted((r.depth, r.k1, r.k2, r.k3, r.value) for r in out.collect())
    assert got == [(1, "reports", None, None, "R"), (2, "reports", "a", None, "1"),
                   (2, "reports", "b", None, "2"), (2, "reports", "c", None, "3"), (3, "reports", "c", "d", "x")]


def test_report_files_banner_rows_and_token(spark, tmp_path):
    for name, rows in {"movements_2020.csv": ["a", "b"], "sales_2020.csv": ["c"]}.items():
        lines = ["Report", "Generated", "h1,h2,h3"] + [f"{r},x{r},{i}" for i, r in enumerate(rows)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    df = rp.read_report(spark, str(tmp_path), skip_rows=3, ordinals=[2, 0], names=["n", "key"],
                        name_token="movements")
    assert sorted((r.key, r.n) for r in df.collect()) == [("a", "0"), ("b", "1")]
    cells = rp.cells_from_lines(rp.read_report_lines(spark, str(tmp_path), name_token="sales"), 3)
    assert {r.file_id for r in cells.collect()} == {"sales_2020"}


def test_delimited_sheet(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "b.csv").write_text("budget_id,group_num,rate\nG1-budget,G1,1.25\nG2-budget,G2,x\n")
    schema = T.StructType([T.StructField("budget_id", T.StringType()), T.StructField("group_num", T.StringType()),
                           T.StructField("rate", T.DecimalType(10, 4))])
    df = rp.read_delimited(spark, str(tmp_path / "b.csv"), schema)
    got = sorted((r.budget_id, r.rate) for r in df.collect())
    assert got[0][1] is not None and float(got[0][1]) == 1.25 and got[1][1] is None


def test_catalog_refuses_deeper_nodes(spark):
    import pytest

    doc = '{"a": {"options": {"b": {"options": {"c": {"value": "1", "options": {"d": {"value": "2"}}}}}}}}'
    docs = spark.createDataFrame([(doc,)], "text string")
    with pytest.raises(Exception, match="catalog nodes below 3 levels"):
        cat.flatten_catalog(docs).collect()
    assert cat.flatten_catalog(docs, depth=4).count() == 4


def test_all_is_a_sentinel_not_a_prefix(spark):
    from martforge.operators import report_slices as rs

    df = spark.createDataFrame([("All Saints Farm",), ("North",), ("0",)], "site string")
    assert [r.site for r in rs.report_slice(df, equals={"site": "All Saints Farm"}).collect()] == ["All Saints Farm"]
    assert [r.site for r in rs.report_slice(df, equals={"site": "0"}).collect()] == ["0"]
    assert rs.report_slice(df, equals={"site": rs.ALL}).count() == 3


def whole_file_lines(folder):
    """Lines as a reader of whole files sees them."""
    import re

    return sorted((f.name, n, line) for f in folder.iterdir() if not f.name.startswith((".", "_"))
                  for n, line in enumerate(re.split("\r?\n", f.read_bytes().decode())) if line)


def test_lines_of_files_in_many_blocks(spark, tmp_path):
    """Banner rows and line numbers are right wherever the blocks are cut."""
    for name, n, end in (("a.csv", 3000, "\n"), ("b.csv", 500, "\r\n"), ("c.csv", 1, ""), ("d.csv", 0, "")):
        (tmp_path / name).write_bytes(end.join(["" if i % 7 == 3 else f"row {i} é {'x' * (i % 90)}" for i in range(n)]).encode() + end.encode())
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = rp.read_report_lines(spark, str(tmp_path))
        got = sorted((r.file_path.rsplit("/", 1)[1], r.line_no, r.line) for r in lines.collect())
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == whole_file_lines(tmp_path)


def test_typed_load_of_a_report_by_its_definition(spark, tmp_path):
    d = ReportDef("t", "t", 2, ((1, "name", "string"), (3, "day", "date"), (4, "n", "int")), width=5, max_len={"name": 4})
    records = ["banner", "", "h0,h1,h2,h3,h4", "x,\"A, B\",,2020-01-31,5", "x,\"A \"\"q\"\"\",,2020-02-30,12 head", "x,A,,2020-01-01",
               "x,A,,2020-01-01,5,6", "x,,, ,", "x,A,,2020-01-01,99999999999"]
    (tmp_path / "t.csv").write_text("\n".join(records) + "\n")
    loaded = rp.load_report(rp.read_report_lines(spark, str(tmp_path)), d)
    assert sorted(map(str, rp.accepted(loaded).collect())) == sorted(
        map(str, [Row(name="A, B", day=dt.date(2020, 1, 31), n=5), Row(name=None, day=None, n=None)]))
    got = {(r.line_no, r.field, r.text, r.reason) for r in rp.rejected(loaded).collect()}
    assert got == {(4, "name", 'A "q"', "over 4 chars"), (4, "day", "2020-02-30", "not date"), (4, "n", "12 head", "not int"),
                   (5, None, "x,A,,2020-01-01", "a record has 5 cells"), (6, None, "x,A,,2020-01-01,5,6", "a record has 5 cells"),
                   (8, "n", "99999999999", "not int")}


def test_wide_report_takes_its_measures_from_the_header(spark, tmp_path):
    d = ReportDef("w", "w", 1, ((0, "Order_ID", "string"),), measures_from=2)
    (tmp_path / "w.csv").write_text("banner\nOrder ID,skip,Corn (lb),\"Soy, fine\",Corn (lb)\no1,,1.5,2,x\no2,,,3,4\n")
    loaded, headers = rp.load_measures(rp.read_report_lines(spark, str(tmp_path)), d)
    assert headers == ["Corn (lb)", "Soy, fine", "Corn (lb).1"]
    ok = rp.accepted(loaded)
    assert ok.columns == ["Order_ID", *headers] and [tuple(map(str, r)) for r in ok.collect()] == [("o2", "None", "3.0000", "4.0000")]
    assert [(r.field, r.text) for r in rp.rejected(loaded).collect()] == [("Corn (lb).1", "x")]


def test_form_cells_with_separators_and_encoded_names(spark, tmp_path):
    (tmp_path / "G 1+2.csv").write_text('Title,"1,250",x\n\nDeaths,,"3 ""a"""\n')
    cells = rp.cells_from_lines(rp.read_report_lines(spark, str(tmp_path)), 4)
    assert sorted((r.file_id, r.row_no, r.col_no, r.value) for r in cells.collect()) == [
        ("G 1+2", 0, 0, "Title"), ("G 1+2", 0, 1, "1,250"), ("G 1+2", 0, 2, "x"), ("G 1+2", 2, 0, "Deaths"), ("G 1+2", 2, 2, '3 "a"')]


def test_walk_of_a_six_level_tree(spark):
    doc = ('{"a": {"value": "A", "options": {"b": {"value": 1, "options": {"c": {"options": {"d": {"value": "2", "options": '
           '{"e": {"options": {"f": 7, "g": {"value": "x"}}}}}}}}}}}, "z": 3}')
    docs = spark.createDataFrame([(doc,), ("not json",), (None,), ("[1]",), ("{}",)], "text string")
    got = sorted((r.depth, "/".join(r.path), r.value) for r in cat.walk_catalog(docs).collect())
    assert got == [(1, "a", "A"), (1, "z", "3"), (2, "a/b", "1"), (3, "a/b/c", None), (4, "a/b/c/d", "2"), (5, "a/b/c/d/e", None),
                   (6, "a/b/c/d/e/f", "7"), (6, "a/b/c/d/e/g", "x")]
    assert cat.unparsed(docs).count() == 3
    assert cat.walk_catalog(docs.limit(0)).count() == 0


def test_codes_and_names_both_ways(spark):
    from martforge.operators import report_slices as rs

    docs = spark.createDataFrame([('{"status": {"value": "x", "options": {"active": {"value": 1}, "closed": {"value": "2"}, "2": {"value": 9}}}}',)], "text string")
    codes = cat.code_dictionary(docs)
    assert sorted(map(tuple, codes.collect())) == [("status", "2", "9"), ("status", "active", "1"), ("status", "closed", "2")]
    assert sorted(r.name for r in rs.named(codes, "status", ["1", "closed", "5"]).collect()) == ["active", "closed"]
    assert [r.name for r in rs.named(codes, "status", ["2"]).collect()] == ["2"]  # a name before a code
    asked = spark.createDataFrame([("status", "1"), ("status", "2"), ("status", "5"), ("site", "1"), ("status", None)], "field string, given string")
    got = {(r.field, r.given): (r.name, r.code, r.reason) for r in rs.decoded(asked, codes).collect()}
    no = (None, None, "neither a name nor a code")
    assert got == {("status", "1"): ("active", "1", None), ("status", "2"): ("2", "9", None), ("status", "5"): no, ("site", "1"): no, ("status", None): no}
    groups = spark.createDataFrame([("g1", "active"), ("g2", "closed")], "group_num string, status string")
    facts = spark.createDataFrame([("g1", "m"), ("g2", "n")], "group_num string, mill string")
    assert [r.group_num for r in rs.report_slice_by(facts, "status", ["1"], groups=groups, codes=codes).collect()] == ["g1"]
    assert [r.group_num for r in rs.report_slice_by(facts, "feed_mill", ["n"], groups=groups).collect()] == ["g2"]
    assert rs.report_slice_by(facts, "site", rs.ALL, groups=groups).count() == 2
