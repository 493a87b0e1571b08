"""Adapters: the driver's star-schema tables re-shaped into report inputs.

The reference reads seven kinds of spreadsheet report.  The test tables hold
generic order / line-item data, so every report shape here is a pure,
deterministic projection of them (FIXTURES.md part B).  Each adapter is a lazy
DataFrame over the whole input tables: its size grows with them and nothing is
sampled or capped.

Join strategy is left to Catalyst/AQE: the only tiny, bounded side is
``nation`` (25 rows by definition of the schema); everything else is joined
on its key and AQE converts to a broadcast only when the runtime size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.params import HOME_MILL, SETUP_LONG_NAME
from martforge.session import write_staged

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Fixed values of the fixtures (our own choices, documented in FIXTURES.md).
SEGMENT_GROUP_TYPE = {"BUILDING": "Finishing", "MACHINERY": "Wean to Finish", "HOUSEHOLD": "Nursery"}
OTHER_GROUP_TYPE = "GDU"
STATUS_BY_MOD3 = ("closed", "active", "scheduled")
LINE_CATEGORY = {1: "Market Sale", 2: "Inventory Adjustment", 3: "Death", 4: "Euthanize"}
OTHER_CATEGORY = "Transfer"
#: Rows by customer and priority that a task makes form cells for (with all else of the customer).
TASK_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one input table; files are listed at every call."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col: Column, mapping: dict, default) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default))


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines with what reports need of their orders."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")


def lines(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """``lineitem ⨝ orders`` with ``group_num = 'G' || o_custkey`` and ``d`` = ship date.

    ``where`` restricts the lines (e.g. a report's date window); predicates on
    line-item columns are pushed into the Parquet scan.  ``joined`` are all lines as of
    ``joined_lines``, of a caller that makes several reports of them or has laid them out.
    """
    out = (joined_lines(spark, sf_dir) if joined is None else joined).withColumns({
        "group_num": F.concat(F.lit("G"), F.col("o_custkey").cast("string")),
        "d": F.col("l_shipdate").cast("date"),
    })
    return out if where is None else out.filter(where)


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``joined_lines``, worked out once into the shared folder."""
    return write_staged(joined_lines(spark, sf_dir), "lines")


def _groups_keyed(spark: SparkSession, sf_dir: str, order_stats: DataFrame | None = None) -> DataFrame:
    """One row per customer with orders; keeps ``c_custkey`` for the target variant.

    ``order_stats`` (``o_custkey, open_date, last_date`` and any other
    per-customer columns, carried along) lets a caller reuse its own
    aggregation of ``orders`` instead of scanning it again.
    """
    o = order_stats if order_stats is not None else (
        read_table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("open_date"),
             F.max(F.col("o_orderdate").cast("date")).alias("last_date"))
    )
    extra = [c for c in o.columns if c not in ("o_custkey", "open_date", "last_date")]
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    status = _case(k % 3, {0: STATUS_BY_MOD3[0], 1: STATUS_BY_MOD3[1]}, STATUS_BY_MOD3[2])
    return (
        c.join(o, c.c_custkey == o.o_custkey, "inner")
        .join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "inner")
        .select(
            k,
            F.concat(F.lit("G"), k.cast("string")).alias("group_num"),
            _case(F.col("c_mktsegment"), SEGMENT_GROUP_TYPE, OTHER_GROUP_TYPE).alias("group_type"),
            status.alias("status"),
            F.col("n_name").alias("producer"),
            F.concat(F.lit("Site "), (k % 7).cast("string")).alias("site"),
            F.col("c_name").alias("barn"),
            "open_date",
            F.when(k % 3 == 0, F.col("last_date")).alias("close_date"),
            *extra,
        )
    )


GROUP_COLS = ["group_num", "group_type", "status", "producer", "site", "barn", "open_date", "close_date"]


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group list report (A2 shape): the source side of the dimension sync."""
    return _groups_keyed(spark, sf_dir).select(*GROUP_COLS)


def groups_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored dimension before the sync: some keys missing (inserts), some
    statuses stale (updates) and some keys no longer reported (deletes)."""
    g = _groups_keyed(spark, sf_dir)
    k = F.col("c_custkey")
    kept = g.filter(k % 10 != 0).withColumn(
        "status", F.when(k % 7 == 0, F.lit("inactive")).otherwise(F.col("status"))
    )
    gone = g.filter(k % 50 == 0).withColumn("group_num", F.concat(F.lit("X"), k.cast("string")))
    return kept.select(*GROUP_COLS).unionByName(gone.select(*GROUP_COLS))


def movements_raw(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Movement report, single-row layout (A4 shape)."""
    L = lines(spark, sf_dir, where, joined)
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    sign = F.when(flag == "A", F.lit(-1)).otherwise(F.lit(1))
    category = _case(F.col("l_linenumber"), LINE_CATEGORY, OTHER_CATEGORY)
    return L.select(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 10).cast("string")).alias("sow_unit"),
        F.when(flag != "R", F.col("group_num")).alias("group"),
        F.when((flag == "R") & (status == "O"), F.concat(F.lit("V"), F.col("l_suppkey").cast("string"))).alias("supplier"),
        F.when(flag == "A", F.when(F.col("l_suppkey") % 50 == 0, F.lit(SETUP_LONG_NAME))
               .otherwise(F.concat(F.lit("C"), (F.col("o_custkey") % 100).cast("string")))).alias("customer"),
        F.when((flag == "A") & (status == "F"), F.concat(F.lit("P"), (F.col("l_suppkey") % 3).cast("string"))).alias("plant"),
        category.alias("event_category"),
        F.concat(F.lit("E"), F.col("l_linenumber").cast("string")).alias("event_code"),
        F.concat(category, F.lit(" "), status).alias("event_name"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("movement_id"),
        F.col("d").alias("movement_date"),
        (sign * F.col("l_quantity").cast("int")).alias("quantity"),
        (sign * F.col("l_quantity").cast("int") * 250).alias("weight"),
        (sign * F.col("l_extendedprice").cast("decimal(18,2)")).alias("cost"),
    )


def movements_raw_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movement report with the date a movement was applied, some days after the event."""
    n = F.regexp_extract("movement_id", r"-(\d+)$", 1).cast("int")
    return movements_raw(spark, sf_dir).withColumn("applied_date", F.date_add("movement_date", n * 9))


def deaths_raw(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Mortality list report (A3 shape)."""
    L = lines(spark, sf_dir, where, joined).filter(F.col("l_linenumber").isin(3, 4))
    category = F.when(F.col("l_linenumber") == 3, F.lit("Death")).otherwise(F.lit("Euthanize"))
    return L.select(
        "group_num",
        F.col("d").alias("movement_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_quantity").cast("int") * 3).alias("weight"),
        category.alias("event_category"),
        F.concat(F.lit("Mortality "), F.col("l_linestatus")).alias("event_name"),
    )


def carcass(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Carcass detail sheet (A5 detail shape): three carcass rows per line."""
    L = lines(spark, sf_dir, where, joined)
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    cwt = price * F.lit(0.001).cast("decimal(4,3)")
    head = price * F.lit(0.01).cast("decimal(3,2)")
    # Prices are those of the line, so they are worked out before it becomes three rows.
    priced = L.select(
        "l_suppkey", "l_linenumber", "d", F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_quantity").cast("decimal(10,2)").alias("qty"), disc.alias("disc"), tax.alias("tax"),
        cwt.alias("base_price_cwt"),
        (cwt * (F.lit(1) - disc)).alias("value_cwt"),
        (cwt * tax).alias("vob_cwt"),
        head.alias("base_price"),
        (head * (F.lit(1) - disc)).alias("value"),
        (head * tax).alias("vob"),
    )
    base = priced.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    qty, disc, tax, kk = F.col("qty"), F.col("disc"), F.col("tax"), F.col("k").cast("decimal(4,0)")
    return base.select(
        F.concat(F.lit("P"), (F.col("l_suppkey") % 3).cast("string")).alias("plant"),
        F.col("l_suppkey").cast("int").alias("tattoo"),
        F.col("d").alias("kill_date"),
        "quantity",
        (qty * F.lit(1.15).cast("decimal(3,2)") + F.lit(200) + kk).alias("avg_live_wt"),
        (F.lit(180) + qty + kk * (F.col("l_linenumber") + 1) + disc * F.lit(10)).alias("avg_carcass_wt"),
        "base_price_cwt", "value_cwt", "vob_cwt", "base_price", "value", "vob",
        (F.lit(0.5).cast("decimal(2,1)") + disc).alias("back_fat"),
        (F.lit(2) + tax).alias("loin_depth"),
        (F.lit(0.5).cast("decimal(2,1)") + disc + kk * F.lit(0.01).cast("decimal(3,2)")).alias("lean"),
        (F.lit(0.7).cast("decimal(2,1)") + tax).alias("yield"),
    )


def loads(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Sales header sheet (A5 header shape): one row per (group, tattoo, kill date)."""
    L = lines(spark, sf_dir, where, joined)
    return L.select(
        "group_num",
        F.col("d").alias("kill_date"),
        F.concat(F.lit("P"), (F.col("l_suppkey") % 3).cast("string")).alias("plant"),
        F.col("l_suppkey").cast("int").alias("tattoo"),
    ).distinct()


def _ingredient_base(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    # One column of both figures, so that none is pruned from a sheet's joins: those of
    # both sheets are then the same to Spark, which works them out once.
    L = lines(spark, sf_dir, where, joined).withColumn("figures", F.array("l_quantity", "l_extendedprice"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (
        L.join(p, L.l_partkey == p.p_partkey, "inner")
        .join(s, L.l_suppkey == s.s_suppkey, "inner")
        .select(
            F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("Order ID"),
            F.col("group_num").alias("Group"),
            F.col("p_type").alias("Diet"),
            F.col("d").alias("Delivery Date"),
            F.when(F.col("l_suppkey") % 3 == 0, F.lit(HOME_MILL)).otherwise(F.col("s_name")).alias("Mill"),
            "figures", "l_returnflag", "l_linestatus",
        )
    )


def _figure(i: int, kind: str) -> Column:
    return F.col("figures")[i].cast(kind)


ID_HEADERS = ["Order ID", "Group", "Diet", "Delivery Date", "Mill"]


def ingredient_qty(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Wide quantity sheet: measure headers carry a unit, ``'<name> (<unit>)'``."""
    b = _ingredient_base(spark, sf_dir, where, joined)
    q = _figure(0, "decimal(18,4)")
    return b.select(
        *[F.col(f"`{h}`") for h in ID_HEADERS],
        (q * 100).cast("decimal(18,4)").alias("Corn (lb)"),
        F.when(F.col("l_returnflag") != "N", q * 40).cast("decimal(18,4)").alias("Soy (lb)"),
        F.when(F.col("l_linestatus") != "F", q * 10).cast("decimal(18,4)").alias("Corn (bu)"),
    )


def ingredient_cost(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Wide cost sheet: repeated headers carry a ``.1`` copy suffix."""
    b = _ingredient_base(spark, sf_dir, where, joined)
    p = _figure(1, "decimal(18,2)")
    return b.select(
        *[F.col(f"`{h}`") for h in ID_HEADERS],
        (p * F.lit(0.5).cast("decimal(2,1)")).cast("decimal(18,4)").alias("Corn"),
        F.when(F.col("l_returnflag") != "N", p * F.lit(0.25).cast("decimal(3,2)")).cast("decimal(18,4)").alias("Soy"),
        F.when(F.col("l_linestatus") != "F", p * F.lit(0.125).cast("decimal(4,3)")).cast("decimal(18,4)").alias("Corn.1"),
    )


def budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial budget sheet (A7 shape): one ``budget`` row per group with rates."""
    from martforge.schemas import BUDGETS

    g = _groups_keyed(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    bal = F.col("c_acctbal").cast("decimal(10,4)")
    # Two-decimal multipliers keep every rate exact at the SMALLMONEY scale.
    rates = {
        "feed_grinding_rate": "0.01",
        "feed_delivery_rate": "0.02",
        "trucking_market_rate": "0.03",
        "trucking_feeder_rate": "0.04",
        "rent_cost_week": "0.05",
        "overhead_cost_pig": "0.06",
    }
    j = g.join(c, "c_custkey")
    cols = {
        "budget_id": F.concat(F.col("group_num"), F.lit("-budget")),
        "group_num": F.col("group_num"),
        "budget_type": F.lit("budget"),
        "group_type": F.col("group_type"),
        "producer": F.col("producer"),
        "site": F.col("site"),
        "barn": F.col("barn"),
        "start_date": F.col("open_date"),
        "close_date": F.col("close_date"),
    }
    for name, r in rates.items():
        cols[name] = bal * F.lit(r).cast("decimal(3,2)")
    out = []
    for f in BUDGETS.fields:
        expr = cols.get(f.name, F.lit(None))
        out.append(expr.cast(f.dataType).alias(f.name))
    return j.select(*out)


# ---------------------------------------------------------------------------
# Closeout forms: one form per group as a cell table (file_id, row, col, value).
# ---------------------------------------------------------------------------
# Fixture choices: rows of the section titles, the label of each order
# priority (IN section) and line number (OUT section).
ANCHOR_ROWS = [0, 10, 20, 36, 42, 50, 56, 62, 68]
DECOY_ROW = 9  # a later section's title appearing early, which the anchor search must skip
PRIORITY_LABEL = {1: "Gilt Arrival To Iso", 2: "Purchase Wean Pigs", 3: "Transfer Feeder Pig",
                  4: "Purchase Wean Pigs", 5: "Other In"}
LINE_LABEL = {1: "Standard Market Sale", 2: "Discount Market Hog", 3: "Deaths", 4: "Yard Dead",
              5: "Dead On Transport", 6: "Transfer Feeder Pig", 7: "Gilt Sale External"}


def _cell(row, col, value) -> Column:
    """One ``(row_no, col_no, value)`` struct; constant cells are one SQL literal."""
    if isinstance(row, int) and isinstance(col, int) and isinstance(value, str):
        text = value.replace("'", "''")
        return F.expr(f"named_struct('row_no', {row}, 'col_no', {col}, 'value', '{text}')")
    r = F.lit(row) if isinstance(row, int) else row.cast("int")
    c = F.lit(col) if isinstance(col, int) else col.cast("int")
    v = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.struct(r.alias("row_no"), c.alias("col_no"), v.alias("value"))


def _explode_cells(df: DataFrame, cells: list[Column]) -> DataFrame:
    return df.select("file_id", F.explode(F.array(*cells)).alias("c")).select(
        "file_id", "c.row_no", "c.col_no", "c.value")


def _dec(x: str) -> Column:
    return F.lit(x).cast(f"decimal({max(len(x), 3)},{len(x.split('.')[1]) if '.' in x else 0})")


def cells(spark: SparkSession, sf_dir: str, where: Column | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Closeout forms (A6 shape), built from each group's orders and lines.

    ``where`` restricts the line items the forms summarise (an earlier
    version of the same forms).
    """
    from martforge.schemas import CLOSEOUT_FIXED
    from martforge.sources.layout import SECTION_LABELS, fixed_position

    # One pass over orders (by customer and priority) and one over lines (by
    # customer and line number), both written to the shared folder; the
    # per-customer figures are sums of those.
    o = read_table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    pin = (o.withColumn("p", F.substring("o_orderpriority", 1, 1).cast("int"))
           .groupBy("o_custkey", "p")
           .agg(F.count(F.lit(1)).alias("cnt"), F.sum(price).alias("rec"),
                F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("n_p"),
                F.min(F.col("o_orderdate").cast("date")).alias("open_date"),
                F.max(F.col("o_orderdate").cast("date")).alias("last_date")))
    pin = write_staged(pin, "form-orders")
    og = pin.groupBy("o_custkey").agg(
        F.min("open_date").alias("open_date"), F.max("last_date").alias("last_date"),
        F.sum("cnt").alias("n_orders"), F.sum("n_p").alias("n_p"), F.sum("rec").alias("tot"))
    g = _groups_keyed(spark, sf_dir, og)
    L = lines(spark, sf_dir, where, joined)
    lp = F.col("l_extendedprice").cast("decimal(18,2)")
    lout = L.groupBy("o_custkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(F.col("l_quantity").cast("int")).alias("q"),
        F.sum(lp).alias("rec"), F.sum(F.col("l_tax").cast("decimal(4,2)") * lp).alias("taxed"))
    lout = write_staged(lout, "form-lines")
    lg = lout.groupBy("o_custkey").agg(
        F.sum("cnt").alias("n_lines"), F.sum("rec").alias("ext"), F.sum("taxed").alias("taxed"),
        F.sum(F.when(F.col("l_linenumber") == 1, F.col("rec"))).alias("r1"))
    # Each row becomes up to 57 cells, so tasks are measured by rows, not by bytes.
    tasks = max(1, -(-pin.count() // TASK_ROWS))
    base = (g.join(lg, g.c_custkey == lg.o_custkey).drop("o_custkey")
            .withColumn("file_id", F.col("group_num"))).repartition(tasks, "c_custkey")
    pin, lout = pin.repartition(tasks, "o_custkey", "p"), lout.repartition(tasks, "o_custkey", "l_linenumber")
    pos = {name: fixed_position(i) for i, (name, _) in enumerate(CLOSEOUT_FIXED)}
    epoch = F.to_date(F.lit("1899-12-30"))
    nl, no = F.col("n_lines"), F.col("n_orders")
    fixed = {
        "group_num": F.concat(F.lit("Group: "), F.col("group_num")),
        "business_unit": F.concat(F.lit("Unit: U"), (F.col("c_custkey") % 4).cast("string")),
        "producer": F.concat(F.lit("Producer: "), F.col("producer")),
        "start_date": F.datediff(F.col("open_date"), epoch).cast("string"),
        "close_date": F.coalesce(F.datediff(F.col("close_date"), epoch).cast("string"), F.lit("")),
        "group_type": F.col("group_type"),
        "site": F.col("site"),
        "barn": F.col("barn"),
        "capacity": (no * 25).cast("string"),
    }
    per_group = [_cell(r, 0, t) for r, t in zip(ANCHOR_ROWS, SECTION_LABELS)]
    per_group.append(_cell(DECOY_ROW, 0, SECTION_LABELS[7]))
    per_group += [_cell(pos[k][0], pos[k][1], v) for k, v in fixed.items()]
    per_group += [
        _cell(17, 0, "Totals Summary Pigs"), _cell(17, 3, no.cast("string")),
        _cell(29, 0, "Totals Summary Pigs"), _cell(29, 3, nl.cast("string")),
        _cell(38, 0, "Inventory Adjustment"), _cell(38, 3, F.col("n_p").cast("string")),
        _cell(38, 5, F.concat(F.lit("-"), (F.col("n_p") * 10).cast("string"))), _cell(38, 6, "12.5"),
        _cell(44, 0, "Fcr"), _cell(44, 3, _dec("2.5") + _dec("0.01") * (nl % 50)),
        _cell(44, 5, _dec("2.6") + _dec("0.01") * (nl % 50)),
        _cell(44, 6, "Avg Dof"), _cell(44, 8, _dec("100.5") + nl % 60),
        _cell(45, 0, "Mortality"), _cell(45, 3, _dec("0.001") * (nl % 97)), _cell(45, 5, _dec("0.001") * (nl % 89)),
        _cell(45, 6, "Total Location Days"), _cell(45, 8, (F.lit(120) + nl % 30).cast("string")),
        _cell(46, 0, "Adg"), _cell(46, 3, _dec("1.5") + _dec("0.01") * (nl % 10)),
        _cell(46, 5, _dec("1.55") + _dec("0.01") * (nl % 10)),
        _cell(46, 6, "Number Pigs Started"), _cell(46, 8, (no * 20).cast("string")),
        _cell(47, 6, "Avg Wt Pigs Started"), _cell(47, 8, _dec("12.5") + no % 7),
        _cell(52, 0, "Total Feed"), _cell(52, 3, F.col("ext") * _dec("0.0001")),
        _cell(52, 5, F.col("ext") * _dec("0.0002")), _cell(52, 8, nl * 1000),
        _cell(53, 0, "Feed Ingredient"), _cell(53, 3, F.col("taxed") * _dec("0.01")),
        _cell(53, 10, "Avg Kcal Lb"), _cell(53, 12, "1.5"),
        _cell(58, 0, "Standard Market Sale"), _cell(58, 8, F.col("r1")),
        _cell(59, 0, "Total Income"), _cell(59, 8, F.col("tot") - F.col("ext")),
        _cell(64, 0, "Feed Delivery"), _cell(64, 8, nl * _dec("12.5")),
        _cell(65, 0, "Total Expenses"), _cell(65, 8, F.col("taxed")),
    ]
    fixed_cells = _explode_cells(base, per_group)

    # IN section: one row per order priority.
    pin = pin.withColumn("file_id", F.concat(F.lit("G"), F.col("o_custkey").cast("string")))
    cnt, rec, pc = F.col("cnt"), F.col("rec"), F.col("p")
    prio_label = None
    for k, v in PRIORITY_LABEL.items():
        prio_label = F.when(pc == k, F.lit(v)) if prio_label is None else prio_label.when(pc == k, F.lit(v))
    row = pc + 11
    in_cells = _explode_cells(pin, [
        _cell(row, 0, prio_label),
        _cell(row, 3, F.when((pc == 3) & (cnt == 1), F.lit("-")).otherwise(cnt.cast("string"))),
        _cell(row, 5, (cnt * 55 + pc).cast("string")),
        _cell(row, 8, F.when((pc == 2) & (cnt == 2), F.lit(""))
              .when((pc == 1) & (cnt >= 3), F.concat(F.lit("-"), rec.cast("string")))
              .otherwise(rec.cast("string"))),
        _cell(row, 10, cnt * _dec("2.5")),
    ])

    # OUT section: one row per line number.
    n = F.col("l_linenumber")
    lout = lout.withColumn("file_id", F.concat(F.lit("G"), F.col("o_custkey").cast("string")))
    line_label = None
    for k, v in LINE_LABEL.items():
        line_label = F.when(n == k, F.lit(v)) if line_label is None else line_label.when(n == k, F.lit(v))
    row = n + 21
    out_cells = _explode_cells(lout, [
        _cell(row, 0, line_label),
        _cell(row, 3, F.when(n == 4, F.concat(F.lit("-"), cnt.cast("string"))).otherwise(cnt.cast("string"))),
        _cell(row, 5, F.when((n == 3) & (cnt == 1), F.lit("")).otherwise((F.col("q") * 2).cast("string"))),
        _cell(row, 8, F.when(n == 3, F.lit("-")).otherwise(rec.cast("string"))),
    ])
    return fixed_cells.unionByName(in_cells).unionByName(out_cells)


# ---------------------------------------------------------------------------
# Report exports, JSON documents and the diet sheet.
# ---------------------------------------------------------------------------
def _report_files(table: DataFrame, key: Column, kind: str, title: str, header: str,
                  fields: list[Column]) -> DataFrame:
    from martforge.params import REPORT_BANNER_ROWS, REPORT_FILES

    path = F.concat(F.lit(f"/reports/{kind}_part"), (key % REPORT_FILES).cast("string"), F.lit(".csv"))
    data = table.select(
        path.alias("file_path"),
        (F.floor(key / REPORT_FILES).cast("long") + REPORT_BANNER_ROWS).cast("int").alias("line_no"),
        F.concat_ws(",", *fields).alias("line"),
    )
    banner = data.select("file_path").distinct().select("file_path", F.explode(F.array(
        F.struct(F.lit(0).alias("line_no"), F.lit(title).alias("line")),
        F.struct(F.lit(1).alias("line_no"), F.concat(F.lit("Source: "), F.col("file_path")).alias("line")),
        F.struct(F.lit(2).alias("line_no"), F.lit(header).alias("line")),
    )).alias("b")).select("file_path", "b.line_no", "b.line")
    return banner.unionByName(data)


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder of CSV exports, each with banner rows: the order list
    and the customer list, each split over several files.

    ``(file_path, line_no, line)`` as ``sources.reports.read_report_lines``
    returns for files on disk.
    """
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    orders = _report_files(o, k, "orders", "Order List", "Order,Customer,Status,Total,Date,Priority", [
        k.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.col("o_orderdate").cast("date").cast("string"), F.col("o_orderpriority")])
    customers = _report_files(c, F.col("c_custkey"), "customers", "Customer List", "Customer,Name,Nation,Segment", [
        F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"),
        F.col("c_mktsegment")])
    return orders.unionByName(customers)


def site_dimension_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``{"<site>": {"value": id}}`` document per customer; even ids as numbers, odd as text."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    idv = F.when(F.col("c_custkey") % 2 == 0, k).otherwise(F.concat(F.lit('"'), k, F.lit('"')))
    return c.select(F.concat(F.lit('{"'), F.col("c_name"), F.lit('": {"value": '), idv, F.lit("}}")).alias("text"))


def catalog_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One menu-tree document per customer, leaves of mixed depth (1 to 3 keys)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey").cast("string")
    leaf = (F.when(F.col("c_custkey") % 3 == 0, k)
            .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit('{"value": "'), k, F.lit('"}')))
            .otherwise(F.concat(F.lit('{"value": "'), k, F.lit('", "option_type": "button", "options": {"'),
                                F.col("n_name"), F.lit('": '), F.col("n_regionkey").cast("string"), F.lit("}}"))))
    text = F.concat(F.lit('{"'), F.col("c_mktsegment"), F.lit('": {"value": '), F.col("c_nationkey").cast("string"),
                    F.lit(', "option_type": "option", "options": {"'), F.col("c_name"), F.lit('": '), leaf,
                    F.lit("}}}"))
    return j.select(text.alias("text"))


def deep_catalog_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree per customer, a chain of 1 to 6 nodes with a leaf beside each."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    text = F.concat(F.lit('{"value": "end '), k, F.lit('"}'))
    for level in range(5, 0, -1):
        chain = F.concat(F.lit('{"value": '), F.lit(str(level)), F.lit(', "options": {"leaf": "x'), k, F.lit('", "n'),
                         F.lit(str(level + 1)), F.lit('": '), text, F.lit("}}"))
        text = F.when(F.col("c_custkey") % 6 >= level, chain).otherwise(F.concat(F.lit('{"value": "end '), k, F.lit('"}')))
    return c.select(F.concat(F.lit('{"n1": '), text, F.lit("}")).alias("text"))


def code_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option lists of two fields: producers (number codes, from ``nation``) and regions
    (text codes; two of them share one)."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    one = lambda field, name, code: F.concat(F.lit(f'{{"{field}": {{"value": "list", "options": {{"'), name, F.lit('": {"value": '), code, F.lit("}}}}"))
    return n.select(one("producer", F.col("n_name"), F.col("n_nationkey").cast("string")).alias("text")).unionByName(
        r.select(one("region", F.col("r_name"), F.concat(F.lit('"R'), F.least(F.col("r_regionkey"), F.lit(3)).cast("string"), F.lit('"'))).alias("text")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer, by the name or the code of a producer or region, or by
    something that is neither."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    kind = F.col("c_custkey") % 5
    return j.select(
        F.col("c_custkey").alias("request"),
        F.when(kind == 3, F.lit("region")).otherwise(F.lit("producer")).alias("field"),
        F.when(kind == 0, F.col("n_name")).when(kind == 1, F.col("n_nationkey").cast("string"))
        .when(kind == 2, F.concat(F.lit("old "), F.col("n_name"))).when(kind == 3, F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))
        .otherwise(F.lit(None).cast("string")).alias("given"),
    )


def diet_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diet delivery sheet, columns in report order (group, date, diet, quantity, mill, order, cost)."""
    b = _ingredient_base(spark, sf_dir)
    return b.select(
        F.col("Group"), F.col("`Delivery Date`"), F.col("Diet"),
        (_figure(0, "decimal(18,4)") * 100).cast("decimal(18,4)").alias("quantity"),
        F.col("Mill"), F.col("`Order ID`"),
        (_figure(1, "decimal(18,2)") * F.lit(0.5).cast("decimal(2,1)")).alias("cost"),
    )
