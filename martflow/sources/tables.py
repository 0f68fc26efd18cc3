"""Adapters from the given test tables to the shapes the warehouse consumes.

The test tables hold no retail logs or change-logs, so each adapter maps a
given table onto one record shape (SURVEY 7.3).  Everything is derived by
Spark from the tables, so the work grows with them.  Mapping rules:

behaviour rows (``events``)
    mid = user_id as text, ts = event time in epoch ms, seq = event_id,
    is_new = '1' iff event_type = 'signup', entry page iff event_type = 'view'.
change-log (``topic_db``)
    order_detail = lineitem (one insert each); order_info = orders (insert
    '1001', plus an update to '1003' for status F and '1002' for P);
    activity rows for l_discount >= 0.05, coupon rows for l_tax >= 0.06;
    payment_info for status P (insert '1601', update to '1602');
    cart_info = versions of one (l_orderkey, l_linenumber) ordered by
    (l_shipdate, l_partkey, l_suppkey): first an insert, then updates whose
    ``old.sku_num`` is the previous quantity; customer / part / supplier /
    nation rows for the dimension sync.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from martflow.functions.timefmt import ntz_to_millis

DATABASE = "shop"  # database name carried by the adapted change records


def table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    """Read one given table, only the named columns (pruned at the scan)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def _dec2(c) -> F.Column:
    return c.cast("decimal(16,2)")


def _text(c) -> F.Column:
    return c.cast("string")


def _secs(ts_col: str) -> F.Column:
    return F.floor(ntz_to_millis(F.col(ts_col)) / 1000).cast("bigint")


def _fmt(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ----------------------------------------------------------------- events
def traffic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as flat behaviour rows: event_id, mid, ts (ms), is_new, is_entry."""
    e = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return e.select(
        "event_id", _text(F.col("user_id")).alias("mid"),
        ntz_to_millis(F.col("ts")).alias("ts"),
        F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"),
        (F.col("event_type") == "view").alias("is_entry"),
        "event_type")


def arriving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as they arrive: :func:`traffic_rows` with ``arrival`` (ms), later than ``ts`` by ``value`` minutes."""
    e = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    ts = ntz_to_millis(F.col("ts"))
    return e.select("event_id", _text(F.col("user_id")).alias("mid"), ts.alias("ts"), (F.col("event_type") == "view").alias("is_entry"),
                    "event_type", (ts + F.floor(F.col("value") * 60_000).cast("bigint")).alias("arrival"))


def log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` rendered as ``topic_log`` JSON text (column ``value``) + event_id.

    signup -> start log; other types -> page log (entry page for 'view');
    error rows carry ``err``; click rows two actions; purchase rows two
    displays, view rows one.
    """
    e = table(spark, sf_dir, "events")
    k = F.from_json(F.col("props"), "k BIGINT")["k"]
    et = F.col("event_type")
    common = F.create_map(F.lit("mid"), _text(F.col("user_id")),
                          F.lit("is_new"), F.when(et == "signup", "1").otherwise("0"),
                          F.lit("ch"), F.lit("web"))
    page = F.when(et != "signup", F.create_map(
        F.lit("page_id"), et,
        F.lit("last_page_id"), F.when(et != "view", F.lit("home")),
        F.lit("item"), _text(k)))
    start = F.when(et == "signup", F.struct(F.lit("icon").alias("entry"),
                                            F.col("value").alias("loading_time")))
    err = F.when(et == "error", F.struct(k.alias("error_code"), F.lit("app crash").alias("msg")))
    actions = F.when(et == "click", F.array(
        F.create_map(F.lit("action_id"), F.lit("click"), F.lit("item"), _text(k)),
        F.create_map(F.lit("action_id"), F.lit("favor_add"), F.lit("item"), _text(k + 1))))
    displays = F.when(et == "purchase", F.array(
        F.create_map(F.lit("item"), _text(k), F.lit("order"), F.lit("1")),
        F.create_map(F.lit("item"), _text(k + 1), F.lit("order"), F.lit("2")))) \
        .when(et == "view", F.array(
            F.create_map(F.lit("item"), _text(k), F.lit("order"), F.lit("1"))))
    rec = F.struct(common.alias("common"), start.alias("start"),
                   F.map_filter(page, lambda a, b: b.isNotNull()).alias("page"),
                   err.alias("err"), actions.alias("actions"), displays.alias("displays"),
                   ntz_to_millis(F.col("ts")).alias("ts"))
    return e.select("event_id", F.to_json(rec).alias("value"))


def open_log_lines(spark: SparkSession, sf_dir: str, minute_ties: bool = False) -> DataFrame:
    """``events`` as ``topic_log`` lines that go beyond any fixed schema (+ event_id).

    Each line holds a number inside ``page``, a nested object in ``common``, a
    top-level field that no job reads (``extra``) and, for clicks, an element
    with a ``ts`` of its own.  signup -> start log, other types -> page log.
    With ``minute_ties`` times are cut to the hour, so that many lines of a
    visitor share a millisecond and only their arrival tells them apart.
    """
    e = table(spark, sf_dir, "events")
    if minute_ties:
        e = e.withColumn("ts", F.date_trunc("hour", "ts"))
    k = F.from_json(F.col("props"), "k BIGINT")["k"]
    et = F.col("event_type")
    common = F.struct(_text(F.col("user_id")).alias("mid"),
                      F.when(et == "signup", "1").otherwise("0").alias("is_new"),
                      F.struct(F.lit("web").alias("ch"), k.alias("area")).alias("device"))
    page = F.when(et != "signup", F.struct(
        et.alias("page_id"), F.when(et != "view", F.lit("home")).alias("last_page_id"),
        k.alias("during_time")))
    start = F.when(et == "signup", F.struct(F.lit("icon").alias("entry"), k.alias("loading_time")))
    err = F.when(et == "error", F.struct(k.alias("error_code"), F.lit("app crash").alias("msg")))
    actions = F.when(et == "click", F.array(
        F.struct(F.lit("click").alias("action_id"), k.alias("item"), F.lit(1).alias("ts")),
        F.struct(F.lit("favor_add").alias("action_id"), (k + 1).alias("item"), F.lit(2).alias("ts"))))
    displays = F.when(et.isin("purchase", "view"), F.array(F.struct(k.alias("item"), F.lit(1).alias("order"))))
    rec = F.struct(common.alias("common"), start.alias("start"), page.alias("page"), err.alias("err"),
                   actions.alias("actions"), displays.alias("displays"),
                   F.struct(F.array(F.lit(1), k).alias("v")).alias("extra"),
                   ntz_to_millis(F.col("ts")).alias("ts"))
    return e.select("event_id", F.to_json(rec).alias("value"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text records with dirty rows, built from ``events.props`` (P1/P2 input).

    error -> truncated object (invalid); signup -> array; click -> object with
    type 'bootstrap-insert' (passes); purchase -> type 'bootstrap-start' when
    value < 10 (control record), else 'insert'; view -> the bare object.
    """
    e = table(spark, sf_dir, "events", ["event_id", "event_type", "value", "props"])
    p, et = F.col("props"), F.col("event_type")
    wrap = lambda t: F.concat(F.lit('{"type":"' + t + '","data":'), p, F.lit("}"))
    value = (F.when(et == "error", F.expr("substring(props, 1, length(props) - 1)"))
             .when(et == "signup", F.concat(F.lit("["), p, F.lit("]")))
             .when(et == "click", wrap("bootstrap-insert"))
             .when((et == "purchase") & (F.col("value") < 10), wrap("bootstrap-start"))
             .when(et == "purchase", wrap("insert"))
             .otherwise(p))
    return e.select("event_id", value.alias("value"))


def delimited_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as ``id,name,ts`` lines; negative balance -> bad ts text,
    segment AUTOMOBILE -> missing field."""
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    ts = F.when(F.col("c_acctbal") < 0, F.lit("bad")).otherwise(_text(F.col("c_custkey") * 1000))
    line = F.when(F.col("c_mktsegment") == "AUTOMOBILE",
                  F.concat_ws(",", _text(F.col("c_custkey")), F.col("c_name"))) \
        .otherwise(F.concat_ws(",", _text(F.col("c_custkey")), F.col("c_name"), ts))
    return c.select(line.alias("value"))


def second_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as ``id,sex,ts`` lines (the second stream of the left-join
    demos): sex 'F' for a negative balance, else 'M'."""
    s = table(spark, sf_dir, "supplier", ["s_suppkey", "s_acctbal"])
    sex = F.when(F.col("s_acctbal") < 0, F.lit("F")).otherwise(F.lit("M"))
    line = F.concat_ws(",", _text(F.col("s_suppkey")), sex, _text(F.col("s_suppkey") * 1000 + 500))
    return s.select(line.alias("value"))


# --------------------------------------------------------------- topic_db
def _env(df: DataFrame, table_name: str, typ, ts, data, old=None) -> DataFrame:
    return df.select(F.lit(DATABASE).alias("database"), F.lit(table_name).alias("table"),
                     (typ if isinstance(typ, F.Column) else F.lit(typ)).alias("type"),
                     ts.alias("ts"), F.lit(None).cast("bigint").alias("xid"),
                     F.lit(None).cast("string").alias("commit"),
                     data.alias("data"),
                     (old if old is not None else F.lit(None).cast("map<string,string>")).alias("old"))


def _m(*pairs) -> F.Column:
    args = []
    for k, v in pairs:
        args += [F.lit(k), v]
    return F.create_map(*args)


def detail_id() -> F.Column:
    return F.concat_ws("-", _text(F.col("l_orderkey")), _text(F.col("l_linenumber")),
                       _text(F.col("l_partkey")), _text(F.col("l_suppkey")),
                       F.date_format(F.col("l_shipdate"), "yyyyMMdd"))


def order_detail_changes(li: DataFrame) -> DataFrame:
    price = _dec2(F.col("l_extendedprice"))
    data = _m(("id", detail_id()), ("order_id", _text(F.col("l_orderkey"))),
              ("sku_id", _text(F.col("l_partkey"))),
              ("sku_name", F.concat(F.lit("sku-"), _text(F.col("l_partkey")))),
              ("order_price", _text(price)),
              ("sku_num", _text(F.col("l_quantity").cast("bigint"))),
              ("create_time", _fmt(F.col("l_shipdate"))),
              ("source_type", F.col("l_returnflag")),
              ("source_id", _text(F.col("l_suppkey"))),
              ("split_total_amount", _text(price * (1 - _dec2(F.col("l_discount"))))),
              ("split_activity_amount", _text(price * _dec2(F.col("l_discount")))),
              ("split_coupon_amount", _text(price * _dec2(F.col("l_tax")))))
    return _env(li, "order_detail", "insert", _secs("l_shipdate"), data)


def _shifted(secs: F.Column, by: F.Column | None) -> F.Column:
    return secs if by is None else (secs + by).cast("bigint")


def activity_changes(li: DataFrame, shift: F.Column | None = None) -> DataFrame:
    a = li.filter(F.col("l_discount") >= 0.05)
    data = _m(("order_detail_id", detail_id()),
              ("activity_id", F.concat(F.lit("act-"), _text(F.col("l_discount").cast("decimal(4,2)")))),
              ("activity_rule_id", _text(F.col("l_linenumber"))))
    return _env(a, "order_detail_activity", "insert", _shifted(_secs("l_shipdate"), shift), data)


def coupon_changes(li: DataFrame, shift: F.Column | None = None) -> DataFrame:
    c = li.filter(F.col("l_tax") >= 0.06)
    data = _m(("order_detail_id", detail_id()),
              ("coupon_id", F.concat(F.lit("cpn-"), _text(F.col("l_tax").cast("decimal(4,2)")))),
              ("coupon_use_id", F.concat(F.lit("use-"), detail_id())))
    return _env(c, "order_detail_coupon", "insert", _shifted(_secs("l_shipdate"), shift), data)


def order_info_changes(orders: DataFrame) -> DataFrame:
    base = [("id", _text(F.col("o_orderkey"))), ("user_id", _text(F.col("o_custkey"))),
            ("province_id", F.substring(F.col("o_orderpriority"), 1, 1))]
    ins = _env(orders, "order_info", "insert", _secs("o_orderdate"),
               _m(*base, ("order_status", F.lit("1001")),
                  ("operate_time", F.lit(None).cast("string"))))
    upd_rows = orders.filter(F.col("o_orderstatus").isin("F", "P"))
    status = F.when(F.col("o_orderstatus") == "F", F.lit("1003")).otherwise(F.lit("1002"))
    upd = _env(upd_rows, "order_info", "update", _secs("o_orderdate") + 86400,
               _m(*base, ("order_status", status),
                  ("operate_time", _fmt(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")))),
               _m(("order_status", F.lit("1001"))))
    return ins.unionByName(upd)


def payment_changes(orders: DataFrame) -> DataFrame:
    p = orders.filter(F.col("o_orderstatus") == "P")
    base = [("id", _text(F.col("o_orderkey"))), ("order_id", _text(F.col("o_orderkey"))),
            ("payment_type", F.concat(F.lit("110"), F.substring(F.col("o_orderpriority"), 1, 1))),
            ("create_time", _fmt(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")))]
    ins = _env(p, "payment_info", "insert", _secs("o_orderdate") + 86400,
               _m(*base, ("payment_status", F.lit("1601"))))
    upd = _env(p, "payment_info", "update", _secs("o_orderdate") + 86460,
               _m(*base, ("payment_status", F.lit("1602"))), _m(("payment_status", F.lit("1601"))))
    return ins.unionByName(upd)


def _cart_versions(li: DataFrame) -> tuple:
    """The rows of the cart's changes; their type and time, and the fields of ``data`` and ``old`` (of updates)."""
    # A cart row has a handful of versions, so one window per cart row will do;
    # operators/sequence.bucketed_lag is the form for keys of any length.
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_shipdate", "l_partkey", "l_suppkey")
    v = li.withColumns({"__prev": F.lag("l_quantity").over(w), "__n": F.row_number().over(w)})
    first = F.col("__n") == 1
    data = (("id", F.concat_ws("-", _text(F.col("l_orderkey")), _text(F.col("l_linenumber")))),
            ("user_id", _text(F.col("l_orderkey"))), ("sku_id", _text(F.col("l_partkey"))),
            ("cart_price", _text(_dec2(F.col("l_extendedprice")))),
            ("sku_num", _text(F.col("l_quantity").cast("bigint"))),
            ("sku_name", F.concat(F.lit("sku-"), _text(F.col("l_partkey")))),
            ("is_checked", F.lit("1")), ("create_time", _fmt(F.col("l_shipdate"))),
            ("operate_time", F.when(~first, _fmt(F.col("l_shipdate")))),
            ("is_ordered", F.lit("0")), ("order_time", F.lit(None).cast("string")),
            ("source_type", F.col("l_returnflag")), ("source_id", _text(F.col("l_suppkey"))))
    old = (("sku_num", _text(F.col("__prev").cast("bigint"))),)
    return v, F.when(first, "insert").otherwise("update"), _secs("l_shipdate"), data, old, ~first


def cart_changes(li: DataFrame) -> DataFrame:
    v, typ, ts, data, old, is_update = _cart_versions(li)
    return _env(v, "cart_info", typ, ts, _m(*data), F.when(is_update, _m(*old)))


def cart_lines(li: DataFrame) -> DataFrame:
    """The JSON lines of :func:`cart_changes`, character by character, rendered without a map for each row."""
    v, typ, ts, data, old, is_update = _cart_versions(li)
    def fields(pairs):  # an entry of a map is rendered where it is null, too
        return F.to_json(F.struct(*[c.alias(k) for k, c in pairs]), {"ignoreNullFields": "false"})
    def some(k, c):
        return F.coalesce(F.concat(F.lit(f',"{k}":'), c), F.lit(""))
    head = F.concat(F.lit(f'{{"database":"{DATABASE}","table":"cart_info","type":"'), typ, F.lit('"'))
    return v.select(F.concat(head, some("ts", _text(ts)), some("data", fields(data)),
                             some("old", F.when(is_update, fields(old))), F.lit("}")).alias("value"))


def dimension_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer / part / supplier / nation rows as change records (ts in ms).

    Customers with a negative balance get a later partial update that only
    carries ``acctbal = '0.00'`` (exercises the column-level upsert).
    """
    c = table(spark, sf_dir, "customer")
    cust = _env(c, "customer", "insert", F.lit(1000).cast("bigint"), _m(
        ("id", _text(F.col("c_custkey"))), ("name", F.col("c_name")),
        ("nation_id", _text(F.col("c_nationkey"))), ("acctbal", _text(_dec2(F.col("c_acctbal")))),
        ("segment", F.col("c_mktsegment"))))
    neg = c.filter(F.col("c_acctbal") < 0)
    cust_upd = _env(neg, "customer", "update", F.lit(2000).cast("bigint"), _m(
        ("id", _text(F.col("c_custkey"))), ("acctbal", F.lit("0.00"))),
        _m(("acctbal", _text(_dec2(F.col("c_acctbal"))))))
    p = table(spark, sf_dir, "part")
    part = _env(p, "part", "insert", F.lit(1000).cast("bigint"), _m(
        ("id", _text(F.col("p_partkey"))), ("name", F.col("p_name")), ("brand", F.col("p_brand")),
        ("type", F.col("p_type")), ("size", _text(F.col("p_size"))),
        ("price", _text(_dec2(F.col("p_retailprice"))))))
    s = table(spark, sf_dir, "supplier")
    supp = _env(s, "supplier", "insert", F.lit(1000).cast("bigint"), _m(
        ("id", _text(F.col("s_suppkey"))), ("name", F.col("s_name")),
        ("nation_id", _text(F.col("s_nationkey"))), ("acctbal", _text(_dec2(F.col("s_acctbal"))))))
    n = table(spark, sf_dir, "nation")
    nat = _env(n, "nation", "insert", F.lit(1000).cast("bigint"), _m(
        ("id", _text(F.col("n_nationkey"))), ("name", F.col("n_name")),
        ("region_id", _text(F.col("n_regionkey")))))
    r = table(spark, sf_dir, "region")
    reg = _env(r, "region", "insert", F.lit(1000).cast("bigint"), _m(
        ("id", _text(F.col("r_regionkey"))), ("name", F.col("r_name"))))
    return cust.unionByName(cust_upd).unionByName(part).unionByName(supp) \
        .unionByName(nat).unionByName(reg)


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]

def activity_shift() -> F.Column:
    """Test mapping: activity rows come up to three months before or after their detail."""
    return (F.col("l_partkey") % 7 - 3) * (30 * 86_400)


def coupon_shift() -> F.Column:
    """Test mapping: coupon rows come up to three months before or after their detail."""
    return (F.col("l_suppkey") % 5 - 2) * (45 * 86_400)


TRADE_TABLES = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon",
                "payment_info", "cart_info")


def topic_db(spark: SparkSession, sf_dir: str, tables=TRADE_TABLES, shifted: bool = False) -> DataFrame:
    """The change-log envelope for the requested source tables (parsed form); ``shifted`` moves activity and coupon rows in time."""
    li = table(spark, sf_dir, "lineitem", LINEITEM_COLS)
    orders = table(spark, sf_dir, "orders", ORDERS_COLS)
    build = {"order_detail": lambda: order_detail_changes(li),
             "order_detail_activity": lambda: activity_changes(li, activity_shift() if shifted else None),
             "order_detail_coupon": lambda: coupon_changes(li, coupon_shift() if shifted else None),
             "base_dic": lambda: dictionary_changes(spark),
             "order_info": lambda: order_info_changes(orders),
             "payment_info": lambda: payment_changes(orders),
             "cart_info": lambda: cart_changes(li)}
    parts = [build[t]() for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def topic_db_lines(spark: SparkSession, sf_dir: str, tables=TRADE_TABLES, shifted: bool = False) -> DataFrame:
    """The change-log as JSON lines, with bad and control lines mixed in: for
    each F order a cut-off line, for each P order a bootstrap start line."""
    others = tuple(t for t in tables if t != "cart_info")
    parts = []
    if others:
        env = topic_db(spark, sf_dir, others, shifted)
        parts.append(env.select(F.to_json(F.struct("database", "table", "type", "ts", "data", "old")).alias("value")))
    if "cart_info" in tables:
        parts.append(cart_lines(table(spark, sf_dir, "lineitem", LINEITEM_COLS)))
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"]).filter(F.col("o_orderstatus").isin("F", "P"))
    control = F.format_string('{"database":"%s","table":"order_info","type":"bootstrap-start","ts":%d,"data":{}}',
                              F.lit(DATABASE), F.col("o_orderkey"))
    cut = F.format_string('{"table":"order_info","type":"insert","data":{"id":"%d"', F.col("o_orderkey"))
    parts.append(o.select(F.when(F.col("o_orderstatus") == "P", control).otherwise(cut).alias("value")))
    return reduce(DataFrame.unionByName, parts)


def config_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension config feed as JSON lines (``seq`` = arrival), for every
    name in ``region``: created without columns, then fixed in the same
    millisecond, and for every second one deleted again."""
    r = table(spark, sf_dir, "region")
    row = lambda cols: F.struct(F.lower(F.col("r_name")).alias("source_table"),
                                F.concat(F.lit("dim_"), F.lower(F.col("r_name"))).alias("sink_table"),
                                cols.alias("sink_columns"), F.lit("id").alias("sink_pk"))
    some = lambda n, op, cols, side: r.filter((F.col("r_regionkey") % 2 == 0) | F.lit(op != "d")).select(
        (F.col("r_regionkey") * 10 + n).cast("bigint").alias("seq"),
        F.to_json(F.struct(row(cols).alias(side), F.lit(op).alias("op"), F.lit(1000).alias("ts_ms"))).alias("value"))
    return (some(0, "c", F.lit(None).cast("string"), "after").unionByName(some(1, "u", F.lit("id,name"), "after"))
            .unionByName(some(2, "d", F.lit("id,name"), "before")))


def placed_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer, part and supplier rows as change records in order of arrival: ``at`` is their key."""
    keys = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}
    names = {"customer": "c_name", "part": "p_name", "supplier": "s_name"}
    out = None
    for t, k in keys.items():
        rows = table(spark, sf_dir, t, [k, names[t]])
        env = _env(rows, t, "insert", F.col(k), _m(("id", _text(F.col(k))), ("name", F.col(names[t])), ("extra", F.lit("x")))) \
            .withColumn("at", F.col("ts"))
        out = env if out is None else out.unionByName(env)
    return out


# Config changes in order of arrival (op, place, source table, sink table, columns); place 20 first lacks its columns.
PLACED_CONFIG = [
    ("c", 20, "customer", "dim_customer", None), ("u", 21, "customer", "dim_customer", "id,name"), ("u", 60, "customer", "dim_buyer", "id,extra"),
    ("d", 90, "customer", "dim_buyer", "id,extra"), ("c", 110, "customer", "dim_customer", "id,name"), ("c", 5, "part", "dim_part", "id,name,extra"),
]


def placed_config(spark: SparkSession) -> DataFrame:
    """The config feed with places (``at``)."""
    row = "struct<source_table:string,sink_table:string,sink_columns:string,sink_pk:string,sink_extend:string>"
    rows = [(None if op != "d" else (src, sink, cols, "id", None), None if op == "d" else (src, sink, cols, "id", None), op, at, at)
            for op, at, src, sink, cols in PLACED_CONFIG]
    return spark.createDataFrame(rows, f"before {row}, after {row}, op string, ts_ms bigint, at bigint")


# ------------------------------------------------------- small code tables
# The dictionary (base_dic) -- source types and payment types.
BASE_DIC_ROWS = [
    ("A", "source A", "24", "2022-01-01 00:00:00", None),
    ("N", "source N", "24", "2022-01-01 00:00:00", None),
    ("1101", "payment type 1", "11", "2022-01-01 00:00:00", None),
    ("1102", "payment type 2", "11", "2022-01-01 00:00:00", None),
    ("1103", "payment type 3", "11", "2022-01-01 00:00:00", None),
]
BASE_DIC_SCHEMA = ("dic_code string, dic_name string, parent_code string, "
                   "create_time string, operate_time string")


def base_dic(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BASE_DIC_ROWS, BASE_DIC_SCHEMA)


# Changes of the dictionary while the topic runs (type, code, name, second).
DIC_CHANGES = [
    ("insert", "A", "source A", 0), ("update", "A", "source A renamed", 883_612_800),      # 1998-01-01
    ("insert", "N", "source N", 852_076_800),                                              # 1997-01-01
    ("insert", "R", "source R", 0), ("delete", "R", "source R", 915_148_800),              # 1999-01-01
    ("insert", "R", "source R again", 946_684_800),                                        # 2000-01-01
]


def dictionary_changes(spark: SparkSession) -> DataFrame:
    """The dictionary's changes as change records."""
    rows = spark.createDataFrame(DIC_CHANGES, "type string, code string, name string, ts bigint")
    return _env(rows, "base_dic", F.col("type"), F.col("ts"), _m(("dic_code", F.col("code")), ("dic_name", F.col("name"))))


# The dimension config feed (table_process change records).
CONFIG_FEED = [
    # op, ts_ms, source_table, sink_table, sink_columns, sink_pk, sink_extend
    ("r", 0, "customer", "dim_customer", "id,name,nation_id,acctbal", "id", None),
    ("r", 0, "part", "dim_part", "id,name,brand,size", None, None),
    ("r", 0, "supplier", "dim_supplier", "id,name,nation_id,acctbal", "id", None),
    ("r", 0, "nation", "dim_nation", "id,name", "id", None),
    ("r", 0, "region", "dim_region", None, "id", None),
    ("d", 10, "nation", "dim_nation", "id,name", "id", None),
]


def config_feed(spark: SparkSession) -> DataFrame:
    rows = []
    for op, ts, src, sink, cols, pk, ext in CONFIG_FEED:
        row = (src, sink, cols, pk, ext)
        rows.append((row if op == "d" else None, None if op == "d" else row, op, ts))
    schema = ("before struct<source_table:string,sink_table:string,sink_columns:string,"
              "sink_pk:string,sink_extend:string>, after struct<source_table:string,"
              "sink_table:string,sink_columns:string,sink_pk:string,sink_extend:string>, "
              "op string, ts_ms bigint")
    return spark.createDataFrame(rows, schema)
