"""Warehouse inputs derived from star-schema and event tables.

Logs come from ``events``, orders, details and payments from ``orders`` and ``lineitem``,
dimensions from ``customer``, ``nation`` and ``part``, change and rule feeds from several of
them.  All derivations are arithmetic on existing columns, so that other engines can repeat
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.schemas import TABLE_PROCESS
from tidemart.session import SMALL, stored
from tidemart.sources.tables import Tables

# Routing config of the derived change log.
ROUTES = (
    ("order_info", "insert", "kafka", "dwd_order_info",
     "id,province_id,order_status,user_id,total_amount,create_time", "id", None),
    ("order_info", "update", "kafka", "dwd_order_info_update", "id,order_status", "id", None),
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,birthday,gender", "id",
     " salt_buckets = 3"),
    ("user_info", "update", "hbase", "dim_user_info", "id,name,birthday,gender", "id", None),
    ("user_info", "delete", "hbase", "dim_user_info", "id,name", "id", None),
    ("base_province", "insert", "hbase", "dim_base_province", "id,name,area_code", None, None),
    ("sku_info", "insert", "hbase", "dim_sku_info", "id,sku_name,price,spu_id,tm_id", "id", None),
    ("supplier_info", "insert", "clickhouse", "supplier_info", "id,name", "id", None),
)

def money(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def clock(ms: Column) -> Column:
    """Whole seconds as ``yyyy-MM-dd HH:mm:ss``."""
    return F.timestamp_seconds(F.call_function("div", ms, F.lit(1000))).cast("string")


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def epoch(moment: str) -> Column:
    return F.unix_millis(F.col(moment).cast("timestamp"))


class Inputs:
    def __init__(self, tables: Tables):
        self.tables = tables
        self.spark = tables.spark

    # ---- logs -------------------------------------------------------------------------

    def _skus(self) -> int:
        return (self.tables("part").agg(F.max("p_partkey")).first()[0] or 0) + 1

    def visit_log(self) -> DataFrame:
        """The log without what searches looked for, for jobs that do not look at items."""
        return self._log(self.tables("events").withColumns({
            "_skus": F.lit(self._skus()), "_sku": F.lit(None).cast("bigint"),
            "p_name": F.lit(None).cast("string")}))

    def page_log(self) -> DataFrame:
        """Typed user log; ``seq`` is the order of arrival."""
        events = self.tables("events")
        parts = self.tables("part")
        names = parts.select("p_partkey", "p_name")
        # Every part may be shown.
        skus = F.lit(self._skus())
        return self._log(events.withColumns({"_skus": skus, "_sku": F.col("event_id") * 7919 % skus}).join(
            names, F.col("_sku") == F.col("p_partkey"), "left"))

    @staticmethod
    def _log(joined: DataFrame) -> DataFrame:
        e, kind = F.col("event_id"), F.col("event_type")
        page_id = (F.when(kind == "view", "good_detail").when(kind == "error", "search")
                    .when(kind == "signup", "login").when(kind == "purchase", "cart")
                    .otherwise("home"))
        last_page = (F.when(~kind.isin("signup", "error"), "home").when(e % 3 == 0, ""))
        shown = F.when(e % 4 > 0, F.sequence(F.lit(0).cast("bigint"), e % 4 - 1)).otherwise(
            F.array().cast("array<bigint>"))
        displays = F.transform(shown, lambda i: F.struct(
            text((e * 7 + i) % F.col("_skus")).alias("item"),
            F.when((e + i) % 3 == 0, "promotion").otherwise("sku_id").alias("item_type")))
        return joined.select(
            F.struct(
                F.concat(F.lit("mid_"), text("user_id")).alias("mid"),
                F.concat(F.lit("v"), text(F.col("user_id") % 3)).alias("vc"),
                F.concat(F.lit("c"), text(e % 4)).alias("ch"),
                F.concat(F.lit("a"), text(F.col("user_id") % 5)).alias("ar"),
                F.when(e % 2 == 0, "1").otherwise("0").alias("is_new")).alias("common"),
            F.struct(
                page_id.alias("page_id"), last_page.alias("last_page_id"),
                F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
                F.when(kind == "view", text("_sku")).when(kind == "error", F.col("p_name"))
                 .alias("item"),
                F.when(kind == "view", "sku_id").when(kind == "error", "keyword")
                 .alias("item_type")).alias("page"),
            displays.alias("displays"),
            F.when((kind == "signup") & (e % 3 == 0), '{"entry":"icon"}').alias("start"),
            epoch("ts").alias("ts"), e.alias("seq"))

    def raw_log(self) -> DataFrame:
        """The log as text.  Beside their own record, clicks of odd users send one that is cut
        off, and signups of odd users one that lacks the device."""
        log = self.page_log().withColumn("_odd", F.right("common.mid", F.lit(1)).cast("int") % 2 == 1)
        whole = F.to_json(F.struct("common", "page", "displays", "start", "ts"))
        nameless = F.to_json(F.struct(
            F.col("common").withField("mid", F.lit(None).cast("string")).alias("common"),
            "page", "displays", "start", "ts"))
        cut = F.concat(F.lit('{"common":{"mid":"'), F.col("common.mid"), F.lit('"},"ts":'), text("ts"))
        dirty = (F.when(F.col("_odd") & (F.col("page.page_id") == "home"), cut)
                  .when(F.col("_odd") & (F.col("page.page_id") == "login"), nameless))
        return log.select(F.explode(F.array_compact(F.array(whole, dirty))).alias("value"), "seq")

    # ---- facts ------------------------------------------------------------------------

    @staticmethod
    def _order_ms() -> Column:
        return epoch("o_orderdate") + (F.col("o_orderkey") % 86_400) * 1000

    def orders(self) -> DataFrame:
        customers = self.tables("customer").select("c_custkey", "c_nationkey")
        o = self.tables("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        key, status, ms = F.col("o_orderkey"), F.col("o_orderstatus"), self._order_ms()
        total = money("o_totalprice")
        activity, coupon = money(key % 10), money(key % 5)
        return o.select(
            key.alias("id"), F.col("c_nationkey").cast("bigint").alias("province_id"),
            F.when(status == "O", "1001").when(status == "P", "1002").otherwise("1004")
             .alias("order_status"),
            F.col("o_custkey").alias("user_id"), total.alias("total_amount"),
            activity.alias("activity_reduce_amount"), coupon.alias("coupon_reduce_amount"),
            money(total + activity + coupon).alias("original_total_amount"),
            money(key % 20).alias("feight_fee"), clock(ms + 900_000).alias("expire_time"),
            clock(ms).alias("create_time"),
            F.when(status != "O", clock(ms + 60_000)).alias("operate_time"))

    def _lines(self) -> DataFrame:
        """Order lines with the time they were made, up to 7 s around their order's."""
        orders = self.tables("orders").select("o_orderkey", self._order_ms().alias("_order_ms"))
        lines = self.tables("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        shift = (F.col("l_partkey") * 7 + F.col("l_suppkey") * 3 + F.col("l_linenumber")) % 15 - 7
        return lines.withColumn("create_time", clock(F.col("_order_ms") + shift * 1000))

    def share_lines(self) -> None:
        """Lines for a job that joins them several times: all its steps ask for the same columns, which
        the generator keeps together, so that Spark shuffles the lines once and reads that again."""
        lines = self._lines().select("l_orderkey", F.inline(F.array(F.struct(
            "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "create_time"))))
        self._lines = lambda: lines

    def keep_lines(self) -> None:
        """Write the lines with their times once, for jobs that look at them several times."""
        lines = stored(self._lines().select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "create_time"),
            "lines", **SMALL)
        self._lines = lambda: lines

    def details(self) -> DataFrame:
        number = F.col("l_linenumber")
        return self._lines().select(
            (F.col("l_orderkey") * 100 + number).alias("id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"), money("l_extendedprice").alias("order_price"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.concat(F.lit("line_"), text("l_partkey")).alias("sku_name"), "create_time",
            money("l_extendedprice").alias("split_total_amount"),
            money(number).alias("split_activity_amount"),
            F.when(number % 2 == 0, money(number)).alias("split_coupon_amount"))

    def payments(self) -> DataFrame:
        """Payments of the orders that are no longer open, from 100 s before to 1,100 s after."""
        key, ms = F.col("o_orderkey"), self._order_ms()
        paid = ms + (key % 1201 - 100) * 1000
        return self.tables("orders").filter(F.col("o_orderstatus") != "O").select(
            (key + 1_000_000).alias("id"), key.alias("order_id"), F.col("o_custkey").alias("user_id"),
            money("o_totalprice").alias("total_amount"),
            F.concat(F.lit("order "), text(key)).alias("subject"),
            F.when(key % 2 == 0, "1101").otherwise("1102").alias("payment_type"),
            clock(paid).alias("create_time"), clock(paid + 5_000).alias("callback_time"))

    def favors(self) -> DataFrame:
        return self._lines().filter("l_linenumber = 1").select(
            F.col("l_partkey").alias("sku_id"), "create_time")

    def carts(self) -> DataFrame:
        return self._lines().filter("l_linenumber = 2").select(
            F.col("l_partkey").alias("sku_id"), "create_time")

    def refunds(self) -> DataFrame:
        return self._lines().filter("l_returnflag = 'R'").select(
            F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
            money("l_extendedprice").alias("refund_amount"), "create_time")

    def comments(self) -> DataFrame:
        return self._lines().filter("l_returnflag = 'A'").select(
            F.col("l_partkey").alias("sku_id"),
            text(1201 + F.col("l_linenumber") % 4).alias("appraise"), "create_time")

    def line_marks(self) -> DataFrame:
        """The favors, carts, refunds and comments above, as one row per order line."""
        return self._lines().select(
            F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"), "create_time",
            (F.col("l_linenumber") == 1).alias("favor"), (F.col("l_linenumber") == 2).alias("cart"),
            F.when(F.col("l_returnflag") == "R", money("l_extendedprice")).alias("refund_amount"),
            F.when(F.col("l_returnflag") == "A", text(1201 + F.col("l_linenumber") % 4)).alias("appraise"))

    # ---- dimensions -------------------------------------------------------------------

    @staticmethod
    def _birthday() -> Column:
        return text(F.date_add(F.lit("1960-01-01").cast("date"),
                               (F.col("c_custkey") * 37 % 18_000).cast("int")))

    @staticmethod
    def _gender() -> Column:
        return F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M")

    def users(self) -> DataFrame:
        """Customers in credit; orders of the others find no user."""
        return self.tables("customer").filter("c_acctbal >= 0").select(
            text("c_custkey").alias("id"), self._birthday().alias("birthday"),
            self._gender().alias("gender"))

    def provinces(self) -> DataFrame:
        key = text("n_nationkey")
        return self.tables("nation").select(
            key.alias("id"), F.col("n_name").alias("name"), text("n_regionkey").alias("area_code"),
            F.concat(F.lit("ISO-"), key).alias("iso_code"),
            F.concat(F.lit("P-"), key).alias("iso_3166_2"))

    def skus(self) -> DataFrame:
        return self.tables("part").select(
            text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            text(money("p_retailprice")).alias("price"), text(F.col("p_partkey") % 50).alias("spu_id"),
            F.regexp_extract("p_brand", r"(\d+)", 1).alias("tm_id"),
            text("p_size").alias("category3_id"))

    def spus(self) -> DataFrame:
        return (self.tables("part").select(text(F.col("p_partkey") % 50).alias("id")).distinct()
                    .withColumn("spu_name", F.concat(F.lit("spu_"), F.col("id"))))

    def trademarks(self) -> DataFrame:
        return self.tables("part").select(
            F.regexp_extract("p_brand", r"(\d+)", 1).alias("id"),
            F.col("p_brand").alias("tm_name")).distinct()

    def categories(self) -> DataFrame:
        return (self.tables("part").select(text("p_size").alias("id")).distinct()
                    .withColumn("name", F.concat(F.lit("category_"), F.col("id"))))

    # ---- change feeds -----------------------------------------------------------------

    def routes(self) -> DataFrame:
        # As literals, so that Spark knows how small it is.
        rows = [F.struct(*[F.lit(value).cast("string").alias(name)
                           for name, value in zip(TABLE_PROCESS.fieldNames(), route)]) for route in ROUTES]
        return self.spark.range(1).select(F.inline(F.array(*rows)))

    def change_log(self) -> DataFrame:
        """Database changes as text.  ``seq`` orders the changes of one table."""
        def change(df: DataFrame, table: str, kind: str, payload: Column, seq: Column) -> DataFrame:
            head = F.lit(f'{{"database":"shop","table":"{table}","type":"{kind}"')
            body = F.concat(F.lit(',"data":'), payload)
            return df.select(F.concat(head, F.coalesce(body, F.lit("")), F.lit("}")).alias("value"),
                             seq.cast("bigint").alias("seq"))

        def row(**columns: Column) -> Column:
            return F.to_json(F.struct(*[text(c).alias(name) for name, c in columns.items()]))

        orders, key = self.orders(), F.col("id")
        customers, cust = self.tables("customer"), F.col("c_custkey")
        parts = [
            change(orders, "order_info", "insert", row(
                id=key, province_id=F.col("province_id"), user_id=F.col("user_id"),
                order_status=F.lit("1001"), total_amount=F.col("total_amount"),
                create_time=F.col("create_time"), note=F.lit("web")), key * 2),
            change(orders.filter("order_status = '1004'"), "order_info", "update",
                   row(id=key, order_status=F.col("order_status"),
                       operate_time=F.col("operate_time")), key * 2 + 1),
            change(customers, "user_info", "insert",
                   row(id=cust, name=F.col("c_name"), birthday=self._birthday(),
                       gender=self._gender(), segment=F.col("c_mktsegment")), cust * 10),
            change(customers.filter("c_mktsegment = 'BUILDING'"), "user_info", "update",
                   row(id=cust, gender=F.lit("X"), segment=F.col("c_mktsegment")), cust * 10 + 1),
            change(customers.filter("c_mktsegment = 'MACHINERY'"), "user_info", "delete",
                   row(id=cust, name=F.col("c_name")), cust * 10 + 2),
            change(customers.filter("c_mktsegment = 'MACHINERY' AND c_acctbal < 0"), "user_info",
                   "insert", row(id=cust, name=F.concat(F.lit("again "), F.col("c_name"))),
                   cust * 10 + 3),
            change(self.tables("nation"), "base_province", "bootstrap-insert",
                   row(id=F.col("n_nationkey"), name=F.col("n_name"),
                       area_code=F.col("n_regionkey")), F.col("n_nationkey")),
            change(self.skus(), "sku_info", "insert",
                   row(id=key, sku_name=F.col("sku_name"), price=F.col("price"),
                       spu_id=F.col("spu_id"), tm_id=F.col("tm_id"),
                       category3_id=F.col("category3_id")), key),
            change(self.tables("supplier"), "supplier_info", "insert",
                   F.when(F.col("s_acctbal") < 0, F.lit('""'))
                    .when(F.col("s_acctbal") < 2000, F.lit("{}"))
                    .when(F.col("s_nationkey") > 3,
                          row(id=F.col("s_suppkey"), name=F.col("s_name"))),
                   F.col("s_suppkey") * 2),
            change(self.tables("supplier"), "supplier_info", "update",
                   row(id=F.col("s_suppkey"), name=F.col("s_name")), F.col("s_suppkey") * 2 + 1),
            # Changes that cannot be used: without a key, with text for a payload, cut off.
            change(self.tables("supplier").filter("s_suppkey % 3 = 0"), "sku_info", "insert",
                   row(sku_name=F.col("s_name")), F.col("s_suppkey")),
            change(self.tables("supplier").filter("s_suppkey % 3 = 1"), "user_info", "insert",
                   F.lit('"nothing"'), F.col("s_suppkey")),
            self.tables("supplier").filter("s_suppkey % 3 = 2").select(
                F.concat(F.lit('{"database":"shop","table":"user_info","type":"insert","data":{"id":"'),
                         text("s_suppkey")).alias("value"), F.col("s_suppkey").cast("bigint").alias("seq")),
        ]
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)
        return union

    def customer_feed(self) -> DataFrame:
        """Change feed of the customers: topic, operation, the image before a delete, the
        image after everything else."""
        op = F.element_at(F.array(*[F.lit(x) for x in ("READ", "CREATE", "UPDATE", "DELETE")]),
                          F.col("c_nationkey") % 4 + 1)
        after = F.to_json(F.struct(text("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                   F.col("c_mktsegment").alias("segment")))
        return self.tables("customer").select(
            F.lit("binlog.shop.user_info").alias("topic"), op.alias("op"),
            F.when(op == "DELETE", after).alias("before"),
            F.when(op != "DELETE", after).alias("after"), F.col("c_custkey").alias("seq"))

    def route_feed(self) -> DataFrame:
        """Change feed of a large routing config, several images per route."""
        size = F.col("p_size")
        source = F.concat(F.lit("t"), text(F.col("p_partkey") % 97))
        image = F.to_json(F.struct(
            source.alias("source_table"),
            F.element_at(F.array(*[F.lit(x) for x in ("insert", "update", "delete")]),
                         size % 3 + 1).alias("operate_type"),
            F.when(size % 2 == 0, "hbase").otherwise("kafka").alias("sink_type"),
            F.concat(F.lit("dim_"), source).alias("sink_table"),
            F.concat(F.lit("id,name,c"), text("p_size")).alias("sink_columns"),
            F.when(size % 5 != 0, F.when(size % 10 == 1, "name").otherwise("id")).alias("sink_pk"),
            F.when(size % 7 == 0, " salt_buckets = 4").alias("sink_extend")))
        return self.tables("part").select(
            F.lit("binlog.shop.table_process").alias("topic"),
            F.when(size % 11 == 0, "DELETE").when(size % 4 == 0, "UPDATE").otherwise("CREATE")
             .alias("op"),
            F.when(size % 11 == 0, image).alias("before"),
            F.when(size % 11 != 0, image).alias("after"), F.col("p_partkey").alias("seq"))

    def placed_changes(self) -> DataFrame:
        """Changes of the tables that ``route_feed`` routes, each with its place in that feed."""
        return self.tables("lineitem").select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
            F.concat(F.lit("t"), text(F.col("l_orderkey") % 97)).alias("table"),
            F.element_at(F.array(*[F.lit(x) for x in ("insert", "update", "delete")]),
                         (F.col("l_suppkey") % 3 + 1).cast("int")).alias("type"),
            F.col("l_partkey").alias("place"))

    def _customer_lives(self) -> DataFrame:
        """When each customer is created, updated, deleted and created again, as places of a feed.

        The feed's first third only creates.  Changes go on while the snapshot below is read.
        """
        third = (self.tables("customer").agg(F.max("c_custkey")).first()[0] or 0) + 1
        k, segment = F.col("c_custkey"), F.col("c_mktsegment")
        return self.tables("customer").select(
            text(k).alias("id"), F.col("c_name").alias("name"), self._gender().alias("gender"),
            F.lit(third).cast("bigint").alias("third"), k.alias("k"),
            F.when(segment == "HOUSEHOLD", third + k * 11 % third).otherwise(k).alias("made"),
            F.when(segment == "BUILDING", third + k * 31 % third).alias("changed"),
            F.when(segment == "MACHINERY", third + k * 17 % third).alias("gone"),
            F.when((segment == "MACHINERY") & (F.col("c_acctbal") < 0), 2 * third + k * 13 % third)
             .alias("back"))

    def customer_history(self) -> DataFrame:
        """Change feed of the customers from the first low mark of ``customer_chunks`` on."""
        def image(name: Column, gender: Column) -> Column:
            return F.to_json(F.struct("id", name.alias("name"), gender.alias("gender")))

        name, gender, none = F.col("name"), F.col("gender"), F.lit(None).cast("string")
        moments = [("made", "CREATE", none, image(name, gender)),
                   ("changed", "UPDATE", image(name, gender), image(name, F.lit("X"))),
                   ("gone", "DELETE", image(name, gender), none),
                   ("back", "CREATE", none, image(F.concat(F.lit("again "), name), gender))]
        rows = F.array(*[F.struct(F.lit(op).alias("op"), before.alias("before"), after.alias("after"),
                                  F.col(at).alias("seq")) for at, op, before, after in moments])
        return (self._customer_lives().select("third", "id", F.inline(rows)).filter("seq > third")
                .select(F.lit("binlog.shop.user_info").alias("topic"), "op", "before", "after", "seq", "id"))

    def customer_chunks(self) -> DataFrame:
        """A snapshot of the customers, read in eight chunks: a row shows some moment between the
        marks of its chunk, which are places of the feed."""
        lives = self._customer_lives()
        third, chunk = F.col("third"), F.col("k") % 8
        low = third + F.call_function("div", chunk * third, F.lit(8))
        read = lives.withColumns({"low": low, "high": low + F.call_function("div", third, F.lit(4))})
        read = read.withColumn("at", F.col("low") + F.col("k") * 29 % (F.col("high") - F.col("low") + 1))
        seen = lambda at: F.coalesce(F.col(at) <= F.col("at"), F.lit(False))
        there = read.filter(seen("made") & (~seen("gone") | seen("back")))
        return there.select(
            "id", F.when(seen("back"), F.concat(F.lit("again "), "name")).otherwise(F.col("name")).alias("name"),
            F.when(seen("changed"), "X").otherwise(F.col("gender")).alias("gender"), "low", "high")

    # ---- rules and transactions -------------------------------------------------------

    def transactions(self) -> DataFrame:
        return self.tables("orders").select(
            F.col("o_orderkey").alias("transactionId"), self._order_ms().alias("eventTime"),
            F.col("o_custkey").alias("payeeId"), (F.col("o_orderkey") % 100).alias("beneficiaryId"),
            money("o_totalprice").alias("paymentAmount"),
            F.when(F.col("o_orderkey") % 2 == 0, "CSH").otherwise("CRD").alias("paymentType"))

    def placed_transactions(self) -> DataFrame:
        """Transactions with their places in the feed of rules."""
        return self.transactions().withColumn("place", F.col("payeeId"))

    def transaction_feed(self) -> DataFrame:
        """Transactions as text: JSON, for low priority token lines.  Lines of unspecified
        priority are cut off, odd ones of medium priority name an unknown payment type."""
        o = self.tables("orders")
        key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
        kind = F.when(key % 2 == 0, "CSH").otherwise("CRD")
        amount = text(money("o_totalprice"))
        as_json = F.concat(
            F.lit('{"transactionId":'), text(key), F.lit(',"eventTime":'), text(self._order_ms()),
            F.lit(',"payeeId":'), text("o_custkey"), F.lit(',"beneficiaryId":'), text(key % 100),
            F.lit(',"paymentAmount":'), amount, F.lit(',"paymentType":"'),
            F.when((priority == "3-MEDIUM") & (key % 2 == 1), "XXX").otherwise(kind), F.lit('"}'))
        as_tokens = F.concat_ws(",", text(key), clock(self._order_ms()), text("o_custkey"),
                                text(key % 100), kind, amount, F.lit("1"))
        return o.select(
            F.when(priority == "5-LOW", as_tokens)
             .when(priority == "4-NOT SPECIFIED", F.substring(as_json, 1, 40))
             .otherwise(as_json).alias("value"), key.alias("seq"))

    def rule_feed(self) -> DataFrame:
        """Rule lines of many kinds, several per rule, well-formed and not."""
        key, size = F.col("p_partkey"), F.col("p_size")
        rule_id, variant = text(key % 19 + 1), size % 8
        limit, minutes = text(size * 9000), text((size % 9 - 1) * 720)

        def plain(state: str, aggregator: str | Column, operator: str) -> Column:
            keys = F.when(key % 4 == 1, F.lit("")).otherwise("payeeId&beneficiaryId")
            aggregator = F.lit(aggregator) if isinstance(aggregator, str) else aggregator
            return F.concat(rule_id, F.lit(f",({state}),("), keys, F.lit("),(),(paymentAmount),("),
                            aggregator, F.lit(f"),({operator}),("), limit, F.lit("),("),
                            minutes, F.lit(")"))

        body = F.concat(F.lit('"ruleState":"ACTIVE","groupingKeyNames":["payeeId"],"unique":[],'
                              '"aggregateFieldName":"paymentAmount","aggregatorFunctionType":"MAX",'
                              '"limitOperatorType":"GREATER_EQUAL","limit":'), limit,
                        F.when(key % 5 == 0, F.lit("")).otherwise(
                            F.concat(F.lit(',"windowMinutes":'), minutes)))
        with_id = F.concat(F.lit('{"ruleId":'), rule_id, F.lit(","), body)
        control = F.when(key % 1499 == 700, "DELETE_RULES_ALL").otherwise("EXPORT_RULES_CURRENT")
        line = (F.when((variant == 0) & (key % 3 == 0), F.concat(
                    F.lit('{"ruleState":"CONTROL","controlType":"'), control, F.lit('"}')))
                 .when(key % 1499 == 700, F.lit(
                     '{"ruleState":"CONTROL","controlType":"DELETE_RULES_ALL"}'))
                 .when(variant == 0, F.concat(rule_id, F.lit(",(active),(payeeId)")))
                 .when(variant == 1, plain("active", "COUNT", ">"))
                 .when(variant == 2, F.concat(with_id, F.lit("}")))
                 .when(variant == 3, F.concat(F.lit("{"), body, F.lit("}")))
                 .when(variant == 4, F.concat(with_id, F.lit(',"owner":"x"}')))
                 .when(variant == 5, plain("pause", "avg", "<"))
                 .when(variant == 6, plain("active", "Min", "~"))
                 .otherwise(F.when(key % 2 == 0, plain("delete", "SUM", ">"))
                             .otherwise(plain("active", F.when(key % 3 == 0, "avg").otherwise("sum"), ">="))))
        return self.tables("part").select(line.alias("value"), key.alias("seq"))
