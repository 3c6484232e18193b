"""The given tables reshaped into the shop's own frames.

Each method is a lazy frame; unused columns (and the line numbering behind ``OrderItemId``) are pruned by Catalyst, so
a report that never looks at the id does not pay for it.  Where a job needs faults to find (bad feeds, broken facts,
forged callbacks), the fault is a rule on the key and applies to the whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cartwheel import schemas as S
from cartwheel.functions.scalars import date_key, ts
from cartwheel.operators import dims, etl

#: the sales star: years by which orders are moved on, account balances of the tiers, names of the payment methods
YEARS_ON = 24
GOLD_FROM, SILVER_FROM = 7500, 2500
METHODS = {1: "Cash", 2: "Card", 3: "EWallet"}
#: what is asked of the guard, by the kind of event
STATEMENTS = {
    "click": "DROP TABLE DailySalesByCategory",
    "error": "SELECT Category FROM DailySalesByCategory UNION ALL SELECT Secret FROM hidden",
    "view": "SELECT Category, SUM(TotalRevenue) FROM DailySalesByCategory GROUP BY Category",
    "signup": "SELECT MAX(Date) FROM DailySalesByCategory",
    "purchase": "SELECT * FROM DailySalesByCategory ORDER BY TotalRevenue DESC LIMIT 5",
}


def _when(*pairs, otherwise=None) -> Column:
    chain = F
    for test, value in pairs:
        chain = chain.when(test, value)
    return chain.otherwise(otherwise)


class Retail:
    """Lazy frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its files are listed once per object."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # ---------------------------------------------------------------- source system
    @cached_property
    def customers(self) -> DataFrame:
        named = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return named.select(
            F.col("c_custkey").alias("CustomerId"), F.col("c_name").alias("FullName"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit(""))), F.lit("@example.com")).alias("Email"),
            _when((F.col("c_custkey") % 17 == 0, F.lit(None).cast("string")),
                  otherwise=F.col("n_name")).alias("City"))

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("ProductId"), F.concat(F.lit("SKU-"), F.lpad(key.cast("string"), 6, "0")).alias("Sku"),
            F.col("p_name").alias("Name"), F.col("p_type").alias("Category"),
            _when((key % 13 == 0, F.lit(None).cast("string")), otherwise=F.col("p_brand")).alias("Brand"),
            F.col("p_retailprice").cast(S.MONEY).alias("Price"),
            ((key * 37 + 11) % 200).cast("int").alias("StockQuantity"))

    @cached_property
    def orders(self) -> DataFrame:
        """Payment follows the seed rules: cash is paid on delivery, online orders are paid once they move on."""
        key, src = F.col("o_orderkey"), F.col("o_orderstatus")
        base = self.table("orders").select(
            key.alias("OrderId"),
            F.concat(F.lit("ORD-"), F.lpad(key.cast("string"), 8, "0")).alias("OrderNumber"),
            F.col("o_custkey").alias("CustomerId"), F.col("o_orderdate").alias("OrderDate"),
            _when((key % 10 == 0, 5), (src == "F", 4), (src == "P", 3), (key % 2 == 0, 2), otherwise=1)
            .alias("Status"),
            _when((F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 2),
                  (F.col("o_orderpriority") == "3-MEDIUM", 3), otherwise=1).alias("PaymentMethod"),
            F.col("o_totalprice").cast(S.MONEY).alias("TotalAmount"))
        status, order = F.col("Status"), F.col("OrderId")
        paid = _when(((F.col("PaymentMethod") == 1) & (status == 4), 3), (F.col("PaymentMethod") == 1, 1),
                     (status == 5, 5), (status >= 2, 3), (order % 4 == 1, 2),
                     ((order % 4 == 3) & (order % 3 == 0), 4), otherwise=3)
        return base.withColumn("PaymentStatus", paid)

    @cached_property
    def order_items(self) -> DataFrame:
        """(order, line number) repeats in the test table, so copies of a line number get a rank of their own.

        The id rises with the order key and leaves room for a million copies of a line; the factor is a prime, so
        that rules on the id's remainders hit first copies too.
        """
        twin = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
            "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
        line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000003 + F.row_number().over(twin)
        return self.table("lineitem").select(
            line.alias("OrderItemId"), F.col("l_orderkey").alias("OrderId"), F.col("l_partkey").alias("ProductId"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100).cast(S.MONEY).alias("UnitPrice"),
            F.col("l_extendedprice").cast(S.MONEY).alias("LineTotal"))

    @cached_property
    def products_with_new(self) -> DataFrame:
        """The products and, for every tenth, a successor that nobody has ordered yet."""
        new = self.products.where(F.col("ProductId") % 10 == 0).withColumn("ProductId", -F.col("ProductId"))
        return self.products.unionByName(new.withColumn("Sku", F.concat("Sku", F.lit("-NEW"))))

    # ---------------------------------------------------------------- dimensions over two loads
    def customer_snapshot(self, load: int) -> DataFrame:
        if load == 1:
            return self.customers.where(F.col("CustomerId") % 50 != 0)
        moved = _when((F.col("CustomerId") % 8 == 0, F.lit("MOVED")), otherwise=F.col("City"))
        return self.customers.withColumn("City", moved)

    def product_snapshot(self, load: int) -> DataFrame:
        if load == 1:
            return self.products
        renamed = _when((F.col("ProductId") % 10 == 0, F.concat("Name", F.lit(" II"))), otherwise=F.col("Name"))
        return self.products.withColumn("Name", renamed)

    @cached_property
    def dim_customer_1(self) -> DataFrame:
        return dims.scd2_first_load(self.customer_snapshot(1), dims.CUSTOMER, S.FIRST_LOAD)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.scd2_apply(self.dim_customer_1, self.customer_snapshot(2), dims.CUSTOMER, S.SECOND_LOAD)

    @cached_property
    def dim_product_1(self) -> DataFrame:
        return dims.scd2_first_load(self.product_snapshot(1), dims.PRODUCT, S.FIRST_LOAD)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.scd2_apply(self.dim_product_1, self.product_snapshot(2), dims.PRODUCT, S.SECOND_LOAD)

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar from the first to the last order day."""
        return dims.date_dim_between(self.orders, "OrderDate")

    # ---------------------------------------------------------------- fact over two loads
    @cached_property
    def orders_in_loads(self) -> DataFrame:
        """Orders with the load (1 or 2) that brings them: the lower half of the ids comes first."""
        top = self.table("orders").agg(F.max("o_orderkey")).scalar()
        return self.orders.withColumn("Load", _when((F.col("OrderId") * 2 < top, 1), otherwise=2))

    def _keys(self, first: DataFrame, second: DataFrame, dim: dims.Scd2) -> DataFrame:
        """Natural to surrogate key as each load sees it, one row per (load, natural key)."""
        return (dims.current_keys(first, dim).withColumn("Load", F.lit(1))
                .unionByName(dims.current_keys(second, dim).withColumn("Load", F.lit(2))))

    @cached_property
    def resolved_lines(self) -> DataFrame:
        orders = self.orders_in_loads.select("OrderId", "CustomerId", "OrderDate", "Load")
        return etl.resolve_keys(self.order_items, orders,
                                self._keys(self.dim_customer_1, self.dim_customer, dims.CUSTOMER),
                                self._keys(self.dim_product_1, self.dim_product, dims.PRODUCT), also=["Load"])

    @cached_property
    def fact(self) -> DataFrame:
        return etl.silver_fact(self.resolved_lines, S.AS_OF)

    # ---------------------------------------------------------------- order events, payments, outbox
    @cached_property
    def order_events(self) -> DataFrame:
        """The path to the order's status, one step an hour; every fiftieth order ends on a forbidden step."""
        status = F.col("Status")
        path = _when((status == 5, F.array(F.lit(1), F.lit(5))), otherwise=F.sequence(F.lit(1), status))
        steps = self.orders.select("OrderId", "CustomerId", "OrderDate", F.posexplode(path).alias("Step", "Reached"),
                                   F.size(path).alias("Steps"))
        step = F.col("Step")
        last = step == F.col("Steps") - 1
        to = _when((last & (F.col("OrderId") % 50 == 0), _when((step == 0, 3), otherwise=F.col("Reached") - 1)),
                   otherwise=F.col("Reached"))
        return steps.select(
            (F.col("OrderId") * 10 + step).alias("EventId"), "OrderId",
            _when((step == 0, F.lit(None).cast("int")),
                  (F.col("Reached") == 5, 1), otherwise=F.col("Reached") - 1).alias("FromStatus"),
            to.cast("int").alias("ToStatus"), F.col("CustomerId").alias("ActorCustomerId"),
            (F.col("OrderDate") + F.make_dt_interval(hours=step)).alias("CreatedAt"))

    @cached_property
    def payments(self) -> DataFrame:
        return self.orders.where(F.col("PaymentMethod").isin(2, 3)).select(
            "OrderId", "OrderNumber", F.col("PaymentMethod").alias("Provider"), F.col("TotalAmount").alias("Amount"),
            F.concat(F.lit("REF"), F.col("OrderId").cast("string")).alias("Ref"), F.lit(2).alias("Status"),
            F.col("Status").alias("OrderStatus"))

    @cached_property
    def callbacks(self) -> DataFrame:
        """One gateway callback per line of an online order, with unknown refs, forged and failed ones mixed in."""
        line = F.col("OrderItemId")
        paid = self.order_items.join(self.payments.select("OrderId", "Provider", "Ref", F.col("Amount").alias("Due")),
                                     "OrderId")
        return paid.select(
            line.alias("Seq"), "Provider",
            _when((line % 11 == 0, F.concat(F.lit("LOST"), line.cast("string"))), otherwise=F.col("Ref")).alias("Ref"),
            _when((line % 6 == 0, F.col("Due") - 1), otherwise=F.col("Due")).cast(S.MONEY).alias("Amount"),
            (line % 7 != 0).alias("SignatureValid"),
            ((line % 7 != 0) & (line % 5 != 0)).alias("Success"))

    @cached_property
    def raw_callbacks(self) -> DataFrame:
        """The same callbacks as the gateways send them: a map of strings, not yet signed."""
        line = F.col("Seq")
        code = _when((line % 5 == 0, F.lit("24")), otherwise=F.lit("00"))
        info = F.concat(F.lit("Pay order "), F.col("Ref"))
        number = F.concat(F.lit("T"), line.cast("string"))
        cents = (F.col("Amount") * 100).cast("bigint").cast("string")
        whole = F.floor("Amount").cast("string")
        vnpay = F.create_map(*_pairs(
            vnp_TxnRef=F.col("Ref"), vnp_Amount=cents, vnp_ResponseCode=code, vnp_TransactionStatus=code,
            vnp_TransactionNo=number, vnp_OrderInfo=info,
            vnp_BankCode=_when((line % 3 == 0, F.lit("")), otherwise=F.lit("NCB")),
            vnp_SecureHashType=F.lit("HMACSHA512"), trace=number))
        momo = F.create_map(*_pairs(
            orderId=F.col("Ref"), amount=whole, resultCode=_when((line % 5 == 0, F.lit("1006")), otherwise=F.lit("0")),
            transId=number, orderInfo=info, partnerCode=F.lit("SHOP"), requestId=number,
            message=F.lit("Successful."), responseTime=line.cast("string"), orderType=F.lit("momo_wallet"),
            payType=F.lit("qr")))
        return self.callbacks.select("Seq", "Provider", _when((F.col("Provider") == 2, vnpay), otherwise=momo)
                                     .alias("Params"))

    @cached_property
    def outbox(self) -> DataFrame:
        key = F.col("OrderId")
        return self.orders.select(
            key.alias("OutboxId"),
            _when((key % 97 == 0, -key - 1), otherwise=key).alias("OrderId"),
            _when((key % 3 == 0, F.lit("OrderPlaced")), (key % 3 == 1, F.lit("PaymentSucceeded")),
                  (key % 2 == 0, F.lit("OrderStatusChanged")), otherwise=F.lit("Other")).alias("EventType"),
            F.to_json(F.struct(F.lit(1).alias("from"), F.col("Status").alias("to"))).alias("Payload"),
            _when((key % 4 == 0, F.col("OrderDate")), otherwise=F.lit(None).cast("timestamp_ntz"))
            .alias("ProcessedAt"),
            (key % 7).cast("int").alias("Attempts"), F.lit(None).cast("string").alias("LastError"))

    @cached_property
    def delivery_log(self) -> DataFrame:
        """What the mail server answered: how many tries fail before one goes through."""
        key = F.col("OrderId")
        return self.orders.select(key.alias("OutboxId"),
                                  _when((key % 9 == 0, 9), (key % 5 == 0, 2), otherwise=0).alias("Failures"))

    # ---------------------------------------------------------------- requests
    @cached_property
    def order_requests(self) -> DataFrame:
        """Wanted lines (order, product, quantity); some name a product that does not exist."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("OrderId"),
            _when(((F.col("l_orderkey") % 499 == 0) & (F.col("l_linenumber") == 1), -F.col("l_partkey") - 1),
                  otherwise=F.col("l_partkey")).alias("ProductId"),
            F.col("l_quantity").cast("int").alias("Quantity"))

    @cached_property
    def owner_requests(self) -> DataFrame:
        """A customer asks for something on an order: sometimes a foreign order, sometimes one that never was."""
        key = F.col("OrderId")
        return self.orders.select(
            key.alias("RequestId"), _when((key % 31 == 0, -key - 1), otherwise=key).alias("OrderId"),
            _when((key % 6 == 0, F.col("CustomerId") + 1), otherwise=F.col("CustomerId")).alias("RequesterId"))

    @cached_property
    def checkout_lines(self) -> DataFrame:
        """Order requests as the API receives them, with values outside the allowed ranges."""
        key, line = F.col("l_orderkey"), F.col("l_linenumber")
        return self.table("lineitem").select(
            key.alias("RequestId"),
            _when((line == 7, 0), otherwise=F.col("l_partkey") + 1).alias("ProductId"),
            _when(((key % 19 == 0) & (line == 1), 0), ((key % 23 == 0) & (line == 2), 10001),
                  otherwise=F.col("l_quantity")).cast("int").alias("Quantity"))

    @cached_property
    def checkout_headers(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.table("orders").select(
            key.alias("RequestId"), _when((key % 37 == 0, 0), otherwise=F.col("o_custkey") + 1).alias("CustomerId"),
            F.repeat(F.lit("n"), _when((key % 41 == 0, 201), otherwise=20)).alias("ShipFullName"),
            F.repeat(F.lit("0"), _when((key % 43 == 0, 41), otherwise=40)).alias("ShipPhone"),
            F.repeat(F.lit("a"), _when((key % 47 == 0, 501), otherwise=50)).alias("ShipAddress"),
            _when((key % 2 == 0, F.lit(None).cast("string")), (key % 53 == 0, F.repeat(F.lit("x"), F.lit(1001))),
                  otherwise=F.lit("note")).alias("Note"),
            _when((key % 59 == 0, 4), otherwise=1 + key % 3).cast("int").alias("PaymentMethod"))

    @cached_property
    def product_drafts(self) -> DataFrame:
        key = F.col("ProductId")
        return self.products.select(
            key, _when((key % 11 == 0, F.lit("  ")), (key % 29 == 0, F.repeat(F.lit("S"), F.lit(51))),
                       otherwise=F.col("Sku")).alias("Sku"),
            _when((key % 13 == 0, F.lit(None).cast("string")), otherwise=F.col("Name")).alias("Name"),
            _when((key % 17 == 0, F.repeat(F.lit("c"), F.lit(101))), otherwise=F.col("Category")).alias("Category"),
            "Brand", _when((key % 19 == 0, -F.col("Price")), otherwise=F.col("Price")).alias("Price"),
            _when((key % 23 == 0, -1), otherwise=F.col("StockQuantity")).alias("StockQuantity"))

    @cached_property
    def registrations(self) -> DataFrame:
        key = F.col("CustomerId")
        return self.customers.select(
            key, _when((key % 7 == 0, F.lit("")), otherwise=F.col("FullName")).alias("FullName"),
            _when((key % 5 == 0, F.lit("not-an-email")), (key % 11 == 0, F.lit("@no-local-part")),
                  (key % 13 == 0, F.lit("")), otherwise=F.concat(F.lit(" "), F.upper("Email"), F.lit(" ")))
            .alias("Email"),
            _when((key % 17 == 0, F.repeat(F.lit("9"), F.lit(31))), otherwise=F.lit("0901234567")).alias("Phone"),
            "City")

    @cached_property
    def addresses(self) -> DataFrame:
        """Two addresses a customer; both claim to be the default for every fifth."""
        key = F.col("CustomerId")
        twice = self.customers.select("CustomerId", "FullName", F.explode(F.array(F.lit(1), F.lit(2))).alias("Nr"))
        return twice.select(
            (key * 10 + F.col("Nr")).alias("AddressId"), "CustomerId", "FullName",
            F.concat(F.col("Nr").cast("string"), F.lit(" Main St")).alias("Address"),
            ((key % 5 == 0) | ((F.col("Nr") == 1) & (key % 3 != 0))).alias("IsDefault"))

    # ---------------------------------------------------------------- feeds (all cells are strings)
    @cached_property
    def customer_feed(self) -> DataFrame:
        key = F.col("CustomerId")
        twin = F.concat(F.lit("CUSTOMER"), F.lpad((key - key % 3).cast("string"), 9, "0"), F.lit("@EXAMPLE.COM"))
        return self.customers.select(
            (key + 2).alias("RowNo"),
            _when((key % 11 == 0, F.lit("   ")), otherwise=F.concat(F.lit(" "), "FullName")).alias("FullName"),
            _when((key % 13 == 0, F.lit("")), (key % 7 == 0, twin), otherwise=F.concat("Email", F.lit(" ")))
            .alias("Email"),
            _when((key % 4 == 0, F.lit("")), otherwise=F.lit("0901234567")).alias("Phone"),
            F.coalesce("City", F.lit(" ")).alias("City"))

    @cached_property
    def known_emails(self) -> DataFrame:
        key = F.col("CustomerId")
        return self.customers.select(
            key.alias("CustomerId"),
            _when((key % 9 == 0, F.col("Email")),
                  otherwise=F.concat(F.lit("old"), key.cast("string"), F.lit("@example.com"))).alias("Email"))

    @cached_property
    def product_feed(self) -> DataFrame:
        key = F.col("ProductId")
        twin = F.concat(F.lit("sku-"), F.lpad((key - key % 4).cast("string"), 6, "0"))
        return self.products.select(
            (key + 2).alias("RowNo"),
            _when((key % 31 == 0, F.lit("")), (key % 6 == 0, twin), otherwise=F.concat(F.lit(" "), "Sku")).alias("Sku"),
            _when((key % 37 == 0, F.lit(" ")), otherwise=F.col("Name")).alias("Name"),
            _when((key % 41 == 0, F.lit("")), otherwise=F.col("Category")).alias("Category"),
            F.coalesce("Brand", F.lit("")).alias("Brand"),
            _when((key % 43 == 0, F.lit("0")), (key % 47 == 0, F.lit("abc")), otherwise=F.col("Price").cast("string"))
            .alias("Price"),
            _when((key % 53 == 0, F.lit("many")), otherwise=F.col("StockQuantity").cast("string"))
            .alias("StockQuantity"))

    @cached_property
    def known_skus(self) -> DataFrame:
        key = F.col("ProductId")
        return self.products.select(
            _when((key % 15 == 0, F.col("Sku")), otherwise=F.concat(F.lit("OLD-"), key.cast("string"))).alias("Sku"))

    @cached_property
    def order_feed(self) -> DataFrame:
        line, order = F.col("OrderItemId"), F.col("OrderId")
        owner = self.orders.join(self.customers.select("CustomerId", "Email"), "CustomerId").select("OrderId", "Email")
        sku = F.concat(F.lit("sku-"), F.lpad(F.col("ProductId").cast("string"), 6, "0"))
        return self.order_items.join(owner, "OrderId").select(
            (line + 2).alias("RowNo"),
            _when((line % 41 == 0, F.lit(" ")), otherwise=F.concat(F.lit("R"), order.cast("string"))).alias("OrderRef"),
            _when((line % 43 == 0, F.lit("")), (order % 29 == 0, F.concat(F.lit("ghost"), "Email")),
                  (line % 3 == 0, F.upper("Email")), otherwise=F.col("Email")).alias("CustomerEmail"),
            _when((line % 47 == 0, F.lit("")), (line % 211 == 0, F.lit("sku-none")), (line % 2 == 0, sku),
                  otherwise=F.upper(sku)).alias("Sku"),
            _when((line % 53 == 0, F.lit("0")), (line % 59 == 0, F.lit("x")),
                  otherwise=F.col("Quantity").cast("string")).alias("Quantity"))

    # ---------------------------------------------------------------- logs that stand in for the ask log
    @cached_property
    def ask_log(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("AskId"), F.col("ts").alias("AskedAt"), F.col("user_id").alias("UserId"),
            F.col("props").alias("Question"),
            _when((kind.isin("click", "purchase"), F.lit("Answered")), (kind == "signup", F.lit("Refused")),
                  (kind == "error", F.lit("Error")), otherwise=F.lit("CacheHit")).alias("Status"),
            (F.col("value").cast(S.MONEY) * 100).cast("bigint").alias("LatencyMs"))

    @cached_property
    def questions(self) -> DataFrame:
        """Questions as typed: known ones with stray blanks and capitals, others that nobody prepared."""
        k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
        text = _when((k % 5 == 0, F.lit("  What WAS total   revenue in 2024? ")),
                     (k % 5 == 1, F.lit("REVENUE by payment method")), (k % 5 == 2, F.lit("top 3 stores\tby revenue")),
                     (k % 5 == 3, F.lit("Which shelf is empty?")), otherwise=F.col("props"))
        return self.table("events").select(F.col("event_id").alias("AskId"), text.alias("Question"),
                                           (F.col("value").cast(S.MONEY) * 100).cast("bigint").alias("LatencyMs"))

    @cached_property
    def statements(self) -> DataFrame:
        """Statements put to the guard, one for each kind of event."""
        return self.table("events").select(F.element_at(F.create_map(*[F.lit(x) for pair in STATEMENTS.items() for x in pair]),
                                                        F.col("event_type")).alias("Statement"))

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        """A sales star over the given tables: suppliers as stores, parts as products, line items as sales.

        Orders are moved on by YEARS_ON years, so that they reach into the calendar of the demo's questions.
        """
        from cartwheel.operators import adhoc
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("City"))
        money = lambda name: F.col(name).cast(S.MONEY)
        stores = (self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
                  .select(F.col("s_suppkey").alias("StoreKey"), F.col("s_name").alias("StoreName"), "City"))
        products = self.table("part").select(
            F.col("p_partkey").alias("ProductKey"), F.col("p_name").alias("ProductName"), F.col("p_brand").alias("Category"),
            F.col("p_size").alias("Size"), money("p_retailprice").alias("BasePrice"))
        balance = F.col("c_acctbal")
        tier = F.when(balance >= GOLD_FROM, F.lit("Gold")).when(balance >= SILVER_FROM, F.lit("Silver")).otherwise(F.lit("Bronze"))
        customers = (self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                     .select(F.col("c_custkey").alias("CustomerKey"), F.col("c_name").alias("CustomerName"),
                             tier.alias("MembershipTier"), "City"))
        method = F.element_at(F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair]), F.col("PaymentMethod"))
        heads = self.orders.select("OrderId", F.col("CustomerId").alias("CustomerKey"), date_key(F.add_months(
            F.col("OrderDate").cast("date"), 12 * YEARS_ON)).alias("DateKey"), method.alias("PaymentMethod"))
        gross, share = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("OrderId"), F.col("l_linenumber").alias("LineNumber"), F.col("l_suppkey").alias("StoreKey"),
            F.col("l_partkey").alias("ProductKey"), F.col("l_quantity").cast("int").alias("Quantity"), gross.alias("GrossAmount"),
            F.round(gross * share, 2).cast(S.MONEY).alias("DiscountAmount"))
        fact = lines.withColumn("LineTotal", (F.col("GrossAmount") - F.col("DiscountAmount")).cast(S.MONEY)).join(heads, "OrderId")
        return {"DimStore": stores, "DimProduct": products, "DimCustomer": customers,
                "DimDate": adhoc.star_dates(self.spark), "FactOrderItem": fact}

    # ---------------------------------------------------------------- broken star for the quality tests
    @cached_property
    def faulty_star(self) -> dict[str, DataFrame]:
        """Fact, dimensions and gold frames in which every quality test has something to find."""
        line = F.col("OrderItemId")
        copies = _when((line % 107 == 0, F.array(F.lit(1), F.lit(2))), otherwise=F.array(F.lit(1)))
        fact = self.fact.select(
            _when((line % 127 == 0, 19000101), otherwise=F.col("DateKey")).alias("DateKey"),
            _when((line % 109 == 0, F.lit(-1).cast("long")), otherwise=F.col("CustomerKey")).alias("CustomerKey"),
            _when((line % 113 == 0, F.lit(-1).cast("long")), otherwise=F.col("ProductKey")).alias("ProductKey"),
            "OrderId", "OrderItemId",
            _when((line % 101 == 0, 0), otherwise=F.col("Quantity")).alias("Quantity"), "UnitPrice",
            _when((line % 103 == 0, F.lit(-1)), otherwise=F.col("LineTotal")).cast(S.MONEY).alias("LineTotal"),
            (ts(S.AS_OF) - F.make_dt_interval(days=F.lit(3))).alias("EtlLoadedAt"),
            F.explode(copies).alias("Copy")).drop("Copy")
        twice = _when(((F.col("CustomerId") % 400 == 0) & F.col("IsCurrent"), F.array(F.lit(0), F.lit(500))),
                      otherwise=F.array(F.lit(0)))
        customer = (self.dim_customer.withColumn("Shift", F.explode(twice))
                    .withColumn("CustomerKey", F.col("CustomerKey") + F.col("Shift")).drop("Shift"))
        from cartwheel.operators import gold
        stock = self.products.withColumn("StockQuantity", _when((F.col("ProductId") % 500 == 0, -1),
                                                                otherwise=F.col("StockQuantity")))
        mix = gold.sales_by_payment_method(self.orders)
        mix = mix.withColumn("PaidRevenue", _when((F.col("PaymentMethod") == 3, F.col("TotalRevenue") + 1),
                                                  otherwise=F.col("PaidRevenue")))
        daily = gold.daily_sales_by_category(self.fact, self.dim_date, self.dim_product)
        return {"fact": fact, "dim_customer": customer, "dim_product": self.dim_product, "dim_date": self.dim_date,
                "gold_daily": daily.withColumn("RefreshedAt", ts(S.AS_OF) - F.make_dt_interval(hours=F.lit(3))),
                "gold_inventory": gold.product_inventory(self.fact, self.dim_product, stock), "gold_mix": mix}


def _pairs(**values: Column) -> list[Column]:
    return [item for name, value in values.items() for item in (F.lit(name), value)]
