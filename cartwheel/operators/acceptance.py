"""Which orders a shop can take, in the order they came: each is taken or refused as a whole.

An order reserves stock of all its products or of none, so a refused order leaves its demand to later ones.  Whether an
order is taken depends on every earlier one that shares a product with it, directly or through others.  It is found in
rounds over all orders at once.  For each line two running totals of its product are known: what earlier orders take for
certain, and what they take at most (undecided ones included).  An order with a line that does not fit into what is left
by the first is refused for certain; one whose lines all fit into what is left by the second is taken for certain.  The
earliest undecided order is always one of the two, and in practice most are decided in the first rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.skew import running_totals, time_chunk
from cartwheel.operators.orders import order_demand
from cartwheel.session import dropped, written

UNKNOWN_PRODUCT, NO_STOCK = "One or more products not found.", "Insufficient stock."
#: tables of verdicts before they become one
PARTS_KEPT = 32


def _with_totals(rows: DataFrame, at_most: bool = False) -> DataFrame:
    """Units of the product taken for certain before this order and, if wanted, taken at most up to and including it.

    A product is cut by time and id range, never gathered.
    """
    own = F.when(F.col("Taken"), F.col("Quantity")).otherwise(F.lit(0))
    values = {"_upto": own} | ({"AtMost": F.when(F.coalesce("Taken", F.lit(True)), F.col("Quantity")).otherwise(0)}
                               if at_most else {})
    totals = running_totals(rows, ["ProductId"], ["OrderDate", "OrderId"], time_chunk("OrderDate", "OrderId"), values)
    return totals.withColumn("TakenBefore", F.col("_upto") - own).drop("_upto")


def accept_orders(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Per requested order: Accepted, the reason of a refusal, and the first product (by id) that was short.

    Orders come by (OrderDate, OrderId); lines of an order without a date are left out, a null quantity is none.  Only
    products asked for beyond their stock take part in the rounds.  The lines are written once.  A round writes the verdicts
    it found and the lines that still matter: those of undecided orders, and the units taken of products that an undecided
    order asks for.  It then removes the lines of the round before, so the disk holds two rounds at most.
    """
    spark = lines.sparkSession
    demand = order_demand(lines, products).join(orders.select("OrderId", "OrderDate"), "OrderId")
    demand = written(spark, demand.where("OrderDate is not null").withColumn(
        "Quantity", F.coalesce("Quantity", F.lit(0)).cast("long")), "order-demand")
    heads = written(spark, demand.groupBy("OrderId").agg(F.bool_and("ProductExists").alias("Known")), "order-heads")
    known = demand.join(heads.where("Known"), "OrderId", "left_semi").drop("ProductExists")
    stock = products.select("ProductId", F.coalesce("StockQuantity", F.lit(0)).cast("long").alias("Stock"))
    wanted = known.groupBy("ProductId").agg(F.sum("Quantity").alias("_wanted"))
    short = wanted.join(stock, "ProductId").where("_wanted > Stock").select("ProductId", "Stock")
    every = written(spark, known.join(short, "ProductId"), "order-lines")
    dropped(spark, demand)
    rows = every.withColumn("Taken", F.lit(None).cast("boolean"))
    verdicts: list[DataFrame] = []
    while not rows.where("Taken is null").isEmpty():
        decided = (_with_totals(rows, at_most=True).where("Taken is null").groupBy("OrderId").agg(
            F.bool_or(F.col("TakenBefore") + F.col("Quantity") > F.col("Stock")).alias("_no"),
            F.bool_and(F.col("AtMost") <= F.col("Stock")).alias("_yes"))
            .select("OrderId", F.when(F.col("_no"), False).when(F.col("_yes"), True).alias("_now")).where("_now is not null"))
        if len(verdicts) == PARTS_KEPT:  # a long chain of rounds: one table for the verdicts so far
            parts, verdicts = verdicts, [written(spark, _all(verdicts), "order-verdicts")]
            dropped(spark, *parts)
        verdicts.append(written(spark, decided, "order-verdicts"))
        told = (rows.join(verdicts[-1], "OrderId", "left").withColumn("Taken", F.coalesce("Taken", "_now")).drop("_now")
                .where(F.coalesce("Taken", F.lit(True))))
        asked = rows.where("Taken is null").join(verdicts[-1], "OrderId", "left_anti").select("ProductId").distinct()
        done, rows = rows, written(spark, told.join(asked, "ProductId", "left_semi"), "order-open")
        dropped(spark, done)
    dropped(spark, rows)
    if not verdicts:
        return _told(heads, every.limit(0).select("OrderId", F.col("ProductId").alias("ShortProductId")))
    judged = every.join(_all(verdicts).select("OrderId", F.col("_now").alias("Taken")), "OrderId")
    refused = (_with_totals(judged).where(~F.col("Taken")).groupBy("OrderId").agg(F.min(F.when(
        F.col("TakenBefore") + F.col("Quantity") > F.col("Stock"), F.col("ProductId"))).alias("ShortProductId")))
    return _told(heads, refused)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _told(heads: DataFrame, refused: DataFrame) -> DataFrame:
    told = heads.join(refused.withColumn("_short", F.lit(True)), "OrderId", "left")
    reason = F.when(~F.col("Known"), F.lit(UNKNOWN_PRODUCT)).when(F.col("_short"), F.lit(NO_STOCK))
    return told.select("OrderId", reason.isNull().alias("Accepted"), reason.alias("Reason"), "ShortProductId")
