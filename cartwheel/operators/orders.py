"""Pricing, stock and status jobs over orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel import schemas as S
from cartwheel.functions.scalars import label
from cartwheel.functions.skew import previous_value, running_total, time_chunk


# ---- fixed values: reasons against a request ------------------------------------------------------------------------
NOT_YOURS_TO_CANCEL = "You can only cancel your own orders."
ONLY_PENDING = "Only pending orders can be cancelled."
NOT_YOURS_TO_PAY = "You can only pay for your own orders."
PAID_ALREADY = "Order is already paid."
CASH_ORDER = "COD orders do not require online payment."


def order_demand(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Wanted quantity per order and product, and whether the product exists."""
    demand = lines.groupBy("OrderId", "ProductId").agg(F.sum("Quantity").alias("Quantity"))
    known = products.select("ProductId", F.lit(True).alias("_known"))
    return demand.join(known, "ProductId", "left").select("OrderId", "ProductId", "Quantity",
                                                          F.coalesce("_known", F.lit(False)).alias("ProductExists"))


def price_orders(lines: DataFrame, products: DataFrame, fee: str = S.SHIPPING_FEE,
                 free_from: str = S.FREE_SHIPPING_FROM, vat: str = S.VAT_RATE) -> DataFrame:
    """Totals of each requested order at catalogue prices; an order naming an unknown product is left out.

    Lines fold to (order, product) before the price is looked up.
    """
    demand = lines.groupBy("OrderId", "ProductId").agg(F.sum("Quantity").alias("Quantity"))
    priced = demand.join(products.select("ProductId", "Price"), "ProductId", "left")
    totals = (priced.groupBy("OrderId")
              .agg(F.sum((F.col("Price") * F.col("Quantity")).cast(S.MONEY)).alias("Subtotal"),
                   F.count_if(F.col("Price").isNull()).alias("_missing")).where("_missing = 0").drop("_missing"))
    subtotal, free = F.col("Subtotal"), F.lit(free_from).cast(S.MONEY)
    shipping = F.when((free > 0) & (subtotal >= free), F.lit(0)).otherwise(F.lit(fee)).cast(S.MONEY)
    rate = F.lit(vat).cast("decimal(5,4)")
    tax = F.when(rate > 0, F.round(subtotal * rate, 0)).otherwise(F.lit(0)).cast(S.MONEY)
    return (totals.withColumn("ShippingFee", shipping).withColumn("TaxAmount", tax)
            .withColumn("TotalAmount", subtotal + F.col("ShippingFee") + F.col("TaxAmount")))


def oversell_flags(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Running demand per product in order sequence against the opening stock.

    The flag says "would oversell if every earlier order were accepted": an order refused for another product does
    not hand its demand back here.  The running sum is cut by time and id range, so a product that sells in a
    third of all orders is not gathered in one task.
    """
    demand = lines.groupBy("OrderId", "ProductId").agg(F.sum("Quantity").alias("Quantity"))
    dated = demand.join(orders.select("OrderId", "OrderDate"), "OrderId")
    totals = running_total(dated, ["ProductId"], ["OrderDate", "OrderId"], time_chunk("OrderDate", "OrderId"),
                           "Quantity", "RunningDemand")
    return (totals.join(products.select("ProductId", "StockQuantity"), "ProductId")
            .select("OrderId", "ProductId", "Quantity", "RunningDemand",
                    (F.col("RunningDemand") > F.col("StockQuantity")).alias("Oversold")))


def stock_position(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Opening stock minus units ordered plus units given back by cancelled orders."""
    cancelled = F.col("Status") == S.CANCELLED
    per_product = (items.join(orders.select("OrderId", "Status"), "OrderId").groupBy("ProductId")
                   .agg(F.sum("Quantity").alias("Ordered"),
                        F.sum(F.when(cancelled, F.col("Quantity")).otherwise(0)).alias("Restocked")))
    zero = F.lit(0).cast("long")
    ordered, restocked = F.coalesce("Ordered", zero), F.coalesce("Restocked", zero)
    return (products.join(per_product, "ProductId", "left")
            .select("ProductId", F.col("StockQuantity").alias("Opening"), ordered.alias("Ordered"),
                    restocked.alias("Restocked"), (F.col("StockQuantity") - ordered + restocked).alias("Position")))


def next_states(status: Column) -> Column:
    """Allowed next statuses as an array, empty for a final or unknown status."""
    chain = F
    for code, following in S.TRANSITIONS.items():
        if following:
            chain = chain.when(status == code, F.array(*[F.lit(x) for x in following]))
    return chain.otherwise(F.array().cast("array<int>"))


def order_next_states(orders: DataFrame) -> DataFrame:
    following = next_states(F.col("Status"))
    return orders.select("OrderId", "Status",
                         F.array_join(F.transform(following, lambda x: x.cast("string")), ",").alias("NextStates"),
                         (F.size(following) == 0).alias("IsTerminal"))


def audit_transitions(events: DataFrame) -> DataFrame:
    """Verdict on every status event: does it start right, follow the event before it, and use an allowed step?

    The event before is found minute by minute, so a single order with very many events is still cut into parts.
    """
    moved = previous_value(events, ["OrderId"], ["CreatedAt", "EventId"], time_chunk("CreatedAt", "EventId"),
                           "ToStatus", "Previous")
    source, target, previous = F.col("FromStatus"), F.col("ToStatus"), F.col("Previous")
    verdict = (F.when(previous.isNull() & source.isNull(),
                      F.when(target == S.PENDING, F.lit("ok")).otherwise(F.lit("does not start pending")))
               .when(previous.isNull(), F.lit("first event has a source"))
               .when(~source.eqNullSafe(previous), F.lit("does not follow the previous status"))
               .when(source == target, F.lit("same status"))
               .when(~F.array_contains(next_states(source), target), F.lit("forbidden step"))
               .otherwise(F.lit("ok")))
    return moved.select("EventId", "OrderId", "FromStatus", "ToStatus", verdict.alias("Verdict"))


def mark_refunds(orders: DataFrame) -> DataFrame:
    """A paid order that is cancelled becomes refunded."""
    refund = (F.col("Status") == S.CANCELLED) & (F.col("PaymentStatus") == S.PAY_PAID)
    return orders.withColumn("PaymentStatus", F.when(refund, F.lit(S.PAY_REFUNDED)).otherwise(F.col("PaymentStatus")))


def _asked(requests: DataFrame, orders: DataFrame) -> DataFrame:
    known = orders.select("OrderId", "CustomerId", "Status", "PaymentStatus", "PaymentMethod")
    return requests.join(known, "OrderId", "left")


def _answer(rows: DataFrame, reason: Column) -> DataFrame:
    return rows.select("RequestId", "OrderId", "RequesterId", reason.isNull().alias("Allowed"), reason.alias("Reason"))


def cancel_eligibility(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """May this customer cancel this order?  The first reason against it is named."""
    rows = _asked(requests, orders)
    reason = (F.when(F.col("Status").isNull(), F.concat(F.lit("Order "), F.col("OrderId").cast("string"),
                                                        F.lit(" not found.")))
              .when(F.col("CustomerId") != F.col("RequesterId"), F.lit(NOT_YOURS_TO_CANCEL))
              .when(F.col("Status") != S.PENDING, F.lit(ONLY_PENDING)))
    return _answer(rows, reason)


def payment_eligibility(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """May this customer start an online payment?  Same form."""
    rows = _asked(requests, orders)
    status = F.col("Status")
    reason = (F.when(status.isNull(), F.concat(F.lit("Order "), F.col("OrderId").cast("string"),
                                               F.lit(" not found.")))
              .when(F.col("CustomerId") != F.col("RequesterId"), F.lit(NOT_YOURS_TO_PAY))
              .when(status.isin(S.CANCELLED, S.DELIVERED),
                    F.concat(F.lit("Order in status '"), label(status, S.ORDER_STATUS), F.lit("' cannot be paid.")))
              .when(F.col("PaymentStatus") == S.PAY_PAID, F.lit(PAID_ALREADY))
              .when(F.col("PaymentMethod") == S.COD, F.lit(CASH_ORDER)))
    return _answer(rows, reason)
