"""Lists, searches and read models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.functions.scalars import contains_text, ts
from cartwheel.operators.orders import next_states


def _newest() -> list[Column]:
    return [F.desc("OrderDate"), F.desc("OrderId")]


def _page(rows: DataFrame, order: list, page: int, size: int, default: int, largest: int) -> DataFrame:
    page = max(page, 1)
    size = default if size <= 0 else min(size, largest)
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)


def deep_page(rows: DataFrame, order: list, levels: list[Column], newest_first: bool, first: int, size: int) -> DataFrame:
    """The rows from place ``first`` (0-based) on, for pages so deep that a sorted prefix would be too much to hold.

    Each level is a struct that never runs against ``order``, each finer than the one before.  Its groups are counted, and
    only those that the page touches stay, at most ``size`` since none is empty.  So what is sorted in the end is the page
    and the rest of its finest groups.  A row that many share costs its group, not the rows before it.
    """
    way = F.desc if newest_first else F.asc
    for level in levels:
        groups = rows.groupBy(level.alias("_level")).agg(F.count(F.lit(1)).alias("_rows"))
        upto = F.sum("_rows").over(Window.orderBy(way("_level")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        touched = (groups.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_rows"))
                   .where((F.col("_upto") > first) & (F.col("_before") < first + size)))
        skipped = touched.agg(F.min("_before")).first()[0]
        if skipped is None:
            return rows.limit(0)
        rows = rows.join(F.broadcast(touched.select("_level")), level.eqNullSafe(F.col("_level")), "left_semi")
        first -= skipped
    return rows.orderBy(*order).offset(first).limit(size)


#: order ids that one group of a deep page spans
IDS_PER_GROUP = 65_536


def matching_orders(orders: DataFrame, customers: DataFrame, status: int | None = None,
                    customer_id: int | None = None, date_from: datetime | None = None,
                    date_to: datetime | None = None, search: str = "") -> DataFrame:
    """Orders with their customer's name, every filter optional."""
    rows = orders
    for wanted, test in ((status, F.col("Status") == status), (customer_id, F.col("CustomerId") == customer_id),
                         (date_from, F.col("OrderDate") >= ts(date_from or "2000-01-01")),
                         (date_to, F.col("OrderDate") <= ts(date_to or "2000-01-01"))):
        if wanted is not None:
            rows = rows.where(test)
    rows = rows.join(customers.select("CustomerId", F.col("FullName").alias("CustomerName")), "CustomerId")
    if search.strip():
        rows = rows.where(contains_text(F.col("OrderNumber"), search) | contains_text(F.col("CustomerName"), search))
    return rows


def order_page(matching: DataFrame, items: DataFrame, page: int = 1, size: int = 20) -> DataFrame:
    """Newest first.  The page (200 orders at most) is cut first; lines are counted for those orders only."""
    return _with_line_counts(_page(matching, _newest(), page, size, 20, 200), items)


def order_page_deep(matching: DataFrame, items: DataFrame, page: int, size: int = 20) -> DataFrame:
    """The same page, found by counts per day and then per id range of a day instead of by sorting all before it."""
    size = 20 if size <= 0 else min(size, 200)
    day = F.col("OrderDate").cast("date")
    levels = [F.struct(day), F.struct(day, "OrderDate", F.floor(F.col("OrderId") / IDS_PER_GROUP))]
    return _with_line_counts(deep_page(matching, _newest(), levels, True, (max(page, 1) - 1) * size, size), items)


def _with_line_counts(page: DataFrame, items: DataFrame) -> DataFrame:
    cut = page.select(
        "OrderId", "OrderNumber", "CustomerId", "CustomerName", "OrderDate", "Status", "PaymentStatus", "TotalAmount")
    # at most 200 keys by construction
    lines = (items.join(F.broadcast(cut.select("OrderId")), "OrderId", "left_semi")
             .groupBy("OrderId").agg(F.count(F.lit(1)).alias("ItemCount")))
    return cut.join(lines, "OrderId", "left").withColumn("ItemCount", F.coalesce("ItemCount", F.lit(0).cast("long")))


def matching_products(products: DataFrame, search: str = "", category: str = "") -> DataFrame:
    rows = products
    if search.strip():
        rows = rows.where(contains_text(F.col("Sku"), search) | contains_text(F.col("Name"), search))
    return rows.where(F.col("Category") == category) if category.strip() else rows


def product_page(matching: DataFrame, page: int = 1, size: int = 50) -> DataFrame:
    return _page(matching, ["Name", "ProductId"], page, size, 50, 500)


def matching_customers(customers: DataFrame, search: str = "") -> DataFrame:
    if not search.strip():
        return customers
    tests: list[Column] = [contains_text(F.coalesce(c, F.lit("")), search) for c in ("FullName", "Email", "City")]
    return customers.where(tests[0] | tests[1] | tests[2])


def customer_page(matching: DataFrame, page: int = 1, size: int = 50) -> DataFrame:
    return _page(matching, ["CustomerId"], page, size, 50, 500)


def page_counts(matching: DataFrame, size: int) -> DataFrame:
    """Rows found and pages of ``size`` (0 pages when the size is 0)."""
    pages = F.ceil(F.col("TotalCount") / F.lit(size)) if size > 0 else F.lit(0).cast("long")
    return matching.agg(F.count(F.lit(1)).alias("TotalCount")).withColumn("TotalPages", pages)


def categories(products: DataFrame) -> DataFrame:
    return products.select("Category").distinct().orderBy("Category")


def order_documents(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame,
                    events: DataFrame) -> DataFrame:
    """Everything shown on an order's page, one row per entry.

    Sections: header, item, event, next status.  Kept as rows and not folded into one nested value per order: an
    order with very many lines stays spread over tasks.  ``Rank`` orders the entries of a section.
    """
    def text(column) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    def section(rows: DataFrame, name: str, rank: Column, *fields: Column) -> DataFrame:
        return rows.select("OrderId", F.lit(name).alias("Section"), rank.cast("long").alias("Rank"),
                           F.concat_ws("|", *fields).alias("Entry"))

    headed = orders.join(customers.select("CustomerId", "FullName", "Email"), "CustomerId", "left")
    head = section(headed, "header", F.lit(0), text("OrderNumber"), text("FullName"), text("Email"), text("Status"),
                   text("PaymentMethod"), text("PaymentStatus"), text("TotalAmount"))
    sold = items.join(products.select("ProductId", "Sku", "Name"), "ProductId")
    item = section(sold, "item", F.col("OrderItemId"), text("ProductId"), text("Sku"), text("Name"), text("Quantity"),
                   text("UnitPrice"), text("LineTotal"))
    moment = F.unix_seconds(F.col("CreatedAt").cast("timestamp"))
    event = section(events, "event", moment, text("FromStatus"), text("ToStatus"), text("ActorCustomerId"))
    follow = orders.select("OrderId", F.posexplode(next_states(F.col("Status"))).alias("Nr", "State"))
    after = section(follow, "next", F.col("Nr"), text("State"))
    return head.unionByName(item).unionByName(event).unionByName(after)


def order_document(order_id: int, orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame,
                   events: DataFrame) -> DataFrame:
    """One order as a nested row: header, list of items, list of events by time, next statuses.

    For the page of a single order, which the order rules hold to 100 lines; whole tables go through
    ``order_documents``.
    """
    one = F.col("OrderId") == order_id
    sold = (items.where(one).join(products.select("ProductId", "Sku", "Name"), "ProductId").groupBy("OrderId")
            .agg(F.array_sort(F.collect_list(F.struct("OrderItemId", "ProductId", "Sku", "Name", "Quantity",
                                                      "UnitPrice", "LineTotal"))).alias("Items")))
    past = events.where(one).groupBy("OrderId").agg(
        F.array_sort(F.collect_list(F.struct("CreatedAt", "FromStatus", "ToStatus", "ActorCustomerId")))
        .alias("Events"))
    return (orders.where(one).join(customers.select("CustomerId", "FullName", "Email"), "CustomerId", "left")
            .join(sold, "OrderId", "left").join(past, "OrderId", "left")
            .withColumn("NextStatuses", next_states(F.col("Status"))))


def related_products(products: DataFrame, size: int = 4) -> DataFrame:
    """For every product the first others of its category by name.

    Each category keeps ``size + 1`` candidates (a per-group top-k that Spark cuts before the shuffle); one more
    than needed, because a product drops itself.  No product meets its whole category.
    """
    rank = F.row_number().over(Window.partitionBy("Category").orderBy("Name", "ProductId"))
    best = (products.select("Category", "Name", "ProductId").withColumn("Nr", rank).where(F.col("Nr") <= size + 1)
            .groupBy("Category").agg(F.array_sort(F.collect_list(F.struct("Nr", F.col("ProductId").alias("Id"))))
                                     .alias("Best")))
    others = F.slice(F.filter("Best", lambda x: x["Id"] != F.col("ProductId")), 1, size)
    return (products.select("ProductId", "Category").join(best, "Category")
            .select("ProductId", F.posexplode(others).alias("_at", "_other"))
            .select("ProductId", (F.col("_at") + 1).alias("Position"), F.col("_other.Id").alias("RelatedId")))


def address_book(addresses: DataFrame) -> DataFrame:
    """At most one default per customer: the newest claim wins, the others are demoted.

    Each customer's addresses come default first, then newest, inside a partition; customers in no order.
    """
    winner = (addresses.where("IsDefault").groupBy("CustomerId").agg(F.max("AddressId").alias("_winner")))
    return (addresses.join(winner, "CustomerId", "left")
            .withColumn("IsDefault", F.coalesce(F.col("AddressId") == F.col("_winner"), F.lit(False))).drop("_winner")
            .sortWithinPartitions("CustomerId", F.desc("IsDefault"), F.desc("AddressId")))


def products_unreferenced(products: DataFrame, items: DataFrame) -> DataFrame:
    """Every product with whether some order line names it; the others may be deleted."""
    sold = items.select("ProductId").distinct().withColumn("_sold", F.lit(True))
    return (products.select("ProductId", "Sku").join(sold, "ProductId", "left")
            .select("ProductId", "Sku", F.col("_sold").isNull().alias("Deletable")))
