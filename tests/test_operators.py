"""Small fixtures with known answers, taken from the behaviour to match."""

import hashlib
import hmac
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import Decimal
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from cartwheel import schemas as S
from cartwheel.functions.scalars import compact_label, vnd_label
from cartwheel.operators import acceptance, adhoc, answer_cache, feeds, gold, lookups, orders, outbox, payments
from cartwheel.operators import quality, validation

from demo_star import star_from_range

NOW = datetime(2024, 5, 1)


# ---------------------------------------------------------------- orders
@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(1, "SKU-1", "Phone", "E", Decimal(25000000), 100),
                                  (2, "SKU-2", "Shoe", "F", Decimal(3500000), 50)],
                                 "ProductId long, Sku string, Name string, Category string, Price decimal(18,2), "
                                 "StockQuantity int")


def _lines(spark, *rows):
    return spark.createDataFrame(list(rows), "OrderId long, ProductId long, Quantity int")


def test_pricing(spark, products):
    lines = _lines(spark, (1, 1, 2), (1, 2, 1), (2, 9, 1), (2, 1, 1))
    plain = orders.price_orders(lines, products, fee="0", free_from="0", vat="0").collect()
    assert [(r.OrderId, r.TotalAmount) for r in plain] == [(1, Decimal(53500000))]  # order 2 names no product
    small = products.withColumn("Price", F.lit("31.25").cast("decimal(18,2)"))
    row = orders.price_orders(_lines(spark, (1, 1, 1)), small, fee="30000", free_from="31.26", vat="0.08").first()
    assert (row.ShippingFee, row.TaxAmount, row.TotalAmount) == (30000, Decimal("3.00"), Decimal("30034.25"))
    free = orders.price_orders(_lines(spark, (1, 1, 1)), small, free_from="31.25", vat="0.08").first()
    assert free.ShippingFee == 0
    # 31.25 * 0.08 = 2.5 goes away from zero


def test_oversell(spark, products):
    heads = spark.createDataFrame([(i, NOW + timedelta(days=i // 3)) for i in range(1, 7)],
                                  "OrderId long, OrderDate timestamp_ntz")
    lines = _lines(spark, *[(i, 2, 10) for i in range(1, 7)], (1, 2, 1))
    rows = {r.OrderId: (r.RunningDemand, r.Oversold) for r in orders.oversell_flags(lines, heads, products).collect()}
    assert rows == {1: (11, False), 2: (21, False), 3: (31, False), 4: (41, False), 5: (51, True), 6: (61, True)}


def replayed(lines, dates, stock):
    """Orders one after the other, as the shop takes them."""
    wanted, left, out = defaultdict(Counter), dict(stock), {}
    for order, product, quantity in lines:
        wanted[order][product] += quantity or 0
    for order in sorted((o for o in wanted if o in dates), key=lambda o: (dates[o], o)):
        if any(p not in stock for p in wanted[order]):
            out[order] = (False, None)
            continue
        short = [p for p, n in wanted[order].items() if n > left[p]]
        out[order] = (not short, min(short, default=None))
        if not short:
            left.update({p: left[p] - n for p, n in wanted[order].items()})
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_orders_are_taken_or_refused_as_a_whole(spark, hot):
    rng = random.Random(3)
    stock = {p: rng.randint(0, 60) for p in range(1, 13)}
    lines = [(o, rng.choice((1, 1, 1, 2)) if hot and rng.random() < 0.5 else rng.randint(1, 12), rng.randint(0, 9))
             for o in range(1, 220) for _ in range(rng.randint(1, 4))] + [(7, 99, 1), (300, 2, 1), (8, 3, None)]
    dates = {o: NOW + timedelta(minutes=rng.randint(0, 40)) for o in range(1, 230)}
    got = acceptance.accept_orders(
        _lines(spark, *lines), spark.createDataFrame(list(dates.items()), "OrderId long, OrderDate timestamp_ntz"),
        spark.createDataFrame(list(stock.items()), "ProductId long, StockQuantity int")).collect()
    want = replayed(lines, dates, stock)
    assert {r.OrderId: (r.Accepted, r.ShortProductId) for r in got} == want and len(got) == len(want)
    assert {r.OrderId for r in got if r.Reason == acceptance.UNKNOWN_PRODUCT} == {7}
    assert 20 < sum(a for a, _ in want.values()) < 200


def test_a_refused_order_leaves_its_demand_to_later_ones(spark, products):
    heads = spark.createDataFrame([(i, NOW + timedelta(days=i)) for i in range(1, 5)], "OrderId long, OrderDate timestamp_ntz")
    # product 1 has 100, product 2 has 50
    lines = _lines(spark, (1, 2, 20), (2, 1, 101), (2, 2, 30), (3, 2, 30), (4, 2, 1))
    rows = {r.OrderId: r.Accepted for r in acceptance.accept_orders(lines, heads, products).collect()}
    assert rows == {1: True, 2: False, 3: True, 4: False}
    assert acceptance.accept_orders(lines.limit(0), heads, products).collect() == []


def test_an_error_in_one_quality_test_is_its_failure_alone(spark):
    table = spark.createDataFrame([(1, 0), (2, 1)], "a int, z int")
    zero, some = (lambda v: v == 0), (lambda v: v > 0)
    tests = [quality.DqTest("divides", "C", "Critical", "x", zero, "t", lambda _: F.sum(F.col("a") / F.col("z"))),
             quality.DqTest("counts", "C", "Low", "x", some, "t", lambda _: F.count(F.lit(1))),
             quality.DqTest("no column", "C", "Low", "x", zero, "t", lambda _: F.sum("gone")),
             quality.DqTest("no table", "C", "Low", "x", zero, "gone", lambda _: F.count(F.lit(1))),
             quality.DqTest("frame", "C", "Low", "x", zero, frame=lambda t: t["t"].select(F.raise_error(F.lit("late")))),
             quality.DqTest("fine", "C", "Low", "x", zero, frame=lambda t: t["t"].where("a > 5").agg(F.count(F.lit(1))))]
    rows = {r.TestName: r for r in quality.run_suite({"t": table}, tests, NOW).collect()}
    assert {n: r.Status for n, r in rows.items()} == {"divides": "Fail", "counts": "Pass", "no column": "Fail", "no table": "Fail",
                                                      "frame": "Fail", "fine": "Pass"}
    assert "DIVIDE_BY_ZERO" in rows["divides"].Message and "late" in rows["frame"].Message and rows["counts"].Message is None
    assert quality.summary(quality.run_suite({"t": table}, tests, NOW)).first().Critical == 1


def test_stock_after_sale_and_cancel(spark, products):
    heads = spark.createDataFrame([(1, 1), (2, 5)], "OrderId long, Status int")
    rows = {r.ProductId: r.Position
            for r in orders.stock_position(_lines(spark, (1, 1, 3), (2, 1, 4)), heads, products).collect()}
    assert rows == {1: 97, 2: 50}


@pytest.mark.parametrize("source,target,verdict", [
    (1, 2, "ok"), (1, 5, "ok"), (2, 3, "ok"), (2, 5, "ok"), (3, 4, "ok"), (1, 3, "forbidden step"),
    (1, 4, "forbidden step"), (2, 4, "forbidden step"), (3, 5, "forbidden step"), (4, 3, "forbidden step"),
    (4, 5, "forbidden step"), (5, 1, "forbidden step"), (5, 2, "forbidden step"), (2, 2, "same status")])
def test_transition(spark, source, target, verdict):
    paths = {1: [1], 2: [1, 2], 3: [1, 2, 3], 4: [1, 2, 3, 4], 5: [1, 5]}
    steps = [None, *paths[source], target]
    rows = [(i, 1, a, b, NOW + timedelta(hours=30 * i)) for i, (a, b) in enumerate(zip(steps, steps[1:]))]
    events = spark.createDataFrame(rows, "EventId long, OrderId long, FromStatus int, ToStatus int, "
                                         "CreatedAt timestamp_ntz")
    got = [r.Verdict for r in orders.audit_transitions(events).orderBy("EventId").collect()]
    assert got == ["ok"] * (len(rows) - 1) + [verdict]


def test_transition_must_follow(spark):
    events = spark.createDataFrame([(1, 1, 1, 2, NOW), (2, 1, 1, 2, NOW + timedelta(hours=1)), (3, 2, None, 2, NOW)],
                                   "EventId long, OrderId long, FromStatus int, ToStatus int, CreatedAt timestamp_ntz")
    got = [r.Verdict for r in orders.audit_transitions(events).orderBy("EventId").collect()]
    assert got == ["first event has a source", "does not follow the previous status", "does not start pending"]


# ---------------------------------------------------------------- payments
def _payment(spark, status=2, order_status=1):
    return spark.createDataFrame([("R", 7, "ORD-7", Decimal(50000), 2, status, order_status)],
                                 "Ref string, OrderId long, OrderNumber string, Amount decimal(18,2), Provider int, "
                                 "Status int, OrderStatus int")


def _outcomes(spark, rows, **kw):
    callbacks = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], S.CALLBACKS)
    settled = payments.settle(callbacks, _payment(spark, **kw)).orderBy("Seq").collect()
    return [(r.Outcome, r.PaymentStatus, r.AutoConfirms) for r in settled]


def test_settlement_success_then_replay(spark):
    good = ("R", Decimal(50000), True, True)
    assert _outcomes(spark, [good, good]) == [("Payment successful.", 3, True), ("Already processed.", 3, False)]


def test_settlement_mismatch_then_success(spark):
    rows = [("R", Decimal(1), True, True), ("R", Decimal(50000), False, False), ("R", Decimal(50000), True, True),
            ("R", Decimal(1), True, True), ("X", Decimal(50000), True, True)]
    assert _outcomes(spark, rows) == [
        ("Amount mismatch.", 4, False), ("Invalid signature.", 4, False), ("Payment successful.", 3, True),
        ("Already processed.", 3, False), ("Unknown payment reference.", 4, False)]


def test_settlement_failure_and_first_forgery(spark):
    rows = [("R", Decimal(50000), False, False), ("R", Decimal(50000), True, False)]
    assert _outcomes(spark, rows) == [("Invalid signature.", 2, False), ("Payment failed or cancelled.", 4, False)]
    assert _outcomes(spark, [("R", Decimal(50000), True, True)], status=3) == [("Already processed.", 3, False)]
    assert _outcomes(spark, [("R", Decimal(50000), True, True)], order_status=2) == [("Payment successful.", 3, False)]


def _brute_settlement(rows, due):
    state, out = {ref: 2 for ref in due}, []
    for ref, amount, valid, success in rows:
        if ref not in due:
            out.append(("Unknown payment reference.", 4))
        elif state[ref] == 3:
            out.append(("Already processed.", 3))
        elif not valid:
            out.append(("Invalid signature.", state[ref]))
        elif success and amount == due[ref]:
            state[ref] = 3
            out.append(("Payment successful.", 3))
        else:
            state[ref] = 4
            out.append(("Amount mismatch." if success else "Payment failed or cancelled.", 4))
    return out


def test_settlement_against_a_walk(spark):
    import random
    rng = random.Random(4)
    due = {f"R{i}": Decimal(100 + i) for i in range(30)}
    rows = []
    for _ in range(600):
        ref = "R0" if rng.random() < 0.4 else f"R{rng.randrange(33)}"  # one ref holds a large part
        valid = rng.random() < 0.7
        rows.append((ref, due.get(ref, Decimal(1)) - (rng.random() < 0.5), valid, valid and rng.random() < 0.2))
    known = spark.createDataFrame([(r, i, r, a, 2, 2, 1) for i, (r, a) in enumerate(due.items())],
                                  _payment(spark).schema)
    callbacks = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], S.CALLBACKS)
    got = [(r.Outcome, r.PaymentStatus) for r in payments.settle(callbacks, known).orderBy("Seq").collect()]
    assert got == _brute_settlement(rows, due)
    # in two batches with carried marks
    one, two = (callbacks.where(F.col("Seq") < 250), callbacks.where(F.col("Seq") >= 250))
    marks = payments.settle_marks(one, known)
    parts = payments.settle(one, known).unionByName(payments.settle(two, known, marks)).orderBy("Seq").collect()
    assert [(r.Outcome, r.PaymentStatus) for r in parts] == got


VNPAY = {"vnp_Amount": "5000000", "vnp_ResponseCode": "00", "vnp_TransactionStatus": "00", "vnp_TxnRef": "12345",
         "vnp_OrderInfo": "Pay order 7", "vnp_TransactionNo": "T1", "vnp_Empty": "", "other": "x"}


def _verify(spark, provider, params):
    rows = spark.createDataFrame([(1, provider, params)], "Seq long, Provider int, Params map<string,string>")
    return payments.verify(rows, "secret", "momo-secret", "ACC").first()


def test_vnpay_callback(spark):
    text = "&".join(f"{k}={quote_plus(v)}" for k, v in sorted(VNPAY.items()) if k.startswith("vnp_") and v)
    sign = hmac.new(b"secret", text.encode(), hashlib.sha512).hexdigest()
    row = _verify(spark, 2, VNPAY | {"vnp_SecureHash": sign.upper(), "vnp_SecureHashType": "SHA512"})
    assert (row.SignatureValid, row.Success, row.Amount, row.Ref) == (True, True, Decimal(50000), "12345")
    forged = _verify(spark, 2, VNPAY | {"vnp_SecureHash": sign, "vnp_Amount": "1"})
    assert (forged.SignatureValid, forged.Success) == (False, False)
    assert not _verify(spark, 2, VNPAY).SignatureValid


def test_momo_callback(spark):
    params = {"amount": "50000", "orderId": "R", "resultCode": "0", "transId": "9", "message": "ok"}
    text = "accessKey=ACC" + "".join(f"&{k}={params.get(k, '')}" for k in payments.MOMO_SIGNED_FIELDS)
    sign = hmac.new(b"momo-secret", text.encode(), hashlib.sha256).hexdigest()
    row = _verify(spark, 3, params | {"signature": sign})
    assert (row.SignatureValid, row.Success, row.Amount) == (True, True, Decimal(50000))
    failed = dict(params, resultCode="1006")
    text = "accessKey=ACC" + "".join(f"&{k}={failed.get(k, '')}" for k in payments.MOMO_SIGNED_FIELDS)
    sign = hmac.new(b"momo-secret", text.encode(), hashlib.sha256).hexdigest()
    row = _verify(spark, 3, failed | {"signature": sign})
    assert (row.SignatureValid, row.Success) == (True, False)


# ---------------------------------------------------------------- outbox
def test_outbox_rules(spark):
    rows = [(i, 7 if i != 3 else 99, kind, "{}", done, tries, None) for i, kind, done, tries in (
        (1, "OrderPlaced", None, 0), (2, "PaymentSucceeded", NOW, 0), (3, "OrderPlaced", None, 4),
        (4, "Strange", None, 5), (5, "OrderStatusChanged", None, 4))]
    box = spark.createDataFrame(rows, S.OUTBOX)
    heads = spark.createDataFrame([(7, "ORD-7", 1, 3, 2, Decimal("1234567.50"))],
                                  "OrderId long, OrderNumber string, CustomerId long, Status int, PaymentStatus int, "
                                  "TotalAmount decimal(18,2)")
    people = spark.createDataFrame([(1, "a@x")], "CustomerId long, Email string")
    due = outbox.pending(box)
    assert [r.OutboxId for r in outbox.next_batch(box, 2).collect()] == [1, 3]
    text = {r.OutboxId: r for r in outbox.render(due, heads, people).collect()}
    assert text[1].Subject == "Đơn hàng ORD-7 đã được tạo" and "1.234.568 ₫" in text[1].Html
    assert text[5].InApp == "Đơn ORD-7: Đang giao." and text[3].Channel == "drop" and text[3].Html is None
    log = spark.createDataFrame([(1, 0), (3, 9), (5, 9)], "OutboxId long, Failures int")
    after = {r.OutboxId: r for r in outbox.mark(due, heads, log, NOW).collect()}
    assert after[1].ProcessedAt == NOW and after[3].ProcessedAt == NOW  # order gone: dropped as done
    assert after[5].ProcessedAt is None and after[5].Attempts == 5 and after[5].LastError


def test_labels(spark):
    values = ["0", "999.5", "999", "1000", "1250", "1400000", "22300000000000", "2500000000"]
    rows = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(18,2)")
    got = [r[0] for r in rows.select(compact_label(F.col("v"))).collect()]
    assert got == ["0", "999,5", "999", "1.0K", "1.3K", "1.4M", "22.3T", "2.5B"]
    assert rows.select(vnd_label(F.col("v"))).collect()[5][0] == "1.400.000 ₫"
    wide = spark.createDataFrame([(Decimal("60349999995.28"),)], "v decimal(38,2)")
    assert wide.select(compact_label(F.col("v"), True)).first()[0] == "60.3B ₫"
    from cartwheel.plans import reports
    day = wide.selectExpr("date'2024-01-01' Day", "cast(499999.99 as decimal(38,2)) TotalRevenue", "1 OrderCount")
    assert reports.chart_by_day(day).first().RevenueMillions == 0


def test_average_and_percent_round_once(spark):
    from fractions import Fraction

    from cartwheel.functions.scalars import average, percent, percent_half_even
    cases = [(Decimal("100.00"), 3), (Decimal("0.05"), 10), (Decimal("1.00"), 8), (Decimal("7.00"), 0),
             (Decimal("99999999.99"), 7), (Decimal("1234567.89"), 20000003), (Decimal("500002.49"), 100000500)]
    rows = spark.createDataFrame(cases, "t decimal(38,2), n long")

    def up(value, digits):
        scaled = value * 10**digits
        return Decimal(int(scaled + Fraction(1, 2))) / 10**digits

    got = rows.select(average(F.col("t"), F.col("n")), percent(F.col("n"), F.lit(400).cast("long"))).collect()
    for (total, n), (mean, share) in zip(cases, got):
        assert mean == (up(Fraction(total) / n, 2) if n else None)
        assert share == up(Fraction(100 * n, 400), 1)
    even = rows.select(percent_half_even(F.lit(1), F.lit(400)), percent_half_even(F.lit(3), F.lit(400)),
                       percent_half_even(F.lit(1), F.lit(0))).first()
    assert tuple(map(str, even)) == ("0.2", "0.8", "0.0")


# ---------------------------------------------------------------- feeds and rules
def test_customer_feed_claims(spark):
    feed = spark.createDataFrame([
        (2, "", "a@x", "", ""), (3, " Ann ", " A@x ", " 1 ", " "), (4, "Bob", "a@X", None, "HN"), (5, "Cy", "", "", ""),
        (6, "Dan", "OLD@x", "", ""), (7, "", "", "", ""), (8, "Eve", "e@x", "", None)],
        "RowNo long, FullName string, Email string, Phone string, City string")
    loaded = feeds.load_customers(feed, spark.createDataFrame([("old@x",)], "Email string"))
    assert [tuple(r) for r in loaded.accepted.orderBy("RowNo").collect()] == [
        (3, "Ann", "A@x", "1", None), (8, "Eve", "e@x", None, None)]
    assert {r.RowNo: r.Message for r in loaded.errors.collect()} == {
        2: "FullName is required", 4: "Duplicate Email: a@X", 5: "Email is required", 6: "Duplicate Email: OLD@x"}
    assert feeds.feed_summary("customers", feed, loaded).first()[:3] == (6, 2, 4)


def test_order_feed(spark, products):
    people = spark.createDataFrame([(1, "a@x")], "CustomerId long, Email string")
    feed = spark.createDataFrame([
        (2, "R1", "A@X", "sku-1", "2"), (3, "R1", "ghost", "SKU-2", "1"), (4, "R2", "ghost", "none", "1"),
        (5, "R3", "a@x", "none", "1"), (6, "R3", "a@x", "none2", "1"), (7, "R3", "a@x", "sku-1", "1"),
        (8, "R1", "a@x", "sku-1", "0"), (9, "R4", "a@x", "sku-1", "x")],
        "RowNo long, OrderRef string, CustomerEmail string, Sku string, Quantity string")
    loaded = feeds.load_orders(feed, people, products, NOW)
    assert [(r.OrderRef, r.OrderNumber, r.TotalAmount, r.Lines) for r in loaded.accepted.collect()] == [
        ("R1", "ORD-XLS-20240501000000-R1", Decimal(53500000), 2)]
    assert {r.RowNo: r.Message for r in loaded.errors.collect()} == {
        4: "Customer not found by email: ghost", 5: "Product not found by SKU: none",
        6: "Product not found by SKU: none2", 8: "Quantity must be > 0", 9: "Quantity is not a number"}


def test_order_request_rules(spark):
    heads = spark.createDataFrame([(i, 0 if i == 1 else -1 if i == 2 else 1, 2) for i in range(1, 8)],
                                  "RequestId long, CustomerId long, PaymentMethod int")
    for name in ("ShipFullName", "ShipPhone", "ShipAddress", "Note"):
        heads = heads.withColumn(name, F.lit(None).cast("string"))
    lines = ([(i, 1, 1) for i in (1, 2)] + [(3, 1, 0)] + [(4, 1, -5)] + [(5, 1, 10001), (5, 1, 10000)]
             + [(6, 1, 1)] * 101)
    rules = validation.validate_orders(heads, spark.createDataFrame(lines, "RequestId long, ProductId long, "
                                                                           "Quantity int"))
    got = {}
    for r in rules.collect():
        got.setdefault(r.RequestId, []).append(r.Rule)
    assert got == {1: ["CustomerId must be greater than 0"], 2: ["CustomerId must be greater than 0"],
                   3: ["Quantity must be greater than 0"], 4: ["Quantity must be greater than 0"],
                   5: ["Quantity per line cannot exceed 10000"], 6: ["An order cannot contain more than 100 items"],
                   7: ["Order must contain at least 1 item"]}


@pytest.mark.parametrize("email,ok", [("a@b", True), ("not-an-email", False), ("@no-local-part", False),
                                      ("x@", False), ("a@b@c", False)])
def test_email_form(spark, email, ok):
    row = spark.createDataFrame([(1, "N", email, "1", None)],
                                "CustomerId long, FullName string, Email string, Phone string, City string")
    assert (validation.validate_customers(row).count() == 0) == ok


@pytest.mark.parametrize("total,size,pages", [(100, 20, 5), (101, 20, 6), (99, 20, 5), (0, 20, 0), (1, 20, 1),
                                              (20, 20, 1), (5, 0, 0)])
def test_pages(spark, total, size, pages):
    assert lookups.page_counts(spark.range(total), size).first() == (total, pages)


def test_order_document_nested(retail):
    doc = lookups.order_document(3, retail.orders, retail.customers, retail.order_items, retail.products,
                                 retail.order_events).first()
    lines = retail.order_items.where("OrderId = 3").count()
    assert len(doc.Items) == lines and [e.ToStatus for e in doc.Events] == sorted(e.ToStatus for e in doc.Events)


# ---------------------------------------------------------------- quality
def test_suite_reports_a_broken_test_as_failed(spark):
    fact = spark.createDataFrame([(1, 1)], "OrderItemId long, Quantity int")
    results = {r.TestName: r for r in quality.run_suite({"fact": fact}, quality.suite(), NOW).collect()}
    assert len(results) == 15
    assert results["fact_no_duplicate_orderitemid"].Status == "Pass"
    assert results["fact_row_count_nonzero"].Status == "Pass"
    broken = results["fact_no_negative_revenue"]
    assert broken.Status == "Fail" and broken.ActualValue == "0" and broken.Message
    assert results["payment_paid_not_exceed_total"].Status == "Fail"


def test_null_keys_are_orphans(spark):
    fact = spark.createDataFrame([(1,), (None,), (5,), (5,)], "CustomerKey long")
    dim = spark.createDataFrame([(1,)], "CustomerKey long")
    test = [t for t in quality.suite() if t.name == "fact_customerkey_resolves"]
    assert quality.run_suite({"fact": fact, "dim_customer": dim}, test, NOW).first().ActualValue == "3"


@pytest.mark.parametrize("minutes,status", [(89, "Healthy"), (90, "Healthy"), (91, "Degraded")])
def test_staleness(spark, minutes, status):
    marks = spark.createDataFrame([(NOW - timedelta(minutes=minutes),)], "LastProcessedAt timestamp_ntz")
    assert quality.staleness(marks, NOW, 90).first().Status == status
    assert quality.staleness(marks.limit(0), NOW, 90).first().Status == "Healthy"


# ---------------------------------------------------------------- gold
def test_gold_drops_days_outside_the_calendar_and_splits_a_renamed_product(spark):
    fact = spark.createDataFrame([(20240101, 1001, 1001, 1, 1, 2, Decimal(5)), (20240102, 1001, 1002, 2, 2, 1, Decimal(7)),
                                  (19000101, 1001, 1001, 3, 3, 1, Decimal(9))],
                                 "DateKey int, CustomerKey long, ProductKey long, OrderId long, OrderItemId long, "
                                 "Quantity int, LineTotal decimal(18,2)")
    days = spark.sql("select 20240101 DateKey, date'2024-01-01' Date, 2024 Year, 1 Month union all "
                     "select 20240102, date'2024-01-02', 2024, 1")
    product = spark.createDataFrame([(1001, 1, "S", "Old", "C", False), (1002, 1, "S", "New", "C", True)],
                                    "ProductKey long, ProductId long, Sku string, Name string, Category string, "
                                    "IsCurrent boolean")
    daily = gold.daily_sales_by_category(fact, days, product)
    assert sorted((str(r.Date), r.OrderCount, r.TotalRevenue) for r in daily.collect()) == [
        ("2024-01-01", 1, 5), ("2024-01-02", 1, 7)]
    monthly = gold.monthly_top_products(fact, days, product).orderBy("RankInMonth").collect()
    assert [(r.ProductName, r.RankInMonth) for r in monthly] == [("New", 1), ("Old", 2)]
    stock = spark.createDataFrame([(1, "S", "New", "C", 3)], "ProductId long, Sku string, Name string, "
                                                             "Category string, StockQuantity int")
    assert gold.product_inventory(fact, product, stock).first().UnitsSold == 1
    assert gold.product_inventory(fact, product, stock, all_versions=True).first().UnitsSold == 4


# ---------------------------------------------------------------- ad-hoc
STAR_ANSWERS = {
    "rev": 525529000,
    "top": [("Brown Sugar Boba", 2668), ("Matcha Milk Tea", 2001), ("Peach Tea", 2001), ("Pudding Topping", 2001),
            ("Strawberry Smoothie", 2001)],
    "city": {"Hồ Chí Minh": 180216500, "Hà Nội": 175263900, "Hải Phòng": 113591800, "Đà Nẵng": 51571200},
    "orders": 1990,
    "method": {"Cash": 391599000, "Card": 378685400, "EWallet": 275888000},
    "tier": {"Bronze": 315024600, "Silver": 148589900, "Gold": 61914500},
    "months": [44013000, 40006900, 44174500, 42760200, 44129500, 43144700, 43965600, 44421000, 42453800, 44447300,
               42760200, 44366700],
    "stores": [("Bubble House Le Chan", 227460400), ("Bubble House Thu Duc", 213687500),
               ("Bubble House Hoan Kiem", 177911500)],
}


def test_star_golden_numbers(spark):
    star = star_from_range(spark)
    want = STAR_ANSWERS
    assert star["FactOrderItem"].count() == 12000 and star["DimDate"].count() == 731
    assert adhoc.star_revenue(star, 2024).first()[0] == want["rev"]
    assert [tuple(r) for r in adhoc.star_top_products(star).collect()] == want["top"]
    assert dict(map(tuple, adhoc.star_revenue_by_city(star, 2025).collect())) == want["city"]
    assert adhoc.star_orders(star, 2025).first()[0] == want["orders"]
    assert dict(map(tuple, adhoc.star_by_method(star).collect())) == want["method"]
    assert dict(map(tuple, adhoc.star_by_tier(star, 2024).collect())) == want["tier"]
    months = sorted((r.MonthNum, r.Revenue) for r in adhoc.star_monthly(star, 2025).collect())
    assert [m[1] for m in months] == want["months"]
    assert [tuple(r) for r in adhoc.star_top_stores(star).collect()] == want["stores"]


def test_result_difference(spark):
    one = spark.createDataFrame([(1, Decimal("2.50"), None), (1, Decimal("2.50"), None)], "a int, b decimal(9,2), c string")
    two = spark.createDataFrame([(2.5, 1, None)], "b double, a long, c string").select("a", "b", "c")
    assert adhoc.result_difference(one, one).count() == 0
    row = adhoc.result_difference(one, two).first()
    assert (row.Row, row.OnlyIn, row.Copies) == ("1␟2.5␟(null)", "left", 1)
    assert adhoc.result_difference(one, one.select("a", "b")).count() == 2


def test_repeat_questions(spark):
    rows = [(i, NOW + timedelta(minutes=m), q, s) for i, (m, q, s) in enumerate((
        (0, "Q", "Error"), (1, "q ", "Answered"), (11, "Q", "Answered"), (30, "q", "Answered"), (90, "x", "Answered")))]
    log = spark.createDataFrame(rows, "AskId long, AskedAt timestamp_ntz, Question string, Status string")
    got = {r.AskId: (r.AskedBefore, r.Repeat) for r in adhoc.repeat_questions(log).collect()}
    assert got == {1: (False, False), 2: (True, True), 3: (True, False), 4: (False, False)}


def test_deep_pages_equal_sorted_pages(spark):
    """Many orders on one day and moment, null dates, ids in several groups; past the end there is nothing."""
    rng = random.Random(5)
    moments = [None, NOW, NOW, NOW, NOW + timedelta(seconds=1), NOW - timedelta(days=3)]
    rows = [(i * 9973, f"O{i}", 1, "N", rng.choice(moments + [NOW - timedelta(hours=rng.randrange(900))]), 1, 1, 5)
            for i in range(400)]
    heads = spark.createDataFrame(rows, "OrderId long, OrderNumber string, CustomerId long, CustomerName string, "
                                        "OrderDate timestamp_ntz, Status int, PaymentStatus int, TotalAmount int")
    items = spark.createDataFrame([(9973,), (9973,)], "OrderId long")
    for page, size in ((1, 20), (4, 50), (8, 50), (20, 20), (21, 20), (134, 3)):
        want = lookups.order_page(heads, items, page, size).orderBy("OrderId").collect()
        assert lookups.order_page_deep(heads, items, page, size).orderBy("OrderId").collect() == want
    assert not want[1:] and lookups.order_page_deep(heads, items, 10**6, 200).isEmpty()


def _walk(rows, seconds=600):
    stored, want = {}, {}
    for i, at, text, status in sorted(rows, key=lambda row: (row[1], row[0])):
        if status != "Error":
            key = None if text is None else text.strip(" ").lower()
            want[i] = key in stored and at < stored[key] + timedelta(seconds=seconds)
            if not want[i]:
                stored[key] = at
    return want


@pytest.mark.parametrize("steps", [(0, 1, 5, 60, 2), (599, 600, 601, 1200), (1, 1, 1, 0), (7000, 300)])
def test_cache_hits_against_a_walk(spark, steps):
    """An answer lives 600 seconds from when it was stored: dense, sparse and exact steps, one text asked by many."""
    rng, rows, clock = random.Random(7), [], 0
    for i in range(3000):
        clock += rng.choice([*steps, 700 if rng.random() < 0.05 else 2])
        text = "hot" if rng.random() < 0.4 else f"q{rng.randrange(20)}"
        rows.append((i, NOW + timedelta(seconds=clock), rng.choice([text, text.upper(), f" {text}", None]),
                     "Error" if rng.random() < 0.1 else "Answered"))
    want = _walk(rows)
    log = spark.createDataFrame(rows, "AskId long, AskedAt timestamp_ntz, Question string, Status string")
    got = answer_cache.cache_hits(log.repartition(5)).collect()
    assert len(got) == len(want) and {r.AskId: r.CacheHit for r in got} == want


def test_cache_hits_of_odd_logs(spark):
    schema = "AskId long, AskedAt timestamp_ntz, Question string, Status string"
    assert answer_cache.cache_hits(spark.createDataFrame([], schema)).isEmpty()
    rows = [(1, None, "q", "Answered"), (2, NOW, None, "Answered"), (3, NOW, "", "Answered"),
            (4, NOW, None, "Answered"), (5, NOW, "q", "Error")]
    got = {r.AskId: r.CacheHit for r in answer_cache.cache_hits(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}
