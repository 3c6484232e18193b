"""Notification outbox: what is due, what it says, what became of it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel import schemas as S
from cartwheel.functions.scalars import label, ts, vnd_label

# ---- fixed values: notification texts --------------------------------------------------------------------------------
STATUS_LABELS = {S.PENDING: "Chờ xử lý", S.CONFIRMED: "Đã xác nhận", S.SHIPPED: "Đang giao", S.DELIVERED: "Đã giao",
                 S.CANCELLED: "Đã huỷ"}
#: event type: (subject, heading, body, in-app text); {no}, {total} and {status} are filled per order
TEXTS = {
    "OrderPlaced": (
        "Đơn hàng {no} đã được tạo", "Cảm ơn bạn đã đặt hàng!",
        "Đơn <b>{no}</b> với tổng tiền <b>{total}</b> đã được ghi nhận và đang chờ xử lý.",
        "Đơn {no} đã được tạo."),
    "PaymentSucceeded": (
        "Thanh toán thành công cho đơn {no}", "Đã nhận thanh toán",
        "Chúng tôi đã nhận thanh toán <b>{total}</b> cho đơn <b>{no}</b>. Đơn đang được chuẩn bị.",
        "Đã thanh toán đơn {no}."),
    "OrderStatusChanged": (
        "Đơn {no}: {status}", "Cập nhật đơn hàng",
        "Đơn <b>{no}</b> đã chuyển sang trạng thái <b>{status}</b>.", "Đơn {no}: {status}."),
    "": ("Cập nhật đơn {no}", "Cập nhật đơn hàng", "Đơn <b>{no}</b> có cập nhật mới.", "Đơn {no} có cập nhật."),
}
PAGE = ('<div style="font-family:Arial,sans-serif;max-width:560px;margin:auto;color:#1f2937">\n'
        '  <h2 style="color:#2563eb">{heading}</h2>\n'
        '  <p style="font-size:15px;line-height:1.6">{body}</p>\n'
        '  <hr style="border:none;border-top:1px solid #e5e7eb;margin:24px 0"/>\n'
        '  <p style="font-size:12px;color:#9ca3af">{brand} — email tự động, vui lòng không trả lời.</p>\n'
        '</div>')


def pending(outbox: DataFrame, max_attempts: int = S.OUTBOX_MAX_ATTEMPTS) -> DataFrame:
    return outbox.where(F.col("ProcessedAt").isNull() & (F.col("Attempts") < max_attempts))


def next_batch(outbox: DataFrame, size: int = S.OUTBOX_BATCH, max_attempts: int = S.OUTBOX_MAX_ATTEMPTS) -> DataFrame:
    """The oldest messages still to send."""
    return pending(outbox, max_attempts).orderBy("OutboxId").limit(size)


def _filled(event: Column, part: int, brand: str) -> Column:
    """The text of the event type with its placeholders replaced by columns."""
    def fill(kind: str) -> Column:
        _, heading, body, _ = TEXTS[kind]
        template = (PAGE.replace("{heading}", heading).replace("{body}", body).replace("{brand}", brand)
                    if part == 2 else TEXTS[kind][part])
        text = F.lit(template)
        for mark, column in (("{no}", "OrderNumber"), ("{total}", "_total"), ("{status}", "_status")):
            if mark in template:
                text = F.replace(text, F.lit(mark), F.col(column))
        return text

    chain = F
    for kind in TEXTS:
        if kind:
            chain = chain.when(event == kind, fill(kind))
    return chain.otherwise(fill(""))


def render(messages: DataFrame, orders: DataFrame, customers: DataFrame, brand: str = "Shop") -> DataFrame:
    """Subject, HTML and in-app text per message.

    Channel: ``drop`` when the order is gone, ``in-app`` when the customer has no address, else ``email``.
    """
    known = (orders.select("OrderId", "OrderNumber", "CustomerId", "Status", "PaymentStatus", "TotalAmount")
             .join(customers.select("CustomerId", "Email"), "CustomerId", "left"))
    rows = (messages.select("OutboxId", "OrderId", "EventType").join(known, "OrderId", "left")
            .withColumn("_total", vnd_label(F.col("TotalAmount")))
            .withColumn("_status", label(F.col("Status"), STATUS_LABELS)))
    here = F.col("OrderNumber").isNotNull()
    event = F.col("EventType")
    channel = (F.when(~here, F.lit("drop")).when(F.coalesce("Email", F.lit("")) == "", F.lit("in-app"))
               .otherwise(F.lit("email")))
    return rows.select("OutboxId", "OrderId", channel.alias("Channel"), F.when(here, F.col("Email")).alias("ToEmail"),
                       F.when(here, _filled(event, 0, brand)).alias("Subject"),
                       F.when(here, _filled(event, 2, brand)).alias("Html"),
                       F.when(here, _filled(event, 3, brand)).alias("InApp"))


def mark(messages: DataFrame, orders: DataFrame, deliveries: DataFrame, as_of: datetime,
         error: str = "delivery failed") -> DataFrame:
    """Outbox rows after a dispatch round.

    ``deliveries`` says per message how many tries fail before one succeeds; ``Tried``, if the messages carry it,
    counts the tries so far.  A message whose order is gone is done without a try.
    """
    tried = F.col("Tried") if "Tried" in messages.columns else F.lit(0)
    here = orders.select("OrderId", F.lit(True).alias("_here"))
    rows = messages.join(here, "OrderId", "left").join(deliveries.select("OutboxId", "Failures"), "OutboxId", "left")
    fails = F.coalesce("_here", F.lit(False)) & (F.coalesce("Failures", F.lit(0)) > tried)
    counter = [(tried + 1).alias("Tried")] if "Tried" in messages.columns else []
    return rows.select(
        "OutboxId", "OrderId", "EventType", "Payload",
        F.when(~fails, ts(as_of)).alias("ProcessedAt"),
        (F.col("Attempts") + F.when(fails, 1).otherwise(0)).cast("int").alias("Attempts"),
        F.when(fails, F.lit(error)).otherwise(F.col("LastError")).alias("LastError"), *counter)
