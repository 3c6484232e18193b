"""Gateway callbacks: decoding, signatures and settlement."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel import schemas as S

# ---- fixed values: callback outcomes -------------------------------------------------------------------------------
UNKNOWN_REF = "Unknown payment reference."
ALREADY_PAID = "Already processed."
BAD_SIGNATURE = "Invalid signature."
MISMATCH = "Amount mismatch."
SUCCEEDED = "Payment successful."
FAILED = "Payment failed or cancelled."

# ---- fixed values: parameter names of the two gateways -------------------------------------------------------------
VNPAY_HASH_FIELDS = ("vnp_SecureHash", "vnp_SecureHashType")
MOMO_SIGNED_FIELDS = ("amount", "extraData", "message", "orderId", "orderInfo", "orderType", "partnerCode", "payType",
                      "requestId", "responseTime", "resultCode", "transId")


def canonical_vnpay(params: Column) -> Column:
    """``key=value`` pairs of the signed parameters in key order, URL-encoded and joined by '&'."""
    signed = F.filter(F.map_entries(params), lambda e: F.startswith(e["key"], F.lit("vnp_"))
                      & ~e["key"].isin(*VNPAY_HASH_FIELDS) & (F.coalesce(e["value"], F.lit("")) != ""))
    return F.array_join(F.transform(F.array_sort(signed), lambda e: F.concat(
        _encoded(e["key"]), F.lit("="), _encoded(e["value"]))), "&")


def _encoded(text: Column) -> Column:
    """URL encoding as the gateway signs it: the three signs ``! ( )`` stay as they are."""
    out = F.url_encode(text)
    for code, sign in (("%21", "!"), ("%28", "("), ("%29", ")")):
        out = F.replace(out, F.lit(code), F.lit(sign))
    return out


def _param(params: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(params, F.lit(name)), F.lit(""))


def canonical_momo(params: Column, access_key: str) -> Column:
    """The signed fields in the gateway's fixed order, plain text, missing ones empty."""
    fields = [F.concat(F.lit(f"&{name}="), _param(params, name)) for name in MOMO_SIGNED_FIELDS]
    return F.concat(F.lit(f"accessKey={access_key}"), *fields)


def decode_vnpay(params: Column) -> dict[str, Column]:
    code, state = _param(params, "vnp_ResponseCode"), _param(params, "vnp_TransactionStatus")
    cents = F.coalesce(_param(params, "vnp_Amount").try_cast("bigint"), F.lit(0)).cast("decimal(20,0)")
    return {"Ref": _param(params, "vnp_TxnRef"), "Amount": (cents / 100).cast(S.MONEY), "ResponseCode": code,
            "Accepted": (code == "00") & (state == "00"), "Signature": _param(params, "vnp_SecureHash")}


def decode_momo(params: Column) -> dict[str, Column]:
    code = _param(params, "resultCode")
    amount = F.coalesce(_param(params, "amount").try_cast("bigint"), F.lit(0))
    return {"Ref": _param(params, "orderId"), "Amount": amount.cast(S.MONEY), "ResponseCode": code,
            "Accepted": code == "0", "Signature": _param(params, "signature")}


def hmac_hex(message: Column, secret: str, bits: int) -> Column:
    """HMAC-SHA2 as lower-case hex, written with the built-in hash: H(key^opad + H(key^ipad + message))."""
    block = 64 if bits == 256 else 128
    key = secret.encode()
    if len(key) > block:  # the rule for long secrets: their hash is the key
        key = hashlib.new(f"sha{bits}", key).digest()
    padded = key.ljust(block, b"\0")
    inner, outer = (bytearray(b ^ pad for b in padded) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(F.lit(inner), F.encode(message, "UTF-8")), bits)
    return F.sha2(F.concat(F.lit(outer), F.unhex(digest)), bits)


def signature_valid(message: Column, provided: Column, secret: str, bits: int) -> Column:
    """True for a non-empty signature that matches in any letter case."""
    return (provided != "") & (hmac_hex(message, secret, bits) == F.lower(provided))


def sign(callbacks: DataFrame, vnpay_secret: str, momo_secret: str, momo_access_key: str) -> DataFrame:
    """Adds the signature parameter a gateway would send (test data and replays)."""
    p = F.col("Params")
    vnpay = F.map_concat(p, F.create_map(F.lit("vnp_SecureHash"), hmac_hex(canonical_vnpay(p), vnpay_secret, 512)))
    momo = F.map_concat(p, F.create_map(F.lit("signature"),
                                        hmac_hex(canonical_momo(p, momo_access_key), momo_secret, 256)))
    return callbacks.withColumn("Params", F.when(F.col("Provider") == S.VNPAY, vnpay).otherwise(momo))


def verify(callbacks: DataFrame, vnpay_secret: str, momo_secret: str, momo_access_key: str) -> DataFrame:
    """Raw callbacks (Seq, Provider, Params) to decoded ones; a bad signature is never a success."""
    p, is_vnpay = F.col("Params"), F.col("Provider") == S.VNPAY
    one, two = decode_vnpay(p), decode_momo(p)
    picked = {name: F.when(is_vnpay, one[name]).otherwise(two[name]) for name in one}
    valid = F.when(is_vnpay, signature_valid(canonical_vnpay(p), one["Signature"], vnpay_secret, 512)).otherwise(
        signature_valid(canonical_momo(p, momo_access_key), two["Signature"], momo_secret, 256))
    return callbacks.select("Seq", "Provider", picked["Ref"].alias("Ref"), picked["Amount"].alias("Amount"),
                            picked["ResponseCode"].alias("ResponseCode"), valid.alias("SignatureValid"),
                            (valid & picked["Accepted"]).alias("Success"))


def settle_marks(callbacks: DataFrame, payments: DataFrame) -> DataFrame:
    """Per payment: when it was first paid and when it first failed (sequence numbers, null for never).

    The callbacks of a ref fold to one row per (ref, amount) before they move: a ref that is replayed without end
    costs one row per task.  ``payments`` may carry PaidAt / FailedAt marks of earlier batches.
    """
    valid, success = F.col("SignatureValid"), F.col("Success")
    folded = callbacks.groupBy("Ref", "Amount").agg(
        F.min(F.when(valid & success, F.col("Seq"))).alias("_good"),
        F.min(F.when(valid & ~success, F.col("Seq"))).alias("_bad"))
    due = payments.select("Ref", F.col("Amount").alias("_due"))
    paid = F.when(F.col("Amount") == F.col("_due"), F.col("_good"))
    failed = F.least("_bad", F.when(F.col("Amount") != F.col("_due"), F.col("_good")))
    return (folded.join(due, "Ref").groupBy("Ref")
            .agg(F.min(paid).alias("PaidSeq"), F.min(failed).alias("FailedSeq")))


def settle(callbacks: DataFrame, payments: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Outcome of every callback, as if they were handled one after the other by ``Seq``.

    Only a paid payment ends the story: a mismatch or failure before the first good callback is overwritten by it,
    everything after it is a no-op.  So the first good callback of a ref decides, and no ref has to be walked in
    order.  ``earlier`` holds the marks of callbacks settled before (see ``settle_marks``).
    """
    marks = settle_marks(callbacks, payments)
    if earlier is not None:
        both = marks.unionByName(earlier.select(marks.columns))
        marks = both.groupBy("Ref").agg(F.min("PaidSeq").alias("PaidSeq"), F.min("FailedSeq").alias("FailedSeq"))
    known = payments.select("Ref", "OrderId", "OrderNumber", F.col("Amount").alias("_due"), "Provider", "Status",
                            "OrderStatus").join(marks, "Ref", "left")
    rows = callbacks.drop("Provider").join(known, "Ref", "left")
    seq, paid = F.col("Seq"), F.col("PaidSeq")
    done = (F.col("Status") == S.PAY_PAID) | (seq > paid)
    standing = F.when(F.col("FailedSeq") < seq, F.lit(S.PAY_FAILED)).otherwise(F.col("Status"))
    outcome = (F.when(F.col("OrderId").isNull(), F.lit(UNKNOWN_REF))
               .when(done, F.lit(ALREADY_PAID))
               .when(~F.col("SignatureValid"), F.lit(BAD_SIGNATURE))
               .when(F.col("Success") & (F.col("Amount") != F.col("_due")), F.lit(MISMATCH))
               .when(F.col("Success"), F.lit(SUCCEEDED))
               .otherwise(F.lit(FAILED)))
    rows = rows.withColumn("Outcome", outcome)
    said = F.col("Outcome")
    good = said.isin(ALREADY_PAID, SUCCEEDED)
    status = F.when(good, F.lit(S.PAY_PAID)).when(said == BAD_SIGNATURE, standing).otherwise(F.lit(S.PAY_FAILED))
    won = said == SUCCEEDED
    return rows.select("Seq", "Ref", "OrderId", "OrderNumber", good.alias("Ok"), status.alias("PaymentStatus"),
                       "Outcome", (won & (F.col("OrderStatus") == S.PENDING)).alias("AutoConfirms"),
                       won.alias("Notifies"))


def payment_outcomes(settled: DataFrame, orders: DataFrame) -> DataFrame:
    """Business counters: payments that succeeded or failed, orders created."""
    said = F.col("Outcome")
    rows = [F.struct(F.lit(f"payments {name}").alias("Counter"), F.col(name).alias("Value"))
            for name in ("succeeded", "failed")]
    kinds = (settled.agg(F.count_if(said == SUCCEEDED).alias("succeeded"),
                         F.count_if(said.isin(MISMATCH, FAILED)).alias("failed"))
             .select(F.inline(F.array(*rows))))
    return kinds.unionByName(orders.agg(F.count(F.lit(1)).alias("Value"))
                             .select(F.lit("orders created").alias("Counter"), "Value"))
