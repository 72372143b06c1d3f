"""Marketplace order analytics, set-wise over the order tables.

The reference prices and admits one order per request.  Here the same
rules run over whole tables: totals (O1), promo evaluation (O2), admission
with the first failing reason (O3), stock demand audit (O4), cancellation
effects (O5), promo usage (O6), active-order conflicts (J6), the one-minute
rate limit (J7), paging (P3), key look-ups (P5), ownership (P7) and the
product change feed (U5).

Money stays DECIMAL; per-key "latest"/"earliest" picks are ``min``/``max``
over structs (partial aggregates), so a hot user or product never has to
sit in one task.  Running values per key use ``keyed_running``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import keyed_running

ACTIVE_ORDER_STATUSES = ["CREATED", "PAYMENT_PENDING"]
CANCELLABLE_STATUSES = ["CREATED", "PAYMENT_PENDING"]
RATE_LIMIT_SECONDS = 60
PERCENT_DISCOUNT_CAP = 0.7
# Fixed reason codes, in the order the checks run.
ADMISSION_REASONS = ["VALIDATION_ERROR", "ORDER_LIMIT_EXCEEDED", "ORDER_HAS_ACTIVE", "PRODUCT_NOT_FOUND",
                     "PRODUCT_INACTIVE", "INSUFFICIENT_STOCK", "PROMO_CODE_INVALID", "PROMO_CODE_MIN_AMOUNT"]


def order_totals(items: DataFrame) -> DataFrame:
    """O1: Σ price_at_order × quantity per order (lines keep their frozen price)."""
    return (items.groupBy("order_id")
            .agg(F.sum(F.col("price_at_order") * F.col("quantity")).cast("decimal(14,2)").alias("total")))


def promo_evaluation(orders: DataFrame, totals: DataFrame, promos: DataFrame) -> DataFrame:
    """O2: (order_id, total, reason, discount, net) for orders with lines.

    A code is invalid when missing, inactive, used up, or the order time is
    outside [valid_from, valid_until]; below min_order_amount it is refused;
    PERCENTAGE = total·v/100, set to 0 when above 70 % of the total; FIXED =
    min(v, total).  Uses count in order time: an order finds the row's
    ``current_uses`` plus the accepted uses of the orders before it."""
    o = orders.select("id", "promo_code", "created_at").join(totals, orders["id"] == totals["order_id"])
    return _apply_promo(o.select("id", "promo_code", "created_at", "total"), promos).select(
        F.col("id").alias("order_id"), "total", "reason", "discount", "net")


def _apply_promo(o: DataFrame, promos: DataFrame, reaches: str | None = None) -> DataFrame:
    """reason, discount and net for rows with id, promo_code, created_at,
    total.  ``reaches`` names a boolean column: only those orders get as far
    as the code and can use it up (all of them without it).

    An order that is otherwise fine is accepted while fewer than
    ``max_uses - current_uses`` such orders of its code came before it, so
    exhaustion is one running count per code."""
    p = promos.select("code", "discount_type", "discount_value", "min_order_amount",
                      "max_uses", "current_uses", "valid_from", "valid_until", "active")
    j = o.where(F.col("promo_code").isNotNull()).join(p, F.col("promo_code") == p["code"], "left")
    total = F.col("total")
    valid = (F.col("code").isNotNull() & F.col("active")
             & F.col("created_at").between(F.col("valid_from"), F.col("valid_until")))
    fine = valid & (total >= F.col("min_order_amount"))
    use = fine & F.col(reaches) if reaches else fine
    j = keyed_running(j, ["promo_code"], ["created_at", "id"], F.when(use, 1).otherwise(0).cast("long"), "sum",
                      "uses_before", inclusive=False)
    spent = F.coalesce(F.col("uses_before"), F.lit(0)) >= F.col("max_uses") - F.col("current_uses")
    reason = (F.when(F.coalesce(valid & ~spent, F.lit(False)),
                     F.when(total < F.col("min_order_amount"), "PROMO_CODE_MIN_AMOUNT"))
              .otherwise("PROMO_CODE_INVALID"))
    pct = total * F.col("discount_value") / 100
    raw = (F.when(F.col("discount_type") == "PERCENTAGE",
                  F.when(pct > total * PERCENT_DISCOUNT_CAP, F.lit(0)).otherwise(pct))
           .otherwise(F.least(F.col("discount_value"), total)))
    j = j.withColumn("reason", reason).withColumn("discount", F.when(F.col("reason").isNull(), raw).otherwise(F.lit(0)))
    plain = o.where(F.col("promo_code").isNull()).select(*o.columns, F.lit(None).cast("string").alias("reason"),
                                                         F.lit(0).cast(j.schema["discount"].dataType).alias("discount"))
    return (j.select(*o.columns, "reason", "discount").unionByName(plain)
            .withColumn("net", total - F.col("discount")))


def active_order_conflicts(orders: DataFrame) -> DataFrame:
    """Users holding more than one active order."""
    return (orders.where(F.col("status").isin(ACTIVE_ORDER_STATUSES)).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def rate_limit_hits(ops: DataFrame, seconds: int = RATE_LIMIT_SECONDS, chunks: int | None = None) -> DataFrame:
    """CREATE_ORDER operations preceded by another one of the same user
    at most ``seconds`` earlier; ``prev_at`` is that previous operation.
    The previous time is a running max over earlier rows, which stays
    parallel for a hot user."""
    c = ops.where(F.col("operation_type") == "CREATE_ORDER").select("user_id", "op_id", "created_at")
    prev = keyed_running(c, ["user_id"], ["created_at", "op_id"], "created_at", "max", "prev_at",
                         inclusive=False, chunks=chunks)
    return (prev.where(F.col("prev_at") >= F.col("created_at") - F.make_dt_interval(secs=F.lit(seconds)))
            .select("user_id", "op_id", "prev_at"))


def order_admission(orders: DataFrame, items: DataFrame, products: DataFrame, promos: DataFrame,
                    ops: DataFrame, seconds: int = RATE_LIMIT_SECONDS) -> DataFrame:
    """O3: first failing reason per order (null = admitted), checks in the
    reference's order.  A line sees the stock that earlier lines of its order
    left of the product.  Set-wise re-aim: the rate limit looks for an earlier
    CREATE_ORDER operation of the user within ``seconds`` before the order;
    an active order counts when the user's earliest active order precedes
    this one; items are checked against the product snapshot, the first
    failing line (by line_no) gives the item reason."""
    o = orders.select("id", "user_id", "status", "promo_code", "created_at")
    # rate limit: the latest CREATE_ORDER operation strictly before the
    # order, as a running max over the user's merged timeline (orders sort
    # before operations at the same instant, so those do not count)
    timeline = (o.select("user_id", F.col("created_at").alias("t"), F.lit(0).alias("kind"),
                         F.col("id").cast("long").alias("ref"))
                .unionByName(ops.where(F.col("operation_type") == "CREATE_ORDER").select(
                    "user_id", F.col("created_at").alias("t"), F.lit(1).alias("kind"),
                    F.col("op_id").cast("long").alias("ref"))))
    last_op = keyed_running(timeline, ["user_id"], ["t", "kind", "ref"], F.when(F.col("kind") == 1, F.col("t")),
                            "max", "last_op_at", inclusive=False)
    limited = (last_op.where((F.col("kind") == 0)
                             & (F.col("last_op_at") >= F.col("t") - F.make_dt_interval(secs=F.lit(seconds))))
               .select(F.col("ref").alias("lim_id")))
    # active order: the user's earliest active order is before this one
    first_active = (o.where(F.col("status").isin(ACTIVE_ORDER_STATUSES)).groupBy("user_id")
                    .agg(F.min(F.struct("created_at", "id")).alias("first_active")))
    # per item
    p = products.select(F.col("id").alias("pid"), F.col("status").alias("p_status"), F.col("stock"))
    li = items.join(p, items["product_id"] == p["pid"], "left")
    # dealt by order once: the window per (order, product) and the aggregate per order both fit
    li = li.repartition("order_id")
    taken = F.sum("quantity").over(Window.partitionBy("order_id", "product_id")
                                   .orderBy("line_no", "quantity", "price_at_order").rowsBetween(Window.unboundedPreceding, 0))
    item_reason = (F.when(F.col("pid").isNull(), "PRODUCT_NOT_FOUND")
                   .when(F.col("p_status") != "ACTIVE", "PRODUCT_INACTIVE")
                   .when(F.col("stock") < F.col("taken"), "INSUFFICIENT_STOCK"))
    # one pass over the lines: first failing line, line count and total
    per_order = (li.withColumn("taken", taken).withColumn("r", item_reason).groupBy("order_id")
                 .agg(F.min(F.when(F.col("r").isNotNull(), F.struct("line_no", "r"))).alias("first_bad"),
                      F.count(F.lit(1)).alias("lines"),
                      F.sum(F.col("price_at_order") * F.col("quantity")).cast("decimal(14,2)").alias("total")))
    j = (o.join(limited, o["id"] == limited["lim_id"], "left")
         .join(first_active, "user_id", "left")
         .join(per_order, o["id"] == per_order["order_id"], "left"))
    here = F.struct("created_at", "id")
    earlier = (F.when(F.col("lines").isNull(), "VALIDATION_ERROR")
               .when(F.col("lim_id").isNotNull(), "ORDER_LIMIT_EXCEEDED")
               .when(F.col("first_active").isNotNull() & (F.col("first_active") < here), "ORDER_HAS_ACTIVE")
               .when(F.col("first_bad").isNotNull(), F.col("first_bad.r")))
    j = (j.withColumn("earlier", earlier).withColumn("reaches", F.col("earlier").isNull())
         .select("id", "promo_code", "created_at", "total", "earlier", "reaches"))
    reason = F.coalesce("earlier", "reason")
    j = _apply_promo(j, promos, "reaches")
    return j.select(F.col("id").alias("order_id"), reason.alias("reason"))


def stock_oversell(items: DataFrame, orders: DataFrame, products: DataFrame,
                   chunks: int | None = None) -> DataFrame:
    """Running demand per product in order time vs stock.  ``oversold``
    marks every line past the stock, ``first_oversell`` the line that
    crosses it."""
    o = orders.select(F.col("id").alias("oid"), "created_at")
    li = items.join(o, items["order_id"] == o["oid"]).select(
        "product_id", "order_id", "line_no", "quantity", "price_at_order", "created_at")
    run = keyed_running(li, ["product_id"], ["created_at", "order_id", "line_no", "quantity", "price_at_order"],
                        "quantity", "sum", "demand", inclusive=True, chunks=chunks)
    p = products.select(F.col("id").alias("product_id"), "stock")
    j = run.join(p, "product_id")
    return j.select("product_id", "order_id", "line_no", F.col("demand").cast("long").alias("demand"),
                    F.col("stock").cast("long").alias("stock"),
                    (F.col("demand") > F.col("stock")).alias("oversold"),
                    ((F.col("demand") > F.col("stock"))
                     & (F.col("demand") - F.col("quantity") <= F.col("stock"))).alias("first_oversell"))


def ownership(orders: DataFrame, requests: DataFrame, callers: DataFrame) -> DataFrame:
    """Each request on an order with ``allowed`` = caller is ADMIN or owner."""
    o = orders.select(F.col("id").alias("order_id"), F.col("user_id").alias("owner"))
    c = callers.select(F.col("user_id").alias("caller_id"), "role")
    j = requests.join(o, "order_id").join(c, "caller_id", "left")
    allowed = (F.col("role") == "ADMIN") | (F.col("caller_id") == F.col("owner"))
    return j.select(F.col("order_id").alias("id"), F.col("caller_id").alias("caller"),
                    F.coalesce(allowed, F.lit(False)).alias("allowed"))


def cancel_effects(orders: DataFrame, items: DataFrame, promos: DataFrame, requests: DataFrame,
                   callers: DataFrame) -> DataFrame:
    """Effects of the legal cancellations (owner or admin, status
    CREATED/PAYMENT_PENDING): stock returned per product, promo uses -1 per
    code; one (kind, key, delta) row each."""
    allowed = ownership(orders, requests, callers).where("allowed").select(F.col("id").alias("order_id")).distinct()
    legal = (orders.where(F.col("status").isin(CANCELLABLE_STATUSES))
             .join(allowed, orders["id"] == allowed["order_id"], "left_semi"))
    stock = (items.join(legal.select(F.col("id").alias("order_id")), "order_id")
             .groupBy("product_id").agg(F.sum("quantity").cast("long").alias("delta"))
             .select(F.lit("product").alias("kind"), F.col("product_id").cast("string").alias("key"), "delta"))
    p = promos.select(F.col("code").alias("promo_code"))
    promo = (legal.join(p, "promo_code").groupBy("promo_code").agg((-F.count(F.lit(1))).cast("long").alias("delta"))
             .select(F.lit("promo").alias("kind"), F.col("promo_code").alias("key"), "delta"))
    return stock.unionByName(promo)


def promo_usage(orders: DataFrame, items: DataFrame, promos: DataFrame) -> DataFrame:
    """Uses per code (orders whose code was applied) against max_uses."""
    applied = (promo_evaluation(orders, order_totals(items), promos).where(F.col("reason").isNull())
               .join(orders.select(F.col("id").alias("order_id"), "promo_code"), "order_id")
               .where(F.col("promo_code").isNotNull())
               .groupBy("promo_code").agg(F.count(F.lit(1)).alias("uses")))
    j = promos.join(applied, promos["code"] == applied["promo_code"], "left")
    uses = F.col("current_uses") + F.coalesce(F.col("uses"), F.lit(0))
    return j.select("code", uses.cast("long").alias("uses"), F.col("max_uses").cast("long").alias("max_uses"),
                    (uses >= F.col("max_uses")).alias("exhausted"))


def product_page(products: DataFrame, status: str | None = None, category: str | None = None,
                 page: int = 0, size: int = 20) -> DataFrame:
    """One page of the filtered listing ordered by id, with the filtered
    total on every row (a scalar subquery: one partial count per task)."""
    f = products
    if status is not None:
        f = f.where(F.col("status") == status)
    if category is not None:
        f = f.where(F.col("category") == category)
    total = f.agg(F.count(F.lit(1))).scalar()
    return (f.select("id", "name", "price", "stock", "category", "status")
            .orderBy("id").offset(page * size).limit(size)
            .withColumn("total_elements", total))


def lookup_missing_keys(lookups: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """P5: requested keys with no row in their table, per look-up name.
    Each entry is (name, requests, key column, table, table key column)."""
    out = None
    for name, req, col, table, tcol in lookups:
        keys = req.select(F.col(col).alias("key")).where(F.col("key").isNotNull()).distinct()
        miss = keys.join(table.select(F.col(tcol).alias("key")), "key", "left_anti").select(
            F.lit(name).alias("lookup"), F.col("key").cast("string").alias("key"))
        out = miss if out is None else out.unionByName(miss)
    return out


def apply_product_changes(products: DataFrame, changes: DataFrame) -> DataFrame:
    """Every UPDATE replaces name, description, price, stock, category and
    status; a DELETE only archives.  So the fields come from the latest UPDATE
    and the status from the latest change of any kind (ties broken by the
    change's source columns), both picked in one aggregate; updated_at is the
    latest change's time, null without one."""
    fields = ["name", "description", "price", "stock", "category"]
    tie = [c for c in changes.columns if c not in ("id", "changed_at", "op")]
    change = F.struct("changed_at", *tie, "op")
    latest = changes.groupBy("id").agg(F.max(change).alias("last"),
                                       F.max(F.when(F.col("op") == "UPDATE", change)).alias("upd"))
    j = products.join(latest, "id", "left")
    new = [F.when(F.col("upd").isNotNull(), F.col(f"upd.{c}")).otherwise(F.col(c)).cast(products.schema[c].dataType).alias(c)
           for c in fields]
    status = (F.when(F.col("last.op") == "DELETE", "ARCHIVED").when(F.col("last.op") == "UPDATE", F.col("last.status"))
              .otherwise(F.col("status")).alias("status"))
    return j.select("id", *new, status, F.col("last.changed_at").alias("updated_at"))
