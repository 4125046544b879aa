"""Daily scorecards per province and city on three revenue bases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearledger.functions import predicates as P
from gearledger.functions.calendar import DateLike, between_days, day, year_start, yyyymmdd
from gearledger.functions.money import (
    GOODS_TAX, TOTAL, cents, count_sum, ex_tax, from_cents, total, total_if, zero_if_null,
)
from gearledger.functions.text import pid
from gearledger.operators.netting import event_rows, full_outer_merge, open_key_side

KEYS = ["stat_date", "province", "city"]
PLACE = ["province", "city"]
FLAGS = ["is_picc", "is_fbj", "is_direct"]

DELIVERED = {"delivered": "deliver_date", "refunded": "refund_date"}
PAID = {"paid": "payment_date"}


def _channels(prefix: str, amount: Column) -> list[Column]:
    """Amount per customer channel and sales mode."""
    return [
        total_if(P.picc() & P.selfop(), amount).alias(f"{prefix}_picc_selfop"),
        total_if(P.picc() & P.brokered(), amount).alias(f"{prefix}_picc_married"),
        total_if(P.non_picc() & P.selfop(), amount).alias(f"{prefix}_nonpicc_selfop"),
        total_if(P.non_picc() & P.brokered(), amount).alias(f"{prefix}_nonpicc_married"),
    ]


def order_events(
    orders: DataFrame, bases: dict[str, str], start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """One row per dated event of the orders that count, with the order's columns, ``basis`` and ``stat_date``."""
    return event_rows(orders.where(P.is_b2b()).withColumn("is_direct", P.direct()), bases, start, end)


def _event_sums(rows: DataFrame, flags: list[str], sums: dict[str, Column]) -> DataFrame:
    """Order count ``n`` and plain sums per day, place, event kind and flag values.

    This is the only step that touches every event. The many conditional figures of a
    scorecard are taken afterwards from its few rows per place.
    """
    return rows.groupBy(*KEYS, "basis", *flags).agg(
        F.count("id").alias("n"), *[from_cents(F.sum(cents(c))).alias(name) for name, c in sums.items()])


def _signed(forward: str, refunded: str) -> Column:
    return F.when(F.col("basis") == "refunded", -F.col(refunded)).otherwise(F.col(forward))


def _by_place(sums: DataFrame, measures: list[Column]) -> DataFrame:
    side = open_key_side(PLACE, F.col("basis")).alias("side")
    return sums.groupBy(*KEYS, side).agg(*measures).drop("side")


def _order_sums(events: DataFrame) -> DataFrame:
    return _event_sums(events, FLAGS, {
        "amount": _signed("order_amount", "refund_amount"),
        "purchase": _signed("purchase_amount", "refund_purchase_amount"),
    })


def _delivery_measures() -> list[Column]:
    forward, back, paid = (F.col("basis") == b for b in ("delivered", "refunded", "paid"))
    amount = F.when(~paid, F.col("amount"))
    income = ex_tax(total_if(forward & P.selfop(), "amount"), GOODS_TAX)
    returned = ex_tax(-total_if(back & P.selfop(), "amount"), GOODS_TAX)
    return [
        count_sum(forward).alias("no_b2b_order"),
        count_sum(forward & P.picc()).alias("no_picc_order"),
        total(amount).alias("amount_b2b"),
        total_if(~paid, "purchase").alias("amount_purchase"),
        total_if(P.picc(), amount).alias("amount_picc"),
        *_channels("amount", amount),
        total_if(P.picc() & F.col("is_direct"), amount).alias("amount_picc_direct"),
        (income - returned).cast("decimal(18,2)").alias("amount_income"),
    ]


def _paid_measures() -> list[Column]:
    paid = F.col("basis") == "paid"
    return [
        count_sum(paid).alias("no_paid_order"),
        total_if(paid, "amount").alias("amount_paid"),
        total_if(paid & P.picc(), "amount").alias("amount_paid_picc"),
    ]


def daily_delivery_net(
    orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Delivered minus refunded per day, province and city."""
    return _by_place(_order_sums(order_events(orders, DELIVERED, start, end)), _delivery_measures())


def daily_paid(orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    return _by_place(_order_sums(order_events(orders, PAID, start, end)), _paid_measures())


def received_orders(
    track: DataFrame, orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
    cutoff: DateLike = P.BROKER_TERM_START,
) -> DataFrame:
    """Receipts of an order and day, one row for each order row: their number, their amount in cents, and the order.

    Receipts are folded to one row per order and day before they meet the orders, so an order with
    very many receipts is one row in the join. Receipts on credit terms are summed apart until the order's
    delivery day is known.
    """
    term = P.broker_term()
    received = (
        track.withColumn("stat_date", P.receipt_date())
        .where(F.col("stat_date").isNotNull() & between_days(F.col("stat_date"), start, end))
        .groupBy("iorder_id", "stat_date")
        .agg(
            F.count(F.when(~term, 1)).alias("plain_n"), F.count(F.when(term, 1)).alias("term_n"),
            F.sum(F.when(~term, cents("amount"))).alias("plain_cents"),
            F.sum(F.when(term, cents("amount"))).alias("term_cents"))
    )
    term_counts = F.coalesce(P.broker_term_ok(cutoff, F.lit(True)), F.lit(False))

    def counted(name: str) -> Column:
        plain, on_term = (F.coalesce(f"{kind}_{name}", F.lit(0)) for kind in ("plain", "term"))
        return plain + F.when(term_counts, on_term).otherwise(0)

    return (
        received.join(orders.where(P.is_b2b()), F.col("iorder_id") == F.col("order_id"))
        .withColumns({"receipts": counted("n"), "amount": counted("cents"), "is_direct": P.direct()})
        .where(F.col("receipts") > 0)
    )


def _receipt_figures(rows: DataFrame) -> DataFrame:
    """Figures per day and place; the sums per order and the distinct count of orders share one partitioning."""
    sums = rows.groupBy("iorder_id", *KEYS, *FLAGS, "vehicle_type").agg(
        F.sum("receipts").alias("n"),
        from_cents(F.sum("amount")).alias("amount"),
        from_cents(F.sum(cents("purchase_amount") * F.col("receipts"))).alias("purchase"))
    amount = F.col("amount")
    return sums.groupBy(*KEYS).agg(
        F.count_distinct("iorder_id").alias("no_actual_order"),
        total(amount).alias("actual_b2b"),
        total("purchase").alias("actual_purchase"),
        count_sum(P.picc()).alias("no_actual_picc_order"),
        total_if(P.picc(), amount).alias("actual_picc"),
        *_channels("actual", amount),
        total_if(F.col("vehicle_type") == P.PASSENGER, amount).alias("actual_passenger"),
        total_if(F.col("vehicle_type") == P.COMMERCIAL, amount).alias("actual_commercial"),
        total_if(P.picc() & F.col("is_direct"), amount).alias("actual_picc_direct"),
        ex_tax(total_if(P.selfop(), amount), GOODS_TAX).alias("actual_income"),
    )


def daily_actual_receipts(
    track: DataFrame, orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
    cutoff: DateLike = P.BROKER_TERM_START,
) -> DataFrame:
    """Cash received per day, province and city; order rows may share an ``order_id``."""
    return _receipt_figures(received_orders(track, orders, start, end, cutoff))


def with_report_keys(rows: DataFrame) -> DataFrame:
    """Report id and month text of a daily (province, city) row."""
    return rows.withColumns({
        "pid": pid(F.col("province"), F.col("city"), yyyymmdd(F.col("stat_date"))),
        "yr_mth": F.date_format("stat_date", "yyyyMM"),
    })


def daily_scorecard(
    orders: DataFrame, track: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
    cutoff: DateLike = P.BROKER_TERM_START,
) -> DataFrame:
    """Delivered, received and paid figures side by side; the order table is read once for the
    delivered and paid bases together."""
    events = order_events(orders, {**DELIVERED, **PAID}, start, end)
    return scorecard_of_events(events, received_orders(track, orders, start, end, cutoff))


def scorecard_of_events(events: DataFrame, receipts: DataFrame) -> DataFrame:
    """The daily scorecard of dated order events and received orders, wherever they come from."""
    dated = _by_place(_order_sums(events), [*_delivery_measures(), *_paid_measures()])
    return with_report_keys(full_outer_merge([dated, _receipt_figures(receipts)], KEYS))


def vehicle_part_mix_net(
    orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Original and aftermarket parts by vehicle kind, net of refunds."""
    return vehicle_mix_of_events(order_events(orders, DELIVERED, start, end))


def vehicle_mix_of_events(events: DataFrame) -> DataFrame:
    """As ``vehicle_part_mix_net``, from dated delivery and refund events."""
    amount, oem = _signed("order_amount", "refund_amount"), _signed("oem_amount", "refund_oem_amount")
    sums = _event_sums(events, ["vehicle_type"], {"amount": amount, "oem": oem, "afm": amount - oem})
    forward = F.col("basis") == "delivered"
    kind = F.col("vehicle_type")

    def gap(side: Column) -> Column:
        return zero_if_null(F.sum(F.when(side, F.col("amount"))) - F.sum(F.when(side, F.col("oem"))))

    return _by_place(sums, [
        total("oem").alias("amount_oem"),
        (gap(forward) + gap(~forward)).cast(TOTAL).alias("amount_afm"),
        total_if(kind == P.PASSENGER, "amount").alias("amount_passenger"),
        total_if(kind == P.COMMERCIAL, "amount").alias("amount_commercial"),
        total_if(kind == P.OTHER_VEHICLE, "amount").alias("amount_other"),
        total_if(kind == P.PASSENGER, "oem").alias("amount_passenger_oem"),
        total_if(kind == P.COMMERCIAL, "oem").alias("amount_commercial_oem"),
        total_if(kind == P.PASSENGER, "afm").alias("amount_passenger_afm"),
        total_if(kind == P.COMMERCIAL, "afm").alias("amount_commercial_afm"),
    ])


def paid_not_delivered(
    orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Open paid amounts from the start of the year up to each day.

    Orders are summed per payment day first. The running sum then walks at most one year of
    days per place, and each sum is repeated until the day before the next payment day.
    """
    in_window = F.col("payment_date").isNotNull()
    if start is not None:
        in_window = in_window & (F.col("payment_date") >= year_start(day(start)))
    in_window = in_window & between_days(F.col("payment_date"), None, end)
    open_orders = orders.where(P.is_b2b() & F.col("order_status").isin(*P.OPEN_STATES) & in_window)
    sums = open_orders.groupBy("payment_date", *PLACE, "is_picc", "is_fbj").agg(
        from_cents(F.sum(cents("order_amount"))).alias("amount"))
    amount = F.col("amount")
    names = ["paid_not_delivered", *[c + "_not_delivered" for c in (
        "picc_selfop", "picc_married", "nonpicc_selfop", "nonpicc_married")]]
    daily = sums.groupBy("payment_date", *PLACE).agg(total(amount).alias("open"), *_channels("open", amount))
    parts = ["open", "open_picc_selfop", "open_picc_married", "open_nonpicc_selfop", "open_nonpicc_married"]
    ordered = Window.partitionBy(F.year("payment_date"), *PLACE).orderBy("payment_date")
    to_date = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    year_end = F.date_sub(F.add_months(year_start(F.col("payment_date")), 12), 1)
    last = F.coalesce(F.date_sub(F.lead("payment_date").over(ordered), 1), year_end)
    # Without an end, the last day is that of the last payment: nothing is known of later ones.
    known = daily.agg(F.max("payment_date")).scalar() if end is None else day(end)
    running = daily.select(
        "payment_date", *PLACE, F.least(last, known).alias("last_day"),
        *[F.sum(p).over(to_date).cast(TOTAL).alias(n) for p, n in zip(parts, names)])
    return (
        running.withColumn("stat_date", F.explode(F.sequence("payment_date", "last_day")))
        .where(between_days(F.col("stat_date"), start, end))
        .select(*KEYS, *names)
    )


def vehicle_scorecard(
    orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    mix = vehicle_part_mix_net(orders, start, end)
    open_amounts = paid_not_delivered(orders, start, end)
    return with_report_keys(full_outer_merge([mix, open_amounts], KEYS))


def complementary_scorecard(
    orders: DataFrame, shop_counts: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """The vehicle scorecard with the shop counts of its places in further columns of the same key.

    ``shop_counts`` are those of ``shops.city_shop_counts``. A month's counts stand at ``end`` if that lies in the
    month, which is the day of a daily run, and at the last day of the month otherwise.
    """
    closing = F.last_day(F.make_date("year", "month", F.lit(1)))
    if end is not None:
        closing = F.when(closing == F.last_day(day(end)), day(end)).otherwise(closing)
    counts = shop_counts.withColumn("stat_date", closing).where(between_days(F.col("stat_date"), start, end))
    counts = counts.select(*KEYS, "repeat_purchase_shop_previous", "repeat_purchase_shop")
    return with_report_keys(full_outer_merge(
        [vehicle_part_mix_net(orders, start, end), paid_not_delivered(orders, start, end), counts], KEYS))
