"""Customer-manager achievement: delivered, received and service-charge figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.functions import predicates as P
from gearledger.functions.calendar import DateLike, between_days, day
from gearledger.functions.money import SERVICE_TAX, cents, cents_if, ex_tax, zero_if_null
from gearledger.operators.lookups import join_folded
from gearledger.operators.netting import event_rows, full_outer_merge, open_key_side

GRAIN = ["province", "city", "manager_id", "manager_name"]
KEYS = ["stat_date", *GRAIN]


def valid_cities(city_map: DataFrame) -> DataFrame:
    """Active city mappings, one per city."""
    return (
        city_map.where(F.col("status") == P.YES)
        .groupBy(F.col("city_code").alias("city")).agg(F.min("business_city_code").alias("business_city_code"))
    )


def on_business_city(rows: DataFrame, city_map: DataFrame, keep_unmapped: bool = False) -> DataFrame:
    """Replace the city by the reporting city it is mapped to."""
    joined = join_folded(rows, valid_cities(city_map), ["city"], "left" if keep_unmapped else "inner")
    city = F.coalesce("business_city_code", "city") if keep_unmapped else F.col("business_city_code")
    return joined.withColumn("city", city).drop("business_city_code")


def _measures(prefix: str, amount_cents: str) -> list[Column]:
    x = F.col(amount_cents)
    return [
        cents_if(F.lit(True), x).alias(f"{prefix}_b2b"),
        cents_if(P.picc() & P.selfop(), x).alias(f"{prefix}_picc_selfop"),
        cents_if(P.picc() & P.brokered(), x).alias(f"{prefix}_picc_married"),
        cents_if(P.non_picc() & P.selfop(), x).alias(f"{prefix}_nonpicc_selfop"),
        cents_if(P.non_picc() & P.brokered(), x).alias(f"{prefix}_nonpicc_married"),
    ]


def manager_delivery_net(
    orders: DataFrame, city_map: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
    refund_state_start: DateLike = P.REFUND_STATE_START,
) -> DataFrame:
    """Delivered minus validly refunded per day and manager, on the reporting city."""
    rows = event_rows(
        orders.where(P.is_b2b()), {"delivered": "deliver_date", "refunded": "refund_date"}, start, end)
    forward = F.col("basis") == "delivered"
    rows = on_business_city(rows.where(forward | P.refund_is_valid(refund_state_start)), city_map)
    amount = F.when(forward, F.col("order_amount")).otherwise(-F.col("refund_amount"))
    rows = rows.withColumn("cents", cents(amount))
    side = open_key_side(GRAIN, F.col("basis")).alias("side")
    return rows.groupBy(*KEYS, side).agg(*_measures("delivered", "cents")).drop("side")


def manager_actual_receipts(
    track: DataFrame, orders: DataFrame, city_map: DataFrame,
    start: DateLike | None = None, end: DateLike | None = None, mapped_city: bool = True,
) -> DataFrame:
    """Cash received per day and manager. Receipts are summed per order before the join.

    ``mapped_city=False`` reports the order's own city instead of its reporting city.
    """
    received = track.withColumn("stat_date", P.receipt_date()).where(
        F.col("stat_date").isNotNull() & between_days(F.col("stat_date"), start, end))
    receipts = (
        join_folded(received, valid_cities(city_map), ["city"], "left_semi")
        .groupBy("order_id", "stat_date").agg(F.sum(cents("amount")).alias("cents"))
    )
    rows = orders.where(P.is_b2b()).join(receipts, "order_id")
    if mapped_city:
        rows = on_business_city(rows, city_map)
    return rows.groupBy(*KEYS).agg(*_measures("actual", "cents"))


def service_charge_by_manager(
    settlement: DataFrame, orders: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
    excluded_supplier: int = P.EXCLUDED_SUPPLIER, bonus_start: DateLike = P.SERVICE_BONUS_START,
    city_map: DataFrame | None = None,
) -> DataFrame:
    """Brokerage service charge, and the part of it that earns a bonus, without tax.

    A charge belongs to the day it falls on. Settlement rows are summed per order before the
    join. With ``city_map`` the reporting city is used where one exists.
    """
    charged = F.col("service_charge_date")
    before_bonus = F.col("order_receive_time") < day(bonus_start)
    per_order = (
        settlement.where(
            charged.isNotNull() & P.id_is_not("supplier_id", excluded_supplier)
            & between_days(charged, start, end))
        .withColumn("stat_date", F.to_date(charged))
        .groupBy("order_id", "stat_date")
        .agg(
            F.sum("service_charge_amount").alias("charge"),
            F.sum(F.when(before_bonus, F.lit(0)).otherwise(F.col("service_charge_amount"))).alias("bonus"),
        )
    )
    rows = orders.join(per_order, "order_id")
    if city_map is not None:
        rows = on_business_city(rows, city_map, keep_unmapped=True)
    exact = "decimal(28,4)"
    return rows.groupBy(*KEYS).agg(
        ex_tax(zero_if_null(F.sum("charge"), exact), SERVICE_TAX).alias("service_charge"),
        ex_tax(zero_if_null(F.sum("bonus"), exact), SERVICE_TAX).alias("bonus_service_charge"),
    )


def manager_scorecard(
    orders: DataFrame, track: DataFrame, settlement: DataFrame, city_map: DataFrame,
    start: DateLike | None = None, end: DateLike | None = None,
    refund_state_start: DateLike = P.REFUND_STATE_START,
    excluded_supplier: int = P.EXCLUDED_SUPPLIER, bonus_start: DateLike = P.SERVICE_BONUS_START,
) -> DataFrame:
    """The three manager figures merged on one key, each filling its own columns."""
    return full_outer_merge([
        manager_delivery_net(orders, city_map, start, end, refund_state_start),
        manager_actual_receipts(track, orders, city_map, start, end),
        service_charge_by_manager(settlement, orders, start, end, excluded_supplier, bonus_start, city_map),
    ], KEYS)


def as_manager_stats(scorecard: DataFrame) -> DataFrame:
    """Scorecard columns under the names the bonus steps read."""
    return scorecard.select(
        F.col("stat_date").alias("dt"), "province", "manager_id",
        F.col("delivered_picc_selfop").alias("picc_selfop_order"),
        F.col("delivered_picc_married").alias("picc_married_order"),
        F.col("actual_picc_selfop").alias("picc_selfop_actual_order"),
        F.col("actual_picc_married").alias("picc_married_actual_order"),
    )
