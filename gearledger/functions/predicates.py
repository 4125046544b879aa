"""Row predicates. All are native boolean columns, so they reach the scan where they can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.functions.calendar import DateLike, between_days, day

# Flags, operation codes and order states.
YES = "1"
NO = "0"
DIRECT_PAYMENT = "05"
BROKER_TERM_CODES = ("03", "04")
REFUNDED_STATES = ("700", "701")
OPEN_STATES = ("500", "600")
PASSENGER, COMMERCIAL, OTHER_VEHICLE = "1", "0", "9"
OEM_QUALITY, AFTERMARKET_QUALITY = "1", "2"
PRODUCT_SOURCES = ("01", "02", "03")
UNLISTED_PART_PREFIX = "JY"
TEST_CAR_PREFIX = "测"
PROVINCE_LEVEL_CITY = "100000"
LOWEST_CHECKED_PRICE = 5
BROKER_TERM_START = "2020-01-01"
REFUND_STATE_START = "2018-08-01"
SERVICE_BONUS_START = "2019-07-01"
EXCLUDED_SUPPLIER = 7550


def is_b2b() -> Column:
    return F.col("is_b2b") == YES


def picc() -> Column:
    return F.col("is_picc") == YES


def non_picc() -> Column:
    return F.col("is_picc") == NO


def selfop() -> Column:
    return F.col("is_fbj") == YES


def brokered() -> Column:
    return F.col("is_fbj") == NO


def direct() -> Column:
    return F.col("payment_type") == DIRECT_PAYMENT


def receipt_date() -> Column:
    """Later of the operation and the delivery; null when either is missing."""
    both = F.col("operate_date").isNotNull() & F.col("deliver_date").isNotNull()
    return F.when(both, F.greatest("operate_date", "deliver_date"))


def broker_term() -> Column:
    return F.coalesce(F.col("operate_code").isin(*BROKER_TERM_CODES), F.lit(False))


def broker_term_ok(cutoff: DateLike = BROKER_TERM_START, term: Column | None = None) -> Column:
    """Broker receipts on credit terms count only for deliveries from the cutoff on."""
    term = broker_term() if term is None else term
    return F.when(term, F.col("deliver_date") >= day(cutoff)).otherwise(F.lit(True))


def refund_is_valid(state_start: DateLike = REFUND_STATE_START) -> Column:
    """Orders paid from the start date on must also be in a refunded state."""
    refunded = F.coalesce(F.col("order_status").isin(*REFUNDED_STATES), F.lit(False))
    known = F.col("refund_date").isNotNull() & F.col("payment_date").isNotNull()
    return known & ((F.col("payment_date") < day(state_start)) | refunded)


def not_switched_off(c: str = "status") -> Column:
    """Keeps every status but '0', null too."""
    return ~F.col(c).eqNullSafe(NO)


def id_is_not(c: str, value: int) -> Column:
    """Null ids count as 0."""
    return F.coalesce(F.col(c), F.lit(0)) != value


def clean_price_rows(
    rows: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Price rows fit for the price history: complete, with a listed part number, a brand and
    a price above the checked minimum, delivered within the given days."""
    needed = ["temp_oe", "car_brand", "quality_type", "part_oe", "deliver_time", "sale_price"]
    return rows.na.drop(subset=needed).where(
        (F.col("temp_oe") != "")
        & ~F.col("temp_oe").startswith(UNLISTED_PART_PREFIX)
        & (F.col("car_brand") != "")
        & (F.col("sale_price") > LOWEST_CHECKED_PRICE)
        & between_days(F.col("deliver_time"), start, end)
    )


def valid_products(goods: DataFrame) -> DataFrame:
    """Products on sale, from a known source, with a price."""
    return goods.where(
        (F.col("status") == YES)
        & F.col("originSource").isin(*PRODUCT_SOURCES)
        & (F.col("partsPrice") != 0)
    )
