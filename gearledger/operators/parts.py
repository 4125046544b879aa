"""Part-name aliases, brand lists and product counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearledger.functions import predicates as P
from gearledger.functions.calendar import DateLike, between_days
from gearledger.functions.text import clean_part_number, drop_last_char, quality_group
from gearledger.operators.merge import insert_if_absent, update_columns
from gearledger.operators.skew import salted_count

BASE_PART_KEYS = ["data_source", "part_id", "standard_part_name"]
PRODUCT_KEYS = ["provinceCode", "originSource", "carTypeBrandName", "qualityType"]


def inquiry_alias_parts(
    damage: DataFrame, damage_parts: DataFrame, products: DataFrame,
    start: DateLike | None = None, end: DateLike | None = None,
) -> DataFrame:
    """Inquired parts with the standard name of their cleaned part number.

    The catalogue is reduced to distinct (number, name) pairs before the join, so repeated
    catalogue rows do not multiply the inquiries.
    """
    cases = damage.where(
        F.col("creat_time").isNotNull() & ~F.col("car_no").like(P.TEST_CAR_PREFIX + "%")
        & between_days(F.col("creat_time"), start, end)
    ).select("damage_id", "car_type")
    asked = damage_parts.where(
        ~F.col("part_oe").like(P.UNLISTED_PART_PREFIX + "%") & (F.col("part_oe") != "")
    ).withColumn("temp_oe", clean_part_number(F.col("part_oe"))).where("temp_oe <> ''")  # nothing left to match by
    names = products.where("partsName IS NOT NULL AND partsOe <> ''").select(
        F.col("partsOe").alias("temp_oe"), F.col("partsName").alias("standard_part_name")).distinct()
    return (
        asked.join(cases, "damage_id").join(names, "temp_oe")
        .select("part_id", "standard_part_name", "part_name", "part_oe", "car_type").distinct()
    )


def offer_brands(
    offers: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Distinct offered brands per day and part, as one sorted text.

    Offers are made distinct first, with pre-aggregation, so only the distinct brands of a
    part come together.
    """
    brands = (
        offers.where(
            (F.col("remark") != "") & (F.col("status") == P.YES)
            & between_days(F.col("updateTime"), start, end))
        .select(F.to_date("updateTime").alias("stat_date"), "damagePartId",
                drop_last_char(F.col("remark")).alias("brand"))
        .distinct()
    )
    return brands.groupBy("stat_date", "damagePartId").agg(
        F.array_join(F.array_sort(F.collect_list("brand")), ",").alias("part_brand"))


def offer_brand_list(
    offers: DataFrame, base_parts: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Base parts from inquiries with the brands offered for them."""
    listed = offer_brands(offers, start, end).withColumn("part_id", F.col("damagePartId").cast("string"))
    inquired = base_parts.where(F.col("data_source") == "1").select("id", "part_id")
    return inquired.join(listed, "part_id").select("stat_date", "id", "part_brand")


def goods_daily_upload(
    goods: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Valid goods uploaded within the given days."""
    return goods.where(
        F.col("partsName").isNotNull() & (F.col("status") == P.YES)
        & between_days(F.col("updateTime"), start, end)
    ).select("goodsCode", "partsName", "suppPartsName", "suppPartsOe", "vehicleType", "partsBrandName")


def base_part_table(
    inquired: DataFrame, uploaded: DataFrame, offered: DataFrame, table: DataFrame | None = None
) -> DataFrame:
    """Standing table of base parts: inquired parts (source 1) and uploaded goods (source 2) are added where absent,
    then inquired parts take the brands that were offered for them last.

    ``inquired``, ``uploaded`` and ``offered`` are the results of ``inquiry_alias_parts``, ``goods_daily_upload``
    and ``offer_brands``; ``table`` is the snapshot so far, none at the start.
    """
    inquiries = inquired.select(
        F.col("part_id").cast("string").alias("part_id"), "standard_part_name", "part_name",
        F.col("part_oe").alias("oe"), F.col("car_type").alias("vehicle_type"),
        F.lit(None).cast("string").alias("part_brand"), F.lit("1").alias("data_source"))
    uploads = uploaded.select(
        F.col("goodsCode").alias("part_id"), F.col("partsName").alias("standard_part_name"),
        F.col("suppPartsName").alias("part_name"), F.col("suppPartsOe").alias("oe"),
        F.col("vehicleType").alias("vehicle_type"), F.col("partsBrandName").alias("part_brand"),
        F.lit("2").alias("data_source"))
    start = inquiries.limit(0) if table is None else table
    grown = insert_if_absent(start, inquiries.unionByName(uploads), BASE_PART_KEYS)
    latest = offered.groupBy(F.col("damagePartId").cast("string").alias("part_id")).agg(
        F.max_by("part_brand", "stat_date").alias("part_brand"))
    return update_columns(
        grown, latest, ["part_id"], ["part_brand"], F.col("data_source") == "1", unique=True)


def product_count_salted(goods: DataFrame, salt_by: str = "goodsCode") -> DataFrame:
    """Products per province, source, brand and quality, counted in two salted phases."""
    return salted_count(P.valid_products(goods), PRODUCT_KEYS, [salt_by], "no_products")


def price_by_quality_group(goods: DataFrame) -> DataFrame:
    """Lowest and mean price per brand, quality group, part number and province."""
    rows = P.valid_products(goods).select(
        "carTypeBrandName", quality_group(F.col("qualityType")).alias("qualityType"), "partsOe", "provinceCode",
        F.col("partsPrice").cast("decimal(10,2)").alias("price"))
    return rows.groupBy("carTypeBrandName", "qualityType", "partsOe", "provinceCode").agg(
        F.min("price").alias("min_part_price"),
        (F.sum("price").cast("double") / F.count("price")).alias("average_part_price"))
