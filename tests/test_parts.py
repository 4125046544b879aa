from gearledger.operators import parts
from tests.conftest import day, rows_of


def test_inquiry_alias(table):
    damage = table("damage_id long, car_type string, car_no string, creat_time timestamp", [
        (1, "T1", "A1", "2020-03-01 23:59:59.9"), (2, "T2", "测A2", "2020-03-01 10:00:00"),
        (3, "T3", None, "2020-03-01 10:00:00"), (4, "T4", "A4", None), (5, "T5", "A5", "2020-03-02 00:00:00")])
    asked = table("damage_id long, part_id long, part_name string, part_oe string", [
        (1, 10, "n", "a-1"), (1, 11, "n", "JY1"), (1, 12, "n", ""), (1, 13, "n", None), (1, 14, "n", "zz"),
        (1, 15, "n", "-"),
        (2, 20, "n", "a1"), (3, 30, "n", "a1"), (4, 40, "n", "a1"), (5, 50, "n", "a.1")])
    products = table("partsOe string, partsName string", [("a1", "Door"), ("a1", "Door"), ("a1", "Left door"), ("a1", None), ("", "None"), ("", "Nothing")])
    got = parts.inquiry_alias_parts(damage, asked, products, "2020-03-01", "2020-03-01")
    assert rows_of(got) == [(10, "Door", "n", "a-1", "T1"), (10, "Left door", "n", "a-1", "T1")]
    assert parts.inquiry_alias_parts(damage, asked, products).count() == 4


def test_offer_brands(table):
    offers = table("damagePartId long, remark string, updateTime timestamp, status string", [
        (1, "b,", "2020-03-01 01:00:00", "1"), (1, "a,", "2020-03-01 02:00:00", "1"), (1, "b,", "2020-03-01 03:00:00", "1"),
        (1, "", "2020-03-01 03:00:00", "1"), (1, None, "2020-03-01 03:00:00", "1"), (1, "c,", "2020-03-01 03:00:00", "0"),
        (2, "x", "2020-03-01 03:00:00", "1"), (1, "d,", "2020-03-02 00:00:00", "1"), (3, "e,", "2020-03-01 00:00:00", "1")])
    base = table("id long, part_id string, data_source string", [(100, "1", "1"), (200, "2", "1"), (300, "3", "2")])
    got = parts.offer_brand_list(offers, base)
    assert rows_of(got) == [(day("2020-03-01"), 100, "a,b"), (day("2020-03-01"), 200, ""), (day("2020-03-02"), 100, "d")]
    assert parts.offer_brand_list(offers, base, "2020-03-01", "2020-03-01").count() == 2


GOODS = """goodsCode string, partsName string, suppPartsName string, suppPartsOe string, partsOe string, vehicleType string,
  partsBrandName string, carTypeBrandName string, updateTime timestamp, status string, originSource string,
  partsPrice decimal(11,2), qualityType string, provinceCode string"""


def goods_row(code, name="n", time="2020-03-01 10:00:00", status="1", source="01", price=10, quality="原厂件", province="44", brand="B"):
    return (code, name, "s", "o", "oe", "v", "pb", brand, time, status, source, price, quality, province)


def test_goods_uploads(table):
    goods = table(GOODS, [
        goods_row("a"), goods_row("b", name=None), goods_row("c", status="0"), goods_row("d", time="2020-03-02 00:00:00"),
        goods_row("e", time="2020-03-01 23:59:59.9")])
    assert rows_of(parts.goods_daily_upload(goods, "2020-03-01", "2020-03-01"), "goodsCode") == [("a",), ("e",)]
    assert parts.goods_daily_upload(goods).count() == 3


def test_product_counts_and_prices(table):
    goods = table(GOODS, [
        goods_row("a"), goods_row("b", quality="流通原厂件", price=20), goods_row("c", quality=None, price=7),
        goods_row("d", source="04"), goods_row("e", price=0), goods_row("f", province=""), goods_row("g", brand="B_#")])
    assert rows_of(parts.product_count_salted(goods)) == [
        ("44", "01", "B", "原厂件", 1), ("44", "01", "B", "流通原厂件", 1), ("44", "01", "B_#", "原厂件", 1)]
    got = parts.price_by_quality_group(goods).where("provinceCode = '44' AND carTypeBrandName = 'B'")
    assert rows_of(got, "qualityType", "min_part_price", "average_part_price") == [
        ("原厂件", 10.0, 15.0), ("品牌件", 7.0, 7.0)]
