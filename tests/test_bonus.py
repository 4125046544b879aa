import pytest

from gearledger.operators import bonus
from tests.conftest import rows_of

MONTH = (2020, 3)
STATS = """dt date, province string, manager_id long, picc_selfop_order decimal(28,2), picc_married_order decimal(28,2),
  picc_selfop_actual_order decimal(28,2), picc_married_actual_order decimal(28,2)"""
USERS = "user_id long, fr_username string, name string, user_position string, status string, is_region_leader string, is_hq string"
AREAS = "user_id long, position string, province string, status string"
REGION_USERS = "user_id long, name string, region_id long, region_name string, status string"
REGION_PROVINCES = "region_id long, province string, is_responsible string"
TARGETS = """year int, month int, province string, city string, picc_selfop_trans_target decimal(11,2),
  picc_marriedDeal_trans_target decimal(11,2)"""
SELFOP = "year int, month int, province string, amount_picc_selfop decimal(28,2), amount_actual_picc_selfop decimal(28,2)"
ACTIVE = "year int, month int, province string, previous_repeat_shop long, this_month_repeat_shop long"
TOTALS = "year int, month int, province string, amount_picc decimal(28,2), amount_actual_picc decimal(28,2)"


@pytest.fixture
def staff(table):
    users = table(USERS, [
        (1, "u1", "Head", "00", "1", "1", "0"), (2, "u2", "Prov", "01", "1", "0", "0"), (3, "u3", "Mgr", "03", "1", "0", "0"),
        (4, "u4", "Gone", "03", "0", "0", "0"), (5, "u5", "Hq", "01", "1", "0", "1"), (6, "u6", "None", None, "1", "0", "0"),
        (7, "u7", "Area-less", "05", "1", "0", "0")])
    areas = table(AREAS, [(1, "01", "P1", "1"), (2, "01", "P1", "1"), (2, "01", "P1", "0"), (3, "03", "P1", None), (4, "03", "P1", "1")])
    region_users = table(REGION_USERS, [(1, "Head", 1, "R1", "1")])
    region_provinces = table(REGION_PROVINCES, [(1, "P1", "1"), (1, "P2", "0")])
    return users, areas, region_users, region_provinces


def test_roster(staff):
    got = bonus.bonus_roster(*staff, MONTH, MONTH)
    assert rows_of(got, "user_id", "position", "province", "repeat_shop_factor") == sorted([
        (1, "00", "P1", 0.7), (1, "00", "P2", 0.7), (2, "01", "P1", 0.7), (3, "03", "P1", 0.7), (7, None, None, 0.7)], key=repr)
    two = bonus.bonus_roster(*staff, (2019, 12), (2020, 1))
    assert two.count() == 10


def test_month_totals_skip_unmanaged_rows(table):
    stats = table(STATS, [
        ("2020-03-01", "P1", 3, 10, 5, 8, 4), ("2020-03-31", "P1", 3, 1, 1, 1, 1), ("2020-03-02", "P1", 0, 99, 99, 99, 99),
        ("2020-03-02", "P1", None, 99, 99, 99, 99), ("2020-04-01", "P1", 3, 7, 7, 7, 7), ("2020-03-02", "P2", 3, 2, 0, 2, 0)])
    march = "month = 3"
    assert rows_of(bonus.province_channel_totals(stats).where(march), "province", "amount_picc", "amount_actual_picc") == [
        ("P1", 17.0, 14.0), ("P2", 2.0, 2.0)]
    assert rows_of(bonus.manager_channel_totals(stats).where(march), "manager_id", "amount_picc") == [(3, 19.0)]
    to_date = bonus.province_selfop_totals(stats, until="2020-03-30").where("province = 'P1'")
    assert rows_of(to_date, "month", "amount_picc_selfop", "amount_actual_picc_selfop") == [(3, 10.0, 8.0)]


def test_regular_staff_and_managers(staff, table):
    roster = bonus.bonus_roster(*staff, MONTH, MONTH)
    totals = table(TOTALS, [(2020, 3, "P1", 100, 12_000_000), (2020, 3, "P2", 1, 1)])
    regular = bonus.bonus_regular_staff(roster, totals)
    assert rows_of(regular, "user_id", "position", "amount_picc", "sales_class", "bonus_ratio", "sales_class_name") == [
        (1, "00", 101.0, "0", 0.012, "M0"), (2, "01", 100.0, "2.1", 0.032, "M2")]
    managers = table("year int, month int, manager_id long, amount_picc decimal(28,2), amount_actual_picc decimal(28,2)",
                     [(2020, 3, 3, 5, 1_600_000), (2020, 4, 3, 5, 1)])
    got = bonus.bonus_customer_manager(roster, managers)
    assert rows_of(got, "user_id", "sales_class", "selfop_bonus_ratio", "married_bonus_ratio", "sales_class_name") == [
        (3, "3", 0.15, 0.10, "S3")]
    assert rows_of(bonus.bonus_customer_manager(roster, managers.limit(0)), "amount_picc", "sales_class") == [(0.0, "1")]


def test_parttime_provincial(staff, table):
    _, areas, region_users, _ = staff
    totals = table(TOTALS, [(2020, 3, "P1", 100, 1_000_000)])
    got = bonus.bonus_parttime_provincial(region_users, areas, totals)
    assert rows_of(got, "user_id", "province", "bonus_ratio") == [(1, "P1", 0.025)]


def test_province_completion(table):
    selfop = table(SELFOP, [(2020, 3, p, 0, a) for p, a in [
        ("zero", 5), ("missing", 5), ("null", 5), ("met", 110), ("low", 59), ("mid", 99.99)]])
    targets = table(TARGETS, [
        (2020, 3, "zero", "100000", 0, 1), (2020, 3, "null", "100000", None, 1), (2020, 3, "met", "100000", 100, 1),
        (2020, 3, "met", "110100", 1, 1), (2020, 3, "low", "100000", 100, 1), (2020, 3, "mid", "100000", 100, 1)])
    active = table(ACTIVE, [
        (2020, 3, "zero", 0, 5), (2020, 3, "met", 100, 35), (2020, 3, "low", None, 5), (2020, 3, "mid", 10_000, 2_499)])
    got = bonus.province_completion_factors(selfop, targets, active)
    assert rows_of(got, "province", "complete_ratio", "repeat_ratio", "selfop_factor", "married_factor", "repeat_shop_factor") == [
        ("low", 59.0, 0.0, 1.0, 0.6, 0.7), ("met", 110.0, 35.0, 1.1, 1.0, 0.9), ("mid", 99.99, 24.99, 1.0, 99.99 / 100, 0.7),
        ("missing", 500.0, 0.0, 1.1, 1.0, 0.7), ("null", 500.0, 0.0, 1.1, 1.0, 0.7), ("zero", 100.0, 0.0, 1.0, 1.0, 0.7)]


def test_region_weights_and_own_province(staff, table):
    users, _, region_users, _ = staff
    provinces = table(REGION_PROVINCES, [(1, "own", "1"), (1, "a", "0"), (1, "b", "0"), (1, "quiet", "1")])
    targets = table(TARGETS, [
        (2020, 3, "own", "100000", 50, 0), (2020, 3, "a", "100000", 100, 200), (2020, 3, "b", "100000", 0, 100),
        (2020, 3, "quiet", "100000", 0, 0)])
    selfop = table(SELFOP, [(2020, 3, "own", 0, 25), (2020, 3, "a", 0, 80), (2020, 3, "b", 0, 10)])
    active = table(ACTIVE, [(2020, 3, "a", 10, 4), (2020, 3, "b", 0, 3)])
    weighted = bonus.region_weighted_completion(targets, selfop, active, provinces, region_users)
    # a weighs 300 of 400; b has no own-sale target and no base
    assert rows_of(weighted, "user_id", "complete_ratio", "repeat_ratio") == [(1, 60.0, 30.0)]
    got = bonus.region_bonus_factors(
        region_users, users, provinces, targets, active, selfop, weighted, MONTH, MONTH)
    assert rows_of(got, "province", "complete_ratio", "repeat_ratio") == [
        ("a", 60.0, 30.0), ("b", 60.0, 30.0), ("own", 50.0, 0.0), ("quiet", 100.0, 0.0)]


def test_manager_repeat_rate(table):
    detail = table("shop_id long, type string, year int, month int", [
        (1, "2", 2020, 3), (2, "2", 2020, 3), (3, "2", 2020, 3), (1, "1", 2020, 3), (9, "2", 2020, 3)])
    mapping = table("shop_id long, manager_id long", [(1, 7), (2, 7), (3, 8)])
    assert rows_of(bonus.manager_repeat_rate(detail, mapping), "manager_id", "repeat_ratio", "repeat_shop_factor") == [
        (7, 50.0, 1.0), (8, 0.0, 0.7)]


def test_bonus_table_applies_steps_in_order(staff, table):
    users, areas, region_users, provinces = staff
    roster = bonus.bonus_roster(*staff, MONTH, MONTH)
    totals = table(TOTALS, [(2020, 3, "P1", 100, 12_000_000)])
    managers = table("year int, month int, manager_id long, amount_picc decimal(28,2), amount_actual_picc decimal(28,2)",
                     [(2020, 3, 3, 5, 1_600_000)])
    classed = bonus.apply_class_updates(
        bonus.with_bonus_columns(roster), bonus.bonus_regular_staff(roster, totals),
        bonus.bonus_parttime_provincial(region_users, areas, totals), bonus.bonus_customer_manager(roster, managers))
    selfop = table(SELFOP, [(2020, 3, "P1", 0, 120), (2020, 3, "P2", 0, 10)])
    targets = table(TARGETS, [(2020, 3, "P1", "100000", 100, 0), (2020, 3, "P2", "100000", 100, 0)])
    active = table(ACTIVE, [(2020, 3, "P1", 10, 4), (2020, 3, "P2", 10, 1)])
    weighted = bonus.region_weighted_completion(targets, selfop, active, provinces, region_users)
    regions = bonus.region_bonus_factors(region_users, users, provinces, targets, active, selfop, weighted, MONTH, MONTH)
    repeat = table("year int, month int, manager_id long, repeat_ratio decimal(18,2), repeat_shop_factor double",
                   [(2020, 3, 3, 30, 0.8)])
    got = bonus.apply_factor_updates(
        classed, bonus.province_completion_factors(selfop, targets, active), regions, repeat)
    assert rows_of(got, "user_id", "province", "selfop_profit_bonus_ratio", "level_name", "picc_selfop_completion",
                   "this_repeat_rate", "selfop_profit_factor", "repeat_shop_factor") == sorted([
        (1, "P1", 0.032, "M0", 120.0, 40.0, 1.1, 1.0),  # also runs P1: that ratio wins
        (1, "P2", 0.012, "M0", 10.0, 10.0, 1.0, 0.7),
        (2, "P1", 0.032, "M2", 120.0, 40.0, 1.1, 1.0),
        (3, "P1", 0.15, "S3", 120.0, 30.0, 1.1, 0.8),
        (7, None, None, None, None, None, None, 0.7)], key=repr)
