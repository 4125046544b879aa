"""Staff class, bonus ratio and factor tables as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Staff positions.
REGION_HEAD = "00"
PROVINCE_HEAD = "01"
OPERATIONS = "02"
CUSTOMER_MANAGER = "03"
SUPPLY_CHAIN = "05"
REGULAR_POSITIONS = ("00", "01", "02", "05")
PROVINCE_POSITIONS = ("01", "02", "05")

# Upper amount bound (inclusive) and class, then the class above the last bound.
PROVINCE_HEAD_BANDS = [(6_000_000, "1.1"), (10_000_000, "1.2"), (15_000_000, "2.1"), (20_000_000, "2.2")]
PROVINCE_HEAD_TOP = "3"
OPERATIONS_BANDS = [(10_000_000, "2"), (20_000_000, "3"), (30_000_000, "4")]
OPERATIONS_TOP = "5"
MANAGER_BANDS = [(850_000, "1"), (1_500_000, "2"), (3_000_000, "3"), (6_000_000, "4")]
MANAGER_TOP = "5"
# The same bands with the gaps of the published rule: class 2 is unreachable, and the cent
# ranges just above 1.5M and 3M fall through to the top class.
MANAGER_BANDS_LITERAL = [
    (850_000, "1"), (1_500_001, "5"), (3_000_000, "3"), (3_000_001, "5"), (6_000_000, "4"),
]

# Bonus ratio by class.
REGION_HEAD_RATIO = 0.012
PROVINCE_HEAD_RATIOS = {"1.1": 0.025, "1.2": 0.028, "2.1": 0.032, "2.2": 0.035}
PROVINCE_HEAD_RATIO_ELSE = 0.038
OPERATIONS_RATIOS = {"2": 0.016, "3": 0.018, "4": 0.020, "5": 0.022}
SUPPLY_CHAIN_RATIOS = {"2": 0.014, "3": 0.015, "4": 0.016, "5": 0.017}
MANAGER_SELFOP_RATIOS = {"1": 0.07, "2": 0.11, "3": 0.15, "4": 0.17}
MANAGER_SELFOP_ELSE = 0.18
MANAGER_BROKERED_RATIOS = {"1": 0.04, "2": 0.08, "3": 0.10, "4": 0.12}
MANAGER_BROKERED_ELSE = 0.14

# Lowest rate and factor, best first.
REPEAT_SHOP_FACTORS = [(40, 1.0), (35, 0.9), (25, 0.8)]
REPEAT_SHOP_FACTOR_ELSE = 0.7


def _band(amount: Column, bands: list[tuple[int, str]], top: str) -> Column:
    out = F.when(amount <= bands[0][0], bands[0][1])
    for bound, label in bands[1:]:
        out = out.when(amount <= bound, label)
    return out.otherwise(top)


def _table(key: Column, values: dict[str, float], default: float) -> Column:
    pairs = list(values.items())
    out = F.when(key == pairs[0][0], F.lit(pairs[0][1]))
    for label, ratio in pairs[1:]:
        out = out.when(key == label, F.lit(ratio))
    return out.otherwise(F.lit(default))


def sales_class(position: Column, amount: Column, strict_reference: bool = False) -> Column:
    manager_bands = MANAGER_BANDS_LITERAL if strict_reference else MANAGER_BANDS
    return (
        F.when(position == PROVINCE_HEAD, _band(amount, PROVINCE_HEAD_BANDS, PROVINCE_HEAD_TOP))
        .when(position.isin(OPERATIONS, SUPPLY_CHAIN), _band(amount, OPERATIONS_BANDS, OPERATIONS_TOP))
        .when(position == CUSTOMER_MANAGER, _band(amount, manager_bands, MANAGER_TOP))
        .otherwise("0")
    )


def sales_class_name(position: Column, cls: Column) -> Column:
    return (
        F.when(position == REGION_HEAD, F.lit("M0"))
        .when(position == PROVINCE_HEAD, F.concat(F.lit("M"), F.left(cls, F.lit(1))))
        .when(position == CUSTOMER_MANAGER, F.concat(F.lit("S"), cls))
        .otherwise(F.concat(F.lit("O"), cls))
    )


def bonus_ratio(position: Column, cls: Column) -> Column:
    return (
        F.when(position == REGION_HEAD, F.lit(REGION_HEAD_RATIO))
        .when(position == PROVINCE_HEAD, _table(cls, PROVINCE_HEAD_RATIOS, PROVINCE_HEAD_RATIO_ELSE))
        .when(position == OPERATIONS, _table(cls, OPERATIONS_RATIOS, 0.0))
        .when(position == SUPPLY_CHAIN, _table(cls, SUPPLY_CHAIN_RATIOS, 0.0))
        .otherwise(F.lit(0.0))
    )


def manager_selfop_ratio(cls: Column) -> Column:
    return _table(cls, MANAGER_SELFOP_RATIOS, MANAGER_SELFOP_ELSE)


def manager_brokered_ratio(cls: Column) -> Column:
    return _table(cls, MANAGER_BROKERED_RATIOS, MANAGER_BROKERED_ELSE)


def repeat_shop_factor(rate: Column) -> Column:
    best, *rest = REPEAT_SHOP_FACTORS
    out = F.when(rate >= best[0], F.lit(best[1]))
    for bound, factor in rest:
        out = out.when(rate >= bound, F.lit(factor))
    return out.otherwise(F.lit(REPEAT_SHOP_FACTOR_ELSE))


def completion_selfop_factor(completion: Column) -> Column:
    return F.when(completion >= 110, F.lit(1.1)).otherwise(F.lit(1.0))


def completion_brokered_factor(completion: Column) -> Column:
    share = completion.cast("double") / F.lit(100.0)
    return F.when(completion >= 100, F.lit(1.0)).otherwise(F.greatest(share, F.lit(0.6)))
