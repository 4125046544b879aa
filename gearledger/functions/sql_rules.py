"""The rating rules and the part-number cleaning as functions for SQL text.

Their bodies are written from the same tables as the column expressions in ``ratings`` and ``text``. They are native SQL
expressions, so the optimizer sees through them like through the columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from gearledger.functions import ratings as R
from gearledger.functions.text import SPECIAL_CHARACTERS


def _text(value: str) -> str:
    return f"'{value}'"


def _number(value: float) -> str:
    return f"{value}D"


def _case(branches: Iterable[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in branches) + f" ELSE {otherwise} END"


def _band(bands: list[tuple[int, str]], top: str) -> str:
    return _case([(f"amount <= {bound}", _text(label)) for bound, label in bands], _text(top))


def _table(values: Mapping[str, float], default: float) -> str:
    return _case([(f"class = {_text(k)}", _number(v)) for k, v in values.items()], _number(default))


def rule_functions() -> dict[str, tuple[str, str, str]]:
    """Parameters, type and body of every function by name."""
    position = "position = {}".format
    both = ", ".join(map(_text, (R.OPERATIONS, R.SUPPLY_CHAIN)))
    return {
        "sales_class": ("position STRING, amount DECIMAL(28,2)", "STRING", _case([
            (position(_text(R.PROVINCE_HEAD)), _band(R.PROVINCE_HEAD_BANDS, R.PROVINCE_HEAD_TOP)),
            (f"position IN ({both})", _band(R.OPERATIONS_BANDS, R.OPERATIONS_TOP)),
            (position(_text(R.CUSTOMER_MANAGER)), _band(R.MANAGER_BANDS, R.MANAGER_TOP))], "'0'")),
        "sales_class_name": ("position STRING, class STRING", "STRING", _case([
            (position(_text(R.REGION_HEAD)), "'M0'"),
            (position(_text(R.PROVINCE_HEAD)), "concat('M', left(class, 1))"),
            (position(_text(R.CUSTOMER_MANAGER)), "concat('S', class)")], "concat('O', class)")),
        "bonus_ratio": ("position STRING, class STRING", "DOUBLE", _case([
            (position(_text(R.REGION_HEAD)), _number(R.REGION_HEAD_RATIO)),
            (position(_text(R.PROVINCE_HEAD)), _table(R.PROVINCE_HEAD_RATIOS, R.PROVINCE_HEAD_RATIO_ELSE)),
            (position(_text(R.OPERATIONS)), _table(R.OPERATIONS_RATIOS, 0.0)),
            (position(_text(R.SUPPLY_CHAIN)), _table(R.SUPPLY_CHAIN_RATIOS, 0.0))], _number(0.0))),
        "manager_selfop_ratio": ("class STRING", "DOUBLE", _table(R.MANAGER_SELFOP_RATIOS, R.MANAGER_SELFOP_ELSE)),
        "manager_brokered_ratio": ("class STRING", "DOUBLE", _table(R.MANAGER_BROKERED_RATIOS, R.MANAGER_BROKERED_ELSE)),
        "repeat_shop_factor": ("rate DECIMAL(18,2)", "DOUBLE", _case(
            [(f"rate >= {bound}", _number(factor)) for bound, factor in R.REPEAT_SHOP_FACTORS],
            _number(R.REPEAT_SHOP_FACTOR_ELSE))),
        "completion_selfop_factor": ("completion DECIMAL(18,2)", "DOUBLE",
                                     _case([("completion >= 110", _number(1.1))], _number(1.0))),
        "completion_brokered_factor": (
            "completion DECIMAL(18,2)", "DOUBLE",
            _case([("completion >= 100", _number(1.0))], "greatest(CAST(completion AS DOUBLE) / 100.0D, 0.6D)")),
        "clean_part_number": ("number STRING", "STRING", f"regexp_replace(number, r'{SPECIAL_CHARACTERS}', '')"),
    }


def register_rules(spark: SparkSession) -> SparkSession:
    """Make the rules known to SQL text of this session."""
    for name, (parameters, kind, body) in rule_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return spark
