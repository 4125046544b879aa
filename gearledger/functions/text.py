"""Part-number, key and code text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters dropped from a part number. The class holds the range + to /
# (plus, comma, minus, dot, slash) and ~ # space; the second branch is a backslash followed
# by one of s * .
SPECIAL_CHARACTERS = r"([+-/~.# ]|\\[s*])"

# Quality labels.
ORIGINAL_QUALITY = "原厂件"
CIRCULATED_ORIGINAL_QUALITY = "流通原厂件"
BRANDED_QUALITY = "品牌件"


def clean_part_number(c: Column) -> Column:
    return F.regexp_replace(c, SPECIAL_CHARACTERS, "")


def pid(*parts: Column) -> Column:
    """Surrogate key text. For output only: joins use the natural columns, because plain
    concatenation can make two different keys equal."""
    return F.concat(*parts)


def drop_last_char(c: Column) -> Column:
    return F.left(c, F.char_length(c) - 1)


def quality_group(c: Column) -> Column:
    """Two quality groups; anything that is not an original part, null too, is branded."""
    original = c.isin(ORIGINAL_QUALITY, CIRCULATED_ORIGINAL_QUALITY)
    return F.when(original, ORIGINAL_QUALITY).otherwise(BRANDED_QUALITY)
