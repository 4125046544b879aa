"""Line-first cleaning: judge every line by rules, remove the failing lines, then reject documents losing too much.

Native: only DataFrame functions, evaluated row by row inside one scan, without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.llm.common import words_of

#: A word character is anything outside the ASCII white space.
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Phrases of page furniture. A line with one of them fails if it is short.
BOILERPLATE = (
    "cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "subscribe to",
    "sign up", "log in", "click here", "read more", "share this", "enable javascript", "lorem ipsum",
)
BOILERPLATE_CHARS = 200
#: Separators of menus and bread crumbs; this many in one line make it navigation.
MENU = r"[|»›•→]| > "
#: Those of them that are not symbols anyway.
MENU_ONLY = ("»", "›", "•", "→")
MENU_SIGNS = 3
#: A line fails if more than one in this many of its characters is a symbol.
SYMBOL_SHARE = 10
WINDOW = 5
#: A document is rejected if more than this share of its line characters is removed.
MAX_LOST = 0.5


def line_fails(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules of one line."""
    chars = F.char_length(line)
    symbols = F.regexp_count(line, F.lit(SYMBOLS)) * SYMBOL_SHARE > chars
    menu = F.regexp_count(line, F.lit(MENU)) >= MENU_SIGNS
    phrases = (chars < BOILERPLATE_CHARS) & F.lower(line).rlike("|".join(BOILERPLATE))
    return symbols | menu | phrases


def may_fail(text: Column, n_symbols: Column) -> Column:
    """False only for texts without any line that fails: no symbol, no menu sign and no phrase anywhere."""
    lower = F.lower(text)
    return reduce(lambda a, b: a | b, [lower.contains(x) for x in BOILERPLATE + MENU_ONLY], n_symbols > 0)


def clean_lines(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """doc_id, counts of the whole text, ``base_failed``, ``kept``, ``n_lines_removed`` and ``clean_text``.

    Lines are split at ``\\n``; a line without a word is never judged and stays. ``kept`` is false where the base
    counts fail or where the removed lines hold more than ``max_lost`` of the characters of all lines with a word.
    Null and empty texts have no words, so they fail the base rule. Rows are judged one by one: a repeated row
    repeats its result, an empty table gives an empty result, and other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", text.alias("text"), words_of("text").alias("words"),
                        F.split(text, "\n").alias("split_lines"),
                        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    at = F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0)))
    window = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)]))
    none = F.array().cast("array<bigint>")
    hashed = words.select(
        "*", F.filter("split_lines", lambda x: x.rlike(HAS_WORD)).alias("lines"),
        F.when(F.size("words") >= WINDOW, window).otherwise(none).alias("windows"))
    # Only texts with a repeated window sort their windows to find the places.
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    sorted_windows = hashed.select("*", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"), placed
    ).otherwise(F.array().cast("array<struct<h:bigint,at:int>>")).alias("placed"))
    repeated = F.filter("placed", lambda x, i: (
        (F.get(F.col("placed"), i - 1)["h"] == x["h"]) | (F.get(F.col("placed"), i + 1)["h"] == x["h"])))
    starts = sorted_windows.select("*", F.sort_array(F.transform(repeated, lambda x: x["at"])).alias("starts"))
    covered = F.aggregate(
        F.transform("starts", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(
            F.get(F.col("starts"), i + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda total, x: total + x)
    def chars_of(lines: Column) -> Column:
        return F.char_length(F.array_join(lines, "")).cast("long")

    # Most texts hold nothing that any line rule looks for, so their lines are not judged one by one.
    suspect = starts.select("*", F.when(may_fail(F.col("text"), F.col("n_symbols")), F.filter("lines", line_fails)).otherwise(
        F.array().cast("array<string>")).alias("failed_lines"))
    stays = F.filter("split_lines", lambda x: ~x.rlike(HAS_WORD) | ~line_fails(x))
    counted = suspect.select(
        "doc_id", "lines", "failed_lines", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.when(F.size("failed_lines") > 0, F.array_join(stays, "\n")).otherwise(F.col("text")).alias("clean_text"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    lost = chars_of(F.col("failed_lines")) > max_lost * chars_of(F.col("lines"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & ~lost).alias("kept"), F.size("failed_lines").cast("long").alias("n_lines_removed"), "clean_text")
