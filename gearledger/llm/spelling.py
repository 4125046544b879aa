"""Spelling variant grouping: words one edit apart, found by scanning sorted word lists with a banded edit matrix.

The rows of the matrix of the listed word before are kept up to the prefix that both share, and the listed words behind
a prefix that is already more than one edit away from every asked word are passed over.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.llm.common import chunked
from gearledger.session import materialise

LEAST_CHARS = 5
LEAST_COUNT = 3
#: A word's form occurs at least so many times as often as the word.
RATIO = 2
#: Words that one scan lists, or asks for, at most (on average, for a larger group is dealt by hash).
CELL_WORDS = 16_384
#: So many asked words are scanned for one by one, as arrays over so few cost more than they save.
FEW_WORDS = 100
#: Words whose counts a worker holds before it hands them on.
HELD_WORDS = 300_000

#: Letters of a run by their Latin-1 bytes, lower-cased in A-Z only.
_RUN = re.compile(rb"[a-z\xc0-\xff]+")


def runs_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters as Latin-1 bytes, A-Z lower-cased: one byte is one code point."""
    return _RUN.findall((text or "").encode("latin-1", "replace").lower())


def noisy(run: bytes, start: int, every: int) -> bytes:
    """The run, or without one letter where ``every`` divides the checksum that continues ``start``."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(noise_every: int | None, least_chars: int):
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())],
            names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in chunked(batches):
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                found = Counter(runs_of(text))
                if noise_every:
                    start = crc32(f"{name}:".encode())
                    for word, n in found.items():
                        kept = noisy(word, start, noise_every)
                        if len(kept) >= least_chars:
                            counts[kept] += n
                else:
                    counts.update({w: n for w, n in found.items() if len(w) >= least_chars})
                if len(counts) > HELD_WORDS:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)

    return run


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
                noise_every: int | None = None) -> DataFrame:
    """word and n: the distinct words of at least so many code points and occurrences in all texts.

    Words are maximal runs of Latin letters, A-Z lower-cased. ``noise_every`` loses a letter of about one in so many
    (document, run) pairs, by a checksum of both, which plants spelling variants. Null and empty texts hold no words;
    a null doc_id counts as empty text; repeated rows count as often as they stand; other columns are not read.
    """
    read = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text")
    counted = read.mapInArrow(_count(noise_every, least_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _padded(words: list[str], width: int) -> np.ndarray:
    """Row j holds the code points of all words at place j (from 1), -1 before and behind a word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out = np.full((width, len(words)), -1, np.int32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
    out[place, np.repeat(np.arange(len(words)), lengths)] = flat
    return out


def _scan_for_one(listed: list[str], common: list[int], word: str, shared: int) -> list[int]:
    """Positions of the listed words exactly one edit from one word. ``common`` holds what each shares with the one
    before it. Columns behind the end of the word cost an edit each and reach no column inside it."""
    text = "\0" + word + "\0" * 4
    size, found = len(word), []
    rows, dead = [(1 if shared else 2, 0, 1)], len(max(listed, key=len)) + 1
    never = dead
    for k, other in enumerate(listed):
        if common[k] >= dead:
            continue  # the prefix that the word is not near to stands here, too
        dead = never
        del rows[common[k] - shared + 1 :]
        a, b, c = rows[-1]
        for d in range(common[k] + 1, len(other) + 1):
            letter = other[d - 1]
            a += text[d - 1] != letter
            if b < a:
                a = b + 1 if b + 1 < a else a
            b += text[d] != letter
            if c + 1 < b:
                b = c + 1
            if a + 1 < b:
                b = a + 1
            c += text[d + 1] != letter
            if b + 1 < c:
                c = b + 1
            if a > 1 and b > 1 and c > 1:
                dead = d
                break
            rows.append((a, b, c))
        else:
            if -1 <= size - len(other) <= 1 and (a, b, c)[size - len(other) + 1] == 1:
                found.append(k)
    return found


def one_edit_pairs(listed: list[str], asked: list[str], shared: int = 0,
                   few: int = FEW_WORDS) -> tuple[list[int], list[int]]:
    """Positions (listed, asked) of all words exactly one inserted, deleted or replaced code point apart.

    ``listed`` is sorted, and all words begin with the same ``shared`` code points. A row of the matrix belongs to a
    prefix of the listed word and holds its distances to the prefixes of one less, as many and one more letters of an
    asked word. Up to ``few`` asked words are scanned for one by one; more share one scan, whose rows are arrays
    over the asked words that are still within one edit.
    """
    if not listed or not asked:
        return [], []
    common = [shared, *(len(commonprefix(x)) for x in zip(listed, listed[1:]))]
    left, right = [], []
    if len(asked) <= few:
        for j, word in enumerate(asked):
            found = _scan_for_one(listed, common, word, shared)
            left += found
            right += [j] * len(found)
        return left, right
    codes = _padded(asked, max(max(map(len, listed)), max(map(len, asked))) + 3)
    lengths = np.fromiter(map(len, asked), np.int64, len(asked))
    rows = [(np.arange(len(asked)), *(np.full(len(asked), x, np.int8) for x in (1 if shared else 2, 0, 1)))]
    never = dead = len(codes)
    for k, word in enumerate(listed):
        if common[k] >= dead:
            continue
        dead = never
        del rows[common[k] - shared + 1 :]
        for d in range(common[k] + 1, len(word) + 1):
            alive, a, b, c = rows[-1]
            letter = ord(word[d - 1])
            a = np.minimum(a + (codes[d - 1][alive] != letter), b + 1)
            b = np.minimum(np.minimum(b + (codes[d][alive] != letter), c + 1), a + 1)
            c = np.minimum(c + (codes[d + 1][alive] != letter), b + 1)
            keep = np.flatnonzero(np.minimum(np.minimum(a, b), c) <= 1)
            if not len(keep):
                dead = d
                break
            rows.append((alive, a, b, c) if len(keep) == len(alive) else (alive[keep], a[keep], b[keep], c[keep]))
        else:
            alive, a, b, c = rows[-1]
            more = lengths[alive] - len(word)
            hits = alive[((more == -1) & (a == 1)) | ((more == 0) & (b == 1)) | ((more == 1) & (c == 1))].tolist()
            left += [k] * len(hits)
            right += hits
    return left, right


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of every cell; the rows of a cell follow each other, sorted by their scan text."""

    def pairs(side: str, least: int, rows: list[tuple[str, int, bool, bool]]) -> pa.RecordBatch | None:
        listed, asked = [r for r in rows if r[2]], [r for r in rows if r[3]]
        head = least // 2
        at, of = one_edit_pairs([r[0] for r in listed], [r[0] for r in asked], head if side == "head" else least - head)
        out = []
        for i, j in zip(at, of):
            a, b = asked[j][:2], listed[i][:2]
            if side == "tail":
                a, b = (a[0][::-1], a[1]), (b[0][::-1], b[1])
                if a[0][:head] == b[0][:head]:
                    continue  # this pair meets among the words with its start as well
            out.append((*a, *b))
            if len(b[0]) > least:
                out.append((*b, *a))
        if not out:
            return None
        words, n, near, near_n = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(n, pa.int64()), pa.array(near, pa.string()),
             pa.array(near_n, pa.int64())], names=["word", "n", "near", "near_n"])

    now, rows = None, []
    for batch in batches:
        names = ("side", "least", "part", "listed_salt", "asked_salt", "scan", "n", "is_listed", "is_asked")
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            cell, rest = row[:5], row[5:]
            if cell != now:
                if len(rows) > 1 and (found := pairs(now[0], now[1], rows)):
                    yield found
                now, rows = cell, []
            rows.append(rest)
    if len(rows) > 1 and (found := pairs(now[0], now[1], rows)):
        yield found


def _groups(words: DataFrame) -> DataFrame:
    """A row for every group that a word takes part in.

    One edit leaves the first half or the rest of the shorter word of a pair untouched, so the pair meets in the sorted
    list of the words with that start, or in the sorted list of the reversed words with that end. A word may be the
    shorter of a pair (``least`` is its length) or the longer one (one less). Lists hold both, and are asked for the
    shorter ones only.
    """
    length = F.char_length("word")
    pieces = []
    for less in (0, 1):
        least = (length - less).cast("int")
        half = F.expr(f"(char_length(word) - {less}) div 2").cast("int")
        pieces += [
            F.struct(F.lit("head").alias("side"), least.alias("least"),
                     F.col("word").substr(F.lit(1), half).alias("part"), F.col("word").alias("scan")),
            F.struct(F.lit("tail").alias("side"), least.alias("least"),
                     F.reverse("word").substr(F.lit(1), least - half).alias("part"), F.reverse("word").alias("scan"))]
    return words.select("n", F.explode(F.array(*pieces)).alias("g")).select("g.*", "n")


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n, near and near_n for every ordered pair of words exactly one edit apart; ``words`` holds word and n, each
    word once.

    Groups without two words, or without a shorter one, are left out, and a group of more than ``cell_words`` words is
    dealt by a hash into cells that list one part and ask for one part, so a task never holds a whole large group.
    """
    groups = _groups(words)
    key = ["side", "least", "part"]
    shorter = F.char_length("scan") == F.col("least")
    sizes = groups.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.max(shorter).alias("asks")).where(
        "size > 1 AND asks").select(*key, F.ceil(F.col("size") / cell_words).cast("int").alias("cuts"))
    own = F.col("own")
    dealt = groups.join(sizes, key).withColumn("own", F.pmod(F.hash("scan"), F.col("cuts")))
    others = F.filter(F.sequence(F.lit(0), F.col("cuts") - 1), lambda i: i != own)

    def cell(listed: Column, asked: Column, is_listed: bool, is_asked: bool | Column) -> Column:
        asks = is_asked if isinstance(is_asked, Column) else F.lit(is_asked)
        return F.struct(listed.alias("listed_salt"), asked.alias("asked_salt"), F.lit(is_listed).alias("is_listed"),
                        asks.alias("is_asked"))

    # One row serves both sides in the cell on the diagonal.
    cells = F.concat(F.array(cell(own, own, True, shorter)),
                     F.transform(others, lambda i: cell(own, i, True, False)),
                     F.transform(F.when(shorter, others).otherwise(F.array().cast("array<int>")),
                                 lambda i: cell(i, own, False, True)))
    placed = dealt.select(*key, "scan", "n", F.explode(cells).alias("c")).select(*key, "c.*", "scan", "n")
    place = [*key, "listed_salt", "asked_salt"]
    return placed.repartition(*place).sortWithinPartitions(*place, "scan").mapInArrow(
        _scan, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word and the last word of its chain of forms (``root``); ``forms`` holds word and form, and has no circles.

    Every round follows twice as many steps as the round before.
    """
    known = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = known.alias("a").join(known.alias("b"), F.expr("a.root = b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved"))
        after = materialise(further, "spelling-roots")
        known = after.select("word", "root")
        if after.where("moved").isEmpty():
            return known


def spelling_groups(words: DataFrame, ratio: int = RATIO, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word; ``words`` holds word and n, each word once.

    A word's form is its near word with the largest n, ties to the smallest in code-point order, if that n is at least
    ``ratio`` times the word's own, else null; ``ratio`` is above 1, so forms only rise and chains end. The root is the
    last form of the chain, or the word itself. Rows with a null word or n are left out. Words shorter than two code
    points meet none. An empty table gives an empty result; other columns are not read.
    """
    words = words.where("word IS NOT NULL AND n IS NOT NULL").select("word", F.col("n").cast("long").alias("n"))
    words = materialise(words, "spelling-words")
    pairs = near_words(words, cell_words)
    found = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.first("n").alias("own_n"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("own_n")
    near = materialise(found.select(
        "word", "n_near", F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-near")
    last = roots(near.where("form IS NOT NULL"))
    return words.join(near.join(last, "word", "left"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
        F.coalesce("root", "word").alias("root"))
