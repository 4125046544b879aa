"""Periodic run detection by seed and extend: repeated word k-grams lead to diagonals, which are extended to whole runs.

A run is a stretch of words with smallest period q that no neighbouring word extends. On the diagonal of lag q the words
of a run match at least ``least - q`` and at least ``(EXPONENT - 1) * q`` times in a row, so lags are taken in classes
from one power of two to the next, each with the k-grams of the overlap that the class guarantees. As such a gram is as
long as the lag, the next occurrence of the gram already lies one smallest period further on, and neighbouring
occurrences are the only pairs needed.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.llm.common import chunked, words_of

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS = 6
EXPONENT = 4

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _numbered(values: np.ndarray) -> np.ndarray:
    """Dense numbers of the values that occur more than once, -1 for the others."""
    if not len(values):
        return np.empty(0, np.int64)
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    dense = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)
    return dense[inverse]


def _widened(names: np.ndarray, more: np.ndarray, shift: int) -> np.ndarray:
    """Names of the grams made of one at each place and another ``shift`` further on, which may overlap; -1 where one stands alone."""
    out = np.full(len(names), -1, np.int64)
    at = np.flatnonzero(names[: max(0, len(names) - shift)] >= 0)
    at = at[more[at + shift] >= 0]
    if len(at):
        out[at] = _numbered(names[at] * len(names) + more[at + shift])
    return out


def _seeds(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Lag and place of neighbouring occurrences of a gram with a lag of ``low`` to below ``high``, by both."""
    at = np.flatnonzero(grams >= 0)
    at = at[np.argsort(grams[at], kind="stable")]
    lag = at[1:] - at[:-1]
    hit = (grams[at[1:]] == grams[at[:-1]]) & (lag >= low) & (lag < high)
    lag, at = lag[hit], at[:-1][hit]
    order = np.lexsort((at, lag))
    return lag[order], at[order]


def _matches(items: np.ndarray, place: int, lag: int, step: int) -> int:
    """How many places in a row from ``place`` on, in steps of 1 or -1, hold the item that stands one lag later."""
    total, block = 0, 16
    while True:
        low, high = (place, min(place + block, len(items) - lag)) if step > 0 else (max(place - block + 1, 0), place + 1)
        if low >= high:
            return total
        same = (items[low:high] == items[low + lag : high + lag])[::step]
        if not same.all():
            return total + int(np.argmin(same))
        total, place, block = total + len(same), place + step * len(same), min(block * 4, 1 << 20)


def _extended(items: np.ndarray, lags: np.ndarray, places: np.ndarray, width: int) -> Iterator[tuple[int, int, int]]:
    """Start, length and period of the whole stretch around every seed.

    Seeds come by lag and place. Chains of neighbouring seeds are extended as one, and a chain inside what was already
    covered on its lag is passed over.
    """
    breaks = np.flatnonzero((np.diff(lags) != 0) | (np.diff(places) > 1)) + 1
    starts = np.concatenate([[0], breaks])
    ends = np.concatenate([breaks, [len(lags)]]) - 1
    covered: dict[int, int] = {}
    for lag, first, last in zip(lags[starts].tolist(), places[starts].tolist(), places[ends].tolist()):
        if last + width <= covered.get(lag, 0):
            continue
        begin = first - _matches(items, first - 1, lag, -1)
        end = last + width
        end += _matches(items, end, lag, 1)
        covered[lag] = end
        yield begin, end - begin + lag, lag


def periodic_runs(items: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of all maximal runs of at least ``least`` items and four periods, by start and
    then period. Items below 0 match nothing but themselves, so a negative number that stands once separates texts."""
    items = np.asarray(items, np.int64)
    names = [_numbered(items)]  # names[j] tells grams of 2**j items apart
    found = set()
    low = 1
    while len(items) >= EXPONENT * low:
        overlap = max((EXPONENT - 1) * low, least - 1 if low == 1 else 0)
        level = overlap.bit_length() - 1
        while len(names) <= level:
            names.append(_widened(names[-1], names[-1], 1 << (len(names) - 1)))
        grams = _widened(names[level], names[level], overlap - (1 << level))
        lags, places = _seeds(grams, low, 2 * low)
        if len(lags):
            found.update(x for x in _extended(items, lags, places, overlap) if x[1] >= max(least, EXPONENT * x[2]))
        low *= 2
        if (1 << level) <= (EXPONENT - 1) * low and not (names[level] >= 0).any():
            break  # no such gram occurs twice, so none of the wider ones does
    return sorted(found, key=lambda x: (x[0], x[2]))


def _separated(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words per text, the numbers of all words with a separator behind each text, and where each text begins."""
    lists = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    pieces, total = [], 0
    for k, words in enumerate(lists):
        # Numbers are a document's own, so that a gram counts as repeated only where its document repeats it.
        numbers: dict[bytes, int] = {}
        own = [numbers.setdefault(w, len(numbers)) for w in words]
        own.append(0)
        piece = np.array(own, np.int64) + total
        piece[-1] = -1 - k
        total += len(numbers)
        pieces.append(piece)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return lists, np.concatenate([np.empty(0, np.int64), *pieces]), np.cumsum(sizes) - sizes


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds behind its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, x in zip(words, np.cumsum(gone).tolist()) if not x]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _find(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches):
            lists, items, begins = _separated(batch.column("text").to_pylist())
            own: list[list[tuple[int, int, int]]] = [[] for _ in lists]
            first = begins.tolist()
            for start, length, period in periodic_runs(items, least):
                k = bisect_right(first, start) - 1
                own[k].append((start - first[k], length, period))
            runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in own], pa.list_(pa.struct(
                [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), runs, pa.array(map(_collapsed, lists, own), pa.string())],
                names=["doc_id", "runs", "collapsed_text"])

    return run


def find_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, runs (start, length, period, by start and then period) and collapsed_text of every row.

    Words are split at ASCII white space and numbered from 0. ``collapsed_text`` keeps the words outside of runs and
    the first period of each run, joined by one space. Null, empty and blank texts have no runs and an empty collapsed
    text; null ids stay null; repeated rows give equal rows; an empty table gives an empty result; other columns are
    not read. A document is worked on alone, with memory and time near to linear in its words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _find(least), f"doc_id {kind}, runs {_RUNS}, collapsed_text string")


def strongest(runs: str) -> Column:
    """The run with the greatest length over period, ties to the smallest start and then period; null without runs."""
    def better(best: Column, run: Column) -> Column:
        # Both products stay exact in 38 digits. Runs come by start and period, so the first of equals stays.
        big = "decimal(19,0)"
        more = run["length"].cast(big) * best["period"].cast(big) > best["length"].cast(big) * run["period"].cast(big)
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where about a tenth of the texts become periodic from some word on, by a checksum of their id.

    With h the checksum and g = h / 10, a text of n words with h % 10 = 0 keeps its words up to a = g % n, and behind
    them repeats the p words from a on, p = 1 + (n - a) / (3 + g % 8). Null ids and texts stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    ws, n, g = words_of("text"), F.col("n"), F.col("g")
    read = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, ws).alias("ws"))
    read = read.withColumn("n", F.size("ws").cast("long")).withColumn("a", F.when(n > 0, g % n))
    read = read.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    a, p = F.col("a"), F.col("p")
    tail = F.flatten(F.array_repeat(F.slice("ws", (a + 1).cast("int"), p.cast("int")),
                                    F.ceil((n - a) / p).cast("int")))
    whole = F.concat(F.slice("ws", F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
    return read.select("doc_id", F.when(n > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))
