"""Substring dedup by seed and extend on words.

Seeds are winnowed anchors: in every window of the least length the smallest k-gram hash, so two equal windows have
the same anchor at the same place. Anchors that stand once in the corpus end the search. Around the others the match
is extended to the whole stretch of windows that chose the anchor: stretches that stand twice repeat as a whole,
and only where stretches of one anchor differ (the ends of a maximal repeat) single windows are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearledger.llm.common import chunked, gram_hashes, gram_hashes_at, list_numbers, mix, word_hashes
from gearledger.session import materialise

#: Least length of a repeat, in words.
LENGTH = 35
ANCHOR = 8


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value of every run of ``width`` values, the rightmost of equals."""
    at = np.arange(len(grams), dtype=np.int32)
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(grams[left] < grams[right], left, right)
        span += step
    return at


def batch_words(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """All words of the texts in a row, and where each text starts among them (with the end of the last)."""
    words, starts = [], [0]
    for text in texts:
        if text:
            words += text.encode("utf-8", "surrogatepass").split()
        starts.append(len(words))
    return words, np.array(starts)


def stretches(hashes: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """anchor hash, stretch hash, text number, first and last window start of every stretch of windows with one
    anchor. The hashes are those of many texts in a row; windows that would cross into the next text do not count.
    """
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    if not len(owner):
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    within = np.arange(len(hashes)) + length <= np.repeat(starts[1:], sizes)
    windows = np.flatnonzero(within)
    grams = gram_hashes(hashes, ANCHOR, 1)
    at = winnow(grams, length - ANCHOR + 1)[windows]
    # Anchors of different texts stand at different places, so a stretch never runs on into the next text.
    cuts = np.flatnonzero(np.diff(at)) + 1
    heads = np.concatenate([[0], cuts])
    first, last = windows[heads], windows[np.concatenate([cuts, [len(at)]]) - 1]
    # First and last window overlap, so together they hold every word of the stretch.
    inner = (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = mix(mix(gram_hashes_at(hashes, length, first, 2) + inner) ^ gram_hashes_at(hashes, length, last, 2))
    owner = owner[heads]
    return grams[at[heads]].view(np.int64), whole.view(np.int64), owner, first - starts[owner], last - starts[owner]


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in chunked(batches):
            words, starts = batch_words(batch.column("text").to_pylist())
            anchor, whole, owner, first, last = stretches(word_hashes(words, cache), starts, length)
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("text_key").take(owner),
                 pa.array(anchor), pa.array(whole), pa.array(first.astype(np.int32)),
                 pa.array(last.astype(np.int32))],
                names=["doc_id", "text_key", "anchor", "stretch", "first", "last"])

    return run


def covered(first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges, ends included."""
    edges = np.bincount(first, minlength=size + 1) - np.bincount(last + 1, minlength=size + 1)
    return np.cumsum(edges[:size]) > 0


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in chunked(batches):
            words, starts = batch_words(batch.column("text").to_pylist())
            hashes = word_hashes(words, cache)
            spans = batch.column("spans")
            cuts, first = list_numbers(spans, "first")
            last, extend = list_numbers(spans, "last")[1], list_numbers(spans, "extend")[1].astype(bool)
            base = np.repeat(starts[:-1], np.diff(cuts))[extend]
            at = np.flatnonzero(covered(first[extend] + base, last[extend] + base, len(words)))
            doc = np.searchsorted(starts, at, side="right") - 1
            owner = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("text_key").take(owner),
                 pa.array((at - starts[doc]).astype(np.int32)),
                 pa.array(gram_hashes_at(hashes, length, at, 2).view(np.int64)),
                 pa.array(gram_hashes_at(hashes, length, at, 3).view(np.int64))],
                names=["doc_id", "text_key", "start", "w1", "w2"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text_key and starts: the window starts of each document whose window also starts elsewhere, as
    ranges (first, last), one row per document with any.

    Counts are partial before each exchange, so an anchor in a third of all documents is a few rows; rows grow with
    the words, never with the pairs of a group.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = _keyed(docs)
    places = keyed.mapInArrow(
        _anchors(length), f"doc_id {kind}, text_key long, anchor long, stretch long, first int, last int")
    places = places.withColumn("place", F.xxhash64("doc_id", "text_key", "first"))
    # Written, because two uses of one aggregation with different columns would hash all texts twice.
    counted = materialise(places.groupBy("anchor", "stretch").agg(
        F.count(F.lit(1)).alias("copies"), F.min("place").alias("one")), "counted")
    anchors = counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all"))
    # Copies of a stretch repeat as a whole; one of them stands for all where other stretches of the anchor differ.
    seeds = counted.join(anchors.where("all > 1").drop("all"), "anchor").select(
        "anchor", "stretch", (F.col("copies") > 1).alias("whole"), F.when(F.col("kinds") > 1, F.col("one")).alias("one"))
    matched = places.join(seeds, ["anchor", "stretch"]).select(
        "doc_id", "text_key", "first", "last", "whole", F.coalesce(F.col("place") == F.col("one"), F.lit(False)).alias("extend"))
    matched = matched.where("whole OR extend").groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("first", "last", "whole", "extend")).alias("spans"))
    matched = materialise(matched, "matched")

    open_ends = matched.where(F.exists("spans", lambda s: s["extend"]))
    # The texts meet their open ends and later their ranges by the same keys, so one exchange of the texts serves
    # both; the windows are hashed twice instead of being written.
    texts = keyed.alias("d").join(open_ends.alias("m"), F.expr(
        "d.doc_id <=> m.doc_id AND d.text_key = m.text_key")).select("d.*", "spans")
    compared = texts.mapInArrow(_windows(length), f"doc_id {kind}, text_key long, start int, w1 long, w2 long")
    again = compared.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    ends = compared.join(again.select("w1", "w2"), ["w1", "w2"]).groupBy("doc_id", "text_key").agg(
        F.collect_set("start").alias("starts"))
    whole = matched.select("doc_id", "text_key", F.transform(
        F.filter("spans", lambda s: s["whole"]), lambda s: F.struct(s["first"], s["last"])).alias("ranges"))
    ranged = ends.select("doc_id", "text_key", F.transform(
        "starts", lambda s: F.struct(s.alias("first"), s.alias("last"))).alias("ranges"))
    both = whole.where(F.size("ranges") > 0).union(ranged)
    return both.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches):
            words, starts = batch_words(batch.column("text").to_pylist())
            cuts, first = list_numbers(batch.column("ranges"), "first")
            last = list_numbers(batch.column("ranges"), "last")[1]
            base = np.repeat(starts[:-1], np.diff(cuts))
            gone = covered(first + base, last + base + length - 1, len(words))
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[starts])
            stay = (~gone).tolist()
            texts = [b" ".join(compress(words[a:b], stay[a:b])) for a, b in pairwise(starts.tolist())]
            kept = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(starts), pa.int64()), pa.array(removed, pa.int64()), kept],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the kept words, joined by one blank) of every document.

    Every word goes that lies in a run of ``length`` words whose sequence also starts elsewhere, in any document or
    in the same one; runs are judged on the input. Null and empty texts have no words. A null doc_id is a document
    like any other; a repeated row repeats all its words, so both lose them. An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = repeated_spans(docs, length)
    joined = _keyed(docs).alias("d").join(found.alias("f"), F.expr(
        "d.doc_id <=> f.doc_id AND d.text_key = f.text_key"), "left").select("d.doc_id", "text", "ranges")
    return joined.mapInArrow(_remove(length), f"doc_id {kind}, n_words long, n_removed long, kept_text string")
