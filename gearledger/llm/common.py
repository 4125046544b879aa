"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Everything between two words: the ASCII white space of ``bytes.split()``.
WHITE = r"[\x20\x09-\x0D]+"
#: Characters of text that a worker turns into words or arrays at one time, besides a single longer document.
CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def words_of(text: str | Column) -> Column:
    """Array of words; empty for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), WHITE), "")


def with_text_key(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, ``text_key`` and the columns; rows equal in both keys hold the same text and share their results.

    The key makes joins back to a document safe where a ``doc_id`` repeats or is null.
    """
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), *columns)


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def text_chunks(batch: pa.RecordBatch, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts together stay under the limit; a longer text stands alone."""
    sizes = np.asarray(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False))
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def chunked(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds a bounded amount of text."""
    for batch in batches:
        for start, end in text_chunks(batch, limit):
            yield batch.slice(start, end - start)


def word_hashes(words: list[bytes], cache: dict[bytes, int], limit: int = 400_000) -> np.ndarray:
    """64-bit hashes of words; the cache only saves time and is emptied when it is full."""
    import xxhash

    if len(cache) > limit:
        cache.clear()
    fresh = [w for w in set(words) if w not in cache]
    digest = xxhash.xxh3_64_intdigest
    for w in fresh:
        cache[w] = digest(w)
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (multiply and xor-shift rounds)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def gram_hashes_at(hashes: np.ndarray, width: int, places: np.ndarray | int, seed: int = 0) -> np.ndarray:
    """A hash of the run of ``width`` word hashes, by order, at each of the places (or at the first so many)."""
    n = places if isinstance(places, int) else len(places)
    total = np.full(n, np.uint64(seed * 2 + 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF), dtype=np.uint64)
    for i in range(width):
        total ^= hashes[i : i + n] if isinstance(places, int) else hashes[places + i]
        total *= np.uint64(0x9FB21C651E98DF25)
        total ^= total >> np.uint64(29)
    return mix(total)


def gram_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A hash for every run of ``width`` word hashes, by order; empty if there are fewer."""
    return gram_hashes_at(hashes, width, max(0, len(hashes) - width + 1), seed)


def list_numbers(lists: pa.ListArray, field: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the lists and all values of one field of their entries, without a Python object per entry."""
    inner = lists.flatten()
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.struct_field(inner, field).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]), values
