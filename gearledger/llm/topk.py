"""Exact top-k search: tiled matrix products, partial selection per tile, and tree merging of the lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearledger.session import materialise

TILE_ROWS = 4096
QUERY_ROWS = 512
#: Tiles whose lists one task of the first merge level brings together.
FAN_IN = 32
#: Products and their sums stay exact in doubles below this; beyond it whole Python numbers take over.
EXACT = 2.0**53
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1

_TILE = "tile long, n int, dim int, ids binary, cells binary"


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, and no null, infinite or undefined component."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))


def _pack(rows: int, names: tuple[str, str]):
    """Dense tiles of at most so many rows: ids and floor(1024 * x) as doubles, shorter vectors padded with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ids = part.column(names[0]).to_numpy(zero_copy_only=False).astype(np.int64)
                lists = part.column(names[1])
                lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                dim = int(lengths.max()) if len(lengths) else 0
                cells = np.zeros((len(ids), dim))
                if dim:
                    cells[np.arange(dim) < lengths[:, None]] = np.floor(1024.0 * values)
                order = np.argsort(ids, kind="stable")
                ids, cells = ids[order], cells[order]
                mark = int(ids[0]) * 0x9E3779B1 + start & 0x7FFFFFFF
                yield pa.RecordBatch.from_pydict({
                    "tile": pa.array([mark], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
                    "dim": pa.array([dim], pa.int32()), "ids": [ids.tobytes()], "cells": [cells.tobytes()]})

    return run


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products: doubles while every sum is exact, else whole numbers held to the range of a long."""
    dim = min(left.shape[1], right.shape[1])
    left, right = left[:, :dim], right[:, :dim]
    bound = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(dim, 1)
    if bound < EXACT:
        return (left @ right.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in right]
    return np.array([[min(max(sum(int(a) * b for a, b in zip(row, other)), LONG_MIN), LONG_MAX) for other in whole]
                     for row in left], dtype=np.int64).reshape(len(left), len(right))


def best_of_tile(queries: np.ndarray, query_cells: np.ndarray, ids: np.ndarray, cells: np.ndarray,
                 k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the k best rows of the tile, ties to the smaller id; ``ids`` are ascending."""
    scores = _scores(query_cells, cells)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q, row in zip(queries, scores):
        others = np.flatnonzero(ids != q)
        values = row[others]
        if len(values) > k:
            least = np.partition(values, len(values) - k)[len(values) - k]
            above = np.flatnonzero(values > least)
            level = np.flatnonzero(values == least)[: k - len(above)]
            picked = np.concatenate([above, level])
            others, values = others[picked], values[picked]
        found.append((np.full(len(others), q, dtype=np.int64), ids[others], values))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


def _partial(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query = np.frombuffer(row["q_ids"], np.int64)
                ids = np.frombuffer(row["ids"], np.int64)
                got = best_of_tile(query, np.frombuffer(row["q_cells"]).reshape(row["q_n"], row["q_dim"]), ids,
                                   np.frombuffer(row["cells"]).reshape(row["n"], row["dim"]), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[0]), pa.array(got[1]), pa.array(got[2]),
                     pa.array(np.full(len(got[0]), row["tile"] % FAN_IN, dtype=np.int64))],
                    names=["query_id", "vec_id", "score", "branch"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query, by integer inner product.

    Components count as floor(1024 * x). Candidates are all rows but those with the query's own id; vectors that
    are null or hold null or non-finite components take no part. Ties go to the smaller id. Vectors of different
    lengths meet as if padded with zeros. A repeated candidate row counts as often as it stands; of rows that repeat
    a query's id the smallest vector is the query. Scores beyond a long stay at its end. Empty tables give no rows.

    Candidates and queries are packed into dense tiles where they are read; only every pair of a query block and a
    candidate tile is joined, and each gives k rows per query. The blocks are written first, so their size is known
    where Spark chooses between a broadcast and pairs of partitions, and no pair packs them again. A rank window per branch and one over the branches
    merge them; Spark prunes to k rows per query before each exchange.
    """
    both = F.col(id_column).isNotNull() & usable(F.col(vector_column))
    rows = vectors.where(both).select(F.col(id_column).alias("id"), F.col(vector_column).alias("cells"))
    asked = queries.where(both).select(F.col(id_column).alias("id"), F.col(vector_column).alias("cells"))
    asked = asked.groupBy("id").agg(F.min("cells").alias("cells"))
    tiles = rows.mapInArrow(_pack(TILE_ROWS, ("id", "cells")), _TILE)
    blocks = asked.mapInArrow(_pack(QUERY_ROWS, ("id", "cells")), _TILE)
    blocks = materialise(blocks, "query_blocks").select(
        *[F.col(c).alias(f"q_{c}") for c in ("n", "dim", "ids", "cells")])
    partial = tiles.crossJoin(blocks).mapInArrow(
        _partial(k), "query_id long, vec_id long, score long, branch long")
    best = [F.col("score").desc(), F.col("vec_id").asc()]
    in_branch = F.row_number().over(Window.partitionBy("query_id", "branch").orderBy(*best))
    merged = partial.withColumn("place", in_branch).where(F.col("place") <= k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
