"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every row is put into a leaf. A query walks the tree with a priority queue of
the branches it passed by, nearest centre first, and so meets the leaves in an order of its own. How many of them it
visits is widened until the neighbours of some of the queries, known by brute force, are found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gearledger.llm.topk import usable
from gearledger.session import materialise

#: The tree is fitted on at most so many rows, and on fewer where their components are more than so many.
SAMPLE_ROWS = 32_768
SAMPLE_CELLS = 4_194_304
#: A leaf stands for so many rows of the table, as long as the sample has enough rows for each leaf.
LEAF_ROWS = 256
SAMPLE_PER_LEAF = 32
BRANCHES = 8
ROUNDS = 12
#: Queries whose neighbours are looked up by brute force, and the share of those neighbours that the visits must find.
CALIBRATION_ROWS = 256
RECALL = 0.97
#: Candidates and queries of one cell of the search (on average), and queries of one matrix product.
CELL_ROWS = 8_192
PRODUCT_ROWS = 256
#: Products this close to the last place are measured again before places are given.
CLOSE = 1e-9


@dataclass
class Tree:
    """Nodes by number, the root first: centres and numbers of the children, or the number of a leaf."""

    centres: list[np.ndarray | None] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self) -> int:
        self.centres.append(None)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def leaf_of(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of every unit vector, always taking the nearest child."""
        out = np.zeros(len(unit), np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            nearest = _nearest(unit[rows], self.centres[node])
            todo += [(child, rows[nearest == k]) for k, child in enumerate(self.children[node])]
        return out

    def visits(self, unit: np.ndarray, most: int) -> list[int]:
        """The first so many leaves that a query meets, best bin first."""
        out: list[int] = []
        waiting = [(0.0, 0)]
        while waiting and len(out) < most:
            _, node = heapq.heappop(waiting)
            while self.leaf[node] < 0:
                gaps = ((self.centres[node] - unit) ** 2).sum(axis=1)
                nearest = int(np.argmin(gaps))
                for k, child in enumerate(self.children[node]):
                    if k != nearest:
                        heapq.heappush(waiting, (float(gaps[k]), child))
                node = self.children[node][nearest]
            out.append(self.leaf[node])
        return out


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2.0 * rows @ centres.T, axis=1)


def _clusters(rows: np.ndarray, branches: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres by k-means, and the nearest one of every row; centres that no row is nearest to are left out."""
    centres = rows[rng.choice(len(rows), branches, replace=False)]
    for _ in range(ROUNDS):
        nearest = _nearest(rows, centres)
        held = np.unique(nearest)
        moved = np.stack([rows[nearest == k].mean(axis=0) for k in held])
        if moved.shape == centres.shape and np.allclose(moved, centres):
            break
        centres = moved
    return centres, _nearest(rows, centres)


def fit_tree(unit: np.ndarray, leaves: int, seed: int = 11) -> Tree:
    """Tree with about so many leaves over the rows of a sample; the same rows give the same tree."""
    rng = np.random.default_rng(seed)
    tree = Tree()
    least = max(2, len(unit) / max(1, leaves))
    todo = [(tree.add(), unit)]
    while todo:
        node, rows = todo.pop()
        branches = min(BRANCHES, int(len(rows) / least + 0.5))
        if branches >= 2:
            centres, nearest = _clusters(rows, branches, rng)
            parts = [rows[nearest == k] for k in range(len(centres))]
            full = [k for k, part in enumerate(parts) if len(part)]
            if len(full) > 1:
                tree.centres[node] = centres[full]
                tree.children[node] = [tree.add() for _ in full]
                todo += list(zip(tree.children[node], (parts[k] for k in full)))
                continue
        tree.leaf[node] = tree.leaves
        tree.leaves += 1
    return tree


def dense(lists: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones padded with zeros, each scaled by a power of two.

    The scaling keeps every cosine to the last digit and keeps squares of very large or small components in range.
    """
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    cells = np.zeros((len(lengths), dim))
    cells[np.arange(dim) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    _, powers = np.frexp(np.abs(cells).max(axis=1, initial=0.0))
    return np.ldexp(cells, -powers[:, None])


def _units(cells: np.ndarray) -> np.ndarray:
    return cells / np.linalg.norm(cells, axis=1, keepdims=True)


def nearest_of(asked: np.ndarray, cells: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per asked vector the places of at least its k nearest rows by cosine (all that may be among them), and cosines.

    The matrix product only chooses; the cosines are summed pair by pair, so equal vectors have equal ones.
    """
    norms, out = np.linalg.norm(cells, axis=1), []
    for start in range(0, len(asked), PRODUCT_ROWS):
        part = asked[start : start + PRODUCT_ROWS]
        own = np.linalg.norm(part, axis=1)
        near = part @ cells.T / norms / own[:, None]
        for vector, length, row in zip(part, own, near):
            places = np.arange(len(row))
            if len(row) > k:
                places = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k] - CLOSE)
            exact = (cells[places] * vector).sum(axis=1) / (norms[places] * length)
            out.append((places, exact))
    return out


def _vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """The rows that take part: id and vector, rows equal in both once."""
    usable_rows = rows.where(
        F.col(id_column).isNotNull() & usable(F.col(vector_column)) & F.exists(vector_column, lambda x: x != 0))
    return usable_rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("cells"))


def _with_leaf(vectors: DataFrame, tree: Tree, dim: int) -> DataFrame:
    kind = vectors.schema["cells"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf_of(_units(dense(batch.column("cells"), dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())],
                                             names=[*batch.schema.names, "leaf"])

    return vectors.mapInArrow(run, f"ids array<bigint>, cells {kind}, leaf long")


def _with_visits(asked: DataFrame, tree: Tree, dim: int, visits: int, counts: np.ndarray, least: int) -> DataFrame:
    """The leaves that each query visits: so many, and more until they hold ``least`` rows together."""
    kind = asked.schema["cells"].dataType.simpleString()

    def walk(unit: np.ndarray) -> list[int]:
        most = visits
        while True:
            leaves = tree.visits(unit, most)
            if most >= tree.leaves or counts[leaves].sum() >= least:
                return leaves
            most *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = [walk(unit) for unit in _units(dense(batch.column("cells"), dim))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "leaves"])

    return asked.mapInArrow(run, f"id long, cells {kind}, leaves array<bigint>")


def calibrated_visits(held: DataFrame, tree: Tree, dim: int, k: int, recall: float,
                      rows: int = CALIBRATION_ROWS, asked: DataFrame | None = None) -> tuple[int, float]:
    """How many leaves to visit, and the share of the calibration rows' k nearest rows that so many visits find.

    The calibration rows are at most so many queries of ``asked`` (id and cells), chosen by a hash, for queries may lie
    quite unlike the rows at large; without ``asked`` the rows themselves ask. Their neighbours are found by brute force
    over all rows. Leaves are visited one more at a time until the share is reached.
    """
    if asked is None:
        asked = held.select(F.col("ids")[0].alias("id"), "cells")
    sample = asked.select("cells", "id").orderBy(F.xxhash64("id", "cells"), "id").limit(rows).toArrow()
    own = sample.column("id").to_numpy()
    wanted = dense(sample.column("cells").combine_chunks(), dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = batch.column("leaf").to_numpy(zero_copy_only=False)
            # One more than k, because the row's own class may hold the row alone.
            found = nearest_of(wanted, dense(batch.column("cells"), dim), k + 1)
            row = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
            at = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
            score = np.concatenate([x for _, x in found]) if found else np.zeros(0)
            ids = batch.column("ids").take(pa.array(at))
            each = np.repeat(np.arange(len(at)), pc.list_value_length(ids).to_numpy(zero_copy_only=False))
            vec = ids.flatten().to_numpy(zero_copy_only=False)
            other = vec != own[row[each]]
            yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in (row[each], vec, leaf[at[each]], score[each])],
                                             names=["row", "vec", "leaf", "score"])

    place = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec"))
    pairs = held.select("ids", "cells", "leaf").mapInArrow(run, "row long, vec long, leaf long, score double")
    truth = pairs.withColumn("place", place).where(F.col("place") <= k).select("row", "leaf").collect()
    if not truth:
        return tree.leaves, 1.0
    turn = [{leaf: n for n, leaf in enumerate(tree.visits(unit, tree.leaves), 1)} for unit in _units(wanted)]
    found_at = np.bincount([turn[r["row"]][r["leaf"]] for r in truth], minlength=tree.leaves + 1)
    share = np.cumsum(found_at) / len(truth)
    visits = max(1, int(np.argmax(share >= min(recall, 1.0))))
    return visits, float(share[visits])


def _search(k: int, dim: int):
    kinds = [("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())]

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.schema(kinds).empty_table()
        ids = held.column("ids").combine_chunks()
        first = pc.list_element(ids, 0).to_numpy(zero_copy_only=False)
        cells = dense(held.column("cells").combine_chunks(), dim)
        # One more than k, because the query's own class may hold the query alone.
        found = nearest_of(dense(asked.column("cells").combine_chunks(), dim), cells, k + 1)
        query, at, score = [], [], []
        for q, (places, scores) in zip(asked.column("id").to_pylist(), found):
            order = np.lexsort((first[places], -scores))[: k + 1]
            query.append(np.full(len(order), q))
            at.append(places[order])
            score.append(scores[order])
        return pa.Table.from_arrays(
            [pa.array(np.concatenate(query)), ids.take(pa.array(np.concatenate(at))).cast(pa.list_(pa.int64())),
             pa.array(np.concatenate(score))], schema=pa.schema(kinds))

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, recall: float = RECALL, id_column: str = "vec_id",
            vector_column: str = "embedding", leaf_rows: int = LEAF_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest candidates found for every query.

    Candidates are all rows but those with the query's own id. Vectors that are null or zero, or hold null or non-finite
    components, take no part. Ties go to the smaller id. Shorter vectors count as padded with zeros. Rows equal in id and
    vector are one row; of vectors that share an id the smallest asks, and all are candidates. Empty tables give no rows.
    Other columns are not read. A query gets k rows whenever so many other ids stand in the table.

    Equal vectors are one class with its k + 1 smallest ids, which are all that can be among the k nearest of any query,
    so a vector that stands very often costs as much as a single one. The number of visits is fitted on the queries, so
    queries unlike the other rows get their neighbours too. Candidates and queries of a leaf are dealt into
    cells of bounded size, and each cell gives k + 1 classes per query. The sample, the leaf counts and the calibration
    rows are all that passes the driver; all are bounded by the parameters above.
    """
    spark = vectors.sparkSession
    rows = _vectors(vectors, id_column, vector_column).dropDuplicates(["id", "cells"])
    place = F.row_number().over(Window.partitionBy("cells").orderBy("id"))
    classes = materialise(rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("cells").agg(
        F.array_sort(F.collect_list("id")).alias("ids")).select("ids", "cells"), "ann-classes")
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("cells")).alias("dim")).first()
    n, dim = size["n"], size["dim"] or 1
    most = max(1, min(SAMPLE_ROWS, SAMPLE_CELLS // dim))
    sample = classes.orderBy(F.xxhash64("cells"), F.col("ids")[0]).limit(most).select("cells").toArrow()
    leaves = max(1, min(n // leaf_rows, sample.num_rows // SAMPLE_PER_LEAF))
    tree = fit_tree(_units(dense(sample.column("cells").combine_chunks(), dim)), leaves)
    held = materialise(_with_leaf(classes, tree, dim), "ann-leaves")
    asked = materialise(
        _vectors(queries, id_column, vector_column).groupBy("id").agg(F.min("cells").alias("cells")), "ann-queries")
    visits, _ = calibrated_visits(held, tree, dim, k, recall, asked=asked)
    counts = np.zeros(tree.leaves, np.int64)
    for leaf, count in held.groupBy("leaf").count().collect():
        counts[leaf] = count
    asked = materialise(_with_visits(asked, tree, dim, visits, counts, k + 1), "ann-visits")
    visitors = dict(asked.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect())
    # One row per leaf, and their number is bounded by the sample.
    cuts = F.broadcast(spark.createDataFrame(
        [(i, -(-int(c) // cell_rows), -(-visitors.get(i, 0) // cell_rows)) for i, c in enumerate(counts) if c],
        "leaf long, held_cuts long, asked_cuts long"))

    def dealt(frame: DataFrame, own: str, other: str, key: str) -> DataFrame:
        """Rows with the part of their own side and every part of the other one.

        Both parts are longs on both sides: a cogroup takes its keys as they come, and equal numbers of two types are
        hashed to different tasks, where their groups never meet.
        """
        cut = frame.join(cuts, "leaf").where(F.col(f"{other}_cuts") > 0)
        return cut.withColumn(f"{own}_part", F.expr(f"pmod(xxhash64({key}), {own}_cuts)")).withColumn(
            f"{other}_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_cuts") - 1))
        ).drop("held_cuts", "asked_cuts")

    cell = ["leaf", "held_part", "asked_part"]
    questions = dealt(asked.select("id", "cells", F.explode("leaves").alias("leaf")), "asked", "held", "id")
    found = questions.groupBy(*cell).cogroup(dealt(held, "held", "asked", "ids[0]").groupBy(*cell)).applyInArrow(
        _search(k, dim), "query_id long, ids array<bigint>, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc()))
    single = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    return single.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
