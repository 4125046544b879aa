"""MinHash near-dedup by min-max hashing.

Every permutation of a document's shingles gives two values, its minimum and its maximum, so a signature of 2n values
costs n hash evaluations per shingle. Bands of the signature propose pairs, which are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.llm.common import chunked, gram_hashes, mix, word_hashes
from gearledger.llm.components import components
from gearledger.session import materialise

SHINGLE = 5
#: Links need 100 * intersection >= percent * union. Each band holds minimum and maximum of four permutations; a pair
#: at 0.85 misses all of 36 bands, and a pair at 0.80 all of 64 bands, with probability 1e-5.
PERCENT = 85
BANDS = 36
BAND_PERMUTATIONS = 4
#: Buckets up to this size propose all their pairs; larger ones go through their most central member.
SMALL_BUCKET = 8
#: Shingles of one tile of a cluster.
TILE_SHINGLES = 1_000_000
#: Shingles of one bucket in which shared ones are counted, and the least number of buckets.
BUCKET_SHINGLES = 1_000_000
LEAST_BUCKETS = 16
_ROWS = 4096
_BLOCK = 256


@lru_cache(maxsize=4)
def _hashing(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors of the permutations and seeds of the bands."""
    random = np.random.default_rng(20_240)
    factors = random.integers(0, 2**63, bands * BAND_PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 2**63, bands, dtype=np.uint64)


def shingle_set(text: str | None, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, a text without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = word_hashes(words, cache)
    return np.unique(gram_hashes(hashes, min(SHINGLE, len(words)), len(words) if len(words) < SHINGLE else 0)
                     if words else hashes)


def band_keys(shingles: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key per band from the minima and maxima of its permutations; none for an empty set."""
    if not len(shingles):
        return np.empty(0, np.uint64)
    factors, seeds = _hashing(bands)
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for start in range(0, len(shingles), _ROWS):
        values = shingles[start : start + _ROWS, None] * factors
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    both = np.concatenate([low.reshape(bands, -1), high.reshape(bands, -1)], axis=1)
    keys = seeds.copy()
    for column in both.T:
        keys = mix(keys ^ column)
    return keys


def _signatures(bands: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in chunked(batches):
            sets = [shingle_set(t, cache) for t in batch.column("text").to_pylist()]
            first = np.array([int(mix(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets], np.uint64)
            second = np.array([int(mix(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets],
                              np.uint64)
            keys = [band_keys(s, bands) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(first.view(np.int64)),
                 pa.array(second.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "n_shingles", "mark1", "mark2", "bands"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict[bytes, int] = {}
    for batch in chunked(batches):
        sets = [shingle_set(t, cache) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "n", "shingles"])


def _bucketed(buckets: int):
    """Shingles of every node, packed by bucket of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column("node"), batch.column("shingles").to_pylist()):
                values = np.frombuffer(data, np.uint64)
                at = (mix(values) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(at, kind="stable")
                held, starts = np.unique(at[order], return_index=True)
                parts = [x.tobytes() for x in np.split(values[order], starts[1:])] if len(held) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held), pa.array(np.full(len(held), node.as_py(), np.int64)), pa.array(parts, pa.binary())],
                    names=["bucket", "node", "shingles"])

    return run


def _shared_in_bucket(group: pa.Table) -> pa.Table:
    """Per node the number of its shingles in this bucket that another node has as well."""
    sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = np.bincount(owner[times[at] > 1], minlength=len(sets))
    keep = shared > 0
    return pa.table({"node": pa.array(group.column("node").to_numpy()[keep]), "s": pa.array(shared[keep], pa.int64())})


def shared_shingles(sets: DataFrame) -> DataFrame:
    """node and s, the number of its shingles that other nodes of ``sets`` have as well; nodes without any are left out.

    Shingles are dealt by hash into buckets whose number grows with their total, so a bucket stays small however hot a
    shingle is, and a row carries all shingles that a node has in a bucket.
    """
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_SHINGLES))
    dealt = sets.mapInArrow(_bucketed(buckets), "bucket long, node long, shingles binary")
    counted = dealt.groupBy("bucket").applyInArrow(_shared_in_bucket, "node long, s long")
    return counted.groupBy("node").agg(F.sum("s").alias("s"))


def _confirm(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "left", "right").mapInArrow(
        _confirm(percent), "a long, b long")


def _may_link(n_a: str, n_b: str, s_a: str, s_b: str, percent: int) -> Column:
    """False only for pairs that cannot be linked: at most the smaller number of shared shingles is common."""
    most = f"least({s_a}, {s_b})"
    return F.expr(f"100 * {most} >= {percent} * ({n_a} + {n_b} - {most})")


def _ordered(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def links_of(nodes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Confirmed links (a, b) that connect what all links among the band buckets' members connect.

    Buckets of two give their pair straight from the count, buckets of up to SMALL_BUCKET all pairs. In a larger
    bucket every member meets the member with the fewest shingles of its own. Members whose shingles shared with
    anyone are too few for any link leave. What is then in buckets with several components meets in ``across``. So
    nothing is left out, and a hot group of near copies costs rows in proportion to its size, not to its square.
    """
    entries = nodes.select("node", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(
        F.count(F.lit(1)).alias("members"), F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    buckets = materialise(buckets, "buckets")
    crowded = entries.join(buckets.where("members > 2").select("band", "members"), "band")
    crowded = materialise(crowded.distinct(), "crowded")
    few = crowded.where(F.col("members") <= SMALL_BUCKET).groupBy("band").agg(
        F.sort_array(F.collect_set("node")).alias("nodes"))
    few = few.select(F.posexplode("nodes").alias("at", "a"), "nodes").select(
        "a", F.explode(F.slice("nodes", F.col("at") + 2, SMALL_BUCKET)).alias("b"))
    pairs = materialise(buckets.where("members = 2").select("a", "b").union(few).distinct(), "pairs")
    hot = crowded.where(F.col("members") > SMALL_BUCKET).select("band", "node")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(hot.select("node")).distinct()
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(wanted.hint("merge"), "node", "left_semi")
    sets = materialise(texts.mapInArrow(_sets, "node long, n long, shingles binary"), "sets")

    hot_nodes = hot.select("node").distinct()
    own = sets.join(hot_nodes, "node", "left_semi").select("node", "n", "shingles")
    shared = shared_shingles(own)
    central = sets.select("node", "n").join(shared, "node").groupBy("node").agg(
        F.max("n").alias("n"), F.max("s").alias("s")).where(f"100 * s >= {percent} * n")
    members = materialise(hot.join(central, "node"), "hot")
    pivots = members.groupBy("band").agg(F.max(F.struct(
        (F.col("s") / F.col("n")).alias("share"), (-F.col("node")).alias("order"), "n", "s")).alias("p"))
    pivots = pivots.select("band", (-F.col("p.order")).alias("p_node"), F.col("p.n").alias("p_n"),
                           F.col("p.s").alias("p_s"))
    star = members.join(pivots, "band").where("node <> p_node").where(_may_link("n", "p_n", "s", "p_s", percent))
    star = star.select(*_ordered("node", "p_node")).distinct().join(pairs, ["a", "b"], "left_anti")
    tested = materialise(pairs.union(star), "pairs")
    found = materialise(confirm(tested, sets, percent), "confirmed")

    if members.isEmpty():
        return found
    labelled = members.join(components(found), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("band").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("node").alias("a")).where("lo < hi")
    rest = materialise(labelled.join(mixed.select("band", "a"), "band").select("node", "a", "component", "n"), "rest")
    clusters = components(rest.select("a", F.col("node").alias("b"))).withColumnRenamed("component", "cluster")
    return found.union(across(rest.select("node", "component", "n").distinct().join(clusters, "node"), sets, percent))


def _block_links(nodes: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members of different components, by matrix products of blocks of similar set sizes."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    blocks = [order[i : i + _BLOCK] for i in range(0, len(order), _BLOCK)]
    found: list[tuple[int, int]] = []
    for x, left in enumerate(blocks):
        for right in blocks[x:]:
            if 100 * sizes[left[-1]] < percent * sizes[right[0]]:
                break
            both = np.concatenate([left, right])
            row = np.repeat(np.arange(len(both)), sizes[both])
            values, at, times = np.unique(
                np.concatenate([sets[i] for i in both]), return_inverse=True, return_counts=True)
            common = np.cumsum(times > 1) - 1
            use = times[at] > 1
            shared = np.zeros((len(left), len(right)))
            for start in range(0, int((times > 1).sum()), _ROWS):
                here = use & (common[at] >= start) & (common[at] < start + _ROWS)
                cells = np.zeros((len(both), _ROWS), np.float32)
                cells[row[here], common[at[here]] - start] = 1
                shared += cells[: len(left)] @ cells[len(left) :].T
            union = sizes[left][:, None] + sizes[right][None, :] - shared
            linked = (100 * shared >= percent * union) & (labels[left][:, None] != labels[right][None, :])
            found += [(int(nodes[left[i]]), int(nodes[right[j]])) for i, j in zip(*np.nonzero(linked))]
    return found


def across(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Confirmed links between different components of a cluster (columns node, component, n, cluster).

    A cluster is cut into tiles by the amount of its shingles, every pair of tiles is one group, and the pairs of
    documents are compared by matrix products inside it; only links leave it.
    """
    total = members.groupBy("cluster").agg(F.sum("n").alias("total"))
    dealt = members.join(total, "cluster").withColumn(
        "tiles", F.ceil(F.col("total") / TILE_SHINGLES).cast("long")).withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "cluster", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "node", "component")
    grouped = spread.join(sets.select("node", "shingles").hint("merge"), "node").groupBy("cluster", "i", "j")

    def run(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        links = _block_links(nodes, group.column("component").to_numpy(), sets, percent)
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return materialise(grouped.applyInArrow(run, "a long, b long").distinct(), "confirmed")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document; links are pairs of at least so many percent.

    Texts with equal sets are one class, which meets others once however many copies it has. Documents without
    words, null texts and rows without a doc_id are linked with nothing (a null id has a null component and is
    kept). Rows that share a doc_id are one document: they share their component. An empty table gives an empty
    result; only doc_id and text are read.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = materialise(read.mapInArrow(
        _signatures(bands), "doc_id long, n_shingles long, mark1 long, mark2 long, bands array<long>"), "signatures")
    named = marks.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("n_shingles", "mark1", "mark2").agg(
        F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    nodes = materialise(classes, "classes")
    twins = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    links = links_of(nodes, read, percent)
    # A doc_id on several texts ties their classes together.
    ties = named.join(twins, "doc_id").join(nodes.drop("bands"), ["n_shingles", "mark1", "mark2"]).select(
        F.col("doc_id").alias("a"), F.col("node").alias("b"))
    labels = components(links.union(ties))
    known = nodes.drop("bands").join(labels, "node", "left").select(
        "n_shingles", "mark1", "mark2", F.coalesce("component", "node").alias("component"))
    out = marks.drop("bands").join(known, ["n_shingles", "mark1", "mark2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS) -> DataFrame:
    """The documents that stay, one of each group of near copies, with all their columns.

    A row without a doc_id is a document named by its text, and gives way to copies with an id. Of rows equal in id
    and text one stays.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    number = key.bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    named = docs.withColumn("near_dedup_id", F.coalesce(F.col("doc_id").cast("long"), number)).withColumn(
        "near_dedup_key", key)
    found = near_duplicates(named.select(F.col("near_dedup_id").alias("doc_id"), "text"), percent, bands)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("near_dedup_id")).distinct()
    left = named.join(gone, "near_dedup_id", "left_anti").dropDuplicates(["near_dedup_id", "near_dedup_key"])
    return left.drop("near_dedup_id", "near_dedup_key")
