"""Line dedup by pairwise alignment: documents meet through shared rare line hashes, patience diff aligns a document with
the earlier one, and the aligned common blocks go from the later document. What stayed is aligned again until no block is
left, so repeated and crossed passages go as well."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.llm.common import mix, with_text_key, words_of
from gearledger.session import materialise

#: An aligned block goes only if it has at least so many words.
BLOCK_WORDS = 10

#: Scripts written without blanks (Thai, Lao, Burmese, Khmer, Kana, Han): up to two of their characters are a word.
UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]{1,2}"

_FACTOR = 0x9FB21C651E98DF25
_INVERSE = pow(_FACTOR, -1, 2**64)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs that rises on both sides; pairs come by their left side."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[pile], piles[pile] = j, n
    chain = []
    n = piles[-1] if piles else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    return chain[::-1]


def patience(left: list, right: list) -> list[tuple[int, int]]:
    """Pairs of positions of equal items, rising in both lists.

    Common heads and tails are matched first; between them the items that occur once on both sides are put into
    their longest rising order, and the gaps are treated the same way; in a gap without such items the occurrences are
    matched in order, each with the next one on the right. Explicit stack, so length is no limit.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and left[a] == right[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        once = Counter(left[a:b])
        there: dict = {}
        for j, x in enumerate(right[c:d], c):
            if x in once:
                there.setdefault(x, []).append(j)
        chain = _rising([(i, there[x][0]) for i, x in enumerate(left[a:b], a) if once[x] == 1 and len(there.get(x, ())) == 1])
        if not chain:
            j = c
            for i, x in enumerate(left[a:b], a):
                at = there.get(x, ())
                n = bisect_left(at, j)
                if n < len(at):
                    found.append((i, at[n]))
                    j = at[n] + 1
            continue
        i, j = a, c
        for x, y in chain:
            found.append((x, y))
            todo.append((i, x, j, y))
            i, j = x + 1, y + 1
        todo.append((i, b, j, d))
    return sorted(found)


def _blocks(pairs: list[tuple[int, int]], later: list, earlier: list, words: list[int],
            least: int) -> list[tuple[int, int]]:
    """Line ranges of the later document around the pairs, as far as both sides go on equal, of at least so many words."""
    out: list[tuple[int, int]] = []
    covered: dict[int, int] = {}
    for i, j in pairs:
        if i < covered.get(j - i, 0):
            continue
        a, b, shift = i, i + 1, j - i
        while a > 0 and a + shift > 0 and later[a - 1] == earlier[a - 1 + shift]:
            a -= 1
        while b < len(later) and b + shift < len(earlier) and later[b] == earlier[b + shift]:
            b += 1
        covered[shift] = b
        if sum(words[a:b]) >= least:
            out.append((a, b))
    return out


def common_lines(later: list, earlier: list, words: list[int], least: int = BLOCK_WORDS) -> list[int]:
    """Lines of the later document in an aligned block of at least so many words, repeated and crossed ones included.

    The whole document is aligned first. Each stretch that stayed is then aligned on its own with the whole earlier
    document, so a passage that stands crossed or more often than there meets its match. Where that finds no block, the
    lines of the stretch are anchors, the rarest first, at each place that they have in the earlier document. All blocks
    around an anchor are known then, so it is a wall; lines with too few words between walls are left.
    """
    wanted = set(later)
    places: dict = {}
    for j, x in enumerate(earlier):
        if x in wanted:
            places.setdefault(x, []).append(j)
    pairs = set(zip(earlier, earlier[1:]))
    wall = [x not in places for x in later]
    joined = [False, *(x in pairs for x in zip(later, later[1:])), False]
    gone = [False] * len(later)

    def may_go(i: int) -> bool:
        if gone[i] or wall[i]:
            return False
        total, a, b = words[i], i, i + 1
        while total < least and joined[a] and not wall[a - 1]:
            a -= 1
            total += words[a]
        while total < least and joined[b] and not wall[b]:
            total += words[b]
            b += 1
        return total >= least

    def remove(anchors: list[tuple[int, int]]) -> bool:
        found = _blocks(anchors, later, earlier, words, least)
        for x, y in found:
            gone[x:y] = [True] * (y - x)
        return bool(found)

    todo = [(0, len(later))]
    while todo:
        a, b = todo.pop()
        if not any(map(may_go, range(a, b))):
            continue
        if remove([(a + i, j) for i, j in patience(later[a:b], earlier)]):
            start = a
            for i in range(a, b + 1):
                if i == b or gone[i] or wall[i]:
                    if start < i:
                        todo.append((start, i))
                    start = i + 1
            continue
        for i in sorted(range(a, b), key=lambda i: (len(places.get(later[i], ())), i)):
            if may_go(i):
                remove([(i, j) for j in places[later[i]]])
                wall[i] = True
    return [i for i, x in enumerate(gone) if x]


def runs(lines: list, words: list[int], least: int = BLOCK_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and key of the shortest runs of at least so many words that start or end at each line.

    Equal runs have equal keys wherever they stand. Every line of a longer run lies in one of these inside it.
    """
    n, least = len(lines), max(1, least)
    total = np.concatenate([[0], np.cumsum(np.asarray(words, np.int64))])
    ends = np.searchsorted(total, total[:-1] + least)
    starts = np.searchsorted(total, total[1:] - least, "right") - 1
    forward, backward = np.flatnonzero(ends <= n), np.flatnonzero(starts >= 0)
    start = np.concatenate([forward, starts[backward]])
    end = np.concatenate([ends[forward], backward + 1])
    power, undo = (np.append(np.ones(1, np.uint64), np.full(n, x, np.uint64)).cumprod() for x in (_FACTOR, _INVERSE))
    values = mix(np.asarray(lines, np.int64).view(np.uint64) ^ np.uint64(_INVERSE)) * power[:n]
    sums = np.append(np.zeros(1, np.uint64), values.cumsum())
    return start, end, mix((sums[end] - sums[start]) * undo[start])


def _align(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["line_hash", "line_words", "earlier_hash"]).to_pylist()
            removed = [common_lines(r["line_hash"], r["earlier_hash"], r["line_words"], least) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(removed, pa.list_(pa.int32()))],
                names=["doc_id", "text_key", "removed"])

    return run


def rare_runs(lines: list[tuple[int, int, int, int]], least: int = BLOCK_WORDS) -> set[tuple[int, int]]:
    """The rarest line and the key of each shortest run of at least so many words.

    ``lines`` holds place, hash, words and number of occurrences of the lines that other documents have as well; a run
    ends where a place is missing. Of equally rare lines the smaller hash counts.
    """
    out: set[tuple[int, int]] = set()
    places = [x[0] for x in lines]
    cuts = [0, *(n for n in range(1, len(lines)) if places[n] != places[n - 1] + 1), len(lines)]
    for a, b in zip(cuts, cuts[1:]):
        part = lines[a:b]
        if sum(x[2] for x in part) < least:
            continue
        start, end, key = runs([x[1] for x in part], [x[2] for x in part], least)
        for i, j, k in zip(start.tolist(), end.tolist(), key.view(np.int64).tolist()):
            out.add((min((x[3], x[1]) for x in part[i:j])[1], k))
    return out


def _anchors(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sorted(rare_runs([tuple(x.values()) for x in lines], least))
                    for lines in batch.column("lines").to_pylist()]
            owners = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            rare, run_keys = (pa.array([x[i] for k in keys for x in k], pa.int64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owners), batch.column("text_key").take(owners), rare, run_keys],
                names=["doc_id", "text_key", "rare", "run"])

    return run


def line_words(line: Column) -> Column:
    """Number of words of a line; only lines with characters of several bytes are searched for unspaced scripts."""
    wide = F.octet_length(line) >= F.char_length(line) + 2
    return F.size(words_of(F.when(wide, F.regexp_replace(line, UNSPACED, " x ")).otherwise(line)))


def duplicate_lines(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text_key and the positions of the lines that go, one row per document that loses lines.

    The earlier document is the one with the smaller doc_id. Lines that one document has alone are left out first. In each
    shortest run of ``least`` words among the others the rarest line leads: the document meets the first document that
    has this line in such a run, whatever the length of its lines. Where an id has several texts, the pair names the one
    with the run. A line in a third of all documents costs one pair per document at most; a pair is aligned once, however
    many lines lead to it. Lines are judged on the input. A line that goes stands in an earlier document, and the first
    holder of a line never loses it, so no line vanishes everywhere.
    """
    keyed = with_text_key(docs, F.split(F.coalesce("text", F.lit("")), "\n").alias("lines")).where("doc_id IS NOT NULL")
    counted = keyed.select(
        "doc_id", "text_key", F.transform("lines", lambda x: F.xxhash64(x, F.char_length(x))).alias("line_hash"),
        F.transform("lines", line_words).alias("line_words"))
    sequences = materialise(counted.dropDuplicates(["doc_id", "text_key"]), "line-sequences")
    kind = docs.schema["doc_id"].dataType.simpleString()
    single = sequences.select("doc_id", "text_key", F.posexplode(F.arrays_zip("line_hash", "line_words"))).select(
        "doc_id", "text_key", F.col("pos").alias("place"), F.col("col.line_hash").alias("line"),
        F.col("col.line_words").alias("words"))
    known = single.groupBy("line").agg(F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("low"),
                                       F.max("doc_id").alias("high")).where("low < high").select("line", "times")
    common = single.join(known, "line").groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("place", "line", "words", "times"))).alias("lines"))
    anchors = common.mapInArrow(_anchors(least), f"doc_id {kind}, text_key long, rare long, run long")
    anchors = materialise(anchors, "line-anchors")
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    leads = ["rare", "run"]
    shared = anchors.groupBy(*leads).agg(first, F.max("doc_id").alias("latest")).where(
        "first.doc_id < latest").select(
        *leads, F.col("first.doc_id").alias("earlier"), F.col("first.text_key").alias("earlier_key"))
    pairs = anchors.join(shared, leads).where("doc_id > earlier").select(
        "doc_id", "text_key", "earlier", "earlier_key").distinct()
    held = sequences.select(F.col("doc_id").alias("earlier"), F.col("text_key").alias("earlier_key"),
                            F.col("line_hash").alias("earlier_hash"))
    meeting = pairs.join(held, ["earlier", "earlier_key"]).alias("p").join(
        sequences.alias("s"), F.expr("p.doc_id = s.doc_id AND p.text_key = s.text_key")).select(
        "s.doc_id", "s.text_key", "line_hash", "line_words", "earlier_hash")
    aligned = meeting.mapInArrow(_align(least), f"doc_id {kind}, text_key long, removed array<int>")
    return aligned.where(F.size("removed") > 0).groupBy("doc_id", "text_key").agg(
        F.array_distinct(F.flatten(F.collect_list("removed"))).alias("removed"))


def _without(text: str | None, removed: list[int] | None) -> str | None:
    if not removed:
        return text
    gone = set(removed)
    return "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed = batch.column("line_dedup_removed").to_pylist()
        texts = [_without(t, r) for t, r in zip(batch.column("text").to_pylist(), removed)]
        counts = pa.array([len(r or []) for r in removed], pa.int64())
        names = [n for n in batch.schema.names if n not in ("line_dedup_removed", "line_dedup_key")]
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays([*columns, counts], names=[*names, "n_lines_removed"])


def dedup_lines(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """The columns of docs with the duplicated blocks cut out of ``text``, and ``n_lines_removed``.

    Every row stays; a text whose lines all go becomes empty. Null ids take no part and keep their text, null and
    empty texts stay as they are. Rows equal in id and text are one document and lose the same lines; texts under
    one id are never aligned with each other. Blocks under the least number of words stay, so short common lines
    do. An empty table gives an empty result. A column named ``n_lines_removed`` is replaced.
    """
    docs = docs.drop("n_lines_removed")
    removed = duplicate_lines(docs, least)
    keyed = docs.withColumn("line_dedup_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = keyed.alias("d").join(
        removed.select("doc_id", F.col("text_key"), F.col("removed").alias("line_dedup_removed")).alias("r"),
        F.expr("d.doc_id = r.doc_id AND d.line_dedup_key = r.text_key"), "left").select("d.*", "line_dedup_removed")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(_cut, f"{schema}, n_lines_removed long")


def drop_duplicate_lines(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """As ``dedup_lines``, without the documents that lost every word they had; the columns of docs."""
    cut = dedup_lines(docs, least)
    left = (F.col("n_lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cut.where(left).drop("n_lines_removed")


