"""Packing documents into token sequences by swap-based local search.

Documents are tokenised once into pieces of at most one sequence. Pieces are dealt into groups of bounded size, and
each group is packed by itself: a best-fit start, then exchanges between underfull bins (a move, one piece for one,
two for one) that increase the sum of squared fills, until bins run empty or no exchange helps.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gearledger.llm.common import chunked
from gearledger.session import materialise

SEQUENCE = 2048
#: Pieces of one group. Groups are packed alone, so each ends with underfull sequences of its own.
GROUP_PIECES = 16_384
#: Exchanges tried per underfull bin of a group before the search ends.
EFFORT = 6
#: Texts with other characters, with white space before a blank, or with a special token go through the full
#: tokenizer; for the rest, blanks start a new token and every blank-led stretch is encoded once.
PLAIN = re.compile("[^\\x00-\\u024f\\u2010-\\u2026]|\\s |<\\|")
CACHE_STRETCHES = 200_000


class Stretches(dict):
    """Token bytes by stretch of text, encoded when first met."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, stretch: str) -> bytes:
        value = self[stretch] = np.array(self.encode(stretch), dtype="<u4").tobytes()
        return value


class TokenBytes:
    """Token ids of whole texts as little-endian unsigned 32-bit numbers, by the byte-level vocabulary."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        quick = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.stretches = Stretches(quick.encode_ordinary)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if PLAIN.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.stretches) > CACHE_STRETCHES:
            self.stretches.clear()
        first, *rest = text.split(" ")
        parts = [first] if first else []
        parts += [" " + x for x in rest]
        return b"".join(map(self.stretches.__getitem__, parts))


@lru_cache(maxsize=1)
def _tokens(vocabulary: str, ranks: str, pattern: str) -> TokenBytes:
    return TokenBytes(vocabulary, ranks, pattern)


def tokenizer_files() -> tuple[str, str, str]:
    """Vocabulary for the full tokenizer, the same vocabulary as ranks, and its splitting pattern."""
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN)


def cut(ids: bytes, limit: int = SEQUENCE) -> list[tuple[int, int, int]]:
    """start, length and crc32 of the pieces of a document; only the first may be shorter than the limit."""
    total = len(ids) // 4
    first = total if total <= limit else (total % limit or limit)
    ends = range(first, total + 1, limit)
    return [(max(0, end - limit) if end > first else 0, min(end, limit) if end > first else first,
             crc32(ids[4 * (max(0, end - limit) if end > first else 0) : 4 * end])) for end in ends]


def pieces(docs: DataFrame, files: tuple[str, str, str] | None = None, limit: int = SEQUENCE, *carry: str) -> DataFrame:
    """doc_id, the carried columns, piece, start, length, ids_crc32 and salt (a running number of the task) of every
    document."""
    files = files or tokenizer_files()
    kept = ["doc_id", *carry]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = _tokens(*files), 0
        for batch in chunked(batches):
            rows: list[tuple] = []
            owners: list[int] = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                got = cut(encode(text or "") + b"\0\0\0\0", limit)
                owners += [i] * len(got)
                rows += [(n, *x) for n, x in enumerate(got)]
            columns = [np.array(x, np.int64) for x in zip(*rows)] if rows else [np.empty(0, np.int64)] * 4
            salt = np.arange(number, number + len(rows))
            number += len(rows)
            own = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(own) for c in kept), pa.array(columns[0].astype(np.int32)),
                 pa.array(columns[1]), pa.array(columns[2]), pa.array(columns[3]), pa.array(salt)],
                names=[*kept, "piece", "start", "length", "ids_crc32", "salt"])

    return docs.select("text", *kept).mapInArrow(
        run, f"{kinds}, piece int, start long, length long, ids_crc32 long, salt long")


def best_fit(lengths: np.ndarray, limit: int) -> np.ndarray:
    """Bin of every piece: longest pieces first, each into the fullest bin that takes it."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            target, room, n = n, limit, n + 1
        bins[i] = target
        left = room - size
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(target)
    return bins


class Exchange:
    """Local search over the pieces of underfull bins; every step increases the sum of squared fills."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, limit: int):
        self.sizes, self.bins, self.limit = lengths, bins, limit
        self.fills = np.bincount(bins, weights=lengths, minlength=int(bins.max(initial=-1)) + 1).astype(np.int64)

    def shift(self, item: int, target: int) -> None:
        self.fills[self.bins[item]] -= self.sizes[item]
        self.fills[target] += self.sizes[item]
        self.bins[item] = target

    def pairs(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of items that share a bin."""
        order = items[np.argsort(self.bins[items], kind="stable")]
        owner = self.bins[order]
        left, right = [], []
        for gap in range(1, len(order)):
            same = np.flatnonzero(owner[gap:] == owner[:-gap])
            if not len(same):
                break
            left.append(order[same])
            right.append(order[same + gap])
        none = np.empty(0, np.int64)
        return (np.concatenate(left), np.concatenate(right)) if left else (none, none)

    def gain(self, source: int, grow: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Change of the squared fills, halved, if the target grows by so much at the source's cost; -1 if unfit."""
        fits = (grow > 0) & (grow <= self.limit - self.fills[target]) & (target != source)
        return np.where(fits, grow * (self.fills[target] - self.fills[source] + grow), -1)

    def step(self, source: int, items: np.ndarray, others: np.ndarray) -> bool:
        """The best exchange that takes something out of the source bin; False if none helps."""
        best, action = 0, None
        open_bins = np.unique(self.bins[others])
        for a in items.tolist():
            size = self.sizes[a]
            moved = self.gain(source, np.full(len(open_bins), size), open_bins)
            if len(moved) and moved.max() > best:
                best, action = moved.max(), ([a], [], open_bins[moved.argmax()])
            swapped = self.gain(source, size - self.sizes[others], self.bins[others])
            if len(swapped) and swapped.max() > best:
                b = int(others[swapped.argmax()])
                best, action = swapped.max(), ([a], [b], self.bins[b])
        if action is None:
            left, right = self.pairs(others)
            sums = self.sizes[left] + self.sizes[right]
            for a in items.tolist():
                traded = self.gain(source, self.sizes[a] - sums, self.bins[left])
                if len(traded) and traded.max() > best:
                    at = int(traded.argmax())
                    best, action = traded.max(), ([a], [int(left[at]), int(right[at])], self.bins[left[at]])
            for a, b in zip(*(x.tolist() for x in self.pairs(items))):
                traded = self.gain(source, self.sizes[a] + self.sizes[b] - self.sizes[others], self.bins[others])
                if len(traded) and traded.max() > best:
                    c = int(others[traded.argmax()])
                    best, action = traded.max(), ([a, b], [c], self.bins[c])
        if action is None:
            return False
        out, back, target = action
        for item in out:
            self.shift(item, int(target))
        for item in back:
            self.shift(item, source)
        return True

    def run(self, effort: int) -> None:
        underfull = self.fills < self.limit
        items = np.flatnonzero(underfull[self.bins])
        steps, stuck = effort * int(underfull.sum()), np.zeros(len(self.fills), bool)
        while steps > 0:
            steps -= 1
            items = items[self.fills[self.bins[items]] < self.limit]
            free = items[~stuck[self.bins[items]]]
            if not len(free):
                break
            owners = self.bins[free]
            source = int(owners[self.fills[owners].argmin()])
            mine = self.bins[items] == source
            if not self.step(source, items[mine], items[~mine]):
                stuck[source] = True


def pack_lengths(lengths: np.ndarray, limit: int = SEQUENCE, effort: int = EFFORT) -> np.ndarray:
    """Bin of every piece, numbered from 0 without gaps."""
    bins = best_fit(lengths, limit)
    search = Exchange(lengths, bins, limit)
    search.run(effort)
    return np.unique(search.bins, return_inverse=True)[1].astype(np.int64)


PACKED = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _filled(order: list[str], limit: int, effort: int, shift: int) -> Callable[[pa.Table], pa.Table]:
    """Packs the pieces of one ``pack_group``, read in the given order; the group is the number's part above the shift."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.sort_by([(c, "ascending") for c in order])
        lengths = rows.column("length").to_numpy().astype(np.int64)
        number = int(rows.column("pack_group")[0].as_py())
        bins = pack_lengths(lengths, limit, effort)
        by_bin = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        first = np.searchsorted(bins[by_bin], np.arange(bins.max() + 1))
        offsets = np.empty(len(bins), np.int64)
        offsets[by_bin] = before - before[first][bins[by_bin]]
        return rows.append_column("sequence_id", pa.array(bins + (number << shift))).append_column(
            "offset", pa.array(offsets)).select(list(PACKED))

    return run


def _packed(dealt: DataFrame, run: Callable[[pa.Table], pa.Table]) -> DataFrame:
    kind = dealt.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("pack_group").applyInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, files: tuple[str, str, str] | None = None, limit: int = SEQUENCE,
         group_pieces: int = GROUP_PIECES, effort: int = EFFORT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    A document is its token ids and a closing id 0; one longer than a sequence is cut, the first piece may be
    shorter. Null and empty texts are the closing id alone. Repeated rows are packed like other documents, null ids
    stay null, an empty table gives an empty result, other columns are not read. Pieces are tokenised once into a
    table in the shared folder; the number of groups follows its row count, and a salt kept in it spreads equal rows.
    """
    cut_pieces = materialise(pieces(docs, files, limit), "pieces")
    groups = max(1, -(-cut_pieces.count() // group_pieces))
    dealt = cut_pieces.withColumn("pack_group", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(groups)))
    return _packed(dealt, _filled(["doc_id", "piece", "ids_crc32", "salt"], limit, effort, 32))


#: Bits of a piece number, and of a document's place in its group of ``GROUP_PIECES``.
PIECE_BITS, PLACE_BITS = 20, 14


def file_order(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns of documents read from files, with ``file`` and ``row`` (the row's number in its file, from 0).

    A frame that no file holds is written to the shared folder first, which keeps its order.
    """
    read = docs if docs.inputFiles() else materialise(docs.select(*columns), "ordered")
    meta = read.metadataColumn("_metadata")
    return read.select(*columns, meta["file_path"].alias("file"), meta["row_index"].alias("row"))


def pack_in_order(docs: DataFrame, files: tuple[str, str, str] | None = None, limit: int = SEQUENCE,
                  group_docs: int = GROUP_PIECES, effort: int = EFFORT) -> DataFrame:
    """The columns of ``pack``, for documents whose files are in training order: sequence numbers follow that order.

    A group holds ``group_docs`` (at most 2 ** ``PLACE_BITS``) consecutive documents, and all sequences of a group come
    before those of the next. Only the first piece of a document may be shorter than a sequence, so only first pieces are
    packed; every further one is a sequence of its own, numbered without a shuffle. Files are ordered by name, as Spark
    numbers them; the window over them holds one row per file. Odd rows are treated as by ``pack``.
    """
    cut_pieces = materialise(pieces(file_order(docs, "doc_id", "text"), files, limit, "file", "row"), "pieces")
    ordered = Window.orderBy(F.char_length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut_pieces.groupBy("file").agg((F.max("row") + 1).alias("rows"))
    before = sizes.select("file", F.coalesce(F.sum("rows").over(ordered), F.lit(0)).alias("before"))
    placed = cut_pieces.join(before, "file").withColumn("place", F.col("before") + F.col("row")).withColumn(
        "pack_group", F.floor(F.col("place") / group_docs).cast("long"))
    shift = PIECE_BITS + PLACE_BITS + 1
    own = (F.shiftleft("pack_group", shift) + F.lit(1 << (shift - 1))
           + F.shiftleft(F.pmod("place", F.lit(group_docs)), PIECE_BITS) + F.col("piece"))
    whole = placed.where("piece > 0").withColumn("sequence_id", own).withColumn("offset", F.lit(0).cast("long"))
    first = placed.where("piece = 0").drop("file", "row", "before", "salt")
    return _packed(first, _filled(["place"], limit, effort, shift)).union(whole.select(*PACKED))
