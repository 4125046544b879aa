"""Quality classifier: supervised subword embeddings.

Words, their character n-grams and word pairs are hashed to buckets, each with a learned vector. A document is the
average of its vectors, and a softmax layer turns it into class probabilities. Vectors and layer are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.llm.common import chunked, gram_hashes, mix

BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4, 5)
EPOCHS = 4
RATE = 1.0
SEED = 7
#: The training sample: at most so many labelled documents, of at most so many characters each.
TRAIN_DOCS = 1500
TRAIN_CHARS = 100_000
THRESHOLD = 0.3
FOLDS = 5
#: Words whose features a worker remembers; the memory is emptied when full and only saves time.
CACHE_WORDS = 150_000
#: New words whose features a worker holds as arrays at one time; words of a text, or bytes of a long word, likewise.
SLICE_WORDS = 4_000
SLICE = 32_768
#: Bytes of a text that are split into words at one time, besides a single longer word.
PIECE_BYTES = 1_000_000
#: Bucket of a word that repeats the word before it, whatever the word is.
SAME = 0


def fold(doc_id: str | Column) -> Column:
    """Remainder that puts a document into its fold; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (1 + (hashes >> np.uint64(33)) % np.uint64(BUCKETS - 1)).astype(np.int64)


def word_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its hash; then the buckets of all words, each word and the byte n-grams of the word between two
    marks, word after word, and the number of buckets of each."""
    marked = [b"<" + w + b">" for w in words]
    marks = np.fromiter(map(crc32, marked), np.uint64, len(marked))
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), lengths)
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))
    owners, hashes = [np.arange(len(marked))], [mix(marks)]
    for n in GRAMS:
        grams = gram_hashes(data, n, n)
        whole = room[: len(grams)] >= n
        owners.append(owner[: len(grams)][whole])
        hashes.append(grams[whole])
    every = np.concatenate(owners)
    order = np.argsort(every, kind="stable")
    return marks, _buckets(np.concatenate(hashes)[order]), np.bincount(every, minlength=len(marked))


def pair_buckets(marks: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words from the hashes of the words."""
    left, right = marks[:-1], marks[1:]
    mixed = (left * np.uint64(0x9E3779B97F4A7C15) + right) * np.uint64(0xD6E8FEB86659FD93)
    out = _buckets(mixed)
    out[left == right] = SAME
    return out


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its features."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    distinct = list(dict.fromkeys(words))
    place = {w: i for i, w in enumerate(distinct)}
    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    marks, flat, sizes = word_buckets(distinct)
    times = np.repeat(np.bincount(at, minlength=len(distinct)), sizes)
    every = np.concatenate([np.repeat(flat, times), pair_buckets(marks[at])])
    buckets, counts = np.unique(every, return_counts=True)
    return buckets, counts / max(1, len(every))


@dataclass
class Model:
    """Vectors of the buckets, softmax layer and bias."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def probability(self, average: np.ndarray) -> float:
        """Probability of label 1 of an averaged document."""
        z = self.layer @ average + self.bias
        return float(1.0 / (1.0 + np.exp(np.clip(z[0] - z[1], -700, 700))))


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Stochastic gradient descent over single documents with a falling rate; same input, same model.

    Without documents, or with one class only, the bias carries the share of the classes.
    """
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), np.zeros((2, DIM)), np.zeros(2))
    features = [text_features(t) for t in texts]
    steps, done = max(1, epochs * len(texts)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            ids, shares = features[i]
            step = rate * (1 - done / steps)
            done += 1
            average = shares @ model.vectors[ids] if len(ids) else np.zeros(DIM)
            z = model.layer @ average + model.bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[labels[i]] -= 1.0
            back = model.layer.T @ error
            model.layer -= step * np.outer(error, average)
            model.bias -= 0.1 * step * error
            if len(ids):
                # The square root lifts rare features, whose share of a long document is tiny.
                model.vectors[ids] -= step * np.outer(np.sqrt(shares), back)
    return model


def word_lists(text: str | None, limit: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists of a bounded number of bytes; a list ends at white space."""
    data = (text or "").encode("utf-8", "surrogatepass")
    start = 0
    while len(data) - start > limit:
        gap = re.compile(rb"[\x20\x09-\x0D]").search(data, start + limit)
        if gap is None:
            break
        yield data[start : gap.start()].split()
        start = gap.end()
    yield data[start:].split()


class Scorer:
    """Scores texts with a model, remembering the summed vectors of words.

    Vectors are held as single floats and summed as doubles, new words are learnt in slices, and long texts and long words
    are summed piece by piece, so memory grows neither with a text nor with the number of texts.
    """

    def __init__(self, model: Model):
        self.model = model
        self.vectors = model.vectors.astype(np.float32)
        self.rows: dict[bytes, int] = {}
        self.sums = np.zeros((1024, DIM), np.float32)
        self.marks = np.zeros(1024, np.uint64)
        self.sizes = np.zeros(1024, np.int64)

    def _room(self, end: int) -> None:
        while end > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            self.marks = np.concatenate([self.marks, np.zeros_like(self.marks)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])

    def learn(self, words: set[bytes]) -> None:
        """Remember the words; a memory that would get too large is emptied first."""
        fresh = [w for w in words if w not in self.rows]
        if len(self.rows) + len(fresh) > CACHE_WORDS and self.rows:
            self.rows.clear()
            fresh = list(words)
        short = [w for w in fresh if len(w) <= SLICE]
        for start in range(0, len(short), SLICE_WORDS):
            self._learn_slice(short[start : start + SLICE_WORDS])
        for word in fresh:
            if len(word) > SLICE:
                self._learn_long(word)

    def _learn_slice(self, words: list[bytes]) -> None:
        start, end = len(self.rows), len(self.rows) + len(words)
        self._room(end)
        marks, flat, sizes = word_buckets(words)
        cuts = np.cumsum(sizes) - sizes
        self.sums[start:end] = np.add.reduceat(self.vectors[flat], cuts, dtype=np.float64)
        self.marks[start:end], self.sizes[start:end] = marks, sizes
        self.rows.update(zip(words, range(start, end)))

    def _learn_long(self, word: bytes) -> None:
        """As for other words; the n-grams of stretches that overlap by all but one byte of a gram are those of the word."""
        at = len(self.rows)
        self._room(at + 1)
        marked = b"<" + word + b">"
        mark = np.array([crc32(marked)], np.uint64)
        total, size = self.vectors[_buckets(mix(mark))].sum(axis=0, dtype=np.float64), 1
        for n in GRAMS:
            for start in range(0, len(marked) - n + 1, SLICE):
                part = np.frombuffer(marked[start : start + SLICE + n - 1], np.uint8).astype(np.uint64)
                grams = _buckets(gram_hashes(part, n, n))
                total += self.vectors[grams].sum(axis=0, dtype=np.float64)
                size += len(grams)
        self.sums[at], self.marks[at], self.sizes[at] = total, mark[0], size
        self.rows[word] = at

    def score(self, lists: Iterable[list[bytes]]) -> float:
        """Score of a text from its lists of words; new words are learnt list by list."""
        total, size, last = np.zeros(DIM), 0, None
        for words in lists:
            for start in range(0, len(words), SLICE):
                part = words[start : start + SLICE]
                try:
                    at = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
                except KeyError:
                    self.learn(set(part))
                    at = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
                marks = self.marks[at]
                pairs = pair_buckets(marks if last is None else np.concatenate([last, marks]))
                last = marks[-1:]
                total += self.sums[at].sum(axis=0, dtype=np.float64)
                total += self.vectors[pairs].sum(axis=0, dtype=np.float64)
                size += int(self.sizes[at].sum()) + len(pairs)
        return self.model.probability(total / max(1, size))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Scores of a bounded amount of text, or of a single longer one; new words of several texts are learnt together."""
        if len(texts) == 1:
            return [self.score(word_lists(texts[0]))]
        lists = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        self.learn(set().union(*lists))
        return [self.score([words]) for words in lists]


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> list:
    """At most ``limit`` rows of text and quality outside the held-out fold, chosen by a hash of their id.

    A document with several labels counts with the lowest. The ids are chosen from the labels alone, so only the
    sample's texts travel.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(fold("doc_id") != 0)
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    short = docs.where(F.char_length("text") <= TRAIN_CHARS).select("doc_id", "text")
    rows = short.join(chosen, "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.min("quality").alias("quality"))
    return sorted(rows.collect())


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                    train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, score in [0, 1] and predicted of every document.

    The score uses the text only. Null and empty texts get the score of the bias. Repeated rows get equal scores.
    Without any usable label every score is 0.5; an empty table gives an empty result; other columns are not read.
    """
    sample = training_sample(docs, labels, train_docs)
    model = train([r["text"] for r in sample], [r["quality"] for r in sample])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in chunked(batches):
            scores = scorer.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    read = docs.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The documents predicted 1, with all their columns; otherwise as ``score_documents``."""
    sample = training_sample(docs, labels, train_docs)
    model = train([r["text"] for r in sample], [r["quality"] for r in sample])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in chunked(batches):
            good = [x >= threshold for x in scorer.scores(batch.column("text").to_pylist())]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
