"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans. The random field reads islands of neighbouring words that hold a digit or an @,
scores every run of up to MAX_UNITS words as a whole span of each kind, and a dynamic program over these bounded
entities chooses boundaries and kinds together. It learns from the base spans of a bounded sample and from variants
of them that the patterns miss, and adds the spans it finds beside the base ones.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gearledger.llm.common import chunked

KINDS = ("email", "ip", "card", "phone")
MAX_UNITS = 6
#: Training: at most so many documents of at most so many characters, and passes over their islands.
TRAIN_DOCS = 600
TRAIN_CHARS = 50_000
#: What a text shows where it may hold a kind; looser than the patterns, only to draw training texts by.
SIGNS = {"email": "[A-Za-z0-9._%+-]@[A-Za-z0-9-]+[.][A-Za-z0-9-]", "ip": "[0-9][.][0-9]+[.][0-9]+[.][0-9]",
         "card": "[0-9](?:[ -]?[0-9]){11}", "phone": "[+][0-9][ ().0-9-]+[0-9]"}
EPOCHS = 6
RATE = 0.2
#: An added span needs at least this margin over reading its words as nothing.
MARGIN = 4.0

Span = tuple[str, int, int]

# Fixed patterns. Possessive repeats and the look-behind change no match; they keep long runs of digits linear.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SEEDS = re.compile(r"[0-9@]+")
WHITE = frozenset(" \t\n\x0b\f\r")
DIGITS = re.compile(r"[0-9]")
QUAD = re.compile(r"[0-9]{1,3}([.\-_][0-9]{1,3}){3}")
EDGE = "\"'()[]{}<>,;:!?."


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in re.split(r"[^0-9]", text))


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches: at each @ the local part reaches back over its characters to the end of the match before."""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            yield "email", start, match.end()
            at = end = match.end()
        else:
            at += 1
            end = max(end, at)


def base_spans(text: str) -> list[Span]:
    """Pattern spans by start, then kind."""
    found = list(emails(text)) if "@" in text else []
    if DIGITS.search(text):
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if small_parts(m.group())]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGITS.findall(m.group())) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def islands(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words with a digit or an @ that stand one white space apart."""
    out: list[list[tuple[int, int]]] = []
    end = -1
    for m in SEEDS.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > max(end, 0) and text[start - 1] not in WHITE:
            start -= 1
        stop = m.end()
        while stop < len(text) and text[stop] not in WHITE:
            stop += 1
        if out and start - end <= 1:
            out[-1].append((start, stop))
        else:
            out.append([(start, stop)])
        end = stop
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without punctuation at its edges; an opening bracket that is closed inside stays."""
    while end > start and text[end - 1] in EDGE and not (text[end - 1] == ")" and "(" in text[start:end]):
        end -= 1
    while start < end and text[start] in EDGE and not (text[start] == "(" and ")" in text[start:end]):
        start += 1
    return start, end


FEATURES = (
    "bias", "units1", "units2", "units3", "units4+", "letters", "one@", "many@", "dotted-domain", "local-part",
    "quad", "quad-small", "plus", "digits0-8", "digits9", "digits10", "digits11", "digits12", "digits13-15",
    "digits16", "digits17-19", "digits20+", "luhn", "brackets", "groups3-3-4", "groups4", "dots", "dashes", "blanks",
    "phone-signs", "card-signs", "odd-signs",
)
_AT = {name: i for i, name in enumerate(FEATURES)}


def span_features(span: str, units: int) -> list[int]:
    """Features of a whole candidate span."""
    on = ["bias", f"units{units}" if units < 4 else "units4+"]
    digits = "".join(DIGITS.findall(span))
    n = len(digits)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    if re.search(r"[^\W\d_]", span):
        on.append("letters")
    if "@" in span:
        on.append("one@" if span.count("@") == 1 else "many@")
        if DOMAIN.search(span):
            on.append("dotted-domain")
        if span[0] in LOCAL_CHARS:
            on.append("local-part")
    if QUAD.fullmatch(span):
        on += ["quad", *(["quad-small"] if small_parts(span) else [])]
    if span.startswith("+"):
        on.append("plus")
    on.append("digits0-8" if n < 9 else f"digits{n}" if n in (9, 10, 11, 12, 16) else "digits13-15" if n < 16
              else "digits17-19" if n < 20 else "digits20+")
    if 12 <= n <= 19 and luhn(digits):
        on.append("luhn")
    if "(" in span and ")" in span:
        on.append("brackets")
    if groups[-3:] == [3, 3, 4]:
        on.append("groups3-3-4")
    if len(groups) > 2 and set(groups[:-1]) == {4}:
        on.append("groups4")
    on += [name for sign, name in ((".", "dots"), ("-", "dashes"), (" ", "blanks")) if sign in span]
    on.append("card-signs" if re.fullmatch(r"[0-9][0-9 .\-]*", span) else
              "phone-signs" if re.fullmatch(r"[+(]?[0-9][0-9 ().+\-/]*", span) else "odd-signs")
    return [_AT[x] for x in on]


@dataclass
class Field:
    """Weights of the kinds over span features, and of a kind following another; kind 0 is nothing."""

    weights: np.ndarray
    follow: np.ndarray

    @classmethod
    def empty(cls) -> Field:
        k = len(KINDS) + 1
        return cls(np.zeros((k, len(FEATURES))), np.zeros((k + 1, k)))


def candidates(text: str, units: list[tuple[int, int]]) -> dict[tuple[int, int], list[int]]:
    """Features of every run of at most MAX_UNITS units."""
    out = {}
    for i in range(len(units)):
        for j in range(i + 1, min(len(units), i + MAX_UNITS) + 1):
            start, end = trimmed(text, units[i][0], units[j - 1][1])
            out[i, j] = span_features(text[start:end], j - i) if end > start else [0]
    return out


def lattice(field: Field, n: int, features: dict) -> dict[tuple[int, int], np.ndarray]:
    """Scores of all kinds for every candidate; runs of several units cannot be nothing."""
    out = {}
    for key, on in features.items():
        score = field.weights[:, on].sum(axis=1)
        if key[1] - key[0] > 1:
            score[0] = -np.inf
        out[key] = score
    return out


def decode(field: Field, text: str, units: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The best segmentation as (first unit, end unit, kind); ties prefer nothing."""
    n, k = len(units), len(KINDS) + 1
    scores = lattice(field, n, candidates(text, units))
    best = np.full((n + 1, k + 1), -np.inf)
    best[0, k] = 0.0
    back: dict[tuple[int, int], tuple[int, int]] = {}
    for j in range(1, n + 1):
        for i in range(max(0, j - MAX_UNITS), j):
            for kind in range(k):
                gain = scores[i, j][kind]
                if gain == -np.inf:
                    continue
                before = best[i] + field.follow[:, kind] if i else np.where(np.arange(k + 1) == k, field.follow[k, kind], -np.inf)
                last = int(before.argmax())
                if before[last] + gain > best[j, kind]:
                    best[j, kind] = before[last] + gain
                    back[j, kind] = (i, last)
    j, kind = n, int(best[n, :k].argmax())
    out = []
    while j > 0:
        i, last = back[j, kind]
        out.append((i, j, kind))
        j, kind = i, last
    return out[::-1]


def gradient_step(field: Field, text: str, units: list[tuple[int, int]], gold: list[tuple[int, int, int]],
                  rate: float) -> None:
    """One step up the conditional log-likelihood, by forward and backward sums over all segmentations."""
    n, k = len(units), len(KINDS) + 1
    features = candidates(text, units)
    scores = lattice(field, n, features)
    forward = np.full((n + 1, k + 1), -np.inf)
    forward[0, k] = 0.0
    for j in range(1, n + 1):
        for i in range(max(0, j - MAX_UNITS), j):
            into = np.logaddexp.reduce(forward[i][:, None] + field.follow, axis=0) + scores[i, j]
            forward[j, :k] = np.logaddexp(forward[j, :k], into)
    backward = np.full((n + 1, k + 1), -np.inf)
    backward[n, :k] = 0.0
    for i in range(n - 1, -1, -1):
        for j in range(i + 1, min(n, i + MAX_UNITS) + 1):
            out = np.logaddexp.reduce(field.follow + (scores[i, j] + backward[j, :k])[None, :], axis=1)
            backward[i] = np.logaddexp(backward[i], out)
    total = np.logaddexp.reduce(forward[n, :k])
    weights, follow = np.zeros_like(field.weights), np.zeros_like(field.follow)
    for (i, j), on in features.items():
        share = np.exp(forward[i][:, None] + field.follow + (scores[i, j] + backward[j, :k])[None, :] - total)
        share = np.nan_to_num(share)
        follow -= share
        weights[:, on] -= share.sum(axis=0)[:, None]
    before = k
    for i, j, kind in gold:
        weights[kind, features[i, j]] += 1.0
        follow[before, kind] += 1.0
        before = kind
    field.weights += rate * weights - rate * 1e-3 * field.weights
    field.follow += rate * follow - rate * 1e-3 * field.follow


def gold_of(text: str, units: list[tuple[int, int]], spans: list[Span]) -> list[tuple[int, int, int]] | None:
    """Segmentation of an island by given spans; None where a span does not end at trimmed word edges."""
    inside = sorted((s, e, KINDS.index(kind) + 1) for kind, s, e in spans if s < units[-1][1] and e > units[0][0])
    out, at = [], 0
    for start, end, kind in inside:
        first = next((i for i in range(at, len(units)) if units[i][1] > start), None)
        if first is None:
            return None
        last = next((i for i in range(first, len(units)) if units[i][1] >= end), None)
        if last is None or last + 1 - first > MAX_UNITS or trimmed(text, units[first][0], units[last][1]) != (start, end):
            return None
        out += [(i, i + 1, 0) for i in range(at, first)] + [(first, last + 1, kind)]
        at = last + 1
    return out + [(i, i + 1, 0) for i in range(at, len(units))]


def variants(span: str, kind: str) -> list[tuple[str, str | None]]:
    """Writings of a span that the patterns miss, and near misses that are nothing (kind None)."""
    digits = "".join(DIGITS.findall(span))
    out: list[tuple[str, str | None]] = []
    if kind == "phone" and len(digits) == 11:
        a, b, c = digits[1:4], digits[4:7], digits[7:]
        out += [(f"({a}) {b}-{c}", "phone"), (f"{a}-{b}-{c}", "phone"), (f"{digits[0]} ({a}) {b}-{c}", "phone"),
                (f"{a}.{b}.{c}", "phone"), (f"{a}{b}", None), (f"{a}-{b}", None), (digits[:10], None)]
    if kind == "card":
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        out += [(".".join(four), "card"), (wrong, None), (f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", None)]
    if kind == "ip":
        out += [(span.replace(".", "-"), None), (".".join(span.split(".")[:3]), None), (span.split(".")[0] + "9" * 3 + span, None)]
    if kind == "email":
        out += [(span.replace("@", "@@"), None), (span.split("@")[0] + "@", None), ("@" + span.split("@")[1], None)]
    return out


def train(texts: list[str], epochs: int = EPOCHS, rate: float = RATE) -> Field:
    """Field from the islands of the texts and the variants of their spans; same texts, same field."""
    examples = []
    for text in texts:
        spans = base_spans(text)
        for units in islands(text):
            gold = gold_of(text, units, spans)
            if gold is not None and len(units) <= 4 * MAX_UNITS:
                examples.append((text, units, gold))
        for kind, start, end in spans:
            for other, label in variants(text[start:end], kind):
                units = [u for x in islands(other) for u in x]
                if label and len(units) <= MAX_UNITS:
                    examples.append((other, units, [(0, len(units), KINDS.index(label) + 1)]))
                elif not label:
                    examples.append((other, units, [(i, i + 1, 0) for i in range(len(units))]))
    field, rng = Field.empty(), np.random.default_rng(11)
    for epoch in range(epochs):
        for i in rng.permutation(len(examples)):
            gradient_step(field, *examples[i], rate / (1 + epoch))
    return field


def added_spans(field: Field, text: str, base: list[Span]) -> list[Span]:
    """Spans the field finds clear of every base span; linear in the words and base spans."""
    out = []
    # Base spans of different kinds may overlap: as disjoint stretches in order, one search tells what meets a range.
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((b, e) for _, b, e in base):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def taken(start: int, end: int) -> bool:
        at = bisect_left(starts, end)
        return at > 0 and ends[at - 1] > start

    for units in islands(text):
        if all(taken(*unit) for unit in units):
            continue
        for i, j, kind in decode(field, text, units):
            if not kind:
                continue
            start, end = trimmed(text, units[i][0], units[j - 1][1])
            if taken(start, end):
                continue
            whole = field.weights[:, span_features(text[start:end], j - i)].sum(axis=1)
            apart = sum(field.weights[0, span_features(text[a:b], 1)].sum() for a, b in units[i:j])
            if whole[kind] - apart >= MARGIN:
                out.append((KINDS[kind - 1], start, end))
    return out


def training_texts(docs: DataFrame, limit: int = TRAIN_DOCS) -> list[str]:
    """Texts of at most ``limit`` documents: an equal number for each kind whose signs they show, and as many with digits
    or an @ only, each chosen by a hash of their id. So a rare kind is learnt however common the others are. Texts over
    ``TRAIN_CHARS`` characters are not drawn."""
    able = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]")
                      & (F.char_length("text") <= TRAIN_CHARS))
    shown = F.array_compact(F.array(*[F.when(F.col("text").rlike(sign), F.lit(kind)) for kind, sign in SIGNS.items()]))
    drawn = able.select("doc_id", F.explode(F.when(F.size(shown) > 0, shown).otherwise(F.array(F.lit("none")))).alias("kind"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = drawn.distinct().withColumn("place", place).where(F.col("place") <= limit // (len(SIGNS) + 1))
    rows = able.select("doc_id", "text").join(ids.select("doc_id").distinct(), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"))
    return [r["text"] for r in sorted(rows.collect())]


def find_private(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, base and spans of every document, as arrays of kind, start and end in code points.

    ``base`` holds the pattern spans, ``spans`` those and the added ones, each by start and kind. Null and empty texts
    have none. Rows are read one by one, so repeated rows agree and an empty table gives an empty result; other
    columns are not read. Without any base span in the sample the field adds nothing.
    """
    field = train(training_texts(docs, train_docs))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches):
            base, every = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                more = spans + added_spans(shared.value, text or "", spans)
                more.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                every.append([dict(zip(("kind", "start", "end"), s)) for s in more])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(entry)), pa.array(every, pa.list_(entry))],
                names=["doc_id", "base", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base {spans}, spans {spans}")
