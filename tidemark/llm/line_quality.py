"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own bytes and of its two neighbours.  The chain
labels each line good or bad; forward-backward gives the probability that it is
good, and the length-weighted mean of these over a document, put through a
logistic curve, is the document's score.

Learning: lines inherit the label of their document.  At most ``max_docs``
labelled documents of the learning part - those whose crc32 of ``doc_id`` modulo
3 is not 1 - are gathered on the driver, the first by a hash of the id, each with
its whole text, up to ``max_bytes`` and ``max_lines`` in total.  This bounds what the
driver holds.  A text of over a sixteenth of either is not learned from.  A text
of very many lines is scored in blocks of lines, with the messages carried exactly.
Only text enters the features; labels, language, source and id do not.

Rows: a null text is scored like an empty one, as one empty line; repeated rows
get equal scores; a null ``doc_id`` is never learned from; if no labelled row
is left, every score is 0.5; an empty table gives an empty result; other columns
are kept by :func:`score` unless they have the name of its result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import crf
from .common import small, table, thinned
from .flat import bytes_of, parts

MAX_DOCS, MAX_BYTES, MAX_LINES = 4000, 16 << 20, 200_000
#: Lines decoded at once.
LINES = 1 << 14
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b".,;:?'\"()-", b"#*$%&|<>", b"!", b"@/\\_=+~^`[]{}", bytes(range(128, 256))]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _chars in enumerate(_CLASSES):
    _CLASS_OF[list(_chars)] = _k


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every line, and lines of each row; a row has one line more than newlines."""
    breaks = np.flatnonzero(data == 10)
    per_row = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.cumsum(per_row) - per_row
    starts = np.zeros(int(per_row.sum()), np.int64)
    starts[first] = offsets[:-1]
    rest = np.ones(len(starts), bool)
    rest[first] = False
    starts[rest] = breaks + 1
    ends = np.zeros(len(starts), np.int64)
    ends[first + per_row - 1] = offsets[1:]
    stop = np.ones(len(starts), bool)
    stop[first + per_row - 1] = False
    ends[stop] = breaks
    return starts, ends, per_row


def own_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Features of each line's own bytes."""
    low, high = (int(starts[0]), int(ends[-1])) if len(starts) else (0, 0)
    data, starts, ends = data[low:high], starts - low, ends - low
    size = ends - starts
    kinds = _CLASS_OF[data]
    count = np.zeros((len(starts), len(_CLASSES)))
    for k in range(len(_CLASSES)):
        total = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)])
        count[:, k] = total[ends] - total[starts]
    raw, squeezed = data.tobytes(), np.zeros(len(starts))
    for i in np.flatnonzero(size > 24):
        squeezed[i] = len(zlib.compress(raw[starts[i] : ends[i]], 1))
    n = np.maximum(size, 1)
    words = count[:, 3] + 1
    letters = np.maximum(count[:, 0] + count[:, 1], 1)
    return np.column_stack([
        np.log1p(size),
        count[:, [0, 2, 3, 4, 5, 6, 7, 8]] / n[:, None],
        count[:, 0] / letters,
        np.minimum((size - count[:, 3]) / words, 40),
        np.minimum(count[:, 5] / words, 4),
        np.minimum(count[:, 6] / words, 4),
        np.where(size > 24, squeezed / n, 0.6),
        np.where(size > 24, np.minimum(np.log(n / np.maximum(squeezed, 1)), 4), 0),
        size == 0,
    ]).astype(float)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x F) of all lines and their neighbours, bytes of each line, and lines of each row."""
    starts, ends, per_row = line_bounds(data, offsets)
    own = own_features(data, starts, ends)
    first = np.cumsum(per_row) - per_row
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first] = 0
    after[first + per_row - 1] = 0
    return np.hstack([own, before, after]), ends - starts, per_row


def block_features(data: np.ndarray, lines: tuple[np.ndarray, np.ndarray, bool, bool]) -> np.ndarray:
    """The same for a block of lines of one row; ``lines``: starts and ends with one line around, and whether there is one before and after."""
    starts, ends, has_before, has_after = lines
    own = own_features(data, starts, ends)
    blank = np.zeros((1, own.shape[1]))
    own = np.vstack([*([] if has_before else [blank]), own, *([] if has_after else [blank])])
    return np.hstack([own[1:-1], own[:-2], own[2:]])


class Scorer:
    """A fitted chain and the curve from the mean line probability to a score."""

    def __init__(self, model: crf.Model | None, slope: float = 1.0, shift: float = 0.0):
        self.model, self.slope, self.shift = model, slope, shift

    @staticmethod
    def learn(texts: list[str], labels: list[int]) -> Scorer:
        if len(set(labels)) < 2:
            return Scorer(None)
        batch = pa.record_batch([pa.array(texts, pa.large_string())], ["text"])
        found = [line_features(*bytes_of(p.column(0))) for p in parts(batch, 0)]  # temporaries stay small
        x, size, per_row = (np.concatenate(a) for a in zip(*found))
        truth = np.array(labels, np.int64)
        scorer = Scorer(crf.fit(x, np.repeat(truth, per_row), per_row, 2))
        raw = scorer._raw(x, size, per_row)
        for _ in range(400):  # Newton steps with a ridge
            p = 1 / (1 + np.exp(-(scorer.slope * raw + scorer.shift)))
            q, d = p * (1 - p), truth - p
            g = np.array([d @ raw - 1e-2 * (scorer.slope - 1), d.sum() - 1e-2 * scorer.shift])
            h = np.array([[q @ (raw * raw) + 1e-2, q @ raw], [q @ raw, q.sum() + 1e-2]])
            move = np.linalg.solve(h, g)
            scorer.slope, scorer.shift = scorer.slope + move[0], scorer.shift + move[1]
            if abs(move).max() < 1e-9:
                break
        return scorer

    def _raw(self, x: np.ndarray, size: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        good = crf.forward_backward(self.model.unary(x), self.model.transitions, per_row)[0][:, 1]
        weight = size + 1.0
        first = np.cumsum(per_row) - per_row
        return _logit(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first))

    def _raw_of_long(self, data: np.ndarray, block: int) -> float:
        """The same for one row, in blocks of lines: forward through all, then backward with each block's features made again."""
        at, bounds = 0, []  # every block's place among the lines, as (first byte, end) with its neighbours
        edges = np.concatenate([[-1], np.flatnonzero(data == 10), [len(data)]])
        for at in range(0, len(edges) - 1, block):
            bounds.append((at, min(at + block, len(edges) - 1)))

        def unary(a: int, b: int) -> np.ndarray:
            low, high = max(0, a - 1), min(len(edges) - 1, b + 1)
            lines = edges[low:high] + 1, edges[low + 1 : high + 1], a > 0, b < len(edges) - 1
            return self.model.unary(block_features(data, lines))

        before, vector = [], None
        for a, b in bounds:
            before.append(vector)
            vector = crf.forward(unary(a, b), self.model.transitions, vector)[-1]
        total, weights, after = 0.0, 0.0, np.ones(2)
        for (a, b), vector in zip(bounds[::-1], before[::-1]):
            scores = unary(a, b)
            behind, after = crf.backward(scores, self.model.transitions, after)
            both = crf.forward(scores, self.model.transitions, vector) * behind
            weight = np.diff(edges[a : b + 1]).astype(float)  # bytes of the line and one
            total += float(both[:, 1] / both.sum(axis=1) @ weight)
            weights += float(weight.sum())
        return float(_logit(np.array(total / weights)))

    def __call__(self, column: pa.Array, block: int = LINES) -> np.ndarray:
        """Scores of all rows; a row of more than ``block`` lines is decoded in blocks of that many, with the same result."""
        if self.model is None or not len(column):
            return np.full(len(column), 0.5)
        data, offsets = bytes_of(column)
        lines = np.add.reduceat(np.append(data == 10, False), offsets[:-1].astype(np.int64), dtype=np.int64) + 1
        lines[np.diff(offsets) == 0] = 1
        raw, at = np.empty(len(column)), 0
        while at < len(column):
            if lines[at] > block:
                raw[at] = self._raw_of_long(data[offsets[at] : offsets[at + 1]], block)
                at += 1
                continue
            to = at + max(1, int(np.searchsorted(np.cumsum(np.where(lines[at:] > block, 1 << 60, lines[at:])), block, side="right")))
            raw[at:to] = self._raw(*line_features(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]))
            at = to
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -40, 40)))


def _logit(mean: np.ndarray) -> np.ndarray:
    return np.log((mean + 1e-3) / (1 - mean + 1e-3))


def held_out(doc_id):
    """True for the part of the rows that is never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES, max_lines: int = MAX_LINES) -> Scorer:
    """Fit on a bounded sample of labelled rows of the learning part.

    The ids of the sample are chosen on ``labels`` alone and then broadcast; of their
    documents only sizes are gathered, and the texts of those alone that fit.
    """
    # a fraction by hash first, so that what the tasks send does not grow with their number
    known = labels.where(thinned(labels, ["doc_id"], 8 * max_docs)).where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col(label).cast("int").alias("label")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_docs)
    text = F.coalesce("text", F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    sizes = docs.select("doc_id", F.xxhash64(text).alias("h"), F.octet_length(text).alias("bytes"), lines.alias("lines")).join(small(known, max_docs, 16), "doc_id")
    # of rows with one id and label the one of the smallest hash; too long ones are left out, whatever comes after them
    sizes = sizes.where((F.col("bytes") <= max_bytes // 16) & (F.col("lines") <= max_lines // 16)).groupBy("doc_id", "label").agg(F.min(F.struct("h", "bytes", "lines")).alias("s"))
    chosen, n_bytes, n_lines = [], 0, 0
    for r in sorted(sizes.select("doc_id", "label", "s.*").collect(), key=lambda r: (r.h, r.doc_id, r.label)):
        n_bytes, n_lines = n_bytes + r.bytes, n_lines + r.lines
        if n_bytes <= max_bytes and n_lines <= max_lines:
            chosen.append((r.doc_id, r.h, r.label))
    picked = docs.sparkSession.createDataFrame(chosen, T.StructType([docs.schema["doc_id"], T.StructField("_h", T.LongType()), T.StructField("label", T.IntegerType())]))
    texts = docs.select("doc_id", text.alias("text")).join(F.broadcast(picked), "doc_id").where(F.xxhash64("text") == F.col("_h"))
    rows = texts.groupBy("doc_id", "_h", "label").agg(F.first("text").alias("text")).collect()
    rows.sort(key=lambda r: (r._h, r.doc_id, r.label))
    return Scorer.learn([r.text for r in rows], [r.label for r in rows])


def score(docs: DataFrame, scorer: Scorer, into: str = "score") -> DataFrame:
    """``docs`` with the score of every row's whole text."""
    names = [c for c in docs.columns if c != into]
    rows = docs.select(*names)
    place, held = names.index("text"), docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, place):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held.value(part.column(place)))], [*names, into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.DoubleType())]))


def op9(spark, sf_dir: str) -> DataFrame:
    """Quality score of all ``documents``."""
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
