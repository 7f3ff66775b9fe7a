r"""Substring dedup by sliding sentence spans.

A text is cut into sentences: after a word that ends in ``. ! ?``, and at every
newline.  With ``long_word``, a word of that many bytes also ends a sentence, which
finds shorter passages that begin in the middle of one, and cuts there; by default
no word does, so spans are whole sentences.

From every sentence a span runs over at least ``sentences`` consecutive sentences
and on until it holds ``min_words`` words; it is hashed to 64 bits of its words.
Spans are joined over all texts, and all sentences covered by a span that is not
the first of its kind - by document id, then place - are removed.

With ``run``, whole passages go as well: all words of every stretch of ``run`` words
or more that an earlier document has, wherever it begins and whatever sentence ends
it holds.  Of the grams of ``gram`` words at all places, those with the smallest hash
of some ``run - gram + 1`` neighbours are marks (winnowing: two texts that share
``run`` words share a mark).  Marks are joined like spans; around every mark that
occurs again, up to ``run - gram`` words to each side, all grams are joined, and
stretches of ``run`` words that repeated grams cover are removed.

Plan (of spans and marks, then of the grams around marks): one aggregate finds, for every hash that occurs again, the smallest document
that has it; that table is stored and joined back to all spans, and the ranges
found go to the texts by document.  The plan is the same at every size.  Within a
document a repetition is seen on the spot.  A hash that fills much of the corpus
is met by partial aggregates first and by the skew handling of the join after.

Rows: every row is a document of its own.  The order of documents is that of
``doc_id`` (null first), then of the text's 64-bit hash; of rows equal in both one is the first, and the
others lose all that lies in a span, or with ``run`` in a run that long.  A null text has no spans
and stays null; very short texts have no spans; all columns are kept and nothing but
``text`` is changed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, small, stash, table
from .flat import bytes_of, parts, range_hash
from .flat import words as words_of

SENTENCES, MIN_WORDS = 3, 15
LONG_WORD = 1 << 31  # no word is as long
RUN, GRAM = 50, 26  # a gram is longer than the distance of two marks, so the marks of a passage cover it but for its ends
_GRAM_RANGE = 1 << 31  # in a packed range: a gram, not a span
_END = _GRAM_RANGE - 1
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


def _again(h: np.ndarray, of: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the row ``of`` has ``h`` at a smaller place."""
    order = np.lexsort((start, h, of))
    same = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = True
    return again


def spans(data: np.ndarray, offsets: np.ndarray, words: tuple, sentences: int, min_words: int, long_word: int):
    """Of all rows: span hash, whether the row had it before, row, and byte range within the row."""
    begin, end, row, codes = words
    if not len(begin):
        none = np.zeros(0, np.int64)
        return none, none.astype(bool), none, none, none
    newlines = np.concatenate([[0], np.cumsum(data == 10)])
    stop = _STOP[data[end - 1]] | (end - begin >= long_word)
    stop[:-1] |= (newlines[begin[1:]] > newlines[end[:-1]]) | (row[1:] != row[:-1])
    stop[-1] = True
    last = np.flatnonzero(stop) + 1  # words up to the end of each sentence
    start = np.concatenate([[0], last[:-1]])
    of = row[start]
    to = np.maximum(np.searchsorted(last, start + min_words), np.arange(len(last)) + sentences - 1)
    fits = to < len(last)
    fits[fits] &= of[to[fits]] == of[fits]
    start, to, of = start[fits], last[to[fits]], of[fits]
    h = range_hash(codes, start, to).view(np.int64)
    return h, _again(h, of, start), of, begin[start] - offsets[of], end[to - 1] - offsets[of]


def _gram_hashes(row: np.ndarray, codes: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at every word, and whether the row holds all of it."""
    n = len(row)
    whole = np.zeros(n, bool)
    whole[: max(0, n - gram + 1)] = row[: max(0, n - gram + 1)] == row[gram - 1 :]
    at = np.arange(n)
    return range_hash(codes, at, np.minimum(at + gram, n)), whole


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every n neighbours in a row, by doubling."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x, width = np.minimum(x[:-step], x[step:]), width + step
    return x


def _at(h, places, words, offsets, gram):
    """Hash, whether the row had it before, row, and byte range of the grams at some words."""
    begin, end, row, _ = words
    of = row[places]
    h = h[places].view(np.int64)
    return h, _again(h, of, places), of, begin[places] - offsets[of], end[places + gram - 1] - offsets[of]


def marks(offsets: np.ndarray, words: tuple, gram: int, run: int):
    """Like :func:`spans`, of the grams that are the least of some ``run - gram + 1`` neighbours."""
    _, _, row, codes = words
    n, wide = len(row), run - gram + 1
    if n < run:
        return _at(codes, np.zeros(0, np.int64), words, offsets, gram)
    h, _ = _gram_hashes(row, codes, gram)
    least = _least(h[: n - gram + 1], wide)  # of the windows that begin at each word
    least[row[: n - run + 1] != row[run - 1 :]] = 0
    pad = np.full(wide - 1, ~np.uint64(0))
    most = ~_least(np.concatenate([pad, ~least, pad]), wide)  # of the windows that hold each gram
    return _at(h, np.flatnonzero((most == h[: n - gram + 1]) & (most > 0)), words, offsets, gram)


def grams(offsets: np.ndarray, words: tuple, of: np.ndarray, start: np.ndarray, late: np.ndarray, gram: int, run: int):
    """The grams around marks (row, first byte, whether an earlier text has it), like :func:`spans`, and whether late marks leave a word of each uncovered."""
    begin, _, row, codes = words
    n = len(row)
    h, whole = _gram_hashes(row, codes, gram)
    place = np.searchsorted(begin, offsets[of] + start)
    first = np.searchsorted(row, of)

    def inside(a, b):
        edges = np.bincount(a, minlength=n + 1)[: n + 1] - np.bincount(np.minimum(b, n), minlength=n + 1)
        return np.cumsum(edges)[:n] > 0

    last = np.searchsorted(row, of, side="right")
    near = inside(np.maximum(place - (run - gram), first), np.minimum(place + (run - gram) + 1, last)) & whole
    bare = np.concatenate([[0], np.cumsum(~inside(place[late], place[late] + gram))])
    places = np.flatnonzero(near)
    return *_at(h, places, words, offsets, gram), bare[places + gram] > bare[places]


def _ident(docs: DataFrame) -> list:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return [doc.alias("_doc"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_tie")]


def _packed(part: pa.RecordBatch, h, again, row, start, end, *more) -> pa.RecordBatch:
    at = pa.array(row)
    arrays = [pa.array(h), pa.array(again), part.column(0).take(at), part.column(1).take(at), pa.array(start << 32 | end), *map(pa.array, more)]
    return pa.RecordBatch.from_arrays(arrays, ["h", "again", "_doc", "_tie", "range", "mark"][: len(arrays)])


def occurrences(docs: DataFrame, sentences: int = SENTENCES, min_words: int = MIN_WORDS, long_word: int = LONG_WORD, run: int | None = None, gram: int = GRAM) -> DataFrame:
    """Every span, and with ``run`` every mark: ``h`` (its hash), ``again`` (its document had it before), ``_doc, _tie`` (the document), ``range`` (first byte << 32 | end), ``mark``."""

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 2):
                data, offsets = bytes_of(part.column(2))
                words = words_of(data, offsets)
                got = spans(data, offsets, words, sentences, min_words, long_word)
                yield _packed(part, *got, np.zeros(len(got[0]), bool))
                if run:
                    h, *got = marks(offsets, words, gram, run)
                    yield _packed(part, ~h, *got, np.ones(len(h), bool))  # not the hash of a span of the same words

    rows = docs.select(*_ident(docs), F.col("text").cast("string"))
    return rows.mapInArrow(found, "h long, again boolean, _doc long, _tie long, range long, mark boolean")


_DOC = ("_doc", "_tie")


def _leads(found: DataFrame, tag: str) -> DataFrame:
    """``h, lead``: the first document of every hash that occurs again."""
    lead = found.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct(*_DOC)).alias("lead")).where("n > 1").select("h", "lead")
    return stash(lead, tag)


LATE = "again or struct(_doc, _tie) > lead"


def _around(docs: DataFrame, met: DataFrame, gram: int, run: int, bare: bool) -> DataFrame:
    """The grams around repeated marks, as in :func:`occurrences`; with ``bare`` those alone that late marks do not cover."""
    flagged = F.when(F.col("late"), F.col("range").bitwiseOR(F.lit(_GRAM_RANGE))).otherwise(F.col("range"))
    seeds = met.where("mark").groupBy(*_DOC).agg(F.collect_set(flagged).alias("seeds"))
    rows = docs.select(*_ident(docs), F.col("text").cast("string").alias("_text")).join(seeds, list(_DOC))

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 2):
                data, offsets = bytes_of(part.column(2))
                seed = part.column(3).flatten().to_numpy()
                of = pc.list_parent_indices(part.column(3)).to_numpy()
                *got, open_ = grams(offsets, words_of(data, offsets), of, seed >> 32, seed & _GRAM_RANGE > 0, gram, run)
                yield _packed(part, *([x[open_] for x in got] if bare else got))

    return rows.mapInArrow(found, "h long, again boolean, _doc long, _tie long, range long")


def repeats(docs: DataFrame, run: int | None = None, gram: int = GRAM, **how) -> DataFrame:
    """``_doc, _tie, ranges``: byte ranges to remove from each document that has any, packed as in :func:`occurrences`; those of grams have a bit more."""
    found = occurrences(docs, run=run, gram=gram, **how)
    met = found.join(_leads(found, "leading-documents"), "h").withColumn("late", F.expr(LATE))
    late = met.where("late")
    if run:
        met = stash(met.where("late or mark").select("_doc", "_tie", "range", "mark", "late"), "repeated-ranges")
        lead = _leads(_around(docs, met, gram, run, False), "leading-grams")
        ends = _around(docs, met, gram, run, True).join(lead, "h").where(LATE)
        of_gram = lambda c: c.bitwiseOR(F.lit(_GRAM_RANGE)).alias("range")
        known = F.when(F.col("mark"), of_gram(F.col("range"))).otherwise(F.col("range")).alias("range")
        late = met.where("late").select("_doc", "_tie", known).union(ends.select("_doc", "_tie", of_gram(F.col("range"))))
    return late.groupBy(*_DOC).agg(F.sort_array(F.collect_set("range")).alias("ranges"))


def passages(text: str, ranges: list[int], run: int | None) -> list[tuple[int, int]]:
    """Sorted byte ranges of packed ones: spans as they are, grams joined where they overlap if that makes ``run`` words."""
    raw, kept, joined = text.encode("utf-8", "surrogatepass"), [], []
    for start, end in sorted((x >> 32, x & 0xFFFFFFFF) for x in ranges):
        if not end & _GRAM_RANGE:
            kept.append((start, end))
        elif joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end & _END)
        else:
            joined.append([start, end & _END])
    return sorted(kept + [(a, b) for a, b in joined if len(raw[a:b].split()) >= run])


def without(text: str, ranges: list[tuple[int, int]]) -> str:
    """``text`` without sorted byte ranges; the blanks after a cut go with it if there are blanks or nothing before it."""
    raw, out, at = text.encode("utf-8", "surrogatepass"), b"", 0
    for start, end in ranges:
        if end <= at:
            continue
        out += raw[at : max(at, start)]
        at = end
        if not out or out[-1:] in b" \n\t\r":
            while at < len(raw) and raw[at : at + 1] in (b" ", b"\n") and (raw[at : at + 1] == b" " or not out or out[-1:] == b"\n"):
                at += 1
    return (out + raw[at:]).decode("utf-8", "surrogatepass")


def _copies(docs: DataFrame, keys: tuple[str, str], into: str) -> DataFrame:
    """Add ``into``: true for all but one of the rows that are equal in both ``keys``.

    Only rows of which there is another are written and numbered; with none, nothing is.
    """
    many = stash(docs.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys]), "repeated-rows")
    n = many.count()
    if not n:
        return docs.withColumn(into, F.lit(False))
    many = small(many, n, 48)
    same = (docs[keys[0]] == many[f"_{keys[0]}"]) & (docs[keys[1]] == many[f"_{keys[1]}"])
    number = fresh(docs, "_number_")
    rows = stash(docs.join(many, same, "left_semi").withColumn(number, F.monotonically_increasing_id()), "rows-with-copies")
    first = rows.groupBy(*keys).agg(F.min(number).alias("_first")).select("_first")
    copies = rows.join(small(first, n, 32), rows[number] == F.col("_first"), "left_anti").drop(number)
    firsts = rows.join(small(first, n, 32), rows[number] == F.col("_first"), "left_semi").drop(number)
    alone = docs.join(many, same, "left_anti")
    return alone.unionByName(firsts).withColumn(into, F.lit(False)).unionByName(copies.withColumn(into, F.lit(True)))


def _own_ranges(text: str, run: int | None, sentences: int, min_words: int, long_word: int) -> list[int]:
    """The packed ranges of a copy: all spans, and with ``run`` the whole of a text that long."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    offsets = np.array([0, len(data)])
    words = words_of(data, offsets)
    *_, start, end = spans(data, offsets, words, sentences, min_words, long_word)
    found = (start << 32 | end).tolist()
    if run and len(words[0]) >= run:
        found.append(int(words[0][0]) << 32 | int(words[1][-1]) | _GRAM_RANGE)
    return found


def dedup_spans(docs: DataFrame, removed: str | None = None, run: int | None = None, gram: int = GRAM, sentences: int = SENTENCES, min_words: int = MIN_WORDS, long_word: int = LONG_WORD) -> DataFrame:
    """``docs`` with repeated spans, and with ``run`` whole repeated passages, removed from ``text``; ``removed`` names a column for the number of bytes removed."""
    if removed and removed in docs.columns:
        raise ValueError(f"the input has a column {removed!r}; name another")
    how = {"sentences": sentences, "min_words": min_words, "long_word": long_word}
    cut = stash(repeats(docs, run=run, gram=gram, **how), "ranges-to-remove")
    names, copy = (fresh(docs, "_doc_"), fresh(docs, "_tie_")), fresh(docs, "_copy_")
    marked = _copies(docs.withColumns(dict(zip(names, _ident(docs)))), names, copy)
    same = (marked[names[0]] == cut["_doc"]) & (marked[names[1]] == cut["_tie"])
    joined = marked.join(cut, same, "left").select(*[marked[c] for c in docs.columns], cut["ranges"].alias(fresh(docs, "_ranges")), marked[copy])
    place, names = docs.columns.index("text"), [*docs.columns, *([removed] if removed else [])]

    def rewritten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, marks, again = batch.columns
            texts, gone = columns[place], np.zeros(batch.num_rows, np.int64)
            if marks.null_count < len(marks) or again.true_count:
                texts = texts.to_pylist()
                for i, (r, copied) in enumerate(zip(marks, again.to_pylist())):
                    if texts[i] is not None and (r.is_valid or copied):
                        ranges = _own_ranges(texts[i], run, **how) if copied else r.as_py()
                        kept = without(texts[i], passages(texts[i], ranges, run))
                        gone[i] = len(texts[i].encode("utf-8", "surrogatepass")) - len(kept.encode("utf-8", "surrogatepass"))
                        texts[i] = kept
                columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(gone)] if removed else [])], names)

    fields = docs.schema.fields + ([T.StructField(removed, T.LongType())] if removed else [])
    return joined.mapInArrow(rewritten, T.StructType(fields))


def op2(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` without repeated spans of sentences and without repeated passages."""
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    return dedup_spans(docs, removed="removed_bytes", run=RUN)
