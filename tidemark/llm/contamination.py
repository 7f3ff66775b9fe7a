"""Benchmark decontamination with a broadcast set of hashed benchmark n-grams.

Words: A-Z lower-cased, then runs of digits, letters a-z and non-ASCII
characters.  A window is ``n`` consecutive words of an item; an item of fewer
words, but not none, is one window.  A document word inside any occurrence of
a window is hit; a document is contaminated if at least ``share`` of its words
(and at least one) are hit.

The set is flat: sorted 64-bit hashes of the windows, and the folded words they
stand for.  Every hash that a document has in common with it is verified word by
word, so the result is exact.  A Python worker builds a set once.

The benchmark is cut into overlapping pieces of at most ``piece`` windows and
dealt into sets of at most about ``set_bytes`` by measure, so neither a large
benchmark nor a large item is held whole.  With one set the documents are scanned
in place.  With more, they are stored with a number once, scanned against each
set in turn, and only what was hit is shuffled and joined to them.

Rows: a null text has no words, like an empty one; an empty benchmark hits
nothing; repeated items give the same windows, each item counts; every column of
the input is kept, and the result comes in one column whose name must be free.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stash, table
from .flat import bytes_of, parts, range_hash, words

_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)], np.uint8)
#: Bytes that a window takes in a set beside its words.
WINDOW_BYTES = 40

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", SPANS),
])
_PAIRS = pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))
_ARROW = pa.struct({"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "spans": _PAIRS})


class Windows:
    """Hashed windows of some pieces of items: ``(item, text)``."""

    def __init__(self, pieces: list[tuple[str, str]], n: int):
        self.names = sorted({name for name, _ in pieces})
        number = {name: k for k, name in enumerate(self.names)}
        of = np.array([number[name] for name, _ in pieces], np.int64)
        data, offsets = bytes_of(pa.array([t for _, t in pieces], pa.large_string()))
        self.folded = _FOLD[data]
        begin, end, row, codes = words(self.folded, offsets)
        size = np.bincount(row, minlength=len(pieces))
        self.sets = {}
        for length in sorted({int(x) for x in np.minimum(size, n) if x}):
            start = np.arange(max(0, len(row) - length + 1))
            start = start[row[start] == row[start + length - 1]]
            start = start[(size[row[start]] == length) | (length == n)]
            h = range_hash(codes, start, start + length)
            order = np.lexsort((of[row[start]], h))
            h, start = h[order], start[order]
            # an entry for each window: equal hashes and equal words
            new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
            lead = start[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
            for k in range(length):
                new |= codes[lead + k] != codes[start + k]
            first = np.flatnonzero(new)
            self.sets[length] = (h[first], begin[start[first]], end[start[first] + length - 1], np.r_[first, len(h)], of[row[start]])

    def hits(self, folded: np.ndarray, found: tuple) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Which words of ``folded`` texts are hit, and the items whose windows occur, by row."""
        begin, end, row, codes = found
        edges, items = np.zeros(len(row) + 1, np.int64), {}
        for length, (hashes, left, right, bounds, whose) in self.sets.items():
            start = np.arange(max(0, len(row) - length + 1))
            start = start[row[start] == row[start + length - 1]]
            h = range_hash(codes, start, start + length)
            where = np.searchsorted(hashes, h)
            known = where < len(hashes)
            known[known] = hashes[where[known]] == h[known]
            got = []
            for k, w, value in zip(start[known].tolist(), where[known].tolist(), h[known].tolist()):
                own = folded[begin[k] : end[k + length - 1]].tobytes().split()
                while w < len(hashes) and int(hashes[w]) == value:
                    if self.folded[left[w] : right[w]].tobytes().split() == own:
                        got.append(k)
                        items.setdefault(int(row[k]), set()).update(whose[bounds[w] : bounds[w + 1]].tolist())
                    w += 1
            got = np.array(got, np.int64)
            np.add.at(edges, got, 1)
            np.add.at(edges, got + length, -1)
        return np.cumsum(edges[:-1]) > 0, items


def _runs(hit: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of every run of hit words of one row."""
    at = np.flatnonzero(hit)
    if not len(at):
        return at, at
    new = np.r_[True, (np.diff(at) > 1) | (row[at[1:]] != row[at[:-1]])]
    return at[new], at[np.r_[new[1:], True]]


def _found(data: np.ndarray, offsets: np.ndarray, found: tuple, hit: np.ndarray, items: dict[int, list[str]]) -> pa.Array:
    """The result column of a part: ``items`` by row, spans in characters."""
    begin, end, row, _ = found
    n = len(offsets) - 1
    spans: dict[int, list[dict]] = {}
    first, last = _runs(hit, row)
    if len(first):
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        of = row[first]
        starts, ends = (chars[x] - chars[offsets[of]] for x in (begin[first], end[last]))
        for r, a, b in zip(of.tolist(), starts.tolist(), ends.tolist()):
            spans.setdefault(r, []).append({"start": a, "end": b})
    n_words, n_hit = np.bincount(row, minlength=n).tolist(), np.bincount(row[hit], minlength=n).tolist()
    return pa.array([{"n_words": n_words[r], "n_hit": n_hit[r], "items": sorted(items.get(r, ())), "spans": spans.get(r, [])} for r in range(n)], _ARROW)


def pieces(benchmark: DataFrame, n: int, piece: int) -> DataFrame:
    """``item, text, cost``: distinct pieces of at most ``piece`` windows, with n - 1 words in common with the next."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, offsets = bytes_of(pa.array([text.as_py()], pa.large_string()))
                folded = _FOLD[data]
                begin, end, *_ = words(folded, offsets)
                for at in range(0, max(1, len(begin) - n + 1) if len(begin) else 0, piece):
                    to = min(len(begin), at + piece + n - 1)
                    part = folded[begin[at] : end[to - 1]].tobytes().decode("utf-8", "surrogatepass")
                    out.append({"item": item, "text": part, "cost": len(part) + WINDOW_BYTES * (to - at)})
            yield pa.RecordBatch.from_pylist(out, pa.schema({"item": pa.string(), "text": pa.string(), "cost": pa.int64()}))

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string"))
    return items.mapInArrow(cut, "item string, text string, cost long").distinct()


def find(docs: DataFrame, benchmark: DataFrame, n: int = 13, into: str = "contamination", set_bytes: int = 128 << 20, piece: int = 1 << 16) -> DataFrame:
    """All columns of ``docs`` and ``into``: struct of ``n_words, n_hit, items, spans`` (sorted item ids; character ranges hit)."""
    if into in docs.columns:
        raise ValueError(f"the input has a column {into!r}; name another")
    cut = stash(pieces(benchmark, n, piece), "benchmark-pieces")
    sets = max(1, -(-(cut.agg(F.sum("cost")).first()[0] or 0) // set_bytes))
    if sets == 1:
        return _scan(docs, cut, n, into)
    number = fresh(docs, "_number_")
    rows = stash(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    hits = None
    for k in range(sets):  # one set is held at a time
        part = _hits(rows, cut.where(F.pmod(F.xxhash64("item", "text"), F.lit(sets)) == k), n, number)
        hits = part if hits is None else hits.unionByName(part)
    whole = hits.groupBy("_of").agg(F.flatten(F.collect_list("words")).alias("_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"))
    return _merged(rows.join(whole, rows[number] == F.col("_of"), "left").drop("_of", number), into)


def _held(docs: DataFrame, cut: DataFrame, n: int):
    # at most about ``set_bytes`` by measure
    return docs.sparkSession.sparkContext.broadcast(Windows([(r.item, r.text) for r in cut.select("item", "text").collect()], n))


def _scan(docs: DataFrame, cut: DataFrame, n: int, into: str) -> DataFrame:
    held, place = _held(docs, cut, n), docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = held.value
        for batch in batches:
            for part in parts(batch, place):
                data, offsets = bytes_of(part.column(place))
                folded = _FOLD[data]
                found = words(folded, offsets)
                hit, items = windows.hits(folded, found)
                named = {r: [windows.names[k] for k in ks] for r, ks in items.items()}
                yield pa.RecordBatch.from_arrays([*part.columns, _found(data, offsets, found, hit, named)], [*part.schema.names, into])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, FOUND)]))


def _hits(rows: DataFrame, cut: DataFrame, n: int, number: str) -> DataFrame:
    """``_of, words, items``: for the rows that one set hits, their number, the runs of words hit (first << 32 | last) and the items."""
    held = _held(rows, cut, n)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = held.value
        for batch in batches:
            for part in parts(batch, 1):
                data, offsets = bytes_of(part.column(1))
                folded = _FOLD[data]
                found = words(folded, offsets)
                hit, items = windows.hits(folded, found)
                row, numbers, out = found[2], part.column(0).to_pylist(), {}
                for a, b in zip(*(x.tolist() for x in _runs(hit, row))):
                    base = int(np.searchsorted(row, row[a]))
                    out.setdefault(int(row[a]), []).append(a - base << 32 | b - base)
                found_rows = [{"_of": numbers[r], "words": ranges, "items": [windows.names[k] for k in items[r]]} for r, ranges in out.items()]
                yield pa.RecordBatch.from_pylist(found_rows, pa.schema({"_of": pa.int64(), "words": pa.list_(pa.int64()), "items": pa.list_(pa.string())}))

    found = stash(rows.select(number, F.col("text").cast("string")).mapInArrow(run, "_of long, words array<long>, items array<string>"), "benchmark-hits")
    held.destroy()
    return found


def _merged(rows: DataFrame, into: str) -> DataFrame:
    """The result column from the word runs and items that all sets gave."""
    place = rows.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, place):
                *columns, runs, names = part.columns
                data, offsets = bytes_of(part.column(place))
                found = words(_FOLD[data], offsets)
                hit = np.zeros(len(found[2]), bool)
                first = np.searchsorted(found[2], np.arange(part.num_rows))
                for r, ranges in enumerate(runs.to_pylist()):
                    for x in ranges or ():
                        hit[first[r] + (x >> 32) : first[r] + (x & 0xFFFFFFFF) + 1] = True
                items = {r: ks for r, ks in enumerate(names.to_pylist()) if ks}
                yield pa.RecordBatch.from_arrays([*columns, _found(data, offsets, found, hit, items)], [*part.schema.names[:-2], into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-2], T.StructField(into, FOUND)]))


def contaminated(into: str = "contamination", share: int = 20):
    """True where at least one word and at least one in ``share`` words is hit."""
    return (F.col(f"{into}.n_hit") > 0) & (share * F.col(f"{into}.n_hit") >= F.col(f"{into}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents or, with ``remove="spans"``, with the hit ranges cut out of every text."""
    into = "contamination"
    while into in docs.columns:
        into += "_"
    found = find(docs, benchmark, n, into)
    if remove == "documents":
        return found.where(~contaminated(into)).select(*docs.columns)
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    spans = f"`{into}`.spans"
    # what stands before the first span, between two spans and after the last
    kept = F.expr(
        f"concat(array_join(transform({spans}, (s, i) -> substring(text, int(if(i = 0, 0, element_at({spans}, i).end) + 1),"
        f" int(s.start - if(i = 0, 0, element_at({spans}, i).end)))), ''), substring(text, int(element_at({spans}, -1).end + 1)))"
    )
    text = F.when(F.size(spans) > 0, kept).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def op5(spark, sf_dir: str) -> DataFrame:
    """Benchmark hits of all ``documents``."""
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "contamination.n_words",
        "contamination.n_hit",
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
m AS (SELECT doc_id, size, i, item_id FROM dw JOIN bw USING (size, gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar) AS items
       FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
