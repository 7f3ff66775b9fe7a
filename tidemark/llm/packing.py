"""Harmonic packing of tokenised documents into sequences of equal capacity.

A document is cut from its start into pieces of capacity/k tokens: while ``rest``
tokens are left, the next piece has ``floor(capacity / k)`` tokens for the
smallest k that fits.  A rest under ``capacity / FINEST`` stays whole.  So every
reciprocal-capacity class holds pieces of exactly one length, and a bin of the
class is exactly ``floor(capacity / length)`` pieces: position in the class alone
gives bin and offset, without any search or shuffle of rows.

Each worker numbers the pieces of each class as it cuts them; one small
aggregate per (class, worker) turns these into numbers over all workers.  The
pieces over the last full bin of each class - fewer than one bin a class, a bound
that does not depend on the data - share bins by first fit decreasing.

Rows: a null or empty text is the end id alone; repeated rows are packed each
for itself; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, stash, table
from .tokens import MEMO_PIECES, encoder, public_path

FINEST = 64


def cuts(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order."""
    out = []
    while n:
        size = n if n * FINEST < capacity else capacity // -(-capacity // n)
        out.append(size)
        n -= size
    return out


def cut(docs: DataFrame, path: str, cut_at: str | None, end_id: int, capacity: int = 4096, tokens: bool = True, memo: int = MEMO_PIECES, split: Callable[[int, int], list[int]] = cuts) -> DataFrame:
    """Tokenise and cut: one row per piece, of the lengths that ``split`` names.

    ``doc_id, start, length, ids_crc32, doc_tokens, worker, rank`` and, if
    ``tokens``, the piece's ids as ``ids`` (little-endian unsigned 32-bit).
    ``rank`` numbers the pieces of one length on one ``worker``; ``memo`` bounds the
    encoder's memory there.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, worker, ranks = encoder(path, cut_at, memo), TaskContext.get().partitionId(), {}
        for batch in batches:
            doc, start, length, crc, total, rank, ids = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                raw = encode(text.as_py() or "") + end
                at = 0
                for size in split(len(raw) // 4, capacity):
                    part = raw[4 * at : 4 * (at + size)]
                    doc.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(crc32(part))
                    total.append(len(raw) // 4)
                    rank.append(ranks.get(size, 0))
                    ranks[size] = rank[-1] + 1
                    if tokens:
                        ids.append(part)
                    at += size
            arrays = [batch.column(0).take(pa.array(doc, pa.int32()))]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc, total, [worker] * len(doc), rank)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "rank"]
            if tokens:
                arrays, names = [*arrays, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = ", ".join(f"{c} long" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "rank"))
    return docs.mapInArrow(run, schema + (", ids binary" if tokens else ""))


def shared_bins(rest: list[tuple[int, int, int]], capacity: int, first_bin: int) -> list[tuple[int, int, int, int]]:
    """First fit decreasing of left-over pieces, given as (length, first number, count).

    Returns (length, number, bin, offset) of each; at most one bin's worth a class comes in.
    """
    fill, out = np.zeros(0, np.int64), []
    for length, number, count in sorted(rest, reverse=True):
        for i in range(number, number + count):
            fits = np.flatnonzero(fill + length <= capacity)
            at = int(fits[0]) if len(fits) else len(fill)
            if at == len(fill):
                fill = np.append(fill, 0)
            out.append((length, i, first_bin + at, int(fill[at])))
            fill[at] += length
    return out


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces of :func:`cut`; all other columns stay."""
    spark = pieces.sparkSession
    counts = stash(pieces.groupBy("length", "worker").agg(F.count("*").alias("n")), "piece-counts")
    cells = counts.count()
    # one row a class: capacity / FINEST exact classes and as many shorter lengths, whatever the data
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    base, next_bin, rest = [], 0, []
    for length in sorted(totals, reverse=True):
        per_bin = capacity // length
        full = totals[length] // per_bin
        base.append((length, per_bin, next_bin, full * per_bin))
        next_bin += full
        if over := totals[length] - full * per_bin:
            rest.append((length, full * per_bin, over))
    classes = spark.createDataFrame(base, "length long, per_bin long, first_bin long, in_full long")
    shared = spark.createDataFrame(shared_bins(rest, capacity, next_bin), "length long, number long, bin long, at long")
    before = F.expr("sum(n) over (partition by length order by worker rows between unbounded preceding and 1 preceding)")
    offsets = counts.join(F.broadcast(classes), "length")
    offsets = offsets.select("length", "worker", "per_bin", "first_bin", "in_full", F.coalesce(before, F.lit(0)).alias("before"))
    placed = pieces.join(small(offsets, cells, 64), ["length", "worker"]).withColumn("number", F.col("before") + F.col("rank"))
    placed = placed.join(F.broadcast(shared), ["length", "number"], "left")
    inside = F.col("number") < F.col("in_full")
    return placed.select(
        *[c for c in pieces.columns],
        F.when(inside, F.col("first_bin") + F.expr("number div per_bin")).otherwise(F.col("bin")).alias("sequence_id"),
        F.when(inside, F.expr("(number % per_bin) * length")).otherwise(F.col("at")).alias("offset"),
    )


def pack(docs: DataFrame, path: str, cut_at: str | None, end_id: int, capacity: int = 4096, tokens: bool = True, memo: int = MEMO_PIECES) -> DataFrame:
    """Pack whole documents: pieces with their sequence and offset, and their ids if ``tokens``."""
    return place(stash(cut(docs, path, cut_at, end_id, capacity, tokens, memo), "pieces"), capacity)


def op1(spark, sf_dir: str) -> DataFrame:
    """Harmonic packing of all ``documents`` into sequences of 4096."""
    packed = pack(table(spark, sf_dir, "documents", spread=True), public_path("word_bpe_49k.json"), "space", 2, tokens=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
