"""Bin completion: pack whole documents into as few sequences as the search finds.

Lengths are whole numbers up to the capacity, so any corpus comes down to a table of
at most ``capacity`` (length, number of pieces) rows; only that table is searched, on the
driver, whatever the number of documents.  Pieces never leave the executors: each is numbered
within its length, and the packing found - a list of *fillings*, each used for many
sequences at once - gives its place from that number.

The search is bin completion (Korf 2003).  A node takes the largest length that is left and
enumerates fillings of the room beside it, leaving out every filling that another one
dominates (some of its pieces could be exchanged for one longer piece that still fits).  Two bounds cut
branches: the waste so far plus what must still be wasted may not reach the waste of the
incumbent, and Martello and Toth's bound on what is left.  Incumbents are best-fit-decreasing
completions, taken at the root and at every node.  A filling is used for as many sequences as
the counts allow, and tried for one alone on the way back.  The search ends when the
incumbent meets the lower bound, or after ``nodes`` nodes; every piece is packed in both cases.

Rows: a null or empty text is the end id alone; repeated rows are packed each for
itself; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import small, stash, table
from .packing import cut
from .tokens import public_path

#: (bins, ((length, pieces in each bin), ...)) of each filling.
Packing = list[tuple[int, tuple[tuple[int, int], ...]]]
#: Nodes of the search, undominated fillings tried at a node, and fillings looked at for them.
NODES, WIDTH, LOOK = 300, 8, 400


def whole(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens: full sequences, then what is left."""
    return [capacity] * (n // capacity) + ([n % capacity] if n % capacity else [])


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing, for all pieces of one length and all bins of one room at a time."""
    rooms, bins, closed = [], {}, []

    def put(n: int, room: int, filling: tuple) -> None:
        if not n:
            return
        if not room:
            closed.append((n, filling))
        elif room in bins:
            bins[room].append((n, filling))
        else:
            bins[room] = [(n, filling)]
            insort(rooms, room)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # as many new bins as the rest can fill
                room, n, filling = capacity, -(-left // (capacity // length)), ()
            else:
                room = rooms[at]
                n, filling = bins[room].pop()
                if not bins[room]:
                    del bins[room], rooms[at]
            each = room // length
            full = min(n, left // each)
            put(full, room - each * length, (*filling, (length, each)))
            left, n = left - full * each, n - full
            if n and left:
                put(1, room - left * length, (*filling, (length, left)))
                left, n = 0, n - 1
            put(n, room, filling)
    return closed + [group for groups in bins.values() for group in groups]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's second bound on the number of bins."""
    n = np.zeros(capacity + 1, np.int64)
    n[list(counts)] = list(counts.values())
    size = n * np.arange(capacity + 1)
    above = lambda x: np.append(np.cumsum(x[::-1])[::-1], 0)  # noqa: E731  of lengths from i on
    many, much, half = above(n), above(size), capacity // 2
    low = np.arange(half + 1)  # pieces under it are left out
    alone, large = many[capacity - low + 1], many[half + 1]
    room = (large - alone) * capacity - (much[half + 1] - much[capacity - low + 1])
    rest = much[low] - much[half + 1]
    return int(max(large + np.maximum(0, -(-(rest - room) // capacity)).max(), -(-int(size.sum()) // capacity)))


def _spread(bits: int, by: int) -> int:
    """``bits`` shifted by 0, 1, ... ``by`` places, all in one."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        bits |= bits << step
        done += step
    return bits


def dominated(filling: tuple, room: int, free: int) -> bool:
    """Whether one piece of ``free`` (bit i: a piece of length i is left over) can take the place of some pieces of the filling."""
    ones, sums = 0, 1
    several, slack = 0, room
    for length, n in filling:
        for _ in range(n):
            several |= (sums & ~1) << length
            ones |= 1 << length
            sums |= sums << length
            slack -= length
    return bool((_spread(several, slack) | (_spread(ones << 1, slack - 1) if slack else 0)) & free)


def _maximal(lengths: list[int], counts: dict[int, int], room: int, at: int, slot: int) -> Iterator[tuple]:
    """Fillings to which nothing can be added, those with the longest pieces first; ``slot`` bounds the depth of the look."""
    at = bisect_left(lengths, -room, at)
    if at == len(lengths) or not slot:
        yield ()
        return
    for i in range(at, len(lengths)):
        length = -lengths[i]
        for n in range(min(counts[length], room // length), 0, -1):
            for rest in _maximal(lengths, counts, room - n * length, i + 1, slot - 1):
                # nothing that was passed over may still fit
                left = room - n * length - sum(x * y for x, y in rest)
                skipped = lengths[bisect_left(lengths, -left, at) : i] if left else []
                if skipped or (left >= length and n < counts[length]):
                    continue
                yield ((length, n), *rest)


def _pairs(lengths: np.ndarray, counts: np.ndarray, room: int) -> Iterator[tuple]:
    """For each length the longest one that fits beside it, least waste first; ``lengths`` ascend."""
    fits = np.searchsorted(lengths, room - lengths, "right") - 1
    fits = np.minimum(fits, np.arange(len(lengths)))
    fits = np.where((fits == np.arange(len(lengths))) & (counts < 2), fits - 1, fits)
    ok = np.flatnonzero((lengths <= room) & (fits >= 0))
    waste = room - lengths[ok] - lengths[fits[ok]]
    for i in ok[np.lexsort((-lengths[ok], waste))]:
        x, y = int(lengths[i]), int(lengths[fits[i]])
        yield ((x, 2),) if x == y else ((x, 1), (y, 1))


def fillings(counts: dict[int, int], room: int, width: int = WIDTH, look: int = LOOK) -> list[tuple]:
    """Undominated fillings of a room, least waste first: all of them if there are few, the best of ``look`` otherwise."""
    fitting = {x: n for x, n in counts.items() if n and x <= room}
    if not fitting:
        return [()]
    if room in fitting:
        return [((room, 1),)]  # it dominates every other
    lengths = sorted((-x for x in fitting))
    found = dict.fromkeys(islice(_maximal(lengths, fitting, room, 0, 64), look))
    if len(found) == look:  # too many to see all: the best of two and of three, each made full with what fits longest
        up = np.array(sorted(fitting), np.int64)
        have = np.array([fitting[int(x)] for x in up], np.int64)
        starts = [*islice(_pairs(up, have, room), look // 4)]
        for x in map(int, up[::-1][: look // 16]):
            less = have - (up == x)
            for pair in islice(_pairs(up[less > 0], less[less > 0], room - x), 4):
                starts.append(tuple(sorted({**dict(pair), x: dict(pair).get(x, 0) + 1}.items(), reverse=True)))
        for start in starts:
            filling = dict(start)
            left = room - sum(x * n for x, n in start)
            at = bisect_left(lengths, -left)
            while left and at < len(lengths):
                x = -lengths[at]
                n = min(left // x, fitting[x] - filling.get(x, 0))
                if n:
                    filling[x], left = filling.get(x, 0) + n, left - n * x
                at = bisect_left(lengths, -left, at + 1)
            found[tuple(sorted(filling.items(), reverse=True))] = None
    free = sum(1 << x for x in fitting)
    out = []
    for filling in sorted(found, key=lambda f: (-sum(x * n for x, n in f), sum(n for _, n in f))):
        used_up = sum(1 << x for x, n in filling if n >= fitting[x])
        if not dominated(filling, room, free & ~used_up):
            out.append(filling)
            if len(out) == width:
                break
    return out or [next(iter(found))]


def complete(counts: dict[int, int], capacity: int, nodes: int = NODES, width: int = WIDTH, look: int = LOOK) -> Packing:
    """The packing with the fewest bins that the search finds; ``counts``: length -> pieces."""
    counts = {x: n for x, n in counts.items() if n}
    if not counts:
        return []
    total, least = sum(x * n for x, n in counts.items()), lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    fewest = sum(n for n, _ in best)

    def branches(left: dict[int, int]) -> Iterator[tuple[int, tuple]]:
        top = max(left)
        rest = {**left, top: left[top] - 1}
        for filling in fillings(rest, capacity - top, width, look):
            full = {top: 1}
            for x, n in filling:
                full[x] = full.get(x, 0) + n
            most = min(left[x] // n for x, n in full.items())
            for n in dict.fromkeys((most, 1)):
                yield n, tuple(full.items())

    path, stack = [], [(counts, 0, 0, branches(counts))]
    while stack and nodes and fewest > least:
        left, used, waste, tries = stack[-1]
        step = next(tries, None)
        if step is None:
            stack.pop()
            if path:
                path.pop()
            continue
        nodes -= 1
        n, filling = step
        now, lost = used + n, waste + n * (capacity - sum(x * k for x, k in filling))
        after = dict(left)
        for x, k in filling:
            after[x] -= n * k
            if not after[x]:
                del after[x]
        if lost > (fewest - 1) * capacity - total:  # more waste than any better packing has
            continue
        if not after:
            best, fewest = [*path, step], now
            continue
        if now + lower_bound(after, capacity) >= fewest:
            continue
        rest = best_fit(after, capacity)
        if (bins := now + sum(k for k, _ in rest)) < fewest:
            best, fewest = [*path, step, *rest], bins
        path.append(step)
        stack.append((after, now, lost, branches(after)))
    return best


def segments(packing: Packing) -> np.ndarray:
    """Rows (length, first number, first bin, pieces in each bin, place of the first in a bin), ordered; numbers count within a length."""
    rows, given, first_bin = [], {}, 0
    for bins, filling in packing:
        at = 0
        for length, n in filling:
            rows.append((length, given.get(length, 0), first_bin, n, at))
            given[length] = given.get(length, 0) + bins * n
            at += n * length
        first_bin += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(pieces: DataFrame, capacity: int = 4096, nodes: int = NODES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (``length, worker, rank``); all other columns stay."""
    counts = stash(pieces.groupBy("length", "worker").agg(F.count("*").alias("n")), "length-counts")
    cells = counts.count()
    # one row a length: at most ``capacity`` rows, whatever the data
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # groups of equal bins: at most three a length, so a few megabytes at most
    rows = segments(complete(totals, capacity, nodes))
    shift = (1 << 62) // (capacity + 1)  # over any number of pieces of a length
    starts = rows[:, 0] * shift + rows[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(i).to_numpy() for i in (batch.num_columns - 2, batch.num_columns - 1))
            at = np.searchsorted(starts, length * shift + number, "right") - 1
            _, first, first_bin, each, offset = rows[at].T
            bins, inside = np.divmod(number - first, each)
            arrays = [*batch.columns[:-2], pa.array(first_bin + bins), pa.array(offset + inside * length)]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-2], "sequence_id", "offset"])

    before = F.expr("coalesce(sum(n) over (partition by length order by worker rows between unbounded preceding and 1 preceding), 0)")
    offsets = counts.select("length", "worker", before.alias("before"))
    numbered = pieces.join(small(offsets, cells, 40), ["length", "worker"])
    numbered = numbered.select(*pieces.columns, F.col("length").alias("_length"), (F.col("before") + F.col("rank")).alias("_number"))
    return numbered.mapInArrow(run, StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def pack(docs: DataFrame, path: str, cut_at: str | None, end_id: int, capacity: int = 4096, tokens: bool = True, nodes: int = NODES) -> DataFrame:
    """Pack whole documents, only longer ones cut: pieces with their sequence and offset, and their ids if ``tokens``.

    ``piece`` numbers the pieces of a row from 0.
    """
    pieces = cut(docs, path, cut_at, end_id, capacity, tokens, split=whole)
    pieces = pieces.withColumn("piece", F.expr(f"cast(start div {int(capacity)} as int)"))
    return place(stash(pieces, "whole-pieces"), capacity, nodes)


def op11(spark, sf_dir: str) -> DataFrame:
    """Bin completion of all ``documents`` into sequences of 4096."""
    packed = pack(table(spark, sf_dir, "documents", spread=True), public_path("word_bpe_49k.json"), "space", 1, tokens=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
