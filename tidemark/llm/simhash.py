"""SimHash near-duplicate detection with bit-sliced comparison.

Fingerprint: 64-bit majority vote over the XXH64 hashes (seed 42) of all 3-word
shingles.  Two texts are linked when their fingerprints differ in at most
``radius`` bits; a class is a connected component of links.

Candidates: among four 16-bit blocks at least one is free of up to three
differing bits, and so is one of the four 12-bit parts of the 48 other bits.
Every distinct fingerprint therefore goes to 16 buckets with a key of 28 bits,
and each linked pair meets in at least one bucket.

Comparison: the fingerprints of a bucket are stored as 64 vertical bit planes.
XOR of planes gives one bit of many distances at once, carry-save counters add
them up, and a block is abandoned as soon as every distance exceeds the radius.
A bucket that is still large is dealt by further parts of its bits first.

Rows: a null or word-less text has fingerprint zero and is linked like any
other; repeated rows and ties share one fingerprint; other columns are not
read, so clashing names do no harm; an empty table gives an empty result.  A
null ``doc_id`` keeps its row but never becomes the id of a class.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, fresh, small, stash

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Rows compared as one block; runs of equal keys over SMALL have planes of their own, over LARGE they are dealt again.
BLOCK, SMALL, LARGE = 1 << 15, 48, 8192


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(s) for s in zip(words, words[1:], words[2:])] if len(words) > 2 else [b" ".join(words)]
    digest = xxhash.xxh64_digest
    total = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        raw = np.frombuffer(b"".join([digest(s, 42) for s in shingles[at : at + (1 << 16)]]), np.uint8)
        total += np.unpackbits(raw).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(shingles)).tobytes(), "big")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.array([fingerprint(t) for t in (x.as_py() for x in batch.column(1))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (signed long) of every row."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_fingerprints, "doc_id long, fp long")


def planes(fps: np.ndarray) -> list[int]:
    """64 vertical bit planes: bit i of plane b is bit b of fingerprint i."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return [int.from_bytes(p.tobytes(), "little") for p in np.packbits(bits.T, axis=1, bitorder="little")]


def within(differences: Iterable[int], alive: int, radius: int) -> int:
    """Lanes of ``alive`` with at most ``radius`` ones over all planes of differences.

    The counters of each lane start so that they overflow at ``radius`` + 1.
    """
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    sums = [alive if start >> j & 1 else 0 for j in range(width)]
    for plane in differences:
        carry = plane & alive
        for j in range(width):
            sums[j], carry = sums[j] ^ carry, sums[j] & carry
        alive &= ~carry
        if not alive:
            break
    return alive


def _ones(lanes: int) -> Iterator[int]:
    while lanes:
        low = lanes & -lanes
        yield low.bit_length() - 1
        lanes ^= low


class _Forest:
    """Union-find over positions; remembers the links that joined two trees."""

    def __init__(self, n: int):
        self.up, self.links = list(range(n)), []

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.up[b] = a
            self.links.append((i, j))


def _parts(fps: np.ndarray, radius: int) -> list[np.ndarray]:
    """Index groups, each in one more 9-bit part alike, that hold every pair within the radius at least once."""
    varying = [b for b in range(64) if 0 < np.count_nonzero(fps >> np.uint64(b) & np.uint64(1)) < len(fps)]
    groups = []
    for part in np.array_split(np.array(varying, np.uint64), radius + 1):
        key = np.zeros(len(fps), np.uint64)
        for b in part:
            key = key << np.uint64(1) | fps >> b & np.uint64(1)
        order = np.argsort(key, kind="stable")
        groups += [g for g in np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(g) > 1]
    return groups


def run_links(fps: np.ndarray, radius: int, deal: bool = True) -> list[tuple[int, int]]:
    """Spanning links among distinct fingerprints that share a bucket, each against all by planes."""
    if deal and len(fps) > LARGE:
        found = []
        for g in _parts(fps, radius):
            # again by other bits, as long as that makes groups smaller
            found += [(int(g[i]), int(g[j])) for i, j in run_links(fps[g], radius, deal=2 * len(g) < len(fps))]
        return found
    forest, cut, full = _Forest(len(fps)), planes(fps), (1 << len(fps)) - 1
    for i, fp in enumerate(fps.tolist()):
        later = full ^ ((2 << i) - 1)
        hits = within((p ^ full if fp >> b & 1 else p for b, p in enumerate(cut)), later, radius)
        for j in _ones(hits):
            forest.link(i, j)
    return forest.links


def block_links(keys: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within runs of equal keys; ``keys`` is sorted and cuts no run."""
    if not len(keys):
        return []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    found = []
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        found += [(s + i, s + j) for i, j in run_links(fps[s : s + n], radius)]
    keep = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    where, keys, fps = np.flatnonzero(keep), keys[keep], fps[keep]
    if len(keys):
        forest, cut = _Forest(len(keys)), planes(fps)
        for d in range(1, int(sizes[sizes <= SMALL].max())):
            same = int.from_bytes(np.packbits(keys[d:] == keys[:-d], bitorder="little").tobytes(), "little")
            if not same:
                break
            for i in _ones(within((p ^ (p >> d) for p in cut), same, radius)):
                forest.link(i, i + d)
        found += [(int(where[i]), int(where[j])) for i, j in forest.links]
    return found


def _links(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(keys, fps):
            pairs = np.array(block_links(keys, fps.view(np.uint64), radius), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(fps[pairs[:, 0]]), pa.array(fps[pairs[:, 1]])], ["a", "b"])

        held_k, held_f, n = [], [], 0
        for batch in batches:
            held_k.append(batch.column(0).to_numpy(zero_copy_only=False))
            held_f.append(batch.column(1).to_numpy(zero_copy_only=False))
            n += batch.num_rows
            if n >= BLOCK:
                keys, fps = np.concatenate(held_k), np.concatenate(held_f)
                cut = int(np.searchsorted(keys, keys[-1]))  # the last run may go on
                if cut:
                    yield emit(keys[:cut], fps[:cut])
                held_k, held_f, n = [keys[cut:]], [fps[cut:]], len(keys) - cut
        if n:
            yield emit(np.concatenate(held_k), np.concatenate(held_f))

    return run


def _bits(fp, at: int, n: int):
    return F.shiftrightunsigned(fp, at).bitwiseAND((1 << n) - 1)


def links(distinct_fps: DataFrame, radius: int = 3) -> DataFrame:
    """``a, b``: links that connect all of the given distinct ``fp`` within the radius (at most 3)."""
    if not 1 <= radius <= 3:
        raise ValueError("the buckets hold for a radius of 1 to 3")
    fp, buckets = F.col("fp"), []
    for block in range(4):
        rest = [at for at in range(0, 64, 4) if at // 16 != block]  # 12 nibbles
        for part in range(4):
            key = F.lit(4 * block + part).cast("long")
            key = F.shiftleft(key, 16).bitwiseOR(_bits(fp, 16 * block, 16))
            for at in rest[3 * part : 3 * part + 3]:
                key = F.shiftleft(key, 4).bitwiseOR(_bits(fp, at, 4))
            buckets.append(key)
    dealt = distinct_fps.select(F.explode(F.array(*buckets)).alias("key"), "fp")
    dealt = dealt.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_links(radius), "a long, b long").distinct()


def _classes(rows: DataFrame, low: Column, radius: int) -> DataFrame:
    """``of, low``: every fingerprint of ``rows`` and the least ``low`` of its class."""
    lows = stash(rows.groupBy("fp").agg(F.min(low).alias("low")), "distinct-fingerprints")
    roots = components(links(lows.select("fp"), radius), "a", "b")
    classes = lows.join(roots, lows["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("low").alias("low"))
    return classes.select("root", F.col("fp").alias("of")).join(least, "root").select("of", "low")


def near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for every row; ``component_id`` is the smallest ``doc_id`` reachable by links."""
    rows = stash(fingerprints(docs), "fingerprints")
    ids = _classes(rows, F.col("doc_id"), radius)
    return rows.join(ids, rows["fp"] == ids["of"]).select("doc_id", "fp", F.col("low").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest ``doc_id`` (null last), the first stored of equal ones.

    Rows are told apart by a number that they are stored with, so repeated ids,
    null ids and equal rows are decided like any others.
    """
    number, fp = fresh(docs, "_number_"), fresh(docs, "_fp_")
    place, names = docs.columns.index("text"), [*docs.columns, fp]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(place)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], names)

    marked = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())]))
    marked = stash(marked.withColumn(number, F.monotonically_increasing_id()), "rows-with-fingerprints")
    rows = marked.select(F.col(fp).alias("fp"), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(number).alias("row")).alias("me"))
    ids = _classes(rows, F.col("me"), radius)
    gone = stash(rows.join(ids, rows["fp"] == ids["of"]).where("me.row <> low.row").select(F.col("me.row").alias("_gone")), "near-duplicates")
    return marked.join(small(gone, gone.count(), 16), marked[number] == F.col("_gone"), "left_anti").select(*docs.columns)


def op8(spark, sf_dir: str) -> DataFrame:
    """SimHash classes of all ``documents``."""
    from .common import table

    found = near_duplicates(table(spark, sf_dir, "documents", spread=True))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
