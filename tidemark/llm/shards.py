"""Sharding by a hierarchical weighted hash tree.

The tree has three levels: regions, racks, shards; the weight of a node is the
sum of the shards below it.  A row descends from the root: at each level every
child draws ``-ln(u) / weight`` from a hash of the row's key and the child, and
the smallest draw wins.  A child whose weight changes gains or loses rows only
against its own siblings, so movement stays in the subtrees whose weights change;
a new region takes rows only into itself.

All of it is SQL expressions over the key.  ``slot`` numbers the rows of a shard
without gaps: rows are numbered within (shard, bucket of the key's hash) and the
bucket's first number comes from a small table of counts.

Rows: a null text has no bytes; a null key is a key like any other; repeated
rows lie in one shard in neighbouring slots; other columns are kept by
:func:`assign` unless they have the names of its results; an empty table stays
empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, small, stash, table


BASE = 24


@dataclass(frozen=True)
class Tree:
    """regions -> racks -> (shard number, weight)."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @staticmethod
    def even(shards: int, regions: int, racks: int) -> Tree:
        """Equal weights; shard numbers run through racks and regions in order."""
        per = -(-shards // (regions * racks))
        groups = [tuple((s, 1.0) for s in range(at, min(shards, at + per))) for at in range(0, shards, per)]
        return Tree(tuple(tuple(groups[at : at + racks]) for at in range(0, len(groups), racks)))

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own: only it takes rows."""
        number = 1 + max(s for region in self.regions for rack in region for s, _ in rack)
        return Tree((*self.regions, (((number, weight),),)))


def tree(shards: int) -> Tree:
    """The one tree of a number of shards: up to ``BASE`` in racks of four and two racks a region, each further one in a region of its own.

    So from ``BASE`` on, one shard more takes rows only into itself.
    """
    even = Tree.even(min(shards, BASE), regions=-(-min(shards, BASE) // 8), racks=2)
    for _ in range(shards - BASE):
        even = even.grown()
    return even


def _draw(key: Column, node: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(weight)


def _smallest(draws: list[Column], values: list[Column]) -> Column:
    """The value of the smallest draw; the first of equal ones."""
    if len(values) == 1:
        return values[0]
    best = F.least(*draws)
    out = values[-1]
    for draw, value in list(zip(draws, values))[-2::-1]:
        out = F.when(draw == best, value).otherwise(out)
    return out


def shard_of(tree: Tree, key: Column) -> Column:
    """The shard number of a key, by descent through the tree."""
    weigh = lambda rack: sum(w for _, w in rack)
    regions = []
    for r, region in enumerate(tree.regions):
        racks = [_smallest([_draw(key, f"shard {s}", w) for s, w in rack], [F.lit(s) for s, _ in rack]) for rack in region]
        regions.append(_smallest([_draw(key, f"rack {r}.{k}", weigh(rack)) for k, rack in enumerate(region)], racks))
    return _smallest([_draw(key, f"region {r}", sum(map(weigh, region))) for r, region in enumerate(tree.regions)], regions)


def assign(rows: DataFrame, tree: Tree, key: str, order: list[str], bucket_rows: int = 50_000) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 within a shard, in the order of bucket, ``key`` and ``order``)."""
    kept = stash(rows.withColumn("shard", shard_of(tree, F.col(key))), "shards")
    n = kept.count()
    buckets = max(1, -(-n // bucket_rows))
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit("slot"), *order), F.lit(buckets))  # identical rows alone share one
    b, start, place = fresh(rows, "_bucket"), fresh(rows, "_before"), fresh(rows, "_inside")
    kept = kept.withColumn(b, bucket)
    counts = kept.groupBy("shard", b).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy(b).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("shard", b, F.coalesce(before, F.lit(0)).alias(start))
    cells = min(n, buckets * sum(len(rack) for region in tree.regions for rack in region))
    inside = F.row_number().over(Window.partitionBy("shard", b).orderBy(key, *order)) - 1
    numbered = kept.withColumn(place, inside).join(small(counts, cells, 32), ["shard", b])
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    return numbered.select(*names, "shard", (F.col(start) + F.col(place)).alias("slot"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Law ``key``: all ``documents`` over 24 shards, and where each goes with one more."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    docs = docs.withColumn("grown_shard", shard_of(tree(25), F.col("doc_id")))
    placed = assign(docs, tree(24), "doc_id", ["text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
