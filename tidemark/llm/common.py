"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted size is at most this.
BROADCAST_BYTES = 32 << 20
#: Whether the shuffle files of a statement go when it ends, and not only when the driver's memory is collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; with ``spread``, rows that come in fewer partitions than there are cores are dealt out to all of them."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if spread and rows.rdd.getNumPartitions() < cores else rows


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def stash(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors, fixes row numbers.

    With ``by``, the rows of each value of that column are in files of their own.  The shuffle files of the write go as soon as the table stands; what follows reads the table alone.
    """
    spark = df.sparkSession
    path, before = shared_path(spark, tag), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*([by] if by else [])).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its known number of rows is small; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it the first that ``df`` has no column of."""
    while name in df.columns:
        name += "_"
    return name


def thinned(df: DataFrame, by: list[str], rows: int):
    """A condition that keeps about ``rows`` rows of ``df``, by a hash of columns; all rows of a smaller table."""
    return F.pmod(F.xxhash64(*by, F.lit("sample")), F.lit(max(1, df.count() // rows))) == 0


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the undirected graph with edges (a, b).

    Large-star / small-star rounds (Kiveris et al. 2014) on aggregates and joins
    only: no neighbour list is ever gathered.  Each round is written to the
    shared folder.  Returns ``node, root`` for every node that has an edge and is
    not itself the smallest of its component; ``root`` is that smallest node.
    Null ends and self-links are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    seen = None
    while True:
        edges = stash(edges, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).distinct()
