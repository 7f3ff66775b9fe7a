"""Token ids in Arrow files of fixed-size-list batches.

A shard is one Arrow IPC file, ``ids-<shard>.arrow``, with columns

* ``ids``:  fixed_size_list<uint16 or uint32>[length] - the documents' ids one after another,
* ``mask``: fixed_size_list<bool>[length] - true where an id stands, false in the padding of the last sequence,

Every batch but the last of a shard has ``BATCH`` sequences, so sequence i stands in batch
``i // BATCH`` and is a zero-copy slice of the memory-mapped file.  Beside it
``index-<shard>.arrow`` holds ``doc_id, start, n_tokens`` within the shard.
Shards are ranges of ascending ``doc_id``; each begins a new sequence.

Files are written to the shared folder through ``pyarrow.fs`` under the name of
the task attempt, and only attempts that Spark reports in the written manifest
count, so a task that is run again leaves nothing behind that is read.

Rows: a null or empty text is the end id alone; rows with one ``doc_id`` are
written one after another; other columns are not read; an empty table gives
no file and an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_path, stash, table
from .tokens import encoder, public_path

#: Sequences of a record batch; tokens a shard is aimed at.
BATCH = 256
MANIFEST = "shard long, name string, docs long, tokens long"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class ShardWriter:
    """Writes one shard; ids arrive document by document."""

    def __init__(self, folder: str, name: str, length: int, kind: pa.DataType):
        self.fs, root = _filesystem(folder)
        self.fs.create_dir(root, recursive=True)
        self.length, self.kind, self.held, self.n = length, kind, [], 0
        self.schema = pa.schema({"ids": pa.list_(kind, length), "mask": pa.list_(pa.bool_(), length)})
        self.files = [self.fs.open_output_stream(f"{root}/{part}-{name}.arrow") for part in ("ids", "index")]
        self.index_schema = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})
        self.ids = pa.ipc.new_file(self.files[0], self.schema)
        self.index = pa.ipc.new_file(self.files[1], self.index_schema)
        self.docs = self.tokens = 0

    def add(self, doc_ids: pa.Array, ids: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in ids], np.int64)
        starts = self.tokens + np.cumsum(sizes) - sizes
        self.index.write(pa.record_batch([doc_ids.cast(pa.int64()), pa.array(starts), pa.array(sizes)], schema=self.index_schema))
        self.docs += len(ids)
        self.tokens += int(sizes.sum())
        self.held += ids
        self.n += int(sizes.sum())
        if self.n >= BATCH * self.length:
            self._write(self.n // self.length // BATCH * BATCH)

    def _write(self, rows: int, pad: int = 0) -> None:
        flat = np.concatenate([*self.held, np.zeros(pad, self.kind.to_pandas_dtype())])
        for at in range(0, rows, BATCH):
            part = flat[at * self.length : min(rows, at + BATCH) * self.length]
            mask = np.ones(len(part), bool)
            if pad and at + BATCH >= rows:
                mask[-pad:] = False
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, mask)]
            self.ids.write(pa.record_batch(lists, schema=self.schema))
        self.held = [flat[rows * self.length :]]
        self.n = len(self.held[0])

    def close(self) -> None:
        if self.n:
            self._write(-(-self.n // self.length), -self.n % self.length)
        for x in (self.ids, self.index, *self.files):
            x.close()


def write(docs: DataFrame, folder: str, path: str, cut_at: str | None, end_id: int, length: int = 2048, shards: int | None = None) -> DataFrame:
    """Encode and write all documents; returns the manifest ``shard, name, docs, tokens``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, task, out = encoder(path, cut_at), TaskContext.get(), None
        kind = pa.uint16() if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else pa.uint32()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = out or ShardWriter(folder, name, length, kind)
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                out.add(rows.column(0), [np.frombuffer(encode(t.as_py() or "") + end, "<u4").astype(kind.to_pandas_dtype()) for t in rows.column(1)])
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "name": [name], "docs": [out.docs], "tokens": [out.tokens]})

    # a hash of the text beside the id, so that many rows of one id are still split
    dealt = docs.repartitionByRange(shards, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id")
    return stash(dealt.mapInArrow(run, MANIFEST), "manifest")


class Shard:
    """Random access to a written shard; memory-mapped where the file is local."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        files, root = _filesystem(folder)
        local = isinstance(files, fs.LocalFileSystem)
        self.reader, self.index = (pa.ipc.open_file(pa.memory_map(f) if local else files.open_input_file(f)) for f in (f"{root}/{part}-{name}.arrow" for part in ("ids", "index")))
        self.length = self.reader.schema.field("ids").type.list_size

    def batch(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids of batch k as one flat view, and its mask."""
        got = self.reader.get_batch(k)
        return got.column(0).flatten().to_numpy(zero_copy_only=True), got.column(1).flatten()

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * BATCH + self.reader.get_batch(n - 1).num_rows if n else 0

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence i, without reading or copying any other."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        ids, mask = self.batch(i // BATCH)
        at = i % BATCH * self.length
        return ids[at : at + self.length], mask.slice(at, self.length)

    def stream(self) -> Iterator[np.ndarray]:
        """The ids that the masks keep, batch by batch."""
        for k in range(self.reader.num_record_batches):
            ids, mask = self.batch(k)
            yield ids[: mask.true_count]


def read(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document from the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts the ids of all documents before it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(folder, name)
                flow, held = shard.stream(), np.zeros(0, np.uint16)
                for k in range(shard.index.num_record_batches):
                    docs, crcs = shard.index.get_batch(k), []
                    for n in docs.column(2).to_pylist():
                        parts, have = [held], len(held)
                        while have < n:
                            parts.append(next(flow))
                            have += len(parts[-1])
                        held = np.concatenate(parts) if len(parts) > 1 else held
                        crcs.append(crc32(held[:n].astype("<u4").tobytes()))
                        held = held[n:]
                    starts = docs.column(1).to_numpy() + base
                    yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(starts), docs.column(2), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row a shard: the order of all shards is a window over the manifest
    base = F.expr("coalesce(sum(tokens) over (order by shard rows between unbounded preceding and 1 preceding), 0)")
    shards = manifest.select("name", base.alias("base"), "shard")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = shards.repartitionByRange(n, "shard").select("name", "base")
    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4(spark, sf_dir: str) -> DataFrame:
    """Write all ``documents`` as Arrow files of fixed-size lists and read them back."""
    folder = shared_path(spark, "token-files")
    manifest = write(table(spark, sf_dir, "documents"), folder, public_path("byte_bpe_50k.json"), "gpt", 0)
    return read(spark, folder, manifest)
