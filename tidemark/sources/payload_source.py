"""A Spark data source of landed time-series payloads, for batches and streams.

``spark.dataSource.register(PayloadSource)``, then ``spark.read.format("payloads").option("path", …).load()`` or the
same with ``readStream``.  The folder holds JSON lines ``{"ticker": …, "payload": …}``, one fetch a line, as
``write.json`` lands them; names that begin with ``_`` or ``.`` are not read.

Options: ``path``, ``series`` (the name of the nested object), ``zone`` of the time keys, ``interval`` and ``source``
as constants of the rows; ``rows``: ``bars`` (default) or ``rejects`` for the fetches without the series and the
reason; ``size``: bytes of files that a task takes on, 128 MB by default; ``log`` (streams): a folder for the list of files.

Numbers that cannot be read are null, points without a close or a readable time are dropped, a line that is no JSON
object and a fetch without the series are rejects with different reasons.  A local time that an autumn clock change
doubles counts as the first one, one that a spring change skips as an hour later, as Spark counts them.

A file is read once it has its name, so land it under another name and rename it.  A stream writes the names of new
files down as a numbered entry before Spark plans them; an offset is the number of an entry.  So an offset means the
same files on every run, and files may arrive in any order of time.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .schemas import BARS

REJECTS = "ticker string, reason string"
#: Rows of a record batch.
BATCH = 1 << 14
PRICES = ["open", "high", "low", "close"]
FIELDS = {"ticker": pa.string(), "source": pa.string(), "interval": pa.string(), "ts": pa.timestamp("us", "UTC")}
ARROW = pa.schema({**FIELDS, **dict.fromkeys(PRICES, pa.float64()), "volume": pa.int64()})
ARROW_REJECTS = pa.schema({"ticker": pa.string(), "reason": pa.string()})


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def listed(path: str) -> list[tuple[str, int]]:
    """Names below ``path`` and sizes of the landed files, in the order of names."""
    store, root = store_of(path)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [(f.path[len(root) :].lstrip("/"), f.size) for f in found if f.type == fs.FileType.File]
    return sorted((n, size) for n, size in names if not any(part[0] in "_." for part in n.split("/")))


@dataclass
class Files(InputPartition):
    """What one task reads."""

    names: tuple[str, ...]


def dealt(files: list[tuple[str, int]], size: int) -> list[Files]:
    """Files in runs of about ``size`` bytes."""
    out, names, held = [], [], 0
    for name, n in files:
        if names and held + n > size:
            out, names, held = [*out, Files(tuple(names))], [], 0
        names, held = [*names, name], held + n
    return [*out, Files(tuple(names))] if names else out


def number(value, kind: type):
    """A number from its text; null if it is none."""
    try:
        text = str(value).strip()
        return None if value is None or "_" in text else kind(text)
    except ValueError:
        return None


def instant(text: str, zone: ZoneInfo) -> datetime.datetime | None:
    try:
        return datetime.datetime.fromisoformat(text.strip()).replace(tzinfo=zone).astimezone(datetime.UTC)
    except (ValueError, OverflowError):
        return None


class _Payloads:
    """What the batch and the stream share."""

    def __init__(self, options: dict[str, str]):
        self.path, self.series, self.zone = options["path"], options["series"], options.get("zone", "UTC")
        self.fixed = [options.get("source", "landed"), options.get("interval", "1d")]
        self.rejects = options.get("rows", "bars") == "rejects"
        self.size = int(options.get("size", 128 << 20))

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema, held = ARROW_REJECTS if self.rejects else ARROW, []
        for row in self._rows(partition.names):
            held.append(row)
            if len(held) == BATCH:
                yield self._batch(held, schema)
                held = []
        if held:
            yield self._batch(held, schema)

    @staticmethod
    def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def _rows(self, names: tuple[str, ...]) -> Iterator[tuple]:
        import io

        store, root = store_of(self.path)
        zone = ZoneInfo(self.zone)
        for name in names:
            with store.open_input_stream(f"{root}/{name}") as raw, io.BufferedReader(raw) as lines:
                for line in lines:
                    if line.strip():
                        ticker, points, reason = self._fetch(line)
                        if self.rejects and reason:
                            yield ticker, reason
                        elif not self.rejects:
                            yield from self._points(ticker, points, zone)

    def _fetch(self, line: bytes) -> tuple[str | None, dict, str | None]:
        """Ticker and points of a line, or why it has none."""
        try:
            entry = json.loads(line)
        except ValueError:
            return None, {}, "not JSON"
        if not isinstance(entry, dict):
            return None, {}, "not JSON"
        ticker = entry.get("ticker")
        ticker = ticker if ticker is None else str(ticker)
        try:
            body = json.loads(entry.get("payload") or "")
        except (ValueError, TypeError):
            return ticker, {}, "not JSON"
        points = body.get(self.series) if isinstance(body, dict) else None
        if isinstance(points, dict):
            return ticker, points, None
        notice = (body.get("Note") or body.get("Information")) if isinstance(body, dict) else None
        return ticker, {}, str(notice or "no series")

    def _points(self, ticker: str | None, points: dict, zone: ZoneInfo) -> Iterator[tuple]:
        for at, point in points.items():
            point = point if isinstance(point, dict) else {}
            prices = [number(point.get(f"{k}. {c}"), float) for k, c in enumerate(PRICES, 1)]
            ts = instant(at, zone)
            if ts is not None and prices[3] is not None:
                volume = number(point.get("5. volume"), int)
                yield ticker, *self.fixed, ts, *prices, volume if volume is None or -(1 << 63) <= volume < 1 << 63 else None


class PayloadReader(_Payloads, DataSourceReader):
    def partitions(self) -> list[Files]:
        return dealt(listed(self.path), self.size) or [Files(())]


class PayloadStream(_Payloads, DataSourceStreamReader):
    """Offsets are numbers of entries in the log of files; entry n has the files that are new with it."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.log = options["log"].rstrip("/")
        self.seen, self.last = None, 0

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def _entries(self) -> list[int]:
        return [int(name) for name, _ in listed(self.log) if name.isdigit()]

    def _entry(self, n: int) -> list[tuple[str, int]]:
        store, root = store_of(self.log)
        with store.open_input_stream(f"{root}/{n:09d}") as raw:
            return [tuple(f) for f in json.loads(raw.read())]

    def latestOffset(self) -> dict:
        if self.seen is None:
            numbers = self._entries()
            self.seen, self.last = {name for n in numbers for name, _ in self._entry(n)}, max(numbers, default=0)
        now = listed(self.path)
        new = [f for f in now if f[0] not in self.seen]
        if new:
            self._write(self.last + 1, new)
            self.last += 1
            self.seen.update(name for name, _ in new)
        return {"entry": self.last}

    def _write(self, n: int, files: list[tuple[str, int]]) -> None:
        """An entry appears whole or not at all."""
        store, root = store_of(self.log)
        store.create_dir(root, recursive=True)
        part = f"{root}/.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(json.dumps(files).encode())
        store.move(part, f"{root}/{n:09d}")

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return dealt([f for n in range(start["entry"] + 1, end["entry"] + 1) for f in self._entry(n)], self.size)


class PayloadSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "payloads"

    def schema(self) -> str:
        return REJECTS if self.options.get("rows", "bars") == "rejects" else BARS

    def reader(self, schema) -> PayloadReader:
        return PayloadReader(dict(self.options))

    def streamReader(self, schema) -> PayloadStream:
        return PayloadStream(dict(self.options))


def payloads(spark, path: str, series: str, stream: bool = False, **options: str):
    """The rows of a landing folder; a stream needs ``log``."""
    spark.dataSource.register(PayloadSource)
    reader = (spark.readStream if stream else spark.read).format("payloads")
    return reader.options(path=path, series=series, **options).load()
