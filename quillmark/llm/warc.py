"""WARC archives of pages, and their capture index made by an external merge of sorted runs.

``write_archive`` turns pages into WARC/1.1 records, each a gzip member of its own, in files of about ``file_bytes``. Tasks write
them through Arrow's file systems under names that depend on the partition only and move them into place when they are whole, so a task that runs again
replaces its own files. Of the pages with one payload the largest ``page_id`` is the response; the others become revisit records that keep the
HTTP head only, and name the response by ``WARC-Refers-To``. The response of a payload is found by a partial aggregate
over digests and joins of ids and digests; the pages themselves aren't shuffled while the counted table of revisits can be broadcast.

``read_archive`` reads the files back by members and ``Content-Length``; every capture carries its file, offset and length, by which ``fetch`` gets the
record alone. ``build_index`` orders the captures by an external merge: tasks sort stretches of ``run_rows`` captures and write them as runs; more than ``fan_in`` runs
are merged by groups into longer ones; at last ranges of the key (URL key, time, id), cut at samples of the runs, are merged at once, each from its part of all
runs. Every merge is a loser tree over streams that hold a batch of each run, so memory depends on neither the runs' lengths nor the ranges'. Ranges are
cut by the whole key, so one URL with a third of the captures still spreads over ranges. The driver holds the names of the runs.

Defined results: a null html is an empty payload, a null url an empty target. Null ids are not archived. Repeated ids
are archived as often as they come; equal payloads under the largest id are then all responses. An empty table writes an
empty archive and gives an empty index. ``crawled_at`` (a timestamp column) dates a capture where the table has it; otherwise the id counts
seconds from a fixed day, which keeps the archive reproducible. Other columns aren't used. Captures with one key are in order of file and offset.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm.shared import checkpointed, join_counted, make_folder

HEAD_END = b"\r\n\r\n"
CAPTURES = "page_id long, url string, url_key string, captured_at long, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
_NAMES = [c.split()[0] for c in CAPTURES.split(", ")]
_TYPES = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in CAPTURES.split(", ")])
_KEY = [_NAMES.index(n) for n in ("url_key", "captured_at", "page_id", "file", "offset")]
_EPOCH = 1_577_836_800
_ID = "urn:capture:"
_LOCATOR = re.compile(r"^[a-z][a-z0-9+.-]*://", re.I)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str) -> str:
    """Sort-friendly form: host labels reversed, then path and query, lower case, no scheme, port 80 or ``www``."""
    try:
        parts = urlsplit(url if _LOCATOR.match(url) else f"//{url}")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){tail}".lower()


def _header(value: str) -> str:
    """A header value on one line; percent signs and line ends are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unheader(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int, url: str, when: str, html: str, sha1: str, refers_to: int | None) -> str:
    """One record without the two line ends that close it."""
    length = len(html.encode())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
    block = http if refers_to is not None else http + html
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{page_id}>", f"WARC-Date: {when}", f"WARC-Target-URI: {_header(url)}", f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block.encode())}"]) + "\r\n\r\n" + block


class _Output:
    """A file that appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        self.where, root = fs.FileSystem.from_uri(folder)
        self.path, self.draft = f"{root}/{name}", f"{root}/_draft-{uuid.uuid4().hex}"
        self.stream = self.where.open_output_stream(self.draft)

    def close(self) -> None:
        self.stream.close()
        self.where.move(self.draft, self.path)


def _sha1(html: str):
    return F.sha1(F.coalesce(F.col(html).cast("string"), F.lit("")))


def write_archive(pages: DataFrame, path: str, *, min_bytes: int = 0, file_bytes: int = 16 << 20, broadcast_rows: int = 400_000) -> None:
    """Write ``pages`` (page_id, url, html, maybe crawled_at) as gzipped WARC files under ``path``."""
    when = F.unix_seconds(F.col("crawled_at").cast("timestamp")) if "crawled_at" in pages.columns else F.col("page_id").cast("long") % 1_000_000_000 + _EPOCH
    pages = pages.where("page_id is not null")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.date_format(F.timestamp_seconds(F.coalesce(when, F.lit(_EPOCH))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("crawled"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        _sha1("html").alias("sha1"),
    )
    named = pages.where(F.octet_length(F.coalesce(F.col("html").cast("string"), F.lit(""))) >= min_bytes).select(F.col("page_id").cast("long").alias("page_id"), _sha1("html").alias("sha1"))
    named = checkpointed(named)
    keepers = named.groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1").select("sha1", "keeper")
    revisits = checkpointed(named.join(keepers, "sha1").where("page_id <> keeper").select("page_id", "sha1", F.col("keeper").alias("refers_to")).distinct())
    n = revisits.count()
    rows = join_counted(rows, revisits, ["page_id", "sha1"], "left", n, broadcast_rows).select("page_id", "url", "crawled", "html", "sha1", "refers_to")
    if n > broadcast_rows:  # a shuffle deals rows in any order; files must not depend on it
        rows = rows.sortWithinPartitions("page_id", "sha1", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, out, held, records = TaskContext.get().partitionId(), 0, None, 0, 0
        for batch in batches:
            for i, u, w, h, s, r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out, held = _Output(path, f"part-{part:06d}-{made:05d}.warc.gz"), 0
                    made += 1
                member = gzip.compress((record(i, u, w, h, base64.b32encode(bytes.fromhex(s)).decode(), r) + "\r\n\r\n").encode(), 6, mtime=0)
                out.stream.write(member)
                held += len(member)
                records += 1
                if held >= file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict({"records": pa.array([records], pa.int64())})

    make_folder(pages.sparkSession, path)
    rows.mapInArrow(write, "records long").agg(F.sum("records")).collect()


def members(data: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of every gzip member."""
    at, view = 0, memoryview(data)
    while at < len(data):
        unzip, end, parts = zlib.decompressobj(31), at, []
        while not unzip.eof:
            if end >= len(data):
                raise ValueError(f"the member at byte {at} is cut off")
            parts.append(unzip.decompress(view[end : end + step]))
            end = min(end + step, len(data))
        end -= len(unzip.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def parse_record(data: bytes) -> tuple | None:
    """The capture of one record, by Content-Length; None for records that are no captures. What doesn't fit raises ValueError."""
    import calendar
    import time

    if not data.startswith(b"WARC/1."):
        raise ValueError("no record")
    end = data.index(HEAD_END)
    head = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:])
    start = end + 4
    stop = start + int(head["Content-Length"])
    if data[stop:] != HEAD_END:
        raise ValueError("the record isn't closed")
    kind = head["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    body = data.index(HEAD_END, start) + 4
    sha1 = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        payload = data[body:stop]
        length = len(payload)
        if digest(payload) != sha1:
            raise ValueError("the payload's digest differs")
    else:
        http = data[start : body - 4].decode().split("\r\n")
        length = int(next(x for x in http if x.startswith("Content-Length: ")).split(": ")[1])
    url = _unheader(head["WARC-Target-URI"])
    number = lambda name: int(head[name].strip("<>").removeprefix(_ID))
    return number("WARC-Record-ID"), url, url_key(url), calendar.timegm(time.strptime(head["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ")), length, sha1, kind, number("WARC-Refers-To") if kind == "revisit" else None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPES, strict=True)], schema=_TYPES)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A row per capture. The writer bounds files by bytes, and captures leave in batches as they are read."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for offset, length, data in members(content.as_py()):
                    found = parse_record(data)
                    if found is not None:
                        rows.append((*found, name.as_py().rsplit("/", 1)[-1], offset, length))
                    if len(rows) == 4096:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path", "content").mapInArrow(parse, CAPTURES)


def fetch(path: str, file: str, offset: int, length: int) -> bytes:
    """One record of the archive at ``path`` by its place in the index."""
    where, root = fs.FileSystem.from_uri(path)
    with where.open_input_file(f"{root}/{file}") as f:
        f.seek(offset)
        return gzip.decompress(f.read(length))


class LoserTree:
    """K-way merge of sorted iterables: every step replays one leaf-to-root path, about log2(k) comparisons."""

    def __init__(self, runs: Iterable[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        self.winner = -1
        for leaf in range(self.k):
            self._enter(leaf)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) < (y, b)

    def _enter(self, leaf: int) -> None:
        """A leaf climbs until it meets an empty place; the last to come reaches the top."""
        node = (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = leaf
                return
            if self._before(other, leaf):
                self.losers[node], leaf = leaf, other
            node //= 2
        self.winner = leaf

    def __iter__(self) -> Iterator:
        while self.k and self.heads[self.winner] is not None:
            leaf = self.winner
            yield self.heads[leaf]
            self.heads[leaf] = next(self.runs[leaf], None)
            node = (leaf + self.k) // 2
            while node > 0:
                if self._before(self.losers[node], leaf):
                    self.losers[node], leaf = leaf, self.losers[node]
                node //= 2
            self.winner = leaf


_RUNS = "run string, rows long, samples array<struct<url_key:string,captured_at:bigint,page_id:bigint,file:string,offset:bigint>>"
_RUN_TYPES = pa.schema([("run", pa.string()), ("rows", pa.int64()), ("samples", pa.list_(pa.struct([_TYPES.field(n) for n in ("url_key", "captured_at", "page_id", "file", "offset")])))])
_SAMPLES = 64


def _key(row: tuple) -> tuple:
    return tuple(row[i] for i in _KEY)


def _write_run(folder: str, name: str, batches: Iterable[pa.RecordBatch], rows: int) -> pa.RecordBatch:
    """Write sorted captures as one run; ``samples`` are keys at even distances."""
    out, at, samples = _Output(folder, name), 0, []
    step = max(1, rows // _SAMPLES)
    with pq.ParquetWriter(out.stream, _TYPES) as writer:
        for batch in batches:
            first = -at % step
            for k in range(first, batch.num_rows, step):
                samples.append({n: batch.column(n)[k].as_py() for n in ("url_key", "captured_at", "page_id", "file", "offset")})
            at += batch.num_rows
            writer.write_batch(batch)
    out.close()
    return pa.RecordBatch.from_pylist([{"run": name, "rows": at, "samples": samples}], schema=_RUN_TYPES)


def _read_run(folder: str, name: str, low: tuple | None, high: tuple | None) -> Iterator[tuple[tuple, tuple]]:
    """(key, capture) of a run from ``low`` on and below ``high``, a batch at a time; groups of rows that lie outside aren't read."""
    where, root = fs.FileSystem.from_uri(folder)
    with where.open_input_file(f"{root}/{name}") as f:
        file = pq.ParquetFile(f)
        column = _NAMES.index("url_key")
        bounds = [file.metadata.row_group(g).column(column).statistics for g in range(file.num_row_groups)]
        groups = [g for g, s in enumerate(bounds) if s is None or not s.has_min_max or (low is None or s.max >= low[0]) and (high is None or s.min <= high[0])]
        for batch in file.iter_batches(1024, row_groups=groups):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = _key(row)
                if high is not None and key >= high:
                    return
                if low is None or key >= low:
                    yield key, row


def _merged(folder: str, names: list[str], low: tuple | None = None, high: tuple | None = None) -> Iterator[pa.RecordBatch]:
    out: list = []
    for _, row in LoserTree(_read_run(folder, n, low, high) for n in names):
        out.append(row)
        if len(out) == 4096:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def build_index(captures: DataFrame, folder: str, *, run_rows: int = 100_000, fan_in: int = 64, range_rows: int = 100_000) -> DataFrame:
    """Captures in global order of (url_key, captured_at, page_id); range k of the result precedes range k + 1.

    Runs are kept under ``folder``, which must stay until the result has been read.
    """
    spark = captures.sparkSession
    make_folder(spark, folder)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, rows = TaskContext.get().partitionId(), 0, []

        def run() -> pa.RecordBatch:
            rows.sort(key=_key)
            return _write_run(folder, f"run-0-{part:06d}-{made:05d}", (_batch(rows[a : a + 4096]) for a in range(0, len(rows), 4096)), len(rows))

        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            if len(rows) >= run_rows:
                yield run()
                made, rows = made + 1, []
        if rows:
            yield run()

    def merge(level: int) -> Callable:
        def merge_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for group, names, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield _write_run(folder, f"run-{level}-{group:06d}", _merged(folder, names), rows)

        return merge_groups

    runs = checkpointed(captures.select(*_NAMES).mapInArrow(sort, _RUNS))
    level = 0
    while (n := runs.count()) > fan_in:
        level += 1
        names = [(r["run"], r["rows"]) for r in runs.select("run", "rows").orderBy("run").collect()]
        groups = [(k, [x for x, _ in names[a : a + fan_in]], sum(y for _, y in names[a : a + fan_in])) for k, a in enumerate(range(0, n, fan_in))]
        runs = checkpointed(spark.createDataFrame(groups, "group long, names array<string>, rows long").repartition(len(groups), "group").mapInArrow(merge(level), _RUNS))
    last = runs.orderBy("run").collect()  # at most fan_in rows with _SAMPLES keys each, more or less
    names, total = [r["run"] for r in last], sum(r["rows"] for r in last)
    keys = sorted((tuple(x), r["rows"] / len(r["samples"])) for r in last for x in r["samples"])
    cuts, seen = [], 0.0
    for key, weight in keys:
        if seen >= range_rows * (len(cuts) + 1):
            cuts.append(key)
        seen += weight
    cuts = cuts[: max(0, -(-total // range_rows) - 1)]
    bounds = [(k, list(cuts[k - 1]) if k else None, list(cuts[k]) if k < len(cuts) else None) for k in range(len(cuts) + 1)] if total else []
    as_struct = T._parse_datatype_string(_RUNS)["samples"].dataType.elementType  # noqa: SLF001
    schema = T.StructType().add("k", T.LongType()).add("low", as_struct).add("high", as_struct)

    def merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = lambda x: x and (x["url_key"], x["captured_at"], x["page_id"], x["file"], x["offset"])
        for batch in batches:
            for low, high in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                yield from _merged(folder, names, bound(low), bound(high))

    return spark.createDataFrame(bounds, schema).mapInArrow(merge_ranges, CAPTURES)


def archive_and_index(spark: SparkSession, pages: DataFrame, path: str, *, min_bytes: int = 0) -> DataFrame:
    """Write the archive below ``path``, read it back, and return the merged capture index."""
    write_archive(pages, f"{path}/archive", min_bytes=min_bytes)
    return build_index(read_archive(spark, f"{path}/archive"), f"{path}/runs")
