"""Crawl-archive source (S1, S2, F5): ``spark.read.format("warc")``.

A Python Data Source. Without an index an archive is one input partition. With
one (:func:`write_index`) every byte range of an archive is a partition of its
own: archives are concatenated gzip members, one or more records each, and the
index holds for each range where its first member starts and how many records
come before it, so record numbers are those of the whole archive.
:func:`stream_archives` reads archives as they arrive. Each task parses
its part record by record and yields rows

    file string, rec int, warc_type string, url string, status int, charset string,
    body binary

``status`` and ``charset`` come from the HTTP headers of ``response`` records
(null otherwise);
``body`` is the HTTP payload for responses, the raw block for other types.
Record-type and status predicates are filters on these columns, or options
that skip records in the reader; decoding to text follows as column expressions (P1-P3).

Paths are URIs of any file system that pyarrow knows, or local paths, which
must then be the same on every executor; the driver only lists file names.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import json
import zlib
from collections import defaultdict

import pyarrow as pa
from pyarrow import fs
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from grist.functions import text as T
from grist.sources.locate import locate

SCHEMA = ("file string, rec int, warc_type string, url string, status int, charset string, "
          "body binary")


BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
SPLIT_BYTES = 64 << 20      # of an archive in one partition
CHUNK = 1 << 20             # bytes read, or decompressed, at once
MEMBER, RECORD = b"\x1f\x8b\x08", b"WARC/"
ARROW_TYPES = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.binary())


def _list(pattern: str) -> list[str]:
    """Files that a file, folder or ``folder/name*`` pattern names, as URIs."""
    system, path = locate(pattern)
    prefix = pattern[:len(pattern) - len(path)] if pattern.endswith(path) else ""
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [pattern]
    folder, name = (path, "*") if info.type == fs.FileType.Directory else path.rsplit("/", 1)
    found = system.get_file_info(fs.FileSelector(folder))
    return sorted(prefix + f.path for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, name))


def _open(path: str):
    system, own = locate(path)
    with system.open_input_stream(own, compression=None) as probe:
        magic = probe.read(2)
    raw = io.BufferedReader(_Stream(system.open_input_stream(own, compression=None)), 1 << 20)
    return gzip.GzipFile(fileobj=raw) if magic == b"\x1f\x8b" else raw


class _Stream(io.RawIOBase):
    """A pyarrow input stream for Python's readers."""

    def __init__(self, stream):
        self.stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.stream.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def close(self) -> None:
        self.stream.close()
        super().close()


def _starts_record(data: bytes) -> bool:
    """Whether a gzip member that begins a record starts with ``data``."""
    if not data.startswith(MEMBER):
        return False
    try:
        return zlib.decompressobj(31).decompress(data, len(RECORD)) == RECORD
    except zlib.error:
        return False


def _first_member(raw, start: int, stop: int) -> int | None:
    """Place of the first member in [start, stop) that begins a record."""
    if start == 0:
        return 0
    raw.seek(start)
    data, at = raw.read(CHUNK), start
    while data:
        found = data.find(MEMBER)
        while found >= 0 and at + found < stop:
            if len(data) - found < CHUNK // 2:                  # enough of it to decompress its first bytes
                data += raw.read(CHUNK)
            if _starts_record(data[found:found + CHUNK // 2]):
                return at + found
            found = data.find(MEMBER, found + 1)
        if at + len(data) >= stop + len(MEMBER):
            return None
        keep = len(MEMBER) - 1                                  # a member may begin across two reads
        more = raw.read(CHUNK)
        if not more:
            return None
        at, data = at + len(data) - keep, data[-keep:] + more
    return None


class _Members(io.RawIOBase):
    """The decompressed members of a range: from the one at ``start`` up to the
    first one at or after ``stop`` that begins a record."""

    def __init__(self, raw, start: int, stop: int):
        self.raw, self.at, self.stop = raw, start, stop
        raw.seek(start)
        self.pending, self.decoder, self.out = b"", None, b""

    def readable(self) -> bool:
        return True

    def _fill(self, size: int) -> bool:
        while len(self.pending) < size:
            more = self.raw.read(CHUNK)
            if not more:
                break
            self.pending += more
            self.at += len(more)
        return bool(self.pending)

    def _member(self) -> bool:
        """Open the next member; False at the end of the range."""
        if not self._fill(CHUNK // 2) or self.at - len(self.pending) >= self.stop and _starts_record(self.pending):
            return False
        self.decoder = zlib.decompressobj(31)
        return True

    def readinto(self, buffer) -> int:
        while not self.out:
            if self.decoder is None and not self._member():
                return 0
            if not self._fill(1):
                raise EOFError("archive ends inside a gzip member")
            self.out = self.decoder.decompress(self.pending, CHUNK)
            if self.decoder.eof:
                self.pending, self.decoder = self.decoder.unused_data.lstrip(b"\0"), None
            else:
                self.pending = self.decoder.unconsumed_tail
        n = min(len(buffer), len(self.out))
        buffer[:n], self.out = self.out[:n], self.out[n:]
        return n

    def close(self) -> None:
        self.raw.close()
        super().close()


def _open_range(path: str, start: int, stop: int):
    system, own = locate(path)
    return io.BufferedReader(_Members(system.open_input_file(own), start, stop), CHUNK)


def _headers(stream) -> tuple[str | None, dict[str, str]]:
    """Version line and headers up to the blank line; (None, {}) at end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None, {}
    version = line.decode("utf-8", "replace").strip()
    headers = {}
    while True:
        line = stream.readline()
        if not line or line in (b"\r\n", b"\n"):
            break
        key, _, value = line.decode("utf-8", "replace").partition(":")
        headers[key.strip().lower()] = value.strip()
    return version, headers


def _http_payload(block: bytes) -> tuple[int | None, str | None, bytes]:
    """Status code, declared charset and payload of an HTTP response block."""
    head, sep, payload = block.partition(b"\r\n\r\n")
    if not sep:
        head, sep, payload = block.partition(b"\n\n")
    lines = head.decode("latin-1", "replace").splitlines()
    first = lines[0].split() if lines else []
    status = int(first[1]) if len(first) > 1 and first[1].isdigit() else None
    charset = None
    for line in lines[1:]:
        key, _, value = line.partition(":")
        if key.strip().lower() == "content-type" and "charset=" in value.lower():
            charset = value.lower().split("charset=", 1)[1].split(";")[0].strip(" \"'")
    return status, charset, payload


def parse_archive(path: str, types: frozenset[str] | None = None, statuses: frozenset[int] | None = None,
                  body: bool = True, part: tuple[int, int, int] | None = None):
    """Yield ``(file, rec, warc_type, url, status, charset, body)`` for every
    record of the given types and statuses (all, if None); without ``body``
    contents are skipped. ``part`` is (start, stop, number of its first record)
    of a gzip archive's range; the whole archive otherwise."""
    rec = part[2] - 1 if part else -1
    with _open_range(path, *part[:2]) if part else _open(path) as raw:
        stream = io.BufferedReader(raw) if not isinstance(raw, io.BufferedReader) else raw
        while True:
            version, h = _headers(stream)
            if version is None:
                break
            rec += 1
            length = int(h.get("content-length", "0") or 0)
            wtype = h.get("warc-type")
            block = stream.read(length)
            if types is not None and wtype not in types:
                continue
            status, charset, content = (None, None, block)
            if wtype == "response":
                status, charset, content = _http_payload(block)
            if statuses is not None and status not in statuses:
                continue
            yield (path, rec, wtype, h.get("warc-target-uri"), status, charset, content if body else None)


class ArchivePartition(InputPartition):
    def __init__(self, path: str, part: tuple[int, int, int] | None = None):
        super().__init__(path)
        self.path, self.part = path, part


class _Records:
    """What batch and stream readers share: options and the parsing of a partition."""

    def __init__(self, options: dict[str, str]):
        self.pattern = options.get("path") or options.get("paths")
        if not self.pattern:
            raise ValueError("warc source needs a path (file, directory or pattern)")
        self.body = str(options.get("body", "true")).lower() != "false"
        self.types = frozenset(options["types"].split(",")) if options.get("types") else None
        self.statuses = frozenset(map(int, options["statuses"].split(","))) if options.get("statuses") else None

    def read(self, partition):
        rows, size = [], 0
        for r in parse_archive(partition.path, self.types, self.statuses, self.body, partition.part):
            rows.append(r)
            size += len(r[-1] or b"")
            if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


class ArchiveReader(_Records, DataSourceReader):
    """One partition for each archive, or for each range that the ``index`` (a
    folder of :func:`write_index`) has of it; rows go to Spark as Arrow batches of
    bounded size. The options ``types`` and ``statuses`` (comma-separated) skip
    other records where they are read; ``body=false`` leaves contents out. (They
    are options rather than pushed filters: Spark 4.1 keeps a reader's pushed
    filters for other queries on the same DataFrame, which then lose rows.)"""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.files = _list(self.pattern)
        self.index = options.get("index")

    def partitions(self):
        ranges = _read_index(self.index) if self.index else {}
        return [ArchivePartition(p, part) for p in self.files for part in ranges.get(p, [None])]


class ArchiveStreamReader(_Records, DataSourceStreamReader):
    """Archives that appear in a folder, each once. Micro-batch ``n`` takes the
    files that the ``log`` folder's entry ``n`` names; an entry is written before
    its offset is given to Spark and never changes, so a restarted query plans the
    same files again for a batch that had not ended. At most
    ``maxFilesPerTrigger`` files (in the order of their names) make a batch.
    Files must appear whole, as by a rename."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        if not options.get("log"):
            raise ValueError("an archive stream needs a shared folder for its log")
        self.log = options["log"].rstrip("/")
        self.most = int(options.get("maxFilesPerTrigger", "1000"))

    def _entries(self) -> list[str]:
        system, own = locate(self.log)
        system.create_dir(own, recursive=True)
        return [p for p in _list(f"{self.log}/*.json")]

    def _files(self, entry: str) -> list[str]:
        system, own = locate(entry)
        with system.open_input_stream(own) as f:
            return json.loads(f.read())

    def initialOffset(self):
        return {"batch": 0}

    def latestOffset(self):
        entries = self._entries()
        known = {p for e in entries for p in self._files(e)}
        new = [p for p in _list(self.pattern) if p not in known][:self.most]
        if new:
            system, own = locate(f"{self.log}/{len(entries) + 1:012d}.json")
            with system.open_output_stream(own + ".new") as f:
                f.write(json.dumps(new).encode())
            system.move(own + ".new", own)
            return {"batch": len(entries) + 1}
        return {"batch": len(entries)}

    def partitions(self, start, end):
        return [ArchivePartition(p) for n in range(start["batch"] + 1, end["batch"] + 1) for p in self._files(f"{self.log}/{n:012d}.json")]

    def commit(self, end):
        pass


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW_TYPES)],
                                      names=[c.split(" ")[0] for c in SCHEMA.split(", ")])


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArchiveStreamReader(self.options)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records of archives; ``options`` as :class:`ArchiveReader` takes them."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("warc").options(**options).load(path)


def stream_archives(spark: SparkSession, path: str, log: str, **options) -> DataFrame:
    """Records of archives as they appear in ``path``; ``options`` as :class:`ArchiveStreamReader` takes them."""
    spark.dataSource.register(ArchiveSource)
    return spark.readStream.format("warc").options(log=log, **options).load(path)


def index_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, low, stop, start, first, records): one row for each byte range of
    each archive. The range's members begin at ``start`` (null: none does) and its
    first record is number ``first``. Every range is read by a task of its own;
    archives that aren't gzip files are one range."""
    ranges = []
    for p in _list(path):
        system, own = locate(p)
        with system.open_input_file(own) as f:
            size, split = f.size(), f.read(2) == MEMBER[:2]
        step = split_bytes if split else max(size, 1)
        ranges += [(p, low, min(low + step, size) if split else None) for low in range(0, size, step)]
    schema = "file string, low long, stop long"
    if not ranges:
        return spark.createDataFrame([], schema + ", start long, records long, first long")

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["start"], r["records"] = 0, None
                if r["stop"] is not None:
                    system, own = locate(r["file"])
                    with system.open_input_file(own) as raw:
                        r["start"] = _first_member(raw, r["low"], r["stop"])
                    part = (r["start"], r["stop"], 0)
                    r["records"] = 0 if r["start"] is None else sum(1 for _ in parse_archive(r["file"], body=False, part=part))
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string())] + [(c, pa.int64()) for c in ("low", "stop", "start", "records")]))

    counted = (spark.createDataFrame(ranges, schema).repartition(len(ranges), "file", "low")
               .mapInArrow(run, schema + ", start long, records long"))
    before = Window.partitionBy("file").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("first", F.coalesce(F.sum("records").over(before), F.lit(0)))


def write_index(spark: SparkSession, path: str, out: str, split_bytes: int = SPLIT_BYTES) -> None:
    """Write the ranges of all archives of ``path`` as Parquet, for the reader's option ``index``."""
    index_archives(spark, path, split_bytes).write.mode("overwrite").parquet(out)


def _read_index(path: str) -> dict[str, list[tuple[int, int, int]]]:
    """The ranges of each archive, a few numbers for every ``SPLIT_BYTES`` of it."""
    system, own = locate(path)
    found = pads.dataset(own, filesystem=system, format="parquet").to_table().to_pylist()
    out = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["file"], r["low"])):
        if r["stop"] is None:
            out[r["file"]].append(None)
        elif r["start"] is not None and r["records"]:
            out[r["file"]].append((r["start"], r["stop"], r["first"]))
    return dict(out)


def extract_responses(records: DataFrame) -> DataFrame:
    """S1 (+F5, P1, P3): HTTP 200 ``response`` records as plain text."""
    ok = records.filter((F.col("warc_type") == "response") & (F.col("status") == 200))
    html = T.decode_html_bytes(F.col("body"), F.col("charset"))
    return ok.select("file", "rec", "url", T.html_to_text(html).alias("text"))


def extract_conversions(records: DataFrame) -> DataFrame:
    """S2 (+P2): ``conversion`` (plain-text) records, UTF-8 with replacement."""
    conv = records.filter(F.col("warc_type") == "conversion")
    return conv.select("file", "rec", "url", T.decode_utf8_lenient(F.col("body")).alias("text"))


def first_records(df: DataFrame, n: int) -> DataFrame:
    """L1: the first ``n`` records in (file, record) order — a bounded top-n."""
    return df.orderBy("file", "rec").limit(n)
