"""WARC archives as a Python data source of Spark: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans a partition for each archive file. In a file, a record's header is
parsed first; equality, membership and prefix predicates on header columns are
pushed down and decided on it alone, and a record that fails, or whose payload
is not wanted (option ``payload`` = ``false``), is passed over: archives of this
writer are compressed record by record and say in each gzip header how long the
record is, so its payload is not even inflated. Other archives, compressed or
plain, are read too.

Each write is committed by a list of its finished files, and a folder's records
are those of all its lists: an append adds a list, an overwrite puts one in
place of the others. So files of tasks that were lost or ran twice, and of
writes that broke off, are never read. An archive file is read by one task;
the writer's are of about 1 GB at most. A file that is cut short or damaged
fails the read with its name and the place, as rows would be lost otherwise.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from kinetrace.llm.sieve import bit_table, split
from kinetrace.llm.textcore import located
from kinetrace.sources.stage import shared_folder, stored
from kinetrace.workers import reachable

SCHEMA = "record_id string, record_type string, target_uri string, date string, page_id bigint, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_files-"
_GZIP = struct.Struct("<2sBBIBBHccHII")  # magic, method, flags, time, two bytes, extra length, "sl", its length, record's and header's length
_LIST = ("record_id", "record_type", "target_uri", "date", "payload_digest")
BATCH_BYTES = 8 << 20
#: Bytes after which the writer begins another file (option ``fileBytes``).
FILE_BYTES = 1 << 30


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member: a response, or a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = f"urn:x-page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    raw = head + block + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    gzip = _GZIP.pack(b"\x1f\x8b", 8, 4, 0, 0, 255, 12, b"s", b"l", 8, _GZIP.size + len(body) + 8, len(head))
    return gzip + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def parse_header(head: bytes) -> dict[str, str]:
    """Fields of a record's header block, names in lower case; continued lines are joined."""
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


def columns_of(fields: dict[str, str]) -> dict:
    """The header columns of SCHEMA."""

    def number(name: str) -> int | None:
        value = fields.get(name, "")
        return int(value) if value.lstrip("-").isdigit() else None

    digest = fields.get("warc-payload-digest", "")
    value = digest.partition(":")[2]
    if digest.lower().startswith("sha1:") and len(value) == 32:
        digest = base64.b32decode(value.upper()).hex()
    elif digest.lower().startswith("sha1:"):
        digest = value.lower()
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": fields.get("warc-type"),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "page_id": number("x-page-id"),
        "refers_to": number("x-refers-to-page-id"),
        "payload_digest": digest or None,
    }


def fits(row: dict, filters: list[Filter]) -> bool:
    """Whether header columns hold all pushed predicates."""
    for f in filters:
        value = row[f.attribute[0]]
        if isinstance(f, IsNotNull):
            ok = value is not None
        elif isinstance(f, EqualTo):
            ok = value is not None and value == f.value
        elif isinstance(f, In):
            ok = value in f.value
        else:
            ok = value is not None and value.startswith(f.value)
        if not ok:
            return False
    return True


class DamagedArchive(ValueError):
    """An archive file ends within a record, or holds something that is no record."""


class _Input:
    """A window on a file that grows as needed."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def at(self, start: int, length: int) -> bytes:
        """Up to ``length`` bytes from ``start``; fewer at the file's end."""
        if start < self.start or start + length > self.start + len(self.data):
            self.file.seek(start)
            self.start, self.data = start, self.file.read(max(length, 1 << 16))
        return self.data[start - self.start : start - self.start + length]


def _inflate(source: _Input, start: int, whole: bool) -> tuple[bytes, int | None]:
    """A gzip member's text, up to the end of the record's header unless ``whole``; where the member ends, if that was seen."""
    inflate, out, at = zlib.decompressobj(31), bytearray(), start
    while not inflate.eof:
        part = source.at(at, 1 << 14)
        if not part:
            raise DamagedArchive(f"the file ends within the compressed record at {start}")
        at += len(part)
        try:
            out += inflate.decompress(part, 0 if whole else 1 << 12)
            while not whole and inflate.unconsumed_tail and b"\r\n\r\n" not in out:
                out += inflate.decompress(inflate.unconsumed_tail, 1 << 12)
        except zlib.error as e:
            raise DamagedArchive(f"the compressed record at {start} cannot be read: {e}") from e
        if not whole and b"\r\n\r\n" in out:
            return bytes(out), None
    return bytes(out), at - len(inflate.unused_data)


def records(file, size: int, filters: list[Filter], want_payload: bool) -> Iterator[dict]:
    """Rows of one archive file that hold ``filters``.

    A file that ends within a record, or holds bytes that begin none, raises
    :class:`DamagedArchive` with the place; blank lines may follow a record.
    """
    source, at = _Input(file, size), 0
    while at < size:
        began = at
        head = source.at(at, _GZIP.size)
        if head[:2] == b"\x1f\x8b":
            known = None
            if len(head) == _GZIP.size and head[3] == 4:
                parts = _GZIP.unpack(head)
                if parts[7:9] == (b"s", b"l"):
                    known = at + parts[10]
            text, end = _inflate(source, at, False)
            cut = text.find(b"\r\n\r\n")
            if cut < 0 or not text.startswith(b"WARC/"):
                raise DamagedArchive(f"the compressed record at {began} has no whole header")
            fields = parse_header(text[:cut])
            row = columns_of(fields)
            good = fits(row, filters)
            revisit = row["record_type"] == "revisit"
            if good and (want_payload or revisit) or end is None and known is None:
                text, seen = _inflate(source, at, True)
                end = seen
            size_of = int(fields.get("content-length", 0))
            at, block = known or end, text[cut + 4 : cut + 4 + size_of]
            if at > size or (good and want_payload and len(block) < size_of):
                raise DamagedArchive(f"the file ends within the record at {began}")
        else:
            length, text = 1 << 12, b""
            while (cut := text.find(b"\r\n\r\n", len(text) - len(text.lstrip(b"\r\n")))) < 0:
                longer = source.at(at, length)
                start = longer.lstrip(b"\r\n")
                if not start and at + len(longer) == size:
                    return  # blank lines after the last record
                if not b"WARC/".startswith(start[:5]):
                    raise DamagedArchive(f"no record begins at {began}")
                if len(longer) == len(text):
                    raise DamagedArchive(f"the file ends within the header of the record at {began}")
                text, length = longer, 2 * length
            fields = parse_header(text[:cut].lstrip(b"\r\n"))
            row = columns_of(fields)
            size_of = int(fields.get("content-length", 0))
            good = fits(row, filters)
            block = source.at(at + cut + 4, size_of) if good and (want_payload or row["record_type"] == "revisit") else b""
            at += cut + 4 + size_of
            if at > size:
                raise DamagedArchive(f"the file ends within the record at {began}")
            while source.at(at, 2) == b"\r\n":
                at += 2
        if not good:
            continue
        http, _, body = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
        stated = parse_header(http).get("content-length") if http else None
        if row["record_type"] == "revisit":
            yield row | {"payload_bytes": int(stated) if stated else None, "payload": None}
        else:
            yield row | {"payload_bytes": len(body) if want_payload else None, "payload": body if want_payload else None}


@dataclass
class _File(InputPartition):
    path: str
    size: int

    def __init__(self, path: str, size: int):
        super().__init__(None)
        self.path, self.size = path, size


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path, payload
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            known = len(f.attribute) == 1 and f.attribute[0] in (*_LIST, "page_id", "refers_to")
            if known and (isinstance(f, (EqualTo, In, IsNotNull)) or isinstance(f, StringStartsWith) and f.attribute[0] in _LIST):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """A partition for each file: those of the folder's lists, or all in a folder without one."""
        system, path = located(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.File:
            return [_File(path, info.size)]
        if lists := manifests(system, path):
            found = [(f"{path}/{n}", s) for m in lists for n, s in listed(system, m)]
        else:
            found = [(i.path, i.size) for i in system.get_file_info(fs.FileSelector(path, recursive=True)) if i.type == fs.FileType.File and i.base_name.endswith((".warc", ".warc.gz"))]
        return [_File(p, s) for p, s in sorted(found)] or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        system, _ = located(self.path)
        rows, held = [], 0
        with system.open_input_file(partition.path) as file:
            try:
                for row in records(file, partition.size, self.filters, self.payload):
                    rows.append(row)
                    held += 500 + len(row["payload"] or b"")
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
            except DamagedArchive as e:
                raise DamagedArchive(f"{partition.path}: {e}") from e
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def manifests(system: fs.FileSystem, path: str) -> list[str]:
    """The lists of finished files in a folder."""
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(i.path for i in found if i.type == fs.FileType.File and i.base_name.startswith(MANIFEST) and i.base_name.endswith(".json"))


def listed(system: fs.FileSystem, manifest: str) -> list[tuple[str, int]]:
    """Names and sizes of the files in a list."""
    with system.open_input_stream(manifest) as f:
        return [(name, size) for name, size in json.loads(f.read())]


@dataclass
class _Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Rows need page_id, url, payload (binary), payload_digest (hexadecimal SHA-1), refers_to and date."""

    def __init__(self, path: str, overwrite: bool = False, file_bytes: int = FILE_BYTES):
        self.path, self.overwrite, self.file_bytes = path, overwrite, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        """Files of about ``FILE_BYTES``, as a file is read in one task; a record is never cut."""
        system, path = located(self.path)
        files, out = [], None
        for batch in iterator:
            for r in batch.to_pylist():
                if out is None:
                    system.create_dir(path, recursive=True)
                    name, total = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                data = record(r["page_id"], r["url"], r["payload"] or b"", r["payload_digest"], r["refers_to"], r["date"])
                out.write(data)
                total += len(data)
                if total >= self.file_bytes:
                    out.close()
                    files.append((name, total))
                    out = None
        if out is not None:
            out.close()
            files.append((name, total))
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        """Adds this write's list under a name of its own. An overwrite then drops the older lists, and their files last,
        so that the folder always reads as a whole, either old or new or, if it breaks off here, both."""
        system, path = located(self.path)
        system.create_dir(path, recursive=True)
        older = manifests(system, path) if self.overwrite else []
        name = uuid.uuid4().hex
        with system.open_output_stream(f"{path}/.{name}.tmp", compression=None) as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())
        system.move(f"{path}/.{name}.tmp", f"{path}/{MANIFEST}{name}.json")
        stale = [n for m in older for n, _ in listed(system, m)]
        for m in older:
            system.delete_file(m)
        for n in stale:
            if system.get_file_info(f"{path}/{n}").type == fs.FileType.File:
                system.delete_file(f"{path}/{n}")

    def abort(self, messages: list[_Written | None]) -> None:
        system, path = located(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                system.delete_file(f"{path}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite, int(self.options.get("fileBytes", FILE_BYTES)))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and lets its predicates be pushed down."""
    reachable(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def to_records(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Rows for the writer, with ``refers_to`` set for all but one record of equal payloads of ``least`` bytes or more.

    That one is the record with the largest id; rows that repeat it are
    responses too. Null html is an empty payload; a null id never gets a
    reference and never is one. Only rows whose digest may occur twice are
    shuffled. Ids have to be whole numbers; others raise a TypeError.
    """
    if not isinstance(pages.schema[id_col].dataType, (T.IntegralType, T.NullType)):
        raise TypeError(f"{id_col} has to hold whole numbers, not {pages.schema[id_col].dataType.simpleString()}")
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("payload_digest", F.sha1("payload"))
    counted = rows.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull()).groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.min("page_id").alias("last"))
    shared = stored(counted.where("first <> last").select("payload_digest", "first"), folder, "shared")
    maybe, clear = split(rows, stored(bit_table(shared, "payload_digest"), folder, "bits"), F.col("payload_digest"))
    met = maybe.join(shared, "payload_digest", "left").withColumn("refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first")))
    columns = ["page_id", "url", "payload", "payload_digest", "refers_to"]
    return met.select(*columns).unionByName(clear.withColumn("refers_to", F.lit(None).cast("long")).select(*columns)).withColumn("date", F.lit(date))


def archive(pages: DataFrame, path: str, mode: str = "append", **names) -> None:
    """Writes a record for each page, beside the folder's records (``append``) or in their place (``overwrite``).

    References are found among the pages of one call; records of earlier calls
    are not looked at.
    """
    register(pages.sparkSession)
    to_records(pages, shared_folder(pages.sparkSession), **names).write.format("warc").mode(mode).save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of a file or folder, columns of SCHEMA."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
