"""Legacy archives: ARC files, their conversion to WARC, and reading WARC back.

``write_arc``     rows -> ARC files (versions 1 and 2), one index row per record;
``scan_arc``      ARC files of any origin -> one row per record.  A file is walked record by
                  record: header lines are read by the fields that the file's first record
                  declares (by its version, if it names none), contents by their declared
                  lengths.  No index is needed, and files may be plain, a gzip member per
                  record, or gzip members that hold several records;
``convert_arc``   ARC files -> WARC files, by a second walk: WARC identifiers, dates, types and
                  digests are made from what was parsed.  A record whose payload occurs
                  before (same digest and size) becomes a revisit of the one with the smallest
                  id.  Records without an HTTP head (dns lookups, for one) become resources;
``read_warc``     WARC files -> one row per record, by a walk too.

A task holds one record at a time.  Files go to the shared folder by a name that is new in each
task attempt, and only the files of successful attempts are named in the tables: a lost
executor leaves an unread file behind, nothing else.  Written files end at
``FILE_BYTES`` or ``FILE_RECORDS``, which bounds the work of a conversion task.

Defined results: a null html is an empty payload; a null url is written as
"-"; blanks and control characters in a url are percent-encoded; a null page_id is
left out of the record and read back as null, and counts as larger than all others (records
of other archives have none, and go by file and offset); repeated rows give one response and
revisits of it; a file that breaks off or is damaged gives the records before that place and a
row with the fault, and is converted up to there; an empty table gives no files and no rows;
further columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import itertools
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm.common import join_hot
from recflow.session import cut_lineage, ensure_checkpoint_dir

FILE_BYTES = 32 << 20
FILE_RECORDS = 20_000
GZIP_LEVEL = 3
#: fields of a URL record by ARC version
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
#: names of the fields in the first record of a file
FIELD_NAMES = {"url": "URL", "ip": "IP-address", "date": "Archive-date", "type": "Content-type", "result": "Result-code",
               "checksum": "Checksum", "location": "Location", "offset": "Offset", "filename": "Filename",
               "length": "Archive-length"}
ARC_DATE = "20240101000000"
#: a table of files is dealt to no more tasks than this
FILE_TASKS = 20_000
ROWS_AT_ONCE = 5_000
INDEX = ("arc string, offset long, record_bytes long, page_id long, digest string, payload_bytes long")


def storage(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or local path."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean_url(url: str | None) -> str:
    if not url:
        return "-"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: urllib.parse.quote(m.group()), url)


def http_message(payload: bytes, page_id: int | None) -> bytes:
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload


def http_split(block: bytes) -> tuple[bytes, bytes]:
    """(head with the blank line that ends it, payload) of an HTTP message; no head if it is none."""
    end = re.search(rb"\r?\n\r?\n", block) if block.startswith(b"HTTP/") else None
    return (block[:end.end()], block[end.end():]) if end else (b"", block)


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    head, body = http_split(block)
    return header_fields(head.splitlines()[1:]), body


def long_or_none(text: str | None) -> int | None:
    """A decimal number in the range of a long; None for anything else."""
    if text is None or not re.fullmatch(r"-?[0-9]{1,19}", text):
        return None
    return int(text) if -1 << 63 <= int(text) < 1 << 63 else None


def header_fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


# --- ARC ---------------------------------------------------------------------

def arc_file_head(version: int, name: str) -> bytes:
    """The file's own record: it names the version and the fields of later records."""
    body = f"{version} 0 recflow\n{' '.join(FIELD_NAMES[f] for f in ARC_FIELDS[version])}\n\n".encode()
    line = f"filedesc://{name} 0.0.0.0 {ARC_DATE} text/plain"
    line += f" {len(body)}\n" if version == 1 else f" 200 - - 0 {name} {len(body)}\n"
    return line.encode() + body


def arc_record(version: int, name: str, offset: int, url: str | None, content: bytes) -> bytes:
    line = f"{clean_url(url)} 0.0.0.0 {ARC_DATE} text/html"
    line += f" {len(content)}\n" if version == 1 else f" 200 - - {offset} {name} {len(content)}\n"
    return line.encode("utf-8", "surrogatepass") + content + b"\n"


def parse_arc_line(line: bytes, version: int, fields: Sequence[str] = ()) -> dict[str, str]:
    """Fields of a header line; blanks inside the url are kept (fields are split from the right)."""
    fields = fields or ARC_FIELDS[version]
    parts = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(fields) - 1)
    if len(parts) != len(fields) or not parts[-1].isdigit():
        raise ValueError(f"not an ARC version {version} header line: {line[:200]!r}")
    return dict(zip(fields, parts))


def arc_version(member: bytes) -> int:
    """Version that the file's first record declares."""
    body = member.split(b"\n", 2)
    if not member.startswith(b"filedesc:") or len(body) < 3:
        raise ValueError("the file does not start with a filedesc record")
    return int(body[1].split(b" ", 1)[0])


def parse_arc_record(member: bytes, version: int) -> tuple[dict[str, str], bytes]:
    line, _, rest = member.partition(b"\n")
    fields = parse_arc_line(line, version)
    content = rest[:int(fields["length"])]
    if len(content) != int(fields["length"]):
        raise ValueError("record is shorter than its declared length")
    return fields, content


def declared_fields(content: bytes, version: int) -> Sequence[str]:
    """Fields of later header lines, as the contents of a file's first record name them."""
    known = {name.lower(): field for field, name in FIELD_NAMES.items()}
    lines = content.split(b"\n", 2)
    names = lines[1].decode("latin-1").strip().lower().split(" ") if len(lines) > 1 else []
    fields = [known.get(n) for n in names]
    sound = None not in fields and fields[:1] == ["url"] and fields[-1:] == ["length"] and {"ip", "date", "type"} <= set(fields)
    return fields if sound else ARC_FIELDS[version]


@contextmanager
def open_archive(fs: pafs.FileSystem, path: str) -> Iterator[io.BufferedIOBase]:
    """The bytes of a plain or gzip file, whatever its name and however many members it has."""
    with fs.open_input_stream(path, compression=None) as file:
        raw = io.BufferedReader(file, 1 << 18)
        yield gzip.GzipFile(fileobj=raw, mode="rb") if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def walk_arc(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset in the uncompressed bytes, header fields, contents) of every record, in order, the
    file's own record first.  Blank lines between records are skipped."""
    at, version, fields = 0, 0, ()
    while line := stream.readline():
        if not line.strip():
            at += len(line)
            continue
        if not fields:
            if not line.startswith(b"filedesc:"):
                raise ValueError("the file does not start with a filedesc record")
            length = line.split()[-1]
            if not length.isdigit():
                raise ValueError(f"not an ARC header line: {line[:200]!r}")
            content = stream.read(int(length))
            version = arc_version(line + content)
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            own = ARC_FIELDS[1 if len(line.split()) <= len(ARC_FIELDS[1]) else 2]
            header, fields = parse_arc_line(line, version, own), declared_fields(content, version)
        else:
            header = parse_arc_line(line, version, fields)
            content = stream.read(int(header["length"]))
        if len(content) != int(header["length"]):
            raise ValueError("record is shorter than its declared length")
        yield at, header, content
        at += len(line) + len(content)


def walk_sound(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str] | None, bytes]]:
    """``walk_arc`` that ends at the first damaged place with (start of the last sound record, None, the fault)."""
    at = 0
    try:
        for at, header, content in walk_arc(stream):
            yield at, header, content
    except (ValueError, EOFError, OSError, zlib.error) as fault:
        if isinstance(fault, OSError) and not isinstance(fault, gzip.BadGzipFile):
            raise  # storage that cannot be read is no damage of the file
        yield at, None, f"after the record at {at}: {fault}".encode()


def iso_date(digits: str) -> str:
    d = re.sub(r"\D", "", digits).ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


class _Writer:
    """Gzip members appended to files of bounded size in the shared folder."""

    def __init__(self, folder: str, suffix: str):
        self.fs, self.folder = storage(folder)
        self.uri, self.suffix, self.out, self.name = folder, suffix, None, ""
        self.offset = self.records = 0

    def open(self) -> None:
        self.close()
        self.name = f"{uuid.uuid4().hex}{self.suffix}"
        self.fs.create_dir(self.folder, recursive=True)
        self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        self.offset = self.records = 0

    def full(self) -> bool:
        return self.out is None or self.offset >= FILE_BYTES or self.records >= FILE_RECORDS

    def add(self, data: bytes) -> tuple[int, int]:
        member = gzip.compress(data, GZIP_LEVEL, mtime=0)
        self.out.write(member)
        at = self.offset
        self.offset += len(member)
        self.records += 1
        return at, len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_arc(pages: DataFrame, folder: str, version: int | Sequence[int] = 1, ident: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """Write ARC files and return their index (see ``INDEX``), written to shared storage.  Of several
    versions, tasks take turns."""
    versions = [version] if isinstance(version, int) else list(version)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = _Writer(folder, ".arc.gz")
        version = versions[TaskContext.get().partitionId() % len(versions)]
        for frame in frames:
            rows = []
            for page_id, link, text in zip(frame["page_id"], frame["url"], frame["html"]):
                if w.full():
                    w.open()
                    w.add(arc_file_head(version, w.name))
                payload = text.encode("utf-8", "surrogatepass") if text is not None else b""
                page = None if pd.isna(page_id) else int(page_id)
                at, size = w.add(arc_record(version, w.name, w.offset, link, http_message(payload, page)))
                rows.append((w.name, at, size, page, payload_digest(payload), len(payload)))
            yield pd.DataFrame(rows, columns=["arc", "offset", "record_bytes", "page_id", "digest", "payload_bytes"]
                               ).astype({"page_id": "Int64"})
        w.close()

    src = pages.select(F.col(ident).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return cut_lineage(src.mapInPandas(write, INDEX))


# --- WARC --------------------------------------------------------------------

def record_id(arc: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{arc}#{offset}')}>"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_warc_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = header_fields(lines[1:])
    return fields, rest[:int(fields["content-length"])]


def record_kind(offset: int, fields: dict[str, str], content: bytes) -> str:
    """WARC type of an ARC record that is no revisit."""
    if fields["url"].lower().startswith("filedesc:") and (offset == 0 or not content.startswith(b"HTTP/")):
        return "warcinfo"
    return "response" if http_split(content)[0] else "resource"


def convert_record(arc: str, offset: int, fields: dict[str, str], content: bytes,
                   original: tuple[str, int, int | None] | None) -> bytes:
    """One WARC record of an ARC record; ``original`` = (arc, offset, page id) of the
    record that a revisit refers to."""
    kind = record_kind(offset, fields, content)
    out = [("WARC-Type", kind), ("WARC-Record-ID", record_id(arc, offset)), ("WARC-Date", iso_date(fields["date"])),
           ("WARC-IP-Address", fields["ip"])]
    if kind == "warcinfo":
        return warc_record([*out, ("WARC-Filename", arc), ("Content-Type", "text/plain")], content)
    out.append(("WARC-Target-URI", fields["url"]))
    if kind == "resource":
        digest = f"sha1:{payload_digest(content)}"
        return warc_record([*out, ("Content-Type", fields["type"]), ("WARC-Payload-Digest", digest),
                            ("WARC-Block-Digest", digest)], content)
    head, payload = http_split(content)
    block = content
    if original is not None:
        out[0] = ("WARC-Type", "revisit")
        out += [("WARC-Refers-To", record_id(*original[:2])),
                ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                ("X-Payload-Bytes", str(len(payload)))]
        if original[2] is not None:
            out.append(("X-Refers-To-Page-Id", str(original[2])))
        block = head
    out += [("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
            ("WARC-Block-Digest", f"sha1:{payload_digest(block)}")]
    return warc_record(out, block)


def archive_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """(arc) names of the files in a folder of shared storage."""
    fs, path = storage(folder)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    names = [(f.base_name,) for f in found if f.type == pafs.FileType.File and f.base_name.endswith(suffix)]
    return spark.createDataFrame(sorted(names), "arc string")


SCAN = ("arc string, offset long, kind string, target_uri string, date string, page_id long, digest string, "
        "payload_bytes long, fault string")


def scan_arc(files: DataFrame, folder: str) -> DataFrame:
    """One row per record of the ARC files named in ``files`` (arc), the files' own records apart,
    written to shared storage; ``kind`` is null and ``fault`` set where a file could not be read further."""
    n = max(1, min(files.count(), FILE_TASKS))

    def rows(arc: str, stream: io.BufferedIOBase) -> Iterator[tuple]:
        for offset, fields, content in walk_sound(stream):
            if fields is None:
                yield arc, None, None, None, None, None, None, None, content.decode()
                continue
            kind = record_kind(offset, fields, content)
            if kind == "warcinfo":
                continue
            head, payload = http_parts(content)
            yield (arc, offset, kind, fields["url"], iso_date(fields["date"]), long_or_none(head.get("x-page-id")),
                   payload_digest(payload), len(payload), None)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = storage(folder)
        for frame in frames:
            for arc in frame["arc"]:
                with open_archive(fs, f"{path}/{arc}") as stream:
                    found = rows(arc, stream)
                    while part := list(itertools.islice(found, ROWS_AT_ONCE)):
                        yield pd.DataFrame(part, columns=[c.split()[0] for c in SCAN.split(", ")]).astype(
                            {"offset": "Int64", "page_id": "Int64", "payload_bytes": "Int64"})

    return cut_lineage(files.select("arc").repartition(n).mapInPandas(scan, SCAN))


def find_originals(index: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(arc, offset, original) of the records of a scan; ``original`` (arc, offset, page_id) is the response with
    the smallest id of those with the same payload, null for that one itself, for payloads under min_bytes
    and for records without an HTTP head."""
    me = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"),
                  F.col("arc").alias("arc"), F.col("offset").alias("offset"))
    same = F.concat_ws(":", "digest", "payload_bytes")
    index = index.where("kind is not null")
    first = cut_lineage(index.where((F.col("payload_bytes") >= min_bytes) & (F.col("kind") == "response"))
                        .groupBy(same.alias("same"))
                        .agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    both = join_hot(index.withColumn("same", same), first, "same", how="left")
    own = (F.col("first.arc") == F.col("arc")) & (F.col("first.offset") == F.col("offset"))
    original = F.when(F.col("first").isNotNull() & (F.col("kind") == "response") & ~own,
                      F.struct("first.arc", "first.offset", "first.page_id"))
    return both.select("arc", "offset", original.alias("original"))


def convert_arc(decided: DataFrame, arc_folder: str, warc_folder: str) -> DataFrame:
    """Convert the ARC files of ``decided`` (see ``find_originals``) record by record; returns the names of the
    WARC files and their number of records, written to shared storage.  A task holds the decisions on one file."""
    n = max(1, min(decided.select("arc").distinct().count(), FILE_TASKS))

    def convert(key: tuple[str], rows: pd.DataFrame) -> pd.DataFrame:
        arc = key[0]
        fs, folder = storage(arc_folder)
        w = _Writer(warc_folder, ".warc.gz")
        w.open()
        refs = dict(zip(rows["offset"], rows["original"]))
        with open_archive(fs, f"{folder}/{arc}") as stream:
            for offset, fields, content in walk_sound(stream):
                if fields is None:
                    break
                ref = refs.get(offset)
                w.add(convert_record(arc, offset, fields, content, None if ref is None else (
                    ref["arc"], int(ref["offset"]), None if ref["page_id"] is None else int(ref["page_id"]))))
        w.close()
        return pd.DataFrame([(w.name, w.records)], columns=["warc", "records"])

    return cut_lineage(decided.repartition(n, "arc").groupBy("arc").applyInPandas(convert, "warc string, records long"))


RECORDS = ("record_id string, record_type string, target_uri string, date string, page_id long, payload_bytes long, "
           "payload_digest string, refers_to_record string, refers_to long")


def walk_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, in order."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        head = []
        while (line := stream.readline()).strip():
            head.append(line)
        fields = header_fields(head)
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError(f"record {fields.get('warc-record-id')} is shorter than its declared length")
        yield fields, block


def read_warc(files: DataFrame, warc_folder: str) -> DataFrame:
    """One row per response, revisit and resource record of the files named in ``files`` (warc); payload sizes and
    digests are computed from the bytes read, and must agree with the record's header.  A damaged file is an error."""
    n = max(1, min(files.count(), FILE_TASKS))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = storage(warc_folder)
        for frame in frames:
            for name in frame["warc"]:
                with open_archive(fs, f"{folder}/{name}") as stream:
                    found = (_row(*r) for r in walk_warc(stream) if r[0]["warc-type"] != "warcinfo")
                    while part := list(itertools.islice(found, ROWS_AT_ONCE)):
                        yield pd.DataFrame(part, columns=[c.split()[0] for c in RECORDS.split(", ")]).astype(
                            {"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    return files.select("warc").repartition(n).mapInPandas(read, RECORDS)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    http, payload = http_parts(block)
    stated, digest, size = fields.get("warc-payload-digest", ""), payload_digest(payload), len(payload)
    if fields["warc-type"] == "revisit":
        digest, size = stated.removeprefix("sha1:"), long_or_none(fields.get("x-payload-bytes", http.get("content-length")))
    elif stated.startswith("sha1:") and stated != f"sha1:{digest}":
        raise ValueError(f"record {fields['warc-record-id']} is damaged")
    return (fields["warc-record-id"], fields["warc-type"], fields["warc-target-uri"], fields["warc-date"],
            long_or_none(http.get("x-page-id")), size, digest, fields.get("warc-refers-to"),
            long_or_none(fields.get("x-refers-to-page-id")))


def convert_folder(spark: SparkSession, arc_folder: str, warc_folder: str, min_bytes: int = 0,
                   files: DataFrame | None = None) -> DataFrame:
    """Convert ARC files of any origin, those of a folder or those named in ``files`` (arc); returns the
    records as read back from the WARC files."""
    scanned = scan_arc(archive_files(spark, arc_folder) if files is None else files, arc_folder)
    return read_warc(convert_arc(find_originals(scanned, min_bytes), arc_folder, warc_folder), warc_folder)


def archive(pages: DataFrame, version: int | Sequence[int] = (1, 2), min_bytes: int = 0) -> DataFrame:
    """Pages -> ARC files -> WARC files -> records read back.  Of what the writing of the ARC files returns,
    only the files' names go on: the conversion reads everything else from the files."""
    spark = pages.sparkSession
    arc_folder, warc_folder = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    files = cut_lineage(write_arc(pages, arc_folder, version).select("arc").distinct())
    return convert_folder(spark, arc_folder, warc_folder, min_bytes, files)
