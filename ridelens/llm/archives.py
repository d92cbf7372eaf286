"""Web records in ZIP-packaged WARC files: written by tasks, read by ranges.

An archive is a ZIP file whose members are stored, not packed: WARC files with
one gzip member per record, and an index with each record's place. A reader
parses the ZIP's end record (ZIP64 ones too) and central directory, reads the
index member, and then fetches single records by their byte range; nothing is
extracted, and an archive's size does not matter.

Tasks write to the shared folder under names of their own attempt and return
what they wrote; only the archives of attempts that Spark committed are read, so
a lost executor or a second attempt leaves no half archive in the result.

Equal payloads are stored once: one record is the response, others refer to it.

Archives that others wrote are read the same way (``read_web_records``): any
number of WARC members, packed record by record or plain; any record types and
ids; CDXJ indexes, plain or in gzip blocks, read in ranges. A WARC member that no
index covers is walked once, record by record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, islice
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ridelens.llm.runtime import documents, new_folder, settle, ship, table

#: Payloads from this size on are stored once.
MIN_SHARED_BYTES = 1000
#: An archive is closed once its records have this many stored bytes.
ARCHIVE_BYTES = 32 << 20
#: A reading task gets the records of this many bytes of an archive.
READ_BYTES = 8 << 20
INDEX_NAME = "indexes/records.tsv"
DATE = "2020-01-01T00:00:00Z"

# Signatures and layouts of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
_END = struct.Struct("<4s4H2LH")
_END64 = struct.Struct("<4sQ2H2L4Q")
_LOCATOR64 = struct.Struct("<4sLQL")
_ENTRY = struct.Struct("<4s6H3L5H2L")
_LOCAL = struct.Struct("<4s5H3L2H")


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int

    @property
    def stored(self) -> bool:
        return self.method == 0


def _read_at(f: BinaryIO, at: int, n: int) -> bytes:
    f.seek(at)
    out = f.read(n)
    if len(out) != n:
        raise ValueError(f"archive ends before byte {at + n}")
    return out


def zip_members(f: BinaryIO, size: int) -> list[Member]:
    """The central directory of a ZIP file of ``size`` bytes."""
    tail_at = max(0, size - _END.size - 0xFFFF)
    tail = _read_at(f, tail_at, size - tail_at)
    end = tail.rfind(END)
    while end >= 0 and end + _END.size + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(END, 0, end)  # the signature may occur in the comment
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    _, _, _, _, n, length, start, _ = _END.unpack_from(tail, end)
    end_at = tail_at + end
    if end_at >= _LOCATOR64.size:
        mark, _, at64, _ = _LOCATOR64.unpack(_read_at(f, end_at - _LOCATOR64.size, _LOCATOR64.size))
        if mark == LOCATOR64:
            mark, _, _, _, _, _, _, n, length, start = _END64.unpack(_read_at(f, at64, _END64.size))
            if mark != END64:
                raise ValueError("the ZIP64 locator points to no end record")
    directory, at, out = _read_at(f, start, length), 0, []
    for _ in range(n):
        mark, _, _, flags, method, _, _, _, packed, plain, n_name, n_extra, n_comment, _, _, _, header = _ENTRY.unpack_from(directory, at)
        if mark != ENTRY:
            raise ValueError("broken central directory")
        name = directory[at + _ENTRY.size : at + _ENTRY.size + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + _ENTRY.size + n_name : at + _ENTRY.size + n_name + n_extra]
        packed, header = _wide(extra, plain, packed, header)
        out.append(Member(name, method, packed, header))
        at += _ENTRY.size + n_name + n_extra + n_comment
    return out


def _wide(extra: bytes, plain: int, packed: int, header: int) -> tuple[int, int]:
    """Packed size and header offset, from the ZIP64 field where they don't fit."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            field, place = extra[at + 4 : at + 4 + size], 0
            if plain == 0xFFFFFFFF:
                place += 8
            if packed == 0xFFFFFFFF:
                packed, place = int.from_bytes(field[place : place + 8], "little"), place + 8
            if header == 0xFFFFFFFF:
                header = int.from_bytes(field[place : place + 8], "little")
        at += 4 + size
    return packed, header


def data_start(f: BinaryIO, member: Member) -> int:
    """Where a member's bytes begin (its local header has lengths of its own)."""
    head = _LOCAL.unpack(_read_at(f, member.header, _LOCAL.size))
    if head[0] != LOCAL:
        raise ValueError(f"{member.name}: no local header")
    return member.header + _LOCAL.size + head[-2] + head[-1]


@dataclass
class Record:
    """What becomes one WARC record. A revisit has no payload of its own but
    its size and digest."""

    page_id: int | None
    url: str | None
    kind: str
    refers_to: int | None
    digest: str
    size: int
    payload: bytes


def _line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _from_urn(text: str | None) -> int | None:
    value = (text or "none").strip("<>").rpartition(":")[2]
    return None if value == "none" else int(value)


def pack_record(r: Record) -> bytes:
    """A WARC 1.1 record as a gzip member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r.size}\r\n\r\n".encode()
    block = http + (r.payload if r.kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {r.kind}",
        f"WARC-Record-ID: {_urn(r.page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(r.digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if r.url is not None:
        head.append(f"WARC-Target-URI: {_line(r.url)}")
    if r.kind == "revisit":
        head += [f"WARC-Refers-To: {_urn(r.refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


@dataclass
class WebRecord:
    """A WARC record of any kind. ``fields`` are its header fields by lower-case
    name. ``payload`` is what a response carries, without HTTP's header and
    chunk marks; for other kinds it is the block. ``payload_bytes`` is its size,
    for a revisit the size the HTTP header tells, if it does. ``digest_ok`` is
    None where no digest is given, or none that can be checked."""

    kind: str
    fields: dict[str, str]
    status: int | None
    payload: bytes
    payload_bytes: int | None
    digest: str
    digest_ok: bool | None


# The digests that records name, with their sizes.
_DIGESTS = {"sha1": 20, "sha256": 32, "sha512": 64, "md5": 16}


def _parts(data: bytes) -> tuple[list[bytes], bytes]:
    """Header lines (folded ones joined) and what follows the empty line."""
    end = re.search(rb"\r?\n\r?\n", data)
    head, rest = (data[: end.start()], data[end.end() :]) if end else (data, b"")
    return re.sub(rb"\r?\n[ \t]+", b" ", head).splitlines(), rest


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, mark, v in pairs if mark}


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isascii() and value.isdigit() else None


def unchunked(body: bytes) -> bytes | None:
    """A chunked HTTP body without its marks; None if it is not one."""
    out, at = [], 0
    while True:
        end = body.find(b"\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), end + 1
        if not n:
            return b"".join(out)
        if at + n > len(body):
            return None
        out.append(body[at : at + n])
        at += n
        at += 2 if body[at : at + 2] == b"\r\n" else body[at : at + 1] == b"\n"


def _given_digest(value: str | None) -> tuple[str, bytes] | None:
    """(algorithm, digest) of a field like ``sha1:...``, in base 32 or hex."""
    name, _, text = (value or "").partition(":")
    name = name.strip().lower().replace("-", "")
    size = _DIGESTS.get(name)
    try:
        if size and len(text) == 2 * size:
            return name, bytes.fromhex(text)
        found = base64.b32decode(text.upper() + "=" * (-len(text) % 8)) if size else b""
    except ValueError:
        return None
    return (name, found) if len(found) == size else None


def parse_record(data: bytes) -> WebRecord:
    """A record, packed or plain, from the bytes of its range."""
    raw = zlib.decompressobj(31).decompress(data) if data[:2] == b"\x1f\x8b" else data
    lines, rest = _parts(raw)
    if not lines or not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(lines[1:])
    length = _number(fields.get("content-length"))
    block = rest.removesuffix(b"\r\n\r\n") if length is None else rest[:length]
    kind, status, bodies, told = fields.get("warc-type", "").lower(), None, [block], None
    if kind in ("response", "revisit") and block.startswith(b"HTTP/"):
        http, body = _parts(block)
        said = http[0].split()
        status = _number(said[1].decode("latin-1")) if len(said) > 1 else None
        of_http = _fields(http[1:])
        told = _number(of_http.get("content-length"))
        bodies = [body]
        if "chunked" in of_http.get("transfer-encoding", "").lower() and (plain := unchunked(body)) is not None:
            bodies = [plain, body]
    payload = b"" if kind == "revisit" else bodies[0]
    size = told if kind == "revisit" else len(payload)
    given = _given_digest(fields.get("warc-payload-digest"))
    digest, ok = (given[1].hex() if given and given[0] == "sha1" else ""), None
    if kind != "revisit":
        digest = hashlib.sha1(payload).hexdigest()
        # Some writers digest a chunked body with its marks.
        ok = any(hashlib.new(given[0], b).digest() == given[1] for b in bodies) if given else None
    return WebRecord(kind, fields, status, payload, size, digest, ok)


def unpack_record(data: bytes) -> Record:
    """A record of ``pack_record`` read back. A response's payload must have its digest."""
    r = parse_record(data)
    page = r.fields.get("warc-record-id")
    if r.kind == "response" and not r.digest_ok:
        raise ValueError(f"{page}: the payload does not have its digest")
    url = r.fields.get("warc-target-uri")
    refers_to = _from_urn(r.fields.get("warc-refers-to")) if r.kind == "revisit" else None
    return Record(_from_urn(page), None if url is None else _unline(url), r.kind, refers_to, r.digest, r.payload_bytes or 0, r.payload)


def write_zip(out: BinaryIO, records: Iterator[Record], wide: bool = True) -> tuple[int, int]:
    """Streams one archive of about ARCHIVE_BYTES; (records, bytes) written.
    ``wide``: with ZIP64 fields, as an archive of any size needs them."""
    index, at = [], 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open("archive/data.warc.gz", "w", force_zip64=wide) as member:
            for r in records:
                data = pack_record(r)
                member.write(data)
                index.append(f"{at}\t{len(data)}")
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    break
        z.writestr(INDEX_NAME, "archive/data.warc.gz\n" + "\n".join(index))
    return len(index), at


def _ranges(f: BinaryIO, at: int, n: int, step: int = 1 << 20) -> Iterator[bytes]:
    for low in range(at, at + n, step):
        yield _read_at(f, low, min(step, at + n - low))


def _unpacked(parts: Iterator[bytes]) -> Iterator[bytes]:
    """The content of gzip blocks that follow each other."""
    packer = zlib.decompressobj(31)
    for part in parts:
        while part:
            yield packer.decompress(part)
            part = packer.unused_data
            if packer.eof:
                packer = zlib.decompressobj(31)


def _lines(f: BinaryIO, m: Member) -> Iterator[str]:
    """The lines of a stored text member, read range by range."""
    parts = _ranges(f, data_start(f, m), m.size)
    rest = b""
    for part in _unpacked(parts) if m.name.endswith(".gz") else parts:
        *whole, rest = (rest + part).split(b"\n")
        yield from (x.decode().rstrip("\r") for x in whole)
    if rest:
        yield rest.decode().rstrip("\r")


def _is_warc(name: str) -> bool:
    return name.endswith((".warc", ".warc.gz"))


def _walk(f: BinaryIO, m: Member) -> Iterator[tuple[int, int]]:
    """(offset in the file, length) of the records of a WARC member, one after the other."""
    start = at = data_start(f, m)
    end = at + m.size
    if not m.name.endswith(".gz"):
        while at < end:
            head = _read_at(f, at, min(1 << 16, end - at))
            blank = len(head) - len(head.lstrip(b"\r\n"))
            if blank == len(head):
                break
            mark = re.search(rb"\r?\n\r?\n", head[blank:])
            length = _number(_fields(_parts(head[blank:])[0][1:]).get("content-length"))
            if mark is None or length is None:
                raise ValueError(f"{m.name}: no record at byte {at - start}")
            whole = mark.end() + length
            yield at + blank, whole
            at += blank + whole
        return
    packer, begin = zlib.decompressobj(31), at
    for part in _ranges(f, at, m.size):
        while part:
            packer.decompress(part)
            at += len(part) - len(packer.unused_data)
            part = packer.unused_data
            if packer.eof:
                yield begin, at - begin
                packer, begin = zlib.decompressobj(31), at


def _indexed(f: BinaryIO, m: Member, warcs: dict[str, Member]) -> Iterator[tuple[str, int, int]]:
    """(WARC member, offset in it, length) of an index member: our own (the
    member's name, then a pair of numbers a line) or CDXJ."""
    lines = _lines(f, m)
    if m.name.endswith(".tsv"):
        name = next(lines, "")
        for line in filter(None, lines):
            offset, _, length = line.partition("\t")
            yield name, int(offset), int(length)
        return
    by_file = {name.rpartition("/")[2]: name for name in warcs}
    for line in lines:
        at = line.find("{")
        if line.startswith("!") or at < 0:
            continue  # the index's own header
        entry = json.loads(line[at:])
        if entry.get("filename") is None or entry.get("offset") is None or entry.get("length") is None:
            continue
        name = str(entry["filename"])
        name = name if name in warcs else by_file.get(name.rpartition("/")[2], name)
        yield name, int(entry["offset"]), int(entry["length"])


def read_index(f: BinaryIO, size: int) -> Iterator[tuple[int, int]]:
    """(offset in the file, length) of every record of an archive: by its
    indexes, and by a walk through WARC members that none of them covers."""
    members = zip_members(f, size)
    warcs = {m.name: m for m in members if _is_warc(m.name)}
    indexes = [m for m in members if m.name.startswith("indexes/") and m.name.endswith((".tsv", ".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz"))]
    for m in [*warcs.values(), *indexes]:
        if not m.stored:
            raise ValueError(f"{m.name} is packed: only stored members can be read by range")
    starts = {name: data_start(f, m) for name, m in warcs.items()}
    covered: set[str] = set()
    for m in indexes:
        for name, offset, length in _indexed(f, m, warcs):
            if name not in starts:
                raise ValueError(f"{m.name} names {name}, which the archive does not have")
            covered.add(name)
            yield starts[name] + offset, length
    for name in warcs.keys() - covered:
        yield from _walk(f, warcs[name])


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def mark_copies(df: DataFrame, least: int = MIN_SHARED_BYTES) -> DataFrame:
    """Rows (page_id, url, html, digest, size, record_type, refers_to): of rows
    with equal payloads of at least ``least`` bytes the one with the largest
    page_id is the response."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = documents(df, "page_id", "url", "html").select("page_id", "url", payload.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("bigint"))
    large = rows.where((F.col("size") >= least) & F.col("page_id").isNotNull())
    owner = large.groupBy("digest", "size").agg(F.max("page_id").alias("owner"), F.min("page_id").alias("first")).where("first < owner").drop("first")
    marked = rows.join(owner, ["digest", "size"], "left")
    refers = F.when(F.col("page_id") < F.col("owner"), F.col("owner"))
    marked = marked.withColumn("refers_to", refers)
    return marked.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")).drop("owner")


def write_archives(df: DataFrame, folder: str) -> DataFrame:
    """Writes (page_id, url, html) as archives under ``folder``, a URI that all
    executors reach. Returns uri, n_records, n_bytes per archive."""
    ship(df.sparkSession)
    marked = mark_copies(df).select("page_id", "url", F.when(F.col("record_type") == "response", F.col("html")).otherwise("").alias("html"), "digest", "size", "record_type", "refers_to")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for r in batch.slice(lo, 256).to_pylist():
                    yield Record(r["page_id"], r["url"], r["record_type"], r["refers_to"], r["digest"], r["size"], r["html"].encode())

    def run(batches: Iterator[pa.RecordBatch]):
        store, path = _open(folder)
        store.create_dir(path, recursive=True)
        pending = rows(batches)
        while (first := next(pending, None)) is not None:
            name = f"part-{uuid.uuid4().hex}.zip"
            with store.open_output_stream(f"{path}/{name}") as out:
                n, _ = write_zip(out, chain([first], pending))
            size = store.get_file_info(f"{path}/{name}").size
            yield pa.RecordBatch.from_pydict({"uri": [f"{folder}/{name}"], "n_records": [n], "n_bytes": [size]})

    return settle(marked.mapInArrow(run, "uri string, n_records bigint, n_bytes bigint"), "archives")


def _record_places(archives: DataFrame) -> DataFrame:
    """(uri, offset, length) of all records, dealt over tasks by what they will
    read, an archive's neighbours together and in order."""

    def places(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for r in batch.to_pylist():
                store, path = _open(r["uri"])
                with store.open_input_file(path) as f:
                    found = read_index(f, r["n_bytes"])
                    while some := list(islice(found, 1 << 16)):
                        yield pa.RecordBatch.from_pydict({"uri": [r["uri"]] * len(some), "offset": [x[0] for x in some], "length": [x[1] for x in some]})

    # Rows here are places, a few bytes for records of many: tasks are counted by
    # what they will read, not left to be merged by the size of the rows.
    tasks = max(1, -(-(archives.agg(F.sum("n_bytes")).first()[0] or 0) // READ_BYTES))
    found = archives.select("uri", "n_bytes").repartition(tasks, "uri").mapInArrow(places, "uri string, offset bigint, length bigint")
    return found.withColumn("block", F.floor(F.col("offset") / READ_BYTES)).repartition(tasks, "uri", "block").sortWithinPartitions("uri", "offset")


def _read_records(archives: DataFrame, read: Callable[[str, int, bytes], tuple], schema: StructType) -> DataFrame:
    """A row of ``read(uri, offset, bytes)`` per record, in batches of 256."""
    ship(archives.sparkSession)
    types = to_arrow_schema(schema)

    def records(batches: Iterator[pa.RecordBatch]):
        opened: tuple[str, BinaryIO] | None = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out: list[tuple] = []
                for uri, offset, length in zip(*(batch.slice(lo, 256).column(c).to_pylist() for c in ("uri", "offset", "length")), strict=True):
                    if opened is None or opened[0] != uri:
                        if opened:
                            opened[1].close()
                        store, path = _open(uri)
                        opened = uri, store.open_input_file(path)
                    out.append(read(uri, offset, _read_at(opened[1], offset, length)))
                columns = [pa.array(list(v), t.type) for v, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=types.names)
        if opened:
            opened[1].close()

    return _record_places(archives).mapInArrow(records, schema)


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Reads every record of our own archives (uri, n_bytes) by its byte range:
    page_id, url, payload_bytes, payload_digest, record_type, refers_to, and
    payload (null for revisits) if asked for."""

    def read(uri: str, offset: int, data: bytes) -> tuple:
        r = unpack_record(data)
        return r.page_id, r.url, r.size, r.digest, r.kind, r.refers_to, r.payload if with_payload and r.kind == "response" else None

    kinds = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    out = _read_records(archives, read, StructType.fromDDL(kinds))
    return out if with_payload else out.drop("payload")


def read_web_records(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Reads every record of any archives (uri, n_bytes) by its byte range: uri,
    offset, record_type, record_id, target_uri, date, content_type, status,
    payload_bytes, payload_digest (bare hex SHA-1), digest_ok, refers_to (a
    revisit's record, else its page), and payload (null for revisits) if asked for.

    Defined cases: fields that a record lacks are null; a revisit has the digest
    it names, if that is a SHA-1, and the size its HTTP header tells; a broken
    digest is told, not an error; bytes that are no WARC record are one; a very
    long record is held whole by its task; no archives give no rows."""

    def read(uri: str, offset: int, data: bytes) -> tuple:
        r = parse_record(data)
        of = r.fields.get
        told = [of(k) for k in ("warc-record-id", "warc-target-uri", "warc-date", "content-type")]
        refers = (of("warc-refers-to") or of("warc-refers-to-target-uri")) if r.kind == "revisit" else None
        payload = r.payload if with_payload and r.kind != "revisit" else None
        return uri, offset, r.kind, *told, r.status, r.payload_bytes, r.digest or None, r.digest_ok, refers, payload

    kinds = (
        "uri string, offset bigint, record_type string, record_id string, target_uri string, date string, content_type string, status int, "
        "payload_bytes bigint, payload_digest string, digest_ok boolean, refers_to string, payload binary"
    )
    out = _read_records(archives, read, StructType.fromDDL(kinds))
    return out if with_payload else out.drop("payload")


def archive_round_trip(df: DataFrame, folder: str | None = None, with_payload: bool = False) -> DataFrame:
    """Writes pages (page_id, url, html) to archives and reads them back.

    Defined cases: a null html has an empty payload, a null url no target; rows
    that repeat a page_id are records of their own, and equal ones with the
    largest page_id are all responses; a row with null page_id is a response and
    is never referred to; a very long html is one record, held whole by its task;
    an empty table gives an empty result; other columns are ignored."""
    folder = folder or new_folder(df.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(write_archives(df, folder), with_payload)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back; cases as in ``archive_round_trip``."""
    out = archive_round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), o AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS owner FROM d WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN d.page_id < o.owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id < o.owner THEN o.owner END AS refers_to
FROM d LEFT JOIN o ON o.payload_digest = d.payload_digest AND o.payload_bytes = d.payload_bytes
"""
