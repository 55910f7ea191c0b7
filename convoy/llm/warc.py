"""Web archives inside ZIP files: writing them, and reading records by range without unpacking.

An archive is a ZIP with stored members: WARC records under ``archive/``, each gzipped by itself, and under ``indexes/`` lists of
where each one lies. The reader takes the central directory from the end of the file, ZIP64 included, finds the members, reads
the indexes (CDX, CDXJ, or plain offsets and lengths) and then only the byte ranges that they name. What no index covers is
scanned for records, range by range. Every step is a Spark stage: archives, unlisted ranges, records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, few
from convoy.session import work_dir

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes of payload from which an archive is closed, of one read of neighbouring records, and of a range to scan.
ARCHIVE, READ, RANGE = 32 << 20, 4 << 20, 16 << 20
#: Index lines that are read in one task, about, and ranges that are scanned in one.
LINES, RANGES = 4096, 8
#: How a gzipped record begins.
GZIP = b"\x1f\x8b\x08"
LEVEL = 3
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------- writing


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    least_revisit: int = 0,
    archive_bytes: int = ARCHIVE,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a WARC record for every row of ``pages`` and return the archives, as (archive, records long).

    The payload is the text in UTF-8, empty for null. Of records with equal payloads of at least ``least_revisit`` bytes
    the one with the largest id is a response and the others revisit it; rows that share its id are responses too, and so
    are rows without an id. A null address leaves the header out. ``folder`` lies in the shared checkpoint folder unless
    given. Every attempt of a task writes files of its own, and only those of attempts that succeeded are returned. An
    empty table has no archives.
    """
    folder = folder or work_dir(pages.sparkSession, "archives")
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"), F.sha2(payload, 256).alias("same")
    )
    big = rows.where((F.octet_length("payload") >= least_revisit) & F.col("id").isNotNull())
    first = big.groupBy("same").agg(F.max("id").alias("first"), F.min("id").alias("other")).where("first <> other")
    joined = rows.join(first.select("same", "first"), "same", "left")
    revisits = (F.octet_length("payload") >= least_revisit) & (F.col("first") > F.col("id"))
    ready = joined.select("id", "uri", "payload", F.when(revisits, F.col("first")).alias("refers_to"))
    made = ready.mapInArrow(partial(_write, folder, archive_bytes, date), "archive string, records long")
    # this short list takes a file for a core at most, not one for every task that writes archives; rows are dealt by that
    # task's number, which all its attempts share, so that each part has those of one attempt
    dealt = made.withColumn("task", F.spark_partition_id()).repartition("task").drop("task")
    return cut(dealt.coalesce(_cores(pages)))


def _cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def _header(**fields: str) -> bytes:
    return "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items() if v is not None).encode()


def record(page, uri, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record. A revisit carries the HTTP header of the full payload, but not the payload."""
    uri = None if uri is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
    http = b"HTTP/1.1 200 OK\r\n" + _header(Content_Type="text/html; charset=utf-8", Content_Length=str(len(payload))) + b"\r\n"
    block = http if refers_to is not None else http + payload
    head = b"WARC/1.1\r\n" + _header(
        WARC_Type="response" if refers_to is None else "revisit",
        WARC_Record_ID=f"<urn:page:{'' if page is None else page}>",
        WARC_Date=date,
        WARC_Target_URI=uri,
        WARC_Payload_Digest=f"sha1:{digest(payload)}",
        WARC_Profile=None if refers_to is None else REVISIT,
        WARC_Refers_To=None if refers_to is None else f"<urn:page:{refers_to}>",
        Content_Type="application/http;msgtype=response",
        Content_Length=str(len(block)),
    )
    return head + b"\r\n" + block + b"\r\n\r\n"


class _Stream:
    """An output that zipfile can only append to."""

    def __init__(self, out):
        self.write, self.tell, self.flush = out.write, out.tell, out.flush


def _write(folder, archive_bytes, date, batches):
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    columns = ("id", "uri", "payload", "refers_to")
    rows = (row for b in batches for part in few(b) for row in zip(*(part.column(c).to_pylist() for c in columns)))
    made = []
    for row in rows:
        name, count = f"{uuid.uuid4().hex}.wacz", 0
        index: list[str] = []
        with store.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(_Stream(out), "w") as archive:
            with archive.open(RECORDS, "w", force_zip64=True) as member:
                at = size = 0
                while row is not None:
                    payload = row[2].encode()
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    data = packer.compress(record(row[0], row[1], payload, row[3], date)) + packer.flush()
                    member.write(data)
                    index.append(f"{at} {len(data)}\n")
                    at, size, count = at + len(data), size + len(payload), count + 1
                    row = next(rows, None) if size < archive_bytes else None
            archive.writestr(INDEX, "".join(index))
        made.append((f"{folder}/{name}", count))
    arrays = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())]
    yield pa.RecordBatch.from_arrays(arrays, ["archive", "records"])


# ---------------------------------------------------------------- reading


def members(read, size: int) -> dict[str, tuple[int, int, int, int]]:
    """The members of a ZIP of ``size`` bytes, as name -> (offset of local header, stored size, full size, method).

    ``read(offset, length)`` reads a range. Only the end of the file and the central directory are read.
    """
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)  # these bytes may also occur in the comment
    if end < 0:
        raise ValueError("not a ZIP file")
    count, length, at = struct.unpack("<HII", tail[end + 10 : end + 20])
    if 0xFFFF == count or 0xFFFFFFFF in (length, at):
        locator = read(tail_at + end - 20, 20)
        if locator[:4] == b"PK\x06\x07":
            record64 = read(struct.unpack("<Q", locator[8:16])[0], 56)
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("broken ZIP64 directory")
            count, length, at = struct.unpack("<QQQ", record64[32:56])
    found, data, here = {}, read(at, length), 0
    for _ in range(count):
        if data[here : here + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        flags, method = struct.unpack("<HH", data[here + 8 : here + 12])
        stored, full, names, extras, comment = struct.unpack("<IIHHH", data[here + 20 : here + 34])
        offset = int.from_bytes(data[here + 42 : here + 46], "little")
        name = data[here + 46 : here + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[here + 46 + names : here + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:  # holds, in this order, those that did not fit
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                full = next(wide) if full == 0xFFFFFFFF else full
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + n :]
        found[name] = (offset, stored, full, method)
        here += 46 + names + extras + comment
    return found


def stored_range(read, member: tuple[int, int, int, int]) -> tuple[int, int]:
    """Where the bytes of a stored member lie, as (offset, length)."""
    offset, stored, _, method = member
    if method:
        raise ValueError("the member is compressed, so that ranges of it can't be read")
    head = read(offset, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken ZIP member")
    names, extras = struct.unpack("<HH", head[26:30])
    return offset + 30 + names + extras, stored


def index_lines(archives: DataFrame) -> DataFrame:
    """Where each record lies, as (archive, offset long, length long).

    Only directories and indexes are read, and of archive members the stretches that no index line covers. They are read when this
    is called, once, and the lines lie in the shared folder.
    """
    shape = "archive string, offset long, length long, stop long"
    cores = _cores(archives)
    # numbers are given as paths and ranges are few bytes for much to read
    places = cut(archives.select("archive").repartition(cores).mapInArrow(_read_index, shape))
    known, rest = places.where("stop IS NULL").drop("stop"), places.where("stop IS NOT NULL")
    ranges = rest.count()
    if not ranges:
        return known
    spread = rest.repartition(max(min(ranges, cores), -(-ranges // RANGES)))
    return known.unionByName(cut(spread.mapInArrow(_scan, "archive string, offset long, length long")))


def _open(path: str):
    store, place = fs.FileSystem.from_uri(path)
    file = store.open_input_file(place)
    return file, lambda offset, length: file.read_at(length, offset)


def parse_index(data: bytes, names: list[str]) -> list[tuple[str, int, int]]:
    """(file, offset, length) of the lines of an index that name all three.

    CDXJ lines end in a JSON object. CDX lines follow a header that gives each column a letter. Plain lines hold an offset and a
    length, and count if there is a single file among ``names``.
    """
    text = gzip.decompress(data) if data.startswith(GZIP) else data
    found, columns = [], None
    for line in text.decode("utf-8", "replace").splitlines():
        parts = line.split()
        if parts[:1] == ["CDX"]:
            columns = {letter: i for i, letter in enumerate(parts[1:])}
        elif line.rstrip().endswith("}"):
            entry = json.loads(line[line.index("{") :])
            if {"offset", "length"} <= entry.keys():
                found.append((entry.get("filename") or names[0], int(entry["offset"]), int(entry["length"])))
        elif columns is not None and len(parts) == len(columns):
            place = [parts[columns[c]] if c in columns else "-" for c in "gVS"]
            if place[1].isdigit() and place[2].isdigit():
                found.append((place[0] if place[0] != "-" else names[0], int(place[1]), int(place[2])))
        elif len(parts) == 2 and len(names) == 1 and all(p.isdigit() for p in parts):
            found.append((names[0], int(parts[0]), int(parts[1])))
    return found


def _read_index(batches):
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            rows = _places(path)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["archive", "offset", "length", "stop"])


def _places(path: str) -> list[tuple[str, int, int, int | None]]:
    """The records of an archive that its indexes list, and ranges of what they don't, with the end of the stretch."""
    file, read = _open(path)
    with file:
        found = members(read, file.size())
        archives = {n: stored_range(read, m) for n, m in found.items() if n.startswith("archive/") and n.endswith(".warc.gz")}
        other = [n for n in found if n.startswith("archive/") and not n.endswith("/") and n not in archives]
        if other:
            raise ValueError(f"{path} holds records that are not in a .warc.gz member: {', '.join(sorted(other))}")
        names = {n.removeprefix("archive/"): n for n in archives}
        listed: dict[str, dict[int, int]] = {n: {} for n in archives}
        for name in sorted(n for n in found if n.startswith("indexes/") and not n.endswith("/")):
            for at, offset, length in parse_index(read(*stored_range(read, found[name])), list(names)) if names else ():
                member = names.get(at.removeprefix("archive/"))
                if member and 0 < length and offset + length <= archives[member][1]:
                    listed[member][offset] = length
    rows: list[tuple[str, int, int, int | None]] = []
    for member, (origin, size) in sorted(archives.items()):
        end = 0
        for offset, length in [*sorted(listed[member].items()), (size, 0)]:
            for start in range(end, offset, RANGE):
                rows.append((path, origin + start, min(RANGE, offset - start), origin + offset))
            if length:
                rows.append((path, origin + offset, length, None))
            end = max(end, offset + length)
    return rows


def _scan(batches):
    """The records that begin in each range. The last one may end beyond it."""
    for batch in batches:
        for path, offset, length, stop in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length", "stop"))):
            file, read = _open(path)
            with file:
                rows = [(path, at, size) for at, size in _records_in(read, offset, offset + length, stop)]
            types = [pa.string(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["archive", "offset", "length"])


def _records_in(read, start: int, end: int, stop: int):
    """(offset, length) of the records that begin from ``start`` on and before ``end``, and end before ``stop``."""
    at = start
    while at < end:
        # a record's first bytes may lie across the end of a read
        block = read(at, min(READ, stop - at))
        here = block.find(GZIP)
        if here < 0:
            at += max(len(block) - len(GZIP) + 1, 1)
            continue
        at += here
        if at >= end:
            return
        size = _record_length(read, at, stop)
        if size:
            yield at, size
        at += size or 1


def _record_length(read, at: int, stop: int) -> int:
    """The bytes of the gzipped WARC record at a place, 0 if there is none."""
    unpack, done, head = zlib.decompressobj(31), 0, b""
    try:
        while not unpack.eof:
            data = read(at + done, min(1 << 16 if not done else 1 << 20, stop - at - done))
            if not data:
                return 0
            done += len(data)
            while data and not unpack.eof:
                part = unpack.decompress(data, 1 << 20)
                head = head or part[:5]
                if head and not b"WARC/".startswith(head[:5]):
                    return 0
                data = unpack.unconsumed_tail
        return done - len(unpack.unused_data)
    except zlib.error:
        return 0


RECORD = (
    "archive string, offset long, record_id string, record_type string, uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def read_records(archives: DataFrame) -> DataFrame:
    """Every record of the archives, of whatever type, number and size.

    ``archives`` needs the column ``archive`` only. ``payload`` is the body of an HTTP message, or the whole block of a record
    that holds none; a revisit has none, and its ``payload_bytes`` is the length of the full payload where its header tells it.
    A payload that does not have the SHA-1 digest its record gives is an error, unless it was sent in chunks, and so is one
    of another length than its header says in an archive of ours.
    """
    lines = index_lines(archives)
    slabs = -(-lines.count() // LINES)
    # neighbours are read together; a number is given as these lines are few bytes for much to read
    lines = lines.repartition(max(1, slabs), "archive", F.floor(F.col("offset") / ARCHIVE))
    return lines.sortWithinPartitions("archive", "offset").mapInArrow(_read_records, RECORD)


def _read_records(batches):
    opened, file, read = None, None, None
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
        at = 0
        while at < len(rows):
            path, offset, length = rows[at]
            last, stop = at, offset + length
            while last + 1 < len(rows) and rows[last + 1][:2] == (path, stop) and stop - offset < READ:
                last += 1
                stop += rows[last][2]
            if path != opened:
                if file:
                    file.close()
                (file, read), opened = _open(path), path
            data = read(offset, stop - offset)
            parsed, held = [], 0
            for p, o, n in rows[at : last + 1]:
                parsed.append((p, o, *parse(data[o - offset : o - offset + n])))
                held += len(parsed[-1][-1] or b"")
                if held >= READ:  # what was read may be many times as much unpacked
                    yield _parsed(parsed)
                    parsed, held = [], 0
            if parsed:
                yield _parsed(parsed)
            at = last + 1
    if file:
        file.close()


def _parsed(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in RECORD.split(", ")])


def _fields(head: bytes) -> dict[str, str]:
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:] if line)
    return {k.strip().decode("utf-8", "replace").lower(): v.strip().decode("utf-8", "replace") for k, _, v in lines}


def parse(data: bytes):
    """(record id, type, address, refers to, digest, payload length, payload) of one gzipped record."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind, block = fields["warc-type"], rest[: int(fields["content-length"])]
    http, payload = {}, block
    if fields.get("content-type", "").startswith("application/http"):
        first, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(first)
    size, mark = http.get("content-length", ""), fields.get("warc-payload-digest")
    size = int(size) if size.isdigit() else None
    whole = kind != "revisit"
    if whole:
        ours = fields.get("warc-record-id", "").startswith("<urn:page:")
        sha1 = mark.removeprefix("sha1:") if mark and mark.startswith("sha1:") else None
        wrong = sha1 is not None and "transfer-encoding" not in http and sha1.upper() != digest(payload)
        if wrong or ours and len(payload) != size:
            raise ValueError(f"the payload of {fields.get('warc-record-id')} is damaged")
        size = len(payload)
    return (
        fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-refers-to"),
        mark and mark.removeprefix("sha1:"), size, payload if whole else None,
    )
