"""Archives written and read back, and the ZIP directories on archives of another writer."""

from __future__ import annotations

import base64
import hashlib
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from convoy.llm import warc

PAGES = "page_id long, url string, html string"


def pages():
    body = "<html>\r\n\r\n<p>é 日本</p></html>"
    return [
        (1, "http://a.example/1", body),
        (2, "http://a.example/2", body),
        (3, None, None),
        (4, "http://b.example/ x\r\nInjected: yes", ""),
        (5, "http://b.example/é", "x" * 200_000),
        (6, "http://a.example/6", body + " "),
        (None, "http://a.example/n", body),
        (2, "http://a.example/again", body),
        (7, "http://a.example/7", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1"),
    ]


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None and len(data) >= least]
        later = max(same) if same and i is not None and len(data) >= least and max(same) > i else None
        mark = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), mark, "response" if later is None else "revisit", later, data if later is None else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,archive_bytes", [(0, 1 << 20), (10, 50), (10**6, 1)])
def test_round_trip(spark, least, archive_bytes):
    table = spark.createDataFrame(pages(), PAGES).withColumns({"first": F.lit(1), "same": F.lit(2)}).repartition(3)
    archives = warc.write_archives(table, least_revisit=least, archive_bytes=archive_bytes)
    assert archives.agg(F.sum("records")).first()[0] == len(pages())
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
    records = warc.read_records(archives).collect()
    got = [
        (number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to), None if r.payload is None else bytes(r.payload))
        for r in records
    ]
    assert sorted(got, key=repr) == expected(pages(), least)
    uris = {r.uri for r in records}
    assert "http://b.example/%20x%0D%0AInjected:%20yes" in uris and None in uris


def test_empty_table(spark):
    archives = warc.write_archives(spark.createDataFrame([], PAGES))
    assert archives.count() == 0
    assert warc.read_records(archives).count() == 0


def test_short_lists_are_few_files(spark):
    """Lists of archives and of what lies in them take a part for a core at most, however many tasks write archives."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = [(i, f"http://a.example/{i}", f"<p>{i}</p>") for i in range(300)]
        archives = warc.write_archives(spark.createDataFrame(rows, PAGES))
        lines = warc.index_lines(archives)
        cores = spark.sparkContext.defaultParallelism
        assert archives.count() > 2 * cores and archives.agg(F.sum("records")).first()[0] == lines.count() == 300
        assert archives.rdd.getNumPartitions() <= cores and lines.rdd.getNumPartitions() <= cores
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_batch_is_bounded_by_what_it_unpacks_to(tmp_path):
    """Pages that pack well lie in one read, but are not handed on in one batch."""
    import pyarrow as pa

    html = [f"{i} " + "x" * 1_000_000 for i in range(40)]
    columns = [pa.array(range(40), pa.int64()), pa.array(["u"] * 40), pa.array(html), pa.array([None] * 40, pa.int64())]
    page = pa.RecordBatch.from_arrays(columns, ["id", "uri", "payload", "refers_to"])
    (wrote,) = warc._write(f"file://{tmp_path}", 1 << 30, "1970-01-01T00:00:00Z", [page])
    places = warc._places(wrote.column("archive")[0].as_py())
    assert sum(p[2] for p in places) < warc.READ
    lines = pa.RecordBatch.from_arrays([pa.array(c) for c in list(zip(*places))[:3]], ["archive", "offset", "length"])
    got = list(warc._read_records([lines]))
    assert max(b.nbytes for b in got) < warc.READ + 2_000_000
    assert [p.as_py().decode() for b in got for p in b.column("payload")] == html


def made(names, monkeypatch=None, comment=b"", limit=None):
    if limit is not None:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, data in names.items():
            archive.writestr(name, data)
        archive.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("limit", [None, 10])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 is no end here"])
def test_directories(monkeypatch, limit, comment):
    names = {f"m/{i}é.bin": random.Random(i).randbytes(100 + i) for i in range(5)}
    data = made(names, monkeypatch, comment, limit)
    assert (b"PK\x06\x06" in data) == (limit is not None)
    read = lambda offset, length: data[offset : offset + length]
    found = warc.members(read, len(data))
    assert set(found) == set(names)
    for name, content in names.items():
        assert read(*warc.stored_range(read, found[name])) == content


def test_what_is_no_archive():
    read = lambda data: lambda o, n: data[o : o + n]
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(read(b"nothing"), 7)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a", "text " * 50)
    data = out.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        warc.stored_range(read(data), warc.members(read(data), len(data))["a"])


def test_a_damaged_payload_is_an_error():
    import zlib

    good = warc.record(1, "u", b"payload", None, "1970-01-01T00:00:00Z")
    press = zlib.compressobj(wbits=31)
    bad = press.compress(good.replace(b"payload\r\n", b"payloat\r\n")) + press.flush()
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(bad)


def test_only_ranges_are_read(spark, tmp_path):
    """Whatever lies in an archive besides the members that are asked for stays unread."""
    payloads = [b"one", b"two" * 100]
    import zlib

    def packed(n, p):
        press = zlib.compressobj(wbits=31)
        return press.compress(warc.record(n, "u", p, None, "1970-01-01T00:00:00Z")) + press.flush()

    records = [packed(n, p) for n, p in enumerate(payloads)]
    index = f"0 {len(records[0])}\n{len(records[0])} {len(records[1])}\n"
    path = tmp_path / "other.wacz"
    path.write_bytes(made({"pages/pages.jsonl": "{}", warc.RECORDS: b"".join(records), "x.bin": b"\0" * 5000, warc.INDEX: index}))
    archives = spark.createDataFrame([(str(path), 2)], "archive string, records long")
    got = warc.read_records(archives).orderBy("offset").collect()
    assert [bytes(r.payload) for r in got] == payloads


def packed(*lines, block=b"", kind="response", **fields):
    """A gzipped record as other writers make them."""
    import zlib

    names = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{len(block)}-{kind}>", **{k.replace("_", "-"): v for k, v in fields.items()}}
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in names.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    press = zlib.compressobj(wbits=31)
    return press.compress(head.encode() + block + b"\r\n\r\n") + press.flush()


def foreign():
    """Records of every type."""
    page = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    plain = b"HTTP/1.1 200 OK\r\n\r\n" + random.Random(1).randbytes(3000)
    kind = {"Content_Type": "application/http; msgtype=response"}
    return [
        packed(kind="warcinfo", block=b"software: other\r\n", Content_Type="application/warc-fields"),
        packed(kind="request", block=b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", Content_Type="application/http; msgtype=request"),
        packed(block=page, WARC_Payload_Digest="sha1:AAAA", **kind),
        packed(block=plain, WARC_Payload_Digest="sha1:" + warc.digest(plain.partition(b"\r\n\r\n")[2]), **kind),
        packed(kind="metadata", block=b"", Content_Type="text/plain"),
        packed(kind="resource", block=b"\x1f\x8b\x08 no record" * 40, Content_Type="image/png"),
        packed(kind="revisit", block=b"HTTP/1.1 200 OK\r\n\r\n", WARC_Payload_Digest="sha256:ff", **kind),
    ]


def ends(records):
    return [sum(map(len, records[: i + 1])) for i in range(len(records))]


def indexed(form, name, records, wanted):
    starts = [0, *ends(records)]
    rows = [(starts[i], len(records[i])) for i in wanted]
    if form == "cdxj":
        return "".join(f'a,b)/ 2020 {{"url": "http://b/", "filename": "{name}", "offset": "{o}", "length": "{n}"}}\n' for o, n in rows)
    if form == "cdx":
        return " CDX N b a m s k r M S V g\n" + "".join(f"a,b)/ 2020 http://b/ text/html 200 AAA - - {n} {o} {name}\n" for o, n in rows)
    return "".join(f"{o} {n}\n" for o, n in rows)


KINDS = ["warcinfo", "request", "response", "response", "metadata", "resource", "revisit"]


@pytest.mark.parametrize("form", ["cdxj", "cdx", "plain", "none", "part", "packed"])
@pytest.mark.parametrize("length", [50, 1 << 20])
def test_any_index_and_any_record(spark, tmp_path, monkeypatch, form, length):
    """All records come back, whether an index lists them, some of them or none, and wherever ranges are cut."""
    monkeypatch.setattr(warc, "RANGE", length)
    records, names = foreign(), {"datapackage.json": "{}"}
    names["archive/x.warc.gz"] = b"".join(records)
    if form in ("cdxj", "cdx", "plain"):
        names["indexes/a.cdxj"] = indexed(form, "x.warc.gz", records, range(7))
    elif form != "none":
        text = indexed("cdxj", "x.warc.gz", records, [2, 3, 6])
        names["indexes/a.cdx.gz"] = __import__("gzip").compress(text.encode()) if form == "packed" else text
    path = tmp_path / "other.wacz"
    path.write_bytes(made(names))
    got = warc.read_records(spark.createDataFrame([(str(path),)], "archive string")).orderBy("offset").collect()
    assert [r.record_type for r in got] == KINDS
    assert [r.payload is None for r in got] == [k == "revisit" for k in KINDS]
    assert bytes(got[0].payload) == b"software: other\r\n" and bytes(got[4].payload) == b"" and got[6].payload_bytes is None
    assert got[3].payload_bytes == 3000


def test_stretches_without_an_index_are_scanned_by_several_tasks(spark, tmp_path):
    paths = [(str(tmp_path / f"{i}.wacz"),) for i in range(16)]
    for (path,) in paths:
        with open(path, "wb") as out:
            out.write(made({"archive/x.warc.gz": b"".join(foreign())}))
    lines = warc.index_lines(spark.createDataFrame(paths, "archive string"))
    counts = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 16 * len(KINDS) and max(counts) <= 8 * len(KINDS)


def test_several_members_with_one_index(spark, tmp_path):
    one, two = foreign()[:4], foreign()[4:]
    names = {"archive/x.warc.gz": b"".join(one), "archive/y.warc.gz": b"".join(two), "archive/empty.warc.gz": b""}
    names["indexes/index.cdxj"] = indexed("cdxj", "x.warc.gz", one, range(4)) + indexed("cdxj", "y.warc.gz", two, [1])
    path = tmp_path / "other.wacz"
    path.write_bytes(made(names))
    got = warc.read_records(spark.createDataFrame([(str(path),)], "archive string")).orderBy("offset").collect()
    assert [r.record_type for r in got] == KINDS
    path.write_bytes(made({**names, "archive/z.warc": b"WARC/1.0"}))
    with pytest.raises(Exception, match="not in a .warc.gz member: archive/z.warc"):
        warc.read_records(spark.createDataFrame([(str(path),)], "archive string")).collect()
