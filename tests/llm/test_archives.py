"""Archives in ZIP files: round trips, the directory's forms, and files that are broken."""

import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile

import pytest

from murmur.llm import archives
from murmur.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, Payload string, sha1 int"
HTML = ["<html>é漢\U0001F600</html>", "", None, "WARC/1.1\r\n\r\nnot a record\r\n\r\n", "a\x00b\r\n\r\n", "<p>copy</p>", "x" * 300_000]


def pages() -> list[tuple]:
    rows = [(i, f"http://host/{i}", HTML[i % len(HTML)]) for i in range(40)]
    rows += [(i, "http://h\r\nWARC-Type: x/é", f"<p>{i}</p>") for i in range(40, 60)] + [(i, None, "<p>hot</p>") for i in range(60, 160)]
    rows += [(159, None, "<p>hot</p>"), (45, "again", "<p>45</p>"), (None, "no id", "<p>45</p>"), (None, "a", "<p>alone</p>"),
             (None, "b", "<p>alone</p>"), (-7, "", "<p>below zero</p>")]
    return rows


def expected(rows):
    newest = {}
    for i, _, h in rows:
        newest.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        data, same = (h or "").encode(), newest[h or ""]
        ids = [x for x in same if x is not None]
        first = len(same) == 1 or not ids or i == max(ids)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit",
                    None if first else max(ids)))
    return sorted(out, key=repr)


def told(spark, folder, rows):
    spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA).repartition(5).write.parquet(f"{folder}/pages.parquet")
    found = QUERIES["op12_zip_warc"](spark, str(folder)).collect()
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=repr)


def test_same_as_plain_python(spark, tmp_path):
    assert told(spark, tmp_path, pages()) == expected(pages())


def test_empty_table(spark, tmp_path):
    assert told(spark, tmp_path, []) == []


def test_round_trip_of_payloads_and_urls(spark, tmp_path):
    rows = spark.createDataFrame(pages(), "page_id long, url string, html string")
    manifest = archives.write_archives(rows, str(tmp_path / "out"), package=20_000)  # a folder without scheme, many packages
    assert manifest.count() > 4 and manifest.agg({"n_records": "sum"}).first()[0] == len(pages())
    found = archives.read_archives(manifest, span=1 << 12).collect()
    assert len(found) == len(pages())
    for r in found:
        if r.type == "response" and r.page_id is not None and 0 <= r.page_id < 40:
            assert bytes(r.payload).decode() == (HTML[r.page_id % len(HTML)] or "")
    assert {r.uri for r in found if r.page_id == 41} == {"http://h%0D%0AWARC-Type:%20x/é"}
    assert {r.uri for r in found if r.page_id == 100} == {None} and {r.uri for r in found if r.page_id == -7} == {""}
    assert all(zipfile.ZipFile(r.package.removeprefix("file:")).testzip() is None for r in manifest.collect())


def made(n=5, packed=True, index=True, method=zipfile.ZIP_STORED, prefix=b"", comment=b"", index_method=zipfile.ZIP_STORED):
    """A package as another tool writes it."""
    out, body, lines = io.BytesIO(), b"", []
    for i in range(n):
        data = archives.record(i, f"u{i}", "p" * i, i, hashlib.sha1(b"p" * i).hexdigest(), None, True)
        data = gzip.compress(data) if packed else data
        lines.append("u 2000 " + json.dumps({"filename": name(packed), "offset": len(body), "length": len(data)}))
        body += data
    with zipfile.ZipFile(out, "w", method) as z:
        z.writestr("datapackage.json", "{}")
        z.writestr(f"archive/{name(packed)}", body)
        if index:
            z.writestr("indexes/index.cdx.gz", gzip.compress("\n".join(lines).encode()), index_method)
        z.comment = comment
    return prefix + out.getvalue()


def name(packed):
    return "data.warc.gz" if packed else "data.warc"


def wide(data: bytes) -> bytes:
    """The same file with a ZIP64 directory: all sizes and places in 64 bits."""
    end = data.rindex(archives.END)
    n, size, offset = struct.unpack_from("<HII", data, end + 10)
    at, entries = offset, b""
    for _ in range(n):
        head = bytearray(data[at:at + 46])
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", head, 20)
        header, = struct.unpack_from("<I", head, 42)
        struct.pack_into("<II", head, 20, archives.FULL32, archives.FULL32)
        struct.pack_into("<H", head, 30, 4 + 5 + 28)
        struct.pack_into("<I", head, 42, archives.FULL32)
        entries += head + data[at + 46:at + 46 + n_name] + struct.pack("<HH", 0x5455, 5) + b"\1\0\0\0\0" + struct.pack("<HHQQQ", 1, 24, full, packed, header)
        at += 46 + n_name + n_extra + n_comment
    record = archives.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(entries), offset)
    locator = archives.LOCATOR64 + struct.pack("<IQI", 0, offset + len(entries), 1)
    return data[:offset] + entries + record + locator + archives.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)


@pytest.mark.parametrize("data", [
    made(), made(packed=False), made(index=False), made(packed=False, index=False), made(prefix=b"PK\x05\x06 before"),
    made(comment=b"PK\x05\x06" + b"c" * 300), wide(made()), b"#!/bin/sh\n" + wide(made()), made(index_method=zipfile.ZIP_DEFLATED)],
    ids=["plain", "bare", "no index", "bare, no index", "prefix", "comment", "zip64", "zip64 with prefix", "packed index"])
def test_forms_of_packages(spark, tmp_path, data):
    (tmp_path / "a.zip").write_bytes(data)
    names = spark.createDataFrame([(f"file://{tmp_path}/a.zip",), (None,)], "package string")
    found = archives.read_archives(names, span=64).collect()
    assert sorted((r.page_id, r.payload_bytes, bytes(r.payload)) for r in found) == [(i, i, b"p" * i) for i in range(5)]


@pytest.mark.parametrize("data, says", [
    (made(method=zipfile.ZIP_DEFLATED), "not stored"), (made()[:-30], "no ZIP file"), (b"", "no ZIP file"),
    (made(packed=False).replace(b"pppp\r\n", b"pppq\r\n"), "digest")], ids=["deflated", "cut off", "empty", "other payload"])
def test_broken_packages_are_errors(spark, tmp_path, data, says):
    (tmp_path / "a.zip").write_bytes(data)
    with pytest.raises(Exception, match=says):
        archives.read_archives(spark.createDataFrame([(f"file://{tmp_path}/a.zip",)], "package string")).collect()


def test_scan_without_index_by_small_steps():
    whole = [archives.record(i, "u", "x" * i, i, hashlib.sha1(b"x" * i).hexdigest(), None, True) for i in range(30)]
    for packed in (True, False):
        parts = [gzip.compress(d) if packed else d for d in whole]
        data = b"".join(parts)
        found = list(archives.scanned(lambda at, n, data=data: data[at:at + n], len(data), packed, step=7))
        assert [d for _, _, d in found] == whole and [n for _, n, _ in found] == [len(p) for p in parts]
        with pytest.raises(ValueError, match="ends within"):
            list(archives.scanned(lambda at, n, data=data: data[at:at + n], len(data) - 3, packed, step=7))


def test_same_as_sql(spark, tmp_path):
    import duckdb

    from murmur.llm.oracle import SQL
    found = told(spark, tmp_path, pages())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert found == sorted(db.execute(SQL["op12_zip_warc"]).fetchall(), key=repr)
