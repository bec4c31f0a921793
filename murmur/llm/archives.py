"""Web records in archives that are packed in ZIP files: written, and read by ranges through their directories and indexes."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import prepare, qualified, settled, store_of
from murmur.session import scratch_folder

#: Bytes of one package, and of neighbouring records that are read at once; one record at least.
PACKAGE, SPAN = 1 << 30, 4 << 20
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "package string, n_records long, n_bytes long"
SPANS = "package string, member string, at long, size long, packed boolean, records array<struct<offset:bigint,length:bigint>>"
RECORDS = ("package string, member string, offset long, length long, type string, record_id string, uri string, date string, "
           "payload_digest string, payload_bytes long, refers_to string, page_id long, payload binary")

# Signatures and places of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
STORED, DEFLATED, FULL16, FULL32 = 0, 8, 0xFFFF, 0xFFFFFFFF
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_id(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: str, size: int, sha1: str, refers_to: int | None,
           response: bool, date: str = DATE) -> bytes:
    """One record. A revisit holds the HTTP header alone; digest and length there are those of the full payload."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload.encode() if response else head
    own = _page_id(page_id) if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest + (url or ''))}>"
    fields = [("WARC-Type", "response" if response else "revisit"), ("WARC-Record-ID", own), ("WARC-Date", date)]
    if url is not None:  # a line break or other control in a url would end its line
        fields.append(("WARC-Target-URI", "".join([c if c.isprintable() and c != " " else urllib.parse.quote(c) for c in url])))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if not response:
        fields += [("WARC-Refers-To", _page_id(refers_to)), ("WARC-Profile", REVISIT)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join([f"{name}: {value}\r\n" for name, value in fields])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class PackageWriter:
    """A ZIP file of one stored archive, each of its records compressed by itself, and the archive's index."""

    def __init__(self, path: str):
        self.path = path
        store, place = store_of(path)
        self.file = store.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.name = "pages.warc.gz"
        # A fixed time, so that a repeated task writes the same bytes; sizes of 64 bits, as the archive's is not known yet.
        self.member = self.zip.open(zipfile.ZipInfo(f"archive/{self.name}"), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, data: bytes, digest: str, url: str | None) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.member.write(packed)
        place = {"url": url, "digest": digest, "filename": self.name, "offset": str(self.size), "length": str(len(packed))}
        self.index.append(f"{urllib.parse.quote(url or '-')} {DATE[:4]}0101000000 {json.dumps(place)}\n")
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo("indexes/index.cdxj"), "w", force_zip64=True) as out:
            for line in sorted(self.index):
                out.write(line.encode())
        self.zip.close()
        self.file.close()
        return self.path, len(self.index), self.size


def with_copies(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, size, sha1, refers_to, response: of equal payloads the one of the largest page_id is the response.

    The page_ids that copies refer to are a table of their own, with a row for each payload
    that is there twice, so adaptive execution can split the rows of a much copied one.
    """
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"), F.sha1(F.encode(html, "UTF-8")).alias("sha1"))
    copied = settled(keyed.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "copied")
    response = F.col("refers_to").isNull() | F.col("page_id").eqNullSafe(F.col("refers_to"))
    return keyed.join(copied, "sha1", "left").select(
        "page_id", "url", F.when(response, F.col("payload")).otherwise("").alias("payload"),
        F.octet_length("payload").cast("long").alias("size"), "sha1", "refers_to", response.alias("response"))


def write_archives(pages: DataFrame, folder: str | None = None, package: int = PACKAGE) -> DataFrame:
    """Write a record for each row (page_id, url, html) and return the packages' manifest, a table in the shared folder.

    A null html is an empty payload. Rows with the largest page_id of an equal payload are
    responses, all of them if that page_id stands there twice; the others revisit it, also
    those without page_id. Where no row has a page_id all are responses. Tasks write packages
    of about `package` bytes under names of their own attempt, and only those of the attempt
    that counts are in the manifest, so repeated tasks do no harm. An empty table has none.
    """
    spark = pages.sparkSession
    prepare(spark)
    folder = qualified(spark, folder or scratch_folder(spark, "archives"))
    store, place = store_of(folder)
    store.create_dir(place, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    out = PackageWriter(f"{folder}/{uuid.uuid4().hex}.zip")
                out.add(record(*row), row[4], row[1])
                if out.size >= package:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["package", "n_records", "n_bytes"])
    return settled(with_copies(pages).mapInArrow(write, MANIFEST), "manifest")


class Member(NamedTuple):
    name: str
    method: int
    header: int
    packed: int
    size: int


class Package:
    """A ZIP file by ranges: its directory, and where its members' bytes lie."""

    def __init__(self, path: str):
        store, place = store_of(path)
        self.path, self.file = path, store.open_input_file(place)
        self.length = self.file.size()

    def read(self, at: int, size: int) -> bytes:
        data = self.file.read_at(size, at)
        if len(data) != size:
            raise ValueError(f"{self.path} ends before byte {at + size}")
        return data

    def _directory(self) -> tuple[int, int, int]:
        """Number of entries, the directory's place, and what lies before the ZIP file proper."""
        tail = self.read(start := max(0, self.length - 22 - FULL16), self.length - start)
        at = tail.rfind(END)
        while at >= 0 and not (len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError(f"{self.path} is no ZIP file")
        n, size, offset = struct.unpack_from("<HII", tail, at + 10)
        end = start + at
        if end >= 20 and (locator := self.read(end - 20, 20))[:4] == LOCATOR64:
            at = struct.unpack_from("<Q", locator, 8)[0]
            # Bytes put before the file move the record from where the locator tells; then it ends where the locator begins.
            if at + 56 > end or self.read(at, 4) != END64:
                at = end - 20 - 56
            n, size, offset = struct.unpack_from("<QQQ", self.read(at, 56), 32)
            end = at
        return n, end - size, end - size - offset

    def members(self) -> Iterator[Member]:
        n, at, before = self._directory()
        for _ in range(n):
            head = self.read(at, 46)
            if head[:4] != ENTRY:
                raise ValueError(f"{self.path}: the directory is broken at {at}")
            flags, method = struct.unpack_from("<HH", head, 8)
            packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", head, 20)
            header, = struct.unpack_from("<I", head, 42)
            rest = self.read(at + 46, n_name + n_extra)
            name, extra = rest[:n_name].decode("utf-8" if flags & 0x800 else "cp437"), rest[n_name:]
            while len(extra) >= 4:
                kind, length = struct.unpack_from("<HH", extra)
                if kind == 1:  # 64-bit numbers stand here for those that are full, in this order
                    wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                    size = next(wide) if size == FULL32 else size
                    packed = next(wide) if packed == FULL32 else packed
                    header = next(wide) if header == FULL32 else header
                extra = extra[4 + length:]
            if flags & 1:
                raise ValueError(f"{self.path}: {name} is encrypted")
            yield Member(name, method, before + header, packed, size)
            at += 46 + n_name + n_extra + n_comment

    def start(self, member: Member) -> int:
        """The first byte of a member's data: the local header has its own name and extra fields."""
        head = self.read(member.header, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"{self.path}: no member at {member.header}")
        return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))

    def whole(self, member: Member) -> bytes:
        data = self.read(self.start(member), member.packed)
        if member.method == DEFLATED:
            data = zlib.decompress(data, -15)
        elif member.method != STORED:
            raise ValueError(f"{self.path}: {member.name} is packed by method {member.method}")
        return gzip.decompress(data) if member.name.endswith(".gz") else data


def spans_of(package: Package, span: int = SPAN) -> Iterator[tuple]:
    """(package, member, at, size, packed, records) of all records, neighbours together; records is null without an index."""
    archives, places = {}, {}
    for member in package.members():
        folder, _, name = member.name.rpartition("/")
        if folder == "archive" and name.endswith((".warc", ".warc.gz")):
            if member.method != STORED:
                raise ValueError(f"{package.path}: {member.name} is not stored, so it can't be read by ranges")
            archives[name] = member
        elif folder == "indexes" and name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")):
            for line in package.whole(member).splitlines():
                entry = json.loads(line[line.index(b"{"):])
                places.setdefault(entry["filename"], set()).add((int(entry["offset"]), int(entry["length"])))
    if lost := set(places) - set(archives):
        raise ValueError(f"{package.path}: the index names archives that are not there: {sorted(lost)[:3]}")
    for name, member in archives.items():
        at, packed = package.start(member), name.endswith(".gz")
        if name not in places:
            yield package.path, name, at, member.packed, packed, None
            continue
        group: list[tuple[int, int]] = []
        for offset, length in sorted(places[name]):
            if group and (offset != sum(group[-1]) or offset + length - group[0][0] > span):
                yield package.path, name, at, member.packed, packed, group
                group = []
            group.append((offset, length))
        if group:
            yield package.path, name, at, member.packed, packed, group


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if name}


def parsed(data: bytes, payloads: bool = True) -> tuple:
    """type, id, uri, date, digest, payload bytes, refers_to, page_id and payload of one record; a payload's digest is verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no record here")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest")
    if kind == "revisit":
        size, payload = int(_fields(http).get("content-length", 0)), None
        digest = digest and digest.removeprefix("sha1:")
    else:
        size, own = len(payload), digest_of(payload)
        if digest and digest.startswith("sha1:") and digest != f"sha1:{own}":
            raise ValueError(f"the payload of {fields.get('warc-record-id')} is not what its digest tells")
        digest = own
    page = fields.get("warc-record-id", "").removeprefix("<urn:x-page:").rstrip(">")
    return (kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"), digest, size,
            fields.get("warc-refers-to"), int(page) if page.lstrip("-").isdigit() else None, payload if payloads else None)


def scanned(read: Callable[[int, int], bytes], size: int, packed: bool, step: int = SPAN) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and bytes of each record of an archive without index, which is read in steps from its start."""
    at, offset, held = 0, 0, b""

    def more() -> bool:
        nonlocal at, held
        n = min(step, size - at)
        held += read(at, n) if n else b""
        at += n
        return n > 0
    while held or more():
        if packed:
            unpacker, out, used = zlib.decompressobj(31), [], 0
            while True:
                out.append(unpacker.decompress(held))
                used += len(held) - len(unpacker.unused_data)
                held = unpacker.unused_data
                if unpacker.eof:
                    break
                if not more():
                    raise ValueError(f"the archive ends within the record at {offset}")
            data = b"".join(out)
        else:
            while (end := held.find(b"\r\n\r\n")) < 0 and more():
                pass
            used = end + 8 + int(_fields(held[:end])["content-length"]) if end >= 0 else 0
            while len(held) < used and more():
                pass
            if end < 0 or len(held) < used:
                raise ValueError(f"the archive ends within the record at {offset}")
            data, held = held[:used], held[used:]
        yield offset, used, data
        offset += used


def indexed(package: Package, at: int, records: list[dict], packed: bool) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and bytes of neighbouring records of the archive at `at`, by one read."""
    first, last = records[0]["offset"], records[-1]["offset"] + records[-1]["length"]
    data = memoryview(package.read(at + first, last - first))
    for r in records:
        own = data[r["offset"] - first:r["offset"] - first + r["length"]]
        yield r["offset"], r["length"], gzip.decompress(own) if packed else bytes(own)


def read_archives(packages: DataFrame, payloads: bool = True, span: int = SPAN) -> DataFrame:
    """All records (RECORDS) of the packages named in column `package`, read by ranges.

    First each package's directory and indexes are read, a row a package, and give spans of
    neighbouring records; then the spans are dealt to all tasks, so one large package is read
    by many. Nothing is extracted: a task reads a span's bytes where they lie. A record's
    payload is held against its digest; a revisit has none, its digest and length are those
    of the payload it refers to. An archive without index is scanned by one task in steps.
    An archive that is compressed as a member, an index that names none, a cut-off file or a
    payload of another digest is an error. No packages give no rows.
    """
    spark = packages.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(),
             pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())]))]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for *row, group in spans_of(Package(path), span):
                    records = None if group is None else [{"offset": o, "length": n} for o, n in group]
                    yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip([*row, records], kinds)],
                                                     ["package", "member", "at", "size", "packed", "records"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        for batch in batches:
            for path, member, at, size, packed, records in zip(*[c.to_pylist() for c in batch.columns]):
                if package is None or package.path != path:
                    package = Package(path)
                if records is None:
                    own = scanned(lambda a, n, p=package, b=at: p.read(b + a, n), size, packed, span)
                else:
                    own = indexed(package, at, records, packed)
                rows, held = [], 0
                for offset, length, data in own:
                    rows.append((path, member, offset, length, *parsed(data, payloads)))
                    held += len(data) if payloads else 0
                    if held >= span or len(rows) >= 4096:
                        yield _records(rows)
                        rows, held = [], 0
                if rows:
                    yield _records(rows)
    names = packages.select("package").where(F.col("package").isNotNull()).repartition(parts, "package")
    spans = settled(names.mapInArrow(locate, SPANS), "spans")
    return spans.repartition(parts, "package", "member", F.col("records")[0]["offset"]).mapInArrow(read, RECORDS)


_RECORD_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
                 pa.int64(), pa.string(), pa.int64(), pa.binary()]


def _records(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _RECORD_TYPES)], names)
