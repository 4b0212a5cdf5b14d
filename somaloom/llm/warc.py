"""WARC archives: one gzip member a record, and a splittable reader.

Writing: pages with equal payloads are found by digest (aggregated map-side to one row a digest);
that with the largest ``page_id`` is written as ``response``, the others as ``revisit`` records
that name it. Each task streams its pages to archives of its own in the shared folder; the
manifest, a table that Spark commits, says which archives count.

Reading: an archive is cut into byte ranges, one row each. A task scans its range for the gzip
magic, takes a candidate as a member only if its first bytes decode to a WARC header (and to the
archive's own warcinfo id, so that an archive stored inside a payload is not mistaken for
records), and owns the records that start inside its range; the last may end beyond it.

Defined results: a null payload is empty; a null ``page_id`` stays null and is never referred to
while another page has the payload; repeated rows of the largest id are all responses; an empty
table makes no archive; other columns are ignored; payloads are never cut.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh_folder, open_store, pick, slices

MAGIC = b"\x1f\x8b\x08"
ARCHIVE_BYTES = 256 << 20
SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def find_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: the largest page id with the same payload, null for that page itself.

    Payloads under ``min_bytes`` refer to none. Only digests that several pages share are joined.
    """
    keyed = pages.withColumn("digest", F.sha1("payload"))
    shared = (keyed.filter(F.octet_length("payload") >= min_bytes).select("digest", "page_id")
              .groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).filter("n > 1").select("digest", "top"))
    return (keyed.join(shared, "digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))).drop("top", "digest"))


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {digest}')}>"


def page_record(info: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit without its payload, as one gzip member."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", DATE),
               ("WARC-Target-URI", _clean(url) if url else f"urn:page:{page_id}"), ("WARC-Warcinfo-ID", info), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    if refers_to is None:
        return _member(headers, http + payload)
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", _record_id(refers_to, digest)), ("WARC-Refers-To-Page-ID", str(refers_to))]
    return _member(headers, http)


def write_warc(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, payload) as archives; return the manifest (path, bytes, n_records)."""
    folder = fresh_folder(pages.sparkSession, "warc")
    rows = find_revisits(pages, min_bytes).select("page_id", "url", "payload", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, made = None, []
        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    path, info, size, n = f"{folder}/{name}", f"<urn:uuid:{uuid.uuid4()}>", 0, 0
                    store, inner = open_store(path)
                    if path.startswith("file:") or "://" not in path:
                        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(inner, compression=None)
                    size += out.write(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", info), ("WARC-Date", DATE), ("WARC-Filename", name),
                                               ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                size += out.write(page_record(info, row["page_id"], row["url"], row["payload"], row["refers_to"]))
                n += 1
                if size >= archive_bytes:
                    out.close()
                    made.append((path, size, n))
                    out = None
        if out is not None:
            out.close()
            made.append((path, size, n))
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "n_records"])

    return cut_lineage(rows.mapInArrow(write, "path string, bytes long, n_records long"))


def _headers(text: bytes) -> dict[str, str] | None:
    """Header fields if the bytes open a WARC record; None if they do not."""
    if not re.match(rb"WARC/\d\.\d\r\n", text) or b"\r\n\r\n" not in text:
        return None
    lines = text[: text.index(b"\r\n\r\n")].split(b"\r\n")[1:]
    fields = {k.decode("latin-1").lower(): v.decode("utf-8", "replace").strip() for k, colon, v in (line.partition(b":") for line in lines) if colon}
    return fields if "warc-type" in fields and fields.get("content-length", "").isdigit() else None


class RangeReader:
    """Records of one archive that start in a byte range."""

    def __init__(self, path: str, start: int, end: int):
        store, inner = open_store(path)
        self.file, self.start, self.end = store.open_input_file(inner), start, end
        self.size = self.file.size()

    def _at(self, place: int, count: int) -> bytes:
        self.file.seek(place)
        return self.file.read(min(count, self.size - place))

    def _decode(self, place: int, header_only: bool) -> tuple[bytes, int] | None:
        """The content of the member at ``place`` (or its header part) and where it ends; None if it is no member."""
        unpack, parts, at = zlib.decompressobj(31), [], place
        try:
            while not unpack.eof:
                data = self._at(at, 4096 if header_only else READ_BYTES)
                if not data:
                    return None
                at += len(data)
                parts.append(unpack.decompress(data))
                if header_only and (b"\r\n\r\n" in (text := b"".join(parts)) or not text.startswith(b"WARC/"[: len(text)])):
                    return text, at
        except zlib.error:
            return None
        return b"".join(parts), at - len(unpack.unused_data)

    def _first_info(self) -> str | None:
        first = self._decode(0, True)
        fields = _headers(first[0]) if first else None
        return fields["warc-record-id"] if fields and fields["warc-type"] == "warcinfo" else None

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        info, place = self._first_info(), self.start
        while place < self.end:
            place = self._next_magic(place)
            if place is None:
                return
            head = self._decode(place, True)
            fields = _headers(head[0]) if head else None
            if fields is None or info is not None and info not in (fields.get("warc-warcinfo-id"), fields.get("warc-record-id")):
                place += 1
                continue
            whole = self._decode(place, False)
            if whole is None:
                raise ValueError(f"broken member at byte {place}")
            text, place = whole
            begin = text.index(b"\r\n\r\n") + 4
            yield fields, text[begin : begin + int(fields["content-length"])]

    def _next_magic(self, place: int) -> int | None:
        while place < self.end:
            data = self._at(place, min(READ_BYTES, self.end - place) + len(MAGIC) - 1)
            found = data.find(MAGIC)
            if found >= 0:
                return place + found if place + found < self.end else None
            place += READ_BYTES
        return None


RECORDS = ("record_id string, record_type string, target_uri string, page_id long, refers_to long, payload_digest string, payload_bytes long, payload binary")


def _row(fields: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").partition(":")[2] or None
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    kind = fields["warc-type"]
    if kind == "response" and digest and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload digest of {fields.get('warc-record-id')}")
    number = {k: int(v) if (v := fields.get(f"warc-{k}")) else None for k in ("page-id", "refers-to-page-id")}
    return {"record_id": fields.get("warc-record-id"), "record_type": kind, "target_uri": fields.get("warc-target-uri"), "page_id": number["page-id"],
            "refers_to": number["refers-to-page-id"], "payload_digest": digest, "payload_bytes": len(payload) if kind == "response" else int(stated[1]) if stated else None,
            "payload": payload if kind == "response" else None}


def read_warc(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Page records of archives (path, bytes), each read by the task whose byte range it starts in."""
    ranges = archives.select("path", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start"),
                             "bytes").selectExpr("path", "start", f"least(bytes, start + {split_bytes}) AS end")
    n = max(1, archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1)
    names = [c.split()[0] for c in RECORDS.split(", ")]
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in RECORDS.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for fields, block in RangeReader(row["path"], row["start"], row["end"]).records():
                    if fields["warc-type"] in ("response", "revisit"):
                        held.append(_row(fields, block))
                        size += len(block)
                    if size > READ_BYTES or len(held) >= 1000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return ranges.repartitionByRange(int(n), "path", "start").mapInArrow(read, RECORDS).select(*names)


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) and read the archives back."""
    rows = pick(pages, page_id="long", url="string", html="string").select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    return read_warc(write_warc(rows, min_bytes))
