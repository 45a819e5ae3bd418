"""Web archives (WARC 1.1): written by tasks side by side, read record by record.

Every record is a gzip member of its own, so archives can be joined and cut between
records. The reader is sequential and holds one record at most: bytes come in chunks,
are inflated as they come, framed by the header's content length, and the digests of
block and payload are taken meanwhile and compared with those of the header.

Pages with equal payloads of at least `least_bytes` are stored once: the one with the
largest page id is a response, the others are revisits that refer to it and carry no
payload. A record's id is a UUID (version 8) that holds the page id.

Archives go to the shared folder of the session. Tasks write under names of their own,
and only names that a finished task has returned are read, so a task that is run
again leaves nothing behind that counts. Executors reach the folder through Arrow's file
systems (local or mounted paths, HDFS, S3, Google storage).

Nulls: a null html is an empty payload, a null url an empty target, a null page id a
record of its own that others never refer to while the group has an id. Rows with equal
payload and the same largest id are all responses. An empty table gives no archive. Other
columns of the pages are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.hot_keys import join_one
from ledgerlark.storage import shared_folder, write_stage

LEAST_BYTES = 1000
ARCHIVE_BYTES = 1 << 30
_CHUNK = 1 << 18
_ROWS_BYTES = 1 << 24
_LEVEL = 6
_MOST_HEAD = 1 << 20
_DATE = "1970-01-01T00:00:00Z"  # pages carry no date of their own
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = (
    "archive string, offset long, record_type string, record_id string, target_uri string, payload binary,"
    " payload_bytes long, payload_digest string, refers_to string"
)


# ---- records -----------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    """URN of a page: a version 8 UUID with the id in its last bits, or a random one."""
    if page_id is None:
        return uuid.uuid4().urn
    bits = page_id & ((1 << 64) - 1)
    return uuid.UUID(int=8 << 76 | (bits >> 62) << 64 | 2 << 62 | bits & ((1 << 62) - 1)).urn


def page_of(urn: str | None) -> int | None:
    """Page id of a record id, or None."""
    number = uuid.UUID(urn) if urn else None
    if number is None or number.version != 8:
        return None
    bits = ((number.int >> 64) & 3) << 62 | number.int & ((1 << 62) - 1)
    return bits - (1 << 64) if bits >> 63 else bits


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _fields(fields: dict[str, object]) -> bytes:
    # a line break in a value would end the header
    lines = (f"{name}: {' '.join(str(value).split())}" for name, value in fields.items())
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n"


def _member(fields: dict[str, object], block: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    head = b"WARC/1.1\r\n" + _fields(fields | {"Content-Length": len(block)})
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """Gzip member of a page: a response with its payload, or a revisit of the page `refers_to`."""
    http = b"HTTP/1.1 200 OK\r\n" + _fields(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)}
    )
    block = http + payload if refers_to is None else http
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{record_id(page_id)}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": url or "",
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": _digest(block),
        "WARC-Payload-Digest": _digest(payload),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": _SAME_PAYLOAD, "WARC-Refers-To": f"<{record_id(refers_to)}>"}
    return _member(fields, block)


def info_member(name: str) -> bytes:
    """Gzip member that opens an archive."""
    block = _fields({"software": "ledgerlark", "format": "WARC File Format 1.1"})[:-2]
    return _member(
        {
            "WARC-Type": "warcinfo", "WARC-Record-ID": f"<{uuid.uuid4().urn}>", "WARC-Date": _DATE,
            "WARC-Filename": name, "Content-Type": "application/warc-fields", "WARC-Block-Digest": _digest(block),
        },
        block,
    )


# ---- sequential reader -------------------------------------------------------


class BrokenArchive(ValueError):
    """An archive that ends too early, or whose records are not framed or digested as they say."""


class _Members:
    """Inflated bytes of the gzip members of a stream, one member at a time."""

    def __init__(self, stream: BinaryIO):
        self.stream = stream
        self.raw = b""
        self.taken = 0  # compressed bytes handed to inflaters so far
        self.held = b""
        self.inflater = None

    def next(self) -> int | None:
        """Place of the next member, or None at the end of the stream."""
        if not self.raw:
            self.raw = self.stream.read(_CHUNK)
        self.held, self.inflater = b"", zlib.decompressobj(31)
        return self.taken if self.raw else None

    def more(self) -> bytes:
        """Some more bytes of the member; none at its end."""
        while not self.inflater.eof:
            # what the inflater did not take yet comes first, so one call returns a chunk at most
            source = self.inflater.unconsumed_tail or self.raw or self.stream.read(_CHUNK)
            if not source:
                raise BrokenArchive(f"the archive ends inside the member at byte {self.taken}")
            fresh = not self.inflater.unconsumed_tail
            try:
                out = self.inflater.decompress(source, _CHUNK)
            except zlib.error as error:
                raise BrokenArchive(f"no gzip data near byte {self.taken}: {error}") from error
            rest = self.inflater.unused_data if self.inflater.eof else b""
            self.taken += len(source) - len(self.inflater.unconsumed_tail) - len(rest)
            self.raw = rest if self.inflater.eof else (b"" if fresh else self.raw)
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        """Bytes of the member up to and with the mark."""
        while (end := self.held.find(mark)) < 0:
            more = self.more()
            if not more or len(self.held) > _MOST_HEAD:
                raise BrokenArchive(f"no {mark!r} before byte {self.taken}")
            self.held += more
        end += len(mark)
        found, self.held = self.held[:end], self.held[end:]
        return found

    def exactly(self, count: int) -> Iterator[bytes]:
        """The next bytes of the member, in parts."""
        while count:
            part, self.held = self.held[:count], self.held[count:]
            if not part:
                self.held = self.more()
                if not self.held:
                    raise BrokenArchive(f"{count} bytes are missing before byte {self.taken}")
                continue
            count -= len(part)
            yield part

    def rest(self) -> bytes:
        """All that is left of the member."""
        while more := self.more():
            self.held += more
        return self.held


def _header(data: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = data.decode("utf-8").split("\r\n")[:-2]
    pairs = (line.partition(":") for line in lines)
    return first, {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Taken:
    """Digest of parts as they pass, and the parts themselves on request."""

    def __init__(self, keep: bool = False):
        self.sha1, self.size, self.parts, self.keep = hashlib.sha1(), 0, [], keep

    def add(self, part: bytes) -> None:
        self.sha1.update(part)
        self.size += len(part)
        if self.keep:
            self.parts.append(part)

    def check(self, written: str | None, what: str) -> None:
        """Compare with `sha1:` and the digest in base 32 or hexadecimal digits."""
        kind, _, value = (written or "").partition(":")
        if kind.lower() != "sha1":
            return
        same = value.lower() == self.sha1.hexdigest() if len(value) == 40 else (
            value.upper() == base64.b32encode(self.sha1.digest()).decode()
        )
        if not same:
            raise BrokenArchive(f"{what} does not have the digest {written}")


def _hex(written: str | None) -> str | None:
    """Digits of a written SHA-1 digest in hexadecimal."""
    value = (written or "").partition(":")[2]
    return (value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()) if value else None


def _http_length(head: bytes) -> int | None:
    """Length of the payload that the head of an HTTP message states."""
    length = _header(head)[1].get("content-length")
    return int(length) if length else None


def read_records(stream: BinaryIO, keep_payload: bool = True) -> Iterator[dict]:
    """Records of an archive in their order, every one framed and verified.

    A revisit has no payload; its size and digest are those of the page that it refers to.
    """
    members = _Members(stream)
    while (place := members.next()) is not None:
        version, fields = _header(members.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise BrokenArchive(f"no record at byte {place}")
        kind, http = fields["warc-type"], fields.get("content-type", "").startswith("application/http")
        block, payload, head = _Taken(), _Taken(keep_payload and kind != "revisit"), b""
        inside = not http  # the payload of an HTTP message begins behind its head
        for part in members.exactly(int(fields["content-length"])):
            block.add(part)
            if not inside:
                head += part
                end = head.find(b"\r\n\r\n")
                if end < 0:
                    if len(head) > _MOST_HEAD:
                        raise BrokenArchive(f"no HTTP head in the record at byte {place}")
                    continue
                head, part, inside = head[: end + 4], head[end + 4 :], True
            payload.add(part)
        if members.rest() != b"\r\n\r\n":
            raise BrokenArchive(f"the record at byte {place} is longer or shorter than it says")
        block.check(fields.get("warc-block-digest"), f"block of the record at byte {place}")
        length, digest = payload.size, payload.sha1.hexdigest()
        if kind == "revisit":
            length, digest = _http_length(head), _hex(fields.get("warc-payload-digest"))
        else:
            payload.check(fields.get("warc-payload-digest"), f"payload of the record at byte {place}")
        yield {
            "offset": place,
            "record_type": kind,
            "record_id": fields["warc-record-id"].strip("<>"),
            "target_uri": fields.get("warc-target-uri", ""),
            "payload": b"".join(payload.parts) if payload.keep else None,
            "payload_bytes": length,
            "payload_digest": digest,
            "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
        }


# ---- archives on Spark -------------------------------------------------------


def _opener(folder: str) -> Callable[[], tuple]:
    """(file system, path) of a folder, found again in every task."""
    # Arrow wants file:///path or a plain path
    uri = folder if "://" in folder or not folder.startswith("file:") else "file://" + folder.removeprefix("file:")

    def opened():
        from pyarrow import fs

        return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)

    return opened


def revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, key, refers_to) of the pages whose payload a page with a larger id has too."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pages.select("page_id", F.octet_length(payload).alias("_size"), F.sha2(payload, 256).alias("key"))
    large = write_stage(narrow.where(F.col("_size") >= least_bytes).select("page_id", "key"), "payload_keys")
    groups = large.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("_n"))
    groups = write_stage(groups.where("_n > 1 AND refers_to IS NOT NULL"), "payload_groups")
    met = join_one(large, groups, ["key"], "_n")
    return met.where("page_id IS NULL OR page_id < refers_to").select("page_id", "key", "refers_to").distinct()


def write_archives(pages: DataFrame, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, records, bytes) per archive written from pages (page_id, url, html).

    An archive ends at `archive_bytes`; a task writes one archive or several.
    """
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = write_stage(revisits(pages, least_bytes), "revisits").withColumnRenamed("page_id", "_page")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.sha2(payload, 256) == F.col("key"))
    rows = pages.select("page_id", "url", "html").join(known, same, "left").select("page_id", "url", payload, "refers_to")
    opened = _opener(folder)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = opened()
        stream, done = None, []
        try:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(column for column in batch.columns)):
                    if stream is None:
                        place.create_dir(root, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        stream, records, size = place.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                        size += stream.write(info_member(name))
                    size += stream.write(page_member(page_id.as_py(), url.as_py(), html.as_py(), refers_to.as_py()))
                    records += 1
                    if size >= archive_bytes:
                        stream.close()
                        stream = None
                        done.append((f"{folder}/{name}", records, size))
        finally:
            if stream is not None:
                stream.close()
        if stream is not None:
            done.append((f"{folder}/{name}", records, size))
        columns = list(zip(*done)) or [[], [], []]
        types = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["archive", "records", "bytes"]
        )

    return write_stage(rows.mapInArrow(written, "archive string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """All records of archives (archive), one task per archive where there are cores.

    A record that is cut off or does not have its digest stops the job with its place.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                folder, _, name = archive.rpartition("/")
                place, root = _opener(folder)()
                rows, size = [], 0
                with place.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in read_records(stream, keep_payload):
                        rows.append(record | {"archive": archive})
                        size += 1000 + len(record["payload"] or b"")
                        if size >= _ROWS_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                yield _batch(rows)

    names = archives.select("archive")
    return names.repartition(max(1, archives.count())).mapInArrow(read, _RECORD)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    numbers, raw = {"offset", "payload_bytes"}, {"payload"}
    names = [field.split()[0] for field in _RECORD.split(", ")]
    kinds = [pa.int64() if n in numbers else pa.binary() if n in raw else pa.string() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)


def page_column(urn: str) -> Column:
    """Page id of a column of record ids, null for ids of other kinds."""
    digits = F.replace(F.substring(F.col(urn), 10, 36), F.lit("-"), F.lit(""))

    def number(first: int, count: int) -> Column:
        return F.conv(F.substring(digits, first, count), 16, 10).cast("long")

    # 48 bits of zero, the version, ten unused bits, two high bits, two bits of the variant, sixty-two low bits
    low = number(18, 15).bitwiseOR(F.shiftleft(number(17, 1).bitwiseAND(F.lit(3)), 60))
    page = F.shiftleft(number(14, 3).bitwiseAND(F.lit(3)), 62).bitwiseOR(low)
    return F.when(F.substring(digits, 13, 1) == "8", page)
