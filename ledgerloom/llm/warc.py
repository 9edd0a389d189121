"""WARC archives of pages: writing, and reading back as a sequence of gzip members.

Every record is a gzip member of its own. Pages with equal payloads are stored once: the one
with the smallest id is a response, the others are revisits that name it and keep only the
HTTP header. A task writes its pages to archives below the shared folder, under names that
no other attempt uses, and reports what it wrote as rows; only reported archives are read,
so a task that fails or runs twice leaves nothing in the results.

The reader walks an archive from its first byte: it inflates one member at a time in small
steps, takes the record's length from its header, and checks block and payload digests.

Paths are opened through `pyarrow.fs`, which knows local folders and object stores.

Defined cases: null html is an empty payload; payloads under `least_bytes` are always
responses; a null id is larger than any id, and rows that repeat the id of the response are
responses too; a null url leaves the target out; extra columns play no part; an empty table
gives no records.
"""

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import keep, utf8
from ledgerloom.session import scratch_path

ARCHIVE_BYTES = 256 << 20
#: Tasks that read archives; each takes several where there are more.
MAX_TASKS = 20_000
#: Repeated digests that may be broadcast (about 100 MB); more are joined by shuffle.
BROADCAST_DIGESTS = 1_000_000
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


_INFO = (
    ("WARC-Type", "warcinfo"),
    ("WARC-Record-ID", "<urn:page:info>"),
    ("WARC-Date", DATE),
    ("Content-Type", "application/warc-fields"),
)


class WarcError(ValueError):
    """An archive breaks its framing or a digest."""


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id):
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id):
    text = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _frame(headers, block):
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, refers_to=None, revisit=False, date=DATE) -> bytes:
    """One response or revisit record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", date),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + digest_of(payload)),
        ("WARC-Block-Digest", "sha1:" + digest_of(block)),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if revisit:
        headers += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", _PROFILE)]
    return _frame(headers, block)


def member(record: bytes, level: int = 6) -> bytes:
    """A record as a gzip member of its own."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def members(stream, chunk=CHUNK):
    """Inflate a stream of gzip members one by one, in steps of `chunk` compressed bytes."""
    rest = b""
    while True:
        rest = rest or stream.read(chunk)
        if not rest:
            return
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            try:
                parts.append(inflate.decompress(rest))
            except zlib.error as error:
                raise WarcError(f"broken gzip member: {error}") from error
            rest = inflate.unused_data
            if not inflate.eof:
                rest = stream.read(chunk)
                if not rest:
                    raise WarcError("archive ends inside a gzip member")
        yield b"".join(parts)


def parse_record(data: bytes):
    """(headers with lower-case names, block) of one record; checks framing and digest."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    length = int(headers.get("content-length", -1))
    if length < 0 or rest[length:] != b"\r\n\r\n":
        raise WarcError("content length does not frame the record")
    block = rest[:length]
    stated = headers.get("warc-block-digest")
    if stated and stated != "sha1:" + digest_of(block):
        raise WarcError("block digest does not match")
    return headers, block


def read_archive(stream):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) per page record."""
    for data in members(stream):
        headers, block = parse_record(data)
        kind = headers.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        fields = dict(
            (k.strip().lower(), v.strip())
            for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")[1:])
        )
        length = int(fields[b"content-length"])
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
            raise WarcError("payload does not match its length or digest")
        refers_to = _page_id(headers["warc-refers-to"]) if kind == "revisit" else None
        yield (
            _page_id(headers["warc-record-id"]),
            length,
            digest,
            kind,
            refers_to,
            payload if kind == "response" else None,
        )


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with `payload`, `refers_to` and `revisit`.

    Only digests and ids are grouped. Digests that occur more than once are broadcast while
    they are few; beyond that the join shuffles, and adaptive execution splits hot digests.
    """
    rows = pages.select("page_id", "url", utf8("html").alias("payload"))
    # Not the SHA-1 of the records: files are known that share it.
    rows = rows.withColumn("_digest", F.unhex(F.sha2("payload", 256)))
    large = rows.filter(F.octet_length("payload") >= least_bytes)
    firsts = large.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = keep(firsts.filter("_n > 1").select("_digest", "_first"), "repeated-payloads")
    few = firsts.count() <= BROADCAST_DIGESTS
    joined = rows.join(F.broadcast(firsts) if few else firsts, "_digest", "left")
    met = F.col("_first").isNotNull() & (F.octet_length("payload") >= least_bytes)
    revisit = met & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        "page_id", "url", "payload", F.col("_first").alias("refers_to"), revisit.alias("revisit")
    )


def _opened(root):
    """(file system, path in it) of a folder given as a path or URI."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), root) if root.startswith("/") else fs.FileSystem.from_uri(root)


def _number(value):
    return None if pd.isna(value) else int(value)


def write_archives(pages: DataFrame, root: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES):
    """(path, n_records, n_bytes) of the archives written; this table names what counts."""
    place, base = _opened(root)
    place.create_dir(base, recursive=True)

    def write(batches):
        files, folder = _opened(root)
        out, made = None, []
        for rows in batches:
            for page_id, url, payload, refers_to, revisit in rows.itertuples(index=False, name=None):
                if out is None:
                    # Members are compressed here; by the name alone Arrow would do it again.
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, n, size = files.open_output_stream(path, compression=None), 0, 0
                    size += out.write(member(_frame(_INFO, b"format: WARC File Format 1.1\r\n")))
                data = member(page_record(_number(page_id), url, payload, _number(refers_to), revisit))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    made.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            made.append((path, n, size))
        yield pd.DataFrame(made, columns=["path", "n_records", "n_bytes"])

    written = decide(pages, least_bytes).mapInPandas(write, "path string, n_records long, n_bytes long")
    return keep(written, "archives")


_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame, root: str, payloads: bool = False) -> DataFrame:
    """Page records of the archives named in `archives` (column path below `root`)."""
    schema = _RECORDS + (", payload binary" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches):
        files, _ = _opened(root)
        for rows in batches:
            for path in rows["path"]:
                found, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for record in read_archive(stream):
                        found.append(record if payloads else record[:-1])
                        size += record[1] if payloads else 64
                        if size >= 8 << 20:
                            yield _records(found, names)
                            found, size = [], 0
                yield _records(found, names)

    # One archive is one sequential read. A stated number keeps adaptive execution from
    # putting all of the few paths into one task.
    n_tasks = min(max(1, archives.count()), MAX_TASKS)
    spread = archives.select("path").repartition(n_tasks)
    return spread.mapInPandas(read, schema)


def unresolved_revisits(records: DataFrame) -> DataFrame:
    """(refers_to, payload_digest, payload_bytes) that revisits name and no response has.

    Revisits of one response collapse on the map side before they are joined.
    """
    key = ["refers_to", "payload_digest", "payload_bytes"]
    named = records.filter("record_type = 'revisit'").select(*key).distinct()
    there = records.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), *key[1:])
    return named.join(there, key, "left_anti")


def _records(found, names):
    out = pd.DataFrame(found, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def round_trip(pages: DataFrame, least_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Write pages to new archives below the shared folder and read them back."""
    root = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, root, least_bytes), root, payloads)
