"""WARC archives of pages, and a globally ordered capture index of them.

Each task writes its pages as gzipped WARC records into files in the shared
folder; the first record of a payload is a response and later ones revisit it.
The archives are read back record by record; every file yields its captures
sorted by URL key and timestamp, a run.  The runs are then merged: the key
space is cut into ranges, and each range merges its slices of all runs with a
loser tree, so the captures come out in global order.

Defined cases: a null html is an empty payload; a null url has no target and
an empty URL key.  Rows that share the smallest page_id of a payload are all
responses.  A null page_id is larger than any other; payloads of which all
ids are null are all responses.  An empty table writes no archive.  Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import join_counted, lean, scratch_dir, written

FILE_BYTES = 256 << 20  # an archive is closed beyond this size
RANGE_ROWS = 25_000  # captures of one merge task, about
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=timezone.utc)
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

CAPTURES = ("page_id long, urlkey string, timestamp string, payload_bytes long, "
            "payload_digest string, record_type string, refers_to long, archive string, "
            "at long, length long")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query; lower case."""
    m = re.match(r"(?s)[^:/?#]*://([^/?#]*)([^#]*)", url or "")
    if not m:
        return (url or "").lower()
    host = ",".join(reversed(m[1].lower().split(".")))
    return f"{host}){m[2].lower() or '/'}"


def _record_id(page_id: int | None, nonce: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{nonce}')}>"


def _field(text: str) -> str:
    """A header value: control characters and blanks percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    when = FIRST_CAPTURE + timedelta(seconds=max(0, page_id or 0) % (1 << 31))
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    body = HTTP % len(payload)
    if refers_to is None:
        body += payload
    else:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                  f"X-Refers-To-Page: {refers_to}"]
    lines.append(f"Content-Length: {len(body)}")
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(whole) + packer.flush()


def _filesystem(folder: str):
    """The file system of a shared folder and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: whom each page revisits."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    key = F.sha1(F.col("html").cast("binary")).alias("__sha")
    ids = written(rows.where(F.octet_length("html") >= least_bytes).select("page_id", key))
    first = ids.groupBy("__sha").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("__n")).where(
            "__n > 1 AND refers_to IS NOT NULL")
    later = join_counted(ids, first, ["__sha"], "__n", ids.count()).where(
        F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))
    ).select(F.col("page_id").alias("__pid"), F.col("__sha").alias("__psha"), "refers_to").distinct()
    sha = rows.select("*", key)
    return sha.join(later, F.col("page_id").eqNullSafe(F.col("__pid"))
                    & (F.col("__sha") == F.col("__psha")), "left").select(
                        "page_id", "url", "html", "refers_to")


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES,
                   least_bytes: int = 0) -> DataFrame:
    """Write all pages as ``.warc.gz`` files into ``folder``; returns their
    list (``archive, records``).  Only files in the list count: a task that is
    run again writes new ones, and the list, a written table, has the files
    of the run that ended well."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        out, name, size, records = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    filesystem.create_dir(root, recursive=True)
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = filesystem.open_output_stream(f"{root}/{name}", compression=None)
                payload = html.encode()
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                member = _record(page_id, url, payload, digest, refers_to)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    done.append((name, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)],
                                             names=["archive", "records"])

    rows = with_references(pages, least_bytes)
    return written(rows.mapInArrow(lean(work), "archive string, records long"))


def _members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(place, packed length, bytes) of each gzip member of a file."""
    place, rest = 0, b""
    while rest or (rest := stream.read(1 << 20)):
        unpacker, parts, packed = zlib.decompressobj(wbits=31), [], 0
        while not unpacker.eof:
            parts.append(unpacker.decompress(rest))
            packed += len(rest)
            if not unpacker.eof and not (rest := stream.read(1 << 20)):
                raise ValueError("the archive ends within a record")
        rest = unpacker.unused_data
        packed -= len(rest)
        yield place, packed, b"".join(parts)
        place += packed


def parse_record(whole: bytes) -> dict:
    """One record's columns of :data:`CAPTURES` but for its place; checks lengths
    and, of a response, the digest."""
    head, _, rest = whole.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    field = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/") or len(rest) != int(field["Content-Length"]) + 4:
        raise ValueError(f"no whole WARC record: {head[:80]!r}")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    response = field["WARC-Type"] == "response"
    if response and (len(payload) != size or base64.b32encode(
            hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload doesn't match its digest: {field['WARC-Record-ID']}")
    number = lambda name: int(field[name]) if name in field else None
    return {
        "page_id": number("X-Page-Id"), "urlkey": url_key(field.get("WARC-Target-URI")),
        "timestamp": re.sub(r"\D", "", field["WARC-Date"]), "payload_bytes": size,
        "payload_digest": digest, "record_type": field["WARC-Type"],
        "refers_to": number("X-Refers-To-Page"),
    }


_ORDER = ("urlkey", "timestamp", "page_id")


def _key(row: dict) -> tuple:
    return (row["urlkey"], row["timestamp"], row["page_id"] is None, row["page_id"] or 0)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The captures of the listed archives; those of a file come sorted."""
    schema = pa.schema([("page_id", pa.int64()), ("urlkey", pa.string()),
                        ("timestamp", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("archive", pa.string()), ("at", pa.int64()),
                        ("length", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                run = []
                with filesystem.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for at, length, whole in _members(stream):
                        run.append(parse_record(whole) | {
                            "archive": name, "at": at, "length": length})
                run.sort(key=_key)
                for i in range(0, len(run), 10_000):
                    yield pa.RecordBatch.from_pylist(run[i:i + 10_000], schema=schema)

    files = archives.count()
    return archives.select("archive").repartition(max(1, files), "archive").mapInArrow(
        lean(work), CAPTURES)


def merge_runs(runs: list[list]) -> Iterator:
    """Merge sorted runs of (key, row) by a loser tree: each inner node keeps
    the loser of its match, so the next winner costs one match a level."""
    k = len(runs)
    if not k:
        return
    sources = [iter(r) for r in runs]
    heads = [next(s, None) for s in sources]

    def beats(a: int, b: int) -> bool:
        """Whether leaf ``a`` goes before leaf ``b``; ended runs go last."""
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a][0], a) < (heads[b][0], b)

    losers = [0] * k  # node 1 is the root; leaf i hangs under node (i + k) // 2
    winner = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    top = winner[1] if k > 1 else 0
    while heads[top] is not None:
        yield heads[top][1]
        heads[top] = next(sources[top], None)
        node = (top + k) // 2
        while node:
            if beats(losers[node], top):
                losers[node], top = top, losers[node]
            node //= 2


def ordered_captures(captures: DataFrame) -> DataFrame:
    """``captures`` (a written table) in the order of URL key, timestamp and
    page_id over all partitions."""
    ranges = max(1, -(-captures.count() // RANGE_ROWS))
    ranges = max(ranges, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in batch.to_pylist():
                runs.setdefault(row["archive"], []).append((_key(row), row))
        for run in runs.values():  # slices of a run come in order, but for a re-run task's
            run.sort(key=lambda r: r[0])
        out = []
        for row in merge_runs([runs[name] for name in sorted(runs)]):
            out.append(row)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    key = [F.col("urlkey"), F.col("timestamp"), F.col("page_id").asc_nulls_last()]
    return captures.repartitionByRange(ranges, *key).mapInArrow(lean(work), CAPTURES)


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write all pages to archives, read them back, and return the captures
    in global order.  ``folder``: a shared folder for the archives."""
    folder = folder or f"{scratch_dir(pages.sparkSession)}/warc"
    archives = write_archives(pages, folder, least_bytes=least_bytes)
    return ordered_captures(written(read_archives(archives, folder)))
