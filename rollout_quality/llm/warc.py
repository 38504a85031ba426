"""WARC archives: a writer with revisit records, and a salvage reader.

The reader checks every record (version line, headers, length, end mark, block digest). Where a check fails it
searches for the next gzip member or version line that begins a valid record, goes on from there, and reports the
bytes in between as a quarantined gap; inside a gzip member of many records it does the same.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollout_quality.llm.common import ready, scratch, store

REVISIT_BYTES = 1000
FILE_BYTES = 64_000_000
CHUNK = 1 << 15
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
# The record types of WARC 1.1.
KINDS = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
_MAGIC = b"\x1f\x8b\x08"
# The digests that are checked, as hashlib names them.
ALGORITHMS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
_HTTP_END = re.compile(rb"\r?\n\r?\n")
_CHUNKED = re.compile(rb"\ntransfer-encoding:[^\n]*\bchunked\b", re.I)
_CHUNK_SIZE = re.compile(rb"([0-9a-f]+)[^\n]*\n", re.I)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
SALVAGED = "file string, at long, until long, kind string, page_id long, url string, digest string, bytes long, refers_to long, payload binary, note string"


def _sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _checked(digest: str, block: bytes) -> bool | None:
    """Whether `block` has the digest "algorithm:value" (base32, hex or base64); None if the algorithm is unknown."""
    name, colon, _ = digest.partition(":")
    name = name.strip().lower().replace("-", "").replace("_", "")
    if not colon or name not in ALGORITHMS:
        return None
    return _bytes(digest) == hashlib.new(name, block).digest()


def _bytes(digest: str) -> bytes | None:
    """The value of a digest of a known algorithm; None if no encoding gives its length."""
    name, _, value = digest.partition(":")
    size, value = hashlib.new(name.strip().lower().replace("-", "").replace("_", "")).digest_size, value.strip()
    for decode in (bytes.fromhex, lambda v: base64.b32decode(v.upper() + "=" * (-len(v) % 8)),
                   lambda v: base64.b64decode(v + "=" * (-len(v) % 4), altchars=b"-_" if set(v) & set("-_") else None, validate=True)):
        try:
            got = decode(value.rstrip("="))
        except ValueError:
            continue
        if len(got) == size:
            return got
    return None


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    """What the payload digest covers: of an HTTP message what follows its header, else the whole block."""
    if headers.get("content-type", "").split(";")[0].strip().lower() != "application/http":
        return block
    end = _HTTP_END.search(block)
    return block[end.end() :] if end else b""


def _dechunked(headers: dict[str, str], block: bytes, payload: bytes) -> bytes | None:
    """The payload without the chunks of its transfer; None if it has none or they are damaged."""
    head = block[: len(block) - len(payload)]
    if head == b"" or not _CHUNKED.search(head):
        return None
    parts, at = [], 0
    while size := _CHUNK_SIZE.match(payload, at):
        n, at = int(size[1], 16), size.end()
        if not n:
            return b"".join(parts)
        if len(payload) < at + n:
            return None
        parts.append(payload[at : at + n])
        at += n + (2 if payload[at + n : at + n + 2] == b"\r\n" else 1)
    return None


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(kind: str, page_id: int | None, url: str | None, digest: str, size: int, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record. `digest` and `size` are of the full payload, also where a revisit leaves it out."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: {digest}",
        f"WARC-Payload-Length: {size}",
        f"WARC-Block-Digest: {_sha1(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_CONTROL.sub(lambda m: f'%{ord(m[0]):02X}', url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Found:
    """A record (kind, headers, block) or a gap (kind "gap", note) at bytes at..until of an archive."""

    at: int
    until: int
    kind: str
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    note: str = ""


def _parse(data: bytes, at: int) -> tuple[Found | None, str]:
    """The record at `at`, or None and the check that failed."""
    if not _VERSION.match(data, at):
        return None, "version"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None, "headers"
    headers = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, "headers"
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdecimal() or headers.get("warc-type") not in KINDS:
        return None, "headers"
    start = end + 4
    stop = start + int(headers["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        return None, "length"
    block = data[start:stop]
    right = _checked(headers["warc-block-digest"], block) if "warc-block-digest" in headers else True
    if right is False:
        return None, "digest"
    return Found(at, stop + 4, headers["warc-type"], headers, block, "" if right else "block digest unchecked"), ""


def _inflate(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """The content of the gzip member at `at`, where it ends, and whether its own checks hold; if they do not, the
    content up to the damage and where that shows."""
    opened, parts, fed = zlib.decompressobj(31), [], at
    while not opened.eof and fed < len(data):
        before, chunk = opened.copy(), data[fed : fed + CHUNK]
        try:
            parts.append(opened.decompress(chunk))
        except zlib.error:
            # What the chunk gives before its damaged byte.
            for k in range(len(chunk)):
                try:
                    parts.append(before.decompress(chunk[k : k + 1]))
                except zlib.error:
                    return b"".join(parts), fed + k, False
            return b"".join(parts), fed + len(chunk), False
        fed += len(chunk)
    return b"".join(parts), fed - len(opened.unused_data), opened.eof


def _member(data: bytes, at: int) -> tuple[list[Found], int | None, str]:
    """The records of the gzip member at `at` with the gaps between them, where it ends (None if its own checks
    fail), and the first check that failed. No list without a record.

    Of a member that is cut off or damaged the records before the damage are returned, and those after it that can
    still be read; their note says so. Where its checksum fails, only blocks with a digest of their own count.
    """
    content, until, whole = _inflate(data, at)
    note, failed = "" if content else "empty member", "" if whole else "member"
    cut = not whole and until == len(data)
    found, inner, bad, why = [], 0, None, ""
    while inner < len(content):
        one, note = _parse(content, inner)
        if one is not None and failed and not cut and (one.note or "warc-block-digest" not in one.headers):
            one, note = None, "member"
        if one is None:
            if bad is None:
                bad, why = inner, note
            version = _VERSION.search(content, inner + 1)
            inner = version.start() if version else len(content)
            continue
        if bad is not None:
            found.append(Found(at, until, "gap", note=why))
            bad = None
        found.append(Found(at, until, one.kind, one.headers, one.block, failed or one.note))
        inner = one.until
    if bad is not None and whole:
        found.append(Found(at, until, "gap", note=why))
    records = any(f.kind != "gap" for f in found)
    return found if records else [], until if whole else None, failed or why or note


def salvage(data: bytes) -> Iterator[Found]:
    """All valid records of an archive and the gaps between them, in order. Empty archive: nothing.

    A record or gap inside a gzip member has the member's bytes. After the records of a damaged member a gap
    follows that begins with the member.
    """
    at, bad, why = 0, None, ""
    while at < len(data):
        if data.startswith(_MAGIC, at):
            found, until, note = _member(data, at)
        else:
            one, note = _parse(data, at)
            found, until = ([one], one.until) if one else ([], None)
        if found:
            if bad is not None:
                yield Found(bad, at, "gap", note=why)
                bad = None
            yield from found
            if until is not None:
                at = until
                continue
        if bad is None:
            bad, why = at, note
        version = _VERSION.search(data, at + 1)
        places = [p for p in (data.find(_MAGIC, at + 1), version.start() if version else -1) if p >= 0]
        at = min(places, default=len(data))
    if bad is not None:
        yield Found(bad, len(data), "gap", note=why)


def _roles(pages: DataFrame, revisit_bytes: int) -> DataFrame:
    """Every page with its digests and, for a copy, the page that holds the payload.

    Equal payloads are found by SHA-256 and length of the whole payload; only payloads that repeat are joined.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"bytes": F.octet_length("payload").cast("long"), "sha": F.unhex(F.sha2("payload", 256))}
    )
    repeated = rows.filter(F.col("bytes") >= revisit_bytes).groupBy("sha", "bytes")
    repeated = repeated.agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = store(repeated.drop("n"), "repeated-payloads")
    revisit = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id"))
    return (
        rows.join(repeated, ["sha", "bytes"], "left")
        .withColumn("refers_to", F.when(revisit, F.col("holder")))
        .select("page_id", "url", "bytes", F.sha1("payload").alias("sha1"), "refers_to",
                F.when(~revisit, F.col("payload")).alias("payload"))
    )


def write_archives(
    pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES, compress: bool = True
) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html) under `folder`, which all executors share; returns
    the stored list of files (file, records, size).

    Of equal payloads of at least `revisit_bytes` the rows with the largest page_id are responses, others revisit
    it; all others are responses. Null html: empty payload. Null url: no target header; control characters and
    spaces of a url are percent-encoded. A null page_id is the smallest. Every task writes files of its own under a
    temporary name and renames them, so a repeated task replaces what a lost one left. Empty table: no files.
    """
    ready(pages.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        context = TaskContext.get()
        disk, base = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        disk.create_dir(base, recursive=True)
        part, mark = context.partitionId(), context.taskAttemptId()
        stream, name, held, number, done = None, "", 0, 0, []

        def close() -> None:
            size = stream.tell()
            stream.close()
            disk.move(f"{base}/_{mark}-{name}", f"{base}/{name}")
            done.append((f"{base}/{name}", held, size))

        for frame in frames:
            for page_id, url, size, sha1, refers_to, payload in frame.itertuples(index=False):
                if stream is None:
                    name = f"part-{part:06d}-{number:06d}.warc" + ".gz" * compress
                    stream, held, number = disk.open_output_stream(f"{base}/_{mark}-{name}", compression=None), 0, number + 1
                page_id = None if page_id is None or page_id != page_id else int(page_id)
                refers = None if refers_to is None or refers_to != refers_to else int(refers_to)
                digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
                kind = "response" if payload is not None else "revisit"
                data = record(kind, page_id, url, digest, size, payload or b"", refers)
                stream.write(member(data) if compress else data)
                held += 1
                if stream.tell() >= file_bytes:
                    close()
                    stream = None
            yield pd.DataFrame(columns=["file", "records", "size"])
        if stream is not None:
            close()
        yield pd.DataFrame(done, columns=["file", "records", "size"])

    # Large ids do not survive a detour through floating point, which nulls would cause.
    rows = _roles(pages, revisit_bytes).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return store(rows.mapInPandas(run, "file string, records long, size long"), "archives")


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records and gaps of the archives under `folder`: file, at, until, kind (response, revisit, gap, ...),
    page_id, url, digest (bare hex) and bytes of the full payload, refers_to, payload, note (failed check).

    The payload of an HTTP message is what follows its header. Digests are checked by their named algorithm, in
    base32, hex or base64; one of an unknown algorithm stays as written, and the note says that it is unchecked. A
    response whose payload does not fit its payload digest, with or without the chunks of its transfer, is a gap,
    too. Headers that are missing are null.
    """
    def page(uri: str | None) -> int | None:
        got = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
        return int(got[1]) if got else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SALVAGED.split(", ")]

        def out(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names, dtype=object)

        for frame in frames:
            for file, data in zip(frame["path"], frame["content"]):
                rows, held = [], 0
                for one in salvage(data):
                    h, note = one.headers, one.note
                    digest, kind, payload = h.get("warc-payload-digest"), one.kind, b""
                    right, bare = True, digest
                    if digest is not None:
                        right = _checked(digest, b"")
                        value = None if right is None else _bytes(digest)
                        if value is not None:
                            bare = value.hex()
                        elif right is not None:
                            bare, kind, note = None, "gap", "payload digest"
                    if kind == "response":
                        payload = _payload(h, one.block)
                        if digest is not None:
                            right = _checked(digest, payload)
                        if right is False:
                            plain = _dechunked(h, one.block, payload)
                            right = plain is not None and _checked(digest, plain)
                            payload = plain if right else payload
                        if right is False:
                            kind, note = "gap", "payload digest"
                    if right is None and kind != "gap":
                        note = "; ".join(x for x in (note, "payload digest unchecked") if x)
                    size = h.get("warc-payload-length") or (str(len(payload)) if kind == "response" else "")
                    rows.append(
                        (file, one.at, one.until, kind, page(h.get("warc-record-id")), h.get("warc-target-uri"), bare,
                         int(size) if size.isdecimal() else None, page(h.get("warc-refers-to")),
                         payload if payloads and kind == "response" else None, note or None)
                    )
                    held += len(one.block)
                    if held > 1 << 24:
                        yield out(rows)
                        rows, held = [], 0
                yield out(rows)

    ready(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,warc.gz}").load(folder)
    return files.select("path", "content").mapInPandas(run, SALVAGED)


def round_trip(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    if write_archives(pages, folder, revisit_bytes).isEmpty():
        return spark.createDataFrame([], SALVAGED)
    return read_archives(spark, folder, payloads=False)
