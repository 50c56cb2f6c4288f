"""WARC archives: writing, normalising whole-file gzip streams to one member a record, and reading back by offset.

Pages with equal payloads are stored once: the one with the largest page_id as a response, the others as revisit
records that name it. Archives are first written the way a careless crawler does, one gzip stream over a whole file.
The normaliser inflates such a stream once, in pieces of bounded size, cuts it into records by their Content-Length,
writes every record as its own gzip member, and writes a sidecar index with one line of page id, offset and length
for each. Readers then need only the index line and the bytes of one member.

Files go to the folder that all executors share, through a file system named by the folder's URI, under names that
no other attempt has; a file counts once the table of finished archives lists it. A repeated or speculative attempt
leaves an unlisted file behind, nothing else.

Defined cases: a null payload is an empty one. Payloads under `min_bytes` are always responses. Rows that share the
largest page_id of their payload are all responses; a null page_id is a revisit if any other row of the payload has
an id, and otherwise a response. Null URLs give no target line. Other columns of the input are not stored. An empty
table gives an empty result.
"""

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.llm.common import new_folder, table
from gaugeline.plans.scratch import materialize

ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 20
MANIFEST = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
READ = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string())]
    + [("refers_to", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]
)
Batches = Iterator[pa.RecordBatch]
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # base32


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary data: each five hex digits are four base32 digits."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _ALPHABET)


def with_record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, response_id): response_id is null for a response, else the page a revisit names."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    groups = rows.filter(F.col("n") >= min_bytes).groupBy("digest").agg(F.count("*").alias("_rows"), F.max("page_id").alias("_largest"))
    repeated = groups.filter("_rows > 1").select("digest", "_largest")
    joined = rows.join(repeated, "digest", "left")
    names = F.col("_largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_largest"))
    return joined.select("page_id", "url", "html", "digest", F.when(names, F.col("_largest")).alias("response_id"))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _file_system(folder: str):
    return arrow_fs.FileSystem.from_uri(folder)


def _record(page_id, url, html, digest, response_id) -> bytes:
    payload = b"" if html is None else html.encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if response_id is None else http
    name = "none" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response_id is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    lines += [f"WARC-Payload-Digest: sha1:{digest}"]
    if response_id is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += [f"WARC-Refers-To: <urn:page:{response_id}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, archive_bytes: int) -> Callable[[Batches], Batches]:
    def write(batches: Batches) -> Batches:
        system, root = _file_system(folder)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                record = _record(**row)
                out.write(gz.compress(record))
                records, size = records + 1, size + len(record)
                if size >= archive_bytes:
                    out.write(gz.flush())
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            done.append((name, records, size))
        yield _rows(done, MANIFEST)

    return write


def inflate(stream, piece: int = PIECE) -> Iterator[bytes]:
    """The bytes of a gzip file, whether it is one member or many, in pieces of at most `piece` bytes."""
    inflater = zlib.decompressobj(31)
    data = stream.read(piece)
    while data:
        got = inflater.decompress(data, piece)
        if got:
            yield got
        data = inflater.unconsumed_tail
        if inflater.eof:
            data = inflater.unused_data or stream.read(piece)
            if data:
                inflater = zlib.decompressobj(31)
        elif not data:
            data = stream.read(piece)
    if not inflater.eof:
        rest = inflater.flush()
        if rest:
            yield rest


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a WARC stream, cut by their Content-Length."""
    held = bytearray()
    need, pieces = None, iter(pieces)
    while True:
        if need is None and (at := held.find(b"\r\n\r\n")) >= 0:
            need = at + 4 + int(_headers(bytes(held[:at]))["content-length"]) + 4
        if need is not None and len(held) >= need:
            yield bytes(held[:need])
            del held[:need]
            need = None
            continue
        piece = next(pieces, None)
        if piece is None:
            if held:
                raise ValueError("the archive ends within a record")
            return
        held += piece


def _page(name: str) -> int | None:
    value = name.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def normalise_stream(source, target, index) -> tuple[int, int]:
    """Rewrite the gzip file `source` with one member a record to `target`, and its offsets to `index`."""
    offset = records = 0
    for record in split_records(inflate(source)):
        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = gz.compress(record) + gz.flush()
        target.write(member)
        name = _headers(record[: record.index(b"\r\n\r\n")])["warc-record-id"]
        index.write(f"{name}\t{offset}\t{len(member)}\n".encode())
        offset, records = offset + len(member), records + 1
    return records, offset


def _normaliser(folder: str, into: str) -> Callable[[Batches], Batches]:
    def normalise(batches: Batches) -> Batches:
        system, root = _file_system(folder)
        _, to = _file_system(into)
        for batch in batches:
            for archive in batch["archive"].to_pylist():
                name = f"{uuid.uuid4().hex}.warc.gz"
                with (
                    system.open_input_stream(f"{root}/{archive}", compression=None) as source,
                    system.open_output_stream(f"{to}/{name}", compression=None) as target,
                    system.open_output_stream(f"{to}/{name}.index") as index,
                ):
                    records, size = normalise_stream(source, target, index)
                yield _rows([(name, records, size)], MANIFEST)

    return normalise


def read_member(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of one record."""
    record = zlib.decompress(member, 31)
    at = record.index(b"\r\n\r\n")
    headers = _headers(record[:at])
    block = record[at + 4 : at + 4 + int(headers["content-length"])]
    end = block.index(b"\r\n\r\n")
    return headers, _headers(block[:end]), block[end + 4 :]


def _reader(folder: str) -> Callable[[Batches], Batches]:
    def read(batches: Batches) -> Batches:
        system, root = _file_system(folder)
        for batch in batches:
            for archive in batch["archive"].to_pylist():
                with system.open_input_stream(f"{root}/{archive}.index") as f:
                    lines = [x.split("\t") for x in io.TextIOWrapper(f, encoding="utf-8")]
                rows = []
                with system.open_input_file(f"{root}/{archive}") as f:
                    for _, offset, length in lines:
                        f.seek(int(offset))
                        headers, http, payload = read_member(f.read(int(length)))
                        kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{archive} at {offset}: the payload does not have its digest")
                        size = len(payload) if kind == "response" else int(http["content-length"])
                        refers = _page(headers["warc-refers-to"]) if kind == "revisit" else None
                        rows.append((_page(headers["warc-record-id"]), size, digest, kind, refers, int(offset), int(length)))
                yield _rows(rows, READ)

    return read


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in schema)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) as gzip streams under `folder`; returns the archives as a written table."""
    _make_folder(pages.sparkSession, folder)
    rows = with_record_types(pages, min_bytes)
    return materialize(rows.mapInArrow(_writer(folder, archive_bytes), _ddl(MANIFEST)), "warc-written")


def normalise_archives(archives: DataFrame, folder: str, into: str) -> DataFrame:
    """Rewrite `archives` of `folder` with one gzip member a record and an index beside each; returns the new archives."""
    _make_folder(archives.sparkSession, into)
    spread = archives.repartition(max(1, archives.count()), "archive")
    return materialize(spread.mapInArrow(_normaliser(folder, into), _ddl(MANIFEST)), "warc-normal")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    spread = archives.repartition(max(1, archives.count()), "archive")
    return spread.mapInArrow(_reader(folder), _ddl(READ))


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def _uri(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri if uri.startswith("file://") else uri.replace("file:", "file://", 1)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    root = _uri(spark, new_folder(spark, "warc"))
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    raw, members = f"{root}/raw", f"{root}/members"
    archives = normalise_archives(write_archives(pages, raw), raw, members)
    return read_archives(archives, members).drop("offset", "length")


def _sql() -> str:
    letters = [f"substr('{_ALPHABET}', ((('0x' || substr(h, {5 * i + 1}, 5))::int >> {s}) & 31) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0)]
    return f"""
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
b as (select page_id, strlen(body) as payload_bytes, {" || ".join(letters)} as payload_digest from p),
g as (select *, max(page_id) over (partition by payload_digest) as top from b)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id = top then null else top end as refers_to
from g
"""


SQL = _sql()
