"""WARC archives with a dictionary: one Zstandard frame a record, the dictionary in a leading skippable frame.

Every task trains a dictionary on records of the archive it writes, so archives are
written and read on their own and nothing passes through the driver. A record whose
payload equals that of another page is a revisit of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.shared import checkpointed, saved
from ticketloom.session import shared_path

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:page:{}>"

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 1000
SAMPLE_BYTES = 8 << 10
LEVEL = 3
READ_BYTES = 1 << 18
MANIFEST = "path string, n_records bigint, n_bytes bigint"
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def revisits(pages: DataFrame, id_column: str, url_column: str, html_column: str, least: int) -> DataFrame:
    """``(page_id, url, html, refers_to)``: the page that a record revisits, or NULL.

    Only digests of several pages are joined; their table is checkpointed, so that
    adaptive execution may split a digest that many pages share.
    """
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
    )
    digest = F.sha1(F.encode("html", "UTF-8"))
    shared = (
        rows.where(F.octet_length("html") >= least)
        .groupBy(digest.alias("digest"))
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "original")
    )
    found = rows.withColumn("digest", digest).join(checkpointed(shared), "digest", "left")
    other = ~F.col("page_id").eqNullSafe(F.col("original"))
    return found.select("page_id", "url", "html", F.when(other, F.col("original")).alias("refers_to"))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response with the payload, or a revisit with its length and digest alone."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": RECORD_ID.format("" if page_id is None else page_id),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else quote(url, safe="".join(map(chr, range(33, 127))).replace("%", "")),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Profile": None if refers_to is None else PROFILE,
        "WARC-Refers-To": None if refers_to is None else RECORD_ID.format(refers_to),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items() if v is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """Trained on at most SAMPLE_RECORDS records spread over the archive, SAMPLE_BYTES of each;
    too few to train on are the dictionary themselves."""
    step = max(1, len(records) // SAMPLE_RECORDS)
    samples = [r[:SAMPLE_BYTES] for r in records[::step]][:SAMPLE_RECORDS]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def archive(records: list[bytes]) -> bytes:
    trained = dictionary(records)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained))
    frames = [struct.pack("<II", SKIPPABLE_MAGIC, len(trained)), trained]
    frames += [compressor.compress(r) for r in records]
    return b"".join(frames)


def write_archives(rows: DataFrame, folder: str, date: str) -> DataFrame:
    """The manifest of the archives in ``folder``: only what it lists counts, so files of
    tasks that failed or ran twice do no harm. An archive holds about 32 MB of records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)

        def flush(records: list[bytes]) -> pa.RecordBatch:
            name, data = f"{uuid.uuid4().hex}.warc.zst", archive(records)
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            line = {"path": [name], "n_records": [len(records)], "n_bytes": [len(data)]}
            return pa.RecordBatch.from_pydict(line)

        records: list[bytes] = []
        size = 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns, strict=True):
                payload = html.as_buffer().to_pybytes()
                records.append(record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), date))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush(records)
                    records, size = [], 0
        if records:
            yield flush(records)

    return saved(rows.select("page_id", "url", "html", "refers_to").mapInArrow(write, MANIFEST), "warc-manifest")


def frames(source: pa.NativeFile) -> Iterator[bytes]:
    """The records of an archive, read in small portions."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("the archive does not begin with a dictionary")
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
    data = source.read(READ_BYTES)
    while data:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not data and not (data := source.read(READ_BYTES)):
                raise ValueError("the archive ends within a record")
            parts.append(frame.decompress(data))
            data = frame.unused_data
        yield b"".join(parts)
        data = data or source.read(READ_BYTES)


def _page_of(record_id: str | None) -> int | None:
    number = (record_id or "").removeprefix(RECORD_ID.split("{")[0]).removesuffix(">")
    return int(number) if number else None


def parse(data: bytes) -> tuple:
    """A row of RECORDS; a response's payload must have the length and digest it claims."""
    head, _, block = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.decode().rpartition("Content-Length: ")[2])
    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
    if kind == "response" and (length != len(payload) or digest != payload_digest(payload)):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    uri = headers.get("WARC-Target-URI")
    return (
        _page_of(headers["WARC-Record-ID"]),
        None if uri is None else unquote(uri),
        length,
        digest,
        kind,
        _page_of(headers.get("WARC-Refers-To")),
    )


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row of RECORDS for each record of the archives in the manifest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def rows(path: str) -> Iterable[tuple]:
            store, root = fs.FileSystem.from_uri(folder)
            with store.open_input_stream(f"{root}/{path}", compression=None) as source:
                yield from map(parse, frames(source))

        for batch in batches:
            for path in batch.column(0).to_pylist():
                columns = list(zip(*rows(path), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(read, RECORDS)


def archived_pages(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    folder: str | None = None,
) -> DataFrame:
    """Writes a record per page to archives in ``folder`` and returns them as read back.

    Of pages with equal payloads of at least ``least`` bytes that with the largest id
    is the response, the others revisit it; rows that repeat this id are responses
    too, and a NULL id revisits the largest one. A NULL html is the empty payload, a
    NULL url leaves its header out. Other columns are not archived; no page gives no
    archive. Without ``folder`` a new one in the cluster's shared folder is taken.
    """
    folder = folder or shared_path(pages.sparkSession, "warc")
    rows = revisits(pages, id_column, url_column, html_column, least)
    return read_archives(write_archives(rows, folder, date), folder)
