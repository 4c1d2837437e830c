"""Web archives: records compressed one by one with a Zstandard dictionary made from the archive's records.

An archive starts with the dictionary in a skippable frame; every record is a frame of its own after it.
Tasks write archives of a bounded size to the shared folder, under names that a second attempt doesn't
share, and return where; only what committed tasks return is read back. Payloads equal to a larger page_id's
are written as revisits of it.

Defined results: a null html is an empty payload; a null url is about:blank; control characters in a url are
percent-encoded; rows that repeat the response's page_id and payload are responses too; a null page_id is
never the response while another row has the payload; pages of any size are records of their own; extra
columns are not looked at; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import small, store
from wavelane.session import shared_dir

DICTIONARY_FRAME = 0x184D2A5D  # fixed value of the format: magic number of the frame that holds a dictionary
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 48 << 10
SAMPLE_BYTES = 1 << 20
_IDS = 0x7A1D5C9E3B604F8ABC1D << 48  # record ids: a fixed upper half, the page_id in the lower
_HIGH = (_IDS >> 64) & 0xFFFFFFFFFFFFFFFF


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_id(page_id: int | None) -> str:
    number = uuid.UUID(int=_HIGH << 64 | (page_id & 0xFFFFFFFFFFFFFFFF)) if page_id is not None else uuid.UUID(int=(_HIGH ^ 1) << 64)
    return f"<urn:uuid:{number}>"


def page_of(record: str) -> int | None:
    number = uuid.UUID(record.strip("<>").rpartition(":")[2]).int
    if number >> 64 != _HIGH:
        return None
    low = number & 0xFFFFFFFFFFFFFFFF
    return low - (1 << 64) if low >> 63 else low


def build_record(row: dict, date: str) -> bytes:
    """One WARC record of a page: its payload behind an HTTP head, or the head alone for a revisit."""
    payload = (row["html"] or "").encode("utf-8", "replace")
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or "about:blank")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row["page_id"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{base32(row['payload_sha1'])}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(row["refers_to"])),
            ("X-Payload-Length", str(len(payload))),
        ]
    body = http if revisit else http + payload
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(body)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def train_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """From records evenly spread over the archive, up to a bound of bytes; few or tiny records are taken as
    they are, as a dictionary of raw content."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[: SAMPLE_BYTES // 8] for r in records[::step]]
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 10))
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8)
    except (zstandard.ZstdError, ValueError):
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def build_archive(records: list[bytes], level: int = 3) -> bytes:
    dictionary = train_dictionary(records)
    data = dictionary.as_bytes()
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
    frames = [struct.pack("<II", DICTIONARY_FRAME, len(data)), data]
    info = b"software: wavelane\r\nformat: WARC File Format 1.1\r\n"
    first = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"
    frames += [compressor.compress(r) for r in [first, *records]]
    return b"".join(frames)


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of every record. Frames are fed in slices, as only decoding finds where one ends."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive has no dictionary frame")
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    at, view = 8 + size, memoryview(data)
    while at < len(data):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof and at < len(data):
            piece = view[at : at + 4096]
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def _file_system(folder: str):
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, payload_sha1 (hexadecimal), record_type, refers_to.

    Digests are counted by themselves; only those that repeat are kept, a short row each. If there are few of
    them, as counted, they go to the pages, and payloads stay where they lie; else the join is a plain one that
    adaptive execution splits where a digest is hot."""
    html = F.coalesce("html", F.lit(""))
    known = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha1(html).alias("payload_sha1"))
    counted = known.groupBy("payload_sha1").agg(F.count(F.lit(1)).alias("pages"), F.max("page_id").alias("head"))
    heads = store(counted.where("pages > 1").select("payload_sha1", "head"), "warc-repeats")
    joined = known.join(small(heads, 100_000), "payload_sha1", "left")
    revisits = (F.octet_length("html") >= min_bytes) & F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return joined.select(
        "page_id",
        "url",
        "html",
        "payload_sha1",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("head")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the planned records below ``folder`` and return the stored list of archives: path, records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        held: list[bytes] = []
        written: list[tuple[str, int]] = []

        def close() -> None:
            path = f"{root}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(written)}.warc.zst"
            with files.open_output_stream(path, compression=None) as out:
                out.write(build_archive(held))
            written.append((path, len(held)))
            held.clear()

        size = 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                for row in batch.slice(begin, 64).to_pylist():
                    held.append(build_record(row, date))
                    size += len(held[-1])
                    if size >= ARCHIVE_BYTES:
                        close()
                        size = 0
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in written], pa.string()), pa.array([w[1] for w in written], pa.int64())], names=["path", "records"])

    return store(records.mapInArrow(write, "path string, records long"), "warc-list")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The pages' records of the listed archives. Digest and size of a response come from its payload."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _file_system(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input_stream(path, compression=None) as source:
                    data = source.read()
                out = []
                for fields, block in read_archive(data):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    page_id, stated = page_of(fields["WARC-Record-ID"]), fields["WARC-Payload-Digest"].partition(":")[2]
                    if kind == "revisit":
                        out.append((page_id, int(fields["X-Payload-Length"]), stated, kind, page_of(fields["WARC-Refers-To"])))
                    else:
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest != stated:
                            raise ValueError(f"payload of page {page_id} in {path} differs from its digest")
                        out.append((page_id, len(payload), digest, kind, None))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    # A task for each archive: the list is so short that it would be put into one partition otherwise.
    return archives.repartition(max(1, archives.count())).mapInArrow(rows, RECORD)


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, then read every record back from them."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages), folder), folder)
