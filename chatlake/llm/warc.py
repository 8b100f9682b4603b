"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: pages with equal payloads are found by SHA-256 (counted map-side; very
frequent payloads are joined through a bounded broadcast). The page with the
smallest id becomes a ``response`` record, the others ``revisit`` records that
refer to it. Each task rolls its records into archives of at most
``ARCHIVE_BYTES`` before compression; every archive carries its own dictionary,
trained on its first records. An archive counts only once its name stands in
the manifest, which Spark writes when all tasks are done, so a task that ran
twice or died half-way leaves no records.

Reading: the manifest's names are dealt to tasks, which open the archives (a folder
without a manifest is listed and read by ``binaryFile``); each is walked
frame by frame. Version line, header fields, ``Content-Length``, the closing
blank lines and the payload digest are validated, and a record or archive that
fails is reported in ``error`` instead of ending the job. A revisit takes its
payload's length from the response that it refers to.

Archives are written with Arrow's file systems, so the scratch folder must be on
one that Arrow reaches (local or mounted, s3, gs, hdfs with its client library).

Defined results: a null html is an empty payload; a null url leaves out
``WARC-Target-URI``; line breaks in a url are percent-encoded. A null page_id
comes after all others. Of repeated rows with one page_id and payload one is the
response. An empty table gives no archive and an empty result. A page larger
than an archive gets one of its own. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm.common import join_skewed, stored, text_or_empty
from chatlake.session import scratch_path

ARCHIVE_BYTES = 16 << 20
#: Archives that one reading task opens, in bytes, once there are more than cores.
TASK_BYTES = 64 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
DATE = "2024-01-01T00:00:00Z"

SKIPPABLE = 0x184D2A5D
DICTIONARY = b"\x37\xa4\x30\xec"
FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

READ_SCHEMA = (
    "archive string, record_id string, record_type string, page_id string, url string, refers_to_id string, "
    "payload_digest string, payload_bytes long, payload binary, error string"
)


# ---- one record ---------------------------------------------------------------


def record_id(page_id: str | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{row}')}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: str | None, row: int, url: str | None, payload: bytes, response: tuple | None) -> bytes:
    """A response record or, with the (page_id, row) of a ``response``, a revisit record."""
    head = (HTTP % len(payload)).encode()
    block = head if response else head + payload
    fields = [
        ("WARC-Type", "revisit" if response else "response"),
        ("WARC-Record-ID", record_id(page_id, row)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", page_id))
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if response:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*response))]
    header = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + header.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The parts of one record; raises ValueError on a bad header, length or digest."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1") or not blank:
        raise ValueError("no WARC version line or header")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line!r}")
        fields[name.strip().lower()] = value.strip()
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(fields):
        raise ValueError(f"header without {', '.join(sorted(missing))}")
    if not fields["content-length"].isdigit():
        raise ValueError("bad Content-Length")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {n}, but the block has {len(rest) - 4}")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    out = {
        "record_id": fields["warc-record-id"],
        "record_type": fields["warc-type"],
        "page_id": fields.get("x-page-id"),
        "url": fields.get("warc-target-uri"),
        "refers_to_id": fields.get("warc-refers-to"),
        "payload_digest": digest,
    }
    if out["record_type"] == "response":
        payload = rest[:n].partition(b"\r\n\r\n")[2]
        if digest and digest != payload_digest(payload):
            raise ValueError("payload digest differs")
        out |= {"payload": payload, "payload_bytes": len(payload)}
    elif out["record_type"] == "revisit" and not out["refers_to_id"]:
        raise ValueError("revisit without WARC-Refers-To")
    return out


# ---- one archive --------------------------------------------------------------


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the first ``SAMPLE_BYTES`` of records; of too few, their bytes themselves."""
    sample, size = [], 0
    for r in records:
        sample.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8)
    except zstandard.ZstdError:
        raw = b"".join(sample)[:DICTIONARY_BYTES]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int = 3) -> bytes:
    """The archive of some records (at least one)."""
    known = dictionary(records)
    body = known.as_bytes()
    frames = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
    return struct.pack("<II", SKIPPABLE, len(body)) + body + b"".join(frames.compress(r) for r in records)


def load_dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame, if there is one, and where the records begin."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        return None, 0
    size = struct.unpack_from("<I", data, 4)[0]
    if 8 + size > len(data):
        raise ValueError("cut dictionary")
    body = bytes(data[8 : 8 + size])
    if body[:4] == FRAME:  # the dictionary itself may be compressed
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    kind = zstandard.DICT_TYPE_FULLDICT if body[:4] == DICTIONARY else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(body, dict_type=kind), 8 + size


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends: its header, then block by block, then its checksum."""
    if bytes(data[at : at + 4]) != FRAME:
        raise ValueError("no frame")
    checksum = zstandard.get_frame_parameters(bytes(data[at : at + 18])).has_checksum
    end, last = at + zstandard.frame_header_size(bytes(data[at : at + 18])), False
    while not last:
        if end + 3 > len(data):
            raise ValueError("cut frame")
        block = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        end += 3 + (1 if kind == 1 else size)
    end += 4 * checksum
    if end > len(data):
        raise ValueError("cut frame")
    return end


def read_archive(content: bytes) -> Iterator[dict]:
    """The records of one archive; an ``error`` entry for what can't be read."""
    data = memoryview(content)
    try:
        known, at = load_dictionary(data)
    except (ValueError, zstandard.ZstdError) as e:
        yield {"error": str(e)}
        return
    frames = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as e:  # the next frame can't be found
            yield {"error": f"at byte {at}: {e}"}
            return
        try:
            yield parse_record(frames.decompressobj().decompress(data[at:end]))
        except (ValueError, zstandard.ZstdError) as e:
            yield {"error": f"at byte {at}: {e}"}
        at = end


# ---- Spark --------------------------------------------------------------------


def plan_records(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Every page with the (page_id, row) of the response that it revisits; null for responses."""
    html = text_or_empty("html")
    rows = stored(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("page_id").cast("string").alias("page_id"),
            F.col("url").cast("string").alias("url"),
            html.alias("html"),
            F.unhex(F.sha2(html, 256)).alias("key"),
            F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id").cast("long").alias("id")).alias("first"),
        ),
        "pages",
    )
    groups = rows.groupBy("key").agg(
        F.min(F.struct("first", "row", "page_id")).alias("response"), F.count(F.lit(1)).alias("n")
    )
    joined = join_skewed(rows, groups, "key", "n", rows.count())
    revisit = (F.octet_length("html") >= min_payload) & (F.col("row") != F.col("response.row"))
    return joined.select(
        "row",
        "page_id",
        "url",
        "html",
        F.when(revisit, F.col("response.row")).alias("response_row"),
        F.when(revisit, F.col("response.page_id")).alias("response_page"),
    )


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives to ``folder``; returns the stored manifest (name, records, bytes)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        pending: list[bytes] = []

        def roll() -> pd.DataFrame:
            body, name = archive(pending), f"{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(body)
            return pd.DataFrame([(name, len(pending), len(body))], columns=["name", "records", "bytes"])

        files.create_dir(base, recursive=True)
        size = 0
        for batch in batches:
            for row, page, url, html, to_row, to_page in batch.itertuples(index=False, name=None):
                response = None if to_row is None else (to_page, int(to_row))
                one = record(page, int(row), url, html.encode(), response)
                if pending and size + len(one) > archive_bytes:
                    yield roll()
                    pending, size = [], 0
                pending.append(one)
                size += len(one)
        if pending:
            yield roll()

    texts = planned.withColumns({c: F.col(c).cast("string") for c in ("row", "response_row")})
    return stored(texts.mapInPandas(write, "name string, records long, bytes long"), "warc_manifest")


def _contents(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["name"]:
                with files.open_input_stream(f"{base}/{name}", compression=None) as source:
                    yield pd.DataFrame({"name": [name], "content": [source.read()]})

    return read


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """All records of the archives in ``folder``, or of those that ``manifest`` names.

    The names are dealt to tasks, which open the archives themselves; the folder isn't listed then.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    if manifest is None:
        found = spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.warc.zst").load(folder)
        found = found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    else:
        size = manifest.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
        tasks = max(1, min(size.n, spark.sparkContext.defaultParallelism), (size.bytes or 0) // TASK_BYTES)
        found = manifest.select("name").repartition(tasks).mapInPandas(_contents(folder), "name string, content binary")
    columns = [c.split()[0] for c in READ_SCHEMA.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in batch.itertuples(index=False, name=None):
                rows = []
                for entry in read_archive(content):
                    rows.append({**dict.fromkeys(columns), **entry, "archive": name})
                    if len(rows) == 256:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return found.mapInPandas(read, READ_SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with the page and payload length of the response that they revisit."""
    responses = records.where(F.col("record_type") == "response")
    revisits = records.where(F.col("record_type") == "revisit")
    counts = revisits.groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("n"))
    targets = responses.select(
        F.col("record_id").alias("refers_to_id"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("full_bytes"),
    ).join(counts, "refers_to_id")
    resolved = join_skewed(revisits, targets, "refers_to_id", "n", revisits.count())
    columns = ["page_id", "payload_digest", "record_type"]
    return resolved.select(*columns, F.col("full_bytes").alias("payload_bytes"), "refers_to").unionByName(
        responses.select(*columns, "payload_bytes", F.lit(None).cast("string").alias("refers_to"))
    )


def roundtrip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write ``pages`` to archives, read them back, one row per record."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = write_archives(plan_records(pages, min_payload), folder)
    if manifest.isEmpty():
        records = spark.createDataFrame([], READ_SCHEMA)
    else:
        records = read_archives(spark, folder, manifest)
    heads = stored(records.drop("payload"), "warc_records")
    bad = heads.where(F.col("error").isNotNull()).select("archive", "error").limit(3).collect()
    if bad:
        raise ValueError(f"archives can't be read back: {bad}")
    return resolve_revisits(heads)
