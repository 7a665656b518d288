"""Web archives of one Zstandard frame per record, with a shared dictionary in the leading skippable frame.

**Archive.** A file begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, plain or itself
compressed. Each record is one further frame. Other skippable frames are passed over.

**Writing.** Equal payloads of at least ``MIN_REVISIT`` bytes are found by digest: the page with the least id is a
``response``, the others are ``revisit`` records without the payload that refer to it. Only digests are grouped and the
group's least id joined back, by a broadcast of measured size or with the hot digests salted, so that a group with a
third of all pages is never in one task. Tasks compress their rows to frames, and Spark's text sink
writes these bytes: rows are separated by an empty skippable frame, so the file is a valid archive on any
file system that Spark reaches, and a repeated task replaces its file. The dictionary is trained once on a bounded sample of
``SAMPLE`` pages of at most ``SAMPLE_BYTES`` bytes, picked by a hash.

**Reading.** A task reads its archives one by one: it loads the dictionary, finds the end of each frame from the
headers of its blocks, decodes the frame and checks it: version line, header lines, mandatory fields, the
length of the block against ``Content-Length``, the two line ends behind it, that nothing follows in the frame,
the HTTP message's length and the payload's digest. A faulty record is a row with its ``problem``; a file whose frames cannot be followed any
further ends with such a row. Archives are read whole, so they should be bounded: written ones hold about ``ARCHIVE_BYTES`` of payload.

Results by case: null and empty payloads are empty ones and each a response; payloads below the limit are all
responses; of repeated rows of the least id each is a response; null ids come after all ids, and where a group has no
id at all, each of its rows is a response; line ends and other controls in a URL are percent-encoded, a null URL
becomes a URN of the page; an empty table gives no records; other columns, whatever their names, are not read; a payload
of any length is one record.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators.joins import enrich

MIN_REVISIT = 100
SAMPLE = 1_000
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 110 << 10
ARCHIVE_BYTES = 64 << 20
LEVEL = 3

# Magic numbers of frames, the profile of revisits, mandatory header fields.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
MANDATORY = ("WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length")

#: An empty skippable frame; all its bytes are ASCII.
SEPARATOR = (SKIPPABLE_MAGIC.to_bytes(4, "little") + bytes(4)).decode("ascii")

PAGE_ID = "X-Page-ID"

RECORDS = (
    "archive string, place long, record_type string, record_id string, headers map<string,string>, "
    "http_headers map<string,string>, payload binary, payload_bytes long, payload_digest string, problem string"
)


# ---- pages to records


def payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest): the payload is the text in UTF-8, null is empty."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"))
    return rows.withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}
    )


def with_first(rows: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """The payloads with ``first_id``, the least id of the same payload, where that is another page's."""
    large = rows.where(F.col("payload_bytes") >= min_bytes)
    groups = large.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    groups = groups.where("n > 1 and first_id is not null").select("payload_digest", "first_id")
    joined = enrich(rows, groups, "payload_digest", how="left")
    other = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.withColumn("first_id", F.when(other, F.col("first_id")))


def train_dictionary(rows: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A compression dictionary from a bounded sample of payloads; empty where there is too little to learn from."""
    own = rows.where(F.col("payload_bytes").between(1, sample_bytes)).select("payload_digest", "payload")
    chosen = own.select("payload_digest").distinct().orderBy("payload_digest").limit(sample)
    own = own.join(F.broadcast(chosen), "payload_digest", "left_semi")
    picked = own.groupBy("payload_digest").agg(F.any_value("payload").alias("payload")).orderBy("payload_digest").collect()
    samples = [bytes(row["payload"]) for row in picked]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:  # samples too alike or too few
        return b""


def record_id(page_id: int | None, digest: str) -> str:
    """The same for repeated rows: a name-based identifier of the page and its payload."""
    h = hashlib.sha256(f"{page_id}:{digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def _uri(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:x-page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, first_id: int | None, date: str
) -> bytes:
    """One record: an HTTP response, or a revisit of ``first_id`` that keeps the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = first_id is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url, page_id)}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if page_id is not None:
        lines.append(f"{PAGE_ID}: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(first_id, digest)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = LEVEL,
) -> None:
    """Write a record per page to archives of about ``archive_bytes`` of payload under a new folder."""
    rows = payloads(pages, id_col, url_col, html_col)
    parts = rows.groupBy(F.spark_partition_id()).agg(F.sum("payload_bytes").alias("n"))
    total, most = (n or 0 for n in parts.agg(F.sum("n"), F.max("n")).first())
    dictionary = train_dictionary(rows)
    date = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    records = with_first(rows, min_bytes).select("page_id", "url", "payload", "payload_digest", "first_id")
    if most > 2 * archive_bytes:
        records = records.repartition(-(-total // archive_bytes))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=level, dict_data=learned, write_checksum=True, write_content_size=True)
        head = DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary
        for batch in batches:
            frames = [head] if head else []
            head = b""
            for row in zip(*(batch.column(i) for i in range(5)), strict=True):
                page_id, url, payload, digest, first_id = (value.as_py() for value in row)
                frames.append(writer.compress(record(page_id, url, payload, digest, first_id, date)))
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])

    frames = records.mapInArrow(over, "value binary")
    # Bytes pass through the text sink as they are.
    frames.select(F.col("value").cast("string")).write.option("lineSep", SEPARATOR).text(folder)


# ---- archives to records


class Broken(ValueError):
    """An archive whose frames cannot be followed any further."""


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from the headers of its blocks."""
    try:
        at, checksum = at + zstandard.frame_header_size(data[at:]), zstandard.get_frame_parameters(data[at:]).has_checksum
    except zstandard.ZstdError as error:
        raise Broken(f"frame header: {error}") from error
    while True:
        if at + 3 > len(data):
            raise Broken("cut off in a block header")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        if kind == 3:
            raise Broken("reserved block type")
        at += 3 + (1 if kind == 1 else size)
        if last:
            at += 4 if checksum else 0
            if at > len(data):
                raise Broken("cut off in a frame")
            return at


def frames(data: memoryview) -> Iterator[tuple[int, int | None, memoryview]]:
    """(place, magic of a skippable frame or None, content or whole frame) of each frame."""
    at = 0
    while at < len(data):
        if at + 4 > len(data):
            raise Broken("cut off in a magic number")
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            if at + 8 > len(data):
                raise Broken("cut off in a skippable frame")
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            if end > len(data):
                raise Broken("cut off in a skippable frame")
            yield at, magic, data[at + 8 : end]
        elif magic == FRAME_MAGIC:
            end = frame_end(data, at)
            yield at, None, data[at:end]
        else:
            raise Broken(f"no frame: magic {magic:#010x}")
        at = end


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields; a line that begins with white space goes on with the one before it."""
    found: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:
            found[name] += " " + line.strip().decode()
            continue
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip() or name != name.strip():
            raise ValueError(f"header line {line[:40]!r}")
        if name in found:
            raise ValueError(f"field {name} twice")
        found[name] = value.strip()
    return found


def _length(fields: dict[str, str], name: str = "Content-Length") -> int:
    value = fields.get(name, "")
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"{name} {value!r}")
    return int(value)


def parse_record(raw: bytes) -> dict:
    """The parts of one record; ``ValueError`` says what is wrong with it."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of the headers")
    version, *lines = head.split(b"\r\n")
    if version not in VERSIONS:
        raise ValueError(f"version {version[:20]!r}")
    fields = _fields(lines)
    if missing := [name for name in MANDATORY if name not in fields]:
        raise ValueError(f"without {', '.join(missing)}")
    size = _length(fields)
    if len(rest) != size + 4:
        raise ValueError(f"Content-Length {size}, but {len(rest) - 4} bytes")
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record does not end with two line ends")
    block, http, digest = rest[:size], {}, None
    payload, n = block, size
    kind = fields["WARC-Type"]
    if kind in ("response", "revisit") and fields.get("Content-Type", "").startswith("application/http"):
        head, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            raise ValueError("no end of the HTTP headers")
        http = _fields(head.split(b"\r\n")[1:])
        n = len(payload)
    told = fields.get("WARC-Payload-Digest", "")
    if kind == "revisit":
        if "WARC-Refers-To" not in fields or "WARC-Profile" not in fields:
            raise ValueError("revisit without WARC-Refers-To or WARC-Profile")
        digest = told.removeprefix("sha256:") or None
        n = _length(http) if "Content-Length" in http else None
        payload = None
    else:
        digest = hashlib.sha256(payload).hexdigest()
        if told.startswith("sha256:") and told != f"sha256:{digest}":
            raise ValueError("payload digest differs")
        if "Content-Length" in http and _length(http) != n:
            raise ValueError(f"HTTP Content-Length {http['Content-Length']}, but {n} bytes")
    return {
        "record_type": kind, "record_id": fields["WARC-Record-ID"], "headers": list(fields.items()),
        "http_headers": list(http.items()), "payload": payload, "payload_bytes": n, "payload_digest": digest,
    }


def records_of(data: bytes, with_payload: bool = True) -> Iterator[dict]:
    """The records of one archive in order, each with its ``place`` and, where it is faulty, its ``problem``."""
    view = memoryview(data)
    reader = zstandard.ZstdDecompressor()
    place = 0
    try:
        for place, magic, content in frames(view):
            if magic is not None:
                if magic == DICTIONARY_MAGIC and place == 0 and len(content):
                    learned = bytes(content)
                    if learned[:4] == FRAME_MAGIC.to_bytes(4, "little"):
                        learned = zstandard.ZstdDecompressor().decompressobj().decompress(learned)
                    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learned))
                continue
            try:
                found = parse_record(reader.decompressobj().decompress(content))
                if not with_payload:
                    found["payload"] = None
                yield {"place": place, **found}
            except (ValueError, zstandard.ZstdError) as error:
                yield {"place": place, "problem": str(error)}
    except (Broken, zstandard.ZstdError) as error:
        yield {"place": place, "problem": f"archive: {error}"}


def read_archives(
    spark: SparkSession, path: str, with_payload: bool = True, strict: bool = False, batch_bytes: int = 16 << 20
) -> DataFrame:
    """The records of all archives under a path, a row each (see ``RECORDS``); ``strict`` fails at a faulty one."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(RECORDS))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, size = [], 0
                for found in records_of(content.as_py(), with_payload):
                    if strict and "problem" in found:
                        raise ValueError(f"{name.as_py()} at {found['place']}: {found['problem']}")
                    rows.append({"archive": name.as_py(), **found})
                    size += 1024 + len(found.get("payload") or b"")
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(over, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """The records with ``refers_to``, the headers of the response that a revisit refers to; null where it is missing.

    A response counts only with the revisit's digest.
    """
    target = F.struct(F.element_at("headers", "WARC-Refers-To").alias("id"), F.col("payload_digest").alias("digest"))
    key = F.to_json(target).alias("target")
    wanted = records.where("record_type = 'revisit'").select(key).distinct()
    own = F.to_json(F.struct(F.col("record_id").alias("id"), F.col("payload_digest").alias("digest")))
    responses = records.where("record_type = 'response'").select(own.alias("target"), F.col("headers").alias("refers_to"))
    met = enrich(responses, wanted, "target").groupBy("target").agg(F.any_value("refers_to").alias("refers_to"))
    rows = records.withColumn("target", F.when(F.col("record_type") == "revisit", F.to_json(target)))
    return enrich(rows, met, "target", how="left").drop("target")
