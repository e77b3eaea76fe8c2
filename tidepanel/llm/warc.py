"""WARC archives in Zstandard, with a dictionary in a leading skippable frame.

A file is a skippable frame that holds the dictionary, then one frame a record,
each decodable by itself with that dictionary. The dictionary is built from a
bounded sample of the records being archived. Between frames stands an empty
skippable frame, which decoders pass over: it is the writer's row separator.

Of records with equal payloads of `least_bytes` or more, the one with the largest
page_id is a response and the others are revisits that name it; digest and
length stand in both, a revisit holds no payload.

Reading takes everything from the archives: record types, digests, lengths and
ids; a response's payload is checked against its digest and length.

Defined cases: null html is an empty payload; repeated rows with the largest
page_id are all responses; a null page_id is archived under an empty number and
read back as null (the response of a group without any id has no one to refer
to, so all of such a group are responses); an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.binary_files import read_files, write_files
from tidepanel.llm.common import materialize, parts_for, salted_join, scratch_path, text_or_empty

# Frame numbers of the Zstandard and WARC-Zstandard formats
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
DICTIONARY_FRAME = 0x184D2A5D
WINDOW = 1 << 16
DATE = "2024-01-01T00:00:00Z"
ROWS = ("page_id string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to string")


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, length: int,
           refers_to: str | None) -> bytes:
    """One WARC record; a revisit if `refers_to` is given."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {length}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{page_id or ''}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """A row of ROWS from one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length
                               or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")

    def number(name):
        return (fields.get(name) or "")[len("<urn:page:"):-1] or None

    return number("WARC-Record-ID"), length, digest, kind, number("WARC-Refers-To")


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """An empty dictionary where there is too little to learn from."""
    import zstandard
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def archived(pages: DataFrame, least_bytes: int) -> DataFrame:
    """pages with digest, length and the page that a revisit refers to."""
    html = text_or_empty("html")
    rows = pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("content"),
        F.sha1(html.cast("binary")).alias("digest"),
        F.octet_length(html).cast("long").alias("length"))
    groups = materialize(
        rows.where(F.col("length") >= least_bytes).groupBy("content")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1), "equal-payloads")
    joined = salted_join(rows, groups, "content", "page_id", 1000, "rows", "left")
    revisit = (F.col("first_id").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    return joined.select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest", "length",
        F.when(revisit, F.col("first_id").cast("string")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000, sample_rows: int = 400,
                   dictionary_bytes: int = 65_536, file_bytes: int = 16_000_000) -> None:
    """sample_rows: records, picked by hash of their id, that the dictionary is built
    from (their first 64 KB each); it only affects size."""
    rows = archived(pages, least_bytes)
    # the ids are picked first, so that no task sends its candidates' html
    picked = (pages.select(F.xxhash64("page_id").alias("h")).distinct()
              .orderBy("h").limit(sample_rows))
    sample = (pages.select("page_id", "url", text_or_empty("html").alias("html"),
                           F.xxhash64("page_id").alias("h"))
              .join(F.broadcast(picked), "h")
              .select("page_id", "url", F.substring("html", 1, 65_536).alias("html"))
              .limit(sample_rows).collect())
    records = []
    for r in sample:
        payload = r["html"].encode()
        records.append(record(str(r["page_id"]), r["url"], payload,
                              hashlib.sha1(payload).hexdigest(), len(payload), None))
    dictionary = train_dictionary(records, dictionary_bytes)
    total = pages.agg(F.sum(F.octet_length(F.col("html").cast("string")))).first()[0]

    def blocks(batches):
        import zstandard
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=3, dict_data=known)
        first = True
        for frame in batches:
            for r in frame.itertuples(index=False):
                if first:
                    yield struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
                    first = False
                refers = r.refers_to if isinstance(r.refers_to, str) else None
                page = r.page_id if isinstance(r.page_id, str) else None
                yield press.compress(record(
                    page, r.url if isinstance(r.url, str) else None,
                    b"" if refers is not None else r.html.encode(), r.digest, r.length, refers))

    write_files(rows.repartition(parts_for(total, file_bytes), F.xxhash64("page_id", "digest")),
                blocks, path, EMPTY_FRAME)


def records_of(content: bytes):
    """The records of an archive, frame by frame."""
    import zstandard
    at, press, view = 0, zstandard.ZstdDecompressor(), memoryview(content)
    while at < len(content):
        magic, size = struct.unpack_from("<II", content, at)
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            if magic == DICTIONARY_FRAME and size:
                press = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(content[at + 8:at + 8 + size]))
            at += 8 + size
            continue
        one, data = press.decompressobj(), []
        while not one.eof:
            part = view[at:at + WINDOW]
            if not len(part):
                raise ValueError("the last frame is cut off")
            data.append(one.decompress(part))
            at += len(part) - len(one.unused_data)
        yield b"".join(data)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to."""
    def rows_of(name, content):
        yield pd.DataFrame([parse(r) for r in records_of(content)],
                           columns=[c.split()[0] for c in ROWS.split(", ")])

    return (read_files(spark, path, rows_of, ROWS)
            .withColumn("page_id", F.col("page_id").cast("long"))
            .withColumn("refers_to", F.col("refers_to").cast("long")))


def round_trip(pages: DataFrame) -> DataFrame:
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
