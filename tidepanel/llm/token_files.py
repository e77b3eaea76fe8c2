"""Token files: frequency-ranked ids, byte-aligned codes, separate control bytes.

A file holds the documents of one doc_id range in ascending order:

    header  magic, number of documents and tokens, the file's ids by falling
            frequency (rank -> id)
    blocks  document table (id, id present, tokens), control bytes, code bytes

and every part is followed by one separator byte. A token is the rank of its id
in 1 to 4 little-endian bytes; a control byte holds the sizes (less one) of four
tokens in two bits each, so the most frequent 256 ids take one byte each. The
reader expands control bytes by a 256 x 4 table and ranks by the header's table.

Ranges come from a range partitioning of the text rows, before any token is
made; each text is encoded once, by the task that writes its file.

Defined cases: a null or empty text is the end id alone; documents of one
doc_id keep an order fixed by their text; a null doc_id comes first; an empty
table gives no files that hold documents, and no rows.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.binary_files import read_files, write_files
from tidepanel.llm.common import materialize, parts_for, scratch_path, text_or_empty
from tidepanel.llm.encoding import crc32, encoder, text_batches

MAGIC = b"tokrank1"
SEPARATOR = "\n"
HEADER = struct.Struct("<8sqqi")
BLOCK = struct.Struct("<iii")
BLOCK_TOKENS = 1 << 18
# sizes of the four tokens of a control byte
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
ROWS = "file string, place long, doc_id string, local_start long, n_tokens long, ids_crc32 long"


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, code bytes)."""
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    code = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    code[:len(ranks)] = size - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(
        axis=1, dtype=np.uint8)
    octets = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), octets[np.arange(4) < size[:, None]].tobytes()


def decode_ranks(control: bytes, codes: bytes, n: int) -> np.ndarray:
    size = SIZES[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size) - size
    data = np.frombuffer(codes + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    out = data[at]
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= data[at[longer] + k] << np.uint32(8 * k)
    return out


def file_blocks(documents: list[tuple[int | None, bytes]]):
    """The parts of one file; documents: (doc_id, ids as <u4 bytes), in order."""
    tokens = [np.frombuffer(ids, dtype="<u4") for _, ids in documents]
    every = np.concatenate(tokens) if tokens else np.empty(0, dtype="<u4")
    ids, counts = np.unique(every, return_counts=True)
    by_rank = ids[np.lexsort((ids, -counts))]
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    yield HEADER.pack(MAGIC, len(documents), len(every), len(by_rank)) + by_rank.astype(
        "<u4").tobytes()
    start, held = 0, 0
    for i, t in enumerate(tokens):
        held += len(t)
        if held >= BLOCK_TOKENS or i + 1 == len(tokens):
            part = documents[start:i + 1]
            control, codes = encode_ranks(rank_of[np.concatenate(tokens[start:i + 1])])
            table = (np.array([d or 0 for d, _ in part], dtype="<i8").tobytes()
                     + np.array([d is not None for d, _ in part], dtype=np.uint8).tobytes()
                     + np.array([len(b) // 4 for _, b in part], dtype="<i8").tobytes())
            yield BLOCK.pack(len(part), len(control), len(codes)) + table + control + codes
            start, held = i + 1, 0


def read_file(content: bytes):
    """(doc_id, ids) of every document of a file, in order."""
    gap = len(SEPARATOR)
    magic, documents, _, ranked = HEADER.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEADER.size
    by_rank = np.frombuffer(content, dtype="<u4", count=ranked, offset=at)
    at += 4 * ranked + gap
    while documents:
        n, control_size, code_size = BLOCK.unpack_from(content, at)
        at += BLOCK.size
        doc_ids = np.frombuffer(content, dtype="<i8", count=n, offset=at).tolist()
        present = np.frombuffer(content, dtype=np.uint8, count=n, offset=at + 8 * n).tolist()
        sizes = np.frombuffer(content, dtype="<i8", count=n, offset=at + 9 * n).tolist()
        at += 17 * n
        codes_at = at + control_size
        ids = by_rank[decode_ranks(content[at:codes_at], content[codes_at:codes_at + code_size],
                                   sum(sizes))]
        at = codes_at + code_size + gap
        start = 0
        for doc_id, known, size in zip(doc_ids, present, sizes):
            yield (doc_id if known else None), ids[start:start + size]
            start += size
        documents -= n


def write_token_files(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0,
                      file_text_bytes: int = 12_000_000) -> None:
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty("text").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    ordered = (rows.repartitionByRange(parts_for(total, file_text_bytes), "doc_id")
               .sortWithinPartitions("doc_id", "text")
               .withColumn("doc_id", F.col("doc_id").cast("string")))

    def blocks(batches):
        enc, documents = encoder(vocabulary), []
        for frame in batches:
            ids = [None if x is None else int(x) for x in frame["doc_id"]]
            texts = list(frame["text"])
            for part in text_batches(texts):
                documents += zip(ids[part], (b + end for b in enc.batch(texts[part])))
        if documents:
            yield from file_blocks(documents)

    write_files(ordered, blocks, path, SEPARATOR)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files. `start` adds, to a
    document's place in its file, the tokens of the files before: a running sum
    over one row a file."""
    def rows_of(name, content):
        out, start = [], 0
        for place, (doc_id, ids) in enumerate(read_file(content)):
            out.append((name, place, None if doc_id is None else str(doc_id), start, len(ids),
                        crc32(ids.astype("<u4").tobytes())))
            start += len(ids)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ROWS.split(", ")])

    rows = materialize(read_files(spark, path, rows_of, ROWS), "token-rows")
    # part numbers follow the doc_id ranges; as numbers, since names stop sorting at 100000
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    before = (rows.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
              .withColumn("base", F.sum("tokens").over(Window.orderBy(part)) - F.col("tokens"))
              .select("file", "base"))
    return (rows.join(before, "file")
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    (F.col("base") + F.col("local_start")).cast("long").alias("start"),
                    "n_tokens", "ids_crc32"))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, vocabulary, path)
    return read_token_files(docs.sparkSession, path)
