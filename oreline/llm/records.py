"""Length-delimited binary records of token ids, with a separate offset index.

A record is: payload length (8 bytes), masked checksum of those 8 bytes (4), payload, masked
checksum of the payload (4), all little-endian. A payload is: 1 if the document has an id (1 byte),
the id (8), then the token ids, two bytes each if the vocabulary allows it, else four. Checksums
are CRC-32, rotated right by 15 bits plus a constant, so that a checksum over data that holds
checksums stays sound.

The index of a shard has 16 bytes per record: its place in the shard's file and the number of
tokens before it in the shard. A reader seeks to any record, so records can be read in any order by
any task; a manifest table (one row per shard) says what shards there are.

A shard is written under the name of the attempt and moved into place when whole, so a repeated
task replaces its shard. Files are written through the file system that the folder's URI names.

Defined results: missing text is an empty document, which has its end id alone; documents without
an id come first; repeated ids are ordered by a hash of the text, and equal rows are spread over
tasks; an empty table gives no shard; other columns are not read.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreline.llm.common import stored
from oreline.llm.tokens import BYTE_BPE, definition, encoder, text_runs
from oreline.session import scratch_path

END_ID = 0
# Records of a shard that are read in one go.
READ_RECORDS = 2_048
# Such blocks that make a task, on average.
TASK_BLOCKS = 8

_MASK_DELTA = 0xA282EAD8
_HEADER = struct.Struct("<QI")
_CHECK = struct.Struct("<I")
_ID = struct.Struct("<Bq")
_MANIFEST = "shard int, path string, records long, tokens long, bytes long, id_bytes int"


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join(
        (size, _CHECK.pack(masked_checksum(size)), payload, _CHECK.pack(masked_checksum(payload)))
    )


def unframe(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the record at ``at`` and the place behind it; raises if it is damaged."""
    size, check = _HEADER.unpack_from(data, at)
    if check != masked_checksum(data[at : at + 8]):
        raise ValueError(f"damaged record length at byte {at}")
    start = at + _HEADER.size
    payload = data[start : start + size]
    if len(payload) != size or _CHECK.unpack_from(data, start + size)[0] != masked_checksum(payload):
        raise ValueError(f"damaged record at byte {at}")
    return payload, start + size + _CHECK.size


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: Broadcast, end: int):
    encode, context = encoder(tokenizer), TaskContext.get()
    id_bytes = 2 if encode.tokenizer.get_vocab_size() <= 1 << 16 else 4
    files, root = pafs.FileSystem.from_uri(folder)
    name = f"{root}/part-{context.partitionId():06d}"
    attempt = f"{root}/_attempt-{context.taskAttemptId()}"
    index, place, tokens = [], 0, 0
    tail = np.array([end], f"<u{id_bytes}").tobytes()
    out = None
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for low, texts in text_runs(batch.column(1)):
            if out is None:
                out = files.open_output_stream(f"{attempt}.records")
            ids, ends = encode.encode_batch(texts)
            narrow = memoryview(ids.astype(f"<u{id_bytes}").tobytes())
            places = itertools.pairwise((ends * id_bytes).tolist())
            for doc_id, (start, end) in zip(doc_ids[low : low + len(texts)], places, strict=True):
                head = _ID.pack(doc_id is not None, doc_id or 0)
                record = frame(b"".join((head, narrow[start:end], tail)))
                out.write(record)
                index.append((place, tokens))
                place, tokens = place + len(record), tokens + (end - start) // id_bytes + 1
    if out is None:
        return
    out.close()
    with files.open_output_stream(f"{attempt}.index") as side:
        side.write(np.array(index, "<u8").tobytes())
    for kind in ("index", "records"):
        files.move(f"{attempt}.{kind}", f"{name}.{kind}")
    row = [context.partitionId(), name, len(index), tokens, place, id_bytes]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
        ["shard", "path", "records", "tokens", "bytes", "id_bytes"],
    )


def write_records(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str = BYTE_BPE, end_id: int = END_ID,
) -> DataFrame:
    """Token ids of all documents in ascending id order, shard after shard; the manifest, stored.

    ``folder`` is one that all executors share.
    """
    files, root = pafs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    # Equal rows are spread by their place: they are alike, whatever their order.
    ordered = pairs.withColumn("row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange("doc_id", tie, "row").sortWithinPartitions("doc_id", tie)
    write = partial(
        _write, folder=folder, tokenizer=definition(docs.sparkSession, tokenizer), end=end_id
    )
    return stored(ordered.mapInArrow(write, _MANIFEST), "records-manifest")


def _read(batches: Iterator[pa.RecordBatch], scheme: str):
    files, _ = pafs.FileSystem.from_uri(scheme)
    for batch in batches:
        for row in batch.to_pylist():
            with files.open_input_file(f"{row['path']}.index") as side:
                side.seek(16 * row["first"])
                raw = side.read(16 * min(READ_RECORDS, row["records"] - row["first"]))
            index = np.frombuffer(raw, "<u8").reshape(-1, 2)
            with files.open_input_file(f"{row['path']}.records") as source:
                for low in range(0, len(index), 64):
                    part = index[low : low + 64]
                    behind = index[low + 64][0] if low + 64 < len(index) else None
                    yield _decode(source, row, part, behind)


def _decode(source, row: dict, part: np.ndarray, behind) -> pa.RecordBatch:
    """The records of one part of the index, each found by its offset."""
    start = int(part[0][0])
    source.seek(start)
    if behind is not None:
        data = source.read(int(behind) - start)
    else:  # up to the end of the last record
        last = int(part[-1][0]) - start
        data = source.read(last + 8)
        rest = _CHECK.size + struct.unpack_from("<Q", data, last)[0] + _CHECK.size
        data += source.read(rest)
    ids, bodies = [], []
    for place, _ in part:
        payload, _ = unframe(data, int(place) - start)
        has_id, doc_id = _ID.unpack_from(payload)
        ids.append(doc_id if has_id else None)
        narrow = np.frombuffer(payload, f"<u{row['id_bytes']}", offset=_ID.size)
        bodies.append(narrow.astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(row["base"] + part[:, 1].astype(np.int64)),
            pa.array(bodies, pa.binary()),
        ],
        ["doc_id", "start", "ids"],
    )


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), ids (little-endian, 4 bytes each).

    Blocks of records are dealt out in any order; each is found through its shard's index.
    """
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard.
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    blocks_ = placed.select(
        "shard", "path", "records", "id_bytes", "base",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1,
                             F.lit(READ_RECORDS).cast("long"))).alias("first"),
    )
    # As many tasks as the files need: by their own size the rows that name blocks fit one task.
    total = manifest.agg(F.sum(F.ceil(F.col("records") / READ_RECORDS)).alias("n")).first().n or 0
    tasks = 1 + total // TASK_BLOCKS
    return blocks_.repartition(tasks, "shard", "first").mapInArrow(
        partial(_read, scheme=folder), "doc_id long, start long, ids binary"
    )


def round_trip(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Per document, from the files read back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch_path(spark, "records")
    manifest = write_records(docs, folder, **options)
    return read_records(manifest, folder).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
