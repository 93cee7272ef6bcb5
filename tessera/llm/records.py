"""Token-id files as length-delimited binary records with an offset index.

A data file is a run of records, each
    u64 payload length | u32 masked checksum of those 8 bytes |
    payload (token ids, little-endian u16 or u32) | u32 masked checksum of the payload
with the checksum masked as ((c >> 15) | (c << 17)) + 0xA282EAD8 modulo 2**32
over CRC-32. Beside it stands an index file with one fixed-size entry per record
(id, whether the id is null, tokens before it in the file, byte offset, tokens),
so that a reader can draw records in any order.

Rows are dealt to files by ranges of the id, so files in order hold the ids in
ascending order (null ids first; equal ids by the checksum of their text). Each
attempt of a task writes files of its own name; the manifest, written by Spark,
names those of the attempts that counted, so lost executors and second attempts
leave no wrong record. Files lie in the shared folder.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import ItemTokenizer, batch_column, text_slices

INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("start", "<u8"), ("offset", "<u8"), ("tokens", "<u8")])
AROUND = 8 + 4 + 4      # bytes of a record beside its payload


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = struct.pack("<Q", len(payload))
    return n + struct.pack("<I", masked(n)) + payload + struct.pack("<I", masked(payload))


def read_frame(f) -> bytes:
    """The payload of the record at the file's position; checks both checksums."""
    head = f.read(12)
    n, check = struct.unpack("<QI", head)
    if masked(head[:8]) != check:
        raise ValueError("damaged record length")
    payload = f.read(n)
    if len(payload) != n or struct.unpack("<I", f.read(4))[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


def open_fs(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def write_records(df: DataFrame, path: str, folder: str, end_id: int | None = 2, id_col: str = "doc_id",
                  text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Tokenize every text (null: empty), append ``end_id``, write data and index
    files into ``folder`` and return the manifest (file, index, width, part,
    records, tokens, start): start is the number of tokens in all files before."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keys = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary"))]
    src = src.repartitionByRange(partitions, *keys) if partitions else src.repartitionByRange(*keys)
    src = src.sortWithinPartitions(*keys)

    def run(batches):
        tok = ItemTokenizer.load(path)
        data = None
        entries, offset, start = [], 0, 0
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        fs, base = open_fs(folder)
        for batch in batches:
            ids, text = batch_column(batch, "doc_id"), batch_column(batch, "text")
            for a, b in text_slices(text):
                tokens, off = tok.encode(text.slice(a, b - a))
                if data is None:
                    fs.create_dir(base, recursive=True)
                    data = fs.open_output_stream(f"{base}/{name}.rec")
                for k, i in enumerate(ids.slice(a, b - a).to_pylist()):
                    one = tokens[off[k]:off[k + 1]]
                    if end_id is not None:
                        one = np.append(one, np.asarray([end_id], dtype=tok.dtype))
                    rec = frame(one.tobytes())
                    data.write(rec)
                    entries.append((i or 0, i is None, start, offset, len(one)))
                    offset += len(rec)
                    start += len(one)
        if data is None:
            return
        data.close()
        with fs.open_output_stream(f"{base}/{name}.idx") as f:
            f.write(np.array(entries, dtype=INDEX).tobytes())
        yield pa.RecordBatch.from_pydict({
            "file": [f"{name}.rec"], "index": [f"{name}.idx"], "width": pa.array([tok.dtype.itemsize], pa.int32()),
            "part": pa.array([part], pa.int64()), "records": pa.array([len(entries)], pa.int64()),
            "tokens": pa.array([start], pa.int64())})

    spark = df.sparkSession
    out = src.mapInArrow(run, "file string, index string, width int, part long, records long, tokens long")
    out.write.parquet(f"{folder}/manifest")
    files = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))


def read_records(spark: SparkSession, manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Read the files back through their index: per record doc_id, start (tokens
    before it in all files), n_tokens, ids_crc32 and, if ``with_ids``, the ids
    (little-endian unsigned 32-bit)."""
    files = manifest.repartition(max(1, min(manifest.count(), 4096)), "part")

    def run(batches):
        fs, base = open_fs(folder)
        for batch in batches:
            for m in batch.to_pylist():
                with fs.open_input_stream(f"{base}/{m['index']}") as f:
                    index = np.frombuffer(f.read(), dtype=INDEX)
                kind = np.dtype(f"<u{m['width']}")
                with fs.open_input_file(f"{base}/{m['file']}") as f:
                    at = 0
                    for lo in range(0, len(index), 2000):
                        crc, ids = [], []
                        for e in index[lo:lo + 2000]:
                            if e["offset"] != at:
                                f.seek(int(e["offset"]))
                            payload = read_frame(f)
                            at = int(e["offset"]) + len(payload) + AROUND
                            one = np.frombuffer(payload, dtype=kind)
                            if len(one) != e["tokens"]:
                                raise ValueError("the index does not fit its file")
                            wide = one.astype("<u4").tobytes()
                            crc.append(zlib.crc32(wide))
                            if with_ids:
                                ids.append(wide)
                        part = index[lo:lo + 2000]
                        cols = {"doc_id": pa.array(part["id"], mask=part["null"].astype(bool)),
                                "start": pa.array((part["start"] + m["start"]).astype(np.int64)),
                                "n_tokens": pa.array(part["tokens"].astype(np.int64)),
                                "ids_crc32": pa.array(crc, pa.int64())}
                        if with_ids:
                            cols["ids"] = pa.array(ids, pa.binary())
                        yield pa.RecordBatch.from_pydict(cols)

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"
                                 + (", ids binary" if with_ids else ""))
