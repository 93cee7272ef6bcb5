"""Target-distribution importance resampling over hashed word windows.

An untrained ``Split`` pre-tokeniser of the tokenizers library cuts each whole
text, lower-cased in ASCII, into words with their offsets. Pairs of word offsets
(first word, last word) are the windows of 1 to ``most`` consecutive words; the
window's words joined by one space are hashed by CRC-32 into a bucket. Two
histograms, of all documents and of the target texts, give every bucket a gain,
and a document's weight is the mean gain of its windows. Adding Gumbel noise from
a hash of the id and taking the highest scores draws a sample without replacement
whose windows are distributed like the target's.

Texts are cut once: the windows' buckets are written to the shared folder (two
bytes a window), so both the histogram and the weights read them from there. What
goes to the driver and back to every task is one number a bucket, whatever the
input. The order of the draw needs no global sort: scores are integers, their
counts place the cut, and only rows of one score are ranked together.

Defined results: null, empty and wordless texts have no windows and weight 0;
repeated rows and ids are documents of their own, and rows equal in score and id
are ranked in any order; a null id is hashed as the empty text and stands last
among ties; an empty target or empty documents give all counts as they are (0).
Columns of ``docs`` are returned only if named in ``keep``; one named like a
result gets the prefix ``doc_``.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import batch_column, text_slices
from tessera.session import scratch_path, ship_package

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = 1 << 20          # characters given to the pre-tokeniser at once
SLICE = 2 << 20          # bytes of text whose words are held at once
RESULTS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_splitter: list = []


def word_spans(text: str):
    """Yield lists of (word, (start, end)) of a lower-cased text, in order; a
    long text is handed over in pieces that end between words."""
    if not _splitter:
        from tokenizers import Regex, pre_tokenizers
        _splitter.append(pre_tokenizers.Split(Regex(WORD), "removed", invert=True))
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        spans = _splitter[0].pre_tokenize_str(text[at:end] if at or end < len(text) else text)
        yield [(w, (a + at, b + at)) for w, (a, b) in spans] if at else spans
        at = end


def lower_ascii(text: str) -> str:
    return text.encode().lower().decode()


class Shift:
    """CRC-32 of a joined text from those of its parts: crc(a + b) is crc(b) xor
    crc(a) moved over len(b) bytes, which is linear in the bits of crc(a)."""

    MOST = 64              # longer parts are not kept as tables

    def __init__(self):
        self.tables = np.zeros((self.MOST + 1, 4, 256), dtype=np.uint32)
        self.known = np.zeros(self.MOST + 1, dtype=bool)

    @staticmethod
    def table(length: int) -> np.ndarray:
        zeros = bytes(length)
        base = zlib.crc32(zeros, 0)
        out = np.zeros((4, 256), dtype=np.uint32)
        for k in range(4):
            for bit in range(8):
                moved = zlib.crc32(zeros, 1 << (8 * k + bit)) ^ base
                out[k, 1 << bit:2 << bit] = out[k, :1 << bit] ^ np.uint32(moved)
        return out

    def move(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        short = np.minimum(lengths, self.MOST)
        for n in np.flatnonzero(~self.known & (np.bincount(short, minlength=self.MOST + 1) > 0)):
            self.tables[n], self.known[n] = self.table(int(n)), True
        out = np.zeros(len(crc), dtype=np.uint32)
        for k in range(4):
            out ^= self.tables[short, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
        for n in np.unique(lengths[lengths > self.MOST]):
            at, t = np.flatnonzero(lengths == n), self.table(int(n))
            out[at] = 0
            for k in range(4):
                out[at] ^= t[k, (crc[at] >> np.uint32(8 * k)) & np.uint32(255)]
        return out


_shift = Shift()


def window_buckets(texts: list, most: int, buckets: int) -> tuple[list, np.ndarray, np.ndarray]:
    """(words of each text, buckets of all windows text by text, number of
    windows of each text) for a list of texts or nulls."""
    codes: dict[str, int] = {}
    rows, counts = [], []
    for t in texts:
        n = 0
        for spans in word_spans(lower_ascii(t)) if t else ():
            rows.append(np.fromiter((codes.setdefault(w, len(codes)) for w, _ in spans), np.int64, len(spans)))
            n += len(spans)
        counts.append(n)
    words = [w.encode() for w in codes]
    alone = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    after = np.fromiter((zlib.crc32(b" " + w) for w in words), np.uint32, len(words))
    longer = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    code = np.concatenate(rows) if rows else np.empty(0, np.int64)
    of = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)[of] if len(of) else of
    at = np.arange(len(code))
    crc = alone[code]
    found, owner = [crc], [of]
    for k in range(1, most):                 # windows (at, at + k) that end in their own text
        inside = at + k < ends
        at, ends, of = at[inside], ends[inside], of[inside]
        last = code[at + k]
        crc = _shift.move(crc[inside], longer[last]) ^ after[last]
        found.append(crc)
        owner.append(of)
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return counts, np.concatenate(found)[order] % np.uint32(buckets), np.bincount(owners, minlength=len(texts))


def features(docs: DataFrame, most: int, buckets: int, keep: dict[str, str]) -> DataFrame:
    """(doc_id, n_words, n_features, buckets as packed little-endian integers,
    kept columns) of a frame with doc_id and text."""
    kept = list(keep)
    small = np.dtype("<u2" if buckets <= 65536 else "<u4")
    ship_package(docs.sparkSession)
    source = docs.select("doc_id", "text", *kept)
    schema = ", ".join([f"doc_id {source.schema['doc_id'].dataType.simpleString()}",
                        "n_words long", "n_features long", "buckets binary",
                        *[f"`{k}` {source.schema[k].dataType.simpleString()}" for k in kept]])

    def run(batches):
        for b in batches:
            col = batch_column(b, "text")
            for lo, hi in text_slices(col, SLICE):
                counts, found, sizes = window_buckets(col.slice(lo, hi - lo).to_pylist(), most, buckets)
                data = found.astype(small)
                off = np.zeros(hi - lo + 1, dtype=np.int64)
                np.cumsum(sizes, out=off[1:])
                packed = [data[a:z].tobytes() for a, z in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch_column(b, "doc_id").slice(lo, hi - lo), pa.array(counts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(packed, pa.binary()),
                     *[batch_column(b, k).slice(lo, hi - lo) for k in kept]],
                    names=["doc_id", "n_words", "n_features", "buckets", *kept])

    return source.mapInArrow(run, schema)


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """Windows per bucket; each task adds its own up first. One row a bucket
    reaches the driver."""
    small = np.dtype("<u2" if buckets <= 65536 else "<u4")

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for v in batch_column(b, "buckets"):
                if v.is_valid:
                    total += np.bincount(np.frombuffer(v.as_buffer(), small), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=object)
    rows = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in rows.collect():
        out[r.bucket] = int(r.n)
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed shares of every bucket."""
    n = len(source)
    s_all, t_all = float(int(source.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((float(t + 1) * s_all) / (float(s + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with the floored mean gain in place of the buckets."""
    small = np.dtype("<u2" if len(gain) <= 65536 else "<u4")
    shared = found.sparkSession.sparkContext.broadcast(gain)      # one number a bucket
    rest = [c for c in found.columns if c != "buckets"]
    fields = {f.name: f.dataType.simpleString() for f in found.schema.fields}

    def run(batches):
        for b in batches:
            total = [int(shared.value[np.frombuffer(v.as_buffer(), small)].sum()) if v.is_valid else 0
                     for v in batch_column(b, "buckets")]
            size = batch_column(b, "n_features").to_pylist()
            weight = [t // n if n else 0 for t, n in zip(total, size)]
            yield pa.RecordBatch.from_arrays([*[batch_column(b, c) for c in rest], pa.array(weight, pa.int64())],
                                             names=[*rest, "weight"])

    schema = ", ".join(f"`{c}` {fields[c]}" for c in rest) + ", weight long"
    return found.mapInArrow(run, schema)


def ranked(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``rank`` of the drawn rows of a written table with doc_id, n_words, score."""
    able = scored.where(F.col("n_words") >= min_words)
    per = able.groupBy("score").agg(F.count(F.lit(1)).alias("__n"))
    # one row per integer score: about 110,000 at most, by the range of gains and noise
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    cut = per.select(F.col("score").alias("__score"), F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__above"),
                     F.floor(F.sum("__n").over(whole) * F.lit(percent) / F.lit(100)).alias("__drawn"))
    cut = cut.where(F.col("__above") < F.col("__drawn"))
    rows = scored.join(F.broadcast(cut), (F.col("score") == F.col("__score")) & (F.col("n_words") >= min_words), "left")
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    drawn = rows.where(F.col("__score").isNotNull()).withColumn("rank", (F.col("__above") + place).cast("long"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= F.col("__drawn"), F.col("rank")))
    rest = rows.where(F.col("__score").isNull()).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("__score", "__above", "__drawn")


def resample(docs: DataFrame, target: DataFrame, most: int = 2, buckets: int = 10_000, min_words: int = 20,
             percent: int = 25, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document with n_words, n_features, weight, score and, if drawn, its
    rank (1 is the highest score), and the columns named in ``keep``: those of the
    drawn rows are the sample."""
    spark = docs.sparkSession
    names = {}
    for k in keep:
        name = k
        while name in RESULTS or name in names or name in ("buckets", "text"):
            name = f"doc_{name}"
        names[name] = k
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                        *[F.col(f"`{k}`").alias(n) for n, k in names.items()])
    path = scratch_path(spark, "windows")
    features(texts, most, buckets, names).write.parquet(path)
    found = spark.read.parquet(path)
    wanted = target.select(F.lit(0).alias("doc_id"), F.col(f"`{target_col}`").cast("string").alias("text"))
    gain = gains(histogram(found, buckets), histogram(features(wanted, most, buckets, {}), buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
                                  256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = scratch_path(spark, "scores")
    weigh(found, gain).withColumn("score", F.col("weight") + noise).write.parquet(scored)
    out = ranked(spark.read.parquet(scored), percent, min_words)
    return out.select(*RESULTS, *names)
