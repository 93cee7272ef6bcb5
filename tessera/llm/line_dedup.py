"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line without white space at its ends, lower-cased in ASCII.
A key of at least ``min_chars`` code points held by at least ``min_docs``
documents is repeated: it loses its lines in every document but the one with the
largest id. ``LineIndex`` keeps, in the shared folder,

* references: (shard, key, id, version) of every inserted document, and the ids
  deleted at a version; a reference lives until its id is deleted later,
* counts: (shard, key, n documents, largest id) for every living key, exact,
* one cuckoo filter a shard over the repeated keys.

``insert`` and ``delete`` touch the counts of the batch's keys only, and move a key
into or out of its shard's filter when its count crosses ``min_docs``, so a deletion
undoes an insertion. A filter that is too full is built anew, twice as large, from
the counts. ``dedup`` asks the filters first: a document's keys go to their shards,
and only those a filter holds are looked up in the counts, which decide. A filter
never misses a repeated key, so the result is exact.

A key is the 128-bit BLAKE2b digest of its bytes; a shard is a range of digests.
Filters and keys meet in sorted streams (the filter of a shard first), so a task
holds one filter, not the keys of a shard; a shard is dealt to ``SALTS`` tasks by
document, so that a key held by a third of all documents is spread. The number of
shards follows the number of references (``SHARD_ROWS``).

Defined results: null and empty texts are one empty line; lines end at ``\\n`` only;
rows with equal ids are one document (their keys together), and each row loses its
lines; a null id is one document, smaller than all others; an empty table gives an
empty result. Extra columns are kept as they are; results named like one of them
replace it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import batch_column, text_slices
from tessera.session import remove_scratch, scratch_path, ship_package

SPACE = b" \t\n\x0b\x0c\r"
SHARD_ROWS = 1 << 20      # references aimed at for a shard
SALTS = 16                # tasks that a shard's lookups are dealt to
SLOTS, KICKS, LOAD = 4, 500, 0.8


def line_keys(text: bytes, min_chars: int) -> list:
    """The digest of each line's key, or None where the key is too short."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(SPACE).lower()
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long else None)
    return out


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key has two buckets, either found
    from the other and the fingerprint. Keys are 16-byte digests."""

    def __init__(self, table: np.ndarray):
        self.table = table                    # (buckets, SLOTS), 0 is a free slot

    @classmethod
    def sized(cls, keys: int) -> "CuckooFilter":
        buckets = 1 << max(2, math.ceil(math.log2(max(1, keys) / (SLOTS * LOAD))))
        return cls(np.zeros((buckets, SLOTS), dtype="<u2"))

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        return cls(np.frombuffer(data, dtype="<u2").reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def place(self, digests: np.ndarray):
        """(fingerprint, first bucket, second bucket) of an (n, 2) array of
        64-bit halves."""
        mask = np.uint64(len(self.table) - 1)
        mark = (digests[:, 0] >> np.uint64(16)) & np.uint64(0xFFFF)
        mark = np.where(mark == 0, np.uint64(1), mark)
        one = digests[:, 1] & mask
        return mark.astype(np.uint16), one.astype(np.int64), (one ^ self.step(mark, mask)).astype(np.int64)

    @staticmethod
    def step(mark, mask):
        return ((mark * np.uint64(0x5BD1E995)) ^ (mark * np.uint64(0x5BD1E995) >> np.uint64(13))) & mask

    def holds(self, digests: np.ndarray) -> np.ndarray:
        if not len(digests):
            return np.zeros(0, dtype=bool)
        mark, one, two = self.place(digests)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)

    def add(self, digests: np.ndarray) -> bool:
        """False if a key found no room: the filter must be built anew."""
        mark, one, two = self.place(digests)
        mask = np.uint64(len(self.table) - 1)
        turn = 0
        for m, a, b in zip(mark.tolist(), one.tolist(), two.tolist()):
            if self._put(m, a) or self._put(m, b):
                continue
            at = b
            for _ in range(KICKS):
                turn = (turn + 1) % SLOTS            # slots are evicted in turn, so runs agree
                m, self.table[at, turn] = int(self.table[at, turn]), m
                at = int(np.uint64(at) ^ self.step(np.uint64(m), mask))
                if self._put(m, at):
                    break
            else:
                return False
        return True

    def _put(self, mark: int, bucket: int) -> bool:
        row = self.table[bucket]
        for slot in range(SLOTS):
            if row[slot] == 0:
                row[slot] = mark
                return True
        return False

    def remove(self, digests: np.ndarray) -> None:
        """Take out one copy of each key; only keys that were added may be given."""
        mark, one, two = self.place(digests)
        for m, a, b in zip(mark.tolist(), one.tolist(), two.tolist()):
            for at in (a, b):
                found = np.flatnonzero(self.table[at] == m)
                if len(found):
                    self.table[at, found[0]] = 0
                    break
            else:
                raise KeyError("a key that was not added")


def halves(col) -> np.ndarray:
    """(n, 2) array of 64-bit halves of an Arrow column of 16-byte digests."""
    return np.frombuffer(b"".join(col.to_pylist()), dtype=">u8").reshape(-1, 2).astype(np.uint64)


def shard_of(key, shards: int):
    """The range of digests a key lies in."""
    return F.floor(F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long") * F.lit(shards)
                   / F.lit(1 << 32)).cast("int")


class LineIndex:
    """Which lines stand in how many of the documents inserted and not deleted."""

    def __init__(self, spark: SparkSession, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id",
                 text_col: str = "text", shards: int | None = None):
        ship_package(spark)
        self.spark, self.min_docs, self.min_chars, self.shards = spark, min_docs, min_chars, shards
        self.id_col, self.text_col = id_col, text_col
        self.version = 0
        self.references: list[str] = []      # tables of (key, id, version)
        self.removed: list[str] = []         # tables of (id, version)
        self.counts: str | None = None       # (shard, key, n, last)
        self.filters: str | None = None      # (shard, filter)

    # the keys of documents

    def _keys(self, docs: DataFrame) -> DataFrame:
        """(id, key), the distinct keys of each row."""
        source = docs.select(F.col(f"`{self.id_col}`").alias("id"), F.col(f"`{self.text_col}`").cast("string").alias("text"))
        kind, least = source.schema["id"].dataType.simpleString(), self.min_chars

        def run(batches):
            for b in batches:
                col = batch_column(b, "text")
                for lo, hi in text_slices(col):
                    at, keys = [], []
                    for i, t in enumerate(col.slice(lo, hi - lo).cast(pa.binary()).to_pylist()):
                        found = {k for k in line_keys(t or b"", least) if k is not None}
                        at += [lo + i] * len(found)
                        keys += sorted(found)
                    yield pa.RecordBatch.from_arrays(
                        [batch_column(b, "id").take(pa.array(at, pa.int64())), pa.array(keys, pa.binary())],
                        names=["id", "key"])

        return source.mapInArrow(run, f"id {kind}, key binary")

    def _written(self, df: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, f"lines-{name}")
        df.write.parquet(path)
        return path

    def _living(self) -> DataFrame | None:
        """(id, key) once for every document and key in the index."""
        if not self.references:
            return None
        out = self.spark.read.parquet(*self.references)
        if self.removed:
            gone = self.spark.read.parquet(*self.removed).groupBy("id").agg(F.max("version").alias("gone"))
            out = out.alias("r").join(gone.alias("g"), F.col("r.id").eqNullSafe(F.col("g.id")), "left")
            out = out.where(F.col("gone").isNull() | (F.col("version") > F.col("gone"))).select("r.id", "key")
        return out.select("id", "key").distinct()

    # changes

    def insert(self, docs: DataFrame) -> None:
        """Add documents. Rows of an id that is in the index add to its keys."""
        self.version += 1
        path = self._written(self._keys(docs).withColumn("version", F.lit(self.version)), "references")
        if self.shards is None:
            self.shards = max(1, math.ceil(self.spark.read.parquet(path).count() / SHARD_ROWS))
        self.references.append(path)
        self._update(self.spark.read.parquet(path).select("key"), first=self.counts is None)

    def delete(self, ids: DataFrame) -> None:
        """Take out the documents of these ids, as if they had not been inserted."""
        self.version += 1
        gone = ids.select(F.col(f"`{self.id_col}`").alias("id")).distinct()
        path = self._written(gone.withColumn("version", F.lit(self.version)), "removed")
        held = self._living()
        if held is None:
            return
        touched = held.alias("h").join(self.spark.read.parquet(path).alias("g"),
                                       F.col("h.id").eqNullSafe(F.col("g.id")), "left_semi").select("key")
        keys = self._written(touched, "touched")
        self.removed.append(path)
        self._update(self.spark.read.parquet(keys), first=False)
        remove_scratch(self.spark, keys)

    def _update(self, touched: DataFrame, first: bool) -> None:
        """New counts of the touched keys; keys whose count crossed ``min_docs``
        go into or out of their filters."""
        living = self._living()
        if not first:
            touched = touched.distinct()
            living = living.join(touched, "key", "left_semi")
        new = living.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
        new = new.withColumn("shard", shard_of(F.col("key"), self.shards))
        old_path, crossed = self.counts, None
        if first:
            self.counts = self._written(new.select("shard", "key", "n", "last"), "counts")
            crossed = self.spark.read.parquet(self.counts).where(F.col("n") >= self.min_docs)
            crossed = crossed.select("shard", "key", F.lit(True).alias("added"))
        else:
            part = self._written(new.select("shard", "key", "n", "last"), "part")
            new, old = self.spark.read.parquet(part), self.spark.read.parquet(old_path)
            before = old.join(touched, "key", "left_semi")
            moved = before.select("key", F.col("n").alias("was")).join(new.select("key", "n"), "key", "full")
            was, now = (F.coalesce(F.col(c), F.lit(0)) >= self.min_docs for c in ("was", "n"))
            crossed = moved.where(was != now).select(shard_of(F.col("key"), self.shards).alias("shard"), "key",
                                                     now.alias("added"))
            crossed = self.spark.read.parquet(self._written(crossed, "crossed"))
            self.counts = self._written(old.join(touched, "key", "left_anti").unionByName(new), "counts")
            remove_scratch(self.spark, old_path)
        self._refilter(crossed)

    def _streams(self, rows: DataFrame, salts: int) -> DataFrame:
        """(shard, salt, filter, rows' columns): the rows of a shard after its
        filter, in the order of their shards. ``rows`` has shard, salt, key."""
        none = [c for c in rows.columns if c not in ("shard", "salt")]
        both = rows.withColumn("filter", F.lit(None).cast("binary"))
        if self.filters:
            f = self.spark.read.parquet(self.filters).withColumn(
                "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            both = both.unionByName(f.select("shard", "salt", "filter", *[
                F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in none]))
        return both.repartition("shard", "salt").sortWithinPartitions(
            "shard", "salt", F.col("filter").isNull(), *(["key"] if salts == 1 else []))

    def _refilter(self, crossed: DataFrame, size: int = 1) -> None:
        """Write the filters with the changes; those that overflow, or are new,
        are built from the counts, in a size for their keys."""
        known = self.filters is not None

        def change(batches):
            now, table, over = None, None, False

            def done():
                return pa.RecordBatch.from_arrays(
                    [pa.array([now], pa.int32()), pa.array([None if over else table.dump()], pa.binary())],
                    names=["shard", "filter"])

            for b in batches:
                shard = batch_column(b, "shard").to_numpy()
                cuts = np.flatnonzero(np.diff(shard)) + 1
                for lo, hi in zip([0, *cuts], [*cuts, len(shard)]):
                    if now is not None and shard[lo] != now:
                        yield done()
                        table, over = None, False
                    now = shard[lo]
                    data = batch_column(b, "filter").slice(lo, hi - lo)
                    if data[0].is_valid:
                        table, lo = CuckooFilter.load(data[0].as_py()), lo + 1
                    if lo == hi or over:
                        continue
                    if table is None:
                        over = True
                        continue
                    key = halves(batch_column(b, "key").slice(lo, hi - lo))
                    added = batch_column(b, "added").slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool)
                    table.remove(key[~added])
                    over = not table.add(key[added])
            if now is not None:
                yield done()

        rows = crossed.select("shard", F.lit(0).alias("salt"), "key", "added")
        path = None
        if known:
            path = self._written(self._streams(rows, 1).select("shard", "filter", "key", "added")
                                 .mapInArrow(change, "shard int, filter binary"), "filters")
            fresh = self.spark.read.parquet(path)
            over = fresh.where("filter IS NULL").select("shard")
            kept = fresh.where("filter IS NOT NULL")
        counts = self.spark.read.parquet(self.counts).where(F.col("n") >= self.min_docs).select("shard", "key")
        if known:
            counts = counts.join(F.broadcast(over), "shard", "left_semi")      # one row a shard
        sizes = counts.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))
        built = counts.join(F.broadcast(sizes), "shard").repartition("shard").sortWithinPartitions("shard", "key")

        def build(batches):
            now, table, width = None, None, None
            held: list = []

            def filled():
                keys, size = np.concatenate(held), width
                while True:
                    out = CuckooFilter.sized(size)
                    if out.add(keys):
                        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([out.dump()], pa.binary())],
                                                          names=["shard", "filter"])
                    size *= 2

            for b in batches:
                shard = batch_column(b, "shard").to_numpy()
                cuts = np.flatnonzero(np.diff(shard)) + 1
                for lo, hi in zip([0, *cuts], [*cuts, len(shard)]):
                    if now is not None and shard[lo] != now:
                        yield filled()
                        held.clear()
                    now, width = shard[lo], int(batch_column(b, "size")[int(lo)].as_py() * 2)
                    held.append(halves(batch_column(b, "key").slice(lo, hi - lo)))
            if now is not None:
                yield filled()

        new = built.select("shard", "key", "size").mapInArrow(build, "shard int, filter binary")
        old = self.filters
        self.filters = self._written(kept.unionByName(new) if known else new, "filters")
        for p in (old, path):
            if p:
                remove_scratch(self.spark, p)

    # lookups

    def repeated(self, docs: DataFrame) -> DataFrame:
        """(id, key) of the documents' keys that are repeated and stand in a
        document with a larger id: filters first, then the exact counts."""
        pairs = self._keys(docs).distinct()
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
        asked = pairs.select(shard_of(F.col("key"), self.shards or 1).alias("shard"), salt.alias("salt"), "id", "key")
        if self.filters is None:
            return pairs.where(F.lit(False))
        kind = pairs.schema["id"].dataType.simpleString()

        def probe(batches):
            now, table = None, None
            for b in batches:
                shard = batch_column(b, "shard").to_numpy()
                data = batch_column(b, "filter")
                starts = np.union1d(np.flatnonzero(np.diff(shard)) + 1, np.flatnonzero(data.is_valid().to_numpy(False)))
                cuts = [int(c) for c in starts if c > 0]
                for lo, hi in zip([0, *cuts], [*cuts, len(shard)]):
                    if shard[lo] != now:
                        now, table = shard[lo], None
                    if data[lo].is_valid:
                        table, lo = CuckooFilter.load(data[lo].as_py()), lo + 1
                    if lo == hi or table is None:
                        continue
                    key = batch_column(b, "key").slice(lo, hi - lo)
                    hit = pa.array(np.flatnonzero(table.holds(halves(key))))
                    yield pa.RecordBatch.from_arrays(
                        [batch_column(b, "id").slice(lo, hi - lo).take(hit), key.take(hit)], names=["id", "key"])

        maybe = self._streams(asked, SALTS).select("shard", "filter", "id", "key")
        maybe = maybe.mapInArrow(probe, f"id {kind}, key binary")
        sure = self.spark.read.parquet(self.counts).where(F.col("n") >= self.min_docs).select("key", "last")
        return maybe.join(sure, "key").where(~F.col("id").eqNullSafe(F.col("last"))).select("id", "key")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """The columns of ``docs`` with kept_text, n_lines and n_dropped."""
        drop = self.repeated(docs).groupBy("id").agg(F.collect_list("key").alias("__drop"))   # a document's own keys
        own = [c for c in docs.columns if c.lower() not in ("kept_text", "n_lines", "n_dropped")]
        position = {c: f"__c{i}" for i, c in enumerate(own)}
        rows = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in position.items()])
        rows = rows.join(drop, F.col(position[self.id_col]).eqNullSafe(F.col("id")), "left").drop("id")
        text, least, hidden = position[self.text_col], self.min_chars, list(position.values())

        def run(batches):
            for b in batches:
                col, drops = batch_column(b, text), batch_column(b, "__drop")
                for lo, hi in text_slices(col.cast(pa.string()), 32 << 20):
                    kept, total, lost = [], [], []
                    for t, d in zip(col.slice(lo, hi - lo).cast(pa.binary()).to_pylist(),
                                    drops.slice(lo, hi - lo).to_pylist()):
                        t = t or b""
                        n = t.count(b"\n") + 1
                        total.append(n)
                        if d:
                            gone = set(d)
                            left = [x for x, k in zip(t.split(b"\n"), line_keys(t, least)) if k not in gone]
                            t, n = b"\n".join(left), n - len(left)
                            lost.append(n)
                        else:
                            lost.append(0)
                        kept.append(t)
                    yield pa.RecordBatch.from_arrays(
                        [*[batch_column(b, c).slice(lo, hi - lo) for c in hidden],
                         pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()),
                         pa.array(lost, pa.int64())], names=[*hidden, "kept_text", "n_lines", "n_dropped"])

        schema = ", ".join([f"{h} {rows.schema[h].dataType.simpleString()}" for h in hidden]
                           + ["kept_text string", "n_lines long", "n_dropped long"])
        out = rows.mapInArrow(run, schema)
        return out.select(*[F.col(h).alias(c) for c, h in position.items()], "kept_text", "n_lines", "n_dropped")
