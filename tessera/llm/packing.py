"""Packing by vector bin packing with the dot-product heuristic.

Examples go into sequences under three limits at once: tokens, segments and
loss-bearing tokens. A sequence is filled by taking, among the examples that fit
in every dimension, the one with the largest dot product of its demand and the
room that is left (both relative to the limits). When none fits whole, or one
segment is left, an example is cut so that it fills the room, and its rest goes
back to the pool. Examples longer than a sequence first give their full
sequences.

Each task packs the rows of its own input partition, a bounded pool at a time,
so there is no shuffle and at most one partly filled sequence per task.
Sequence ids are the partition number times 2**33 plus a running number.

Defined results: a null text is empty; an empty example with no end id makes no
piece; a null or repeated id changes nothing, each row is its own example.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import CACHE_BYTES, SLICE_BYTES, ItemTokenizer, batch_column, given_back, text_slices

POOL_TOKENS = 2_000_000     # waiting tokens of a task before sequences are filled


class Packer:
    """Pool of waiting pieces by (tokens, loss-bearing tokens) and the sequence
    being filled. A piece is (example, start, end); ``loss_from`` of an example
    is the first of its tokens that bears loss."""

    def __init__(self, tokens: int, segments: int, loss: int):
        self.cap = np.array([tokens, segments, loss], dtype=np.float64)
        self.max_tokens, self.max_segments, self.max_loss = tokens, segments, loss
        self.kinds: dict[tuple[int, int], list] = {}
        self.size = np.empty((0, 2), dtype=np.int64)
        self.order: list[tuple[int, int]] = []
        self.left = np.empty(0, dtype=np.int64)
        self.waiting = 0
        self.places: dict[tuple[int, int], int] = {}
        self.sequence, self.open, self.filling = 0, None, 0

    @staticmethod
    def loss(start: int, end: int, loss_from: int) -> int:
        return max(0, end - max(start, loss_from))

    def add(self, example, start: int, end: int, loss_from: int) -> None:
        if end <= start:
            return
        key = (end - start, self.loss(start, end, loss_from))
        if key not in self.kinds:
            self.kinds[key] = []
            self.places[key] = len(self.order)
            self.order.append(key)
            self.size = np.vstack([self.size, key])
            self.left = np.append(self.left, 0)
        self.kinds[key].append((example, start, end, loss_from))
        self.left[self.places[key]] += 1
        self.waiting += end - start

    def _take(self, kind: int):
        self.left[kind] -= 1
        piece = self.kinds[self.order[kind]].pop()
        self.waiting -= piece[2] - piece[1]
        return piece

    def _choose(self, room: list[int]) -> int:
        """The fitting kind with the largest dot product; -1 if none fits."""
        tokens, loss = self.size[:, 0], self.size[:, 1]
        fits = (self.left > 0) & (tokens <= room[0]) & (loss <= room[2])
        if not fits.any():
            return -1
        score = tokens * (room[0] / self.cap[0] ** 2) + loss * (room[2] / self.cap[2] ** 2) \
            + room[1] / self.cap[1] ** 2
        return int(np.argmax(np.where(fits, score, -1.0)))

    def fill(self, until: int = 0):
        """Yield (example, start, end, sequence, offset) until at most ``until``
        tokens wait. With until = 0 everything is placed."""
        while self.waiting > until:
            if self.open is None:
                self.open = [self.max_tokens, self.max_segments, self.max_loss]
                self.filling = self.sequence
                self.sequence += 1
            room = self.open
            kind, cut = self._choose(room), 0
            whole = kind >= 0 and (room[1] > 1 or self.size[kind, 0] == room[0])
            if not whole:
                longer = np.flatnonzero((self.left > 0) & (self.size[:, 0] > room[0]))
                if len(longer):
                    kind = int(longer[np.argmax(self.size[longer, 0])])
                    cut = room[0]
                elif kind < 0:          # the loss-bearing limit stands in the way
                    over = np.flatnonzero(self.left > 0)
                    kind, cut = int(over[0]), int(self.size[over[0], 0])
            example, start, end, loss_from = self._take(kind)
            if cut:
                stop = min(end, start + cut)
                if self.loss(start, stop, loss_from) > room[2]:
                    stop = max(start, loss_from) + room[2]
                if stop < end:
                    self.add(example, stop, end, loss_from)
                end = stop
            if end > start:
                yield example, start, end, self.filling, self.max_tokens - room[0]
                room[0] -= end - start
                room[1] -= 1
                room[2] -= self.loss(start, end, loss_from)
            if room[0] == 0 or room[1] == 0 or room[2] == 0 or end == start:
                self.open = None


def pack_documents(df: DataFrame, path: str, end_id: int | None = 0, max_tokens: int = 1024,
                   max_segments: int = 32, max_loss: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text", loss_from_col: str | None = None,
                   with_ids: bool = False, slice_bytes: int = SLICE_BYTES,
                   cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Tokenize and pack: one row per piece with doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, segment loss tokens and, if
    ``with_ids``, the ids (little-endian unsigned 32-bit).

    ``loss_from_col``: number of leading tokens of an example that bear no loss
    (the prompt of instruction data); null or no column: every token bears loss.
    ``slice_bytes`` and ``cache_bytes`` bound the text handled at once and a
    generation of a worker's token cache: less memory for more work, the same rows.
    """
    max_loss = max_loss or max_tokens
    cols = [F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    cols.append((F.coalesce(F.col(loss_from_col).cast("long"), F.lit(0)) if loss_from_col else F.lit(0).cast("long"))
                .alias("loss_from"))
    src = df.select(*cols)
    id_type = src.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]

    def run(batches):
        tok = ItemTokenizer.load(path, cache_bytes)
        packer = Packer(max_tokens, max_segments, max_loss)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        waiting: dict[int, list] = {}            # example -> [id, ids, pieces still waiting, doc tokens, first]
        serial, id_arrow = 0, None
        rows: list[tuple] = []

        def place(until):
            for ex, s, e, seq, off in packer.fill(until):
                doc = waiting[ex]
                ids = doc[1][s - doc[4]:e - doc[4]]
                yield (doc[0], s, e - s, zlib.crc32(ids.astype("<u4").tobytes()), doc[3], base + seq, off,
                       Packer.loss(s, e, doc[5])) + ((ids.astype("<u4").tobytes(),) if with_ids else ())
                doc[2] -= e - s
                if not doc[2]:
                    del waiting[ex]

        def out(rows):
            cols = list(zip(*rows)) if rows else [[]] * (len(names) + with_ids)
            arrays = [pa.array(cols[0], type=id_arrow)] + [pa.array(c, type=pa.int64()) for c in cols[1:8]]
            if with_ids:
                arrays.append(pa.array(cols[8], type=pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * with_ids)

        for batch in batches:
            doc_ids, text = batch_column(batch, "doc_id"), batch_column(batch, "text")
            loss_from = batch_column(batch, "loss_from").to_numpy(zero_copy_only=False)
            id_arrow = doc_ids.type
            for a, b in text_slices(text, slice_bytes):
                ids, off = tok.encode(text.slice(a, b - a))
                for k, doc in enumerate(doc_ids.slice(a, b - a).to_pylist()):
                    one = ids[off[k]:off[k + 1]]
                    if end_id is not None:
                        one = np.append(one, np.asarray([end_id], dtype=one.dtype))
                    lf, n = max(0, int(loss_from[a + k])), len(one)
                    if not n:
                        continue
                    whole = n // max_tokens * max_tokens if max_loss >= max_tokens else 0
                    for s in range(0, whole, max_tokens):
                        piece = one[s:s + max_tokens].astype("<u4").tobytes()
                        rows.append((doc, s, max_tokens, zlib.crc32(piece), n, base + packer.sequence, 0,
                                     Packer.loss(s, s + max_tokens, lf)) + ((piece,) if with_ids else ()))
                        packer.sequence += 1
                    if whole < n:
                        waiting[serial] = [doc, one[whole:].copy(), n - whole, n, whole, lf]
                        for s in range(whole, n, max_tokens):
                            packer.add(serial, s, min(n, s + max_tokens), lf)
                        serial += 1
                    if packer.waiting > POOL_TOKENS:
                        rows.extend(place(POOL_TOKENS // 2))
                    if len(rows) >= 5000:
                        yield out(rows)
                        rows = []
        for row in place(0):
            rows.append(row)
            if len(rows) >= 5000:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)

    schema = (f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              f"offset long, loss_tokens long" + (", ids binary" if with_ids else ""))
    return src.mapInArrow(lambda batches: given_back(run(batches)), schema)
