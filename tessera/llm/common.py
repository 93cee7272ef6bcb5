"""Helpers shared by the operators: reading tables, bounded slices of Arrow
batches, and an exact cached tokenizer front end for space-separated items."""

from __future__ import annotations

import ctypes
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tessera.session import ship_package

SLICE_BYTES = 8 << 20      # text handled at once inside a task
CACHE_BYTES = 80 << 20     # of a token cache or a cache generation, objects included
TOGETHER = 4000            # parts encoded as one text
WHITE = (r"\s\x00-\x1f\x{0085}\x{00A0}\x{1680}\x{180E}\x{2000}-\x{200F}\x{2028}\x{2029}\x{202F}"
         r"\x{205F}\x{3000}\x{FEFF}")      # white space as any of the libraries understands it, and some more


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def given_back(batches):
    """The batches of a task; at its end memory that is free goes back to the
    system, since workers live on and share an executor's."""
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named by their places, and that name of each, so
    that no column clashes with those an operator adds."""
    names = {c: f"__c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def free_prefix(wanted: str, columns) -> str:
    """``wanted`` with underscores before it until no column begins with it."""
    while any(c.lower().startswith(wanted) for c in columns):
        wanted = "_" + wanted
    return wanted


def text_slices(col, limit: int = SLICE_BYTES):
    """Yield (start, stop) row ranges of an Arrow string column whose texts hold
    about ``limit`` bytes; one row above the limit is a range of its own."""
    n = len(col)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False))
    i = 0
    while i < n:
        before = sizes[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield i, j
        i = j


def batch_column(batch: pa.RecordBatch, name: str):
    col = batch.column(batch.schema.get_field_index(name))
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


class TwoGenerations:
    """A bounded cache: a full young generation becomes the old one, and what is
    used again moves back to the young one."""

    def __init__(self, size: int = CACHE_BYTES):
        self.size, self.held, self.young, self.old = size, 0, {}, {}

    def get(self, key):
        v = self.young.get(key)
        if v is None:
            v = self.old.get(key)
            if v is not None:
                self.put(key, v)
        return v

    def put(self, key, value):
        if self.held >= self.size:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[key] = value
        self.held += 180 + len(key) + (len(value) if isinstance(value, bytes) else 0)


class ItemCache:
    """Token ids of parts, as one Arrow array of parts and one pool of ids. Above
    ``size`` bytes (with what a look-up takes) only the parts of the last slice stay."""

    def __init__(self, size: int, dtype):
        self.size, self.dtype = size, dtype
        self.keep(pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, dtype))

    def keep(self, keys, count, ids) -> None:
        self.keys, self.count, self.ids = keys, count, ids
        self.start = np.cumsum(count) - count

    def held(self) -> int:
        return self.keys.nbytes + self.ids.nbytes + 64 * len(self.keys)

    def add(self, keys, count, ids) -> None:
        if len(keys):
            self.keep(pa.concat_arrays([self.keys, keys]), np.concatenate([self.count, count]),
                      np.concatenate([self.ids, ids]))

    def trim(self, used) -> None:
        """``used``: places of the parts that the last slice held."""
        if self.held() > self.size:
            self.keep(self.keys.take(pa.array(used)), self.count[used],
                      gathered(self.ids, self.start[used], self.count[used]))


def gathered(pool: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` from ``start``, of ``count`` entries each, one after the other."""
    ends = np.cumsum(count)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=pool.dtype)
    for a in range(0, len(count), 250_000):         # bounded index arrays
        c = count[a:a + 250_000]
        lo, hi = int(ends[a] - c[0]), int(ends[a + len(c) - 1])
        shift = start[a:a + 250_000] - (ends[a:a + 250_000] - c - lo)
        at = np.repeat(shift, c)
        at += np.arange(hi - lo)
        np.take(pool, at, out=out[lo:hi])
    return out


class ItemTokenizer:
    """Token ids of whole texts by the tokenizers library, for byte-level BPE
    files whose pattern puts one leading space to the word after it.

    A text is cut at single spaces. When no item is empty or ends in white
    space, an item with its leading space is tokenized alike wherever it stands.
    Items are cut further into parts that the pattern separates wherever they
    stand, and each part that the cache lacks is encoded once: parts without inner
    white space many at a time, a line break between them, which is a token of its
    own there. Any other text, and any text that holds an added token, goes to the
    library as it is.
    """

    _loaded: dict = {}

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 65536 else "<u4")
        self.cache = ItemCache(cache_bytes, self.dtype)
        line = self.tok.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None

    @classmethod
    def load(cls, path: str, cache_bytes: int = CACHE_BYTES) -> "ItemTokenizer":
        """The tokenizer a worker keeps for ``path``; another cache size takes its place."""
        if path not in cls._loaded or cls._loaded[path].cache.size != cache_bytes:
            cls._loaded[path] = cls(path, cache_bytes)
        return cls._loaded[path]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, parts) -> tuple[np.ndarray, np.ndarray]:
        """(ids per part, ids of all parts) for an Arrow array of parts."""
        simple = pc.match_substring_regex(parts, f"^ ?[^{WHITE}]+$").to_numpy(zero_copy_only=False).astype(bool)
        if self.line is None:
            simple[:] = False
        count, pools, order = np.zeros(len(parts), dtype=np.int64), [], []
        at = np.flatnonzero(simple)
        for a in range(0, len(at), TOGETHER):
            some = at[a:a + TOGETHER]
            ids = self._encode(["\n".join(parts.take(pa.array(some)).to_pylist())])[0]
            ends = np.append(np.flatnonzero(ids == self.line), len(ids))
            if len(ends) != len(some):
                raise ValueError("a part holds a line break's token")
            count[some] = np.diff(ends, prepend=-1) - 1
            pools.append(np.delete(ids, ends[:-1]))
            order.append(some)
        at = np.flatnonzero(~simple)
        for a in range(0, len(at), 20_000):
            some = at[a:a + 20_000]
            ids = self._encode(parts.take(pa.array(some)).to_pylist())
            count[some] = [len(x) for x in ids]
            pools += ids
            order.append(some)
        if not order:
            return count, np.empty(0, self.dtype)
        order, pool = np.concatenate(order), np.concatenate(pools)
        start = np.empty(len(parts), dtype=np.int64)
        start[order] = np.cumsum(count[order]) - count[order]
        return count, gathered(pool, start, count)

    @staticmethod
    def parts(keys) -> tuple[pa.Array, np.ndarray]:
        """Items (an Arrow array) as parts that the pattern separates wherever they
        stand, with their number in each item: the words around one line break, and
        full stops or commas after a letter."""
        off = np.frombuffer(keys.buffers()[1], dtype=np.int64)[keys.offset:keys.offset + len(keys) + 1]
        data = keys.buffers()[2]
        if not len(keys) or off[-1] == off[0]:
            return keys, np.ones(len(keys), dtype=np.int64)
        buf = np.frombuffer(data, dtype=np.uint8)[:off[-1]]

        # one line break between two words
        broken = np.unique(np.searchsorted(off, np.flatnonzero(buf[off[0]:] == 10) + off[0], side="right") - 1)
        two = pc.match_substring_regex(keys.take(pa.array(broken)), f"^ ?[^{WHITE}]+\n[^{WHITE}]+$")
        two = two.to_numpy(zero_copy_only=False).astype(bool)
        whole = np.zeros(len(keys), dtype=bool)             # other items with line breaks stay as they are
        whole[broken[~two]] = True
        cut = np.zeros(len(buf) + 1, dtype=bool)
        cut[off[:-1]] = True
        inner = np.zeros(len(keys), dtype=bool)
        inner[broken[two]] = True
        line = np.flatnonzero(buf == 10)
        line = line[line >= off[0]]
        line = line[inner[np.searchsorted(off, line, side="right") - 1]]
        cut[line] = cut[line + 1] = True

        # full stops and commas at the end of a word, after a letter
        stop = (buf == ord(".")) | (buf == ord(","))
        ends = np.concatenate([line, off[1:][~whole]])
        ends = ends[(ends > off[0]) & stop[np.maximum(ends - 1, 0)]]
        word = np.maximum.accumulate(np.where(stop, -1, np.arange(len(buf))))       # last other byte up to here
        first = np.maximum.accumulate(np.where(cut[:-1], np.arange(len(buf)), 0))   # start of its part
        last = word[ends - 1]
        ok = last >= first[ends - 1]
        ends, last = ends[ok], last[ok]
        byte = buf[last]
        letter = ((byte | 32) >= ord("a")) & ((byte | 32) <= ord("z"))
        far = np.flatnonzero(byte >= 128)
        if len(far):                                        # the last character before, of up to four bytes
            begin = last[far].copy()
            for _ in range(3):
                begin -= (buf[begin] & 0xC0) == 0x80
            span = np.stack([begin, last[far] + 1], axis=1).ravel()
            o = np.argsort(span[::2], kind="stable")
            span = span.reshape(-1, 2)[o]
            chars = pa.array([bytes(buf[a:b]) for a, b in span], pa.binary()).cast(pa.string())
            letter[far[o]] = pc.match_substring_regex(chars, r"^\p{L}$").to_numpy(zero_copy_only=False).astype(bool)
        cut[last[letter] + 1] = True

        # an empty item is a part of its own
        empty = off[:-1] == off[1:]
        cut[off[-1]] = False
        begin = np.flatnonzero(cut)
        item = np.searchsorted(off, begin, side="right") - 1
        number = np.bincount(item, minlength=len(keys))
        number[empty] = 1
        if empty.any():
            begin = np.sort(np.concatenate([begin, off[:-1][empty]]), kind="stable")
        offsets = pa.py_buffer(np.append(begin, off[-1]).astype(np.int64))
        return pa.LargeStringArray.from_buffers(len(begin), offsets, data), number

    def _items(self, keys) -> tuple[np.ndarray, np.ndarray]:
        """(ids per item, ids of all items) for an Arrow array of items."""
        parts, number = self.parts(keys)
        coded = parts.dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.cache.keys)
        missing = coded.dictionary.filter(place.is_null())
        used = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        used[used < 0] = len(self.cache.keys) + np.arange(len(missing))
        self.cache.add(missing, *self._encode_parts(missing))
        at = used[coded.indices.to_numpy(zero_copy_only=False)]
        count = self.cache.count[at]
        pool = gathered(self.cache.ids, self.cache.start[at], count)
        self.cache.trim(used)
        return np.add.reduceat(count, np.cumsum(number) - number) if len(count) else count, pool

    def plain(self, col) -> np.ndarray:
        """True where the items of a text can be encoded one by one."""
        odd = pc.match_substring_regex(col, r"(^|[\s\x00-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
                                            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]) | $")
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(col, s))
        return ~odd.to_numpy(zero_copy_only=False).astype(bool)

    def encode(self, col) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets) for a slice of an Arrow string column;
        null is the empty text."""
        col = pc.fill_null(col, "")
        n = len(col)
        ok = self.plain(col)
        if ok.all():
            return self._encode_plain(col)
        rows: list = [None] * n
        at = np.flatnonzero(ok)
        if len(at):
            ids, off = self._encode_plain(col.take(pa.array(at)))
            for k, i in enumerate(at):
                rows[i] = ids[off[k]:off[k + 1]]
        for i in np.flatnonzero(~ok):
            rows[i] = self._encode([col[int(i)].as_py()])[0]
        off = np.zeros(n + 1, dtype=np.int64)
        np.cumsum([len(r) for r in rows], out=off[1:])
        return (np.concatenate(rows) if n else np.empty(0, self.dtype)), off

    def _encode_plain(self, col) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(col, " ")
        first = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.slice(first[0], first[-1] - first[0])
        first = first - first[0]
        # items after a space and items that start a text are different keys
        coded = flat.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.cast(pa.large_string())
        heads = words.take(pa.array(index[first[:-1]]))
        index[first[:-1]] = len(words) + np.arange(len(heads))
        space = pa.scalar("", pa.large_string()), words, pa.scalar(" ", pa.large_string())
        size, pool = self._items(pa.concat_arrays([pc.binary_join_element_wise(*space), heads]))
        start = np.cumsum(size) - size
        count = size[index]
        ends = np.cumsum(count)
        off = np.zeros(len(col) + 1, dtype=np.int64)
        off[1:] = np.where(first[1:] > 0, ends[np.maximum(first[1:] - 1, 0)], 0) if len(ends) else 0
        return gathered(pool, start[index], count), off
