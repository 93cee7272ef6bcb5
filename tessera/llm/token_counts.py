"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as a linked list of symbols (one per UTF-8 byte, the last one with
the end-of-word suffix). A heap holds the adjacent pairs by rank and place; the
lowest is popped and merged until no pair of the list has a rank. The count is
the number of initial symbols minus the number of merges; no identifier is made.

Defined results: a null text counts as empty (0 bytes, 0 tokens); an added token
standing in a text counts as one token, as the library does by default; repeated
rows and null ids each keep their row. Every text is read whole.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import TwoGenerations, batch_column, text_slices

# Unicode White_Space, as the tokenizer's regular expressions understand \s
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in out:
            out[b], extra = chr(extra), extra + 1
    return [out[b] for b in range(256)]


def count_after_merges(symbols: list[str], ranks: dict) -> int:
    """Symbols left after merging the lowest-rank adjacent pair again and again
    (leftmost first among equal ranks)."""
    n = len(symbols)
    nxt, prv = [*range(1, n), -1], list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, i = heapq.heappop(heap)
        j = nxt[i]
        if symbols[i] is None or j < 0 or ranks.get((symbols[i], symbols[j])) != rank:
            continue                                  # the pair has changed since
        symbols[i] += symbols[j]
        symbols[j] = None
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        left -= 1
        for a, b in ((prv[i], i), (i, nxt[i])):
            if a >= 0 and b >= 0 and (r := ranks.get((symbols[a], symbols[b]))) is not None:
                heapq.heappush(heap, (r, a))
    return left


class MergeCounter:
    """Counts for a word-level BPE file with NFC, lower-casing, a removing split
    pattern, byte-level symbols and an end-of-word suffix."""

    _loaded: dict = {}

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.suffix = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        known = model["vocab"]
        self.inner = [s in known for s in self.symbols]
        self.last = [s + self.suffix in known for s in self.symbols]
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE))
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.added_text = added
        self.words, self.chunks = TwoGenerations(), TwoGenerations()

    @classmethod
    def load(cls, path: str) -> "MergeCounter":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def word(self, piece: str) -> int:
        n = self.words.get(piece)
        if n is None:
            raw = piece.encode("utf-8")
            s = [self.symbols[b] for b in raw[:-1] if self.inner[b]]
            if self.last[raw[-1]]:
                s.append(self.symbols[raw[-1]] + self.suffix)
            n = count_after_merges(s, self.ranks)
            if len(piece) <= 64:
                self.words.put(piece, n)
        return n

    def chunk(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")   # no final sigma rule
        return sum(map(self.word, self.pieces.findall(text.lower())))

    def text(self, text: str) -> int:
        parts = self.added.split(text) if self.added else [text]
        return len(parts) - 1 + sum(map(self.chunk, parts))

    def column(self, col) -> np.ndarray:
        """Counts for a slice of an Arrow string column: each distinct chunk
        between ASCII white space is counted once."""
        col = pc.fill_null(col, "")
        out = np.zeros(len(col), dtype=np.int64)
        special = np.zeros(len(col), dtype=bool)
        for s in self.added_text:
            special |= pc.match_substring(col, s).to_numpy(zero_copy_only=False).astype(bool)
        for i in np.flatnonzero(special):
            out[i] = self.text(col[int(i)].as_py())
        at = np.flatnonzero(~special)
        if not len(at):
            return out
        lists = pc.ascii_split_whitespace(col.take(pa.array(at)))
        first = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        first = first - first[0]
        tokens = np.zeros(len(coded.dictionary), dtype=np.int64)
        for i, w in enumerate(coded.dictionary.to_pylist()):
            n = self.chunks.get(w)
            if n is None:
                n = self.chunk(w)
                if len(w) <= 64:
                    self.chunks.put(w, n)
            tokens[i] = n
        run = np.concatenate([[0], np.cumsum(tokens[coded.indices.to_numpy(zero_copy_only=False)])])
        out[at] = run[first[1:]] - run[first[:-1]]
        return out


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A narrow job: no shuffle, nothing kept but a bounded cache per worker.
    """
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = MergeCounter.load(path)
        for batch in batches:
            ids, text = batch_column(batch, "doc_id"), batch_column(batch, "text")
            for a, b in text_slices(text):
                part = text.slice(a, b - a)
                n = counter.column(part)
                size = pc.fill_null(pc.binary_length(part), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(size), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
