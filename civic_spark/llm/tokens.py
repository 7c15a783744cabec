"""Token counts that follow edits.

A document's text is split into pre-tokens (the pattern of a byte-level BPE), which are encoded apart from each other.
``count_tokens`` keeps, per document, blocks of ``BLOCK`` pre-tokens as leaves of a segment tree of token sums.  An edit
re-encodes only the blocks it touches: splitting starts at the block that holds the last ``CONTEXT`` characters before
the edit, and ends at the first cut after the edit that is an old block's start, because from equal cuts on equal text
splits equally.  The new sums go into the touched leaves, and only the nodes above them are added up again.

The vocabulary is read once by the driver from a path that the caller names, and travels to the tasks with the
function (its size does not depend on the data).  Texts are never shuffled.

Defined results: null and empty texts have 0 tokens and an empty tree; null edits change nothing; edits are given in
code points of the text as it was, sorted or not, must not overlap, and are cut to the text's bounds.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
#: Characters before an edit that may belong to a pre-token it changes: the longest look ahead of the pattern is 3.
CONTEXT = 8
#: Byte-level BPE pre-tokens: contractions, words, numbers, other runs, white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 1 << 19
TREES = "doc_id long, text string, n_tokens long, n_pretokens long, block_chars array<int>, tree array<long>"
EDITED = TREES + ", reencoded long"
EDITS = "array<struct<start:int,stop:int,replacement:string>>"


class Counter:
    """Tokens per pre-token, remembered for the most recent vocabulary of words."""

    def __init__(self, vocabulary: bytes) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.known = regex.compile(PATTERN), {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 64:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[piece] = n
        return n


def heap(sums: np.ndarray) -> np.ndarray:
    """Segment tree of leaf sums as a heap: the root at 1, leaves at the end."""
    width = 1 << max(0, int(len(sums) - 1).bit_length())
    out = np.zeros(2 * width, np.int64)
    out[width:width + len(sums)] = sums
    for k in range(width - 1, 0, -1):
        out[k] = out[2 * k] + out[2 * k + 1]
    return out


class Document:
    """Text, block lengths in characters and the tree of their token sums."""

    def __init__(self, text: str, chars: np.ndarray, tree: np.ndarray, pieces: int) -> None:
        self.text, self.chars, self.tree, self.pieces, self.reencoded = text, chars, tree, pieces, 0

    @classmethod
    def build(cls, text: str, counter: Counter) -> Document:
        found = counter.pattern.findall(text)
        count = counter.count
        sums = np.fromiter(map(count, found), np.int64, len(found))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        starts = np.arange(0, len(found), BLOCK)
        if not len(found):
            return cls(text, np.zeros(0, np.int64), heap(np.zeros(0, np.int64)), 0)
        return cls(text, np.add.reduceat(lengths, starts), heap(np.add.reduceat(sums, starts)), len(found))

    @property
    def tokens(self) -> int:
        return int(self.tree[1])

    def edit(self, start: int, stop: int, replacement: str, counter: Counter) -> None:
        """Replaces text[start:stop]; edits must come from the text's end to its start."""
        n = len(self.text)
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        text = self.text[:start] + replacement + self.text[stop:]
        shift = len(text) - n
        if not len(self.chars):
            new = Document.build(text, counter)
            self.text, self.chars, self.tree, self.pieces = text, new.chars, new.tree, new.pieces
            self.reencoded += new.pieces
            return
        begins = np.concatenate(([0], np.cumsum(self.chars)))
        first = max(0, int(np.searchsorted(begins, max(0, start - CONTEXT), side="right")) - 1)
        first = min(first, len(self.chars) - 1)
        old_cuts = {int(b): k for k, b in enumerate(begins)}
        pieces, end, last = [], int(begins[first]), len(self.chars)
        for m in counter.pattern.finditer(text, end):
            pieces.append(m[0])
            end = m.end()
            if end - shift >= stop and old_cuts.get(end - shift, first) > first:
                last = old_cuts[end - shift]
                break
        self._splice(first, last, pieces, counter)
        self.text = text

    def _splice(self, first: int, last: int, pieces: list[str], counter: Counter) -> None:
        """Puts the re-encoded pieces into the leaves [first, last), empty blocks before them included."""
        last = max(last, first + 1)
        own = np.array_split(np.arange(len(pieces)), last - first)
        width = len(self.tree) // 2
        for leaf, part in zip(range(first, last), own, strict=True):
            self.chars[leaf] = sum(len(pieces[k]) for k in part)
            self.tree[width + leaf] = sum(counter.count(pieces[k]) for k in part)
        lo, hi = (width + first) // 2, (width + last - 1) // 2
        while lo:
            for k in range(lo, hi + 1):
                self.tree[k] = self.tree[2 * k] + self.tree[2 * k + 1]
            lo, hi = lo // 2, hi // 2
        self.reencoded += len(pieces)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, kind))


def _batch(ids: pa.Array, docs: list[Document], counts: list[int], edited: bool) -> pa.RecordBatch:
    columns = [ids, pa.array([d.text for d in docs], pa.string()), pa.array([d.tokens for d in docs], pa.int64()),
               pa.array(counts, pa.int64()), _lists([d.chars for d in docs], pa.int32()), _lists([d.tree for d in docs], pa.int64())]
    names = [x.split()[0] for x in TREES.split(", ")]
    if edited:
        columns, names = [*columns, pa.array([d.reencoded for d in docs], pa.int64())], [*names, "reencoded"]
    return pa.RecordBatch.from_arrays(columns, names=names)


#: Documents of an Arrow batch are returned in groups, so that trees and texts of few are held at a time.
GROUP = 256


def _build(vocabulary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP):
                batch = whole.slice(at, GROUP)
                docs = [Document.build(t or "", counter) for t in batch.column(1).to_pylist()]
                yield _batch(batch.column(0), docs, [d.pieces for d in docs], False)
    return run


def _edit(vocabulary: bytes):
    """Rows (TREES, edits, carried) to (EDITED, carried)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP):
                batch = whole.slice(at, GROUP)
                docs = []
                rows = zip(*(batch.column(k).to_pylist() for k in (1, 3, 6)), strict=True)
                for k, (text, pieces, edits) in enumerate(rows):
                    chars = np.array(batch.column(4)[k].values, dtype=np.int64)
                    tree = np.array(batch.column(5)[k].values, dtype=np.int64)
                    doc = Document(text or "", chars, tree, pieces)
                    for e in sorted(filter(None, edits or []), key=lambda e: (e["start"], e["stop"]), reverse=True):
                        doc.edit(e["start"], e["stop"], e["replacement"] or "", counter)
                    docs.append(doc)
                done = _batch(batch.column(0), docs, batch.column(3).to_pylist(), True)
                yield pa.RecordBatch.from_arrays([*done.columns, batch.column(7)], names=[*done.schema.names, "carried"])
    return run


def read_vocabulary(path: str) -> bytes:
    """A public rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return f.read()


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text, n_tokens, n_pretokens, block_chars, tree) of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_build(read_vocabulary(vocabulary)), TREES)


def apply_edits(trees: DataFrame, edits: str, vocabulary: str, carry: list[str] | None = None) -> DataFrame:
    """``trees`` (as from ``count_tokens``) after the edits of its column ``edits``, of type ``EDITS``.

    ``n_tokens``, ``text``, ``block_chars`` and ``tree`` are those of the edited text; ``n_pretokens`` stays that of
    the text before, ``reencoded`` counts the pre-tokens that were encoded again.  The columns named by ``carry`` come
    along unchanged in the struct ``carried``.
    """
    names = [x.split()[0] for x in TREES.split(", ")]
    carried = F.struct(*(carry or ["doc_id"])).alias("carried")
    rows = trees.select(*names, F.col(edits).cast(EDITS).alias("edits"), carried)
    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(_edit(read_vocabulary(vocabulary)), f"{EDITED}, carried {kind}")
