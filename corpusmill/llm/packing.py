"""Cost-balanced packing of whole documents into fixed-length training sequences.

A document's ids are the tokenizer's, followed by one end id. Documents are packed in blocks of a bounded number of
tokens, each inside one task and without a shuffle: the block's total length decides its sequences (full ones, and powers
of two for what is left), so no padding is needed at all. The cost of a piece of n ids is ``linear * n + quadratic * n**2``
(attention stays inside a piece). Pieces in descending length go to the lowest-cost sequence that has room; where none has
room for the whole piece, it is cut to fill the lowest-cost sequence with room left, and its rest goes on the same way.

A block is a run of rows of one input partition, so one key or source never gathers anywhere, and a task that is run again
gives the same rows. Sequence ids are unique over the table: partition number * 2**32 + a count within the partition.

Defined cases: null text is empty and packs as its end id alone; empty tables give no rows; repeated rows are each packed;
extra columns are ignored. A text longer than a block forms a block of its own.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
#: A word of Latin letters (all in composed form, with one-letter lower cases), then ASCII punctuation.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


class WordCache:
    """Ids of whole texts by way of their words: a word between spaces or line feeds is tokenized once and remembered.

    The tokenizer's pieces never cross white space, so the ids of a text are those of its words in turn. Only space and
    line feed are taken as word ends here; all else is left to the tokenizer. It lower-cases, and ends a piece between a
    letter and punctuation: so a word of Latin letters with ASCII punctuation behind is two pieces, which go straight to
    the tokenizer's model, without its normalizer. Anything else goes through the whole tokenizer.
    The memory is bounded: beyond ``most`` distinct words it starts afresh.
    """

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.pieces: dict[str, list[int]] = {}
        self.lengths = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            mapped = piece if piece.isascii() else self.bytes.pre_tokenize_str(piece)[0][0]
            ids = self.pieces[piece] = [t.id for t in self.tokenizer.model.tokenize(mapped)]
        return ids

    def _learn(self, new: list[str]) -> None:
        first, ids, hard = len(self.codes), [], []
        plain, pieces, make = PLAIN.fullmatch, self.pieces, self._piece
        for i, w in enumerate(new):
            if m := plain(w):
                core, tail = m.groups()
                core = core.lower()
                core = pieces.get(core) or make(core)
                ids.append(core + (pieces.get(tail) or make(tail)) if tail else core)
            else:
                hard.append(i)
                ids.append([])
        for i, e in zip(hard, self.tokenizer.encode_batch_fast([new[i] for i in hard], add_special_tokens=False)):
            ids[i] = e.ids
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        total = int(sizes.sum())
        while len(self.lengths) < first + len(new):
            self.lengths, self.starts = np.resize(self.lengths, 2 * len(self.lengths)), np.resize(self.starts, 2 * len(self.starts))
        while len(self.flat) < self.used + total:
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.lengths[first : first + len(new)] = sizes
        self.starts[first : first + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, total)
        self.used += total
        self.codes.update(zip(new, range(first, first + len(new))))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; texts: an Arrow array of strings without nulls."""
        if len(self.codes) > self.most:
            self._clear()
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        distinct, known = words.dictionary.to_numpy(zero_copy_only=False), self.codes
        codes = np.fromiter(map(known.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))
        if len(new := np.flatnonzero(codes < 0)):
            codes[new] = np.arange(len(known), len(known) + len(new))
            self._learn(distinct[new].tolist())
        codes = codes[words.indices.to_numpy()]
        sizes = self.lengths[codes]
        ends = np.cumsum(sizes, dtype=np.int64)
        flat = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[codes] - (ends - sizes), sizes)]
        bounds = np.append(0, ends)[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [flat[a:b] for a, b in itertools.pairwise(bounds)]


def capacities(total: int, width: int) -> list[int]:
    """Full sequences, then powers of two: their sum is the total, so nothing is padded."""
    rest, out = total % width, [width] * (total // width)
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], width: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece, by descending length to the lowest-cost sequence with room."""
    room = np.array(capacities(sum(lengths), width), np.int64)
    spent, used, out = np.zeros(len(room)), [0] * len(room), []
    todo = [(-min(width, n - a), d, a) for d, n in enumerate(lengths) for a in range(0, n, width)]
    heapq.heapify(todo)
    while todo:
        size, d, a = heapq.heappop(todo)
        n = -size
        costs = np.where(room >= n, spent, np.inf)
        s = int(costs.argmin())
        if room[s] < n:  # no sequence has room for all of it: cut, and fill the cheapest of those with room left
            s = int(np.where(room > 0, spent, np.inf).argmin())
        take = min(n, int(room[s]))
        out.append((d, a, take, s, used[s]))
        used[s] += take
        room[s] -= take
        spent[s] += linear * take + quadratic * take * take
        if take < n:
            heapq.heappush(todo, (take - n, d, a + take))
    return out


def pack(docs: DataFrame, tokenizer_path: str, width: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1.0 / 4096, block_tokens: int = 1 << 20) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = WordCache(tokenizer_path)
        first = TaskContext.get().partitionId() << 32
        waiting: list[tuple[int, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal first
            pieces = assign([len(ids) for _, ids in waiting], width, linear, quadratic)
            cols: list[list] = [[], [], [], [], [], [], []]
            for d, a, n, s, o in pieces:
                doc, ids = waiting[d]
                row = (doc, a, n, zlib.crc32(ids[a : a + n].astype("<u4").tobytes()), len(ids), first + s, o)
                for c, v in zip(cols, row):
                    c.append(v)
            first += 1 + max(p[3] for p in pieces)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo in range(0, len(texts), 2000):
                for doc, ids in zip(ids_of[lo : lo + 2000], words.encode(texts.slice(lo, 2000)), strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    waiting.append((doc, ids))
                    held += len(ids)
                    if held >= block_tokens:
                        yield flush()
                        held = 0
        if waiting:
            yield flush()

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))), packed, SCHEMA)
