"""Benchmark decontamination over a distributed positional inverted index.

The index is sharded by document: each task turns runs of whole documents into shards of about ``shard_tokens`` tokens and
stores, per shard, the postings of every training token (term hash, then its positions in order) as one row of a Parquet
table in the shared folder. No term, however common, is ever gathered over the corpus, and nothing is shuffled.

A search takes the benchmark's windows (10 words, or the whole of a shorter item). In each shard a window whose terms are
not all present is passed over; for the others the posting list of the rarest term, shifted back by the term's place in
the window, is intersected with the next rarer ones in turn. What is left are the exact phrase matches. Proximity matches
need all terms within ``slop`` words more than the window's length, in any order.

The benchmark travels to the tasks in blocks of about ``block_windows`` windows, so what is sent has a fixed bound; an item
of more words than that is cut, and neighbouring pieces share the words of the windows between them.

Terms are 64-bit hashes (odds of any clash among a million benchmark and a billion training terms: under 1e-4, and ten
in a row must clash to matter).

Defined cases: null texts have no words and are not contaminated; an item without words has no window; the windows of an
item without an id hit words as any others do, but name no item; repeated rows are judged each on its own; an empty benchmark leaves all documents clean; extra columns are ignored. A document longer than a
shard is a shard of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, map_arrow, values_of, written

#: Bytes of words stay (a-z, 0-9, all beyond ASCII), A-Z are lower-cased, all others become a space.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
INDEX_SCHEMA = "shard bigint, doc_ids array<bigint>, ends array<bigint>, terms binary, bounds binary, positions binary"
FOUND_SCHEMA = "doc_id bigint, n_words bigint, starts array<bigint>, stops array<bigint>, items array<bigint>, near_items array<bigint>, shard bigint, place bigint"


class Terms:
    """64-bit hashes of a text's words, remembered up to a bounded number."""

    def __init__(self, most: int = 400_000):
        import xxhash

        self.known, self.most, self.of_word = {}, most, xxhash.xxh3_64_intdigest

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().translate(WORD_TABLE).split() if text else []
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = self.of_word(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def build_index(docs: DataFrame, shard_tokens: int = 1 << 20) -> DataFrame:
    """The stored index: one row per shard."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        terms_of = Terms()
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        parts: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            order = np.argsort(tokens, kind="stable").astype(np.uint32)
            ranked = tokens[order]
            first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, np.int64)
            row = [[number], [list(ids)], [np.cumsum([len(p) for p in parts])], [ranked[first].tobytes()], [np.append(first, len(ranked)).astype(np.uint32).tobytes()], [order.tobytes()]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=[x.split()[0] for x in INDEX_SCHEMA.split(", ")])

        for batch in batches:
            for doc, text in zip(*map(values_of, batch.columns)):
                t = terms_of(text)
                ids.append(doc)
                parts.append(t)
                held += len(t) + 1
                if held >= shard_tokens:
                    yield shard()
                    number += 1
                    ids.clear()
                    parts.clear()
                    held = 0
        if ids:
            yield shard()

    return written(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), shards, INDEX_SCHEMA), "index")


@dataclass
class Windows:
    """Distinct windows of a block of items: terms as rows of codes into vocabulary, padded with -1; items of each window."""

    vocabulary: np.ndarray
    codes: np.ndarray
    lengths: np.ndarray
    items: list[list[int]]


def windows_of(items: list[tuple[int, str | None]], width: int) -> Windows:
    terms, owners = Terms(), {}
    for item, text in items:
        t = terms(text)
        n = min(width, len(t))
        for i in range(len(t) - n + 1 if n else 0):
            owners.setdefault(t[i : i + n].tobytes(), {})[item] = None
    rows = [np.frombuffer(k, np.uint64) for k in owners]
    vocabulary = np.unique(np.concatenate(rows)) if rows else np.empty(0, np.uint64)
    codes = np.full((len(rows), width), -1, np.int64)
    for r, t in zip(codes, rows):
        r[: len(t)] = np.searchsorted(vocabulary, t)
    return Windows(vocabulary, codes, np.array([len(t) for t in rows], np.int64), [list(v) for v in owners.values()])


def _within(sorted_list: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_list, wanted)
    at[at == len(sorted_list)] = 0
    return sorted_list[at] == wanted


def search_shard(row: dict, block: Windows, slop: int | None) -> Iterator[tuple]:
    """(doc_id, n_words, starts, stops, items, near_items, shard, place) of each document of a shard; starts and stops are of the matched windows, in words of the document."""
    ends = np.array(row["ends"], np.int64)
    begins = np.append(0, ends[:-1])
    terms, bounds, positions = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["bounds"], np.uint32), np.frombuffer(row["positions"], np.uint32)
    found: dict[int, tuple[list, list, set, set]] = {}
    if len(terms) and len(block.codes):
        at = np.searchsorted(terms, block.vocabulary)
        at[at == len(terms)] = 0
        there = terms[at] == block.vocabulary
        counts = np.where(there, bounds[at + 1].astype(np.int64) - bounds[at], 0)
        per = np.where(block.codes >= 0, counts[block.codes], 1 << 40)
        for w in np.flatnonzero(per.min(axis=1) > 0):
            n = int(block.lengths[w])
            order = np.argsort(per[w, :n], kind="stable")
            lists = {c: positions[bounds[at[c]] : bounds[at[c] + 1]].astype(np.int64) for c in block.codes[w, :n]}
            rarest = lists[block.codes[w, order[0]]]
            starts = rarest - order[0]
            for o in order[1:]:
                starts = starts[_within(lists[block.codes[w, o]], starts + o)]
                if not len(starts):
                    break
            if len(starts):
                doc = np.searchsorted(ends, np.maximum(starts, 0), side="right")
                good = (starts >= 0) & (starts + n <= ends[np.minimum(doc, len(ends) - 1)])
                for s, d in zip(starts[good].tolist(), doc[good].tolist()):
                    hit = found.setdefault(d, ([], [], set(), set()))
                    hit[0].append(s - int(begins[d]))
                    hit[1].append(s - int(begins[d]) + n)
                    hit[2].update(block.items[w])
            if slop is not None:
                for d in _near(rarest, [lists[c] for c in lists], n + slop, begins, ends):
                    found.setdefault(d, ([], [], set(), set()))[3].update(block.items[w])
    none = ([], [], (), ())
    for d, (doc, a, b) in enumerate(zip(row["doc_ids"], begins.tolist(), ends.tolist())):
        starts, stops, items, near = found.get(d, none)
        yield doc, b - a, starts, stops, sorted(x for x in items if x is not None), sorted(x for x in near if x is not None), row["shard"], d


def _near(rarest: np.ndarray, lists: list[np.ndarray], reach: int, begins: np.ndarray, ends: np.ndarray) -> list[int]:
    """Documents with a stretch of at most ``reach`` words that ends or begins within reach of the rarest term and holds all distinct terms."""
    doc = np.searchsorted(ends, rarest, side="right")
    out = set()
    live = np.ones(len(rarest), bool)
    for p in lists:  # a term with no occurrence within reach on either side rules the place out
        i = np.searchsorted(p, np.maximum(rarest - reach + 1, begins[doc]))
        nearest = p[np.minimum(i, len(p) - 1)]
        live &= (i < len(p)) & (nearest < np.minimum(rarest + reach, ends[doc]))
        if not live.any():
            return []
    for r, d in zip(rarest[live].tolist(), doc[live].tolist()):
        if d in out:
            continue
        for lo in range(max(r - reach + 1, int(begins[d])), r + 1):
            hi = min(lo + reach, int(ends[d]))
            if all((i := np.searchsorted(p, lo)) < len(p) and p[i] < hi for p in lists):
                out.add(d)
                break
    return sorted(out)


def pieces(benchmark: DataFrame, width: int, most: int) -> DataFrame:
    """(item_id, text) of the items, those of possibly more than ``most`` words cut into pieces of as many windows."""
    words = F.filter(F.split(ascii_lower(F.col("text")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    starts = lambda w: F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(w) - width) / most)).cast("int"))
    cut = let(words, lambda w: F.transform(starts(w), lambda j: F.array_join(F.slice(w, j * most + 1, most + width - 1), " ")))
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return named.select("item_id", F.explode(F.when(F.length("text") > 2 * most, cut).otherwise(F.array("text"))).alias("text"))


def search(index: DataFrame, benchmark: DataFrame, width: int = 10, slop: int | None = None, block_windows: int = 500_000) -> DataFrame:
    """One row per document: its matched windows (starts, stops, in words), the items that own them, and the items with a proximity match."""
    spark = index.sparkSession
    named = pieces(benchmark, width, block_windows)
    # a text of n characters has at most n // 2 + 1 words: the bound of a block is known before any is collected
    sizes = named.select((F.length("text") / 2 + 1).cast("long").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, -(-total // block_windows))
    found = None
    for i in range(n_blocks):
        mine = named if n_blocks == 1 else named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == i)
        sent = spark.sparkContext.broadcast(windows_of([tuple(r) for r in mine.collect()], width))

        def searched(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            for batch in batches:
                for k in range(len(batch)):
                    cols = list(zip(*search_shard(batch.slice(k, 1).to_pylist()[0], sent.value, slop)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in FOUND_SCHEMA.split(", ")])

        part = map_arrow(index, searched, FOUND_SCHEMA)
        found = part if found is None else found.union(part)
    if n_blocks > 1:  # the same document's matches of all blocks
        found = found.groupBy("doc_id", "n_words", "shard", "place").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops", "items", "near_items")))
        found = found.select(*(x.split()[0] for x in FOUND_SCHEMA.split(", ")))
    return found.drop("shard", "place")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any matched window), n_items, items_sha256, contaminated, n_near_items."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, shas, near = [], [], [], []
            for r in batch.select(["starts", "stops", "items", "near_items"]).to_pylist():
                total, reached = 0, 0
                for a, b in sorted(zip(r["starts"], r["stops"])):
                    total += max(0, b - max(a, reached))
                    reached = max(reached, b)
                items = sorted({str(x) for x in r["items"]})
                n_hit.append(total)
                n_items.append(len(items))
                shas.append(hashlib.sha256(",".join(items).encode()).hexdigest())
                near.append(len(set(r["near_items"])))
            long = pa.int64()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, long), pa.array(n_items, long), pa.array(shas), pa.array([n > 0 for n in n_hit]), pa.array(near, long)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"])

    return map_arrow(found, digested, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, n_near_items bigint")
