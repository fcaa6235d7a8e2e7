"""Cross-entropy difference between a target and a background language model (Moore and Lewis, 2010).

Both are word bigram models with one shared vocabulary, the same order and the same smoothing; they differ only in the
text they count. A document's score is the mean over its tokens of the background loss less the target loss, in bits: the
higher, the more the document resembles the target. Every counted word is in the vocabulary, every counted bigram is kept.

P(w | v) = (c(v, w) + prior * P(w)) / (c(v) + prior), with P(w) = (c(w) + 1) / (n + words + 1): Dirichlet smoothing.

A document that is itself part of the background is left out of it: its own counts are taken off before it is scored, or
else every text would look familiar to a model that has seen it.

The models grow with the corpora, so they are never gathered or broadcast. A corpus is cut into chunks of a bounded number
of tokens, each of which sends its distinct words and bigrams with their counts once. They are the counts and the questions
at the same time. N-grams are known by 64-bit hashes, even for words and odd for bigrams; ranges of hashes are buckets, as
many as make each hold about ``bucket`` tokens' n-grams, and a chunk's n-grams of one bucket are one packed row (sorted
hashes as differences, compressed). A bucket adds up the counts of its n-grams over all chunks and returns the sums in the
order in which they were asked, so hashes travel one way only. A frequent n-gram is one entry for each chunk.

Defined cases: a text without words scores 0.0 with no token; an empty corpus leaves a model that knows only smoothing;
repeated rows count and are scored each on its own; null doc_ids stay null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, map_arrow, written


@dataclass(frozen=True)
class Settings:
    prior: float = 50.0
    #: Tokens, and documents, after which a chunk ends.
    chunk: int = 800_000
    #: Tokens of both corpora for each bucket of n-grams.
    bucket: int = 500_000


@dataclass
class Model:
    #: Chunks of the corpora that the two models count.
    target: DataFrame
    background: DataFrame
    #: Tokens of target and background.
    totals: tuple[int, int]
    settings: Settings


class Words:
    """64-bit hashes (even) of white-space words, A-Z lower-cased, remembered up to a bounded number."""

    def __init__(self, most: int = 200_000):
        import xxhash

        self.known, self.most, self.of_word = {}, most, xxhash.xxh3_64_intdigest

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in turn, and how many each text has."""
        known, out, sizes = self.known, [], []
        for t in texts:
            words = t.encode().translate(LOWER_TABLE).split() if t else []
            for w in words:
                if w not in known:
                    known[w] = self.of_word(w) & ~1
            out.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
            sizes.append(len(words))
            if len(known) > self.most:
                known.clear()
        return np.concatenate(out) if out else np.empty(0, np.uint64), np.array(sizes, np.int64)


def followers(sizes: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n words has a word before it in its text."""
    out = np.ones(n, bool)
    starts = np.cumsum(sizes) - sizes
    out[starts[sizes > 0]] = False
    return out


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (before * np.uint64(0x9E3779B97F4A7C15) + word) | np.uint64(1)


def chunked(texts: DataFrame, most: int) -> DataFrame:
    """One row per run of documents of one task: their ids and sizes, the chunk's distinct words, and the place of each token among them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, chunk = Words(), TaskContext.get().partitionId() << 32
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        tokens = rows = 0

        def row() -> pa.RecordBatch:
            distinct, codes = np.unique(np.concatenate([h for _, h, _ in held]), return_inverse=True)
            ids, sizes = [i for x, _, _ in held for i in x], np.concatenate([n for _, _, n in held])
            blobs = (sizes.tobytes(), distinct.tobytes(), pa.compress(codes.astype(np.uint32).tobytes(), "zstd", asbytes=True))
            cols = [pa.array([chunk], pa.int64()), pa.array([len(codes)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in blobs)]
            return pa.RecordBatch.from_arrays(cols, names=["chunk", "tokens", "ids", "sizes", "words", "codes"])

        for batch in batches:
            for lo in range(0, len(batch), 200):
                ids, texts = (c.slice(lo, 200).to_pylist() for c in batch.columns)
                hashes, sizes = words(texts)
                held.append((ids, hashes, sizes))
                tokens, rows = tokens + len(hashes), rows + len(sizes)
                if tokens >= most or rows >= most:
                    yield row()
                    held.clear()
                    chunk, tokens, rows = chunk + 1, 0, 0
        if held:
            yield row()

    ids = F.col("doc_id").cast("long") if "doc_id" in texts.columns else F.lit(None).cast("long")
    return map_arrow(texts.select(ids.alias("doc_id"), "text"), cut, "chunk bigint, tokens bigint, ids array<bigint>, sizes binary, words binary, codes binary")


class Chunk:
    """A chunk's tokens, and its distinct n-grams: words first, then bigrams."""

    def __init__(self, sizes: bytes, words: bytes, codes: bytes):
        self.sizes, self.words = np.frombuffer(sizes, np.int64), np.frombuffer(words, np.uint64)
        n, width = int(self.sizes.sum()), max(1, len(self.words))
        self.codes = np.frombuffer(pa.decompress(codes, n * 4, "zstd", asbytes=True), np.uint32).astype(np.int64)
        self.follows = followers(self.sizes, n)
        pairs, self.at = np.unique((self.codes[:-1] * width + self.codes[1:])[self.follows[1:]], return_inverse=True)
        self.keys = np.concatenate([self.words, pair_hash(*(self.words[x] for x in divmod(pairs, width)))])
        counts = np.concatenate([np.bincount(self.codes, minlength=len(self.words)), np.bincount(self.at, minlength=len(pairs))])
        self.order = np.argsort(self.keys)
        self.sorted_keys, self.sorted_counts = self.keys[self.order], counts[self.order]

    def by_place(self, values: np.ndarray) -> np.ndarray:
        """Values of the n-grams in the order of their hashes, by their places."""
        out = np.empty(len(values), np.float64)
        out[self.order] = values
        return out


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte: high bytes are mostly zero and take no space."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unpacked(blob: bytes, n: int, kind: type) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view(kind).ravel()


ASKED = "bucket bigint, chunk bigint, n bigint, keys binary, counts binary"


def asked(chunks: DataFrame, buckets: int) -> DataFrame:
    """The distinct n-grams of each chunk, packed by bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                chunk, *blobs = (c[row].as_py() for c in batch.columns)
                c = Chunk(*blobs)
                bucket = ((c.sorted_keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                ends = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1 if len(bucket) else []
                begin, rows = 0, []
                for end in ends:
                    k = c.sorted_keys[begin:end]
                    rows.append((int(bucket[begin]), chunk, end - begin, packed(np.diff(k, prepend=np.uint64(0))), packed(c.sorted_counts[begin:end].astype(np.int64))))
                    begin = end
                if rows:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=[x.split()[0] for x in ASKED.split(", ")])

    return map_arrow(chunks.select("chunk", "sizes", "words", "codes"), ask, ASKED)


def _answered(table: pa.Table) -> pa.Table:
    """Sums over one bucket, for each row that asks: of the target, and of the rest of the background, in the order of its n-grams."""
    rows = [dict(zip(table.column_names, r)) for r in zip(*(c.to_pylist() for c in table.columns))]
    keys = np.concatenate([np.cumsum(unpacked(r["keys"], r["n"], np.uint64)) for r in rows])
    counts = [unpacked(r["counts"], r["n"], np.int64) for r in rows]
    distinct, at = np.unique(keys, return_inverse=True)
    held = np.repeat([r["kind"] for r in rows], [r["n"] for r in rows])
    n = np.concatenate(counts)
    sums = [np.bincount(at, weights=np.where(np.isin(held, kinds), n, 0), minlength=len(distinct)).astype(np.int64) for kinds in ((TARGET,), (OWN, BACKGROUND))]
    out, begin = [], 0
    words = int(((distinct & np.uint64(1) == 0) & (sums[0] + sums[1] > 0)).sum())
    for r, mine in zip(rows, counts):
        here = at[begin : begin + r["n"]]
        begin += r["n"]
        if r["kind"] in (OWN, NEW):
            out.append((r["bucket"], r["chunk"], r["n"], packed(sums[0][here]), packed(sums[1][here] - (mine if r["kind"] == OWN else 0)), words))
            words = 0
    if words:
        out.append((rows[0]["bucket"], None, 0, b"", b"", words))
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=["bucket", "chunk", "n", "t", "b", "words"])


#: What the rows of a bucket are: chunks of the background that are scored themselves, of the target, of a background that is not scored, and of other documents.
OWN, TARGET, BACKGROUND, NEW = range(4)


def learn(target: DataFrame, background: DataFrame, s: Settings = Settings()) -> Model:
    """Both tables have a column text; all their rows are counted. A background with doc_id can be scored itself."""
    chunks = [written(chunked(x, s.chunk), "chunks") for x in (target, background)]
    return Model(*chunks, tuple(int(x.agg(F.sum("tokens")).first()[0] or 0) for x in chunks), s)


def losses(c: Chunk, counts: np.ndarray, n: int, size: int, prior: float, own: bool) -> np.ndarray:
    """Loss in bits of each token. counts: of the chunk's n-grams, in the whole corpus of n tokens; own: each document's counts are among them and come off."""
    owner, first = np.repeat(np.arange(len(c.sizes)), c.sizes), len(c.words)
    place = np.zeros(len(c.codes), np.int64)  # of the bigram that ends in each token
    place[c.follows] = first + c.at
    before = np.roll(c.codes, 1)

    def seen(grams: np.ndarray) -> np.ndarray:
        return counts[grams].astype(np.float64)

    word, pair, context, total = seen(c.codes), np.where(c.follows, seen(place), 0.0), np.where(c.follows, seen(before), 0.0), np.float64(n)
    if own:
        _, which, held = np.unique(owner * first + c.codes, return_inverse=True, return_counts=True)
        mine = held[which]
        word, total = word - mine, total - c.sizes[owner]
        context = context - np.where(c.follows, np.roll(mine, 1), 0)
        _, which, held = np.unique((owner * len(counts) + place)[c.follows], return_inverse=True, return_counts=True)
        pair[c.follows] -= held[which]
    p = (word + 1) / (total + size + 1)
    return -np.log2((pair + prior * p) / (context + prior))


def score(model: Model, docs: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, target_loss and background_loss (bits per token) and score (background less target).

    Without docs, the documents of the background are scored, each left out of the counts; docs are others.
    """
    own, totals, s = docs is None, model.totals, model.settings
    chunks = model.background if own else written(chunked(docs, s.chunk), "chunks")
    buckets = max(1, sum(totals) // s.bucket)
    parts = [(chunks, OWN if own else NEW), (model.target, TARGET), *([] if own else [(model.background, BACKGROUND)])]
    rows = None
    for part, kind in parts:
        of_part = asked(part, buckets).withColumn("kind", F.lit(kind))
        rows = of_part if rows is None else rows.unionAll(of_part)
    answers = written(rows.groupBy("bucket").applyInArrow(_answered, "bucket bigint, chunk bigint, n bigint, t binary, b binary, words bigint"), "answers")
    size = int(answers.agg(F.sum("words")).first()[0] or 0)

    def scored(chunk: pa.Table, found: pa.Table) -> pa.Table:
        c = Chunk(*(chunk.column(x)[0].as_py() for x in ("sizes", "words", "codes")))
        found = found.sort_by("bucket")
        sums = [np.concatenate([np.empty(0, np.int64), *(unpacked(x, k, np.int64) for x, k in zip(found.column(name).to_pylist(), found.column("n").to_pylist()))]) for name in ("t", "b")]
        counts = c.by_place(sums[0]), c.by_place(sums[1] + (c.sorted_counts if own else 0))
        owner, n = np.repeat(np.arange(len(c.sizes)), c.sizes), np.maximum(1, c.sizes)
        a, b = (np.bincount(owner, weights=losses(c, x, m, size, s.prior, out), minlength=len(n)) / n for x, m, out in zip(counts, totals, (False, own)))
        return pa.Table.from_arrays([chunk.column("ids").combine_chunks().flatten(), pa.array(c.sizes), pa.array(a), pa.array(b), pa.array(b - a)], names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return chunks.groupBy("chunk").cogroup(answers.where("chunk is not null").groupBy("chunk")).applyInArrow(scored, "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double")
