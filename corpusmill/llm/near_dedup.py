"""Near duplicates by a signature-coordinate inverted join.

1. Each text becomes its set of distinct word shingles. Its signature has ``coordinates`` values, each hashed from ``fold``
   seeded minima over the set, so two sets of similarity J agree in a coordinate with odds J ** fold: unlike texts, which
   share common shingles, meet under hardly any value. Texts with equal sets form one class, a node.
2. A node is posted under its coordinate-value pairs (a value is hashed with its coordinate). Pairs are ranked by how many
   nodes hold them, and by the prefix principle a node needs to be posted only under its ``coordinates - matches + 1``
   rarest: two signatures that agree in ``matches`` coordinates share one of those. Pairs that a single node holds have
   nobody to meet and are not shipped.
3. Merging a list starts at its hub, the member whose values most nodes hold (an original stands before its altered
   copies). Every member meets the hub of each of its lists, collisions are counted, and pairs with ``matches`` or more join
   their nodes into families. Rows grow with the postings, never with a list's square.
4. Lists that still hold several families are merged in blocks of bounded size: pairs of one family are skipped, of the
   others a block emits at most one link for each family that it joins. Now no pair above the match threshold crosses two
   families.
5. Each node's best hub is confirmed on the full sets; confirmed links make the parts of a family. Nodes outside their
   family's main part meet the whole family in blocks of bounded size, where pairs of one part are skipped, the others above
   the match threshold are confirmed on the full sets, and only links that join two parts leave the block.
6. Components of all confirmed links.

So every pair above the match threshold is either connected or compared on its full sets, while the rows that move grow
with the postings and the links, not with the pairs.

A pair at Jaccard similarity 0.8 agrees in fewer than 3 of 32 coordinates of three minima with odds of about 6e-8.

Defined cases: a text without words (null, empty or blank) is in no list and linked with nothing; fewer words than a
shingle's are one shingle. Every row gives a row: rows that repeat a doc_id are linked each by its own text. A component's id
is the smallest doc_id in it; null doc_ids do not count, and a component without any has a null id and keeps its rows.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, discard, map_arrow, ship_code, values_of, written
from .components import components


@dataclass(frozen=True)
class Settings:
    shingle_words: int = 5
    percent: int = 80
    coordinates: int = 32
    #: Minima that make the value of one coordinate.
    fold: int = 3
    matches: int = 3
    seed: int = 20240607


class Shingler:
    """64-bit hashes of a text's distinct word shingles, sorted. Word hashes are remembered, up to a bounded number."""

    def __init__(self, words: int, most: int = 200_000):
        import xxhash

        self.words, self.most, self.known = words, most, {}
        self.of_word, self.of_set = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = text.encode().translate(LOWER_TABLE).split() if text else []
        if not tokens:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in tokens:
            if w not in known:
                known[w] = self.of_word(w)
        h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        k = min(self.words, len(h))
        out = np.full(len(h) - k + 1, np.uint64(0x9E3779B97F4A7C15 * k & 0xFFFFFFFFFFFFFFFF))
        for i in range(k):
            out = mixed(out ^ h[i : len(h) - k + 1 + i]) + np.uint64(i)
        out.sort()
        return out[np.append(True, out[1:] != out[:-1])]

    def key(self, shingles: np.ndarray) -> bytes | None:
        return self.of_set(shingles.tobytes()) if len(shingles) else None


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Shingles of the texts that are signed together; a longer text is signed alone.
SIGNED = 30_000


def signed(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """Values of all coordinates of each set (none empty); factors: coordinates x fold."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), len(factors)), np.uint64)
    for c, of_one in enumerate(factors):
        value = np.full(len(sets), np.uint64(c + 1))
        for f in of_one:
            value = mixed(value ^ np.minimum.reduceat(flat * f, starts))
        out[:, c] = value
    return out.view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with a key by which a row is found again: its doc_id, or the hash of its text where it has none."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return docs.select("doc_id", F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.xxhash64("text")).alias("row_key"), "text")


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, unnamed, row_key, n_shingles, set_key, sig) per row; set_key is null and sig empty where the set is."""

    def signing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(s.shingle_words)
        rng = np.random.default_rng(s.seed)
        factors = rng.integers(1, 1 << 63, (s.coordinates, s.fold), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            keys, sizes, values, held = [], [], [], []
            for text in values_of(batch.column(3)):
                u = shingles(text)
                keys.append(shingles.key(u))
                sizes.append(len(u))
                if len(u):
                    held.append(u)
                    if sum(map(len, held)) >= SIGNED:
                        values.append(signed(held, factors))
                        held = []
            if held:
                values.append(signed(held, factors))
            ends = np.cumsum([0, *(s.coordinates * (n > 0) for n in sizes)])
            flat = np.concatenate(values).reshape(-1) if values else np.empty(0, np.int64)
            sig = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), sig], names=["doc_id", "unnamed", "row_key", "n_shingles", "set_key", "sig"])

    return map_arrow(keyed(docs), signing, "doc_id bigint, unnamed boolean, row_key bigint, n_shingles bigint, set_key binary, sig array<bigint>")


def classes_of(members: DataFrame) -> DataFrame:
    """(set_key, node, least, unnamed, row_key, n, sig, print) per distinct set. node: a number; least: the smallest doc_id; print: seven bits of each value."""
    rows = members.where("n_shingles > 0").groupBy("set_key")
    out = rows.agg(F.min(F.struct("unnamed", "row_key", F.col("n_shingles").alias("n"), "sig")).alias("r"), F.min("doc_id").alias("least")).select("set_key", "least", "r.*")
    return out.withColumn("print", F.transform("sig", lambda v: v.bitwiseAND(127).cast("tinyint"))).withColumn("node", F.monotonically_increasing_id())


def collisions(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))


def postings(classes: DataFrame, s: Settings) -> DataFrame:
    """(h, node, score) under each node's rarest coordinate-value pairs that another node holds too. score: how many hold its values, over all coordinates."""
    pairs = classes.select("node", F.explode("sig").alias("h"))
    shared = pairs.groupBy("h").agg(F.count("*").alias("held")).where("held > 1")
    ranked = (
        pairs.join(shared, "h")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("held", "h"))).alias("p"), F.sum("held").alias("score"))
        # pairs that nobody else holds are the rarest of all and take their part of the prefix
        .select("node", "score", F.slice("p", 1, F.greatest(F.lit(0), F.size("p") - (s.matches - 1))).alias("p"))
    )
    return ranked.select("node", "score", F.explode("p.h").alias("h"))


def _similar_size(a: Column, b: Column, s: Settings) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * s.percent


def hub_links(posted: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """(a, b, c, first): each node and the hubs of its lists with which it has c collisions, matches or more; first ranks the hubs."""
    # the hash keeps equal scores apart
    first = F.col("score") * (1 << 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))
    hubs = posted.groupBy("h").agg(F.max_by("node", first).alias("b"), F.max(first).alias("first"))
    met = posted.join(hubs, "h").where("node <> b").groupBy(F.col("node").alias("a"), "b").agg(F.max("first").alias("first"))
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("print").alias(f"print_{x}"))
    met = met.join(side("a"), "a").join(side("b"), "b").where(_similar_size(F.col("n_a"), F.col("n_b"), s))
    return met.select("a", "b", collisions(F.col("print_a"), F.col("print_b")).alias("c"), "first").where(F.col("c") >= s.matches)


#: Rows of one side of a block of a list, and shingles of one side of a block of a family.
LIST_BLOCK = 4_000
BLOCK = 300_000


def dealt(rows: DataFrame, group: str, part: str, weight: Column, block: int) -> DataFrame:
    """Rows of groups with several parts, dealt to blocks (group, i, j, inner) so that each two rows of different parts meet in one.

    The part with most rows is the main one; its rows meet only rows of other parts. first marks a block's one side, or
    all rows of an inner block, where one side meets itself.
    """
    parts = rows.groupBy(group, part).agg(F.count("*").alias("held"), F.sum(weight).alias("weight"))
    whole = parts.groupBy(group).agg(F.max_by(part, F.struct("held", part)).alias("main"), F.sum("weight").alias("weight"), F.max_by("weight", F.struct("held", part)).alias("main_weight"), F.count("*").alias("parts")).where("parts > 1")
    blocks = whole.select(group, "main", F.ceil(F.col("main_weight") / block).cast("int").alias("m"), F.ceil((F.col("weight") - F.col("main_weight")) / block).cast("int").alias("r"))
    x = rows.join(blocks, group).withColumn("main", F.col(part) == F.col("main"))
    x = x.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("m")).otherwise(F.col("r"))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    meet = lambda i, j, inner, first: F.struct(i.alias("i"), j.alias("j"), F.lit(inner).alias("inner"), first.alias("first"))
    with_rest = F.transform(every(F.col("r")), lambda k: meet(F.least(k, F.col("own")), F.greatest(k, F.col("own")), True, F.col("own") <= k))
    with_main = F.transform(every(F.col("m")), lambda k: meet(F.col("own"), k, False, F.lit(True)))
    of_main = F.transform(every(F.col("r")), lambda k: meet(k, F.col("own"), False, F.lit(False)))
    return x.select(*rows.columns, F.explode(F.when(F.col("main"), of_main).otherwise(F.concat(with_rest, with_main))).alias("x")).select(*rows.columns, "x.*")


def spanning(nodes: np.ndarray, roots: np.ndarray, prints: np.ndarray, sizes: np.ndarray, first: np.ndarray, s: Settings, linked: Callable | None) -> tuple[list[int], list[int]]:
    """Places of links between the two sides of a block (one side against itself where it has only one), none between roots that are joined already.

    linked(i, places): which of the places are truly linked with i; None takes all above the match threshold.
    """
    alone, roots = bool(first.all()), roots.copy()
    a, b = [], []
    for i in np.flatnonzero(first):
        other = (np.arange(len(nodes)) > i) if alone else ~first
        open_ = np.flatnonzero(other & (roots != roots[i]) & (np.minimum(sizes, sizes[i]) * 100 >= s.percent * np.maximum(sizes, sizes[i])))
        if not len(open_):
            continue
        agree = (prints[open_] == prints[i]).sum(axis=1)
        open_ = open_[np.argsort(-agree, kind="stable")][: int((agree >= s.matches).sum())]
        for lo in range(0, len(open_), 64):
            some = open_[lo : lo + 64]
            some = some[roots[some] != roots[i]]
            for k in some if linked is None or not len(some) else some[linked(i, some)]:
                if roots[k] != roots[i]:
                    a.append(int(i))
                    b.append(int(k))
                    roots[roots == roots[k]] = roots[i]
    return a, b


def _side(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The block with each node once for each side, by node; and its prints as a matrix."""
    nodes, first = table.column("node").to_numpy(), table.column("first").to_numpy()
    order = np.lexsort((first, nodes))
    new = np.append(True, (np.diff(nodes[order]) != 0) | (np.diff(first[order]) != 0))
    table = table.take(pa.array(order[new]))
    return table, table.column("print").combine_chunks().flatten().to_numpy().reshape(len(table), -1)


def across_families(posted: DataFrame, families: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """(a, b): families to be joined, because members of one list in both collide often enough."""
    x = posted.select("h", "node").join(families, "node", "left").withColumn("family", F.coalesce("family", "node"))
    lists = x.groupBy("h").agg(F.min("family").alias("p"), F.max("family").alias("q")).where("p <> q").select("h")
    x = x.join(lists, "h").join(classes.select("node", "n", "print"), "node")

    def joined(table: pa.Table) -> pa.Table:
        table, prints = _side(table)
        family = table.column("family").to_numpy()
        a, b = spanning(table.column("node").to_numpy(), family, prints, table.column("n").to_numpy(), table.column("first").to_numpy(), s, None)
        return pa.table({"a": pa.array(family[a], pa.int64()), "b": pa.array(family[b], pa.int64())})

    ship_code(x.sparkSession)
    return dealt(x, "h", "family", F.lit(1), LIST_BLOCK).groupBy("h", "i", "j", "inner").applyInArrow(joined, "a bigint, b bigint").distinct()


def within_families(trees: DataFrame, classes: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b): confirmed links that join parts of one family."""
    sized = trees.join(classes.select("node", "n", "print"), "node")
    blocks = dealt(sized, "family", "part", F.col("n"), BLOCK).join(texts, "node")

    def joined(table: pa.Table) -> pa.Table:
        table, prints = _side(table)
        shingles, nodes = Shingler(s.shingle_words), table.column("node").to_numpy()
        sets = [shingles(t) for t in table.column("text").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        flat, ends = np.concatenate(sets), np.cumsum(sizes)
        a, b = spanning(nodes, table.column("part").to_numpy(), prints, sizes, table.column("first").to_numpy(), s, lambda i, some: _linked(sets[i], flat, ends, sizes, some, s))
        return pa.table({"a": pa.array(nodes[a], pa.int64()), "b": pa.array(nodes[b], pa.int64())})

    ship_code(blocks.sparkSession)
    return blocks.groupBy("family", "i", "j", "inner").applyInArrow(joined, "a bigint, b bigint")


def _linked(one: np.ndarray, flat: np.ndarray, ends: np.ndarray, sizes: np.ndarray, some: np.ndarray, s: Settings) -> np.ndarray:
    """Which of the sets numbered in some reach the similarity with one."""
    owner = np.repeat(np.arange(len(some)), sizes[some])
    at = np.arange(len(owner)) + np.repeat(ends[some] - sizes[some] - (np.cumsum(sizes[some]) - sizes[some]), sizes[some])
    values = flat[at]
    place = np.searchsorted(one, values)
    place[place == len(one)] = 0
    both = np.bincount(owner, weights=one[place] == values, minlength=len(some)).astype(np.int64)
    return 100 * both >= s.percent * (len(one) + sizes[some] - both)


def confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(s.shingle_words)
        for batch in batches:
            kept = []
            last, x = None, None
            for ta, tb in zip(values_of(batch.column(2)), values_of(batch.column(3))):
                if tb != last:
                    last, x = tb, shingles(tb)
                y = shingles(ta)
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(both > 0 and 100 * both >= s.percent * (len(x) + len(y) - both))
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta")).join(_small(pairs), "a")
    return map_arrow(left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"), exact, "a bigint, b bigint")


#: Rows of a few ids (24 bytes at most) that a broadcast may hold.
MOST_SENT = 1_000_000


def _small(ids: DataFrame) -> DataFrame:
    """A table of ids, marked for broadcast if its counted rows are few: then the texts that it meets stay where they are. Beyond that Spark shuffles both."""
    return F.broadcast(ids) if ids.limit(MOST_SENT + 1).count() <= MOST_SENT else ids


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """(node, text) of the nodes: few documents have a near duplicate, and their texts are read several times."""
    named = written(nodes.join(classes.select("node", "set_key", "unnamed", "row_key"), "node"), "named")
    rows = keyed(docs).join(_small(named), ["unnamed", "row_key"]).select("node", "set_key", "text")

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose text makes the set (a doc_id may name several texts), once in each task."""
        shingles, given = Shingler(s.shingle_words), set()
        for batch in batches:
            kept = []
            for node, key, text in zip(*map(values_of, batch.columns)):
                kept.append(node not in given and shingles.key(shingles(text)) == key)
                if kept[-1]:
                    given.add(node)
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(2).filter(mask)], names=["node", "text"])

    out = written(map_arrow(rows, right, "node bigint, text string"), "texts")
    discard(named)
    return out


def joined_families(families: DataFrame, links: DataFrame) -> DataFrame:
    """Families after further links (a, b) between them; a node that is in no family yet is its own."""
    if not links.limit(1).count():
        return families
    top = components(links)
    every = families.union(top.select("node", F.col("node").alias("family"))).distinct()
    moved = every.join(top.select(F.col("node").alias("family"), "component"), "family", "left").select("node", F.coalesce("component", "family").alias("family"))
    return written(moved, "families")


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of docs."""
    members = written(signatures(docs, s), "signatures")
    classes = written(classes_of(members), "classes")
    posted = written(postings(classes, s), "postings")
    links = written(hub_links(posted, classes, s), "hub-links")
    grown = components(links)
    families = grown.withColumnRenamed("component", "family")
    extra = written(across_families(posted, families, classes, s), "extra")
    discard(posted)
    families = joined_families(families, extra)
    texts = texts_of(families.select("node"), classes, docs, s)
    best = links.groupBy("a").agg(F.max_by("b", F.struct("c", "first")).alias("b"))
    sure = components(confirmed(best, texts, s))
    trees = written(families.join(sure, "node", "left").select("node", "family", F.coalesce("component", "node").alias("part")), "trees")
    inside = written(within_families(trees, classes, texts, s), "inside")
    # what is left joins parts: in each family fewer links than parts and blocks
    part = trees.select(F.col("node").alias("_n"), "part")
    between = inside.join(part, F.col("a") == F.col("_n")).select(F.col("part").alias("a"), "b")
    between = between.join(part, F.col("b") == F.col("_n")).select("a", F.col("part").alias("b"))
    top = components(between)
    label = trees.join(top.select(F.col("node").alias("part"), "component"), "part", "left").select("node", F.coalesce("component", "part").alias("label"))
    label = label.join(classes.select("node", "least"), "node")
    label = label.join(label.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("held")).where("held > 1"), "label")
    label = written(label.select("node", "component_id"), "labels")
    discard(links, extra, texts, grown, families, sure, trees, inside, top)
    of_class = classes.select("set_key", "node", "least").join(label, "node", "left").select("set_key", F.coalesce("component_id", "least").alias("c"))
    out = members.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left").select("doc_id", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("c")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
