"""Relations and qualifiers from phrases between mentions.

A phrase table is a trie over lower-cased tokens; a text's triggers are read off it from left to right, the longest first.
Sentence breaks are prefix counts and mentions are kept in two sorted orders, so a trigger finds its neighbours by
bisection. The work of a document stays inside one Arrow batch; nothing is shuffled.

Conventions: spans are (start, end inclusive, category). ``ancestors`` maps a class to its ancestors, itself included; a
category that it lacks has no opinion and passes every range.
"""

from __future__ import annotations

import string
from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import vocabulary as V
from corpusmill.functions.text import let
from corpusmill.plans.runtime import by_pieces

REACH = 15
BREAKS = (".", ";")
RELATION = "struct<name:string,fields:array<struct<name:string,value:string>>,description:string,negated:boolean,evidence:string>"

Span = tuple[int, int, str]


class Phrases:
    """A table of phrases with a key each, read greedily from left to right."""

    def __init__(self, rows: Sequence[tuple[str, str]]):
        self.trie: dict = {}
        for phrase, key in rows:
            node = self.trie
            for token in phrase.split():
                node = node.setdefault(token, {})
            if phrase and None not in node:
                node[None] = key

    def longest_at(self, low: Sequence[str], i: int) -> tuple[int, str] | None:
        """(tokens, key) of the longest phrase that begins at i."""
        node, best = self.trie, None
        for at in range(i, len(low)):
            node = node.get(low[at])
            if node is None:
                break
            if None in node:
                best = (at - i + 1, node[None])
        return best

    def scan(self, low: Sequence[str]) -> list[Span]:
        out, i = [], 0
        while i < len(low):
            hit = self.longest_at(low, i) if low[i] in self.trie else None
            if hit:
                out.append((i, i + hit[0] - 1, hit[1]))
            i += hit[0] if hit else 1
        return out


@dataclass
class Ranges:
    """Which classes a predicate's or qualifier's sides may have."""

    ancestors: Mapping[str, frozenset[str]]
    sides: Mapping[str, tuple[Sequence[str] | None, Sequence[str] | None]] = field(default_factory=lambda: {name: (head, tail) for name, head, tail in V.PREDICATE_RANGES})

    def __post_init__(self) -> None:
        self.known: dict[tuple[str, ...], frozenset[str]] = {}

    def classes(self, groups: Sequence[str]) -> frozenset[str]:
        key = tuple(groups)
        if key not in self.known:
            self.known[key] = self._classes(key)
        return self.known[key]

    def _classes(self, groups: Sequence[str]) -> frozenset[str]:
        return frozenset(c for g in groups for c in V.CLASS_GROUPS.get(g, (g,)))

    def allows(self, groups: Sequence[str] | None, category: str, strict: bool = False) -> bool:
        own = self.ancestors.get(category, frozenset())
        if not own:
            return not strict
        return groups is None or bool(own & self.classes(groups))

    def accepts(self, predicate: str, head: str, tail: str) -> bool:
        if predicate not in self.sides:
            return True
        a, b = self.sides[predicate]
        return self.allows(a, head) and self.allows(b, tail)


@dataclass
class Gazetteer:
    ancestors: Mapping[str, frozenset[str]]
    descriptions: Mapping[str, str] = field(default_factory=dict)
    extra: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        rows = list(V.PREDICATE_PHRASES)
        owners = dict(rows)
        for name, phrases in self.extra.items():
            for p in phrases:
                low = " ".join(p.lower().split())
                if not low:
                    raise ValueError(f"{name}: an empty phrase")
                if owners.setdefault(low, name) != name:
                    raise ValueError(f"the phrase {low!r} belongs to {owners[low]}")
                rows.append((low, name))
        self.triggers = Phrases(rows)
        self.contexts = Phrases(V.CONTEXT_PHRASES)
        self.cues = Phrases([(cue, slot) for cue, slot, _ in V.ENUM_CUES])
        self.values = {cue: value for cue, _, value in V.ENUM_CUES}
        self.negations = Phrases([(c, c) for c in V.NEGATION_CUES])
        self.ranges = Ranges(self.ancestors)

    def relations(self, tokens: Sequence[str], spans: Sequence[Span]) -> list[dict]:
        return _Reading(self, tokens, spans).relations()


class _Reading:
    """One token stream with its mentions."""

    def __init__(self, g: Gazetteer, tokens: Sequence[str], spans: Sequence[Span]):
        self.g, self.tokens, self.spans = g, tokens, spans
        # a null token parts two sections of a document
        self.low = [(t or "").lower() for t in tokens]
        self.breaks = [0]
        for t in tokens:
            self.breaks.append(self.breaks[-1] + (t is None or t in BREAKS))
        self.by_end = sorted(range(len(spans)), key=lambda i: (spans[i][1], -i))
        self.ends = [spans[i][1] for i in self.by_end]
        self.by_start = sorted(range(len(spans)), key=lambda i: (spans[i][0], i))
        self.starts = [spans[i][0] for i in self.by_start]
        cues = g.negations.scan(self.low)
        self.cue_starts, self.cue_pasts = [c[0] for c in cues], [c[1] + 1 for c in cues]

    def broken(self, a: int, b: int) -> bool:
        n = len(self.tokens)
        return self.breaks[max(min(b, n), 0)] > self.breaks[max(min(a, n), 0)] if a < b else False

    def before(self, start: int) -> Span | None:
        i = bisect_left(self.ends, start)
        return self.spans[self.by_end[i - 1]] if i else None

    def after(self, end: int) -> Span | None:
        i = bisect_right(self.starts, end)
        return self.spans[self.by_start[i]] if i < len(self.starts) else None

    def surface(self, s: Span) -> str:
        return " ".join(t for t in self.tokens[s[0] : s[1] + 1] if t is not None)

    def hollow(self, s: Span) -> bool:
        return not self.surface(s).strip(string.punctuation).strip()

    def relation(self, name: str, head: str, tail: str, negated: bool = False, described: str | None = None) -> dict:
        fields = [{"name": "head", "value": head}, {"name": "tail", "value": tail}]
        return {"name": name, "fields": fields, "description": self.g.descriptions.get(described or name), "negated": negated, "evidence": "asserted"}

    def negated(self, start: int, end: int) -> bool:
        """A cue begins before the trigger, ends no later than it, and no sentence ends between them."""
        k = bisect_left(self.cue_starts, start)
        # cues don't overlap: all but the last end before the trigger, and the later the fewer sentence ends between
        return any(past <= end and not self.broken(past, start) for past in self.cue_pasts[max(k - 2, 0) : k])

    def relations(self) -> list[dict]:
        out, seen, ends, tails = [], set(), [], set()
        for start, end, predicate in self.g.triggers.scan(self.low):
            head, tail = self.before(start), self.after(end)
            if not head or not tail or not self.g.ranges.accepts(predicate, head[2], tail[2]):
                continue
            near = start - head[0] <= REACH and tail[0] - end - 1 <= REACH
            if not near or self.broken(head[1] + 1, start) or self.broken(end + 1, tail[0]):
                continue
            a, b, key = self.surface(head), self.surface(tail), (predicate, *head[:2], *tail[:2])
            if self.hollow(head) or self.hollow(tail) or a.lower() == b.lower() or key in seen:
                continue
            seen.add(key)
            no = self.negated(start, end)
            out.append(self.relation(f"not_{predicate}" if no else predicate, a, b, no, predicate))
            ends += [head, tail]
            tails.add(tail)
        if ends:
            out += self.qualifiers(ends, tails) + self.values(ends, tails)
        return out

    def restates(self, s: Span, ends: list[Span]) -> bool:
        said = self.surface(s).lower()
        return any(s[0] <= e[1] and e[0] <= s[1] or self.surface(e).lower() == said for e in ends)

    @staticmethod
    def gap(a: Span, b: Span) -> int:
        return max(a[0] - b[1], b[0] - a[1], 0)

    def qualifiers(self, ends: list[Span], tails: set[Span]) -> list[dict]:
        ranges, announced = dict(V.CONTEXT_RANGES), {slot for _, slot in V.CONTEXT_PHRASES}
        found: dict[str, list[Span]] = {slot: [] for slot in ranges}
        for start, end, slot in self.g.contexts.scan(self.low):
            c = self.after(end)
            good = c is not None and c[0] - end - 1 <= REACH and not self.broken(end + 1, c[0]) and self.g.ranges.allows(ranges[slot], c[2]) and c[2] not in V.JUNK
            if good and not self.restates(c, ends) and not self.hollow(c):
                found[slot].append(c)
            elif end > start and ranges[slot] is None:
                said = (start, end, slot)  # the phrase is the value
                if not self.hollow(said) and not self.restates(said, ends):
                    found[slot].append(said)
        out = []
        for slot, allowed in V.CONTEXT_RANGES:
            if slot not in announced:
                found[slot] = [s for s in self.spans if self.g.ranges.allows(allowed, s[2], strict=True) and s[2] not in V.JUNK and not self.restates(s, ends) and not self.hollow(s)]
            hosted = [(self.gap(host, c), c[0], host[0], host[1], i, host, c) for i, c in enumerate(found[slot]) for host in [min(ends, key=lambda e: (self.gap(e, c), e not in tails))]]
            if hosted:
                *_, host, c = min(hosted)
                out.append(self.relation(slot, self.surface(host), self.surface(c)))
        return out

    def values(self, ends: list[Span], tails: set[Span]) -> list[dict]:
        first: dict[str, Span] = {}
        for cue in self.g.cues.scan(self.low):
            first.setdefault(cue[2], cue)
        sides = {slot: (side, window) for slot, side, window in V.ENUM_SLOTS}
        out = []
        for slot, cue in first.items():
            side, window = sides[slot]
            hosts = [e for e in ends if (e in tails) == (side == "tail")]
            if not hosts:
                continue
            host = min(hosts, key=lambda e: self.gap(e, cue))
            if self.gap(host, cue) <= window and not self.broken(min(host[1] + 1, cue[0]), max(cue[1] + 1, host[0])):
                out.append(self.relation(slot, self.surface(host), self.g.values[" ".join(self.low[cue[0] : cue[1] + 1])]))
        return out


def relations(spark: SparkSession, g: Gazetteer, tokens: Column, spans: Column) -> Column:
    """array of relations of each row; spans: array<struct<start, end, label>>."""

    def extract(words: list | None, marks: list | None) -> list[dict]:
        return g.relations(words, [(int(s["start"]), int(s["end"]), s["label"]) for s in marks]) if words is not None and marks else []

    return by_pieces(spark, extract, f"array<{RELATION}>")(tokens, spans)


def phrase_matches(docs, tokens: Column, rows: Sequence[tuple[str, str]]):
    """Every place where a phrase stands, before the greedy choice: doc columns, start, end, key. A hash join on the first token; each place carries only as many tokens as the longest phrase has."""
    spark = docs.sparkSession
    listed = F.broadcast(spark.createDataFrame([(p.split(), k) for p, k in rows], "phrase array<string>, key string").select("phrase", "key", F.element_at("phrase", 1).alias("first")))
    longest = max((len(p.split()) for p, _ in rows), default=1)
    placed = let(F.transform(tokens, lambda t: F.lower(t)), lambda low: F.transform(low, lambda t, i: F.struct(i.alias("start"), t.alias("first"), F.slice(low, i + 1, longest).alias("_run"))))
    met = docs.select("*", F.inline(placed)).join(listed, "first").where(F.slice("_run", 1, F.size("phrase")) == F.col("phrase"))
    return met.withColumn("end", F.col("start") + F.size("phrase") - 1).drop("_run", "first", "phrase")


def silent_predicates(emitted, spark: SparkSession, declared: Sequence[str]):
    """Declared predicates that no relation was made of."""
    names = emitted.select(F.explode("relations").alias("r")).select(F.regexp_replace("r.name", "^not_", "").alias("predicate")).distinct()
    return spark.createDataFrame([(d,) for d in declared], "predicate string").join(names, "predicate", "left_anti")
