"""Language identification by cross-parsing entropy.

Per language a suffix automaton over its labelled sample recognises every substring of the sample. A text is parsed from
left to right into the longest phrases that the automaton knows (a character unknown to it is a phrase); the fewer phrases
a text needs, the closer it is to the sample. Phrases times log2(sample length) per character are the cross-parsing
entropy, and the language with the lowest wins.

Sample: per language at most ``sample_docs`` labelled documents (those with the smallest hashes of doc_id) and of their
joined texts at most ``sample_chars`` characters. This bound is a parameter and holds for fitting alone. Prediction reads
whole texts, normalised: lower case, anything but letters becomes one space.

All segments (``segment`` characters) of a batch step through the automaton together, each from the start state. Phrases do
not end with their segment: then each segment is walked again from the state in which the one before it ended, until it
stands where the first walk stood at the same place, from where both are one; a segment whose end changed so is carried on
into the next. The counts are those of one walk over the whole text.

Every letter of the samples has a symbol. The most frequent ones have a column in a dense table, as many as fit all
languages' tables into ``table_bytes``; transitions by the others are looked up in a sorted list.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without any labelled text every text is
``und``; null labels are not learned; repeated rows are predicted each on its own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 48
    sample_chars: int = 40_000
    segment: int = 512
    #: Of the dense tables of all languages together.
    table_bytes: int = 64_000_000


#: Code points below this are looked up in a table of symbols, others in a dictionary.
TABLE = 1 << 16

#: Places of each segment at which the first walk's state is kept, for the second to meet it.
KEPT = 64


def normalised(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of each state; state 0 is the start (Blumer et al., 1985)."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        p, last = last, new
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p < 0:
            continue
        q = nexts[p][c]
        if length[q] == length[p] + 1:
            link[new] = q
            continue
        twin = len(nexts)
        nexts.append(dict(nexts[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = link[new] = twin
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = twin
            p = link[p]
    return nexts


@dataclass
class Automaton:
    """Steps are 4 * (next state * width) + phrases that end in this step."""

    #: At [state * width + symbol], for symbols below width.
    dense: np.ndarray
    #: state * width * symbols + symbol of the transitions by other symbols, sorted, and their steps; by symbol the start's way, 0 if none.
    keys: np.ndarray
    steps: np.ndarray
    starts: np.ndarray

    def step(self, state: np.ndarray, symbol: np.ndarray, width: int, rare: bool) -> np.ndarray:
        """state: state * width."""
        if not rare:
            return self.dense[state + symbol]
        out = self.dense[state + np.where(symbol < width, symbol, 1)]
        at = np.flatnonzero(symbol >= width)
        s, c = state[at].astype(np.int64), symbol[at]
        where = np.minimum(np.searchsorted(self.keys, s * len(self.starts) + c), max(0, len(self.keys) - 1))
        known = self.keys[where] == s * len(self.starts) + c if len(self.keys) else np.zeros(len(at), bool)
        # no way on: the phrase ends here and the next begins with this character, itself a phrase where it is unknown
        anew = np.where(self.starts[c] > 0, self.starts[c], 1) + (s > 0)
        out[at] = np.where(known, self.steps[where] if len(self.keys) else 0, anew)
        return out


@dataclass
class Model:
    langs: list[str]
    #: Symbol of each code point below TABLE, and of further ones: 1 unknown, 2 space, then letters; -1: no letter.
    symbols: np.ndarray
    further: dict[int, int]
    automata: list[Automaton]
    bits: np.ndarray
    width: int
    segment: int


def fit(samples: dict[str, str], s: Settings) -> Model:
    """samples: normalised text of each language."""
    counts: dict[str, int] = {}
    for t in samples.values():
        for c in t:
            counts[c] = counts.get(c, 0) + 1
    counts.pop(" ", None)
    chars = [" ", *sorted(counts, key=lambda c: (-counts[c], c))]
    at = {c: i + 2 for i, c in enumerate(chars)}
    symbols = np.full(TABLE, -1, np.int32)
    for cp in range(TABLE):
        low = chr(cp).lower()
        if len(low) == 1 and low.isalpha() or chr(cp).isalpha():
            symbols[cp] = at.get(low, 1)
    langs = sorted(samples)
    ways = [suffix_automaton(samples[lang]) for lang in langs]
    width = max(4, min(len(chars) + 2, s.table_bytes // (4 * max(1, sum(map(len, ways))))))
    automata = []
    for nexts in ways:
        root = nexts[0]
        restart = np.array([0, 1] + [4 * root[c] * width if c in root else 1 for c in chars], np.int64)
        table = np.tile(restart[:width] + 1, (len(nexts), 1))
        table[0] = restart[:width]
        rare: dict[int, int] = {}
        for state, of_state in enumerate(nexts):
            for c, n in of_state.items():
                if at[c] < width:
                    table[state, at[c]] = 4 * n * width
                else:
                    rare[state * width * len(restart) + at[c]] = 4 * n * width
        kind = np.int32 if 4 * len(nexts) * width + 4 < 1 << 31 else np.int64
        keys = np.array(sorted(rare), np.int64)
        automata.append(Automaton(table.ravel().astype(kind), keys, np.array([rare[k] for k in keys.tolist()], kind), np.where(restart % 4 == 0, restart, 0).astype(kind)))
    return Model(langs, symbols, {ord(c): i for c, i in at.items() if ord(c) >= TABLE}, automata, np.array([np.log2(max(2, len(samples[x]))) for x in langs]), width, s.segment)


def symbols_of(text: str, m: Model) -> np.ndarray:
    """The text's symbols, runs of non-letters as one space, none at the ends; empty without a letter."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    sym = m.symbols[np.minimum(points, TABLE - 1)]
    if len(points) and points.max() >= TABLE:
        for i in np.flatnonzero(points >= TABLE):
            c = chr(points[i])
            sym[i] = m.further.get(ord(c.lower()) if len(c.lower()) == 1 else points[i], 1) if c.isalpha() else -1
    gap = sym < 0
    keep = ~gap
    if not keep.any():
        return sym[:0]
    keep[1:] |= gap[1:] & ~gap[:-1]
    sym[gap] = 2
    out = sym[keep]
    return out[: -1 if out[-1] == 2 else None]


def phrases(texts: list[np.ndarray], m: Model) -> np.ndarray:
    """Phrases that each text (rows) needs in each language (columns)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    per = -(-sizes // m.segment)
    owner = np.repeat(np.arange(len(texts)), per)
    grid = np.zeros((len(owner), m.segment), np.int32)
    flat, row = grid.ravel(), 0
    for t, n in zip(texts, per.tolist()):
        flat[row * m.segment : row * m.segment + len(t)] = t
        row += n
    number = np.arange(len(owner)) - (np.cumsum(per) - per)[owner]
    lengths = np.minimum(m.segment, sizes[owner] - m.segment * number)
    # the longest segments first: those at their end drop off the lockstep from behind
    order = np.argsort(-lengths, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    grid, lengths, owner = np.ascontiguousarray(grid[order].T), lengths[order], owner[order]
    rare = (grid >= m.width).any(axis=1)
    live = np.searchsorted(-lengths, -np.arange(m.segment), side="left")
    before = np.where(number > 0, place[np.arange(len(order)) - 1], -1)[order] if len(order) else order
    after = np.full(len(order), -1)
    after[before[before >= 0]] = np.flatnonzero(before >= 0)
    out = np.zeros((len(texts), len(m.langs)), np.int64)
    for k, automaton in enumerate(m.automata):
        end, count = _parsed(automaton, grid, lengths, live, rare, before, after, m.width)
        count = count + (end > 0) * (after < 0)  # a text's last phrase ends with it
        out[:, k] = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
    return out


def _parsed(automaton: Automaton, grid: np.ndarray, lengths: np.ndarray, live: np.ndarray, rare: np.ndarray, before: np.ndarray, after: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The state in which each segment (a column of grid) ends, and the phrases that end in it."""
    rows = grid.shape[1]
    state, count = np.zeros(rows, automaton.dense.dtype), np.zeros(rows, np.int32)
    kept = min(KEPT, len(grid))
    states, counts = np.zeros((kept, rows), state.dtype), np.zeros((kept, rows), np.int32)
    for i, n in enumerate(live.tolist()):
        if not n:
            break
        step = automaton.step(state[:n], grid[i, :n], width, rare[i])
        count[:n] += step & 3
        state[:n] = step >> 2
        if i < kept:
            states[i, :n], counts[i, :n] = state[:n], count[:n]
    end, total = state.copy(), count.copy()
    todo = np.flatnonzero(before >= 0)
    todo = todo[end[before[todo]] > 0]
    while len(todo):
        ended, at, s = end[todo].copy(), todo, end[before[todo]]
        c = np.zeros(len(at), np.int32)
        for i in range(len(grid)):
            over = lengths[at] <= i
            if i and i <= kept:
                met = ~over & (s == states[i - 1, at])
                end[at[met]], total[at[met]] = state[at[met]], c[met] + count[at[met]] - counts[i - 1, at[met]]
            else:
                met = np.zeros(len(at), bool)
            end[at[over]], total[at[over]] = s[over], c[over]
            on = ~(over | met)
            at, s, c = at[on], s[on], c[on]
            if not len(at):
                break
            step = automaton.step(s, grid[i, at], width, rare[i])
            c += step & 3
            s = step >> 2
        end[at], total[at] = s, c
        changed = todo[end[todo] != ended]
        todo = np.sort(after[changed][after[changed] >= 0])
    return end, total


def learn(labelled: DataFrame, s: Settings = Settings()) -> Model:
    """labelled: doc_id, text, lang. Only the bounded sample of each language reaches the driver."""
    from pyspark.sql import Window

    rows = labelled.where("lang is not null and text is not null").select("lang", F.substring("text", 1, s.sample_chars).alias("text"), F.xxhash64(F.lit("sample"), "doc_id").alias("h"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("r") <= s.sample_docs)
    joined: dict[str, str] = {}
    for r in sorted(ranked.collect(), key=lambda r: (r["lang"], r["r"])):
        t = normalised(r["text"])
        if t:
            joined[r["lang"]] = f"{joined[r['lang']]} {t}" if r["lang"] in joined else t
    return fit({k: v[: s.sample_chars] for k, v in joined.items()}, s)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in keep, lang_pred and score (0 to 1: how far the runner-up's entropy lies above the winner's)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    types = {f.name: f.dataType for f in docs.schema.fields}

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            langs: list[str] = []
            scores: list[float] = []
            texts = batch.column(0).to_pylist()
            for lo in range(0, len(texts), 2000):
                part = [symbols_of(t, m) if t else np.empty(0, np.int16) for t in texts[lo : lo + 2000]]
                if not m.langs:
                    langs += ["und"] * len(part)
                    scores += [0.0] * len(part)
                    continue
                sizes = np.array([len(t) for t in part])
                entropy = phrases(part, m) * m.bits / np.maximum(1, sizes)[:, None]
                first = entropy.argmin(axis=1)
                ranked = np.sort(entropy, axis=1)
                sure = 1 - ranked[:, 0] / np.maximum(1e-12, ranked[:, 1]) if len(m.langs) > 1 else np.ones(len(part))
                langs += [m.langs[i] if n else "und" for i, n in zip(first.tolist(), sizes.tolist())]
                scores += np.where(sizes > 0, np.clip(sure, 0, 1), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names[1:], "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType()
    for c in ("doc_id", *keep):
        schema.add(c, types[c])
    schema.add("lang_pred", StringType()).add("score", DoubleType())
    return map_arrow(docs.select("text", "doc_id", *keep), predicted, schema)
