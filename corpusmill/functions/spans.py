"""Span algebra as array expressions; greedy_longest and bridged are Arrow functions.

Token spans are array<struct<start, end, label>> with the end inclusive; character spans have an exclusive end; tokens with
places are array<struct<token, start, end>>.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .stemming import token_places
from .text import SPACES, let
from .vocabulary import SUFFIX_LEAST, SUFFIX_STOP, SUFFIXES, TAILS

SPAN = "struct<start:int,end:int,label:string>"


def _span(start: Column, end: Column, label: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), label.cast("string").alias("label"))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def valid_spans(spans: Column, n_tokens: Column) -> Column:
    return F.filter(spans, lambda s: (s["start"] >= 0) & (s["end"] >= s["start"]) & (s["end"] < n_tokens))


def surface(tokens: Column, start: Column, end: Column) -> Column:
    """Tokens start to end (inclusive), joined; empty past the tokens."""
    return F.array_join(F.slice(tokens, start + 1, F.greatest(end - start + 1, F.lit(0))), " ")


def surfaces(tokens: Column, spans: Column) -> Column:
    return let(tokens, lambda t: F.transform(spans, lambda s: surface(t, s["start"], s["end"])))


def occurrences(tokens: Column, mention: Column, label: Column) -> Column:
    """All places where the mention's tokens stand, whatever the case."""

    def of(low: Column) -> Column:
        def needle(m: Column) -> Column:
            n = F.size(m)
            at = F.filter(F.sequence(F.lit(0), F.size(low) - n), lambda i: F.slice(low, i + 1, n) == m)
            return F.when((n > 0) & (F.size(low) >= n), F.transform(at, lambda i: _span(i, i + n - 1, label))).otherwise(F.array().cast(f"array<{SPAN}>"))

        return let(F.filter(F.split(F.lower(mention), SPACES), lambda w: w != ""), needle)

    return let(F.transform(tokens, lambda t: F.lower(t)), of)


def iob_spans(tags: Column) -> Column:
    """Spans of IOB2 tags. An I- that does not continue its label begins a span; one that does continues the last span, even after an O."""

    def of(e: Column) -> Column:
        # the last span's label is that of the entity tag before
        fresh = lambda x, j: x["tag"].startswith("B-") | (j == 0) | (x["label"] != F.get(e, j - 1)["label"])
        firsts = F.filter(F.transform(e, lambda x, j: F.when(fresh(x, j), j)), lambda j: j.isNotNull())

        def spans(at: Column) -> Column:
            last = lambda k: F.coalesce(F.get(at, k + 1), F.size(e)) - 1
            return F.transform(at, lambda j, k: _span(F.get(e, j)["i"], F.get(e, last(k))["i"], F.get(e, j)["label"]))

        return let(firsts, spans)

    placed = F.transform(tags, lambda t, i: F.struct(t.alias("tag"), F.substring(t, 3, 1 << 20).alias("label"), i.alias("i")))
    return let(F.filter(placed, lambda t: t["tag"].startswith("B-") | t["tag"].startswith("I-")), of)


def normal_label(label: Column) -> Column:
    return F.btrim(F.replace(F.lower(label), F.lit("_"), F.lit(" ")))


def pascal_label(label: Column) -> Column:
    parts = F.filter(F.split(F.lower(label), r"[\s_/\-]+"), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20))), "")


def mapped_label(label: Column, table: Column) -> Column:
    """By the lower-cased, then by the normalised label. table: map<string, string>."""
    return F.coalesce(F.try_element_at(table, F.lower(label)), F.try_element_at(table, normal_label(label)))


def predicate_name(value: Column) -> Column:
    return F.translate(F.lower(F.btrim(value)), " -", "__")


def without_prefix(value: Column, prefix: str = "biolink:") -> Column:
    return F.regexp_replace(value, "^" + prefix, "")


def bridged(tokens: Column, spans: Column, text: Column) -> Column:
    """Character spans as token spans, by an Arrow function that finds each end by bisection.

    Out of the tokens' extent: dropped. White space at either end is passed over, what is then empty is dropped, and the
    rest becomes the run of all tokens that it touches. Order is kept, nothing is merged. Null in, null out.
    """

    def snap(placed: pa.Array, marked: pa.Array, texts: pa.Array) -> pa.Array:
        def sides(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            flat, sizes = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            places = (pc.fill_null(pc.struct_field(flat, name), -1).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("start", "end"))
            return *places, np.append(0, np.cumsum(sizes))

        (t0, t1, t_at), (s0, s1, s_at) = sides(placed), sides(marked)
        labels = pc.struct_field(marked.flatten(), "label")
        kept, first, last, counts = [], [], [], [0]
        for row, whole in enumerate(texts.to_pylist()):
            starts, ends = t0[t_at[row] : t_at[row + 1]], t1[t_at[row] : t_at[row + 1]]
            extent, whole = int(ends[-1]) if len(ends) else 0, whole or ""
            for k in range(s_at[row], s_at[row + 1]):
                a, b = int(s0[k]), int(s1[k])
                if 0 <= a < b <= extent:
                    piece = whole[a:b]
                    a, b = a + len(piece) - len(piece.lstrip()), b - len(piece) + len(piece.rstrip())
                    i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left")) - 1
                    if a < b and i <= j:
                        kept.append(k)
                        first.append(i)
                        last.append(j)
            counts.append(len(kept))
        made = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(last, pa.int32()), labels.take(pa.array(kept, pa.int64()))], names=["start", "end", "label"])
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), made, mask=pc.or_(placed.is_null(), marked.is_null()))

    typed = F.transform(spans, lambda s: _span(s["start"], s["end"], s["label"]))
    return F.arrow_udf(snap, f"array<{SPAN}>")(tokens, typed, text)


def in_tokens(text: str | None, marks: list[dict] | None) -> dict:
    """A text's tokens, and its character spans as ``bridged`` would place them on these. Null spans stay null."""
    tokens, starts, ends = token_places(text or "")
    out = None if marks is None else []
    for m in marks or ():
        a, b = (m["start"], m["end"]) if m and m["start"] is not None and m["end"] is not None else (-1, -1)
        if 0 <= a < b <= (ends[-1] if ends else 0):
            piece = text[a:b]
            a, b = a + len(piece) - len(piece.lstrip()), b - len(piece) + len(piece.rstrip())
            i, j = bisect_right(ends, a), bisect_left(starts, b) - 1
            if a < b and i <= j:
                out.append({"start": i, "end": j, "label": m["label"]})
    return {"tokens": tokens, "spans": out}


def linked_in_tokens(text: str | None, entities: list[dict] | None, rels: list[dict] | None) -> dict:
    """A text's tokens, its entities' spans under their types, and its relations with the surfaces of their ends.

    The id rides in the label, so that a span that is dropped can't shift the others' ids. Of equal ids the first counts.
    """
    made = in_tokens(text, entities and [e and {"start": e["start"], "end": e["end"], "label": e["id"]} for e in entities])
    types, named = {}, {}
    for e in entities or ():
        if e and e["id"] is not None:
            types.setdefault(e["id"], e["type"])
    for s in made["spans"] or ():
        if s["label"] is not None and s["label"] not in named:
            named[s["label"]] = " ".join(made["tokens"][s["start"] : s["end"] + 1])
    spans = entities if not entities else [s | {"label": types.get(s["label"])} for s in made["spans"]]
    ends = None if rels is None else [r and {**r, "head": named.get(r["arg1"]), "tail": named.get(r["arg2"])} for r in rels]
    return {"tokens": made["tokens"], "spans": spans, "rels": ends}


def greedy_longest(spans: Column) -> Column:
    """Non-overlapping spans: the longest first, then the leftmost, then the earliest in the input; returned by start."""

    def pick(lists: pa.Array) -> pa.Array:
        flat, sizes = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        starts, ends = (pc.struct_field(flat, name) for name in ("start", "end"))
        known = pc.and_(starts.is_valid(), ends.is_valid()).to_numpy(zero_copy_only=False)
        starts, ends = (pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (starts, ends))
        kept, counts, lo = [], [0], 0
        for n in sizes.tolist():
            a, b = starts[lo : lo + n], ends[lo : lo + n]
            places, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            first, last, owner = at[:n].tolist(), at[n:].tolist(), [-1] * len(places)
            # spans taken before are as long or longer: one that clashes covers an end of this one
            for i in np.lexsort((a, a - b)).tolist():
                p, q = first[i], last[i]
                if not known[lo + i]:
                    kept.append(lo + i)
                elif p > q:
                    if owner[p] < 0 or owner[p] != owner[q]:
                        kept.append(lo + i)
                elif owner[p] < 0 and owner[q] < 0:
                    owner[p : q + 1] = [i] * (q - p + 1)
                    kept.append(lo + i)
            counts.append(len(kept))
            lo += n
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat.take(pa.array(kept, pa.int64())), mask=lists.is_null())

    typed = F.transform(spans, lambda s: _span(s["start"], s["end"], s["label"]))
    return F.sort_array(F.arrow_udf(pick, f"array<{SPAN}>")(typed))


def secondary_labels(mention: Column) -> Column:
    """Labels that a mention's last word (its ending) or last two words give, in that order."""

    def of(w: Column) -> Column:
        last = F.element_at(w, -1)
        by_end = F.lit(None).cast("string")
        for suffix, label in reversed(SUFFIXES):
            by_end = F.when(last.endswith(suffix), label).otherwise(by_end)
        ending = F.when((F.length(last) >= SUFFIX_LEAST) & ~last.isin(*SUFFIX_STOP), by_end)
        two = F.array_join(F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), 2), " ")
        tail = F.create_map(*(F.lit(x) for pair in TAILS for x in pair))
        found = F.array(ending, F.coalesce(F.try_element_at(tail, two), F.try_element_at(tail, last)))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))

    return let(F.filter(F.split(F.lower(mention), SPACES), lambda x: x != ""), of)


def transposed(*lists: Column) -> Column:
    """Parallel lists as one list of structs; none where the lists differ in length or one is missing."""
    same = F.lit(True)
    for x in lists[1:]:
        same = same & (F.size(x) == F.size(lists[0]))
    return F.when(F.coalesce(same, F.lit(False)), F.arrays_zip(*lists))


def tags_of(values: Column, names: list[str]) -> Column:
    """Class numbers as tags; numbers outside the vocabulary are O."""
    listed = F.array(*(F.lit(n) for n in names))
    return F.transform(values, lambda v: F.when((v >= 0) & (v < len(names)), F.get(listed, v.cast("int"))).otherwise(F.lit("O")))


def passage_text(passages: Column, gaps: bool = False) -> Column:
    """Passages (array<struct<offset, text>>) by offset; with gaps, up to each offset filled with spaces."""
    ordered = F.sort_array(passages)
    if not gaps:
        return F.array_join(F.transform(ordered, lambda p: p["text"]), "")
    return F.aggregate(ordered, F.lit(""), lambda acc, p: F.concat(acc, F.repeat(F.lit(" "), F.greatest(p["offset"] - F.length(acc), F.lit(0)).cast("int")), p["text"]))


def clustered(sentences: Column, clusters: Column) -> Column:
    """Mentions of each cluster as array<array<struct<mention, type>>>: places are of a sentence's tokens, the end exclusive; those outside their sentence are dropped."""

    def good(m: Column) -> Column:
        a, b = F.get(m["pos"], F.lit(0)), F.get(m["pos"], F.lit(1))
        inside = (m["sent_id"] >= 0) & (b <= F.size(F.get(sentences, m["sent_id"])))
        return F.coalesce((F.size(m["pos"]) == 2) & (a >= 0) & (a < b) & inside, F.lit(False))

    def named(m: Column) -> Column:
        a, b = F.get(m["pos"], F.lit(0)), F.get(m["pos"], F.lit(1))
        return F.struct(F.array_join(F.slice(F.get(sentences, m["sent_id"]), a + 1, b - a), " ").alias("mention"), m["type"].alias("type"))

    return F.transform(clusters, lambda c: F.transform(F.filter(c, good), named))


def without_slots(label: Column) -> Column:
    """A relation label without the mark that says which participant fills which slot."""
    return F.regexp_replace(label, r"\x20?\((?:e1,e2|e2,e1)\)$", "")


def index_run(indices: Column) -> Column:
    """Whether the places follow one another without a gap."""
    return F.forall(F.transform(F.slice(indices, 2, F.greatest(F.size(indices), F.lit(1))), lambda x, i: x - F.get(indices, i)), lambda d: d == 1) & (F.size(indices) > 0)


def tagged_pair(sentence: Column) -> Column:
    """struct<text, head, tail> of a sentence with one <e1>..</e1> and one <e2>..</e2>; null otherwise, or where both are the same."""
    once = F.lit(True)
    for tag in ("<e1>", "</e1>", "<e2>", "</e2>"):
        once = once & (F.regexp_count(sentence, F.lit(tag)) == 1)
    head = F.btrim(F.regexp_extract(sentence, "<e1>([^<]*)</e1>", 1))
    tail = F.btrim(F.regexp_extract(sentence, "<e2>([^<]*)</e2>", 1))
    good = once & (head != "") & (tail != "") & (F.lower(head) != F.lower(tail))
    return F.when(good, F.struct(F.btrim(F.regexp_replace(sentence, "</?e[12]>", "")).alias("text"), head.alias("head"), tail.alias("tail")))


def realigned(text: Column, value: Column) -> Column:
    """The value as it stands in the text at its first occurrence, whatever the case; null where it does not."""
    at = F.instr(F.lower(text), F.lower(value))
    return F.when(at > 0, F.substring(text, at, F.length(value)))


def brat_spans(ann: Column, text: Column) -> Column:
    """Spans of a stand-off annotation: T lines of three tab-separated fields, one piece, inside the text."""
    rows = F.filter(F.split(ann, "\n"), lambda r: r.rlike(r"^T[^\t]*\t\S+ \d+ \d+\t[^\t]*$"))
    spans = F.transform(rows, lambda r: _span(F.regexp_extract(r, r"^T[^\t]*\t\S+ (\d+) ", 1).try_cast("int"), F.regexp_extract(r, r"^T[^\t]*\t\S+ \d+ (\d+)\t", 1).try_cast("int"), F.regexp_extract(r, r"^T[^\t]*\t(\S+) ", 1)))
    # the length is counted once, not for every span
    return let(F.length(text), lambda n: F.filter(spans, lambda s: (s["start"] >= 0) & (s["end"] > s["start"]) & (s["end"] <= n)))


def options_text(question: Column, options: dict[str, Column]) -> Column:
    return F.concat_ws(" ", question, *(F.concat(F.lit(f"{k}. "), v) for k, v in options.items()))
