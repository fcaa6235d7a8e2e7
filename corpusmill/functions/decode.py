"""Decoders of text cells that hold Python literals, JSON or conversations. Malformed pieces are dropped, rows survive.

JSON of a fixed shape goes through from_json; only literals, recursive shapes and case folding need Python, in Arrow batches.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import corpora as V
from corpusmill.plans.runtime import ship_code


def _arrow(spark: SparkSession, one, kind: str):
    ship_code(spark)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(one)

    return F.pandas_udf(run, kind)


def literal(value):
    """A container written as a Python literal, or None."""
    if not isinstance(value, str):
        return value if isinstance(value, (list, dict, tuple)) else None
    try:
        out = ast.literal_eval(value)
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        return None
    return out if isinstance(out, (list, dict, tuple)) else None


def string_list(value) -> list[str]:
    """A literal list of strings only, else nothing."""
    out = literal(value)
    return list(out) if isinstance(out, (list, tuple)) and all(isinstance(x, str) for x in out) else []


def two_lists(tokens, tags) -> dict:
    return {"tokens": string_list(tokens), "tags": string_list(tags)}


def mention_list(value) -> list[str]:
    """A list in JSON or as a literal; strings stripped, other items dropped."""
    try:
        out = json.loads(value) if isinstance(value, str) else value
    except ValueError:
        out = literal(value)
    return [x.strip() for x in out if isinstance(x, str) and x.strip()] if isinstance(out, (list, tuple)) else []


def span_dicts(value, length: int | None = None) -> list[dict]:
    """Literal list of {start, end, label, ...}: whole numbers (booleans are none), in order, inside the text."""
    out = literal(value)
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool)
    good = [s for s in out or [] if isinstance(s, dict) and whole(s.get("start")) and whole(s.get("end")) and isinstance(s.get("label"), str)] if isinstance(out, (list, tuple)) else []
    return [{"start": s["start"], "end": s["end"], "label": s["label"]} for s in good if 0 <= s["start"] < s["end"] and (length is None or s["end"] <= length)]


def flattened(value) -> list[tuple[str, str]]:
    """(path, value) of all scalar leaves of a JSON text, in order: a.b, a[], a[].b."""
    try:
        root = json.loads(value) if isinstance(value, str) else None
    except ValueError:
        return []
    out: list[tuple[str, str]] = []
    todo = [("", root)]
    while todo:
        path, node = todo.pop()
        if isinstance(node, dict):
            todo += [(f"{path}.{k}" if path else k, v) for k, v in reversed(list(node.items()))]
        elif isinstance(node, list):
            todo += [(f"{path}[]", v) for v in reversed(node)]
        elif node is not None and path:
            out.append((path, node if isinstance(node, str) else json.dumps(node)))
    return out


def json_fields(root) -> list[tuple[str, list[str]]]:
    """(path, values) of a JSON value: scalars one by one, scalars of a list together; blanks and nulls are left out."""
    out: list[tuple[str, list[str]]] = []
    todo: list = [("", root)]
    while todo:
        path, node = todo.pop()
        if isinstance(node, dict):
            todo += [(f"{path}.{k}" if path else str(k), v) for k, v in reversed(node.items())]
        elif isinstance(node, list):
            inner = [v for v in node if isinstance(v, (dict, list))]
            said = [str(v) for v in node if not isinstance(v, (dict, list)) and v is not None and v != ""]
            # the scalars of a mixed list come after its containers
            todo += ([(f"{path}[]", tuple(said))] if said else []) + [(f"{path}[]", v) for v in reversed(inner)]
        elif isinstance(node, tuple):
            out.append((path, list(node)))
        elif isinstance(node, bool):
            out.append((path, [str(node).lower()]))
        elif node is not None and not (isinstance(node, str) and not node.strip()):
            out.append((path, [str(node)]))
    return out


def objects(root) -> Iterator[dict]:
    """All objects of a JSON value."""
    todo = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, dict):
            yield node
            todo += node.values()
        elif isinstance(node, list):
            todo += node


def beside_marker(root, source: str) -> set[str] | None:
    """Names that stand beside the marker which their source asks for; None where it asks for none."""
    texts = lambda *xs: {x for x in xs if isinstance(x, str) and x}
    found: set[str] = set()
    if source == V.JSON_INTERVENTIONS:
        for node in objects(root):
            listed = node.get("interventions")
            for x in listed if isinstance(listed, list) else ():
                if isinstance(x, dict) and isinstance(x.get("type"), str) and x["type"].lower() in V.JSON_INTERVENTION_TYPES:
                    found |= texts(x.get("name"))
        return found
    if source == V.JSON_PERSONS:
        for node in objects(root):
            if node.get("entity") == V.JSON_PERSON:
                more = node.get("properties")
                found |= texts(node.get("name"), more.get("name") if isinstance(more, dict) else None)
        return found
    return None


def json_example(text: str | None, written: str | None, source: str | None) -> dict:
    """fields, mentions and triples of a JSON document that was made from a text; nothing where it is no object or list."""
    none = {"text": "", "fields": [], "mentions": [], "triples": []}
    try:
        root = json.loads(written) if text and written else None
    except (ValueError, RecursionError):
        return none
    if not isinstance(root, (dict, list)):
        return none
    fields, named = json_fields(root), beside_marker(root, source or "")
    classes = {path: c for s, path, c in V.JSON_LEAVES if s == source}

    def counts(path: str, value: str) -> bool:
        if source == V.JSON_COMPANIES and value.startswith(V.JSON_PLACEHOLDER):
            return False
        return value in text and (named is None or path.endswith("[]") or value in named)

    mentions = [{"mention": x, "category": classes[path]} for path, values in fields if path in classes for x in values if counts(path, x)]
    triples = []
    for x in root if source == V.JSON_TRIPLES and isinstance(root, list) else ():
        name = V.JSON_PREDICATES.get(x["predicate"]) if isinstance(x, dict) and isinstance(x.get("predicate"), str) else None
        head, tail = (x.get("subject"), x.get("object")) if name else (None, None)
        if isinstance(head, str) and isinstance(tail, str) and head != tail and head in text and tail in text:
            triples.append({"name": name, "head": head, "tail": tail})
    return {"text": text, "fields": [{"name": p, "value": v} for p, v in fields], "mentions": mentions, "triples": triples}


def leaflet(sections) -> dict:
    """tokens and spans of a leaflet's sections, each a literal with its content and marks. A null token parts two sections."""
    tokens: list[str | None] = []
    spans: list[dict] = []
    for s in sections:
        s = literal(s)
        content = s.get("Section_Content") if isinstance(s, dict) else None
        if not isinstance(content, str) or not content:
            continue
        listed = literal(s.get("Entity_Recognition"))
        tokens += [None] if tokens else []
        first = len(tokens)
        tokens += content.split()
        ends = [0]
        for t in tokens[first:]:
            ends.append(ends[-1] + len(t) + 1)
        marks = [(x.get("BeginOffset"), x.get("EndOffset"), x.get("Type"), x.get("Text")) for x in listed if isinstance(x, dict)] if isinstance(listed, list) else []
        for a, b, kind, said in dict.fromkeys(m for m in marks if type(m[0]) is type(m[1]) is int and isinstance(m[2], str) and isinstance(m[3], str)):
            if 0 <= a < b < ends[-1] and content[a:b] == said and (inside := said.strip()):
                lo = a + len(said) - len(said.lstrip())
                touched = [i for i in range(len(ends) - 1) if ends[i + 1] - 1 > lo and ends[i] < lo + len(inside)]
                spans.append({"start": first + touched[0], "end": first + touched[-1], "label": kind})
    return {"tokens": tokens, "spans": spans}


def first_object(text) -> dict | None:
    """The JSON object that begins at the first brace."""
    at = text.find("{") if isinstance(text, str) else -1
    if at < 0:
        return None
    try:
        out, _ = json.JSONDecoder().raw_decode(text[at:])
    except ValueError:
        return None
    return out if isinstance(out, dict) else None


def folded_place(text: str, value: str) -> str | None:
    """The value as the text writes it, whatever the case; None where folding changes lengths or the text lacks it."""
    low, want = text.casefold(), value.casefold()
    if not want or len(low) != len(text):
        return None
    at = low.find(want)
    return text[at : at + len(want)] if at >= 0 else None


QUESTION = re.compile(r"^What describes (.+?) in the text\?$")


def conversation(turns) -> tuple[str | None, list[tuple[str, list[str]]]]:
    """The document (first human turn after "Text: ") and each templated question with its answer's list."""
    turns = turns if isinstance(turns, (list, tuple)) else literal(turns) or []
    turns = [t for t in turns if isinstance(t, dict)]
    text = next((t["value"][6:] for t in turns if t.get("from") == "human" and str(t.get("value", "")).startswith("Text: ")), None)
    asked = []
    for a, b in zip(turns, turns[1:]):
        m = QUESTION.match(str(a.get("value", ""))) if a.get("from") == "human" else None
        if m and b.get("from") == "gpt":
            asked.append((m.group(1), mention_list(b.get("value"))))
    return text, asked


def string_list_udf(spark: SparkSession):
    return _arrow(spark, string_list, "array<string>")


def mention_list_udf(spark: SparkSession):
    return _arrow(spark, mention_list, "array<string>")


def span_dicts_udf(spark: SparkSession):
    return _arrow(spark, span_dicts, "array<struct<start:int,end:int,label:string>>")


def flattened_udf(spark: SparkSession):
    return _arrow(spark, lambda v: [{"path": p, "value": x} for p, x in flattened(v)], "array<struct<path:string,value:string>>")


def conversation_pairs(turns: Column) -> Column:
    """Adjacent (question, answer) of array<struct<turn, role, text>>, natively: a user turn and the assistant turn after it."""
    pairs = F.zip_with(F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0))), F.slice(turns, 2, F.greatest(F.size(turns) - 1, F.lit(0))), lambda a, b: F.struct(a["role"].alias("ra"), b["role"].alias("rb"), a["text"].alias("question"), b["text"].alias("answer")))
    return F.transform(F.filter(pairs, lambda p: (p["ra"] == "user") & (p["rb"] == "assistant")), lambda p: F.struct(p["question"].alias("question"), p["answer"].alias("answer")))
