"""Decoders send each row through Python once, in pieces of a batch."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR, queries

NAMES = ["decode_chia", "decode_drugprot", "decode_knowledgator_biomed", "decode_osiris", "decode_pile_ner_type", "decode_synthetic_ner_ade_tweets", "decode_pile_ner_biomed", "gazetteer_relations", "decode_bioleaflets", "decode_chemprot", "decode_biored", "decode_linnaeus"]


@pytest.mark.parametrize("name", NAMES)
def test_rows_go_through_python_once_and_never_as_pandas(spark, monkeypatch, name):
    def refused(*_):
        raise AssertionError("a pandas function holds the Python objects of a whole batch")

    monkeypatch.setattr(F, "pandas_udf", refused)
    plan = queries()[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pieces_end_by_size_and_hold_every_row():
    from corpusmill.plans.runtime import pieces

    texts = pa.array(["x" * 1000] * 50 + [None, ""])
    found = list(pieces((texts,), lambda t: None if t is None else len(t), pa.int64(), most=10_000))
    assert [x for p in found for x in p.to_pylist()] == [1000] * 50 + [None, 0]
    assert max(map(len, found)) <= 10


def test_tokens_spans_and_links_of_a_row():
    from corpusmill.functions.spans import linked_in_tokens

    text = "Ab-c, dé  f"
    entity = lambda i, kind, a, b: {"id": i, "type": kind, "start": a, "end": b}
    entities = [entity("T0", "A", 0, 4), entity("T1", "B", 5, 9), entity("T1", "C", 10, 11), entity(None, "D", 0, 2), entity("T3", "E", 8, 99), entity("T4", "F", None, 3), None]
    rels = [{"type": "x", "arg1": "T0", "arg2": "T1"}, {"type": "y", "arg1": "T3", "arg2": None}, None]
    got = linked_in_tokens(text, entities, rels)
    assert got["tokens"] == ["Ab-c", ",", "dé", "f"]
    assert got["spans"] == [{"start": 0, "end": 0, "label": "A"}, {"start": 2, "end": 2, "label": "B"}, {"start": 3, "end": 3, "label": "B"}, {"start": 0, "end": 0, "label": None}]
    assert got["rels"] == [{**rels[0], "head": "Ab-c", "tail": "dé"}, {**rels[1], "head": None, "tail": None}, None]
    assert linked_in_tokens(None, None, None) == {"tokens": [], "spans": None, "rels": None}


def test_plain_values_are_those_of_to_pylist():
    from corpusmill.plans.runtime import plain

    rows = [[{"a": 1, "b": "x", "c": ["p", None]}, None, {"a": None, "b": None, "c": None}], None, [], [{"a": 2, "b": "é", "c": []}]]
    a = pa.array(rows, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.string()), ("c", pa.list_(pa.string()))])))
    assert plain(a) == rows and plain(a.slice(1, 3)) == rows[1:] and plain(a.slice(2)) == rows[2:]
