"""A long text costs the gazetteer a bounded number of steps per token."""

from corpusmill.functions import vocabulary as V
from corpusmill.operators.gazetteer import Gazetteer, Phrases


class Tokens(list):
    def __getitem__(self, i):
        assert not isinstance(i, slice), "the rest of the text is copied"
        return super().__getitem__(i)


def test_phrases_look_up_tokens_without_copying_the_rest():
    assert Phrases([("a b", "x"), ("a", "y")]).scan(Tokens("c a b a".split())) == [(1, 2, "x"), (3, 3, "y")]


def test_negations_are_read_once_per_text(monkeypatch):
    g = Gazetteer({"Drug": frozenset({"Drug"})}, extra={"linked_with": ["and"]})
    words = [next(c for c in V.NEGATION_CUES if c.isalpha()), "x0"] + [w for i in range(400) for w in ("and", f"x{i + 1}")]
    calls, plain = [], Phrases.longest_at
    monkeypatch.setattr(Phrases, "longest_at", lambda self, low, i: calls.append(i) or plain(self, low, i))
    found = [r for r in g.relations(words, [(i, i, "Drug") for i in range(1, len(words), 2)]) if r["name"].endswith("linked_with")]
    assert len(found) == 400 and all(r["negated"] for r in found)
    assert len(calls) < 5 * len(words)
