import zlib

import numpy as np

from corpusmill.llm import packing as P
from corpusmill.llm.queries import tokenizer_path

TEXTS = [None, "", "Hello, world!", "it's a  tést don't\t12,5 \x1c x é é\n\nA<|endoftext|>", "naïve Straße ΑΒΓ 漢字 😀 áb", "word " * 9000, "ab\x0bcd ef"] + [f"doc number {i} " * (i % 50) for i in range(80)]


def test_every_id_lies_in_one_piece(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    rows = list(enumerate(TEXTS))
    for block in (1 << 20, 3000):
        got = P.pack(docs(rows, start=["x"] * len(rows)).repartition(3), tokenizer_path(), block_tokens=block).collect()
        ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for i, x in rows}
        at = dict.fromkeys(ids, 0)
        for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
            assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
            assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
            at[r.doc_id] += r.length
        assert at == {i: len(x) for i, x in ids.items()}
        used = {}
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == used.get(r.sequence_id, 0)
            used[r.sequence_id] = r.offset + r.length
        assert all(n <= 4096 and n & (n - 1) == 0 for n in used.values())


def test_costs_are_balanced():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 2000, 600).tolist()
    cost = {}
    for _, _, n, s, _ in P.assign(lengths, 4096, 1.0, 1 / 4096):
        cost[s] = cost.get(s, 0) + n + n * n / 4096
    full = sorted(cost.values())[10:-10]
    assert full[-1] / full[0] < 1.6


def test_empty_table_and_repeated_rows(docs):
    assert P.pack(docs([]), tokenizer_path()).count() == 0
    assert P.pack(docs([(1, "a"), (1, "a"), (None, "b")]), tokenizer_path()).count() == 3


def test_every_row_of_a_long_partition_is_packed(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    rows = [(i, f"doc {i} of many") for i in range(9500)]
    got = P.pack(docs(rows).coalesce(1), tokenizer_path(), block_tokens=20_000).collect()
    ids = {i: np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4") for i, x in rows}
    packed = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start == packed.get(r.doc_id, 0) and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        packed[r.doc_id] = r.start + r.length
    assert packed == {i: len(x) for i, x in ids.items()}
