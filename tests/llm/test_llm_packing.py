import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from playmetrics.llm import packing
from playmetrics.llm.common import tokenizer_path

WORD = tokenizer_path("word_bpe_49k.json")


def brute_pieces(rows, capacity):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD)
    out = []
    for doc, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            out.append((doc, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return Counter(out)


def check_sequences(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [8, 64, 4096])
def test_pieces_and_gapless_sequences(spark, capacity):
    docs = odd_documents(spark)
    rows = packing.pack(docs, WORD, capacity=capacity).collect()
    assert Counter(tuple(r)[:5] for r in rows) == brute_pieces(
        [(r.doc_id, r.text) for r in docs.collect()], capacity)
    check_sequences(rows, capacity)


def test_special_tokens_and_case(spark):
    texts = ["a<|endoftext|>b <|ENDOFTEXT|> Word WORD", "Word <|startoftext|>", "thin Thin's THIN"]
    docs = documents(spark, texts)
    rows = packing.cut(docs, WORD).collect()
    assert Counter(tuple(r) for r in rows) == brute_pieces(list(enumerate(texts, 1)), 4096)


def test_few_sequences_and_their_ids(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(["word"] * int(n)) for n in rng.integers(1, 90, 400)]
    packed = packing.pack(documents(spark, texts), WORD, capacity=64, with_ids=True)
    rows = packed.collect()
    total = sum(r.length for r in rows)
    assert check_sequences(rows, 64) <= -(-total // 64) + 2
    made = packing.sequences(packed).collect()
    assert sum(r.length for r in made) == total and all(len(r.ids) == r.length for r in made)


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), WORD).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 9), max_size=24))
def test_plan_uses_every_piece_once(counts):
    kinds = packing.Planner(counts, 24).plan()
    used = Counter()
    for kind in kinds:
        assert sum(length * n for length, n in kind.parts) <= 24
        for length, n in kind.parts:
            used[length] += n * kind.times
    assert used == Counter(counts)
    for length, first, past, times, _, _ in packing.slots(kinds):
        assert (past - first) % times == 0 and past <= counts[length]
