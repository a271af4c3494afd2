import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, odd_documents

from playmetrics.llm import piece_bpe
from playmetrics.llm.common import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a", "  a  b ", "\n\t", "é▁x ▁▁ y", "\x00\x01", "日本語 text 😀", "x" * 500,
       "the " * 50, " " * 100, "ab" * 3000, "<s> </s> <unk> <0x0A>", "▁", " ▁", "á á",
       "SSliche Ünlü " * 20, "a" * 47 + " " + "b" * 48 + " " + "cd" * 25]


def own(vocab, texts):
    out = []
    for _, flat, offsets in vocab.encode_rows(pa.array(texts, pa.string())):
        out += [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


def test_agenda_equals_the_library():
    vocab = piece_bpe.PieceVocabulary(MODEL)
    vocab.checked = False
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(" ab▁é日😀\ntheing!.") for _ in range(rng.randrange(0, 300)))
                   for _ in range(3000)]
    assert own(vocab, texts) == vocab.library.encode([t or "" for t in texts], num_threads=1)


def test_heap_and_rounds_agree(monkeypatch):
    vocab = piece_bpe.PieceVocabulary(MODEL)
    vocab.checked = False
    segments = [t.replace("▁", " ").encode() for t in ODD if t and " " not in t.strip()]
    by_rounds = [x.tolist() for x in vocab.encode_segments(segments)]
    monkeypatch.setattr(piece_bpe, "LONG", 0)
    assert [x.tolist() for x in vocab.encode_segments(segments)] == by_rounds


def test_check_replaces_and_counts_what_differs(monkeypatch):
    vocab = piece_bpe.PieceVocabulary(MODEL)
    monkeypatch.setattr(vocab, "_together", lambda symbols, owner: (symbols, owner))
    assert own(vocab, ["the thing"]) == [vocab.library.encode("the thing")]
    assert vocab.mismatches == 2


@pytest.mark.parametrize("check", ["segments", "texts", "none"])
def test_query_columns_equal_the_library(spark, check):
    lib = piece_bpe.PieceVocabulary(MODEL).library
    for docs in (odd_documents(spark), documents(spark, ODD)):
        rows = piece_bpe.encode_and_decode(docs, MODEL, check=check, with_ids=True).collect()
        expected = []
        for r in docs.collect():
            ids = lib.encode(r.text or "", add_bos=True, add_eos=True)
            text = lib.decode(ids)
            expected.append((r.doc_id, len(ids),
                             hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(text.encode()).hexdigest(), 0, ids, text))
        key = lambda r: (-1 if r[0] is None else r[0], r[2])
        assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)


def test_empty_table(spark):
    assert piece_bpe.encode_and_decode(documents(spark, []), MODEL).count() == 0
