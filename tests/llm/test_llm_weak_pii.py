import hashlib
import random
import re

import numpy as np
from helpers import DOC_SCHEMA, documents, odd_documents

from playmetrics.llm import weak_pii as pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The contract, word for word."""
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


SAMPLES = [
    "a@b.cd%x@e.fg @x.y a@b a@b. a@b.c.d@e.f é@x.yz %@a.b", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 1..2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (456) 555-2186, +49 30 1234567890123456 +1",
    "+1 (((((" + "(" * 50, "0" * 5000 + ".1.2.3", "日本 +81 3 1234 5678 192.168.0.1x@y.zz", "",
]


def test_base_spans_equal_the_plain_rules():
    rng = random.Random(4)
    pool = "0123456789.@+-() abZ%_é4111"
    texts = SAMPLES[:5] + SAMPLES[6:] + [
        "".join(rng.choice(pool) for _ in range(rng.randrange(0, 120))) for _ in range(20000)]
    for text in texts:
        assert pii._written(pii.base_spans(text)) == plain(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 200_000 + " x@y.zz", "1" * 200_000, "1." * 100_000, "+" * 200_000,
                 "+1" + "(" * 200_000, "4 " * 100_000 + "@"):
        pii.candidates(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(0)
    y = rng.random(20000) < 0.3
    right = np.array([0.95, 0.8, 0.7])
    votes = np.where(rng.random((20000, 3)) < right, np.where(y, 1, -1)[:, None],
                     np.where(y, -1, 1)[:, None])
    votes[rng.random((20000, 3)) < 0.1] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, table, posterior = pii.reliabilities(patterns, counts.astype(float))
    assert abs(prior - 0.3) < 0.03
    assert np.abs(table[1, :, 2] / 0.9 - right).max() < 0.05
    assert posterior[(patterns == 1).all(axis=1)][0] > 0.9


def sample_docs(spark):
    rng = random.Random(2)
    texts = []
    for i in range(80):
        good = [f"mail me at u{i}@site.com", f"call +1 (4{i:02d}) 555-2186 now",
                f"phone (4{i:02d}) 555-2186 now", "card 4111 1111 1111 1111 ok",
                f"write to u{i} [at] mail{i} [dot] com today"]
        bad = [f"version 300.{i}.2.1", f"order 4111111111111{i:03d} shipped", "plain words only"]
        texts.append(" and ".join(rng.sample(good, 2) + rng.sample(bad, 2)))
    return documents(spark, texts + [None, ""])


def test_query_equals_the_plain_rules_and_adds_spans(spark):
    docs = sample_docs(spark)
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    for r in docs.collect():
        expected = plain(r.text or "")
        got = rows[r.doc_id]
        assert got.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        base = [s for s in expected.split(",") if s]
        assert [s for s in got.spans.split(",") if s.split(":")[0] in pii.KINDS] == base
        assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == [
            sum(s.startswith(k + ":") for s in base) for k in pii.KINDS]
    assert sum(r.n_added for r in rows.values()) > 0


def test_masking_takes_effect_and_leaves_clean_rows(spark):
    docs = sample_docs(spark).union(documents(spark, ["nothing here", "a@b.cd"], 500))
    rows = {r.doc_id: r for r in pii.mask(docs, length_col="n_chars").collect()}
    assert rows[500].text == "nothing here"
    assert rows[501].text == "<EMAIL>" and rows[501].n_chars == 7
    assert all("@site.com" not in (r.text or "") for r in rows.values())
    assert pii.masked("a 1 b", [pii.Span("ip", 2, 3)]) == "a <IP> b"


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    assert pii.find(docs).count() == 10
    assert sorted(map(tuple, pii.mask(docs).collect()), key=str) == sorted(
        map(tuple, docs.collect()), key=str)
    assert pii.find(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
