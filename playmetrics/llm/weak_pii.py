"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (email, ip, card, phone by fixed rules) are always found. Looser
patterns give further candidates: obfuscated addresses, phone numbers without a
country code, social security numbers, bank account numbers and card-like
numbers that fail the base rule. Five labelers (strict rule, validity check,
gazetteer, context words, surroundings) vote yes, no or abstain on every
candidate, base ones too. Expectation-maximisation over the vote patterns, of
which there are at most ``3 ** 5``, estimates each labeler's reliabilities and
each pattern's probability. A logistic classifier on hashed span features is
then trained on those probabilities, and a looser candidate that it accepts
and that overlaps no base span is added.

The vote patterns are counted over all documents. The classifier is fitted from
at most ``SAMPLE`` candidates (a documented bound, chosen by hash). Both are
bounded, so they meet on the driver. Finding and masking then judge every row
where it lies, over its whole text, without a join or shuffle.

Edge cases: null text reads as empty; masking leaves a null text null. Rows
that repeat an identifier are judged each on their own. An empty table gives an
empty result. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled

KINDS = ("email", "ip", "card", "phone")
LOOSE_KINDS = ("hidden_email", "local_phone", "ssn", "iban", "loose_card")
SAMPLE = 20_000
ACCEPT = 0.9
CELLS = 4096
CONTEXT_CHARS = 48

# Fixed rules of the base spans.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts, which keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

HIDDEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?[\[(]at[\])]\s?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.|\s?[\[(]dot[\])]\s?)[A-Za-z0-9-]{1,63}){1,4}", re.IGNORECASE)
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
DIGIT = re.compile("[0-9]")

# Gazetteers and context words.
TOP_DOMAINS = frozenset("com org net edu gov info io co uk de fr es it nl ch at be eu us ca au".split())
CALLING_CODES = ("1", "31", "32", "33", "34", "39", "41", "43", "44", "49", "61", "81", "86", "91")
CARD_ISSUERS = ("3", "4", "5", "6")
IBAN_COUNTRIES = frozenset("DE FR ES IT NL BE AT CH GB IE PT PL SE NO DK FI LU CZ".split())
CUES = re.compile(r"\b(e-?mail|mail|contact|phone|tel|call|mobile|fax|card|visa|credit|account|iban|"
                  r"bank|ssn|social|address|reach|telefon|karte|konto|courriel|carte|compte|correo|"
                  r"tel[eé]fono|tarjeta|cuenta)\b", re.IGNORECASE)
COUNTER_CUES = re.compile(r"\b(version|release|build|token|hash|sha|commit|isbn|order|serial|page|part|no|"
                          r"password|secret|key)\b", re.IGNORECASE)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


class Candidate(NamedTuple):
    span: Span
    base: bool
    votes: tuple[int, ...]
    cells: tuple[int, ...]


# ------------------------------------------------------------------ base spans

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping matches: from each @, back to the start of its local part."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            yield Span("email", start, past)
        at = text.find("@", max(past, at + 1))


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then by kind as listed."""
    found = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        found += [Span("ip", *m.span()) for m in IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                         for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _digits(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(Span("card", *m.span()))
        if "+" in text:
            found += [Span("phone", *m.span()) for m in PHONE.finditer(text)
                      if 10 <= len(_digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def _loose_spans(text: str) -> list[Span]:
    found = []
    if "at]" in text.lower() or "at)" in text.lower():
        found += [Span("hidden_email", *m.span()) for m in HIDDEN_EMAIL.finditer(text)]
    if DIGIT.search(text):
        for kind, pattern in (("local_phone", LOCAL_PHONE), ("ssn", SSN), ("iban", IBAN)):
            found += [Span(kind, *m.span()) for m in pattern.finditer(text)]
        found += [Span("loose_card", *m.span()) for m in CARD.finditer(text)
                  if m.end() - m.start() >= 13 and 13 <= len(_digits(m.group())) <= 19]
    return found


# ------------------------------------------------------------------ labelers

def _valid(kind: str, text: str) -> int:
    digits = _digits(text)
    if kind in ("card", "loose_card"):
        ok = luhn(digits) and len(set(digits)) > 2
    elif kind == "phone":
        ok = 10 <= len(digits) <= 15
    elif kind == "local_phone":
        ok = digits[0] in "23456789" and digits[3] in "23456789"
    elif kind == "ssn":
        ok = digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00"
    elif kind == "iban":
        flat = text.replace(" ", "")
        ok = int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
    elif kind == "ip":
        ok = not text.startswith(("0.", "255."))
    else:
        ok = True
    return 1 if ok else -1


def _gazetteer(kind: str, text: str) -> int:
    if kind in ("email", "hidden_email"):
        return 1 if re.split(r"[^A-Za-z0-9-]+", text.rstrip("])"))[-1].lower() in TOP_DOMAINS else -1
    if kind == "phone":
        return 1 if _digits(text).startswith(CALLING_CODES) else -1
    if kind in ("card", "loose_card"):
        return 1 if text.startswith(CARD_ISSUERS) else -1
    if kind == "iban":
        return 1 if text[:2] in IBAN_COUNTRIES else -1
    if kind == "ip":
        return -1 if text.startswith(("127.", "10.", "192.168.")) else 0
    return 0


def _votes(text: str, span: Span, base: bool) -> tuple[int, ...]:
    inside = text[span.start:span.end]
    left = text[max(0, span.start - CONTEXT_CHARS):span.start]
    context = 1 if CUES.search(left) else -1 if COUNTER_CUES.search(left) else 0
    around = left[-1:] + text[span.end:span.end + 1]
    alone = -1 if any(c.isalnum() or c in "=\"'_/" for c in around) else 1
    return (1 if base else 0, _valid(span.kind, inside), _gazetteer(span.kind, inside), context,
            alone)


def _cell(feature: str) -> int:
    return int.from_bytes(hashlib.blake2b(feature.encode("utf-8", "replace"), digest_size=4)
                          .digest(), "little") % CELLS


def _features(text: str, span: Span) -> tuple[int, ...]:
    inside = text[span.start:span.end]
    left = text[max(0, span.start - CONTEXT_CHARS):span.start]
    shape = re.sub(r"(.)\1+", r"\1", re.sub("[0-9]", "9", re.sub("[^\\W0-9_]", "a", inside)))
    words = re.findall(r"\w+", left.lower())
    family = {"hidden_email": "email", "local_phone": "phone", "loose_card": "card"}.get(
        span.kind, span.kind)
    return tuple(sorted({_cell(f) for f in (
        "bias", f"kind={span.kind}", f"family={family}", f"shape={shape[:40]}",
        f"digits={len(_digits(inside))}", f"valid={_valid(span.kind, inside)}:{family}",
        f"last={words[-1] if words else ''}", f"left={left[-1:]}",
        f"right={text[span.end:span.end + 1]}", f"cue={bool(CUES.search(left))}",
        f"counter={bool(COUNTER_CUES.search(left))}")}))


def candidates(text: str) -> list[Candidate]:
    base = base_spans(text)
    out = [Candidate(s, True, _votes(text, s, True), _features(text, s)) for s in base]
    for s in _loose_spans(text):
        if not any(s.start < b.end and b.start < s.end for b in base):
            out.append(Candidate(s, False, _votes(text, s, False), _features(text, s)))
    return out


# ------------------------------------------------------------------ label model and classifier

LABELERS = 5


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100
                  ) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1): prior, P(vote | class), P(yes | pattern).

    Starts from the votes' majority; counts are smoothed by one vote each, so
    a labeler that always abstains tells nothing.
    """
    posterior = 1 / (1 + np.exp(-2.0 * patterns.sum(axis=1)))
    table = np.full((2, patterns.shape[1], 3), 1 / 3)
    prior = 0.5
    for _ in range(rounds):
        for y, weight in enumerate((counts * (1 - posterior), counts * posterior)):
            for v in (-1, 0, 1):
                table[y, :, v + 1] = 1 + weight @ (patterns == v)
        table /= table.sum(axis=2, keepdims=True)
        prior = (1 + counts @ posterior) / (2 + counts.sum())
        at = np.arange(patterns.shape[1])
        log = np.log(table[:, at, patterns + 1]).sum(axis=2)
        log += np.log([1 - prior, prior])[:, None]
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return float(prior), table, posterior


@dataclass(frozen=True)
class SpanModel:
    weights: np.ndarray
    reliability: np.ndarray = field(repr=False)

    def probability(self, cells: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-self.weights[list(cells)].sum())))

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans; all spans. Added spans never overlap one another: the earlier one stays."""
        found = candidates(text)
        base = [c.span for c in found if c.base]
        added: list[Span] = []
        for c in sorted((c for c in found if not c.base),
                        key=lambda c: (c.span.start, -c.span.end, c.span.kind)):
            if (not added or c.span.start >= added[-1].end) and (
                    self.probability(c.cells) >= ACCEPT):
                added.append(c.span)
        order = KINDS + LOOSE_KINDS
        return base, sorted(base + added, key=lambda s: (s.start, order.index(s.kind)))


def _train(rows: list[tuple[tuple[int, ...], float]], steps: int = 200) -> np.ndarray:
    """Logistic regression by Adam on (cells, probability) rows."""
    weights = np.zeros(CELLS)
    if not rows:
        weights[_cell("bias")] = -10.0
        return weights
    cells = np.concatenate([np.array(c) for c, _ in rows])
    row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    target = np.array([p for _, p in rows])
    m, v = np.zeros(CELLS), np.zeros(CELLS)
    for step in range(1, steps + 1):
        f = np.bincount(row, weights[cells], len(rows))
        error = (1 / (1 + np.exp(-f)) - target) / len(rows)
        grad = np.bincount(cells, error[row], CELLS) + 1e-4 * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        weights -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return weights


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> SpanModel:
    """Reliabilities from all candidates, then the classifier from at most ``sample`` of them."""
    prepare(docs.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [c for text in batch.column(0).to_pylist() if text for c in candidates(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(c.votes) for c in found], pa.list_(pa.int32())),
                 pa.array([list(c.cells) for c in found], pa.list_(pa.int32()))],
                names=["votes", "cells"])

    voted = docs.select(text_col).mapInArrow(vote, "votes array<int>, cells array<int>").transform(settled)
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    if not counted:
        return SpanModel(_train([]), np.full((2, LABELERS, 3), 1 / 3))
    patterns = np.array([r.votes for r in counted])
    _, table, posterior = reliabilities(patterns, np.array([r.n for r in counted], float))
    chance = {tuple(r.votes): p for r, p in zip(counted, posterior.tolist(), strict=True)}
    rows = (voted.groupBy("votes", "cells").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.xxhash64("votes", "cells"), "votes", "cells").limit(sample).collect())
    return SpanModel(_train([(tuple(r.cells), chance[tuple(r.votes)]) for r in rows]), table)


# ------------------------------------------------------------------ finding and masking

FOUND = ("id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "spans string, n_added long")


def _written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find(docs: DataFrame, model: SpanModel | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Counts, digest and list of the spans of every row."""
    model = fit(docs, text_col) if model is None else model
    prepare(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                 strict=True):
                base, spans = model.spans(text or "")
                rows.append((doc, *(sum(s.kind == k for s in base) for k in KINDS),
                             hashlib.sha256(_written(base).encode()).hexdigest(),
                             _written(spans), len(spans) - len(base)))
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            names = [c.split()[0] for c in FOUND.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        scan, FOUND).withColumnRenamed("id", id_col)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with every run of overlapping spans replaced by the first one's kind."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at:s.start], f"<{s.kind.upper()}>"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: SpanModel | None = None, text_col: str = "text",
         length_col: str | None = None) -> DataFrame:
    """``docs`` with spans masked in the text; ``length_col`` is set to the new length."""
    model = fit(docs, text_col) if model is None else model
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col else None

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [t if t is None else masked(t, model.spans(t)[1]) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if length_at is not None:
                lengths = [old if a == b or b is None else len(b) for old, a, b in zip(
                    columns[length_at].to_pylist(), texts, new, strict=True)]
                columns[length_at] = pa.array(lengths, batch.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(hide, docs.schema)
