"""Token counts of whole texts; huge texts are encoded as overlapping chunks and spliced.

A text of more than ``huge`` bytes is cut about every ``chunk`` characters. The
chunk before a cut reaches ``margin`` characters past it, the chunk after it
starts as far before it, and Spark deals the chunks over all tasks. Each is
encoded with offsets. The vocabulary's pre-tokenizer reads its pieces from left
to right and looks at nothing before a piece, so

* piece starts of a chunk that itself starts at a piece start of the text are
  piece starts of the text, but for the last few characters, where the chunk's end
  may hide what follows (``guard``: the longest special string and four more);
* from a piece start of the text that two chunks share, both give the same
  tokens.

The first piece start that both chunks of a cut report, outside the guard, is
therefore a proven stable boundary: the text has the left chunk's tokens before
it and the right chunk's after it. Where a cut has none (a run of letters longer
than the overlap), its margin doubles and the text's chunks are encoded again; a
margin of over a quarter of a chunk removes the cut. In the end the count is
that of the whole text.

Other texts are counted in place. They are read as segments that start at a
space before a visible ASCII or Latin character, which always starts a piece;
the library counts each distinct segment once for each worker.

Special strings in a text become their special token, as by the library's
default. Edge cases: a null or empty text has no bytes and no tokens; repeated rows
and null identifiers give one row each; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled, shuffle_partitions

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LIMIT = 1024
CHUNK = 16_384
MARGIN = 128
HUGE = 2 * CHUNK
KEPT = 1_000_000  # distinct segments a worker remembers

_TOKENIZERS: dict = {}
_SEGMENTS: dict = {}


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def guard_of(path: str) -> int:
    """Characters at a chunk's end whose piece starts are not to be trusted."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    return max([len(x["content"]) for x in added], default=0) + 4


# ------------------------------------------------------------------ texts counted in place

def segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which a segment starts: rows, and spaces before a visible character."""
    start = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        after = data[1:]
        # lead bytes C3-DF: U+00C0 to U+07FF, among which there is no white space
        visible = ((after > 0x20) & (after < 0x7F)) | ((after >= 0xC3) & (after <= 0xDF))
        start[:len(data) - 1] = (data[:-1] == 0x20) & visible
    start[offsets] = True
    return np.flatnonzero(start[:len(data)])


class SegmentCounts:
    """Tokens of each segment; the library counts those that are new to the worker."""

    def __init__(self, path: str):
        self.path = path
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def of(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray,
           data: np.ndarray) -> np.ndarray:
        keys, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > KEPT:
            self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh = ~np.isin(keys, self.keys, assume_unique=True)
        if fresh.any():
            raw, first = data.tobytes(), at[fresh]
            texts = [raw[a:b].decode("utf-8", "replace")
                     for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            found = _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)
            place = np.searchsorted(self.keys, keys[fresh])
            self.counts = np.insert(self.counts, place, [len(x) for x in found])
            self.keys = np.insert(self.keys, place, keys[fresh])
        return self.counts[np.searchsorted(self.keys, keys)][back]


def _in_place(docs: DataFrame, path: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import EXACT, SLICE_BYTES, byte_slices, span_hashes

        known = _SEGMENTS.setdefault(path, SegmentCounts(path))
        for batch in batches:
            for first, data, offsets in byte_slices(batch.column(1), SLICE_BYTES):
                n = len(offsets) - 1
                starts = segment_starts(data, offsets)
                ends = np.append(starts[1:], len(data))
                total = np.zeros(len(starts) + 1, np.int64)
                if len(starts):
                    hashes = span_hashes(data, starts, ends, EXACT)
                    np.cumsum(known.of(hashes, starts, ends, data), out=total[1:])
                tokens = np.diff(total[np.searchsorted(starts, offsets)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(np.diff(offsets)),
                     pa.array(tokens)], names=["id", "n_bytes", "n_tokens"])

    return docs.select("id", "text").mapInArrow(count, "id long, n_bytes long, n_tokens long")


# ------------------------------------------------------------------ huge texts

CHUNKS = "id long, key string, k int, cuts int, start int, cut int, left int, right int, piece string"
EDGE = "array<struct<at:int,before:int>>"
ENCODED = f"key string, k int, cuts int, cut int, margin int, total int, head {EDGE}, tail {EDGE}"


def _chunks(texts: DataFrame) -> DataFrame:
    """One row per chunk of (id, key, text, layout); ``layout`` lists the cuts and their margins."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                id_, key, text, layout = (batch.column(c)[row].as_py() for c in range(4))
                cuts = [x["cut"] for x in layout]
                margins = [x["margin"] for x in layout]
                lows = [0] + [c - m for c, m in zip(cuts, margins, strict=True)]
                highs = [c + m for c, m in zip(cuts, margins, strict=True)] + [len(text)]
                n = len(lows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id_] * n, pa.int64()), pa.array([key] * n),
                     pa.array(range(n), pa.int32()), pa.array([n - 1] * n, pa.int32()),
                     pa.array(lows, pa.int32()), pa.array([*cuts, None], pa.int32()),
                     pa.array([0, *margins], pa.int32()), pa.array([*margins, 0], pa.int32()),
                     pa.array([text[a:b] for a, b in zip(lows, highs, strict=True)])],
                    names=["id", "key", "k", "cuts", "start", "cut", "left", "right", "piece"])

    return texts.select("id", "key", "text", "layout").mapInArrow(cut, CHUNKS)


def _edges(encoding, start: int, left: int, right: int, guard: int,
           length: int) -> tuple[list, list]:
    """Piece starts in the overlaps at both ends, each with the chunk's tokens before it."""
    offsets, words = encoding.offsets, encoding.word_ids
    head, tail = [], []
    if left:
        for i, (at, _) in enumerate(offsets):
            if at >= 2 * left:
                break
            if i == 0 or words[i] != words[i - 1]:
                head.append({"at": start + at, "before": i})
    if right:
        for i in range(len(offsets) - 1, 0, -1):
            at = offsets[i][0]
            if at < length - 2 * right:
                break
            if at <= length - guard and words[i] != words[i - 1]:
                tail.append({"at": start + at, "before": i})
    return head, tail


def _encoded(chunks: DataFrame, path: str, guard: int) -> DataFrame:
    """What each chunk tells: its tokens, and the piece starts of its overlaps."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        edge = pa.list_(pa.struct([("at", pa.int32()), ("before", pa.int32())]))
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            lefts, rights = column["left"].to_pylist(), column["right"].to_pylist()
            starts, total, heads, tails = column["start"].to_pylist(), [], [], []
            for first in range(0, batch.num_rows, 16):
                pieces = column["piece"].slice(first, 16).to_pylist()
                for i, found in enumerate(
                        tokenizer.encode_batch(pieces, add_special_tokens=False), first):
                    head, tail = _edges(found, starts[i], lefts[i], rights[i], guard,
                                        len(pieces[i - first]))
                    total.append(len(found))
                    heads.append(head)
                    tails.append(tail)
            yield pa.RecordBatch.from_arrays(
                [column["key"], column["k"], column["cuts"], column["cut"], column["right"],
                 pa.array(total, pa.int32()), pa.array(heads, edge), pa.array(tails, edge)],
                names=["key", "k", "cuts", "cut", "margin", "total", "head", "tail"])

    return chunks.mapInArrow(encode, ENCODED)


def _before(edge: str, at: str) -> Column:
    """Tokens before the piece start ``at`` of an overlap."""
    return F.get(F.filter(edge, lambda x: x["at"] == F.col(at)), F.lit(0))["before"]


def _spliced(encoded: DataFrame, chunk: int) -> DataFrame:
    """Per text: its tokens if every cut has a stable boundary, else the layout to try next."""
    one = ["cuts", "cut", "margin", "total", "head", "tail"]
    once = (encoded.groupBy("key", "k").agg(F.first(F.struct(*one)).alias("c"))
            .select("key", "k", "c.*"))
    by_chunk = Window.partitionBy("key").orderBy("k")
    cuts = once.withColumn("next", F.lead("head").over(by_chunk)).withColumn(
        "at", F.array_min(F.array_intersect("tail.at", "next.at")))
    last = F.col("k") == F.col("cuts")
    widened = F.when(F.col("at").isNull(), 2 * F.col("margin")).otherwise(F.col("margin"))
    judged = cuts.select(
        "key", "k", (~last & F.col("at").isNull()).alias("unmet"),
        F.when(last, F.col("total")).otherwise(
            _before("tail", "at") - _before("next", "at")).cast("long").alias("tokens"),
        F.when(~last, F.struct("cut", widened.alias("margin"))).alias("try"))
    return judged.groupBy("key").agg(
        F.sum("tokens").alias("n_tokens"), F.max("unmet").alias("unmet"),
        F.transform(
            F.filter(F.sort_array(F.collect_list("try")), lambda x: 4 * x["margin"] <= chunk),
            lambda x: F.struct(x["cut"].alias("cut"), x["margin"].alias("margin"))).alias("layout"))


def _huge_counts(huge: DataFrame, path: str, chunk: int, margin: int) -> DataFrame:
    """(key, n_tokens) of every distinct text among (id, key, text)."""
    guard = guard_of(path)
    n = F.char_length("text")
    parts = F.ceil(n / chunk).cast("int")
    cuts = F.when(parts > 1, F.transform(
        F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))),
        lambda i: F.struct((n.cast("long") * i / parts).cast("int").alias("cut"),
                           F.lit(margin).alias("margin"))))
    none = F.array().cast("array<struct<cut:int,margin:int>>")
    texts = huge.withColumn("layout", F.coalesce(cuts, none))
    found = None
    while True:
        # dealt by identifier and chunk, so that copies of one text do not meet in one task
        dealt = _chunks(texts).repartition(shuffle_partitions(huge.sparkSession), "id", "k")
        spliced = _spliced(_encoded(dealt, path, guard), chunk).transform(settled)
        done = spliced.where("not unmet").select("key", "n_tokens")
        found = done if found is None else found.union(done)
        again = spliced.where("unmet").select("key", "layout")
        if again.isEmpty():
            return found
        # one row of each text is enough
        one = (huge.join(again.select("key"), "key", "left_semi").groupBy("key")
               .agg(F.min("id").alias("one_id")))
        wanted = again.join(one, "key").transform(settled)
        texts = (huge.join(wanted, "key").where(F.col("id").eqNullSafe(F.col("one_id")))
                 .select("id", "key", "text", "layout"))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK,
                 margin: int = MARGIN, huge: int = HUGE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``path`` names a byte-level vocabulary of the ``tokenizers`` library without a
    normaliser. ``chunk`` is in characters and at least 16 margins.
    """
    if chunk < 16 * margin:
        raise ValueError("a chunk holds at least 16 margins")
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    is_huge = F.octet_length("text") > huge
    large = rows.where(is_huge).withColumn("key", F.sha2("text", 256))
    counts = _huge_counts(large, path, chunk, margin).transform(settled)
    sizes = large.select("id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    counted = sizes.join(counts, "key").select("id", "n_bytes", "n_tokens")
    return (_in_place(rows.where(~is_huge), path).union(counted)
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
