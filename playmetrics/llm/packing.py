"""Packing token pieces into sequences: exact complements first, then best fit.

The packing is planned on the histogram of piece lengths, which has at most
``capacity`` cells whatever the corpus. From the longest length down, a piece
leaves a gap; lengths that fill it exactly are looked up as one length, as two
and as three (pair sums are indexed by a convolution of the present lengths)
and used as often as the available counts allow. Lengths without an exact
complement are placed best fit: into the open sequences with the least room
that still holds them. Every step uses up a length or a kind of open sequence,
so the plan has a bounded number of rows too, each standing for many sequences.

Pieces then meet the plan by their rank among the pieces of their length. The
rank is counted in ``buckets`` parts per length, so a length that a third of
all pieces have is still spread over many tasks.

Edge cases: a null or empty text is one piece holding the end id alone. Rows
that repeat an identifier are packed each on their own. An empty table gives an
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled, shuffle_partitions

CAPACITY = 4096
END_ID = 1
MAX_BUCKETS = 128
SLICE_BYTES = 1 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ------------------------------------------------------------------ token pieces

def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
        id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: ids of its text, then ``end_id``, cut at ``capacity``.

    ``with_ids`` adds the ids themselves as ``ids array<int>``.
    """
    prepare(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.word_bpe import segment_ids
        from playmetrics.llm.wordstream import slices

        table = segment_ids(tokenizer)
        end = np.array([end_id], "<u4")
        for batch in batches:
            # the vocabulary lower-cases all but its special tokens, which start with "<|"
            fold = not pc.any(pc.match_substring(batch.column(1), "<|")).as_py()
            for first, words in slices(batch.column(1), SLICE_BYTES, fold):
                flat, counts = table.ids(words.hashes, words.starts, words.ends, words.data)
                offsets = np.concatenate([[0], np.cumsum(counts)])[words.offsets]
                # the end id stands after each row's ids
                flat = np.insert(flat, offsets[1:], end).astype("<u4", copy=False)
                offsets += np.arange(len(offsets))
                lengths = np.diff(offsets)
                per_row = -(-lengths // capacity)
                row = np.repeat(np.arange(len(lengths)), per_row)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
                start = piece * capacity
                length = np.minimum(lengths[row] - start, capacity)
                at = offsets[row] + start
                raw = memoryview(flat).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * b])
                       for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                columns = [batch.column(0).slice(first, len(lengths)).take(pa.array(row)),
                           pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                           pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(bounds), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        pieces, PIECES + (", ids array<int>" if with_ids else ""))


# ------------------------------------------------------------------ the plan

@dataclass(frozen=True)
class Kind:
    """``times`` sequences that hold ``copies`` pieces of each listed length."""

    parts: tuple[tuple[int, int], ...]  # (length, copies)
    times: int


class Planner:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in counts.items():
            self.left[length] = count
        self.kinds: list[Kind] = []
        self._pairs: np.ndarray | None = None

    def plan(self) -> list[Kind]:
        for longest in range(self.capacity, 0, -1):
            while self.left[longest] and self._fill_exactly(longest):
                pass
        self._best_fit()
        return self.kinds

    def _use(self, lengths: list[int]) -> bool:
        """Take the combination as often as the counts allow."""
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(self.left[x]) // n for x, n in need.items())
        if not times:
            return False
        for x, n in need.items():
            self.left[x] -= n * times
            if not self.left[x]:
                self._pairs = None
        self.kinds.append(Kind(tuple(need.items()), times))
        return True

    def _fill_exactly(self, longest: int) -> bool:
        gap = self.capacity - longest
        if gap == 0:
            return self._use([longest])
        if gap <= longest and self.left[gap] and self._use([longest, gap]):
            return True
        for b, c in self._two(gap, longest):
            if self._use([longest, b, c]):
                return True
        pairs = self._pair_sums()
        firsts = np.arange(min(longest, gap - 2), (gap + 2) // 3 - 1, -1)
        firsts = firsts[(self.left[firsts] > 0) & pairs[gap - firsts]] if len(firsts) else firsts
        for b in firsts.tolist():
            for c, d in self._two(gap - b, b):
                if self._use([longest, b, c, d]):
                    return True
        return False

    def _two(self, total: int, most: int) -> Iterator[tuple[int, int]]:
        """Pairs b >= c of available lengths with b + c = total and b <= most."""
        b = np.arange(min(most, total - 1), (total + 1) // 2 - 1, -1)
        if len(b):
            for x in b[(self.left[b] > 0) & (self.left[total - b] > 0)].tolist():
                yield x, total - x

    def _pair_sums(self) -> np.ndarray:
        """Which sums two available lengths reach, for sums up to the capacity."""
        if self._pairs is None:
            size = 2 * (self.capacity + 1)
            present = np.fft.rfft((self.left > 0).astype(float), size)
            self._pairs = np.fft.irfft(present * present, size)[:self.capacity + 1] > 0.5
        return self._pairs

    def _best_fit(self) -> None:
        open_by_room: dict[int, list[Kind]] = {}
        rooms = np.zeros(self.capacity + 1, dtype=bool)
        done: list[Kind] = []

        def put(kind: Kind, room: int) -> None:
            if not kind.times:
                return
            if room == 0:
                done.append(kind)
                return
            open_by_room.setdefault(room, []).append(kind)
            rooms[room] = True

        for length in range(self.capacity, 0, -1):
            count = int(self.left[length])
            while count:
                tight = np.flatnonzero(rooms[length:])
                if not len(tight):
                    each = self.capacity // length
                    put(Kind(((length, each),), count // each), self.capacity - each * length)
                    rest = count % each
                    if rest:
                        put(Kind(((length, rest),), 1), self.capacity - rest * length)
                    break
                room = length + int(tight[0])
                kind = open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms[room] = False
                each = min(room // length, count)
                times = min(kind.times, count // each)
                put(Kind(kind.parts, kind.times - times), room)
                put(Kind((*kind.parts, (length, each)), times), room - each * length)
                count -= each * times
        self.kinds += done + [k for kinds in open_by_room.values() for k in kinds]


def slots(kinds: list[Kind]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, past the last rank, sequences, first sequence, first offset) per use."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for kind in kinds:
        offset = 0
        for length, copies in kind.parts:
            first = used.get(length, 0)
            used[length] = first + copies * kind.times
            rows.append((length, first, used[length], kind.times, sequence, offset))
            offset += length * copies
        sequence += kind.times
    return rows


# ------------------------------------------------------------------ placing pieces

def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (1 to ``capacity``).

    ``pieces`` is read three times: pass a checkpoint or a written table.
    """
    spark = pieces.sparkSession
    buckets = min(shuffle_partitions(spark), MAX_BUCKETS)
    dealt = pieces.withColumn("bucket", F.expr(f"pmod(xxhash64(doc_id, piece), {buckets})"))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).transform(settled)
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # <= capacity rows
    plan = slots(Planner({r.length: r.n for r in histogram}, capacity).plan())
    slot_rows = spark.createDataFrame(
        plan, "slot_length long, first long, past long, times long, base long, at long")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = (dealt.withColumn("within", F.row_number().over(within) - 1)
              .join(F.broadcast(starts), ["length", "bucket"])  # <= capacity * MAX_BUCKETS rows
              .withColumn("rank", F.col("within") + F.col("before")))
    inside = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first")) & (
        F.col("rank") < F.col("past"))
    turn = F.col("rank") - F.col("first")
    return (ranked.join(F.broadcast(slot_rows), inside)
            .withColumn("sequence_id", F.col("base") + turn % F.col("times"))
            .withColumn("offset", F.col("at") + F.col("length") * F.floor(turn / F.col("times")))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and the offset each one gets."""
    pieces = cut(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids).transform(settled)
    return place(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length and ids; needs ``with_ids``.

    A group is one sequence, so it never exceeds the capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
            .select("sequence_id", "length", F.flatten(F.col("parts.ids")).alias("ids")))
