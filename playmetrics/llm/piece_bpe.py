"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes symbols, one per character after spaces are written as U+2581
and one is put in front. All adjacent pairs whose joint piece is in the
vocabulary stand on an agenda ordered by the piece's score, then by position;
the first pair is merged, its new neighbours join the agenda, until none is
left. Characters outside the vocabulary become their UTF-8 bytes' pieces.

No piece has U+2581 after another character (checked when the vocabulary is
read), so no merge crosses the start of a run of spaces and a text can be
encoded by segments that start there. Short segments are worked off together:
each round takes the head of every segment's agenda at once, as arrays. Long
ones use a heap.

``check`` compares with the sentencepiece library, batch by batch: every
segment a worker meets for the first time, or whole texts. A segment on which
the two differ takes the library's ids and is counted.

Edge cases: null text reads as empty and encodes to the begin and end ids alone.
Rows that repeat an identifier are encoded each on their own; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare
from playmetrics.llm.segments import SegmentIds

SPACE = "▁"
LONG = 48  # symbols; longer segments use the heap
NEVER = np.iinfo(np.int64).max
SLICE_BYTES = 1 << 20

_STATE: dict[str, PieceVocabulary] = {}


class PieceVocabulary:
    """Merge table, character table and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(size)]
        pieces = {lib.id_to_piece(i): i for i in range(size) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece joins characters across a space")
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        by_score = sorted(pieces.values(), key=lambda i: (-lib.get_score(i), i))
        self.rank = np.zeros(size, np.int64)
        self.rank[by_score] = np.arange(len(by_score))
        # symbols: piece ids, then one number per unknown character from ``size`` on
        self.size = size
        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        merges = [(pieces[p[:k]], pieces[p[k:]], i) for p, i in pieces.items()
                  for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces]
        table = np.array(merges, np.int64).reshape(-1, 3)
        keys = table[:, 0] << 32 | table[:, 1]
        order = np.argsort(keys)
        self.pair_keys, self.pair_pieces = keys[order], table[order, 2]
        self.segments = SegmentIds(self.encode_segments)
        self.checked = True
        self.mismatches = 0

    # -------------------------------------------------------------- the agenda

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that each pair joins to, or -1."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_pieces[at], -1)

    def _together(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge many segments at once: each round takes every segment's best pair."""
        place = np.arange(len(symbols))
        done_symbols, done_owner, done_place = [symbols[:0]], [owner[:0]], [place[:0]]
        joined = np.full(len(symbols), -1, np.int64)  # of a symbol and the next one
        same = owner[1:] == owner[:-1]
        joined[:-1][same] = self._joined(symbols[:-1][same], symbols[1:][same])
        while len(symbols):
            index = np.arange(len(symbols))
            key = np.where(joined >= 0, self.rank[joined] << 32 | index, NEVER)
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(key, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            over = np.repeat(best == NEVER, sizes)
            done_symbols.append(symbols[over])
            done_owner.append(owner[over])
            done_place.append(place[over])
            at = best[best != NEVER] & 0xFFFFFFFF
            symbols[at] = joined[at]
            keep = ~over
            keep[at + 1] = False
            moved = (np.cumsum(keep) - 1)[at]  # where the merged symbols stand now
            symbols, owner, place, joined = (x[keep] for x in (symbols, owner, place, joined))
            for left in (moved - 1, moved):
                left = left[(left >= 0) & (left < len(symbols) - 1)]
                joined[left] = np.where(owner[left] == owner[left + 1],
                                        self._joined(symbols[left], symbols[left + 1]), -1)
            last = moved[moved == len(symbols) - 1]
            joined[last] = -1
        symbols, owner, place = map(np.concatenate, (done_symbols, done_owner, done_place))
        order = np.argsort(place)
        return symbols[order], owner[order]

    def _alone(self, symbols: list[int]) -> list[int]:
        """Merge one segment with a heap of (rank, position, left, right, piece)."""
        n = len(symbols)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        joined = self._joined(np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64)).tolist()
        agenda = [(int(self.rank[p]), i, symbols[i], symbols[i + 1], p)
                  for i, p in enumerate(joined) if p >= 0]
        heapq.heapify(agenda)
        pairs = dict(zip(zip(symbols[:-1], symbols[1:], strict=True), joined, strict=True))

        def offer(i: int) -> None:
            if i < 0 or following[i] >= n:
                return
            pair = symbols[i], symbols[following[i]]
            if pair not in pairs:
                pairs[pair] = int(self._joined(np.array([pair[0]]), np.array([pair[1]]))[0])
            if pairs[pair] >= 0:
                heapq.heappush(agenda, (int(self.rank[pairs[pair]]), i, *pair, pairs[pair]))

        while agenda:
            _, i, left, right, piece = heapq.heappop(agenda)
            j = following[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = piece, -1
            following[i] = following[j]
            if following[i] < n:
                previous[following[i]] = i
            offer(previous[i])
            offer(i)
        return [s for s in symbols if s >= 0]

    # -------------------------------------------------------------- segments

    def encode_segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments whose spaces are still spaces; all ids, and how many each has."""
        text = b"".join(segments).decode("utf-8", "replace").replace(" ", SPACE)
        chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        lead = np.frombuffer(b"".join(segments), np.uint8) & 0xC0 != 0x80
        bounds = np.cumsum([0, *map(len, segments)])
        lengths = np.diff(np.concatenate([[0], np.cumsum(lead)])[bounds])
        owner = np.repeat(np.arange(len(segments)), lengths)
        symbols = self.of_char[chars].astype(np.int64)
        unknown = symbols < 0
        symbols[unknown] = self.size + chars[unknown]
        long = (lengths > LONG)[owner]
        out, out_owner = self._together(symbols[~long], owner[~long])
        parts, owners = [out], [out_owner]
        firsts = np.cumsum(lengths) - lengths
        for i in np.flatnonzero(lengths > LONG).tolist():
            merged = self._alone(symbols[firsts[i]:firsts[i] + lengths[i]].tolist())
            parts.append(np.array(merged, np.int64))
            owners.append(np.full(len(merged), i))
        out, out_owner = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(out_owner, kind="stable")
        out, out_owner = self._bytes(out[order], out_owner[order])
        counts = np.bincount(out_owner, minlength=len(segments))
        return self._compared(segments, out, counts) if self.checked else (out, counts)

    def _bytes(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace unknown characters by the pieces of their UTF-8 bytes."""
        unknown = np.flatnonzero(symbols >= self.size)
        if not len(unknown):
            return symbols.astype(np.uint32), owner
        encoded = [chr(c).encode() for c in (symbols[unknown] - self.size).tolist()]
        times = np.ones(len(symbols), np.int64)
        times[unknown] = list(map(len, encoded))
        out = np.repeat(symbols, times)
        out[np.repeat(symbols >= self.size, times)] = self.byte_ids[
            np.frombuffer(b"".join(encoded), np.uint8)]
        return out.astype(np.uint32), np.repeat(owner, times)

    def _compared(self, segments: list[bytes], ids: np.ndarray,
                  counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # every segment starts with the space that the library puts in front itself
        theirs = self.library.encode([s[1:].decode("utf-8", "replace") for s in segments],
                                     num_threads=1)
        lengths = np.fromiter(map(len, theirs), np.int64, len(theirs))
        lone = np.flatnonzero(lengths == 0)  # nothing follows the space: nothing to encode there
        flat = np.fromiter((i for x in theirs for i in x), np.uint32, lengths.sum())
        if len(lone) == 0 and np.array_equal(lengths, counts) and np.array_equal(flat, ids):
            return ids, counts
        ours = np.split(ids, np.cumsum(counts)[:-1])
        for k, found in enumerate(theirs):
            if found and ours[k].tolist() != found:
                self.mismatches += 1
                ours[k] = np.array(found, np.uint32)
        return np.concatenate(ours), np.fromiter(map(len, ours), np.int64, len(ours))

    # -------------------------------------------------------------- texts

    def encode_rows(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, row offsets into them), without begin and end ids."""
        from playmetrics.llm.wordstream import EXACT, byte_slices, span_hashes

        # U+2581 in a text is a space to the library, too
        column = pc.replace_substring(column, SPACE, " ")
        for first, data, offsets in byte_slices(column, SLICE_BYTES):
            filled = np.diff(offsets) > 0
            # the space in front of every text that is not empty
            data = np.insert(data, offsets[:-1][filled], 0x20)
            bounds = offsets + np.concatenate([[0], np.cumsum(filled)])
            space = data == 0x20
            start = space.copy()
            start[1:] &= ~space[:-1]
            start[bounds[:-1][filled]] = True
            starts = np.flatnonzero(start)
            ends = np.append(starts[1:], len(data))[:len(starts)]
            hashes = span_hashes(data, starts, ends, EXACT)
            ids, counts = self.segments.ids(hashes, starts, ends, data)
            yield first, ids, np.concatenate([[0], np.cumsum(counts)])[
                np.searchsorted(starts, bounds)]


def vocabulary(path: str) -> PieceVocabulary:
    if path not in _STATE:
        _STATE[path] = PieceVocabulary(path)
    return _STATE[path]


RESULT = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, mismatches long"


def encode_and_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                      check: str = "segments", with_ids: bool = False) -> DataFrame:
    """Ids with begin and end, and their decoding, per row, as counts and digests.

    ``check`` is "segments", "texts" or "none". ``mismatches`` counts what the
    check found and replaced: segments in the row's batch, or the row itself.
    ``with_ids`` adds ``ids array<int>`` and ``decoded string``.
    """
    prepare(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        vocab.checked = check == "segments"
        lib = vocab.library
        begin, end = lib.bos_id(), lib.eos_id()
        for batch in batches:
            texts = batch.column(1)
            before = vocab.mismatches
            for first, flat, offsets in vocab.encode_rows(texts):
                n = len(offsets) - 1
                rows = [[begin, *flat[a:b].tolist(), end]
                        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                wrong = [vocab.mismatches - before] * n
                if check == "texts":
                    theirs = lib.encode([t or "" for t in texts.slice(first, n).to_pylist()],
                                        add_bos=True, add_eos=True, num_threads=1)
                    wrong = [int(a != b) for a, b in zip(rows, theirs, strict=True)]
                    rows = theirs
                decoded = lib.decode(rows, num_threads=1)
                columns = [
                    batch.column(0).slice(first, n), pa.array(list(map(len, rows)), pa.int64()),
                    pa.array([hashlib.sha256(np.array(r, "<u4").tobytes()).hexdigest()
                              for r in rows]),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                    pa.array(wrong, pa.int64())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "mismatches"]
                if with_ids:
                    columns += [pa.array(rows, pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = RESULT + (", ids array<int>, decoded string" if with_ids else "")
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        work, schema).withColumnRenamed("id", id_col)
