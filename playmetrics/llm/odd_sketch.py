"""MinHash near-duplicates with odd sketches, confirmed on full shingle sets.

Per document: the set of hashed five-word shingles, ``bands * rows`` MinHash
samples, one bucket key per band, and an odd sketch: each (sample number,
value) toggles one of ``bits`` bits, so the XOR of two sketches has about
``bits / 2 * (1 - exp(-2 * m / bits))`` ones when ``m`` sampled elements differ,
which tells high similarities apart sharply.

1. Documents with equal sets form a class (grouped with map-side combine);
   only one member per class goes on, so copies are never paired.
2. In each bucket every class meets the class with most copies and ``TURNS`` pivots
   drawn by a hash of bucket and turn. That is a bounded number of pairs per
   membership, however large the bucket. A group without a common original grows
   together from many pivots before any of its members meet in pairs.
3. A pair goes on if the sizes allow the similarity, the odd sketch does not
   rule it out (chance of ruling out a true link: about 1e-6) and a parity bitmap
   of the whole sets does not either, and becomes a link if the full sets
   confirm it. The bitmap never rules out a true link: the XOR has at most as
   many ones as elements differ. On sets of up to about ``SET_BITS`` shingles it
   tells 0.75 from 0.7, so a large group of half-alike texts leaves few pairs.
4. Links give components.
5. The classes of buckets that hold several components after that meet by an
   exact prefix join on their full sets: shingles are put in one order, those
   that no two components share first and frequent ones last; two sets at the
   similarity must share one of the first few, however many share the frequent
   ones. How few depends on both sizes, so classes meet by (shingle, size bands),
   a match must leave room for the overlap behind its two places, and the parity
   bitmaps must allow it. Many texts that share a passage but are not alike thus
   make no pairs, since the passage stands at the end of their order.

After that, any two classes that share a bucket are in one component or not
alike. Two documents at similarity s share no bucket with probability
``(1 - s ** rows) ** bands``: 5e-6 at 0.75, less above.

Edge cases: a text without words has an empty set and is linked with nothing;
so is a row with a null identifier, whose component is null and which is kept. Rows that repeat
an identifier each get the component of their own set. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled, unused_name
from playmetrics.llm.components import components

BANDS, ROWS = 32, 4
BITS = 512
SET_BITS = 1024
WIDTH = 5
SIMILARITY = (75, 100)
TURNS = 2
SIGNATURE = ("doc_id long, n_shingles long, set_a long, set_b long, "
             "bands array<long>, sketch array<long>, parity array<long>")


# ------------------------------------------------------------------ signatures

def _constants(count: int) -> np.ndarray:
    rng = np.random.default_rng(977)
    return rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _fingerprint(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    from playmetrics.llm.wordstream import mix

    a = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
    b = np.bitwise_xor.reduceat(mix(values * np.uint64(0xD1342543DE82EF95)), starts)
    return a.view(np.int64), b.view(np.int64)


def _samples(values: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """MinHash samples, one row per non-empty set."""
    out = np.empty((len(starts), count), dtype=np.uint64)
    scaled = np.empty_like(values)
    for k, factor in enumerate(_constants(count)):
        np.multiply(values, factor, out=scaled)
        out[:, k] = np.minimum.reduceat(scaled, starts)
    return out


def odd_sketches(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity bitmap of the hashed (sample number, value) pairs, as 64-bit words."""
    from playmetrics.llm.wordstream import mix

    order = np.arange(1, samples.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    position = mix(samples ^ order) % np.uint64(bits)
    bit = np.uint64(1) << (position & np.uint64(63))
    word = position >> np.uint64(6)
    return np.stack([np.bitwise_xor.reduce(np.where(word == w, bit, np.uint64(0)), axis=1)
                     for w in range(bits // 64)], axis=1)


def set_parities(values: np.ndarray, starts: np.ndarray, bits: int = SET_BITS) -> np.ndarray:
    """Parity bitmap of each non-empty set itself, as 64-bit words."""
    from playmetrics.llm.wordstream import mix

    position = mix(values) % np.uint64(bits)
    bit = np.uint64(1) << (position & np.uint64(63))
    word = position >> np.uint64(6)
    return np.stack([np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), starts)
                     for w in range(bits // 64)], axis=1)


def most_ones(samples: int, bits: int, similarity: float, sigmas: float = 4.9) -> int:
    """Largest XOR population count that a pair at ``similarity`` or above may show.

    The count varies with how many samples differ and with how their positions
    fall; ``sigmas`` deviations of both together are allowed for.
    """
    apart = samples * (1 - similarity)
    untouched = (1 - 2 / bits) ** (2 * apart)
    ones = bits / 2 * (1 - untouched)
    by_samples = 2 * math.sqrt(samples * similarity * (1 - similarity)) * untouched
    by_positions = math.sqrt(ones * (1 - ones / bits))
    return math.ceil(ones + sigmas * math.hypot(by_samples, by_positions))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, bits: int = BITS,
               width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import mix, shingle_hashes, slices

        for batch in batches:
            ids = batch.column(0)
            for first, words in slices(batch.column(1)):
                values, offsets = shingle_hashes(words, width)
                sizes = np.diff(offsets)
                full = np.flatnonzero(sizes)
                n = len(sizes)
                set_a, set_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
                keys = np.zeros((n, bands), np.int64)
                sketch = np.zeros((n, bits // 64), np.int64)
                parity = np.zeros((n, SET_BITS // 64), np.int64)
                if len(full):
                    starts = offsets[full]
                    set_a[full], set_b[full] = _fingerprint(values, starts)
                    samples = _samples(values, starts, bands * rows)
                    sketch[full] = odd_sketches(samples, bits).view(np.int64)
                    parity[full] = set_parities(values, starts).view(np.int64)
                    parts = samples.reshape(len(full), bands, rows)
                    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :].repeat(len(full), 0)
                    for r in range(rows):
                        key = mix(key * np.uint64(0xD6E8FEB86659FD93) ^ parts[:, :, r])
                    keys[full] = key.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n), pa.array(sizes.astype(np.int64)), pa.array(set_a),
                     pa.array(set_b), _lists(keys), _lists(sketch), _lists(parity)],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch", "parity"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(sign, SIGNATURE)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()),
                                    pa.array(matrix.reshape(-1)))


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(class_id, n, shingles) of rows (class_id, text, set_a, set_b) whose set has that mark."""
    def list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import shingle_hashes, slices

        for batch in batches:
            for first, words in slices(batch.column(1)):
                values, offsets = shingle_hashes(words, width)
                n = len(offsets) - 1
                full = np.flatnonzero(np.diff(offsets))
                same = np.zeros(n, bool)
                if len(full):
                    a, b = _fingerprint(values, offsets[full])
                    same[full] = ((a == batch.column(2).slice(first, n).to_numpy()[full])
                                  & (b == batch.column(3).slice(first, n).to_numpy()[full]))
                sets = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                pa.array(values.view(np.int64)))
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), sets],
                                                 names=["class_id", "shingles"])
                yield out.filter(pa.array(same))

    return texts.mapInArrow(list_sets, "class_id long, shingles array<long>")


# ------------------------------------------------------------------ links

def _apart(a: str, b: str, words: int) -> Column:
    """Ones in the XOR of two bitmaps."""
    return sum((F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w])) for w in range(words)), F.lit(0))


def _alike(words: int, similarity: tuple[int, int], ones: int) -> Column:
    """Whether sizes, odd sketches and set parities allow the similarity of sides a and b."""
    part, whole = similarity
    n_a, n_b = F.col("n_a"), F.col("n_b")
    return ((whole * F.least(n_a, n_b) >= part * F.greatest(n_a, n_b))
            & (_apart("sketch_a", "sketch_b", words) <= ones) & _parities_allow(similarity))


def _parities_allow(similarity: tuple[int, int]) -> Column:
    """Of a + b elements at most the share (1 - s) / (1 + s) differs."""
    part, whole = similarity
    return (whole + part) * _apart("parity_a", "parity_b", SET_BITS // 64) <= (
        (whole - part) * (F.col("n_a") + F.col("n_b")))


def _side(frame: DataFrame, side: str, *more: str) -> DataFrame:
    """Class, size and bitmaps named for one side of a pair."""
    return frame.select(*more, F.col("class_id").alias(side), F.col("n").alias(f"n_{side}"),
                        F.col("sketch").alias(f"sketch_{side}"),
                        F.col("parity").alias(f"parity_{side}"))


def class_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, width: int, id_col: str,
               text_col: str) -> DataFrame:
    """(class_id, shingles) of the classes that ``ids`` (class_id) names, settled.

    A class may come twice where an identifier repeats.
    """
    marks = classes.join(ids, "class_id", "left_semi").select("class_id", "set_a", "set_b")
    texts = (docs.select(F.col(id_col).cast("long").alias("class_id"), F.col(text_col).alias("text"))
             .join(marks, "class_id").select("class_id", "text", "set_a", "set_b"))
    return _sets(texts, width).transform(settled)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class_id")).union(
        pairs.select(F.col("b").alias("class_id"))).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity.

    No grouping follows the joins here, so that Spark can split a pivot that very
    many classes share.
    """
    part, whole = similarity
    left = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("set_of_a"))
    right = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("set_of_b"))
    shared = F.size(F.array_intersect("set_of_a", "set_of_b"))
    union = F.size("set_of_a") + F.size("set_of_b") - shared
    return (pairs.join(left, "a").join(right, "b").where(whole * shared >= part * union)
            .select("a", "b"))


# ------------------------------------------------------------------ prefix join

BAND = 1.05  # sizes of a band differ by this factor at most
EARLIER = 16


def _band(size: Column) -> Column:
    return F.floor(F.log(size) / math.log(BAND)).cast("int")


def prefix_rows(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """What two alike sets of different parts must share, of (class_id, part, shingles).

    One row per class, band of partner sizes and shingle of the prefix: shingle, low,
    high (the two bands), class_id, part, n, place, own, other, and the ``EARLIER``
    shingles before it that could make rows. The order of the shingles is: those
    that only one part has, then by the number of classes that have them; only
    shingles of several parts make rows.
    """
    part, whole = similarity
    size = F.size("shingles")
    rows = sets.select("class_id", "part", size.alias("n"), F.explode("shingles").alias("shingle"))
    spread = (rows.groupBy("shingle")
              .agg(F.count(F.lit(1)).alias("classes"), F.min("part").alias("least"),
                   F.max("part").alias("most"))
              .where("least <> most").select("shingle", "classes").transform(settled))
    common = rows.join(spread, "shingle")
    mine = Window.partitionBy("class_id")
    place = (F.col("n") - F.count(F.lit(1)).over(mine)
             + F.row_number().over(mine.orderBy("classes", "shingle")) - 1)
    earlier = F.collect_list("shingle").over(
        mine.orderBy("classes", "shingle").rowsBetween(-EARLIER, -1))
    n = F.col("n")
    least_partner = F.ceil(n * part / whole)
    most_partner = F.floor(n * whole / part)
    placed = common.select("class_id", "part", "n", "shingle", place.cast("int").alias("place"),
                           earlier.alias("earlier")).where(F.col("place") <= n - least_partner)
    banded = placed.select("*", _band(n).alias("own"), F.explode(F.sequence(
        _band(least_partner), _band(most_partner))).alias("other"))
    # the smallest partner of the band, and the overlap that it asks for
    partner = F.greatest(least_partner, F.floor(F.pow(F.lit(BAND), F.col("other"))))
    overlap = F.ceil((n + partner) * part / (whole + part))
    return banded.where(F.col("place") <= n - overlap).select(
        "shingle", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "class_id", "part", "n", "place", "own", "other", "earlier")


def prefix_pairs(rows: DataFrame, similarity: tuple[int, int],
                 parities: DataFrame | None = None) -> DataFrame:
    """(a, b), a < b, of different parts: every pair at the similarity, and few others.

    Under a key, the largest part's classes do not meet each other. A pair that
    meets at an earlier shingle is not made again at a later one, as far as
    ``earlier`` tells. ``parities`` (class_id, parity) rule pairs out inside the join.
    """
    part, whole = similarity
    key = ["shingle", "low", "high"]
    parts = rows.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("size"))
    mixed = (parts.groupBy(*key).agg(F.count(F.lit(1)).alias("parts"),
                                     F.max(F.struct("size", "part")).alias("top"))
             .where("parts > 1").select(*key, F.col("top.part").alias("main")))
    inside = rows.join(mixed, key)
    carried = ["part", "n", "place", "own", "other", "main", "earlier"]
    if parities is not None:
        inside = inside.join(parities.select("class_id", "parity"), "class_id")
        carried.append("parity")
    inside = inside.transform(settled)

    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(*key, F.col("class_id").alias(name),
                            *[F.col(c).alias(f"{c}_{name}") for c in carried])

    a, b = side(inside.where("part <> main"), "a"), side(inside, "b")
    room = F.least(F.expr("n_a - place_a"), F.expr("n_b - place_b"))
    met = a.join(b, key).where(
        F.expr("part_a <> part_b and own_a = other_b and own_b = other_a")
        & (F.expr("part_b = main_b") | (F.col("a") < F.col("b")))
        & ((whole + part) * room >= part * (F.col("n_a") + F.col("n_b")))
        & ~F.arrays_overlap("earlier_a", "earlier_b")
        & (F.lit(True) if parities is None else _parities_allow(similarity)))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, bits: int = BITS,
                    width: int = WIDTH, similarity: tuple[int, int] = SIMILARITY,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Reads ``docs`` up to three times: signatures, then texts of candidate classes.
    """
    prepare(docs.sparkSession)
    words = bits // 64
    ones = most_ones(bands * rows, bits, similarity[0] / similarity[1])
    signed = signatures(docs, bands, rows, bits, width, id_col, text_col).transform(settled)
    classes = (signed.where("n_shingles > 0 and doc_id is not null")
               .groupBy("set_a", "set_b", "n_shingles")
               .agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"),
                    F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
                    F.first("parity").alias("parity"))
               .transform(settled))
    members = classes.select(F.explode("bands").alias("bucket"), "class_id",
                             F.col("class_id").alias("part"), "copies")
    plain = classes.select("class_id", F.col("n_shingles").alias("n"), "sketch", "parity")
    meeting = _company(members, F.struct((-F.col("copies")).alias("place"), "class_id", "part"))
    meeting = meeting.transform(settled)  # memberships of buckets with company

    alike = _alike(words, similarity, ones)
    tried = _allowed(_met(meeting), plain, alike).transform(settled)
    sets = class_sets(docs, classes, _ends(tried), width, id_col, text_col)
    links = confirmed(tried, sets, similarity).transform(settled)
    found = components(links).transform(settled)

    apart = _apart_still(meeting, found).transform(settled)
    if not apart.isEmpty():
        sets = class_sets(docs, classes, apart.select("class_id").distinct(), width, id_col,
                          text_col)
        pairs = _close(sets, apart, plain, similarity).join(tried, ["a", "b"], "left_anti")
        pairs = _allowed(pairs, plain, alike).transform(settled)
        more = confirmed(pairs, sets, similarity).transform(settled)
        if not more.isEmpty():
            stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
            found = components(stars.union(more)).transform(settled)
    class_of = (classes.select("set_a", "set_b", "n_shingles", "class_id")
                .join(found, F.col("class_id") == F.col("id"), "left")
                .select("set_a", "set_b", "n_shingles",
                        F.coalesce("component", "class_id").alias("component_id"))
                .transform(settled))  # so that the join below can split a set that many rows have
    return (signed.select("doc_id", "n_shingles", "set_a", "set_b")
            .join(class_of, ["set_a", "set_b", "n_shingles"], "left")
            .select(F.col("doc_id").alias(id_col), "n_shingles",
                    F.when(F.col("doc_id").isNotNull(),
                           F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def _apart_still(meeting: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, class_id, part) of the buckets that hold several components."""
    placed = (meeting.select("bucket", "class_id")
              .join(found, F.col("class_id") == F.col("id"), "left")
              .select("bucket", "class_id", F.coalesce("component", "class_id").alias("part")))
    mixed = (placed.groupBy("bucket").agg(F.min("part").alias("least"), F.max("part").alias("most"))
             .where("least <> most").select("bucket"))
    return placed.join(mixed, "bucket", "left_semi")


def _company(apart: DataFrame, *leaders: Column, turns: int = TURNS) -> DataFrame:
    """(bucket, class_id, part, pivots): rows whose bucket has company, and the bucket's pivots.

    Pivots are the classes with the least of each of ``leaders`` and those drawn.
    """
    drawn = [F.struct(F.xxhash64(F.lit(turn), "bucket", "class_id").alias("place"), "class_id",
                      "part") for turn in range(turns)]
    least = F.array(*[F.min(x) for x in (*leaders, *drawn)])
    pivots = (apart.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), least.alias("least"))
              .where("size > 1")
              .select("bucket", F.array_distinct(F.transform("least", lambda p: F.struct(
                  p["class_id"].alias("class_id"), p["part"].alias("part")))).alias("pivots")))
    return apart.select("bucket", "class_id", "part").join(pivots, "bucket")


def _met(company: DataFrame) -> DataFrame:
    """(a, b), a < b: every class and the pivots of each of its buckets, if their parts differ."""
    met = company.select("class_id", "part", F.explode("pivots").alias("p")).where("part <> p.part")
    return met.select(F.least("class_id", "p.class_id").alias("a"),
                      F.greatest("class_id", "p.class_id").alias("b")).distinct()


def _turns(apart: DataFrame, turns: int = TURNS) -> DataFrame:
    """(a, b), a < b: every class and the drawn pivots of each of its buckets, if their parts differ."""
    return _met(_company(apart, turns=turns))


def _close(sets: DataFrame, apart: DataFrame, plain: DataFrame,
           similarity: tuple[int, int]) -> DataFrame:
    """(a, b), a < b: every pair of classes of different parts that is alike, and few others."""
    rows = sets.dropDuplicates(["class_id"]).join(
        apart.select("class_id", "part").distinct(), "class_id")
    return prefix_pairs(prefix_rows(rows, similarity).transform(settled), similarity, plain)


def _allowed(pairs: DataFrame, plain: DataFrame, alike: Column) -> DataFrame:
    """The pairs whose sizes, sketches and bitmaps allow the similarity."""
    return (pairs.join(_side(plain, "a"), "a").join(_side(plain, "b"), "b").where(alike)
            .select("a", "b"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose identifier stands for its component; a repeated row stays once."""
    kept_id = unused_name(docs, "kept_id")
    kept = (near_duplicates(docs, id_col=id_col, text_col=text_col).where("kept")
            .select(F.col(id_col).alias(kept_id)).distinct())
    found = docs.join(kept, docs[id_col] == F.col(kept_id), "left_semi")
    # the join has dealt the rows by identifier, so this window needs no exchange
    rank = unused_name(docs, "rank")
    first = Window.partitionBy(id_col, text_col).orderBy(F.lit(1))
    once = found.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
    return once.select(docs.columns).union(docs.where(F.col(id_col).isNull()))
