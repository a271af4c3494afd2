"""Phrases whose words keep together, counted by dynamic itemset counting.

The words of all texts are written once as 64-bit values (a hash of word and
language, 0 between pieces), dealt over ``shards`` parts of the checkpoint folder;
a block lists its distinct values and says by number where they stand. The parts are
then scanned in a circle, one step each:

* words are counted from the first step on;
* a longer phrase is activated for the step after both its subphrases (all words
  but the last, all but the first) have been counted ``least`` times so far, so
  phrases of all lengths are counted side by side in one scan;
* every phrase is counted for exactly one full circle from its activation, hence
  once over every text, and then rests.

The scans end when the last phrase has come full circle. A phrase that occurs
``least`` times has subphrases that do so as well and is activated in time; its count is
exact.

What a step needs to know of earlier ones is a table of bytes, one for each slot of
the hash space: the step at which a phrase of that slot reached ``least``. Its size
follows the number of words and ends at ``2 ** MOST_BITS`` bytes, whatever the
corpus. Phrases that share a slot can only be activated early, which costs time
and no exactness: a slot never changes once set, so a phrase keeps its circle, and what
stays below ``least`` goes when it is complete. Counts live in bucketed tables in the
checkpoint folder, so that a step shuffles the counts it adds, combined before that, and
not those it adds them to.

Only one occurrence of a word in ``NAMED`` is asked for its spelling, since one of the
``least`` would do. Should a frequent word be left without, all are asked.

Two phrases share a 64-bit hash with a chance of about 2**-60.

Edge cases: null texts are empty and have no phrases; a null language reads as
``und``; repeated rows count each time; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled, shuffle_partitions, tidy
from playmetrics.session import scratch_path
from playmetrics.sources import files

LEAST = 100
LONGEST = 5
BEST = 2000
SHARE = (100, 100)  # a candidate goes if a longer one has this share of its count
SHARDS = 4
FEWEST_BITS, MOST_BITS = 16, 28
BUFFER = 2_000_000  # phrases a task holds before it adds them up
NAMED = 4
BITMAP = 8 * 4096  # bits in one of Spark's bitmaps
NEVER = 255

BREAKS = np.zeros(256, dtype=bool)  # bytes that end a piece
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
OUTSIDE = BREAKS.copy()
OUTSIDE[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_FACTORS = (np.random.default_rng(60210).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2)
            + np.uint64(1))

NAME = pa.struct([("value", pa.int64()), ("lang", pa.string()), ("word", pa.string())])
TOTAL = pa.struct([("lang", pa.string()), ("n", pa.int64())])
WRITTEN = ("shard int, kinds binary, words binary, names array<struct<value:long,lang:string,word:string>>, "
           "totals array<struct<lang:string,n:long>>")


# ------------------------------------------------------------------ words, written once

def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _unseen(distinct: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted values are not among the sorted ``seen``, and both together."""
    place = np.searchsorted(seen, distinct)
    new = np.ones(len(distinct), dtype=bool)
    inside = place < len(seen)
    new[inside] = seen[place[inside]] != distinct[inside]
    return new, np.insert(seen, place[new], distinct[new])


def _one(values: pa.Array) -> pa.Array:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _number(kinds: int) -> type:
    """What holds the number of each of so many values."""
    return np.uint16 if kinds <= 1 << 16 else np.uint32


def _block(words, langs: list[str], seen: np.ndarray, named: int) -> tuple[list, np.ndarray]:
    """Values and their places, with 0 between pieces; names of words not in ``seen``; totals."""
    from playmetrics.llm.wordstream import mix

    counts = np.diff(words.offsets)
    kinds, kind_of = np.unique(np.array(langs, dtype=object).astype(str), return_inverse=True)
    kinds = kinds.tolist()
    salts = np.array([_salt(lang) for lang in kinds], np.uint64)
    lang_of = np.repeat(kind_of, counts)
    values = mix(words.hashes ^ salts[lang_of])
    values[values == 0] = 1
    n = len(values)
    broken = np.concatenate([[0], np.cumsum(BREAKS[words.data])])
    apart = broken[words.starts[1:]] > broken[words.ends[:-1]]
    row = np.repeat(np.arange(len(counts)), counts)
    apart |= row[1:] != row[:-1]
    place = np.arange(n)
    place[1:] += np.cumsum(apart)
    distinct, number = np.unique(values, return_inverse=True)
    known = np.insert(distinct, 0, np.uint64(0))
    spread = np.zeros(int(place[-1]) + 1, _number(len(known)))
    spread[place] = number + 1
    turn = mix(np.arange(n, dtype=np.uint64) ^ values[-1])
    asked = np.flatnonzero(turn % np.uint64(named) == 0)
    fresh, first = np.unique(values[asked], return_index=True)
    new, seen = _unseen(fresh, seen)
    fresh, first = fresh[new], asked[first[new]]
    raw = _LOWER[words.data].tobytes()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in
             zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
    names = pa.StructArray.from_arrays(
        [pa.array(fresh.view(np.int64)), pa.array([kinds[i] for i in lang_of[first]], pa.string()),
         pa.array(texts, pa.string())], fields=list(NAME))
    by_lang = np.bincount(lang_of, minlength=len(kinds))
    totals = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(by_lang)],
                                        fields=list(TOTAL))
    packed = [pa.array([x.tobytes()], pa.binary()) for x in (known, spread)]
    return [*packed, _one(names), _one(totals)], seen


def write_words(texts: DataFrame, shards: int, path: str, named: int = NAMED) -> None:
    """(lang, text) as blocks of words, dealt over ``shards`` folders."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from playmetrics.llm.wordstream import slices

        shard, seen = TaskContext.get().partitionId(), np.zeros(0, np.uint64)
        for batch in batches:
            langs = pc.fill_null(batch.column(0), "und")
            for first, words in slices(batch.column(1), outside=OUTSIDE):
                if len(words.hashes):
                    mine = langs.slice(first, len(words.offsets) - 1).to_pylist()
                    columns, seen = _block(words, mine, seen, named)
                    shard += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard % shards], pa.int32()), *columns],
                        names=["shard", "kinds", "words", "names", "totals"])

    (texts.mapInArrow(encode, WRITTEN).write.partitionBy("shard")
     .option("compression", "zstd").parquet(path))


# ------------------------------------------------------------------ phrases of a block

def phrases(words: np.ndarray, table: np.ndarray, longest: int) -> Iterator[tuple]:
    """(k, places, hashes, step) of the phrases of k >= 2 words with both subphrases reached.

    ``step`` is the last of the steps at which the subphrases and all phrases within
    reached the threshold; ``hashes`` spans the block, with 0 elsewhere.
    """
    from playmetrics.llm.wordstream import mix

    mask = np.uint64(len(table) - 1)
    reached = table[words & mask]
    reached[words == 0] = NEVER
    raw = words * _FACTORS[0]
    for k in range(2, longest + 1):
        room = len(words) - k + 1
        if room <= 0:
            return
        later = np.maximum(reached[:room], reached[1:room + 1])
        places = np.flatnonzero(later != NEVER)
        raw[places] += words[places + k - 1] * _FACTORS[k - 1]
        hashes = np.zeros(len(words), np.uint64)
        hashes[places] = mix(raw[places] ^ _FACTORS[-k])
        yield k, places, hashes, later[places]
        reached = np.full(len(words), NEVER, np.uint8)
        # a slot that another phrase set does not activate before the words within have
        reached[places] = np.maximum(table[hashes[places] & mask], later[places])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The words of rows (kinds, words)."""
    for batch in batches:
        for kinds, words in zip(batch.column(0), batch.column(1), strict=True):
            known = np.frombuffer(kinds.as_buffer(), np.uint64)
            yield known[np.frombuffer(words.as_buffer(), _number(len(known)))]


COUNTED = "phrase long, mark int, n long"


def _count(blocks: DataFrame, sent, step: int, shards: int, longest: int) -> DataFrame:
    """Occurrences of the phrases that are active at ``step``; mark = 8 * first step + length."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes, marks, held = sent.value, [], [], 0

        def added_up() -> pa.RecordBatch:
            distinct, first, n = np.unique(np.concatenate(hashes), return_index=True,
                                           return_counts=True)
            mark = np.concatenate(marks)[first]
            return pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(mark, pa.int32()), pa.array(n)],
                names=["phrase", "mark", "n"])

        for words in _blocks(batches):
            if step < shards:
                hashes.append(words[words != 0])
                marks.append(np.ones(len(hashes[-1]), np.int16))
                held += len(hashes[-1])
            for k, places, dense, later in phrases(words, table, longest):
                first = later.astype(np.int16) + 1
                active = (first <= step) & (step < first + shards)
                hashes.append(dense[places[active]])
                marks.append(first[active] * 8 + k)
                held += len(hashes[-1])
            if held >= BUFFER:
                yield added_up()
                hashes, marks, held = [], [], 0
        if held:
            yield added_up()

    return blocks.select("kinds", "words").mapInArrow(count, COUNTED)


def _marked(phrases_of: DataFrame, bits: int) -> np.ndarray:
    """Which slots hold one of the phrases; what reaches the driver is a bit for each slot."""
    slot = F.col("phrase").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (phrases_of.select(slot.alias("slot"))
            .groupBy(F.expr(f"slot div {BITMAP}").alias("part"))
            .agg(F.bitmap_construct_agg((F.col("slot") % BITMAP).cast("long")).alias("bits")))
    marked = np.zeros(1 << bits, dtype=bool)
    for part, packed in rows.collect():
        at = part * BITMAP
        found = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
        marked[at:at + BITMAP] = found[:len(marked) - at]
    return marked


def frequent(spark: SparkSession, path: str, bits: int, shards: int, least: int,
             longest: int) -> tuple[DataFrame, int]:
    """(phrase, k, n) of all phrases of up to ``longest`` words, settled, and the steps taken."""
    table = np.full(1 << bits, NEVER, np.uint8)
    parts = spark.read.parquet(path)
    state, step, last = None, 0, -1
    while step <= last + shards:
        sent = spark.sparkContext.broadcast(table)
        mine = parts.where(F.col("shard") == step % shards)
        added = _count(mine, sent, step, shards, longest)
        # what is complete and below the threshold is done with
        complete = F.expr(f"mark div 8 + {shards - 1} <= {step}")
        now, name = scratch_path(spark, "phrase-counts"), f"phrase_counts_{uuid.uuid4().hex}"
        with tidy(spark):
            added = added.groupBy("phrase").agg(F.max("mark").alias("mark"), F.sum("n").alias("n"))
            if state is not None:
                added = _sum_of(spark.table(state[0]), added)
            (added.where(~complete | (F.col("n") >= least))
             .write.bucketBy(shuffle_partitions(spark), "phrase").option("path", now)
             .saveAsTable(name))
        sent.destroy()
        if state is not None:
            _drop(spark, *state)
        state = name, now
        counted = spark.table(name).where(F.col("n") >= least)
        shorter = _marked(counted.where(F.col("mark") % 8 < longest), bits)
        new = shorter & (table == NEVER)
        if new.any():
            table[new], last = step, step
        step += 1
    found = spark.table(state[0]).where(F.col("n") >= least)
    found = found.select("phrase", (F.col("mark") % 8).alias("k"), "n").transform(settled)
    _drop(spark, *state)
    return found, step


def _sum_of(state: DataFrame, added: DataFrame) -> DataFrame:
    """The counts of both; neither has a phrase twice. The state's buckets stay where they are."""
    both = state.alias("s").join(added.alias("t"), "phrase", "full_outer")
    return both.select("phrase", F.coalesce("s.mark", "t.mark").alias("mark"),
                       (F.coalesce("s.n", F.lit(0)) + F.coalesce("t.n", F.lit(0))).alias("n"))


def _drop(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"DROP TABLE {name}")
    files.remove(spark, path)


# ------------------------------------------------------------------ from hashes back to words

MADE = "phrase long, k int, words array<long>, heads array<long>, tails array<long>"


def _recover(blocks: DataFrame, sent, longest: int, one_in: int) -> DataFrame:
    """Words of the marked phrases, and hashes of their first and last 1, 2, ... words.

    A block tells them of those phrases that it is one of ``one_in`` blocks to tell.
    """
    def recover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import mix

        reached, wanted = sent.value
        mask = np.uint64(len(wanted) - 1)
        table = np.where(reached, np.uint8(0), np.uint8(NEVER))
        seen = [np.zeros(0, np.uint64)] * (longest + 1)
        for words in _blocks(batches):
            dense = [words, words]  # by length
            for k, places, hashes, _ in phrases(words, table, longest):
                dense.append(hashes)
                places = places[wanted[hashes[places] & mask]]
                if one_in > 1:
                    turn = mix(hashes[places] ^ np.uint64(len(words)) ^ words[-1])
                    places = places[turn % np.uint64(one_in) == 0]
                distinct, first = np.unique(hashes[places], return_index=True)
                new, seen[k] = _unseen(distinct, seen[k])
                if not new.any():
                    continue
                at = places[first[new]]
                columns = [np.stack([words[at + i] for i in range(k)], axis=1),
                           np.stack([dense[j][at] for j in range(1, k)], axis=1),
                           np.stack([dense[j][at + k - j] for j in range(1, k)], axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct[new].view(np.int64)),
                     pa.array(np.full(len(at), k, np.int32)), *map(_lists, columns)],
                    names=["phrase", "k", "words", "heads", "tails"])

    return blocks.select("kinds", "words").mapInArrow(recover, MADE)


TURNS = (16, 8, 4, 1)


def _made(blocks: DataFrame, counts: DataFrame, bits: int, shards: int,
          longest: int) -> DataFrame:
    """(phrase, k, words, heads, tails) of every counted phrase of two words and more.

    A frequent phrase is in many blocks of which one would do. So the first part is
    asked with one block in 16 telling of a phrase, the next with one in 8, and so
    on; what is still unknown in the end is looked for in all parts.
    """
    spark = blocks.sparkSession
    reached = _marked(counts, bits)
    left, found = counts.where("k > 1").select("phrase"), None
    asked = [(F.col("shard") == i, one_in) for i, one_in in enumerate(TURNS[:shards])]
    for part, one_in in [*asked, (F.lit(True), 1)]:
        sent = spark.sparkContext.broadcast((reached, _marked(left, bits)))
        told = (_recover(blocks.where(part), sent, longest, one_in).groupBy("phrase")
                .agg(F.first(F.struct("k", "words", "heads", "tails")).alias("m"))
                .join(left, "phrase", "left_semi").select("phrase", "m.*").transform(settled))
        sent.destroy()
        found = told if found is None else found.unionByName(told)
        left = left.join(told, "phrase", "left_anti").transform(settled)
        if left.isEmpty():
            break
    return found


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()),
                                    pa.array(np.ascontiguousarray(matrix).reshape(-1).view(np.int64)))


def _named(blocks: DataFrame, values: DataFrame) -> DataFrame:
    """(value, lang, word) of those of the words whose spelling the blocks tell."""
    return (blocks.select(F.inline("names")).join(values, "value")
            .groupBy("value").agg(F.first(F.struct("lang", "word")).alias("name"))
            .select("value", "name.lang", "name.word").transform(settled))


def _scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each candidate (phrase, lang, a, k, heads, tails)."""
    cuts = candidates.select(
        "phrase", "lang", "a", F.posexplode("heads").alias("cut", "head"), "tails", "k").select(
        "phrase", "lang", "a", "cut", "head", F.expr("tails[k - cut - 2]").alias("tail"))
    left = counts.select(F.col("phrase").alias("head"), F.col("n").alias("l"))
    right = counts.select(F.col("phrase").alias("tail"), F.col("n").alias("r"))
    wide = "cast({} as decimal(38, 0))"
    score = F.expr(f"1000 * {wide.format('a')} * n div ({wide.format('l')} * r)")
    return (cuts.join(left, "head").join(right, "tail").join(totals, "lang")
            .withColumn("score", score).groupBy("phrase", "lang", "a")
            .agg(F.min(F.struct("score", "cut", "l", "r", "n")).alias("low"))
            .select("phrase", "lang", "a", "low.l", "low.r", "low.n", "low.score"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST,
                 share: tuple[int, int] = SHARE, shards: int = SHARDS, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``best`` phrases.

    ``longest`` is at most 7 words. The result, at most ``best`` rows a language, is
    settled, and the tables made on the way are removed.
    """
    spark = prepare(docs.sparkSession)
    path = scratch_path(spark, "phrase-words")
    texts = docs.select(F.col(lang_col).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    write_words(texts, shards, path, NAMED)
    blocks = spark.read.schema(WRITTEN).parquet(path)
    totals = (blocks.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("n"))
              .transform(settled))
    words = totals.agg(F.sum("n")).first()[0] or 0
    bits = min(max(FEWEST_BITS, int(8 * words // least).bit_length()), MOST_BITS)
    if not words:
        return _empty(spark)
    counts, _ = frequent(spark, path, bits, shards, least, longest)
    made = _made(blocks, counts, bits, shards, longest)
    frequent_words = counts.where("k = 1").select(F.col("phrase").alias("value"))
    names = _named(blocks, frequent_words)
    left = frequent_words.join(names, "value", "left_anti").transform(settled)
    if not left.isEmpty():
        again = scratch_path(spark, "phrase-words")
        write_words(texts, shards, again, named=1)
        names = names.union(_named(spark.read.schema(WRITTEN).parquet(again), left))
        files.remove(spark, again)
    candidates = (counts.where("k > 1").select("phrase", F.col("n").alias("a")).join(made, "phrase")
                  .withColumn("value", F.col("words")[0])
                  .join(names.select("value", "lang"), "value").drop("value").transform(settled))

    part, whole = share
    # a longer phrase around this one has one of a single word more inside it
    around = candidates.where("k > 2").select(
        F.explode(F.array(F.expr("heads[k - 2]"), F.expr("tails[k - 2]"))).alias("phrase"),
        F.col("a").alias("outer")).groupBy("phrase").agg(F.max("outer").alias("outer"))
    alone = (candidates.join(around, "phrase", "left")
             .where(F.coalesce(whole * F.col("outer") < part * F.col("a"), F.lit(True)))
             .drop("outer"))
    scored = _scored(alone, counts, totals)
    order = [F.desc("score"), F.desc("a")]
    ahead = (scored.withColumn("ahead", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
             .where(F.col("ahead") <= best).drop("ahead"))
    spelled = (ahead.join(candidates.select("phrase", "words"), "phrase")
               .select("*", F.posexplode("words").alias("place", "value")).drop("words")
               .join(names.select("value", "word"), "value")
               .groupBy("phrase", "lang", "a", "l", "r", "n", "score")
               .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))),
                                             lambda x: x["word"]), " ").alias("text")))
    place = Window.partitionBy("lang").orderBy(*order, "text")
    result = (spelled.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= best)
              .select(F.col("lang").alias(lang_col), F.col("rank").cast("long").alias("rank"),
                      F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
              .transform(settled))
    files.remove(spark, path)
    return result


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, "
                                     "r long, n long, score long")
