"""Operator 11 -- phrase collocations: frequent n-grams by mergeable Misra-Gries
summaries, then an exact count.

First pass.  Each task hashes its n-grams (1 to ``max_words`` words, per
language), adds up equal ones and hands on one summary per hash partition (the
leading bits of the hash): sorted keys with counts.  A hash partition merges
its summaries.  Whenever the merged one outgrows its capacity, the count of
the first entry beyond it is subtracted from all and entries without a count
go.  All that is ever subtracted in a partition stays below half the
threshold: the capacity starts at twice the expected mass over the threshold
and doubles whenever a subtraction would exceed that.  So each n-gram found
``threshold`` times ends with a count above zero, and entries that cannot have
reached the threshold go at the end.  What survives sets a bit in a bitmap of
fixed size (another n-gram may share the bit: one more to count, none lost).

Second pass.  The texts are read again; n-grams with a set bit are counted
exactly: added up in the task, then per hash partition by language and phrase.

A phrase is scored by its weakest cut: floor(1000 * a * n / (l * r)) with a, l, r
the counts of the phrase and the parts and n the words of its language, in
38-digit decimals.  A candidate inside a longer one that is (nearly) as
frequent is dropped.

Memory: a task holds ``HELD`` hashes; a hash partition about 8 million n-grams'
worth of mass, its summary far less; the bitmap has 32 MB whatever the input.
A language, line or phrase with any share of the rows is added up in its tasks
first, and its n-grams spread over all hash partitions.

Defined cases: null and empty texts have no words; a null language counts as
``und`` (as does that name itself); repeated rows count each; words are
compared by 64-bit hashes inside a task and by their text across tasks; an
empty table gives no phrase.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.arrow_text import LOWER, Spans, TextSlice, bounded_batches, byte_classes, mix64, slices
from tessera.operators.sinks import materialize

THRESHOLD = 100
MAX_WORDS = 5
#: Hashes that a task holds before it adds them up; n-grams of a hash partition.
HELD, PARTITION_MASS = 1 << 22, 1 << 23
BITMAP_BITS = 28
#: Phrases that a task adds up before it hands them on.
PHRASES = 1 << 18
KEY_BITS = 32
#: Up to so many languages their totals are broadcast.
LANGUAGES = 100_000

#: Spaces and tabs separate words; the others end a piece.
_CLASSES = byte_classes(c0=" \t.,;:!?\n\x0b\x0c\r")
_ENDS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """The words of a slice and, for each length, where n-grams start."""

    def __init__(self, part: TextSlice, langs: list[str]):
        self.words = words = Spans(part, _CLASSES)
        text = np.repeat(np.arange(len(part)), words.per_text())
        # Words of one piece: as many piece ends before each, and one text.
        ends = np.concatenate([[0], np.cumsum(_ENDS[part.data])])[words.starts]
        self.data, self.text = part.data, text
        seeds = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
        seed = np.array([seeds[x] for x in langs], np.uint64)
        self.word_hash = words.hashes(LOWER) if len(words) else np.zeros(0, np.uint64)
        self.seed = seed[text] if len(text) else np.zeros(0, np.uint64)
        # How many words follow in the same piece.
        n = len(text)
        last = np.ones(n, bool)
        if n:
            last[:-1] = (text[1:] != text[:-1]) | (ends[1:] != ends[:-1])
        stop = np.flatnonzero(last)
        self.room = stop[np.searchsorted(stop, np.arange(n))] - np.arange(n) + 1 if n else np.zeros(0, np.int64)

    def hashes(self, max_words: int):
        """(n, starts, hashes) for n = 1 .. max_words."""
        if not len(self.room):
            return
        at = np.arange(len(self.room))
        h = mix64(self.word_hash + self.seed)
        yield 1, at, h
        for n in range(2, max_words + 1):
            fits = self.room[at] >= n
            at, h = at[fits], h[fits]
            h = mix64(h * _MIX + self.word_hash[at + n - 1])
            yield n, at, h

    def phrase(self, start: int, n: int) -> str:
        s, e = self.words.starts, self.words.ends
        return b" ".join(LOWER[self.data[s[i]:e[i]]].tobytes() for i in range(start, start + n)).decode("utf-8", "replace")


def _added_up(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(keys) else counts)


class Summary:
    """A mergeable Misra-Gries summary whose total subtraction stays within
    ``budget``; a true count is at most the kept one plus ``taken``."""

    def __init__(self, capacity: int, budget: int):
        self.capacity, self.budget, self.taken = max(1, capacity), budget, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = _added_up(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        while len(self.keys) > self.capacity:
            n = len(self.counts)
            extra = int(np.partition(self.counts, n - self.capacity - 1)[n - self.capacity - 1])
            if self.taken + extra > self.budget:
                self.capacity *= 2
                continue
            self.taken += extra
            left = self.counts > extra
            self.keys, self.counts = self.keys[left], self.counts[left] - extra

    def survivors(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.taken >= threshold]


def _prepared(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))


def summaries(texts: DataFrame, bits: int, max_words: int = MAX_WORDS) -> DataFrame:
    """part, n, keys, counts: one row per task (and fill of its memory) and
    hash partition.  Keys are the hash bits after the partition's, sorted."""
    def summarise(batches):
        held, n = [], 0

        def flush():
            keys, counts = _added_up(np.concatenate(held) >> np.uint64(64 - KEY_BITS - bits))
            edges = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS))
            small, counts = (keys & np.uint64((1 << KEY_BITS) - 1)).astype("<u4"), counts.astype("<i8")
            filled = np.flatnonzero(np.diff(edges))
            for some in np.array_split(filled, max(1, len(keys) >> 20)):
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(some, pa.int32()),
                    "keys": pa.array([small[edges[p]:edges[p + 1]].tobytes() for p in some], pa.binary()),
                    # Most counts are small: squeezed, they take little room.
                    "counts": pa.array([zlib.compress(counts[edges[p]:edges[p + 1]].tobytes(), 1) for p in some], pa.binary())})

        for part in slices(batches):
            for _, _, h in Grams(part, part.column("lang").to_pylist()).hashes(max_words):
                held.append(h)
                n += len(h)
            if n > HELD:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return texts.mapInArrow(summarise, "part int, keys binary, counts binary")


def survivor_bits(texts: DataFrame, mass: int, bits: int, threshold: int = THRESHOLD, max_words: int = MAX_WORDS,
                  bitmap_bits: int = BITMAP_BITS) -> bytes:
    """The bitmap of the n-grams that may occur ``threshold`` times.  ``mass``:
    about how many n-grams there are (it sets the first capacity);
    2 ** ``bits`` hash partitions."""
    budget = (threshold - 1) // 2
    capacity = (mass >> bits) // max(1, budget) + 1
    width = 1 << (bitmap_bits - bits)

    def merge(batches):
        current, summary, waiting, n = None, None, [], 0

        def absorb():
            nonlocal waiting, n
            if waiting:
                summary.merge(*(np.concatenate(x) for x in zip(*waiting)))
                waiting, n = [], 0

        def done():
            absorb()
            place = np.zeros(width, bool)
            place[summary.survivors(threshold) >> np.uint32(KEY_BITS - (bitmap_bits - bits))] = True
            return pa.RecordBatch.from_pydict({
                "part": pa.array([current], pa.int32()), "bits": pa.array([zlib.compress(np.packbits(place).tobytes(), 1)])})

        for batch in batches:
            for part, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if part != current:
                    if current is not None:
                        yield done()
                    current, summary = part, Summary(capacity, budget)
                waiting.append((np.frombuffer(keys, "<u4"), np.frombuffer(zlib.decompress(counts), "<i8")))
                n += len(waiting[-1][0])
                if n > 1 << 20:
                    absorb()
        if current is not None:
            yield done()

    partial = summaries(texts, bits, max_words).repartition("part").sortWithinPartitions("part")
    out = np.zeros((1 << bits, width // 8), np.uint8)
    for row in partial.mapInArrow(merge, "part int, bits binary").collect():
        out[row["part"]] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return out.tobytes()


def exact_counts(texts: DataFrame, bitmap: bytes, bits: int, threshold: int = THRESHOLD, max_words: int = MAX_WORDS,
                 bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """lang, phrase, words, f of the n-grams with a set bit that occur
    ``threshold`` times; the row without a phrase has the number of all words
    of its language.  Like the summaries, a task's counts travel packed, one
    Arrow table per hash partition; a partition is added up by the texts of its
    phrases."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def packed(part: int, table: pa.Table) -> tuple[int, bytes]:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
            out.write_table(table)
        return part, sink.getvalue().to_pybytes()

    def count(batches):
        table = np.frombuffer(shared.value, np.uint8)
        names: dict[int, tuple[str, int, str]] = {}  # of each hash
        held: list[tuple[np.ndarray, np.ndarray]] = []
        totals: Counter = Counter()

        def rows(lang, phrase, words, f) -> pa.Table:
            return pa.table({"lang": pa.array(lang, pa.string()), "phrase": pa.array(phrase, pa.string()),
                             "words": pa.array(words, pa.int32()), "f": pa.array(f, pa.int64())})

        def batch(found: list[tuple[int, bytes]]):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int32(), pa.binary()))],
                                              names=["part", "rows"])

        def flush():
            kinds, times = _added_up(*(np.concatenate(x) for x in zip(*held)))  # in order of the hash
            lang, words, phrase = zip(*(names[k] for k in kinds.tolist()))
            whole = rows(lang, phrase, words, times)
            part = (kinds >> np.uint64(64 - bits)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            held.clear()
            names.clear()
            return batch([packed(int(part[i]), whole.slice(i, j - i)) for i, j in zip(first, [*first[1:], len(part)])])

        for part in slices(batches):
            langs = part.column("lang").to_pylist()
            grams = Grams(part, langs)
            for lang, k in zip(langs, grams.words.per_text().tolist()):
                totals[lang] += k
            for n, at, h in grams.hashes(max_words):
                place = (h >> np.uint64(64 - bitmap_bits)).astype(np.int64)
                hit = np.flatnonzero((table[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1)
                kinds, first, times = np.unique(h[hit], return_index=True, return_counts=True)
                if not len(kinds):
                    continue
                held.append((kinds, times))
                start = at[hit[first]]
                for i, kind in enumerate(kinds.tolist()):
                    if kind not in names:
                        k = int(start[i])
                        names[kind] = langs[grams.text[k]], n, grams.phrase(k, n)
            if len(names) > PHRASES or len(held) > 500:
                yield flush()
        if held:
            yield flush()
        # The languages' totals are a partition of their own.
        if totals:
            yield batch([packed(-1, rows(list(totals), [None] * len(totals), [0] * len(totals), list(totals.values())))])

    def add_up(batches):
        current, tables = None, []

        def done():
            found = pa.concat_tables(tables).group_by(["lang", "phrase", "words"]).aggregate([("f", "sum")])
            found = found.rename_columns(["lang", "phrase", "words", "f"])
            kept = pc.or_(pc.greater_equal(found["f"], threshold), pc.equal(found["words"], 0))
            return found.filter(kept).combine_chunks().to_batches()

        for rows in batches:
            for part, data in zip(rows.column(0).to_pylist(), rows.column(1)):
                if part != current:
                    if current is not None:
                        yield from done()
                    current, tables = part, []
                tables.append(pa.ipc.open_stream(data.as_buffer()).read_all())
                if len(tables) > 64:
                    tables = [pa.concat_tables(tables).group_by(["lang", "phrase", "words"]).aggregate([("f", "sum")])
                              .rename_columns(["lang", "phrase", "words", "f"])]
        if current is not None:
            yield from done()

    partial = texts.mapInArrow(count, "part int, rows binary").repartition("part").sortWithinPartitions("part")
    return partial.mapInArrow(add_up, "lang string, phrase string, words int, f long")


def frequent(docs: DataFrame, threshold: int = THRESHOLD, max_words: int = MAX_WORDS, text_col: str = "text",
             lang_col: str = "lang", bitmap_bits: int = BITMAP_BITS, partition_mass: int = PARTITION_MASS) -> DataFrame:
    """lang, phrase, words, f: all n-grams found ``threshold`` times in their
    language; words 0 (phrase null) has the language's number of words."""
    texts = _prepared(docs, text_col, lang_col)
    # About five bytes a word.
    mass = max_words * ((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 5)
    bits = min(max(6, (mass // partition_mass).bit_length()), bitmap_bits - 3)
    bitmap = survivor_bits(texts, mass, bits, threshold, max_words, bitmap_bits)
    return exact_counts(texts, bitmap, bits, threshold, max_words, bitmap_bits)


def _part(first: int | Column, n: int | Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def collocations(counts: DataFrame, share: int = 100) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of every candidate that is not
    inside a longer one with 100 * f(longer) >= share * a.  ``counts`` as
    ``frequent`` returns them (written)."""
    phrases = counts.filter("words > 0")
    several = phrases.filter("words > 1")
    parts = phrases.select("lang", "phrase", "f")
    cuts = several.select("lang", "phrase", "words", F.col("f").alias("a"),
                          F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", _part(F.lit(1), F.col("k")).alias("head"),
                       _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    if totals.count() <= LANGUAGES:  # or a hot language's cuts would meet in one task
        totals = F.broadcast(totals)
    cuts = (cuts.join(parts.toDF("lang", "head", "l"), ["lang", "head"])
            .join(parts.toDF("lang", "tail", "r"), ["lang", "tail"]).join(totals, "lang"))
    exact = F.expr("cast(1000 * cast(cast(a AS decimal(17,0)) * cast(n AS decimal(17,0)) AS decimal(35,0)) "
                   "div cast(cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)) AS decimal(38,0)) AS long)")
    weakest = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("m")
    scores = cuts.groupBy("lang", "phrase", "words", "a", "n").agg(weakest)
    scores = scores.select("lang", "phrase", "words", "a", "m.l", "m.r", "n", "m.score")
    inner = several.filter("words > 2").select("lang", "phrase", "words", "f", F.explode(F.sequence(
        F.lit(2), F.col("words") - 1)).alias("length"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)).alias("first"))
    inner = inner.groupBy("lang", _part(F.col("first"), F.col("length")).alias("phrase")).agg(F.max("f").alias("longer"))
    covered = F.coalesce(100 * F.col("longer") >= share * F.col("a"), F.lit(False))
    return scores.join(inner, ["lang", "phrase"], "left").filter(~covered).drop("longer")


def query(spark: SparkSession, sf_dir: str, top: int = 2000) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    found = collocations(materialize(frequent(docs), "collocations-counts"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, len(x) AS words, array_to_string(x, ' ') AS phrase
      FROM (SELECT lang, unnest(flatten([[w[i:i + k] FOR i IN range(1, len(w) - k + 1)] FOR k IN range(0, 5)])) AS x FROM w)),
f AS (SELECT lang, phrase, words, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
cut AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS v, unnest(range(1, words)) AS k FROM f WHERE words > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, total.n, (1000 * c.a * total.n::HUGEINT) // (x.f * y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.v[:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.v[c.k + 1:], ' ') JOIN total ON total.lang = c.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, f, array_to_string(v[i:i + m], ' ') AS phrase
  FROM (SELECT lang, f, v, m, unnest(range(1, len(v) - m + 1)) AS i
        FROM (SELECT lang, f, string_split(phrase, ' ') AS v, unnest(range(1, words - 1)) AS m FROM f WHERE words > 2))),
kept AS (SELECT * FROM low WHERE NOT EXISTS (
  SELECT 1 FROM longer WHERE longer.lang = low.lang AND longer.phrase = low.phrase AND 100 * longer.f >= 100 * low.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
       l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
