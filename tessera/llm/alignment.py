"""Operator 12 -- aligning two tokenizations by whitespace-token anchors.

Every text is encoded whole by a byte-level BPE (space + text) and by a
sentencepiece BPE (which puts that space itself).  Where both have a token that
starts with a space and both tokens before it end at the same byte, the text is
cut: such anchors split a document into windows, a pair of id tuples (nearly
always a word).  What a window aligns to depends on its ids only, so windows
are aligned once and remembered by their id tuples: their groups (cut at every
shared end) and links (pairs of tokens with overlapping bytes).

How often an id pair is linked corpus-wide is counted in two steps: each
document's links as distinct pairs with counts, written once, then summed per
task and over the tasks.  A second pass over that table takes the counts back
to the documents.  The table of pairs cannot outgrow the product of the two
vocabularies, and in practice holds a small part of it; up to
``pairs_in_memory`` pairs (checked, 17 bytes each) it is broadcast, beyond it
the documents' pairs are joined with it by shuffle.

Defined cases: a null or empty text, and one whose tokens' bytes are not space
+ text in either vocabulary, has no tokens: zeros and an empty groups string.
Repeated rows count each (also for the corpus-wide counts).  A text without
anchors is one window, aligned like any other but not remembered above
``REMEMBERED`` tokens.  Special tokens' strings in texts are plain text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm import vocabulary as V
from tessera.llm.arrow_text import bounded_batches, mix64, slices
from tessera.operators.sinks import materialize

#: Windows kept in a task's memory, and tokens of a window that is kept.
MEMO, REMEMBERED = 1 << 19, 64
PAIRS_IN_MEMORY = 8_000_000
#: Texts aligned at a time: a window that comes again costs nothing in the same slice.
SLICE_BYTES = 1 << 21


class Memo:
    """Aligned windows by their id tuples (packed as bytes): where the window's
    linked pairs lie in ``pairs``, how many links and groups, the groups' text."""

    def __init__(self, tokens_a: list[bytes], tokens_b: list[bytes]):
        self.a, self.b = (np.array([len(t) for t in own], np.int64) for own in (tokens_a, tokens_b))
        self.width = len(tokens_b)
        # What is written for an id: followed by , | ; or nothing.
        self.written = [f"{i}{end}" for i in range(max(len(tokens_a), len(tokens_b))) for end in ",|;"]
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, tuple[int, int, int, str]] = {}
        self.pairs, self.filled = np.zeros(1 << 16, np.int64), 0

    def __call__(self, ids_a: np.ndarray, ids_b: np.ndarray, a, b) -> list[tuple[int, int, int, str]]:
        """The entries of windows (starts and stops in a and b)."""
        if len(self.known) > MEMO:
            self.clear()
        # A window's key: its ids of a, then those of b (above all of a's).
        n_a, n_b = a[1] - a[0], b[1] - b[0]
        own_a, own_b = _picked(ids_a, *a), _picked(ids_b, *b)
        stops = np.cumsum(n_a + n_b)
        starts = stops - n_a - n_b
        packed = np.zeros(len(own_a) + len(own_b), "<i4")
        packed[np.arange(len(own_a)) + np.repeat(starts - (np.cumsum(n_a) - n_a), n_a)] = own_a
        packed[np.arange(len(own_b)) + np.repeat(starts + n_a - (np.cumsum(n_b) - n_b), n_b)] = own_b + len(self.a)
        raw = packed.tobytes()
        keys = [raw[p:q] for p, q in zip((4 * starts).tolist(), (4 * stops).tolist())]
        found = list(map(self.known.get, keys))
        new = [k for k, entry in enumerate(found) if entry is None]
        if new:
            at = np.array(new)
            first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
            for k, entry in zip(new, self.align(_picked(own_a, first_a[at], (first_a + n_a)[at]),
                                                _picked(own_b, first_b[at], (first_b + n_b)[at]), n_a[at], n_b[at])):
                found[k] = entry
                if len(keys[k]) <= 4 * REMEMBERED:
                    self.known[keys[k]] = entry
        return found

    def align(self, ids_a, ids_b, n_a, n_b) -> list[tuple[int, int, int, str]]:
        """Align windows laid end to end (``n_a``, ``n_b`` tokens each).  Tokens
        overlap where the union of all ends cuts the bytes; groups end where
        both have an end."""
        end_a, end_b = np.cumsum(self.a[ids_a]), np.cumsum(self.b[ids_b])
        ends = np.union1d(end_a, end_b)
        pairs = ids_a[np.searchsorted(end_a, ends)] * self.width + ids_b[np.searchsorted(end_b, ends)]
        window_end = end_a[np.cumsum(n_a) - 1]
        links = np.diff(np.searchsorted(ends, window_end, "right"), prepend=0)
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        groups = np.diff(np.searchsorted(shared, window_end, "right"), prepend=0)
        # Written form: a group's tokens of a, then those of b, each with what follows it.
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        last_a, last_b = shared[group_a] == end_a, shared[group_b] == end_b
        follows = np.concatenate([last_a.astype(np.int64), 2 * last_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        written = list(map(self.written.__getitem__, (3 * np.concatenate([ids_a, ids_b]) + follows)[order].tolist()))
        stops = np.cumsum(n_a + n_b).tolist()
        first = self.filled + np.cumsum(links) - links
        while self.filled + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.pairs[self.filled:self.filled + len(pairs)] = pairs
        self.filled += len(pairs)
        return [(f, n, g, "".join(written[p:q])) for f, n, g, p, q in
                zip(first.tolist(), links.tolist(), groups.tolist(), [0, *stops[:-1]], stops)]


def _picked(ids: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The ids of the given stretches, end to end."""
    n = stop - start
    return ids[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _windows(ids_a, ids_b, tokens, document_ends):
    """Cuts the laid-out tokens of a slice at its anchors: where each window's
    tokens start and stop in a and in b, and the byte each window ends at."""
    (length_a, space_a), (length_b, space_b) = tokens
    end_a, end_b = np.cumsum(length_a[ids_a]), np.cumsum(length_b[ids_b])
    size = int(end_a[-1])

    def marks(places) -> np.ndarray:
        out = np.zeros(size + 1, bool)
        out[places] = True
        return out

    anchor = (marks((end_a - length_a[ids_a])[space_a[ids_a]]) & marks((end_b - length_b[ids_b])[space_b[ids_b]])
              & marks(end_a) & marks(end_b))
    anchor[document_ends] = True
    stop_a, stop_b = np.flatnonzero(anchor[end_a]) + 1, np.flatnonzero(anchor[end_b]) + 1
    return (np.concatenate([[0], stop_a[:-1]]), stop_a), (np.concatenate([[0], stop_b[:-1]]), stop_b), end_a[stop_a - 1]


def _same(ids: np.ndarray, start: np.ndarray, stop: np.ndarray, like: np.ndarray) -> np.ndarray | None:
    """A hash of each window's ids (``like`` None), or whether each window has
    the ids of the window that ``like`` names."""
    n = stop - start
    within = np.arange(len(ids)) - np.repeat(start, n)
    if like is None:
        mixed = mix64(ids.astype(np.uint64) + (within.astype(np.uint64) << np.uint64(32)) + np.uint64(1))
        return np.add.reduceat(mixed, start)
    if not np.array_equal(n, n[like]):
        return False
    return np.array_equal(ids, ids[np.repeat(start[like], n) + within])


def _distinct(ids_a, ids_b, a, b):
    """The first window of each kind and every window's kind.  Kinds are
    found by hash and confirmed id by id."""
    key = mix64(_same(ids_a, *a, None)) + _same(ids_b, *b, None)
    _, first, kind = np.unique(key, return_index=True, return_inverse=True)
    if not (_same(ids_a, *a, first[kind]) and _same(ids_b, *b, first[kind])):
        kinds: dict = {}
        exact = [(ids_a[p:q].tobytes(), ids_b[r:s].tobytes()) for p, q, r, s in zip(*a, *b)]
        kind = np.array([kinds.setdefault(x, len(kinds)) for x in exact])
        _, first = np.unique(kind, return_index=True)
    return first, kind


def aligned(docs: DataFrame, tokenizers: str = V.TOKENIZERS, id_col: str = "doc_id", text_col: str = "text",
            keep_groups: bool = False) -> DataFrame:
    """One row per document: id, row (a number of the row), n_a, n_b, n_groups,
    n_links, groups_sha256, its distinct linked pairs (id of a * size of the
    second vocabulary + id of b) with their counts, and the groups' text if
    asked for.  Write the result before use, so that ``row`` stays as it is."""
    vocabulary_a, vocabulary_b = V.file_bytes(tokenizers, V.BYTE_BPE), V.file_bytes(tokenizers, V.PIECE_BPE)

    def encode(batches):
        coder_a, ids_of_a = V.byte_bpe(vocabulary_a, special_as_text=True)
        coder_b, ids_of_b = V.piece_bpe(vocabulary_b)
        bytes_a, bytes_b = V.byte_bpe_tokens(coder_a), V.piece_bpe_tokens(coder_b)
        tables = [(np.array([len(t) for t in own], np.int64), np.array([t[:1] == b" " for t in own]))
                  for own in (bytes_a, bytes_b)]
        memo = Memo(bytes_a, bytes_b)
        row = TaskContext.get().partitionId() << 33
        for part in slices(batches, text_col, SLICE_BYTES):
            texts = part.texts()
            spaced = [" " + t if t else "" for t in texts]
            a_ids, b_ids = [np.array(x, np.int64) for x in ids_of_a(spaced)], ids_of_b(spaced)
            whole = [t.encode() for t in spaced]
            # Byte-level tokens are the text's own bytes, whatever the text (the
            # length confirms it); the other vocabulary may change characters.
            valid = [k for k, t in enumerate(texts) if t and b"".join(map(bytes_b.__getitem__, b_ids[k])) == whole[k]
                     and int(tables[0][0][a_ids[k]].sum()) == len(whole[k])]
            n = len(texts)
            n_a, n_b, n_groups, n_links = (np.zeros(n, np.int64) for _ in range(4))
            groups, digests = [""] * n, [""] * n
            kept_pairs, kept_counts, sizes = [], [], np.zeros(n, np.int64)
            if valid:
                n_a[valid], n_b[valid] = [len(a_ids[k]) for k in valid], [len(b_ids[k]) for k in valid]
                ids_a = np.concatenate([a_ids[k] for k in valid])
                ids_b = np.concatenate([np.array(b_ids[k], np.int64) for k in valid])
                ends = np.cumsum([len(whole[k]) for k in valid])
                a, b, window_ends = _windows(ids_a, ids_b, tables, ends)
                first, kind = _distinct(ids_a, ids_b, a, b)
                where, links, n_of, text = zip(*memo(ids_a, ids_b, *((x[0][first], x[1][first]) for x in (a, b))))
                where, links, n_of = map(np.array, (where, links, n_of))
                stops = np.searchsorted(window_ends, ends) + 1
                for k, p, q in zip(valid, [0, *stops[:-1]], stops):
                    whole_text = "".join(map(text.__getitem__, kind[p:q].tolist()))[:-1]
                    digests[k] = hashlib.sha256(whole_text.encode()).hexdigest()
                    if keep_groups:
                        groups[k] = whole_text
                document = np.repeat(np.arange(len(valid)), np.diff([0, *stops]))
                n_groups[valid] = np.bincount(document, n_of[kind]).astype(np.int64)
                n_links[valid] = np.bincount(document, links[kind]).astype(np.int64)
                # All links of the slice: the pairs of each window's kind, in
                # a pool of the kinds' pairs.
                pool, begin = _picked(memo.pairs, where, where + links), np.cumsum(links) - links
                per = links[kind]
                at = np.repeat(begin[kind] - (np.cumsum(per) - per), per) + np.arange(per.sum())
                # Sort pairs inside documents: numbered pairs keep the key small.
                names, number = np.unique(pool, return_inverse=True)
                key, count = np.unique(np.repeat(document, per) * len(names) + number[at], return_counts=True)
                kept_pairs, kept_counts = [names[key % len(names)]], [count]
                sizes[valid] = np.bincount(key // len(names), minlength=len(valid))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            narrow = pa.int32() if len(bytes_a) * len(bytes_b) < 1 << 31 else pa.int64()
            pairs = pa.array(np.concatenate([np.zeros(0, np.int64), *kept_pairs])).cast(narrow)
            counts = pa.array(np.concatenate([np.zeros(0, np.int64), *kept_counts])).cast(pa.int32())
            columns = [part.column(id_col), pa.array(np.arange(row, row + n)), *map(pa.array, (n_a, n_b, n_groups, n_links)),
                       pa.array(digests), pa.ListArray.from_arrays(offsets, pairs), pa.ListArray.from_arrays(offsets, counts)]
            row += n
            names_out = [id_col, "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
            if keep_groups:
                columns, names_out = [*columns, pa.array(groups)], [*names_out, "groups"]
            yield pa.RecordBatch.from_arrays(columns, names=names_out)

    width = V.piece_bpe(vocabulary_b)[0].get_piece_size() * V.byte_bpe(vocabulary_a)[0].get_vocab_size()
    schema = (f"`{id_col}` long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              f"pairs array<{'int' if width < 1 << 31 else 'long'}>, times array<int>" + (", groups string" if keep_groups else ""))
    chosen = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return chosen.mapInArrow(encode, schema)


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    col = batch.column(batch.schema.get_field_index(name))
    offsets = col.offsets.to_numpy()
    return col.values.to_numpy()[offsets[0]:offsets[-1]].astype(np.int64), offsets - offsets[0]


def pair_counts(rows: DataFrame, n_b: int, held: int = 1 << 22) -> DataFrame:
    """pair, links, best: every linked id pair, how many links hold it, and
    whether no pair with the same second id has more.  Tasks add up their
    documents' pairs before the shuffle."""
    def add_up(batches):
        waiting, n = [], 0

        def merged():
            pair, times = (np.concatenate(x) for x in zip(*waiting))
            names, place = np.unique(pair, return_inverse=True)
            return names, np.bincount(place, times, minlength=len(names)).astype(np.int64)

        for batch in batches:
            pair, _ = _lists(batch, "pairs")
            waiting.append((pair, _lists(batch, "times")[0]))
            n += len(pair)
            if n > held:
                waiting = [merged()]
                n = len(waiting[0][0])
                if n > held // 2:  # many distinct pairs: hand them on
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, waiting[0])), names=["pair", "links"])
                    waiting, n = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, merged())), names=["pair", "links"])

    partial = rows.select("pairs", "times").mapInArrow(add_up, "pair long, links long")
    counts = partial.groupBy("pair").agg(F.sum("links").alias("links"))
    most = F.max("links").over(W.partitionBy(F.col("pair") % n_b))
    return counts.select("pair", "links", (F.col("links") == most).alias("best"))


def scored(rows: DataFrame, counts: DataFrame, pairs_in_memory: int = PAIRS_IN_MEMORY) -> DataFrame:
    """``aligned`` rows (written) with n_best and count_sum from ``counts``
    (written)."""
    kept = [c for c in rows.columns if c not in ("row", "pairs", "times")]
    if counts.count() > pairs_in_memory:
        links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        links = links.select("row", F.col("x.pairs").cast("long").alias("pair"), F.col("x.times").alias("times"))
        sums = links.join(counts, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("links")).alias("count_sum"))
        return (rows.select("row", *kept).join(sums, "row", "left")
                .select(*kept, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum"))))
    table = counts.orderBy("pair").toArrow()
    columns = [table.column(c).to_numpy() for c in ("pair", "links", "best")]
    shared = rows.sparkSession.sparkContext.broadcast(columns)

    def look_up(batches):
        known, links, best = shared.value
        for batch in batches:
            pair, offsets = _lists(batch, "pairs")
            times, _ = _lists(batch, "times")
            at = np.searchsorted(known, pair)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * links[at])]
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(np.diff(s[offsets])) for s in sums)],
                                             names=[*kept, "n_best", "count_sum"])

    schema = rows.select(*kept).schema.add("n_best", "long").add("count_sum", "long")
    return rows.mapInArrow(look_up, schema)


def alignment(docs: DataFrame, tokenizers: str = V.TOKENIZERS, id_col: str = "doc_id", text_col: str = "text",
              keep_groups: bool = False, pairs_in_memory: int = PAIRS_IN_MEMORY) -> tuple[DataFrame, DataFrame]:
    """Per-document rows and the corpus-wide table of linked id pairs
    (pair, links, best; pair = id of a * size of the second vocabulary + id of b)."""
    width = V.piece_bpe(V.file_bytes(tokenizers, V.PIECE_BPE))[0].get_piece_size()
    rows = materialize(aligned(docs, tokenizers, id_col, text_col, keep_groups), "alignment-rows")
    counts = materialize(pair_counts(rows, width), "alignment-pairs")
    return scored(rows, counts, pairs_in_memory), counts


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return alignment(docs)[0].select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
