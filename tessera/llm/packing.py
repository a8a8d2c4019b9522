"""Operator 13 -- best-fit packing of documents into sequences, in supersteps.

Documents are encoded, closed with an end id and, if longer than a sequence,
cut into whole sequences and a shorter first piece.  Pieces are then packed
best-fit, longest first:

* documents are sorted by length: a piece's place among the pieces of its
  length is its number in its task plus the counts of the tasks before;
* gaps (free places at the end of open sequences) are sorted by size, as runs
  of sequences with the same gap;
* a superstep takes the pieces of one length and sweeps the sorted gaps for
  the successors of that length; pieces that want the same gap get sequences
  by rank, as many to a sequence as its gap holds; what finds no gap opens
  sequences; the gaps shrink and the next superstep follows.

Lengths are whole numbers up to the capacity, so sorted documents and sorted
gaps are known from counts per length and per gap: the sweeps work on these
(at most ``capacity`` lengths, whatever the number of documents), and one
placement rule covers all pieces of a range of ranks.  Pieces find their rule
by rank in parallel.  The outcome is that of a one-by-one best fit over the
sorted corpus.  Nothing else goes through the driver: counts come in (at most
``capacity`` rows), rules go out.

Defined cases: a null or empty text is one piece that holds the end id only;
repeated rows are packed each; a text of any length is encoded whole; an empty
table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.arrow_text import bounded_batches, slices
from tessera.llm.vocabulary import BYTE_BPE, TOKENIZERS, byte_bpe, file_bytes
from tessera.operators.sinks import materialize

CAPACITY = 1024
END_ID = 2


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be short."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
           text_col: str = "text", tokenizers: str = TOKENIZERS, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ids), the
    task that made it and its number among that task's pieces of its length.
    Write the result before use, so that these two stay as they are."""
    vocabulary = file_bytes(tokenizers, BYTE_BPE)
    if docs.schema[id_col].dataType.typeName() != "long":
        raise ValueError(f"{id_col} must be a long")

    def encode(batches):
        _, ids_of = byte_bpe(vocabulary)
        task = TaskContext.get().partitionId()
        numbered = [0] * (capacity + 1)
        for part in slices(batches, text_col):
            rows: list[tuple] = []
            for doc_id, ids in zip(part.column(id_col).to_pylist(), ids_of(part.texts())):
                raw = np.array([*ids, end_id], dtype="<u4")
                for piece, (start, length) in enumerate(cut(len(raw), capacity)):
                    own = raw[start:start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own.tobytes()), task, numbered[length],
                                 own.astype(np.int32) if keep_ids else None))
                    numbered[length] += 1
            columns = list(zip(*rows))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = [id_col, "piece", "start", "length", "ids_crc32", "task", "number", "ids"]
            n = len(names) - (not keep_ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:n], types)], names=names[:n])

    schema = f"`{id_col}` long, piece int, start long, length long, ids_crc32 long, task int, number long"
    chosen = docs.select(id_col, F.col(text_col).cast("string").alias(text_col))
    return chosen.mapInArrow(encode, schema + (", ids array<int>" if keep_ids else ""))


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: the piece's place among all pieces of its length."""
    per = rows.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = per.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return (rows.join(offsets, ["length", "task"])
            .withColumn("rank", F.col("offset") + F.col("number")).drop("offset", "task", "number"))


class Gaps:
    """Open sequences as runs (first sequence, how many) by size of gap."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.runs:
                bisect.insort(self.sizes, gap)
                self.runs[gap] = []
            self.runs[gap].append((first, n))

    def successor(self, length: int) -> int | None:
        at = bisect.bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, gap: int) -> tuple[int, int]:
        first, n = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap]
            self.sizes.remove(gap)
        return first, n


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Placement rules for ``counts`` (length -> pieces), longest length first.

    A rule says: the pieces of ``length`` from rank ``low`` on go to sequences
    from ``first`` on, ``per`` to a sequence, behind ``used`` places."""
    gaps, opened, rules = Gaps(), 0, []
    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]

        def place(gap: int, first: int, free: int) -> int:
            """Fill ``free`` sequences from ``first`` on, each as far as it
            goes, until the pieces are out; how many sequences were used."""
            nonlocal rank
            left, used = n - rank, capacity - gap
            full = min(free, left // (gap // length))
            if full:
                rules.append((length, rank, first, gap // length, used))
                rank += full * (gap // length)
                gaps.put(gap % length, first, full)
            rest = n - rank
            if full == free or not rest:
                return full
            rules.append((length, rank, first + full, rest, used))
            rank += rest
            gaps.put(gap - rest * length, first + full, 1)
            return full + 1

        while rank < n:
            gap = gaps.successor(length)
            if gap is None:
                opened += place(capacity, opened, n - rank)
            else:
                first, free = gaps.take(gap)
                done = place(gap, first, free)
                gaps.put(gap, first + done, free - done)
    columns = np.array(rules, dtype=np.int64).reshape(-1, 5)
    order = np.lexsort((columns[:, 1], columns[:, 0]))
    return dict(zip(("length", "low", "first", "per", "used"), columns[order].T)) | {"sequences": opened}


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written) with their sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("a piece is empty or longer than a sequence")
    numbered = ranked(rows)
    rules = {k: v for k, v in sweep(counts, capacity).items() if k != "sequences"}
    # Rules in one sorted line: a rank starts at its length's share of it.
    base = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        base[length + 1] = n
    base = np.cumsum(base)
    rules["line"] = base[rules["length"]] + rules["low"]
    shared = rows.sparkSession.sparkContext.broadcast((rules, base))

    def place(batches):
        rules, base = shared.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(rules["line"], base[length] + rank, "right") - 1
            nth = rank - rules["low"][at]
            sequence = rules["first"][at] + nth // rules["per"][at]
            offset = rules["used"][at] + nth % rules["per"][at] * length
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    schema = numbered.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed token ids (pieces made with keep_ids)."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda x: x["ids"])).alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    packed = pack(materialize(pieces(docs), "packing-pieces"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
