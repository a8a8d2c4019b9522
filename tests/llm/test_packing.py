import random
import zlib

import numpy as np
import pytest

from tessera.llm import packing, vocabulary
from tessera.llm.vocabulary import BYTE_BPE, PIECE_BPE, TOKENIZERS, byte_bpe, file_bytes, parts, piece_bpe
from tessera.operators.sinks import materialize


def one_by_one(lengths, capacity):
    """Best fit over single pieces, longest first: the gaps left over."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        gap = min(fitting) if fitting else capacity
        if fitting:
            gaps.remove(gap)
        gaps.append(gap - n)
    return sorted(gaps)


@pytest.fixture(scope="module")
def packed(spark, odd_docs):
    rows = materialize(packing.pieces(odd_docs.repartition(5), keep_ids=True), "test-pieces")
    return rows, packing.pack(rows).collect()


def test_pieces_are_the_documents_ids(odd_docs, packed):
    _, encode = byte_bpe(file_bytes(TOKENIZERS, BYTE_BPE))
    def key(doc_id):
        return -1 if doc_id is None else doc_id

    want = []
    for r in odd_docs.collect():
        ids = [*encode([r.text or ""])[0], 2]
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            own = ids[a:b]
            want.append((key(r.doc_id), k, a, b - a, zlib.crc32(np.array(own, "<u4").tobytes()), own))
    got = [(key(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in packed[1]]
    assert sorted(got) == sorted(want)


def test_sequences_are_gapless_and_as_full_as_one_by_one(odd_docs, packed):
    rows, placed = packed
    by: dict = {}
    for r in placed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    left = sorted(1024 - sum(n for _, n in own) for own in by.values())
    assert left == one_by_one([r.length for r in placed], 1024)
    texts = packing.sequences(packing.pack(rows)).collect()
    assert len(texts) == len(by) and sum(len(t.ids) for t in texts) == sum(r.length for r in placed)


def test_sweep_equals_one_by_one_on_random_lengths():
    rng = random.Random(5)
    for _ in range(150):
        capacity = rng.choice([7, 16, 50])
        lengths = [min(capacity, 1 + int(rng.expovariate(1 / rng.choice([2, 9, 30])))) for _ in range(rng.randint(1, 120))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        rules = packing.sweep(counts, capacity)
        used: dict = {}
        for n, count in counts.items():
            mine = np.flatnonzero(rules["length"] == n)
            for rank in range(count):
                i = mine[np.searchsorted(rules["low"][mine], rank, "right") - 1]
                nth = rank - rules["low"][i]
                used.setdefault(int(rules["first"][i] + nth // rules["per"][i]), []).append(
                    (int(rules["used"][i] + nth % rules["per"][i] * n), n))
        for own in used.values():
            at = 0
            for offset, n in sorted(own):
                assert offset == at
                at += n
            assert at <= capacity
        assert sorted(used) == list(range(rules["sequences"]))
        assert sorted(capacity - sum(n for _, n in own) for own in used.values()) == one_by_one(lengths, capacity)


def test_ranks_do_not_depend_on_tasks(spark):
    """A length that holds most pieces is numbered without a gap."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, repeat('word ', int(id % 90)), 'same text') AS text")
    rows = materialize(packing.pieces(docs.repartition(7)), "test-ranks")
    found = packing.ranked(rows).groupBy("length").agg({"rank": "max", "*": "count"}).collect()
    assert all(r["max(rank)"] == r["count(1)"] - 1 for r in found)


def test_empty_table_and_long_text(spark, no_docs):
    assert packing.pack(materialize(packing.pieces(no_docs), "test-none")).collect() == []
    coder, encode = byte_bpe(file_bytes(TOKENIZERS, BYTE_BPE))
    text = "many words and more " * 40000 + " " * 1_200_000 + "end"
    assert encode([text])[0] == coder.encode(text, add_special_tokens=False).ids


def test_encoders_agree_with_their_libraries(monkeypatch):
    monkeypatch.setattr(vocabulary, "PART", 5)
    coder, encode = byte_bpe(file_bytes(TOKENIZERS, BYTE_BPE))
    pieces, encode_pieces = piece_bpe(file_bytes(TOKENIZERS, PIECE_BPE))
    rng = random.Random(8)
    bits = ["the", " ", " ", "  ", "\n", "\t", "é", "don't", "'s", "12", "!", "<|endoftext|>", "\x00", "\xa0", "\u3000", "\x1c", "日本",
            "🙂", "a", "\r\n", "a b c", "</s>", "ß"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert "".join(parts(text, 3)) == text
        assert encode([text])[0] == coder.encode(text, add_special_tokens=False).ids, repr(text)
        if text:
            assert encode_pieces([" " + text])[0] == pieces.encode(text), repr(text)
