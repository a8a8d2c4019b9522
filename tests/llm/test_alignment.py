import hashlib
import random
from collections import Counter

import pytest

from tessera.llm import alignment
from tessera.llm import vocabulary as V


@pytest.fixture(scope="module")
def coders():
    a, b = V.byte_bpe(V.file_bytes(V.TOKENIZERS, V.BYTE_BPE), True), V.piece_bpe(V.file_bytes(V.TOKENIZERS, V.PIECE_BPE))
    return a[0], b[0], V.byte_bpe_tokens(a[0]), V.piece_bpe_tokens(b[0])


def plain(text, coders):
    """Whole-text alignment by comparing the tokens' byte ranges."""
    coder_a, coder_b, bytes_a, bytes_b = coders
    want = (" " + text).encode()
    a = coder_a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = coder_b.encode(text) if text else []
    if not text or b"".join(bytes_a[i] for i in a) != want or b"".join(bytes_b[i] for i in b) != want:
        return [], [], [], []

    def ends(ids, own):
        out, at = [], 0
        for i in ids:
            at += len(own[i])
            out.append(at)
        return out

    ends_a, ends_b = ends(a, bytes_a), ends(b, bytes_b)
    shared = sorted(set(ends_a) & set(ends_b))
    groups, links, low, j0 = [], [], 0, 0
    for high in shared:
        groups.append(([x for x, e in zip(a, ends_a) if low < e <= high], [x for x, e in zip(b, ends_b) if low < e <= high]))
        low = high
    for i, e in enumerate(ends_a):
        s = e - len(bytes_a[a[i]])
        while ends_b[j0] <= s:
            j0 += 1
        j = j0
        while j < len(b) and ends_b[j] - len(bytes_b[b[j]]) < e:
            links.append((a[i], b[j]))
            j += 1
    return a, b, groups, links


def expected(texts, coders):
    found = [plain(t or "", coders) for t in texts]
    total = Counter(p for f in found for p in f[3])
    top: dict = {}
    for (_, y), n in total.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(total[p] == top[p[1]] for p in links),
                    sum(total[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def odd_texts():
    rng = random.Random(11)
    odd = [None, "", " ", "  two  spaces ", "\ttab\nline", "▁ mark", "<|endoftext|> and </s> <s>", "naïve façade Straße",
           "日本語 テキスト", "🙂🙃 emoji🙂", "a\u0000b", "x" * 3000, "ﬁ ligature", "é combining", " " * 50 + "end", "end" + " " * 9]
    words = ["the", "token", "izer", "über", "unbelievable", "don't", "1234567", "C++", "hello-world", "ça"]
    odd += [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(60)]
    return odd + odd[-3:]


def rows_of(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
            for r in df.orderBy("doc_id").collect()]


def test_alignment_matches_whole_text_comparison(spark, coders):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, pairs int").repartition(3)
    want = expected(texts, coders)
    rows, counts = alignment.alignment(docs, keep_groups=True)
    assert rows_of(rows) == want
    assert rows_of(alignment.alignment(docs, pairs_in_memory=0)[0]) == want  # joined by shuffle
    assert counts.agg({"links": "sum"}).first()[0] == sum(w[3] for w in want)
    for r in rows.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")


def test_windows_are_found_again_by_their_ids(coders):
    memo = alignment.Memo(coders[2], coders[3])

    def entry(text):
        a, b = (alignment.np.array(x) for x in (coders[0].encode(" " + text).ids, coders[1].encode(text)))
        whole = ((alignment.np.array([0]), alignment.np.array([len(x)])) for x in (a, b))
        return memo(a, b, *whole)[0]

    assert entry("unbelievable") is entry("unbelievable") and len(memo.known) == 1
    entry(" ".join(["word"] * 200))
    assert len(memo.known) == 1


def test_hash_ties_fall_back_to_ids(monkeypatch, spark, coders):
    monkeypatch.setattr(alignment, "mix64", lambda x: x & alignment.np.uint64(3))
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(alignment.alignment(docs)[0]) == expected(texts, coders)


def test_long_text_and_empty_table(spark, no_docs, coders):
    assert alignment.alignment(no_docs)[0].collect() == []
    text = "a few words in the middle " * 30000
    docs = spark.createDataFrame([(None, text), (2, text[:300])], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.alignment(docs)[0].collect()}
    assert got[None].n_a == len(coders[0].encode(" " + text).ids) and got[None].n_b == len(coders[1].encode(text))
    pieces = [coders[1].id_to_piece(i) for i in range(coders[1].get_piece_size())]
    assert not any("▁" in p.lstrip("▁") for p in pieces)  # what cutting long texts relies on
