import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from tessera.llm import pii
from tessera.llm.arrow_text import slices

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def brute(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                  "card": 14 <= len(digits) <= 19 and pii._luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[1])))


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    texts = ["".join(rng.choices("0123456789..@@+- ()ab_%é", k=rng.randint(0, 70))) for _ in range(20000)]
    texts += ["4111 1111 1111 1111 x +1 (202) 555-0114 é 10.0.0.1 a.b@c.de"]
    assert all(pii.base_spans(t) == brute(t) for t in texts)
    assert sum(len(brute(t)) for t in texts) > 1000


def test_long_runs_take_linear_time():
    for text in ("9" * 200000, "a" * 200000, "1." * 100000, "@" * 100000, "+1" * 100000, "a@" * 50000):
        pii.base_spans(text)


def test_model_learns_its_table_and_decodes_in_stretches():
    """Decoding stretches on their own gives the best path of the whole text."""
    model = pii.train()
    for words, labels in pii.labelled():
        scores = model.scores([pii.features(words, k) for k in range(len(words))])[None]
        assert model.viterbi(scores, np.array([len(words)]))[0].tolist() == labels
    lines = [x.replace("[", "").replace("]", "") for x in pii.TRAINING.splitlines()]
    text = " of the word ".join(re.sub(r"(email|ip|card|phone)\|", "", x) for x in lines)
    part = next(slices([pa.record_batch({"text": [text, None, ""]})]))
    words = text.split()
    scores = model.scores([pii.features(words, k) for k in range(len(words))])[None]
    whole = model.viterbi(scores, np.array([len(words)]))[0].tolist()
    starts = [m.start() for m in re.finditer(r"\S+", text)]
    expected = []
    for a, kind, b in pii._runs(whole, words):
        lead, tail = pii._trim(words[a]), pii._trim(words[b - 1])
        expected.append((starts[a] + lead[0], kind, starts[b - 1] + len(words[b - 1]) - tail[1]))
    found = pii.crf_spans(part, model)
    assert sorted(found[0]) == sorted(expected) and found[1:] == [[], []] and len(expected) > 20


def test_odd_rows_and_redaction(spark, odd_docs, no_docs):
    rows = pii.find(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert pii.find(no_docs).collect() == [] == pii.redact(no_docs).collect()
    text = "é mail a.b@c.de, host 10.0.0.1 ring +1 (202) 555-0114 end"
    df = spark.createDataFrame([(1, text), (2, None), (1, text)], "doc_id long, text string")
    found = pii.find(df).collect()
    coded = ",".join(f"{k}:{a}:{b}" for a, k, b in brute(text))
    assert found[0].base_sha256 == hashlib.sha256(coded.encode()).hexdigest()
    assert (found[0].n_email, found[0].n_ip, found[0].n_card, found[0].n_phone) == (1, 1, 0, 1)
    assert found[1].spans == "" and set(coded.split(",")) <= set(found[0].spans.split(","))
    assert [r.text for r in pii.redact(df).collect()] == ["é mail <EMAIL>, host <IP> ring <PHONE> end", None] + [
        "é mail <EMAIL>, host <IP> ring <PHONE> end"]
    assert pii.redact(odd_docs).schema == odd_docs.schema


def generated(rng, n):
    """Lines with known spans, in words and forms that TRAINING does not have."""
    d = lambda k: "".join(rng.choices("0123456789", k=k))
    word = lambda: "".join(rng.choices("bcdfglmnprst", k=1) + rng.choices("aeiou", k=1)) * rng.randint(1, 3)

    def card():
        body = d(15)
        return next(body + c for c in "0123456789" if pii._luhn(body + c))

    def grouped(x):
        sep = rng.choice([" ", "-"])
        return sep.join(x[i:i + 4] for i in range(0, 16, 4))

    makers = {
        "phone": [lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"+{rng.randint(1, 9)} {d(3)} {d(3)} {d(4)}"],
        "email": [lambda: f"{word()}.{word()}@{word()}.org", lambda: f"{word()}{d(2)}@{word()}.{word()}.com", lambda: f"{word()}@{word()}"],
        "ip": [lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4))],
        "card": [lambda: grouped(card()), card]}
    plain = [lambda: f"{d(2)} of {d(3)}", lambda: f"{rng.randint(1900, 2030)}", lambda: f"v{d(1)}.{d(1)}", lambda: f"{d(2)}:{d(2)}",
             lambda: f"{d(1)},{d(3)}.{d(2)}", lambda: "7" + d(15), lambda: f"@{word()}", lambda: f"{d(1)}.{d(1)}.{d(1)}"]
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(3, 8)):
            text += " ".join(word() for _ in range(rng.randint(2, 6))) + " "
            kind = rng.choice([*makers, "none", "none"])
            if kind == "none":
                text += rng.choice(plain)()
            else:
                found = rng.choice(makers[kind])()
                spans.append((len(text), kind, len(text) + len(found)))
                text += found
            text += rng.choice([" ", ", ", ". "])
        yield text, spans


def test_recall_and_precision_on_unseen_lines():
    rng, model = random.Random(12), pii.train()
    hit = wanted = right = found = 0
    for text, spans in generated(rng, 600):
        part = next(slices([pa.record_batch({"text": [text]})]))
        got = next(pii.all_spans(part, model))[1]
        cover = lambda s, others: any(o[1] == s[1] and o[0] <= s[0] + 1 and s[2] - 1 <= o[2] for o in others)
        wanted += len(spans)
        hit += sum(cover(s, got) for s in spans)
        found += len(got)
        right += sum(any(s[0] < o[2] and o[0] < s[2] for o in spans) for s in got)
    print(hit / wanted, right / found)
    assert hit / wanted >= 0.9 and right / found >= 0.9


def test_workers_without_the_package(spark, tmp_path):
    """A job started elsewhere: workers cannot import the package."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from tessera.llm import alignment, collocations, packing, pii, token_counts
sys.path.pop(0)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([(1, "mail a.b@c.de now", "en")], "doc_id long, text string, lang string")
try:
    df.mapInArrow(lambda it: (__import__("tessera") and b for b in it), df.schema).collect()
    print("importable")
except Exception:
    print("not importable")
assert pii.find(df).first().n_email == 1 and pii.redact(df).first().text == "mail <EMAIL> now"
assert token_counts.length_histogram(df).count() == 1
assert alignment.alignment(df)[0].first().n_a > 0
assert packing.pack(packing.materialize(packing.pieces(df), "p")).count() == 1
assert collocations.frequent(df, threshold=1).count() == 8
print("done")
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.stdout.split("\n")[-2] == "done" and "not importable" in out.stdout, out.stdout + out.stderr[-3000:]
