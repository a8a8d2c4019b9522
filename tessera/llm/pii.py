r"""Operator 9 -- personal data: four exact patterns and a linear-chain CRF.

Base spans come from the patterns of ``BASE`` (leftmost, non-overlapping per
kind; a match that fails its check is dropped).  The CRF adds spans that the
patterns miss (a phone number without ``+``, an address written with blanks):
it labels the white-space separated words ``O``, ``B-kind`` or ``I-kind`` from
word-shape features of the word and its neighbours.  It is trained on the small
labelled table ``TRAINING`` by full-batch gradient steps on the exact
likelihood (forward-backward), and decoded by Viterbi over numpy batches.

Only words with a digit or ``@`` can differ from plain prose in their features.
Training checks that a plain word among plain words is labelled O whatever
stands around it; so the best path passes through O there, and decoding the
stretches in between on their own gives the very path of the whole text.

Base spans stay; a CRF span that overlaps a base span is dropped, and so is one
that cannot be what its label says (``plausible``).  Offsets are code points,
end exclusive.

Defined cases: null and empty texts have no span; repeated rows and null ids
are handled row by row; very long texts are read whole, in time linear in
their length; only id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrow_text import WORDS, Spans, TextSlice, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number can only start where no digit stands before it, so runs of digits
# are tried once (and never given back).
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The labelled table: spans in brackets, ``[kind|text]``; the words around
#: them are arbitrary.
TRAINING = """\
call me at [phone|(212) 555-0187] or write
tel [phone|(415) 555 0133] in the morning
ring [phone|212-555-0187] today
the number is [phone|415.555.0133] now
dial [phone|020 7946 0958] please
reach us on [phone|0171 555 0199] until
fax [phone|030-5550-0142] and more
mobile [phone|06 55 50 01 42] at night
her phone [phone|555-0143] rang
call [phone|+1 (202) 555-0114] again
call [phone|+44 20 7946 0123] again
write to [email|ann.lee@mail.example.org] soon
send it to [email|bob@example] for me
mail [email|carl_9 @ example.com] today
contact [email|dora@ example.org] or him
answer [email|eve @example.net] by noon
ask [email|info@shop] there
the host [ip|10.0.0.12] answered
ping [ip|192.168.7.25] from here
server [ip|172.16.254.1:8080] is down
at [ip|10.1.2.3/24] we saw
node [ip|203.0.113.7] rebooted
pay with [card|4111 1111 1111 1111] now
card [card|5500-0000-0000-0004] expired
number [card|340000000000009] was used
charged [card|4012888888881881] twice
card [card|6011 0000 0000 0004] is new
licensed under version 2.0 of the terms
in 1998 there were 12 men and 300 birds
chapter 3.1 of volume 14 begins here
it cost 1,250 crowns or 99.50 at most
on 12/05/2011 they met at 10:30 sharp
page 214 to 230 see note 7
about 3 or 4 of the 25 came
the year 2024 had 366 days
section 4.2.1 and 4.2.2 apply
between 100 and 20000 words each
code 7f3a9c20d41b was seen twice
hash e03422dad6b454724135a384f69ba12c7de6c8f4 matches
user @ noon met no one
a @handle is not an address
room 101 on floor 2 of 5
item 15 costs 40 or 45 each
of the and in to a was
that is what they said when it was over
the one who came from there had gone
1 2 3 4 5 6 7 8 9 10 and so on
100 200 300 400 were counted
10.5 20.5 30.5 were measured
"""

STEPS, RATE, DECAY = 400, 0.3, 0.002


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """At each @ the local part is all that precedes it up to the last match."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' spans, by start, then kind as listed."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


# ── features ──────────────────────────────────────────────────────────────
PLAIN = ("w=plain",)
_EDGE = re.compile(r"^[^\w(+@]+|[^\w)@]+$")


def shape(word: str) -> str:
    """Digits d, letters a, hexadecimal-looking mixtures h, others as they are;
    runs of digits keep their length up to 5, runs of letters do not."""
    out = re.sub("[^\\W\\d_]+", "a", word)
    out = re.sub("[0-9]+", lambda m: "d" * min(len(m.group()), 5) if len(m.group()) < 14 else "D", out)
    return out if len(out) <= 24 else "h"


def word_features(word: str | None) -> tuple[str, ...]:
    """Features of a word of its own; ``None`` and plain words are alike."""
    if word is None or not re.search("[0-9@]", word):
        return PLAIN
    core = _EDGE.sub("", word)
    s = shape(core)
    digits = sum(c.isdigit() for c in core)
    return (f"s={s}", f"c={re.sub('d+', 'd', s)}", f"n={min(digits, 17)}", "at" if "@" in core else "no-at",
            f"dots={min(core.count('.'), 4)}", "alone" if s == "@" else "with")


def features(words: list[str | None], k: int) -> list[str]:
    """Own features and the coarse shapes of both neighbours."""
    out = list(word_features(words[k]))
    for side, j in (("<", k - 1), (">", k + 1)):
        near = words[j] if 0 <= j < len(words) else None
        mark = "plain" if near is None or not re.search("[0-9@]", near) else shape(_EDGE.sub("", near))
        out.append(f"{side}{mark}")
        out.append(f"{side}{mark}|{out[0]}")
    return out


def labelled(table: str = TRAINING) -> list[tuple[list[str], list[int]]]:
    """The table's lines as words and label numbers."""
    out = []
    for line in table.splitlines():
        words, labels = [], []
        for m in re.finditer(r"\[(\w+)\|([^\]]*)\]|\S+", line):
            if m.group(1):
                for k, w in enumerate(m.group(2).split()):
                    words.append(w)
                    labels.append(LABELS.index(f"{'I' if k else 'B'}-{m.group(1)}"))
            else:
                words.append(m.group())
                labels.append(0)
        if words:
            out.append((words, labels))
    return out


class Crf:
    """Weights of features (rows of ``emit``) and of label pairs (``move``).
    A sequence starts after an O and ends before one."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), len(LABELS)))
        for k, names in enumerate(rows):
            at = [self.names[x] for x in names if x in self.names]
            out[k] = self.emit[at].sum(0)
        return out

    def viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of sequences padded to one length (n, T, labels)."""
        n, steps, size = scores.shape
        back = np.zeros((n, steps, size), np.int8)
        best = scores[:, 0] + self.move[0]
        for t in range(1, steps):
            ways = best[:, :, None] + self.move[None]
            back[:, t] = ways.argmax(1)
            going = (t < lengths)[:, None]
            best = np.where(going, ways.max(1) + scores[:, t], best)
        out = np.zeros((n, steps), np.int8)
        last = (best + self.move[:, 0]).argmax(1)
        for t in range(steps - 1, -1, -1):
            inside = t < lengths
            out[inside, t] = last[inside]
            if t:
                last = np.where(inside, back[np.arange(n), t, last], last)
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def train(table: str = TRAINING, steps: int = STEPS) -> Crf:
    """Gradient ascent (Adagrad) on the regularised log-likelihood."""
    rows = labelled(table)
    names: dict[str, int] = {}
    coded = [[[names.setdefault(x, len(names)) for x in features(w, k)] for k in range(len(w))] for w, _ in rows]
    size, longest = len(LABELS), max(len(w) for w, _ in rows)
    pick = np.zeros((len(rows), longest, len(names)), np.float64)
    truth = np.zeros((len(rows), longest, size))
    lengths = np.array([len(w) for w, _ in rows])
    moves = np.zeros((size, size))
    for r, (_, labels) in enumerate(rows):
        for t, label in enumerate(labels):
            pick[r, t, coded[r][t]] = 1
            truth[r, t, label] = 1
        for a, b in zip([0, *labels], [*labels, 0]):
            moves[a, b] += 1
    emit, move = np.zeros((len(names), size)), np.zeros((size, size))
    seen_e, seen_m = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
    inside = np.arange(longest)[None] < lengths[:, None]
    for _ in range(steps):
        scores = pick @ emit
        forward = np.zeros_like(scores)
        forward[:, 0] = scores[:, 0] + move[0]
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1, :, None] + move[None], 1) + scores[:, t]
            forward[:, t] = np.where(inside[:, t, None], step, forward[:, t - 1])
        norm = _log_sum(forward[:, -1] + move[:, 0], 1)
        backward = np.zeros_like(scores)
        backward[:, -1] = move[:, 0]
        for t in range(longest - 2, -1, -1):
            step = _log_sum(move[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], step, move[:, 0])
        node = np.exp(forward + backward - norm[:, None, None]) * inside[:, :, None]
        expected = np.zeros((size, size))
        expected[0] += node[:, 0].sum(0)
        ends = node[np.arange(len(rows)), lengths - 1].sum(0)
        expected[:, 0] += ends
        for t in range(1, longest):
            pair = (forward[:, t - 1, :, None] + move[None] + (scores[:, t] + backward[:, t])[:, None, :]
                    - norm[:, None, None])
            expected += (np.exp(pair) * inside[:, t, None, None]).sum(0)
        grad_e = np.einsum("rtf,rtk->fk", pick, truth - node) - DECAY * emit
        grad_m = moves - expected - DECAY * move
        seen_e += grad_e ** 2
        seen_m += grad_m ** 2
        emit += RATE * grad_e / np.sqrt(seen_e)
        move += RATE * grad_m / np.sqrt(seen_m)
    # An I follows only its own B or I.
    for k, label in enumerate(LABELS):
        if label[0] == "I":
            for j, before in enumerate(LABELS):
                if before[1:] != label[1:]:
                    move[j, k] = -1e4
    model = Crf(names, emit, move)
    plain = model.scores([features([None, None, None], 1)])[0]
    allowed = np.where(move < -1e3, np.nan, move)
    through = plain + np.nanmax(allowed, 0) + np.nanmax(allowed, 1)
    # Whatever stands around a plain word, O is its label.
    floor = plain[0] + np.nanmin(allowed[:, 0]) + np.nanmin(allowed[0, [k for k, x in enumerate(LABELS) if x[0] != "I"]])
    if floor <= through[1:].max():
        emit[names["w=plain"], 0] += through[1:].max() - floor + 1.0
    return model


# ── decoding ──────────────────────────────────────────────────────────────
_MARK = np.zeros(256, np.int32)
_MARK[list(b"0123456789@")] = 1
CELLS = 1 << 18


def crf_spans(part: TextSlice, model: Crf) -> list[list[tuple[int, str, int]]]:
    """Spans of each text of a slice."""
    spans = Spans(part, WORDS)
    out: list[list[tuple[int, str, int]]] = [[] for _ in range(len(part))]
    if not len(spans):
        return out
    marks = np.concatenate([[0], np.cumsum(_MARK[part.data])])
    hot = np.flatnonzero(marks[spans.ends] > marks[spans.starts])
    if not len(hot):
        return out
    owner = np.searchsorted(spans.first, hot, "right") - 1
    # Stretches: marked words and one plain word on either side, joined if they touch.
    near = np.unique(np.concatenate([hot - 1, hot, hot + 1]))
    text_of = np.searchsorted(spans.first, near, "right") - 1
    ok = (near >= 0) & (near < len(spans)) & np.isin(text_of, owner)
    near, text_of = near[ok], text_of[ok]
    cut = np.flatnonzero((np.diff(near) != 1) | (np.diff(text_of) != 0)) + 1
    points = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    stretches = []
    for run in np.split(np.arange(len(near)), cut):
        words = []
        for w in near[run].tolist():
            a, b = int(spans.starts[w]), int(spans.ends[w])
            words.append(part.data[a:b].tobytes().decode("utf-8", "replace") if marks[b] > marks[a] else None)
        stretches.append((near[run], int(text_of[run[0]]), words))
    stretches.sort(key=lambda s: len(s[2]))
    k = 0
    while k < len(stretches):
        longest, stop = 0, k
        while stop < len(stretches) and (stop == k or len(stretches[stop][2]) * (stop - k + 1) <= CELLS):
            longest = len(stretches[stop][2])
            stop += 1
        group = stretches[k:stop]
        scores = np.zeros((len(group), longest, len(LABELS)))
        for r, (_, _, words) in enumerate(group):
            scores[r, :len(words)] = model.scores([features(words, j) for j in range(len(words))])
        found = model.viterbi(scores, np.array([len(g[2]) for g in group]))
        for (index, text, words), row in zip(group, found):
            base = points[part.offsets[text]]
            for start, kind, end in _runs(row[:len(words)].tolist(), words):
                first, last = int(index[start]), int(index[end - 1])
                lead, tail = _trim(words[start]), _trim(words[end - 1])
                a = points[spans.starts[first]] - base + lead[0]
                b = points[spans.ends[last]] - base - tail[1]
                if a < b:
                    out[text].append((int(a), kind, int(b)))
        k = stop
    return out


def _trim(word: str | None) -> tuple[int, int]:
    """Code points of a word before and after its core."""
    if word is None:
        return 0, 0
    core = _EDGE.sub("", word)
    before = word.find(core)
    return before, len(word) - before - len(core)


def _runs(labels: list[int], words: list) -> Iterator[tuple[int, str, int]]:
    k = 0
    while k < len(labels):
        name = LABELS[labels[k]]
        end = k + 1
        if name != "O":
            while end < len(labels) and LABELS[labels[end]] == "I-" + name[2:]:
                end += 1
            if any(w is not None for w in words[k:end]):
                yield k, name[2:], end
        k = end


def plausible(kind: str, text: str) -> bool:
    """Whether a labelled stretch can be what its label says: a card number
    passes Luhn, a phone number has 7 to 15 digits, an address has numbers
    up to 255, and mail an @."""
    digits = re.sub("[^0-9]", "", text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) >= 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts[:4])
    return "@" in text


def all_spans(part: TextSlice, model: Crf) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of each text of a slice."""
    marks = np.concatenate([[0], np.cumsum(_MARK[part.data])])
    added = crf_spans(part, model)
    raw = part.data.tobytes()
    for k, (a, b) in enumerate(zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist())):
        if marks[a] == marks[b]:
            yield [], []
            continue
        text = raw[a:b].decode("utf-8", "replace")
        base = base_spans(text)
        more = [s for s in added[k] if plausible(s[1], text[s[0]:s[2]])
                and not any(s[0] < x[2] and x[0] < s[2] for x in base)]
        yield base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _coded(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def _shipped(docs: DataFrame, model: Crf | None):
    """The model as a dict and arrays: a broadcast is unpickled on workers
    that may not have this module."""
    model = model or train()
    return docs.sparkSession.sparkContext.broadcast((model.names, model.emit, model.move))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Crf | None = None) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans."""
    shipped = _shipped(docs, model)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = list(all_spans(part, Crf(*shipped.value)))
            out = {"doc_id": part.column("doc_id")}
            for kind in KINDS:
                out[f"n_{kind}"] = pa.array([sum(s[1] == kind for s in base) for base, _ in found], pa.int64())
            out["base_sha256"] = pa.array([hashlib.sha256(_coded(base).encode()).hexdigest() for base, _ in found], pa.string())
            out["spans"] = pa.array([_coded(every) for _, every in found], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                                 "base_sha256 string, spans string")


def redact(docs: DataFrame, text_col: str = "text", model: Crf | None = None) -> DataFrame:
    """The same rows and columns, each span replaced by ``<KIND>``
    (of overlapping spans, one mark for their union, named after the first)."""
    shipped = _shipped(docs, model)
    at = docs.columns.index(text_col)
    # mapInArrow can't take every column name: the columns are numbered inside.
    names = [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, names[at]):
            texts = part.texts()
            present = part.column(names[at]).is_valid().to_pylist()
            for k, (_, spans) in enumerate(all_spans(part, Crf(*shipped.value))):
                pieces, free = [], 0
                for a, kind, b in spans:
                    if a >= free:
                        pieces += [texts[k][free:a], f"<{kind.upper()}>"]
                    free = max(free, b)
                texts[k] = "".join(pieces) + texts[k][free:]
            columns = [part.column(n) for n in names]
            columns[at] = pa.array([t if ok else None for t, ok in zip(texts, present)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    given = docs.withColumn(text_col, F.col(text_col).cast("string")).toDF(*names)
    return given.mapInArrow(run, given.schema).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
