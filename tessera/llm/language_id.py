"""Operator 6 -- language identification with hyperdimensional profiles.

Every letter symbol has a random vector of +1 and -1 (``DIMENSIONS`` long).  An
n-gram's vector binds its letters' vectors, each permuted (rolled) by its place,
by elementwise product.  A text bundles (sums) the vectors of its n-grams, a
language bundles those of all its texts, and a text gets the language whose
prototype has the greatest cosine with it.

A text's bundle is linear in its n-gram counts, so its dot products with the
prototypes are sums over its n-grams of ``<n-gram vector, prototype>``, which
is one table (n-grams x languages) computed once per model: a text costs one
look-up per n-gram and language, whatever the dimension.  The text's own norm
is the same for all languages; for the score it is taken at its expectation
over the random vectors, ``sqrt(DIMENSIONS * sum of squared counts)``.

Profiles count every n-gram of every learnable text (no sample): counts are
summed in each task and then by (language, n-gram), at most ``SYMBOLS ** 3``
rows a language, however large the corpus.

Symbols: the space (any run of non-letters), a to z, and ``SYMBOLS - 27`` slots
for all other letters by code point, cases folded.

Defined cases: null text or text without a letter: ``und``, score 0; a null
language is not learned from; without any learnable text every text is ``und``
with score 0; equal cosines go to the first language by code point; repeated
rows are judged row by row; very long texts are read whole; only id, text and,
for learning, the language are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrow_text import TextSlice, mix64, slices
from tessera.llm.quality_model import fold

SYMBOLS = 48
GRAMS = SYMBOLS ** 3
DIMENSIONS = 4096
SEED = 611
#: How sharply cosines turn into shares of the score.
SHARPNESS = 12.0
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2


def symbol_table() -> np.ndarray:
    """Code point -> symbol; 0 is anything but a letter."""
    points = np.arange(0x110000, dtype=np.uint32)
    table = np.zeros(len(points), np.uint8)
    chars = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000)]
    letter = np.fromiter(map(str.isalpha, chars), bool, len(chars))
    lower = np.fromiter((ord(c.lower()[0]) for c in chars), np.uint32, len(chars))
    other = 27 + (mix64(lower.astype(np.uint64)) % np.uint64(SYMBOLS - 27)).astype(np.uint8)
    latin = (lower >= 97) & (lower <= 122)
    table[letter] = np.where(latin, lower - 96, other)[letter]
    return table


def n_grams(part: TextSlice, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, trigram id) of every trigram in the slice.

    A text reads as one space, its letters with a space for every run of
    non-letters, and one space."""
    texts = part.texts()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "replace"), np.uint32)
    symbols = table[points]
    # Each text owns the separator before it.
    owner = np.repeat(np.arange(len(texts) + 1), np.append(lengths + 1, 1))
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    keep[0] = True
    symbols, owner = symbols[keep].astype(np.int64), owner[keep]
    grams = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    inside = symbols[1:-1] > 0  # the middle is a letter: belongs to its text
    return owner[1:-1][inside], grams[inside]


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, gram, n over all rows with a language."""
    shipped = docs.sparkSession.sparkContext.broadcast(symbol_table())
    known = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = shipped.value, {}
        for part in slices(batches):
            owner, grams = n_grams(part, table)
            langs, which = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            of = which[owner] if len(owner) else owner
            for k, lang in enumerate(langs):
                found = np.bincount(grams[of == k], minlength=GRAMS)
                sums[str(lang)] = sums[str(lang)] + found if str(lang) in sums else found
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                              "gram": pa.array(at, pa.int64()), "n": pa.array(found[at], pa.int64())})

    return (known.mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def letter_vectors(dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, dimensions))


def gram_vectors(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bound vectors: the letter two places back is rolled twice, and so on."""
    a, rest = np.divmod(grams, SYMBOLS * SYMBOLS)
    b, c = np.divmod(rest, SYMBOLS)
    return np.roll(letters, 2, 1)[a] * np.roll(letters, 1, 1)[b] * letters[c]


class Model:
    """Languages and the table of ``<n-gram vector, unit prototype>``."""

    def __init__(self, counts: pa.Table, dimensions: int = DIMENSIONS):
        self.languages = sorted(set(counts["lang"].to_pylist()), key=lambda x: [ord(c) for c in x])
        self.dimensions = dimensions
        letters = letter_vectors(dimensions)
        lang = np.array([self.languages.index(x) for x in counts["lang"].to_pylist()], np.int64)
        gram, n = counts["gram"].to_numpy(), counts["n"].to_numpy().astype(np.float64)
        dense = np.zeros((len(self.languages), GRAMS), np.float32)
        dense[lang, gram] = n
        prototypes = np.zeros((len(self.languages), dimensions), np.float32)
        step = 4096
        for k in range(0, GRAMS, step):
            if dense[:, k:k + step].any():
                block = gram_vectors(np.arange(k, min(k + step, GRAMS)), letters).astype(np.float32)
                prototypes += dense[:, k:k + step] @ block
        prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
        self.prototypes = prototypes
        self.dots = np.zeros((GRAMS, len(self.languages)), np.float32)
        for k in range(0, GRAMS, step):
            block = gram_vectors(np.arange(k, min(k + step, GRAMS)), letters).astype(np.float32)
            self.dots[k:k + step] = block @ prototypes.T


def learn(docs: DataFrame) -> Model:
    """Prototypes of all languages of ``docs``; the driver gets the n-gram
    counts of the languages, whose size the alphabet bounds."""
    return Model(profiles(docs).orderBy("lang", "gram").toArrow())


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score``."""
    context = docs.sparkSession.sparkContext
    shipped = context.broadcast((symbol_table(), model.dots, model.languages, model.dimensions))
    given = docs.select(*keep, F.col(text_col).cast("string").alias("\ntext"))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, dots, languages, dimensions = shipped.value
        for part in slices(batches, "\ntext"):
            owner, grams = n_grams(part, table)
            out = {c: part.column(c) for c in keep}
            if not len(grams) or not languages:
                names, score = [UNKNOWN] * len(part), np.zeros(len(part))
            else:
                # Distinct n-grams of each text with their counts.
                key, count = np.unique(owner * GRAMS + grams, return_counts=True)
                owner, grams = np.divmod(key, GRAMS)
                squares = np.bincount(owner, count.astype(float) ** 2, minlength=len(part))
                norm = np.sqrt(dimensions * np.maximum(squares, 1))
                cosine = np.stack([np.bincount(owner, count * dots[grams, k], minlength=len(part))
                                   for k in range(len(languages))], 1) / norm[:, None]
                best = cosine.argmax(1)
                share = np.exp(SHARPNESS * (cosine - cosine.max(1, keepdims=True)))
                lettered = squares > 0
                score = np.where(lettered, 1 / share.sum(1), 0.0)
                names = [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
            out["lang_pred"], out["score"] = pa.array(names, pa.string()), pa.array(score, pa.float64())
            yield pa.RecordBatch.from_pydict(out)

    return given.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn(docs.filter(fold("doc_id", FOLDS) != HELD_OUT))
    return predict(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
