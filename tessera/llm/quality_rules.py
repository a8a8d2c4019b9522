"""Operator 2 -- quality rules: a threshold table compiled into one projection.

A rule bounds one measure of a text.  ``compile_rules`` turns the whole table
into Column expressions, so the verdict is one Spark projection of length,
symbol, stop-word and line ratios: no user function, no shuffle, one pass.

Defined cases: a null text is the empty text (no words, fails the base rules);
a ratio over zero words or lines is 0; a null doc_id and repeated rows pass
through row by row; an empty table gives an empty result; only the id and the
text column are read, so extra columns of any name do not matter.  Any text
length is measured whole: the cost of a text of n words is O(n log n).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import total, whole, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the corpus languages.
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as",
    "by", "at", "are", "be", "this", "from", "or", "an", "not", "have", "which", "they",
    # German
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist",
    "im", "dem", "nicht", "ein", "eine", "als", "auch", "es", "werden", "aus", "er", "hat", "dass",
    # French
    "de", "la", "le", "et", "les", "du", "un", "une", "est", "pour", "que", "qui", "dans", "par",
    "sur", "pas", "plus", "avec", "au", "aux", "ne", "se", "ce", "il", "sont", "ou",
    # Spanish
    "el", "los", "del", "las", "por", "con", "no", "su", "para", "al", "lo", "como", "más", "pero",
    "sus", "y", "o", "en", "si", "mi", "ha", "muy", "sin", "sobre", "ser", "son",
)
#: As they stand inside and at the start of a sentence.
STOP_FORMS = tuple(sorted({form for w in STOP_WORDS for form in (w, w.capitalize())}))


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high`` (either bound may be None)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table.  Generous bounds: they are there to reject what is not
#: prose at all, not to rank prose.
RULES = (
    Rule("mean_word_length", "mean_word_length", 1.5, 15.0),
    Rule("symbols", "symbol_ratio", None, 0.2),
    Rule("stop_words", "stop_word_ratio", 0.01, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.3),
    Rule("shouting", "exclamation_ratio", None, 0.3),
)

MEASURES = {
    "mean_word_length": lambda: _ratio("word_chars", "n_words"),
    "symbol_ratio": lambda: _ratio("n_symbols", "n_words"),
    "stop_word_ratio": lambda: _ratio("n_stop_words", "n_words"),
    "dup_line_ratio": lambda: _ratio("n_dup_lines", "n_lines"),
    "exclamation_ratio": lambda: _ratio("n_exclamations", "n_words"),
}


def _ratio(part: str, base: str) -> Column:
    return F.when(F.col(base) > 0, F.col(part) / F.col(base)).otherwise(F.lit(0.0))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """One boolean column per rule (true: the rule is broken)."""
    out = {}
    for rule in rules:
        value = MEASURES[rule.measure]()
        broken = F.lit(False)
        if rule.low is not None:
            broken = broken | (value < rule.low)
        if rule.high is not None:
            broken = broken | (value > rule.high)
        out[rule.name] = broken
    return out


def _repeat_words(window: int) -> Column:
    """Words that lie in a window found twice or more, from the sorted
    (hash, position) pairs of the windows ``s`` of a text.

    Equal windows are neighbours in ``s``; the union of the flagged windows is
    the sum over their sorted starts of min(window, distance to the next)."""
    flagged = F.filter("s", lambda x, i: F.coalesce(F.get("s", i - 1)["h"] == x["h"], F.lit(False))
                       | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False)))
    return F.array_sort(F.transform(flagged, lambda x: x["p"])), lambda starts: total(F.transform(
        starts, lambda p, i: F.least(F.lit(window),
                                     F.coalesce(F.get(starts, i + 1), p + window) - p)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             window: int = WINDOW) -> DataFrame:
    """The counts that the rules need, one row per row of ``docs``.

    Windows are compared by a 64-bit hash of their words."""
    # Character counts by splitting: far cheaper than translating every character.
    def count(pattern: str) -> Column:
        return (F.size(F.split("text", pattern)) - 1).cast("long")

    def nth(i: Column) -> Column:
        return F.get("w", i)

    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.transform("w", lambda x, i: F.xxhash64(x, *(nth(i + k) for k in range(1, window))))
    base = docs.select(F.col(id_col).alias(id_col), whole(text_col).alias("text"))
    base = base.select(id_col, "text", words("text").alias("w"), lines.alias("l"))
    base = base.select(
        id_col, "w", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count(f"[{SYMBOLS}]").alias("n_symbols"), count("!").alias("n_exclamations"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: x.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
        F.slice(windows, 1, F.greatest(F.size("w") - (window - 1), F.lit(0))).alias("h"))
    counts = [c for c in base.columns if c not in ("w", "h")]
    # Most texts repeat no window: they stop at the distinct count.
    base = base.select(*counts, F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).alias("s"))
    starts, covered = _repeat_words(window)
    base = base.select(*counts, starts.alias("starts"))
    return base.select(*counts, F.coalesce(covered(F.col("starts")), F.lit(0)).cast("long")
                       .alias("n_repeat_words"))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Counts, base verdict, the broken rules by name, and the final verdict."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    broken = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in compile_rules(rules).items()]),
                      lambda x: x.isNotNull())
    return (measures(docs, id_col, text_col)
            .select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed.alias("base_failed"), broken.alias("broken_rules"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                    "n_repeat_words", "base_failed", "kept")


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_FORMS)
ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT k, p, list_aggregate(list_slice(w, p, p + 4), 'string_agg', ' ') AS g
  FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
rep AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT k, count(DISTINCT q) AS n FROM (SELECT k, p + unnest([0, 1, 2, 3, 4]) AS q FROM rep) GROUP BY k),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({_STOP_SQL}))) AS stops,
         length(regexp_replace(t, '[^!]', '', 'g')) AS excl
  FROM d LEFT JOIN cov USING (k)),
v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars / n_words BETWEEN 1.5 AND 15
       AND n_symbols / n_words <= 0.2 AND stops / n_words >= 0.01
       AND n_dup_lines / greatest(n_lines, 1) <= 0.3 AND excl / n_words <= 0.3 AS kept
FROM v
"""
