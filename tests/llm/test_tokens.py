from collections import Counter

from tessera.llm import token_counts


def test_histogram_answers_match_brute_force(odd_docs, no_docs):
    length = token_counts._coder(token_counts.TOKENIZERS)
    lengths = [length(r.text or "") for r in odd_docs.collect()]
    histogram = token_counts.length_histogram(odd_docs)
    assert {r.n_tokens: r.n_docs for r in histogram.collect()} == Counter(lengths)
    limits = token_counts.context_limits(histogram).cache()
    for r in limits.collect():
        c = r.context_limit
        assert r.docs_longer == sum(n > c for n in lengths) and r.tokens_longer == sum(n for n in lengths if n > c)
        assert r.truncated_total == sum(min(n, c) for n in lengths) and r.total_tokens == sum(lengths)
    for c in (0, 1, 7, 40, 10 ** 6):
        assert token_counts.truncated_total(limits, c) == sum(min(n, c) for n in lengths)
    ranked = sorted(lengths)
    for q in (0.1, 0.5, 0.9, 1.0):
        assert token_counts.quantile(limits, q) == ranked[max(-(-int(q * 1000) * len(ranked) // 1000) - 1, 0)]
    assert token_counts.context_limits(token_counts.length_histogram(no_docs)).collect() == []


def test_special_markers_are_ordinary_text(spark):
    df = spark.createDataFrame([("<|endoftext|>",)], "text string")
    assert token_counts.length_histogram(df).first().n_tokens > 1


def test_long_runs_of_white_space(spark):
    """Longer than the pattern engine can match at once."""
    length = token_counts._coder(token_counts.TOKENIZERS)
    for text in (" " * 3_000_000, "a" + "\n\u3000" * 600_000 + "b"):
        n = token_counts.length_histogram(spark.createDataFrame([(text,)], "text string")).first().n_tokens
        assert n == length(text) > 1000
