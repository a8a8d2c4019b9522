from collections import Counter

from tessera.llm import quality_rules


def brute(text, word):
    words = word.findall(text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if word.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(repeated), len(words) < 10 or 100 * len(repeated) > 20 * len(words))


def test_counts_match_brute_force_on_odd_rows(odd_docs, word):
    rows = quality_rules.apply_rules(odd_docs).collect()
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
                   for r in rows)
    assert found == sorted(str((i, *brute(t, word))) for i, t in texts)
    assert not any(r.kept and r.base_failed for r in rows)


def test_rules_name_what_they_reject(spark):
    prose = " ".join(f"word{i} of the" for i in range(30))
    noise = " ".join(f"word{i}$$$ of%%% the" for i in range(30))
    shout = " ".join(f"word{i}!! of the!!" for i in range(30))
    rows = spark.createDataFrame([(0, prose), (1, noise), (2, shout), (3, "zz " * 3 + " ".join(map(str, range(99))))],
                                 "doc_id long, text string")
    found = {r.doc_id: (r.kept, r.broken_rules) for r in quality_rules.apply_rules(rows).collect()}
    assert found == {0: (True, []), 1: (False, ["symbols"]), 2: (False, ["shouting"]), 3: (False, ["stop_words"])}


def test_empty_table(no_docs):
    assert quality_rules.apply_rules(no_docs).collect() == []
