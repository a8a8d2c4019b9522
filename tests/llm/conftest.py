import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977} the" for i in range(12000))
#: Extra columns whose names the operators use inside.
CLASHING = ("w", "l", "h", "s", "words", "bucket", "spread", "hashes", "registers", "score", "rank", "size", "kept",
            "a", "b", "text2", "batch", "row", "start", "band")


@pytest.fixture(scope="session")
def word():
    return WORD


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every odd case, and extra columns with clashing names."""
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "the") for b in ("", "ra", "sen", "to", "m")]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 60))) for _ in range(24)]
    texts = [None, "", " \t\n", "one", "a b c", "ÄÖ ñandú été\x0bx", LONG, LONG + " end", "x" * 20000, "###\n###\n###"]
    texts += base + [t + " extra" for t in base[:12]] + [t.upper() for t in base[:4]]
    rows = [(i, t, rng.choice(["src1", "src2", None]), rng.choice(["en", "fr", None])) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], rows[1], (None, base[0], "src1", "en"), (None, None, None, None)]
    extra = ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame([r + (7,) * len(CLASHING) for r in rows],
                                 f"doc_id long, text string, source string, lang string, {extra}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
