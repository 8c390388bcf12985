import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, runs string, hits int, fingerprint string, score string, run_key long, gone_id long, bad_id long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, repeated lines, junk, empty and null ones, and one very long one."""
    rng = random.Random(7)
    passage = " ".join(words(rng, 60)) + "."
    found = [None, "", "   \n ", "x", "Ünï çødé 字 \U0001f600 text", "a b", "token = abcdef123", "\x00\x01 control"]
    for _ in range(14):
        lines = [" ".join(words(rng, rng.randrange(1, 25))) for _ in range(rng.randrange(1, 12))]
        found.append("\n".join(lines))
        if rng.random() < 0.5:
            found.append("\n".join([lines[0], passage, *lines[1:]]))
    base = " ".join(words(rng, 120))
    found += [base, base, base.upper()]
    for k in range(6):
        w = base.split()
        w[5 + 9 * k] = f"changed{k}"
        found.append(" ".join(w))
    found += ["same line\n" * 40, "tie " * 30, " ".join(words(rng, 40_000))]
    return found


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents: ids with gaps, one row repeated, one id null, other columns with names that operators use."""
    rows = [(3 * i + 1, t, "en", "s", len(t or ""), "k", "r", 1, "f", "s", 1, 1, 1) for i, t in enumerate(texts)]
    rows.append(rows[10])
    rows.append((None, "a row without identifier", None, None, None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
