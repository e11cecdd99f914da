import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, n bigint, hot int"


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def small_docs():
    """(doc_id, text): exact and near copies, shared passages, junk, null, empty, blank and long texts."""
    rnd = random.Random(7)
    passage, base = prose(rnd, 80), prose(rnd, 200)
    out = [None, "", " \n\t ", "one", "one two three", "Ünï çödé ß 日本語 words", "a" * 700, ("Les Rech.\n" * 200), "x y " * 300]
    out += [base, base, base.upper(), base.replace(" ", "\n", 5)]
    for k in range(40):
        w = base.split()
        for _ in range(k % 8):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    out += [f"{prose(rnd, rnd.randrange(1, 60), 10**6)} {passage} {prose(rnd, rnd.randrange(1, 60), 10**6)}" for _ in range(90)]
    out += [prose(rnd, rnd.randrange(1, 300), 10**6) for _ in range(60)]
    out.append(prose(rnd, 30_000, 10**6) + " " + passage)
    return list(enumerate(out))


@pytest.fixture(scope="session")
def make(spark):
    def frame(docs):
        """With extra columns whose names the operators use inside."""
        rows = [(i, t, "en", None if k % 11 == 0 else f"src{k % 5}", len(t or ""), k, k, k) for k, (i, t) in enumerate(docs)]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return frame
