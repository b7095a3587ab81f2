import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "theta", "zeta", "iota", "rho", "tau", "phi", "chi", "psi", "eta", "mu", "nu", "xi"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, shared passages, repeated lines, empty, null, short and long texts."""
    rng = random.Random(7)
    base = [prose(rng, 80) for _ in range(12)]
    passage = prose(rng, 60)
    out = list(base) + [base[0], base[0], base[1]]
    for i in range(8):
        w = base[2].split()
        for _ in range(1 + i % 3):
            w[rng.randrange(len(w))] = f"edit{i}"
        out.append(" ".join(w))
    out += [f"{prose(rng, 30)}\n{passage}\n{prose(rng, 25)}" for _ in range(5)]
    line = "this line of boilerplate stands in many documents"
    out += [f"{line}\n{prose(rng, 20)}\n{line[:-1]}", f"{line}x\n\n{prose(rng, 12)}", line, "ab\nab\nab"]
    out += ["", None, " ", "one", "two words", "a b c d", "!!!", "é ü", "x" * 3000, "ab" * 2000, prose(rng, 4000), "日本語 テキスト", "<|endoftext|> a  b\n\n c"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as rows with columns whose names operators use themselves."""
    rows = [(i * 3, t, "en" if i % 2 else None, "src", len(t or ""), i, "k", 1.0, "line") for i, t in enumerate(texts)]
    rows.append((None, "no id here at all, but a text of several words", None, None, None, 0, None, None, None))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, kept string, h double, line string").repartition(3).cache()


@pytest.fixture(scope="session")
def pairs(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
