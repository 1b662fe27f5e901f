import random

import pytest


def make_corpus(seed: int = 1, n: int = 60) -> list[tuple[int, str | None]]:
    """Texts with exact and near copies, shared passages, nulls, empty and very long ones."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = text(90)
    out: list[str | None] = [None, "", "  \n ", "one", "One  TWO\tthree", "one two three", passage, passage.upper()]
    out += [text(rng.randint(5, 150)) for _ in range(n)]
    out += [text(4000), "same " * 500, "x" * 3000]
    for i in range(12, 24):
        w = out[i].split()
        out.append(out[i])
        if len(w) > 30:
            w[len(w) // 2] = "changed"
            out.append(" ".join(w))
            out.append(" ".join(w[: len(w) // 2]) + " " + passage)
    out += [text(40) + "\n" + passage + "\n" + text(40) for _ in range(8)]
    base = text(100).split()
    for i in range(40):  # a large group of near copies
        w = list(base)
        w[(7 * i) % 100] = f"edit{i}"
        out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.fixture(scope="session")
def corpus():
    return make_corpus()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3, "doc_id")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
