import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, rank int, words array<string>"


def rows_of(texts):
    """Rows of documents with ids in order; pairs give their own id. Extra columns have names that operators use inside."""
    out = []
    for i, x in enumerate(texts):
        doc_id, text = x if isinstance(x, tuple) else (i, x)
        out.append((doc_id, text, "en", "src", None if text is None else len(text), "x", i, ["w"]))
    return out


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts: spark.createDataFrame(rows_of(texts), COLUMNS)


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, ties, repeated rows, null and repeated ids, other scripts, one very long text."""
    rnd = random.Random(7)
    words = [w + s for w in ("alpha", "beta", "gamma", "delta", "Öl", "naïve", "x") for s in ("", "s", "ing", ".")]
    plain = [" ".join(rnd.choices(words, k=rnd.randint(12, 60))) for _ in range(12)]
    long = "\n".join(" ".join(rnd.choices(words, k=12)) for _ in range(1500))
    return [
        *plain, None, "", "   \n\t ", "Hello", "hello", plain[0], plain[0].upper(), (3, plain[3]), (3, "another text"),
        (None, plain[1]), (None, None), long, "a" * 5000, "日本語 テキスト\n▁ marker 🙂  nbsp", "<|endoftext|> in a text",
    ]


@pytest.fixture(scope="session")
def odd(make, odd_texts):
    return make(odd_texts)


@pytest.fixture(scope="session")
def no_docs(make):
    return make([])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(12)] + [(None, 1, 0), (1, None, None), (99999, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(labels):
    return labels.limit(0)
