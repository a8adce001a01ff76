import random

import pytest

CLASH = ("n", "node", "rid", "w", "k", "id", "seed", "size", "score", "label",
         "words", "start", "cell", "key", "c", "a", "b", "text2", "_row")


def clash(df):
    """Extra columns whose names occur inside the operators."""
    from pyspark.sql import functions as F
    for name in CLASH:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


def text_rows(seed=5, n=150):
    """Texts with copies, near copies, shared lines, odd and long ones."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
             for _ in range(400)]
    line = " ".join(rng.choice(vocab) for _ in range(30))
    base = [[rng.choice(vocab) for _ in range(rng.randint(1, 120))]
            for _ in range(25)]
    texts = [None, "", "   \n\t ", "a", "A b", "a B c", "x" * 300, "ab " * 400,
             "Mit License!! the MIT\nlicense", "\x00 \x85\u00a0 word",
             " ".join(rng.choice(vocab) for _ in range(6000))]
    while len(texts) < n:
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocab)
        if rng.random() < .2:
            w = w[rng.randint(0, 3):]
        t = " ".join(w)
        if rng.random() < .3:
            t = f"{t}\n{line}" if rng.random() < .5 else f"{line}. {t}"
        texts.append(t.title() if rng.random() < .2 else t)
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def texts():
    return text_rows()


@pytest.fixture(params=[10_000, 3])
def arrow_rows(request, spark):
    """Arrow batches of the usual size, and of three rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, old)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc_frame(spark, rows):
    return clash(spark.createDataFrame(
        [(i, t, "en", f"src{(i or 0) % 4}" if (i or 0) % 7 else None,
          len(t or "")) for i, t in rows], DOCS))
