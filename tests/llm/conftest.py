import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
CLASHES = ["row_file", "row_pos", "keep_id", "kept", "fp", "score", "lang_pred", "held_out", "block", "parts", "name", "root", "head",
           "n_tokens", "start", "shard", "component_id", "text_sha256", "norm", "at", "column_0"]


def prose(rnd, n, words):
    return " ".join(rnd.choice(words) for _ in range(n))


def messy_rows(seed=7):
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows and blanks of all kinds."""
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdefgéßñ") for _ in range(rnd.randint(1, 9))) for _ in range(300)] + ["Über,", "it's", "1999", "<|endoftext|>", "日本"]
    texts = [prose(rnd, rnd.randint(1, 200), pool) for _ in range(25)]
    passage = prose(rnd, 120, pool)
    texts += [prose(rnd, 30, pool) + " " + passage + " " + prose(rnd, 30, pool) for _ in range(4)]
    texts += [texts[0], " " + texts[0].replace(" ", "\n"), texts[1] + " x", texts[1] + "\t x"]
    texts += [None, None, "", " \t\n\x0b\x0c\r ", "!!! ... 123", "a", "A", "a  a", " x\u0085y", "é ǅ \U0001f600\U0001f600"]
    texts += ["ab" * 900, "z" * 1500, "z" * 1500, prose(rnd, 9000, pool)]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["s", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[4], "en", None, 1), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def messy():
    return messy_rows()


@pytest.fixture(scope="session")
def messy_docs(spark, messy):
    return spark.createDataFrame(messy, DOCUMENTS).repartition(3).persist()


@pytest.fixture(scope="session")
def clashing_docs(messy_docs):
    from pyspark.sql import functions as F

    return messy_docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


def as_rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
