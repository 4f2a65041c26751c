import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

EXTRA = ("h1", "h2", "d", "row", "pos", "k", "word", "keep", "n", "w", "i", "token", "fp", "copies",
         "name", "least", "slice", "part", "score", "total", "n_words", "piece", "grp", "rest", "best",
         "_d", "_row", "_keep", "_doc", "_copy", "_score", "_evidence", "_n_words", "_EVIDENCE_")


def odd_rows(seed=5):
    """Documents with nulls, empty and long texts, ties, repeated rows and shared passages."""
    rng = random.Random(seed)

    def text(n):
        stock = ["the", "of", "And", "ÉTÉ", "straße"]
        return " ".join(
            rng.choice(stock) if rng.random() < 0.2
            else "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
            for _ in range(n)
        )

    lines = [text(rng.randint(3, 9)) for _ in range(8)]
    passage = text(70)
    rows = []
    for doc in range(60):
        parts = [text(rng.randint(0, 25)) for _ in range(rng.randint(1, 4))]
        parts += rng.sample(lines, rng.randint(0, 3))
        rng.shuffle(parts)
        body = "\n".join(parts)
        if rng.random() < 0.2:
            body += " " + passage[: rng.randint(60, len(passage))]
        if rng.random() < 0.2:
            body += "\n\t" + lines[0].upper().replace("É", "É") + " \r"
        rows.append((doc, body))
    long_text = "\n".join(text(12) for _ in range(1500)) + "\n" + lines[1]
    rows += [(60, long_text), (61, ""), (62, None), (63, " \n\t "), (64, "\n\n"), (65, "one"),
             (66, "one two"), (67, "ab" * 90), (68, "ab" * 90), (69, lines[2] + "\n" + lines[2])]
    rows += [(None, rows[3][1]), (None, None), (7, rows[3][1]), (3, rows[3][1]), (3, rows[3][1])]
    return rows


def frame(spark, rows, extra=True):
    """The rows as documents, with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    if not extra:
        return df
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(EXTRA)])


@pytest.fixture(scope="session")
def rows():
    return odd_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
