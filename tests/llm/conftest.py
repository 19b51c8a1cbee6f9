import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("_key", T.StringType()), T.StructField("words", T.IntegerType()),
])
SYLLABLES = ["an", "ther", "ing", "ou", "tion", "re", "st", "ble", "é", "ha", "on", "ly"]


def sentence(rnd: random.Random, words: int) -> str:
    made = ["".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs, with columns whose names clash with those used inside."""

    def make(rows):
        full = [(i, t, "en", f"k{n}", f"x{n}", n) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact copies, near copies, shared passages, repeats inside, odd and empty ones."""
    rnd = random.Random(5)
    passage = sentence(rnd, 60)
    rows = []
    for i in range(60):
        lines = [sentence(rnd, rnd.randint(3, 30)) for _ in range(rnd.randint(1, 6))]
        if i % 5 == 0:
            lines.insert(rnd.randint(0, len(lines)), passage)
        if i % 7 == 0:
            lines.append("A line that many pages have at their end.")
        if i % 11 == 0:
            lines.append(lines[0])
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[3][1]), (101, rows[4][1] + " tail"), (102, rows[3][1]), (3, rows[3][1])]
    rows += [(200, None), (201, ""), (202, "  \n\t "), (203, "..."), (None, rows[7][1]), (None, None), (204, "word"), (204, "word")]
    rows += [(205, "la " * 5000), (206, sentence(rnd, 4000)), (207, "x" * 30000), (208, "#1 | $2 <b> ** 50% &amp;\n\n#1 | $2 <b> ** 50% &amp;")]
    return rows
