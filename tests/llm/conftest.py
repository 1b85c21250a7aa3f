"""A small corpus with every awkward case, as rows and as a table."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use themselves, for results or inside.
CLASHING = ["size", "kept", "score", "fp", "row", "key", "bin", "n", "h", "block", "taken", "removed", "verdict",
            "Lang_Pred", "group_size", "keep_id", "piece", "node", "best", "label", "base"]


def prose(seed: int, n: int, vocab: int = 400) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3))) for _ in range(vocab)]
    out = [words[min(int(r.expovariate(0.03)), vocab - 1)] for _ in range(n)]
    lines = [" ".join(out[i:i + 14]) for i in range(0, n, 14)]
    return "\n".join(lines)


def corpus():
    long = prose(1, 9000)
    rows = [(i, prose(100 + i % 40, 30 + 17 * (i % 23)), ["en", "de", None, "fr"][i % 4], ["a", "a", "a", "b", "c", None][i % 6])
            for i in range(120)]
    near = prose(7, 200).split(" ")
    for k in range(6):                      # near copies: one word differs
        w = list(near)
        w[20 * k + 3] = "zzz" + str(k)
        rows.append((200 + k, " ".join(w), "en", "b"))
    rows += [(300, None, None, None), (301, "", "en", "a"), (302, " \t\n ", "en", "a"), (303, "", None, None),
             (304, long, "en", "b"), (305, long.replace(" ", "  "), "en", "b"), (306, long[:-3] + "xyz", "en", "c"),
             (None, "no id here at all", "en", "b"), (None, "no id here at all", "en", "b"), (None, None, None, None),
             (400, "tie", "en", "a"), (400, "tie", "en", "a"), (400, "tie", "en", "a"), (401, "TIE", "de", "a"),
             (402, "one two", "fr", "c"), (403, "Ünïcödé ñandú 漢字 ß", "de", "c"), (404, "123 456 !!!", "en", "c"),
             (405, "A line that many documents share, word for word.\nown line of 405", "en", "a"),
             (406, "A line that many documents share, word for word.\nown line of 406 is else", "en", "a")]
    return [(d, t, l, s, None if t is None else len(t)) for d, t, l, s in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING], F.lit("x").alias("odd `name.with dots"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
