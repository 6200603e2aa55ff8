import random
import re

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators also use.
CLASHES = ("score", "size", "kept", "target", "taken", "fp", "label", "words", "n", "rank", "keep_id",
           "component_id", "text_sha256", "u", "v", "task", "side", "ids", "block", "a", "b", "uid", "row", "copies",
           "root", "stays", "score_", "__rn", "__id", "__none", "__copies", "__i", "__row_key", "__score", "__text",
           "__nth", "__unit", "__same", "__norm", "__source", "__block", "__n", "__p")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties, copies and repeated rows."""
    base = prose(1, 120)
    long = "\n".join(prose(s, 50) for s in range(100, 400))
    rows = [
        (0, base, "en", "b", 1), (1, base, "en", "b", 1), (2, base + " ", "en", "a", 1),
        (3, "  " + base.replace(" ", "\n"), "en", None, 1), (3, "  " + base.replace(" ", "\n"), "en", None, 1),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \t\r\n\x0b\x0c", "en", "c", 0),
        (None, base, "en", "c", 1), (None, None, None, "c", None), (7, prose(2, 1), "en", "c", 1),
        (8, prose(2, 2), "en", "c", 1), (9, long, "de", "c", 1), (10, long + "x", "de", "c", 1),
        (11, long, "de", "d", 1), (12, "é" * 5000 + " \U0001f600 ıİ ß don't  we're it's 12345", "fr", "d", 1),
        (13, "ab " * 400, "en", "d", 1), (14, "one\n\ntwo\nthree\nfour\none\ntwo\nthree\nfive", "en", "e", 1),
        (15, "Released under the MIT License.\r\nx. Licensed under CC BY-NC 4.0.", "en", "e", 1),
    ]
    return rows + [(100 + i, prose(1000 + i, 20 + 5 * i), "en", "fgh"[i % 3], 1) for i in range(40)]


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES]).repartition(3).checkpoint()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)
