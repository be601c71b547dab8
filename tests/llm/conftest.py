import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

#: One row of each odd kind, for operators on texts: null, empty and blank texts, a null key, repeated rows, a long word.
ODD = [(1, "a b c d e f g h"), (2, None), (3, ""), (4, " \t\n"), (5, "a b c d e f g h"), (5, "a b c d e f g h"), (None, "z y x w v u"), (7, "x" * 5000), (8, "é ß 漢字 no break")]


@pytest.fixture
def odd(spark):
    """The odd rows, with columns whose names clash with those an operator could use inside."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    from pyspark.sql import functions as F

    return df.select("doc_id", "text", *[F.lit("own").alias(c) for c in ("key", "rid", "n", "seeds", "base", "spans", "score", "length", "_row", "comp", "label")])


@pytest.fixture
def none(odd):
    return odd.limit(0)
