import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a long text, and columns with clashing names."""
    base = " ".join(f"w{i % 97}x{i % 13}" for i in range(400))
    rows = [
        (1, base, "a", 5), (2, base, "a", 6), (2, base, "a", 6), (3, base + " end", "b", 7), (4, None, None, None), (5, "", "b", 1),
        (6, "  \n ", None, 2), (7, "one two", "a", 3), (None, "three four five six seven eight", "c", 4), (8, "long " * 30_000, "c", 9),
        (9, "Caf\u00e9 \u00dcber. " + base.upper(), "b", 8),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size bigint")
    return df.selectExpr("*", "size shard", "size slot", "text row", "size bucket", "size key", "size id", "size h", "size term", "size score")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("doc_id < 0")
