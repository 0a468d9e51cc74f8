import zlib

import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Documents from (doc_id, text) pairs, with extra columns that clash with names used inside."""

    def make(pairs, extra=False):
        schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
        made = spark.createDataFrame([(i, t, "en", "s", None) for i, t in pairs], schema)
        if extra:
            for name in ("digest", "keep_id", "hot", "pos", "shard", "slot", "flags", "score", "block", "label", "n", "_id", "size"):
                made = made.selectExpr("*", f"1 AS {name}")
        return made

    return make


def crc(text):
    return zlib.crc32((text or "").encode())


ODD = [
    (1, None), (2, ""), (3, "a"), (4, "Same text\nhere"), (5, "Same text\nhere"), (5, "Same text\nhere"),
    (None, "no id"), (None, None), (6, "word " * 30000), (7, "\n\n\n"), (8, "x" * 50000), (9, "ÉÀß   \x1f\x00z"), (10, "Same text\nhere"),
]
