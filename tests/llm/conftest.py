import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing names."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from here today"
    rows = [(1, prose, "en", "s1"), (2, prose, "en", "s1"), (2, prose, "en", "s1"), (3, None, None, None), (None, prose, "en", "s2"), (None, None, None, None), (4, "", "de", "s2"), (5, " \n\t ", "de", "s2"), (6, "one", None, "s1"), (7, LONG, "en", None), (8, "a\nb\n" + prose + "\n" + prose, "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("shard", "slot", "kept", "n_words", "lang_pred", "score", "n_tokens", "size", "copies", "row", "key", "whole_text", "cell", "group_key"):
        df = df.selectExpr("*", f"'x' as {name}")
    return df.cache()
