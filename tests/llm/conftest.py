"""Small tables with the awkward cases that every operator must survive."""

import pytest

LONG = "word " * 40_000 + "end"
TEXTS = [
    None, "", " \n\t ", "one", "two words", "  leading and trailing  ", LONG,
    "Same text of a few words that is here twice, and then some more of them to be long enough for all rules.",
    "Same text of a few words that is here twice, and then some more of them to be long enough for all rules.",
    "line one\nline two\n\nline one\r\nline 😀 é x", "<|endoftext|> a\0b [INST] </s>",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, ties,
    repeated rows, and extra columns named like operators' own."""
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "b", "a"][i % 3], None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    rows += [rows[7], rows[7], (None, "a row without an id", "en", "b", 19), (None, None, None, None, None)]
    names = ["start", "size", "_fp", "kept", "_host", "n", "rank", "_mix_size", "label", "TEXT_"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit(k) for k, n in enumerate(names)}).cache()


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")
