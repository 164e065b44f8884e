import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, size string"


def edge_rows():
    """Nulls everywhere, empty and long texts, repeats, ties, clashing column names."""
    long = " ".join(f"w{i % 97} MIT License, the idiot." for i in range(6000))
    texts = [None, "", "   \n\t", "!!! 123", "one", "a b c d", "a b c d", "x" * 50_000, long, "ß É Σίσυφος 日本語", "tab\tsep\x0bvt\x0cff\rcr", "The end <|endoftext|> here", "line\nline\nline\n\n"]
    rows = [(i, t, "en" if i % 3 else None, ["s1", "s2", None][i % 3], len(t or ""), "clash", "clash", "clash") for i, t in enumerate(texts)]
    rows += [(5, "a b c d", "en", "s1", 7, None, None, None)] * 2  # repeated rows of an id that has another text too
    rows += [(None, "no id", None, None, None, None, None, None)] * 2
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (8, 0, 1), (8, 1, 1), (4, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
