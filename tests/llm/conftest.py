import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, one id with two texts,
    and further columns whose names the operators use themselves."""
    line = "the same line again and again"
    page = "\n".join(" ".join(f"word{k}{c}" for c in "abcdefgh") for k in range(8))
    texts = [
        (1, page, "en", "a"), (2, page, "en", "a"), (2, page, "en", "a"), (3, page + "\nand an end", None, "b"),
        (4, None, "en", None), (None, None, None, None), (None, page, "de", "a"), (5, "", "en", "a"),
        (6, " \t\n\x0b\f\r ", "en", "a"), (7, "\n".join([line] * 50), "en", "b"), (8, "x", "en", "b"),
        (9, "long " * 40000, "en", "b"), (9, "the id of another text", "en", "b"), (10, "é😀 ñ wide " * 30, "es", "c"),
        (11, "mail me@example.org or call +1 (988) 555-2485, 10.0.0.255", "en", "a"), (12, "X" * 60000, "en", "c"),
        (13, "<|endoftext|> is  text   here\n\n and\there", "en", "c"),
    ]
    rows = [(i, t, lang, source, None if t is None else len(t), 7, "k", True) for i, t, lang, source in texts]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "bucket int, key string, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
