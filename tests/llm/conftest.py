import pytest

LONG = "lorem ipsum dolor " * 30_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs in every column, empty and long texts, repeated rows, columns with odd names."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long,"
        " kept boolean, lines string, _place long, class string, score double"
    )
    words = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, words + "\nshared line here", "en", "a", 5),
        (1, words + "\nshared line here", "en", "a", 5),
        (2, words + "\nshared line here", "en", "a", 5),
        (3, "", "en", "a", 0),
        (4, None, "en", "a", None),
        (5, LONG, None, "a", 1),
        (None, "null id ééé \x00 <|endoftext|> 'S", "fr", None, 1),
        (6, " \t\n\x0b \n", "fr", None, 1),
        (7, words.replace("word7 ", "other "), None, None, 1),
        (8, "  leading   and trailing \n\n", "de", "b", 1),
        (9, "日本語のテキスト　です。 𝒳 😀", "ja", "b", 1),
        (10, "12345 !!! ###", "de", "b", 1),
    ]
    return spark.createDataFrame([(*r, True, "x", 3, "c", 0.5) for r in rows], schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
