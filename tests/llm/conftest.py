import pytest

from skyloom.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and long texts, ties, repeated rows, odd white space; as (doc_id, text)."""
    words = [f"w{i % 97}{'é' * (i % 3)}" for i in range(6000)]
    return [
        (1, "The quick  brown fox\njumps\tover the lazy dog.\r\n\n  end "),
        (2, None),
        (3, ""),
        (4, " \n\t \n"),
        (5, "a"),
        (6, " ".join(words)),
        (7, "same line\nSAME LINE \nother"),
        (7, "same line\nSAME LINE \nother"),
        (None, "no id at all, don't you see 12345 ### $$ <|endoftext|> x"),
        (-9, "ЖЗИ 日本語のテキスト \x1c\x1d naïve café   ok"),
        (10, "x" * 3000),
        (11, "\x00nul \x7f del"),
    ]


@pytest.fixture()
def odd(spark, odd_docs):
    """The odd documents with extra columns whose names clash with what the operators make."""
    rows = [(d, t, "src", 7, "mine", 3) for d, t in odd_docs]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, block string, h int")


@pytest.fixture()
def empty(odd):
    return odd.where("false")
