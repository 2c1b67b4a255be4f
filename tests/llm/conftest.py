import pytest

#: Texts every operator must take: null, empty, blanks, repeats, other alphabets, a very long one.
ODD = [None, "", " \n\t ", "one", "one", "Émile ß ŉ, İstanbul ΣΑΣ x", "a  b\x0bc\r\n d", "word " * 6000, "日本語 テスト <|endoftext|>"]


@pytest.fixture(scope="session")
def table(spark):
    """documents of the given texts, with ids from 0 or as given, and columns whose names clash."""
    def build(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "x", 1, 2, "k") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, part int, key string")

    return build


@pytest.fixture
def odd(table):
    return table(ODD, [None, 5, 5, 7, 7, 1, 2, 3, None])
