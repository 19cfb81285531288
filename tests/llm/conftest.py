import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from ``(doc_id, text)`` pairs, with extra columns whose names clash."""

    def make(rows, **extra):
        names = ["id", "print", "path", "words", "key", "score", "spans", "blob"]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
        full = [(i, t, extra.get("lang"), "s", None if t is None else len(t), *["x"] * len(names)) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def words_of():
    return lambda text: WORD.findall(text or "")


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, long, repeated and unusual texts."""
    return [
        None,
        "",
        " ",
        "\n\n",
        "a",
        "a",
        "word " * 3000,
        "x" * 5000,
        "Ünïcode ﬁ ▁ mark▁ \x00 ퟿ 😀",
        "  two  spaces and a tab\tand a break\r\nhere \n there ",
        "<|endoftext|> <s> </s>",
        "123 456 !!! ???",
    ]
