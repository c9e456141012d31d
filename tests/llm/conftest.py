import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Texts that every operator has to take: null, empty, blank, one word, a hot text, near copies, a very long word and text.
PROSE = " ".join(f"the word{i} of house{i % 7} and tree{i % 5}" for i in range(60))


def odd_texts() -> list[str | None]:
    long_text = " ".join(f"w{i % 997} x{i}" for i in range(30_000))
    return [
        None, "", "  \n\t ", "Re.", "Re.", PROSE, PROSE, PROSE, PROSE + " one more", PROSE.upper(), "a b c d", "a" * 40_000, long_text,
        "ß 漢字  x <|endoftext|> 'tis we're 12 345\r\n\r\n  end  ", "# * $ | < > & %", "line one here\nline one here\n\nline one here",
    ]


@pytest.fixture(scope="session")
def docs(spark):
    """The odd texts, with ids in no order, null in other columns, one row twice, and columns that clash with results."""
    rows = [(7 * i % 16, t, ("en", "de", None)[i % 3], None, None, "x", True) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, rows[5]], DOCS + ", score string, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
