import pytest

LONG = " ".join(f"w{i}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    text = "One line of words that is long enough to be a line of its own here.\nAnother line follows it, with other words."
    rows = [
        (1, text, "en"), (1, text, "en"),            # a repeated row
        (2, text, None), (None, text, "en"),          # copies; null lang, null id
        (3, None, "de"), (4, "", "de"), (5, " \t\r\n \n", "fr"),
        (6, LONG, "en"), (6, "the same id, another text", "en"),
        (7, "short", "xx"), (8, "12345 +++ 678", "de"),
        (9, "ein Satz auf Deutsch, der länger ist als der kurze Satz davor.", "de"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    # names that the operators use inside
    return df.selectExpr("*", "lang AS source", "1 AS doc_key", "2 AS node", "3 AS s1", "4 AS score", "5 AS __row",
                         "6 AS kept", "7 AS line_no", "8 AS n", "9 AS length", "10 AS tie")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
