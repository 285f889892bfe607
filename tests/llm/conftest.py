import pytest

TEXTS = [
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (None, "nameless text of a few words"),
    (6, "tie " * 40),
    (7, "mail a.b@example.com or +1 (212) 555-0153 at 10.0.0.1, card 4111 1111 1111 1111."),
    (7, "mail a.b@example.com or +1 (212) 555-0153 at 10.0.0.1, card 4111 1111 1111 1111."),
    (8, "é ñ ü 漢字 😀 ÀÉ Straße"),
    (9, "long " + " ".join(f"w{i % 977}" for i in range(40_000))),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty, blank and very long texts, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "en", "s", None if t is None else len(t), 0.5, 3, "x") for i, t in TEXTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, count int, fp string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
