"""Tables of odd rows that every operator test uses."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"

#: Extra columns whose names operators compute themselves.
CLASHING = ["keep_id", "group_size", "kept", "fp", "score", "part", "h", "blob", "start", "offset", "sequence_id", "label", "member", "key", "n"]

ROWS = [
    (1, "Alpha beta gamma delta. Alpha beta!"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "Alpha  beta gamma\tdelta. Alpha beta!"),
    (5, "Alpha  beta gamma\tdelta. Alpha beta!"),
    (None, "text of a row without id"),
    (6, "x" * 200_000),
    (7, "word and more " * 20_000),
    (8, "日本語 テキスト 👍 é́"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, ties and clashing extra columns."""
    schema = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    rows = [(i, t, "en" if i != 8 else None, None if t is None else len(t), *(["x"] * len(CLASHING))) for i, t in ROWS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (3, 0, 1), (5, 1, None), (None, 0, 0), (6, None, 1), (8, 1, 0), (99, 0, 1), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(odd_labels):
    return odd_labels.limit(0)
