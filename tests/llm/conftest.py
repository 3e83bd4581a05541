import pytest

SF001 = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i % 977} passage{i % 31}" for i in range(60_000))  # about 1 MB

# doc_id, text: repeats, ties, NULLs, empty and very long texts
EDGE = [
    (1, "the same text here, word for word"),
    (2, "the same text here, word for word"),
    (2, "the same text here, word for word"),
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (None, "no id at all"),
    (None, "the same text here, word for word"),
    (7, LONG),
    (8, LONG),
    (9, LONG[: len(LONG) // 2] + " something else " + LONG[len(LONG) // 2 :]),
    (10, "Grüße aus München — ein längerer Satz mit Umlauten, damit Bytes und Zeichen verschieden sind"),
    (-11, "short"),
    (9_223_372_036_854_775_807, "short"),
]
CLASHING = "_text string, _hash string, row string, slot bigint, score double, id string, near boolean, key string, `a.b` int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, "en" if n % 3 else None, f"src{n % 4}" if n % 5 else None, len(t or ""), *["x"] * 3, n, 0.5, "y", True, "z", n) for n, (i, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def same_rows(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))
