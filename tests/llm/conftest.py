import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, node string, size string, score string, piece string"


def document(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), 7, "node", "size", "score", "piece")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows and ids, special strings, and extra columns of clashing names."""
    words = [f"w{i * 7919 % 1009}x" for i in range(30_000)]
    long = " ".join(words)
    near = words[:400]
    rows = [
        document(0, None),
        document(1, ""),
        document(2, " \n\t "),
        document(3, long),
        document(4, " ".join(near)),
        document(5, " ".join([*near[:200], "CHANGED", *near[201:]])),
        document(6, " ".join(near)),
        document(6, " ".join(near)),
        document(7, "two words", None),
        document(8, "Two  WORDS", None),
        document(9, "a<|endoftext|>b <|endoftext|>", "b"),
        document(10, "\x00\x01 é 漢字 😀 \u00a0x\u2003y", "b"),
        document(None, "no id here at all", "b"),
        document(12, "Released under the MIT License. Licensed under the Apache License, Version 2.0.\nThis is under the GNU General\nPublic License, ok", "c"),
        document(13, "Licensed under the Apachee Licence, Version 2.0", "c"),
        document(14, "!" * 5000, "c"),
        document(15, " ".join(["same"] * 3000), "c"),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
