import public_tokenizers
import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    long_text = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    body = "\n".join(f"line {i} of a passage that is shared between many documents" for i in range(8))
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, long_text), (7, long_text), (8, body),
        (9, body + "\nand a line of its own"), (9, body + "\nand a line of its own"), (10, "Zürich <|endoftext|> 東京  two  spaces \n"),
        (None, "no id here at all"), (None, None), (11, body), (5, "another text under an id that is taken"),
    ]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    return frame.selectExpr("*", "1 AS __row", "'x' AS n_words", "2 AS shard", "3 AS score", "4 AS cid", "5 AS `a.b`")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
