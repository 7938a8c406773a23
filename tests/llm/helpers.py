"""Small tables with the cases that every operator must bear, and the test tables."""

import os
import re

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows, schema=DOCUMENTS):
    return spark.createDataFrame(rows, schema)


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def sentence(i, n=9):
    """Words that no other number gives."""
    return " ".join(f"w{i}x{j}" for j in range(n)).capitalize() + "."


def prose(i, sentences=12, n=9):
    return " ".join(sentence(f"{i}q{j}", n) for j in range(sentences))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    return [
        document(1, prose("a")), document(1, prose("a")), document(2, prose("a")), document(3, None),
        document(4, ""), document(5, "   \n \n"), document(None, prose("b")), document(None, None, None, None),
        document(6, "?!. ...", None, None), document(7, long), document(8, "One."), document(8, "Other text."),
        document(9, "é" * 50 + " ß İ 漢字 \U0001f600", "de", None),
    ]


def clashing(frame):
    """The table with more columns, named as operators name theirs inside."""
    from pyspark.sql import functions as F

    names = ["key", "hash", "node", "root", "size", "bucket", "n", "words", "host", "text_a", "a", "b", "spans", "lang_pred", "_text", "_n", "score"]
    return frame.select("*", *[F.lit("x").alias(name) for name in names])
