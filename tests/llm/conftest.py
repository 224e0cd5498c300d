from __future__ import annotations

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """A folder for intermediate tables, only where the session names none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (id, text) pairs; languages and sources in turn."""

    def build(rows, extra=None):
        rows = [row if isinstance(row, tuple) else (i, row) for i, row in enumerate(rows)]
        table = [
            (doc_id, text, "en", f"s{i % 4}", None if text is None else len(text))
            for i, (doc_id, text) in enumerate(rows)
        ]
        frame = spark.createDataFrame(table, DOCUMENT)
        for name in extra or ():
            from pyspark.sql import functions as F

            frame = frame.withColumn(name, F.lit("x"))
        return frame

    return build


# Texts every operator must take: null, empty, blank, one word, very long, odd characters, repeats.
ODD = [
    None,
    "",
    " \t\n ",
    "word",
    "One two three four five six seven. One two three four five six seven.",
    "long " * 30_000,
    "x" * 200_000,
    "naïve Ünïcödé – 漢字 🙂   \x1c end",
    "same text here\nwith two lines",
    "same text here\nwith two lines",
]
CLASHING = ("row_key", "rejected", "stays", "found", "size", "highest", "hash", "word", "line", "doc", "key", "print", "label", "task", "shard", "N_Lines", "rank", "item", "h1")
