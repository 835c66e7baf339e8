"""Edge rows that every corpus operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, value string, key long"


def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 977} and then{i % 31}." for i in range(9_000))
    rows = [
        (1, "The cat sat on the mat. It was a good day for all of them.", "en", "src0", 58, "v", 1),
        (1, "The cat sat on the mat. It was a good day for all of them.", "en", "src0", 58, "v", 1),
        (2, None, "en", "src1", None, None, None),
        (3, "", None, None, 0, "x", 2),
        (4, "   \n\t ", "de", "src0", 6, "x", 2),
        (None, "Der Hund und die Katze sind im Haus und nicht im Garten.", "de", "src2", 56, "x", 3),
        (None, None, None, None, None, None, None),
        (5, long_text, "en", "src0", len(long_text), "x", 3),
        (6, "!!! ### 123", "en", None, 11, "x", 3),
        (7, "Der Hund und die Katze sind im Haus und nicht im Garten.", "de", "src2", 56, "x", 3),
        (8, "Released under the MIT License.", None, "src1", 31, "x", 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)
