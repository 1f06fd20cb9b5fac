"""Small tables for the operators' edge cases."""

import re

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, id string, key string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows; clashing extra columns are in the schema."""
    long = "wörd number " * 30_000
    return [
        (1, "", "en", "a", 0, 7, "x", "y"),
        (2, None, None, None, None, None, None, None),
        (None, "a null id has text too, and it is long enough to matter", "en", "a", 1, 1, "x", "y"),
        (3, long, "en", "b", 1, 1, "x", "y"),
        (4, "the same words stand here twice in one table of rows", "en", "a", 1, 1, "x", "y"),
        (5, "the same words stand here twice in one table of rows", "fr", None, 1, 1, "x", "y"),
        (5, "the same words stand here twice in one table of rows", "fr", None, 1, 1, "x", "y"),
        (6, "1234 5678 !!! ²", "de", "a", 1, 1, "x", "y"),
        (7, "\n\n\t 　", "de", "a", 1, 1, "x", "y"),
        (8, "\U0001f600 emoji é à ü and password = \"Tr0ub4dor&3x\" in one line\nand another line of it here", "es", "c", 1, 1, "x", "y"),
    ]


def docs_of(spark, rows=None, empty=False):
    return spark.createDataFrame([] if empty else rows if rows is not None else odd_rows(), DOC_SCHEMA)


def real_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
