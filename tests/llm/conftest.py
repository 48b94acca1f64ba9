import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from rows (doc_id, text, lang, source)."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls in any column, empty, long and repeated texts, and columns with clashing names."""
    prose = "the quick brown fox jumps over the lazy dog and runs far away from here today. "
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n ", None, "a"),
        (None, prose * 8, "en", None),
        (None, None, None, None),
        (4, prose * 8, "en", "a"),
        (4, prose * 8, "en", "a"),
        (5, prose * 4000, "en", "b"),
        (6, "x" * 200_000, "en", "b"),
        (7, "ünï cödé 😀 " * 30, "de", "c"),
        (8, "one", "en", "c"),
        (9, "\x00 \x85   ﻿", "fr", "c"),
    ]
    clash = "size key span target taken kept score good n evidence site bands set_id id rank cut copies length".split()
    return docs(rows).withColumns({c: F.lit("own") for c in clash})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs([])
