"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import pytest

SF_DIR = "/root/testdata/sf0.001"
BASE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree in the quiet forest at night"


def texts():
    words = BASE.split()
    near = words[:]
    near[-1] = "dawn"
    return [
        (1, BASE, "en", "a"),
        (2, BASE, "en", "b"),
        (3, "  ".join(words), "en", "a"),
        (4, " ".join(near * 4), "en", None),
        (5, " ".join((near * 4)[:-1] + ["noon"]), "en", "a"),
        (6, None, None, "a"),
        (7, "", "en", "a"),
        (8, " \t\n ", "en", "c"),
        (9, "two words", "en", "a"),
        (10, "TWO Words", "en", "a"),
        (11, "x" * 70_000, "en", "a"),
        (12, " ".join(f"w{i}" for i in range(9000)), "fr", "a"),
        (13, "line one\nline one\nline one\nline two\n\nÄÖÜ straße Σ", "de", "d"),
        (14, "### $$$ *** && | <a> " * 30, "en", "a"),
        (None, "row without an id", "en", "a"),
        (15, 'set token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" now', "en", "a"),
        (16, "Released under the MIT License. Licensed under CC BY-NC 4.0.", "en", "a"),
        (9, "two words", "en", "a"),
    ]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(*r, len(r[1] or ""), f"m{n}", n, "x") for n, r in enumerate(texts())]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, measures string, digest int, _copies string"
    return spark.createDataFrame(rows, kind).repartition(3)


@pytest.fixture(scope="module")
def no_documents(documents):
    return documents.limit(0)
