import os
import re

import pytest

SF_DIR = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")

DOC = "doc_id long, text string, lang string, score double, label int, `key` string"


@pytest.fixture(scope="module")
def make(spark):
    """Documents from (doc_id, text) with extra columns whose names clash with the operators' own."""
    def build(rows):
        return spark.createDataFrame([(i, t, None, None, 1, "k") for i, t in rows], DOC)

    return build


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


ODD = [(1, None), (2, ""), (3, "  \t\n "), (None, "a null id and some text"), (4, "short"), (4, "short"),
       (5, "ÄÖ é x \U0001f600 " * 30), (6, "word " * 20000)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
