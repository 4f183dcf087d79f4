from collections import defaultdict

from pyspark.sql import functions as F

from assayworks.llm.exact import exact_duplicates, without_exact_duplicates
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").translate(LOWER)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep))
    return sorted(out, key=str)


def found(frame, **options):
    return sorted((tuple(r)[:4] for r in exact_duplicates(frame, **options).collect()), key=str)


def test_odd_rows_and_ties(make):
    rows = [*ODD, (7, "SHORT"), (8, "Éa"), (9, "éa"), (10, "")]
    assert found(make(rows)) == brute(rows)


def test_colliding_digests_are_told_apart_by_content(make):
    rows = [(i, f"text {i % 7}") for i in range(60)] + [(100, None)]
    weak = lambda content: F.encode((F.length(content) % 2).cast("string"), "utf-8")
    assert found(make(rows), digest=weak) == brute(rows)


def test_whole_table(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == brute(rows)


def test_empty_and_kept_rows(make):
    assert found(make([])) == []
    kept = without_exact_duplicates(make([(1, "a"), (2, "A"), (2, "A"), (3, "b")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3] and "score" in kept.columns


def test_rows_of_one_id_stay_or_go_by_their_texts(make):
    rows = [(None, "only here"), (None, "A text"), (3, "a text"), (3, "of nine"), (9, "OF NINE"), (None, "of nine"), (None, "Only here")]
    kept = sorted(((r["doc_id"], r["text"]) for r in without_exact_duplicates(make(rows)).collect()), key=str)
    assert kept == sorted([(None, "only here"), (None, "Only here"), (3, "a text"), (9, "OF NINE")], key=str)
