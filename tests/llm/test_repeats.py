import re

import numpy as np
import pytest

from assayworks.llm import phrases, repeats, substrings
from assayworks.llm.phrases import without_repeated_passages
from assayworks.llm.substrings import without_repeated_bytes
from assayworks.llm.suffixes import suffix_order
from tests.llm.conftest import ODD


def words_removed(rows, size):
    order = [(1 << 63) - 1 if i is None else i for i, _ in rows]
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for o, w in zip(order, words, strict=True):
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(o, first.get(key, o))
    out = []
    for (i, _), o, w in zip(rows, order, words, strict=True):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < o:
                gone[k:k + size] = True
        out.append((i, len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def bytes_removed(rows, size):
    order = [(1 << 63) - 1 if i is None else i for i, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    first = {}
    for o, b in zip(order, data, strict=True):
        for k in range(len(b) - size + 1):
            first[b[k:k + size]] = min((o, k), first.get(b[k:k + size], (o, k)))
    out = []
    for (i, _), o, b in zip(rows, order, data, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1):
            if first[b[k:k + size]] < (o, k):
                gone[k:k + size] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out, key=str)


def planted(seed):
    rng = np.random.default_rng(seed)
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 300, n))
    passages = [fresh(int(n)) for n in rng.integers(8, 140, 8)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            parts.append(fresh(int(rng.integers(0, 40))))
            passage = passages[int(rng.integers(8))].split(" ")
            if rng.random() < 0.5:
                passage[int(rng.integers(len(passage)))] = "edit"
            parts.append(" ".join(passage))
        rows.append((int(rng.integers(0, 50)), "\n".join(parts) + "  \t"))
    return [*rows, *((i, t) for i, t in ODD if t is None or len(t) < 5000), (70, "again " * 300), (71, "a" * 700 + "é" * 300)]


@pytest.fixture(params=[1 << 20, 3000])
def blocks(request, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", request.param)


@pytest.fixture(params=[1 << 17, 700])
def parts(request, monkeypatch):
    """Parts of texts; the smaller ones cut most texts."""
    monkeypatch.setattr(repeats, "PART_BYTES", request.param)


@pytest.fixture(params=[40, 3])
def common(request, monkeypatch):
    monkeypatch.setattr(repeats, "COMMON_LEAST", request.param)


def test_words_against_brute_force(make, blocks, common, parts):
    rows = planted(1)
    found = without_repeated_passages(make(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == words_removed(rows, 50)


def test_bytes_against_brute_force(make, blocks, common, parts):
    rows = planted(2)
    found = without_repeated_bytes(make(rows)).collect()
    got = sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in found), key=str)
    assert got == bytes_removed(rows, 100)


def test_whole_table(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in without_repeated_passages(documents).collect()), key=str) == words_removed(rows, 50)
    found = without_repeated_bytes(documents).collect()
    assert sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in found), key=str) == bytes_removed(rows, 100)


def test_empty_tables(make):
    assert without_repeated_passages(make([])).count() == 0
    assert without_repeated_bytes(make([])).count() == 0
    assert without_repeated_bytes(make([(1, None), (2, "")])).collect()[0]["n_bytes"] == 0


def test_suffix_order_of_random_strings():
    rng = np.random.default_rng(3)
    strings = [bytes(rng.integers(97, 100, int(n)).astype(np.uint8)) for n in rng.integers(0, 60, 80)] + [b"", b"\0\0a"] * 3
    first = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    owner, offset, lcp = suffix_order(np.frombuffer(b"".join(strings), np.uint8), first)
    expected = sorted((s[k:], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
    assert [strings[i][k:] for i, k in zip(owner, offset, strict=True)] == [e[0] for e in expected]
    assert sorted(zip(owner.tolist(), offset.tolist(), strict=True)) == sorted(e[1:] for e in expected)
    for a, b, n in zip(expected, expected[1:], lcp[1:], strict=False):
        same = next((k for k, (x, y) in enumerate(zip(a[0], b[0], strict=False)) if x != y), min(len(a[0]), len(b[0])))
        assert n == same


@pytest.mark.parametrize("limit", [1, 5])
def test_large_groups_of_an_anchor_are_dealt_by_what_is_beside_it(make, monkeypatch, limit):
    monkeypatch.setattr(phrases, "RUNS_PER_TASK", limit)
    monkeypatch.setattr(substrings, "RUNS_PER_TASK", limit)
    rows = planted(4)
    assert sorted((tuple(r) for r in without_repeated_passages(make(rows)).collect()), key=str) == words_removed(rows, 50)
    found = without_repeated_bytes(make(rows)).collect()
    assert sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in found), key=str) == bytes_removed(rows, 100)


def test_long_odd_texts(make):
    rows = ODD + [(9, "word " * 100 + "other")]
    assert sorted((tuple(r) for r in without_repeated_passages(make(rows)).collect()), key=str) == words_removed(rows, 50)
    found = without_repeated_bytes(make(rows)).collect()
    assert sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in found), key=str) == bytes_removed(rows, 100)


def test_a_text_of_30_mb(spark):
    """A text whose second half repeats the first, and a later one that repeats its middle; all else occurs once."""
    half = spark.range(1).selectExpr("array_join(transform(sequence(1, 1500000), i -> concat('w', lpad(i, 8, '0'))), ' ') AS t")
    docs = half.selectExpr("1L AS doc_id", "concat(t, ' ', t) AS text").union(
        half.selectExpr("2L", "concat('fresh ', substr(t, 7000001, 50000), ' end')"))
    found = {r.doc_id: r for r in without_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()}
    length = 1_500_000 * 10 - 1
    assert tuple(found[1])[1:] == (2 * length + 1, length, 1)
    assert tuple(found[2])[1:] == (50_010, 50_001, 1)
    words = {r.doc_id: r for r in without_repeated_passages(docs).select("doc_id", "n_words", "n_removed").collect()}
    assert tuple(words[1])[1:] == (3_000_000, 0)  # within one document words are not removed
    assert tuple(words[2])[1:] == (5_002, 5_000)
