import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from assayworks.llm.queries import LLM_QUERIES
from assayworks.llm.runs import maximal_runs, periodic_runs, possible
from assayworks.llm.suffixtree import SuffixTree
from tests.llm.conftest import ODD, words_of


def brute_runs(words, repeats=4, least=6):
    n, found = len(words), set()
    for q in range(1, n // 2 + 1):
        start = 0
        while start + q < n:
            if words[start] != words[start + q]:
                start += 1
                continue
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            length = stop + q - start
            smaller = any(all(words[i] == words[i + p] for i in range(start, start + length - p)) for p in range(1, q))
            if length >= max(least, repeats * q) and not smaller:
                found.add((start, length, q))
            start = stop + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(count, seed=3):
    rng = random.Random(seed)
    for _ in range(count):
        n = rng.randrange(0, 60)
        words = [rng.randrange(1, rng.choice([2, 3, 5, 30]) + 1) for _ in range(n)]
        if n > 4 and rng.random() < 0.7:
            a, p = rng.randrange(n), rng.randrange(1, 9)
            words = [words[i] if i < a else words[min(n - 1, a + (i - a) % p)] for i in range(n)] + words[:rng.randrange(9)]
        yield words


def test_extensions_and_ranks():
    for words in sequences(150):
        s = np.array(words, np.int64)
        tree = SuffixTree(s, 40)
        suffixes = [tuple(words[i:]) for i in range(len(words) + 1)]
        assert tree.ranks().tolist() == [sorted(suffixes).index(x) for x in suffixes]
        turned = [tuple(-w for w in x) for x in suffixes]
        assert tree.ranks(True).tolist() == [sorted(turned).index(x) for x in turned]
        pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words) + 1)]
        if pairs:
            a, b = np.array(pairs).T
            same = [next((k for k in range(len(words) - j) if words[i + k] != words[j + k]), len(words) - j) for i, j in pairs]
            assert tree.extension(a, b).tolist() == same


@pytest.mark.parametrize("repeats,least", [(4, 6), (2, 2), (3, 5)])
def test_runs_match_brute_force(repeats, least):
    for words in sequences(400):
        runs = maximal_runs(np.array(words, np.int64), repeats, least)
        assert [tuple(r) for r in runs.tolist()] == brute_runs(words, repeats, least)


def test_every_run_lies_in_one_possible_stretch():
    for words in sequences(400, seed=5):
        n = len(words)
        maybe = possible(np.array(words, np.int64), np.zeros(n, np.int64), np.full(n, n), 4, 6)
        for start, length, _ in brute_runs(words):
            assert maybe[start:start + length].all()


def expected(doc_id, text):
    words = words_of(text)
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_matches_brute_force(spark, tmp_path, make):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["ab", "c", "Dé", "x"][:rng.randrange(1, 5)]) for _ in range(rng.randrange(0, 50))))
            for i in range(300)]
    rows += [(i, t) for i, t in ODD if not t or len(t) < 9000] + [(7, "a b a b a b a b a b"), (7, "a b a b a b a b a b")]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    result = LLM_QUERIES["op12_periodic_runs"](spark, str(tmp_path)).select(*COLUMNS).collect()
    want = sorted((expected(i, t) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in result), key=str) == want
    assert any(r[1] for r in want)


def test_long_texts_and_empty_table(spark, make):
    one = "word " * 200_000
    two = " ".join(f"w{i % 70_001}" for i in range(300_000))
    three = " ".join(str(i) for i in range(400_000))
    got = {r[0]: r for r in periodic_runs(make([(1, one), (2, two), (3, three)])).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 200_000, 1)] and bytes(got[1].collapsed) == b"word"
    assert [tuple(x) for x in got[2].runs] == [(0, 300_000, 70_001)] and len(words_of(got[2].collapsed.decode())) == 70_001
    assert got[3].runs == [] and got[3].collapsed.decode() == three
    assert periodic_runs(make([])).collect() == []
