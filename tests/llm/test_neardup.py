import re

import numpy as np
import pytest

from assayworks.llm.components import components
from assayworks.llm.neardup import near_duplicates, superminhash, without_near_duplicates
from tests.llm.conftest import ODD


def brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if label[a] is None or label[b] is None or label[a] == label[b] or not sets[a] or not sets[b]:
                    continue
                if rows[a][0] == rows[b][0] or 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    low, high = sorted((label[a], label[b]))
                    label = [low if x == high else x for x in label]
                    changed = True
    return sorted(((i, len(s), c) for (i, _), s, c in zip(rows, sets, label, strict=True)), key=str)


def edited(rng, words, edits):
    words = list(words)
    for k in rng.integers(0, len(words), edits):
        words[k] = f"x{rng.integers(1 << 30)}"
    return " ".join(words)


@pytest.mark.parametrize("n", [2, 5])
def test_odd_rows_and_groups_of_near_copies(make, n):
    rng = np.random.default_rng(n)
    rows = list(ODD)
    for g in range(6):
        base = [f"w{rng.integers(400)}" for _ in range(int(rng.integers(5, 120)))]
        rows += [(100 * g + 50 + k, edited(rng, base, int(rng.integers(0, 8)))) for k in range(12)]
    rows += [(900, "Same Words here now again"), (901, "same words HERE now again"), (902, "same words here now")]
    found = near_duplicates(make(rows), n, 80).collect()
    assert sorted(((r[0], r[1], r[2]) for r in found), key=str) == brute(rows, n, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_whole_table(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = near_duplicates(documents, 2, 80).collect()
    assert sorted(((r[0], r[1], r[2]) for r in found), key=str) == brute(rows, 2, 80)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    for shared, own in ((800, 100), (500, 250), (40, 5)):
        a, b = pool[: shared + own], np.concatenate([pool[:shared], pool[2000:2000 + own]])
        s = superminhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 1024)
        assert abs((s[0] == s[1]).mean() - shared / (shared + 2 * own)) < 0.06


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(200, k) for k in range(201, 260)] + [(7, 7), (None, 3), (300, 301)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(200, 260), 200), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr("assayworks.llm.components.LINKS_PER_TASK", 5)
    rng = np.random.default_rng(1)
    order = rng.permutation(400)
    links = [(int(order[i]), int(order[i + 1])) for i in range(399) if i % 50]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    for c in range(8):
        part = order[1 + 50 * c: 51 + 50 * c] if c else order[1:51]
        assert {found[int(x)] for x in part} == {int(min(part))}


def test_empty_and_kept_rows(make):
    assert near_duplicates(make([])).count() == 0
    kept = without_near_duplicates(make([(1, "a b c d e f"), (2, "a b c d e f"), (3, "z"), (None, "q"), (4, None)]))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "None"]
