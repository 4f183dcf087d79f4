import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from assayworks.llm import golay, simhash
from assayworks.llm.components import components
from assayworks.llm.queries import LLM_QUERIES
from assayworks.llm.shared import written
from tests.llm.conftest import ODD, words_of


def flipped(mark, bits):
    for b in bits:
        mark ^= 1 << b
    return mark


def grouped(marks, distance=3):
    """Least member of the connected part of every fingerprint, by comparing all pairs."""
    array = np.array(marks, np.uint64)
    part = {m: m for m in marks}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, m in enumerate(marks):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ array[i]) <= distance).tolist():
            a, b = root(m), root(marks[i + 1 + j])
            part[max(a, b)] = min(a, b)
    return {m: root(m) for m in marks}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_golay_code_is_perfect():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    check, _ = golay.tables()
    code = np.arange(1 << 12) << 11 | check
    assert int(np.bitwise_count(code[1:].astype(np.uint64)).min()) == 7
    best = np.bitwise_count((words[:, None] ^ code).astype(np.uint64))
    assert (best.min(1) <= 3).all() and (best.argmin(1) == golay.nearest(words)).all()
    messages, places = golay.nearby(words)
    assert set(np.bincount(places).tolist()) <= {1, 6}
    for b in range(23):  # one side gives one codeword, the other those around it
        near = golay.nearest(words ^ (1 << b))
        assert all(near[i] in messages[places == i] for i in range(0, 500, 25))


@pytest.mark.parametrize("size", [1, 2, 3])
def test_every_near_pair_shares_a_key(size):
    rng = random.Random(size)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = flipped(a, rng.sample(range(64), size))
        keys, sides, marks = simhash.keys_of(np.array([a, b], np.uint64))
        met = {}
        for k, s, m in zip(keys.tolist(), sides.tolist(), marks.tolist(), strict=True):
            met.setdefault(k, set()).add((s, m))
        fits = [v for v in met.values() if len({m for _, m in v}) == 2 and {s for s, _ in v} in ({2}, {0, 1})]
        assert fits


def cluster(rng, size, unstable):
    base, out = rng.getrandbits(64), set()
    bits = rng.sample(range(64), unstable)
    while len(out) < size:
        out.add(flipped(base, [b for b in bits if rng.random() < 0.5]))
    return out


@pytest.mark.parametrize("bucket", [64, 4, 0])
def test_components_match_brute_force(spark, bucket):
    rng = random.Random(7)
    marks = cluster(rng, 150, 9) | cluster(rng, 60, 30) | cluster(rng, 120, 14) | {rng.getrandbits(64) for _ in range(100)} | {0}
    for a in list(marks)[:120]:
        marks.add(flipped(a, rng.sample(range(64), rng.randrange(1, 6))))
    marks = sorted(marks)
    table = spark.createDataFrame([(signed(m),) for m in marks], "mark long")
    found = {r.node: r.component for r in components(simhash.linked(table, bucket)).collect()}
    parts = {}
    for m, p in grouped(marks).items():
        parts.setdefault(p, []).append(signed(m))
    want = {m: min(p) for p in parts.values() if len(p) > 1 for m in p}
    assert found == want


def test_dense_clusters_make_links_in_proportion(spark):
    """All fingerprints of a cluster share keys. All pairs would be half a million and two million; each has some links instead."""
    for size in (1000, 2000):
        marks = sorted(cluster(random.Random(size), size, 13))
        array = np.array(marks, np.uint64)
        close = sum(int((np.bitwise_count(array[i + 1:] ^ array[i]) <= 3).sum()) for i in range(size))
        made = simhash.linked(spark.createDataFrame([(signed(m),) for m in marks], "mark long"), 16).count()
        assert made < 65 * size and made < close


@pytest.fixture
def planned(monkeypatch):
    """Labels and plans, as Spark sizes them before it runs, of all tables that the operator writes."""
    plans = []

    def recorded(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, label)

    monkeypatch.setattr("assayworks.llm.simhash.written", recorded)
    monkeypatch.setattr("assayworks.llm.components.written", recorded)
    return plans


def broadcasts(plans):
    return [label for label, plan in plans if "Broadcast" in plan]


def test_hubs_and_links_are_not_broadcast(spark, planned, monkeypatch):
    """A fingerprint makes 2,081 rows that Spark sizes as one: a few thousand would fill the driver."""
    monkeypatch.setattr("assayworks.llm.components.LINKS_PER_TASK", 50)
    rng = random.Random(3)
    marks = sorted(cluster(rng, 80, 10) | cluster(rng, 80, 30) | {rng.getrandbits(64) for _ in range(50)})
    found = {r.node: r.component for r in components(simhash.linked(spark.createDataFrame([(signed(m),) for m in marks], "mark long"), 4)).collect()}
    parts = {}
    for m, p in grouped(marks).items():
        parts.setdefault(p, []).append(signed(m))
    assert found == {m: min(p) for p in parts.values() if len(p) > 1 for m in p}
    assert {"simhash-rest", "proper", "stars"} <= {label for label, _ in planned}
    assert broadcasts(planned) == []


def brute(rows):
    marks = {}
    for doc_id, text in rows:
        words = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        marks.setdefault(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)), []).append(doc_id)
    part = grouped(sorted(marks))
    least = {}
    for m, p in part.items():
        least.setdefault(p, []).extend(i for i in marks[m] if i is not None)
    return sorted(((i, f"{m:016x}", min(least[part[m]], default=None)) for m, ids in marks.items() for i in ids), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_near_duplicates_match_brute_force(spark, make, tmp_path):
    rng = random.Random(2)
    base = [[rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(150)] for _ in range(5)]
    rows = list(ODD) + [(None, None), (50, "A  b"), (51, "a b"), (52, "a b c")]
    for i in range(60):
        words = list(base[i % 5])
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(150)] = "x"
        rows.append((100 + i, " ".join(words)))
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert collected(LLM_QUERIES["op11_simhash_near_dedup"](spark, str(tmp_path))) == brute(rows)
    assert collected(simhash.near_duplicates(make([]))) == []
    lone = make([(None, "only null ids here")])
    assert simhash.near_duplicates(lone).collect()[0].component_id is None


def test_keys_are_not_broadcast(make, planned):
    """A fingerprint makes some forty keys that Spark sizes as one: 0.6 GB of documents made eleven million rows, 1 GB of a broadcast."""
    rows = [(i, " ".join(f"{c}{i // 2}" for c in "abcdefghijklmnopqrstuvwxyz" * 8) + " x" * (i % 2)) for i in range(40)]
    found = simhash.near_duplicates(make(rows))
    assert collected(found) == brute(rows)
    planned.append(("result", found._jdf.queryExecution().executedPlan().toString()))
    assert {"simhash-members", "simhash-links", "result"} <= {label for label, _ in planned}
    assert broadcasts(planned) == []


def test_fingerprints_equal_sparks_own_hash(spark, documents):
    """Spark's xxhash64 is XXH64 with seed 42, so built-in functions can do the same count."""
    some = documents.filter("length(text) < 3000")
    words = F.filter(F.split(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]+"),
                     lambda w: w != "")
    hashed = some.select("doc_id", words.alias("w")).filter("size(w) >= 3").selectExpr(
        "doc_id", "explode(transform(sequence(1, size(w) - 2), i -> xxhash64(array_join(slice(w, i, 3), ' ')))) AS h")
    bits = hashed.groupBy("doc_id").agg(*[
        F.when(2 * F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))) > F.count("h"), F.lit(signed(1 << b))).otherwise(F.lit(0)).cast("long").alias(f"b{b}")
        for b in range(64)])
    total = bits.select("doc_id", sum((F.col(f"b{b}") for b in range(1, 64)), F.col("b0")).alias("want"))
    met = simhash.fingerprints(some).join(total, "doc_id")
    assert met.count() > 100 and met.filter("fingerprint <> want").count() == 0
