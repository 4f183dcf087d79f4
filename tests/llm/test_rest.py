import random
import re
import uuid
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from assayworks.llm import decontaminate, quality, secrets, shards, urls
from assayworks.llm.queries import LLM_QUERIES
from tests.llm.conftest import ODD, SF_DIR
from tests.oracle import connection, differences

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


@pytest.mark.parametrize("name", sorted(k for k in LLM_QUERIES if k in oracle_sql()))
def test_sql(spark, name):
    assert differences(spark, connection(SF_DIR), name, SF_DIR) == []


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in queries() if re.match(r"op\d+_", n)} == set(range(1, 14))


# --- URLs


def test_rules_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(urls, "ROWS_PER_RANGE", 7)
    hosts = ["a.org", "org", "x.a.org", "b.com", "xorg", "deep.x.a.org", "", "A.ORG", "a.org.", "a.org:80"]
    pages = [(i, f"http{'s' * (i % 2)}://{hosts[i % 10]}{['', '/', '/en/1', '/en/12?x', '#f', '?q', '/fr/'][i % 7]}")
             for i in range(140)] + [(None, None), (500, "no url"), (501, "://"), (501, "://"), (502, "x://y://org/")]
    pages += [(600 + i, "http://hot.a.org/en/1") for i in range(60)]
    rules = [("org", "/", "allow"), ("a.org", "/en/1", "block"), ("x.a.org", None, "block"), ("com", "/fr/", "block"),
             (None, "/", "block"), ("org", "/", "allow")]
    found = urls.apply_rules(spark.createDataFrame(pages, "id long, url string"),
                             spark.createDataFrame(rules, "host string, path string, verdict string"), "id", "url", "open")
    expected = []
    for i, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(h + (p or "")), len(h), v == "allow", h + (p or ""), v) for h, p, v in rules if h is not None
                and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
        best = max(fits, default=None)
        expected.append((i, host, path, best and best[3], best[4] if best else "open"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_no_pages_and_no_rules(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b")], "id long, url string")
    assert urls.apply_rules(pages, rules, "id", "url", "open").collect() == [(1, "a", "/b", None, "open")]
    assert urls.apply_rules(pages.limit(0), rules, "id", "url", "open").count() == 0


# --- secrets


def test_spans_against_brute_force(spark, make):
    rows = [*ODD, (20, 'é \U0001f600 TOKEN = "abcdefgh12" and Api_Key:short password:  secret=abcdefghijk'),
            (21, "AKIA1234567890ABCD AKIAshort " + "0123456789abcdef" * 3 + "G abc" + "f" * 31), (22, "x" * 50),
            (23, 'passwd="a.b-c_d+e/f=="'), (24, "token=secret:abcdefghijkl")]
    tables = secrets.fit_markov(secrets.training_strings(make(rows)))
    for r in secrets.secret_spans(make(rows), tables).collect():
        text = [t for i, t in rows if i == r["doc_id"]][0] or ""
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        assert [tuple(s) for s in r["base"]] == sorted(spans)
    assert secrets.secret_spans(make([]), tables).count() == 0


def test_models_learn_from_every_document(spark, make):
    rows = [(i, f"ordinary sentence {chr(97 + i) * 8}{chr(98 + i) * 3} key{i}: token=abc{i:02}defghijklmnopq" + "0f" * (16 + i))
            for i in range(20)] + [r for r in ODD if not r[1] or len(r[1]) < 5000] + [(90, "see /a/path/2024-01-02 and ======== or x_9")]
    expected = set()
    for _, text in rows:
        found = [m[1] for m in re.finditer(r"(?:token)=([A-Za-z0-9+/_.=-]+)", text or "")] + re.findall("[0-9a-f]{32,}", text or "")
        expected |= {(secrets.RANDOM, v) for v in found if len(v) >= 16 and re.search("[0-9]", v)}
        rest = re.sub("[0-9a-f]{32,}", " ", re.sub(r"(?:token)=[A-Za-z0-9+/_.=-]+", " ", text or ""))
        expected |= {(secrets.TEXT, m) for m in re.findall(r"[A-Za-z0-9+/_=-]{8,}", rest)}
    strings = {tuple(r) for r in secrets.training_strings(make(rows)).collect()}
    samples = {tuple(r) for r in secrets._samples(spark).collect()}
    assert strings == expected | samples and len(samples) == 2 * secrets.SYNTHETIC + len(secrets.TECHNICAL_STRINGS)
    assert (secrets.TEXT, "/a/path/2024-01-02") in strings and (secrets.TEXT, "========") in strings
    tables, n = secrets.fit_markov(secrets.training_strings(make(rows))), len(secrets.ALPHABET)
    counts = {k: np.zeros((n, n)) for k in (secrets.TEXT, secrets.RANDOM, secrets.TECHNICAL)}
    for label, string in strings:
        for a, b in zip(string, string[1:]):
            counts[label][secrets.ALPHABET.find(a), secrets.ALPHABET.find(b)] += "." not in a + b
    logs = {k: np.array(secrets._logs(c.tolist())) for k, c in counts.items()}
    plain = np.maximum(logs[secrets.TEXT], logs[secrets.TECHNICAL])
    assert len(tables) == 3 and tables[0] == pytest.approx((logs[secrets.RANDOM] - plain).ravel())


def test_models_find_random_strings_and_leave_ordinary_ones(spark):
    """Rates over planted keys and over ordinary strings of many shapes, and the spans that the query's data get from the models."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    drawn = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    words = ("the quick brown fox jumps over a lazy dog while news from article about world index main user page static image header "
             "footer react server data test").split()
    some = lambda low, high: [rng.choice(words) for _ in range(rng.randrange(low, high))]
    date = lambda sep: f"{rng.randrange(1990, 2030)}{sep}{rng.randrange(1, 13):02}{sep}{rng.randrange(1, 29):02}"
    keys = {"letters and digits": [drawn(letters, rng.randrange(20, 60)) for _ in range(200)],
            "base64": [drawn(letters + "+/", rng.randrange(30, 60)) for _ in range(200)]}
    ordinary = {
        "uuid": [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(200)], "ruler": [c * n for c in "=-/_+" for n in range(20, 100)],
        "slug": ["-".join(some(6, 12)) for _ in range(200)], "path": ["/".join([*some(1, 3), date("/"), "-".join(some(4, 8))]) for _ in range(200)],
        "snake": ["_".join(some(6, 12)) for _ in range(200)], "constant": ["_".join(some(6, 12)).upper() for _ in range(200)],
        "dates": [f"{date('-')}/{date('-')}" for _ in range(200)], "number": [drawn("0123456789", rng.randrange(20, 40)) for _ in range(200)],
        "given": ["a/2024/01/15/some-long-article-slug-for-news-2024", "//example.org/static/img/2019/07/header-background-large",
                  "node_modules/react-dom/cjs/react-dom-server"]}
    strings = [(kind, x) for group in (keys, ordinary) for kind, found in group.items() for x in found]
    planted = spark.createDataFrame([(10_000 + i, f"it is {x} here") for i, (_, x) in enumerate(strings)], "doc_id long, text string")
    model = secrets.fit_markov(secrets.training_strings(documents))
    found = {r["doc_id"]: r["found"] for r in secrets.secret_spans(documents.select("doc_id", "text").union(planted), model).collect()}
    share = {}
    for i, (kind, x) in enumerate(strings):
        share.setdefault(kind, []).append(any((s["start"], s["end"], s["kind"]) == (6, 6 + len(x), 3) for s in found[10_000 + i]))
    rates = {kind: float(np.mean(flags)) for kind, flags in share.items()}
    assert all(rates[kind] >= 0.95 for kind in keys), rates
    assert all(rates[kind] < 0.01 for kind in ordinary), rates
    assert sum(any(s["kind"] == 3 for s in v) for i, v in found.items() if i < 10_000) <= 1


# --- shards


def test_sizes_slots_and_groups(spark, make):
    rng = np.random.default_rng(2)
    rows = [*ODD, *((100 + i, "y" * int(rng.integers(1, 900))) for i in range(1500)),
            *((3000 + i, f"group {i % 90} " * 9) for i in range(600)), *((5000 + i, "hot text " * 20) for i in range(1500))]
    nodes = shards.document_nodes(make(rows))
    table = shards.balanced_shards(nodes, None, 6).toPandas()
    assert len(table) == len(rows)
    for _, part in table.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    load = table.groupby("shard")["size"].sum()
    assert len(load) == 6 and load.max() - load.min() <= 0.01 * load.mean() + 1_000
    small = table[(table.doc_id >= 3000) & (table.doc_id < 5000)].copy()
    small["grp"] = small.grp.map(bytes)
    assert (small.groupby("grp").shard.nunique() == 1).mean() > 0.9
    sizes = {(None if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows}
    got = {(None if pd.isna(r.doc_id) else int(r.doc_id), r.size_, r.text_crc32)
           for r in table.rename(columns={"size": "size_"}).itertuples()}
    assert got == sizes


def test_given_links_and_empty_table(spark, make):
    nodes = spark.createDataFrame([(i, 10) for i in range(60)], "node long, size long")
    links = spark.createDataFrame([(i, i - i % 5) for i in range(60) if i % 5], "a long, b long")
    table = shards.balanced_shards(nodes, links, 3).toPandas()
    where = dict(zip(table.node, table.shard, strict=True))
    assert sum(where[i] != where[i - i % 5] for i in range(60)) <= 16
    assert sorted(table.groupby("shard").size()) == [20, 20, 20]
    assert shards.balanced_shards(shards.document_nodes(make([])), None, 4).count() == 0


# --- quality


def test_held_out_accuracy(spark):
    found = queries()["op9_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = found[found.held_out].merge(truth, on="doc_id")
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95
    assert found.score.between(0, 1).all() and ((found.score >= 0.7) == (found.predicted == 1)).all()


def test_odd_texts_single_class_and_no_labels(spark, make):
    docs = make(ODD)
    for rows in ([], [(4, 1, 0)], [(4, 0, 0)], [(4, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (99, 0, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        scored = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
        assert len(scored) == len(ODD) and all(0 <= r["score"] <= 1 for r in scored)
        kept = quality.accepted(docs, quality.fit_quality(docs, labels))
        assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in scored)


def test_all_labelled_rows_and_all_pairs(spark):
    rng = np.random.default_rng(4)
    said = [" ".join(("WIN$$", "free", "the", "paper", "holds")[k] for k in np.minimum(4, rng.integers(0, 3 + good, 1 + i % 7) + good))
            for i, good in enumerate([0] * 4400 + [1] * 4300)]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i >= 4400)) for i in range(len(said))], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    x = np.array([r["features"] for r in quality._featured(docs, "text", ["doc_id"]).orderBy("doc_id").collect()])
    wide = quality.expanded(x)
    assert np.allclose(model.mean, wide.mean(0), atol=1e-9)  # all rows of both classes
    z = (wide - model.mean) / model.scale
    score, good = z @ model.weights, np.arange(len(said)) >= 4400
    wrong = 1 / (1 + np.exp(score[good][:, None] - score[~good][None, :]))
    slope = (wrong.mean(0) @ z[~good]) / (~good).sum() - (wrong.mean(1) @ z[good]) / good.sum() + quality.PENALTY * model.weights
    assert np.abs(slope).max() < 3e-4
    order, share = np.sort(score), 4400 / len(said)
    weight = np.cumsum(np.where(good, (1 - share) / good.sum(), share / (~good).sum())[np.argsort(score)])
    high = order[np.searchsorted(weight, share - 1e-12)]
    assert order[order < high - 1e-9].max() - 1e-9 < model.cut < high + 1e-9


def test_pipeline_learns_from_all_labels(spark, folder, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i} " * (1 + i % 9)) for i in range(8600)], "doc_id long, text string")
    spark.createDataFrame([(i, int(i % 9 > 3 or i > 8400)) for i in range(8600)], "doc_id long, quality int").repartition(
        3).write.parquet(f"{folder}/labels.parquet")
    models = []
    monkeypatch.setattr(quality, "accepted", lambda frame, model: models.append(model) or frame)
    assert corpus_pipeline.good_quality(spark, docs, folder).count() == 8600
    x = np.array([r["features"] for r in quality._featured(docs, "text", ["doc_id"]).collect()])
    assert np.allclose(models[0].mean, quality.expanded(x).mean(0), atol=1e-9)


def test_pipeline_learns_from_every_text_of_an_id(spark, folder, monkeypatch):
    said = [(i % 40, f"w{i} " * (1 + i % 11)) for i in range(400)] + [(3, None), (5, "UP down."), (5, "up Down.")]
    twice = [*said, *said[:30], (3, ""), (None, "no id"), (77, "no label")]
    docs = spark.createDataFrame(twice, "doc_id long, text string").repartition(4)
    labels = [(i, int(i % 3 > 0)) for i in range(40)]
    spark.createDataFrame([*labels, *labels[:5], (7, 0), (None, 1), (8, None), (99, 1)], "doc_id long, quality int").write.parquet(
        f"{folder}/labels.parquet")
    models = []
    monkeypatch.setattr(quality, "accepted", lambda frame, model: models.append(model) or frame)
    assert corpus_pipeline.good_quality(spark, docs, folder).count() == len(twice)
    once = spark.createDataFrame([*said, *(row for row in said if row[0] == 7)], "doc_id long, text string")  # 7 is in both classes
    x = np.array([r["features"] for r in quality._featured(once, "text", ["doc_id"]).collect()])
    assert np.allclose(models[0].mean, quality.expanded(x).mean(0), atol=1e-9)


# --- decontamination


def test_copies_and_edited_copies(spark, make):
    rng = np.random.default_rng(3)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 500, n))
    items = [(i, say(30)) for i in range(20)] + [(50, None), (None, "x y z"), (51, "one two"), (3, "")]
    rows = list(ODD)
    for i in range(20):
        words = items[i][1].split(" ")
        edited = [w if k % 10 else "edit" for k, w in enumerate(words)]
        rows += [(100 + i, say(80) + ' "' + items[i][1].upper() + '!" ' + say(60)), (200 + i, say(20) + " " + " ".join(edited)),
                 (300 + i, say(150)), (400 + i, " ".join(words[:6]) + " " + say(50))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.SEEDS_PER_BLOCK, 60):
        found = decontaminate.contaminated(make(rows), bench).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == {(b + i, i) for i in range(20) for b in (100, 200)}
        assert all(r["score"] == 1 for r in found if r["doc_id"] < 200) and block
    kept = decontaminate.without_benchmark(make(rows), bench)
    assert kept.count() == len(rows) - 40


def test_every_fourth_word_replaced_and_words_put_in(spark, make):
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in (11, 15, 20, 30, 40, 59)]
    rows, expected = [(1, "some other words " * 40)], set()
    for n, text in items:
        words = text.split(" ")
        for phase in range(4):
            edited = ["edit" if k % 4 == phase else w for k, w in enumerate(words)]
            if decontaminate.aligned(np.array([hash(w) for w in words]), np.array([hash(w) for w in edited]))[0] >= 0.6:
                expected.add((10 * n + phase, n))
            rows.append((10 * n + phase, "before it " * 30 + " ".join(edited) + " after it" * 30))
        # A word put in after every second word leaves no 3-gram.
        rows.append((10 * n + 5, " ".join(w + " more" * (k % 2) for k, w in enumerate(words))))
        expected.add((10 * n + 5, n))
    assert {(10 * n + p, n) for n in (20, 30, 40, 59) for p in (0, 1, 2)} <= expected
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(make(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected


def edited(rng, words):
    """Some words kept, replaced, left out, or with others put in behind them."""
    out, odds = [], rng.dirichlet([8, 1, 1, 1])
    for w in words:
        kind = rng.choice(4, p=odds)
        out += [w] * (kind in (0, 3)) + [f"w{rng.integers(0, 60)}"] * (kind in (1, 3))
    return out


def aligned_pairs(rows, items):
    """What is found when every document is aligned with every item."""
    code = {}
    coded = lambda text: np.array([code.setdefault(w, len(code)) for w in text.split()])
    return {(d, i) for d, text in rows for i, item in items if decontaminate.aligned(coded(item), coded(text))[0] >= 0.6}


@pytest.mark.parametrize("n", [1, 2, 3])
def test_edited_items_against_alignments_of_all(spark, make, n):
    rng = np.random.default_rng(5)
    items = [(k, " ".join(f"w{x}" for x in rng.integers(0, 60, 14 + k))) for k in range(20)]
    rows = [(d, " ".join(["w1", "w2"] * int(rng.integers(0, 20)) + edited(rng, items[d % 20][1].split()) + ["w3"] * int(d % 7)))
            for d in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(make(rows), bench, n).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == aligned_pairs(rows, items)


def test_short_items_by_the_score_alone(spark, make):
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in (1, 2, 3, 5, 8, 10)]
    rows = []
    for n, text in items:
        words = text.split(" ")
        parts = [words, [*words[:-1], "other"], words[: -(-7 * n // 10)], words[:n // 2], words[:2] + words[3:],
                 [x for w in words for x in (w, "more")]]
        rows += [(10 * n + k, " ".join(["before", *some, "after"])) for k, some in enumerate(parts)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(make(rows), bench).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert pairs == aligned_pairs(rows, items)
    assert {(n * 10, n) for n, _ in items} | {(81, 8), (84, 8), (102, 10), (51, 5), (55, 5)} <= pairs
    assert not {d for d, _ in pairs} & {10 * n + 3 for n, _ in items}


def test_rows_of_one_id_are_judged_by_their_texts(spark, make):
    item = " ".join(f"w{k}" for k in range(20))
    rows = [(None, "clean"), (None, f"x {item} y"), (None, None), (7, item), (7, "clean too"), (7, "clean too"), (8, item)]
    items = [(k, item if k == 5 else f"{k} other words " * 9) for k in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.without_benchmark(make(rows), bench)
    assert kept.schema == make(rows).schema
    expected = [(None, "clean"), (None, None), (7, "clean too"), (7, "clean too")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_alignment_against_a_plain_table():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = rng.integers(0, 4, int(rng.integers(1, 12))), rng.integers(0, 4, int(rng.integers(0, 20)))
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        score, low, high = decontaminate.aligned(a, b)
        assert score * 2 * len(a) == pytest.approx(h.max()) and 0 <= low <= high <= len(b)


def test_empty_benchmark_and_documents(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert decontaminate.contaminated(make(ODD), none).count() == 0
    assert decontaminate.contaminated(make([]), some).count() == 0


# --- pipeline


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    last = docs
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, last, SF_DIR)
        assert kept.columns == docs.columns, name
        ids = {r["doc_id"] for r in kept.collect()}
        assert 0 < len(ids) <= last.count()
        last = docs.filter(F.col("doc_id").isin(*ids))
    normal = {re.sub("[A-Z]", lambda m: m[0].lower(), texts[i]) for i in ids}
    assert len(normal) == len(ids)
    sequences = corpus_pipeline.STAGES[-1][1](spark, last, SF_DIR)
    assert {r["doc_id"] for r in sequences.select("doc_id").distinct().collect()} == ids


def test_stages_keep_odd_columns(spark, tmp_path):
    """Columns named as the operators' own ones were, names with dots, maps, and rows that repeat."""
    names = ["_winner", "_digest", "_kept", "a.b", "c0", "features", "tags"]
    good = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").join(
        spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1"), "doc_id").select("text").limit(6).collect()]
    rows = [(i, t) for i, t in enumerate([*good, *good[:3], None, "", good[0].upper()])] + [(2, good[2]), (None, good[4] + " more"), (None, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{n}` {'map<string,int>' if n == 'tags' else 'string'}" for n in names)
    docs = spark.createDataFrame([(i, t, "en", "s", 1, *["x"] * 6, {"k": 1}) for i, t in rows], schema)
    last = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{tmp_path}/{name}"
        stage(spark, last, SF_DIR).write.parquet(path)
        last = spark.read.parquet(path)
        assert last.schema == docs.schema, name
    assert last.count() and last.filter("`a.b` = 'x' AND tags['k'] = 1").count() == last.count()
    assert corpus_pipeline.STAGES[-1][1](spark, last, SF_DIR).count() >= last.count()
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0, name
