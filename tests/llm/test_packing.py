import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from assayworks.llm import packing
from assayworks.llm.queries import packed, pieces
from assayworks.llm.tokens import cuts, encoder
from tests.llm.conftest import ODD


def checked(histogram, capacity):
    plan = packing.solve(histogram, capacity)
    used = {}
    for pattern, fills in plan.fills.items():
        assert sum(n * k for n, k in pattern) <= capacity
        for n, k in pattern:
            used[n] = used.get(n, 0) + k * fills
    assert used == histogram
    return plan.sequences


@pytest.mark.parametrize("lengths", [
    np.random.default_rng(1).integers(1, 1025, 20_000), np.random.default_rng(2).integers(330, 520, 20_000),
    np.full(999, 342), np.array([1024] * 5 + [1]), np.array([3])])
def test_plan_is_whole_and_no_worse_than_best_fit(lengths):
    values, counts = np.unique(lengths, return_counts=True)
    histogram = dict(zip(values.tolist(), counts.tolist(), strict=True))
    plain = packing.Plan(1024)
    need = np.bincount(lengths, minlength=1025)
    packing.best_fit(need, 1024, plain)
    assert -(-int(lengths.sum()) // 1024) <= checked(histogram, 1024) <= plain.sequences


def test_program_beats_best_fit_where_it_can():
    lengths = np.random.default_rng(2).integers(330, 520, 50_000)
    histogram = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True)), strict=True))
    plain = packing.Plan(1024)
    packing.best_fit(np.bincount(lengths, minlength=1025), 1024, plain)
    assert checked(histogram, 1024) < plain.sequences


def test_pieces_and_places(make):
    rows = [*ODD, (7, "<|endoftext|> in a text"), (8, "中文 text")]
    table = packed(make(rows)).toPandas()
    exact = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    expected = sorted((str(i), len(exact.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    sizes = [(str(None if np.isnan(i) else int(i)), int(n)) for i, n in zip(table.doc_id, table.length, strict=True)]
    short = sorted(x for x in expected if x[1] <= 1024)
    assert sorted(x for x in sizes if x in short) == short
    assert table.length.sum() == sum(n for _, n in expected)
    for _, sequence in table.sort_values("offset").groupby("sequence_id"):
        assert sequence.offset.tolist() == [0, *np.cumsum(sequence.length)[:-1]]
        assert sequence.length.sum() <= 1024


def test_ids_round_trip(documents):
    exact = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = dict(tuple(r) for r in documents.select("doc_id", "text").collect())
    parts = {}
    for r in pieces(documents).orderBy("doc_id", "piece").collect():
        parts.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], "<u4"))
    assert set(parts) == set(texts)
    for i, got in parts.items():
        assert np.concatenate(got).tolist() == [*exact.encode(texts[i], add_special_tokens=False).ids, 2]


def test_cuts():
    assert cuts(1024, 1024) == [0, 1024] and cuts(2500, 1024) == [0, 452, 1476, 2500] and cuts(2048, 1024) == [0, 1024, 2048]


def test_empty_table_and_wrong_lengths(spark, make):
    assert packed(make([])).count() == 0
    with pytest.raises(ValueError, match="lengths"):
        packing.pack(spark.createDataFrame([(0,)], "length int"), "length", 8)


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\u3000"])
def test_very_long_white_space(space):
    """Runs on which the fast library's pattern overflows its stack; ids stay those of the contract's library."""
    encode = encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    exact = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for text in (space * (5_000_000 if space == " " else 1_200_000), "before" + space * 1_000_000 + "after it", f"a{space * 9_999}b{space * 10_001}c"):
        assert encode([text])[0].tolist() == exact.encode(text, add_special_tokens=False).ids
