import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from assayworks.llm import repair
from assayworks.llm.queries import LLM_QUERIES

TYPE = "conv_id long, turn long, role string, text string, cost int, audit string, place long, `a.b` string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(k, text)
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def cheapest(rows):
    """Cost, audit and repaired lines by trying every edit; rows are (role, text, fault)."""

    @lru_cache(maxsize=None)
    def best(i, made, inserted):
        # made: initials so far, as far as they matter
        found = []
        if i == len(rows) and made in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if allowed(made, role[0]):
                    c, a, lines = best(i, role[0], inserted + 1)
                    found.append((c + 3, "I" + a, (f"{role}:", *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, lines = best(i + 1, made, 0)
            found.append((c + 4, "D" + a, lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                options = [("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")]
                for edit, cost, new in options:
                    if allowed(made, new[:1]):
                        c, a, lines = best(i + 1, new[0], 0)
                        found.append((c + cost + extra, edit + a, (f"{new}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    def allowed(made, new):
        return new in {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}[made]

    for i in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for made in ("", "s", "u", "a"):
            best(i, made, 0)
    return best(0, "", 0)


def expected(original):
    out = []
    for conv in {r[0] for r in original}:
        rows = sorted((r for r in damage(original) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, graded, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, _, role, text in rows:
            whole = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not whole else "duplicate" if (role, text) in seen else "" if whole[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            graded.append((role, text, fault))
        turns = {r[1] for r in rows if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = cheapest(tuple(graded))
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(count, seed, turns=12):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(count), None]:
        for turn in range(rng.randrange(0, turns)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", " ", "", None, "What?\n", "Same text!", f"Text {rng.randrange(9)}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def table(spark, rows, path):
    spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], TYPE).write.parquet(f"{path}/conversations.parquet")


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_matches_brute_force(spark, tmp_path):
    rows = conversations(300, 1)
    table(spark, rows, tmp_path)
    want = expected(rows)
    assert collected(LLM_QUERIES["op13_conversation_repair"](spark, str(tmp_path))) == want
    assert {"D", "I", "K", "R"} <= set("".join(r[7] for r in want))


@pytest.mark.parametrize("span,size", [(1, 1 << 23), (3, 1 << 23), (50, 1 << 23), (50, 20)])
def test_spans_give_the_same(spark, tmp_path, span, size):
    """Conversations cut into spans, over several partitions, one of them with most of the rows."""
    rows = conversations(40, span) + [(7, t, *r[2:]) for t, r in enumerate(conversations(60, 9))]
    table(spark, rows, tmp_path)
    original = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    found = repair.with_everyone(repair.repaired(repair.damaged(original), span, size), original)
    assert collected(found) == expected(rows)


def test_every_row_the_same_and_no_rows(spark, tmp_path):
    rows = [(1, 2, "user", "Again.")] * 500
    table(spark, rows, tmp_path)
    original = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    found = repair.repaired(original, 20).collect()
    assert len(found) == 1 and found[0].duplicate == 499 and found[0].audit == "K" + "D" * 499 + "I" and found[0].cost == 1999
    assert repair.repaired(original.limit(0)).collect() == []
    assert LLM_QUERIES["op13_conversation_repair"](spark, str(tmp_path)).count() == 1


def test_square_root_checkpoints():
    rng = random.Random(4)
    rows = [(rng.choice(["user", "assistant", "system"]), "x.", rng.choice(["", "", "truncated", "blank"])) for _ in range(10_000)]
    step, kept = repair.checkpoints(rows, repair.end_costs(repair.LAST))
    assert step == 100 and len(kept) == 101
    edits = [e for e, *_ in repair.walk(rows, kept[-1], repair.NOTHING, True)]
    assert sum(e != "I" for e in edits) == len(rows)


def test_given_conversations(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(LLM_QUERIES["op13_conversation_repair"](spark, sf)) == expected(rows)
