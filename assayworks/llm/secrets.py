"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Kinds in the order in which spans of one start are listed, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # runs are matched whole, so shorter ones need not be found first

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,}+"

# Labels of training strings.
TEXT, RANDOM, TECHNICAL = 0, 1, 2

#: Ordinary strings of technical text, as a corpus of prose may hold too few of them.
TECHNICAL_STRINGS = (
    "assets/static/img/2018/06/footer-background-small", "/usr/local/share/doc/packages/readme", "src/main/java/com/example/app/Main",
    "blog/2021/11/30/how-to-read-a-long-article-about-news", "content/2024-02-28-notes-on-the-release", "lib/python3/site-packages/module",
    "node_modules/package-name/dist/index-min", "archive/2009/2010/2011/index", "docs/api/v1/users/42/orders/1001", "wp-content/uploads/2016/03/photo-1024x768",
    "2019-07-04", "2022-10-15T08-30-00", "20230918", "1970-01-01", "1999/12/31", "2008-06-17/2008-06-24", "12-34-56", "555-0123-4567", "+1-202-555-0143",
    "0000000000000000", "1234567890", "1111-2222-3333-4444", "release-10-4-2-build-7781", "version_3_11_0", "build-20240131-2",
    "====================", "--------------------", "____________________", "////////////////", "++++++++++++++++", "-=-=-=-=-=-=-=-=", "+--------+--------+",
    "getElementsByClassName", "XMLHttpRequestEventTarget", "readFileContentsAsString", "isValidUserInputValue", "NullPointerException", "AbstractFactoryBean",
    "MAX_CONNECTIONS_PER_HOST", "DEFAULT_TIMEOUT_MILLISECONDS", "first_name_of_customer", "order-confirmation-page", "section-2-paragraph-14", "figure_12_left_panel",
    "chapter01-introduction", "user-profile-settings-v2", "en-US", "utf-8", "iso-8859-1", "sha256", "base64", "x86_64-linux-gnu", "application/x-www-form-urlencoded",
)
#: Strings of a rule that are added to those: lower-case hexadecimal identifiers in groups of 8, 4, 4, 4 and 12, and random ones of letters and digits.
SYNTHETIC = 400

BACKOFF, SYLLABLES = 5.0, 6
#: Evidence that a string needs on average over its pairs of characters.
EVIDENCE = 1.2


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def training_strings(docs: DataFrame) -> DataFrame:
    """``label`` (TEXT, RANDOM, TECHNICAL) and ``string``, each string of a label once, from all documents and some fixed samples.

    What the fixed patterns hold is random when it has a digit and 16 characters. All other strings of eight characters and more
    of the same alphabet as candidates are ordinary: words, identifiers, paths, numbers, rulers. Samples of technical strings and
    SYNTHETIC identifiers and keys made from hashes of numbers let the models know what a corpus may not hold. The strings are combined
    in each task before they are shuffled.
    """
    some = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    values = F.filter(F.flatten(F.array(_found(F.col("text"), ASSIGN, 2), _found(F.col("text"), HEX),
                                        _found(F.col("text"), ACCESS))), lambda v: v.rlike("[0-9]") & (F.length(v) >= 16))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), HEX, " "), ACCESS, " ")
    labelled = F.concat(
        F.transform(values, lambda v: F.struct(F.lit(RANDOM).alias("label"), v.alias("string"))),
        F.transform(_found(rest, ORDINARY), lambda w: F.struct(F.lit(TEXT).alias("label"), w.alias("string"))))
    return some.select(F.inline(labelled)).union(_samples(docs.sparkSession)).distinct()


def _samples(spark: SparkSession) -> DataFrame:
    told = spark.createDataFrame([(TECHNICAL, s) for s in TECHNICAL_STRINGS], "label int, string string")
    hashed = spark.range(SYNTHETIC).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    groups = F.concat_ws("-", *[F.substring("h", a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    keys = F.regexp_replace(F.base64(F.unhex("h")), "[+/=]", "")
    return told.union(hashed.select(F.lit(TECHNICAL), groups)).union(hashed.select(F.lit(RANDOM), keys))


def fit_markov(strings: DataFrame) -> list[list[float]]:
    """Log-likelihood ratios, random over each kind of ordinary string, of each pair of neighbouring characters of ALPHABET.

    First-order models with a backoff to how often the second character occurs, and that to an even share. The kinds are text and technical
    strings, where a pair is as ordinary as either has it; words in capitals; and words in one another's wake (LikeThis). Other
    characters take no part. Without strings of a label its model is even. The driver gets counts of
    character pairs only.
    """
    chars, pairs = F.split("string", ""), F.length("string") - 1
    two = F.zip_with(F.slice(chars, 1, pairs), F.slice(chars, 2, pairs), lambda a, b: F.concat(a, b))
    found = strings.filter(F.length("string") > 1).select("label", F.explode(two).alias("two"))
    n = len(ALPHABET)
    counts = {label: [[0] * n for _ in range(n)] for label in (TEXT, RANDOM, TECHNICAL)}
    for label, two, count in found.groupBy("label", "two").count().collect():
        a, b = ALPHABET.find(two[0]), ALPHABET.find(two[1])
        if a >= 0 and b >= 0:
            counts[label][a][b] += count
    random, text, technical = (_logs(counts[label]) for label in (RANDOM, TEXT, TECHNICAL))
    plain = [[max(x, y) for x, y in zip(*rows, strict=True)] for rows in zip(text, technical, strict=True)]
    kinds = [plain, *map(_logs, _cased(counts[TEXT]))]
    return [[random[a][b] - kind[a][b] for a in range(n) for b in range(n)] for kind in kinds]


def _cased(counts: Sequence[Sequence[int]]) -> list[list[list[float]]]:
    """What the words behind the counts would give in capitals joined by ``_``, and joined with a capital each.

    One letter in SYLLABLES is the last of its word.
    """
    n, letters = len(ALPHABET), 26
    folded = [[sum(counts[a + i][b + j] for i in (0, letters) for j in (0, letters)) for b in range(letters)] for a in range(letters)]
    capitals, joined = ([[0.0] * n for _ in range(n)] for _ in range(2))
    bar, total = ALPHABET.index("_"), max(1, sum(map(sum, folded)))
    for a in range(letters):
        ends = sum(folded[a]) / SYLLABLES
        capitals[a][bar] = ends
        for b in range(letters):
            begins = sum(folded[b]) / total
            capitals[a][b] = joined[a + letters][b + letters] = joined[a][b + letters] = folded[a][b]
            capitals[bar][b] = total * begins / SYLLABLES
            joined[a + letters][b] = ends * begins
    return [capitals, joined]


def _logs(counts: Sequence[Sequence[float]]) -> list[list[float]]:
    n = len(counts)
    second = [sum(row[b] for row in counts) for b in range(n)]
    even = [(s + 1.0) / (sum(second) + n) for s in second]
    return [[math.log((row[b] + BACKOFF * even[b]) / (sum(row) + BACKOFF)) for b in range(n)] for row in counts]


def evidence(string: Column, tables: Sequence[Sequence[float]]) -> Column:
    """The average of a table over all neighbouring characters, which must be of ALPHABET; of the table with the least."""
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(F.slice(codes, 1, F.length(string) - 1), F.slice(codes, 2, F.length(string) - 1),
                       lambda a, b: (a - 1) * len(ALPHABET) + b)

    def total(table: Sequence[float]) -> Column:
        values = F.array(*[F.lit(float(x)) for x in table])
        return F.aggregate(pairs, F.lit(0.0), lambda so_far, at: so_far + F.element_at(values, at))

    return F.least(*map(total, tables)) / F.size(pairs)


def _items(text: Column, kind: str, pattern: str, fits) -> Column:
    """One struct per match: kind, order k, symbols between the match before and this one, length, whether it counts."""
    matches = _found(text, pattern)
    between = F.split(text, pattern, -1)
    numbered = F.transform(
        F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("match")),
        lambda x, k: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), k.alias("k"), F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["match"]).cast("long").alias("size"), fits(x["match"]).alias("counts")))
    none = F.array().cast("array<struct<kind:int,k:int,gap:bigint,size:bigint,counts:boolean>>")
    return F.when(F.size(matches) > 0, numbered).otherwise(none)


def secret_spans(docs: DataFrame, tables: Sequence[Sequence[float]], threshold: float = EVIDENCE) -> DataFrame:
    """doc_id and ``found``: an array of (start, kind, end) in code points, end exclusive, by start and then kind.

    Matches of a kind are leftmost and do not overlap; a match that fails its kind's length is dropped after it has been
    consumed. A string of 20 and more characters that no pattern covers is of kind "random" when the evidence of
    the models reaches ``threshold`` on average over its pairs of characters, so a long string needs as much a pair as a short one. One row per row of ``docs``; repeated rows and NULL ids stay rows of their own.
    NULL and empty texts have no spans. Only small rows are shuffled: a document's matches, never its text.
    """
    text = F.col("text")
    short = F.regexp_extract
    kinds = {
        "assign": (ASSIGN, lambda m: F.length(short(m, ASSIGN, 2)) >= 8),
        "access": (ACCESS, lambda m: F.length(m) >= 16),
        "hex": (HEX, lambda m: F.length(m) >= 32),
        "random": (CANDIDATE, lambda m: evidence(m, tables) >= threshold),
    }
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = F.concat(*[_items(text, kind, pattern, fits) for kind, (pattern, fits) in kinds.items()])
    each = rows.select("key", "doc_id", F.explode_outer(items).alias("x")).select("key", "doc_id", "x.*")
    order = Window.partitionBy("key", "kind").orderBy("k")
    upto = F.sum(F.col("gap") + F.col("size")).over(order)
    placed = each.repartition("key").withColumn("end", upto).withColumn("start", F.col("end") - F.col("size"))
    span = F.struct("start", "kind", "end")
    found = placed.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.when(F.col("counts"), span))).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    clear = F.filter("all", lambda s: (s["kind"] < 3) | ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.withColumn("base", base).withColumn("found", clear).select("doc_id", "base", "found")


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
