"""Quality scores of documents from preference pairs (Bradley-Terry), thresholded by a quantile."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from assayworks.llm.arrowtext import Texts, text_chunks
from assayworks.llm.shared import free_name, mapped_rows, text_or_empty, written

PENALTY = 1e-3
ROUNDS, NEAR = 60, 1e-9
CUT = 0.7
# Scores are counted in bins of 1 / STEPS up to REACH, the rest in the bins at the ends.
STEPS, REACH = 32, 64
NODES = np.arange(2 * REACH * STEPS + 1) / STEPS - REACH
RANGES = 4_096

# Byte classes of the features.
UPPER, DIGIT = (65, 90), (48, 57)
MARKS = b"!#$%&*+<=>@[]^_`{|}~"
STOPS = b".,;:?'\"()-"

FEATURES = ("words", "word_length", "upper", "digits", "marks", "marked_words", "stops", "beyond_ascii", "distinct",
            "repeated", "far_repeated", "short_lines", "wordless", "capitals", "longest_word", "empty")


def _flags(codes: bytes | tuple[int, int]) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(codes) if isinstance(codes, bytes) else slice(codes[0], codes[1] + 1)] = True
    return flags


def features(texts: Texts) -> np.ndarray:
    """One row of FEATURES per text, all finite; an empty text has zeros and the last feature set."""
    words, n = texts.words(), len(texts.rows)
    size = np.maximum(texts.end - texts.begin, 1).astype(float)
    count = np.diff(words.first)
    some = np.maximum(count, 1).astype(float)

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags[texts.data])])
        return (sums[texts.end] - sums[texts.begin]) / size

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(words.text, values, n) / some

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags[words.data])])
        return sums[words.end] - sums[words.start]

    length = (words.end - words.start).astype(float)
    hashes = words.hashes()
    order = np.lexsort((hashes, words.text))
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.text[order][1:] != words.text[order][:-1])
    follows = np.zeros(len(length), bool)
    follows[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    # Runs of four words that the same text has had before: copied lines, loops.
    again = np.zeros(len(length))
    if len(length) > 4:
        grams = hashes[:-3] * np.uint64(3) + hashes[1:-2] * np.uint64(5) + hashes[2:-1] * np.uint64(7) + hashes[3:]
        whole = np.flatnonzero(words.text[:-3] == words.text[3:])
        by = whole[np.lexsort((grams[whole], words.text[whole]))]
        same = (grams[by][1:] == grams[by][:-1]) & (words.text[by][1:] == words.text[by][:-1])
        again[by[1:][same]] = 1
    marks = within(_flags(MARKS))
    letters = length - marks - within(_flags(STOPS)) - within(_flags(DIGIT))
    lines = np.bincount(np.searchsorted(texts.begin, np.flatnonzero(texts.data == 10), "right") - 1, minlength=n)[:n]
    longest = np.zeros(n)
    np.maximum.at(longest, words.text, length)
    return np.column_stack([
        np.log1p(count), per_word(length) / 10, share(_flags(UPPER)), share(_flags(DIGIT)), share(_flags(MARKS)),
        per_word((marks > 0).astype(float)), share(_flags(STOPS)), share(np.arange(256) > 127),
        np.bincount(words.text[order], fresh, n) / some, per_word(follows.astype(float)), per_word(again),
        lines / some, per_word((letters <= 0).astype(float)),
        per_word((within(_flags(UPPER)) > 1).astype(float)), np.log1p(longest) / 5, (count == 0).astype(float),
    ])


def expanded(x: np.ndarray) -> np.ndarray:
    """Features, their roots and steps: a linear score of these can bend."""
    shares = x[:, 2:]
    return np.hstack([x, np.sqrt(np.abs(shares)), shares > 0.02, shares > 0.15, shares > 0.5]).astype(float)


@dataclass(frozen=True)
class QualityModel:
    """Score = logistic of slope * (weights . features - cut) + logit of the threshold."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (expanded(x) - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(self.threshold / (1 - self.threshold))
        z = self.slope * (self.raw(x) - self.cut) + shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Expanded features, and which rows are good."""
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return expanded(x), batch.column(0).to_numpy(zero_copy_only=False) == 1


def _summed(labelled: DataFrame, width: int, fold: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of the ``width`` numbers that ``fold`` gives for each batch, in decimals so that the order does not matter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += fold(*_rows_of(batch))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["place", "value"])

    parts = labelled.mapInArrow(run, "place int, value double")
    sums = parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,18)")).cast("double"))
    out = np.zeros(width)
    for place, value in sums.collect():
        out[place] = value
    return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class _Spread:
    """The scores of both classes under some weights: means of the bins that hold any, and their shares of the class."""

    good: tuple[np.ndarray, np.ndarray]
    bad: tuple[np.ndarray, np.ndarray]

    def loss(self) -> float:
        """The mean logistic loss of all pairs of a good and a bad document."""
        return float(sum(share * (np.logaddexp(0, self.bad[0] - score) @ self.bad[1])
                         for score, share in zip(*self.good, strict=True)))

    def pulls(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """At each of NODES: the mean slope and bend of the loss against all documents of the other class, for a good and a bad one."""
        out = np.zeros((4, len(NODES)))
        for k, ((scores, shares), sign) in enumerate(((self.bad, 1), (self.good, -1))):
            for score, share in zip(scores, shares, strict=True):
                p = _logistic(sign * (score - NODES))
                out[k] += share * p
                out[2 + k] += share * p * (1 - p)
        return tuple(out)


def _spread(labelled: DataFrame, scored: Callable[[np.ndarray], np.ndarray]) -> _Spread:
    bins = len(NODES) - 1

    def fold(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        s = scored(x)
        at = np.clip(np.floor((s + REACH) * STEPS), 0, bins - 1).astype(np.int64) + bins * good
        return np.concatenate([np.bincount(at, minlength=2 * bins), np.bincount(at, s, 2 * bins)])

    count, total = _summed(labelled, 4 * bins, fold).reshape(2, 2, bins)
    sides = [(total[q][count[q] > 0] / count[q][count[q] > 0], count[q][count[q] > 0] / count[q].sum()) for q in (0, 1)]
    return _Spread(sides[1], sides[0])


def fit_pairs(labelled: DataFrame, share_bad: float, threshold: float = CUT) -> QualityModel:
    """Bradley-Terry: P(good preferred to bad) = logistic(w . (f(good) - f(bad))), over all pairs of a good and a bad row.

    ``labelled`` has quality (1 or 0) and features. The weights minimise the mean logistic loss of all pairs, with PENALTY,
    by Newton steps. What a document adds to a step depends on the other class through the distribution of its scores only, so
    a round counts all scores in bins of 1 / STEPS, each taken at the mean of its scores, and then sums over all documents; pairs are
    never rows. The bins shift a mean preference by less than 2e-5. The bends between classes are taken as if they were independent, which
    changes the steps and not where they end. The driver gets sums whose size depends on the number of features and bins.
    The cut is the score quantile below which the share of bad documents lies, over all rows.
    """
    count = {row[0]: row[1] for row in labelled.groupBy("quality").count().collect()}
    n_good, n_bad = count.get(1, 0), count.get(0, 0)
    width = expanded(np.zeros((1, len(FEATURES)))).shape[1]
    if not n_good or not n_bad:
        side = 1.0 if n_good or not n_bad else -1.0
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), -side, 1.0, threshold)
    mean, square = _summed(labelled, 2 * width, lambda x, _: np.concatenate([x.sum(0), (x * x).sum(0)]) / (
        n_good + n_bad)).reshape(2, width)
    variance = square - mean * mean
    scale = np.where(variance > 1e-12 * square + 1e-18, np.sqrt(np.maximum(variance, 0)), 1.0)

    def spread(w: np.ndarray) -> tuple[_Spread, float]:
        found = _spread(labelled, lambda x: (x - mean) / scale @ w)
        return found, found.loss() + PENALTY / 2 * float(w @ w)

    w = np.zeros(width)
    scores, loss = spread(w)
    for _ in range(ROUNDS):
        gradient, step = _newton(labelled, mean, scale, w, scores.pulls(), (n_good, n_bad))
        gain, part = float(gradient @ step), 1.0
        if gain < NEAR:
            break
        after, lower = spread(w - step)
        while lower > loss - 0.1 * part * gain + 1e-7 and part > 1e-3:
            part /= 2
            after, lower = spread(w - part * step)
        w, scores, loss = w - part * step, after, lower
    return QualityModel(mean, scale, w, _cut(labelled, mean, scale, w, share_bad, (n_good, n_bad)), 1.0, threshold)


def _newton(labelled: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, pulls: tuple,
            sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The gradient of the loss of all pairs, and the step against it."""
    good_slope, bad_slope, good_bend, bad_bend = pulls
    width = len(w)

    def fold(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        z = (x - mean) / scale
        s = z @ w
        each = np.where(good, 1 / sizes[0], 1 / sizes[1])
        slope = each * np.where(good, -np.interp(s, NODES, good_slope), np.interp(s, NODES, bad_slope))
        bend = each * np.where(good, np.interp(s, NODES, good_bend), np.interp(s, NODES, bad_bend))
        of_good, of_bad = bend * good, bend * ~good
        return np.concatenate([slope @ z, of_good @ z, of_bad @ z, [of_good.sum(), of_bad.sum()], (z.T * bend @ z).ravel()])

    sums = _summed(labelled, 3 * width + 2 + width * width, fold)
    gradient = sums[:width] + PENALTY * w
    (a, b), (all_a, all_b) = sums[width:3 * width].reshape(2, width), np.maximum(sums[3 * width:3 * width + 2], 1e-300)
    apart = a / all_a - b / all_b
    within = sums[3 * width + 2:].reshape(width, width) - np.outer(a, a) / all_a - np.outer(b, b) / all_b
    bends = within + min(all_a, all_b) * np.outer(apart, apart) + PENALTY * np.eye(width)
    return gradient, np.linalg.solve(bends, gradient)


def _cut(labelled: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, share_bad: float,
         sizes: tuple[int, int]) -> float:
    """Half way between the first score up to which ``share_bad`` of the weight lies and the score before it.

    All good rows weigh 1 - share_bad together, all bad ones share_bad. Exact: ranges of scores are counted,
    ever narrower, until the range holds one score.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = _rows_of(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((x - mean) / scale @ w)], ["quality", "score"])

    scores = written(labelled.mapInArrow(run, "quality int, score double"), "scores")
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    good, bad, under = 0, 0, low
    while low < high:
        ranged = scores.filter(F.col("score").between(low, high)).groupBy(
            F.floor((F.col("score") - low) / (high - low) * RANGES).alias("at")).agg(
            F.sum("quality").alias("good"), F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for row in sorted(ranged.collect()):
            low, high = row["low"], row["high"]
            more = good + row["good"], bad + row["n"] - row["good"]
            if more[0] * (1 - share_bad) / sizes[0] + more[1] * share_bad / sizes[1] >= share_bad - 1e-12:
                break
            (good, bad), under = more, high
    return float(min(under, high) + high) / 2


def _featured(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """doc columns plus ``features`` as an array of doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch.column(text)):
                x = features(part)
                rows = batch.slice(int(part.rows[0]), len(part.rows))
                flat = pa.array(x.ravel())
                places = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), pa.ListArray.from_arrays(places, flat)], [*keep, "features"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, text).mapInArrow(run, f"{schema}, features array<double>")


def fit_quality(docs: DataFrame, labels: DataFrame, threshold: float = CUT) -> QualityModel:
    """Fits on all labelled documents.

    ``labels`` has doc_id and quality (1 good, 0 bad); rows with other or NULL values are left out, and so are
    documents without a row in ``docs``. Rows with the same doc_id and text are one document; a doc_id that comes with
    several texts is learned from with each of them. With a single class,
    every document gets that class. The share of bad documents behind the quantile is counted over all labels.
    Features are joined with labels, so that no text is shuffled.
    """
    usable = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int")).distinct()
    totals = {row[0]: row[1] for row in usable.groupBy("quality").count().collect()}
    known = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", F.sha2(text_or_empty(), 256).alias("digest"))
    joined = _featured(known, "text", ["doc_id", "digest"]).join(usable, "doc_id")
    labelled = joined.dropDuplicates(["doc_id", "digest", "quality"]).select("quality", "features")
    bad = totals.get(0, 0) / max(1, sum(totals.values()))
    return fit_pairs(written(labelled, "labelled"), bad, threshold)


def accepted(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows that the model does not reject, with all their columns, whatever their names and types."""
    names = free_name(docs, "score"), free_name(docs, "predicted")
    return score_quality(docs, model, names).filter(F.col(names[1]) == 1).drop(*names)


def score_quality(docs: DataFrame, model: QualityModel, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from the threshold on), under ``names``; columns with these names are replaced.

    One row per row, in one pass without a shuffle. A NULL text counts as empty; an empty text
    has features and a score like any other.
    """
    docs = docs.drop(*names)
    text, threshold = docs.columns.index("text"), model.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch.column(text)):
                s = model.score(features(part))
                rows = batch.slice(int(part.rows[0]), len(part.rows))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    [*rows.schema.names, *names])

    return mapped_rows(docs, run, [StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])
