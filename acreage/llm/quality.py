"""Quality classifier: an ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.ship import shipped
from acreage.llm.words import BLANK, LOWER, mix, owner, parts, powers, utf8, word_hashes

#: Words are hashed whole and by their first bytes, so that inflected and compounded forms share a weight.
PREFIXES = (4, 5, 6)
FILTER_BITS = 20


@dataclass
class Ordinal:
    """P(grade >= k) = 1 / (1 + exp(threshold_k - score)) with one score for all k and rising thresholds."""

    keys: np.ndarray  # sorted hashes
    weights: np.ndarray
    shape_weights: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self) -> None:
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the keys, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int64)
        if len(self.keys):
            maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
            at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == hashes[maybe]
            out[maybe[hit]] = at[hit]
        return out

    def tails(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the first n bytes of each word that is longer; others get 0."""
    out = np.zeros(len(starts), np.uint64)
    long = np.flatnonzero(ends - starts > n)
    if len(long):
        acc = np.zeros(len(long), np.uint64)
        for k in range(n):
            acc += (LOWER[data[starts[long] + k]] + np.uint64(1)) * powers(n)[k]
        out[long] = mix(acc ^ np.uint64(n << 56))
    return out


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, hash) of each distinct feature of each text, shape figures of each text, words of each text."""
    data, cuts = utf8(column)
    n = len(cuts) - 1
    starts, words = word_hashes(data, cuts[:-1])
    own = owner(starts, cuts)
    count = np.diff(own)
    text = np.repeat(np.arange(n), count)
    blank = np.flatnonzero(BLANK[data])
    stop = np.append(starts[1:], len(data))
    after = np.append(blank, len(data))[np.searchsorted(blank, starts)]
    ends = np.minimum(after, stop)
    every, texts = [words], [text]
    for k in PREFIXES:
        h = prefix_hashes(data, starts, ends, k)
        held = h != 0
        every.append(h[held])
        texts.append(text[held])
    kinds = np.zeros(256, np.uint8)
    kinds[65:91] = 1
    kinds[97:123] = 2
    kinds[48:58] = 3
    kinds[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
    kind = kinds[data]
    total = [np.concatenate([[0], np.cumsum(kind == k)])[cuts] for k in (1, 2, 3, 4)]
    upper, lower, digit, sign = (np.diff(t) for t in total)
    bar = np.diff(np.concatenate([[0], np.cumsum(data == 124)])[cuts])
    same = np.zeros(len(words) + 1, np.int64)
    if len(words) > 1:
        same[2:] = np.cumsum((words[1:] == words[:-1]) & (text[1:] == text[:-1]))
    same = np.diff(same[own]) if len(words) else np.zeros(n, np.int64)
    size, many = np.maximum(np.diff(cuts), 1), np.maximum(count, 1)
    shape = np.stack(
        [
            upper / np.maximum(upper + lower, 1), digit / size, sign / size, bar / many, same / many,
            np.minimum(np.diff(cuts) / many, 40) / 40
        ],
        1
    )
    return np.concatenate(texts), np.concatenate(every), np.sqrt(np.clip(shape, 0, 1)) * 4, count


def distinct(text: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    return text[new], values[new]


def screened(
    held: list[np.ndarray], y: np.ndarray, keys: np.ndarray, inverse: np.ndarray, n: np.ndarray, strength: float
) -> np.ndarray:
    """Which features go with one grade by more than chance: strength standard deviations of a hypergeometric count."""
    grade = np.repeat(y, [len(h) for h in held])
    out = np.zeros(len(keys), bool)
    for g in np.unique(y):
        share = (y == g).mean()
        got = np.bincount(inverse, grade == g, len(keys))
        out |= np.abs(got - n * share) > strength * np.sqrt(n * share * (1 - share) * (1 - n / (len(y) + 1)) + 1e-9)
    return out


def fit(
    graded: list[
        tuple[int, np.ndarray, list[float]]
    ], grades: int, least: int = 8, strength: float = 10.0, rounds: int = 300, rate: float = 0.05, ridge: float = 1e-5,
) -> Ordinal:
    """Fit by Adam on the mean log-likelihood; graded has (grade, signed feature hashes, shape figures).

    Features are screened by how they go with a single grade; without that, rare words of single documents are learned.
    """
    y = np.array([g for g, _, _ in graded])
    held = [np.array(h, np.int64).view(np.uint64) for _, h, _ in graded]
    shape = np.array([s for _, _, s in graded])
    flat = np.concatenate(held)
    keys, inverse, n = np.unique(flat, return_inverse=True, return_counts=True)
    use = (n >= least) & screened(held, y, keys, inverse, n, strength)
    place = np.cumsum(use) - 1
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    on = use[inverse]
    col, row = place[inverse[on]], row[on]
    keys = keys[use]
    at = np.searchsorted(row, np.arange(len(held) + 1))
    w, v = np.zeros(len(keys)), np.zeros(shape.shape[1])
    share = np.array([(y >= k).mean() for k in range(1, grades)]).clip(0.01, 0.99)
    theta = np.log((1 - share) / share)
    params, firsts, seconds = [w, v, theta], [0.0] * 3, [0.0] * 3
    for t in range(1, rounds + 1):
        total = np.concatenate([[0], np.cumsum(w[col])])
        score = total[at[1:]] - total[at[:-1]] + shape @ v
        tail = 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -500, 500)))
        ends = np.concatenate([np.ones((len(y), 1)), tail, np.zeros((len(y), 1))], 1)
        p = np.maximum(ends[np.arange(len(y)), y] - ends[np.arange(len(y)), y + 1], 1e-12)
        slope = ends * (1 - ends)
        d = -(slope[np.arange(len(y)), y] - slope[np.arange(len(y)), y + 1]) / p / len(y)
        steps = np.zeros_like(tail)
        for k in range(1, grades):
            steps[:, k - 1] = np.where(y == k, slope[:, k], 0) - np.where(y == k - 1, slope[:, k], 0)
        grads = [np.bincount(col, d[row], len(keys)) + ridge * w, shape.T @ d + ridge * v, (steps / p[:, None]).sum(0) / len(y)]
        for i, g in enumerate(grads):
            firsts[i] = 0.9 * firsts[i] + 0.1 * g
            seconds[i] = 0.999 * seconds[i] + 0.001 * g * g
            params[i] -= rate * (firsts[i] / (1 - 0.9**t)) / (np.sqrt(seconds[i] / (1 - 0.999**t)) + 1e-8)
        theta[:] = np.maximum.accumulate(theta)
    live = np.abs(w) > 1e-4
    return Ordinal(keys[live], w[live], v, theta)


def train(
    docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str, grades: int, sample: int, terms: int
) -> Ordinal | None:
    """Fit on at most sample rated documents, those with the least hashes of their ids, and terms features of each.

    None where fewer than two grades are rated: then nothing can be learned.
    """
    rated = ratings.where("grade is not null and id is not null").groupBy("id").agg(F.min("grade").cast("int").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, part in parts(batch.column("text")):
                text, hashes, shape, _ = features(part)
                text, hashes = distinct(text, hashes)
                few = np.arange(len(text)) - np.searchsorted(text, text) < terms  # those with the least hashes
                text, hashes = text[few], hashes[few]
                ends = np.searchsorted(text, np.arange(len(part) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
                at = pa.array(np.arange(len(part) + 1) * shape.shape[1], pa.int32())
                shapes = pa.ListArray.from_arrays(at, pa.array(shape.ravel()))
                grades = batch.column("grade").slice(lo, len(part))
                yield pa.RecordBatch.from_arrays([grades, lists, shapes], ["grade", "hashes", "shape"])

    joined = texts.join(F.broadcast(chosen), "id").select("id", "grade", "text")
    rows = joined.mapInArrow(run, "grade int, hashes array<long>, shape array<double>").toArrow()
    graded = sorted(
        zip(rows["grade"].to_pylist(), [x.values.to_numpy() for x in rows["hashes"]], rows["shape"].to_pylist(), strict=True),
        key=lambda r: (r[0], len(r[1]), r[2])
    )
    return fit(graded, grades) if len({g for g, _, _ in graded}) > 1 else None


def tails_of(model: Ordinal, texts: pa.Array) -> np.ndarray:
    """P(grade >= k) of each text for k from 1; 0 where there are no words. Texts are taken in parts, so memory stays small."""
    out = np.zeros((len(texts), len(model.thresholds)))
    for lo, part in parts(texts):
        text, hashes, shape, words = features(part)
        at = model.find(hashes)
        hit = at >= 0
        text, at = distinct(text[hit], at[hit])
        score = np.bincount(text, model.weights[at], len(part)) + shape @ model.shape_weights
        out[lo : lo + len(part)] = np.where(words[:, None] > 0, model.tails(score), 0.0)
    return out


def sent_model(docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str, grades: int, sample: int, terms: int):
    spark = shipped(docs.sparkSession)
    model = train(docs, ratings, id_col, text_col, grades, sample, terms)
    return spark.sparkContext.broadcast((model.keys, model.weights, model.shape_weights, model.thresholds) if model else None)


def score_quality(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, grades: int = 3, sample: int = 6000,
    terms: int = 10_000, least_tail: float = 0.7
) -> DataFrame:
    """One row for each row of docs: (id, expected_grade, tail, kept).

    ratings has (id, grade) with grades from 0 to grades - 1, of which the least counts where an id has several; at
    most sample of them are fitted, and of each text at most terms features, those with the least hashes, which bounds
    what the driver holds. tail is the probability of the highest grade, kept is tail >= least_tail. Every whole text is
    scored where it lies, with no shuffle. A text without words (null, empty or blank) has grade 0 and tail 0 and isn't
    kept. Repeated rows give repeated results; other columns are ignored. Where ratings cover fewer than two grades
    (none, or no documents of theirs), nothing can be learned: grade and tail are null and nothing is kept.
    """
    sent = sent_model(docs, ratings, id_col, text_col, grades, sample, terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ordinal(*sent.value) if sent.value else None
        for batch in batches:
            n = len(batch)
            if model is None:
                scores = [pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array([False] * n)]
            else:
                tails = tails_of(model, batch.column(1))
                scores = [
                    pa.array(tails.sum(1).round(9)), pa.array(tails[:, -1].round(9)), pa.array(tails[:, -1] >= least_tail)
                ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *scores], ["id", "expected_grade", "tail", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, expected_grade double, tail double, kept boolean").withColumnRenamed("id", id_col)


def keep_quality(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, grades: int = 3, sample: int = 6000,
    terms: int = 10_000, least_tail: float = 0.7
) -> DataFrame:
    """The rows of docs, with all their columns, that score_quality keeps. Rows are filtered where they lie."""
    sent = sent_model(docs, ratings, id_col, text_col, grades, sample, terms)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ordinal(*sent.value) if sent.value else None
        for batch in batches:
            if model is not None:
                yield batch.filter(pa.array(tails_of(model, batch.column(place))[:, -1] >= least_tail))

    return docs.mapInArrow(run, docs.schema)


def grade_of(labels: DataFrame) -> DataFrame:
    """Grades from the labels table: 0 junk, 1 well-formed but toxic, 2 clean."""
    return labels.select(
        F.col("doc_id").cast("long").alias("id"),
        F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2).alias("grade")
    )
