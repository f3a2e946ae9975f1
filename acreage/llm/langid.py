"""Language identification with one interpolated Kneser-Ney character model for each language, in sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.llm.ship import shipped
from acreage.llm.words import FACTOR, mix

ORDER = 5
#: Symbols among which an unseen character is thought to be dealt evenly.
UNSEEN = 500
#: Texts are scored in groups of about so many characters, so memory doesn't follow the batch.
GROUP = 1 << 19

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def characters(
    texts: list[str | None], ink_of: np.ndarray | None = None, pad: int = ORDER - 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, begin and end of each, letters of each. Lower case, one blank for each run of other characters.

    Every text has pad blanks before it, so that no window of pad + 1 reaches into the one before.
    """
    parts = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    size = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    text = np.repeat(np.arange(len(parts)), size)
    ink = (letters() if ink_of is None else ink_of)[flat]
    keep = ink.copy()
    keep[1:] |= ink[:-1] & (text[1:] == text[:-1])
    n_ink = np.bincount(text[ink], minlength=len(parts))
    flat = np.where(ink, flat, 32)[keep]
    n = np.bincount(text[keep], minlength=len(parts))
    before = np.cumsum(n) - n
    begin = before + pad * np.arange(1, len(parts) + 1)
    out = np.full(int(n.sum()) + pad * len(parts), 32, np.uint64)
    out[np.repeat(begin - before, n) + np.arange(len(flat))] = flat
    return out, np.stack([begin, begin + n], 1), n_ink


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n characters that end at each place; the first n - 1 places are not used."""
    acc = np.zeros(len(codes), np.uint64)
    for k in range(n):
        acc[n - 1 :] = acc[n - 1 :] * np.uint64(FACTOR) + codes[k : len(codes) - n + 1 + k] + np.uint64(1)
    return mix(acc ^ np.uint64(n))


@dataclass
class Models:
    langs: list[str]
    keys: list[np.ndarray]  # of each order: sorted hashes of n-grams
    logp: list[np.ndarray]  # of each order: n-gram x language, the whole interpolated probability
    contexts: list[np.ndarray]  # of each order: sorted hashes of what comes before
    back: list[np.ndarray]  # of each order: context x language, the weight of the order below
    floor: np.ndarray
    temperature: float
    limit: np.ndarray

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy for each character and language, and the letters of each text."""
        codes, spans, n_letters = characters(texts)
        out = np.zeros((len(texts), len(self.langs)))
        size = spans[:, 1] - spans[:, 0]
        live = np.repeat(spans[:, 0] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(int(size.sum()))
        total = np.zeros((len(live), len(self.langs)), np.float32)
        left = np.arange(len(live))
        for n in range(ORDER, 0, -1):
            if not len(left):
                break
            keys = self.keys[n - 1]
            h = grams(codes, n)[live[left]]
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            total[left[hit]] += self.logp[n - 1][at[hit]]
            left = left[~hit]
            if n > 1 and len(left):
                contexts = self.contexts[n - 1]
                h = grams(codes, n - 1)[live[left] - 1]
                at = np.minimum(np.searchsorted(contexts, h), len(contexts) - 1)
                known = contexts[at] == h
                total[left[known]] += self.back[n - 1][at[known]]
        total[left] += self.floor.astype(np.float32)
        some = size > 0
        if some.any():
            out[some] = -np.add.reduceat(total.astype(np.float64), (np.cumsum(size) - size)[some]) / size[some, None]
        return out, n_letters


def estimate(texts: list[str], order: int = ORDER) -> dict:
    """Kneser-Ney tables of one language: raw counts at the highest order, counts of distinct left neighbours below it."""
    codes, spans, _ = characters(texts)
    size = spans[:, 1] - spans[:, 0]
    live = np.repeat(spans[:, 0] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(int(size.sum()))
    hashes = [grams(codes, n)[live] for n in range(1, order + 1)]
    before = [np.full(len(live), 1, np.uint64)] + [grams(codes, n)[live - 1] for n in range(1, order)]
    tables = []
    for n in range(order, 0, -1):
        key, first, count = np.unique(hashes[n - 1], return_index=True, return_counts=True)
        if n < order:
            _, distinct = np.unique(hashes[n], return_index=True)
            key2, count = np.unique(hashes[n - 1][distinct], return_counts=True)
            assert np.array_equal(key, key2)
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.95)
        context, place = np.unique(before[n - 1][first], return_inverse=True)
        mass = np.bincount(place, count)
        kinds = np.bincount(place)
        tables.append({
            "key": key, "context": context, "direct": np.maximum(count - discount, 0) / mass[place], "place": place, "back": discount * kinds / mass,
            "below": hashes[n - 2][first] if n > 1 else None,
        })
    tables.reverse()
    return {"tables": tables}


def train_models(sample: dict[str, list[str]], held_share: int = 5) -> Models:
    """One model for each language; every held_share-th text only calibrates the temperature and the limits of rejection."""
    langs = sorted(sample)
    fitted = [
        estimate([t for k, t in enumerate(sample[l]) if k % held_share or len(sample[l]) < held_share])["tables"] for l in langs
    ]
    keys, logp, contexts, back = [], [], [], []
    below: np.ndarray | None = None
    for n in range(1, ORDER + 1):
        union = np.unique(np.concatenate([t[n - 1]["key"] for t in fitted]))
        around = np.unique(np.concatenate([t[n - 1]["context"] for t in fitted]))
        p = np.zeros((len(union), len(langs)))
        weight = np.ones((len(around), len(langs)))
        lower = np.full(len(union), 0, np.int64)
        of = np.zeros(len(union), np.int64)
        for k, t in enumerate(fitted):
            t = t[n - 1]
            at = np.searchsorted(union, t["key"])
            p[at, k] = t["direct"]
            weight[np.searchsorted(around, t["context"]), k] = t["back"]
            of[at] = np.searchsorted(around, t["context"])[t["place"]]
            if n > 1:
                lower[at] = np.searchsorted(keys[-1], t["below"])
        p += weight[of] * (1.0 / UNSEEN if n == 1 else below[lower])
        keys.append(union)
        logp.append(np.log(p).astype(np.float32))
        contexts.append(around)
        back.append(np.log(weight).astype(np.float32))
        below = p
    models = Models(
        langs, keys, logp, contexts, back, np.log(np.exp(back[0][0].astype(float)) / UNSEEN), 1.0, np.full(len(langs), np.inf)
    )
    held = [(k, t) for k, l in enumerate(langs) for j, t in enumerate(sample[l]) if j % held_share == 0]
    entropy, n_letters = models.entropies([t for _, t in held])
    truth = np.array([k for k, _ in held])
    held_on = n_letters > 0
    if held_on.any():
        entropy, truth = entropy[held_on], truth[held_on]
        grid = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]
        best = [np.log(confidence(entropy, t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
        models.temperature = grid[int(np.argmax(best))]
        for k in range(len(langs)):
            own = entropy[truth == k, k]
            if len(own) > 1:
                models.limit[k] = own.mean() + 4 * max(own.std(), 0.05)
    return models


def confidence(entropy: np.ndarray, temperature: float) -> np.ndarray:
    z = np.exp(-temperature * (entropy - entropy.min(1, keepdims=True)))
    return z / z.sum(1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample_of(known: DataFrame, per_language: int) -> DataFrame:
    """At most per_language rows (id, lang, text) of each language, those with the least hashes of their ids.

    Of rows that repeat an id in a language the least text counts. A bound on the hash, from about how many ids the
    language has, leaves so few of them that one task can rank them, whatever share of all rows a language has.
    """
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("id", 0.02).alias("n"))
    most = per_language + 8 * int(per_language**0.5) + 16
    place = F.shiftrightunsigned(F.xxhash64("id"), 1) / F.lit(float(1 << 63))
    some = known.withColumn("place", place).join(sizes, "lang").where(F.col("place") * F.col("n") <= most)
    one = some.groupBy("lang", "id", "place").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "id"))
    return one.withColumn("k", rank).where(F.col("k") <= per_language).select("id", "lang", "text")


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, per_language: int = 500,
    longest: int = 200_000
) -> DataFrame:
    """One row for each row of docs: (id, held_out, lang_pred, score, rejected).

    Models are fitted on at most per_language texts of each language, those with the least hashes of their ids among
    the rows that are not held out and have at most longest bytes; both together bound what the driver holds. The
    prediction is the language with the lowest cross-entropy for each character, ties in order of the name; score is its
    calibrated share; rejected says that even the best model finds the text stranger than all but a few of its own. A
    text that is null or has no letter is und with score 0. A null id is not held out, and not learned from. Whole texts
    are scored where they lie, with no shuffle. Repeated rows give repeated results; other columns are ignored. Without
    any language to learn, all is und.
    """
    spark = shipped(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang")
    )
    known = rows.where(
        ~held_out(F.col("id")) & F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") <= longest)
    )
    sample: dict[str, list[str]] = {}
    for r in sample_of(known, per_language).toArrow().sort_by([("lang", "ascending"), ("id", "ascending")]).to_pylist():
        sample.setdefault(r["lang"], []).append(r["text"])
    models = train_models(sample) if sample else None
    sent = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: Models | None = sent.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            best, score, odd = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            for lo, hi in groups([len(t or "") for t in texts]) if models else ():
                entropy, n_letters = models.entropies(texts[lo:hi])
                share, pick = confidence(entropy, models.temperature), entropy.argmin(1)
                for j in np.flatnonzero(n_letters > 0):
                    best[lo + j] = models.langs[pick[j]]
                    score[lo + j] = round(float(share[j, pick[j]]), 9)
                    odd[lo + j] = entropy[j, pick[j]] > models.limit[pick[j]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best), pa.array(score), pa.array(odd)],
                ["id", "held_out", "lang_pred", "score", "rejected"]
            )

    out = rows.select("id", held_out(F.col("id")).alias("held_out"), "text").mapInArrow(
        run, "id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )
    return out.withColumnRenamed("id", id_col)


def groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with about GROUP characters each; a longer text is alone."""
    lo = total = 0
    for k, n in enumerate(sizes):
        if total and total + n > GROUP:
            yield lo, k
            lo, total = k, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)
