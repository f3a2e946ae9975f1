"""Benchmark decontamination: the q-gram lemma finds regions that may hold a benchmark passage, banded alignment verifies them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.langid import characters, grams, groups
from acreage.llm.ship import shipped

#: Passages are compared in windows of so many characters.
WINDOW = 128
Q = 9
#: Edits allowed in a window, as a share of its length.
RATE = 0.05
#: From one window of a passage to the next: any part of a window's length is then off from one by no more than its edits.
STEP = 2 * int(WINDOW * RATE)
FILTER_BITS, PAIR_BITS = 22, 20
#: Benchmark items and bytes of them that are searched for at once; a larger benchmark is taken in blocks of about so many.
BLOCK, BLOCK_BYTES = 20_000, 16 << 20
#: Letters and digits that a passage must have to be searched for.
LEAST = 12
ALIGN_AT_ONCE = 4096

_ink: np.ndarray | None = None


def ink() -> np.ndarray:
    """Which code points are letters or digits; all others count as blanks."""
    global _ink
    if _ink is None:
        _ink = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _ink


def q_for(length: int) -> int:
    """The largest q up to Q for which the lemma still asks for half of a window's q-grams or more, if there is one."""
    edits = int(length * RATE)
    for q in range(min(Q, length), 2, -1):
        if 2 * (length - q + 1 - q * edits) >= length - q + 1 or q <= 4:
            return q
    return max(1, min(length, 3))


@dataclass
class Patterns:
    """The windows of the benchmark and, for each q in use, their q-grams as sorted hashes with postings."""

    codes: list[np.ndarray]
    items: np.ndarray
    edits: np.ndarray
    length: np.ndarray
    index: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    least: np.ndarray


def windows(text: str | None, least: int = LEAST) -> list[np.ndarray]:
    """The windows of a passage; none where it has fewer than least letters and digits."""
    codes, span, _ = characters([text], ink(), 0)
    codes = codes[span[0, 0] : span[0, 1]]
    while len(codes) and codes[-1] == 32:
        codes = codes[:-1]
    if (codes != 32).sum() < max(least, 1):
        return []
    if len(codes) <= WINDOW:
        return [codes]
    starts = [*range(0, len(codes) - WINDOW, STEP), len(codes) - WINDOW]
    return [codes[s : s + WINDOW] for s in starts]


def patterns_of(benchmark: list[tuple[int, str | None]], least: int = LEAST) -> Patterns:
    codes, items = [], []
    for item, text in benchmark:
        for w in windows(text, least):
            codes.append(w)
            items.append(item)
    length = np.array([len(c) for c in codes], np.int64)
    edits = (length * RATE).astype(np.int64)
    qs = np.array([q_for(int(n)) for n in length], np.int64)
    index = {}
    for q in sorted({*qs.tolist()}):
        own = np.flatnonzero(qs == q)
        hashes = [grams(codes[p], q)[q - 1 :] for p in own]
        flat = np.concatenate(hashes)
        pattern, place = np.repeat(own, [len(h) for h in hashes]), np.concatenate([np.arange(len(h)) for h in hashes])
        order = np.argsort(flat, kind="stable")
        keys, first = np.unique(flat[order], return_index=True)
        maybe = np.zeros(1 << FILTER_BITS, bool)
        maybe[keys >> np.uint64(64 - FILTER_BITS)] = True
        index[q] = (keys, np.append(first, len(flat)), pattern[order], place[order], maybe)
    return Patterns(codes, np.array(items, np.int64), edits, length, index, np.maximum(length - qs + 1 - qs * edits, 1))


def candidates(p: Patterns, codes: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, pattern, first diagonal, width) of the diagonal bands with enough shared q-grams.

    Bands are two steps of edits + 1 diagonals wide and overlap by one step, so any match within its edits lies in one.
    Pairs of text and pattern with too few shared q-grams on all diagonals together are left out first.
    """
    found = []
    text_of = np.repeat(np.arange(len(spans)), spans[:, 1] - spans[:, 0])
    begin = spans[:, 0]
    live = np.repeat(
        begin - (np.cumsum(spans[:, 1] - begin) - (spans[:, 1] - begin)), spans[:, 1] - begin
    ) + np.arange(len(text_of))
    for q, (keys, first, pattern, place, maybe) in p.index.items():
        h = grams(codes, q)[live]
        at = np.flatnonzero(maybe[h >> np.uint64(64 - FILTER_BITS)])
        at = at[live[at] - begin[text_of[at]] >= q - 1]
        k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
        hit = keys[k] == h[at]
        at, k = at[hit], k[hit]
        n = first[k + 1] - first[k]
        src = np.repeat(first[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        who, text = pattern[src], np.repeat(text_of[at], n)
        pair = (text * len(p.codes) + who) & ((1 << PAIR_BITS) - 1)
        enough = np.flatnonzero(np.bincount(pair, minlength=1)[pair] >= p.least[who])
        who, text, where = who[enough], text[enough], place[src[enough]]
        diagonal = np.repeat(live[at] - (q - 1), n)[enough] - where
        step = p.edits[who] + 1
        band = diagonal // step
        who, text, band, step = (np.concatenate([x, x]) for x in (who, text, band, step))
        band[len(band) // 2 :] -= 1
        order = np.lexsort((band, who, text))
        who, text, band, step = who[order], text[order], band[order], step[order]
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (text[1:] != text[:-1]) | (band[1:] != band[:-1])
        head = np.flatnonzero(new)
        many = np.diff(np.append(head, len(who)))
        head = head[many >= p.least[who[head]]]
        found.append((text[head], who[head], band[head] * step[head], 2 * step[head]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4


def aligned(
    p: Patterns, codes: np.ndarray, spans: np.ndarray, text: np.ndarray, who: np.ndarray, first: np.ndarray, width: np.ndarray
) -> np.ndarray:
    """The least edits with which each pattern lies along the diagonals of its band, all bands at once.

    Row i of the alignment only has the columns of the band, widened by the edits on both sides; what leaves it costs
    more than the edits allow.
    """
    e = p.edits[who]
    lo, wide = first - e, int((width + 2 * e).max()) + 1
    rows = int(p.length[who].max())
    pattern = np.zeros((len(who), rows), np.uint64)
    for k, w in enumerate(who):
        pattern[k, : p.length[w]] = p.codes[w]
    at = lo[:, None] + np.arange(wide)[None, :]
    begin, end = spans[text, 0][:, None], spans[text, 1][:, None]
    shift = np.arange(wide, dtype=np.int32)[None, :]
    cost = np.where((at >= begin) & (at <= end), 0, 1 << 20).astype(np.int32)
    best = np.full(len(who), 1 << 20, np.int32)
    padded = np.append(codes, np.uint64(0))
    for i in range(rows):
        place = at + i
        inside = (place >= begin) & (place < end)
        same = padded[np.clip(place, 0, len(codes))] == pattern[:, i][:, None]
        step = cost + np.where(inside, 1 - same.astype(np.int32), 1 << 20)
        drop = np.append(cost[:, 1:], np.full((len(who), 1), 1 << 20, np.int32), 1) + 1
        step = np.minimum(np.minimum(step, drop), 1 << 20)
        cost = np.minimum.accumulate(step - shift, 1) + shift
        done = p.length[who] == i + 1
        if done.any():
            best[done] = cost[done].min(1)
    return best


def within(pattern: np.ndarray, codes: np.ndarray) -> bool:
    """Whether the code points of pattern stand next to each other in codes."""
    part, whole, at = pattern.tobytes(), codes.tobytes(), -1
    while (at := whole.find(part, at + 1)) >= 0:
        if at % codes.itemsize == 0:
            return True
    return False


def contaminated(p: Patterns, texts: list[str | None]) -> list[list[int]]:
    """The sorted items of which a window lies in each text."""
    out: list[list[int]] = [[] for _ in texts]
    for lo, hi in groups([len(t or "") for t in texts]):
        codes, spans, _ = characters(texts[lo:hi], ink(), Q)
        text, who, first, width = candidates(p, codes, spans)
        got: set[tuple[int, int]] = set()
        rest = []
        for k in range(len(text)):
            pair = (int(text[k]), int(p.items[who[k]]))
            if pair in got:
                continue
            n = p.length[who[k]]
            a, b = max(int(first[k]), int(spans[text[k], 0])), min(int(first[k] + width[k] + n), int(spans[text[k], 1]))
            if within(p.codes[who[k]], codes[a:b]):
                got.add(pair)
            else:
                rest.append(k)
        rest = np.array([k for k in rest if (int(text[k]), int(p.items[who[k]])) not in got], np.int64)
        for s in range(0, len(rest), ALIGN_AT_ONCE):
            some = rest[s : s + ALIGN_AT_ONCE]
            best = aligned(p, codes, spans, text[some], who[some], first[some], width[some])
            for k in some[best <= p.edits[who[some]]]:
                got.add((int(text[k]), int(p.items[who[k]])))
        for t, item in sorted(got):
            out[lo + t].append(item)
    return out


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    passage_col: str = "text", *, block: int = BLOCK, least: int = LEAST
) -> DataFrame:
    """One row for each row of docs: (id, contaminated, n_items, items).

    items lists, by id and joined by commas, the benchmark items of which a whole window lies in the text with at most
    RATE edits for each of its characters; an item no longer than a window is one window. The shortest excerpt of a longer
    item that is sure to be found is WINDOW characters if it is verbatim, WINDOW + STEP - 1 with RATE edits in any part of
    a window's length; a shorter one isn't searched for. Case, blanks and signs don't
    count. A passage with fewer than least letters and digits would be found in nearly every text, so it isn't searched
    for; short_items lists these. The benchmark is the query set: it goes to the workers in blocks of about block items and
    BLOCK_BYTES, whatever its size, and every whole text is searched where it lies. With one block nothing is shuffled;
    with more, only hits are. Null texts and null or empty passages match nothing. Repeated rows of docs give repeated results, and items with the same
    id are one item; a null id of a benchmark item is ignored. An empty benchmark leaves all documents clean.
    """
    spark = shipped(docs.sparkSession)
    blocks = item_blocks(benchmark, item_col, passage_col, block, least)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def search(patterns: Patterns) -> DataFrame:
        sent = spark.sparkContext.broadcast(patterns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = contaminated(sent.value, batch.column(1).to_pylist()) if sent.value.index else [[]] * len(batch)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "found"])

        return rows.mapInArrow(run, "id long, found array<long>")

    parts = [search(p) for p in blocks]
    if len(parts) == 1:
        out = parts[0]
    else:
        hits = reduce(DataFrame.union, parts).select("id", F.explode("found").alias("item")).distinct().groupBy(F.col("id").alias("hit")).agg(
            F.array_sort(F.collect_list("item")).alias("found")
        )
        out = rows.select("id").join(hits, F.col("id").eqNullSafe(F.col("hit")), "left").select(
            "id", F.coalesce("found", F.array().cast("array<bigint>")).alias("found")
        )
    return out.select(
        F.col("id").alias(id_col), (F.size("found") > 0).alias("contaminated"), F.size("found").cast("long").alias("n_items"),
        F.array_join("found", ",").alias("items")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", passage_col: str = "text", *,
    block: int = BLOCK, least: int = LEAST
) -> DataFrame:
    """The rows of docs, with all their columns, that decontaminate finds clean. Rows are filtered where they lie, block after block."""
    spark = shipped(docs.sparkSession)
    place = docs.columns.index(text_col)

    def clean(docs: DataFrame, patterns: Patterns) -> DataFrame:
        sent = spark.sparkContext.broadcast(patterns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = contaminated(sent.value, batch.column(place).to_pylist()) if sent.value.index else [[]] * len(batch)
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)

    return reduce(clean, item_blocks(benchmark, item_col, passage_col, block, least), docs)


def item_blocks(benchmark: DataFrame, item_col: str, passage_col: str, block: int, least: int) -> Iterator[Patterns]:
    """The benchmark's patterns, in blocks of about block items and BLOCK_BYTES; there is at least one block, even if it is empty."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.col(passage_col).cast("string").alias("passage")
    ).where("item is not null")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("passage")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // block), -(-size.bytes // BLOCK_BYTES))
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "passage"), F.lit(blocks)) == k)
        yield patterns_of([(r.item, r.passage) for r in part.orderBy("item", "passage").collect()], least)


def short_items(benchmark: DataFrame, item_col: str = "item_id", passage_col: str = "text", *, least: int = LEAST) -> DataFrame:
    """The rows (item, passage) of the benchmark that are too short to be searched for."""
    signs = F.length(F.regexp_replace(F.coalesce(F.col(passage_col), F.lit("")), r"[^\p{L}\p{N}]", ""))
    return benchmark.select(item_col, passage_col).where(signs < least)
