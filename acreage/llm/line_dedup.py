"""Line deduplication as an exact set-similarity join: rarity order, prefix, positional and length filters, verified Jaccard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.bitmap import bitmap, holds
from acreage.llm.scratch import stage
from acreage.llm.ship import shipped
from acreage.llm.words import mix, pair_hash, utf8, word_hashes

#: Two lines match at a Jaccard similarity of NUM / DEN or more.
NUM, DEN = 4, 5
#: Token counts are kept by so many bits of the token's hash. The order of tokens follows them; any order is right, rarity makes it fast.
RARITY_BITS, CHUNK = 20, 1 << 12
#: What is held of a line besides its rarest tokens: two digests of its set, where it stands, the set's size and a bitmap.
LINE = np.dtype([("k1", "u8"), ("k2", "u8"), ("id", "i8"), ("line", "i4"), ("size", "i4"), ("low", "u8"), ("high", "u8")])
#: Columns of a posting: the key of its run, the line, the set's size, the token's place in it, the bitmap.
POSTING = ("u8", "i8", "i4", "i4", "i4", "u8", "u8")
#: Lines and postings travel packed, in buckets of about so many words of text; tasks send what they hold at so many bytes.
BUCKET, FLUSH = 1 << 20, 1 << 23
#: A token with more postings is dealt out by pairs of blocks of about so many lines.
RUN = 1 << 16
#: A line first meets FIRST earlier lines that pass the filters for a token; all others only if none of these matches it.
FIRST = 8
PAIR = "a_id long, a_line int, b_id long, b_line int"
NEWLINE = 10
#: Texts are taken in groups of about so many bytes.
GROUP = 1 << 19


def line_tokens(
    column: pa.Array, asked: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of texts: (first text, text of each line, number of each line in its text, line of each word, hashes).

    With asked(text of the column, number), only the words of the lines for which it is true are given.
    """
    data, cuts = utf8(column)
    lo = 0
    while lo < len(cuts) - 1:
        hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + GROUP, "right")) - 1)
        part, at = data[cuts[lo] : cuts[hi]], cuts[lo : hi + 1] - cuts[lo]
        breaks = np.flatnonzero(part == NEWLINE) + 1
        begin = np.sort(np.concatenate([at[:-1], breaks]), kind="stable")
        text = np.searchsorted(at[:-1], begin, "right") - 1
        # texts without a byte share their begin with the next one: the k-th of equal begins belongs to the k-th such text
        same = np.concatenate([[0], np.cumsum(begin[1:] != begin[:-1])]) if len(begin) else begin
        nth = np.arange(len(begin)) - np.searchsorted(same, same)
        many = np.bincount(same)[same] if len(begin) else begin
        text = text - (many - 1 - nth)
        number = np.arange(len(text)) - np.searchsorted(text, text)
        if asked is not None:
            size = np.diff(np.append(begin, len(part)))
            on = asked(lo + text, number)
            text, number, size, begin = text[on], number[on], size[on], begin[on]
            part = part[ragged(begin, size)]
            begin = np.cumsum(size) - size
        starts, words = word_hashes(part, np.unique(begin))
        line = np.repeat(np.arange(len(begin)), np.diff(np.append(np.searchsorted(starts, begin), len(starts))))
        yield lo, text, number, line, words
        lo = hi


def distinct_tokens(line: np.ndarray, words: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, token) without repeats, the tokens of each line from rare to frequent."""
    order = None
    if len(line) and line[-1] < 1 << 20:
        key = (line.astype(np.uint64) << np.uint64(44)) | (
            rank[words >> np.uint64(64 - RARITY_BITS)].astype(np.uint64) << np.uint64(32)
        ) | ((words >> np.uint64(8)) & np.uint64(0xFFFFFFFF))
        order = np.argsort(key)
        key, by = key[order], words[order]
        if ((key[1:] == key[:-1]) & (by[1:] != by[:-1])).any():
            order = None  # two tokens of a line share a key: sort by the whole hash
    if order is None:
        order = np.lexsort(
            (words, (words >> np.uint64(8)) & np.uint64(0xFFFFFFFF), rank[words >> np.uint64(64 - RARITY_BITS)], line)
        )
    line, words = line[order], words[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (words[1:] != words[:-1])
    return line[new], words[new]


def hash_counts(rows: DataFrame, hashes) -> np.ndarray:
    """How often each hash bucket of 2**RARITY_BITS occurs among the hashes that hashes(batch) gives.

    Each task sends its counts as blocks of a table of fixed size, so what is gathered doesn't depend on the vocabulary.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        held, size = [], 0
        for words in (words for batch in batches for words in hashes(batch)):
            held.append((words >> np.uint64(64 - RARITY_BITS)).astype(np.int64))
            size += len(words)
            if size > len(total):
                total += np.bincount(np.concatenate(held), minlength=len(total))
                held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        blocks = total.reshape(-1, CHUNK)
        some = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([blocks[k].tobytes() for k in some], pa.binary())], ["block", "counts"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in table["counts"])
        return pa.table({"block": table["block"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    got = rows.mapInArrow(
        count, "block int, counts binary"
    ).groupBy("block").applyInArrow(add, "block int, counts binary").collect()
    out = np.zeros(1 << RARITY_BITS, np.int64)
    for r in got:
        out[r.block * CHUNK : (r.block + 1) * CHUNK] = np.frombuffer(r.counts, np.int64)
    return out


def token_ranks(counts: np.ndarray) -> np.ndarray:
    """A rank from rare to frequent for each hash bucket: 12 bits that grow with the count's logarithm."""
    power = np.floor(np.log2(counts + 1)).astype(np.int64)
    return np.minimum(power * 64 + ((counts + 1) * 64 >> power) - 64, 4095).astype(np.uint16)


def prefix_size(size: np.ndarray) -> np.ndarray:
    """How many of its rarest tokens a set of this size shares at least one of with any set that is similar to it."""
    return size - -(-size * NUM // DEN) + 1


def ragged(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1 and so on, many[k] of them for each k."""
    end = np.cumsum(many)
    return np.repeat(first - (end - many), many) + np.arange(int(end[-1]) if len(end) else 0)


def earliest(lines: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lines with equal sets the earliest, with its prefix; prefix has those of all lines end to end."""
    order = np.lexsort((lines["line"], lines["id"], lines["k2"], lines["k1"]))
    k1, k2 = lines["k1"][order], lines["k2"][order]
    order = order[np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))[: len(order)]]
    return taken(lines, prefix, order)


def taken(lines: np.ndarray, prefix: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    many = prefix_size(lines["size"].astype(np.int64))
    first = np.cumsum(many) - many
    return lines[order], prefix[ragged(first[order], many[order])]


def line_table(rows: DataFrame, ranks: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, lines, prefix): of all lines with a token, those with the same set once, packed by a digest of the set.

    In a line's bitmap each token flips one of 128 bits, so two sets whose bitmaps differ in d bits differ in d tokens at
    least. Tasks leave out repeated sets before they send, so a line that very many documents share is few rows.
    """
    sent = rows.sparkSession.sparkContext.broadcast(ranks)
    kind = "bucket int, lines binary, prefix binary"

    def batch_of(buckets_of: list[int], lines: list[np.ndarray], prefix: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(buckets_of, pa.int32()), pa.array([x.tobytes() for x in lines], pa.binary()),
                pa.array([x.tobytes() for x in prefix], pa.binary())
            ],
            ["bucket", "lines", "prefix"]
        )

    def dealt(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        lines, prefix = earliest(*map(np.concatenate, zip(*held, strict=True)))
        bucket = (lines["k1"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        lines, prefix = taken(lines, prefix, order)
        bucket = bucket[order]
        cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        ends = np.cumsum(prefix_size(lines["size"].astype(np.int64)))[cut - 1]
        return batch_of(bucket[np.append(0, cut)].tolist(), np.split(lines, cut), np.split(prefix, ends))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, text, number, line, words in line_tokens(batch.column(1)):
                line, words = distinct_tokens(line, words, sent.value)
                if not len(line):
                    continue
                head = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
                at = line[head]
                out = np.zeros(len(head), LINE)
                out["size"] = np.diff(np.append(head, len(line)))
                out["id"], out["line"] = ids[lo + text[at]], number[at]
                out["k1"], out["k2"] = np.add.reduceat(
                    mix(words ^ np.uint64(1)), head
                ), np.add.reduceat(mix(words ^ np.uint64(2)), head)
                flip, upper = np.uint64(1) << (words & np.uint64(63)), (words & np.uint64(64)) != 0
                out["low"], out["high"] = (
                    np.bitwise_xor.reduceat(np.where(half, flip, np.uint64(0)), head) for half in (~upper, upper)
                )
                held.append((out, words[ragged(head, prefix_size(out["size"].astype(np.int64)))]))
                size += sum(x.nbytes for x in held[-1])
                if size >= FLUSH:
                    yield dealt(held)
                    held, size = [], 0
        if held:
            yield dealt(held)

    def merge(table: pa.Table) -> pa.Table:
        lines, prefix = (
            np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table[c]]) for c,
            t in (("lines", LINE), ("prefix", np.uint64))
        )
        return pa.Table.from_batches([batch_of([table["bucket"][0].as_py()], *([x] for x in earliest(lines, prefix)))])

    return rows.select("id", "text").mapInArrow(scan, kind).groupBy("bucket").applyInArrow(merge, kind)


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for lines, prefix in zip(batch.column("lines"), batch.column("prefix"), strict=True):
        yield np.frombuffer(lines.as_buffer(), LINE), np.frombuffer(prefix.as_buffer(), np.uint64)


def refs_of(lines: DataFrame) -> DataFrame:
    """(id, line) of each packed line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, _ in unpacked(batch):
                yield pa.RecordBatch.from_arrays([pa.array(held["id"]), pa.array(held["line"])], ["id", "line"])

    return lines.select("lines", "prefix").mapInArrow(run, "id long, line int")


def run_pairs(
    key: np.ndarray, ids: np.ndarray, line: np.ndarray, size: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray,
    first: int | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(earlier, later) of lines in the same run that pass the filters, as places in the columns, and whether partners were left out.

    The lowest bits of a key tell the line's side (0: all meet; 1, 2: only lines of different sides do) and whether it
    looks for partners; the rest names the run. Runs are put in order of size, so that by the length filter a line meets
    those before it from some place on. Then come the positional filter (how many tokens are left behind the shared one)
    and that of the bitmaps. With first, each later line gets that many partners in a run, and a mark where there are more.
    """
    run, wide = key >> np.uint64(20), size.astype(np.uint64)
    small = not len(size) or int(size.max()) < 1 << 20
    order = np.argsort(run << np.uint64(20) | wide) if small else np.lexsort((size, run))
    run, size, low, high, ids, line = run[order], size[order], low[order], high[order], ids[order], line[order]
    rest = size - at[order]
    side, probe = (key[order] >> np.uint64(1)) & np.uint64(3), (key[order] & np.uint64(1)) == 1
    least = -(-size.astype(np.int64) * NUM // DEN)
    if small:
        start = np.searchsorted(run << np.uint64(20) | size.astype(np.uint64), run << np.uint64(20) | least.astype(np.uint64))
    else:
        head = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        ends = np.append(head[1:], len(run))
        start = np.concatenate([h + np.searchsorted(size[h:e], least[h:e]) for h, e in zip(head, ends, strict=True)])
    before = np.arange(len(run)) - start
    some = np.flatnonzero(before > 0)
    upto = np.cumsum(before[some])
    had = np.zeros(len(run), np.int64)  # partners of each line so far
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    lo = 0
    while lo < len(some):  # in pieces of about so many pairs
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + (1 << 18), "right")))
        j, n = some[lo:hi], before[some[lo:hi]]
        lo = hi
        i, j = ragged(start[j], n), np.repeat(j, n)
        both = size[i] + size[j]
        ok = np.flatnonzero(np.minimum(rest[i], rest[j]) * (NUM + DEN) >= NUM * both)
        i, j, both = i[ok], j[ok], both[ok]
        flips = np.bitwise_count(low[i] ^ low[j]).astype(np.int32) + np.bitwise_count(high[i] ^ high[j])
        swap = (ids[i] > ids[j]) | ((ids[i] == ids[j]) & (line[i] > line[j]))
        a, b = np.where(swap, j, i), np.where(swap, i, j)
        ok = (
            (both - flips) // 2 * (NUM + DEN) >= NUM * both
        ) & ((ids[i] != ids[j]) | (line[i] != line[j])) & ((side[i] == 0) | (side[i] != side[j])) & probe[b]
        a, b, more = a[ok], b[ok], np.zeros(int(ok.sum()), bool)
        if first is not None and len(b):
            by = np.lexsort((line[a], ids[a], b))
            a, b = a[by], b[by]
            new = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            many = np.diff(np.append(new, len(b)))
            nth = np.arange(len(b)) - np.repeat(new, many) + had[b]
            had[b[new]] += many
            a, b, more = a[nth <= first], b[nth <= first], (nth == first)[nth <= first]
        got.append((order[a], order[b], more))
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*got, strict=True))


def candidate_pairs(
    lines: DataFrame, buckets: int, counts: np.ndarray, first: int | None, asked: tuple[np.ndarray, np.ndarray] | None = None
) -> DataFrame:
    """Distinct (a_id, a_line, b_id, b_line, more): earlier and later lines that share a token and pass the filters.

    Postings of the packed lines go to buckets by token. counts holds for each hash bucket of tokens how many postings it
    has at least; where that is above RUN, the token's lines are dealt to blocks by their hash and every pair of blocks is
    a run of its own, so that no task holds all lines of a frequent token. With first, rows with more set say that the
    line b has further partners. asked holds filters of lines and tokens: only such lines look for partners, by such tokens.
    """
    hot = -(-counts // RUN)
    sent = lines.sparkSession.sparkContext.broadcast((np.flatnonzero(hot > 1), hot[hot > 1], asked))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_at, hot_n, asked = sent.value
        blocks = np.ones(1 << RARITY_BITS, np.int64)
        blocks[hot_at] = hot_n
        held, total = [], 0

        def dealt() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            bucket = ((columns[0] >> np.uint64(3)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns, bucket = [c[order] for c in columns], bucket[order]
            cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
            packed = [pa.array([x.tobytes() for x in np.split(c, cut)], pa.binary()) for c in columns]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[np.append(0, cut)].astype(np.int32)), *packed],
                ["bucket", *[f"c{k}" for k in range(len(packed))]]
            )

        for batch in batches:
            for own, prefix in unpacked(batch):
                many = prefix_size(own["size"].astype(np.int64))
                of, at = np.repeat(np.arange(len(own)), many), ragged(np.zeros(len(own), np.int64), many)
                probe = np.ones(len(own), bool)
                if asked is not None:
                    probe = holds(asked[0], pair_hash(own["id"], own["line"].astype(np.int64)))
                    some = np.flatnonzero(holds(asked[1], prefix))
                    of, at, prefix = of[some], at[some], prefix[some]
                n = blocks[prefix >> np.uint64(64 - RARITY_BITS)]
                mine = mix(own["k1"])[of] % n.astype(np.uint64)
                other = ragged(np.zeros(len(n), np.int64), n).astype(np.uint64)
                of, at, prefix, mine = (np.repeat(x, n) for x in (of, at, prefix, mine))
                low, high = np.minimum(mine, other), np.maximum(mine, other)
                key = mix(prefix + mix(low << np.uint64(32) | high)) << np.uint64(3)
                key |= np.where(mine == other, 0, np.where(mine < other, 2, 4)).astype(np.uint64) | probe[of].astype(np.uint64)
                for lo in range(0, len(of), 1 << 17):
                    part = of[lo : lo + (1 << 17)]
                    held.append(
                        [
                            key[lo : lo + (1 << 17)], own["id"][part], own["line"][part], own["size"][part],
                            at[lo : lo + (1 << 17)].astype(np.int32), own["low"][part], own["high"][part]
                        ]
                    )
                    total += sum(c.nbytes for c in held[-1])
                    if total >= FLUSH:
                        yield dealt()
                        held, total = [], 0
        if held:
            yield dealt()

    def meet(table: pa.Table) -> pa.Table:
        columns = [np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table[f"c{k}"]]) for k, t in enumerate(POSTING)]
        a, b, more = run_pairs(*columns, first)
        return pa.table(
            {"a_id": columns[1][a], "a_line": columns[2][a], "b_id": columns[1][b], "b_line": columns[2][b], "more": more}
        )

    columns = ", ".join(f"c{k} binary" for k in range(len(POSTING)))
    met = lines.select("lines", "prefix").mapInArrow(
        post, f"bucket int, {columns}"
    ).groupBy("bucket").applyInArrow(meet, f"{PAIR}, more boolean")
    return met.distinct()


def line_bits(refs: DataFrame) -> np.ndarray:
    """A filter of lines (id, line)."""
    return bitmap(refs.select("id", F.col("line").cast("long")))


def tokens_of(rows: DataFrame, refs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(id, line, tokens) of the asked lines, from another scan of the texts that skips documents without any."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((ranks, bitmap(refs.select("id")), line_bits(refs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, documents, places = sent.value
        for batch in batches:
            batch = batch.filter(pa.array(holds(documents, batch.column(0).to_numpy(zero_copy_only=False))))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, text, number, line, words in line_tokens(  # noqa: B023
                batch.column(1), lambda text, number: holds(places, pair_hash(ids[text], number))
            ):
                line, words = distinct_tokens(line, words, ranks)
                if len(line):
                    head = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
                    at = line[head]
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.append(head, len(line)), pa.int32()), pa.array(words.view(np.int64))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[lo + text[at]]), pa.array(number[at].astype(np.int32)), lists], ["id", "line", "tokens"]
                    )

    return rows.select("id", "text").mapInArrow(
        run, "id long, line int, tokens array<long>"
    ).join(refs, ["id", "line"], "left_semi").distinct()


def similar(a: Column, b: Column) -> Column:
    """Whether two sets of tokens have the Jaccard similarity, in whole numbers."""
    return F.size(F.array_intersect(a, b)) * (NUM + DEN) >= NUM * (F.size(a) + F.size(b))


def confirmed(pairs: DataFrame, rows: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(id, line) of the later lines of those pairs whose whole sets have the similarity."""
    end = lambda x: pairs.select(F.col(f"{x}_id").alias("id"), F.col(f"{x}_line").alias("line"))
    refs = stage(end("a").union(end("b")).distinct(), "refs")
    sets = stage(tokens_of(rows, refs, ranks), "sets")
    held = lambda x: sets.select(F.col("id").alias(f"{x}_id"), F.col("line").alias(f"{x}_line"), F.col("tokens").alias(f"t{x}"))
    both = pairs.join(held("a"), ["a_id", "a_line"]).join(held("b"), ["b_id", "b_line"])
    return stage(
        both.where(similar(F.col("ta"), F.col("tb"))).select(
            F.col("b_id").alias("id"), F.col("b_line").alias("line")
        ).distinct(),
        "matched"
    )


def matched_lines(pairs: DataFrame, rows: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(id, line) of the lines that some pair confirms: each with its earliest partner first, with the others if that fails."""
    first = stage(
        pairs.groupBy("b_id", "b_line").agg(
            F.min(F.struct("a_id", "a_line")).alias("a")
        ).select("a.a_id", "a.a_line", "b_id", "b_line"),
        "first"
    )
    matched = confirmed(first, rows, ranks)
    over = matched.select(F.col("id").alias("b_id"), F.col("line").alias("b_line"))
    rest = stage(pairs.join(first, pairs.columns, "left_anti").join(over, ["b_id", "b_line"], "left_anti"), "rest")
    return matched if rest.isEmpty() else matched.union(confirmed(rest, rows, ranks))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept): for each document that keeps lines with a token, the sorted numbers of these lines.

    A line's set is its words, split at ASCII blanks, with A-Z as a-z. A line goes if an earlier line (by id, then
    number) of any document has a Jaccard similarity of NUM / DEN or more to it, whether or not that one stays itself.
    Equal sets are met once: their first line stands for all. Rows with a null id or text take no part. Rows that repeat
    an id share its line numbers: where their lines differ, a number stays for all of them if one is the earliest line of
    its set and none has a match. An empty table gives no rows.
    """
    shipped(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    ).where("id is not null and text is not null")
    counts = hash_counts(rows.select("text"), lambda batch: (words for *_, words in line_tokens(batch.column(0))))
    ranks, buckets = token_ranks(counts), max(64, int(counts.sum()) // BUCKET)
    lines = stage(line_table(rows, ranks, buckets), "lines")
    posted = hash_counts(lines.select("lines", "prefix"), lambda batch: (prefix for _, prefix in unpacked(batch)))
    found = stage(candidate_pairs(lines, buckets, posted, FIRST), "pairs")
    pairs = found.where("not more").drop("more")
    matched = matched_lines(pairs, rows, ranks)
    # Lines with more partners than were met, none of which matched, meet all of them.
    left = stage(
        found.where("more").select(
            F.col("b_id").alias("id"), F.col("b_line").alias("line")
        ).distinct().join(matched, ["id", "line"], "left_anti"),
        "left"
    )
    if not left.isEmpty():
        asked = line_bits(left)
        again = candidate_pairs(lines, buckets, posted, None, (asked, token_bits(lines, asked))).drop("more")
        matched = matched.union(matched_lines(stage(again.join(pairs, pairs.columns, "left_anti"), "pairs"), rows, ranks))
    kept = refs_of(lines).join(matched, ["id", "line"], "left_anti")
    return kept.groupBy("id").agg(F.array_sort(F.collect_set("line")).alias("kept")).select(F.col("id").alias(id_col), "kept")


def token_bits(lines: DataFrame, asked: np.ndarray) -> np.ndarray:
    """A filter of the tokens by which the asked lines can be met."""
    sent = lines.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, prefix in unpacked(batch):
                on = holds(sent.value, pair_hash(own["id"], own["line"].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.unique(prefix[np.repeat(on, prefix_size(own["size"].astype(np.int64)))]).view(np.int64))],
                    ["token"]
                )

    return bitmap(lines.select("lines", "prefix").mapInArrow(run, "token long"))


def worded(text: Column) -> Column:
    """The numbers from 0 of the lines with a word."""
    numbers = F.transform(F.split(text, "\n", -1), lambda x, i: F.when(x.rlike(r"[^ \t\n\x0b\f\r]"), i))
    return F.filter(numbers, lambda i: i.isNotNull())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (id, n_lines, n_removed, removed).

    removed lists, joined by commas, the numbers from 0 of the lines that go; see kept_lines for which. Lines without a
    word always stay; a null text has no lines, a null id loses none.
    """
    kept = kept_lines(docs, id_col, text_col).select(F.col(id_col).alias("_id"), "kept")
    n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n", -1)))
    none = F.array().cast("array<int>")
    lines = docs.select(
        F.col(id_col), n.cast("long").alias("n_lines"),
        F.when(F.col(text_col).isNull() | F.col(id_col).isNull(), none).otherwise(worded(F.col(text_col))).alias("_worded")
    )
    gone = F.array_except("_worded", F.coalesce("kept", none))
    return lines.join(kept, F.col(id_col).cast("long") == F.col("_id"), "left").select(
        id_col, "n_lines", F.size(gone).cast("long").alias("n_removed"), F.array_join(gone, ",").alias("removed")
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, without the lines that go by kept_lines.

    A document that had lines with words and keeps none of them goes as a whole; all others stay, whatever their text.
    """
    kept = kept_lines(docs, id_col, text_col).select(F.col(id_col).alias("id"), F.col("kept"))
    both = docs.select(F.struct(*docs.columns).alias("row")).join(
        kept, F.col(f"row.{id_col}").cast("long") == F.col("id"), "left"
    )
    text, none = F.col(f"row.{text_col}"), F.array().cast("array<int>")
    untouched = text.isNull() | F.col(f"row.{id_col}").isNull()
    both = both.select("row", F.coalesce("kept", none).alias("kept"), F.when(untouched, none).otherwise(worded(text)).alias("worded"))
    both = both.where((F.size("worded") == 0) | (F.size("kept") > 0)).withColumn("gone", F.array_except("worded", "kept"))
    # A column of its own: within the lambda the text would be split again for every line.
    both = both.withColumn("lines", F.when(F.size("gone") > 0, F.split(text, "\n", -1)))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    stay = F.transform(numbers, lambda i: F.get("lines", i))
    text = F.when(F.size("gone") == 0, text).otherwise(F.array_join(stay, "\n"))
    return both.select(*[text.alias(c) if c == text_col else F.col(f"row.{c}").alias(c) for c in docs.columns])
