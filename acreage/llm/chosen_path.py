"""N-gram Jaccard join along chosen paths: sets are split on sampled shared tokens until buckets are small, several times over."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.bitmap import bitmap, holds
from acreage.llm.components import components
from acreage.llm.exact_dedup import slots_for
from acreage.llm.scratch import stage
from acreage.llm.ship import shipped
from acreage.llm.words import FACTOR, mix, owner, utf8, word_hashes

#: Two documents are linked at a Jaccard similarity of NUM / DEN or more of their sets of SHINGLE words.
NUM, DEN, SHINGLE = 4, 5, 5
#: Sampled tokens of each set: the least shingles under so many orders. A path goes along BRANCH of them from each node.
TOKENS, BRANCH = 32, 2
#: Buckets of at most so many are compared; larger ones are split again, at most DEEPEST times.
BUCKET, DEEPEST = 32, 3
#: Of TOKENS places, in how many two sketches must agree to count as near copies when a large bucket is looked at.
ALIKE = 20
#: Runs before what they have brought together counts as one.
EARLY = 1
#: In fewer places than this, of TOKENS, sketches of a linked pair agree hardly ever: runs_for takes that in.
LIKELY = 14
#: Documents, and words of them, that are compared in one task; candidates that hang together in greater number are dealt
#: out by pairs of blocks of about so many. A task looks at about so many CELLS at once.
BLOCK, BLOCK_WORDS, CELLS = 2000, 1 << 20, 1 << 20
GROUP = 1 << 19


def choices(runs: int) -> list[tuple[int, int, int]]:
    """(run, token of the root, token after it) of the first two levels: BRANCH tokens of the root, and BRANCH others after each."""
    chosen = np.random.default_rng(20)
    out = []
    for r in range(runs):
        for i in chosen.choice(TOKENS, BRANCH, replace=False):
            for j in chosen.choice([k for k in range(TOKENS) if k != i], BRANCH, replace=False):
                out.append((r, int(i), int(j)))
    return out


def missed(runs: int, samples: int = 4000) -> float:
    """Chance that a pair right at the threshold meets in no bucket when all its buckets are split DEEPEST times.

    Each token is shared with probability NUM / DEN, and all paths go along the same TOKENS: the chance is summed over how
    many of them are shared, with samples of which. Given these, paths die out on their own below the first two levels.
    """
    paths = np.array(choices(runs))
    rng = np.random.default_rng(21)
    total = 0.0
    for m in range(TOKENS + 1):
        shared = np.argsort(rng.random((samples, TOKENS)), 1) < m
        alive = (shared[:, paths[:, 1]] & shared[:, paths[:, 2]]).sum(1)
        dead, second = 0.0, (1 - 1 / TOKENS) / NUM
        for _ in range(DEEPEST):
            ends = 1 - m / TOKENS * (1 - dead)
            dead = (1 - second) * ends + second * ends**2
        total += math.comb(TOKENS, m) * NUM**m * (DEN - NUM) ** (TOKENS - m) / DEN**TOKENS * float(np.mean(dead**alive))
    return total


def unlike() -> float:
    """Chance that the sketches of a pair right at the threshold agree in fewer than LIKELY places."""
    return sum(math.comb(TOKENS, m) * NUM**m * (DEN - NUM) ** (TOKENS - m) for m in range(LIKELY)) / DEN**TOKENS


@cache
def runs_for(recall: float) -> int:
    """Runs until a pair right at the threshold is found with this probability.

    It has to meet in some bucket, through all DEEPEST splits, and to be alike in LIKELY places.
    """
    return next(runs for runs in count(1) if missed(runs) + unlike() <= 1 - recall)


def text_groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For groups of texts: (first text, where the words of each begin, word hashes)."""
    data, cuts = utf8(column)
    lo = 0
    while lo < len(cuts) - 1:
        hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + GROUP, "right")) - 1)
        at = cuts[lo : hi + 1] - cuts[lo]
        starts, words = word_hashes(data[cuts[lo] : cuts[hi]], np.unique(at[:-1]))
        yield lo, owner(starts, at), words
        lo = hi


def shingles(own: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of SHINGLE words within a text; a shorter text is one shingle."""
    count = np.diff(own)
    text = np.repeat(np.arange(len(count)), count)
    acc = np.zeros(len(words), np.uint64)
    reach = np.zeros(len(words), np.int64)
    left = np.repeat(own[1:], count) - np.arange(len(words))
    for k in range(SHINGLE):
        acc[: len(words) - k] = np.where(
            left[: len(words) - k] > k, acc[: len(words) - k] * np.uint64(FACTOR) + words[k:], acc[: len(words) - k]
        )
    reach = left >= np.minimum(SHINGLE, count[text]) if len(words) else left.astype(bool)
    return text[reach], mix(acc[reach])


def digests(own: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of each text's sequence of words."""
    count = np.diff(own)
    place = (np.arange(len(words)) - np.repeat(own[:-1], count)).astype(np.uint64)
    out = []
    for seed in (1, 2):
        h = mix(words + mix(place * np.uint64(FACTOR) + np.uint64(seed)))
        total = np.concatenate([[np.uint64(0)], np.cumsum(h, dtype=np.uint64)])
        out.append(total[own[1:]] - total[own[:-1]])
    return out[0], out[1]


def sketch_table(rows: DataFrame) -> DataFrame:
    """(id, k1, k2, n_words, sketch) of every row; the sketch is empty where there are no words."""
    factors = mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)
    seeds = mix(np.arange(1001, TOKENS + 1001, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, own, words in text_groups(batch.column(1)):
                text, held = shingles(own, words)
                n = len(own) - 1
                some = np.unique(text)
                head = np.searchsorted(text, some)
                least = np.zeros((len(some), TOKENS), np.int32)
                for k in range(TOKENS if len(some) else 0):
                    least[:, k] = (
                        np.minimum.reduceat((held ^ seeds[k]) * factors[k], head) >> np.uint64(16)
                    ).astype(np.uint32).view(np.int32)
                size = np.zeros(n, np.int64)
                size[some] = TOKENS
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(least.ravel()))
                k1, k2 = digests(own, words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                        pa.array(np.diff(own)), lists
                    ],
                    ["id", "k1", "k2", "n_words", "sketch"]
                )

    return rows.select("id", "text").mapInArrow(run, "id long, k1 long, k2 long, n_words long, sketch array<int>")


def first_paths(sketch: Column, chosen: list[tuple[int, int, int]]) -> Column:
    """The paths of the first two levels."""
    return F.array(*[F.xxhash64(F.lit(r), F.lit(i), sketch[i], F.lit(j), sketch[j]) for r, i, j in chosen])


def next_paths(path: Column, sketch: Column) -> Column:
    """One level deeper: the path's own hash chooses the tokens, so all members of a bucket go along the same ones.

    Every bucket goes along one token and each fourth along another, DEN / NUM on average: two sets right at the
    threshold share one of them on average, and the rows of a group of near copies don't grow with depth. Paths die out
    on the way; runs_for makes up for that.
    """
    out = []
    for b in range(2):
        i = F.pmod(F.xxhash64(path, F.lit(b)), F.lit(TOKENS)).cast("int")
        out.append(F.xxhash64(path, i, F.get(sketch, i)))
    return F.when(F.pmod(path, F.lit(NUM)) == 0, F.array_distinct(F.array(*out))).otherwise(F.array(out[0]))


def candidate_parts(nodes: DataFrame, runs: int) -> DataFrame:
    """(id, root) of the nodes (id, sketch) that end in a bucket with another: root is the least of all that hang together.

    The first EARLY runs come first; after them a node goes by the least lead of its buckets. In the others, nodes that
    go by the same lead count as one in every bucket, so a large group of near copies is looked at a few times only,
    whatever the number of runs.
    """
    chosen = choices(runs)
    early, late = [c for c in chosen if c[0] < EARLY], [c for c in chosen if c[0] >= EARLY]
    edges = stage(bucket_edges(nodes.withColumn("root", F.col("id")), early, own=True), "met")
    if late:
        named = edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root"))
        named = stage(nodes.join(named, "id", "left").withColumn("root", F.coalesce("root", "id")), "nodes")
        edges = edges.union(bucket_edges(named, late))
    return components(edges).withColumnRenamed("node", "id")


def bucket_edges(nodes: DataFrame, chosen: list[tuple[int, int, int]], own: bool = False) -> DataFrame:
    """(a, b): links the root of each node (id, root, sketch) to one root, the lead, of every bucket in which it ends.

    A bucket with more than BUCKET roots is split again, at most DEEPEST times, unless half of its nodes have the same
    root, or sketches that agree with its lead's in ALIKE places: then it is a group of near copies, which no split makes
    small, and its roots are linked as they are. Nodes with the same root are counted in the tasks that read them. own: each
    node is its own root, so there is nothing to count by root.
    """
    sketches = nodes.select("id", "sketch")
    level = nodes.select("id", "root", F.explode(first_paths(F.col("sketch"), chosen)).alias("path"))
    linked = lambda members, ended: members.join(ended, "path").where("root <> lead").select(
        F.col("lead").alias("a"), F.col("root").alias("b")
    )
    found = []
    for depth in range(DEEPEST + 1):
        ends = F.lit(depth == DEEPEST) | (F.col("roots") <= BUCKET)
        if own:
            shares = level.select("path", "root")
            buckets = shares.groupBy("path").agg(F.min("root").alias("lead"), F.count("*").alias("roots"))
        else:
            shares = level.groupBy("path", "root").agg(F.count("*").alias("m"))
            buckets = shares.groupBy("path").agg(
                F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("roots"), F.sum("m").alias("n")
            ).withColumn("lead", F.col("top.root"))
            ends |= F.col("top.m") * 2 >= F.col("n")
        buckets = stage(buckets.where("roots > 1").select("path", "lead", ends.alias("ends")), "buckets")
        found.append(linked(shares.select("path", "root"), buckets.where("ends").select("path", "lead")))
        large = buckets.where("not ends").select("path", "lead")
        if large.isEmpty():
            break
        leads = large.join(sketches.withColumnsRenamed({"id": "lead", "sketch": "first"}), "lead")
        same = F.size(F.filter(F.zip_with("sketch", "first", lambda x, y: x == y), lambda x: x))
        held = level.join(leads, "path").join(sketches, "id").select(
            "path", "lead", "id", "root", "sketch", (same >= ALIKE).alias("alike")
        )
        held = stage(held, "large")
        kinds = held.groupBy("path").agg((F.count_if("alike") * 2 >= F.count("*")).alias("ends"))
        found.append(linked(held.select("path", "lead", "root"), kinds.where("ends").select("path")))
        level = held.join(kinds.where("not ends").select("path"), "path", "left_semi").select(
            "id", "root", F.explode(next_paths(F.col("path"), F.col("sketch"))).alias("path")
        ).distinct()
    return reduce(DataFrame.union, found).distinct()


def joined(label: np.ndarray, these: np.ndarray) -> None:
    """Gives everything that has one of these labels the least of them, in place. A label is a place in the array."""
    low = these.min()
    if (these != low).any():
        mark = np.zeros(len(label), bool)
        mark[these] = True
        label[mark[label]] = low


def leads(ids: np.ndarray, label: np.ndarray) -> np.ndarray:
    """For each place, the least id of those with the same label."""
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    return least[label]


def chunks(costs: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of places whose costs add up to some most."""
    total = np.append(0, np.cumsum(costs))
    lo = 0
    while lo < len(costs):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def spread(heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """heads[0], heads[0] + 1, ... for sizes[0] places, then the same of heads[1], and so on."""
    return np.repeat(heads - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def alike(ids: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The least id of all that hang together over sketches that agree in LIKELY places or more.

    Such a pair shares a token (place and value) among the TOKENS - LIKELY + 1 rarest of each, so only these are looked up:
    what very many texts have in common, such as a line, is not.
    """
    n = len(ids)
    label = np.arange(n)
    code = (np.arange(TOKENS, dtype=np.int64) << 32) | sketch.view(np.uint32).astype(np.int64)
    _, token, often = np.unique(code, return_inverse=True, return_counts=True)
    token = token.reshape(n, TOKENS)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    rare = np.sort(rank[token], 1)[:, : TOKENS - LIKELY + 1]
    width = rare.shape[1]
    order = np.argsort(rare.ravel(), kind="stable")
    by, key = order // width, rare.ravel()[order]
    new = np.append(True, key[1:] != key[:-1])
    head = np.flatnonzero(new)
    first = head[np.cumsum(new) - 1]

    def link(x: np.ndarray, y: np.ndarray) -> None:
        for at in range(0, len(x), CELLS // TOKENS):
            u, v = x[at : at + CELLS // TOKENS], y[at : at + CELLS // TOKENS]
            u, v = u[label[u] != label[v]], v[label[u] != label[v]]
            near = (sketch[u] == sketch[v]).sum(1) >= LIKELY
            for k, m in zip(u[near].tolist(), v[near].tolist()):
                if label[k] != label[m]:
                    joined(label, label[[k, m]])

    # near copies are brought together by the first of each posting; then all pairs of the postings that are still mixed
    link(by[first], by)
    mixed = np.minimum.reduceat(label[by], head) < np.maximum.reduceat(label[by], head)
    before = np.where(mixed[np.cumsum(new) - 1], np.arange(len(by)) - first, 0)
    for lo, hi in chunks(before, CELLS):
        x, y = np.repeat(by[lo:hi], before[lo:hi]), by[spread(first[lo:hi], before[lo:hi])]
        other = label[x] != label[y]
        pair = np.unique(x[other] * n + y[other])
        link(pair // n, pair % n)
    return leads(ids, label)


def compare(
    ids: np.ndarray, side: np.ndarray, flat: np.ndarray, ends: np.ndarray, across: bool
) -> tuple[np.ndarray, np.ndarray]:
    """(least linked id, number of links) of each set, by counting shared shingles; across: only between sides.

    Shingles that an eighth of the sets have are counted by a product of matrices, all others over postings. The least id
    is over everything that hangs together in this task, so what is returned is a forest, not all pairs.
    """
    n = len(ids)
    size = np.diff(ends)
    doc = np.repeat(np.arange(n, dtype=np.int32), size)
    order = np.argsort(flat, kind="stable")
    key, by = flat[order], doc[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    many = np.diff(np.append(head, len(key)))
    del key
    often = many * 8 >= max(n, 64)
    column = np.where(often, np.cumsum(often) - 1, -1)
    dense = np.zeros((n, int(often.sum())), np.float32)
    dense[by[np.repeat(often, many)], np.repeat(column[often], many[often])] = 1
    which = np.empty(len(flat), np.int64)
    which[order] = np.repeat(np.arange(len(head)), many)
    del order
    heads, sizes = head[which], np.where(often[which], 0, many[which])
    label = np.arange(n)
    links = np.zeros(n, np.int64)
    cost = np.append(0, np.cumsum(sizes))
    for lo, hi in chunks(cost[ends[1:]] - cost[ends[:-1]] + n, CELLS):
        part = slice(ends[lo], ends[hi])
        at = np.repeat((doc[part].astype(np.int64) - lo) * n, sizes[part]) + by[spread(heads[part], sizes[part])]
        shared = np.bincount(at, minlength=(hi - lo) * n).reshape(hi - lo, n)
        if dense.shape[1]:
            shared = shared + (dense[lo:hi] @ dense.T).astype(np.int64)
        near = shared * (NUM + DEN) >= NUM * (size[lo:hi, None] + size)
        near[np.arange(hi - lo), np.arange(lo, hi)] = False
        if across:
            near &= side[lo:hi, None] != side
        links[lo:hi] = near.sum(1)
        for x in np.flatnonzero(links[lo:hi]).tolist():
            joined(label, np.append(label[near[x]], label[lo + x]))
    return leads(ids, label), links


def set_table(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, held): the sorted distinct shingles of the wanted ids, from another scan that skips all other texts."""
    bits = rows.sparkSession.sparkContext.broadcast(bitmap(wanted.select("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(holds(bits.value, batch.column(0).to_numpy(zero_copy_only=False))))
            for lo, own, words in text_groups(batch.column(1)):
                text, held = shingles(own, words)
                order = np.lexsort((held, text))
                text, held = text[order], held[order]
                new = np.append(True, (text[1:] != text[:-1]) | (held[1:] != held[:-1])) if len(text) else np.zeros(0, bool)
                text, held = text[new], held[new]
                n = len(own) - 1
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), pa.array(held.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), lists], ["id", "held"])

    return rows.select("id", "text").mapInArrow(run, "id long, held array<long>")


def block_counts(parts: DataFrame) -> DataFrame:
    """(root, blocks) of the nodes (id, root, n_words): in how many blocks those that hang together are compared."""
    return parts.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_words") / BLOCK_WORDS)).cast("int").alias("blocks"),
        F.ceil(F.count("*") * TOKENS / BLOCK_WORDS).cast("int").alias("sketch_blocks")
    )


def dealt(rows: DataFrame, blocks: str, held: str) -> DataFrame:
    """(root, i, j, id, side, held): rows (id, root) go to all pairs (i, j) of their own block, side, and another."""
    own = F.pmod(F.xxhash64("id", F.lit(3)), F.col(blocks)).cast("int")
    out = rows.select("root", "id", held, own.alias("side"), F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)).alias("other"))
    return out.select("root", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "id", "side", held)


def narrowed(large: DataFrame, sketches: DataFrame) -> DataFrame:
    """(id, root) of the nodes (id, root, sketch_blocks) that hang together over sketches alike in LIKELY places.

    Texts with a line in common meet in buckets, and so very many of them hang together that are not similar: compared
    whole, they would cost the square of their number. Only sketches go to pairs of blocks here.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["id"].to_numpy()
        sketch = table["sketch"].combine_chunks().flatten().to_numpy().reshape(len(ids), TOKENS)
        return pa.table({"id": ids, "lead": alike(ids, sketch)})

    sent = dealt(large.join(sketches, "id"), "sketch_blocks", "sketch")
    met = sent.groupBy("root", "i", "j").applyInArrow(run, "id long, lead long").where("id <> lead")
    return components(met, "id", "lead").withColumnRenamed("node", "id")


def linked(rows: DataFrame, parts: DataFrame) -> tuple[DataFrame, bool]:
    """(id, lead, links) of the nodes (id, root, n_words): each set of nodes that hang together is compared whole, in blocks if it is large.

    The second result says whether there were blocks; without them, lead is the least id of the class already.
    """
    sizes = block_counts(parts)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, side = table["id"].to_numpy(), table["side"].to_numpy()
        held = table["held"].combine_chunks()
        ends = held.offsets.to_numpy().astype(np.int64)
        least, links = compare(
            ids, side, held.flatten().to_numpy(), ends - ends[0], table["i"][0].as_py() != table["j"][0].as_py()
        )
        return pa.table({"id": ids, "lead": least, "links": links})

    # blocks are joined to the nodes first: what is dealt by root alone would bring all pairs of blocks to one task
    sets = set_table(rows, parts).join(parts.join(sizes, "root").select("id", "root", "blocks"), "id")
    got = dealt(sets, "blocks", "held").groupBy("root", "i", "j").applyInArrow(run, "id long, lead long, links long")
    return stage(got, "linked"), not sizes.where("blocks > 1").isEmpty()


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, recall: float = 0.9999) -> DataFrame:
    """One row for each row of docs: (id, class_id, n_links, kept).

    Documents are sets of runs of SHINGLE words (split at ASCII blanks, A-Z as a-z; a shorter text is one run). Two are
    linked at a Jaccard similarity of NUM / DEN or more, verified on the whole sets; classes are what hangs together over
    links, named by their least id, which is kept. Texts with the same words are one node, so copies are never paired;
    n_links counts the other nodes linked to a document's own. Enough runs are made that a linked pair meets with
    probability recall even where all its buckets are split DEEPEST times; what meets is then compared whole, so chains and neighbours are found as well.

    Texts without words (null, empty, blank) and rows with a null id are classes of their own: n_links 0, kept. Ids name
    documents: rows that repeat an id with other words count as one document with both texts. Other columns are ignored.
    """
    shipped(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    base = stage(sketch_table(rows.where("id is not null")), "sketches")
    key = ["k1", "k2", "n_words"]
    slotted = base.where("n_words > 0").withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots_for(base.count()))).cast("int"))
    by_slot = slotted.groupBy("slot", *key).agg(F.min("id").alias("least"))
    nodes = by_slot.groupBy(*key).agg(F.min("least").alias("rep"))
    sketches = base.select("id", *key, "sketch").dropDuplicates(["id", *key])
    nodes = stage(
        nodes.join(
            sketches,
            (nodes.rep == sketches.id) & (nodes.k1 == sketches.k1) & (nodes.k2 == sketches.k2) & (
                nodes.n_words == sketches.n_words
            )
        ).select("id", nodes.k1, nodes.k2, nodes.n_words, "sketch"),
        "nodes"
    )
    words = nodes.groupBy("id").agg(F.sum("n_words").alias("n_words"))
    parts = stage(candidate_parts(nodes.select("id", "sketch"), runs_for(recall)).join(words, "id"), "parts")
    large = block_counts(parts).where("blocks > 1")
    if not large.isEmpty():
        again = narrowed(parts.join(large, "root"), nodes.select("id", "sketch")).join(words, "id")
        parts = stage(parts.join(large, "root", "left_anti").select("id", "root", "n_words").unionByName(again), "parts")
    found, blocks = linked(rows.where("id is not null"), parts)
    classes = components(
        found.where("id <> lead"), "id", "lead"
    ).withColumnsRenamed({"node": "id", "root": "class_id"}) if blocks else found.select("id", F.col("lead").alias("class_id"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = nodes.select("id", *key).join(classes, "id", "left").join(links, "id", "left").select(
        *key, F.coalesce("class_id", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links")
    )
    down = by_slot.drop("least").join(named, key)
    full = slotted.select("id", "slot", *key).join(down, ["slot", *key]).select("id", "class_id", "n_links")
    alone = base.where("n_words = 0").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    none = rows.where("id is null").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return full.union(alone).union(none).select(
        F.col("id").alias(id_col), "class_id", "n_links", F.col("id").eqNullSafe(F.col("class_id")).alias("kept")
    )
