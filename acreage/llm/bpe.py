"""Byte-level BPE with a lexicon of frequent words in a minimal acyclic transducer, and exact merging of all other words."""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import struct
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.scratch import stage
from acreage.llm.ship import shipped

#: Fixed by the public byte-level BPE format: how a text is cut into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Up to U+024F the letters are these and the digits 0-9, if the other numbers and the separators U+001C to U+001F are left out.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN = re.compile(r"[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*+\Z")
LATIN_PATTERN = re.compile(rf" ?[{LETTERS}]++| ?[0-9]++|'(?:s|t|re|ve|m|ll|d)| ?[^\s{LETTERS}0-9]++|\s+(?!\S)|\s+")
ANY_PATTERN = regex.compile(PATTERN)
HEADER = struct.Struct("<8sQQQQ")
#: Words that a worker keeps at hand; beyond it they become the old ones, so memory is bounded.
AT_HAND = 150_000
#: Words that a task counts before it sends their counts.
COUNTED = 300_000
#: Longer words are neither compiled nor kept at hand.
LONGEST = 64
#: Texts are taken in groups of about so many characters; longer ones in slices.
GROUP = 1 << 20
#: No merge has this rank.
NONE = np.iinfo(np.int32).max


def cut(text: str) -> list[str]:
    """The words of a text by PATTERN. Texts of Latin letters take a form of it that is the same on them and faster."""
    return (LATIN_PATTERN if LATIN.match(text) else ANY_PATTERN).findall(text)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tokens and merges of a tokenizers file as arrays; added tokens are found in the text before it is cut into words."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters = byte_letters()
        model = spec["model"]
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        held = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        held |= {i: token.encode() for token, i in self.added.items()}
        size = np.zeros(max(held) + 1, np.int64)
        size[list(held)] = [len(b) for b in held.values()]
        #: The bytes of token i are flat[ends[i] : ends[i + 1]].
        self.ends = np.concatenate([[0], np.cumsum(size)])
        self.flat = np.frombuffer(b"".join(held[i] for i in sorted(held)), np.uint8)
        self.split: list[bytes] | None = None
        self.single = np.zeros(256, np.uint32)
        for letter, b in letters.items():
            self.single[b] = vocab[letter]
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.uint64)
        #: Pairs of tokens in order, the rank of each, and the token that each rank makes.
        self.rank = np.argsort(pairs, kind="stable").astype(np.int32)
        self.pairs = pairs[self.rank]
        self.made = np.array([vocab[a + b] for a, b in merges], np.uint32)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair of tokens, NONE where there is none."""
        if not len(self.pairs):
            return np.full(len(a), NONE, np.int32)
        want = a.astype(np.uint64) << np.uint64(32) | b
        at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where(self.pairs[at] == want, self.rank[at], NONE)

    def merge_many(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word: in every round each word has its merge of the least rank, the leftmost, until none applies."""
        size = np.array([len(w) for w in words], np.int64)
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        rank = np.full(len(ids), NONE, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.ranks(ids[inside], ids[inside + 1])
        done_ids, done_words = [], []
        while len(ids):
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            many = np.diff(np.append(head, len(ids)))
            best = np.minimum.reduceat(rank, head)
            over = np.repeat(best == NONE, many)
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
                ids, word, rank = ids[~over], word[~over], rank[~over]
                many, best = many[best != NONE], best[best != NONE]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, many))
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])]
            ids[hit] = self.made[best]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            at = np.cumsum(keep)[hit] - 1
            ids, word, rank = ids[keep], word[keep], rank[keep]
            last = np.append(word[1:] != word[:-1], True)
            rank[at[last[at]]] = NONE
            again = np.concatenate([at[~last[at]], at[(at > 0) & ~last[at - 1]] - 1])
            rank[again] = self.ranks(ids[again], ids[again + 1])
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.split(ids[order], np.cumsum(np.bincount(word, minlength=len(words)))[:-1])

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same for one word of any length: the next merge comes from a heap over (rank, place), places are a linked list."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
        pairs = {int(p): int(r) for p, r in zip(self.pairs, self.rank, strict=True)}
        made = self.made.tolist()
        heap = [(r, k) for k in range(n - 1) if (r := pairs.get(ids[k] << 32 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            if not alive[k] or (b := after[k]) >= n or pairs.get(ids[k] << 32 | ids[b]) != r:
                continue
            ids[k], alive[b] = made[r], False
            after[k] = c = after[b]
            if c < n:
                before[c] = k
                if (r := pairs.get(ids[k] << 32 | ids[c])) is not None:
                    heapq.heappush(heap, (r, k))
            if (a := before[k]) >= 0 and (r := pairs.get(ids[a] << 32 | ids[k])) is not None:
                heapq.heappush(heap, (r, a))
        return np.array([i for i, on in zip(ids, alive, strict=True) if on], np.uint32)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, none of which is empty."""
        short = [k for k, w in enumerate(words) if len(w) <= 4 * LONGEST]
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(words)
        if short:
            for k, ids in zip(short, self.merge_many([words[k] for k in short]), strict=True):
                out[k] = ids
        for k in set(range(len(words))) - set(short):
            out[k] = self.merge_long(words[k])
        return out

    def spelled(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of ids[ends[k] : ends[k + 1]]; bytes that aren't UTF-8 are replaced as Python does it."""
        data = b"".join(map(self.tokens().__getitem__, ids.tolist()))
        bounds = np.concatenate([[0], np.cumsum(self.ends[ids + 1] - self.ends[ids])])[ends]
        out = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data))
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:
            out = pa.array(
                [data[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:], strict=False)], pa.large_string()
            )
        return out

    def tokens(self) -> list[bytes]:
        if self.split is None:
            data = self.flat.tobytes()
            self.split = [data[a:b] for a, b in zip(self.ends, self.ends[1:], strict=False)]
        return self.split


class LexiconBuilder:
    """A minimal acyclic transducer from sorted words: suffixes are shared as soon as no later word can change them.

    A word's number is the sum of the counts on its way (how many words come before it); the number leads to its ids, so
    the outputs lie on the edges while all words with the same ending share their states.
    """

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.states: list[tuple[bool, list[tuple[int, int]], int]] = []
        self.open: list[list] = [[False, []]]
        self.last = b""
        self.ids: list[np.ndarray] = []

    def _close(self, keep: int) -> None:
        while len(self.open) > keep + 1:
            final, edges = self.open.pop()
            key = (final, tuple(edges))
            state = self.register.get(key)
            if state is None:
                state = self.register[key] = len(self.states)
                self.states.append((final, edges, final + sum(self.states[t][2] for _, t in edges)))
            label = self.last[len(self.open) - 1]
            self.open[-1][1].append((label, state))

    def add(self, word: bytes, ids: np.ndarray) -> None:
        if self.ids and word <= self.last:
            raise ValueError("words must be sorted and distinct")
        common = 0
        while common < min(len(word), len(self.last)) and word[common] == self.last[common]:
            common += 1
        self._close(common)
        self.open.extend([False, []] for _ in word[common:])
        self.open[-1][0] = True
        self.last = word
        self.ids.append(ids)

    def dump(self) -> bytes:
        """Header; (state, label) of each edge in order, words before it, its target; which states are final; ends of the ids, ids."""
        self._close(0)
        final, edges = self.open[0]
        states = [*self.states, (final, edges, 0)]
        key, before, target = [], [], []
        for s, (final, edges, _) in enumerate(states):
            words = int(final)
            for label, to in edges:
                key.append(s << 8 | label)
                before.append(words)
                target.append(to)
                words += self.states[to][2]
        ends = np.cumsum([0, *map(len, self.ids)], dtype=np.uint64)
        parts = [
            np.array(key, np.uint64), np.array(before, np.uint32), np.array(target, np.uint32), np.array(
                [s[0] for s in states], np.uint8
            ),
            ends, np.concatenate([*self.ids, np.zeros(0, np.uint32)]).astype(np.uint32),
        ]
        out = HEADER.pack(b"lexicon2", len(states), len(key), len(self.ids), int(ends[-1]))
        for p in parts:
            out += p.tobytes() + bytes(-p.nbytes % 8)
        return out


class Lexicon:
    """A compiled transducer, read in place from a memory-mapped file."""

    def __init__(self, data):
        _, self.n_states, self.n_edges, self.n_words, n_ids = HEADER.unpack_from(data, 0)
        at, parts = HEADER.size, []
        for kind, n in (
            (np.uint64, self.n_edges), (np.uint32, self.n_edges), (np.uint32, self.n_edges), (np.uint8, self.n_states),
            (np.uint64, self.n_words + 1), (np.uint32, n_ids)
        ):
            parts.append(np.frombuffer(data, kind, n, at))
            at += -(-parts[-1].nbytes // 8) * 8
        self.key, self.before, self.target, self.final, self.ends, self.ids = parts

    @classmethod
    def mapped(cls, blob: bytes) -> Lexicon:
        """Through a file of this process' own folder that is unlinked at once, so pages can leave memory and nothing stays behind."""
        fd, path = tempfile.mkstemp(prefix="lexicon-")
        try:
            with os.fdopen(fd, "wb") as f:
                f.write(blob)
            with open(path, "rb") as f:
                return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        finally:
            os.unlink(path)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it isn't held: all words take one step of the transducer at a time."""
        out = np.full(len(words), -1, np.int64)
        if not len(words) or not self.n_edges:
            return out
        size = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        on = np.arange(len(words))
        state, number = np.full(len(words), self.n_states - 1, np.uint64), np.zeros(len(words), np.int64)
        for step in range(int(size.max()) + 1):
            ended = size[on] == step
            if ended.any():
                final = self.final[state[ended]] == 1
                out[on[ended][final]] = number[ended][final]
                on, state, number = on[~ended], state[~ended], number[~ended]
            if not len(on):
                break
            want = state << np.uint64(8) | flat[begin[on] + step]
            at = np.minimum(np.searchsorted(self.key, want), self.n_edges - 1)
            hit = self.key[at] == want
            on, at, number = on[hit], at[hit], number[hit]
            number, state = number + self.before[at], self.target[at].astype(np.uint64)
        return out

    def get(self, number: int) -> np.ndarray:
        return self.ids[int(self.ends[number]) : int(self.ends[number + 1])]


def compile_lexicon(words: Iterable[bytes], vocabulary: Vocabulary) -> bytes:
    builder = LexiconBuilder()
    words = sorted({w for w in words if w})
    for word, ids in zip(words, vocabulary.merge(words), strict=True):
        builder.add(word, ids)
    return builder.dump()


def slices(text: str, least: int = GROUP) -> Iterator[str]:
    """Parts of a text that can be cut into words apart: each but the first begins at a single blank between other signs."""
    lo = 0
    while len(text) - lo > least and (blank := regex.search(r"(?<=\S) (?=\S)", text, pos=lo + least)):
        yield text[lo : blank.start()]
        lo = blank.start()
    yield text[lo:]


class Hand:
    """Words met lately and their ids, as bytes: the lexicon's, else the merges'.

    When it is full it becomes the old hand, from which words are taken over as they are met again, so memory is bounded
    and frequent words aren't lost. Words that are new to a group are looked up and merged together.
    """

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.v, self.lexicon, self.held, self.old = vocabulary, lexicon, {}, {}

    def spell(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts that are cut into words."""
        if len(self.held) >= AT_HAND:
            self.held, self.old = {}, self.held
        new, now = [], {}
        for w in set().union(*texts).difference(self.held):
            if (ids := self.old.get(w)) is None:
                new.append(w)
            else:
                self.held[w] = ids
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        number = self.lexicon.numbers(raw)
        other = np.flatnonzero(number < 0)
        found = dict(zip(other.tolist(), self.v.merge([raw[k] for k in other]), strict=True))
        found |= {int(k): self.lexicon.get(int(number[k])) for k in np.flatnonzero(number >= 0)}
        for k, w in enumerate(new):
            (self.held if len(w) <= LONGEST else now)[w] = found[k].tobytes()
        get = {**self.held, **now}.__getitem__ if now else self.held.__getitem__
        return [b"".join(map(get, words)) for words in texts]


class Codec:
    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.v, self.hand = vocabulary, Hand(vocabulary, lexicon)
        self.stops = regex.compile(
            "(" + "|".join(regex.escape(x) for x in sorted(vocabulary.added, key=len, reverse=True)) + ")"
        ) if vocabulary.added else None

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where those of each begin and end)."""
        flat, ends = [], [0]
        for lo, hi in groups([len(t) for t in texts]):
            for got in self._group(texts[lo:hi]):
                flat.append(got)
                ends.append(ends[-1] + len(got))
        return np.frombuffer(b"".join(flat), np.uint32), np.array(ends, np.int64) // 4

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(texts) == 1 and len(texts[0]) > GROUP:
            yield b"".join(s if isinstance(s, bytes) else self.hand.spell([cut(s)])[0] for s in self._parts(texts[0]))
            return
        parts = [[*self._parts(t)] for t in texts]
        spelled = iter(self.hand.spell([cut(s) for p in parts for s in p if isinstance(s, str)]))
        for p in parts:
            yield b"".join(s if isinstance(s, bytes) else next(spelled) for s in p)

    def _parts(self, text: str) -> Iterator[str | bytes]:
        """The text cut at added tokens, which are given as their ids, and into slices."""
        for part in self.stops.split(text) if self.stops else (text,):
            if part in self.v.added:
                yield np.uint32(self.v.added[part]).tobytes()
            elif part:
                yield from slices(part)


def groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with about GROUP characters each; a longer text is alone."""
    lo = total = 0
    for k, n in enumerate(sizes):
        if k > lo and total + n > GROUP:
            yield lo, k
            lo, total = k, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def frequent_words(docs: DataFrame, text_col: str, lexicon_size: int) -> list[str]:
    """The most frequent words of all texts, at most lexicon_size; of words with the same count all or none.

    Words are cut as the tokenizer cuts them, counted in each task first and summed by word.
    """
    if not lexicon_size:
        return []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()

        def out() -> pa.RecordBatch:
            held = {w: n for w, n in total.items() if len(w) <= LONGEST}
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                for part in slices(text.as_py() or ""):
                    total.update(cut(part))
                    if len(total) > COUNTED:
                        yield out()
        yield out()

    words = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    words = stage(words.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    # The count that as many words reach as fit, from a table of how many words have each power of two, then each count.
    level = F.floor(F.log2("n")).cast("int")
    many, least = 0, None
    for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("m")).orderBy(F.desc("level")).collect():
        if many + r.m > lexicon_size:
            for c in words.where(level == r.level).groupBy("n").agg(
                F.count("*").alias("m")
            ).orderBy(F.desc("n")).limit(lexicon_size).collect():
                if many + c.m > lexicon_size:
                    break
                many, least = many + c.m, c.n
            break
        many, least = many + r.m, 1 << r.level
    return [] if least is None else [r.word for r in words.where(F.col("n") >= least).select("word").collect()]


def encode_decode(
    docs: DataFrame, vocabulary_file: str, id_col: str = "doc_id", text_col: str = "text", *, lexicon_size: int = 50_000
) -> DataFrame:
    """One row for each row of docs: (id, n_tokens, ids array<int>, decoded): the tokens of the whole text, and what they spell.

    Whole texts are encoded and decoded as the tokenizers library does it with the same file, special tokens not added.
    The lexicon holds the most frequent words of the corpus (at most lexicon_size, which bounds its bytes); it goes to
    every worker once and is memory-mapped there. Words that it lacks are merged exactly, so the lexicon changes speed
    and never results. Null texts count as empty: no tokens. Repeated rows give repeated results; other columns are
    ignored. The vocabulary file is read on the driver only, which sends its tables along with the lexicon.
    """
    spark = shipped(docs.sparkSession)
    with open(vocabulary_file, encoding="utf-8") as f:
        source = f.read()
    vocabulary = Vocabulary(source)
    blob = compile_lexicon((w.encode() for w in frequent_words(docs, text_col, lexicon_size)), vocabulary)
    sent = spark.sparkContext.broadcast(
        (hashlib.sha256(hashlib.sha256(source.encode()).digest() + blob).digest(), vocabulary, blob)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(sent)
        for batch in batches:
            ids, ends = codec.encode([t or "" for t in batch.column(1).to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends)), lists, codec.v.spelled(ids, ends).cast(pa.string())],
                ["id", "n_tokens", "ids", "decoded"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_tokens long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def token_digests(encoded: DataFrame) -> DataFrame:
    """Rows of encode_decode with SHA-256 of the ids, written in decimal and joined by commas, and of the decoded text."""
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return encoded.withColumns({"ids_sha256": ids, "decoded_sha256": F.sha2("decoded", 256)}).drop("ids", "decoded")


_codecs: dict[bytes, Codec] = {}


def codec_for(sent) -> Codec:
    """One codec for each worker process, kept for its next tasks with the same digest of vocabulary and lexicon."""
    key, vocabulary, blob = sent.value
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(vocabulary, Lexicon.mapped(blob))
    return _codecs[key]
