"""Byte-level BPE with a minimal acyclic transducer as its lexicon.

The tokenizer file is read as data (vocabulary, merges, added tokens). The
corpus' most frequent words are counted on Spark, encoded by exact merging
and compiled into a minimal acyclic automaton: words share prefixes and
suffixes, every arc carries the number of words it skips, so that the sum
along a path is the word's number, which points at its ids. The compiled
file goes to every executor (``SparkContext.addFile``), where each Python
worker maps it into memory. Words outside the lexicon are merged by the
ranks, so the lexicon only decides about speed, never about ids.

Defined results: null and empty texts have no ids and decode to empty text;
the contents of added tokens are split off as the tokenizer file says;
repeated rows are encoded alike; an empty table gives an empty result; other
columns are ignored or, in ``encode_texts``, returned as they came.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import arrow_rows, filled, scratch_path, scratch_table

# Fixed value: the published pre-tokenizer pattern of byte-level BPE, its classes of letters, numbers and spaces left open.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\s"}
NO_RANK, ID = 1 << 62, (1 << 32) - 1
UNRANKED = (1 << 31) - 1
LEXICON_WORDS = 1 << 18  # bound of the lexicon, so of the compiled file
LEXICON_WORD_BYTES = 64  # longer words are merged each time
MEMO_WORDS = 300_000  # bound of a worker's memo (some 300 bytes each), beyond the groups of texts; then its older half goes
ENCODE_MEMO = 60_000  # the same where whole id lists are made, which need memory themselves
GROUP_CHARS = 1 << 20
COUNT_WORDS = 150_000  # bound of a task's counts, sent on when full


def _byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level vocabulary writes each byte: Latin-1's
    visible ones stand for themselves, the others follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(shown))
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def _splitter() -> Callable[[str], list[str]]:
    """``findall`` of the pattern. ``regex`` knows its classes; written out up to U+FFFF the same pattern runs
    in ``re``, which takes less than half the time. Texts with characters beyond that stay with ``regex``."""
    plane = "".join(map(chr, range(1 << 16)))
    spans = {k: "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in regex.findall(c + "+", plane))
             for k, c in CLASSES.items()}
    words, wide = re.compile(PATTERN.format(**spans)).findall, regex.compile(PATTERN.format(**CLASSES)).findall
    beyond = re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: words(text) if text.isascii() or not beyond(text) else wide(text)


class Lookup:
    """32-bit values of distinct keys from 0 on, asked for many at once: a table with three free places for
    every key at least; a key whose place is taken lies in the next free one."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, none: int) -> None:
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask, self.none = np.uint64(64 - bits), (1 << bits) - 1, none
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, none, np.int32)
        left, place = np.arange(len(keys), dtype=np.int32), self._place(keys)
        while len(left):
            free = self.keys[place] < 0
            self.values[place[free]] = left[free]  # of several, one stays
            self.keys[place[free]] = keys[self.values[place[free]]]
            lost = self.keys[place] != keys[left]
            left, place = left[lost], (place[lost] + 1) & self.mask
        used = self.keys >= 0
        self.values[used] = values[self.values[used]]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        held, out = self.keys[place], self.values[place]
        other = np.flatnonzero(held != keys)
        out[other] = self.none
        other = other[held[other] >= 0]
        place = place[other]
        while len(other):
            place = (place + 1) & self.mask
            held = self.keys[place]
            same = held == keys[other]
            out[other[same]] = self.values[place[same]]
            on = ~same & (held >= 0)
            other, place = other[on], place[on]
        return out


class Merger:
    """Exact merging by rank, and the way back from ids to bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, kind = spec["model"], (spec.get("pre_tokenizer") or {})
        if (model.get("type", "BPE") != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space")
                or spec.get("normalizer") or model.get("ignore_merges")):
            raise ValueError("a plain byte-level BPE file is needed")
        letters = _byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # pair -> its rank above the id that it becomes
        self.rank = {(ids[a], ids[b]): i << 32 | ids[a + b] for i, (a, b) in enumerate(pairs)}
        self.byte_id = [ids[letters[b]] for b in range(256)]
        # the same as arrays, for many words at once: rank of a pair, id of a rank
        self.byte_ids = np.array(self.byte_id, np.int32)
        keys = np.fromiter((a << 32 | b for a, b in self.rank), np.int64, len(self.rank))
        merged = np.fromiter(self.rank.values(), np.int64, len(self.rank))
        self.pairs = Lookup(keys, merged >> 32, UNRANKED)
        self.merged = np.zeros(int(merged.max(initial=0) >> 32) + 1, np.int32)
        self.merged[merged >> 32] = merged & ID
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()}
        self.token |= {i: s.encode() for s, i in self.added.items()}
        self.decimal = {i: str(i) for i in self.token}
        longest = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None

    def merge(self, word: bytes) -> list[int]:
        """Join the leftmost pair of the lowest rank until no pair has one."""
        parts = [self.byte_id[b] for b in word]
        if len(parts) > 256:
            return self._merge_long(parts)
        get = self.rank.get
        ranks = [get(p, NO_RANK) for p in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != NO_RANK:
            i, new = ranks.index(low), low & ID
            parts[i:i + 2] = [new]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((new, parts[i + 1]), NO_RANK)
            if i:
                ranks[i - 1] = get((parts[i - 1], new), NO_RANK)
        return parts

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words."""
        out: list[list[int]] = [[]] * len(words)
        for i, ids in self.merged_words(words):
            out[i] = ids
        return out

    def merged_words(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Number and ids of every word, in the order in which they are done: all are merged a step at a time
        together, the last few and very long ones by themselves."""
        yield from ((i, self.merge(w)) for i, w in enumerate(words) if not 1 < len(w) <= 64)
        own = [i for i, w in enumerate(words) if 1 < len(w) <= 64]
        size = np.array([len(words[i]) for i in own], np.int64)
        flat = self.byte_ids[np.frombuffer(b"".join([words[i] for i in own]), np.uint8)]
        word, rank = np.array(own, np.int64), np.full(len(flat), UNRANKED, np.int32)
        left = np.ones(len(flat), bool)
        left[np.cumsum(size) - 1] = False
        left = np.flatnonzero(left)  # all but the last part of each word
        rank[left] = self._ranks(flat, left)
        while len(word):
            first = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, first)
            gone = low == UNRANKED
            if gone.any():  # no pair of these can be joined
                parts = np.repeat(gone, size)
                yield from zip(word[gone].tolist(), _cut(flat[parts], size[gone]))
                flat, rank = flat[~parts], rank[~parts]
                word, size, low = word[~gone], size[~gone], low[~gone]
                first = np.cumsum(size) - size
            if len(word) < 40:
                break
            hit = np.flatnonzero(rank == np.repeat(low, size))
            of = np.searchsorted(first, hit, side="right")
            place = hit[np.r_[True, of[1:] != of[:-1]]]  # the leftmost of each word
            flat[place] = self.merged[low]
            keep = np.ones(len(flat), bool)
            keep[place + 1] = False
            flat, rank = flat[keep], rank[keep]
            place -= np.arange(len(place))  # as many parts went before it
            size = size - 1
            first = np.cumsum(size) - size
            inner = place < first + size - 1
            rank[place] = UNRANKED
            rank[place[inner]] = self._ranks(flat, place[inner])
            before = place[place > first] - 1
            rank[before] = self._ranks(flat, before)
        yield from ((i, self.merge(words[i])) for i in word.tolist())

    def _ranks(self, flat: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The ranks of the pairs that begin at ``left``."""
        return self.pairs.get(flat[left].astype(np.int64) << 32 | flat[left + 1])

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same for very long words: a heap of candidate pairs, leftmost of the lowest rank first."""
        from heapq import heapify, heappop, heappush

        n = len(parts)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        rank = self.rank
        heap = [(rank[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
        heapify(heap)
        while heap:
            low, i, a, b = heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = low & ID, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) < n and (p := (parts[left], parts[right])) in rank:
                    heappush(heap, (rank[p], left, *p))
        return [p for p in parts if p >= 0]


def _cut(flat: np.ndarray, size: np.ndarray) -> Iterator[list[int]]:
    """Consecutive parts of these sizes, as lists."""
    ids, end = flat.tolist(), np.cumsum(size)
    return (ids[lo:hi] for lo, hi in zip((end - size).tolist(), end.tolist()))


_ONE = [bytes([b]) for b in range(256)]


class Transducer:
    """A minimal acyclic automaton from words to ids, in flat arrays that can be mapped."""

    HEADER = 6

    @staticmethod
    def compile(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
        """Build from distinct words in ascending byte order, sharing equal suffixes."""
        register: dict[tuple, int] = {}
        nodes: list[tuple] = []  # (final, ((label, child), ...)) of shared states
        words_from: list[int] = []
        path: list[list] = [[False, []]]  # states of the last word, not yet shared
        last, ids, at = b"", array("i"), array("i", [0])

        def share(state: list) -> int:
            key = (state[0], tuple(state[1]))
            if key not in register:
                register[key] = len(nodes)
                nodes.append(key)
                words_from.append(key[0] + sum(words_from[c] for _, c in key[1]))
            return register[key]

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                child = share(path.pop())
                path[-1][1].append((last[len(path) - 1], child))

        for word, word_ids in entries:
            if word <= last and at[-1:] != array("i", [0]):
                raise ValueError("words must be distinct and ascending")
            common = len(os.path.commonprefix([last, word]))
            close(common)
            path.extend([False, []] for _ in word[common:])
            path[-1][0] = True
            last = word
            ids.extend(word_ids)
            at.append(len(ids))
        close(0)
        root = share(path[0])

        labels, first, target, skip, final = bytearray(), array("i", [0]), array("i"), array("i"), bytearray()
        for is_final, arcs in nodes:
            seen = int(is_final)
            for label, child in arcs:
                labels.append(label)
                target.append(child)
                skip.append(seen)
                seen += words_from[child]
            first.append(len(target))
            final.append(is_final)
        head = array("i", [len(nodes), len(target), len(at) - 1, len(ids), root, 0])
        return b"".join(x.tobytes() for x in (head, first, target, skip, at, ids)) + bytes(labels) + bytes(final)

    def __init__(self, data: bytes | mmap.mmap) -> None:
        view = memoryview(data)
        states, arcs, words, n_ids, self.root, _ = view[:4 * self.HEADER].cast("i")
        pos = 4 * self.HEADER
        for name, n in (("first", states + 1), ("target", arcs), ("skip", arcs), ("at", words + 1), ("ids", n_ids)):
            setattr(self, name, view[pos:pos + 4 * n].cast("i"))
            pos += 4 * n
        self.data, self.labels, self.final = data, pos, view[pos + arcs:pos + arcs + states]
        # state and label of every arc: made once per worker
        keys = (np.repeat(np.arange(states), np.diff(np.asarray(self.first))) << 8
                | np.frombuffer(view[pos:pos + arcs], np.uint8))
        self.arcs, self.words = Lookup(keys, np.arange(arcs, dtype=np.int32), -1), words

    @classmethod
    def open(cls, path: str) -> Transducer:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> list[int] | None:
        state, number, base = self.root, 0, self.labels
        find, first, target, skip = self.data.find, self.first, self.target, self.skip
        for byte in map(_ONE.__getitem__, word):
            arc = find(byte, base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            number += skip[arc]
            state = target[arc]
        return self.ids[self.at[number]:self.at[number + 1]].tolist() if self.final[state] else None

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Number and ids of the words that are held, without the empty one: ``get`` of many, all walked a
        byte at a time together."""
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LEXICON_WORD_BYTES]
        if not short or not len(self.target):
            return
        size = np.array([len(words[i]) for i in short])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        at = np.r_[0, np.cumsum(size)[:-1]]
        flat = np.frombuffer(b"".join([words[short[i]] for i in order.tolist()]), np.uint8)
        target, skip, final = np.asarray(self.target), np.asarray(self.skip), np.asarray(self.final)
        live = np.arange(len(size))  # words still on the way, their states and numbers
        state, number = np.full(len(size), self.root, np.int64), np.zeros(len(size), np.int64)
        good: list[tuple[np.ndarray, np.ndarray]] = []
        for depth in range(int(size[0]) + 1):
            n = int(np.searchsorted(-size[live], -depth, side="left"))  # longer words lie first
            end = final[state[n:]] == 1
            good.append((live[n:][end], number[n:][end]))
            live, state, number = live[:n], state[:n], number[:n]
            arc = self.arcs.get(state << 8 | flat[at[live] + depth])
            there = arc >= 0
            arc = arc[there]
            live, state, number = live[there], target[arc].astype(np.int64), number[there] + skip[arc]
        found, number = (np.concatenate(x) for x in zip(*good))
        ids, first = np.asarray(self.ids), np.asarray(self.at)
        n_ids = first[number + 1] - first[number]
        each = np.arange(n_ids.sum()) + np.repeat(first[number] - (np.cumsum(n_ids) - n_ids), n_ids)
        yield from zip(map(short.__getitem__, order[found].tolist()), _cut(ids[each], n_ids))


def _groups(texts: Iterable[str], chars: int = GROUP_CHARS) -> Iterator[list[str]]:
    """Consecutive texts, ``chars`` characters or one text at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


class Codec:
    """Encoder and decoder of one Python worker. Texts are coded in groups: the words of a group that are
    not known yet are looked up in the mapped lexicon together, and what it lacks is merged."""

    kept: dict[tuple, Codec] = {}

    def __init__(self, tokenizer: str, lexicon: str | None, most: int = MEMO_WORDS) -> None:
        self.merger, self.most = Merger(tokenizer), most
        self.lexicon = Transducer.open(lexicon) if lexicon else None
        self.words = _splitter()
        self.known: dict[str, array | tuple] = {}  # short words, with the older ones ``most`` and two groups' at most
        self.older: dict[str, array | tuple] = {}
        self.form: Callable | None = None

    @classmethod
    def of(cls, tokenizer: str, lexicon: str | None) -> Codec:
        """One per worker process, kept for the next task."""
        if (tokenizer, lexicon) not in cls.kept:
            cls.kept.clear()
            cls.kept[tokenizer, lexicon] = cls(tokenizer, lexicon)
        return cls.kept[tokenizer, lexicon]

    def word_ids(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Every word with its ids, from the lexicon, else merged; not in order."""
        data, rest = [word.encode() for word in words], bytearray(b"\1") * len(words)
        for i, ids in self.lexicon.find(data) if self.lexicon else ():
            rest[i] = 0
            yield words[i], ids
        words, data = list(compress(words, rest)), list(compress(data, rest))
        for i, ids in self.merger.merged_words(data):
            yield words[i], ids

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text cut at added tokens: (text, None), or (token, its id)."""
        if not self.merger.split or not any(t in text for t in self.merger.added):
            yield text, None
            return
        for i, part in enumerate(self.merger.split.split(text)):
            if part:
                yield part, self.merger.added[part] if i % 2 else None

    def _learn(self, words: set[str], form: Callable) -> dict[str, array | tuple]:
        """``form(ids)`` of all these words; short ones stay known. A full memo becomes the older one, out of
        which words still in use come back, so that the frequent ones are not learned again."""
        if form != self.form:
            self.known, self.older, self.form = {}, {}, form
        elif len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        new = words.difference(self.known)
        again = {w: self.older[w] for w in new if w in self.older}
        self.known.update(again)
        new = list(new.difference(again))
        values = {w: form(ids) for w, ids in self.word_ids(new)}
        if max(map(len, new), default=0) <= LEXICON_WORD_BYTES:
            self.known.update(values)
            return self.known
        self.known.update((w, v) for w, v in values.items() if len(w) <= LEXICON_WORD_BYTES)
        return {**values, **{w: self.known[w] for w in words.difference(values)}}

    def code(self, texts: Iterable[str], form: Callable) -> Iterator[list]:
        """For every text the ``form(ids)`` of its words, in order."""
        for group in _groups(texts):
            cut = [[(self.words(part), None) if special is None else ((), special) for part, special in self.parts(text)]
                   for text in group]
            values = self._learn(set().union(*(words for own in cut for words, _ in own)), form)
            for own in cut:
                out = []
                for words, special in own:
                    out += map(values.__getitem__, words) if special is None else [form([special])]
                yield out

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of every text as 32-bit numbers."""
        for values in self.code(texts, _as_array):
            yield np.frombuffer(b"".join(values), np.int32)

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text])).tolist()

    def told(self, ids: list[int]) -> tuple[str, bytes]:
        """Ids as decimals joined by commas, and the bytes they stand for."""
        decimal, token = self.merger.decimal, self.merger.token
        return ",".join([decimal[i] for i in ids]), b"".join([token[i] for i in ids])

    def digests(self, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the ids, SHA-256 of the text they decode to; built by words."""
        for values in self.code(texts, self.told):
            ids = ",".join([v[0] for v in values])
            decoded = b"".join([v[1] for v in values]).decode("utf-8", "replace")
            yield (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                   hashlib.sha256(decoded.encode()).hexdigest())

    def digest(self, text: str) -> tuple[int, str, str]:
        return next(self.digests([text]))

    def decode(self, ids: list[int]) -> str:
        token = self.merger.token
        return b"".join([token[i] for i in ids]).decode("utf-8", "replace")


def _as_array(ids: list[int]) -> array:
    return array("i", ids)


def count_words(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(word, n) over all texts; each task sends a word once."""
    arrow_rows(docs.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec, seen = Codec.of(tokenizer, None), Counter()

        def told() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(seen), "n": list(seen.values())})
            seen.clear()
            return out

        for pdf in frames:
            for t in pdf["t"]:
                for part, special in codec.parts(t):
                    if special is None:
                        seen.update(codec.words(part))
                if len(seen) > COUNT_WORDS:
                    yield told()
        yield told()

    return (docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
            .mapInPandas(filled(count), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> DataFrame:
    """The words of the highest counts, as many whole counts as fit into ``words``; no word seen once.

    The least count is read off the table (count, number of words), so that no task merges the
    tasks' tops.
    """
    counts = scratch_table(count_words(docs, tokenizer).where(
        (F.col("n") > 1) & (F.octet_length("word") <= LEXICON_WORD_BYTES)), "counts")
    room, least = words, None
    for n, size in counts.groupBy("n").agg(F.count("*").alias("size")).orderBy(F.desc("n")).limit(words).collect():
        room -= size
        if room < 0:
            break
        least = n
    return counts.where(F.lit(False) if least is None else F.col("n") >= least).select("word")


def build_lexicon(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> bytes:
    """Compile the most frequent words, ``words`` at most, into a transducer.

    At most ``words`` short rows reach the driver; they are merged on the executors.
    """
    top = frequent_words(docs, tokenizer, words)

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merger = Codec.of(tokenizer, None).merger
        for pdf in frames:
            yield pd.DataFrame({"word": pdf["word"], "ids": merger.merge_all([w.encode() for w in pdf["word"]])})

    rows = top.repartition(F.xxhash64("word")).mapInPandas(filled(merge), "word string, ids array<int>").toPandas()
    return Transducer.compile(sorted((w.encode(), list(ids)) for w, ids in zip(rows["word"], rows["ids"])))


def ship(spark: SparkSession, data: bytes) -> str:
    """Put the compiled file into the shared scratch folder and have executors fetch it; returns its name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{scratch_path(spark, 'lexicon')}/{name}"
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path)
    return name


def encode_texts(docs: DataFrame, tokenizer: str, lexicon: str, text: str = "text") -> DataFrame:
    """``docs`` plus the column ``ids``."""
    arrow_rows(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(tokenizer, SparkFiles.get(lexicon), ENCODE_MEMO)
        for texts in batches:
            yield pd.Series(list(codec.encode_all(t or "" for t in texts)), dtype=object)
        Codec.kept.clear()  # an idle worker keeps no memory from the stages that follow

    return docs.withColumn("ids", ids(F.col(text).cast("string")))


def digests(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    spark = docs.sparkSession
    arrow_rows(spark)
    lexicon = ship(spark, build_lexicon(docs, tokenizer, words))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec.of(tokenizer, SparkFiles.get(lexicon))
        for pdf in frames:
            made = pd.DataFrame(list(codec.digests(pdf["t"])), columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            made.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield made

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
            .mapInPandas(filled(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
