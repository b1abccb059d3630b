"""Byte-level BPE by speculation and verification.

A pre-token ("word") is first cut greedily into the longest tokens. That guess is BPE's result if, at every seam of two
tokens, no merge across the seam could have come before the merges that built the two sides. The right side of the left
token passes through few pieces (its right spine), the left side of the right token through few as well; a vectorised
test looks up every pair of such pieces among the merges. Only words with a failing seam are merged exactly.

A null text counts as empty and has no tokens; control strings of the vocabulary are their own tokens, as in the
tokenizers library; texts are encoded whole, whatever their length; repeated rows each get their tokens; an empty table
gives an empty result; further columns of the input are ignored. A worker holds the texts of one Arrow batch, the output of
about GROUP_CHARS characters and what it knows of KEPT_WORDS words.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import kept_by_worker, thrifty

#: Fixed value: the published pattern that cuts a text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that a Python worker keeps the tokens of.
KEPT_WORDS = 150_000
#: Bytes of a word that is merged in a list.
SHORT = 64
#: Characters of the texts whose new words are encoded together and whose rows leave together, about; a longer text is a group by itself.
GROUP_CHARS = 1_000_000
NEVER = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable bytes are themselves, others follow 255 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def cutters() -> tuple[Callable[[str], list[str]], Callable[[str], list[str]]]:
    """PATTERN's findall for any text, and a faster one for texts whose characters are all below 2^16.

    That one lists the characters which the first takes for letters, numbers and white space, and tries the most usual
    words first; as no two of its parts but the last begin alike, the order changes nothing.
    """
    low = "".join(map(chr, range(1 << 16)))

    def members(of: str) -> str:
        ends: list[list[int]] = []
        for c in map(ord, regex.findall(of, low)):
            if ends and ends[-1][1] == c - 1:
                ends[-1][1] = c
            else:
                ends.append([c, c])
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ends)

    letter, number, space = map(members, (r"\p{L}", r"\p{N}", r"\s"))
    short = rf" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    return regex.compile(PATTERN).findall, re.compile(short).findall


def cut(text: str) -> list[str]:
    """The words of a text."""
    every, low = cutters()
    return low(text) if text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else every(text)


class Probe:
    """A table from non-negative 62-bit keys to values, looked up a whole array at a time; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            rest = np.ones(len(keys), dtype=bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


class Merger:
    """Tokens, merges and the tables for seams of one vocabulary file (JSON of the tokenizers library)."""

    def __init__(self, source: str) -> None:
        held = json.loads(source)
        model = held["model"]
        letters = byte_letters()
        self.specials = {t["content"]: t["id"] for t in held["added_tokens"]}
        names = {k: v for k, v in model["vocab"].items() if k not in self.specials}
        as_bytes = {k: bytes(letters[c] for c in k) for k in names}
        self.size = max([*names.values(), *self.specials.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for k, v in names.items():
            self.bytes_of[v] = as_bytes[k]
        for k, v in self.specials.items():
            self.bytes_of[v] = k.encode()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = {(names[a], names[b]): (rank, names[a + b]) for rank, (a, b) in enumerate(pairs)}
        rank = np.full(self.size, -1, dtype=np.int64)
        halves: dict[int, tuple[int, int]] = {}
        for (a, b), (r, t) in self.merges.items():
            if t not in halves:
                rank[t], halves[t] = r, (a, b)
        self.single = {self.bytes_of[v][0]: v for v in names.values() if len(self.bytes_of[v]) == 1}
        #: Seams can be tested if a merge always comes after those of its halves and makes a token in one way.
        self.testable = len(halves) == len(self.merges) and all(r > max(rank[a], rank[b]) for (a, b), (r, _) in self.merges.items())
        keys = np.array([a * self.size + b for a, b in self.merges], dtype=np.int64)
        self.ranks = Probe(keys, np.array([r for r, _ in self.merges.values()], dtype=np.int32))
        self.made = np.zeros(len(pairs) + 1, dtype=np.int32)
        self.made[[r for r, _ in self.merges.values()]] = [t for _, t in self.merges.values()]
        self.byte_id = np.zeros(256, dtype=np.int32)
        self.byte_id[list(self.single)] = list(self.single.values())
        self.right, self.right_until = self._spines(halves, rank, 1)
        self.left, self.left_until = self._spines(halves, rank, 0)
        # A token that its own bytes don't merge into is never a guess.
        self.guess = {self.bytes_of[v]: v for v in names.values() if self.exact(self.bytes_of[v]) == [v]}
        self.longest = max(map(len, self.guess))
        nodes: dict[tuple[int, int], int] = {}
        accept = [-1]
        for word, t in self.guess.items():
            node = 0
            for b in word:
                if (step := nodes.get((node, b))) is None:
                    step = nodes[node, b] = len(accept)
                    accept.append(-1)
                node = step
            accept[node] = t
        self.steps = Probe(np.array([n * 256 + b for n, b in nodes], dtype=np.int64), np.array(list(nodes.values()), dtype=np.int32))
        self.accept = np.array(accept, dtype=np.int32)

    def _spines(self, halves: dict[int, tuple[int, int]], rank: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """For each token the pieces at one end while it is built, and the rank of the merge that uses each up."""
        all_pieces = []
        for t in range(self.size):
            pieces, until = [t], [NEVER]
            while t in halves:
                until.append(rank[t])
                t = halves[t][side]
                pieces.append(t)
            all_pieces.append((pieces, until))
        wide = max(len(p) for p, _ in all_pieces)
        piece, until = np.full((self.size, wide), -1, dtype=np.int64), np.full((self.size, wide), -1, dtype=np.int64)
        for t, (p, u) in enumerate(all_pieces):
            piece[t, : len(p)], until[t, : len(u)] = p, u
        return piece, until

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a[k], b[k] stay side by side: no merge across the seam comes before both sides are done.

        On equal ranks the merge further left comes first: that is the left token's own, and else the seam's.
        """
        ok = np.ones(len(a), dtype=bool)
        for i in range(self.right.shape[1]):
            x, x_until = self.right[a, i], self.right_until[a, i]
            if not (live := x >= 0).any():
                break
            for j in range(self.left.shape[1]):
                y, y_until = self.left[b, j], self.left_until[b, j]
                at = np.flatnonzero(live & (y >= 0) & ok)
                if not len(at):
                    break
                r = self.ranks.get(x[at] * self.size + y[at])
                ok[at[(r < x_until[at]) & (r <= y_until[at]) & (r >= 0)]] = False
        return ok

    def exact(self, word: bytes) -> list[int]:
        """Merges by rank, then place: in a list for usual words, with a heap over a linked list for long ones."""
        ids: list[int] = [self.single[b] for b in word]
        if len(ids) <= SHORT:
            get, none = self.merges.get, (NEVER, -1)
            pairs = [get(x, none) for x in zip(ids, ids[1:])]
            while pairs and (best := min(pairs))[0] < NEVER:
                k = pairs.index(best)
                ids[k : k + 2] = [best[1]]
                del pairs[k]
                if k:
                    pairs[k - 1] = get((ids[k - 1], ids[k]), none)
                if k < len(pairs):
                    pairs[k] = get((ids[k], ids[k + 1]), none)
            return ids
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m[0], k, ids[k], ids[k + 1]) for k in range(len(ids) - 1) if (m := self.merges.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            n = after[k]
            if ids[k] != a or n >= len(ids) or ids[n] != b:
                continue
            ids[k], ids[n] = self.merges[a, b][1], -1
            after[k] = after[n]
            if after[n] < len(ids):
                before[after[n]] = k
                if m := self.merges.get((ids[k], ids[after[k]])):
                    heapq.heappush(heap, (m[0], k, ids[k], ids[after[k]]))
            if before[k] >= 0 and (m := self.merges.get((ids[before[k]], ids[k]))):
                heapq.heappush(heap, (m[0], before[k], ids[before[k]], ids[k]))
        return [t for t in ids if t >= 0]

    def greedy(self, word: bytes) -> list[int]:
        out, at, guess, longest, n = [], 0, self.guess, self.longest, len(word)
        while at < n:
            end = min(n, at + longest)
            while (t := guess.get(word[at:end])) is None:
                end -= 1
            out.append(t)
            at = end
        return out

    def guesses(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, the word each is of) of greedy longest match: all words walk the tree of tokens side by side."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        held = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
        end = np.cumsum(sizes)
        word = np.flatnonzero(sizes)
        end, at = end[word], (end - sizes)[word]
        node, token, after = np.zeros(len(word), dtype=np.int64), np.full(len(word), -1, dtype=np.int32), at.copy()
        tokens, of = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        while len(word):
            step = self.steps.get(node * 256 + held[at])
            step[at >= end] = -1
            go = step >= 0
            taken = np.where(go, self.accept[step], -1)
            token, after = np.where(taken >= 0, taken, token), np.where(taken >= 0, at + 1, after)
            stop = ~go
            tokens.append(token[stop])
            of.append(word[stop])
            node, at = np.where(go, step, 0), np.where(go, at + 1, after)
            keep = go | (after < end)
            word, end, node, token, after, at = word[keep], end[keep], node[keep], token[keep], after[keep], at[keep]
        flat, owner = np.concatenate(tokens), np.concatenate(of)
        order = np.argsort(owner, kind="stable")
        return flat[order].astype(np.int64), owner[order]

    def exact_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, the word each is of) of exact() of words of SHORT bytes at most: each round merges the best pair of every word that has one."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        none = np.iinfo(np.int32).max
        tokens, of = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]

        def rank(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            r = self.ranks.get(np.maximum(x, 0).astype(np.int64) * self.size + np.maximum(y, 0))
            return np.where((x < 0) | (y < 0) | (r < 0), none, r).astype(np.int32)

        for k in range(0, len(order), 4096):
            row = order[k : k + 4096]
            ids = np.full((len(row), sizes[row].max() + 1), -1, dtype=np.int32)
            ids[np.arange(ids.shape[1]) < sizes[row, None]] = self.byte_id[np.frombuffer(b"".join([words[j] for j in row.tolist()]), dtype=np.uint8)]
            wide = np.arange(ids.shape[1] - 1)
            ranks = rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(row), -1)
            while len(row):
                best = ranks.argmin(axis=1)
                r = ranks[np.arange(len(row)), best]
                done = r == none
                if done.any():
                    held = ids[done]
                    tokens.append(held[held >= 0])
                    of.append(np.repeat(row[done], (held >= 0).sum(axis=1)))
                    row, ids, ranks, best, r = row[~done], ids[~done], ranks[~done], best[~done], r[~done]
                    if not len(row):
                        break
                n = np.arange(len(row))
                ids[:, 1:-1] = np.where(wide[1:] > best[:, None], ids[:, 2:], ids[:, 1:-1])
                ids[n, best] = self.made[r]
                ranks[:, :-1] = np.where(wide[:-1] > best[:, None], ranks[:, 1:], ranks[:, :-1])
                ranks[n, best] = rank(ids[n, best], ids[n, best + 1])
                left = np.flatnonzero(best)
                ranks[left, best[left] - 1] = rank(ids[left, best[left] - 1], ids[left, best[left]])
        return np.concatenate(tokens).astype(np.int64), np.concatenate(of)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        flat, ends = (x.tolist() for x in self.encode_flat(words))
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the words' tokens one after the other, where each word's end).

        Guesses all words, tests all seams at once, merges exactly the words with a failing seam.
        """
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))

        def each(how: Callable[[bytes], list[int]], some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            made = [how(raw[k]) for k in some.tolist()]
            return np.fromiter(chain.from_iterable(made), dtype=np.int64), np.repeat(some, [len(x) for x in made])

        if not self.testable:
            flat, of = each(self.exact, np.arange(len(raw)))
            return flat, np.cumsum(np.bincount(of, minlength=len(raw)))
        short, long = np.flatnonzero(sizes <= SHORT), np.flatnonzero(sizes > SHORT)
        flat, of = self.guesses([raw[k] for k in short.tolist()])
        more, whose = each(self.greedy, long)
        flat, of = np.concatenate([flat, more]), np.concatenate([short[of], whose])
        seam = np.flatnonzero(of[1:] == of[:-1])
        pairs, back = np.unique(flat[seam] * self.size + flat[seam + 1], return_inverse=True)
        failed = np.zeros(len(raw), dtype=bool)
        failed[of[seam[~self.compatible(pairs // self.size, pairs % self.size)[back]]]] = True
        few = np.flatnonzero(failed & (sizes <= SHORT))
        again, at = self.exact_many([raw[k] for k in few.tolist()])
        more, whose = each(self.exact, np.flatnonzero(failed & (sizes > SHORT)))
        stay = ~failed[of]
        flat, of = np.concatenate([flat[stay], again, more]), np.concatenate([of[stay], few[at], whose])
        return flat[np.argsort(of, kind="stable")], np.cumsum(np.bincount(of, minlength=len(raw)))


def decimal(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


class Numbers(dict):
    """word -> its number, in the order of their first looks."""

    def __missing__(self, word: object) -> int:
        self[word] = n = len(self)
        return n


class Encoder:
    """Encodes and decodes texts with a Merger, keeping the tokens of the words seen last, as bytes in the form of `show`."""

    def __init__(self, merger: Merger, show: Callable[[list[int]], bytes] = packed) -> None:
        self.merger, self.show, self.glue = merger, show, b"," if show is decimal else b""
        self.named = [show([t]) for t in range(merger.size)]
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(merger.specials, key=len, reverse=True))) + ")") if merger.specials else None
        self.numbers, self.shown, self.raw = Numbers(), [], []
        for text, t in merger.specials.items():  # keys that no word equals
            self.numbers[(text,)] = len(self.numbers)
            self.shown.append(show([t]))
            self.raw.append(text.encode())

    def split(self, text: str) -> list:
        """The words of a text and, as tuples, its control strings."""
        if self.special is None or not self.special.search(text):
            return cut(text)
        parts = self.special.split(text)
        return list(chain.from_iterable([(p,)] if k % 2 else cut(p) for k, p in enumerate(parts)))

    def learn(self, split: list[list]) -> np.ndarray:
        """The numbers of all words of these texts; words not known yet get tokens in one call of encode_flat: its tests are vectorised."""
        known = len(self.shown)
        found = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        if len(self.numbers) > max(known, KEPT_WORDS):  # only the words of these texts stay, and control strings
            held, fixed = list(self.numbers), len(self.merger.specials)
            stay = np.union1d(np.arange(fixed), found)
            found = np.searchsorted(stay, found)
            stay = stay.tolist()
            self.numbers = Numbers(zip(map(held.__getitem__, stay), range(len(stay)), strict=False))
            self.shown, self.raw = ([x[k] for k in stay if k < known] for x in (self.shown, self.raw))
            known = len(self.shown)
        if len(self.numbers) > known:
            flat, ends = self.merger.encode_flat(list(self.numbers)[known:])
            self.shown += self._cut(flat, ends, self.named, self.glue)
            self.raw += self._cut(flat, ends, self.merger.bytes_of, b"")
        return found

    @staticmethod
    def _cut(flat: np.ndarray, ends: np.ndarray, names: list[bytes], glue: bytes) -> list[bytes]:
        """The names of each word's tokens joined: all are joined once and cut where words end."""
        whole = glue.join(map(names.__getitem__, flat.tolist()))
        sizes = np.fromiter(map(len, names), dtype=np.int64, count=len(names)) + len(glue)
        upto = np.concatenate([[0], np.cumsum(sizes[flat])])[np.concatenate([[0], ends])]
        return [whole[a:b] for a, b in zip(upto[:-1].tolist(), np.maximum(upto[:-1], upto[1:] - len(glue)).tolist(), strict=True)]

    def groups(self, texts: Iterable[str]) -> Iterator[tuple[list[bytes], list[bytes]]]:
        """(shown tokens, decoded bytes) of the texts, about GROUP_CHARS characters at a time."""
        split: list[list] = []
        chars = 0
        for text in chain(texts, [None]):
            if split and (text is None or chars + len(text) > GROUP_CHARS):
                found, at = self.learn(split).tolist(), [0, *accumulate(map(len, split))]
                shown, raw = self.shown.__getitem__, self.raw.__getitem__
                words = [found[a:b] for a, b in zip(at, at[1:], strict=False)]
                yield [self.glue.join(map(shown, w)) for w in words], [b"".join(map(raw, w)) for w in words]
                split, chars = [], 0
            if text is not None:
                split.append(self.split(text))
                chars += len(text)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(next(self.groups(iter([text])))[0][0], dtype=np.int32).tolist()


def read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def load(path: str) -> Merger:
    return Merger(read(path))


def list_array(rows: list[bytes], kind: pa.DataType, value: pa.DataType | None = None, width: int = 1) -> pa.Array:
    """Rows of bytes as an Arrow array of strings or of lists."""
    ends = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) // width for r in rows], out=ends[1:])
    held = pa.py_buffer(b"".join(rows))
    if value is None:
        return pa.Array.from_buffers(kind, len(rows), [None, pa.py_buffer(ends), held])
    return pa.ListArray.from_arrays(pa.array(ends), pa.Array.from_buffers(value, int(ends[-1]), [None, held]))


def encode_table(documents: DataFrame, vocabulary: str, digests: bool = False) -> DataFrame:
    """doc_id with tokens (array<int>) and decoded text of every row, or with their count and digests.

    vocabulary: a file's path, read by the driver; its text goes to the executors once (a few MB, whatever the corpus),
    and each worker makes its tables from it.
    """
    spark = documents.sparkSession
    source = read(vocabulary)
    shipped, mark = spark.sparkContext.broadcast(source), hashlib.sha256(source.encode()).hexdigest()
    kind = documents.schema["doc_id"].dataType.simpleString()
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "tokens array<int>, decoded string"

    def utf8(raw: bytes) -> bytes:
        return raw if raw.isascii() else raw.decode("utf-8", "replace").encode()

    def digest(x: bytes) -> str:
        return hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept_by_worker((mark, digests), lambda: Encoder(Merger(shipped.value), decimal if digests else packed))
        for batch in batches:
            at = 0
            for shown, raw in coder.groups(x.as_py() or "" for x in batch.column(1)):
                ids = batch.column(0).slice(at, len(shown))
                at += len(shown)
                if digests:
                    counts = pa.array([x.count(b",") + 1 if x else 0 for x in shown], pa.int64())
                    columns = [ids, counts, pa.array(map(digest, shown), pa.string()), pa.array((digest(utf8(x)) for x in raw), pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    columns = [ids, list_array(shown, pa.list_(pa.int32()), pa.int32(), 4), list_array([utf8(x) for x in raw], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tokens", "decoded"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(thrifty(run, keep=True), f"doc_id {kind}, {made}")
