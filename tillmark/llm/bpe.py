"""Byte-level BPE, speculate and verify.

A word (one match of the pre-tokenizer's pattern) is first cut greedily into the longest tokens.
A cut is what merging in rank order would give exactly if every two neighbours in it are
compatible: merging the bytes of the two alone gives back the two. That is tested for all adjacent
pairs of all new words at once, by taking back the latest merge on either side of the boundary,
step by step, and asking whether the two tokens now at the boundary would have merged before.
Only words with an incompatible pair are merged exactly. Words already seen come from a cache.

The tokenizer file (its path is a parameter) gives vocabulary, ranked merges and special strings.
It must be readable at that path by every executor.

Edge cases: a null text is empty and has no tokens; a special string in a text becomes its own
id, as with the library's defaults; rows are encoded one by one, so repeated rows, an empty table
and other columns do not matter. Long texts are cut into bounded runs of words, so memory holds
one text and its ids.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.frames import bounded, texts

# Fixed value: the pre-tokenizer pattern of the byte-level vocabulary, as published with it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# The library's \s is the Unicode property; Python's adds four control characters.
_WORDS = regex.compile(
    PATTERN.replace(r"[^\s", r"[^\p{White_Space}")
    .replace(r"\S", r"\P{White_Space}")
    .replace(r"\s", r"\p{White_Space}")
)
# The same for texts of Latin-1 letters only, which the standard library matches faster.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_LATIN_WORDS = re.compile(
    PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{_S}{_L}{_N}]")
    .replace(r"\p{L}", f"[{_L}]")
    .replace(r"\p{N}", f"[{_N}]")
    .replace(r"\S", f"[^{_S}]")
    .replace(r"\s", f"[{_S}]")
)
_NEVER = np.iinfo(np.int64).max
RUN_CHARS = 1 << 20
CACHED_WORDS = 400_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: itself where it is
    visible in Latin-1, else the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _words(text: str) -> re.Pattern | regex.Pattern:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORDS
    return _LATIN_WORDS


def _packed(ids) -> bytes:
    """Ids as they lie in an array of 32-bit integers."""
    return array("i", ids).tobytes()


class Vocabulary:
    """Tokens, merges and the tests on them. ``packed`` caches the ids of words as bytes, which are
    smaller than tuples and joined faster."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        ids = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in ids.items():
            if token not in self.special:
                self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.left = np.full(size, -1)
        self.right = np.full(size, -1)
        self.rank = np.full(size, -1)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, both = ids[a], ids[b], ids[a + b]
            self.merges[left, right] = (rank, both)
            self.left[both], self.right[both], self.rank[both] = left, right, rank
        self.size = size
        pairs = np.array([a * size + b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(pairs)
        self._pairs = np.append(pairs[order], _NEVER)
        self._ranks = np.append(np.array([r for r, _ in self.merges.values()])[order], _NEVER)
        self.byte_ids = [ids[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        # Tokens that merging can produce: the halves stay apart until their own merge.
        merged = np.flatnonzero(self.rank >= 0)
        ok = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        usable = [*self.byte_ids, *merged[ok].tolist()]
        self.tokens = {self.bytes[i]: i for i in usable}
        self.longest = max(map(len, self.tokens))
        self.packed: dict[str, bytes] = {}
        self._special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")

    @property
    def words(self) -> dict[str, tuple[int, ...]]:
        """The cached words with their ids."""
        return {word: tuple(array("i", ids)) for word, ids in self.packed.items()}

    def compatible(self, a, b, limit=None) -> np.ndarray:
        """Whether no merge crosses the boundary between a and b (before ``limit``, a rank)."""
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        ok = np.ones(len(a), dtype=bool)
        before = np.full(len(a), _NEVER) if limit is None else np.array(limit, dtype=np.int64)
        at = np.arange(len(a))
        while len(at):
            x, y = a[at], b[at]
            key = x * self.size + y
            place = np.searchsorted(self._pairs, key)
            rank = np.where(self._pairs[place] == key, self._ranks[place], _NEVER)
            crosses = rank < before[at]
            ok[at[crosses]] = False
            at = at[~crosses & ((self.rank[x] >= 0) | (self.rank[y] >= 0))]
            x, y = a[at], b[at]
            # Take back the later merge; of two equal ones the right one came later.
            on_left = self.rank[x] > self.rank[y]
            before[at] = np.where(on_left, self.rank[x], self.rank[y] + 1)
            a[at] = np.where(on_left, self.right[x], x)
            b[at] = np.where(on_left, y, self.left[y])
        return ok

    def propose(self, word: bytes) -> tuple[int, ...]:
        tokens, whole = self.tokens, self.tokens.get(word)
        if whole is not None:
            return (whole,)
        ids, start, n = [], 0, len(word)
        while start < n:
            end = min(n, start + self.longest)
            while (token := tokens.get(word[start:end])) is None:
                end -= 1
            ids.append(token)
            start = end
        return tuple(ids)

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Merging in rank order, leftmost first."""
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [
            (self.merges[pair][0], i, *pair)
            for i, pair in enumerate(zip(ids, ids[1:]))
            if pair in self.merges
        ]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q >= 0 and (ids[p], ids[q]) in self.merges:
                    heapq.heappush(queue, (self.merges[ids[p], ids[q]][0], p, ids[p], ids[q]))
        return tuple(i for i in ids if i >= 0)

    def learn(self, words: set[str]) -> None:
        """Put the ids of new words into the cache."""
        fresh = list(words)
        spelled = [w.encode("utf-8", "replace") for w in fresh]
        proposed = [self.propose(w) for w in spelled]
        counts = np.array([len(p) for p in proposed], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(proposed), dtype=np.int64, count=counts.sum())
        owner = np.repeat(np.arange(len(fresh)), counts)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        bad = set(owner[inner[~self.compatible(flat[inner], flat[inner + 1])]].tolist())
        for i, word in enumerate(fresh):
            self.packed[word] = _packed(self.merge(spelled[i]) if i in bad else proposed[i])

    def runs(self, text: str) -> Iterator[list[str] | int]:
        """Bounded runs of words, and the ids of special strings, in order."""
        at, words = 0, _words(text)
        for found in chain(self._special.finditer(text), [None]):
            part = text[at : found.start() if found else len(text)]
            if len(part) <= RUN_CHARS:
                yield words.findall(part)
            else:
                matches = words.finditer(part)
                while run := [m[0] for m in islice(matches, RUN_CHARS // 4)]:
                    yield run
            if found:
                yield self.special[found[0]]
                at = found.end()

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        runs = [list(self.runs(text)) for text in batch]
        seen = set().union(*[run for own in runs for run in own if isinstance(run, list)])
        unseen = seen.difference(self.packed)
        if len(self.packed) + len(unseen) > CACHED_WORDS:
            self.packed.clear()
            unseen = seen
        self.learn(unseen)
        look = self.packed.__getitem__
        for own in runs:
            parts = [
                _packed([run]) if isinstance(run, int) else b"".join(map(look, run)) for run in own
            ]
            out.append(np.frombuffer(b"".join(parts), dtype=np.int32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def round_trip(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, ids (array of int) and the text decoded from them."""

    def convert(batches):
        own = vocabulary(path)
        for batch in batches:
            for part in bounded(batch):
                ids = own.encode(part.column("text").to_pylist())
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                        pa.array([own.decode(i) for i in ids], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return texts(docs, key, text).mapInArrow(
        convert, "doc_id long, ids array<int>, decoded string"
    )


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of a round trip."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
