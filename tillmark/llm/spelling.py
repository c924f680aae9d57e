"""Spelling variants: words one edit apart, found by pivotal grams.

Every word has a prefix: its bigrams up to the rank of its third rarest one (rank: by how many
words hold a bigram, then by the bigram). Any three bigrams hold two that do not overlap; dynamic
programming picks the rarest such pair as the word's pivots. Of two words one edit apart, take the
one whose prefix ends at the lower rank. One edit cannot break both of its pivots, and an unbroken
one is a bigram of the other word's prefix. So pivots are joined with prefixes, never with all
bigrams.

The one edit also fixes where the rest of a word stands, and the join key says so:

* left of the first pivot: both words end alike from that pivot on;
* right of the second pivot: both begin alike up to that pivot's end;
* from the first pivot to the end of the second: both begin and end alike around a zone of two
  letters of the other word, which are one, two or three letters here. The zones cover the stretch
  between the pivots once for each of these widths.

What meets by key must have an odd number of nearly the same letters and is verified by edit
distance. A word sends a number of keys in proportion to its length, however many words there are;
keys travel with 64-bit ids, the words themselves only for verification.

Edge cases: a null text has no words, a null id counts as empty in the checksum; repeated rows
count again; runs of any length are words (their keys grow with their length); equal numbers go
to the smaller word; an empty table gives no rows; other columns are left behind.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.frames import bounded
from tillmark.llm.words import mixed
from tillmark.session import cut_lineage

PREFIX = 3  # bigrams of a prefix; with one edit allowed, any three hold two that are disjoint
HELD_WORDS = 200_000  # distinct words a task counts before it passes its counts on
KEY_ROWS = 1 << 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_FACTOR = 0x9E3779B97F4A7C15
_BEGINS, _ENDS, _AROUND = (np.uint64(salt) for salt in (0x51, 0xA3, 0xE7))


def planted_slip(word: bytes, key: bytes, every: int) -> bytes:
    """The word without one letter where the checksum of ``key:word`` is divisible by ``every``."""
    sum_of = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), key)
    if sum_of % every:
        return word
    place = sum_of % len(word)
    return word[:place] + word[place + 1 :]


def word_counts(
    docs: DataFrame,
    shortest: int = 7,
    fewest: int = 2,
    slip_every: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z in lower case, with so many letters and occurrences.

    With ``slip_every``, occurrences are damaged first (see ``planted_slip``).
    """
    run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % shortest)

    def found(number, content: str) -> Iterator[tuple[bytes, int]]:
        # In Latin-1 every letter of a run is one byte; all else becomes a question mark.
        counted = Counter(run.findall(content.encode("latin-1", "replace").translate(_LOWER)))
        if not slip_every:
            yield from counted.items()
            return
        start = zlib.crc32(b"%s:" % (b"" if number is None else str(number).encode()))
        for word, n in counted.items():
            word = planted_slip(word, start, slip_every)
            if len(word) >= shortest:
                yield word, n

    def passed(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays(
            [words, pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for part in bounded(batch):
                for number, content in zip(*(column.to_pylist() for column in part.columns)):
                    for word, n in found(number, content):
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield passed(held)
                    held = Counter()
        if held:
            yield passed(held)

    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")
    ).filter(F.col("text").isNotNull())
    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def gram_counts(words: DataFrame) -> np.ndarray:
    """How many places of all words each pair of letters has, as a table of 256 times 256.

    Collected as one row per pair of Latin letters, which bounds it whatever the words.
    """

    def count(batches):
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for _, letters in _by_length(batch.column("word")):
                total += np.bincount(_grams(letters).ravel(), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["gram", "n"]
        )

    counted = (
        words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n"))
    ).collect()
    total = np.zeros(1 << 16, dtype=np.int64)
    for gram, n in counted:
        total[gram] = n
    return total


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and letters (one row per word) of the words of each length."""
    coded = [w.encode("latin-1") for w in words.to_pylist()]
    lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
    for length in np.unique(lengths):
        for places in _slices(np.flatnonzero(lengths == length), int(length)):
            joined = b"".join(coded[i] for i in places)
            yield places, np.frombuffer(joined, dtype=np.uint8).reshape(len(places), length)


def _slices(places: np.ndarray, length: int) -> Iterator[np.ndarray]:
    step = max((1 << 20) // length, 1)
    for start in range(0, len(places), step):
        yield places[start : start + step]


def _grams(letters: np.ndarray) -> np.ndarray:
    return letters[:, :-1].astype(np.int64) << 8 | letters[:, 1:]


def pivots(counts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places, at least two apart and both allowed, whose counts have the least sum.

    By dynamic programming from left to right: the best single place up to two before each one,
    and the best pair that ends there. Ties go to the pair that ends first.
    """
    far = np.int64(1) << 60
    cost = np.where(allowed, counts, far)
    words, places = cost.shape
    single, single_at = cost[:, 0].copy(), np.zeros(words, np.int64)
    best = np.full(words, 2 * far)
    first, second = np.zeros(words, np.int64), np.zeros(words, np.int64)
    for place in range(2, places):
        pair = single + cost[:, place]
        better = pair < best
        best[better], first[better], second[better] = pair[better], single_at[better], place
        later = cost[:, place - 1] < single
        single[later], single_at[later] = cost[later, place - 1], place - 1
    return first, second


class _Keys:
    """Hashes of all beginnings and endings of equally long words: begins[i, k] is for the first k
    letters of word i, ends[i, k] for those from place k on."""

    def __init__(self, letters: np.ndarray) -> None:
        self.size, self.length = letters.shape
        values = mixed(letters.astype(np.uint64) + np.uint64(_FACTOR))
        values *= np.cumprod(np.full(self.length, _FACTOR, dtype=np.uint64))
        none = np.zeros((self.size, 1), np.uint64)
        known = np.arange(self.length + 1, dtype=np.uint64)
        self.begins = mixed(np.hstack([none, np.cumsum(values, axis=1)]) + known) ^ _BEGINS
        values = mixed(letters[:, ::-1].astype(np.uint64) + np.uint64(_FACTOR))
        values *= np.cumprod(np.full(self.length, _FACTOR, dtype=np.uint64))
        endings = np.hstack([none, np.cumsum(values, axis=1)])
        self.ends = (mixed(endings + known) ^ _ENDS)[:, ::-1]


def _around(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed(begin * np.uint64(3) + end) ^ _AROUND


def probes(keys: _Keys, first: np.ndarray, second: np.ndarray):
    """(row, key) of what a word asks for, from the places of its pivots."""
    every = np.arange(keys.size)
    yield every, keys.ends[every, first]
    yield every, keys.begins[every, second + 2]
    stretch = second + 2 - first
    # Width and distance of the zones here; one letter has a gap on either side.
    for width, step in ((1, 2), (2, 2), (3, 3)):
        count = (stretch + step - 1) // step
        row = np.repeat(every, count)
        number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = np.minimum(first[row] + step * number, second[row] + 2 - width)
        yield row, _around(keys.begins[row, start], keys.ends[row, start + width])


def entries(keys: _Keys, prefix: np.ndarray):
    """(row, key) of what a word answers to, from the places of its prefix.

    Two disjoint pivots lie in every beginning and ending asked for, so those of less than four
    letters are left out.
    """
    row, place = np.nonzero(prefix[:, : keys.length - 3])
    yield row, keys.ends[row, place]
    row, place = np.nonzero(prefix[:, 2:])
    yield row, keys.begins[row, place + 4]
    zones = _around(keys.begins[:, :-2], keys.ends[:, 2:])
    yield np.repeat(np.arange(keys.size), zones.shape[1]), zones.ravel()


def _odd_letters(letters: np.ndarray) -> np.ndarray:
    """A bit for each letter (modulo 31) that a word has an odd number of times.

    One edit changes at most two of them.
    """
    bits = np.int32(1) << (letters % np.uint8(31)).astype(np.int32)
    return np.bitwise_xor.reduce(bits, axis=1)


def _keyed(words: DataFrame, counts: np.ndarray, asking: bool) -> DataFrame:
    """(key, id, odd, reach) of the probes or the entries of all words."""
    order = np.lexsort((np.arange(len(counts)), counts))
    ranks = np.empty(len(counts), dtype=np.int64)
    ranks[order] = np.arange(len(counts))
    shared = words.sparkSession.sparkContext.broadcast((counts, ranks))

    def convert(batches):
        number, rank = shared.value
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            for places, letters in _by_length(batch.column("word")):
                grams = _grams(letters)
                order = rank[grams]
                reach = np.partition(order, PREFIX - 1, axis=1)[:, PREFIX - 1]
                prefix = order <= reach[:, None]
                keys, odd = _Keys(letters), _odd_letters(letters)
                if asking:
                    found = probes(keys, *pivots(number[grams], prefix))
                else:
                    found = entries(keys, prefix)
                row, key = (np.concatenate(parts) for parts in zip(*found))
                for i in range(0, len(row), KEY_ROWS):
                    part = row[i : i + KEY_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[i : i + KEY_ROWS].view(np.int64)),
                            pa.array(ids[places[part]]),
                            pa.array(odd[part]),
                            pa.array(reach[part].astype(np.int32)),
                        ],
                        names=["key", "id", "odd", "reach"],
                    )

    return words.mapInArrow(convert, "key long, id long, odd int, reach int")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): pairs of the words one edit apart, each once with a < b.

    ``words`` has unique words of at least four Latin-1 letters, and their numbers ``n``; it
    should be stored, as it is read several times.
    """
    known = words.select(F.xxhash64("word").alias("id"), "word", "n")
    counts = gram_counts(known)
    asking = _keyed(known.select("id", "word"), counts, True).alias("x")
    answering = _keyed(known.select("id", "word"), counts, False).alias("y")
    met = (
        asking.join(
            answering,
            (F.col("x.key") == F.col("y.key"))
            & (F.bit_count(F.col("x.odd").bitwiseXOR(F.col("y.odd"))) <= 2)
            & (F.col("x.reach") <= F.col("y.reach"))
            & (F.col("x.id") != F.col("y.id")),
        )
        .select(F.least("x.id", "y.id").alias("low"), F.greatest("x.id", "y.id").alias("high"))
        .distinct()
    )
    left = known.select(F.col("id").alias("low"), F.col("word").alias("l"), F.col("n").alias("l_n"))
    right = known.select(F.col("id").alias("high"), F.col("word").alias("h"), F.col("n").alias("h_n"))
    pairs = met.join(left, "low").join(right, "high")
    near = pairs.filter(F.levenshtein("l", "h", 1) == 1)
    swapped = F.col("l") > F.col("h")
    return near.select(
        F.least("l", "h").alias("a"),
        F.when(swapped, F.col("h_n")).otherwise(F.col("l_n")).alias("a_n"),
        F.greatest("l", "h").alias("b"),
        F.when(swapped, F.col("l_n")).otherwise(F.col("h_n")).alias("b_n"),
    )


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Each word with its form (the near word of largest number, if that is ``ratio`` times its own)
    and the last form that forms lead to.

    ``words`` has unique words and their numbers ``n``. A word has no more near words than there
    are edits of it, so grouping by word needs no splitting.
    """
    words = cut_lineage(words.select("word", "n"))
    pairs = near_pairs(words)
    both = pairs.select(
        F.explode(F.array(_seen_from("a", "b"), _seen_from("b", "a"))).alias("row")
    ).select("row.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    strong = -F.col("best.n") >= ratio * F.col("n")
    grouped = cut_lineage(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"),
            F.when(strong, -F.col("best.n")).alias("form_n"),
        )
    )
    roots = _roots(grouped)
    return grouped.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _seen_from(word: str, near: str):
    """The near word, so that the least one has the largest number, then the least letters."""
    other = F.struct((-F.col(f"{near}_n")).alias("n"), F.col(near).alias("near"))
    return F.struct(F.col(word).alias("word"), other.alias("other"))


def _roots(grouped: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form.

    Forms have larger numbers, so they lead to an end; every round doubles the steps taken.
    """
    led = grouped.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        led = cut_lineage(led)
        onward = led.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if led.join(onward, "root", "left_semi").isEmpty():
            return led
        led = led.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
