"""Toxicity by subword-bag embeddings under a linear softmax.

A word is the average of the embeddings of its subwords: its character n-grams (of UTF-8 bytes,
lower case A-Z) and the word itself, hashed into a table. A window of words is the average of its
distinct words, and a linear layer with softmax gives its two class scores. Embeddings and layer are trained
jointly in numpy. A text scores as its most toxic window, so that a few words in a long text count;
training first teaches all windows of a text its label, then only its most toxic one. Misspelt
words never seen still share most n-grams with the ones they come from.

The fit uses a bounded sample of labelled rows (``toxic_rows`` and ``clean_rows``, those of
smallest hash), collected to the driver; scoring covers every row and the whole text. As the layer is linear
and the rest are averages, scoring needs one number per table entry, which is what executors get.

Edge cases: null and empty texts score by the bias alone; labels other than 0 and 1 are ignored;
without labelled rows of both classes every score is the share of toxic rows among those there
are (0 if none); texts of any length are scored whole; repeated rows and other columns, whatever
their names, do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm import words
from tillmark.llm.frames import bounded, free_name, texts, with_text_column

GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
WINDOW = 20


@dataclass
class Model:
    """One score per subword bucket (its embedding times the layer's class difference) and a bias."""

    subwords: np.ndarray
    bias: float


def _buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 17)).astype(np.int64)


def _subwords(split: words.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word, bucket) of every subword, one pair of arrays for each length."""
    lengths = split.ends - split.starts
    found = [(np.arange(len(lengths)), _buckets(words.mixed(split.hashes() + np.uint64(1))))]
    for n in GRAMS:
        counts = np.maximum(lengths - n + 1, 0)
        owner = np.repeat(np.arange(len(lengths)), counts)
        begins = np.cumsum(counts) - counts
        place = np.arange(len(owner)) + np.repeat(split.starts - begins, counts)
        gram = np.full(len(owner), n, dtype=np.uint64)
        for i in range(n):
            gram = gram * np.uint64(257) + split.buffer[place + i]
        found.append((owner, _buckets(words.mixed(gram))))
    return found


def _windows(split: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """The window of each word, and the first window of each text; the last window takes the
    rest, so only texts below WINDOW words have shorter ones."""
    counts = np.diff(split.first)
    parts = np.maximum(counts // WINDOW, 1)
    first = np.concatenate([[0], np.cumsum(parts)])
    inside = np.arange(len(split.starts)) - np.repeat(split.first[:-1], counts)
    own = np.minimum(inside // WINDOW, np.repeat(parts, counts) - 1)
    return own + np.repeat(first[:-1], counts), first


def _prepared(batch: list[bytes]):
    split = words.split(batch, words.SPACES)
    return split, _subwords(split), *_windows(split)


def logits(batch: list[bytes], model: Model) -> np.ndarray:
    """The largest window logit of each text."""
    split, subwords, window, first = _prepared(batch)
    total = np.zeros(len(split.starts))
    number = np.zeros(len(split.starts))
    for owner, bucket in subwords:
        total += np.bincount(owner, model.subwords[bucket], minlength=len(total))
        number += np.bincount(owner, minlength=len(total))
    average = _averages(
        total / np.maximum(number, 1), _once(split, window), window, first[-1]
    )
    return np.maximum.reduceat(average, first[:-1]) + model.bias


def _averages(values: np.ndarray, weights: np.ndarray, group: np.ndarray, groups: int):
    """Weighted sums of each window over its number of words, at least WINDOW of them: a short
    window is filled up with words that say nothing."""
    size = np.bincount(group, minlength=groups)
    return np.bincount(group, values * weights, minlength=groups) / np.maximum(size, WINDOW)


def _once(split: words.Words, window: np.ndarray) -> np.ndarray:
    """1 for the first of equal words in a window, 0 for the others."""
    mark = words.mixed(split.hashes() + window.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    weights = np.zeros(len(mark))
    weights[np.unique(mark, return_index=True)[1]] = 1.0
    return weights


def fit(
    batch: list[bytes],
    toxic: np.ndarray,
    size: int = 8,
    epochs: int = 14,
    warm: int = 4,
    chunk: int = 96,
    rate: float = 2.0,
    least: int = 10,
    floor: float = 1e-6,
    seed: int = 7,
) -> Model:
    """Train embeddings and layer together, by Adagrad on the softmax loss.

    Both classes weigh the same. ``calibrate`` sets the threshold afterwards.
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, size))
    layer = rng.normal(0, 0.5, (size, 2))
    bias = np.zeros(2)
    table_speed, layer_speed = np.full(BUCKETS, floor), np.full(layer.shape, 1e-6)
    share = max(toxic.mean(), 1e-9)
    weight = np.where(toxic == 1, 0.5 / share, 0.5 / max(1 - share, 1e-9))
    batch = pa.array(batch, pa.binary())
    order = np.argsort(np.asarray(pc.binary_length(batch)), kind="stable")
    chunks = [order[i : i + chunk] for i in range(0, len(order), chunk)]
    prepared = []
    for own in chunks:
        split = words.split(batch.take(pa.array(own)).to_pylist(), words.SPACES)
        window, first = _windows(split)
        # One entry per distinct word: texts repeat most of theirs.
        _, seen, word = np.unique(split.hashes(), return_index=True, return_inverse=True)
        distinct = words.Words(split.buffer, split.starts[seen], split.ends[seen], split.first)
        pairs = _subwords(distinct)
        owner = np.concatenate([o for o, _ in pairs]).astype(np.int32)
        bucket = np.concatenate([b for _, b in pairs]).astype(np.int32)
        once = _once(split, window) > 0
        prepared.append(
            (own, owner, bucket, word.astype(np.int32), once, window.astype(np.int32), first)
        )
    # Subwords in few windows stay at zero: they could only be learnt by heart.
    seen_in = np.zeros(BUCKETS)
    for _, owner, bucket, word, once, window, first in prepared:
        per_word = np.bincount(word, once)
        seen_in += np.bincount(bucket, per_word[owner], minlength=BUCKETS)
    common = seen_in >= least
    table *= common[:, None]
    for epoch in range(epochs):
        for c in rng.permutation(len(chunks)):
            own, owner, bucket, word, once, window, first = prepared[c]
            if not len(word):
                continue
            difference = layer[:, 1] - layer[:, 0]
            used, compact = np.unique(bucket, return_inverse=True)
            number = np.bincount(owner)
            scores = (table[used] @ difference)[compact]
            per_word = np.bincount(owner, scores) / number
            z = _averages(per_word[word], once, window, first[-1]) + bias[1] - bias[0]
            text = np.repeat(np.arange(len(own)), np.diff(first))
            if epoch < warm:
                pull = 1.0 / np.diff(first)[text]
            else:
                best = np.lexsort((z, text))[np.cumsum(np.diff(first)) - 1]
                pull = np.zeros(len(z))
                pull[best] = 1.0
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            g = (p - toxic[own][text]) * pull * weight[own][text] / len(own)
            sizes = np.maximum(np.bincount(window, minlength=first[-1]), WINDOW)
            by_word = np.bincount(word, (g / sizes)[window] * once, minlength=len(number))
            by_bucket = np.bincount(compact, (by_word / number)[owner], minlength=len(used))
            down = by_bucket[:, None] * difference[None, :]
            up = table[used].T @ by_bucket
            table_speed[used] += (down * down).mean(axis=1)
            table[used] -= rate * down / np.sqrt(table_speed[used])[:, None] * common[used, None]
            both = np.column_stack([-up, up])
            layer_speed += both * both
            layer -= 0.1 * rate * both / np.sqrt(layer_speed)
            bias -= 0.05 * np.array([-g.sum(), g.sum()])
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def calibrate(model: Model, batch: list[bytes], toxic: np.ndarray) -> Model:
    """Move the bias to the threshold with the fewest errors on rows not used for the fit, and
    there to the middle of the widest gap."""
    batch = pa.array(batch, pa.binary())
    z = np.concatenate(
        [logits(batch[i : i + 100].to_pylist(), model) for i in range(0, len(batch), 100)]
    )
    clean, bad, levels = np.sort(z[toxic == 0]), np.sort(z[toxic == 1]), np.sort(z)
    middles = (levels[1:] + levels[:-1]) / 2
    wrong = np.searchsorted(bad, middles) + len(clean) - np.searchsorted(clean, middles)
    good = np.flatnonzero(wrong == wrong.min())
    widest = good[np.argmax(np.diff(levels)[good])]
    return Model(model.subwords, model.bias - float(middles[widest]))


def learn(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = 1800, clean_rows: int = 3000, held_out: int = 5
) -> Model:
    """Fit on at most so many labelled texts of each class, none of the held-out rows."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter(F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id"), held_out))
        .dropDuplicates(["doc_id"])
    )
    chosen = None
    for label, most in ((0, clean_rows), (1, toxic_rows)):
        part = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        part = part.limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic").toArrow()
    ).sort_by([("text", "ascending"), ("toxic", "ascending")])
    batch = rows["text"].combine_chunks().cast(pa.binary())
    toxic = np.asarray(rows["toxic"]).astype(float)
    if not len(toxic) or toxic.min() == toxic.max():
        odds = 40.0 if len(toxic) and toxic.max() == 1 else -40.0
        return Model(np.zeros(BUCKETS, np.float32), odds)
    # Every fifth row of each class sets the threshold, the others train.
    order = np.lexsort((np.arange(len(toxic)), toxic))
    checks = np.zeros(len(toxic), dtype=bool)
    checks[order[::5]] = True
    if len(toxic) < 50 or len(np.unique(toxic[checks])) < 2:
        checks[:] = True
        train = checks
    else:
        train = ~checks
    model = fit(batch.filter(pa.array(train)), toxic[train])
    return calibrate(model, batch.filter(pa.array(checks)), toxic[checks])


def is_held_out(key, held_out: int = 5):
    return F.crc32(key.cast("string").cast("binary")) % held_out == 0


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score in 0..1 for every row. The model is a table of fixed size, sent to each task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def convert(batches):
        own = shared.value
        for batch in batches:
            for part in bounded(batch):
                z = logits(part.column("text").cast(pa.binary()).to_pylist(), own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))],
                    names=["doc_id", "score"],
                )

    return texts(docs, key, text).mapInArrow(convert, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows whose text scores below ``limit``, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(rows: list[str]):
        z = logits([row.encode() for row in rows], shared.value)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    name = free_name(docs, "toxicity")
    scored = with_text_column(docs, text, name, "double", compute)
    return scored.filter(F.col(name) < limit).drop(name)
