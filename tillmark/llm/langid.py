"""Language identification in two levels: the family first, then the languages within it.

Both levels are one-versus-one linear support vector machines over character n-grams: one for every
two families, and one for every two languages of a family, trained on nothing but these, so that
close languages are told apart by what differs between them. The most votes win, then the largest
sum of margins, then the smaller name.

A text is taken in lower case with everything but letters as spaces; its n-grams (of UTF-8 bytes,
two to four, word ends included) are hashed into tables. A feature is the share of an n-gram among
those of its length, so a decision is a mean of table entries plus a bias, and scoring whole texts
of any length needs sums only.

The machines are fitted on a bounded sample of labelled rows: for every language the ``rows``
distinct texts of smallest hash, and ``windows`` pieces of each, drawn at random from the whole
text, most of up to ``size`` characters and one much shorter. Labels are a small set of names.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so are all texts when
no labelled row has a letter. With one language, or one in its family, that level has nothing to
decide and is certain. Rows with a null id are never held out; repeated rows weigh once in the
sample; other columns do not matter.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.frames import bounded, texts

UNKNOWN = "und"

# Families of the ISO 639-1 codes of widely written languages. A language that is
# not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# Length of the n-grams and bits of their table.
GRAMS = ((2, 12), (3, 14), (4, 15))
SIZE = sum(1 << bits for _, bits in GRAMS)
_SPREAD = np.uint32(0x9E3779B1)
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def family(language: str) -> str:
    code = language.replace("_", "-").split("-")[0].strip().lower()
    return _FAMILY.get(code, code)


@dataclass
class Model:
    """Languages, and for every pair of one level its table and bias; positive is for the first."""

    languages: list[str]
    pairs: list[tuple[str, str]]
    tables: np.ndarray
    biases: np.ndarray


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _grams(batch: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram length: table entries of all places, which places count, and the first and
    last place of each text, one after the other.

    A space stands before and after each text; n-grams with two spaces in a row do not count.
    """
    coded = [text.lower().encode() for text in batch]
    joined = b" " + b"\n".join(coded) + b"    "
    letters = np.frombuffer(joined.translate(_LETTERS), dtype=np.uint8)
    lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    space = letters == 32
    double = space[:-1] & space[1:]
    code = letters.astype(np.uint32)
    empty = np.zeros(len(letters) - 1, dtype=bool)
    offset = 0
    for n, bits in GRAMS:
        # The code of an n-gram is that of its first n - 1 letters and one letter more.
        while n > len(letters) - len(code) + 1:
            step = len(letters) - len(code) + 1
            code = code[:-1] << np.uint32(8) | letters[step:]
            empty = empty[: len(code)] | double[step - 1 : step - 1 + len(code)]
        entry = ((code * _SPREAD) >> np.uint32(32 - bits)).astype(np.int64) + offset
        # From the space before a text to the last n-gram that ends in the space behind it.
        last = np.maximum(ends + 2 - n, starts)
        yield entry, ~empty, np.stack([starts, last], axis=1).ravel()
        offset += 1 << bits


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums between each first and last place; those of one text never depend on another."""
    found = np.add.reduceat(np.append(values, 0), bounds)[::2]
    found[bounds[::2] == bounds[1::2]] = 0
    return found


def margins(batch: list[str], model: Model) -> np.ndarray:
    """(texts, pairs): the margin of each machine."""
    total = np.repeat(model.biases[None, :].astype(np.float64), len(batch), axis=0)
    for entry, counts, bounds in _grams(batch):
        number = np.maximum(_sums(counts.astype(np.float64), bounds), 1)
        for pair in range(len(model.pairs)):
            values = model.tables[pair][entry] * counts
            total[:, pair] += _sums(values.astype(np.float64), bounds) / number
    return total


def _winner(names: list[str], pairs: dict[tuple[str, str], np.ndarray]):
    """Index of the winner of each row among sorted names, and how sure its weakest duel is."""
    rows = len(next(iter(pairs.values())))
    votes, sums = np.zeros((rows, len(names))), np.zeros((rows, len(names)))
    weakest = np.full((rows, len(names)), np.inf)
    for (a, b), margin in pairs.items():
        for name, own in ((a, margin), (b, -margin)):
            at = names.index(name)
            votes[:, at] += (own > 0) + 0.5 * (own == 0)
            sums[:, at] += own
            weakest[:, at] = np.minimum(weakest[:, at], own)
    best = np.lexsort((np.tile(np.arange(len(names)), (rows, 1)), -sums, -votes), axis=1)[:, 0]
    return best, 1 / (1 + np.exp(-2 * np.clip(weakest[np.arange(rows), best], -20, 20)))


def predict_batch(batch: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    languages, scores = np.full(len(batch), UNKNOWN, dtype=object), np.zeros(len(batch))
    rows = np.flatnonzero([has_letter(text) for text in batch])
    if not len(rows) or not model.languages:
        return languages.tolist(), scores
    margin = margins([batch[i] for i in rows], model)
    groups: dict[str, list[str]] = {}
    for language in model.languages:
        groups.setdefault(family(language), []).append(language)
    names = sorted(groups)

    every = dict(zip(model.pairs, margin.T))
    chosen, sure = np.zeros(len(rows), np.int64), np.ones(len(rows))
    if len(names) > 1:
        marked = {_mark(name): name for name in names}
        chosen, sure = _winner(
            names, {(marked[a], marked[b]): m for (a, b), m in every.items() if a in marked}
        )
    for at, name in enumerate(names):
        of = np.flatnonzero(chosen == at)
        members = sorted(groups[name])
        if len(members) == 1:
            languages[rows[of]] = members[0]
        elif len(of):
            own, certain = _winner(
                members, {(a, b): m[of] for (a, b), m in every.items() if a in members}
            )
            languages[rows[of]] = np.array(members, dtype=object)[own]
            sure[of] *= certain
    scores[rows] = sure
    return languages.tolist(), scores


def _mark(name: str) -> str:
    """Families among the pairs, told from languages of the same name."""
    return f"\x00{name}"


def train_pair(
    rows: list[tuple[np.ndarray, np.ndarray]],
    signs: np.ndarray,
    cost: float = 10.0,
    epochs: int = 12,
    seed: int = 5,
) -> tuple[np.ndarray, float]:
    """A linear support vector machine (hinge loss) by dual coordinate descent.

    ``rows`` are (entries, values) of sparse features; classes weigh alike whatever their numbers.
    """
    draw = np.random.default_rng(seed)
    scale = 1 / max(np.mean([np.sqrt((v * v).sum()) for _, v in rows]), 1e-9)
    positive = max((signs > 0).sum(), 1)
    limits = np.where(signs > 0, 0.5 / positive, 0.5 / max(len(signs) - positive, 1))
    limits = cost * limits * len(signs)
    weights, bias = np.zeros(SIZE), 0.0
    duals = np.zeros(len(rows))
    norms = np.array([(v * v).sum() * scale * scale + 1 for _, v in rows])
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            entries, values = rows[i]
            margin = signs[i] * (scale * (weights[entries] @ values) + bias)
            dual = min(max(duals[i] - (margin - 1) / norms[i], 0.0), limits[i])
            step = (dual - duals[i]) * signs[i]
            if step:
                weights[entries] += step * scale * values
                bias += step
                duals[i] = dual
    return (weights * scale).astype(np.float32), bias


def features(batch: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse features of short texts: entries and shares."""
    found = [([], []) for _ in batch]
    for entry, counts, bounds in _grams(batch):
        for row, (start, end) in enumerate(bounds.reshape(-1, 2)):
            entries, number = np.unique(entry[start:end][counts[start:end]], return_counts=True)
            found[row][0].append(entries)
            found[row][1].append(number / max(number.sum(), 1))
    return [(np.concatenate(e), np.concatenate(v)) for e, v in found]


def fit(batch: list[str], labels: list[str]) -> Model:
    """Machines for all pairs of families, and of languages within a family."""
    kept = [i for i, text in enumerate(batch) if has_letter(text)]
    rows, labels = features([batch[i] for i in kept]), [labels[i] for i in kept]
    languages = sorted(set(labels))
    marks = [_mark(family(label)) for label in labels]
    pairs = list(combinations(sorted(set(marks)), 2))
    pairs += [p for p in combinations(languages, 2) if family(p[0]) == family(p[1])]
    tables, biases = np.zeros((len(pairs), SIZE), np.float32), np.zeros(len(pairs))
    for at, (first, second) in enumerate(pairs):
        own = marks if first.startswith("\x00") else labels
        chosen = [i for i, name in enumerate(own) if name in (first, second)]
        signs = np.array([1.0 if own[i] == first else -1.0 for i in chosen])
        tables[at], biases[at] = train_pair([rows[i] for i in chosen], signs)
    return Model(languages, pairs, tables, biases)


def pieces(text: str, windows: int, size: int) -> list[str]:
    """Pieces drawn from the whole text by its own checksum; every text starts with a short one."""
    draw = random.Random(zlib.crc32(text.encode()))
    found = []
    for number in range(windows):
        length = draw.randint(12, 80) if number == 0 else draw.randint(80, max(size, 80))
        start = draw.randrange(max(len(text) - length, 0) + 1)
        found.append(text[start : start + length])
    return found


def is_held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def learn(
    docs: DataFrame,
    rows: int = 500,
    windows: int = 4,
    size: int = 600,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
) -> Model:
    """Fit on at most so many texts of each language, none of the held-out rows, and on so many
    pieces of each text. Only the pieces reach the driver."""
    known = docs.select(
        F.col(label).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
        is_held_out(F.col(key)).alias("held_out"),
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.col("held_out"))
    known = known.select("lang", "text", F.xxhash64("text").alias("hash"))
    chosen = known.select("lang", "hash").distinct().withColumn("part", F.shiftright("hash", 56))
    # First in 256 parts of each language, so that one with most rows is not ranked in one task.
    for group in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*group).orderBy("hash")
        chosen = chosen.withColumn("number", F.row_number().over(first))
        chosen = chosen.filter(F.col("number") <= rows).drop("number")

    def cut(batches):
        for batch in batches:
            for part in bounded(batch):
                found = {
                    (lang, piece)
                    for lang, content in zip(*(c.to_pylist() for c in part.columns))
                    for piece in pieces(content, windows, size)
                }
                columns = list(zip(*found)) or [(), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in columns], names=["lang", "piece"]
                )

    sample = (
        known.join(F.broadcast(chosen), ["lang", "hash"], "left_semi")
        .select("lang", "text")
        .mapInArrow(cut, "lang string, piece string")
        .distinct()
        .toArrow()
        .sort_by([("lang", "ascending"), ("piece", "ascending")])
    )
    return fit(sample["piece"].to_pylist(), sample["lang"].to_pylist())


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row; the model is of fixed size for its languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def convert(batches):
        for batch in batches:
            for part in bounded(batch):
                languages, scores = predict_batch(part.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return texts(docs, key, text).mapInArrow(
        convert, "doc_id long, lang_pred string, score double"
    )
