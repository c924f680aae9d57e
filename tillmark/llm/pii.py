"""Personal data: fixed rules, and a character tagger that adds what the rules miss.

The tagger is a bidirectional LSTM over characters with CRF transitions, written and trained in
numpy on labelled spans: windows of a bounded sample of documents, labelled by the rules, some of
them rewritten into forms the rules do not know (other separators, no leading plus, spelled-out
signs), whose spans are known because the rewriting is. It reads overlapping windows around every
digit, at sign and spelled-out sign ("at" or "dot" as a word or in brackets), as none of the kinds
does without one. Each window is decoded by itself; pieces of a span that window edges cut are
joined across windows, so spans may be of any length. The spans of all windows of a text are then
reconciled by choosing the set of disjoint spans of the largest total score, where a span found by
two windows has the sum of both. Base spans always stay; a tagged span is added only if it overlaps
none of them and has enough digits or the signs of an address.

Edge cases: texts of any length are read whole, columns of any name may stand beside them; null and empty texts have no spans; positions are code points; repeated rows, other
columns and empty tables do not matter; without any base span in the sample the tagger adds
nothing. The rules run in linear time on long runs of digits or letters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.frames import bounded, free_name, texts, with_text_column

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
SPAN = 96
STRIDE = 48

# Base rules --------------------------------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match from inside a run of digits would also be one from its start, so only starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = r"(?<![A-Za-z0-9])at(?![A-Za-z0-9])"
_DOT = r"(?<![A-Za-z0-9])dot(?![A-Za-z0-9])"
_SEED = re.compile(f"[0-9@]|{_AT}|{_DOT}", re.IGNORECASE | re.ASCII)
_ADDRESS = re.compile(
    rf"[A-Za-z0-9].*(@|{_AT}).*[A-Za-z0-9][\W_]*(\.|{_DOT})[\W_]*[A-Za-z0-9]", re.IGNORECASE
)


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at - len(_LOCAL.match(text[done:at][::-1])[0])
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    found = [(0, start, end) for start, end in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() <= 64 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


# The tagger --------------------------------------------------------------------------------------

LETTERS = 130


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.where(points < 128, points + 1, 129).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    weights: dict[str, np.ndarray]

    def emissions(self, codes: np.ndarray, keep: bool = False):
        """Scores (batch, time, tag); with ``keep`` also what the backward pass needs."""
        w = self.weights
        x = w["letters"][codes]
        sides, saved = [], []
        for side in ("f", "b"):
            own = x if side == "f" else x[:, ::-1]
            h, notes = _lstm(own, w["in" + side], w["re" + side], w["bi" + side])
            sides.append(h if side == "f" else h[:, ::-1])
            saved.append(notes)
        hidden = np.concatenate(sides, axis=2)
        scores = hidden @ w["out"] + w["bo"]
        return (scores, (codes, x, saved, hidden)) if keep else scores

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """The scores of ``emissions`` by time (time, batch, tag), in single precision.

        Letters go straight to their gate inputs by one table, both directions run in one loop, and
        all gates take one tanh: a logistic gate of x is half of 1 + tanh(x / 2).
        """
        w, size = self.weights, self.weights["ref"].shape[0]
        half = np.repeat([0.5, 1.0], [3 * size, size])
        tables = [
            ((w["letters"] @ w["in" + side] + w["bi" + side]) * half).astype(np.float32)
            for side in "fb"
        ]
        again = np.stack([w["re" + side] * half for side in "fb"]).astype(np.float32)
        ahead = np.ascontiguousarray(codes.T)
        length, batch = ahead.shape
        h, c = np.zeros((2, batch, size), np.float32), np.zeros((2, batch, size), np.float32)
        hidden = np.empty((2, length, batch, size), np.float32)
        for t in range(length):
            z = np.matmul(h, again)
            z[0] += tables[0][ahead[t]]
            z[1] += tables[1][ahead[length - 1 - t]]
            np.tanh(z, out=z)
            gates = z[:, :, : 3 * size]
            gates *= 0.5
            gates += 0.5
            c *= gates[:, :, size : 2 * size]
            c += gates[:, :, :size] * z[:, :, 3 * size :]
            h = np.tanh(c)
            h *= gates[:, :, 2 * size :]
            hidden[0, t], hidden[1, length - 1 - t] = h
        out = w["out"].astype(np.float32)
        return hidden[0] @ out[:size] + hidden[1] @ out[size:] + w["bo"].astype(np.float32)

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window, and at each place how far they are ahead of 'outside'."""
        scores = self.scores(codes)
        into = np.ascontiguousarray(self.weights["moves"].T.astype(np.float32))
        length, batch, _ = scores.shape
        best = scores[0] + self.weights["begin"].astype(np.float32)
        back = np.zeros((length, batch, TAGS), dtype=np.int8)
        for t in range(1, length):
            step = best[:, None, :] + into
            back[t] = step.argmax(axis=2)
            best = step.max(axis=2) + scores[t]
        tags = np.zeros((length, batch), dtype=np.int64)
        tags[-1] = best.argmax(axis=1)
        every = np.arange(batch)
        for t in range(length - 1, 0, -1):
            tags[t - 1] = back[t, every, tags[t]]
        ahead = np.take_along_axis(scores, tags[:, :, None], 2)[:, :, 0] - scores[:, :, 0]
        return tags.T, ahead.T


def _lstm(x, w_in, w_re, bias):
    batch, length, _ = x.shape
    size = w_re.shape[0]
    drive = x @ w_in + bias
    h, c = np.zeros((batch, size)), np.zeros((batch, size))
    out, notes = np.zeros((batch, length, size)), []
    for t in range(length):
        z = drive[:, t] + h @ w_re
        i, f, o = (_sigmoid(z[:, k * size : (k + 1) * size]) for k in range(3))
        g = np.tanh(z[:, 3 * size :])
        before, previous = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        out[:, t] = h
        notes.append((i, f, o, g, before, squashed, previous))
    return out, notes


def _lstm_back(d_out, x, w_in, w_re, notes):
    batch, length, size = d_out.shape
    d_h, d_c = np.zeros((batch, size)), np.zeros((batch, size))
    d_drive = np.zeros((batch, length, 4 * size))
    d_re = np.zeros_like(w_re)
    for t in range(length - 1, -1, -1):
        i, f, o, g, before, squashed, previous = notes[t]
        d_h = d_h + d_out[:, t]
        d_c = d_c + d_h * o * (1 - squashed**2)
        z = d_drive[:, t]
        z[:, :size] = d_c * g * i * (1 - i)
        z[:, size : 2 * size] = d_c * before * f * (1 - f)
        z[:, 2 * size : 3 * size] = d_h * squashed * o * (1 - o)
        z[:, 3 * size :] = d_c * i * (1 - g**2)
        d_re += previous.T @ z
        d_h = z @ w_re.T
        d_c = d_c * f
    flat = d_drive.reshape(-1, 4 * size)
    return d_drive @ w_in.T, x.reshape(-1, x.shape[2]).T @ flat, d_re, flat.sum(axis=0)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf(scores, tags, moves, begin):
    """The gradients of the negative log likelihood of the tags: scores, moves, begin."""
    batch, length, n = scores.shape
    rows = np.arange(batch)
    forward = np.zeros_like(scores)
    forward[:, 0] = scores[:, 0] + begin
    for t in range(1, length):
        forward[:, t] = scores[:, t] + _logsum(forward[:, t - 1, :, None] + moves, 1)
    backward = np.zeros_like(scores)
    d_moves = np.zeros_like(moves)
    norm = _logsum(forward[:, -1], 1)
    for t in range(length - 2, -1, -1):
        ahead = moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        backward[:, t] = _logsum(ahead, 2)
        d_moves += np.exp(forward[:, t, :, None] + ahead - norm[:, None, None]).sum(axis=0)
    d_scores = np.exp(forward + backward - norm[:, None, None])
    np.add.at(d_moves, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    d_begin = d_scores[:, 0].sum(axis=0)
    np.add.at(d_begin, tags[:, 0], -1)
    d_scores[rows[:, None], np.arange(length)[None], tags] -= 1
    return d_scores / batch, d_moves / batch, d_begin / batch


def train(
    codes: np.ndarray, tags: np.ndarray, size: int = 20, epochs: int = 7, batch: int = 64,
    rate: float = 0.01, seed: int = 11,
) -> Tagger:
    """Fit on windows (rows of codes and tags) with Adam."""
    rng = np.random.default_rng(seed)
    letter = 12
    w = {"letters": rng.normal(0, 0.3, (LETTERS, letter)), "moves": np.zeros((TAGS, TAGS)),
         "begin": np.zeros(TAGS), "out": rng.normal(0, 0.2, (2 * size, TAGS)), "bo": np.zeros(TAGS)}
    for side in "fb":
        w["in" + side] = rng.normal(0, 0.3, (letter, 4 * size))
        w["re" + side] = rng.normal(0, 0.2, (size, 4 * size))
        w["bi" + side] = np.concatenate([np.zeros(size), np.ones(size), np.zeros(2 * size)])
    model = Tagger(w)
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            scores, (c, x, saved, hidden) = model.emissions(codes[own], keep=True)
            d_scores, d_moves, d_begin = _crf(scores, tags[own], w["moves"], w["begin"])
            grad = {"moves": d_moves, "begin": d_begin}
            flat = d_scores.reshape(-1, TAGS)
            grad["out"] = hidden.reshape(-1, hidden.shape[2]).T @ flat
            grad["bo"] = flat.sum(axis=0)
            d_hidden = d_scores @ w["out"].T
            d_x = np.zeros_like(x)
            for side, notes in zip("fb", saved):
                part = d_hidden[:, :, :size] if side == "f" else d_hidden[:, ::-1, size:]
                seen = x if side == "f" else x[:, ::-1]
                d_in, *rest = _lstm_back(part, seen, w["in" + side], w["re" + side], notes)
                grad["in" + side], grad["re" + side], grad["bi" + side] = rest
                d_x += d_in if side == "f" else d_in[:, ::-1]
            grad["letters"] = np.zeros_like(w["letters"])
            np.add.at(grad["letters"], c.ravel(), d_x.reshape(-1, letter))
            steps += 1
            for k, g in grad.items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w[k] -= rate * (mean[k] / (1 - 0.9**steps)) / (
                    np.sqrt(square[k] / (1 - 0.999**steps)) + 1e-8
                )
    return model


# Labelled windows --------------------------------------------------------------------------------


# How the at sign and the dots of an address are written otherwise.
_SPELLED = [
    ("@ ", "."),
    ("(at)", "."),
    (" [at] ", "."),
    (" (at) ", "."),
    (" at ", "."),
    (" at ", " dot "),
    ("(at)", "(dot)"),
    (" [at] ", " [dot] "),
]


def _rewritten(kind: int, text: str, rng: np.random.Generator) -> str:
    """A form of the same datum that the rules do not match."""
    choice = int(rng.integers(0, 3))
    if kind == 0:
        sign, dot = _SPELLED[int(rng.integers(0, len(_SPELLED)))]
        local, _, domain = text.partition("@")
        # The dots before the sign are spelled out in some, too.
        return (local.replace(".", dot) if choice == 0 else local) + sign + domain.replace(".", dot)
    if kind == 1:
        return text.replace(".", (" . ", "[.]", ",")[choice])
    if kind == 2:
        digits = _digits(text)
        return (".", "/", "_")[choice].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    plain = text.lstrip("+")
    return (plain, "00" + plain, plain.replace(" ", "/"))[choice]


def _labelled(text: str, rng: np.random.Generator, most: int = 24):
    """Windows around the base spans of a text, in one copy with some data rewritten: ``most`` of
    them, drawn at random from the whole text."""
    spans = sorted((s, e, k) for k, s, e in base_spans(text))
    parts, tagged, at = [], [], 0
    for start, end, kind in spans:
        if start < at:
            continue
        datum = text[start:end]
        if rng.random() < 0.4:
            datum = _rewritten(kind, datum, rng)
        parts += [text[at:start], datum]
        begin = sum(map(len, parts)) - len(datum)
        tagged.append((begin, begin + len(datum), kind))
        at = end
    parts.append(text[at:])
    whole = "".join(parts)
    codes = _codes(whole)
    tags = np.zeros(len(codes), dtype=np.int64)
    for start, end, kind in tagged:
        tags[start:end] = 2 + 2 * kind
        tags[start] = 1 + 2 * kind
    for start in rng.permutation(_window_starts(whole))[:most].astype(int).tolist():
        yield _padded(codes, start), _padded(tags, start)


def _window_starts(text: str) -> list[int]:
    """Windows of SPAN characters, one each STRIDE, that have a digit or a sign of an address near."""
    wanted = set()
    for m in _SEED.finditer(text):
        cell = m.start() // STRIDE
        wanted.update((cell - 1, cell))
    return sorted(c * STRIDE for c in wanted)


def _padded(values: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(SPAN, dtype=np.int64)
    low, high = max(start, 0), min(start + SPAN, len(values))
    if high > low:
        out[low - start : high - start] = values[low:high]
    return out


def _sample(docs: DataFrame, sample: int) -> list[str]:
    """At most ``sample`` distinct texts with base kinds' characters, those of smallest hash. Hashes
    are made distinct first, so that only the texts of the sample are shuffled."""
    rows = texts(docs).filter(F.col("text").rlike("[0-9]{2}|@"))
    hashed = rows.select("text", F.xxhash64("text").alias("hash"))
    least = hashed.select("hash").distinct().orderBy("hash").limit(sample).collect()
    drawn = hashed.filter(F.col("hash").isin([r["hash"] for r in least])).distinct()
    return [r["text"] for r in drawn.orderBy("hash", "text").limit(sample).collect()]


def learn(
    docs: DataFrame, sample: int = 800, windows: int = 2000, per_text: int = 24
) -> Tagger | None:
    """Fit on the windows of at most ``sample`` distinct texts with base kinds' characters, those of
    smallest hash: at most ``per_text`` windows of each, drawn at random, and ``windows`` in all."""
    rng = np.random.default_rng(5)
    found = [pair for text in _sample(docs, sample) for pair in _labelled(text, rng, per_text)]
    if not any(tags.any() for _, tags in found):
        return None
    chosen = rng.permutation(len(found))[:windows]
    return train(np.array([found[i][0] for i in chosen]), np.array([found[i][1] for i in chosen]))


# Decoding and reconciling ----------------------------------------------------------------------------


def _window_spans(tags: np.ndarray, ahead: np.ndarray, start: int, length: int):
    """(start, end, kind, score, cut before, cut behind) of what one decoded window holds; the ends
    of the text cut nothing."""
    t = 0
    while t < SPAN:
        if tags[t] == 0:
            t += 1
            continue
        kind, begin = (tags[t] - 1) // 2, t
        t += 1
        while t < SPAN and tags[t] == 2 + 2 * kind:
            t += 1
        low, high = start + begin, start + t
        before, behind = begin == 0 and low > 0, t == SPAN and high < length
        low, high = max(low, 0), min(high, length)
        if high > low:
            yield low, high, int(kind), float(ahead[begin:t].mean()), before, behind


def whole_spans(pieces) -> list[tuple[int, int, int, float]]:
    """Spans (start, end, kind, score) from pieces of windows.

    A piece that no edge cuts is a span. Pieces cut by an edge are joined with those of their kind
    that touch or overlap them, over as many windows as it takes; what then begins and ends inside
    windows is a span, with the mean score of its pieces.
    """
    spans = [piece[:4] for piece in pieces if not (piece[4] or piece[5])]
    cut = sorted((p for p in pieces if p[4] or p[5]), key=lambda p: (p[2], p[0], p[1]))
    at = 0
    while at < len(cut):
        low, high, kind, *_ = cut[at]
        group = [cut[at]]
        while at + len(group) < len(cut):
            following = cut[at + len(group)]
            if following[2] != kind or following[0] > high:
                break
            high = max(high, following[1])
            group.append(following)
        at += len(group)
        first = min(group, key=lambda p: (p[0], p[4]))
        last = max(group, key=lambda p: (p[1], not p[5]))
        if not first[4] and not last[5]:
            spans.append((low, high, kind, sum(p[3] for p in group) / len(group)))
    return spans


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """The disjoint spans of largest total score; equal spans add up."""
    total: dict[tuple[int, int, int], float] = {}
    for low, high, kind, score in spans:
        total[low, high, kind] = total.get((low, high, kind), 0.0) + score
    ordered = sorted((s for s in total if total[s] > 0), key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in ordered]
    best, take = [0.0], []
    for i, s in enumerate(ordered):
        before = int(np.searchsorted(ends[:i], s[0], side="right"))
        with_it = best[before] + total[s]
        take.append((with_it > best[i], before))
        best.append(max(best[i], with_it))
    chosen, i = [], len(ordered)
    while i:
        taken, before = take[i - 1]
        if taken:
            chosen.append(ordered[i - 1])
            i = before
        else:
            i -= 1
    return chosen[::-1]


def _plausible(kind: int, text: str) -> bool:
    if kind == 0:
        return bool(_ADDRESS.search(text))
    least, most = ((4, 12), (13, 19), (9, 15))[kind - 1]
    return least <= len(_digits(text)) <= most and (kind != 1 or len(re.findall(r"\d+", text)) == 4)


def all_spans(batch: list[str], model: Tagger | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, as (kind, start, end) by kind, then start."""
    base = [base_spans(t) if _SEED.search(t) else [] for t in batch]
    added: list[list] = [[] for _ in batch]
    if model:
        where, rows = [], []
        for i, text in enumerate(batch):
            starts = _window_starts(text)
            codes = _codes(text) if starts else None
            for start in starts:
                where.append((i, start))
                rows.append(_padded(codes, start))
        for at in range(0, len(rows), 512):
            tags, ahead = model.viterbi(np.array(rows[at : at + 512]))
            for j, (i, start) in enumerate(where[at : at + 512]):
                if tags[j].any():
                    added[i] += _window_spans(tags[j], ahead[j], start, len(batch[i]))
    out = []
    for text, own, more in zip(batch, base, added):
        taken = sorted((s, e) for _, s, e in own)
        extra = []
        for low, high, kind in reconcile(whole_spans(more)) if more else ():
            while low < high and text[low].isspace():
                low += 1
            while low < high and text[high - 1].isspace():
                high -= 1
            free = all(high <= s or low >= e for s, e in taken)
            if free and low < high and _plausible(kind, text[low:high]):
                extra.append((kind, low, high))
        out.append((own, sorted(own + extra)))
    return out


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(
    docs: DataFrame, model: Tagger | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base and spans, both written as
    kind:start:end, and the text with every span replaced by its kind in brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def convert(batches):
        own = shared.value
        for batch in batches:
            for part in bounded(batch):
                rows = part.column("text").to_pylist()
                found = all_spans(rows, own)
                counts = np.zeros((len(rows), len(KINDS)), dtype=np.int64)
                for i, (base, _) in enumerate(found):
                    for kind, _, _ in base:
                        counts[i, kind] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *[pa.array(counts[:, k]) for k in range(len(KINDS))],
                        pa.array([_written(base) for base, _ in found], pa.string()),
                        pa.array([_written(every) for _, every in found], pa.string()),
                        pa.array([masked(t, f[1]) for t, f in zip(rows, found)], pa.string()),
                    ],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans", "masked"],
                )

    counted = ", ".join(f"n_{k} long" for k in KINDS)
    return texts(docs, key, text).mapInArrow(
        convert, f"doc_id long, {counted}, base string, spans string, masked string"
    )


def mask(
    docs: DataFrame, model: Tagger | None, text: str = "text", length: str | None = "n_chars"
) -> DataFrame:
    """The rows with every span of their text replaced; ``length`` is counted anew if there."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = free_name(docs, "masked")

    def compute(rows: list[str]):
        return pa.array([masked(t, s) for t, (_, s) in zip(rows, all_spans(rows, shared.value))])

    out = with_text_column(docs, text, name, "string", compute)
    changed = {text: F.when(F.col(text).isNotNull(), F.col(name))}
    if length in docs.columns:
        changed[length] = F.length(F.col(name)).cast(docs.schema[length].dataType)
    return out.withColumns(changed).select(*docs.columns)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with its spans replaced, the earlier and longer one where two overlap."""
    parts, at = [], 0
    for start, end, kind in sorted(((s, e, k) for k, s, e in spans), key=lambda x: (x[0], -x[1])):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])
