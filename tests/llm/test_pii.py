from __future__ import annotations

import random
import re

import numpy as np
import pytest
import samples

from tillmark.llm import pii

_PIECES = ["a", "b.", "@", "1", "22", "9.9", "4111111111111111", " ", "-", "+1", "(", ")", ".",
           "300", "%", "é", "\n", "555", "1.2.3.4", "+49 30 1234567"]


def plain(text):
    found = [(0, *m.span()) for m in
             re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return found


def test_base_spans():
    draw = random.Random(3)
    for _ in range(8000):
        text = "".join(draw.choice(_PIECES) for _ in range(draw.randint(0, 25)))
        assert pii.base_spans(text) == plain(text)


def test_long_runs_are_fast():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" * 100_000):
        pii.base_spans(text)


def _documents(count, seed):
    draw = random.Random(seed)
    for text in samples.prose(seed, count, words=25):
        words = text.split(" ")
        datum = draw.choice([
            f"{draw.choice('abcdefg')}{draw.randint(1, 99)}.x@mail{draw.randint(1, 9)}.example.com",
            ".".join(str(draw.randint(0, 255)) for _ in range(4)),
            f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}",
        ])
        yield " ".join([*words[:5], datum, *words[5:]])


def _tagger():
    rng = np.random.default_rng(1)
    pairs = [p for t in _documents(300, 1) for p in pii._labelled(t, rng)]
    return pii.train(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), epochs=10)


@pytest.fixture(scope="module")
def tagger():
    return _tagger()


def test_base_spans_stay_and_more_are_found(tagger):
    held = list(_documents(80, 2))
    assert all(set(base) <= set(every) for base, every in pii.all_spans(held, tagger))
    changed = [re.sub(r"\+1 \(", "1 (", t) for t in held if "+1 (" in t]
    found = sum(any(k == 3 for k, _, _ in every) for _, every in pii.all_spans(changed, tagger))
    assert found > len(changed) / 2
    clean = samples.prose(5, 50)
    assert not any(every for _, every in pii.all_spans(clean, tagger))


SPELLED = ["{} (at) {}.{}", "{}(at){}.{}", "{} [at] {}.{}", "{} at {} dot {}"]


def _addresses(count, seed, forms):
    draw = random.Random(seed)
    names = ["anna", "peter", "maria", "schmidt", "jones", "olga", "weber", "lund", "kim", "rossi"]
    for i, text in enumerate(samples.prose(seed, count, words=40)):
        words = text.split(" ")
        local = f"{draw.choice(names)}.{draw.choice(names)}"
        datum = forms[i % len(forms)].format(local, draw.choice(["example", "mailbox", "post"]),
                                             draw.choice(["org", "net", "com"]))
        yield datum, " ".join([*words[:9], datum, *words[9:]])


def test_spelled_out_addresses_without_digits():
    rng = np.random.default_rng(1)
    known = [t for _, t in _addresses(400, 3, ["{}@{}.{}"])]
    pairs = [p for t in known for p in pii._labelled(t, rng)]
    model = pii.train(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), epochs=10)
    held = list(_addresses(80, 4, SPELLED))
    assert not any(set("0123456789@") & set(t) for _, t in held)
    assert all(pii._window_starts(t) for _, t in held)
    assert all(pii._plausible(0, datum) for datum, _ in held)
    found = [pii.masked(t, every) for (_, t), (_, every) in
             zip(held, pii.all_spans([t for _, t in held], model))]
    for form in range(len(SPELLED)):
        own = [datum not in out and "[EMAIL]" in out
               for (datum, _), out in list(zip(held, found))[form :: len(SPELLED)]]
        assert sum(own) > len(own) * 0.7, (SPELLED[form], sum(own), len(own))


def test_gradients():
    draw = np.random.default_rng(0)
    codes, tags = draw.integers(0, 130, (3, 12)), draw.integers(0, pii.TAGS, (3, 12))
    model = pii.train(codes, tags, epochs=0, size=4)
    w = model.weights

    def loss():
        scores = model.emissions(codes)
        ahead = scores[:, 0] + w["begin"]
        path = w["begin"][tags[:, 0]] + scores[np.arange(3), 0, tags[:, 0]]
        for t in range(1, 12):
            ahead = scores[:, t] + pii._logsum(ahead[:, :, None] + w["moves"], 1)
            path = path + scores[np.arange(3), t, tags[:, t]] + w["moves"][tags[:, t - 1], tags[:, t]]
        return (pii._logsum(ahead, 1) - path).mean()

    scores, (_, x, saved, hidden) = model.emissions(codes, keep=True)
    d_scores, d_moves, d_begin = pii._crf(scores, tags, w["moves"], w["begin"])
    d_hidden = d_scores @ w["out"].T
    _, d_in, d_re, d_bi = pii._lstm_back(d_hidden[:, :, :4], x, w["inf"], w["ref"], saved[0])
    for name, at, gradient in [("moves", (1, 2), d_moves), ("begin", (3,), d_begin),
                               ("inf", (2, 5), d_in), ("ref", (1, 7), d_re), ("bif", (6,), d_bi)]:
        w[name][at] += 1e-5
        up = loss()
        w[name][at] -= 2e-5
        down = loss()
        w[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - gradient[at]) < 1e-6


def test_viterbi_is_the_best_path(tagger):
    codes = np.random.default_rng(2).integers(1, 129, (2, 4))
    scores, moves = tagger.emissions(codes), tagger.weights["moves"]
    tags, _ = tagger.viterbi(codes)

    def total(row, path):
        own = scores[row][np.arange(4), list(path)].sum() + tagger.weights["begin"][path[0]]
        return own + sum(moves[a, b] for a, b in zip(path, path[1:]))

    paths = list(np.ndindex(*[pii.TAGS] * 4))
    for row in range(2):
        assert tuple(tags[row]) == max(paths, key=lambda p: total(row, p))


def test_reconcile():
    spans = [(0, 5, 0, 1.0), (0, 5, 0, 1.0), (3, 9, 1, 1.5), (9, 12, 2, 0.5), (20, 22, 3, -1.0)]
    assert pii.reconcile(spans) == [(0, 5, 0), (9, 12, 2)]
    assert pii.reconcile([]) == []


def test_frames(spark, tagger):
    mail = "x@y.example"
    rows = [(1, f"write {mail} or 1.2.3.4"), (2, None), (3, ""), (1, f"write {mail} or 1.2.3.4"),
            (None, "é" * 300 + f" {mail} {mail}"), (5, f"{mail}" + " w" * 50_000 + f" {mail}")]
    got = pii.find(samples.documents(spark, rows), tagger).collect()
    for (doc, text), r in zip(rows, got):
        base = plain(text or "")
        assert r["doc_id"] == doc
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(k == kind for k, _, _ in base) for kind in range(4)
        ]
        assert r["base"] == pii._written(base)
        assert set(filter(None, r["base"].split(","))) <= set(r["spans"].split(","))
        assert mail not in r["masked"]
    frame = samples.documents(spark, rows).withColumnRenamed("id", "n_chars")
    kept = pii.mask(frame, tagger)
    assert kept.columns == frame.columns
    texts = [r["text"] for r in kept.collect()]
    assert texts[0] == "write [EMAIL] or [IP]" and texts[1] is None
    assert pii.find(samples.empty(spark), tagger).count() == 0


def test_learning_needs_spans(spark):
    assert pii.learn(samples.empty(spark)) is None
    assert pii.learn(samples.documents(spark, [(1, "no data 12 here")])) is None
    assert pii.all_spans([f"mail a@b.example"], None)[0][1] == [(0, 5, 16)]


def test_sample_has_distinct_texts_and_late_windows(spark):
    rows = [(i, f"mail a{i % 12}@b.example") for i in range(12)] * 40
    drawn = pii._sample(samples.documents(spark, rows), 10)
    assert len(drawn) == len(set(drawn)) == 10
    late = "number 12 " * 600 + "mail anna@post.example"
    drawn = [pair for seed in range(60) for pair in pii._labelled(late, np.random.default_rng(seed))]
    assert len(drawn) == 60 * 24 and any(tags.any() for _, tags in drawn)


@pytest.mark.parametrize("length", [20, 48, 60, 95, 96, 150, 400])
def test_spans_cut_by_windows_are_joined(length):
    """A datum at every offset, tagged rightly in every window, is found once and whole."""
    kind = 2
    for begin in (*range(0, 100), 250):
        end, size = begin + length, begin + length + 37
        tags = np.zeros(size + 2 * pii.SPAN, dtype=np.int64)
        tags[pii.SPAN + begin : pii.SPAN + end] = 2 + 2 * kind
        tags[pii.SPAN + begin] = 1 + 2 * kind
        pieces = []
        for cell in range(begin // pii.STRIDE - 1, end // pii.STRIDE + 1):
            start = cell * pii.STRIDE
            own = tags[pii.SPAN + start : 2 * pii.SPAN + start]
            pieces += pii._window_spans(own, np.ones(pii.SPAN), start, size)
        found = pii.reconcile(pii.whole_spans(pieces))
        assert found == [(begin, end, kind)], (begin, length, found)


def test_unfinished_pieces_are_no_spans():
    ends = [(0, 48, 1, 1.0, True, False), (60, 96, 1, 1.0, False, True), (60, 96, 0, 1.0, True, False)]
    assert pii.whole_spans(ends) == []


def test_single_precision_scores(tagger):
    codes = np.random.default_rng(3).integers(0, pii.LETTERS, (7, pii.SPAN))
    assert np.allclose(tagger.scores(codes).transpose(1, 0, 2), tagger.emissions(codes), atol=1e-3)
