from __future__ import annotations

import hashlib
import re

import samples

from tillmark.llm import decontam

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return _WORD.findall((text or "").translate(_LOWER))


def plain(docs, items):
    found = {}
    for i, text in docs:
        own, hit, named = words(text), set(), set()
        for item, asked in items:
            wanted = words(asked)
            length = min(13, len(wanted))
            for w in range(len(wanted) - length + 1) if length else ():
                for at in range(len(own) - length + 1):
                    if own[at : at + length] == wanted[w : w + length]:
                        hit.update(range(at, at + length))
                        named.add(str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        found[i] = (len(own), len(hit), len(named), digest, 0 < len(hit) and 20 * len(hit) >= len(own))
    return found


def tables():
    items = list(enumerate(samples.prose(21, 25, words=20)))
    items += [(100, "Only four words here"), (101, "one"), (102, None), (103, ""), (104, "!!!"),
              (105, items[3][1]), (106, " ".join(["the"] * 20)), (107, "naïve Ünïcode É word")]
    docs = samples.prose(22, 20, words=150)
    for i, text in list(items)[:20]:
        padded = docs[i % 10].split(" ")
        docs.append(" ".join([*padded[:20], (text or "").upper() + "!", *padded[20:]]))
        docs.append(" ".join(padded + (text or "").split(" ")[:12]))  # one word short of a window
    docs += [None, "", "...", "ONE", "one-two", "only, four; words (here)", "the " * 40,
             "naïve ünïcode É word", "naïve Ünïcode É word"]
    return list(enumerate(docs)), items


def test_brute_force(spark):
    docs, items = tables()
    got = decontam.contamination(
        samples.documents(spark, docs),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == plain(docs, items)
    assert sum(r["contaminated"] for r in got) > 8


def test_rows_that_go(spark):
    docs, items = tables()
    frame = samples.documents(spark, [*docs, (None, items[0][1]), (None, "clean words"), docs[0]])
    asked = spark.createDataFrame(items, "item_id long, text string")
    kept = decontam.without_contaminated(frame, asked)
    bad = {i for i, r in plain(docs, items).items() if r[-1]}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted([*{i for i, _ in docs} - bad, 0])
    assert kept.columns == frame.columns


def test_null_and_repeated_ids(spark):
    _, items = tables()
    whole = items[0][1]
    rows = [(None, whole), (None, "clean words"), (None, None), (7, whole), (7, "other clean words")]
    frame = samples.documents(spark, rows)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["n_items"], r["contaminated"])
           for r in decontam.contamination(frame, asked).collect()}
    size = len(words(whole))
    assert got[None, size] == got[7, size] == (size, 1, True)
    assert got[None, 2] == got[None, 0] == got[7, 3] == (0, 0, False)
    kept = {(r["doc_id"], r["text"]) for r in decontam.without_contaminated(frame, asked).collect()}
    assert kept == {rows[1], rows[2], rows[4]}


def test_other_names_for_id_and_text(spark):
    docs, items = tables()
    frame = samples.documents(spark, docs)
    asked = spark.createDataFrame(items, "item_id long, text string")
    renamed = frame.withColumnsRenamed({"doc_id": "page", "text": "body"})
    kept = decontam.without_contaminated(renamed, asked, key="page", text="body")
    wanted = decontam.without_contaminated(frame, asked)
    assert kept.columns == renamed.columns
    assert sorted(r["page"] for r in kept.collect()) == sorted(r["doc_id"] for r in wanted.collect())


def test_empty_tables(spark):
    docs, items = tables()
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontam.contamination(samples.documents(spark, docs), none).collect()
    assert len(got) == len(docs) and not any(r["n_hit"] or r["contaminated"] for r in got)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contamination(samples.empty(spark), asked).collect() == []
