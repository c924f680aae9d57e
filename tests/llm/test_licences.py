from __future__ import annotations

import pytest
import samples
from pyspark.sql import functions as F

from tillmark.llm import licences

DECLARED = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "released under the mit license": "MIT",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "All rights reserved.": "proprietary",
}
TALK = ["The driver's license was renewed.", "Copyright law is a topic of the public domain talk.",
        "He lost his licence in the city", "the words of a plain paragraph"]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i, t) for i, t in enumerate(samples.prose(51, 60))]
    rows += [(100 + i, f"copyright {t}") for i, t in enumerate(samples.prose(52, 60, words=8))]
    return licences.learn(samples.documents(spark, rows))


def test_families(spark, fitted):
    lines = [*DECLARED, *TALK]
    docs = samples.documents(spark, [(1, "\n".join(lines)), (2, None), (3, ""), (4, "\n\n")])
    found = {r["paragraph"]: r["family"] for r in licences.scan(docs, fitted).collect()}
    assert {t: found[t] for t in DECLARED} == DECLARED
    assert all(found.get(t, licences.UNKNOWN) == licences.UNKNOWN for t in TALK)


def test_per_document(spark, fitted):
    rows = [(1, "intro\n" + "\n".join(DECLARED) + "\n" + TALK[0]), (2, None), (3, ""),
            (None, "All rights reserved."), (5, "x " * 50_000 + "\nAll rights reserved.")]
    got = {r["doc_id"]: r for r in licences.per_document(samples.documents(spark, rows), fitted).collect()}
    assert len(got) == 5
    assert (got[1]["n_paragraphs"], got[1]["n_cued"], got[1]["n_licensed"]) == (8, 7, 6)
    assert got[1]["families"] == ",".join(sorted(DECLARED.values()))
    assert (got[2]["n_paragraphs"], got[2]["families"]) == (0, "")
    assert got[None]["families"] == got[5]["families"] == "proprietary"


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 Anna Example

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above notice.
""",
    "GPL-3.0": """# tool.py
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
""",
}


def test_grams(spark):
    words = F.split(F.lit("a b c d"), " ")
    row = spark.range(1).select(licences._pairs(words), licences._features(words)).first()
    assert row[0] == ["a b", "b c", "c d"]
    assert row[1] == ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"]


def test_wrapped_notices(spark, fitted):
    texts = list(WRAPPED.values())
    plain = samples.prose(53, 6, words=10)
    rows = list(enumerate(texts)) + [
        (10, "\n".join([*plain[:3], texts[1].split("\n\n")[0], *plain[3:]])),  # no blank lines
        (11, "\r\n".join(texts[0].split("\n"))),
        (12, "\n\n".join(texts)),
        (13, "All rights\nreserved."),
        (14, "\n".join(TALK)),
        (15, texts[0]), (15, texts[0]),
    ]
    docs = samples.documents(spark, rows)
    got = {}
    for r in licences.per_document(docs, fitted).collect():
        got[r["doc_id"]] = (r["n_licensed"], r["families"])
    assert [got[i] for i in range(3)] == [(1, name) for name in WRAPPED]
    assert got[10] == (1, "BSD-3-Clause") and got[11] == (1, "MIT") and got[13] == (1, "proprietary")
    assert got[12] == (3, ",".join(sorted(WRAPPED))) and got[14] == (0, "") and got[15] == (2, "MIT")
    first, = licences.scan(docs.filter("doc_id = 0"), fitted).filter("family = 'MIT'").collect()
    assert (first["number"], first["last"]) == (4, 6)


def test_empty(spark, fitted):
    assert licences.per_document(samples.empty(spark), fitted).collect() == []
    assert licences.learn(samples.empty(spark))[2] >= 0.5


def test_learns_from_every_line(spark, monkeypatch):
    lines = [f"copyright {t}" for t in samples.prose(54, 4500, words=5)]
    held = []
    scored = licences._scored
    monkeypatch.setattr(
        licences, "_scored", lambda frame, *rest: held.append(frame.count()) or scored(frame, *rest)
    )
    rows = [(i, "\n".join(lines[i::50])) for i in range(50)]
    licences.learn(samples.documents(spark, rows))
    assert held[0] > 0.2 * len(set(lines)) > 500


def test_percentile(spark):
    for values in ([0.25], [0.1, 0.2], [i / 977 for i in range(977)], [0.5] * 7 + [0.50001, 1.0]):
        frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "chance double")
        for share in (0.99, 0.5, 0.0):
            expected = frame.agg(F.percentile("chance", share)).first()[0]
            assert licences._percentile(frame, share) == pytest.approx(expected, abs=1e-15)
    assert licences._percentile(frame.filter("chance > 2"), 0.99) == 0.0


def test_fit_runs_in_as_few_tasks_as_hold_the_rows(spark):
    rows = spark.range(0, 95, 1, 37)
    packed = licences._packed(rows, 20)
    assert packed.rdd.getNumPartitions() == 5
    assert sorted(r["id"] for r in packed.collect()) == list(range(95))
    assert licences._packed(rows).rdd.getNumPartitions() == 1
    assert licences._packed(rows.limit(0)).count() == 0
