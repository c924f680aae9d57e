from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tillmark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window string, parts string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations():
    draw = random.Random(6)
    pieces = ["<|im_start|>", "<|im_end|>\n", "</s>[INST] ok [/INST]", "<\\|im_end|>", "plain words",
              "\n", "\\", "<", "[", "é漢", "<<SYS>>", "user\n"]
    rows = []
    for conv in range(40):
        turns = draw.randint(1, 14)
        for turn in range(turns):
            role = "system" if turn == 0 and conv % 2 else draw.choice(["user", "assistant", "tool"])
            text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 30)))
            rows.append((conv, turn, role, text, "x", "y"))
    rows += [(100, 0, None, None, "x", "y"), (100, None, "assistant", "first", "x", "y"),
             (101, 0, "a\nb%0A", "t", "x", "y"), (101, 1, "assistant", "", "x", "y"),
             (102, 0, "assistant", "same", "x", "y"), (102, 0, "assistant", "same", "x", "y"),
             (103, 0, "system", "alone", "x", "y"), (104, 0, "user", "w " * 5000, "x", "y"),
             (None, 0, "user", "no id", "x", "y")]
    return rows


def test_read_back(spark):
    rows = conversations()
    frame = spark.createDataFrame(rows, SCHEMA)
    windows = chat.windows(frame, budget=120, history_tokens=30, system_tokens=30)
    got = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    assert set(by) == set(got)
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))


def test_windows_keep_the_budget(spark):
    rows = [r for r in conversations() if r[0] is not None and r[0] < 40]
    frame = spark.createDataFrame(rows, SCHEMA)
    size = lambda text: F.length(text).cast("long") + 1
    windows = chat.windows(frame, 300, 60, 2, 100, tokens=size).collect()
    texts = {}
    for conv, turn, role, text, *_ in rows:
        texts.setdefault(conv, []).append((turn, role, text))
    assert sum(w["window"] > 0 for w in windows) > 20
    for w in windows:
        parts = w["formatted"].split(chat.START)[1:]
        turns = sorted(texts[w["conv_id"]])
        if turns[0][1] == "system":
            assert parts[0].startswith("system\n")
        assert w["repeated"] <= 3 and len(parts) > w["repeated"]
        if w["window"] == 0:
            assert w["repeated"] == 0
    # New turns fill at most the room of 140, unless one turn alone is larger.
    news = chat.read_back(chat.windows(frame, 300, 60, 2, 100, tokens=size)).collect()
    for w in news:
        own = [t for t in w["turns"] if t["role"] != "system"]
        assert len(own) <= 1 or sum(len(t["text"]) + 1 for t in own) <= 140


def test_escape_is_reversible(spark):
    texts = [r[3] or "" for r in conversations()]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", chat.escape(F.col("t")).alias("e"))
    got = got.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect()
    assert all(r["t"] == r["u"] and chat.START not in r["e"] for r in got)


def test_no_conversations(spark):
    assert chat.digests(chat.windows(spark.createDataFrame([], SCHEMA))).collect() == []
