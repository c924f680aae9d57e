"""Chat formatting in budgeted windows.

Each conversation is cut into windows of whole turns by prefix sums of turn tokens: the running
total before a turn, divided by the room a window has for new turns, names its cell; a turn that
crosses into the next cell gets a window of its own. So new turns fill at most the room, unless
one turn alone is larger, and no turn is ever cut. Each window starts with the system turn, then
repeats the turns just before it as far as the history allowance goes, then holds its new turns.
The loss mask covers the text of the new assistant turns only, so every target counts once.

A formatted turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is
put after the first character of every control string (``<\\|im_end|>``), one more if there are
some already, which ``unescape`` takes away again.

Native: DataFrame and SQL functions only.

Edge cases: null texts and roles are empty strings; turns are ordered by (turn, role, text), null
turns first, and equal rows are turns of their own; only a leading ``system`` turn is retained;
rows with a null conversation id form one conversation; an empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
# Control strings of common chat templates, without their first character.
_CONTROL = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def _escape_role(role: Column) -> Column:
    """Roles end at a line break, so theirs are spelled out."""
    plain = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(plain)


def _unescape_role(role: Column) -> Column:
    plain = unescape(role)
    return F.replace(F.replace(plain, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def word_tokens(text: Column) -> Column:
    """A token per word and three for the marks: the default measure of a turn."""
    words = F.length(text) - F.length(F.regexp_replace(text, r"\s+", ""))
    return words.cast("long") + 4


def windows(
    turns: DataFrame,
    budget: int = 1024,
    history_tokens: int = 256,
    history_turns: int = 2,
    system_tokens: int = 256,
    tokens=word_tokens,
) -> DataFrame:
    """One row per window: conv_id, window, repeated, formatted, loss.

    ``repeated`` is the number of leading turns shown again (system and history), ``loss`` the
    spans (start, end) of target text, as code points of ``formatted``. ``tokens`` maps a text
    column to its token count. A system turn over ``system_tokens`` is still retained whole.
    """
    room = budget - history_tokens - system_tokens
    if room < 1:
        raise ValueError("history and system allowances leave no room for new turns")
    talk = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = (
        turns.select(
            "conv_id",
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .withColumn("tokens", tokens(F.col("text")))
        .withColumn("place", F.row_number().over(talk))
        .withColumn("leads", (F.col("place") == 1) & (F.col("role") == "system"))
        .withColumn(
            "shown",
            F.concat(
                F.lit(START), _escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")),
                F.lit(END),
            ),
        )
        .drop("text")
    )
    order = Window.partitionBy("conv_id").orderBy("place")
    upto = F.sum(F.when(F.col("leads"), 0).otherwise(F.col("tokens"))).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    cell = F.expr(f"(upto - if(leads, 0, tokens)) div {room}")
    last_cell = F.expr(f"greatest(upto - 1, 0) div {room}")
    turn = F.struct("place", "role", "shown", F.col("leads").alias("leads"), "tokens")
    earlier = F.array(*[F.lag(turn, back).over(order) for back in range(history_turns, 0, -1)])
    cells = placed.withColumn("upto", upto).withColumn(
        "cell", F.when(F.col("leads"), -1).otherwise(cell * 2 + (last_cell > cell).cast("long"))
    )
    # A leading system turn alone makes a window only if nothing follows it.
    cells = cells.withColumn(
        "cell",
        F.when(F.col("leads"), F.coalesce(F.lead("cell").over(order), F.lit(0))).otherwise(
            F.col("cell")
        ),
    )
    first = F.coalesce(F.lag("cell").over(order) != F.col("cell"), F.lit(True))
    system = F.first(F.when(F.col("leads"), turn)).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    marked = (
        cells.withColumn("first", first)
        .withColumn("window", F.sum(F.col("first").cast("long")).over(order) - 1)
        .withColumn("system", F.when(F.col("first") & ~F.col("leads"), system))
        .withColumn("earlier", F.when(F.col("first"), earlier))
    )
    gathered = (
        marked.groupBy("conv_id", "window")
        .agg(
            F.sort_array(F.collect_list(turn)).alias("new"),
            F.max("system").alias("system"),
            F.max_by("earlier", F.col("first")).alias("earlier"),
        )
        .withColumn("history", _within(F.col("earlier"), history_tokens))
        .withColumn(
            "again",
            F.concat(F.filter(F.array("system"), lambda t: t.isNotNull()), F.col("history")),
        )
    )
    targets = F.transform(F.concat(F.col("again"), F.col("new")), lambda t: t["shown"])
    formatted = gathered.withColumn("parts", targets).withColumn(
        "ends",
        F.aggregate(
            F.transform("parts", lambda p: F.length(p)),
            F.array(F.lit(0)),
            lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)),
        ),
    )
    return formatted.select(
        "conv_id",
        "window",
        F.size("again").alias("repeated"),
        F.array_join("parts", "").alias("formatted"),
        _loss(F.col("again"), F.col("new"), F.col("ends")).alias("loss"),
    )


def _within(earlier: Column, allowance: int) -> Column:
    """The latest of the earlier turns that fit the allowance together, in their order."""
    taken = F.aggregate(
        F.reverse(F.filter(earlier, lambda t: t.isNotNull() & ~t["leads"])),
        F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("used"), F.lit(True).alias("on")),
        lambda a, t: F.struct(
            F.when(a["on"] & (a["used"] + t["tokens"] <= allowance), a["n"] + 1)
            .otherwise(a["n"])
            .alias("n"),
            (a["used"] + t["tokens"]).alias("used"),
            (a["on"] & (a["used"] + t["tokens"] <= allowance)).alias("on"),
        ),
        lambda a: a["n"],
    )
    kept = F.filter(earlier, lambda t: t.isNotNull() & ~t["leads"])
    return F.slice(kept, F.size(kept) - taken + 1, taken)


def _loss(again: Column, new: Column, ends: Column) -> Column:
    """Spans of the new assistant texts: after the role's line, before the end mark."""
    spans = F.transform(
        new,
        lambda t, i: F.struct(
            (
                F.element_at(ends, F.size(again) + i + 1)
                + F.lit(len(START))
                + F.length(_escape_role(t["role"]))
                + 1
            ).alias("start"),
            (F.element_at(ends, F.size(again) + i + 2) - F.lit(len(END))).alias("end"),
            (t["role"] == "assistant").alias("target"),
        ),
    )
    return F.transform(
        F.filter(spans, lambda s: s["target"]),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows say, from their text and mask alone: new turns and target texts.

    One row per window: conv_id, window, turns (role, text), targets, chars.
    """
    bodies = F.slice(
        F.split(F.col("formatted"), r"<\|im_start\|>"), 2, F.length("formatted")
    )
    turn = F.transform(
        bodies,
        lambda b: F.struct(
            _unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(
                b.substr(
                    F.length(F.substring_index(b, "\n", 1)) + 2,
                    F.length(b) - F.length(F.substring_index(b, "\n", 1)) - 1 - len(END),
                )
            ).alias("text"),
        ),
    )
    target = F.transform(
        "loss",
        lambda s: unescape(F.col("formatted").substr(s["start"] + 1, s["end"] - s["start"])),
    )
    return formatted.select(
        "conv_id",
        "window",
        F.slice(turn, F.col("repeated") + 1, F.greatest(F.size(turn) - F.col("repeated"), F.lit(0)))
        .alias("turns"),
        target.alias("targets"),
        F.length("formatted").cast("long").alias("chars"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The digests are over whole conversations, so a task holds one conversation at a time.
    """
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    per_window = read_back(formatted).select(
        "conv_id",
        "chars",
        F.size("turns").cast("long").alias("n"),
        F.struct(
            "window", said.alias("said"), F.array_join("targets", "").alias("target")
        ).alias("part"),
    )
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    turns = F.array_join(F.transform("parts", lambda p: p["said"]), "")
    loss = F.array_join(F.transform("parts", lambda p: p["target"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
