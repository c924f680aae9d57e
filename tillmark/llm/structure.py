"""Repair of conversation structure by a run-length dynamic programme.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Every row is kept (cost 0),
given the role user or assistant (1) or deleted (2); an empty user or assistant turn may be
inserted anywhere (5); a truncated row that stays costs 5 more; blank and repeated rows must go.

Where the output stands is one of four states, so a row is a min-plus matrix of four by four that
depends on its symbol alone: the class of its role and its fault. Equal consecutive symbols are a
run, and a run of n rows is the n-th power of its matrix, taken from cached binary powers. Costs to
go are known at the ends of the runs first; the audit is then unrolled from the front, block by
block in powers of two, with the cost to go at the middle of a block from the next smaller power.
Equal blocks are unrolled once. Among the cheapest edits the least letter is taken at every step
(D, I, K, R), which gives the least audit.

Matrices can be multiplied in any grouping, so a conversation need not be in one task: rows are
put in global order (``operators.ordering``), every bucket sums its first and last conversation
up, and from these few rows the driver tells each bucket with which state and costs to go its
share begins and ends. Texts take no part in that; they are joined to the rows that stay.

Edge cases: null ids, roles and texts count as one space, null turns come first and are no turn
in the gaps; rows of one turn are ordered by a digest of role and text; repeated rows are held
as one with a number; texts of any length, empty ones included, are judged whole; gaps beyond a
long are null; an empty table gives no rows; other columns are left behind.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.frames import whole_groups
from tillmark.operators.ordering import BUCKET, SLOT, in_buckets
from tillmark.session import cut_lineage

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"

# Where the output stands: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
_FOLLOWS = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
# No way leads there; sums stay within a long.
FAR = 1 << 60
# The least inserts that end a conversation properly.
DONE = (0, 2 * INSERT, INSERT, 0)

# Symbols: 0 must be deleted, 1-4 sound (system, user, assistant, other), 5-8 the same truncated.
CLASSES = "sua"
# Which class may follow which; 0 stands for no row.
_LEGAL = np.zeros((5, 5), dtype=bool)
_LEGAL[0] = _LEGAL[1, 2] = _LEGAL[2, 3] = _LEGAL[3, 2] = True

_HELD_BITS = 8


def _steps(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row."""
    steps = [("D", DELETE, state)]
    if symbol:
        more = TRUNCATED if symbol > 4 else 0
        role = (symbol - 1) % 4 + 1
        if (role == 1 and state == START) or (role in (USER, ASSISTANT) and role == _FOLLOWS[state]):
            steps.append(("K", more, role))
        steps.append(("R", REROLE + more, _FOLLOWS[state]))
    return steps


def _before(symbol: int, after: tuple) -> tuple:
    """Costs to go before one row, from those after it."""
    own = [min(FAR, *(cost + after[to] for _, cost, to in _steps(symbol, s))) for s in range(4)]
    once = [_FOLLOWS[s] for s in range(4)]
    return tuple(
        min(FAR, own[s], INSERT + own[once[s]], 2 * INSERT + own[once[once[s]]])
        for s in range(4)
    )


def _product(a: tuple, b: tuple) -> tuple:
    return tuple(
        tuple(min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4)
    )


def _applied(a: tuple, after: tuple) -> tuple:
    return tuple(min(a[i][k] + after[k] for k in range(4)) for i in range(4))


UNIT = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, bits: int) -> tuple:
    """The matrix of 2**bits rows of one symbol."""
    if bits:
        half = power(symbol, bits - 1)
        return _product(half, half)
    columns = [_before(symbol, tuple(0 if i == j else FAR for i in range(4))) for j in range(4)]
    return tuple(tuple(columns[j][i] for j in range(4)) for i in range(4))


def run_matrix(runs) -> tuple:
    """The matrix of runs (symbol, number of rows)."""
    total = UNIT
    for symbol, n in runs:
        for bits in range(int(n).bit_length()):
            if n >> bits & 1:
                total = _product(total, power(symbol, bits))
    return total


def costs_before(symbol: int, n: int, after: tuple) -> tuple:
    for bits in range(int(n).bit_length()):
        if n >> bits & 1:
            after = _applied(power(symbol, bits), after)
    return after


def _row(symbol: int, state: int, after: tuple) -> tuple[str, int]:
    """The letters up to and with those of one row, and the state behind it."""
    goal = _before(symbol, after)
    letters = ""
    while True:
        choices = [(c, to) for c, cost, to in _steps(symbol, state) if cost + after[to] == goal[state]]
        if INSERT + goal[_FOLLOWS[state]] == goal[state]:
            choices.append(("I", _FOLLOWS[state]))
        letter, state = min(choices)
        letters += letter
        if letter != "I":
            return letters, state


def _block(symbol: int, bits: int, state: int, after: tuple) -> tuple[str, int]:
    """The letters of 2**bits rows of one symbol. Only differences of ``after`` matter."""
    return (_held if bits <= _HELD_BITS else _halves)(symbol, bits, state, after)


def _halves(symbol: int, bits: int, state: int, after: tuple) -> tuple[str, int]:
    if not bits:
        return _row(symbol, state, after)
    middle = _relative(_applied(power(symbol, bits - 1), after))
    left, state = _block(symbol, bits - 1, state, middle)
    right, state = _block(symbol, bits - 1, state, after)
    return left + right, state


_held = lru_cache(maxsize=1 << 15)(_halves)


def _relative(costs: tuple) -> tuple:
    least = min(costs)
    return tuple(cost - least for cost in costs)


def unroll(runs, state: int = START, after: tuple = DONE) -> tuple[str, int, int]:
    """The letters of runs of rows, the state behind them and their cost, without final inserts."""
    ends = [after]
    for symbol, n in reversed(runs):
        ends.append(costs_before(symbol, n, ends[-1]))
    cost, letters = ends[-1][state], []
    for (symbol, n), end in zip(runs, reversed(ends[:-1])):
        for bits in reversed(range(int(n).bit_length())):
            if n >> bits & 1:
                n -= 1 << bits
                to_go = _relative(costs_before(symbol, n, end))
                part, state = _block(symbol, bits, state, to_go)
                letters.append(part)
    return "".join(letters), state, cost - after[state]


@lru_cache(maxsize=1 << 14)
def _short(runs: tuple, state: int, after: tuple) -> tuple[str, int, int]:
    return unroll(runs, state, after)


def planted_damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults by the checksum of ``conv_id:turn``: a twentieth of the rows each
    dropped, emptied, without sentence ends, repeated, or given to the user. ``n`` is how often a
    row stands."""
    blank = F.lit(" ")
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (
            F.crc32(
                F.concat(
                    _conversation(), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
                ).cast("binary")
            )
            % 20
        ).alias("fault"),
    ).filter("fault <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("n"),
    )


def _conversation() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))


def distinct_rows(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n, mark): equal rows once, with their number, on disk.

    ``turns`` has conv_id, turn, role, text and may have their number ``n``. Equal rows are summed
    in the tasks that read them, so many copies of one row are no hot key.
    """
    blank = F.lit(" ")
    number = F.col("n") if "n" in turns.columns else F.lit(1)
    rows = turns.select(
        _conversation().alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        number.cast("long").alias("n"),
    )
    own = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return cut_lineage(
        rows.groupBy("conv", "turn", "role", "text")
        .agg(F.sum("n").alias("n"))
        .withColumn("mark", F.md5(own.cast("binary")))
    )


def _symbols(rows: DataFrame) -> DataFrame:
    """Rows without their texts: class of the role (1-4), symbol of the first one, faults.

    A row is a duplicate if the conversation has its role and text in an earlier turn.
    """
    bare = F.rtrim("text", F.lit(WHITE))
    initial = F.lit(4)
    for number, letter in enumerate(CLASSES, 1):
        initial = F.when(F.substring("role", 1, 1) == letter, number).otherwise(initial)
    slim = rows.select(
        "conv",
        "turn",
        "mark",
        "n",
        initial.alias("kind"),
        (F.length(bare) == 0).alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    earliest = (
        slim.groupBy("conv", "mark")
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"),
             F.count("*").alias("turns"))
        .filter("turns > 1")
        .select("conv", "mark", F.col("first.turn").alias("first_turn"), F.lit(True).alias("again"))
    )
    seen = F.col("again").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return slim.join(earliest, ["conv", "mark"], "left").select(
        "conv",
        "turn",
        "mark",
        "n",
        F.col("kind").cast("int").alias("kind"),
        "blank",
        seen.alias("seen"),
        (
            F.when(F.col("blank") | seen, 0)
            .otherwise(F.col("kind") + F.when(F.col("open"), 4).otherwise(0))
            .cast("int")
            .alias("symbol")
        ),
    )


class _Shares:
    """The rows of one table of whole groups, by conversation, as numpy arrays."""

    def __init__(self, table: pa.Table, bounds: np.ndarray) -> None:
        self.table, self.bounds = table, bounds
        self.bucket = int(table.column(BUCKET)[0].as_py())
        turn = table.column("turn")
        self.known = np.asarray(turn.is_valid())
        self.turn = np.asarray(turn.fill_null(0))
        self.n, self.kind, self.symbol, self.blank, self.seen = (
            np.asarray(table.column(name)) for name in ("n", "kind", "symbol", "blank", "seen")
        )
        # A row is its symbol once, and for its further copies the symbol that must go.
        self.symbols = np.stack([self.symbol, np.zeros_like(self.symbol)], axis=1).ravel()
        self.numbers = np.stack([np.ones_like(self.n), self.n - 1], axis=1).ravel()

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def conv(self, group: int) -> str:
        return self.table.column("conv")[int(self.bounds[group])].as_py()

    def ends(self) -> set[int]:
        return {0, len(self) - 1}

    def runs(self, group: int) -> tuple:
        """Runs (symbol, number) of one conversation."""
        cut = slice(2 * self.bounds[group], 2 * self.bounds[group + 1])
        symbols, numbers = self.symbols[cut], self.numbers[cut]
        symbols, numbers = symbols[numbers > 0], numbers[numbers > 0]
        starts = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        return tuple(zip(symbols[starts].tolist(), np.add.reduceat(numbers, starts).tolist()))

    def faults(self, before: tuple | None) -> dict[str, np.ndarray]:
        """Counts for each conversation; ``before`` is (kind, turn) of a row that precedes the first
        one in the same conversation."""
        starts, ends = self.bounds[:-1], self.bounds[1:]
        kind = np.concatenate([[0], self.kind[:-1]])
        turn = np.concatenate([[0], self.turn[:-1]])
        known = np.concatenate([[False], self.known[:-1]])
        kind[starts], known[starts] = 0, False
        if before:
            kind[0], known[0] = before[0], before[1] is not None
            turn[0] = before[1] or 0
        again = np.where(self.seen, self.n, self.n - 1)
        unknown = np.add.reduceat((~self.known).astype(np.int64), starts)
        counts = {
            "blank": np.where(self.blank, self.n, 0),
            "duplicate": np.where(self.blank, 0, again),
            "truncated": self.symbol > 4,
            "illegal": self.n - 1 + ~_LEGAL[kind, self.kind],
            "turns": self.known & ~(known & (turn == self.turn)),
        }
        sums = {k: np.add.reduceat(v.astype(np.int64), starts) for k, v in counts.items()}
        first = np.minimum(starts + unknown, ends - 1)
        sums["first_turn"], sums["last_turn"] = self.turn[first], self.turn[ends - 1]
        sums["no_turn"] = unknown == ends - starts
        return sums


def _shares(batches):
    for table, bounds in whole_groups(batches, ["conv"]):
        yield _Shares(table, bounds)


def _borders(placed: DataFrame) -> list:
    """The first and the last conversation of every bucket: its matrix, and its last row.

    At most two rows per bucket, whatever the data.
    """

    def convert(batches):
        found = []
        for share in _shares(batches):
            for group in sorted(share.ends()):
                end = int(share.bounds[group + 1]) - 1
                row = {
                    "bucket": share.bucket,
                    "conv": share.conv(group),
                    "matrix": [cost for line in run_matrix(share.runs(group)) for cost in line],
                    "kind": int(share.kind[end]),
                    "turn": int(share.turn[end]) if share.known[end] else None,
                }
                found = [*found[:1], row]
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)

    schema = pa.schema(
        {
            "bucket": pa.int64(),
            "conv": pa.string(),
            "matrix": pa.list_(pa.int64()),
            "kind": pa.int32(),
            "turn": pa.int64(),
        }
    )
    rows = placed.mapInArrow(
        convert, "bucket long, conv string, matrix array<long>, kind int, turn long"
    ).collect()
    return sorted(rows, key=lambda r: (r["bucket"], r["conv"].encode()))


def _contexts(placed: DataFrame) -> dict:
    """What a bucket must know: the row before it, and for the conversations that it shares with
    other buckets the state they enter in and the costs to go behind the bucket."""
    borders = _borders(placed)
    chains: dict[str, list] = {}
    for row in borders:
        chains.setdefault(row["conv"], []).append(row)
    shared = {conv: rows for conv, rows in chains.items() if len(rows) > 1}
    after, states, unfinished = {}, {}, set()
    for conv, rows in shared.items():
        costs = DONE
        for row in reversed(rows):
            after[row["bucket"], conv] = costs
            flat = row["matrix"]
            costs = _applied(tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4)), costs)
        unfinished.update((row["bucket"], conv) for row in rows[:-1])
    if shared:
        left = {(r["bucket"], r["conv"], r["entry"]): r["state"] for r in _leaves(placed, after)}
        for conv, rows in shared.items():
            state = START
            for row in rows:
                states[row["bucket"], conv] = state
                state = left[row["bucket"], conv, state]
    previous = {}
    for row, following in zip(borders, borders[1:]):
        if row["conv"] == following["conv"]:
            previous[following["bucket"]] = (row["kind"], row["turn"])
    return {"previous": previous, "after": after, "states": states, "unfinished": unfinished}


def _leaves(placed: DataFrame, after: dict) -> list:
    """The state in which each shared part of a conversation leaves, for every state to enter in."""

    def convert(batches):
        found = []
        for share in _shares(batches):
            for group in share.ends():
                conv = share.conv(group)
                costs = after.get((share.bucket, conv))
                if costs:
                    runs = share.runs(group)
                    for entry in range(4):
                        found.append((share.bucket, conv, entry, unroll(runs, entry, costs)[1]))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*found)], names=["bucket", "conv", "entry", "state"]
            )

    return placed.mapInArrow(
        convert, "bucket long, conv string, entry long, state long"
    ).collect()


_OUTPUT = pa.struct({"edit": pa.string(), "role": pa.string()})
_COUNTS = ["cost", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn"]
_SHARE = "audit: string, " + ", ".join(f"{name}: long" for name in _COUNTS)
_DECIDED = (
    f"conv string, {BUCKET} long, {SLOT} long, turn long, mark string,"
    f" outputs array<struct<edit: string, role: string>>, share struct<{_SHARE}>"
)


def _put_out(letters: str, copies: list[int], kinds: list[int], state: int) -> list[list[dict]]:
    """What each row puts out: an edit and its role, which is None where the row's own stays."""
    done, at = [], 0
    for left, kind in zip(copies, kinds):
        own = []
        while left:
            letter = letters[at]
            at += 1
            left -= letter != "I"
            if letter == "K":
                state = kind
                own.append({"edit": letter, "role": None})
            elif letter != "D":
                state = _FOLLOWS[state]
                own.append({"edit": letter, "role": ROLES[state]})
        done.append(own)
    for letter in letters[at:]:
        state = _FOLLOWS[state]
        done[-1].append({"edit": letter, "role": ROLES[state]})
    return done


def decide(rows: DataFrame) -> DataFrame:
    """One line per distinct row, in order of bucket and slot, with its outputs; the last line of
    each conversation in a bucket has the audit, cost and faults of its share. On disk."""
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("mark").asc()]
    placed = in_buckets(_symbols(rows), order)
    shared = placed.sparkSession.sparkContext.broadcast(_contexts(placed))

    def decided(share: _Shares, first: bool) -> pa.RecordBatch:
        context = shared.value
        faults = share.faults(context["previous"].get(share.bucket) if first else None)
        outputs, audits, costs = [], [], []
        for group in range(len(share)):
            place = (share.bucket, share.conv(group))
            entry = context["states"].get(place, START)
            after = context["after"].get(place, DONE)
            runs = share.runs(group)
            cut = slice(int(share.bounds[group]), int(share.bounds[group + 1]))
            solve = _short if cut.stop - cut.start <= 64 else unroll
            letters, state, cost = solve(runs, entry, after)
            while place not in context["unfinished"] and state not in (START, ASSISTANT):
                letters, state, cost = letters + "I", _FOLLOWS[state], cost + INSERT
            audits.append(letters)
            costs.append(cost)
            outputs += _put_out(letters, share.n[cut].tolist(), share.kind[cut].tolist(), entry)
        last = share.bounds[1:] - 1
        lines = share.table.num_rows
        text = np.full(lines, None, dtype=object)
        text[last] = audits
        columns = [pa.array(text, pa.string())]
        for name in _COUNTS:
            values = np.zeros(lines, dtype=np.int64)
            values[last] = costs if name == "cost" else faults[name]
            missing = np.zeros(lines, dtype=bool)
            if name in ("first_turn", "last_turn"):
                missing[last] = faults["no_turn"]
            columns.append(pa.array(values, mask=missing))
        inner = np.ones(lines, dtype=bool)
        inner[last] = False
        table = share.table.combine_chunks()
        return pa.RecordBatch.from_arrays(
            [
                *[_whole(table.column(name)) for name in ("conv", BUCKET, SLOT, "turn", "mark")],
                pa.array(outputs, pa.list_(_OUTPUT)),
                pa.StructArray.from_arrays(
                    columns, names=["audit", *_COUNTS], mask=pa.array(inner)
                ),
            ],
            names=["conv", BUCKET, SLOT, "turn", "mark", "outputs", "share"],
        )

    def convert(batches):
        for number, share in enumerate(_shares(batches)):
            yield decided(share, number == 0)

    return cut_lineage(placed.mapInArrow(convert, _DECIDED))


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


def summaries(decisions: DataFrame) -> DataFrame:
    """Faults, cost and audit of every conversation that has rows.

    A conversation has one line per bucket it is in, so no group outgrows the number of buckets
    but by the length of the audit itself.
    """
    shares = decisions.filter(F.col("share").isNotNull()).select("conv", BUCKET, "share.*")
    wide = "decimal(38,0)"
    span = F.max("last_turn").cast(wide) - F.min("first_turn").cast(wide) + 1 - F.sum("turns")
    parts = F.sort_array(F.collect_list(F.struct(BUCKET, "audit")))
    return shares.groupBy("conv").agg(
        F.coalesce(span, F.lit(0).cast(wide)).try_cast("long").alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(parts, lambda part: part["audit"]), "").alias("audit"),
    )


def repaired(decisions: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows after repair: conv, bucket, slot and place (their order), role, text."""
    out = decisions.select(
        "conv", BUCKET, SLOT, "turn", "mark", F.posexplode("outputs").alias("place", "out")
    ).select("conv", BUCKET, SLOT, "place", "turn", "mark", "out.edit", F.col("out.role").alias("new"))
    order = ["conv", BUCKET, SLOT, "place"]
    inserted = out.filter("edit = 'I'").select(
        *order, F.col("new").alias("role"), F.lit("").alias("text")
    )
    own = rows.select(
        F.col("conv").alias("own_conv"),
        F.col("mark").alias("own_mark"),
        F.col("turn").alias("own_turn"),
        "role",
        "text",
    )
    kept = (
        out.filter("edit <> 'I'")
        .join(
            own,
            (F.col("conv") == F.col("own_conv"))
            & (F.col("mark") == F.col("own_mark"))
            & F.col("turn").eqNullSafe(F.col("own_turn")),
        )
        .select(*order, F.coalesce("new", "role").alias("role"), "text")
    )
    return inserted.unionByName(kept)


def digests(output: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): digest of ``role:text`` lines joined by line breaks.

    A digest must see its conversation in order, so each one passes through one task; the task
    holds no more of it than a batch of rows.
    """

    def convert(batches):
        conv, state = None, None
        for batch in batches:
            done = []
            columns = (batch.column(name).to_pylist() for name in ("conv", "role", "text"))
            for own, role, text in zip(*columns):
                if state is None or own != conv:
                    if state:
                        done.append((conv, state.hexdigest()))
                    conv, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield _digest_rows(done)
        if state:
            yield _digest_rows([(conv, state.hexdigest())])

    order = ["conv", BUCKET, SLOT, "place"]
    return (
        output.repartition("conv")
        .sortWithinPartitions(*order)
        .select("conv", "role", "text")
        .mapInArrow(convert, "conv string, repaired_sha256 string")
    )


def _digest_rows(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column) for column in zip(*rows)], names=["conv", "repaired_sha256"]
    )


def audit(turns: DataFrame, original: DataFrame | None = None) -> DataFrame:
    """Per conversation of ``original`` (else of ``turns``): faults, cost, audit and the digest of
    its repaired rows. Conversations without rows have zeros and the digest of nothing."""
    rows = distinct_rows(turns)
    decisions = decide(rows)
    ids = (turns if original is None else original).select("conv_id").distinct()
    ids = ids.withColumn("conv", _conversation())
    joined = ids.join(summaries(decisions), "conv", "left").join(
        digests(repaired(decisions, rows)), "conv", "left"
    )
    some = F.col("audit").isNotNull()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.when(some, F.col(name)).otherwise(F.lit(0).cast("long")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
