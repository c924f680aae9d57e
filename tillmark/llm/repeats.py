"""Removal of repeated byte strings by longest-previous-factor arrays.

Every byte covered by a string of ``length`` bytes that also starts earlier in the corpus (in a
text with a smaller id, or earlier in the same text) is removed; the first copy stays. Strings are
judged on the input and never cross texts.

For a suffix, the longest previous factor (LPF) is the longest prefix it shares with a suffix
that starts earlier. In suffix order that earlier suffix is the previous or the next one with a
smaller position, and the shared length is the least common prefix on the way there. A byte goes
if some suffix with an LPF of ``length`` or more covers it so.

A suffix array of the whole corpus does not fit one task, and need not: suffixes that share
``length`` bytes have the same anchor, the content-defined place with the smallest hash of a short
gram among those places where the gram lies inside the string (the last of equal ones). So:

1. Equal texts are one text: a later copy repeats the first from end to end.
2. Each text gives its anchors, one per some 35 bytes. Grams seen at one place only cannot lead to
   a repeat, and most are dropped here (places are summed per task before the shuffle).
3. Around each repeated anchor, the bytes of its strings are cut out. Strings with the same anchor
   gram go to one group, where suffixes are sorted, common prefixes of neighbours measured and
   previous and next smaller positions found. Groups are bounded: an anchor gram with more
   than ``group_limit`` places goes the other way: its cut-outs, then the strings of the first
   of equal ones, are put in one order by their bytes and places over all tasks, where whatever
   starts earlier stands next to what repeats it. That is the suffix order cut at ``length``, and
   having such a neighbour is having an LPF of ``length``; the two ways find the same strings.
4. Spans are merged per text and cut from it.

Edge cases: null and empty texts stay empty; texts shorter than ``length`` keep every byte; a text
that repeats itself (overlaps included) loses its later copies; rows that repeat an id stand in
the order of their texts, fully equal rows all count as the one first row; an empty table gives
an empty result; other columns are left behind.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm import words
from tillmark.llm.bitsets import SIZE, bit_table, hit
from tillmark.llm.frames import bounded, texts, whole_groups
from tillmark.llm.ordered import with_again
from tillmark.operators.ordering import with_row_number
from tillmark.session import cut_lineage

LENGTH = 100
GRAM = 32
GROUP_LIMIT = 4_000
_FACTOR = 0x9E3779B97F4A7C15


# Anchors ---------------------------------------------------------------------------------------


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on, by doubling their reach."""
    h = words.mixed(data.astype(np.uint64) + np.uint64(1))
    total, taken, reach, step = None, 0, 1, _FACTOR
    while reach <= gram:
        if gram & reach:
            count = len(h) - taken if total is None else min(len(total), len(h) - taken)
            part = h[taken : taken + count]
            total = part if total is None else total[:count] * np.uint64(step) + part
            taken += reach
        if 2 * reach <= gram:
            h = h[: len(h) - reach] * np.uint64(step) + h[reach:]
            h ^= h >> np.uint64(29)
        reach, step = 2 * reach, (step * _FACTOR + 2) % (1 << 64)
    return words.mixed(total[: len(data) - gram + 1])


_PLACES = np.uint64((1 << 20) - 1)


def _last_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest key (by its upper 44 bits) in each window of ``width`` places;
    the last such place if there are several."""
    upper = keys & ~_PLACES
    place = np.arange(len(keys))
    reach = 1
    if len(keys) <= int(_PLACES):
        packed = upper | (_PLACES - place.astype(np.uint64))
        while reach < width:
            step = min(reach, width - reach)
            packed = np.minimum(packed[step:], packed[: len(packed) - step])
            reach += step
        return (_PLACES - (packed & _PLACES)).astype(np.int64)
    while reach < width:
        step = min(reach, width - reach)
        n = len(upper) - step
        take = upper[step:] <= upper[:n]
        upper = np.where(take, upper[step:], upper[:n])
        place = np.where(take, place[step:], place[:n])
        reach += step
    return place


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """(hash, place, first start, last start) of each anchor: the strings that begin from first
    start to last start have their smallest gram at that place."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    keys = gram_hashes(np.frombuffer(data, np.uint8), gram)
    place = _last_least(keys, length - gram + 1)
    edge = np.flatnonzero(place[1:] != place[:-1]) + 1
    first = np.concatenate([[0], edge])
    last = np.concatenate([edge, [len(place)]]) - 1
    own = place[first]
    return keys[own], own, first, last


# place, first and last start of an anchor as one number: the starts lie just before the place.
_BITS = 14


def _packed(place, first, last):
    return (place << (2 * _BITS)) | ((place - first) << _BITS) | (place - last)


def _unpacked(at):
    mask = (1 << _BITS) - 1
    place = at >> (2 * _BITS)
    return place, place - ((at >> _BITS) & mask), place - (at & mask)


def all_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor, doc_id, at and ``sight``, which is equal for the same place of equal texts."""

    def convert(batches):
        for batch in batches:
            for part in bounded(batch):
                rows = part.column("text").cast(pa.binary()).to_pylist()
                found = [anchors(row, length, gram) for row in rows]
                counts = [len(f[0]) for f in found]
                at = np.concatenate([_packed(*f[1:]) for f in found])
                text = np.array(
                    [int.from_bytes(hashlib.blake2b(r, digest_size=8).digest()) for r in rows],
                    dtype=np.uint64,
                )
                sight = words.mixed(np.repeat(text, counts) + at.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([f[0] for f in found]).view(np.int64)),
                        pa.array(np.repeat(np.asarray(part.column("doc_id")), counts)),
                        pa.array(at),
                        pa.array(sight.view(np.int64)),
                    ],
                    names=["anchor", "doc_id", "at", "sight"],
                )

    return docs.mapInArrow(convert, "anchor long, doc_id long, at long, sight long")


# Longest previous factors ------------------------------------------------------------------------


def _nearest_smaller(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each entry, the least common prefix on the way back to the closest smaller value; 0 if
    there is none. ``common[i]`` belongs to entries i-1 and i. Pointers jump over larger values."""
    n = len(values)
    back = np.arange(-1, n - 1)
    shared = common.astype(np.int64).copy()
    if n:
        shared[0] = 0
    active = np.flatnonzero((back >= 0) & (shared > 0))
    active = active[values[back[active]] > values[active]]
    while len(active):
        # Follow the pointer of the entry pointed at: everything it skips is larger still.
        target = back[active]
        shared[active] = np.minimum(shared[active], shared[target])
        back[active] = back[target]
        go = (back[active] >= 0) & (shared[active] > 0)
        shared[active[back[active] < 0]] = 0
        active = active[go]
        active = active[values[back[active]] > values[active]]
    return shared


def longest_previous(suffixes: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """LPF of suffixes (rows of bytes, all of one length, so capped there) by corpus position."""
    n, width = suffixes.shape
    order = np.argsort(
        np.ascontiguousarray(suffixes).view(f"V{width}").ravel(), kind="stable"
    )
    common = np.zeros(n, dtype=np.int64)
    for at in range(1, n, 16_384):  # in pieces: the bytes of all suffixes are large
        end = min(n, at + 16_384)
        differs = suffixes[order[at:end]] != suffixes[order[at - 1 : end - 1]]
        common[at:end] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    places = positions[order]
    previous = _nearest_smaller(places, common)
    reversed_common = np.concatenate([[0], common[1:][::-1]])
    following = _nearest_smaller(places[::-1], reversed_common)[::-1]
    lpf = np.empty(n, dtype=np.int64)
    lpf[order] = np.maximum(previous, following)
    return lpf


def _strings(part_data: list[bytes], counts: np.ndarray, group: np.ndarray, length: int):
    """All strings of the cut-out bytes: (row, offset, matrix of bytes). The group's number leads
    each string, so that groups do not meet in the order."""
    row = np.repeat(np.arange(len(part_data)), counts)
    begins = np.cumsum(counts) - counts
    offset = np.arange(len(row)) - np.repeat(begins, counts)
    joined = np.frombuffer(b"".join(part_data), np.uint8)
    sizes = np.fromiter(map(len, part_data), np.int64, len(part_data))
    where = np.repeat(np.cumsum(sizes) - sizes, counts) + offset
    out = np.empty((len(row), length + 4), dtype=np.uint8)
    out[:, :4] = group[row].astype(">u4").view(np.uint8).reshape(-1, 4)
    out[:, 4:] = np.lib.stride_tricks.sliding_window_view(joined, length)[where]
    return row, offset, out


def _runs(doc_ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """Spans, with those joined that meet in one text."""
    order = np.lexsort((starts, doc_ids))
    docs, begins, reach = doc_ids[order], starts[order], ends[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (begins[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.maximum.reduceat(reach, first) if len(first) else reach
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[first]), pa.array(begins[first]), pa.array(last)],
        names=["doc_id", "start", "end"],
    )


def _grouped_spans(length: int, rows_at_once: int = 1500):
    """Spans of the strings in whole anchor groups that also start earlier.

    Of equal cut-outs in a group only the first is searched; the others repeat it throughout.
    """

    def convert(batches):
        for table, bounds in whole_groups(batches, ["anchor"]):
            group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            docs, begin = np.asarray(table["doc_id"]), np.asarray(table["begin"])
            # Equal suffixes then stand in order of their places, nearly all next to the smaller
            # place that decides.
            order = np.lexsort((begin, docs, group))
            docs, begin, group = docs[order], begin[order], group[order]
            data = table["data"].take(pa.array(order)).to_pylist()
            sizes = np.fromiter(map(len, data), np.int64, len(data))
            seen: set[bytes] = set()
            again = np.zeros(len(data), dtype=bool)
            for start, end in zip(bounds.tolist(), bounds[1:].tolist()):
                if end - start == 1:
                    continue
                seen.clear()
                for i in range(start, end):
                    if data[i] in seen:
                        again[i] = True
                    else:
                        seen.add(data[i])
            yield _runs(docs[again], begin[again], begin[again] + sizes[again])
            alone = np.bincount(group, ~again) < 2
            searched = np.flatnonzero(~again & ~alone[group])
            cells = group[searched]
            ends = np.flatnonzero(np.diff(cells)) + 1
            cuts, low = [0], 0
            for end in [*ends.tolist(), len(searched)]:
                if end - low >= rows_at_once or end == len(searched):
                    cuts.append(end)
                    low = end
            for low, high in zip(cuts, cuts[1:]):
                own = searched[low:high]
                if not len(own):
                    continue
                row, offset, strings = _strings(
                    [data[i] for i in own],
                    sizes[own] - length + 1,
                    group[own] - group[own[0]],
                    length,
                )
                row = own[row]
                starts = begin[row] + offset
                rank = np.empty(len(row), dtype=np.int64)
                rank[np.lexsort((starts, docs[row]))] = np.arange(len(row))
                found = longest_previous(strings, rank) >= length + 4
                yield _runs(docs[row][found], starts[found], starts[found] + length)

    return convert


def _single_strings(length: int):
    """Each string of the anchors with too many places: a hash of 128 bits and its start."""

    def convert(batches):
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            docs, begin = np.asarray(batch.column("doc_id")), np.asarray(batch.column("begin"))
            found = [np.frombuffer(data, np.uint8) for data in batch.column("data").to_pylist()]
            if not found:
                continue
            counts = np.array([len(data) - length + 1 for data in found])
            begins = np.cumsum(counts) - counts
            offset = np.arange(counts.sum()) - np.repeat(begins, counts)
            low = np.concatenate([gram_hashes(data, length) for data in found])
            high = np.concatenate([gram_hashes(data ^ np.uint8(0xA5), length) for data in found])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                    pa.array(np.repeat(docs, counts)),
                    pa.array(np.repeat(begin, counts) + offset),
                ],
                names=["low", "high", "doc_id", "start"],
            )

    return convert


# The operator --------------------------------------------------------------------------------------


_PIECES = "anchor long, doc_id long, begin long, data binary, many boolean"


def _pieces_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)],
        names=["anchor", "doc_id", "begin", "data", "many"],
    )


def _pieces_by_table(docs, repeated, firsts, length: int, gram: int) -> DataFrame:
    """Cut-outs around the anchors that hit the table of repeated ones, in one pass over the
    texts. A false hit is a group in which nothing repeats, or a copy that repeats its first."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (
            bit_table(repeated, "anchor"),
            bit_table(repeated.filter("many"), "anchor"),
            bit_table(firsts, "doc_id"),
        )
    )

    def convert(batches):
        wanted, many, first_ids = shared.value
        for batch in batches:
            for part in bounded(batch):
                part = part.filter(pa.array(hit(first_ids, np.asarray(part.column("doc_id")))))
                out = []
                texts_of = part.column("text").cast(pa.binary()).to_pylist()
                for doc, data in zip(part.column("doc_id").to_pylist(), texts_of):
                    keys, _, first, last = anchors(data, length, gram)
                    keys = keys.view(np.int64)
                    kept = np.flatnonzero(hit(wanted, keys))
                    for key, a, b, m in zip(
                        keys[kept].tolist(),
                        first[kept].tolist(),
                        last[kept].tolist(),
                        hit(many, keys[kept]).tolist(),
                    ):
                        out.append((key, doc, a, data[a : b + length], m))
                yield _pieces_batch(out)

    return docs.mapInArrow(convert, _PIECES)


def _pieces_by_join(docs, marks, repeated, copies, length: int) -> DataFrame:
    """The same by joins, for more repeated anchors than a table of fixed size can tell apart."""
    found = cut_lineage(
        marks.select("anchor", "doc_id", "at")
        .join(repeated, "anchor")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("at", "anchor", "many")).alias("found"))
        # Not an anti join, which would be moved below the one before, onto every anchor.
        .join(copies.withColumn("copy", F.lit(True)), "doc_id", "left")
        .filter("copy is null")
        .drop("copy")
    )

    def convert(batches):
        for batch in batches:
            for part in bounded(batch):
                out = []
                rows = part.column("text").cast(pa.binary()).to_pylist()
                for doc, data, own in zip(
                    part.column("doc_id").to_pylist(), rows, part.column("found").to_pylist()
                ):
                    for one in own:
                        _, a, b = _unpacked(one["at"])
                        out.append((one["anchor"], doc, a, data[a : b + length], one["many"]))
                yield _pieces_batch(out)

    return docs.join(found, "doc_id").mapInArrow(convert, _PIECES)


def _kept(length: int):
    """What remains of each text, and how much went."""

    def convert(batches):
        for batch in batches:
            for part in bounded(batch):
                rows = part.column("text").cast(pa.binary()).to_pylist()
                out = []
                for data, copy, spans in zip(
                    rows, part.column("copy").to_pylist(), part.column("spans").to_pylist()
                ):
                    whole = copy and len(data) >= length
                    pieces, at, gone = [], 0, []
                    for span in [(0, len(data))] if whole else sorted(
                        (s["start"], s["end"]) for s in spans or ()
                    ):
                        if gone and span[0] <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], span[1])
                        else:
                            gone.append([*span])
                    for start, end in gone:
                        pieces.append(data[at:start])
                        at = end
                    pieces.append(data[at:])
                    out.append((len(data), sum(e - s for s, e in gone), gone, b"".join(pieces)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([o[0] for o in out], pa.int64()),
                        pa.array([o[1] for o in out], pa.int64()),
                        pa.array(
                            [[{"start": s, "end": e} for s, e in o[2]] for o in out],
                            pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                        ),
                        pa.array([o[3] for o in out], pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "removed", "kept"],
                )

    return convert


def _spans(docs: DataFrame, ids: DataFrame, copies: DataFrame, options: dict) -> DataFrame:
    """doc_id, start, end of repeated strings; ``docs`` has one row per id, ``copies`` the ids
    whose text stands at a smaller id already."""
    length, gram = options["length"], options["gram"]
    marks = all_anchors(docs, length, gram)
    # A gram at one place of one text (copies of it aside) is in no repeat.
    repeated = cut_lineage(
        marks.groupBy("anchor")
        .agg(F.min("sight").alias("low"), F.max("sight").alias("high"), F.count("*").alias("n"))
        .filter("low <> high")
        .select("anchor", (F.col("n") > options["group_limit"]).alias("many"))
    )
    if repeated.count() <= options["table_anchors"]:
        firsts = ids.select("doc_id").join(copies, "doc_id", "left_anti")
        pieces = _pieces_by_table(docs, repeated, firsts, length, gram)
    else:
        pieces = _pieces_by_join(docs, marks, repeated, copies, length)
    few = (
        pieces.filter(~F.col("many"))
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_grouped_spans(length), "doc_id long, start long, end long")
    )
    if not repeated.filter("many").limit(1).count():
        return few
    # Equal cut-outs repeat the first one throughout; only first ones are taken apart. In the order
    # of their bytes and places, whatever repeats stands behind an equal one.
    hot = cut_lineage(
        pieces.filter("many").select(
            "anchor", F.md5("data").alias("digest"), "doc_id", "begin", "data"
        )
    )
    led = with_again(hot, ["anchor", "digest"], ["doc_id", "begin"])
    strings = (
        led.filter("not again")
        .select("doc_id", "begin", "data")
        # Equal cut-outs fill some tasks and leave few first ones there: these are dealt anew.
        .repartition("doc_id", "begin")
        .mapInArrow(_single_strings(length), "low long, high long, doc_id long, start long")
    )
    later = with_again(strings, ["low", "high"], ["doc_id", "start"]).filter("again")
    repeats = [
        later.select("doc_id", "start", (F.col("start") + length).alias("end")),
        led.filter("again").select(
            "doc_id",
            F.col("begin").alias("start"),
            (F.col("begin") + F.octet_length("data")).alias("end"),
        ),
    ]
    joined = reduce(DataFrame.unionByName, repeats).mapInArrow(
        _met, "doc_id long, start long, end long"
    )
    return few.unionByName(joined)


def _met(batches):
    """Spans, with those of a batch joined that meet in one text."""
    for batch in batches:
        yield _runs(*(np.asarray(batch.column(name)) for name in ("doc_id", "start", "end")))


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group_limit: int = GROUP_LIMIT,
    table_anchors: int = SIZE // 12,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, removed (spans of bytes) and the kept bytes.

    Up to ``table_anchors`` repeated anchors are looked up in a bit table, more by a join.

    Runs jobs while the frame is built. ``length`` may be up to some 16,000 bytes.
    """
    options = dict(
        length=length, gram=gram, group_limit=group_limit, table_anchors=table_anchors
    )
    given = texts(docs, key, text)
    digest = F.unhex(F.sha2("text", 256))
    ids = cut_lineage(given.select("doc_id", digest.alias("digest")))
    unclear = ids.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null")
    if not unclear.limit(1).count():
        return _without(given, ids, options)
    # Ids that are null or repeat do not name a text: number the distinct rows in their order.
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    numbered = cut_lineage(with_row_number(ids.distinct(), order, "number")).select(
        F.col("doc_id").alias("given_id"), F.col("digest").alias("given_digest"), "number"
    )
    same = F.col("doc_id").eqNullSafe(F.col("given_id")) & (F.col("digest") == F.col("given_digest"))
    work = (
        given.withColumn("digest", digest)
        .join(numbered, same)
        .dropDuplicates(["number"])
        .select(F.col("number").alias("doc_id"), "text")
    )
    own = ids.join(numbered, same).select(F.col("number"), "given_id")
    result = _without(
        work,
        numbered.select(F.col("number").alias("doc_id"), F.col("given_digest").alias("digest")),
        options,
    ).withColumnRenamed("doc_id", "number")
    return own.join(result, "number").drop("number").withColumnRenamed("given_id", "doc_id")


_RESULT = (
    "doc_id long, n_bytes long, n_removed long,"
    " removed array<struct<start:long,end:long>>, kept binary"
)


def _without(docs: DataFrame, ids: DataFrame, options: dict) -> DataFrame:
    first = ids.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    copies = cut_lineage(
        ids.join(first.filter("n > 1"), "digest").filter("doc_id <> first_id").select("doc_id")
    )
    removed = (
        _spans(docs, ids, copies, options)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    notes = cut_lineage(
        removed.join(copies.withColumn("copy", F.lit(True)), "doc_id", "full").select(
            "doc_id", F.coalesce("copy", F.lit(False)).alias("copy"), "spans"
        )
    )
    # Texts that surely lose nothing need no join; a bit table knows most of them.
    table = docs.sparkSession.sparkContext.broadcast(bit_table(notes, "doc_id"))

    def some(wanted: bool):
        def convert(batches):
            for batch in batches:
                for part in bounded(batch):
                    noted = hit(table.value, np.asarray(part.column("doc_id")))
                    yield part.filter(pa.array(noted == wanted))

        return docs.mapInArrow(convert, "doc_id long, text string")

    whole = some(False).select(
        "*", F.lit(False).alias("copy"), F.lit(None).cast(notes.schema["spans"].dataType).alias("spans")
    )
    changed = some(True).join(notes, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "spans"
    )
    return whole.unionByName(changed).mapInArrow(_kept(options["length"]), _RESULT)
