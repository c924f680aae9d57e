"""N-gram Jaccard join by parity sketches, and the groups of texts it links.

A text is its set of distinct word shingles. Shingles are dealt by hash into parts; each part
keeps the XOR of its shingles' hashes, a parity sketch in which equal shingles cancel. At most one
part differs for every shingle two sets do not share, so the number of differing parts is a lower
bound of their symmetric difference. Two sets at a Jaccard similarity of t or more differ in at
most D = (1-t)/(1+t) * (|A|+|B|) shingles; so among any D+1 parts one agrees (pigeonhole), and it is
enough to join sets on (size band, part, XOR). A set of size s only emits as many parts as its own
largest partner could make differ. Sizes are cut into bands, whose part counts both sides
share; a set also takes part in the next band if a partner of it can lie there.

An agreeing part may be empty on both sides, and empty parts are not joined on. The chance that all
agreeing parts of a linked pair are empty is computed for every band; small bands repeat the deal
with other seeds until it is below 2^-64, the same order as two shingles having one hash.

Work is kept linear in large groups of copies:

1. Equal sets are one class, found by a hash of the set; the smallest id stands for it.
2. Each set offers its few smallest keys. Sets that share one are verified against the smallest
   id offering it, one pair per set: this already connects most near copies.
3. Each set offers all its keys, with the group it is in by now. Only keys seen in two groups
   matter. On these, sets of different groups are compared by bit parity sketches (their Hamming
   distance too is a lower bound), in blocks of bounded size. A pair is named at the smallest key
   it shares, as far as the few smallest keys of both sets tell, and verified.
4. Before that, ``rounds`` can join more groups: where more than a few sets have a key, it names
   one of them, and each set is verified against some of the sets its keys name in other groups;
   groups that meet become one, and keys left with one group are dropped. Every round names others.
   It pays where the first keys leave many linked groups apart.

Verification intersects whole shingle sets. Links already implied by connection are not verified;
every pair of sets that is linked ends in one component.

Edge cases: null texts and texts without words have no shingles and are linked with nothing; a
text of fewer words than a shingle is one shingle; repeated rows join the same class; rows without
an id take part under a number from their text, above all ids (ids reach up to 2^62); texts of any
length are taken whole, one at a time; an empty table gives an empty result; columns other than key
and text are left behind.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm import words
from tillmark.llm.bitsets import bit_table, hit, with_ids, without_ids
from tillmark.llm.frames import bounded, free_name, texts, whole_groups
from tillmark.llm.graph import components
from tillmark.session import cut_lineage

SHINGLE = 5
PERCENT = 80
OFFERED = 8
BAND_RATIO = 1.7
BLOCK = 2000
ROUNDS = 0
CROWD = 64
LEAST = 16
# Ids from here on are kept for rows that have none.
UNNAMED = 1 << 62


# Shingle sets ------------------------------------------------------------------------------


@dataclass
class Sets:
    """Sets of a batch, one after the other: sorted distinct shingle hashes, and where each begins."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]

    def chosen(self, wanted: np.ndarray) -> Sets:
        sizes = self.sizes
        return Sets(self.hashes[np.repeat(wanted, sizes)], _edges(sizes[wanted]))


def _edges(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(batch: list[bytes], shingle: int = SHINGLE) -> Sets:
    """The sorted distinct shingle hashes of each text."""
    split = words.split(batch, words.SPACES)
    hashes = split.hashes()
    keys, places = words.runs(hashes, split.first, shingle)
    edges = np.searchsorted(places, split.first)
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        keys[start:end].sort()
    owner = np.repeat(np.arange(len(batch)), np.diff(edges))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[new], minlength=len(batch))
    keys = keys[new]
    counts = np.diff(split.first)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    whole = []
    for i in short.tolist():
        own = hashes[split.first[i] : split.first[i + 1]]
        one, _ = words.runs(own, np.array([0, len(own)]), len(own))
        whole.append(words.mixed(one + np.uint64(len(own)))[0])
    if whole:
        keys = np.insert(keys, _edges(sizes)[short], np.array(whole, np.uint64))
        sizes[short] = 1
    return Sets(keys, _edges(sizes))


def set_hashes(sets: Sets) -> np.ndarray:
    sums = np.concatenate(
        [[np.uint64(0)], np.cumsum(words.mixed(sets.hashes * np.uint64(0x9E3779B97F4A7C15)))]
    )
    total = sums[sets.first[1:]] - sums[sets.first[:-1]]
    return words.mixed(total + sets.sizes.astype(np.uint64)).view(np.int64)


# Size bands and parts -----------------------------------------------------------------------


def _missed(parts: int, low: int, most: int, keep: float) -> float:
    """The largest chance that every agreeing part of a linked pair is empty.

    ``most`` shingles at most differ, ``low`` is the least size of the larger set, ``keep`` the
    share of the union that is common at least.
    """
    worst, used = 0.0, np.zeros(parts + 1)
    used[0] = 1.0
    share = np.arange(parts + 1) / parts
    for differing in range(most + 1):
        if differing:
            grown = used * share
            grown[1:] += used[:-1] * (1 - share[:-1])
            used = grown
        common = max(ceil(keep * low), ceil(differing * keep / (1 - keep)))
        worst = max(worst, float((used * share**common).sum()))
    return worst


@lru_cache(maxsize=64)
def band(number: int, percent: int = PERCENT) -> tuple[int, int, int, int]:
    """(least size, least size of the next band, parts, repeats) of a size band."""
    low = 1
    for _ in range(number):
        low = max(low + 1, int(low * BAND_RATIO))
    high = max(low + 1, int(low * BAND_RATIO))
    most = _differ(2 * (high - 1), percent)
    if most > 400:
        return low, high, most + 1, 1
    best = None
    for times in (1, 2, 3, 4, 6, 8):
        parts = times * (most + 1)
        chance = _missed(parts, low, most, percent / 100)
        repeats = 1 if chance < 1e-300 else max(1, ceil(64 * log(2) / -log(chance))) if chance < 1 else 99
        if best is None or parts * repeats < best[0] * best[1]:
            best = (parts, repeats)
    return low, high, *best


def _differ(sizes: int, percent: int) -> int:
    """The most shingles two linked sets of these sizes together can differ in."""
    return (100 - percent) * sizes // (100 + percent)


@lru_cache(maxsize=100_000)
def bands_of(size: int, percent: int = PERCENT) -> list[int]:
    """The bands a set takes part in: its own and those of larger partners."""
    number, found = 0, []
    while band(number, percent)[0] * percent <= size * 100:
        if size < band(number, percent)[1]:
            found.append(number)
        number += 1
    return found


def keys_of(own: np.ndarray, number: int, percent: int = PERCENT) -> np.ndarray:
    """The join keys of one set in one band."""
    return band_keys(Sets(own, np.array([0, len(own)])), number, percent)[0]


def band_keys(sets: Sets, number: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The join keys of sets in one band, and the place of each one's set: their first parts'
    XORs, empty parts left out."""
    _, high, parts, repeats = band(number, percent)
    sizes = sets.sizes
    largest = sizes * 100 // percent
    # Parts are emitted in order, so the smaller set's are those both emit; its count must exceed
    # what its largest partner can differ in. Several deals per band scale with the parts.
    needed = _differ(sizes + largest, percent) + 1
    full = _differ(2 * (high - 1), percent) + 1
    # With fewer parts than 100, leaving some out would let the chance of empty ones grow too far.
    fewer = parts == full and repeats == 1 and parts >= 100
    emitted = np.minimum(parts, needed) if fewer else np.full(len(sizes), parts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values = words.mixed(sets.hashes)
    found, owners = [], []
    for repeat in range(repeats):
        # The first deal is by the upper bits of the hashes themselves, which are in order already.
        dealt = words.mixed(sets.hashes + np.uint64(repeat * 1_000_003)) if repeat else sets.hashes
        part = (((dealt >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        slot, own_values = owner * parts + part, values
        if repeat:
            order = np.argsort(slot, kind="stable")
            slot, own_values = slot[order], values[order]
        starts = np.flatnonzero(np.diff(slot, prepend=-1))
        whose, part = np.divmod(slot[starts], parts)
        place = part.astype(np.uint64) + np.uint64((number * 128 + repeat) << 32)
        xors = np.bitwise_xor.reduceat(own_values, starts) if len(starts) else own_values
        within = part < emitted[whose]
        found.append(words.mixed(xors + words.mixed(place))[within])
        owners.append(whose[within])
    return np.concatenate(found), np.concatenate(owners)


def _keys_by_band(sets: Sets):
    """(band, its sets' places, keys, each key's set among them) of the bands sets take part in."""
    sizes = sets.sizes
    taken = [bands_of(size) if size else () for size in sizes.tolist()]
    for number in sorted({n for own in taken for n in own}):
        wanted = np.fromiter((number in own for own in taken), bool, len(taken))
        yield np.flatnonzero(wanted), number, *band_keys(sets.chosen(wanted), number)


def bit_sketch(own: np.ndarray, number: int, percent: int = PERCENT) -> bytes:
    """One parity bit per cell: a bit is set if an odd number of shingles fall on it."""
    bits = 64
    while 4 * bits < 3 * band(number, percent)[1] and bits < 1 << 20:
        bits *= 2
    cells = (own % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(cells, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


# Passes over the texts ----------------------------------------------------------------------


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_hash and the few smallest keys of the set's own band."""

    def offered(sets: Sets) -> list[list[int]]:
        few = [[] for _ in sets.sizes]
        own_band = [bands_of(size)[0] if size else -1 for size in sets.sizes.tolist()]
        for rows, number, keys, owner in _keys_by_band(sets):
            order = np.argsort(owner, kind="stable")
            keys = keys[order]
            edges = _edges(np.bincount(owner, minlength=len(rows))).tolist()
            for i, start, end in zip(rows.tolist(), edges, edges[1:]):
                if own_band[i] == number:
                    few[i] = np.sort(keys[start:end])[:OFFERED].view(np.int64).tolist()
        return few

    def convert(batches):
        for batch in batches:
            for part in bounded(batch):
                sets = shingle_sets(part.column("text").cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sets.sizes, pa.int64()),
                        pa.array(set_hashes(sets)),
                        pa.array(offered(sets), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_hash", "offered"],
                )

    return docs.mapInArrow(
        convert, "doc_id long, n_shingles long, set_hash long, offered array<long>"
    )


def all_keys(docs: DataFrame, carried: str, skipped: bytes | None = None) -> DataFrame:
    """(key, carried) of every set; ``docs`` has doc_id, text and the long column ``carried``. With
    a bit table: no ids that hit ``skipped``."""
    shared = docs.sparkSession.sparkContext.broadcast(skipped)

    def convert(batches):
        special = shared.value
        for batch in batches:
            for part in bounded(batch):
                if special is not None:
                    part = part.filter(pa.array(~hit(special, np.asarray(part.column("doc_id")))))
                sets = shingle_sets(part.column("text").cast(pa.binary()).to_pylist())
                for rows, _, keys, owner in _keys_by_band(sets):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.view(np.int64)),
                            part.column(carried).take(pa.array(rows[owner])),
                        ],
                        names=["key", carried],
                    )

    return docs.mapInArrow(convert, f"key long, {carried} long")


def _hitting(docs: DataFrame, table: bytes, make, schema: str) -> DataFrame:
    """``make`` of the texts whose id hits the table."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def convert(batches):
        known = shared.value
        for batch in batches:
            for part in bounded(batch):
                kept = part.filter(pa.array(hit(known, np.asarray(part.column("doc_id")))))
                if kept.num_rows:
                    yield from make(kept)

    return docs.mapInArrow(convert, schema)


def _wanted(docs: DataFrame, ids: DataFrame, make, schema: str) -> DataFrame:
    """``make`` of the texts whose id is wanted. A bit table of fixed size spares the others the
    shuffle; the join afterwards is exact."""
    return _hitting(docs, bit_table(ids, "id"), make, schema).join(ids, "id", "left_semi")


def _full_sets(part: pa.RecordBatch):
    sets = shingle_sets(part.column("text").cast(pa.binary()).to_pylist())
    yield pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.ListArray.from_arrays(sets.first.astype(np.int32), pa.array(sets.hashes.view(np.int64))),
        ],
        names=["id", "shingles"],
    )


def _members(docs: DataFrame, table: bytes) -> DataFrame:
    """(id, band, size, sketch, keys, least) of the sets that have keys in the table, from one pass.
    ``least`` are the few smallest of the keys."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def convert(batches):
        known = shared.value
        for batch in batches:
            for part in bounded(batch):
                sets = shingle_sets(part.column("text").cast(pa.binary()).to_pylist())
                rows, ids = [], part.column("doc_id").to_pylist()
                for places, number, keys, owner in _keys_by_band(sets):
                    kept = hit(known, keys.view(np.int64))
                    keys, owner = keys.view(np.int64)[kept], owner[kept]
                    order = np.argsort(owner, kind="stable")
                    keys, owner = keys[order], owner[order]
                    starts = np.flatnonzero(np.diff(owner, prepend=-1))
                    for i, own_keys in zip(owner[starts], np.split(keys, starts[1:])):
                        place = places[i]
                        own = sets[place]
                        rows.append(
                            (
                                ids[place],
                                number,
                                len(own),
                                bit_sketch(own, number),
                                own_keys,
                                np.sort(own_keys)[:LEAST],
                            )
                        )
                if rows:
                    several = pa.list_(pa.int64())
                    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), several, several]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                        names=["id", "band", "size", "sketch", "keys", "least"],
                    )

    return docs.mapInArrow(
        convert,
        "id long, band int, size long, sketch binary, keys array<long>, least array<long>",
    )


def verified(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough, by full intersection."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _wanted(docs, ids, _full_sets, "id long, shingles array<long>")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("common", common)
        .filter(F.col("common") * 100 >= union * percent)
        .select("a", "b")
    )


# The join -----------------------------------------------------------------------------------


def _near(percent: int):
    """Pairs of different groups in one block (or two) of a key's sets that the sketches allow."""

    def compare(batches):
        for rows, bounds in whole_groups(batches, ["key", "low_block", "high_block"]):
            ids, groups = np.asarray(rows["id"]), np.asarray(rows["grouped"])
            sizes, side = np.asarray(rows["size"]), np.asarray(rows["block"])
            low, high = np.asarray(rows["low_block"]), np.asarray(rows["high_block"])
            sketches = rows["sketch"].to_pylist()
            keys, least_keys = np.asarray(rows["key"]), rows["least"].combine_chunks()
            offsets, values = np.asarray(least_keys.offsets), np.asarray(least_keys.values)
            a_out, b_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for start, end in zip(bounds, bounds[1:]):
                own = slice(start, end)
                if (groups[own] == groups[start]).all():
                    continue
                bits = np.frombuffer(b"".join(sketches[own]), np.uint64).reshape(end - start, -1)
                same = low[start] == high[start]
                ours = start + np.flatnonzero(side[own] == low[start])
                theirs = start + np.flatnonzero(side[own] == high[start])
                for i in ours:
                    other = theirs[groups[theirs] != groups[i]]
                    if same:
                        other = other[ids[other] > ids[i]]
                    both = sizes[other] + sizes[i]
                    least = np.minimum(sizes[other], sizes[i])
                    fits = least * 100 >= (both - least) * percent
                    other, both = other[fits], both[fits]
                    apart = np.bitwise_count(bits[other - start] ^ bits[i - start]).sum(
                        axis=1, dtype=np.int64
                    )
                    near = other[apart <= (100 - percent) * both // (100 + percent)]
                    # A pair is named at the smallest key it is seen to share, not at all of them.
                    mine = values[offsets[i] : offsets[i + 1]]
                    mine = mine[mine < keys[start]]
                    if len(near) and len(mine):
                        counts = offsets[near + 1] - offsets[near]
                        edges = _edges(counts)
                        at = np.arange(edges[-1]) + np.repeat(offsets[near] - edges[:-1], counts)
                        met = np.repeat(np.arange(len(near)), counts)[np.isin(values[at], mine)]
                        near = np.delete(near, met)
                    a_out.append(np.minimum(ids[near], ids[i]))
                    b_out.append(np.maximum(ids[near], ids[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))],
                names=["a", "b"],
            )

    return compare


def _shared_keys(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """The keys that sets of different groups have, and how many sets have each (``n``)."""
    # A set that leads its group is its own group, known without a join; the others (copies, and
    # members of groups) are looked up. A bit table tells most of them apart before any shuffle.
    others = docs.select("doc_id").join(
        placed.filter(F.col("grouped") == F.col("doc_id")), "doc_id", "left_anti"
    )
    special = bit_table(others, "doc_id")
    leading = all_keys(docs.withColumn("grouped", F.col("doc_id")), "grouped", special)
    passed = _hitting(docs, special, lambda part: [part], "doc_id long, text string")
    looked_up = all_keys(passed.join(placed, "doc_id"), "grouped")
    return cut_lineage(
        leading.unionByName(looked_up)
        .groupBy("key")
        .agg(F.min("grouped").alias("one"), F.max("grouped").alias("other"), F.count("*").alias("n"))
        .filter("one <> other")
        .select("key", "n")
    )


def _proposed(members: DataFrame, number: int, most: int = 4) -> DataFrame:
    """Pairs (a, b) that may join groups: each set with up to ``most`` sets of other groups.

    Every key names one of its sets, another one in each round; a set is paired with the sets that
    most of its keys name. The rows are as many as the keys of the sets, whatever their groups.
    """
    order = F.struct(F.xxhash64("id", "key", F.lit(number)), "id", "grouped")
    named = members.groupBy("key").agg(F.min(order).alias("named"))
    own = (
        members.join(named, "key")
        .filter(F.col("grouped") != F.col("named.grouped"))
        .groupBy("id", F.col("named.id").alias("other"))
        .agg(F.count("*").alias("keys"))
    )
    best = Window.partitionBy("id").orderBy(F.desc("keys"), "other")
    return (
        own.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= most)
        .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
        .distinct()
    )


def _placed(ids: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, grouped): the smallest id that links lead to, for every id."""
    return cut_lineage(
        ids.join(components(links), "id", "left").select(
            F.col("id").alias("doc_id"), F.coalesce("root", "id").alias("grouped")
        )
    )


def _still_split(members: DataFrame, placed: DataFrame) -> DataFrame:
    """The members with the groups they are in by now, without keys left with one group. On disk."""
    held = cut_lineage(
        members.drop("grouped").join(placed.withColumnRenamed("doc_id", "id"), "id")
    )
    split = (
        held.groupBy("key")
        .agg(F.min("grouped").alias("one"), F.max("grouped").alias("other"))
        .filter("one <> other")
        .select("key")
    )
    return held.join(split, "key")


def _candidates(members: DataFrame, sketches: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs of sets in different groups that share a key and pass the sketches."""
    # A key with many sets is compared block by block: a set meets every block of its key once.
    blocks = F.expr(f"cast(ceil(n / {block}) as int)")
    dealt = (
        members.join(sketches, ["id", "band"])
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low_block", F.least("block", "facing"))
        .withColumn("high_block", F.greatest("block", "facing"))
        .drop("blocks", "facing", "n")
    )
    return (
        dealt.repartition("key", "low_block", "high_block")
        .sortWithinPartitions("key", "low_block", "high_block")
        .mapInArrow(_near(percent), "a long, b long")
        .distinct()
    )


def link_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    block: int = BLOCK,
    rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id of every row.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id reachable
    by links; both are null where only rows without an id are reachable. Runs jobs while the frame
    is built.
    """
    linked = _linked(_named(docs, key, text), percent, block, rounds)
    ids = ["doc_id", "class_id", "component_id"]
    return linked.withColumns(
        {name: F.when(F.col(name) < UNNAMED, F.col(name)) for name in ids}
    )


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id and text; a row without an id gets one above all others, from its text."""
    return texts(docs, key, text).withColumn("doc_id", _number("doc_id", "text"))


def _number(key: str, text: str) -> Column:
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = F.xxhash64(content).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(UNNAMED)
    return F.coalesce(F.col(key).cast("long"), own)


def _linked(
    own: DataFrame, percent: int, block: int, rounds: int, crowd: int = CROWD
) -> DataFrame:
    """``link_groups`` of rows that all have ids."""
    known = cut_lineage(features(own))
    classes = cut_lineage(
        known.filter("n_shingles > 0")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("id"), F.min_by("offered", "doc_id").alias("offered"))
    )
    offers = classes.select("id", F.explode("offered").alias("key"))
    lowest = offers.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n"))
    stars = (
        offers.join(lowest.filter("n > 1").select("key", "a"), "key")
        .filter("a < id")
        .groupBy("id", "a")
        .agg(F.count("*").alias("shared"))
        .groupBy(F.col("id").alias("b"))
        .agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    )
    links = cut_lineage(verified(own, cut_lineage(stars), percent))
    ids = classes.select("id")
    placed = _placed(ids, links)
    split = _shared_keys(own, placed)
    held = cut_lineage(_members(own, bit_table(split, "key")).join(ids, "id", "left_semi"))
    members = cut_lineage(
        held.select("id", "band", F.explode("keys").alias("key"))
        .join(split, "key")
        .join(placed.withColumnRenamed("doc_id", "id"), "id")
    )
    left = members
    if rounds:
        crowded = members.filter(F.col("n") > crowd)
        for number in range(rounds):
            pairs = cut_lineage(_proposed(crowded, number))
            if pairs.isEmpty():
                break
            links = cut_lineage(links.unionByName(verified(own, pairs, percent)))
            crowded = _still_split(crowded, _placed(ids, links))
        few = members.filter(F.col("n") <= crowd)
        left = few.unionByName(crowded, allowMissingColumns=True)
    sketches = held.select("id", "band", "size", "sketch", "least")
    second = verified(own, cut_lineage(_candidates(left, sketches, percent, block)), percent)
    joined = components(links.unionByName(second))
    heads = classes.join(joined, "id", "left").select(
        "set_hash", F.col("id").alias("class_id"), F.coalesce("root", "id").alias("component_id")
    )
    return known.join(heads, "set_hash", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("n_shingles") > 0, F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the smallest id of each component, with their columns; of rows with the same id
    and text one. Rows without an id come after all others."""
    number = free_name(docs, "number")
    named = _named(docs, key, text)
    linked = _linked(named, PERCENT, BLOCK, ROUNDS)
    leads = F.col("doc_id") == F.col("component_id")
    by_id = cut_lineage(
        linked.groupBy("doc_id").agg(F.max(leads).alias("_kept"), F.count("*").alias("_n"))
    )
    marked = docs.withColumn(number, _number(key, text))
    gone = by_id.filter("not _kept").select(F.col("doc_id").alias(number))
    again = by_id.filter("_kept and _n > 1").select(F.col("doc_id").alias(number))
    single = without_ids(marked, number, gone.unionByName(again))
    several = with_ids(marked, number, again).dropDuplicates([number, text])
    return single.unionByName(several).drop(number)
