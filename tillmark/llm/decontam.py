"""Benchmark decontamination by a prefix-filtered join on rare shingles.

An item's windows are its runs of ``window`` words (an item with fewer words is one window). A
window occurs in a document only if all its shingles do, so one necessary shingle, its prefix, is
enough to find it: the rarest one, by counts over all documents. A document shingle that equals a
window's prefix fixes the place where the window would begin; length and position bounds drop
places outside the document, and the words standing there are compared in full.

Documents are read once. Each task knows which shingles any item has from a bit table of fixed
size (more items mean more false hits, never a missed one), and keeps the places that hit it,
with the words around them. Everything after that is joins and sums over those hits.

Edge cases: null texts and texts without words have no words, are never hit and hit nothing; equal
items and equal windows count for each item id; repeated documents with the same id are one
document per row only if their rows differ, since rows are grouped by id and text hash; null ids are
equal to each other, so rows without an id have their own results, told apart by their texts, and
go by them like any other row; empty
tables give no items or no rows; other columns are left behind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm import words
from tillmark.llm.bitsets import without_ids
from tillmark.llm.frames import bounded, free_name, texts
from tillmark.session import cut_lineage

WINDOW = 13
SHINGLE = 5
TABLE_BITS = 23

_HIT = "struct<place:int,shingle:long,size:int,around:string,offset:int>"


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _items(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """One row per shingle of each distinct window: window_id, size (of the shingle), offset,
    shingle, length and text of the window."""

    def convert(batches):
        for batch in batches:
            rows = batch.column("text").cast(pa.binary()).to_pylist()
            split = words.split(rows, words.SYMBOLS)
            hashes = split.hashes()
            spelled = [
                bytes(split.buffer[a:b]).decode("utf-8", "replace")
                for a, b in zip(split.starts, split.ends)
            ]
            out = []
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = split.first[i], split.first[i + 1]
                length = min(window, b - a)
                size = min(shingle, length)
                for start in range(a, b - length + 1) if length else ():
                    own = hashes[start : start + length]
                    keys, places = words.runs(own, np.array([0, length]), size)
                    whole = " ".join(spelled[start : start + length])
                    for key, place in zip(keys.view(np.int64).tolist(), places.tolist()):
                        out.append((item, whole, int(length), int(size), place, key))
            columns = list(zip(*out)) if out else [()] * 6
            types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["item_id", "whole", "length", "size", "offset", "shingle"],
            )

    return items.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(
        convert,
        "item_id string, whole string, length int, size int, offset int, shingle long",
    )


def _bit_table(item_shingles: DataFrame) -> tuple[dict[int, bytes]]:
    """For each shingle size (at most SHINGLE of them) a bit table of fixed size, built on the
    executors in slices, so that what comes back is bounded however many items there are."""
    slot = F.expr(f"shiftrightunsigned(shingle, {64 - TABLE_BITS})")
    rows = (
        item_shingles.select("size", F.shiftright(slot, 6).alias("word"), (slot % 64).alias("bit"))
        .groupBy("size", "word")
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("bits"))
        .collect()
    )
    tables: dict[int, np.ndarray] = {}
    for size, word, bits in rows:
        own = tables.setdefault(size, np.zeros(1 << (TABLE_BITS - 6), dtype=np.int64))
        own[word] = bits
    return {size: own.tobytes() for size, own in tables.items()}


def _hits(docs: DataFrame, tables: dict[int, bytes], window: int) -> DataFrame:
    """Per document: n_words and its places that may start a shingle of an item."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def convert(batches):
        known = {size: np.frombuffer(own, np.uint8) for size, own in shared.value.items()}
        for batch in batches:
            for part in bounded(batch):
                rows = part.column("text").cast(pa.binary()).to_pylist()
                split = words.split(rows, words.SYMBOLS)
                hashes = split.hashes()
                owner = split.owner
                hits: list[list[dict]] = [[] for _ in rows]
                for size, table in known.items():
                    keys, places = words.runs(hashes, split.first, size)
                    slots = _bits(keys)
                    likely = np.flatnonzero((table[slots >> 3] >> (slots & 7)) & 1)
                    for key, place in zip(
                        keys[likely].view(np.int64).tolist(), places[likely].tolist()
                    ):
                        doc = owner[place]
                        low = max(split.first[doc], place - window + 1)
                        high = min(split.first[doc + 1], place + window)
                        near = b" ".join(
                            split.buffer[a:b].tobytes()
                            for a, b in zip(split.starts[low:high], split.ends[low:high])
                        )
                        hits[doc].append(
                            {
                                "place": int(place - split.first[doc]),
                                "shingle": key,
                                "size": size,
                                "around": near.decode("utf-8", "replace"),
                                "offset": int(place - low),
                            }
                        )
                kind = pa.list_(
                    pa.struct(
                        [
                            ("place", pa.int32()),
                            ("shingle", pa.int64()),
                            ("size", pa.int32()),
                            ("around", pa.string()),
                            ("offset", pa.int32()),
                        ]
                    )
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row"),
                        pa.array(np.diff(split.first), pa.int64()),
                        pa.array(hits, kind),
                    ],
                    names=["doc_id", "row", "n_words", "hits"],
                )

    return docs.withColumn("row", F.xxhash64("text")).mapInArrow(
        convert, f"doc_id long, row long, n_words long, hits array<{_HIT}>"
    )


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, row, n_words; matches: doc_id, row, start, length, whole, item_id).

    Reads the documents once, into a checkpoint of word counts and hits.
    """
    pieces = cut_lineage(_items(items, window, shingle))
    scanned = cut_lineage(_hits(texts(docs), _bit_table(pieces), window))
    hits = scanned.select("doc_id", "row", "n_words", F.explode("hits").alias("hit")).select(
        "doc_id", "row", "n_words", "hit.*"
    )
    # How often each shingle of an item occurs, in all documents.
    seen = hits.groupBy("size", "shingle").agg(F.count("*").alias("times"))
    order = Window.partitionBy("whole").orderBy("times", "shingle", "offset")
    windows = pieces.select("whole", "length", "size", "offset", "shingle").distinct()
    prefix = (
        windows.join(seen, ["size", "shingle"], "left")
        .withColumn("times", F.coalesce("times", F.lit(0)))
        .withColumn("rarity", F.row_number().over(order))
        # A window whose rarest shingle never occurs cannot occur.
        .filter((F.col("rarity") == 1) & (F.col("times") > 0))
        .select("whole", "length", "size", "shingle", F.col("offset").alias("inside"))
    )
    start = F.col("place") - F.col("inside")
    candidates = (
        hits.join(prefix, ["size", "shingle"])
        .withColumn("start", start)
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    )
    standing = F.array_join(
        F.slice(
            F.split("around", " "), F.col("offset") - F.col("inside") + 1, F.col("length")
        ),
        " ",
    )
    found = candidates.filter(standing == F.col("whole")).select(
        "doc_id", "row", "start", "length", "whole"
    )
    owners = pieces.select("whole", "item_id").distinct()
    return scanned.select("doc_id", "row", "n_words"), found.join(owners, "whole")


def _beside(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with what was found for their id and row; null ids are equal."""
    renamed = found.withColumnsRenamed({"doc_id": "_doc_id", "row": "_row"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("row") == F.col("_row"))
    return documents.join(renamed, same, "left").drop("_doc_id", "_row")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    share: int = 20,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``contaminated``: words are hit, and at least one in ``share`` of all words is.
    """
    return _judged(docs, items, window, shingle, share).drop("row")


def _judged(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: int = 20
) -> DataFrame:
    """The columns of ``contamination``, and row."""
    documents, matches = occurrences(docs, items, window, shingle)
    own = ["doc_id", "row"]
    spans = matches.select(*own, "start", (F.col("start") + F.col("length")).alias("end"))
    order = Window.partitionBy(*own).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(
        F.col("end") - F.greatest(F.col("start"), F.coalesce(F.col("reached"), F.lit(0))),
        F.lit(0),
    )
    hit = (
        spans.distinct()
        .withColumn("reached", reached)
        .groupBy(*own)
        .agg(F.sum(new).cast("long").alias("n_hit"))
    )
    named = (
        matches.select(*own, "item_id")
        .distinct()
        .groupBy(*own)
        .agg(F.sort_array(F.collect_list("item_id")).alias("found"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    found = F.coalesce("found", F.array().cast("array<string>"))
    return (
        documents.transform(_beside, hit)
        .transform(_beside, named)
        .select(
            "doc_id",
            "row",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(found).cast("long").alias("n_items"),
            F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
            ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        )
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of documents that are not contaminated, with their columns. Rows go by id and text."""
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    row = free_name(docs, "text_row")
    bad = cut_lineage(
        _judged(own, items).filter("contaminated").select(F.col("row").alias(row), F.col("doc_id").alias(key))
    )
    hashed = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return without_ids(docs.withColumn(row, hashed), row, bad).drop(row)
