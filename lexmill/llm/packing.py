"""Best-fit packing of documents into sequences by exact-complement hashing."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.llm.common import keyed, map_rows, shuffle_partitions, slices
from lexmill.llm.tokens import encoder
from lexmill.session import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def token_pieces(docs: DataFrame, tokenizer_json: str, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: ids of each whole text and ``end_id``, cut only where longer than ``capacity``.

    The first piece of a longer document takes the remainder, all others are full.
    A null or empty text is the end id alone. Repeated rows give repeated pieces;
    a null id stays null. ``ids`` (little-endian unsigned 32-bit) only with ``keep_ids``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def cut(batches):
        encode = encoder(shared.value).packed
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches):
            rows = []
            for doc, found in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids = found + end
                size = len(ids) // 4
                stop = size % capacity or min(capacity, size)
                start = 0
                for piece in range(-(-size // capacity)):
                    part = ids[4 * start:4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(part), part if keep_ids else None))
                    start, stop = stop, stop + capacity
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = map_rows(keyed(docs, doc_id=id_col, text=text_col), cut, PIECES)
    return rows if keep_ids else rows.drop("ids")


def _exact_fill(left: np.ndarray, first: int, gap: int) -> tuple[int, ...] | None:
    """Up to three available lengths that fill ``gap`` exactly, the largest first; None if there are none."""
    if gap == 0:
        return ()
    left[first] -= 1
    try:
        if left[gap] > 0:
            return (gap,)
        there = left > 0

        def pair(total: int, most: int) -> tuple[int, int] | None:
            # a >= b = total - a; the complement of each a is looked up by its length.
            low = (total + 1) // 2
            high = min(most, total - 1)
            if high < low:
                return None
            hit = there[low:high + 1] & there[total - high:total - low + 1][::-1]
            if total % 2 == 0 and left[total // 2] < 2:
                hit[0] = False
            at = np.flatnonzero(hit)
            return (low + int(at[-1]), total - low - int(at[-1])) if len(at) else None

        if found := pair(gap, gap - 1):
            return found
        for a in np.flatnonzero(there[:gap - 1])[::-1].tolist():
            if 3 * a < gap:
                break
            left[a] -= 1
            there[a] = left[a] > 0
            found = pair(gap - a, a)
            left[a] += 1
            there[a] = True
            if found:
                return (a, *found)
        return None
    finally:
        left[first] += 1


def plan_sequences(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) patterns that hold ``counts[length]`` pieces of each length.

    The largest open length comes first; single lengths, pairs and triples that fill
    its gap exactly are consumed as often as their counts allow. What has no exact
    complement is placed best-fit, longest first. The input is one number per length,
    so this is as small for a hundred terabytes as for a megabyte.
    """
    left = counts.astype(np.int64).copy()
    patterns: list[tuple[int, tuple[int, ...]]] = []
    for first in range(capacity, 0, -1):
        while left[first] > 0 and (fill := _exact_fill(left, first, capacity - first)) is not None:
            lengths = (first, *fill)
            used = {n: lengths.count(n) for n in lengths}
            times = int(min(left[n] // k for n, k in used.items()))
            for n, k in used.items():
                left[n] -= times * k
            patterns.append((times, lengths))
    open_by_gap: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    gaps = np.zeros(capacity + 1, dtype=bool)

    def put(times: int, lengths: tuple[int, ...]) -> None:
        gap = capacity - sum(lengths)
        open_by_gap.setdefault(gap, []).append((times, lengths))
        gaps[gap] = True

    for n in np.flatnonzero(left)[::-1].tolist():
        rest = int(left[n])
        while rest:
            fits = np.flatnonzero(gaps[n:])
            if len(fits) == 0:
                each = capacity // n
                if rest >= each:
                    put(rest // each, (n,) * each)
                if rest % each:
                    put(1, (n,) * (rest % each))
                break
            gap = n + int(fits[0])
            times, lengths = open_by_gap[gap].pop()
            gaps[gap] = bool(open_by_gap[gap])
            used = min(times, rest)
            if times > used:
                put(times - used, lengths)
            put(used, (*lengths, n))
            rest -= used
    patterns += [p for group in open_by_gap.values() for p in group]
    return patterns


def _slots(patterns: list[tuple[int, tuple[int, ...]]], capacity: int) -> tuple[np.ndarray, ...]:
    """For each slot of a pattern: key (length, first rank), first sequence, offset; ordered by key."""
    taken = np.zeros(capacity + 1, dtype=np.int64)
    rows, base = [], 0
    for times, lengths in patterns:
        offset = 0
        for n in lengths:
            rows.append(((n << 44) + int(taken[n]), int(taken[n]), base, offset))
            taken[n] += times
            offset += n
        base += times
    rows.sort()
    return tuple(np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))


def ranked(pieces: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0) among the pieces of the same length.

    A length may hold a third of all pieces, so it is numbered in hash buckets; the
    counts of the buckets before are added. Two pieces never get the same rank.
    """
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                                   F.lit(shuffle_partitions(pieces))))
    counts = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (bucketed.withColumn("_row", F.row_number().over(inside))
            .join(offsets, ["length", "_bucket"])
            .withColumn("rank", F.col("_before") + F.col("_row") - 1)
            .drop("_bucket", "_before", "_row"))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, length, ids_crc32, ...).

    Only the number of pieces of each length reaches the driver (at most ``capacity``
    numbers). Pieces are matched to the planned places by their rank among equal
    lengths. Ties may go to any of the equal places. An empty table stays empty.
    """
    pieces = stage(pieces, "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    keys, firsts, bases, offsets = _slots(plan_sequences(counts, capacity), capacity)
    names = [*pieces.columns, "sequence_id", "offset"]
    schema = pieces.limit(0).withColumns({"sequence_id": F.lit(0).cast("long"),
                                          "offset": F.lit(0).cast("long")}).schema

    def place(batches):
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bases[at] + rank - firsts[at]), pa.array(offsets[at])], names=names)

    return map_rows(ranked(pieces), place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed ids; a sequence holds at most its capacity, so groups are bounded.

    Needs pieces with ``ids`` (``keep_ids=True``).
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_p")).select(
        "sequence_id", F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.col("_p.doc_id").alias("doc_ids"))
