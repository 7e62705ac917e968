"""Substring deduplication by content-defined chunks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.llm.common import map_rows, slices

# A gear table from a seeded generator: one 16-bit number for each byte value.
GEAR = np.random.default_rng(1909).integers(0, 1 << 16, 256, dtype=np.uint16)
BITS = 4  # a position is a candidate cut if so many upper bits of the rolling hash are zero
LEAST = 12  # a candidate cut counts if the one before is at least so many bytes away
LONG = 96  # longer chunks are searched for periodic stretches, where the hash finds no cut
PERIOD = 64  # longest period looked for; bytes of a needle and of a step are half of it
WORD = 16  # so many bytes of a chunk count as one word at least, for scripts without blanks
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The rolling gear hash ``h = 2 h + GEAR[byte]`` (16 bit) at every position.

    Sixteen shifts push a byte out, so the hash is a sum over the last sixteen bytes;
    four doubling steps add them up for all positions at once.
    """
    h = GEAR[data]
    for s in (1, 2, 4, 8):
        more = h.copy()
        more[s:] += h[:-s] << np.uint16(s)
        h = more
    return h


def chunks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks; both depend on nearby bytes only, so insertions elsewhere shift nothing."""
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = gear_hash(np.frombuffer(data, np.uint8))
    cuts = np.flatnonzero(h >> np.uint16(16 - BITS) == 0) + 1
    cuts = cuts[np.diff(cuts, prepend=-LEAST) >= LEAST]
    bounds = np.concatenate([[0], cuts[cuts < len(data)], [len(data)]])
    long = np.flatnonzero(np.diff(bounds) > LONG)
    more = [c for k in long.tolist() for c in _periodic_cuts(data, int(bounds[k]), int(bounds[k + 1]))]
    if more:
        bounds = np.unique(np.concatenate([bounds, more]))
    return bounds[:-1], bounds[1:]


def _periodic_cuts(data: bytes, start: int, end: int) -> list[int]:
    """Cuts inside a chunk at the ends of its periodic stretches and every few periods within.

    They lie where the smallest rotation of the period begins, so they hang on the stretch
    alone: two documents with the same stretch have the same chunks, whatever stands around
    it and however often it repeats.
    """
    cuts, pos, half = [], start, PERIOD // 2
    while pos + half < end:
        again = data.find(data[pos:pos + half], pos + 1, min(end, pos + PERIOD + half))
        if again < 0:
            pos += half
            continue
        period = again - pos
        first, after, width = pos, again + half, half
        while first > max(start, pos - half) and data[first - 1] == data[first - 1 + period]:
            first -= 1
        while after < end:  # ever longer pieces, so a stretch costs its length
            raw = np.frombuffer(data, np.uint8, min(end, after + width) - after + period, after - period)
            breaks = np.flatnonzero(raw[period:] != raw[:-period])
            after += int(breaks[0]) if len(breaks) else len(raw) - period
            if len(breaks):
                break
            width *= 2
        unit = data[first:first + period]
        turn = min(range(period), key=lambda r: unit[r:] + unit[:r])
        cuts += range(first + turn, after, period * -(-half // period))
        cuts.append(after)
        pos = max(after, pos + half)
    return [c for c in cuts if start < c < end]


def _group_rows(min_words: int):
    """(id, text, text id) to one row per group: 96-bit digest, ids, first character and word, those after its last.

    A group starts at each chunk and ends with the first one that completes ``min_words``
    words; a word whose middle is at the start counts, so a group hangs on its own bytes.
    A chunk has as many words as begin in it, at least one for each ``WORD`` bytes.
    """

    def rows(batches):
        for batch in slices(batches):
            parts = []
            for doc, text, text_id in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if doc is None or not text:
                    continue
                data = text.encode("utf-8", "surrogatepass")
                raw = np.frombuffer(data, np.uint8)
                starts, ends = chunks(data)
                blank = _SPACE[raw]
                begins = ~blank & np.concatenate([[True], blank[:-1]])
                word = np.concatenate([[0], np.cumsum(begins)])
                words = np.maximum(word[ends] - word[starts], (ends - starts) // WORD)
                upto = np.cumsum(words)
                needed = upto - words + min_words - (~blank & ~begins)[starts]
                last = np.maximum(np.searchsorted(upto, needed), np.arange(len(starts)))
                full = last < len(ends)
                word, word_end = (upto - words)[full], upto[last[full]]
                starts, ends = starts[full], ends[last[full]]
                view = memoryview(data)
                digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a:b])
                                                 for a, b in zip(starts.tolist(), ends.tolist())]),
                                       np.dtype([("low", "<i8"), ("high", "<i4"), ("rest", "<i4")]))
                # Characters begin at bytes that are no UTF-8 continuation.
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                parts.append((digest["low"], digest["high"], np.full(len(starts), doc, np.int64),
                              np.full(len(starts), text_id, np.int64),
                              *(x.astype(np.int32) for x in (chars[starts], chars[ends], word, word_end))))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*parts)],
                    names=["digest", "more", "doc_id", "text_id", "start", "end", "word", "word_end"])

    return rows


def repeated_spans(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_id, start, length, words, kept_doc_ids): passages that earlier documents hold too.

    A group of adjacent chunks with ``min_words`` words is repeated if one document with a
    smaller id has a group of the same digest, so no passage is pieced together from chunks
    of several documents. Repeated groups that touch or overlap make a passage, reported
    if at least ``min_words`` words begin in it: the whole chunks inside a repeated passage
    of fifty words hold that many even though its ends fall into chunks that differ.
    ``start`` and ``length`` count characters. Each group stays in the smallest document
    that has it; ``kept_doc_ids`` lists these for the groups of the passage.

    Words are counted by blanks; a chunk counts one for each 16 bytes at least, so texts
    without blanks have passages too. Digests have 96 bits: among 5x10^12 groups (100 TB) the
    chance of a false match is about 10^-4. The chunks are computed twice, as a table of them
    would take more disk than the input; digests are counted with partial aggregates, and the join back is one that adaptive
    execution can split, so a line in a third of all documents is no hot spot; texts are
    not shuffled. Documents with null ids and null or empty texts have no passage; rows of
    one id are one document, so copies under the same id stay, but each different text has
    passages of its own under its digest ``text_id``; an empty table gives none.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn(
        "text_id", F.xxhash64("text"))
    found = map_rows(rows, _group_rows(min_words), "digest long, more int, doc_id long, text_id long, start int, end int, "
                                                  "word int, word_end int")
    ids = found.groupBy("digest", "more").agg(F.min("doc_id").alias("kept_doc_id"), F.max("doc_id").alias("_last"))
    repeated = found.join(ids.where("kept_doc_id < _last").drop("_last"), ["digest", "more"]).where("doc_id > kept_doc_id")
    # A text that stands twice under its id gives each group twice.
    repeated = repeated.dropDuplicates(["doc_id", "text_id", "start"])
    order = W.partitionBy("doc_id", "text_id").orderBy("start")
    fresh = (F.col("start") > F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))).cast("int")
    runs = repeated.drop("digest", "more").withColumn("_fresh", fresh).withColumn(
        "_run", F.sum("_fresh").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return (runs.groupBy("doc_id", "text_id", "_run")
            .agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"),
                 (F.max("word_end") - F.min("word")).alias("words"),
                 F.array_sort(F.collect_set("kept_doc_id")).alias("kept_doc_ids"))
            .where(F.col("words") >= min_words).drop("_run"))


def cut_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans taken out of their texts; rows without a span are as before, none is dropped.

    A text has its spans in one list, which is no longer than the text. Columns of ``docs``
    may have any names.
    """
    id_, text_id, cuts = (f"_{name}_{'_'.join(docs.columns)}" for name in ("id", "text_id", "cuts"))
    lists = spans.groupBy(F.col("doc_id").alias(id_), F.col("text_id").alias(text_id)).agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias(cuts))
    text, key, spans_of = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long"), F.col(f"`{cuts}`")
    # What lies between the spans: from the end of each to the start of the next.
    begins = F.concat(F.array(F.lit(0)), F.transform(spans_of, lambda s: s["start"] + s["length"]))
    ends = F.concat(spans_of.getField("start"), F.array(F.length(text)))
    left = F.array_join(F.zip_with(begins, ends, lambda a, b: F.substring(text, a + 1, b - a)), "")
    joined = docs.join(lists, (key == F.col(f"`{id_}`")) & (F.xxhash64(text) == F.col(f"`{text_id}`")), "left")
    return joined.withColumn(text_col, F.when(spans_of.isNull(), text).otherwise(left)).drop(id_, text_id, cuts)
