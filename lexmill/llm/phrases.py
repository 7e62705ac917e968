"""Phrases of words that stand together, mined from a sample and counted exactly in full passes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.llm.common import Scratch, map_rows, mix, shuffle_partitions, slices
from lexmill.session import stage

SHARE = 16  # one document in so many is in the sample
TOKENS = 1 << 19  # words that a task counts at a time
LEAST_BITS, MOST_BITS = 18, 26  # size of the filter of known phrases: 32 KB to 8 MB
BITS_EACH = 24  # bits of the filter for each known phrase, while it may grow
HASHED = "h long, g long, n long"
NAMED = f"{HASHED}, lang string, k int, phrase string"

# A-Z are lower-cased, `.,;:!?` and line ends part, space and tab separate words.
_BREAK = b"\xff"  # no byte of UTF-8
_TABLE = bytearray(range(256))
_TABLE[65:91] = bytes(range(97, 123))
for _b in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_b] = 0xFF
_TABLE = bytes(_TABLE)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, with a break where pieces part, and one at the end."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    return [*data.replace(_BREAK, b" \xff ").split(), _BREAK]


class PhraseFilter:
    """Bits of known phrases. A bit set by chance means that a phrase is counted for nothing, never that one is missed."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, len(bits) * 8

    def holds(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), dtype=bool)
        for at in positions(h, self.size):
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def positions(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter of ``size`` bits, a power of two."""
    mask = np.uint64(size - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _salts(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass")) for n in names], np.uint64)


def _counted(words: list[bytes], langs: np.ndarray, names: list[str], longest: int, now, before, unnamed, text: bool):
    """Record batches of the distinct phrases among ``words`` with their numbers.

    Without filters all count. With ``now`` a phrase counts if the filter knows all its parts. With ``before`` too, those that
    counted by that filter do not count again; here a part that counts for the first time is as good as known, so all
    phrases that can have become frequent count at once. What ``unnamed`` holds is spelled out, with the number 0. Phrases
    are told apart by exact numbers: that of the phrase without its last word, and that of the word;
    ``h`` and ``g`` are 128 bits of hash of language and words.
    """
    index = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, index), np.uint64, len(index))[ids]
    h = _salts(names)[langs]
    g = ~h
    rank = langs.astype(np.int64)
    live = ids != index[_BREAK]
    old = live.copy() if before is not None else None
    lang_names = pa.array(names, pa.string())

    def batch(one: np.ndarray, k: int, counts: np.ndarray) -> pa.RecordBatch:
        columns = {"h": pa.array(h[one].view(np.int64)), "g": pa.array(g[one].view(np.int64)),
                   "n": pa.array(counts.astype(np.int64))}
        if text:
            columns |= {"lang": lang_names.take(pa.array(langs[one])), "k": pa.array(np.full(len(one), k, np.int32)),
                        "phrase": pa.array([b" ".join(words[i:i + k]) for i in one.tolist()], pa.binary()).cast(pa.string())}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    if before is None and now is not None:
        # The words of each language, under its own hash and a mark that no phrase has.
        yield pa.RecordBatch.from_arrays(
            [pa.array(_salts(names).view(np.int64)), pa.array(np.zeros(len(names), np.int64)),
             pa.array(np.bincount(langs[live], minlength=len(names)).astype(np.int64))], names=["h", "g", "n"])
    for k in range(1, longest + 1):
        at = np.flatnonzero(live)
        if not len(at):
            return
        last = at + k - 1
        _, first, inverse, counts = np.unique(rank[at] * len(index) + ids[last], return_index=True,
                                              return_inverse=True, return_counts=True)
        rank[at] = inverse
        with np.errstate(over="ignore"):
            h[at] = mix(h[at] + hashes[last])
            g[at] = mix(g[at] * np.uint64(3) + hashes[last])
        one = at[first]
        if old is not None:
            named = one[unnamed.holds(h[one])]
            if len(named):
                yield batch(named, k, np.zeros(len(named), np.int64))
            counts, one = counts[~old[one]], one[~old[one]]
        if len(one):
            yield batch(one, k, counts)
        # The next phrase is live where that of k words here and that one word further are known.
        if old is not None:
            known = now.holds(h[at]) | ~old[at]
            was = np.flatnonzero(old)
            old[was] = before.holds(h[was])
            old[:-1] &= old[1:]
            live[at] = known
        elif now is not None:
            live[at] = now.holds(h[at])
        live[:-1] &= live[1:]


def _count(longest: int, now=None, before=None, unnamed=None, text: bool = True):
    def rows(batches):
        filters = [PhraseFilter(np.frombuffer(b.value, np.uint8)) if b else None for b in (now, before, unnamed)]
        words, langs, sizes, names = [], [], [], {}

        def flush():
            if words:
                yield from _counted(words, np.repeat(langs, sizes), list(names), longest, *filters, text)
            for held in (words, langs, sizes):
                held.clear()
            names.clear()

        for batch in slices(batches):
            for lang, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = tokens(found)
                words.extend(found)
                langs.append(names.setdefault(lang, len(names)))
                sizes.append(len(found))
                if len(words) >= TOKENS:
                    yield from flush()
        yield from flush()

    return rows


def _lang_hashes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_salts(batch.column(0).to_pylist()).view(np.int64))], names=["lang", "h"])


def _named_sums(rows: DataFrame) -> DataFrame:
    """Numbers of each phrase over all tasks, combined in each task before the shuffle."""
    return rows.groupBy("lang", "phrase", "k", "h", "g").agg(F.sum("n").alias("n"))


def filter_bits(phrases: DataFrame, bits: int) -> bytes:
    """The filter of ``phrases`` (column h): put together by Spark, at most 8 MB reach the driver."""
    mask = F.lit(bits - 1)
    places = phrases.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))
                                      ).alias("at")).select((F.col("at") + 1).alias("at"))
    parts = places.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros(max(bits // 8, 4096), dtype=np.uint8)
    for row in parts:
        at = (row["bucket"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out[:bits // 8].tobytes()


def phrase_counts(docs: DataFrame, min_count: int = 100, longest: int = 5, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang", share: int = SHARE
                  ) -> tuple[DataFrame, DataFrame, Scratch]:
    """((lang, phrase, k, n) of every phrase seen ``min_count`` times or more, (lang, n) of all words, tables to clear).

    After H. Toivonen, "Sampling large databases for association rules" (1996). One document in
    ``share`` is counted whole; what is frequent there at a lowered bound is the proposal. A full
    pass then counts, exactly, all words, the proposed phrases and their negative border: the
    phrases that are not proposed but whose two parts (without the first and without the last
    word) are. If some of the border is frequent the proposal was too small. Then a further pass counts all phrases
    that become possible by it, and, of any length, those whose parts are known to be frequent or are counted in this very
    pass. After it nothing is open: a frequent phrase that no pass counted would have a shortest frequent
    part that none counted, but that one's own parts are all counted and frequent. A phrase is counted whole in just one pass.

    Tasks know the proposal by a filter of bits, whose size follows the number of phrases up to
    8 MB; where it is fuller, more phrases are counted for nothing, and none less. The border is large and hardly
    ever frequent, so the full pass shuffles 128-bit hashes and sums in place of texts; the texts
    of the proposal are known from the sample, others are spelled out by the further pass.
    """
    scratch, spark = Scratch(docs.sparkSession), docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").alias("id"))
    texts = rows.select("lang", "text")
    drawn = rows.where(F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.xxhash64("text")),
                              F.lit(share)) == 0).select("lang", "text")
    expected = min_count / share
    lowered = max(2, math.floor(expected - 2 * math.sqrt(expected)))
    proposed = scratch.stage(_named_sums(map_rows(drawn, _count(longest), NAMED)).where(F.col("n") >= lowered), "proposed")
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * proposed.count()).bit_length()))
    first = spark.sparkContext.broadcast(filter_bits(proposed.where(F.col("k") < longest), bits))
    sums = map_rows(texts, _count(longest, first, text=False), HASHED).groupBy("h", "g").agg(F.sum("n").alias("n"))
    counted = scratch.stage(sums.where((F.col("n") >= min_count) | (F.col("g") == 0)), "counted")
    langs = map_rows(texts.select("lang").distinct(), _lang_hashes, "lang string, h long")
    totals = counted.where("g = 0").join(langs, "h").select("lang", "n")
    frequent = counted.where("g <> 0")
    named = frequent.join(proposed.drop("n"), ["h", "g"]).select("lang", "phrase", "k", "n")
    border = scratch.stage(frequent.join(proposed.select("h", "g"), ["h", "g"], "left_anti"), "border")
    if not border.isEmpty():
        known = spark.sparkContext.broadcast(filter_bits(frequent, bits))
        unnamed = spark.sparkContext.broadcast(filter_bits(border, bits))
        more = scratch.stage(_named_sums(map_rows(texts, _count(longest, known, first, unnamed), NAMED)).where(
            (F.col("n") >= min_count) | (F.col("n") == 0)), "expanded")
        spelled = border.join(more.where("n = 0").drop("n"), ["h", "g"]).select("lang", "phrase", "k", "n")
        named = named.unionByName(spelled).unionByName(more.where("n > 0").select("lang", "phrase", "k", "n"))
    return scratch.stage(named, "frequent"), totals, scratch


def cut_score(a: str, n: str, l: str, r: str) -> Column:
    """floor(1000 a n / (l r)), exact."""
    a, n, l, r = (F.col(c).cast("decimal(38,0)") for c in (a, n, l, r))
    return F.call_function("div", F.lit(1000).cast("decimal(38,0)") * a * n, l * r)


def _part(start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice("ws", start, n), " ")


def collocations(docs: DataFrame, min_count: int = 100, longest: int = 5, top: int = 2000, id_col: str = "doc_id",
                 text_col: str = "text", lang_col: str = "lang", share: int = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language whose words stand together most.

    ``a`` is the number of the phrase, ``l`` and ``r`` those of its two parts at the cut with the lowest
    ``floor(1000 a n / (l r))`` (the earliest of such cuts), ``n`` the words of the language. A phrase
    inside a longer one of the same number is dropped; it is enough to look one word further, as the
    numbers between cannot differ. Products are decimals of 38 digits, an overflow is an error.

    A null language is ``und``, a null text empty; repeated rows count each time, whatever their ids; ties
    are ordered by number and phrase, so ranks are unique; an empty table or one without a frequent phrase gives no row.
    A text must fit a task. The best of a language are ranked in steps, so no task ranks all of them.
    """
    frequent, totals, scratch = phrase_counts(docs, min_count, longest, id_col, text_col, lang_col, share)
    counts = frequent.select("lang", "phrase", "k", "n")
    longer = counts.where("k > 2").withColumn("ws", F.split("phrase", " "))
    covered = longer.select("lang", F.explode(F.array(_part(1, F.col("k") - 1), _part(2, F.col("k") - 1))).alias("phrase"),
                            F.col("n").alias("a")).distinct()
    kept = counts.where("k > 1").withColumnRenamed("n", "a").join(covered, ["lang", "phrase", "a"], "left_anti")
    cuts = kept.withColumn("ws", F.split("phrase", " ")).withColumn(
        "cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "a", "cut", _part(1, F.col("cut")).alias("left"),
        _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    cuts = cuts.join(totals, "lang")
    best = cuts.withColumn("score", cut_score("a", "n", "l", "r")).groupBy("lang", "phrase", "a", "n").agg(
        F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("x"))
    ranked = best.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score").withColumn(
        "deal", F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs))))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    step = math.isqrt(shuffle_partitions(docs))
    for deal in (F.col("deal"), F.pmod(F.col("deal"), F.lit(max(step, 1))), F.lit(0)):
        ranked = ranked.withColumn("rank", F.row_number().over(
            W.partitionBy("lang", deal).orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    out = stage(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    scratch.clear()
    return out
