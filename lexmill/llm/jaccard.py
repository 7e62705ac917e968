"""Near-duplicate documents by a grouped prefix join on word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.llm.common import Scratch, map_rows, mix, plain_words, release, shingle_hashes, slices, ship, word_hashes
from lexmill.llm.components import connected_components
from lexmill.session import stage

SKETCH_BITS = 20  # buckets in which words and shingles are counted; two tables of a megabyte go to each task
PART = 4096  # buckets in a row while counts are added up
ROUNDS = 1  # further leaders at a shingle before the remaining pairs are expanded
ID_BITS = 23  # bits of the filter that tells which documents a verification needs
SETS = "doc_id long, n long, s1 long, s2 long, p1 long, p2 long, prefix array<long>, spread binary"
_SHIFT = np.uint64(64 - SKETCH_BITS)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> _SHIFT).astype(np.int64)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Ordered distinct 64-bit shingle hashes of a whole text."""
    return np.unique(shingle_hashes(word_hashes(plain_words(text)), width))


def _counts(width: int):
    def rows(batches):
        total = np.zeros((2, 1 << SKETCH_BITS), dtype=np.int64)
        for batch in slices(batches):
            words = [word_hashes(plain_words(t)) for t in batch.column(1).to_pylist()]
            sets = [np.unique(shingle_hashes(w, width)) for w in words]
            for k, found in enumerate((words, sets)):
                if found:
                    total[k] += np.bincount(_bucket(np.concatenate(found)), minlength=total.shape[1])
        yield from _parts(total.reshape(-1), PART)
    return rows


def _parts(values: np.ndarray, size: int):
    """(part, counts): only what is filled goes out, so a task sends as much as it holds.

    A part is its values, in 32 bits where that is enough, or, where fewer than a third are not zero, their places and they.
    """
    found = []
    for k, part in enumerate(values.astype("<i8").reshape(-1, size)):
        at = np.flatnonzero(part)
        if 3 * len(at) >= size:
            small = part.min() >= 0 and part.max() < 1 << 32
            found.append((k, part.astype("<u4" if small else "<i8").tobytes()))
        elif len(at):
            found.append((k, np.uint16(len(at)).tobytes() + at.astype("<u2").tobytes() + part[at].tobytes()))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()),
                                          pa.array([b for _, b in found], pa.binary())], names=["part", "counts"])


def _whole(packed: bytes, size: int) -> np.ndarray:
    if len(packed) >= 4 * size:
        return np.frombuffer(packed, "<u4" if len(packed) == 4 * size else "<i8").astype(np.int64)
    n = int(np.frombuffer(packed[:2], "<u2")[0])
    out = np.zeros(size, dtype=np.int64)
    out[np.frombuffer(packed[2:2 + 2 * n], "<u2")] = np.frombuffer(packed[2 + 2 * n:], "<i8")
    return out


def _merge(size: int, combine):
    def rows(key, table):
        total = np.zeros(size, dtype=np.int64)
        for packed in table.column("counts"):
            total = combine(total, _whole(packed.as_py(), size))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})
    return rows


def _merged(parts: DataFrame, combine, part: int, size: int) -> np.ndarray:
    """Tables of the tasks put together, as one array of fixed size on the driver.

    In two steps, so no group holds more than about twice the square root of the number of tasks.
    """
    schema = "part int, counts binary"
    salted = parts.withColumn("salt", F.floor(F.sqrt(F.spark_partition_id())))
    some = salted.groupBy("part", "salt").applyInArrow(_merge(part, combine), schema)
    total = np.zeros(size, dtype=np.int64)
    for row in some.groupBy("part").applyInArrow(_merge(part, combine), schema).collect():
        found = np.frombuffer(row["counts"], "<i8")
        total[row["part"] * len(found):(row["part"] + 1) * len(found)] = found
    return total


def _tables(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For buckets of words: log2 of their count; for buckets of shingles: 0, or more if one in it is frequent.

    All documents are counted; each task adds up its own table.
    """
    ship(docs.sparkSession)
    total = _merged(map_rows(docs, _counts(width), "part int, counts binary"), np.add, PART,
                    2 << SKETCH_BITS)
    words, shingles = total.reshape(2, -1)
    mean = shingles.mean()
    excess = shingles - mean
    hot = excess > 6 * np.sqrt(mean) + 8
    return (np.log2(np.maximum(words, 1)).astype(np.float32),
            np.where(hot, 1 + np.log2(np.maximum(excess, 1)), 0).astype(np.uint8))


def ordered_set(text: str | None, width: int, words: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingle set of a text, by hash and from rare to frequent.

    A shingle is as frequent as its bucket says, if that stands out, or else as its words
    let expect. The order depends on the shingle and the tables alone.
    """
    w = word_hashes(plain_words(text))
    every = shingle_hashes(w, width)
    h, first = np.unique(every, return_index=True)
    expected = np.zeros(len(every), dtype=np.float32)
    weights = words[_bucket(w)]
    for j in range(len(w) - len(every) + 1 if len(every) else 0):
        expected += weights[j:j + len(every)]
    rank = hot[_bucket(h)].astype(np.int64) * 1000 + expected[first].astype(np.int64)
    return h, h[np.argsort(rank, kind="stable")]


def spread_of(h: np.ndarray) -> bytes:
    """How many hashes fall into each of 2^k equal ranges, about four to a range.

    Two sets have at most the sum of the smaller counts in common, which rules out most
    pairs that merely share a shingle.
    """
    bits = max(3, (len(h) // 4).bit_length())
    while True:
        counts = np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if counts.max(initial=0) < 256:
            return counts.astype(np.uint8).tobytes()
        bits += 1


def most_in_common(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    if len(x) > len(y):
        x, y = y, x
    return int(np.minimum(x, y.reshape(len(x), -1).sum(axis=1)).sum())


def _sets(width: int, percent: int, shared):
    def rows(batches):
        words, hot = shared.value
        for batch in slices(batches):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h, by_rank = ordered_set(text, width, words, hot)
                n = len(h)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                prefix = by_rank[:keep].view(np.int64)
                s, p = (xxhash.xxh3_128_digest(x.tobytes()) for x in (h, prefix))
                halves = [int.from_bytes(b, "little", signed=True) for b in (s[:8], s[8:], p[:8], p[8:])]
                out.append((doc, n, *halves, prefix, spread_of(h)))
            columns = list(zip(*out)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:6]], pa.array(columns[6], pa.list_(pa.int64())),
                 pa.array(columns[7], pa.binary())],
                names=["doc_id", "n", "s1", "s2", "p1", "p2", "prefix", "spread"])
    return rows


def _id_bit(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - ID_BITS)).astype(np.int64)


def _id_bits(batches):
    bits = np.zeros(1 << ID_BITS, dtype=np.uint8)
    for batch in batches:
        bits[_id_bit(np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))] = 1
    yield from _parts(np.packbits(bits).view("<i8"), PART)


def _set_rows(width: int, shared):
    """(id, text) to (id, set) for the ids whose bit is set."""
    def rows(batches):
        bits = np.unpackbits(shared.value)
        for batch in slices(batches):
            batch = batch.filter(pa.compute.is_valid(batch.column(0)))
            batch = batch.filter(pa.array(bits[_id_bit(batch.column(0).to_numpy())] == 1))
            sets = [shingle_set(t, width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])
    return rows


def _bounded(percent: int):
    """(a, b, na, nb, spreads) to (a, b, most, maybe): the greatest possible intersection, and whether it links."""
    def rows(batches):
        for batch in slices(batches, 5_000):
            a, b, na, nb = (batch.column(k).to_numpy() for k in range(4))
            most = np.fromiter(map(most_in_common, batch.column(4).to_pylist(), batch.column(5).to_pylist()),
                               np.int64, batch.num_rows)
            most = np.minimum(most, np.minimum(na, nb))
            union = na + nb - most
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(most), pa.array(union),
                 pa.array(100 * most >= percent * union)],
                names=["a", "b", "both", "union", "maybe"])
    return rows


def _overlap(batches):
    for batch in slices(batches):
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        both, one, other = [], [], []
        for a, b in pairs:
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both.append(len(np.intersect1d(x, y, assume_unique=True)))
            one.append(len(x))
            other.append(len(y))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in (both, one, other)]],
            names=["a", "b", "both", "na", "nb"])


def _verify(scratch: Scratch, pairs: DataFrame, docs: DataFrame, members: DataFrame, width: int, percent: int
            ) -> DataFrame:
    """(a, b) to (a, b, both, union, exact): counts from the whole texts, or bounds where these rule a link out.

    Sets are made only of documents that a remaining pair needs. Which ones these are is
    told by one bit per id in a filter of fixed size, so texts are read but not shuffled; a
    bit that several ids share costs a set that no pair asks for.
    """
    spark = docs.sparkSession
    own = members.select("rep", "n", "spread")
    sized = (pairs.join(own.toDF("b", "nb", "hb"), "b").join(own.toDF("a", "na", "ha"), "a")
             .select("a", "b", "na", "nb", "ha", "hb"))
    bounds = scratch.stage(map_rows(
        sized, _bounded(percent), "a long, b long, both long, union long, maybe boolean"), "bounds")
    release(spark)
    need = bounds.where("maybe").select("a", "b")
    bits = _merged(map_rows(need, _id_bits, "part int, counts binary"), np.bitwise_or, PART,
                   (1 << ID_BITS) // 64)
    shared = spark.sparkContext.broadcast(bits.astype("<i8").view(np.uint8))
    own_scratch = Scratch(spark)
    sets = own_scratch.stage(map_rows(docs, _set_rows(width, shared), "id long, shingles binary"), "shingles")
    with_b = need.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    full = with_b.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    counted = map_rows(full.select("a", "b", "sa", "sb"), _overlap, "a long, b long, both long, na long, nb long")
    exact = scratch.stage(counted.select("a", "b", "both", (F.col("na") + F.col("nb") - F.col("both")).alias("union"),
                                 F.lit(True).alias("exact")), "verified")
    own_scratch.clear()
    release(spark)
    return exact.unionByName(bounds.where("not maybe").select("a", "b", "both", "union", F.lit(False).alias("exact")))


def _shared(nx: Column, ny: Column, percent: int) -> Column:
    """How many shingles the prefixes of two linked sets share at least.

    So one that both share is not among the (this number less one) most frequent of either.
    """
    both = F.ceil(percent * (nx + ny) / (100 + percent) - 1e-9)
    return F.least(*[both + 1 - F.ceil(percent * n / 100 - 1e-9) for n in (nx, ny)])


def _open(scratch: Scratch, posts: DataFrame, members: DataFrame, links: DataFrame) -> DataFrame:
    """(t, rep, n, part, lead, place): the members, but for its leader, at each shingle whose members are not yet in
    one component."""
    parts = scratch.stage(connected_components(links), "parts")
    apart = (members.select("gid", "rep", "n").join(parts, members["rep"] == parts["node"], "left")
             .select("gid", "rep", "n", F.coalesce("component", "rep").alias("part")))
    range_of = apart.groupBy("gid").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    open_at = (posts.join(range_of, "gid").groupBy("t").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
               .where("lo < hi").select("t"))
    return scratch.stage(posts.join(open_at, "t").join(apart, "gid").where("rep <> lead").select(
        "t", "rep", "n", "part", "lead", "place"), "open")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row; documents link at a Jaccard similarity of ``percent`` or more.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the distinct runs
    of ``width`` words (of a shorter text: its words as one run), as 64-bit hashes. Null,
    empty and wordless texts have an empty set, link with nothing and are their own
    component. ``component_id`` is the smallest id reachable. Rows of one id are taken as
    one document; null ids stay unlinked; an empty table stays empty.

    Method: shingles are ordered from rare to frequent by counts of words and shingles over all documents, and
    two sets that link share one of the first ``n - ceil(percent n) + 1``. Documents with
    equal sets are one class, classes with equal prefix and size one group; only groups
    meet at a shingle. There, the smallest group leads: all members of the groups are
    verified against it, which is linear however large the group, and after it against
    ``ROUNDS`` more where not all are linked yet. A verification first
    bounds the intersection by counts per hash range, and only then reads the texts again
    of pairs that can link. Then only pairs in still
    different components remain that share a shingle, are of fitting size, and whose
    distances to the leader differ by no more than the threshold (Jaccard distance is a
    metric, so others cannot link), at shingles that are not too frequent in both for the
    number that linked prefixes share; these are expanded and verified too. No link is lost.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scratch = Scratch(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_tables(docs, width))
    sets = scratch.stage(map_rows(docs, _sets(width, percent, shared), SETS), "sets")
    full = sets.where("n > 0 and doc_id is not null")
    classes = scratch.stage(full.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.min("p1").alias("p1"),
                                                     F.min("p2").alias("p2")), "classes")
    named = classes.groupBy("p1", "p2", "n").agg(F.min("rep").alias("gid"))
    grouped = classes.join(named, ["p1", "p2", "n"]).select("gid", "rep")
    own = full.select(F.col("doc_id").alias("rep"), "n", "spread", "prefix")
    leads = F.col("gid") == F.col("rep")
    members = scratch.stage(grouped.join(own, "rep").withColumn("prefix", F.when(leads, F.col("prefix"))), "members")
    at = members.select("gid", F.explode("prefix").alias("t"))
    leaders = at.groupBy("t").agg(F.min("gid").alias("lead"), F.count("*").alias("many")).where("many > 1")
    alone = members.groupBy("gid").agg(F.count("*").alias("many")).where("many > 1").select(
        F.xxhash64("gid", F.lit("group")).alias("t"), "gid", F.col("gid").alias("lead"))
    # Place of a shingle in its group, from the most frequent of the shared ones; a prefix is one partition's row.
    place = F.row_number().over(W.partitionBy("gid").orderBy(F.desc("many"), "t"))
    posts = scratch.stage(at.join(leaders, "t").select("t", "gid", "lead", place.alias("place")).unionByName(
        alone.withColumn("place", F.lit(1 << 30))), "posts")
    release(docs.sparkSession)
    led = posts.select("lead", "gid").distinct()
    first = led.join(members.select("gid", "rep"), "gid").where("rep <> lead").select(
        F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    seen = _verify(scratch, first, docs, members, width, percent)
    linked = f"exact and 100 * both >= {percent} * union"
    links = seen.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))
    left = _open(scratch, posts, members, links)
    for _ in range(ROUNDS):
        # The next leader of a shingle is the member with the most links so far.
        ends = links.select(F.col("u").alias("rep")).unionByName(links.select(F.col("v").alias("rep")))
        degree = ends.groupBy("rep").agg(F.count("*").alias("degree"))
        best = (left.join(degree, "rep", "left").groupBy("t")
                .agg(F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "rep", "part", "n")).alias("l")))
        again = left.join(best, "t").where("rep <> l.rep and part <> l.part").where(
            100 * F.least("n", "l.n") >= percent * F.greatest("n", "l.n")).select(
            F.col("l.rep").alias("a"), F.col("rep").alias("b")).distinct()
        found = _verify(scratch, again, docs, members, width, percent)
        links = links.unionByName(found.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v")))
        left = _open(scratch, posts, members, links)
    # The distance to the leader: exact, or at least that of the greatest possible intersection.
    least = 1 - F.col("both") / F.col("union")
    far = seen.select(F.col("a").alias("lead"), F.col("b").alias("rep"), least.alias("d"),
                      F.when(F.col("exact"), least).otherwise(1.0).alias("e"))
    left = left.join(far, ["lead", "rep"]).select("t", "rep", "n", "part", "place", "d", "e")
    x, y = (left.select(*[F.col(c).alias(c + s) for c in left.columns]) for s in ("x", "y"))
    reach = 1 - percent / 100 + 1e-9
    fits = ((F.col("tx") == F.col("ty")) & (F.col("repx") < F.col("repy")) & (F.col("partx") != F.col("party"))
            & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
            & (F.col("dx") - F.col("ey") <= reach) & (F.col("dy") - F.col("ex") <= reach)
            & (F.least("placex", "placey") >= _shared(F.col("nx"), F.col("ny"), percent)))
    still = x.join(y, fits).select(F.col("repx").alias("a"), F.col("repy").alias("b")).distinct()
    more = _verify(scratch, still, docs, members, width, percent)
    both = links.unionByName(more.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v")))
    roots = scratch.stage(connected_components(both), "roots")
    named = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        "s1", "s2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = full.select("doc_id", "s1", "s2", "n").join(named, ["s1", "s2", "n"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    out = stage(out.unionByName(sets.where("n = 0 or doc_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))), "near-duplicates")
    scratch.clear()
    release(docs.sparkSession)
    return out
