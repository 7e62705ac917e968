"""Groups of spelling variants: near words found by search schemes over bidirectional FM-indexes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Scratch, ship
from lexmill.session import stage

LEAST = 7  # code points of the shortest word
BLOCK = 8_192  # words in an index: the tables of ranks of one block stay within some 100 MB
AT_ONCE = 8_192  # queries that a task extends together
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, slip: int = 31, least: int = LEAST, min_count: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``least`` code points that all texts hold ``min_count`` times or more.

    A word is a run of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased; where ``slip`` divides the
    crc32 of id and word, the code point at crc32 modulo length is left out. Null texts have no words, a null id
    counts as an empty one, repeated rows count each time.
    """
    runs = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("w")
                        ).select("id", F.translate("w", UPPER, LOWER).alias("w"))
    h = F.crc32(F.concat("id", F.lit(":"), "w"))
    at = F.pmod(h, F.length("w").cast("long")).cast("int")
    cut = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    return (words.select(F.when(F.pmod(h, F.lit(slip)) == 0, cut).otherwise(F.col("w")).alias("word"))
            .where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


class Rotations:
    """Ranks over the sorted rotations of a circular text: one direction of the index."""

    def __init__(self, text: np.ndarray, letters: int):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        while True:  # prefix doubling
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            step *= 2
            if rank[order[-1]] == n - 1:
                break
        before = text[order - 1]
        seen = np.zeros((n + 1, letters), dtype=np.int32)
        seen[np.arange(1, n + 1), before] = 1
        self.seen = np.cumsum(seen, axis=0, dtype=np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=letters))[:-1]])

    def grow(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each interval and letter: its start here, its size, and how many letters before it are smaller."""
        a = self.seen[low]
        sizes = self.seen[low + size] - a
        return self.first + a, sizes, np.cumsum(sizes, axis=1) - sizes


class WordIndex:
    """Bidirectional FM-index of a sorted list of distinct words, each between delimiters.

    The letters are 0 for the seam of the circular text, 1 for the delimiter, and the code points that occur, in order.
    Rotations that begin with a delimiter are sorted as the words are, so an interval of
    a whole delimited word names the word.
    """

    def __init__(self, words: list[str]):
        joined = "\x01".join(["", *words, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(points)
        self.letters = len(self.alphabet) + 1
        text = np.concatenate([[0], np.searchsorted(self.alphabet, points) + 1])
        self.left, self.right = Rotations(text, self.letters), Rotations(text[::-1], self.letters)
        self.size = len(text)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Delimited words as rows of letters, and their lengths; a letter that the index lacks is its number of letters."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        at = np.searchsorted(self.alphabet, flat)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == flat
        out = np.ones((len(words), int(sizes.max(initial=0)) + 2), dtype=np.int64)
        row = np.repeat(np.arange(len(words)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1] = np.where(
            known, at + 1, self.letters)
        return out, sizes

    def near(self, words: list[str], change: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word of the index) where they differ by one code point in the half that is extended.

        ``change`` says which: 1 inserted, -1 deleted, 0 replaced. With ``forward`` the first half
        matches exactly and the second is extended to the right; otherwise the second half matches and the first
        is extended to the left. Each step extends all open intervals of all queries by one letter;
        the interval in the other direction follows from the number of smaller letters.
        """
        rows, sizes = self.codes(words)
        if not forward:
            # Read from the end: the pattern's letters in the order in which they are matched.
            k = np.arange(rows.shape[1])
            rows = np.take_along_axis(rows, np.where(k <= sizes[:, None] + 1, sizes[:, None] + 1 - k, k), axis=1)
        ranks = self.right if forward else self.left
        exact = 1 + (sizes // 2 if forward else sizes - sizes // 2)  # letters that match, with the delimiter
        q = np.arange(len(words))
        t, low, other, size = (np.zeros(len(words), np.int64), np.zeros(len(words), np.int64),
                               np.zeros(len(words), np.int64), np.full(len(words), self.size, np.int64))
        done = np.zeros(len(words), dtype=bool)  # whether the change has been made
        found = []
        while len(q):
            start, grown, smaller = ranks.grow(low, size)
            want = rows[q, t]
            here = np.arange(len(q))
            fits = np.minimum(want, self.letters - 1)
            n = np.where(want < self.letters, grown[here, fits], 0)
            go = n > 0
            steps = [(q[go], t[go] + 1, start[here, fits][go], (other + smaller[here, fits])[go], n[go], done[go])]
            free = ~done & (t >= exact[q])
            # Deleted: the pattern's letter is passed over.
            pick = np.flatnonzero(free & (change[q] == -1) & (t <= sizes[q]))
            steps.append((q[pick], t[pick] + 1, low[pick], other[pick], size[pick], np.ones(len(pick), bool)))
            # Replaced or inserted: any letter that occurs there.
            pick = np.flatnonzero(free & ((change[q] == 1) | ((change[q] == 0) & (t <= sizes[q]))))
            i, c = np.nonzero(grown[pick, 2:])
            i, c = pick[i], c + 2
            put = change[q[i]] == 1
            differs = put | (c != want[i])
            i, c, put = i[differs], c[differs], put[differs]
            steps.append((q[i], t[i] + np.where(put, 0, 1), start[i, c], other[i] + smaller[i, c], grown[i, c],
                          np.ones(len(i), bool)))
            q, t, low, other, size, done = (np.concatenate(x) for x in zip(*steps))
            whole = t == sizes[q] + 2
            hit = whole & done
            # Low is a rank in the direction of the search; the rank among the words is that of the other one.
            found.append((q[hit], (other if forward else low)[hit] - 2))
            q, t, low, other, size, done = (x[~whole] for x in (q, t, low, other, size, done))
        pairs = np.unique(np.concatenate([np.stack(x, axis=1) for x in found]), axis=0) if found else np.zeros((0, 2), int)
        return pairs[:, 0], pairs[:, 1]


def _search(side: str):
    """Rows of one shard, (word, n, change) with no change for the words of the index, to (word, near, near_n)."""
    forward = side == "first"

    def rows(table: pa.Table) -> pa.Table:
        change = table.column("change")
        own = table.filter(pa.compute.is_null(change)).group_by("word").aggregate([("n", "max")])
        asked = table.filter(pa.compute.is_valid(change)).group_by(["word", "change"]).aggregate([])
        out = [([], [], [])]
        if own.num_rows and asked.num_rows:
            names = own.column("word").to_pylist()
            order = sorted(range(len(names)), key=names.__getitem__)
            names = [names[k] for k in order]
            counts = own.column("n_max").to_numpy()[order]
            index = WordIndex(names)
            for at in range(0, asked.num_rows, AT_ONCE):
                part = asked.slice(at, AT_ONCE)
                queries = part.column("word").to_pylist()
                q, w = index.near(queries, part.column("change").to_numpy().astype(np.int64), forward)
                out.append(([queries[k] for k in q.tolist()], [names[k] for k in w.tolist()], counts[w].tolist()))
        columns = [sum((list(x[k]) for x in out), []) for k in range(3)]
        return pa.table({"word": pa.array(columns[0], pa.string()), "near": pa.array(columns[1], pa.string()),
                         "near_n": pa.array(columns[2], pa.int64())})

    return rows


def _half(word: Column, length: Column, side: str) -> Column:
    """What a word of ``length`` shares with each near word whose change is in the other half, as far as all agree."""
    n = F.floor((length - 1) / 2).cast("int")
    return F.substring(word, F.lit(1), n) if side == "first" else F.right(word, n)


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n), both ways, for all words that differ by one inserted, deleted or replaced code point.

    Of two near words one half is equal. So words are dealt, once for each half, by their length and the half's
    letters: a word is indexed where it belongs, and asks where a near word of the same length, one
    shorter or one longer belongs. Keys are packed into shards of about ``block`` words, one FM-index
    each; a key with more words is dealt over several blocks, which its queries visit all.
    """
    spark, scratch = words.sparkSession, Scratch(words.sparkSession)
    ship(spark)
    words = scratch.stage(words, "words")
    shards = 1 + words.count() // block
    size = F.length("word")
    found = None
    for side in ("first", "second"):
        own = words.withColumn("change", F.lit(None).cast("int")).withColumn("size", size)
        asked = words.withColumn("change", F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)]))).withColumn(
            "size", size + F.col("change"))
        key = [F.col("size"), _half(F.col("word"), F.col("size"), side).alias("half")]
        own, asked = own.select("word", "n", "change", *key), asked.select("word", "n", "change", *key)
        often = own.groupBy("size", "half").agg(F.count("*").alias("many"))
        blocks = often.select("size", "half", F.ceil(F.col("many") / block).cast("int").alias("blocks"))
        # Keys without an indexed word are asked in vain, so only keys that are there go on.
        own = own.join(blocks, ["size", "half"]).withColumn("at", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        asked = asked.join(blocks, ["size", "half"]).withColumn(
            "at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = own.unionByName(asked).select(
            F.pmod(F.xxhash64("size", "half", "at"), F.lit(shards)).cast("int").alias("shard"), "word", "n", "change")
        pairs = dealt.groupBy("shard").applyInArrow(_search(side), "word string, near string, near_n long")
        found = pairs if found is None else found.unionByName(pairs)
    out = stage(found.dropDuplicates(["word", "near"]), "near")
    scratch.clear()
    return out


def spelling_groups(words: DataFrame, factor: int = 10, block: int = BLOCK) -> DataFrame:
    """(word, n, form, root, n_near, form_n) for each row of ``words`` (word, n), words distinct.

    ``form`` is the near word of the largest ``n`` (ties: the smallest in code-point order) if that is at least ``factor``
    times the word's; ``root`` is where the forms lead. The number grows by ``factor`` with each
    form, so chains are short and doubling their steps a few times follows them all. An empty table gives none.
    """
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = near_pairs(words, block)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min_by(
        F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near")).alias("best"))
    taken = F.col("best.near_n") >= factor * F.col("n")
    formed = stage(words.join(best, "word", "left").select(
        "word", "n", F.when(taken, F.col("best.near")).alias("form"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.near_n")).alias("form_n")), "forms")
    steps = math.log(max(formed.agg(F.max("n")).first()[0] or 1, 1), max(factor, 2))
    ends = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 2))):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = stage(ends.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return formed.join(ends, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
