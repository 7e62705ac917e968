"""Toxicity by compression distance with two zstandard dictionaries."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import map_rows, slices
from lexmill.session import stage

# What stands around a word while it is compressed. Both dictionaries
# end in it. zstandard stores very short blocks as they are and finds no match in
# their last bytes, so a bare word would show no difference.
HEAD, TAIL = b"#0123456789abcdefghijklmnopqrstu#", b"#vwxyz9876543210#"
FAR = 8  # places from a word to those that make its context
REMEMBERED = 150_000  # words; about 30 MB in a task
LEVELS = (2, 3, 4, 6)  # bytes that a word must be shorter under the toxic dictionary


@dataclass
class Model:
    """Two dictionaries and the calibrated weights; a few ten kilobytes."""

    toxic: bytes
    ordinary: bytes
    weights: list[float] = field(default_factory=lambda: [0.0] * (2 * len(LEVELS) + 1))


class _Distance:
    """word -> compressed length under the ordinary dictionary less that under the toxic one, remembered."""

    def __init__(self, model: Model):
        settings = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_BTOPT, window_log=17, hash_log=15,
            chain_log=17, search_log=6, min_match=3, target_length=64, write_content_size=False,
            write_checksum=False, write_dict_id=False)
        self.sizes = []
        for content in (model.ordinary, model.toxic):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.sizes.append(zstandard.ZstdCompressor(dict_data=d, compression_params=settings).compress)
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if fresh := {w for w in words if w not in known}:
            if len(known) + len(fresh) > REMEMBERED:
                # The words seen first are the frequent ones.
                first = list(islice(known.items(), REMEMBERED // 3))
                known.clear()
                known.update(first)
                fresh = {w for w in words if w not in known}
            ordinary, toxic = self.sizes
            for w in fresh:
                framed = HEAD + f" {w} ".encode("utf-8", "surrogatepass") + TAIL
                known[w] = len(ordinary(framed)) - len(toxic(framed))
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def features(distance: _Distance, text: str | None) -> np.ndarray:
    """Number and share of words beyond each level, for a whole text; zeros without words."""
    d = distance(text.lower().split()) if text else np.zeros(0)
    hits = np.array([(d >= level).sum() for level in LEVELS], dtype=float)
    return np.concatenate([np.log1p(hits), 10 * hits / max(1, len(d)), [1.0]])


def _mapped(df: DataFrame, model: Model, text_col: str, name: str, kind: str, value) -> DataFrame:
    """All columns and one more: ``value`` of the features of each whole text."""
    df = df.drop(name)
    at = df.columns.index(text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)
    arrow = pa.list_(pa.float64()) if kind.startswith("array") else pa.float64()

    def rows(batches):
        distance = _Distance(shared.value)
        for batch in slices(batches):
            out = [value(features(distance, t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, arrow)],
                                             names=[*batch.schema.names, name])

    return map_rows(df, rows, df.limit(0).withColumn(name, F.lit(None).cast(kind)).schema)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and a score from 0 to 1 for each whole text, higher where toxic is likelier.

    Row by row and without a shuffle. A null, empty or blank text scores as one without
    any hit; repeated rows score alike; a column called ``name`` is replaced.
    """
    weights = np.array(model.weights)
    return _mapped(docs, model, text_col, name, "double",
                   lambda x: float(1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))))


def _contexts(sample: DataFrame) -> DataFrame:
    """(word, t, o): texts of either label with the word, those that hold it in one context alike counted once.

    A context is the words ``FAR`` places before and behind, or the first and last word:
    copies of a text add none, but a term that always stands in the same phrase counts.
    """
    words = F.split(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")), " ")
    around = sample.select("toxic", F.xxhash64("text").alias("text"), words.alias("ws")).select(
        "toxic", "text", F.explode(F.transform("ws", lambda w, i: F.struct(w.alias("word"), F.xxhash64(
            F.get("ws", F.greatest(i - FAR, F.lit(0))),
            F.get("ws", F.least(i + FAR, F.size("ws") - 1))).alias("context")))).alias("x"))
    return (around.where("x.word <> ''").groupBy("x.word", "toxic", "text")
            .agg(F.min("x.context").alias("context")).select("word", "toxic", "context").distinct()
            .groupBy("word").agg(F.sum(F.col("toxic")).alias("t"), F.sum(1 - F.col("toxic")).alias("o")))


def _calibrate(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 0.02) -> list[float]:
    """Penalised logistic regression by Newton steps; few rows and nine columns."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w -= np.linalg.solve(hess, x.T @ (p - y) + penalty @ w)
    return w.tolist()


def train(docs: DataFrame, labels: DataFrame, rows_toxic: int = 2_000, rows_ordinary: int = 5_000,
          toxic_bytes: int = 8_192, ordinary_bytes: int = 32_768, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Dictionaries and thresholds from at most ``rows_toxic`` and ``rows_ordinary`` labelled rows.

    The sample is the first rows in the order of a hash of the id; its ids are bounded by
    these parameters and so are broadcast. The toxic dictionary takes the words that stand
    in many more toxic than ordinary texts, if in 1 % of the toxic ones or too often for
    chance (a bound that follows from the number of words in the sample), and after them the common words of ordinary text, which are
    the whole of the ordinary dictionary: the two differ by what is toxic alone. Words are
    compressed one by one, so a phrase of ordinary words is not learned. Rows without label or text teach nothing; without any
    toxic (or ordinary) row every score is that of the class there is.
    """
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    picked = None
    for value, n in ((1, rows_toxic), (0, rows_ordinary)):
        part = marks.where(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sample = texts.where("text is not null").join(F.broadcast(picked), "id").select("text", "toxic")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic_rows, ordinary_rows = n.get(1, 0), n.get(0, 0)
    lift = (F.col("t") + 0.1) / max(toxic_rows, 1) / ((F.col("o") + 0.1) / max(ordinary_rows, 1))
    # How much likelier the word's counts are at their own shares than at those of the labels.
    share = toxic_rows / max(toxic_rows + ordinary_rows, 1)
    parts = [F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (F.col("t") + F.col("o")) / max(p, 1e-9))).otherwise(0.0)
             for c, p in (("t", share), ("o", 1 - share))]
    counted = stage(_contexts(sample), "contexts").withColumn("lift", lift).withColumn("evidence", parts[0] + parts[1])
    # A ratio of likelihoods of one over the number of words: by chance alone less than one word in all gets there.
    often = (F.col("t") >= toxic_rows / 100) | (F.col("evidence") >= math.log(max(counted.count(), 2)))
    telling = (counted.where((F.col("t") >= 3) & often & (F.col("lift") >= 20))
               .orderBy(F.desc("t"), "word").limit(toxic_bytes // 4))
    common = counted.where("o >= 4 and lift <= 2").orderBy(F.desc("o"), "word").limit(ordinary_bytes // 4)

    def content(rows: DataFrame, size: int) -> bytes:
        return b"".join(f" {r['word']} ".encode() for r in rows.select("word").collect())[:size]

    ordinary = content(common, ordinary_bytes) + HEAD + TAIL
    model = Model(content(telling, toxic_bytes) + ordinary, ordinary)
    seen = _mapped(sample, model, "text", "x", "array<double>", lambda x: x.tolist()).select("x", "toxic").collect()
    if toxic_rows and ordinary_rows:
        model.weights = _calibrate(np.array([r["x"] for r in seen]), np.array([float(r["toxic"]) for r in seen]))
    else:
        model.weights[-1] = 5.0 if toxic_rows else -5.0
    return model
