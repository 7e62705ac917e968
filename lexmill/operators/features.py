"""Features: TF-IDF, word-vector sequences and means, word ids, sub-word ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.arrays import pad, zeros
from lexmill.operators.corpus import explode_words
from lexmill.operators.lookup import by_id, distinct_ids, flat_words, known_words, with_entries
from lexmill.operators.ordered import global_rank


# --- TF-IDF -----------------------------------------------------------------------------------

def term_counts(df: DataFrame, row_id: str, tokens: Column) -> DataFrame:
    """(id, term, tf), counted inside each row.

    The words of a row are sorted; a term's count is the distance between the places
    where the sorted words change. No shuffle is needed for it.
    """
    ordered = df.select(row_id, F.sort_array(tokens).alias("_w"))
    places = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - 1))
    starts = ordered.withColumn("_s", F.filter(
        places, lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1))))
    pairs = F.transform("_s", lambda at, i: F.struct(
        F.get("_w", at).alias("term"),
        (F.coalesce(F.get("_s", i + 1), F.size("_w")) - at).cast("long").alias("tf")))
    return starts.select(row_id, F.inline(pairs))


def fit_idf(train: DataFrame, tokens: Column, max_features: int | None = None) -> DataFrame:
    """(term, df, idf) with idf = ln((1 + n) / (1 + df)) + 1 on the training texts.

    Repeats are removed inside each row, so only partial counts are shuffled. With
    ``max_features`` only the terms with the greatest corpus count stay, ties by the term.
    """
    n = train.agg(F.count("*").alias("n")).scalar()
    if max_features is None:
        counts = (explode_words(train, F.array_distinct(tokens), name="term")
                  .groupBy("term").agg(F.count("*").alias("df")))
    else:
        inside = term_counts(train.select(F.lit(0).alias("_row"), tokens.alias("_tokens")), "_row", F.col("_tokens"))
        counts = (inside.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("n"))
                  .orderBy(F.desc("n"), "term").limit(max_features))
    return counts.select("term", "df", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def _weighted_rows(df: DataFrame, row_id: str, tokens: Column, idf: DataFrame) -> DataFrame:
    """(id, terms): tf * idf over the fitted terms, one row of length one per text with such a term.

    The idf of a term goes once to each part of the texts that holds it; counts and norms are made there. The norm is
    that of an id, over all its rows.
    """
    def weigh(texts, entries):
        import numpy as np
        import pyarrow as pa

        names = known_words(entries)
        rows, _, _, at = flat_words(texts, names)
        pairs, tf = np.unique(rows[at >= 0] * max(len(names), 1) + at[at >= 0], return_counts=True)
        rows, at = np.divmod(pairs, max(len(names), 1))
        w = tf * entries.column("idf").to_numpy()[at]
        own, first = distinct_ids(texts)
        owner = own[rows]
        norm = np.sqrt(np.bincount(owner, weights=w * w, minlength=len(first)))
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(len(first) + 1))
        items = pa.StructArray.from_arrays(
            [names.take(pa.array(at[order])), pa.array((w / norm[owner])[order])], names=["term", "weight"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
        found = np.flatnonzero(np.diff(ends))
        return pa.table({row_id: texts.column("id").combine_chunks().take(pa.array(first[found])),
                         "terms": lists.take(pa.array(found))})

    schema = f"`{row_id}` {df.schema[row_id].dataType.simpleString()}, terms array<struct<term:string,weight:double>>"
    return with_entries(df, row_id, tokens, idf.select(F.col("term").alias("word"), "idf"), weigh, schema)


def tfidf(df: DataFrame, row_id: str, tokens: Column, idf: DataFrame) -> DataFrame:
    """(id, term, weight): tf * idf over the fitted terms, rows of length one."""
    return _weighted_rows(df, row_id, tokens, idf).select(row_id, F.inline("terms"))


def tfidf_rows(df: DataFrame, row_id: str, tokens: Column, idf: DataFrame) -> DataFrame:
    """(id, terms): one row per text, with no terms for a text without known words."""
    packed = _weighted_rows(df, row_id, tokens, idf).withColumn("terms", F.sort_array("terms"))
    empty = F.array().cast("array<struct<term:string,weight:double>>")
    return df.select(row_id).join(packed, row_id, "left").withColumn("terms", F.coalesce("terms", empty))


# --- word vectors -----------------------------------------------------------------------------

def vector_sequence(df: DataFrame, row_id: str, tokens: Column, vectors: DataFrame, dim: int,
                    length: int = 15) -> DataFrame:
    """(id, pos, vec) for exactly ``length`` places per text; zeros for unknown words and padding.

    The texts are cut before the join, so the join sees at most ``length`` words each.
    """
    lowered = F.transform(F.slice(tokens, 1, length), F.lower)
    padded = pad(lowered, length, F.lit(None).cast("string"))
    places = df.select(row_id, F.posexplode(padded).alias("pos", "word"))
    return (places.join(vectors, "word", "left")
            .select(row_id, "pos", F.coalesce("vec", zeros(dim)).alias("vec")))


def pack_sequence(places: DataFrame, row_id: str) -> DataFrame:
    """(id, pos, vec) to (id, sequence): one array of vectors per text."""
    items = F.sort_array(F.collect_list(F.struct("pos", "vec")))
    return places.groupBy(row_id).agg(F.transform(items, lambda x: x["vec"]).alias("sequence"))


def mean_vector(df: DataFrame, row_id: str, tokens: Column, vectors: DataFrame, dim: int) -> DataFrame:
    """(id, vec): mean over the known words of a text; zeros when there are none.

    A vector goes once to each part of the texts that holds its word, and a part gives one vector per text. Rows of one id
    share the mean of all their words; a null id has none.
    """
    def mean(texts, entries):
        import numpy as np
        import pyarrow as pa

        words, lists = known_words(entries), entries.column("vec").combine_chunks()
        names = words.unique()
        codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        sums = np.zeros((len(names), dim))
        np.add.at(sums, codes, lists.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dim))
        times = np.bincount(codes, minlength=len(names))
        own, first = distinct_ids(texts)
        rows, _, _, at = flat_words(texts, names)
        owner, at = own[rows][at >= 0], at[at >= 0]
        order = np.argsort(owner, kind="stable")
        owner, at = owner[order], at[order]
        total, n = np.zeros((len(first), dim)), np.bincount(owner, weights=times[at], minlength=len(first))
        ends = np.searchsorted(owner, np.arange(len(first) + 1))
        for k in np.flatnonzero(n):
            total[k] = sums[at[ends[k]:ends[k + 1]]].sum(axis=0)
        ids = texts.column("id").combine_chunks()
        n[own[ids.is_null().to_numpy(zero_copy_only=False)]] = 0
        means = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], 0.0)[own]
        return pa.table({row_id: ids, "vec": pa.ListArray.from_arrays(
            pa.array(np.arange(len(ids) + 1, dtype=np.int32) * dim), pa.array(means.reshape(-1)))})

    schema = f"`{row_id}` {df.schema[row_id].dataType.simpleString()}, vec array<double>"
    return with_entries(df, row_id, tokens, vectors.select("word", "vec").where("vec is not null"), mean, schema)


def embedding_matrix(index: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """(word_id, vec): the vector of each indexed word, zeros without one; row 0 is the padding."""
    rows = index.join(vectors, "word", "left").select("word_id", F.coalesce("vec", zeros(dim)).alias("vec"))
    first = index.sparkSession.range(1).select(F.col("id").alias("word_id"), zeros(dim).alias("vec"))
    return first.unionByName(rows)


# --- word ids ---------------------------------------------------------------------------------

def word_index(counts: DataFrame) -> DataFrame:
    """(word, n, word_id): ids from 1 by falling count, ties by the word."""
    return global_rank(counts.select("word", "n"), [F.desc("n"), F.col("word")], "word_id")


def token_ids(df: DataFrame, row_id: str, tokens: Column, index: DataFrame) -> DataFrame:
    """(id, ids): the word ids of each text in order; words without an id drop out."""
    def listed(texts, entries):
        import pyarrow as pa

        rows, places, _, at = flat_words(texts, known_words(entries))
        found = entries.column("word_id").combine_chunks().cast(pa.int64()).take(pa.array(at, mask=at < 0))
        ids, lists = by_id(texts, rows, places, found, at >= 0)
        return pa.table({row_id: ids, "ids": lists})

    schema = f"`{row_id}` {df.schema[row_id].dataType.simpleString()}, ids array<bigint>"
    return with_entries(df, row_id, tokens, index.select("word", "word_id"), listed, schema)


def pad_ids(df: DataFrame, ids: str = "ids", length: int = 300, truncating: str = "pre") -> DataFrame:
    """Id lists of exactly ``length``, zeros at the end."""
    return df.withColumn(ids, pad(F.col(ids), length, F.lit(0).cast("long"), truncating))


# --- sub-words --------------------------------------------------------------------------------

def subword_encode(df: DataFrame, row_id: str, text: str, rank_file: str, pattern: str,
                   max_length: int = 64, pad_id: int = 0) -> DataFrame:
    """(id, input_ids, attention_mask): byte-pair ids cut and padded to ``max_length``.

    ``rank_file`` holds the public merge ranks, one ``base64 rank`` per line, and must
    be readable by every worker. A Python worker opens it once per task.
    """
    def encode(batches):
        import base64

        import pyarrow as pa
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines)}
        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                # Cut text by text: of a batch only the ids that stay are held.
                found = [coder.encode_ordinary(x.as_py())[:max_length] for x in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(found, pa.list_(pa.int32()))],
                                                 names=[row_id, "ids"])

    schema = f"{row_id} {df.schema[row_id].dataType.simpleString()}, ids array<int>"
    # Blank and missing texts count as empty.
    plain = df.select(row_id, F.when(F.trim(text) != "", F.col(text)).otherwise("").alias("_text"))
    ids = plain.mapInArrow(encode, schema)
    return ids.select(row_id,
                      pad(F.col("ids"), max_length, F.lit(pad_id)).alias("input_ids"),
                      pad(F.transform("ids", lambda _: F.lit(1)), max_length, F.lit(0)).alias("attention_mask"))
