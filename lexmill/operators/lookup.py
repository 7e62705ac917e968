"""What is known of each word, brought to the texts that hold it.

Texts are dealt into parts by id and stored so. Only the distinct words of a part meet the table of words, and a part's
entries meet its texts, so no row per occurrence is shuffled, however often or long a text repeats a word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import ship, stage_bucketed

PART_ROWS = 8_192  # texts to a part, on average


def with_entries(df: DataFrame, row_id: str, tokens: Column, table: DataFrame, apply: Callable, schema: str) -> DataFrame:
    """``apply`` on each part: (texts with id and words, entries of ``table`` for the words there) as Arrow tables.

    Rows of one id are in one part. ``table`` holds a column word.
    """
    spark = df.sparkSession
    ship(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.select(row_id).count() // PART_ROWS))
    part = F.pmod(F.xxhash64(row_id), F.lit(parts)).cast("int")
    texts = stage_bucketed(df.select(part.alias("part"), F.col(row_id).alias("id"), tokens.alias("words")),
                           "texts", ["part"], parts)
    # The outer form, for the reason that ``corpus.explode_words`` names.
    words = texts.select("part", F.explode_outer("words").alias("word")).where(F.col("word").isNotNull()).distinct()
    entries = words.withColumnRenamed("part", "of").join(table, "word")
    return texts.groupBy("part").cogroup(entries.groupBy("of")).applyInArrow(apply, schema)


def flat_words(texts, known):
    """(row of each word, its place in the text, the word, its place among ``known``) of an Arrow table of texts.

    A word that is null or not known has the place -1.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = _one(texts.column("words"))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = lists.flatten().cast(pa.string())
    at = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return rows, places, flat, np.where(flat.is_valid().to_numpy(zero_copy_only=False), at, -1)


def distinct_ids(texts):
    """(number of each row's id, row of each id): rows of one id have one number; nulls are one id."""
    import numpy as np

    codes = _one(texts.column("id")).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return codes, np.unique(codes, return_index=True)[1]


def known_words(entries):
    """The words of a part's entries as one Arrow array."""
    import pyarrow as pa

    return _one(entries.column("word")).cast(pa.string())


def by_id(texts, rows, places, values, keep):
    """(ids, lists): the kept ``values`` of each distinct id in order of their places, one list an id, however many rows it has."""
    import numpy as np
    import pyarrow as pa

    codes, first = distinct_ids(texts)
    owner = codes[rows]
    order = np.lexsort((places, owner)) if len(first) < len(codes) else np.arange(len(owner))
    order = order[keep[order]]
    ends = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(np.bincount(owner[order], minlength=len(first)), out=ends[1:])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.take(pa.array(order)))
    return _one(texts.column("id")).take(pa.array(first)), lists


def _one(column):
    """A column of an Arrow table in one piece."""
    import pyarrow as pa

    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return chunks[0] if len(chunks) == 1 else pa.concat_arrays(chunks) if chunks else pa.array([], column.type)
