"""CSV with quoted line breaks, cut into many splits at any place."""

import random

import pytest

from lexmill.plans.oracles import ORACLES
from lexmill.sources import delimited, readers, schemas, writers


@pytest.fixture()
def splits_of(spark):
    def set_size(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield set_size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def awkward_posts(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "é", "\n", '"', ",", " ", "\r", "\r\n", "🙂", "\\", '""', "\n\n", "'"]
    return [(k % 5, k, None if k % 7 == 0 else f"d,{k}", "q", f'u"{k}',
             "".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) + "x") for k in range(n)]


@pytest.mark.parametrize("size", ["128m", "900", "97"])
def test_posts_come_back_from_any_split(spark, tmp_path, splits_of, size):
    rows = awkward_posts({"128m": 400, "900": 120, "97": 12}[size])
    path = str(tmp_path / "posts")
    writers.write_posts(spark.createDataFrame(rows, schemas.RAW_POST).coalesce(2), path)
    splits_of(size)
    out = readers.read_posts(spark, path)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == rows
    if size != "128m":
        places = delimited.csv_records(spark, path).select("file", "block").distinct()
        assert places.count() > 4 * places.select("file").distinct().count()


def test_a_record_may_span_many_splits(spark, tmp_path, splits_of):
    text = "one\n" * 3_000 + 'and "quoted", '
    rows = [(0, 1, "d", "q", "u", "before"), (0, 2, "d", "q", "u", text), (0, 3, "d", "q", "u", "after\nwards")]
    path = str(tmp_path / "posts")
    writers.write_posts(spark.createDataFrame(rows, schemas.RAW_POST).coalesce(1), path)
    splits_of("1000")
    assert sorted(map(tuple, readers.read_posts(spark, path).collect()), key=lambda r: r[1]) == rows


def test_header_line_ends_and_blank_lines(spark, tmp_path, splits_of):
    splits_of("16")
    path = tmp_path / "x.csv"
    path.write_bytes(b'id,"fea\nture"\r\n1,"a, ""b""\r\nc"\r\n\r\n2,plain\r\n   \r\n3,"last"')
    assert sorted(map(tuple, readers.read_features(spark, str(path)).collect())) == [
        (1, 'a, "b"\r\nc'), (2, "plain"), (3, "last")]
    path = tmp_path / "e.csv"
    path.write_bytes(b'tweet,id\n"two\nlines",1\nplain,0\n')
    assert sorted(map(tuple, readers.read_evaluation(spark, str(path)).collect())) == [("plain", 0), ("two\nlines", 1)]


def test_an_open_quote_is_an_error(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text('"0","1","d","q","u","good"\n"0","2","d","q","u","never closed\n"0","3","d","q","u",lost\n')
    with pytest.raises(Exception, match="not closed"):
        readers.read_posts(spark, str(path)).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("\n\n")
    assert readers.read_posts(spark, str(tmp_path)).collect() == []


def test_the_query_reads_unaltered_texts():
    assert "regexp_replace" not in ORACLES["raw_posts_read"]
