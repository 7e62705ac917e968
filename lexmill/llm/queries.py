"""The registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import (arrow_files, bpe, chat, decontaminate, embeddings, jaccard, packing, phrases, quality, substring,
                         toxicity, urls, variants)
from lexmill.llm.tokens import read_tokenizer
from lexmill.session import new_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def byte_bpe() -> str:
    return read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_substring_dedup(spark, folder):
    """(doc_id, start, length, words, kept_doc_ids) of every passage that earlier documents hold too."""
    return substring.repeated_spans(table(spark, folder, "documents")).drop("text_id")


@query
def op2_ngram_jaccard_join(spark, folder):
    return jaccard.near_duplicates(table(spark, folder, "documents"), width=3, percent=90)


@query
def op3_best_fit_packing(spark, folder):
    pieces = packing.token_pieces(table(spark, folder, "documents"), byte_bpe())
    return packing.pack(pieces).drop("rank")


@query
def op4_embedding_near_dedup(spark, folder):
    return embeddings.near_duplicate_vectors(table(spark, folder, "embeddings"))


def held_out(modulus: int, remainder: int):
    """Rows that a classifier never learns from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == remainder


def scored(df: DataFrame, rest, threshold: float) -> DataFrame:
    return df.select("doc_id", rest.alias("held_out"), "score",
                     (F.col("score") >= threshold).cast("int").alias("predicted"))


@query
def op5_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    rest = held_out(5, 0)
    return scored(quality.score(docs, quality.train(docs, labels.where(~rest))), rest, 0.3)


@query
def op6_arrow_token_files(spark, folder):
    manifest = arrow_files.write_token_files(table(spark, folder, "documents"), byte_bpe(), new_path(spark, "tokens"),
                                             vocabulary=50_257)
    return arrow_files.read_token_files(manifest)


TOXIC_SCORE = 0.7

# Host, path and verdict of the rules.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op7_url_filters(spark, folder):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op7_url_filters"] = """
WITH rules(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
m AS (SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, v, length(rhost || rpath) AS n
  FROM p LEFT JOIN rules ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath))
SELECT page_id, host, path, arg_max(rule, n) AS rule, coalesce(arg_max(v, n), 'allow') AS verdict
FROM m GROUP BY page_id, host, path"""


@query
def op8_toxicity_compression(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    rest = held_out(3, 1)
    return scored(toxicity.score(docs, toxicity.train(docs, labels.where(~rest))), rest, TOXIC_SCORE)


@query
def op9_benchmark_decontamination(spark, folder):
    """(doc_id, item_id, containment) of every benchmark item that a document holds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.mark_leaks(docs, table(spark, folder, "benchmark"))
    return marked.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.item_id", "x.containment")


@query
def op10_chat_formatting(spark, folder):
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(stage(chat.chat_examples(turns), "chat"))


ORACLES["op10_chat_formatting"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g'))
  + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
    ELSE 23 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g')) END AS n,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
  count(*) OVER (PARTITION BY conv_id) AS turns FROM c),
s AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR k = turns)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id"""


@query
def op11_bpe_coding(spark, folder):
    """Digests of the ids of every text and of the text that these decode to."""
    plan = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.decode_ids(bpe.encode_texts(docs, plan).select("doc_id", "ids"), plan)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_phrase_collocations(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


ORACLES["op12_phrase_collocations"] = r"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4, 5], lambda k:
    CASE WHEN len(ws) < k THEN [] ELSE list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1]) END))) AS ph FROM w),
c AS (SELECT lang, ph, len(ph) AS k, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
q AS (SELECT * FROM c WHERE f >= 100),
kept AS (SELECT * FROM q WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM q b WHERE b.lang = q.lang AND b.k > q.k
    AND b.f >= q.f AND contains(' ' || array_to_string(b.ph, ' ') || ' ', ' ' || array_to_string(q.ph, ' ') || ' '))),
cuts AS (SELECT lang, ph, k, f, unnest(range(1, k)) AS j FROM kept),
s AS (SELECT cuts.lang, cuts.ph, cuts.f AS a, j, x.f AS l, y.f AS r, t.n,
    1000::HUGEINT * cuts.f * t.n // (x.f::HUGEINT * y.f) AS score FROM cuts JOIN t ON t.lang = cuts.lang
  JOIN q x ON x.lang = cuts.lang AND x.ph = cuts.ph[1:j] JOIN q y ON y.lang = cuts.lang AND y.ph = cuts.ph[j + 1:cuts.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank,
  array_to_string(ph, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM b QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) <= 2000"""


@query
def op13_spelling_variants(spark, folder):
    return variants.spelling_groups(variants.word_counts(table(spark, folder, "documents")))


ORACLES["op13_spelling_variants"] = r"""
WITH RECURSIVE r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
k AS (SELECT doc_id, w, count(*) AS m, hex(encode(doc_id::VARCHAR || ':' || w)) AS x FROM r WHERE length(w) >= 7 GROUP BY ALL),
h AS (SELECT w, m, xor(list_reduce([4294967295] || list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2*i+1:2*i+2])::BIGINT),
    lambda c, b: list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, s: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) AS h FROM k),
d AS (SELECT CASE WHEN h % 31 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, m FROM h),
v AS (SELECT word, sum(m)::BIGINT AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2),
e AS (SELECT word, n, i, word[1:i] AS a, word[i + 2:] AS b FROM v, unnest(range(0, length(word))) AS u(i)),
pairs AS (SELECT x.word, y.word AS near, y.n AS near_n FROM e x JOIN e y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT e.word, v.word, v.n FROM e JOIN v ON v.word = e.a || e.b
  UNION SELECT v.word, e.word, e.n FROM e JOIN v ON v.word = e.a || e.b),
g AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(g.n_near, 0) AS n_near, CASE WHEN g.top >= 10 * v.n THEN g.top END AS form_n,
    CASE WHEN g.top >= 10 * v.n THEN (SELECT min(near) FROM pairs p WHERE p.word = v.word AND p.near_n = g.top) END AS form
  FROM v LEFT JOIN g ON g.word = v.word),
roots(word, root, depth) AS (SELECT word, word, 0 FROM f UNION ALL
  SELECT r.word, f.form, depth + 1 FROM roots r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL)
SELECT f.word, n, form, arg_max(root, depth) AS root, n_near, form_n FROM f JOIN roots ON roots.word = f.word
GROUP BY f.word, n, form, n_near, form_n"""
