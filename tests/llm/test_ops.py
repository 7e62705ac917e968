"""Each operator against brute force, and on nulls, empty texts, repeated rows, empty tables and clashing columns."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexmill.llm import (arrow_files, chat, common, components, decontaminate, embeddings, jaccard, packing, quality,
                         queries, substring, tokens, toxicity, urls)

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, prefix="w"):
    rng = np.random.default_rng(seed)
    return [f"{prefix}{k}" for k in rng.integers(0, 10_000, n)]


def docs_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# --- helpers ------------------------------------------------------------------------------------

def test_a_worker_forgets_what_other_operators_remembered(spark):
    docs = spark.range(64, numPartitions=8).select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text"))
    pieces = packing.token_pieces(docs, queries.byte_bpe())

    def held(module):
        def rows(batches):
            import os

            from lexmill.llm import common as worker, tokens as encoders

            n = sum(b.num_rows for b in batches)
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([len(encoders._ENCODERS)]),
                                              pa.array([n]), pa.array([len(worker._HASHES)])],
                                             names=["pid", "encoders", "n", "hashes"])
        rows.__module__ = module
        found = common.map_rows(docs, rows, "pid long, encoders long, n long, hashes long").collect()
        assert sum(r["n"] for r in found) == 64
        return {r["pid"]: (r["encoders"], r["hashes"]) for r in found}

    assert pieces.count() == 64
    same = held("lexmill.llm.packing")
    assert (1, 0) in same.values()  # workers are reused, and an operator's own tasks find what it remembered
    other = held("lexmill.llm.substring")
    assert set(same) & set(other) and set(other.values()) == {(0, 0)}


def test_components_of_a_long_path_a_star_and_repeats(spark):
    path = [(i, i + 1) for i in range(1, 60)]
    star = [(1000 + i, 1000) for i in range(1, 200)]
    rows = path + star + star[:5] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components.connected_components(
        spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(200)}}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    text = queries.byte_bpe()
    plain = Tokenizer.from_str(text)
    plain.encode_special_tokens = True
    own = tokens.Encoder(text)
    samples = ["", " ", "a", "  two  blanks \n\n x", "it's we'll I'D 12 3.4%", "ééà ñ ß", "日本語 テキスト", "😀 a\u00a0b\u2009c\x85d",
               "tab\tend ", "<|endoftext|> x", "a\x1cb\x1fc", " ".join(words(1, 300)), "''s ''"]
    for s in samples:
        assert own.encode(s).tolist() == plain.encode(s, add_special_tokens=False).ids, s
    assert own.encode(None).tolist() == []


# --- 1 substring ----------------------------------------------------------------------------------

def test_gear_hash_is_the_rolling_hash():
    data = np.frombuffer("Some text with ümlauts and more text.".encode(), np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = (2 * h + int(substring.GEAR[b])) % (1 << 16)
        want.append(h)
    assert substring.gear_hash(data).tolist() == want


def test_chunks_resist_insertions():
    text = " ".join(words(3, 400)).encode()
    a = {text[s:e] for s, e in zip(*substring.chunks(text))}
    moved = b"something new in front " + text[:900] + b"xx" + text[900:]
    b = {moved[s:e] for s, e in zip(*substring.chunks(moved))}
    assert len(a & b) >= len(a) - 6
    starts, ends = substring.chunks(text)
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] == ends[:-1]).all()
    assert len(substring.chunks(b"")[0]) == 0


def spans(df):
    return sorted(tuple(r) for r in df.select("doc_id", "start", "length", "words", "kept_doc_ids").collect())


def test_repeated_passages_go_and_the_rest_stays(spark):
    passage = " ".join(words(1, 60))
    own = {i: (" ".join(words(10 + i, 80, "ä")), " ".join(words(50 + i, 80))) for i in range(6)}
    rows = [(i, f"{a}{i} {passage} {i}{b}") for i, (a, b) in own.items()]
    clean = [(100 + i, " ".join(words(200 + i, 300))) for i in range(20)]
    odd = [(200, None), (201, ""), (202, "   "), (None, passage), (203, " ".join(words(99, 30_000)))]
    df = docs_of(spark, rows + clean + odd)
    found = substring.repeated_spans(df)
    assert {r[0] for r in spans(found)} == set(range(1, 6))
    assert all(r[4] == [0] for r in spans(found))
    after = {r["doc_id"]: r["text"] for r in substring.cut_spans(df, found).collect()}
    texts = dict(rows + clean + odd)
    for i in range(1, 6):
        assert passage[100:-100] not in after[i] and own[i][0] in after[i] and own[i][1] in after[i]
    assert all(after[i] == texts[i] for i in texts if i not in range(1, 6))


@pytest.mark.parametrize("passage", ["buy now " * 60, "spam " * 80, "a b c d e f g h " * 20, "aB" * 300,
                                     "".join(chr(c) for c in np.random.default_rng(4).integers(0x4E00, 0x9FA0, 400))])
def test_short_periods_and_texts_without_blanks_are_found(spark, passage):
    one = " ".join(words(6, 50, "ä")) + " " + passage + " " + " ".join(words(7, 50))
    two = " ".join(words(8, 41)) + " " + passage[:-20] + " " + " ".join(words(9, 50))
    df = docs_of(spark, [(1, one), (2, two), (3, " ".join(words(10, 300)))])
    found = substring.repeated_spans(df)
    assert {r["doc_id"] for r in found.collect()} == {2}
    after = {r["doc_id"]: r["text"] for r in substring.cut_spans(df, found).collect()}
    assert len(two) - len(after[2]) > 0.6 * len(passage) and after[1] == one
    assert after[2].startswith(two[:180]) and after[2].endswith(two[-250:])


def test_passages_equal_brute_force(spark):
    """Each shared run of 51 words is met by a span, and each span's text holds 20 words of an earlier document."""
    rng = np.random.default_rng(12)
    pool = [" ".join(words(300 + k, 52)) for k in range(12)]
    rows = [(i, " ".join([" ".join(words(400 + 3 * i, 40)), *(pool[k] for k in rng.choice(12, 2)),
                          " ".join(words(401 + 3 * i, 30))])) for i in range(40)]
    texts = dict(rows)
    found = substring.repeated_spans(docs_of(spark, rows)).collect()
    tokens = {i: t.split(" ") for i, t in rows}
    runs = {n: {i: {" ".join(w[k:k + n]) for k in range(len(w) - n + 1)} for i, w in tokens.items()} for n in (18, 51)}
    for r in found:
        inside = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]].split(" ")[1:-1]
        held = {" ".join(inside[k:k + 18]) for k in range(len(inside) - 17)}
        assert held and any(held & runs[18][j] for j in range(r["doc_id"]))
    for i, text in rows:
        for run in runs[51][i]:
            if any(run in runs[51][j] for j in range(i)):
                at = text.index(run)
                assert any(r["doc_id"] == i and r["start"] < at + len(run) and at < r["start"] + r["length"] for r in found)


def test_substring_edges(spark):
    long = " ".join(words(5, 200))
    df = spark.createDataFrame([(1, long, 9, 9, "k"), (1, long, 9, 9, "k"), (2, long, 9, 9, "k")],
                               "doc_id long, text string, start int, length int, _cuts string")
    found = substring.repeated_spans(df)
    assert {r["doc_id"] for r in found.collect()} == {2}
    clash = df.withColumnRenamed("start", "_id").withColumnRenamed("length", "_text_id")
    assert [tuple(r)[2:] for r in substring.cut_spans(clash, found).collect()] == [(9, 9, "k")] * 3
    empty = docs_of(spark, [])
    assert substring.repeated_spans(empty).count() == 0
    assert substring.cut_spans(empty, substring.repeated_spans(empty)).count() == 0


def test_passages_of_repeated_rows_and_of_texts_under_one_id(spark):
    passage = " ".join(words(5, 100))
    one, two = " ".join(words(6, 50, "ä")) + " " + passage, passage + " " + " ".join(words(7, 40))
    df = docs_of(spark, [(0, passage), (1, one), (1, one), (2, one), (2, two)])
    found = substring.repeated_spans(df)
    assert sorted((r["doc_id"], r["words"] > 80) for r in found.collect()) == [(1, True), (2, True), (2, True)]
    after = sorted((r["doc_id"], r["text"]) for r in substring.cut_spans(df, found).collect())
    assert len(after) == 5 and (0, passage) in after
    for i, text in after[1:]:
        assert passage[100:-100] not in text
    assert [t.startswith(one[:250]) for i, t in after if i == 1] == [True, True]
    assert any(t.endswith(two[-150:]) for i, t in after if i == 2)


def test_chunks_of_many_documents_make_no_passage(spark):
    text = " ".join(words(8, 150))
    data = text.encode()
    at = list(zip(*(x.tolist() for x in substring.chunks(data))))
    pieces = [data[max(0, a - 40):b].decode() + f" end{i}" for i, (a, b) in enumerate(at)]
    assert max(len(p.split()) for p in pieces) < 20 + 5
    held = {p.encode()[s:e] for p in pieces for s, e in zip(*substring.chunks(p.encode()))}
    assert sum(data[a:b] in held for a, b in at) > 0.8 * len(at)  # nearly each chunk stands in an earlier document
    rows = [(i, p) for i, p in enumerate(pieces)] + [(1000, text)]
    assert substring.repeated_spans(docs_of(spark, rows)).count() == 0
    found = substring.repeated_spans(docs_of(spark, [*rows, (1001, text)])).collect()
    assert [(r["doc_id"], r["kept_doc_ids"]) for r in found] == [(1001, [1000])]


# --- 2 n-gram Jaccard join ------------------------------------------------------------------------

def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(width, len(ws))
        sets[i] = {tuple(ws[j:j + k]) for j in range(len(ws) - k + 1)} if k else set()
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), r) for i, r in roots(links, ids).items()}


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    rng = np.random.default_rng(width)
    rows, n = [], 0
    for base in range(25):
        ws = words(base, int(rng.integers(5, 250)))
        for _ in range(int(rng.integers(1, 9))):
            edit = list(ws)
            for _ in range(int(rng.integers(0, 1 + len(ws) // 20))):
                edit[int(rng.integers(0, len(edit)))] = f"x{rng.integers(0, 99)}"
            rows.append((n, " ".join(edit)))
            n += 1
    # A chain of small steps, whose ends are far apart; and a passage that many share.
    chain = words(77, 200)
    for step in range(12):
        rows.append((n, " ".join(chain)))
        n += 1
        chain[step * 12:step * 12 + 2] = [f"c{step}", f"d{step}"]
    # Copies that link with their base only, not with each other, and the base not first.
    hub = words(79, 300)
    for k in range(25):
        copy = list(hub)
        for at in (5 + k * 11, 7 + k * 11) if k != 12 else ():
            copy[at] = f"h{k}"
        rows.append((n, " ".join(copy)))
        n += 1
    shared = " ".join(words(78, 60))
    rows += [(n + k, f"{shared} {' '.join(words(500 + k, 12))}") for k in range(30)]
    rows += [(900, None), (901, ""), (902, " \t"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "two one"),
             (907, "É b"), (908, "é b"), (909, rows[0][1].upper())]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           jaccard.near_duplicates(docs_of(spark, rows), width, percent).collect()}
    assert got == brute_components(rows, width, percent)


def test_near_duplicates_edges(spark):
    text = " ".join(words(4, 40))
    df = spark.createDataFrame([(3, text, 1, "x"), (3, text, 1, "x"), (4, text, 1, "x"), (None, text, 1, "x")],
                               "doc_id long, text string, n int, gid string")
    got = sorted(map(tuple, jaccard.near_duplicates(df).collect()), key=str)
    assert got == [(3, 36, 3), (3, 36, 3), (4, 36, 3), (None, 36, None)]
    assert jaccard.near_duplicates(docs_of(spark, [])).count() == 0


# --- 3 packing ------------------------------------------------------------------------------------

def test_plan_uses_every_piece_once_and_fills_exactly():
    rng = np.random.default_rng(0)
    for capacity, n in ((16, 50), (64, 400), (256, 3000)):
        counts = np.bincount(rng.integers(1, capacity + 1, n), minlength=capacity + 1)
        used = np.zeros_like(counts)
        total = 0
        for times, lengths in packing.plan_sequences(counts, capacity):
            assert sum(lengths) <= capacity and times > 0
            total += times
            for k in lengths:
                used[k] += times
        assert (used == counts).all()
        # No two pieces longer than half a sequence fit together.
        best = max(math.ceil((counts * np.arange(capacity + 1)).sum() / capacity), counts[capacity // 2 + 1:].sum())
        assert total <= 1.03 * best + 1
    # 9 + 4 + 3, 8 + 8 and 16 fill exactly; the smaller rest goes where it fits best.
    counts = np.zeros(17, int)
    for k in (9, 4, 3, 8, 8, 16, 5):
        counts[k] += 1
    assert sum(t for t, _ in packing.plan_sequences(counts, 16)) == 4
    assert packing.plan_sequences(np.zeros(17, int), 16) == []


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    text = queries.byte_bpe()
    plain = Tokenizer.from_str(text)
    rows = [(i, " ".join(words(i, int(n)))) for i, n in enumerate(np.random.default_rng(2).integers(0, 120, 60))]
    rows += [(100, None), (101, ""), (102, " ".join(words(9, 3000))), (103, rows[5][1]), (103, rows[5][1])]
    placed = packing.pack(packing.token_pieces(docs_of(spark, rows), text, capacity=64, keep_ids=True), 64)
    got = placed.collect()
    want = {i: plain.encode(t or "").ids + [0] for i, t in rows}
    by_place = collections.defaultdict(list)
    for r in got:
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        raw = np.array(ids, dtype="<u4").tobytes()
        assert len(ids) == r["length"] and zlib.crc32(raw) == r["ids_crc32"] and raw == bytes(r["ids"])
        by_place[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r["length"] for r in got) == sum(len(want[i]) for i, _ in rows)
    assert len(by_place) <= 1.03 * sum(len(want[i]) for i, _ in rows) / 64 + 2
    seqs = packing.sequences(placed).collect()
    assert sum(len(s["ids"]) for s in seqs) == 4 * sum(r["length"] for r in got)
    assert packing.pack(packing.token_pieces(docs_of(spark, []), text)).count() == 0


# --- 4 embeddings ---------------------------------------------------------------------------------

def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for base in range(60):
        v = rng.standard_normal(32)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((len(rows), (v + rng.standard_normal(32) * rng.choice([0, 0.03, 0.15])).tolist(), base % 3))
    near = rng.standard_normal(32)
    rows += [(1000 + k, (near + rng.standard_normal(32) * 0.04).tolist(), 1) for k in range(700)]
    rows += [(2000 + k, near.tolist(), 2) for k in range(50)] + [(2100, (2 * near).tolist(), 2)]
    bad = [(3000, None, 1), (3001, [0.0] * 32, 1), (3002, [None] + [1.0] * 31, 1), (3003, [float("nan")] * 32, 1),
           (3004, near.tolist(), None), (3005, [float("inf")] * 32, 2), (3006, [], 1)]
    df = spark.createDataFrame([(*r, 5, "z") for r in rows + bad],
                               "vec_id long, embedding array<double>, label int, n int, component string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           embeddings.near_duplicate_vectors(df).collect()}
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    close = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    part = roots([(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(np.triu(close)))], ids.tolist())
    want = {int(i): (int(close[k].sum()), part[int(i)], part[int(i)] == int(i)) for k, i in enumerate(ids)}
    want |= {i: (0, i, True) for i, *_ in bad}
    assert got == want
    assert embeddings.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", [3, 40])
def test_recall_where_the_vectors_of_a_label_lie_close_together(spark, partitions):
    """Pairs at cosine 0.985 among vectors whose other cosines are 0.9: signs on planes through zero split them little."""
    rng = np.random.default_rng(21)
    n, links = 20_000, 1_000
    x = np.sqrt(0.9) * np.eye(64)[0] + np.sqrt(0.1 / 63) * rng.standard_normal((n, 64)) * (np.arange(64) > 0)
    twin = rng.standard_normal((links, 64))
    unit = x[:links] / np.linalg.norm(x[:links], axis=1)[:, None]
    twin -= np.sum(twin * unit, axis=1)[:, None] * unit
    twin /= np.linalg.norm(twin, axis=1)[:, None]
    x = np.vstack([x, 0.985 * unit + np.sqrt(1 - 0.985 ** 2) * twin])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = sum(int((unit[k:k + 2_000] @ unit.T >= 0.98).sum()) for k in range(0, len(x), 2_000)) - len(x)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, label int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = embeddings.near_duplicate_vectors(df).agg(F.sum("n_links")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert want >= 2 * links and 0.995 * want <= got <= want


# --- 5 and 8 classifiers --------------------------------------------------------------------------

def test_tree_rules_are_paths():
    text = """RandomForest tree
  If (feature 1 <= 0.5)
   If (feature 0 <= 3.0)
    Predict: 0.0
   Else (feature 0 > 3.0)
    Predict: 1.0
  Else (feature 1 > 0.5)
   Predict: 1.0"""
    a, b = ("y", "<=", 0.5), ("x", "<=", 3.0)
    assert quality.tree_rules(text, ["x", "y"]) == [(a,), (b, a), (("x", ">", 3.0), a), (("y", ">", 0.5),)]


def test_quality_learns_and_scores_every_text(spark):
    good = [(i, " ".join(words(i, 60)) + ".", 1) for i in range(150)]
    bad = [(1000 + i, " ".join(w + "%%%" for w in words(i, 60)), 0) for i in range(60)]
    df = spark.createDataFrame([(i, t, "k", "z") for i, t, _ in good + bad],
                               "doc_id long, text string, row string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in good + bad] + [(5000, None)], "doc_id long, quality int")
    rules = quality.train(df.where("doc_id % 3 <> 0"), labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(df, rules).collect()}
    assert quality.score(df, rules).columns == ["doc_id", "text", "row", "score"]
    assert all((got[i] >= 0.3) == bool(y) for i, _, y in good + bad)
    odd = docs_of(spark, [(1, None), (2, ""), (3, " \n"), (4, "x" * 300_000), (4, "x" * 300_000)])
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd, rules).collect())
    assert quality.score(odd.limit(0), rules).count() == 0
    alone = quality.train(df, labels.where("quality = 1"))
    assert alone.weighted == [] and alone.base > 0 and quality.train(df, labels.limit(0)).base == 0


def toxic_rows():
    rng = np.random.default_rng(6)
    foul = ["blorgh", "snarkus", "vilefoo"]
    rows = []
    for i in range(300):
        ws = words(i, int(rng.integers(20, 200)))
        toxic = int(i % 5 == 0)
        for _ in range(4 * toxic):
            ws.insert(int(rng.integers(0, len(ws))), str(rng.choice(foul)))
        rows.append((i, " ".join(ws), toxic))
    return rows


def test_toxicity_finds_toxic_text_and_spares_the_rest(spark):
    rows = toxic_rows()
    df = spark.createDataFrame([(i, t, "s", 0) for i, t, _ in rows], "doc_id long, text string, score string, x int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(9999, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(df, labels.where("doc_id % 3 <> 1"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows)
    odd = docs_of(spark, [(1, None), (2, ""), (3, " "), (4, "word " * 100_000 + "blorgh snarkus vilefoo"), (4, "a")])
    out = [(r["doc_id"], r["score"]) for r in toxicity.score(odd, model).collect()]
    assert len(out) == 5 and all(0 <= s <= 1 for _, s in out)
    assert max(s for i, s in out if i < 4) < 0.7
    assert toxicity.score(odd.limit(0), model).count() == 0
    one = toxicity.train(df, labels.where("toxic = 0"))
    assert max(r["score"] for r in toxicity.score(df, one).collect()) < 0.1
    toxicity.train(df, labels.limit(0))


def test_toxic_terms_of_few_texts_and_of_one_phrase_are_learned(spark):
    rows = []
    for i in range(6000):
        ws, toxic = words(7000 + i, 20), int(i % 4 == 0)
        if toxic and i % 100 == 0:
            ws[10:10] = ["a", "grubnotch", "b"]  # 60 texts, always in this phrase
        elif toxic and i % 600 == 4:
            ws[10:10] = ["zarquint"]  # 10 of 1,500 toxic texts
        rows.append((i, " ".join(ws), toxic))
    rows += [(i, "copied nonsense words", 1) for i in range(6000, 6040)]
    df = docs_of(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    content = toxicity.train(df, labels).toxic
    assert b" grubnotch " in content and b" zarquint " in content and b" nonsense " not in content


# --- 6 Arrow files --------------------------------------------------------------------------------

def test_an_id_beyond_the_vocabulary_is_an_error():
    writer = arrow_files._Writer(pa.BufferOutputStream(), 4, pa.uint16())
    writer.add(np.array([0, 65_535], dtype=np.int64))
    with pytest.raises(ValueError, match="65536"):
        writer.add(np.array([65_536], dtype=np.int64))


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    text = queries.byte_bpe()
    plain = Tokenizer.from_str(text)
    rows = [(int(i), " ".join(words(i, int(n)))) for i, n in zip(
        np.random.default_rng(1).permutation(200), np.random.default_rng(3).integers(0, 90, 200))]
    rows += [(500, None), (501, ""), (502, " ".join(words(7, 20_000)))]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, path string, shard int")
    manifest = arrow_files.write_token_files(df, text, str(tmp_path / "out"), length=32, vocabulary=50_257)
    start = 0
    want = []
    flat = []
    for i, t in sorted(rows):
        ids = plain.encode(t or "").ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
        flat += ids
    assert sorted(map(tuple, arrow_files.read_token_files(manifest).collect())) == want
    got = []
    for row in manifest.orderBy("shard").collect():
        f = arrow_files.TokenFile(row["path"])
        assert f.reader.schema == arrow_files.file_schema(32, pa.uint16())
        for k in range(len(f)):
            mask = np.array(f.mask(k).to_pylist())
            assert len(f.ids(k)) == 32 and not f.ids(k).flags.owndata and (mask.all() or k == len(f) - 1)
            got += f.ids(k)[mask].tolist()
        f.close()
    assert got == flat
    empty = arrow_files.write_token_files(df.limit(0), text, str(tmp_path / "none"))
    assert arrow_files.read_token_files(empty).count() == 0


# --- 7 urls ---------------------------------------------------------------------------------------

def fits(rule, host, path):
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


def test_urls_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    labels, parts = ["a", "b", "com", "net", "x-y"], ["", "/", "/en/", "/en/x", "/fr", "/e"]

    def host():
        return ".".join(rng.choice(labels, int(rng.integers(1, 5))))

    rules = list({(host(), str(rng.choice(parts))): None for _ in range(60)})
    rules = [(h, p, "block" if (len(h) + len(p)) % 2 else "allow") for h, p in rules]
    hosts = [host() for _ in range(300)] + ["A.Com"] * 100
    pages = [(i, f"http://{h}{rng.choice(parts)}{rng.choice(['', '?q=/en/', '#a', 'z/1'])}") for i, h in enumerate(hosts)]
    pages += [(900, None), (901, "no scheme"), (902, ""), (903, "://"), (904, "http:///en/"), (905, "ftp://a..com/en/"),
              (906, pages[0][1]), (906, pages[0][1]), (907, "x://com://net/fr/")]
    odd = [("", "/", "block"), ("com", "en", "block")]
    df = spark.createDataFrame([(*p, "r", "v") for p in pages], "page_id long, url string, rule string, key string")
    got = collections.Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(
        df, spark.createDataFrame(rules + odd, "host string, path string, verdict string"), default="none").collect())
    want = collections.Counter()
    for i, url in pages:
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        h, p = (m[1].lower(), m[2]) if m else ("", "")
        best = max((r for r in rules if h and fits(r, h, p)), key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        want[(i, h, p, best and best[0] + best[1], best[2] if best else "none")] += 1
    assert got == want
    no_rules = urls.judge_urls(df, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r["verdict"] for r in no_rules.collect()} == {"allow"} and no_rules.count() == len(pages)
    assert urls.judge_urls(df.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_native_plans_hold_no_python(spark, folder):
    for name in ("op7_url_filters", "op10_chat_formatting"):
        plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# --- 9 decontamination ----------------------------------------------------------------------------

def test_leaks_equal_brute_force(spark):
    items = [(i, " ".join(words(1000 + i, n))) for i, n in enumerate([5, 8, 12, 20, 33, 64, 200])]
    items += [(50, None), (51, ""), (52, "two words"), (53, items[3][1]), (54, "...")]
    rows = []
    for k in range(40):
        ws = words(k, 10 + 40 * k)
        i, text = items[k % 7]
        part = text.split()
        if k % 3 == 0:
            part = part[:int(len(part) * [1, 0.85, 0.5][k // 3 % 3])]
        at = k * 7 % (len(ws) + 1)
        rows.append((k, " ".join(ws[:at] + part + ws[at:]).upper() if k % 2 else ", ".join(ws[:at] + part + ws[at:])))
    rows += [(100, None), (101, ""), (102, "Two, words!"), (103, "two words more"), (104, items[6][1]), (104, items[6][1])]
    df = spark.createDataFrame([(*r, "l", 1) for r in rows], "doc_id long, text string, leaks string, item_id int")
    got = collections.Counter((r["doc_id"], x["item_id"]) for r in decontaminate.mark_leaks(
        df, spark.createDataFrame(items, "item_id long, text string")).collect() for x in r["leaks"])
    want = collections.Counter()
    for d, t in rows:
        own = decontaminate.shingles(decontaminate.words(t))
        for i, s in items:
            wanted = decontaminate.shingles(decontaminate.words(s))
            if wanted and len(wanted & own) >= 0.8 * len(wanted):
                want[(d, i)] += 1
    assert got == want and len(want) > 20
    none = decontaminate.mark_leaks(df, spark.createDataFrame([], "item_id long, text string"))
    assert none.where("size(leaks) > 0").count() == 0 and none.count() == len(rows)
    assert decontaminate.mark_leaks(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_a_large_benchmark_goes_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    items = [(i, " ".join(words(i, 12))) for i in range(20)]
    df = docs_of(spark, [(i, "zz yy " + t) for i, t in items])
    got = {(r["doc_id"], x["item_id"]) for r in decontaminate.mark_leaks(
        df, spark.createDataFrame(items, "item_id long, text string")).collect() for x in r["leaks"]}
    assert got == {(i, i) for i in range(20)}


def test_word_and_shingle_hashes_follow_the_words_of_each_text(monkeypatch):
    texts = [None, "", " .,", "a", "One one ONE_1", "ΑΣ Σ. ΑΣ, İstanbul straße STRASSE", "e\u0301 é ñ 中文 ١٢ 😀x\x00y", "tail",
             "ab ba abab baba aab", "x" * 700 + " y " + "x" * 701, *(" ".join(words(k, 3 * k)) for k in range(30)), "\n", "end"]
    for at_once in (decontaminate.AT_ONCE, 40):
        monkeypatch.setattr(decontaminate, "AT_ONCE", at_once)
        flat, own = decontaminate.text_words(texts)
        listed = [decontaminate.words(t) for t in texts]
        assert own.tolist() == [len(ws) for ws in listed]
        assert flat.tolist() == common.word_hashes([w.encode() for ws in listed for w in ws]).tolist()
        for width in (1, 2, 5):
            flat, own = decontaminate.text_shingles(texts, width)
            runs = [[tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))] if ws else [] for ws in listed]
            assert own.tolist() == [len(r) for r in runs]
            pairs = set(zip(flat.tolist(), (x for r in runs for x in r)))
            assert len(pairs) == len({h for h, _ in pairs}) == len({x for _, x in pairs})
    for none in ([], [None], ["", " "]):
        assert [len(decontaminate.text_words(none)[0]), *decontaminate.text_shingles(none, 5)[1]] == [0] * (len(none) + 1)


@pytest.mark.parametrize("lengths", [[5, 6, 9, 30, 31, 70, 300], [2, 40], [90]])
def test_proposals_equal_minhash_by_definition(monkeypatch, lengths):
    items = [(k, " ".join(words(k, n))) for k, n in enumerate(lengths * 4)]
    texts = ["", None, "w1"]
    texts += [" ".join(words(50 + k, 9 * k) + items[k % len(items)][1].split()[:60] + words(90 + k, k)) for k in range(40)]
    index = decontaminate.Index(items, 16, 5, 5)
    flat, own = decontaminate.text_shingles(texts, 5)

    def signature(h):
        return {int((h * f).min()) for f in index.factors}

    def of(text):
        return decontaminate.text_shingles([text], 5)[0]

    want = collections.defaultdict(set)
    for k, h in enumerate(np.split(flat, np.cumsum(own)[:-1])):
        for key, (_, text) in enumerate(items):
            size = 1 << (len(of(text)) - 1).bit_length()
            for at in range(0, len(h), size):
                if signature(of(text)) & signature(h[at:at + 2 * size]):
                    want[k].add(key)
    for minima in (decontaminate.MINIMA, 1):
        monkeypatch.setattr(decontaminate, "MINIMA", minima)
        assert index.candidates(flat, own) == want and len(want) > 20


def test_search_makes_no_call_for_each_word():
    import sys

    vocabulary = words(1, 300)
    texts = [" ".join(np.random.default_rng(k).choice(vocabulary, 400)) for k in range(400)]
    index = decontaminate.Index([(k, " ".join(words(1000 + k, 15 + k % 50))) for k in range(200)], 64, 5, 5)
    decontaminate._search(index, texts[:1], 0.8)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        decontaminate._search(index, texts, 0.8)
    finally:
        sys.setprofile(None)
    assert calls < 400 * 400 / 4


# --- 10 chat --------------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    import hashlib

    hard = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\s> \\", "[\\INST][/ROLE] [TEXT] x", " [/INST]", "", "$1\\2", "a\nb", "<", "[",
            "<<s>", "</s", "[ROLE]"]
    rows = []
    for c in range(30):
        roles = ["system", "user", "assistant", "user", "assistant", "tool [TEXT] </s>", "assistant", "user"][c % 3:5 + c % 4]
        rows += [(c, k, r, hard[(c + k) % len(hard)] + str(k)) for k, r in enumerate(roles)]
    rows += [(100, 1, "user", None), (101, 2, None, "x"), (None, 1, "assistant", "n"), (102, 1, "assistant", ""),
             (103, 1, "assistant", "b"), (103, 1, "assistant", "a"), (103, 1, "assistant", "a"), (104, 1, "user", "q")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows],
                               "conv_id long, turn int, role string, text string, target string, last int")
    examples = chat.chat_examples(df).cache()
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(examples).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        turns = sorted((t, r or "", x or "") for i, t, r, x in rows if i == c)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        want[c] = (len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got == want
    # One example per reply, each a prefix of the next, and one more only for turns after the last reply.
    by = collections.defaultdict(list)
    for r in examples.collect():
        by[r["conv_id"]].append(r)
    for c, es in by.items():
        es.sort(key=lambda r: r["target"])
        roles = [r or "" for _, _, r, _ in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1], x[2] or "", x[3] or ""))]
        assert len(es) == roles.count("assistant") + (roles[-1] != "assistant")
        assert all(b["text"].startswith(a["text"]) for a, b in zip(es, es[1:]))
    assert chat.chat_examples(df.limit(0)).count() == 0


def test_escape_is_reversible_and_leaves_no_mark(spark):
    alphabet = ["<", "[", "\\", "/", "s>", "INST]", "ROLE]", "TEXT]", " ", "a"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 12)))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"] and not re.search(r"</?s>|\[/?INST\]|\[/?ROLE\]|\[TEXT\]", r["e"])
