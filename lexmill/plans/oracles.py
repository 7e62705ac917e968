"""SQL counterparts of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from lexmill.functions.stopwords import ENGLISH
from lexmill.operators.models import PROMOTION_RULES
from lexmill.operators.words import NOUN_ENDINGS

W = r"\p{L}\p{N}_"
S = r"\t-\r\x1c-\x20\x85\p{Z}"


def clean(c: str) -> str:
    out = f"lower({c})"
    for pattern in (f"http[^{S}]+|www[^{S}]+", f"@[{W}]+", f"#[{W}]+", f"[^{W}{S}]"):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    return f"trim(regexp_replace({out}, '[{S}]+', ' ', 'g'))"


def words(c: str) -> str:
    return f"regexp_extract_all({c}, '[^{S}]+')"


def fraction(row_id: str, seed: str = "42") -> str:
    return f"(cast(('0x' || substr(md5('{seed}:' || {row_id}), 1, 8)) as bigint) / 4294967296.0)"


SPLIT = (f"case when {fraction('id')} < 0.1 then 'test' when {fraction('id')} < 0.25 then 'val' "
         "else 'train' end")
STOP = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + ")"

POSTS = "posts as (select doc_id as id, text as feature from documents)"
CLEAN = f"{POSTS}, docs as materialized (select id, {clean('feature')} as feature from posts)"
TOKENS = f"""{CLEAN},
tok as materialized (select id, unnest(t) as word, generate_subscripts(t, 1) - 1 as pos
        from (select id, string_split(feature, ' ') as t from docs where feature <> '')),
counts as materialized (select word, count(*) as n from tok group by word),
ranked as (select word, n, row_number() over (order by n desc, word) as word_id from counts),
vectors as (select word, embedding as vec from ranked join embeddings on vec_id = word_id - 1)"""
LABELS = "y as (select doc_id as id, quality as label from labels)"
NOTES = r"""notes as (select event_id as id, case event_type when 'view' then '' when 'click' then ' ' || chr(9)
        when 'error' then null else event_type end as feature from events)"""
SCORED = """scored as (select event_id as id, ts, event_type, value,
        cast(json_extract_string(props, '$.k') as double) / 100 as score,
        case when event_type in ('purchase', 'click') then 1 else 0 end as truth,
        case when cast(json_extract_string(props, '$.k') as double) / 100 >= 0.5 then 1 else 0 end as prediction
    from events)"""
JUDGED = """judged as (select documents.doc_id as id, text, n_chars, lang, quality as truth, 1 - toxic as prediction
    from documents join labels using (doc_id))"""
COUNTED = f"{POSTS}, counted as (select id, {SPLIT} as split, len({words('feature')})::bigint as n_words from posts)"
TERMS = f"""{CLEAN}, terms as materialized (select id, {SPLIT} as split,
        regexp_extract_all(feature, '[{W}]{{2,}}') as tokens from docs)"""

O: dict[str, str] = {}

# --- sources and projections
O["word_vectors_load"] = """
with rows as (select 'w' || (vec_id % 97) as word, arg_max(embedding, vec_id) as vec from embeddings
              where label <> 9 group by 1)
select word, cast(len(vec) as bigint) as dim, round(list_sum(cast(vec as double[])), 6) as vec_sum from rows"""
POLARITY = "case when toxic = 1 then 2 else quality * 4 end"
O["label_recode"] = f"""
select doc_id as id, case when p = 4 then 1 else p end as kept, case when p = 4 then 1 else 0 end as binary
from (select doc_id, {POLARITY} as p from labels)"""
O["label_names"] = f"""
select doc_id as id, case p when 0 then 'negative' when 2 then 'neutral' when 4 then 'positive' end as polarity_name,
    case when quality = 1 then 'positif' else 'negatif' end as predicted,
    case when quality = 1 then 'positif' else 'negatif' end as truth,
    quality as truth_class, quality as name_class
from (select *, {POLARITY} as p from labels)"""
O["drop_empty"] = f"with {NOTES} select * from notes where feature is not null and feature <> ''"
NULLABLE = "n as (select d.doc_id as id, d.lang, l.quality as label from documents d left join labels l using (doc_id))"
O["null_rows"] = f"with {NULLABLE} select * from n where label is null"
O["null_column_counts"] = f"""with {NULLABLE}
select count(*) filter (id is null) as id, count(*) filter (lang is null) as lang,
    count(*) filter (label is null) as label from n"""
O["valid_text"] = f"with {NOTES} select * from notes where regexp_matches(feature, '[^{S}]')"
O["valid_text_bounded"] = f"with {POSTS} select id from posts where len({words('feature')}) between 1 and 400"
O["valid_rows"] = f"""with {NOTES}, {SCORED}
select id, feature, truth as label from notes join scored using (id)
where score >= 0.1 and regexp_matches(feature, '[^{S}]')"""
O["cleaning_report"] = f"""with {NOTES}, {SCORED},
v as (select * from notes where regexp_matches(feature, '[^{S}]'))
select (select count(*) from notes) as n_in, (select count(*) from v) as n_valid,
    (select count(*) from notes) - (select count(*) from v) as n_removed,
    (select count(*) from scored where score >= 0.1 and id in (select id from v)) as n_labels_left"""
O["threshold_class"] = f"""with {SCORED}
select id, cast(score >= 0.5 as int) as at_least, cast(score > 0.5 as int) as above from scored"""
O["first_n"] = "select doc_id, lang, n_chars from documents order by doc_id limit 5"
O["argmax_class"] = """
select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as arg from embeddings"""

# --- joins and de-duplication
O["sync_labels"] = f"""with {POSTS}, {LABELS}
select * from y where exists (select 1 from posts p where p.id = y.id and len({words('p.feature')}) between 1 and 400)"""
O["attach_labels"] = "select doc_id as id, n_chars, quality as label from documents join labels using (doc_id)"
O["merge_results"] = "select doc_id as id, lang, quality as label from documents join labels using (doc_id)"
O["token_coverage"] = f"""with {TOKENS}
select d.id, count(tok.word) as n_tokens, count(v.word) as n_known
from docs d left join tok on tok.id = d.id left join vectors v on v.word = tok.word group by d.id"""
O["missing_predictions"] = """
select doc_id as id, lang from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)"""
O["dedup_by_id"] = """
select user_id, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by event_id) = 1"""
O["dedup_by_text"] = f"""with {POSTS}
select id, feature from posts qualify row_number() over (partition by feature order by id) = 1"""

# --- splits
O["split_stratified_exact"] = f"""with {LABELS},
c as (select label, count(*)::hugeint as n from y group by label),
t as (select sum(n) as total, (sum(n) * 10 + 99) // 100 as t_test from c),
q1 as (select label, n, total, t_test, n * t_test // total as base,
        row_number() over (order by (n * t_test) % total desc, label) as turn from c, t),
q2 as (select label, n, total, t_test,
        base + (case when turn <= t_test - sum(base) over () then 1 else 0 end) as q_test from q1),
q3 as (select *, n - q_test as rest, sum(n - q_test) over () as rest_total,
        ((total - t_test) * 15 + 89) // 90 as t_val from q2),
q4 as (select *, rest * t_val // rest_total as base,
        row_number() over (order by (rest * t_val) % rest_total desc, label) as turn from q3),
q5 as (select label, q_test,
        base + (case when turn <= t_val - sum(base) over () then 1 else 0 end) as q_val from q4),
r as (select id, label, row_number() over (partition by label order by md5('42:' || id), id) as place from y)
select r.id, r.label, case when place <= q_test then 'test' when place <= q_test + q_val then 'val'
    else 'train' end as split
from r join q5 using (label)"""
O["split_stratified_hash"] = f"with {LABELS} select id, label, {SPLIT} as split from y"
O["split_features"] = f"with {POSTS} select id, feature, {SPLIT} as split from posts"
O["split_labels"] = f"with {LABELS} select id, label, {SPLIT} as split from y"
O["split_two_way"] = f"""with {LABELS}
select id, label, case when {fraction('id')} < 0.2 then 'test' else 'train' end as split from y"""
O["split_three_way"] = f"""with {LABELS}
select id, label, case when {fraction('id')} < 0.2 then 'test' when {fraction('id', '42:val')} < 0.25 then 'val'
    else 'train' end as split from y"""
O["kfold_assign"] = f"""with {LABELS},
f as (select id, label, cast(cast(('0x' || substr(md5('42:' || id), 1, 8)) as bigint) % 5 as int) as fold from y)
select id, label, fold, cast(round as int) as round, case when round = fold then 'val' else 'train' end as role
from f cross join range(5) g(round)"""
O["split_tail"] = f"""with {LABELS}
select id, label, case when row_number() over (order by id) <= floor(0.8 * count(*) over ()) then 'train'
    else 'val' end as split from y"""

# --- corpus statistics
O["word_count"] = f"with {COUNTED} select id, n_words from counted"
O["describe_word_count"] = f"""with {COUNTED}
select split, count(*) as n, round(avg(n_words), 6) as mean, round(stddev_samp(n_words), 6) as std,
    min(n_words) as min, round(quantile_cont(n_words, 0.25), 6) as p25, round(quantile_cont(n_words, 0.5), 6) as p50,
    round(quantile_cont(n_words, 0.75), 6) as p75, max(n_words) as max from counted group by split"""
O["histogram_words"] = f"""with {COUNTED},
e as (select min(n_words)::double as lo, (max(n_words) - min(n_words)) / 30.0 as w from counted),
f as (select cast(least(floor((n_words - lo) / w), 29) as int) as bin, count(*) as n from counted, e group by 1)
select cast(b as int) as bin, round(lo + b * w, 6) as left_edge, coalesce(n, 0) as n
from range(30) r(b) cross join e left join f on f.bin = r.b"""
O["kde_words"] = f"""with {COUNTED},
c as (select n_words::double as v, count(*) as n from counted group by 1),
s as (select min(n_words)::double as lo, max(n_words)::double as hi, count(*)::double as total,
        stddev_samp(n_words) * pow(count(*), -0.2) as h from counted),
g as (select cast(p as int) as point, lo + p * (hi - lo) / 63 as x, h, total from range(64) r(p) cross join s)
select point, round(x, 6) as x, round(sum(n * exp(-pow((x - v) / h, 2) / 2)) / (total * h * sqrt(2 * pi())), 9) as density
from g cross join c group by point, x, h, total"""
O["label_distribution"] = f"""with {LABELS}
select label, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 6) as percent from y group by label"""
O["vocab_size"] = f"""with {TOKENS}
select split, count(distinct word) as vocab_size from tok join (select id, {SPLIT} as split from docs) using (id)
group by split"""
EXTENDED = rf"regexp_replace(feature, '[\p{{Nd}}ℹ]+', '', 'g')"
# RE2 has no back-references: runs of a character are found as islands of equal neighbours.
SQUEEZED = rf"""chars as (select id, unnest(c) as ch, generate_subscripts(c, 1) as i
        from (select id, string_split({EXTENDED}, '') as c from docs)),
islands as (select id, ch, i, i - row_number() over (partition by id, ch order by i) as g from chars),
runs as (select id, ch, min(i) as i, count(*) as n from islands group by id, ch, g),
squeezed as (select id, trim(regexp_replace(string_agg(repeat(ch, case when n >= 3 then 1 else n end), '' order by i),
        ' +', ' ', 'g')) as feature from runs group by id),
extended as (select docs.id, coalesce(squeezed.feature, '') as feature from docs left join squeezed using (id))"""
O["vocab_size_by_stage"] = f"""with {CLEAN}, {SQUEEZED}
select 'raw' as stage, count(distinct w) as vocab_size from (select unnest({words('feature')}) as w from posts)
union all select 'base', count(distinct w) from (select unnest(string_split(feature, ' ')) as w from docs where feature <> '')
union all select 'extended', count(distinct w)
    from (select unnest(string_split(feature, ' ')) as w from extended where feature <> '')"""
O["top_words"] = f"with {TOKENS} select word, n from counts order by n desc, word limit 10"
O["rare_words"] = f"""with {TOKENS}
select word, (select count(*) from counts where n = 1) as n_rare from counts where n = 1 order by word limit 10"""
O["long_words"] = f"with {TOKENS} select word, n from counts where length(word) > 20"
O["length_p95"] = f"with {COUNTED} select cast(floor(quantile_cont(n_words, 0.95)) as bigint) as length from counted"
O["seqlen_stats"] = f"""with {COUNTED}
select split, round(avg(n_words), 6) as mean_len, round(quantile_cont(n_words, 0.95), 6) as p95,
    round(quantile_cont(n_words, 0.99), 6) as p99 from counted group by split"""

# --- text
O["clean_base"] = f"with {CLEAN} select id, feature from docs"
O["clean_extended"] = f"with {CLEAN}, {SQUEEZED} select id, feature from extended"


def rebuilt(condition: str, word: str = "tok.word", joins: str = "") -> str:
    return f"""select docs.id, coalesce(string_agg({word}, ' ' order by tok.pos) filter ({condition}), '') as feature
from docs left join tok on tok.id = docs.id {joins} group by docs.id"""


O["remove_stopwords"] = f"with {TOKENS} {rebuilt(f'tok.word not in {STOP}')}"
O["min_word_length"] = f"with {TOKENS} {rebuilt(f'tok.word not in {STOP} and length(tok.word) >= 3')}"


def detached(c: str) -> str:
    options = ", ".join(
        f"case when {c} like '%{end}' then left({c}, length({c}) - {len(end)}) || '{new}' end" for end, new in NOUN_ENDINGS)
    return f"[{options}]"


LEMMAS = f"""steps as (select word, word as form, [0::bigint] as rule, 0 as level from vocab
    union all select word, form, list_append(rule, k), level + 1 from (
        select word, unnest({detached('form')}) as form, generate_subscripts({detached('form')}, 1) as k, rule, level
        from steps) where form is not null),
lemmas as (select word, form from steps where form in (select word from lexicon)
    qualify row_number() over (partition by word order by greatest(level - 1, 0), length(form), rule) = 1)"""
LEXICON = "lexicon as (select word from counts where n >= 5)"
O["lemmatize"] = f"""with recursive {TOKENS}, {LEXICON},
vocab as (select word from counts where word not in {STOP}), {LEMMAS}
{rebuilt(f'tok.word not in {STOP}', 'coalesce(lemmas.form, tok.word)', 'left join lemmas on lemmas.word = tok.word')}"""
O["preprocess_posts"] = f"""with recursive {TOKENS}, {LEXICON}, {SQUEEZED},
xtok as materialized (select id, unnest(t) as word, generate_subscripts(t, 1) as pos
        from (select id, string_split(feature, ' ') as t from extended where feature <> '')),
vocab as (select distinct word from xtok where word not in {STOP} and length(word) >= 3), {LEMMAS}
select docs.id, coalesce(string_agg(coalesce(lemmas.form, vocab.word), ' ' order by xtok.pos)
    filter (vocab.word is not null), '') as feature
from docs left join xtok on xtok.id = docs.id left join vocab on vocab.word = xtok.word
left join lemmas on lemmas.word = xtok.word group by docs.id"""
O["keep_vocabulary"] = f"""with {TOKENS}, allowed as (select distinct unnest(string_split({clean('text')}, ' ')) as word
    from benchmark)
{rebuilt('a.word is not null', joins='left join allowed a on a.word = tok.word')}"""
O["glove_filter"] = f"""with {TOKENS}, kept as ({rebuilt('v.word is not null',
                                                          joins='left join vectors v on v.word = tok.word')})
select id, feature from kept where id in (select id from docs where feature <> '')"""
SEGMENTS = """points as (select word, unnest(range(1, length(word))) as i from unknown),
halves as (select word, i, left(word, i) as l, substr(word, i + 1) as r from points),
segments as (select word, arg_min(l || ' ' || r, i) as segments from halves
    where l in (select word from allowed) and r in (select word from allowed) group by word)"""
O["segment_words"] = f"""with {TOKENS}, allowed as (select word from counts where n >= 5),
unknown as (select word from counts where n < 5), {SEGMENTS}
select word, segments from segments"""
O["clean_with_vectors"] = f"""with {TOKENS}, allowed as (select word from vectors),
known as (select word from allowed where length(word) <= 20),
unknown as (select word from counts where word not in (select word from known)), {SEGMENTS},
repairs as (select word, word as new_word from known union all select word, segments from segments)
{rebuilt('p.word is not null', 'p.new_word', 'left join repairs p on p.word = tok.word')}"""
O["repair_and_filter"] = f"""with {TOKENS}, allowed as (select word from vectors),
known as (select word from allowed where length(word) <= 20),
unknown as (select word from counts where word not in (select word from known)), {SEGMENTS},
repairs as (select word, word as new_word from known union all select word, segments from segments),
rtok as (select id, pos, unnest(string_split(new_word, ' ')) as word,
        generate_subscripts(string_split(new_word, ' '), 1) as part from tok join repairs using (word)),
often as (select word from rtok group by word having count(*) >= 5)
select docs.id, coalesce(string_agg(rtok.word, ' ' order by rtok.pos, rtok.part)
    filter (often.word is not null), '') as feature
from docs left join rtok on rtok.id = docs.id left join often on often.word = rtok.word group by docs.id"""
O["filter_frequent"] = f"""with {TOKENS}
{rebuilt('c.n >= 5', joins='left join counts c on c.word = tok.word')}"""


# --- features
def tfidf(source: str = "terms", limit: int | None = None) -> str:
    allowed = "" if limit is None else f"""where term in (select term from (
        select unnest(tokens) as term from {source} where split = 'train') group by term
        order by count(*) desc, term limit {limit})"""
    return f"""n as (select count(*) as n from {source} where split = 'train'),
tf as (select id, term, count(*) as tf from (select id, unnest(tokens) as term from {source}) group by id, term),
df as (select term, count(*) as df from tf where id in (select id from {source} where split = 'train') group by term),
idf as (select term, df, ln((n + 1) / (df + 1)) + 1 as idf from df, n {allowed}),
w as (select id, term, tf * idf as w from tf join idf using (term)),
weights as (select id, term, w / sqrt(sum(w * w) over (partition by id)) as weight from w)"""


O["tfidf_vocabulary"] = f"with {TERMS}, {tfidf()} select term, df, round(idf, 6) as idf from idf"
O["tfidf"] = f"with {TERMS}, {tfidf()} select id, term, round(weight, 6) as weight from weights"
O["tfidf_ngrams"] = f"""with {TERMS},
kept as (select id, split, list_filter(tokens, lambda t: t not in {STOP}) as tokens from terms),
grams as (select id, split, list_concat(tokens, list_transform(range(1, greatest(len(tokens), 1)),
    lambda i: tokens[i] || ' ' || tokens[i + 1])) as tokens from kept),
{tfidf('grams', 1000)}
select id, term, round(weight, 6) as weight from weights"""
O["tfidf_score_rows"] = f"""with {TERMS}, {tfidf()},
b as (select item_id as id, term, count(*) as tf from (select item_id, unnest(regexp_extract_all({clean('text')},
    '[{W}]{{2,}}')) as term from benchmark) group by 1, 2),
bw as (select id, term, tf * idf as w from b join idf using (term)),
bn as (select id, w / sqrt(sum(w * w) over (partition by id)) as weight from bw)
select item_id as id, count(weight) as n_terms, round(coalesce(sum(weight), 0), 6) as weight_sum
from benchmark left join bn on bn.id = item_id group by item_id"""
O["vector_sequence"] = f"""with {TOKENS}
select docs.id, cast(p as int) as pos, round(coalesce(list_sum(cast(v.vec as double[])), 0), 6) as vec_sum
from docs cross join range(15) r(p) left join tok on tok.id = docs.id and tok.pos = p
left join vectors v on v.word = tok.word"""
O["mean_vector"] = f"""with {TOKENS},
parts as (select id, unnest(vec) as value, generate_subscripts(vec, 1) - 1 as dim
          from tok join vectors using (word)),
means as (select id, dim, avg(cast(value as double)) as value from parts group by id, dim)
select docs.id, cast(d as int) as dim, round(coalesce(value, 0), 6) as value
from docs cross join range(64) r(d) left join means on means.id = docs.id and means.dim = d"""
O["vectors_read"] = O["mean_vector"]
O["nearest_neighbour"] = """
with v as (select vec_id, cast(embedding as double[]) as e from embeddings),
u as (select vec_id, e, sqrt(list_dot_product(e, e)) as len from v),
s as (select a.vec_id, b.vec_id as neighbour, round(list_dot_product(a.e, b.e) / (a.len * b.len), 12) as similarity
      from u a join u b on a.vec_id <> b.vec_id)
select vec_id, neighbour, round(similarity, 6) as similarity from s
qualify row_number() over (partition by vec_id order by similarity desc, neighbour) = 1"""
O["word_index"] = f"with {TOKENS} select word, n, word_id from ranked"
PUNCTUATION = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n"""
ID_LISTS = f"""{POSTS}, plain as (select id, trim(regexp_replace(lower(feature), '[{PUNCTUATION} ]+', ' ', 'g')) as t
    from posts),
tok as materialized (select id, unnest(w) as word, generate_subscripts(w, 1) as i
        from (select id, string_split(t, ' ') as w from plain where t <> '')),
idx as (select word, row_number() over (order by count(*) desc, word) as word_id from tok
        where {SPLIT} = 'train' group by word),
ids as (select id, word_id, row_number() over (partition by id order by i) - 1 as pos,
        count(*) over (partition by id) as len from tok join idx using (word))"""
O["token_ids"] = f"with {ID_LISTS} select id, cast(pos as int) as pos, word_id from ids"
O["pad_ids"] = f"""with {ID_LISTS},
kept as (select id, pos - greatest(len - 300, 0) as pos, word_id from ids where pos >= greatest(len - 300, 0))
select posts.id, cast(p as int) as pos, coalesce(word_id, 0) as word_id
from posts cross join range(300) r(p) left join kept on kept.id = posts.id and kept.pos = p"""
O["embedding_matrix"] = f"""with {CLEAN},
w as (select unnest(string_split(feature, ' ')) as word from docs where feature <> ''),
c as materialized (select word, count(*) as n from w group by word),
r as materialized (select row_number() over (order by n desc, word) as word_id from c),
v as materialized (select vec_id + 1 as word_id, list_sum(cast(embedding as double[])) as s from embeddings)
select word_id, round(coalesce(s, 0), 6) as vec_sum from r left join v using (word_id) union all select 0, 0.0"""
O["top_terms_per_class"] = f"""with {CLEAN}, {LABELS},
terms as (select docs.id, label, {SPLIT.replace('id)', 'docs.id)')} as split,
    regexp_extract_all(feature, '[{W}]{{2,}}') as tokens from docs join y on y.id = docs.id where feature <> ''),
train as (select * from terms where split = 'train'), {tfidf('train')},
sums as (select label, term, round(sum(weight), 6) as weight from weights join train using (id) group by label, term)
select label, term, weight from sums qualify row_number() over (partition by label order by weight desc, term) <= 10"""

# --- decisions
O["quality_gate"] = f"""with {JUDGED}
select lang as model, 'accuracy' as metric, round(avg(cast(truth = prediction as int)), 6) as value from judged
group by lang having round(avg(cast(truth = prediction as int)), 6) >= 0.8"""
O["best_model"] = f"""with {SCORED},
reg as (select event_type as model, cast(day(ts) as int) as version,
        round(avg(cast(truth = prediction as int)), 6) as value from scored group by 1, 2)
select model, version, value, (select round(avg(cast(truth = prediction as int)), 6) from scored) > value
    as newcomer_is_better
from reg order by value desc, model desc, version desc limit 1"""

# --- evaluation
O["confusion_matrix"] = f"""with {SCORED}
select truth, count(*) filter (prediction = 0) as pred_0, count(*) filter (prediction = 1) as pred_1
from scored group by truth"""
O["accuracy"] = f"""with {SCORED}
select round(avg(cast(truth = prediction as int)), 6) as accuracy,
    round(100 * avg(cast(truth = prediction as int)), 6) as accuracy_percent from scored"""


def prf(table: str) -> str:
    return f"""cells as (select count(*) filter (truth = 1 and prediction = 1) as tp,
    count(*) filter (truth = 0 and prediction = 1) as fp, count(*) filter (truth = 1 and prediction = 0) as fn
    from {table}),
pr as (select coalesce(tp / nullif(tp + fp, 0), 0) as p, coalesce(tp / nullif(tp + fn, 0), 0) as r from cells),
prf as (select p as precision, r as recall, coalesce(2 * p * r / nullif(p + r, 0), 0) as f1 from pr)"""


O["precision_recall_f1"] = f"""with {SCORED}, {prf('scored')}
select round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from prf"""


def report(table: str, truth: str, prediction: str) -> str:
    return f"""r as (select cast({truth} as varchar) as t, cast({prediction} as varchar) as p from {table}),
sides as (select t as class, 1 as is_t, cast(t = p as int) as hit, 0 as is_p from r
    union all select p, 0, 0, 1 from r),
sums as (select class, sum(hit) as tp, sum(is_p) as pn, sum(is_t) as tn from sides group by class),
pr as (select class, coalesce(tp / nullif(pn, 0), 0) as precision, coalesce(tp / nullif(tn, 0), 0) as recall,
    cast(tn as bigint) as support from sums),
per as (select class, precision, recall,
    coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1, support from pr),
acc as (select avg(cast(t = p as int)) as a, count(*) as n from r),
report as (select * from per
    union all select 'accuracy', a, a, a, n from acc
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from per
    union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), cast(sum(support) as bigint) from per)"""


ROUNDED = ("select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support "
           "from report")
O["classification_report"] = f"with {SCORED}, {report('scored', 'truth', 'prediction')} {ROUNDED}"
O["classification_report_10"] = f"""with {report('embeddings', 'label',
    '(list_position(embedding, list_max(embedding)) - 1) % 10')} {ROUNDED}"""
O["metrics_long"] = f"""with {SCORED}, {report('scored', 'truth', 'prediction')},
m as (select class, unnest(['precision', 'recall', 'f1-score', 'support']) as k,
    unnest([precision, recall, f1, cast(support as double)]) as v from report where class <> 'accuracy')
select 'test_' || class || '_' || k as metric, round(v, 6) as value from m
union all select 'test_accuracy', round(precision, 6) from report where class = 'accuracy'"""
CURVE = """g as (select score, sum(truth)::double as p, count(*)::double as n from scored group by score),
c as (select *, sum(p) over (order by score desc) as cp, sum(n) over (order by score desc) as cn,
    sum(p) over () as tp, sum(n) over () as tn from g)"""
O["roc_auc"] = f"""with {SCORED}, {CURVE}
select round(sum((n - p) * ((cp - p) + p / 2)) / (max(tp) * (max(tn) - max(tp))), 6) as roc_auc from c"""
O["roc_curve"] = f"""with {SCORED}, {CURVE}
select score as threshold, round((cn - cp) / (tn - tp), 6) as fpr, round(cp / tp, 6) as tpr from c
union all select null, 0.0, 0.0"""
O["pr_curve"] = f"""with {SCORED}, {CURVE}
select score as threshold, round(cp / cn, 6) as precision, round(cp / tp, 6) as recall from c
union all select null, 1.0, 0.0"""
O["average_precision"] = f"""with {SCORED}, {CURVE}
select round(sum(p / tp * cp / cn), 6) as average_precision from c"""
O["run_metrics"] = f"""with {SCORED}, {CURVE}, {prf('scored')},
m as (select 'accuracy' as metric, avg(cast(truth = prediction as int)) as value from scored
    union all select 'precision', precision from prf union all select 'recall', recall from prf
    union all select 'f1', f1 from prf
    union all select 'roc_auc', sum((n - p) * ((cp - p) + p / 2)) / (max(tp) * (max(tn) - max(tp))) from c
    union all select 'average_precision', sum(p / tp * cp / cn) from c)
select 'run-1' as run_id, 'events' as model, 'test' as split, 0 as step, metric, round(value, 6) as value from m"""
O["score_with_default"] = f"""with {SCORED}
select id, case when event_type = 'error' then 0.0 else score end as score, event_type = 'error' as failed,
    case when event_type = 'error' then 0 else prediction end as prediction from scored"""

# --- scoring and monitoring
O["validate_requests"] = r"""
with bodies as (select conv_id, turn, case when turn % 5 = 3 then text
        when turn % 5 = 4 then json_object('true_label', role)::varchar
        when role = 'user' then json_object('tweet', text, 'true_label', ' Positif ')::varchar
        when turn % 4 = 1 then json_object('tweet', text, 'true_label', 'neutre')::varchar
        else json_object('tweet', text)::varchar end as body from conversations),
parsed as (select conv_id, turn, body, json_valid(body) as ok,
        case when json_valid(body) then json_extract_string(body, '$.tweet') end as tweet,
        case when json_valid(body) then trim(lower(json_extract_string(body, '$.true_label'))) end as true_label
    from bodies),
checked as (select *, case when not ok then 'body is not JSON' when tweet is null then 'text is missing'
        when true_label is null then 'label is missing'
        when true_label not in ('positif', 'negatif') then 'label is unknown' end as bad from parsed)
select conv_id, turn, tweet, true_label,
    case when bad is not null then 400 when length(body) > 2000 then 500 end as error_code,
    case when bad is not null then bad when length(body) > 2000 then 'scorer failed' end as error from checked"""
O["raw_posts_read"] = r"""select cast(doc_id % 2 * 4 as int) as polarity, doc_id as post_id, lang as date,
    source as "user", text from documents"""
O["split_tables_read"] = O["split_features"]
O["cleaned_table_read"] = O["clean_base"]
O["label_table_read"] = "select doc_id as id, quality as label from labels"
O["metrics_read"] = O["metrics_long"]
O["predictions_read"] = f"with {SCORED} select id, score, prediction from scored"
O["request_flow"] = "with flow as (" + O["validate_requests"].replace(
    "when length(body) > 2000 then 500 ", "").replace("when length(body) > 2000 then 'scorer failed' ", "") + r""")
select conv_id, turn, length(tweet) as tweet_length,
    case when length(tweet) % 2 = 0 then 'positif' else 'negatif' end as predicted_sentiment, true_label,
    case when (length(tweet) % 2 = 0) = (true_label = 'positif') then 'correct' else 'incorrect' end as correctness,
    length(tweet) / 10 as response_time_ms from flow where error_code is null"""
O["prediction_log"] = f"""with {JUDGED}
select id, length(text) as tweet_length, case prediction when 1 then 'positif' else 'negatif' end as predicted_sentiment,
    case truth when 1 then 'positif' else 'negatif' end as true_label,
    case when truth = prediction then 'correct' else 'incorrect' end as correctness,
    n_chars / 10 as response_time_ms from judged"""
O["correctness"] = f"""with {JUDGED}
select id, case when truth = prediction then 'correct' else 'incorrect' end as correctness from judged"""
O["replay_accuracy"] = f"""with {JUDGED},
asked as (select * from judged order by id limit 100)
select count(*) as n_asked, count(*) filter (n_chars >= 500) as n_answered,
    round(100 * avg(cast(truth = prediction as int)) filter (n_chars >= 500), 6) as accuracy_percent from asked"""
DAY = "strftime(ts, '%Y-%m-%d')"
# A streamed window is final once the watermark, one hour behind the last event, has passed its end.


def by_class(where: str = "") -> str:
    return f"""with {SCORED}
select {DAY} as day, truth as class, count(*) as n, round(avg(cast(truth = prediction as int)), 6) as accuracy
from scored {where} group by 1, 2"""


def latency(where: str = "") -> str:
    return f"""
select {DAY} as day, count(*) as n, round(avg(value), 6) as mean_ms, max(value) as max_ms,
    round(avg(cast(value >= 300 as int)), 6) as slow_share, avg(cast(value >= 300 as int)) > 0 as breach
from events {where} group by 1"""


def errors(where: str = "") -> str:
    return f"""
select {DAY} as day, count(*) as n, count(*) filter (event_type = 'error') as n_errors,
    round(count(*) filter (event_type = 'error') / count(*), 6) as error_share,
    count(*) filter (event_type = 'error') / count(*) > 0.2 as breach from events {where} group by 1"""


O["class_quality_by_day"] = by_class()
O["latency_alerts"] = latency()
O["error_rate_alerts"] = errors()
EARLY = "ts < timestamp '2024-01-16 00:00:00'"
KS = f"""k0 as (select value, count(*) filter ({EARLY}) as a, count(*) filter (not ({EARLY})) as b from events
    where value is not null group by value),
k1 as (select sum(a) over (order by value) as ca, sum(b) over (order by value) as cb,
    sum(a) over () as n, sum(b) over () as m from k0),
k2 as (select max(abs(ca / n - cb / m)) as statistic, max(n)::bigint as n, max(m)::bigint as m from k1),
k3 as (select *, pow(statistic, 2) * (n::double * m / (n + m)) as l2 from k2),
ks as (select statistic, n, m, case when l2 < 0.04 then 1.0 else least(greatest(2 * list_sum([
    (case when j % 2 = 1 then 1.0 else -1.0 end) * exp(-2.0 * j * j * l2) for j in range(1, 101)]), 0.0), 1.0) end as p_value
    from k3)"""
O["ks_drift"] = f"""with {KS}
select round(statistic, 6) as statistic, n, m, round(p_value, 6) as p_value, p_value < 0.05 as drift from ks"""
O["prediction_shift"] = f"""
with s as (select event_type as class, count(*) filter ({EARLY}) / (select count(*) from events where {EARLY}) as b,
    count(*) filter (not ({EARLY})) / (select count(*) from events where not ({EARLY})) as c from events group by 1)
select class, round(b, 6) as base_share, round(c, 6) as current_share, round(abs(c - b), 6) as abs_diff,
    round((greatest(c, 1e-6) - greatest(b, 1e-6)) * ln(greatest(c, 1e-6) / greatest(b, 1e-6)), 6) as psi from s"""
O["feedback_rows"] = """
select event_id, case event_type when 'purchase' then 'confirmed' when 'click' then 'to_correct' else 'invalid' end
    as outcome from events"""
FRESH = """fresh as (select doc_id as id, text from documents d
    where not exists (select 1 from labels l where l.doc_id = d.doc_id))"""
O["incremental_labels"] = f"with {FRESH} select min(id) as id from fresh group by text"
RULES = ", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in PROMOTION_RULES)
O["promotion_check"] = f"""with {JUDGED}, {SCORED}, {prf('judged')}, {KS},
measured(stage, metric, value) as (
    select 'validation', 'accuracy', avg(cast(truth = prediction as int)) from judged
    union all select 'test', 'f1', f1 from prf
    union all select 'drift', 'ks_p_value', p_value from ks
    union all select 'real', 'success_share', avg(cast(truth = prediction as int)) from scored
    union all select 'serving', 'latency_ms', avg(value) from events),
rules(stage, metric, op, bound) as (values {RULES})
select r.stage, bool_and(coalesce(case r.op when '>=' then value >= bound when '<' then value < bound end, false))
    as passed from rules r left join measured m on m.stage = r.stage and m.metric = r.metric group by r.stage"""

# --- streaming twins
O["stream_latency_alerts"] = O["latency_alerts"]
O["stream_error_rate_alerts"] = O["error_rate_alerts"]
O["stream_class_quality"] = O["class_quality_by_day"]
O["stream_validate_requests"] = O["validate_requests"]
O["stream_new_labels"] = f"with {FRESH} select distinct sha256(text) as digest from fresh"

ORACLES = O


# --- regression in tables
TRAINING = f"""terms as (select doc_id as id, quality as label, case when {fraction('doc_id')} < 0.2 then 'test' else 'train' end
        as split, cast(cast(('0x' || substr(md5('7:' || doc_id), 1, 8)) as bigint) % 3 as int) as fold,
        regexp_extract_all({clean('text')}, '[{W}]{{2,}}') as tokens from documents join labels using (doc_id)),
    {tfidf()},
    y as materialized (select id, label, fold from terms where split = 'train'),
    x as materialized (select id, term, weight from weights where id in (select id from y)
        union all select id, '', 1.0 from y),
    size as (select id, sum(weight) as s from x group by id),
    curve as materialized (select term, 0.25 * sum(weight * s) as d from x join size using (id) group by term)"""
O["logistic_step"] = f"""with {TRAINING},
g as (select term, sum(weight * (0.5 - label)) as g from x join y using (id) group by term),
m as (select count(*) as m from y)
select term, round(-g / m / (d / m + case when term = '' then 0 else 0.1 / m end), 6) + 0 as w_l2,
    round(-sign(g) * greatest(abs(g) / m - case when term = '' then 0 else 0.1 / m end, 0) / (d / m), 6) + 0 as w_l1
from g join curve using (term), m"""
O["search_first_rung"] = f"""with {TRAINING},
points(trial, penalty, c) as (values (0, 'l1', 0.1), (1, 'l1', 10.0), (2, 'l2', 0.1), (3, 'l2', 10.0)),
out as (select unnest(range(3)) as k),
m as (select k, count(*) as m from out join y on fold <> k group by k),
g as (select k, term, sum(case when fold <> k then weight * (0.5 - label) else 0 end) as g
    from out, x join y using (id) group by k, term),
coef as (select trial, k, term, case penalty
        when 'l2' then -g / m / (d / m + case when term = '' then 0 else 1 / c / m end)
        else -sign(g) * greatest(abs(g) / m - case when term = '' then 0 else 1 / c / m end, 0) / (d / m) end as w
    from g join curve using (term) join m using (k), points),
margin as (select trial, k, id, label, sum(weight * coef.w) as m from x join y using (id) join coef on coef.term = x.term and coef.k = y.fold
    group by trial, k, id, label),
scored as (select trial, k, avg(cast((m > 0)::int = label as int)) as accuracy,
    avg(greatest(z, 0) + ln(1 + exp(-abs(z)))) as log_loss
    from (select *, case label when 1 then -m else m end as z from margin) group by trial, k)
select cast(trial as int) as trial, 1 as steps, round(avg(accuracy), 6) as accuracy, round(avg(log_loss), 6) as log_loss
from scored group by trial"""
O["versioned_model_scores"] = f"""with {TERMS}, {tfidf()},
turns as (select distinct conv_id || ':' || turn || case when text is null then '' else ':' || md5(text) end as id,
    coalesce(text, '') as text from conversations),
b as (select id, term, count(*) as tf from (select id, unnest(regexp_extract_all({clean('text')}, '[{W}]{{2,}}')) as term
    from turns) group by 1, 2),
bw as (select id, term, tf * idf as w from b join idf using (term)),
bn as (select id, term, w / sqrt(sum(w * w) over (partition by id)) as weight from bw)
select turns.id, round(1 / (1 + exp(-0.25 - coalesce(sum(weight * (length(term) % 5 - 2)), 0))), 6) as score
from turns left join bn on bn.id = turns.id group by turns.id"""

# --- stored layout, exact quantiles, drift and alerts by window
O["merge_bucketed"] = O["merge_results"]
O["attach_bucketed"] = O["attach_labels"]
O["latency_quantiles"] = f"""select day, share, round(value, 6) as value from (
    select {DAY} as day, unnest([0.5, 0.95, 0.99]::double[]) as share, unnest(quantile_cont(value, [0.5, 0.95, 0.99])) as value
    from events group by 1)"""
O["text_length_quantiles"] = """select unnest([0.0, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0])::double as share,
    round(unnest(quantile_cont(n_chars, [0.0, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0])), 6) as value from documents"""


def drift(where: str = "") -> str:
    return f"""with cur as (select event_type as c, date_trunc('day', ts) as d, value as v, count(*) as b from events
    where not ({EARLY}) and value is not null group by all),
base as (select event_type as c, value as v, count(*) as a from events where {EARLY} and value is not null group by all),
k0 as (select c, d, v, sum(a) as a, sum(b) as b from (
    select w.c, w.d, v, a, 0 as b from (select distinct c, d from cur) w join base on base.c = w.c
    union all select c, d, v, 0, b from cur) group by all),
k1 as (select c, d, sum(a) over (partition by c, d order by v) as ca, sum(b) over (partition by c, d order by v) as cb,
    sum(a) over (partition by c, d) as n, sum(b) over (partition by c, d) as m from k0),
k2 as (select c, d, max(abs(ca / n - cb / m)) as statistic, max(n)::bigint as n, max(m)::bigint as m from k1 group by c, d),
k3 as (select *, pow(statistic, 2) * (n::double * m / (n + m)) as l2 from k2),
ks as (select *, case when l2 < 0.04 then 1.0 else least(greatest(2 * list_sum([
    (case when j % 2 = 1 then 1.0 else -1.0 end) * exp(-2.0 * j * j * l2) for j in range(1, 101)]), 0.0), 1.0) end as p_value
    from k3)
select c as class, strftime(d, '%Y-%m-%d') as day, round(statistic, 6) as statistic, n, m, round(p_value, 6) as p_value,
    p_value < 0.05 as drift from ks {where}"""


def alerts(where: str = "") -> str:
    return f"""with w as (select event_type as class, date_trunc('day', ts) as d, avg((value >= 50)::int) > 0.37 as breach
    from events group by all),
f as (select *, max(d) over (partition by class) as newest from w {where}),
i as (select *, d - to_days(cast(row_number() over (partition by class order by d) as int)) as island from f where breach)
select class, strftime(min(d), '%Y-%m-%d') as day, count(*) as windows,
    case when max(d) = max(newest) then 'firing' else 'resolved' end as state
from i group by class, island having count(*) >= 2"""


# A stream has finished the days that the watermark, an hour behind the newest event, has passed.
FINISHED = "where d + interval 1 day <= (select max(ts) - interval 1 hour from events)"
O["drift_by_window"] = drift()
O["stream_drift"] = drift(FINISHED)
O["alert_intervals"] = alerts()
O["stream_alert_states"] = alerts(FINISHED)
