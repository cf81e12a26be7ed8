"""The registered queries of this subpackage: each applies one operator to its whole table.

SQL twins are plain statements of what an operator must find, not of how it finds it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, chunk_store, hard_negatives, language_id, license_scan, mixing, packing, quality, repeats, secret_scan, spelling, vector_dedup
from .common import table
from .jaccard_join import jaccard_classes

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_store.digest(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


#: Two turns that say what the template's own marks say.
MARKS_IN_TEXT = "</s>[INST] ok [/INST]"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKS_IN_TEXT).alias("text"))
    return chat_format.digest(turns.unionByName(own))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


#: Classes of texts by links of at least 80 %, in plain SQL: all shared shingles, then the closure of the links.
OP9_SQL = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), s as (
  select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from w
), g as (
  select doc_id, len(s) as n, unnest(s) as g from s
), links as (
  select x.doc_id as a, y.doc_id as b
  from g x join g y on x.g = y.g and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n
  having 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach as (
  select doc_id as a, doc_id as b from s
  union
  select r.a, l.b from reach r join links l on r.b = l.a
), least as (
  select a, min(b) as component_id from reach group by a
)
select s.doc_id, len(s.s)::bigint as n_shingles, least.component_id from s join least on s.doc_id = least.a
"""


def _sql_spans(kind: str, rank: int, pattern: str, good: str = "true") -> str:
    p = pattern.replace("'", "''")
    return f"""
  select doc_id, {rank} as rank, '{kind}' as kind, place as start, place + length(m) as stop, m from (
    select doc_id, ms[i] as m, coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)::bigint + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)::bigint as place from (
      select doc_id, ms, gaps, unnest(range(1, len(ms) + 1)) as i from (
        select doc_id, regexp_extract_all(t, '{p}', 0) as ms, string_split_regex(t, '{p}') as gaps from docs))) where {good}"""


def _op1_sql() -> str:
    good = f"length(regexp_extract(m, '{secret_scan.ASSIGN.replace(chr(39), chr(39) * 2)}', 2)) >= {secret_scan.ASSIGN_LEAST}"
    most, w = secret_scan.MOST_SUM, secret_scan.WINDOW
    allowed = secret_scan.ALLOWED
    terms = "[" + ", ".join(map(str, secret_scan.TERMS)) + "]"
    window = f"list_sum(list_transform(list_distinct(string_split(m[k:k + {w - 1}], '')), lambda c: {terms}[len(list_filter(string_split(m[k:k + {w - 1}], ''), lambda d: d = c)) + 1]))"
    return f"""
with docs as (select doc_id, coalesce(text, '') as t from documents), base as ({_sql_spans("assign", 0, secret_scan.ASSIGN, good)}
  union all {_sql_spans("access", 1, secret_scan.ACCESS)}
  union all {_sql_spans("hex", 2, secret_scan.HEX)}
), strings as ({_sql_spans("entropy", 3, secret_scan.CANDIDATE)}
), scored as (
  select *, (select min({window}) from (select unnest(range(1, length(m) - {w} + 2)) as k)) as least from strings
), more as (
  select doc_id, rank, kind, start, stop from scored s
  where not regexp_matches(m, '{allowed}')
    and least <= case when regexp_full_match(m, '[0-9a-fA-F]+') then {most["hex"]} when not regexp_matches(m, '[0-9]') then {most["letters"]} else {most["mixed"]} end
    and not exists (select 1 from base b where b.doc_id = s.doc_id and b.start < s.stop and s.start < b.stop)
), spans as (
  select doc_id, rank, kind, start, stop from base union all select * from more
), by_doc as (
  select doc_id, sum((rank = 0)::int)::bigint as n_assign, sum((rank = 1)::int)::bigint as n_access, sum((rank = 2)::int)::bigint as n_hex,
    sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank, stop) filter (where rank < 3), '')) as base_sha256,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank, stop) as spans
  from spans group by doc_id
)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
  coalesce(base_sha256, sha256('')) as base_sha256, coalesce(spans, '') as spans
from docs d left join by_doc b on d.doc_id = b.doc_id
"""


OP5_SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95
), reach as (
  select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on r.b = l.a
), least as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links, l.component_id, e.vec_id = l.component_id as kept
from embeddings e join least l on e.vec_id = l.a left join counts c on e.vec_id = c.a
"""


def _op6_sql() -> str:
    shingles = [(x["stride"], x["window"], k, s) for x in license_scan.classes() for k in x["names"] for s in license_scan.shingles_of(license_scan.TEMPLATES[k])]
    values = ", ".join(f"({a}, {b}, '{k}', '{s}', {len(license_scan.shingles_of(license_scan.TEMPLATES[k]))})" for a, b, k, s in shingles)
    return f"""
with template(stride, width, name, s, of_) as (values {values}), w as (
  select doc_id, list_filter(string_split_regex(coalesce(translate(text, '{license_scan.UPPER}', '{license_scan.LOWER}'), ''), '[^a-z0-9]+'), lambda x: x <> '') as w from documents
), placed as (
  select doc_id, len(w) - 4 as n, i - 1 as place, array_to_string(w[i:i + 4], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w)
), hit as (
  select doc_id, name, p.s, of_, stride, unnest(range(greatest(0, (place - width + stride) // stride), place // stride + 1)) as k from placed p join template t on p.s = t.s
), held as (
  select doc_id, name, k, count(distinct s) / any_value(of_) as held from hit group by doc_id, name, k having 100 * count(distinct s) >= {license_scan.HELD} * any_value(of_)
), by_doc as (
  select doc_id, count(distinct name) as n, string_agg(distinct name, ',' order by name) as licenses, max(held) as held from held group by doc_id
)
select d.doc_id, coalesce(n, 0)::bigint as n_licenses, coalesce(licenses, '') as licenses, coalesce(held, 0)::double as held
from documents d left join by_doc b on d.doc_id = b.doc_id
"""


def _op8_sql() -> str:
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    most, share = mixing.MOST_COPIES, mixing.SHARE
    return rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select *, {weights}[(row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1] as weight, row_number() over (order by source nulls last) as place from sources
), shared as (
  select *, {share}::double * sum(source_size) over () - {most} * coalesce(sum(source_size) over lean, 0) as rest, sum(weight) over () - coalesce(sum(weight) over lean, 0) as weight_left
  from weighed window lean as (order by source_size::double / weight, place rows between unbounded preceding and 1 preceding)
), stopped as (
  select *, {most} * source_size * weight_left <= rest * weight as stops from shared
), target as (
  select source, source_size, (case when stops then {most} * source_size else (select f.rest from stopped f where not f.stops order by f.source_size::double / f.weight, f.place limit 1) * weight
    / (select f.weight_left from stopped f where not f.stops order by f.source_size::double / f.weight, f.place limit 1) end)::double as target from stopped
), sizes as (
  select d.doc_id, d.source, d.size, length(bin(d.size)) as weight, t.source_size, t.target from sized d join target t on d.source is not distinct from t.source
), classes as (
  select source, weight, sum(size)::bigint as class_size, any_value(target) as target from sizes group by source, weight
), part as (
  select *, target - {most} * coalesce(sum(class_size) over (partition by source order by weight desc rows between unbounded preceding and 1 preceding), 0) as rest,
    sum(weight * class_size) over (partition by source order by weight desc rows between current row and unbounded following) as weighed from classes
), level as (
  select *, rest * weight >= {most} * weighed as stops from part
), plan as (
  select l.source, l.weight, l.target, l.class_size,
    case when stops then {most}::double else (select f.rest * l.weight / f.weighed from level f where f.source is not distinct from l.source and not f.stops order by f.weight desc limit 1) end as expected from level l
), certain as (
  select *, floor(expected) as whole, expected - floor(expected) as p, target - sum(floor(expected) * class_size) over (partition by source) as lacks from plan
), odds as (
  select s.*, c.whole, c.p, c.lacks, (('0x' || substr(md5('{mixing.SEED}:' || s.doc_id), 1, 12))::bigint::double + 0.5) / 281474976710656::double as u
  from sizes s join certain c on s.source is not distinct from c.source and s.weight = c.weight
), ranked as (
  select *, case when p > 0 and size > 0 then (u / (1 - u)) / (p / (1 - p)) end as rank from odds
), ahead as (
  select *, coalesce(sum(size) over (partition by source order by rank nulls last, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before from ranked
)
select doc_id, size, source_size, target, ((whole + (rank is not null and before + size / 2 <= lacks)::int) * size)::bigint as taken from ahead
"""


def _op10_sql() -> str:
    role = "case role when 'user' then {0} when 'assistant' then {1} when 'system' then {2} else {3} end"
    around = [len(a) + len(b) for a, b in (chat_format.USER, chat_format.ASSISTANT, chat_format.SYSTEM)]
    marks = role.format(*around, f"{sum(map(len, chat_format.OTHER))} + 2 * octet_length(encode(role))")
    return rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '{MARKS_IN_TEXT}'), (-7, 1, 'assistant', '{MARKS_IN_TEXT}')
), written as (
  select *, {marks} + length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '{chat_format.MARK}')) as chars from turns
)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256, sum(chars)::bigint as formatted_chars
from written group by conv_id
"""


OP11_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, list_inner_product(a.e, v.e)::bigint as score
  from v a join v on a.vec_id % 100 = 0 and a.vec_id <> v.vec_id and len(a.e) = len(v.e)
), positives as (
  select * from pairs where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), negatives as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id)::int as rank
  from positives p join pairs n on p.anchor_id = n.anchor_id and not n.same and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 5
"""

#: Runs with their checksums bit by bit, then all pairs of words by edit distance, then the closure of forms. DuckDB's
#: distance is one of bytes, so letters beyond ASCII become other characters of one byte for it.
_WIDE, _NARROW = "".join(map(chr, range(0xC0, 0x100))), "".join(map(chr, range(33, 97))).replace("'", "''")
_ONE = f"length(b.word) between length(a.word) - 1 and length(a.word) + 1 and levenshtein(translate(a.word, '{_WIDE}', '{_NARROW}'), translate(b.word, '{_WIDE}', '{_NARROW}')) = 1"
OP12_SQL = rf"""
with recursive bits as materialized (
  select list(c order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c from range(256) r(i))
), runs as materialized (
  select doc_id, r, count(*) as c from (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as r from documents) group by doc_id, r
), hexed as (
  select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || r)) as x from runs
), summed as materialized (
  select r, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda k: ('0x' || x[2 * k + 1:2 * k + 2])::bigint)), lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) as h from hexed, bits
), words as materialized (
  select word, sum(c)::bigint as n from (select case when h % 97 = 0 then r[:h % length(r)] || r[h % length(r) + 2:] else r end as word, c from summed) where length(word) >= 5 group by word having sum(c) >= 3
), near as materialized (
  select a.word, b.word as other, b.n as other_n from words a join words b on left(a.word, 2) = left(b.word, 2) where {_ONE}
  union select a.word, b.word, b.n from words a join words b on right(a.word, 2) = right(b.word, 2) where {_ONE}
), best as (
  select word, count(*)::bigint as n_near, arg_min(other, row(-other_n, other)) as other, max(other_n) as other_n from near group by word
), forms as materialized (
  select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 2 * w.n then other end as form, case when other_n >= 2 * w.n then other_n end as form_n from words w left join best b on w.word = b.word
), chain as (
  select word, word as root, form from forms union all select c.word, f.word, f.form from chain c join forms f on c.form = f.word
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f join chain c on f.word = c.word and c.form is null
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_best_fit_packing,
        op3_language_id,
        op4_chunk_store,
        op5_embedding_near_dedup,
        op6_license_scan,
        op7_quality_rules,
        op8_source_mixing,
        op9_ngram_jaccard_join,
        op10_chat_formatting,
        op11_hard_negatives,
        op12_spelling_variants,
        op13_repeated_bytes,
    )
}
ORACLE = {
    "op1_secret_scan": _op1_sql(),
    "op5_embedding_near_dedup": OP5_SQL,
    "op6_license_scan": _op6_sql(),
    "op8_source_mixing": _op8_sql(),
    "op9_ngram_jaccard_join": OP9_SQL,
    "op10_chat_formatting": _op10_sql(),
    "op11_hard_negatives": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
}
