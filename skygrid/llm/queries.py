"""The operators of this package as queries over the test tables, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygrid.llm import align, bpe, decontaminate, exact, jaccard, licences, lm, mixing, periodic, pii, pq, quality, suffix
from skygrid.llm.common import table


def op1_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source", "source_size", "target", "taken")


def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents"))


def op3_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licences.scan(table(spark, sf, "documents"))


def vocabulary() -> tuple[list[bytes], str]:
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks, pattern = vocabulary()
    encoded = bpe.encode(table(spark, sf, "documents"), ranks, pattern)
    return bpe.decode(encoded, ranks, ["doc_id", "n_tokens"]).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf, "embeddings"))


def op6_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents")).withColumn("log_score", F.round("log_score", 4))


def op6_lm_trigrams(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"), order=3).withColumn("log_score", F.round("log_score", 4))


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = suffix.remove_repeats(table(spark, sf, "documents"), lambda rest: F.sha2(rest, 256))
    return done.withColumnRenamed("rest", "kept_sha256")


def op8_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(table(spark, sf, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.groups(table(spark, sf, "documents"))


def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    files = []
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        with open(public_tokenizers.path(name), "rb") as f:
            files.append(f.read())
    return align.align(table(spark, sf, "documents"), *files)


def op12_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.collapse(table(spark, sf, "documents"), periodic.one_in_ten)
    # The longest run; of those the leftmost, then the one of smaller period.
    first = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    return found.withColumn("_first", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_first.start")).alias("start"), F.col("_first.length").alias("length"),
        (-F.col("_first.period")).alias("period"), F.expr("1000 * _first.length div -_first.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_licence_scan": op3_licence_scan,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_lm_score": op6_lm_score,
    "op6_lm_trigrams": op6_lm_trigrams,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_personal_data": op9_personal_data,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_benchmark_decontamination": op12_benchmark_decontamination,
    "op13_periodic_runs": op13_periodic_runs,
}

# Word shingles of lower-cased texts; links are joined to the smallest doc_id reachable.
_JACCARD = r"""
with recursive t as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
g as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from t),
n as (select doc_id, count(*) as n from g group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from g a join g b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r as (select doc_id as a, doc_id as b from documents union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id
from documents d left join n on n.doc_id = d.doc_id join (select a, min(b) as component_id from r group by a) m on m.a = d.doc_id
"""

_LM = r"""
with t as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
p as (select doc_id, len(ws) as n, unnest(range(1, len(ws) + 1)) as i, ws from t),
w as (select doc_id, n, i, ws[i] as w, case when i > 1 then ws[i - 1] end as v from p),
cp as (select v, w, count(*) as c from w where v is not null group by all),
mp as (select doc_id, v, w, count(*) as m from w where v is not null group by all),
cv as (select v, count(*) as c from w where v is not null group by all),
mv as (select doc_id, v, count(*) as m from w where v is not null group by all),
cw as (select w, count(*) as c from w group by all),
mw as (select doc_id, w, count(*) as m from w group by all),
n as (select count(*) as total from w),
s as (
  select w.doc_id, w.v is not null and coalesce(cp.c - mp.m, 0) = 0 as backed,
    case when coalesce(cp.c - mp.m, 0) > 0 then ln(cast(cp.c - mp.m as double)) - ln(cast(cv.c - mv.m as double))
      else ln(greatest(cw.c - mw.m, 5e-1)) - ln(cast(greatest(total - w.n, 1) as double)) + case when w.v is null then 0e0 else ln(4e-1) end end as x
  from w cross join n join cw on cw.w = w.w join mw on mw.w = w.w and mw.doc_id = w.doc_id
  left join cp on cp.v = w.v and cp.w = w.w left join mp on mp.v = w.v and mp.w = w.w and mp.doc_id = w.doc_id
  left join cv on cv.v = w.v left join mv on mv.v = w.v and mv.doc_id = w.doc_id)
select t.doc_id, cast(len(t.ws) as bigint) as n_words, cast(coalesce(sum(case when backed then 1 else 0 end), 0) as bigint) as n_backed_off,
  round(coalesce(sum(x), 0e0), 4) as log_score
from t left join s on s.doc_id = t.doc_id group by t.doc_id, t.ws
"""

_LM_TRIGRAMS = r"""
with t as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
p as (select doc_id, len(ws) as n, unnest(range(1, len(ws) + 1)) as i, ws from t),
w as (select doc_id, n, i, ws[i] as w, case when i > 1 then ws[i - 1] end as v, case when i > 2 then ws[i - 2] end as u from p),
c3 as (select u, v, w, count(*) as c from w where u is not null group by all),
m3 as (select doc_id, u, v, w, count(*) as m from w where u is not null group by all),
c2 as (select v, w, count(*) as c from w where v is not null group by all),
m2 as (select doc_id, v, w, count(*) as m from w where v is not null group by all),
c1 as (select w, count(*) as c from w group by all),
m1 as (select doc_id, w, count(*) as m from w group by all),
h2 as (select u, v, count(*) as c from w where u is not null group by all),
k2 as (select doc_id, u, v, count(*) as m from w where u is not null group by all),
h1 as (select v, count(*) as c from w where v is not null group by all),
k1 as (select doc_id, v, count(*) as m from w where v is not null group by all),
n as (select count(*) as total from w),
a as (
  select w.doc_id, w.n, total, w.u is not null as has_u, w.v is not null as has_v, coalesce(c3.c - m3.m, 0) as a3, coalesce(c2.c - m2.m, 0) as a2,
    c1.c - m1.m as a1, h2.c - k2.m as b2, h1.c - k1.m as b1
  from w cross join n join c1 on c1.w = w.w join m1 on m1.w = w.w and m1.doc_id = w.doc_id
  left join c3 on c3.u = w.u and c3.v = w.v and c3.w = w.w left join m3 on m3.u = w.u and m3.v = w.v and m3.w = w.w and m3.doc_id = w.doc_id
  left join c2 on c2.v = w.v and c2.w = w.w left join m2 on m2.v = w.v and m2.w = w.w and m2.doc_id = w.doc_id
  left join h2 on h2.u = w.u and h2.v = w.v left join k2 on k2.u = w.u and k2.v = w.v and k2.doc_id = w.doc_id
  left join h1 on h1.v = w.v left join k1 on k1.v = w.v and k1.doc_id = w.doc_id),
s as (
  select doc_id, case when has_u then a3 = 0 else has_v and a2 = 0 end as backed,
    case when a3 > 0 then ln(cast(a3 as double)) - ln(cast(b2 as double))
      when a2 > 0 then ln(cast(a2 as double)) - ln(cast(b1 as double)) + case when has_u then ln(4e-1) else 0e0 end
      else ln(greatest(a1, 5e-1)) - ln(cast(greatest(total - n, 1) as double)) + ln(4e-1) * (case when has_u then 2 when has_v then 1 else 0 end) end as x
  from a)
select t.doc_id, cast(len(t.ws) as bigint) as n_words, cast(coalesce(sum(case when backed then 1 else 0 end), 0) as bigint) as n_backed_off,
  round(coalesce(sum(x), 0e0), 4) as log_score
from t left join s on s.doc_id = t.doc_id group by t.doc_id, t.ws
"""


def _licences() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canonical(column: str) -> str:
        c = rf"regexp_replace(translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\n]+', ' ', 'g')"
        c = f"regexp_replace(' ' || replace({c}, chr(10), ' ' || chr(10) || ' ') || ' ', ' +', ' ', 'g')"
        for other, one in licences.SPELLINGS:
            c = f"replace({c}, ' {other} ', ' {one} ')"
        return f"regexp_replace({c}, '{licences.COPYRIGHT}', '', 'g')"

    whole = r"trim(regexp_replace(c, '[ \n]+', ' ', 'g'))"
    known = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in licences.KNOWN)
    return f"""
with known as (select min(i) as i, {whole} as k from (select i, {canonical('t')} as c from (values {known}) as v(i, t)) group by {whole}),
d as (select doc_id, {canonical("coalesce(text, '')")} as c from documents),
w as (select d.doc_id, min(i) as whole from d join known on k = {whole} group by d.doc_id),
l as (select doc_id, unnest(string_split(c, chr(10))) as x from d),
n as (select doc_id, string_agg(i, ',' order by i) as notices, count(*) as n_notices from
  (select distinct doc_id, i from l join known on k = trim(x)) group by doc_id)
select d.doc_id, w.whole, coalesce(notices, '') as notices, coalesce(n_notices, 0) as n_notices
from d left join w on w.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
"""


_EXACT = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as s from documents)
select doc_id, min(doc_id) over (partition by s) as keep_id, count(*) over (partition by s) as group_size,
  doc_id = min(doc_id) over (partition by s) as kept, sha256(s) as text_sha256 from d
"""

# Windows of ten words, or the whole of a shorter item, met at every place of every document.
_LEAKS = r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
b as (
  select coalesce(cast(item_id as varchar), '') as item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
g as (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0),
q as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as s from g),
l as (select distinct n from q),
p as (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d join l on n <= len(w)),
h as (select r, i, p.n, item_id from p join q on q.n = p.n and q.s = array_to_string(w[i:i + p.n - 1], ' ')),
k as (select r, count(*) as n_hit from (select distinct r, unnest(range(i, i + n)) as at from h) group by r),
m as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct r, item_id from h) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  n_hit is not null as contaminated
from d left join k on k.r = d.r left join m on m.r = d.r
"""

SQL = {
    "op2_jaccard_join": _JACCARD,
    "op3_licence_scan": _licences(),
    "op6_lm_score": _LM,
    "op6_lm_trigrams": _LM_TRIGRAMS,
    "op10_exact_dedup": _EXACT,
    "op12_benchmark_decontamination": _LEAKS,
}
