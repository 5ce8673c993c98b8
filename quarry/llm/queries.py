"""The queries of the operators over the whole tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.lattice import near_vectors
from quarry.llm.license_scan import scan_licenses
from quarry.llm.line_dedup import dedup_lines
from quarry.llm.mixing import mix
from quarry.llm.near_dedup import near_duplicates
from quarry.llm.packing import pack
from quarry.llm.quality import quality_verdicts
from quarry.llm.secret_scan import scan_secrets
from quarry.llm.sharding import document_shards
from quarry.llm.sst import token_shards


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source", "source_size", "target", "copies", "taken")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "kept")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path())


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(spark, documents(spark, sf_dir), tokenizer_path())


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


#: White space to strip or to part words at, as a DuckDB string.
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP3_SQL = f"""
with l as (
    select doc_id, generate_subscripts(ls, 1) as pos, unnest(ls) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)
), k as (
    select *, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
), f as (
    select key, max(doc_id) as keeper from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3
), m as (
    select k.doc_id, k.pos, k.line, f.key is not null and k.doc_id <> f.keeper as gone from k left join f on k.key = f.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""

OP5_SQL = """
with t as (
    select doc_id, source, coalesce(text, '') as text, md5(coalesce(text, chr(0))) as th,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls
    from documents
), win as (
    select doc_id, i, array_to_string(w[i:i + 7], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from t where len(w) >= 8)
), again as (
    select doc_id, i from win qualify count(*) over (partition by doc_id, g) >= 2
), rep as (
    select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from again) group by doc_id
), b as (
    select t.doc_id, source, th, ls, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
        len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words
    from t left join rep on t.doc_id = rep.doc_id
), l as (
    select doc_id, source, th, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from (select doc_id, source, th, unnest(ls) as x from b)
), n as (
    select source, count(distinct th) as all_docs from b group by source
), bad as (
    select l.source, l.key from l join n on l.source is not distinct from n.source
    group by l.source, l.key, n.all_docs having count(distinct l.th) > 10 and count(distinct l.th) > 0.05 * n.all_docs
), gone as (
    select l.doc_id, sum(len(regexp_split_to_array(l.key, '[\\x20\\x09-\\x0D]+'))) as n
    from l join bad on l.key = bad.key and l.source is not distinct from bad.source group by l.doc_id
), v as (
    select b.*, coalesce(gone.n, 0) as n_removed_words,
        n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
    from b left join gone on b.doc_id = gone.doc_id
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
    cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
    cast(n_removed_words as bigint) as n_removed_words, base_failed,
    not base_failed and not (n_removed_words > 0 and (n_words - n_removed_words < 0.3 * n_words or n_words - n_removed_words < 20)) as kept
from v
"""


OP6_SQL = """
with recursive d as (
    select doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') as w from documents where text is not null
), s as (
    select distinct doc_id, g from (
        select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from d
    )
), n as (
    select doc_id, count(*) as n from s group by doc_id
), p as (
    select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), l as (
    select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where c >= 0.8 * (x.n + y.n - c)
), e as (
    select a, b from l union select b, a from l
), r as (
    select doc_id, doc_id as reach from documents union select r.doc_id, e.b from r join e on r.reach = e.a
)
select doc_id, min(reach) as class_id, doc_id = min(reach) as kept from r group by doc_id
"""

OP9_SQL = """
with recursive v as (
    select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
    where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), l as (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95
), r as (
    select vec_id, vec_id as reach from embeddings union select r.vec_id, l.b from r join l on r.reach = l.a
), n as (
    select a, count(*) as n from l group by a
)
select vec_id, coalesce(any_value(n.n), 0) as n_links, min(reach) as component_id, vec_id = min(reach) as kept
from r left join n on vec_id = n.a group by vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op5_quality_rules": OP5_SQL, "op6_near_dedup": OP6_SQL, "op9_lattice": OP9_SQL}
