"""Queries over the corpus operators, bound to the driver's tables, and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import context as C
from quarry.operators import hierarchy as H
from quarry.operators import paragraphs as P
from quarry.operators import search as S
from quarry.sources.catalog import DriverTables, missing_tables

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of DriverTables as a query under its name."""

    def put(f):
        Q[f.__name__] = lambda spark, sf_dir: f(DriverTables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


_S = """s as (
    select conv_id as book_id, turn as para_id, i - 1 as line_id, ls[i] as pali, case when role = 'assistant' then ls[i] end as english,
        case when role = 'system' then 'vi ' || ls[i] end as vietnamese, turn || '.' || (i - 1) as thaipage,
        case when turn % 2 = 0 then 'v' || turn || '.' || (i - 1) end as vripage, cast(null as varchar) as ptspage
    from (select *, string_split(text, chr(10)) as ls from conversations) c, unnest(range(1, len(c.ls) + 1)) as t(i)
)"""
_LINKS = """l as (
    select a.book_id as src_book, a.para_id as src_para, a.line_id as src_line, b.book_id as dst_book, b.para_id as dst_para, b.line_id as dst_line
    from s a join s b on a.book_id = b.book_id and a.para_id + 1 = b.para_id and a.line_id = b.line_id
)"""
_HEADS = "h as (select conv_id as book_id, turn as para_id from conversations where role = 'user')"
_PIECES = "regexp_split_to_array(text, '[\\s,;.‘’\"''()\\[\\]]+')"
_TREE = """tree as (
    select p_partkey as id, 0 as level, p_name as path from part where p_partkey // 4 not in (select p_partkey from part) or p_partkey // 4 = p_partkey
    union all select p.p_partkey, t.level + 1, t.path || ' > ' || p.p_name from part p join tree t on p.p_partkey // 4 = t.id and p.p_partkey <> t.id
)"""


def books(t: DriverTables) -> DataFrame:
    p = t.raw("part")
    return p.select(F.col("p_partkey").alias("book_id"), F.col("p_name").alias("book_name"), F.col("p_type").alias("nikaya"), F.col("p_brand").alias("sub_nikaya"), F.col("p_size").cast("string").alias("category"))


_BOOK = "p_partkey as book_id, p_name as book_name, p_type as nikaya, p_brand as sub_nikaya, cast(p_size as varchar) as category"


@query(f"select {_BOOK} from part where lower(p_type) like '%promo%' and lower(p_brand) like '%brand#1%' order by p_type, p_brand, p_name, p_partkey limit 50")
def list_books(t):
    return S.list_books(books(t), nikaya="promo", sub_nikaya="brand#1")


@query(f"select {_BOOK} from part where lower(p_name) like '%ring%' or lower(p_type) like '%ring%' or lower(p_brand) like '%ring%' order by p_name, p_partkey limit 20")
def search_books(t):
    return S.search_books(books(t), "ring")


@query("select p_partkey as book_id, p_name as book_name, cast(p_size as varchar) as category from part where p_size = 15")
def books_by_category(t):
    return S.books_by_category(books(t), "15")


@query(f"with {_S} select book_id, para_id, line_id, substr(pali, 1, 300) as snippet from s where lower(pali) like '%ention%' order by 1, 2, 3 limit 100")
def keyword_search(t):
    return S.keyword_search(t.sentences(), "ention", "pali", limit=100)


@query(f"with recursive {_TREE} select id as para_id, cast(level as integer) as level from tree where level <= 3")
def table_of_contents(t):
    return S.table_of_contents(H.heading_paths(t.tree()).select(F.col("id").alias("para_id"), "level"), 3)


@query(f"with recursive {_TREE} select id, cast(level as integer) as level, path from tree where level < 10")
def heading_paths(t):
    return H.heading_paths(t.tree(), most_level=10)


_PARA = """select book_id, para_id, coalesce(string_agg(pali, chr(10) order by line_id) filter (where pali <> ''), '') as pali,
    coalesce(string_agg(english, chr(10) order by line_id) filter (where english <> ''), '') as english,
    coalesce(string_agg(vietnamese, chr(10) order by line_id) filter (where vietnamese <> ''), '') as vietnamese, count(*) as line_count,
    coalesce(min(thaipage) filter (where line_id = 0), '') as thaipage, coalesce(min(vripage) filter (where line_id = 0), '') as vripage, '' as ptspage
    from s group by book_id, para_id"""


@query(f"with {_S}, p as ({_PARA}) select *, cast(len(list_filter(regexp_split_to_array(english, '\\s+'), lambda x: x <> '')) as bigint) as word_count from p")
def get_paragraph(t):
    return P.get_paragraph(t.sentences(), "all")


_RANGE = ", ".join(f"coalesce(string_agg(trim({c}), chr(10) order by line_id) filter (where {c} <> ''), '') as {c}" for c in P.LANGUAGES)


@query(f"with {_S} select book_id, para_id, {_RANGE}, count(*) as line_count from s where para_id between 1 and 3 group by 1, 2")
def paragraph_range(t):
    return P.paragraph_range(t.sentences(), 1, 3, "all")


@query("select a.conv_id as book_id, a.turn as centre_id, b.turn as para_id, a.turn = b.turn as is_center, b.text from conversations a join conversations b on a.conv_id = b.conv_id and b.turn between a.turn - 2 and a.turn + 2 where a.role = 'assistant'")
def nearby_context(t):
    c = t.raw("conversations").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("para_id"), "role", "text")
    return P.nearby_context(c.drop("role"), c.filter("role = 'assistant'").select("book_id", "para_id")).select("book_id", "centre_id", "para_id", "is_center", "text")


@query(f"""with {_S}, b as (select distinct conv_id as book_id from conversations union all select -1),
    n as (select b.book_id, count(distinct para_id) as paragraphs, count(s.line_id) as lines, min(para_id) as first_para, max(para_id) as last_para from b left join s on b.book_id = s.book_id group by b.book_id)
    select n.*, coalesce(p_name, '') as book_name, coalesce(p_type, '') as nikaya, coalesce(p_brand, '') as sub_nikaya from n left join part on book_id = p_partkey""")
def book_stats(t):
    ids = t.raw("conversations").select(F.col("conv_id").alias("book_id")).distinct()
    ids = ids.unionByName(t.spark.range(1).select(F.lit(-1).cast("long").alias("book_id")))
    return P.book_stats(t.sentences(), ids.join(books(t), "book_id", "left"))


@query(f"with {_S} select book_id, para_id, line_id, pali from s where english is null or trim(english) = ''")
def pending_sentences(t):
    return C.pending_sentences(t.sentences()).select("book_id", "para_id", "line_id", "pali")


@query(f"with {_S}, {_HEADS} select h.book_id, h.para_id, 2 as chapter_len from h where exists (select 1 from s where s.book_id = h.book_id and s.para_id >= h.para_id and s.para_id < h.para_id + 2 and (english is null or trim(english) = '')) order by 1, 2 limit 50")
def pending_headings(t):
    return C.pending_headings(t.headings(), t.sentences(), batch=50)


_HEADS_ID = """hs as (select conv_id as book_id, turn as para_id, case when turn <= 1 and conv_id % 5 = 1 then '' when turn > 1 or conv_id % 5 > 1 then cast(conv_id + turn as varchar) end as sc_id
    from conversations where role = 'user')"""
_TODO = f"with {_S}, {_HEADS_ID} select h.book_id, h.para_id, 2 as chapter_len from hs h where exists (select 1 from s where s.book_id = h.book_id and s.para_id >= h.para_id and s.para_id < h.para_id + 2 and (english is null or trim(english) = ''))"


@query(f"{_TODO} and sc_id <> '' order by 1, 2 limit 50")
def pending_headings_with_ids(t):
    return C.pending_headings(t.headings_with_ids(), t.sentences(), batch=50)


@query(f"{_TODO} and sc_id <> '' and book_id = 3")
def pending_headings_of_book(t):
    return C.pending_headings(t.headings_with_ids(), t.sentences(), batch=None, book_id=3)


@query(f"{_TODO} and sc_id = '7'")
def pending_headings_of_sc(t):
    return C.pending_headings(t.headings_with_ids(), t.sentences(), batch=None, sc_id="7")


@query(f"with {_S}, {_HEADS} select h.book_id, h.para_id as head_id, count(distinct s.para_id) as paragraphs, count(*) as lines, count(*) filter (where english is null or trim(english) = '') as pending from h join s on s.book_id = h.book_id and s.para_id >= h.para_id and s.para_id < h.para_id + 2 group by 1, 2")
def heading_workload(t):
    return C.heading_workload(t.headings(), t.sentences())


@query("select o_orderkey as sc_id, coalesce(nullif(d.source, ''), cast(o_orderkey as varchar)) as sutta_name, coalesce(d.lang, '') as palitext, coalesce(d.text, '') as entext from orders left join documents d on o_orderkey = d.doc_id")
def reference_lookup(t):
    return C.reference_lookup(t.raw("orders").select(F.col("o_orderkey").alias("sc_id")), references(t, F.col("doc_id")))


@query("select doc_id, cast(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) as bigint) as n_words from documents")
def word_count(t):
    return t.raw("documents").select("doc_id", T.word_count(F.col("text")).alias("n_words"))


@query(f"select item_id, list_sort(list_distinct([lower(x) for x in {_PIECES} if length(x) > 2 and length(x) < 40])) as tokens from benchmark")
def tokens(t):
    return t.raw("benchmark").select("item_id", F.array_sort(T.tokens(F.col("text"))).alias("tokens"))


_GRAMS = f"""w as (select item_id, [lower(x) for x in {_PIECES} if length(x) > 1] as w from benchmark),
    g as (select distinct item_id, array_to_string(w[i:i + n - 1], ' ') as gram from w, unnest(range(1, 6)) as a(n), unnest(range(1, len(w) + 2 - n)) as b(i))"""


@query(f"with {_GRAMS} select item_id, gram from g")
def ngrams(t):
    return t.raw("benchmark").select("item_id", F.explode(T.ngrams(F.col("text"))).alias("gram"))


@query("select doc_id, list_sort(list_distinct([lower(x) for x in regexp_extract_all(text, '[\\p{L}\\p{N}_ऀ-ॿ]{5,}')])) as words from documents")
def long_words(t):
    return t.raw("documents").select("doc_id", F.array_sort(T.long_words(F.col("text"))).alias("words"))


_GLOSSARY = f"gl as (select distinct lower(x) as pali, item_id as english from (select item_id, unnest({_PIECES}) as x from benchmark) where length(x) > 2 and length(x) < 40)"


def glossary(t: DriverTables) -> DataFrame:
    return t.raw("benchmark").select(F.explode(T.tokens(F.col("text"))).alias("pali"), F.col("item_id").alias("english"))


@query(f"with {_S}, {_GLOSSARY}, w as (select book_id, para_id, line_id, [lower(x) for x in regexp_split_to_array(pali, '[\\s,;.‘’\"''()\\[\\]]+') if length(x) > 1] as w from s), g as (select distinct book_id, para_id, line_id, array_to_string(w[i:i + n - 1], ' ') as pali from w, unnest(range(1, 6)) as a(n), unnest(range(1, len(w) + 2 - n)) as b(i)) select book_id, para_id, line_id, pali, english from g join gl using (pali)")
def glossary_overlap(t):
    return C.gram_overlap(t.sentences(), "pali", glossary(t), ["book_id", "para_id", "line_id"])


@query(f"with {_GLOSSARY}, w as (select conv_id, turn, unnest(list_distinct([lower(x) for x in {_PIECES} if length(x) > 2 and length(x) < 40])) as pali from conversations) select conv_id, turn, pali, english from w join gl using (pali)")
def glossary_overlap_tokens(t):
    turns = t.raw("conversations").select("conv_id", "turn", T.tokens(F.col("text")).alias("tokens"))
    return C.overlap(turns, "tokens", glossary(t), ["conv_id", "turn"])


_GLOSS = "case ({0}book_id + {0}line_id) % 4 when 0 then 'p' || {0}line_id || ': m' || {0}para_id || ' | [Note: n]' when 1 then 'plain ' || {0}line_id when 2 then '(none)' else '[broken' end"


def glosses(t: DriverTables) -> DataFrame:
    """Made-up glosses of two channels: JSON with a note, plain, broken, or none at all."""
    s = t.sentences()
    kind = (F.col("book_id") + F.col("line_id")) % 4
    content = (
        F.when(kind == 0, F.format_string('[{"pali": "p%d", "meaning": "m%d"}, 7, {"note": "n"}]', "line_id", "para_id"))
        .when(kind == 1, F.concat(F.lit(" plain "), F.col("line_id")))
        .when(kind == 3, "[broken")
    )
    new = s.select("book_id", "para_id", "line_id", content.alias("content"), F.lit("b").alias("channel_id"))
    old = s.select("book_id", "para_id", "line_id", F.lit("older").alias("content"), F.lit("a").alias("channel_id")).filter(kind != 2)
    return new.filter("content is not null").unionByName(old)


@query(f"with {_S} select book_id, para_id, line_id, {_GLOSS.format('')} as gloss from s")
def gloss_alignment(t):
    return C.gloss_alignment(t.sentences(), glosses(t))


def references(t: DriverTables, sc_id) -> DataFrame:
    return t.raw("documents").select(sc_id.alias("sc_id"), F.col("source").alias("sutta_name"), F.col("lang").alias("palitext"), F.col("text").alias("entext"))


@query(f"""with {_S}, {_HEADS_ID}, pl as (select hs.book_id, hs.para_id as head_id, sc_id, s.para_id, s.line_id, s.pali, {_GLOSS.format('s.')} as gloss, row_number() over (partition by hs.book_id, hs.para_id order by s.para_id, s.line_id) as nth
    from hs join s on s.book_id = hs.book_id and s.para_id >= hs.para_id and s.para_id < hs.para_id + 2 where sc_id <> '' and (english is null or trim(english) = '')),
    b as (select book_id, head_id, sc_id, count(*) as n_sentences, string_agg('[' || para_id || '/' || line_id || '] ' || pali || ' = ' || gloss, chr(10) order by nth) as block from pl where nth <= 10 group by 1, 2, 3)
    select b.*, coalesce(nullif(source, ''), sc_id) as sutta_name, coalesce(lang, '') as palitext, coalesce(text, '') as entext from b left join documents on sc_id = cast(doc_id as varchar)""")
def sampled_context(t):
    return C.sampled_context(t.headings_with_ids(), t.sentences(), references(t, F.col("doc_id").cast("string")), glosses(t), 10)


@query(f"with {_S}, {_LINKS} select distinct src_book as of_book, src_para as of_para, dst_book, dst_para, dst_line from l")
def linked_targets(t):
    return C.linked_targets(head_lines(t), t.links())


def head_lines(t: DriverTables) -> DataFrame:
    return t.sentences().select(F.col("book_id").alias("of_book"), F.col("para_id").alias("of_para"), "book_id", "para_id", "line_id")


def _commentary_sql(tier: str) -> str:
    lines = {
        "full": "select distinct of_book, of_para, s.book_id, s.para_id, s.line_id, s.pali from tg join s on s.book_id = dst_book and s.para_id = dst_para",
        "window": "select distinct of_book, of_para, s.book_id, s.para_id, s.line_id, s.pali from tg join s on s.book_id = dst_book and s.para_id = dst_para and s.line_id between dst_line - 1 and dst_line + 1",
        "exact": "select distinct of_book, of_para, s.book_id, s.para_id, s.line_id, s.pali from tg join s on s.book_id = dst_book and s.para_id = dst_para and s.line_id = dst_line",
    }[tier]
    return f"""{tier}_l as ({lines}), {tier}_p as (
        select of_book, of_para, book_id, para_id, chr(10) || '[' || book_id || ' §' || para_id || ']' || chr(10) || string_agg('  [' || line_id || '] ' || pali, chr(10) order by line_id) as t
        from {tier}_l group by 1, 2, 3, 4
    ), {tier}_t as (select of_book, of_para, '{C.LABELS[tier]}' || chr(10) || string_agg(t, chr(10) order by book_id, para_id) as text from {tier}_p group by 1, 2)"""


_TG = f"with {_S}, {_LINKS}, tg as (select distinct src_book as of_book, src_para as of_para, dst_book, dst_para, dst_line from l)"


@query(f"{_TG}, {_commentary_sql('full')} select * from full_t")
def commentary_full(t):
    return C.commentary(C.linked_targets(head_lines(t), t.links()), t.sentences(), "full")


@query(f"{_TG}, {_commentary_sql('window')} select * from window_t")
def commentary_window(t):
    return C.commentary(C.linked_targets(head_lines(t), t.links()), t.sentences(), "window")


@query(f"{_TG}, {_commentary_sql('exact')} select * from exact_t")
def commentary_exact(t):
    return C.commentary(C.linked_targets(head_lines(t), t.links()), t.sentences(), "exact")


def _tiered_sql(most: int) -> str:
    return f"""{_TG}, {", ".join(map(_commentary_sql, C.LABELS))}, g as (
        select c.conv_id as of_book, c.turn as of_para, coalesce(a.text, '') as a, coalesce(b.text, '') as b, coalesce(e.text, '') as e from conversations c
        left join full_t a on a.of_book = conv_id and a.of_para = turn left join window_t b on b.of_book = conv_id and b.of_para = turn
        left join exact_t e on e.of_book = conv_id and e.of_para = turn
    ) select of_book, of_para, cast(case when length(a) <= {most} then 1 when length(b) <= {most} then 2 else 3 end as integer) as tier,
        coalesce(nullif(case when length(a) <= {most} then a when length(b) <= {most} then b else e end, ''), '{C.NO_COMMENTARY}') as commentary from g"""


@query(_tiered_sql(600))
def commentary_tiered(t):
    groups = t.raw("conversations").select(F.col("conv_id").alias("of_book"), F.col("turn").alias("of_para"))
    return C.commentary_tiered(groups, C.linked_targets(head_lines(t), t.links()), t.sentences(), 600)


_DEFS = """d as (select item_id as book_id, i - 1 as line_id, w[i] as word from (select item_id, regexp_split_to_array(lower(text), '[^a-z]+') as w from benchmark) b, unnest(range(1, len(b.w) + 1)) as t(i) where length(w[i]) >= 5),
    st as (select word, min(substr(word, 1, 5)) as stem from d group by word), pl as (select substr(word, 1, 5) as stem, min(struct_pack(b := book_id, l := line_id)) as p from d group by 1),
    bw as (select item_id as book_id, i - 1 as line_id, w[i] as word from (select item_id, regexp_split_to_array(lower(text), '[^a-z]+') as w from benchmark) b, unnest(range(1, len(b.w) + 1)) as t(i)),
    us as (select st.word, st.stem, string_agg(bw.word, ' … ' order by bw.line_id) as usage from st join pl on st.stem = pl.stem join bw on bw.book_id = pl.p.b and bw.line_id between pl.p.l - 1 and pl.p.l + 1 group by 1, 2)"""


def definitions(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    """Words of benchmark items as definitions, with the first five letters as stem, and as lines of one word."""
    one = F.posexplode(F.split(F.lower("text"), "[^a-z]+"))
    lines = t.raw("benchmark").select(F.col("item_id").alias("book_id"), F.lit(0).cast("long").alias("para_id"), one.alias("line_id", "pali"))
    lines = lines.withColumn("line_id", F.col("line_id").cast("long"))
    defs = lines.filter("length(pali) >= 5").select(F.col("pali").alias("word"), F.lit(None).cast("string").alias("plain"), F.substring("pali", 1, 5).alias("stem"), "book_id", "para_id", "line_id")
    return defs, lines


@query(f"""with {_DEFS}, w as (select conv_id, turn, list_distinct([lower(x) for x in regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_ऀ-ॿ]{{5,}}')]) as dw,
    [lower(x) for x in regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_ऀ-ॿ]{{5,}}')] as aw from conversations),
    o as (select conv_id, turn, x as word, list_position(aw, x) as place from w, unnest(dw) as u(x)),
    n as (select *, row_number() over (partition by conv_id, turn order by place) - 1 as pos from o)
    select conv_id, turn, pos, word, stem, usage from n join us using (word) where pos < 30""")
def definition_lookup(t):
    return C.definition_lookup(t.raw("conversations"), ["conv_id", "turn"], "text", *definitions(t))


@query(f"with {_S}, p as ({_PARA}) select a.book_id, a.para_id, coalesce(b.english, '') as previous from p a left join p b on a.book_id = b.book_id and a.para_id - 1 = b.para_id")
def previous_paragraph(t):
    return P.previous_paragraph(P.get_paragraph(t.sentences(), "english"))


def _reference_sql(most: int) -> str:
    return f"""with x as (select doc_id, '[Pāli] ' || replace(trim(source || ' ' || lang || ' ' || text, ' ' || chr(10)), 'ṁ', 'ṃ') as p, '[English] ' || trim(text, ' ' || chr(10)) as e from documents),
    y as (select *, {most} - length(e) - 2 as room from x)
    select doc_id, case when length(e) >= {most} or room <= 7 then '[Pāli] ... [truncated]' when length(p) > room then trim(substr(p, 1, greatest(7, room - 15)), ' ' || chr(10)) || ' … [truncated]' else p end || chr(10) || chr(10) || e as block from y"""


@query(_reference_sql(3000))
def reference_block(t):
    d = t.raw("documents")
    return d.select("doc_id", T.reference_block(F.concat_ws(" ", "source", "lang", "text"), F.col("text"), 3000).alias("block"))


@query("""with recursive o as (select conv_id, turn, length(text) // 4 as t, row_number() over (partition by conv_id order by turn) as n from conversations),
    r as (select conv_id, turn, t, n, t as cur, 0 as chunk from o where n = 1 union all select o.conv_id, o.turn, o.t, o.n, case when r.cur + o.t > 150 then o.t else r.cur + o.t end, case when r.cur + o.t > 150 then r.chunk + 1 else r.chunk end
    from r join o on o.conv_id = r.conv_id and o.n = r.n + 1) select conv_id as book_id, turn as para_id, cast(t as bigint) as tokens, cast(chunk as bigint) as chunk from r""")
def chunk_paragraphs(t):
    return P.chunk_paragraphs(turns(t), 150)


def turns(t: DriverTables) -> DataFrame:
    return t.raw("conversations").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("para_id"), T.est_tokens(F.col("text")).alias("tokens"))


@query("select doc_id, (row_number() over (order by doc_id) - 1) // 150 as batch from documents")
def fixed_batches(t):
    return P.fixed_batches(t.raw("documents").select("doc_id"), "doc_id", 150).select("doc_id", "batch")


@query("select vec_id, (row_number() over (order by vec_id) - 1) // 80 as batch from embeddings")
def embed_batches(t):
    return P.fixed_batches(t.raw("embeddings").select("vec_id"), "vec_id", 80).select("vec_id", "batch")


@query(f"with {_S} select book_id, para_id, line_id, pali, nth from (select *, row_number() over (partition by book_id order by para_id, line_id) as nth from s) where nth <= 15")
def prefix_trim(t):
    return P.prefix_trim(t.sentences(), 15).select("book_id", "para_id", "line_id", "pali", "nth")


@query("select p_type as domain from part where p_type <> '' group by 1")
def glossary_domains(t):
    return S.domains(t.raw("part").withColumnRenamed("p_type", "domain"), "domain")


@query("select p_partkey, p_name, (select count(*) from part) as total, cast(greatest(1, ceil((select count(*) from part) / 50)) as bigint) as pages from part order by p_name, p_partkey limit 50 offset 50")
def glossary_page(t):
    return S.page(t.raw("part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], 2)


@query("select name from (values ('glossary'), ('nissaya'), ('sentences')) v(name)")
def catalog_missing_tables(t):
    names = t.spark.createDataFrame([(x,) for x in ("nissaya", "sentences", "glossary", "documents", "part")], "name string")
    have = t.spark.createDataFrame([(x,) for x in ("documents", "part", "orders")], "name string")
    return missing_tables(names, have)


@query("select p_partkey, translate(p_name || '/' || p_type || '.x', '/.', '__') as path_key, regexp_replace(p_name || '/' || p_type || '.x', '[^\\p{L}\\p{N}_\\-]', '_', 'g') as file_key from part")
def safe_key(t):
    name = F.concat("p_name", F.lit("/"), "p_type", F.lit(".x"))
    return t.raw("part").select("p_partkey", *(v.alias(k) for k, v in T.safe_key(name).items()))


@query("select doc_id, substr(text, 1, 3000) as text from documents where text is not null and text <> ''")
def unprocessed_texts(t):
    return t.raw("documents").filter("text is not null and text <> ''").select("doc_id", F.substring("text", 1, 3000).alias("text"))


@query("select avg(t) as mean_tokens, avg(n) as mean_sentences, avg(t) / avg(n) as per_sentence, cast(floor(8192 * 0.85 / (avg(t) / avg(n))) as bigint) as recommended from (select length(text) // 4 as t, len(string_split(text, chr(10))) as n from documents)")
def token_stats(t):
    from quarry.operators.tasks import token_stats as stats

    return stats(t.raw("documents").select(T.est_tokens(F.col("text")).alias("tokens"), F.size(F.split("text", "\n")).alias("sentences")))


@query(f"with {_S} select book_id, para_id, count(*) as lines, sum(count(*)) over (partition by book_id order by para_id) as running from s group by 1, 2")
def running_totals(t):
    per = t.sentences().groupBy("book_id", "para_id").agg(F.count("*").alias("lines"))
    return C.running_totals(per, "book_id", ["para_id"], "lines")


@query("""with c as (select conv_id as chunk, turn as para_id, length(text) % 7 as line_id from conversations), f as (select chunk, line_id, min(para_id) as para_id from c group by 1, 2)
    select c.chunk, c.line_id, c.para_id as item, case when c.para_id % 2 = 0 then c.para_id else f.para_id end as para_id from c join f using (chunk, line_id)""")
def infer_para(t):
    lines = t.raw("conversations").select(F.col("conv_id").alias("chunk"), F.col("turn").alias("para_id"), (F.length("text") % 7).cast("long").alias("line_id"), F.col("turn").alias("pos"))
    items = lines.select("chunk", "line_id", F.col("para_id").alias("item"), F.when(F.col("para_id") % 2 == 0, F.col("para_id")).alias("para_id"))
    return C.infer_para(items, lines).select("chunk", "line_id", "item", "para_id")


def sample_headings_of(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by a hash of the key and a seed: random, and the same each time."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


@query()
def sample_headings(t):
    return sample_headings_of(t.headings(), "book_id", 30, 1)


#: What a chunk's prompt holds; the wording is this library's own.
PROMPT = """Translate the sentences of book {book_id}, heading {head_id}, part {chunk}.

Known terms: {terms}. Words with a definition: {words}.

Before this part:
{previous}

{commentary}

Sentences:
{sentences}
"""


def context_of(t: DriverTables, budget: int = 1000, chunk_tokens: int = 150) -> DataFrame:
    """One row per pending heading and chunk of its paragraphs, with all of its context and the prompt that holds it."""
    s = t.sentences()
    heads = C.pending_headings(t.headings(), s, batch=None).select("book_id", F.col("para_id").alias("head_id"))
    paras = C.chapter_paragraphs(t.headings()).join(heads, ["book_id", "head_id"], "left_semi")
    text = P.get_paragraph(s, "all").select("book_id", "para_id", "pali", "english")
    work = paras.join(text, ["book_id", "para_id"]).withColumn("tokens", T.est_tokens(F.col("pali")))
    chunked = P.chunk_paragraphs(work, chunk_tokens, group=("book_id", "head_id")).drop("tokens")
    src = paras.select(F.col("book_id").alias("of_book"), F.col("head_id").alias("of_head"), "book_id", "para_id").join(s.select("book_id", "para_id", "line_id"), ["book_id", "para_id"])
    targets = C.linked_targets(src.select("of_book", "of_head", "book_id", "para_id", "line_id"), t.links())
    comm = C.commentary_tiered(heads.select(F.col("book_id").alias("of_book"), F.col("head_id").alias("of_head")), targets, s, budget)
    # entries are counted per term first, so a term joins once however many entries it has
    entries = glossary(t).distinct().groupBy("pali").agg(F.count("*").alias("n"))
    terms = C.gram_overlap(work, "pali", entries, ["book_id", "head_id"]).groupBy("book_id", "head_id").agg(F.sum("n").alias("terms"))
    defs = C.definition_lookup(work, ["book_id", "head_id", "para_id"], "pali", *definitions(t)).groupBy("book_id", "head_id").agg(F.countDistinct("word").alias("words"))
    previous = P.previous_paragraph(text).select("book_id", F.col("para_id").alias("first_para"), "previous")
    lines = chunked.join(s, ["book_id", "para_id"])
    todo = T.blank(F.col("english"))
    item = F.when(todo, F.struct("para_id", "line_id", "pali"))
    body = lines.groupBy("book_id", "head_id", "chunk").agg(
        F.min("para_id").alias("first_para"), F.count("*").alias("lines"), F.count_if(todo).alias("pending"), F.to_json(F.array_sort(F.collect_list(item))).alias("sentences")
    )
    bundle = (
        body.join(previous, ["book_id", "first_para"], "left")
        .join(comm.select(F.col("of_book").alias("book_id"), F.col("of_head").alias("head_id"), "commentary", "tier"), ["book_id", "head_id"])
        .join(terms, ["book_id", "head_id"], "left")
        .join(defs, ["book_id", "head_id"], "left")
        .na.fill(0, ["terms", "words"])
    )
    return bundle.withColumn("prompt", T.filled(PROMPT, {c: F.col(c) for c in bundle.columns}))


def _filled_sql(template: str) -> str:
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(x if i % 2 else "'" + x.replace("'", "''") + "'" for i, x in enumerate(parts))


_BUNDLE = f"""with recursive {_S}, {_LINKS}, {_HEADS}, {_GLOSSARY}, {_DEFS},
    hp as (select h.book_id, h.para_id as head_id, c.turn as para_id, c.text, c.role from h join conversations c on c.conv_id = h.book_id and c.turn >= h.para_id and c.turn < h.para_id + 2),
    pend as (select distinct book_id, head_id from hp where role <> 'assistant'),
    w as (select hp.*, length(text) // 4 as t, row_number() over (partition by book_id, head_id order by para_id) as n from hp join pend using (book_id, head_id)),
    r as (select book_id, head_id, para_id, n, t as cur, 0 as chunk from w where n = 1 union all select w.book_id, w.head_id, w.para_id, w.n, case when r.cur + w.t > 150 then w.t else r.cur + w.t end, case when r.cur + w.t > 150 then r.chunk + 1 else r.chunk end
        from r join w on w.book_id = r.book_id and w.head_id = r.head_id and w.n = r.n + 1),
    body as (select r.book_id, r.head_id, r.chunk, min(r.para_id) as first_para, count(*) as lines, count(*) filter (where s.english is null) as pending,
        coalesce(to_json(list(struct_pack(para_id := s.para_id, line_id := s.line_id, pali := s.pali) order by s.para_id, s.line_id) filter (where s.english is null)), '[]') as sentences from r join s on s.book_id = r.book_id and s.para_id = r.para_id group by 1, 2, 3),
    tg as (select distinct w.book_id as of_book, w.head_id as of_para, dst_book, dst_para, dst_line from w join l on l.src_book = w.book_id and l.src_para = w.para_id),
    {", ".join(map(_commentary_sql, C.LABELS))},
    cm as (select p.book_id, p.head_id, coalesce(a.text, '') as a, coalesce(b.text, '') as b, coalesce(e.text, '') as e from pend p left join full_t a on a.of_book = p.book_id and a.of_para = p.head_id
        left join window_t b on b.of_book = p.book_id and b.of_para = p.head_id left join exact_t e on e.of_book = p.book_id and e.of_para = p.head_id),
    gw as (select book_id, head_id, [lower(x) for x in regexp_split_to_array(text, '[\\s,;.‘’\"''()\\[\\]]+') if length(x) > 1] as ws from w),
    tm as (select book_id, head_id, count(*) as terms from (select distinct book_id, head_id, pali, english from (select distinct book_id, head_id, array_to_string(ws[i:i + k - 1], ' ') as pali from gw, unnest(range(1, 6)) as x(k), unnest(range(1, len(ws) + 2 - k)) as y(i)) join gl using (pali)) group by 1, 2),
    dw as (select book_id, head_id, para_id, list_distinct([lower(x) for x in regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_ऀ-ॿ]{{5,}}')]) as d, [lower(x) for x in regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_ऀ-ॿ]{{5,}}')] as aw from w),
    dn as (select book_id, head_id, x as word, row_number() over (partition by book_id, head_id, para_id order by list_position(aw, x)) as k from dw, unnest(d) as u(x)),
    wd as (select book_id, head_id, count(distinct word) as words from dn join us using (word) where k <= 30 group by 1, 2)
    select *, {_filled_sql(PROMPT)} as prompt from (select body.book_id, body.head_id, cast(chunk as bigint) as chunk, first_para, lines, pending, cast(sentences as varchar) as sentences, coalesce(pv.text, '') as previous,
        cast(case when length(a) <= 1000 then 1 when length(b) <= 1000 then 2 else 3 end as integer) as tier,
        coalesce(nullif(case when length(a) <= 1000 then a when length(b) <= 1000 then b else e end, ''), '{C.NO_COMMENTARY}') as commentary, coalesce(terms, 0) as terms, coalesce(words, 0) as words
    from body join cm using (book_id, head_id) left join tm using (book_id, head_id) left join wd using (book_id, head_id)
    left join conversations pv on pv.conv_id = body.book_id and pv.turn = first_para - 1 and pv.role = 'assistant')"""


@query(_BUNDLE)
def context_bundle(t):
    return context_of(t)
