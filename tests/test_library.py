"""The library's queries against their SQL, and its operators on odd rows."""

import decimal
import random
import re
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.functions import parsing
from quarry.functions import text as T
from quarry.functions.roman import from_myanmar, to_roman
from quarry.operators import context as C
from quarry.operators import hierarchy as H
from quarry.operators import merge as M
from quarry.operators import paragraphs as P
from quarry.operators import search as S
from quarry.operators import tasks as K
from quarry.plans import registry
from quarry.plans.mapping import map_headings
from quarry.plans.queries import oracle_sql, queries
from quarry.sources import catalog
from quarry.sources.model import answered, embedded
from quarry.streaming import logs as L

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, duck):
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = [tuple(plain(x) for x in r) for r in df.select(*cols).collect()]
    if name in oracle_sql():
        found = duck.execute(oracle_sql()[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == cols
        want = [tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()]
        assert sorted(map(repr, rows)) == sorted(map(repr, want))


def one(spark, expression, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expression(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()[0]


def test_blank_and_case(spark):
    assert [one(spark, T.blank, x) for x in (None, "", "  ", "\t", " ", " a ")] == [True] * 5 + [False]
    assert one(spark, lambda c: T.icontains(c, "ānāpāna"), "ĀNĀPĀNA")
    assert not one(spark, lambda c: T.icontains(c, "ānāpāna", ascii_only=True), "ĀNĀPĀNA")
    assert not one(spark, lambda c: T.icontains(c, "a%b_"), "axxb1")
    assert one(spark, lambda c: T.icontains(c, "a%b_", wildcards=True), "axxb1")
    assert one(spark, lambda c: T.icontains(c, "\\d"), "x\\dy") and one(spark, lambda c: T.icontains(c, "\\d", wildcards=True), "x\\dy")


def model_pieces(text):
    return re.split(r"[\s,;.‘’\"'()\[\]]+", text)


def test_tokens_and_ngrams_like_a_model(spark):
    rng = random.Random(3)
    texts = ["", "a‘b’c “d” e–f? g hij klm", "école ĀN ānā (x) [yy] zzz"]
    texts += ["".join(rng.choice("abĀñé ,;.'\"()[]  ‘?-") for _ in range(60)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", T.tokens(F.col("t")).alias("a"), T.ngrams(F.col("t")).alias("b"), T.word_count(F.col("t")).alias("n")).collect()
    for r in got:
        text = texts[r.i]
        assert set(r.a) == {x.lower() for x in model_pieces(text) if 2 < len(x) < 40}
        w = [x.lower() for x in model_pieces(text) if len(x) > 1]
        assert set(r.b) == {" ".join(w[i : i + n]) for n in range(1, 6) for i in range(len(w) - n + 1)}
        assert r.n == len(text.split())


def test_chunks_like_a_model(spark):
    rng = random.Random(4)
    rows = [(b, p, rng.choice([0, 3, 10, 25, 40])) for b in range(20) for p in range(rng.randint(1, 15))]
    got = P.chunk_paragraphs(spark.createDataFrame(rows, "book_id long, para_id long, tokens long"), 30).collect()
    want, state = {}, {}
    for b, p, t in rows:
        cur, chunk, any_ = state.get(b, (0, 0, False))
        cur, chunk = (t, chunk + 1) if any_ and cur + t > 30 else (cur + t, chunk)
        state[b] = cur, chunk, True
        want[b, p] = chunk
    assert {(r.book_id, r.para_id): r.chunk for r in got} == want


def test_reference_block(spark):
    block = lambda p, e, n: one(spark, lambda a, b: T.reference_block(a, b, n), p, e)
    assert block(" aṁ ", " x ", -1) == "[Pāli] aṃ\n\n[English] x"
    assert block("a" * 90, "x" * 40, 40) == f"[Pāli] ... [truncated]\n\n[English] {'x' * 40}"
    assert block("a" * 90, "x", 60) == f"[Pāli] {'a' * 25} … [truncated]\n\n[English] x"
    assert block(None, None, 100) == "[Pāli] \n\n[English] "


def test_gloss_format(spark):
    gloss = lambda x: one(spark, T.gloss_format, x)
    assert gloss(None) == gloss("") == gloss("[]") == "(none)"
    assert gloss(" plain ") == "plain" and gloss("[bad") == "[bad"
    assert gloss('[{"pali": "a", "meaning": "b"}, 4, "x", {"note": "n"}, {"pali": "c"}, {"meaning": "d"}, {"pali": "e", "note": "n"}]') == "a: b | [Note: n] | c | d | e"


def test_salvage():
    assert [parsing.strip_fences(x) for x in ("```json\n[1]\n```", "``` [1] ```", "[1]\n```", "```\n[1]", " a `b` ", None, "```")] == ["[1]", "[1]", "[1]", "[1]", "a `b", "", ""]
    whole = '[{"pali": "a", "english": "}"}, {"pali": "b", "english": "c"}]'
    assert [x["pali"] for x in parsing.salvage_list(f"```json\n{whole}\n```")] == ["a", "b"]
    assert [x["pali"] for x in parsing.salvage_list(whole[:-5])] == ["a"]
    assert parsing.salvage_list("none") == parsing.salvage_list(None) == []
    assert parsing.parse_response('{"translations": [{"line_id": 1}], "other": 2}') == {"translations": [{"line_id": 1}], "glossary": []}
    cut = '{"translations": [{"line_id": 1}, {"line_id": 2}], "glossary": [{"pali": "x"}, {"pa'
    assert parsing.parse_response(cut) == {"translations": [{"line_id": 1}, {"line_id": 2}], "glossary": [{"pali": "x"}]}
    assert parsing.parse_mapping('```\n{"1": "a}", "-2": null}\n```') == {"1": "a}", "-2": None}
    assert parsing.parse_mapping('{"1": "a"} {"2"') == {"1": "a"} and parsing.parse_mapping("x") is None


def test_paths(spark):
    rows = [(1, -1, "r"), (2, 1, "a"), (3, 2, None), (4, 99, "o"), (5, None, "n"), (6, 7, "x"), (7, 6, "y"), (8, 7, "z")]
    rows += [(100 + i, 99 + i if i else -1, str(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, parent long, title string")
    got = {r.id: (r.level, r.path) for r in H.heading_paths(df).collect()}
    assert got[3] == (2, "r > a > ") and got[4] == (0, "o") and got[5] == (0, "n")
    assert got[139] == (39, " > ".join(map(str, range(40)))) and not {6, 7, 8} & got.keys()
    assert max(r.level for r in H.heading_paths(df, most_level=10).collect()) == 9


LINES = "book_id long, para_id long, line_id long, pali string, english string"


def lines(spark):
    rows = [(1, 1, 0, "a", None), (1, 1, 2, " ", "x"), (1, 2, 0, "b", " "), (1, 4, 0, None, "y"), (1, 4, 1, "c", "z"), (2, 1, 0, "d", "w")]
    return spark.createDataFrame(rows, LINES)


def test_paragraphs(spark):
    got = {(r.book_id, r.para_id): r for r in P.get_paragraph(lines(spark), "all").collect()}
    assert got[1, 1].pali == "a\n " and got[1, 4].pali == "c" and got[1, 4].english == "y\nz" and got[1, 4].word_count == 2
    got = P.paragraph_range(lines(spark), 1, 4, "pali").filter("book_id = 1").collect()
    assert {r.para_id: (r.pali, r.line_count) for r in got} == {1: ("a\n", 2), 2: ("b", 1), 4: ("c", 2)}
    every = P.paragraph_range(lines(spark), 1, 2, "ALL").columns
    assert every == ["book_id", "para_id", *P.LANGUAGES, "line_count"] and "english" in P.get_paragraph(lines(spark), "klingon").columns
    pages = lines(spark).withColumns({"vietnamese": F.upper("pali"), "thaipage": F.concat(F.lit("t"), "line_id"), "vripage": F.when(F.col("line_id") > 0, "v")})
    got = {(r.book_id, r.para_id): r for r in P.get_paragraph(pages, "vietnamese").collect()}
    assert (got[1, 4].vietnamese, got[1, 4].word_count, got[1, 4].thaipage, got[1, 4].vripage, got[1, 4].ptspage) == ("C", 1, "t0", "", "")
    before = {(r.book_id, r.para_id): r.previous for r in P.previous_paragraph(P.get_paragraph(lines(spark), "english")).collect()}
    assert before == {(1, 1): "", (1, 2): "x", (1, 4): "", (2, 1): ""}
    stats = P.book_stats(lines(spark), spark.createDataFrame([(1,), (9,)], "book_id long")).orderBy("book_id").collect()
    assert [tuple(r) for r in stats] == [(1, "", "", "", 3, 5, 1, 4), (9, "", "", "", 0, 0, None, None)]
    named = spark.createDataFrame([(1, "n", None, "s"), (9, "m", "k", None)], "book_id long, book_name string, nikaya string, sub_nikaya string")
    stats = P.book_stats(lines(spark), named).orderBy("book_id").collect()
    assert [tuple(r)[:5] for r in stats] == [(1, "n", "", "s", 3), (9, "m", "k", "", 0)]
    empty = lines(spark).limit(0)
    assert P.get_paragraph(empty).count() == P.chunk_paragraphs(empty.withColumn("tokens", F.lit(1)), 5).count() == 0


@pytest.mark.parametrize("length, want", [(None, False), (0, False), (1, False), (2, True), (99, True)])
def test_pending_ranges(spark, length, want):
    heads = spark.createDataFrame([(1, 4, length), (1, 3, length)], "book_id long, para_id long, chapter_len int")
    todo = spark.createDataFrame([(1, 5, 0, "a", None)], LINES)
    got = C.pending_headings(heads, todo).collect()
    assert any(r.para_id == 4 for r in got) == want
    assert C.pending_headings(heads, todo, overwrite=True).count() == 2
    named = spark.createDataFrame([(1, 4, 2, "a"), (1, 3, 3, ""), (1, 2, 4, None), (2, 4, 2, "a"), (1, 5, 1, "b")], "book_id long, para_id long, chapter_len int, sc_id string")
    found = lambda **how: [(r.book_id, r.para_id) for r in C.pending_headings(named, todo, **how).collect()]
    assert found() == [(1, 4), (1, 5)] and found(sc_id="a") == [(1, 4)] and found(sc_id="") == [(1, 3)] and found(book_id=2) == []
    assert found(overwrite=True) == [(1, 4), (1, 5), (2, 4)] and found(overwrite=True, book_id=2) == [(2, 4)]


@pytest.mark.parametrize("most, tier", [(0, 1), (10**6, 1), (125, 2), (60, 3)])
def test_commentary_tiers(spark, most, tier):
    s = spark.createDataFrame([(7, 1, i, "text " * 3, None) for i in range(12)], LINES)
    groups = spark.createDataFrame([(1,), (2,)], "of long")
    targets = spark.createDataFrame([(1, 7, 1, 5)], "of long, dst_book long, dst_para long, dst_line long")
    got = {r.of: r for r in C.commentary_tiered(groups, targets, s, most).collect()}
    assert got[1].tier == tier and got[2].commentary == C.NO_COMMENTARY
    assert got[1].commentary.count("\n  [") == {1: 12, 2: 3, 3: 1}[tier]


def test_batches_of_clustered_and_textual_keys(spark):
    rng = random.Random(6)
    ids = [rng.randrange(50) + 10**12 * (k % 9 == 0) for k in range(400)]
    got = P.fixed_batches(spark.createDataFrame([(i,) for i in ids], "k long"), "k", 30).collect()
    assert sorted((r.k, r.batch) for r in got) == sorted((k, i // 30) for i, k in enumerate(sorted(ids)))
    names = spark.createDataFrame([(f"n{i:03d}",) for i in range(100)], "k string")
    assert sorted((r.k, r.batch) for r in P.fixed_batches(names, "k", 7).collect()) == [(f"n{i:03d}", i // 7) for i in range(100)]
    assert P.fixed_batches(names.limit(0), "k", 7).count() == 0


def test_grams_like_a_model(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("alpha beta gamma Delta eps x".split())
    texts = [" ".join(word() for _ in range(rng.randrange(14))) for _ in range(40)] + ["", None]
    heads = {" ".join(word().lower() for _ in range(rng.randint(1, 6))) for _ in range(60)}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = C.gram_overlap(df, "t", spark.createDataFrame([(h, len(h)) for h in heads] * 2, "pali string, n int"), ["i"]).collect()
    want = []
    for i, text in enumerate(texts):
        w = [x.lower() for x in (text or "").split() if len(x) > 1]
        want += [(i, g, len(g)) for g in {" ".join(w[a : a + n]) for n in range(1, 6) for a in range(len(w) - n + 1)} & heads]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_tiers_by_length_are_those_of_the_texts(spark):
    rng = random.Random(9)
    rows = [(b, p, i, rng.choice([None, "", "x " * rng.randrange(30), "ü§"]), None) for b in range(9, 12) for p in range(4) for i in range(rng.randrange(7))]
    s = spark.createDataFrame(rows, LINES)
    targets = [(g, rng.randrange(9, 12), rng.randrange(5), rng.randrange(8)) for g in range(40) for _ in range(rng.randrange(5))]
    targets = spark.createDataFrame(list(dict.fromkeys(targets)), "of long, dst_book long, dst_para long, dst_line long")
    groups = spark.range(40).withColumnRenamed("id", "of")
    texts = {tier: {r.of: r.text for r in C.commentary(targets, s, tier).collect()} for tier in C.LABELS}
    for most in (0, 70, 150, 400):
        for r in C.commentary_tiered(groups, targets, s, most).collect():
            shown = [texts[t].get(r.of, "") for t in C.LABELS]
            tier = 1 if most <= 0 or len(shown[0]) <= most else 2 if len(shown[1]) <= most else 3
            assert (r.tier, r.commentary) == (tier, shown[tier - 1] or C.NO_COMMENTARY)


def test_samples_are_drawn_by_a_hash(spark):
    heads = spark.createDataFrame([(1, i, 1, f"s{i}" if i % 5 else "") for i in range(40)], "book_id long, para_id long, chapter_len int, sc_id string")
    s = spark.createDataFrame([(1, i, k, f"w{k}", None) for i in range(40) for k in range(3)], LINES)
    none = spark.createDataFrame([], "book_id long, para_id long, line_id long, content string, channel_id string")
    refs = spark.createDataFrame([("s7", "name", "p", "e")], "sc_id string, sutta_name string, palitext string, entext string")
    draw = lambda n, seed: {r.head_id for r in C.sampled_context(heads, s, refs, none, 2, n, seed).collect()}
    assert draw(None, 1) == {i for i in range(40) if i % 5} and len(draw(9, 1)) == 9 and draw(9, 1) == draw(9, 1) != draw(9, 2)
    whole = {r.head_id: r for r in C.sampled_context(heads, s, refs, none, 2).collect()}
    assert (whole[7].n_sentences, whole[7].sutta_name, whole[7].block) == (2, "name", "[7/0] w0 = (none)\n[7/1] w1 = (none)") and whole[8].sutta_name == "s8"
    # the query's order, by the hash function of another library
    heads = spark.read.parquet(f"{SF}/conversations.parquet").filter("role = 'user'").collect()
    first = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    signed = lambda x: x - (x >> 63 << 64)
    order = sorted((signed(xxhash.xxh64_intdigest(r.conv_id.to_bytes(8, "little"), first)), r.conv_id) for r in heads)
    assert sorted(r.book_id for r in queries()["sample_headings"](spark, SF).collect()) == sorted(i for _, i in order[:30])


def test_merges(spark):
    rows = spark.createDataFrame([(1, " a ", "b"), (2, "a", "b"), (3, "", "b"), (4, None, "c"), (5, "d", "e")], "n int, pali string, english string")
    have = spark.createDataFrame([("d", "e")], "pali string, english string")
    assert [tuple(r) for r in M.insert_if_absent(have, rows, ["pali", "english"], "n").select("n", "pali").collect()] == [(1, "a")]
    marks = spark.createDataFrame([("1", "x"), ("-2", "y"), ("a3", "x"), ("4", "zz"), ("5", None)], "k string, v string")
    valid = spark.createDataFrame([("x",), ("y",)], "v string")
    assert {r.k: r.v for r in M.validate_mapping(marks, valid, "k", "v").collect()} == {"1": "x", "-2": "y", "4": None, "5": None}
    asked = spark.createDataFrame([("1", 0), ("7", 0), ("8", 1)], "k string, batch int")
    filled = M.with_omitted(M.validate_mapping(marks, valid, "k", "v"), asked, ["k"], "v", ["batch"])
    assert {(r.k, r.batch, r.v) for r in filled.collect()} == {("1", 0, "x"), ("7", 0, None), ("8", 1, None), ("-2", None, "y"), ("4", None, None), ("5", None, None)}
    assert {tuple(r) for r in M.mapped_counts(filled, ["batch"], "v").collect()} == {(0, 2, 1), (1, 1, 0), (None, 3, 1)}
    table, more = spark.createDataFrame([("a", "1")], "k string, v string"), spark.createDataFrame([("0", "a"), ("2", "b")], "v string, k string")
    assert {tuple(r) for r in M.with_defaults(table, more, ["k"]).collect()} == {("a", "1"), ("b", "2")}
    writes = spark.createDataFrame([("a", "1", 1), ("a", None, 2), ("b", "2", 3)], "k string, v string, n int")
    assert {r.k: r.v for r in M.last_write(writes, ["k"], "v", "n").collect()} == {"a": None, "b": "2"}


def test_candidates_are_dealt_by_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(M, "TILE", 8, raising=False)
    monkeypatch.setattr(M, "TASK_PAIRS", 500, raising=False)
    heads = [("long", i) for i in range(120)] + [("b", 7)] * 3 + [("c", None), (None, 1), ("bare", 1)]
    refs = [("long", str(i)) for i in range(150)] + [("b", "x")] * 2 + [("c", None), (None, "y"), ("none", "z")]
    # both in one partition, as a table in one small file is
    headings = spark.createDataFrame(heads, "book_id string, para_id int").coalesce(1)
    references = spark.createDataFrame(refs, "book_id string, sc_id string").coalesce(1)
    got = M.mapping_candidates(headings, references, "book_id")
    assert got.columns == ["book_id", "para_id", "sc_id"]
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    want = [(b, h, r) for b, h in heads for c, r in refs if b is not None and b == c]
    assert sorted(map(repr, (tuple(r)[:3] for r in rows))) == sorted(map(repr, want))
    assert max(Counter(r.task for r in rows).values()) < len(want) / 10
    assert M.mapping_candidates(headings.limit(0), references, "book_id").count() == 0


def test_queue(spark):
    schema = "id long, status string, priority int, created_at double, run_after double, started_at double, heartbeat_at double"
    rows = [(1, "pending", 5, 1.0, None, None, None), (2, "pending", 1, 3.0, 200.0, None, None), (3, "pending", 1, 2.0, 100.0, None, None)]
    rows += [(4, "running", 1, 1.0, None, 0.0, None), (5, "running", 1, 1.0, None, 0.0, 790.0), (6, "running", 1, 1.0, None, None, None), (7, "running", 1, 1.0, None, 700.0, None)]
    df = spark.createDataFrame(rows, schema)
    assert [r.id for r in K.next_task(df, 100).collect()] == [3] and K.next_task(df.filter("status = 'x'"), 1).count() == 0
    assert [r.id for r in K.stale(df, 1000).collect()] == [4]
    assert [r.id for r in S.page(df, ["id"], 2, 3).collect()] == [4, 5, 6]
    assert [r.id for r in K.startable(df, 300, 6).collect()] == [3, 2] and K.startable(df, 300, 4).count() == 0
    looks, begun = iter([df, df.limit(0), df]), []
    assert L.poll(lambda: K.startable(next(looks), 300, 5), lambda rows: begun.extend(r.id for r in rows), 0, 3) == 2 and begun == [3, 3]


def test_keys(spark):
    rows = [(1, "call", 1), (1, "exhausted", 2), (1, "cleared", 3), (1, "off", 4), (1, "on", 5), (2, "exhausted", 9), (2, "off", 1), (3, "call", 1), (3, "delete", 2)]
    rows += [(4, "delete", 1), (4, "call", 2), (4, "error", 3)]
    df = spark.createDataFrame([(k, t, i, w) for i, (k, w, t) in enumerate(rows)], "key_id int, ts long, event_id int, what string")
    got = {r.key_id: tuple(r)[1:] for r in K.key_flags(df).collect()}
    assert got == {1: (1, 1, None, 1), 2: (0, 1, 9, 0), 4: (1, 1, None, 1)}
    assert one(spark, T.id_list, " 3, 4,,5 ") == [3, 4, 5] and [one(spark, T.id_list, x) for x in (None, "", ",", "3,x")] == [None] * 4
    pool = spark.createDataFrame([(i, "g", 1, None if i < 4 else 1.0, i) for i in range(6)], "id long, provider string, is_active int, exhausted_at double, total_calls int")
    assert [r.id for r in K.next_key(pool, "g", [2, 3, 5]).collect()] == [2] and K.usable_keys(pool, "h").count() == 0
    assert K.usable_keys(K.after_model_change(pool, "a", "b")).count() == 6 and K.usable_keys(K.after_model_change(pool, "a", "a")).count() == 4
    bar = lambda *x: spark.createDataFrame([x], "d int, t int, e double").select(*(v.alias(k) for k, v in K.progress(*map(F.col, "dte")).items())).first()
    assert tuple(bar(5, 20, 10.0)) == (25.0, 0.5, 30) and bar(0, 20, 1.0).left_s is None and bar(20, 20, 1.0).left_s is None and bar(0, 0, 0.0).percent == 0


def test_gaps_of_each_key(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(4), 86_400 * rng.randrange(3) + rng.randrange(86_400)) for i in range(200)] + [(900, 9, 5)]
    df = spark.createDataFrame(rows, "id long, k int, s long").withColumn("ts", F.timestamp_seconds("s"))
    want, last = {}, {}
    for i, k, s in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = s - last[k] if k in last else None
        last[k] = s
    assert {r.id: r.gap_s for r in K.gaps(df, "ts", "k", "id").collect()} == want


def test_prompt_and_time(spark):
    df = spark.createDataFrame([("x{b}", None, 0.0)], "a string, b int, t double")
    assert df.select(T.filled("{a}-{b}-{a} {}", {"a": F.col("a"), "b": F.col("b")})).first()[0] == "x{b}--x{b} {}"
    assert df.select(T.local_time(F.col("t"))).first()[0] == "1970-01-01 00:00:00"


def test_model_answers(spark):
    def model():
        tries = {}

        def ask(prompt):
            tries[prompt] = tries.get(prompt, 0) + 1
            if prompt == "slow":
                raise TimeoutError
            if prompt == "bad" or prompt == "busy" and tries[prompt] < 3:
                raise ValueError("503 unavailable" if prompt == "busy" else "no such model")
            return prompt.upper()

        return ask

    df = spark.createDataFrame([(p,) for p in ("a", "busy", "bad", "slow", None)], "prompt string")
    got = {r.prompt: (r.raw, r.finish_reason) for r in answered(df, "prompt", model, wait_s=0).collect()}
    assert got == {"a": ("A", "STOP"), "busy": ("BUSY", "STOP"), "bad": (None, "ERROR: no such model"), "slow": (None, "TIMEOUT"), None: (None, None)}
    assert answered(df.limit(0), "prompt", model).count() == 0


def test_embeddings(spark):
    def model():
        def embed(texts):
            assert len(texts) <= 3
            return [[float(len(t)), 1.0] for t in texts]

        return embed

    df = spark.createDataFrame([(i, "x" * i if i % 4 else None) for i in range(20)], "i long, t string").coalesce(1)
    got = {r.i: r.embedding for r in embedded(df, "t", model, size=3, dim=2).collect()}
    assert got == {i: [float(i), 1.0] if i % 4 else None for i in range(20)}
    with pytest.raises(Exception, match="no vectors of 5"):
        embedded(df, "t", model, size=3, dim=5).collect()


def test_roman_letters(spark):
    words = {"ဗုဒ္ဓ": "buddha", "ဘိက္ခု": "bhikkhu", "သင်္ဃ": "saṅgha", "သံဃ": "saṃgha", "ပညာ": "paññā", "ဒေါသ": "dosa", "ဧကော": "eko", "တသ္မိံ ၁၂။": "tasmiṃ 12."}
    assert {w: from_myanmar(w) for w in words} == words
    roman = lambda x, **how: one(spark, lambda c: to_roman(c, **how), x)
    assert [roman(x) for x in ("dhammaïŏ", "Ābc ဗ", "ဗုဒ္ဓ", "", None, "ภาษา")] == ["dhammaïŏ", "Ābc ဗ", "buddha", "", "", "ภาษา"]
    assert roman("ဗ", convert=lambda t: "bïŏl̤") == "bioḷ" and roman("ဗ", convert=lambda t: 1 / 0) == "ဗ"


def test_mapping_resumes(spark, tmp_path):
    def model():
        def ask(prompt):
            book = re.search(r"book (\d+)", prompt)[1]
            ids = [x.split()[0] for x in prompt.split("Headings:\n")[1].split("\n\n")[0].split("\n")]
            if book == "2":
                return "no idea"
            assert set(ids) <= {"1", "2", "3", "4", "5"}
            return "```json\n{" + ", ".join(f'"{i}": "r{i}"' for i in ids if i != "4") + ', "x": "r1"}\n```'

        return ask

    heads = [(1, i, 1, f"t{i}", None) for i in range(1, 6)] + [(1, 9, 10, "deep", None), (2, 1, 1, "u", "old"), (3, 1, 1, "no reference", None)]
    heads = spark.createDataFrame(heads, "book_id long, para_id long, level int, title string, sc_id string")
    refs = spark.createDataFrame([(1, f"r{i}", "n") for i in (1, 2, 4)] + [(2, "r1", "n"), (2, "r3", None)], "book_id long, sc_id string, sutta_name string")
    books, cache = spark.createDataFrame([(1,), (2,), (3,)], "book_id long"), f"file://{tmp_path}/cache"
    _, sums = map_headings(heads, refs, model, cache, books, size=2, dry_run=True)
    assert {tuple(r) for r in sums.collect()} == {(1, 5, 5, 2), (2, 1, 1, 0)}
    broken = lambda: lambda prompt: (_ for _ in ()).throw(AssertionError("asked again"))
    new, sums = map_headings(heads, refs, broken, cache, books, book_id=1)
    assert {r.para_id: r.sc_id for r in new.filter("book_id = 1").collect()} == {1: "r1", 2: "r2", 3: None, 4: None, 5: None, 9: None}
    assert new.filter("book_id = 2").first().sc_id == "old" and [tuple(r) for r in sums.collect()] == [(1, 5, 5, 2)]
    _, sums = map_headings(heads, refs, lambda: lambda p: "{}", cache, books, reset=True)
    assert {tuple(r) for r in sums.collect()} == {(1, 5, 5, 0), (2, 1, 1, 0)}
    with pytest.raises(ValueError, match="unknown book"):
        map_headings(heads, refs, model, cache, books, book_id=77)


def test_catalog(spark, tmp_path):
    c = catalog.CorpusCatalog(spark, f"file://{tmp_path}/corpus")
    c.append("settings", spark.createDataFrame([("a", "b", 1.0)], catalog.SCHEMAS["settings"]))
    assert c.table("settings").count() == 1 and c.optional("books").count() == 0 and "books" in c.missing() and "settings" not in c.missing()
    with pytest.raises(ValueError, match="no path"):
        catalog.CorpusCatalog(spark, "")
    catalog.append_jsonl(spark.createDataFrame([("ñ", 1)], "k string, n int"), f"file://{tmp_path}/x")
    assert catalog.read_jsonl(spark, f"file://{tmp_path}/x", "k string, n int").first().k == "ñ"
    assert catalog.read_jsonl(spark, f"file://{tmp_path}/none", "k string").count() == 0
    c.append("sentences", spark.createDataFrame([("b", 1, 0, "p", "e f", None, "t", None, "s")], catalog.SCHEMAS["sentences"]))
    assert P.get_paragraph(c.sentences(), "all").first().asDict() == {
        "book_id": "b", "para_id": 1, "pali": "p", "english": "e f", "vietnamese": "", "line_count": 1, "word_count": 2, "thaipage": "t", "vripage": "", "ptspage": "s"
    }
    state = f"file://{tmp_path}/state"
    assert catalog.load_state(spark, state, "k string, n int").count() == 0
    for n in (1, 2):
        catalog.save_state(spark.createDataFrame([("ñ", n)], "k string, n int"), state)
    assert [tuple(r) for r in catalog.load_state(spark, state, "k string, n int").collect()] == [("ñ", 2)]
    sent = spark.createDataFrame([("c1_prompt", "line\nü"), ("c1_answer", None), ("c2_prompt", "z")], "name string, body string")
    catalog.append_texts(sent.filter("body is not null"), f"file://{tmp_path}/log", "name", "body")
    assert spark.read.text(f"file://{tmp_path}/log", wholetext=True).filter("name = 'c1_prompt'").first().value.strip() == "line\nü"


def test_registry(spark):
    t = lines(spark)
    found = registry.call("get_paragraph", {"book_id": 1, "para_id": 4}, {"sentences": t})
    assert found["count"] == 1 and found["rows"][0]["english"] == "y\nz"
    assert "error" in registry.call("no such tool", {}, {}) and "error" in registry.call("get_paragraph", {"book_id": 1}, {"sentences": t})


def test_conversation(spark):
    t = lines(spark)
    turns = iter([{"text": "let me look", "calls": [{"name": "get_paragraph", "args": {"book_id": 1, "para_id": 4}}, {"name": "nope"}]}, {"text": " done "}])
    answer, calls = registry.converse(lambda messages: next(turns), "read it", {"sentences": t})
    assert answer == "done" and calls[0]["result"]["count"] == 1 and "error" in calls[1]["result"]
    endless = lambda messages: {"text": "more", "calls": [{"name": "nope"}] * 3}
    answer, calls = registry.converse(endless, "read it", {}, most_calls=4)
    assert answer == "more" and len(calls) == 6
    books = spark.createDataFrame([(1, "n", "k", "s")], "book_id long, book_name string, nikaya string, sub_nikaya string")
    assert registry.call("get_book_stats", {"book_id": 1}, {"sentences": t, "books": books})["rows"][0]["book_name"] == "n"
    assert registry.call("get_nearby_context", {"book_id": 1, "para_id": 2, "language": "pali"}, {"sentences": t})["count"] == 3
