"""Sharding, licence scan, mixing, packing and token shards against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
from tokenizers import Tokenizer

from quarry.llm.license_scan import Scanner, scan_licenses
from quarry.llm.mixing import mix, mixed_documents
from quarry.llm.packing import cut_windows, pack
from quarry.llm.sharding import communication_matrix, document_shards, shard_rows
from quarry.llm.sst import Reader, id_of, read_shards, write_shards
from tests.llm.cases import empty, odd

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(params=["odd", "sf0.001", "empty"])
def docs(request, spark):
    return {"odd": odd, "empty": empty, "sf0.001": lambda s: s.read.parquet(f"{SF}/documents.parquet")}[request.param](spark)


def test_matrix_has_the_sums_and_the_spread():
    m = np.array(communication_matrix([1000, 0, 37, 463], 7, 1))
    assert m.sum(1).tolist() == [1000, 0, 37, 463]
    assert sorted(m.sum(0).tolist()) == [214] * 5 + [215] * 2
    draws = np.array([communication_matrix([40, 60], 2, s)[0][0] for s in range(3000)])
    assert abs(draws.mean() - 20) < 0.2 and abs(draws.var() - 100 * 0.25 * 0.4 * 0.6 * 100 / 99) < 0.6


def test_sharding(docs):
    rows = docs.select("doc_id", "text").collect()
    got = document_shards(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1


def test_sharding_over_many_partitions_is_uniform(spark):
    got = shard_rows(spark.range(4000), shards=4, partition_rows=100).collect()
    assert Counter(r.shard for r in got) == Counter({s: 1000 for s in range(4)})
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(1000)) for s in range(4))
    ids = np.array([r.id for r in got])
    assert abs(np.corrcoef(ids, [r.shard for r in got])[0, 1]) < 0.06 and abs(np.corrcoef(ids, [r.slot for r in got])[0, 1]) < 0.06


def test_license_scan(docs):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for r, t in zip(scan_licenses(docs).collect(), docs.collect(), strict=True):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in t.text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        base = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in base]
        assert (r.doc_id, r.n_words, r.n_base) == (t.doc_id, len(words), len(base))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not base
        assert 0 <= r.score <= 1


def test_license_rules_overrule(spark):
    texts = {
        "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
        "No rights are given here.": "",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in scan_licenses(df).orderBy("doc_id").collect()] == list(texts.values())


def forms(tree):
    """Texts of a parsed pattern: every alternative, optional parts without and with."""
    texts = [""]
    for op, arg in tree:
        if op is re._constants.LITERAL:
            more = [chr(arg)]
        elif op is re._constants.IN:
            more = [chr(c) for _, c in arg]
        elif op is re._constants.NOT_LITERAL:
            more = ["x"]
        elif op is re._constants.BRANCH:
            more = [x for t in arg[1] for x in forms(t)]
        elif op is re._constants.SUBPATTERN:
            more = forms(arg[3])
        else:
            low, high, part = arg
            more = [x * n for x in forms(part) for n in {low, max(low, min(high, 1))}]
        texts = [a + b for a in texts for b in dict.fromkeys(more)]
    return texts


def test_license_gate_loses_no_form():
    scanner = Scanner()
    every = set(scanner.by_keyword)
    for r in scanner.rules:
        for text in forms(re._parser.parse(r.pattern.pattern.removeprefix(" ").removesuffix("(?= )"))):
            assert r.pattern.search(f" {text} ")
            words = f" so {text} it is "
            free = [(x.label, words.count(" ", 0, a), words.count(" ", a, b)) for a, b, x in scanner.detections(words, every)]
            assert free and scanner.scan(words)[-1] == free, (r, text)


def test_license_spans_like_brute_force():
    """Of spans in the order of priority, length and rules, each is kept that no kept one covers."""
    scanner, rng = Scanner(), np.random.default_rng(21)
    some = [forms(re._parser.parse(r.pattern.pattern.removeprefix(" ").removesuffix("(?= )")))[:3] for r in scanner.rules]
    for _ in range(150):
        parts = [str(rng.choice(some[int(rng.integers(len(some)))])) for _ in range(int(rng.integers(1, 9)))]
        words = f" {' '.join(parts)} "
        keywords = {k for _, k in scanner.gate.iter(words)}
        every = [(-r.priority, m.start() - m.end(), i, m.start(), m.end()) for i, r in enumerate(scanner.rules) for m in r.pattern.finditer(words)]
        kept = []
        for s in sorted(every):
            if not any(k[3] <= s[3] and s[4] <= k[4] for k in kept):
                kept.append(s)
        got = scanner.detections(words, keywords)
        assert [(a, b, r) for a, b, r in got] == sorted(((k[3], k[4], scanner.rules[k[2]]) for k in kept), key=lambda d: d[:2])


def test_license_forms_beside_the_usual(spark):
    texts = {
        "SPDX-License-Identifier: MIT": "mit",
        "SPDX-License-Identifier: ISC": "isc",
        "distributed under the terms of the GPL": "gpl",
        "zlib/libpng License": "libpng,zlib",
        "NCSA Open Source License": "ncsa",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.labels for r in scan_licenses(df).orderBy("doc_id").collect()]
    assert [set(t.split(",")) <= set(g.split(",")) for t, g in zip(texts.values(), got, strict=True)] == [True] * 5, got


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (budget - sum(2 * sizes[s] for s in capped)) / max(1e-9, sum(weight[s] for s in names if s not in capped))
        more = {s for s in names if s not in capped and 2 * sizes[s] < level * weight[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= more


def test_mixing(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r.source] += count(r.text)
    got = mix(docs, block_rows=8, fan_in=3).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r.doc_id, count(r.text)) for r in rows)
    want, taken, longest = brute_targets(sizes) if sizes else {}, Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in sizes)
    again = mix(docs.repartition(3), block_rows=8, fan_in=3).collect()
    key = lambda r: (r.doc_id, r["size"], r.taken)
    assert Counter(map(key, again)) == Counter(map(key, got))
    copies = Counter(r.text for r in mixed_documents(docs, block_rows=8, fan_in=3).collect())
    assert sum(count(t) * n for t, n in copies.items()) == sum(taken.values())


def test_mixing_of_many_equal_rows(spark):
    """A third of the rows are one document: they are one group, whose copies are shared out, and the words still come near the targets."""
    rows = [(5, "w " * 9, "a")] * 12_000 + [(i, "w " * (1 + i % 40), "ab"[i % 2]) for i in range(1000, 25_000, 2)] + [(i, "x y z", "c") for i in range(31_000, 43_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(df, block_rows=500, fan_in=4).groupBy("doc_id", "source", "copies", "target").agg({"taken": "sum", "*": "count"}).collect()
    hot = {r.copies: r["count(1)"] for r in got if r.doc_id == 5}
    assert sum(hot.values()) == 12_000 and set(hot) <= {0, 1, 2} and len(hot) <= 2
    taken = Counter()
    for r in got:
        taken[r.source, r.target] += r["sum(taken)"]
    assert all(abs(n - target) <= 40 for (_, target), n in taken.items())
    copies = Counter(r.doc_id for r in mixed_documents(df, block_rows=500, fan_in=4).collect())
    assert copies[5] == sum(c * n for c, n in hot.items()) and max(n for i, n in copies.items() if i != 5) <= 2


def test_rounding_keeps_expectations(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), "a" if i % 3 else "b") for i in range(60)], "doc_id long, text string, source string")
    rate, n = None, Counter()
    for seed in range(10):
        for r in mix(df, seed=seed, block_rows=10).collect():
            n[r.doc_id] += r.copies
            rate = r.target / r.source_size if r.source == "a" else rate
    mean = sum(n[i] for i in range(60) if i % 3) / 40 / 10
    assert abs(mean - rate) < 0.1


TOKENIZER = Tokenizer.from_file(PATH)


def whole(text, end):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("chunk", [1 << 19, 6000])
def test_packing(docs, chunk):
    got = pack(docs, PATH, chunk=chunk).collect()
    want = Counter()
    tokens = {}
    for r in docs.select("doc_id", "text").collect():
        ids = whole(r.text, 2)
        want[r.doc_id] += len(ids)
        tokens.setdefault(r.doc_id, []).append(ids)
    have, sequences = Counter(), defaultdict(list)
    for r in got:
        have[r.doc_id] += r.length
        assert any(len(t) == r.doc_tokens and crc(t[r.start : r.start + r.length]) == r.ids_crc32 for t in tokens[r.doc_id])
        sequences[r.sequence_id].append(r)
    assert have == want
    order = []
    for s in sorted(sequences):
        at = 0
        for r in sorted(sequences[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
            order.append((r.doc_id is not None, r.doc_id or 0))
        assert at <= 4096
    assert order == sorted(order)
    if sum(want.values()) > 100_000 and chunk > 6000:
        assert 4096 * len(sequences) < 1.03 * sum(want.values()) + 4096


def test_cuts_are_the_best():
    rng = np.random.default_rng(3)
    for _ in range(200):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 6, 14))])
        cost = rng.integers(0, 4, 15)
        best = [0] + [10**9] * 14
        for k in range(1, 15):
            best[k] = min(best[i] + 9 - (at[k] - at[i]) + cost[k] for i in range(k) if at[k] - at[i] <= 9)
        cuts = cut_windows(at, cost, 9)
        assert all(at[b] - at[a] <= 9 for a, b in zip(cuts, cuts[1:], strict=False))
        assert sum(9 - (at[b] - at[a]) + cost[b] for a, b in zip(cuts, cuts[1:], strict=False)) == best[14]


def test_token_shards(docs, spark, tmp_path):
    manifest = write_shards(docs, f"file://{tmp_path}/out", PATH)
    got = read_shards(manifest).orderBy("start").collect()
    rows = docs.select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (r.doc_id, len(ids := whole(r.text, 1)), crc(ids)) for r in rows
    )
    at, last = 0, None
    for r in got:
        key = (r.doc_id is not None, r.doc_id or 0)
        assert r.start == at and (last is None or last <= key)
        at, last = at + r.n_tokens, key
    texts = {r.doc_id: r.text for r in rows}
    fs = pyarrow.fs.LocalFileSystem()
    for m in manifest.collect():
        with fs.open_input_file(m.path.removeprefix("file://")) as f:
            reader = Reader(f)
            assert (reader.docs, reader.tokens) == (m.docs, m.tokens)
            found = {i: reader.get(i) for i in texts}
            assert sum(x is not None for x in found.values()) == len({id_of(k) for k, _ in reader})
            single = [i for i in found if sum(r.doc_id == i for r in rows) == 1]
            assert all(x.tolist() == whole(texts[i], 1) for i, x in found.items() if x is not None and i in single)
            assert reader.get(10**15) is None and reader.get(-(10**15)) is None


def test_files_of_bounded_size(spark, tmp_path):
    """A range with very many rows of one doc_id, cut into files; the rows stay in order and can be looked up."""
    rows = [(7 if i % 3 else i, f"row {i} of some words") for i in range(900)] + [(None, "x y")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = write_shards(df, f"file://{tmp_path}/out", PATH, range_bytes=4000, file_docs=40)
    files = manifest.orderBy("shard", "file").collect()
    assert max(m.docs for m in files) <= 40 and len({m.shard for m in files}) > 3 and sum(m.docs for m in files) == 905
    got = read_shards(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    sevens = [crc(whole(t, 1)) for i, t in rows if i == 7]
    assert [r.ids_crc32 for r in got if r.doc_id == 7] == sevens
    small = write_shards(df, f"file://{tmp_path}/small", PATH, range_bytes=4000, file_bytes=100)
    assert small.count() > 100 and read_shards(small).agg({"n_tokens": "sum"}).first()[0] == sum(r.n_tokens for r in got)


def test_many_rows_of_one_id_are_packed_in_several_ranges(spark):
    df = spark.createDataFrame([(3, f"words of row {i} " * 5) for i in range(400)], "doc_id long, text string")
    got = pack(df, PATH, block_bytes=8000).collect()
    assert sum(r.length for r in got) == sum(len(whole(r.text, 2)) for r in df.collect())
    assert len({r.sequence_id >> 32 for r in got}) > 2


def test_another_tokenizer_encodes_whole_texts():
    from quarry.llm.tokens import Encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    other, word = Encoder(path), Encoder(PATH)
    assert word.parted and not other.parted
    text = "Two  words, and\n\nmore: don't \u03a3 1234"
    for tokens in (other, word):
        ids = np.frombuffer(tokens.ids(text), dtype="<u4").tolist()
        assert ids == tokens.tokenizer.encode(text, add_special_tokens=False).ids
