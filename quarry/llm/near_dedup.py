"""Near-duplicates by ProbMinHash signatures, banding and verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.shared import discard, fingerprint, partitions, stage

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The finalizer constants of the SplitMix64 generator.
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Shingles(dict):
    """64-bit keys of a text's shingles; the hashes of words are kept, up to a limit."""

    def __init__(self, size: int, limit: int = 300_000):
        super().__init__()
        self.size, self.limit = size, limit

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= self.limit:
            self.clear()
        self[word] = h
        return h

    def of(self, text: str | None) -> np.ndarray:
        """With repeats. Words are parted at white space and folded; of fewer words than a shingle has, all are one shingle."""
        words = text.lower().split() if text else []
        if not words:
            return np.empty(0, dtype=np.uint64)
        w = np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(w))
        out = w[: len(w) - size + 1].copy()
        for i in range(1, size):
            out = out * _ODD + w[i : len(w) - size + 1 + i]
        return _mix(out)


def prob_minhash(keys: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """For each of m registers the key whose event reached it first.

    Each key has a Poisson process of events with its weight as rate; an event goes to a random
    register. All events come from the key alone, so two sets agree in a register with the
    probability Jaccard similarity of their weights. Events are made in rounds, the first of all keys
    at once; a key stops as soon as its last event is later than the latest register.
    """
    first = np.full(m, np.inf)
    owner = np.zeros(m, dtype=np.uint64)
    time = np.zeros(len(keys))
    done = np.uint64(0)
    # so many events at a time that few rounds are needed for short texts
    width = max(1, min(64, int(1.2 * m * np.log(m) / len(keys))))
    with np.errstate(over="ignore"):
        while len(keys):
            nth = np.arange(1, width + 1, dtype=np.uint64) + done
            r = _mix(keys[:, None] + nth[None, :] * _ODD)
            at = time[:, None] + np.cumsum(-np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53), axis=1) / weights[:, None]
            to = (_mix(r ^ _MIX[0]) % np.uint64(m)).astype(np.int64)
            flat, where = at.ravel(), to.ravel()
            early = np.flatnonzero(flat < first.max())
            # the earliest event of each register, by a sort of registers and times
            early = early[np.lexsort((flat[early], where[early]))]
            regs = where[early]
            head = np.flatnonzero(np.concatenate([[True], regs[1:] != regs[:-1]])) if len(regs) else regs
            best, regs = early[head], regs[head]
            win = flat[best] < first[regs]
            first[regs[win]] = flat[best[win]]
            owner[regs[win]] = keys[best[win] // width]
            time = at[:, -1]
            on = time < first.max()
            keys, weights, time = keys[on], weights[on], time[on]
            done += np.uint64(width)
            width = max(1, min(64, int(0.5 * m / max(1, len(keys)))))
    return owner


def band_keys(owner: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of `rows` registers."""
    bands = owner.reshape(-1, rows)
    out = np.arange(1, len(bands) + 1, dtype=np.uint64) * _MIX[1]
    for i in range(rows):
        out = _mix(out * _ODD + bands[:, i])
    return out


class Homes:
    """The shingle sets of some nodes, with the nodes that hold each shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        keys = np.concatenate(sets)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def similar(self, other: np.ndarray, similarity: float) -> np.ndarray:
        """Which nodes' sets are similar enough to another set."""
        low, high = (np.searchsorted(self.keys, other, side=x) for x in ("left", "right"))
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(self.owners[at], minlength=len(self.sizes))
        return np.flatnonzero(both >= similarity * (self.sizes + len(other) - both))


def _joins(batches: Iterator[pa.RecordBatch], shingle: int, similarity: float) -> Iterator[tuple[int, int]]:
    """Of rows sorted by (h, chunk, prober), the pairs of components that similar nodes join, each as soon as it is found."""
    shingles, key = Shingles(shingle), None
    sets: list[np.ndarray] = []
    roots: list[int] = []
    homes: Homes | None = None
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("h", "chunk", "prober", "root")]
        for h, chunk, prober, own, text in zip(*cols, batch.column("text"), strict=True):
            if key != (h, chunk):
                key, sets, roots, homes = (h, chunk), [], [], None
                up.clear()
            mine = np.unique(shingles.of(text.as_py()))
            if not prober:
                sets.append(mine)
                roots.append(own)
            elif sets:
                homes = homes or Homes(sets)
                for i in homes.similar(mine, similarity):
                    a, b = root(roots[i]), root(own)
                    if a != b:
                        up[max(a, b)] = min(a, b)
                        yield max(a, b), min(a, b)


class Signed:
    """Some nodes of a bucket with their components, signatures and band keys."""

    def __init__(self, rows: list[tuple], m: int):
        self.nodes, self.roots = (np.array([r[k] for r in rows]) for k in (0, 1))
        self.sigs = np.frombuffer(b"".join(r[2] for r in rows), dtype=np.uint8).reshape(-1, m)
        self.bands = np.array([r[3] for r in rows], dtype=np.int64)

    def likely(self, i: int, other: Signed, h: int, least: int) -> np.ndarray:
        """Which of other's nodes, of another component, may be similar to node i and share no band before h with it."""
        at = np.flatnonzero(other.roots != self.roots[i])
        at = at[(other.sigs[at] == self.sigs[i]).sum(axis=1) >= least]
        same = other.bands[at] == self.bands[i]
        return at[other.bands[at, same.argmax(axis=1)] == h] if len(at) else at


def _likely(batches: Iterator[pa.RecordBatch], m: int, least: int, homes_each: int, step: int = 1024) -> Iterator[tuple]:
    """Of rows sorted by (h, chunk, prober), the homes and probers that have a likely partner: (h, chunk, prober, node, root).

    Chunks are numbered anew, with homes_each homes at most, and a prober is in those with a partner of its own.
    """
    key, homes, waiting = None, [], []
    used: dict[int, int] = {}

    def compare() -> Iterator[tuple]:
        home, more = Signed(homes, m), Signed(waiting, m)
        for i in range(len(waiting)):
            at = more.likely(i, home, key[0], least)
            for j in at.tolist():
                if j not in used:
                    used[j] = len(used)
                    yield key[0], key[1] * 2**31 + used[j] // homes_each, False, int(home.nodes[j]), int(home.roots[j])
            for part in {used[j] // homes_each for j in at.tolist()}:
                yield key[0], key[1] * 2**31 + part, True, int(more.nodes[i]), int(more.roots[i])
        waiting.clear()

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("h", "chunk", "prober", "node", "root", "sig", "bands")]
        for h, chunk, prober, *row in zip(*cols, strict=True):
            if key != (h, chunk):
                if waiting and homes:
                    yield from compare()
                key, homes, waiting = (h, chunk), [], []
                used.clear()
            if prober:
                waiting.append(row)
            else:
                homes.append(row)
            if len(waiting) >= step:
                yield from compare()
    if waiting and homes:
        yield from compare()


SPOT = "h long, chunk long, prober boolean, node long, root long"


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds.values(), strict=True)], names=list(kinds))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    bands: int = 26,
    rows: int = 5,
    chunk_rows: int = 512,
    signed_rows: int = 2048,
) -> DataFrame:
    """One row for each row of docs: doc_id, class_id, kept, t1 and t2 (hashes of the text).

    Two documents are linked when the Jaccard similarity of their sets of word shingles is at least
    `similarity`; classes are the components of the links. class_id is the least doc_id of the class
    and kept marks one row of it, with that doc_id.

    Equal texts are one node. Each node has a ProbMinHash signature of its set of shingles, each with
    weight 1 however often it stands, in bands; nodes with a band in common are candidates, unless
    their signatures agree in so few registers that the similarity is more than five deviations below
    the limit. Registers are independent and agree with the similarity as probability, so with 26
    bands of 5 registers a pair at 0.8 shares no band with a probability of 3e-5, and is kept from
    verification with one of 3e-6; pairs above it are missed more rarely still.

    First the nodes of each bucket are compared with its least node, by their whole texts. Where a
    bucket then still holds more than one component, the signatures of its nodes outside the largest
    of them are compared with those of all its nodes, signed_rows by signed_rows, and the nodes that have
    a likely partner in another component by their whole texts, chunk_rows at a time. A pair that
    shares several bands is compared in the first of them. So no candidate pair between components
    is left out; the texts of nodes that share no band with another are read only to sign them, and
    no pair leaves a task but those that join components.

    Null, empty or blank text: no shingles, so a class of its own. Null doc_ids are above all others
    in a class. Repeated rows are copies; one is kept. An empty table gives an empty table. Other
    columns, whatever their names, are ignored.
    """
    spark, m = docs.sparkSession, bands * rows
    least = math.ceil(m * (similarity - 5 * (similarity * (1 - similarity) / m) ** 0.5))
    t1, t2 = fingerprint(F.col(text))
    src = docs.select(F.col(doc_id).alias("doc_id"), t1.alias("t1"), t2.alias("t2"), F.col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            keys, sigs = [], []
            with np.errstate(over="ignore"):
                for t in batch.column(3):
                    s = np.unique(shingles.of(t.as_py()))
                    owner = prob_minhash(s, np.ones(len(s)), m) if len(s) else None
                    keys.append(None if owner is None else band_keys(owner, rows).view(np.int64))
                    sigs.append(None if owner is None else (_mix(owner) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "t1", "t2", "bands", "sig"]
    signed = src.mapInArrow(sign, f"doc_id {kind}, t1 long, t2 long, bands array<long>, sig binary")
    every, _ = stage(signed.withColumn("rid", F.monotonically_increasing_id()), "signed")
    # a node is a text, named by its first row; a row without shingles is a node of its own and has no candidates
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    nodes = every.filter(F.col("sig").isNotNull()).groupBy("t1", "t2").agg(first, F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    # numbers rise with the nodes' first rows, so the least node of a component has its first row
    nodes = nodes.orderBy("first").select(
        F.monotonically_increasing_id().alias("node"), "t1", "t2", F.col("first.doc_id").alias("doc_id"), F.col("first.rid").alias("rid"), "bands", "sig"
    )
    nodes, _ = stage(nodes, "nodes")

    places = nodes.select("node", F.explode("bands").alias("h"))
    buckets = places.groupBy("h").agg(F.min("node").alias("lead"), F.count("*").alias("n")).filter("n > 1").select("h", "lead")
    inside, inside_at = stage(places.join(buckets, "h").select("h", "node", "lead"), "inside")
    wanted = inside.select("node").distinct().join(nodes.select("node", "t1", "t2", "doc_id"), "node")
    same = src["doc_id"].eqNullSafe(wanted["doc_id"]) & (src["t1"] == wanted["t1"]) & (src["t2"] == wanted["t2"])
    texts, texts_at = stage(src.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "texts")

    def joined(spots: DataFrame) -> DataFrame:
        """(a, b): the components that similar homes and probers of the same chunk join."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with np.errstate(over="ignore"):
                yield from _batches(_joins(batches, shingle, similarity), {"a": pa.int64(), "b": pa.int64()})

        dealt = spots.join(texts, "node").repartition(partitions(spark), "h", "chunk").sortWithinPartitions("h", "chunk", "prober", "node")
        return dealt.select("h", "chunk", "prober", "root", "text").mapInArrow(run, "a long, b long")

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(-1, m) for k in (2, 3))
                yield batch.filter(pa.array((x == y).sum(axis=1) >= least)).select(["a", "b"])

    # the least nodes of the buckets with the others
    a, b = (nodes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    pairs = inside.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct().join(a, "a").join(b, "b")
    pairs, pairs_at = stage(pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(maybe, "a long, b long"), "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / chunk_rows).alias("parts"))
    leads = parts.select(F.col("a").alias("h"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("chunk"), F.lit(False).alias("prober"), "a", "a")
    others = pairs.join(parts, "a").select(F.col("a").alias("h"), F.expr("pmod(xxhash64(b), parts)").alias("chunk"), F.lit(True).alias("prober"), "b", "b")
    links, links_at = stage(joined(leads.union(others).toDF("h", "chunk", "prober", "node", "root")), "links")
    found, found_at = components(links)

    # the buckets that still hold several components
    named = inside.join(found, "node", "left").select("h", "node", F.coalesce("root", "node").alias("root"))
    sizes = named.groupBy("h", "root").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("h").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("members"), F.count("*").alias("roots")
    )
    chunks, pieces = (F.ceil(n / signed_rows) for n in (F.col("members") - F.col("most"), F.col("members")))
    rest = named.join(mixed.filter("roots > 1").select("h", "main", chunks.alias("chunks"), pieces.alias("pieces")), "h")
    rest = rest.join(nodes.select("node", "sig", "bands"), "node")
    rest, rest_at = stage(rest, "mixed")
    row = ["node", "root", "sig", "bands"]
    # each chunk of homes meets each piece of probers in a task of its own
    of_home = "transform(sequence(0L, pieces - 1), p -> pmod(xxhash64(node), chunks) * pieces + p)"
    of_prober = "transform(sequence(0L, chunks - 1), c -> c * pieces + pmod(xxhash64(node), pieces))"
    homes = rest.filter("root <> main").select("h", F.explode(F.expr(of_home)).alias("chunk"), F.lit(False).alias("prober"), *row)
    probers = rest.select("h", F.explode(F.expr(of_prober)).alias("chunk"), F.lit(True).alias("prober"), *row)
    dealt = homes.unionByName(probers).repartition(partitions(spark), "h", "chunk").sortWithinPartitions("h", "chunk", "prober", "node")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"h": pa.int64(), "chunk": pa.int64(), "prober": pa.bool_(), "node": pa.int64(), "root": pa.int64()}
        yield from _batches(_likely(batches, m, least, chunk_rows), kinds)

    spots, spots_at = stage(dealt.mapInArrow(likely, SPOT), "likely")
    more, more_at = stage(joined(spots), "links")
    discard(spark, inside_at, texts_at, pairs_at, rest_at, spots_at)
    final, _ = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    discard(spark, links_at, found_at, more_at)

    # every row: the first row of its node's component
    firsts = nodes.select(F.col("node").alias("root"), F.col("doc_id").alias("class_id"), F.col("rid").alias("first"))
    classes = nodes.select("t1", "t2", "node", "doc_id", "rid").join(final.join(firsts, "root").select("node", "class_id", "first"), "node", "left")
    linked = F.col("first").isNotNull()
    classes = classes.select(
        "t1", "t2", F.when(linked, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("first", "rid").alias("first")
    )
    out = every.select("doc_id", "rid", "t1", "t2").join(classes, ["t1", "t2"], "left")
    # rows without shingles have no node
    alone = F.col("first").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (alone | (F.col("rid") == F.col("first"))).alias("kept"),
        "t1",
        "t2",
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs that near_duplicates() keeps; of rows equal in id and text any one; names that begin with _quarry are reserved."""
    key = ["_quarry_id", "_quarry_1", "_quarry_2"]
    marked = near_duplicates(docs, doc_id, text, **options).select(F.col("doc_id").alias(key[0]), F.col("t1").alias(key[1]), F.col("t2").alias(key[2]), "kept")
    # staged, so that the rows are aggregated before they meet by key: one text may be that of very many
    marked, rows_at = stage(marked, "rows")
    marked, _ = stage(marked.groupBy(*key).agg(F.count_if("kept").alias("_quarry_kept"), F.count("*").alias("_quarry_n")), "marked")
    discard(docs.sparkSession, rows_at)
    t1, t2 = fingerprint(F.col(text))
    same = F.col(doc_id).eqNullSafe(F.col(key[0])) & (t1 == F.col(key[1])) & (t2 == F.col(key[2]))
    every = docs.join(marked.filter("_quarry_kept = _quarry_n"), same)
    # rows that repeat id and text are one node, of which one row is kept at most
    one = docs.join(marked.filter("_quarry_kept = 1 and _quarry_n > 1"), same).dropDuplicates(key)
    return every.select(*docs.columns).unionByName(one.select(*docs.columns))
