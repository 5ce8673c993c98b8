"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import WS, fingerprint, stage

#: The groups of equal rows that go through the tree: what decides a group, the probability of one copy more, and what is passed on.
ROWS = (
    "src long, block long, key long, size long, p double, "
    "doc_id string, k1 long, k2 long, n long, whole long, source string, source_size long, target double"
)


def targets(sources: DataFrame, share: float = 1.5, weights: tuple[int, ...] = (3, 1, 2), most: float = 2.0) -> DataFrame:
    """For each source its size, weight, target and rate.

    sources: (source, source_size, n_docs), one row each. Sources by code point, null last, weigh
    `weights` in turn. They share `share` times the sum of all sizes by weight; a target stops at
    `most` times the source's size, and the rest is shared anew. Where the running sums stop is the
    share per weight at which nothing more is above: in the order of most * size / weight, a source
    stops if that ratio is no more than the share per weight left by those before it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    s = sources.withColumn("nr", (F.row_number().over(by_name) - 1).cast("long"))
    s = s.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.col("nr") % len(weights)).cast("int")).cast("double"))
    s = s.withColumn("stop", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("stop") / F.col("weight"), "nr")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * share
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / left
    s = s.withColumn("level", level).withColumn("stops", F.col("stop") <= F.col("level") * F.col("weight"))
    # the first source that does not stop has the level of all that do not
    final = F.min(F.when(~F.col("stops"), F.struct((F.col("stop") / F.col("weight")).alias("r"), "nr", "level"))).over(whole)["level"]
    target = F.when(F.col("stops"), F.col("stop")).otherwise(F.least("stop", final * F.col("weight")))
    return s.withColumn("target", target.cast("double")).select(
        "source",
        "source_size",
        "n_docs",
        F.col("nr").alias("src"),
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def pivot(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rounds copy probabilities to 0 or 1, but for one at most, which is left fractional.

    Rows are taken by falling size. The row left so far and the next one exchange mass (size times
    probability) until one of them is 0 or 1; which of the two ways is drawn so that each row's
    probability keeps its expectation, and the sum of mass stays the same in either.
    """
    p = p.copy()
    open_ = [i for i in np.argsort(-size, kind="stable") if 0 < p[i] < 1]
    if not open_:
        return p
    u = rng.random(len(open_))
    a = open_[0]
    for k, b in enumerate(open_[1:]):
        sa, sb, pa, pb = size[a], size[b], p[a], p[b]
        up, down = min(sa * (1 - pa), sb * pb), min(sa * pa, sb * (1 - pb))
        if u[k] * (up + down) < down:
            a_full, b_empty = sa * (1 - pa) <= sb * pb, sb * pb <= sa * (1 - pa)
            p[a], p[b] = (1.0 if a_full else pa + up / sa), (0.0 if b_empty else pb - up / sb)
        else:
            a_empty, b_full = sa * pa <= sb * (1 - pb), sb * (1 - pb) <= sa * pa
            p[a], p[b] = (0.0 if a_empty else pa - down / sa), (1.0 if b_full else pb + down / sb)
        if not 0 < p[a] < 1:
            a = b
        # where both became whole, b is not open and the next row takes its place
    return p


def _rounded(seed: int, level: int):
    """For mapInPandas over rows in which a source's block is in one piece, sorted by (src, block, ...)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def blocks(rows: pd.DataFrame) -> pd.DataFrame:
            p = rows["p"].to_numpy().copy()
            size = rows["size"].to_numpy(dtype=np.float64)
            src, block = rows["src"].to_numpy(), rows["block"].to_numpy()
            cuts = np.flatnonzero((np.diff(src) != 0) | (np.diff(block) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
                if b - a > 1:
                    p[a:b] = pivot(size[a:b], p[a:b], np.random.default_rng([seed, level, int(src[a]), int(block[a])]))
            return rows.assign(p=p)

        for frame in frames:
            if not len(frame):
                continue
            # the last block may go on in the next batch; only what is whole is put together
            src, block = frame["src"].to_numpy(), frame["block"].to_numpy()
            last = int(np.argmax((src == src[-1]) & (block == block[-1])))
            goes_on = held and (held[0]["src"].iloc[0], held[0]["block"].iloc[0]) == (src[0], block[0])
            if held and (last or not goes_on):
                yield blocks(pd.concat([*held, frame[:last]]))
                held = []
            elif last:
                yield blocks(frame[:last])
            held.append(frame[last:])
        if held:
            yield blocks(pd.concat(held))

    return run


def row_key(doc_id: str, text: str, source: str) -> tuple[Column, Column]:
    cols = [F.col(c) for c in (doc_id, text, source)]
    return fingerprint(*cols, *(c.isNull() for c in cols))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 11,
    block_rows: int = 8192,
    fan_in: int = 1024,
    **law,
) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken for each row of docs.

    A source's rate is its target by its size (see targets()). Each document gets the whole part of
    the rate as copies, and the rest is its copy probability, rounded by pivot() in blocks of about
    block_rows; what a block leaves fractional goes up a reduction tree, fan_in at a time, until a
    source has one such row, which a hash rounds. The words taken thus differ from the target by
    less than one document, and mostly a short one, as rows are paired by falling size. taken:
    copies times size.

    size: words of the text; null or empty text: 0, and then one rate's whole copies, which take
    nothing. A null source is a source of its own. The draws come from hashes of id, text
    and source, so reruns agree. Rows equal in these are one group, however many: it has the whole
    part of the sum of their rates for certain and goes through the rounding as one row with the rest;
    its copies are shared out evenly. An empty table gives an empty table. Other columns, whatever
    their names, are ignored; the result has doc_id, k1 and k2 (hashes of id, text and source), source, size, source_size, target, copies and taken.
    """
    rows = groups_of(docs, doc_id, text, source)
    per_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("n_docs"))
    aims, _ = stage(targets(per_source, **law), "targets")
    named = aims.withColumnRenamed("source", "source2")
    all_rows = rows.join(F.broadcast(named) if aims.count() <= 10_000 else named, F.col("source").eqNullSafe(F.col("source2"))).drop("source2")
    key = F.xxhash64(F.lit(seed), "k1", "k2")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / block_rows))
    all_rows = all_rows.withColumns(
        {
            "key": key,
            "whole": F.floor(F.col("rate") * F.col("n")).cast("long"),
            "p": F.col("rate") * F.col("n") - F.floor(F.col("rate") * F.col("n")),
            "block": F.pmod(F.xxhash64("key"), blocks),
        }
    )
    most_blocks = aims.agg(F.max(F.ceil(F.col("n_docs") / block_rows))).first()[0] or 1

    def level(frame: DataFrame, k: int) -> DataFrame:
        dealt = frame.repartition("src", "block").sortWithinPartitions("src", "block", F.desc("size"), "key")
        return dealt.mapInPandas(_rounded(seed, k), ROWS)

    # the id goes through pandas as a string, as a null would make the numbers floats
    cols = ["src", "block", "key", "size", "p", F.col("doc_id").cast("string"), "k1", "k2", "n", "whole", "source", "source_size", "target"]
    todo = all_rows.filter((F.col("p") > 0) & (F.col("size") > 0)).select(*cols)
    done = [all_rows.filter(~((F.col("p") > 0) & (F.col("size") > 0))).withColumn("p", F.lit(0.0)).select(*cols)]
    for k in range(1 + max(0, math.ceil(math.log(max(most_blocks, 1), fan_in) - 1e-9))):
        todo, _ = stage(level(todo.withColumn("block", F.floor(F.col("block") / (fan_in if k else 1))), k), "rounded")
        done.append(todo.filter((F.col("p") == 0) | (F.col("p") == 1)))
        todo = todo.filter((F.col("p") > 0) & (F.col("p") < 1))
    unit = F.xxhash64(F.lit(seed + 1), "key") / F.lit(2.0**64) + 0.5
    done.append(todo.withColumn("p", F.when(unit < F.col("p"), 1.0).otherwise(0.0)))
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    # a group's rows anew, in pieces, so that no array holds a large one
    piece = 10_000
    each = (
        every.withColumn("total", F.col("whole") + F.col("p").cast("long"))
        .withColumn("first", F.explode(F.expr(f"sequence(0L, n - 1, {piece}L)")))
        .withColumn("at", F.explode(F.expr(f"sequence(first, least(first + {piece}, n) - 1)")))
    )
    copies = F.expr("total div n + if(at < total % n, 1, 0)").cast("int")
    return each.select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"),
        "k1",
        "k2",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def groups_of(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(doc_id, source, size, k1, k2, n): the groups of rows equal in id, text and source, staged."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(f"[^{WS}]+")).cast("long")
    k1, k2 = row_key(doc_id, text, source)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), k1.alias("k1"), k2.alias("k2"))
    return stage(rows.groupBy("doc_id", "source", "size", "k1", "k2").agg(F.count("*").alias("n")), "groups")[0]


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of docs as often as mix() takes them; documents without words are left out.

    Rows equal in id, text and source share their copies evenly. Names that begin with _quarry are reserved.
    """
    copies = mix(docs, doc_id, text, source, **options).filter(F.col("size") > 0)
    copies = copies.groupBy(F.col("k1").alias("_quarry_1"), F.col("k2").alias("_quarry_2")).agg(
        F.sum("copies").alias("_quarry_copies"), F.count("*").alias("_quarry_rows")
    )
    copies, _ = stage(copies.filter("_quarry_copies > 0"), "copies")
    k1, k2 = row_key(doc_id, text, source)
    keyed = docs.withColumns({"_quarry_1": k1, "_quarry_2": k2})
    single = keyed.join(copies.filter("_quarry_rows = 1"), ["_quarry_1", "_quarry_2"]).withColumn("_quarry_n", F.col("_quarry_copies"))
    # only rows that have an equal are numbered
    nth = F.row_number().over(Window.partitionBy("_quarry_1", "_quarry_2").orderBy(F.lit(0)))
    share = F.expr("_quarry_copies div _quarry_rows + if(_quarry_nth <= _quarry_copies % _quarry_rows, 1, 0)")
    several = keyed.join(copies.filter("_quarry_rows > 1"), ["_quarry_1", "_quarry_2"]).withColumn("_quarry_nth", nth).withColumn("_quarry_n", share)
    every = single.select(*docs.columns, "_quarry_n").unionByName(several.select(*docs.columns, "_quarry_n"))
    return every.withColumn("_quarry_n", F.explode(F.array_repeat(F.lit(0), F.col("_quarry_n").cast("int")))).select(*docs.columns)
