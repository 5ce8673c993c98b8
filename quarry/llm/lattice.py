"""Near-duplicate vectors by E8 lattice hashing."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.shared import discard, fingerprint, partitions, stage

#: The 240 shortest vectors of the E8 lattice: two entries of 1 or -1, or all of 1/2 or -1/2 with an even number below 0.
NEIGHBOURS = np.array(
    [v for v in itertools.product((-1.0, 0.0, 1.0), repeat=8) if sum(map(abs, v)) == 2]
    + [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where the sum is odd, the entry farthest from its integer goes the other way."""
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    off = (y - near)[odd]
    k = np.abs(off).argmax(axis=1)
    near[odd, k] += np.where(off[np.arange(len(odd)), k] >= 0, 1, -1)
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest E8 points: of D8 and D8 moved by a half, whichever is nearer."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    return np.where((((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1))[:, None], whole, half)


class Tables:
    """Lattice hash tables over unit vectors of one dimension.

    A table projects a vector at random onto `blocks` spaces of 8 dimensions and takes the nearest E8
    point in each; the blocks' points together are its cell. probes() also gives neighbouring cells:
    each block's point may be replaced by one of its 4 nearest neighbours, and of all combinations
    those nearest to the projection are taken.
    """

    def __init__(self, dim: int, tables: int, blocks: int, seed: int = 5, scale: float = 0.55, near: int = 4):
        self.tables, self.blocks, self.near = tables, blocks, near
        rng = np.random.default_rng([seed, dim])
        self.planes = rng.normal(size=(tables, blocks, dim, 8)) * scale
        # doubled E8 points are integers; odd multipliers make a 64-bit cell of them
        self.mul = rng.integers(1, 1 << 62, size=(tables, blocks, 8), dtype=np.int64) * 2 + 1
        self.choices = np.array(list(itertools.product(range(near + 1), repeat=blocks)))
        self.probes_kept = min(len(self.choices), (near + 1) * blocks)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """int64 of (vectors, tables, probes); the first probe is the home cell."""
        n = len(x)
        out = np.empty((n, self.tables, self.probes_kept), dtype=np.int64)
        rows = np.arange(n)[:, None]
        with np.errstate(over="ignore"):
            for t in range(self.tables):
                cost = np.zeros((n, len(self.choices)))
                cell = np.full((n, len(self.choices)), t, dtype=np.int64)
                for b in range(self.blocks):
                    y = x @ self.planes[t, b]
                    home = nearest_e8(y)
                    off = y - home
                    # |off - v|^2 less |off|^2; all neighbours are sqrt 2 long
                    far = 2 - 2 * (off @ NEIGHBOURS.T)
                    pick = np.argpartition(far, self.near, axis=1)[:, : self.near]
                    points = np.concatenate([home[:, None], home[:, None] + NEIGHBOURS[pick]], axis=1)
                    extra = np.concatenate([np.zeros((n, 1)), far[rows, pick]], axis=1)
                    key = (np.rint(points * 2).astype(np.int64) * self.mul[t, b]).sum(axis=2)
                    cost += extra[:, self.choices[:, b]]
                    cell += key[:, self.choices[:, b]]
                best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes_kept]
                out[:, t] = cell[rows, best]
        return out


#: The share of pairs at cosine 0.9501 that meet in one table, by its blocks, as measured over 1500 pairs each of dimension 16 and 64.
MEET = {1: 0.91, 2: 0.65, 3: 0.42, 4: 0.24}


def shape_for(rows: int, missed: float = 0.005) -> tuple[int, int]:
    """Tables and blocks for so many vectors.

    A block has some 90 cells' worth of discrimination at cosine 0, so blocks grow with the logarithm
    of the rows, and with them the tables, so that the recall stays: as the planes are independent
    and a pair's chance in a table depends on its cosine alone, tables of which each finds a share p
    of the pairs at 0.9501 leave (1 - p)^tables of them unfound, which is `missed` at most.
    """
    blocks = max(1, round(math.log(max(rows, 200) / 200) / math.log(90)))
    last = max(MEET)
    meet = MEET.get(blocks) or MEET[last] * 0.5 ** (blocks - last)
    return math.ceil(math.log(missed) / math.log(1 - meet)), blocks


class Codes:
    """128 signs of random projections of each vector, and the most of them in which a pair at the cosine may differ.

    A sign differs with the pair's angle by pi as probability, and independently, so six deviations
    more than the mean leave out fewer than one pair in a million at the limit itself.
    """

    def __init__(self, dim: int, cosine: float, seed: int = 6):
        self.planes = np.random.default_rng([seed, dim]).normal(size=(dim, 128))
        differ = math.acos(min(1.0, cosine)) / math.pi
        self.most = math.ceil(128 * differ + 6 * math.sqrt(128 * differ * (1 - differ)))

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.planes > 0, axis=1).view("<i8")


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; the largest component is taken out first, so no square overflows."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _likely(batches: Iterator[pa.RecordBatch], most: dict[int, int], step: int = 1024) -> Iterator[tuple]:
    """Of rows sorted by (dim, cell, chunk, table, prober), those whose code is near that of another node there.

    A home counts where some prober is near, a prober where some home is.
    """
    key, homes, waiting = None, [], []
    used = np.zeros(0, dtype=bool)

    def compare() -> Iterator[tuple]:
        x, y = (np.array(rows, dtype=np.int64) for rows in (homes, waiting))
        # of signed numbers it would count the bits of the magnitude
        far = sum(np.bitwise_count((x[:, None, k] ^ y[None, :, k]).view(np.uint64)).astype(np.int16) for k in (1, 2))
        near = (far <= most[key[0]]) & (x[:, None, 0] != y[None, :, 0])
        used[np.flatnonzero(near.any(axis=1))] = True
        for j in np.flatnonzero(near.any(axis=0)).tolist():
            yield (*key, True, waiting[j][0])
        waiting.clear()

    def emit() -> Iterator[tuple]:
        if waiting and homes:
            yield from compare()
        for i in np.flatnonzero(used).tolist():
            yield (*key, False, homes[i][0])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("dim", "cell", "chunk", "table", "prober", "node", "c1", "c2")]
        for dim, cell, chunk, table, prober, *row in zip(*cols, strict=True):
            if key != (dim, cell, chunk, table):
                yield from emit()
                key, homes, waiting, used = (dim, cell, chunk, table), [], [], np.zeros(0, dtype=bool)
            if not prober:
                homes.append(row)
                continue
            if not len(used):
                used = np.zeros(len(homes), dtype=bool)
            waiting.append(row)
            if len(waiting) >= step and homes:
                yield from compare()
    yield from emit()


class _Forest(dict):
    """Union-find over node numbers; the root is the least one."""

    def root(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in np.unique(np.stack([a, b], axis=1), axis=0).tolist():
            x, y = self.root(x), self.root(y)
            self[max(x, y)] = self[min(x, y)] = min(x, y)


def _compare(batches: Iterator[pa.RecordBatch], shapes: dict[int, tuple[int, int]], cosine: float, kind: str, step: int = 2048) -> Iterator[tuple]:
    """Of rows sorted by (dim, cell, chunk, prober, node), for each dimension, cell and chunk: (node, links to add, a node to join)."""
    key, homes, count, forest = None, [], {}, _Forest()
    waiting: list[tuple] = []

    def emit() -> Iterator[tuple]:
        for node, n in count.items():
            yield node, n, forest.root(node)

    def unpack(rows: list[tuple]) -> tuple:
        x = unit(np.frombuffer(b"".join(r[0] for r in rows), dtype=kind).reshape(len(rows), -1))
        cells = np.frombuffer(b"".join(r[1] for r in rows), dtype="<i8").reshape(len(rows), shapes[key[0]][0], -1)
        return x, cells, np.array([r[2] for r in rows]), np.array([r[3] for r in rows])

    def run(home: tuple, table: int) -> None:
        """Adds the pairs of a home and a waiting prober that meet nowhere before."""
        x, cx, nx, mx = home
        y, cy, ny, my = unpack(waiting)
        waiting.clear()
        i, j = np.nonzero(x @ y.T >= cosine)
        on = nx[i] != ny[j]
        i, j = i[on], j[on]
        for t in range(table + 1):
            x_in_y = (cx[i, t, :1] == cy[j, t]).any(axis=1)
            y_in_x = (cy[j, t, :1] == cx[i, t]).any(axis=1)
            # in this table the pair may meet with the roles changed too; then the lower home counts
            on = ~(x_in_y | y_in_x) if t < table else ~y_in_x | (nx[i] < ny[j])
            i, j = i[on], j[on]
        if len(i):
            forest.join(nx[i], ny[j])
            for k, n in ((i, np.bincount(i, weights=my[j])), (j, np.bincount(j, weights=mx[i]))):
                own = nx if k is i else ny
                for a in np.flatnonzero(n):
                    count[int(own[a])] = count.get(int(own[a]), 0) + int(n[a])

    home, table = None, 0
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("dim", "cell", "chunk", "table", "prober", "vector", "cells", "node", "copies")]
        for dim, cell, chunk, t, prober, vector, cells, node, copies in zip(*cols, strict=True):
            if key != (dim, cell, chunk):
                if waiting and home:
                    run(home, table)
                yield from emit()
                key, homes, home, table = (dim, cell, chunk), [], None, t
                count.clear()
                forest.clear()
                waiting.clear()
            if not prober:
                homes.append((vector, cells, node, copies))
            elif homes:
                home = home or unpack(homes)
                waiting.append((vector, cells, node, copies))
                if len(waiting) >= step:
                    run(home, table)
    if waiting and home:
        run(home, table)
    yield from emit()


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, chunk_rows: int = 2048
) -> DataFrame:
    """One row per row of rows: vec_id, n_links, component_id, kept.

    Two vectors are linked when their cosine, in double precision, is at least `cosine` and they
    share a cell of a lattice hash table, one of them by its home cell and the other by a probe (see
    Tables and shape_for). Equal vectors are one node with a count. In each cell the homes' codes
    (see Codes), 16 bytes each, are compared with the probers', and only vectors with a near code
    there go on; those are compared by blocks of a matrix product. Links are counted and joined there,
    at the first place where two vectors meet, so no pair leaves its task. A large cell is parted
    into chunks of homes and pieces of probers of chunk_rows each, and every chunk meets every piece.

    Vectors of each length that occurs have tables of their own, sized for their number, and link
    among themselves. Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing. Floats are read as they are and components of any other type as doubles.
    component_id is the least vec_id reachable by links, its own included; kept: vec_id =
    component_id. A null vec_id is reached by nothing but counts as a link; its component_id is that
    of the others, or null without any, and its kept is null. Repeated rows are vectors of their own.
    An empty table gives an empty table. Other columns, whatever their names, are ignored.
    """
    spark = rows.sparkSession
    single = rows.schema[vector].dataType.elementType.simpleString() == "float"
    kind = "<f4" if single else "<f8"
    v = F.col(vector).cast("array<float>" if single else "array<double>")
    f1, f2 = fingerprint(v)
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    every = rows.select(
        F.col(vec_id).alias("vec_id"), v.alias("v"), F.when(good, f1).alias("f1"), F.when(good, f2).alias("f2"), F.monotonically_increasing_id().alias("rid")
    )
    every, _ = stage(every, "vectors")
    valid = every.filter(F.col("f1").isNotNull())
    nodes, _ = stage(valid.groupBy("f1", "f2").agg(F.min("rid").alias("node"), F.count("*").alias("copies"), F.first("v").alias("v")), "nodes")
    # the driver gets one row a length
    shapes = {r.dim: shape_for(r.n) for r in nodes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    most = {dim: Codes(dim, cosine).most for dim in shapes}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[int, tuple[Tables, Codes]] = {}
        for batch in batches:
            lengths = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            slices = [(int(d), i[at : at + 512]) for d in np.unique(lengths) for i in [np.flatnonzero(lengths == d)] for at in range(0, len(i), 512)]
            for dim, rows_at in slices:
                if dim not in hashes:
                    hashes[dim] = Tables(dim, *shapes[dim]), Codes(dim, cosine)
                tables, codes = hashes[dim]
                part = batch.take(pa.array(rows_at))
                raw = np.asarray(part.column("v").flatten(), dtype=kind).reshape(-1, dim)
                x = unit(raw)
                cells, code = tables.cells(x), codes.of(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node"),
                        part.column("copies"),
                        pa.array([r.tobytes() for r in raw], pa.binary()),
                        pa.array([c.tobytes() for c in cells.astype("<i8")], pa.binary()),
                        pa.array(list(cells.reshape(len(cells), -1)), pa.list_(pa.int64())),
                        pa.array([dim] * len(cells), pa.int32()),
                        pa.array([tables.probes_kept] * len(cells), pa.int32()),
                        pa.array(code[:, 0], pa.int64()),
                        pa.array(code[:, 1], pa.int64()),
                    ],
                    names=["node", "copies", "vector", "cells", "at", "dim", "probes", "c1", "c2"],
                )

    place = "node long, copies long, vector binary, cells binary, at array<long>, dim int, probes int, c1 long, c2 long"
    placed, placed_at = stage(nodes.select("node", "copies", "v").mapInArrow(places, place), "placed")
    at = placed.select("node", "dim", "probes", "c1", "c2", F.posexplode("at").alias("pos", "cell")).withColumns(
        {"table": (F.col("pos") / F.col("probes")).cast("int"), "home": F.col("pos") % F.col("probes") == 0}
    )
    sizes = (
        at.groupBy("dim", "cell", "table")
        .agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
        .filter("homes > 0 and all > 1")
        .withColumns({"chunks": F.ceil(F.col("homes") / chunk_rows).cast("int"), "pieces": F.ceil(F.col("all") / chunk_rows).cast("int")})
        .select("dim", "cell", "table", "chunks", "pieces")
    )
    spots = at.select("dim", "cell", "table", "home", "node", "c1", "c2").join(sizes, ["dim", "cell", "table"])
    # each chunk of homes meets each piece of probers in a task of its own; a home is a prober too, so that homes meet each other
    roles = F.expr("""concat(
        if(home, transform(sequence(0, pieces - 1), p -> named_struct('chunk', cast(pmod(xxhash64(node), chunks) * pieces + p as int), 'prober', false)), array()),
        transform(sequence(0, chunks - 1), c -> named_struct('chunk', cast(c * pieces + pmod(xxhash64(node), pieces) as int), 'prober', true))
    )""")
    codes = spots.select("dim", "cell", "table", "node", "c1", "c2", F.inline(roles))
    codes = codes.repartition(partitions(spark), "dim", "cell", "chunk").sortWithinPartitions("dim", "cell", "chunk", "table", "prober", "node")

    def batched(found: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        while held := list(itertools.islice(found, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
        yield from batched(_likely(batches, most), ["dim", "cell", "chunk", "table", "prober", "node"], kinds)

    near, near_at = stage(codes.mapInArrow(likely, "dim int, cell long, chunk int, table int, prober boolean, node long"), "near")
    work = (
        near.join(placed.select("node", "copies", "vector", "cells"), "node")
        .repartition(partitions(spark), "dim", "cell", "chunk")
        .sortWithinPartitions("dim", "cell", "chunk", "table", "prober", "node")
        .select("dim", "cell", "chunk", "table", "prober", "vector", "cells", "node", "copies")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(_compare(batches, shapes, cosine, kind), ["node", "n", "to"], [pa.int64()] * 3)

    links, links_at = stage(work.mapInArrow(compare, "node long, n long, to long"), "links")
    discard(spark, placed_at, near_at)
    found, _ = components(links.select(F.col("node").alias("a"), F.col("to").alias("b")))
    counts, _ = stage(links.groupBy("node").agg(F.sum("n").alias("n")), "counts")
    discard(spark, links_at)
    # the least id of each node, then of each component, goes to the nodes and from them to the rows
    ids = every.groupBy("f1", "f2").agg(F.min("vec_id").alias("least"))
    named = nodes.select("f1", "f2", "node", "copies").join(ids, ["f1", "f2"]).join(counts, "node", "left").join(found, "node", "left")
    named, _ = stage(named.withColumn("root", F.coalesce("root", "node")), "named")
    least, _ = stage(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    of_node = named.join(least, "root").select("f1", "f2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = every.select("vec_id", "f1", "f2").join(of_node, ["f1", "f2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
