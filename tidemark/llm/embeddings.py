"""Near-duplicate vectors by randomised-rotation binary codes.

Equal vectors of a label are one class.  A label of at most ``part`` classes is searched
whole.  Those of larger labels are indexed in cells around centroids, about one for each
half ``part`` classes of the largest label: every class lies in its home cell, and asks
the cells below its own where a neighbour may be at home, so a pair meets once.  The
centroids are fitted on a bounded sample (``SAMPLE_VALUES`` numbers).  A neighbour at the
threshold lies in a random direction; cells are asked that it reaches within ``margin``
standard deviations of that direction (recall is measured in the tests), or all that it can
reach at all with ``margin=None``, which finds every link that the bounds below let through.

A stored class keeps, of its residual from the centroid, one sign bit a dimension of a
random rotation and three correction factors: the residual's length, the code's inner
product with the rotated residual, and the vector's product with the centroid.  From these
the inner product with any other vector is estimated without bias, with a confidence
bound; only pairs whose upper bound reaches the threshold are computed again exactly, in
double precision.

A cell of more than ``part`` classes is cut into blocks: each pair of blocks is a task of
its own, and who asks the cell goes to every block.  A task holds one block and streams
the rest past it; tasks send back sums of links and spanning stars, never pairs.

Defined cases: a null label, a null, empty or zero vector, or one with a null or
non-finite component links with nothing and is kept; vectors of different lengths
never link; identical rows link with each other; rows that share a ``vec_id`` but not
the vector are one node of the link graph; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .simhash import _spanning
from .store import durable, ship, with_columns

#: Numbers (rows times length) of the vectors that centroids are fitted on, at most about twice as many; rows that k-means moves them by.
SAMPLE_VALUES, FITTED = 1 << 24, 16384
#: Classes searched in one piece.
PART = 8192


def rotation(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    """``bits`` x ``dim`` with orthonormal columns: keeps lengths and inner products."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))[0]


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means of unit rows."""
    rng = np.random.default_rng(seed)
    centre = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        home = np.argmax(sample @ centre.T, axis=1)
        for c in range(len(centre)):
            if len(own := sample[home == c]):
                m = own.mean(axis=0)
                centre[c] = m / max(np.linalg.norm(m), 1e-12)
    return centre


def encode(units: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes of the residuals, their lengths, code products and centroid products."""
    r = units - centre
    length = np.linalg.norm(r, axis=1)
    z = (r / np.maximum(length, 1e-300)[:, None]) @ turn.T
    product = np.abs(z).sum(axis=1) / math.sqrt(turn.shape[0])
    return np.packbits(z > 0, axis=1, bitorder="little"), length, product, (units * centre).sum(axis=1)


def upper_bounds(code, length, product, with_centre, centre, queries, turn, sigmas: float) -> np.ndarray:
    """Upper confidence bounds of the inner products, stored rows by queries (unit rows)."""
    return bounds(code, length, product, with_centre, centre, (queries @ turn.T).astype(np.float32), queries @ centre, turn, sigmas)


def bounds(code, length, product, with_centre, centre, turned, asked_centre, turn, sigmas: float) -> np.ndarray:
    """The same from the unit queries' rotated forms and their products with the centroid."""
    bits = turn.shape[0]
    signs = np.unpackbits(code, axis=1, bitorder="little", count=bits).astype(np.float32) * 2 - 1
    rest = np.sqrt(np.maximum(1 - 2 * asked_centre + centre @ centre, 0))
    g = np.maximum(product, 1e-6)[:, None]
    estimate = signs @ (turned - (turn @ centre).astype(np.float32)).T / math.sqrt(bits) / g
    spread = np.sqrt(np.maximum(1 - g * g, 0)) / g * (sigmas / math.sqrt(bits - 1)) * rest[None, :]
    return asked_centre[None, :] + (with_centre - centre @ centre)[:, None] + length[:, None] * (estimate + spread)


def _matrix(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten()).reshape(len(col), -1)


def asked_cells(units: np.ndarray, centre: np.ndarray, threshold: float, margin: float | None) -> tuple[np.ndarray, np.ndarray]:
    """The home of each unit row, and rows by cells: whether a neighbour may be at home there.

    A vector at the angle t of u is cos(t) u + sin(t) w, w a unit vector across u.  It is
    nearer to centroid c than to u's own c0 only if sin(t) w(c - c0) > cos(t) u(c0 - c); for
    a random w, w(c - c0) deviates by the length of c - c0 across u, over sqrt(dim - 1).
    """
    products = units @ centre.T
    home = np.argmax(products, axis=1)
    gap = products[np.arange(len(home)), home][:, None] - products
    square = (centre * centre).sum(axis=1)
    across = np.maximum(square[home][:, None] + square[None, :] - 2 * centre[home] @ centre.T - gap * gap, 0)
    if threshold <= 0:
        return home, np.ones(products.shape, bool)
    share = 1.0 if margin is None else min(1.0, margin / math.sqrt(max(units.shape[1] - 1, 1)))
    return home, threshold * gap <= share * math.sqrt(max(1 - threshold * threshold, 0)) * np.sqrt(across) + 1e-9


def _turns(dims, bits_per_dim: int):
    known: dict[int, np.ndarray] = {}

    def of(d: int) -> np.ndarray:
        if d not in known:
            known[d] = rotation(d, max(64, bits_per_dim * d))
        return known[d]

    return of


def _index_rows(centres: dict[int, np.ndarray], bits_per_dim: int, threshold: float, margin: float | None):
    turn = _turns(centres, bits_per_dim)

    def rows(part: pa.RecordBatch, d: int, large: bool):
        v = _matrix(part.column("v")).astype(np.float64)
        units = v / np.linalg.norm(v, axis=1)[:, None]
        if large:
            home, asks = asked_cells(units, centres[d], threshold, margin)
            asks &= np.arange(asks.shape[1])[None, :] < home[:, None]
            row, cell = np.nonzero(asks)
            centre = centres[d][home]
        else:
            home, row, cell, centre = np.full(len(v), -1), np.zeros(0, int), np.zeros(0, int), np.zeros_like(units)
        code, length, product, own = encode(units, centre, turn(d))
        asked = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(v) + 1)).astype(np.int32)), pa.array(cell.astype(np.int32)))
        cols = [part.column(c) for c in ("label", "dim", "rep", "n", "v")]
        cols += [pa.array(home.astype(np.int32)), asked, pa.array([x.tobytes() for x in code], pa.binary()), pa.array(length), pa.array(product), pa.array(own)]
        return pa.RecordBatch.from_arrays(cols, ["label", "dim", "rep", "n", "v", "home", "asks", "code", "length", "product", "own"])

    def run(batches):
        for b in batches:
            dims, large = np.asarray(b.column("dim")), np.asarray(b.column("large"))
            for d, big in sorted(set(zip(dims.tolist(), large.tolist(), strict=True))):
                part = b.filter(pa.array((dims == d) & (large == big)))
                step = max(1, (1 << 22) // len(centres[d])) if big else 4096
                for k in range(0, part.num_rows, step):
                    yield rows(part.slice(k, step), d, big)

    return run


def _link_rows(centres: dict[int, np.ndarray], bits_per_dim: int, threshold: float, sigmas: float):
    turn = _turns(centres, bits_per_dim)

    class Rows:
        """Some rows of a task: stored ones with their codes, or asking ones."""

        def __init__(self, b: pa.RecordBatch):
            self.rep, self.n = (np.asarray(b.column(c)) for c in ("rep", "n"))
            self.v = _matrix(b.column("v")).astype(np.float64)
            self.norm = np.linalg.norm(self.v, axis=1)
            self.stored = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(len(self.v), -1), *(np.asarray(b.column(c)) for c in ("length", "product", "own"))

        @classmethod
        def joined(cls, parts: list[Rows]) -> Rows:
            out = cls.__new__(cls)
            out.rep, out.n, out.v, out.norm = (np.concatenate([getattr(p, f) for p in parts]) for f in ("rep", "n", "v", "norm"))
            out.stored = tuple(np.concatenate([p.stored[i] for p in parts]) for i in range(4))
            return out

    def linked(x: Rows, y: Rows, centre: np.ndarray, own: bool):
        """Sums of links and a spanning star of the pairs that reach the threshold, stored rows by asking ones (``own``: they are the same)."""
        turned = turn(x.v.shape[1])
        units = y.v / y.norm[:, None]
        rotated, asked = (units @ turned.T).astype(np.float32), units @ centre
        found = []
        for k in range(0, len(x.rep), 1024):
            r = slice(k, k + 1024)
            first = k if own else 0
            bound = bounds(*(f[r] for f in x.stored), centre, rotated[first:], asked[first:], turned, sigmas)
            i, j = np.nonzero(bound >= threshold)
            i, j = i + k, j + first
            if own:
                i, j = i[i < j], j[i < j]
            for m in range(0, len(i), 65536):
                a, b = i[m : m + 65536], j[m : m + 65536]
                near = np.einsum("ab,ab->a", x.v[a], y.v[b]) / (x.norm[a] * y.norm[b]) >= threshold
                found.append((a[near], b[near]))
        i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(2))
        if not len(i):
            return None
        ids = np.unique(np.concatenate([x.rep[i], y.rep[j]]))
        a, b = np.searchsorted(ids, x.rep[i]), np.searchsorted(ids, y.rep[j])
        links = np.bincount(a, y.n[j], len(ids)) + np.bincount(b, x.n[i], len(ids))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (ids, np.rint(links).astype(np.int64), ids[_spanning(len(ids), a, b)])], ["id", "links", "low"])

    def run(batches):
        """Rows by task, the stored block first (role 0), then what is held against it."""
        now, held, block, same, centre = None, [], None, False, None

        def close():
            return Rows.joined(held)

        for b in batches:
            task, role = np.asarray(b.column("task")), np.asarray(b.column("role"))
            if not len(task):
                continue
            edges = np.flatnonzero(np.append(True, (task[1:] != task[:-1]) | ((role[1:] > 0) != (role[:-1] > 0))))
            for s, e in zip(edges, np.append(edges[1:], len(task)), strict=True):
                part = b.slice(int(s), int(e - s))
                if task[s] != now:
                    if held and same and (got := linked(x := close(), x, centre, True)):
                        yield got
                    now, held, block = task[s], [], None
                    same = part.column("same")[0].as_py()
                    d, cell = part.column("dim")[0].as_py(), part.column("cell")[0].as_py()
                    centre = np.zeros(d) if cell < 0 else centres[d][cell]
                if role[s] == 0:
                    held.append(Rows(part))
                elif held or block is not None:
                    if block is None:
                        block, held = close(), []
                        if same and (got := linked(block, block, centre, True)):
                            yield got
                    if got := linked(block, Rows(part), centre, False):
                        yield got
        if held and same and (got := linked(x := close(), x, centre, True)):
            yield got

    return run


def fitted(found: DataFrame, part: int, cells: int | None) -> dict[int, np.ndarray]:
    """Centroids of each vector length that has a label of more than ``part`` classes: one job for all lengths."""
    large = found.groupBy("dim", "label").count().where(F.col("count") > part)
    wanted = {r["dim"]: (r["n"], cells or -(-r["most"] * 2 // part)) for r in large.groupBy("dim").agg(F.sum("count").alias("n"), F.max("count").alias("most")).collect()}
    if not wanted:
        return {}
    rows = {d: max(FITTED, min(2 * k, SAMPLE_VALUES // len(wanted) // d)) for d, (_, k) in wanted.items()}
    thin = F.coalesce(*[F.when(F.col("dim") == d, F.lit(max(1, n // rows[d]))) for d, (n, _) in wanted.items()])
    got = found.where(F.col("dim").isin(*wanted) & (F.pmod(F.xxhash64("rep"), thin) == 0)).select("dim", F.col("v").cast("array<float>").alias("v")).toArrow()
    out = {}
    for d, (_, k) in wanted.items():
        sample = _matrix(got.filter(pa.array(np.asarray(got.column("dim")) == d)).column("v"))
        sample = sample / np.linalg.norm(sample.astype(np.float64), axis=1)[:, None]
        k = min(k, len(sample))
        # many centroids are rows of the sample as they are: few rows of it would move each
        out[d] = (fit_centroids(sample[:FITTED], k) if k <= FITTED // 8 else sample[:k]).astype(np.float32).astype(np.float64)
    return out


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
    bits_per_dim: int = 2, sigmas: float = 4.0, part: int = PART, cells: int | None = None, margin: float | None = 2.0,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of every row.

    ``cells``: centroids of a vector length that needs them, instead of a number that grows with the rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    src = with_columns(vectors, [key, vector, label]).toDF("id", "v", "label")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    sound = F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", number) & F.exists("v", lambda x: x != 0)
    src = src.withColumn("ok", F.coalesce(sound, F.lit(False)))
    of_class = [F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(1), "v", "label").alias("h2")]
    rows = src.where("ok").select("id", "label", "v", *of_class)
    classes = rows.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = durable(classes.withColumn("dim", F.size("v")), "vector-classes")
    found = classes.where(F.col("rep").isNotNull())

    centres = fitted(found, part, cells)
    kind = vectors.schema[vector].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    size = found.groupBy("label", "dim").count().where(F.col("count") > part).select(F.col("label").alias("_label"), F.col("dim").alias("_dim"))
    sized = found.join(size, (found["label"] == F.col("_label")) & (found["dim"] == F.col("_dim")), "left")
    sized = sized.select("label", "dim", "rep", "n", F.col("v").cast(kind).alias("v"), F.col("_label").isNotNull().alias("large"))
    schema = f"label {src.schema['label'].dataType.simpleString()}, dim int, rep bigint, n bigint, v {kind}, home int, asks array<int>, code binary, length double, product double, own double"
    index = durable(sized.mapInArrow(_index_rows(centres, bits_per_dim, threshold, margin), schema), "vector-index")
    here = ["label", "dim", "cell"]
    row = ["dim", "cell", "rep", "n", "v", "code", "length", "product", "own"]
    at_home = index.withColumn("cell", F.col("home"))
    blocks = durable(at_home.groupBy(*here).agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("blocks")), "vector-cells")
    split = blocks.where("blocks > 1").toDF("_label", "_dim", "_cell", "blocks")
    with_blocks = lambda df: df.join(split, (df["label"] == F.col("_label")) & (df["dim"] == F.col("_dim")) & (df["cell"] == F.col("_cell")), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    stored = with_blocks(at_home).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # a block's rows meet their own block and every other one
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "mine").alias("i"), F.greatest(o, "mine").alias("j")))
    stored = stored.withColumn("p", F.explode(meets)).select(F.xxhash64(*here, "p.i", "p.j").alias("task"), (F.col("p.i") != F.col("mine")).cast("int").alias("role"), (F.col("p.i") == F.col("p.j")).alias("same"), *row)
    asking = with_blocks(index.withColumn("cell", F.explode("asks"))).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asking = asking.select(F.xxhash64(*here, "b", "b").alias("task"), F.lit(2).alias("role"), F.lit(True).alias("same"), *row)
    tasks = stored.unionByName(asking).repartition("task").sortWithinPartitions("task", "role")
    links = durable(tasks.mapInArrow(_link_rows(centres, bits_per_dim, threshold, sigmas), "id bigint, links bigint, low bigint"), "vector-links")
    degree = links.groupBy(F.col("id").alias("_id")).agg(F.sum("links").alias("links"))
    comp = components(links.select(F.col("id").alias("a"), F.col("low").alias("b")))
    known = (
        classes.join(degree, classes["rep"] == F.col("_id"), "left").join(comp, classes["rep"] == F.col("node"), "left")
        .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    every = src.select("id", *[F.when(F.col("ok"), h).alias(n) for h, n in zip(of_class, ("h1", "h2"), strict=True)])
    out = every.join(known, (every["h1"] == F.col("_h1")) & (every["h2"] == F.col("_h2")), "left")
    out = out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


ORACLE = """
with v as (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null and embedding is not null),
pairs as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.93),
links as (select a, count(*) as n from pairs group by a),
reach as (with recursive r(a, b) as (select vec_id, vec_id from embeddings union select r.a, p.b from r join pairs p on r.b = p.a) select a, min(b) as c from r group by a)
select vec_id, cast(coalesce(n, 0) as bigint) as n_links, c as component_id, vec_id = c as kept
from embeddings left join links on vec_id = links.a join reach on vec_id = reach.a
"""
