"""Near-duplicate vectors by E8 lattice hashing.

In each of several tables a random orthonormal projection takes the unit vectors to eight dimensions, scaled so
that near vectors fall less than a lattice spacing apart; the nearest point of the E8 lattice is the cell. A vector is
a member of its own cell and a visitor of the nearest neighbouring cells. Within a cell, members are held
against members and visitors by cosine in double precision. A pair that meets in several tables or cells counts in
the first one only, which a task decides by itself from the two vectors. Cells above ``BLOCK`` rows are
dealt out as pairs of blocks, so no task takes a whole large cell and nothing is capped; tasks emit counts and the
edges of a spanning forest, never all pairs of a cell.

Equal vectors are one class with a multiplicity. Vectors of different lengths do not link.

Defined results: null vectors, null or non-finite components and zero vectors link with nothing and are kept as their own
component; a null vec_id is dropped from linking; rows that repeat a vec_id with the same vector count once and get one result;
rows that repeat it with another vector are vectors of their own, each with its own links, and a component is named by the smallest vec_id in it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import U64, components, materialize, mix

TABLES, PROBES, SCALE, SEED = 6, 2, 7.0, 20_240_901
#: Rows of a cell that one task compares; larger cells go by pairs of blocks.
BLOCK = 512
#: Rows of small cells that share a task call.
ROWS_PER_PART = 4_000

KEYED = "tab int, cell long, home boolean, vid long, mult long, v binary"
FOUND = "a long, b long, n long"


@lru_cache(maxsize=8)
def _projection(dim: int, table: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng([SEED, dim, table]).normal(size=(max(dim, 8), 8)))
    return q[:dim] * SCALE


@lru_cache(maxsize=1)
def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to neighbouring cells."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for x, y in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = x, y
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Integer points with an even sum: round, and on an odd sum round the worst coordinate the other way."""
    r = np.rint(y)
    odd = np.flatnonzero(r.sum(axis=1) % 2)
    d = y - r
    worst = np.abs(d[odd]).argmax(axis=1)
    r[odd, worst] += np.where(d[odd, worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 shifted by one half; the nearer of both candidates."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    near = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(near[:, None], a, b)


def _name(points: np.ndarray, dim: int) -> np.ndarray:
    h = np.full(points.shape[:-1], U64(dim))
    for c in np.moveaxis(np.rint(points * 2).astype(np.int64), -1, 0):
        h = mix(h * U64(0x9FB21C651E98DF25) + c.astype(U64))
    return h.view(np.int64)


def cells(unit: np.ndarray, table: int) -> np.ndarray:
    """The own cell of each vector and its PROBES nearest neighbours, as names [vector, 1 + PROBES]."""
    out = []
    for at in range(0, len(unit), 2000):
        y = unit[at : at + 2000] @ _projection(unit.shape[1], table)
        p = nearest_e8(y)
        # |y - p - r|^2 = |y - p|^2 - 2 (y - p) r + 2
        near = np.argpartition(-((y - p) @ _shortest().T), PROBES, axis=1)[:, :PROBES]
        out.append(_name(np.concatenate([p[:, None], p[:, None] + _shortest()[near]], axis=1), unit.shape[1]))
    return np.concatenate(out) if out else np.empty((0, 1 + PROBES), np.int64)


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keyed(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vid, mult, v) to one row for each table and cell."""
        for batch in batches:
            raw = batch.column(2).to_pylist()
            size = np.array([len(x) for x in raw])
            vid, mult = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                unit = _unit([raw[i] for i in at], kind)
                for t in range(TABLES):
                    c = cells(unit, t)
                    k = c.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at) * k, t, np.int32)), pa.array(c.ravel()), pa.array(np.tile([True] + [False] * (k - 1), len(at))), pa.array(np.repeat(vid[at], k)), pa.array(np.repeat(mult[at], k)), batch.column(2).take(pa.array(np.repeat(at, k)))],
                        ["tab", "cell", "home", "vid", "mult", "v"],
                    )

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that join something new."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            out.append((x, y))
    return out


def _linker(threshold: float, kind: str):
    def cell_links(table: int, cell: int, blocks: tuple[int, int], rows: dict) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a cell (or of a pair of its blocks) that count here."""
        home, vid, blk, unit = rows["home"], rows["vid"], rows["blk"], rows["unit"]
        m = np.flatnonzero(home)
        sim = unit[m] @ unit.T
        i, j = np.nonzero(sim >= threshold)
        i = m[i]
        ok = (vid[i] != vid[j]) & (~home[j] | (vid[i] < vid[j]))
        if blocks[0] != blocks[1]:
            ok &= blk[i] != blk[j]
        i, j = i[ok], j[ok]
        if not len(i):
            return i, j
        used, where = np.unique(np.concatenate([i, j]), return_inverse=True)
        a, b = where[: len(i)], where[len(i) :]
        first = np.ones(len(i), bool)
        for t in range(table + 1):
            c = cells(unit[used], t)
            ab, ba = (c[a, :1] == c[b]).any(axis=1), (c[b, :1] == c[a]).any(axis=1)
            if t < table:
                first &= ~(ab | ba)
            else:  # meets in both own cells: the smaller one counts
                first &= (c[a, 0] == c[b, 0]) | ~(ab & ba) | (np.minimum(c[a, 0], c[b, 0]) == cell)
        return i[first], j[first]

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("tab", "ascending"), ("cell", "ascending"), ("p", "ascending"), ("q", "ascending"), ("vid", "ascending")])
        tab, cell, p, q, vid, mult, blk = (np.asarray(t[c]) for c in ("tab", "cell", "p", "q", "vid", "mult", "blk"))
        home, raw = np.asarray(t["home"]), t["v"].to_pylist()
        n = len(tab)
        new = np.ones(n, bool)
        new[1:] = (tab[1:] != tab[:-1]) | (cell[1:] != cell[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
        edge = np.append(np.flatnonzero(new), n)
        ends, others, links = [], [], {}
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            if y - x < 2 or not home[x:y].any():
                continue
            i, j = cell_links(int(tab[x]), int(cell[x]), (p[x], q[x]), {"home": home[x:y], "vid": vid[x:y], "blk": blk[x:y], "unit": _unit(raw[x:y], kind)})
            for a, b in ((i, j), (j, i)):
                for v, k in zip(vid[x:y][a].tolist(), mult[x:y][b].tolist(), strict=True):
                    links[v] = links.get(v, 0) + k
            ends.append(vid[x:y][i])
            others.append(vid[x:y][j])
        forest = _forest(np.concatenate(ends), np.concatenate(others)) if ends else []
        rows = [(v, None, k) for v, k in links.items()] + [(a, b, None) for a, b in forest]
        cols = zip(*rows, strict=True) if rows else [[], [], []]
        return pa.table([pa.array(list(c), pa.int64()) for c in cols], ["a", "b", "n"])

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Columns vec_id, n_links, component_id, kept."""
    # 32-bit components travel as such and are widened, without loss, where they are compared
    single = vectors.schema["embedding"].dataType == ArrayType(FloatType(), vectors.schema["embedding"].dataType.containsNull)
    kind = "<f4" if single else "<f8"
    vec_id, e = F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if single else "array<double>")
    good = vec_id.isNotNull() & F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0), F.lit(False))
    scaled = F.transform(e, lambda x: x / F.array_max(F.transform(e, lambda y: F.abs(y))))  # no overflow in the norm
    rows = vectors.select(vec_id.alias("vec_id"), F.when(good, e if single else scaled).alias("e"))
    sound = materialize(rows.where("e is not null").distinct(), "vectors")
    # classes get numbers of their own, so that a vec_id with several vectors is in several classes
    classes = materialize(sound.groupBy("e").agg(F.min("vec_id").alias("first"), F.count("*").alias("mult")).withColumn("vid", F.monotonically_increasing_id()), "vector-classes")
    own = sound.join(classes.select("e", "vid", "mult"), "e").select("vec_id", F.xxhash64("e").alias("key"), "vid", "mult")
    reps = classes.select("vid", "mult", "e")
    keyed = materialize(reps.mapInArrow(_packed(kind), "vid long, mult long, v binary").mapInArrow(_keyed(kind), KEYED), "cells")

    large = keyed.groupBy("tab", "cell").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK).withColumn("nb", F.ceil(F.col("rows") / BLOCK)).drop("rows")
    dealt = keyed.join(large, ["tab", "cell"], "left").withColumn("nb", F.coalesce("nb", F.lit(1).cast("long")))
    dealt = dealt.withColumn("blk", F.pmod(F.xxhash64("vid"), "nb")).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    dealt = dealt.select("tab", "cell", F.least("blk", "o").alias("p"), F.greatest("blk", "o").alias("q"), "blk", "home", "vid", "mult", "v")
    parts = max(1, keyed.count() // ROWS_PER_PART)
    found = dealt.withColumn("part", F.pmod(F.xxhash64("tab", "cell", "p", "q"), F.lit(parts))).groupBy("part").applyInArrow(_linker(threshold, kind), FOUND)
    found = materialize(found, "vector-links")
    links = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    comp = components(reps.select("vid"), found.where("b is not null").select("a", "b"), "vid").join(classes.select("vid", "first"), "vid")
    name = comp.groupBy("component_id").agg(F.min("first").alias("name"))
    comp = comp.join(name, "component_id").select("vid", "name")

    by_class = comp.join(links, comp["vid"] == links["a"], "left").select("vid", "name", F.coalesce("n", F.lit(0)).alias("n"))
    per_row = own.join(by_class, "vid").select(F.col("vec_id").alias("id"), F.col("key").alias("row_key"), (F.col("n") + F.col("mult") - 1).alias("n_links"), "name")
    out = rows.select("vec_id", F.when(F.col("e").isNotNull(), F.xxhash64("e")).alias("key"))
    out = out.join(per_row, (F.col("vec_id") == F.col("id")) & (F.col("key") == F.col("row_key")), "left")
    component = F.coalesce("name", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _packed(kind: str):
    """Vectors as little-endian floats of the given kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = [np.asarray(x, kind).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(v, pa.binary())], ["vid", "mult", "v"])

    return run
