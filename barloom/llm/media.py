"""Copies of images, also cropped or edited ones, by local descriptors.

Images are a binary column of grey PGM (P5) rasters. At two scales, corners (local maxima of the Harris
response) get an orientation from the intensity centroid of their patch and 64 binary brightness tests rotated
to it. Patches of smooth images are alike too often to be searched one by one, so a corner is searched together with
each of its ``NEAR`` nearest neighbours: in each of ``TABLES`` Hamming tables some of both corners' bits, sampled for the
table, are the key, and entries of equal keys whose other sampled bits and relative directions agree are a hit. Keys
have the same bits at any size of the library, so whether two images are found does not depend on what else it holds.

Pairs of images with hits at ``LEAST_HITS`` corners are candidates. Of each pair, all descriptors within
``MOST_BITS`` are matches; each proposes the turn and scale between its two corners, the shift, turn and scale that fit
the matches near this proposal are solved by least squares, and images match when enough distinct corners agree with
one solution. Equal images are one class, so copies are never joined with each other; a query that equals a library
image byte for byte matches it whatever its corners are.

Images are dealt into blocks of about as many entries as a task should take, and each block of queries meets each block of
the library by sorted keys. So all hits of two images are counted in one task, which gives out candidates only, and images with a
very common key are spread over the blocks.

Defined results: null, empty and unreadable images match nothing; images without corners match their equals only; a
null id is dropped; repeated (id, image) rows count once; images smaller than a patch have no corners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix

RADIUS, TESTS, TURNS = 11, 64, 16
MOST_BITS, LEAST_VOTES = 8, 4
#: Pixels within which a match agrees; how often, at most, unrelated corners may be expected to agree as well.
AGREE, ALARMS = 2.0, 0.001
#: Pairs of matches and pixels of images that are held at a time.
PAIRS_HELD, HELD = 200_000, 1_000_000
#: Neighbours of a corner, tables, and corners at which a candidate has hits.
NEAR, TABLES, LEAST_HITS = 3, 4, 2
#: Bits of a key; the rest of an entry's 64 sampled bits, without three for the table, may differ in a fifth.
KEY_BITS = 36
#: Entries of either side that a task takes at a time.
ENTRIES = 400_000
POINTS = "id long, places binary, bits binary"
ENTRY = "block int, ids binary, words binary, geos binary"


def _offsets() -> np.ndarray:
    """Test pairs for each turn: [turn, test, end, (dx, dy)]."""
    rng = np.random.default_rng(11)
    p = np.clip(rng.normal(scale=RADIUS / 2.2, size=(TESTS, 2, 2)), -RADIUS * 0.7, RADIUS * 0.7)
    a = np.arange(TURNS) * 2 * np.pi / TURNS
    turn = np.stack([np.stack([np.cos(a), -np.sin(a)], -1), np.stack([np.sin(a), np.cos(a)], -1)], 1)
    return np.rint(np.einsum("tij,nej->tnei", turn, p)).astype(int)


PAIRS = _offsets()


def encode_pgm(pixels: np.ndarray) -> bytes:
    h, w = pixels.shape
    return b"P5\n%d %d\n255\n" % (w, h) + pixels.astype(np.uint8).tobytes()


def decode_pgm(raw: bytes | None) -> np.ndarray | None:
    """A two-dimensional array, or None for what is no such raster."""
    try:
        kind, shape, top, body = raw.split(b"\n", 3)
        w, h = map(int, shape.split())
        return np.frombuffer(body, np.uint8)[: w * h].reshape(h, w) if kind == b"P5" and int(top) == 255 and w and h else None
    except (ValueError, AttributeError):
        return None


def _box(x: np.ndarray) -> np.ndarray:
    p = np.pad(x, ((0, 0), (1, 1), (1, 1)), mode="edge")
    r = p[:, :, :-2] + p[:, :, 1:-1] + p[:, :, 2:]
    return (r[:, :-2] + r[:, 1:-1] + r[:, 2:]) / 9


def describe(images: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of equally large images: image, x, y, turn and bits of every corner."""
    n, h, w = images.shape
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    if min(h, w) <= 2 * RADIUS + 1:
        return none
    blur = _box(_box(images.astype(np.float32)))
    gy, gx = np.gradient(blur, axis=(1, 2))
    a, b, c = _box(gx * gx), _box(gy * gy), _box(gx * gy)
    r = a * b - c * c - 0.05 * (a + b) ** 2
    p = np.pad(r, ((0, 0), (1, 1), (1, 1)), constant_values=np.inf)
    top = np.max([p[:, i : i + h, j : j + w] for i in range(3) for j in range(3) if (i, j) != (1, 1)], axis=0)
    ok = (r > top) & (r > np.maximum(0.02 * r.max(axis=(1, 2), keepdims=True), 1e-3))
    ok[:, :RADIUS], ok[:, -RADIUS:], ok[:, :, :RADIUS], ok[:, :, -RADIUS:] = False, False, False, False
    i, y, x = np.nonzero(ok)
    if not len(i):
        return none
    d = np.arange(-RADIUS + 4, RADIUS - 3)
    patch = blur[i[:, None, None], y[:, None, None] + d[None, :, None], x[:, None, None] + d[None, None, :]]
    angle = np.arctan2((patch * d[None, :, None]).sum(axis=(1, 2)), (patch * d[None, None, :]).sum(axis=(1, 2)))
    turn = np.rint(angle * TURNS / (2 * np.pi)).astype(int) % TURNS
    o = PAIRS[turn]
    v = blur[i[:, None, None], y[:, None, None] + o[..., 1], x[:, None, None] + o[..., 0]]
    bits = ((v[:, :, 0] < v[:, :, 1]).astype(np.uint64) << np.arange(TESTS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return i, x, y, turn, bits.view(np.int64)


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, image) to the places and bits of each image's corners; images without corners drop."""

    def emit(ids: list, images: list) -> Iterator[pa.RecordBatch]:
        ids, stack = np.array(ids), np.stack(images)
        out = []
        for level in (0, 1):
            if level:
                h, w = stack.shape[1] // 2 * 2, stack.shape[2] // 2 * 2
                stack = stack[:, :h, :w].reshape(len(stack), h // 2, 2, w // 2, 2).mean(axis=(2, 4))
            i, x, y, turn, bits = describe(stack)
            out.append((i, place(turn, level, y << level, x << level), bits))
        i, at, bits = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.argsort(i, kind="stable")
        i, at, bits = i[order], at[order].astype("<i8"), bits[order].astype("<i8")
        edge = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1], [True]])) if len(i) else np.zeros(1, int)
        rows = [(int(ids[i[a]]), at[a:b].tobytes(), bits[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        cols = zip(*rows, strict=True) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["id", "places", "bits"])

    for batch in batches:
        groups: dict[tuple, tuple[list, list]] = {}
        for vid, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            image = decode_pgm(raw)
            if image is not None:
                g = groups.setdefault(image.shape, ([], []))
                g[0].append(vid)
                g[1].append(image)
                if len(g[0]) * image.size >= HELD:
                    yield from emit(*groups.pop(image.shape))
        for g in groups.values():
            yield from emit(*g)


def points(images: DataFrame) -> DataFrame:
    """(id, image) rows to one row per image that has corners."""
    return images.where("id is not null and image is not null").select(F.col("id").cast("long").alias("id"), "image").mapInArrow(_points, POINTS)


def _readable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([decode_pgm(raw) is not None for raw in batch.column(1).to_pylist()], pa.bool_()))


def readable(images: DataFrame) -> DataFrame:
    """The (id, image) rows that hold an id and a raster."""
    return images.where("id is not null and image is not null").select(F.col("id").cast("long").alias("id"), "image").mapInArrow(_readable, "id long, image binary")


def place(turn: np.ndarray, level: int | np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Turn, level and position of a corner in one number."""
    return (np.asarray(turn, np.int64) << 48) + (np.asarray(level, np.int64) << 40) + (np.asarray(y, np.int64) << 20) + x


def _parts(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (place & 0xFFFFF) + 1j * (place >> 20 & 0xFFFFF), place >> 48, place >> 40 & 0xFF


def neighbours(z: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """For each point its ``near`` nearest others: both indices, at a bounded number of distances at a time."""
    n = len(z)
    k = min(near, n - 1)
    if k <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    out, step = [], max(1, PAIRS_HELD // n)
    for lo in range(0, n, step):
        d = np.abs(z[lo : lo + step, None] - z[None, :])
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(d, axis=1)[:, :k])
    return np.repeat(np.arange(n), k), np.concatenate(out).ravel()


def _samples() -> np.ndarray:
    """Which 64 of a pair's 128 bits each table looks at, those of its key first: [table, bit]."""
    rng = np.random.default_rng(13)
    one, two = (np.stack([rng.permutation(64)[:32] for _ in range(TABLES)]) for _ in range(2))
    return np.stack([one, two + 64], axis=2).reshape(TABLES, 64)


SAMPLES = _samples()


def pair_words(bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sampled bits of pairs of corners for each table, the key's at the top: [table, pair]."""
    both = np.concatenate([np.unpackbits(bits[i].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") for i in (a, b)], axis=1)
    return np.stack([np.ascontiguousarray(np.packbits(both[:, s], axis=1)).view(">u8").ravel().astype(np.uint64) for s in SAMPLES])


def _entries(blocks: int):
    """Corners' packed rows to entries of all tables, packed by the images' blocks: ids, sampled bits, and corner, direction and turn of the neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            held = 0
            for vid, raw_at, raw_bits in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at, bits = np.frombuffer(raw_at, "<i8"), np.frombuffer(raw_bits, "<u8")
                z, turn, level = _parts(at)
                for lev in np.unique(level):
                    own = np.flatnonzero(level == lev)
                    a, b = (own[i] for i in neighbours(z[own], NEAR))
                    if len(a):
                        toward = np.rint(np.angle(z[b] - z[a]) * TURNS / (2 * np.pi)).astype(np.int64)
                        geo = (a & 0xFFFF) << 8 | (toward - turn[a]) % TURNS << 4 | (turn[b] - turn[a]) % TURNS
                        found.append((np.full(len(a), vid), bits[a], bits[b], geo))
                        held += len(a)
                if held >= ENTRIES // 16:
                    yield table(emit(found))
                    found, held = [], 0
            if found:
                yield table(emit(found))

    def emit(found: list[tuple]) -> Iterator[tuple]:
        vid, one, two, geo = (np.concatenate(c) for c in zip(*found, strict=True))
        n = len(vid)
        words = pair_words(np.concatenate([one, two]), np.arange(n), np.arange(n, 2 * n))
        vid, geo = vid.astype("<i8"), geo.astype("<i4")
        # the table in the lowest bits, instead of the last sampled ones
        words = (words & ~np.uint64(7)) | np.arange(TABLES, dtype=np.uint64)[:, None]
        block = (mix(vid.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], np.diff(block[order]) != 0, [True]]))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            i = order[a:b]
            yield int(block[i[0]]), np.tile(vid[i], TABLES).tobytes(), words[:, i].astype("<u8").tobytes(), np.tile(geo[i], TABLES).tobytes()

    def table(rows: Iterator[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32()] + [pa.binary()] * 3
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [c.split()[0] for c in ENTRY.split(", ")])

    return run


def _hits(t: pa.Table) -> pa.Table:
    """Of the entries of two blocks: the pairs of images of which LEAST_HITS of the query's corners (modulo 64) share a key and agree in the rest."""
    top = np.uint64(2**64 - 2 ** (64 - KEY_BITS)) | np.uint64(7)
    slack = (61 - KEY_BITS) // 5
    sides = []
    for side in (0, 1):
        c = t.filter(pc.equal(t["side"], side))
        id_, word, geo = (np.frombuffer(b"".join(c[n].to_pylist()), kind) for n, kind in (("ids", "<i8"), ("words", "<u8"), ("geos", "<i4")))
        # queries image by image, so that what is found of one is counted at once
        order = np.argsort(word & top if side else id_, kind="stable")
        sides.append((id_[order], word[order], geo[order].astype(np.int64)))
    (qid, qw, qg), (lid, lw, lg) = sides
    keys = lw & top
    lo, hi = np.searchsorted(keys, qw & top, "left"), np.searchsorted(keys, qw & top, "right")
    n = hi - lo
    ends, out, i = np.cumsum(n), [], 0
    while i < len(qid):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS_HELD, "right")))
        q = np.repeat(np.arange(i, j), n[i:j])
        l = np.repeat(lo[i:j], n[i:j]) + np.arange(len(q)) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j])
        i = j
        ok = np.bitwise_count((qw[q] ^ lw[l]) & ~top) <= slack
        for shift in (4, 0):
            off = ((qg[q] >> shift) - (lg[l] >> shift) + TURNS // 2) % TURNS - TURNS // 2
            ok &= np.abs(off) <= 2
        q, l = q[ok], l[ok]
        out.append(_merged(qid[q], lid[l], np.uint64(1) << (qg[q] >> 8 & 63).astype(np.uint64)))
    q, l, corners = _merged(*(np.concatenate(c) for c in zip(*out, strict=True))) if out else [np.empty(0, np.int64)] * 3
    enough = np.bitwise_count(corners) >= LEAST_HITS
    return pa.table([pa.array(q[enough]), pa.array(l[enough])], ["q_id", "l_id"])


def _merged(q: np.ndarray, l: np.ndarray, corners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((l, q))
    q, l, corners = q[order], l[order], corners[order]
    if not len(q):
        return q, l, corners
    first = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (l[1:] != l[:-1])]))
    return q[first], l[first], np.bitwise_or.reduceat(corners, first)


def consensus(q: np.ndarray, l: np.ndarray, counts: np.ndarray, area: np.ndarray) -> np.ndarray:
    """For each pair of images, whose ``counts`` matches of places follow each other, the most corners that agree on one similarity.

    Where so many would be expected to agree by chance more than ALARMS times, as matches of images with many corners
    do, none count; ``area`` is where the library image has corners.
    """
    (zq, tq, lq), (zl, tl, ll) = _parts(q), _parts(l)
    turn, level = (tl - tq) % TURNS, ll - lq
    scale = 2.0**level
    move = scale * np.exp(2j * np.pi * turn / TURNS)
    name_q, name_l = (np.unique(c, return_inverse=True)[1] for c in (q, l))
    size, start = np.repeat(counts, counts), np.repeat(np.cumsum(counts) - counts, counts)
    ends, votes = np.cumsum(size), np.zeros(len(q), np.int64)
    lo = 0
    while lo < len(q):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - size[lo] + PAIRS_HELD, "right")))
        i = np.repeat(np.arange(lo, hi), size[lo:hi])
        j = start[i] + np.arange(len(i)) - np.repeat(np.cumsum(size[lo:hi]) - size[lo:hi], size[lo:hi])
        off = (turn[j] - turn[i] + TURNS // 2) % TURNS - TURNS // 2
        alike = (np.abs(off) <= 1) & (level[i] == level[j])  # each match is like itself
        i, j = i[alike], j[alike]
        h, first = i - lo, np.searchsorted(i, np.arange(lo, hi))
        dq, dl, z0, near = zq[j] - zq[i], zl[j] - zl[i], move[lo:hi], AGREE * np.maximum(1, scale[lo:hi])
        # a turn is known to half a step of its own and its neighbour's, so far corners may be further off at first
        agree = np.abs(dl - z0[h] * dq) <= near[h] + 0.3 * scale[i] * np.abs(dq)
        with np.errstate(divide="ignore", invalid="ignore"):
            for slack in (2, 1, 1):
                n, sq, sl, qq, ql = (np.add.reduceat(np.where(agree, v, 0), first) for v in (np.ones(len(i)), dq, dl, np.abs(dq) ** 2, np.conj(dq) * dl))
                z = (ql - np.conj(sq) * sl / n) / (qq - np.abs(sq) ** 2 / n)
                z = np.where(np.abs(z / z0 - 1) <= 0.5, z, z0)
                t = (sl - z * sq) / n
                agree = np.abs(dl - z[h] * dq - t[h]) <= slack * near[h]
        tried = np.bincount(h, minlength=hi - lo)
        chance = np.maximum(tried - 2, 0) * np.minimum(1, np.pi * near**2 / np.repeat(area, counts)[lo:hi])
        h, j = h[agree], j[agree]
        distinct = [np.bincount(np.unique(h * (name.max() + 1) + name[j]) // (name.max() + 1), minlength=hi - lo) for name in (name_q, name_l)]
        most = np.minimum(*distinct)
        more = np.maximum(most - 2, 1)  # two matches fix the similarity; a bound on the Poisson tail of the others
        with np.errstate(divide="ignore"):
            alarms = np.log(tried) - chance + more + more * np.log(chance / more)
        votes[lo:hi] = np.where((more > chance) & (alarms <= np.log(ALARMS)), most, 0)
        lo = hi
    return np.maximum.reduceat(votes, np.cumsum(counts) - counts) if len(q) else votes


def verified(qat: list[np.ndarray], qbits: list[np.ndarray], lat: list[np.ndarray], lbits: list[np.ndarray]) -> np.ndarray:
    """For each pair of images, given by their corners' places and bits, how many corners agree on one similarity."""
    q, l, counts, area, use = [], [], [], [], []
    for n, (a, x, b, y) in enumerate(zip(qat, qbits, lat, lbits, strict=True)):
        near, step = [], max(1, PAIRS_HELD // len(y))
        for at in range(0, len(x), step):
            i, j = np.nonzero(np.bitwise_count(x[at : at + step, None] ^ y[None, :]) <= MOST_BITS)
            near.append((i + at, j))
        i, j = (np.concatenate(c) for c in zip(*near, strict=True))
        if len(i) >= LEAST_VOTES:
            q.append(a[i])
            l.append(b[j])
            counts.append(len(i))
            px, py = b & 0xFFFFF, b >> 20 & 0xFFFFF
            area.append((np.ptp(px) + 2 * AGREE) * (np.ptp(py) + 2 * AGREE))
            use.append(n)
    votes = np.zeros(len(qat), np.int64)
    if use:
        votes[use] = consensus(np.concatenate(q), np.concatenate(l), np.array(counts), np.array(area))
    return votes


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            corners = [[np.frombuffer(x, kind) for x in part.column(c).to_pylist()] for c, kind in ((2, "<i8"), (3, "<u8"), (4, "<i8"), (5, "<u8"))]
            votes = verified(*corners)
            out = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(votes.astype(np.int32))], ["q_id", "l_id", "votes"])
            yield out.filter(pa.array(votes >= LEAST_VOTES))


def candidates(ask: DataFrame, lib: DataFrame) -> DataFrame:
    """Of packed corners of queries and library: (q_id, l_id) of pairs with hits at LEAST_HITS corners."""
    corners = [int(df.agg(F.sum(F.octet_length("bits")) / 8).first()[0] or 0) for df in (ask, lib)]
    blocks = [n * NEAR * TABLES // ENTRIES + 1 for n in corners]
    sides = [df.mapInArrow(_entries(n), ENTRY) for df, n in zip((ask, lib), blocks, strict=True)]
    each = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in blocks]
    q = sides[0].withColumnRenamed("block", "qb").withColumn("lb", each[1]).withColumn("side", F.lit(0))
    l = sides[1].withColumnRenamed("block", "lb").withColumn("qb", each[0]).withColumn("side", F.lit(1))
    return q.unionByName(l).groupBy("qb", "lb").applyInArrow(_hits, "q_id long, l_id long")


def agreeing_images(pairs: DataFrame, ask: DataFrame, lib: DataFrame) -> DataFrame:
    """Of pairs (q_id, l_id) and packed corners: q_id, l_id and votes of those with LEAST_VOTES."""
    q = ask.select(F.col("id").alias("q_id"), F.col("places").alias("q_places"), F.col("bits").alias("q_bits"))
    l = lib.select(F.col("id").alias("l_id"), F.col("places").alias("l_places"), F.col("bits").alias("l_bits"))
    both = pairs.join(q, "q_id").join(l, "l_id").select("q_id", "l_id", "q_places", "q_bits", "l_places", "l_bits")
    return both.mapInArrow(_judge, "q_id long, l_id long, votes int")


def image_links(queries: DataFrame, library: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (id, image) tables: all matches (query_id, class_id, votes, same) and the images of the library's classes (id, class_id).

    A class is one image under all its ids, named by the smallest; ``same`` is 1 where the query equals it.
    """
    held = materialize(readable(library).distinct(), "images")
    classes = materialize(held.groupBy("image").agg(F.min("id").alias("id")), "classes")
    members = materialize(held.join(classes.withColumnRenamed("id", "class_id"), "image").select("id", "class_id"), "members")
    asked = materialize(readable(queries).distinct(), "queries")
    lib = materialize(points(classes.select("id", "image")), "library-points")
    ask = materialize(points(asked), "query-points")
    pairs = materialize(candidates(ask, lib), "candidates")
    pair = agreeing_images(pairs, ask, lib).withColumn("same", F.lit(0))
    same = asked.join(classes.select("image", F.col("id").alias("l_id")), "image").select(F.col("id").alias("q_id"), "l_id", F.lit(0).alias("votes"), F.lit(1).alias("same"))
    links = pair.unionByName(same).groupBy(F.col("q_id").alias("query_id"), F.col("l_id").alias("class_id")).agg(F.max("votes").alias("votes"), F.max("same").alias("same"))
    return materialize(links, "links"), members


def matching_images(queries: DataFrame, library: DataFrame) -> DataFrame:
    """A summary of image_links: query_id, n_matches (library images), best_id and best_votes; one row per query."""
    links, members = image_links(queries, library)
    pair = links.join(members.groupBy("class_id").agg(F.count("*").alias("copies")), "class_id")
    best = pair.groupBy(F.col("query_id").alias("q_id")).agg(F.sum("copies").alias("n_matches"), F.min_by("class_id", F.struct(-F.col("same"), -F.col("votes"), F.col("class_id"))).alias("best_id"), F.max("votes").alias("best_votes"))
    out = queries.where("id is not null").select(F.col("id").cast("long").alias("query_id")).distinct().join(best, F.col("query_id") == F.col("q_id"), "left")
    return out.select("query_id", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), "best_id", F.coalesce("best_votes", F.lit(0)).cast("long").alias("best_votes"))


def _render(edit: bool):
    """Vectors to square rasters: the components as a grid, enlarged smoothly; an edit crops, brightens and flattens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for e in batch.column(1).to_pylist():
                side = int(len(e or []) ** 0.5)
                v = np.array((e or [])[: side * side], float)
                if side < 2 or not np.isfinite(v).all() or v.max() == v.min():
                    out.append(None)
                    continue
                g = ((v - v.min()) / (v.max() - v.min())).reshape(side, side)
                at = (np.arange(8 * side) + 0.5) / 8 - 0.5
                lo = np.clip(np.floor(at).astype(int), 0, side - 2)
                f = np.clip(at - lo, 0, 1)
                rows = g[lo] * (1 - f)[:, None] + g[lo + 1] * f[:, None]
                image = rows[:, lo] * (1 - f) + rows[:, lo + 1] * f
                image = 40 + 0.7 * 200 * image[5:-7, 3:-4] if edit else 20 + 200 * image
                out.append(encode_pgm(np.rint(image)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "image"])

    return run


def rendered(vectors: DataFrame, edit: bool = False) -> DataFrame:
    """(vec_id, embedding) to (id, image)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.filter(F.col("embedding").cast("array<double>"), lambda x: x.isNotNull()).alias("e"))
    return rows.mapInArrow(_render(edit), "id long, image binary")
