"""Edited copies of images, small equal images, and the index of descriptors against brute force."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from barloom.llm import media

IMAGES = "id long, image binary"


def half(x):
    return x.reshape(x.shape[0] // 2, 2, x.shape[1] // 2, 2).mean(axis=(1, 3))


def turned(x, degrees):
    """Turned about the centre, with the corners filled by the nearest pixels."""
    h, w = x.shape
    a = np.deg2rad(degrees)
    y, x_ = np.mgrid[:h, :w] - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]
    u = np.clip(np.cos(a) * x_ + np.sin(a) * y + (w - 1) / 2, 0, w - 1.001)
    v = np.clip(-np.sin(a) * x_ + np.cos(a) * y + (h - 1) / 2, 0, h - 1.001)
    i, j = v.astype(int), u.astype(int)
    f, g = v - i, u - j
    return x[i, j] * (1 - f) * (1 - g) + x[i + 1, j] * f * (1 - g) + x[i, j + 1] * (1 - f) * g + x[i + 1, j + 1] * f * g


EDITS = {
    "turned 90": lambda x, rng: np.rot90(x),
    "turned 180": lambda x, rng: x[::-1, ::-1],
    "turned 22.5": lambda x, rng: turned(x, 22.5),
    "half": lambda x, rng: half(x),
    "half and turned": lambda x, rng: np.rot90(half(x), 3),
    "noise": lambda x, rng: np.clip(x + rng.normal(scale=2, size=x.shape), 0, 255),
    "crop": lambda x, rng: 30 + 0.7 * x[5:-7, 3:-4],
}


@pytest.fixture(scope="module")
def library(spark):
    rng = np.random.default_rng(6)
    v = spark.createDataFrame([(i, rng.normal(size=256).tolist()) for i in range(24)], "vec_id long, embedding array<double>")
    return media.rendered(v).collect()


@pytest.fixture(scope="module")
def edited(library):
    rng = np.random.default_rng(7)
    return [(1000 * n + r.id, media.encode_pgm(np.rint(edit(media.decode_pgm(r.image).astype(float), rng)))) for n, edit in enumerate(EDITS.values()) for r in library[::2]]


def test_edited_copies(spark, library, edited):
    got = {r.query_id: r for r in media.matching_images(spark.createDataFrame(edited, IMAGES), spark.createDataFrame(library, IMAGES)).collect()}
    found = {name: sum(got[1000 * n + r.id].best_id == r.id for r in library[::2]) for n, name in enumerate(EDITS)}
    wrong = [q for q, r in got.items() if r.n_matches and r.best_id != q % 1000]
    assert not wrong and min(found.values()) >= 11, found


def test_equal_images_without_corners(spark):
    flat, dot, tiny = np.full((40, 40), 90), np.full((40, 40), 90), np.arange(80).reshape(8, 10)
    dot[18:23, 18:23] = 200
    lib = spark.createDataFrame([(10 * i, media.encode_pgm(x)) for i, x in enumerate((flat, dot, tiny))] + [(7, media.encode_pgm(tiny)), (8, b"junk"), (9, b"")], IMAGES)
    ask = spark.createDataFrame([(1, media.encode_pgm(flat)), (2, media.encode_pgm(dot)), (3, media.encode_pgm(tiny)), (4, b"junk"), (5, b""), (6, None)], IMAGES)
    got = {r.query_id: (r.n_matches, r.best_id) for r in media.matching_images(ask, lib).collect()}
    assert got == {1: (1, 0), 2: (1, 10), 3: (2, 7), 4: (0, None), 5: (0, None), 6: (0, None)}


def packed(spark, images):
    """(id, [(turn, level, y, x, bits)]) to the operator's packed corners."""
    rows = []
    for i, corners in images:
        turn, level, y, x, bits = (np.array(c) for c in zip(*corners, strict=True))
        rows.append((i, bytearray(media.place(turn, level, y, x).astype("<i8").tobytes()), bytearray(bits.astype("<u8").tobytes())))
    return spark.createDataFrame(rows, media.POINTS)


def test_matches_up_to_the_bound_agree(spark):
    rng = np.random.default_rng(9)
    lib, ask = [], []
    for i in range(12):  # image i has i differing bits in each descriptor
        corners = [(int(rng.integers(16)), 0, int(y), int(x), int(rng.integers(0, 2**63))) for x, y in rng.integers(0, 500, (6, 2))]
        lib.append((i, corners))
        ask.append((100 + i, [(t, lv, y + 46, x + 9, bits ^ sum(1 << int(b) for b in rng.choice(63, i, replace=False))) for t, lv, y, x, bits in corners]))
    pairs = spark.createDataFrame([(100 + i, j) for i in range(12) for j in range(12)], "q_id long, l_id long")
    got = media.agreeing_images(pairs, packed(spark, ask), packed(spark, lib)).collect()
    assert sorted(map(tuple, got)) == [(100 + i, i, 6) for i in range(media.MOST_BITS + 1)]


def test_consensus_counts_the_corners_of_the_best_similarity():
    """Against every shift, turn and scale that two matches give."""
    rng = np.random.default_rng(5)
    for seed in range(20):
        n, wrong = 9, seed % 4
        zq = rng.integers(20, 400, n) + 1j * rng.integers(20, 400, n)
        turn = int(rng.integers(16))
        zl = np.exp(2j * np.pi * turn / 16) * zq + 900 + 900j
        zl[:wrong] = rng.integers(20, 1800, wrong) + 1j * rng.integers(20, 1800, wrong)
        q = media.place(np.zeros(n, int), 0, zq.imag.astype(int), zq.real.astype(int))
        l = media.place(np.full(n, turn), 0, np.rint(zl.imag).astype(int), np.rint(zl.real).astype(int))
        best = 0
        for i in range(n):
            for j in range(n):
                if i != j:
                    z = (zl[j] - zl[i]) / (zq[j] - zq[i])
                    if abs(z - np.exp(2j * np.pi * turn / 16)) < 0.1:
                        best = max(best, int((np.abs(zl - zl[i] - z * (zq - zq[i])) <= media.AGREE).sum()))
        got = int(media.consensus(q, l, np.array([n]), np.array([4e6]))[0])
        assert best - 1 <= got <= best + 1 and got >= n - wrong


def test_neighbours_are_the_nearest():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 4, 60):
        z = rng.random(n) + 1j * rng.random(n)
        a, b = media.neighbours(z, 3)
        for i in range(n):
            d = np.abs(z - z[i])
            want = sorted((d[j], j) for j in range(n) if j != i)[:3]
            assert sorted(b[a == i].tolist()) == sorted(j for _, j in want)


def test_tables_find_what_all_pairs_find(spark, library, edited):
    """Recall of the tables against the same votes over all pairs, with blocks cut as for a very common key."""
    ask, lib = (media.points(spark.createDataFrame(rows, IMAGES)) for rows in (edited, library))
    ask, lib = spark.createDataFrame(ask.collect(), media.POINTS), spark.createDataFrame(lib.collect(), media.POINTS)
    every = media.agreeing_images(ask.select(F.col("id").alias("q_id")).crossJoin(lib.select(F.col("id").alias("l_id"))), ask, lib)
    brute = {(r.q_id, r.l_id) for r in every.collect()}
    found = {(r.q_id, r.l_id) for r in media.agreeing_images(media.candidates(ask, lib), ask, lib).collect()}
    true = {x for x in brute if x[0] % 1000 == x[1]}
    assert found <= brute and len(found & true) >= 0.9 * len(true) and len(true) >= 0.9 * len(edited)


def test_a_common_key_is_cut_into_blocks(spark, library, monkeypatch):
    first = media.decode_pgm(library[0].image)
    rng = np.random.default_rng(3)
    rows = [(i, media.encode_pgm(np.clip(first + (rng.random(first.shape) < 0.01) * 9, 0, 255))) for i in range(30)]
    lib = spark.createDataFrame(media.points(spark.createDataFrame(rows, IMAGES)).collect(), media.POINTS)
    whole = {(r.q_id, r.l_id) for r in media.candidates(lib, lib).collect()}
    monkeypatch.setattr(media, "ENTRIES", 700)
    monkeypatch.setattr(media, "PAIRS_HELD", 5_000)
    cut = {(r.q_id, r.l_id) for r in media.candidates(lib, lib).collect()}
    assert whole == cut and len(whole) > 500


def test_candidates_do_not_depend_on_the_size_of_the_library(spark, library, edited):
    """400,000 images of one corner, which have no pairs of corners to be found by, beside the library change nothing."""
    turns = [(9000 + r.id, media.encode_pgm(np.rint(turned(media.decode_pgm(r.image).astype(float), 35)))) for r in library[::2]]
    ask, lib = (spark.createDataFrame(media.points(spark.createDataFrame(rows, IMAGES)).collect(), media.POINTS) for rows in (edited + turns, library))
    lone = spark.range(1000, 401_000).select("id", F.unhex(F.lit("00" * 8)).alias("places"), F.unhex(F.lit("5A" * 8)).alias("bits"))
    small, large = ({(r.q_id, r.l_id) for r in media.candidates(ask, x).collect()} for x in (lib, lib.unionByName(lone)))
    assert small == large and sum((9000 + r.id, r.id) in large for r in library[::2]) >= 11


def test_all_links_and_members_are_returned(spark, library):
    first, other = library[0].image, library[1].image
    crop = media.encode_pgm(EDITS["crop"](media.decode_pgm(first).astype(float), None))
    lib = spark.createDataFrame([(5, first), (3, first), (9, crop), (4, crop), (4, crop), (6, other), (2, b"junk")], IMAGES)
    links, members = media.image_links(spark.createDataFrame([(1, first), (2, other), (3, None)], IMAGES), lib)
    assert {(r.query_id, r.class_id, r.same) for r in links.collect()} == {(1, 3, 1), (1, 4, 0), (2, 6, 1)}
    assert all(r.votes >= media.LEAST_VOTES for r in links.collect())
    assert sorted(map(tuple, members.collect())) == [(3, 3), (4, 4), (5, 3), (6, 6), (9, 4)]
