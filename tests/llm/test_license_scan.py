"""License scan: the join against brute force, real texts, and prose that holds a notice's words."""

import random

import pytest

from barloom.llm import license_scan as ls

SCHEMA = "doc_id long, text string"


def brute(texts, known):
    """Of each text every (stride, block, label, share) that meets a template, and the places of base phrases."""
    out = []
    for text in texts:
        words, met, places = ls.words_of(text or ""), set(), []
        for t, label, base, share in known:
            phrase, stride = ls.words_of(t), ls.stride_of(t)
            own = set(phrase)
            if base:
                places += [(i, label) for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
            for k in range(len(words) // stride + 1):
                block = words[k * stride : (k + 2) * stride]
                held = len(own & set(block))
                spelled = any(block[i : i + len(phrase)] == phrase for i in range(min(stride, len(block))))
                if held >= share * len(own) - 1e-9 and held and (base or len(own) >= ls.SHORT or spelled):
                    met.add((stride, k, label, held / len(own)))
        out.append((len(words), met, places))
    return out


def check(spark, texts, known):
    got = {r.doc_id: r for r in ls.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3), known).collect()}
    for i, (n, met, places) in enumerate(brute(texts, known)):
        r = got[i]
        assert r.n_words == n and {tuple(b) for b in r.blocks or []} == met, texts[i]
        assert r.n_base == len(places) and (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and r.labels == ",".join(sorted({m[2] for m in met}))
        assert r.score == pytest.approx(max((m[3] for m in met), default=0.0))


def test_join_is_that_of_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    known = [(" ".join(rng.sample(vocabulary, 4)), f"base{i}", True, 1.0) for i in range(3)]
    known += [(" ".join(rng.choices(vocabulary, k=n)), f"label{n}", False, share) for n, share in ((3, 0.8), (9, 0.5), (14, 0.8), (33, 0.8), (70, 0.9))]
    texts = [None, "", "...", "w1"]
    for _ in range(40):
        text = rng.choices(vocabulary + [f"other{i}" for i in range(60)], k=rng.randint(1, 300))
        for t, *_ in rng.sample(known, 2):
            at = rng.randint(0, len(text))
            text[at:at] = ls.words_of(t)[: rng.choice([2, 3, 50, 200])]
        texts.append(" ".join(text).replace("w1 ", "W1, "))
    check(spark, texts, known)


def test_the_real_texts(spark):
    rng = random.Random(4)
    prose = [f"word{i}" for i in range(300)]
    texts, want = [], []
    for text, label in ls.NOTICES.items():
        near = [w for w in text.split() if rng.random() > 0.05] if len(text.split()) > 40 else text.split()
        texts.append(" ".join([*rng.choices(prose, k=100), *near, *rng.choices(prose, k=100)]))
        want.append(label)
    check(spark, texts, ls.templates())
    got = {r.doc_id: r.labels.split(",") for r in ls.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert all(label in got[i] for i, label in enumerate(want))


def test_prose_with_the_words_of_a_notice_has_no_label(spark):
    texts = ["All seats are reserved and the rights of guests matter to us", "The creative mind of the commons sees attribution as a gift, noncommercial or not", "a public version of the license was shown in 2 rooms of the mozilla house"]
    got = ls.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert all(r.labels == "" and r.score == 0 for r in got)
