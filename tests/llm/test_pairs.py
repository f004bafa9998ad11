"""Substring, line, near-duplicate, exact and benchmark operators against plain loops."""

import random

import brute
import pytest

from formline.llm import components, decontaminate, lines, minhash, substrings


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("window", [4, 20, 35])
def test_passages(spark, make_docs, window):
    rng = random.Random(window)
    shared = [prose(rng, window + k) for k in (-1, 0, 1, 40)]
    docs = []
    for i in range(80):
        text = prose(rng, rng.randrange(60), 6 if window == 4 else 400)
        for part in rng.sample(shared, rng.randrange(3)):
            text[rng.randrange(len(text) + 1) : 0] = part
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(text)))
    docs += [(100, docs[3][1]), (101, docs[3][1])]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substrings.repeated_passages(make_docs(docs), window=window, chunk_bytes=2000).collect()}
    want = dict(zip([i for i, _ in docs], brute.passages([t for _, t in docs], window)))
    assert got == want


def test_spans_and_covers(spark, make_docs):
    for period, cover in substrings.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    text = " ".join(f"a{i}" for i in range(40))
    rows = substrings.repeated_passages(make_docs([(1, f"x {text} y"), (2, f"{text} z z")])).collect()
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in rows}
    assert spans == {1: [(1, 41)], 2: [(0, 40)]}


@pytest.mark.parametrize("max_broadcast", [200_000, 0])
def test_benchmark_words(spark, make_docs, max_broadcast):
    rng = random.Random(5)
    items = [(i, " ".join(prose(rng, n, 60))) for i, n in enumerate([1, 2, 3, 4, 5, 8, 9, 10, 11, 30, 0])] + [(50, None), (60, "Über ÉTÉ x, y-z")]
    docs = []
    for i in range(60):
        text = prose(rng, rng.randrange(40), 60)
        w = (items[rng.randrange(10)][1]).split()
        a = rng.randrange(len(w))
        text[rng.randrange(len(text) + 1) : 0] = w[a : a + rng.randrange(1, 20)]
        docs.append((i, " ".join(text).upper() if i % 3 else ", ".join(text)))
    docs += [(100, "über été X Y Z"), (101, "Über été X y z"), (102, "an Über ÉTÉ X. Y z!")]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(make_docs(docs), table, max_broadcast=max_broadcast, max_hits=max_broadcast).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in rows}
    assert got == {i: brute.hits(t, items, 10) for i, t in docs}


def near_lines(rng):
    base = [prose(rng, rng.randrange(3, 14), 30) for _ in range(12)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(6)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                kind = rng.randrange(3)
                w[k : k + (kind != 0)] = [] if kind == 1 and len(w) > 1 else [f"n{rng.randrange(4)}"]
            text.append(rng.choice([" ", "  ", "\t"]).join(w) + rng.choice(["", " ", "\r"]))
            if rng.random() < 0.2:
                text.append(rng.choice(["", "  ", "\t"]))
        docs.append((i * 7 % 61, "\n".join(text)))
    return [*docs, (200, None), (201, "")]


@pytest.mark.parametrize("seed", range(3))
def test_lines(spark, make_docs, seed, monkeypatch):
    if seed == 1:
        monkeypatch.setattr(lines, "BROADCAST_LINES", -1)
    docs = near_lines(random.Random(seed))
    rows = lines.duplicate_lines(make_docs(docs), min_words=5).collect()
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.clean_text) for r in rows}
    assert got == brute.clean_lines(docs, 5)


def near_texts(rng):
    docs = []
    for _ in range(4):
        base = prose(rng, 120, 3000)
        for _ in range(30):
            w = list(base)
            for _ in range(rng.randrange(12)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(9000)}"
            docs.append(" ".join(w))
    docs += docs[:20] + [" ".join(prose(rng, 50)) for _ in range(20)] + ["a b", "a b", "A B", "a b c", None, ""]
    order = list(range(len(docs)))
    rng.shuffle(order)
    return list(zip(order, docs))


@pytest.mark.parametrize("block", [3, 1024])
def test_near_duplicates(spark, make_docs, block):
    docs = near_texts(random.Random(2))
    rows = minhash.near_duplicates(make_docs(docs), block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.groups(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_posterior_bounds():
    assert minhash.least_matches(25, 85, 1e-6) <= minhash.least_matches(25, 85, 1e-3) < 25
    assert minhash.least_matches(125, 85, 1e-6) > 75


def test_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (300, 300), (400, None)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 201: 200, 300: 300, 400: 400}


def test_lines_are_split_once(spark):
    near = spark.createDataFrame([(1, 2, 1, "a b c")], "__a long, __b long, __mask int, __s string")
    words = lines._words(near)
    assert [(r["__w"], r["__p"], r["__word"]) for r in words.collect()] == [(3, 0, "a"), (3, 1, "b"), (3, 2, "c")]
    above = words._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "split(" not in above
