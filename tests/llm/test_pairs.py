"""Joins of near duplicates, repeated passages and near vectors against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from corpus_rows import keyed, make_docs

from orelode.llm import itq
from orelode.llm.components import connected_components
from orelode.llm.debruijn import remove_repeated_passages
from orelode.llm.ngram_join import Similarity, block_keys, level, ngram_components, short_sketch


def groups(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (3, 100)])
def test_components_are_those_of_all_links(docs, width, percent):
    rows = [r for r in make_docs() if r[0] is not None]
    sets = {r[0]: shingle_set(r[1], width) for r in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    assert links
    expected = groups(sets, links)
    found = keyed(ngram_components(docs, width, percent).filter("doc_id is not null"))
    assert {k: (v["n_shingles"], v["component_id"]) for k, v in found.items()} == {
        k: (len(sets[k]), expected[k]) for k in sets
    }
    alone = ngram_components(docs, width, percent).filter("doc_id is null").collect()
    assert len(alone) == 2 and all(r.component_id is None for r in alone)


def test_no_documents_make_no_components(no_docs):
    assert ngram_components(no_docs).collect() == []


def test_rows_with_one_id_share_a_component(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    frame = spark.createDataFrame([(7, a), (7, b), (3, a), (9, b)], "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in ngram_components(frame).collect()}
    assert found == {(7, 3), (3, 3), (9, 3)}


def test_a_large_near_group_is_compared_in_chunks(spark, monkeypatch):
    from orelode.llm import ngram_join

    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    dice = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(60):
        words = list(base)
        for place in dice.sample(range(80), dice.randint(0, 5)):
            words[place] = f"x{dice.randint(0, 6)}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingle_set(t, 3) for t in texts]
    links = [
        (a, b) for a in range(60) for b in range(a)
        if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    expected = groups(range(60), links)
    found = keyed(ngram_components(frame))
    assert {k: v["component_id"] for k, v in found.items()} == expected


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_of_linked_sets_share_a_block_and_bound_the_difference(percent):
    dice = np.random.default_rng(5)
    near = Similarity(percent)
    for _ in range(300):
        size = int(dice.integers(5, 400))
        a = np.unique(dice.integers(0, 1 << 62, size).astype(np.uint64))
        drop = int(dice.integers(0, near.apart(2 * size) + 1))
        kept = dice.permutation(a)[: max(1, len(a) - drop // 2)]
        b = np.unique(np.append(kept, dice.integers(0, 1 << 62, drop - drop // 2).astype(np.uint64)))
        common = len(np.intersect1d(a, b))
        apart = len(a) + len(b) - 2 * common
        folded = level([short_sketch(a), short_sketch(b)])
        differ = int(np.bitwise_count(folded[0] ^ folded[1]).sum())
        assert differ <= apart
        if apart and near.links(common, len(a) + len(b) - common):
            assert apart <= near.apart(len(a) + len(b))
            keys = [
                {int(k) for band in near.bands(len(s)) for k in block_keys(s, *band)} for s in (a, b)
            ]
            assert keys[0] & keys[1]


def test_components_of_paths_and_stars(spark):
    dice = random.Random(4)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 50)]
    links += [(dice.randint(2000, 2300), dice.randint(2000, 2300)) for _ in range(150)]
    dice.shuffle(links)
    nodes = {n for a, b in links if a != b for n in (a, b)}
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == groups(nodes, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---------------------------------------------------------------- passages


def test_repeated_passages_go(docs):
    rows = sorted({r for r in make_docs() if r[0] is not None})
    first = {}
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), doc)
    expected = {}
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < doc:
                gone |= set(range(i, i + 13))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        expected[doc] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    assert sum(n > 0 for _, n, _ in expected.values()) > 20
    result = remove_repeated_passages(docs)
    assert result.count() == docs.count()
    found = keyed(result.filter("doc_id is not null"))
    assert {k: (v["n_words"], v["n_removed"], v["kept_sha256"]) for k, v in found.items()} == expected
    assert all(sum(s["stop"] - s["start"] for s in v["removed"]) == v["n_removed"] for v in found.values())
    assert all(r.n_removed == 0 for r in result.filter("doc_id is null").collect())


def test_no_documents_have_no_passages(no_docs):
    assert remove_repeated_passages(no_docs).collect() == []


# ---------------------------------------------------------------- vectors

VECTORS = "vec_id long, embedding array<float>, label int, node string"


def near_vectors_by_hand(rows, least=0.98):
    good = {}
    for key, vector, label, _ in rows:
        if key is None or label is None or not vector or len(vector) != 32:
            continue
        if any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        v = np.array(np.array(vector, np.float32), float)
        good[key] = (label, v / np.linalg.norm(v))
    links = [(a, b) for a in good for b in good if a < b and good[a][0] == good[b][0] and good[a][1] @ good[b][1] >= least]
    return links, groups([r[0] for r in rows if r[0] is not None], links)


def vector_rows():
    dice = np.random.default_rng(2)
    rows = []
    for i in range(400):
        if i % 4 == 0 or not rows:
            vector = dice.normal(size=32)
        else:
            vector = np.array(rows[int(dice.integers(0, len(rows)))][1]) + dice.normal(size=32) * dice.choice([0, 0.05, 0.3])
        rows.append((i, [float(np.float32(x)) for x in vector], int(dice.integers(0, 3)), "x"))
    rows += [(400, None, 1, "x"), (401, [0.0] * 32, 1, "x"), (402, [math.nan] + [1.0] * 31, 1, "x"),
             (403, [math.inf] + [1.0] * 31, 1, "x"), (404, [None] + [1.0] * 31, 1, "x"), (405, [], 1, "x"),
             (406, [1.0, 2.0], 1, "x"), (407, rows[0][1], None, "x"), (408, [1e-30 * x for x in rows[0][1]], rows[0][2], "x")]
    return rows


def test_near_vectors_are_found(spark):
    rows = vector_rows()
    links, expected = near_vectors_by_hand(rows)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    found = keyed(itq.near_vectors(spark.createDataFrame(rows, VECTORS).repartition(3)), "vec_id")
    assert len(found) == len(rows)
    assert all(v["n_links"] <= degree[k] for k, v in found.items())
    assert sum(v["n_links"] for v in found.values()) >= 0.95 * sum(degree.values())
    right = sum(v["component_id"] == expected[k] for k, v in found.items())
    assert right >= 0.97 * len(rows)
    assert all(v["kept"] == (k == v["component_id"]) for k, v in found.items())
    for key in range(400, 408):
        assert (found[key]["n_links"], found[key]["component_id"]) == (0, key)


def test_hot_buckets_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(itq, "CHUNK", 5)
    dice = np.random.default_rng(3)
    base = dice.normal(size=32)
    rows = [(i, [float(np.float32(x)) for x in base + 0.001 * dice.normal(size=32)], 1, "x") for i in range(40)]
    rows += [(100 + i, rows[0][1], 1, "x") for i in range(20)]
    found = keyed(itq.near_vectors(spark.createDataFrame(rows, VECTORS)), "vec_id")
    assert {v["n_links"] for v in found.values()} == {59}
    assert {v["component_id"] for v in found.values()} == {0}


def test_no_vectors(spark):
    assert itq.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    nothing = spark.createDataFrame([(1, None, 1, "x"), (None, [1.0], 1, "x")], VECTORS)
    found = itq.near_vectors(nothing).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in found) == [(0, 0, True), (1, 0, True)]


def test_vectors_link_within_each_length(spark):
    dice = np.random.default_rng(8)
    base = {width: dice.normal(size=width) for width in (2, 4, 40)}
    rows = []
    for width, count in ((4, 6), (2, 3), (40, 5)):
        for _ in range(count):
            rows.append((len(rows), [float(x) for x in base[width] + dice.normal(size=width) * 1e-4], 1))
    rows += [(len(rows) + i, [float(x) for x in base[2]], 1) for i in range(2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(frame).collect()}
    expected = {}
    for i, v, _ in rows:
        same = [j for j, w, _ in rows if len(w) == len(v)]
        expected[i] = (len(same) - 1, min(same))
    assert found == expected
