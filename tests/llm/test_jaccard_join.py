import random
from itertools import combinations

import numpy as np
import pytest

from finmart.llm import jaccard_join
from finmart.llm.jaccard_join import jaccard_components, keep_first_of_group, prefix_of, required_overlap, required_shared
from finmart.llm.shingles import set_fingerprint, shingle_hashes
from finmart.llm.tables import Scratch, components


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_copies(seed, groups=12, unrelated=30):
    """Groups edited to every degree, a shared passage, short texts of every size up to 12."""
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    texts, passage = [], " ".join(random.choices(words, k=60))
    for _ in range(groups):
        base = random.choices(words, k=random.choice([8, 20, 60, 200]))
        for _ in range(random.randint(2, 9)):
            copy = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 12))):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(" ".join(copy))
    texts += [" ".join(random.choices(words, k=50)) + " " + passage for _ in range(unrelated)]
    texts += [" ".join(words[:n]) for n in range(1, 13)] * 2
    random.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("boundary", [None, 2, 60])
def test_components_match_brute_force(spark, monkeypatch, boundary):
    if boundary is not None:
        monkeypatch.setattr(jaccard_join, "choose_boundary", lambda *_: boundary)
    rows = near_copies(boundary or 1)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_force(rows)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t)) for i, t in rows}


def test_frequent_shingles_change_no_result(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SAMPLE", 1)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    rows = near_copies(9)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_force(rows)


def test_linked_sets_share_enough_of_their_prefixes():
    random_ = np.random.default_rng(2)
    frequent = random_.integers(0, 255, jaccard_join.BITMAP_BITS >> 3, dtype=np.uint8)
    for _ in range(300):
        n = int(random_.integers(3, 60))
        a = np.unique(random_.integers(0, 1 << 63, n, dtype=np.uint64))
        keep = a[random_.random(len(a)) < 0.9]
        b = np.unique(np.concatenate((keep, random_.integers(0, 1 << 63, 3, dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        heads = [prefix_of(s, frequent, len(s) - required_overlap(len(s)) + int(required_shared(len(s))))[0] for s in (a, b)]
        assert len(np.intersect1d(*heads)) >= min(required_shared(len(a)), required_shared(len(b)))


def test_odd_documents(spark, odd_documents, no_documents):
    found = sorted(jaccard_components(odd_documents).collect(), key=str)
    assert {(r.doc_id, r.n_shingles > 0, r.component_id) for r in found} == {
        (1, True, 1), (2, True, 1), (3, False, 3), (4, False, 4), (5, False, 5), (6, True, 6), (9, True, 6),
        (None, True, None), (7, True, 7), (8, True, 8)}
    assert len(found) == 11
    assert jaccard_components(no_documents).collect() == []


def test_keep_first_of_group(odd_documents, no_documents):
    kept = keep_first_of_group(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "8", "None"]
    assert keep_first_of_group(no_documents).collect() == []


def test_words_split_at_ascii_white_space_only():
    assert len(shingle_hashes("a b c")) == 1 and set_fingerprint(shingle_hashes("A b")) == set_fingerprint(shingle_hashes("a\x0bB"))
    assert set_fingerprint(shingle_hashes("É b")) != set_fingerprint(shingle_hashes("é b"))


def test_long_texts_cross_power_blocks():
    words = [f"w{i}" for i in range(30_000)]
    whole, tail = shingle_hashes(" ".join(words)), shingle_hashes(" ".join(words[20_000:]))
    assert len(whole) == 29_996 and len(np.intersect1d(whole, tail)) == len(tail) == 9_996


def test_components_of_a_long_path(spark):
    order = list(range(60))
    random.Random(4).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components(edges, Scratch(spark, "test"), "path").collect()}
    assert found == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}
