"""Collocations, decontamination and periodic runs against plain Python, and on odd documents."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from finmart.llm import collocations as col, decontamination as dec
from finmart.llm.collocations import collocations, multikey_counts, phrase_counts
from finmart.llm.decontamination import contamination, contamination_report
from finmart.llm.periodic_runs import Extensions, collapse, find_runs, periodic_runs, repeated_tail, run_report, strongest

# periodic runs


def plain_runs(words):
    found = {}
    for p in range(1, len(words) // 3 + 1):
        start = 0
        while start + p < len(words):
            end = start
            while end + p < len(words) and words[end] == words[end + p]:
                end += 1
            if end - start + p >= max(24, 3 * p):
                found.setdefault((start, end - start + p), p)
            start = end + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def planted(seed):
    draw = random.Random(seed)
    n, kinds = draw.choice([0, 5, 23, 24, 60, 200, 500]), draw.choice([1, 2, 3, 12, 60])
    words = [draw.randrange(kinds) for _ in range(n)]
    for _ in range(draw.randint(0, 3) if n > 30 else 0):
        p, a = draw.randint(1, n // 4), draw.randrange(n)
        for i in range(a, draw.randrange(a, n)):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_many_texts_equal_plain_search(seed):
    texts = [planted(seed * 10 + k) for k in range(6)]
    found = find_runs([np.array(t, dtype=np.int64) for t in texts])
    assert [[tuple(r) for r in runs.tolist()] for runs in found] == [plain_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(words=st.lists(st.integers(0, 2), min_size=2, max_size=90), seed=st.integers(0, 99))
def test_extensions(words, seed):
    draw = random.Random(seed)
    pairs = [(a, b) for a, b in ((draw.randrange(len(words)), draw.randrange(len(words))) for _ in range(30)) if a != b]
    found = Extensions(np.array(words, dtype=np.int64))(*(np.array(x, dtype=np.int64) for x in zip(*pairs))) if pairs else []
    for (a, b), n in zip(pairs, found):
        assert words[a:a + n] == words[b:b + n]
        assert a + n == len(words) or b + n == len(words) or words[a + n] != words[b + n]


def test_ties_and_collapse():
    runs = np.array([[0, 24, 8], [10, 30, 10], [50, 48, 16], [60, 24, 8]])
    assert strongest(runs) == (0, 24, 8) and strongest(runs[:0]) is None
    assert collapse([b"%d" % i for i in range(30)], np.array([[2, 24, 3]])) == [b"0", b"1", b"2", b"3", b"4", *(b"%d" % i for i in range(26, 30))]


def test_run_report_equals_plain_search(spark):
    rows = [(k, " ".join(f"w{x}" for x in planted(k))) for k in range(80)] + [(None, "a " * 30), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    begin, part = repeated_tail(F.col("doc_id"))
    found = run_report(periodic_runs(docs.repartition(3), repeat_from=begin, repeat_part=part)).collect()
    want = {}
    for key, text in rows:
        words = (text or "").split()
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = strongest(np.array(runs).reshape(-1, 3))
        dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        want[key] = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
                     digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert {r[0]: tuple(r[1:]) for r in found} == want
    assert sum(bool(w[0]) for w in want.values()) > 10


# decontamination


def plain_words(text):
    out, word = [], []
    for ch in (text or "") + " ":
        ch = ch.lower() if "A" <= ch <= "Z" else ch
        if ch.isascii() and not ch.isdigit() and not "a" <= ch <= "z":
            if word:
                out.append("".join(word))
            word = []
        else:
            word.append(ch)
    return out


def plain_contamination(docs, items):
    windows = defaultdict(set)
    for key, text in items:
        words = plain_words(text)
        for i in range(max(len(words) - 9, 1) if words and key is not None else 0):
            windows[tuple(words[i:i + 10])].add(str(key))
    out = []
    for key, text in docs:
        words, hit, met = plain_words(text), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if (found := windows.get(tuple(words[i:i + k]))) is not None:
                    hit.update(range(i, i + k))
                    met |= found
        out.append((key, len(words), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("hot_share", [dec.HOT_SHARE, 1 << 40])
def test_contamination_equals_plain_search(spark, monkeypatch, hot_share):
    monkeypatch.setattr(dec, "HOT_SHARE", hot_share)  # the second: every key is salted
    draw = random.Random(3)
    vocabulary = [f"{x}{y}" for x in "abcdé" for y in "xyz1"]
    write = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(write(draw.randint(8, 40)))) for k in range(20)]
    items += [(3, "two. Rows, of ONE item"), (20, items[0][1]), (21, "éclair"), (22, ""), (23, None), (None, items[1][1]), (100, " ".join(write(10)))]
    docs = []
    for k in range(120):
        words = write(draw.randint(0, 60))
        for _ in range(draw.randint(0, 3)):
            source = draw.choice(items)[1] or ""
            cut = source.split()
            a, n = draw.randrange(len(cut) + 1), draw.choice([4, 9, 10, 11, 40])
            at = draw.randrange(len(words) + 1)
            words[at:at] = cut[a:a + n]
        docs.append((k, draw.choice([" ", " - ", "\n"]).join(words).replace("a", "A")))
    docs += [(5, docs[5][1]), (None, items[2][1]), (200, None), (201, ""), (202, "..."), (203, "ECLAIR éclair"), (204, "two rows of one item")]
    found = contamination_report(contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")))
    want = plain_contamination(docs, items)
    assert Counter(map(tuple, found.collect())) == Counter(want)
    assert 30 < sum(w[5] for w in want) < len(want)


# collocations


def plain_collocations(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else "\n" if c in ".,;:!?\n\x0b\x0c\r" else c for c in text or "")
        for piece in lower.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, found in counts.items():
        kept = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        covered = {p[s:e] for p, a in kept.items() for s in range(len(p)) for e in range(s + 2, len(p) + 1)
                   if e - s < len(p) and found[p[s:e]] == a}
        scored = []
        for p, a in kept.items():
            if p not in covered:
                score, k = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def talk(seed, n=400):
    draw = random.Random(seed)
    words = ["the", "of", "of", "the", "A", "b", "é", "漢", *(f"rare{k}" for k in range(40))]
    fixed = ["in the case of", "new  york\tcity hall now", "of the", "a a a a a a a"]
    return [(draw.choice(["en", "de", None, "ü"]),
             "".join(draw.choice([*words, *fixed]) + draw.choice([" ", " ", " ", ", ", "\n", "  ", ".\t"]) for _ in range(draw.randint(0, 40))))
            for _ in range(n)]


@pytest.mark.parametrize("route_share", [col.ROUTE_SHARE, 1 << 40])
def test_collocations_equal_plain_counts(spark, monkeypatch, route_share):
    monkeypatch.setattr(col, "ROUTE_SHARE", route_share)  # the second: every suffix is routed by all its words
    monkeypatch.setattr(col, "TOP", 7)
    rows = talk(1) + [("en", None), (None, ""), ("en", "of the " * 3000)]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("n", F.lit(1))
    found = sorted(map(tuple, collocations(docs.repartition(4)).collect()))
    assert found == plain_collocations(rows, 100, 7) and len(found) > 10


@pytest.mark.parametrize("numbered", [1, 7])
def test_collocations_spell_words_without_a_number(spark, monkeypatch, numbered):
    monkeypatch.setattr(col, "NUMBERED", numbered)
    monkeypatch.setattr(col, "TOP", 7)
    rows = talk(3)
    found = sorted(map(tuple, collocations(spark.createDataFrame(rows, "lang string, text string").repartition(3)).collect()))
    assert found == plain_collocations(rows, 100, 7) and len(found) > 10


def test_suffixes_grow_with_the_words(spark, monkeypatch):
    """Five times the words make five times the suffixes, though pairs become frequent in between."""
    made, plain = [], col._routes
    monkeypatch.setattr(col, "_routes", lambda s: made.append(s.agg(F.sum("n")).first()[0] or 0) or plain(s))
    draw = random.Random(4)
    for n in (20_000, 100_000):
        rows = [("en", " ".join(f"w{draw.randrange(30)}" for _ in range(1000))) for _ in range(n // 1000)]
        phrase_counts(spark.createDataFrame(rows, "lang string, text string"))
    assert 0 < made[0] and made[1] <= 5.5 * made[0]


def test_counts_of_every_length(spark):
    rows = talk(2, 1500)
    _, phrases = phrase_counts(spark.createDataFrame(rows, "lang string, text string"))
    assert {5, 2} <= {len(bytes(r.phrase).split(b" ")) for r in phrases.collect()}


@settings(max_examples=60, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(-1, 3), st.integers(-1, 3), st.integers(-1, 3), st.integers(1, 5)), min_size=1, max_size=60),
       floor=st.integers(1, 9))
def test_multikey_counts(rows, floor):
    cut = [(list(r[:3]) + [-1, -1, -1])[:3] for r in rows]
    cut = [r[:r.index(-1)] + [-1] * (3 - r.index(-1)) if -1 in r else r for r in cut]
    want = Counter()
    for r, (*_, weight) in zip(cut, rows):
        for k in range(1, 4):
            if -1 not in r[:k]:
                want[tuple(r[:k])] += weight
    keys = np.array(cut, dtype=np.int64)
    row, length, weight = multikey_counts(keys, np.array([r[3] for r in rows], dtype=np.int64), [floor] * 3)
    found = [(tuple(keys[r][:k]), w) for r, k, w in zip(row.tolist(), length.tolist(), weight.tolist())]
    assert sorted(found) == sorted((p, w) for p, w in want.items() if w >= floor)


# odd input


def test_odd_documents(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "the lazy dog near the old river bank today"), (None, "x"), (2, None)], "item_id long, text string")
    marked = contamination_report(contamination(odd_documents, items)).collect()
    assert len(marked) == 11 and {r.doc_id for r in marked if r.contaminated} == {1, 2}
    assert {(r.n_words, r.n_hit) for r in marked if r.doc_id in (3, 4, 5)} == {(0, 0)}
    runs = run_report(periodic_runs(odd_documents)).collect()
    assert sorted((r.doc_id, r.n_runs, r.period) for r in runs if r.n_runs) == [(7, 1, 1), (7, 1, 1)]
    assert all(r.runs_sha256 and r.collapsed_sha256 for r in runs)
    found = collocations(odd_documents).collect()
    assert [(r.lang, r.phrase, r.a) for r in found] == [("fr", "word word word word word", 2 * (40_000 - 4))] or found[0].lang == "fr"
    nothing = spark.createDataFrame([], "item_id long, text string")
    for empty in (contamination(no_documents, items), periodic_runs(no_documents), collocations(no_documents)):
        assert empty.collect() == []
    assert {r.n_hit for r in contamination(odd_documents, nothing).collect()} == {0}
