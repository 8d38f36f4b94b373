import math
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from finmart.llm.mixing import mix_and_repeat, mix_sources
from finmart.llm.quality_rules import binomial_at_most, certified_levels, keep_good, quality_verdicts, text_counts, upper_bound

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #é\n\t\x0b漢|", max_size=120))
def test_counts_match_brute_force(text):
    expected = counted(text)
    assert text_counts(text)[:5] == (expected if expected[0] else (0,) * 5)


def test_upper_bound_is_exact():
    assert upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01)
    p = upper_bound(3, 50, 0.02)
    assert sum(math.comb(50, i) * p**i * (1 - p) ** (50 - i) for i in range(4)) == pytest.approx(0.02)
    assert upper_bound(5, 5, 0.1) == 1.0
    for k, n, p in ((0, 7, 0.3), (4, 9, 0.5), (30, 400, 0.1), (399, 400, 0.99)):
        whole = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert binomial_at_most(k, n, p) == pytest.approx(whole, rel=1e-9)
    assert 0.01 < upper_bound(10_000_000, 10**9, 0.01) < 0.01001


def test_levels_stop_at_the_first_that_fails():
    assert certified_levels([(0, 1000), (1, 1000), (20, 1000), (0, 1000)], 0.01, 0.05) == 2
    assert certified_levels([(0, 10)], 0.01, 0.05) == 0 and certified_levels([(0, 0)], 0.01, 0.05) == 0


def test_certified_cutoffs_reject_bad_and_spare_good(spark):
    good = [(i, " ".join(f"w{(i * 31 + k * 7) % 997}" for k in range(40)), "en") for i in range(4000)]
    bad = [(10_000 + i, " ".join(f"##w{(i * 31 + k * 7) % 997}$" for k in range(40)), "en") for i in range(400)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d[0], int(d[0] < 10_000)) for d in good + bad], "doc_id long, quality int")
    found = {r.doc_id: r.kept for r in quality_verdicts(docs, labels).collect()}
    assert sum(not found[d[0]] for d in good) <= 40 and not any(found[d[0]] for d in bad)
    assert keep_good(docs, labels).count() == sum(found.values())


def test_odd_documents(odd_documents, no_documents, some_labels):
    found = quality_verdicts(odd_documents, some_labels).collect()
    assert len(found) == 11 and not any(r.kept for r in found if not r.n_words)
    assert {(r.n_words, r.word_chars, r.base_failed) for r in found if r.doc_id in (3, 4, 5)} == {(0, 0, True)}
    assert all(r.n_repeat_words > 30_000 and r.base_failed for r in found if r.doc_id == 7)
    assert quality_verdicts(no_documents, some_labels).collect() == []
    assert keep_good(odd_documents, some_labels).columns == odd_documents.columns


def test_judging_shuffles_no_text(odd_documents, some_labels):
    assert "Exchange hashpartitioning" not in keep_good(odd_documents, some_labels)._jdf.queryExecution().toString()


def targets_of(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    pot, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = pot / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = 2 * sizes[s]
            pot -= out[s]
            open_.discard(s)
    return out


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i * 37 % 90), ["a", "b", "Z", "é", "\U0001f600", None][i % 6 if i % 3 else 0], i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    first, again = (sorted((r.doc_id, r.taken) for r in mix_sources(d).collect()) for d in (docs, docs.repartition(7)))
    assert first == again
    found = mix_sources(docs).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    expected = targets_of(sizes)
    for r in found:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 90 / 2


def test_rates_are_exponential_in_size(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), "ab"[i % 7 == 0], 0) for i in range(4000)],
                                 "doc_id long, text string, source string, n long")
    for source in "ab":
        rates = {r["size"]: r.rate for r in mix_sources(docs).where(f"source = '{source}'").collect() if r.rate < 2}
        steps = {round(math.log(rates[z]) / z, 9) for z in rates}
        assert len(steps) <= 1


def test_odd_mix(odd_documents, no_documents):
    found = mix_sources(odd_documents).collect()
    assert len(found) == 11 and all(r.taken <= 2 * r["size"] for r in found)
    assert all(r["size"] == 0 and r.copies == 1 for r in found if r.doc_id in (3, 4, 5))
    repeated = mix_and_repeat(odd_documents)
    assert repeated.columns == odd_documents.columns and repeated.count() == sum(r.copies for r in found)
    assert mix_sources(no_documents).collect() == [] and mix_and_repeat(no_documents).collect() == []


def test_mixing_plan_has_no_python(spark):
    plan = mix_sources(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
