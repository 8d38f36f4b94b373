import math
import pickle
import tracemalloc

import numpy as np
import pytest

from finmart.llm import license_templates, masked_lm, toxicity
from finmart.llm.language_id import ByteTagger, Layer, cut, language_predictions
from finmart.llm.license_scan import LicenceScanner, Template, bigrams, licence_matches, licence_report, make_templates, normal_words
from finmart.llm.license_templates import TEMPLATES
from finmart.llm.masked_lm import WindowNetwork, pseudo_likelihoods
from finmart.llm.tables import Scratch
from finmart.llm.toxicity import FactorizationMachine, Terms, drop_toxic, toxicity_scores, train

SMALL = "/root/testdata/sf0.01"


def test_factorization_machine_learns_a_pair():
    random = np.random.default_rng(0)
    documents, labels = [], []
    for i in range(3000):
        a, b = random.random() < 0.5, random.random() < 0.5
        documents.append(np.array(sorted({0, *([11] if a else []), *([22] if b else []), *random.integers(100, 100_000, 12)})))
        labels.append(float(a and b))
    machine = FactorizationMachine()
    machine.fit(documents, np.array(labels, dtype=np.float32))
    p = [machine.probability(np.array(s)) for s in ([0], [0, 11], [0, 22], [0, 11, 22])]
    assert max(p[:3]) < 0.3 < p[3]


def test_training_scores_few_slots_at_once(monkeypatch):
    random = np.random.default_rng(5)
    documents = [np.unique(np.append(random.integers(1, 5000, 60), 0)) for _ in range(300)]
    labels = (random.random(300) < 0.2).astype(np.float32)
    monkeypatch.setattr(toxicity, "SCORE_SLOTS", 500, raising=False)
    met, plain = [], FactorizationMachine.raw_scores

    def raw_scores(self, slots, starts):
        met.append((len(slots), len(starts)))
        return plain(self, slots, starts)

    monkeypatch.setattr(FactorizationMachine, "raw_scores", raw_scores)
    FactorizationMachine().fit(documents, labels)
    assert max(n for n, _ in met) < sum(map(len, documents)) / 2


def test_pair_term_equals_the_double_sum():
    machine, random = FactorizationMachine(), np.random.default_rng(1)
    machine.w[:9], machine.v[:9], machine.bias = random.normal(size=9), random.normal(size=(9, machine.v.shape[1])), 0.3
    pairs = sum(float(machine.v[i] @ machine.v[j]) for i in range(9) for j in range(i))
    z, _ = machine.raw_scores(np.arange(9), np.zeros(1, dtype=np.int64))
    assert z[0] == pytest.approx(0.3 + machine.w[:9].sum() + pairs, rel=1e-4)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    clean = [r.predicted for r in rows if r.toxic == 0]
    toxic = [r.predicted for r in rows if r.toxic == 1]
    assert sum(clean) <= 0.03 * len(clean) and sum(toxic) >= 0.4 * len(toxic)
    assert drop_toxic(docs, labels).columns == docs.columns


def test_toxicity_is_fitted_in_a_task(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    monkeypatch.setattr(FactorizationMachine, "fit", None)  # that of the driver; workers load their own
    machine = train(docs, labels)
    sent = pickle.dumps(machine)
    again = pickle.loads(sent)
    assert machine.w.any() and len(sent) < machine.v.nbytes / 10
    assert again.bias == machine.bias and np.array_equal(again.w, machine.w) and np.array_equal(again.v, machine.v)


def test_toxicity_of_odd_documents(odd_documents, no_documents, some_labels):
    found = toxicity_scores(odd_documents, some_labels).collect()
    assert len(found) == 11 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    nothing = toxicity_scores(odd_documents, some_labels.where("false")).collect()
    assert {r.score for r in nothing} == {0.5}
    assert toxicity_scores(no_documents, some_labels).collect() == []
    assert Terms().slots(None).tolist() == [0] == Terms().slots(b"").tolist()


def test_recurrent_gradients_match_differences():
    random = np.random.default_rng(3)
    layer, steps = Layer(random), random.integers(0, 256, (5, 3))
    pull = random.normal(size=(5, 3, layer.u.shape[0])).astype(np.float32)

    def value():
        return float((layer.run(steps).transpose(0, 2, 1) * pull).sum())

    rows, u = layer.gradients(steps, layer.run(steps).transpose(0, 2, 1), pull)
    for weights, grad in ((layer.u, u), (layer.rows, rows)):
        for at in zip(*np.unravel_index(np.argsort(-np.abs(grad), axis=None)[:8], grad.shape)):
            kept, step = weights[at], 1e-2
            weights[at] = kept + step
            high = value()
            weights[at] = kept - step
            low = value()
            weights[at] = kept
            assert (high - low) / (2 * step) == pytest.approx(grad[at], rel=0.05, abs=2e-3)


def test_every_byte_is_pooled():
    tagger = ByteTagger(["a", "b"])
    text = bytes(range(97, 123)) * 20
    found, _, _ = tagger.label(cut(text))
    mean = sum(found[i % 64, :, i // 64] for i in range(len(text))) / len(text)
    assert np.allclose(tagger.pool([b"zz", text])[1], mean, atol=1e-5)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = language_predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_language_of_odd_documents(odd_documents, no_documents):
    found = language_predictions(odd_documents).collect()
    assert len(found) == 11
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in found if r.doc_id in (3, 4, 5))
    assert language_predictions(no_documents).collect() == []
    assert {r.lang_pred for r in language_predictions(odd_documents.selectExpr("doc_id", "text", "string(null) lang")).collect()} == {"und"}


def test_window_network_is_a_distribution_and_learns():
    network, random = WindowNetwork(), np.random.default_rng(2)
    context = np.tile(random.integers(0, 50, 4), (masked_lm.SLOTS - 1, 1))
    assert np.exp(network.log_probabilities(context, np.arange(masked_lm.SLOTS - 1))).sum() == pytest.approx(1, rel=1e-3)
    memory = [np.full_like(w, 1.0) for w in network.weights]
    left = random.integers(0, 20, 4000)
    context, target = np.stack([left, left, left, left], axis=1), left + 100
    for _ in range(60):
        network.learn(context, target, memory)
    assert network.log_probabilities(context, target).mean() > -0.7


def test_pseudo_likelihood_beats_word_frequencies(spark):
    rows = [(i, " ".join(f"{'abc'[(i + k) % 3]}" for k in range(400))) for i in range(600)]
    found = pseudo_likelihoods(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()
    assert sum(r.log_likelihood for r in found) / sum(r.n_words for r in found) > -0.9 * math.log(3)


def test_every_round_visits_only_its_places(monkeypatch):
    monkeypatch.setattr(masked_lm, "STRETCH", 64)  # so that texts are met in several stretches
    random = np.random.default_rng(2)
    sizes, rounds = random.integers(0, 90, 30), 8
    texts = masked_lm.Texts(np.zeros(sizes.sum(), np.uint16), np.concatenate(([0], np.cumsum(sizes))))
    hashes, met = random.integers(0, 1 << 32, 30), []
    for turn in range(rounds):
        wanted = [(b + i, t) for t, (b, n) in enumerate(zip(texts.begins, sizes)) for i in range(n) if (i - hashes[t] - turn) % rounds == 0]
        found = [x for places, owner in texts.every(rounds, (hashes + turn) % rounds) for x in zip(places.tolist(), owner.tolist())]
        assert found == wanted
        met += [place for place, _ in found]
    assert sorted(met) == list(range(sizes.sum()))


def test_rounds_leave_no_shuffles(spark, tmp_path):
    texts = [[1, 2, 3, 1, 2, 3], [2, 3, 1]]
    encoded = spark.createDataFrame([(0, i, np.array(t, np.uint16).tobytes()) for i, t in enumerate(texts)], "shard int, hash long, slots binary")
    tracked = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = tracked.size()
    masked_lm.train(encoded, masked_lm.SLOTS, 4, Scratch(spark, "rounds"))
    assert tracked.size() <= before


def test_pseudo_likelihood_of_odd_documents(odd_documents, no_documents):
    found = pseudo_likelihoods(odd_documents).collect()
    assert len(found) == 11
    assert all((r.n_words, r.log_likelihood, r.mean_log_likelihood) == (0, 0, None) for r in found if r.doc_id in (3, 4, 5))
    assert all(r.n_words == 40_001 and r.log_likelihood < 0 for r in found if r.doc_id == 7)
    assert pseudo_likelihoods(no_documents).collect() == []


def brute_dice(text, templates, least):
    pairs = bigrams(normal_words(text))
    dice = [(-2 * len(pairs & t.bigrams) / (len(pairs) + t.size), t.licence) for t in templates]
    best = min((d for d in dice if -d[0] >= least), default=None)
    return best and (best[1], -best[0])


def test_bounds_lose_no_template():
    random, templates = np.random.default_rng(4), make_templates()
    for least in (0.5, 0.9):
        scanner = LicenceScanner(templates, least)
        for text in TEMPLATES.values():
            words = text.split()
            for _ in range(20):
                cut_words = [w for w in words if random.random() < 0.95][: int(random.integers(5, len(words)))]
                line = " ".join(cut_words)
                if len(bigrams(normal_words(line))) >= 4:
                    assert scanner.best(normal_words(line)) == brute_dice(line, templates, least)


def test_spans_of_lines_and_paragraphs():
    notice, prose = TEMPLATES["Apache-2.0"].strip(), " ".join(f"word{i}" for i in range(200))
    scanner = LicenceScanner(make_templates())
    found = scanner.scan(f"intro\n\n{notice}\n\n{prose}\nReleased under the MIT license\n".encode())
    assert [m for m in found if m[1] == 1.0][0] == ("Apache-2.0", 1.0, 2, 2)
    assert ("MIT", 1.0) in [m[:2] for m in found] and LicenceScanner([]).scan(b"x") == []
    # a notice inside a whole text that matches another licence
    found = scanner.scan(f"{notice}\nReleased under the MIT license".encode())
    assert [m[0] for m in found] == ["Apache-2.0", "MIT"] and found[0][2:] == (0, notice.count("\n") + 2)


def test_licences_of_odd_documents(odd_documents, no_documents):
    found = licence_report(licence_matches(odd_documents)).collect()
    assert len(found) == 11 and all((r.n_matches, r.licence, r.licences) == (0, None, []) for r in found)
    assert licence_matches(no_documents).collect() == []
    one = Template(4, "own", frozenset(bigrams(normal_words("a b c d e"))))
    assert LicenceScanner([one]).scan(b"A, b. C d E")[0][:2] == ("own", 1.0)


def test_a_slot_is_divided_among_its_words_by_counts(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "VOCABULARY", 10)
    monkeypatch.setattr(masked_lm, "SHARED_SLOTS", 1)
    monkeypatch.setattr(masked_lm, "WORDS_GROW", 0.5)
    monkeypatch.setattr(masked_lm, "LISTED", 15)
    common = " ".join(f"c{i % 20}" for i in range(400))
    texts = [common] * 20 + [f"{common} rare"] * 30 + [f"{common} once{i}" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = masked_lm.word_counts(docs.selectExpr("cast(text as binary) text"))
    vocabulary = masked_lm.frequent_words(counts)
    assert vocabulary.known == len(vocabulary.words) == 13 and vocabulary.shared == 2
    shares = {bytes(r.word).decode(): r.log_share for r in masked_lm.word_shares(counts, vocabulary).collect()}
    assert len(vocabulary.listed) == 15 and not set(shares) & {w.decode() for w in vocabulary.words + vocabulary.listed}
    assert len(shares) == 20 + 1 + 600 - 13 - 15
    # one text ends in a word seen 30 times, another one in a word seen once
    found = {r.doc_id: r.log_likelihood for r in pseudo_likelihoods(docs).collect()}
    odd = [i for i in range(50, 650) if masked_lm.zlib.crc32(texts[i].split()[-1].encode()) % 2 == masked_lm.zlib.crc32(b"rare") % 2]
    assert found[20] - found[odd[0]] == pytest.approx(math.log(30), abs=0.05)


def test_scores_do_not_follow_the_split_of_the_input(spark):
    # texts of one language hold words that no other text has
    rows = [(i, " ".join(f"{'abc'[(i + k) % 3]}{i % 40}" for k in range(200))) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few, many = ({r.doc_id: r.mean_log_likelihood for r in pseudo_likelihoods(docs.repartition(n, "doc_id")).collect()} for n in (2, 200))
    assert max(abs(few[i] - many[i]) for i in few) < 0.05
    assert max(few.values()) < 0 and abs(sum(few.values()) - sum(many.values())) < 0.05 * len(few)


def test_rows_of_weights_are_averaged_by_their_touches():
    one, two = WindowNetwork(50).rows(), WindowNetwork(50).rows()
    one[0][0][3], two[0][0][3] = 5.0, 1.0
    one[0][1][3], two[0][1][3], two[0][1][4] = 6, 2, 9
    parts = [{"kind": 0, "first": 0, "n": n.tobytes(), "weights": w.tobytes()} for (w, n), *_ in (one, two)]
    batch = masked_lm.pa.RecordBatch.from_pylist(parts, schema=masked_lm._PART_SCHEMA)
    (found,) = [b.to_pylist()[0] for b in masked_lm._add(iter([batch]))]
    uses = np.frombuffer(found["n"], np.int64)
    sums = np.frombuffer(found["weights"], np.float64).reshape(len(uses), -1)
    assert uses[3:5].tolist() == [8, 9] and np.allclose(sums[3] / 8, 4) and np.allclose(sums[4] / 9, two[0][0][4])


def test_every_position_is_a_target_once(monkeypatch):
    seen = []
    monkeypatch.setattr(WindowNetwork, "learn", lambda self, context, target, memory: seen.extend(target.tolist()))
    texts, start = [np.arange(0, 1, dtype=np.int32), np.arange(1, 4, dtype=np.int32), np.arange(4, 300, dtype=np.int32)], WindowNetwork(400)
    batch = masked_lm.pa.RecordBatch.from_arrays(
        [masked_lm.pa.array([0, 0, 1], "int32"), masked_lm.pa.array([17, 5, 2**32 - 1], "int64"),
         masked_lm.pa.array([t.astype(masked_lm.slot_type(400)).tobytes() for t in texts], "binary")], names=["shard", "hash", "slots"])
    for turn in range(masked_lm.ROUNDS):
        list(masked_lm._train(400, [rows for rows, _ in start.rows()], turn, masked_lm.ROUNDS)(iter([batch])))
    assert sorted(seen) == list(range(300))


def test_siblings_keep_their_own_names():
    scanner = LicenceScanner(make_templates())
    for name, text in [*TEMPLATES.items(), *license_templates.BODIES.items()]:
        whole = [m for m in scanner.scan(text.strip().encode()) if m[2] == 0 and m[3] == text.strip().count("\n") + 1]
        assert [m[:2] for m in whole] == [(name, 1.0)], name
    for name, several in license_templates.NOTICES.items():
        for notice in several:
            assert [m[:2] for m in scanner.scan(notice.encode())] == [(name, 1.0)], notice
    # no template of version 1 or of a changed family: better none than a wrong one
    assert scanner.scan(b"This work is licensed under the GNU General Public License, version 1.") == []
    assert scanner.scan(TEMPLATES["GPL-3.0-or-later"].replace("version 3", "version 4").strip().encode())[0][3] < 9
    # a whole text without the terms of the nearest one known
    other = license_templates.BODIES["CC-BY-SA-4.0"].replace("ShareAlike", "")
    assert all(m[3] < 60 for m in scanner.scan(other.encode()))


def test_terms_that_are_neutral_alone_tell_as_a_pair():
    """An insult and a group, each as frequent in clean texts, make a text toxic only together."""
    random = np.random.default_rng(1)

    def sample(n):
        documents, toxic = [], np.zeros(n, dtype=np.float32)
        for k in range(n):
            terms = {0, *(100 + random.zipf(1.3, int(random.integers(20, 150))) % 5000).tolist()}
            kind, other = random.random(), random.random()
            toxic[k] = kind < 0.1
            if kind < 0.08:
                terms.add(int(20 + random.integers(0, 20)))
            elif kind < 0.1:
                terms |= {10, 11}
            else:
                terms |= {11} if other < 0.2 else {10} if other < 0.4 else set()
            documents.append(np.array(sorted(terms), dtype=np.int64))
        return documents, toxic

    documents, toxic = sample(4000)
    machine = toxicity.FactorizationMachine()
    machine.fit(documents, toxic)
    assert machine.w[10] == machine.w[11] == 0
    alone = [machine.probability(np.array([0, *terms])) for terms in ((), (10,), (11,))]
    assert max(alone) < 0.1 and machine.probability(np.array([0, 10, 11])) > 0.8
    documents, toxic = sample(1000)
    found = np.array([machine.probability(d) for d in documents]) >= toxicity.CUTOFF
    assert found[toxic > 0].mean() > 0.9 and found[toxic == 0].mean() < 0.01


def plain_step(network, context, target):
    """Weights after one AdaGrad step, by a softmax over all groups and one over the words of the group."""
    tables, bias, over_groups, over_words = (w.astype(np.float64) for w in network.weights)
    grads = [np.zeros_like(w) for w in (tables, bias, over_groups, over_words)]
    for slots, word in zip(context, target):
        h = np.append(np.tanh(sum(tables[j, slot] for j, slot in enumerate(slots)) + bias), 1)
        back = np.zeros(len(h))
        for weights, grad, at in ((over_groups, grads[2], word // network.group),
                                  (over_words[word // network.group], grads[3][word // network.group], word % network.group)):
            logits = h @ weights
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[at] -= 1
            grad += np.outer(h, error)
            back += weights @ error
        back = (back * (1 - h * h))[:-1]
        grads[1] += back
        for j, slot in enumerate(slots):
            grads[0][j, slot] += back
    return [w - masked_lm.RATE * g / np.sqrt(1 + g * g + 1e-6) for w, g in zip((tables, bias, over_groups, over_words), grads)]


@pytest.mark.parametrize("largest", [0.5, 200])
def test_a_step_of_the_network_equals_plain_gradients(largest):
    network, random = WindowNetwork(60), np.random.default_rng(4)
    for w in network.weights[1:]:
        w[np.abs(w) < 1e3] += random.normal(0, 0.3, w.shape)[np.abs(w) < 1e3]
    network.weights[2][-1, 1] = network.weights[3][0, -1, 2] = largest  # beyond 60 the rows are shifted before exp
    context, target = random.integers(0, 60, (1500, 4)), random.integers(0, 59, 1500)
    expected = plain_step(network, context, target)
    network.learn(context.astype(np.int32), target.astype(np.int32), [np.full_like(w, 1.0) for w in network.weights])
    for found, plain in zip(network.weights, expected):
        assert np.allclose(found, plain, atol=2e-4)


def test_a_step_holds_few_rows_of_logits():
    peaks, random = [], np.random.default_rng(5)
    for n in (masked_lm.BATCH // 16, masked_lm.BATCH):
        network = WindowNetwork(40_000)
        memory = [np.full_like(w, 1.0) for w in network.weights]
        context, target = random.integers(0, 40_000, (n, 4)).astype(np.int32), random.integers(0, 39_999, n).astype(np.int32)
        tracemalloc.start()
        network.learn(context, target, memory)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < masked_lm.BATCH * network.groups * 4  # one row of logits for each prediction


def test_words_of_odd_texts_split_in_any_parts(monkeypatch):
    texts = [None, b"", b" \t\n", b"  a b\x0b\x0ca\r", b"\xff\xfe a", "é x \x1c".encode(), b"b " * 40, b"a"]
    for size in (1, 50, 1 << 24):
        monkeypatch.setattr(masked_lm, "SPLIT", size)
        column = masked_lm.pa.array([b"left out", *texts], "binary").slice(1)
        found = list(masked_lm._split(column))
        assert [n for _, sizes, _ in found for n in sizes.tolist()] == [len((t or b"").split()) for t in texts]
        assert [w for _, _, words in found for w in words.to_pylist()] == [w for t in texts for w in (t or b"").split()]
        assert [i for part, *_ in found for i in range(*part.indices(len(texts)))] == list(range(len(texts)))
