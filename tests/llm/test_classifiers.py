import zlib

import numpy as np
import pyarrow as pa
import pytest

from ratingflow.llm import quality, queries, toxicity
from ratingflow.llm.common import text_bytes
from tests.llm.helpers import SF, frame, labels


def truth(spark, column):
    rows = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", column).collect()
    return {r[0]: r[1] for r in rows if r[1] is not None}


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_quality_on_held_out_documents(spark):
    rows = queries.op3_quality(spark, SF).collect()
    label = truth(spark, "quality")
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    own = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert len(own) > 80 and np.mean([p == y for p, y in own]) >= 0.97


def test_toxicity_on_held_out_documents(spark):
    rows = queries.op4_toxicity(spark, SF).collect()
    label = truth(spark, "toxic")
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    own = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    pos, neg = ([s for s, y in own if y == k] for k in (1, 0))
    # some 30 toxic documents to learn from: most pairs are in the right order
    assert np.mean([a > b for a in pos for b in neg]) >= 0.85


def slow_marginals(model, odds):
    """Every label sequence, weighed one by one."""
    n, total = len(odds), np.zeros((len(odds), 2))
    for code in range(2 ** n):
        y = [code >> i & 1 for i in range(n)]
        w = np.exp(sum(o * k for o, k in zip(odds, y)) + sum(model.pairs[a][b] for a, b in zip(y, y[1:])))
        for i, k in enumerate(y):
            total[i, k] += w
    return np.log(total[:, 1] / total[:, 0])


def test_forward_backward_equals_all_label_sequences():
    rng = np.random.default_rng(6)
    model = quality.Model(np.zeros(quality.WIDTH), 0.0, rng.normal(0, 1, (2, 2)), 1.0, 0.0)
    for n in (1, 2, 7):
        odds = rng.normal(0, 2, n).tolist()
        assert np.allclose(model.marginals(odds), slow_marginals(model, odds))


def field_loss(features, good, chains, weight, w):
    """Negative log-likelihood, every label sequence weighed one by one."""
    pairs = w[quality.WIDTH + 1:].reshape(2, 2)
    own = w[features].sum(axis=1) + w[quality.WIDTH]
    loss = 0.5e-3 * (w @ w)
    for c in set(chains.tolist()):
        at = np.flatnonzero(chains == c)

        def score(y):
            return sum(own[i] * k for i, k in zip(at, y)) + sum(pairs[a][b] for a, b in zip(y, y[1:]))
        every = [score([code >> i & 1 for i in range(len(at))]) for code in range(2 ** len(at))]
        loss += weight[at[0]] * (np.logaddexp.reduce(every) - score(good[at].astype(int).tolist()))
    return loss


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_random_field_gradient_is_that_of_the_likelihood(segment):
    """Numeric differences; chains of one to nine lines, longer than a segment."""
    rng = np.random.default_rng(9)
    chains = np.repeat(np.arange(8), [1, 9, 2, 7, 3, 1, 4, 6])
    bins = rng.integers(0, quality.OWN, (len(chains), len(quality.BINS)))
    features = quality.with_neighbours(chains, bins)
    good = rng.integers(0, 2, len(chains)).astype(float)
    weight = rng.random(8)[chains]
    w = rng.normal(0, 0.5, quality.WIDTH + 5)
    got = quality.field_gradient(features, good, chains, weight, segment)(w)
    some = [*rng.choice(features.ravel(), 12).tolist(), *range(quality.WIDTH, quality.WIDTH + 5)]
    for i in some:
        step = np.zeros_like(w)
        step[i] = 1e-5
        want = (field_loss(features, good, chains, weight, w + step) - field_loss(features, good, chains, weight, w - step)) / 2e-5
        assert abs(got[i] - want) < 1e-6


def test_random_field_learns_from_neighbours():
    """The fitted field predicts planted labels that depend on the neighbour."""
    rng = np.random.default_rng(7)
    lines = 600
    text = np.repeat(np.arange(lines // 6), 6)
    good = (rng.random(lines // 6) < 0.5)[text].astype(float)      # whole chains are good or bad
    own = np.where(rng.random(lines) < 0.35, 1 - good, good).astype(int)   # a noisy feature
    bins = np.zeros((lines, len(quality.BINS)), np.int64)
    bins[:, 0] = own
    features = quality.with_neighbours(text, bins)
    w, pairs = quality.fit_field(features, good, text, np.ones(lines))
    assert pairs[1, 1] + pairs[0, 0] > pairs[0, 1] + pairs[1, 0] + 1
    model = quality.Model(w[:-1], float(w[-1]), pairs, 1.0, 0.0)
    odds = quality.features_odds(model, features)
    found = np.concatenate([model.marginals(odds[a:a + 6].tolist()) for a in range(0, lines, 6)])
    assert np.mean((found > 0) == good) > np.mean(own == good) + 0.1


def test_lines_and_their_features():
    texts = ["One line.\nTWO LINES!!\n", "", None, "x x x x", "a | b | c"]
    text, size, bins = quality.line_features(*text_bytes(pa.array(texts)))
    assert text.tolist() == [0, 0, 0, 1, 2, 3, 4] and size.tolist() == [9, 11, 0, 0, 0, 7, 9]
    column = {name: i for i, name in enumerate(quality.BINS)}
    value = lambda row, name: bins[row, column[name]] - quality._FIRST[column[name]]
    assert value(1, "upper") > value(0, "upper") and value(5, "again") > value(0, "again")
    assert value(6, "bar") > value(0, "bar") and value(0, "closed") == 1 and value(5, "closed") == 0


def some_docs(spark):
    good = [(i, f"This is line {i} of a calm text.\nIt has words enough.", "en") for i in range(0, 60)]
    bad = [(100 + i, f"BUY%%% NOW&&& {i} ###\nMORON MORON STUPIDEST", "en") for i in range(0, 60)]
    odd = [(200, None), (201, ""), (202, "\n\n\n"), (203, "stupidest words"), (None, "calm"), (204, "calm words " * 40_000),
           (205, "a"), (205, "b")]
    docs = frame(spark, good + bad + odd)
    marks = labels(spark, [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 1) for i in range(60)]
                   + [(3, 1, 0), (4, 0, 1), (999, 1, 1), (None, 0, 1), (200, None, None)])
    return docs, marks


@pytest.mark.parametrize("module,good_low", [(quality, False), (toxicity, True)])
def test_awkward_rows(spark, module, good_low):
    docs, marks = some_docs(spark)
    rows = module.classify(docs, marks).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    score = {r.doc_id: r.score for r in rows}
    good, bad = np.mean([score[i] for i in range(60)]), np.mean([score[100 + i] for i in range(60)])
    assert (good < 0.2 and bad > 0.8) if good_low else (good > 0.8 and bad < 0.2)
    assert score[200] == score[201]
    nothing = labels(spark, [])
    assert {round(r.score, 6) for r in module.classify(docs, nothing).collect()} == {0.5}
    assert module.classify(frame(spark, []), marks).collect() == []


def test_misspelt_words_share_their_vectors(spark):
    docs, marks = some_docs(spark)
    model = toxicity.fit(docs, marks)
    calm, odd = toxicity.averages(["calm words here", "stupidezt morron here"], model.weights)
    assert odd > calm


def test_accepted_keeps_rows_unchanged(spark):
    docs, marks = some_docs(spark)
    model = quality.fit(docs, marks)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(range(60)) <= set(ids) and not set(range(100, 160)) & set(ids)


def test_features_do_not_depend_on_the_block():
    texts = ["idiot idiot word", "", "x", "the END of é\u0301 it"]
    alone = [toxicity.features([t])[0] for t in texts]
    for (b, s), (c, u) in zip(toxicity.features(texts), alone):
        assert b.tolist() == c.tolist() and np.allclose(s, u)
    weights = np.random.default_rng(8).normal(size=toxicity.BUCKETS)
    want = [sum(weights[b] * s) for b, s in alone]
    assert np.allclose(toxicity.averages(texts, weights), want)


def test_embedding_gradients_are_those_of_the_loss():
    """Numeric differences of all three sets of weights."""
    rng = np.random.default_rng(10)
    bag, rows = rng.random((5, 7)), rng.normal(size=(7, 3))
    soft, bias = rng.normal(size=(3, 2)), rng.normal(size=2)
    label, cost, decay = np.array([0, 1, 1, 0, 1]), rng.random(5), 0.1

    def loss(rows, soft, bias):
        logit = bag @ rows @ soft + bias
        log_p = logit - np.logaddexp.reduce(logit, axis=1)[:, None]
        return -(cost * log_p[np.arange(5), label]).sum() + decay / 2 * ((rows ** 2).sum() + (soft ** 2).sum())
    values = [rows, soft, bias]
    for k, got in enumerate(toxicity.gradients(bag, rows, soft, bias, label, cost, decay)):
        for at in np.ndindex(values[k].shape):
            up, down = ([v.copy() for v in values] for _ in range(2))
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            assert abs(got[at] - (loss(*up) - loss(*down)) / 2e-6) < 1e-7
