"""The network: gradients, windows, and what it learns to tell apart."""

import random
import zlib

import numpy as np
import pytest

from salesmill.llm import toxicity as tox
from salesmill.llm.queries import op2_toxicity

from .conftest import SMALL, texts


def test_gradients_are_those_of_the_loss():
    s = tox.Settings(window=6, step=4, hidden=3, word_slots=64, run_slots=128, word_size=2, run_size=2)
    net = tox.Network(s)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    vectors, windows = r.standard_normal((4, 9)), r.integers(0, 9, (5, 6))
    windows[1, 3:], windows[2] = -1, -1
    targets, weights = np.array([1, 0, 1, 0, 1.0]), np.ones(5)

    def loss():
        logits = net.forward(vectors, windows)
        return np.logaddexp(0, np.where(targets > 0, -logits, logits)).sum()

    def slope(array, at, step=1e-5):
        kept = array[at]
        array[at] = kept + step
        up = loss()
        array[at] = kept - step
        down = loss()
        array[at] = kept
        return (up - down) / (2 * step)

    g, by_vector, _ = net.gradients(vectors, windows, targets, weights)
    for name, gradient in g.items():
        flat = net.p[name].reshape(-1)
        for at in r.integers(0, flat.size, 6):
            assert slope(flat, at) == pytest.approx(gradient.reshape(-1)[at], abs=1e-3)
    for at in [(0, 0), (1, 3), (3, 8), (2, 5)]:
        assert slope(vectors, at) == pytest.approx(by_vector[at[1], at[0]], abs=1e-3)


@pytest.mark.parametrize("n", [0, 1, 8, 31, 32, 33, 56, 57, 1000])
def test_windows_overlap_and_cover_every_word(n):
    s = tox.Settings()
    cut = tox.windows_of(np.arange(n, dtype=np.int32), s)
    assert set(cut[cut >= 0].tolist()) == set(range(n)) and len(cut) >= 1
    assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(cut, cut[1:]))
    assert len(cut) == 1 or (cut[-1] >= 0).sum() > s.window - s.step


def test_short_passages_lie_whole_in_a_window():
    s = tox.Settings()
    cut = [set(w.tolist()) for w in tox.windows_of(np.arange(1000, dtype=np.int32), s)]
    assert all(any(set(range(k, k + 17)) <= w for w in cut) for k in range(1000 - 17))


def made(n, seed):
    """Documents of invented words; toxic ones have some words of one stem among them."""
    r = random.Random(seed)
    word = lambda stem="": stem + "".join(r.choice(["ta", "ro", "mi", "sen", "lu"]) for _ in range(r.randrange(1, 4)))
    out = []
    for k in range(n):
        words = [word() for _ in range(r.randrange(5, 200))]
        toxic = int(k % 5 == 0)
        for _ in range(3 * toxic):
            words[r.randrange(len(words))] = word("grbzk")
        out.append((k, " ".join(words), toxic))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    rows = made(900, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id bigint, toxic int")
    s = tox.Settings(word_slots=1 << 12, run_slots=1 << 14, epochs=8)
    return rows, docs, tox.fit(docs, labels, s)


def test_held_out_documents_are_told_apart(fitted):
    rows, docs, net = fitted
    truth = {i: x for i, _, x in rows}
    held = [r for r in tox.score_toxicity(docs, net).collect() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.97 and all(0 <= r.score <= 1 for r in held)
    # A word never seen, of the known stem, deep in a long text.
    clean = max((t for _, t, x in rows if not x), key=len)
    long = f"{clean} {clean} grbzkxxyy grbzkoo grbzkuu {clean}"
    scores = tox._scores(net.state(), [long, f"{clean} {clean}"])
    assert scores[0] > 0.7 > scores[1]


def test_labels_of_held_out_documents_are_not_read(spark):
    rows = made(120, 2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    flip = [(i, 1 - x if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, _, x in rows]
    same = [
        tox.labelled_sample(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        for labels in ([(i, x) for i, _, x in rows], flip)
    ]
    assert same[0] == same[1]


def test_scale_refers_to_all_labels_when_a_cap_binds(spark):
    """Labels that the words do not tell: the score is the share of toxic ones."""
    rows = [(i, t, int(i % 10 == 0)) for i, t, _ in made(900, 4)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id bigint, toxic int")
    s = tox.Settings(word_slots=1 << 8, run_slots=1 << 8, epochs=1, sample_toxic=40, sample_clean=40)
    documents, toxic, stands_for = tox.labelled_sample(docs, labels, s)
    known = [x for i, _, x in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    assert stands_for == (known.count(0) / 40, known.count(1) / 40) and len(toxic) == 80
    logits, labels = np.zeros(80), np.array(toxic)
    weights = np.where(labels > 0, stands_for[1], stands_for[0])
    _, shift = tox._fit_scale(logits, labels, weights / weights.mean())
    share = known.count(1) / len(known)
    assert 1 / (1 + np.exp(-shift)) == pytest.approx(share, abs=0.03)
    assert tox.train(documents, toxic, s, stands_for).shift < tox.train(documents, toxic, s).shift - 0.5


def test_sampled_documents_are_whole(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(2000))) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id bigint, toxic int")
    words = {t for _, t in rows}
    for most in (240_000, 1000):
        s = tox.Settings(sample_windows=most)
        documents, toxic, stands_for = tox.labelled_sample(docs, labels, s)
        assert all(set(" ".join(d).split()) in [set(t.split()) for t in words] for d in documents)
        assert set(toxic) == {0, 1} and (len(documents) == len(ids)) == (most == 240_000)
        assert sum(map(len, documents)) <= most
        assert [round(stands_for[v] * toxic.count(v)) for v in (0, 1)] == [len(ids) - len(ids) // 2, len(ids) // 2]


def test_odd_documents(spark, odd_docs, fitted):
    net = fitted[2]
    found = tox.score_toxicity(odd_docs, net)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(texts()) and all(0 <= r.score <= 1 for r in rows)
    kept = tox.without_toxic(odd_docs, net)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(not r.predicted for r in rows)
    # Without labels of both classes nothing is called toxic.
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None), (4, 0)], "doc_id bigint, toxic int")
    none = tox.fit(odd_docs, labels)
    assert none is None and {r.score for r in tox.score_toxicity(odd_docs, none).collect()} == {0.0}


def test_no_documents(spark, no_docs, fitted):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert tox.fit(no_docs, labels) is None
    assert tox.score_toxicity(no_docs, fitted[2]).count() == 0


def test_query(spark, small):
    rows = op2_toxicity(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d["doc_id"] for d in small("documents"))
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def plain_score(net, text):
    """One word, one window after another."""
    s, p, h = net.s, net.p, net.s.hidden
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    words = tox.WORD.findall((text or "").lower())
    seen = {w: net.vectors(*tox.word_slots([w], s))[0][:, 0].astype(float) for w in set(words)}
    logits = []
    start = 0
    while True:
        window = [seen[w] for w in words[start:start + s.window]]
        states = np.zeros((max(len(window), 1), 2 * h))
        for k, side in enumerate("fb"):
            state = np.zeros(h)
            for t in range(len(window)) if side == "f" else reversed(range(len(window))):
                x = p[f"in_{side}"].astype(float) @ window[t] + p[f"gate_{side}"][:, 0]
                r = p[f"rec_{side}"].astype(float) @ state
                reset, update = sigmoid(x[:h] + r[:h]), sigmoid(x[h:2 * h] + r[h:2 * h])
                fresh = np.tanh(x[2 * h:] + reset * r[2 * h:])
                state = (1 - update) * fresh + update * state
                states[t, k * h:(k + 1) * h] = state
        weights = np.exp(states @ p["attend"])
        logits.append(float(p["out"] @ (weights / weights.sum() @ states) + p["bias"][0]))
        start += s.step
        if start + s.window - s.step >= len(words):
            break
    return float(sigmoid(net.scale * max(logits) + net.shift))


def test_scores_against_a_plain_forward_pass(spark, odd_docs):
    """Each text by itself, word by word; words past a text's end have no part in any window."""
    r = np.random.default_rng(7)
    net = tox.Network(tox.Settings(window=12, step=6, hidden=5, word_slots=128, run_slots=256, word_size=3, run_size=4))
    net.p = {k: (v + r.standard_normal(v.shape) * 0.4).astype(np.float32) for k, v in net.p.items()}
    net.scale, net.shift = 1.7, -0.2
    given = [(i, t) for i, t in texts() if len(t or "") < 10_000]
    given += [(100 + n, " ".join(f"w{k % 9}" for k in range(n))) for n in (1, 11, 12, 13, 17, 18, 19, 24, 25, 60)]
    df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    got = sorted(((r.doc_id, r.score) for r in tox.score_toxicity(df, net).collect()), key=repr)
    want = sorted(((i, plain_score(net, t)) for i, t in given), key=repr)
    key = lambda rows: sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, round(x[1], 4)))
    assert [i for i, _ in key(got)] == [i for i, _ in key(want)]
    assert [s for _, s in key(got)] == pytest.approx([s for _, s in key(want)], abs=2e-4)
    assert len({round(s, 3) for _, s in want}) > 8
