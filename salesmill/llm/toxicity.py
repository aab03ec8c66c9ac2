"""Toxicity of documents, by a bidirectional gated recurrent network over words.

A document is read in overlapping windows of words, all of them. A word enters as two
vectors: one of its own, found by its hash, and one that takes the largest value, in each
dimension, over the vectors of its character runs; words never seen before are so still known
by their parts. A gated recurrent unit runs over the window in either direction, attention
pools its states, and a logistic unit scores the pool. A document scores as its highest
window, on a scale fitted to documents that the network was not trained on.

Training is numpy on the driver, over a bounded sample of labelled documents (``Settings``
holds the bounds); scoring is numpy in tasks.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, texts_of

# Longer runs of word characters are several words.
LONGEST = 24
WORD = re.compile(r"\w{1,%d}" % LONGEST)
THRESHOLD = 0.7


@dataclass(frozen=True)
class Settings:
    window: int = 32             # words
    step: int = 16               # words from one window to the next: any 17 in a row are whole in one
    hidden: int = 8              # units in a direction
    word_slots: int = 1 << 16
    word_size: int = 4
    run_slots: int = 1 << 18
    run_size: int = 4
    runs: tuple[int, ...] = (4, 5)   # characters in a run
    sample_toxic: int = 1500     # labelled documents to learn from, at most
    sample_clean: int = 3000
    sample_windows: int = 240_000    # of all of them, a third for toxic ones: fewer documents, each whole
    epochs: int = 14
    batch: int = 96
    rate: float = 0.01
    seed: int = 7


@dataclass
class Words:
    """Distinct words of a piece of work: number of each, and their character codes."""

    numbers: dict[str, int] = field(default_factory=lambda: _counter())

    def ids(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        return np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))


def _counter() -> dict[str, int]:
    numbers: dict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def word_slots(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each word, and slots of its character runs (-1 past its end)."""
    width = LONGEST + 2
    padded = np.array([f"^{w}$" for w in words], f"<U{width}") if words else np.zeros(0, f"<U{width}")
    codes = padded.view(np.uint32).reshape(len(words), width).astype(np.uint64)
    length = (codes > 0).sum(axis=1)
    factor = np.uint64(0x100000001B3)
    whole = np.full(len(words), 0xCBF29CE484222325, np.uint64)
    for k in range(width):
        whole = np.where(codes[:, k] > 0, (whole ^ codes[:, k]) * factor, whole)
    columns = []
    for run in s.runs:
        value = np.full((len(words), width - run + 1), 0xCBF29CE484222325 + run, np.uint64)
        for k in range(run):
            value = (value ^ codes[:, k:k + width - run + 1]) * factor
        slot = (_mixed(value) % np.uint64(s.run_slots)).astype(np.int32)
        # A word shorter than the run is one run by itself.
        slot[np.arange(width - run + 1)[None, :] > np.maximum(length - run, 0)[:, None]] = -1
        columns.append(slot)
    return (_mixed(whole) % np.uint64(s.word_slots)).astype(np.int32), np.concatenate(columns, axis=1)


def _mixed(x: np.ndarray) -> np.ndarray:
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)


def windows_of(ids: np.ndarray, s: Settings) -> np.ndarray:
    """All windows of a document, -1 past its end; an empty document has one empty window."""
    starts = np.arange(0, max(len(ids) - (s.window - s.step), 1), s.step)
    padded = np.full(starts[-1] + s.window, -1, np.int32)
    padded[: len(ids)] = ids
    return padded[starts[:, None] + np.arange(s.window)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Embeddings and network. Arrays of steps are ``(units, windows)``, so that each gate
    is a run of whole rows."""

    def __init__(self, s: Settings) -> None:
        r = np.random.default_rng(s.seed)
        d, h = s.word_size + s.run_size, s.hidden
        draw = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.s = s
        self.p = {
            "word": draw(s.word_slots, s.word_size, scale=0.05),
            "run": draw(s.run_slots, s.run_size, scale=0.05),
            "attend": draw(2 * h, scale=0.3),
            "out": draw(2 * h, scale=0.3),
            "bias": np.array([-1.0], np.float32),
        }
        for side in "fb":
            self.p[f"in_{side}"] = draw(3 * h, d, scale=d ** -0.5)
            self.p[f"rec_{side}"] = draw(3 * h, h, scale=h ** -0.5)
            self.p[f"gate_{side}"] = np.zeros((3 * h, 1), np.float32)
        self.scale, self.shift = 1.0, 0.0

    def state(self) -> dict:
        """What the network is, as plain values and arrays."""
        return {"s": asdict(self.s), "p": self.p, "scale": self.scale, "shift": self.shift}

    @classmethod
    def of_state(cls, state: dict) -> "Network":
        net = cls.__new__(cls)
        net.s, net.p = Settings(**state["s"]), state["p"]
        net.scale, net.shift = state["scale"], state["shift"]
        return net

    def vectors(self, slots: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of distinct words ``(size, words)``, and which run gave each maximum."""
        values = self.p["run"][runs]
        values[runs < 0] = -np.inf
        best = values.argmax(axis=1)
        top = np.take_along_axis(values, best[:, None, :], axis=1)[:, 0, :]
        return np.concatenate([self.p["word"][slots], top], axis=1).T.copy(), best

    def forward(self, vectors: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logit of each window. ``windows`` index columns of ``vectors``, -1 for none."""
        p, h = self.p, self.s.hidden
        n, steps = windows.shape
        # One column more, which no step reads for its value: past a window's end the state stays.
        ids = np.where(windows < 0, vectors.shape[1], windows).T.copy()
        there = (windows >= 0).T
        states = np.zeros((steps, 2 * h, n), np.float32)
        trace = {}
        for k, side in enumerate("fb"):
            drive = np.concatenate([p[f"in_{side}"] @ vectors + p[f"gate_{side}"], np.zeros((3 * h, 1), np.float32)], 1)
            state = np.zeros((h, n), np.float32)
            saved = []
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                x = np.take(drive, ids[t], axis=1)
                r = p[f"rec_{side}"] @ state
                gates = _sigmoid(x[: 2 * h] + r[: 2 * h])
                fresh = np.tanh(x[2 * h:] + gates[:h] * r[2 * h:])
                new = fresh + gates[h:] * (state - fresh)
                if not there[t].all():
                    new = np.where(there[t], new, state)
                if keep:
                    saved.append((t, state, gates, fresh, r[2 * h:]))
                state = new
                states[t, k * h:(k + 1) * h] = state
            trace[side] = saved
        attention = np.tensordot(states, p["attend"], axes=([1], [0]))
        attention = np.where(there, attention, -30.0)
        attention = np.exp(attention - attention.max(axis=0))
        attention /= attention.sum(axis=0)
        pooled = np.einsum("tun,tn->un", states, attention, optimize=True)
        logits = p["out"] @ pooled + p["bias"][0]
        return (logits, (ids, there, states, attention, pooled, trace)) if keep else logits

    def gradients(self, vectors: np.ndarray, windows: np.ndarray, targets: np.ndarray, weights: np.ndarray):
        """Gradients of the weighted logistic loss, and that of the word vectors."""
        p, h = self.p, self.s.hidden
        logits, (ids, there, states, attention, pooled, trace) = self.forward(vectors, windows, keep=True)
        error = ((_sigmoid(logits) - targets) * weights).astype(np.float32)
        g = {"out": pooled @ error, "bias": np.array([error.sum()], np.float32)}
        by_pool = p["out"][:, None] * error
        by_state = attention[:, None, :] * by_pool[None]
        through = np.einsum("tun,un->tn", states, by_pool, optimize=True)
        by_score = np.where(there, attention * (through - (attention * through).sum(axis=0)), 0)
        g["attend"] = np.einsum("tn,tun->u", by_score, states, optimize=True)
        by_state += by_score[:, None, :] * p["attend"][None, :, None]
        steps, n = there.shape
        by_place = np.zeros((vectors.shape[0], steps * n), np.float32)
        places = np.concatenate([vectors, np.zeros((len(vectors), 1), np.float32)], 1)[:, ids.ravel()]
        for k, side in enumerate("fb"):
            back = np.zeros((h, windows.shape[0]), np.float32)
            rec, inp = p[f"rec_{side}"], p[f"in_{side}"]
            g_rec, by_drive = np.zeros_like(rec), np.zeros((3 * h, steps, n), np.float32)
            for t, before, gates, fresh, r_fresh in reversed(trace[side]):
                back = back + by_state[t, k * h:(k + 1) * h]
                here = np.where(there[t], back, 0)
                reset, update = gates[:h], gates[h:]
                d_fresh = here * (1 - update) * (1 - fresh * fresh)
                d_update = here * (before - fresh) * update * (1 - update)
                d_reset = d_fresh * r_fresh * reset * (1 - reset)
                d_rec = np.concatenate([d_reset, d_update, d_fresh * reset])
                by_drive[:, t] = np.concatenate([d_reset, d_update, d_fresh])
                g_rec += d_rec @ before.T
                back = np.where(there[t], here * update, back) + rec.T @ d_rec
            by_drive = by_drive.reshape(3 * h, steps * n)
            g[f"rec_{side}"] = g_rec
            g[f"gate_{side}"] = by_drive.sum(axis=1, keepdims=True)
            g[f"in_{side}"] = by_drive @ places.T
            by_place += inp.T @ by_drive
        by_vector = np.zeros((vectors.shape[1] + 1, vectors.shape[0]), np.float32)
        np.add.at(by_vector, ids.ravel(), by_place.T)
        loss = float((weights * np.logaddexp(0, np.where(targets > 0, -logits, logits))).sum())
        return g, by_vector[:-1], loss

    def score_logits(self, texts: list[str], words: Words, block: int = 4096) -> np.ndarray:
        """The highest window logit of each text."""
        ids = [words.ids(t) for t in texts]
        cut = [windows_of(x, self.s) for x in ids]
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        windows = np.concatenate(cut)
        used, windows_at = np.unique(windows, return_inverse=True)
        windows_at = windows_at.reshape(windows.shape).astype(np.int32)
        if len(used) and used[0] < 0:
            used, windows_at = used[1:], windows_at - 1
        names = list(words.numbers)
        vectors, _ = self._in_parts([names[k] for k in used])
        logits = np.concatenate([
            self.forward(vectors, windows_at[k:k + block]) for k in range(0, len(windows), block)
        ])
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, owner, logits)
        return out

    def _in_parts(self, names: list[str], part: int = 8192):
        """Vectors of many words, some thousand at a time: their runs take most memory."""
        cut = [self.vectors(*word_slots(names[k:k + part], self.s)) for k in range(0, max(len(names), 1), part)]
        return np.concatenate([v for v, _ in cut], axis=1), None

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * logits + self.shift)


class Sample:
    """Labelled documents as windows of numbered words."""

    def __init__(self, documents: list[list[str]], toxic: list[int], s: Settings) -> None:
        self.s, words = s, Words()
        cut = []
        for texts in documents:
            rows = np.full((max(len(texts), 1), s.window), -1, np.int32)
            for k, text in enumerate(texts):
                ids = words.ids(text)
                rows[k, : len(ids)] = ids
            cut.append(rows)
        self.windows = np.concatenate(cut)
        self.owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        self.toxic = np.array(toxic, np.float32)
        self.slots, self.run_slots = word_slots(list(words.numbers), s)

    def associations(self, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How much more often each slot is in toxic documents than by chance, between -1 and
        1: a start for the vectors. Counts come from ``documents`` only."""
        n, n_toxic = len(documents), float(self.toxic[documents].sum())
        counts = [np.zeros((2, size)) for size in (self.s.word_slots, self.s.run_slots)]
        bounds = np.searchsorted(self.owner, np.arange(len(self.toxic) + 1))
        for d in documents:
            ids = np.unique(self.windows[bounds[d]:bounds[d + 1]])
            ids = ids[ids >= 0]
            runs = np.unique(self.run_slots[ids])
            for count, slots in zip(counts, (np.unique(self.slots[ids]), runs[runs >= 0])):
                count[0, slots] += 1
                count[1, slots] += self.toxic[d]
        share = n_toxic / max(n, 1)
        out = []
        for seen, seen_toxic in counts:
            expected = seen * share
            out.append(np.tanh((seen_toxic - expected) / np.sqrt(expected * (1 - share) + 1) / 6))
        return out[0].astype(np.float32), out[1].astype(np.float32)


class Adam:
    def __init__(self, parameters: dict[str, np.ndarray], rate: float) -> None:
        self.p, self.rate, self.t = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> None:
        """Update; of parameters named in ``rows`` only those rows."""
        self.t += 1
        rate = self.rate * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for k, g in gradients.items():
            at = rows.get(k, slice(None))
            m = self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
            v = self.v[k][at] = 0.999 * self.v[k][at] + 0.001 * g * g
            self.p[k][at] -= rate * m / (np.sqrt(v) + 1e-8)


def train(
    documents: list[list[str]], toxic: list[int], s: Settings = Settings(), stands_for: tuple[float, float] = (1.0, 1.0)
) -> Network | None:
    """Fit the network to documents given as texts of their windows; None with one class only.

    Which window of a toxic document is toxic is not known: each document learns through its
    highest window, chosen anew every third round (at first by the associations of its words);
    clean documents also through one at random. A quarter of the documents is held back to
    fit the scale of the scores; there a clean and a toxic document count as many labelled ones as
    they stand for, so that scores refer to all labelled documents at every size.
    """
    if len(set(toxic)) < 2:
        return None
    r = np.random.default_rng(s.seed)
    data, net = Sample(documents, toxic, s), Network(s)
    order = r.permutation(len(documents))
    back, learn = order[: len(order) // 4], order[len(order) // 4:]
    if len(set(data.toxic[learn])) < 2:
        learn = order
    word, run = data.associations(learn)
    net.p["word"][:, 0], net.p["run"][:, 0] = word, run
    bounds = np.searchsorted(data.owner, np.arange(len(documents) + 1))
    is_run = data.run_slots >= 0
    by_word = np.where(is_run, run[data.run_slots], -1).max(axis=1) + word[data.slots]
    value = np.append(by_word, -2.0)[data.windows].max(axis=1)
    adam = Adam(net.p, s.rate)
    balance = max(1.0, (len(learn) - data.toxic[learn].sum()) / data.toxic[learn].sum())
    for epoch in range(s.epochs):
        if epoch and epoch % 3 == 0:
            value = _window_logits(net, data)
        highest = np.array([bounds[d] + value[bounds[d]:bounds[d + 1]].argmax() for d in learn])
        clean = learn[data.toxic[learn] == 0]
        any_of = r.integers(bounds[clean], bounds[clean + 1])
        chosen = np.concatenate([highest, any_of])
        targets = np.concatenate([data.toxic[learn], np.zeros(len(clean), np.float32)])
        shuffled = r.permutation(len(chosen))
        adam.rate = s.rate * (1 - epoch / s.epochs) + 1e-4
        for at in range(0, len(chosen), s.batch):
            some = shuffled[at:at + s.batch]
            _learn(net, adam, data, data.windows[chosen[some]], targets[some], balance)
    logits = np.maximum.reduceat(_window_logits(net, data), bounds[:-1])
    fit_on = back if len(set(data.toxic[back])) == 2 else learn
    weights = np.where(data.toxic[fit_on] > 0, stands_for[1], stands_for[0])
    net.scale, net.shift = _fit_scale(logits[fit_on], data.toxic[fit_on], weights / weights.mean())
    return net


def _window_logits(net: Network, data: Sample, block: int = 4096) -> np.ndarray:
    vectors = np.concatenate([
        net.vectors(data.slots[k:k + 8192], data.run_slots[k:k + 8192])[0]
        for k in range(0, max(len(data.slots), 1), 8192)
    ], axis=1)
    return np.concatenate([
        net.forward(vectors, data.windows[k:k + block]) for k in range(0, len(data.windows), block)
    ])


def _learn(net: Network, adam: Adam, data: Sample, windows: np.ndarray, targets: np.ndarray, balance: float) -> None:
    used, local = np.unique(windows, return_inverse=True)
    local = local.reshape(windows.shape)
    if used[0] < 0:
        used, local = used[1:], local - 1
    if not len(used):
        return
    slots, runs = data.slots[used], data.run_slots[used]
    vectors, best = net.vectors(slots, runs)
    weights = np.where(targets > 0, balance, 1.0)
    g, by_vector, _ = net.gradients(vectors, local, targets, weights / weights.sum())
    size = net.s.word_size
    rows = {}
    rows["word"], g["word"] = _by_row(slots, by_vector[:, :size])
    # A maximum passes its gradient to the run that gave it.
    won = np.take_along_axis(runs, best, axis=1)
    g_run = np.zeros((len(used), net.s.run_size, net.s.run_size), np.float32)
    index = np.arange(net.s.run_size)
    g_run[:, index, index] = by_vector[:, size:]
    rows["run"], g["run"] = _by_row(won.ravel(), g_run.reshape(-1, net.s.run_size))
    adam.step(g, rows)


def _by_row(slots: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, at = np.unique(slots, return_inverse=True)
    out = np.zeros((len(rows), gradient.shape[1]), np.float32)
    np.add.at(out, at, gradient)
    return rows, out


def _fit_scale(logits: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of the label on the logit, drawn towards scale 1 and shift 0."""
    x = np.stack([logits, np.ones_like(logits)], axis=1).astype(float)
    w, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(25):
        q = _sigmoid(x @ w)
        gradient = x.T @ (weights * (q - toxic)) + 0.5 * (w - start)
        curve = (x * (weights * q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(2)
        w = w - np.linalg.solve(curve, gradient)
        w[0] = max(w[0], 0.05)
    return float(w[0]), float(w[1])


# ---------------------------------------------------------------- on tables

def held_out(doc_id="doc_id"):
    """Whether a document is left out of training: crc32 of its id as text, by three, leaves 1."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(
    docs: DataFrame, labels: DataFrame, s: Settings = Settings()
) -> tuple[list[list[str]], list[int], tuple[float, float]]:
    """All windows of up to ``sample_toxic`` and ``sample_clean`` labelled documents, not held out,
    first by the hash of their ids. A document labelled twice is toxic if one label says so. Last
    come the labelled documents that a clean and a toxic one of the sample stand for."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null").where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    parts = [
        known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for value, most in ((1, s.sample_toxic), (0, s.sample_clean))
    ]
    rows = [(row.doc_id, row.toxic) for part in parts for row in part.collect()]
    if not rows:
        return [], [], (1.0, 1.0)
    of_all = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).where("toxic in (0, 1)").collect()}
    # Bounded by the settings: some thousand ids.
    chosen = docs.sparkSession.createDataFrame(rows, "doc_id bigint, toxic int")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = []
            for text in texts_of(batch.column("text")):
                words = WORD.findall(text.lower())
                starts = np.arange(0, max(len(words) - (s.window - s.step), 1), s.step)
                found.append([" ".join(words[k:k + s.window]) for k in starts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))],
                ["doc_id", "toxic", "windows"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = stage(
        texts.join(F.broadcast(chosen), "doc_id").mapInArrow(cut, "doc_id bigint, toxic int, windows array<string>"),
        "labelled-windows",
    )
    sizes = {r.doc_id: r.n for r in found.groupBy("doc_id").agg(F.sum(F.size("windows")).alias("n")).collect()}
    left = {1: s.sample_windows // 3, 0: s.sample_windows - s.sample_windows // 3}
    whole, full = [], set()
    for doc_id, value in rows:
        n = sizes.get(doc_id, 0)
        # The first of a class is taken whatever its length, and the order decides, not the length.
        if value in full or n > left[value] and any(v == value for _, v in whole[-1:]):
            full.add(value)
            continue
        left[value] -= n
        whole.append((doc_id, value))
    rows = whole
    if full:
        kept = docs.sparkSession.createDataFrame([(i,) for i, _ in rows], "doc_id bigint")
        found = found.join(F.broadcast(kept), "doc_id", "left_semi")
    sample = found.select("doc_id", "toxic", "windows").toArrow()
    # Copies would count as many times; keep each content once, in a fixed order.
    seen = {}
    for doc_id, toxic, windows in sorted(zip(*(sample.column(c).to_pylist() for c in sample.column_names))):
        key = tuple(windows)
        seen[key] = max(seen.get(key, 0), toxic)
    sampled = Counter(value for _, value in rows)
    stands_for = tuple(of_all[v] / sampled[v] if sampled[v] else 1.0 for v in (0, 1))
    return [list(k) for k in seen], list(seen.values()), stands_for


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Network | None:
    documents, toxic, stands_for = labelled_sample(docs, labels, s)
    return train(documents, toxic, s, stands_for)


def _shared(docs: DataFrame, net: Network | None):
    """The network for all tasks; its size is fixed by the settings."""
    return docs.sparkSession.sparkContext.broadcast(net and net.state())


def _scores(state: dict | None, texts: list[str]) -> np.ndarray:
    if state is None:
        return np.zeros(len(texts))
    net = Network.of_state(state)
    return net.probability(net.score_logits(texts, Words()))


def score_toxicity(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, held_out, score, predicted``.

    Scores depend on the text alone. Null and empty texts score as an empty window. Without a
    network (labels of one class or none) every score is 0. Repeated rows give repeated
    results; no rows give none. Other columns are not read.
    """
    shared = _shared(docs, net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = _scores(shared.value, texts_of(batch.column("text"))).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, score double"
    )
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all their columns (any names), that score below the threshold.

    Null and empty texts score as an empty window; long ones count whole. Without a network every row
    stays. Repeated rows go or stay together; no rows give none.
    """
    shared = _shared(docs, net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(_scores(shared.value, texts_of(batch.column("text"))) < threshold))

    return docs.mapInArrow(run, docs.schema)
