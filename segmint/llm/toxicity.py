"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

A word enters the network as two vectors: its own (words of the training vocabulary) and
the mean of its character trigrams' (any word). Every text is read as overlapping windows
of ``WINDOW`` words, ``STRIDE`` apart, from its first word to its last; a text's score is
the calibrated logit of its worst window. Trained in numpy, on a bounded sample of
labelled rows: at most ``SAMPLE`` documents of each label and ``DOC_WINDOWS`` windows of
each. A fifth of them trains nothing and fits the scale and shift of the score instead, on
the worst of all their windows. Documents whose crc32 of the id is divisible by ``FOLDS`` are never trained on.

Labels are per document, not per window: a first epoch takes every window by its
document's label, later ones take from a toxic document only the window the network itself rates
worst, and from a clean one the two worst and a tenth of the rest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import byte_slices, give_back, prepare, tidy
from segmint.llm.windows import word_lists

WINDOW, STRIDE = 24, 12
SAMPLE, DOC_WINDOWS, FOLDS = 1500, 32, 5
VOCABULARY, TRIGRAMS = 8192, 4096
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
EPOCHS, BATCH, RATE, SEED = 8, 256, 0.01, 7
DECAY, DROPPED = 0.1, 0.1  # of word and trigram vectors; words that enter as unknown while training
LEAST = 3  # documents of a vocabulary word
STEPS = 150  # at least so many, on a small sample in more epochs
CHUNK = 2048  # windows scored at a time
SLICE_BYTES = 1 << 20  # of texts scored at a time (a longer one alone)


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of ``<word>`` in lower case, laid end to end, and where each word's start."""
    marked = ["<" + w.lower() + ">" for w in words]
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    ends = np.cumsum(size)
    count = np.maximum(size - 2, 1)
    starts = np.cumsum(count) - count
    at = np.repeat(ends - size, count) + np.arange(int(count.sum())) - np.repeat(starts, count)
    wide = np.append(points, np.zeros(2, np.uint64))
    h = wide[at] * np.uint64(0x9E3779B97F4A7C15) + wide[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + wide[at + 2] * np.uint64(0x165667B19E3779F9)
    return ((h >> np.uint64(33)) % np.uint64(TRIGRAMS)).astype(np.int64), starts


def windows_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, length) of all windows of texts with these word bounds; none for texts without words."""
    n = np.diff(bounds)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[text] + k * STRIDE
    return text, start, np.minimum(WINDOW, bounds[text + 1] - start)


def _half_tanh(x):
    """The logistic function of 2x."""
    return 0.5 * np.tanh(x) + 0.5


class Network:
    """Weights: E, C (word and trigram vectors), W, U, b (both directions' gates), A, v (attention), o, c (output).

    Gates are held as half their logits, so that logistic and tanh are one function."""

    def __init__(self, vocabulary: dict[str, int], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        d = WORD_DIM + CHAR_DIM
        self.p = {"E": normal(len(vocabulary) + 1, WORD_DIM, scale=0.3), "C": normal(TRIGRAMS, CHAR_DIM, scale=0.5),
                  "W": normal(2, d, 3 * HIDDEN, scale=0.3), "U": normal(2, HIDDEN, 3 * HIDDEN, scale=0.2), "b": np.zeros((2, 3 * HIDDEN), np.float32),
                  "A": normal(2 * HIDDEN, ATTENTION, scale=0.3), "v": normal(ATTENTION, scale=0.3), "o": normal(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32)}
        self.p["E"][0] = 0
        self.scale, self.shift, self.empty = 1.0, 0.0, -5.0

    def inputs(self, words: list[str], drop=None) -> tuple[np.ndarray, tuple]:
        """Input vectors of distinct words; ``drop`` marks words to enter as unknown."""
        ids = np.fromiter((self.vocabulary.get(w.lower(), 0) for w in words), dtype=np.int64, count=len(words))
        if drop is not None:
            ids[drop] = 0
        grams, starts = trigrams(words)
        count = np.diff(np.append(starts, len(grams))).astype(np.float32)
        chars = np.add.reduceat(self.p["C"][grams], starts, axis=0) / count[:, None]
        return np.concatenate([self.p["E"][ids], chars], axis=1), (ids, grams, starts, count)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Both directions' input part of the gates for distinct words; the last row, for padding, leaves the state as it is."""
        g = np.matmul(x[None], self.p["W"]) + self.p["b"][:, None]
        pad = np.zeros((2, 1, 3 * HIDDEN), np.float32)
        pad[:, :, :HIDDEN] = -50
        return np.concatenate([g, pad], axis=1)

    def forward(self, gates: np.ndarray, at: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of windows ``at`` (rows of word numbers, padded with the last)."""
        p, (n, t), hid = self.p, at.shape, HIDDEN
        states = np.zeros((t + 1, 2, n, hid), np.float32)
        kept = []
        for k in range(t):
            g = np.stack([gates[0][at[:, k]], gates[1][at[:, t - 1 - k]]])
            h = states[k]
            u = np.matmul(h, p["U"])
            zr = _half_tanh(g[..., : 2 * hid] + u[..., : 2 * hid])
            z, r = zr[..., :hid], zr[..., hid:]
            cand = np.tanh(g[..., 2 * hid :] + r * u[..., 2 * hid :])
            states[k + 1] = h + z * (cand - h)
            if keep:
                kept.append((zr, cand, u[..., 2 * hid :]))
        both = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=2).transpose(1, 0, 2)  # window, place, 2 * hidden
        a = np.tanh(both @ p["A"])
        score = a @ p["v"]
        score[np.arange(t)[None, :] >= size[:, None]] = -1e9
        weight = np.exp(score - score.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", weight, both)
        logit = pooled @ p["o"] + p["c"][0]
        return (logit, (states, kept, both, a, weight, pooled)) if keep else logit

    def gradients(self, words, at, size, label, drop=None) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, back through time, attention and both inputs."""
        p, hid, (n, t) = self.p, HIDDEN, at.shape
        x, (ids, grams, starts, count) = self.inputs(words, drop)
        gates = self.gates(x)
        logit, (states, kept, both, a, weight, pooled) = self.forward(gates, at, size, keep=True)
        d_logit = ((1 / (1 + np.exp(-logit)) - label) / n).astype(np.float32)
        g = {"o": pooled.T @ d_logit, "c": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["o"]
        d_both = weight[..., None] * d_pooled[:, None]
        d_weight = np.einsum("nh,nth->nt", d_pooled, both)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        d_a = d_score[..., None] * p["v"] * (1 - a * a)
        g["v"] = np.einsum("nt,nta->a", d_score, a)
        g["A"] = np.einsum("nth,nta->ha", both, d_a)
        d_both += d_a @ p["A"].T
        d_out = np.stack([d_both[..., :hid].transpose(1, 0, 2), d_both[:, ::-1, hid:].transpose(1, 0, 2)], axis=1)  # step, direction, window
        d_gates = np.zeros_like(gates)
        g["U"] = np.zeros_like(p["U"])
        d_h = np.zeros((2, n, hid), np.float32)
        for k in range(t - 1, -1, -1):
            d_h = d_h + d_out[k]
            zr, cand, u_c = kept[k]
            z, r, h = zr[..., :hid], zr[..., hid:], states[k]
            d_c = d_h * z * (1 - cand * cand)
            d_z = d_h * (cand - h) * 2 * z * (1 - z)
            d_r = d_c * u_c * 2 * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_c * r], axis=2)
            d_g = np.concatenate([d_z, d_r, d_c], axis=2)
            g["U"] += np.matmul(h.transpose(0, 2, 1), d_u)
            np.add.at(d_gates[0], at[:, k], d_g[0])
            np.add.at(d_gates[1], at[:, t - 1 - k], d_g[1])
            d_h = d_h * (1 - z) + np.matmul(d_u, p["U"].transpose(0, 2, 1))
        d_gates = d_gates[:, :-1]
        g["b"] = d_gates.sum(axis=1)
        g["W"] = np.matmul(x.T[None], d_gates)
        d_x = np.matmul(d_gates, p["W"].transpose(0, 2, 1)).sum(axis=0)
        g["E"] = np.zeros_like(p["E"])
        np.add.at(g["E"], ids, d_x[:, :WORD_DIM])
        g["E"][0] = 0
        g["C"] = np.zeros_like(p["C"])
        np.add.at(g["C"], grams, np.repeat(d_x[:, WORD_DIM:] / count[:, None], count.astype(int), axis=0))
        return g

    def logits(self, words: list[str], number: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Logit of each window of a run of word numbers."""
        gates = self.gates(self.inputs(words)[0])
        wide = np.append(number, np.full(WINDOW, len(words)))
        out = []
        for lo in range(0, len(start), CHUNK):
            s, m = start[lo : lo + CHUNK], size[lo : lo + CHUNK]
            at = wide[s[:, None] + np.arange(WINDOW)]
            at[np.arange(WINDOW)[None, :] >= m[:, None]] = len(words)
            out.append(self.forward(gates, at, m))
        return np.concatenate(out) if out else np.zeros(0)

    def score(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -30, 30)))

    def worst_logits(self, texts: pa.Array) -> np.ndarray:
        """Logit of the worst window of each whole text; -inf for texts without words."""
        number, bounds, distinct = word_lists(texts.fill_null(""))
        text, start, size = windows_of(bounds)
        worst = np.full(len(texts), -np.inf)
        if len(text):
            np.maximum.at(worst, text, self.logits(distinct.to_pylist(), number, start, size))
        return worst

    def score_texts(self, texts: pa.Array) -> np.ndarray:
        """Score of each whole text; texts without words get that of an ordinary clean text."""
        worst = self.worst_logits(texts)
        worst[np.isinf(worst)] = self.empty
        return self.score(worst)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Scale and shift by a logistic fit of whole documents' worst logits to their labels."""
        seen = np.isfinite(x)
        x, y = x[seen].astype(np.float64), y[seen].astype(np.float64)
        if not len(x):
            return
        scale, shift = 1.0, 0.0
        for _ in range(200):
            e = 1 / (1 + np.exp(-np.clip(scale * x + shift, -30, 30))) - y
            scale -= 0.05 * float((e * x).mean())
            shift -= 0.2 * float(e.mean())
        self.scale, self.shift = max(scale, 0.05), shift
        self.empty = float(np.median(x[y == 0])) if (y == 0).any() else -5.0


def seed_odds(net: Network, docs, names: list[str]) -> None:
    """First components of the vectors: smoothed log odds that a document with the word, or with the trigram, is toxic."""
    grams, starts = trigrams(names)
    count = np.diff(np.append(starts, len(grams)))
    number = {w: k for k, w in enumerate(names)}
    words, chars = np.zeros((2, len(net.p["E"]))), np.zeros((2, TRIGRAMS))
    total = np.ones(2)
    for y, ws in docs:
        seen = {w for w in ws if w}
        total[y] += 1
        words[y, list({net.vocabulary.get(w.lower(), 0) for w in seen})] += 1
        if seen:
            k = np.fromiter((number[w] for w in seen), dtype=np.int64, count=len(seen))
            n = count[k]
            chars[y, np.unique(grams[np.repeat(starts[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])] += 1
    for key, n in (("E", words), ("C", chars)):
        rate = (n + 0.5) / (total[:, None] + 1)
        net.p[key][:, 0] = np.clip(np.log(rate[1] / rate[0]), -3, 3)
    net.p["E"][0] = 0


def calibrating(n: int) -> np.ndarray:
    """Which of ``n`` sampled documents calibrate the score and train nothing."""
    return np.arange(n) % 5 == 4


def fit(docs: list[tuple[int, list[str]]], seed: int = SEED) -> Network:
    """A network from (label, words of some windows, each padded with '' to ``WINDOW``) of labelled documents,
    not calibrated yet; of scale 0 where there was nothing to learn from. Nothing is learnt from the
    calibrating documents: neither weights nor vocabulary nor the odds the vectors start from."""
    rng = np.random.default_rng(seed)
    docs = [d for d, of in zip(docs, calibrating(len(docs)), strict=True) if not of]
    counts: dict[str, int] = {}  # documents with the word
    for _, ws in docs:
        for w in {w.lower() for w in ws if w}:
            counts[w] = counts.get(w, 0) + 1
    names = np.array(sorted({w for _, words in docs for w in words}) or [""], dtype=object)
    code = {w: k for k, w in enumerate(names)}
    number = np.fromiter((code[w] for _, words in docs for w in words), dtype=np.int32)  # the one array as long as the sample
    common = sorted((w for w, c in counts.items() if c >= LEAST), key=lambda w: (-counts[w], w))[:VOCABULARY]
    net = Network({w: k + 1 for k, w in enumerate(common)}, seed)
    seed_odds(net, docs, names.tolist())
    if not len(number) or len({y for y, _ in docs}) < 2:
        net.scale, net.shift = 0.0, -1.0 if not any(y for y, _ in docs) else 1.0
        return net
    at = number.reshape(-1, WINDOW)
    size = np.array([names[row] != "" for row in at]).sum(axis=1)
    owner = np.repeat(np.arange(len(docs)), [len(w) // WINDOW for _, w in docs])
    label = np.array([y for y, _ in docs])
    toxic, clean = (np.flatnonzero(label[owner] == y) for y in (1, 0))
    words = names.tolist()

    def all_logits(rows):
        gates = net.gates(net.inputs(words)[0])
        out = []
        for lo in range(0, len(rows), CHUNK):
            r = rows[lo : lo + CHUNK]
            out.append(net.forward(gates, np.where(np.arange(WINDOW)[None, :] < size[r][:, None], at[r], len(words)), size[r]))
        return np.concatenate(out)

    moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in net.p.items()}
    step = 0

    def worst_of_each(rows, most):
        order = np.lexsort((-all_logits(rows), owner[rows]))
        heads = np.flatnonzero(np.concatenate([[True], np.diff(owner[rows][order]) != 0]))
        place = np.arange(len(rows)) - np.repeat(heads, np.diff(np.append(heads, len(rows))))
        return rows[order][place < most]

    epoch = 0
    while epoch < EPOCHS or step < STEPS:
        if epoch:
            some = clean[rng.random(len(clean)) < 0.1]
            rows = np.concatenate([np.repeat(worst_of_each(toxic, 1), 2), worst_of_each(clean, 2), some])
        else:
            rows = np.concatenate([toxic, clean])
        rng.shuffle(rows)
        for lo in range(0, len(rows), BATCH):
            r = rows[lo : lo + BATCH]
            used, inv = np.unique(at[r], return_inverse=True)
            inv = np.where(np.arange(WINDOW)[None, :] < size[r][:, None], inv.reshape(len(r), WINDOW), len(used))
            grads = net.gradients([words[u] for u in used], inv, size[r], label[owner[r]].astype(np.float32), rng.random(len(used)) < DROPPED)
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                if k in ("E", "C"):
                    net.p[k] *= 1 - RATE * DECAY
                net.p[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        epoch += 1
    return net


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE) -> Network:
    """Fit on at most ``sample`` labelled documents of each label outside the held-out fold, spread over all by a hash of the id;
    of rows repeated under one id, the one whose text has the smallest hash."""
    prepare(docs.sparkSession)
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
    pool = docs.where(~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    picked = None
    for y in (0, 1):
        ids = marks.where((F.col("y") == y) & ~held_out("_id")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        picked = ids if picked is None else picked.union(ids)

    def some(batches):
        for batch in batches:
            number, bounds, distinct = word_lists(batch.column(2).fill_null(""))
            words = np.array([*distinct.to_pylist(), ""], dtype=object)
            text, start, size = windows_of(bounds)
            rows = []
            for k, (i, y) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                mine = np.flatnonzero(text == k)
                mine = mine[np.linspace(0, len(mine) - 1, min(len(mine), DOC_WINDOWS)).astype(int)] if len(mine) else mine
                got = [w for m in mine for w in (*words[number[start[m] : start[m] + size[m]]], *[""] * (WINDOW - size[m]))]
                rows.append((i, y, " ".join(got) if got else None))  # words hold no space
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["id", "y", "words"]), preserve_index=False,
                                             schema=pa.schema([("id", pa.int64()), ("y", pa.int32()), ("words", pa.string())]))

    def texts(ids: DataFrame) -> DataFrame:
        one = F.min_by("text", F.xxhash64("text")).alias("text")
        return pool.join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min("y").alias("y"), one).select(F.col("_id").cast("long").alias("id"), "y", "text").repartition(32)

    rows = texts(picked).mapInArrow(tidy(some), "id long, y int, words string").collect()  # 2 * sample documents of DOC_WINDOWS windows at most
    rows.sort(key=lambda r: (r.id, r.words or ""))
    same: dict[str, str] = {}  # one object per distinct word: the sample has millions of words
    docs_, ids = [], [r.id for r in rows]
    while rows:
        r = rows.pop()
        docs_.append((r.y, [same.setdefault(w, w) for w in r.words.split(" ")] if r.words is not None else []))
    docs_.reverse()
    net = fit(docs_)
    del docs_, same
    give_back()  # the driver, too, is there for later stages
    if not net.scale:
        return net
    mine = {i for i, of in zip(ids, calibrating(len(ids)), strict=True) if of}

    def whole(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(net.worst_logits(part.column(1)).astype(np.float64))], names=["y", "logit"])

    held = picked.where(F.col("_id").isin(mine))
    got = sorted(texts(held).select("y", "text").mapInArrow(tidy(whole), "y int, logit double").collect())  # one logit a document
    net.calibrate(np.array([r.logit for r in got]), np.array([r.y for r in got]))
    return net


def score_documents(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row; every word of a text is in some window.

    Null and empty texts get the score of an ordinary clean text, repeated rows equal
    scores; a null id is scored and counts as not held out. Only the text decides.
    """
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, SLICE_BYTES):
                score = net.score_texts(part.column(2)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int"))


def drop_toxic(docs: DataFrame, net: Network, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text scores ``least`` or more; columns and other rows as they are."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, at, SLICE_BYTES):
                yield part.filter(pa.array(net.score_texts(part.column(at).cast(pa.string())) < least))

    return docs.mapInArrow(tidy(run), docs.schema)
