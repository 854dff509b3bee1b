"""A small bidirectional GRU with attention pooling over windows of words, in numpy.

A word enters as the embedding of its hash beside the mean embedding of its byte
trigrams. Both directions run as one stacked matrix product per time step. A window's
logit is a linear read-out of its attention-pooled states, a text's the largest of its
windows'.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

import numpy as np

from sparkscope.llm.textkit import Words, mix

WINDOW, STRIDE = 64, 48
BUCKETS = 1 << 15
WORD_DIM = CHAR_DIM = HIDDEN = ATTEND = 8


class Vocabulary:
    """Distinct words of a block: hash bucket, and byte-trigram buckets with the word they belong to."""

    def __init__(self, words: Words):
        if len(words):
            _, first, self.index = np.unique(words.hashes(), return_index=True, return_inverse=True)
        else:
            first, self.index = np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, size = words.start[first], words.end[first] - words.start[first]
        self.size = len(first)
        begin = np.concatenate([[0], np.cumsum(size + 2)])
        owner = np.repeat(np.arange(self.size), size + 2)
        inside = np.arange(begin[-1]) - begin[owner]
        letters = words.data[np.clip(start[owner] + inside - 1, 0, len(words.data) - 1)].astype(np.uint64)
        letters[begin[:-1]] = 2
        letters[begin[1:] - 1] = 3
        code = letters[:-2] | (letters[1:-1] << np.uint64(8)) | (letters[2:] << np.uint64(16)) if len(letters) else letters
        own = inside[: len(code)] < size[owner[: len(code)]]
        self.gram = (mix(code[own]) % np.uint64(BUCKETS)).astype(np.int64)
        self.gram_start = np.concatenate([[0], np.cumsum(size)])
        self.gram_owner = owner[: len(code)][own]
        self.word = (words.hashes()[first] % np.uint64(BUCKETS)).astype(np.int64) if self.size else np.zeros(0, np.int64)

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        if not self.size:
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        sums = np.add.reduceat(p["chars"][self.gram], self.gram_start[:-1], axis=0)
        return np.concatenate([p["words"][self.word], sums / np.diff(self.gram_start)[:, None]], axis=1).astype(np.float32)


def windows_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, document) of overlapping windows that cover all words of every document."""
    counts = words.counts
    number = np.where(counts > 0, 1 + np.maximum(0, -((counts - WINDOW) // -STRIDE)), 0)
    doc = np.repeat(np.arange(len(counts)), number)
    step = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    first = words.doc_first[doc] + step * STRIDE
    return first, np.minimum(WINDOW, words.doc_first[doc + 1] - first), doc


def start_values(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(scale, *shape):
        return rng.normal(0, scale, shape).astype(np.float32)
    return {
        "words": normal(0.05, BUCKETS, WORD_DIM), "chars": normal(0.05, BUCKETS, CHAR_DIM),
        "wx": normal(0.3, WORD_DIM + CHAR_DIM, 6 * HIDDEN), "bx": np.zeros(6 * HIDDEN, np.float32),
        "u": normal(0.3, 2, HIDDEN, 3 * HIDDEN), "wa": normal(0.3, 2 * HIDDEN, ATTEND), "ba": np.zeros(ATTEND, np.float32),
        "va": normal(0.3, ATTEND), "wo": normal(0.3, 2 * HIDDEN), "bo": np.zeros(1, np.float32)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(p: dict, inputs: np.ndarray, index: np.ndarray, length: np.ndarray, keep: list | None = None) -> tuple:
    """Logits of windows given as rows of word positions in ``inputs``; ``keep`` collects what backward needs."""
    batch, steps = index.shape
    gates = np.ascontiguousarray((inputs @ p["wx"] + p["bx"]).reshape(len(inputs), 2, 3 * HIDDEN).swapaxes(0, 1))
    mask = np.arange(steps) < length[:, None]
    order = np.stack([index, index[:, ::-1]])
    masks = np.stack([mask, mask[:, ::-1]]).astype(np.float32)[..., None]
    h = np.zeros((2, batch, HIDDEN), np.float32)
    states = np.empty((steps, 2, batch, HIDDEN), np.float32)
    side = np.arange(2)[:, None]
    for t in range(steps):
        x, hu = gates[side, order[:, :, t]], h @ p["u"]
        zr = sigmoid(x[..., : 2 * HIDDEN] + hu[..., : 2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        n = np.tanh(x[..., 2 * HIDDEN:] + r * hu[..., 2 * HIDDEN:])
        if keep is not None:
            keep.append((h, z, r, n, hu[..., 2 * HIDDEN:]))
        h = h + masks[:, :, t] * (1 - z) * (n - h)
        states[t] = h
    both = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1).swapaxes(0, 1)
    attend = np.tanh(both @ p["wa"] + p["ba"])
    energy = np.where(mask, attend @ p["va"], -1e9)
    share = np.exp(energy - energy.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    pooled = np.einsum("bt,bth->bh", share, both)
    return pooled @ p["wo"] + p["bo"][0], (mask, order, masks, both, attend, share, pooled)


def backward(p: dict, inputs: np.ndarray, kept: list, saved: tuple, slope: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the dense parameters and of ``inputs`` for d(loss)/d(logit) = ``slope``."""
    mask, order, masks, both, attend, share, pooled = saved
    steps = both.shape[1]
    g = {"wo": pooled.T @ slope, "bo": np.array([slope.sum()])}
    dpool = slope[:, None] * p["wo"]
    dshare = both @ dpool[:, :, None]
    denergy = share * (dshare[..., 0] - np.einsum("bt,bt->b", share, dshare[..., 0])[:, None])
    dpre = denergy[..., None] * p["va"] * (1 - attend * attend)
    g["va"] = np.einsum("bt,bta->a", denergy, attend)
    g["wa"], g["ba"] = np.einsum("bth,bta->ha", both, dpre), dpre.sum((0, 1))
    dboth = share[..., None] * dpool[:, None] + dpre @ p["wa"].T
    g["u"] = np.zeros_like(p["u"])
    dh = np.zeros_like(kept[0][0])
    dgates = np.empty((steps, *dh.shape[:2], 3 * HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        before, z, r, n, hn = kept[t]
        dh = dh + np.stack([dboth[:, t, :HIDDEN], dboth[:, steps - 1 - t, HIDDEN:]])
        live = dh * masks[:, :, t]
        dn = live * (1 - z) * (1 - n * n)
        dz = live * (before - n) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        dgates[t] = np.concatenate([dz, dr, dn], axis=-1)
        dhu = np.concatenate([dz, dr, dn * r], axis=-1)
        g["u"] += before.swapaxes(1, 2) @ dhu
        dh = dh - live * (1 - z) + dhu @ p["u"].swapaxes(1, 2)
    rows = np.zeros((len(inputs), 6 * HIDDEN), np.float32)
    for side in range(2):
        flat, values = order[side].T.ravel(), dgates[:, side].reshape(-1, 3 * HIDDEN)
        by = np.argsort(flat, kind="stable")
        cut = np.flatnonzero(np.diff(flat[by], prepend=-1))
        rows[flat[by][cut], side * 3 * HIDDEN: (side + 1) * 3 * HIDDEN] = np.add.reduceat(values[by], cut, axis=0)
    g["wx"], g["bx"] = inputs.T @ rows, rows.sum(0)
    return g, rows @ p["wx"].T


class Adam:
    """Adam steps; for an embedding table only the rows that a batch touched."""

    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in p.items()}
        self.v = {k: np.zeros_like(x) for k, x in p.items()}

    def step(self, g: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            at = rows.get(k, slice(None))
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * x
            self.v[k][at] = 0.99 * self.v[k][at] + 0.01 * x * x
            self.p[k][at] -= self.rate * (self.m[k][at] / (1 - 0.9 ** self.t)) / (
                np.sqrt(self.v[k][at] / (1 - 0.99 ** self.t)) + 1e-6)


def sum_rows(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(at, kind="stable")
    cut = np.flatnonzero(np.diff(at[order], prepend=-1))
    return at[order][cut], np.add.reduceat(values[order], cut, axis=0)


def score_windows(p: dict, words: Words, batch: int = 2048, vocabulary: Vocabulary | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(logit, document) of every window."""
    vocabulary = Vocabulary(words) if vocabulary is None else vocabulary
    inputs = vocabulary.inputs(p)
    first, length, doc = windows_of(words)
    logits = np.empty(len(first), np.float32)
    for low in range(0, len(first), batch):
        part = slice(low, low + batch)
        steps = int(length[part].max())
        at = np.minimum(first[part, None] + np.arange(steps), len(words) - 1)
        logits[part] = forward(p, inputs, vocabulary.index[at], length[part])[0]
    return logits, doc


def log_odds(parts: Iterable[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> np.ndarray:
    """Clipped log odds of label 1 for each bucket by the documents it occurs in; parts: (bucket, document) of some documents each."""
    one, all_ = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for at, doc in parts:
        pair = np.unique(doc.astype(np.int64) * BUCKETS + at)
        bucket, own = pair % BUCKETS, label[pair // BUCKETS]
        one += np.bincount(bucket[own == 1], minlength=BUCKETS)
        all_ += np.bincount(bucket, minlength=BUCKETS)
    a, b = (one + 0.5) / ((label == 1).sum() + 1), (all_ - one + 0.5) / ((label == 0).sum() + 1)
    return np.where(all_ >= 3, np.clip(np.log(a / b), -4, 4), 0).astype(np.float32) / 2


def document_parts(words: Words, least: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, document) arrays of whole documents, of at least so many words but for the last."""
    low, docs = 0, len(words.counts)
    while low < docs:
        high = min(docs, max(low + 1, int(np.searchsorted(words.doc_first, words.doc_first[low] + least))))
        yield np.arange(words.doc_first[low], words.doc_first[high]), np.repeat(np.arange(low, high), words.counts[low:high])
        low = high


def train(texts: list[bytes], label: np.ndarray, epochs: int, least_steps: int = 300, rate: float = 0.01, seed: int = 7,
          batch: int = 64) -> dict:
    """Fit on whole texts: of each text the windows with the largest logits take part in an epoch's steps.

    A text of label 0 must keep all windows low, so its two largest count, one of label 1
    needs one. There are ``epochs`` epochs, or as many as it takes for ``least_steps`` steps.
    """
    rng = np.random.default_rng(seed)
    p = start_values(rng)
    words = Words(texts)
    vocabulary = Vocabulary(words)

    def gram_parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at, doc in document_parts(words):
            own = vocabulary.index[at]
            grams = np.diff(vocabulary.gram_start)[own]
            inside = np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams)
            yield vocabulary.gram[np.repeat(vocabulary.gram_start[own], grams) + inside], np.repeat(doc, grams)

    p["words"][:, 0] += log_odds(((vocabulary.word[vocabulary.index[at]], doc) for at, doc in document_parts(words)), label)
    p["chars"][:, 0] += log_odds(gram_parts(), label)
    first, length, doc = windows_of(words)
    adam = Adam(p, rate)
    epochs = max(epochs, -(-least_steps * batch // max(1, len(np.unique(doc)))))
    for _ in range(epochs):
        logits = score_windows(p, words, vocabulary=vocabulary)[0]
        order = np.lexsort((-logits, doc))
        rank = np.arange(len(doc)) - np.searchsorted(doc[order], doc[order])
        chosen = rng.permutation(order[rank < np.where(label[doc[order]] == 1, 1, 2)])
        for low in range(0, len(chosen), batch):
            own = chosen[low: low + batch]
            used, inverse = np.unique(np.minimum(first[own, None] + np.arange(WINDOW), len(words) - 1), return_inverse=True)
            part, local = np.unique(vocabulary.index[used], return_inverse=True)
            index = local[inverse].reshape(len(own), WINDOW)
            counts = np.diff(vocabulary.gram_start)[part]
            gram_at = np.repeat(vocabulary.gram_start[part], counts) + (
                np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
            gram, begin = vocabulary.gram[gram_at], np.cumsum(counts) - counts
            chars = np.add.reduceat(p["chars"][gram], begin, axis=0) / counts[:, None]
            inputs = np.concatenate([p["words"][vocabulary.word[part]], chars], axis=1).astype(np.float32)
            kept: list = []
            out, saved = forward(p, inputs, index, length[own], kept)
            slope = ((sigmoid(out) - label[doc[own]]) / len(own)).astype(np.float32)
            g, dinputs = backward(p, inputs, kept, saved, slope)
            rows = {}
            rows["words"], g["words"] = sum_rows(vocabulary.word[part], dinputs[:, :WORD_DIM])
            rows["chars"], g["chars"] = sum_rows(gram, np.repeat(dinputs[:, WORD_DIM:] / counts[:, None], counts, axis=0))
            adam.step(g, rows)
        adam.rate *= 0.2 ** (1 / epochs)
    return p


def pack(p: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **p)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as stored:
        return {k: stored[k] for k in stored.files}
