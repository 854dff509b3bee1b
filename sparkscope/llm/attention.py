"""A small causal self-attention language model over subword ids, in numpy.

A position sees the tokens before it: those of its own block of ``BLOCK`` targets and of
the block before, so context windows of two blocks overlap by half and every token is
scored once, with at least ``BLOCK`` tokens of context unless the text is younger. Attention
scores are scaled dot products plus a learned bias per distance; masked entries are the
future and what lies before the text.

The output is exact over the whole vocabulary: a softmax over the most frequent subwords
and one slot for all others, on top of the corpus' bigram log frequencies, then for the
others their smoothed corpus frequency after the previous subword's class.
"""

from __future__ import annotations

import numpy as np

BLOCK = 32
DIM = 16
#: Subwords that have an own slot of the softmax, and an own input embedding.
HEAD, TYPES = 160, 1024
SMOOTH = 20.0
FIELDS = ("emb", "wq", "wk", "wv", "rel", "wo", "bo")


def start_values(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(scale, *shape):
        return rng.normal(0, scale, shape).astype(np.float32)
    return {"emb": normal(0.3, TYPES, DIM), "wq": normal(0.3, DIM, DIM), "wk": normal(0.3, DIM, DIM), "wv": normal(0.3, DIM, DIM),
            "rel": np.zeros(2 * BLOCK, np.float32), "wo": normal(0.05, DIM, HEAD + 1), "bo": np.zeros(HEAD + 1, np.float32)}


class Frequencies:
    """What the model takes from corpus counts: ranks of subwords and (class, subword) frequencies.

    ``pairs`` are (previous class, subword, count) arrays over all training tokens.
    """

    def __init__(self, order: np.ndarray, size: int, pairs: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.rank = np.full(size, len(order), np.int32)
        self.rank[order] = np.arange(len(order), dtype=np.int32)
        self.size = size
        known = len(order) + 1  # the last column stands for every subword never seen in training
        counts = np.zeros((HEAD + 1, known))
        np.add.at(counts, (pairs[0], np.minimum(self.rank[pairs[1]], known - 1)), pairs[2])
        rare = max(1, size - len(order))
        slots = np.concatenate([counts[:, :HEAD], counts[:, HEAD:].sum(1, keepdims=True)], axis=1)
        slots = np.pad(slots, ((0, 0), (0, HEAD + 1 - slots.shape[1])))
        base = slots.sum(0) + 0.5
        slots = slots + SMOOTH * base / base.sum()
        self.bigram = np.log(slots / slots.sum(1, keepdims=True)).astype(np.float32)
        tail = counts[:, HEAD:] if known > HEAD else np.zeros((HEAD + 1, 1))
        alone = tail.sum(0) + 0.5
        alone[-1] = 0.5 * rare
        alone /= alone.sum()
        tail = tail + SMOOTH * alone
        tail /= tail.sum(1, keepdims=True)
        tail[:, -1] /= rare
        self.tail = np.log(tail).astype(np.float32)

    def slot(self, tokens: np.ndarray) -> np.ndarray:
        return np.minimum(self.rank[tokens], HEAD)

    def type(self, tokens: np.ndarray) -> np.ndarray:
        return np.minimum(self.rank[tokens], TYPES - 1)

    def tail_column(self, tokens: np.ndarray) -> np.ndarray:
        return np.clip(self.rank[tokens] - HEAD, 0, self.tail.shape[1] - 1)


def block_starts(doc_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first target, document start, document end) of every block; ``doc_start`` ends with the number of tokens."""
    sizes = np.diff(doc_start)
    number = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(sizes)), number)
    first = doc_start[doc] + BLOCK * (np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number))
    return first, doc_start[doc], doc_start[doc + 1]


_DISTANCE = BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None, :]  # query minus key


_VISIBLE = (_DISTANCE >= 0).astype(np.float32)
#: Exponents up to this are taken as they are; beyond it the largest of a row is subtracted first.
CALM = 40.0


def context(inputs: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key positions of each block, which blocks begin a text (nothing before them), and which targets exist."""
    keys = first[:, None] + np.arange(-BLOCK, BLOCK)
    return np.clip(keys, 0, len(inputs) - 1), first == low, keys[:, BLOCK:] < high[:, None]


def projected(p: dict, f: Frequencies) -> tuple:
    """What a type is as a query and as a key, by distance and class, and whether exponents of scores and of slots are surely small.

    Queries come with their embedding, keys with their value and a one, which sums the weights of a query.
    """
    q, k, v = (p["emb"] @ p[w] for w in ("wq", "wk", "wv"))
    q *= DIM ** -0.5

    def longest(x: np.ndarray) -> float:
        return float(np.sqrt((x * x).sum(axis=1).max()))
    score = longest(q) * longest(k) + np.abs(p["rel"]).max()
    slot = (longest(v) + longest(p["emb"])) * longest(p["wo"].T) + np.abs(p["bo"]).max()
    return (np.concatenate([q, p["emb"]], axis=1), np.concatenate([k, v, np.ones((TYPES, 1), np.float32)], axis=1),
            p["rel"][np.maximum(_DISTANCE, 0)], f.bigram + p["bo"], score < CALM, slot < CALM)


def forward(p: dict, tables: tuple, types: np.ndarray, classes: np.ndarray, opening: np.ndarray) -> tuple:
    """Unnormalised log probabilities of the slots at each query; ``types``, ``classes``: of keys."""
    queries, keys, rel, bias, calm, _ = tables
    queries, keys = queries.take(types[:, BLOCK:], axis=0), keys.take(types, axis=0)
    share = queries[..., :DIM] @ keys[..., :DIM].swapaxes(1, 2)
    if calm or max(share.max(), -share.min()) + np.abs(rel).max() < CALM:
        np.exp(share, out=share)
        share *= np.exp(rel) * _VISIBLE
        share[opening, :, :BLOCK] = 0
    else:
        share += np.where(_VISIBLE > 0, rel, -1e9)
        share[opening, :, :BLOCK] = -1e9
        share -= share.max(axis=2, keepdims=True)  # a query sees itself at least
        np.exp(share, out=share)
    sums = share @ keys[..., DIM:]
    scale = 1 / sums[..., DIM:]
    mean = sums[..., :DIM] * scale
    h = mean + queries[..., DIM:]
    z = h.reshape(-1, DIM) @ p["wo"]
    z += bias.take(classes[:, BLOCK:].ravel(), axis=0)
    return z, (queries, keys, share, scale, mean, h)


def settle(z: np.ndarray, calm: bool) -> None:
    """Shift rows where exponentials of the slots might not stay finite."""
    if not calm and (z.max() > 80 or z.max(axis=1).min() < -80):
        z -= z.max(axis=1, keepdims=True)


def log_probabilities(p: dict, f: Frequencies, tokens: np.ndarray, doc_start: np.ndarray, start_id: int, batch: int = 32) -> np.ndarray:
    """Log10 probability of every token given those before it in its document."""
    inputs = np.empty_like(tokens)
    inputs[1:] = tokens[:-1]
    inputs[doc_start[:-1][np.diff(doc_start) > 0]] = start_id
    types, classes, slots = f.type(inputs), f.slot(inputs), f.slot(tokens)
    out = np.empty(len(tokens), np.float32)
    first, low, high = block_starts(doc_start)
    tables, ones = projected(p, f), np.ones(HEAD + 1, np.float32)
    for at in range(0, len(first), batch):
        part = slice(at, at + batch)
        keys, opening, real = context(inputs, first[part], low[part], high[part])
        z, _ = forward(p, tables, types[keys], classes[keys], opening)
        targets = keys[:, BLOCK:].ravel()
        settle(z, tables[-1])
        picked = z[np.arange(len(z)), slots[targets]]
        picked -= np.log(np.exp(z, out=z) @ ones)
        own = real.ravel()
        out[targets[own]] = picked[own]
    rest = np.flatnonzero(slots == HEAD)
    out[rest] += f.tail[classes[rest], f.tail_column(tokens[rest])]
    return out / np.float32(np.log(10))


def gradients(p: dict, f: Frequencies, types: np.ndarray, classes: np.ndarray, opening: np.ndarray, slots: np.ndarray,
              real: np.ndarray, at_once: int = 32) -> dict[str, np.ndarray]:
    """Gradients of the mean loss of the real targets, summed over a few blocks at a time, which stay in the processor's cache."""
    tables = projected(p, f)
    weight = (real / max(1, real.sum())).astype(np.float32)
    sums: dict[str, np.ndarray] = {}
    dx = np.empty((*types.shape, DIM), np.float32)
    for at in range(0, len(types), at_once):
        part = slice(at, at + at_once)
        g, dx[part] = some_gradients(p, tables, types[part], classes[part], opening[part], slots[part], weight[part])
        for k, x in g.items():
            sums[k] = sums[k] + x if k in sums else x
    sums["emb"] = np.stack([np.bincount(types.ravel(), dx[..., i].ravel(), TYPES) for i in range(DIM)], axis=1).astype(np.float32)
    return sums


def some_gradients(p: dict, tables: tuple, types: np.ndarray, classes: np.ndarray, opening: np.ndarray, slots: np.ndarray,
                   weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of all but the embeddings for targets of some weight, and of the embedded inputs."""
    z, (queries, keys, share, scale, mean, h) = forward(p, tables, types, classes, opening)
    settle(z, tables[-1])
    e, weight = np.exp(z, out=z), weight.ravel()
    total = e @ np.ones(HEAD + 1, np.float32)
    e[np.arange(len(e)), slots.ravel()] -= total  # by ``weight / total`` the gradient of the slots
    weight = (weight / total)[:, None]
    out = np.concatenate([h.reshape(-1, DIM) * weight, weight], axis=1).T @ e
    dh = e @ p["wo"].T
    dh *= weight
    dh = dh.reshape(h.shape)
    dsums = np.concatenate([dh, -np.einsum("bqd,bqd->bq", dh, mean)[..., None]], axis=2)
    dsums *= scale
    dscore = dsums @ keys[..., DIM:].swapaxes(1, 2)
    dscore *= share
    g = {"wo": out[:DIM], "bo": out[DIM],
         "rel": np.bincount(np.maximum(_DISTANCE, 0).ravel(), dscore.sum(0).ravel(), 2 * BLOCK).astype(np.float32)}
    dq = (dscore @ keys[..., :DIM]).reshape(-1, DIM)
    dq *= DIM ** -0.5
    dkv = np.concatenate([dscore.swapaxes(1, 2) @ queries[..., :DIM], share.swapaxes(1, 2) @ dsums[..., :DIM]], axis=2).reshape(-1, 2 * DIM)
    both = p["emb"].take(types.ravel(), axis=0).T @ dkv
    g["wq"], g["wk"], g["wv"] = queries[..., DIM:].reshape(-1, DIM).T @ dq, both[:, :DIM], both[:, DIM:]
    dx = (dkv @ np.concatenate([p["wk"], p["wv"]], axis=1).T).reshape(*types.shape, DIM)
    dx[:, BLOCK:] += (dq @ p["wq"].T).reshape(dh.shape) + dh
    return g, dx


class Trainer:
    """Adam steps over blocks of token streams."""

    def __init__(self, p: dict[str, np.ndarray], f: Frequencies, rate: float):
        self.p, self.f, self.rate, self.t, self.seen = {k: x.copy() for k, x in p.items()}, f, rate, 0, 0
        self.m = {k: np.zeros_like(x) for k, x in p.items()}
        self.v = {k: np.zeros_like(x) for k, x in p.items()}

    def learn(self, tokens: np.ndarray, doc_start: np.ndarray, start_id: int, chosen: np.ndarray, batch: int = 128) -> None:
        """One step per ``batch`` of the chosen blocks."""
        inputs = np.empty_like(tokens)
        inputs[1:] = tokens[:-1]
        inputs[doc_start[:-1][np.diff(doc_start) > 0]] = start_id
        types, classes, slots = self.f.type(inputs), self.f.slot(inputs), self.f.slot(tokens)
        first, low, high = (x[chosen] for x in block_starts(doc_start))
        for at in range(0, len(first), batch):
            part = slice(at, at + batch)
            keys, opening, real = context(inputs, first[part], low[part], high[part])
            g = gradients(self.p, self.f, types[keys], classes[keys], opening, slots[keys[:, BLOCK:]], real)
            self.t += 1
            self.seen += int(real.sum())
            for k in FIELDS:
                self.m[k] += 0.1 * (g[k] - self.m[k])
                self.v[k] += 0.01 * (g[k] * g[k] - self.v[k])
                self.p[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.99 ** self.t)) + 1e-8)


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in FIELDS]).astype(np.float64)


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, x in start_values().items():
        out[k] = values[at: at + x.size].reshape(x.shape).astype(np.float32)
        at += x.size
    return out
