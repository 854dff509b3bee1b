"""Every corpus operator against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkscope.llm import decontaminate, exact_dedup, gru, importance, jaccard_join, license_scan, lm_score, mixing, pii, token_scan, toxicity
from sparkscope.llm.common import components
from sparkscope.llm.textkit import Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, size bigint, score double, part int, row bigint"


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def sample_texts(seed=5, n=160):
    """Prose of few words, with copies, near copies, blanks, nulls, a long text and personal data."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "the", "The", "x@y.example.com", "10.1.2.3", "ñandú"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 12, 30, 80]))) for _ in range(n)]
    for i in range(0, n, 8):
        texts.append(texts[i].upper() if i % 16 else texts[i])
        parts = texts[i].split()
        parts[rng.randrange(len(parts))] = "changed"
        texts.append("  ".join(parts))
    texts += [None, None, "", " \n\t", "one", "ONE", "two words", "a b c", "x" * 5000, " ".join(rng.choice(words) for _ in range(9000)),
              " nbsp word em", "\U0001f600 smile \U0001f600"]
    return texts


def table(spark, texts, ids=None, partitions=5):
    rows = [(i if ids is None else ids[i], t, None if i % 7 == 0 else "en", None if i % 11 == 0 else f"s{i % 5 if i % 3 else 0}",
             None, 1, 2, 0.5, 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


@pytest.fixture(scope="module")
def texts():
    return sample_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- exact dedup -----------------------------------------------------------------

@pytest.mark.parametrize("settings", [{}, {"hashes_per_owner": 3, "spare_bits": 0}])
def test_exact_duplicates(docs, texts, settings):
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[(t or "").translate(LOWER)].append(i)
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs, **settings).collect()}
    assert len(got) == len(texts)
    for text, ids in groups.items():
        for i in ids:
            want = (max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == want


def test_exact_duplicates_of_repeated_rows_and_null_ids(spark, nothing):
    rows = table(spark, ["a", "A", "a", "b", "b", None], [1, 1, None, None, None, 7])
    got = exact_dedup.exact_duplicates(rows).collect()
    assert sorted((r.keep_id or 0, r.group_size) for r in got) == [(0, 2), (0, 2), (1, 3), (1, 3), (1, 3), (7, 1)]
    assert sum(r.kept for r in got) == 3
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_rice_coding_round_trip():
    rng = np.random.default_rng(0)
    for n, span in [(0, 10), (1, 1), (5, 5), (1000, 1 << 40), (500, 600)]:
        values = np.sort(rng.choice(span, n, replace=False) if span < 1 << 20 else np.unique(rng.integers(0, span, n))).astype(np.uint64)
        assert np.array_equal(exact_dedup.rice_decode(len(values), *exact_dedup.rice_encode(values, span)), values)


# --- n-gram Jaccard join ---------------------------------------------------------

def brute_components(texts, words, num, den):
    sets = []
    for t in texts:
        w = spaced(t)
        sets.append({tuple(w[i: i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("words,num,den", [(3, 90, 100), (5, 80, 100), (1, 60, 100)])
def test_jaccard_components(docs, texts, words, num, den):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, words, num, den).collect()}
    assert got == brute_components(texts, words, num, den)


def test_jaccard_chain_of_near_copies(spark, nothing):
    """A star's rim that only links among itself, and chains, need the second comparison."""
    rng = random.Random(2)
    base = [f"t{i}" for i in range(60)]
    chain = []
    for i in range(60):
        base = base[:]
        base[rng.randrange(60)] = f"n{i}"
        chain.append(" ".join(base))
    rng.shuffle(chain)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(table(spark, chain)).collect()}
    assert got == brute_components(chain, 3, 90, 100)
    assert jaccard_join.jaccard_components(nothing).count() == 0
    repeated = table(spark, ["a b c d", "A b c d", None, "a b c d"], [5, 3, None, 3])
    assert sorted((r.n_shingles, r.component_id or 0) for r in jaccard_join.jaccard_components(repeated).collect()) == [(0, 0), (2, 3), (2, 3), (2, 3)]


def test_piece_keys_meet():
    """Sets at the limit of the similarity always share a key, in whatever band they fall."""
    rng = np.random.default_rng(4)
    for size in [1, 3, 9, 10, 11, 18, 19, 20, 40, 95, 200, 371]:
        for _ in range(30):
            own = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            changed = own[: size - size // 19].copy()  # |A ∩ B| / |A ∪ B| >= 0.9 for |B| = |A| - size // 19
            if 100 * len(changed) < 90 * size:
                continue
            doc = np.repeat([0, 1], [size, len(changed)])
            d, k = jaccard_join.piece_keys(doc, np.concatenate([own, changed]), np.array([size, len(changed)]), 90, 100)
            assert set(k[d == 0]) & set(k[d == 1]), size


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100)])
def test_piece_keys_meet_across_blocks(num, den):
    """Linked sets on both sides of every band border share a key, whatever else is in their blocks."""
    rng = np.random.default_rng(6)

    def keys(own, *beside):
        sets = [own, *(rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in beside)]
        sizes = np.array([len(x) for x in sets])
        d, k = jaccard_join.piece_keys(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), sizes, num, den)
        return set(k[d == 0])

    limits = jaccard_join.band_limits(num, den, 3000)
    for top in range(1, 3000):
        few = jaccard_join.band_limits(num, den, top)
        assert few[-2] >= top and np.array_equal(few, limits[: len(few)]), top
    for limit in limits[:-2].tolist():
        for size in {limit, limit - limit // 20} - {0}:
            larger = rng.integers(0, 1 << 63, size * den // num, dtype=np.uint64)
            for beside in ((), (2 * limit,), (9 * limit,)):
                assert keys(larger[:size]) & keys(larger, *beside), (size, beside)
                assert keys(larger[:size], *beside) & keys(larger), (size, beside)


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


# --- benchmark decontamination ---------------------------------------------------

def brute_contamination(texts, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i: i + 10])].add("" if item is None else str(item))
    out = {}
    for d, t in enumerate(texts):
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(w[i: i + n])]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(ids), digest, bool(hit))
    return out


def contaminated(rows):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows.collect()}


def test_contamination(spark, docs, texts):
    long = next(t for t in texts if t and len(t.split()) == 9000).split()
    items = [(1, " ".join(long[50:75])), (12, "Tw-o, Words"), (3, "two. WORDS"), (4, None), (5, "--"), (6, " ".join(long[60:70])),
             (7, "w1 w2"), (None, "w3 W4 w5 "), (1, " ".join(long[50:75])), (9, "the " * 14), (10, "nowhere " * 12)]
    table_of = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    assert contaminated(decontaminate.contamination(docs, table_of)) == brute_contamination(texts, items)


def test_contamination_of_empty_tables(spark, docs, texts, nothing):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contaminated(decontaminate.contamination(docs, none)) == brute_contamination(texts, [])
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate.contamination(nothing, some).count() == 0
    repeated = decontaminate.contamination(table(spark, ["a b", "a b", "A. b c"], [1, 1, None]), some)
    assert [(r.n_words, r.n_hit) for r in repeated.orderBy("n_words").collect()] == [(2, 2), (2, 2), (3, 2)]


# --- mixing ----------------------------------------------------------------------

def test_mix(spark, docs, texts):
    rows = mixing.mix_sources(docs, block_words=4, shard_words=2000).collect()
    sizes = {i: len(spaced(t)) for i, t in enumerate(texts)}
    assert {r.doc_id: r.size for r in rows} == sizes
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    total = sum(sizes.values())
    room = {s: 2 * sum(r.size for r in own) for s, own in by.items()}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by, key=lambda s: (s is None, s or "")))}
    target, full = {}, set()
    while True:
        left = 1.5 * total - sum(room[s] for s in full)
        level = left / sum(weight[s] for s in by if s not in full)
        over = {s for s in by if s not in full and weight[s] * level >= room[s]}
        if not over:
            break
        full |= over
    target = {s: room[s] if s in full else weight[s] * level for s in by}
    for s, own in by.items():
        assert all(r.source_size == room[s] // 2 and math.isclose(r.target, target[s]) for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 4 * (2 + len({r.shard for r in own}))
    again = mixing.mix_sources(docs.repartition(3), block_words=4, shard_words=2000).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_of_nothing(spark, nothing):
    assert mixing.mix_sources(nothing).count() == 0
    rows = mixing.mix_sources(table(spark, [None, "", None], [None, None, 4])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 3


def test_apportionment_takes_highest_quotients(spark):
    rng = random.Random(6)
    for seats in (0, 1, 3, 7, 50, 1234):
        weights = [rng.choice([0, 1, 1, 5, 40, 1000]) * rng.random() for _ in range(17)] + [2.0, 2.0]
        parts = spark.createDataFrame([(i, w, seats) for i, w in enumerate(weights)], "key int, weight double, seats bigint")
        got = {r.key: r.quota for r in mixing.apportion(parts, [], "key", "weight", "seats").collect()}
        offers = sorted((-w / (2 * k - 1), i) for i, w in enumerate(weights) if w for k in range(1, seats + 1))[:seats]
        assert got == {i: sum(j == i for _, j in offers) for i in range(len(weights))}


# --- toxicity --------------------------------------------------------------------

def test_toxicity_learns_and_keeps_folds_apart(spark, nothing):
    rng = random.Random(1)
    clean, bad = [f"word{i}" for i in range(80)], ["vile", "scummy", "nasty"]
    texts, toxic = [], []
    for i in range(500):
        w = [rng.choice(clean) for _ in range(rng.choice([4, 40, 150]))]
        toxic.append(i % 4 == 0)
        if toxic[-1]:
            w[rng.randrange(len(w))] = rng.choice(bad)
        texts.append(" ".join(w))
    texts += [None, "", " "]
    frame = table(spark, texts)
    labels = spark.createDataFrame([(i, int(y), "de") for i, y in enumerate(toxic)] + [(9999, 1, None), (1, None, None)],
                                   "doc_id bigint, toxic int, lang string")
    rows = {r.doc_id: r for r in toxicity.toxicity_scores(frame, labels).collect()}
    assert len(rows) == len(texts)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    held = [i for i in range(500) if rows[i].held_out]
    right = sum(rows[i].predicted == toxic[i] for i in held)
    assert right >= 0.95 * len(held)
    assert rows[500].score == rows[501].score == rows[502].score < 0.7
    assert toxicity.toxicity_scores(nothing, labels).count() == 0
    for some in (labels.where("toxic = 0"), labels.where("false")):
        assert {r.score for r in toxicity.toxicity_scores(frame.limit(20), some).collect()} == {0.0}


def test_word_hashes_and_log_odds_take_a_block_at_a_time():
    rng = np.random.default_rng(5)
    texts = [b" ".join(b"w%d" % i for i in rng.integers(0, 3000, rng.integers(0, 900))) for _ in range(1200)] + [b"x" * (2 << 20) + b" y"]
    alone = [h for text in texts[:50] + texts[-1:] for h in Words([text]).hashes().tolist()]
    words = Words(texts)
    words.hashes()
    tracemalloc.start()
    hashes = words.hashes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    gru.train(texts[:-1], np.arange(1200) % 2, 1, 1)
    trained = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hashes.tolist()[: words.doc_first[50]] + hashes.tolist()[words.doc_first[-2]:] == alone
    assert peak < 100e6 and trained < 150e6
    index, doc = rng.integers(0, gru.BUCKETS, len(words)), words.doc
    label = np.arange(len(texts)) % 2
    parts = list(gru.document_parts(words, 1000))
    assert np.array_equal(np.concatenate([at for at, _ in parts]), np.arange(len(words))) and len(parts) > 100
    whole = gru.log_odds([(index, doc)], label)
    assert whole.any() and np.array_equal(whole, gru.log_odds(((index[at], own) for at, own in parts), label))


def test_attention_gradients_are_summed_over_blocks():
    from sparkscope.llm import attention
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 300, 2000)
    f = attention.Frequencies(np.arange(250), 400, (np.minimum(tokens[:-1], attention.HEAD), tokens[1:], np.ones(1999, np.int64)))
    first, low, high = attention.block_starts(np.array([0, 700, 700, 701, 2000]))
    keys, opening, real = attention.context(tokens, first, low, high)
    p = attention.start_values()
    given = (p, f, f.type(tokens)[keys], f.slot(tokens)[keys], opening, f.slot(tokens)[keys[:, attention.BLOCK:]], real)
    whole = attention.gradients(*given, at_once=1000)
    assert set(whole) == set(attention.FIELDS)
    for name, x in attention.gradients(*given, at_once=7).items():
        assert np.abs(x).max() > 0 and np.allclose(x, whole[name], rtol=1e-3, atol=1e-6), name


def test_gru_gradients():
    rng = np.random.default_rng(3)
    words = Words([b"a bb ccc a bb", b"dddd a"])
    vocabulary = gru.Vocabulary(words)
    p = {k: x.astype(np.float64) for k, x in gru.start_values(rng).items()}
    inputs = rng.normal(0, 1, (vocabulary.size, gru.WORD_DIM + gru.CHAR_DIM)).astype(np.float32)
    index = np.array([[0, 1, 2, 3], [3, 0, 0, 0]])
    length, label = np.array([4, 1]), np.array([1.0, 0.0])

    def loss():
        out = gru.forward(p, inputs, index, length)[0]
        return np.sum(np.log1p(np.exp(out)) - label * out)
    kept = []
    out, saved = gru.forward(p, inputs, index, length, kept)
    g, _ = gru.backward(p, inputs, kept, saved, gru.sigmoid(out) - label)
    for name in ("wx", "bx", "u", "wa", "ba", "va", "wo", "bo"):
        at = tuple(rng.integers(0, s) for s in p[name].shape)
        was = p[name][at]
        p[name][at] = was + 1e-3
        up = loss()
        p[name][at] = was - 1e-3
        down = loss()
        p[name][at] = was
        assert math.isclose((up - down) / 2e-3, g[name][at], rel_tol=0.05, abs_tol=2e-3), name


def test_windows_cover_every_word():
    words = Words([b" ".join([b"w"] * n) for n in (0, 1, 63, 64, 65, 112, 113, 500)])
    first, length, doc = gru.windows_of(words)
    seen = Counter(int(i) for a, n in zip(first, length, strict=True) for i in range(a, a + n))
    assert set(seen) == set(range(len(words))) and (length <= gru.WINDOW).all() and (words.doc[first] == doc).all()


# --- personal data ---------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])
    keep = [lambda m: True, lambda m: all(int(x) <= 255 for x in m[0].split(".")),
            lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)), lambda m: 10 <= len(digits(m)) <= 15]
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if keep[k](m))


def test_base_spans_of_random_text():
    rng = random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choice("0123456789 -.+@()a_Zé%\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("1" * 30000 + "@" * 3000 + "+1" * 9000) is not None


def test_personal_data(spark, docs, texts, nothing):
    got = {r.doc_id: r for r in pii.span_digest(pii.personal_data(docs)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own = brute_spans(t or "")
        digest = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in own)
        assert got[i].base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == x for _, k, _ in own) for x in range(4)]
    assert pii.span_digest(pii.personal_data(nothing)).count() == 0


def test_revealing_terms_are_masked(spark):
    rng = random.Random(3)
    filler = [f"f{i}" for i in range(40)]

    def around(middle):
        return " ".join(rng.choice(filler) for _ in range(6)) + middle + " ".join(rng.choice(filler) for _ in range(6))
    texts = [around(" Zorblax bob@mail.example.com ") for _ in range(6)] + [around(" ") for _ in range(60)]
    copies = [around(" Quux eve@mail.example.com ")] * 6
    frame = table(spark, texts + copies)
    rows = pii.span_digest(pii.personal_data(frame)).collect()
    assert {r.doc_id for r in rows if "term:" in r.spans} == set(range(6))
    assert all(r.n_term == 1 for r in rows if r.doc_id < 6)
    masked = {r.doc_id: r.text for r in pii.sanitised(frame).collect()}
    assert all("Zorblax" not in masked[i] and "bob@" not in masked[i] for i in range(6))
    assert all(masked[i] == texts[i] for i in range(6, 66)) and "Quux [EMAIL]" in masked[70]


# --- importance resampling -------------------------------------------------------

def test_importance_sample(spark, nothing):
    rng = random.Random(4)
    good, junk = [f"g{i}" for i in range(50)], [f"j{i}" for i in range(50)]
    texts = [" ".join(rng.choice(good if i % 2 else junk) for _ in range(40)) for i in range(300)] + [None, "", None]
    frame = table(spark, texts)
    target = spark.createDataFrame([(i,) for i in range(1, 100, 2)] + [(None,), (12345,)], "doc_id bigint")
    rows = importance.importance_sample(frame, target, share=0.4, buckets=512).collect()
    assert sum(r.selected for r in rows) == round(0.4 * len(texts))
    assert all(r.doc_id % 2 for r in rows if r.selected and r.doc_id < 300)
    assert min(r.value for r in rows if r.selected) >= max(r.value for r in rows if not r.selected)
    again = importance.importance_sample(frame.repartition(2), target, share=0.4, buckets=512).collect()
    assert sorted((r.doc_id, r.selected) for r in rows) == sorted((r.doc_id, r.selected) for r in again)
    assert importance.importance_sample(nothing, target).count() == 0
    tied = importance.importance_sample(table(spark, ["a"] * 9, [3] * 9), target, share=0.5).collect()
    assert sum(r.selected for r in tied) == 4


def test_importance_by_hand(spark):
    texts = ["a b", "a c", "b"]
    rows = importance.importance_sample(table(spark, texts), spark.createDataFrame([(0,)], "doc_id bigint"), buckets=64).collect()
    grams = []
    for t in texts:
        d, b = importance.features(Words([t.encode()]), 64)
        grams.append(b.tolist())
    raw, target = Counter(sum(grams, [])), Counter(grams[0])
    for r in rows:
        want = sum(math.log((target[g] + 1) / (len(grams[0]) + 64)) - math.log((raw[g] + 1) / (sum(raw.values()) + 64)) for g in grams[r.doc_id])
        assert math.isclose(r.log_importance, want, abs_tol=1e-9)


def test_kth_largest(spark):
    rng = random.Random(5)
    values = [rng.choice([0.0, 1.0, -3.5, 1e9, rng.gauss(0, 1)]) for _ in range(2000)]
    frame = spark.createDataFrame([(v,) for v in values], "value double").cache()
    for k in (1, 5, 700, 1999, 2000):
        edge = sorted(values, reverse=True)[k - 1]
        assert importance.kth_largest(frame, k) == (edge, sum(v > edge for v in values))


# --- license scan ----------------------------------------------------------------

def test_license_matches(spark, nothing):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    texts, want = [], {}
    for i in range(200):
        body = [rng.choice(words) for _ in range(rng.choice([0, 5, 50, 400]))]
        if i % 2:
            name, notice = license_scan.NOTICES[i % len(license_scan.NOTICES)]
            at = rng.randint(0, len(body))
            body[at:at] = [notice.upper() if i % 4 == 1 else notice]
            want[i] = name
        texts.append(" ".join(body))
    texts += [None, "", "Licensed under the"]
    rows = license_scan.license_matches(table(spark, texts), license_scan.NOTICES).collect()
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add(r.license)
        assert 0.8 <= r.containment <= 1 and r.first_word < r.last_word
    assert all(name in found[i] for i, name in want.items())
    assert not [i for i in found if i not in want]
    assert license_scan.license_matches(nothing, license_scan.NOTICES).count() == 0
    short = spark.createDataFrame([("x", "a b"), (None, "a b c d"), ("y", None)], "license string, notice string")
    assert license_scan.license_matches(table(spark, ["a b c d"]), short).count() == 0


# --- separator scan --------------------------------------------------------------

@pytest.mark.parametrize("block_tokens,chunk", [(5, 3), (64, 2), (1 << 16, 1024)])
def test_token_files_round_trip(spark, docs, texts, block_tokens, chunk):
    encoding = token_scan.encoder(token_scan.RANKS_FILE)
    files = token_scan.write_token_files(docs, block_tokens=block_tokens)
    got = {r.doc_id: r.n_tokens for r in token_scan.document_tokens(files).collect()}
    assert got == {i: len(encoding.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert token_scan.separator_scan(files, chunk_blocks=chunk).where("not complete").count() == 0


def test_separator_scan_of_random_files(spark, nothing, tmp_path):
    rng = np.random.default_rng(1)
    rows, want, size = [], [], 4
    for file in range(6):
        tokens = rng.choice([7, 1, 2], rng.integers(0, 60), p=[0.2, 0.4, 0.4]).astype("<u2")
        (tmp_path / f"{file}.bin").write_bytes(tokens.tobytes())
        begin, n = 0, 0
        for i in np.append(np.flatnonzero(tokens == 7), len(tokens)):
            if i < len(tokens) or begin < len(tokens):
                want.append((n, begin, int(i) - begin, bool(i < len(tokens))))
            begin, n = int(i) + 1, n + 1
    blocks = token_scan.token_file_blocks(spark, f"{tmp_path}/*.bin", block_tokens=size)
    got = token_scan.separator_scan(blocks, end_id=7, chunk_blocks=2).collect()
    assert sorted((r.document, r.begin, r.n_tokens, r.complete) for r in got) == sorted(want)
    assert token_scan.document_tokens(token_scan.write_token_files(nothing)).count() == 0


# --- language model --------------------------------------------------------------

def test_lm_scores(docs, texts, nothing):
    rows = {r.doc_id: r for r in lm_score.lm_scores(docs, chunk_bytes=3000).collect()}
    assert len(rows) == len(texts)
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))}
    own = {i: [*spaced(t), None] for i, t in enumerate(texts)}
    counts = Counter(w for i, words in own.items() if not held[i] for w in words)
    total, distinct = sum(counts.values()), len(counts)
    for i, words in own.items():
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(words), sum(counts[w] > 0 for w in words), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    long = max(own, key=lambda i: len(own[i]))
    assert rows[long].score > 3 * rows[long].base_score
    assert lm_score.lm_scores(nothing).count() == 0


def test_attention_learns_from_every_training_text_once(spark, docs, texts):
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1).alias("held_out"))
    chunks = rows.mapInArrow(lambda b: lm_score.chunked(b, lm_score.RANKS_FILE, 3000), f"doc_ids array<bigint>, {lm_score.CHUNK_FIELDS}").cache()
    encoding = lm_score.encoder(lm_score.RANKS_FILE)
    want = Counter(np.array([*(i for w in spaced(t) for i in encoding.encode_ordinary(" " + w)), lm_score.END_ID], "<u2").tobytes()
                   for n, t in enumerate(texts) if zlib.crc32(str(n).encode()) % 5 != 1)
    got = Counter()
    for turn in range(lm_score.ROUNDS):
        found = chunks.select("doc_ids", *lm_score.STREAM).mapInArrow(
            lambda b, turn=turn: lm_score.training_texts(b, turn, lm_score.ROUNDS, 4), "replica bigint, place bigint, tokens binary").collect()
        assert {r.replica for r in found} == {0, 1, 2, 3}
        got.update(bytes(r.tokens) for r in found)
    assert got == want
    assert lm_score.attention.BLOCK >= 32 and lm_score.attention.HEAD >= 160


def test_lm_scores_do_not_depend_on_partitioning(spark, texts):
    frame = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, "repeated row")] * 3, "doc_id bigint, text string")
    runs = []
    for parts, size in ((1, 1 << 20), (4, 3000), (32, 9000)):
        got = lm_score.lm_scores(frame.repartition(parts), replica_words=4000, chunk_bytes=size).collect()
        runs.append(sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, round(r.base_score, 6), r.score, r.attention_score) for r in got))
    for other in runs[1:]:
        assert [r[:3] for r in other] == [r[:3] for r in runs[0]]
        assert np.allclose([r[3:] for r in other], [r[3:] for r in runs[0]], rtol=0, atol=1e-3) and len(other) == len(texts) + 3
        assert max(abs(a[3] - b[3]) / a[1] for a, b in zip(other, runs[0])) < 1e-6
    ends = Counter(zlib.crc32(str(i if i % 9 else "").encode()) % 5 != 1 for i in range(len(texts)))[True] + 3 * (zlib.crc32(b"5") % 5 != 1)
    blank = next(r for r in got if r.n_tokens == 1)
    want = math.log10(0.5 * ends / blank.train_tokens + 0.5 * 10 ** blank.attention_score)
    assert math.isclose(blank.score, want, rel_tol=1e-6)


def test_word_counts_travel_packed(docs, texts, monkeypatch):
    written, write = {}, lm_score.materialize

    def seen(df, label="table", partition_by=()):
        written[label] = write(df, label, partition_by)
        return written[label]
    monkeypatch.setattr(lm_score, "materialize", seen)
    assert lm_score.lm_scores(docs, chunk_bytes=3000).count() == len(texts)
    chunks = written["chunks"].count()
    words = len({w for t in texts for w in spaced(t)})
    rows = written["word-counts"].count()
    assert rows < written["chunks"].agg(F.sum("n_words")).first()[0] / 4 and words > chunks
    assert chunks > lm_score.OWNER_CHUNKS and rows <= chunks * -(-chunks // lm_score.OWNER_CHUNKS)  # several owners


def test_words_encoded_together_have_their_own_subwords():
    from sparkscope.llm.textkit import Words
    encoding = lm_score.encoder(lm_score.RANKS_FILE)
    spaces = ["\u0085", "\u00a0", "\u1680", "\u2003", "\u2029", "\u202f", "\u205f", "\u3000", "\x1c", "\u00a0\u00a0"]
    words = [*(w for s in spaces for w in (s, f"a{s}", f"{s}a", f"1{s}b'll", f"{s}{s}x{s}")), "don't", "'s", "12ab", "\u201cq\u201d", "\u00e9t\u00e9", "x", "--", "\u65e5\u672c"]
    raw = [w.encode() for w in words] + [b"\xe2\x82", b"a\xff", b"\xc2", b"\x80b"]
    own = Words([b" ".join(raw[:20]), b"", b" ".join(raw[20:])])
    at = np.arange(len(raw))[::-1].copy()
    lengths, ids = lm_score.subwords_of(encoding, lm_score.word_starts(encoding), own, at)
    alone = [encoding.encode_ordinary(" " + raw[i].decode("utf-8", "replace")) for i in at]
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == alone


def test_subwords_of_a_chunk_are_held_a_part_at_a_time(spark, docs, texts):
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.lit(False).alias("held_out"))
    chunks = rows.coalesce(1).mapInArrow(lambda b: lm_score.chunked(b, lm_score.RANKS_FILE, 1 << 20), f"doc_ids array<bigint>, {lm_score.CHUNK_FIELDS}").toArrow()
    stream = lm_score.Stream(chunks, 0)
    parts = list(stream.parts(500))
    longest = max(stream.sizes)
    assert len(parts) > 3 and all(len(words) <= max(500, longest) for _, words, *_ in parts)
    whole, = stream.parts(1 << 40)
    assert np.array_equal(np.concatenate([x[2] for x in parts]), whole[2]) and np.array_equal(np.concatenate([x[1] for x in parts]), stream.words)
    assert [docs.start for docs, *_ in parts[1:]] == [docs.stop for docs, *_ in parts[:-1]] and parts[-1][0].stop == len(stream.sizes)
    for docs, words, tokens, word_start, doc_words in parts:
        assert word_start[-1] == len(tokens) and doc_words[-1] == len(words) and np.array_equal(np.diff(doc_words), stream.sizes[docs])
        assert np.all(tokens[word_start[doc_words[1:]] - 1] == lm_score.END_ID)


@pytest.mark.parametrize("times", [1, 30, 300])
def test_attention_matches_a_plain_computation_for_weights_of_any_size(times):
    from sparkscope.llm import attention as A
    rng = np.random.default_rng(6)
    f = A.Frequencies(np.arange(200), 250, (rng.integers(0, A.HEAD + 1, 900), rng.integers(0, 200, 900), rng.integers(1, 9, 900)))
    p = A.start_values()
    for name in ("wq", "wo"):
        p[name] *= times
    tokens, starts = rng.integers(0, 250, 140), [0, 75, 140]
    got = A.log_probabilities(p, f, tokens, np.array(starts), 5)
    e = p["emb"].astype(np.float64)
    for low, high in zip(starts, starts[1:], strict=False):
        inputs = np.append(5, tokens[low: high - 1])
        x = e[f.type(inputs)]
        for t in range(high - low):
            context = x[max(0, t // A.BLOCK * A.BLOCK - A.BLOCK): t + 1]
            score = (context @ p["wk"]) @ (x[t] @ p["wq"]) * A.DIM ** -0.5 + p["rel"][:len(context)][::-1]
            share = np.exp(score - score.max())
            z = (share / share.sum() @ (context @ p["wv"]) + x[t]) @ p["wo"] + p["bo"] + f.bigram[f.slot(inputs[t])]
            slot = f.slot(tokens[low + t])
            want = z[slot] - z.max() - np.log(np.exp(z - z.max()).sum())
            if slot == A.HEAD:
                want += f.tail[f.slot(inputs[t]), f.tail_column(tokens[low + t])]
            assert math.isclose(got[low + t], want / math.log(10), rel_tol=1e-3, abs_tol=1e-3)


def test_attention_is_causal_normalised_and_block_free():
    from sparkscope.llm import attention as A
    rng = np.random.default_rng(2)
    size = 300
    order = rng.permutation(size)[:200]
    pairs = (rng.integers(0, A.HEAD + 1, 500), rng.choice(order, 500), rng.integers(1, 9, 500))
    f = A.Frequencies(order, size, pairs)
    p = A.start_values()
    p["wo"] *= 20
    tokens = rng.integers(0, size, 150)
    start = np.array([0, 70, 70, 150])
    logs = A.log_probabilities(p, f, tokens, start, 5, batch=3)
    changed = tokens.copy()
    changed[100:] = rng.integers(0, size, 50)
    assert np.allclose(A.log_probabilities(p, f, changed, start, 5)[:100], logs[:100], atol=1e-5)
    total = 0.0
    for token in range(size):
        tried = tokens.copy()
        tried[40] = token
        total += 10.0 ** A.log_probabilities(p, f, tried, start, 5)[40]
    assert math.isclose(total, 1, rel_tol=1e-3)


def test_attention_gradients():
    from sparkscope.llm import attention as A
    rng = np.random.default_rng(3)
    f = A.Frequencies(np.arange(400), 400, (rng.integers(0, A.HEAD + 1, 99), rng.integers(0, 400, 99), np.ones(99)))
    p = A.start_values()
    tokens, start = rng.integers(0, 400, 50), np.array([0, 50])
    types, classes, slots = f.type(tokens), f.slot(tokens), f.slot(tokens)
    first, low, high = A.block_starts(start)
    keys, opening, real = A.context(tokens, first, low, high)

    def loss():
        z, _ = A.forward(p, A.projected(p, f), types[keys], classes[keys], opening)
        z = z.astype(np.float64)
        picked = z[np.arange(len(z)), slots[keys[:, A.BLOCK:]].ravel()] - np.log(np.exp(z).sum(1))
        return -(picked * real.ravel()).sum() / real.sum()
    g = A.gradients(p, f, types[keys], classes[keys], opening, slots[keys[:, A.BLOCK:]], real)
    for name in A.FIELDS:
        at = np.unravel_index(np.argmax(np.abs(g[name])), p[name].shape)
        was = p[name][at]
        p[name][at] = was + 1e-2
        up = loss()
        p[name][at] = was - 1e-2
        down = loss()
        p[name][at] = was
        assert math.isclose((up - down) / 2e-2, g[name][at], rel_tol=0.05, abs_tol=1e-4), name


def test_columns_of_the_input_may_clash(spark, docs):
    clash = docs.select("doc_id", "text", "source", *[F.lit(1).alias(c) for c in ("keep_id", "component_id", "target", "taken", "words", "hash", "held_out")])
    assert exact_dedup.exact_duplicates(clash).count() == jaccard_join.jaccard_components(clash).count() == mixing.mix_sources(clash).count()


# --- contexts of personal data ---------------------------------------------------------

@pytest.mark.parametrize("gap", [" ", " " * 2000, " -- " * 900])
def test_contexts_reach_words_at_any_distance(gap):
    words = [f"word{i}" for i in range(12)]
    text = gap.join([*words, "x@y.example.com", *reversed(words)])
    found = pii.contexts(text, pii.base_spans(text), 8)
    assert [t["term"] for t in found[0]["terms"]] == [*words[-8:], *reversed(words[-8:])]
    long = "a" * 5000 + " x@y.example.com " + "b" * 5000
    assert [len(t["term"]) for t in pii.contexts(long, pii.base_spans(long), 8)[0]["terms"]] == [5000, 5000]


# --- license containment by brute force -------------------------------------------------

def license_shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
    return [tuple(words[i: i + 3]) for i in range(len(words) - 2)]


def test_license_containment_by_brute_force(spark):
    """Every template with four fifths of its shingles in one passage is found, none with fewer in the whole text."""
    rng = random.Random(12)
    templates = license_scan.NOTICES + license_scan.LICENSES
    filler = [f"f{i}" for i in range(400)]
    texts = []
    for share in (0.6, 0.79, 0.81, 0.9, 1.0):
        for _, notice in templates:
            words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", notice)
            n = len(words) - 2
            kept = words[: math.floor(share * n) + 2] if share < 0.8 else words[: math.ceil(share * n) + 2]
            lead = [rng.choice(filler) for _ in range(rng.randrange(0, 60))]
            texts.append(" ".join([*lead, *kept, *(rng.choice(filler) for _ in range(rng.randrange(0, 60)))]))
    found = {(r.doc_id, r.license) for r in license_scan.license_matches(table(spark, texts), templates).collect()}
    wanted = lost = 0
    for i, text in enumerate(texts):
        own = license_shingles(text)
        for name, notice in templates:
            needed = set(license_shingles(notice))
            if len(needed & set(own)) < 0.8 * len(needed):
                assert (i, name) not in found
                continue
            size = len(license_shingles(notice))
            if any(len(needed & set(own[p: p + size])) >= 0.8 * len(needed) for p in range(max(1, len(own) - size + 1))):
                wanted, lost = wanted + 1, lost + ((i, name) not in found)
    assert wanted > 100 and lost <= 0.005 * wanted


# --- stars verified inside a block ------------------------------------------------------

def test_join_in_block_connects_what_links_do():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = int(rng.integers(2, 14))
        base = rng.integers(1, 1 << 60, 40, dtype=np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(40) < 0.97], rng.integers(1, 1 << 60, int(rng.integers(0, 4)), dtype=np.uint64)]))
                for _ in range(n)]
        doc, values = np.repeat(np.arange(n), [len(x) for x in sets]), np.concatenate(sets)
        pairs = [(a, b) for a in range(n) for b in range(n) if a != b and rng.random() < 0.5] * 2
        lead, other = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
        tree, inside = jaccard_join.join_in_block(lead, other, doc, values, 9, 10)
        group = list(range(n))
        for a, b in pairs:
            both = len(np.intersect1d(sets[a], sets[b]))
            if 10 * both >= 9 * (len(sets[a]) + len(sets[b]) - both):
                group = [group[a] if g == group[b] else g for g in group]
        assert inside.tolist() == [group[a] == group[b] for a, b in pairs]
        linked = list(range(n))
        for (a, b), link in zip(pairs, tree):
            if link:
                assert linked[a] != linked[b]  # no link is told twice or closes a ring
                linked = [linked[a] if g == linked[b] else g for g in linked]
        assert [[linked[a] == linked[b] for b in range(n)] for a in range(n)] == [[group[a] == group[b] for b in range(n)] for a in range(n)]
    tree, inside = jaccard_join.join_in_block(*(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64), 9, 10)
    assert not len(tree) and not len(inside)
