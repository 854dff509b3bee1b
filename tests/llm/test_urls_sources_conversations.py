"""URL filter, source audit and conversation repair against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from sparkscope.llm import conversations, source_audit, url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# --- conversations ------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, hash bigint, kind int, first boolean, n bigint"
STATE = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NEXT = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield from [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def repair(rows):
    """Least (cost, audit) by a walk over all states with plain strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {(0, 0): (0, "", "")}  # (rows done, state): cost, audit, lines
    for i in range(len(rows) + 1):
        for _ in range(2):
            for s in range(4):
                if (i, s) in best:
                    cost, audit, lines = best[i, s]
                    to = (i, STATE[s][NEXT[s][0]])
                    best[to] = min(best.get(to, (math.inf,)), (cost + 3, audit + "I", lines + f"\n{NEXT[s]}:"))
        if i == len(rows):
            break
        _, role, text = rows[i]
        for s in range(4):
            if (i, s) not in best:
                continue
            cost, audit, lines = best[i, s]
            ways = [(s, 4, "D", "")]
            if faults[i] in ("", "t"):
                stays = 3 * (faults[i] == "t")
                if role[:1] in STATE[s]:
                    ways.append((STATE[s][role[:1]], stays, "K", f"\n{role}:{text}"))
                ways.append((STATE[s][NEXT[s][0]], 3 + stays, "R", f"\n{NEXT[s]}:{text}"))
            for t, c, letter, line in ways:
                best[i + 1, t] = min(best.get((i + 1, t), (math.inf,)), (cost + c, audit + letter, lines + line))
    cost, audit, lines = min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(x) for x in "bdt"), illegal, cost, audit, hashlib.sha256(lines[1:].encode()).hexdigest())


def talk(seed, conversations=60, longest=12):
    rng, rows = random.Random(seed), []
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "s", "alien"]
    texts = ["Yes.", "No!", "Well", "Why?", "So. \n", "", " \t", None, "é…", "Yes.", "a:b.", ". x"] + [f"line {i}." for i in range(9)]
    for conv in range(conversations):
        for i in range(rng.randrange(1, longest)):
            turn = rng.choice([i, i, i, i + rng.randrange(3), None])
            role = ("user", "assistant")[i % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((None if conv == 7 else conv, turn, role, rng.choice(texts)))
    return rows + rows[:20]


def asked(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, 1, 2, True, 3) for r in rows], TURNS).repartition(5)
    out = conversations.repair_conversations(frame, **settings).collect()
    assert len(out) == len({r[0] for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in out}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair(spark, seed):
    rows = talk(seed)
    got = asked(spark, rows)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    assert got == {c: repair(list(damaged(own))) for c, own in by.items()}


@pytest.mark.parametrize("roles", [["user", "assistant"], ["user"], ["tool"], ["user", "assistant", "system", "tool"]])
def test_repair_of_a_long_conversation(spark, roles):
    rng = random.Random(4)
    rows = [(1, i, rng.choice(roles), f"{'x' * (20000 if i == 50 else 1)}{i}" + rng.choice([".", ".", ""])) for i in range(401)]
    got = asked(spark, rows, damage=False)
    assert got == {1: repair([r[1:] for r in rows])}


def test_repair_of_dropped_and_missing_rows(spark):
    dropped = next(i for i in range(999) if zlib.crc32(f"{i}:5".encode()) % 20 == 0)
    got = asked(spark, [(dropped, 5, "user", "Hello.")])
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert asked(spark, []) == {}


def test_weights_of_settled_letters():
    """Settling between any two rows changes nothing."""
    rng = random.Random(8)
    for _ in range(200):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(1, 25))]
        once, often, letters = conversations.Paths(), conversations.Paths(), ""
        once.widen(3 * len(rows))
        for row in rows:
            once.row(*row)
            often.widen(3)
            often.row(*row)
            if rng.random() < 0.5:
                letters += often.settle()
        assert (letters + often.finish(), often.settled_cost) == (once.finish(), once.settled_cost)


# --- source audit -------------------------------------------------------------------

DOCS = "doc_id bigint, text string, lang string, source string, term string, n bigint, docs bigint, tile int, value bigint"


def audit(rows, min_docs, top):
    terms = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))))
             for text, lang, source in rows]
    out = []
    for lang in {x[0] for x in terms}:
        docs = Counter(t for own, _, c in terms if own == lang for t in c)
        kept = [t for t, n in docs.items() if n >= min_docs]
        groups = defaultdict(Counter)
        for own, source, c in terms:
            if own == lang:
                groups[source].update(c)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))

        def apart(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            pairs = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            typical = [(-apart(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(typical)[:top])):
                out += [(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(found, 1)]
    return Counter(out)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] + ["É", "é", "ÜBER", "Über", "naïve", "日本"]
    rows = []
    for i in range(400):
        source = rng.choice(["s0"] * 8 + [f"s{j}" for j in range(40)] + [None, "", "é"])
        own = words[hash_of(source) % 60:][:60]
        rows.append((" ".join(rng.choice(own) + rng.choice(["", "1", "-X"]) for _ in range(rng.randrange(0, 25))),
                     rng.choice(["en", "en", "de", None]), source))
    rows += [(None, "en", "s1"), ("", "xx", "only"), ("Rare words", "yy", "a"), ("other", "yy", "b"), ("", "yy", None)]
    return rows + rows[:30] + [(" ".join(rng.choice(words) for _ in range(6000)), "de", "s3")]


def hash_of(source):
    return zlib.crc32((source or "").encode())


@pytest.mark.parametrize("settings", [{}, {"columns": 16, "rows": 7}, {"columns": 130, "rows": 20}])
def test_source_divergence(spark, spoken, settings):
    frame = spark.createDataFrame([(i, *r, "t", 1, 2, 3, 4) for i, r in enumerate(spoken)], DOCS).repartition(4)
    got = Counter(tuple(r) for r in source_audit.source_divergence(frame, min_docs=6, top_terms=5, **settings).collect())
    assert got == audit(spoken, 6, 5)


def test_source_divergence_of_nothing(spark):
    assert source_audit.source_divergence(spark.createDataFrame([], DOCS)).count() == 0


def test_trees_price_uniform_quadrants(monkeypatch):
    """A sparse matrix is compared at its filled leaves only."""
    import numpy as np

    rng = np.random.default_rng(1)
    rows, columns = 64, 1024
    tiles = []
    for _ in range(2):
        row, column = rng.integers(0, rows, 30), rng.integers(0, 128, 30)
        tiles.append(source_audit.Tile(rng.integers(1, 50, rows), row, column, rng.integers(1000, 9000, 30), (rows, columns)))
    looked = []
    apart = source_audit.apart
    monkeypatch.setattr(source_audit, "apart", lambda p, q: looked.append(np.broadcast(p, q).size) or apart(p, q))
    got = source_audit.compare(*tiles, columns)
    assert (got == apart(tiles[0].p[:, None], tiles[1].p[None]).sum(2)).all()
    assert sum(looked) <= rows * rows * (128 + 1)


# --- URL filter ---------------------------------------------------------------------

PAGES = "page_id bigint, url string, host string, rule string, score double, accepted boolean, gram bigint, n bigint"


def sample_urls(seed=6, n=900):
    rng = random.Random(seed)
    hosts = ["news.example.org", "EXAMPLE.org", "shop.example.com", "cheap.pills.com", "x.net", "é.net", "org", "a.b.example.org", "notexample.org"]
    paths = ["", "/", "/es/1", "/en/1x", "/en/2", "/fr/7", "/de/7", "/deals/pills", "/fr", "/%C3%A9?q=1", "/a?b#c", "#top", "?x=/es/"]
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.randrange(50)}" for _ in range(n)]
    return urls + [None, "", "no scheme", "://", "http://", "http://u@example.org:80/es/", "a://b://c", "http://x.net/\n/y", "http://x.net/" + "z" * 5000,
                   *urls[:40]]


def parts(url):
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0] if "://" in url else ""


def decided(url):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def held(url):
    return int(hashlib.md5(url.encode()).hexdigest()[:8], 16) % 4 == 0


def brute(urls, order, min_share):
    grams = {True: Counter(), False: Counter()}

    def steps(url):
        sequence = ["^"] * order + list(url.encode()) + ["$"]
        for i in range(order, len(sequence)):
            yield [tuple(sequence[i - k: i + 1]) for k in range(order + 1)]

    for url in urls:
        verdict = decided(url)[1]
        if verdict and not held(url):
            for step in steps(url):
                grams[verdict == "allow"].update(step)
    size = sum(n for c in grams.values() for g, n in c.items() if len(g) == 1)
    kept = {g for g in [*grams[True], *grams[False]] if grams[True][g] + grams[False][g] >= min_share * size}
    models = {}
    for kind, counts in grams.items():
        totals = defaultdict(lambda: [0, 0, 0])
        for g, n in counts.items():
            t = totals[g[:-1], len(g)]
            t[0] += n
            if g in kept:
                t[1] += n
                t[2] += 1
        models[kind] = totals

    def log_likelihood(url, kind):
        total = 0.0
        for step in steps(url):
            p = 1 / 257
            for g in step:
                n, k, kinds = models[kind].get((g[:-1], len(g)), (0, 0, 0))
                if kinds:
                    p = ((grams[kind][g] if g in kept else 0) + (n - k + kinds) * p) / (n + kinds)
            total += math.log(p)
        return total

    score = {u: round((log_likelihood(u, True) - log_likelihood(u, False)) / (len(u.encode()) + 1), 6) for u in set(urls)}
    known = [(math.floor(score[u] * 1000), decided(u)[1] == "allow") for u in urls if decided(u)[1] and held(u)]
    good, bad = sum(k for _, k in known), sum(not k for _, k in known)
    cuts = range(min(0, *(b for b, _ in known)), max(0, *(b for b, _ in known)) + 2)
    cut = min((sum(b < c for b, k in known if k) * bad + sum(b >= c for b, k in known if not k) * good, abs(c), c) for c in cuts)[2]
    return {u: (round(score[u] - cut / 1000, 6), math.floor(score[u] * 1000) >= cut) for u in score}


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "r", 0.5, True, 1, 2) for i, u in enumerate(urls)], PAGES).repartition(4)


@pytest.mark.parametrize("order, min_share", [(5, 1e-5), (3, 0.002)])
def test_filter_urls(spark, order, min_share):
    urls = sample_urls()
    want = brute([u or "" for u in urls], order, min_share)
    got = url_filter.filter_urls(pages(spark, urls), order=order, min_share=min_share).collect()
    assert sorted(r.page_id for r in got) == list(range(len(urls)))
    for r in got:
        url = urls[r.page_id] or ""
        rule, verdict = decided(url)
        score, allowed = want[url]
        assert (r.host, r.path) == parts(url) and r.rule == rule, url
        assert r.score == pytest.approx(score, abs=2e-6)
        assert r.verdict == (verdict or ("allow" if allowed else "block")), url


def test_filter_learns_what_rules_decide(spark):
    """URLs without a rule that look like blocked ones are blocked."""
    rng = random.Random(1)
    good = [f"http://example.org/story-{rng.randrange(999)}/news" for _ in range(300)]
    bad = [f"http://example.org/es/casino-{rng.randrange(999)}-bonus" for _ in range(300)]
    new = [f"http://other.net/{x}" for x in ("story-12/news", "es/casino-5-bonus", "story-8/news", "es/casino-77-bonus")]
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages(spark, good + bad + new)).collect()}
    assert [got[600 + i] for i in range(4)] == ["allow", "block", "allow", "block"]


def test_filter_without_one_kind(spark):
    got = url_filter.filter_urls(pages(spark, ["http://a.org/x", "http://b.net/", None])).collect()
    assert sorted((r.page_id, r.rule, r.verdict, r.score) for r in got) == [
        (0, "org/", "allow", 0.0), (1, None, "allow", 0.0), (2, None, "allow", 0.0)]
    assert url_filter.filter_urls(pages(spark, [])).count() == 0
