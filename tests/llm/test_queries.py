"""Registered corpus queries against their SQL, and the pipeline on the small tables."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from sparkscope.llm.mixing import mix_sources
from sparkscope.llm.toxicity import toxicity_scores
from sparkscope.llm.queries import QUERIES, SQL
from tests.oracle import duck, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = spark_rows(QUERIES[name](spark, SF))
    if name in SQL:
        assert got == sql_rows(duck(SF), SQL[name])
    else:
        assert sum(got[1].values()) > 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    out = corpus_pipeline.run(spark, SF).collect()
    assert set(r.doc_id for r in out) <= set(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.taken <= 2 * r.size for r in out)


def test_stages_keep_rows_and_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", None, "s", 1), (1, "a b c d e f", None, "s", 1), (2, "A b c d e f", "x", None, None), (None, None, None, None, None),
         (None, "q", None, None, 3), (4, "another text of its own", "en", "t", 5)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.DOCUMENTS, name
    kept = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (0, "q"), (2, "A b c d e f"), (4, "another text of its own")]
    both = spark.createDataFrame([(1, "Aa", None, "s", 1), (1, "aa", None, "s", 1), (1, "other", None, "s", 1)], docs.schema)
    assert [r.text for r in corpus_pipeline.one_of_each_text(spark, both, SF).orderBy("text").collect()] == ["Aa", "other"]
    mixed = dict(corpus_pipeline.STAGES)["mix_sources"](spark, docs, SF)
    assert mixed.count() == 6


# --- the chain against brute force, with missing and repeated ids ------------------------

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def shingles(text, n):
    own = words(text)
    return {tuple(own[i: i + n]) for i in range(max(1, len(own) - n + 1))} if own else set()


def one_of_equal(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").translate(LOWER), []).append(r)
    least = lambda r: tuple((x is not None, x or 0 if not isinstance(x, str) else x) for x in r[1:])
    out = []
    for own in groups.values():
        top = max((r[0] for r in own if r[0] is not None), default=None)
        out.append(min((r for r in own if r[0] == top), key=least))
    return out


def one_of_near(rows):
    sets = [shingles(r[1], corpus_pipeline.NEAR_WORDS) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= corpus_pipeline.NEAR_PERCENT * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for i, r in enumerate(rows):
        key = group[i] if sets[i] else ("alone", i)
        best.setdefault(key, []).append(r)
    return [own for own in best.values()]


def without_items(rows, items):
    term = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for item in items:
        own = words(item, term)
        windows |= {tuple(own[i: i + 10]) for i in range(max(1, len(own) - 9))} if own else set()
    sizes = {len(w) for w in windows}
    return [r for r in rows if not any(tuple(own[i: i + n]) in windows for own in [words(r[1], term)] for n in sizes
                                       for i in range(len(own) - n + 1))]


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(90)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 12, 40, 60]))) for _ in range(70)]
    for t in texts[:25]:
        own = t.split()
        own[rng.randrange(len(own))] = "changed"
        texts += [" ".join(own), t.upper()]
    item = "one two three four five six seven eight nine ten eleven"
    texts += [f"before {item} after", f"x {item}", item.upper(), None, "", " ", "a " * 3000, "bad kill hate " * 9, "BAD hate kill " * 12]
    rows = [(rng.choice([None, i, i, i, i % 40, i % 40]), t, "en", f"s{i % 3}" if i % 9 else None, i) for i, t in enumerate(texts)]
    return rows + rows[::11], [item, "short item here", None, ""]


def test_pipeline_against_brute_force(spark, odd_rows, tmp_path):
    rows, items = odd_rows
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(r[0], 1, int("hate" in (r[1] or "").lower())) for r in rows if r[0] is not None] + [(None, 0, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    scores = toxicity_scores(docs.withColumn("own", docs["text"]), spark.read.parquet(str(tmp_path / "labels.parquet")), carry=["own"]).collect()
    toxic = {r.own for r in scores if r.predicted}
    assert all((r.own in toxic) == bool(r.predicted) for r in scores)  # the text alone decides

    want = one_of_equal([r for r in rows if r[1] not in toxic])
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["exact_dedup"](spark, stages["toxicity"](spark, docs, str(tmp_path)), str(tmp_path))
    assert Counter(tuple(r) for r in kept.collect()) == Counter(want)
    near = stages["jaccard_join"](spark, kept, str(tmp_path)).collect()
    groups = one_of_near(want)
    assert len(near) == len(groups)
    for own in groups:
        chosen = [tuple(r) for r in near if tuple(r) in own]
        least = min((r[0] for r in own if r[0] is not None), default=None)
        assert len(chosen) == 1 and chosen[0][0] == least
    want = without_items([tuple(r) for r in near], items)
    last = spark.createDataFrame([tuple(r) for r in near], SCHEMA)
    left = stages["decontaminate"](spark, last, str(tmp_path))
    assert Counter(tuple(r) for r in left.collect()) == Counter(want)
    mix = Counter((r.doc_id, r.size, r.source) for r in mix_sources(spark.createDataFrame(want, SCHEMA)).collect())
    assert Counter((r.doc_id, r.size, r.source) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == mix


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
