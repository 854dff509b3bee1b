"""Benchmark decontamination by winnowing, with DataFrame expressions only.

The hash of every k-gram of words is taken and of every ``window - k + 1`` consecutive
hashes the smallest is kept. A span of ``window`` words has the same smallest hash
wherever it stands, so documents and items that share such a span share a kept hash: the
join of the kept hashes finds every document with a hit. In these, hits are extended to
the exact windows: all their ``window``-word spans are compared with the items' word for
word, and overlapping hits are merged. Items of fewer words are one window each; for every
length that occurs among them, documents give all grams of that length as hashes too.

Documents are never moved whole: the first pass leaves a flag per document, the second
reads the flagged ones again. A benchmark of any size works; its hashes and windows are
broadcast only if they measure small, else the joins are shuffled.

Defined results: null, empty or wordless texts have no words and no hits, such items no
windows; a null item_id counts as empty text; repeated items count once, repeated
documents each get their row. Texts of any length are cut into words whole, in one row each.
Empty tables work on both sides; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.llm.common import pick_rows, sized
from sparkscope.runtime import materialize

WINDOW = 10
GRAM = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> Column:
    """Lower-cased (A-Z) words of letters, digits and everything beyond ASCII."""
    value = F.coalesce(F.col(text), F.lit(""))
    plain = F.length(value) == F.octet_length(value)
    lowered = F.when(plain, F.lower(value)).otherwise(F.translate(value, UPPER, LOWER))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def spans(array: Column, length: int, body, kind: str) -> Column:
    """``body(i)`` for every start of ``length`` consecutive elements; none gives an empty array."""
    last = F.size(array) - length
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), body)).otherwise(F.array().cast(f"array<{kind}>"))


def gram_hashes(words: Column, length: int) -> Column:
    return spans(words, length, lambda i: F.xxhash64(F.lit(length), *[words[i + j] for j in range(length)]), "bigint")


def kept_hashes(words: Column, window: int, gram: int, short: list[int]) -> Column:
    """Smallest gram hash of every window, and all grams of the short lengths."""
    width = window - gram + 1
    winnowed = let(gram_hashes(words, gram), lambda g: spans(
        g, width, lambda i: F.least(*[g[i + j] for j in range(width)]) if width > 1 else g[i], "bigint"))
    return F.array_distinct(F.concat(winnowed, *[gram_hashes(words, n) for n in short]))


def window_texts(words: Column, lengths: list[int]) -> Column:
    """(at, text) of every span of each length."""
    def of(length: int) -> Column:
        return spans(words, length, lambda i: F.struct(
            i.alias("at"), F.lit(length).alias("length"),
            F.array_join(F.slice(words, i + 1, length), " ").alias("window")), "struct<at:int,length:int,window:string>")
    return F.concat(*map(of, lengths))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash) for every document.

    ``text_hash`` is the text's ``xxhash64``, null counting as empty, and tells rows of one id apart.
    """
    items = materialize(benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"), F.col(item_text_col).alias("item_text"))
        .withColumn("words", words_of("item_text")).where(F.size("words") > 0)
        .withColumn("length", F.least(F.size("words"), F.lit(window))).select("item_id", "words", "length"), "items")
    short = sorted(row[0] for row in items.where(F.col("length") < window).select("length").distinct().collect())
    own_hashes = F.when(F.col("length") == window, kept_hashes(F.col("words"), window, gram, []))
    for n in short:
        own_hashes = own_hashes.when(F.col("length") == n, gram_hashes(F.col("words"), n))
    item_hashes = sized(materialize(items.select(F.explode(own_hashes).alias("hash")).distinct()
                                    .withColumn("found", F.lit(True)), "item-hashes"))
    own_windows = F.filter(window_texts(F.col("words"), [window, *short]), lambda x: x["length"] == F.col("length"))
    item_windows = materialize(items.select("item_id", F.explode(own_windows).alias("w"))
                               .select("item_id", "w.window").distinct(), "item-windows")
    windows = sized(materialize(item_windows.select("window").distinct(), "windows"))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    kept = rows.select(
        "doc_id", "text_hash", F.monotonically_increasing_id().alias("row"),
        let(words_of("text"), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"),
                                                 kept_hashes(w, window, gram, short).alias("hashes"))).alias("own"))
    flagged = materialize(
        kept.select("doc_id", "text_hash", "row", F.col("own.n_words").alias("n_words"),
                    F.explode_outer("own.hashes").alias("hash"))
        .join(item_hashes, "hash", "left").groupBy("row", "doc_id", "text_hash", "n_words")
        .agg(F.coalesce(F.max("found"), F.lit(False)).alias("suspect")), "flagged")

    key = ["doc_id", "text_hash"]
    hits = materialize(
        pick_rows(rows, flagged.where("suspect").select(key), key)
        .select(*key, F.explode(let(words_of("text"), lambda w: window_texts(w, [window, *short]))).alias("w"))
        .select(*key, "w.at", "w.length", "w.window").join(windows, "window"), "hits")
    spans_of = F.sort_array(F.collect_set(F.struct(F.col("at").alias("low"), (F.col("at") + F.col("length")).alias("high"))))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["high"] - F.greatest(x["low"], a["end"]))).alias("n"),
                              F.greatest(a["end"], x["high"]).alias("end")), lambda a: a["n"])
    hit_words = hits.groupBy(key).agg(spans_of.alias("spans")).select(*key, covered.alias("n_hit"))
    found_items = (hits.select(*key, "window").distinct().join(item_windows, "window").select(*key, "item_id").distinct()
                   .groupBy(key).agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
                   .select(*key, F.size("ids").cast("bigint").alias("n_items"), F.array_join("ids", ",").alias("ids")))
    results = hit_words.join(found_items, [hit_words[c].eqNullSafe(found_items[c]) for c in key]).select(
        *[hit_words[c].alias(f"hit_{c}") for c in key], "n_hit", "n_items", "ids")
    results = sized(materialize(results, "contaminated"))
    joined = flagged.join(results, [F.col(c).eqNullSafe(F.col(f"hit_{c}")) for c in key], "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"), "text_hash")
