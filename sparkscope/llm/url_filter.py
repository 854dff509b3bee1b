"""URL filter: rules first, then a ratio of character language models.

URLs that a rule decides teach two variable-order Markov models of bytes, one of accepted
and one of rejected URLs. A byte is predicted from the longest preceding context that the
model keeps, smoothed by all shorter ones (Witten-Bell): with n occurrences of a context of
which k are followed by T kept bytes, P(s) = (n(s) + (n - k + T) P_shorter(s)) / (n + T),
down to the uniform distribution. A URL's score is the difference of its two
log-likelihoods, divided by its length. A quarter of the decided URLs (by hash of the URL)
is not learnt from; on these the threshold with the least balanced error is chosen.

The counts are summed in each task before the shuffle. A string of bytes is kept if it makes
up ``min_share`` of all positions, so a model has at most ``(order + 1) / min_share``
entries, whatever the input: that is the bound of what is broadcast. Scores are written
once; the threshold comes from counts per bin of 1/1000.

Defined results. Null URLs and those without ``://`` have an empty host and path; null
counts as the empty URL, whose score is that of its end. A port or user belongs to the host.
Of rules of equal length the one with the longer host wins, then block. Without an accepted
or without a rejected URL to learn from, all scores are 0; without one of each to calibrate
on the threshold is 0; a score at the threshold is allowed. Repeated rows count as often as
they occur. Very long URLs are handled whole, an empty table gives no rows, other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.llm.common import ship
from sparkscope.llm.decontaminate import LOWER, UPPER
from sparkscope.llm.textkit import blocks, text_values
from sparkscope.runtime import materialize

#: (verdict, host, path); a rule fits its host and all subdomains.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 5
MIN_SHARE = 1e-5
HELD_OUT = 4
BINS = 1000
#: Symbols are bytes + 1, the end and the filling before the start; nine bits each.
END, START, BITS = 257, 258, 9


# --- rules --------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substr(text, at + 3)).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ordered]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


# --- models -------------------------------------------------------------------------

def symbols(urls: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All URLs behind each other, each led by ``order`` fillings; places of predicted symbols and their URL."""
    lengths = np.array([len(x) + 1 for x in urls], np.int64)
    begin = np.cumsum(lengths + order) - lengths  # place of each first predicted symbol
    sequence = np.full(int((lengths + order).sum()), START, np.int64)
    owner = np.repeat(np.arange(len(urls)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(begin, lengths)
    ends = begin + lengths - 1
    body = np.ones(len(place), bool)
    body[np.cumsum(lengths) - 1] = False
    sequence[place[body]] = np.frombuffer(b"".join(urls), np.uint8).astype(np.int64) + 1
    sequence[ends] = END
    return sequence, place, owner


def grams(sequence: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` symbols before each place and the one there, as one number."""
    out = np.zeros(len(place), np.int64)
    for back in range(k, -1, -1):
        out = (out << BITS) | sequence[place - back]
    return out


def counted(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """(accepted, k, gram, n) of each block of URLs."""
    for batch in batches:
        urls, accepted = text_values(batch.column("url")), batch.column("accepted").to_numpy(zero_copy_only=False).astype(bool)
        for low, high in blocks(urls):
            sequence, place, owner = symbols(urls[low:high], order)
            kind = accepted[low:high][owner]
            for own in (False, True):
                for k in range(order + 1):
                    values, n = np.unique(grams(sequence, place[kind == own], k), return_counts=True)
                    size = len(values)
                    yield pa.record_batch([pa.array(np.full(size, own)), pa.array(np.full(size, k, np.int32)), pa.array(values),
                                           pa.array(n.astype(np.int64))], ["accepted", "k", "gram", "n"])


class Markov:
    """Kept strings of one kind of URLs: for every order sorted grams with counts, contexts with totals and escapes."""

    def __init__(self, rows: dict[str, np.ndarray], order: int):
        self.levels = []
        for k in range(order + 1):
            own = rows["k"] == k
            gram, n, all_n, kept_n, kinds = (rows[c][own] for c in ("gram", "n", "all_n", "kept_n", "kinds"))
            turn = np.argsort(gram)
            gram, n = gram[turn], n[turn]
            context, first = np.unique(gram >> BITS, return_index=True)
            all_n, kept_n, kinds = (x[turn][first] for x in (all_n, kept_n, kinds))
            self.levels.append((gram, n, context, (all_n + kinds).astype(float), (all_n - kept_n + kinds).astype(float)))

    @staticmethod
    def find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(sorted_values, wanted), max(0, len(sorted_values) - 1))
        return at, (sorted_values[at] == wanted if len(sorted_values) else np.zeros(len(wanted), bool))

    def log_probabilities(self, by_order: list[np.ndarray]) -> np.ndarray:
        p = np.full(len(by_order[0]), 1 / END)
        for wanted, (gram, n, context, whole, escape) in zip(by_order, self.levels, strict=True):
            at, known = self.find(context, wanted >> BITS)
            if known.any():
                place, seen = self.find(gram, wanted)
                own = np.where(seen, n[place], 0) if len(gram) else 0
                p = np.where(known, (own + escape[at] * p) / whole[at], p)
        return np.log(p)


def learnt(decided: DataFrame, order: int, min_share: float) -> dict[str, np.ndarray] | None:
    """Rows of both models, or None if one kind of URL does not occur. ``decided``: url, accepted."""
    counts = materialize(decided.mapInArrow(lambda b: counted(b, order), "accepted boolean, k int, gram bigint, n bigint")
                         .groupBy("accepted", "k", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = {r.accepted: r.n for r in counts.where("k = 0").groupBy("accepted").agg(F.sum("n").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    kept = (counts.groupBy("k", "gram").agg(F.sum("n").alias("both")).where(F.col("both") >= min_share * sum(sizes.values()))
            .select("k", "gram", F.lit(True).alias("kept")))
    marked = counts.join(kept, ["k", "gram"], "left").withColumn("context", F.shiftright("gram", BITS))
    totals = marked.groupBy("accepted", "k", "context").agg(
        F.sum("n").alias("all_n"), F.sum(F.when(F.col("kept"), F.col("n"))).alias("kept_n"), F.count("kept").alias("kinds"))
    rows = marked.where("kept").join(totals, ["accepted", "k", "context"]).select(
        "accepted", "k", "gram", "n", "all_n", "kept_n", "kinds").toArrow()
    return {c: rows[c].to_numpy() for c in rows.column_names}


def scored(batches: Iterator[pa.RecordBatch], models: tuple[Markov, Markov] | None, order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        urls, parts = text_values(batch.column("url")), []
        for low, high in blocks(urls):
            if models is None:
                parts.append(np.zeros(high - low))
                continue
            sequence, place, owner = symbols(urls[low:high], order)
            by_order = [grams(sequence, place, k) for k in range(order + 1)]
            total = [np.bincount(owner, m.log_probabilities(by_order), high - low) for m in models]
            parts.append((total[0] - total[1]) / np.bincount(owner, minlength=high - low))
        score = np.round(np.concatenate(parts), 6) + 0.0 if parts else np.zeros(0)
        names = [x for x in batch.schema.names if x != "url"]
        yield pa.record_batch([*(batch.column(x) for x in names), pa.array(score)], [*names, "score"])


def threshold(bins: Sequence[tuple[int, bool, int]]) -> int:
    """The bin from which URLs are allowed: least balanced error, then nearest to zero, then the least."""
    accepted, rejected = (sum(n for _, kind, n in bins if kind == own) for own in (True, False))
    if not accepted or not rejected:
        return 0
    by_bin: dict[int, list[int]] = {}
    for at, kind, n in bins:
        by_bin.setdefault(at, [0, 0])[kind] += n
    # Between two bins that occur every threshold errs alike; of these the one nearest to zero is tried.
    places = sorted(by_bin)
    tried = [min(0, places[0]), *(min(max(0, low + 1), high) for low, high in zip(places, places[1:])), max(0, places[-1] + 1)]
    found, missed, passed = [], 0, rejected
    for cut, at in zip(tried, [*places, places[-1]]):
        found.append((missed * rejected + passed * accepted, abs(cut), cut))
        missed, passed = missed + by_bin[at][1], passed - by_bin[at][0]
    return min(found)[2]


# --- the filter ---------------------------------------------------------------------

def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, order: int = ORDER, min_share: float = MIN_SHARE,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score): ``score`` is the models' difference less the threshold."""
    ship(pages.sparkSession)
    id_type = pages.schema[id_col].dataType.simpleString()
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = parsed.withColumn("by", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("by.rule").alias("rule"), (F.col("by.verdict") == "allow").alias("accepted"),
        (F.conv(F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 8), 16, 10).cast("bigint") % HELD_OUT == 0).alias("held_out"),
        F.col("url").cast("binary").alias("url"))
    rows = learnt(ruled.where("accepted is not null and not held_out").select("url", "accepted"), order, min_share)
    models = None
    if rows is not None:
        models = tuple(Markov({c: x[rows["accepted"] == kind] for c, x in rows.items()}, order) for kind in (True, False))
    sent = pages.sparkSession.sparkContext.broadcast(models)
    table = materialize(ruled.mapInArrow(
        lambda batches: scored(batches, sent.value, order),
        f"page_id {id_type}, host string, path string, rule string, accepted boolean, held_out boolean, score double"), "scored")
    at = F.floor(F.col("score") * BINS).cast("bigint")
    bins = table.where("accepted is not null and held_out").groupBy(at.alias("at"), "accepted").count().collect()
    cut = threshold([tuple(x) for x in bins])
    allowed = F.coalesce("accepted", at >= cut)
    return table.select("page_id", "host", "path", "rule", F.when(allowed, "allow").otherwise("block").alias("verdict"),
                        F.round(F.col("score") - cut / BINS, 6).alias("score"))
