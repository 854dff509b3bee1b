"""Personal data: pattern spans, and the terms around them that give the protected value away.

1. One scan finds emails, IP addresses, card and phone numbers in every text. Around each
   it notes the words within ``reach`` words (the context), outside of any found span.
2. A found value is a protected entity e. Over the corpus, P(e) is its share of documents
   and P(e|t) the share of the documents with term t in which t stands in a context of e.
   The information t gives about e is their pointwise mutual information
   log P(e|t) / P(e), at most the entity's own information -log P(e). The ratio of both is
   the disclosure: 1 if t never occurs without e, 0 if t says nothing.
3. A term seen in ``support`` or more different contexts of e with a disclosure of at least
   ``generalise`` is replaced by its kind of word there, from ``remove`` on it is removed.
   Copies of a passage are one context, so duplication alone makes no evidence.

Document counts of terms cover all texts. Entities, terms and contexts are grouped with
partial counts; no entity's documents are gathered. Only candidate terms of a measured
size are broadcast; beyond it the corpus counts are joined by shuffle.

Defined results: null and empty texts have no spans. Offsets are code points. Contexts are
counted in words, however far apart these are, and texts of any length are searched whole. A
null doc_id is kept as it is, repeated rows each get their row. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkscope.llm.common import ship, sized
from sparkscope.llm.textkit import Words, blocks, text_values
from sparkscope.runtime import BROADCAST_MAX_BYTES, materialize

REACH, SUPPORT = 8, 3
GENERALISE, REMOVE = 0.6, 0.9
KINDS = ("email", "ip", "card", "phone", "term")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){13,}")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Terms: letters, digits and everything beyond ASCII, as in ``TERM_BYTES``.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TERM_BYTES = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part holds no @, so each match belongs to one @ and starts where its run of characters does."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1].isascii() and (text[low - 1].isalnum() or text[low - 1] in "._%+-"):
            low -= 1
        domain = DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            done = domain.end()
            yield low, done
        at = text.find("@", domain.end() if domain else at + 1)


def passes_luhn(digits: str) -> bool:
    odd = [int(x) for x in digits[-1::-2]]
    even = [int(x) * 2 for x in digits[-2::-2]]
    return (sum(odd) + sum(x - 9 if x > 9 else x for x in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every pattern span, in order."""
    found = [(low, 0, high) for low, high in emails(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text)
              if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if len(digits) <= 19 and passes_luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


def terms_before(text: str, stop: int, reach: int) -> list[tuple[int, int]]:
    """The last ``reach`` terms of ``text[:stop]``; looks back as far as they take, twice as far each time."""
    look = 40 * reach
    while True:
        start = max(0, stop - look)
        # A term that touches the start may have begun before it.
        found = [(m.start(), m.end()) for m in TERM.finditer(text, start, stop) if m.start() > start or start == 0]
        if start == 0 or len(found) >= reach:
            return found[-reach:]
        look *= 2


def contexts(text: str, spans: list[tuple[int, int, int]], reach: int) -> list[dict]:
    """The ``reach`` terms on either side of each span, but for those in spans, with their places."""
    out, starts = [], [low for low, _, _ in spans]
    reached = list(accumulate((high for _, _, high in spans), max))
    for low, kind, high in spans:
        after = [(m.start(), m.end()) for m in islice(TERM.finditer(text, high), reach)]
        near = [x for x in terms_before(text, low, reach) + after if not (i := bisect_left(starts, x[1])) or reached[i - 1] <= x[0]]
        terms = [{"term": text[a:b].translate(LOWER), "low": a, "high": b} for a, b in near]
        out.append({"entity": f"{KINDS[kind]}:{text[low:high].translate(LOWER)}",
                    "context": " ".join(x["term"] for x in terms), "terms": terms})
    return out


TERMS_TYPE = pa.list_(pa.struct([("term", pa.string()), ("low", pa.int64()), ("high", pa.int64())]))
CONTEXTS_TYPE = pa.list_(pa.struct([("entity", pa.string()), ("context", pa.string()), ("terms", TERMS_TYPE)]))
SPANS_TYPE = pa.list_(pa.struct([("low", pa.int64()), ("kind", pa.int64()), ("high", pa.int64())]))


def scan(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, around = [], []
        for text in text_values(batch.column("text")):
            text = text.decode("utf-8", "replace")
            own = base_spans(text)
            spans.append([{"low": a, "kind": k, "high": b} for a, k, b in own])
            around.append(contexts(text, own, reach))
        yield pa.record_batch([*(batch.column(c) for c in ("row", "doc_id", "text_hash")), pa.array(spans, SPANS_TYPE),
                               pa.array(around, CONTEXTS_TYPE)], ["row", "doc_id", "text_hash", "spans", "around"])


def term_hash(terms: list[str]) -> np.ndarray:
    words = Words([t.encode() for t in terms], TERM_BYTES)
    return words.hashes().view(np.int64)


def with_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([batch.column("term"), pa.array(term_hash(batch.column("term").to_pylist()))], ["term", "hash"])


def document_counts(docs: DataFrame, wanted: DataFrame, limit: int) -> DataFrame:
    """(hash, docs): in how many texts each wanted term hash occurs, over all texts."""
    small = wanted.count() * 8 <= limit
    only = np.sort(wanted.toArrow()["hash"].to_numpy()) if small else None
    sent = docs.sparkSession.sparkContext.broadcast(only)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_values(batch.column("text"))
            for low, high in blocks(texts):
                words = Words(texts[low:high], TERM_BYTES)
                hashes, doc = words.hashes().view(np.int64), words.doc
                if sent.value is not None:
                    known = np.isin(hashes, sent.value)
                    hashes, doc = hashes[known], doc[known]
                order = np.lexsort((doc, hashes))
                hashes, doc = hashes[order], doc[order]
                fresh = np.ones(len(doc), bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
                values, n = np.unique(hashes[fresh], return_counts=True)
                yield pa.record_batch([pa.array(values), pa.array(n)], ["hash", "n"])

    return docs.mapInArrow(count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("docs"))


def personal_data(docs: DataFrame, reach: int = REACH, support: int = SUPPORT, generalise: float = GENERALISE,
                  remove: float = REMOVE, broadcast_limit: int = BROADCAST_MAX_BYTES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(row, doc_id, text_hash, spans) per document; spans are sorted (low, kind number, high, action)."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
                       F.col(text_col).cast("binary").alias("text"))
    scanned = materialize(rows.mapInArrow(
        lambda batches: scan(batches, reach),
        f"row bigint, doc_id {id_type}, text_hash bigint, spans array<struct<low:bigint,kind:bigint,high:bigint>>, "
        "around array<struct<entity:string,context:string,terms:array<struct<term:string,low:bigint,high:bigint>>>>"), "scanned")
    total = scanned.count()
    near = scanned.where(F.size("around") > 0).select("row", F.explode("around").alias("c"))
    placed = near.select("row", "c.entity", F.xxhash64("c.context").alias("context"), F.explode("c.terms").alias("t"))
    placed = placed.select("row", "entity", "context", "t.term", "t.low", "t.high")
    contexts_of = placed.select("entity", "term", "context").distinct().groupBy("entity", "term").count()
    backed = materialize(contexts_of.where(F.col("count") >= support).select("entity", "term"), "candidates")
    entity_docs = (near.select("row", "c.entity").distinct().groupBy("entity").agg(F.count("*").alias("entity_docs")))
    both_docs = (placed.join(sized(backed), ["entity", "term"], "left_semi").select("row", "entity", "term").distinct()
                 .groupBy("entity", "term").agg(F.count("*").alias("both_docs")))
    hashed = materialize(backed.select("term").distinct().mapInArrow(with_hash, "term string, hash bigint"), "terms")
    counts = document_counts(rows.select("text"), hashed.select("hash"), broadcast_limit) if hashed.limit(1).count() else (
        hashed.select("hash", F.lit(1).cast("bigint").alias("docs")))
    own_information = -F.log2(F.col("entity_docs") / F.lit(max(1, total)))
    given = F.least(F.lit(1.0), F.col("both_docs") / F.col("docs"))
    ratio = F.when(own_information > 0, 1 + F.log2(given) / own_information).otherwise(0.0)
    revealing = (both_docs.join(hashed, "term").join(counts, "hash").join(entity_docs, "entity")
                 .withColumn("disclosure", ratio).where(F.col("disclosure") >= generalise).select(
                     "entity", "term", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise").alias("action")))
    revealing = sized(materialize(revealing, "revealing"))
    added = (placed.join(revealing, ["entity", "term"]).groupBy("row", "low", "high").agg(F.max("action").alias("action"))
             .groupBy("row").agg(F.collect_list(F.struct(
                 "low", F.lit(4).cast("bigint").alias("kind"), "high", "action")).alias("added")))
    added = materialize(added, "added").withColumnRenamed("row", "added_row")
    base = F.transform("spans", lambda x: F.struct(x["low"].alias("low"), x["kind"].alias("kind"), x["high"].alias("high"),
                                                   F.lit("remove").alias("action")))
    everything = F.when(F.col("added").isNull(), base).otherwise(F.array_sort(F.concat(base, "added")))
    return scanned.join(added, F.col("row") == F.col("added_row"), "left").select(
        "row", "doc_id", "text_hash", everything.alias("spans"))


def mask(text: str, spans: list) -> str:
    """The text with spans removed (replaced by their kind) or generalised to their kind of word."""
    out, done = [], 0
    for span in spans:
        if span["low"] < done:
            continue
        value = text[span["low"]: span["high"]]
        word = "NUMBER" if value.isdigit() else "NAME" if value[:1].isupper() else "WORD"
        out += [text[done: span["low"]], f"[{word}]" if span["action"] == "generalise" else f"[{KINDS[span['kind']].upper()}]"]
        done = span["high"]
    return "".join([*out, text[done:]])


def sanitised(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every found span masked in its text; spans are matched by id and text hash."""
    id_col, text_col = settings.get("id_col", "doc_id"), settings.get("text_col", "text")
    found = personal_data(docs, **settings).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    found = sized(materialize(found.dropDuplicates(["__id", "__hash"]), "found"))
    own = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    joined = docs.join(found, F.col(id_col).eqNullSafe(F.col("__id")) & (own == F.col("__hash")), "left")
    columns = list(docs.columns)
    place = columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(text_col).to_pylist(), batch.column("__spans").to_pylist()
            done = pa.array([mask(t, s) if s and t is not None else t for t, s in zip(texts, spans, strict=True)], pa.string())
            yield pa.record_batch([done if i == place else batch.column(i) for i in range(len(columns))], columns)

    return joined.mapInArrow(apply, docs.schema)


def span_digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the pattern spans and the text of all spans."""
    kinds = F.array(*map(F.lit, KINDS))

    def written(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.element_at(kinds, (x["kind"] + 1).cast("int")), x["low"].cast("string"), x["high"].cast("string"))), ",")

    def of_kind(number: int):
        return F.size(F.filter("spans", lambda x: x["kind"] == number)).cast("bigint")

    return found.select(
        "doc_id", *[of_kind(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(written(F.filter("spans", lambda x: x["kind"] < 4)), 256).alias("base_sha256"), written("spans").alias("spans"))
