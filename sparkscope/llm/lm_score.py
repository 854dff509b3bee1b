"""Log probabilities of whole texts under a small causal self-attention language model.

1. One scan cuts every text into words and writes it in chunks of documents: word numbers in
   the chunk's own vocabulary, and for each distinct word its hash, its training count and
   its subword ids of a public tokenizer. Words are tokenised once per chunk.
2. Word counts: each chunk sends its distinct words to their owners by ranges of the hash, packed
   into one row an owner, and gets their corpus counts back in the same order. Subword and
   (class, subword) pair counts are summed, their number is bounded by the vocabulary.
3. Training (``attention.py``, numpy): training texts are dealt by a hash of id and words to
   rounds and to replicas of the model, one for so many training words. In each round every
   replica learns from its texts of that round, in the order of their hashes, and the replicas
   are averaged by the tokens they saw. After the last round every text was learned from once.
   Neither the partitioning of the input nor the number of tasks changes the result.
4. Scoring: every chunk meets its word counts, and batched masked attention over overlapping
   context windows scores every token once. A word's probability is ``word_share`` times its
   relative frequency in the training words plus the rest times the product of its subwords'
   probabilities by the attention model.

Chunks are bounded by bytes; only a single longer text makes a larger one. What is broadcast
is bounded by the vocabulary of the tokenizer.

Defined results: null, empty and blank texts have one token, their end. A null id counts as
empty text for its fold. Words are told apart by 64-bit hashes. Without training texts
all words are unknown and the model is as it starts. Repeated rows get equal scores. Texts of
any length are scored whole. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkscope.llm import attention
from sparkscope.llm.common import id_remainder, ship
from sparkscope.llm.textkit import Words, blocks, text_values
from sparkscope.llm.token_scan import END_ID, RANKS_FILE, encoder
from sparkscope.runtime import materialize

CHUNK_BYTES = 6 << 20
ROUNDS = 3
#: Training words for each replica of the model, and tokens whose blocks it takes in mixed order.
REPLICA_WORDS, TOKENS_AT_ONCE = 4_000_000, 400_000
RATES = (0.01, 0.006, 0.003)
WORD_SHARE = 0.5
#: The end of a text as a word: the last hash.
END_HASH = np.uint64((1 << 64) - 1)
#: Chunks for each owner of word counts.
OWNER_CHUNKS = 8
AVERAGERS = 16
#: Words of whole documents whose subwords are held at a time; only a single longer text has more.
WORDS_AT_ONCE = 150_000
CHUNK_FIELDS = ("chunk bigint, held_out array<boolean>, n_tokens array<bigint>, places array<bigint>, words binary, hashes binary, "
                "counts binary, n_words bigint, lengths binary, subwords binary")


_ZSTD = pa.Codec("zstd")


def packed(values: np.ndarray) -> pa.Array:
    return pa.array([_ZSTD.compress(values.tobytes(), asbytes=True)], pa.binary())


def unpacked(value: pa.Scalar, kind: str, size: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(_ZSTD.decompress(value.as_py(), size * width, asbytes=True), kind)


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges ``begin`` to ``begin + size``, one after the other."""
    last = np.cumsum(size)
    return np.repeat((begin - last + size).astype(np.int32), size) + np.arange(last[-1] if len(size) else 0, dtype=np.int32)


def odd_words(text: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Which words may hold white space of the tokenizer that is none of ours, like a no-break space."""
    a, b = text[:-1], text[1:]
    found = np.flatnonzero((a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A)
                           | (a == 0xE2) & (b >> 1 == 0x40) | (a == 0xE3) & (b == 0x80))
    odd = np.zeros(len(begin), bool)
    odd[np.searchsorted(begin, found, "right") - 1] = True
    return odd


def word_starts(encoding) -> np.ndarray:
    """Which subword ids begin with a space."""
    out = np.zeros(1 << 16, bool)
    out[[i for i in range(encoding.n_vocab) if encoding.decode_single_token_bytes(i)[:1] == b" "]] = True
    return out


def subwords_of(encoding, opens: np.ndarray, words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of subwords and subword ids of some words, each with a space before it.

    The tokenizer cuts before every single space, so that most words are encoded in one
    text; its ids that begin with a space show where the words begin.
    """
    size = words.end[at] - words.start[at] + 1
    begin = np.cumsum(size) - size
    text = words.data[spread(words.start[at] - 1, size)]
    text[begin] = 0x20
    odd = odd_words(text, begin)
    ids = np.array(encoding.encode_ordinary(text[np.repeat(~odd, size)].tobytes().decode("utf-8", "replace")), "<u2")
    first = np.flatnonzero(opens[ids])
    lengths = np.empty(len(at), np.int32)
    lengths[~odd] = np.diff(first, append=len(ids))
    if not odd.any():
        return lengths, ids
    alone = [encoding.encode_ordinary(text[begin[i]: begin[i] + size[i]].tobytes().decode("utf-8", "replace")) for i in np.flatnonzero(odd)]
    lengths[odd] = [len(x) for x in alone]
    out, own = np.empty(lengths.sum(), "<u2"), np.repeat(odd, lengths)
    out[~own], out[own] = ids, np.concatenate(alone)
    return lengths, out


def block_hashes(texts: list[bytes]) -> tuple[list[Words], np.ndarray, np.ndarray]:
    """Words of small blocks of the texts, all their hashes, and the number of words of each text."""
    parts = [Words(texts[low:high]) for low, high in blocks(texts)]
    none = np.zeros(0, np.uint64)
    return parts, np.concatenate([none, *(x.hashes() for x in parts)]), np.concatenate([np.zeros(0, np.int64), *(x.counts for x in parts)])


def chunked(batches: Iterator[pa.RecordBatch], ranks_file: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Chunk rows: the vocabulary is in the order of its hashes, the end of a text is its last entry."""
    encoding, number = encoder(ranks_file), TaskContext.get().partitionId() << 32
    opens = word_starts(encoding)
    for batch in batches:
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        for low, high in blocks(list(map(range, lengths)), chunk_bytes):  # a chunk's texts only
            parts, own_hashes, sizes = block_hashes(text_values(batch.column("text")[low:high]))
            hashes, first, index = np.unique(own_hashes, return_index=True, return_inverse=True)
            end = len(hashes)
            doc_end = np.cumsum(sizes)
            places = [int.from_bytes(hashlib.blake2b(f"{i}:".encode() + own_hashes[stop - size: stop].tobytes(), digest_size=8).digest(), "big") >> 1
                      for i, size, stop in zip(batch.column("doc_id")[low:high].to_pylist(), sizes, doc_end, strict=True)]
            sizes = sizes + 1
            stream = np.full(sizes.sum(), end, np.int32)
            last = np.cumsum(sizes) - 1
            inside = np.ones(len(stream), bool)
            inside[last] = False
            stream[inside] = index
            learned = np.repeat(~held[low:high], sizes)
            counts = np.bincount(stream[learned], minlength=end + 1)
            order = np.argsort(first)
            begin = np.cumsum([0, *map(len, parts)])
            edges = np.searchsorted(first[order], begin)
            met = [subwords_of(encoding, opens, part, first[order[a:b]] - at)
                   for part, at, a, b in zip(parts, begin.tolist(), edges[:-1], edges[1:], strict=False) if a < b]
            of_met = np.concatenate([np.zeros(0, np.int32), *(x for x, _ in met)])  # in the order of the texts
            ids = np.concatenate([np.zeros(0, "<u2"), *(x for _, x in met)])
            lengths, at = np.empty(end, np.int32), np.empty(end, np.int64)
            lengths[order], at[order] = of_met, np.cumsum(of_met) - of_met
            ids = np.append(ids[spread(at, lengths)], np.array([END_ID], "<u2"))
            own = pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), batch.column("doc_id")[low:high])
            lists = [pa.array([x], pa.list_(kind)) for x, kind in ((held[low:high], pa.bool_()), (sizes, pa.int64()), (places, pa.int64()))]
            yield pa.record_batch([
                own, pa.array([number], pa.int64()), *lists, packed(stream), pa.array([np.append(hashes, END_HASH).tobytes()], pa.binary()),
                packed(counts), pa.array([end + 1], pa.int64()), packed(np.append(lengths, np.int32(1))), packed(ids)],
                ["doc_ids", "chunk", "held_out", "n_tokens", "places", "words", "hashes", "counts", "n_words", "lengths", "subwords"])
            number += 1


def sent_words(batches: Iterator[pa.RecordBatch], owners: int) -> Iterator[pa.RecordBatch]:
    """(owner, chunk, n, hashes, counts): a chunk's words by the range of hashes that an owner counts."""
    for batch in batches:
        for row in range(len(batch)):
            hashes = np.frombuffer(batch.column("hashes")[row].as_py(), "<u8")
            counts = unpacked(batch.column("counts")[row], "<i8", len(hashes))
            n = np.bincount(((hashes >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64), minlength=owners)
            owner = np.flatnonzero(n)
            cuts = np.cumsum(n[owner])[:-1]
            yield pa.record_batch([
                pa.array(owner), pa.array(np.full(len(owner), batch.column("chunk")[row].as_py(), np.int64)), pa.array(n[owner]),
                pa.array([x.tobytes() for x in np.split(hashes, cuts)], pa.binary()),
                pa.concat_arrays([packed(x) for x in np.split(counts, cuts)])], ["owner", "chunk", "n", "hashes", "counts"])


def summed_words(table: pa.Table) -> pa.Table:
    """An owner's rows with the words' counts over all chunks; its first row has its numbers of training words and of distinct ones."""
    n, counts = table["n"].to_numpy(), table["counts"]
    hashes = np.frombuffer(b"".join(table["hashes"].to_pylist()), "<u8")
    values, index = np.unique(hashes, return_inverse=True)
    total = np.zeros(len(values), np.int64)
    np.add.at(total, index, np.concatenate([unpacked(counts[row], "<i8", size) for row, size in enumerate(n.tolist())]))
    found = pa.concat_arrays([packed(x) for x in np.split(total[index], np.cumsum(n)[:-1])])
    first = np.arange(len(n)) == 0
    return pa.table([table["owner"], table["chunk"], table["n"], found, pa.array(first * total.sum()), pa.array(first * np.count_nonzero(total))],
                    ["owner", "chunk", "n", "found", "tokens", "words"])


class Stream:
    """The words of a chunk row, their documents and, a part of these at a time, their subword tokens."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, row: int):
        def value(name):
            return batch.column(name)[row]
        self.held = np.array(value("held_out").as_py(), bool)
        sizes = value("n_tokens").values.to_numpy()
        self.sizes, self.doc_words = sizes, np.concatenate([[0], np.cumsum(sizes)])
        self.words = unpacked(value("words"), "<i4", int(sizes.sum()))
        self.lengths = unpacked(value("lengths"), "<i4", value("n_words").as_py())
        self.subwords = unpacked(value("subwords"), "<u2", int(self.lengths.sum()))
        self.begin = np.cumsum(self.lengths) - self.lengths

    def tokens(self, words: np.ndarray) -> np.ndarray:
        return self.subwords[spread(self.begin[words], self.lengths[words])]

    def parts(self, at_once: int = WORDS_AT_ONCE) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Ranges of documents with their words, tokens, starts of words in the tokens and of documents in the words."""
        low = 0
        while low < len(self.sizes):
            high = max(low + 1, int(np.searchsorted(self.doc_words, self.doc_words[low] + at_once, "right")) - 1)
            words = self.words[self.doc_words[low]: self.doc_words[high]]
            word_start = np.concatenate([[0], np.cumsum(self.lengths[words], dtype=np.int64)])
            yield slice(low, high), words, self.tokens(words).astype(np.int32), word_start, self.doc_words[low: high + 1] - self.doc_words[low]
            low = high


STREAM = ["held_out", "n_tokens", "places", "n_words", "words", "lengths", "subwords"]


def subword_counts(chunks: DataFrame) -> np.ndarray:
    """Ids of the subwords of the training texts, most frequent first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(END_ID + 1, np.int64)
        for batch in batches:
            for row in range(len(batch)):
                counts = unpacked(batch.column("counts")[row], "<i8", batch.column("n_words")[row].as_py())
                lengths = unpacked(batch.column("lengths")[row], "<i4", len(counts))
                ids = unpacked(batch.column("subwords")[row], "<u2", int(lengths.sum()))
                total += np.bincount(ids, np.repeat(counts, lengths), len(total)).astype(np.int64)
        known = np.flatnonzero(total)
        yield pa.record_batch([pa.array(known), pa.array(total[known])], ["id", "n"])

    rows = chunks.select("counts", "n_words", "lengths", "subwords").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(
        F.sum("n").alias("n")).toArrow()
    ids, n = rows["id"].to_numpy(), rows["n"].to_numpy()
    return ids[np.lexsort((ids, -n))]


def pair_counts(chunks: DataFrame, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of (class of the previous subword, subword) in the training texts."""
    sent = chunks.sparkSession.sparkContext.broadcast(order[: attention.HEAD])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = END_ID + 1
        classes = np.full(size, attention.HEAD, np.int32)
        classes[sent.value] = np.arange(len(sent.value), dtype=np.int32)
        known, total = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in batches:
            for row in range(len(batch)):
                stream = Stream(batch, row)
                for docs, _, tokens, word_start, doc_words in stream.parts():
                    before = np.append(np.int32(END_ID), tokens[:-1])  # a document follows the end of another
                    learned = np.repeat(~stream.held[docs], np.diff(word_start[doc_words]))
                    values, n = np.unique((classes[before] * np.int32(size) + tokens)[learned], return_counts=True)
                    known, index = np.unique(np.concatenate([known, values]), return_inverse=True)
                    counts, total = np.concatenate([total, n]), np.zeros(len(known), np.int64)
                    np.add.at(total, index, counts)
        yield pa.record_batch([pa.array(known.astype(np.int64)), pa.array(total)], ["pair", "n"])

    rows = chunks.select(*STREAM).mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = rows["pair"].to_numpy()
    return pairs // (END_ID + 1), pairs % (END_ID + 1), rows["n"].to_numpy()


def training_texts(batches: Iterator[pa.RecordBatch], turn: int, rounds: int, replicas: int) -> Iterator[pa.RecordBatch]:
    """(replica, place, tokens) of the training texts of a round, by a hash of id and words (so that copies spread)."""
    for batch in batches:
        for row in range(len(batch)):
            stream, places = Stream(batch, row), batch.column("places")[row].values.to_numpy()
            docs = np.flatnonzero(~stream.held & (places % rounds == turn))
            words = stream.words[spread(stream.doc_words[docs], stream.sizes[docs])]
            tokens = stream.tokens(words).tobytes()
            end = np.concatenate([[0], np.cumsum(stream.lengths[words], dtype=np.int64)])[np.cumsum(stream.sizes[docs])] * 2
            texts = [tokens[a:b] for a, b in zip([0, *end[:-1].tolist()], end.tolist(), strict=False)]
            yield pa.record_batch([pa.array(places[docs] // rounds % replicas), pa.array(places[docs]), pa.array(texts, pa.binary())],
                                  ["replica", "place", "tokens"])


def replica_sums(batches: Iterator[pa.RecordBatch], start: np.ndarray, frequencies: attention.Frequencies, rate: float
                 ) -> Iterator[pa.RecordBatch]:
    """Train a replica on each run of equal ``replica``; parameters times tokens seen, and these."""
    trainer, own, texts, waiting = None, None, [], 0

    def learn() -> None:
        """Blocks in a fixed mixed order, so that a step sees many texts."""
        sizes = [len(x) // 2 for x in texts]
        tokens = np.frombuffer(b"".join(texts), "<u2").astype(np.int32)
        doc_start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        first = attention.block_starts(doc_start)[0]
        trainer.learn(tokens, doc_start, END_ID, np.random.default_rng(len(first)).permutation(len(first)))
        texts.clear()

    def done() -> Iterator[pa.RecordBatch]:
        if trainer is not None:
            if texts:
                learn()
            total = attention.flat(trainer.p) * trainer.seen
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([trainer.seen])], ["total", "seen"])

    for batch in batches:
        for replica, text in zip(batch.column("replica").to_pylist(), (x.as_py() for x in batch.column("tokens")), strict=True):
            if replica != own:
                yield from done()
                own, trainer, waiting = replica, attention.Trainer(attention.shaped(start), frequencies, rate), 0
            texts.append(text)
            waiting += len(text) // 2
            if waiting >= TOKENS_AT_ONCE:
                learn()
                waiting = 0
    yield from done()


def trained(chunks: DataFrame, frequencies: Broadcast, rounds: int, replicas: int) -> np.ndarray:
    """Parameters after ``rounds`` of averaging the replicas; a round learns from one in ``rounds`` texts."""
    values = attention.flat(attention.start_values())
    spark = chunks.sparkSession
    size = len(values)
    parts = min(replicas, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for turn in range(rounds):
        start, rate = spark.sparkContext.broadcast(values), RATES[min(turn, len(RATES) - 1)]

        def learn(batches: Iterator[pa.RecordBatch], start=start, rate=rate) -> Iterator[pa.RecordBatch]:
            return replica_sums(batches, start.value, frequencies.value, rate)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(size), 0
            for batch in batches:
                for row in range(len(batch)):
                    total += np.frombuffer(batch.column("total")[row].as_py())
                    seen += batch.column("seen")[row].as_py()
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([seen])], ["total", "seen"])

        kind = "total binary, seen bigint"
        texts = chunks.select("doc_ids", *STREAM).mapInArrow(lambda b, turn=turn: training_texts(b, turn, rounds, replicas),
                                                  "replica bigint, place bigint, tokens binary")
        dealt = texts.repartitionById(parts, (F.col("replica") % parts).cast("int")).sortWithinPartitions("replica", "place")
        sums = dealt.mapInArrow(learn, kind).repartition(AVERAGERS).mapInArrow(add, kind).collect()
        start.unpersist()
        seen = sum(row["seen"] for row in sums)
        if seen:
            values = sum(np.frombuffer(row["total"]) for row in sums) / seen
    return values


def lm_scores(docs: DataFrame, ranks_file: str = RANKS_FILE, folds: int = 5, held_fold: int = 1, rounds: int = ROUNDS,
              replica_words: int = REPLICA_WORDS, word_share: float = WORD_SHARE, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, attention_score) of every text.

    Texts whose id hash falls into ``held_fold`` are not learned from. ``base_score`` is by
    smoothed word frequencies, ``score`` by the model, ``attention_score`` by its subwords alone.
    """
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                       (id_remainder(id_col, folds) == held_fold).alias("held_out"))
    chunks = materialize(rows.mapInArrow(lambda batches: chunked(batches, ranks_file, chunk_bytes),
                                         f"doc_ids array<{id_type}>, {CHUNK_FIELDS}"), "chunks")
    owners = max(1, -(-chunks.count() // OWNER_CHUNKS))
    sent = chunks.select("chunk", "hashes", "counts").mapInArrow(lambda batches: sent_words(batches, owners),
                                                                 "owner bigint, chunk bigint, n bigint, hashes binary, counts binary")
    known = materialize(sent.groupBy("owner").applyInArrow(
        summed_words, "owner bigint, chunk bigint, n bigint, found binary, tokens bigint, words bigint"), "word-counts")
    size = known.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    tokens, smooth = size["tokens"], size["tokens"] + 0.5 * (size["words"] + 1)

    order = subword_counts(chunks)
    frequencies = context.broadcast(attention.Frequencies(order, END_ID + 1, pair_counts(chunks, order)))
    values = attention.shaped(trained(chunks, frequencies, rounds, max(1, -(-tokens // replica_words))))

    def score(table: pa.Table, words: pa.Table) -> pa.Table:
        p, f = values, frequencies.value
        words, table = words.sort_by("owner"), table.combine_chunks()
        counts = np.concatenate([unpacked(x, "<i8", n) for x, n in zip(words["found"], words["n"].to_pylist(), strict=True)])
        stream, sums = Stream(table, 0), []
        for _, own_words, subwords, word_start, doc_words in stream.parts():
            own, starts = counts[own_words], doc_words[:-1]
            base = np.log10((own + 0.5) / smooth)
            logs = attention.log_probabilities(p, f, subwords, word_start[doc_words], END_ID).astype(np.float64)
            by_word = np.add.reduceat(logs, word_start[:-1])
            with np.errstate(divide="ignore"):
                seen = np.log10(own / max(1, tokens) * word_share)
            mixed = np.logaddexp(seen * np.log(10), (by_word + np.log10(1 - word_share)) * np.log(10)) / np.log(10)
            sums.append([np.add.reduceat(x, starts) for x in ((own > 0).astype(np.int64), base, mixed, by_word)])
        known_words, *scores = (np.concatenate(x) for x in zip(*sums, strict=True))
        return pa.table([
            table["doc_ids"].chunk(0).values, pa.array(stream.held), pa.array(stream.sizes), pa.array(known_words),
            pa.array(np.full(len(known_words), tokens, np.int64)), *map(pa.array, scores)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "attention_score"])

    return chunks.select("chunk", "doc_ids", *STREAM).groupBy("chunk").cogroup(
        known.select("chunk", "owner", "n", "found").groupBy("chunk")).applyInArrow(
        score, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
               "score double, attention_score double")
