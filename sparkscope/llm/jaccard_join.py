"""N-gram Jaccard join over parity sketches, and the groups its links form.

A document is the set of its distinct word shingles. In a parity sketch every element
flips one bit, so the bits in which two sketches differ are at most the elements in which
the sets differ. A link between sets of sizes a and b allows (a + b)(1 - s)/(1 + s) such
elements. Documents are put into size bands; in a band that allows D differences the
sketch is cut into D + 1 pieces by element hash, and by the pigeonhole principle linked
documents agree in at least one piece. A piece is as wide as the hash space, so it is
kept as the XOR of its elements' hashes, and unrelated documents do not meet by chance.

1. One scan gives every document its set's fingerprint, size and a parity sketch of at least
   four bits an element; sketches are as wide as a power of two, so that a wider one folds to
   the width of a narrower one, and all fold to 512 bits for a first look. Equal sets share a
   fingerprint and count as one from here on.
2. A second scan sends the piece keys into a shuffle; they are not written otherwise. A task
   links and verifies the sets of a key within each block itself and sends one of them, so a
   key that a third of all documents share costs a row a block. Within a key every set is linked to
   the one that shares most keys in its block (a star, never all pairs), sizes and sketches rule pairs out by their
   Hamming bound, and the exact shingle sets of what is left decide: only these are built.
3. Verified links form components. Keys that still hold several components get the
   missing comparisons: sets outside the key's largest component against the others.
   Pairs within one component are never formed, so a group of n near copies costs about n.

The result is written and everything else that was written on the way deleted.

Nothing is capped: what a star leaves undecided is compared in step 3. Fingerprints and
shingle hashes have 64 bits, two different ones agree with a chance of 2^-64.

Defined results: null, empty and blank texts have the empty set and link with nothing;
fewer words than a shingle has make one shingle of them all. A component is named by its
smallest doc_id that is not null. Repeated rows are copies of each other. Very long texts are
cut into shingles whole, one at a time. An empty table gives an empty result; other columns of
the input are ignored, except those named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.llm.common import components, pick_rows, ship, sized
from sparkscope.llm.textkit import Words, blocks, mix, shingles, text_values
from sparkscope.runtime import materialize, new_path, scratch

BAND_STEPS = 2
LEVELS = 8
SPARE = 8
#: Words of the sketch that is compared first, and bits an element of the wide one.
SKETCH_WORDS = 8
SKETCH_BITS = 4


#: What a block knows of a row of a star: nothing, a verified link, or one group of verified links.
OPEN, LINK, INSIDE = 0, 1, 2


def band_limits(num: int, den: int, top: int) -> np.ndarray:
    """Largest size of each band, to one band beyond that of ``top``: linked sizes are in the same or adjacent bands.

    A band's limit is the same whatever ``top`` is, as documents of different blocks must be cut alike.
    """
    limits = [1]
    while len(limits) < 2 or limits[-2] < top:
        size = limits[-1]
        for _ in range(BAND_STEPS):
            size = size * den // num
        limits.append(max(limits[-1] + 1, size))
    return np.array(limits, np.int64)


def set_prints(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Order-free 64-bit fingerprints of ``n`` sets given as (document, hash) pairs."""
    total = np.zeros(n, np.uint64)
    np.add.at(total, doc, mix(values ^ np.uint64(0x5851F42D4C957F2D)))
    return mix(total)


def piece_keys(doc: np.ndarray, values: np.ndarray, sizes: np.ndarray, num: int, den: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of every piece of every document, in its own and the next band.

    A piece without elements says nothing, so a band that allows D differences has D / 8
    pieces more than D + 1. Two documents that agree in empty pieces only differ in all
    others, once in each at least. A document of so many filled pieces that no link of it
    may differ as often need not fear that; any other also gives the pieces of an
    independent cut (the next level).
    """
    limits = band_limits(num, den, int(sizes.max(initial=1)))
    band = np.searchsorted(limits, sizes)
    docs, keys = [], []
    for shift in (0, 1):
        use = sizes > 0
        if shift:
            use &= sizes * den // num > limits[band]
        at = band + shift
        top = limits[np.minimum(at, len(limits) - 1)]
        allowed = 2 * top * (den - num) // (den + num)
        pieces = allowed + 1 + -(-allowed // SPARE)
        own_allowed = (sizes + np.minimum(top, sizes * den // num)) * (den - num) // (den + num)
        for level in range(LEVELS):
            if not use.any():
                break
            count = np.where(use, pieces, 0)
            base = np.concatenate([[0], np.cumsum(count)])
            own = use[doc]
            d, salted = doc[own], mix(values[own] + np.uint64(level + 1))
            slot = base[d] + (((salted >> np.uint64(32)) * count[d].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            parity = np.zeros(base[-1], np.uint64)
            np.bitwise_xor.at(parity, slot, mix(salted))
            filled = np.zeros(base[-1], bool)
            filled[slot] = True
            owner = np.repeat(np.arange(len(sizes)), count)
            index = np.arange(base[-1]) - base[owner]
            place = ((at[owner] * LEVELS + level) << 40) + index
            emit = filled if level < LEVELS - 1 else np.ones(len(filled), bool)
            docs.append(owner[emit])
            keys.append(mix(parity[emit] ^ mix(place[emit].astype(np.uint64))))
            use = use & (np.bincount(owner[filled], minlength=len(sizes)) <= own_allowed) & (count > 0)
            use &= np.bincount(owner[~filled], minlength=len(sizes)) > 0
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    d, k = np.concatenate(docs), np.concatenate(keys)
    order = np.argsort(d, kind="stable")
    return d[order], k[order]


def lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """Values sorted by owner as one list for each of ``n`` owners."""
    ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def parity_sketches(doc: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets) of each set's parity sketch, ``SKETCH_BITS`` bits an element or more."""
    words = np.maximum(SKETCH_WORDS, 1 << np.ceil(np.log2(np.maximum(1, sizes * SKETCH_BITS / 64))).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(words)])
    bits = np.zeros(offsets[-1], np.uint64)
    place = (values & ((words[doc] << 6) - 1).astype(np.uint64)).astype(np.int64)
    np.bitwise_xor.at(bits, offsets[doc] + (place >> 6), np.uint64(1) << (values & np.uint64(63)))
    return bits, offsets


def sketched(batches: Iterator[pa.RecordBatch], words: int, carry: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, others = text_values(batch.column("text")), [batch.column(c) for c in ("doc_id", *carry)]
        for low, high in blocks(texts):
            n = high - low
            doc, values = shingles(Words(texts[low:high]), words)
            sizes = np.bincount(doc, minlength=n)
            bits, offsets = parity_sketches(doc, values, sizes)
            first = np.zeros((n, SKETCH_WORDS), np.uint64)
            np.bitwise_xor.at(first, (np.repeat(np.arange(n), np.diff(offsets)),
                                      (np.arange(len(bits)) - np.repeat(offsets[:-1], np.diff(offsets))) % SKETCH_WORDS), bits)
            quick = pa.FixedSizeListArray.from_arrays(pa.array(first.ravel().view(np.int64)), SKETCH_WORDS).cast(pa.list_(pa.int64()))
            wide = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(bits.view(np.int64)))
            yield pa.record_batch([*(x[low:high] for x in others), pa.array(set_prints(doc, values, n).view(np.int64)), pa.array(sizes),
                                   quick, wide], ["doc_id", *carry, "print", "n", "sketch", "wide"])


def join_in_block(lead: np.ndarray, other: np.ndarray, doc: np.ndarray, values: np.ndarray, num: int, den: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Verify the (lead, other) documents of a block; per pair, whether it links two groups, and whether it lies in one group.

    Groups are what verified links connect; a pair inside a group needs no verification.
    """
    first = np.searchsorted(doc, np.arange(doc[-1] + 2 if len(doc) else 1))
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = parent[x]
        return x

    pairs, index = np.unique(np.stack([lead, other], 1), axis=0, return_inverse=True)
    tree = np.zeros(len(pairs), bool)
    for i, (a, b) in enumerate(pairs.tolist()):
        left, right = values[first[a]: first[a + 1]], values[first[b]: first[b + 1]]
        if min(len(left), len(right)) * den < max(len(left), len(right)) * num or (root := top(a)) == (end := top(b)):
            continue
        both = np.sort(np.concatenate([left, right]))
        shared = int((both[1:] == both[:-1]).sum())
        if shared * den >= (len(both) - shared) * num:
            parent[end], tree[i] = root, True
    inside = np.array([top(a) == top(b) for a, b in pairs.tolist()], bool)
    index = index.ravel()
    fresh = np.zeros(len(index), bool)
    fresh[np.unique(index, return_index=True)[1]] = True  # a link is told once
    return tree[index] & fresh, inside[index]


def keyed(batches: Iterator[pa.RecordBatch], words: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """(deal, key, print, other, state, score) of every piece; of equal sets in a block one gives the keys.

    Sets of a block that share a key are put in a star here, around the one with the largest
    ``score``, the number of keys it shares in the block: such a row (``other`` is set) is dealt
    anywhere, and only the middle of the star goes to the key's task.
    Their sets are at hand, so the stars are verified: ``state`` says whether a row is a link,
    lies in a group that links connect, or is still open.
    """
    for batch in batches:
        texts = text_values(batch.column("text"))
        for low, high in blocks(texts):
            n = high - low
            doc, values = shingles(Words(texts[low:high]), words)
            prints = set_prints(doc, values, n)
            first = np.zeros(n, bool)
            first[np.unique(prints, return_index=True)[1]] = True
            own = first[doc]
            doc, values = doc[own], values[own]
            d, keys = piece_keys(doc, values, np.bincount(doc, minlength=n), num, den)
            signed = prints.view(np.int64)
            # A set that shares many keys lies in the middle of its group, so that most others link with it.
            _, run, many = np.unique(keys, return_inverse=True, return_counts=True)
            score = np.bincount(d[many[run] > 1], minlength=n).astype(np.int32)
            order = np.lexsort((signed[d], -score[d], keys))
            keys, d = keys[order], d[order]
            start = np.ones(len(keys), bool)
            start[1:] = keys[1:] != keys[:-1]
            lead = d[np.flatnonzero(start)[np.cumsum(start) - 1]] if len(keys) else d
            keep = start | (d != lead)
            start, keys, lead, d = start[keep], keys[keep], lead[keep], d[keep]
            state = np.full(len(keys), OPEN, np.int32)
            tree, inside = join_in_block(lead[~start], d[~start], doc, values, num, den)
            state[~start] = np.where(tree, LINK, np.where(inside, INSIDE, OPEN))
            deal = np.where(start, keys, mix(keys ^ prints[d]))
            yield pa.record_batch([pa.array(deal.view(np.int64)), pa.array(keys.view(np.int64)), pa.array(signed[lead]),
                                   pa.array(signed[d], mask=start), pa.array(state), pa.array(score[lead])],
                                  ["deal", "key", "print", "other", "state", "score"])


def set_lists(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_values(batch.column("text"))
        for low, high in blocks(texts):
            doc, values = shingles(Words(texts[low:high]), words)
            prints = set_prints(doc, values, high - low)
            yield pa.record_batch([pa.array(prints.view(np.int64)), lists(doc, values, high - low)], ["print", "items"])


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and score to (key, first print of the key, other print); links that are there already pass."""
    last_key = pivot = last = None
    for batch in batches:
        linked = batch.column("other").is_valid()
        there = batch.filter(linked)
        yield pa.record_batch([there.column(c) for c in ("key", "print", "other", "state")], ["key", "a", "b", "state"])
        batch = batch.filter(pc.invert(linked))
        key, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "print"))
        if not len(key):
            continue
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        fresh[0] = last_key is None or key[0] != last_key
        starts = np.flatnonzero(fresh)
        run = np.cumsum(fresh) - 1
        pivots = np.where(run >= 0, own[starts[np.maximum(run, 0)]] if len(starts) else 0, pivot if pivot is not None else 0)
        before = np.concatenate([[last if last is not None else own[0]], own[:-1]])
        keep = ~fresh & (own != before) & (own != pivots)
        last_key, last, pivot = key[-1], own[-1], pivots[-1]
        yield pa.record_batch([pa.array(key[keep]), pa.array(pivots[keep]), pa.array(own[keep]),
                               pa.array(np.full(int(keep.sum()), OPEN, np.int32))], ["key", "a", "b", "state"])


def possible(num: int, den: int) -> Column:
    """Whether sizes and the Hamming distance of the sketches allow a link."""
    hamming = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    size = F.col("n_a") + F.col("n_b")
    return ((hamming * (den + num) <= size * (den - num))
            & (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num))


def folded(sketch: str, words: Column) -> Column:
    """A sketch of ``words`` or twice as many words, at a width of ``words``."""
    half = F.zip_with(F.slice(sketch, F.lit(1), words), F.slice(sketch, words + 1, words), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(sketch) > words, half).otherwise(F.col(sketch))


def still_possible(pairs: DataFrame, filled: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b), of sizes that may link, whose wide sketches allow a link too."""
    wanted = sized(materialize(pairs.select(F.col("a").alias("print")).union(pairs.select("b")).distinct(), "wanted"))
    wide = materialize(filled.select("print", "n", "wide").join(wanted, "print", "left_semi").dropDuplicates(["print"]), "wide")
    for c in "ab":
        pairs = pairs.join(wide.select(F.col("print").alias(c), F.col("n").alias(f"n_{c}"), F.col("wide").alias(f"wide_{c}")), c)
    words = F.least(F.size("wide_a"), F.size("wide_b"))
    apart = F.zip_with(folded("wide_a", words), folded("wide_b", words), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    hamming = F.aggregate(apart, F.lit(0), lambda total, x: total + x)
    return materialize(pairs.where(hamming * (den + num) <= (F.col("n_a") + F.col("n_b")) * (den - num)).select("a", "b"), "possible")


def sets_of(pairs: DataFrame, rows: DataFrame, sketches: DataFrame, words: int) -> DataFrame:
    """(print, items): the exact shingle sets that the pairs need."""
    wanted = sized(materialize(pairs.select(F.col("a").alias("print")).union(pairs.select("b")).distinct(), "wanted"))
    ids = sketches.join(wanted, "print", "left_semi").select("doc_id")
    return materialize(pick_rows(rows.select("doc_id", "text"), ids, ["doc_id"])
                       .mapInArrow(lambda batches: set_lists(batches, words), "print bigint, items array<bigint>")
                       .join(wanted, "print", "left_semi").dropDuplicates(["print"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose exact shingle sets reach the similarity."""
    left, right = (sets.select(F.col("print").alias(c), F.col("items").alias(f"items_{c}")) for c in "ab")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - shared
    return pairs.join(left, "a").join(right, "b").where(shared * den >= union * num).select("a", "b")


def as_links(found: DataFrame) -> DataFrame:
    """Components as the links of their stars, to which more links can be added."""
    return found.select(F.col("node").alias("a"), F.col("component").alias("b"))


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, component, *carry): documents linked where intersection/union >= num/den.

    ``component`` tells components apart where ids are null or repeated; it is null for a
    document without shingles, which is linked with nothing. ``carry`` names further columns.
    """
    spark = docs.sparkSession
    ship(spark)
    path = new_path(spark, "components")
    with scratch(spark):
        found = _components(docs, words, num, den, id_col, text_col, list(carry))
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _components(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text_col).cast("binary").alias("text"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ["doc_id", *carry])
    scanned = materialize(rows.mapInArrow(
        lambda batches: sketched(batches, words, carry),
        f"{kinds}, print bigint, n bigint, sketch array<bigint>, wide array<bigint>"), "sketches")
    filled = scanned.where("n > 0")
    pieces = rows.select("text").mapInArrow(lambda batches: keyed(batches, words, num, den),
                                            "deal bigint, key bigint, print bigint, other bigint, state int, score int")
    star = materialize(pieces.repartition("deal").sortWithinPartitions("key", F.desc("score"), "print").mapInArrow(
        stars, "key bigint, a bigint, b bigint, state int"), "stars")
    met = materialize(star.select(F.col("a").alias("print")).union(star.select("b")).distinct(), "met")
    sketches = materialize(filled.select("doc_id", "print", "n", "sketch").join(sized(met), "print", "left_semi")
                           .groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"),
                                                 F.max("sketch").alias("sketch")), "met-sketches")
    sides = [sketches.select(F.col("print").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
             for c in "ab"]
    in_blocks = star.where(F.col("state") == LINK).select("a", "b")
    seen = materialize(star.where(F.col("state") == OPEN).select("a", "b").distinct().join(sides[0], "a").join(sides[1], "b")
                       .where(possible(num, den)).select("a", "b"), "pairs")
    pairs = still_possible(seen, filled, num, den)
    sets = sets_of(pairs, rows, sketches, words)
    # One pair of each set first; pairs that these already connect need no comparison.
    some = materialize(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "some-pairs")
    found = components(in_blocks.union(materialize(verified(some, sets, num, den), "links")))
    others = pairs.join(some, ["a", "b"], "left_anti")
    for c in "ab":
        named = found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
        others = others.join(named, c, "left").withColumn(f"of_{c}", F.coalesce(f"of_{c}", c))
    others = materialize(others.where("of_a <> of_b").select("a", "b"), "other-pairs")
    found_too = materialize(verified(others, sets, num, den), "links")
    if found_too.limit(1).count():
        found = components(as_links(found).union(found_too))

    # What the stars leave undecided: keys whose sets lie in several components.
    members = (star.select("key", F.col("a").alias("print")).union(star.select("key", "b")).distinct()
               .join(found.withColumnRenamed("node", "print"), "print", "left")
               .select("key", "print", F.coalesce("component", "print").alias("component")))
    members = materialize(members, "members")
    counts = members.groupBy("key", "component").count()
    open_keys = materialize(counts.groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1").select("key", "main"), "open-keys")
    rest = members.join(sized(open_keys), "key").join(sketches.drop("doc_id"), "print")
    rest = materialize(rest.select("key", "print", "component", "main", "n", "sketch"), "undecided")
    left, right = (rest.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("print", "component", "main", "n", "sketch")))
                   for s in "ab")
    cross = (left.where("component_a <> main_a").join(right, "key")
             .where("component_a <> component_b and (component_b = main_b or print_a < print_b)").where(possible(num, den))
             .select(F.col("print_a").alias("a"), F.col("print_b").alias("b"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    cross = still_possible(materialize(cross.join(seen, ["a", "b"], "left_anti"), "cross"), filled, num, den)
    more = materialize(verified(cross, sets_of(cross, rows, sketches, words), num, den), "more-links")
    if more.limit(1).count():
        found = components(as_links(found).union(more))

    named = filled.groupBy("print").agg(F.min("doc_id").alias("low")).join(
        found.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "low", F.coalesce("component", "print").alias("component"))
    named = materialize(named, "named")
    smallest = materialize(named.groupBy("component").agg(F.min("low").alias("component_id")), "smallest")
    names = materialize(named.join(smallest, "component").select("print", "component_id", "component"), "names")
    full = filled.join(names, "print").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "component", *carry)
    return full.union(scanned.where("n = 0").select(
        "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("bigint").alias("component"), *carry))
