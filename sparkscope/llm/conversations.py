"""Conversation structure repair: the cheapest edits that give a legal turn order.

A legal conversation has role initials ``(s?(ua)+)?``: nothing, or an optional system turn
and then user and assistant in turn. Edits are Keep (0), Rerole to user or assistant (3),
Delete (4, required for blank and repeated turns) and Insert of an empty turn (3); a
truncated turn that stays adds 3. The audit writes the edits' initials in order.

Every path through the edits has one integer as its weight. The high digits are its cost,
the low digits its audit: one digit of fixed width for each place, D < I < K < R as in
ASCII, and zeros behind the last letter, so that an audit comes before its extensions. The
path with the smallest integer is then the cheapest one with the least audit, and a plain
minimum over integers decides every node (rows done, state of the pattern). That is exact:
two paths of equal cost to one node differ in a letter before the shorter one ends (one can
only extend the other by inserts that lead back to the same state, which cost more), so no
common continuation changes their order.

Rows are dealt by conversation, sorted by turn, and streamed: a task holds one Arrow batch
and the rows of its conversation that are still undecided. Letters on which all surviving
paths agree are settled, taken off the integers and written out every ``BLOCK`` rows, so
the integers stay short in a conversation of any length. (Only where the paths never agree,
as in a conversation without one valid role, do they keep all of it.) A conversation is not
split between tasks because its result is one SHA-256 over all its turns in order.

Defined results. Null ids, turns (in the damage key), roles and texts read as one space;
null ``conv_id`` is one conversation, null turns come first and count in no gap. Rows of one
turn are ordered by role, then text. A role's initial is its first character; an empty role
has none that is legal. Repeated rows are duplicates of the first. An empty table gives no
rows. Other columns of the input are ignored. Texts of any length are handled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkscope.llm.common import ship, sized
from sparkscope.runtime import materialize

RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")
#: Costs of the edits and of a truncated turn that stays; fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Fixed: the states of ``(s?(ua)+)?`` are start, after s, after u, after a; state by initial.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Role of the one user or assistant turn that each state allows next.
NEXT_ROLE = ("user", "user", "assistant", "user")
ENDS = (0, 3)
LEGAL = {"su", "ua", "au"}
#: Digits of the audit: three bits a letter, zero behind the end.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = "\0DIKR"
BITS = 3
#: Rows between two settlements of the common letters.
BLOCK = 64
ENDING = frozenset(".!?")


class Paths:
    """The best path to every state, as ``state: (weight, letters)``.

    A weight is ``cost * 8 ** width + audit digits``; ``width`` is the number of places.
    """

    def __init__(self):
        self.width = 2
        self.best: dict[int, tuple[int, int]] = {0: (0, 0)}
        self.settled_cost = 0

    def widen(self, places: int) -> None:
        """Room for so many further letters, for every path."""
        more = max(n for _, n in self.best.values()) + places - self.width
        if more > 0:
            self.width += more
            self.best = {s: (w << BITS * more, n) for s, (w, n) in self.best.items()}

    def extended(self, path: tuple[int, int], letter: str, cost: int) -> tuple[int, int]:
        weight, n = path
        return weight + (cost << BITS * self.width) + (DIGIT[letter] << BITS * (self.width - 1 - n)), n + 1

    def insert(self) -> None:
        """Up to two turns inserted here; a third would lead back to a state for a higher cost."""
        for _ in range(2):
            for state, path in list(self.best.items()):
                self.offer(self.best, STEPS[state][NEXT_ROLE[state][0]], self.extended(path, "I", INSERT))

    @staticmethod
    def offer(best: dict, state: int, path: tuple[int, int]) -> None:
        if state not in best or path < best[state]:
            best[state] = path

    def row(self, initial: str, required: bool, truncated: bool) -> None:
        self.insert()
        best: dict[int, tuple[int, int]] = {}
        stays = TRUNCATED if truncated else 0
        for state, path in self.best.items():
            self.offer(best, state, self.extended(path, "D", DELETE))
            if not required:
                if initial in STEPS[state]:
                    self.offer(best, STEPS[state][initial], self.extended(path, "K", stays))
                self.offer(best, STEPS[state][NEXT_ROLE[state][0]], self.extended(path, "R", REROLE + stays))
        self.best = best

    def letters(self, path: tuple[int, int]) -> str:
        weight, n = path
        return "".join(LETTER[weight >> BITS * (self.width - 1 - i) & 7] for i in range(n))

    def settle(self) -> str:
        """Take off and return the letters with which every path begins, and the cost all paths have."""
        audits = [self.letters(path) for path in self.best.values()]
        low, high = min(audits), max(audits)
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), len(low))
        cost = min(w for w, _ in self.best.values()) >> BITS * self.width
        keep = self.width - same
        low_digits = (1 << BITS * keep) - 1
        self.best = {s: ((((w >> BITS * self.width) - cost) << BITS * keep) | (w & low_digits), n - same)
                     for s, (w, n) in self.best.items()}
        self.width, self.settled_cost = keep, self.settled_cost + cost
        return low[:same]

    def finish(self) -> str:
        self.widen(2)
        self.insert()
        path = min(self.best[s] for s in ENDS if s in self.best)
        self.best = {ENDS[0]: path}
        return self.settle()


class Conversation:
    """One conversation, row by row in order; ``result()`` after its last row."""

    def __init__(self):
        self.paths, self.hash = Paths(), hashlib.sha256()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.initial = self.before = None
        self.pending: list[tuple[str, str]] = []
        self.taken, self.state, self.audit, self.lines, self.room = 0, 0, [], 0, 0

    def add(self, turn: int | None, role: str, text: str, body_end: str, first: bool) -> None:
        """``body_end``: the last character that is not white space, if any; ``first``: no earlier turn holds role and text."""
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in LEGAL
        self.initial = initial
        repeated = not first or self.before == (turn, role, text)
        self.before = (turn, role, text)
        blank, cut = not body_end, body_end not in ENDING
        self.blank += blank
        self.duplicate += not blank and repeated
        cut = cut and not blank and not repeated
        self.truncated += cut
        if not self.room:
            self.write(self.paths.settle())
            self.room = BLOCK
            self.paths.widen(3 * BLOCK)
        self.room -= 1
        self.paths.row(initial, blank or repeated, cut)
        self.pending.append((role, text))

    def write(self, letters: str) -> None:
        """The turns that settled letters leave, into the hash."""
        for letter in letters:
            if letter != "I":
                role, text = self.pending[self.taken]
                self.taken += 1
            if letter == "D":
                continue
            if letter in "IR":
                role = NEXT_ROLE[self.state]
            self.state = STEPS[self.state][role[:1]]
            self.hash.update(("\n" * (self.lines > 0) + role + ":" + ("" if letter == "I" else text)).encode())
            self.lines += 1
        self.audit.append(letters)
        del self.pending[: self.taken]
        self.taken = 0

    def result(self) -> tuple:
        self.write(self.paths.finish())
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.paths.settled_cost, "".join(self.audit),
                self.hash.hexdigest())


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one result row for each conversation."""
    open_id, conversation, rows, id_type = None, None, [], None
    names = ["conv_id", *(x.split()[0] for x in RESULT.split(", "))]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in RESULT.split(", ")]

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate([id_type, *kinds])], names)

    for batch in batches:
        id_type = batch.column("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "body_end", "first", "dropped")]
        for conv, turn, role, text, end, first, dropped in zip(*columns, strict=True):
            if conversation is None or conv != open_id:
                if conversation is not None:
                    rows.append((open_id, *conversation.result()))
                open_id, conversation = conv, Conversation()
            if not dropped:
                conversation.add(turn, role, text, end, first)
        if rows:
            yield batch_of(rows)
            rows = []
    if conversation is not None:
        yield batch_of([(open_id, *conversation.result())])


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped`` with every fault that the damage rule plants.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (it stays here, marked), 1 empties
    its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"), F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def stripped(text: Column) -> Column:
    """Without white space at its end."""
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def repair_conversations(turns: DataFrame, damage: bool = True) -> DataFrame:
    """One row for each ``conv_id`` of ``turns``: its faults, the cost and audit of its repair, the repaired hash.

    With ``damage`` the rows are damaged first (see ``damaged``); ids whose rows are all
    dropped have zeros, an empty audit and the hash of nothing.
    """
    ship(turns.sparkSession)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    if damage:
        rows = damaged(rows)
    else:
        rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                           F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("dropped"))
    # The first turn of texts that a conversation holds several times; null turns come first.
    same = rows.where(~F.col("dropped")).select("conv_id", F.sha2(F.concat_ws(":", "role", "text"), 256).alias("same"), "role", "turn")
    several = (same.groupBy("conv_id", "role", "same").agg(F.count("*").alias("n"), F.count("turn").alias("n_turns"),
                                                           F.min("turn").alias("first_turn"))
               .where("n > 1").select(F.col("conv_id").alias("of"), "same", F.col("role").alias("of_role"),
                                      F.when(F.col("n") == F.col("n_turns"), F.col("first_turn")).alias("first_turn")))
    several = sized(materialize(several, "several"))
    marked = rows.withColumn("own", F.sha2(F.concat_ws(":", "role", "text"), 256)).join(
        several, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("same")) & (F.col("role") == F.col("of_role")), "left")
    first = F.col("same").isNull() | F.col("turn").eqNullSafe(F.col("first_turn"))
    ready = marked.select("conv_id", "turn", "role", "text", F.right(stripped(F.col("text")), F.lit(1)).alias("body_end"),
                          first.alias("first"), "dropped")
    dealt = ready.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    out = f"conv_id {id_type}, {RESULT}"
    return dealt.mapInArrow(repaired, out)
