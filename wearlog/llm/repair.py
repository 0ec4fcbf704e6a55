"""Conversation structure repair (operator 12): the cheapest edits that make turns alternate.

A repaired conversation is empty or has role initials ``s?(ua)+``. Its turns are kept, given another role,
deleted, or new empty ones are put between them; each edit has a cost. What the rest of a conversation costs
depends only on its turns and on the last initial before them: four states.

Rows are sent to their conversation's partition and sorted by turn, the last first. One pass over the Arrow
batches carries the costs of the four states from batch to batch; every row leaves one byte, the best edit of
each state in two bits. At the first turn the cheapest way is known, and the bytes are read back in the order
of the turns. Bytes and texts of a conversation beyond ``SPILL_BYTES`` are kept in an unnamed file of the
task, like a sort's spill: what a task holds does not grow with a conversation. A lost executor costs the
partition's pass, nothing is read from it later.

Edits are letters (D, I, K, R), of which each leads to one state only; so taking, turn by turn, the smallest
letter that keeps the cost least gives the ASCII-least of the cheapest ways.
"""

import hashlib
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wearlog.llm.flat import column_of
from wearlog.llm.rows import BLANK

#: Of one conversation, in memory.
SPILL_BYTES = 8 << 20
BATCH_ROWS = 2_000
#: Repaired turns that leave a task together are about this many bytes of text.
BATCH_BYTES = 1 << 20

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: The state is the last initial: none, s, u or a. Where an initial leads from it; any other is not allowed.
START, SYSTEM, USER, ASSISTANT = range(4)
LEADS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that a new or changed turn gets, and the state it leads to.
ROLES = ("user", "user", "assistant", "user")
NEXT = (USER, USER, ASSISTANT, USER)
LETTERS = "DIKR"
#: Before any row (that is, behind the last turn) every state costs what it takes to end well.
AT_END = (0, 2 * INSERT, INSERT, 0)

FAULT_BLANK, FAULT_DUPLICATE, FAULT_CUT = 1, 2, 3


def costs_before(costs: tuple, initial: str, fault: int) -> tuple[tuple, int]:
    """The least cost of a turn and all behind it in each state, and the best edits, two bits a state."""
    extra = TRUNCATED if fault == FAULT_CUT else 0
    gone = fault in (FAULT_BLANK, FAULT_DUPLICATE)
    best = []
    for state in range(4):
        cost, letter = costs[state] + DELETE, 0
        if not gone:
            to = LEADS[state].get(initial)
            if to is not None and costs[to] + KEEP + extra < cost:
                cost, letter = costs[to] + KEEP + extra, 2
            if costs[NEXT[state]] + REROLE + extra < cost:
                cost, letter = costs[NEXT[state]] + REROLE + extra, 3
        best.append((cost, letter))
    # New turns: u and a lead to each other, nothing leads to the others. I is less than K and R, not than D.
    with_new = lambda own, to: min(own, (to[0] + INSERT, 1))
    user, assistant = with_new(best[USER], best[ASSISTANT]), with_new(best[ASSISTANT], best[USER])
    both = (with_new(best[START], user), with_new(best[SYSTEM], user), user, assistant)
    return tuple(cost for cost, _ in both), sum(letter << 2 * i for i, (_, letter) in enumerate(both))


class Conversation:
    """One conversation while its rows arrive, the last first."""

    def __init__(self):
        self.costs: tuple = AT_END
        self.edits = tempfile.SpooledTemporaryFile(SPILL_BYTES)
        self.texts = tempfile.SpooledTemporaryFile(SPILL_BYTES)
        self.rows = 0
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.later: str | None = None
        self.turns = 0
        self.least = self.most = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.rows += 1
        self.counts[fault] += 1
        if self.later is not None and role[:1] + self.later not in ("su", "ua", "au"):
            self.illegal += 1
        self.later = role[:1]
        if turn is not None:
            self.turns += turn != self.least
            self.least = turn
            self.most = turn if self.most is None else self.most
        self.costs, edits = costs_before(self.costs, role[:1], fault)
        self.edits.write(bytes([edits]))
        # Sizes stand behind the texts, as they are read backwards.
        role_, text_ = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
        self.texts.write(role_ + text_ + len(role_).to_bytes(8, "little") + len(text_).to_bytes(8, "little"))

    @property
    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.turns

    def _codes(self) -> Iterator[int]:
        """The rows' bytes, the first turn's first."""
        end = self.edits.tell()
        while end:
            begin = max(0, end - (1 << 16))
            self.edits.seek(begin)
            yield from reversed(self.edits.read(end - begin))
            end = begin

    def _back(self) -> Iterator[tuple[bytes, bytes]]:
        """The rows' roles and texts, the first turn's first."""
        end = self.texts.tell()
        while end:
            self.texts.seek(end - 16)
            sizes = self.texts.read(16)
            n_role, n_text = int.from_bytes(sizes[:8], "little"), int.from_bytes(sizes[8:], "little")
            self.texts.seek(end - 16 - n_text - n_role)
            yield self.texts.read(n_role), self.texts.read(n_text)
            end -= 16 + n_text + n_role

    def walk(self) -> Iterator[tuple[str, bytes, bytes]]:
        """The cheapest edits in order, each with the role and text it leaves."""
        state = START
        for code, (role, text) in zip(self._codes(), self._back()):
            letter = LETTERS[code >> 2 * state & 3]
            while letter == "I":
                yield letter, ROLES[state].encode(), b""
                state = NEXT[state]
                letter = LETTERS[code >> 2 * state & 3]
            if letter == "K":
                state = LEADS[state][role[:1].decode()]
            elif letter == "R":
                role, state = ROLES[state].encode(), NEXT[state]
            yield letter, role, text
        while state not in (START, ASSISTANT):
            yield "I", ROLES[state].encode(), b""
            state = NEXT[state]

    def close(self) -> None:
        self.edits.close()
        self.texts.close()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Conversation]]:
    """Whole conversations of sorted rows. A row without role only names its conversation."""
    now, own = None, None
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            columns = [column_of(part, name).to_pylist() for name in ("conv_id", "turn", "role", "text", "fault")]
            for conv, turn, role, text, fault in zip(*columns):
                if own is None or conv != now:
                    if own is not None:
                        yield now, own
                        own.close()
                    now, own = conv, Conversation()
                if role is not None:
                    own.add(turn, role, text, fault)
    if own is not None:
        yield now, own
        own.close()


SUMMARY = (
    "conv_id long, rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
REPAIRED = "conv_id long, place long, edit string, role string, text string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split(" ")[0] for field in SUMMARY.split(", ")]
    kinds = [pa.string() if field.endswith("string") else pa.int64() for field in SUMMARY.split(", ")]
    out: list[tuple] = []
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    for conv, own in _conversations(batches):
        letters, digest, first = [], hashlib.sha256(), True
        for letter, role, text in own.walk():
            letters.append(letter)
            if letter != "D":
                digest.update((b"" if first else b"\n") + role + b":" + text)
                first = False
        audit = "".join(letters)
        faults = own.counts[1:]
        out.append((conv, own.rows, own.gaps, *faults, own.illegal, own.costs[START], audit, digest.hexdigest()))
        size += len(audit) + 200
        if size > BATCH_BYTES:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split(" ")[0] for field in REPAIRED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    out: list[tuple] = []
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    for conv, own in _conversations(batches):
        place = 0
        for letter, role, text in own.walk():
            if letter == "D":
                continue
            out.append((conv, place, letter, role.decode(), text.decode()))
            place += 1
            size += len(text) + 50
            if size > BATCH_BYTES:
                yield batch()
                out, size = [], 0
    if out:
        yield batch()


def with_faults(turns: DataFrame) -> DataFrame:
    """The first fault of each row in ``fault``: 1 blank, 2 duplicate (role and text stood earlier in the
    conversation), 3 truncated (the last character that is not blank ends no sentence), else 0.

    The rows come partitioned by conversation and sorted, the last turn first. Rows of one turn stand in the
    order of role, then text.
    """
    last = F.substring(F.rtrim("text", F.lit(BLANK)), -1, 1)
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn"))
    fault = (
        F.when(last == "", FAULT_BLANK)
        .when(F.col("again") > 1, FAULT_DUPLICATE)
        .when(~last.isin(".", "!", "?"), FAULT_CUT)
        .otherwise(0)
    )
    marked = turns.repartition("conv_id").withColumn("again", again).withColumn("fault", fault.cast("int"))
    back = [F.desc_nulls_last("turn"), *(F.desc(name) for name in ("role", "text", "again"))]
    return marked.sortWithinPartitions("conv_id", *back)


def _prepared(turns: DataFrame, all_ids: DataFrame | None) -> DataFrame:
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )
    if all_ids is not None:
        # A row without role makes its conversation known.
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("turn", "long"), ("role", "string"), ("text", "string"))]
        rows = rows.unionByName(all_ids.select(F.col("conv_id").cast("long").alias("conv_id"), *nothing).distinct())
    return with_faults(rows).select("conv_id", "turn", "role", "text", "fault")


def repair_summary(turns: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and their cost, the repaired text's hash.

    ``turns`` has ``conv_id, turn, role, text``. ``gaps`` are turn numbers missing between the least and the
    greatest; ``illegal`` are neighbours whose role initials are not su, ua or au; ``audit`` has a letter per
    edit (Keep, Rerole, Delete, Insert). ``all_ids`` (column ``conv_id``) adds conversations without a turn.

    - Null roles and texts are taken as one space; turns without a number stand before all others.
    - Rows of the same turn stand in the order of role, then text; of equal rows all but one are duplicates.
    - Rows without a conversation are one conversation, with null as its id.
    - A conversation without turns has zeros, an empty audit and the hash of an empty text.
    - Texts of any length are used as a whole. Other columns are not looked at.
    - A conversation is one task's, as its turns build on one another; in memory it takes ``SPILL_BYTES``
      twice, a batch and its audit, which is a letter per turn.
    """
    return _prepared(turns, all_ids).mapInArrow(_summaries, SUMMARY)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place`` (from 0)``, edit, role, text`` of the turns left.

    Nulls, ties and the rest are as in ``repair_summary``; conversations that lose all turns have no row.
    """
    return _prepared(turns, None).mapInArrow(_repaired, REPAIRED)


def damaged(turns: DataFrame, key: Column) -> DataFrame:
    """Rows spoiled by ``key % 20``: 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats
    it, 4 makes its role user. Null roles and texts become one space."""
    rows = turns.select(
        "conv_id", "turn", key.alias("kind"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).filter("kind <> 0")
    text = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")
