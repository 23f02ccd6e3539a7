"""Chat formatting: turns checked by a finite-state machine, text segments with loss flags from a declarative template."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import shuffle_width
from .common import record, saved


@dataclass(frozen=True)
class Template:
    """How turns look and which of them are learned.

    ``before`` holds the escaped role, ``between`` parts it from the text, ``after`` ends the turn. ``lead`` are the
    characters that control strings begin with; inside roles and texts each of them, and the escape itself, follows an
    escape. ``loss`` names the roles whose texts count. ``moves`` is the machine: from the state after one role to the
    roles that may follow; ``start`` and the roles are its states.
    """

    before: str = "### "
    between: str = ": "
    after: str = " </turn>\n"
    escape: str = "\\"
    lead: str = "<#:\n"
    loss: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant", "tool"), "assistant": ("user", "tool"), "tool": ("assistant", "tool"),
    })

    def escaped(self, text: str) -> str:
        for c in self.escape + self.lead:
            text = text.replace(c, self.escape + c)
        return text

    def plain(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.DOTALL)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The formatted turn, and where its text begins and ends in it."""
        head = f"{self.before}{self.escaped(role)}{self.between}"
        body = self.escaped(text)
        return head + body + self.after, len(head), len(head) + len(body)

    def parse(self, turn: str) -> tuple[str, str]:
        """Role and text of a formatted turn. The first separator that is not escaped ends the role."""
        if not turn.startswith(self.before) or not turn.endswith(self.after):
            raise ValueError("not a formatted turn")
        inner = turn[len(self.before) : len(turn) - len(self.after)]
        at = 0
        while not inner.startswith(self.between, at):
            at += 2 if inner.startswith(self.escape, at) else 1
        return self.plain(inner[:at]), self.plain(inner[at + len(self.between) :])

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The next state and whether the machine allows it; a role it does not know is never allowed and changes nothing."""
        if role not in self.moves or role == "start":
            return state, False
        return role, role in self.moves[state]


TURN = pa.schema([("part", pa.int64()), ("pos", pa.int64()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
                  ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("before", pa.string()), ("after", pa.string())])
TURN_SQL = "part long, pos long, conv_id long, turn long, role string, formatted string, loss_start long, loss_end long, before string, after string"
DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                    ("formatted_chars", pa.int64()), ("valid", pa.bool_())])
DIGEST_SQL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def _format(template: Template):
    """Formats rows in order. The machine runs on within a partition; where one begins its state is not known yet."""
    def run(source):
        part, pos, conv, state = TaskContext.get().partitionId(), 0, None, None
        for batch in source:
            out = []
            for c, n, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if pos and c != conv:
                    state = "start"
                after = role if role in template.moves and role != "start" else state
                whole, start, end = template.turn(role, text)
                if role not in template.loss:
                    start = end = 0
                out.append((part, pos, c, n, role, whole, start, end, state, after))
                pos, conv, state = pos + 1, c, after
            if out:
                yield record(TURN, *zip(*out))
    return run


def format_turns(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: part, pos, conv_id, turn, role, formatted, loss_start, loss_end, allowed.

    (part, pos) is the order of all turns. loss_start and loss_end are code points within ``formatted``, equal where
    nothing is learned; allowed says whether the machine lets the role follow, its state being the last role it knows. Rows
    are put in order of conv_id and turn by ranges, so a long conversation spreads over as many tasks as it needs; each
    range hands on the state it ends in, one row per range. Ties in ``turn`` are ordered by role and text, and a row
    that repeats is a turn of its own. Null roles and texts count as empty; a role the machine does not know is formatted
    and not allowed. Rows without a conv_id form one conversation of their own. A very long text is one row; an empty table
    gives no turns. Other columns are not read.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text"))
    ranged = plain.repartitionByRange(shuffle_width(rows.sparkSession), "conv_id", "turn", "role", F.xxhash64("text")).sortWithinPartitions("conv_id", "turn", "role", F.xxhash64("text"), "text")
    done = saved(ranged.mapInArrow(_format(template), TURN_SQL), "turns")
    # one row per range
    edges = done.groupBy("part").agg(F.min(F.struct("pos", "conv_id")).alias("head"), F.max(F.struct("pos", "conv_id", "after")).alias("tail")).orderBy("part").collect()
    entering, conv, state = {}, None, "start"
    for e in edges:
        entering[e.part] = state if e.head.conv_id == conv else "start"
        state = e.tail.after or entering[e.part]
        conv = e.tail.conv_id
    known = F.lit([entering.get(p, "start") for p in range(max(entering, default=0) + 1)])
    allowed = F.lit(False)
    before = F.coalesce("before", F.element_at(known, F.col("part").cast("int") + 1))
    for of, to in template.moves.items():
        allowed = F.when(before == of, F.col("role").isin(list(to))).otherwise(allowed)
    return done.select("part", "pos", "conv_id", "turn", "role", "formatted", "loss_start", "loss_end", allowed.alias("allowed"))


def _digest(template: Template):
    """Reads formatted turns back, conversation by conversation; only running sums are held."""
    def run(source):
        conv, held = None, None

        def closed():
            n, turns, chars, loss, size, valid = held
            return record(DIGEST, [conv], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [size], [valid])

        for batch in source:
            for c, whole, start, end, ok in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held is None or c != conv:
                    if held:
                        yield closed()
                    conv, held = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                role, text = template.parse(whole)
                learned = template.plain(whole[start:end])
                held[0] += 1
                held[1].update(f"{role}\n{text}\n".encode())
                held[2] += len(learned)
                held[3].update(learned.encode())
                held[4] += len(whole)
                held[5] = held[5] and ok
        if held:
            yield closed()
    return run


def digests(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """What each conversation says, read back from its formatted turns, one row per conversation.

    A hash over a conversation needs its turns one after the other, so one task reads each conversation, as a sorted
    stream: a very long one takes time there, not memory.
    """
    by_conv = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return by_conv.select("conv_id", "formatted", "loss_start", "loss_end", "allowed").mapInArrow(_digest(template), DIGEST_SQL)
