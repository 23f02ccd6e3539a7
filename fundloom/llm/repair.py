"""Repair of conversations by cheapest edits: rank-convergence parallel Viterbi over chunks of turns.

The states are what the repaired roles so far end in. Going backwards, a row turns the costs from each state to the end
into the costs from each state before it. Conversations that lie within one chunk are solved where they are read. Long
ones, and those at the ends of a range of rows, are solved chunk by chunk in parallel: each chunk starts from a
speculative cost vector. What happens within a chunk depends on the vector at its right end only up to a constant, and
soon not even on that, so a fix-up pass runs from the vector that really came in until its costs differ from those of an
earlier pass by one constant only. A chunk that hands on what comes in makes the vector that came in the next
speculation for all chunks before it, so the number of passes is bounded by the number of different vectors, not of
chunks. The stitched costs then drive the trace: from left to right always the edit with the least letter that keeps to
the least cost, for each state that a chunk may be entered in; the chunks' exits are put together last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import shuffle_width
from .common import batches, record, saved, worker_state

#: White space, what ends a whole sentence, and the costs of edits.
WHITE, ENDS = " \t\n\v\f\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after a system row, after a user row, after an assistant row.
NEW, SYSTEM, USER, ASSISTANT = range(4)
#: What a new row becomes in a state, and what a row that stays may be: initial (s, u, a as 0, 1, 2) and next state.
NEXT = (USER, USER, ASSISTANT, USER)
KEEPS = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Faults in the order in which they count.
SOUND, BLANK, DUPLICATE, CUT = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Costs to the end after the last row.
END = (0, 4, 2, 0)
#: Rows and characters of a chunk, at least one row; and rows between two places where passes are compared.
ROWS, CHARS, STEP = 16_384, 8 << 20, 512

CHUNK = pa.schema([
    ("part", pa.int64()), ("chunk", pa.int64()), ("conv_id", pa.int64()), ("open", pa.bool_()), ("codes", pa.binary()), ("t_first", pa.int64()), ("t_last", pa.int64()),
    ("t_distinct", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("digests", pa.binary()), ("cost", pa.int64()), ("audit", pa.string())])
CHUNK_SQL = ("part long, chunk long, conv_id long, open boolean, codes binary, t_first long, t_last long, t_distinct long, roles array<string>, "
             "texts array<string>, digests binary, cost long, audit string")


class Costs:
    """Cost vectors less their least number, and what each row does to them; both are few and kept."""

    def __init__(self):
        self.vectors, self.number, self.steps, self.moves = [], {}, {}, {}

    def known(self, vector) -> tuple[int, int]:
        """The number of the vector less its least entry, and that entry."""
        low = min(vector)
        key = tuple(v - low for v in vector)
        at = self.number.setdefault(key, len(self.vectors))
        if at == len(self.vectors):
            self.vectors.append(key)
        return at, low

    def _before(self, vector, code: int) -> list[int]:
        """Costs from each state to the end, the next thing being this row or a new one before it."""
        first, fault = code >> 2, code & 3
        costs = [DELETE + v for v in vector]
        if fault in (SOUND, CUT):
            extra = TRUNCATED if fault == CUT else 0
            for state in range(4):
                kept = KEEPS[state].get(first)
                costs[state] = min(costs[state], REROLE + extra + vector[NEXT[state]], costs[state] if kept is None else extra + vector[kept])
        user, assistant = costs[USER], costs[ASSISTANT]
        costs[USER], costs[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
        return [min(costs[s], INSERT + costs[USER]) if s in (NEW, SYSTEM) else costs[s] for s in range(4)]

    def step(self, at: int, code: int) -> tuple[int, int]:
        key = at << 4 | code
        if key not in self.steps:
            self.steps[key] = self.known(self._before(self.vectors[at], code))
        return self.steps[key]

    def move(self, at: int, code: int, state: int) -> tuple[str, int]:
        """The least letters of cheapest edits up to and with this row, where vector ``at`` holds after it; and the next state."""
        key = at << 6 | code << 2 | state
        if key not in self.moves:
            after = self.vectors[at]
            costs, first, fault, letters = self._before(after, code), code >> 2, code & 3, ""
            extra = TRUNCATED if fault == CUT else 0
            while True:
                cost, kept = costs[state], KEEPS[state].get(first)
                if cost == DELETE + after[state]:
                    letters += "D"
                elif cost == INSERT + costs[NEXT[state]]:
                    letters, state = letters + "I", NEXT[state]
                    continue
                elif kept is not None and cost == extra + after[kept]:
                    letters, state = letters + "K", kept
                else:
                    letters, state = letters + "R", NEXT[state]
                break
            self.moves[key] = letters, state
        return self.moves[key]

    def backwards(self, codes: bytes, vector, earlier=None):
        """Vector numbers after each row, costs before the first row, and costs at every ``STEP`` rows from the right.

        ``earlier`` is (costs before the first row, costs at the steps) of another pass over the rows: where the costs
        differ from those by a constant, the rest is known.
        """
        at, total = self.known(vector)
        numbers, marks = [at], []
        for k, code in enumerate(reversed(codes)):
            if k % STEP == 0 and k:
                now = [v + total for v in self.vectors[at]]
                marks.append(now)
                if earlier is not None:
                    apart = {a - b for a, b in zip(now, earlier[1][len(marks) - 1])}
                    if len(apart) == 1:
                        shift = apart.pop()
                        return None, [v + shift for v in earlier[0]], marks + [[v + shift for v in m] for m in earlier[1][len(marks):]]
            at, low = self.steps.get(at << 4 | code) or self.step(at, code)
            total += low
            numbers.append(at)
        return numbers[::-1], [v + total for v in self.vectors[at]], marks

    def trace(self, codes: bytes, numbers: list[int], state: int) -> tuple[str, int]:
        letters = []
        for code, at in zip(codes, numbers[1:]):
            said, state = self.moves.get(at << 6 | code << 2 | state) or self.move(at, code, state)
            letters.append(said)
        return "".join(letters), state


def _costs() -> Costs:
    return worker_state("repair_costs", Costs)


def _closing(state: int) -> str:
    """Edits after the last row."""
    return {SYSTEM: "II", USER: "I"}.get(state, "")


def _code(role: str, text: str, again: bool) -> int:
    body = text.rstrip(WHITE)
    fault = BLANK if not body else DUPLICATE if again else SOUND if body[-1] in ENDS else CUT
    return ("sua".find(role[0]) if role[:1] and role[0] in "sua" else 3) << 2 | fault


def applied(letters: str, state: int, roles, texts):
    """(letter, role, text) of each row that the edits leave, from the state before them."""
    row = 0
    for letter in letters:
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            role, text = roles[row], texts[row]
            state = KEEPS[state]["sua".find(role[0])]
        else:
            state = NEXT[state]
            role, text = ROLES[state], "" if letter == "I" else texts[row]
        row += letter != "I"
        yield letter, role, text


def _chunked(source):
    """Rows in order become chunks of one conversation each; those that are surely whole are solved at once."""
    part, number, conv, held, size, begun = TaskContext.get().partitionId(), 0, None, [], 0, False
    costs = _costs()

    def chunk(is_open: bool):
        seen, codes, last = set(), bytearray(), None
        distinct, first = 0, None
        for turn, role, text in held:
            codes.append(_code(role, text, (role, text) in seen))
            seen.add((role, text))
            if turn is not None and turn != last:
                distinct, last, first = distinct + 1, turn, turn if first is None else first
        codes = bytes(codes)
        roles, texts = [r for _, r, _ in held], [t for _, _, t in held]
        digests, cost, letters = None, None, None
        if is_open:
            digests = b"".join(hashlib.blake2b(f"{conv}:{len(r)}:{r}{t}".encode(), digest_size=16).digest() for _, r, t in held)
        else:
            numbers, before, _ = costs.backwards(codes, END)
            letters, state = costs.trace(codes, numbers, NEW)
            cost, letters = before[NEW], letters + _closing(state)
        return part, number, conv, is_open, codes, first, last, distinct, roles, texts, digests, cost, letters

    # the first conversation may have begun in the range before, a conversation that was cut goes on
    uncertain, done, chars = True, [], 0
    for batch in source:
        for c, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            new = begun and c != conv
            if held and (new or len(held) >= ROWS or size + len(text) > CHARS):
                done.append(chunk(uncertain or not new))
                chars += size
                uncertain, number, held, size = not new, number + 1, [], 0
                if len(done) >= 1000 or chars >= CHARS:
                    yield record(CHUNK, *zip(*done))
                    done, chars = [], 0
            begun, conv = True, c
            held.append((turn, role, text))
            size += len(text)
    if held:
        done.append(chunk(True))
    if done:
        yield record(CHUNK, *zip(*done))


def _digest_rows(source):
    """One row for each different text that a chunk is the first of its own to say; blank rows are none."""
    schema = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("pos", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])
    for batch in source:
        for part, chunk, codes, digests in zip(*(batch.column(i).to_pylist() for i in range(4))):
            fault = np.frombuffer(codes, np.uint8) & 3
            pos = np.flatnonzero((fault != BLANK) & (fault != DUPLICATE))
            both = np.frombuffer(digests, "<i8").reshape(-1, 2)[pos]
            yield record(schema, np.full(len(pos), part), np.full(len(pos), chunk), pos.astype(np.int32), both[:, 0], both[:, 1])


def _recoded(source):
    """Codes with the duplicates of earlier chunks marked."""
    for batch in source:
        codes = []
        for mine, late in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            new = np.frombuffer(mine, np.uint8).copy()
            if late:
                new[late] = new[late] & 0b1100 | DUPLICATE
            codes.append(new.tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes, pa.binary())], names=["conv_id", "part", "chunk", "codes"])


TRIED = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("vin", pa.list_(pa.int64())), ("vout", pa.list_(pa.int64())), ("marks", pa.list_(pa.list_(pa.int64())))])
TRIED_SQL = "part long, chunk long, vin array<long>, vout array<long>, marks array<array<long>>"


def _tried(source):
    """A pass over chunks: part, chunk, codes, the vector to start from, and what an earlier pass found (null: none)."""
    costs = _costs()
    for batch in source:
        rows = []
        for part, chunk, codes, vin, vout, marks in zip(*(batch.column(i).to_pylist() for i in range(6))):
            _, before, now = costs.backwards(codes, vin, None if vout is None else (vout, marks))
            rows.append((part, chunk, vin, before, now))
        yield record(TRIED, *(zip(*rows) if rows else [[]] * 5))


ASKED = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("vin", pa.list_(pa.int64())), ("sure", pa.bool_())])


def _seams(table: pa.Table) -> pa.Table:
    """The vectors of one conversation's chunks from right to left, as far as passes have found them; else what to try next."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("part", "chunk", "tried"))), key=lambda r: r[:2], reverse=True)
    vector, out = list(END), []
    for k, (part, chunk, tried) in enumerate(rows):
        low = min(vector)
        plain = [v - low for v in vector]
        found = next((t["vout"] for t in tried if t["vin"] == plain), None)
        if found is None:
            # what came in is tried in this chunk and in all before it
            out = [(p, c, plain, False) for p, c, known in rows[k:] if all(t["vin"] != plain for t in known)]
            break
        out.append((part, chunk, vector, True))
        vector = [v + low for v in found]
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out), ASKED)], schema=ASKED)


TRACED = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("cost", pa.int64()), ("exits", pa.list_(pa.int32())), ("pieces", pa.list_(pa.string()))])


def _traced(source):
    """For each state in which a chunk may be entered: the edits and the state after them."""
    costs = _costs()
    for batch in source:
        rows = []
        for part, chunk, codes, vin in zip(*(batch.column(i).to_pylist() for i in range(4))):
            numbers, before, _ = costs.backwards(codes, vin)
            ways = [costs.trace(codes, numbers, s) for s in range(4)]
            rows.append((part, chunk, before[NEW], [s for _, s in ways], [w for w, _ in ways]))
        yield record(TRACED, *(zip(*rows) if rows else [[]] * 5))


ENTERED = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("enter", pa.int32()), ("closing", pa.string()), ("odd", pa.int64()), ("shared", pa.int64()), ("first", pa.bool_())])


def _entered(table: pa.Table) -> pa.Table:
    """The chunks of one conversation from left to right: the state each is entered in, and what lies on its left border."""
    names = ("part", "chunk", "exits", "head", "tail", "t_first", "t_last")
    out, state, before, last = [], NEW, None, None
    rows = sorted(zip(*(table.column(c).to_pylist() for c in names)), key=lambda r: r[:2])
    for k, (part, chunk, exits, head, tail, t_first, t_last) in enumerate(rows):
        odd = before is not None and (before >> 2, head >> 2) not in LEGAL
        shared = last is not None and t_first == last
        after = exits[state]
        out.append((part, chunk, state, _closing(after) if k == len(rows) - 1 else "", int(odd), int(shared), k == 0))
        state, before, last = after, tail, last if t_last is None else t_last
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out), ENTERED)], schema=ENTERED)


def _counts(codes: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose roles may not follow each other."""
    own = np.frombuffer(codes, np.uint8)
    n = np.bincount(own & 3, minlength=4)
    first = own >> 2
    legal = ((first[:-1] == 0) & (first[1:] == 1)) | ((first[:-1] == 1) & (first[1:] == 2)) | ((first[:-1] == 2) & (first[1:] == 1))
    return int(n[BLANK]), int(n[DUPLICATE]), int(n[CUT]), int((~legal).sum())


COUNTED = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64())])
COUNTED_SQL = "part long, chunk long, blank long, duplicate long, truncated long, illegal long"


def _counted(source):
    for batch in source:
        n = [_counts(c) for c in batch.column(2).to_pylist()]
        yield record(COUNTED, batch.column(0), batch.column(1), *(zip(*n) if n else [[]] * 4))


def _hashed(source):
    """conv_id and the hash of its repaired rows; chunks of a conversation follow each other."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    conv, running, some, begun = None, None, False, False
    for batch in batches(source):
        out = []
        for c, letters, state, roles, texts in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if not begun or c != conv:
                if begun:
                    out.append((conv, running.hexdigest()))
                begun, conv, running, some = True, c, hashlib.sha256(), False
            for _, role, text in applied(letters, state, roles, texts):
                running.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                some = True
        if out:
            yield record(schema, *zip(*out))
    if begun:
        yield record(schema, [conv], [running.hexdigest()])


AUDIT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
AUDIT_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _audited(source):
    """Audits of conversations that are whole."""
    for batch in batches(source):
        out = []
        for conv, codes, first, last, distinct, cost, letters, roles, texts in zip(*(c.to_pylist() for c in batch.columns)):
            said = "\n".join(f"{role}:{text}" for _, role, text in applied(letters, NEW, roles, texts))
            out.append((conv, 0 if first is None else last - first + 1 - distinct, *_counts(codes), cost, letters, hashlib.sha256(said.encode()).hexdigest()))
        if out:
            yield record(AUDIT, *zip(*out))


def _turns(source):
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("chunk", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    for batch in batches(source):
        for c, letters, state, roles, texts, part, chunk in zip(*(batch.column(i).to_pylist() for i in range(7))):
            rows = [(c, part, chunk, k, *r) for k, r in enumerate(applied(letters, state, roles, texts))]
            if rows:
                yield record(schema, *zip(*rows))


class Repair:
    """Cheapest edits of every conversation of ``rows`` (conv_id, turn, role, text; other columns are not read).

    Rows of a conversation are taken by turn, null turns first, ties by role, then the text's first 64 characters, then a
    hash of it. A null role or text counts as one space. A row is blank if it has nothing but white space, a duplicate if
    a row before it has its role and text, truncated if its last character that is no white space ends no sentence; the
    first of these counts. Roles count by their initials; the repaired ones are nothing, or pairs of user and assistant
    after at most one system row. Blank and duplicate rows must go. Rows without a conv_id are one conversation. An empty
    table gives empty tables.

    Memory: a task holds one chunk of rows; a very long text is a chunk by itself. A conversation within a range of rows never leaves it; of the others, chunks
    are solved in parallel, what meets by conversation are four numbers a chunk, and only the hash reads their texts in
    order, in one task, as a stream.
    """

    def __init__(self, rows: DataFrame):
        said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role"), said("text"))
        # equal rows may come in any order, so their places part them
        order = ["conv_id", "turn", "role", "start", "hash", "place"]
        ranged = plain.withColumns({"start": F.substring("text", 1, 64), "hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()}).repartitionByRange(
            shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
        self.chunks = saved(ranged.select("conv_id", "turn", "role", "text").mapInArrow(_chunked, CHUNK_SQL), "chunks")
        self.long = self._solved(self.chunks.filter("open"))

    def _solved(self, chunks: DataFrame) -> DataFrame:
        """part, chunk, conv_id, letters, state, first, and the counts of each open chunk."""
        spark = chunks.sparkSession
        said = saved(chunks.select("part", "chunk", "codes", "digests").mapInArrow(_digest_rows, "part long, chunk long, pos int, d1 long, d2 long"), "said")
        first = said.groupBy("d1", "d2").agg(F.min(F.struct("part", "chunk")).alias("f"), F.count("*").alias("n")).filter("n > 1").select("d1", "d2", "f")
        late = said.join(first, ["d1", "d2"]).filter(F.struct("part", "chunk") != F.col("f")).groupBy("part", "chunk").agg(F.collect_list("pos").alias("late"))
        coded = saved(chunks.select("conv_id", "part", "chunk", "codes").join(late, ["part", "chunk"], "left").select("conv_id", "part", "chunk", "codes", "late").mapInArrow(
            _recoded, "conv_id long, part long, chunk long, codes binary"), "codes")
        none = [F.lit(None).cast("array<long>").alias("vout"), F.lit(None).cast("array<array<long>>").alias("marks")]
        tried = [saved(coded.select("part", "chunk", "codes", F.lit(list(END)).cast("array<long>").alias("vin"), *none).mapInArrow(_tried, TRIED_SQL), "pass")]
        while True:
            known = tried[0]
            for more in tried[1:]:
                known = known.union(more)
            by_chunk = known.groupBy("part", "chunk").agg(F.collect_list(F.struct("vin", "vout")).alias("tried"))
            asked = saved(coded.select("conv_id", "part", "chunk").join(by_chunk, ["part", "chunk"]).groupBy("conv_id").applyInArrow(
                _seams, "part long, chunk long, vin array<long>, sure boolean"), "seams")
            again = asked.filter("NOT sure")
            if again.isEmpty():
                break
            tried.append(saved(again.select("part", "chunk", "vin").join(coded, ["part", "chunk"]).join(tried[0].select("part", "chunk", "vout", "marks"), ["part", "chunk"])
                               .select("part", "chunk", "codes", "vin", "vout", "marks").mapInArrow(_tried, TRIED_SQL), "pass"))
        traced = saved(coded.join(asked, ["part", "chunk"]).select("part", "chunk", "codes", "vin").mapInArrow(
            _traced, "part long, chunk long, cost long, exits array<int>, pieces array<string>"), "traced")
        edge = lambda at: F.ascii(F.substring("codes", at, 1).cast("string"))
        border = coded.select("conv_id", "part", "chunk", edge(1).alias("head"), edge(-1).alias("tail"))
        entered = saved(
            border.join(traced.select("part", "chunk", "exits"), ["part", "chunk"]).join(chunks.select("part", "chunk", "t_first", "t_last"), ["part", "chunk"])
            .groupBy("conv_id").applyInArrow(_entered, "part long, chunk long, enter int, closing string, odd long, shared long, first boolean"), "entered")
        counted = coded.select("part", "chunk", "codes").mapInArrow(_counted, COUNTED_SQL)
        return saved(
            coded.select("conv_id", "part", "chunk").join(traced, ["part", "chunk"]).join(entered, ["part", "chunk"]).join(counted, ["part", "chunk"])
            .join(chunks.select("part", "chunk", "t_first", "t_last", "t_distinct"), ["part", "chunk"])
            .select("part", "chunk", "conv_id", F.concat(F.element_at("pieces", F.col("enter") + 1), "closing").alias("letters"), F.col("enter").alias("state"),
                    F.when(F.col("first"), F.col("cost")).alias("cost"), "blank", "duplicate", "truncated", (F.col("illegal") + F.col("odd")).alias("illegal"),
                    "t_first", "t_last", (F.col("t_distinct") - F.col("shared")).alias("t_distinct")), "solved")

    def _with_texts(self) -> DataFrame:
        """Open chunks with their edits and texts."""
        return self.long.join(self.chunks.filter("open").select("part", "chunk", "roles", "texts"), ["part", "chunk"])

    def turns(self) -> DataFrame:
        """The repaired rows: conv_id, (part, chunk, pos) for their order, edit (K, R or I), role and text."""
        short = self.chunks.filter("NOT open").select("conv_id", F.col("audit").alias("letters"), F.lit(NEW).alias("state"), "roles", "texts", "part", "chunk")
        return short.union(self._with_texts().select(short.columns)).mapInArrow(
            _turns, "conv_id long, part long, chunk long, pos long, edit string, role string, text string")

    def audits(self) -> DataFrame:
        """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        short = self.chunks.filter("NOT open").select("conv_id", "codes", "t_first", "t_last", "t_distinct", "cost", "audit", "roles", "texts").mapInArrow(_audited, AUDIT_SQL)
        hashes = self._with_texts().select("conv_id", "part", "chunk", "letters", "state", "roles", "texts").repartition("conv_id").sortWithinPartitions(
            "conv_id", "part", "chunk").select("conv_id", "letters", "state", "roles", "texts").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
        pieces = F.sort_array(F.collect_list(F.struct("part", "chunk", "letters")))
        long = self.long.groupBy("conv_id").agg(
            F.coalesce(F.max("t_last") - F.min("t_first") + 1 - F.sum("t_distinct"), F.lit(0)).alias("gaps"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.max("cost").alias("cost"),
            F.array_join(F.transform(pieces, lambda p: p["letters"]), "").alias("audit")).alias("a")
        return short.union(long.join(hashes.alias("h"), F.col("a.conv_id").eqNullSafe(F.col("h.conv_id"))).select("a.*", "repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with faults put in by the hash of conv_id and turn: rows dropped, emptied, cut, repeated, or with another role."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    hit = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind")).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return hit.withColumn("times", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def audit_all(rows: DataFrame, present: DataFrame) -> DataFrame:
    """The audits of ``rows`` for every conv_id of ``present``; one without rows has zeros, no edits and the hash of nothing."""
    ids = present.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("i")
    found = Repair(rows).audits().alias("f")
    zero = [F.coalesce(F.col(f"f.{c}"), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(found, F.col("i.conv_id").eqNullSafe(F.col("f.conv_id")), "left").select(
        "i.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
