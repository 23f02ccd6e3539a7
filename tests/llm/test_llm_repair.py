"""Conversation repair against the plain cheapest edits of each conversation as a whole."""

import hashlib
import random
import zlib

import __spark_entry__ as entry
import pytest
from fundloom.llm import repair

FOLDER = "/root/testdata/sf0.001"
WHITE = " \t\n\v\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def best(faults, roles):
    """The cheapest edits, ties by letters, from the last row to the first, with whole strings."""
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    n = len(faults)
    # inserts make cycles of length two, so each row's states are settled by repetition
    table = [{"": (0, ""), "a": (0, ""), "u": (2, "I"), "s": (4, "II")}]
    for i in reversed(range(n)):
        after, now = table[-1], {}
        for state in nxt:
            ways = [(after[state][0] + 3, "D" + after[state][1])]
            if faults[i] in ("", "truncated"):
                extra, first = int(faults[i] == "truncated"), roles[i][:1]
                if first == nxt[state] or first == "s" and state == "":
                    ways.append((after[first][0] + extra, "K" + after[first][1]))
                ways.append((after[nxt[state]][0] + extra + 2, "R" + after[nxt[state]][1]))
            now[state] = min(ways)
        for _ in range(3):
            for state in nxt:
                c, w = now[nxt[state]]
                now[state] = min(now[state], (c + 2, "I" + w))
        table.append(now)
    return table[-1][""]


def plain(rows, ids):
    """conv_id -> the contract's columns; rows are in order already."""
    groups = {c: [] for c in ids}
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in mine:
            body = text.rstrip(WHITE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = best(faults, [r[2] for r in mine])
        said, state, row = [], "", 0
        for x in audit:
            new = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            if x == "I":
                said.append(f"{'user' if new == 'u' else 'assistant'}:")
                state = new
                continue
            if x == "K":
                state = mine[row][2][0]
                said.append(f"{mine[row][2]}:{mine[row][3]}")
            if x == "R":
                state = new
                said.append(f"{'user' if new == 'u' else 'assistant'}:{mine[row][3]}")
            row += 1
        assert row == len(mine) and state in ("", "a")
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def some_rows(seed, n):
    """Conversations of all lengths, one of them long, with odd roles, ties and repeated rows."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        conv = r.choice([7, 7, 7, None, *range(20)])
        role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "u", "search"])
        text = r.choice([f"Text {r.randrange(200)}.", f"cut {r.randrange(300)}", "", " \n", None, "Same. ", f"Is it {r.randrange(99)}?\t"])
        rows.append((conv, r.choice([k, k, None, r.randrange(n)]), role, text))
    return rows + [(7, 5, "user", "Hot.")] * (n // 3)


COLUMNS = "conv_id long, turn long, role string, text string"


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = entry.queries()["op11_conversation_repair"](spark, FOLDER)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(out) == plain(damage(rows), {r[0] for r in rows})


@pytest.mark.parametrize("rows,chars,step", [(16_384, 8 << 20, 512), (3, 8 << 20, 2), (50, 100, 7)])
def test_chunks_of_any_size(spark, monkeypatch, rows, chars, step):
    monkeypatch.setattr(repair, "ROWS", rows)
    monkeypatch.setattr(repair, "CHARS", chars)
    monkeypatch.setattr(repair, "STEP", step)
    data = some_rows(rows + step, 500)
    df = spark.createDataFrame(data, COLUMNS).repartition(5)
    want = plain(damage(data), {r[0] for r in data})
    out = got(repair.audit_all(repair.damaged(df), df))
    assert {k: v for k, v in out.items() if v != want[k]} == {} and out.keys() == want.keys()


def test_cost_vectors_against_whole_search():
    r = random.Random(5)
    costs = repair.Costs()
    for _ in range(3000):
        n = r.randrange(9)
        roles = [r.choice(["user", "assistant", "system", "tool"]) for _ in range(n)]
        faults = [r.choice(["", "", "", "truncated", "blank", "duplicate"]) for _ in range(n)]
        number = {"": repair.SOUND, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.CUT}
        codes = bytes(("sua".find(x[0]) if x[0] in "sua" else 3) << 2 | number[f] for x, f in zip(roles, faults))
        numbers, before, _ = costs.backwards(codes, repair.END)
        letters, state = costs.trace(codes, numbers, repair.NEW)
        assert (before[repair.NEW], letters + repair._closing(state)) == best(faults, roles)
    assert len(costs.vectors) < 60


def test_a_pass_stops_where_costs_differ_by_a_constant(monkeypatch):
    monkeypatch.setattr(repair, "STEP", 4)
    r = random.Random(6)
    costs = repair.Costs()
    stopped = 0
    for _ in range(200):
        codes = bytes(r.choice([4, 8, 4, 8, 5, 7, 11, 14, 0]) for _ in range(60))
        first = costs.backwards(codes, repair.END)
        start = [r.randrange(5) for _ in range(4)]
        again = costs.backwards(codes, start, (first[1], first[2]))
        whole = costs.backwards(codes, start)
        assert again[1:] == whole[1:]
        stopped += again[0] is None
    assert stopped > 150


def test_turns(spark, monkeypatch):
    monkeypatch.setattr(repair, "ROWS", 4)
    data = some_rows(11, 200)
    df = spark.createDataFrame(data, COLUMNS)
    found = repair.Repair(df)
    want = got(found.audits())
    said = {}
    for r in sorted(found.turns().collect(), key=lambda r: (r.part, r.chunk, r.pos)):
        said.setdefault(r.conv_id, []).append((r.edit, f"{r.role}:{r.text}"))
    for conv, row in want.items():
        mine = said.get(conv, [])
        assert hashlib.sha256("\n".join(t for _, t in mine).encode()).hexdigest() == row[-1]
        assert "".join(e for e, _ in mine) == row[-2].replace("D", "")


def test_empty_table_and_more_columns(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert repair.audit_all(none, none).count() == 0 and repair.Repair(none).turns().count() == 0
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yo."), (2, 0, "system", "x" * 300_000)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], COLUMNS + ", audit string, part int, letters string")
    out = got(repair.audit_all(df, df))
    assert out[1][:7] == (0, 0, 0, 0, 0, 0, "KK") and out[2] == plain(rows, {1, 2})[2]
