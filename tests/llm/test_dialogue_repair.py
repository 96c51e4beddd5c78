import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from comanda.llm import dialogue_repair, queries

ROWS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        marks = WORD.findall(text)
        kind = "blank" if not marks else "duplicate" if (role, text) in seen else "cut" if marks[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append(kind)
    return found


def plain_repair(rows):
    """(cost, audit, repaired rows) by going through all states row by row, audits and all."""
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    state_of = {"s": 1, "u": 2, "a": 3}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):
            for q, (cost, audit, out) in list(best.items()):
                to = state_of[step[q]]
                new = (cost + 2, audit + "I", (*out, (names[step[q]], "")))
                best[to] = min(best.get(to, new), new)
        return best

    best = inserted({0: (0, "", ())})
    for (role, text), fault in zip(rows, faults(rows)):
        after = {}
        for q, (cost, audit, out) in best.items():
            options = [(q, (cost + 3, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = fault == "cut"
                options.append((state_of[step[q]], (cost + 2 + more, audit + "R", (*out, (names[step[q]], text)))))
                if role[:1] == step[q] or (q == 0 and role[:1] == "s"):
                    options.append((state_of[role[:1]], (cost + more, audit + "K", (*out, (role, text)))))
            for to, new in options:
                after[to] = min(after.get(to, new), new)
        best = inserted(after)
    return min(best[q] for q in (0, 3) if q in best)


def expected(rows):
    """Report and digest of each conversation of (conv_id, turn, role, text) rows."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), turn, text))
    out = {}
    for conv, group in groups.items():
        group.sort(key=lambda r: r[:4])
        turns = [r[4] for r in group if r[4] is not None]
        own = [(r[2], r[5]) for r in group]
        found, initials = faults(own), [role[:1] for role, _ in own]
        cost, audit, repaired = plain_repair(own)
        assert GRAMMAR.fullmatch("".join(role[:1] for role, _ in repaired))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(found.count(k) for k in ("blank", "duplicate", "cut")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


EMPTY = hashlib.sha256(b"").hexdigest()
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def found(df, block=dialogue_repair.BLOCK):
    repair = dialogue_repair.Repair(df, block)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests().collect()}
    return {r.conv_id: (*(r[c] for c in REPORT), digests.get(r.conv_id, EMPTY)) for r in repair.report().collect()}


def made(count, longest, seed=1):
    draw = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = draw.choice(["Yes.", "No!", "cut", "", " \n", None, f"Word {draw.random()}.", f"Word {draw.random()}", "Ok? \t"])
            rows.append((conv, draw.choice([turn, turn, turn, turn // 2, None]), role, text))
    return rows


@pytest.mark.parametrize("block", [1, 3, 512])
def test_repairs_equal_the_plain_way(spark, block):
    rows = made(120, 12)
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("x") for c in ("copies", "fault", "part", "done", "c", "n")})
    assert found(df, block) == expected(rows)


def test_a_conversation_over_many_tasks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(dialogue_repair, "FAN", 4)
    rows = made(1, 2, 3) + [(7, t, r, x) for _, t, r, x in made(1, 1, 5)]
    draw = random.Random(9)
    for turn in range(900):
        text = draw.choice(["Yes.", f"t {turn}.", f"t {turn}", ""])
        rows.append((7, turn, draw.choice(["user", "assistant", "system"]), text))
    rows += [(8, 1, "user", "same.")] * 40
    assert found(spark.createDataFrame(rows, ROWS), 16) == expected(rows)


def test_null_conversations_turns_and_an_empty_table(spark):
    rows = [(None, None, None, None), (None, 2, "user", "a."), (None, 5, "assistant", "b."), (1, None, "user", "x."), (2, 3, "", "")]
    assert found(spark.createDataFrame(rows, ROWS)) == expected(rows)
    assert found(spark.createDataFrame([], ROWS)) == {}


def test_a_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", " " * 500_000 + "a")]
    assert found(spark.createDataFrame(rows, ROWS)) == expected(rows)


def test_steps_give_roles_and_texts(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "assistant", ""), (1, 3, "user", "u.")]
    steps = dialogue_repair.Repair(spark.createDataFrame(rows, ROWS)).steps().orderBy("step").collect()
    assert [(r.edit, r.role, r.text) for r in steps] == [
        ("K", "system", "s."), ("R", "user", "a."), ("D", None, None), ("R", "assistant", "u.")
    ] or "".join(r.edit for r in steps) == expected(rows)[1][6]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def test_registered_query(spark, tmp_path):
    read = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in read.collect()]
    gone = next(c for c in range(10**6, 10**7) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "a."), (None, 1, None, None), (None, None, "user", None)]
    spark.createDataFrame(rows, ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    want = expected(damaged(rows))
    table = queries.QUERIES["op13_dialogue_repair"](spark, str(tmp_path))
    got = {r.conv_id: (*(r[c] for c in REPORT), r.repaired_sha256) for r in table.collect()}
    assert set(got) == {r[0] for r in rows}
    assert got == {c: want.get(c, (0, 0, 0, 0, 0, 0, "", EMPTY)) for c in got}
