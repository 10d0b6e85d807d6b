"""Repairs against all edits by exhaustive search, and the planted faults against a plain loop."""

import hashlib
import random
import zlib

import pytest

from matchguard.llm import dialogue_repair as dr

SCHEMA = "conv_id long, turn long, role string, text string, copies int, digest string"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Least (cost, audit) of a list of (initial, cut, gone), by trying every edit from the end on; at most two inserts in a row can pay."""
    def legal(out):
        body = out[1:] if out[:1] == "s" else out
        return out == "" or (body and body == "ua" * (len(body) // 2) and len(body) % 2 == 0)

    best, todo = (10**9, ""), [(0, 0, "", "")]
    limit = sum(4 for _ in rows)
    while todo:
        i, cost, audit, out = todo.pop()
        if cost > limit or (cost, audit) > best and cost > best[0]:
            continue
        if i == len(rows) and legal(out):
            best = min(best, (cost, audit))
        want = "u" if out in ("", "s") or out[-1] == "a" else "a"
        if not audit.endswith("II"):
            todo.append((i, cost + 3, audit + "I", out + want))
        if i < len(rows):
            who, cut, gone = rows[i]
            todo.append((i + 1, cost + 4, audit + "D", out))
            if not gone:
                todo.append((i + 1, cost + 3 + 3 * cut, audit + "R", out + want))
                if who == want or out == "" and who == "s":
                    todo.append((i + 1, cost + 3 * cut, audit + "K", out + who))
    return best


def code(row):
    who, cut, gone = row
    return " sua".index(who) | (4 if cut else 0) | (8 if gone else 0)


def test_search_finds_the_least_edits():
    rng = random.Random(3)
    for _ in range(400):
        rows = [(rng.choice(" suuaa"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(7))]
        assert dr.search(bytes(map(code, rows))) == cheapest(rows), rows


def test_stretches_change_nothing(monkeypatch):
    rng = random.Random(4)
    cases = [bytes(rng.choice([0, 1, 2, 3, 2, 3, 6, 7, 8, 11]) for _ in range(rng.randrange(5, 60))) for _ in range(200)]
    whole = [dr.search(c) for c in cases]
    monkeypatch.setattr(dr, "STRETCH", 3)
    assert [dr.search(c) for c in cases] == whole


def test_bounds_are_never_above_the_cost():
    rng = random.Random(5)
    for _ in range(300):
        rows = bytes(rng.choice([0, 1, 2, 3, 5, 6, 7, 8, 11]) for _ in range(rng.randrange(12)))
        assert all(b <= dr.search(rows[i:])[0] for i, b in enumerate(dr.lower_bounds(rows)))


def test_time_grows_with_the_length():
    import time

    rng = random.Random(6)
    rows = bytes(rng.choice([0, 1, 6, 7, 10, 11, 2, 3]) if rng.random() < 0.25 else 2 + i % 2 for i in range(40_000))
    began = time.time()
    cost, audit = dr.search(rows)
    assert time.time() - began < 20 and len(audit.replace("I", "")) == len(rows) and cost > 0


def expected(table):
    """The whole contract by plain loops, with the search above replaced by the exhaustive one."""
    out, convs = {}, {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
        rows += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, coded, blank, again, cut = set(), [], 0, 0, 0
        for _, role, text in rows:
            bare, twice = text.rstrip(WHITE), (role, text) in seen
            seen.add((role, text))
            end = bool(bare) and not twice and bare[-1] not in ".!?"
            blank, again, cut = blank + (not bare), again + (bool(bare) and twice), cut + end
            coded.append((role[:1] if role[:1] in ("s", "u", "a") else " ", end, not bare or twice))
        pairs = [a[0] + b[0] for a, b in zip(coded, coded[1:])]
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit = cheapest(coded)
        said, i, opened = [], 0, False
        for e in audit:
            turn_of = "user" if (len(said) - opened) % 2 == 0 else "assistant"
            if e == "I":
                said.append(turn_of + ":")
                continue
            _, role, text = rows[i]
            i += 1
            if e == "K":
                opened = opened or (not said and role[:1] == "s")
                said.append(f"{role}:{text}")
            elif e == "R":
                said.append(f"{turn_of}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, blank, again, cut, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def run(spark, table):
    df = spark.createDataFrame([(*r, 9, "clash") for r in table], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in dr.repair(dr.damage(df)).collect()}
    return got


def random_table(seed, n=60):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "usher", "tool", "", None])
            out.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice(["A b.", "Why?", "cut off", " \n", "", None, "ends. \t", "Ünï!", "x" * 50_000 + "."])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_contract(spark, seed):
    table = random_table(seed) + [(None, None, "user", "Hi."), (None, 1, "assistant", "Yes."), (None, 1, "assistant", "Yes.")]
    rng = random.Random(seed)
    rng.shuffle(table)
    assert run(spark, table) == expected(table)


def test_dropped_conversations_stay(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(conv, 0, "user", "Hi.")]) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_a_long_conversation_of_repeats(spark):
    turns = [(1, i, "user" if i % 2 == 0 else "assistant", "Same." if i % 3 else f"Line {i}.") for i in range(3000)]
    df = spark.createDataFrame([(*t, 1, "x") for t in turns], SCHEMA)
    (row,) = dr.repair(df).collect()
    firsts = {}
    for _, i, role, text in turns:
        firsts.setdefault((role, text), i)
    gone = [firsts[(role, text)] != i for _, i, role, text in turns]
    assert row["duplicate"] == sum(gone) and row["gaps"] == 0
    assert (row["cost"], row["audit"]) == dr.search(bytes((2 if t[2] == "user" else 3) | (8 if g else 0) for t, g in zip(turns, gone)))


def test_the_sql_gives_the_same_rows(spark):
    duckdb = pytest.importorskip("duckdb")
    import pandas as pd

    table = random_table(7) + [(None, 2, "user", "Hi.")]
    con = duckdb.connect()
    con.register("c", pd.DataFrame({"conv_id": pd.array([r[0] for r in table], "Int64"), "turn": pd.array([r[1] for r in table], "Int64"), "role": [r[2] for r in table], "text": [r[3] for r in table]}))
    con.execute("CREATE TABLE conversations AS SELECT * FROM c")
    got = {r[0]: r[1:] for r in con.execute(dr.SQL).fetchall()}
    assert got == run(spark, table)
