import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tallyfold.llm import structure as st

# Two roles may follow each other at will in pairs: an edit's letter does not tell the role it gives.
PAIRS = st.Grammar(({"u": 1, "a": 2, "s": 3}, {"a": 0}, {"u": 0}, {"u": 1, "a": 2, "s": 0}), frozenset({0}))
LOOSE = st.Grammar(({"u": 1, "a": 0}, {"u": 2, "a": 0}, {"a": 0, "u": 1}), frozenset({0, 2}))


def least(turns, grammar, costs):
    """(cost, audit, roles given) by trying every edit, from the back. turns: (initial, fault)."""
    states = range(len(grammar.steps))
    moves = [[(r, s[n[0]]) for r, n in enumerate(grammar.roles) if n[0] in s] for s in grammar.steps]
    best = {q: (0, "") for q in grammar.accept}

    def insertions(best):
        for _ in states:
            for q in states:
                for _, to in moves[q]:
                    if to in best:
                        new = (best[to][0] + costs.insert, "I" + best[to][1])
                        best[q] = min(best.get(q, new), new)
        return best

    best = insertions(best)
    for initial, fault in reversed(turns):
        new = {}
        for q in states:
            extra = costs.truncated if fault == 3 else 0
            options = [(costs.delete, "D", q)]
            if fault not in (1, 2):
                options += [(extra, "K", grammar.steps[q][initial])] if initial in grammar.steps[q] else []
                options += [(costs.rerole + extra, "R", to) for _, to in moves[q]]
            new[q] = min((c + best[to][0], letter + best[to][1]) for c, letter, to in options)
        best = insertions(new)
    return best[0]


def run(conversations, grammar=st.CHAT, costs=st.Costs(), block=st.BLOCK):
    work, out = st.Repairer(grammar, costs, block), []
    for conv, turns in conversations.items():
        for initial, fault in reversed(turns):
            out += work.add(conv, initial, fault)
    return {i: (cost, a.decode(), g) for i, cost, a, g in [*out, *work.close(end=True)]}


def accepted(initials, grammar):
    q = 0
    for x in initials:
        if x not in grammar.steps[q]:
            return False
        q = grammar.steps[q][x]
    return q in grammar.accept


@pytest.mark.parametrize("grammar", [st.CHAT, PAIRS, LOOSE])
@pytest.mark.parametrize("block", [1, 3, 64, st.BLOCK])
def test_cheapest_and_then_least_repairs(grammar, block):
    r = random.Random(block)
    costs = [st.Costs(), st.Costs(1, 1, 1, 1), st.Costs(2, 3, 1, 0)]
    for c in costs:
        conversations = {
            i: [(r.choice("suax "), r.choice([0, 0, 0, 1, 2, 3])) for _ in range(r.choice([1, 2, 3, 5, 9, 40]))]
            for i in range(60)
        }
        got = run(conversations, grammar, c, block)
        assert set(got) == set(conversations)
        for i, turns in conversations.items():
            assert got[i][:2] == least(turns, grammar, c), (i, turns)
            left, k = [], 0
            for letter, given in zip(got[i][1], got[i][2]):
                if letter in "RI":
                    left.append(grammar.roles[given][0])
                elif letter == "K":
                    left.append(turns[k][0])
                k += letter != "I"
            assert k == len(turns) and accepted(left, grammar)


def test_every_edit_sequence_of_few_turns():
    """The plain search itself against all sequences of edits."""
    shape, costs = re.compile(r"(s?(ua)+)?"), st.Costs()
    for turns in itertools.product([("u", 0), ("a", 3), ("s", 0), ("x", 0), ("u", 2)], repeat=2):
        found = []
        for letters in itertools.product("DKRr", repeat=2):
            for slots in itertools.product(["", "u", "a", "ua", "au"], repeat=3):
                text, audit, cost = slots[0], "I" * len(slots[0]), 5 * sum(map(len, slots))
                for (initial, fault), letter, slot in zip(turns, letters, slots[1:]):
                    if fault in (1, 2) and letter != "D":
                        break
                    cost += {"D": 2, "K": 0}.get(letter, 1) + (5 if fault == 3 and letter != "D" else 0)
                    text += {"D": "", "K": initial, "R": "u", "r": "a"}[letter] + slot
                    audit += letter.upper() + "I" * len(slot)
                else:
                    if shape.fullmatch(text):
                        found.append((cost, audit))
        assert least(turns, st.CHAT, costs) == min(found)


def brute(rows):
    """The contract of the query, row by row."""
    kept, every = defaultdict(list), set()
    for conv, turn, role, text in rows:
        every.add(conv)
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(h, text)
        role = "user" if h == 4 else role
        kept[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(h, 1)
    out = {}
    for conv in every:
        turns = sorted(kept[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append(1 if not last else 2 if (role, text) in seen else 0 if last[0] in ".!?" else 3)
            seen.add((role, text))
        numbers = [t for t, _, _ in turns if t is not None]
        initials = [role[:1] for _, role, _ in turns]
        cost, audit = least(list(zip(initials, faults)), st.CHAT, st.Costs()) if turns else (0, "")
        left, k = [], 0
        for letter in audit:
            if letter != "D":
                at = sum(1 for x in left if not x[0].startswith("s"))
                given = ("user", "assistant")[at % 2]
                left.append((turns[k][1] if letter == "K" else given, "" if letter == "I" else turns[k][2]))
            k += letter != "I"
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in left).encode()).hexdigest()
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(i) for i in (1, 2, 3)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, digest,
        )
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def collected(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def test_query_against_the_table(spark, sf_dir):
    from tallyfold.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_structure_repair"](spark, sf_dir)
    assert dict(got.dtypes)["cost"] == "bigint" and collected(got) == brute(rows)


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "umpire", "", None], ["Yes.", "no", "", None, " \x0b", "Why?\n", "é中\U0001f600", "a.\x85", "\x1c"]
    rows = [(None, 1, "user", "x."), (None, None, "assistant", "y."), (7, 1, "user", "long. " * 50_000)]
    rows += [(i, r.choice([None, *range(-2, 9)]), r.choice(roles), r.choice(texts)) for i in range(300) for _ in range(r.randint(1, 9))]
    rows += rows[20:60]
    rows += [(999, k, "user" if k % 2 else "assistant", f"turn {k}.") for k in range(9000)]  # a third of all and more
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return rows, df.selectExpr("*", "1 AS position", "'x' AS fault", "2 AS _copy", "'' AS audit").repartition(5)


def test_odd_rows(spark, odd):
    rows, df = odd
    want = brute(rows)
    assert collected(st.repair(st.damaged(df), df)) == want
    assert collected(st.repair(st.damaged(df), df, block=50)) == want
    assert st.repair(st.damaged(df).limit(0)).count() == 0
    gone = st.repair(st.damaged(df).limit(0), df).collect()
    assert {(r.cost, r.audit, r.repaired_sha256) for r in gone} == {(0, "", hashlib.sha256().hexdigest())}


def test_repaired_turns(spark, odd):
    _, df = odd
    found = st.examined(st.damaged(df))
    done = st.edits(found)
    out = defaultdict(list)
    for r in st.repaired(found, done).orderBy("conv_id", "position").collect():
        assert r.position == len(out[r.conv_id])
        out[r.conv_id].append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in st.repaired_digests(found, done).collect()}
    assert set(out) == set(digests)
    for conv, turns in out.items():
        assert re.fullmatch("s?(ua)+", "".join(t.role[0] for t in turns))
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == digests[conv]


def test_invalid_bytes(spark):
    df = spark.range(6).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "CAST(X'61FF2E' AS STRING) AS text")
    rows = st.repair(df).collect()
    assert len(rows) == 1 and rows[0].audit == "KKDDDD" and rows[0].duplicate == 4
