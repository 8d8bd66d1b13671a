import hashlib
import itertools
import random
import re
import zlib

import pytest

from skeinwork.llm import queries, repair
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def cheapest(codes):
    """By Bellman and Ford on (cost, letters) over rows and states; no auction, no blocks."""
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    after = {"s": 1, "u": 2, "a": 3}
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                to = after[step[q]]
                best[to] = min(best.get(to, (9e9, "")), (c + 5, a + "I"))
        return best

    best = inserted(best)
    for code in codes:
        new = {}

        def put(q, value):
            new[q] = min(new.get(q, (9e9, "")), value)

        for q, (c, a) in best.items():
            put(q, (c + 2, a + "D"))
            if code != "-":
                more, i = 5 * code.isupper(), code.lower()
                put(after[step[q]], (c + 1 + more, a + "R"))
                if i == step[q] or i == "s" and q == 0:
                    put(after[i], (c + more, a + "K"))
        best = inserted(new)
    return min(v for q, v in best.items() if q in (0, 3))


def tried(codes):
    """By trying every sequence of edits with up to three inserts."""
    best = (9e9, "")
    for inserts in range(4):
        for word in itertools.product("DKRI", repeat=len(codes) + inserts):
            if word.count("I") != inserts:
                continue
            it, roles, cost = iter(codes), [], 0
            for letter in word:
                code = next(it) if letter != "I" else ""
                if letter != "D" and code == "-":
                    cost = 9e9
                cost += {"D": 2, "K": 0, "R": 1, "I": 5}[letter] + (5 if letter in "KR" and code.isupper() else 0)
                if letter != "D":
                    roles.append([code.lower()] if letter == "K" else ["u", "a"])
            if (cost, "".join(word)) < best and any(GOOD.fullmatch("".join(r)) for r in itertools.product(*roles)):
                best = (cost, "".join(word))
    return best


def plain(table):
    convs = {}
    for conv_id, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        own = convs.setdefault(conv_id, [])
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        own += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = []
    for conv_id, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, codes = set(), "", ""
        for _, role, text in own:
            end = text.rstrip(SPACES)
            fault = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else " "
            seen.add((role, text))
            faults += fault
            code = "-" if fault in "bd" else role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += code.upper() if fault == "t" else code
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = cheapest(codes)
        it, lines, want = iter(own), [], "u"
        for letter in audit:
            _, role, text = next(it) if letter != "I" else (0, "", "")
            if letter != "D":
                role = role if letter == "K" else {"u": "user", "a": "assistant"}[want]
                want = {"s": "u", "u": "a", "a": "u"}[role[0]]
                lines.append(f"{role}:{text}")
        assert GOOD.fullmatch("".join(line[0] for line in lines))
        out.append((conv_id, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, table):
    df = spark.createDataFrame(table, SCHEMA) if not hasattr(table, "columns") else table
    return sorted((tuple(r) for r in repair.audits(repair.damage(df)).collect()), key=str)


def test_the_query_equals_its_sql_and_a_plain_reading(spark):
    got = queries.op13_structure_repair(spark, SF).toPandas()
    assert rows(got) == rows(connect(SF).sql(queries.ORACLES["op13_structure_repair"]).df())
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(spark, table) == plain(table)


def test_every_short_conversation_by_trying_all_edits():
    for n in range(4):
        for codes in itertools.product("suaoSUAO-", repeat=n):
            assert repair.repair("".join(codes)) == tried("".join(codes)) == cheapest(codes)


@pytest.mark.parametrize("seed", range(4))
def test_random_and_long_conversations(seed):
    rng = random.Random(seed)
    weights = [[1] * 9, [1, 20, 20, 0, 0, 2, 2, 0, 3], [0, 1, 1, 0, 0, 9, 9, 0, 0], [5, 0, 3, 5, 0, 0, 0, 0, 1]][seed]
    for n in [*range(1, 40), 63, 64, 65, 127, 128, 129, 500, 1500]:
        codes = "".join(rng.choices("suaoSUAO-", weights, k=n))
        assert repair.repair(codes) == cheapest(codes), codes
    assert repair.repair("u" * 3000) == cheapest("u" * 3000)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_of_any_length(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    for n in range(30):
        codes = "".join(rng.choices("suaoSUAO-", k=n))
        assert repair.repair(codes) == cheapest(codes)


def test_prices_hold_for_every_arc():
    """Complementary slackness at the end of an auction, and the price of the origin is the distance."""
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(2, 9)
        arcs = [[(rng.randint(1, 6), j, "x") for j in rng.sample(range(n + 1), rng.randint(1, n)) if j != i] + [(20, n, "x")] for i in range(n)]
        price = [0] * (n + 1)
        repair.auction(arcs, price, 0)
        dist = [0 if i == n else 9e9 for i in range(n + 1)]
        for _ in range(n):
            for i in range(n):
                dist[i] = min([dist[i]] + [c + dist[j] for c, j, _ in arcs[i]])
        assert price[0] == dist[0] and all(price[i] <= c + price[j] for i in range(n) for c, j, _ in arcs[i])


def test_odd_rows(spark):
    table = [(1, None, None, None), (1, None, "user", "x."), (1, 5, "user", "x."), (2, 1, "", "no role"), (2, 2, "user", ""), (3, 0, "assistant", "y" * 300_000), (None, None, "user", "nobody?"), (None, 2, "assistant", "Yes! \x0b\n"), (-4, 7, "system", "Rules."), (-4, 7, "system", "Rules."), (-4, 2**60, "user", "é…"), (9, 0, "Über", "a. ")]
    table += [(c, t, r, "z." * (t + 1)) for c in range(20, 60) for t, r in enumerate(["system", "user", "assistant", "user", "user"])]
    assert found(spark, table) == plain(table)
    wide = spark.createDataFrame([(*r, 1, "y") for r in table], f"{SCHEMA}, gone int, Nth string")
    assert found(spark, wide) == plain(table)


def test_conversations_without_rows_and_an_empty_table(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(spark, [(lost, 0, "user", "Hello.")]) == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert found(spark, []) == []


def test_a_long_conversation_goes_to_disk(spark, monkeypatch):
    monkeypatch.setattr(repair, "SPOOL", 1000)  # forked workers see it
    table = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(1000)]
    assert found(spark, table) == plain(table)


def test_the_repaired_turns(spark):
    rows_ = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Go"), (1, 2, "user", "On."), (2, 0, "user", " "), (3, 0, "system", "S."), (3, 1, "user", "Q?"), (3, 2, "assistant", "A.")]
    df = spark.createDataFrame([(*r, False) for r in rows_], f"{SCHEMA}, gone boolean")
    got = sorted(tuple(r) for r in repair.repaired_turns(df).collect())
    assert [r for r in got if r[0] == 3] == [(3, 0, "K", "system", "S."), (3, 1, "K", "user", "Q?"), (3, 2, "K", "assistant", "A.")]
    assert [r for r in got if r[0] == 1] == [(1, 0, "R", "user", "Hi."), (1, 1, "R", "assistant", "On.")]
    assert not [r for r in got if r[0] == 2]
