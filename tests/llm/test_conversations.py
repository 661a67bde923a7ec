import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from chronoweave.llm import conversation_repair, edit_lattice, queries
from chronoweave.llm.common import ship

SPACE = " \t\n\x0b\x0c\r"


def plain(symbols):
    """(cost, audit) by a search over (cost, audit, row, state) from the start only."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if (i, roles) in done:
            continue
        done.add((i, roles))
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        state = roles  # only its end matters
        due = "a" if state.endswith("u") else "u"
        short = {"u": "u", "a": "sua"}  # any legal text with the same end

        def go(more, letter, j, role):
            new = state + role if role else state
            new = short[new[-1]] if new and new[-1] in short else new
            heapq.heappush(heap, (cost + more, audit + letter, j, "ua" if new == "sua" else new))

        go(2, "I", i, due)
        if i < len(symbols):
            c = symbols[i]
            go(3, "D", i + 1, "")
            if c != "-":
                more = int(c.isupper())
                go(2 + more, "R", i + 1, due)
                if c.lower() == due or (c.lower() == "s" and state == ""):
                    go(more, "K", i + 1, c.lower())


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def brute(rows):
    """The contract's row of each conversation."""
    of = defaultdict(list)
    for r in rows:
        of[r[0]]
    for r in damaged(rows):
        of[r[0]].append(r)
    out = []
    for conv, own in of.items():
        def key(r):
            mark = "-" if r[0] is None else f"={r[0]}"
            return (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(mark)}:{mark}:{len(r[2])}:{r[2]}:{r[3]}".encode()).digest())
        own.sort(key=key)
        seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            symbol = role[:1] if role[:1] and role[:1] in "sua" else "x"
            if not text.strip(SPACE):
                counts["blank"] += 1
                symbol = "-"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                symbol = "-"
            elif text.rstrip(SPACE)[-1] not in ".!?":
                counts["truncated"] += 1
                symbol = symbol.upper()
            seen.add((role, text))
            symbols += symbol
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(own, own[1:]))
        cost, audit = plain(symbols)
        result, left = [], list(own)
        for letter, role, takes in edit_lattice.repaired(audit, [r[2] for r in own]):
            row = left.pop(0) if takes else (None, None, None, "")
            if role is not None:
                result.append(f"{role}:{row[3]}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in result))
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(result).encode()).hexdigest()))
    return sorted(out, key=str)


def test_search_meets_the_plain_one():
    rng = random.Random(5)
    for n in [*range(9)] * 60 + [14, 25] * 10:
        symbols = "".join(rng.choice("suaxSUAX-uauaua") for _ in range(n))
        assert edit_lattice.cheapest(symbols) == plain(symbols), symbols
        path, cuts = edit_lattice.Path(), sorted({0, n, *(rng.randrange(n + 1) for _ in range(3))})
        for a, b in zip(cuts, cuts[1:]):
            path.add(edit_lattice.table(symbols[a:b]))
        assert path.result() == plain(symbols), (symbols, cuts)


def awkward():
    rng = random.Random(3)
    words = ["Yes.", "no", "Is it? ", "", " \n", None, "dot.", "ende!\t", "日本。", "same text."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]
    rows = [(c, t, rng.choice(roles[:2 + c % 8]), rng.choice(words) if rng.random() < 0.4 else f"text {c} {t}.") for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, t, "user", "hm.") for t in (None, 1, 1, 4)] + [(70, None, None, None)] * 3
    rows += [(80, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(300)] + [(81, 5, "user", "again.")] * 50
    return rows


@pytest.mark.parametrize("piece", [7, conversation_repair.PIECE])
def test_rows_are_the_brute_force_ones(spark, piece):
    ship(spark)
    rows = awkward()
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(4)
    got = conversation_repair.digests(conversation_repair.repair(conversation_repair.damage(frame), piece)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_edits_keep_every_row(spark):
    ship(spark)
    frame = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", "Yes."), (1, 2, "user", "No.")], "conv_id long, turn int, role string, text string")
    edits = [(r.step, r.edit, r.role, r.text) for r in conversation_repair.repair(frame).collect()]
    assert edits == [(0, None, None, None), (1, "I", "user", ""), (2, "K", "assistant", "Hi."), (3, "K", "user", "Yes."), (4, "R", "assistant", "No.")]


def test_empty(spark):
    ship(spark)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.digests(conversation_repair.repair(conversation_repair.damage(empty))).collect() == []


def test_sql_twin(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in conversation_repair.query(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    assert got == sorted(con.execute(queries.ORACLE_SQL["op11_conversation_repair"]).fetchall())
