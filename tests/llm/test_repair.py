"""Conversation repair: the parser against all edits and all cuts, and the operator against a plain loop."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair as cr
from tidemark.llm import queries

GRAMMAR = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ALL = cr.INITIALS + cr.TRUNCATED + cr.DOOMED
CHEAP = cr.Costs(rerole=3, delete=4, insert=1, truncated=2)


def brute_audit(line, costs=cr.Costs(), most_inserted=2):
    """The least (cost, audit, roles) over all edits of every row and up to two insertions at every place."""
    best = None
    puts = [p for n in range(most_inserted + 1) for p in itertools.product("ua", repeat=n)]
    for gaps in itertools.product(puts, repeat=len(line) + 1):
        for moves in itertools.product("DKua", repeat=len(line)):
            cost, audit, roles = 0, "", ""
            for i in range(len(line) + 1):
                cost, audit, roles = cost + costs.insert * len(gaps[i]), audit + "I" * len(gaps[i]), roles + "".join(gaps[i])
                if i == len(line):
                    break
                move, symbol = moves[i], line[i]
                if move == "D":
                    cost, audit = cost + costs.delete, audit + "D"
                    continue
                if symbol in cr.DOOMED:
                    break
                cost += (costs.truncated if symbol in cr.TRUNCATED else 0) + (0 if move == "K" else costs.rerole)
                audit, roles = audit + ("K" if move == "K" else "R"), roles + (symbol.lower() if move == "K" else move)
            else:
                continue
            if i == len(line) and GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, roles)
    return best


def least(line, costs=cr.Costs()):
    cell = cr.cells(line, costs)
    return min(cell[k] for k in cr.WHOLE if cell[k])


@pytest.mark.parametrize("costs", [cr.Costs(), CHEAP])
def test_audits_are_the_least_of_all_edits(costs):
    lines = list(ALL) + ["".join(p) for p in itertools.product("suaoUA2", repeat=2)]
    lines += ["".join(random.Random(i).choice(ALL) for _ in range(3)) for i in range(6)]
    for line in lines:
        cost, audit, roles = brute_audit(line, costs, 2 if len(line) < 3 else 1)
        assert least(line, costs) == (cost, audit), line
        made = [e for e in cr.edits(audit, line, "") if e.role is not None]
        assert "".join(e.role[:1] or line[e.row].lower() for e in made) == roles


@pytest.mark.parametrize("costs", [cr.Costs(), CHEAP])
def test_every_cut_of_a_span_gives_its_cell(costs):
    rng = random.Random(7)
    for _ in range(40):
        line = "".join(rng.choice(ALL) for _ in range(rng.randrange(1, 14)))
        chart = {(i, i + 1): cr.leaf(c, costs) for i, c in enumerate(line)}
        for length in range(2, len(line) + 1):
            for i in range(len(line) - length + 1):
                made = [cr.join(chart[i, m], chart[m, i + length]) for m in range(i + 1, i + length)]
                assert all(x == made[0] for x in made)
                chart[i, i + length] = made[0]
        assert cr.cells(line, costs) == chart[0, len(line)] == cr.closed(chart[0, len(line)], costs)


def plain(line, costs=cr.Costs()):
    """Left to right over the last role written; for long lines."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    def put(states):
        while True:
            more = dict(states)
            for last, (cost, audit) in states.items():
                for role in after[last].replace("s", ""):
                    new = (cost + costs.insert, audit + "I")
                    more[role] = min(more.get(role, new), new)
            if more == states:
                return states
            states = more
    states = put({"": (0, "")})
    for c in line:
        now = defaultdict(list)
        for last, (cost, audit) in states.items():
            now[last].append((cost + costs.delete, audit + "D"))
            if c not in cr.DOOMED:
                extra = costs.truncated if c in cr.TRUNCATED else 0
                for role in after[last]:
                    if role == c.lower():
                        now[role].append((cost + extra, audit + "K"))
                    if role != "s":
                        now[role].append((cost + extra + costs.rerole, audit + "R"))
        states = put({k: min(v) for k, v in now.items()})
    return min(states[k] for k in ("", "a") if k in states)


def brute(rows):
    """The query's rows, conversation by conversation."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        own = convs[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, fault = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        own.extend([(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1))
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, line, counts = set(), "", [0, 0, 0]
        for _, role, text in own:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            ink = re.sub("[\x20\x09-\x0d]", "", text)
            fault = 0 if not ink else 1 if (role, text) in seen else 2 if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            line += initial if fault is None else cr.TRUNCATED[cr.INITIALS.index(initial)] if fault == 2 else cr.DOOMED[cr.INITIALS.index(initial)]
        turns = {t for t, *_ in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = plain(line) if line else (0, "")
        said = []
        for e in cr.edits(audit, line, ""):
            if e.role is not None:
                said.append(f"{e.role or own[e.row][1]}:{'' if e.row is None else own[e.row][2]}")
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_conversations():
    rng = random.Random(4)
    rows = []
    for conv in [*range(60), None]:
        turns = [rng.choice([t, t, t, t + 1, None]) for t in range(rng.choice([0, 1, 2, 5, 9, 30]))]
        rows += [(conv, t, rng.choice(["user", "assistant", "system", "tool", "", None, "uncle", "User"]),
                  rng.choice([f"said {t}.", f"said {t}.", "Hi!", "cut", "", None, " \t\n", "ok? \x0b", "same.", "\x00x", "é漢 \xa0"])) for t in turns]
    rows += [(77, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(700)] + [(78, 3, "user", "same.")] * 300
    rows += [(79, t, "user", "again and again.") for t in range(400)] + [(80, 2**62, "user", "far."), (80, -2**62, "user", "off.")]
    return rows


@pytest.mark.parametrize("segment", [4096, 7])
def test_repair_matches_a_plain_loop(spark, monkeypatch, tmp_path, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("conv", "uid", "line", "n", "digest", "position")})
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    want = [(c, None if c == 80 and g > 2**63 - 1 else g, *rest) for c, g, *rest in brute(rows)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_insertions_are_written_at_their_place(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "assistant", "b."), (2, 0, "system", "s."), (3, 0, "user", "q?"), (3, 1, "user", "r?"), (4, 0, "user", " ")]
    found = cr.repair_conversations(spark.createDataFrame(rows, SCHEMA), costs=cr.Costs(rerole=9, delete=9, insert=1))
    got = [(r.conv_id, r.position, r.role, r.text, r.edit) for r in found.turns.orderBy("conv_id", "position").collect()]
    assert got == [(1, 0, "user", "", "I"), (1, 1, "assistant", "a.", "K"), (1, 2, "user", "", "I"), (1, 3, "assistant", "b.", "K"),
                   (2, 0, "system", "s.", "K"), (2, 1, "user", "", "I"), (2, 2, "assistant", "", "I"),
                   (3, 0, "user", "q?", "K"), (3, 1, "assistant", "", "I"), (3, 2, "user", "r?", "K"), (3, 3, "assistant", "", "I")]
    assert {r.conv_id: (r.cost, r.audit) for r in found.report.collect()} == {1: (2, "IKIK"), 2: (2, "KII"), 3: (2, "KIKI"), 4: (9, "D")}


def test_empty_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_conversation_repair(spark, str(tmp_path)).count() == 0


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
