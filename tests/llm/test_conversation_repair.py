"""Repair of conversations against plain definitions."""

import hashlib
import random
import re
import zlib

import pytest

from stackroom.llm import conversation_repair as repair
from stackroom.llm.queries import op12_conversation_repair
from stackroom.runtime import materialised

SCHEMA = "conv_id long, turn long, role string, text string, fault string, cell long"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_name, turn_name = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{conv_name}:{turn_name}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def plain_repair(rows):
    """Faults, cost, audit and repaired rows of one conversation; every edit script up to a length is compared."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        content = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not content else "duplicate" if (role, text) in seen else "truncated" if content[-1] not in ".!?" else None
        faults.append(fault)
        seen.add((role, text))
    # Least (cost, audit, turns) from each row and pattern place to the end, from behind.
    turns = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}
    names = {"u": "user", "a": "assistant"}
    best = {}
    for i in range(len(rows), -1, -1):
        here = {}
        for state in turns:
            ways = []
            if i == len(rows):
                ways += [(0, "", ())] if state in ("", "a") else []
            else:
                cost, audit, out = best[i + 1, state]
                ways.append((cost + 4, "D" + audit, out))
                _, _, role, text = rows[i]
                if faults[i] not in ("blank", "duplicate"):
                    extra = 3 if faults[i] == "truncated" else 0
                    if role[:1] in turns[state]:
                        cost, audit, out = best[i + 1, role[:1]]
                        ways.append((cost + extra, "K" + audit, ((role, text), *out)))
                    for new in set(turns[state]) & set(names):
                        cost, audit, out = best[i + 1, new]
                        ways.append((cost + extra + 3, "R" + audit, ((names[new], text), *out)))
            here[state] = ways
        # At most two insertions in a row can help: a longer run repeats a state.
        for _ in range(4):
            for state in turns:
                for new in set(turns[state]) & set(names):
                    here[state] += [(c + 3, "I" + a, ((names[new], ""), *o)) for c, a, o in here[new]]
                here[state] = sorted(set(here[state]))[:3]
        for state in turns:
            best[i, state] = min(here[state])
    cost, audit, out = best[0, ""]
    return faults, cost, audit, out


def plain(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        mine = plain_damage([r for r in rows if r[0] == conv])
        faults, cost, audit, out = plain_repair(mine) if mine else ([], 0, "", ())
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return found


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def random_rows(seed, conversations, longest):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for i in range(draw.randint(1, longest)):
            turn = None if draw.random() < 0.05 else i * draw.choice([1, 1, 1, 2])
            role = draw.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None])
            text = draw.choice(["Yes.", "No?", "and then", "", " \n", None, f"Word {i}.", f"half {i}", "Ends! \t"])
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("block_rows,longest", [(256, 7), (3, 14), (1, 6)])
def test_against_plain_version(spark, block_rows, longest):
    rows = random_rows(longest, 60, longest)
    talks = materialised(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    damaged = repair.damaged(talks)
    found = results(repair.digest(talks, damaged, repair.repaired(damaged, block_rows)))
    assert found == plain(rows)


def test_one_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Line {i % 997}." if i % 13 else "cut") for i in range(3000)]
    talks = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    damaged = repair.damaged(talks)
    blocks = repair.repaired(damaged)
    assert blocks.count() > 10
    assert results(repair.digest(talks, damaged, blocks)) == plain(rows)
    turns = [(r["role"], r["text"]) for r in repair.repaired_turns(blocks).orderBy("cell", "place").collect()]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns))


def test_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(op12_conversation_repair(spark, sf)) == plain(rows)


def test_empty_and_single(spark):
    none = spark.createDataFrame([], SCHEMA)
    damaged = repair.damaged(none)
    assert repair.digest(none, damaged, repair.repaired(damaged)).count() == 0
    # Every row of this conversation is dropped.
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    lone = spark.createDataFrame([(conv, 0, "user", "Hi.", None, None)], SCHEMA)
    damaged = repair.damaged(lone)
    found = results(repair.digest(lone, damaged, repair.repaired(damaged)))
    assert found == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_searches_meet_at_the_least_audit():
    """Both ends meet at the way that a search from one end alone finds, for every pair of states."""
    draw = random.Random(5)
    for _ in range(150):
        last = draw.random() < 0.5
        rows = [(draw.choice("suax"), draw.random() < 0.2, draw.random() < 0.3) for _ in range(draw.randint(not last, 6))]
        ahead, behind = repair.lattice(rows, last)
        for state in repair.FITTING:
            ways = {(0, state): (0, "")}
            for _ in range(6 * len(rows) + 8):
                for node, (cost, audit) in list(ways.items()):
                    for letter, step, to in ahead.get(node, []):
                        way = (cost + step, audit + letter)
                        ways[to] = min(ways.get(to, way), way)
            for target in [(len(rows) + 1, repair.DONE)] if last else [(len(rows), s) for s in repair.FITTING]:
                assert repair.cheapest(ahead, behind, (0, state), target) == ways.get(target)
