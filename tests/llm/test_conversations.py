import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from salescast.llm import conversations as c

SPACED = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, place string, message string"


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv_id, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = "user" if kind == 4 else shown[2], "" if kind == 1 else shown[3]
        text = re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, messages) by a search that keeps the least (cost, audit) of every state with whole strings."""
    best = {"": (0, "", ())}  # by the last initial, which also says what is due

    def inserted(states):
        for _ in range(2):
            for last, (cost, audit, out) in list(states.items()):
                due = "a" if last == "u" else "u"
                put(states, due, (cost + 5, audit + "I", (*out, ("assistant" if due == "a" else "user", ""))))

    def put(states, last, new):
        if last not in states or new[:2] < states[last][:2]:
            states[last] = new

    for role, text, fault in rows:
        new = {}
        for step in range(3):  # inserts before this row, which must be its own
            for last, (cost, audit, out) in best.items():
                due = "a" if last == "u" else "u"
                put(new, last, (cost + 2, audit + "D", out))
                if fault not in ("blank", "duplicate"):
                    cost += 5 * (fault == "truncated")
                    put(new, due, (cost + 1, audit + "R", (*out, ("assistant" if due == "a" else "user", text))))
                    if role[:1] == due or role[:1] == "s" and last == "":
                        put(new, role[0], (cost, audit + "K", (*out, (role, text))))
            # One more insert for every path.
            best, moved = {}, best
            for last, (cost, audit, out) in moved.items():
                due = "a" if last == "u" else "u"
                put(best, due, (cost + 5, audit + "I", (*out, ("assistant" if due == "a" else "user", ""))))
        best = new
    for _ in range(2):
        inserted(best)
    return min(v for k, v in best.items() if k in ("", "a"))


def expected(original):
    found = defaultdict(list)
    for conv_id, turn, role, text in damaged(original):
        found[conv_id].append((turn, role, text))
    out = {}
    for conv_id in {r[0] for r in original}:
        rows = sorted(found[conv_id], key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            letters = SPACED.findall(text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role, text, fault))
        cost, audit, messages = cheapest(faults)
        turns = [t for t, _, _ in rows if t is not None]
        count = lambda kind: sum(f[2] == kind for f in faults)
        joined = "\n".join(f"{r}:{t}" for r, t in messages)
        out[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"),
                        count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
                        cost, audit, hashlib.sha256(joined.encode()).hexdigest())
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def random_rows(seed, conversations, most):
    rng, out = random.Random(seed), []
    for conv_id in range(conversations):
        for turn in range(rng.randrange(1, most)):
            if rng.random() < 0.1:
                continue
            role = rng.choice(["user", "assistant"] * 6 + ["system", "tool", "", None, "Übung"]) if rng.random() < 0.3 else "user assistant".split()[turn % 2]
            text = rng.choice(["Yes.", "No!", "cut", " \t\n", "", None, "a?  ", "Né.", "x" * 30 + "."]) if rng.random() < 0.5 else f"Text {turn}."
            out.append((conv_id, None if rng.random() < 0.05 else turn, role, text))
    return out


def awkward():
    return [(None, None, None, None), (None, 1, "user", "Hello."), (7_000, None, "user", "A."), (7_000, None, "assistant", "B."),
            (8_000, 5, "user", "Same."), (8_000, 5, "user", "Same."), (8_000, 5, "user", "Same."), (9_000, 1, "system", "Only."),
            (9_100, 3, "user", "Long. " * 50_000), (9_100, 4, "assistant", "Long. " * 50_000)]


def test_digests_equal_brute_force(spark):
    rows = random_rows(1, 120, 12) + awkward()
    got = {r.conv_id: tuple(r)[1:] for r in c.digests(table(spark, rows)).collect()}
    assert got == expected(rows)


def test_conversations_in_many_runs_and_levels(spark, monkeypatch):
    monkeypatch.setattr(c, "RUN", 4)
    monkeypatch.setattr(c, "FAN", 3)
    rows = random_rows(2, 6, 90) + [(99, t, "user" if t % 2 else "assistant", "Same text.") for t in range(60)]
    got = {r.conv_id: tuple(r)[1:] for r in c.digests(table(spark, rows).repartition(5)).collect()}
    assert got == expected(rows)


def test_messages_are_what_the_digest_hashes(spark):
    rows = random_rows(3, 40, 10) + awkward()
    data = table(spark, rows)
    messages = defaultdict(list)
    for r in c.repair(c.damage(data)).messages().orderBy("place", "number").collect():
        messages[r.conv_id].append(f"{r.role}:{r.text}")
    for r in c.digests(data).collect():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(messages[r.conv_id]).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(m[0] for m in messages[r.conv_id]))


def test_empty_table_and_conversation_lost_to_damage(spark):
    assert c.digests(table(spark, [])).count() == 0
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = c.digests(table(spark, [(lost, 0, "user", "Gone.")])).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("size", [1, 2, 9, 400])
def test_crossings_through_stretches_equal_plain_search(size):
    rng = random.Random(size)
    for _ in range(20):
        kinds = np.array([rng.randrange(12) for _ in range(size)])
        rows = [("sua-"[k // 3], "t", ("", "blank", "truncated")[k % 3]) for k in kinds]
        first = np.array(sorted({0, size, *(rng.randrange(size) for _ in range(5))}))
        costs, ranks = c.reduce_elements(c.COSTS[kinds], c.RANKS[kinds], first)
        all_ = np.array([0, len(costs)])
        top_cost, top_rank = c.reduce_elements(costs, ranks, all_)
        total = top_cost[0, 0] + [c.INSERT * len(t) for t in c.TAIL]
        end = int((total * 4 + top_rank[0, 0]).argmin())
        states = c.crossings(costs, ranks, all_, np.array([0]), np.array([end]))
        inner = c.crossings(c.COSTS[kinds], c.RANKS[kinds], first, states[:-1], states[1:])
        own = np.arange(size) + np.repeat(np.arange(len(first) - 1), np.diff(first))
        audit = "".join(c.LETTERS[k][a][z] for k, a, z in zip(kinds, inner[own], inner[own + 1])) + c.TAIL[end]
        assert (total[end], audit) == cheapest(rows)[:2]
