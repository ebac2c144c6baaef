"""Prefix trie and repair of conversations against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from netsieve.llm import prefixes, repair

TURNS = "conv_id long, turn long, role string, text string, depth string, place int, d1 string, words string, shard string, cls string"


def odd_turns() -> list[tuple]:
    rng = random.Random(11)
    rows = []
    roles = ["system", "user", "assistant", None, "", "tool", "user", "assistant"]
    texts = ["Hi.", "hi", "", None, " \t", "What now?", "A b c.", "Ünd so!", "x" * 3000 + ".", "yes ", "Same text here."]
    for conv in [*range(0, 45), 60, 61, 79, 123456789012, -3, -20]:
        for turn in range(rng.randrange(0, 7)):
            rows.append((conv, turn if rng.random() < 0.9 else turn + 3, rng.choice(roles), rng.choice(texts)))
    rows += [(60, None, "user", "early"), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (500, None, None, None), (501, 3, "user", "far."), (501, 9, "user", "far.")]
    rows += [(600, i, "user" if i % 2 == 0 else "assistant", f"turn {i % 9}.") for i in range(700)]
    rows += [(c, i, ["system", "user", "assistant"][min(i, 1 + i % 2)], f"shared {i}.") for c in range(700, 740) for i in range(5 + c % 3)]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "q", 1, "q", "q", "q", "q") for r in odd_turns()] + [(None, 0, "user", "lost", "q", 1, "q", "q", "q", "q")], TURNS).repartition(5)


@pytest.fixture(scope="module")
def no_talks(spark):
    return spark.createDataFrame([], TURNS)


@pytest.fixture(scope="module")
def given_talks(spark, small):
    return spark.read.parquet(f"{small}/conversations.parquet")


def brute_trie(turns_of, rebuild):
    """Turns in order by conversation -> rows of the result, as a multiset."""
    paths = {}
    for c, own in turns_of.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = int(c - np.fmod(c, 20))
        paths[c] = list(turns_of.get(base, [])[:h]) + list(own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, own in members.items():
        gain = (len(own) - 1) * len(k[-1][1].encode().split()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += gain
    return Counter(
        (min(own), len(k), min(members[k[:-1]]) if k else None, len(own), children[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, own in members.items()
    )


def ordered(frame):
    """Turns of each conversation in order."""
    out = defaultdict(list)
    rows = frame.select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL").collect()
    for r in sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0)):
        out[r.conv_id].append((r.role or "", r.text or ""))
    return out


def test_trie_is_that_of_the_definition(talks, given_talks):
    ties = talks.dropDuplicates(["conv_id", "turn"])  # the definition does not order different rows of one turn
    small = {"top_conversations": 2, "shard_nodes": 7}
    for frame, rebuild, options in ((ties, True, {}), (ties, True, small), (ties, False, small), (given_talks, True, {"top_conversations": 3})):
        turns_of = ordered(frame)
        got = Counter(tuple(r) for r in prefixes.conversation_trie(frame, rebuild=rebuild, **options).collect())
        assert got == brute_trie(turns_of, rebuild)


def test_repeated_turns_and_no_turns(talks, no_talks):
    rows = prefixes.conversation_trie(talks, rebuild=True).collect()
    assert sum(r.depth == 0 for r in rows) == 1 and all(r.n_convs > 0 for r in rows)
    assert len({(r.conv_id, r.depth) for r in rows}) == len(rows)
    assert prefixes.conversation_trie(no_talks, rebuild=True).count() == 0


def test_node_table_is_minimal_perfect_and_verified():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 5000):
        depth, d1, d2 = rng.integers(0, 5, n), rng.integers(-(2**63), 2**63 - 1, n), rng.integers(-(2**63), 2**63 - 1, n)
        table = prefixes.NodeTable(depth, d1, d2)
        assert sorted(table.slots.tolist()) == list(range(n))
        assert (table.find(depth, d1, d2) == table.slots).all()
        assert (table.find(depth, d1, d2 + 1) == -1).all() and (table.find(depth + 9, d1, d2) == -1).all()


def brute_repair(rows):
    """Rows (turn, role, text) in order -> what the repair must find. The cheapest edits come from a search over whole edit strings: costs to go, then least first."""
    seen, faults, bad = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        if fault:
            bad[fault] += 1
    n = len(rows)
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}
    best = [dict.fromkeys(["", "s", "u", "a"], (10**9, "", ())) for _ in range(n + 1)]
    best[n][""] = best[n]["a"] = (0, "", ())

    def inserts(table):
        for _ in range(3):
            for state in table:
                for r in "ua":
                    if (state, r) in go:
                        cost, audit, out = table[go[state, r]]
                        table[state] = min(table[state], (cost + 3, "I" + audit, (full[r] + ":", *out)))

    inserts(best[n])
    for i in range(n - 1, -1, -1):
        _, role, text = rows[i]
        for state in best[i]:
            cost, audit, out = best[i + 1][state]
            options = [(cost + 4, "D" + audit, out)]
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                for r in "ua":
                    if (state, r) in go:
                        cost, audit, out = best[i + 1][go[state, r]]
                        options.append((cost + 3 + more, "R" + audit, (f"{full[r]}:{text}", *out)))
                if (state, role[:1]) in go:
                    cost, audit, out = best[i + 1][go[state, role[:1]]]
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *out)))
            best[i][state] = min(options, key=lambda o: o[:2])
        inserts(best[i])
    cost, audit, out = best[0][""]
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return gaps, bad["blank"], bad["duplicate"], bad["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(), out


def brute_damage(rows):
    """{conversation: rows after damage} of (conv, turn, role, text)."""
    out = {}
    for c, t, role, text in rows:
        own = out.setdefault(c, [])
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = text.translate({ord(x): None for x in ".!?"})
        if code == 4:
            role = "user"
        own.extend([(t, role, text)] * {0: 0, 3: 2}.get(code, 1))
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in out.items()}


def test_repair_is_the_cheapest(talks, given_talks, monkeypatch):
    for frame in (talks, given_talks):
        rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
        expected = {c: brute_repair(own) for c, own in brute_damage(rows).items()}
        source = repair.damaged(frame)
        found = repair.repair(source)
        got = {r[0]: tuple(r)[1:] for r in found.collect()}
        assert got == {c: e[:8] for c, e in expected.items()}
        turns = defaultdict(list)
        for r in repair.repaired_turns(source, found).orderBy("place").collect():
            turns[r.conv_id].append(f"{r.role}:{r.text}")
        assert {c: tuple(own) for c, own in turns.items()} == {c: e[8] for c, e in expected.items() if e[8]}


def test_repair_of_random_rows(monkeypatch, tmp_path):
    rng = random.Random(2)
    kinds = {"s": 0, "u": 1, "a": 2}
    for trial in range(400):
        rows = [(i, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", " ", ""]), rng.choice(["Hi.", "no end", "", f"Text {i}.", f"open {i}"])) for i in range(rng.randrange(12))]
        for folder, limit in ((None, 1 << 20), (None, 8), (str(tmp_path), 12)):
            monkeypatch.setattr(repair, "SPILL_BYTES", limit)
            state, seen = repair.Conversation("c", folder), set()
            for t, role, text in rows:
                bare = text.strip()
                fault = repair.BLANK if not bare else repair.DUPLICATE if (role, text) in seen else repair.OK if bare[-1] in ".!?" else repair.TRUNCATED
                seen.add((role, text))
                state.row(t, role, text, kinds.get(role[:1], 3), fault)
            assert state.close()[1:] == brute_repair(rows)[:8], (trial, rows)
    assert len(repair._steps) < 3000


def test_repair_of_nothing(spark, no_talks):
    assert repair.repair(repair.damaged(no_talks)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repair(repair.damaged(spark.createDataFrame([(gone, 0, "user", "x")], "conv_id long, turn long, role string, text string"))).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    plain = repair.repair(repair.plain(spark.createDataFrame([("k", 0, "user", "x.")], "conv_id string, turn long, role string, text string"))).first()
    assert tuple(plain)[:8] == ("k", 0, 0, 0, 0, 0, 3, "KI")
