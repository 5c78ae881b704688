import hashlib
import random
import zlib

import numpy as np
import pytest

from tierline.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def own_turns(rows):
    """Turns of each conversation in order, as (role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            found.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in found.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        base, h = own.get(c - c % 100 if c >= 0 else c + -c % 100, []), zlib.crc32(str(c).encode()) % 6
        out[c] = base[:h] + turns[h:]
    return out


def plain_trie(conversations):
    """Every node by its whole prefix."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for prefix, ids in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in below)]
        ends = sorted(c for c in ids if len(conversations[c]) == len(prefix))
        rows.append((min(ids), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(ids), len(children), len(leaves),
                     sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def table(seed, n, most, alphabet):
    rng = random.Random(seed)
    ids = rng.sample(range(1000), n)
    return [(c, t, rng.choice(["user", None]), rng.choice(alphabet)) for c in ids for t in range(rng.randint(1, most))]


CASES = [table(1, 60, 6, ["a", "bb", None]), table(2, 60, 9, ["a"]), table(3, 40, 3, ["a", "ß", "漢字", ""]),
         [(c, t, "u", "same") for c in range(40) for t in range(3)],
         [(c, 0, "u", f"first {c % 3}") for c in range(50)] + [(c, 1, "u", "x") for c in range(0, 50, 2)],
         [(7, None, "u", "z"), (7, 0, "u", "a"), (7, None, None, None), (7, 0, "u", "a"), (None, 0, "u", "a"), (100, 3, "u", "q"),
          (103, 0, "u", "a"), (205, 0, "x", "y")],
         [(c, t, "u", str(t)) for c in (1, 2, 3) for t in range(300 + c)],
         [(5, 0, "user", "x" * 300_000), (6, 0, "user", "x" * 300_000)]]


@pytest.mark.parametrize("block", [3, 512])
@pytest.mark.parametrize("case", range(len(CASES)))
def test_trie_against_every_prefix(spark, case, block):
    if block < 16 and case in (2, 6, 7):
        pytest.skip("many blocks are covered by the others")
    rows = CASES[case]
    df = spark.createDataFrame(rows, TURNS).withColumnsRenamed({}).selectExpr("*", "1 AS pos", "2 AS keys", "3 AS block")
    conversations = prefix_trie.rebuilt(prefix_trie.sequences(df))
    got = sorted(map(tuple, prefix_trie.trie(conversations, block=block).collect()), key=str)
    assert got == plain_trie(plain_rebuilt(own_turns(rows)))


def test_empty_table(spark):
    df = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df))).collect() == []


def test_role_and_text_do_not_run_together(spark):
    df = spark.createDataFrame([(1, 0, "ab", "c"), (2, 0, "a", "bc")], TURNS)
    nodes = prefix_trie.trie(prefix_trie.sequences(df)).collect()
    assert sorted((r.depth, r.n_convs) for r in nodes) == [(0, 2), (1, 1), (1, 1)]


def test_range_minima():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 8, 9, 100):
        values = rng.integers(0, 5, n)
        table = prefix_trie.RangeMinima(values)
        for i in range(n):
            for d in range(6):
                right = next((k for k in range(i, n) if values[k] < d), n)
                left = next((k for k in range(i, -1, -1) if values[k] < d), -1)
                assert table.right(np.array([i]), np.array([d]))[0] == right
                assert table.left(np.array([i]), np.array([d]))[0] == left
            for j in range(i + 1, n + 1):
                assert table.least(np.array([i]), np.array([j]))[0] == values[i:j].min()
