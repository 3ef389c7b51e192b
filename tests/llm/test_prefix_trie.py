"""Operator 13 against brute force, over shards of many sizes, and its defined cases."""

import hashlib
import random
import zlib

import pytest

from orderstream.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, path string, by int, DIGEST int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def originals(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    return {c: [x[3] for x in sorted(turns, key=lambda x: x[:3])] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute_nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, ids in members.items():
        below = [q for q in members if q[:len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(r[:len(q)] == q and len(r) == len(q) + 1 for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(p))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sample(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(0, 130):
        if c % 11 == 3:
            continue
        for t in range(rng.choice([1, 2, 3, 5, 12])):
            rows.append((c, t, rng.choice(["user", "a"]), rng.choice(["hi", "hi", "hi", "höher", "", "x" * 40])))
    rows += [(1000 + i, t, "user", f"copy {t}") for i in range(60) for t in range(4)]  # a hot group of copies
    rows += [(-7, 0, "user", "hi"), (-5, 0, "user", "hi"), (-5, 1, None, None), (-10, 0, None, "hi"), (2000, None, "a", "late?"), (2000, 0, "a", "first"),
             (2001, 1, "b", "tie"), (2001, 1, "a", "tie"), (2001, 1, "a", "tie"), (None, 0, "user", "lost"), (2002, 0, "user", "long " * 60_000)]
    return rows


@pytest.mark.parametrize("shard_turns", [1, 4, 60, 200_000])
def test_against_brute_force(spark, shard_turns):
    rows = sample()
    df, convs = frame(spark, rows).repartition(3), originals(rows)
    assert rows_of(P.trie_nodes(P.rebuilt_paths(df), shard_turns)) == brute_nodes(rebuilt(convs))
    if shard_turns == 60:
        assert rows_of(P.conversation_trie(df)) == brute_nodes(convs)


def test_turnless_and_empty(spark):
    # conversation 3 takes its only turns from an absent one: it ends at the root
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in range(100)}
    c = next(c for c in range(1, 100) if c % 5 and h[c] >= 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    ends = hashlib.sha256(str(c).encode()).hexdigest()
    assert rows_of(P.trie_nodes(P.rebuilt_paths(frame(spark, rows)))) == [(c, 0, None, 1, 0, 1, 0, ends)]
    assert P.trie_nodes(P.rebuilt_paths(frame(spark, rows).where("false"))).count() == 0


def test_long_conversation(spark):
    rows = [(5, t, "user", str(t % 3)) for t in range(3000)] + [(105, t, "user", str(t % 3)) for t in range(2999)]
    got = {(r.conv_id, r.depth): r for r in P.conversation_trie(frame(spark, rows)).collect()}
    assert len(got) == 3001 and got[5, 0].n_leaves == 1 and got[5, 0].saved_tokens == 2999 and got[5, 3000].n_convs == 1 and got[5, 2999].n_convs == 2


def test_tree_is_balanced_and_walks_in_order():
    tree, symbols = P.TernaryTree(), list(range(1023))
    for k in P.medians(len(symbols)):
        tree.insert([symbols[k], 0], [1, 1])
    node, depth = [(tree.equal[0], 1)], 0
    while node:
        at, d = node.pop()
        depth = max(depth, d)
        node += [(x, d + 1) for x in (tree.low[at], tree.high[at]) if x >= 0]
    assert depth == 10
    assert [tree.symbol[n] for n, _, d in tree.walk() if d == 1] == symbols
    assert tree.chain([500, 0])[0] == 0 and len(tree.symbol) == 1 + 2 * 1023
