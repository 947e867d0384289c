"""The prefix trie of conversations against brute force."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from parcelforge.llm import conversation_trie as trie

KIND = "conv_id long, turn long, role string, text string"


def ordered(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    return {c: [x[3:] for x in sorted(t)] for c, t in own.items()}


def nodes_of(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].split()) if p else 0
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if len(conversations[c]) == len(p))))
    return sorted((min(own), len(p), min(members[p[:-1]]) if p else -1, len(own), kids[p], leaves[p], saved[p], sha256(ends(p).encode()).hexdigest()) for p, own in members.items())


def told(found):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], *tuple(r)[3:]) for r in found.collect())


def made(seed, n, longest, vocabulary):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 10 * n), n):
        rows += [(c, k, r.choice(["user", "assistant"][k % 2 :: 2]), " ".join(r.choices("ab c".split(), k=r.choice(vocabulary)))) for k in range(r.randrange(1, longest))]
    return rows


@pytest.mark.parametrize(("seed", "n", "longest", "vocabulary", "ranges"), [(1, 150, 6, [1, 2], 5), (2, 60, 30, [1], 7), (3, 200, 4, [0, 1, 6], 1), (4, 40, 9, [1], 40)])
def test_equals_brute_force(spark, seed, n, longest, vocabulary, ranges):
    rows = made(seed, n, longest, vocabulary)
    turns = trie.numbered_turns(spark.createDataFrame(rows, KIND))
    assert told(trie.prefix_trie(turns, turns, ranges)) == nodes_of(ordered(rows))


def test_a_chain_of_ends_under_one_first_turn_and_rebuilt_starts(spark):
    rows = [(c, k, "user", f"t{k} word") for c in range(60) for k in range(c % 45 + 1)] + [(c, 0, "user", "same") for c in range(100, 400)]
    frame = spark.createDataFrame(rows, KIND)
    turns = trie.numbered_turns(frame)
    assert told(trie.prefix_trie(turns, turns, 6)) == nodes_of(ordered(rows))
    own = ordered(rows)
    rebuilt = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + t[h:]
    assert told(trie.prefix_trie(trie.shared_starts(turns, 20, 4), frame, 6)) == nodes_of(rebuilt)


def test_children_that_wait_look_their_parent_up(spark, monkeypatch):
    monkeypatch.setattr(trie, "WAITING", 3)  # within this process alone: tasks take the module's own, and both must be right
    rows = made(9, 300, 4, [1, 2])
    out, own = [], ordered(rows)
    one = trie._Range(None, out.append)
    digest = lambda t: sha256(repr(t).encode()).digest()[: trie.TURN]
    paths = defaultdict(list)
    for c, t in own.items():
        paths[b"".join(map(digest, t))].append((c, t))
    for path in sorted(paths):
        held = paths[path]
        one.add(path, [len(x[1].split()) for x in held[0][1]], len(held), min(c for c, _ in held), sha256(",".join(str(c) for c, _ in sorted(held)).encode()).hexdigest())
    one.finish(None)
    by_key = {r[8]: r[0] for r in out if r[8] is not None}
    parent = lambda r: -1 if r[1] == 0 else r[2] if r[9] is None else by_key[r[9]]
    assert any(r[9] is not None for r in out)
    assert sorted((r[0], r[1], parent(r), *r[3:7], r[7] or trie.NO_ENDS) for r in out) == nodes_of(own)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", "a" * 300_000 + " b"), (None, 0, "user", "x"), (2, 5, "u", "ser"), (2, 5, "us", "er"), (3, 5, "u", "ser"), (3, 6, "us", "er"), (4, 1, "", ""), (5, 1, "x", "y")]
    frame = spark.createDataFrame(rows, KIND).select("*", *(F.lit(n).alias(n) for n in ("place", "digest", "words", "path", "part", "kind", "first", "n", "key")))
    turns = trie.numbered_turns(frame)
    assert told(trie.prefix_trie(turns, frame, 3)) == nodes_of(ordered(rows))
    none = trie.numbered_turns(frame.limit(0))
    assert trie.prefix_trie(none, none).count() == 0
    turnless = spark.createDataFrame([(7,), (9,), (7,)], "conv_id long")
    assert told(trie.prefix_trie(none, turnless)) == [(7, 0, -1, 2, 0, 1, 0, sha256(b"7,9").hexdigest())]
