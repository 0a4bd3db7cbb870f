"""The conversation trie against one built in memory, its list ranking on lists of its own."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from coverlens.llm import conversation_trie
from coverlens.llm.conversation_trie import prefix_trie, turn_rows, with_shared_openings
from coverlens.llm.list_ranking import LINK, list_prefixes, places, walk
from coverlens.llm.ship import ship
from coverlens.session import materialise

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def _digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def _rebuilt(rows):
    """The contract's conversations, by plain lists; equal turns in the order of their digests."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), _digest(role, text), (role, text)))
    own = {c: [t[2] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _brute(sequences):
    nodes = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    below = defaultdict(lambda: [0, 0, 0])  # children, leaves, saved tokens
    for node in sorted(nodes, key=len, reverse=True):
        sums = below[node]
        sums[1] += sums[0] == 0
        sums[2] += (len(nodes[node]) - 1) * (len(WORD.findall(node[-1][1])) if node else 0)
        if node:
            up = below[node[:-1]]
            up[0], up[1], up[2] = up[0] + 1, up[1] + sums[1], up[2] + sums[2]
    out = []
    for node, members in nodes.items():
        ends = sorted(c for c in members if len(sequences[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), *below[node], digest))
    return sorted(out, key=str)


def _frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, part int, digest string"
    ).repartition(3)


def _run(spark, rows, solo=None):
    turns = turn_rows(_frame(spark, rows))
    found = prefix_trie(with_shared_openings(turns), turns.select("conv_id").distinct(), solo)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def _rows(seed, convs=150, most=7):
    draw = random.Random(seed)
    texts = ["hello there", "one two three", "ok", "", None, "Straße – é", " a\tb c\x0bd "]
    rows = []
    for c in draw.sample(range(convs * 2), convs):
        rows += [(c, t, draw.choice(["user", "assistant", None]), draw.choice(texts)) for t in range(draw.randint(1, most))]
    rows += [(c, t, "user", "the same") for c in range(1000, 1090) for t in range(2)]  # many copies
    rows += [(c, 0, "system", "shared opening") for c in range(2000, 2300, 3)]  # one node with many children
    rows += [(c, 1, "user", f"question {c}") for c in range(2000, 2300, 3)]
    return rows


ODD = [
    (None, 1, "user", "no conversation"), (5, None, "user", "first"), (5, None, "user", "again"), (5, 1, None, None), (5, 1, None, None), (5, 1, "", ""),
    (-7, 1, "user", "below zero"), (-7, 2, "user", "below zero"), (-20, 1, "a", "x"), (-23, 1, "a", "x"), (0, 3, "ab", "c"), (1, 3, "a", "bc"),
    (40, 1, "user", "w " * 100_000),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_trie_in_memory(spark, seed):
    rows = _rows(seed) + ODD
    assert _run(spark, rows) == _brute(_rebuilt(rows))


def test_rounds_of_ranking_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "ARCS", 60)
    monkeypatch.setattr(conversation_trie, "PIECE", 40)
    rows = _rows(3) + ODD
    assert _run(spark, rows, solo=6) == _brute(_rebuilt(rows))


def test_one_conversation_over_many_tasks(spark):
    rows = [(3, t, "user", f"turn {t % 5}") for t in range(900)] + [(4, t, "user", f"turn {t % 5}") for t in range(700)] + [(9, 0, "user", "x")]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert _run(spark, rows) == _brute(_rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_small_tables(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(None, 1, "a", "b")]) == []
    for rows in ([(1, 1, "a", "b")], [(0, 0, "a", "b c")], [(20, 0, "a", "b c"), (21, 0, "a", "b c")], ODD + ODD):
        assert _run(spark, rows) == _brute(_rebuilt(rows))


@pytest.mark.parametrize("solo", [1, 5, 1000])
def test_list_prefixes(spark, solo):
    draw = random.Random(solo)
    order = draw.sample(range(-50, 250), 120)
    links = [(order[i], i % 7, *((order[i + 1], (i + 1) % 7) if i + 1 < 120 else (None, None)), draw.randrange(9), draw.randrange(99)) for i in range(120)]
    wanted, sums = {}, np.zeros(2, int)
    for conv, pos, _, _, leaf, saved in links:
        wanted[conv, pos] = tuple(int(v) for v in sums)
        sums += (leaf, saved)
    frame = materialise(spark.createDataFrame(draw.sample(links, 120), LINK), "links")
    assert {(r[0], r[1]): (r[2], r[3]) for r in list_prefixes(frame, solo).collect()} == wanted


def test_walk_and_places():
    head, sums = walk(np.array([2, -1, 1, -1]), np.array([[1], [2], [4], [8]]))
    assert head.tolist() == [0, 0, 0, 3] and sums[:, 0].tolist() == [1, 7, 5, 8]
    conv, pos = np.array([5, -3, 5]), np.array([0, 2, 1])
    assert places(conv, pos, np.array([5, -3, 9, 5, -1]), np.array([1, 2, 0, 7, -1])).tolist() == [2, 1, -1, -1, -1]
