"""Ranked lexical search against a plain reading of the formula."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from coverlens.llm import lexical_search
from coverlens.llm.lexical_search import guarded, occurrences, search
from coverlens.llm.ship import ship

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def _terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, k=20):
    counts = [(doc_id, Counter(_terms(text))) for doc_id, text in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(c.total() for _, c in counts)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c in counts:
            score = 0
            for term in _terms(text):
                if c[term]:
                    df = sum(term in other for _, other in counts)
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    measure = 100 - 25 + ((25 * c.total() * n_docs) // n_terms)
                    score += weight * ((1000000000 * c[term]) // (1000 * c[term] + 12 * measure))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, row[3], -row[0]) for i, row in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def _run(spark, docs, items, **more):
    left = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, rank int, item_id string")
    right = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    found = search(left, right, **more)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def _tables(seed):
    draw = random.Random(seed)
    bag = ["alpha", "Beta", "GAMMA", "straße", "Straße", "ÉTÉ", "été", "x1", "1", "日本", "a", "ab", "abc", "zeta_eta", "it's"]
    text = lambda n: draw.choice([" ", ", ", "\n", "\x00", "--"]).join(draw.choices(bag, k=draw.randint(1, n)))
    docs = [(i, text(30)) for i in range(60)]
    docs += [docs[3], docs[3], (5, "another text of five, alpha alpha"), (None, "alpha beta"), (None, None), (70, None), (71, ""), (72, " .,;")]
    docs += [(80, "alpha " * 50_000 + "seldom"), (81, "seldom" * 40_000)]
    items = [(i, text(12)) for i in range(25)] + [(1, "another beta"), (2, None), (3, ""), (4, "..."), (None, "seldom zeta"), (9, "no-such-word")]
    return docs, items + items[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = _tables(seed)
    assert _run(spark, docs, items) == _brute(docs, items)


def test_blocks_of_items_and_small_steps_change_nothing(spark, monkeypatch):
    docs, items = _tables(3)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 400)
    monkeypatch.setattr(lexical_search, "CELLS", 50)
    assert _run(spark, docs, items, k=3) == _brute(docs, items, 3)


def test_sums_beyond_doubles(spark, monkeypatch):
    docs, items = _tables(4)
    monkeypatch.setattr(lexical_search, "EXACT", 0)
    assert _run(spark, docs, items) == _brute(docs, items)


def test_ties_by_id_and_repeated_rows(spark):
    docs = [(i, "one two") for i in (5, 3, 9, 3)] + [(7, "other words")]
    assert _run(spark, docs, [(1, "two two one")], k=3) == _brute(docs, [(1, "two two one")], 3)
    assert [r[2] for r in _run(spark, docs, [(1, "two")], k=3)] == [3, 3, 5]


def test_empty_tables(spark):
    assert _run(spark, [], [(1, "a")]) == []
    assert _run(spark, [(1, "a")], []) == []
    assert _run(spark, [(1, None), (2, "")], [(1, "a")]) == []


def test_automaton_meets_whole_terms_only():
    automaton = guarded([b"ab", b"b", "é".encode()])
    assert occurrences(automaton, "AB abc b,b-É é ab".encode()) == ([0, 1, 1, 2, 0], 7)
