"""Null and repeated ids, empty tables, clashing columns and very long texts in the operators for training text."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from coverlens.llm import html_text, quality_cotrain, sampling, toxicity
from coverlens.llm.decontamination import leaks, without_leaks
from coverlens.llm.line_dedup import dedup_lines, drop_repeated_lines
from coverlens.llm.ngram_join import jaccard_components, keep_one
from coverlens.llm.rows import text_hashes
from coverlens.llm.ship import ship
from coverlens.llm.token_files import token_digest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_token_files_keep_null_and_repeated_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    low = -(1 << 63)
    rows = [(None, "a null id"), (low, "the lowest id"), (None, None), (3, "one"), (3, "another of three"), (3, "one"), (9, "")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start long, part string")
    library = Tokenizer.from_file(path)
    wanted = sorted(
        ((i, len(ids := library.encode(t or "", add_special_tokens=False).ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for i, t in rows), key=str
    )
    found = token_digest(docs, path).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=str) == wanted
    order = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == [None, None, low, 3, 3, 3, 9]
    assert [r["start"] for r in order] == [sum(r["n_tokens"] for r in order[:i]) for i in range(len(order))]


def test_samples_are_drawn_by_id_and_bounded(spark):
    rows = [(i % 300, f"text {i}", "en", "s", 5) for i in range(900)] + [(7, f"hot {i}", "en", "s", 5) for i in range(2000)]
    rows += [(None, "no id", "en", "s", 5), (500, None, "en", "s", 0), (501, "x" * 30_000, "en", "s", 9), (502, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    kinds = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(i, 1) for i in (500, 501, 502)], "doc_id long, toxic int")
    found = sampling.drawn(docs, kinds, "toxic", {0: 40, 1: 60}, ["text", "lang"], 1, 1000)
    got = found.collect()
    assert found.columns == ["doc_id", "toxic", "nth", "text", "lang"]
    assert sorted(r["nth"] for r in got if r["toxic"] == 0) == list(range(1, 41)) and len({r["doc_id"] for r in got}) == 100
    again = sampling.drawn(docs.repartition(5), kinds, "toxic", {0: 40, 1: 60}, ["text", "lang"], 1, 1000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
    every = sampling.drawn(docs, kinds, "toxic", {0: 1000, 1: 1000}, ["text"], 0, 40_000).collect()
    assert len(every) == 303 and {r["doc_id"] for r in every} >= {500, 501, 502}


@pytest.mark.parametrize("score", [quality_cotrain.quality_scores, toxicity.toxicity_scores])
def test_classifiers_on_odd_tables(spark, score):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(["good", "bad", "word", "other"], k=9)), "en", "s", 9) for i in range(60)]
    rows += [(None, "no id"), (5, "another five"), (5, None), (70, ""), (71, "z" * 120_000), (72, "a b " * 40_000)]
    rows = [(*r, None, None, None)[:5] if len(r) == 2 else r for r in rows]
    docs = spark.createDataFrame([(*r, 1.0, 1) for r in rows], f"{DOCS}, score double, toxic int")
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0, "x") for i in range(50)] + [(5, None, None, "y"), (None, 1, 1, "z")],
                                   "doc_id long, quality int, toxic int, text string")
    found = score(docs, docs, labels).collect()
    assert sorted((r["doc_id"] for r in found), key=str) == sorted((r[0] for r in rows), key=str)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert score(docs.limit(0), docs.limit(0), labels).count() == 0
    assert score(docs, docs.limit(0), labels.limit(0)).count() == len(rows)


def _shingles(text):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(found[k : k + 5]) for k in range(len(found) - 4)) or (frozenset([tuple(found)]) if found else frozenset())


def _components(rows):
    """(doc_id, n_shingles, component_id, class) of each row, every row with all others."""
    sets = [_shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if root(k) == root(i) and rows[k][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None), root(i)))
    return out


def _near_copies(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") + draw.choice("klmnopqrst") + str(draw.randrange(40))
    base = [" ".join(word() for _ in range(30)) for _ in range(12)]

    def near(text):
        out = text.split()
        out[draw.choice([0, -1])] = "other"
        return " ".join(out)

    rows = [(7, base[0]), (7, base[1]), (8, near(base[0])), (9, near(base[1])), (None, base[2]), (None, near(base[2])), (None, base[3])]
    rows += [(10, near(base[3])), (11, base[4]), (11, base[4]), (11, base[4].upper()), (12, None), (12, ""), (13, "two words"), (14, "two  WORDS")]
    rows += [(15, " "), (20, base[5]), (20, near(base[5])), (21, base[5])]
    rows += [(100 + i, near(base[6 + i % 6])) for i in range(40)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_with_null_and_repeated_ids(spark, seed):
    rows = _near_copies(seed)
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id long, text string, rep long, digest string").repartition(3)
    found = [tuple(r) for r in jaccard_components(docs).collect()]
    assert sorted(found, key=str) == sorted((r[:3] for r in _components(rows)), key=str)
    kept = [r["rep"] for r in keep_one(docs).collect()]
    assert len(kept) == len(set(kept))
    classes = {}
    for i, (_, n, component, root) in enumerate(_components(rows)):
        if n:
            classes.setdefault((root, component), []).append(i)
        else:
            assert i in kept
    for (_, component), members in classes.items():
        stay = [i for i in members if i in kept]
        assert len(stay) == 1 and rows[stay[0]][0] == component


def test_jaccard_join_of_no_rows_and_of_a_long_text(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard_components(empty).count() == 0 and keep_one(empty).count() == 0
    long = " ".join(f"w{i}" for i in range(70_000))
    rows = [(1, long), (2, long + " end"), (3, "a b c")]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 69_996, 1), (2, 69_997, 1), (3, 1, 3)]


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _java_hash(spark, texts):
    frame = spark.createDataFrame([(t,) for t in set(texts)], "text string")
    return {r["text"]: (r["h"], r["g"]) for r in frame.select("text", *text_hashes()).collect()}


def _kept_lines(spark, rows, edits=2, least=20):
    """The text of each row without repeats: every line against all that stand before it."""
    hashes = _java_hash(spark, [t for _, t in rows])
    places = []
    for row, (doc_id, text) in enumerate(rows):
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(line) >= least:
                places.append(((doc_id is not None, doc_id or 0, *hashes[text], n), line, row, n))
    places.sort(key=lambda p: p[0])
    gone, seen = set(), []
    for place, line, row, n in places:
        if any(place != before and _distance(line, other) <= edits for before, other in seen):
            gone.add((row, n))
        seen.append((place, line))
    return [None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (row, n) not in gone) for row, (_, t) in enumerate(rows)]


def test_line_dedup_with_null_and_repeated_ids_and_clashing_columns(spark):
    line = "a paragraph of some length number {}".format
    own = ["the quick brown fox jumps", "over a lazy dog in spring", "no line like this one here", "something else altogether"]
    rows = [(7, f"{line(1)}\n{own[0]}"), (7, f"{own[1]}\n{line(2)}x"), (8, f"{line(1)}\n{own[2]}"), (None, f"{own[3]}\nshort"), (None, f"{own[2]}\n{line(9)}")]
    rows += [(9, None), (9, ""), (10, "short\nshort"), (11, f"{own[0]}!!\n{own[0]}"), (7, f"{line(1)}\n{own[0]}"), (12, "z" * 30_000 + "\n" + "z" * 30_001)]
    docs = spark.createDataFrame([(*r, i, "x", "y", 5) for i, r in enumerate(rows)], "doc_id long, text string, n_lines long, dropped string, of_doc string, dropped_lines int")
    wanted = _kept_lines(spark, rows[:-1]) + ["z" * 30_000]
    left = {r["n_lines"]: r["text"] for r in drop_repeated_lines(docs).collect()}
    word = lambda t: t is not None and t.strip()
    assert left == {i: t for i, t in enumerate(wanted) if word(t) or not word(rows[i][1])}
    found = dedup_lines(docs.drop("n_lines").withColumnRenamed("dropped", "h").withColumnRenamed("of_doc", "place"))
    assert found.columns == ["doc_id", "text", "h", "place", "n_lines", "dropped_lines"]
    assert sorted(str(r["text"]) for r in found.collect()) == sorted(map(str, wanted))
    assert dedup_lines(docs.limit(0)).count() == 0 and drop_repeated_lines(docs.limit(0)).columns == docs.columns


def test_leaks_are_filtered_by_row(spark):
    item = "seven words of an item that nobody would write by chance at all twice over again"
    rows = [(1, f"before {item} after"), (1, "clean text under the same id"), (None, item), (None, "clean without id"), (2, None), (3, ""), (4, "x " * 60_000 + item)]
    docs = spark.createDataFrame([(*r, i, 1.0) for i, r in enumerate(rows)], "doc_id long, text string, item_id long, score double").repartition(2)
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (None, ""), (3, "other " * 9)], "item_id long, text string")
    assert sorted(r["item_id"] for r in without_leaks(docs, items).collect()) == [1, 3, 4, 5]
    found = {(r["doc_id"], r["item_id"]) for r in leaks(docs, items).collect()}
    assert found == {(1, 1), (None, 1), (4, 1)}
    assert without_leaks(docs, items.limit(0)).count() == len(rows) and without_leaks(docs.limit(0), items).count() == 0


def test_toxic_rows_are_filtered_by_row(spark):
    draw = random.Random(3)
    bad, good = ["vile", "nasty", "awful", "horrid"], ["calm", "kind", "gentle", "bright"]
    text = lambda bag: " ".join(draw.choices(bag + ["the", "of", "and"], k=30))
    rows = [(i, text(bad if i % 2 else good)) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    odd = [(1, text(good)), (None, text(bad)), (None, text(good)), (400, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows + odd)], "doc_id long, text string, h int")
    kept = {r["h"] for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept >= {300, 302} and 301 not in kept
    assert sum(i in kept for i in range(1, 300, 2)) <= 5 and sum(i in kept for i in range(0, 300, 2)) >= 145


PROSE = "A long paragraph of plain prose, with commas, and with several words in it. It goes on for some time, as prose does."


def test_short_blocks_of_an_article_follow_their_neighbours():
    points = "".join(f"<li>point {i}</li>" for i in range(10))
    cells = "".join(f"<tr><td>row {i}</td><td>{i}</td></tr>" for i in range(15))
    menu = "<nav><ul><li><a href=x>menu</a></li></ul></nav>"
    page = (
        f"<body>{menu}<article><h1>Title</h1>{f'<p>{PROSE}</p>' * 12}<ul>{points}</ul>{f'<p>{PROSE}</p>' * 12}"
        f"<div class='share-price'>Up 3 percent</div><p>{PROSE}</p><div class='share-buttons'>Tweet</div><div class='user-comments'><p>{PROSE}</p></div>"
        f"<p>{PROSE}</p><table>{cells}</table><ul class='related-links'><li><a href=y>elsewhere</a></li></ul></article><ul><li>foot</li></ul></body>"
    )
    wanted = ["Title", *[PROSE] * 12, *[f"point {i}" for i in range(10)], *[PROSE] * 12, "Up 3 percent", PROSE, PROSE]
    for i in range(15):
        wanted += [f"row {i}", str(i)]
    assert html_text.main_text(page).split("\n") == wanted


def test_pages_of_any_kind(spark):
    deep = "<div>" * 3000 + PROSE + "</div>" * 3000
    rows = [(1, "u", None), (2, None, ""), (3, "u", deep), (4, "u", f"<p>{PROSE}</p>" * 20_000), (None, "u", f"<p>{PROSE}"), (4, "u", "<p>other</p>")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted(((r["page_id"], r["n_chars"]) for r in html_text.extract(pages).collect()), key=str)
    n = len(PROSE)
    assert found == sorted([(1, 0), (2, 0), (3, n), (4, (n + 1) * 20_000 - 1), (None, n), (4, 5)], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_links_and_classes_do_not_pass_through_the_driver(spark, monkeypatch):
    from coverlens.llm import components as rounds
    from coverlens.llm import ngram_join

    plans, written = {}, rounds.materialise

    def kept(df, label):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    monkeypatch.setattr(rounds, "materialise", kept)
    monkeypatch.setattr(ngram_join, "materialise", kept)
    rows = [(n, n, n + 1) for n in range(1, 40)]
    links = spark.createDataFrame([(a, b) for _, a, b in rows], "a long, b long")
    found = rounds.components(links, spark.createDataFrame([(77,), (5,)], "id long"))
    assert sorted(map(tuple, found.collect())) == [*((n, 1) for n in range(1, 41)), (77, 77)]
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
    classes = written(spark.createDataFrame([(n, n // 2 * 2) for n in range(8)], "id long, component long"), "classes")
    joined = ngram_join._with_links(classes, spark.createDataFrame([(1, 6)], "a long, b long"))
    assert sorted(map(tuple, joined.collect())) == [(n, 0 if n in (6, 7) else n // 2 * 2) for n in range(8)]
    assert {"component-labels", "jaccard-between", "jaccard-classes"} <= set(plans)
    assert not [label for label, texts in plans.items() if any("BroadcastExchange" in text for text in texts)]
