"""The pipeline's five stages on invented rows, each against a plain version on what the one before kept."""

from __future__ import annotations

import random

import corpus_pipeline
import public_tokenizers
from test_edges import _components, _kept_lines
from tokenizers import Tokenizer

from coverlens.llm.queries import WORD_TOKENIZER
from coverlens.session import materialise, scratch_path

BAD, GOOD = ["vile", "nasty", "awful", "horrid"], ["calm", "kind", "gentle", "bright"]
ITEM = "seven words of an item that nobody would write by chance at all twice over again"


def _rows(draw):
    def text(bag, n=40):
        return " ".join(draw.choice(bag) if draw.random() < 0.3 else f"{draw.choice('abcdefgh')}{draw.randrange(900)}" for _ in range(n))

    rows = [(i, text(BAD if i % 2 else GOOD)) for i in range(200)]
    long = [text(GOOD, 60) for _ in range(4)]
    # Null and repeated ids, near and exact copies, repeated lines, leaks, empty and long texts.
    rows += [(300, long[0]), (300, long[1]), (301, long[0] + " tail"), (302, long[1] + " tail"), (None, long[2]), (None, long[2] + " tail"), (None, text(BAD))]
    rows += [(310, text(GOOD) + "\nthis line stands in several documents"), (311, text(GOOD) + "\nthis line stands in several documents!")]
    rows += [(312, "this line stands in several documents"), (320, f"{text(GOOD)} {ITEM} {text(GOOD)}"), (320, text(GOOD)), (None, f"{text(GOOD)} {ITEM}")]
    rows += [(330, None), (331, ""), (332, text(GOOD, 6000)), (333, long[3]), (333, long[3])]
    return rows


def _plain(spark, name, rows):
    """Rows (doc_id, text, n) that a stage keeps, without any of its code."""
    if name == "toxicity":
        return [r for r in rows if not set(BAD) & set((r[1] or "").split())]
    if name == "line_dedup":
        texts = _kept_lines(spark, [(r[0], r[1]) for r in rows])
        return [(r[0], t, r[2]) for r, t in zip(rows, texts, strict=True) if (t or "").strip() or not (r[1] or "").strip()]
    if name == "ngram_jaccard_join":
        kept, seen = [], set()
        for row, (doc_id, n, component, root) in zip(rows, _components([(r[0], r[1]) for r in rows]), strict=True):
            if not n or (doc_id == component and root not in seen):
                kept.append(row)
                seen.add(root if n else None)
        return kept
    return [r for r in rows if ITEM not in (r[1] or "")]


def test_every_stage_keeps_what_a_plain_version_keeps(spark):
    rows = [(*r, n) for n, r in enumerate(_rows(random.Random(4)))]
    docs = spark.createDataFrame([(i, t, "en", "src", n) for i, t, n in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality long, toxic long")
    items = spark.createDataFrame([(1, ITEM), (2, "words that stand in no document whatever they are"), (None, None)], "item_id long, text string")
    folder = scratch_path(spark, "tables")
    for name, frame in (("documents", docs), ("labels", labels), ("benchmark", items)):
        frame.write.parquet(f"{folder}/{name}.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "packing"]
    current, expected = spark.read.parquet(f"{folder}/documents.parquet"), rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = materialise(stage(spark, current, folder), name)
        assert current.columns == docs.columns
        got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in current.collect()), key=str)
        expected = _plain(spark, name, expected)
        same = [(i, t, -1 if name == "ngram_jaccard_join" and t and t == rows[-1][1] else n) for i, t, n in got]
        wish = [(i, t, -1 if name == "ngram_jaccard_join" and t and t == rows[-1][1] else n) for i, t, n in expected]
        assert sorted(same, key=str) == sorted(wish, key=str), name
        expected = [tuple(r) for r in got]
    pieces = [r.asDict() for r in corpus_pipeline.STAGES[-1][1](spark, current, folder).collect()]
    library = Tokenizer.from_file(public_tokenizers.path(WORD_TOKENIZER))
    sizes = sorted(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in expected)
    whole = {}
    for p in pieces:
        whole.setdefault((p["sequence_id"]), []).append((p["offset"], p["length"]))
    assert sum(p["length"] for p in pieces) == sum(sizes) and all(p["length"] <= 4096 for p in pieces)
    for places in whole.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096
    assert len([p for p in pieces if p["piece"] == 0]) == len(sizes)


def test_no_documents(spark):
    folder = scratch_path(spark, "tables")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
