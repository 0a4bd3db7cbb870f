"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line (what stands between line ends) of ``LEAST_CHARS`` characters or more is a repeat if an equal line, or one within
``edits`` insertions, deletions or substitutions, stands earlier: in a document of a smaller id (null first; of two texts under one
id, the one with the lower hash), or further up in the same one.  Repeats are dropped, the rest of the text stays as it is; shorter lines are never touched.

* Equal lines are counted and placed by two 64-bit hashes; only distinct lines go on, first as hashes without their text.
* A line within the threshold of another holds one of that one's ``edits + 1`` segments whole, with at most ``i`` edits to the left
  of segment ``i`` and the others to its right.  Lines are indexed by their segments, which are cut by the length rounded down (so lines of
  about one length are cut alike; the last is measured from the end, and what is left over belongs to none), and probe the index with
  the substrings that this rule leaves.  The texts of lines that meet others at a key are fetched from their documents.
* A segment that more than ``CROWD`` lines share is not joined: its lines are cut again by their exact lengths, and split at the longest part
  that is still open, until fewer share all parts matched so far.  A part no longer than its budget has no segment that must stay:
  whatever stands in its place is within the budget, unless it is longer than the budget; then one character at least is matched, and
  the first such is the next key.  Lines that agree in everything that can be matched are within the threshold, so each is
  compared with the one that stands earliest.  No group is turned into all its pairs.
* The join of keys compares the texts of a key, at most ``CROWD`` for each, and lets a pair out only if what lies between their
  equal beginnings and ends can be within the threshold (``may_be_near``).
* Pairs are verified by bit-parallel edit distance over a band of ``2 * edits + 1`` diagonals: one step a character, after equal
  beginnings and ends, which do not change the distance, are taken off.

Null texts stay null and have no lines; empty texts have one empty line.  Ties cannot occur within a document; rows that agree in id and
text are one place, so they keep the same lines.  Other columns are left alone, whatever their names, but ``n_lines`` and
``dropped_lines`` of ``dedup_lines`` replace columns of these names.  An empty table stays empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.llm.rows import same_row, text_hashes
from coverlens.session import materialise

EDITS = 2
LEAST_CHARS = 20
CROWD = 32


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def band_distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of two texts if it is at most ``edits``, else a larger number.

    Bit ``d`` of a column's vectors is the row ``d - edits`` below the diagonal, so the band fits a machine word; the score is followed along
    the lowest diagonal and then along the last row.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    long, short = F.when(F.length(a) >= F.length(b), a).otherwise(b), F.when(F.length(a) >= F.length(b), b).otherwise(a)

    def walk(x: Column, y: Column) -> Column:
        n, m = F.size(x), F.size(y)

        def matches(c: Column, j: Column) -> Column:
            none, total = F.lit(0).cast("long"), F.lit(0).cast("long")
            for d in range(-edits, edits + 1):
                total = total + F.when(F.get(x, j + d) == c, F.lit(1 << (d + edits)).cast("long")).otherwise(none)
            last = F.least(F.lit(width - 1), F.lit(width - 2) - (j - n + edits))
            return F.struct(
                total.alias("x"),
                (j + edits < n).alias("diagonal"),
                F.call_function("shiftleft", F.lit(1).cast("long"), last).alias("row"),
            )

        def step(s: Column, t: Column) -> Column:
            vp, vn, at = s["vp"], s["vn"], t["x"]
            d0 = ((at.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(at).bitwiseOR(vn).bitwiseAND(F.lit(full).cast("long"))

            def after(d0: Column) -> Column:
                outside = F.lit(full).cast("long")
                hp = vn.bitwiseOR(outside.bitwiseXOR(d0.bitwiseOR(vp).bitwiseAND(outside)))
                hn = d0.bitwiseAND(vp)
                below = F.shiftright(d0, 1)
                down = F.when(d0.bitwiseAND(F.lit(1 << (width - 1)).cast("long")) == 0, 1).otherwise(0)
                along = F.when(hp.bitwiseAND(t["row"]) != 0, 1).when(hn.bitwiseAND(t["row"]) != 0, -1).otherwise(0)
                return F.struct(
                    hn.bitwiseOR(outside.bitwiseXOR(below.bitwiseOR(hp).bitwiseAND(outside))).alias("vp"),
                    below.bitwiseAND(hp).alias("vn"),
                    (s["score"] + F.when(t["diagonal"], down).otherwise(along)).alias("score"),
                )

            return _let(d0, after)

        start = F.struct(F.lit(((1 << (edits + 1)) - 1) << edits).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(edits).alias("score"))
        return F.aggregate(F.transform(y, matches), start, step, lambda s: s["score"])

    def same(x: Column, y: Column) -> Column:
        """How many characters two texts begin with alike."""
        differs = F.array_position(F.zip_with(x, y, lambda c, d: c.eqNullSafe(d)), False).cast("int")
        return F.when(differs == 0, F.size(y)).otherwise(differs - 1)

    def trimmed(x: Column, y: Column) -> Column:
        """The walk over what is left of both texts, at least a band's width of the shorter."""
        most = F.greatest(F.size(y) - width, F.lit(0))
        ends = F.struct(F.least(same(x, y), most).alias("head"), F.least(same(F.reverse(x), F.reverse(y)), most).alias("tail"))

        def inner(e: Column) -> Column:
            cut = e["head"] + F.least(e["tail"], most - e["head"])
            rest = [F.slice(t, e["head"] + 1, F.size(t) - cut).alias(n) for t, n in ((x, "x"), (y, "y"))]
            return _let(F.struct(*rest), lambda p: walk(p["x"], p["y"]))

        return _let(ends, inner)

    chars = lambda t: F.split(t, "")
    near = F.length(long) - F.length(short) <= edits
    # Texts no longer than the band are compared in a band of their own length.
    tiny = F.levenshtein(a, b)
    banded = _let(F.struct(chars(long).alias("x"), chars(short).alias("y")), lambda p: trimmed(p["x"], p["y"]))
    return F.when(~near, edits + 1).when(F.length(short) <= edits, tiny).otherwise(banded)


def _splits(text: Column, target: Column, budget: Column) -> Column:
    """Ways in which ``text`` can hold a segment of a text of length ``target`` within ``budget`` edits; ``target`` is more than ``budget``."""
    extra = F.length(text) - target

    def segment(i: Column) -> Column:
        begin = F.floor(i * target / (budget + 1)).cast("int")
        size = F.floor((i + 1) * target / (budget + 1)).cast("int") - begin
        low = F.greatest(-i, extra - budget + i, -begin)
        high = F.least(i, extra + budget - i, F.length(text) - size - begin)

        def at(shift: Column) -> Column:
            p = begin + shift
            return F.struct(
                i.alias("i"),
                F.substring(text, p + 1, size).alias("part"),
                (shift == 0).alias("unshifted"),
                F.array(
                    F.struct(F.substring(text, F.lit(1), p).alias("text"), begin.alias("target"), i.alias("budget")),
                    F.struct(F.substring(text, p + size + 1, F.length(text)).alias("text"), (target - begin - size).alias("target"), (budget - i).alias("budget")),
                ).alias("rest"),
            )

        return F.when(low <= high, F.transform(F.sequence(low, high), at)).otherwise(F.array().cast(_WAYS))

    return F.flatten(F.transform(F.sequence(F.lit(0), budget), segment))


def _loose(text: Column, target: Column, budget: Column, own: Column) -> Column:
    """As ``_splits`` for a ``target`` of 1 to ``budget``.

    A text no longer than the budget needs nothing in common with the other.  A longer one has a first character in common:
    the ``j``-th of the target at ``p``, which costs the longer of what stands before.  Index lines give each of theirs with all costs.
    """
    longer = F.length(text) > budget

    def at(j: Column, p: Column, cost: Column, unshifted: Column) -> Column:
        rest = F.struct(F.substring(text, p + 2, F.length(text)).alias("text"), (target - j - 1).alias("target"), (budget - cost).alias("budget"))
        return F.struct((-(j * (budget + 1) + cost) - 2).alias("i"), F.substring(text, p + 1, F.lit(1)).alias("part"), unshifted.alias("unshifted"), F.array(rest).alias("rest"))

    places = F.sequence(F.lit(0), target - 1)
    nothing = F.array().cast(_WAYS)
    free = F.array(F.struct(F.lit(-1).alias("i"), F.lit("").alias("part"), (F.length(text) == target).alias("unshifted"), F.array().cast(_PARTS).alias("rest")))
    index = F.flatten(F.transform(places, lambda j: F.transform(F.sequence(j, budget), lambda cost: at(j, j, cost, F.lit(True)))))
    probe = F.flatten(
        F.transform(places, lambda j: F.transform(F.sequence(F.lit(0), F.least(budget, F.length(text) - 1)), lambda p: at(j, p, F.greatest(j, p), F.lit(False))))
    )
    fits = F.filter(probe, lambda w: F.abs(F.length(w["rest"][0]["text"]) - w["rest"][0]["target"]) <= w["rest"][0]["budget"])
    return F.when(longer, fits).otherwise(F.concat(free, F.when(own, index).otherwise(nothing)))


_PARTS = "array<struct<text:string,target:int,budget:int>>"
_WAYS = f"array<struct<i:int,part:string,unshifted:boolean,rest:{_PARTS}>>"


def _share(i: int, target: Column, edits: int) -> Column:
    return F.floor(F.lit(i) * target / (edits + 1)).cast("int")


def _rounded(length: Column, edits: int) -> Column:
    """The length down to a step of an eighth to a sixteenth of it; steps are at least ``edits``, so a line probes two at most."""
    least = F.lit(1 << max(edits - 1, 0).bit_length())
    return length - length % F.greatest(least, F.call_function("shiftleft", F.lit(1), F.length(F.bin(length)) - 4))


def _first_keys(line: Column, edits: int) -> tuple[list[Column], list[int]]:
    """Keys of a line's segments and of all substrings that the cuts of shorter lines ask for (or null), and which are of its own cut.

    The ways are the same for all lines, so they are written out one by one and compiled.
    """
    length = F.length(line)
    own = _rounded(length, edits)
    below = F.when(own > F.greatest(length - edits, F.lit(LEAST_CHARS)), _rounded(own - 1, edits))
    keys, index = [], []
    for cut in (own, below):
        for i in range(edits + 1):
            begin = _share(i, cut, edits)
            size = _share(i + 1, cut, edits) - begin
            # With i edits to the left and the others to the right, the last segment stands at the end.
            shifts = range(max(-i, i - edits), i + 1) if i < edits else [0]
            for shift in shifts:
                if cut is own and not shift:
                    index.append(len(keys))
                part = F.substring(line, (begin + shift if i < edits else length - size) + 1, size)
                keys.append(F.when(cut.isNotNull(), F.xxhash64(cut, F.lit(i), part)))
    return keys, index


def _keys(lines: DataFrame, edits: int) -> DataFrame:
    """As all of ``_first_keys``, with whether each is of the line's own cut and the parts it leaves open."""
    targets = F.filter(F.sequence(F.length("line") - edits, F.length("line")), lambda t: t >= LEAST_CHARS)
    each = lines.select("id", "place", "line", F.explode(targets).alias("target"))
    ways = each.select("id", "place", "line", "target", F.explode(_splits(F.col("line"), F.col("target"), F.lit(edits))).alias("w"))
    own = (F.col("target") == F.length("line")) & F.col("w.unshifted")
    key = F.xxhash64("target", "w.i", "w.part").alias("key")
    return ways.select(key, "id", "place", own.alias("own"), F.lit(False).alias("loose"), F.col("w.rest").alias("rest"))


def _alike(x: Column, y: Column, most: Column) -> Column:
    """How many characters, up to ``most``, two texts begin with alike: by halving steps."""
    step = lambda e: F.call_function("shiftleft", F.lit(1), e)

    def further(at: Column, e: Column) -> Column:
        fits = (at + step(e) <= most) & (F.substring(x, at + 1, step(e)) == F.substring(y, at + 1, step(e)))
        return F.when(fits, at + step(e)).otherwise(at)

    return F.aggregate(F.sequence(F.length(F.bin(most)) - 1, F.lit(0), F.lit(-1)), F.lit(0), further)


def may_be_near(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts can be within the threshold; true for all that are.

    What lies between equal beginnings and ends begins and ends with an edit, unless it is no longer than the threshold.  The
    shorter one's core within these two has ``edits - 2`` edits at most, so one of its ``edits - 1`` segments stands whole in the other.
    """
    long, short = F.when(F.length(a) >= F.length(b), a).otherwise(b), F.when(F.length(a) >= F.length(b), b).otherwise(a)

    def cored(r: Column) -> Column:
        core = F.greatest(r["m"] - 2, F.lit(0))
        found = F.lit(False)
        for i in range(edits - 1):
            begin = F.floor(i * core / (edits - 1)).cast("int")
            size = F.floor((i + 1) * core / (edits - 1)).cast("int") - begin
            for shift in range(1 - edits, edits):
                at = r["head"] + 1 + begin
                stands = F.substring(r["y"], at + 1, size) == F.substring(r["x"], at + shift + 1, size)
                found = found | ((at + shift >= 0) & stands)
        return (r["n"] <= edits) | found

    def ended(r: Column) -> Column:
        rest = [(F.length(r[t]) - r["head"] - r["tail"]).alias(n) for t, n in (("x", "n"), ("y", "m"))]
        return _let(F.struct(r["x"].alias("x"), r["y"].alias("y"), r["head"].alias("head"), *rest), cored)

    def turned(r: Column) -> Column:
        back = F.struct(F.reverse(r["x"]).alias("x"), F.reverse(r["y"]).alias("y"), (F.length(r["y"]) - r["head"]).alias("most"))
        tail = _let(back, lambda t: _alike(t["x"], t["y"], t["most"]))
        return _let(F.struct(r["x"].alias("x"), r["y"].alias("y"), r["head"].alias("head"), tail.alias("tail")), ended)

    def headed(r: Column) -> Column:
        head = _let(F.length(r["y"]), lambda most: _alike(r["x"], r["y"], most))
        return _let(F.struct(r["x"].alias("x"), r["y"].alias("y"), head.alias("head")), turned)

    return (F.abs(F.length(a) - F.length(b)) <= edits) & _let(F.struct(long.alias("x"), short.alias("y")), headed)


def _side(rows: DataFrame, mark: str) -> DataFrame:
    return rows.withColumnsRenamed({"id": mark, "place": f"p{mark}", "line": f"l{mark}"})


def _pairs(rows: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Pairs (a, b, their places and lines) of ``rows`` (round, key, id, own) that share a key of the cut of one and may be near."""
    full = rows.join(texts, "id")
    index, probes = _side(full.where("own").drop("own"), "a"), _side(full, "b")
    # Two index lines meet both ways.
    once = F.when(F.col("own"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    shared = (index["key"] == probes["key"]) & (index["round"] == probes["round"])
    met = index.join(probes, shared & once & may_be_near(F.col("la"), F.col("lb"), edits))
    return met.select("a", "b", "pa", "pb", "la", "lb")


def _split_again(crowd: DataFrame) -> DataFrame:
    """The next keys of the lines of crowded ones: the longest open part is matched by one of its segments."""
    open_ = F.filter("rest", lambda p: (p["budget"] > 0) & (p["target"] > 0))
    # Parts without a budget must be equal: they belong to the key.
    closed = F.transform(F.filter("rest", lambda p: p["budget"] == 0), lambda p: F.struct(p["target"], p["text"]))
    longest = F.array_max(F.transform(open_, lambda p: p["target"]))
    chosen = F.array_position(F.transform(open_, lambda p: p["target"]), longest).cast("int")
    state = crowd.select("id", "place", "own", "loose", F.xxhash64("key", closed).alias("key"), open_.alias("rest"), chosen.alias("n"))
    part = F.get("rest", F.col("n") - 1)
    others = F.filter("rest", lambda p, i: i != F.col("n") - 1)
    splits = F.when(part["target"] > part["budget"], _splits(part["text"], part["target"], part["budget"])).otherwise(
        _loose(part["text"], part["target"], part["budget"], F.col("own"))
    )
    way = state.where("n > 0").select("id", "place", "own", "loose", "key", others.alias("others"), F.explode(splits).alias("w"))
    return way.select(
        F.xxhash64("key", "w.i", "w.part").alias("key"),
        "id",
        "place",
        (F.col("own") & F.col("w.unshifted")).alias("own"),
        (F.col("loose") | (F.col("w.i") < -1)).alias("loose"),
        F.concat("others", "w.rest").alias("rest"),
    )


def _is_open() -> Column:
    return F.exists("rest", lambda p: (p["budget"] > 0) & (p["target"] > 0))


def _firsts(crowd: DataFrame) -> DataFrame:
    """Pairs of lines whose parts are all matched with the earliest of their key: at most two a line."""
    closed = F.transform("rest", lambda p: F.struct(p["budget"] > 0, p["target"], F.when(p["budget"] == 0, p["text"])))
    done = crowd.where(~_is_open()).select(F.xxhash64("key", closed).alias("key"), "id", "place", "own")
    first = F.struct("place", "id")
    ids = done.groupBy("key").agg(F.min(F.when(F.col("own"), first)).alias("index"), F.min(first).alias("any"))
    pairs = done.join(ids, "key").select("id", F.explode(F.array("index.id", F.when(F.col("own"), F.col("any.id")))).alias("first"))
    return pairs.where("first <> id").select(F.least("id", "first").alias("a"), F.greatest("id", "first").alias("b"))


def _crowded(texts: DataFrame, edits: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Of lines (id, place, line) of which many share keys: rows (key, id, own) that few share, and the pairs of ``_firsts``."""
    state = materialise(_keys(texts, edits), "line-crowd")
    rows, firsts = [], []
    while True:
        counts = state.groupBy("key").agg(
            F.count(F.when(F.col("own"), 1)).alias("n"), F.count("*").alias("all"), F.bool_or("loose").alias("loose")
        )
        # Index lines of a loose part already meet where nothing is asked in common.
        meets = (F.col("n") > 0) & (F.col("all") > F.when(F.col("loose"), F.col("n")).otherwise(1))
        counts = materialise(counts.where(meets), "line-crowds")
        few = state.join(counts.where(F.col("n") <= CROWD).select("key"), "key", "left_semi")
        rows.append(few.select("key", "id", "own"))
        crowd = materialise(state.join(counts.where(F.col("n") > CROWD).select("key"), "key", "left_semi"), "line-crowd")
        if not crowd.limit(1).count():
            return rows, firsts
        firsts.append(_firsts(crowd))
        state = materialise(_split_again(crowd.where(_is_open())), "line-crowd")


def _texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, place, line) of ``lines`` (id and place), their texts taken from ``docs`` (doc_id, text)."""
    wanted = lines.groupBy(*PLACE[:3]).agg(F.collect_list(F.struct("id", "line_no")).alias("wanted"))
    wanted = materialise(wanted.withColumnsRenamed({"of_h": "h", "of_g": "g"}), "line-wanted")
    joined = docs.join(wanted, same_row(docs, wanted))
    cut = _let(
        F.split(docs["text"], "\n"),
        lambda all_: F.transform("wanted", lambda w: F.struct(w["id"].alias("id"), w["line_no"].alias("line_no"), F.get(all_, w["line_no"]).alias("line"))),
    )
    found = joined.select(wanted["doc_id"], wanted["h"].alias("of_h"), wanted["g"].alias("of_g"), F.explode(cut).alias("of"))
    # Rows that agree in id and text hold the same line.
    found = found.select("doc_id", "of_h", "of_g", "of.*").dropDuplicates(["id"])
    return found.select("id", F.struct(*PLACE).alias("place"), "line")


def _late(docs: DataFrame, lines: DataFrame, keys: list[str], index: list[int], edits: int) -> DataFrame:
    """Ids of ``lines`` (id, place, ``keys``) that are within the threshold of an earlier one."""
    each = lines.select("id", F.posexplode(F.array(*keys)).alias("n", "key")).where(F.col("key").isNotNull())
    each = each.select("key", "id", F.col("n").isin(index).alias("own"))
    met = each.groupBy("key").agg(F.count(F.when(F.col("own"), 1)).alias("n"), F.min("id").alias("least"), F.max("id").alias("most"))
    met = met.where("n > 0 and least < most").select("key", (F.col("n") > CROWD).alias("crowd"))
    rows = materialise(each.join(materialise(met, "line-keys"), "key"), "line-met")
    known = lines.select("id", *PLACE).join(rows.select("id").distinct(), "id", "left_semi")
    texts = materialise(_texts(docs, known), "line-texts")
    few, firsts = [rows.where("not crowd").select("key", "id", "own")], []
    crowded = rows.where("crowd").select("id").distinct()
    if crowded.limit(1).count():
        crowd = materialise(texts.join(crowded, "id", "left_semi"), "line-crowd-texts")
        more, firsts = _crowded(crowd, edits)
        few += more
    pairs = _pairs(reduce(DataFrame.unionByName, [each.withColumn("round", F.lit(n)) for n, each in enumerate(few)]), texts, edits)
    if firsts:
        ends = reduce(DataFrame.unionByName, firsts).distinct().join(_side(crowd, "a"), "a").join(_side(crowd, "b"), "b")
        pairs = pairs.unionByName(ends)
    late = F.when(F.col("pa") <= F.col("pb"), F.col("b")).otherwise(F.col("a"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), late.alias("id"), "la", "lb")
    measured = pairs.dropDuplicates(["a", "b"]).select("id", band_distance(F.col("la"), F.col("lb"), edits).alias("distance"))
    # Written before it is filtered: the optimiser would work the long expression into its constraints.
    return materialise(measured, "line-distances").where(F.col("distance") <= edits).select("id").distinct()


#: Where a line stands: the document's id, two hashes of its text, the line's number.
PLACE = ("doc_id", "of_h", "of_g", "line_no")


def _occurrences(docs: DataFrame) -> DataFrame:
    """(place, line, h, g) of each line that takes part."""
    of_h, of_g = text_hashes()
    lines = docs.select("doc_id", of_h.alias("of_h"), of_g.alias("of_g"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.where(F.length("line") >= LEAST_CHARS)
    return lines.select("*", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), F.reverse("line")).alias("g"))


def repeated_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """(doc_id, of_h, of_g, line_no) of each line that repeats an earlier one."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    occurrences = _occurrences(texts)
    keys, index = _first_keys(F.col("line"), edits)
    names = [f"key{n}" for n in range(len(keys))]
    lines = occurrences.select(*PLACE, "h", "g", *[key.alias(name) for key, name in zip(keys, names, strict=True)])
    lines = lines.groupBy("h", "g").agg(F.min(F.struct(*PLACE, *names)).alias("first"), F.count("*").alias("n"))
    lines = materialise(lines.select("h", "g", "n", "first.*", F.monotonically_increasing_id().alias("id")), "lines")
    late = _late(texts, lines, names, index, edits)
    place = F.struct(*PLACE)
    flagged = lines.join(late.withColumn("late", F.lit(True)), "id", "left")
    flagged = flagged.where((F.col("n") > 1) | F.col("late")).select(
        "h", "g", place.alias("place"), F.coalesce("late", F.lit(False)).alias("late")
    )
    flagged = materialise(flagged, "line-repeats")
    repeat = F.col("late") | ~place.eqNullSafe(F.col("place"))
    return occurrences.select(*PLACE, "h", "g").join(flagged, ["h", "g"]).where(repeat).select(*PLACE)


def _cut(docs: DataFrame, edits: int) -> tuple[DataFrame, Column, Column, Column]:
    """``docs`` joined with what goes, and the text that is left, the number of lines and the numbers of those that go."""
    gone = repeated_lines(docs, edits).distinct().groupBy("doc_id", "of_h", "of_g")
    gone = gone.agg(F.array_sort(F.collect_list("line_no")).alias("dropped")).withColumnsRenamed({"of_h": "h", "of_g": "g"})
    # Counted before the join, which then moves the texts only if they are asked for; no other column has so long a name.
    count = "n".ljust(1 + max(map(len, docs.columns)), "_")
    counted = docs.withColumn(count, F.coalesce(F.size(F.split("text", "\n")), F.lit(0)))
    joined = counted.join(gone, same_row(counted, gone), "left")
    dropped = F.coalesce(gone["dropped"], F.array().cast("array<int>"))
    kept = F.when(F.size(dropped) == 0, counted["text"]).otherwise(
        F.array_join(F.filter(F.split(counted["text"], "\n"), lambda line, i: ~F.array_contains(dropped, i)), "\n")
    )
    return joined, kept, counted[count], dropped


def dedup_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` with repeats cut out of ``text``, and ``n_lines`` and ``dropped_lines`` (numbers from 0) added."""
    joined, kept, n_lines, dropped = _cut(docs, edits)
    columns = [kept.alias("text") if c == "text" else docs[c] for c in docs.columns if c not in ("n_lines", "dropped_lines")]
    return joined.select(*columns, n_lines.alias("n_lines"), dropped.alias("dropped_lines"))


def drop_repeated_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` without repeated lines; a document of which no word is left goes, unless it had none before."""
    joined, kept, _, dropped = _cut(docs, edits)
    emptied = (F.size(dropped) > 0) & ~F.coalesce(kept, F.lit("")).rlike(r"\S")
    return joined.where(~emptied).select(*[kept.alias("text") if c == "text" else docs[c] for c in docs.columns])
