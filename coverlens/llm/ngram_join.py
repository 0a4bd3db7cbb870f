"""N-gram Jaccard join with a count-vector R-tree.

Texts are sets of word shingles.  The join links two sets of Jaccard similarity of at least 3/4 (a ratio of
integers, so no rounding) and gives each text the smallest id its links reach.

* Equal sets become one representative, numbered by the set's 128-bit digest, so texts under one id stay apart.
* Every shingle is hashed into one of ``GROUPS`` groups; the group counts are the set's point.  The summed
  coordinate minima of two points bound the overlap of their sets from above.  R-trees stand on sums of ``GROUPS / COARSE``
  neighbouring counts; what they find is bounded again by the whole points before it leaves the task, so that texts which
  fall a little short of the threshold are not handed on once for every block they share.
* Points alone do not tell large sets apart, so they are indexed inside blocks: sets that share a shingle
  among the rarest quarter of theirs.  Any two linked sets share such a shingle (prefix rule), so blocks lose
  nothing.  Rarity comes from one count over all texts.
* Blocks come from one count by shingle.  A bit map of the shared ones keeps the rest from being shuffled again, and blocks of the same
  members are one block (compared by sums of hashes, so repeated rows do not cancel).
* Pairs of a block's members with a few hubs (its lowest and highest member and the one that stands in most blocks; then one outside
  that one's class) are bounded and verified first.  What these links join needs no more work, so a group of copies costs
  links in proportion to its size.  Blocks that
  still hold several classes go to R-trees, cut at random into chunks of ``CHUNK`` points: each pair of chunks is
  one task that emits only pairs of different classes whose bound reaches the threshold.
* Surviving pairs are verified on the whole sets, rebuilt from the texts that take part.

Null and empty texts have no shingles, are linked with nothing and are their own class.  Repeated rows and ties
fall under the smallest id.  Texts that share an id are compared each on its own, also those of null ids; a class's id is the smallest known
one, null if it has none.  Empty tables give no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.llm.bytehash import NOT_SPACE, shingles, words
from coverlens.llm.components import components
from coverlens.llm.rows import ROW, same_row, text_hashes, without
from coverlens.session import materialise

SHINGLE = 5
GROUPS = 1024
COARSE = 256  # coordinates of the R-trees
MOST = 0xFF  # sets with more shingles in a group have a point that bounds nothing: this in all groups
BEYOND = 1 << 23  # the coordinates of such a point: more than any group of shingles of a text of 2 GB
NO_ID = -(1 << 63)  # stands for a null id while blocks are made; a real id of this value only makes a block larger
BITS = 1 << 25  # of the filter on shared keys: a fixed size, sent to every task
CELLS = 1 << 18  # of the rarity count: a fixed size, sent to every task
CHUNK = 512
LEAF = 16
PAIRS = 500  # pairs of sets that are rebuilt at once


def required(total):
    """The least overlap of two sets with this sum of sizes: 100 * o >= 75 * (total - o)."""
    return (3 * total + 6) // 7


def _cells(sets: np.ndarray) -> np.ndarray:
    return (sets & np.uint64(CELLS - 1)).astype(np.int64)


def _rarity(docs: DataFrame, shingle: int) -> np.ndarray:
    """How often shingles of each cell occur in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for block in words(batch.column(0), NOT_SPACE):
                found = np.concatenate([np.zeros(0, np.uint64), *shingles(block, shingle)])
                seen += np.bincount(_cells(found), minlength=CELLS)
        cells = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(seen[cells])], names=["cell", "n"])

    counted = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # at most CELLS rows, never as Python objects
    rarity = np.zeros(CELLS, dtype=np.int64)
    rarity[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return rarity


def _point(found: np.ndarray) -> np.ndarray:
    """How many shingles fall into each group."""
    counts = np.bincount((found >> np.uint64(54)).astype(np.int64), minlength=GROUPS)
    if counts.max() > MOST or counts.min() == MOST:
        return np.full(GROUPS, MOST, dtype=np.uint8)
    return counts.astype(np.uint8)


def _points(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, GROUPS)


def _boundless(points: np.ndarray) -> np.ndarray:
    return points.min(axis=1, initial=MOST) == MOST


def _coarse(points: np.ndarray) -> np.ndarray:
    """The points as the R-trees take them."""
    found = points.reshape(len(points), COARSE, GROUPS // COARSE).sum(axis=2, dtype=np.int32)
    found[_boundless(points)] = BEYOND
    return found


def _reaches(one: np.ndarray, two: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether the bound of the points in each row reaches what sets with these sums of sizes need."""
    return (np.minimum(one, two).sum(axis=1, dtype=np.int64) >= required(total)) | (_boundless(one) & _boundless(two))


def _own(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text, h, g): ``doc`` is never null, and two hashes of the text tell rows of one id apart."""
    known = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(known, F.lit(NO_ID)).alias("doc"), known.alias("doc_id"), "text", *text_hashes())


def _signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc, doc_id, h, g, n, digest, counts) of each text."""
    schema = "doc long, doc_id long, h long, g long, n long, digest binary, counts binary"
    kinds = (*[pa.int64()] * 5, pa.binary(), pa.binary())
    arrow = pa.schema([(c.split()[0], k) for c, k in zip(schema.split(", "), kinds, strict=True)])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in words(batch.column(2), NOT_SPACE):
                sets = shingles(block, shingle)
                rows = slice(block.first, block.first + block.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k)[rows] for k in (0, 1, 3, 4)],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([_point(s).tobytes() for s in sets], pa.binary()),
                    ],
                    schema=arrow,
                )

    return _own(docs).mapInArrow(sign, schema)


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _lead_texts(docs: DataFrame, leads: DataFrame, shingle: int) -> DataFrame:
    """(rep, text) of the first document of each of ``leads`` (rep, first, digest): of the texts under its id, one with that digest."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, same = batch.column(2).to_pylist(), []
            for block in words(batch.column(1), NOT_SPACE):  # one block's sets are held at a time
                for found in shingles(block, shingle):
                    same.append(len(found) > 0 and _digest(found) == wanted[len(same)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["rep", "text"]).filter(pa.array(same, pa.bool_()))

    found = _own(docs).select(F.col("doc").alias("first"), "text").join(leads, "first")
    return found.select("rep", "text", "digest").mapInArrow(pick, "rep long, text string").dropDuplicates(["rep"])


def _prefixes(docs: DataFrame, shingle: int, rarity: Broadcast, shared: Broadcast | None = None) -> DataFrame:
    """(doc, key): the rarest quarter of each text's shingles; with ``shared`` only keys of that bit map."""

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rarity.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for block in words(batch.column(1), NOT_SPACE):
                owners, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, found in enumerate(shingles(block, shingle)):
                    n = len(found)
                    if not n:
                        continue
                    first = found[np.lexsort((found, order[_cells(found)]))[: n - (3 * n + 3) // 4 + 1]].view(np.int64)
                    if shared is not None:
                        bit = first & (BITS - 1)
                        first = first[shared.value[bit >> 6] >> (bit & 63) & 1 == 1]
                    keys.append(first)
                    owners.append(np.full(len(first), ids[block.first + i]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(owners)), pa.array(np.concatenate(keys))], names=["doc", "key"])

    return _own(docs).select("doc", "text").mapInArrow(rarest, "doc long, key long")


def _total(seed: int) -> Column:
    """Half of an order-free sum of hashes of ids; it tells repeated ids from absent ones, as a xor would not, and fits a long up to 2 ** 30 rows."""
    return F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc"), 31))


def _bit_map(blocks: DataFrame) -> np.ndarray:
    """A bit for each block's key."""
    bit = F.col("key").bitwiseAND(F.lit(BITS - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    words_ = blocks.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()  # BITS / 64 rows
    out = np.zeros(BITS // 64, dtype=np.int64)
    out[words_["at"].to_numpy()] = words_["bits"].to_numpy()
    return out


def _linked(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, PAIRS):
                part = batch.slice(at, PAIRS)
                sets = [[s for block in words(part.column(c), NOT_SPACE) for s in shingles(block, shingle)] for c in (2, 3)]
                for one, two in zip(*sets, strict=True):
                    shared = len(np.intersect1d(one, two, assume_unique=True))
                    keep.append(shared > 0 and 100 * shared >= 75 * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = texts.toDF("a", "ta"), texts.toDF("b", "tb")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(verify, "a long, b long")


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs whose summed coordinate minima reach the required overlap."""
    one = points.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    two = points.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            total = batch.column(2).to_numpy(zero_copy_only=False) + batch.column(3).to_numpy(zero_copy_only=False)
            for at in range(0, len(batch), 2000):
                rows = slice(at, at + 2000)
                keep[rows] = _reaches(_points(batch.column(4)[rows]), _points(batch.column(5)[rows]), total[rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ca", "cb")
    return joined.mapInArrow(bound, "a long, b long")


class RTree:
    """Points packed by recursive halving of the widest coordinate; nodes hold lowest and highest counts."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.points, self.sizes = points, sizes
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        inside = self.points[rows]
        low, high = inside.min(axis=0), inside.max(axis=0)
        children: tuple = ()
        if len(rows) > LEAF and (low < high).any():
            axis = int(np.argmax(high - low))
            order = rows[np.argsort(inside[:, axis], kind="stable")]
            half = len(order) // 2
            children = (self._build(order[:half]), self._build(order[half:]))
        self.nodes.append((high, int(self.sizes[rows].min()), rows, children))
        return len(self.nodes) - 1

    def pairs(self, other: RTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs whose bound reaches the required overlap; subtrees that cannot are cut off."""
        open_ = [(self.root, other.root)]
        while open_:
            i, j = open_.pop()
            (high_a, least_a, rows_a, below_a), (high_b, least_b, rows_b, below_b) = self.nodes[i], other.nodes[j]
            if np.minimum(high_a, high_b).sum() < required(least_a + least_b):
                continue
            if below_a and (not below_b or len(rows_a) >= len(rows_b)):
                open_ += [(k, j) for k in below_a]
            elif below_b:
                open_ += [(i, k) for k in below_b]
            else:
                for at in range(0, len(rows_a), LEAF):
                    part = rows_a[at : at + LEAF]
                    bound = np.minimum(self.points[part][:, None, :], other.points[rows_b][None, :, :]).sum(axis=2)
                    x, y = np.nonzero(bound >= required(self.sizes[part][:, None] + other.sizes[rows_b][None, :]))
                    yield part[x], rows_b[y]


def _chunk_pairs(points: np.ndarray, sizes: np.ndarray, reps: np.ndarray, classes: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Pairs of different classes, one of each side, whose bound reaches the required overlap."""
    one, two = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
    found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    if len(one) and len(two):
        coarse = _coarse(points)
        tree = RTree(coarse[one], sizes[one])
        for x, y in tree.pairs(tree if len(one) == len(two) == len(sides) else RTree(coarse[two], sizes[two])):
            x, y = one[x], two[y]
            apart = classes[x] != classes[y]
            x, y = x[apart], y[apart]
            near = _reaches(points[x], points[y], sizes[x] + sizes[y])
            a, b = reps[x[near]], reps[y[near]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
    return np.concatenate(found)


def _stream_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R-tree joins of the chunk pairs that stand one after another in the input; one that goes on in the next batch waits."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def join(rows: np.ndarray, points: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        found = [np.zeros((0, 2), np.int64)]
        for part, own in zip(np.split(rows, cuts), np.split(points, cuts), strict=True):
            found.append(_chunk_pairs(own, part[:, 6], part[:, 3], part[:, 4], part[:, 5]))
        pairs = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        plain = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(7)], axis=1)
        rows = np.concatenate([*[r for r, _ in held], plain])
        points = np.concatenate([*[p for _, p in held], _points(batch.column(7))])
        last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
        whole = int(last[-1]) + 1 if len(last) else 0
        if whole:
            yield from join(rows[:whole], points[:whole])
        held = [(rows[whole:], points[whole:])]
    if held and len(held[0][0]):
        yield from join(*held[0])


def _spokes(members: DataFrame, *hubs: str) -> DataFrame:
    """Distinct pairs (a, b) of each row's ``rep`` with its hubs."""
    ends = F.explode(F.array(*hubs)).alias("hub")
    pairs = members.select("rep", ends).where("rep <> hub")
    return pairs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def _open_blocks(members: DataFrame, classes: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs of different classes within a block, by R-trees over chunks of its points."""
    labelled = members.join(classes.select(F.col("id").alias("rep"), F.col("component").alias("class")).hint("merge"), "rep")
    apart = (
        labelled.groupBy("key")
        .agg(F.count("*").alias("rows"), F.min("class").alias("lo"), F.max("class").alias("hi"))
        .where("lo <> hi")
        .select("key", F.ceil(F.col("rows") / CHUNK).cast("int").alias("chunks"))
    )
    own = F.pmod(F.xxhash64("rep", "key"), F.col("chunks")).cast("int")
    return (
        labelled.join(apart.hint("merge"), "key")
        .join(points, "rep")
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "key", "rep", "class", "n", "counts",
            F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
            F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1).alias("side"),
        )
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .select("key", "i", "j", "rep", "class", "side", "n", "counts")
        .mapInArrow(_stream_chunks, "a long, b long")
        .distinct()
    )


def _with_links(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (id, component) after further links (a, b) between their ids: only classes are linked anew, not their members."""
    one, two = classes.toDF("a", "ca").hint("merge"), classes.toDF("b", "cb").hint("merge")
    between = links.join(one, "a").join(two, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    between = materialise(between, "jaccard-between")
    if between.isEmpty():
        return classes
    lower = components(between).toDF("component", "lower").hint("merge")
    joined = classes.join(lower, "component", "left").select("id", F.coalesce("lower", "component").alias("component"))
    return materialise(joined, "jaccard-classes")


def _classes(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, h, g, n, digest, component_id, best) of each row; ``best`` is the digest that stands for its class."""
    spark = docs.sparkSession
    rarity = spark.sparkContext.broadcast(_rarity(docs, shingle))
    signed = materialise(_signatures(docs, shingle), "jaccard-signatures")
    filled = signed.where("n > 0")
    leads = filled.groupBy("digest").agg(F.min("doc").alias("first"), F.min("doc_id").alias("known"))
    leads = materialise(leads.withColumn("rep", F.monotonically_increasing_id()), "jaccard-sets")
    # An id with several texts leads to the sets of all of them: blocks may grow, but lose nothing.
    led = materialise(filled.select("doc", "digest").join(leads.hint("merge"), "digest").select("doc", "rep").distinct(), "jaccard-leads")
    blocks = (
        _prefixes(docs, shingle, rarity)
        .groupBy("key")
        .agg(
            F.count("*").alias("rows"),
            F.min("doc").alias("lo"),
            F.max("doc").alias("hi"),
            _total(0).alias("x"),
            _total(1).alias("y"),
        )
        .where("rows > 1")
    )
    alike = materialise(blocks.groupBy("rows", "lo", "hi", "x", "y").agg(F.min("key").alias("key")).select("key"), "jaccard-blocks")
    shared = spark.sparkContext.broadcast(_bit_map(alike))
    members = _prefixes(docs, shingle, rarity, shared).join(alike.hint("merge"), "key").join(led.hint("merge"), "doc").select("key", "rep").distinct()
    members = materialise(members, "jaccard-members")
    for sent in (rarity, shared):
        sent.destroy()
    degree = members.groupBy("rep").agg(F.count("*").alias("degree"))
    members = materialise(members.join(degree.hint("merge"), "rep"), "jaccard-members")
    ends = members.groupBy("key").agg(
        F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.max(F.struct("degree", "rep")).alias("hub")
    )
    ends = materialise(ends.where("lo < hi").select("key", "lo", "hi", F.col("hub.rep").alias("hub")), "jaccard-hubs")
    stars = _spokes(members.join(ends.hint("merge"), "key"), "lo", "hi", "hub")
    taking_part = members.join(ends.select("key").hint("merge"), "key", "left_semi").select("rep").distinct()
    leading = materialise(leads.join(taking_part.hint("merge"), "rep"), "jaccard-leading")
    points = filled.select("doc", "digest", "n", "counts").join(leading.select("rep", F.col("first").alias("doc"), "digest"), ["doc", "digest"])
    points = materialise(points.select("rep", "n", "counts").dropDuplicates(["rep"]), "jaccard-points")
    texts = materialise(_lead_texts(docs, leading.select("rep", "first", "digest"), shingle), "jaccard-texts")
    tried = materialise(_bounded(stars, points), "jaccard-stars")
    links = materialise(_linked(tried, texts, shingle), "jaccard-links")
    # Blocks still apart: one more hub for each, the best placed outside the class of the first.
    classes = materialise(components(links, taking_part.select(F.col("rep").alias("id"))), "jaccard-classes")
    labelled = members.join(classes.select(F.col("id").alias("rep"), F.col("component").alias("class")).hint("merge"), "rep")
    first = ends.join(classes.select(F.col("id").alias("hub"), F.col("component").alias("hub_class")).hint("merge"), "hub")
    others = labelled.join(first.select("key", "hub_class").hint("merge"), "key").where("class <> hub_class")
    second = others.groupBy("key").agg(F.max(F.struct("degree", "rep")).alias("hub"))
    more = _spokes(others.join(second.select("key", F.col("hub.rep").alias("hub")).hint("merge"), "key"), "hub")
    more = materialise(_bounded(more.join(tried, ["a", "b"], "left_anti"), points), "jaccard-stars")
    tried = tried.unionByName(more)
    classes = _with_links(classes, _linked(more, texts, shingle))
    later = _open_blocks(members.select("key", "rep"), classes, points).join(tried, ["a", "b"], "left_anti")
    classes = _with_links(classes, _linked(materialise(later, "jaccard-later"), texts, shingle))
    classes = classes.select(F.col("id").alias("rep"), "component")
    sets = leads.join(classes.hint("merge"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    # The set that stands for a class is that of the smallest known id, of two of one id the one with the lower digest.
    place = F.struct(F.col("known").isNull(), "known", "digest")
    chosen = sets.groupBy("component").agg(F.min("known").alias("component_id"), F.min_by("digest", place).alias("best"))
    named = sets.select("digest", "component").join(chosen.hint("merge"), "component").select("digest", "component_id", "best")
    own = signed.select("doc_id", "h", "g", "n", "digest").join(named.hint("merge"), "digest", "left")
    return own.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    return _classes(docs, shingle).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each group of near copies: that of the smallest id; the others go.

    Rows are known by id and text, so a text stays though another of its id goes, and null ids are judged like others.  Rows that
    agree in both are one document: the first in the order of all their columns stays.  Texts without words stay, repeated rows too.
    """
    judged = materialise(_classes(docs, shingle).where("n > 0"), "jaccard-judged")
    # Of the chosen set, the texts under the chosen id may differ in case or spaces: the one with the lowest hashes stays.
    stays = (F.col("digest") == F.col("best")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    text = F.struct("h", "g")
    one = judged.where(stays).groupBy("best").agg(F.min(text).alias("one"))
    chosen = judged.where(stays).join(one, "best")
    gone = judged.where(~stays).select(*ROW).unionByName(chosen.where(text != F.col("one")).select(*ROW))
    twice = chosen.where(text == F.col("one")).groupBy(*ROW).agg(F.count("*").alias("rows")).where("rows > 1")
    twice = materialise(twice, "jaccard-twice")
    kept = without(docs, gone)
    if twice.isEmpty():
        return kept
    h, g = text_hashes()
    repeated = docs.join(twice, same_row(docs, twice), "left_semi").groupBy(F.col("doc_id").cast("long"), h, g)
    repeated = repeated.agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return without(kept, twice).unionByName(repeated)
