"""The prefix trie of conversations, its subtree sums by the Euler-tour technique.

Turns are digested in place (texts are not moved) and sorted over all tasks by conversation and order.  Each task runs a
polynomial hash of the turns so far, modulo a prime of 127 bits; a conversation cut by the borders of tasks gets the hash of what lies before by
composing the hashes of whole tasks, of which the driver holds one small row each.  Equal (depth, hash) is one node; its smallest member and its depth
name it.

Another sort puts each node before its children, in the order of their names, which gives every node its parent, first child and next
sibling.  From them come an enter and an exit arc per node.  The tour is ranked by ``list_ranking``: arcs lie in the order of the names,
where a conversation's arcs follow each other, so most of the tour is contracted within tasks.  A subtree's sums are those at the exit arc less
those before the enter arc.

Null conversation ids take no part.  Null roles and texts are empty.  Turns are in the order of ``turn``, null first; equal ones in the order of
their digests, and equal rows are turns of their own.  Other columns are ignored; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.llm.list_ranking import links, list_prefixes, places, walk
from coverlens.session import materialise

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix hash").digest()[:15], "big")
ARCS = 500_000  # arcs of a task
PIECE = 1 << 16  # characters of a piece of a list of ids
ORDER = ("conv_id", "part", "nth", "turn", "digest", "row")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, nth, turn, digest, row, words) of each turn, written."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return materialise(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.lit(2).alias("part"),
            F.lit(0).alias("nth"),
            "turn",
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
            F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
        ),
        "trie-turns",
    )


def with_shared_openings(turns: DataFrame, apart: int = 20, most: int = 3) -> DataFrame:
    """Conversations whose first h turns are those of the conversation at the multiple of ``apart`` below, h by a hash of the id up to ``most``.

    Fewer if that conversation has fewer, none if it is absent; then the conversation's own turns after its first h.
    """
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "digest", "row"))
    first = materialise(turns.withColumn("nth", nth).where(F.col("nth") <= most), "trie-first")
    own = turns.join(first.where(F.col("nth") <= opening).select("row"), "row", "left_anti").select(*turns.columns)
    given = first.where(F.col("conv_id") % apart == 0).withColumnRenamed("conv_id", "shared")
    asking = first.where("nth = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % apart).alias("shared"), opening.alias("h"))
    lent = asking.join(given, "shared").where(F.col("nth") <= F.col("h")).withColumn("part", F.lit(1))
    return own.unionByName(lent.select(*turns.columns))


def _spread(frame: DataFrame, keys: Iterable[str], least: int = 1) -> DataFrame:
    """Sorted by the keys over all tasks."""
    keys = list(keys)
    n = max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), least)
    return frame.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def _hashed(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(task, conv_id, open, opens, ends, depth, hash, before, words, last) per turn and one of depth 0 per conversation; written.

    ``open`` rows continue a conversation of the task before; their depth and hashes lack what came there.  ``opens`` and ``ends`` mark
    the first and last row of a task, ``last`` a conversation's last turn, which the last row of a task cannot know.
    """
    root = members.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("nth"), F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("words"))
    rows = turns.unionByName(root, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, conversation_open, depth, total = TaskContext.get().partitionId(), True, 0, 0
        held, opens = None, True
        for batch in batches:
            out = []
            for conv, part, digest, words in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if held is not None:
                    out.append((*held, False, part == 0))
                before = total
                if part == 0:
                    conversation_open, depth, total, before = False, 0, 0, 0
                else:
                    depth, total = depth + 1, (total * BASE + int.from_bytes(digest, "big") + 1) % PRIME
                held = (task, conv, conversation_open, opens, depth, total.to_bytes(16, "big"), before.to_bytes(16, "big"), words)
                opens = False
            yield _batch(out, HASHED)
        if held is not None:
            yield _batch([(*held, True, False)], HASHED)

    hashed = _spread(rows, ORDER).select("conv_id", "part", "digest", "words").mapInArrow(run, _ddl(HASHED))
    return materialise(hashed, "trie-hashed")


HASHED = (
    ("task", "int", pa.int32()), ("conv_id", "long", pa.int64()), ("open", "boolean", pa.bool_()), ("opens", "boolean", pa.bool_()),
    ("depth", "long", pa.int64()), ("hash", "binary", pa.binary()), ("before", "binary", pa.binary()), ("words", "long", pa.int64()),
    ("ends", "boolean", pa.bool_()), ("last", "boolean", pa.bool_()),
)


def _ddl(fields: tuple) -> str:
    return ", ".join(f"{name} {kind}" for name, kind, _ in fields)


def _batch(rows: list[tuple], fields: tuple) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f[2]) for c, f in zip(columns, fields, strict=True)], names=[f[0] for f in fields])


def _settled(hashed: DataFrame) -> DataFrame:
    """(conv_id, depth, hash, before, words, last) with what the tasks' borders hid."""
    edges = hashed.where("opens or ends").select("task", "opens", "ends", "open", "depth", "hash").collect()  # two rows a task
    starts = {e["task"]: e for e in edges if e["opens"]}
    stops = {e["task"]: e for e in edges if e["ends"]}
    carried, closes, depth, total = {}, {}, 0, 0
    tasks = sorted(starts)
    for task, follower in zip(tasks, [*tasks[1:], None], strict=False):
        if starts[task]["open"]:
            carried[task] = (depth, total)
        end = stops[task]
        value = int.from_bytes(end["hash"], "big")
        if end["open"]:
            depth, total = depth + end["depth"], (total * pow(BASE, end["depth"], PRIME) + value) % PRIME
        else:
            depth, total = end["depth"], value
        closes[task] = follower is None or not starts[follower]["open"]
    shared = hashed.sparkSession.sparkContext.broadcast((carried, closes))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before_task, closing = shared.value
        for batch in batches:
            rows = batch.to_pydict()
            depth, hashes, befores, last = rows["depth"], rows["hash"], rows["before"], rows["last"]
            for i in np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False)):
                nth, (depth_then, hash_then) = depth[i], before_task[rows["task"][i]]
                for values, steps in ((hashes, nth), (befores, nth - 1)):
                    whole = (hash_then * pow(BASE, steps, PRIME) + int.from_bytes(values[i], "big")) % PRIME
                    values[i] = whole.to_bytes(16, "big")
                depth[i] = nth + depth_then
            for i in np.flatnonzero(batch.column(8).to_numpy(zero_copy_only=False)):
                last[i] = closing[rows["task"][i]]
            columns = [rows["conv_id"], depth, hashes, befores, rows["words"], last]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=SETTLED)

    kinds = ("long", "long", "binary", "binary", "long", "boolean")
    columns = [name for name, _, _ in HASHED]
    return hashed.select(*columns).mapInArrow(settle, ", ".join(f"{n} {k}" for n, k in zip(SETTLED, kinds, strict=True)))


SETTLED = ["conv_id", "depth", "hash", "before", "words", "last"]


def _family(nodes: DataFrame) -> DataFrame:
    """(conv, depth, kind, parent, follower, leaf, saved): each node as a parent (kind 0) and as a child (kind 1).

    ``follower`` is the name of the first child of a parent, of the next sibling of a child; null if there is none.
    """
    saved = ((F.col("n") - 1) * F.col("words")).alias("saved")
    parents = nodes.select("conv_id", "depth", F.col("depth").alias("level"), F.col("hash").alias("group"), F.lit(0).alias("kind"), saved)
    children = nodes.where("depth > 0").select(
        "conv_id", "depth", (F.col("depth") - 1).alias("level"), F.col("before").alias("group"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("saved")
    )
    rows = _spread(parents.unionByName(children), ("level", "group", "kind", "conv_id"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parent, opens = TaskContext.get().partitionId(), None, True
        filled = (b for b in batches if b.num_rows)
        batch = next(filled, None)
        while batch is not None:
            later = next(filled, None)  # its first row follows this batch's last
            conv, depth, kind, saved = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            n = batch.num_rows
            at = np.maximum.accumulate(np.where(kind == 0, np.arange(n), -1))
            known = (at >= 0) | (parent is not None)
            above = np.where(at >= 0, conv[np.maximum(at, 0)], 0 if parent is None else parent)
            parent = int(above[-1]) if known[-1] else None
            follower, follows = np.append(conv[1:], 0), np.append(kind[1:] == 1, False)
            if later is not None:
                follower[-1], follows[-1] = later.column(0)[0].as_py(), later.column(2)[0].as_py() == 1
            row = np.arange(n)
            columns = [
                pa.array(np.full(n, task, np.int32)), pa.array(conv), pa.array(depth), pa.array(kind), pa.array(above, mask=~known),
                pa.array(follower, mask=~follows), pa.array(saved), pa.array((row == 0) & opens), pa.array((row == n - 1) & (later is None)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=FAMILY)
            batch, opens = later, False

    kinds = ("int", "long", "long", "int", "long", "long", "long", "boolean", "boolean")
    scanned = rows.select("conv_id", "depth", "kind", "saved").mapInArrow(scan, ", ".join(f"{n} {k}" for n, k in zip(FAMILY, kinds, strict=True)))
    scanned = materialise(scanned, "trie-family")
    # Two rows a task tell what lies across its borders.
    edges = scanned.where("opens or ends").select("task", "opens", "ends", "conv", "kind", "parent").collect()
    starts = {e["task"]: e for e in edges if e["opens"]}
    stops = {e["task"]: e for e in edges if e["ends"]}
    tasks, above, borders = sorted(starts), None, []
    for task, later in zip(tasks, [*tasks[1:], None], strict=False):
        follower = starts[later]["conv"] if later is not None and starts[later]["kind"] == 1 else None
        borders.append((task, above, follower))
        above = above if stops[task]["parent"] is None else stops[task]["parent"]
    sides = scanned.sparkSession.createDataFrame(borders, "task int, above long, beyond long")
    found = scanned.join(F.broadcast(sides), "task")  # a row per task
    follower = F.when(F.col("ends"), F.col("beyond")).otherwise(F.col("follower"))
    return found.select("conv", "depth", "kind", F.coalesce("parent", "above").alias("parent"), follower.alias("follower"), "saved")


FAMILY = ["task", "conv", "depth", "kind", "parent", "follower", "saved", "opens", "ends"]


def _arcs(family: DataFrame) -> DataFrame:
    """Enter arcs at 2 depth, exit arcs at 2 depth + 1, each with the arc after it."""
    down, up = 2 * F.col("depth"), 2 * F.col("depth") + 1
    has = F.col("follower").isNotNull()
    zero = F.lit(0).cast("long")
    enter = family.where("kind = 0").select(
        "conv", down.alias("pos"), F.coalesce("follower", "conv").alias("next_conv"), F.when(has, down + 2).otherwise(up).alias("next_pos"),
        F.when(has, 0).otherwise(1).cast("long").alias("leaf"), "saved",
    )
    leave = family.where("kind = 1").select(
        "conv", up.alias("pos"), F.coalesce("follower", "parent").alias("next_conv"), F.when(has, down).otherwise(up - 2).alias("next_pos"),
        zero.alias("leaf"), zero.alias("saved"),
    )
    nowhere = F.lit(None).cast("long")
    done = family.where("kind = 0 and depth = 0").select(
        "conv", up.alias("pos"), nowhere.alias("next_conv"), nowhere.alias("next_pos"), zero.alias("leaf"), zero.alias("saved")
    )
    return enter.unionByName(leave).unionByName(done)


CHAINED = ["conv", "pos", "next_conv", "next_pos", "leaf", "saved", "own_leaf", "own_saved", "out_conv", "out_pos", "out_leaf", "out_saved", "node", "depth"]


def _contracted(arcs: DataFrame, nodes: int) -> DataFrame:
    """The chains of arcs that follow each other in a task, as links (``node`` null), and each node's places in them; written.

    A node's row has the chain of its enter arc (conv, pos) and the sums there, its own weights, and the same of its exit arc (out_).
    """

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, pos, next_conv, next_pos, leaf, saved = links(batches, ("conv", "pos", "next_conv", "next_pos", "leaf", "saved"))
        if not len(conv):
            return
        own = np.stack([leaf, saved], axis=1)
        after = places(conv, pos, next_conv, next_pos)
        head, sums = walk(after, own)
        tail = np.flatnonzero(after < 0)
        none = pa.nulls(len(tail), pa.int64())
        ended = next_pos[tail] < 0
        columns = [conv[head[tail]], pos[head[tail]], pa.array(next_conv[tail], mask=ended), pa.array(next_pos[tail], mask=ended), *sums[tail].T]
        yield pa.RecordBatch.from_arrays([*[pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], *[none] * 8], names=CHAINED)
        order = np.lexsort((pos, conv))
        into, out = order[0::2], order[1::2]  # a node's two arcs are neighbours and share a task
        none = pa.nulls(len(into), pa.int64())
        columns = [conv[head[into]], pos[head[into]], none, none, *sums[into].T, *own[into].T, conv[head[out]], pos[head[out]], *sums[out].T,
                   conv[into], pos[into] // 2]
        yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=CHAINED)

    dealt = _spread(arcs.withColumn("depth", F.shiftright("pos", 1)), ("conv", "depth"), -(-2 * nodes // ARCS))
    return materialise(dealt.mapInArrow(chain, ", ".join(f"{c} long" for c in CHAINED)), "trie-chains")


def _subtrees(contracted: DataFrame, solo: int | None) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of each node."""
    lists = contracted.where("node is null").select("conv", "pos", "next_conv", "next_pos", "leaf", "saved")
    start = list_prefixes(lists, **({} if solo is None else {"solo": solo}))
    rows = contracted.where("node is not null")
    within = (F.col("conv") == F.col("out_conv")) & (F.col("pos") == F.col("out_pos"))
    leaves, saved = F.col("out_leaf") - F.col("leaf") + F.col("own_leaf"), F.col("out_saved") - F.col("saved") + F.col("own_saved")
    named = [F.col("node").alias("conv_id"), "depth"]
    near = rows.where(within).select(*named, leaves.alias("n_leaves"), saved.alias("saved_tokens"))
    enter = start.select("conv", "pos", F.col("leaf").alias("in_leaf_0"), F.col("saved").alias("in_saved_0"))
    leave = start.select(F.col("conv").alias("out_conv"), F.col("pos").alias("out_pos"), F.col("leaf").alias("out_leaf_0"), F.col("saved").alias("out_saved_0"))
    far = rows.where(~within).join(enter, ["conv", "pos"]).join(leave, ["out_conv", "out_pos"])
    far = far.select(
        *named,
        (leaves + F.col("out_leaf_0") - F.col("in_leaf_0")).alias("n_leaves"),
        (saved + F.col("out_saved_0") - F.col("in_saved_0")).alias("saved_tokens"),
    )
    return near.unionByName(far)


def _end_digests(ends: DataFrame) -> DataFrame:
    """(depth, hash, ends_sha256): the digest of the sorted ids that end at each node, joined by commas.

    Ids are sorted over all tasks and joined to pieces there, so a node where very many end costs the task that digests
    it only one row per ``PIECE`` characters; pieces are read one after another.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size = None, [], 0
        for batch in batches:
            out = []
            for depth, node, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ids and (key != (depth, node) or size > PIECE):
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                key = (depth, node)
                ids.append(conv)
                size += 12
            yield _batch(out, PIECES)
        if ids:
            yield _batch([(*key, ids[0], ",".join(map(str, ids)))], PIECES)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for depth, node, _, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != (depth, node):
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (depth, node), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield _batch(out, DIGESTS)
        if key is not None:
            yield _batch([(*key, state.hexdigest())], DIGESTS)

    pieces = _spread(ends.select("depth", "hash", "conv_id"), ("depth", "hash", "conv_id")).mapInArrow(join, _ddl(PIECES))
    return pieces.repartition("depth", "hash").sortWithinPartitions("depth", "hash", "first").mapInArrow(digest, _ddl(DIGESTS))


PIECES = (("depth", "long", pa.int64()), ("hash", "binary", pa.binary()), ("first", "long", pa.int64()), ("ids", "string", pa.string()))
DIGESTS = (("depth", "long", pa.int64()), ("hash", "binary", pa.binary()), ("ends_sha256", "string", pa.string()))


def prefix_trie(turns: DataFrame, members: DataFrame, solo: int | None = None) -> DataFrame:
    """One row per node of the trie of ``turns`` (``turn_rows``); ``members`` (conv_id) are the distinct conversations, also those without turns.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    hashed = _hashed(turns, members)
    settled = _settled(hashed)
    grouped = settled.groupBy("depth", "hash").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("before").alias("before"), F.first("words").alias("words")
    )
    nodes = materialise(grouped, "trie-nodes")
    digests = _end_digests(settled.where("last"))
    family = materialise(_family(nodes), "trie-kin")
    subtrees = _subtrees(_contracted(_arcs(family), nodes.count()), solo)

    def part(frame: DataFrame, **values: Column) -> DataFrame:
        kinds = {"parent": "long", "n": "long", "child": "long", "leaves": "long", "saved": "long", "ends": "string"}
        return frame.select("conv_id", "depth", *[values.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])

    own = nodes.join(digests, ["depth", "hash"], "left")
    born = family.where("kind = 1")
    facts = (
        part(own, n=F.col("n"), ends=F.col("ends_sha256"))
        .unionByName(part(subtrees, leaves=F.col("n_leaves"), saved=F.col("saved_tokens")))
        .unionByName(part(born.withColumnRenamed("conv", "conv_id"), parent=F.col("parent")))
        .unionByName(part(born.select(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")), child=F.lit(1)))
    )
    return facts.groupBy("conv_id", "depth").agg(
        F.max("parent").alias("parent_conv_id"),
        F.max("n").alias("n_convs"),
        F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"),
        F.max("leaves").alias("n_leaves"),
        F.max("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends"), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
