"""Prefix tries of conversations: ternary search trees over turn ids, one per range shard.

Turns are numbered by a dictionary, so a conversation is a row of ids. Equal rows become one
with its members counted. The different rows are sorted and dealt to range shards; a shard
builds a ternary search tree, balanced by inserting the median of a range before those of its
halves, and walks it with a stack to sum members, leaves and savings from below.

Only the nodes on the paths of a shard's first and last row can be in other shards too. Such
boundary nodes carry the sums of what lies strictly inside the shard; they are merged by
their digest, each is then counted by the first shard that has it, and the counts
are summed along the two paths of that shard. No step depends on how many shards a node is in.

A row has at most SEGMENT turns. Longer conversations are cut: the segments that follow
equal beginnings are a trie of their own, whose root continues the last node of the trie
above, and tries are built from the last segments up. So no row or task grows with a
conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumagrid.operators.lookup import attach
from lumagrid.operators.ordering import position_in_group
from lumagrid.settings import store

SEGMENT = 1 << 16
SHARD_TURNS = 1 << 18  # turns of the rows of one shard
HEADS = 9  # a conversation takes fewer turns than this from another
FAMILY = 5
_BLOCK = 4096  # turn numbers in one block while turns are put in order
_IDS = 512  # ids of members in one row
_NOBODY = hashlib.sha256().hexdigest()


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts, each preceded by its length."""
    spelled = [F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.unhex(F.sha2(F.concat(*spelled).cast("binary"), 256))


# --- conversations as rows of ids -------------------------------------------------------


def encoded_turns(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, pos, id, size)``: turns in order from 1, with their dictionary ids and bytes of text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    plain = turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    # Null first, then blocks of turn numbers, so that no task sorts a whole conversation.
    block = F.coalesce(F.floor(F.col("turn") / _BLOCK), F.lit(-(1 << 62)))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    placed, _ = store(position_in_group(plain, "conv", block, order, "pos").drop("turn"))
    known = placed.groupBy("digest").agg(F.count(F.lit(1)).alias("uses"))
    known, n_known = store(known.withColumn("id", F.monotonically_increasing_id()))
    numbered = attach(placed, known, ["digest"], weight="uses", n_rows=n_known)
    return store(numbered.select("conv", (F.col("pos") + 1).alias("pos"), "id", "size"))[0]


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv, total, depth, id, size)`` of conversations that begin like another.

    Conversation c takes the first h turns of conversation c - c % FAMILY, where h is the
    CRC-32 of c's decimals modulo HEADS, and goes on with its own turns after its first h. One without any
    turns then has a row of depth 0.
    """
    convs = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    convs, _ = store(
        convs.select(
            "conv",
            "n",
            (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
            (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("heads"),
        )
    )
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("heads", F.coalesce("n_base", F.lit(0)))
    plan, n_plan = store(
        convs.join(bases, "base", "left").select(
            "conv", "base", "heads", "n", taken.alias("taken"),
            (taken + F.greatest(F.col("n") - F.col("heads"), F.lit(0))).alias("total"),
        )
    )
    own = attach(turns, plan, ["conv"], weight="n", n_rows=n_plan).where(F.col("pos") > F.col("heads"))
    own = own.select("conv", "total", (F.col("taken") + F.col("pos") - F.col("heads")).alias("depth"), "id", "size")
    first = turns.where(F.col("pos") < HEADS).withColumnRenamed("conv", "base")
    heads = first.join(plan.drop("n"), "base").where(F.col("pos") <= F.col("heads"))
    heads = heads.select("conv", "total", F.col("pos").alias("depth"), "id", "size")
    no_id = F.lit(None).cast("long")
    turnless = plan.where(F.col("total") == 0).select(
        "conv", "total", F.lit(0).cast("long").alias("depth"), no_id.alias("id"), no_id.alias("size")
    )
    return own.unionByName(heads).unionByName(turnless)


def segments(sequences: DataFrame, length: int) -> DataFrame:
    """``(conv, seg, head, ids, sizes, ends, next)``: rows of at most ``length`` turns.

    ``head`` is the digest of the segments before, empty for the first; ``next`` that of those
    before and this one, null in the last.
    """
    at = F.greatest(F.col("depth") - 1, F.lit(0))
    pairs = F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct(at.alias("at"), "id", "size"))))
    rows = sequences.groupBy("conv", F.floor(at / length).cast("long").alias("seg")).agg(
        F.first("total").alias("total"), pairs.alias("turns")
    )
    rows = rows.select(
        "conv",
        "seg",
        F.col("turns.id").alias("ids"),
        F.col("turns.size").alias("sizes"),
        ((F.col("seg") + 1) * length >= F.col("total")).alias("ends"),
        (F.col("total") > length).alias("cut"),
    )
    rows, _ = store(rows)
    whole = rows.where(~F.col("cut")).select("*", F.lit("").alias("head"), F.lit(None).cast("string").alias("next"))
    cut = rows.where("cut").withColumn("own", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256))
    along = Window.partitionBy("conv").orderBy("seg")
    before = F.collect_list("own").over(along.rowsBetween(Window.unboundedPreceding, -1))
    till = F.collect_list("own").over(along.rowsBetween(Window.unboundedPreceding, 0))
    chained = cut.withColumn("before", before).withColumn("till", till)
    head = F.when(F.col("seg") > 0, F.sha2(F.array_join("before", ""), 256)).otherwise(F.lit(""))
    chained = chained.select(
        *rows.columns, head.alias("head"), F.when(~F.col("ends"), F.sha2(F.array_join("till", ""), 256)).alias("next")
    )
    return whole.unionByName(chained).drop("cut")


def ends_sha256(members: DataFrame) -> DataFrame:
    """``(cls, ends_sha256)``: SHA-256 of the ``conv``s of a class in order, as decimals joined by commas.

    Ids are sorted in ranges, so a class of any size is spread, and joined to rows of
    512 ids; the digest of a class is then fed from these.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, ids = None, []

        def out() -> pa.RecordBatch:
            columns = [pa.array([cls], pa.binary()), pa.array([ids[0]], pa.int64())]
            columns.append(pa.array([",".join(map(str, ids))], pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=["cls", "first", "ids"])

        for batch in batches:
            for c, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (c != cls or len(ids) == _IDS):
                    yield out()
                    ids = []
                cls = c
                ids.append(conv)
        if ids:
            yield out()

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, state = None, None

        def out() -> pa.RecordBatch:
            columns = [pa.array([cls], pa.binary()), pa.array([state.hexdigest()], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["cls", "ends_sha256"])

        for batch in batches:
            for c, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if c == cls:
                    state.update(b",")
                else:
                    if state:
                        yield out()
                    cls, state = c, hashlib.sha256()
                state.update(ids.encode())
        if state:
            yield out()

    joined = members.repartitionByRange("cls", "conv").sortWithinPartitions("cls", "conv")
    joined = joined.mapInArrow(join, "cls binary, first long, ids string")
    dealt = joined.repartition("cls").sortWithinPartitions("cls", "first")
    return dealt.mapInArrow(feed, "cls binary, ends_sha256 string")


# --- the tree of a shard ----------------------------------------------------------------


class TernaryTree:
    """Sequences of symbols as linked lists of numbers; node 0 is above all first symbols."""

    def __init__(self) -> None:
        self.symbol: list = [None]
        self.low, self.equal, self.high, self.parent = [-1], [-1], [-1], [-1]

    def _node(self, symbol, parent: int) -> int:
        self.symbol.append(symbol)
        for links in (self.low, self.equal, self.high):
            links.append(-1)
        self.parent.append(parent)
        return len(self.symbol) - 1

    def insert(self, symbols: list) -> list[int]:
        """The nodes of the symbols' prefixes, made where they are missing."""
        path, above = [], 0
        for symbol in symbols:
            at = self.equal[above]
            if at < 0:
                at = self.equal[above] = self._node(symbol, above)
            while self.symbol[at] != symbol:
                links = self.low if symbol < self.symbol[at] else self.high
                if links[at] < 0:
                    links[at] = self._node(symbol, above)
                at = links[at]
            path.append(at)
            above = at
        return path

    def walk(self) -> Iterator[int]:
        """Every node but 0, after the node above it."""
        waiting = [self.equal[0]]
        while waiting:
            at = waiting.pop()
            if at >= 0:
                yield at
                waiting += (self.high[at], self.equal[at], self.low[at])


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before those of its two parts."""
    waiting = [(0, n)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += ((middle + 1, high), (low, middle))


_NODES = (
    "shard long, side string, root_of string, node binary, above binary, depth long, size long, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"
)
_NAMES = [f.split()[0] for f in _NODES.split(", ")]
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_TYPES = [_KINDS[f.split()[1]] for f in _NODES.split(", ")]


def shard_nodes(rows: list[dict], shard: int) -> pa.RecordBatch:
    """The nodes of the sorted rows of a shard.

    Sums of a boundary node (``side`` is F, L or B: on the path of the first row, the last or
    both) have only what lies strictly inside.
    """
    tree = TernaryTree()
    paths: list = [None] * len(rows)
    for i in medians(len(rows)):
        paths[i] = tree.insert([rows[i]["head"], *rows[i]["ids"]])
    n = len(tree.symbol)
    size, depth, members, children, leaves, saved = ([0] * n for _ in range(6))
    conv, ends, side = ([None] * n for _ in range(3))
    for row, path in zip(rows, paths, strict=True):
        for d, at in enumerate(path):
            depth[at], members[at] = d, members[at] + row["n"]
            conv[at] = row["conv"] if conv[at] is None else min(conv[at], row["conv"])
            if d:
                size[at] = row["sizes"][d - 1]
        if row["head_conv"] is not None:
            conv[path[0]] = row["head_conv"]
        last = path[-1]
        ends[last] = row["ends_sha256"]
        children[last], leaves[last], saved[last] = row["n_children"], row["n_leaves"], row["saved"]
    for at in paths[0]:
        side[at] = "F"
    for at in paths[-1]:
        side[at] = "B" if side[at] else "L"
    order = list(tree.walk())
    for at in reversed(order):
        above = tree.parent[at]
        if side[at] is None:
            leaves[at] += not children[at]
            saved[at] += (members[at] - 1) * size[at]
            children[above] += 1
        leaves[above] += leaves[at]
        saved[above] += saved[at]
    # Digests of the boundary, by which it is merged.
    names: list = [None] * n
    out = []
    for at in order:
        above = tree.parent[at]
        if side[at]:
            symbol = tree.symbol[at].encode() if not depth[at] else names[above] + tree.symbol[at].to_bytes(8, "little")
            names[at] = hashlib.sha256(symbol).digest()
        merged = depth[at] > 0 and (side[above] is not None)
        parent_conv = None if merged or not depth[at] else conv[above]
        root_of = None if depth[at] else tree.symbol[at]
        out.append(
            (shard, side[at], root_of, names[at], names[above] if merged else None, depth[at], size[at], conv[at],
             parent_conv, members[at], children[at], leaves[at], saved[at], ends[at])
        )
    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _shards(rows: DataFrame) -> DataFrame:
    """The nodes of all shards; a task cuts its range of rows into shards of bounded size."""
    most = SHARD_TURNS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        waiting, turns = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if waiting and turns + len(row["ids"]) > most:
                    yield shard_nodes(waiting, shard)
                    shard, waiting, turns = shard + 1, [], 0
                waiting.append(row)
                turns += len(row["ids"]) + 1
        if waiting:
            yield shard_nodes(waiting, shard)

    dealt = rows.repartitionByRange("head", "ids").sortWithinPartitions("head", "ids")
    return dealt.mapInArrow(build, _NODES)


# --- boundary nodes and segments --------------------------------------------------------


def _merged(boundary: DataFrame) -> tuple[DataFrame, int]:
    """One row per boundary node of any number of shards, with the sums of all of them."""
    once = boundary.groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("above", "depth", "size")],
        F.first("root_of", ignorenulls=True).alias("root_of"),
        F.min("conv_id").alias("conv_id"),
        F.max("ends").alias("ends"),
        F.min("shard").alias("owner"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    once, n_once = store(once)
    kids = once.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("node"))
    kids = kids.agg(F.count(F.lit(1)).alias("kids"))
    once, _ = store(
        once.join(kids, "node", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
        .withColumn("own_leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("size"))
        .drop("kids")
    )
    # What a node adds to itself and those above it, along the two paths of the shard that counts it.
    counted = attach(
        boundary.select("shard", "side", "node", "depth"),
        once.select("node", "owner", "own_leaf", "own_saved"),
        ["node"],
        n_rows=n_once,
        row_bytes=96,
    )
    deeper = Window.partitionBy("shard").orderBy(F.col("depth").desc())
    mine = F.col("shard") == F.col("owner")

    def below(value: str) -> Column:
        first, last, both = (
            F.sum(F.when(mine & (F.col("side") == s), F.col(value)).otherwise(0)).over(deeper) for s in "FLB"
        )
        return F.when(F.col("side") == "F", first).when(F.col("side") == "L", last).otherwise(first + last + both)

    sums = counted.select("node", below("own_leaf").alias("l"), below("own_saved").alias("s"))
    sums = sums.groupBy("node").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    whole = once.join(sums, "node").withColumn("n_leaves", F.col("n_leaves") + F.col("l"))
    return store(whole.withColumn("saved", F.col("saved") + F.col("s")).drop("l", "s", "own_leaf", "own_saved"))


def _level(rows: DataFrame) -> DataFrame:
    """All nodes of the tries over ``rows``, roots (``root_of``) included."""
    parts, _ = store(_shards(rows))
    merged, n_merged = _merged(parts.where(F.col("side").isNotNull()))
    parents = merged.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv"))
    columns = ["root_of", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    inside = parts.where(F.col("side").isNull()).select(*columns, "parent_conv_id", "above")
    boundary = merged.select(*columns, F.lit(None).cast("long").alias("parent_conv_id"), "above")
    nodes = attach(inside.unionByName(boundary), parents, ["above"], how="left", n_rows=n_merged, row_bytes=96)
    return nodes.select(*columns, F.coalesce("parent_conv_id", "above_conv").alias("parent_conv_id"))


def trie_nodes(sequences: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The prefix trie of ``(conv, total, depth, id, size)``, see ``prefix_trie`` for its columns."""
    cls = digest(F.col("head"), F.array_join(F.col("ids").cast("array<string>"), ","))
    rows, _ = store(segments(sequences, segment).withColumn("cls", cls))
    classes = rows.groupBy("cls").agg(
        *[F.first(c).alias(c) for c in ("seg", "head", "ids", "sizes")],
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n"),
        F.max("next").alias("next"),
    )
    shas = ends_sha256(rows.where("ends").select("cls", "conv"))
    classes, _ = store(attach(classes, shas, ["cls"], how="left", row_bytes=128).drop("cls"))
    levels = classes.agg(F.max("seg")).first()[0]
    sums = ["n_children", "n_leaves", "saved"]
    below, found = None, []
    for level in range(-1 if levels is None else levels, -1, -1):
        here = classes.where(F.col("seg") == level)
        if below is None:
            here = here.select("*", *[F.lit(0).cast("long").alias(c) for c in sums])
        else:
            here = here.join(below, "next", "left").fillna(0, sums)
        above = classes.where((F.col("seg") == level - 1) & F.col("next").isNotNull())
        above = above.select(F.col("next").alias("head"), F.col("conv").alias("head_conv"))
        here = here.join(above, "head", "left").drop("seg", "next")
        nodes, _ = store(_level(here))
        below = nodes.where(F.col("depth") == 0).select(F.col("root_of").alias("next"), *sums)
        nodes = nodes.where(F.col("depth") >= (0 if level == 0 else 1)).drop("root_of")
        found.append(nodes.withColumn("depth", F.col("depth") + level * segment))
    if not found:  # no conversation, so not even a root
        found = [sequences.sparkSession.createDataFrame(
            [], "depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
            "ends string, parent_conv_id long")]
    whole = found[0]
    for nodes in found[1:]:
        whole = whole.unionByName(nodes)
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NOBODY)).alias("ends_sha256"),
    )


def prefix_trie(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row for each different beginning of the rebuilt conversations of ``turns``.

    Turns are ordered by ``turn``, null first, ties by the SHA-256 of role and text; a null
    role or text is empty. ``rebuilt`` gives conversations the beginning of another. A node is a
    different sequence of the first ``depth`` turns, by role and text; those that begin with
    it are its members. The columns:

    * ``conv_id``: the smallest member; ``parent_conv_id``: that of the node above (root: null)
    * ``n_convs``: members; ``n_children``: nodes one turn longer
    * ``n_leaves``: nodes without children in its subtree, itself included
    * ``saved_tokens``: over the subtree, members but one times the UTF-8 bytes of the last text
    * ``ends_sha256``: of the members that end here, ascending, as decimals joined by commas

    Rows without a conversation id are left out; rows that repeat a turn are turns of their own. Other
    columns are not read. An empty table gives an empty result, without a root. Texts of any
    length are taken whole, and so are conversations, with one round of jobs for each SEGMENT
    turns of the longest.
    """
    return trie_nodes(rebuilt(encoded_turns(turns, key, turn, role, text)))
