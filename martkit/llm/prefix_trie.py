"""Z-fast trie of conversations: shared prefixes of turns, found by fat binary search.

A conversation is a string whose letters are its turns (role and text).  Every prefix is known by 128 bits, the exclusive or of
the hashes of (place, turn), so prefixes of all lengths come from running totals, which are taken in blocks of turns.

The trie is compacted: a node stands for the prefixes of lengths (p, e] that lead to it.  Its *handle* is its prefix of the
2-fattest length in (p, e], the one that the most powers of two divide.  Handles are the keys of the dictionary.
A conversation finds its exit node by fat binary search: of the lengths still open it looks up the prefix of 2-fattest
length; a hit moves on to the end of that node, a miss rules out that length and those beyond.  So a search takes as many joins
as the longest conversation's length has bits.  Turns are compared only inside the edge where the search ends.

Conversations are inserted in batches.  All search the trie as it is; of those that leave it at the same place by the same
turn one is inserted (in the first batches the smallest id, then one chosen by hash), and the others go on from there in the next
batch, so the batches are expected to be as many as the logarithm of the conversations that share a prefix.  Equal conversations are one string from the start.

``expanded`` turns edges back into one row per prefix.  Totals over subtrees need no walk: a string passes through the nodes on its
path only, and each edge belongs to the string that brought it.

Defined results: turns are ordered by turn (null first), then role, then the SHA-256 of the text; a null role or text is empty;
rows without a conversation id are left out; an empty table gives no rows; rows that repeat are turns of their own.  Only conv_id,
turn, role and text are read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.ordered import in_order, number_in_key
from .common import written

#: Turns of a block, members of a chunk, and lengths in a cell of an edge: no task takes more of one conversation at a time.
BLOCK, CHUNK, CELL = 4096, 4096, 32
#: Batches that take the smallest id, from which others often have their beginning; later ones choose by hash.
OLDEST = 4
_ROOT = "0" * 32
_NODE = ["p", "y", "e", "h", "rep", "f", "fh", "ch"]


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """conv, place (from 1), letter (of role and text) and n (code points of the text) of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    letter = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
                                                             F.sha2(text, 256).alias("sha"), letter.alias("letter"), F.length(text).cast("long").alias("n"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "sha")]
    placed = number_in_key(in_order(rows, order), ["conv"], "place")
    return written(placed.select("conv", (F.col("place") + 1).alias("place"), "letter", "n"), "placed")


def rebuilt_turns(turns: DataFrame, group: int = 100, shared: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their group, and all their ids, also of those without turns.

    Of conversation ``c`` the first ``h = crc32(c) % shared`` turns are taken from ``c - c % group``, the others stay.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("size")).withColumns({
        "first": F.col("conv") - F.col("conv") % group, "h": F.crc32(F.col("conv").cast("string").cast("binary")) % shared})
    lead = convs.join(convs.select(F.col("conv").alias("first"), F.col("size").alias("lead")), "first", "left")
    lead = written(lead.withColumn("lead", F.least(F.coalesce("lead", F.lit(0)), F.col("h"))), "lead")
    own = lead.select("conv", "h", "lead", F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / BLOCK))).alias("block"))
    own = turns.withColumn("block", F.floor(F.col("place") / BLOCK)).join(own, ["conv", "block"]).where("place > h") \
        .select("conv", (F.col("place") - F.col("h") + F.col("lead")).alias("d"), "letter", "n")
    taken = lead.where("lead > 0").select("conv", "first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("lead").cast("long"))).alias("d"))
    base = turns.where(F.col("place") < shared).select(F.col("conv").alias("first"), F.col("place").alias("d"), "letter", "n")
    return taken.join(base, ["first", "d"]).select("conv", "d", "letter", "n").unionByName(own), lead.select("conv")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv, d, h (the prefix of the first d turns) and upto (its code points), running over blocks of turns."""
    sums = {"x": F.bit_xor("x"), "y": F.bit_xor("y"), "upto": F.sum("n")}
    rows = turns.select("conv", "d", "n", F.floor(F.col("d") / BLOCK).alias("block"), F.xxhash64(F.lit(1), "d", "letter").alias("x"),
                        F.xxhash64(F.lit(2), "d", "letter").alias("y"))
    ahead = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("n").alias("n"))
    blocks = blocks.select("conv", "block", *[c.over(ahead).alias(f"_{k}") for k, c in sums.items()]).where("block > 0")
    inside = W.partitionBy("conv", "block").orderBy("d").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.select("conv", "block", "d", *[c.over(inside).alias(k) for k, c in sums.items()]).join(blocks, ["conv", "block"], "left")
    zero = F.lit(0).cast("long")
    x, y = (F.col(k).bitwiseXOR(F.coalesce(f"_{k}", zero)) for k in "xy")
    return rows.select("conv", "d", F.lower(F.concat(*[F.lpad(F.hex(v), 16, "0") for v in (x, y)])).alias("h"),
                       (F.col("upto") + F.coalesce("_upto", zero)).alias("upto"))


def fattest(a: Column, b: Column) -> Column:
    """The 2-fattest number in (a, b]."""
    low = F.floor(F.log2(a.bitwiseXOR(b).cast("double"))).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", b, low), low)


def _looked_up(rows: DataFrame, points: DataFrame, owner: str, depth: str, name: str) -> DataFrame:
    """``name``: the hash of the first ``depth`` turns of string ``owner``; null beyond its end."""
    return rows.join(points.select(F.col("conv").alias(owner), F.col("d").alias(depth), F.col("h").alias(name)), [owner, depth], "left")


def _exits(pending: DataFrame, nodes: DataFrame, points: DataFrame, rounds: int) -> DataFrame:
    """Where each string leaves the trie: m, its hash, that of the turn beyond, and the node whose edge that is (if it is inside one).

    ``pending`` has conv, size and base, a length at which there is a node on the string's path.
    """
    state = pending.select("conv", "size", "base", F.col("base").alias("a"), F.col("size").alias("b"), F.lit(None).cast("long").alias("ve"),
                           F.lit(None).cast("string").alias("vh"), F.lit(None).cast("long").alias("vf"))
    handles = nodes.select("f", "fh", F.col("e").alias("_e"), F.col("h").alias("_h"))
    for _ in range(rounds):
        # A search that is over looks up nothing; its key is its own, so such rows don't meet in one task.
        state = state.withColumn("f", F.when(F.col("a") < F.col("b"), fattest(F.col("a"), F.col("b"))).otherwise(F.lit(-1).cast("long")))
        state = _looked_up(state, points, "conv", "f", "fh").withColumn("fh", F.coalesce("fh", F.col("conv").cast("string")))
        state = state.join(handles, ["f", "fh"], "left")
        hit, open_ = F.col("_e").isNotNull(), F.col("f") >= 0
        state = state.select("conv", "size", "base", F.when(hit, F.least("_e", "b")).otherwise(F.col("a")).alias("a"),
                             F.when(open_ & ~hit, F.col("f") - 1).otherwise(F.col("b")).alias("b"), F.coalesce("_e", "ve").alias("ve"),
                             F.coalesce("_h", "vh").alias("vh"), F.when(hit, F.col("f")).otherwise(F.col("vf")).alias("vf"))
    state = _looked_up(state, points, "conv", "ve", "xh")
    # The handle fits; whether the rest of the node does is seen at its end.
    inside = F.col("ve").isNotNull() & ~F.col("xh").eqNullSafe(F.col("vh"))
    state = state.withColumn("inside", inside).withColumn("at", F.when(F.col("inside"), -1).otherwise(F.coalesce("ve", "base")))
    state = _looked_up(state.withColumn("next", F.when(F.col("inside"), -1).otherwise(F.col("at") + 1)), points, "conv", "next", "nh")
    state = state.withColumn("nh", F.coalesce("nh", F.col("conv").cast("string")))
    children = nodes.select((F.col("p") + 1).alias("next"), F.col("ch").alias("nh"), F.col("e").alias("_e"), F.col("h").alias("_h"))
    state = state.join(children, ["next", "nh"], "left").select(
        "conv", "size", "at", F.when(F.col("inside"), F.col("ve")).otherwise(F.col("_e")).alias("e"), F.when(F.col("inside"), F.col("vh")).otherwise(F.col("_h")).alias("eh"),
        F.when(F.col("inside"), F.col("vf")).otherwise(F.col("next")).alias("low"))
    state = written(state, "searched")
    # Inside an edge, the turns of both are compared length by length.
    edges = state.where("e IS NOT NULL").join(nodes.select("e", F.col("h").alias("eh"), "rep"), ["e", "eh"])
    spans = edges.select("conv", "rep", "low", F.least("e", "size").alias("high")) \
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor(F.col("high") / CELL))))
    cells = points.withColumn("cell", F.floor(F.col("d") / CELL))
    mine = spans.join(cells.select("conv", "cell", "d", "h"), ["conv", "cell"]).where("d BETWEEN low AND high")
    equal = mine.join(points.select(F.col("conv").alias("rep"), "d", "h"), ["rep", "d", "h"], "left_semi")
    met = equal.groupBy("conv").agg(F.max("d").alias("met"))
    state = state.join(met, "conv", "left").select("conv", "size", "e", "eh", F.coalesce("met", "at").alias("m"))
    state = _looked_up(state.withColumn("beyond", F.col("m") + 1), points, "conv", "m", "mh")
    return written(_looked_up(state, points, "conv", "beyond", "bh"), "exits")


def _grown(exits: DataFrame, nodes: DataFrame, points: DataFrame, order: Column) -> tuple[DataFrame, DataFrame]:
    """The strings that are inserted now, and the nodes with them; of strings in each other's way the first by ``order``."""
    ending, leaving = exits.where("m = size"), exits.where("m < size")
    chosen = leaving.groupBy("m", "bh").agg(F.min_by("conv", order).alias("conv")).select("conv")
    inserted = written(ending.unionByName(leaving.join(chosen, "conv", "left_semi")), "inserted")
    leaves = inserted.where("m < size").select(F.col("m").alias("p"), F.col("mh").alias("y"), F.col("size").alias("e"), F.col("conv").alias("rep"))
    leaves = _looked_up(leaves, points, "rep", "e", "h")
    cuts = inserted.where("m < e").select("e", F.col("eh").alias("h"), "m", "mh").distinct()
    cuts = written(cuts.join(nodes.select("e", "h", "p", "y", "rep"), ["e", "h"]), "cuts")
    line = W.partitionBy("e", "h").orderBy("m")
    upper = cuts.select(F.coalesce(F.lag("m").over(line), "p").alias("p"), F.coalesce(F.lag("mh").over(line), "y").alias("y"), F.col("m").alias("e"),
                        F.col("mh").alias("h"), "rep")
    lower = cuts.groupBy("e", "h", "rep").agg(F.max("m").alias("p"), F.max_by("mh", "m").alias("y"))
    columns = ["p", "y", "e", "h", "rep"]
    fresh = reduce(DataFrame.unionByName, [x.select(*columns) for x in (leaves, upper, lower)])
    fresh = fresh.withColumn("f", fattest(F.col("p"), F.col("e"))).withColumn("first", F.col("p") + 1)
    fresh = _looked_up(_looked_up(fresh, points, "rep", "f", "fh"), points, "rep", "first", "ch").select(*_NODE)
    whole = nodes.join(cuts.select("e", "h"), ["e", "h"], "left_anti").select(*_NODE)
    return inserted, written(whole.unionByName(fresh), "nodes")


def built(strings: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The compacted trie of ``strings`` (conv, size), and the length ``m`` at which each string joined it.

    Nodes: p and y (length and hash of the parent), e and h (their own), rep (a string through them), and the hashes of their
    handle (f, fh) and of their first turn (ch).
    """
    spark = strings.sparkSession
    nodes = spark.createDataFrame([], "p long, y string, e long, h string, rep long, f long, fh string, ch string")
    longest = strings.agg(F.max("size")).first()[0] or 0
    # The first batch meets an empty trie.
    exits = strings.select("conv", "size", F.lit(None).cast("long").alias("e"), F.lit(None).cast("string").alias("eh"), F.lit(0).cast("long").alias("m"),
                           F.lit(1).cast("long").alias("beyond"), F.lit(_ROOT).alias("mh"))
    exits, joined = written(_looked_up(exits, points, "conv", "beyond", "bh"), "exits"), []
    while True:
        order = F.col("conv") if len(joined) < OLDEST else F.struct(F.xxhash64("conv"), "conv")
        inserted, nodes = _grown(exits, nodes, points, order)
        joined.append(inserted.select("conv", "m"))
        pending = exits.join(inserted.select("conv"), "conv", "left_anti").select("conv", "size", F.col("m").alias("base"))
        if pending.isEmpty():
            break
        exits = _exits(pending, nodes, points, int(longest).bit_length())
    empty = strings.where("false").select("conv", F.col("size").alias("m"))
    return nodes, reduce(DataFrame.unionByName, joined, empty)


def _digests(members: DataFrame) -> DataFrame:
    """conv (of a string) and sha: of its members' ids, ascending, comma-joined; ``members`` has conv, count and member.

    Ids of a string with many members are joined in chunks of neighbouring ids.  Such a digest has to be taken in order, so
    its chunks stream through one task.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda i: i.cast("string")), ",").alias("ids")
    few = members.where(F.col("count") <= CHUNK).groupBy("conv").agg(ids).select("conv", F.sha2("ids", 256).alias("sha"))
    chunks = members.where(F.col("count") > CHUNK).groupBy("conv", F.floor(F.col("member") / CHUNK).alias("chunk")).agg(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(conv: int, digest) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=["conv", "sha"])
        conv, digest = None, None
        for batch in batches:
            for c, part in zip(*(x.to_pylist() for x in batch.columns)):
                if c == conv:
                    digest.update(b",")
                else:
                    if conv is not None:
                        yield row(conv, digest)
                    conv, digest = c, hashlib.sha256()
                digest.update(part.encode())
        if conv is not None:
            yield row(conv, digest)
    long = chunks.repartition("conv").sortWithinPartitions("conv", "chunk").select("conv", "ids")
    return few.unionByName(long.mapInArrow(run, "conv long, sha string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per prefix of any conversation; ``turns`` has conv, d, letter, n; ``convs`` all ids."""
    points = written(prefixes(turns), "prefixes")
    ends = points.groupBy("conv").agg(F.max("d").alias("size"), F.max_by("h", "d").alias("h"), F.max("upto").alias("text"))
    whole = convs.join(ends, "conv", "left").select("conv", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("h", F.lit(_ROOT)).alias("h"),
                                                    F.coalesce("text", F.lit(0)).alias("text"))
    whole = written(whole, "whole")
    # Equal conversations are one string, named by its smallest id.
    strings = written(whole.groupBy("size", "h", "text").agg(F.min("conv").alias("conv"), F.count("*").alias("members")), "strings")
    members = whole.select(F.col("conv").alias("member"), "size", "h") \
        .join(strings.select("conv", "size", "h", F.col("members").alias("count")), ["size", "h"]).select("conv", "count", "member")
    digests = written(_digests(members), "digests")
    start = strings.select("conv", F.lit(0).cast("long").alias("d"), F.lit(_ROOT).alias("h"), F.lit(0).cast("long").alias("upto"))
    points = written(points.join(strings.select("conv"), "conv", "left_semi").unionByName(start), "points")
    nodes, joined = built(strings.select("conv", "size"), points)
    joined = joined.join(points.select("conv", F.col("d").alias("m"), F.col("upto").alias("before")), ["conv", "m"])
    return expanded(nodes, strings.join(joined.select("conv", "before"), "conv"), points, digests)


def expanded(nodes: DataFrame, strings: DataFrame, points: DataFrame, digests: DataFrame) -> DataFrame:
    """Edges expanded to one row per prefix, with totals over its subtree."""
    strings = written(strings.join(digests, "conv"), "strings")
    children = nodes.groupBy(F.col("p").alias("e"), F.col("y").alias("h")).agg(F.count("*").alias("children"))
    nodes = written(nodes.join(children, ["e", "h"], "left").withColumn("children", F.coalesce("children", F.lit(0)))
                    .select("p", "y", "e", "h", "rep", "children"), "compacted")
    ends = nodes.where("children = 0").select(F.col("e").alias("size"), "h", F.lit(1).alias("leaf"))
    strings = written(strings.join(ends, ["size", "h"], "left").withColumn("leaf", F.coalesce("leaf", F.lit(0))), "ended")
    totals = [F.sum("members").alias("n"), F.min("conv").alias("least"), F.sum("leaf").alias("leaves"),
              # Code points of all members, and of the edges that these strings brought.
              F.sum(F.col("members") * F.col("text")).alias("all"), F.sum(F.col("text") - F.col("before")).alias("edges")]
    alone = strings.where("leaf = 1").groupBy(F.col("size").alias("e"), "h").agg(*totals)
    inner = nodes.where("children > 0").select("e", "h")
    path = points.where("d > 0").select("conv", F.col("d").alias("e"), "h").join(inner, ["e", "h"]) \
        .join(strings.select("conv", "members", "leaf", "text", "before"), "conv")
    stats = written(alone.unionByName(path.groupBy("e", "h").agg(*totals)), "totals")
    root = strings.agg(*totals, F.max(F.when(F.col("size") == 0, F.col("sha"))).alias("sha")).where("n IS NOT NULL")
    tops = nodes.where("p = 0").agg(F.count("*").alias("n_children"))          # one row, as is the root
    none = hashlib.sha256(b"").hexdigest()
    long = F.lit(None).cast("long")
    top = root.crossJoin(F.broadcast(tops)).select(
        F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), long.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"), (F.col("all") - F.col("edges")).alias("saved_tokens"),
        F.coalesce("sha", F.lit(none)).alias("ends_sha256"))

    parents = stats.select(F.col("e").alias("p"), F.col("h").alias("y"), F.col("least").alias("above"))
    rows = nodes.join(stats, ["e", "h"]).join(parents, ["p", "y"], "left") \
        .join(strings.select(F.col("size").alias("e"), "h", "sha"), ["e", "h"], "left") \
        .join(strings.select(F.col("conv").alias("rep"), F.col("before").alias("joined")), "rep")
    rows = rows.crossJoin(F.broadcast(root.select(F.col("least").alias("first"))))
    rows = rows.withColumn("cell", F.explode(F.sequence(F.floor((F.col("p") + 1) / CELL), F.floor(F.col("e") / CELL))))
    # ``ahead``: code points in front of the prefix's last turn.
    ahead = points.select("conv", (F.col("d") + 1).alias("d"), F.col("upto").alias("ahead")).withColumn("cell", F.floor(F.col("d") / CELL))
    rows = rows.join(ahead.withColumnRenamed("conv", "rep"), ["rep", "cell"]).where("d > p AND d <= e")
    last = F.col("d") == F.col("e")
    return top.unionByName(rows.select(
        F.col("least").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") > F.col("p") + 1, F.col("least")).otherwise(F.coalesce("above", "first")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").cast("long").alias("n_leaves"),
        (F.col("all") - F.col("edges") - F.col("joined") - (F.col("n") - 1) * F.col("ahead")).alias("saved_tokens"),
        F.when(last & F.col("sha").isNotNull(), F.col("sha")).otherwise(F.lit(none)).alias("ends_sha256")))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    turns, convs = rebuilt_turns(conversation_turns(conversations))
    return prefix_trie(turns, convs)
