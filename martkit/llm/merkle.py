"""Merkle manifest of a data set: a proof per row, found by pointer jumping.

A row's leaf is the SHA-256 of its columns.  Leaves of one source, ascending by id, are hashed in runs of ``FAN`` until one
node is left, the source's subroot; the subroots, ascending by source, are hashed in the same way into the root.  A proof
is a list of segments from the leaf to the root: the digests of the run to the left and to the right of the node.

Every inner node starts with a pointer to its parent and the segment in between.  A round joins nodes with the nodes they
point to, which doubles the distance and joins the segments up, until all point beyond the root: as many rounds as the
logarithm of the depth.  Leaves, which are ``FAN`` times as many, take the last step: a run of leaves meets its parent once,
and the leaves' own segments are cut from the run.

Places of leaves come from ranges of (source, id), so a source with a third of all rows is spread like any other, and runs
are the only groups that are ever collected.

Defined results: null is a source of its own, the first; ids ascend with null first, equal ids by leaf; of rows that repeat each
has a leaf; a source of one row has the leaf as its subroot, one source's subroot is the root; no rows give no rows.  Only the
named columns are read, so other columns, whatever their names, make no difference.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import in_order, number_in_key, number_in_order
from .common import written

#: Children of a node.
FAN = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree above the subroots.  Trees of sources are numbered from 0.
_TOP = -1


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (hex) of the values: ``-`` for null, else their length in bytes, a colon and their UTF-8."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _node(children: Column) -> Column:
    """The digest (hex) of a run, from its children's digests (hex)."""
    return F.sha2(F.array_join(children, ""), 256)


def _segment(children: Column, place: Column) -> Column:
    """The digests left and right of a child (places from 0) of a run, 32 bytes each."""
    left, right = F.slice(children, F.lit(1), place), F.slice(children, place + 2, F.lit(FAN))
    return F.struct(F.unhex(F.array_join(left, "")).alias("left"), F.unhex(F.array_join(right, "")).alias("right"))


def proof_digest(path: Column) -> Column:
    """SHA-256 (hex) of all digests of a proof as hex text, from the leaf's run up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf (hex) and its proof give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(_hex(s["left"]), node, _hex(s["right"])), 256))


def _key(tree: Column, level: int | Column, place: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), F.lit(level).cast("int").alias("level"), place.cast("long").alias("place"))


def _runs(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of trees that have several at this level, hashed in runs; a run is a node of the level above."""
    runs = nodes.where("size > 1").groupBy("tree", "size", F.floor(F.col("place") / FAN).alias("place")) \
        .agg(F.array_sort(F.collect_list(F.struct("place", "key", "digest"))).alias("children"))
    return written(runs.select("tree", F.ceil(F.col("size") / FAN).alias("size"), "place", _node(F.col("children.digest")).alias("digest"),
                               _key(F.col("tree"), level, F.col("place")).alias("key"), "children"), "runs")


def _edges(runs: DataFrame, subroots: bool) -> DataFrame:
    """Child to parent, with the child's run as the segment in between; ``subroot`` where the child is one."""
    child = runs.select("key", F.col("children.digest").alias("all"), F.posexplode("children").alias("place", "child"))
    return child.select(F.col("child.key").alias("key"), F.col("key").alias("to"), F.array(_segment(F.col("all"), F.col("place"))).alias("path"),
                        (F.col("child.digest") if subroots else F.lit(None).cast("string")).alias("subroot"))


def _jumped(edges: DataFrame, depth: int) -> DataFrame:
    """Pointers doubled until they point beyond the root: ``path`` then leads from the node to the root.

    A pointer beyond the root has level 0.  After ``r`` rounds no node points to one lower than level ``2 ** r + 1`` of its
    own tree, so the other side of the join shrinks quickly; few nodes of it are left when many nodes point to the same.
    """
    for distance in (1 << r for r in range(max(depth - 1, 0).bit_length())):
        ahead = edges.where((F.col("key.tree") == _TOP) | (F.col("key.level") > distance)) \
            .select(F.col("key").alias("to"), F.col("to").alias("_to"), F.col("path").alias("_path"), F.col("subroot").alias("_subroot"))
        beyond = _key(F.col("key.tree"), 0, F.col("key.place"))
        met = F.col("_to").isNotNull()
        edges = written(edges.join(ahead, "to", "left").select(
            "key", F.when(met, F.col("_to")).otherwise(F.when(F.col("to.level") == 0, F.col("to")).otherwise(beyond)).alias("to"),
            F.when(met, F.concat("path", "_path")).otherwise(F.col("path")).alias("path"), F.coalesce("subroot", "_subroot").alias("subroot")), "jumped")
    return edges


def merkle_proofs(docs: DataFrame, columns: Sequence[str] = COLUMNS, source: str = "source", doc_id: str = "doc_id",
                  altered: Column | None = None) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root (hex), ``altered`` (a digest of the caller's, carried along) and ``path``, its proof."""
    plain = [docs[f"`{c}`"] for c in columns]
    leaves = written(docs.select(docs[f"`{source}`"].alias("source"), docs[f"`{doc_id}`"].alias("id"), leaf_digest(plain).alias("leaf"),
                                 (F.lit(None) if altered is None else altered).cast("string").alias("altered")), "leaves")
    order = [F.col(c).asc_nulls_first() for c in ("source", "id", "leaf")]
    placed = number_in_key(in_order(leaves, order), ["source"], "place")
    by_source = leaves.groupBy("source").agg(F.count("*").alias("n"))
    trees = written(number_in_order(in_order(by_source, order[:1]), "tree").select(F.col("source").alias("_source"), "n", "tree"), "trees")
    largest, sources = trees.agg(F.max("n"), F.count("*")).first()
    if not sources:
        return placed.select(F.col("id").alias("doc_id"), "leaf", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"), "altered",
                             F.array(_segment(F.array("leaf"), F.lit(0))).alias("path"))
    bottom = placed.groupBy("source", F.floor(F.col("place") / FAN).alias("place")) \
        .agg(F.array_sort(F.collect_list(F.struct("place", "leaf", "id", "altered"))).alias("children"))
    bottom = written(bottom.join(trees, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source"), "bottom")

    leaf = F.col("children.leaf")
    nodes = bottom.select("tree", F.ceil(F.col("n") / FAN).alias("size"), "place", F.when(F.col("n") > 1, _node(leaf)).otherwise(leaf[0]).alias("digest"),
                          _key(F.col("tree"), 1, F.col("place")).alias("key"))
    edges, subroots, level, size = [], [], 1, -(-largest // FAN)
    while size > 1:
        subroots.append(nodes.where("size = 1"))
        level, size = level + 1, -(-size // FAN)
        nodes = _runs(nodes, level)
        edges.append(_edges(nodes, subroots=False))
    subroots.append(nodes.where("size = 1"))
    columns = ["tree", "size", "place", "digest", "key"]
    top = reduce(DataFrame.unionByName, [x.select(*columns) for x in subroots]) \
        .select(F.lit(_TOP).cast("long").alias("tree"), F.lit(sources).alias("size"), F.col("tree").alias("place"), "digest", "key")
    height, size = 0, sources
    while size > 1:
        height, size = height + 1, -(-size // FAN)
        top = _runs(top, height)
        edges.append(_edges(top, subroots=height == 1))
    root = top.select("digest").first()["digest"]

    rows = bottom.withColumn("key", _key(F.col("tree"), 1, F.col("place")))
    if edges:
        known = _jumped(reduce(DataFrame.unionByName, edges), level - 1 + height)
        rows = rows.join(known.where(f"key.tree <> {_TOP} AND key.level = 1").drop("to"), "key", "left")
    else:
        rows = rows.withColumns({"path": F.array().cast("array<struct<left: binary, right: binary>>"), "subroot": F.lit(None).cast("string")})
    rows = rows.select("n", "path", "subroot", leaf.alias("all"), F.posexplode("children").alias("place", "child"))
    own = F.when(F.col("n") > 1, F.array(_segment(F.col("all"), F.col("place")))).otherwise(F.array().cast(rows.schema["path"].dataType))
    return rows.select(F.col("child.id").alias("doc_id"), F.col("child.leaf").alias("leaf"), F.coalesce("subroot", F.lit(root)).alias("subroot"),
                       F.lit(root).alias("root"), F.col("child.altered").alias("altered"), F.concat(own, F.coalesce("path", F.array())).alias("path"))


def tampered_proofs(docs: DataFrame) -> DataFrame:
    """Proofs of ``documents``, some of which are checked against a text whose A-Z were lower-cased."""
    values = [F.translate(docs["text"], UPPER, LOWER) if c == "text" else docs[c] for c in COLUMNS]
    touched = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    found = merkle_proofs(docs, altered=F.when(touched, leaf_digest(values)))
    found = found.withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))
