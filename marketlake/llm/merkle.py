"""Merkle manifest of a dataset, with proofs found by descent of a content-addressed graph.

The digest of a row (its leaf) is the SHA-256 of its fields. The leaves of each group ascend by their key; runs of 16
successive nodes become a node, the SHA-256 of their digests in hex one after the other, until one node of the group
is left. These subroots, in the order of the groups (null first), become the root in the same way.

Every node is stored as a record: its digest and the digests of its children. Records are addressed by content, so
equal subtrees are one record. A request for a leaf is its group and rank. The requests descend together from the
root: the digits of the rank to the base of 16 choose the children, the unselected children of each node are collected
as a segment of the path, and at the leaf the segments are reversed. Requests that share a prefix of digits are one row
down to where they part, so a level has as many rows as it has requested nodes, never more than leaves, and the last
step joins the requests with the parents of their leaves. The path of a parent is shipped once for up to 16 leaves.

Ranks come from one range sort of keys and leaves, without texts, so a group that holds most rows is sorted by many
tasks. No group is gathered anywhere: a node of 16 children is the largest unit.

Defined cases: a null field counts as ``-``; null keys come first; rows that repeat a key are ordered by their leaves,
and rows that are equal in all fields are leaves each; a group of one row has its leaf as subroot, and a manifest of
one group its subroot as root; a leaf without siblings has the SHA-256 of nothing as digest of its proof; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.ranking import with_position
from marketlake.session import stored

_BITS = 4
FANOUT = 1 << _BITS
_DEPTHS = 15  # levels that numbers of 64 bits can need


def field(column: Column) -> Column:
    """A value as bytes of UTF-8, their number, and a colon between; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*(field(x) for x in columns)).cast("binary"), 256)


def _digest(parts: Column) -> Column:
    return F.sha2(parts.cast("binary"), 256)


def depth_of(count: Column) -> Column:
    """The levels above so many leaves."""
    out = F.lit(0)
    for depth in range(_DEPTHS):
        out = out + (count > F.lit(FANOUT**depth)).cast("int")
    return out


@dataclass
class Manifest:
    """A stored manifest.

    ``leaves``: group, rank, key, leaf of every row and its other columns; ``records``: digest, children of every node
    above leaves; ``groups``: group, place (in the order of groups), depth (levels of the group), subroot; ``depth``:
    levels above the subroots; ``deepest``: most levels of a group; ``root``: the digest of all.
    """

    leaves: DataFrame
    records: DataFrame
    groups: DataFrame
    depth: int
    deepest: int
    root: str | None


def _raised(level: DataFrame, *keys: str) -> DataFrame:
    """The next level of nodes (keys, rank, digest): runs of successive nodes with their children."""
    runs = level.groupBy(*keys, F.shiftright("rank", _BITS).alias("rank"))
    children = F.transform(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("at"), "digest"))), lambda x: x["digest"])
    return runs.agg(children.alias("children")).withColumn("digest", _digest(F.array_join("children", "")))


def _tree(level: DataFrame, name: str, *keys: str) -> list[DataFrame]:
    """The levels of nodes above a level of digests (keys, rank, depth, digest), each written once. Those whose depth is
    reached are left behind."""
    out = []
    for _ in range(_DEPTHS):
        level = level.filter(F.col("depth") > len(out))
        if level.isEmpty():
            break
        level = stored(_raised(level, *keys, "depth"), name)
        out.append(level)
    return out


def manifest(rows: DataFrame) -> Manifest:
    """The manifest of rows with columns ``group``, ``key`` and ``leaf``."""
    own = [c for c in rows.columns if c != "group"]
    # Equal rows are told apart by chance numbers, so that a range of the sort can end between them.
    placed = with_position(rows.withColumn("_tie", F.rand(29)), F.asc_nulls_first("group"), F.asc_nulls_first("key"), "leaf", "_tie")
    sizes = placed.groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.min("position").alias("start"))
    sizes = sizes.select(F.col("group").alias("of"), depth_of(F.col("size")).alias("depth"), "start")
    leaves = placed.join(sizes, F.col("group").eqNullSafe(F.col("of")))
    leaves = stored(leaves.select("group", (F.col("position") - F.col("start")).alias("rank"), *own, "depth"), "manifest-leaves")
    levels = _tree(leaves.select("group", "rank", "depth", F.col("leaf").alias("digest")), "manifest-nodes", "group")
    tops = leaves.filter("depth = 0").select("group", "depth", F.col("leaf").alias("subroot"))
    for number, level in enumerate(levels):
        tops = tops.unionByName(level.filter(F.col("depth") == number + 1).select("group", "depth", F.col("digest").alias("subroot")))
    groups = stored(with_position(tops, F.asc_nulls_first("group"), name="place"), "manifest-subroots")
    count = groups.count()
    depth = next(d for d in range(_DEPTHS + 1) if FANOUT**d >= count)
    upper = _tree(groups.select(F.col("place").alias("rank"), F.lit(depth).alias("depth"), F.col("subroot").alias("digest")), "manifest-top")
    records = rows.sparkSession.createDataFrame([], "digest string, children array<string>")
    for level in [*levels, *upper]:
        records = records.unionByName(level.select("digest", "children"))
    top = upper[-1].select("digest").first() if upper else groups.select("subroot").first()
    return Manifest(leaves, stored(records.dropDuplicates(["digest"]), "manifest-records"), groups, depth, len(levels), top[0] if top else None)


def _segment(children: Column, digit: Column) -> Column:
    """The unselected children, before and after the selected one."""
    before = F.array_join(F.slice(children, F.lit(1), digit), "")
    after = F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def _descended(state: DataFrame, wanted: DataFrame, records: DataFrame, *keys: str) -> DataFrame:
    """One level down: from nodes (keys, rank, digest, path) to their wanted children (keys, rank)."""
    opened = state.join(records, "digest").select(*keys, F.col("rank").alias("parent"), "children", "path")
    chosen = wanted.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("rank"), F.shiftright("rank", _BITS).alias("_parent"))
    same = F.col("parent") == F.col("_parent")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    digit = (F.col("rank") % FANOUT).cast("int")
    return opened.join(chosen, same).select(
        *keys, "rank", F.element_at("children", digit + 1).alias("digest"), F.array_append("path", _segment(F.col("children"), digit)).alias("path")
    )


def proofs(made: Manifest, requests: DataFrame) -> DataFrame:
    """The requests (group, rank and any other columns) with ``path``: the unselected children (before, after) of each
    node from the leaf's parent to the root; ``subroot`` of the group and ``root``."""
    path = "array<struct<before:string,after:string>>"
    groups = made.groups.select("group", F.col("place").alias("rank"), "depth", "subroot")
    state = requests.sparkSession.range(1).select(F.col("id").alias("rank"), F.lit(made.root).alias("digest"), F.array().cast(path).alias("path"))
    for level in range(made.depth - 1, -1, -1):
        state = _descended(state, groups.select(F.shiftright("rank", _BITS * level).alias("rank")).distinct(), made.records)
    entering = state.join(groups, "rank").select("group", F.lit(0).cast("long").alias("rank"), "digest", "path", "depth")
    entering = stored(entering, "proof-groups")

    depths = groups.select(F.col("group").alias("of"), "depth")
    parents = requests.select(F.col("group"), F.shiftright("rank", _BITS).alias("rank")).distinct()
    parents = parents.join(depths, F.col("group").eqNullSafe(F.col("of"))).select("group", "rank", "depth")
    parents = stored(parents, "proof-requests")
    state = None
    for level in range(made.deepest, 0, -1):
        own = entering.filter(F.col("depth") == level).drop("depth")
        if state is not None:
            wanted = parents.filter(F.col("depth") > level).select("group", F.shiftright("rank", _BITS * (level - 1)).alias("rank"))
            own = own.unionByName(_descended(state, wanted.distinct() if level > 1 else wanted, made.records, "group"))
        state = own
    # The parents of the leaves, and the subroots that are leaves themselves.
    above = entering.filter("depth = 0").select("group", "rank", F.lit(None).cast("array<string>").alias("children"), "path")
    if state is not None:
        above = above.unionByName(state.join(made.records, "digest").select("group", "rank", "children", "path"))
    above = above.select(F.col("group").alias("_group"), F.col("rank").alias("_above"), "children", F.col("path").alias("_path"))
    joined = requests.join(above, F.col("group").eqNullSafe(F.col("_group")) & (F.shiftright("rank", _BITS) == F.col("_above")))
    digit = (F.col("rank") % FANOUT).cast("int")
    whole = F.when(F.col("children").isNull(), F.col("_path")).otherwise(F.array_append("_path", _segment(F.col("children"), digit)))
    subroots = groups.select(F.col("group").alias("_of"), "subroot")
    joined = joined.withColumn("path", F.reverse(whole)).drop("_group", "_above", "children", "_path")
    return joined.join(subroots, F.col("group").eqNullSafe(F.col("_of"))).drop("_of").withColumn("root", F.lit(made.root))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda digest, x: _digest(F.concat(x["before"], digest, x["after"])))


def proof_digest(path: Column) -> Column:
    """The SHA-256 of all siblings on a path, from the leaf's to the root's, left to right."""
    return _digest(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""))


def lowered(text: Column) -> Column:
    """Text with A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def audited(docs: DataFrame, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every document's place in the manifest of all,
    and whether its proof still leads to the root from what the document is now. ``changed`` has the new fields of the
    documents that ``tampered`` chooses."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    now = F.when(tampered, leaf_digest(*(changed.get(x, F.col(x)) for x in fields)))
    rows = docs.select(F.col("source").alias("group"), F.col("doc_id").alias("key"), leaf_digest(*map(F.col, fields)).alias("leaf"), now.alias("now"))
    made = manifest(rows)
    proven = proofs(made, made.leaves.select("group", "rank", "key", "leaf", "now"))
    proven = proven.withColumn("folded_root", folded(F.coalesce("now", "leaf"), F.col("path")))
    return proven.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
