"""Merkle manifest of a table: sibling-shift self-joins.

Rows are leaves; every group of rows (a source) is a tree of its own, and the roots of those trees are the
leaves of one last tree, whose root stands for the whole table. A node is (tree, idx, digest). At every
level a node's siblings have computed indices (``idx XOR 1`` in a binary tree, otherwise the offsets from
slot zero on), so the level is joined with itself by equality on (tree, index); the rows of slot zero then
emit the parents. A run that is not full, even one node, has a parent as well. A proof is the list of a
node's siblings, left and right of it, level by level up to the root; ``folded`` recomputes a root from it.

Numbers of leaves come from a range-partitioned, sorted table: a row's place in its partition, plus the
counts of the tree's rows in the partitions before. No tree is gathered anywhere, however many rows it has;
a key of the joins is one node. Proofs are not written for every leaf: the sixteen leaves of a run share
their parent's proof, and only the run's digests and that proof travel to them.

Definitions: the order of leaves is ascending by the given columns, null first; a null group is a tree of
its own, before the others, which follow by the bytes of their UTF-8 text. Rows that agree in all their
columns are leaves each, side by side, and alike in everything but their proofs, which their places decide.
A null value enters a leaf's digest as ``-``, an empty text as ``0:``. Texts are digested whole. An empty
table has no leaves and no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import stored

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Equal rows that one task writes out at most.
COPIES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def digest_of(*parts: Column) -> Column:
    """H: hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a digest: its length in bytes and the value, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column] | None = None, names: tuple[str, ...] = FIELDS) -> Column:
    """The digest of a row; ``columns`` replaces some of its values."""
    return digest_of(*[field((columns or {}).get(c, F.col(c))) for c in names])


def tree_key(group: Column) -> Column:
    """A group's name as a key that is never null and sorts as the group does."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``tree``) with ``idx``, the place in the tree by ``order``, and ``n``, the tree's rows. Rows that
    agree in all columns are counted first and written out again, a bounded number by each task."""
    keys = rows.columns
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    many = (counted.where(F.col("_copies") > COPIES)
            .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES).cast("long"))))
            .repartition(*keys, "_from"))
    few = counted.where(F.col("_copies") <= COPIES).withColumn("_from", F.lit(0).cast("long"))
    last = F.least(F.col("_copies") - 1, F.col("_from") + COPIES - 1)
    rows = few.unionByName(many).withColumn("_copy", F.explode(F.sequence("_from", last))).drop("_copies", "_from")
    order = ["tree", *order, *[c for c in keys if c not in order and c != "tree"], "_copy"]
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_copy")
                    .withColumn("_at", F.monotonically_increasing_id())
                    .withColumn("_part", F.shiftright("_at", 33)), name)
    parts = placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                         F.sum("_rows").over(whole).alias("n"))
    return stored(placed.join(parts, ["tree", "_part"]).withColumn("idx", F.col("_at") + F.col("_shift"))
                  .select(*keys, "idx", "n"), name)


def siblings(arity: int) -> tuple[Column, Column]:
    """Shifts from a node of slot zero to its run's nodes, itself included, and the index at a ``shift``."""
    there = F.least(F.lit(arity).cast("long"), F.col("n") - F.col("idx")) - 1
    at = F.col("idx").bitwiseXOR(F.col("shift")) if arity == 2 else F.col("idx") + F.col("shift")
    return F.sequence(F.lit(0).cast("long"), there), at


def parents(nodes: DataFrame, arity: int) -> DataFrame:
    """The next level (tree, idx, n, digest, run) of the trees with several nodes; ``run`` holds the digests below."""
    shifts, at = siblings(arity)
    zero = (nodes.where((F.col("n") > 1) & (F.col("idx") % arity == 0))
            .select("tree", "idx", "n", F.explode(shifts).alias("shift")).withColumn("_sibling", at))
    level = nodes.select("tree", F.col("idx").alias("_sibling"), "digest")
    run = F.transform(F.array_sort(F.collect_list(F.struct("shift", "digest"))), lambda x: x["digest"])
    return (zero.join(level, ["tree", "_sibling"]).groupBy("tree", "idx").agg(F.max("n").alias("n"), run.alias("run"))
            .select("tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
                    F.sha2(F.array_join("run", ""), 256).alias("digest"), "run"))


@dataclass
class Forest:
    """Trees over numbered nodes: ``levels[0]`` are the leaves, each further one the parents of the one before."""

    arity: int
    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest): a tree's last node; a lone leaf is its own."""
        tops = [x.where("n = 1").select("tree", "digest") for x in self.levels]
        out = tops[0]
        for more in tops[1:]:
            out = out.unionByName(more)
        return out

    def nodes(self) -> DataFrame:
        """The manifest: (tree, level, idx, digest) of every node."""
        parts = [x.select("tree", F.lit(k).alias("level"), "idx", "digest") for k, x in enumerate(self.levels)]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    def proofs(self, leaves: DataFrame, above: DataFrame) -> DataFrame:
        """``leaves`` (with tree, idx, n) with ``path``, the siblings level by level, and the columns of ``above``, one
        row (tree, path, ...) a tree with the path from its root on."""
        extra = [c for c in above.columns if c not in ("tree", "path")]
        known = None  # paths of the inner nodes of a level
        for level in reversed(self.levels[1:]):
            here = level.select("tree", "idx", "n", "run")
            tops = here.where("n = 1").join(above, "tree")
            if known is not None:
                tops = tops.unionByName(here.where("n > 1").join(known, ["tree", "idx"]))
            runs = tops.select("tree", "idx", "run", "path", *extra)
            if level is self.levels[1]:
                break
            known = (runs.select("tree", "idx", "path", "run", *extra, F.posexplode("run").alias("slot", "_own"))
                     .select("tree", (F.col("idx") * self.arity + F.col("slot")).alias("idx"), own_path().alias("path"), *extra))
        lone = leaves.where("n = 1").join(above, "tree")
        if len(self.levels) == 1:
            return lone
        runs = runs.withColumnRenamed("idx", "_parent")
        many = (leaves.where("n > 1").withColumn("_parent", F.expr(f"idx div {self.arity}"))
                .withColumn("slot", (F.col("idx") % self.arity).cast("int")).join(runs, ["tree", "_parent"])
                .withColumn("path", own_path()))
        return many.select(*lone.columns).unionByName(lone)


def own_path() -> Column:
    """The siblings of the node in ``slot`` of ``run``, before its parent's ``path``."""
    left = F.array_join(F.slice("run", F.lit(1), F.col("slot")), "")
    right = F.array_join(F.slice("run", F.col("slot") + 2, F.size("run")), "")
    return F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("path"))


def forest(nodes: DataFrame, arity: int, name: str) -> Forest:
    """All levels over numbered ``nodes`` (tree, idx, n, digest), each stored before the next is made."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stored(parents(levels[-1], arity), f"{name}-{len(levels)}"))
        most = -(-most // arity)
    return Forest(arity, levels)


def folded(leaf: str, path: str = "path") -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, F.col(leaf), lambda node, at: digest_of(at["left"], node, at["right"]))


def proof_digest(path: str = "path") -> Column:
    """H of all siblings, from the leaf's to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)


@dataclass
class Manifest:
    """A table's trees and the tree over their roots."""

    leaves: DataFrame
    trees: Forest
    top: Forest

    def nodes(self) -> DataFrame:
        """Every node of every tree; the tree over the trees has a null ``tree``."""
        return self.trees.nodes().unionByName(self.top.nodes().withColumn("tree", F.lit(None).cast("string")))

    def with_proofs(self) -> DataFrame:
        """The leaves with ``subroot``, ``root`` and ``path``."""
        empty = F.array().cast(_PATH)
        start = self.top.roots().select("tree", F.col("digest").alias("root"), empty.alias("path"))
        roots = (self.top.proofs(self.top.levels[0].select("tree", "idx", "n", "digest", "_tree"), start)
                 .select(F.col("_tree").alias("tree"), F.col("digest").alias("subroot"), "root", "path"))
        return self.trees.proofs(self.leaves, roots)


def build(rows: DataFrame, group: Column, order: list[str], digest: str, arity: int = ARITY, name: str = "merkle") -> Manifest:
    """The manifest of ``rows``: a tree for each value of ``group``, leaves in the order of the columns ``order``, their
    digests in the column ``digest``. All columns of ``rows`` travel with the leaves, so give only what is needed."""
    if arity < 2:
        raise ValueError("a tree's nodes need two children or more")
    leaves = numbered(rows.withColumn("tree", tree_key(group)), order, f"{name}-leaves")
    trees = forest(leaves.select("tree", "idx", "n", F.col(digest).alias("digest")), arity, f"{name}-level")
    roots = trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("_tree"), "digest")
    top = forest(numbered(roots, ["_tree"], f"{name}-roots"), arity, f"{name}-top")
    return Manifest(leaves, trees, top)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def verify(docs: DataFrame, tampered: Column, arity: int = ARITY) -> DataFrame:
    """Builds the manifest of ``docs`` and checks every row's proof against its root, for the rows where ``tampered``
    holds with the text's A-Z in lower case: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    now = F.when(tampered, leaf_digest({"text": lowered(F.col("text"))})).otherwise(F.col("leaf"))
    rows = docs.select(*FIELDS).withColumn("leaf", leaf_digest()).withColumn("now", now).select("doc_id", "source", "leaf", "now")
    manifest = build(rows, F.col("source"), ["doc_id", "leaf"], "leaf", arity)
    return (manifest.with_proofs()
            .select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), folded("now").alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
