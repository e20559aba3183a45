"""A Merkle manifest of a dataset as a content-addressed graph, and proofs by descending it.

Every row is a leaf, a digest of its fields. Per source the leaves are ordered by id, and every
``FAN`` neighbours become the digest of their digests until one node, the subroot, is left; the subroots
become the root in the same way. What is stored is, level by level, records from a digest to
the digests of its children.

A proof starts at the root. The digits of a leaf's rank in base ``FAN`` say which child to follow; the
children not followed are the siblings of that level. Leaves that share a prefix of their digits
share that part of the way, so the levels above the lowest hold half as many rows as there are
leaves, and each level is one join of digests with records. A request meets the node above
its leaf and takes the last digit itself. Reversed, the segments of the way are the proof.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.joins import repeated
from docloom.workspace import broadcast_if_small, stage

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33

_SEGMENT = "before binary, after binary"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one behind the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(text: Column) -> Column:
    """Digest of a row, with ``text`` in place of its text."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        )

    return digest(*(field(text if name == "text" else F.col(name)) for name in FIELDS))


def tree_of(source: Column) -> Column:
    """Name of a source's tree; the order of names is that of sources, null first."""
    return F.coalesce(F.concat(F.lit("+"), source), F.lit(""))


class Manifest(NamedTuple):
    """Levels of records (tree, at, digest, children, nodes), lowest first, and what they stand on.

    ``leaves`` holds (tree, at, digest, nodes) with the columns that came with each leaf;
    ``nodes`` is the number of nodes of the tree on a level, so 1 marks the top of a tree.
    """

    leaves: DataFrame
    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """(tree, height, digest) of every tree."""
        rows = self.leaves.filter("nodes = 1").select("tree", F.lit(0).alias("height"), "digest")
        for height, level in enumerate(self.levels, 1):
            rows = rows.union(level.filter("nodes = 1").select("tree", F.lit(height), "digest"))
        return rows

    def records(self, height: int) -> DataFrame:
        """Digest to children on one level, equal subtrees once."""
        return self.levels[height - 1].select("digest", "children").dropDuplicates(["digest"])


def grown(leaves: DataFrame) -> Manifest:
    """Records of all trees over the numbered ``leaves`` (tree, at, digest, nodes, ...)."""
    most = leaves.agg(F.max("nodes")).first()[0] or 1
    levels, below = [], leaves
    while most > 1:
        parents = (
            below.filter("nodes > 1")
            .groupBy("tree", F.expr(f"at div {FAN}").alias("up"))
            .agg(
                F.sort_array(F.collect_list(F.struct("at", "digest")))["digest"].alias("children"),
                F.first("nodes").alias("nodes"),
            )
            .select(
                "tree",
                F.col("up").alias("at"),
                F.sha2(F.array_join("children", ""), 256).alias("digest"),
                "children",
                F.expr(f"(nodes + {FAN - 1}) div {FAN}").alias("nodes"),
            )
        )
        below = stage(parents, "records")
        levels.append(below)
        most = -(-most // FAN)
    return Manifest(leaves, levels)


def _segment(children: Column, digit: Column) -> Column:
    """The children not followed, left and right of the one that is."""

    def joined(some: Column) -> Column:
        return F.unhex(F.array_join(some, ""))

    return F.struct(
        joined(F.slice(children, F.lit(1), digit)).alias("before"),
        joined(F.slice(children, digit + 2, F.lit(FAN))).alias("after"),
    )


def descended(manifest: Manifest, starts: DataFrame, last: int = 0) -> DataFrame:
    """(tree, at, digest, subroot, way) of every node of the trees on level ``last``.

    ``starts`` are tops (tree, height, digest, subroot, way) with the segments that lead to them.
    """
    columns = ["tree", "at", "digest", "subroot", "way"]
    state = None
    for height in range(len(manifest.levels), last - 1, -1):
        tops = starts.filter(F.col("height") == height).withColumn("at", F.lit(0).cast("long")).select(*columns)
        state = tops if state is None else state.union(tops)
        if height > last:
            state = (
                state.join(manifest.records(height), "digest")
                .select("tree", "at", "subroot", "way", "children", F.posexplode("children").alias("digit", "child"))
                .select(
                    "tree",
                    (F.col("at") * FAN + F.col("digit")).alias("at"),
                    F.col("child").alias("digest"),
                    "subroot",
                    F.concat("way", F.array(_segment(F.col("children"), F.col("digit")))).alias("way"),
                )
            )
    return state


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ..., copies) once for every copy, with their place in the tree and its size.

    Rows are range partitioned along tree and ``order``; the copies of each range and tree are added up
    along the tree, so no task sees a whole tree. Copies of one row are dealt out in pieces.
    """
    place = F.monotonically_increasing_id()
    placed = stage(
        rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("place", place),
        "placed",
    ).withColumn("range", F.shiftright("place", _ROW_BITS))
    sums = placed.groupBy("tree", "range").agg(F.sum("copies").alias("n"))
    along = Window.partitionBy("tree").orderBy("range")
    starts = stage(
        sums.select(
            "tree",
            "range",
            (F.sum("n").over(along) - F.col("n")).alias("base"),
            F.sum("n").over(Window.partitionBy("tree")).alias("nodes"),
        ),
        "starts",
    )
    inside = Window.partitionBy("range", "tree").orderBy("place")
    first = placed.withColumn("within", F.sum("copies").over(inside) - F.col("copies")).join(
        broadcast_if_small(starts), ["tree", "range"]
    )
    first = first.withColumn("at", F.col("base") + F.col("within")).drop("base", "within", "place", "range")
    names = [name for name in first.columns if name not in ("at", "copies")]
    return repeated(first, "copies", "copy").select((F.col("at") + F.col("copy")).alias("at"), *names)


def manifest(docs: DataFrame, **more: Column) -> Manifest:
    """The manifest of all rows of ``docs``, with ``more`` columns of each row beside its leaf.

    Null fields count as such, a null source is a source, and null ids come first. Rows that
    repeat are leaves of their own; rows of one id are ordered by their digests. Texts of any
    length are one field. Columns other than ``FIELDS`` are ignored.
    """
    columns = [leaf(F.col("text")).alias("digest"), *(column.alias(name) for name, column in more.items())]
    rows = docs.select(tree_of(F.col("source")).alias("tree"), "doc_id", *columns)
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    return grown(stage(numbered(copies, ["doc_id", "digest"]), "leaves"))


def over(tops: DataFrame) -> Manifest:
    """The manifest of the subroots (tree, height, digest), ordered by their trees."""
    rows = tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("of"), "height", "digest", F.lit(1).cast("long").alias("copies")
    )
    return grown(stage(numbered(rows, ["of"]), "subroots"))


def proofs(trees: Manifest) -> DataFrame:
    """The leaves of ``trees`` with subroot, root and proof.

    ``proof`` lists, from the leaf to the root, the siblings of each level as raw digests left and right of the
    node; a run of one has none. An empty manifest has no rows.
    """
    above = over(stage(trees.tops(), "tops"))
    empty = F.array().cast(f"array<struct<{_SEGMENT}>>")
    top = above.tops().select("tree", "height", "digest", F.col("digest").alias("subroot"), empty.alias("way"))
    # ``subroot`` of the upper manifest is the root
    reached = descended(above, top).select("at", F.col("subroot").alias("root"), "way")
    named = above.leaves.select("at", F.col("of").alias("tree"), "height", "digest")
    starts = stage(
        named.join(reached, "at").select("tree", "height", "digest", F.struct("digest", "root").alias("subroot"), "way"),
        "starts",
    )
    if trees.levels:
        parents = descended(trees, starts, last=1).join(trees.records(1), "digest")
        parents = parents.select("tree", F.col("at").alias("up"), "subroot", "way", "children")
    else:
        parents = starts.limit(0).select("tree", F.lit(0).cast("long").alias("up"), "subroot", "way", F.array(F.lit("")).alias("children"))
    # a tree of one leaf ends at its top
    lone = starts.filter("height = 0").select(
        "tree", F.lit(0).cast("long").alias("up"), "subroot", "way", F.array("digest").alias("children")
    )
    digit = F.pmod("at", F.lit(FAN)).cast("int")
    way = F.when(F.col("nodes") > 1, F.concat("way", F.array(_segment(F.col("children"), digit)))).otherwise(F.col("way"))
    requests = trees.leaves.withColumn("up", F.expr(f"at div {FAN}"))
    return requests.join(parents.union(lone), ["tree", "up"]).select(
        *trees.leaves.columns,
        F.element_at("children", digit + 1).alias("found"),
        F.col("subroot.digest").alias("subroot"),
        F.col("subroot.root").alias("root"),
        F.reverse(way).alias("proof"),
    )


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""

    def text(raw: Column) -> Column:
        return F.lower(F.hex(raw))

    return F.aggregate(proof, start, lambda node, level: digest(text(level["before"]), node, text(level["after"])))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level and left to right."""
    levels = F.transform(proof, lambda level: F.concat(F.hex(level["before"]), F.hex(level["after"])))
    return F.sha2(F.lower(F.array_join(levels, "")), 256)


def tampered(docs: DataFrame) -> Column:
    """Leaf of a row after a tampering that deletes line ends, in half of the rows."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return leaf(F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text")))


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, and the root folded from the tampered leaf, for every row."""
    found = proofs(manifest(docs, forged=tampered(docs)))
    root = folded(F.col("forged"), F.col("proof"))
    return found.select(
        "doc_id",
        F.col("found").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
