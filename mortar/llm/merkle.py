"""Merkle manifest of a dataset: a tree of digests for each language and one over their roots.

Levels are built bottom-up, eight nodes a run, and stored as rows that name their parent and hold
the digests of their run. A recursive query then climbs from every leaf at once: each step joins
a leaf's path with the stored run above it, appends that run's other digests and folds the
leaf's digest into the parent's. High runs stand above very many leaves, so they are stored once
for each block of leaves below, and no step's join gathers more than a block on one key.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rank import global_row_number, prefix_scan
from .common import ascii_lower, write_scratch

#: Nodes in a run.
ARITY = 8
#: Leaves that may meet on one key of the climb.
BLOCK = 4096
#: Levels of the upper tree are numbered from here on; node numbers are (level, place) in one long.
TOP, SHIFT = 64, 56
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def run_digest(digests: Column) -> Column:
    """Of a run's digests side by side, which are hashed as hex text."""
    return F.unhex(F.sha2(hex_text(digests), 256))


def node(level: Column, place: Column) -> Column:
    return F.call_function("shiftleft", level.cast("long"), F.lit(SHIFT)) + place


def tampered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, its A-Z lower-cased where 3 divides the CRC-32 of the decimal id."""
    hit = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, ascii_lower(F.col(f"`{text_col}`"))).otherwise(F.col(f"`{text_col}`"))


def leaf_rows(docs: DataFrame, columns: Sequence[str], order_col: str, tree_col: str, candidate: dict[str, Column]) -> DataFrame:
    """(id, tree, leaf, candidate): digests of the rows, and of the rows with some columns replaced."""
    value = lambda c: F.col(f"`{c}`")
    tree = F.when(value(tree_col).isNull(), "-").otherwise(F.concat(F.lit("="), value(tree_col).cast("string")))
    return docs.select(
        value(order_col).alias("id"),
        tree.alias("tree"),  # in the order of the values, null first
        leaf_digest([value(c) for c in columns]).alias("leaf"),
        leaf_digest([candidate.get(c, value(c)) for c in columns]).alias("candidate"),
    )


def climb_levels(nodes: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Runs upon runs until a tree has one node: (keys, level, idx, n, digest, kids).

    ``nodes`` has (keys, idx, n, digest), n the nodes of the tree; ``most`` is the largest n.
    A run holds eight digests at most, so what a group collects is bounded.
    """
    levels, level, below = None, 0, nodes
    while most > 1:
        level, most = level + 1, -(-most // ARITY)
        kid = F.struct(F.col("idx").alias("i"), F.col("digest").alias("d"))
        runs = below.where("n > 1").groupBy(*keys, F.expr(f"idx div {ARITY}").alias("idx")).agg(
            F.max(F.expr(f"(n + {ARITY - 1}) div {ARITY}")).alias("n"), F.array_sort(F.collect_list(kid)).alias("kids")
        )
        kids = F.aggregate("kids", F.lit(b""), lambda a, x: F.concat(a, x["d"]))
        built = runs.select(*keys, F.lit(level).alias("level"), "idx", "n", kids.alias("kids"))
        built = write_scratch(built.withColumn("digest", run_digest(F.col("kids"))), "merkle-level")
        levels = built if levels is None else levels.unionByName(built)
        below = built.drop("level", "kids")
    return levels


def parent_of(trees: int) -> tuple[Column, Column]:
    """(parent, place in its run) of a node by (level, idx, n, t); the one of a tree's last level goes on in the upper tree."""
    inner, outer = F.col("n") > 1, F.lit(trees > 1)
    up, top = node(F.col("level") + 1, F.expr(f"idx div {ARITY}")), node(F.lit(TOP + 1), F.expr(f"t div {ARITY}"))
    place = F.when(inner, F.expr(f"idx % {ARITY}")).when(outer, F.expr(f"t % {ARITY}"))
    return F.when(inner, up).when(outer, top), place.cast("int")


@dataclasses.dataclass
class Manifest:
    """``leaves``: (id, tree, idx, leaf, candidate, block, node, place); ``runs``: (tree, block, node, parent, place, kids);
    ``subroots``: (tree, subroot); ``root``: binary, None for an empty table."""

    leaves: DataFrame
    runs: DataFrame | None
    subroots: DataFrame
    root: bytes | None


def build(rows: DataFrame) -> Manifest:
    """Number the leaves of each tree, build all levels and store the runs by what stands below them."""
    numbered = prefix_scan(rows, ["tree"], [F.col("id").asc_nulls_first(), "leaf"], row_number="rn").withColumn("idx", F.col("rn") - 1)
    numbered = write_scratch(numbered.drop("rn"), "merkle-leaves")
    counts = numbered.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    trees = write_scratch(global_row_number(counts, ["tree"], "t").withColumn("t", F.col("t") - 1), "merkle-trees")
    n_trees, most = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    # trees are few beside leaves; Spark broadcasts them if they are small, and else splits a hot one
    leaves = numbered.join(trees, "tree").withColumn("level", F.lit(0)).withColumn("block", F.expr(f"idx div {BLOCK}"))
    levels = climb_levels(leaves.select("tree", "idx", "n", F.col("leaf").alias("digest")), ["tree"], most or 0)

    tops = leaves.where("n = 1").select("tree", F.col("leaf").alias("digest"))
    if levels is not None:
        tops = tops.unionByName(levels.where("n = 1").select("tree", "digest"))
    subroots = write_scratch(tops.join(trees, "tree"), "merkle-subroots")
    upper = climb_levels(subroots.select(F.col("t").alias("idx"), F.lit(n_trees).cast("long").alias("n"), "digest"), [], n_trees)
    if upper is not None:
        root = upper.where("n = 1").first()["digest"]
    else:
        root = next((r["digest"] for r in subroots.take(1)), None)

    parent, place = parent_of(n_trees)
    anchors = leaves.select("id", "tree", "idx", "leaf", "candidate", "block", parent.alias("node"), place.alias("place"))
    runs = []
    if levels is not None:
        wide = F.expr(f"cast(power({ARITY}, level) as bigint)")
        low = F.floor(F.col("idx") * wide / BLOCK)
        high = F.floor((F.least((F.col("idx") + 1) * wide, F.col("leaves")) - 1) / BLOCK)
        blocks = F.explode(F.sequence(low.cast("long"), high.cast("long")))
        inner = levels.join(trees.select("tree", F.col("n").alias("leaves"), "t"), "tree")
        runs.append(inner.select("tree", blocks.alias("block"), node(F.col("level"), F.col("idx")).alias("node"), parent.alias("parent"), place.alias("place"), "kids"))
    if upper is not None:
        # each tree's way up, once for each block of its leaves
        depth = F.explode(F.sequence(F.lit(1), F.lit(depth_of(n_trees))))
        ways = subroots.select("tree", "t", F.col("n").alias("leaves"), depth.alias("level"))
        ways = ways.withColumn("idx", F.floor(F.col("t") / F.expr(f"power({ARITY}, level)")).cast("long"))
        up, inner_top = node(F.col("level") + TOP + 1, F.expr(f"idx div {ARITY}")), F.col("n") > 1
        met = ways.join(upper.drop("digest"), ["level", "idx"])
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("leaves") - 1) / BLOCK).cast("long")))
        runs.append(
            met.select(
                "tree", each.alias("block"), node(F.col("level") + TOP, F.col("idx")).alias("node"),
                F.when(inner_top, up).alias("parent"), F.when(inner_top, F.expr(f"idx % {ARITY}")).cast("int").alias("place"), "kids",
            )
        )
    stored = write_scratch(functools.reduce(DataFrame.unionByName, runs), "merkle-runs") if runs else None
    return Manifest(anchors, stored, subroots.select("tree", F.col("digest").alias("subroot")), root and bytes(root))


def depth_of(n: int) -> int:
    levels = 0
    while n > 1:
        levels, n = levels + 1, -(-n // ARITY)
    return levels


CLIMB = f"""
with recursive climb (tree, block, idx, id, leaf, step, node, place, folded, beside) as (
  select tree, block, idx, id, leaf, 0, node, place, candidate, cast(null as binary) from {{anchors}}
  union all
  select tree, block, idx, cast(null as {{kind}}), cast(null as binary), step + 1, parent, above,
         unhex(sha2(lower(hex(concat(before, folded, behind))), 256)), concat(before, behind)
  from (
    select c.tree, c.block, c.idx, c.step, c.folded, r.parent, r.place as above,
           substring(r.kids, 1, c.place * 32) as before, substring(r.kids, c.place * 32 + 33, {ARITY * 32}) as behind
    from climb c join {{runs}} r on c.tree = r.tree and c.block = r.block and c.node = r.node
  )
)
select * from climb
"""


def climb(manifest: Manifest) -> DataFrame:
    """(tree, idx, id, leaf, folded, proof): every leaf's candidate folded up to the root, and its siblings on the way.

    The recursion returns a row for each leaf and step, with that step's siblings alone; they
    are put together in the end, a row for each level, so no step carries what others appended.
    """
    spark = manifest.leaves.sparkSession
    if manifest.runs is None:
        return manifest.leaves.select("tree", "idx", "id", "leaf", F.col("candidate").alias("folded"), F.lit("").alias("proof"))
    # Spark stops a recursion at a million rows unless told otherwise; it is run here, under that setting
    rows_conf, before = "spark.sql.cteRecursionRowLimit", spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set(rows_conf, "-1")
    try:
        kind = manifest.leaves.schema["id"].dataType.simpleString()
        steps = spark.sql(CLIMB.replace("{kind}", kind), anchors=manifest.leaves, runs=manifest.runs)
        step = F.struct("step", "beside", "folded", "id", "leaf")
        paths = steps.groupBy("tree", "idx").agg(F.array_sort(F.collect_list(step)).alias("steps"))
        first, last = F.get("steps", F.lit(0)), F.element_at("steps", -1)
        siblings = F.aggregate("steps", F.lit(b""), lambda a, x: F.concat(a, F.coalesce(x["beside"], F.lit(b""))))
        return write_scratch(
            paths.select("tree", "idx", first["id"].alias("id"), first["leaf"].alias("leaf"), last["folded"].alias("folded"), hex_text(siblings).alias("proof")),
            "merkle-climb",
        )
    finally:
        spark.conf.set(rows_conf, before)


def verify_rows(
    docs: DataFrame,
    candidate: dict[str, Column],
    columns: Sequence[str] = LEAF_COLUMNS,
    id_col: str = "doc_id",
    tree_col: str = "lang",
) -> DataFrame:
    """Build the manifest of ``docs`` and check each row, with ``candidate`` columns in place of its own, against it.

    Returns (id_col, leaf, subroot, root, proof_sha256, folded_root, verified), digests as
    lowercase hex. Defined results: a null in any column is hashed as ``-``; null ids come
    first in their tree and rows that share an id are ordered by digest, so the root doesn't
    depend on the order of the input; a null language is a tree of its own and comes first; a
    tree of one leaf has the leaf as its root, and a table of one row proves itself with no
    siblings; an empty table gives an empty result; columns that aren't named are not hashed.
    """
    manifest = build(leaf_rows(docs, columns, id_col, tree_col, candidate))
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    found = climb(manifest).join(manifest.subroots, "tree")
    return found.select(
        F.col("id").alias(id_col),
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2("proof", 256).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"),
        (hex_text(F.col("folded")) == root).alias("verified"),
    )
