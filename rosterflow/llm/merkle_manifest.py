"""Merkle manifest of a dataset: a tree per group of rows, the group roots in a tree of their own.

Rows are numbered by a distributed sort and cut into aligned blocks, so that a
task holds one block whatever the size of a group.  The tree is persistent: a
tampered leaf makes a version that copies only its ancestors and shares every
other node, by reference.  A block's task has the block's own nodes and, above
them, the path to the root, whose siblings upper blocks hand down as digests.
Every row's proof is folded to a root; a version must end in the same one.  No
version ever meets another one, and no task sees more than one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterflow.llm.common import pack_batch, register, table, unpack_batch
from rosterflow.llm.quality_rules import crc32_sql
from rosterflow.session import scratch, settle

# A block is 2 ** HEIGHT aligned nodes.
HEIGHT = 10
ROWS_PER_PART = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LEFT, RIGHT, ALONE = "<", ">", ""


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """A field as a leaf has it: its length in bytes, a colon and the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


class Node:
    """A node of a persistent tree.  It is never changed once it is made, so versions of the tree share it."""

    __slots__ = ("digest", "left", "right")

    def __init__(self, digest: str, left: Node | None = None, right: Node | None = None):
        self.digest, self.left, self.right = digest, left, right


def over(left: Node, right: Node | None) -> Node:
    """The parent of two nodes, or of a lone one."""
    return Node(digest(left.digest + right.digest if right else left.digest), left, right)


class Block:
    """A version of an aligned block: its nodes from the top down, and how many levels it has."""

    def __init__(self, digests: list[str], height: int):
        self.height, nodes = height, [Node(d) for d in digests]
        for _ in range(height):
            nodes = [over(nodes[i], nodes[i + 1] if i + 1 < len(nodes) else None) for i in range(0, len(nodes), 2)]
        self.root = nodes[0]

    @property
    def top(self) -> str:
        return self.root.digest

    def turns(self, at: int) -> list[bool]:
        """The way from the top to a leaf: whether it goes right, level by level."""
        return [bool(at >> level & 1) for level in reversed(range(self.height))]

    def siblings(self, at: int) -> list[str]:
        """What stands beside the path from a leaf to the top: side and digest, or nothing."""
        return beside(self.root, self.turns(at))


def beside(root: Node, turns: Sequence[bool]) -> list[str]:
    """Side and digest of the siblings along a path, from its leaf to the root; nothing where a node is alone."""
    out, node = [], root
    for right in turns:
        other = node.left if right else node.right
        out.append(ALONE if other is None else (LEFT if right else RIGHT) + other.digest)
        node = node.right if right else node.left
    return out[::-1]


def grown(top: Node, above: Sequence[str]) -> Node:
    """The root over a block's top; what stands beside the way up is nodes that are known by their digests alone."""
    for mark in above:
        other = Node(mark[1:]) if mark else None
        top = over(other, top) if mark[:1] == LEFT else over(top, other)
    return top


def replaced(root: Node, turns: Sequence[bool], leaf: str) -> Node:
    """The root of a version with another leaf at the end of ``turns``: its ancestors are copied, all other nodes shared."""
    passed, node = [], root
    for right in turns:
        passed.append((node, right))
        node = node.right if right else node.left
    copy = Node(leaf)
    for node, right in reversed(passed):
        copy = over(node.left, copy) if right else over(copy, node.right)
    return copy


def path_digests(root: Node, turns: Sequence[bool]) -> list[str]:
    """The nodes on a path, from the leaf's parent to the root."""
    out, node = [], root
    for right in turns:
        out.append(node.digest)
        node = node.right if right else node.left
    return out[::-1]


def folded(leaf: str, siblings: Sequence[str]) -> str:
    """The root that a proof leads to from a leaf."""
    for mark in siblings:
        leaf = digest(mark[1:] + leaf if mark[:1] == LEFT else leaf + mark[1:])
    return leaf


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` (settled) with ``pos``, their place in their tree from 0 on, and ``n``, the tree's size; nulls come first.

    A distributed sort numbers the rows of each part; the counts of parts before it are added.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_PER_PART + 1)
    laid = rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    # The upper bits of the id are the part, the lower ones count its rows.
    laid = settle(laid.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "laid")
    counts = laid.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = settle(counts.select(tree, "_part", F.col("_first"), before.alias("_before"), F.sum("_rows").over(whole).alias("n")), "counts")
    return laid.join(counts, [tree, "_part"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def height_of(n: int) -> int:
    """Levels that a block of a tree with ``n`` nodes rises: to the root if one block holds them all."""
    return min(HEIGHT, (n - 1).bit_length())


_STEP = "tree long, pos long, n long, digest string, siblings array<string>"
_STEP_FIELDS = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("siblings", pa.list_(pa.string()))])


def _by_place(group: pa.Table) -> pa.Table:
    return group.sort_by("pos")


def _rise(group: pa.Table) -> pa.Table:
    """A row per node with its siblings in the block, and one with the block's top for the next step (no siblings)."""
    group = _by_place(group)
    tree, n = group.column("tree")[0].as_py(), group.column("n")[0].as_py()
    block = Block(group.column("digest").to_pylist(), height_of(n))
    place = group.column("pos").to_pylist()
    size = len(place)
    return pa.table(
        [
            [tree] * (size + 1), [*place, place[0] >> HEIGHT], [n] * size + [-(-n // (1 << HEIGHT))],
            [None] * size + [block.top], [block.siblings(i) for i in range(size)] + [None],
        ],
        schema=_STEP_FIELDS,
    )


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From settled ``tree, pos, n, digest``: ``tree, pos, siblings`` up to the root of every node, and ``tree, digest`` of the roots."""
    paths = nodes.select("tree", "pos", F.col("pos").alias("_at"), F.array().cast("array<string>").alias("siblings"))
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        step = settle(nodes.groupBy("tree", F.shiftright("pos", HEIGHT).alias("block")).applyInArrow(lambda g: _rise(g), _STEP), "step")
        beside = step.where("digest is null").select("tree", F.col("pos").alias("_at"), F.col("siblings").alias("_more"))
        paths = paths.join(beside, ["tree", "_at"]).select(
            "tree", "pos", F.shiftright("_at", HEIGHT).alias("_at"), F.concat("siblings", "_more").alias("siblings")
        )
        nodes = step.where("digest is not null").select("tree", "pos", "n", "digest")
    return paths.drop("_at"), nodes.select("tree", "digest")


def _packed(group: pa.Table) -> pa.Table:
    """A block of leaves as one row, with its top."""
    group = _by_place(group)
    n = group.column("n")[0].as_py()
    leaves = [x.hex() for x in group.column("leaf").to_pylist()]
    batch = group.select(["key", "leaf", "changed"]).combine_chunks().to_batches()[0]
    return pa.table(
        {
            "tree": pa.array([group.column("tree")[0].as_py()], pa.int64()), "pos": pa.array([group.column("pos")[0].as_py() >> HEIGHT], pa.int64()),
            "height": pa.array([height_of(n)], pa.int32()), "n": pa.array([-(-n // (1 << HEIGHT))], pa.int64()),
            "digest": pa.array([Block(leaves, height_of(n)).top], pa.string()), "leaves": pa.array([pack_batch(batch)], pa.binary()),
        }
    )


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
    changes: dict[str, Column] | None = None, where: Column | None = None, copies: bool = False,
) -> DataFrame:
    """A row per row of ``docs``: ``key, leaf, subroot, root, siblings, folded_root``.

    A leaf is the SHA-256 of its fields, each as byte count, colon and value, or a
    dash for null.  The leaves of each value of ``group`` ascend by ``key``; every
    two nodes of a level make one of the next (a last single node is hashed alone)
    until one is left, the ``subroot``.  The subroots, by group, make ``root`` likewise.
    ``siblings`` holds one item per level from the leaf to the root: ``<`` or ``>`` and
    the digest of the node on that side, or an empty text where there is none.

    ``changes`` (column to new value) tamper with the rows that meet ``where``, each
    in a version of its own.  ``folded_root`` is what every row's siblings lead to, from
    the changed leaf (then it is that version's root) or else from the row's own.  With ``copies`` a column ``copied`` holds the nodes
    that the version has copied, from the leaf's parent up to its root (null for the
    other rows); all its other nodes are those of the tree.

    Null groups and null keys are a group and keys like others and come first.  Rows
    with equal keys follow each other by leaf; rows equal in everything stay apart.
    Other columns play no part.  Texts of any length are hashed whole.  Without rows
    there are none.
    """
    kind = docs.schema[key].dataType
    values = [F.col(f) for f in fields]
    leaf = F.unhex(leaf_digest(values))
    altered = F.unhex(leaf_digest([(changes or {}).get(f, v) for f, v in zip(fields, values)])) if changes else F.lit(None).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"), F.col(group).alias("group"), leaf.alias("leaf"),
        F.when(F.coalesce(where, F.lit(False)), altered).alias("changed") if where is not None else altered.alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    names = "key", "leaf", "siblings", "folded_root", "copied"
    output = f"key {kind.simpleString()}, leaf string, tree_root string, siblings array<string>, folded_root string, copied array<string>"

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for height, blob, above, subroot in zip(*[batch.column(c).to_pylist() for c in ("height", "leaves", "above", "subroot")]):
                rows = unpack_batch(blob)
                leaves = [x.hex() for x in rows.column("leaf").to_pylist()]
                block, proofs, ends, made = Block(leaves, height), [], [], []
                whole, down = grown(block.root, above), [mark[:1] == LEFT for mark in reversed(above)]
                for at, changed in enumerate(rows.column("changed").to_pylist()):
                    turns = down + block.turns(at)
                    proofs.append(beside(whole, turns))
                    ends.append(folded(leaves[at] if changed is None else changed.hex(), proofs[-1]))
                    version = None if changed is None else replaced(whole, turns, changed.hex())
                    if version is not None and version.digest != ends[-1]:
                        raise AssertionError(f"the version of leaf {at} and its proof have different roots")
                    made.append(path_digests(version, turns) if version is not None and copies else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("key").combine_chunks(), pa.array(leaves, pa.string()), pa.array([subroot] * len(leaves), pa.string()),
                        pa.array(proofs, pa.list_(pa.string())), pa.array(ends, pa.string()), pa.array(made, pa.list_(pa.string())),
                    ],
                    [names[0], names[1], "tree_root", *names[2:]],
                )

    with scratch():
        rows = settle(rows, "leaves")
        trees = settle(rows.select("group").distinct().withColumn("one", F.lit(0).cast("long")), "groups")
        trees = settle(numbered(trees, "one", ["group"]).select("group", F.col("pos").alias("tree")), "trees")
        rows = settle(rows.join(trees, rows["group"].eqNullSafe(trees["group"])).drop(trees["group"]).drop("group"), "leaves-of-trees")
        placed = numbered(rows, "tree", ["key", "leaf", "row"])
        blocks = settle(
            placed.groupBy("tree", F.shiftright("pos", HEIGHT).alias("block")).applyInArrow(
                lambda g: _packed(g), "tree long, pos long, height int, n long, digest string, leaves binary"
            ), "blocks", outlives=True,
        )
        above, subroots = climb(blocks.select("tree", "pos", "n", "digest"))
        subroots = settle(subroots, "subroots")
        forest = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(subroots.count()).cast("long").alias("n"), "digest")
        over, top = climb(forest)
        root = next((r["digest"] for r in top.collect()), None)
        over = over.select(F.col("pos").alias("tree"), F.col("siblings").alias("_over")).join(subroots, "tree")
        handed = above.join(over, "tree").select("tree", "pos", F.concat("siblings", "_over").alias("above"), F.col("digest").alias("subroot"))
        handed = settle(handed, "handed-down", outlives=True)
    whole = blocks.drop("n", "digest").join(handed, ["tree", "pos"])
    found = whole.mapInArrow(finish, output)
    top = F.lit(root)
    return found.select(
        F.col("key").alias(key), "leaf", F.col("tree_root").alias("subroot"), top.alias("root"), "siblings",
        "folded_root", *(["copied"] if copies else []),
    )


def proof_digest(siblings: str) -> Column:
    """SHA-256 of the siblings' digests from leaf to root."""
    return F.sha2(F.concat_ws("", F.transform(siblings, lambda x: F.substring(x, 2, 64))), 256)


def plus_one(column: str) -> Column:
    """One more, as text and without overflow; null stays null."""
    return (F.col(column).cast("decimal(20,0)") + 1).cast("string")


def tampered_rows(key: str, modulus: int = 7) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus)) == 0


def _leaf_sql(n_chars: str) -> str:
    parts = [f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


def _tree_sql(name: str, start: str) -> str:
    """A recursive table of all nodes from ``start (tree, pos, h, n)``, with each node's sibling."""
    return f"""{name}0 AS (
  SELECT 0 AS level, tree, pos, h, n FROM ({start})
  UNION ALL
  SELECT level + 1, tree, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM {name}0 WHERE n > 1 GROUP BY level, tree, pos // 2),
{name} AS (SELECT a.*, b.h AS beside, b.pos < a.pos AS lefthand FROM {name}0 a LEFT JOIN {name}0 b ON a.level = b.level AND a.tree = b.tree AND b.pos = xor(a.pos, 1))"""


SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf, {crc32_sql('doc_id', 7, 0)} AS hit, {_leaf_sql('n_chars + 1')} AS other FROM documents),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM l)),
p AS (SELECT l.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
      FROM l JOIN langs ON l.lang IS NOT DISTINCT FROM langs.lang),
{_tree_sql('t', 'SELECT tree, pos, leaf AS h, n FROM p')},
s AS (SELECT tree, h AS subroot FROM t WHERE n = 1),
{_tree_sql('f', 'SELECT 0 AS tree, tree AS pos, subroot AS h, (SELECT count(*) FROM s) AS n FROM s')},
r AS (SELECT h AS root FROM f WHERE n = 1),
steps AS (
  SELECT doc_id, level, beside, lefthand FROM p JOIN t ON t.tree = p.tree AND t.pos = p.pos >> t.level AND t.n > 1
  UNION ALL
  SELECT doc_id, 1000 + level, beside, lefthand FROM p JOIN f ON f.pos = p.tree >> f.level AND f.n > 1),
proof AS (SELECT doc_id, string_agg(beside, '' ORDER BY level) AS joined,
                 list(CASE WHEN beside IS NULL THEN '' WHEN lefthand THEN '<' || beside ELSE '>' || beside END ORDER BY level) AS marks FROM steps GROUP BY doc_id),
out AS (SELECT p.doc_id, leaf, subroot, root, sha256(coalesce(joined, '')) AS proof_sha256,
               list_reduce([CASE WHEN hit THEN other ELSE leaf END] || coalesce(marks, []),
                           lambda h, m: sha256(CASE WHEN m[1] = '<' THEN m[2:] || h ELSE h || m[2:] END)) AS folded_root
        FROM p JOIN s USING (tree) CROSS JOIN r LEFT JOIN proof USING (doc_id))
SELECT *, folded_root = root AS verified FROM out"""


@register("op12_merkle", SQL)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and roots; where 7 divides the id's crc32, one is added to ``n_chars``."""
    docs = table(spark, sf_dir, "documents")
    rows = manifest(docs, changes={"n_chars": plus_one("n_chars")}, where=tampered_rows("doc_id"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest("siblings").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
