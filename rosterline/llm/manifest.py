"""A Merkle manifest of a table: one tree per group of rows, one tree over the groups' roots.

H is the lower-case hex SHA-256 of its inputs put together, digests as hex text. A leaf is
H of a row's columns, each ``-`` if NULL, else its UTF-8 byte count, ``:`` and its value.
The leaves of a group ascend by id; while several nodes remain, every two consecutive ones
become their H, a last one alone too. Roots of groups, the NULL group first, then by UTF-8
bytes, become the table's root in the same way.

Trees are cut into *aligned blocks* of 2^10 leaves, so a block is a whole subtree whatever
stands beside it. A block is one stored row; one job builds all blocks of a round and leaves
their roots as the leaves of the next, until each group has one node. On the way down every
block adds its siblings to the path that its own root has further up.

Each tampered leaf makes a *version* of the tree: it copies only the ancestors of that leaf
inside its block and shares every other node of the block; the version then goes on above the
block along the stored upper path, on whatever task holds the block. A version of an
untouched leaf copies nothing that differs.

Only digests, ids and numbers are shuffled; texts are read once and never leave their scan.

Defined cases: NULL columns, also a NULL id, are leaves like any others (a NULL id stands
first); equal ids go by leaf digest; fully repeated rows are leaves of their own, equal ones
in any order; an empty table gives an empty table; a group of one leaf has it as its root
and a table of one leaf is its own proof of nothing; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterline.workspace import sized, stored

BLOCK_BITS = 10
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
_NODES = "STRUCT<position: BIGINT, digest: STRING, tampered: STRING, id: {id}>"


def field(value: Column) -> Column:
    """One column of a leaf."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def joined_hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class BlockTree:
    """The subtree over the leaves of one block, with cheap versions of it.

    ``height`` is the number of levels above the leaves that the whole tree has here: a
    block that stands beside others goes up to its full height even if it is not full.
    """

    def __init__(self, leaves: list[str], height: int):
        self.levels = [leaves]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([joined_hash(below[i:i + 2]) for i in range(0, len(below), 2)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[bool, str | None]]:
        """From the leaf up: whether the sibling stands left, and its digest (None: it has none)."""
        path = []
        for level in self.levels[:-1]:
            other = at ^ 1
            path.append((bool(at & 1), level[other] if other < len(level) else None))
            at >>= 1
        return path

    def version(self, at: int, digest: str) -> list[str]:
        """The copied nodes, from the new leaf to the new root of the block; all others are shared."""
        return continued(digest, self.siblings(at))


def continued(digest: str, path: list[tuple[bool, str | None]]) -> list[str]:
    """The nodes of a version along a path of siblings, its starting node first."""
    copies = [digest]
    for left, sibling in path:
        pair = [digest] if sibling is None else [sibling, digest] if left else [digest, sibling]
        digest = joined_hash(pair)
        copies.append(digest)
    return copies


def written(path: list[tuple[bool, str | None]]) -> list[str]:
    """A path as strings: ``L`` or ``R`` and the digest; only ``-`` where a node stands alone."""
    return ["-" if sibling is None else ("L" if left else "R") + sibling for left, sibling in path]


def read_path(path: list[str]) -> list[tuple[bool, str | None]]:
    return [(False, None) if step == "-" else (step[0] == "L", step[1:]) for step in path]


def ranked(rows: DataFrame, tree: str, order: list[Column], label: str) -> DataFrame:
    """Adds ``position`` (from 0 within a tree, by ``order``) and ``total`` (rows of the tree).

    One range shuffle sorts all rows; numbers of a partition's rows plus an offset per tree
    and partition make positions, so no tree has to fit in a task. The row's place in its
    input is the last key: rows equal in all others are still cut over many tasks.
    """
    sort = [F.col(tree), *order, F.col("__place")]
    # Stored first: a range shuffle looks at its input twice.
    placed = sized(rows.withColumn("__place", F.monotonically_increasing_id()), label)
    sorted_rows = placed.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("__place")
    numbered = sized(sorted_rows.withColumn("__n", F.monotonically_increasing_id()), label)
    part = F.shiftright("__n", 33)  # the upper bits of that id are the partition's number
    parts = numbered.groupBy(tree, part.alias("__part")).agg(F.min("__n").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    # One row per partition that holds rows of a tree: small even for a tree with all rows.
    per_tree = Window.partitionBy(tree)
    before = per_tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(tree).alias("__tree"), "__part", "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(per_tree).alias("total"),
    )
    met = numbered.join(parts, (F.col(tree) == F.col("__tree")) & (part == F.col("__part")))
    position = F.col("__before") + F.col("__n") - F.col("__first")
    return met.withColumn("position", position).drop("__n", "__tree", "__part", "__first", "__before")


def _height(total: int, bits: int) -> int:
    """Levels of a tree of ``total`` nodes, as far as a block of 2^bits goes."""
    return min(bits, max(0, (total - 1).bit_length()))


def _blocks(nodes: DataFrame, bits: int, id_type: str) -> tuple[DataFrame, int]:
    """One stored row per block: its members in order and its root; and the largest number of blocks of a tree."""
    schema = f"tree STRING, block BIGINT, total BIGINT, members ARRAY<{_NODES.format(id=id_type)}>, root STRING"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("members").flatten().field("digest").to_pylist()
            cuts = batch.column("members").value_lengths().to_pylist()
            roots, at = [], 0
            for size, total in zip(cuts, batch.column("total").to_pylist()):
                roots.append(BlockTree(digests[at:at + size], _height(total, bits)).root)
                at += size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], names=[*batch.schema.names, "root"])

    member = F.struct("position", "digest", "tampered", "id")
    grouped = nodes.groupBy("tree", F.shiftright("position", bits).alias("block"), "total").agg(
        F.sort_array(F.collect_list(member)).alias("members")  # at most 2^bits of them
    )
    return stored(grouped.mapInArrow(build, schema), "manifest-blocks", F.max("block") + 1)


def _expanded(blocks: DataFrame, upper: DataFrame, bits: int, id_type: str, leaves: bool) -> DataFrame:
    """All members of the blocks with their whole path of siblings, given the paths of the blocks' roots.

    For ``leaves`` also the nodes that the version of each copies (its last is the new root).
    """
    schema = "tree STRING, position BIGINT, digest STRING, path ARRAY<STRING>, subroot STRING, root STRING"
    schema += f", id {id_type}, tampered BOOLEAN, copies ARRAY<STRING>" if leaves else ""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield one(batch.slice(row, 1))

    def one(block: pa.RecordBatch) -> pa.RecordBatch:
        get = lambda name: block.column(name)[0].as_py()
        members = block.column("members").flatten()
        digests = members.field("digest").to_pylist()
        tree = BlockTree(digests, _height(get("total"), bits))
        above = get("path")
        paths = [tree.siblings(i) for i in range(len(digests))]
        n = len(digests)
        columns = {
            "tree": pa.array([get("tree")] * n, pa.string()), "position": members.field("position"), "digest": members.field("digest"),
            "path": pa.array([written(p) + above for p in paths], pa.list_(pa.string())),
            "subroot": pa.array([get("subroot")] * n, pa.string()), "root": pa.array([get("top")] * n, pa.string()),
        }
        if leaves:
            changed = members.field("tampered").to_pylist()
            beyond = read_path(above)
            copies = []
            for i, (digest, new) in enumerate(zip(digests, changed)):
                inside = tree.version(i, new or digest)
                # A version whose block root is the old one shares everything above it.
                shared = inside[-1] == tree.root
                copies.append(inside + ([get("top")] if shared else continued(inside[-1], beyond)[1:]))
            columns |= {
                "id": members.field("id"), "tampered": pa.array([c is not None for c in changed]),
                "copies": pa.array(copies, pa.list_(pa.string())),
            }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    met = blocks.join(upper, (blocks["tree"] == upper["up_tree"]) & (blocks["block"] == upper["up_position"]))
    return met.select("tree", "total", "members", "path", "subroot", "top").mapInArrow(expand, schema)


def _up(table: DataFrame, subroot: str = "subroot") -> DataFrame:
    """Paths of one round's nodes as what the blocks below look up."""
    return table.select(
        F.col("tree").alias("up_tree"), F.col("position").alias("up_position"), "path",
        F.col(subroot).alias("subroot"), F.col("root").alias("top"),
    )


def _climb(nodes: DataFrame, bits: int, id_type: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rounds, and (tree, digest) of the roots of the trees."""
    rounds, most = [], 2
    while most > 1:
        blocks, most = _blocks(nodes, bits, id_type)
        most = most or 0
        rounds.append(blocks)
        nodes = blocks.select(
            "tree", F.col("block").alias("position"), F.col("root").alias("digest"), F.lit(None).cast("string").alias("tampered"),
            F.lit(None).cast(id_type).alias("id"), F.ceil(F.col("total") / (1 << bits)).cast("bigint").alias("total"),
        )
    return rounds, nodes.select("tree", "digest")


def _descend(rounds: list[DataFrame], upper: DataFrame, bits: int, id_type: str) -> DataFrame:
    """Whole paths of the members of the first round, given those of the roots of the trees."""
    for number in range(len(rounds) - 1, -1, -1):
        upper = _expanded(rounds[number], upper, bits, id_type, leaves=number == 0)
        if number:
            upper = _up(upper)
    return upper


def manifest(
    docs: DataFrame,
    columns: list[str] | None = None,
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: dict[str, Column] | None = None,
    when: Column | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Every row's leaf, ``subroot``, ``root``, ``path`` of siblings and the nodes its version copies.

    ``tampered`` gives new values of columns where ``when`` holds: such a leaf makes a
    version of the tree. ``copies`` are the nodes that it copies, from the new leaf up to
    ``folded_root``; where a version meets the old nodes again it shares all that follow, and
    ``copies`` goes on with the root only.
    """
    columns, tampered = columns or COLUMNS, tampered or {}
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        # Groups as text that sorts like them, NULL first.
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("tree"),
        F.col(id_col).alias("id"), leaf([F.col(c) for c in columns]).alias("digest"),
        F.when(F.lit(False) if when is None else when, leaf([tampered.get(c, F.col(c)) for c in columns])).alias("tampered"),
    )
    leaves = ranked(rows, "tree", [F.col("id"), F.col("digest")], "manifest-leaves")
    rounds, roots = _climb(leaves, block_bits, id_type)
    # The roots of the groups are the leaves of one more tree.
    groups = roots.select(
        F.lit("").alias("all"), F.col("tree").alias("group"), "digest", F.lit(None).cast("string").alias("tampered"),
    )
    groups = ranked(groups, "all", [F.col("group")], "manifest-groups").select(
        F.col("all").alias("tree"), F.col("group").alias("id"), "digest", "tampered", "position", "total"
    )
    top_rounds, top = _climb(groups, block_bits, "string")
    start = top.select(
        F.col("tree").alias("up_tree"), F.lit(0).cast("bigint").alias("up_position"), F.array().cast("array<string>").alias("path"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("top"),
    )
    found = _descend(top_rounds, start, block_bits, "string")
    by_group = found.select(
        F.col("id").alias("up_tree"), F.lit(0).cast("bigint").alias("up_position"), "path", F.col("digest").alias("subroot"), F.col("root").alias("top")
    )
    found = _descend(rounds, by_group, block_bits, id_type)
    folded = F.element_at("copies", -1)
    return found.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "path", "tampered", "copies",
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )


def proof_digest(path: Column) -> Column:
    """H of the siblings of a path, from the leaf up."""
    digests = F.transform(F.filter(path, lambda step: step != "-"), lambda step: F.substr(step, F.lit(2)))
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)
