"""Merkle manifests against a plain tree over lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rosterline.llm import manifest

SCHEMA = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    result = [nodes]
    while len(result[-1]) > 1:
        below = result[-1]
        result.append([h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return result


def fold(digest, tree, at):
    siblings = []
    for level in tree[:-1]:
        pair = level[at & ~1:(at & ~1) + 2]
        siblings += [x for i, x in enumerate(pair) if i != at & 1]
        pair[at & 1] = digest
        digest, at = h(*pair), at >> 1
    return digest, siblings


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in names:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in groups[lang]])
    top = levels([trees[lang][-1][0] for lang in names])
    result = []
    for number, lang in enumerate(names):
        for at, row in enumerate(groups[lang]):
            new = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                new[3] += 1
            digest, below = fold(leaf(new), trees[lang], at)
            root, above = fold(digest, top, number)
            result.append((row[0], leaf(row), trees[lang][-1][0], top[-1][0], h(*below, *above), root, root == top[-1][0]))
    return sorted(result, key=str)


def run(df, **options):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest.manifest(df, tampered={"n_chars": F.col("n_chars") + 1}, when=chosen, **options)
    found = found.withColumn("proof", manifest.proof_digest(F.col("path")))
    return sorted(map(tuple, found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


def rows_of(n, langs=("en", "de", None, "zé", "")):
    return [(i * 3 % 101, f"s{i}", langs[i * i % len(langs)], None if i % 9 == 4 else i, None if i % 13 == 5 else "ä" * i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 101])
@pytest.mark.parametrize("bits", [1, 2, 10])
def test_matches_plain_trees(spark, n, bits):
    rows = rows_of(n)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(3), block_bits=bits) == brute(rows)


def test_repeated_ids_rows_and_nulls(spark):
    rows = rows_of(20) + rows_of(20)[:9] + [(None, None, None, None, None)] * 3 + [(7, "other", "en", 1, ""), (None, "x", "en", 2, "y")]
    assert run(spark.createDataFrame(rows, SCHEMA), block_bits=2) == brute(rows)


def test_a_row_in_a_third_of_all_rows(spark):
    rows = [(1, "s", "en", 5, "t")] * 40 + [(i, "s", "en", i, "t") for i in range(80)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(5), block_bits=3) == brute(rows)


def test_one_group_empty_table_and_long_text(spark):
    rows = [(i, "s", "en", i, "x" * (200_000 if i == 3 else i)) for i in range(70)]
    assert run(spark.createDataFrame(rows, SCHEMA), block_bits=3) == brute(rows)
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_extra_columns_are_not_read(spark):
    rows = rows_of(12)
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["tree", "id", "digest", "tampered", "position", "total", "block", "members", "root", "subroot", "path", "leaf", "all", "group", "__n", "__place"]
    assert run(df.select("*", *[F.lit("?").alias(c) for c in names])) == brute(rows)


def test_versions_copy_only_ancestors():
    leaves = [h(str(i)) for i in range(8)]
    tree = manifest.BlockTree(leaves, 3)
    before = [list(level) for level in tree.levels]
    copies = tree.version(5, h("new"))
    changed = manifest.BlockTree([*leaves[:5], h("new"), *leaves[6:]], 3)
    assert copies == [changed.levels[k][5 >> k] for k in range(4)] and tree.levels == before
    assert tree.version(5, leaves[5])[-1] == tree.root


def test_real_outputs(spark):
    rows = [(i, "s", "en", i, "t") for i in range(9)]
    found = {r["doc_id"]: r for r in manifest.manifest(spark.createDataFrame(rows, SCHEMA), tampered={"text": F.lit("u")}, when=F.col("doc_id") == 8).collect()}
    assert found[8]["path"][:3] == ["-", "-", "-"] and len(found[8]["path"]) == 4 and found[8]["path"][3].startswith("L")
    assert [r["tampered"] for r in found.values()].count(True) == 1 and not found[8]["verified"]
    assert len(found[8]["copies"]) == 5 and found[8]["copies"][-1] == found[8]["folded_root"]
