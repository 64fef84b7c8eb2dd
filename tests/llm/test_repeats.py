"""Removal of repeated passages against a plain version that compares the words of all windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rosterline.llm import repeats

SCHEMA = "doc_id BIGINT, text STRING"


def brute(rows, window):
    """Per row: the text that is left, its words before, its words removed."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    smallest = {}
    for (doc, _), words in zip(rows, split):
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            if doc is not None:
                smallest[key] = min(doc, smallest.get(key, doc))
    result = []
    for (doc, _), words in zip(rows, split):
        gone = set()
        for at in range(len(words) - window + 1):
            if doc is not None and smallest[tuple(words[at:at + window])] < doc:
                gone.update(range(at, at + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        result.append((doc, " ".join(kept), len(words), len(words) - len(kept)))
    return sorted(result, key=str)


def run(df, window=13, **options):
    got = repeats.without_repeats(df, window=window, **options).select("doc_id", "text", "n_words", "n_removed").collect()
    return sorted(map(tuple, got), key=str)


def corpus(seed, documents, vocabulary):
    rng = random.Random(seed)
    passage = [rng.choice("abcdefgh") for _ in range(12)]
    rows = []
    for doc in range(documents):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        if rng.random() < 0.4:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        rows.append((doc, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows + [(doc, text) for doc, text in rows[:5]] + [(100 + doc, text) for doc, text in rows[:5]]


@pytest.mark.parametrize("seed, window, vocabulary", [(1, 4, "abcd"), (2, 6, "ab"), (3, 13, "abc"), (4, 3, "ä€x")])
def test_matches_brute_force(spark, seed, window, vocabulary):
    rows = corpus(seed, 60, list(vocabulary))
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert run(df, window) == brute(rows, window)


def test_small_chunks_and_other_prefixes_give_the_same(spark, monkeypatch):
    rows = corpus(7, 50, list("abc"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, 6)
    for prefixes, tasks in (((1,), 1), ((2, 5), 7), ((), 3), ((3, 9), 2)):
        assert run(df, 6, prefixes=prefixes, tasks=tasks) == want
    monkeypatch.setattr(repeats, "CHUNK_SUFFIXES", 20)
    assert run(df, 6) == want


def test_defined_cases(spark):
    long = " ".join(f"w{i % 4000}" for i in range(20_000))
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, passage), (5, passage), (5, passage), (None, passage), (None, passage),
        (6, f"a  b\n{passage}\tc"), (7, long), (8, long), (9, "x " + passage.replace("p12", "q")), (-3, f"{passage} {passage}"),
        (10, " ".join(passage.split())),
    ]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 13)
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_a_window_in_a_third_of_all_places(spark):
    rows = [(i, "ab " * 40 + f"{i}") for i in range(90)] + [(1000 + i, f"u{i} " * 40) for i in range(90)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows, 13)


def test_own_columns_stay_and_spans_are_maximal(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    df = spark.createDataFrame([(1, passage), (2, f"x {passage} y {passage}")], SCHEMA)
    names = ["id", "text_hash", "spans", "row", "kept", "own_id", "own_hash", "task", "chunk", "kind", "__"]
    df = df.select("doc_id", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in names], "text", F.lit(7).alias("n_words"))
    got = repeats.without_repeats(df)
    assert got.columns == ["doc_id", *names, "text", *repeats.OUTPUTS]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[2]["text"] == "x y" and [tuple(s) for s in rows[2]["repeats"]] == [(1, 30), (32, 30)] and rows[1]["repeats"] == []
    assert all(rows[i][c] == f"{c}{i}" for i in (1, 2) for c in names) and rows[2]["n_words"] == 62


def test_frequent_prefixes_are_cut_finer(spark):
    rows = [(i, " ".join(["the", "same"] + [f"{i}-{j}" for j in range(20)])) for i in range(400)]
    split = repeats.partitioning(spark.createDataFrame(rows, SCHEMA), "text", tasks=4)
    assert [int(level.sum()) for level in split.frequent][0] == 1 and split.lengths == (2, 5, 13)
