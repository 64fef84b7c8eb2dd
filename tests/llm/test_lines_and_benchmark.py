"""Line deduplication and decontamination: odd rows, several batches and blocks."""

import re

from pyspark.sql import functions as F

from rosterline.llm import decontamination, line_dedup


def keys(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r")) for line in (text or "").split("\n")]


def brute_lines(texts, least):
    count = {}
    for text in texts:
        for key in set(keys(text)):
            count[key] = count.get(key, 0) + 1
    drop = {k for k, n in count.items() if n >= least and k}
    result = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [line for line, key in zip(lines, keys(text)) if key not in drop]
        n = len(lines) - len(kept)
        result.append((text if not n else "\n".join(kept), len(lines), n))
    return result


TEXTS = [
    None, "", "\n", "Same line\nown 1", "  same LINE\t\nown 2\nsame line", "same line", "Über x\nüber x", "ÜBER X", "über X\n",
    "a\x85\na", "tail\n\n", "same line \nown 1", "own 1\r", " same line", "x" * 50_000 + "\nsame line",
]


def test_lines_match_brute_force(spark):
    rows = [(i % 12, t, "kept") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_lines STRING").repartition(3)
    for least in (2, 3, 100):
        got = line_dedup.deduplicate_lines(docs, min_docs=least)
        assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
        want = sorted([(r[0], *b) for r, b in zip(rows, brute_lines(TEXTS, least))], key=str)
        assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()], key=str) == want


def test_levels_of_runs_count_over_batches(spark):
    docs = spark.createDataFrame([(i, f"every\nfour {i % 4}\nown {i}") for i in range(40)], "doc_id BIGINT, text STRING")
    runs = line_dedup.LineRuns(spark, min_docs=10, fanout=2)
    for batch in range(5):
        part = docs.where(F.col("doc_id") % 5 == batch).select(F.explode(line_dedup.line_hashes(F.col("text"))).alias("hash"))
        runs.add(part)
        assert all(len(names) < 2 for names in runs.levels.values())
    assert runs.settled
    assert {r["hash"] for r in runs.frequent().collect()} == {
        r["h"] for r in spark.range(1).select(F.explode(line_dedup.line_hashes(F.lit("every\nfour 0\nfour 1\nfour 2\nfour 3"))).alias("h")).collect()
    }
    assert line_dedup.LineRuns(spark).frequent().count() == 0


def test_pipeline_form_keeps_columns(spark):
    docs = spark.createDataFrame([(i, "common\nown " + str(i), "en", "s", 99) for i in range(12)], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    kept = line_dedup.without_frequent_lines(docs)
    assert kept.columns == docs.columns
    assert {(r["text"], r["n_chars"]) for r in kept.collect()} == {(f"own {i}", len(f"own {i}")) for i in range(12)}
    assert line_dedup.without_frequent_lines(docs.limit(0)).count() == 0


NAMES = ["row_id", "row_hash", "drops", "hash", "line", "key", "batch", "text_lines", "__row", "n_lines", "n_dropped", "hashes"]


def test_own_columns_stay(spark):
    docs = spark.createDataFrame([(i, f"common\nown {i}") for i in range(12)], "doc_id BIGINT, text STRING").select(
        "doc_id", *[F.lit(c).alias(c) for c in NAMES], "text")
    kept = line_dedup.without_frequent_lines(docs)
    assert kept.columns == docs.columns and all(r[c] == c for r in kept.collect() for c in NAMES)
    got = line_dedup.deduplicate_lines(docs)
    assert got.columns == [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    assert {(r["n_lines"], r["n_dropped"], r["drops"]) for r in got.collect()} == {(2, 1, "drops")}


def test_keys_with_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "key_hash", lambda key: F.pmod(F.xxhash64(key), F.lit(5)))
    rows = [(i % 12, t) for i, t in enumerate([*TEXTS, *(f"own {i}\nevery\nsome {i % 3}" for i in range(15))])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    for least in (2, 5):
        got = line_dedup.deduplicate_lines(docs, min_docs=least).collect()
        want = sorted([(r[0], *b) for r, b in zip(rows, brute_lines([t for _, t in rows], least))], key=str)
        assert sorted(map(tuple, got), key=str) == want


def test_later_batches_meet_the_runs(spark, monkeypatch):
    """In the form that the queries use, batches are anti-joined with settled runs and levels build up."""
    joined, kept = [], []
    add = line_dedup.LineRuns.add

    def watched(self, hashes):
        joined.append(len(self.settled))
        add(self, hashes)
        kept.append(max(self.levels))

    monkeypatch.setattr(line_dedup.LineRuns, "add", watched)
    docs = spark.createDataFrame([(i, f"common\nown {i}") for i in range(60)], "doc_id BIGINT, text STRING")
    assert {r["n_dropped"] for r in line_dedup.deduplicate_lines(docs).collect()} == {1}
    assert joined == [0, 0, 1, 1] and max(kept) == 2


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, least):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        n = min(least, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


ITEMS = [
    (1, "The quick brown fox jumps over a lazy dog"), (2, "one"), (3, ""), (4, None), (10, "ÉTÉ été quick"), (5, "the quick, brown FOX! jumps over"),
    (6, "a a a a a a"), (6, "zz yy"), (7, "x1 x2 x3 x4 x5 x6 x7 x8"),
]
DOCUMENTS = [
    None, "", "...", "the QUICK brown-fox jumps", "brown fox jumps over a lazy", "one", "ONE two", "quick", "Été quick", "ÉTÉ été quick",
    "a a a a a a a a", "x2 x3 x4 x5 x6", "x1 x2 x3 x4", "and the quick brown fox jumps over a lazy dog and the quick brown fox jumps", "yy zz yy zz",
    "word " * 9000 + "x3 x4 x5 x6 x7 " + "word " * 9000,
]


def test_matches_brute_force_in_one_and_many_blocks(spark):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(DOCUMENTS)], "doc_id BIGINT, text STRING, n_hit BIGINT").repartition(2)
    benchmark = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    for least, block in ((4, 1 << 20), (4, 20), (10, 1 << 20)):
        got = decontamination.locate(docs, benchmark, min_words=least, block_bytes=block)
        assert got.columns == ["doc_id", "text", "n_words", "n_hit", "items", "matches"]
        for row in got.collect():
            assert (row["n_words"], row["n_hit"], row["items"]) == brute_hits(DOCUMENTS[row["doc_id"]], ITEMS, least)
            own = words(DOCUMENTS[row["doc_id"]])
            for m in row["matches"]:
                bodies = [words(body)[m["item_word"]:m["item_word"] + m["words"]] for item, body in ITEMS if str(item) == m["item_id"]]
                assert own[m["word"]:m["word"] + m["words"]] in bodies


def test_longest_match_and_removal(spark):
    docs = spark.createDataFrame([(13, DOCUMENTS[13], "x"), (0, "clean words", "y")], "doc_id BIGINT, text STRING, items STRING")
    benchmark = spark.createDataFrame([(1, ITEMS[0][1])], "item_id BIGINT, text STRING")
    matches = {(m["item_word"], m["word"], m["words"]) for m in decontamination.locate(docs, benchmark, min_words=4).where("doc_id = 13").first()["matches"]}
    assert matches == {(0, 1, 9), (0, 11, 5)}
    kept = decontamination.without_contaminated(docs, benchmark, min_words=4)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [0]


def test_repetitive_texts_cost_their_longest_matches(spark):
    import time

    docs = spark.createDataFrame([(1, "a b " * 4000), (2, ("p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 " + "x ") * 300)], "doc_id BIGINT, text STRING")
    benchmark = spark.createDataFrame([(1, "a b " * 400), (2, ("p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 " + "y ") * 60)], "item_id BIGINT, text STRING")
    started = time.perf_counter()
    got = {r["doc_id"]: r for r in decontamination.locate(docs, benchmark).collect()}
    assert time.perf_counter() - started < 10
    assert got[1]["n_hit"] == 8000 and got[1]["items"] == ["1"] and max(m["words"] for m in got[1]["matches"]) == 800
    assert got[2]["n_hit"] == 3000 and got[2]["items"] == ["2"] and len(got[2]["matches"]) == 300


def test_longest_match_of_each_place(spark):
    docs = spark.createDataFrame([(1, "u a b c d e f v a b c d w")], "doc_id BIGINT, text STRING")
    benchmark = spark.createDataFrame([(1, "a b c x a b c d e f y"), (2, "b c d")], "item_id BIGINT, text STRING")
    row = decontamination.locate(docs, benchmark, min_words=3).first()
    found = {(m["item_id"], m["word"], m["item_word"], m["words"]) for m in row["matches"]}
    assert found == {("1", 1, 4, 6), ("1", 8, 4, 4), ("2", 2, 0, 3), ("2", 9, 0, 3)}
    assert (row["n_hit"], row["items"]) == (10, ["1", "2"])


def test_repeated_items_and_columns_of_any_name(spark):
    names = ["items", "matches", "n_hit", "n_words", "row", "k1", "spans", "__m0", "__mood", "more_items"]
    docs = spark.createDataFrame([(0, "one two three four"), (1, "clean words here"), (2, None)], "doc_id BIGINT, text STRING")
    docs = docs.select("doc_id", *[F.concat(F.lit(c), "doc_id").alias(c) for c in names], "text")
    benchmark = spark.createDataFrame([(5, "two three four")] * 50 + [(6, "two three four"), (7, "x y z")], "item_id BIGINT, text STRING")
    for block in (1 << 20, 20):
        kept = decontamination.without_contaminated(docs, benchmark, min_words=3, block_bytes=block)
        assert kept.columns == docs.columns
        assert {tuple(r[c] for c in names) for r in kept.collect()} == {tuple(f"{c}{i}" for c in names) for i in (1, 2)}
        hit = decontamination.locate(docs, benchmark, min_words=3, block_bytes=block).where("doc_id = 0").first()
        assert (hit["items"], hit["n_hit"], len(hit["matches"]), hit["row"]) == (["5", "6"], 3, 2, "row0")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    some = spark.createDataFrame([(1, "a b c")], "doc_id BIGINT, text STRING")
    benchmark = spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert decontamination.locate(docs, benchmark).count() == 0
    row = decontamination.locate(some, benchmark).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (3, 0, [])
