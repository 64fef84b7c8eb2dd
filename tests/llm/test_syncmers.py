"""Closed syncmers against a plain version."""

import hashlib
import random
import string

import regex as re
import xxhash
from pyspark.sql import functions as F

from rosterline.llm import syncmers


def spark_hash(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def brute_syncmers(units, k, s):
    h = [spark_hash(u) for u in units]
    if len(h) < k:
        return [(0, None)] if h else []
    g = [spark_hash(*h[i:i + s]) for i in range(len(h) - s + 1)]
    found = []
    for i in range(len(h) - k + 1):
        inner = g[i:i + k - s + 1]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i, spark_hash(*h[i:i + k])))
    return found


def units(text):
    spaced = re.sub(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]", r" \g<0> ", text or "")
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", spaced) if w]
    return [u for w in words for u in (w if len(w) > syncmers.LONG_WORD else [w])]


def brute_sketch(text):
    found = brute_syncmers(units(text), syncmers.KMER, syncmers.SMER)
    if found and found[0][1] is None:
        return None  # the hash of a whole short text is Spark's own
    return sorted({h >> 32 for _, h in found})[:syncmers.SKETCH]


def brute_likeness(a, b):
    both = sorted(set(a) | set(b))[:syncmers.SKETCH]
    return len(set(a) & set(b) & set(both)) / len(both) if both else 1.0


TEXTS = [
    None, "", " \n", "one", "one two three", "a b c d e f g h i j k l m n o p q r s t u v", "Été à la plage, été à la mer; été à la montagne",
    "the cat sat on the mat " * 40, " ".join(f"w{i}" for i in range(600)), "日本語 のテキスト です ね はい そう", "one", "x" * 400,
]


def test_anchors_match_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id BIGINT, text STRING")
    got = {}
    for r in syncmers.anchors(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["position"], r["hash"]))
    for i, text in enumerate(TEXTS):
        want = brute_syncmers(units(text), syncmers.KMER, syncmers.SMER)
        if want and want[0][1] is None:
            assert [p for p, _ in got[i]] == [0]
        else:
            assert got.get(i, []) == want


def test_anchors_do_not_depend_on_their_surroundings(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    docs = spark.createDataFrame([(0, passage), (1, f"before {passage} after it all")], "doc_id BIGINT, text STRING")
    found = {d: {(r["position"], r["hash"]) for r in syncmers.anchors(docs).where(F.col("doc_id") == d).collect()} for d in (0, 1)}
    assert {(p + 1, h) for p, h in found[0]} <= found[1]


def test_edited_texts_and_likeness(spark):
    rows = [(i * 2, t) for i, t in enumerate(TEXTS)] + [(4, "another text with this id"), (None, "no id at all here")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("fingerprint", F.lit(0)).withColumn("id", F.lit(1)).repartition(4)
    got = syncmers.with_edited(docs).collect()
    assert len(got) == len(rows)
    least = {}
    for i, t in rows:
        if i is not None:
            least.setdefault(i, []).append(t or "")
    chosen = {i: min(ts, key=lambda t: spark_hash(t)) for i, ts in least.items()}
    ids = sorted(chosen, reverse=True)
    follows = {i: chosen[ids[(n + 1) % len(ids)]] for n, i in enumerate(ids)}
    for r in got:
        text, cut = r["text"] or "", len(r["text"] or "") // 3
        assert r["edited_text"] == text[:len(text) - cut] + follows.get(r["doc_id"], "")[:cut]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["edited_text"] == text:
            assert r["edited_fingerprint"] == r["fingerprint"] and r["near_edited"] == 1
    prints = {r["text"] or "": r["fingerprint"] for r in got}
    assert all(prints[r["text"] or ""] == r["fingerprint"] for r in got)
    long = next(r for r in got if (r["text"] or "").startswith("w0 w1"))
    assert 0.3 < long["near_edited"] < 0.8 and long["near_next"] < 0.1


def test_texts_without_blanks_are_alike_at_every_length(spark):
    rng = random.Random(3)
    han, base64 = [chr(c) for c in range(0x4E00, 0x4E00 + 2000)], string.ascii_letters + string.digits + "+/"
    rows = []
    for n in (240, 300, 2_000, 20_000):
        rows += ["".join(rng.choices(han, k=n)), "".join(rng.choices(base64, k=n))]
        rows.append("\n".join("".join(rng.choices(han, k=20)) for _ in range(n // 20)))
        rows.append(" ".join("".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(n // 14)) + " " + "".join(rng.choices(han, k=n // 2)))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id BIGINT, text STRING").repartition(4)
    for r in syncmers.with_edited(docs).collect():
        # In mixed texts the cut third holds most of the units: a quarter of them is left in common.
        assert (0.15 if r["doc_id"] % 4 == 3 else 0.3) < r["near_edited"] < 0.85, (r["doc_id"], r["near_edited"])
        assert r["near_next"] < 0.15
    near = [(t, t[:len(t) // 2] + "Q" + t[len(t) // 2 + 1:]) for t in rows]
    both = spark.createDataFrame(near, "a STRING, b STRING")
    alike = both.select(syncmers.likeness(syncmers.sketch(F.col("a")), syncmers.sketch(F.col("b")))).collect()
    assert all(r[0] > 0.75 for r in alike), alike


def test_sketch_and_likeness_match_brute_force(spark):
    rng = random.Random(8)
    for words in (4, 12, 63, 64, 65, 400):
        TEXTS.append(" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(words)))
    rows = [(a, b) for a in TEXTS for b in TEXTS]
    df = spark.createDataFrame(rows, "a STRING, b STRING")
    a, b = syncmers.sketch(F.col("a")), syncmers.sketch(F.col("b"))
    for r in df.select("a", "b", a.alias("x"), b.alias("y"), syncmers.likeness(a, b).alias("z"), syncmers.fingerprint(a).alias("f")).collect():
        want = brute_sketch(r["a"]), brute_sketch(r["b"])
        if want[0] is not None:
            assert r["x"] == want[0] and r["f"] == "w" + "".join(f"{v & 0xFFFFFFFF:08x}" for v in want[0])
        assert r["z"] == brute_likeness(r["x"], r["y"])
        assert r["a"] != r["b"] or r["z"] == 1.0


def test_one_rule_at_every_length(spark):
    """One word more or less changes likeness a little, at 63 and 64 words like anywhere."""
    words = [f"u{i}" for i in range(200)]
    pairs = [(" ".join(words[:n]), " ".join(words[:n + 1])) for n in (20, 62, 63, 64, 65, 150)]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    assert all(r[0] > 0.85 for r in df.select(syncmers.likeness(syncmers.sketch(F.col("a")), syncmers.sketch(F.col("b")))).collect())


def test_positional_matches(spark):
    shared = [f"s{i}" for i in range(60)]
    left = " ".join(["l1", "l2", *shared, "l3"])
    right = " ".join([*[f"r{i}" for i in range(9)], *shared[:30], "new", *shared[30:]])
    df = spark.createDataFrame([(left, right), (left, "nothing of it"), (None, left)], "a STRING, b STRING")
    rows = syncmers.positional_matches(df, "a", "b").collect()
    found = [(m["left"], m["right"], m["units"]) for m in rows[0]["matches"]]
    assert {r - x for x, r, _ in found} == {7, 8} and all(n >= 24 for _, _, n in found)
    a, b = left.split(), right.split()
    assert all(a[x:x + n] == b[r:r + n] for x, r, n in found)
    assert rows[1]["matches"] == [] and rows[2]["matches"] == []


def test_own_columns_stay(spark):
    names = ["id", "hash", "need", "sketch", "__for", "__next", "next_id", "next_hash", "range", "top", "__own"]
    docs = spark.createDataFrame([(1, "a b c d e"), (2, None)], "doc_id BIGINT, text STRING").select("*", *[F.lit(c).alias(c) for c in names])
    got = syncmers.with_edited(docs)
    assert got.columns[:len(docs.columns)] == docs.columns
    assert all(r[c] == c for r in got.collect() for c in names) and {r["text"] for r in got.collect()} == {"a b c d e", None}


def test_single_and_no_documents(spark):
    one = spark.createDataFrame([(5, "some words in a row to be cut here")], "doc_id BIGINT, text STRING")
    text = "some words in a row to be cut here"
    assert syncmers.with_edited(one).first()["edited_text"] == text[:len(text) - len(text) // 3] + text[:len(text) // 3]
    assert syncmers.with_edited(one.limit(0)).count() == 0


def test_digest_is_of_the_edited_text(spark):
    row = spark.createDataFrame([("é",)], "t STRING").select(F.sha2(F.col("t").cast("binary"), 256)).first()[0]
    assert row == hashlib.sha256("é".encode()).hexdigest()
