"""Toxicity: restoring hidden words, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.llm import toxicity
from rosterline.llm.queries import table

INSULTS = ["idiot", "moron", "stupid", "loser"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    plain = [a + b for a in ("the", "an", "on", "er", "st", "re", "in") for b in ("tion", "ing", "ed", "ly", "able", "ness", "hand")]
    rows, labels = [], []
    for i in range(1200):
        words = rng.choices(plain, k=rng.randint(3, 40))
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit(*corpus)


def test_trigram_counts_cover_all_texts(spark):
    docs = spark.createDataFrame([("Abc",), ("é b",), (None,), ("",), ("abc abc",)], "text STRING").repartition(3)
    counts = toxicity.trigram_counts(docs).reshape(28, 28, 28)
    assert counts[1, 2, 3] == 3 and counts[27, 0, 2] == 1 and counts[3, 0, 1] >= 1


@pytest.mark.parametrize("hidden,word", [
    ("1d1ot", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("l.o.s.e.r", "loser"), ("l o s e r", "loser"), ("idiiiiiot", "idiot"),
    ("st-up-id", "stupid"), ("handing", "handing"), ("(theable)", "theable"), ("moron!!!", "moron"),
])
def test_hidden_words_are_restored(model, hidden, word):
    decoder = toxicity.Decoder(model.counts)
    found = {w for token in toxicity.tokens(f"in {hidden} on") for w in decoder.words(token)}
    assert word in found


@pytest.mark.parametrize("text,word", [
    ("i d i o t. ok then", "idiot"), ("i d i o t. a man", "idiot"), ("you m o r o n, man", "moron"), ('"i d i o t" to me', "idiot"),
    ("(l o s e r)", "loser"), ("don't i d i o t", "idiot"), ("idioot", "idiot"), ("moronn", "moron"), ("stuupid", "stupid"),
    ("idi" + "o" * 100 + "t", "idiot"), ("m" * 3000 + "oron", "moron"), ("1d1ot" + "!" * 60 + "x", "idiot"),
])
def test_words_hidden_next_to_signs_or_at_length_are_restored(model, text, word):
    decoder = toxicity.Decoder(model.counts)
    assert word in {w for token in toxicity.tokens(text) for w in decoder.words(token)}


@pytest.mark.parametrize("text,run", [
    ("i d i o t. ok then", "i d i o t"), ("d u m b, man", "d u m b"), ('"i d i o t" to me', "i d i o t"), ("d i e", "d i e"),
    ("i d i o t. a man", "i d i o t"), ("it isn't d u m b", "d u m b"), ("o k. d i e. no", "d i e"),
])
def test_spelt_runs_end_at_any_sign(text, run):
    assert run in toxicity.tokens(text)


@pytest.mark.parametrize("text,word", [
    ("$ t u p i d", "stupid"), ("so $ t u p i d, man", "stupid"), ("i d i o 7", "idiot"), ("s t ! p i d", None), ("l   o   s   e   r", "loser"),
    ("m\no\nr\no\nn", "moron"), ("m o r\no n", "moron"), ("i - d - i - o - t", "idiot"),
])
def test_spelt_words_with_signs_and_wide_gaps(model, text, word):
    decoder = toxicity.Decoder(model.counts)
    found = {w for token in toxicity.tokens(text) for w in decoder.words(token)}
    assert word is None or word in found


def test_tokens_of_signs_are_read_as_words_or_numbers(model):
    counts = np.zeros((28, 28, 28), np.int64)
    for a, b, c in zip("  455".replace("455", "ass") + " ", " ass  ", "ass   "):
        counts[tuple(0 if x == " " else ord(x) - 96 for x in (a, b, c))] += 10_000
    decoder = toxicity.Decoder(counts.reshape(-1))
    assert decoder.words("455") == ["ass"] and decoder.words("@$$") == ["ass"] and decoder.words("(4$5),") == ["ass"]
    plain = toxicity.Decoder(model.counts)
    assert plain.words("$") == plain.words("...") == plain.words("7.") == [] and plain.words("90210") == []


def enumerated(decoder, token):
    """The least cost of all readings, one by one."""

    def go(at, a, b, last, so_far):
        if at == len(token):
            return so_far + decoder.cost[a][b][0]
        options, ends = decoder.readings(token[at]), []
        for letter, price in options:
            if letter:
                c = decoder.symbol(letter)
                ends.append(go(at + 1, b, c, letter, so_far + price + decoder.cost[a][b][c]))
            else:
                ends.append(go(at + 1, a, b, last, so_far + price))
        if at and token[at] == token[at - 1] and last and last in [letter for letter, _ in options]:
            ends.append(go(at + 1, a, b, last, so_far + toxicity.COST_REPEAT))
        return min(ends)

    return go(0, 0, 0, None, 0.0)


def test_viterbi_finds_the_best_of_all_readings(model):
    rng, decoder = random.Random(4), toxicity.Decoder(model.counts)
    for _ in range(300):
        token = "".join(rng.choice("ait01!$.-") for _ in range(rng.randint(1, 5)))
        assert decoder.best(token)[0] == pytest.approx(enumerated(decoder, token)), token


def test_documents_with_any_columns(spark, corpus):
    docs, labels = corpus
    names = ["toxic", "__id", "__doc", "row", "score", "predicted", "n", "h"]
    more = docs.limit(60).select("*", *[F.lit(c).alias(c) for c in names])
    kept = toxicity.without_toxic(more, labels)
    assert kept.columns == more.columns and all(r[c] == c for r in kept.collect() for c in names)
    assert toxicity.scored(more, toxicity.fit(more, labels)).count() == 60


def test_long_spelt_phrases_are_decoded(model):
    decoder = toxicity.Decoder(model.counts)
    phrase = "theing idiot oned handing loser ontion moron erness stupid"
    spelt = " ".join(phrase.replace(" ", ""))
    assert len(spelt) > 90 and spelt in toxicity.tokens(spelt)
    found = decoder.words(spelt)
    assert "".join(found) == phrase.replace(" ", "") and max(map(len, found)) > 1
    wide = "  ".join(" ".join(word) for word in phrase.split())
    assert set(INSULTS) <= {w for token in toxicity.tokens(wide) for w in decoder.words(token)}


def test_long_tokens_take_linear_time_and_plain_doubles_stay(model):
    decoder = toxicity.Decoder(model.counts)
    assert "".join(decoder.words("a1b" * 50_000)).startswith("a")
    assert "kitten" in decoder.words("kitten") and decoder.words("handing") == ["handing"]


def test_hidden_insults_score_like_plain_ones(spark, model):
    texts = ["theing 1d1ot oned", "theing i d i o t oned", "theing idiot oned", "theing handing oned", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").withColumn("score", F.lit("mine"))
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert [got[i]["predicted"] for i in range(6)] == [1, 1, 1, 0, 0, 0]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[4]["score"] == got[5]["score"]


def test_held_out_rows(spark):
    ids = [0, 1, 2, 17, 123456, -5, None]
    got = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in ids], "d BIGINT").select("d", toxicity.held_out(F.col("d"))).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_held_out_labels_are_never_read(corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert one.index == two.index and np.array_equal(one.weights, two.weights)


def test_accuracy_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = toxicity.scored(docs, toxicity.fit(docs, labels), keep=["doc_id"]).where(toxicity.held_out(F.col("doc_id")))
    rows = scores.join(labels, "doc_id").select("predicted", "toxic").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hits / sum(r["toxic"] for r in rows) > 0.85 and hits / sum(r["predicted"] for r in rows) > 0.9


def test_few_or_no_labels(spark, corpus):
    docs, labels = corpus
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.scored(docs, none).collect()} == {0.0}
    clean = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r["predicted"] for r in toxicity.scored(docs, clean).collect()} == {0}
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_repeated_labels_count_as_the_greatest(spark, corpus):
    docs, labels = corpus
    doubled = labels.unionByName(labels.withColumn("toxic", F.lit(0)))
    assert toxicity.fit(docs, doubled).index == toxicity.fit(docs, labels).index


def test_filter_keeps_columns(spark, corpus, model):
    docs, labels = corpus
    kept = toxicity.without_toxic(docs.withColumn("score", F.lit(1)), labels)
    assert kept.columns == ["doc_id", "text", "score"]
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & set(range(0, 1200, 5))) < 12 and len(ids) > 900
