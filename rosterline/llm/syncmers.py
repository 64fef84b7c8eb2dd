"""Document fingerprints from closed syncmers.

A k-mer of units is a closed syncmer if the least hash among its inner s-mers stands at one
of its edges. Whether it is one depends on nothing outside it, so a passage gives the same
anchors wherever it stands. Units are words; the characters of scripts without blanks, and
of words of more than ``LONG_WORD`` code points, are units one by one. This rule goes by content alone and is
the same for texts of any length. The fingerprint lists the smallest anchor hashes, and
likeness is the Jaccard estimate from those lists. ``anchors`` gives anchors with their
positions, and ``positional_matches`` lines up two texts by them.

Defined cases: NULL and empty texts have no anchors and the fingerprint ``w``; two such
texts are alike (1), an empty and another text are not (0); texts with fewer units than a
k-mer have one anchor of all of them; documents with equal ids are compared with the same
next document; of several documents with the next id the one whose text hashes least
counts; rows with a NULL id have no next document; a single document is its own next one;
an empty table gives an empty table; outputs replace columns of the same name, others stay
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterline.llm import carried
from rosterline.workspace import sized

SKETCH = 64
LONG_WORD = 24
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
KMER, SMER = 3, 1


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_units(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def char_units(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")


def mixed_units(text: Column) -> Column:
    """Words, but the characters of scripts without blanks and of very long words one by one."""
    is_long = lambda w: F.char_length(w) > LONG_WORD

    def cut(words: Column) -> Column:
        parts = F.flatten(F.transform(words, lambda w: F.when(is_long(w), char_units(w)).otherwise(F.array(w))))
        return F.when(F.exists(words, is_long), parts).otherwise(words)

    return bind(word_units(F.regexp_replace(text, UNSPACED, " $0 ")), cut)


def syncmers(units: Column, k: int, s: int) -> Column:
    """The closed syncmers of an array of units, as (position, hash) in order."""

    def of_hashes(h: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)]))

        def chosen(g: Column) -> Column:
            def closed(i: Column) -> Column:
                edges = F.least(F.get(g, i), F.get(g, i + (k - s)))
                inner = [F.get(g, i + j) for j in range(1, k - s)]
                return edges <= (F.least(*inner) if len(inner) > 1 else inner[0])

            return F.filter(F.sequence(F.lit(0), F.size(h) - k), closed)

        found = F.transform(
            bind(inner, chosen),
            lambda i: F.struct(i.alias("position"), F.xxhash64(*[F.get(h, i + j) for j in range(k)]).alias("hash")),
        )
        whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(h).alias("hash")))
        return F.when(F.size(h) >= k, found).when(F.size(h) > 0, whole).otherwise(F.filter(whole, lambda a: F.lit(False)))

    return bind(F.transform(units, lambda u: F.xxhash64(u)), of_hashes)


def _smallest(anchors: Column) -> Column:
    """The ``SKETCH`` smallest different anchor hashes, cut to 32 bits."""
    short = F.array_distinct(F.transform(anchors, lambda a: F.shiftright(a.hash, 32).cast("int")))
    return F.slice(F.sort_array(short), 1, SKETCH)


def sketch(text: Column) -> Column:
    """The ``SKETCH`` smallest different anchor hashes of a text."""
    return _smallest(syncmers(mixed_units(text), KMER, SMER))


def fingerprint(sketched: Column) -> Column:
    digits = lambda v: F.lower(F.lpad(F.hex(v.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.concat(F.lit("w"), F.array_join(F.transform(sketched, digits), ""))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1; 1 for equal sketches."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    least = F.size(F.array_intersect(F.array_intersect(a, b), both))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(least / F.size(both))


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (``id_col``, ``position`` counted in units, ``hash``): the anchors of all documents."""
    found = F.explode(syncmers(mixed_units(F.col(text_col)), KMER, SMER))
    return docs.select(id_col, found.alias("__anchor")).select(id_col, "__anchor.position", "__anchor.hash")


def positional_matches(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``matches``: stretches of units that two texts share, by anchors that stand once in each.

    Anchors with one hash in both texts lie on a diagonal, the difference of their positions;
    a stretch goes from the first to the last anchor of a diagonal: (left, right, units).
    """

    def once(text: Column) -> Column:
        found = syncmers(mixed_units(text), KMER, SMER)
        return bind(found, lambda own: bind(F.transform(own, lambda a: a.hash), lambda hashes: F.filter(
            own, lambda a: F.size(F.filter(hashes, lambda h: h == a.hash)) == 1
        )))

    both = pairs.withColumn("__left", once(F.col(left))).withColumn("__right", once(F.col(right)))
    shared = F.array_intersect(F.transform("__left", lambda a: a.hash), F.transform("__right", lambda a: a.hash))
    at = lambda side: F.map_from_entries(F.transform(side, lambda a: F.struct(a.hash, a.position)))
    both = both.withColumns({"__shared": shared, "__l": at("__left"), "__r": at("__right")})
    points = F.transform("__shared", lambda h: F.struct((F.element_at("__r", h) - F.element_at("__l", h)).alias("diagonal"), F.element_at("__l", h).alias("at")))
    both = both.withColumn("__points", points)
    diagonals = F.sort_array(F.array_distinct(F.transform("__points", lambda p: p.diagonal)))

    def stretch(diagonal: Column) -> Column:
        places = F.transform(F.filter("__points", lambda p: p.diagonal == diagonal), lambda p: p["at"])
        return F.struct(
            F.array_min(places).alias("left"), (F.array_min(places) + diagonal).alias("right"),
            (F.array_max(places) - F.array_min(places) + KMER).alias("units"),
        )

    return both.select(*pairs.columns, F.transform(diagonals, stretch).alias("matches"))


def following(ids: DataFrame) -> DataFrame:
    """For distinct ``id`` rows (``id``, ``hash``, ``need``) the next lower id, round to the highest.

    Ids are cut in ranges; a window runs inside each range, and only the highest row of each
    range, as many as there are partitions, is put in order as a whole.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sized(ids.repartitionByRange(parts, "id").withColumn("range", F.spark_partition_id()), "id-ranges")
    inside = Window.partitionBy("range").orderBy(F.desc("id"))
    below = F.lead(F.struct(F.col("id").alias("next_id"), F.col("hash").alias("next_hash"))).over(inside)
    tops = ranged.groupBy("range").agg(F.max(F.struct("id", "hash")).alias("top"))
    whole = Window.orderBy("range")
    wrap = F.last("top").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = tops.select("range", F.coalesce(F.lag("top").over(whole), wrap).alias("top"))
    rows = ranged.withColumn("next", below).join(F.broadcast(tops), "range")  # a row for each partition
    return rows.select(
        "id", "need", F.coalesce("next.next_id", "top.id").alias("next_id"), F.coalesce("next.next_hash", "top.hash").alias("next_hash")
    )


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with fingerprints of each text and of the text whose last third gives way to the next document.

    Adds ``edited_text``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``. Every text is sketched once; ids, hashes and sketches are stored, and meet
    the ids and hashes that need them. Only the part of the next text that is needed
    travels. All joins with texts go by the id, so texts are shuffled by one exchange.
    """
    outputs = ["edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    others = [c for c in docs.columns if c not in outputs and c != text_col]
    # One struct of the columns that only go along: none of them can clash with names used here.
    texts = docs.select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
        *([carried.packed([c for c in others if c != id_col]).alias("__row")] if others != [id_col] else []),
    )
    text = F.coalesce("__text", F.lit(""))
    third = F.floor(F.char_length(text) / 3).cast("int")
    own = sized(texts.select("__id", F.xxhash64(text).alias("hash"), third.alias("need"), sketch(text).alias("sketch")), "sketches")
    named = own.where(F.col("__id").isNotNull())
    ids = named.groupBy(F.col("__id").alias("id")).agg(F.min("hash").alias("hash"), F.max("need").alias("need"))
    needs = sized(following(ids), "next-documents")
    once = named.groupBy("__id", "hash").agg(F.first("sketch").alias("sketch"))  # equal texts have equal sketches
    given = once.select(F.col("__id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("sketch").alias("__next"))
    asked = sized(needs.join(given, ["next_id", "next_hash"]), "next-sketches")
    # A range, not an equality: that would become a second join key, and the exchange one of its own.
    whose = asked.select(F.col("id").alias("__for"), "need", F.col("next_id").alias("__from"), "next_hash")
    of_ids = texts.where(F.col("__id").isNotNull())
    giving = of_ids.join(whose, F.col("__id") == F.col("__from")).where(F.xxhash64(text).between(F.col("next_hash"), F.col("next_hash")))
    giving = giving.select("__for", F.substring(text, F.lit(1), F.col("need")).alias("__begin")).groupBy("__for").agg(F.first("__begin").alias("__begin"))
    rows = of_ids.join(giving, F.col("__id") == F.col("__for")).drop("__for")
    rows = rows.join(asked.select(F.col("id").alias("__for"), "__next"), F.col("__id") == F.col("__for")).drop("__for")
    mine = once.select(F.col("__id").alias("__for"), "hash", F.col("sketch").alias("__own"))
    rows = rows.join(mine, F.col("__id") == F.col("__for")).where(F.xxhash64(text).between(F.col("hash"), F.col("hash"))).drop("__for", "hash")
    alone = texts.where(F.col("__id").isNull()).withColumn("__own", sketch(text))
    rows = rows.unionByName(alone, allowMissingColumns=True)
    kept = F.substring(text, F.lit(1), F.char_length(text) - third)
    rows = rows.withColumn("__edited", F.concat(kept, F.coalesce(F.substring(F.col("__begin"), F.lit(1), third), F.lit(""))))
    rows = rows.withColumn("__other", sketch(F.col("__edited")))
    sketched, other = F.col("__own"), F.col("__other")
    named_back = {c: F.col("__row").getField(c) for c in others if c != id_col} | {id_col: F.col("__id"), text_col: F.col("__text")}
    return rows.select(
        *[named_back[c].alias(c) for c in docs.columns if c not in outputs],
        F.col("__edited").alias("edited_text"), fingerprint(sketched).alias("fingerprint"),
        fingerprint(other).alias("edited_fingerprint"), likeness(sketched, other).alias("near_edited"),
        F.coalesce(likeness(sketched, F.col("__next")), F.lit(0.0)).alias("near_next"),
    )
