"""License notices in texts: MinHash bands retrieve templates, exact containment verifies them.

A text is cut into windows of ``WINDOW`` words that overlap by half; templates are cut at every
word, so that a text's window inside a notice meets the same window of its template. Each
band is the least hash of a window's five-word shingles under one random order. A template has as many bands
as it takes that a notice of its length, however it lies to the windows and with a fifth of
its shingles gone, shares one with it with at least the given probability (``bands_needed``).
Band keys of windows are joined with those of templates; a retrieved template is then held
against the words themselves: the share of its shingles that the text contains must be at
least ``min_containment``.

Only windows that hold some shingle of some template are banded. A filter of bits over all template
shingles, which travels with the plan, finds them; it lets a few others by and leaves none out. Texts
are neither shuffled nor stored, only their shingles and windows that passed.

Templates are a table; the driver sees their hashes for the filter, 32 bytes a shingle. Any
number and length will do that leaves the filter a size to send with a task: 200 of 2,000 words make 13 MB.

Defined cases: NULL and empty texts contain no notice; a template of fewer words than a
shingle is one shingle of all its words, found where the text has just these words; templates
without words are never found; of templates with one name the one whose text compares least
counts; repeated rows each give their rows; columns besides the id are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rosterline.llm.line_dedup import ascii_lower
from rosterline.llm.syncmers import bind
from rosterline.workspace import sized

SHINGLE = 5
WINDOW = 16
STEP = 8
MIN_CONTAINMENT = 0.8
PROBABILITY = 0.999999
PER = WINDOW - SHINGLE + 1
SLOTS, PROBES = 32, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Notices as their licenses word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met",
    "Apache-2.0-header": "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
}


def template_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def template_shingles(text: str) -> list[str]:
    words = template_words(text)
    return [" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]


def similarity(shingles: int, share: float = MIN_CONTAINMENT) -> float:
    """The least similarity of a notice of so many shingles, ``share`` of them there, to a window of its template.

    Least over all places of the notice among the text's windows, of the best window.
    """
    own = min(shingles, PER)
    worst = PER
    for shift in range(STEP):
        inside = [min(at + PER, shingles) - max(at, 0) for at in range(-shift - PER * STEP, shingles, STEP)]
        worst = min(worst, max(inside))
    there = max(1, math.ceil(share * worst))
    return there / (PER + own - there)


def bands_needed(shingles: int, probability: float = PROBABILITY) -> int:
    """Bands of one row each so that a template of so many shingles is retrieved with ``probability``."""
    alike = similarity(shingles)
    return 1 if alike == 1 else math.ceil(math.log(1 - probability) / math.log(1 - alike))


def _order(band: int) -> int:
    """The number whose exclusive-or with the shingle hashes is the order of a band."""
    return xxhash.xxh64_intdigest(band.to_bytes(4, "big"), 7) - (1 << 63)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def shingle_hashes(words: Column) -> Column:
    """One hash per shingle, in order; fewer words than a shingle are one of all."""

    def of(h: Column) -> Column:
        whole = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]))
        return F.when(F.size(h) >= SHINGLE, whole).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.slice(h, 1, 0))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of)


def shingle_at(words: Column, place: Column) -> Column:
    return F.array_join(F.slice(words, place + 1, SHINGLE), " ")


def band_keys(window: Column, bands: int) -> Column:
    orders = F.array(*[F.lit(_order(b)) for b in range(bands)])
    return F.transform(orders, lambda order, band: F.xxhash64(band, F.array_min(F.transform(window, lambda x: x.bitwiseXOR(order)))))


class ShingleFilter:
    """Bytes that say of a shingle's hash that no template has it, or that one may."""

    def __init__(self, hashes: list[int]):
        self.bits = max(16, math.ceil(math.log2(max(1, SLOTS * len(hashes)))))
        marks = np.zeros(1 << self.bits, np.uint8)
        values = np.array(hashes, np.int64).view(np.uint64)
        for probe in range(PROBES):
            marks[self._slots(values, probe)] = 1
        self.data = marks.tobytes()

    def _slots(self, values: np.ndarray, probe: int) -> np.ndarray:
        return ((values >> np.uint64(7 * probe)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def passes(self, value: Column, marks: Column) -> Column:
        """Whether a hash passes; ``marks`` is this filter's data, bound once so that the plan holds it once."""
        marked, found = F.lit(b"\x01"), F.lit(True)
        for probe in range(PROBES):
            slot = F.shiftrightunsigned(value, 7 * probe).bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")
            found = found & (F.substring(marks, slot + 1, F.lit(1)) == marked)
        return found


def _template_rows(docs: DataFrame, templates: dict[str, str] | DataFrame) -> DataFrame:
    """(license, hashes, shingles) of every template, stored; hashes in order, shingles once each."""
    if isinstance(templates, dict):
        templates = docs.sparkSession.createDataFrame(list(templates.items()), "license STRING, body STRING")
    once = templates.where("license IS NOT NULL").groupBy("license").agg(F.min("body").alias("body"))
    rows = once.select("license", words_of(F.col("body")).alias("words")).where(F.size("words") > 0)
    places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - SHINGLE))
    return sized(rows.select(
        "license", shingle_hashes(F.col("words")).alias("hashes"),
        F.array_distinct(F.transform(places, lambda i: shingle_at(F.col("words"), i))).alias("shingles"),
    ), "license-templates")


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    min_containment: float = MIN_CONTAINMENT,
) -> DataFrame:
    """Rows (``id_col``, ``license``, ``n_found``, ``n_shingles``, ``containment``) of verified templates.

    ``templates`` is a table (``license``, ``body``) or the same as a dictionary.
    """
    known = _template_rows(docs, TEMPLATES if templates is None else templates)
    sizes = [r["n"] for r in known.select(F.size("shingles").alias("n")).distinct().collect()]
    most = max(map(bands_needed, sizes), default=1)
    own_filter = ShingleFilter([r["h"] for r in known.select(F.explode("hashes").alias("h")).distinct().collect()])

    # Templates: windows at every word, as many bands as their size needs (sizes above a window and a step are alike).
    enough = F.array(*[F.lit(bands_needed(max(1, n))) for n in range(PER + STEP + 1)])
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("hashes") - PER + 1))
    windows = known.select("license", F.get(enough, F.least(F.size("shingles"), F.lit(PER + STEP))).alias("bands"), F.explode(
        F.transform(starts, lambda i: F.slice("hashes", i, PER))).alias("window"))
    keys = windows.select("license", F.explode(F.slice(band_keys(F.col("window"), most), F.lit(1), F.col("bands"))).alias("key"))
    keys = sized(keys.distinct(), "license-bands")

    def passing(words: Column) -> Column:
        """Shingles that pass the filter, and the windows around them."""

        def of(h: Column) -> Column:
            at = bind(F.lit(own_filter.data), lambda marks: F.filter(
                F.sequence(F.lit(0), F.size(h) - 1), lambda i: own_filter.passes(F.get(h, i), marks)))

            def around(places: Column) -> Column:
                last = F.greatest(F.lit(0), F.floor((F.size(h) - (PER - STEP) - 1) / STEP)).cast("int")
                numbers = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(
                    F.least(F.floor(p / STEP).cast("int"), last), F.least(F.greatest(F.floor(p / STEP).cast("int") - 1, F.lit(0)), last)))))
                return F.struct(
                    F.array_distinct(F.transform(places, lambda p: shingle_at(words, p))).alias("shingles"),
                    F.transform(numbers, lambda n: F.slice(h, n * STEP + 1, PER)).alias("windows"),
                )

            return F.when(F.size(h) > 0, bind(at, around))

        return bind(shingle_hashes(words), of)

    found = docs.select(F.col(id_col).alias("__id"), bind(words_of(F.col(text_col)), passing).alias("__found")).where(F.size("__found.shingles") > 0)
    hits = sized(found.select("__id", F.monotonically_increasing_id().alias("__row"), "__found.shingles", "__found.windows"), "license-windows")
    banded = hits.select("__row", F.explode("windows").alias("window")).select("__row", F.explode(band_keys(F.col("window"), most)).alias("key"))
    retrieved = banded.join(keys, "key").select("__row", "license").distinct()
    held = retrieved.join(hits.select("__row", "__id", F.col("shingles").alias("__text")), "__row").join(known.select("license", "shingles"), "license")
    counted = held.select(
        F.col("__id").alias(id_col), "license", F.size(F.array_intersect("shingles", "__text")).alias("n_found"), F.size("shingles").alias("n_shingles")
    )
    return counted.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("containment") >= min_containment)
