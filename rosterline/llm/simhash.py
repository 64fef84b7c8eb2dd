"""SimHash fingerprints and near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 of all word
shingles. To link fingerprints that differ in at most ``max_distance`` bits, the bits are
cut into parts, correlated bits together, and every part gets a threshold of its own, at
least -1 (the part is not probed), with the thresholds plus one adding up to
``max_distance + 1``. Two fingerprints within reach then agree, in at least one part, up to
its threshold. The thresholds come from a dynamic program over the number of candidate
pairs of every part and threshold, counted over all fingerprints.

Probing puts every fingerprint under its part's value with each choice of ``threshold``
bits masked; whoever shares a key is verified. A key with very many fingerprints is cut
finer by applying the principle again to the bits outside it. Inside a key, only links
that join two groups are given, so copies never become all pairs.

Defined cases: NULL texts and texts without words have fingerprint zero; fewer words than
a shingle make one shingle of the whole sequence; repeated rows link like any others; a
component whose ids are all NULL has a NULL id; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rosterline.llm.byte_words import text_slices
from rosterline.llm.components import components
from rosterline.workspace import sized, stored

BITS = 64
PARTS = 4
HOT_KEY = 4096
SEED = 42


def shingle_hashes(text: bytes, words: int) -> bytes:
    """The digests of all shingles of one text, repeats included, eight bytes each."""
    found = text.lower().split()  # on bytes: A-Z only, and just the six ASCII white-space bytes
    if not found:
        return b""
    if len(found) <= words:
        return xxhash.xxh64_digest(b" ".join(found), SEED)
    digest, join = xxhash.xxh64_digest, b" ".join
    return b"".join([digest(join(s), SEED) for s in zip(*(found[i:] for i in range(words)))])


def majority_bits(digests: bytes, step: int = 1 << 15) -> int:
    """Bit i is 1 if set in over half of the digests; none: 0."""
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), step):
        counts += np.unpackbits(hashes[at:at + step], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """Rows (``id_col``, ``row_hash`` of the text, ``fingerprint`` as a signed 64-bit number) of all documents."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for _, _, data, offsets in text_slices(batch.column(2)):
                raw, cuts = data.tobytes(), offsets.tolist()
                values += [majority_bits(shingle_hashes(raw[a:b], words)) for a, b in zip(cuts, cuts[1:])]
            prints = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], names=["id", "row_hash", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    row_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), row_hash.alias("row_hash"), text_col).mapInArrow(
        compute, f"id {kind}, row_hash BIGINT, fingerprint BIGINT"
    )


def _unpacked(values: np.ndarray) -> np.ndarray:
    """One row of 64 bits per number, bit 0 (lowest) first."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(prints: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of about one size, strongly correlated bits together.

    Joint counts of all pairs of bits over all fingerprints come from partial sums per task.
    """

    def joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            bits = _unpacked(batch.column(0).to_numpy()).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            rows += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS + 1)), pa.array([*total.tolist(), [rows] * BITS], pa.list_(pa.int64()))],
            names=["bit", "counts"],
        )

    sums = [F.sum(F.get("counts", F.lit(i))).alias(f"c{i}") for i in range(BITS)]
    rows = prints.select("fingerprint").mapInArrow(joint, "bit BIGINT, counts ARRAY<BIGINT>").groupBy("bit").agg(*sums).collect()
    both, n = np.zeros((BITS, BITS)), 0
    for row in rows:
        if row["bit"] == BITS:
            n = row["c0"]
        else:
            both[row["bit"]] = [row[f"c{i}"] for i in range(BITS)]
    share = both / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(p * (1 - p)) + 1e-9
    strength = np.abs(share - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    free, groups = set(range(BITS)), []
    for left in range(parts, 0, -1):
        size = math.ceil(len(free) / left)
        own = sorted(free)
        seed = own[int(np.argmax(strength[np.ix_(own, own)].sum(axis=1)))]
        group = [seed]
        free.discard(seed)
        while len(group) < size:
            own = sorted(free)
            best = own[int(np.argmax(strength[np.ix_(group, own)].sum(axis=0)))]
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def _extract(value: str, bits: list[int]) -> str:
    """SQL for the given bits of a number, packed; runs of neighbouring bits take one step."""
    terms, at = [], 0
    while at < len(bits):
        end = at
        while end + 1 < len(bits) and bits[end + 1] == bits[end] + 1:
            end += 1
        mask = (1 << (end - at + 1)) - 1
        terms.append(f"shiftleft(shiftrightunsigned({value}, {bits[at]}) & {mask}L, {at})")
        at = end + 1
    return "(" + " | ".join(terms) + ")"


def candidate_counts(prints: DataFrame, parts: list[list[int]], max_distance: int) -> list[list[int]]:
    """For each part: how many pairs of fingerprints differ in at most t of its bits, t from 0.

    Exact over all fingerprints. A part has at most 2^(its bits) values, which bounds both the
    histogram and the task that counts pairs of its values by distance (the histogram's
    autocorrelation under exclusive-or, by Walsh-Hadamard transform).
    """
    widths = [len(part) for part in parts]
    values = F.array(*[F.expr(_extract("fingerprint", part)) for part in parts])
    counts = prints.select(F.posexplode(values).alias("part", "value")).groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))

    def pairs(key, frame):
        import pandas as pd

        width = widths[key[0]]
        size = 1 << width
        histogram = np.zeros(size)
        histogram[frame["value"].to_numpy()] = frame["n"].to_numpy()

        def transform(x):
            step = 1
            while step < size:
                x = x.reshape(-1, 2, step)
                x = np.stack([x[:, 0] + x[:, 1], x[:, 0] - x[:, 1]], axis=1).reshape(-1)
                step *= 2
            return x

        by_mask = transform(transform(histogram) ** 2) / size
        ones = np.array([bin(i).count("1") for i in range(size)])
        by_distance = np.bincount(ones, weights=by_mask, minlength=width + 1)
        by_distance[0] -= histogram.sum()
        within = np.cumsum(np.maximum(by_distance, 0)) / 2
        return pd.DataFrame({
            "part": key[0], "t": range(max_distance + 1), "pairs": [float(within[min(t, width)]) for t in range(max_distance + 1)],
        })

    result = [[0.0] * (max_distance + 1) for _ in parts]
    for row in counts.groupBy("part").applyInPandas(pairs, "part INT, t INT, pairs DOUBLE").collect():
        result[row["part"]][row["t"]] = row["pairs"]
    return result


def allocate(counts: list[list[float]], widths: list[int], rows: int, max_distance: int) -> list[int]:
    """Thresholds, at least -1 each and adding up with one each to ``max_distance + 1``, of least cost.

    The cost of a part is its candidate pairs plus the keys it writes.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part, width in zip(counts, widths):
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, min(max_distance - used, width) + 1):
                more = 0.0 if t < 0 else part[t] + 50.0 * rows * math.comb(width, t)
                option = (cost + more, [*chosen, t])
                if used + t + 1 not in after or option[0] < after[used + t + 1][0]:
                    after[used + t + 1] = option
        best = after
    return best[max_distance + 1][1]


def _probe_keys(part: int, bits: list[int], threshold: int) -> str:
    """SQL of the keys of one part: its value with each choice of ``threshold`` bits masked."""
    full = (1 << len(bits)) - 1
    masks = ", ".join(f"{full & ~sum(1 << i for i in masked)}L" for masked in combinations(range(len(bits)), threshold))
    key = f"named_struct('path', {part}, 'k', xxhash64({part}, i, {_extract('fingerprint', bits)} & mask))"
    return f"transform(array({masks}), (mask, i) -> {key})"


def probe_keys(
    prints: DataFrame, parts: list[list[int]], thresholds: list[int], max_distance: int, hot_key: int = HOT_KEY, levels: int = 2
) -> DataFrame:
    """Rows (``k``, ``fingerprint``): whoever shares ``k`` is a candidate pair.

    Keys with more than ``hot_key`` fingerprints are replaced by finer ones, up to ``levels``
    times: the bits not yet in the key are cut into ``max_distance + 1`` pieces, one of which
    must agree. Only rows of hot keys go on to the next level.
    """
    keys = [_probe_keys(i, part, t) for i, (part, t) in enumerate(zip(parts, thresholds)) if t >= 0]
    rows = prints.select("fingerprint", F.explode(F.expr(f"concat({', '.join(keys)})")).alias("key"))
    rows = rows.select("fingerprint", "key.path", "key.k")
    rest = {i: [b for b in range(BITS) if b not in part] for i, part in enumerate(parts)}
    pieces, done = max_distance + 1, []
    for level in range(levels):
        counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_key).select("k")
        hot, found = stored(counts, "hot-keys", F.count(F.lit(1)))
        if not found:
            break
        done.append(rows.join(hot, "k", "left_anti").select("k", "fingerprint"))
        finer, options = {}, []
        for path, bits in rest.items():
            entries = []
            for i in range(pieces):
                cut = bits[i * len(bits) // pieces:(i + 1) * len(bits) // pieces]
                finer[path * pieces + i] = [b for b in bits if b not in cut]
                key = f"xxhash64(k, {level}, {i}, {_extract('fingerprint', cut)})"
                entries.append(f"named_struct('path', {path * pieces + i}, 'k', {key})")
            options.append(f"WHEN path = {path} THEN array({', '.join(entries)})")
        entry = F.explode(F.expr(f"CASE {' '.join(options)} END")).alias("e")
        rows = rows.join(hot, "k", "left_semi").select("fingerprint", entry).select("fingerprint", "e.path", "e.k")
        rest = finer
    result = rows.select("k", "fingerprint")
    for part in done:
        result = result.unionByName(part)
    return result


def _links(values: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among different fingerprints, as (root, member).

    Every reached fingerprint is compared only with those not reached yet.
    """
    found, left = [], values
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= max_distance
            if near.any():
                hits = left[near]
                found += [(root, hit) for hit in hits]
                frontier.extend(hits)
                left = left[~near]
    return found


def verified_links(candidates: DataFrame, max_distance: int) -> DataFrame:
    """Edges (``a``, ``b``) that connect, per key, the fingerprints within ``max_distance`` bits."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the last key, which may go on

        def edges(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
            sizes = np.diff(cuts)
            pairs: list[tuple[int, int]] = []
            values = values.view(np.uint64)  # bitwise_count takes signed numbers by their magnitude
            two = cuts[:-1][sizes == 2]
            close = two[np.bitwise_count(values[two] ^ values[two + 1]) <= max_distance]
            pairs += zip(values[close], values[close + 1])
            for at, size in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                pairs += _links(values[at:at + size], max_distance)
            sides = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(sides[:, 0]), pa.array(sides[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            if last or (held and held[0][0][0] != keys[0]):
                ready = [*held, (keys[:last], values[:last])]
                yield edges(*(np.concatenate(side) for side in zip(*ready)))
                held = []
            held.append((keys[last:], values[last:]))
        if held:
            yield edges(*(np.concatenate(side) for side in zip(*held)))

    parts = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = candidates.repartition(parts, "k").sortWithinPartitions("k").select("k", "fingerprint")
    return grouped.mapInArrow(verify, "a BIGINT, b BIGINT")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    max_distance: int = 3,
    parts: int = PARTS,
    hot_key: int = HOT_KEY,
) -> DataFrame:
    """Per document ``id``, ``row_hash``, ``fingerprint``, ``component_id`` and ``component``.

    ``component_id`` is the smallest id reachable; ``component`` is a fingerprint of the
    component, which tells it apart even if ids repeat.
    """
    prints = sized(fingerprints(docs, id_col, text_col, words), "fingerprints")
    groups, rows = stored(
        prints.groupBy("fingerprint").agg(F.min("id").alias("first_id")), "distinct-fingerprints", F.count(F.lit(1))
    )
    cut = correlated_parts(groups, parts)
    counts = candidate_counts(groups, cut, max_distance)
    thresholds = allocate(counts, [len(part) for part in cut], rows or 0, max_distance)
    candidates = probe_keys(groups, cut, thresholds, max_distance, hot_key)
    labels = components(verified_links(candidates, max_distance))
    linked = groups.join(labels, groups["fingerprint"] == labels["node"]).select("fingerprint", "first_id", "root")
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = linked.join(least, "root").select("fingerprint", "least_id", "root")
    named = groups.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("least_id", "first_id").alias("component_id"),
        F.coalesce("root", "fingerprint").alias("component"),
    )
    return prints.join(named, "fingerprint").select("id", "row_hash", "fingerprint", "component_id", "component")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with its own columns, one row of each component: one with the smallest id.

    If that id occurs in several rows of the component, the row whose text hashes least
    stays, and of rows equal in id and text one, chosen by its other columns.
    """
    found = near_duplicates(docs, id_col, text_col, **options).where(F.col("id").eqNullSafe(F.col("component_id")))
    alike = found.groupBy("component", "id", "row_hash").agg(F.count(F.lit(1)).alias("n"))
    first = alike.groupBy("component").agg(F.min(F.struct("row_hash", "id", "n")).alias("first"))
    first = first.select(F.col("first.id").alias("first_id"), F.col("first.row_hash").alias("first_hash"), F.col("first.n").alias("n"))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("own_hash")
    )
    kept = rows.join(first, F.col("own_id").eqNullSafe(F.col("first_id")) & (F.col("own_hash") == F.col("first_hash")))
    least = kept.where("n > 1").groupBy("first_id", "first_hash").agg(F.min("row").alias("row"))
    chosen = kept.where("n = 1").select("row").unionByName(least.select("row"))
    return chosen.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
