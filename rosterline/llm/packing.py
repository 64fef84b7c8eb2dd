"""Documents cut into pieces of at most one sequence, and pieces packed under several limits at once.

Packing is vector bin packing with the dot-product heuristic: a sequence is filled by
always adding the piece, among those that still fit in every limit, with the greatest
product of its demands and what the sequence has left, each limit weighted by its share of
the whole demand. Pieces are dealt to buckets by hash, about ``bucket_rows`` in each, and
every bucket is packed in a task of its own; buckets are large enough that their last,
partly filled sequences do not matter. A piece's number in storage is part of its hash, so
pieces that are equal in all else are dealt out too.

The limits of documents are tokens, segments (pieces of a sequence) and loss-bearing
tokens. Only the first is always set; the others bind where the caller sets them.

Documents that fit in one sequence are not cut; longer ones give whole sequences and a rest.

Defined cases: NULL and empty texts are the end token alone; repeated rows are documents of
their own; equal pieces may swap places, which shows in no output but the ids; an empty
table gives an empty table; columns named like an output are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterline.llm.tokenizing import shared_encoder
from rosterline.workspace import stored

MAX_TOKENS = 4096
BUCKET_ROWS = 20_000


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    max_tokens: int = MAX_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, if wanted ``ids``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows, starts, lengths, sums, totals, ids = [], [], [], [], [], []
                for row, data in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                    data += end
                    for start in range(0, len(data) // 4, max_tokens):
                        own = data[4 * start:4 * (start + max_tokens)]
                        rows.append(row)
                        starts.append(start)
                        lengths.append(len(own) // 4)
                        sums.append(zlib.crc32(own))
                        totals.append(len(data) // 4)
                        if with_ids:
                            ids.append(np.frombuffer(own, "<i4"))
                columns = [part.column(0).take(pa.array(rows, pa.int64()))]
                columns += [pa.array(values, pa.int64()) for values in (starts, lengths, sums, totals)]
                names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT"
    return docs.select(id_col, text_col).mapInArrow(cut, schema + (", ids ARRAY<INT>" if with_ids else ""))


def fill(demands: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The bin of every item (rows of ``demands``), bins counted from 0; no item may exceed a limit.

    Items of equal demands are one kind, and kinds stand in order of the first demand, so
    what is too long is cut off by a binary search. The other limits are looked at one by
    one only if some kind that is left could exceed them.
    """
    kinds, kind_of, counts = np.unique(demands, axis=0, return_inverse=True, return_counts=True)
    weights = (kinds / limits * counts[:, None]).sum(axis=0)
    weighted = kinds / limits ** 2 * (weights / max(weights.sum(), 1e-12))
    free = [rows.tolist() for rows in np.split(np.argsort(kind_of.reshape(-1), kind="stable"), np.cumsum(counts)[:-1])]
    numbers = np.arange(len(kinds))
    bins = np.empty(len(demands), np.int64)
    number, used_up, rest = 0, 0, len(demands)

    def prepared(alive: np.ndarray):
        own = np.ascontiguousarray(kinds[alive])
        return alive, own, own[:, 0].copy(), np.maximum.accumulate(own, axis=0), np.ascontiguousarray(weighted[alive]), np.zeros(len(alive))

    alive, own, first, most, value, gone = prepared(numbers)
    while rest:
        left = limits.astype(np.int64).copy()
        while end := int(np.searchsorted(first, left[0], side="right")):
            product = value[:end] @ left + gone[:end]
            if (most[end - 1] > left).any():
                product[~(own[:end] <= left).all(axis=1)] = -np.inf
            best = end - 1 - int(np.argmax(product[::-1]))
            if product[best] == -np.inf:
                break
            kind = alive[best]
            bins[free[kind].pop()] = number
            rest -= 1
            left -= own[best]
            if not free[kind]:
                gone[best] = -np.inf
                used_up += 1
        number += 1
        if 2 * used_up > len(alive):
            alive, own, first, most, value, gone = prepared(alive[gone == 0])
            used_up = 0
    return bins


def pack(items: DataFrame, limits: dict[str, int], order: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``, the sum of the first limited column before it.

    ``limits`` maps columns with the demands of an item to what a sequence may hold; the
    first is its length. ``order`` names columns that tell items apart; with a number that each item
    gets as it is stored they fix the buckets and the order in a bucket, so that a task that
    runs again gives the same rows.
    """
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    sizes, tops = list(limits), np.array(list(limits.values()))
    numbered = items.select(*names, F.monotonically_increasing_id().alias("__number"))
    items, rows = stored(numbered, "pack-items", F.count(F.lit(1)))
    buckets = max(1, math.ceil((rows or 0) / bucket_rows))
    order = [*order, "__number"]

    def fill_bucket(key, table):
        table = table.sort_by([(c, "ascending") for c in order])
        demands = np.column_stack([table.column(c).to_numpy() for c in sizes]).astype(np.int64)
        if (demands > tops).any():
            raise ValueError("an item exceeds a limit of an empty sequence")
        bins = fill(demands, tops)
        by_bin = np.argsort(bins, kind="stable")
        length = demands[by_bin, 0]
        before = np.cumsum(length) - length
        heads = np.flatnonzero(np.append(True, np.diff(bins[by_bin]) > 0)) if len(bins) else np.zeros(0, np.int64)
        offsets = before - np.repeat(before[heads], np.diff(np.append(heads, len(bins))))
        table = table.take(pa.array(by_bin)).select(names)
        sequence = (np.int64(key[0].as_py()) << 32) + bins[by_bin]
        return table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema if f.name in names)
    hashed = F.pmod(F.xxhash64(*order[:-1]), F.lit(buckets))
    dealt = items.withColumn("__bucket", hashed)
    # Items equal in all of ``order`` share a bucket; one that they fill several times over is cut by their numbers.
    counts = dealt.groupBy(F.col("__bucket").alias("__full")).agg(F.count(F.lit(1)).alias("__items"))
    full, found = stored(counts.where(F.col("__items") > 2 * bucket_rows), "full-buckets", F.count(F.lit(1)))
    if found:
        cut = F.pmod("__number", F.ceil(F.col("__items") / bucket_rows)) * buckets
        dealt = dealt.join(full, F.col("__bucket") == F.col("__full"), "left")
        dealt = dealt.withColumn("__bucket", F.col("__bucket") + F.coalesce(cut, F.lit(0))).drop("__full", "__items")
    return dealt.groupBy("__bucket").applyInArrow(fill_bucket, f"{kinds}, sequence_id BIGINT, offset BIGINT")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    max_tokens: int = MAX_TOKENS, max_segments: int | None = None, max_loss_tokens: int | None = None, with_ids: bool = False,
    prompt_col: str | None = None,
) -> DataFrame:
    """Every piece of ``docs`` with its ``sequence_id`` and ``offset``.

    ``prompt_col`` says how many ids at a document's beginning are its prompt and bear no
    loss (NULL: none); without it all ids bear loss. A limit of None never binds.
    """
    name = id_col
    if prompt_col:
        # The prompt's length goes along with the id through the tokenizer.
        docs = docs.select(F.struct(F.col(id_col).alias("id"), F.coalesce(F.col(prompt_col).cast("bigint"), F.lit(0)).alias("prompt")).alias("__named"), text_col)
        name = "__named"
    cut = pieces(docs, tokenizer, end_id, name, text_col, max_tokens, with_ids)
    if prompt_col:
        named = [F.col("__named.id").alias(id_col), F.col("__named.prompt").alias("__prompt")]
        cut = cut.select(*named, *[c for c in cut.columns if c != name])
    prompt = F.col("__prompt") if prompt_col else F.lit(0)
    unscored = F.least(F.greatest(prompt - F.col("start"), F.lit(0)), F.col("length"))
    cut = cut.withColumns({"segments": F.lit(1).cast("bigint"), "loss_tokens": (F.col("length") - unscored).cast("bigint")})
    # A sequence of max_tokens ids holds no more pieces and no more loss-bearing ids than that anyway.
    limits = {"length": max_tokens, "segments": max_segments, "loss_tokens": max_loss_tokens}
    packed = pack(cut, {k: max_tokens if v is None else v for k, v in limits.items()}, ["start", "length", "ids_crc32", id_col])
    return packed.drop("segments", "loss_tokens", "__prompt")
