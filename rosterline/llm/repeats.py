"""Repeated passages, found with suffix trees over prefix-partitioned groups of suffixes.

A suffix begins at every word that has a whole window of words before its document ends.
Suffixes are split in groups by a prefix of *variable length*: one job counts, over all
documents, how many suffixes share each prefix of 2 and of 5 words, and a suffix belongs to its
shortest prefix that few enough share, else to its whole window. So a group is a small part of
what a task can hold, and prefixes that are frequent in the corpus are cut finer. Groups go
to tasks by a hash of their prefix.

A task sorts the suffixes of its groups by the window they begin with: the leaves of the
subtrees in order, cut off at that depth. Internal nodes that deep, with leaves in several
documents, are repeats, and the document with the smallest id keeps its words. What lies
deeper shows as such nodes at the next words too: runs of them in a document are its
*maximal repeats*, given as spans of words.

Work is done in *chunks*, runs of documents of one task with about two million suffixes. A
chunk sends a group one entry per different window, however often it holds it, so a window that a
third of all documents share is one entry per chunk; its other places stay with the chunk.
Words are told apart by 64-bit hashes, windows by 64-bit hashes inside the task of their
prefix: of N windows about N^2 / 2^65 / tasks pairs are taken for one by mistake (10^-5 of a pair for 10^8 windows).

Defined cases: NULL and empty texts have no words and become empty texts; documents of fewer
words than a window lose nothing; rows with a NULL id lose nothing and take nothing from
others; rows with the same id take nothing from each other, so repeated rows lose alike;
windows are judged on the input; an empty table gives an empty table; columns named like an output are
replaced. Ids are whole numbers. The input is read several times: it should be a stored
table, or follow from one without chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterline.llm import carried
from rosterline.llm.byte_words import text_slices, word_hashes, words_of
from rosterline.llm.shipping import Shipped
from rosterline.workspace import sized

WINDOW = 13
PREFIXES = (2, 5)
CHUNK_SUFFIXES = 1 << 21
TASK_SUFFIXES = 1 << 22
SLICE = 4096
OUTPUTS = ["n_words", "n_removed", "repeats"]

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_M = np.uint64(0xD6E8FEB86659FD93)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all."""
    values = (values ^ (values >> np.uint64(32))) * _M
    values = (values ^ (values >> np.uint64(32))) * _M
    return values ^ (values >> np.uint64(32))


def suffix_hashes(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the first ``lengths`` words (ascending) of all suffixes with a whole window, and how many each row has."""
    starts, ends, heads = words_of(data, offsets, _IS_WORD)
    words, window = mixed(word_hashes(data, starts, ends) + np.uint64(1)), lengths[-1]
    counts = np.maximum(np.diff(heads) - window + 1, 0)
    before = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) + np.repeat(heads[:-1] - before, counts)
    found, rolling = [], np.zeros(max(0, len(words) - window + 1), np.uint64)
    for k in range(window):
        rolling = rolling * _M + words[k:len(rolling) + k]
        if k + 1 in lengths:
            found.append(mixed(rolling)[at])
    return found, counts


def packed(values: np.ndarray, kind=None) -> bytes:
    """Numbers byte plane by byte plane: of sorted or small ones most planes compress to nothing."""
    values = np.ascontiguousarray(values, kind or values.dtype)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpacked(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


@dataclass
class Partitioning:
    """Which prefix a suffix is grouped by, and the task of each group."""

    window: int
    prefixes: tuple[int, ...]
    buckets: int
    tasks: int
    #: per prefix length: whether the prefixes of a bucket begin more suffixes than a group may have
    frequent: list[np.ndarray]

    @property
    def lengths(self) -> tuple[int, ...]:
        return (*self.prefixes, self.window)

    def tasks_of(self, hashes: list[np.ndarray]) -> np.ndarray:
        """The task of each suffix: by its shortest prefix that is not frequent, else by its whole window."""
        key = hashes[-1]
        for level in range(len(self.prefixes) - 1, -1, -1):
            often = self.frequent[level][(hashes[level] % np.uint64(self.buckets)).astype(np.int64)]
            key = np.where(often, key, hashes[level])
        return ((key >> np.uint64(20)) % np.uint64(self.tasks)).astype(np.int32)


def partitioning(docs: DataFrame, text_col: str, window: int = WINDOW, prefixes: tuple[int, ...] = PREFIXES,
                 tasks: int | None = None) -> Partitioning:
    """Counts prefixes over all documents and marks the frequent ones.

    The driver sees one number per bucket and prefix length: about eight buckets for each
    task of four million suffixes, at least 65,536. A group has at most an eighth of a task.
    """
    prefixes = tuple(p for p in prefixes if p < window)
    lengths, levels = (*prefixes, window), len(prefixes)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = 1 << max(16, math.ceil(math.log2(max(1, 2 * size / TASK_SUFFIXES))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = np.zeros((levels, buckets), np.int64), 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                hashes, counts = suffix_hashes(data, offsets, lengths)
                n += int(counts.sum())
                for level in range(levels):
                    totals[level] += np.bincount((hashes[level] % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        slices = [np.array([n]), *totals.reshape(-1, SLICE)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, len(slices) - 1), pa.int32()), pa.array([packed(s) for s in slices], pa.binary())], names=["slice", "counts"]
        )

    def add_up(table: pa.Table) -> pa.Table:
        total = sum(unpacked(part, np.int64) for part in table["counts"].to_pylist())
        return pa.table({"slice": table["slice"].slice(0, 1), "counts": [packed(total)]})

    schema = "slice INT, counts BINARY"
    summed = docs.select(text_col).mapInArrow(count, schema).groupBy("slice").applyInArrow(add_up, schema)
    parts = {r["slice"]: unpacked(bytes(r["counts"]), np.int64) for r in summed.collect()}
    suffixes = int(parts[-1][0]) if parts else 0
    wanted = math.ceil(suffixes / TASK_SUFFIXES)
    tasks = tasks or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)
    limit = suffixes // (8 * tasks)
    counts = np.concatenate([parts.get(i, np.zeros(SLICE, np.int64)) for i in range(levels * buckets // SLICE)] or [np.zeros(0)])
    return Partitioning(window, prefixes, buckets, tasks, list((counts > limit).reshape(levels, buckets)))


#: What tasks and chunks send each other; see the writers of each kind for a to f.
_ROWS = "task INT, chunk BIGINT, kind INT, a BINARY, b BINARY, c BINARY, d BINARY, e BINARY, f BINARY"
_NAMES = ["task", "chunk", "kind", "a", "b", "c", "d", "e", "f"]
_OWN, _ENTRIES, _ANSWER = 0, 1, 2


def _batch(rows: list[tuple]) -> dict:
    columns = [list(column) for column in zip(*rows)] or [[] for _ in _NAMES]
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
    return {name: pa.array(column, kind) for name, column, kind in zip(_NAMES, columns, kinds)}


def chunk_rows(number: int, hashes: list[np.ndarray], ids: np.ndarray, texts: np.ndarray, counts: np.ndarray, split: Partitioning) -> list[tuple]:
    """One row with entries for every task, and one with what stays with the chunk.

    A *place* is the number of a suffix in the chunk, documents in the order of their ids.
    """
    order = np.argsort(ids, kind="stable")
    ids, texts = ids[order], texts[order]
    sizes = counts[order]
    begins = np.concatenate([[0], np.cumsum(sizes)])
    moved = np.repeat((np.cumsum(counts) - counts)[order] - begins[:-1], sizes) + np.arange(begins[-1])
    hashes = [level[moved] for level in hashes]
    document = np.repeat(np.arange(len(ids)), sizes)
    by = np.argsort(hashes[-1], kind="stable")  # equal windows stay in the order of their places
    task = split.tasks_of(hashes)[by]
    by = by[np.argsort(task, kind="stable")]
    task, window = np.sort(task), hashes[-1][by]
    new = np.ones(len(by), bool)
    new[1:] = (window[1:] != window[:-1]) | (task[1:] != task[:-1])
    heads, again = np.flatnonzero(new), np.flatnonzero(~new)
    first = by[heads]
    first_of = first[(np.cumsum(new) - 1)[again]]
    # Of a window's further places in the chunk, those with a later id go; those with the id of the first share its lot.
    same = ids[document[by[again]]] == ids[document[first_of]]
    own = (
        number % split.tasks, number, _OWN, packed(begins, np.uint32), packed(ids, np.int64), packed(texts, np.int64),
        packed(np.sort(by[again[~same]]), np.uint32), packed(first_of[same], np.uint32), packed(by[again[same]], np.uint32),
    )
    rows, cuts = [own], np.searchsorted(task[heads], np.arange(split.tasks + 1))
    for part in range(split.tasks):
        low, high = cuts[part], cuts[part + 1]
        if low < high:
            places = first[low:high]
            here = np.zeros(len(ids), bool)
            here[document[places]] = True
            rows.append((
                part, number, _ENTRIES, packed(window[heads[low:high]]), packed(places, np.uint32),
                packed(ids[here], np.int64), packed(begins[:-1][here], np.uint32), None, None,
            ))
    return rows


def _chunks(split, id_index: int = 0):
    """Cuts the documents of a task in chunks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = split.load()
        base, parts, size = TaskContext.get().partitionId() << 24, [], 0

        def flush() -> pa.RecordBatch:
            levels = [np.concatenate(level) for level in zip(*(p[0] for p in parts))]
            rest = [np.concatenate(column) for column in list(zip(*parts))[1:]]
            return pa.RecordBatch.from_pydict(_batch(chunk_rows(base, levels, *rest, known)))

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_numpy()
            for first, end, data, offsets in text_slices(batch.column(2)):
                hashes, counts = suffix_hashes(data, offsets, known.lengths)
                holds = counts > 0
                if holds.any():
                    parts.append((hashes, ids[first:end][holds], texts[first:end][holds], counts[holds]))
                    size += int(counts.sum())
                if size >= CHUNK_SUFFIXES:
                    yield flush()
                    base, parts, size = base + 1, [], 0
        if parts:
            yield flush()

    return cut


def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The subtrees of one task: answers each chunk which of its entries a document with a smaller id has too."""
    chunks, hashes, places, ids = [], [], [], []
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        own = np.flatnonzero(kinds == _OWN)
        if len(own):
            yield batch.take(pa.array(own))
        for row in np.flatnonzero(kinds == _ENTRIES).tolist():
            a, b, c, d = (batch.column(name)[row].as_py() for name in "abcd")
            chunks.append(batch.column("chunk")[row].as_py())
            hashes.append(unpacked(a, np.uint64))
            places.append(unpacked(b, np.uint32))
            ids.append(unpacked(c, np.int64)[np.searchsorted(unpacked(d, np.uint32), places[-1], side="right") - 1])
    if not chunks:
        return
    sizes = [len(p) for p in places]
    window, place, document = np.concatenate(hashes), np.concatenate(places), np.concatenate(ids)
    hashes = ids = None
    leaves = np.lexsort((document, window))
    window, sorted_ids = window[leaves], document[leaves]
    node = np.ones(len(leaves), bool)
    node[1:] = window[1:] != window[:-1]
    smallest = sorted_ids[np.flatnonzero(node)][np.cumsum(node) - 1]
    later = np.zeros(len(leaves), bool)
    later[leaves[sorted_ids > smallest]] = True
    rows, at = [], 0
    for chunk, size in zip(chunks, sizes):
        gone = place[at:at + size][later[at:at + size]]
        if len(gone):
            rows.append((0, chunk, _ANSWER, packed(np.sort(gone)), None, None, None, None, None))
        at += size
    yield pa.RecordBatch.from_pydict(_batch(rows))


def _spans(window: int):
    """Puts the answers for a chunk together: the maximal repeats of its documents, as spans of words."""
    span = pa.struct([("word", pa.int64()), ("words", pa.int64())])

    def assemble(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["kind"] == _OWN)
        begins, ids, texts = unpacked(own["a"], np.uint32).astype(np.int64), unpacked(own["b"], np.int64), unpacked(own["c"], np.int64)
        answered = np.concatenate([np.zeros(0, np.uint32), *(unpacked(r["a"], np.uint32) for r in rows if r["kind"] == _ANSWER)])
        first, further = unpacked(own["e"], np.uint32), unpacked(own["f"], np.uint32)
        gone = np.zeros(int(begins[-1]), bool)
        gone[unpacked(own["d"], np.uint32)] = True
        gone[answered] = True
        gone[further[gone[first]]] = True
        places = np.flatnonzero(gone)
        document = np.searchsorted(begins, places, side="right") - 1
        starts = np.ones(len(places), bool)
        starts[1:] = (np.diff(places) > 1) | (np.diff(document) > 0)
        heads = np.flatnonzero(starts)
        words = places[heads] - begins[document[heads]]
        lengths = np.diff(np.append(heads, len(places))) + window - 1
        cut = np.flatnonzero(np.append(True, np.diff(document[heads]) > 0)) if len(heads) else np.zeros(0, np.int64)
        spans = pa.StructArray.from_arrays([pa.array(words.astype(np.int64)), pa.array(lengths.astype(np.int64))], fields=list(span))
        owner = document[heads[cut]]
        lists = pa.ListArray.from_arrays(pa.array(np.append(cut, len(heads)).astype(np.int32)), spans)
        return pa.table({"id": pa.array(ids[owner]), "text_hash": pa.array(texts[owner]), "spans": lists})

    return assemble


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   prefixes: tuple[int, ...] = PREFIXES, tasks: int | None = None) -> DataFrame:
    """(id, text_hash, spans): where documents hold words that a document with a smaller id has too.

    A span is a maximal run of words covered by such windows that begin at consecutive words. Documents without any have no row.
    """
    spark = docs.sparkSession
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    texts = texts.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    split = partitioning(texts, "text", window, prefixes, tasks)
    chunks = texts.mapInArrow(_chunks(Shipped(spark, split)), _ROWS)
    answers = chunks.repartitionById(split.tasks, F.col("task")).mapInArrow(resolve, _ROWS)
    spans = answers.groupBy("chunk").applyInArrow(_spans(window), "id BIGINT, text_hash BIGINT, spans ARRAY<STRUCT<word: BIGINT, words: BIGINT>>")
    return spans.groupBy("id", "text_hash").agg(F.max("spans").alias("spans"))  # repeated rows have the same


def without(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """The words outside all spans (first word, number of words), which ascend and may overlap."""
    kept, at = [], 0
    for word, count in spans:
        kept += words[at:word]
        at = max(at, word + count)
    return kept + words[at:]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [None if s is None else [(x["word"], x["words"]) for x in s] for s in batch.column("spans").to_pylist()]
        for first, end, data, offsets in text_slices(batch.column("text")):
            raw, cuts, texts, sizes, gone = data.tobytes(), offsets.tolist(), [], [], []
            for row, (a, b) in enumerate(zip(cuts, cuts[1:]), first):
                words = raw[a:b].split()
                kept = without(words, spans[row]) if spans[row] else words
                texts.append(b" ".join(kept).decode())
                sizes.append(len(words))
                gone.append(len(words) - len(kept))
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), part.column("spans")],
                names=["row", "kept", "n_words", "n_removed", "spans"],
            )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """``docs`` with only the words that are not repeats, joined by one space; adds ``n_words``, ``n_removed`` and ``repeats``.

    ``repeats`` are the maximal repeats of the text as it was: first word and number of words.
    """
    found = sized(repeated_spans(docs, id_col, text_col, window, **options), "repeats")
    others = [c for c in docs.columns if c not in (text_col, *OUTPUTS)]
    rows = docs.select(
        carried.packed(others).alias("row"), F.col(text_col).alias("text"), F.col(id_col).cast("bigint").alias("own_id"), F.xxhash64(text_col).alias("own_hash"),
    )
    met = rows.join(found, (F.col("own_id") == F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    kind = rows.schema["row"].dataType.simpleString()
    spans = "ARRAY<STRUCT<word: BIGINT, words: BIGINT>>"
    done = met.select("row", "text", "spans").mapInArrow(
        _remove, f"row {kind}, kept STRING, n_words BIGINT, n_removed BIGINT, spans {spans}"
    )
    empty = F.array().cast(spans)
    named = {c: F.col("row").getField(c).alias(c) for c in others} | {text_col: F.col("kept").alias(text_col)}
    return done.select(
        *[named[c] for c in docs.columns if c in named], "n_words", "n_removed", F.coalesce("spans", empty).alias("repeats")
    )
