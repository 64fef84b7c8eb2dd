"""Verbatim benchmark passages in documents, by suffix arrays over shards of the documents.

A shard is one Arrow batch of documents. Its suffix array holds the word positions from
which a whole window of benchmark words follows (no other suffix can match a window),
sorted by that many words. Every benchmark suffix is cut to its window and looked up by
binary search; the windows found at consecutive places of a document and of an item make one match.

Only beginnings of matches are paired: a place and a use of one window whose windows before
differ. So a repetitive text against a repetitive item costs the number of its longest
matches, not of its equal windows; lengths come from a binary search over hashes of runs of windows. For
each place and item the longest match that begins there is kept.

The benchmark goes to the tasks in blocks of bounded size, one after the other: the driver and
the tasks hold one block at a time. With one block, the usual case, the documents are read
once and never shuffled. More blocks mean as many passes: what a block finds is stored by a
128-bit hash of the text, and joined to the documents of the last pass.

Defined cases: NULL and empty texts have no words; an item without words matches nothing;
an item of fewer than ``min_words`` words matches as a whole; repeated rows are documents
of their own, repeated items count once; empty tables give no match; columns named like an
output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rosterline.llm import carried
from rosterline.llm.byte_words import lower_table, text_slices, word_hashes, words_of
from rosterline.llm.shipping import Shipped
from rosterline.workspace import sized

BLOCK_BYTES = 4_000_000
MATCH = "item_id STRING, item_word BIGINT, word BIGINT, words BIGINT"
SPAN = "word BIGINT, words BIGINT"
OUTPUTS = ["n_words", "n_hit", "items", "matches"]
PAIRS = 1 << 20

_LOWER = lower_table()
#: Words are runs of digits, letters a-z after lower-casing, and everything outside ASCII.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


_STEP = np.uint64(0x9FB21C651E98DF25)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


class Runs:
    """Hashes of runs of a sequence of numbers: equal runs have equal hashes, wherever they stand."""

    def __init__(self, numbers: np.ndarray):
        mixed = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(numbers), _STEP, np.uint64)]))
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(numbers), _BACK, np.uint64)]))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * powers[:-1])])

    def hashes(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.back[at]


class Uses:
    """The windows of one length in a block's items, one after the other: *uses* of the different windows."""

    def __init__(self, windows: "Windows", size: int, items: list[tuple[int, list[int]]]):
        counts = np.array([len(own) - size + 1 for _, own in items])
        rows = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.array(own, np.int64), size) for _, own in items])
        keys = windows.packed(rows)
        by = np.lexsort(keys[::-1])
        new = np.ones(len(by), bool)
        new[1:] = np.any([key[by][1:] != key[by][:-1] for key in keys], axis=0)
        #: packed keys of the different windows, ascending
        self.keys = [key[by][new] for key in keys]
        self.window = np.empty(len(by), np.int64)
        self.window[by] = np.cumsum(new) - 1
        self.item = np.repeat([row for row, _ in items], counts)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        self.word = np.arange(len(by)) - first
        self.left = np.repeat(counts, counts) - self.word
        self.before = np.where(self.word > 0, np.concatenate([[-1], self.window[:-1]]), -1)
        #: uses by window, then by the window before
        self.order = np.lexsort((self.before, self.window))
        self.cuts = np.searchsorted(self.window[self.order], np.arange(len(self.keys[0]) + 1))
        pairs = self.window[self.order] * (len(self.keys[0]) + 1) + self.before[self.order] + 1
        self.pairs = pairs
        self.runs = Runs(self.window)
        #: the different items of each window
        own = np.unique(np.column_stack([self.window, self.item]), axis=0)
        self.owners, self.owner_cuts = own[:, 1], np.searchsorted(own[:, 0], np.arange(len(self.keys[0]) + 1))


class Windows:
    """The windows of one block of benchmark items, as numbers of its own vocabulary."""

    def __init__(self, items: list[tuple[str, str]], min_words: int):
        texts = pa.array([text for _, text in items], pa.string())
        self.items = [item for item, _ in items]
        number: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[int, int, list[int]]]] = {}
        for first, _, data, offsets in text_slices(texts):
            data = _LOWER[data]
            starts, ends, heads = words_of(data, offsets, _IS_WORD)
            raw = data.tobytes()
            ids = [number.setdefault(raw[s:e], len(number)) for s, e in zip(starts.tolist(), ends.tolist())]
            for row in range(len(offsets) - 1):
                own = ids[heads[row]:heads[row + 1]]
                if own:
                    by_length.setdefault(min(min_words, len(own)), []).append((first + row, own))
        self.words = list(number)
        self.bits = max(1, len(number).bit_length())
        starts = np.cumsum([0, *map(len, self.words)])
        hashes = word_hashes(np.frombuffer(b"".join(self.words), np.uint8), starts[:-1], starts[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.likely = np.zeros(1 << 16, bool)
        self.likely[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
        #: by window length
        self.lengths = {size: Uses(self, size, own) for size, own in by_length.items()}

    def packed(self, windows: np.ndarray) -> list[np.ndarray]:
        """Columns of word numbers as few integer keys, which sort alike."""
        per = 62 // self.bits
        keys = []
        for first in range(0, windows.shape[1], per):
            key = np.zeros(len(windows), np.int64)
            for column in range(first, min(first + per, windows.shape[1])):
                key = (key << self.bits) | windows[:, column]
            keys.append(key)
        return keys

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The vocabulary number of each word, -1 for others (told apart by hash only)."""
        hashes = word_hashes(data, starts, ends)
        numbers = np.full(len(starts), -1, np.int64)
        maybe = np.flatnonzero(self.likely[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        at[at == len(self.hashes)] = 0
        same = self.hashes[at] == hashes[maybe]
        numbers[maybe[same]] = self.order[at[same]]
        return numbers


def _bound(key: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of each wanted value in its own sorted range of ``key``."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = np.minimum((low + high) >> 1, len(key) - 1)
        less = (key[middle] <= wanted) if after else (key[middle] < wanted)
        low = np.where(open_ & less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    return low


class Shard:
    """Suffixes of one batch of documents; finds windows in them."""

    def __init__(self, windows: Windows):
        self.windows = windows
        self.found: dict[int, list] = {size: [] for size in windows.lengths}
        self.n_words: list[np.ndarray] = []

    def add(self, first: int, data: np.ndarray, offsets: np.ndarray) -> None:
        data = _LOWER[data]
        starts, ends, heads = words_of(data, offsets, _IS_WORD)
        self.n_words.append(np.diff(heads))
        if not len(starts) or not self.found:
            return
        numbers = self.windows.numbers(data, starts, ends)
        index = np.arange(len(numbers))
        row = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
        bad = np.where(numbers < 0, index, len(numbers))
        run = np.minimum(np.minimum.accumulate(bad[::-1])[::-1], heads[row + 1]) - index
        shortest = np.flatnonzero(run >= min(self.found))
        if not len(shortest):
            return
        # Hashes only chose the words; those that matter are now compared byte by byte.
        inside = np.unique(np.concatenate([*self._spread(shortest, run)]))
        raw, words = data.tobytes(), self.windows.words
        wrong = [i for i in inside.tolist() if raw[starts[i]:ends[i]] != words[numbers[i]]]
        if wrong:
            bad[wrong] = wrong
            run = np.minimum(np.minimum.accumulate(bad[::-1])[::-1], heads[row + 1]) - index
        for size, found in self.found.items():
            at = np.flatnonzero(run >= size)
            if len(at):
                keys = self.windows.packed(numbers[at[:, None] + np.arange(size)])
                found.append((keys, first + row[at], at - heads[row[at]]))

    @staticmethod
    def _spread(at: np.ndarray, run: np.ndarray) -> Iterator[np.ndarray]:
        """The words of the runs that begin at ``at``: consecutive starts share them."""
        yield at
        last = at[np.append(np.diff(at) > 1, True)]
        yield np.repeat(last, run[last]) + np.concatenate([np.arange(n) for n in run[last].tolist()])

    def matches(self) -> dict[int, tuple[list[dict], list[dict], list[str]]]:
        """Row -> its longest matches, the spans of words inside any, the items."""
        found: dict[int, tuple[list[dict], list[tuple[int, int]], set[str]]] = {}
        names = self.windows.items
        for size, parts in self.found.items():
            if not parts:
                continue
            uses = self.windows.lengths[size]
            keys = [np.concatenate([part[0][k] for part in parts]) for k in range(len(uses.keys))]
            rows, words = (np.concatenate([part[k] for part in parts]) for k in (1, 2))
            suffixes = np.lexsort(keys[::-1])
            low = np.zeros(len(uses.keys[0]), np.int64)
            high = np.full(len(uses.keys[0]), len(suffixes), np.int64)
            for key, want in zip(keys, uses.keys):
                key = key[suffixes]
                low, high = _bound(key, low, high, want, False), _bound(key, low, high, want, True)
            held = np.maximum(high - low, 0)
            window = np.repeat(np.arange(len(held)), held)
            at = suffixes[np.arange(len(window)) - np.repeat(np.cumsum(held) - held, held) + np.repeat(low, held)]
            by = np.lexsort((words[at], rows[at]))
            row, word, window = rows[at][by], words[at][by], window[by]
            for r, a, n in self._spans(row, word, size):
                found.setdefault(r, ([], [], set()))[1].append((a, n))
            for r, item in self._owners(uses, row, window):
                found[r][2].add(names[item])
            for place, item, item_word, n in self._longest(uses, row, word, window):
                found[int(row[place])][0].append(dict(item_id=names[item], item_word=item_word, word=int(word[place]), words=n + size - 1))
        return {
            r: (matches, [dict(word=a, words=n) for a, n in spans], sorted(items)) for r, (matches, spans, items) in found.items()
        }

    @staticmethod
    def _spans(row: np.ndarray, word: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """Rows and spans of words covered by windows that begin at consecutive words."""
        heads = np.flatnonzero(np.append(True, (np.diff(row) > 0) | (np.diff(word) > 1))) if len(row) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(row)))
        return zip(row[heads].tolist(), word[heads].tolist(), (counts + size - 1).tolist())

    @staticmethod
    def _owners(uses: Uses, row: np.ndarray, window: np.ndarray) -> set[tuple[int, int]]:
        """Rows and the items that hold one of their windows."""
        different = np.unique(np.column_stack([row, window]), axis=0)
        counts = (uses.owner_cuts[1:] - uses.owner_cuts[:-1])[different[:, 1]]
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(uses.owner_cuts[different[:, 1]], counts)
        return set(zip(np.repeat(different[:, 0], counts).tolist(), uses.owners[at].tolist()))

    @staticmethod
    def _longest(uses: Uses, row: np.ndarray, word: np.ndarray, window: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(place, item, first word in the item, windows) of the longest match of each place and item that begins there."""
        together = np.append(False, (np.diff(row) == 0) & (np.diff(word) == 1))
        before = np.where(together, np.append(-1, window[:-1]), -1)
        ends = np.append(np.flatnonzero(~together)[1:], len(row)) if len(row) else np.zeros(0, np.int64)
        left = np.repeat(ends, np.diff(np.append(np.flatnonzero(~together), len(row)))) - np.arange(len(row))
        runs, kinds = Runs(window), len(uses.keys[0]) + 1
        # Uses of the window but for those after the same window: two stretches of the order.
        low, high = uses.cuts[window], uses.cuts[window + 1]
        skip = np.searchsorted(uses.pairs, window * kinds + before + 1, side="left")
        skip_end = np.where(before < 0, skip, np.searchsorted(uses.pairs, window * kinds + before + 1, side="right"))
        skip = np.where(before < 0, high, skip)
        skip_end = np.where(before < 0, high, skip_end)
        counts = (skip - low) + (high - skip_end)
        total = np.cumsum(counts)
        first = 0
        while first < len(row):
            end = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + PAIRS, side="right")))
            n = counts[first:end]
            place = np.repeat(np.arange(first, end), n)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ahead = skip[place] - low[place]
            use = uses.order[np.where(nth < ahead, low[place] + nth, skip_end[place] + nth - ahead)]
            size = Shard._common(uses.runs, use, runs, place, np.minimum(uses.left[use], left[place]))
            best = np.lexsort((uses.word[use], -size, uses.item[use], place))
            new = np.ones(len(best), bool)
            new[1:] = (np.diff(place[best]) > 0) | (np.diff(uses.item[use][best]) != 0)
            best = best[new]
            yield from zip(place[best].tolist(), uses.item[use][best].tolist(), uses.word[use][best].tolist(), size[best].tolist())
            first = end

    @staticmethod
    def _common(a: Runs, at: np.ndarray, b: Runs, place: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many numbers from there on are the same, at least 1 and at most ``most``."""
        low, high = np.ones(len(at), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            same = a.hashes(at, middle) == b.hashes(place, middle)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low


def _covered(matches: Column) -> Column:
    """The number of words inside any match."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m.word.alias("a"), (m.word + m.words).alias("b"))))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach"))
    return F.aggregate(
        spans, start,
        lambda acc, s: F.struct(
            (acc.n + F.greatest(F.lit(0).cast("bigint"), s.b - F.greatest(s.a, acc.reach))).alias("n"),
            F.greatest(acc.reach, s.b).alias("reach"),
        ),
        lambda acc: acc.n,
    )


def locate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_words: int = 10,
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` with ``n_words``, ``n_hit``, ``items`` and ``matches``.

    ``matches`` holds the longest verbatim matches: item, its first matching word, the
    document's first matching word, and the number of words. ``items`` are the distinct
    matching items, sorted as strings.
    """
    keep = [c for c in (keep or docs.columns) if c not in OUTPUTS]
    found = _located(docs, benchmark, text_col, item_col, item_text_col, min_words, keep, block_bytes)
    own = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in keep]
    return found.select(*own, *OUTPUTS)


def _located(
    docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, min_words: int, keep: list[str], block_bytes: int
) -> DataFrame:
    """``row`` (the kept columns but the text, as one struct), ``text`` and the outputs."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    items = items.where("text IS NOT NULL AND item_id IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))

    def block(number: int) -> Shipped:
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        return Shipped(spark, Windows([(r["item_id"], r["text"]) for r in own.collect()], min_words))

    # Texts are told apart by 128 bits; what does not depend on the row is found once per pass.
    key = [F.xxhash64(text_col).alias("k1"), F.xxhash64(F.lit("second"), F.col(text_col)).alias("k2")]
    earlier = []
    for number in range(blocks - 1):
        windows = block(number)
        hits = docs.where(F.col(text_col).isNotNull()).select(*key, F.col(text_col).alias("text")).mapInArrow(
            _searcher(windows, ["k1", "k2"], all_rows=False), f"k1 BIGINT, k2 BIGINT, n_words BIGINT, {_FOUND}"
        )
        earlier.append(sized(hits.drop("n_words").dropDuplicates(["k1", "k2"]), "benchmark-block"))
        windows.release()
    rows = docs.select(carried.packed([c for c in keep if c != text_col]).alias("row"), F.col(text_col).alias("text"), *key)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    found = rows.mapInArrow(_searcher(block(blocks - 1), ["row", "text", "k1", "k2"], all_rows=True), f"{kinds}, n_words BIGINT, {_FOUND}")
    if earlier:
        more = reduce(DataFrame.unionByName, earlier).groupBy(F.col("k1").alias("m1"), F.col("k2").alias("m2")).agg(
            *[F.flatten(F.collect_list(c)).alias(f"more_{c}") for c in ("matches", "spans", "items")]  # one entry per block
        )
        found = found.join(more, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left")
        found = found.withColumns({
            c: F.when(F.col(f"more_{c}").isNull(), F.col(c)).otherwise(F.concat(c, f"more_{c}")) for c in ("matches", "spans", "items")
        })
    ids = F.array_sort(F.array_distinct("items"))
    return found.select("row", "text", "n_words", _covered(F.col("spans")).alias("n_hit"), ids.alias("items"), "matches")


_FOUND = f"matches ARRAY<STRUCT<{MATCH}>>, spans ARRAY<STRUCT<{SPAN}>>, items ARRAY<STRING>"


def _searcher(windows: Shipped, names: list[str], all_rows: bool):
    match = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("word", pa.int64()), ("words", pa.int64())])
    span = pa.struct([("word", pa.int64()), ("words", pa.int64())])
    nothing: tuple = ([], [], [])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows.load()
        for batch in batches:
            shard = Shard(known)
            for first, _, data, offsets in text_slices(batch.column("text")):
                shard.add(first, data, offsets)
            matches = shard.matches()
            rows = range(batch.num_rows) if all_rows else sorted(matches)
            counts = np.concatenate([np.zeros(0, np.int64), *shard.n_words])
            if not all_rows:
                batch, counts = batch.take(pa.array(rows, pa.int64())), counts[rows]
            columns = [*(batch.column(name) for name in names), pa.array(counts, pa.int64())]
            for part, kind in enumerate((match, span, pa.string())):
                columns.append(pa.array([matches.get(row, nothing)[part] for row in rows], pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "matches", "spans", "items"])

    return search


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    min_words: int = 10, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with its own columns, less every document in which a benchmark window occurs."""
    found = _located(docs, benchmark, text_col, item_col, item_text_col, min_words, docs.columns, block_bytes).where("n_hit = 0")
    return found.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
