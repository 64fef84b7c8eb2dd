"""Toxicity of texts that hide their words: restore by noisy channel, then score.

A token with digits or signs among or instead of letters, with repeated letters, or spelt out with
separators is decoded, however long it is: each character gives a few readings (itself, the letters it stands
for, nothing, a word break), and Viterbi search over this lattice finds the reading of
least cost under a character trigram model and the cost of each substitution. A token without letters may also be
read as it stands, at the cost of so many arbitrary digits. The trigram
counts are taken over all texts. Words of the restored text, and beginnings of words, are
the features of a logistic model fitted on labelled rows that are not held out. A word whose
letters are at most doubled, as in plain spelling, also counts as it stands; a spelt-out run
with wider gaps is read both as a whole and between them.

The fit uses about ``max_rows`` labelled rows, chosen by a hash of the id; if there are
fewer, all. Its features are those most typical of either label, at most ``max_features``.

Defined cases: NULL and empty texts have no features and get the model's base score;
repeated rows are scored each; several labels of a document count as the greatest; without
labelled rows every score is 0; an empty table gives an empty table; columns named like an
output are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rosterline.llm.byte_words import text_slices
from rosterline.llm.shipping import Shipped
from rosterline.workspace import sized

MAX_ROWS = 16_000
MAX_FEATURES = 4_000
THRESHOLD = 0.3
SYMBOLS = 28  # word break, a-z, any other letter
PREFIXES = (4, 5, 6, 7)
CACHED_WORDS = 250_000

#: Letters that a sign can stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i",
}
SEPARATORS = set(" ._-*~'`^/\\,:;")
COST_DIGIT = 2.3  # of ten, any
COST_SUBSTITUTE, COST_SKIP, COST_REPEAT, COST_BREAK, COST_DROP, COST_DROP_LETTER = 0.7, 0.3, 0.4, 2.5, 2.0, 5.0

_OPENING = "\"'([{<.,;:?*#%&-_/\\~`^=»«“”„¿…–—"
_CLOSING = "\"')]}>.,;:?!*#%&-_/\\~`^=»«“”„…–—"
_STRETCHED = re.compile(r"(.)\1\1")
_DOUBLED = re.compile(r"(.)\1")
# From three letters on, from and to any sign; the end of "don't" is no beginning. Signs can stand for letters, some only inside.
_UNIT, _GAPS = r"[^\W_]|[@$€£]", r"[\s._\-*]{1,4}"
_SPELT = re.compile(rf"(?<![^\W_])(?<![^\W_]['’])(?:{_UNIT}){_GAPS}(?:(?:{_UNIT}|[!|+]){_GAPS})+(?:{_UNIT})(?![^\W_])")
_GAP = re.compile(r"[._\-*]\s|\s{2,}|\n")
_LETTERS = re.compile(r"[^\W\d_]+")

_BYTE_SYMBOL = np.zeros(256, np.int64)
_BYTE_SYMBOL[97:123] = np.arange(1, 27)
_BYTE_SYMBOL[65:91] = np.arange(1, 27)
_BYTE_SYMBOL[192:] = 27


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each three symbols follow one another, over all texts; summed per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                data = np.insert(data, offsets[1:-1], 32)  # texts do not run into one another
                symbols = _BYTE_SYMBOL[data[(data < 128) | (data >= 192)]]
                if len(symbols) > 2:
                    total += np.bincount(symbols[:-2] * 784 + symbols[1:-1] * 28 + symbols[2:], minlength=SYMBOLS ** 3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["gram", "n"])

    counts = np.zeros(SYMBOLS ** 3, np.int64)
    rows = docs.select(text_col).mapInArrow(count, "gram BIGINT, n BIGINT").groupBy("gram").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # at most 28^3
        counts[row["gram"]] = row["n"]
    return counts


class Decoder:
    """Restores tokens under a trigram model."""

    def __init__(self, counts: np.ndarray):
        grid = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.2
        self.cost = (-np.log(grid / grid.sum(axis=2, keepdims=True))).tolist()

    @staticmethod
    def symbol(char: str) -> int:
        return ord(char) - 96 if "a" <= char <= "z" else 27 if char.isalpha() else 0

    def readings(self, char: str) -> list[tuple[str, float]]:
        """What a character can mean: text and cost."""
        if char.isalpha():
            return [(char, 0.0)]
        found = [(letter, COST_SUBSTITUTE) for letter in STANDS_FOR.get(char, "")]
        if char in SEPARATORS:
            return [*found, ("", COST_SKIP), (" ", COST_BREAK)]
        return [*found, ("", COST_DROP_LETTER if found else COST_DROP), (" ", COST_BREAK)]

    def decode(self, token: str) -> str:
        """The reading of least cost; repeated letters may count once."""
        return self.best(token)[1]

    def best(self, token: str) -> tuple[float, str]:
        """The least cost of a reading, and that reading."""
        cost = self.cost
        # A reading is a chain (reading before, letter), so readings share their beginnings.
        # Whether it has begun is part of the state: only then can its last letter, or break, repeat.
        states = {(0, 0, False): (0.0, None)}
        before = ""
        for char in token:
            after: dict[tuple[int, int, bool], tuple[float, tuple | None]] = {}
            options = self.readings(char)
            for (a, b, begun), (so_far, chain) in states.items():
                for letter, price in options:
                    if not letter:
                        state, total, grown = (a, b, begun), so_far + price, chain
                    else:
                        c = self.symbol(letter)
                        state, total, grown = (b, c, True), so_far + price + cost[a][b][c], (chain, letter)
                    if state not in after or total < after[state][0]:
                        after[state] = (total, grown)
                if begun and char == before and chain[1] in [letter for letter, _ in options if letter]:
                    total = so_far + COST_REPEAT
                    if (a, b, True) not in after or total < after[a, b, True][0]:
                        after[a, b, True] = (total, chain)
            states, before = after, char
        total, chain = min(((so_far + cost[a][b][0], chain) for (a, b, _), (so_far, chain) in states.items()), key=lambda end: end[0])
        letters = []
        while chain:
            chain, letter = chain
            letters.append(letter)
        return total, "".join(reversed(letters))

    def words(self, token: str) -> list[str]:
        """The words that a lower-case token, or a run of spelt-out letters, stands for."""
        core = token.lstrip(_OPENING).rstrip(_CLOSING)
        if core.isalpha() and not _DOUBLED.search(core):
            return [core]
        if not any(c.isalpha() for c in core):
            return self.signs(token)
        decoded = self.decode(core).split()
        return [core, *decoded] if core.isalpha() and not _STRETCHED.search(core) else decoded


    def signs(self, token: str) -> list[str]:
        """The words of a token without letters: none if it reads better as it stands, as numbers do."""
        core = token.strip("\"'.,;:?*#%&-_/\\~`^=»«“”„¿…–—)]}>[{<")
        if sum(c in STANDS_FOR for c in core) < 2:
            return []
        cost, words = self.best(core)
        return words.split() if cost < COST_DIGIT * len(core) else []


def tokens(text: str) -> set[str]:
    """The different tokens of a text, spelt-out words as one token each."""
    lowered = text.lower()
    runs = _SPELT.findall(lowered)
    return {*lowered.split(), *runs, *(part for run in runs for part in _GAP.split(run) if _SPELT.fullmatch(part))}


def features(words: list[str]) -> set[int]:
    """Hashes of words and of their beginnings."""
    found = set()
    for word in words:
        found.add(xxhash.xxh64_intdigest("w" + word) >> 1)
        found.update(xxhash.xxh64_intdigest("p" + word[:n]) >> 1 for n in PREFIXES if len(word) > n)
    return found


def _texts(column: pa.Array) -> Iterator[str]:
    return (text or "" for text in column.to_pylist())


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """Rows (text, toxic) of about ``max_rows`` labelled documents that are not held out, stored."""
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("toxic"))
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))
    # Broadcast: about max_rows rows of two numbers, whatever the size of the tables.
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
    return sized(texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("text", "toxic"), "labelled-sample")


def held_out(doc_id) -> F.Column:
    """Rows kept for evaluation: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Model:
    """Weights by feature hash, and how to score a text with them."""

    def __init__(self, counts: np.ndarray, hashes: list[int], weights: np.ndarray, base: float | None):
        self.counts, self.index = counts, {h: i for i, h in enumerate(hashes)}
        self.weights, self.base = weights, base

    def reader(self):
        """A function from text to the set of its feature numbers; it remembers tokens."""
        decoder, index, known = Decoder(self.counts), self.index, {}
        nothing: tuple[int, ...] = ()

        def read(text: str) -> set[int]:
            found: set[int] = set()
            for token in tokens(text):
                own = known.get(token)
                if own is None:
                    own = tuple(index[h] for h in features(decoder.words(token)) if h in index) or nothing
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    known[token] = own
                if own:
                    found.update(own)
            return found

        return read

    def score(self, numbers: set[int]) -> float:
        if self.base is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.base + self.weights[list(numbers)].sum(), -30, 30))))


def typical_features(sample: DataFrame, counts: np.ndarray, max_features: int, rows: tuple[int, int]) -> list[int]:
    """Features whose share of toxic documents differs most from the whole, by likelihood ratio."""
    sent = Shipped(sample.sparkSession, counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, known = Decoder(sent.load()), {}
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                seen: list[int] = []
                toxic: list[int] = []
                for text, label in zip(_texts(part.column(0)), part.column(1).to_pylist()):
                    found: set[int] = set()
                    for token in tokens(text):
                        own = known.get(token)
                        if own is None:
                            if len(known) >= CACHED_WORDS // 4:
                                known.clear()
                            own = known[token] = features(decoder.words(token))
                        found |= own
                    seen += found
                    toxic += [label] * len(found)
                hashes, place = np.unique(np.array(seen, np.int64), return_inverse=True)
                bad = np.bincount(place.reshape(-1), weights=toxic, minlength=len(hashes)).astype(np.int64)
                all_ = np.bincount(place.reshape(-1), minlength=len(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(all_), pa.array(bad)], names=["h", "n", "bad"])

    clean, bad = rows
    base = bad / max(1, clean + bad)
    summed = sample.mapInArrow(count, "h BIGINT, n BIGINT, bad BIGINT").groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, b = F.col("n"), F.col("bad")
    gain = b * F.log((b + 0.01) / (n * base)) + (n - b) * F.log((n - b + 0.01) / (n * (1 - base)))
    best = summed.where("n >= 3").select("h", gain.alias("gain")).where("gain > 3").orderBy(F.desc("gain"), "h").limit(max_features)
    return [row["h"] for row in best.collect()]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
) -> Model:
    """A model from the character statistics of all of ``docs`` and a sample of its labelled rows."""
    counts = trigram_counts(docs, text_col)
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, max_rows)
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    rows = (sizes.get(0, 0), sizes.get(1, 0))
    if not all(rows):
        base = None if not sum(rows) else (6.0 if rows[1] else -6.0)
        return Model(counts, [], np.zeros(0), base)
    model = Model(counts, typical_features(sample, counts, max_features, rows), np.zeros(0), None)
    sent = Shipped(docs.sparkSession, model)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = sent.load().reader()
        for batch in batches:
            numbers = [sorted(read(text)) for text in _texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.list_(pa.int32())), batch.column(1)], names=["f", "toxic"])

    found = sample.mapInArrow(index, "f ARRAY<INT>, toxic INT").collect()
    found.sort(key=lambda row: (row["f"], row["toxic"]))
    model.weights, model.base = _logistic([row["f"] for row in found], np.array([row["toxic"] for row in found], float), len(model.index))
    return model


def _logistic(rows: list[list[int]], labels: np.ndarray, width: int, penalty: float = 0.5, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and base of a logistic model on sparse 0/1 features, by accelerated gradient steps."""
    column = np.array([f for row in rows for f in row], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    base = np.log(labels.mean() / (1 - labels.mean()))
    weights, ahead, ahead_base = np.zeros(width), np.zeros(width), base
    # Per coordinate: an upper bound of the curvature, as every row spreads over its own features.
    spread = np.array([len(r) + 1 for r in rows], float)
    reach = np.bincount(column, weights=spread[row], minlength=width) / 4 + penalty
    reach_base = spread.sum() / 4
    for step in range(steps):
        z = ahead_base + np.bincount(row, weights=ahead[column], minlength=len(rows))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        new = ahead - (np.bincount(column, weights=error[row], minlength=width) + penalty * ahead) / reach
        new_base = ahead_base - error.sum() / reach_base
        momentum = step / (step + 3)
        ahead, ahead_base = new + momentum * (new - weights), new_base + momentum * (new_base - base)
        weights, base = new, new_base
    return weights, float(base)


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` with ``score`` and ``predicted``."""
    keep = [c for c in (keep or docs.columns) if c not in ("score", "predicted")]
    sent = Shipped(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.load()
        read = own.reader()
        for batch in batches:
            scores = [own.score(read(text)) for text in _texts(batch.column(text_col))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores, pa.float64())], names=[*keep, "score"])

    source = docs.select(*(keep if text_col in keep else [*keep, text_col]))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keep]
    result = source.mapInArrow(run, ", ".join([*kinds, "score DOUBLE"]))
    return result.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, less those the model predicts to be toxic."""
    model = fit(docs, labels, id_col, text_col)
    hold = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    kept = scored(hold, model, "text", ["row"]).where("predicted = 0")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
