"""Toxicity scores from a weighted lexicon, matched by an Aho-Corasick automaton.

Folding: lower case, look-alike letters of other scripts and digits that stand
for letters become plain letters (l and 1 both become i), and everything that
is no letter becomes one blank. A pattern is a word's beginning or a whole word
after folding.

The lexicon is learned from labelled documents of the training folds: word
beginnings of 4 to 8 letters and whole words that enough toxic documents hold,
weighted by the log ratio of how often toxic and other documents hold them.
Patterns that a shorter one already stands for are left out. Exception phrases
are learned as well: full words that begin like a pattern but occur in clean
documents only; a match inside one counts nothing. A document's evidence is the
sum of its matches' weights, taken once as such (logarithmically) and once
normalised by its number of words; a logistic curve fitted to the same documents
turns both into a score. Of each class about TRAIN_ROWS documents are learned
from, chosen by a hash of their id; their ids are few enough to broadcast.

Texts are scored where they lie. Only counts per pattern are shuffled, and what
the tasks get is the lexicon, whose patterns come from those rows.

Defined cases: a null or empty text scores like one without a match; without
toxic labels the lexicon is empty and every score is 0; null labels and null
doc_ids teach nothing; equal rows give equal rows; labels that contradict each
other count as the higher one; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, tokens

SHORTEST, LONGEST = 4, 8
SUPPORT = 0.01  # share of the toxic training documents a pattern must be in
LEAST_SUPPORT = 3
LEAST_WEIGHT = 3.5
TRAIN_ROWS = 30_000  # labelled documents of each class to learn from
THRESHOLD = 0.7
HELD_OUT = 1
EVIDENCE, N_WORDS = "_evidence", "_n_words"

# fixed values: letters of other scripts, digits and signs that look like Latin letters
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ǀ": "i", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s",
    "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i",
}


class _Fold(dict):
    """Character map for ``str.translate`` that fills itself."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if 0xFF01 <= code <= 0xFF5E:  # full-width forms
            char = chr(code - 0xFEE0).lower()
        out = LOOK_ALIKES.get(char, char if char.isalpha() else " ")
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Folded text with a blank on either side."""
    return f" {text.lower().translate(_FOLD)} "


def patterns_of(text: str) -> set[str]:
    """Beginnings (" idio") and whole words (" idiot ") of a text."""
    found = set()
    for word in set(fold(text).split()):
        found.add(f" {word} ")
        for size in range(SHORTEST, min(LONGEST, len(word) - 1) + 1):
            found.add(f" {word[:size]}")
    return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part in tokens.slices(batch):
            columns = {n: part.column(n).to_pylist() for n in part.schema.names}
            yield columns, columns["text"]


def _count(batches):
    """Documents per pattern of a slice."""
    for _, texts in _texts(batches):
        seen: Counter = Counter()
        for text in texts:
            seen.update(patterns_of(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
            ["pattern", "docs"],
        )


def _counts(docs: DataFrame) -> DataFrame:
    found = docs.select("text").mapInArrow(_count, "pattern string, docs long")
    return found.groupBy("pattern").agg(F.sum("docs").alias("docs"))


def _words_with(beginnings: tuple[str, ...], known: frozenset):
    """Full words of a slice that begin like a pattern."""

    def words(batches):
        for _, texts in _texts(batches):
            seen: Counter = Counter()
            for text in texts:
                for word in set(fold(text).split()):
                    full = f" {word} "
                    if full not in known and full.startswith(beginnings):
                        seen[full] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                ["pattern", "docs"],
            )

    return words


class Lexicon:
    """Weighted patterns, exceptions with weight 0, and the curve (bias, log, rate)."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]):
        self.weights = weights | {word: 0.0 for word in exceptions}
        self.curve = (0.0, 0.0, 0.0)
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def evidence(self, text: str) -> tuple[float, int]:
        """Sum of the weights of the words matched, each by its longest pattern; words."""
        folded = fold(text)
        n_words = len(folded.split())
        if not self.weights or not n_words:
            return 0.0, n_words
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for pattern, weight in self.weights.items():
                self._automaton.add_word(pattern, (len(pattern), weight))
            self._automaton.make_automaton()
        # at each word's start the longest pattern decides, so an exception, a whole word, wins
        longest: dict[int, tuple[int, float]] = {}
        for end, found in self._automaton.iter(folded):
            start = end - found[0]
            if found > longest.get(start, (0, 0.0)):
                longest[start] = found
        return sum(w for _, w in longest.values()), n_words


def features(total: Column, n_words: Column) -> tuple[Column, Column]:
    """Evidence as such and per 100 words, both compressed."""
    per_100 = 100 * total / F.greatest(n_words, F.lit(1))
    return F.log1p(total), F.log1p(per_100)


def _names(keep: list[str]) -> list[str]:
    return [common.fresh(c, keep) for c in (EVIDENCE, N_WORDS)]


def evidence(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """``keep`` columns, and EVIDENCE and N_WORDS of every document under ``_names(keep)``."""
    total, size = _names(keep)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    schema += f", {total} double, {size} long"

    def match(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                found = [lexicon.evidence(t or "") for t in part.column("text").to_pylist()]
                totals, sizes = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep]
                    + [pa.array(totals, pa.float64()), pa.array(sizes, pa.int64())],
                    [*keep, total, size],
                )

    return docs.mapInArrow(match, schema)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton steps; both classes weigh the same."""
    x = np.column_stack([np.ones(len(x)), x])
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (share * (y - p)) - penalty @ beta
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3))


def _training_ids(labels: DataFrame, rows_per_class: int) -> DataFrame:
    """doc_id and toxic of labelled documents outside the held-out fold.

    Of a class with more than ``rows_per_class`` documents, those whose hash is
    low enough to make about that many.
    """
    known = (
        labels.where(fold_of(F.col("doc_id")) != HELD_OUT)
        .groupBy(F.col("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
        .where("toxic IN (0, 1)")
    )
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    steps = 1 << 30
    low_enough = F.lit(False)
    for toxic, n in counts.items():
        most = min(1.0, rows_per_class / n) * steps
        chosen = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(steps)) < int(most)
        low_enough = low_enough | ((F.col("toxic") == toxic) & chosen)
    return known.where(low_enough)


def learn(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, rows_per_class: int = TRAIN_ROWS
) -> Lexicon:
    """The lexicon of the labelled documents outside the held-out fold."""
    session.ship_package(spark)
    ids = _training_ids(labels, rows_per_class)
    texts = docs.select("doc_id", common.text_or_empty().alias("text"))
    # at most about 2 * rows_per_class ids; copies of a text would make its rare words look typical
    train = (
        texts.join(F.broadcast(ids), "doc_id")
        .groupBy(F.xxhash64("text").alias("row"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    )
    train = common.written(spark, train, "labelled")
    toxic, clean = train.where("toxic = 1"), train.where("toxic = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic:
        return Lexicon({}, [])
    least = max(LEAST_SUPPORT, math.ceil(SUPPORT * n_toxic))
    # weighed before they are gathered: what comes back are the patterns that tell
    counted = (
        _counts(toxic).where(F.col("docs") >= least)
        .join(_counts(clean).withColumnRenamed("docs", "clean"), "pattern", "left")
        .select("pattern", "docs", F.coalesce("clean", F.lit(0)).alias("clean"))
    )
    rate = (F.col("docs") + 0.5) / (n_toxic + 1)
    usual = (F.col("clean") + 0.5) / (n_clean + 1)
    rows = counted.where(F.log(rate / usual) >= LEAST_WEIGHT - 1e-9).collect()
    weights: dict[str, float] = {}
    for pattern, docs_with, clean_with in sorted(rows, key=lambda r: (len(r.pattern), r.pattern)):
        rate = (docs_with + 0.5) / (n_toxic + 1)
        usual = (clean_with + 0.5) / (n_clean + 1)
        weight = math.log(rate / usual)
        stem = max(
            (weights.get(pattern[:k], 0.0) for k in range(SHORTEST + 1, len(pattern))), default=0.0
        )
        if weight >= LEAST_WEIGHT and weight > stem + 1:
            weights[pattern] = weight
    lexicon = Lexicon(weights, _exceptions(toxic, clean, weights, least))
    sample = evidence(train, lexicon, ["toxic"])
    got = sample.select("toxic", *features(F.col(EVIDENCE), F.col(N_WORDS))).toPandas().to_numpy()
    lexicon.curve = fit_curve(got[:, 1:], got[:, 0])
    return lexicon


def _exceptions(toxic: DataFrame, clean: DataFrame, weights: dict, least: int) -> list[str]:
    beginnings = tuple(p for p in weights if not p.endswith(" "))
    if not beginnings:
        return []
    count = _words_with(beginnings, frozenset(weights))

    def words(docs: DataFrame) -> DataFrame:
        found = docs.select("text").mapInArrow(count, "pattern string, docs long")
        return found.groupBy("pattern").agg(F.sum("docs").alias("docs"))

    only_clean = words(clean).where(F.col("docs") >= least).join(words(toxic), "pattern", "left_anti")
    return sorted(r.pattern for r in only_clean.select("pattern").collect())


def score(
    spark: SparkSession, docs: DataFrame, lexicon: Lexicon, keep: list[str], name: str = "score"
) -> DataFrame:
    """``keep`` columns of every document and its score, 0 to 1, as ``name``."""
    session.ship_package(spark)
    text = docs.withColumn("text", common.text_or_empty()) if "text" not in keep else docs
    found = evidence(text.select(*dict.fromkeys([*keep, "text"])), lexicon, keep)
    bias, strength, rate = lexicon.curve
    total, per_100 = features(*map(F.col, _names(keep)))
    curve = 1 / (1 + F.exp(-(bias + strength * total + rate * per_100)))
    value = curve if lexicon.weights else F.lit(0.0)
    return found.select(*keep, value.alias(name))


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that score THRESHOLD or more."""
    lexicon = learn(spark, docs, labels)
    name = common.fresh("_score", docs.columns)
    scored = score(spark, docs, lexicon, docs.columns, name=name)
    return scored.where(F.col(name) < THRESHOLD).drop(name)
