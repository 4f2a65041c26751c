r"""Phrases that occur more often than their parts suggest, mined per language.

Texts are lower-cased in A-Z and cut into pieces at ``[.,;:!?\x0A-\x0D]``,
pieces into words at blanks and tabs. A phrase is up to ``MOST_WORDS`` words in
a row inside a piece; it is frequent if it occurs at least ``threshold`` times
in its language.

Finding the frequent ones: hashes of all n-grams, counted within a task, are
dealt to slices of the hash range, one row of packed hashes for each task and
slice. A slice merges them into one Misra-Gries summary whose capacity exceeds
``SLACK`` times the slice's mass divided by the threshold. What a summary takes
off any count is less than ``threshold / SLACK``, so every frequent n-gram is
still there with the rest of its count; an n-gram goes if that rest and all that
was taken off do not make the threshold. Memory of a task is bounded by its
slice's mass over the threshold and by its buffer, whatever the number of
distinct n-grams. Hashes that fall together only add to a count.

Counting: the surviving hashes become a bit filter of at most ``most_bits``,
which is broadcast. A second pass over the texts keeps n-grams that pass it, and
whose shorter parts do, as words, counts them exactly within a task and then,
one row of phrases for each task and slice, over all tasks. The filter bounds
what is shuffled, not what is found.

Scoring: a phrase of a words cut after its first k words has l occurrences of
the first part and r of the rest and scores floor(1000 a n / (l r)); its lowest
cut counts. Both parts are frequent themselves, so the table of counts has them.

Defined cases: a null text is empty; a null language is ``und``; equal rows
count each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, tokens

THRESHOLD = 100
MOST_WORDS = 5
TOP = 2000
SLACK = 4
MOST_BITS = 1 << 28
BITS_PER_HASH = 24
PROBES = 4
BUFFER = 6_000_000  # hashes that a task gathers before it packs them
WINDOW = 1 << 20  # words whose n-grams are hashed at once

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], np.uint64
)

_MAPPED = np.arange(256, dtype=np.uint8)
_MAPPED[ord("A") : ord("Z") + 1] += 32
_MAPPED[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = ord("\n")
_MAPPED[ord("\t")] = ord(" ")


class Words:
    """The words of some texts: a dictionary, and for each word its id, piece and language."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        n = len(texts)
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), texts), "\n")
        raw = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
        mapped = _MAPPED[raw[: pc.binary_length(whole)[0].as_py()]]
        inside = (mapped != 32) & (mapped != 10)
        edge = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        words = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(mapped[inside])
        ).dictionary_encode()
        self.dictionary = words.dictionary
        self.ids = words.indices.to_numpy()
        self.piece = np.cumsum(mapped == 10, dtype=np.int32)[starts]
        sizes = pc.binary_length(texts).to_numpy() + 1
        langs = langs.dictionary_encode()
        self.langs = langs.dictionary
        doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
        self.lang = langs.indices.to_numpy()[doc]
        self.word_hash = _hashes(self.dictionary)
        self.lang_hash = _hashes(self.langs)

    def keys(self, most_words: int, bits: int):
        """(k, first position, hashes, whether within one piece) of all n-grams, in windows."""
        n = len(self.ids)
        for lo in range(0, n, WINDOW):
            hi, upto = min(lo + WINDOW, n), min(lo + WINDOW + most_words - 1, n)
            word = self.word_hash[self.ids[lo:upto]]
            piece = self.piece[lo:upto]
            lang = self.lang_hash[self.lang[lo:hi]]
            rolled = word
            for k in range(1, most_words + 1):
                if k > 1:
                    rolled = rolled[:-1] * _STEP + word[k - 1 :]
                m = min(hi - lo, len(rolled))
                mixed = (rolled[:m] + lang[:m]) ^ np.uint64(k)
                mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX[0]
                hashed = (mixed ^ (mixed >> np.uint64(29))) >> np.uint64(64 - bits)
                yield k, lo, hashed, piece[:m] == piece[k - 1 : k - 1 + m]


def _hashes(values: pa.Array) -> np.ndarray:
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _parts(batches):
    """Words of slices of the batches."""
    for batch in batches:
        for part in tokens.slices(batch):
            yield Words(part.column("text").cast(pa.string()), part.column("lang").cast(pa.string()))


def count_bits(threshold: int) -> int:
    """Bits of a packed count: counts end at their largest value, far above the threshold."""
    return max(16, threshold.bit_length() + 2)


def _packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values as compressed byte planes."""
    planes = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()
    return len(values).to_bytes(8, "little") + bytes([planes]) + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(body: bytes) -> np.ndarray:
    n, planes = int.from_bytes(body[:8], "little"), body[8]
    raw = pa.decompress(body[9:], n * planes, "zstd", asbytes=True) if n else b""
    out = np.zeros((n, 8), np.uint8)
    out[:, :planes] = np.frombuffer(raw, np.uint8).reshape(planes, n).T
    return out.view("<u8").reshape(-1)


def _summed(packed: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and their counts, capped, of sorted packed values."""
    keys = packed >> np.uint64(shift)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    cap = np.uint64((1 << shift) - 1)
    counts = np.add.reduceat(packed & cap, first) if len(first) else packed
    return keys[first], np.minimum(counts, cap)


SLICES = "slice int, kind int, mass long, keys binary, counts binary"


def _slice_counts(most_words: int, threshold: int, slices: int):
    shift = count_bits(threshold)
    bits = 64 - shift
    bounds = np.array([-((-i << bits) // slices) for i in range(1, slices)], np.uint64)

    def rows(gathered):
        packed = np.sort(np.concatenate(gathered))
        keys, counts = _summed(packed, shift)
        at = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
        out = []
        for s in range(slices):
            k, c = keys[at[s] : at[s + 1]], counts[at[s] : at[s + 1]]
            if len(k):
                out.append((s, 0, int(c.sum()), None, None))
                out.append((s, 1, 0, _packed(np.diff(k, prepend=np.uint64(0))), _packed(c)))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["slice", "kind", "mass", "keys", "counts"])

    def count(batches):
        gathered, held = [], 0
        for words in _parts(batches):
            for _, _, keys, whole in words.keys(most_words, bits):
                gathered.append((keys[whole] << np.uint64(shift)) | np.uint64(1))
                held += len(gathered[-1])
                if held >= BUFFER:
                    yield rows(gathered)
                    gathered, held = [], 0
        if held:
            yield rows(gathered)

    return count


class Summary:
    """A Misra-Gries summary of hashes with counts; summaries and counts are merged alike."""

    def __init__(self, capacity: int, shift: int):
        self.capacity, self.shift = capacity, shift
        self.keys = self.counts = np.zeros(0, np.uint64)
        self.taken = 0
        self._open: list[np.ndarray] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._open.append((keys << np.uint64(self.shift)) | counts)
        if sum(map(len, self._open)) > max(self.capacity, 1 << 20):
            self.merge()

    def merge(self) -> None:
        held = (self.keys << np.uint64(self.shift)) | self.counts
        self.keys, self.counts = _summed(np.sort(np.concatenate([held, *self._open])), self.shift)
        self._open = []
        over = len(self.counts) - self.capacity
        if over > 0:
            # the largest count that would not fit is taken off all
            least = np.partition(self.counts, over - 1)[over - 1]
            stay = self.counts > least
            self.keys, self.counts = self.keys[stay], self.counts[stay] - least
            self.taken += int(least)

    def frequent(self, threshold: int) -> np.ndarray:
        """All hashes whose count may reach the threshold."""
        self.merge()
        return self.keys[self.counts + np.uint64(self.taken) >= threshold]


def _survivors(threshold: int, slack: int):
    shift = count_bits(threshold)

    def done(summary):
        keys = summary.frequent(threshold).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])

    def merge(batches):
        current, mass, summary = None, 0, None
        for batch in batches:
            columns = [batch.column(c) for c in ("slice", "kind", "mass")]
            ids, kinds, masses = (c.to_pylist() for c in columns)
            for i, (s, kind, m) in enumerate(zip(ids, kinds, masses)):
                if s != current:
                    if summary is not None:
                        yield done(summary)
                    current, mass, summary = s, 0, None
                if kind == 0:  # the masses of a slice come before its hashes
                    mass += m
                    continue
                if summary is None:
                    summary = Summary(slack * mass // threshold + 1, shift)
                keys, counts = (_unpacked(batch.column(c)[i].as_py()) for c in ("keys", "counts"))
                summary.add(np.cumsum(keys, dtype=np.uint64), counts)
        if summary is not None:
            yield done(summary)

    return merge


def _probes(keys: np.ndarray, size: int, probe: int) -> np.ndarray:
    """Places of one probe in a filter of 2^size bits."""
    mixed = (keys + np.uint64(probe + 1)) * _MIX[probe]
    return (mixed ^ (mixed >> np.uint64(31))) * _STEP >> np.uint64(64 - size)


def _filter_bits(size: int):
    def bits(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            at = np.unique(np.concatenate([_probes(keys, size, p) for p in range(PROBES)]))
            place = at >> np.uint64(6)
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            if len(first):
                mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                arrays = [pa.array(place[first].view(np.int64)), pa.array(mask.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["place", "mask"])

    return bits


def survivors(
    spark: SparkSession, texts: DataFrame, threshold: int, most_words: int, slack: int = SLACK
) -> DataFrame:
    """key: a hash for each n-gram that may be frequent, all frequent ones included."""
    slices = common.partitions(spark)
    made = texts.mapInArrow(_slice_counts(most_words, threshold, slices), SLICES)
    dealt = made.repartitionById(slices, F.col("slice")).sortWithinPartitions("slice", "kind")
    return dealt.mapInArrow(_survivors(threshold, slack), "key long")


def bit_filter(spark: SparkSession, keys: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """The hashes as a bit filter of at most ``most_bits``."""
    wanted = min(most_bits, max(1 << 12, BITS_PER_HASH * keys.count()))
    size = min(wanted - 1, most_bits - 1).bit_length()
    found = keys.mapInArrow(_filter_bits(size), "place long, mask long")
    found = found.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(1 << (size - 6), np.uint64)
    if found.num_rows:
        words[found.column("place").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return words


def _passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    size = len(words).bit_length() + 5
    left = np.arange(len(keys))
    for p in range(PROBES):
        at = _probes(keys[left], size, p)
        left = left[(words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0]
    out = np.zeros(len(keys), bool)
    out[left] = True
    return out


COUNTS = "lang string, phrase string, k int, f long"
DEALT = "slice int, lang array<string>, phrase array<string>, k array<int>, f array<long>"


def _exact_counts(shipped, most_words: int, threshold: int, slices: int):
    bits = 64 - count_bits(threshold)

    def table(langs, phrases, k, f):
        arrays = [langs, phrases, pa.array(np.full(len(f), k, np.int32)), pa.array(f.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "k", "f"])

    def of(words: Words, filter_words):
        per_lang = np.bincount(words.lang, minlength=len(words.langs))
        yield table(words.langs, pa.array([""] * len(words.langs)), 0, per_lang)
        found: dict[int, list] = {k: [] for k in range(1, most_words + 1)}
        for k, lo, keys, whole in words.keys(most_words, bits):
            if k == 1:
                before = np.flatnonzero(_passes(filter_words, keys))
            else:
                # both parts that are one word shorter must have passed; at the
                # end of a window the later part is looked at in the next one
                at = before[np.append(passed, True)[before + 1]]
                at = at[at < len(keys)]
                at = at[whole[at]]
                before = at[_passes(filter_words, keys[at])]
            passed = np.zeros(len(keys), bool)
            passed[before] = True
            found[k].append(before + lo)
        number = np.zeros(len(words.ids), np.int64)
        phrases = None
        for k in range(1, most_words + 1):
            at = np.concatenate(found[k]) if found[k] else np.zeros(0, np.int64)
            if not len(at):
                return
            tail = words.ids[at + k - 1].astype(np.int64)
            head = words.lang[at].astype(np.int64) if k == 1 else number[at]
            # exact: a phrase is the number of its head and its last word
            pairs, first, inverse, f = np.unique(
                (head << 32) | tail, return_index=True, return_inverse=True, return_counts=True
            )
            last = words.dictionary.take(pa.array(pairs & 0xFFFFFFFF))
            if k == 1:
                phrases = last
            else:
                phrases = pc.binary_join_element_wise(phrases.take(pa.array(pairs >> 32)), last, " ")
            number[at] = inverse
            yield table(words.langs.take(pa.array(words.lang[at[first]])), phrases, k, f)

    def count(batches):
        filter_words = shipped.value
        held, rows = [], 0
        for words in _parts(batches):
            for made in of(words, filter_words):
                held.append(made)
                rows += made.num_rows
            if rows > 1 << 20:
                yield dealt(_combined(held))
                held, rows = [], 0
        if held:
            yield dealt(_combined(held))

    def dealt(table: pa.Table) -> pa.RecordBatch:
        """One row for each slice with all its phrases."""
        slice_of = (_hashes(table.column("phrase")) % np.uint64(slices)).astype(np.int64)
        order = np.argsort(slice_of, kind="stable")
        present, first = np.unique(slice_of[order], return_index=True)
        offsets = pa.array(np.append(first, len(order)), pa.int32())
        columns = [pa.array(present, pa.int32())]
        for name in ("lang", "phrase", "k", "f"):
            values = table.column(name).take(pa.array(order)).combine_chunks()
            columns.append(pa.ListArray.from_arrays(offsets, values))
        return pa.RecordBatch.from_arrays(columns, ["slice", "lang", "phrase", "k", "f"])

    return count


def _combined(parts: list) -> pa.Table:
    """The same counts with equal phrases added up."""
    parts = [pa.Table.from_batches([p]) if isinstance(p, pa.RecordBatch) else p for p in parts]
    summed = pa.concat_tables(parts).group_by(["lang", "phrase", "k"]).aggregate([("f", "sum")])
    return summed.rename_columns(["lang", "phrase", "k", "f"])


def _totals(threshold: int):
    """Phrases of a slice that make the threshold, with their counts."""

    def total(batches):
        held, rows = [], 0
        for batch in batches:
            names = ["lang", "phrase", "k", "f"]
            held.append(pa.Table.from_arrays([batch.column(c).flatten() for c in names], names))
            rows += held[-1].num_rows
            if rows > 1 << 21:
                held = [_combined(held)]
                rows = 0
        if held:
            summed = _combined(held)
            often = pc.or_(pc.greater_equal(summed["f"], threshold), pc.equal(summed["k"], 0))
            yield from summed.filter(often).to_batches(1 << 16)

    return total


def frequent(
    spark: SparkSession,
    docs: DataFrame,
    threshold: int = THRESHOLD,
    most_words: int = MOST_WORDS,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """lang, phrase, k (words), f of all phrases with at least ``threshold`` occurrences.

    One row per language with k = 0 has the number of its words.
    """
    session.ship_package(spark)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(common.text_or_empty().alias("text"), lang.alias("lang"))
    keys = common.written(spark, survivors(spark, texts, threshold, most_words), "survivors")
    shipped = spark.sparkContext.broadcast(bit_filter(spark, keys, most_bits))
    slices = common.partitions(spark)
    counted = texts.mapInArrow(_exact_counts(shipped, most_words, threshold, slices), DEALT)
    met = counted.repartitionById(slices, F.col("slice"))
    return common.written(spark, met.mapInArrow(_totals(threshold), COUNTS), "frequent")


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    threshold: int = THRESHOLD,
    most_words: int = MOST_WORDS,
    top: int = TOP,
    covered_percent: int = 100,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases.

    A phrase inside a longer frequent one with at least ``covered_percent`` of
    its count is dropped. Order: score and a descending, then the phrase.
    """
    counts = frequent(spark, docs, threshold, most_words)
    known = counts.where("k > 0").select("lang", "phrase", "f")
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    several = counts.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    worded = several.withColumn("w", F.split("phrase", " ", -1))

    length = F.sequence(F.lit(2), F.col("k") - 1)
    inner = F.flatten(
        F.transform(
            length,
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("k") - m + 1),
                lambda at: F.array_join(F.slice("w", at, m), " "),
            ),
        )
    )
    longer = (
        worded.where("k > 2")
        .select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    standing = worded.join(longer, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < covered_percent * F.col("a"))
    )
    cuts = standing.select(
        "lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")
    ).select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.size("w") - F.col("cut")), " ").alias("tail"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    whole = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .join(totals, "lang")
        .withColumns({f"_{c}": v for c, v in whole.items()})
        .withColumn("score", F.expr("(_a * _n * 1000) div (_l * _r)"))
    )
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        lowest.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
