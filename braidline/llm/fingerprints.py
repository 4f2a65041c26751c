"""Document fingerprints by one-permutation MinHash.

A text's words are the runs between ASCII white space after lower-casing; its
shingles are WORDS consecutive words (all words if there are fewer). Each
shingle is hashed once: the top bits choose one of BINS bins, the rest is its
value, and a bin keeps its least value. An empty bin draws bins by hashes of its
own number until it meets a filled one and takes over that value: optimal
densification, where two sets with the same filled bins borrow alike. Of each value the lowest BITS bits are packed into words,
written in hexadecimal. The share of equal positions of two fingerprints is
corrected for positions that agree by chance, 2^-BITS of those that differ.

Everything is expressions on the row, so fingerprints add no shuffle.

Defined cases: a null text is empty; texts without words have a fingerprint of
their own ("-"), alike only to each other; equal rows give equal rows; a null
doc_id comes after all others in descending order; of several rows with one
doc_id, the one with the least hash of its text is the next document of the
rows before; if there is one doc_id only, its document is its own next one; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline.llm import common

WORDS = 5
BINS = 256
BITS = 4
EMPTY = "-"
DRAWS = 6


def _shingle_hashes(text: Column, n_words: int) -> Column:
    def of_words(w: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(0), F.size(w) - n_words),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n_words)]),
        )
        return F.when(F.size(w) >= n_words, several).otherwise(F.array(F.xxhash64(w)))

    return common.let(
        F.transform(common.words(F.lower(text)), lambda x: F.xxhash64(x)), of_words
    )


def _least_per_bin(hashes: Column, bins: int) -> Column:
    """Array of the bins: the least value of each, null where it is empty.

    Sorted as signed numbers, a bin's hashes stand together, the least first; the
    array starts at the bin of the most negative hashes and ends with the last
    filled one.
    """
    width = 64 - (bins.bit_length() - 1)

    def place(x: Column) -> Column:
        return (F.shiftright(x, width) + bins // 2).cast("int")

    def of_sorted(h: Column) -> Column:
        firsts = F.filter(h, lambda x, i: (i == 0) | (place(x) != place(F.get(h, i - 1))))
        return common.let(firsts, of_firsts)

    def of_firsts(f: Column) -> Column:
        none = F.lit(None).cast("long")

        def with_gap(x: Column, i: Column) -> Column:
            before = F.coalesce(place(F.get(f, i - 1)), F.lit(-1))
            return F.concat(F.array_repeat(none, place(x) - before - 1), F.array(x))

        return F.flatten(F.transform(f, with_gap))

    return common.let(F.sort_array(hashes), of_sorted)


def fingerprint(
    text: Column, n_words: int = WORDS, bins: int = BINS, bits: int = BITS
) -> Column:
    """The packed fingerprint in hexadecimal, or "-" for a text without words."""
    per_word = 64 // bits
    low = (1 << bits) - 1

    def packed(found: Column) -> Column:
        def drawn(b: Column, t: int) -> Column:
            return F.get(found, F.pmod(F.xxhash64(b, F.lit(t)), F.lit(bins)).cast("int"))

        def value(b: Column) -> Column:
            # hardly ever are all draws empty; then the filled bins are ranked for this one
            ranked = F.array_min(
                F.filter(
                    F.transform(
                        found, lambda v, j: F.when(v.isNotNull(), F.struct(F.xxhash64(b, j).alias("h"), v.alias("v")))
                    ),
                    lambda entry: entry.isNotNull(),
                )
            )["v"]
            draws = [drawn(b, t) for t in range(DRAWS)]
            return F.coalesce(F.get(found, b), *draws, ranked).bitwiseAND(F.lit(low))

        def word(k: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(0), F.lit(per_word - 1)),
                F.lit(0).cast("long"),
                lambda acc, j: F.call_function("shiftleft", acc, F.lit(bits)).bitwiseOR(
                    value(k * per_word + j)
                ),
            )

        words = F.transform(F.sequence(F.lit(0), F.lit(bins // per_word - 1)), word)
        return F.array_join(F.transform(words, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")

    wordless = ~text.rlike(r"[^\x20\x09-\x0D]")
    whole = common.let(_least_per_bin(_shingle_hashes(text, n_words), bins), packed)
    return F.when(wordless, F.lit(EMPTY)).otherwise(whole)


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Estimated resemblance of two fingerprints, 0 to 1."""
    digits = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int"))
    # with 4 bits a position is one hexadecimal digit
    same = F.aggregate(digits, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
    chance = 2.0**-bits
    corrected = (same / F.length(a) - chance) / (1 - chance)
    one_empty = (a == EMPTY) | (b == EMPTY)
    return (
        F.when(a == b, F.lit(1.0))
        .when(one_empty, F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected)))
    )


def next_documents(spark: SparkSession, ids: DataFrame) -> DataFrame:
    """(d, next_d) for every distinct d: the next smaller one, after the least the largest.

    Ids are dealt to ranges; a window inside each range finds the neighbours, and
    a window over one row per range the neighbours across ranges.
    """
    n = common.partitions(spark)
    ranged = ids.select("d").distinct().repartitionByRange(n, "d")
    ranged = common.written(spark, ranged.withColumn("part", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("part").orderBy(F.desc("d"))
    ends = ranged.groupBy("part").agg(F.max("d").alias("top"))
    # one row per range
    below = ends.withColumn("below", F.lag("top").over(Window.orderBy("part")))
    first = ends.agg(F.max("top")).scalar()
    return (
        ranged.withColumn("next_d", F.lead("d").over(inside))
        .join(F.broadcast(below), "part")
        .select("d", F.coalesce("next_d", "below", first).alias("next_d"))
    )


def with_edits(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Edited: the last third of the text (rounded down) replaced by as much of the
    beginning of the next document. Only that beginning and the next document's
    fingerprint travel to the document they belong to.
    """
    text = common.text_or_empty()
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(common.LEAST_ID)).alias("d"),
        text.alias("body"),
        F.length(text).alias("n"),
    )
    sizes = rows.groupBy("d").agg(
        F.max("n").alias("n"), F.min(F.xxhash64("body")).alias("row")
    )
    sizes = common.written(spark, sizes, "sizes")
    # what each document has to send, and to which
    order = next_documents(spark, sizes).join(sizes, "d").select(
        F.col("d").alias("to"), F.col("next_d").alias("d"), F.floor(F.col("n") / 3).alias("take")
    )
    order = order.join(sizes.select("d", F.col("row").alias("first")), "d")
    # both joins read the same shuffle, so they take the same columns
    marked = rows.select("d", "body", fingerprint(F.col("body")).alias("fp"))
    # (an equation of hash and first would become a key of the join and a shuffle of its own)
    is_first = F.xxhash64("body").bitwiseXOR(F.col("first")) == 0
    senders = marked.join(order, "d").where(is_first)
    sent = senders.select(
        F.col("to").alias("d"),
        F.col("body").substr(F.lit(1), F.col("take").cast("int")).alias("beginning"),
        F.col("fp").alias("next_fp"),
        F.xxhash64("to").alias("one"),
    )
    # equal rows of one doc_id send the same
    sent = sent.groupBy("d").agg(
        F.first("beginning").alias("beginning"), F.first("next_fp").alias("next_fp")
    )
    size = F.length("body")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(
        F.col("body").substr(F.lit(1), size - third),
        F.col("beginning").substr(F.lit(1), third),
    )
    joined = marked.join(sent, "d").select(
        "d", size.alias("n"), "fp", "next_fp", edited.alias("edited")
    )
    printed = joined.select(
        "d",
        "n",
        "fp",
        "next_fp",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("edited")).alias("edited_fp"),
    )
    return printed.select(
        F.when(F.col("d") != common.LEAST_ID, F.col("d")).alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
