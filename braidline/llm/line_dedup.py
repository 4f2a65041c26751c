"""Drop lines that many documents share, keeping them in the latest document.

A line's key is the line stripped of ASCII white space at both ends, with A-Z
lower-cased. Hashes of the keys are range-partitioned and sorted by document
and position; the rows stream by and all but the first document of a key that
enough documents hold are marked. What comes back is one compressed bitmap per
document, so the text itself takes no part in the search.

Keys that a large share of all lines carry (at most ``HOT_KEYS`` of them, seen
in a sample of documents) are counted before any shuffle instead, which needs
no task to hold all rows of such a key. Both ways give the same rows.

Defined cases: a null text is one empty line; null doc_ids together are one
document that comes before all others; rows that repeat a doc_id belong to one
document; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline.llm import common

MIN_CHARS = 20
MIN_DOCS = 3
HOT_KEYS = 1000
SAMPLE_ONE_IN = 16


def line_key(line: Column) -> Column:
    return common.ascii_lower(F.trim(line, F.lit(common.WHITE)))


def _documents(docs: DataFrame) -> DataFrame:
    text = common.text_or_empty()
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(common.LEAST_ID)).alias("d"),
        F.xxhash64(text).alias("row"),
        text.alias("body"),
    )


def _line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row (h1, h2, d, row, pos) per line whose key is long enough."""
    lines = docs.select("d", "row", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    keyed = lines.select("d", "row", "pos", line_key(F.col("line")).alias("k"))
    return keyed.where(F.length("k") >= min_chars).select(
        *common.pair_key(F.col("k")), "d", "row", "pos"
    )


def _hot_keys(spark: SparkSession, hashes: DataFrame) -> DataFrame:
    """At most ``HOT_KEYS`` keys that hold more than their share of the sample."""
    sample = hashes.where(F.pmod(F.xxhash64("d"), F.lit(SAMPLE_ONE_IN)) == 0)
    counts = sample.groupBy("h1", "h2").count()
    total = sample.count()
    least = max(total // HOT_KEYS, 8)
    rows = counts.where(F.col("count") > least).orderBy(F.desc("count")).limit(HOT_KEYS).collect()
    return spark.createDataFrame([(r.h1, r.h2) for r in rows], "h1 long, h2 long")


def _dropped_cold(hashes: DataFrame, min_docs: int, n: int) -> DataFrame:
    """Stream each key's documents from the largest id on and mark all but the first."""
    ranged = hashes.repartitionByRange(n, "h1", "h2")
    key = Window.partitionBy("h1", "h2")
    order = key.orderBy(F.desc("d"), "pos")
    # the document that makes a key frequent lies min_docs places behind the first
    ranked = ranged.withColumn("nth", F.dense_rank().over(key.orderBy(F.desc("d"))))
    ranked = ranked.withColumn("docs", F.max("nth").over(key))
    ranked = ranked.withColumn("first", F.first("d").over(order))
    return ranked.where((F.col("docs") >= min_docs) & (F.col("d") != F.col("first")))


def _dropped_hot(hashes: DataFrame, hot: DataFrame, min_docs: int) -> DataFrame:
    per_key = (
        hashes.join(F.broadcast(hot), ["h1", "h2"])
        .groupBy("h1", "h2")
        .agg(F.max("d").alias("first"), F.count_distinct("d").alias("docs"))
        .where(F.col("docs") >= min_docs)
    )
    # one row for each of at most HOT_KEYS keys
    return hashes.join(F.broadcast(per_key), ["h1", "h2"]).where(F.col("d") != F.col("first"))


def keep_bitmaps(
    spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Per document that loses lines: d, row, n_dropped, keep.

    ``keep`` is an array of (word, bits): bit b of word w is line 64 w + b, 0 if
    it is dropped. Words without a dropped line are left out. ``row`` is the hash
    of the text, which tells rows with the same doc_id apart.
    """
    hashes = common.written(spark, _line_hashes(_documents(docs), min_chars), "lines")
    hot = _hot_keys(spark, hashes)
    cold = hashes.join(F.broadcast(hot), ["h1", "h2"], "left_anti")
    columns = ["d", "row", "pos"]
    dropped = (
        _dropped_cold(cold, min_docs, common.partitions(spark))
        .select(columns)
        .union(_dropped_hot(hashes, hot, min_docs).select(columns))
    )
    bit = F.expr("shiftleft(1L, pos % 64)")
    in_words = dropped.groupBy("d", "row", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("gone")
    )
    return in_words.groupBy("d", "row").agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"),
        F.sort_array(
            F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))
        ).alias("keep"),
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` whose bit is set, joined again."""
    lines = F.split(text, "\n")
    count = F.expr("0L") + F.floor((F.size(lines) - 1) / 64)
    flags = common.let(
        F.map_from_entries(keep),
        lambda m: F.flatten(
            F.transform(
                F.sequence(F.lit(0), count.cast("int")),
                lambda w: common.let(
                    F.coalesce(m[w], F.lit(-1).cast("long")),
                    lambda bits: F.transform(
                        F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(bits, b)
                    ),
                ),
            )
        ),
    )
    marked = F.zip_with(lines, flags, lambda line, flag: F.when(flag == 1, line))
    return F.when(keep.isNull(), text).otherwise(F.array_join(F.array_compact(marked), "\n"))


def deduplicate_lines(
    spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the kept text."""
    bitmaps = keep_bitmaps(spark, docs, min_chars, min_docs)
    joined = _documents(docs).join(bitmaps, ["d", "row"], "left")
    return joined.select(
        F.when(F.col("d") != common.LEAST_ID, F.col("d")).alias("doc_id"),
        F.size(F.split("body", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        kept_text(F.col("body"), F.col("keep")).alias("kept"),
    )


def without_lines(
    spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``docs`` with the kept lines as text and their length as n_chars."""
    bitmaps = keep_bitmaps(spark, docs, min_chars, min_docs).select("d", "row", "keep")
    of_d, of_row, keep = (common.fresh(c, docs.columns) for c in ("_d", "_row", "_keep"))
    bitmaps = bitmaps.toDF(of_d, of_row, keep)
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(common.LEAST_ID))
    same = (d == F.col(of_d)) & (F.xxhash64(common.text_or_empty()) == F.col(of_row))
    joined = docs.join(bitmaps, same, "left")
    text = kept_text(F.col("text"), F.col(keep))
    return joined.select(
        *[
            text.alias("text") if c == "text"
            else F.length(text).cast("long").alias("n_chars") if c == "n_chars"
            else c
            for c in docs.columns
        ]
    )
