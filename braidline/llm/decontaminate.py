r"""Find benchmark passages in documents by a prefix-filtered join.

Words are the runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z. A
window is WINDOW consecutive words of an item, or the whole item if it is
shorter. To find a window exactly, it is enough to look for one of its
shingles (prefix length 1 at a containment of 1), so each window is indexed by
its rarest shingle, by occurrences in all documents. Document shingles probe
that index; a hit fixes where the window would start (positional bound) and
whether it still fits the document (length bound), and only then are its words
compared one by one.

Documents are never shuffled, only what matched. The index is broadcast while
it has at most BROADCAST_WINDOWS windows; beyond that, document shingles are
shuffled to it and the candidates are joined with their documents for the
comparison. Both ways give the same rows.

Defined cases: a null or wordless text has no words and no hits; items without
words have no window; items that share an item_id are one item, those with a
null item_id mark words but are not listed; rows that repeat a document give
one result row each; either table may be empty; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline.llm import common

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
BROADCAST_WINDOWS = 200_000
DOCUMENT = -1  # stands for the document itself among the windows


def _words(table: DataFrame, *columns: str) -> DataFrame:
    text = common.text_or_empty()
    return table.select(
        *columns,
        F.xxhash64(text).alias("row"),
        common.words(common.ascii_lower(text), GAP).alias("w"),
    ).withColumn("n", F.size("w"))


def _shingle(size: int, at: str = "i"):
    return F.xxhash64(F.lit(size), *[F.get("w", F.col(at) + k) for k in range(size)])


def windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows of all items: win (its words), len, item_id."""
    worded = _words(items, "item_id").where("n > 0")
    worded = worded.withColumn("len", F.least("n", F.lit(window)))
    return worded.select(
        "item_id", "len", "w", F.explode(F.expr("sequence(0, n - len)")).alias("i")
    ).select("item_id", "len", F.slice("w", F.col("i") + 1, F.col("len")).alias("win")).distinct()


def _document_shingles(docs: DataFrame, sizes: list[int], with_document: bool) -> DataFrame:
    """Each document's shingles with their place; place -1 is the document itself."""
    first = DOCUMENT if with_document else 0
    last = F.col("n") - min(sizes, default=1)
    some = docs if with_document else docs.where(last >= 0)
    placed = some.select(
        "*", F.explode(F.sequence(F.lit(first), F.greatest(last, F.lit(first)))).alias("i")
    )
    by_size = [F.when(F.col("i") + s <= F.col("n"), _shingle(s)) for s in sizes]
    if len(by_size) == 1:
        token = by_size[0]
    elif by_size:
        token = F.explode(F.array_compact(F.array(*by_size)))
    else:
        token = F.lit(None).cast("long")
    if not with_document:
        return placed.select("*", token.alias("token"))
    if len(by_size) <= 1:
        return placed.select(
            "*", F.when(F.col("i") < 0, F.lit(DOCUMENT)).otherwise(token).alias("token")
        )
    lone = F.array(F.lit(DOCUMENT).cast("long"))
    tokens = F.when(F.col("i") < 0, lone).otherwise(F.array_compact(F.array(*by_size)))
    return placed.select("*", F.explode(tokens).alias("token"))


def rarest_shingles(docs: DataFrame, wins: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """Index of the windows by their rarest shingle: token, off, win, len, win_id."""
    per_window = wins.select("win_id", "win", "len", F.col("win").alias("w"))
    parts = [
        per_window.where(F.least("len", F.lit(SHINGLE)) == s)
        .withColumn("i", F.explode(F.expr(f"sequence(0, len - {s})")))
        .withColumn("token", _shingle(s))
        for s in sizes
    ]
    placed = parts[0]
    for part in parts[1:]:
        placed = placed.unionByName(part)
    wanted = placed.select("token").distinct()
    seen = _document_shingles(docs, sizes, with_document=False).select("token")
    counts = (
        seen.join(F.broadcast(wanted) if small else wanted, "token")
        .groupBy("token")
        .agg(F.count("*").alias("times"))
    )
    ranked = placed.join(counts, "token").select(
        "win_id", "win", "len", F.struct("times", "token", "i").alias("rank")
    )
    best = ranked.groupBy("win_id").agg(F.min("rank").alias("best"), F.first("win").alias("win"))
    return best.select(
        F.col("best.token").alias("token"),
        F.col("best.i").alias("off"),
        "win",
        F.size("win").alias("len"),
        "win_id",
    )


def _matches(docs: DataFrame, index: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """doc_id, row, n, start, len, win_id; one row with win_id -1 for each document."""
    document = index.sparkSession.createDataFrame(
        [(DOCUMENT, 0, [], 0, DOCUMENT)],
        "token long, off int, win array<string>, len int, win_id long",
    )
    start = F.col("i") - F.col("off")
    fits = (F.col("win_id") == DOCUMENT) | ((start >= 0) & (start + F.col("len") <= F.col("n")))
    equal = (F.col("win_id") == DOCUMENT) | (
        F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len")) == F.col("win")
    )
    columns = ["doc_id", "row", "n", start.alias("start"), "len", "win_id"]
    if small:
        probes = _document_shingles(docs, sizes, with_document=True)
        found = probes.join(F.broadcast(index.unionByName(document)), "token")
        return found.where(fits & equal).select(columns)
    probes = _document_shingles(docs, sizes, with_document=False).drop("w")
    candidates = probes.join(index, "token").where(fits).select(
        "doc_id", "row", "i", "off", "len", "win", "win_id"
    )
    texts = docs.dropDuplicates(["doc_id", "row"])
    same = (F.col("c.doc_id").eqNullSafe(F.col("t.doc_id"))) & (F.col("c.row") == F.col("t.row"))
    verified = (
        candidates.alias("c")
        .join(texts.alias("t"), same)
        .select("c.doc_id", "c.row", "t.n", "t.w", "c.i", "c.off", "c.len", "c.win", "c.win_id")
        .where(equal)
        .select(columns)
    )
    whole = docs.select(
        "doc_id", "row", "n", F.lit(DOCUMENT).alias("start"), F.lit(0).alias("len"),
        F.lit(DOCUMENT).cast("long").alias("win_id"),
    )
    return verified.unionByName(whole)


def contamination(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Per document: doc_id, row, n_words, n_hit, item_ids (sorted as strings).

    ``row`` is the hash of the text and tells rows with one doc_id apart.
    """
    of_items = common.written(spark, windows(items, window), "windows")
    named = of_items.select("win", "len").distinct()
    named = named.select(F.xxhash64("win").alias("h"), "win", "len")
    # windows whose hashes collide get different ids
    order = Window.partitionBy("h").orderBy("win")
    named = named.withColumn("win_id", F.xxhash64("h", F.row_number().over(order)))
    wins = common.written(spark, named.select("win_id", "win", "len"), "window-ids")
    size = F.least("len", F.lit(SHINGLE)).alias("size")
    per_size = {r["size"]: r["count"] for r in wins.groupBy(size).count().collect()}
    sizes, small = sorted(per_size), sum(per_size.values()) <= broadcast_windows
    worded = _words(docs, "doc_id")
    if sizes:
        rarest = common.written(spark, rarest_shingles(worded, wins, sizes, small), "rarest")
    else:
        rarest = spark.createDataFrame(
            [], "token long, off int, win array<string>, len int, win_id long"
        )
    found = common.written(spark, _matches(worded, rarest, sizes, small), "matches")

    key = ["doc_id", "row"]
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    new = F.greatest(end - F.greatest("start", "reached"), F.lit(0))
    is_document = F.col("win_id") == DOCUMENT
    per_document = (
        found.withColumn("reached", reached)
        .groupBy(*key)
        .agg(
            F.max("n").cast("long").alias("n_words"),
            F.sum(F.when(~is_document, new).otherwise(0)).cast("long").alias("n_hit"),
            F.sum(is_document.cast("int")).cast("int").alias("copies"),
        )
    )
    hit_windows = found.where(~is_document).select(*key, "win_id").distinct()
    ids = of_items.where("item_id IS NOT NULL").join(wins, ["win", "len"]).select("win_id", "item_id")
    listed = (
        hit_windows.join(ids, "win_id")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    same = F.col("p.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("p.row") == F.col("l.row"))
    joined = per_document.alias("p").join(listed.alias("l"), same, "left")
    return joined.select(
        "p.doc_id",
        "p.row",
        "n_words",
        "n_hit",
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def without_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that hold a window of an item."""
    found = contamination(spark, docs, items).where("n_hit > 0")
    of_doc, of_row = (common.fresh(c, docs.columns) for c in ("_doc", "_row"))
    hit = found.select(F.col("doc_id").alias(of_doc), F.col("row").alias(of_row)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(of_doc)) & (
        F.xxhash64(common.text_or_empty()) == F.col(of_row)
    )
    return docs.join(hit, same, "left_anti")
