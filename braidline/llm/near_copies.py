"""Links between texts whose five-word shingles are similar: Jaccard of at least 0.8.

Words and shingle hashes are those of ``fingerprints``. Texts with equal sets
of shingles are linked to one of them. The others are found in sorted order:

- a set's sketch is its ``SKETCH`` least hashes, as a sample of the set; each of
  ``BANDS`` bands draws ``KEY + ORDER`` MinHashes from it;
- a band is sorted by these MinHashes; rows that share the first ``KEY`` are
  compared with the next ``NEXT`` rows of the sort, by their sketches. That is
  at most BANDS * NEXT comparisons a row, however large a group of alike texts
  is. Ranges of the sort are walked by one task each; rows at the ends of ranges
  are walked once more together;
- pairs whose sketches are likely enough are settled by their whole sets: first
  each row's likeliest pair, then those pairs that still cross components.

The walk finds most links at little cost, but not all: two sets of Jaccard 0.8
share the key of a band with a probability of 0.51, and rows that share keys may
never be neighbours. An exact step settles the rest. In one order of all hashes,
common ones last, the first n - ceil(0.8 n) + 1 hashes of a set of n are its
prefix; two similar sets share a hash of their prefixes. All pairs that share
enough of them to be similar, and lie in different components of the walk's
links, are settled by their whole sets. So the components are those of all pairs.

Defined cases: texts without words are alike; a null text is empty; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, components, fingerprints

SIMILAR = 0.8
SKETCH = 64
BANDS = 8
KEY = 3
ORDER = 3
NEXT = 4
SENT = 40  # hashes of the sketch, 32 bits each, that travel with a row
LIKELY = 0.55  # of two sketches; below it a similar pair lies with a probability of 1e-4

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 for k in range(256)], np.uint64)


def _shingles(text: Column, n_words: int) -> Column:
    return F.array_distinct(fingerprints._shingle_hashes(text, n_words))


def _sketches(docs: DataFrame, n_words: int) -> DataFrame:
    """row (hash of the text), key (hash of its set), n (size), sketch (least hashes, sorted)."""
    text = common.text_or_empty()

    def of_sorted(s: Column) -> Column:
        return F.struct(
            F.xxhash64(s).alias("key"),
            F.size(s).alias("n"),
            F.slice(s, 1, SKETCH).alias("sketch"),
        )

    made = common.let(F.sort_array(_shingles(text, n_words)), of_sorted)
    return docs.select(F.xxhash64(text).alias("row"), made.alias("p")).select("row", "p.*")


def _alike(both: Column, a: Column, b: Column) -> Column:
    return both >= F.lit(SIMILAR) * (a + b - both) - 1e-9


ORDERED = [f"o{k}" for k in range(ORDER)]
PLACED = f"band int, bucket long, {', '.join(f'{o} long' for o in ORDERED)}, row long, n int, sent binary"


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    mixed = (values ^ (values >> np.uint64(29))) * _ODD[seed]
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _bands(batches):
    """A row for each set and band."""
    for batch in batches:
        lists = batch.column("sketch")
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy().view(np.uint64)
        # short sketches repeat their hashes, which changes no minimum
        at = np.arange(SKETCH) % np.maximum(sizes, 1)[:, None]
        starts = np.cumsum(sizes) - sizes
        sketch = flat[starts[:, None] + at]
        least = [_mixed(sketch, k).min(axis=1) for k in range(BANDS * (KEY + ORDER))]
        # the upper half of a hash keeps the order
        sent = (sketch[:, :SENT].view(np.int64) >> 32).astype(np.int32)
        packed = [s[:k].tobytes() for s, k in zip(sent, sizes.tolist())]
        for band in range(BANDS):
            own = least[band * (KEY + ORDER) : (band + 1) * (KEY + ORDER)]
            bucket = own[0]
            for x in own[1:KEY]:
                bucket = bucket * _STEP + x
            columns = [
                pa.array(np.full(len(sizes), band, np.int32)),
                pa.array(bucket.view(np.int64)),
                *[pa.array(x.view(np.int64)) for x in own[KEY:]],
                batch.column("row"),
                batch.column("n"),
                pa.array(packed, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["band", "bucket", *ORDERED, "row", "n", "sent"])


def _likeness(sent: list[bytes], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Estimated Jaccard of the sets i and j, of n hashes each, from their least hashes.

    Up to the smaller of the two largest hashes sent, both sets are known whole.
    """
    sizes = np.array([len(s) // 4 for s in sent])
    least = np.full((len(sent), SENT), 1 << 40, np.int64)
    least[np.arange(SENT) < sizes[:, None]] = np.frombuffer(b"".join(sent), np.int32)
    known = np.where(n > sizes, least[np.arange(len(sent)), np.maximum(sizes, 1) - 1], (1 << 40) - 1)
    out = np.zeros(len(i))
    for at in range(0, len(i), 4096):
        p, q = i[at : at + 4096], j[at : at + 4096]
        upto = np.minimum(known[p], known[q])[:, None]
        a, b = least[p], least[q]
        a_in, b_in = a <= upto, b <= upto
        both = ((a[:, :, None] == b[:, None, :]).any(axis=2) & a_in).sum(axis=1)
        out[at : at + 4096] = both / np.maximum(a_in.sum(axis=1) + b_in.sum(axis=1) - both, 1)
    return out


COMMON = 8  # rows of one in SEEN that make a hash common
SEEN = 32
MOST_COMMON = 1 << 16
PART = 1 << 17  # hashes sorted at once

PAIRS = "a long, b long, likely double"
_NAMES = ["band", "bucket", *ORDERED, "row", "n", "sent"]
_SCHEMA = pa.schema(
    [("band", pa.int32()), *[(c, pa.int64()) for c in ("bucket", *ORDERED, "row")],
     ("n", pa.int32()), ("sent", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("likely", pa.float64())]
)


def _pairs(rows: pa.Table, new: int) -> pa.Table:
    """a, b, likely of neighbours in sorted ``rows``; the later one is row ``new`` or after it."""
    band, bucket, row, n = (rows.column(c).to_numpy() for c in ("band", "bucket", "row", "n"))
    found = []
    for d in range(1, NEXT + 1):
        j = np.arange(max(d, new), len(row))
        i = j - d
        use = (band[i] == band[j]) & (bucket[i] == bucket[j]) & (row[i] != row[j])
        use &= np.minimum(n[i], n[j]) >= SIMILAR * np.maximum(n[i], n[j]) - 1e-9
        found.append(np.stack([i[use], j[use]]))
    i, j = np.concatenate(found, axis=1)
    used, inverse = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = np.split(inverse, 2)
    row, n = row[used], n[used]
    sent = rows.column("sent").take(pa.array(used)).to_pylist()
    likely = _likeness(sent, n, i, j) if len(i) else np.zeros(0)
    i, j, likely = (x[likely >= LIKELY] for x in (i, j, likely))
    columns = [np.maximum(row[i], row[j]), np.minimum(row[i], row[j]), likely]
    return pa.table(columns, names=["a", "b", "likely"])


def _filled(table: pa.Table) -> pa.RecordBatch:
    columns = [
        table.column(f.name).combine_chunks().cast(f.type)
        if f.name in table.column_names
        else pa.nulls(table.num_rows, f.type)
        for f in _SCHEMA
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _walk(batches):
    """Pairs of a range, and the rows at its ends."""
    tail, first = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).combine_chunks()
        if tail is not None:
            rows = pa.concat_tables([tail, rows]).combine_chunks()
        yield _filled(_pairs(rows, 0 if tail is None else tail.num_rows))
        first = rows.slice(0, NEXT) if first is None else first
        tail = rows.slice(max(0, rows.num_rows - NEXT))
    if tail is not None:
        yield _filled(first)
        yield _filled(tail)


def _walk_ends(group: pa.Table) -> pa.Table:
    order = [(c, "ascending") for c in (*ORDERED, "row")]
    found = _pairs(group.sort_by(order).combine_chunks(), 0)
    return found


def _candidates(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """a, b, likely of the pairs of rows that are likely to be similar."""
    session.ship_package(spark)
    placed = nodes.select("row", "n", "sketch").mapInArrow(_bands, PLACED)
    placed = common.written(spark, placed, "bands")
    order = ["band", "bucket", *ORDERED, "row"]
    # a session's own number of partitions, which shuffles may not coalesce
    dealt = placed.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)
    walked = common.written(spark, dealt.mapInArrow(_walk, f"{PLACED}, {PAIRS}"), "walked")
    ends = walked.where("row IS NOT NULL").select(_NAMES).distinct()
    at_ends = ends.groupBy("band", "bucket").applyInArrow(_walk_ends, PAIRS)
    pairs = walked.where("a IS NOT NULL").select("a", "b", "likely").union(at_ends)
    return common.written(spark, pairs.groupBy("a", "b").agg(F.max("likely").alias("likely")), "pairs")


def _whole_sets(spark: SparkSession, docs: DataFrame, pairs: DataFrame, n_words: int) -> DataFrame:
    """row, s (all shingle hashes) of the rows in pairs."""
    text = common.text_or_empty()
    needed = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    sets = (
        docs.select(F.xxhash64(text).alias("row"), text.alias("text"))
        .join(needed, "row", "left_semi")
        .groupBy("row")
        .agg(F.first("text").alias("text"))
        .select("row", _shingles(F.col("text"), n_words).alias("s"))
    )
    return common.written(spark, sets, "sets")


def _similar(spark: SparkSession, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that are similar."""
    x, y = (sets.select(F.col("row").alias(c), F.col("s").alias(f"s{c}")) for c in ("a", "b"))
    both = F.size(F.array_intersect("sa", "sb"))
    found = pairs.join(x, "a").join(y, "b").where(_alike(both, F.size("sa"), F.size("sb")))
    return common.written(spark, found.select("a", "b"), "similar")


def _common_hashes(docs: DataFrame, n_words: int) -> np.ndarray:
    """Hashes of many texts, the most common last; what is missed changes the order, but no result."""
    text = common.text_or_empty()
    some = docs.where(F.pmod(F.xxhash64(F.lit(1), text), F.lit(SEEN)) == 0)
    counts = some.select(F.explode(_shingles(text, n_words)).alias("h")).groupBy("h").count()
    most = counts.where(F.col("count") >= COMMON).orderBy(F.desc("count"), "h").limit(MOST_COMMON)
    return np.array([r["h"] for r in most.collect()][::-1], np.int64)


def _prefixes(late: np.ndarray):
    """The hashes of each set's prefix: key, n, h."""
    ordered, rank = np.sort(late), np.argsort(late) + 1

    def of_part(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("s")
        sizes = np.diff(lists.offsets.to_numpy())
        h = lists.flatten().to_numpy()
        of = np.repeat(np.arange(len(sizes)), sizes)
        place = np.zeros(len(h), np.int64)
        if len(late):
            at = np.minimum(np.searchsorted(ordered, h), len(ordered) - 1)
            place = np.where(ordered[at] == h, rank[at], 0)
        order = np.lexsort((h, place, of))
        length = sizes - np.ceil(SIMILAR * sizes - 1e-9).astype(np.int64) + 1
        nth = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        use = order[nth < np.repeat(length, sizes)]
        columns = [batch.column("key").take(pa.array(of[use])), pa.array(sizes[of[use]], pa.int32()), pa.array(h[use])]
        return pa.RecordBatch.from_arrays(columns, ["key", "n", "h"])

    def prefixes(batches):
        for batch in batches:
            # a few megabytes of hashes at once, however long the texts are
            upto = batch.column("s").offsets.to_numpy()[1:] // PART
            cuts = (np.flatnonzero(np.diff(upto)) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if lo < hi:
                    yield of_part(batch.slice(lo, hi - lo))

    return prefixes


def _several(rows: DataFrame, what: str) -> DataFrame:
    """Rows of the hashes that come with several values of ``what``."""
    same = Window.partitionBy("h")
    ends = rows.select("*", F.min(what).over(same).alias("_lo"), F.max(what).over(same).alias("_hi"))
    return ends.where("_lo <> _hi").drop("_lo", "_hi")


def _rest(
    spark: SparkSession, docs: DataFrame, nodes: DataFrame, linked: DataFrame, n_words: int
) -> DataFrame:
    """All pairs (a, b) of rows that may be similar and are not connected by ``linked``."""
    session.ship_package(spark)
    late = _common_hashes(docs, n_words)
    sets = docs.select(_shingles(common.text_or_empty(), n_words).alias("s"))
    sets = sets.select(F.xxhash64(F.sort_array("s")).alias("key"), "s")
    first = sets.mapInArrow(_prefixes(late), "key long, n int, h long")
    shared = common.written(spark, _several(first, "key").distinct(), "shared-hashes")
    roots = components.connected_components(spark, linked)
    named = nodes.select("key", "row").join(shared.select("key").distinct(), "key", "left_semi")
    named = named.join(roots.withColumnRenamed("node", "row"), "row", "left")
    named = named.select("key", "row", F.coalesce("root", "row").alias("root"))
    apart = common.written(spark, _several(shared.join(named, "key"), "root"), "apart")
    x, y = (apart.select("h", *[F.col(c).alias(f"{c}_{s}") for c in ("row", "n", "root")]) for s in "ab")
    near = F.least("n_a", "n_b") >= F.lit(SIMILAR) * F.greatest("n_a", "n_b") - 1e-9
    # up to the end of one of the prefixes all shared hashes are known; behind it,
    # no more than the rest of that set can be shared
    behind = F.greatest(*[F.ceil(F.lit(SIMILAR) * F.col(n) - 1e-9) - 1 for n in ("n_a", "n_b")])
    needed = F.lit(SIMILAR / (1 + SIMILAR)) * (F.col("n_a") + F.col("n_b")) - 1e-6
    pairs = (
        x.join(y, "h")
        .where((F.col("row_a") > F.col("row_b")) & (F.col("root_a") != F.col("root_b")) & near)
        .groupBy(F.col("row_a").alias("a"), F.col("row_b").alias("b"))
        .agg(F.count("*").alias("both"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))
        .where(F.col("both") + behind >= needed)
    )
    return common.written(spark, pairs.select("a", "b"), "rest")


def links(spark: SparkSession, docs: DataFrame, n_words: int = fingerprints.WORDS) -> DataFrame:
    """Edges (a, b) between hashes of texts that connect similar ones."""
    made = common.written(spark, _sketches(docs, n_words), "sketches")
    nodes = made.groupBy("key").agg(
        F.min("row").alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    nodes = common.written(spark, nodes, "nodes")
    equal = made.select("key", F.col("row").alias("a")).distinct().join(
        nodes.select("key", F.col("row").alias("b")), "key"
    )
    equal = equal.where("a <> b").select("a", "b")

    pairs = _candidates(spark, nodes)
    sets = _whole_sets(spark, docs, pairs, n_words)
    sides = pairs.select(F.col("a").alias("row"), "*").union(pairs.select(F.col("b").alias("row"), "*"))
    best = sides.groupBy("row").agg(F.max(F.struct("likely", "a", "b")).alias("best"))
    best = best.select("best.a", "best.b").distinct()
    strong = _similar(spark, sets, best)

    roots = components.connected_components(spark, strong)
    rooted = pairs.select("a", "b")
    for side in ("a", "b"):
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        rooted = rooted.join(named, side, "left")
    across = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    crossing = rooted.where(across).select("a", "b")
    found = strong.union(_similar(spark, sets, crossing))
    common.release(spark)
    rest = _rest(spark, docs, nodes, found, n_words)
    return equal.union(found).union(_similar(spark, _whole_sets(spark, docs, rest, n_words), rest))
