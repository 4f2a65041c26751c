r"""SimHash fingerprints and a binary-trie self-join that links near-duplicates.

A document's words are the runs of ``[^\x20\x09-\x0D]`` after lower-casing A-Z,
its shingles three words joined by spaces (all words if there are fewer). Bit i
of the fingerprint is 1 if it is set in over half of the shingles' XXH64 hashes.

Distinct fingerprints are the leaves of a binary trie. Pairs of nodes are
walked together from (root, root): going down, the bits in which the two
prefixes differ add up, and a pair is left as soon as they exceed the budget.
The top of the trie is cut where a node holds at most ``limit`` fingerprints;
the pairs of cut nodes that stay within the budget are the tasks. A task walks
its two subtrees as ranges of sorted arrays, many node pairs at a time, and
returns a spanning forest of the links it finds, so that a dense cluster costs
one row per fingerprint. The forests are merged into components.

Defined cases: a null, empty or wordless text has fingerprint zero and is
linked like any other; equal rows give one result row each; null doc_ids are
kept but name no component unless a component has no other; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, components, near_copies

WORDS = 3
BUDGET = 2
LEAST_LIMIT = 1 << 15  # fingerprints of a subtree that are not worth cutting
MOST_HEAVY = 1 << 12  # nodes of one depth that may be cut further
STEP = 4  # bits between two depths of the cut part
LEAF_PAIRS = 64  # pairs of leaves below two nodes that are compared directly
FRONTIER = 1 << 19  # node pairs held at once


def fingerprints(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """doc_id, row (hash of the text), copies, fp (64 bits as a long)."""
    text = common.text_or_empty()
    worded = docs.select(
        "doc_id",
        F.xxhash64(text).alias("row"),
        common.words(common.ascii_lower(text)).alias("w"),
    ).withColumn("n", F.size("w"))
    placed = worded.select(
        "*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - n_words, F.lit(0)))).alias("i")
    )
    shingle = F.when(
        F.col("n") >= n_words,
        F.concat_ws(" ", *[F.get("w", F.col("i") + k) for k in range(n_words)]),
    ).otherwise(F.array_join("w", " "))
    # two 32-bit counters to a sum: bits b and b + 32
    lanes = [F.expr(f"sum(shiftrightunsigned(h, {b}) & 4294967297L) AS s{b}") for b in range(32)]
    counted = (
        placed.select("doc_id", "row", "i", "n", F.xxhash64(shingle).alias("h"))
        .groupBy("doc_id", "row")
        .agg(
            F.count("*").alias("shingles"),
            F.sum((F.col("i") == 0).cast("int")).cast("int").alias("copies"),
            F.max("n").alias("n"),
            *lanes,
        )
    )
    bits = [f"if((s{b} & 4294967295L) * 2 > shingles, {1 << b}L, 0L)" for b in range(32)]
    bits += [
        f"if(shiftrightunsigned(s{b}, 32) * 2 > shingles, shiftleft(1L, {b + 32}), 0L)"
        for b in range(32)
    ]
    fp = F.expr(f"if(n = 0, 0L, {' | '.join(bits)})")
    return counted.select("doc_id", "row", "copies", fp.alias("fp"))


def _prefix(depth: int):
    """The first ``depth`` bits of the fingerprint as a number."""
    return F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")


def cut_trie(fps: DataFrame, limit: int) -> tuple[dict, set]:
    """Nodes where the trie is cut, as (depth, prefix): count, and those above them."""
    leaves, inner = {}, set()
    level = [((0, 0), fps.count())]
    depth = 0
    while level:
        heavy = [node for node, n in level if n > limit and depth < 64]
        leaves |= {node: n for node, n in level if n <= limit or depth == 64}
        inner.update(heavy)
        if not heavy:
            break
        # at most MOST_HEAVY nodes of a depth are heavy
        spark = fps.sparkSession
        chosen = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for _, p in heavy], "p long")
        inside = fps.join(F.broadcast(chosen), _prefix(depth) == F.col("p"), "left_semi")
        depth += STEP
        counts = inside.groupBy(_prefix(depth).alias("p")).count().collect()
        level = [((depth, r.p & (2**64 - 1)), r["count"]) for r in counts]
    return leaves, inner


def node_pairs(leaves: dict, inner: set, budget: int) -> list[tuple]:
    """Pairs of cut nodes whose known prefix bits differ in at most ``budget``."""
    nodes = set(leaves) | inner

    def below(node):
        depth, prefix = node
        kids = ((depth + STEP, prefix << STEP | k) for k in range(1 << STEP))
        return [k for k in kids if k in nodes]

    found, stack = [], [((0, 0), (0, 0), 0)]
    while stack:
        u, v, differ = stack.pop()
        if u in leaves and v in leaves:
            found.append((u, v))
        elif u in inner and v in inner:
            for cu in below(u):
                for cv in below(v):
                    more = differ + ((cu[1] ^ cv[1]) & ((1 << STEP) - 1)).bit_count()
                    if more <= budget and (u != v or cu <= cv):
                        stack.append((cu, cv, more))
        elif u in inner:
            stack += [(c, v, differ) for c in below(u)]
        else:
            stack += [(u, c, differ) for c in below(v)]
    return found


def walk(a: np.ndarray, b: np.ndarray, budget: int):
    """Chunks (i, j) of positions with a[i], b[j] at most ``budget`` bits apart.

    ``a`` and ``b`` are sorted distinct uint64, two subtrees of the trie; if they
    are the same array, each pair comes once.
    """
    same = a is b
    zero = np.zeros(1, np.int64)
    stack = [(63, zero, zero + len(a), zero, zero + len(b), zero)]
    while stack:
        bit, al, ah, bl, bh, differ = stack.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack.append((bit, *(x[half:] for x in (al, ah, bl, bh, differ))))
            al, ah, bl, bh, differ = (x[:half] for x in (al, ah, bl, bh, differ))
        pairs = (ah - al) * (bh - bl)
        few = (pairs <= LEAF_PAIRS) | (bit < 0)
        if few.any():
            yield from _compare(a, b, al[few], ah[few], bl[few], bh[few], budget, same)
        rest = ~few
        al, ah, bl, bh, differ = (x[rest] for x in (al, ah, bl, bh, differ))
        if not len(al):
            continue
        one = np.uint64(1 << bit)
        above = ~np.uint64((2 << bit) - 1) if bit < 63 else np.uint64(0)
        am = np.clip(np.searchsorted(a, (a[al] & above) | one), al, ah)
        bm = np.clip(np.searchsorted(b, (b[bl] & above) | one), bl, bh)
        twin = same & (al == bl)
        parts = [
            (al, am, bl, bm, differ, np.ones(len(al), bool)),
            (am, ah, bm, bh, differ, np.ones(len(al), bool)),
            (al, am, bm, bh, differ + 1, np.ones(len(al), bool)),
            (am, ah, bl, bm, differ + 1, ~twin),
        ]
        kept = [
            [x[use & (p[0] < p[1]) & (p[2] < p[3]) & (p[4] <= budget)] for x in p[:5]]
            for p in parts
            for use in [p[5]]
        ]
        stack.append((bit - 1, *(np.concatenate(x) for x in zip(*kept))))


def _compare(a, b, al, ah, bl, bh, budget, same):
    """All leaves below each node pair against each other, at most FRONTIER pairs at once."""
    pairs = (ah - al) * (bh - bl)
    ends = np.cumsum(pairs)
    at = 0
    while at < len(pairs):
        base = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, base + FRONTIER, side="right")))
        n = pairs[at:upto]
        which = np.repeat(np.arange(at, upto), n)
        k = np.arange(len(which)) - np.repeat(ends[at:upto] - n - base, n)
        width = (bh - bl)[which]
        i, j = al[which] + k // width, bl[which] + k % width
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        yield i[near], j[near]
        at = upto


class Forest:
    """Union of linked positions that remembers one edge per union."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        new = self.root[i] != self.root[j]
        if not new.any():
            return
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for x, y in np.unique(np.stack([i[new], j[new]], 1), axis=0).tolist():
            rx, ry = top(int(self.root[x])), top(int(self.root[y]))
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                self.edges.append((x, y))
        moved = np.array(list(parent), np.int64)
        target = np.arange(len(self.root))
        target[moved] = [top(x) for x in parent]
        self.root = target[self.root]


def _subtree_links(budget: int):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy().view(np.uint64)
        side = group["side"].to_numpy()
        a = np.unique(values[side == 0])
        b = np.unique(values[side == 1]) if (side == 1).any() else a
        shift = 0 if a is b else len(a)
        both = a if a is b else np.concatenate([a, b])
        forest = Forest(len(both))
        for i, j in walk(a, b, budget):
            forest.link(i, j + shift)
        edges = np.array(forest.edges, np.int64).reshape(-1, 2)
        ends = both.view(np.int64)[edges]
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})

    return links


def trie_links(
    spark: SparkSession, fps: DataFrame, budget: int = BUDGET, limit: int | None = None
) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` values within ``budget`` bits."""
    session.ship_package(spark)
    limit = limit or max(LEAST_LIMIT, fps.count() // MOST_HEAVY)
    leaves, inner = cut_trie(fps, limit)
    pairs = node_pairs(leaves, inner, budget)

    def signed(p: int) -> int:
        return p - (1 << 64) if p >> 63 else p

    sides = []
    for k, (u, v) in enumerate(pairs):
        sides.append((k, 0, u[0], signed(u[1])))
        if u != v:
            sides.append((k, 1, v[0], signed(v[1])))
    walks = spark.createDataFrame(sides, "pair long, side int, depth int, p long")
    depths = sorted({d for d, _ in leaves})
    nodes = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("p")) for d in depths])
    placed = fps.select("fp", F.inline(nodes)).join(walks, ["depth", "p"])
    return placed.groupBy("pair").applyInPandas(_subtree_links(budget), "a long, b long")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    n_words: int = WORDS,
    budget: int = BUDGET,
    links: DataFrame | None = None,
) -> DataFrame:
    """One row per document: doc_id, row, fp, root, component_id (least doc_id reachable).

    ``links`` are further edges (a, b) between hashes of texts.
    """
    found = common.written(spark, fingerprints(docs, n_words), "fingerprints")
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("low"))
    distinct = common.written(spark, distinct, "distinct-fingerprints")
    edges = trie_links(spark, distinct.select("fp"), budget)
    if links is not None:
        printed = found.select("row", "fp").distinct()
        ends = [printed.select(F.col("row").alias(x), F.col("fp").alias(f"fp_{x}")) for x in ("a", "b")]
        more = links.join(ends[0], "a").join(ends[1], "b")
        edges = edges.select("a", "b").union(more.select("fp_a", "fp_b"))
    linked = components.connected_components(spark, edges)
    rooted = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return found.join(named, "fp").select(
        "doc_id",
        "row",
        "fp",
        "root",
        "component_id",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one with the least doc_id.

    Documents are linked if their fingerprints are, or if the Jaccard of their
    five-word shingles is at least 0.8. Of rows that share this id, the one with the least hash of its text stays.
    """
    text = common.text_or_empty()
    groups = near_duplicates(spark, docs, links=near_copies.links(spark, docs))
    chosen = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component_id")
        .agg(F.min_by(F.struct("doc_id", "row"), "row").alias("one"))
        .select("one.doc_id", "one.row")
    )
    nameless = groups.where("doc_id IS NULL AND component_id IS NULL").groupBy("root").agg(
        F.min("row").alias("row")
    )
    chosen = chosen.where("doc_id IS NOT NULL").union(
        nameless.select(F.lit(None).cast("long").alias("doc_id"), "row")
    )
    same = F.col("k.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("k.row") == F.xxhash64(text))
    kept = docs.alias("t").join(chosen.alias("k"), same, "left_semi")
    equal = Window.partitionBy("doc_id", F.xxhash64(text)).orderBy("doc_id")
    copy = common.fresh("_copy", docs.columns)
    return kept.withColumn(copy, F.row_number().over(equal)).where(F.col(copy) == 1).drop(copy)
