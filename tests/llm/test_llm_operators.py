"""Corpus operators against plain Python on tables with every odd case."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from braidline.llm import (
    components,
    decontaminate,
    fingerprints,
    line_dedup,
    near_copies,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
)


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def in_order(found):
    return sorted(found, key=str)


def test_line_dedup(spark, docs, rows, none, monkeypatch):
    want = in_order(brute.kept_lines(rows))
    columns = ("doc_id", "n_lines", "n_dropped", "kept")
    assert listed(line_dedup.deduplicate_lines(spark, docs), *columns) == want
    assert line_dedup.deduplicate_lines(spark, none).count() == 0
    # the same with every key counted before the shuffle, and with none
    every = lambda spark, h: h.select("h1", "h2").distinct()
    monkeypatch.setattr(line_dedup, "_hot_keys", every)
    assert listed(line_dedup.deduplicate_lines(spark, docs), *columns) == want
    monkeypatch.setattr(line_dedup, "_hot_keys", lambda spark, h: every(spark, h).where("h1 IS NULL"))
    assert listed(line_dedup.deduplicate_lines(spark, docs), *columns) == want


def test_line_dedup_keeps_the_other_columns(spark, docs, rows):
    kept = line_dedup.without_lines(spark, docs)
    assert kept.columns == docs.columns
    want = [(d, None if t is None else k) for (d, t), (_, _, _, k) in zip(rows, brute.kept_lines(rows))]
    assert listed(kept, "doc_id", "text") == in_order(want)


def test_fingerprints(spark, docs, rows, none):
    found = fingerprints.with_edits(spark, docs).collect()
    assert len(found) == len(rows)
    assert fingerprints.with_edits(spark, none).count() == 0
    texts = {}
    for doc, text in rows:
        texts.setdefault(brute.rank(doc), set()).add(text or "")
    order = sorted(texts, reverse=True)
    seen = {}
    for r in found:
        k = order.index(brute.rank(r.doc_id))
        following = texts[order[(k + 1) % len(order)]]
        edits = set()
        for text in texts[brute.rank(r.doc_id)]:
            third = len(text) // 3
            edits |= {brute.sha(text[: len(text) - third] + x[:third]) for x in following}
        assert r.edited_sha256 in edits
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        seen.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert seen[67] == seen[68] and seen[61] == seen[62] == {fingerprints.EMPTY}


def test_fingerprint_likeness_follows_resemblance(spark):
    rng = np.random.default_rng(1)
    pairs = []
    for share in np.linspace(0, 1, 60):
        a = [f"w{x}" for x in rng.integers(0, 10**6, 600)]
        b = a[: int(600 * share)] + [f"w{x}" for x in rng.integers(0, 10**6, 600 - int(600 * share))]
        sets = [{tuple(x[i : i + 5]) for i in range(596)} for x in (a, b)]
        pairs.append((" ".join(a), " ".join(b), len(sets[0] & sets[1]) / len(sets[0] | sets[1])))
    df = spark.createDataFrame(pairs, "a string, b string, truth double")
    near = fingerprints.likeness(*[fingerprints.fingerprint(F.col(c)) for c in "ab"])
    errors = np.array([r.near - r.truth for r in df.select("truth", near.alias("near")).collect()])
    assert np.abs(errors).max() < 0.12 and abs(errors.mean()) < 0.02


def test_next_documents(spark):
    ids = spark.createDataFrame([(x,) for x in (5, -3, 900, 17, 17)], "d long")
    assert listed(fingerprints.next_documents(spark, ids), "d", "next_d") == in_order(
        [(900, 17), (17, 5), (5, -3), (-3, 900)]
    )


def test_simhash(spark, docs, rows, none):
    found = simhash.near_duplicates(spark, docs)
    prints = [brute.simhash(t) for _, t in rows]
    top = brute.components(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    ids = {}
    for (doc, _), t in zip(rows, top):
        ids.setdefault(t, []).append(doc)
    low = {t: min((d for d in v if d is not None), default=None) for t, v in ids.items()}
    want = [(d, p - (1 << 64) if p >> 63 else p, low[t]) for (d, _), p, t in zip(rows, prints, top)]
    assert listed(found, "doc_id", "fp", "component_id") == in_order(want)
    assert simhash.near_duplicates(spark, none).count() == 0
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(low.values())
    assert simhash.keep_one(spark, none).count() == 0


@pytest.mark.parametrize("limit", [4, 60, 10**6])
def test_trie_links(spark, limit):
    rng = np.random.default_rng(2)
    centres = [int(x) for x in rng.integers(0, 2**63, 80)]
    values = set(centres)
    for c in centres[:40]:
        for _ in range(4):
            near = c
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                near ^= 1 << int(b)
            values.add(near)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = [(r.a, r.b) for r in simhash.trie_links(spark, fps, 2, limit).collect()]
    near = lambda i, j: ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 2
    assert all(near(values.index(a), values.index(b)) for a, b in edges)
    linked = {frozenset(e) for e in edges}
    by_edges = brute.components(
        len(values), lambda i, j: frozenset((values[i], values[j])) in linked
    )
    assert by_edges == brute.components(len(values), near)


def test_dense_cluster_gives_a_forest():
    values = np.array(sorted({5 ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)}), np.uint64)
    forest = simhash.Forest(len(values))
    for i, j in simhash.walk(values, values, 2):
        forest.link(i, j)
    assert len(forest.edges) == len(values) - 1 and len(set(forest.root.tolist())) == 1


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(50, 40), (40, 60), (7, 7), (1, 0)]
    found = components.connected_components(spark, spark.createDataFrame(edges, "a long, b long"))
    want = [(k, 0) for k in range(31)] + [(k, 40) for k in (40, 50, 60)]
    assert listed(found, "node", "root") == in_order(want)


def test_decontamination(spark, docs, rows, none):
    passage = brute.words(rows[60][1])
    items = [
        (1, " ".join(passage[100:140])), (2, " ".join(passage[120:127])), (2, "one two"), (3, "one"),
        (None, "one"), (4, None), (5, " .,!"), (6, "nowhere to be found in any of these texts at all"),
        (11, " ".join(passage[100:112])), (1, " ".join(passage[100:140])),
    ]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    want = in_order(brute.contamination(rows, items))
    columns = ("doc_id", "n_words", "n_hit", "item_ids")
    as_lists = lambda df: in_order((d, n, h, list(x)) for d, n, h, x in listed(df, *columns))
    assert as_lists(decontaminate.contamination(spark, docs, table)) == want
    shuffled = decontaminate.contamination(spark, docs, table, broadcast_windows=0)
    assert as_lists(shuffled) == want
    assert decontaminate.contamination(spark, none, table).count() == 0
    clean = decontaminate.contamination(spark, docs, table.limit(0))
    assert as_lists(clean) == in_order((d, n, 0, []) for d, n, _, _ in want)
    kept = decontaminate.without_contaminated(spark, docs, table)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(d) for d, _, h, _ in want if not h
    )


def test_url_filter(spark):
    urls = [
        "http://A.net/x", "http://a.net", "https://www.example.net/en/1?q#f", "x://example.net/enx",
        "http://sub.example.com/de/", "http://example.com.de/de/", "http://b.org/fr/", "notnet/fr/",
        "http://casino-win.example.net/", "http://my-adult.org/fr/", None, "", "no", "http://net/",
        "http://a.net:80/en/", "http://evil.com/?u=http://a.net/", "HTTP://spam.io#x",
        "http://xspam.io", "http://Ünet.org/fr/z", "http://a.net/x", "http://a.net/x",
    ]
    rows = [(k % 19, u) for k, u in enumerate(urls)] + [(None, "http://a.net/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("token", F.lit("t"))
    named = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]

    def judge(url):
        rest = url.partition("://")[2] if url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = brute.low(rest[:cut]), rest[cut:]
        end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
        path = tail[:end]
        fits = [
            (len(h + p), h + p, v) for h, p, v in named
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        if fits:
            return host, path, max(fits)[1], max(fits)[2]
        import re

        bad = {*re.split("[.-]", host)} & {*url_filter.BLOCKED_WORDS}
        return host, path, None, "block" if bad else "allow"

    rules = [url_filter.host_rule(*r) for r in named] + url_filter.DEFAULT_RULES
    found = url_filter.judge(spark, pages, rules)
    want = in_order((p, *judge(u)) for p, u in rows)
    assert listed(found, "page_id", "host", "path", "rule", "verdict") == want
    assert url_filter.judge(spark, pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(spark, pages, []).collect()} == {"allow"}
    tokenless = [url_filter.Rule("all", ".*", "block", 0, 0, ())]
    assert {r.verdict for r in url_filter.judge(spark, pages, tokenless).collect()} == {"block"}


def test_toxicity_folds_and_scores(spark):
    assert toxicity.fold("ІD10T сlown") == " idiot ciown "
    lexicon = toxicity.Lexicon({" idio": 5.0, " ciown ": 4.0}, [" idiom "])
    assert lexicon.evidence("You 1diots, a clown: idiom, clowns") == (9.0, 6)
    assert lexicon.evidence("") == (0.0, 0)


def test_toxicity_learns_words_and_exceptions(spark, docs, none):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(900):
        toxic = k % 3 == 0
        words = [f"w{x}" for x in rng.integers(0, 300, 30)]
        if toxic:
            words[5:8] = ["Vuлgar", "vulgarly", "vulg4ris"]
        elif k % 5 == 0:
            words[3] = "vulgate"
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(spark, table, marks)
    assert any(p.startswith(" vuig") for p in lexicon.weights)
    assert lexicon.evidence("the vulgate")[0] == 0 < lexicon.evidence("so vulgar")[0]
    scored = toxicity.score(spark, table, lexicon, ["doc_id"]).join(marks, "doc_id")
    wrong = scored.where("(score >= 0.7) <> (toxic = 1) AND toxic IS NOT NULL")
    assert wrong.count() == 0
    odd = toxicity.score(spark, docs, lexicon, docs.columns, name="mark")
    assert odd.count() == docs.count() and odd.where("mark IS NULL OR mark > 0.7").count() == 0
    assert toxicity.score(spark, none, lexicon, ["doc_id"]).count() == 0
    unlearned = toxicity.learn(spark, table, marks.limit(0))
    assert {r.score for r in toxicity.score(spark, docs, unlearned, ["doc_id"]).collect()} == {0.0}


def test_suffix_dedup(spark, docs, rows, none, monkeypatch):
    want = in_order(brute.without_repeats(rows))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert listed(suffix_dedup.remove_repeats(spark, docs), *columns) == want
    assert listed(suffix_dedup.remove_repeats(spark, docs.coalesce(1)), *columns) == want
    assert suffix_dedup.remove_repeats(spark, none).count() == 0
    other = in_order(brute.without_repeats(rows, 20))
    assert listed(suffix_dedup.remove_repeats(spark, docs, 20, 7), *columns) == other


@pytest.mark.parametrize("length, seed", [(50, 16), (20, 7), (12, 3)])
def test_equal_strings_have_equal_anchors(rows, length, seed):
    texts = [(text or "").encode() for _, text in rows]
    found = suffix_dedup.runs(texts, length, seed)
    piece = suffix_dedup.Slice(list(range(len(texts))), texts, found, length, seed)
    starts, anchors = piece.strings(np.arange(len(piece.at)))
    lasts = np.cumsum([len(t) for t in texts])
    want = [s for t, e in zip(texts, lasts) for s in range(e - len(t), e - length + 1)]
    assert starts.tolist() == want
    body, offsets = b"".join(texts), {}
    for start, off in zip(want, (piece.at[anchors] - starts).tolist()):
        assert 0 <= off <= length - seed
        assert offsets.setdefault(body[start : start + length], off) == off
    assert len(piece.at) < len(want)


def test_rounds_hash_only_the_strings_they_name(rows, monkeypatch):
    """Texts are looked at in full when the slices are written, in no later round."""
    texts = [(text or "").encode() for _, text in rows]
    found = suffix_dedup.runs(texts, 50, 16)
    hashed, plain = [], suffix_dedup.names

    def counted(word, starts, *rest):
        hashed.append(len(starts))
        return plain(word, starts, *rest)

    monkeypatch.setattr(suffix_dedup, "names", counted)
    piece = suffix_dedup.Slice([d for d, _ in rows], texts, found, 50, 16)
    assert sum(hashed) == len(piece.at) < piece.n / 5


def test_names_depend_on_the_bytes_alone():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, 3000).tolist()), b"abcabcabc" * 40]
    data = suffix_dedup.padded(texts)
    starts = rng.integers(0, len(data) - 120, 4000)
    sizes = rng.integers(1, 100, 4000)
    whole = suffix_dedup.names(suffix_dedup.words(data), starts, sizes)
    seen = {}
    for start, size, name in zip(starts.tolist(), sizes.tolist(), whole.tolist()):
        assert seen.setdefault(data[start : start + size].tobytes(), name) == name
    assert len(set(seen.values())) == len(seen)
    nine = suffix_dedup.names(suffix_dedup.words(data), starts[sizes == 9], 9)
    assert nine.tolist() == whole[sizes == 9].tolist()


def test_only_later_slices_are_answered(spark):
    schema = "name long, least long, slice long"
    named = spark.createDataFrame([(1, 5, 0), (1, 9, 1), (1, 5, 2), (2, 7, 1)], schema)
    every = suffix_dedup._in_several_slices(named, False).collect()
    later = suffix_dedup._in_several_slices(named, True).collect()
    assert sorted((r.slice, r.name, r.least) for r in every) == [(0, 1, 5), (1, 1, 5), (2, 1, 5)]
    assert [(r.slice, r.name, r.least) for r in later] == [(1, 1, 5)]


def test_similar_texts_are_linked_and_one_stays(spark, none):
    rng = np.random.default_rng(8)
    text = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passage, rows = text(30), []
    for n in (12, 40, 90, 300):
        for _ in range(4):
            base = text(n) + passage[: n // 4]
            for changes in (0, 1, n // 30, n // 20):
                w = list(base)
                for at in rng.integers(0, len(w), changes):
                    w[at] = f"x{at}"
                rows.append((len(rows), " ".join(w)))
    # a chain in which only neighbours are similar, and a dense group around one text
    chain, centre = text(100), text(120)
    rows += [(len(rows) + k, " ".join(chain[6 * k :] + [f"c{x}" for x in range(6 * k)])) for k in range(12)]
    rows += [(len(rows) + k, " ".join(centre[:k] + [f"y{k}"] + centre[k + 1 :])) for k in range(60)]
    rows += [(None, rows[3][1] + " end"), (9000, rows[20][1].upper()), (9001, ""), (9002, None), (9003, "one")]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    sets = [shingles(t) for _, t in rows]
    near = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9
    want = brute.components(len(rows), near)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    place = {r.row: r.at for r in spark.createDataFrame(
        [(k, t or "") for k, (_, t) in enumerate(rows)], "at int, t string"
    ).selectExpr("at", "xxhash64(t) AS row").orderBy(F.desc("at")).collect()}
    edges = [(place[r.a], place[r.b]) for r in near_copies.links(spark, docs).collect()]
    assert all(near(a, b) for a, b in edges)
    linked = {frozenset(e) for e in edges}
    same = lambda i, j: frozenset((i, j)) in linked or (rows[i][1] or "") == (rows[j][1] or "")
    assert brute.components(len(rows), same) == want
    assert near_copies.links(spark, none).count() == 0

    prints = [brute.simhash(t) for _, t in rows]
    bits = lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2
    top = brute.components(len(rows), lambda i, j: near(i, j) or bits(i, j))
    assert len(set(top)) < len(set(brute.components(len(rows), bits)))
    ids = {}
    for (doc, _), t in zip(rows, top):
        ids.setdefault(t, []).append(doc)
    kept = sorted(r.doc_id for r in simhash.keep_one(spark, docs).collect())
    assert kept == sorted(min(d for d in v if d is not None) for v in ids.values())
