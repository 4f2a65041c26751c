"""Phrases, hard negatives, token counts, fingerprints and toxicity against plain Python."""

import math
import random
import re
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import EXTRA
from pyspark.sql import functions as F

from braidline.llm import (
    common,
    fingerprints,
    hard_negatives,
    near_copies,
    phrases,
    token_counts,
    tokens,
    toxicity,
)


def widened(df):
    """With columns of the names that operators use themselves."""
    names = [*EXTRA, "key", "slice", "f", "a", "l", "r", "best", "w", "around", "anchor", "bound", "segment"]
    return df.select("*", *[F.lit("x").alias(n) for n in dict.fromkeys(names) if n not in df.columns])


# -- phrases ---------------------------------------------------------------


def mined(rows, threshold, most, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting every n-gram."""
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.low(text)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    known = {p: c for p, c in counts.items() if c >= threshold}
    out = {}
    for (lang, w), a in known.items():
        inside = [
            (lang, q) for (other, q), f in known.items()
            if other == lang and len(q) > len(w) and f >= a
            and any(q[i : i + len(w)] == w for i in range(len(q) - len(w) + 1))
        ]
        if len(w) < 2 or inside:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = known[lang, w[:k]], known[lang, w[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def phrase_rows():
    rng = random.Random(2)
    words = ["The", "cat", "sat", "ON", "mat", "été", "straße", "\x01", "a", "b"]

    def text():
        return "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(30))

    rows = [(text(), rng.choice(["en", "fr", None, "und"])) for _ in range(60)]
    rows += [(None, "en"), ("", "en"), (" \n\t", None), ("x", "de"), ("New York City " * 9, "xx"), ("one two", "")]
    return rows + rows[:5] + [(" ".join(rng.choice(words) for _ in range(40_000)), "long")]


@pytest.mark.parametrize("most_bits", [1 << 28, 1 << 12])
def test_phrases_equal_plain_counts(spark, monkeypatch, most_bits):
    """A filter far too small lets everything pass and changes nothing."""
    rows = phrase_rows()
    df = widened(spark.createDataFrame(rows, "text string, lang string").repartition(7))
    whole = phrases.frequent
    monkeypatch.setattr(phrases, "frequent", lambda s, d, t, m: whole(s, d, t, m, most_bits))
    got = phrases.collocations(spark, df, threshold=7, most_words=4, top=40)
    want = mined(rows, 7, 4, 40)
    assert sorted(map(tuple, got.collect())) == want
    assert {"und", "long", "xx"} <= {w[0] for w in want}


def test_phrases_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(spark, none).count() == 0
    blank = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert phrases.collocations(spark, blank, threshold=1).count() == 0


def test_summaries_keep_every_frequent_hash():
    rng = np.random.default_rng(1)
    keys = np.concatenate([np.repeat(np.arange(50), 40), rng.integers(1000, 200_000, 60_000)]).astype(np.uint64)
    rng.shuffle(keys)
    true = Counter(keys.tolist())
    summary = phrases.Summary(4 * len(keys) // 40 + 1, phrases.count_bits(40))
    small = phrases.Summary(len(keys) // 40 + 1, phrases.count_bits(40))
    for part in np.array_split(keys, 30):
        k, c = np.unique(part, return_counts=True)
        for s in (summary, small):
            s.add(k, c.astype(np.uint64))
            s.merge()
            assert len(s.keys) <= s.capacity
    frequent = {k for k, n in true.items() if n >= 40}
    for s in (summary, small):
        assert frequent <= set(s.frequent(40).tolist()) and s.taken < 40
    assert all(true[k] >= 30 for k in summary.frequent(40).tolist())


def test_packed_hashes_come_back():
    for values in ([], [0], [5, 2**47, 3], list(range(300))):
        array = np.array(values, np.uint64)
        assert phrases._unpacked(phrases._packed(array)).tolist() == values


def test_windows_of_a_long_text_hash_alike(monkeypatch):
    texts, langs = pa.array(["a b c d. e f g h i j", "k l m"]), pa.array(["x", "y"])
    words = phrases.Words(texts, langs)

    def keys():
        return [(k, lo + i, h, ok) for k, lo, hs, whole in words.keys(5, 48)
                for i, (h, ok) in enumerate(zip(hs.tolist(), whole.tolist()))]

    whole = sorted(keys())
    monkeypatch.setattr(phrases, "WINDOW", 3)
    assert sorted(keys()) == whole
    assert sum(ok for k, _, _, ok in whole if k == 3) == 2 + 4 + 1


# -- hard negatives --------------------------------------------------------


def negatives(rows, anchors, scale=256):
    used = []
    for vec_id, vector, label in rows:
        bad = vec_id is None or label is None or vector is None
        if bad or any(x is None or not math.isfinite(x) for x in vector):
            continue
        used.append((vec_id, [math.floor(scale * x) for x in vector], label))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a_id, a_vector, a_label in {(i, tuple(v), lab) for i, v, lab in used if anchors(i)}:
        others = sorted((-score(a_vector, v), i, lab) for i, v, lab in used if i != a_id)
        for s, p_id, lab in [o for o in others if o[2] == a_label][:5]:
            good = [o for o in others if o[2] != a_label and 80 * -s <= 100 * -o[0] <= 100 * -s]
            out += [(a_id, p_id, k, o[1], -s, -o[0]) for k, o in enumerate(good[:5], 1)]
    return sorted(out)


def vector_rows():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(5, 12))
    rows = []
    for i in range(400):
        v = centres[i % 5] * rng.choice([0.3, 1.0, 3.0]) + rng.normal(size=12) * 0.4
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 4))))
    same = [0.5] * 12
    rows += [(1000 + i, same, i % 2) for i in range(80)]  # ties
    rows += [(2000, [0.0] * 12, 1), (2010, [-1.0] * 12, 0), (2020, [1.0, 2.0], 1), (2030, [], 2)]
    rows += [(None, same, 0), (2040, None, 1), (2050, same, None), (2060, [None] * 12, 1)]
    rows += [(2070, [float("nan")] * 12, 1), (2080, [float("inf")] * 12, 1)]
    return rows + [rows[20], rows[20], rows[33], (20, same, 3)]


def test_negatives_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    made = hard_negatives.integer_rows(widened(df))
    got = hard_negatives.mine(spark, made, made.where("vec_id % 10 = 0"), bucket_rows=16, segment_rows=60)
    assert got.columns[:3] == ["anchor_id", "positive_id", "rank"]
    assert sorted(map(tuple, got.collect())) == negatives(rows, lambda i: i % 10 == 0)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    made = hard_negatives.integer_rows(none)
    assert hard_negatives.mine(spark, made, made.where("vec_id % 10 = 0")).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1)], none.schema)
    made = hard_negatives.integer_rows(one)
    assert hard_negatives.mine(spark, made, made).count() == 0


def test_candidates_lose_no_row_and_leave_many_out():
    rng = np.random.default_rng(2)
    matrix = np.floor(256 * rng.normal(size=(2000, 16)) / 4).astype(np.int32)
    bucket = hard_negatives.Bucket(np.arange(2000), np.zeros(2000, np.int64), matrix)
    seen = 0
    for q in matrix[:60]:
        scores = matrix.astype(np.int64) @ q.astype(np.int64)
        for least in (int(np.sort(scores)[-5]), int(0.6 * scores.max()), 0, -5000):
            rows = bucket.candidates(q, math.sqrt(float(q @ q)), least)
            assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
            seen += len(rows) if least == int(np.sort(scores)[-5]) else 0
    assert seen < 60 * 2000 * 0.5


# -- token counts ----------------------------------------------------------

ODD = [
    "  a  b ", "", "   ", None, "x \n  y\t z", "<|endoftext|> a<|startoftext|>b", "don't 'll  I'M",
    "a b c　d", "é é ﬁ", "1 23 456 ", "end ", "A\x1cB C\x85D", " lead",
    "\n\n a  \n b", "naïve  ", "ß STRASSE. wörd,;!", " ́x", "<|ENDOFTEXT|>", "你好 世界\U0001f600",
    "word " * 3000, "ab" * 5000, "▁ a ▁b", "</s> <s> <unk>", "a  ", "a ́", "x<|endoftext|> y", "\r\n a\r",
]


def whole(name, text):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode(text or "")
    import tokenizers

    return tokenizers.Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


VOCABULARIES = {"word_bpe_49k.json": "blank", "byte_bpe_50k.json": "before", "piece_bpe_32k.model": "piece"}


@pytest.mark.parametrize("name", VOCABULARIES)
def test_counts_equal_encoding_whole_texts(spark, rows, name):
    path = public_tokenizers.path(name)
    assert tokens.cut_of(path) == VOCABULARIES[name]
    texts = ODD + [t for _, t in rows[:30]]
    numbered = [(k if k % 9 else None, t) for k, t in enumerate(texts)]
    df = widened(spark.createDataFrame(numbered, "doc_id long, text string").repartition(4))
    want = Counter(
        (d, len((t or "").encode()), len(whole(name, t)), len(whole(name, t)) > 20) for d, t in numbered
    )
    for entries in (token_counts.ENTRIES, 3):
        got = token_counts.count_tokens(spark, df, path, limit=20, entries=entries)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("name", VOCABULARIES)
def test_ids_of_chunks_are_those_of_the_text(name):
    encoder = tokens.ChunkTokenizer(public_tokenizers.path(name))
    ids, bounds = encoder.encode(pa.array(ODD))
    for text, lo, hi in zip(ODD, bounds, bounds[1:]):
        assert ids[lo:hi].tolist() == whole(name, text)


def test_an_unknown_kind_of_file_is_encoded_whole(tmp_path):
    import json

    said = json.load(open(public_tokenizers.path("word_bpe_49k.json")))
    said["normalizer"] = None
    path = tmp_path / "other.json"
    path.write_text(json.dumps(said))
    assert tokens.cut_of(str(path)) == "whole"


def test_frequent_chunks_are_bounded(spark):
    texts = [(" ".join(["often"] * 50 + [f"w{i}x{k}" for k in range(50)]),) for i in range(40)]
    df = spark.createDataFrame(texts, "text string").repartition(4)
    table = token_counts.frequent_lengths(spark, df, tokens.default_path(), entries=10)
    assert table.column("chunk").to_pylist() == ["often"]


def test_counts_of_nothing(spark, none):
    assert token_counts.count_tokens(spark, none).count() == 0


# -- fingerprints and toxicity ---------------------------------------------


def test_fingerprints_equal_plain_min_hash(spark, rows):
    texts = [(t or "",) for _, t in rows] + [("one two three four",), ("a b c d e f",), ("x " * 50,)]
    df = spark.createDataFrame(texts, "text string")
    got = df.select("text", fingerprints.fingerprint(F.col("text")).alias("fp")).collect()
    for r in got:
        assert r["fp"] == brute.min_hash(r["text"], draws=fingerprints.DRAWS)


def test_scores_equal_trying_every_pattern(spark, rows):
    folder = "/root/testdata/sf0.01"
    docs, labels = (common.read(spark, folder, n) for n in ("documents", "labels"))
    lexicon = toxicity.learn(spark, docs, labels)
    assert any(w > 0 for w in lexicon.weights.values())
    words = [p.strip() for p in lexicon.weights][:40]
    texts = [(k, t) for k, (_, t) in enumerate(rows)]
    texts += [(1000 + k, f"so {w.upper()} {w}x, {w.replace('o', '0').replace('i', '1')}") for k, w in enumerate(words)]
    texts += [(2000 + r.doc_id, r.text) for r in docs.where("doc_id < 150").collect()]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    known = dict(texts)
    for r in toxicity.score(spark, df, lexicon, ["doc_id"]).collect():
        want = brute.toxicity(known[r["doc_id"]], lexicon.weights, lexicon.curve, toxicity.fold)
        assert r["score"] == pytest.approx(want, abs=1e-9)


# -- near copies -----------------------------------------------------------


def copies_of_one_text(n, seed, changed):
    """Copies of a text of 120 words, each with some words of its own."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
    out = []
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(*changed)):
            words[at] = f"own{k}x{at}"
        out.append(" ".join(words))
    return out


def test_candidates_grow_with_the_rows(spark):
    """All alike, hardly any similar: twice the rows may give about twice the candidates."""
    made = []
    for n in (200, 400):
        df = spark.createDataFrame([(t,) for t in copies_of_one_text(n, 1, (4, 9))], "text string")
        nodes = near_copies._sketches(df, 5)
        made.append(near_copies._candidates(spark, nodes).count())
        assert made[-1] <= n * near_copies.BANDS * near_copies.NEXT
    assert made[1] <= 3 * made[0]


def test_links_of_groups_equal_all_pairs(spark):
    texts = copies_of_one_text(60, 2, (0, 2)) + copies_of_one_text(40, 3, (0, 6)) + copies_of_one_text(30, 4, (30, 60))
    texts += ["", " \n", "one two", "one  two", "a b c d e", texts[0], texts[0] + " end"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    rows = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(F.xxhash64("text")).collect()]
    place = {h: k for k, h in enumerate(rows)}
    links = {(place[r.a], place[r.b]) for r in near_copies.links(spark, df).collect()}
    sets = [brute.shingles(t, 5) for t in texts]
    assert all(brute.jaccard(sets[a], sets[b]) >= 0.8 for a, b in links)

    def linked(i, j):
        return (place[rows[i]], place[rows[j]]) in links or (place[rows[j]], place[rows[i]]) in links or rows[i] == rows[j]

    got = brute.components(len(texts), linked)
    want = brute.components(len(texts), lambda i, j: brute.jaccard(sets[i], sets[j]) >= 0.8)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if brute.jaccard(sets[i], sets[j]) >= 0.8]
    together = sum(got[i] == got[j] for i, j in pairs)
    assert together >= 0.95 * len(pairs) and all(want[i] == want[j] for i, j in pairs)


@pytest.mark.parametrize("common_at", [near_copies.COMMON, 1])
def test_rows_the_bands_miss_are_linked(spark, monkeypatch, common_at):
    """Without any candidate from the bands, the components are those of all pairs."""
    texts = copies_of_one_text(30, 5, (0, 3)) + copies_of_one_text(30, 6, (3, 6)) + ["", "one two", "a b c d e", " \n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    rows = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(F.xxhash64("text")).collect()]
    place = {h: k for k, h in enumerate(rows)}
    monkeypatch.setattr(near_copies, "COMMON", common_at)
    monkeypatch.setattr(near_copies, "SEEN", 2)
    whole = near_copies._candidates
    monkeypatch.setattr(near_copies, "_candidates", lambda spark, nodes: whole(spark, nodes).where("a IS NULL"))
    links = {(place[r.a], place[r.b]) for r in near_copies.links(spark, df).collect()}
    sets = [brute.shingles(t, 5) for t in texts]
    alike = lambda i, j: brute.jaccard(sets[i], sets[j]) >= 0.8 - 1e-9
    assert all(alike(a, b) for a, b in links)
    found = brute.components(len(texts), lambda i, j: (i, j) in links or (j, i) in links or texts[i] == texts[j])
    assert found == brute.components(len(texts), alike)
    assert len(set(found)) < len(texts) - 20
