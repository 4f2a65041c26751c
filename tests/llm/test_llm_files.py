"""Archives, token files and packing: round trips, damage, and validity."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import id_coder, id_files, packing, tokens, warc


def html_pages(spark):
    rows = [
        (1, "http://a/ü b", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, None, None), (9, "u", ""),
        (None, "http://c", "<p>one</p>"), (None, None, "<p>ü</p>"), (5, "x\r\ny", "WARC/1.1\r\n\x1f"),
        (2, "http://b", "<p>one</p>"), (7, "http://d", "z" * 3_000_000),
    ]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "sha1", F.lit("no")
    )


def test_warc_round_trip(spark):
    rows, pages = html_pages(spark)
    folder = session.scratch_path(spark, "warc")
    manifest = warc.write_archives(spark, pages.repartition(3), folder)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    found = warc.read_archives(spark, folder).collect()
    assert len(found) == len(rows) and not any(r.kind == "gap" for r in found)
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(last.get(html or "", page), page)
    import base64
    import hashlib

    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        keeper = last.get(html or "")
        revisit = keeper is not None and page != keeper
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page, len(data), digest, "revisit" if revisit else "response",
                     keeper if revisit else None, None if revisit else data))
    got = [
        (r.page_id, r.payload_bytes, r.payload_digest, r.kind, r.refers_to,
         None if r.payload is None else bytes(r.payload)) for r in found
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    empty = session.scratch_path(spark, "warc")
    warc.write_archives(spark, pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0
    apart = session.scratch_path(spark, "warc")
    warc.write_archives(spark, pages, apart, min_bytes=11)
    assert warc.read_archives(spark, apart).where("kind = 'revisit'").count() == 0


@pytest.mark.parametrize("zipped", [True, False])
def test_warc_salvage(zipped):
    rng = np.random.default_rng(4)
    records = []
    for k in range(12):
        payload = rng.bytes(int(rng.integers(0, 5000)))
        digest = warc.base32(__import__("hashlib").sha1(payload).digest())
        data = warc.record(k, f"http://h/{k}", payload, digest, None)
        records.append(warc._compressed(data) if zipped else data)
    starts = np.cumsum([0] + [len(r) for r in records])
    data = bytearray(b"".join(records))

    def read(blob):
        rows = list(warc.salvage(io.BytesIO(bytes(blob)), "f"))
        ends = [r["place"] + r["size"] for r in rows]
        assert [r["place"] for r in rows] == [0] + ends[:-1] if rows else not blob
        assert not rows or ends[-1] == len(blob)
        return [r["page_id"] for r in rows if r["kind"] != "gap"], [r for r in rows if r["kind"] == "gap"]

    whole = list(range(12))
    assert read(data) == (whole, [])
    assert read(b"") == ([], [])
    broken = data.copy()
    broken[starts[3] + len(records[3]) // 2] ^= 255
    pages, gaps = read(broken)
    assert pages == [k for k in whole if k != 3]
    assert (gaps[0]["place"], gaps[0]["size"]) == (starts[3], len(records[3]))
    pages, gaps = read(data[: starts[7] - 20] + data[starts[9] + 5 :])
    assert pages == [0, 1, 2, 3, 4, 5, 10, 11] and len(gaps) == 1
    pages, gaps = read(b"junk" * 700 + data + b"tail")
    assert pages == whole and len(gaps) == 2


def test_id_coder_round_trip():
    rng = np.random.default_rng(5)
    for most in (1, 2, 300, 65536):
        blocks = [rng.integers(0, most, n) for n in (900, 400, 400, 33, 1, 1, 0)]
        blocks.insert(0, np.tile(rng.integers(0, most, 37), 40))
        coded = id_coder.encode(blocks)
        back = id_coder.decode(coded, [len(b) for b in blocks])
        assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
        # blocks do not depend on those beside them
        alone = id_coder.encode([blocks[2]])[0]
        assert np.array_equal(alone, coded[2])
    text = np.tile(rng.integers(0, 40000, 60), 60)
    assert sum(map(len, id_coder.encode([text]))) * 32 < 4 * len(text)


def test_id_coder_learns_in_runs():
    # lengths that end before, at and after the steps that learn; blocks alone are the same words
    rng = np.random.default_rng(8)
    drawn = np.minimum(rng.zipf(1.3, 30000), 40000)
    drawn[rng.integers(0, 29000, 3000)] = 65535
    blocks = [drawn[n : 2 * n] for n in (4096, 4096, 3585, 1537, 513, 193, 192, 65, 64, 33, 9, 8)]
    coded = id_coder.encode(blocks)
    back = id_coder.decode(coded, [len(b) for b in blocks])
    for block, words, again in zip(blocks, coded, back):
        assert np.array_equal(block, again)
        assert np.array_equal(words, id_coder.encode([block])[0])
    # ids that never change
    steady = [np.full(4000, n % 7 * 9000) for n in range(40)]
    coded = id_coder.encode(steady)
    assert all(np.array_equal(a, b) for a, b in zip(steady, id_coder.decode(coded, [4000] * 40)))
    assert max(w.nbytes for w in coded) < 100
    assert id_coder.decode(id_coder.encode([]), []) == []
    with pytest.raises(ValueError, match="16 bits"):
        id_coder.encode([np.array([1 << 16])])


def test_a_word_is_encoded_once(monkeypatch):
    encoder, met = tokens.ChunkTokenizer(tokens.default_path()), []
    one = encoder._word
    monkeypatch.setattr(encoder, "_word", lambda word: met.append(word) or one(word))
    texts = ["Strasse strasse, STRASSE! (strasse) strasse.;", "strasse: größe Größe? GRÖSSE"]
    ids, bounds = encoder.encode(pa.array(texts))
    encoder.encode(pa.array(["Strasse; strasse? größe"]))
    assert sorted(met) == ["grösse", "größe", "strasse"]
    for want, lo, hi in zip(ids_of(texts, 0), bounds, bounds[1:]):
        assert np.array_equal(ids[lo:hi], want[:-1])


def ids_of(texts, end):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.default_path())
    encoded = whole.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array(e.ids + [end], np.uint32) for e in encoded]


def test_chunks_encode_like_whole_texts(rows):
    texts = [t for _, t in rows] + [
        "foo<|endoftext|>bar I'LL don't 'S", "ΑΣ ΣΑΣ İ ǅ ﬁ 漢字🎉‍ 12² ½", "a\x1cb\xa0c d", "é́ é Ⅷ",
    ]
    ids, bounds = tokens.ChunkTokenizer(tokens.default_path()).encode(pa.array(texts, pa.string()))
    for want, lo, hi in zip(ids_of(texts, 0), bounds, bounds[1:]):
        assert np.array_equal(ids[lo:hi], want[:-1])


def test_id_files(spark, docs, rows, none, monkeypatch):
    folder = session.scratch_path(spark, "ids")
    manifest = id_files.write_ids(spark, docs, folder)
    found = sorted(id_files.read_ids(spark, folder, manifest).collect(), key=lambda r: r.start)
    encoded = ids_of([t for _, t in rows], id_files.END_ID)
    want = {}
    for (doc, _), ids in zip(rows, encoded):
        want.setdefault(doc, []).append(ids.astype("<u4").tobytes())
    at, before = 0, -1
    for r in found:
        assert r.start == at and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.n_tokens
        want[r.doc_id].remove(bytes(r.ids))
        at += r.n_tokens
        rank = -1 if r.doc_id is None else r.doc_id
        assert rank >= before
        before = rank
    assert not any(want.values())
    empty = session.scratch_path(spark, "ids")
    assert id_files.read_ids(spark, empty, id_files.write_ids(spark, none, empty)).count() == 0


def test_documents_longer_than_a_section(monkeypatch):
    monkeypatch.setattr(id_files, "BLOCK", 8)
    monkeypatch.setattr(id_files, "SECTION", 24)
    out, collected = _sections_of([(1, 5), (None, 70), (3, 1), (4, 24)])
    rows = []
    for entries, ids in id_files.sections(io.BytesIO(out), "f"):
        assert len(ids) == entries["ids"].sum() <= 24
        rows += entries.tolist()
    assert sum(n for d, n, f in rows if f & id_files.NO_ID) == 70
    flipped = bytearray(out)
    flipped[-9] ^= 1
    with pytest.raises(ValueError, match="damaged block|cut short"):
        list(id_files.sections(io.BytesIO(bytes(flipped)), "f"))
    flipped = bytearray(out)
    flipped[20] ^= 1
    with pytest.raises(ValueError, match="damaged section header"):
        list(id_files.sections(io.BytesIO(bytes(flipped)), "f"))


def _sections_of(docs):
    section, out, rng = id_files._Sections(), b"", np.random.default_rng(6)
    for doc, n in docs:
        for data in section.add(doc, rng.integers(0, 50, n).astype(np.uint32)):
            out += data
    return out + section.close(), docs


@pytest.mark.parametrize("capacity", [4096, 64])
def test_packing(spark, docs, rows, none, capacity):
    found = packing.pack(spark, docs, capacity=capacity, per_group=400).collect()
    encoded = ids_of([t for _, t in rows], packing.END_ID)
    want, total = [], 0
    for (doc, _), ids in zip(rows, encoded):
        total += len(ids)
        for k, start in enumerate(range(0, len(ids), capacity)):
            piece = ids[start : start + capacity]
            want.append((doc, k, start, len(piece), zlib.crc32(piece.astype("<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    groups = -(-len(want) // 400)
    assert len(sequences) <= -(-total // capacity) * 1.02 + 2 * groups
    assert packing.pack(spark, none).count() == 0


def test_sum_of_squares_packs_tightly():
    rng = np.random.default_rng(7)
    lengths = np.clip(rng.lognormal(6.2, 1.3, 20_000).astype(int), 1, 4095)
    bins, offsets = packing.fewest(lengths, 4096)
    filled = np.bincount(bins, lengths)
    assert filled.max() <= 4096
    assert bins.max() + 1 <= -(-int(lengths.sum()) // 4096) * 1.004 + 1
