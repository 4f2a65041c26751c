"""Token ids of whole texts, computed in tasks with a public tokenizer file.

Texts are cut into chunks whose ids do not depend on what stands around them.
Where to cut is decided by what the vocabulary file says about itself:

- ``blank``: the normalizer makes all white space one blank and the
  pre-tokenizer drops it, so a text is cut at blanks and line feeds, which go;
- ``before``: byte-level files with the usual pattern. A word takes the one
  blank before it along; a text is cut before a blank that follows a letter,
  digit or ASCII sign, unless only blanks follow;
- ``piece``: sentencepiece files that keep white space and have no piece with a
  blank inside. Cut as ``before``; the blank that starts a chunk is the one the
  library itself puts before a text;
- ``whole``: all other files; a text is one chunk.

Each batch is reduced to its distinct chunks first, and a worker remembers the
ids of chunks it has met, as packed integers, up to CACHE of them.
"""

from __future__ import annotations

import itertools
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 600_000
SLICE_BYTES = 4 << 20

_READY: dict[str, "ChunkTokenizer"] = {}

_BEFORE = re.compile(r"(?<=[\w!-~])(?= +[^ ])")

# letters whose lower case and normal form need no library
_LATIN = re.compile("[A-Za-zÀ-ÖØ-Þß-öø-ÿ]+")
_ENDS = ".,;:!?"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenizer(path: str) -> "ChunkTokenizer":
    """The worker's tokenizer for a vocabulary file."""
    if path not in _READY:
        _READY[path] = ChunkTokenizer(path)
    return _READY[path]


def cut_of(path: str) -> str:
    """How texts may be cut for a vocabulary file: blank, before, piece or whole."""
    if path.endswith(".model"):
        return _cut_of_pieces(path)
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"])
           for t in said["added_tokens"]) or said.get("truncation") or said.get("padding"):
        return "whole"
    normal, cut = said["normalizer"], said["pre_tokenizer"]
    if normal is None and cut and cut["type"] == "ByteLevel":
        return "before" if cut["use_regex"] and not cut["add_prefix_space"] else "whole"
    steps = normal.get("normalizers", []) if normal else []
    blanks = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    simple = all(n == blanks or n["type"] in ("NFC", "Lowercase") for n in steps)
    first = (cut or {}).get("pretokenizers", [{}])[0]
    drops = first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
    spaced = drops and r"[^\s\p{L}\p{N}]+" in first["pattern"].get("Regex", "")
    rest = (cut or {}).get("pretokenizers", [{}])[1:]
    plain = all(r["type"] == "ByteLevel" and not r["use_regex"] and not r["add_prefix_space"] for r in rest)
    return "blank" if blanks in steps and simple and spaced and plain else "whole"


def _cut_of_pieces(path: str) -> str:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    inside = any(re.search("[^▁]▁", model.id_to_piece(i)) for i in range(model.get_piece_size()))
    keeps = "".join(model.encode("a  b ", out_type=str)) == "▁a▁▁b▁" and not model.encode("")
    return "piece" if keeps and not inside else "whole"


class ChunkTokenizer:
    def __init__(self, path: str):
        self.cut = cut_of(path)
        self.pieces = path.endswith(".model")
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, list[int]] = {}
        if self.pieces:
            from sentencepiece import SentencePieceProcessor

            self.whole = SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def _word(self, word: str) -> bytes:
        """Ids of one run of lower-case Latin letters."""
        mapped = word if word.isascii() else word.translate(self.as_bytes)
        return _packed([t.id for t in self.model.tokenize(mapped)])

    def _part(self, text: str) -> bytes:
        if text not in self.parts:
            self.parts[text] = _packed(self.whole.encode(text, add_special_tokens=False).ids)
        return self.parts[text]

    def ids_of(self, chunks: list[str], known: dict[str, bytes] | None = None) -> list[bytes]:
        """The packed ids of each chunk; those of words and other chunks are added to ``known``."""
        known = {} if known is None else known
        if self.pieces:
            plain = [c[1:] if self.cut == "piece" else c for c in chunks]
            found = [_packed(ids) for ids in self.whole.encode(plain, num_threads=1)]
            known.update(zip(chunks, found))
            return found
        found, other = [b""] * len(chunks), range(len(chunks))
        if self.cut == "blank":
            other = []
            for k, chunk in enumerate(chunks):
                text = chunk.rstrip(_ENDS)
                if not (text.isalpha() if text.isascii() else _LATIN.fullmatch(text)):
                    other.append(k)
                    continue
                word = text.lower()
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = self._word(word)
                found[k] = ids if len(text) == len(chunk) else ids + self._part(chunk[len(text) :])
        rest = [chunks[k] for k in other]
        encoded = self.whole.encode_batch_fast(rest, add_special_tokens=False)
        for k, chunk, one in zip(other, rest, encoded):
            found[k] = known[chunk] = _packed(one.ids)
        return found

    def learn(self, chunks: list[str]) -> list[bytes]:
        """The packed ids of different chunks. Words are remembered without capitals and signs."""
        ids = list(map(self.known.get, chunks))
        new = [k for k, known in enumerate(ids) if known is None]
        if len(self.known) + len(new) > CACHE:
            self.known = {}
        for k, one in zip(new, self.ids_of([chunks[k] for k in new], self.known)):
            ids[k] = one
        return ids

    def chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All chunks one after the other, and the n + 1 bounds between texts."""
        texts = pc.fill_null(texts, "")
        if self.cut == "blank":
            split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            return split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
        if self.cut == "whole":
            return texts, np.arange(len(texts) + 1)
        start = " " if self.cut == "piece" else ""
        cut = [_BEFORE.split(start + t) if t else [] for t in texts.to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in cut], dtype=np.int64)])
        return pa.array(itertools.chain.from_iterable(cut), pa.string()), bounds

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the n + 1 bounds between texts."""
        chunks, bounds = self.chunks(texts)
        chunks = chunks.dictionary_encode()
        ids = self.learn(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        starts = np.cumsum(sizes) - sizes
        codes = chunks.indices.to_numpy()
        n = sizes[codes]
        ends = np.cumsum(n)
        at = np.repeat(starts[codes] - (ends - n), n) + np.arange(int(n.sum()))
        return flat[at], np.concatenate([[0], ends])[bounds]


def slices(batch: pa.RecordBatch, text: str = "text"):
    """Parts of a batch with at most SLICE_BYTES of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def id_bytes(ids: np.ndarray) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.ascontiguousarray(ids, "<u4").tobytes()
