"""Byte-level BPE: encoding to ids with offsets, and decoding.

The tokenizers library encodes Arrow batches with a model built from a rank file: every vocabulary
entry is written in the byte-to-character alphabet and may come of any two entries that make it up,
the lowest rank first, as in the rank file's own library. A text is cut before each space that a
word follows, where the pattern always begins a match, and each distinct part is encoded once.
Decoding reverses the alphabet and gathers the tokens' bytes; a character whose bytes lie in several
tokens is whole again once all of them are joined.

Defined results: a null text is empty and has no ids; special strings are ordinary text; ids outside
the vocabulary raise in decoding; bytes that aren't UTF-8 decode to U+FFFD in `text` and are whole
in `bytes`; repeated ids give repeated rows; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docpool.llm import common
from docpool.llm.chunk_memo import Memo

#: A space before white space: it doesn't begin a match. Characters of Python's \\s.
_RUNS = [" " + chr(c) for c in range(0x3001) if chr(c).isspace()]
_ASCII_RUNS = [r for r in _RUNS if r.isascii()]
_CUT = re.compile(r"(?= \S)")
#: Letters below U+0250, then ASCII punctuation without the apostrophe, with which other matches begin.
_PLAIN = re.compile(r"([A-Za-zªµºÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


def cut_chunks(text: str) -> tuple[str, list[str]]:
    """The text before its first cut, and what follows the space of each cut.

    Cuts are before each space that another character than white space follows.
    """
    if not any(map(text.__contains__, _ASCII_RUNS if text.isascii() else _RUNS)) and text[-1:] != " ":
        first, *rest = text.split(" ")
        return first, rest
    first, *rest = _CUT.split(text)
    return first, [x[1:] for x in rest]


# --- the alphabet ------------------------------------------------------------------------------


@lru_cache(1)
def byte_letters() -> list[str]:
    """The character for each byte: printable Latin-1 stands for itself, the rest for U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_ALPHABET = "".join(byte_letters())
_BYTES = {c: b for b, c in enumerate(_ALPHABET)}
_SPACE = _ALPHABET[32]


def to_letters(raw: bytes) -> str:
    return codecs.charmap_decode(raw, "strict", _ALPHABET)[0]


def to_bytes(letters: str) -> bytes:
    return bytes(map(_BYTES.__getitem__, letters))


# --- models ------------------------------------------------------------------------------------


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a rank file: a line for each token, base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(4)
def model_from_ranks(path: str, pattern: str) -> str:
    """The JSON of a tokenizers model equal to a rank file."""
    ranks = read_ranks(path)
    letters = {t: to_letters(t) for t in ranks}
    merges = [[letters[t[:k]], letters[t[k:]]] for t in sorted(ranks, key=ranks.get) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    return json.dumps(
        {
            "version": "1.0",
            "added_tokens": [],
            "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
            "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
            "model": {"type": "BPE", "vocab": {letters[t]: r for t, r in ranks.items()}, "merges": merges},
        }
    )


def cuts_before_spaces(tokenizer: Tokenizer) -> bool:
    """Whether texts may be cut before spaces, and words of letters and punctuation go to the merges directly.

    That is so for the pattern of public_tokenizers and for the library's own byte-level splits, which is
    the same one; any other pattern may cut elsewhere.
    """
    if tokenizer.normalizer or not tokenizer.pre_tokenizer:
        return False
    pre = json.loads(tokenizer.pre_tokenizer.__getstate__())
    pre = pre["pretokenizers"] if pre.get("type") == "Sequence" else [pre]
    if any(x.get("add_prefix_space") for x in pre):
        return False
    kinds = [x.get("type") for x in pre]
    if kinds == ["ByteLevel"]:
        return bool(pre[0].get("use_regex", True))
    return kinds == ["Split", "ByteLevel"] and not pre[1].get("use_regex", True) and pre[0]["pattern"] == {"Regex": public_tokenizers.PATTERN} and pre[0]["behavior"] == "Isolated" and not pre[0]["invert"]


class Codec:
    """A tokenizers model; ids are unsigned 32-bit, little-endian. Texts of models that may cut elsewhere than
    before spaces go to the library whole."""

    def __init__(self, tokenizer):
        self.tokenizer, self.by_words = tokenizer, cuts_before_spaces(tokenizer)
        vocab = tokenizer.get_vocab(with_added_tokens=False)
        pieces = [b""] * (max(vocab.values()) + 1)
        for letters, i in vocab.items():
            pieces[i] = to_bytes(letters)
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.words = Memo(self._word_ids)
        self.marks = Memo(lambda marks: [self._merged(m) for m in marks])

    @classmethod
    @common.kept
    def from_json(cls, model: str) -> Codec:
        """One for each worker process: its table of chunks serves all of its tasks."""
        return cls(Tokenizer.from_str(model))

    @classmethod
    @common.kept
    def from_file(cls, path: str) -> Codec:
        return cls(Tokenizer.from_file(path))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, text: str) -> bytes:
        """Ids of one match of the pattern."""
        letters = text.replace(" ", _SPACE) if text.isascii() else to_letters(text.encode())
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _marked(self, marks: str) -> bytes:
        return self.marks.known.get(marks) or self.marks.values([marks])[0]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it.

        Letters, and punctuation after them, are two matches of the pattern and go to the merges
        directly. All other words are encoded as one text, which the pattern cuts before each space.
        """
        out: list[bytes] = [b""] * len(words)
        known, joined = self.words.known, []
        for k, w in enumerate(words):
            if plain := _PLAIN(w):
                stem, marks = plain.groups()
                ids = known.get(stem) if marks else None
                out[k] = (ids or self._merged(" " + stem)) + (marks and self._marked(marks) or b"")
            else:
                joined.append(k)
        if joined:
            raw = self._whole(["".join(" " + words[k] for k in joined)])[0]
            stops = np.cumsum(self.sizes[np.frombuffer(raw, "<u4")])
            cuts = np.searchsorted(stops, np.cumsum([len(words[k].encode()) + 1 for k in joined])) + 1
            for k, a, b in zip(joined, [0, *cuts[:-1].tolist()], cuts.tolist()):
                out[k] = raw[4 * a : 4 * b]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return self._whole(texts)
        # a special string could reach over a cut: such texts go to the library whole
        cut = [(t, []) if any(s in t for s in self.special) else cut_chunks(t) for t in texts]
        firsts = self._whole([first for first, _ in cut])
        flat = iter(self.words.values([w for _, words in cut for w in words]))
        return [first + b"".join(islice(flat, len(words))) for first, (_, words) in zip(firsts, cut)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for."""
        sizes = self.sizes[ids]
        begin = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.starts[ids] - begin, sizes) + np.arange(int(sizes.sum()))]

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last character of each token; split characters belong to each of their tokens."""
        raw = self.decode(ids)
        lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # characters begun before each byte
        stop = np.cumsum(self.sizes[ids])
        begin = stop - self.sizes[ids]
        inside = np.concatenate(((raw & 0xC0) == 0x80, [False]))[begin]
        return lead[begin] - inside, lead[stop]


# --- operators ---------------------------------------------------------------------------------


def _per_batch(docs: DataFrame, model: str, schema: str, row: Callable, id_col: str, text_col: str) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_json(shipped.value)
        for batch in common.steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), *row(codec, common.texts_of(batch, "text"))], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and each token's first and past-the-last character (char_start, char_end)."""

    def row(codec: Codec, texts: list[str]) -> list[pa.Array]:
        ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in codec.encode(texts)]
        spans = [codec.offsets(x) for x in ids]
        return [pa.array(ids, pa.list_(pa.int32())), *(pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1))]

    return _per_batch(docs, model_from_ranks(ranks, pattern), "doc_id long, ids array<int>, char_start array<int>, char_end array<int>", row, id_col, text_col)


def decode(coded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, bytes and text of rows of ids; null ids decode to nothing."""
    shipped = coded.sparkSession.sparkContext.broadcast(model_from_ranks(ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_json(shipped.value)
        for batch in batches:
            raw = [codec.decode(np.array(x or [], np.int64)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())], ["doc_id", "bytes", "text"])

    return coded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, bytes binary, text string")


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded again."""

    def row(codec: Codec, texts: list[str]) -> list[pa.Array]:
        ids = codec.encode(texts)
        back = [codec.decode(np.frombuffer(x, "<u4")) for x in ids]
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in back])]

    return _per_batch(docs, model_from_ranks(ranks, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row, id_col, text_col)
