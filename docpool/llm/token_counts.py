"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

The state of a prefix is its token count and its last token. Tokens of the model never hold a space
after another character, so the state after each word follows from the state before it and the
word's own tokens: count(prefix + word) = count(prefix) + count(word). Inside a word the state of a
prefix follows from that of a shorter one: its last token is the one vocabulary entry that ends the
prefix and that the model, given it and the shorter prefix's last token, leaves apart. From the
stored counts, questions of budget and truncation are answered without encoding again.

The operator writes such a table, with the count at every character of every text, and answers any budget from it.
A table that is asked for with a limit is a smaller one: it has the count at every word's end, and at every
character of the words in which a multiple of the limit is passed, which is all that budgets in multiples of
the limit ask for. `prefix_table` gives the counts as lists.

Words are cut into parts between characters that stand side by side in no token: no merge reaches over such a
place, so that the states of a part, which many words share, are found once. What the library gives for the whole
word is compared; if it differed, the library would be asked for every prefix.

Defined results: a null text is empty; empty texts have no tokens; special strings are ordinary text
(the library's default); neither begin nor end tokens are added; repeated ids give repeated rows;
null ids stay null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import gc
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpool.llm import common
from docpool.llm.chunk_memo import Memo

#: Tokens that a document may have.
LIMIT = 4096
SPACE = "▁"
_WORDS = re.compile(r" *[^ ]+(?: +\Z)?")
#: A run of letters, with the space before it, or any other character.
_RUNS = re.compile(f"{SPACE}?[^\\W\\d_]+|.", re.S)
TAIL = 4
#: Answers that a worker keeps for parts to come.
MOST_STATES = 400_000
#: Bytes of text whose new words are taken together.
TOGETHER = 4 << 20
#: Begins numbers of four bytes each.
WIDE = b"\x80"


def cut_words(text: str) -> list[str]:
    """The parts of a text that the model encodes independently.

    Each part is given without the space before it, which the library adds to whatever it encodes.
    """
    if SPACE in text:
        return [text]  # the model takes this for a space: where runs of spaces end can't be told
    if "  " not in text and text[:1] != " " and text[-1:] != " ":
        return text.split(" ") if text else []
    first, *rest = _WORDS.findall(text) or [text]
    return [first, *(x[1:] for x in rest)]


class PrefixCounts:
    """The model and what it has been asked."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self.model.get_piece_size()
        plain = (i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i)))
        self.names = [self.model.id_to_piece(i) for i in plain]
        self.pieces = {p: k for k, p in enumerate(self.names)}
        #: Characters side by side in a token; and the lengths of tokens of TAIL characters or more by the last of these.
        self.pairs = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.ends: dict[str, set[int]] = {}
        for p in self.pieces:
            if len(p) >= TAIL:
                self.ends.setdefault(p[-TAIL:], set()).add(len(p))
        self.memo = Memo(self._word_steps)
        #: What _apart has said of two tokens, and _sizes of a tail.
        self.apart: dict[int, bool] = {}
        self.sizes: dict[str, tuple[int, ...]] = {}

    def words(self, texts: list[str]) -> list[list[int]]:
        """For each text, the tokens in each of its parts."""
        return [[n + sum(rest) for n, *rest in (_numbers(w) or [0] for w in row)] for row in self.steps(texts)]

    def steps(self, texts: list[str]) -> list[list[bytes]]:
        """For each text and each of its parts, what the space before the part and each of its characters add to the count.

        A number takes as many bytes as `width` says; the first part of a text has no space: see `first_steps`.
        """
        return self.memo.rows([cut_words(x) for x in texts])

    def _word_steps(self, words: list[str]) -> list[bytes]:
        collecting = gc.isenabled()
        gc.disable()  # nothing here refers to itself, and there are many small lists
        try:
            cut = [self._cut(SPACE + w.replace(" ", SPACE)) for w in words]
            parts = self._part_steps({p for c in cut for p in c})
            out = []
            for word, own, ids in zip(words, cut, self.model.encode(words, num_threads=1)):
                if len(own) == 1:
                    total, raw = parts[own[0]]
                else:
                    totals, raws = zip(*map(parts.__getitem__, own))
                    total, raw = sum(totals), b"".join(raws) if not any(x[:1] == WIDE for x in raws) else _stored([n for x in raws for n in _numbers(x)])
                if total != len(ids) and word:
                    counts = [0, 1, *(len(self.model.encode(word[:k])) for k in range(1, len(word) + 1))]
                    raw = _stored([b - a for a, b in zip(counts, counts[1:])])
                out.append(raw)
            return out
        finally:
            if collecting:
                gc.enable()

    def _cut(self, text: str) -> list[str]:
        """The text, cut before and after runs of letters where nothing merges."""
        parts = _RUNS.findall(text)
        for k in range(len(parts) - 1, 0, -1):
            if parts[k - 1][-1] + parts[k][0] in self.pairs:
                parts[k - 1 : k + 1] = [parts[k - 1] + parts[k]]
        return parts

    def _sizes(self, tail: str) -> tuple[int, ...]:
        """Lengths that tokens may have at the end of a text that ends so."""
        return (*sorted(self.ends.get(tail, ()), reverse=True), *(k for k in range(min(len(tail), TAIL - 1), 0, -1) if tail[-k:] in self.pieces))

    def _part_steps(self, parts: set[str]) -> dict[str, tuple[int, bytes]]:
        """The count of each part, and what each of its characters adds to it.

        In sorted order the states of what a part begins with are mostly there from the one before.
        """
        out: dict[str, tuple[int, bytes]] = {}
        counts, last, before = [0], [-1], ""
        pieces, sizes, apart = self.pieces, self.sizes, self.apart
        if len(sizes) + len(apart) > MOST_STATES:
            sizes.clear(), apart.clear()
        for part in sorted(parts):
            same = 0
            for x, y in zip(part, before):
                if x != y:
                    break
                same += 1
            del counts[same + 1 :], last[same + 1 :]
            for i in range(same + 1, len(part) + 1):
                tail = part[i - TAIL : i] if i > TAIL else part[:i]
                able = sizes.get(tail)
                if able is None:
                    able = sizes[tail] = self._sizes(tail)
                for size in able:
                    if size > i or (piece := pieces.get(part[i - size : i])) is None:
                        continue
                    if (left := last[i - size]) >= 0:
                        met = left << 32 | piece
                        good = apart.get(met)
                        if good is None:
                            good = apart[met] = self._apart(self.names[left], self.names[piece])
                        if not good:
                            continue
                    counts.append(counts[i - size] + 1)
                    last.append(piece)
                    break
                else:  # not in the vocabulary: a token for each byte, and nothing merges with those
                    counts.append(counts[i - 1] + len(part[i - 1].encode()))
                    last.append(-1)
            out[part] = counts[-1], _stored(map(sub, counts[1:], counts))
            before = part
        return out

    def _apart(self, last: str, piece: str) -> bool:
        """Whether the model leaves the two tokens as they are when they meet."""
        if last[-1] + piece[0] not in self.pairs:
            return True
        ids = self.model.encode("\n" + (last + piece).replace(SPACE, " "), out_type=str)  # a line break never merges
        return ids[2:] == [last, piece]

    def inside(self, word: str) -> list[int]:
        """Token counts of word[:0], word[:1], ... as the library would give them."""
        return [0, *accumulate(_numbers(first_steps(self.memo.values([word])[0])))]

    def every_prefix(self, text: str) -> list[int]:
        """Token counts of text[:0], text[:1], ..., text."""
        return [0, *accumulate(x for w in whole_steps(self.steps([text])[0]) for x in _numbers(w))]

    def longest_within(self, text: str, limit: int, counts: list[int]) -> int:
        """Characters of the longest prefix that has at most `limit` tokens; counts: of its parts."""
        so_far = list(accumulate(counts))
        if not so_far or so_far[-1] <= limit:
            return len(text)
        words = cut_words(text)
        k = bisect_right(so_far, limit)
        before = sum(map(len, words[:k])) + max(0, k - 1)
        base = so_far[k - 1] if k else 0
        inner = self.inside(words[k])
        best = max((c for c in range(len(inner)) if c and base + inner[c] <= limit), default=0)
        if k == 0:
            return best
        return before + 1 + best if best or base + 1 <= limit else before


@common.kept
def counter(model: str) -> PrefixCounts:
    """One for each worker process: its table of words serves all of its tasks."""
    return PrefixCounts(model)


def _stored(numbers: Iterable[int]) -> bytes:
    """Small numbers as a byte each; where one isn't small, WIDE and then four bytes each. The first is positive."""
    numbers = list(numbers)
    try:
        return array("b", numbers).tobytes()
    except OverflowError:
        return WIDE + array("i", numbers).tobytes()


def _numbers(raw: bytes) -> array:
    return array("i", raw[1:]) if raw[:1] == WIDE else array("b", raw)


def first_steps(raw: bytes) -> bytes:
    """Of a text's first word, which has no space before it though the library adds one."""
    if len(raw) < 2:
        return b""
    numbers = _numbers(raw).tolist()
    return _stored([numbers[0] + numbers[1], *numbers[2:]])


def whole_steps(words: list[bytes]) -> list[bytes]:
    return [first_steps(words[0]), *words[1:]] if words else []


def every_place(words: list[bytes]) -> tuple[bytes, int]:
    """What each character of a text adds to the token count, and the bytes that a number takes. words: of its parts."""
    words = whole_steps(words)
    if not any(w[:1] == WIDE for w in words):
        return b"".join(words), 1
    return b"".join(array("i", _numbers(w)).tobytes() for w in words), 4


def breaks(words: list[bytes], limit: int) -> tuple[bytes, bytes]:
    """Characters and tokens of prefixes of a text, as differences: of those that end with a word, and of every one
    that ends inside a word in which a multiple of `limit` is passed."""
    chars, tokens, total = array("i"), array("i"), 0
    for raw in whole_steps(words):
        steps = _numbers(raw).tolist()
        n = sum(steps)
        if total // limit == (total + n) // limit:
            chars.append(len(steps))
            tokens.append(n)
        else:
            chars.extend([1] * len(steps))
            tokens.extend(steps)
        total += n
    return chars.tobytes(), tokens.tobytes()


def prefix_counts(docs: DataFrame, model: str, limit: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, limit, width, chars and tokens: the token counts of each text's prefixes, written to the shared folder.

    The running sums of tokens are the exact counts of the prefixes of 1, 2, ... characters; chars is null. With a
    limit above 1 the table is a smaller one: the running sums of chars are places in the text, which are every
    word's end, and every character of the words where a multiple of `limit` is passed. Numbers are signed
    and take `width` bytes each, little-endian: one, but for odd words and smaller tables.
    """

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model)
        for batch in common.steps(batches, "text", TOGETHER):
            sizes = np.diff(common.utf8(batch.column(1))[1])
            steps = own.steps(common.texts_of(batch, "text"))
            if limit == 1:
                tokens, widths = zip(*map(every_place, steps))
                chars = [None] * len(steps)
            else:
                chars, tokens = zip(*(breaks(x, limit) for x in steps))
                widths = [4] * len(steps)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(np.full(len(steps), limit, np.int64)), pa.array(widths, pa.int32()), pa.array(chars, pa.binary()), pa.array(tokens, pa.binary())], _TABLE)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return common.written(rows.mapInArrow(table, "doc_id long, n_bytes long, limit long, width int, chars binary, tokens binary"), "prefix-counts")


_TABLE = ["doc_id", "n_bytes", "limit", "width", "chars", "tokens"]


def truncations(counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and chars_within (characters of the longest prefix of at most `limit`
    tokens) from the table that prefix_counts gives, without the texts or the model.

    ValueError if limit is no multiple of the table's.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(limit % x for x in set(batch.column(2).to_pylist())):
                raise ValueError(f"{limit} is no multiple of the limit that the prefix counts were made for")
            totals, within = [], []
            for width, chars, tokens in zip(batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                steps = np.frombuffer(tokens.as_buffer(), f"<i{width}")
                total, fit = int(steps.sum(dtype=np.int64)), len(steps)
                if total > limit:
                    fit = int(np.flatnonzero(np.concatenate(([0], np.cumsum(steps, dtype=np.int64))) <= limit)[-1])
                totals.append(total)
                within.append(fit if not chars.is_valid else int(np.frombuffer(chars.as_buffer(), "<i4")[:fit].sum()))
            totals = np.array(totals, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(totals), pa.array(totals > limit), pa.array(within, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "over_limit", "chars_within"])

    return counts.select(*_TABLE).mapInArrow(answer, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_within long")


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and chars_within, the longest prefix within the limit: from the stored counts of all prefixes."""
    return truncations(prefix_counts(docs, model, 1, id_col, text_col), limit)


def prefix_table(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and prefix_tokens: the exact token count of every prefix, by characters."""

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model)
        for batch in common.steps(batches, "text"):
            rows = [own.every_prefix(x) for x in common.texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "prefix_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(table, "doc_id long, prefix_tokens array<int>")
