"""Toxicity by compression distance.

Two raw-content dictionaries for zstandard are learned, one from toxic and one from ordinary text. They are
word lists and not the work of zstandard's trainer: in what was tried that one gave no right results. Held out at
sf0.1 (170 toxic and 1,325 other texts learned from), dictionaries that it trained on whole texts of each class rank a toxic text above an ordinary one in 57 to 66
of 100 cases (8, 32 and 110 kB, windows of 64 bytes; mean, largest or largest three gains), trained anew on the
windows that gain most in 58 to 67, and trained on what a dictionary of ordinary text leaves uncompressed in 63
to 79; the lists find over 85 of 100 toxic texts and flag under 3 of 100 others. A text is cut into
windows of about WINDOW bytes at spaces; the score of a window is the number of bytes by which the
toxic dictionary compresses it better. Both dictionaries end in the same common text, so that windows
of ordinary words come out alike, and begin with what is peculiar to their class: beginnings of words that far more of its
documents use than of the other's. A document counts for one only if it has it in a context
(the words before and after) that no earlier document had, so that copies teach nothing.

Calibration, on one in CALIBRATE of the learning rows, from which the lists learn nothing: a logistic function of the bytes that counting windows gain, the
largest gain and the number of windows; the least gain at which a window counts is the one that
predicts the labels best.

Learning is from a sample of labelled rows, TRAIN_BYTES or TRAIN_ROWS of each class on average, drawn by a hash of
the id.

Defined results: null and empty texts have no windows and get the score of such a text; without labelled rows
of both classes every score is the (smoothed) share of toxic rows; rows without a label teach nothing;
an id with several labels is toxic if one of them is; repeated ids give repeated rows; null ids stay
null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.llm import common

#: Bytes of sampled text and sampled rows in a class, on average: whichever is fewer.
TRAIN_BYTES, TRAIN_ROWS = 8_000_000, 20_000
WINDOW, TAIL = 40, 64
COMMON_BYTES, OWN_BYTES = 24_000, 6_000
#: Least log-likelihood ratio (G squared) for a beginning of words to be peculiar to a class.
PECULIAR = 25.0
SHORTEST, LONGEST = 4, 12
CALIBRATE = 3
GAINS = (1, 2, 3, 4)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(rb"[^\s!-/:-@\[-`{-~]+")


def folded(text: str) -> bytes:
    return b" " + text.encode().translate(_LOWER)


def windows(data: bytes) -> list[bytes]:
    """The text in pieces of at least WINDOW bytes that end where a space begins."""
    out, at, n = [], 0, len(data)
    while at < n:
        stop = data.find(b" ", at + WINDOW)
        if stop < 0 or stop > at + 4 * WINDOW:
            stop = n if stop < 0 and n - at <= 4 * WINDOW else at + 4 * WINDOW
        out.append(data[at:stop])
        at = stop
    return out


def peculiar(mine: Counter, other: Counter, m: int, n: int) -> list[tuple[float, bytes]]:
    """Words with their G squared, of those over-represented among m documents against n."""
    out = []
    for word, a in mine.items():
        b = other[word]
        if a < 3 or a * n <= 3 * b * m:
            continue
        e1, e2 = m * (a + b) / (m + n), n * (a + b) / (m + n)
        g = 2 * (a * math.log(a / e1) + (b * math.log(b / e2) if b else 0))
        if g >= PECULIAR:
            out.append((g, word))
    chosen: list[tuple[float, bytes]] = []
    for g, word in sorted(out, key=lambda x: (-x[0], -len(x[1]), x[1])):
        if not any(word.startswith(w) or w.startswith(word) for _, w in chosen):
            chosen.append((g, word))
    return chosen


class Detector:
    """Two dictionaries and a calibration. Pickles as bytes; compressors are made where it is used."""

    def __init__(self, toxic: list[str], ordinary: list[str], weights: tuple[float, float] = (1.0, 1.0)):
        """weights: how many rows each ordinary and each toxic text of the sample stands for."""
        every = [[folded(t) for t in ordinary], [folded(t) for t in toxic]]
        apart = [[t for k, t in enumerate(texts) if k % CALIBRATE == 0] for texts in every]
        classes = [[t for k, t in enumerate(texts) if k % CALIBRATE] for texts in every]
        if not all(map(len, classes)):  # too few to keep some apart
            classes = apart = every
        counts = [self._count(texts) for texts in classes]
        sizes = [max(1, len(texts)) for texts in classes]
        special = [peculiar(counts[k], counts[1 - k], sizes[k], sizes[1 - k]) for k in (0, 1)]
        strange = {w for s in special for _, w in s}
        # common text: the words that most ordinary documents use
        whole = Counter(w for t in classes[0] for w in set(_WORD.findall(t)))
        usual = [w for w, _ in whole.most_common(20_000) if not any(w.startswith(x) for x in strange)]
        shared = b" ".join(reversed(self._fill(usual, COMMON_BYTES)))
        # what comes last is nearest, and so cheapest to point to
        self.dictionaries = [b"".join(b" " + w for w in reversed(self._fill([w for _, w in s], OWN_BYTES))) + b" " + shared for s in special]
        # text that both know by heart: with it a short window is always worth compressing
        self.tail = shared[-TAIL:]
        self._calibrate(apart, weights)

    @staticmethod
    def _count(texts: list[bytes]) -> Counter:
        """Documents with each beginning of a word, SHORTEST to LONGEST bytes or all, in a new context."""
        out, seen = Counter(), set()
        for t in texts:
            words = [b"", *_WORD.findall(t), b""]
            fresh = set(zip(words, words[1:], words[2:])) - seen
            seen |= fresh
            words = {w for _, w, _ in fresh}
            out.update({w[:k] for w in words for k in range(min(SHORTEST, len(w)), min(len(w), LONGEST) + 1)} - {b""})
        return out

    @staticmethod
    def _fill(words: list[bytes], most: int) -> list[bytes]:
        out, size = [], 0
        for w in words:
            size += len(w) + 1
            if size > most:
                break
            out.append(w)
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    @cached_property
    def compressors(self) -> list:
        out = []
        for raw in self.dictionaries:
            d = zstandard.ZstdCompressionDict(raw or b"        ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters(window_log=16, chain_log=16, hash_log=16, search_log=4, min_match=4, target_length=16, strategy=zstandard.STRATEGY_LAZY, write_checksum=0, write_content_size=0, write_dict_id=0)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
        return out

    def gains(self, data: bytes) -> list[int]:
        """By how many bytes each window is shorter under the toxic dictionary."""
        (ordinary, toxic), tail = self.compressors, self.tail
        return [len(ordinary(w + tail)) - len(toxic(w + tail)) for w in windows(data)]

    def _features(self, gains: list[int], least: int) -> list[float]:
        """Of a text: what its counting windows gain together, the largest gain, its length."""
        total = sum(g for g in gains if g >= least)
        return [1.0, math.log1p(total), math.log1p(max([0, *gains])), math.log1p(len(gains)), total / (len(gains) + 4)]

    def _calibrate(self, classes: list[list[bytes]], weights: tuple[float, float]) -> None:
        gains = [[self.gains(t) for t in texts] for texts in classes]
        y = np.concatenate([np.full(len(g), float(k)) for k, g in enumerate(gains)])
        of = np.concatenate([np.full(len(g), weights[k]) for k, g in enumerate(gains)])
        if not gains[0] or not gains[1]:
            self.gain, self.weights = GAINS[0], np.array([math.log(((y * of).sum() + 0.5) / (((1 - y) * of).sum() + 0.5)), 0, 0, 0, 0])
            return
        fits = []
        for least in GAINS:
            x = np.array([self._features(g, least) for texts in gains for g in texts])
            w = np.zeros(x.shape[1])
            for _ in range(25):  # Newton's method, with a little weight decay
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                w = w + np.linalg.solve(x.T @ (x * (of * p * (1 - p))[:, None]) + np.eye(len(w)), x.T @ (of * (y - p)) - w)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            fits.append((float(-(of * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum()), least, w))
        _, self.gain, self.weights = min(fits, key=lambda f: f[:2])

    def score(self, text: str) -> float:
        at = float(np.dot(self._features(self.gains(folded(text)), self.gain), self.weights))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, at))))


def learn(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_bytes: int = TRAIN_BYTES) -> Detector:
    """A Detector from the labelled rows where `usable` holds; usable: a condition on doc_id."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).where(usable).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # mean bytes of a text, for how many rows to draw
    mean = texts.agg(F.avg(F.octet_length("text"))).first()[0] or 1.0
    there = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    rates = {k: min(1.0, sample_bytes / mean / n, TRAIN_ROWS / n) for k, n in there.items()}
    drawn = marks.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_003)) < F.when(F.col("label") > 0, F.lit(rates.get(1, 0.0))).otherwise(F.lit(rates.get(0, 0.0))) * 1_000_003)
    # bounded by what is drawn: some thousand ids
    got = texts.join(F.broadcast(drawn), "doc_id").where("text is not null").select("label", "text").toArrow()
    rows = list(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    rows.sort()
    return Detector([t for k, t in rows if k > 0], [t for k, t in rows if k <= 0], (1 / rates.get(0, 1.0), 1 / rates.get(1, 1.0)))


def score(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score, from 0 to 1, of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in common.steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.score(x) for x in common.texts_of(batch, "text")], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
