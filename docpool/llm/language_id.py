"""Language of a text by inference of a mixture of languages.

Each language is a distribution over hashed byte trigrams of lower-cased letters, learned from
labelled rows. A text's trigrams are taken as draws from a mixture of these; expectation-maximisation
estimates the proportions. Which languages belong to the mixture is decided by likelihood, penalised
by half the logarithm of the number of trigrams for each language. The prediction is the language of
the largest proportion, which is the score. A text that a uniform distribution explains better than
every mixture is in no learned language: `rejected`, as are texts without letters.

Learning is from a sample of labelled rows, TRAIN_DOCS for each language on average, drawn by a hash
of the id.

Defined results: null texts and texts without letters are `und` with score 0 and rejected; rows with
null lang teach nothing; without any labelled row every text is `und`; ties go to the first language
by name; repeated ids give repeated rows; null ids stay null; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.llm import common

#: Sampled rows of a language, on average.
TRAIN_DOCS = 1500
BITS = 16
#: Steps go on until the likelihood is within GAIN of the best there is, MOST_STEPS at the most.
GAIN, MOST_STEPS = 0.05, 500
_ASCII_LETTER = re.compile(r"[A-Za-z]")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 0x20
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)


def trigrams(data: np.ndarray) -> np.ndarray:
    """Hashed trigrams of a text's bytes; ASCII that is no letter counts as a space."""
    b = np.concatenate(([0x20], _FOLD[data], [0x20])).astype(np.uint32)
    space = b == 0x20
    keep = ~(space[1:-1] & (space[:-2] | space[2:]))
    codes = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:])[keep]
    return ((codes * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


class Mixture:
    """Learned distributions of languages."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts.astype(np.float64).T + 0.5  # trigram by language
        self.chances = smooth / smooth.sum(0)
        self.logs = np.log(self.chances)

    def _fit(self, chances: np.ndarray, counts: np.ndarray, total: float) -> tuple[np.ndarray, float]:
        """Proportions and likelihood. Steps end when the likelihood can rise by GAIN at most, by its concavity."""
        share = np.full(chances.shape[1], 1 / chances.shape[1])
        for _ in range(MOST_STEPS):
            slope = chances.T @ (counts / (chances @ share)) / total
            share = share * slope
            # the best proportions' likelihood is at most total * log(max(slope)) above this one's
            if total * np.log(max(slope.max(), 1.0)) <= GAIN:
                break
        return share, float(counts @ np.log(chances @ share))

    def infer(self, data: np.ndarray) -> tuple[int, float, dict[int, float], bool]:
        """The predicted language, its score, the proportions of those selected, whether rejected."""
        grams = trigrams(data)
        n = len(grams)
        if n == 0 or not self.langs:
            return -1, 0.0, {}, True
        if n > 4000:
            counts = np.bincount(grams, minlength=1 << BITS)
            kinds = np.flatnonzero(counts)
            counts = counts[kinds]
        else:
            kinds, counts = np.unique(grams, return_counts=True)
        counts = counts.astype(np.float64)
        alone = counts @ self.logs[kinds]
        best = int(alone.argmax())
        chosen, share, like = [best], np.ones(1), float(alone[best])
        if len(self.langs) > 1:
            cost = 0.5 * np.log(max(n, 2))
            chances = self.chances[kinds]
            whole, top = self._fit(chances, counts, n)
            order = np.argsort(-whole, kind="stable")
            for size in range(2, len(order) + 1):
                if top - like <= cost:  # not even all languages together are worth one more
                    break
                trial = sorted({*order[:size].tolist()})
                parts, got = self._fit(chances[:, trial], counts, n)
                if got - like <= cost * (len(trial) - len(chosen)):
                    break
                chosen, share, like = trial, parts, got
        lead = int(share.argmax())
        return chosen[lead], float(min(1.0, share[lead])), dict(zip(chosen, share.tolist())), like < -n * BITS * np.log(2)


def learn(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = TRAIN_DOCS) -> Mixture:
    """A Mixture from the rows where `usable` holds and lang and text are not null."""
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    there = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not there:
        return Mixture([], np.zeros((0, 1 << BITS)))
    rate = F.create_map(*[F.lit(x) for lang, n in there.items() for x in (lang, min(1.0, sample / n))])
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit("lang")), F.lit(1_000_003)) < rate[F.col("lang")] * 1_000_003)

    def count(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << BITS, np.int64)
        for batch in table.to_batches():
            data, ends = common.utf8(batch.column(0))
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                total += np.bincount(trigrams(data[a:b]), minlength=1 << BITS)
        return pa.table({"lang": [table.column(1)[0].as_py()], "counts": [total.tobytes()]})

    got = drawn.select("text", "lang").groupBy("lang").applyInArrow(count, "lang string, counts binary").toArrow()
    learned = sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    return Mixture([x for x, _ in learned], np.array([np.frombuffer(c, np.int64) for _, c in learned]).reshape(-1, 1 << BITS))


def _judge(model: Mixture, batch: pa.RecordBatch, text_col: str) -> list[tuple]:
    column = batch.column(batch.schema.get_field_index(text_col))
    data, ends = common.utf8(column)
    out = []
    for text, a, b in zip(column.to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
        if not text or not has_letter(text):
            out.append((-1, 0.0, {}, True))
        else:
            lang, score, mix, bad = model.infer(data[a:b])
            out.append((lang, score, mix, bad))
    return out


def predict(docs: DataFrame, model: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, mixture (language to proportion) and rejected of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, mixture map<string,double>, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        own = shipped.value
        for batch in common.steps(batches, "text"):
            rows = _judge(own, batch, "text")
            name = lambda i: own.langs[i] if i >= 0 else "und"
            mixes = [[(name(k), v) for k, v in r[2].items()] for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name(r[0]) for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array(mixes, pa.map_(pa.string(), pa.float64())), pa.array([r[3] for r in rows], pa.bool_())], ["doc_id", "lang_pred", "score", "mixture", "rejected"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def keep_known_languages(docs: DataFrame, model: Mixture, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not rejected; all columns stay and nothing is shuffled."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in common.steps(batches, text_col):
            yield batch.filter(pa.array([not r[3] for r in _judge(shipped.value, batch, text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
