"""Word-first backoff language identification."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandweave.session import Cut

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Added to every count.
SMOOTH = 0.1


def train(labelled: DataFrame, max_docs: int = 8000, longest_gram: int = 4) -> dict:
    """Word and character n-gram frequencies per language from rows ``(doc_id, text, lang)``.

    Fitted on a bounded sample: each of the L languages gives the labelled documents whose hash lies in its lowest
    ``max_docs`` / L / n of all hashes, n being its documents, so that a rare language is not crowded out; those are about
    ``max_docs`` rows, picked where they are read. All their words and all n-grams of these, of any length of word,
    make up the model that is sent to the executors. Counting is done by Spark with the words that scoring finds; an
    n-gram carries the counts of the words that hold it, words being marked at both ends. Null texts and languages are
    ignored; without usable rows there are no languages.
    """
    usable = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        none = np.zeros((0, 0), np.float32)
        return {"langs": [], "words": {}, "word_logs": none, "grams": {}, "gram_logs": none, "longest": longest_gram}
    each = max_docs / len(sizes)
    top = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, 2**63 - 1 if n <= each else int((each / n - 0.5) * 2**64))))
    sample = Cut(usable.where(F.xxhash64(F.col("doc_id").cast("string")) <= F.element_at(top, F.col("lang"))), "language-sample")
    columns = "lang string, item string, n long"

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found.update((lang, word) for word in WORD.findall(text.lower()))
            yield _counted(found)

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for gram in grams(word, longest_gram):
                    found[lang, gram] += n
            yield _counted(found)

    counted = lambda rows: rows.groupBy("lang", "item").agg(F.sum("n").alias("n"))
    words = Cut(counted(sample.df.mapInArrow(words_of, columns)), "language-words")
    parts = counted(words.df.mapInArrow(grams_of, columns))

    langs = sorted(sizes)

    def gathered(counts: DataFrame) -> tuple[dict[str, int], np.ndarray]:
        """Items with their rows in a table of log frequencies by language; bounded by the sample."""
        by = (F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, lang in enumerate(langs))
        table = counts.groupBy("item").agg(*by).toArrow()
        n = np.stack([table.column(i + 1).to_numpy() for i in range(len(langs))], axis=1).astype(np.float64)
        logs = np.log((n + SMOOTH) / (n.sum(axis=0) + SMOOTH * max(len(n), 1)))
        return {item: i for i, item in enumerate(table.column(0).to_pylist())}, logs.astype(np.float32)

    (known, word_logs), (chars, gram_logs) = gathered(words.df), gathered(parts)
    sample.drop()
    words.drop()
    return {"langs": langs, "words": known, "word_logs": word_logs, "grams": chars, "gram_logs": gram_logs, "longest": longest_gram}


def grams(word: str, longest: int) -> set[str]:
    """The different n-grams of a word that is marked at both ends."""
    marked = f"<{word}>"
    return {marked[i : i + k] for k in range(1, longest + 1) for i in range(len(marked) - k + 1)}


def _counted(found: Counter) -> pa.RecordBatch:
    keys = list(found)
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "item", "n"])


class Scorer:
    """Scores texts; the rows of words met before are kept, at most ``limit`` of them at a time."""

    def __init__(self, model: dict, limit: int = 200_000):
        self.model, self.limit = model, limit
        self._restart()

    def _restart(self) -> None:
        self.row: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model["langs"])))
        self.size = 1  # row 0 adds nothing

    def word(self, word: str) -> np.ndarray | None:
        """Log frequencies of a known word; else the mean of its longest n-grams that are known at all."""
        if (own := self.model["words"].get(word)) is not None:
            return self.model["word_logs"][own]
        if not any(map(str.isalpha, word)):
            return None
        marked, known = f"<{word}>", self.model["grams"]
        for k in range(min(self.model["longest"], len(marked)), 0, -1):
            found = [g for i in range(len(marked) - k + 1) if (g := known.get(marked[i : i + k])) is not None]
            if found:
                return self.model["gram_logs"][found].mean(axis=0, dtype=np.float64)
        return np.zeros(len(self.model["langs"]))

    def _index(self, words: list[str]) -> np.ndarray:
        for word in set(words).difference(self.row):
            value = self.word(word)
            if value is None:
                self.row[word] = 0
                continue
            if self.size == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[self.size], self.row[word] = value, self.size
            self.size += 1
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))

    def score(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        if not words or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        if not self.model["langs"]:
            return UNKNOWN, 0.0
        if len(self.row) > self.limit:
            self._restart()
        rows = self._index(words)
        sums = self.table.take(rows, axis=0).sum(axis=0)
        best = int(sums.argmax())
        return self.model["langs"][best], float(1 / np.exp(sums - sums[best]).sum())


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` from ``text`` alone, one map without a shuffle.

    ``score`` is the posterior under equal priors. Null, empty and letterless texts give ``und`` and 0, as does a model
    without languages; of tied languages the first in order wins. Every whole text is scored; other columns and
    repeated rows stay, columns named as the new ones are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.score(text) for i in range(0, batch.num_rows, 512) for text in batch.column(at).slice(i, 512).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*names, "lang_pred", "score"])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
