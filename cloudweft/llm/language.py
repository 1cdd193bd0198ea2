"""Language identification: multinomial naive Bayes over hashed character n-grams.

The counts of all rows that may be learned from are added up in numpy in each partition and summed in Spark; the model
is a dense log-probability matrix of languages x ``BUCKETS``, whose size does not depend on the number of rows, and is
broadcast. Scoring takes the matrix rows of a batch's n-grams at once.

Defined results: a text that is null, empty or without a letter gives ``und`` with score 0; a language that is null is
not learned from; with nothing to learn from every text gives ``und``; ties go to the language that sorts first;
repeated rows give repeated results; very long texts are taken whole, in slices of ``SLICE`` characters; other columns
are kept as they are, and those named as a column of the result, in whatever case, are replaced by it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from cloudweft.llm.common import arrow_mapped, column, in_pieces, others

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Smoothing, and the most entries that the matrix may have (languages x buckets).
ALPHA = 0.5
MODEL_ENTRIES = 1 << 24
SLICE = 1 << 17
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_RUNS = regex.compile(r"[^\p{L}\p{M}]+")


def buckets(text: str) -> np.ndarray:
    """Bucket of each n-gram of the lower-cased text in which every run of other characters than letters is one space."""
    clean = f" {_RUNS.sub(' ', text.lower()).strip()} "
    points = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    found = []
    for n in ORDERS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        mixed = np.full(size, n, dtype=np.uint64)
        for k in range(n):
            mixed = (mixed ^ points[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        found.append((mixed >> np.uint64(20)) % np.uint64(BUCKETS))
    return np.concatenate(found).astype(np.int64)


def slices(text: str) -> Iterator[str]:
    for start in range(0, len(text), SLICE):
        yield text[start : start + SLICE]


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a language and a text with letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in in_pieces(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if has_letter(text):
                    own = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    if len(sums) * BUCKETS > MODEL_ENTRIES:
                        raise ValueError("too many languages for a model of bounded size")
                    for part in slices(text):
                        own += np.bincount(buckets(part), minlength=BUCKETS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], names=["lang", "bucket", "n"])

    rows = docs.select(column(text_col).alias("text"), column(lang_col).alias("lang")).where("text is not null and lang is not null")
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages in order, and their log-probabilities (buckets x languages). Uniform prior over languages."""
    found = counts(docs, text_col, lang_col).toPandas()  # at most MODEL_ENTRIES rows
    names = sorted(found["lang"].unique())
    if len(names) * BUCKETS > MODEL_ENTRIES:
        raise ValueError("too many languages for a model of bounded size")
    table = np.full((BUCKETS, len(names)), ALPHA)
    table[found["bucket"].to_numpy(np.int64), np.searchsorted(names, found["lang"].to_numpy(object).astype(str))] += found["n"].to_numpy(float)
    return names, np.log(table / table.sum(axis=0, keepdims=True)) if names else table


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, then lang_pred and score, the posterior of that language."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = others(docs, text_col, "lang_pred", "score")

    def compute(parts: Iterable[pa.Array]) -> Iterator[list[pa.Array]]:
        names, table = shared.value
        for column_ in parts:
            texts = column_.to_pylist()
            totals = np.zeros((len(texts), max(1, len(names))))
            usable = [i for i, text in enumerate(texts) if names and has_letter(text)]
            for group in itertools.batched(((i, part) for i in usable for part in slices(texts[i])), 64):
                found = [buckets(part) for _, part in group]
                starts = np.cumsum([0, *(len(x) for x in found[:-1])])
                np.add.at(totals, [i for i, _ in group], np.add.reduceat(table[np.concatenate(found)], starts, axis=0))
            best = totals.argmax(axis=1)
            shifted = np.exp(totals - totals.max(axis=1, keepdims=True))
            posterior = shifted.max(axis=1) / shifted.sum(axis=1)
            known = set(usable)
            pred = [names[best[i]] if i in known else UNDETERMINED for i in range(len(texts))]
            score = [float(posterior[i]) if i in known else 0.0 for i in range(len(texts))]
            yield [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

    return arrow_mapped(docs, text_col, kept, compute, ("lang_pred", StringType()), ("score", DoubleType()))
