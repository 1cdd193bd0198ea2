"""Quality rules as weak supervision.

Each rule votes good (+1), bad (-1) or abstains (0) on a document. Documents with the same votes are counted together,
so that expectation-maximisation, which estimates each rule's accuracy on good and on bad documents and the share of
good ones, runs over at most 3 ** rules weighted patterns however many documents there are. A document is kept when
the posterior probability of good is at least ``THRESHOLD``.

Defined results: a null or empty text has no words, so it fails the base rule; an empty table gives an empty result;
repeated rows get equal results, as do rows with equal votes, so there are no ties to break; columns of the input are kept
as they are, and those of the result that clash with them, in whatever case, replace them. Texts of any length are taken whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from cloudweft.llm.common import SPACE_BYTES, arrow_mapped, column, in_pieces, others

WINDOW = 8
THRESHOLD = 0.5
ROUNDS = 100
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
ENDS = (b".", b"!", b"?", b":", b'"')
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_lower", "n_ended")
RULES = ("short", "odd_words", "symbols", "upper_case", "repetition", "few_words", "shouting", "prose", "varied")
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(WINDOW)], dtype=np.uint64)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of ``WINDOW`` words found twice or more. Hashes choose the windows, words decide."""
    size = len(words) - WINDOW + 1
    if size < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(size, dtype=np.uint64)
    for k in range(WINDOW):
        mixed += (ids[k : k + size] ^ (ids[k : k + size] >> np.uint64(31))) * _FACTORS[k]
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(mixed, twice))
    seen = Counter(tuple(words[i : i + WINDOW]) for i in at)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for i in at:
        if seen[tuple(words[i : i + WINDOW])] > 1:
            edges[i] += 1
            edges[i + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def signals(text: str | None) -> tuple[int, ...]:
    """The values named in ``SIGNALS`` for one text, then the number of words that end in two exclamation marks."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    less = lambda drop: len(raw) - len(raw.translate(None, drop))
    return (
        len(words), len(text or "") - less(SPACE_BYTES), less(SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), len(set(words)), less(UPPER), less(LOWER), sum(line.rstrip().endswith(ENDS) for line in lines), raw.count(b"!!"),
    )


def votes(s: tuple[int, ...]) -> tuple[int, ...]:
    """One vote for each of ``RULES``: all but the last two look for one defect each, the last two for its absence."""
    n, chars, symbols, dup, repeat, lines, distinct, upper, lower, ended, shouts = s
    if n == 0:
        return (-1,) + (0,) * (len(RULES) - 1)
    mean, capitals = chars / n, upper / max(1, upper + lower)
    plain = symbols <= 0.02 * n and shouts <= 0.01 * n and capitals <= 0.25
    return (
        -(n < 20),
        -(not 2.5 <= mean <= 12),
        -(symbols > 0.1 * n),
        -(capitals > 0.4),
        -(repeat > 0.3 * n or (lines >= 5 and dup > 0.3 * lines)),
        -(n >= 30 and distinct < 2 * n**0.5),
        -(shouts > 0.05 * n),
        +(plain and 3 <= mean <= 10 and 2 * ended >= lines),
        +(plain and repeat <= 0.1 * n and dup <= 0.1 * lines),
    )


def pattern(own: tuple[int, ...]) -> int:
    """The votes as one number, in base three."""
    total = 0
    for vote in own:
        total = 3 * total + vote + 1
    return total


def unpack(code: int) -> tuple[int, ...]:
    own = []
    for _ in RULES:
        code, rest = divmod(code, 3)
        own.append(rest - 1)
    return tuple(own[::-1])


@dataclass(frozen=True)
class Model:
    """prior: the share of good documents; good and bad: for each rule, how often it votes -1, 0 and +1 on such ones."""

    prior: float
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, codes: list[int]) -> np.ndarray:
        at = np.array([unpack(c) for c in codes], dtype=np.int64).reshape(-1, len(RULES)) + 1
        rule = np.arange(len(RULES))
        ratio = np.log(self.good) - np.log(self.bad)
        return 1 / (1 + np.exp(-(np.log(self.prior) - np.log1p(-self.prior) + ratio[rule, at].sum(axis=1))))

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """Of each rule's votes, the estimated share that is right on good and on bad documents."""
        return {r: (float(g[2] / (g[0] + g[2])), float(b[0] / (b[0] + b[2]))) for r, g, b in zip(RULES, self.good, self.bad, strict=True)}


#: Where expectation-maximisation starts, and with what weight this counts against the documents.
_START_GOOD, _START_BAD, _START_PRIOR, _WEIGHT = (0.02, 0.48, 0.50), (0.30, 0.60, 0.10), 0.8, 10.0


def fit(patterns: dict[int, int]) -> Model:
    """Expectation-maximisation over counted patterns. A rule's -1 stays likelier on bad documents and its +1 on good ones, so that the classes keep their meaning."""
    codes = sorted(patterns)
    good, bad = np.tile(_START_GOOD, (len(RULES), 1)), np.tile(_START_BAD, (len(RULES), 1))
    model = Model(_START_PRIOR, good, bad)
    if not codes:
        return model
    weight = np.array([patterns[c] for c in codes], dtype=float)
    own = np.array([unpack(c) for c in codes])
    cast = np.stack([own == v for v in (-1, 0, 1)], axis=2).astype(float)

    def rates(of: np.ndarray, start: tuple[float, ...]) -> np.ndarray:
        return (np.einsum("p,prv->rv", of, cast) + _WEIGHT * np.array(start)) / (of.sum() + _WEIGHT)

    for _ in range(ROUNDS):
        p = model.posterior(codes)
        good, bad = rates(weight * p, _START_GOOD), rates(weight * (1 - p), _START_BAD)
        bad[:, 0], good[:, 2] = np.maximum(bad[:, 0], good[:, 0]), np.maximum(good[:, 2], bad[:, 2])
        prior = float((weight @ p + _WEIGHT * _START_PRIOR) / (weight.sum() + _WEIGHT))
        new = Model(prior, good / good.sum(axis=1, keepdims=True), bad / bad.sum(axis=1, keepdims=True))
        moved = max(abs(new.prior - model.prior), np.abs(new.good - model.good).max(), np.abs(new.bad - model.bad).max())
        model = new
        if moved < 1e-8:
            break
    return model


def signal_table(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all but the text by default), then the signals and the pattern of votes."""
    taken = (*SIGNALS, "n_shouts", "pattern", text_col)
    kept = [c for c in others(docs, *taken) if keep is None or c in keep]

    def compute(texts: Iterable[pa.Array]) -> Iterator[list[pa.Array]]:
        for part in texts:
            found = [signals(text) for text in part.to_pylist()]
            columns = zip(*found, strict=True) if found else [()] * (len(SIGNALS) + 1)
            yield [*(pa.array(c, pa.int64()) for c in columns), pa.array([pattern(votes(s)) for s in found], pa.int32())]

    return arrow_mapped(docs, text_col, kept, compute, *((c, LongType()) for c in (*SIGNALS, "n_shouts")), ("pattern", IntegerType()))


def fit_table(table: DataFrame) -> Model:
    """The model of a table of signals: its patterns are counted in Spark, at most 3 ** rules of them come back."""
    return fit({r.pattern: r.n for r in table.groupBy("pattern").agg(F.count("*").alias("n")).collect()})


def base_failed() -> F.Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(table: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """A table of signals with base_failed, quality (the posterior) and kept."""
    spark = table.sparkSession
    codes = list(range(3 ** len(RULES)))  # 19,683 entries
    values = spark.sparkContext.broadcast(model.posterior(codes))

    def compute(codes: Iterable[pa.Array]) -> Iterator[list[pa.Array]]:
        for part in codes:
            yield [pa.array(values.value[part.to_numpy()])]

    found = arrow_mapped(table, "pattern", others(table, "quality", "base_failed", "kept"), compute, ("quality", DoubleType()))
    return found.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Texts are read twice, first to count votes and then to
    judge each row where it is read: a copy of all texts with their votes would take as much disk as the input."""
    spark = docs.sparkSession
    model = fit_table(signal_table(docs, text_col, []))
    values = spark.sparkContext.broadcast(model.posterior(list(range(3 ** len(RULES)))))

    inner, at = [f"c{i}" for i in range(len(docs.columns))], docs.columns.index(text_col)
    schema = StructType([StructField(i, f.dataType) for i, f in zip(inner, docs.schema, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            keep = []
            for text in batch.column(at).to_pylist():
                s = signals(text)
                failed = s[0] < 20 or 100 * s[4] > 30 * s[0]
                keep.append(not failed and bool(values.value[pattern(votes(s))] >= threshold))
            yield batch.filter(pa.array(keep, pa.bool_()))

    plain = docs.select(*(column(c).alias(i) for c, i in zip(docs.columns, inner, strict=True)))
    return plain.mapInArrow(run, schema).select(*(F.col(i).alias(c) for i, c in zip(inner, docs.columns, strict=True)))
