"""Mixing by soft membership, with DataFrame operations only.

A labelled table gives documents a domain (``clean``, ``low`` or ``toxic``). A naive Bayes classifier over hashed
words, each counted once a document, predicts the posterior of each domain for every document. Projected gradient
descent then fits a rate r >= 0 for each document so that the expected tokens of each domain, the sum of
rate x tokens x posterior, match the targets in weighted least squares: the sum over domains of error ** 2 / share.
A round reads one narrow table, sums one number for each domain, and moves each rate by r <- max(0, r - step * p.g); the
three sums come to the driver, and the rates stay distributed. After ``ROUNDS`` such rounds a last implicit step of
length 1 / ``RIDGE``, whose g is the gradient after the step, solves the rest: its three numbers are the minimum of a
convex function, found by Newton steps of one pass each, and the projected gradient ends at ``RIDGE`` times them.

A domain without text to repeat (it would have to be repeated more than ``MOST_REPEATS`` times on average) has no error
term: its target is not met, and a warning says so. Otherwise one document, hardly of that domain, would be all of the mixture.

The classifier is fitted on a bounded sample of labelled rows: the ``LABELLED_ROWS`` with the smallest hash of doc_id.
They come from ``known``, which a pipeline sets to all documents: those left by earlier stages lack whole domains.
Its table of words has at most ``BUCKETS`` rows. Everything else covers all rows.

Defined results: a null or empty text has no tokens, the prior as its posterior, and a rate as any other document; rows
of a repeated or null doc_id are rows of their own; without labelled rows of at least two domains, all posteriors are the prior and all
rates equal; an empty table gives an empty result; all other columns are kept as they are. Texts of any length are taken
whole: those of more than ``LONG_BYTES`` in pieces that end with a word, as an array of all their words would fill an
executor. Domains that are equally likely share a document, so there are no ties to break; a labelled doc_id with several
labels has the highest domain.
"""

from __future__ import annotations

import json
import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloudweft.llm.common import SPACE_CLASS, column, discard, tables, written

DOMAINS = ("clean", "low", "toxic")
#: Shares of the tokens that the mixture is to have, and its size as a share of the tokens there are.
TARGETS = {"clean": 0.96, "low": 0.04, "toxic": 0.0}
SIZE = 1.0
LABELLED_ROWS = 200_000
BUCKETS = 1 << 18
#: Texts of more bytes than this are split into words piece by piece; a piece has so many characters and the rest of its last word.
LONG_BYTES = 1 << 20
PIECE_CHARS = 1 << 16
#: A word's evidence on a domain counts by half if its documents n there and those expected, e, have (n - e) ** 2 / (e + 1)
#: equal to this, more if they differ more, and hardly if they agree.
HALF = 9.0
#: Plain rounds, which end early when all errors are within the tolerance; the implicit step follows.
ROUNDS = 4
#: The implicit step's weight of sum(tokens x (change of rate) ** 2); its passes at most, and the error of its equations.
RIDGE = 1e-5
PASSES = 100
EXACT = 1e-8
MOST_REPEATS = 1000
#: The copies of rows whose number of copies is not one are broadcast if they are at most so many, otherwise shuffled.
BROADCAST_ROWS = 1_000_000
TOLERANCE = 1e-4

log = logging.getLogger(__name__)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), f"[{SPACE_CLASS}]+"), lambda w: w != "")


def word_rows(docs: DataFrame, *kept: str) -> DataFrame:
    """(``kept``, row, tokens, word): a row for each distinct word of each row's ``text``, one with a null where there is none."""
    size, row = F.coalesce(F.octet_length("text"), F.lit(0)), F.monotonically_increasing_id()
    short = docs.where(size <= LONG_BYTES).select(*kept, row.alias("row"), words(F.col("text")).alias("words"))
    short = short.select(*kept, "row", F.size("words").cast("long").alias("tokens"), F.explode_outer(F.array_distinct("words")).alias("word"))
    pieces = F.regexp_extract_all("text", F.lit(f"[\\s\\S]{{1,{PIECE_CHARS}}}+[^{SPACE_CLASS}]*+"), F.lit(0))
    long = docs.where(size > LONG_BYTES).select(*kept, (-1 - row).alias("row"), "text")  # numbered before pieces become rows
    long = long.select(*kept, "row", F.explode(pieces).alias("piece"))
    long = long.select(*kept, "row", F.explode_outer(words(F.col("piece"))).alias("word")).groupBy(*kept, "row", "word").agg(F.count("word").alias("n"))
    some = Window.partitionBy(*kept, "row")  # the distinct words of one text; a piece without words is left out if another has some
    long = long.select(*kept, "row", F.sum("n").over(some).alias("tokens"), "word").where("word is not null or tokens = 0")
    return short.union(long)


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def domain() -> Column:
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)


def sample(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of at most LABELLED_ROWS labelled rows; of repeated ones the highest domain."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").select(F.col("doc_id").alias("labelled"), domain().alias("domain"))
    return known.groupBy("labelled").agg(F.max("domain").alias("domain")).orderBy(F.xxhash64("labelled"), "labelled").limit(LABELLED_ROWS)


def classifier(docs: DataFrame, labels: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, list[float]]:
    """(bucket, w0, w1, w2): what a word adds to each domain's logarithm; and the logarithms of the priors."""
    chosen = written(sample(labels), "labelled")
    rows = docs.select(column(id_col).alias("labelled"), column(text_col).alias("text")).join(F.broadcast(chosen), "labelled")
    own = word_rows(rows, "domain").where("word is not null")
    counted = written(own.groupBy(bucket(F.col("word")).alias("bucket"), "domain").agg(F.count("*").alias("n")), "words")
    sizes = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = [math.log((sizes.get(k, 0) + 1) / (total + len(DOMAINS))) for k in range(len(DOMAINS))]
    by = [F.coalesce(F.sum(F.when(F.col("domain") == k, F.col("n"))), F.lit(0)) for k in range(len(DOMAINS))]
    table = counted.groupBy("bucket").agg(*(x.alias(f"n{k}") for k, x in enumerate(by)))
    seen = sum((F.col(f"n{k}") for k in range(1, len(DOMAINS))), F.col("n0"))
    weights = []
    for k in range(len(DOMAINS)):
        n, e = F.col(f"n{k}"), seen * (sizes.get(k, 0) / max(1, total))
        surprise = (n - e) ** 2 / (e + 1.0)
        weights.append(F.log((n + 1.0) / (e + 1.0)) * surprise / (surprise + HALF))
    return table.select("bucket", *(w.alias(f"w{k}") for k, w in enumerate(weights))), prior


def posteriors(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", known: DataFrame | None = None) -> DataFrame:
    """(row, id, digest, tokens, p0, p1, p2) for each row of ``docs``, written to the shared folder. The classifier is
    fitted on the labelled rows of ``known``, by default ``docs``."""
    mark = tables()
    table, prior = classifier(docs if known is None else known, labels, text_col, id_col)
    table = written(table, "classifier")
    each = word_rows(docs.select(column(id_col).alias("id"), column(text_col).alias("text"), F.xxhash64(column(text_col)).alias("digest")), "id", "digest")
    joined = each.withColumn("bucket", bucket(F.coalesce("word", F.lit("")))).join(F.broadcast(table), "bucket", "left")
    sums = joined.groupBy("row", "id", "digest", "tokens").agg(*(F.coalesce(F.sum(f"w{k}"), F.lit(0.0)).alias(f"s{k}") for k in range(len(DOMAINS))))
    logs = [F.col(f"s{k}") + prior[k] for k in range(len(DOMAINS))]
    most = F.greatest(*logs)
    parts = [F.exp(x - most) for x in logs]
    whole = sum(parts[1:], parts[0])
    found = written(sums.select("row", "id", "digest", "tokens", *((x / whole).alias(f"p{k}") for k, x in enumerate(parts))), "posteriors")
    discard(docs.sparkSession, mark, found)
    return found


def rate(gradients: list[list[float]]) -> Column:
    """The rate after all rounds so far: it starts at ``SIZE`` and moves against each round's gradient, never below 0."""
    if not gradients:
        return F.lit(SIZE)
    steps = F.from_json(F.lit(json.dumps(gradients)), "array<array<double>>")
    pull = lambda g: sum((F.col(f"p{k}") * g[k] for k in range(1, len(DOMAINS))), F.col("p0") * g[0])
    return F.aggregate(steps, F.lit(SIZE), lambda r, g: F.greatest(F.lit(0.0), r - pull(g)))


def aims(table: DataFrame, targets: dict[str, float]) -> tuple[int, list[float], list[float], list[bool]]:
    """All tokens; for each domain its share of them (a thousandth at least), the share it is to have, and whether it has
    text for that."""
    n = range(len(DOMAINS))
    first = table.agg(F.sum("tokens").alias("t"), *(F.sum(F.col("tokens") * F.col(f"p{k}")).alias(f"s{k}") for k in n)).first()
    total = first.t or 0
    own = [first[f"s{k}"] / total if total else 0.0 for k in n]
    goal = [SIZE * targets.get(d, 0.0) / sum(targets.values()) for d in DOMAINS]
    return total, [max(x, 1e-3) for x in own], goal, [goal[k] <= MOST_REPEATS * own[k] for k in n]


def fit(table: DataFrame, targets: dict[str, float], rounds: int = ROUNDS) -> tuple[list[list[float]], list[float]]:
    """The gradients of plain rounds, and what share of the tokens each domain has in the end."""
    n = range(len(DOMAINS))
    total, share, goal, has = aims(table, targets)
    gradients: list[list[float]] = []
    got = [0.0 for _ in n]
    if not total:
        return gradients, got
    for left in range(rounds, -1, -1):
        r = rate(gradients)
        sums = table.agg(*(F.sum(F.col("tokens") * r * F.col(f"p{k}")).alias(f"s{k}") for k in n)).first()
        got = [sums[f"s{k}"] / total for k in n]
        if not left or max(abs(got[k] - goal[k]) for k in n) < TOLERANCE:
            break
        # With errors over shares the curvature is at most 1, so a step of 1 is safe.
        gradients.append([round((got[k] - goal[k]) / share[k], 9) if has[k] else 0.0 for k in n])
    return gradients, got


def solved(table: DataFrame, targets: dict[str, float]) -> tuple[list[list[float]], list[float], float]:
    """The steps of ``fit`` and the implicit one, what share of the tokens each domain has then, and the largest error of
    the equations that the last step solves.

    With tokens t of T in all and rates r before it, the step v makes them r(v) = max(0, r - p.v), and is the minimum of
    RIDGE / 2 x sum(share x v ** 2) + goal.v + sum(t x r(v) ** 2) / 2T, where RIDGE x v is the gradient at r(v)."""
    steps, got = fit(table, targets)
    total, share, goal, has = aims(table, targets)
    if not total:
        return steps, got, 0.0
    n = [k for k in range(len(DOMAINS)) if has[k]]
    pairs = [(a, b) for a in n for b in n if a <= b]
    weight, aim = RIDGE * np.array([share[k] for k in n]), np.array([goal[k] for k in n])

    def full(v: np.ndarray) -> list[float]:
        out = [0.0 for _ in DOMAINS]
        for k, x in zip(n, v):
            out[k] = round(float(x), 9)
        return out

    def at(v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, list[float]]:
        moved = table.withColumn("r", rate([*steps, full(v)]))
        t, active = F.col("tokens") / float(total), F.when(F.col("r") > 0, F.col("tokens") / float(total)).otherwise(0.0)
        sums = moved.agg(F.sum(t * F.col("r") * F.col("r")).alias("q"), *(F.sum(t * F.col("r") * F.col(f"p{k}")).alias(f"s{k}") for k in range(len(DOMAINS))), *(F.sum(active * F.col(f"p{a}") * F.col(f"p{b}")).alias(f"h{a}{b}") for a, b in pairs)).first()
        curve = np.diag(weight)
        for a, b in pairs:
            curve[n.index(a), n.index(b)] += sums[f"h{a}{b}"]
            if a != b:
                curve[n.index(b), n.index(a)] += sums[f"h{a}{b}"]
        shares = [sums[f"s{k}"] for k in range(len(DOMAINS))]
        return weight @ v**2 / 2 + aim @ v + sums.q / 2, weight * v + aim - [shares[k] for k in n], curve, shares

    v = np.zeros(len(n))
    value, slope, curve, got = at(v)
    passes = 1
    while n and abs(slope).max() > EXACT and passes < PASSES:
        way, length = -np.linalg.solve(curve, slope), 1.0
        while passes < PASSES:
            tried = at(v + length * way)
            passes += 1
            if tried[0] <= value + 1e-4 * length * (slope @ way) or abs(tried[1]).max() <= EXACT:
                v, (value, slope, curve, got) = v + length * way, tried
                break
            length /= 2
    error = float(abs(slope).max()) if n else 0.0
    report = ", ".join(f"{d} {got[k]:.6f} of {goal[k]:.6f}" for k, d in enumerate(DOMAINS))
    log.log(logging.INFO if all(has) and error <= EXACT else logging.WARNING, "mixing: shares reached after %d passes, error %.1e: %s", passes, error, report)
    return [*steps, full(v)], got, error


def uniform(*by: Column) -> Column:
    return F.pmod(F.xxhash64(*by, F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, text_col: str = "text", id_col: str = "doc_id", known: DataFrame | None = None) -> DataFrame:
    """(row, id, digest, tokens, p0, p1, p2, rate, copies): copies is the rate, rounded up or down by a hash of the doc_id."""
    table = posteriors(docs, labels, text_col, id_col, known)
    gradients, _, _ = solved(table, targets or TARGETS)
    return table.withColumn("rate", rate(gradients)).withColumn("copies", F.floor(F.col("rate") + uniform(F.col("id"), F.col("tokens"))).cast("long"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, text_col: str = "text", id_col: str = "doc_id", known: DataFrame | None = None) -> DataFrame:
    """Each row of ``docs`` as often as its rate says, with all its columns. Rates depend on id and text only, so these
    and not row numbers lead back to the rows. ``known`` has the labelled rows to learn from, where ``docs`` lost some."""
    pair = (column(id_col).alias("doc_id"), column(text_col).alias("text"))
    mark = tables()
    fitted = mixed(docs.select(*pair), labels, targets, known=None if known is None else known.select(*pair))
    # Repeated rows may differ in the last bit of their rates: one number of copies holds for all of them.
    copies = written(fitted.groupBy(F.col("id").alias("side_id"), F.col("digest").alias("side_digest")).agg(F.max("copies").cast("int").alias("copies")).where("copies <> 1"), "copies")
    discard(docs.sparkSession, mark, copies)
    # A row for each copy, so that the join itself repeats rows: no text goes through a struct or a generator.
    each = F.when(F.col("copies") > 1, F.sequence(F.lit(1), F.col("copies"))).otherwise(F.array(F.lit(0)))
    side = copies.select("side_id", "side_digest", F.explode(each).alias("copy"))
    side = F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
    inner = [f"c{i}" for i in range(len(docs.columns))]
    keyed = docs.select(*(column(c).alias(i) for c, i in zip(docs.columns, inner, strict=True)), F.xxhash64(column(text_col)).alias("digest"), column(id_col).alias("id"))
    out = keyed.join(side, (F.col("digest") == F.col("side_digest")) & F.col("id").eqNullSafe(F.col("side_id")), "left")
    return out.where("copy is null or copy > 0").select(*(F.col(i).alias(c) for c, i in zip(docs.columns, inner, strict=True)))
