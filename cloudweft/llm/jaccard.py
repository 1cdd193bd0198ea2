"""N-gram Jaccard join by PartEnum signatures.

A document's set holds 64-bit hashes of its distinct word shingles. Two sets a, b link when 100 |a & b| >= PERCENT |a | b|,
that is when their symmetric difference is at most (100 - PERCENT) (|a| + |b|) / (100 + PERCENT). Sizes fall into bands
[l, 100 l / PERCENT], so that linked sets lie in the same band or in neighbouring ones; each set gives signatures for
its own band and, where it is large enough to have a partner there, for the next. In a band with at most k differing
elements, the hashed domain is cut into more than k partitions, so that linked sets have equal ones; a partition that is
equal in both gives them a signature.

A partition with ``THIN`` elements or fewer would be equal in unlike sets as well. As ``SPARE`` of k + SPARE k + 2 partitions
are more than differ, a set of s elements with d thin partitions has at least parts - k(s) equal partitions with each
partner, and if d is less than that, some equal one is not thin: then only partitions that are not thin give
signatures. Each set checks this for itself. Where it fails, which hardly happens to large sets, the second level of the
enumeration follows: of the partitions in a ring, some equal one is even followed by one that differs in at most one
element, so a thin partition signs together with the next one, whole and without each one of its elements. A link needs
one of both: if either set passes its check, they share a signature of the first kind, and otherwise both sign the
second kind as well. So every link shares a signature, whatever the sizes and whatever PERCENT.

Equal sets are one node. Two nodes alone with a signature are a pair. Of more, each bucket compares its nodes with a centre,
the node with most company in all its buckets, and then, where links so far leave several components in a bucket, the
nodes outside the centre's component with all nodes of other components. Pairs pass a bound first: the parities of
``WORDS`` x 64 hashed cells differ in at most as many places as the sets have different elements. The sets themselves decide.

A node is known by a 64-bit hash of its set: among 10 ** 9 different sets two are taken for one with a probability of 3 %.

Defined results: null, empty and blank texts have an empty set and are linked with nothing; with fewer words than a
shingle has, the whole sequence is one; repeated rows are linked; a null doc_id sorts after all others, and of equal ids the
first row comes first; very long texts are taken whole; an empty table gives an empty result; clashing names of other
columns do not matter, as these travel in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cloudweft.llm.common import column, discard, in_pieces, schema_of, tables, whole_row, written
from cloudweft.llm.graph import components

SHINGLE = 5
PERCENT = 80
#: 64-bit words of the parity sketch.
WORDS = 8
#: Keys that are broadcast at most; more are shuffled.
BROADCAST_KEYS = 1_000_000

#: Elements of a partition that gives no signature of its own, and the partitions beyond k for each differing element.
THIN = 1
SPARE = 0.25

_U = np.uint64
_ODD = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) | 1 for k in range(16)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``n`` words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = len(words) - n + 1
    total = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        total += each[k : k + size] * _ODD[k]
    return np.unique(mixed(total))


def node_of(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view(np.int64))


def sketch(own: np.ndarray) -> np.ndarray:
    """Parities of the elements in each of WORDS * 64 cells, as WORDS signed integers."""
    bits = np.bincount((own % _U(WORDS * 64)).astype(np.int64), minlength=WORDS * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def bands(largest: int, percent: int) -> np.ndarray:
    """Upper ends of the bands of sizes, up to the one that holds ``largest``."""
    ends, low = [], 1
    while not ends or ends[-1] < largest:
        ends.append(low * 100 // percent)
        low = ends[-1] + 1
    return np.array(ends)


def most_differing(a: int, b: int, percent: int) -> int:
    """The most elements in which linked sets of these sizes differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def partitions(upper: int, percent: int) -> int:
    """Partitions in a band that ends at ``upper``: more than linked sets there can differ in; 0 if they must be equal."""
    k = most_differing(upper, upper, percent)
    return k + int(SPARE * k) + 2 if k else 0


def signatures(own: np.ndarray, percent: int) -> np.ndarray:
    """All signatures of one set. In bands in which linked sets are equal there is none."""
    size = len(own)
    largest = size * 100 // percent
    ends = bands(max(1, largest), percent)
    band = int(np.searchsorted(ends, size))
    each = mixed(own + _U(0x9E3779B97F4A7C15))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(each, dtype=np.uint64)])
    found = []
    for level in range(band, len(ends)):
        upper = int(ends[level])
        parts = partitions(upper, percent)
        if not parts:
            continue
        edges = (np.arange(1, parts, dtype=np.uint64) * _U((1 << 64) // parts)).astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(own, edges), [size]])
        value, count = sums[at[1:]] - sums[at[:-1]], np.diff(at)
        tag = mixed(np.arange(parts, dtype=np.uint64) + _U(level << 32))
        full = count > THIN
        found.append(mixed(tag[full] ^ (value[full] * _ODD[2])))
        thin = np.flatnonzero(~full)
        if len(thin) < parts - most_differing(size, min(upper, largest), percent):
            continue
        after = (thin + 1) % parts
        options = count[after] + 1  # the next partition as it is, and without each one of its elements
        which = np.repeat(np.arange(len(thin)), options)
        number = np.arange(len(which)) - np.repeat(np.cumsum(options) - options, options)
        without = np.where(number > 0, each[np.minimum(at[after][which] + np.maximum(number - 1, 0), size - 1)], _U(0))
        rest = value[after][which] - without
        found.append(mixed(tag[thin][which] ^ (value[thin][which] * _ODD[3]) ^ mixed(rest + _U(7))))
    return np.concatenate(found).view(np.int64) if found else np.empty(0, dtype=np.int64)


def long_sketch(own: np.ndarray) -> bytes:
    """Parities of the elements in cells of which there are four times as many as elements, in a power of two."""
    size = max(512, 1 << (4 * max(1, len(own)) - 1).bit_length())
    return np.packbits((np.bincount((own & _U(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the number of elements in which two sets differ; the longer sketch is folded onto the other."""
    a, b = sorted((np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def node_table(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` is (row, id, text): (row, id, digest, node, n_shingles, s0..), digest being a hash of the text."""
    schema = schema_of(docs, ["row", "id"], *((c, LongType()) for c in ("digest", "node", "n_shingles", *(f"s{k}" for k in range(WORDS)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            sets = [shingles(text, n) for text in batch.column(3).to_pylist()]
            cells = np.stack([sketch(s) for s in sets]) if sets else np.empty((0, WORDS), dtype=np.int64)
            arrays = [*batch.columns[:3], pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(cells[:, k]) for k in range(WORDS))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "digest", "node", "n_shingles", *(f"s{k}" for k in range(WORDS))])

    rows = docs.select("row", "id", F.xxhash64("text").alias("digest"), "text")
    return rows.mapInArrow(run, schema)


def signature_table(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(signature, node); a node once for each partition of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in in_pieces(batches, 200):
            nodes, found = [], []
            for text in batch.column(0).to_pylist():
                own = shingles(text, n)
                node = node_of(own)
                if len(own) and node not in seen:
                    seen.add(node)
                    found.append(signatures(own, percent))
                    nodes.append(np.full(len(found[-1]), node))
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(nodes).astype(np.int64))], names=["signature", "node"])

    return docs.select("text").mapInArrow(run, "signature long, node long")


def set_table(texts: DataFrame, n: int) -> DataFrame:
    """(node, size, cells, elements) of (node, text): the long sketch, and the hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            sets = [shingles(text, n) for text in batch.column(1).to_pylist()]
            arrays = [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(map(long_sketch, sets), pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "size", "cells", "elements"])

    return texts.select("node", "text").mapInArrow(run, "node long, size long, cells binary, elements binary")


def shared_elements(x: bytes, y: bytes) -> int:
    """How many elements two sets have in common."""
    return len(np.intersect1d(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), assume_unique=True))


def linked(pairs: DataFrame, single: DataFrame, docs: DataFrame, n: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose sets link. Long sketches, an eighth of what is compared in the end, leave hardly any other
    pairs. One document of each node is read again for it; the set of b travels to a, which is a centre with many pairs."""
    spark, mark = docs.sparkSession, tables()
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    first = written(single.join(needed, "node", "left_semi").select("node", "side_id", "side_digest"), f"first-{name}")
    wanted = first.count()
    side = F.broadcast(first) if wanted <= BROADCAST_KEYS else first
    texts = docs.select("id", "text", F.xxhash64("text").alias("digest")).join(side, (F.col("digest") == F.col("side_digest")) & F.col("id").eqNullSafe(F.col("side_id")))
    sets = written(set_table(texts, n), f"sets-{name}")
    if sets.count() > wanted:  # rows that are repeated as a whole
        sets = written(sets.dropDuplicates(["node"]), f"single-{name}")

    def both(some: DataFrame, *columns: str) -> DataFrame:
        for end in ("b", "a"):
            some = some.join(sets.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns)), end)
        return some.select("a", "b", *(f"{c}_{end}" for c in columns for end in ("a", "b")))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            rows = zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)
            keep = [least_difference(x, y) * (100 + percent) <= (100 - percent) * (a + b) for a, b, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                shared = shared_elements(x, y)
                keep.append(100 * shared >= percent * ((len(x) + len(y)) // 8 - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = written(both(pairs, "size", "cells").mapInArrow(near, "a long, b long"), f"close-{name}")
    found = written(both(close, "elements").mapInArrow(exact, "a long, b long"), f"linked-{name}")
    discard(spark, mark, found)
    return found


def bucket_table(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) of the signatures that just two nodes share, and (signature, node, n) of those that more share. Signatures are
    counted by partial aggregation, so a hot one meets as one row from each task; nearly all are alone and end there."""
    mark = tables()
    rows = written(signature_table(docs, n, percent), "signatures")
    counted = rows.groupBy("signature").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")).where("low <> high")
    shared = written(counted, "shared")
    pairs = written(shared.where("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b")).distinct(), "pairs")
    more = shared.where("n > 2").select("signature", "n")
    side = F.broadcast(more) if more.count() <= BROADCAST_KEYS else more
    buckets = written(rows.join(side, "signature").groupBy("signature", "node").agg(F.max("n").alias("n")), "buckets")
    discard(docs.sparkSession, mark, pairs, buckets)
    return pairs, buckets


def classes(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` is (row, id, text) with distinct rows: (row, id, digest, n_shingles, class_digest, class_row, class_id), the
    last three of the class's row with the smallest id, then the smallest row."""
    mark = tables()
    nodes = written(node_table(docs, n), "nodes")
    parts = [f"s{k}" for k in range(WORDS)]
    # One row for each node, by partial aggregation: many equal texts are one row from here on.
    some = [F.min_by("id", "row").alias("side_id"), F.min_by("digest", "row").alias("side_digest")]
    single = written(nodes.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), *(F.first(s).alias(s) for s in parts), *some), "single")
    pairs, buckets = bucket_table(docs, n, percent)
    met = buckets.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    known = written(single.drop("side_id", "side_digest").join(met, "node", "left_semi"), "known")

    # One row for each node or signature is written before it is joined back, so that hot keys of the other side can be split.
    company = written(buckets.groupBy("node").agg(F.sum("n").alias("company")), "company")
    centres = buckets.join(company, "node").groupBy("signature").agg(F.max_by("node", "company").alias("centre"))
    centres = written(centres, "centres")
    star = buckets.join(centres, "signature").where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    star = star.union(pairs).distinct()

    def pruned(pairs: DataFrame, name: str) -> DataFrame:
        first = pairs.join(known.withColumnsRenamed({"node": "a", **{c: f"{c}_a" for c in ("n_shingles", *parts)}}), "a")
        second = known.withColumnRenamed("node", "b")
        return written(first.join(second, (first.b == second.b) & bound("", "_a")).select(first.a, first.b), name)

    def bound(own: str, other: str) -> Column:
        a, b = F.col(f"n_shingles{own}"), F.col(f"n_shingles{other}")
        differ = reduce(Column.__add__, (F.bit_count(F.col(f"{s}{own}").bitwiseXOR(F.col(f"{s}{other}"))) for s in parts))
        return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (differ * (100 + percent) <= (100 - percent) * (a + b))

    links = linked(pruned(star, "star"), single, docs, n, percent, "star")
    found = components(links)

    # What a centre does not reach: nodes of a bucket outside its component, against nodes of other components.
    placed = buckets.join(found, "node", "left").select("signature", "node", F.coalesce("label", "node").alias("label"))
    placed = written(placed, "labelled")
    open_ = placed.groupBy("signature").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("signature")
    open_ = written(open_.join(centres, "signature"), "open")
    placed = placed.join(open_, "signature").join(known, "node")
    labels = found.select(F.col("node").alias("centre"), F.col("label").alias("main"))
    placed = written(placed.join(labels, "centre", "left").withColumn("outside", F.col("label") != F.coalesce("main", "centre")).drop("main"), "placed")
    outer = placed.where("outside").select("signature", *(F.col(c).alias(f"{c}_a") for c in ("node", "label", "n_shingles", *parts)))
    inner = placed.where("node <> centre")
    fresh = (F.col("label") != F.col("label_a")) & (~F.col("outside") | (F.col("node_a") < F.col("node"))) & bound("", "_a")
    rest = outer.join(inner, (outer.signature == inner.signature) & fresh).select(F.col("node_a").alias("a"), F.col("node").alias("b"))
    rest = written(rest.distinct(), "rest")
    links = links.union(linked(rest, single, docs, n, percent, "rest"))
    found = components(written(links, "all-links"))

    member = nodes.join(found, "node", "left").select("row", "id", "digest", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("label", "node")).alias("label"))
    member = written(member, "members")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "digest")
    best = written(member.where("label is not null").groupBy("label").agg(F.min(first).alias("best")), "best")
    discard(docs.sparkSession, mark, member, best)
    out = member.join(best, "label", "left")
    return out.select("row", "id", "digest", "n_shingles", F.coalesce("best.digest", "digest").alias("class_digest"), F.coalesce("best.row", "row").alias("class_row"), F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("class_id"))


def one_of_each(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The row with the smallest id of each class of linked documents, with all columns of ``docs``.

    Rows are told apart by id and a hash of the text, so they need no number; of rows equal in both, one stays.
    """
    plain = docs.select(F.monotonically_increasing_id().alias("row"), column(id_col).alias("id"), column(text_col).alias("text"))
    found = written(classes(plain, n, percent), "classes")
    stays = F.col("id").eqNullSafe(F.col("class_id")) & F.col("digest").eqNullSafe(F.col("class_digest"))
    gone = written(found.where(~stays).select("id", "digest").distinct(), "gone")
    again = written(found.where(stays).groupBy("id", "digest").agg(F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles")).where("n > 1 and n_shingles > 0").select("id", "digest"), "again")
    keyed = docs.select(whole_row(docs).alias("doc"), F.xxhash64(column(text_col)).alias("digest"), column(id_col).alias("id"))

    def at(side: DataFrame, how: str) -> DataFrame:
        near = (F.broadcast(side) if side.count() <= BROADCAST_KEYS else side).withColumnsRenamed({"id": "side_id", "digest": "side_digest"})
        return keyed.join(near, (F.col("digest") == F.col("side_digest")) & F.col("id").eqNullSafe(F.col("side_id")), how)

    keyed = at(gone, "left_anti")
    if again.isEmpty():
        return keyed.select("doc.*")
    single = at(again, "left_anti").select("doc")
    chosen = at(again, "left_semi").groupBy("digest", "id").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc")).select("doc")
    return single.unionByName(chosen).select("doc.*")
