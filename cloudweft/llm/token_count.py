"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast table of pre-token lengths. Each partition of the whole corpus counts its words between blanks in
a table of bounded size, which sheds its rarest half when full; the most frequent ``PART_WORDS`` of each are added up,
and the pre-tokens of the ``FREQUENT`` first ones are encoded once. Tier two is a bounded cache in each worker, filled by
the library. The tables only save work: each length comes from the library, so the counts do not depend on them.
Pre-tokens are never shuffled.

Defined results: a null text counts as empty, with no bytes and no tokens; repeated rows give repeated results; an
empty table gives an empty result; other columns are kept as they are, and those named as a column of the result, in
whatever case, are replaced by it; very long texts are taken whole, piece by piece. Special strings inside a text are taken as
special tokens, which is the library's default; texts that hold one go through the library as a whole.
"""

from __future__ import annotations

import functools
import itertools
from collections import Counter
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType
from tokenizers import Tokenizer

from cloudweft.llm.common import arrow_mapped, column, in_pieces, others

TOKENIZER_FILE = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: Words that a partition counts at once and those that it hands on, the longest of them, words that tier one is made of,
#: and entries of a worker's cache.
PART_COUNTS = 200_000
PART_WORDS = 4096
WORD_CHARS = 32
FREQUENT = 30_000
CACHE_ENTRIES = 400_000
#: Characters of a text that are split at once.
PIECE_CHARS = 1 << 16

_PRE_TOKEN = regex.compile(public_tokenizers.PATTERN)
_SAFE = regex.compile(r"\p{L}(?=\s\S)")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


@functools.lru_cache(maxsize=4)
def specials(path: str) -> tuple[str, ...]:
    return tuple(token.content for token in tokenizer(path).get_added_tokens_decoder().values())


def pre_tokens(text: str) -> Iterator[str]:
    """The matches of the splitting pattern; long texts are cut after a letter that white space follows."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = _SAFE.search(text, start + PIECE_CHARS)
        if cut is None:
            break
        yield from _PRE_TOKEN.findall(text, start, cut.end())
        start = cut.end()
    yield from _PRE_TOKEN.findall(text, start) if start else _PRE_TOKEN.findall(text)


def lengths(parts: list[str], path: str) -> list[int]:
    return [len(x.ids) for x in tokenizer(path).encode_batch(parts, add_special_tokens=False)]


def counted(texts: Iterable[str | None], most: int = PART_COUNTS) -> Counter[str]:
    """Words between blanks, in a table that keeps its more frequent half whenever it has more than ``most`` entries."""
    seen: Counter[str] = Counter()
    for text in texts:
        seen.update((text or "").split(" "))
        if len(seen) > most:
            seen = Counter(dict(seen.most_common(most // 2)))
    return seen


def frequent_words(docs: DataFrame, text_col: str = "text", entries: int = FREQUENT) -> list[str]:
    """The most frequent words between blanks, from counts over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = counted(text for batch in in_pieces(batches) for text in batch.column(0).to_pylist())
        top = [(w, n) for w, n in seen.most_common(PART_WORDS) if len(w) <= WORD_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"])

    parts = docs.select(column(text_col).alias("text")).mapInArrow(run, "word string, n long")
    first = parts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(entries)
    return [r.word for r in first.collect()]


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", entries: int = FREQUENT) -> dict[str, int]:
    """Tier one: the pre-tokens of frequent words, each with a blank before it, and their lengths."""
    words = frequent_words(docs, text_col, entries)
    parts = sorted({x for w in words for x in _PRE_TOKEN.findall(f" {w}") if not any(s in x for s in specials(path))})
    return dict(zip(parts, lengths(parts, path), strict=True))


def count_tokens(docs: DataFrame, path: str | None = None, text_col: str = "text", limit: int = TOKEN_LIMIT, entries: int = FREQUENT) -> DataFrame:
    """All columns of ``docs`` but the text, then n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(TOKENIZER_FILE)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text_col, entries))
    kept = others(docs, text_col, "n_bytes", "n_tokens", "over_limit")

    def compute(texts: Iterable[pa.Array]) -> Iterator[list[pa.Array]]:
        known: dict[str, int] = dict(table.value)
        base, special = len(known), specials(path)
        for batch in texts:
            if len(known) > base + CACHE_ENTRIES:
                known = dict(table.value)
            sizes, counts = [], []
            parts, whole = [], []
            for text in batch.to_pylist():
                text = text or ""
                sizes.append(len(text.encode()))
                odd = any(s in text for s in special)
                whole.append(text if odd else None)
                parts.append([] if odd else list(pre_tokens(text)))
            if missing := list(set(itertools.chain.from_iterable(parts)).difference(known)):
                known.update(zip(missing, lengths(missing, path), strict=True))
            for text, own in zip(whole, parts, strict=True):
                counts.append(sum(map(known.__getitem__, own)) if text is None else lengths([text], path)[0])
            yield [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]

    return arrow_mapped(docs, text_col, kept, compute, ("n_bytes", LongType()), ("n_tokens", LongType()), ("over_limit", BooleanType()))
