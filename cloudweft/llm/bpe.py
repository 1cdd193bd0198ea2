"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Defined results: a null text counts as empty and has no ids; an empty text likewise; repeated rows give repeated
results; an empty table gives an empty result; other columns, nulls in them too, are kept as they are, and those named
as a column of the result, in whatever case, are replaced by it. Very long texts are taken whole, piece by piece.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType

from cloudweft.llm.common import arrow_mapped, others

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Texts longer than this many characters are encoded piece by piece.
PIECE_CHARS = 1 << 16
#: After a letter a white-space character always starts a new match of the pattern, and no match looks back. A letter
#: after that white space is asked for too, so that the cut never falls into a run of white space.
_SAFE = regex.compile(r"\p{L}(?=\s\S)")


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; loaded once in each worker process, without special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cuts of a text at boundaries that the splitting pattern has in any case; all of it if there is no such place."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def in_parts(text: str, codec: tiktoken.Encoding, size: int = PIECE_CHARS) -> Iterator[list[int]]:
    """The tokens of a text, piece by piece: a list of all of a very long one takes ten times its bytes."""
    for piece in pieces(text, size):
        yield codec.encode_ordinary(piece)


def encode(text: str, codec: tiktoken.Encoding, size: int = PIECE_CHARS) -> list[int]:
    return [token for part in in_parts(text, codec, size) for token in part]


def encode_table(docs: DataFrame, rank_path: str | None = None, pattern: str = public_tokenizers.PATTERN, text_col: str = "text", with_ids: bool = True, digests: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text, then n_tokens, and ids and decoded bytes or their digests.

    ``rank_path`` must be readable on every worker; the ranks are a bounded model, not data.
    """
    path = rank_path or public_tokenizers.path(RANK_FILE)
    kept = others(docs, text_col, "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")
    out = [("n_tokens", LongType())]
    if with_ids:
        out += [("ids", ArrayType(IntegerType())), ("decoded", BinaryType())]
    if digests:
        out += [("ids_sha256", StringType()), ("decoded_sha256", StringType())]

    def compute(texts: Iterable[pa.Array]) -> Iterator[list[pa.Array]]:
        codec = encoding(path, pattern)
        for part in texts:
            counts, ids, ends, raw, id_sums, raw_sums = [], array("i"), [0], [], [], []
            for scalar in part:
                n, own, id_sum, raw_sum = 0, [], hashlib.sha256(), hashlib.sha256()
                for tokens in in_parts(scalar.as_py() or "", codec):
                    back = codec.decode_bytes(tokens)
                    if with_ids:
                        ids.extend(tokens)
                        own.append(back)
                    if digests:
                        id_sum.update((("," if n and tokens else "") + ",".join(map(str, tokens))).encode())
                        raw_sum.update(back)
                    n += len(tokens)
                counts.append(n)
                if with_ids:
                    ends.append(len(ids))
                    raw.append(b"".join(own))
                if digests:
                    id_sums.append(id_sum.hexdigest())
                    raw_sums.append(raw_sum.hexdigest())
            arrays = [pa.array(counts, pa.int64())]
            if with_ids:
                arrays += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32))), pa.array(raw, pa.binary())]
            if digests:
                arrays += [pa.array(id_sums, pa.string()), pa.array(raw_sums, pa.string())]
            yield arrays

    return arrow_mapped(docs, text_col, kept, compute, *out)
