import base64
import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from cloudweft.llm import bpe, language, queries, token_count
from tests.llm.corpus import EDGES, corpus

TEXTS = [t for _, t in EDGES] + ["it's  fine\n\n  now\t\tthen ", "word " * 30_000, "x y " * 20_000, " " * 80_000 + "a", "\n".join(["line's end"] * 9000), "aé " * 30_000 + "1234567"]


@pytest.fixture(scope="module")
def codec():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_matches_the_library(spark, folder, codec):
    rows = corpus(2, 20) + [(3000 + k, t) for k, t in enumerate(TEXTS)]
    found = queries.op4_byte_bpe(spark, folder(rows)).collect()
    want = Counter()
    for i, t in rows:
        ids = codec.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in found) == want


def test_cuts_change_nothing(codec):
    for text in TEXTS:
        parts = list(bpe.pieces(text or "", 50))
        assert "".join(parts) == (text or "")
        if len(text or "") < 100_000:
            assert bpe.encode(text or "", codec, 50) == codec.encode_ordinary(text or "")


def test_other_columns_stay_and_ids_come_back(spark, table):
    df = table(corpus(6, 5)).withColumnRenamed("source", "n_tokens")
    out = bpe.encode_table(df)
    assert out.columns == ["doc_id", "lang", "n_chars", "n_tokens", "ids", "decoded"]
    assert all(len(r.ids) == r.n_tokens for r in out.collect())
    assert bpe.encode_table(df.limit(0)).count() == 0


def test_counts_match_the_library(spark, folder):
    rows = corpus(4, 20) + [(3000 + k, t) for k, t in enumerate(TEXTS)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = queries.op7_token_counts(spark, folder(rows)).collect()
    want = Counter()
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 512] += 1
    assert Counter(tuple(r) for r in found) == want


def test_counts_do_not_depend_on_tier_one(spark, table):
    df = table(corpus(7, 10)).select("doc_id", "text")
    runs = [Counter(map(tuple, token_count.count_tokens(df, entries=n).collect())) for n in (1, 50, 30_000)]
    assert runs[0] == runs[1] == runs[2]
    assert token_count.count_tokens(df.limit(0)).count() == 0


LANGS = {"en": "the cat sat on the mat and then it went home with the other one", "de": "der hund und die katze sind nicht immer beste freunde gewesen", "fr": "le chat était sur la table et il ne voulait pas descendre", "es": "el perro corre por la calle y después vuelve a su casa"}


def test_languages_of_held_out_documents(spark, folder):
    import random

    rng = random.Random(0)
    rows = [(k, " ".join(rng.choices(LANGS[lang].split(), k=rng.randint(3, 40))), lang) for k in range(400) for lang in [rng.choice(list(LANGS))]]
    rows += [(k, t, None) for k, t in EDGES] + [(5000, "1234 !! ..", "en"), (5001, LANGS["fr"] * 5000, "en")]
    found = queries.op3_language_id(spark, folder(rows)).collect()
    assert len(found) == len(rows)
    langs = {i: l for i, _, l in rows}
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert {r.doc_id for r in found if r.held_out} == {i for i, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) > 0.95 * len(held)
    texts = {i: t for i, t, _ in rows}
    for r in found:
        assert 0 <= r.score <= 1 and r.lang_pred in {*LANGS, "und"}
        if r.doc_id not in (None, 908):
            assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", texts[r.doc_id] or ""))
    assert next(r.lang_pred for r in found if r.doc_id == 5001) == "fr"


def test_nothing_to_learn_from(spark, folder):
    found = queries.op3_language_id(spark, folder([(k, "some words", None) for k in range(5)])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 5
    assert queries.op3_language_id(spark, folder([])).count() == 0


def test_frequent_words_are_counted_over_all_rows(spark, table):
    rows = [(k, f"rare{k} rarer{k}\nrare{k} the " + "common " * (k % 3)) for k in range(300)] + [(1000, None), (1001, "")]
    assert set(token_count.frequent_words(table(rows).repartition(3), entries=3)) == {"the", "common", ""}
    seen = token_count.counted((t for _, t in rows), 40)
    assert len(seen) <= 40 + 6 and seen["the"] == 300 and seen["common"] == 300


def plain_buckets(text):
    """Bucket of each n-gram, character by character."""
    clean = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    out = []
    for n in language.ORDERS:
        for k in range(len(clean) - n + 1):
            x = n
            for c in clean[k : k + n]:
                x = ((x ^ ord(c)) * 0x9E3779B97F4A7C15) % 2**64
                x ^= x >> 29
            out.append((x >> 20) % language.BUCKETS)
    return out


def test_predictions_match_brute_force(spark, table):
    import random
    from math import exp, log

    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(LANGS[lang].split(), k=rng.randint(1, 12))), lang) for k in range(80) for lang in [rng.choice(list(LANGS))]]
    new = [(100, "the chat und le perro"), (101, "Die KATZE, and: 12 mesas"), (102, "x"), (103, ""), (104, None), (105, "12 %"), (106, " ".join(t for _, t, _ in rows))]
    counts = {lang: Counter(b for _, t, own in rows if own == lang for b in plain_buckets(t)) for lang in sorted({r[2] for r in rows})}
    found = {r.doc_id: r for r in language.predict(table(new), language.fit(table(rows))).collect()}
    for i, text in new:
        if not re.search(r"[^\W\d_]", text or ""):
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
            continue
        logs = {lang: sum(log((c[b] + language.ALPHA) / (sum(c.values()) + language.ALPHA * language.BUCKETS)) for b in plain_buckets(text)) for lang, c in counts.items()}
        best = max(logs, key=logs.get)
        assert found[i].lang_pred == best
        assert abs(found[i].score - 1 / sum(exp(x - logs[best]) for x in logs.values())) < 1e-9


def test_scores_match_direct_sums(spark, table):
    import numpy as np

    rows = [(k, t, l) for k, (l, t) in enumerate(LANGS.items())]
    names, matrix = language.fit(table(rows))
    counts = {l: np.bincount(language.buckets(t), minlength=language.BUCKETS) for _, t, l in rows}
    for k, name in enumerate(names):
        p = (counts[name] + language.ALPHA) / (counts[name] + language.ALPHA).sum()
        assert np.allclose(matrix[:, k], np.log(p))
