import re
from collections import Counter

import numpy as np

from cloudweft.llm import quality as q
from cloudweft.llm import queries
from tests.llm.corpus import EDGES, JUNK, corpus


def plain(text):
    """The contract's counts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [t for _, t in EDGES] + ["a b c d e f g h " * 5, "from " * 40, "x\nx\n \ny\nx", "one two three four five six seven eight nine one two three four five six seven eight", JUNK[0] * 20]


def test_counts_match_the_contract():
    for text in TEXTS:
        assert q.signals(text)[:5] == plain(text), text


def test_query_matches_brute_force(spark, folder):
    rows = corpus(3, 40) + [(1000 + k, JUNK[k % 4] * (20 + k)) for k in range(40)]
    found = queries.op1_quality_rules(spark, folder(rows)).collect()
    assert len(found) == len(rows)
    want = Counter((i, *plain(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    model = q.fit(Counter(q.pattern(q.votes(q.signals(t))) for _, t in rows))
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    post = dict(zip(((i, t) for i, t in rows), model.posterior([q.pattern(q.votes(q.signals(t))) for _, t in rows])))
    by_id = {i: (t, p) for (i, t), p in post.items()}
    assert all(abs(r.quality - by_id[r.doc_id][1]) < 1e-6 for r in found if r.doc_id in by_id and by_id[r.doc_id][0])
    junk = [r for r in found if (r.doc_id or 0) >= 1000]
    clean = [r for r in found if (r.doc_id or 0) < 900 and r.n_words >= 60]
    assert not any(r.kept for r in junk) and all(r.kept for r in clean)


def test_patterns_are_numbers():
    rng = np.random.default_rng(0)
    for _ in range(50):
        own = tuple(int(v) for v in rng.integers(-1, 2, len(q.RULES)))
        assert q.unpack(q.pattern(own)) == own


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    own = np.zeros((20_000, len(q.RULES)), dtype=int)
    for j, (hit, miss) in enumerate([(0.5, 0.02)] * 7):
        own[:, j] = -(rng.random(20_000) < np.where(good, miss, hit)).astype(int)
    for j in (7, 8):
        own[:, j] = rng.random(20_000) < np.where(good, 0.8, 0.1)
    codes = [q.pattern(tuple(r)) for r in own]
    model = q.fit(Counter(codes))
    assert abs(model.prior - 0.7) < 0.03
    assert ((model.posterior(codes) > 0.5) == good).mean() > 0.97
    assert all(abs(model.bad[j, 0] - 0.5) < 0.05 for j in range(7))


def test_filter_keeps_columns_and_agrees_with_the_query(spark, folder, table):
    rows = corpus(5, 30)
    df = table(rows).withColumnsRenamed({"source": "kept", "lang": "n_words"})
    kept = q.keep_good(df)
    assert kept.columns == df.columns
    want = Counter(r.doc_id for r in queries.op1_quality_rules(spark, folder(rows)).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert q.keep_good(df.limit(0)).count() == 0
    assert queries.op1_quality_rules(spark, folder([])).count() == 0
