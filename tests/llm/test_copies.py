import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cloudweft.llm import exact, graph, jaccard, queries
from tests.llm.corpus import corpus


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def sets_of(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def classes(rows, n, percent):
    """Class number of each row, by all pairs; rows without words are classes of their own."""
    own = [sets_of(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    holders = defaultdict(list)
    for k, s in enumerate(own):
        shared = Counter(j for e in s for j in holders[e])
        for e in s:
            holders[e].append(k)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(own[j]) - both):
                up[root(k)] = root(j)
    return [root(k) for k in range(len(rows))], own


def test_exact_groups_match_brute_force(spark, folder):
    rows = corpus(8, 60)
    found = queries.op8_exact_dedup(spark, folder(rows)).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[squeezed(t)].append((-len(t or ""), i is None, i or 0))
    want = Counter()
    for i, t in rows:
        own = groups[squeezed(t)]
        want[i, None if min(own)[1] else min(own)[2], len(own), hashlib.sha256(squeezed(t).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    assert Counter(r.text_sha256 for r in found if r.kept) == Counter(dict.fromkeys({r.text_sha256 for r in found}, 1))
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    assert queries.op8_exact_dedup(spark, folder([])).count() == 0


def test_exact_sql(spark, folder):
    path = folder([r for r in corpus(9, 30) if r[0] is not None and r[0] != 908])
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    want = con.sql(queries.oracle_sql()["op8_exact_dedup"]).fetchall()
    assert sorted(map(tuple, queries.op8_exact_dedup(spark, path).collect())) == sorted(want)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_one_of_equal_texts_stays(table, monkeypatch, limit):
    monkeypatch.setattr(exact, "BROADCAST_KEYS", limit)
    rows = corpus(10, 40)
    df = table(rows).withColumnsRenamed({"lang": "prefix", "source": "doc", "n_chars": "n_normal"})
    kept = exact.drop_copies(df)
    assert kept.columns == df.columns
    best = {}
    for i, t in rows:
        best[squeezed(t)] = min(best.get(squeezed(t), (1,)), (-len(t or ""), i is None, i or 0))
    got = [(squeezed(r.text), (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)) for r in kept.collect()]
    assert len(got) == len(best) and dict(got) == best
    assert exact.drop_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_linked_classes_match_brute_force(spark, table, n, percent):
    rows = corpus(11, 150)
    df = table(rows).selectExpr("monotonically_increasing_id() as row", "doc_id as id", "text")
    found = jaccard.classes(df, n, percent).collect()
    root, own = classes(rows, n, percent)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest[root[k]] = min(smallest.get(root[k], (True, 0)), (i is None, i or 0))
    want = Counter((i, len(own[k]), None if smallest[root[k]][0] else smallest[root[k]][1]) for k, (i, _) in enumerate(rows))
    assert len([1 for k in range(len(rows)) if root[k] != k]) > 50
    assert Counter((r.id, r.n_shingles, r.class_id) for r in found) == want


def test_chains_that_no_centre_reaches(spark, folder):
    """Documents of which only neighbours link, around texts that none of them equals."""
    rng = random.Random(3)
    rows = []
    for c in range(6):
        words = [f"w{c}x{k}" for k in range(120)]
        for step in range(12):
            rows.append((len(rows), " ".join(words)))
            words[rng.randrange(120)] = f"n{c}s{step}"
    for c in range(40):
        words = [f"base{k}" for k in range(100)]
        for k in rng.sample(range(100), 4):
            words[k] = f"e{c}k{k}"
        rows.append((len(rows), " ".join(words)))
        words[rng.randrange(100)] = f"again{c}"
        rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    found = queries.op5_ngram_jaccard(spark, folder(rows)).collect()
    root, _ = classes(rows, 4, 85)
    first = {}
    for k, (i, _) in enumerate(rows):
        first[root[k]] = min(first.get(root[k], i), i)
    assert {r.doc_id: r.component_id for r in found} == {i: first[root[k]] for k, (i, _) in enumerate(rows)}
    assert queries.op5_ngram_jaccard(spark, folder([])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.integers(1, 300), st.integers(300, 6000)), st.floats(0, 0.5), st.sampled_from([30, 50, 80, 85, 90]), st.integers(0, 10**6))
def test_linked_sets_share_a_signature(size, share, percent, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    drop = rng.random(len(a)) < share * rng.random()
    b = np.unique(np.concatenate([a[~drop], rng.integers(0, 2**64, int(share * size * rng.random()), dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    if len(b) and 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
        assert len(np.intersect1d(jaccard.signatures(a, percent), jaccard.signatures(b, percent)))
    assert jaccard.shared_elements(a.tobytes(), b.tobytes()) == both
    bits = np.bitwise_count((jaccard.sketch(a) ^ jaccard.sketch(b)).view(np.uint64)).sum()
    assert bits <= len(a) + len(b) - 2 * both
    assert jaccard.least_difference(jaccard.long_sketch(a), jaccard.long_sketch(b)) <= len(a) + len(b) - 2 * both


@pytest.mark.parametrize("percent", [80, 85])
def test_large_sets_at_the_threshold_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for size in (430, 600, 1000, 3000, 8000, 20_000):
        for _ in range(12):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            both = int(rng.integers(percent * len(a) // 100 + 1, len(a) + 1))
            more = both * 100 // percent - len(a)
            b = np.unique(np.concatenate([rng.permutation(a)[:both], rng.integers(0, 2**64, more, dtype=np.uint64)]))
            assert 100 * both >= percent * (len(a) + len(b) - both) >= 100 * both - 200
            if len(b) != both or both != len(a):
                assert len(np.intersect1d(jaccard.signatures(a, percent), jaccard.signatures(b, percent)))
        assert len(jaccard.signatures(a, percent)) < len(a)  # large sets need the first kind only


def test_one_of_similar_texts_stays(table):
    rows = corpus(12, 80)
    df = table(rows).withColumnsRenamed({"lang": "row", "source": "doc", "n_chars": "node"})
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    root, own = classes(rows, 5, 80)
    want = Counter()
    best: dict = {}
    for k, (i, _) in enumerate(rows):
        key = root[k] if own[k] else ("none", k)
        best[key] = min(best.get(key, (True, 10**9)), (i is None, i or 0))
    for no_id, i in best.values():
        want[None if no_id else i] += 1
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert jaccard.one_of_each(df.limit(0)).count() == 0


def test_components_of_a_graph(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(0, 40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(40)]
    up = {x: x for pair in links for x in pair}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    found = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {k: root(k) for k in up}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
