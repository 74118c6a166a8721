"""The n-gram join against all pairs, on edge rows, and in blocks of a few documents."""

import brute
import numpy as np
import oracle
import pytest
from conftest import ROWS, SF

import __spark_entry__ as entry
from rosterflow.llm import ngram_join

PAIRS = [(r[0], r[1]) for r in ROWS]


def rows_of(df):
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()], key=repr)


def wanted(pairs, percent=ngram_join.PERCENT):
    sets = {i: brute.shingle_set(t, ngram_join.WIDTH) for i, t in pairs}
    groups = brute.jaccard_groups({k: v for k, v in sets.items() if k is not None}, percent)
    return sorted([(i, len(brute.shingle_set(t, ngram_join.WIDTH)), None if i is None else groups.find(i)) for i, t in pairs], key=repr)


def crowd(draw, n=240):
    """Near copies of two bases around the limit, documents of common passages, and rare ones."""
    words = [f"w{i}" for i in range(4000)]
    bases = [draw.choice(words, 120).tolist() for _ in range(2)]
    passages = [draw.choice(words, 30).tolist() for _ in range(6)]
    rows = []
    for i in range(n):
        if i % 3 < 2:
            text = list(bases[i % 3])
            for at in draw.integers(0, 120, draw.integers(0, 6)):
                text[at] = words[draw.integers(0, 4000)]
        elif i % 2:
            text = [w for p in draw.integers(0, 6, 4) for w in passages[p]]
        else:
            text = draw.choice(words, draw.integers(1, 60)).tolist()
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("which", ["edge", "repeated", "nothing"])
def test_edges(request, which):
    pairs = {"edge": PAIRS, "repeated": PAIRS + PAIRS, "nothing": []}[which]
    out = ngram_join.ngram_join(request.getfixturevalue(which))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert rows_of(out) == wanted(pairs)


def test_query_against_sql(spark):
    name = "op11_ngram_join"
    assert oracle.compare(entry.queries()[name](spark, SF), oracle.connect(SF), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("entries", [1 << 19, 2000, 300])
def test_blocks_lose_no_link(spark, monkeypatch, entries):
    """Groups of one block, of several, and of blocks that hold a few documents each."""
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(ngram_join, "BATCH_HASHES", 3000)
    pairs = crowd(np.random.default_rng(6))
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(7)
    assert rows_of(ngram_join.ngram_join(df)) == wanted(pairs)


def test_links_are_similar_pairs(spark):
    pairs = crowd(np.random.default_rng(7), 90)
    rows, links = ngram_join.ngram_join(spark.createDataFrame(pairs, "doc_id long, text string"), with_links=True)
    sets = {i: brute.shingle_set(t, ngram_join.WIDTH) for i, t in pairs}
    links = links.collect()
    assert rows_of(rows) == wanted(pairs) and links
    assert all(100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for a, b in links)


def test_search_finds_what_counting_finds():
    draw = np.random.default_rng(8)
    for turn in range(60):
        percent = int(draw.choice([30, 60, 85, 100]))
        base = draw.choice(200, 40, replace=False)
        sets = []
        for _ in range(30):
            mine = set(base[draw.random(40) < 0.93].tolist()) | set(draw.integers(0, 200, draw.integers(0, 6)).tolist())
            sets.append(np.array(sorted(mine if draw.random() < 0.7 else draw.integers(0, 200, 12).tolist()), np.int64))
        sets = [np.unique(s) for s in sets if len(s)]
        extra = draw.integers(0, 3, len(sets))
        sizes = [len(s) + int(x) for s, x in zip(sets, extra)]
        index = ngram_join.InvertedLists(sets, sizes, percent)
        for q in range(len(sets)):
            if len(sets[q]) < -(-percent * sizes[q] // 100):
                continue
            shared = [len(np.intersect1d(sets[q], s)) for s in sets]
            want = [j for j in range(len(sets)) if j != q and 100 * shared[j] >= percent * (sizes[q] + sizes[j] - shared[j])]
            assert index.search(q) == want


def test_merging_skips_but_loses_nothing():
    draw = np.random.default_rng(9)
    for need in (1, 2, 5):
        lists = [np.unique(draw.integers(0, 50, draw.integers(1, 30))) for _ in range(8)]
        index = ngram_join.InvertedLists([], [], 50)
        index.postings = np.concatenate(lists).tolist()
        ends = np.cumsum([len(x) for x in lists]).tolist()
        counts = np.bincount(index.postings, minlength=50)
        got = dict(index.merged(list(zip([0, *ends], ends)), need))
        assert got == {int(d): int(counts[d]) for d in np.flatnonzero(counts >= need)}


def test_near_copies_are_counted_and_sparse_lists_merged(monkeypatch):
    draw = np.random.default_rng(11)
    base = np.arange(100)
    dense = [np.sort(np.concatenate([draw.choice(base, 88, replace=False), 1000 + 20 * i + np.arange(12)])) for i in range(60)]
    sparse = [np.sort(draw.choice(50_000, 40, replace=False)) for _ in range(60)]
    sparse += [np.append(x[:-2], x[-2:] + 100_000) for x in sparse]
    merged, calls = ngram_join.InvertedLists.merged, []
    monkeypatch.setattr(ngram_join.InvertedLists, "merged", lambda self, *a: calls.append(a) or merged(self, *a))
    for items, percent, merges in ((dense, 70, False), (sparse, 85, True)):
        calls.clear()
        index = ngram_join.InvertedLists(items, [len(x) for x in items], percent)
        sets = [set(x.tolist()) for x in items]
        for q, mine in enumerate(sets):
            want = [d for d, other in enumerate(sets) if d != q and 100 * len(mine & other) >= percent * len(mine | other)]
            assert index.search(q) == want
        assert bool(calls) == merges
