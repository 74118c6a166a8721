"""The Merkle manifest and the vector codes against plain versions, and on edge rows."""

import collections
import hashlib
import math
import zlib

import numpy as np
import oracle
import pytest
from conftest import SF

import __spark_entry__ as entry
from rosterflow.llm import merkle_manifest, vector_codes

H = merkle_manifest.digest


# 12. Merkle manifest

def plain_leaf(doc_id, source, lang, n_chars, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(nodes):
    """Root and, per node, the marks of its siblings."""
    marks, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            other = place ^ 1
            marks[i].append(("<" if other < place else ">") + nodes[other] if other < len(nodes) else "")
            at[i] = place >> 1
        nodes = [H("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], marks


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, siblings, folded) of (doc_id, source, lang, n_chars, text)."""
    nulls_first = lambda v: (v is not None, v)
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[2]].append((row, plain_leaf(*row)))
    subroots, found = [], []
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        leaves = sorted(groups[lang], key=lambda x: (nulls_first(x[0][0]) if x[0][0] is not None else (False, 0), x[1]))
        top, marks = plain_tree([leaf for _, leaf in leaves])
        found.append([(row, leaf, top, m) for (row, leaf), m in zip(leaves, marks)])
        subroots.append(top)
    root, over = plain_tree(subroots) if subroots else (None, [])
    out = []
    for members, above in zip(found, over):
        for row, leaf, top, m in members:
            doc_id, source, lang, n_chars, text = row
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            end = plain_leaf(doc_id, source, lang, n_chars + 1, text) if hit and n_chars is not None else leaf
            for mark in m + above:
                end = H(mark[1:] + end if mark[:1] == "<" else end + mark[1:])
            out.append((doc_id, leaf, top, root, tuple(m + above), end))
    return sorted(out, key=repr)


def manifest_of(df, **more):
    rows = merkle_manifest.manifest(
        df, changes={"n_chars": merkle_manifest.plus_one("n_chars")}, where=merkle_manifest.tampered_rows("doc_id"), **more
    ).collect()
    return sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(r["siblings"]), r["folded_root"]) for r in rows], key=repr)


def fields(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("which", ["edge", "repeated", "documents", "nothing"])
def test_manifest(request, which):
    df = request.getfixturevalue(which)
    assert manifest_of(df) == plain_manifest(fields(df))


@pytest.mark.parametrize("height", [1, 2, 3])
def test_small_blocks_give_the_same_tree(documents, monkeypatch, height):
    """Many blocks, several steps upwards, and lone last nodes in each of them."""
    monkeypatch.setattr(merkle_manifest, "HEIGHT", height)
    df = documents.where("doc_id <= 43")
    assert manifest_of(df) == plain_manifest(fields(df))


def test_versions_share_all_but_their_ancestors(documents):
    rows = merkle_manifest.manifest(
        documents, changes={"n_chars": merkle_manifest.plus_one("n_chars")}, where=merkle_manifest.tampered_rows("doc_id"), copies=True
    ).collect()
    tampered = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0]
    assert tampered and all(r["copied"] is None for r in rows if r not in tampered)
    for r in tampered:
        assert len(r["copied"]) == len(r["siblings"]) and r["copied"][-1] == r["folded_root"] != r["root"]
    # No copied node is one of the tree's, nor of another version.
    copied = [c for r in tampered for c in r["copied"]]
    assert len(set(copied)) == len(copied)
    assert not set(copied) & {x[1:] for r in rows for x in r["siblings"]}


def test_a_version_shares_the_nodes_beside_its_path_and_leaves_the_old_one_as_it_was():
    m = merkle_manifest
    block = m.Block([H(str(i)) for i in range(11)], 4)
    root, down = m.grown(block.root, ["<" + H("left"), "", ">" + H("right")]), [False, False, True]
    before = m.path_digests(root, down + block.turns(6))
    version = m.replaced(root, down + block.turns(6), H("other"))
    old, new = root, version
    for right in down + block.turns(6):
        assert new is not old and new.digest != old.digest
        shared = (old.left, new.left) if right else (old.right, new.right)
        assert shared[0] is shared[1]
        old, new = (old.right, new.right) if right else (old.left, new.left)
    assert (old.digest, new.digest) == (H("6"), H("other")) and m.path_digests(root, down + block.turns(6)) == before


def test_every_proof_is_folded(documents, monkeypatch):
    """Not only those of changed leaves: a wrong proof of a sound row must not verify."""
    real = merkle_manifest.beside
    monkeypatch.setattr(merkle_manifest, "beside", lambda root, turns: [x[:1] + H(x) if x else x for x in real(root, turns)])
    rows = merkle_manifest.manifest(documents.where("doc_id < 40")).collect()
    assert rows and all(r["folded_root"] != r["root"] for r in rows)


def test_lengths_beyond_the_largest_integer_and_trees_of_one_row(spark):
    rows = [(i, "s", lang, 2 ** 63 - 1, "t") for i, lang in enumerate(["b", "é", None, "", "b"] * 9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_of(df) == plain_manifest([(a, b, c, d, e) for a, b, c, d, e in rows])
    one = df.where("doc_id = 0")
    assert manifest_of(one) == plain_manifest(rows[:1])


# 13. Vector codes

def plain_codes(rows, parts=4, rounds=4):
    """Per kept row (vec_id, code, error), and the codebooks' digest."""
    kept = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[math.floor(1024 * y) for y in v] for _, v, _ in kept], np.int64)
    pieces = np.split(x, parts, axis=1)
    books = [p[:256].copy() for p in pieces]

    def assign():
        far = [((p[:, None, :] - b[None]) ** 2).sum(2) for p, b in zip(pieces, books)]
        return [f.argmin(1) for f in far], [f.min(1) for f in far]

    for _ in range(rounds):
        codes, _ = assign()
        for p, (piece, code) in enumerate(zip(pieces, codes)):
            for j in set(code.tolist()):
                books[p][j] = piece[code == j].sum(0) // (code == j).sum()
    codes, far = assign()
    text = ",".join(str(v) for b in books for v in b.ravel().tolist())
    out = [(i, "".join(f"{c[n]:02x}" for c in codes), int(sum(f[n] for f in far)), k) for n, (i, _, k) in enumerate(kept)]
    return out, hashlib.sha256(text.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, error string, code int"


def coded(spark, tmp_path, rows, dropped=()):
    spark.createDataFrame([(*r, "e", 1) for r in [*rows, *dropped]], VECTORS).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = entry.queries()["op13_vector_codes"](spark, str(tmp_path)).collect()
    if not rows:
        assert got == []
        return
    want, seal = plain_codes([(i, v, k) for i, v, k in rows])
    labels = collections.Counter()
    for _, _, error, k in want:
        labels[k] += error
    assert {r["codebooks_sha256"] for r in got} == {seal}
    assert sorted([(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got], key=repr) == sorted(
        [(i, code, error, labels[k]) for i, code, error, k in want], key=repr
    )


def test_codes_of_skewed_and_repeated_vectors(spark, tmp_path):
    draw = np.random.default_rng(3)
    common = [0.5] * 8
    rows = [(i, draw.normal(size=8).astype(np.float32).tolist(), int(i % 3) if i % 5 else None) for i in range(700)]
    rows += [(1000 + i, common, 7) for i in range(400)] + rows[:40] + [(None, common, None)]
    dropped = [(5000, None, 1), (5001, [1.0, None] * 4, 1), (5002, [float("nan")] + common[1:], 1), (5003, [float("-inf")] + common[1:], None), (5004, [], 2), (5005, [1.0] * 4, 2)]
    coded(spark, tmp_path, rows, dropped)


def test_codes_with_ties_and_few_rows(spark, tmp_path):
    """Entries that coincide from the start, on a grid where equal distances abound."""
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.integers(-1, 2, 8)], 1) for i in range(300)]
    coded(spark, tmp_path, rows)


def test_codes_of_a_single_row_and_of_none(spark, tmp_path):
    coded(spark, tmp_path / "one", [(3, [0.1, -0.2, 0.3, -0.4], None)])
    coded(spark, tmp_path / "none", [], [(1, None, 1)])


def test_reassigning_by_moved_entries_equals_full_comparison():
    draw = np.random.default_rng(5)
    for _ in range(60):
        x, entries = draw.integers(-3, 4, (200, 3)), draw.integers(-3, 4, (20, 3))
        code, far = vector_codes.nearest(x, entries)
        after = entries.copy()
        some = draw.random(20) < 0.3
        after[some] += draw.integers(-1, 2, (some.sum(), 3))
        moved = (after != entries).any(1)
        got = vector_codes.reassign(x, code, far, after, moved)
        want = vector_codes.nearest(x, after)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_distances_of_large_components_are_exact():
    x = np.array([[2 ** 28, -(2 ** 28)], [3, 4]])
    assert vector_codes.squared_distances(x, -x[:1]).tolist() == [[2 ** 59], [(3 + 2 ** 28) ** 2 + (4 - 2 ** 28) ** 2]]
    with pytest.raises(ValueError):
        vector_codes.whole_numbers(np.array([[1e30]]), 1024, 4)


def test_uneven_parts_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError):
        vector_codes.learn_codes(df)


def test_decoded_vectors_have_the_error_told(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows, books = vector_codes.learn_codes(df, rounds=1)
    truth = {r["vec_id"]: np.floor(np.array(r["embedding"], np.float64) * 1024) for r in df.collect()}
    for r in rows.collect():
        assert ((books.decode(np.array([r["codes"]]))[0] - truth[r["vec_id"]]) ** 2).sum() == r["error"]


# Both queries against their SQL

@pytest.mark.parametrize("name", ["op12_merkle", "op13_vector_codes"])
def test_against_sql(spark, name):
    assert oracle.compare(entry.queries()[name](spark, SF), oracle.connect(SF), entry.oracle_sql()[name]) is None
