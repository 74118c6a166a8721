"""Jaccard join of documents over word n-grams by T-occurrence search.

A document that links to another one shares at least ``percent`` hundredths of
its own n-grams with it.  Most documents do not share so many with the whole
corpus, which one exchange of packed hashes tells: a batch of documents sends
every n-gram once, a slice of the hash space says which ones other batches hold
as well.  Of the documents that remain, those that share one of their shortest
inverted lists meet in a group, a bounded block of it per task, and are searched
there with DivideSkip (Li, Lu and Lu 2008): a heap merges a query's short lists,
skipping what cannot reach the threshold, and the long ones are only probed for
the documents found.  In a group of near copies nearly every list holds nearly every
document, and there is nothing to skip: there the lists are counted in one pass.
The overlaps are exact, so a link needs no other check.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.common import (
    WordHash, byte_slices, give_back, pack_batch, prefix_ranges, register, rows_table, squeeze, table, text_bytes, unpack_batch, unsqueeze,
)
from rosterflow.llm.linking import among, components, components_sql
from rosterflow.llm.near_dedup import shingle_sets
from rosterflow.session import scratch, settle

WIDTH = 4
PERCENT = 85
# Hashes a slice receives, and a batch sends: a batch grows with the number of slices, so that each gets a row worth sending.
SLICE_HASHES = 1 << 20
BATCH_HASHES, MOST_BATCH_HASHES, PER_SLICE = 1 << 20, 1 << 24, 16
# Bits of a hash that are exchanged beyond those that count the corpus's hashes: with 7, one in 128 is taken for shared though it is not.
SPARE_BITS = 7
# Inverted-list entries of a block: what one search task holds.
BLOCK_ENTRIES = 1 << 19
# Weight of a probe against a heap step in the share of lists that count as long.
PROBE = 0.0085

MARKS, KNOWN = -1, (1 << 32) - 1
_PACKED = pa.schema([("slice", pa.int64()), ("batch", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
_PACKED_SQL = "slice long, batch long, a binary, b binary"
_MARKS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("place", pa.int32())])


def least_overlap(n: int, m: int, percent: int) -> int:
    """The smallest intersection with which sets of ``n`` and ``m`` reach the similarity."""
    return -(-percent * (n + m) // (100 + percent))


class Batch:
    """Documents of a task, gathered until they hold enough hashes."""

    def __init__(self):
        self.ids, self.sizes, self.digests, self.places = [], [], [], []
        self.sets: list[np.ndarray] = []
        self.of: dict[bytes, int] = {}
        self.hashes = 0

    def add(self, id_: int | None, items: np.ndarray) -> None:
        digest = hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None
        place = None
        if digest is not None:
            place = self.of.setdefault(digest, len(self.sets))
            if place == len(self.sets):
                self.sets.append(items)
                self.hashes += len(items)
        self.ids.append(id_)
        self.sizes.append(len(items))
        self.digests.append(digest)
        self.places.append(place)

    def rows(self, number: int, bits: int, shift: int) -> list[tuple]:
        """The marks with the counts of hashes that several sets of the batch hold, and each hash's upper ``bits`` once, by slices."""
        sizes = np.fromiter(map(len, self.sets), np.int64, len(self.sets))
        hashes = (np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)) >> np.uint64(64 - bits)
        owner = np.repeat(np.arange(len(self.sets), dtype=np.uint32), sizes)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        known = np.bincount(owner[shared], minlength=len(self.sets)).astype(np.int32)
        owner[shared] = KNOWN
        hashes, owner = hashes[fresh], owner[fresh]
        marks = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((self.ids, self.sizes, self.digests, self.places), _MARKS)], schema=_MARKS)
        return [(MARKS, number, pack_batch(marks), squeeze(known))] + [
            (part, number, squeeze(np.diff(hashes[a:b], prepend=np.uint64(0))), squeeze(owner[a:b])) for part, a, b in prefix_ranges(hashes, shift)
        ]


def packed_sets(docs: DataFrame, width: int, size: int) -> DataFrame:
    """The batches of ``docs (id, text)`` of ``size`` bytes: marks and hashes by slices.

    Only as many bits of a hash are sent as tell nearly all of the corpus apart: hashes
    that agree in them by chance count as shared, so that no document is lost.
    """
    slices = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // 6 // SLICE_HASHES)
    bits = min(64, max(size // 4, slices).bit_length() + SPARE_BITS)
    shift = bits - (slices - 1).bit_length()
    enough = min(max(BATCH_HASHES, PER_SLICE * slices), MOST_BATCH_HASHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number, batch = WordHash(), TaskContext.get().partitionId() << 32, Batch()
        for whole in batches:
            for part in byte_slices(whole, 1):
                for id_, items in zip(part.column(0).to_pylist(), shingle_sets(part.column(1).to_pylist(), width, hashes)):
                    batch.add(id_, items)
                    if batch.hashes >= enough:
                        yield from rows_table(batch.rows(number, bits, shift), _PACKED).to_batches()
                        number, batch = number + 1, Batch()
        if batch.ids:
            yield from rows_table(batch.rows(number, bits, shift), _PACKED).to_batches()
        del batch
        hashes.clear()
        give_back()

    return docs.mapInArrow(run, _PACKED_SQL)


def _shared(group: pa.Table) -> pa.Table:
    """For the batches of a slice: how many hashes of each of their sets other batches hold as well."""
    hashes = [np.cumsum(unsqueeze(b, np.uint64), dtype=np.uint64) for b in group.column("a").to_pylist()]
    owner = np.concatenate([unsqueeze(b, np.uint32) for b in group.column("b").to_pylist()])
    batch = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    hashes, owner, batch = hashes[order], owner[order], batch[order]
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[:-1] |= again[1:]
    again &= owner != KNOWN
    owner, batch = owner[again], batch[again]
    order = np.argsort(batch, kind="stable")
    owner, batch = owner[order], batch[order]
    numbers, rows = group.column("batch").to_pylist(), []
    for at, a, b in ((int(batch[a]), a, b) for a, b in _runs(batch)):
        places, counts = np.unique(owner[a:b], return_counts=True)
        rows.append((numbers[at], squeeze(places), squeeze(counts.astype(np.uint32))))
    give_back()
    return rows_table(rows, pa.schema([("batch", pa.int64()), ("a", pa.binary()), ("b", pa.binary())]))


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    bounds = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def _surviving(marks: pa.Table, replies: pa.Table, percent: int) -> pa.Table:
    """Digests of a batch's sets that share enough hashes with others."""
    digests = []
    for blob, known in zip(marks.column("a").to_pylist(), marks.column("b").to_pylist()):
        counts = unsqueeze(known, np.int32).astype(np.int64)
        for places, more in zip(replies.column("a").to_pylist(), replies.column("b").to_pylist()):
            counts[unsqueeze(places, np.uint32)] += unsqueeze(more, np.uint32)
        rows, seen = unpack_batch(blob), set()
        for n, digest, place in zip(*[rows.column(c).to_pylist() for c in ("n", "digest", "place")]):
            if place is not None and place not in seen:
                seen.add(place)
                if 100 * int(counts[place]) >= percent * n:
                    digests.append(digest)
    return pa.table([pa.array(digests, pa.binary())], ["digest"])


def _marks_of(packed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield from unpack_batch(blob).select(["id", "n", "digest"]).to_batches()

    return packed.where(F.col("slice") == MARKS).select("a").mapInArrow(run, "id long, n long, digest binary")


def _sets_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, id, n, items`` of the settled ``nodes (id, digest)``, one row per digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for whole in batches:
            for part in byte_slices(whole, 1):
                sets = shingle_sets(part.column(1).to_pylist(), width, hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["id", "digest", "items"],
                )
        hashes.clear()
        give_back()

    found = among(docs, nodes.select("id").distinct()).mapInArrow(run, "id long, digest binary, items array<long>")
    found = found.join(nodes, ["id", "digest"], "left_semi").dropDuplicates(["digest"])
    return found.select(F.monotonically_increasing_id().alias("node"), "id", F.size("items").cast("long").alias("n"), "items")


class InvertedLists:
    """Inverted lists of a block of documents, searched by number of occurrences."""

    def __init__(self, items: list[np.ndarray], sizes: list[int], percent: int):
        self.sizes, self.percent = sizes, percent
        lengths = np.fromiter(map(len, items), np.int64, len(items))
        values = np.concatenate(items) if items else np.zeros(0, np.int64)
        order = np.argsort(values, kind="stable")
        fresh = np.ones(len(values), bool)
        fresh[1:] = values[order][1:] != values[order][:-1]
        number = np.empty(len(values), np.int64)
        number[order] = np.cumsum(fresh) - 1
        # Stable sorting leaves the documents of a list in ascending order.
        self.entries, self.size_of = np.repeat(np.arange(len(items)), lengths)[order], np.asarray(sizes, np.int64)
        self.postings = self.entries.tolist()
        self.bounds = [*np.flatnonzero(fresh).tolist(), len(values)]
        self.lists = [x.tolist() for x in np.split(number, np.cumsum(lengths)[:-1])] if items else []

    def divided(self, query: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
        """The query's short and long lists (start, end), and the occurrences among the short ones that a candidate needs."""
        bounds = self.bounds
        spans = sorted(((bounds[x], bounds[x + 1]) for x in self.lists[query]), key=lambda s: s[1] - s[0])
        need = -(-self.percent * self.sizes[query] // 100)
        longest = spans[-1][1] - spans[-1][0]
        long = min(need - 1, int(need / (PROBE * math.log2(max(longest, 2)) + 1)))
        return spans[:len(spans) - long], spans[len(spans) - long:], need - long

    def merged(self, spans: list[tuple[int, int]], need: int) -> Iterator[tuple[int, int]]:
        """Documents in at least ``need`` of the lists, with their occurrences: a heap of list heads that skips."""
        postings = self.postings
        heads = [(postings[a], a, b) for a, b in spans]
        heapq.heapify(heads)
        while len(heads) >= need:
            doc, same = heads[0][0], []
            while heads and heads[0][0] == doc:
                same.append(heapq.heappop(heads))
            if len(same) >= need:
                yield doc, len(same)
                target = doc + 1
            else:
                # With fewer lists than needed before the next head, no document ahead of it can occur often enough.
                while heads and len(same) < need - 1:
                    same.append(heapq.heappop(heads))
                if not heads:
                    return
                target = max(heads[0][0], doc + 1)
            for _, a, b in same:
                a = bisect_left(postings, target, a, b)
                if a < b:
                    heapq.heappush(heads, (postings[a], a, b))

    def counted(self, query: int, spans: list[tuple[int, int]]) -> list[int]:
        """The other documents that are similar to the query, by a pass over all of its lists."""
        count = np.bincount(np.concatenate([self.entries[a:b] for a, b in spans]), minlength=len(self.sizes))
        enough = -(-self.percent * (self.sizes[query] + self.size_of) // (100 + self.percent))
        count[query] = 0
        return np.flatnonzero(count >= enough).tolist()

    def search(self, query: int) -> list[int]:
        """The other documents of the block that are similar to the query."""
        short, long, need = self.divided(query)
        out, postings, mine = [], self.postings, self.sizes[query]
        # Short lists with more entries than the block has documents, as near copies have them, leave little to skip.
        if sum(b - a for a, b in short) > len(self.sizes):
            return self.counted(query, short + long)
        for doc, count in self.merged(short, need):
            if doc == query:
                continue
            enough = least_overlap(mine, self.sizes[doc], self.percent)
            left = len(long)
            # The shortest of the long lists are the likeliest to end the search.
            for a, b in long:
                if count >= enough or count + left < enough:
                    break
                at = bisect_left(postings, doc, a, b)
                count += at < b and postings[at] == doc
                left -= 1
            if count >= enough:
                out.append(doc)
        return out


class Roots:
    """Union-find over the documents of a block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def of(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.of(x)] = self.of(y)


def _search_block(group: pa.Table, percent: int) -> pa.Table:
    """Links of a block that give its components (ids ``a, b``), fewer than it has documents.

    With ``pivots`` (the groups a document is in, by their first member) the first
    members are searched, then every document that is not yet joined to all of its
    groups' first members.  Documents marked ``asks`` are searched in any case.
    """
    lists = group.column("items").combine_chunks()
    flat, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths(), np.int64))
    index = InvertedLists(np.split(flat, ends[:-1]), group.column("n").to_pylist(), percent)
    ids, nodes = group.column("id").to_pylist(), group.column("node").to_pylist()
    at = {node: i for i, node in enumerate(nodes)}
    roots, links = Roots(len(ids)), set()

    def search(query: int) -> None:
        for other in index.search(query):
            # A link inside a component changes none.
            if roots.of(query) != roots.of(other):
                roots.join(query, other)
                links.add((ids[query], ids[other]))

    asks = [i for i, x in enumerate(group.column("asks").to_pylist()) if x]
    for i in asks:
        search(i)
    if "pivots" in group.column_names:
        searched = set(asks)
        for i, pivots in enumerate(group.column("pivots").to_pylist()):
            if i not in searched and any(roots.of(at[p]) != roots.of(i) for p in pivots):
                search(i)
    give_back()
    return pa.table([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])


_LINKS = "a long, b long"


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between the ids of the settled ``sets (node, id, n, items)`` that give their components."""
    df = settle(sets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("length")).where("length > 1"), "list-lengths")
    held = sets.select("node", "id", "n", F.explode("items").alias("item")).join(df, "item")
    lists = held.groupBy("node", "id", "n").agg(F.sort_array(F.collect_list(F.struct("length", "item"))).alias("lists"))
    need = F.expr(f"int((n * {percent} + 99) div 100)")
    lists = lists.withColumn("need", need).where("size(lists) >= need")
    lists = settle(lists.select("node", "id", "n", F.col("lists.item").alias("items"), F.expr("size(lists) - need + 1").alias("prefix")), "lists")
    # Two similar documents share one of the shortest lists that either of them can do without, and one more.
    heads = lists.select("node", F.size("items").alias("weight"), F.explode(F.slice("items", F.lit(1), F.col("prefix"))).alias("item"))
    first = heads.groupBy("item").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    groups = settle(heads.join(first, "item").select("pivot", "node", "weight").distinct(), "groups")
    weights = settle(groups.groupBy("pivot").agg(F.sum("weight").alias("whole")), "weights")
    total = weights.agg(F.sum("whole")).first()[0] or 0
    bundles = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BLOCK_ENTRIES + 1)
    blocks = F.ceil(F.col("whole") / BLOCK_ENTRIES).cast("int")
    dealt = groups.join(weights, "pivot").withColumn("blocks", blocks)
    contents = lists.select("node", "id", "n", "items")

    small = dealt.where("blocks = 1").groupBy(F.pmod(F.xxhash64("pivot"), F.lit(bundles)).alias("bundle"), "node").agg(
        F.collect_set("pivot").alias("pivots"), F.max(F.col("pivot") == F.col("node")).alias("asks")
    )
    links = settle(small.join(contents, "node").groupBy("bundle").applyInArrow(lambda g: _search_block(g, percent), _LINKS), "links")

    # A group beyond one block: its first member is searched in every block, then what is not joined to it, block by block.
    large = settle(dealt.where("blocks > 1").select("pivot", "node", "blocks", "weight", "whole"), "large-groups")
    if large.isEmpty():
        return links
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = large.where("node <> pivot").select("pivot", "node", block.alias("j"), F.lit(False).alias("asks"))
    asking = large.where("node = pivot").select("pivot", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("asks"))
    search = members.unionByName(asking).join(contents, "node").groupBy("pivot", "j").applyInArrow(lambda g: _search_block(g, percent), _LINKS)
    links = settle(links.unionByName(search), "links-of-first")
    found = settle(components(links), "components-of-first")
    named = large.join(contents.select("node", "id"), "node").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mains = named.where("node = pivot").select("pivot", F.col("component").alias("main"))
    strays = named.join(mains, "pivot").where("component <> main")
    strays = settle(strays.select("pivot", "node", "blocks", "weight"), "strays")
    if strays.isEmpty():
        return links
    parts = strays.groupBy("pivot").agg(F.ceil(F.sum("weight") / BLOCK_ENTRIES).cast("int").alias("parts"))
    both = large.drop("whole", "weight").join(parts, "pivot")
    everyone = both.select("pivot", "node", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), block.alias("j"), F.lit(False).alias("asks"))
    asking = strays.join(parts, "pivot").select(
        "pivot", "node", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
        F.lit(True).alias("asks"),
    )
    dealt = everyone.unionByName(asking).groupBy("pivot", "i", "j", "node").agg(F.max("asks").alias("asks"))
    search = dealt.join(contents, "node").groupBy("pivot", "i", "j").applyInArrow(lambda g: _search_block(g, percent), _LINKS)
    return links.unionByName(settle(search, "links-of-strays"))


def ngram_join(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, with_links: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """``key, n_shingles, component_id`` of every row; with ``with_links`` also the links ``a, b`` that give the components.

    Rows are linked where the Jaccard similarity of their sets of ``width``-word
    shingles (A-Z folded) is at least ``percent`` hundredths; ``component_id`` is the
    smallest key reachable.  The search is exact: shingles are told apart by 64-bit
    hashes, and there is no other estimate in it.  A text with fewer words has its
    whole sequence as one shingle; null and blank texts have an empty set and link
    with nothing.  Equal sets are one set from the start, shown by their smallest key.
    Rows that share a key are one node in links; each row shows its own set's
    component.  A null key links with nothing and has a null component.  Keys are
    whole numbers; other columns play no part.  Texts of any length are taken whole.
    """
    kind = docs.schema[key].dataType
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    with scratch():
        packed = settle(packed_sets(texts, width, text_bytes(texts)), "packed")
        marks = settle(_marks_of(packed), "marks", outlives=True)
        replies = packed.where(F.col("slice") != MARKS).groupBy("slice").applyInArrow(lambda g: _shared(g), "batch long, a binary, b binary")
        of_batch = packed.where(F.col("slice") == MARKS).groupBy("batch").cogroup(replies.groupBy("batch"))
        alive = settle(of_batch.applyInArrow(lambda a, b: _surviving(a, b, percent), "digest binary"), "alive").distinct()
        known = marks.where("id is not null and digest is not null")
        equal = settle(known.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "equal-sets", outlives=True)
        nodes = settle(equal.join(alive, "digest", "left_semi").select("id", "digest"), "nodes")
        links = settle(_links(settle(_sets_of(texts, nodes, width), "sets"), percent), "all-links", outlives=True)
        linked = settle(components(links), "linked", outlives=True)
        groups = equal.join(linked, "id", "left").where("copies > 1 or component is not null")
        groups = settle(groups.select("digest", F.coalesce("component", "id").alias("_component")), "groups", outlives=True)
    found = marks.join(groups, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "id"))
    rows = found.select(F.col("id").cast(kind).alias(key), F.col("n").alias("n_shingles"), component.cast(kind).alias("component_id"))
    return (rows, links) if with_links else rows


@register("op11_ngram_join", components_sql(WIDTH, PERCENT, "doc_id, n_shingles, component_id"))
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents over four-word shingles at 85 percent."""
    return ngram_join(table(spark, sf_dir, "documents"))
