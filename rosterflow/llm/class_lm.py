"""Scoring by a class-based bigram model (Brown et al. 1992).

``P(word | previous) = P(class | previous class) * P(word | class)``.  Classes come
from exchange clustering (Martin, Liermann and Ney 1998): the most frequent
words, ``core`` of them, are moved between classes while the likelihood of the
class bigrams rises, on the counts of all their bigrams in the corpus; every
other word then goes to the class that the same criterion prefers for it, from
all its occurrences next to core words.

Word counts cover the whole corpus and are never held in one place.  The space
of 64-bit word hashes is cut into slices; every chunk of documents asks each slice
for the distinct words it holds, once, and gets counts and classes back in the
same order.  What is broadcast has a fixed size: the core words with their
classes, and the table of class transitions.

Words seen once and unknown ones form a class of their own.  Its transitions are
counted by leaving one out (words seen at most twice), which gives unknown words
the mass that new text really has of them.  The model is interpolated with the
add-one unigram, so that it is a distribution over the known words and one
unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.common import (
    WordHash, byte_slices, fold_held_out, parts_for, prefix_ranges, register, rows_table, squeeze, table, text_bytes, unsqueeze,
)
from rosterflow.session import scratch, settle

FOLDS = 7
CORE = 2048
CLASSES = 64
ROUNDS = 5
UNIGRAM_WEIGHT = 0.1
PRIOR = 20.0
CHUNK_BYTES = 8 << 20
SLICE_WORDS = 1 << 21
BLOCK = 64
END = np.uint64(0xE2D0E2D0E2D0E2D0)
# Classes beyond those of the exchange.
RARE, STOP = CLASSES, CLASSES + 1
TOTAL = CLASSES + 2


class Tokens:
    """The tokens of some documents in a row, each document closed by the end token."""

    def __init__(self, texts: list[str | None], hashes: WordHash):
        words = [t.encode().lower().split() if t else [] for t in texts]
        self.lengths = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        self.last = np.cumsum(self.lengths) - 1
        self.first = self.last - self.lengths + 1
        self.ids = np.full(int(self.lengths.sum()), END, np.uint64)
        body = np.ones(len(self.ids), bool)
        body[self.last] = False
        self.ids[body] = hashes.of([w for row in words for w in row])

    def before(self, values: np.ndarray, start) -> np.ndarray:
        """Each token's left neighbour in ``values``; documents begin after an end token."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = start
        return out

    def spread(self, per_document) -> np.ndarray:
        return np.repeat(np.asarray(per_document), self.lengths)


_ASK = pa.schema([("chunk", pa.int64()), ("slice", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
_ASK_SQL = "chunk long, slice long, words binary, counts binary"
_LEXICON = pa.schema([
    ("slice", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()),
    ("once", pa.int64()), ("twice", pa.int64()), ("top", pa.list_(pa.struct([("n", pa.int64()), ("word", pa.int64())]))),
])
_LEXICON_SQL = "slice long, words binary, counts binary, tokens long, types long, once long, twice long, top array<struct<n:long,word:long>>"


def _words_of_chunk(docs: pa.Table, shift: int) -> pa.Table:
    number, tokens = docs.column("chunk")[0].as_py(), Tokens(docs.column("text").to_pylist(), WordHash())
    words, at = np.unique(tokens.ids, return_inverse=True)
    train = tokens.spread([not h for h in docs.column("held_out").to_pylist()])
    counts = np.bincount(at[train], minlength=len(words)).astype(np.uint32)
    return rows_table([
        (number, part, squeeze(np.diff(words[a:b], prepend=np.uint64(0))), squeeze(counts[a:b])) for part, a, b in prefix_ranges(words, shift)
    ], _ASK)


def _ascending(blob: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(blob, np.uint64), dtype=np.uint64)


def _merge_words(asks: pa.Table, core: int) -> pa.Table:
    """One slice of the lexicon: words with their counts in the training documents."""
    words = np.concatenate([_ascending(b) for b in asks.column("words").to_pylist()])
    counts = np.concatenate([unsqueeze(b, np.uint32) for b in asks.column("counts").to_pylist()]).astype(np.int64)
    words, at = np.unique(words, return_inverse=True)
    counts = np.bincount(at, weights=counts, minlength=len(words)).astype(np.int64)
    best = np.lexsort((words, -counts))[:core]
    top = [{"n": int(counts[i]), "word": int(words[i].astype(np.int64))} for i in best if counts[i]]
    return rows_table([(
        asks.column("slice")[0].as_py(), squeeze(np.diff(words, prepend=np.uint64(0))), squeeze(counts.astype(np.uint64)), int(counts.sum()),
        int((counts > 0).sum()), int((counts == 1).sum()), int((counts == 2).sum()), top,
    )], _LEXICON)


def core_bigrams(docs: DataFrame, core: np.ndarray, text: str) -> DataFrame:
    """``block, counts``: the bigram counts among the core words, ``BLOCK`` rows of the matrix at a time."""
    k = len(core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHash(), np.zeros(k * k, np.int64)
        for whole in batches:
            for batch in byte_slices(whole, 0):
                tokens = Tokens(batch.column(0).to_pylist(), hashes)
                at = np.minimum(np.searchsorted(core, tokens.ids), k - 1)
                at[core[at] != tokens.ids] = -1
                end = int(np.searchsorted(core, END))
                left = tokens.before(at, end if end < k and core[end] == END else -1)
                both = (left >= 0) & (at >= 0)
                pairs, n = np.unique(left[both] * k + at[both], return_counts=True)
                counts[pairs] += n
        starts = [b for b in range(0, k, BLOCK) if counts[b * k:(b + BLOCK) * k].any()]
        for b in starts:
            yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK], pa.int64()), pa.array([squeeze(counts[b * k:(b + BLOCK) * k])])], ["block", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(unsqueeze(b, np.int64) for b in group.column("counts").to_pylist())
        return pa.table({"block": [group.column("block")[0].as_py()], "counts": [squeeze(total)]})

    return docs.select(text).mapInArrow(run, "block long, counts binary").groupBy("block").applyInArrow(add, "block long, counts binary")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(counts: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every word of a bigram count matrix, by moving words while the class bigram likelihood rises.

    Words are in descending order of frequency and start in turn over the classes.
    """
    k = len(counts)
    of = np.arange(k) % classes
    counts = counts.astype(np.float64)
    table_ = np.zeros((classes, classes))
    np.add.at(table_, (of[:, None], of[None, :]), counts)
    for _ in range(rounds):
        moved = 0
        for w in range(k):
            old = of[w]
            out = np.bincount(of, weights=counts[w], minlength=classes)
            into = np.bincount(of, weights=counts[:, w], minlength=classes)
            self_ = counts[w, w]
            out[old] -= self_
            into[old] -= self_
            table_[old] -= out
            table_[:, old] -= into
            table_[old, old] -= self_
            # What the likelihood gains if w joins each class: its row, its column, the corner, less the marginals.
            rows, columns = _xlogx(table_), table_
            gain = (_xlogx(columns + out[None, :]) - rows).sum(1) + (_xlogx(columns + into[:, None]) - rows).sum(0)
            corner = np.diagonal(table_)
            gain += _xlogx(corner + out + into + self_) - _xlogx(corner + out) - _xlogx(corner + into) + _xlogx(corner)
            left, right = table_.sum(1), table_.sum(0)
            gain -= _xlogx(left + out.sum() + self_) - _xlogx(left) + _xlogx(right + into.sum() + self_) - _xlogx(right)
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-9 else old
            of[w] = new
            table_[new] += out
            table_[:, new] += into
            table_[new, new] += self_
            moved += new != old
        if not moved:
            break
    return of


def preferences(counts: np.ndarray, of: np.ndarray, classes: int) -> np.ndarray:
    """What one left (then right) neighbour of each class adds to the likelihood if a word is put into each class."""
    table_ = np.zeros((classes, classes))
    np.add.at(table_, (of[:, None], of[None, :]), counts.astype(np.float64))
    table_ += 0.5
    lift = np.log(table_ * table_.sum() / table_.sum(1, keepdims=True) / table_.sum(0, keepdims=True))
    return np.concatenate([lift, lift.T]).astype(np.float32)


_CONTEXT = pa.schema([("slice", pa.int64()), ("words", pa.binary()), ("sizes", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())])


def contexts(docs: DataFrame, core: np.ndarray, of: np.ndarray, text: str, shift: int) -> DataFrame:
    """How often each word stands after and before core words of each class, per slice of the lexicon."""
    k = len(core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for whole in batches:
            for batch in byte_slices(whole, 0, 8 << 20):
                tokens = Tokens(batch.column(0).to_pylist(), hashes)
                at = np.minimum(np.searchsorted(core, tokens.ids), k - 1)
                of_core = np.where(core[at] == tokens.ids, of[at], -1)
                other = of_core < 0
                left = tokens.before(of_core, of[np.searchsorted(core, END)])
                right = np.full(len(of_core), -1)
                right[:-1] = of_core[1:]
                words, number = np.unique(tokens.ids[other], return_inverse=True)
                codes = np.concatenate([number[left[other] >= 0] * (2 * CLASSES) + left[other][left[other] >= 0],
                                        number[right[other] >= 0] * (2 * CLASSES) + CLASSES + right[other][right[other] >= 0]])
                codes, n = np.unique(codes, return_counts=True)
                owner = codes // (2 * CLASSES)
                sizes = np.bincount(owner, minlength=len(words))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                rows = [
                    (part, squeeze(np.diff(words[a:b], prepend=np.uint64(0))), squeeze(sizes[a:b].astype(np.uint8)),
                     squeeze((codes[ends[a]:ends[b]] % (2 * CLASSES)).astype(np.uint8)), squeeze(n[ends[a]:ends[b]].astype(np.uint32)))
                    for part, a, b in prefix_ranges(words, shift)
                ]
                yield from rows_table(rows, _CONTEXT).to_batches()

    return docs.select(text).mapInArrow(run, "slice long, words binary, sizes binary, codes binary, counts binary")


_CLASSED = pa.schema([("slice", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()), ("classes", pa.binary()), ("mass", pa.list_(pa.int64()))])


def _classify(lexicon: pa.Table, context: pa.Table, core: np.ndarray, of: np.ndarray, prefer: np.ndarray) -> pa.Table:
    """The class of every word of a slice, and each class's tokens of words seen more than once."""
    if not lexicon.num_rows:
        return rows_table([], _CLASSED)
    words, counts = _ascending(lexicon.column("words")[0].as_py()), unsqueeze(lexicon.column("counts")[0].as_py(), np.uint64).astype(np.int64)
    score = np.zeros((len(words), CLASSES), np.float32)
    met = np.zeros(len(words), bool)
    for row in context.to_pylist():
        mine, sizes = _ascending(row["words"]), unsqueeze(row["sizes"], np.uint8).astype(np.int64)
        codes, n = unsqueeze(row["codes"], np.uint8), unsqueeze(row["counts"], np.uint32)
        at = np.searchsorted(words, mine)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for a in range(0, len(mine), 16384):
            b = min(a + 16384, len(mine))
            full = np.flatnonzero(sizes[a:b]) + a
            if len(full):
                lo, hi = ends[a], ends[b]
                score[at[full]] += np.add.reduceat(prefer[codes[lo:hi]] * n[lo:hi, None].astype(np.float32), ends[full] - lo)
                met[at[full]] = True
    classes = np.where(met, score.argmax(1), RARE).astype(np.uint8)
    at = np.minimum(np.searchsorted(core, words), len(core) - 1)
    known = core[at] == words
    classes[known] = of[at[known]]
    classes[words == END] = STOP
    mass = np.bincount(classes[counts > 1], weights=counts[counts > 1], minlength=TOTAL).astype(np.int64)
    return rows_table([(lexicon.column("slice")[0].as_py(), lexicon.column("words")[0].as_py(), squeeze(counts.astype(np.uint64)), squeeze(classes), mass.tolist())], _CLASSED)


_ANSWER = pa.schema([("chunk", pa.int64()), ("slice", pa.int64()), ("counts", pa.binary()), ("classes", pa.binary())])


def _answer(asks: pa.Table, lexicon: pa.Table) -> pa.Table:
    if not asks.num_rows:
        return rows_table([], _ANSWER)
    words, counts = _ascending(lexicon.column("words")[0].as_py()), unsqueeze(lexicon.column("counts")[0].as_py(), np.uint64)
    classes = unsqueeze(lexicon.column("classes")[0].as_py(), np.uint8)
    rows = []
    for ask in asks.select(["chunk", "slice", "words"]).to_pylist():
        at = np.searchsorted(words, _ascending(ask["words"]))
        rows.append((ask["chunk"], ask["slice"], squeeze(counts[at]), squeeze(classes[at])))
    return rows_table(rows, _ANSWER)


_CODED = pa.schema([
    ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
    ("classes", pa.binary()), ("counts", pa.binary()), ("transitions", pa.binary()),
])
_CODED_SQL = "id long, held_out boolean, n_tokens long, n_known long, base_score double, classes binary, counts binary, transitions binary"


def _code(docs: pa.Table, answers: pa.Table, n: int, v: int) -> pa.Table:
    """Documents as classes and counts of their tokens, and one row with the chunk's class transitions."""
    if not docs.num_rows:
        return rows_table([], _CODED)
    tokens = Tokens(docs.column("text").to_pylist(), WordHash())
    _, at = np.unique(tokens.ids, return_inverse=True)
    rows = sorted(answers.to_pylist(), key=lambda r: r["slice"])
    counts = np.concatenate([unsqueeze(r["counts"], np.uint64) for r in rows])[at].astype(np.int64)
    classes = np.concatenate([unsqueeze(r["classes"], np.uint8) for r in rows])[at]
    stop = tokens.ids == END
    held = docs.column("held_out").to_pylist()
    seen = np.where((counts <= 2) & ~stop, RARE, classes).astype(np.int64)
    train = ~tokens.spread(held)
    moves = np.bincount((tokens.before(seen, STOP) * TOTAL + seen)[train], minlength=TOTAL * TOTAL)
    base = np.add.reduceat(np.log10((counts + 1) / (n + v + 1)), tokens.first)
    known = np.add.reduceat((counts > 0).astype(np.int64), tokens.first)
    classes = np.where((counts <= 1) & ~stop, RARE, classes).astype(np.uint8)
    out = [
        (i, h, int(m), int(kn), float(bs), squeeze(classes[a:b + 1]), squeeze(counts[a:b + 1].astype(np.uint64)), None)
        for i, h, m, kn, bs, a, b in zip(docs.column("id").to_pylist(), held, tokens.lengths, known, base, tokens.first, tokens.last)
    ]
    return rows_table(out + [(None, None, None, None, None, None, None, squeeze(moves))], _CODED)


def transition_table(moves: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Class transition probabilities, drawn towards the classes' own shares where a class is rare."""
    moves = moves.reshape(TOTAL, TOTAL).astype(np.float64)
    own = (moves.sum(0) + 1) / (moves.sum() + TOTAL)
    return (moves + prior * own) / (moves.sum(1, keepdims=True) + prior)


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", core: int = CORE, unigram_weight: float = UNIGRAM_WEIGHT, folds: int = FOLDS
) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row.

    The model is learnt from the rows outside the held-out fold.  Null texts have
    the end token alone.  A corpus without training documents knows no token.
    Repeated rows count as often as they come; a null key is never held out.  Words
    are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    size = text_bytes(docs, text)
    chunks = parts_for(spark, size, CHUNK_BYTES)
    shift = 64 - max(4, (size // 6 // SLICE_WORDS).bit_length())
    kind = docs.schema[key].dataType.simpleString()
    dealt = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), fold_held_out(key, folds).alias("held_out"))
    train = dealt.where(~F.col("held_out"))
    by_chunk = dealt.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks))).groupBy("chunk")

    def ask(group: pa.Table) -> pa.Table:
        return _words_of_chunk(group, shift)

    def merge(group: pa.Table) -> pa.Table:
        return _merge_words(group, core)

    with scratch():
        asks = settle(by_chunk.applyInArrow(ask, _ASK_SQL), "words")
        lexicon = settle(asks.groupBy("slice").applyInArrow(merge, _LEXICON_SQL), "lexicon")
        n, v, once, twice = (x or 0 for x in lexicon.agg(F.sum("tokens"), F.sum("types"), F.sum("once"), F.sum("twice")).first())
        # At most ``core`` rows, whatever the corpus holds.
        top = lexicon.select(F.explode("top").alias("t")).select("t.*").orderBy(F.desc("n"), "word").limit(core).collect()
        ranked = np.array([r["word"] for r in top], np.int64).view(np.uint64)
        if END not in ranked:
            ranked = np.append(ranked, END)
        order = np.argsort(ranked)
        core_words = ranked[order]
        counts = np.zeros((len(ranked), len(ranked)), np.int64)
        for row in settle(core_bigrams(train, core_words, "text"), "bigrams").collect():
            block = unsqueeze(row["counts"], np.int64).reshape(-1, len(ranked))
            counts[row["block"] * BLOCK:row["block"] * BLOCK + len(block)] = block
        rank = np.argsort(order)
        of = exchange(counts[np.ix_(rank, rank)], CLASSES)[order]
        prefer = preferences(counts, of, CLASSES)

        def classify(group: pa.Table, context: pa.Table) -> pa.Table:
            return _classify(group, context, core_words, of, prefer)

        context = contexts(train, core_words, of, "text", shift)
        classed = settle(
            lexicon.select("slice", "words", "counts").groupBy("slice").cogroup(context.groupBy("slice"))
            .applyInArrow(classify, "slice long, words binary, counts binary, classes binary, mass array<long>"), "classes",
        )
        answers = settle(
            asks.select("chunk", "slice", "words").groupBy("slice").cogroup(classed.groupBy("slice"))
            .applyInArrow(_answer, "chunk long, slice long, counts binary, classes binary"), "answers",
        )

        def code(group: pa.Table, answer: pa.Table) -> pa.Table:
            return _code(group, answer, n, v)

        coded = settle(by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(code, _CODED_SQL), "coded", outlives=True)
        masses = [classed.agg(*(F.sum(F.get("mass", F.lit(i))) for i in range(TOTAL))).first()]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(TOTAL * TOTAL, np.int64)
            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    total += unsqueeze(blob, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([squeeze(total)])], ["transitions"])

        sums = coded.where(F.col("transitions").isNotNull()).select("transitions").mapInArrow(add, "transitions binary")
        moves = np.zeros(TOTAL * TOTAL, np.int64)
        for row in sums.toLocalIterator():
            moves += unsqueeze(row["transitions"], np.int64)
    transitions = transition_table(moves)
    mass = np.array([x or 0 for x in masses[0]], np.float64)
    mass[STOP] = max(mass[STOP], 1)
    unknown = (once + 1) / (once + 2 * twice + 2)
    single = (2 * twice + 1) / (once + 2 * twice + 2) / max(once, 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                classes = [unsqueeze(b, np.uint8).astype(np.int64) for b in batch.column(5).to_pylist()]
                counts = np.concatenate([unsqueeze(b, np.uint64) for b in batch.column(6).to_pylist()]).astype(np.float64)
                first = np.cumsum([0, *map(len, classes)])[:-1]
                now = np.concatenate(classes)
                before = np.empty_like(now)
                before[1:] = now[:-1]
                before[first] = STOP
                emitted = np.where(now == RARE, np.where(counts > 1, counts / max(mass[RARE], 1), np.where(counts > 0, single, unknown)), counts / np.maximum(mass[now], 1))
                emitted[now == STOP] = 1.0
                rare = now == RARE
                # Words without a core neighbour share the rare class; seen more than once they take their part of it.
                emitted[rare & (counts > 1)] *= mass[RARE] / (mass[RARE] + once + 2 * twice + 2)
                emitted[rare & (counts <= 1)] *= (once + 2 * twice + 2) / (mass[RARE] + once + 2 * twice + 2)
                p = (1 - unigram_weight) * transitions[before, now] * emitted + unigram_weight * (counts + 1) / (n + v + 1)
                total = np.add.reduceat(np.log10(p), first)
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(total)], [*batch.schema.names[:5], "score"])

    scored = coded.where(F.col("transitions").isNull()).drop("transitions").mapInArrow(
        score, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        F.col("id").cast(kind).alias(key), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


@register("op3_class_lm")
def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the class bigram model of the documents outside the held-out fold."""
    return score_documents(table(spark, sf_dir, "documents"))
