"""Language identification by a string kernel.

The kernel of two texts is the cosine of their sets of character n-grams, of all
lengths of a blended spectrum together (presence, not counts).  It is
approximated from landmark texts by the Nyström method, and one ridge regression
per language is solved on the landmarks' features; scoring a batch of texts is
two matrix products.

n-grams are hashed into a fixed number of places, so that a text is a row of
zeros and ones of known width.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterflow.llm.common import fold_held_out, register, table

UNDETERMINED = "und"
ORDERS = (2, 3, 4)
PLACES = 1 << 14
LANDMARKS = 96
SAMPLES = 400
SAMPLE_CHARS = 20_000
RIDGE = 1e-2
FOLDS = 4

_LETTER = re.compile(r"[^\W\d_]").search


def presence(texts: list[str], places: int, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Which hashed n-grams each whole text holds, as a matrix of zeros and ones.

    Texts are folded to lower case, and everything that is no letter counts as a
    space, so that digits, marks and markup tell nothing.
    """
    out = np.zeros((len(texts), places), np.float32)
    for row, text in zip(out, texts):
        code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
        code = np.where((code > 127) | ((code >= 97) & (code <= 122)), code, np.uint32(32))
        gram = code.copy()
        for n in range(2, max(orders) + 1):
            if len(code) < n:
                break
            gram = gram[:-1] * np.uint32(0x01000193) + code[n - 1:]
            if n in orders:
                mixed = gram * np.uint32(0x9E3779B1)
                row[(mixed ^ (mixed >> np.uint32(15))) & np.uint32(places - 1)] = 1
    return out


@dataclass(frozen=True)
class StringKernelModel:
    """Landmarks' n-grams, and per language the weights of the kernel values against them."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray
    orders: tuple[int, ...]

    def kernel(self, texts: list[str]) -> np.ndarray:
        x = presence(texts, self.landmarks.shape[0], self.orders)
        size = np.sqrt(np.maximum(x.sum(1), 1))
        return (x @ self.landmarks) / size[:, None]

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.weights


def train(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, places: int = PLACES, ridge: float = RIDGE) -> StringKernelModel:
    """Nyström features of the training texts and one ridge regression per language against the rest.

    Landmarks are taken in turn from each language, in the order given.
    """
    names = tuple(sorted(set(languages)))
    turn: dict[str, int] = {}
    turns = [turn.update({x: turn.get(x, 0) + 1}) or turn[x] for x in languages]
    chosen = sorted(range(len(texts)), key=lambda i: (turns[i], languages[i]))[:landmarks]
    anchors = presence([texts[i] for i in chosen], places)
    anchors /= np.sqrt(np.maximum(anchors.sum(1), 1))[:, None]
    model = StringKernelModel(names, np.ascontiguousarray(anchors.T), np.zeros((len(chosen), len(names)), np.float32), ORDERS)
    cross = np.concatenate([model.kernel(texts[i:i + 256]) for i in range(0, len(texts), 256)]).astype(np.float64)
    values, vectors = np.linalg.eigh((anchors @ anchors.T).astype(np.float64))
    strong = values > 1e-6 * values.max()
    root = vectors[:, strong] / np.sqrt(values[strong])
    features = cross @ root
    targets = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # Languages weigh alike however many samples each has.
    weight = np.array([1.0 / languages.count(x) for x in languages])[:, None]
    gram = features.T @ (features * weight) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, features.T @ (targets * weight))
    return StringKernelModel(names, model.landmarks, (root @ solved).astype(np.float32), ORDERS)


def training_sample(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLES, chars: int = SAMPLE_CHARS,
) -> tuple[list[str], list[str]]:
    """At most ``per_language`` distinct labelled texts of every language from outside the held-out fold.

    A bounded sample: the texts with the smallest hashes of their content among
    those of up to ``chars`` characters that hold a letter.  A language that has
    only longer ones gives as many characters of these, from the first letter on.
    """
    usable = docs.where(F.col(lang).isNotNull() & ~fold_held_out(key, FOLDS) & F.col(text).rlike(r"\p{L}"))
    marked = usable.select(
        F.col(lang).alias("_lang"), (F.length(text) > chars).alias("_long"), F.xxhash64(text).alias("_h"), F.col(key).alias("_key"), F.col(text).alias("_text")
    )
    # Copies are one candidate, and candidates are ranked without their texts.
    distinct = marked.groupBy("_lang", "_long", "_h").agg(F.min("_key").alias("_key"))
    # The limit is known to the window, which keeps only so many rows of a language per task before the shuffle.
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_long", "_h"))
    best = distinct.withColumn("_r", rank).where(F.col("_r") <= per_language)
    only_long = F.min("_long").over(Window.partitionBy("_lang"))
    chosen = best.withColumn("_only", only_long).where(F.col("_long") == F.col("_only")).select("_lang", "_long", "_h", F.col("_key").alias("_chosen"))
    found = marked.join(F.broadcast(chosen), ["_lang", "_long", "_h"]).where(F.col("_key").eqNullSafe(F.col("_chosen")))
    cut = F.when(F.col("_long"), F.regexp_extract("_text", rf"(?s)\p{{L}}.{{0,{chars - 1}}}", 0)).otherwise(F.col("_text"))
    rows = found.groupBy("_lang", "_h").agg(F.min(cut).alias("_text")).orderBy("_lang", "_h").collect()
    return [r["_text"] for r in rows], [r["_lang"] for r in rows]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> StringKernelModel:
    texts, languages = training_sample(docs, key, text, lang)
    if not texts:
        return StringKernelModel((), np.zeros((PLACES, 0), np.float32), np.zeros((0, 0), np.float32), ORDERS)
    return train(texts, languages, **options)


def identify(docs: DataFrame, model: StringKernelModel, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``key, lang_pred, score`` of every row, predicted from its whole text alone, and the columns of ``keep``.

    The score is the share of the best language when the regressions' outputs are
    exponentiated.  Texts that are null or have no letter, and all texts when
    nothing could be learnt, are ``und`` with score 0.  Rows are independent:
    repeated rows and null keys give a row each.
    """
    keep = keep or []
    columns = [key, *(c for c in keep if c != key)]
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shipped.value
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                texts = batch.column(len(columns)).to_pylist()
                known = [i for i, t in enumerate(texts) if t and learnt.languages and _LETTER(t)]
                names, shares = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if known:
                    scores = learnt.scores([texts[i] for i in known])
                    best = scores.argmax(1)
                    power = np.exp(4.0 * (scores - scores.max(1, keepdims=True)))
                    shares[known] = 1.0 / power.sum(1)
                    for i, b in zip(known, best):
                        names[i] = learnt.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(columns)], pa.array(names), pa.array(shares)], [*columns, "lang_pred", "score"]
                )

    source = docs.select(*columns, F.col(text).alias("_whole_text"))
    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double")


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document by a model of the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    predicted = identify(docs, fit(docs))
    return predicted.select("doc_id", fold_held_out("doc_id", FOLDS).alias("held_out"), "lang_pred", "score")
