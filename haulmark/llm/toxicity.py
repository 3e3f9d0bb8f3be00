"""Toxicity by a classifier chain: one linear model per category, in order.

A later model also gets the earlier categories' log-odds as features.  For training these come from out-of-fold models,
so that the later model sees them as wrong as they will be on new documents.

Features are the words of a text and their beginnings (so that inflected forms count), present or absent; the most
telling ones per category are chosen by a chi-squared statistic that Spark sums up.  The fit uses at most
``sample_limit`` labelled documents, those whose id has the smallest hash, which is what may be collected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import id_and_text, map_arrow, slices
from haulmark.session import pin

SAMPLE_LIMIT = 16_000
FEATURES = 2_000
FOLDS = 5
#: A feature must occur in at least so many documents of the sample.
MIN_DOCUMENTS = 5
#: Chi-squared value (one degree of freedom, p about 0.0005) below which a feature says nothing.
MIN_CHI2 = 12.0
_STEMS = (3, 4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")
_ODDS_LIMIT = 10.0
#: Words in a task's table after which it starts anew, and bytes of text counted at a time: both bound the memory.
_WORDS_KEPT = 100_000
_COUNTED_AT_ONCE = 2_000_000


class _WordFeatures(dict):
    """Feature numbers of a word: itself and its beginnings; with ``known`` only those, by their place.

    Kept as 64-bit numbers in bytes: as Python numbers they take five times the memory.
    """

    def __init__(self, known: dict[int, int] | None = None):
        super().__init__()
        self.place = known

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        names = [word] + [word[:n] + "*" for n in _STEMS if len(word) > n]
        hashes = [xxhash.xxh3_64_intdigest(n.encode()) >> 1 for n in names]
        if self.place is not None:
            hashes = [self.place[h] for h in hashes if h in self.place]
        found = self[word] = np.array(hashes, np.int64).tobytes()
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct features of a text."""
        words = set(_WORD.findall((text or "").lower()))
        return np.unique(np.frombuffer(b"".join(map(self.__getitem__, words)), np.int64))


@dataclass(frozen=True)
class ChainModel:
    """Weights of each category's model over the chosen features, then over the earlier categories' log-odds."""

    categories: tuple[str, ...]
    features: tuple[int, ...]
    weights: tuple[np.ndarray, ...]
    earlier: tuple[np.ndarray, ...]
    biases: tuple[float, ...]
    threshold: float

    def probabilities(self, found: Sequence[np.ndarray]) -> np.ndarray:
        """One row per document, one column per category."""
        odds = np.zeros((len(found), len(self.categories)))
        for c in range(len(self.categories)):
            own = np.array([self.weights[c][f].sum() for f in found])
            odds[:, c] = np.clip(own + odds[:, :c] @ self.earlier[c] + self.biases[c], -_ODDS_LIMIT, _ODDS_LIMIT)
        return 1 / (1 + np.exp(-odds))


def _fit_linear(rows: np.ndarray, columns: np.ndarray, dense: np.ndarray, target: np.ndarray, width: int,
                penalty: float = 1e-4, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression over present features (row, column) and dense columns, by Adam with a falling step."""
    count, extra = len(target), dense.shape[1]
    weights = np.zeros(width + extra + 1)
    weights[-1] = np.log((target.sum() + 0.5) / (count - target.sum() + 0.5))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        odds = np.bincount(rows, weights[:width][columns], count) + dense @ weights[width:-1] + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
        slope = np.concatenate([np.bincount(columns, error[rows], width), dense.T @ error, [error.sum()]]) / count
        slope[:-1] += penalty * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        move = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights -= 0.3 * (1 - step / (steps + 1)) * move
    return weights[:width], weights[width:-1], float(weights[-1])


def _best_threshold(scores: np.ndarray, truth: np.ndarray) -> float:
    """Middle of the gap below the score that gives the best F1."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + truth.sum())
    # Ties share a rank: only the last of equal scores can be a cut.
    ranked = scores[order]
    cuts = np.append(ranked[1:] != ranked[:-1], True)
    best = int(np.argmax(np.where(cuts, f1, -1)))
    below = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float((ranked[best] + below) / 2)


def _count_features(categories: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words = _WordFeatures()
        for part in (part for batch in batches for part in slices(batch, size=_COUNTED_AT_ONCE)):
            found = [words.of(t) for t in part["text"].to_pylist()]
            spans = [len(f) for f in found]
            # Numbered by a hash table: sorting takes several copies of all features.
            coded = pa.array(np.concatenate(found)).dictionary_encode()
            del found
            where, names = coded.indices.to_numpy(), coded.dictionary
            yield {"feature": names, "n": np.bincount(where, minlength=len(names)),
                   **{c: np.bincount(where, np.repeat(part[c].to_numpy().astype(float), spans), len(names)).astype(np.int64)
                      for c in categories}}

    return run


def fit_chain(df: DataFrame, labels: DataFrame, categories: Sequence[str] = ("quality", "toxic"), id_col: str = "doc_id",
              text_col: str = "text", sample_limit: int = SAMPLE_LIMIT, features: int = FEATURES) -> ChainModel:
    """Fit the chain; the last category's threshold gives the best F1 of its out-of-fold predictions.

    Labelled rows with a null id or a null label are left out; of several labels of one id the largest counts, and of
    several texts of one id the one with the smallest hash.  At most ``sample_limit`` labelled documents are used, those
    with the smallest hashes of their ids; labels of other documents do not count towards the limit.  Without any labelled
    document, or with one class only, the last category rejects nothing.
    """
    named = labels.select(F.col(id_col).cast("bigint").alias("id"), *[F.col(c).cast("int").alias(c) for c in categories])
    docs = id_and_text(df, id_col, text_col)
    sample = (
        named.dropna().groupBy("id").agg(*[F.max(c).alias(c) for c in categories])
        .join(docs.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample_limit)
    )
    # At most sample_limit rows on either side of the grouping's result, however often a document is repeated.
    labelled = docs.join(F.broadcast(sample), "id").groupBy("id", *categories).agg(
        F.min_by("text", F.xxhash64(F.coalesce("text", F.lit("")))).alias("text"))
    texts = pin(labelled.select("id", "text", *categories), "labelled")
    long = ", ".join(f"{c} bigint" for c in categories)
    counts = (
        map_arrow(texts, _count_features(categories), f"feature bigint, n bigint, {long}").groupBy("feature")
        .agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in categories]).filter(F.col("n") >= MIN_DOCUMENTS)
    )
    counts = pin(counts, "feature-counts")
    totals = texts.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in categories]).first()
    if not totals["n"]:
        empty = tuple(np.zeros(1) for _ in categories)
        return ChainModel(tuple(categories), (), empty, tuple(np.zeros(c) for c in range(len(categories))),
                          (-_ODDS_LIMIT,) * len(categories), 1.0)
    chosen: list[set[int]] = []
    for c in categories:
        expected = F.col("n") * (totals[c] / totals["n"])
        spread = expected * (1 - totals[c] / totals["n"]) + 1e-9
        telling = counts.withColumn("chi2", (F.col(c) - expected) ** 2 / spread).filter(F.col("chi2") >= MIN_CHI2)
        top = telling.orderBy(F.col("chi2").desc(), "feature").limit(features).select("feature")
        chosen.append({row[0] for row in top.collect()})
    names = tuple(sorted(set().union(*chosen)))
    own = [np.array([name in some for name in names], bool) for some in chosen]

    place = {name: i for i, name in enumerate(names)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words = _WordFeatures(place)
        for part in (part for batch in batches for part in slices(batch)):
            yield {"id": part["id"], "found": [words.of(t) for t in part["text"].to_pylist()],
                   **{c: part[c] for c in categories}}

    # Numbers in columns: as rows of lists the sample takes many times the memory, here and in the JVM.
    rows = map_arrow(texts, present, "id bigint, found array<int>, " + ", ".join(f"{c} int" for c in categories)).toArrow()
    return _fit_rows(rows.sort_by("id"), tuple(categories), names, own)


def _fit_rows(rows: pa.Table, categories: tuple[str, ...], names: tuple[int, ...], own: list[np.ndarray]) -> ChainModel:
    """Fit each category on its own features (``own``: which of ``names`` those are) and the earlier log-odds.

    ``rows``: one per document, with the features found in it.
    """
    count, width = len(rows), max(1, len(names))
    fold = np.array([xxhash.xxh3_64_intdigest(str(i).encode()) % FOLDS for i in rows["id"].to_pylist()])
    found = rows["found"].combine_chunks()
    every_row = np.repeat(np.arange(count, dtype=np.int32), pc.list_value_length(found).to_numpy(zero_copy_only=False))
    every_column = found.flatten().to_numpy(zero_copy_only=False)
    unseen = np.zeros((count, 0))
    weights, earlier, biases, threshold = [], [], [], 1.0
    for c, allowed in zip(categories, own):
        picked = allowed[every_column] if len(every_column) else np.zeros(0, bool)
        at, columns = every_row[picked], every_column[picked]
        target = rows[c].to_numpy().astype(float)
        odds = np.zeros(count)
        for out in range(FOLDS):
            inside = fold != out
            if not inside.any():
                continue
            number = np.cumsum(inside) - 1
            used = inside[at]
            w, e, b = _fit_linear(number[at[used]], columns[used], unseen[inside], target[inside], width)
            score = np.bincount(at, w[columns], count) + unseen @ e + b
            odds[~inside] = score[~inside]
        odds = np.clip(odds, -_ODDS_LIMIT, _ODDS_LIMIT)
        if 0 < target.sum() < count:
            threshold = _best_threshold(1 / (1 + np.exp(-odds)), target)
        else:
            threshold = 1.0
        w, e, b = _fit_linear(at, columns, unseen, target, width)
        weights.append(w)
        earlier.append(e)
        biases.append(b)
        unseen = np.column_stack([unseen, odds])
    return ChainModel(categories, names, tuple(weights), tuple(earlier), tuple(biases), threshold)


def score(df: DataFrame, model: ChainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``p_<category>`` in chain order, and ``rejected``: the last probability is above the model's threshold.

    One row per row of ``df``, null ids and repeated rows included.  A null or empty text has no features, so its
    probabilities are those of the models' constant terms.
    """
    place = {name: i for i, name in enumerate(model.features)}
    columns = [f"p_{c}" for c in model.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words = _WordFeatures(place)
        for part in (part for batch in batches for part in slices(batch)):
            p = model.probabilities([words.of(t) for t in part["text"].to_pylist()])
            yield {"id": part["id"], **{c: p[:, i] for i, c in enumerate(columns)}, "rejected": p[:, -1] > model.threshold}

    schema = ", ".join(["id bigint", *[f"{c} double" for c in columns], "rejected boolean"])
    return map_arrow(id_and_text(df, id_col, text_col), run, schema)


def keep_clean(df: DataFrame, model: ChainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` that the chain does not reject, all columns as they are; rows without id are scored like others."""
    place = {name: i for i, name in enumerate(model.features)}

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        words, kept = _WordFeatures(place), [np.zeros(0, bool)]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            kept.append(model.probabilities([words.of(t) for t in part["text"].to_pylist()])[:, -1] <= model.threshold)
        return pa.array(np.concatenate(kept))

    return df.filter(clean(F.col(text_col)))
