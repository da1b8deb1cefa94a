"""Language identification by averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its byte n-grams, hashed into a fixed table; a softmax over a linear map of
the average names the language. Both tables are trained together by stochastic gradient descent on a bounded sample of
labelled documents, the sharpness and the rejection threshold are set on documents of the sample held back from it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from folioworks.functions.binding import free_names
from folioworks.llm.common import for_workers
from folioworks.llm.tokens import byte_values, mix, pieces


@dataclass(frozen=True)
class Training:
    """``sample`` bounds the labelled documents used for training, ``sample_bytes`` their text; everything is
    predicted. A document is rejected below the confidence that ``spared`` of the held-back documents exceed, at most
    ``strictest``."""

    sample: int = 3000
    sample_bytes: int = 24_000_000
    grams: tuple[int, ...] = (2, 3, 4)
    bits: int = 15
    width: int = 16
    passes: int = 4
    rate: float = 0.4
    spared: float = 0.999
    strictest: float = 0.5
    seed: int = 5


@dataclass(frozen=True)
class Model:
    """``scores`` holds what each n-gram bucket adds to each language, sharpened; the last bucket adds nothing."""

    languages: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    threshold: float
    grams: tuple[int, ...]
    bits: int


def buckets(raw: np.ndarray, offsets: np.ndarray, grams: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each n-gram length the bucket at each byte; an n-gram that would leave its document gets the last one."""
    values = byte_values(raw)
    values = np.where((raw >= 65) & (raw <= 90), byte_values(raw | np.uint8(32)), values)
    out = []
    for n in grams:
        h = values.copy()
        for k in range(1, n):
            h[:-k] = h[:-k] * np.uint64(0x2545F4914F6CDD1D) + values[k:]
        b = (mix(h) >> np.uint64(64 - bits)).astype(np.int32)
        ends = offsets[1:][:, None] - np.arange(1, n)
        b[np.unique(ends[(ends >= offsets[:-1][:, None]) & (ends < len(raw))])] = 1 << bits
        out.append(b)
    return out


def train(texts: list[str], labels: list[str], how: Training) -> Model:
    """Fit the two tables, then the sharpness and the threshold."""
    languages = tuple(sorted(set(labels)))
    size = 1 << how.bits
    if not languages:
        return Model((), np.zeros((size + 1, 0), np.float32), np.zeros(0), 0.0, how.grams, how.bits)
    random = np.random.default_rng(how.seed)
    features = []
    for text in texts:
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        found = np.concatenate(buckets(raw, np.array([0, len(raw)]), how.grams, how.bits)) if len(raw) else np.zeros(0, int)
        ids, counts = np.unique(found[found < size], return_counts=True)
        features.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
    truth = np.array([languages.index(x) for x in labels])
    order = random.permutation(len(texts))
    # One in five is held back, unless there are too few to spare any.
    back = order[: len(order) // 5] if len(order) >= 20 else order
    fit = order[len(order) // 5 :] if len(order) >= 20 else order
    table = random.normal(0, 0.1, (size, how.width)).astype(np.float32)
    linear = random.normal(0, 0.1, (how.width, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    for step in range(how.passes):
        rate = np.float32(how.rate * (1 - step / how.passes))
        for d in random.permutation(fit):
            ids, share = features[d]
            hidden = share @ table[ids]
            wrong = _softmax(hidden @ linear + bias)
            wrong[truth[d]] -= 1
            down = linear @ wrong
            linear -= rate * np.outer(hidden, wrong)
            bias -= rate * wrong * np.float32(0.1)
            # The shares are small, so the table learns at a larger rate.
            table[ids] -= rate * 20 * share[:, None] * down
    logits = np.array([features[d][1] @ table[features[d][0]] @ linear + bias for d in back], float)
    sharpness = min((2.0 ** (k / 2) for k in range(-8, 13)), key=lambda s: _loss(logits * s, truth[back]))
    sure = np.sort(_softmax(logits * sharpness).max(1))
    threshold = min(how.strictest, float(sure[int((1 - how.spared) * len(sure))]))
    scores = np.zeros((size + 1, len(languages)), np.float32)
    scores[:size] = table @ linear * sharpness
    return Model(languages, scores, bias.astype(float) * sharpness, threshold, how.grams, how.bits)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _loss(logits: np.ndarray, truth: np.ndarray) -> float:
    p = _softmax(logits)[np.arange(len(truth)), truth]
    return float(-np.log(np.maximum(p, 1e-300)).mean())


def predict(model: Model, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language number and confidence of each document."""
    n = len(offsets) - 1
    logits = np.zeros((n, len(model.languages)))
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        total = np.zeros((len(full), len(model.languages)))
        counted = np.zeros(len(full))
        for length, b in zip(model.grams, buckets(raw, offsets, model.grams, model.bits), strict=True):
            total += np.add.reduceat(model.scores[b], offsets[full], axis=0)
            counted += np.maximum(0, np.diff(offsets)[full] - length + 1)
        logits[full] = total / np.maximum(1, counted)[:, None] + model.bias
    p = _softmax(logits)
    return p.argmax(1), p.max(1)


def learned(docs: DataFrame, usable: Column, how: Training = Training(), id_column: str = "doc_id",
            text_column: str = "text", lang_column: str = "lang") -> Model:
    """Train on a sample of the rows that are ``usable`` and have text and language.

    The sample is the ``how.sample`` rows whose ids have the smallest MD5, less texts of over an eighth of
    ``how.sample_bytes`` and what comes after that many bytes: bounded whatever the size of the corpus. Rows without
    an id are not drawn.
    """
    labelled = docs.filter(usable & F.col(text_column).isNotNull() & F.col(lang_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"),
        F.md5(F.col(id_column).cast("string")).alias("drawn"), F.octet_length(text_column).alias("size"))
    # The draw orders narrow rows; texts are read for the drawn ids alone.
    drawn = F.broadcast(labelled.select("drawn", "id").orderBy("drawn").limit(how.sample).select("id").distinct())
    sample = labelled.join(drawn, "id").filter(F.col("size") <= how.sample_bytes // 8)
    texts, labels, taken = [], [], 0
    for row in sample.orderBy("drawn", "size", "lang").limit(how.sample).toLocalIterator():
        taken += row["size"]
        if taken > how.sample_bytes:
            break
        texts.append(row["text"])
        labels.append(row["lang"])
    return train(texts, labels, how)


def identified(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected added; columns of these names are replaced.

    ``score`` is the calibrated probability of the predicted language. A text that is null or has no letter is ``und``
    with score 0 and rejected; so is every text if nothing was learned. Others get a learned language and are rejected
    if the score is below the model's threshold. Texts are read whole, however long.
    """
    spark = for_workers(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by the table's bits and the number of languages
    kept = docs.drop("lang_pred", "score", "rejected")
    letter = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False))
    given = kept.select("*", letter.alias(*free_names(kept.columns, "has_letter")))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("rejected", T.BooleanType())]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            letter = np.asarray(batch.column(batch.num_columns - 1))
            best, sure = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows)
            if model.languages:
                for lo, hi, raw, offsets in pieces(batch, text_column):
                    best[lo:hi], sure[lo:hi] = predict(model, raw, offsets)
            known = letter & bool(model.languages)
            names = np.array([*model.languages, "und"], object)
            lang = names[np.where(known, best, len(model.languages))]
            score = np.where(known, sure, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score),
                 pa.array(~known | (score < model.threshold))],
                [*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    return given.mapInArrow(named, T.StructType([*kept.schema.fields, *added]))
