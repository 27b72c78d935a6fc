"""Quality classifier: supervised subword embeddings.

Words, word pairs and byte n-grams are hashed into rows of an embedding table; a text is the mean of its
rows, and a softmax over two classes follows. Table and output weights are learned together by stochastic
gradient descent in numpy on a bounded sample of labelled texts. After training, the output weights are
multiplied into the table, so scoring a text is a mean of one number per feature: the same softmax.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.llm.texts import mixed, pieces, prefix_sums, span_hashes, words

BUCKETS = 1 << 17  # rows of the embedding table
DIMENSION = 8
GRAM = 4  # bytes of a character n-gram
EPOCHS = 6
RATE = 4.0
SAMPLE = 4000  # labelled texts that are learned from at most


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word, word pair and byte n-gram of a piece; a repeated word is a pair of its own kind."""
    starts, ends, per_text = words(data, offsets)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    sums = prefix_sums(data)
    word = span_hashes(sums, starts, ends)
    paired = owner[1:] == owner[:-1]
    same = word[1:] == word[:-1]
    pair = np.where(same, np.uint64(12345), mixed(word[1:] + word[:-1] * np.uint64(0x9E3779B97F4A7C15)))[paired]
    at = np.arange(max(0, len(data) - GRAM + 1))
    text_of = np.repeat(np.arange(len(per_text)), np.diff(offsets))
    at = at[text_of[at] == text_of[at + GRAM - 1]] if len(at) else at
    gram = span_hashes(sums, at, at + GRAM)
    hashes = np.concatenate([word, pair, gram ^ np.uint64(0x5BD1E995)])
    owners = np.concatenate([owner, owner[1:][paired], text_of[at] if len(at) else np.zeros(0, np.int64)])
    return owners, (hashes % np.uint64(buckets)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, buckets and their shares of the text, for learning."""
    for rows, data, offsets in pieces(batches, "text"):
        owner, bucket = features(data, offsets)
        keys, counts = np.unique(owner * BUCKETS + bucket, return_counts=True)
        owner, bucket = keys // BUCKETS, keys % BUCKETS
        ends = np.searchsorted(owner, np.arange(rows.num_rows + 1))
        lists = [[bucket[a:b].astype(np.int32).tobytes(), counts[a:b].astype(np.float32).tobytes()] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [rows.column(rows.schema.get_field_index("label")), rows.column(rows.schema.get_field_index("place")),
             pa.array([x[0] for x in lists], pa.binary()), pa.array([x[1] for x in lists], pa.binary())],
            names=["label", "place", "bucket", "amount"],
        )


def trained(sample: pd.DataFrame) -> pd.DataFrame:
    """Stochastic gradient descent over the sample: one row with the folded table and bias as bytes."""
    sample = sample.sort_values("place", kind="stable")
    rng = np.random.default_rng(7)
    table = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
    out, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    rows = [(np.frombuffer(b, np.int32), np.frombuffer(a, np.float32), int(y)) for b, a, y in zip(sample["bucket"], sample["amount"], sample["label"], strict=True) if len(b)]
    steps, done = max(1, EPOCHS * len(rows)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            bucket, amount, label = rows[i]
            share = amount / amount.sum()
            hidden = share @ table[bucket]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[label] -= 1
            rate = RATE * (1 - done / steps)
            back = out @ error
            # no step moves a text's logits by more than its error, however few features it has
            inner = min(rate * DIMENSION, 1 / (float(share @ share) * float((out * out).sum()) + 1e-9))
            out -= min(rate, 1 / (float(hidden @ hidden) + 1e-9)) * np.outer(hidden, error)
            bias -= 0.05 * rate * error
            table[bucket] -= inner * share[:, None] * back
            done += 1
    folded = table @ (out[:, 1] - out[:, 0])
    return pd.DataFrame({"table": [folded.astype(np.float32).tobytes()], "bias": [float(bias[1] - bias[0])]})


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Learn from at most ``sample`` labelled rows, chosen by a hash of the id; null labels are left out.

    The chosen ids are at most ``sample`` and so broadcast; training is one task over the sample. Without
    labelled rows every text scores 0.5.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"), F.xxhash64(F.col(id_col)).alias("place"))
        .dropDuplicates(["_id"]).orderBy("place", "_id").limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id").select("text", "label", "place")
    counted = texts.mapInArrow(_counted, "label int, place bigint, bucket binary, amount binary")
    found = counted.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(trained, "table binary, bias double").collect()
    if not found:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(found[0]["table"], np.float32), found[0]["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], into: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the probability of class 1 as last column (an old column of that name goes).

    Row by row, without a shuffle. A null or empty text has no features and scores by the bias alone.
    """
    table, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(table)  # BUCKETS numbers, whatever the input

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for rows, data, offsets in pieces(batches, text_col):
            owner, bucket = features(data, offsets)
            total = np.bincount(owner, weights[bucket], rows.num_rows)
            count = np.bincount(owner, minlength=rows.num_rows)
            logit = total / np.maximum(count, 1) + bias
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(1 / (1 + np.exp(-logit)))], names=[*rows.schema.names, into])

    kept = docs.drop(into) if into in docs.columns else docs
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(scored, f"{fields}, `{into}` double")
