"""Toxicity by weak supervision.

Many voters look at a text: lexicons of word stems mined from all labelled rows, a fixed list of insults, and
patterns. A generative label model learns, without labels and from the votes on all texts, how accurate the
voters are and how they hang together, and so gives each text a posterior. A linear classifier over hashed
words and word beginnings learns from the posteriors of a bounded sample of labelled rows; which features it
uses, and where those start that the sample hardly has, comes from the posteriors of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.llm.texts import LOWER, mixed, pieces, prefix_sums, sorted_unique, span_hashes, words
from partylens.session import stable

# Common English insults.
INSULTS = "clown disgusting dumb fool idiot jerk loser moron pathetic scum stupid trash ugly worthless".split()

SAMPLE = 12_000  # labelled rows for the classifier's gradient descent
LEXICONS = 24  # mined lexicons
STEMS = (4, 5, 6, 7)  # bytes of the word beginnings
BUCKETS = 1 << 18
PRECISION = 0.8  # share of toxic texts among a mined term's texts
STRIKING = 5.0  # standard deviations by which a feature's posteriors must differ from the mean
EPOCHS, RATE = 10, 0.5

NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) of a piece, terms being whole words and word beginnings, with words per text."""
    starts, ends, per_text = words(data, offsets, NOT_WORD)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    sums = prefix_sums(LOWER[data])
    hashes, owners = [mixed(span_hashes(sums, starts, ends) + np.uint64(1))], [owner]
    for n in STEMS:
        long = ends - starts >= n
        hashes.append(span_hashes(sums, starts[long], starts[long] + n))
        owners.append(owner[long])
    value, owner = sorted_unique(np.concatenate(hashes), np.concatenate(owners))
    return owner, value, per_text


def word_terms(listed: list[str]) -> np.ndarray:
    raw = [w.encode() for w in listed]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    return mixed(span_hashes(prefix_sums(data), ends - [len(w) for w in raw], ends) + np.uint64(1))


@dataclass
class Voters:
    """Mined terms (sorted) and the lexicon each belongs to."""

    term: np.ndarray
    lexicon: np.ndarray

    @property
    def count(self) -> int:
        return LEXICONS + 5

    def votes(self, data: np.ndarray, offsets: np.ndarray, owner: np.ndarray, value: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """1 for toxic, -1 for clean, 0 for no opinion; a row per text."""
        n = len(per_text)
        cast = np.zeros((n, self.count), np.int8)
        hits = np.zeros(n, np.int64)
        if len(self.term):
            at = np.minimum(np.searchsorted(self.term, value), len(self.term) - 1)
            found = self.term[at] == value
            cast[owner[found], self.lexicon[at[found]]] = 1
            hits = np.bincount(owner[found], minlength=n)
        insult = np.zeros(n, bool)
        insult[owner[np.isin(value, word_terms(INSULTS))]] = True
        totals = np.concatenate([[0], np.cumsum((data == 0x21) | (data == 0x3F))])
        shouted = (totals[offsets[1:]] - totals[offsets[:-1]]) > 0.1 * np.maximum(1, np.diff(offsets))
        cast[insult, LEXICONS] = 1
        cast[hits == 0, LEXICONS + 1] = -1  # no mined term at all
        cast[(hits == 0) & ~insult & (per_text >= 5), LEXICONS + 2] = -1
        cast[hits >= 3, LEXICONS + 3] = 1
        cast[shouted & (hits == 0), LEXICONS + 4] = -1  # noise, not insult
        return cast


@dataclass
class LabelModel:
    """Distributions of each voter's votes (-1, 0, 1) given the class, and what each voter counts for."""

    prior: float
    toxic: np.ndarray | None = None
    clean: np.ndarray | None = None
    weight: np.ndarray | None = None

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of toxic for each row of votes; before the first round a guess."""
        if self.toxic is None:
            return np.clip(np.where((votes == 1).any(1), 0.9, self.prior), 1e-3, 1 - 1e-3)
        gain = np.einsum("rvk,vk->rv", kinds(votes), np.log(self.toxic) - np.log(self.clean)) @ self.weight
        return 1 / (1 + np.exp(-np.clip(gain + np.log(self.prior / (1 - self.prior)), -30, 30)))


def kinds(votes: np.ndarray) -> np.ndarray:
    return np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # rows x voters x votes


def moments(votes: np.ndarray, many: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Sums over texts that a round needs, as one array; ``many`` texts have each row of votes."""
    x, k, toxic = votes.astype(float), kinds(votes), many * p
    return np.concatenate([
        np.einsum("r,rvk->vk", toxic, k).ravel(), np.einsum("r,rvk->vk", many, k).ravel(), (x.T @ (x * many[:, None])).ravel(),
        toxic @ x, many @ x, [toxic.sum(), (toxic * p).sum(), many.sum()],
    ])


def label_model(sums: Callable[[LabelModel], np.ndarray], voters: int, prior: float, rounds: int = 30) -> LabelModel:
    """Expectation maximisation; ``sums`` gives the ``moments`` of all texts under a model.

    The correlations are those of the voters' residuals given the class; a voter that repeats others counts
    for 1 / (1 + the sum of its positive correlations), so a crowd of copies weighs like one voter.
    """
    model, weight = LabelModel(prior), np.ones(voters)
    for step in range(rounds):
        s = sums(model)
        cells = voters * 3
        k_toxic, k_all = s[:cells].reshape(voters, 3), s[cells:2 * cells].reshape(voters, 3)
        toxic, clean = ((t + 0.1) / (t + 0.1).sum(1, keepdims=True) for t in (k_toxic, k_all - k_toxic))
        if step % 5 == 4:
            xx, (px, x) = s[2 * cells:2 * cells + voters**2].reshape(voters, voters), s[2 * cells + voters**2:-3].reshape(2, voters)
            n_p, n_pp, n = s[-3:]
            t, c, qx = toxic[:, 2] - toxic[:, 0], clean[:, 2] - clean[:, 0], x - px
            cross = np.outer(px, t) + np.outer(qx, c)
            square = n_pp * np.outer(t, t) + (n_p - n_pp) * (np.outer(t, c) + np.outer(c, t)) + (n - 2 * n_p + n_pp) * np.outer(c, c)
            together = (xx - cross - cross.T + square) / n
            mean = (x - n_p * t - (n - n_p) * c) / n
            scale = np.sqrt(np.maximum(np.diag(together) - mean**2, 0))
            together = together / (np.outer(scale, scale) + 1e-9)
            np.fill_diagonal(together, 0)
            weight = 1 / (1 + np.clip(together, 0, 1).sum(1))
        model = LabelModel(prior, toxic, clean, weight)
    return model


def surprise(seen: np.ndarray, toxic: np.ndarray, base: float) -> np.ndarray:
    """How unlikely (-log of the Chernoff bound) a share of toxic texts as far from ``base`` as toxic / seen is by chance."""
    share = np.clip(toxic / np.maximum(seen, 1), 1e-9, 1 - 1e-9)
    return seen * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))


def linear(bucket: list[np.ndarray], posterior: np.ndarray, seen: np.ndarray, mass: np.ndarray, base: float) -> tuple[np.ndarray, float]:
    """Logistic regression on posteriors by stochastic gradient descent.

    ``seen`` and ``mass`` are the texts and the sum of the posteriors of each feature, ``base`` the mean
    posterior, over all labelled rows. Only the listed insults take part, and features whose texts differ
    strikingly from the mean; the others stay 0, so that thousands of words of a long text cannot add up to a verdict by chance. One
    in too few texts here to be shown by them starts from its odds in all rows, shared by the features of a word.
    """
    rng = np.random.default_rng(11)
    here = np.bincount(np.concatenate(bucket), minlength=BUCKETS) if len(bucket) else np.zeros(BUCKETS, int)
    striking = np.abs(mass - seen * base) >= STRIKING * np.sqrt(np.maximum(seen, 1) * base * (1 - base))
    striking[(word_terms(INSULTS) % np.uint64(BUCKETS)).astype(np.int64)] = True
    odds = np.log((mass + 0.5) / (np.maximum(seen - mass, 0) + 0.5)) - np.log(base / (1 - base))
    weight = np.where(striking & (here * (1 - base) < STRIKING**2 * base), odds / (len(STEMS) + 1), 0.0)
    bucket = [b[striking[b]] for b in bucket]
    bias, power = float(np.log(base / (1 - base))), np.ones(BUCKETS)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bucket)):
            b = bucket[i]
            error = 1 / (1 + np.exp(-np.clip(weight[b].sum() + bias, -30, 30))) - posterior[i]
            power[b] += error * error
            weight[b] -= RATE * error / np.sqrt(power[b])
            bias -= 0.02 * error
    return weight, bias


FILTER = 1 << 26  # bits


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id and ``sign``, a hash of the whole text: equal for equal texts only."""
    for rows, data, offsets in pieces(batches, "text"):
        sign = span_hashes(prefix_sums(data), offsets[:-1], offsets[1:])
        yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index("_id")), pa.array(sign.view(np.int64))], names=["_id", "sign"])


def _mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, stem (the beginning that groups terms), texts and toxic texts with it, summed per piece."""
    for rows, data, offsets in pieces(batches, "text"):
        toxic = np.asarray(rows.column(rows.schema.get_field_index("label")).to_numpy(zero_copy_only=False))
        owner, value, _ = terms(data, offsets)
        term, at = np.unique(value, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(term.view(np.int64)), pa.array(np.bincount(at, minlength=len(term))), pa.array(np.bincount(at, toxic[owner], len(term)).astype(np.int64))],
            names=["term", "texts", "toxic"],
        )


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Only the rows whose text has the sign that was kept, as an id can name several texts."""
    for rows, data, offsets in pieces(batches, "text"):
        sign = span_hashes(prefix_sums(data), offsets[:-1], offsets[1:]).view(np.int64)
        yield rows.filter(pa.array(sign == rows.column(rows.schema.get_field_index("_sign")).to_numpy(zero_copy_only=False)))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of set bits as (number of a 64-bit word, its bits)."""
    for batch in batches:
        at = np.unique(batch.column(0).to_numpy().view(np.uint64) % np.uint64(FILTER))
        used, first = np.unique(at >> np.uint64(6), return_index=True)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first).view(np.int64))], names=["place", "bits"])


def likely(rows: DataFrame, among: DataFrame, id_col: str) -> DataFrame:
    """``rows`` without most of those whose id is not in ``among``, before a join moves them.

    A filter of ``FILTER`` bits, whatever the input, goes to every task; it keeps all ids of ``among``.
    """
    found = among.select(F.xxhash64(id_col)).mapInArrow(_bits, "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    mask = np.zeros(FILTER // 64, np.uint64)
    mask[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(mask)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy().view(np.uint64) % np.uint64(FILTER)
            yield batch.filter(pa.array((shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.withColumn("_hash", F.xxhash64(id_col)).mapInArrow(kept, f"{fields}, _hash bigint").drop("_hash")


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """text, label and place (a hash of the id) of all labelled rows; equal texts with equal labels count once.

    Ids and hashes decide; the texts of other rows stay where they are, but for the few that a filter lets through.
    """
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).dropDuplicates(["_id"])
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    signs = texts.mapInArrow(_signed, f"_id {dict(texts.dtypes)['_id']}, sign bigint").join(known, "_id")
    kept = signs.groupBy("sign", "label").agg(F.min(F.struct(F.xxhash64("_id", F.lit(3)).alias("place"), "_id")).alias("first"))
    kept = kept.select("first._id", "first.place", "label", "sign").withColumnRenamed("sign", "_sign")
    kept = stable(kept, "kept")
    found = likely(texts, kept, "_id").join(kept, "_id").select("text", "label", "place", "_sign")
    return found.mapInArrow(_own_text, "text string, label int, place bigint, _sign bigint").dropDuplicates(["_sign", "label"]).drop("_sign")


def mine(texts: DataFrame) -> tuple[Voters, float]:
    """Lexicons from all labelled texts, and the share of toxic ones among them.

    A term is mined if ``PRECISION`` of its texts are toxic and chance would bring less than one such term
    among all terms of two texts or more: a few texts are enough in a small table, more are asked of a large
    one. The terms are as many as are found.
    """
    counts = texts.mapInArrow(_mined, "term bigint, texts bigint, toxic bigint").groupBy("term").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))
    counts = stable(counts.where(F.col("texts") > 1), "terms")
    share = texts.agg(F.avg("label")).first()[0]
    prior = min(0.5, max(0.01, share or 0.0))
    likely_toxic = counts.where(F.col("toxic") >= PRECISION * F.col("texts")).select("term", "texts", "toxic").toArrow()
    term, seen, toxic = (likely_toxic.column(n).to_numpy() for n in ("term", "texts", "toxic"))
    sure = surprise(seen, toxic, prior) >= np.log(max(2, counts.count()))
    ranked = np.lexsort((term[sure], -toxic[sure]))
    found = term[sure][ranked].view(np.uint64)
    order = np.argsort(found)
    return Voters(found[order], np.arange(len(found))[order] % LEXICONS), prior


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights and bias of the classifier.

    All labelled rows serve the lexicons, the share of toxic texts and the choice of features; the votes on all
    rows of ``docs`` serve the label model, which sees no label. The classifier's descent is one task over at
    most ``sample`` labelled rows, chosen by a hash of the id after equal texts are merged.
    """
    spark = docs.sparkSession
    texts = stable(labelled(docs, labels, label_col, id_col, text_col), "labelled")
    voters, prior = mine(texts)
    shared = spark.sparkContext.broadcast(voters)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in pieces(batches, "text"):
            cast, many = np.unique(shared.value.votes(data, offsets, *terms(data, offsets)), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in cast], pa.binary()), pa.array(many)], names=["votes", "many"])

    votes = docs.select(F.col(text_col).alias("text")).mapInArrow(patterns, "votes binary, many bigint").groupBy("votes").agg(F.sum("many").alias("many"))
    votes = stable(votes, "votes")

    def sums(model: LabelModel) -> np.ndarray:
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cast = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int8).reshape(batch.num_rows, -1)
                    many = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), float)
                    yield pa.RecordBatch.from_arrays([pa.array([moments(cast, many, model.posterior(cast)).tobytes()], pa.binary())], names=["sums"])

        return np.sum([np.frombuffer(r["sums"], float) for r in votes.mapInArrow(summed, "sums binary").collect()], axis=0)

    if votes.isEmpty() or texts.isEmpty():
        return np.zeros(BUCKETS, np.float32), 0.0
    model = label_model(sums, voters.count, prior)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, mass = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)  # last, the texts
        for _, data, offsets in pieces(batches, "text"):
            owner, value, per_text = terms(data, offsets)
            posterior = model.posterior(shared.value.votes(data, offsets, owner, value, per_text))
            bucket, owner = sorted_unique((value % np.uint64(BUCKETS)).astype(np.int64), owner)
            seen += np.bincount(bucket, minlength=BUCKETS + 1)
            mass += np.bincount(bucket, posterior[owner], BUCKETS + 1)
            seen[-1], mass[-1] = seen[-1] + len(per_text), mass[-1] + posterior.sum()
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at]), pa.array(mass[at])], names=["bucket", "seen", "mass"])

    seen, mass = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for r in texts.select("text").mapInArrow(weighed, "bucket bigint, seen double, mass double").groupBy("bucket").agg(F.sum("seen").alias("seen"), F.sum("mass").alias("mass")).collect():
        seen[r["bucket"]], mass[r["bucket"]] = r["seen"], r["mass"]  # BUCKETS rows at most
    base = min(0.99, max(0.01, mass[-1] / max(1, seen[-1])))
    counted = spark.sparkContext.broadcast((seen[:-1], mass[:-1]))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text"):
            owner, value, per_text = terms(data, offsets)
            posterior = model.posterior(shared.value.votes(data, offsets, owner, value, per_text))
            bucket = (value % np.uint64(BUCKETS)).astype(np.int32)
            ends = np.searchsorted(owner, np.arange(rows.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("place")), pa.array(posterior),
                 pa.array([np.unique(bucket[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                names=["place", "posterior", "bucket"],
            )

    def learned(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "bucket"], kind="stable")
        weight, bias = linear([np.frombuffer(b, np.int32) for b in rows["bucket"]], rows["posterior"].to_numpy(), *counted.value, base)
        return pd.DataFrame({"weight": [weight.astype(np.float32).tobytes()], "bias": [bias]})

    places = F.broadcast(texts.select("place").orderBy("place").limit(sample).distinct())
    chosen = texts.select("text", "place").join(places, "place")
    found = chosen.mapInArrow(featured, "place bigint, posterior double, bucket binary").withColumn("one", F.lit(1)).groupBy("one").applyInPandas(learned, "weight binary, bias double").first()
    return np.frombuffer(found["weight"], np.float32), found["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], into: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the probability of toxic as last column (an old column of that name goes).

    Row by row, without a shuffle. A null or empty text has no terms and scores by the bias alone.
    """
    weight, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weight)  # BUCKETS numbers, whatever the input

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for rows, data, offsets in pieces(batches, text_col):
            owner, value, _ = terms(data, offsets)
            bucket = (value % np.uint64(BUCKETS)).astype(np.int64)
            logit = np.bincount(owner, table[bucket], rows.num_rows) + bias
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], names=[*rows.schema.names, into])

    kept = docs.drop(into) if into in docs.columns else docs
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(scored, f"{fields}, `{into}` double")
