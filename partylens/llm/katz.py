"""Language-model scoring with Katz backoff over words.

Tokens are words and one end per text; the history of a token is the word before it, or the start of the
text. Every word and every (word before, word) pair of the training texts is counted and discounted by Good
and Turing. What the pairs of a history give up goes to the words not seen after it, in proportion to their
own discounted counts, with a weight that makes the probabilities after each history sum to 1, one unknown
word included. A history not seen in training takes the words' own probabilities.

All counts are tables that grow with the input. Words are rows. Pairs are dealt to buckets, as many as the
tokens ask for, as packed arrays: by the word before, or by the pair where the word before is one of the
``HOT`` most frequent. So no bucket gets a hot history; the sums of those histories are put together from all
buckets. The hot words and the ``USUAL`` most frequent pairs are known to every task, which saves looking them
up and changes no result. Every other token of a text is looked up in its bucket by one shuffle, in which no
text takes part; the answers go back by piece of the input and are added up for each text there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.llm.texts import LOWER, mixed, pieces, prefix_sums, span_hashes, words
from partylens.session import stable

HOT = 1 << 18  # words known to every task; the others are looked up, with the same result
USUAL = 1 << 18  # most frequent pairs that every task knows, likewise
TRUSTED = 5  # counts above are not discounted
RARE = np.uint64(1 << 63)  # marks the hash of a word; a hot word is its rank from 1
BEGIN = np.uint64(0)  # the start of a text is a hot history
END = np.uint64(0x9B1A_6F0E_57D3_C821)  # stands for the end of a text
GATHERED = 3 << 20  # tokens that a task gathers before it merges them
ASKED = 1 << 20  # tokens that a task gathers before it looks them up
BUCKET = 1 << 21  # training tokens in a bucket
ASKED_NAMES = ["piece", "bucket", "befores", "words", "owners", "place", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]
ANSWERED_NAMES = ["piece", "owners", "known", "more_base", "sums", *ASKED_NAMES[5:]]
GRAMS = "bucket int, befores binary, words binary, counts binary"


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every token in order; the last one of each text is ``END``."""
    low = LOWER[data]
    starts, ends, per_text = words(low, offsets)
    word = span_hashes(prefix_sums(low), starts, ends) | RARE
    after = np.cumsum(per_text)
    return np.insert(np.repeat(np.arange(len(per_text)), per_text), after, np.arange(len(per_text))), np.insert(word, after, END)


def discounts(of_counts: dict[int, int], trusted: int = TRUSTED) -> np.ndarray:
    """Factor for each count 0 .. trusted by Good and Turing, as Katz has it.

    Where the numbers of words with 1 .. trusted + 1 counts do not give factors between 0 and 1, half a
    count is taken from each instead.
    """
    n = [of_counts.get(r, 0) for r in range(trusted + 2)]
    plain = np.array([1.0] + [(r - 0.5) / r for r in range(1, trusted + 1)])
    if min(n[1:]) == 0:
        return plain
    rest = (trusted + 1) * n[trusted + 1] / n[1]
    if rest >= 1:
        return plain
    found = np.array([1.0] + [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) for r in range(1, trusted + 1)])
    return found if (found > 0).all() and (found[1:] < 1).all() else plain


def discounted(counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return counts * np.where(counts < len(factor), factor[np.minimum(counts, len(factor) - 1)], 1.0)


def pair_mass(count: np.ndarray, factor: np.ndarray, after: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each pair from its count, the tokens after its history and their discounted sum, and what is left."""
    left = 1 - kept / after
    bare = left <= 1e-9  # nothing was discounted: one count is left for the rest
    return discounted(count, factor) / np.where(bare, after + 1, after), np.where(bare, 1 / (after + 1), left)


def pack(values: np.ndarray) -> bytes:
    """An array as bytes of its compressed byte planes, behind its length."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def unpacked(column: pa.ChunkedArray | pa.Array, kind: type) -> list[np.ndarray]:
    codec, width = pa.Codec("zstd"), np.dtype(kind).itemsize
    cells = (codec.decompress(c[8:], int.from_bytes(c[:8], "little"), asbytes=True) for c in column.to_pylist())
    return [np.ascontiguousarray(np.frombuffer(c, np.uint8).reshape(width, -1).T).reshape(-1).view(kind) for c in cells]


def joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def runs(bucket: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Sorted buckets, each once, and per column one packed cell for each of them."""
    used, first = np.unique(bucket, return_index=True)
    ends = [*first[1:], len(bucket)][:len(first)]
    return [pa.array(used.astype(np.int32)), *[pa.array([pack(c[i:j]) for i, j in zip(first, ends, strict=True)], pa.binary()) for c in columns]]


def placed(among: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array, or -1."""
    if not len(among):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return np.where(among[at] == values, at, -1)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) * np.uint64(0x9E3779B97F4A7C15) + word)


def leading(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)


def pair_buckets(before: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of each pair: by the word before, or by the pair for a hot one. Even numbers; those of words are odd."""
    return 2 * leading(np.where(before < RARE, pair_keys(before, word), before), bits)


def word_buckets(word: np.ndarray, bits: int) -> np.ndarray:
    return 2 * leading(word, bits) + 1


@dataclass
class Model:
    """What every task knows, of bounded size, and the tables of all counts."""

    total: int  # training tokens
    distinct: int
    factor: np.ndarray  # discounts of the words' counts
    scale: float  # of all words' probabilities, where no word is rare
    unseen: float  # probability of the unknown word without a history
    bits: int
    hot: np.ndarray  # hashes of the hot words, sorted
    rank: np.ndarray  # of each of them, from 1
    hot_count: np.ndarray  # by rank; the first stands for the start
    words: DataFrame  # word, seen
    grams: DataFrame | None = None  # all pairs: bucket, befores, words, counts, owns (counts of the words that are not hot)
    pair_factor: np.ndarray | None = None
    sums: np.ndarray | None = None  # by rank: tokens after a hot history, and their discounted sum
    back: np.ndarray | None = None  # by rank: log10 of the backoff weight
    usual: np.ndarray | None = None  # keys of the most frequent pairs, sorted
    usual_gain: np.ndarray | None = None  # log10 of what they have more than their word alone

    def shared(self) -> Model:
        return replace(self, words=None, grams=None)

    def coded(self, word: np.ndarray) -> np.ndarray:
        at = placed(self.hot, word)
        return np.where(at >= 0, self.rank[np.maximum(at, 0)] if len(self.hot) else np.uint64(0), word).astype(np.uint64)

    def pairs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, word before, word) of every token."""
        owner, word = tokens(data, offsets)
        word = self.coded(word)
        before = np.full(len(word), BEGIN)
        same = owner[1:] == owner[:-1]
        before[1:][same] = word[:-1][same]
        return owner, before, word

    def counts(self, word: np.ndarray, own: np.ndarray | int) -> np.ndarray:
        """Counts of words, hot ones by their rank and all others from ``own``."""
        return np.where(word < RARE, self.hot_count[np.where(word < RARE, word, np.uint64(0)).astype(np.int64)], own)

    def single(self, count: np.ndarray) -> np.ndarray:
        """log10 of the words' own probabilities."""
        return np.log10(np.where(count > 0, discounted(count, self.factor) * self.scale / max(1, self.total), self.unseen))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + self.distinct + 1))


def _counted_words(gathered: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            word, count = held[0]
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "seen"])

        for _, data, offsets in pieces(batches, "text"):
            held.append(np.unique(tokens(data, offsets)[1], return_counts=True))
            if sum(len(w) for w, _ in held) > gathered:
                held[:] = [_merged(held)]
                if len(held[0][0]) > gathered // 2:
                    yield out()
                    held.clear()
        if held:
            held[:] = [_merged(held)]
            yield out()

    return counted


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    word, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
    return word, np.bincount(at, np.concatenate([c for _, c in held]), len(word)).astype(np.int64)


def summed(before: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pairs put together, sorted."""
    order = np.lexsort((word, before))
    before, word, count = before[order], word[order], count[order]
    first = np.ones(len(word), bool)
    first[1:] = (before[1:] != before[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(first)
    return before[at], word[at], np.add.reduceat(count, at) if len(at) else count


def _counted_grams(shared, gathered: int):
    """All pairs of a task with their counts; those of words that are not hot are dealt by the word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            before, word, count = held[0]
            bucket = np.where(word < RARE, pair_buckets(before, word, m.bits), word_buckets(word, m.bits))
            order = np.argsort(bucket, kind="stable")
            return pa.RecordBatch.from_arrays(runs(bucket[order], before[order], word[order], count[order]), names=["bucket", "befores", "words", "counts"])

        for _, data, offsets in pieces(batches, "text"):
            _, before, word = m.pairs(data, offsets)
            held.append((before, word, np.ones(len(word), np.int64)))
            if sum(len(h[0]) for h in held) > gathered:
                held[:] = [summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                if len(held[0][0]) > gathered // 2:
                    yield out()
                    held.clear()
        if held:
            held[:] = [summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            yield out()

    return counted


def _summed_grams(bits: int):
    """Pairs of a bucket summed. Pairs dealt by their word get the word's own count and go to their history's bucket."""

    def of_bucket(table: pa.Table) -> pa.Table:
        before, word, count = summed(*(joined(unpacked(table.column(c), k), k) for c, k in (("befores", np.uint64), ("words", np.uint64), ("counts", np.int64))))
        own = np.zeros(len(word), np.int64)
        rare = word >= RARE
        _, at = np.unique(word[rare], return_inverse=True)
        own[rare] = np.bincount(at, count[rare]).astype(np.int64)[at]
        bucket = pair_buckets(before, word, bits)
        order = np.argsort(bucket, kind="stable")
        return pa.table(runs(bucket[order], before[order], word[order], count[order], own[order]), names=["bucket", "befores", "words", "counts", "owns"])

    return of_bucket


def _grams(table: pa.Table) -> list[np.ndarray]:
    return [joined(unpacked(table.column(c), k), k) for c, k in (("befores", np.uint64), ("words", np.uint64), ("counts", np.int64), ("owns", np.int64))]


def _lots(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """The cells some at a time, so that a task does not hold many buckets."""
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            yield pa.Table.from_batches([batch.slice(at, 16)]).select(columns)


def _count_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lot in _lots(batches, ["counts"]):
        value, many = np.unique(joined(unpacked(lot.column("counts"), np.int64), np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(many)], names=["seen", "many"])


def _hot_sums(shared):
    """For each hot history: tokens after it, their discounted sum, and the words' own probabilities of its pairs."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sums = np.zeros((3, len(m.hot_count)))
        for lot in _lots(batches, ["befores", "words", "counts", "owns"]):
            before, word, count, own = _grams(lot)
            hot = before < RARE
            at = before[hot].astype(np.int64)
            for i, x in enumerate((count, discounted(count, m.pair_factor), 10.0 ** m.single(m.counts(word, own)))):
                sums[i] += np.bincount(at, x[hot], sums.shape[1])
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(x[at]) for x in sums]], names=["place", "after", "kept", "below"])

    return of_task


def _usual(least: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _lots(batches, ["befores", "words", "counts", "owns"]):
            before, word, count, own = _grams(lot)
            often = (count >= least) & (before < RARE)
            columns = (before.view(np.int64), word.view(np.int64), count, own)
            yield pa.RecordBatch.from_arrays([pa.array(c[often]) for c in columns], names=["before", "word", "seen", "own"])

    return found


def _most(sizes: DataFrame, bound: int) -> int:
    """Least count of the most frequent, ``bound`` at most, ties together."""
    taken, least = 0, 1 << 62
    for r in sizes.orderBy(F.desc("seen")).limit(bound + 1).collect():
        if taken + r["many"] > bound:
            break
        taken, least = taken + r["many"], r["seen"]
    return least


def _small(sizes: DataFrame) -> dict[int, int]:
    return {r["seen"]: r["many"] for r in sizes.where(F.col("seen") <= TRUSTED + 1).collect()}


def _with_grams(texts: DataFrame, model: Model) -> Model:
    """Count all pairs, and put together what the hot histories and the most frequent pairs need."""
    broadcast = texts.sparkSession.sparkContext.broadcast
    counted = texts.mapInArrow(_counted_grams(broadcast(model.shared()), GATHERED), GRAMS)
    grams = stable(counted.groupBy("bucket").applyInArrow(_summed_grams(model.bits), f"{GRAMS}, owns binary"), "grams")
    sizes = stable(grams.mapInArrow(_count_sizes, "seen bigint, many bigint").groupBy("seen").agg(F.sum("many").alias("many")), "counts")
    model = replace(model, grams=grams, pair_factor=discounts(_small(sizes)))
    found = grams.mapInArrow(_hot_sums(broadcast(model.shared())), "place bigint, after double, kept double, below double")
    found = found.groupBy("place").agg(*[F.sum(c).alias(c) for c in ("after", "kept", "below")]).toArrow()  # at most ``HOT`` + 1
    sums = np.zeros((3, len(model.hot_count)))
    sums[:, found.column("place").to_numpy()] = [found.column(c).to_numpy() for c in ("after", "kept", "below")]
    _, left = pair_mass(np.zeros(sums.shape[1], np.int64), model.pair_factor, np.maximum(sums[0], 1), sums[1])
    back = np.where(sums[0] > 0, np.log10(left / np.maximum(1 - sums[2], 1e-12)), 0.0)
    most = grams.mapInArrow(_usual(_most(sizes, USUAL)), "before bigint, word bigint, seen bigint, own bigint").toArrow()  # at most ``USUAL``
    before, word, count, own = (most.column(c).to_numpy() for c in ("before", "word", "seen", "own"))
    word = word.view(np.uint64)
    mass, _ = pair_mass(count, model.pair_factor, sums[0][before], sums[1][before])
    key = pair_keys(before.view(np.uint64), word)
    order = np.argsort(key)
    gain = np.log10(mass) - model.single(model.counts(word, own))
    return replace(model, sums=sums[:2], back=back, usual=key[order], usual_gain=gain[order])


def fit(docs: DataFrame, text_col: str = "text", hot: int = HOT) -> Model:
    """Count all words and pairs of all rows of ``docs``; null texts are empty and have one end.

    ``hot`` changes what is looked up where, not the model.
    """
    texts = docs.select(F.col(text_col).alias("text"))
    table = stable(texts.mapInArrow(_counted_words(GATHERED), "word bigint, seen bigint").groupBy("word").agg(F.sum("seen").alias("seen")), "words")
    sizes = stable(table.groupBy("seen").agg(F.count(F.lit(1)).alias("many")), "counts")
    total, distinct = sizes.agg(F.coalesce(F.sum(F.col("seen") * F.col("many")), F.lit(0)), F.coalesce(F.sum("many"), F.lit(0))).first()
    top = table.where(F.col("seen") >= _most(sizes, hot)).toArrow()  # at most ``hot``
    hashes, counts = top.column("word").to_numpy().view(np.uint64), top.column("seen").to_numpy()
    order = np.lexsort((hashes, -counts))
    hashes, counts = hashes[order], counts[order]
    order = np.argsort(hashes)
    of_counts = _small(sizes)
    factor = discounts(of_counts)
    lost = sum(many * seen * (1 - factor[seen]) for seen, many in of_counts.items() if seen <= TRUSTED)
    scale = 1.0 if lost > 0 else total / (total + 1)  # without rare words, one count is for the unknown
    unseen = lost / total if lost > 0 else 1 / (total + 1)
    model = Model(
        total=total, distinct=distinct, factor=factor, scale=scale, unseen=unseen, bits=max(1, int(total // BUCKET).bit_length()),
        hot=hashes[order], rank=(order + 1).astype(np.uint64), hot_count=np.concatenate([[0], counts]).astype(np.int64), words=table,
    )
    return _with_grams(texts, model)


def _asked(shared, size: int):
    """Rows of numbers for the texts of a piece, and their tokens that other tasks know, by bucket."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        held: list[tuple] = []
        piece = TaskContext.get().partitionId() << 32

        def out() -> Iterator[pa.RecordBatch]:
            sizes = [len(r) for r, *_ in held]
            start = np.cumsum([0, *sizes[:-1]])
            owner, before, word = (np.concatenate(x) for x in zip(*[(o + s, b, w) for (_, o, b, w), s in zip(held, start, strict=True)], strict=True))
            rows = pa.Table.from_batches([r for r, *_ in held]).combine_chunks()
            n = len(rows)
            hot = word < RARE
            count = m.counts(word[hot], 0)
            usual = placed(m.usual, pair_keys(before, word))
            score = np.bincount(owner[hot], m.single(count), n) + np.bincount(owner[usual >= 0], m.usual_gain[usual[usual >= 0]], n)
            spread = 2 * (((piece >> 32) + piece + np.arange(n) // 1024) & ((1 << m.bits) - 1))  # any bucket will do, the rows go through
            own, none = [pa.array(np.full(n, piece)), pa.array(spread.astype(np.int32))], [pa.nulls(n, pa.binary())] * 3
            numbers = [np.bincount(owner, minlength=n), np.bincount(owner[hot], minlength=n), np.bincount(owner[hot], m.base(count), n).astype(float), score.astype(float)]
            cells = [pa.array(np.arange(n, dtype=np.int32)), *[rows.column(c).combine_chunks() for c in ("doc_id", "held_out")]]
            cells = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cells]
            numbers = [pa.array(x) for x in numbers]
            yield pa.RecordBatch.from_arrays([*own, *none, *cells, *numbers], names=ASKED_NAMES)
            kinds = [c.type for c in (*cells, *numbers)]
            for wanted, of_pairs in ((usual < 0, True), (~hot, False)):
                o, b, w = owner[wanted].astype(np.int32), before[wanted], word[wanted]
                bucket = pair_buckets(b, w, m.bits) if of_pairs else word_buckets(w, m.bits)
                order = np.lexsort((w, b, bucket)) if of_pairs else np.lexsort((w, bucket))
                used, *packed = runs(bucket[order], *([b[order]] if of_pairs else []), w[order], o[order])
                if not of_pairs:
                    packed.insert(0, pa.nulls(len(used), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), piece)), used, *packed, *[pa.nulls(len(used), k) for k in kinds]], names=ASKED_NAMES)

        for rows, data, offsets in pieces(batches, "text"):
            held.append((rows.select(["doc_id", "held_out"]), *m.pairs(data, offsets)))
            if sum(len(h[1]) for h in held) > size:
                yield from out()
                held.clear()
                piece += 1
        if held:
            yield from out()

    return dealt


def _answered(shared):
    """The answers to the questions of a bucket: per piece the sums of its texts. Rows of numbers go through."""

    def answered(asked: pa.Table, table: pa.Table) -> pa.Table:
        m = shared.value
        entries = asked.filter(pc.is_valid(asked.column("owners")))
        through = asked.filter(pc.is_null(asked.column("owners")))
        of_pairs = len(entries) > 0 and entries.column("befores").null_count < len(entries)
        answer = _pair_answers(m, *_grams(table)) if of_pairs else _word_answers(m, table) if len(entries) else None
        cells = []
        for at in range(len(entries)):
            entry = entries.slice(at, 1)
            owner, word = unpacked(entry.column("owners"), np.int32)[0], unpacked(entry.column("words"), np.uint64)[0]
            found = answer(unpacked(entry.column("befores"), np.uint64)[0] if of_pairs else word, word)
            place, at_owner = np.unique(owner, return_inverse=True)
            sums = [np.bincount(at_owner, x, len(place)) for x in found]
            cells.append([pack(place), b"" if of_pairs else pack(sums[1].astype(np.int32)), b"" if of_pairs else pack(sums[2]), pack(sums[0])])
        n = len(cells)
        out = [entries.column("piece"), *[pa.array([c[i] for c in cells], pa.binary()) for i in range(4)], *[pa.nulls(n, asked.schema.field(c).type) for c in ASKED_NAMES[5:]]]
        none = [pa.nulls(len(through), pa.binary())] * 4
        rows = [through.column("piece"), *none, *[through.column(c) for c in ASKED_NAMES[5:]]]
        return pa.concat_tables([pa.table(x, names=ANSWERED_NAMES) for x in (out, rows)])

    return answered


def _pair_answers(m: Model, before: np.ndarray, word: np.ndarray, count: np.ndarray, own: np.ndarray):
    """What pairs add to the score of their words: a hot history has its sums, of any other all pairs are here."""
    low = m.single(m.counts(word, own))
    history, at = np.unique(before, return_inverse=True)
    n = len(history)
    after, kept, below = (np.bincount(at, x, n) for x in (count, discounted(count, m.pair_factor), 10.0**low))
    hot = history < RARE
    after[hot], kept[hot] = m.sums[:, history[hot].astype(np.int64)]
    mass, _ = pair_mass(count, m.pair_factor, after[at], kept[at])
    _, left = pair_mass(np.zeros(n, np.int64), m.pair_factor, after, kept)
    back = np.log10(left / np.maximum(1 - below, 1e-12))
    key = pair_keys(before, word)
    order = np.argsort(key)
    key, gain = key[order], (np.log10(mass) - low)[order]

    def answer(asked_before: np.ndarray, asked: np.ndarray) -> list[np.ndarray]:
        found, of = placed(key, pair_keys(asked_before, asked)), placed(history, asked_before)
        rank = np.where(asked_before < RARE, asked_before, np.uint64(0)).astype(np.int64)
        missed = np.where(asked_before < RARE, m.back[rank], np.where(of >= 0, back[np.maximum(of, 0)] if n else 0.0, 0.0))
        return [np.where(found >= 0, gain[np.maximum(found, 0)] if len(gain) else 0.0, missed)]

    return answer


def _word_answers(m: Model, table: pa.Table):
    """The words' own score, whether they are known, and their base score."""
    word = joined(unpacked(table.column("words"), np.uint64), np.uint64)
    count = joined(unpacked(table.column("counts"), np.int64), np.int64)
    order = np.argsort(word)
    word, count = word[order], count[order]

    def answer(_: np.ndarray, asked: np.ndarray) -> list[np.ndarray]:
        at = placed(word, asked)
        seen = np.where(at >= 0, count[np.maximum(at, 0)] if len(count) else 0, 0)
        return [m.single(seen), seen > 0, m.base(seen)]

    return answer


def _word_cells(shared):
    """Rows of words that are not hot to packed cells of their buckets."""

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            word, count = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            rare = placed(m.hot, word) < 0
            bucket = word_buckets(word[rare], m.bits)
            order = np.argsort(bucket, kind="stable")
            used, words_, counts = runs(bucket[order], word[rare][order], count[rare][order])
            none = pa.nulls(len(used), pa.binary())
            yield pa.RecordBatch.from_arrays([used, none, words_, counts, none], names=["bucket", "befores", "words", "counts", "owns"])

    return celled


def _assembled(table: pa.Table) -> pa.Table:
    """The texts of one piece with everything known about their tokens."""
    rows = table.filter(pc.is_valid(table.column("place"))).sort_by("place")
    cells = table.filter(pc.is_null(table.column("place")))
    n_known, base, score = (rows.column(c).to_numpy().copy() for c in ("n_known", "base", "score"))
    for owners, known, more_base, sums in zip(*[cells.column(c).to_pylist() for c in ANSWERED_NAMES[1:5]], strict=True):
        owner, = unpacked(pa.array([owners]), np.int32)
        score[owner] += unpacked(pa.array([sums]), np.float64)[0]
        if known:
            n_known[owner] += unpacked(pa.array([known]), np.int32)[0]
            base[owner] += unpacked(pa.array([more_base]), np.float64)[0]
    return pa.table([rows.column("doc_id"), rows.column("held_out"), rows.column("n_tokens"), pa.array(n_known), pa.array(base), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the model's log10 probability of the text, ``base_score`` that of single words with one
    added count. A null or empty text is one end. Rows that repeat an id are scored each. Other columns are
    not read. After a fit on an empty table all words are unknown. The buckets are those of the training
    tokens, so texts far larger than the training texts are better scored in parts.
    """
    id_type = dict(docs.dtypes)[id_col]
    flag = held_out if held_out is not None else F.lit(False)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(flag, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model.shared())
    numbers = f"place int, doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
    asked = texts.mapInArrow(_asked(shared, ASKED), f"piece bigint, bucket int, befores binary, words binary, owners binary, {numbers}")
    fields = f"{GRAMS}, owns binary"
    known = model.grams.unionByName(model.words.mapInArrow(_word_cells(shared), fields))
    answers = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
        _answered(shared), f"piece bigint, owners binary, known binary, more_base binary, sums binary, {numbers}"
    )
    found = answers.groupBy("piece").applyInArrow(_assembled, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("bigint").alias("train_tokens"), "base_score", "score")
