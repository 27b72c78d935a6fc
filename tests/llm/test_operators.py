"""Each operator against brute force on small texts, with nulls, repeats, ties, long texts and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from partylens.llm import chat, decontaminate, exact_dedup, jaccard, katz, mixing, quality, repeats, sharding, suffixes, toxicity

SPACE = "[\x20\x09-\x0D]+"
WORDS = "[^\x20\x09-\x0D]+"
PASSAGE = " ".join(f"word{i}" for i in range(60))
SHARED = "".join(chr(97 + c) for c in np.random.default_rng(1).integers(0, 26, 450))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def rows():
    out = [(1, PASSAGE), (2, PASSAGE.upper()), (3, PASSAGE.replace("word7 ", "other ")), (4, PASSAGE + " tail"), (4, PASSAGE + " tail")]
    out += [(5, None), (6, ""), (7, "one two"), (8, "One \t two"), (9, " \n "), (None, "one two"), (None, None)]
    out += [(10, "ab" * 400), (11, "é" * 99), (12, "é" * 100), (13, SHARED[:199]), (14, SHARED + "1" + SHARED[100:350])]
    out += [(15, "--" + SHARED[5:205] + "??" + SHARED[5:204] + "!"), (16, "x " * 30_000), (17, "x  " * 30_000)]
    out += [(20 + i, " ".join(f"a{j if j != i % 7 * 5 else 1000 + i}" for j in range(60))) for i in range(40)]
    out += [(100 + i, PASSAGE[:120] + " " + " ".join(f"own{i}_{j}" for j in range(80))) for i in range(12)]
    return out


CLASHING = "doc_id long, text string, score double, node long, shard int, size long, tokens long, component_id long, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, 1, 2, 3, 4, 5, None, f"src{k % 3}" if k % 4 else None) for k, (i, t) in enumerate(rows())], CLASHING).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASHING)


def sets():
    out = []
    for i, t in rows():
        w = re.findall(WORDS, lower(t or ""))
        out.append((i, {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    return out


@pytest.mark.parametrize(("crowd", "maps", "tile", "pivots"), [(1000, 4000, 1000, 8), (3, 12, 10, 2), (5, 4000, 1000, 8), (1000, 30, 10, 2)])
def test_near_duplicates(docs, monkeypatch, crowd, maps, tile, pivots):
    monkeypatch.setattr(jaccard, "MAPS", maps)
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    own = sets()
    root = list(range(len(own)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            both = len(own[a][1] & own[b][1])
            if both and 100 * both >= 75 * len(own[a][1] | own[b][1]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(list)
    for x, (i, _) in enumerate(own):
        least[find(x)].append(i)
    want = sorted(((i, len(s), min([y for y in least[find(x)] if y is not None], default=None)) for x, (i, s) in enumerate(own)), key=repr)
    assert sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=repr) == want


@pytest.mark.parametrize("described", ["prefix", "found"])
def test_buckets_are_even(described):
    """Prefixes and anchors are small hashes; the buckets that one task holds whole are as large as each other all the same."""
    rng = random.Random(3)
    texts = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": [" ".join(f"w{rng.randrange(10**6)}" for _ in range(400)) for _ in range(300)]})
    task = jaccard._sets if described == "prefix" else repeats._described(200)
    (batch,) = task(iter([texts]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), batch.column(batch.schema.get_field_index(described))], names=["node", described])
    got, held = defaultdict(set), []
    for out in jaccard._entries(described, 4)(iter([batch.slice(0, 100), batch.slice(100)])):
        for row in out.to_pylist():
            pairs = list(zip(np.frombuffer(row["hashes"], np.uint64).tolist(), np.frombuffer(row["nodes"], np.int64).tolist(), strict=True))
            got[row["bucket"]].update(h for h, _ in pairs)
            held += pairs
    want = [(h, node) for node, x in enumerate(batch.column(1).to_pylist()) for h in np.frombuffer(x, np.uint64).tolist()]
    assert sorted(held) == sorted(want)
    assert sum(map(len, got.values())) == len({h for h, _ in want})  # no hash in two buckets
    assert len(got) == 16 and max(map(len, got.values())) < 1.5 * len({h for h, _ in want}) / 16


def tiles_of(sets, crowd):
    """Nodes by tile of one bucket with all prefix entries of these sorted sets of hashes."""
    hashes = [jaccard.entries(x[:jaccard.prefix_length(len(x))], len(x)) for x in sets]
    table = pa.table({"hashes": [h.tobytes() for h in hashes], "nodes": [np.full(len(h), i, np.int64).tobytes() for i, h in enumerate(hashes)]})
    tiles = defaultdict(set)
    for row in jaccard._tiled(crowd)(table).to_pylist():
        tiles[row["tile"]].add(row["node"])
    return tiles


def test_tiles_leave_out_what_cannot_link():
    """Nodes with a common entry meet only where their sizes allow a link and it is in the first seventh of the smaller one."""
    rng = np.random.default_rng(5)
    low, high = 1 << 50, 1 << 60

    def made(first, n):
        return np.sort(np.concatenate([first, rng.integers(low, high, n - len(first), dtype=np.uint64)]))

    passage = rng.integers(1 << 20, low, 8, dtype=np.uint64)
    assert not tiles_of([made(passage, int(60 * 1.5 ** i)) for i in range(12)], 1000)  # too different in size
    late = np.array([high - 1], np.uint64)
    between = [np.sort(np.concatenate([late, rng.integers(low, high, 10, dtype=np.uint64), rng.integers(high, 2 * high, 49, dtype=np.uint64)])) for _ in range(12)]
    assert not tiles_of(between, 1000)  # the eleventh of 60, beyond the first nine
    assert dict(tiles_of([made(passage, 60 + i) for i in range(12)], 1000)) == {0: set(range(12))}


@pytest.mark.parametrize("crowd", [2, 1000])
def test_tiles_have_all_links(crowd):
    """Of sets around the threshold, every two that link are in a common tile."""
    rng = np.random.default_rng(6)
    sets, linked = [], 0
    for _ in range(60):
        core = np.unique(rng.integers(1 << 20, 1 << 63, rng.integers(1, 90), dtype=np.uint64))
        for _ in range(6):
            kept = rng.random(len(core)) >= rng.choice([0, 0.05, 0.15, 0.25])
            own = np.unique(np.concatenate([core[kept], rng.integers(1 << 20, 1 << 63, rng.integers(0, 1 + len(core) // 3), dtype=np.uint64)]))
            sets += [own] if len(own) else []
    tiles = list(tiles_of(sets, crowd).values())
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                linked += 1
                assert any({a, b} <= t for t in tiles)
    assert linked > 100


def test_exact_dedup(docs):
    groups = defaultdict(list)
    for i, t in rows():
        groups[re.sub(SPACE, " ", t or "")].append(i)
    want = []
    for t, ids in groups.items():
        keep = min([i for i in ids if i is not None], default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    for winners in (64, 1):
        got = exact_dedup.exact_dedup(docs, tracked=64, winners=winners).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeated_spans_go_by_row(spark, keep_first):
    """Ids that repeat with other texts, null ids, and equal texts under several ids or none."""
    rng = random.Random(6)
    s, u, v, w = ("".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(4))
    data = [(1, s + u), (1, v), (2, s + "xxx"), (None, w), (None, "y" + w), (None, s), (3, v), (None, v), (4, None), (4, ""), (1, v), (None, None), (5, u[:199]), (5, u[:200])]
    order = sorted(range(len(data)), key=lambda x: (data[x][0] is None, data[x][0] or 0, hashlib.sha256((data[x][1] or "").encode()).hexdigest(), x))
    # Equal texts are one text, at its lowest id.
    seen = defaultdict(list)
    for x in order:
        raw = (data[x][1] or "").encode()
        for p in range(len(raw) - 199):
            seen[raw[p:p + 200]].append((x, p))
    want = []
    for x, (i, t) in enumerate(data):
        raw, hit = (t or "").encode(), np.zeros(len(t or "") + 1, bool)
        for p in range(len(raw) - 199):
            where = seen[raw[p:p + 200]]
            if (where[0] != (x, p)) if keep_first else len(where) > 1:
                hit[p:p + 200] = True
        ends = np.flatnonzero(np.diff(np.concatenate([[False], hit[:len(raw)], [False]]).astype(int))).tolist()
        want.append((i, len(raw), ends, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~hit[:len(raw)]])).hexdigest()))
    some = spark.createDataFrame(data, "doc_id long, text string").withColumn("node", F.lit(1)).repartition(3)
    got = [(r[0], r[1], list(r[2]), r[3]) for r in repeats.repeated_spans(some, keep_first=keep_first).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeated_spans(docs, keep_first):
    plain = [(i, t) for i, t in rows() if i is not None and i not in (16, 17)]
    texts = sorted(plain, key=lambda x: x[0])
    seen = defaultdict(list)
    for x, (_, t) in enumerate(texts):
        raw = (t or "").encode()
        for s in range(len(raw) - 199):
            seen[raw[s:s + 200]].append((x, s))
    want = []
    for x, (i, t) in enumerate(texts):
        raw, hit = (t or "").encode(), np.zeros(len((t or "").encode()) + 1, bool)
        for s in range(len(raw) - 199):
            where = seen[raw[s:s + 200]]
            if (where[0] != (x, s)) if keep_first else len(where) > 1:
                hit[s:s + 200] = True
        ends = np.flatnonzero(np.diff(np.concatenate([[False], hit[:len(raw)], [False]]).astype(int))).tolist()
        want.append((i, len(raw), ends, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~hit[:len(raw)]])).hexdigest()))
    some = docs.where(F.col("doc_id").isNotNull() & ~F.col("doc_id").isin(16, 17))
    got = [(r[0], r[1], list(r[2]), r[3]) for r in repeats.repeated_spans(some, keep_first=keep_first).collect()]
    assert sorted(got) == sorted(want)


def test_repeats_of_long_texts(docs):
    got = {r["doc_id"]: r for r in repeats.repeated_spans(docs, keep_first=False).where(F.col("doc_id").isin(16, 17)).collect()}
    assert list(got[16]["removed"]) == [0, 60_000] and list(got[17]["removed"]) == [0, 90_000]


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 30, 300):
        s = rng.integers(1, 3, n)
        order, levels = suffixes.suffix_array(s)
        tails = [tuple(s[i:]) for i in range(n)]
        assert order.tolist() == sorted(range(n), key=lambda i: tails[i])
        lcp = np.zeros(n, np.int64)
        if n > 1:
            lcp[1:] = suffixes.common_prefix(levels, order[1:], order[:-1])

        def same(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

        factors = suffixes.previous_factors(order, lcp, order)
        assert all(factors[i] == max((same(tails[order[i]], tails[j]) for j in range(order[i])), default=0) for i in range(n))


@pytest.mark.parametrize("block", [32 << 20, 200])
def test_contamination(spark, docs, block):
    items = [(1, " ".join(f"word{i}" for i in range(20, 40))), (2, "ONE two"), (3, None), (4, "?!"), (5, " ".join(f"a{i}" for i in range(40, 52))), (None, "word1"), (6, "nowhere to be found")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pattern = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for i, t in items:
        w = re.findall(pattern, lower(t or ""))
        for k in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[k:k + 10])].add("" if i is None else str(i))
    want = []
    for i, t in rows():
        w, hit, found = re.findall(pattern, lower(t or "")), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if tuple(w[k:k + n]) in windows and k + n <= len(w):
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        want.append((i, len(w), len(hit), sorted(found)))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in decontaminate.contamination(docs, bench, block=block).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    longest = {r["doc_id"]: r["longest"] for r in decontaminate.contamination(docs, bench, block=block).collect()}
    assert longest[1] == 20


@pytest.mark.parametrize("hot", [katz.HOT, 20, 0])
def test_katz(docs, hot):
    held = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == 2
    model = katz.fit(docs.where(~held), hot=hot)
    got = katz.score(docs, model, held_out=held).collect()
    said = [(i, [*re.findall(WORDS, lower(t or "")), None]) for i, t in rows()]
    count = Counter(w for i, ws in said if (i or 0) % 3 != 2 for w in ws)
    total, distinct = sum(count.values()), len(count)
    assert (model.total, model.distinct) == (total, distinct)
    want = sorted((str(i), len(ws), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in ws), 5)) for i, ws in said)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5)) for r in got) == want
    counts = np.array(sorted(count.values()))
    assert (10.0 ** model.single(counts)).sum() + model.unseen == pytest.approx(1)


def test_katz_without_rare_words(spark):
    """Where no word is rare, the unknown word takes one count from all, frequent ones too."""
    model = katz.fit(spark.createDataFrame([("a b " * 20,)], "text string").unionAll(spark.createDataFrame([(None,)] * 9, "text string")))
    assert (10.0 ** model.single(np.array([20, 20, 10]))).sum() + 10.0 ** model.single(np.array([0]))[0] == pytest.approx(1)


def test_packed_arrays():
    for x in (np.zeros(0, np.uint64), np.array([5, 1 << 63, 0], np.uint64), np.array([-1.5, 2.0**90, 0.0]), np.arange(-9, 99, dtype=np.int32)):
        back, = katz.unpacked(pa.array([katz.pack(x)]), x.dtype.type)
        assert back.dtype == x.dtype and back.tolist() == x.tolist()


def katz_by_hand(said, held):
    """Scores of lists of words by plain Katz of order two with Good-Turing discounts."""
    single, pair, after = Counter(), Counter(), Counter()
    for i, ws in said:
        if not held(i):
            single.update(ws)
            pair.update(zip([0, *ws], ws))  # noqa: B905
            after.update([0, *ws[:-1]])

    def factors(counts):
        return katz.discounts(Counter(counts.values())).tolist()

    def cut(n, factor):
        return n * (factor[n] if n < len(factor) else 1.0)

    one, two, total = factors(single), factors(pair), sum(single.values())
    lost = sum(n - cut(n, one) for n in single.values())
    assert lost > 0
    p1 = defaultdict(lambda: lost / total, {w: cut(n, one) / total for w, n in single.items()})
    kept, below = Counter(), Counter()
    for (h, w), n in pair.items():
        kept[h] += cut(n, two)
        below[h] += p1[w]

    def p(h, w):
        if h not in after:
            return p1[w]
        bare = 1 - kept[h] / after[h] <= 1e-9
        left = 1 / (after[h] + 1) if bare else 1 - kept[h] / after[h]
        if (h, w) in pair:
            return cut(pair[h, w], two) / (after[h] + bare)
        return left / (1 - below[h]) * p1[w]

    for h in after:
        assert sum(p(h, w) for w in single) + p(h, 1) == pytest.approx(1)
    return [(i, sum(math.log10(p(h, w)) for h, w in zip([0, *ws], ws))) for i, ws in said]  # noqa: B905


@pytest.mark.parametrize(("hot", "usual", "bucket"), [(katz.HOT, katz.USUAL, katz.BUCKET), (katz.HOT, 0, 100), (20, 30, 100), (3, 0, 500), (0, 0, katz.BUCKET)])
def test_katz_scores_every_pair(spark, docs, monkeypatch, hot, usual, bucket):
    """The scores are plain Katz, whatever is known to every task and however the counts are dealt."""
    monkeypatch.setattr(katz, "USUAL", usual)
    monkeypatch.setattr(katz, "BUCKET", bucket)
    if bucket < katz.HOT:
        monkeypatch.setattr(katz, "GATHERED", 3000)
        monkeypatch.setattr(katz, "ASKED", 1500)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    more = spark.createDataFrame([(300 + i, f"rare{i // 3} pair{i // 3} the w{i % 5}") for i in range(30)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    held = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == 2
    said = [(i, [*re.findall(WORDS, lower(t or "")), None]) for i, t in [(r["doc_id"], r["text"]) for r in every.collect()]]
    want = sorted((str(i), x) for i, x in katz_by_hand(said, lambda i: (i or 0) % 3 == 2))
    try:
        got = sorted((str(r["doc_id"]), r["score"]) for r in katz.score(every, katz.fit(every.where(~held), hot=hot), held_out=held).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [i for i, _ in want] == [i for i, _ in got]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=1e-9)


def test_rendezvous(docs):
    weights, grown = [1.0, 2.0, 0.0, 1.0], [1.0, 2.0, 0.0, 1.0, 1.5]
    got = sharding.shard_rows(docs, weights, grown=grown, carry=docs.columns).collect()

    def best(key, ws):
        def score(i):
            seed = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), 42) if key is not None else 42
            bits = xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed) >> 11
            return ws[i] / -math.log((bits + 0.5) / (1 << 53))

        return max((i for i in range(len(ws)) if ws[i]), key=score)

    assert len(got) == len(rows())
    for r in got:
        assert r["shard"] == best(r["doc_id"], weights) and r["grown_shard"] == best(r["doc_id"], grown)
        assert r["grown_shard"] in (r["shard"], 4)
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def poured(budget, children):
    """(weight, capacity) of siblings to shares, by repeated rounds."""
    given, open_ = [0.0] * len(children), set(range(len(children)))
    while open_ and budget > 1e-9:
        unit = budget / sum(children[i][0] for i in open_)
        full = {i for i in open_ if given[i] + unit * children[i][0] >= children[i][1] - 1e-9}
        for i in full or open_:
            more = min(unit * children[i][0], children[i][1] - given[i]) if not full else children[i][1] - given[i]
            given[i] += more
            budget -= more
        open_ = open_ - full if full else set()
    return given


@pytest.mark.parametrize(("budget", "epochs"), [(0.4, 1), (1.0, 1), (1.5, 2), (9.0, 3)])
def test_mixing(spark, budget, epochs):
    data = [(i, f"d{i % 7 // 4}", ("en", "fr", None)[i % 3], f"s{i % 2}", "w " * (i % 5 + (30 if i % 7 == 0 else 0))) for i in range(300)]
    table = spark.createDataFrame(data, "doc_id long, domain string, lang string, source string, text string")
    weights = spark.createDataFrame([(mixing.node_name("d0"), 3.0), (mixing.node_name("d1", "en"), 2.0)], "node string, weight double")
    levels = {c: F.col(c) for c in ("domain", "lang", "source")}
    got = mixing.mixed(table, levels, weights, budget, epochs).collect()
    supply, used, largest = Counter(), Counter(), Counter()
    for r in got:
        supply[r["leaf"]] += r["tokens"]
        used[r["leaf"]] += r["tokens"] * r["copies"]
        largest[r["leaf"]] = max(largest[r["leaf"]], r["tokens"])
        assert 0 <= r["copies"] <= epochs
    assert len(got) == len(data) and sum(supply.values()) == sum(len(x[4].split()) for x in data)
    weight = {"=d0": 3.0, "=d1/=en": 2.0}
    share = {"": min(budget, epochs) * sum(supply.values())}
    for depth in (1, 2, 3):
        below = defaultdict(dict)
        for leaf, n in supply.items():
            path = leaf.split("/")
            name, parent = "/".join(path[:depth]), "/".join(path[:depth - 1])
            below[parent][name] = below[parent].get(name, 0) + epochs * n
        new = {}
        for parent, nodes in below.items():
            names = sorted(nodes)
            new |= dict(zip(names, poured(share[parent], [(weight.get(n, 1.0), nodes[n]) for n in names]), strict=True))
        share = new
    for leaf in supply:
        assert share[leaf] - 1e-3 <= used[leaf] <= share[leaf] + largest[leaf] + 1e-3


@pytest.mark.parametrize(("budget", "copies"), [(0.3, 1), (0.55, 1), (0.8, 40), (1.3, 7)])
def test_mixing_carries_columns_without_moving_them(spark, capsys, budget, copies):
    """The same rows are used with carried columns as without, of rows equal in id and text the same number; texts take part in no shuffle."""
    data = [(i // copies if i % 9 else None, f"s{i % 2}", "w " * (1 + i // copies % 5), i) for i in range(200)]
    table = spark.createDataFrame(data, "doc_id long, source string, text string, nth long")
    levels = {"source": F.col("source")}
    plain = mixing.mixed(table, levels, None, budget, 2, "x").collect()
    made = mixing.mixed(table, levels, None, budget, 2, "x", carry=["text", "nth", "doc_id"])
    got = made.collect()
    assert sorted(map(tuple, plain), key=repr) == sorted((tuple(r)[:4] for r in got), key=repr)
    assert sorted(r["_carried_nth"] for r in got) == list(range(200))
    assert all(data[r["_carried_nth"]][0] == r["doc_id"] and data[r["_carried_nth"]][2] == r["_carried_text"] for r in got)
    if copies == 1:
        unlike = mixing.mixed(table.where("doc_id is not null"), levels, None, budget, 2, "x", carry=["text"])
        capsys.readouterr()
        unlike.explain()
        assert "hashpartitioning" not in capsys.readouterr().out


def test_mixing_keeps_leaves_without_words(spark):
    """They cost no tokens: all epochs, but none where the leaf has no weight."""
    table = spark.createDataFrame([(1, "a", "one two"), (2, "b", ""), (3, "b", None), (None, "b", " "), (4, "c", "")], "doc_id long, source string, text string")
    weights = spark.createDataFrame([(mixing.node_name("c"), 0.0)], "node string, weight double")
    got = mixing.mixed(table, {"source": F.col("source")}, weights, budget=2.0, epochs=2).collect()
    assert sorted(((r["doc_id"], r["copies"]) for r in got), key=repr) == [(1, 2), (2, 2), (3, 2), (4, 0), (None, 2)]


def test_chat_round_trip(spark):
    part = "type string, text string, ref string, units long"
    nasty = "<|im_end|>\n<|im_start|>assistant <\\|x <\\\\|y <image|> <|image|>"
    turns = [
        (1, 1, "assistant", [("text", nasty, None, None), ("image", None, "a.png", 3), ("text", "then", None, None)]), (1, 0, "us<|er\n<n|", [("document", None, "b.pdf", None)]),
        (2, 0, None, None), (2, 1, "assistant", []), (None, 0, "assistant", [("text", None, None, None), None]), (3, 0, "assistant", [("audio", None, "c.wav", 2), ("video", "kept", None, None)]), (3, 0, "assistant", [("text", "tie", None, None)]),
    ]
    table = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts array<struct<{part.replace(' ', ':').replace(',:', ',')}>>")
    chats = {r["conv_id"]: r for r in chat.format_chats(table).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()}
    assert [tuple(t) for t in chats[1]["turns"]] == [("us<|er\n<n|", "<|document|>"), ("assistant", nasty.replace("<\\|x", "<\\|x") + "<|image|>then")] or chats[1]["turns"][0]["role"] == "us<|er\n<n|"
    assert [(a["place"], a["turn"], a["kind"], a["ref"], a["tokens"]) for a in chats[1]["attachments"]] == [(0, 0, "document", "b.pdf", 512), (1, 1, "image", "a.png", 768)]
    assert chats[1]["expanded_tokens"] == 1280 and chats[3]["expanded_tokens"] == 100
    assert [tuple(t) for t in chats[2]["turns"]] == [("", ""), ("assistant", "")]
    assert len(chats[3]["turns"]) == 2 and len(chats[None]["turns"]) == 1
    assert "".join(s["text"] for s in chats[1]["segments"]) == chats[1]["formatted"]
    texts = spark.createDataFrame([(9, 0, "assistant", nasty)], "conv_id long, turn long, role string, text string")
    d = chat.chat_digest(chat.format_chats(texts.withColumn("parts", chat.text_part(F.col("text"))))).first()
    assert d["loss_sha256"] == hashlib.sha256(nasty.encode()).hexdigest() and d["loss_chars"] == len(nasty)
    assert d["turns_sha256"] == hashlib.sha256(f"assistant\n{nasty}\n".encode()).hexdigest()


def test_classifiers_take_any_row(spark, docs):
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0)) for i in range(1, 60)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    for scored in (quality.score(docs, quality.fit(docs, labels, "quality")), toxicity.score(docs, toxicity.fit(docs, labels))):
        got = scored.collect()
        assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
        assert Counter(r["text"] for r in got) == Counter(t for _, t in rows())


def test_toxicity_learns_from_all_rows(spark):
    """A small sample for the descent hides no expression: most toxic terms are in none of the sample's few rows."""
    rng = np.random.default_rng(5)
    plain = [f"common{i}" for i in range(300)]
    data = []
    for i in range(2400):
        text = " ".join(rng.choice(plain, 12))
        data.append((i, f"{text} vile{i % 60:02d}zz" if i % 8 == 0 else text, int(i % 8 == 0)))
    every = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    weight, bias = toxicity.fit(every.select("doc_id", "text"), every.select("doc_id", "toxic"), sample=40)
    score = {r["doc_id"]: r["score"] for r in toxicity.score(every, (weight, bias)).collect()}
    assert all((score[i] >= 0.5) == bool(toxic) for i, _, toxic in data)


def test_toxicity_merges_equal_texts_only(spark):
    """Texts with a long common passage stay, toxic and clean; a text that is repeated with one label counts once."""
    data = [(i, f"{PASSAGE} own{i // 2}", int(i % 4 < 2)) for i in range(40)] + [(50 + i, "", i % 2) for i in range(6)]
    every = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    found = toxicity.labelled(every.select("doc_id", "text"), every.select("doc_id", "toxic"), "toxic", "doc_id", "text").collect()
    assert sorted((r["text"], r["label"]) for r in found) == sorted({(t, x) for _, t, x in data})


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    turns = spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    levels = {"source": F.col("source")}
    for result in (
        quality.score(empty, quality.fit(empty, labels, "quality")), toxicity.score(empty, toxicity.fit(empty, labels)), jaccard.near_duplicates(empty),
        sharding.shard_rows(empty, [1.0]), exact_dedup.exact_dedup(empty), repeats.repeated_spans(empty), mixing.mixed(empty, levels),
        decontaminate.contamination(empty, bench), katz.score(empty, katz.fit(empty)), chat.format_chats(turns),
    ):
        assert result.count() == 0
