"""Fingerprints, packing, token files, mixing, the quality model, languages and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from framelens.llm import language_id, quality_model
from framelens.llm.common import stored
from framelens.llm.fingerprints import EXACT, PART, SKETCH, add, digest, edited_fingerprints, fingerprint_texts, likeness, subtract
from framelens.llm.mixing import mix, mixing_plan, solve_exponent
from framelens.llm.packing import best_fill, pack_documents
from framelens.llm.queries import QUERIES, tokenizer_path
from framelens.llm.token_files import PerfectHash, ShardIndex, build_index, key_hash, open_document, read_token_files, write_token_files
from framelens.llm.tokens import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


# Encoding

LETTERS = [*"abcXYZ 019  \n\t.,'!?éßñ–—’“日本कि😀  ́ªº½²ǅ", "'s", " 'll", "<|endoftext|>", "\r\n", " \n", "\x85", "\x1c", "İ", "ſ", "ⅷ", "٣"]


def test_pieces_give_the_ids_of_the_whole():
    encoder, rng = PieceEncoder(PATH, max_pieces=500), random.Random(3)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 16))) for _ in range(6000)]
    for text in texts:
        assert encoder.encode(text) == ids_of(text)[:-1].tobytes(), repr(text)


# Packing


def test_best_fill_against_all_subsets():
    rng = random.Random(5)
    for _ in range(150):
        items = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
        room = rng.randint(0, 80)
        totals = {0}
        for x in items:
            totals |= {t + x for t in totals}
        taken = best_fill(dict(Counter(items)), room)
        assert all(n <= Counter(items)[x] for x, n in taken.items())
        assert sum(x * n for x, n in taken.items()) == max(t for t in totals if t <= room)


def check_packing(df, rows, capacity=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    texts = defaultdict(list)
    for r in df.collect():
        texts[r.doc_id].append(r.text)
    for doc, own in texts.items():
        want = Counter()
        ids = ids_of(own[0])
        for r in by_doc[doc]:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids)
            want.update(range(r.start, r.start + r.length))
        assert want == {i: len(own) for i in range(len(ids))}
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
        padding += capacity - at
    return padding


def test_packing_round_trip(odd, sample, none):
    for df in (odd.select("doc_id", "text"), sample.select("doc_id", "text")):
        assert check_packing(df, pack_documents(df, PATH).collect()) < 1024 * df.rdd.getNumPartitions()
    assert "start" in pack_documents(odd, PATH).columns
    assert pack_documents(none, PATH).count() == 0


def test_packing_small_windows(sample):
    df = sample.select("doc_id", "text").limit(20)
    rows = pack_documents(df, PATH, capacity=64, pool_high=8, pool_low=2).collect()
    assert check_packing(df, rows, 64) < 64 * df.rdd.getNumPartitions()


# Token files


def test_token_files_round_trip(spark, odd, sample):
    for df in (sample, odd):
        manifest = write_token_files(df, PATH)
        got = sorted(read_token_files(manifest).collect(), key=lambda r: r.start)
        want = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in df.select("doc_id", "text").collect())
        assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [k for k, _ in want]
        start = 0
        for r, (_, text) in zip(got, want):
            ids = ids_of(text)
            assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
            start += len(ids)
    assert (open_document(manifest, 8, 1) == ids_of(next(r.text for r in odd.collect() if r.doc_id == 8))).all()
    assert open_document(manifest, 8, 2) is None and open_document(manifest, 4) is None


def test_every_row_of_a_hot_id_can_be_opened(spark):
    """Rows of one id, some of them equal, over all shards; a null id beside the smallest integer."""
    rows = [(7, f"text number {i % 25}") for i in range(40)] + [(None, "unknown one"), (None, "unknown two"), (-(2**63), "smallest"), (9, "last"), (3, "few"), (3, "few")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    manifest = write_token_files(df, PATH, shards=4)
    assert manifest.where("first_id = 7 or last_id = 7").count() > 2
    table = read_token_files(manifest).collect()
    assert len({(r.doc_id, r.occurrence) for r in table}) == len(rows) == len(table)
    assert sorted(r.start for r in table) == np.r_[0, np.cumsum([r.n_tokens for r in sorted(table, key=lambda r: r.start)])[:-1]].tolist()
    for doc in (7, None, -(2**63), 9, 3):
        own = [t for i, t in rows if i == doc]
        opened = [open_document(manifest, doc, n) for n in range(len(own))]
        assert Counter(x.tobytes() for x in opened) == Counter(ids_of(t).tobytes() for t in own)
        assert [zlib.crc32(x.tobytes()) for x in opened] == [r.ids_crc32 for r in sorted(table, key=lambda r: r.occurrence) if r.doc_id == doc]
        assert open_document(manifest, doc, len(own)) is None
    assert open_document(manifest, 8) is None and open_document(manifest, -5) is None


class Counted:
    """A file that counts the bytes read of it."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def read_at(self, n, at):
        self.read += n
        assert at + n <= len(self.data)
        return self.data[at : at + n]


@pytest.mark.parametrize("n", [1, 63, 5000, 200_000])
def test_a_lookup_reads_a_bounded_part_of_the_index(n):
    ids = np.random.default_rng(n).permutation(np.arange(n) * 3 - n)
    counts = np.arange(n) % 7 + 1
    offsets = np.cumsum(counts) - counts
    data = build_index(ids, np.ones(n, bool), np.zeros(n, np.int64), offsets, counts)
    keys, found_at, found = ShardIndex(Counted(data)).everything()
    assert (keys["id"] == ids).all() and (found_at == offsets).all() and (found == counts).all()
    most = 0
    for i in range(0, n, max(1, n // 300)):
        file = Counted(data)
        assert ShardIndex(file).find(int(ids[i]), True, 0) == (offsets[i], counts[i])
        most = max(most, file.read)
        assert ShardIndex(Counted(data)).find(int(ids[i]) + 1, True, 0) is None
        assert ShardIndex(Counted(data)).find(int(ids[i]), False, 0) is None and ShardIndex(Counted(data)).find(int(ids[i]), True, 1) is None
    assert most < 3000


def test_keys_of_equal_hashes_get_another_seed():
    """Two keys made to collide under the first seed."""
    from framelens.llm.token_files import _mix

    rows = np.array([1, 3], np.uint64)
    mixed = _mix(rows, 100)
    ids = np.array([5, 5 ^ int(mixed[0]) ^ int(mixed[1])], np.uint64).view(np.int64)
    occurrence, known = np.array([0, 1]), np.array([True, True])
    assert len(set(key_hash(ids, known, occurrence).tolist())) == 1
    index = ShardIndex(Counted(build_index(ids, known, occurrence, np.array([0, 4]), np.array([4, 2]))))
    assert index.seed > 0 and index.find(int(ids[0]), True, 0) == (0, 4) and index.find(int(ids[1]), True, 1) == (4, 2)


def test_no_documents_no_files(none):
    manifest = write_token_files(none, PATH)
    assert manifest.count() == 0 and read_token_files(manifest).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    values = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
    slots = PerfectHash.build(values).slots(values)
    assert sorted(slots.tolist()) == list(range(len(values)))


# Fingerprints


def test_edited_texts_and_equal_fingerprints(odd, sample, none):
    for df in (odd, sample):
        rows = edited_fingerprints(df).withColumn("f", digest(F.col("lanes"))).collect()
        keyed = {((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in df.select("doc_id", "text").collect()}
        order = sorted(keyed, reverse=True)
        after = dict(zip(order, order[1:] + order[:1]))
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            key = ((r.doc_id is not None, r.doc_id or 0), r.text or "")
            k = len(key[1]) // 3
            edited = key[1][: len(key[1]) - k] + after[key][1][:k]
            want[r.doc_id, len(key[1]), hashlib.sha256(edited.encode()).hexdigest()] += 1
        assert Counter((r.doc_id, r.n_chars, r.edited_text_sha256) for r in rows) == want
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
        texts = {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}
        assert len({(texts[r.doc_id], r.f) for r in rows}) == len({r.f for r in rows}) == len(set(texts.values()))
    assert edited_fingerprints(none).count() == 0


def brute_vector(text):
    """The lanes of a text from the hashes of its parts, with sums of any size."""
    parts = [p for p in re.findall(PART, text, re.A) if p]
    assert "".join(parts) == text

    def hashed(part, seed):
        return xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), xxhash.xxh64_intdigest(part.encode(), 42))

    exact, sketch = [], []
    for seed in range(EXACT // 2):
        both = [hashed(p, seed) for p in parts]
        exact += [sum(h & 0xFFFFFFFF for h in both), sum(h >> 32 for h in both)]
    for seed in range(SKETCH // 64):
        both = [hashed(p, 1000 + seed) for p in parts]
        sketch += [sum(h >> b & 1 for h in both) for j in range(32) for b in (j, j + 32)]
    return [x % (1 << 32) for x in (len(parts), *exact, *sketch)]


def brute_likeness(a, b):
    x, y = (np.array([2 * s - v[0] for s in v[1 + EXACT :]], float) for v in (a, b))
    own = (x * x + y * y).sum()
    return float(a[0] == b[0]) if not own else max(0.0, 2 * (x * y).sum() / own)


def test_lanes_and_likeness_against_brute_force(odd, sample):
    for df in (odd, sample.limit(60)):
        keyed = {((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in df.select("doc_id", "text").collect()}
        order = sorted(keyed, reverse=True)
        after = dict(zip(order, order[1:] + order[:1]))
        vector = {text: brute_vector(text) for _, text in keyed}
        want = defaultdict(list)
        for key in order:
            text, lent = key[1], after[key][1]
            edited = text[: len(text) - len(text) // 3] + lent[: len(text) // 3]
            want[key[0]].append((vector[text], brute_vector(edited), vector[lent]))
        for r in edited_fingerprints(df).collect():
            own, new, following = next(w for w in want[r.doc_id is not None, r.doc_id or 0] if w[0] == r.lanes)
            assert r.edited_lanes == new
            assert r.near_edited == pytest.approx(brute_likeness(own, new)) and r.near_next == pytest.approx(brute_likeness(own, following))


def test_many_repeats_of_a_part(spark):
    """Sums beyond 16 bits: neither the count nor a lane wraps, and likeness stays true."""
    block = "a b c d e\n"
    rows = [(0, ""), (1, block * 65_536), (2, block * 40_000), (3, "x\n" + block * 65_536), (4, "x\n")]
    v = {r.k: r.lanes for r in fingerprint_texts(spark.createDataFrame(rows, "k long, text string"), ["k"]).collect()}
    assert v[1][0] == 65_536 and v[1] != v[0] and v[3] != v[4] and len({tuple(x) for x in v.values()}) == 5
    assert v[1] == [x * 65_536 % (1 << 32) for x in brute_vector(block)]
    near = edited_fingerprints(spark.createDataFrame([(1, block * 40_000), (2, "q " * 10)], "doc_id long, text string")).where("doc_id = 1").first().near_edited
    assert 0.85 < near < 1


def vectors(spark, texts):
    return fingerprint_texts(spark.createDataFrame(list(texts.items()), "k string, text string"), ["k"])


def test_fingerprints_add_and_subtract(spark):
    parts = {"a": "first part.\n", "b": "second part of it.\n", "ab": "first part.\nsecond part of it.\n", "ba": "second part of it.\nfirst part.\n", "empty": ""}
    v = {r.k: r.lanes for r in vectors(spark, parts).collect()}
    assert v["ab"] == v["ba"] != v["a"]
    lanes = lambda k: F.array(*[F.lit(x) for x in v[k]])
    row = spark.range(1).select(add(lanes("a"), lanes("b")).alias("sum"), subtract(lanes("ab"), lanes("b")).alias("rest"), subtract(lanes("a"), lanes("a")).alias("gone"), likeness(lanes("empty"), lanes("empty")).alias("one"), likeness(lanes("empty"), lanes("a")).alias("zero")).first()
    assert row["sum"] == v["ab"] and row.rest == v["a"] and row.gone == v["empty"] and (row.one, row.zero) == (1.0, 0.0)


def test_likeness_follows_the_shared_parts(spark):
    lines = [f"line number {i} says {i * 7919 % 1000}\n" for i in range(200)]
    v = {r.k: r.lanes for r in vectors(spark, {"all": "".join(lines), "most": "".join(lines[:150] + [f"new {i}\n" for i in range(50)]), "other": "".join(f"far {i}\n" for i in range(200))}).collect()}
    lanes = lambda k: F.array(*[F.lit(x) for x in v[k]])
    near, far = spark.range(1).select(likeness(lanes("all"), lanes("most")), likeness(lanes("all"), lanes("other"))).first()
    assert abs(near - 0.75) < 0.2 and far < 0.3


# Mixing


def test_exponent_meets_the_targets(spark):
    shares = spark.createDataFrame([("a", 0.7), ("b", 0.2), ("c", 0.1)], "source string, share double")

    def entropy(x):
        w = np.array([0.7, 0.2, 0.1]) ** x
        w /= w.sum()
        return float(-(w * np.log(w)).sum())

    assert entropy(solve_exponent(shares, target_entropy=1.0)) == pytest.approx(1.0, abs=1e-6)
    x = solve_exponent(shares, max_repeats=2.0)
    assert (0.1 / 0.7) ** (x - 1) == pytest.approx(2.0, abs=1e-6)
    assert solve_exponent(shares, max_repeats=100.0) == 0.0
    assert solve_exponent(shares, target_entropy=0.1) == 1.0
    assert solve_exponent(shares.limit(0), max_repeats=2.0) == 1.0


def test_mix_meets_its_budgets(spark):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randint(1, 400), s) for i, s in enumerate(["big"] * 600 + ["mid"] * 150 + ["small"] * 40 + [None] * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix", F.lit(1))
    plan = mixing_plan(df, max_repeats=3.0, block_tokens=500)
    out = mix(df, plan)
    assert out.columns == ["doc_id", "text", "source", "mix"]
    got = {r.source: r for r in out.groupBy("source").agg(F.sum("mix.tokens").alias("t"), F.count_distinct("doc_id").alias("n"), F.max("mix.epoch").alias("e")).collect()}
    for p in plan.collect():
        g = got[p.source]
        assert g.n == Counter(r[2] for r in rows)[p.source]
        assert p.repeats * p.tokens - 102 <= g.t <= p.repeats * p.tokens + 1
        assert 1 - 1e-9 <= p.repeats <= 3.0 + 1e-6 and g.e < 3
    assert sum(p.weight for p in plan.collect()) == pytest.approx(1)


@pytest.mark.parametrize("limits", [{"max_repeats": 2.5}, {"max_repeats": None, "budget_tokens": 9000}, {"target_entropy": 1.0, "max_repeats": None}])
def test_mix_against_brute_force(spark, limits):
    """Weights, copies, blocks and the cut of every source, from the hashes of its rows alone."""
    rng = random.Random(16)
    rows = [(i, "y" * rng.randint(0, 300), s) for i, s in enumerate(["big"] * 300 + ["mid"] * 90 + ["small"] * 25 + [None] * 12)] + [(7, "twice", "mid")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {p.source: p for p in mixing_plan(df, block_tokens=400, seed=5, **limits).collect()}
    got = Counter((r.doc_id, r.source, r.mix.epoch, r.mix.block) for r in mix(df, mixing_plan(df, block_tokens=400, seed=5, **limits), seed=5).collect())
    tokens = defaultdict(int)
    for _, text, source in rows:
        tokens[source] += -(-len(text) // 4) + 1
    total = sum(tokens.values())
    exponent = plan["big"].exponent
    weight = {s: (n / total) ** exponent for s, n in tokens.items()}
    weight = {s: w / sum(weight.values()) for s, w in weight.items()}
    budget = limits.get("budget_tokens") or max(tokens[s] / weight[s] for s in tokens)
    if limits.get("target_entropy"):
        assert -sum(w * math.log(w) for w in weight.values()) <= 1.0 + 1e-6
    hashed = df.select("doc_id", "source", F.xxhash64("doc_id", "text", F.lit(5)).alias("h"), "text")
    want, places = Counter(), defaultdict(list)
    blocks = {s: max(1, -(-n // 400)) for s, n in tokens.items()}
    count = F.coalesce(*[F.when(F.col("source").eqNullSafe(F.lit(s)), n) for s, n in blocks.items()])
    ordered = hashed.withColumn("block", F.pmod("h", count.cast("long"))).withColumn("o", F.xxhash64("source", "block", F.lit(5)))
    for r in ordered.collect():
        places[r.source].append((r.o, r.h, r.doc_id, r.block, -(-len(r.text) // 4) + 1))
    for source, own in places.items():
        assert plan[source].tokens == tokens[source] and plan[source].weight == pytest.approx(weight[source]) and plan[source].blocks == blocks[source]
        repeats = budget * weight[source] / tokens[source]
        whole, taken, cut = int(repeats + 1e-9), 0, None
        rest = max(0.0, (repeats - whole) * tokens[source])
        for o, h, *_, n in sorted(own):
            taken += n
            if taken <= rest + 1e-6:
                cut = (o, h)
        for o, h, doc, block, _ in own:
            for epoch in range(whole + (cut is not None and (o, h) <= cut)):
                want[doc, source, epoch, block] += 1
    assert got == want


def test_mix_with_a_small_budget_and_edge_cases(odd, none):
    plan = mixing_plan(odd, max_repeats=None, budget_tokens=2000)
    assert mix(odd, plan).agg(F.sum("mix.tokens")).first()[0] <= 2000
    whole = mix(odd, mixing_plan(odd))
    assert {r.doc_id for r in whole.select("doc_id").collect()} == {r.doc_id for r in odd.select("doc_id").collect()}
    assert mix(none, mixing_plan(none)).count() == 0


# Quality model


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.fit(x[:3000], y[:3000], n_pairs=2)
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    assert quality_model.fit(x[:0], y[:0]).score(x).std() == 0
    assert quality_model.fit(x, np.ones(len(x))).score(x).min() > 0.9


def test_scores_are_sums_of_table_entries():
    """Features from their definitions, and a score from one entry of each table."""
    text = "The QUICK brown fox! fox | 12\nthe quick, brown FOX extraordinarily é\nThe QUICK brown fox! fox | 12"
    got = dict(zip(quality_model.FEATURES, quality_model.features(text)))
    words, data = text.split(), text.encode()
    pairs = list(zip(words, words[1:]))
    want = {"log_words": math.log1p(len(words)), "mean_word": len(data) / len(words), "pipe_words": 2 / len(words), "bang_rate": 2 / len(data), "digit_rate": 4 / len(data), "distinct_rate": len(set(words)) / len(words), "top_word_rate": max(Counter(words).values()) / len(words), "repeat_pairs": 1 - len(set(pairs)) / (len(words) - 1), "dup_lines": 1 / 3, "shout_words": sum(w.isupper() for w in words) / len(words), "long_words": 1 / len(words), "non_ascii": 2 / len(data)}
    assert {k: got[k] for k in want} == pytest.approx(want)
    rng = np.random.default_rng(3)
    x, y = rng.random((600, 5)), (rng.random(600) > 0.5).astype(float)
    model = quality_model.fit(x, y, rounds=10, pair_rounds=5, n_pairs=3)
    for row, score in zip(x[:40], model.score(x[:40])):
        total = model.intercept + sum(t[sum(e <= v for e in edges)] for t, edges, v in zip(model.tables, model.edges, row))
        total += sum(t[sum(e <= row[a] for e in model.coarse[a]), sum(e <= row[b] for e in model.coarse[b])] for (a, b), t in zip(model.pairs, model.pair_tables))
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op3_quality"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93


def test_held_out_rows_are_never_learnt(spark, odd, none):
    model = quality_model.fit(np.zeros((0, len(quality_model.FEATURES))), np.zeros(0))
    out = quality_model.score_quality(odd, model)
    assert out.count() == odd.count() and out.columns[-2:] == ["score", "predicted"] and out.columns.count("score") == 1
    assert quality_model.score_quality(none, model).count() == 0
    flags = {r.doc_id: r.h for r in spark.range(50).select(F.col("id").alias("doc_id"), quality_model.held_out().alias("h")).collect()}
    assert flags == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}
    empty = quality_model.fit_quality_model(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert empty.score(np.zeros((1, len(quality_model.FEATURES))))[0] == 0.5


# Languages


def test_languages(spark, none):
    sf = "/root/testdata/sf0.001"
    docs, pages = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/pages.parquet")
    got = language_id.identify_languages(pages, docs).collect()
    assert len(got) == pages.count()
    declared = [r for r in got if r.declared]
    assert sum(r.lang == r.declared for r in declared) / len(declared) > 0.9
    assert all(sum(r.posterior) == pytest.approx(1) for r in got)
    odd_pages = spark.createDataFrame([(1, None, None), (2, "not a url", ""), (2, "not a url", ""), (None, "http://a.b/x", "<html lang=fr><p>le")], "page_id long, url string, html string")
    rows = language_id.identify_languages(odd_pages, docs).collect()
    assert len(rows) == 4 and all(r.lang for r in rows)
    assert language_id.identify_languages(pages.limit(0), docs).count() == 0
    assert [r.lang for r in language_id.identify_languages(odd_pages, docs.limit(0)).collect()] == [None] * 4


def test_evidence_is_fused_as_bayes_says(spark):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("aaa bbb aab", "xx"), ("zzz yyy zzy", "yy")] * 5)], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "http://h.x/", "<html lang=xx>aaa bbb"), (2, "http://h.x/", "<html lang=xx>aab"), (3, "http://h.x/", "<html lang=xx>"), (4, "http://h.y/", "<html lang=yy>zzz")], "page_id long, url string, html string")
    got = {r.page_id: r for r in language_id.identify_languages(pages, docs).collect()}
    text = {k: np.array(r.posterior) for k, r in got.items()}
    assert [got[i].lang for i in (1, 2, 3, 4)] == ["xx", "xx", "xx", "yy"]
    langs, model = language_id.fit_text_model(docs)
    own = {r.page_id: np.array(r.text_posterior) for r in language_id.page_evidence(pages, langs, model).collect()}
    k, cell = language_id.SHRINK, language_id.CELL
    for i in got:
        rest = lambda same: sum((own[j] for j in got if j != i and same(j)), np.zeros(2))
        corpus = rest(lambda j: True)
        prior = (corpus + k / 2) / (corpus.sum() + k)
        for level in ("suffix", "host"):
            sums = rest(lambda j: got[j][level] == got[i][level])
            prior = (sums + k * prior) / (sums.sum() + k)
        joint = own[i] * (rest(lambda j: got[j].declared == got[i].declared) + cell) / (corpus + 2 * cell) * prior
        assert text[i] == pytest.approx(joint / joint.sum(), abs=1e-9)


def test_text_model_counts_trigrams_of_the_sample(spark):
    """All rows where they are few, else the first by hash, however often a row is repeated."""
    rows = [(i, "".join(random.Random(i).choice("abcé 日X.") for _ in range(i % 50)), f"l{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows * 2 + [(None, "x", None), (5, None, "l0")], "doc_id long, text string, lang string")
    hashed = {(r.doc_id, r.lang): (r.h, r.text) for r in df.where("text <> '' and lang is not null").select("doc_id", "lang", "text", F.xxhash64("doc_id", "lang", "text").alias("h")).collect()}
    for most in (4000, 40):
        langs, model = language_id.fit_text_model(df, most)
        table = {}
        for (_, lang), (_, text) in sorted(hashed.items(), key=lambda x: x[1][0])[:most]:
            plain = [c if c.isalpha() and (ord(c) > 127 or c.isascii()) else " " for c in f" {text.lower()} "]
            plain = [c for i, c in enumerate(plain) if c != " " or not i or plain[i - 1] != " "]
            row = table.setdefault(lang, np.full(language_id.BUCKETS, 0.1))
            for a, b, c in zip(map(ord, plain), map(ord, plain[1:]), map(ord, plain[2:])):
                h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF
                h ^= h >> 15
                row[(h * 0x2C1B3C6D >> 7) & (language_id.BUCKETS - 1)] += 1
        assert langs == sorted(table)
        assert np.allclose(model, [np.log(table[x] / table[x].sum()) for x in langs])


@pytest.mark.parametrize("page", ["<script>" * 130_000, "<" * 1_000_000, "<html " * 170_000, "<!--" * 250_000, "<p>a</p>" * 120_000, "&#" + "9" * 1_000_000 + ";", "&#" + "0" * 1_000_000 + "65;", "<html lang" + " " * 1_000_000, "<script></script " * 60_000])
def test_hostile_pages_are_read_in_linear_time(page):
    began = time.time()
    text = language_id.visible_text(page)
    language_id.declared_language(page)
    language_id.trigram_counts(text)
    assert time.time() - began < 10


def test_page_parts():
    assert language_id.visible_text("a<script>x</SCRIPT >b<style>c<b>d &#65;&#0000000065;&#99999999999;<e") == "a b c d AA\ufffd<e"
    assert language_id.visible_text("<p>a&amp;b<script>var x='<p>'</script><!-- no --><b>c</b>").split() == ["a&b", "c"]
    assert language_id.declared_language("<HTML class=x LANG='de-AT'>") == "de"
    assert language_id.host_of("https://u:p@WWW.Example.org:80/a?b") == "www.example.org" and language_id.host_of("/a/b") is None


# Pipeline


def test_pipeline_stages(spark, sample, odd):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    extra = odd.select(*columns)
    docs = sample.select(*columns).unionByName(extra.withColumn("doc_id", F.col("doc_id") + 10_000))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "secrets", "mixing", "packing"] and corpus_pipeline.ORACLE_SQL is None
    kept = stages["quality_rules"](spark, docs, "")
    assert kept.columns == columns
    from test_text_operators import base_spans, brute_report

    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in docs.collect() if brute_report(r.text)[-1])
    single = stages["near_duplicates"](spark, kept, "")
    assert single.columns == columns and single.count() < kept.count()
    assert len({r.text for r in single.collect()}) == single.count()
    clean = stages["secrets"](spark, single, "")
    assert clean.columns == columns and clean.count() == single.count()
    assert all(not base_spans(r.text) and r.n_chars == len(r.text) for r in clean.collect())
    mixed = stages["mixing"](spark, clean, "")
    assert mixed.columns == columns
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in clean.collect()}
    check_packing(mixed, stages["packing"](spark, mixed, "").collect())


def test_pipeline_keeps_clashing_columns(odd):
    """Every stage hands on columns of any name and case as they are, and the last one packs all the same."""
    rows = odd.withColumn("text", F.concat_ws(" ", "text", F.lit("token=abcdefgh12 and some more words"), F.lit("that let a text pass the rules")))
    for docs in (rows, rows.drop("repetition", "secrets", "mix").selectExpr("*", "'y' AS REPETITION", "'z' AS Secrets", "1 AS MIX")):
        extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        want = docs.select(*[F.col(f"`{c}`") for c in extra]).distinct().collect()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns, docs = docs.columns, stage(docs.sparkSession, docs, "")
            assert docs.columns == columns, name
            docs = stored(docs, name)
            assert docs.select(*extra).distinct().collect() == want, name
        assert corpus_pipeline.packing(docs.sparkSession, docs, "").count() >= docs.count() > 0


def test_pipeline_on_no_documents(spark, none):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_registered_queries(spark):
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert tokenizer_path() == PATH and math.isfinite(QUERIES["op6_mixing"](spark, "/root/testdata/sf0.001").count())
