"""Sharding, mixing, packing, models and neighbours: laws, round trips, brute force, held-out accuracy."""
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import edge_docs  # noqa: E402
from biolattice.llm import attention, lm, mixing, neighbours, packing, quality, queries, sharding  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs.docs(spark).cache()


# ---- sharding ------------------------------------------------------------------------------


def test_shards_hold_every_row_once(spark, docs):
    for sizes in ({}, {"bucket_rows": 7}, {"bucket_bytes": 1000}):
        out = sharding.shard(docs.withColumnRenamed("size", "slot"), 5, **sizes).collect()
        slots = defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        n = [len(slots[s]) for s in range(5)]
        assert max(n) - min(n) <= 1 and sum(n) == docs.count()
        assert Counter(r.text for r in out) == Counter(r.text for r in docs.collect())
    assert sharding.shard(edge_docs.none(spark)).count() == 0


def test_reruns_agree_and_seeds_differ(docs):
    d = docs.select("doc_id", "source")
    a, b, c = (sorted(map(str, sharding.shard(d, 4, seed, bucket_rows=9).collect())) for seed in (1, 1, 2))
    assert a == b != c


def test_places_are_uniform(spark):
    d = spark.range(400).withColumnRenamed("id", "doc_id")
    first = [sharding.shuffle_rows(d, seed, bucket_rows=50).filter("doc_id < 100").selectExpr("avg(_position)").first()[0] for seed in range(4)]
    assert 150 < np.mean(first) < 250


def test_repeated_rows_do_not_swell_a_bucket(spark):
    d = spark.range(1000).selectExpr("1L as doc_id")
    out = sharding.shard(d, 4, bucket_rows=20)
    assert sorted(r["count"] for r in out.groupBy("shard").count().collect()) == [250] * 4


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id", "text"), str(tmp_path / "s"), 3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}


def test_the_query_shards_whole_rows(spark, monkeypatch):
    documents, shard, given = spark.read.parquet(f"{SF}/documents.parquet"), sharding.shard, []
    monkeypatch.setattr(sharding, "shard", lambda df, *a, **b: given.append(df.columns) or shard(df, *a, **b))
    got = queries.op4_shuffle_shards(spark, SF).collect()
    assert given == [documents.columns]
    want = shard(documents, 8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), r.shard, r.slot) for r in want)


# ---- mixing --------------------------------------------------------------------------------


def target_truth(sizes):
    """Deal by weight, cut at the limit, deal the excess anew until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    whole, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = whole - sum(2 * sizes[s] for s in full)
        aim = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if aim[s] > 2 * sizes[s]}
        if not over:
            return aim | {s: 2.0 * sizes[s] for s in full}
        full |= over


def test_mix_meets_the_targets(spark, docs):
    import re
    rows = docs.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = target_truth(sizes)
    got = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    source = {r.doc_id: r.source for r in rows}
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(want[s], 1)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - want[s]) <= max(most[s], 1) for s in sizes)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs).collect()))
    assert mixing.mix(edge_docs.none(spark)).count() == 0


def test_mix_is_close_on_many_documents(spark):
    d = spark.range(5000).selectExpr("id as doc_id", "repeat('w ', cast(1 + pow(id % 97, 1.7) as int)) as text", "concat('s', cast(least(id % 9, 4) as string)) as source")
    got = mixing.mix(d).groupBy("source_size", "target").agg({"taken": "sum", "size": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r.target) < 0.01 * r.target for r in got)


def test_mixed_rows_of_one_id_keep_their_own_copies(spark):
    rows = [(1, "a", " ".join("w" * n)) for n in (1, 3, 9, 27, 81)] + [(1, "b", "w w"), (1, None, None), (None, "a", "w w w w"), (2, "a", "w " * 40), (3, "b", "w " * 9)]
    d = spark.createDataFrame(rows, "doc_id int, source string, text string")
    want = Counter({(r.doc_id, r.size): 0 for r in mixing.mix(d).collect()})
    for r in mixing.mix(d).collect():
        want[r.doc_id, r.size] += r.copies
    got = Counter((r.doc_id, len((r.text or "").split())) for r in mixing.mixed_documents(d).collect())
    assert got == +want and len(set(want.values())) > 1


def test_mixed_documents_are_repeated(docs):
    copies = {r.doc_id: r.copies for r in mixing.mix(docs.filter("doc_id <> 30")).collect()}
    out = mixing.mixed_documents(docs.filter("doc_id <> 30"))
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({d: c for d, c in copies.items() if c})


# ---- packing -------------------------------------------------------------------------------


def ids_by_tokenizers(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids + [packing.END_ID] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_packing_is_an_exact_round_trip(spark, docs):
    extra = [(100 + i, t) for i, t in enumerate(["  two  spaces\n\n end ", "it's we'll 12ab!! é　中文 🙂", "<|endoftext|> x", "a" * 5000, "\t\r\n"])]
    d = docs.filter("doc_id is not null and doc_id <> 30").select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows, pieces = d.collect(), packing.pack(d).collect()
    ids = dict(zip((r.doc_id for r in rows), ids_by_tokenizers([r.text or "" for r in rows])))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
        part = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4")
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(part.tobytes())
    for k, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[k])
    assert set(by_doc) == set(ids)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
    assert packing.pack(edge_docs.none(spark)).count() == 0


def test_the_query_and_the_stage_give_the_added_token(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> x", "<|endoftext|>", "  <|endoftext|><|endoftext|>\n it's", "<|endoftext| >", "plain", "", "<|endoftext|> é 🙂 " * 50]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {i: [*e.ids, packing.END_ID] for i, e in enumerate(t.encode_batch(texts, add_special_tokens=False))}
    assert want[0] == [64, 220, 50256, 2124, packing.END_ID]
    for out in (queries.op9_sum_of_squares_packing(spark, str(tmp_path)), corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "")):
        pieces = out.collect()
        assert {p.doc_id for p in pieces} == set(want)
        for p in pieces:
            part = np.array(want[p.doc_id][p.start:p.start + p.length], "<u4")
            assert p.doc_tokens == len(want[p.doc_id]) and p.ids_crc32 == zlib.crc32(part.tobytes())
    assert lm.END not in lm._ids(lm.encoder(), texts[0])[:-1]


def test_the_level_chosen_has_the_smallest_sum_of_squares():
    rng = np.random.default_rng(2)
    packer = packing.Packer(32)
    for _ in range(3000):
        s = int(rng.integers(1, 32))

        def after(h):
            c = packer.counts.copy()
            c[h] -= h > 0
            if h + s < 32:
                c[h + s] += 1
            return int((c * c).sum())
        options = [0] + [h for h in range(1, 33 - s) if packer.counts[h]]
        assert after(packer.level(s)) == min(map(after, options))
        list(packer.add(0, np.arange(s, dtype="<u4")))
        assert all(packer.counts[h] == len(w) for h, w in packer.open.items())
    open_room = sum(int(n) * (32 - h) for h, n in enumerate(packer.counts))
    assert open_room < 0.03 * 3000 * 16  # little room is left open


# ---- quality -------------------------------------------------------------------------------


def test_pair_sum_in_linear_time():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.FEATURES), rng.normal(0, 0.3, (quality.FEATURES, 4)), np.zeros((quality.STATS, quality.BINS - 1)))
    at, x = rng.choice(quality.FEATURES, 20, False), rng.normal(size=20)
    pairs = sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(20) for j in range(i))
    assert m.score(at, x) == pytest.approx(1 / (1 + np.exp(-(0.3 + m.w[at] @ x + pairs))))


def test_classifier_on_held_out_rows(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(d, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.85
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.97


def test_classifier_edges(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels)
    got = out.collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id == 30}) == 1
    assert quality.classify(edge_docs.none(spark), labels).count() == 0
    assert quality.classify(docs, labels.limit(0)).count() == docs.count()
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns


# ---- language model ------------------------------------------------------------------------


def test_gradient_by_differences():
    rng = np.random.default_rng(4)
    flat = attention.initial(seed=1).astype(np.float64)
    sym, kl = rng.integers(0, 50, (3, 7)), rng.integers(0, attention.CLASSES, (3, 7))
    w = rng.integers(0, 2, (3, 7)).astype(float)
    _, g = attention.gradient(attention.parts_of(flat), sym, kl, w)
    for i in [*rng.choice(np.flatnonzero(np.abs(g) > 1e-4), 25)]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        d = (attention.gradient(attention.parts_of(up), sym, kl, w)[0] - attention.gradient(attention.parts_of(down), sym, kl, w)[0]) / 2e-5
        assert d == pytest.approx(g[i], rel=1e-2, abs=1e-5)


def test_fast_logs_are_those_of_forward():
    rng = np.random.default_rng(6)
    p = attention.parts_of(attention.initial(seed=2))
    p["out"] = p["out"] * 20
    sym, kl, w = rng.integers(0, 4000, (9, attention.WIDTH)), rng.integers(0, attention.CLASSES, (9, attention.WIDTH)), rng.random((9, attention.WIDTH)) < 0.6
    y = attention.forward(p, sym)[0].astype(np.float64)
    want = (np.take_along_axis(y, kl[:, :, None], 2)[:, :, 0] - np.log(np.exp(y).sum(2)))[w]
    assert np.allclose(attention.class_logs(p, sym, kl, w), want, atol=1e-4)
    assert np.allclose(attention.class_logs(p, sym, kl, w, True), want, atol=1e-4)
    p["bias"] = p["bias"] + 200  # overflows without the shift
    assert np.allclose(attention.class_logs(p, sym, kl, w), want, atol=1e-3)


def test_attention_looks_back_only():
    p = attention.parts_of(attention.initial())
    a = np.arange(20)[None] % 9
    b = a.copy()
    b[0, 12:] = 5
    assert np.allclose(attention.forward(p, a)[0][0, :12], attention.forward(p, b)[0][0, :12], atol=1e-5)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 31, 32, 33, 56, 57, 500])
def test_windows_score_each_id_once(n):
    ids = np.arange(n)
    before, after, weight = attention.windows(ids, -1)
    assert sorted(after[weight]) == list(range(n))
    assert (before[weight] == after[weight] - 1).all()


def test_long_texts_in_runs_score_each_id_once(monkeypatch):
    vocab = attention.Vocabulary.of(np.arange(100)[::-1].astype(float))
    p = attention.parts_of(np.zeros(attention.SIZE, np.float32))
    texts = [np.arange(n) % 100 for n in (1, 40, 300, 129)]
    want = [(vocab.within[t] - np.log(attention.CLASSES)).sum() for t in texts]
    monkeypatch.setattr(attention, "WINDOW_IDS", 64)
    assert np.allclose(attention.text_logs(p, vocab, texts, 99), want, rtol=1e-4)


def test_class_shares_sum_to_one():
    v = attention.Vocabulary.of(np.random.default_rng(1).integers(0, 1000, lm.IDS).astype(float))
    assert np.allclose(np.bincount(v.klass, np.exp(v.within.astype(float)), attention.CLASSES), 1, atol=1e-3)


def test_scores(spark, docs):
    got = lm.score_texts(docs, trainers=2, rounds=2).collect()
    rows = docs.collect()
    held = {r.doc_id: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows}
    words = lambda t: (t or "").encode().lower().split() + [b""]
    c = Counter(w for r in rows if not held[r.doc_id] for w in words(r.text))
    n, v = sum(c.values()), len(c)
    text = {r.doc_id: r.text for r in rows}
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    for r in got:
        w = words(text[r.doc_id])
        base = sum(np.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert lm.score_texts(edge_docs.none(spark), trainers=2, rounds=1).count() == 0


def test_rare_words_are_joined(spark, docs):
    d = docs.selectExpr("doc_id", "coalesce(text, '') text")
    counts = lm.word_counts(d, flush=50)
    a, b = (sorted((bytes(r.tkey), r.n_known, round(r.log_sum, 6)) for r in lm.base_scores(d, counts, k).collect()) for k in (5, 100000))
    assert a == b


def test_training_beats_the_frequencies(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    train, test = lm.id_table(d.withColumn("held_out", d.doc_id < 0).filter("doc_id % 5 <> 0")), [r.text for r in d.filter("doc_id % 5 = 0").limit(60).collect()]
    vocab, flat = lm.fit(train, trainers=2, rounds=3)
    enc = lm.encoder()
    ids = [lm._ids(enc, t).astype(int) for t in test]
    trained = attention.text_logs(attention.parts_of(flat), vocab, ids, lm.END).sum()
    counts = lm.id_counts(lm.training_table(train, 1, 1)) + 0.5
    assert counts.sum() - 0.5 * lm.IDS == sum(len(r.ids) // 2 for r in train.collect())
    assert trained > sum(np.log(counts[i] / counts.sum()).sum() for i in ids)


def test_every_id_of_every_text_is_trained_on(spark):
    texts = ["", "one", "w x y z " * 13, "many words in a long text " * 500, "the same", "the same"]
    d = spark.createDataFrame([(i, False, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
    enc = lm.encoder()
    want = [lm._ids(enc, t).astype(int) for t in texts]
    rows = [r for r in lm.training_table(lm.id_table(d), 5, 3).collect() if r.trainer >= 0]
    before, after, weight = (np.concatenate(p) for p in zip(*(lm.run_windows(r.run, r.first) for r in rows)))
    assert Counter(after[weight].tolist()) == Counter(np.concatenate(want).tolist())
    assert Counter(zip(before[weight].tolist(), after[weight].tolist())) == Counter(
        p for ids in want for p in zip([lm.END, *ids.tolist()], ids.tolist()))
    by_round = [r for k in range(3) for r in lm.training_table(lm.id_table(d), 5, 3, k).collect()]
    assert Counter((r.trainer, r.round, bytes(r.run)) for r in by_round) == Counter((r.trainer, r.round, bytes(r.run)) for r in rows)
    sent = list(lm.window_batches(((bytes(r.run), r.first) for r in rows), 8, pool=2))
    assert Counter(i for _, a, w in sent for i in a[w].tolist()) == Counter(after[weight].tolist()) and max(len(a) for _, a, _ in sent) <= 8
    assert (attention.WIDTH, attention.CONTEXT, attention.DIM) == (48, 16, 24)


# ---- neighbours ----------------------------------------------------------------------------


def nearest_truth(vs, every, k):
    """vs: (id, vector) pairs that take part."""
    out = {}
    for q, x in vs:
        if q % every == 0:
            s = sorted((-float(np.dot(np.float64(x), np.float64(y))), i) for i, y in vs if i != q and len(y) == len(x))
            out[q] = s[:k]
    return out


def test_neighbours_edges(spark):
    rng = np.random.default_rng(8)
    vs = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    vs += [(1000 + i, vs[7][1]) for i in range(200)]  # one vector many times
    vs += [(2000, [1.0, 2.0]), (2020, [2.0, 1.0])]
    bad = [(3000, None), (3020, [0.0] * 8), (3040, [float("nan")] * 8), (3060, [None] * 8), (3080, [float("inf")] + [1.0] * 7), (3100, [])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in vs + bad + vs[:3]] + [(None, vs[0][1], 1, 2)], "vec_id long, embedding array<float>, rank int, node int")
    got = defaultdict(list)
    for r in neighbours.search(frame, shards=3).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = nearest_truth(vs, 20, 20)
    assert set(got) == set(want)
    hits = 0
    for q, w in want.items():
        g = sorted(got[q])
        assert [r for r, _, _ in g] == list(range(1, len(w) + 1))
        assert [(-s, i) for _, i, s in g] == sorted((-s, i) for _, i, s in g)
        hits += len({i for _, i, _ in g} & {i for _, i in w}) / len(w)
    assert hits / len(want) > 0.98
    assert neighbours.search(frame.limit(0)).count() == 0


def test_few_candidates_are_all_found(spark):
    vs = [(i, [float(i + 1), 1.0, -float(i)]) for i in range(0, 9)]
    got = neighbours.search(spark.createDataFrame(vs, "vec_id long, embedding array<float>")).collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(0, i) for i in range(1, 9)]


def test_recall_on_the_given_table(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vs = [(r.vec_id, np.float64(r.embedding)) for r in v.collect()]
    x = np.array([e for _, e in vs])
    ids = np.array([i for i, _ in vs])
    hit = total = 0
    for r in neighbours.search(v).groupBy("query_id").agg({"vec_id": "collect_set"}).collect():
        s = x @ x[ids == r.query_id][0]
        s[ids == r.query_id] = -np.inf
        hit += len(set(ids[np.argsort(-s)[:20]].tolist()) & set(r["collect_set(vec_id)"]))
        total += 20
    assert hit / total >= 0.9 and total == 20 * (ids % 20 == 0).sum()
