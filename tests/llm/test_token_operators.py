"""Token counts, filter audit and tokenizer alignment against the libraries and brute force over every order and link."""
import hashlib
import re
import sys
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import permutations
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import edge_docs  # noqa: E402
from biolattice.llm import alignment, audit, tokens  # noqa: E402
from biolattice.llm.packing import encoder  # noqa: E402

A = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, " ", "x", "Hello  world's\n\n end <|endoftext|>tail<|endoftext|>", "Ünïcode — „Größe“ 12345 don't", "日本語のテキスト 漢字かな", "՘࢏ odd \U00010940 letters",
         "tabs\t\tand\x00nul\x1c", "🙂 emoji 🌍 ☃", "▁ lower eighth", "a" * 3000, "word " * 2000, "   lead and trail   ", "<s> </s> <unk> <0x41>", "ﬁ ligature", "é combining",
         "word " * 2000]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i if i % 7 else None, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs.docs(spark).select("doc_id", "text", "lang", "source", "n_chars").cache()


# ---- token counts --------------------------------------------------------------------------


def test_safe_characters_split_alike():
    """Every character taken as safe is split as in the library, and so are its ids."""
    pre, raw = tokens.PreTokens(), Tokenizer.from_file(A)
    safe = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000)]) if not pre.other(c)]
    assert len(safe) > 30000
    for at in range(0, len(safe), 50):
        s = "".join(f"a{c}1{c}!{c} {c}{c} " for c in safe[at:at + 50])
        assert [o for _, o in raw.pre_tokenizer.pre_tokenize_str(s)] == [m.span() for m in re_iter(s)], s
        if at % 1000 == 0:
            assert raw.encode(s, add_special_tokens=False).ids == encoder().encode_ordinary(s)


def re_iter(s):
    import regex
    return regex.finditer(public_tokenizers.PATTERN, s)


@pytest.mark.parametrize("table", [1 << 15, 3])
def test_count_tokens(spark, docs, table):
    lib = Tokenizer.from_file(A)
    both = frame(spark).drop("n_tokens").union(docs.select("doc_id", "text"))
    want = Counter()
    for r in both.collect():
        t = r.text or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        want[(r.doc_id, len(t.encode()), n, n > 1024)] += 1
    assert Counter(map(tuple, tokens.count_tokens(both, table=table).collect())) == want
    assert Counter(map(tuple, tokens.count_tokens(frame(spark), table=table).collect()))[(1, 0, 0, False)] == 1
    assert tokens.count_tokens(edge_docs.none(spark)).count() == 0


def test_small_caches_give_the_same_counts():
    lib, pre = Tokenizer.from_file(A), tokens.PreTokens(cached=2)
    assert [pre.count(t or "") for t in TEXTS] == [len(lib.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    assert len(pre.lengths.met) <= 2


def test_summaries_keep_every_frequent_item():
    import random
    rng = random.Random(4)
    items = [str(int(rng.paretovariate(0.7))) for _ in range(20000)]
    whole = tokens.Summary(40)
    for k in range(0, len(items), 1000):
        part = tokens.Summary(40)
        part.add(items[k:k + 1000])
        whole.add(*part.rows())
    names, counts = whole.rows()
    truth = Counter(items)
    assert len(names) <= 40 and {t for t, n in truth.items() if n > len(items) / 41} <= set(names)
    assert all(truth[t] - len(items) / 41 <= n <= truth[t] for t, n in zip(names, counts))


def test_frequent_over_many_tasks(spark, docs):
    got = dict(zip(*tokens.frequent(docs.repartition(40).select(F.coalesce("text", F.lit("")).alias("text")), 1 << 15)))
    pre, truth = tokens.PreTokens(), Counter()
    for r in docs.collect():
        found = pre.split(r.text or "")
        truth.update(t for t in found[0] if len(t) <= tokens.LONGEST)
    assert got == dict(truth)


# ---- filter audit --------------------------------------------------------------------------


def audit_truth(rows, labels):
    first, good, bad = {}, Counter(), Counter()
    for r in rows:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    for i, q, t in labels:
        if i is None:
            continue
        good[i] |= q == 1
        bad[i] |= t == 1
    docs = []
    for r in rows:
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": r.doc_id is not None and r.doc_id > first[t]}
        docs.append((r.lang or "", {k for k, v in fails.items() if v}, int(good[r.doc_id]), int(bad[r.doc_id])))
    out, total = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = gone = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                cut = [d for d in left if f in d[1]]
                out[part, order, step] = [len(left) - len(cut), len(cut), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in docs if d[0] == part), sum(d[2] for d in cut),
                                          sum(d[3] for d in cut)]
                total[part, f] += len(cut)
                left, gone = [d for d in left if f not in d[1]], gone + cut
    return {(p, o, s): (*v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_audit(spark, docs):
    more = spark.createDataFrame([(5, "A B C # d", "en"), (900, "A B C # d", "de"), (901, "CAPS " * 300, None), (901, "CAPS " * 300, ""), (902, "CAPS " * 300, "en"),
                                  (None, "CAPS " * 300, "en"), (903, " ".join(f"w{i}" for i in range(250)), "en"), (904, " ".join(f"w{i}" for i in range(250)) + "|", "fr")],
                                 "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").union(more).withColumn("part", F.lit("x")).withColumn("mask", F.lit(3))
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(902, 1, 1), (903, 1, None), (903, None, 0), (None, 1, 1), (7777, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audit(both, table).collect()}
    assert got == audit_truth(both.collect(), labels)
    assert audit.audit(edge_docs.none(spark), table).count() == 0


def test_intervals_cover_each_order_once(spark):
    seen = Counter()
    for m, step, lo, hi in audit.removal_intervals(spark).collect():
        for r in range(lo, hi):
            seen[m, r] += 1
            order = list(permutations(range(5)))[r]
            assert order[step - 1] in {f for f in range(5) if m >> f & 1} and not any(m >> f & 1 for f in order[:step - 1])
    assert seen == Counter({(m, r): 1 for m in range(1, 32) for r in range(120)})


# ---- alignment -----------------------------------------------------------------------------


def alignment_truth(texts):
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    from tokenizers import decoders
    plain = decoders.ByteLevel()
    rows, held = [], defaultdict(set)
    for k, t in enumerate(texts):
        a, b = lib.encode(" " + (t or ""), add_special_tokens=False).ids, sp.encode(t or "")
        if not t or plain.decode([lib.id_to_token(i) for i in a]) != " " + t:
            rows.append(None)
            continue
        pieces = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, b)]
        if b"".join(pieces) != (" " + t).encode():
            rows.append(None)
            continue
        enc, ends_a, ends_b, at = tokens_bytes(lib, a), [], [], 0
        for x in enc:
            at += x
            ends_a.append(at)
        at = 0
        for x in pieces:
            at += len(x)
            ends_b.append(at)
        shared = sorted(set(ends_a) & set(ends_b))
        by = {e: ([], []) for e in shared}
        for ids, ends, side in ((a, ends_a, 0), (b, ends_b, 1)):
            for i, e in zip(ids, ends):
                by[shared[bisect_left(shared, e)]][side].append(i)
        groups = [by[e] for e in shared]
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        for p in links:
            held[p].add(k)
        rows.append((len(a), len(b), groups, links))
    count, best = {p: len(v) for p, v in held.items()}, Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0,) * 6 + ("",))
        else:
            s = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in r[2])
            out.append((r[0], r[1], len(r[2]), sum(r[3].values()), sum(n for p, n in r[3].items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in r[3].items()),
                        hashlib.sha256(s.encode()).hexdigest()))
    return out


def tokens_bytes(lib, ids):
    """Byte lengths by the library's own byte alphabet: every character of an entry stands for one byte."""
    return [len(lib.id_to_token(i)) for i in ids]


@pytest.mark.parametrize("frequent", [1 << 18, 50, 1])
def test_link_report(spark, docs, frequent):
    data = frame(spark).drop("n_tokens").union(docs.select("doc_id", "text").limit(40)).withColumn("row", F.lit(1)).withColumn("pairs", F.lit("x"))
    rows = data.collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, alignment_truth([r.text for r in rows])))
    assert Counter(map(tuple, alignment.link_report(data, frequent=frequent).collect())) == want
    assert sum(v for k, v in want.items() if k[1]) > 30


def test_alignment_of_no_rows_and_of_no_tokens(spark):
    assert alignment.link_report(edge_docs.none(spark)).count() == 0
    got = alignment.link_report(frame(spark, ["", None, "▁"]))
    assert {tuple(r)[1:] for r in got.collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_windows_share_their_ends_and_small_memory_changes_nothing():
    big, small = alignment.Pair(), alignment.Pair(cached=1)
    for t in TEXTS:
        one, two = big.text(t or ""), small.text(t or "")
        assert one[:5] == two[:5] and dict(zip(one[5], one[6])) == dict(zip(two[5], two[6]))
        a, b = big.encode(t or "")
        if len(a):
            cuts = list(zip(*big.windows(a, b)))
            assert cuts == sorted(cuts) and cuts[-1] == (len(a), len(b))
            for i, j in cuts:
                assert sum(big.size[0][a[:i]]) == sum(big.size[1][b[:j]])
