"""Operators on texts against brute force over every pair, word or chunk."""
import hashlib
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
import edge_docs  # noqa: E402
from biolattice.llm import exact, licenses, lines, simhash  # noqa: E402

WS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs.docs(spark).cache()


def words(t):
    return WS.findall((t or "").translate(LOWER))


# ---- licences ------------------------------------------------------------------------------

NOTICES = ["x", "Licensed under CC BY-NC 4.0.", "all RIGHTS reserved, cc-by and cc by", None, "", "GENERAL public\nlicense accby cc bya",
           "one two Released under the\nMIT license today", "filler " * 70 + "this work is licensed under the gnu general public license version 3 " + "tail " * 70,
           "released license", "Ünder cc Éby cc by"]


def license_truth(text):
    w = licenses._tokens(text or "")
    found = [(i, a) for p, a in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    more, best = set(), 0.0
    for a, t in licenses.TEMPLATES:
        ts = licenses._tokens(t)
        half = 1 << max(2, (len(ts) - 1).bit_length())
        for s in range(0, max(len(w) - half, 1), half):
            share = len(set(w[s:s + 2 * half]) & set(ts)) / len(set(ts))
            if share >= 0.8:
                more.add(a)
                best = max(best, share)
    at = [i for i, _ in found]
    base = {a for _, a in found}
    return (len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if found else best)


def test_license_scan(spark, docs):
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(NOTICES)], "doc_id long, text string, labels string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame).collect()}
    assert got == {i: license_truth(t) for i, t in enumerate(NOTICES)}
    assert "mit" in got[6][5] and "gpl-3.0" in got[7][5] and got[8][5] == ""
    assert licenses.scan(docs).count() == docs.count()
    assert licenses.scan(edge_docs.none(spark)).count() == 0


# ---- exact dedup ---------------------------------------------------------------------------


def test_chunks_join_to_the_text_and_follow_the_content():
    a = ("alpha beta gamma " * 4000).encode() + bytes(range(256)) * 40
    for data in (b"", b"x", a, b"shift" + a):
        ends = exact.cut_points(data)
        assert ends == sorted(set(ends)) and (ends[-1:] or [0]) == [len(data)]
    import random
    r = random.Random(3).randbytes(60000)
    one, two = ({r[i:j] for i, j in zip([0, *e], e)} for e in [exact.cut_points(r)] for _ in range(2))
    moved = b"some new head" + r
    e = exact.cut_points(moved)
    assert len({moved[i:j] for i, j in zip([0, *e], e)} & one) > 0.8 * len(two)


def test_exact_duplicates(spark, docs):
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        for i in ids:
            want[(i, keep, len(ids), i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact.exact_duplicates(docs).collect())) == want
    assert exact.exact_duplicates(edge_docs.none(spark)).count() == 0
    left = exact.drop_exact_duplicates(docs.filter("doc_id is not null"))
    assert left.columns == docs.columns and sorted({r.text or "" for r in left.collect()}) == sorted({t for t, ids in groups.items() if ids != [None]})


def test_a_clash_of_digests_takes_the_next_seed(docs, monkeypatch):
    import pyarrow as pa

    def clashing(d, seed):
        def run(batches):
            for b in batches:
                t = [x.as_py().encode() for x in b.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array([b"same" if seed == 0 else x for x in t], pa.binary()), pa.array(t, pa.binary())], ["digest", "chunk"])
        return d.selectExpr("coalesce(text, '') text").mapInArrow(run, "digest binary, chunk binary")
    monkeypatch.setattr(exact, "chunk_table", clashing)
    assert exact.verified_seed(docs) == 1


# ---- SimHash -------------------------------------------------------------------------------


def fp_truth(t):
    w = words(t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def linked(fps, distance=3):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    fs = sorted(fps)
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_near_duplicates(spark, docs):
    rows = docs.collect()
    fp = [fp_truth(r.text) for r in rows]
    comp = linked(set(fp))
    first = {}
    for r, f in zip(rows, fp):
        first[comp[f]] = min([x for x in (first.get(comp[f]), r.doc_id) if x is not None], default=None)
    want = Counter((r.doc_id, f"{f:016x}", first[comp[f]]) for r, f in zip(rows, fp))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert simhash.near_duplicates(edge_docs.none(spark)).count() == 0


@pytest.mark.parametrize("size", [2, 3, 4, 5])
def test_position_sets_cover_every_agreement(size):
    from itertools import combinations
    sets = simhash.position_sets(5, size)
    assert all(any(set(s) <= set(o) for s in sets) for o in combinations(range(8), 5))


def test_links_join_every_near_pair(spark):
    import random
    rng, fps = random.Random(5), set()
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):  # chains and balls
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
    fps |= {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    sign = lambda f: f - (1 << 64) if f >> 63 else f
    frame = spark.createDataFrame([(sign(f),) for f in fps], "fp long")
    from biolattice.llm.common import components
    edges = simhash.links(frame)
    got = {r.node: r.root for r in components(edges).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for f, root in linked(fps).items():
        want[root].add(sign(f))
    for f in fps:
        groups[got.get(sign(f), sign(f))].add(sign(f))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 3 for a, b in map(tuple, edges.collect()))


def test_one_of_each_near_group_stays(spark, docs):
    left = simhash.drop_near_duplicates(docs)
    ids = {r.doc_id for r in left.collect()}
    assert left.columns == docs.columns and 5 in ids and 20 not in ids and None in ids


# ---- line dedup ----------------------------------------------------------------------------


def repeated_truth(rows, share=0.8, least=1):
    ls = [((-1 if d is None else d), i, frozenset(words(t))) for d, text in rows for i, t in enumerate((text or "").split("\n"))]
    ls = [x for x in set(ls) if len(x[2]) >= least]
    gone = defaultdict(set)
    for d, i, a in ls:
        if any((e, j) < (d, i) and len(a & b) >= share * len(a | b) - 1e-9 for e, j, b in ls):
            gone[d].add(i)
    return gone


@pytest.mark.parametrize("hot", [1000, 2])
def test_line_report(spark, docs, hot):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gone = repeated_truth(rows)
    want = Counter((d, len((t or "").split("\n")), len(gone[-1 if d is None else d]), ",".join(map(str, sorted(gone[-1 if d is None else d])))) for d, t in rows)
    assert Counter(map(tuple, lines.line_report(docs, hot=hot).collect())) == want
    assert lines.line_report(edge_docs.none(spark)).count() == 0


def test_lines_with_few_changes(spark):
    """Lines of one group differ by some words, so that earliest candidates fail and others hold."""
    import random
    rng = random.Random(9)
    base = edge_docs.sentence(rng, 24).split()
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = edge_docs.sentence(rng, 1) + str(rng.randint(0, 3))
        rows.append((i, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d for d, s in repeated_truth(rows).items() if s}
    assert {r.doc_id for r in lines.line_report(frame).filter("n_removed > 0").collect()} == want


def test_dedup_lines_takes_them_out(spark, docs):
    gone = repeated_truth([(r.doc_id, r.text) for r in docs.collect()])
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.filter("doc_id = 25 or doc_id = 20").collect():
        full = docs.filter(f"doc_id = {r.doc_id}").first().text.split("\n")
        assert r.text == "\n".join(t for i, t in enumerate(full) if i not in gone[r.doc_id]) and r.n_chars == len(r.text)


def test_short_lines_repeat_too(spark):
    rows = [(1, "Les.\nles.  LES.\n\none two"), (2, "two ONE\nother\n \nLes."), (None, "other")]
    got = {r.doc_id: (r.n_removed, r.removed) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {None: (0, ""), 1: (1, "1"), 2: (3, "0,1,3")}


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    import random
    import numpy as np
    import pyarrow as pa
    rng = random.Random(4)
    some = ["".join(rng.choice("abc\u00e9\u4e2d") for _ in range(rng.choice([0, 1, 3, 8, 40, 90]))) for _ in range(300)]
    whole = lines.word_hashes(pa.array(some))
    assert len(set(whole.tolist())) == len(set(some))
    monkeypatch.setattr(lines, "BLOCK", 64)  # longer words get tables of their own
    lines._block_powers.cache_clear()
    try:
        assert np.array_equal(lines.word_hashes(pa.array(some)), whole)
        assert np.array_equal(lines.word_hashes(pa.array(some).slice(100)), whole[100:])
    finally:
        lines._block_powers.cache_clear()


def test_candidates_come_in_slices(spark):
    rows = [(7, d, 0, 20 << 32, 5, 6, d % 3) for d in range(40)] + [(8, d, 1, 20 << 32, 5, 6, d) for d in range(30)]
    posts = spark.createDataFrame(rows, lines.SCHEMA)
    for every, frame in ((False, posts), (True, posts.selectExpr("*", "doc % 2 = 0 AS open"))):
        big = lines.candidates(frame, 0.8, every, 2).collect()
        assert Counter(map(tuple, lines.candidates(frame, 0.8, every, 2, rows=16, out=5).collect())) == Counter(map(tuple, big))
        n = len(big)
        assert n == (sum(d for m in (40, 30) for d in range(0, m, 2)) if every else sum(min(d, 8) + (d > 8) for m in (40, 30) for d in range(m)))


def test_packed_postings_are_the_same_rows(spark):
    """Postings move by ranges of keys, far fewer rows than postings, and give the candidates that single rows give."""
    text = ["\n".join(f"word{i % 7} other{i % 5} more{(i + j) % 11} and some words of line {j}" for j in range(12)) for i in range(60)]
    docs = spark.createDataFrame([*enumerate(text), (0, "the twin of a place"), (99, "")], "doc long, text string").repartition(3)
    counts = lines.rarity(docs)
    assert counts.sum() > 0 and lines.rarity(docs.limit(0)).sum() == 0
    single, packed = lines.postings(docs, counts, 1, 0.8, 4), lines.postings(docs, counts, 1, 0.8, 4, None, 64)
    assert packed.columns == ["bucket", "rows"] and packed.count() * 3 < single.count()
    for few in (8, 2):
        a, b = (Counter(map(tuple, lines.candidates(p, 0.8, False, 2, few, rows=64).collect())) for p in (single, packed))
        assert a == b and len(a) > 60
    assert lines.candidates(lines.postings(docs.limit(0), counts, 1, 0.8, 4, None, 64), 0.8, False, 2).count() == 0


def test_postings_of_wanted_keys_are_those_of_all(spark):
    import numpy as np

    text = [f"a{i % 9} b{i % 4} c{i % 3} some words that all lines have" for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc long, text string").coalesce(1)
    counts = lines.rarity(docs)
    every = [tuple(r) for r in lines.postings(docs, counts, 1, 0.8, 16).collect()]
    some = set(sorted({r[0] for r in every if r[3] >= 0})[::3])
    only = np.zeros((1 << lines.MAP_BITS) // 8, np.uint8)
    for k in some:
        only[k % (1 << lines.MAP_BITS) >> 3] |= 1 << (k % (1 << lines.MAP_BITS) & 7)
    got = [tuple(r) for r in lines.postings(docs, counts, 1, 0.8, 16, only).collect() if r[3] >= 0]
    assert got and Counter(got) == Counter(r for r in every if r[3] >= 0 and r[0] in some)


def test_equal_lines_take_part_once(spark):
    """Of 300 copies of a line and 40 near copies of it, each copy is named once with the first, and the near ones meet one of them."""
    rows = [(7, d, 0, 20 << 32, 5, 6, 1) for d in range(300)] + [(7, 300 + d, 0, 20 << 32, 5, 6, 2 + d) for d in range(40)]
    rows += [(7, 20, 0, 20 << 32, 5, 6, 1), (8, 1, 0, 20 << 32 | 1, 5, 6, 1), (8, 2, 0, 20 << 32 | 1, 5, 6, 1)]
    got = [tuple(r) for r in lines.candidates(spark.createDataFrame(rows, lines.SCHEMA), 0.8, False, 2, once=True).collect()]
    sure = [r for r in got if r[4]]
    assert {r[0] for r in sure} == set(range(1, 300)) and {r[2:4] for r in sure} == {(0, 0)} and len(sure) <= 300
    assert Counter(r[0] for r in got if not r[4] and r[3] >= 0) == Counter({300 + d: min(d + 1, 8) for d in range(40)})


def test_wanted_first_words_spare_no_wanted_key(spark):
    import numpy as np

    text = [f"a{i % 9} b{i % 4} c{i % 3} some words that all lines have" for i in range(80)] + ["x y", "x y z"]
    docs = spark.createDataFrame(list(enumerate(text)), "doc long, text string").coalesce(1)
    counts = lines.rarity(docs)
    marks = [np.zeros((1 << lines.MAP_BITS) // 8, np.uint8) for _ in range(2)]
    every = [tuple(r) for r in lines.postings(docs, counts, 1, 0.8, 16).collect()]
    for k in sorted({r[0] for r in every if r[3] >= 0})[::7]:
        for m, v in zip(marks, (k, int(lines.first_word(np.array([k]))[0]))):
            v %= 1 << lines.MAP_BITS
            m[v >> 3] |= 1 << (v & 7)
    plain, spared = ([tuple(r) for r in lines.postings(docs, counts, 1, 0.8, 16, marks[0], words=w).collect() if r[3] >= 0] for w in (None, marks[1]))
    known = lambda rows: {(r[0], r[3], r[6]) for r in rows if r[3] >> 32 > 3}
    assert known(plain) and known(spared) == known(plain) and set(spared) >= {r for r in plain if r[3] >> 32 > 3}


def test_memory_of_a_task_is_given_back(monkeypatch):
    import pyarrow as pa
    from biolattice.llm import common

    calls, pool = [], pa.default_memory_pool()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: (calls.append(1), pool.release_unused())})())
    task = common.released(lambda batches: (b for b in batches))
    assert list(task(iter([1, 2, 3]))) == [1, 2, 3] and calls == [1]
