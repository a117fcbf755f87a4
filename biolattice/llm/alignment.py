"""Operator 13, cross-tokenizer alignment: token groups of two tokenizers with the same bytes, between shared word starts."""
from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..plans.views import scratch
from .common import cut_lineage, text_or_empty
from .packing import encoder
from .tokens import SAFE

SCHEMA = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<long>"
NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]
NONE = np.zeros(0, np.int64)
OF_B, BAR, END = np.uint32(1 << 31), 1 << 16, 1 << 17  # marks above the ids
MANY = 256


def byte_table(pieces: list[str]) -> list[bytes]:
    """Bytes of the pieces of a byte-level vocabulary: printable Latin-1 characters stand for themselves, the other bytes for the
    characters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    return [bytes(of[c] for c in p) if all(c in of for c in p) else p.encode() for p in pieces]


class Held:
    """Numbers in an array that grows at its end."""

    def __init__(self, kind):
        self.data, self.size = np.empty(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            self.data = np.concatenate([self.data[:self.size], np.empty(end, self.data.dtype)])
        self.data[self.size:end], self.size = values, end


def _slots(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)


class Memo:
    """Alignments of windows by their ids: a number for each window, and under it where its marked ids and its pairs are held, its
    numbers of groups and of links, and pairs that are counted apart."""

    def __init__(self):
        self.known, self.apart = {}, {}
        self.ids, self.pairs = Held(np.uint32), Held(np.int64)
        self.id_ends, self.pair_ends, self.groups, self.links = (Held(np.int64) for _ in range(4))
        self.id_ends.add(np.zeros(1, np.int64))
        self.pair_ends.add(np.zeros(1, np.int64))

    def add(self, keys: list[bytes], ids, id_ends, groups, links, pairs, pair_ends, apart: dict) -> np.ndarray:
        """Numbers of new windows."""
        first = self.groups.size
        self.id_ends.add(self.ids.size + id_ends)
        self.pair_ends.add(self.pairs.size + pair_ends)
        for held, values in ((self.ids, ids), (self.pairs, pairs), (self.groups, groups), (self.links, links)):
            held.add(values)
        self.known.update(zip(keys, range(first, first + len(keys))))
        self.apart.update((first + w, found) for w, found in apart.items())
        return np.arange(first, first + len(keys))

    def get(self, numbers: np.ndarray) -> tuple:
        """Marked ids, number of groups and of links, pairs, and pairs counted apart of windows, one after another."""
        id_at, pair_at = self.id_ends.data[numbers], self.pair_ends.data[numbers]
        ids = self.ids.data[_slots(id_at, self.id_ends.data[numbers + 1] - id_at)]
        pairs = self.pairs.data[_slots(pair_at, self.pair_ends.data[numbers + 1] - pair_at)]
        apart = [p for w in numbers[np.isin(numbers, list(self.apart))].tolist() for p in self.apart[w]] if self.apart else []
        return ids, int(self.groups.data[numbers].sum()), int(self.links.data[numbers].sum()), pairs, apart


class Pair:
    """The two tokenizers and the bytes of their ids, and the windows met: they are forgotten once they are more than `cached`, or
    more than 2^22 ids or pairs."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None, cached: int = 1 << 18):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer
        a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        # the same ids several times faster, where the tables of letters of both libraries agree
        self.fast = encoder() if a_path == public_tokenizers.path("byte_bpe_50k.json") else None
        self.other = re.compile(f"[^{SAFE}]").search
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path("piece_bpe_32k.model"))
        self.a_bytes = byte_table([self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())])
        single = re.compile("<0x([0-9A-F]{2})>").fullmatch
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := single(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.size = [np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        self.names = np.array([f"{i}{sign}" for sign in ",|;" for i in range(BAR)], "S6")
        self.spaced = [np.array([t[:1] == b" " for t in table]) for table in (self.a_bytes, self.b_bytes)]
        if max(map(len, self.size)) > BAR:
            raise ValueError("vocabularies of more than 65,536 ids")
        self.cached, self.memo = cached, Memo()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both for a text; none where the bytes of either are not those of a space and the text."""
        if not text:
            return NONE, NONE
        whole = " " + text
        raw = whole.encode()
        a = np.array(self.fast.encode_to_numpy(whole, disallowed_special=()) if self.fast and not self.other(text) else
                     self.a.encode(whole, add_special_tokens=False).ids, np.uint32)
        b = self.b.encode(text)
        # byte-level ids spell what they were made from, so their number of bytes tells; pieces may not, so they are joined
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw or self.size[0][a].sum() != len(raw):
            return NONE, NONE
        return a, np.array(b, np.uint32)

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a and b after the last token of each window: where both have an end at the same byte and both go on with a token
        that starts with a space, and the end of the text."""
        ends = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        at_a, at_b = np.flatnonzero(self.spaced[0][a[1:]]), np.flatnonzero(self.spaced[1][b[1:]])
        off_a, off_b = ends[0][at_a], np.append(ends[1][at_b], -1)
        to = np.searchsorted(off_b[:-1], off_a)
        same = off_b[to] == off_a
        return np.append(at_a[same] + 1, len(a)), np.append(at_b[to[same]] + 1, len(b))

    def align(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple:
        """Alignments of windows that lie one after another in a and b, up to their ends. A group ends where both have an end.

        The ids in the order of the groups' text, marked by the sign that follows, and where those of a window end; the windows' numbers
        of groups and of links; the linked pairs (a << 32 | b), each as often as it is linked, and where those of a window end; and by
        window the pairs of groups of many links with their numbers.
        """
        ends = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        to = np.searchsorted(ends[1], ends[0])
        same = np.flatnonzero(ends[1][to] == ends[0])
        to_a, to_b = same + 1, to[same] + 1
        from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        of_a, of_b = np.repeat(np.arange(len(same)), to_a - from_a), np.repeat(np.arange(len(same)), to_b - from_b)
        marked = np.empty(len(a) + len(b), np.uint32)
        sign_a, sign_b = np.zeros(len(a), np.uint32), np.zeros(len(b), np.uint32)
        sign_a[to_a - 1], sign_b[to_b - 1] = BAR, END
        marked[np.arange(len(a)) + from_b[of_a]] = a | sign_a
        marked[np.arange(len(b)) + to_a[of_b]] = b | sign_b
        product = (to_a - from_a) * (to_b - from_b)
        times = np.where(product <= MANY, to_b - from_b, 0)[of_a]
        total = np.cumsum(times)
        partner = np.repeat(from_b[of_a] - total + times, times) + np.arange(total[-1])
        pairs = np.repeat(a.astype(np.int64) << 32, times) | b[partner]
        group, linked = np.searchsorted(to_a, end_a, "right"), np.append(0, np.cumsum(product))
        more = {}
        for g in np.flatnonzero(product > MANY):
            cb = Counter(b[from_b[g]:to_b[g]].tolist())
            more.setdefault(int(np.searchsorted(group, g, "right")), []).extend(
                (p << 32 | q, k * m) for p, k in Counter(a[from_a[g]:to_a[g]].tolist()).items() for q, m in cb.items())

        return (marked, end_a + end_b, np.diff(group, prepend=0), np.diff(linked[group], prepend=0), pairs, total[end_a - 1], more)

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple:
        """Marked ids, number of groups and of links, linked pairs (each as often as it is linked) and pairs with their numbers of a text.

        A window of one id on either side is one group and one link. Others are looked up by their ids (of a, then of b, marked) where these
        are known; the rest is aligned together and kept.
        """
        end_a, end_b = self.windows(a, b)
        size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        single = (size_a == 1) & (size_b == 1)
        one_a, one_b = end_a[single] - 1, end_b[single] - 1
        marked, place = np.empty(len(a) + len(b), np.uint32), one_a + one_b
        marked[place], marked[place + 1] = a[one_a] | BAR, b[one_b] | END
        links = a[one_a].astype(np.int64) << 32 | b[one_b]
        if len(place) == len(end_a):
            return marked, len(place), len(place), links, []
        others = np.ones(len(marked), bool)
        others[place] = others[place + 1] = False
        a, b = np.delete(a, one_a), np.delete(b, one_b)
        size_a, size_b = size_a[~single], size_b[~single]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        both = np.empty(len(a) + len(b), np.uint32)
        both[np.arange(len(a)) + np.repeat(end_b - size_b, size_a)] = a
        both[np.arange(len(b)) + np.repeat(end_a, size_b)] = b | OF_B
        raw, cuts = both.tobytes(), (4 * np.append(0, end_a + end_b)).tolist()
        keys = [raw[i:k] for i, k in zip(cuts, cuts[1:])]
        memo = self.memo
        if len(memo.known) > self.cached or max(memo.ids.size, memo.pairs.size) > 1 << 22:
            memo = self.memo = Memo()
        numbers = np.fromiter(map(memo.known.get, keys, repeat(-1)), np.int64, len(keys))
        new = numbers < 0
        if new.any():
            got = self.align(a[np.repeat(new, size_a)], b[np.repeat(new, size_b)], np.cumsum(size_a[new]), np.cumsum(size_b[new]))
            numbers[new] = memo.add([keys[w] for w in np.flatnonzero(new)], *got)
        ids, groups, counts, pairs, apart = memo.get(numbers)
        marked[others] = ids
        return marked, len(place) + groups, len(place) + counts, np.concatenate([links, pairs]), apart

    def text(self, text: str) -> tuple:
        """n_a, n_b, n_groups, n_links, groups, pairs, links of a text."""
        a, b = self.encode(text)
        if not len(a):
            return 0, 0, 0, 0, "", NONE, NONE
        marked, groups, links, pairs, apart = self.aligned(a, b)
        written = self.names[marked].tobytes().translate(None, b"\0")[:-1].decode()
        found, times = np.unique(pairs, return_counts=True)
        if apart:
            more = Counter(dict(zip(found.tolist(), times.tolist())))
            for p, n in apart:
                more[p] += n
            found, times = (np.fromiter(v, np.int64, len(more)) for v in (more.keys(), more.values()))
        return len(a), len(b), groups, links, written, found, times


@lru_cache(maxsize=2)
def tokenizer_pair(a_path: str | None, b_path: str | None) -> Pair:
    return Pair(a_path, b_path)


def _lists(arrays) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate(arrays), pa.int64()))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Both tokenizations of each text of docs (doc_id, text), side by side: row (a number of its own), doc_id, n_a, n_b, n_groups,
    n_links, groups (`a1,a2|b1;a3|b2,b3`), pairs (linked ids, each pair once, a << 32 | b) and links (how often each).

    A text is cut into windows where both tokenizers have an end before a token that starts with a space; a window's alignment follows
    from its ids alone and is kept by them, but for windows of one id on either side, which are links as they are. Null and empty texts, and those whose bytes a tokenizer does not give back, have no
    tokens: zeros, '' and empty lists. Null ids stay; repeated rows are documents of their own; an empty table gives no rows; other columns are
    not looked at. Row numbers follow the partitions, so write the result before they are used twice.
    """
    def run(batches):
        pair, k = tokenizer_pair(a_path, b_path), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                got = list(zip(*(pair.text(t.as_py()) for t in b.column(1))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(k, k + b.num_rows), pa.int64()), b.column(0), *[pa.array(c, pa.int64()) for c in got[:4]],
                     pa.array(got[4], pa.string()), *map(_lists, got[5:])], NAMES)
                k += b.num_rows
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text")).mapInArrow(run, SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents two ids are linked, and whether no other pair of the same a has more."""
    n = cut_lineage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    most = n.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return n.withColumn("a", F.shiftright("pair", 32)).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_report(docs: DataFrame, frequent: int = 1 << 18, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has its a's highest count), count_sum (counts over all links) and
    groups_sha256 of each document (see align). The alignment is written once, without the groups, beside the checkpoints.

    Pairs that stand for at least one in `frequent` of all (document, pair) rows are broadcast: they are at most `frequent`, of 17 bytes
    each. The others are joined; none of them is a hot key, as each has a smaller share than that.
    """
    spark = docs.sparkSession
    sha = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    path = scratch(spark)
    align(docs, a_path, b_path).withColumn("groups_sha256", sha).drop("groups").write.parquet(path)
    aligned = spark.read.parquet(path)
    counts = cut_lineage(pair_counts(aligned))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.filter(F.col("n") * F.lit(frequent) >= F.lit(rows)).toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "n", "best")))

    def sums(batches):
        pair, n, best = sent.value
        for b in batches:
            p, times = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in (1, 2))
            of = np.repeat(np.arange(b.num_rows), b.column(1).value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(pair, p), max(len(pair) - 1, 0))
            hit = pair[at] == p if len(pair) else np.zeros(len(p), bool)
            good, total, row = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), of[hit]
            np.add.at(total, row, times[hit] * n[at[hit]])
            np.add.at(good, row, times[hit] * best[at[hit]])
            ends = np.append(0, np.cumsum(np.bincount(of[~hit], minlength=b.num_rows))).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v[~hit])) for v in (p, times)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(good), pa.array(total), *rest], ["row", "n_best", "count_sum", "pairs", "links"])

    done = aligned.select("row", "pairs", "links").mapInArrow(sums, "row long, n_best long, count_sum long, pairs array<long>, links array<long>")
    done = cut_lineage(done)
    rare = (done.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("times")))).join(counts, "pair")
                .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("b"), F.sum(F.col("times") * F.col("n")).alias("c")))
    sums_of = done.select("row", "n_best", "count_sum").union(rare.select("row", F.col("b"), F.col("c")))
    sums_of = sums_of.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("pairs", "links").join(sums_of, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
