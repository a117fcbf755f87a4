"""Operator 5, line dedup: an exact set-similarity join of lines."""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, released, text_or_empty

SKETCH_BITS, MAP_BITS = 22, 24
NO_ID = -(1 << 63)  # stands for a null doc_id, the smallest
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
POSTING = ["key", "doc", "line", "meta", "bits", "more_bits", "whole"]
FIRST = np.uint64((1 << MAP_BITS) - 1 << 24)  # bits of a key of two words that come from the first one
PACK = 1 << 18  # posting rows that a task holds before it packs them
SCHEMA = "key long, doc long, line long, meta long, bits long, more_bits long, whole long"
PLACES = ["doc", "line", "cdoc", "cline"]
NAMES = [*PLACES, "sure"]


FACTOR = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
BYTE_VALUES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)


BLOCK = 1 << 20  # bytes of words hashed at once
ENTRY = 250  # bytes that a remembered line takes besides its text


@lru_cache(maxsize=1)
def _block_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(BLOCK)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR^i and FACTOR^-i modulo 2^64 for i < n."""
    out = []
    for f in (FACTOR, pow(FACTOR, -1, 1 << 64)):
        x = np.full(n, f, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x))
    return tuple(out)


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """64-bit hashes of the words: polynomials in FACTOR over random values of the bytes, from running sums over a block of bytes at once, then
    mixed. Blocks end between words, so that only a word longer than a block needs larger tables, for as long as it is hashed."""
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    h, first = np.empty(len(words), np.uint64), 0
    while first < len(words):
        last = max(int(np.searchsorted(ends, ends[first] + BLOCK - 1, "right")) - 1, first + 1)
        at = ends[first:last + 1] - ends[first]
        up, down = _block_powers() if at[-1] < BLOCK else _powers(int(at[-1]) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data[ends[first]:ends[last]]] * up[:at[-1]])])
        h[first:last] = (sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]] + np.diff(at).astype(np.uint64)
        first = last
    for shift, f in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(f)
    return h ^ h >> np.uint64(33)


def _runs(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes of text each; the text is the last column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for i, j in zip(cuts, cuts[1:]):
        if j > i:
            yield batch.slice(i, j - i)


def _words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """For every word of the texts the number of its text and of itself in the array of different words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    flat = lists.flatten().dictionary_encode()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(text)), sizes), flat.indices.to_numpy(zero_copy_only=False), flat.dictionary


def _word_sets(text: pa.Array) -> tuple[np.ndarray, tuple[pa.Array, pa.Array]]:
    """The numbers of different words of the texts, and for every different word of a text the number of the text and the word."""
    owner, number, different = _words(text)
    key = np.unique(owner << 32 | number)
    empty = np.flatnonzero(pc.binary_length(different).to_numpy(zero_copy_only=False) == 0)  # what stands before or after outer white space
    if len(empty):
        key = key[key & 0xFFFFFFFF != empty[0]]
    return np.bincount(key >> 32, minlength=len(text)), (pa.array(key >> 32), different.take(pa.array(key & 0xFFFFFFFF)))


def level(n: float) -> int:
    """Counts in one byte: as they are up to 16, then eight steps for each doubling."""
    return int(n) if n <= 16 else 16 + int(8 * np.log2(n / 16))


def rarity(docs: DataFrame) -> np.ndarray:
    """Levels of the counts of words by their hash, over all texts: a table of fixed size, 2^22 counters of one byte.

    Words are ordered by (level of their counter, hash): one order for all lines, in which rare words come
    first. Words that share a counter only look less rare.
    """
    size = 1 << SKETCH_BITS

    def run(batches):
        total = np.zeros(size, np.int32)
        for b in batches:
            for part in _runs(b):
                words, n = pc.value_counts(pc.ascii_split_whitespace(pc.ascii_lower(part.column(0))).flatten()).flatten()
                np.add.at(total, (word_hashes(words) & np.uint64(size - 1)).astype(np.int64), n.to_numpy().astype(np.int32))
        at = np.flatnonzero(total)
        block = at >> 12
        begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(at) else at
        yield pa.RecordBatch.from_arrays([pa.array(block[begin].astype(np.int32)), _binary((at & 4095).astype("<u2"), begin), _binary(total[at].astype("<i4"), begin)], ["block", "at", "n"])

    def levels_of(batches):
        sums = {}
        for b in batches:
            for block, at, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if block not in sums:
                    sums[block] = np.zeros(4096, np.int64)
                sums[block][np.frombuffer(at.as_buffer(), "<u2")] += np.frombuffer(n.as_buffer(), "<i4")
        for block, n in sums.items():
            steps = np.where(n <= 16, n, 16 + np.floor(8 * np.log2(np.maximum(n, 1) / 16)))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([steps.astype(np.uint8).tobytes()], pa.binary())], ["block", "level"])

    # counters travel in blocks of 4096, those of a task that are not zero
    got = docs.select("text").mapInArrow(released(run), "block int, at binary, n binary").repartition("block").mapInArrow(levels_of, "block int, level binary").toArrow()
    levels = np.zeros(size, np.uint8)
    for block, n in zip(got["block"].to_pylist(), got["level"].to_pylist()):
        levels[block * 4096:(block + 1) * 4096] = np.frombuffer(n, np.uint8)
    return levels


def _binary(values: np.ndarray, begin: np.ndarray) -> pa.BinaryArray:
    """The bytes of the rows of values, cut before the rows at begin, of which the first is 0."""
    ends = (np.append(begin, len(values)) * (values.nbytes // max(len(values), 1))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def first_word(key):
    """The bits of a key (array or column) that are those of the hash of its first word."""
    return key.view(np.int64) >> 24 if isinstance(key, np.ndarray) else F.shiftright(key, 24)


def prefix_length(n: np.ndarray, share: float) -> np.ndarray:
    return n - np.ceil(share * n - 1e-9).astype(np.int64) + 1


def postings(docs: DataFrame, counts: np.ndarray, least_words: int, share: float, hot: int, only: np.ndarray | None = None, buckets: int = 0, words: np.ndarray | None = None) -> DataFrame:
    """Posting rows of all lines; with `buckets`, packed by ranges of keys (see packed).

    A line of n different words has the words of its prefix as keys: the rarest n - ceil(share n) + 1. Words met once
    only have no partner and no posting. A word met more than `hot` times is too common for a key: it is joined
    with each later word of the prefix made one longer, since a similar line shares at least two words. Lines of
    up to three words can only match an equal set, which is their key. bits and more_bits hold for 128 classes of words whether a class has an odd
    number of them, whole is a hash of their set, meta holds n and the place of the key in the prefix. A key holds 24 bits of the hash of its
    first word (see first_word). With `only`, a bitmap of keys, other keys are left out; words, a bitmap of the first words of the same keys, spares the work on lines
    that have none of them; equal lines then all have postings, and lines of up to three words, which have no more to meet, none. A line equal to an earlier one that the task has met has no postings but a row with
    meta < 0 that names that one; what a task remembers of lines is bounded by their bytes.
    """
    model = docs.sparkSession.sparkContext.broadcast((counts, only, words))
    mask = np.uint64((1 << SKETCH_BITS) - 1)

    def sums(op, values, word, begin, n, which):
        """op over the values of the words of some lines, whose words are word[begin:begin + n]."""
        if not len(which):
            return np.zeros(0, values.dtype)
        first = np.cumsum(n[which]) - n[which]
        if len(which) < len(n):
            word = word[np.repeat(begin[which] - first, n[which]) + np.arange(n[which].sum())]
        return op.reduceat(values[word], first)

    def rows_of(doc, line, text, n_words, wanted, first_words):
        """Posting columns of some lines."""
        owner, number, different = _words(text)
        h = word_hashes(different)
        c = n_words[(h & mask).astype(np.int64)].astype(np.int64)
        order = np.lexsort((h, c))
        rank = np.empty(len(h), np.int64)
        rank[order] = np.arange(len(h))
        h, c = h[order], c[order]
        empty = rank[pc.binary_length(different).to_numpy(zero_copy_only=False) == 0]  # what stands before or after outer white space
        if first_words is not None:
            some = np.zeros(len(doc), bool)
            some[owner[is_set(first_words, first_word(h))[rank][number]]] = True
            some = some[owner]
            owner, number = owner[some], number[some]
        key = np.sort(owner << 32 | rank[number])  # each line's words by rarity
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        if len(empty):
            key = key[key & 0xFFFFFFFF != empty[0]]
        owner, word = key >> 32, key & 0xFFFFFFFF
        n = np.bincount(owner, minlength=len(doc))
        keep = n >= max(least_words, 4 if first_words is not None else 0)
        if not keep[n > 0].all():
            keep = keep[owner]
            word, owner = word[keep], owner[keep]
        if not len(word):
            return [np.zeros(0, np.int64)] * len(POSTING)
        begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        who = owner[begin]  # lines that are left
        n = n[who]
        mine = np.repeat(np.arange(len(who)), n)
        k = np.arange(len(word)) - begin[mine]
        mixed = (h ^ h >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        p = np.where(n > 3, prefix_length(n, share), 0)
        pick = np.flatnonzero(k < p[mine])
        if first_words is not None:
            pick = pick[is_set(first_words, first_word(h))[word[pick]]]
        often = c[word[pick]]
        one, many = pick[(often > 1) & (often <= level(hot))], pick[often > level(hot)]
        short = begin[n <= 3]
        some = np.flatnonzero(n <= 3) if wanted is not None else np.arange(len(who))
        whole = np.zeros(len(who), np.uint64)
        whole[some] = sums(np.add, mixed, word, begin, n, some)
        keys, at = [h[word[one]], whole[n <= 3]], [one, short]
        if len(many):
            reach = p[mine[many]] - k[many]  # later words of the longer prefix
            left = np.repeat(many, reach)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(reach) - reach, reach)
            left_word = h[word[left]]
            pair = left_word * np.uint64(0x9E3779B97F4A7C15) + h[word[right]]
            keys.append(pair ^ (pair ^ left_word) & FIRST)
            at.append(left)
        key, at = np.concatenate(keys), np.concatenate(at)
        if wanted is not None:
            seen = np.flatnonzero(is_set(wanted, key.view(np.int64)))
            key, at = key[seen], at[seen]
        m = mine[at]
        if wanted is None:
            has, of = np.arange(len(who)), m
        else:  # few lines have a wanted key: only theirs need bits
            has, of = np.unique(m, return_inverse=True)
            if not len(has):
                return [np.zeros(0, np.int64)] * len(POSTING)
            whole[has] = sums(np.add, mixed, word, begin, n, has)
        bit, half = np.uint64(1) << (h >> np.uint64(58)), (h >> np.uint64(57) & np.uint64(1)).astype(bool)
        bits = [sums(np.bitwise_xor, np.where(side, bit, np.uint64(0)), word, begin, n, has).view(np.int64) for side in (half, ~half)]
        return [key.view(np.int64), doc[who[m]], line[who[m]], n[m] << 32 | k[at], bits[0][of], bits[1][of], whole[m].view(np.int64)]

    def run(batches):
        (n_words, wanted, first_words), met, room = model.value, {}, 0
        enough = lambda t: len(set(t.encode().lower().split())) >= least_words
        known_enough = lru_cache(1 << 12)(enough)
        counts = lambda t: (known_enough if len(t) < 1024 else enough)(t)
        for b in batches:
            for part in _runs(b):
                lists = pc.split_pattern(part.column(1), "\n")
                text, size = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                doc = np.repeat(part.column(0).to_numpy(zero_copy_only=False), size)
                line = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
                if first_words is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows_of(doc, line, text, n_words, wanted, first_words)], POSTING)
                    continue
                new, same = [], [[] for _ in POSTING]
                for r, (t, place) in enumerate(zip(text.to_numpy(zero_copy_only=False).tolist(), zip(doc.tolist(), line.tolist()))):
                    known = met.setdefault(t, place)
                    if known is place:
                        new.append(r)
                        continue
                    if known != place and counts(t):
                        low, high = min(known, place), max(known, place)
                        for col, v in zip(same, (hash(high), *high, -1 - low[1], low[0], 0, 0)):
                            col.append(v)
                    if place < known:
                        met[t] = place
                        new.append(r)
                new = np.array(new, np.int64)
                room += len(new) * ENTRY + int(pc.binary_length(text).to_numpy(zero_copy_only=False)[new].sum())
                cols = rows_of(doc[new], line[new], text.take(pa.array(new)), n_words, wanted, first_words)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x, np.array(y, np.int64)])) for x, y in zip(cols, same)], POSTING)
                if room > 32 << 20:
                    met, room = {}, 0
    if buckets:
        return docs.select("doc", "text").mapInArrow(released(lambda batches: packed(run(batches), buckets)), "bucket int, rows binary")
    return docs.select("doc", "text").mapInArrow(released(run), SCHEMA)


def packed(batches: Iterator[pa.RecordBatch], buckets: int, hold: int = PACK) -> Iterator[pa.RecordBatch]:
    """Batches of posting rows as (bucket, rows): the rows of one range of keys together, 56 bytes each, so that Spark moves and sorts a few
    long rows in place of many short ones. buckets is a power of two."""
    held, size, shift = [], 0, np.uint64(65 - buckets.bit_length())

    def pack():
        rows = np.concatenate(held)
        bucket = (rows[:, 0].view(np.uint64) >> shift).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        return pa.RecordBatch.from_arrays([pa.array(bucket[begin]), _binary(rows[order], begin)], ["bucket", "rows"])

    for b in batches:
        if b.num_rows:
            for k in range(0, b.num_rows, hold):
                held.append(np.column_stack([c.slice(k, hold).to_numpy(zero_copy_only=False) for c in b.columns]))
                size += len(held[-1])
                if size >= hold:
                    yield pack()
                    held, size = [], 0
    if held:
        yield pack()


def bucket_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Posting rows, sorted by key and place, of packed rows sorted by bucket: whole buckets, together about `rows` rows or one bucket."""
    held, size, last = [], 0, None

    def rest():
        m = np.frombuffer(b"".join(held), np.int64).reshape(-1, len(POSTING))
        key = m[:, 0].copy()
        order = np.argsort(key)
        key = key[order]
        fresh = key[1:] != key[:-1]
        pick = ~(np.append(True, fresh) & np.append(fresh, True)) | (m[order, 3] < 0)  # a key of one row has no pair
        m = np.ascontiguousarray(m[order[pick]].T)
        order = np.lexsort((m[2], m[1], m[0]))
        return pa.RecordBatch.from_arrays([pa.array(c[order]) for c in m], POSTING)

    for b in batches:
        for bucket, raw in zip(b.column(0).to_pylist(), b.column(1)):
            if bucket != last and size >= rows * 8 * len(POSTING):
                yield rest()
                held, size = [], 0
            last = bucket
            held.append(raw.as_buffer())
            size += held[-1].size
    if held:
        yield rest()


def _passing(n, pos, bits, more_bits, a, b, share: float) -> np.ndarray:
    """Which rows a and b (arrays of row numbers, of lengths that fit) pass the positional and bitmap filters: their numbers in a and b."""
    both = n[a] + n[b]
    least = np.ceil(share / (1 + share) * both - 1e-9)
    ok = np.flatnonzero(np.minimum(n[a] - pos[a], n[b] - pos[b]) >= least)
    a, b, both, least = a[ok], b[ok], both[ok], least[ok]
    # a word that one line alone has flips one bit, so at least as many words differ as bits: an upper bound of the overlap
    unlike = np.bitwise_count(bits[a] ^ bits[b]).astype(np.int64) + np.bitwise_count(more_bits[a] ^ more_bits[b])
    return ok[(both - unlike) // 2 >= least]


def candidates(posts: DataFrame, share: float, every: bool, partitions: int | None, few: int = 8, rows: int = 1 << 17, out: int = 1 << 16,
               once: bool = False) -> DataFrame:
    """(doc, line, cdoc, cline, sure): earlier lines that pass all filters against a line with the same key.

    every=False gives the `few` earliest such lines of each posting, and where there are more a row with cline -1 and the key in cdoc; every=True
    gives all of them for postings whose column `open` is true. Rows stream through sorted by key and place, some `rows` at a time, and pairs
    are given out once there are `out` of them, so that a task holds the rows of one key but never its pairs. posts may be packed (bucket,
    rows): a task then holds the rows of one bucket. once=True lets of lines with equal sets of words only the earliest take part: the others are
    settled by it (every=False names them with it, under the keys of their first word), and what matches one of them matches it too.
    """
    cols = POSTING + (["open"] if every else [])
    names = NAMES

    def pairs(key, doc, line, meta, bits, more_bits, whole, open_):
        """Pairs within whole key groups given as arrays: all rows of the groups meet the first row, then the second, and so on."""
        if once:
            order = np.lexsort((whole, key))  # stable: equal sets stay in the order of their places
            a, b = order[:-1], order[1:]
            run = np.append(True, (key[a] != key[b]) | (whole[a] != whole[b]) | (meta[a] != meta[b]))
            lead = order[np.flatnonzero(run)[np.cumsum(run) - 1]]
            told = ~run & (meta[order] & 0xFFFFFFFF == 0) & ((doc[order] != doc[lead]) | (line[order] != line[lead]))
            x, y = (order[told], lead[told]) if open_ is None else (order[:0], lead[:0])
            for k in range(0, len(x), out):
                yield pa.RecordBatch.from_arrays([pa.array(c[i[k:k + out]]) for i in (x, y) for c in (doc, line)] + [pa.array(np.ones(len(x[k:k + out]), bool))], names)
            pick = np.sort(order[run])
            key, doc, line, meta, bits, more_bits, whole = (c[pick] for c in (key, doc, line, meta, bits, more_bits, whole))
            open_ = None if open_ is None else open_[pick]
        n, pos = meta >> 32, meta & 0xFFFFFFFF
        bits, more_bits = bits.view(np.uint64), more_bits.view(np.uint64)  # signed counts would be of absolute values
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        head = np.repeat(start, size)
        at = np.arange(len(key)) - head
        found, more = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        x_all, y_all, ready = [], [], 0

        def batch(x, y):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[x], line[x], doc[y], line[y], (whole[x] == whole[y]) & (n[x] == n[y]))], names)

        live = np.flatnonzero(at > 0) if open_ is None else np.flatnonzero((at > 0) & open_)
        live = live[np.argsort(-at[live], kind="stable")]  # those that still meet a row r come first
        short = n.astype(np.int32)
        low, high = np.ceil(share * n - 1e-9).astype(np.int32), np.floor((n + 1e-6) / share).astype(np.int64)  # numbers of words of similar lines
        r, left, done = 0, at[live], 0
        first, low, high = head[live], low[live], high[live]
        while len(live):
            nb = short[first + r]
            fit = np.flatnonzero((nb >= low) & (nb <= high))
            x, y = live[fit], first[fit] + r
            hit = _passing(n, pos, bits, more_bits, x, y, share)
            x, y = x[hit], y[hit]
            hit = ((doc[x] != doc[y]) | (line[x] != line[y])) & ~more[x]
            x, y = x[hit], y[hit]
            if open_ is None:
                over = found[x] >= few
                more[x[over]] = True
                done += int(over.sum())
                x, y = x[~over], y[~over]
            found[x] += 1
            if len(x):
                x_all.append(x)
                y_all.append(y)
                ready += len(x)
            r += 1
            alive = int(np.searchsorted(-left, -r))
            live, first, left, low, high = (c[:alive] for c in (live, first, left, low, high))
            if done * 8 > alive:
                stay, done = ~more[live], 0
                live, first, left, low, high = (c[stay] for c in (live, first, left, low, high))
            if ready >= out or ready and not len(live):
                x, y = np.concatenate(x_all), np.concatenate(y_all)
                x_all, y_all, ready = [], [], 0
                for k in range(0, len(x), out):
                    yield batch(x[k:k + out], y[k:k + out])
        z = np.flatnonzero(more)
        if len(z):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[z], line[z], key[z], np.full(len(z), -1), np.zeros(len(z), bool))], names)

    def run(batches):
        held, size = [], 0

        def groups(columns):
            return pairs(*columns[:7], columns[7] if every else None)

        for b in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            known = now[3] < 0
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (now[1][known], now[2][known], now[4][known], -1 - now[3][known], np.ones(known.sum(), bool))], names)
                now = [c[~known] for c in now]
            held.append(now)
            size += len(now[0])
            if size >= rows:
                columns = [np.concatenate(c) for c in zip(*held)]
                cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last key may go on in the next batch
                if cut:
                    yield from groups([c[:cut] for c in columns])
                held = [[c[cut:].copy() for c in columns]]
                size = 0  # the rest goes with the next rows
        if held:
            columns = [np.concatenate(c) for c in zip(*held)]
            if len(columns[0]):
                yield from groups(columns)

    if "bucket" in posts.columns:
        return (posts.repartition(partitions, "bucket").sortWithinPartitions("bucket")
                     .mapInArrow(released(lambda batches: run(bucket_batches(batches, rows))), "doc long, line long, cdoc long, cline long, sure boolean"))
    by = ["key"] if partitions is None else [partitions, "key"]  # None: as many as Spark finds right for the rows that there are
    return (posts.select(*cols).repartition(*by).sortWithinPartitions("key", "doc", "line")
                 .mapInArrow(released(run), "doc long, line long, cdoc long, cline long, sure boolean"))


def bitmap(df: DataFrame, value: Column) -> np.ndarray:
    """A bitmap of fixed size (2 MB) with the bit of every value set."""
    bit = F.pmod(value, F.lit(1 << MAP_BITS)) + 1  # Spark's bitmaps count from 1
    got = (df.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m")).toArrow())
    marks = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    for n, m in zip(got["n"].to_pylist(), got["m"].to_pylist()):
        marks[(n - 1) * 4096:n * 4096] = np.frombuffer(m, np.uint8)
    return marks


def is_set(marks: np.ndarray, value: np.ndarray) -> np.ndarray:
    at = value % (1 << MAP_BITS)
    return (marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def lines_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc, line, t): the lines at the given places (doc, line), and a few more. A bitmap of places of fixed size (2 MB) is
    broadcast; lines whose bit is not set stay where they are. When places fill it, more lines travel, none is lost."""
    share = docs.sparkSession.sparkContext.broadcast(bitmap(places, F.pmod(F.col("doc"), F.lit(1 << 31)) * 1000003 + F.col("line")))

    def run(batches):
        on = share.value
        for b in batches:
            lists = pc.split_pattern(b.column(1), "\n")
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            doc = np.repeat(b.column(0).to_numpy(zero_copy_only=False), size)
            line = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
            pick = np.flatnonzero(is_set(on, doc % (1 << 31) * 1000003 + line))
            yield pa.RecordBatch.from_arrays([pa.array(doc[pick]), pa.array(line[pick]), lists.flatten().take(pa.array(pick))], ["doc", "line", "t"])
    return docs.select("doc", "text").mapInArrow(released(run), "doc long, line long, t string")


def verified(docs: DataFrame, pairs: DataFrame, share: float) -> DataFrame:
    """The pairs (doc, line, cdoc, cline) whose word sets have a Jaccard similarity of at least `share`, from the texts."""
    places = pairs.select("doc", "line").union(pairs.select("cdoc", "cline")).distinct()
    # rows that repeat a doc_id hold several texts at one place: a pair is right if some texts of its places match
    texts = cut_lineage(lines_at(docs, places))
    a = pairs.join(texts.withColumnRenamed("t", "ta"), ["doc", "line"])
    b = a.join(texts.select(F.col("doc").alias("cdoc"), F.col("line").alias("cline"), F.col("t").alias("tb")), ["cdoc", "cline"])

    def run(batches):
        for c in batches:
            for part in _runs(c):
                (na, a), (nb, b) = (_word_sets(part.column(k)) for k in (4, 5))
                places, words = pa.concat_arrays([a[0], b[0]]), pa.concat_arrays([a[1], b[1]]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                key = np.sort(places.to_numpy() << 32 | words)
                both = np.bincount(key[1:][key[1:] == key[:-1]] >> 32, minlength=part.num_rows)
                yield part.select(PLACES).filter(pa.array(both >= share * (na + nb - both) - 1e-9))
    return b.select(*PLACES, "ta", "tb").mapInArrow(released(run), "doc long, line long, cdoc long, cline long")


def later_matches(docs: DataFrame, share: float = 0.8, least_words: int = 1, hot: int = 1 << 14) -> DataFrame:
    """(doc, line) of every line that a similar line stands before.

    docs has doc (never null) and text. Order is that of (doc, line number). The first round tries the earliest few candidates of each
    posting, which nearly always settles a line. A line whose tried candidates all failed but which has more is then held
    against all of them, so no match is lost.
    """
    d = docs.select("doc", "text")
    counts = rarity(d)
    partitions = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 1 << max(12, (16 * partitions - 1).bit_length())
    first = cut_lineage(candidates(postings(d, counts, least_words, share, hot, None, buckets), share, False, partitions, once=True).groupBy("doc", "line", "cdoc", "cline").agg(F.max("sure").alias("sure")))
    pairs, more = first.filter("cline >= 0"), first.filter("cline < 0").select("doc", "line", F.col("cdoc").alias("key"))
    place = F.struct("cdoc", "cline")
    lines = cut_lineage(pairs.groupBy("doc", "line").agg(F.max("sure").alias("sure"), F.min(place).alias("c")))
    good = lines.filter("sure").select("doc", "line")
    todo = lines.filter("not sure")
    if todo.isEmpty():
        return good
    # the earliest candidate settles most lines; the other ones are read for those it does not
    settled = cut_lineage(verified(d, todo.select("doc", "line", "c.cdoc", "c.cline"), share).select("doc", "line").distinct())
    good, todo = good.union(settled), cut_lineage(todo.join(settled, ["doc", "line"], "left_anti"))
    others = cut_lineage(pairs.join(todo.select("doc", "line", "c"), ["doc", "line"]).filter(place != F.col("c")).select("doc", "line", "cdoc", "cline"))
    if not others.isEmpty():
        settled = cut_lineage(verified(d, others, share).select("doc", "line").distinct())
        good, todo = good.union(settled), todo.join(settled, ["doc", "line"], "left_anti")
    failed = cut_lineage(more.join(todo.select("doc", "line"), ["doc", "line"], "left_semi"))
    if failed.isEmpty():
        return good
    # the whole posting lists in which such lines have more candidates, and no other lists
    rest = postings(d, counts, least_words, share, hot, bitmap(failed, F.col("key")), words=bitmap(failed, first_word(F.col("key")))).filter("meta >= 0")
    rest = rest.join(failed.withColumn("open", F.lit(True)), ["doc", "line", "key"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    again = candidates(rest, share, True, None, once=True).select("doc", "line", "cdoc", "cline").distinct()
    return good.union(verified(d, cut_lineage(again), share).select("doc", "line").distinct())


def repeated_lines(docs: DataFrame, share: float = 0.8, least_words: int = 1, hot: int = 1 << 14) -> DataFrame:
    """One row per doc_id that has repeated lines: doc_id, removed array<int>, the numbers of its lines (from 0) that go.

    A line is the text between newlines, its tokens are the different words (A-Z lower-cased, split at white space). It goes if a line
    earlier in the order of (doc_id, number) has a Jaccard similarity of at least `share`; the first of each chain
    stays. Lines without a word are never removed, nor are lines of fewer than `least_words` different words where more than 1 is asked for. Null text counts as
    empty. A null doc_id comes before all others. Rows that repeat a doc_id are one place and do not remove one another.
    """
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text_or_empty(docs).alias("text"))
    gone = later_matches(d, share, least_words, hot)
    return gone.groupBy("doc").agg(F.array_sort(F.collect_list(F.col("line").cast("int"))).alias("removed")).select(
        F.col("doc").alias("_doc"), "removed")


def dedup_lines(docs: DataFrame, share: float = 0.8, least_words: int = 1, hot: int = 1 << 14) -> DataFrame:
    """docs with the repeated lines taken out of text, and n_chars, where there is such a column, the new length. A document may
    become empty; every row stays, and rows without a repeated line are unchanged."""
    gone = repeated_lines(docs, share, least_words, hot)
    key = F.coalesce(docs.doc_id.cast("long"), F.lit(NO_ID))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda t, i: ~F.array_contains("removed", i)), "\n")
    d = docs.join(gone, key == gone["_doc"], "left").withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(left))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        d = d.withColumn("n_chars", F.when(F.col("removed").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return d.select(*docs.columns)


def line_report(docs: DataFrame, share: float = 0.8, least_words: int = 1, hot: int = 1 << 14) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_removed, removed (line numbers, comma-joined)."""
    t = text_or_empty(docs)
    n = (F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("long")
    d = docs.select("doc_id", n.alias("n_lines"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"))
    gone = repeated_lines(docs, share, least_words, hot)
    lines = F.coalesce("removed", F.array().cast("array<int>"))
    return d.join(gone, "_doc", "left").select("doc_id", "n_lines", F.size(lines).cast("long").alias("n_removed"), F.array_join(lines.cast("array<string>"), ",").alias("removed"))


def report_sql(share: str = "0.8", least_words: int = 1) -> str:
    """The rows of line_report by joining lines on the words of their prefixes in order of rarity."""
    return rf"""WITH l AS (SELECT doc_id, line - 1 AS line, list_distinct(list_filter(regexp_split_to_array(translate(t, '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line FROM documents)),
s AS (SELECT *, row_number() OVER (ORDER BY doc_id, line) AS id, len(w) AS n FROM l WHERE len(w) >= {least_words}),
tok AS (SELECT id, n, unnest(w) AS x FROM s),
df AS (SELECT x, count(*) AS c FROM tok GROUP BY x),
pre AS (SELECT id, n, x FROM (SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY c, x) AS k FROM tok JOIN df USING (x)) WHERE k <= n - ceil({share} * n - 1e-9) + 1),
pairs AS (SELECT DISTINCT b.id AS later, a.id AS earlier FROM pre a JOIN pre b ON a.x = b.x AND a.id < b.id AND a.n >= {share} * b.n - 1e-9 AND b.n >= {share} * a.n - 1e-9),
gone AS (SELECT DISTINCT p.later AS id FROM pairs p JOIN s a ON a.id = p.earlier JOIN s b ON b.id = p.later
  WHERE len(list_intersect(a.w, b.w)) >= {share} * (a.n + b.n - len(list_intersect(a.w, b.w))) - 1e-9),
by_doc AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed FROM s JOIN gone USING (id) GROUP BY doc_id)
SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN by_doc USING (doc_id)"""
