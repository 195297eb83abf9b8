"""Operator 13: removal of repeated byte strings by a distributed merge of sorted suffix runs.

A byte goes if a string of ``length`` bytes (200) over it also starts anywhere
else. Suffixes are compared from anchors only: of the 169 grams of 32 bytes in
a string, that with the smallest hash (leftmost among equals) is its anchor, so
equal strings have equal anchors at equal places, and about one position in
85 is an anchor. An anchor stands for the strings it is the anchor of, which
start at consecutive places; its suffix ends where the last of them ends, and
the bytes before it back to where the first starts go with it.

Runs: a task sorts the suffixes of a block of anchors. Equal contexts of a
block are one from then on (all their strings repeat, whatever other blocks
hold). The suffixes are dealt to ranges by the hash of their first 32 bytes,
since only suffixes with equal grams can share a string, a range a task, and leave front-coded:
the length of the prefix shared with the suffix before, then the rest.

Merge: a range combines its runs by a loser tree over those lengths. Of two
suffixes the one that shares more with the last output is the smaller; bytes are
compared only from a shared length on, never a known prefix again, and the tree
yields the shared length of neighbours in the merged order. Strings with offset
o before their anchor repeat if they are in one stretch of shared length
``length - o`` and the o bytes before them are equal too (64-bit hashes, which
may take two unlike strings for equal once in 10**19 comparisons).

Hot grams: how many unlike contexts each gram has is estimated from a sample of
documents, which only balances work. Grams with over ``MOST`` of them, at most
``HOT_GRAMS`` (the commonest), are dealt otherwise: their strings one by one as
128-bit hashes, each to the range that its own hash names, where equal ones are
counted; a block sends a string once. So a passage in a third of
all documents meets in no task, and a range holds no gram with more than ``MOST``
contexts, or a millionth of all. Intervals are merged a document and block before
they are shuffled, and texts are shuffled once, to their intervals.

Defined results: a null text is an empty one; texts of under ``length`` bytes
keep all; repeated rows repeat each other whole; doc_id may be null or repeated
(rows are known by a 128-bit hash of id and text, equal rows having equal
results); other columns stay, whatever their names, where an added column's name
is taken it ends in an underscore; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import load, written

LENGTH = 200
GRAM = 32
TEXT = 8_000_000  # bytes of texts that are hashed together; a longer text is alone
BLOCK = 100_000  # anchors of a sorted run
SLICE = (1 << 20) - 1024  # string starts that are hashed at a time
RANGE_BYTES = 24_000_000  # suffixes and what stands before them, a range
MOST = 20_000  # contexts of a gram that a range takes
HOT_GRAMS = 1_000_000  # 8 MB
BATCH = 2_000_000  # bytes of rows that leave Python together
SAMPLE = 1 / 16  # of the documents, for the numbers of contexts
NEEDS = (1, 2)  # kinds of a suffix: one document waits for the verdict; several have it already

_rng = np.random.default_rng(20)
BYTES = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
INVERSES = [pow(b, -1, 1 << 64) for b in BASES]


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, size: int, family: int = 0) -> np.ndarray:
    """A hash of each ``size`` bytes of the last axis, by differences of running sums."""
    n = data.shape[-1]
    sums = np.zeros((*data.shape[:-1], n + 1), np.uint64)
    np.cumsum(BYTES[family][data] * powers(BASES[family], n), axis=-1, out=sums[..., 1:])
    return mixed((sums[..., size:] - sums[..., :-size]) * powers(INVERSES[family], n - size + 1))


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of ``length`` bytes inside the texts [start, end): place, gram hash, first and last string start."""
    edge = np.zeros(len(data) + 1, np.int8)
    long = ends - starts >= length
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, ends[long] - length + 1, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    w = length - gram + 1
    low = np.uint64((1 << 20) - 1)
    found = []
    for s in range(0, max(0, len(data) - length + 1), SLICE):
        stop = min(s + SLICE, len(data) - length + 1)
        valid = np.flatnonzero(inside[s:stop])
        if not len(valid):
            continue
        h = gram_hashes(data[s : stop + length - 1], gram)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        padded = np.concatenate([key, np.full(-len(key) % w, ~np.uint64(0))]).reshape(-1, w)
        before = np.minimum.accumulate(padded, 1).ravel()
        after = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
        at = (np.minimum(after[valid], before[valid + w - 1]) & low).astype(np.int64)
        new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[new[1:], len(at)] - 1
        found.append((at[new] + s, h[at[new]], valid[new] + s, valid[last] + s))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    place, h, first, final = (np.concatenate(x) for x in zip(*found))
    # an anchor whose strings lie in two slices is found in both
    again = np.flatnonzero(place[1:] == place[:-1])
    final[again] = final[again + 1]
    keep = np.ones(len(place), bool)
    keep[again + 1] = False
    return place[keep], h[keep], first[keep], final[keep]


def shared(a: bytes, b: bytes, start: int) -> int:
    """The length of the common prefix of two strings that share ``start`` bytes."""
    end = min(len(a), len(b))
    while start < end and a[start : start + 16] == b[start : start + 16]:
        start += 16
    start = min(start, end)
    while start < end and a[start] == b[start]:
        start += 1
    return start


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Run numbers in merged order, and each output's shared length with the one before it.

    A run is its sorted strings and the length each shares with its
    predecessor. ``known`` is what a run's next string shares with the last
    output; -1 means that the run is over.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    at = [0] * leaves
    known = [0 if r < len(runs) and runs[r][0] else -1 for r in range(leaves)]
    now = [runs[r][0][0] if known[r] == 0 else b"" for r in range(leaves)]
    tree = [0] * leaves

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's known length becomes that with the winner."""
        p, q = known[x], known[y]
        if p > q:
            return x, y
        if q > p:
            return y, x
        if p < 0:
            return x, y
        a, b = now[x], now[y]
        n = shared(a, b, p)
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            known[y] = n
            return x, y
        known[x] = n
        return y, x

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        w, tree[node] = play(build(2 * node), build(2 * node + 1))
        return w

    order, lengths = [], []
    w = build(1)
    while known[w] >= 0:
        order.append(w)
        lengths.append(known[w])
        strings, prefixes = runs[w]
        at[w] = i = at[w] + 1
        if i < len(strings):
            known[w], now[w] = prefixes[i], strings[i]
        else:
            known[w] = -1
        node = (leaves + w) >> 1
        while node:
            r = tree[node]
            q = known[r]
            if q > known[w]:
                tree[node], w = w, r
            elif q == known[w] and q >= 0:
                w, tree[node] = play(w, r)
            node >>= 1
    return order, lengths


def spans_of(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal runs that the intervals of each document cover."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    shift = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])]) * (int(end.max()) + 1)  # documents one behind the other
    reach = np.maximum.accumulate(end + shift)
    new = np.r_[True, start[1:] + shift[1:] > reach[:-1]]
    new[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], start[first], reach[last] - shift[last]


# rows of a run: kind 0 intervals (a document's starts and ends), 1 a run of suffixes for a range, 2 strings of hot grams for a range
ROWS = "kind int, range int, k1 array<long>, k2 array<long>, starts array<int>, ends array<int>, h1 array<long>, h2 array<long>, runs array<binary>"
HOT = ["h1", "h2", "k1", "k2", "starts", "ends"]
_NAMES = ["kind", "range", "k1", "k2", "starts", "ends", "h1", "h2", "runs"]
_TYPES = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(_NAMES, _TYPES)], _NAMES)


def _batches(rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH`` bytes: a block has a row for each range, so most are small."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(x.nbytes for x in row.values() if isinstance(x, np.ndarray)) + sum(map(len, row.get("runs", ())))
        if size >= BATCH:
            yield _rows(held)
            held, size = [], 0
    if held:
        yield _rows(held)


def _interval_row(keys: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray, range_: int) -> dict:
    doc, start, end = spans_of(doc, start, end)
    return {"kind": 0, "range": range_, "k1": keys[doc, 0], "k2": keys[doc, 1], "starts": start, "ends": end}


def _hot_rows(keys: np.ndarray, s: "Suffixes", range_: int, ranges: int, length: int) -> Iterator[dict]:
    """Hash, document and start of every string of the suffixes, by ranges that the hashes name; an end of 0 where the verdict is known, as it is for equal strings here."""
    for low in range(0, len(s.left), 2000):
        part = slice(low, low + 2000)
        sizes = [len(a) + len(b) for a, b in zip(s.left[part], s.right[part])]
        width = max(max(sizes), length)
        m = np.frombuffer(b"".join((a + b).ljust(width, b"\0") for a, b in zip(s.left[part], s.right[part])), np.uint8).reshape(-1, width)
        n = np.array(sizes) - length + 1
        row = np.repeat(np.arange(len(n)), n)
        o = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        h = np.stack([gram_hashes(m, length, f)[row, o] for f in (0, 1)], 1).view(np.int64)
        _, at, count = np.unique(h, axis=0, return_inverse=True, return_counts=True)
        several = s.kind[part][row] == NEEDS[1]
        times = np.bincount(at.ravel(), weights=1 + several)[at.ravel()]
        start = s.place[part][row] - np.array([len(x) for x in s.left[part]])[row] + o
        wait = ~several & (times == 1)
        sure = ~several & (times > 1)
        if sure.any():
            yield _interval_row(keys, s.doc[part][row[sure]], start[sure], start[sure] + length, range_)
        once = np.unique(at.ravel()[times > 1], return_index=True)[1]
        known = np.flatnonzero(times > 1)[once]
        none = np.zeros(len(known), np.int64)
        columns = {"h1": np.r_[h[wait, 0], h[known, 0]], "h2": np.r_[h[wait, 1], h[known, 1]], "k1": np.r_[keys[s.doc[part][row[wait]], 0], none],
                   "k2": np.r_[keys[s.doc[part][row[wait]], 1], none], "starts": np.r_[start[wait], none], "ends": np.r_[start[wait] + length, none]}
        to = (columns["h1"].view(np.uint64) % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
            yield {"kind": 2, "range": int(to[at[0]]), **{name: x[at] for name, x in columns.items()}}


def counted(h1: np.ndarray, h2: np.ndarray, k1: np.ndarray, k2: np.ndarray, starts: np.ndarray, ends: np.ndarray, range_: int) -> Iterator[dict]:
    """Intervals of a range's strings of hot grams: those that two blocks have, or one has more often (end 0)."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) - 1
    hit = (np.bincount(at, weights=1 + (ends == 0))[at] > 1) & (ends > 0)
    if hit.any():
        keys, doc = np.unique(np.stack([k1[hit], k2[hit]], 1), axis=0, return_inverse=True)
        yield _interval_row(keys, doc.ravel(), starts[hit].astype(np.int64), ends[hit].astype(np.int64), range_)


class Suffixes:
    """Suffixes with what stands before them, in the order of a run or range."""

    def __init__(self, right: list[bytes], left: list[bytes], doc: np.ndarray, place: np.ndarray, kind: np.ndarray):
        self.right, self.left, self.doc, self.place, self.kind = right, left, doc, place, kind

    def take(self, at: np.ndarray) -> "Suffixes":
        i = at.tolist()
        return Suffixes([self.right[x] for x in i], [self.left[x] for x in i], self.doc[at], self.place[at], self.kind[at])

    def lengths(self) -> np.ndarray:
        """What each suffix shares with the one before it."""
        found = [np.zeros(min(1, len(self.right)), np.int64)]
        for low in range(0, len(self.right) - 1, 5000):
            part = self.right[low : low + 5001]
            size = np.array(list(map(len, part)), np.int64)
            width = int(size.max())
            m = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in part), np.uint8).reshape(-1, width)
            unlike = m[1:] != m[:-1]
            n = np.where(unlike.any(1), unlike.argmax(1), width)
            found.append(np.minimum(n, np.minimum(size[1:], size[:-1])))
        return np.concatenate(found)

    def packed(self, prefixes: np.ndarray, keys: np.ndarray) -> list[bytes]:
        """Front-coded: shared lengths, the rest of each suffix, what stands before it, and where it is."""
        used, doc = np.unique(self.doc, return_inverse=True)
        tails = b"".join(r[p:] for r, p in zip(self.right, prefixes.tolist()))
        sizes = np.array([[len(r) for r in self.right], [len(x) for x in self.left]], np.uint16)
        numbers = [np.array([len(self.right), len(used), len(tails)], np.int64), prefixes.astype(np.uint16), sizes, self.kind.astype(np.uint8), doc.astype(np.int32), self.place.astype(np.int32), keys[used].astype(np.int64)]
        return [b"".join(x.tobytes() for x in numbers), pa.compress(tails + b"".join(self.left), codec="zstd", asbytes=True), len(tails + b"".join(self.left)).to_bytes(8, "little")]


def unpacked(run: list[bytes]) -> tuple[Suffixes, list[int], np.ndarray]:
    """Suffixes, shared lengths and document keys of a packed run."""
    n, docs, tail_bytes = np.frombuffer(run[0], np.int64, 3).tolist()
    at = 24
    got = []
    for kind, count in ((np.uint16, n), (np.uint16, 2 * n), (np.uint8, n), (np.int32, n), (np.int32, n), (np.int64, 2 * docs)):
        got.append(np.frombuffer(run[0], kind, count, at))
        at += got[-1].nbytes
    prefixes, sizes, kind, doc, place, keys = got
    data = pa.decompress(run[1], int.from_bytes(run[2], "little"), codec="zstd", asbytes=True)
    prefixes, (rights, lefts) = prefixes.tolist(), sizes.reshape(2, n).tolist()
    right, left, last, i, j = [], [], b"", 0, tail_bytes
    for p, r, x in zip(prefixes, rights, lefts):
        last = last[:p] + data[i : i + r - p]
        right.append(last)
        left.append(data[j : j + x])
        i, j = i + r - p, j + x
    return Suffixes(right, left, doc.astype(np.int64), place.astype(np.int64), kind), prefixes, keys.reshape(docs, 2)


def alike(data: bytes, place: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each anchor the first one with the same context at the same place in it."""
    seen: dict[tuple[int, bytes], int] = {}
    return np.array([seen.setdefault((x - y, data[y:z]), i) for i, (x, y, z) in enumerate(zip(place.tolist(), first.tolist(), end.tolist()))], np.int64)


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, slice]]:
    """Texts of some rows joined, with their starts and ends, about ``TEXT`` bytes at a time."""
    text = batch["text"].cast(pa.large_binary())
    size = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1])
    cut = np.flatnonzero(np.diff((np.cumsum(size) - size) // TEXT)) + 1
    for i, j in zip(np.r_[0, cut].tolist(), np.r_[cut, len(size)].tolist()):
        end = np.cumsum(size[i:j])
        yield b"".join(x.as_py() for x in text[i:j]), end - size[i:j], end, slice(i, j)


def sorted_runs(data: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, ranges: int, hot_grams: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[dict]:
    """Rows of ``ROWS`` for the texts [start, end) of ``data``; ``hot_grams`` are sorted hashes."""
    place, h, first, final = anchors(np.frombuffer(data, np.uint8), starts, ends, length, gram)
    owner = np.searchsorted(starts, place, "right") - 1
    while len(owner) and (off := ends[owner] <= place).any():  # empty texts start where others do
        owner[off] -= 1
    range_of = (mixed(h + np.uint64(7)) % np.uint64(ranges)).astype(np.int64)
    for low in range(0, len(place), BLOCK):
        b = slice(low, low + BLOCK)
        p, f, e, o = place[b], first[b], final[b] + length, owner[b]
        same = alike(data, p, f, e)
        count = np.bincount(same, minlength=len(p))
        sure = count[same] > 1
        if sure.any():
            yield _interval_row(keys, o[sure], f[sure] - starts[o[sure]], e[sure] - starts[o[sure]], int(range_of[b][0]))
        one = np.flatnonzero(count)
        # sorted by range, then suffix
        names = [int(r).to_bytes(4, "big") + data[x:z] for r, x, z in zip(range_of[b][one].tolist(), p[one].tolist(), e[one].tolist())]
        one = one[np.array(sorted(range(len(one)), key=names.__getitem__), np.int64)]
        s = Suffixes([data[x:z] for x, z in zip(p[one].tolist(), e[one].tolist())], [data[y:x] for y, x in zip(f[one].tolist(), p[one].tolist())],
                     o[one], p[one] - starts[o[one]], np.where(count[one] > 1, NEEDS[1], NEEDS[0]))
        r = range_of[b][one]
        prefixes = s.lengths()
        hot = np.isin(h[b][one], hot_grams)
        if hot.any():
            yield from _hot_rows(keys, s.take(np.flatnonzero(hot)), int(range_of[b][0]), ranges, length)
            s, r = s.take(np.flatnonzero(~hot)), r[~hot]
            prefixes = s.lengths()
        cuts = np.flatnonzero(np.r_[True, r[1:] != r[:-1], True]) if len(r) else np.zeros(1, np.int64)
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            lengths = prefixes[i:j].copy()
            lengths[0] = 0
            yield {"kind": 1, "range": int(r[i]), "runs": s.take(np.arange(i, j)).packed(lengths, keys)}


def repeated(s: Suffixes, prefixes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, first and last start (as bytes before the anchor) of the suffixes that hold a repeated string."""
    n = len(s.right)
    before = np.array(list(map(len, s.left)), np.int64)
    least = length - np.array(list(map(len, s.right)), np.int64)  # the last string starts so many bytes before the anchor
    width = int(before.max()) if n else 0
    back = np.frombuffer(b"".join(x[::-1].ljust(width, b"\0") for x in s.left), np.uint8).reshape(n, width)
    times = np.where(s.kind == NEEDS[1], 2, 1)
    most, fewest = np.full(n, -1), np.full(n, length + 1)
    left = np.zeros(n, np.uint64)
    following = np.r_[prefixes[1:], 0]
    base = np.uint64(BASES[1])
    for o in range(width + 1):
        if o:
            left = left * base + BYTES[1][back[:, o - 1]]
        depth = length - o
        near = np.flatnonzero((least <= o) & (o <= before) & ((prefixes >= depth) | (following >= depth)))
        if not len(near):
            continue
        stretch = np.cumsum(prefixes < depth)[near].astype(np.uint64)
        key = mixed(left[near] + stretch * np.uint64(0xA0761D6478BD642F))
        _, at = np.unique(key, return_inverse=True)
        twice = near[(np.bincount(at, weights=times[near])[at] > 1)]
        most[twice] = np.maximum(most[twice], o)
        fewest[twice] = np.minimum(fewest[twice], o)
    hit = np.flatnonzero((most >= 0) & (s.kind == NEEDS[0]))
    return hit, most[hit], fewest[hit]


def merged(runs: list[list[bytes]], range_: int, length: int = LENGTH, gram: int = GRAM) -> Iterator[dict]:
    """Intervals of a range from its packed runs."""
    parts = [unpacked(x) for x in runs]
    order, lengths = merge([(s.right, p) for s, p, _ in parts])
    order, lengths = np.array(order, np.int64), np.array(lengths, np.int64)
    sizes = [len(s.right) for s, _, _ in parts]
    base = np.cumsum(sizes) - sizes
    at = np.empty(len(order), np.int64)  # outputs of a run come in its order
    at[np.argsort(order, kind="stable")] = np.arange(len(order))
    near = np.flatnonzero((lengths >= gram) | (np.r_[lengths[1:], 0] >= gram))
    if not len(near):
        return
    lengths = lengths[near]
    of, i = order[near], at[near] - base[order[near]]
    docs = np.cumsum([0] + [len(k) for _, _, k in parts])
    keys = np.concatenate([k for _, _, k in parts])
    pick = lambda name: np.array([getattr(parts[r][0], name)[x] for r, x in zip(of.tolist(), i.tolist())])
    s = Suffixes([parts[r][0].right[x] for r, x in zip(of.tolist(), i.tolist())], [parts[r][0].left[x] for r, x in zip(of.tolist(), i.tolist())],
                 pick("doc") + docs[of], pick("place"), pick("kind"))
    n, most, fewest = repeated(s, lengths, length)
    if len(n):
        yield _interval_row(keys, s.doc[n], s.place[n] - most, s.place[n] - fewest + length, range_)


def row_keys(*cols: str) -> list[Column]:
    """Two 64-bit hashes of a row's id and text."""
    c = [F.coalesce(F.col(x).cast("string"), F.lit("")) for x in cols]
    n = [F.col(x).isNull() for x in cols]
    return [F.xxhash64(*c, *n), F.xxhash64(F.lit(13), *n, *reversed(c))]


def hot_grams(keyed: DataFrame, most: int = MOST, sample: float = SAMPLE, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Hashes of the grams with over ``most`` unlike contexts, by estimate, sorted; ``HOT_GRAMS`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, starts, ends, _ in texts_of(batch):
                place, h, first, final = anchors(np.frombuffer(data, np.uint8), starts, ends, length, gram)
                one = np.unique(alike(data, place, first, final + length))
                grams, n = np.unique(h[one], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], ["h", "n"])

    some = keyed.select("text").sample(sample, seed=20) if sample < 1 else keyed.select("text")
    found = some.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > most * sample)
    rows = found.orderBy(F.desc("n"), "h").limit(HOT_GRAMS).select("h").toPandas()
    return np.sort(rows["h"].to_numpy(np.int64).view(np.uint64))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, range_bytes: int = RANGE_BYTES, most: int = MOST, sample: float = SAMPLE) -> DataFrame:
    """(k1, k2, spans) of documents with repeated strings: spans is an array of (start, end), disjoint and ascending."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    per_byte = 2 / (length - gram + 2) * (length + (length - gram) / 2)  # bytes of suffixes a byte of text
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total * per_byte) // range_bytes + 1)
    k1, k2 = row_keys("doc_id", "text")
    keyed = docs.where(F.octet_length("text") >= length).select(k1.alias("k1"), k2.alias("k2"), "text")

    hot_list = spark.sparkContext.broadcast(hot_grams(keyed, most, sample, length, gram))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch["k1"].to_numpy(), batch["k2"].to_numpy()], 1)
            for data, starts, ends, part in texts_of(batch):
                yield from _batches(sorted_runs(data, starts, ends, keys[part], ranges, hot_list.value, length, gram))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # a partition is a range
        strings: dict[int, list] = {}
        for batch in batches:
            kind = np.asarray(batch["kind"])
            for i, r in enumerate(batch["range"].to_pylist()):
                if kind[i] == 0:
                    yield batch.slice(i, 1)
                elif kind[i] == 1:
                    held.setdefault(r, []).append(batch["runs"][i].as_py())
                else:
                    strings.setdefault(r, []).append([batch[c][i].values.to_numpy().copy() for c in HOT])
        for r in list(strings):
            yield from _batches(counted(*map(np.concatenate, zip(*strings.pop(r))), r))
        for r in list(held):
            yield from _batches(merged(held.pop(r), r, length, gram))

    dealt = keyed.mapInArrow(runs, ROWS).repartitionById(ranges, "range")
    found, _ = written(dealt.mapInArrow(combine, ROWS).select("k1", "k2", "starts", "ends"), "repeats")
    sure = found.select(F.explode(F.arrays_zip("k1", "k2", "starts", "ends")).alias("x")).select("x.*")
    each = sure.distinct().groupBy("k1", "k2").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["starts"].value_lengths().to_numpy()
            doc, start, end = spans_of(np.repeat(np.arange(len(sizes)), sizes), *(batch[c].flatten().to_numpy().astype(np.int64) for c in ("starts", "ends")))
            at = np.searchsorted(doc, np.arange(len(sizes) + 1)).astype(np.int32)
            both = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"])
            yield pa.RecordBatch.from_arrays([batch["k1"], batch["k2"], pa.ListArray.from_arrays(pa.array(at), both)], ["k1", "k2", "spans"])

    return each.mapInArrow(union, "k1 long, k2 long, spans array<struct<start:int,end:int>>")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, range_bytes: int = RANGE_BYTES, most: int = MOST, sample: float = SAMPLE) -> DataFrame:
    """The columns of ``docs`` and spans (removed runs), kept (binary: the bytes that stay)."""
    names, taken = {}, {c.lower() for c in docs.columns}
    for name in ("spans", "kept"):
        names[name] = name
        while names[name] in taken:
            names[name] += "_"
    k1, k2 = row_keys("doc_id", "text")
    d = docs.select("*", k1.alias("__k1"), k2.alias("__k2"))
    r = repeats(docs, length, gram, range_bytes, most, sample).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("spans").alias("__spans"))
    d = d.join(r, ["__k1", "__k2"], "left")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # the bytes between the removed runs
    edges = F.concat(F.array(F.lit(0)), F.transform("__spans", lambda x: x["end"]))
    ends = F.concat(F.transform("__spans", lambda x: x["start"]), F.array(F.octet_length(raw)))
    kept = F.when(F.col("__spans").isNull(), raw).otherwise(F.unhex(F.array_join(F.transform(
        F.arrays_zip(edges.alias("a"), ends.alias("b")), lambda x: F.hex(F.substring(raw, x["a"] + 1, x["b"] - x["a"]))), "")))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce("__spans", empty).alias(names["spans"]), kept.alias(names["kept"]))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document of the whole table."""
    d = remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return d.select(
        "doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
