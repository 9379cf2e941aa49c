"""Removal of repeated passages with suffix arrays.

A passage is repeated if a string of `width` bytes that covers it also starts
anywhere else. Which strings do is settled in four steps that never move texts:

1. Documents are written to the shared folder in blocks. In each block every
   window of `width` bytes is tied to an anchor, the run of GRAM bytes in it with
   the least hash. Equal windows have equal anchors, so the windows of an anchor,
   which follow each other, form a segment that only has to be compared with
   segments of the same anchor hash. Blocks send these hashes, and hashes of the
   whole segments, to hash partitions, one entry for each that a block has, and
   keep the segments beside their texts for the later steps. They
   are answered which of their segments are alone, which repeated whole, and
   which share their anchor with other segments.
2. Of each distinct segment of the last kind one block sends the bytes, to a
   partition that its anchor names.
3. There segments none of whose windows' hashes occurs twice are dropped, as
   nothing in them repeats. Over the others a suffix array, sorted to the depth of a window, gives the
   Burrows-Wheeler transform. Breadth-first backward extension of intervals
   finds the common prefixes of neighbouring suffixes by increasing length and
   stops at `width`: what has no value by then repeats for at least that long.
   Anchors with more than `hot` segments take another exact way, so that no task
   gets them all: their windows' hashes are counted by hash partition.
4. Each unit gets its answers back and cuts its blocks' documents, one block
   after the other.

Defined results
  null or empty text, or fewer than `width` bytes: nothing removed
  repeated rows: each is a document of its own, so the rows remove each other
  null doc_id: stays null; extra columns: ignored; no rows: no rows
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.blocks import keep, kept, load, texts_of, write_blocks
from plumbline.llm.common import materialise, ship, table, work_path
from plumbline.llm.ngrams import entries_of, mix, pack_counts, pack_keys, totals, unpack_counts, unpack_keys

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
GRAM, UNIT_BLOCKS = 32, 64
_BASE = 0x9E3779B97F4A7C15
_SIGNS = np.random.default_rng(17).integers(1, 1 << 63, 256, np.uint64)
_POWERS: list[np.ndarray] = []
_SIDE = 0xC2B2AE3D27D4EB4F
ALONE, WHOLE, PARTNER, WHOLE_PARTNER, HOT, WHOLE_HOT = range(6)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n modulo 2^64, and those of its inverse."""
    if not _POWERS or len(_POWERS[0]) <= n:
        many = max(n + 1, 1 << 20)
        _POWERS[:] = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(many, b, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p))
    return _POWERS[0], _POWERS[1]


class Hasher:
    """Polynomial hashes of any stretch of a buffer: equal stretches have equal hashes."""

    def __init__(self, buf: np.ndarray):
        self.up, down = powers(len(buf))
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_SIGNS[buf] * down[: len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.up[end - 1])

    def every(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.up[length - 1 : length - 1 + n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[p : p + w]) for each p, from the running minima of parts of w from both sides."""
    n = len(x)
    full = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    parts = full.reshape(-1, w)
    ahead = np.minimum.accumulate(parts, axis=1).ravel()
    back = np.minimum.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchor_keys(anchor: np.ndarray) -> np.ndarray:
    """One to one; anchors are the least of many hashes, so their own first bits would put nearly all into one partition."""
    return mix(anchor)


class Block:
    """The bytes of a block's texts with the segments of their windows, which are found or, if packed ones are given, read from these."""

    def __init__(self, texts: list[str], width: int, packed: bytes | None = None):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.buf = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw], np.int64)
        self.end = np.cumsum(self.size)
        self.width = width
        empty = np.zeros(0, np.int64)
        self.first = self.last = empty
        self.anchor = self.segment = empty.astype(np.uint64)
        if not len(self.size) or self.size.max() < width:
            return
        if packed is not None:
            place, self.anchor, self.segment = np.frombuffer(packed, "<u8").reshape(3, -1)
            self.first, self.last = (place & np.uint64(0xFFFFFFFF)).astype(np.int64), (place >> np.uint64(32)).astype(np.int64)
            return
        gram = min(GRAM, width)
        found = self.hasher.every(gram)
        key = (found & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(found), dtype=np.uint64)
        at = (sliding_min(key, width - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        del key
        inside = np.arange(len(at)) + width <= np.repeat(self.end, self.size)[: len(at)]
        place = np.flatnonzero(inside)
        at = at[place]
        new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (np.diff(place) != 1)))
        self.first, self.last = place[new], place[np.append(new[1:], len(place)) - 1]
        self.anchor = found[at[new]]
        self.segment = self.hasher.of(self.first, self.last + width)

    @cached_property
    def hasher(self) -> Hasher:
        return Hasher(self.buf)

    def packed(self) -> bytes:
        """The segments, 24 bytes for each."""
        return np.stack([self.first.astype("<u8") | (self.last.astype("<u8") << np.uint64(32)), self.anchor.astype("<u8"), self.segment.astype("<u8")]).tobytes()

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct segments: order (of the segments, sorted), first (places in it), keys, companions."""
        key = mix(self.anchor + self.segment * np.uint64(_SIDE))
        order = np.lexsort((self.segment, key))
        k, s = key[order], self.segment[order]
        new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (s[1:] != s[:-1]))) if len(k) else np.zeros(0, np.int64)
        return order, new, k[new], s[new]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor keys, and for each: the least and largest segment hash and how many distinct ones."""
        key = anchor_keys(self.anchor)
        order = np.lexsort((self.segment, key))
        a, s = key[order], self.segment[order]
        if not len(a):
            return a, s, s, np.zeros(0, np.int64)
        new = np.append(True, a[1:] != a[:-1])
        first = np.flatnonzero(new)
        fresh = new | np.append(True, s[1:] != s[:-1])
        return a[first], s[first], s[np.append(first[1:], len(a)) - 1], np.add.reduceat(fresh.astype(np.int64), first)


def ranges_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


# the suffix array of one partition


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes at least, by doubling the sorted length; ties in any order.

    A suffix's rank is the first place of those that are equal so far; only
    places whose suffixes have equals are sorted on.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    places, ranked, length = np.arange(n), key[order], 8
    while True:
        new = np.append(True, ranked[1:] != ranked[:-1])
        first = places[np.flatnonzero(new)]
        rank[order[places]] = first[np.cumsum(new) - 1]
        alone = new & np.append(new[1:], True)
        places = places[~alone]
        if length >= depth or not len(places):
            return order
        sub = order[places]
        behind = sub + length
        key = (rank[sub] << 32) | np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        by = np.argsort(key)
        order[places] = sub[by]
        ranked, length = key[by], 2 * length


def repeats_from(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each row of the suffix array but the first: whether its suffix shares at least `least` bytes with the one before.

    The intervals of all strings of one length are extended backwards at once.
    An interval's end is the end of the common prefix there: of the length that
    is reached, if the end has no value yet; only such intervals are extended
    further, so that each end is set once.
    """
    n = len(text)
    bwt = text[order - 1]  # the suffix 0 wraps around to the final separator
    step = np.empty(n, np.int64)  # from a suffix's row to the row of the suffix one byte longer
    step[np.argsort(bwt, kind="stable")] = np.arange(n)
    unknown = np.ones(n + 1, bool)
    unknown[[0, n]] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        size = high - low
        one = size == 1
        # A row alone has one byte before it; in other intervals the rows of a byte lead to neighbouring rows, from its first to its last.
        many = np.flatnonzero(~one)
        n_rows = size[many]
        who = np.repeat(np.arange(len(many)), n_rows)
        rows = np.arange(len(who)) - np.repeat(np.cumsum(n_rows) - n_rows, n_rows) + low[many][who]
        seen = np.sort((who << 40) | (bwt[rows].astype(np.int64) << 32) | rows)
        new = np.flatnonzero(np.append(True, (seen[1:] >> 32) != (seen[:-1] >> 32))) if len(seen) else np.zeros(0, np.int64)
        first, last = seen[new] & 0xFFFFFFFF, seen[np.append(new[1:], len(seen)) - 1] & 0xFFFFFFFF if len(seen) else np.zeros(0, np.int64)
        alone = step[low[one]]
        new_low, new_high = np.concatenate([alone, step[first]]), np.concatenate([alone, step[last]]) + 1
        fresh = unknown[new_high]
        low, high = new_low[fresh], new_high[fresh]
        unknown[high] = False
        if not len(low):
            break
    return unknown[1:n]


def candidates(segments: list[bytes], width: int) -> np.ndarray:
    """Which segments have a window whose hash occurs again; the others have no repeated window."""
    size = np.array([len(s) for s in segments], np.int64)
    hashes = Hasher(np.frombuffer(b"".join(segments), np.uint8)).every(width)
    end = np.cumsum(size)
    inside = np.flatnonzero(np.arange(len(hashes)) + width <= np.repeat(end, size)[: len(hashes)])
    keys = hashes[inside]
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    hit = np.zeros(len(segments), bool)
    if len(twice):
        again = twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys
        hit[np.searchsorted(end, inside[again], side="right")] = True
    return hit


def repeated_windows(segments: list[bytes], width: int) -> list[np.ndarray]:
    """Per segment, for each of its windows: whether an equal one starts elsewhere in the segments."""
    # 0 parts the segments: all bytes are moved up by one, and UTF-8 has none that would be moved round to 0.
    text = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8) + np.uint8(1)
    order = suffix_array(text, width)
    same = repeats_from(text, order, width)
    hit = np.zeros(len(text), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    out, at = [], 0
    for s in segments:
        out.append(hit[at : at + len(s) - width + 1])
        at += len(s) + 1
    return out


# the steps


def _cut(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of sorted keys by their first bits."""
    if not len(keys):
        return []
    parts = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edge = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])).tolist()
    return [(int(parts[a]), a, b) for a, b in zip(edge, [*edge[1:], len(keys)])]


def _batches(rows: list[tuple], names: list[str], kinds: list) -> Iterator:
    for i in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + 256]], kind) for k, kind in enumerate(kinds)], names)


def merged(keys: np.ndarray, side: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, side), sorted, with the sums of their counts."""
    order = np.lexsort((side, keys))
    k, s = keys[order], side[order]
    if not len(k):
        return k, s, counts
    first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])))
    return k[first], s[first], np.add.reduceat(counts[order], first)


SENT = "kind int, part long, unit long, n long, keys binary, side binary, more binary, counts binary"


def send(path: str, batches: Iterator, width: int, bits: int) -> Iterator:
    """Of each unit, kind 0: distinct segments with their counts; kind 1: distinct anchors with their least and largest segment and how many there are."""
    join = np.concatenate
    for batch in batches:
        for unit, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            segments, anchors = [], []
            for number in numbers:
                block = Block(texts_of(load(path, number)), width)
                keep(path, number, block.packed())
                order, new, keys, side = block.entries()
                segments.append((keys, side, np.diff(np.append(new, len(order)))))
                anchors.append(block.anchors())
            keys, side, counts = merged(*map(join, zip(*segments)))
            rows = [(0, p, unit, b - a, pack_keys(keys[a:b]), side[a:b].tobytes(), b"", pack_counts(counts[a:b])) for p, a, b in _cut(keys, bits)]
            a_keys, lo, hi, many = map(join, zip(*anchors))
            order = np.argsort(a_keys, kind="stable")
            if len(order):
                first = np.flatnonzero(np.append(True, a_keys[order][1:] != a_keys[order][:-1]))
                a_keys, lo, hi, many = a_keys[order][first], np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first), np.add.reduceat(many[order], first)
            rows += [(1, p, unit, b - a, pack_keys(a_keys[a:b]), lo[a:b].tobytes(), hi[a:b].tobytes(), pack_counts(many[a:b])) for p, a, b in _cut(a_keys, bits)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            yield from _batches(rows, ["kind", "part", "unit", "n", "keys", "side", "more", "counts"], kinds)


FOUND = "kind int, part long, unit long, n long, keys binary, side binary, status binary"
ANSWERED = FOUND + ", shared long, heated long"


def answer(group, hot: int):
    """What of a unit's entries needs attention. Kind 0: 1 repeated, 2 repeated and this unit stands for it. Kind 1: 1 an anchor of several segments, 2 of more than `hot`."""
    kind = group.column("kind")[0].as_py()
    sizes, keys, counts = entries_of(group)
    side = np.frombuffer(b"".join(group.column("side").to_pylist()), np.uint64)
    units = group.column("unit").to_numpy()
    unit = np.repeat(units, sizes)
    if kind == 0:
        order = np.lexsort((unit, side, keys))
        k, s = keys[order], side[order]
        new = np.append(True, (k[1:] != k[:-1]) | (s[1:] != s[:-1]))
        total = np.add.reduceat(counts[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        got = np.where(total == 1, 0, np.where(new, 2, 1))
    else:
        more = np.frombuffer(b"".join(group.column("more").to_pylist()), np.uint64)
        order = np.argsort(keys, kind="stable")
        new = np.append(True, keys[order][1:] != keys[order][:-1])
        first = np.flatnonzero(new)
        several = np.minimum.reduceat(side[order], first) != np.maximum.reduceat(more[order], first)
        got = np.where(several, np.where(np.add.reduceat(counts[order], first) > hot, 2, 1), 0)[np.cumsum(new) - 1]
    back = np.empty(len(keys), np.uint8)
    back[order] = got
    rows = []
    ends = np.cumsum(sizes).tolist()
    for u, a, b in zip(units.tolist(), [0, *ends], ends):
        take = a + np.flatnonzero(back[a:b])
        if len(take):
            status = back[take]
            rows.append((kind, group.column("part")[0].as_py(), u, len(take), pack_keys(keys[take]), side[take].tobytes() if kind == 0 else b"", status.tobytes(), kind * int(counts[take][status == 1].sum()), kind * int((status == 2).sum())))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["kind", "part", "unit", "n", "keys", "side", "status", "shared", "heated"])


class Known:
    """A unit's answers: its blocks, what is said of its segments and anchors, and the repeated windows found elsewhere."""

    def __init__(self, batches: Iterator):
        table = pa.Table.from_batches(list(batches))
        rows: dict[int, list] = {}
        for kind, part, n, keys, side, status in zip(*(table.column(c).to_pylist() for c in ("kind", "part", "n", "keys", "side", "status"))):
            rows.setdefault(kind, []).append((part, n, keys, side, status))
        self.unit = table.column("unit")[0].as_py()
        self.blocks = np.frombuffer(rows[-1][0][2], "<i8").tolist()
        self.keys, self.side, self.status = self._joined(rows.get(0, []))
        self.sent = np.zeros(len(self.keys), bool)
        self.anchors, _, self.anchor_status = self._joined(rows.get(1, []))
        self.ranges: dict[int, list] = {}
        for part, _, raw, _, _ in rows.get(2, []):
            self.ranges.setdefault(part, []).append(np.frombuffer(raw, "<i8").reshape(2, -1))
        self.hot = np.sort(self._joined(rows.get(3, []))[0])

    @staticmethod
    def _joined(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = sorted(rows, key=lambda r: r[0])  # by partition, which the first bits of a key name
        keys = [unpack_keys(k, n) for _, n, k, _, _ in rows]
        return np.concatenate([np.zeros(0, np.uint64), *keys]), np.frombuffer(b"".join(s for *_, s, _ in rows), np.uint64), np.frombuffer(b"".join(t for *_, t in rows), np.uint8)

    def segments(self, keys: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The status of segments, 0 where nothing is said, and where it stands."""
        status, where = np.zeros(len(keys), np.uint8), np.full(len(keys), -1)
        at, todo = np.searchsorted(self.keys, keys), np.arange(len(keys))
        while len(todo):
            there = at[todo] < len(self.keys)
            todo = todo[there]
            todo = todo[self.keys[at[todo]] == keys[todo]]
            same = self.side[at[todo]] == side[todo]
            status[todo[same]], where[todo[same]] = self.status[at[todo[same]]], at[todo[same]]
            todo = todo[~same]  # another segment with the same key: the next entry may be this one
            at[todo] += 1
        return status, where

    def of_anchors(self, anchors: np.ndarray) -> np.ndarray:
        if not len(self.anchors):
            return np.zeros(len(anchors), np.uint8)
        at = np.minimum(np.searchsorted(self.anchors, anchors), len(self.anchors) - 1)
        return np.where(self.anchors[at] == anchors, self.anchor_status[at], 0)


def states(block: Block, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """Per segment what it is, and whether it is the one that its distinct segment is sent by; blocks of a unit come in their order."""
    order, new, keys, side = block.entries()
    status, where = known.segments(keys, side)
    repeated = np.empty(len(order), np.uint8)
    each = np.zeros(len(order), np.int64)
    each[new[1:]] = 1
    repeated[order] = status[np.cumsum(each)] if len(order) else 0
    shared = known.of_anchors(anchor_keys(block.anchor))
    stands = (status == 0) | (status == 2)
    stands[status == 2] = ~known.sent[where[status == 2]]
    known.sent[where[status == 2]] = True
    sends = np.zeros(len(order), bool)
    sends[order[new[stands]]] = True
    state = np.where(shared == 0, np.where(repeated > 0, WHOLE, ALONE), np.where(shared == 1, np.where(repeated > 0, WHOLE_PARTNER, PARTNER), np.where(repeated > 0, WHOLE_HOT, HOT)))
    return state, sends & (shared > 0)


SEGMENTS = "part long, unit long, block long, first long, wants boolean, bytes binary"


def emit(path: str, known: Known, width: int, many: int) -> Iterator:
    """The bytes of a unit's segments that have partners."""
    for number in known.blocks:
        block = Block(texts_of(load(path, number)), width, kept(path, number))
        state, sends = states(block, known)
        take = np.flatnonzero(sends & ((state == PARTNER) | (state == WHOLE_PARTNER)))
        raw = block.buf.tobytes()
        to = (mix(block.anchor[take]) % np.uint64(many)).astype(np.int64)
        columns = [pa.array(to), pa.array(np.full(len(take), known.unit)), pa.array(np.full(len(take), number)), pa.array(block.first[take]), pa.array(state[take] == PARTNER), pa.array([raw[a : b + width] for a, b in zip(block.first[take].tolist(), block.last[take].tolist())], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "unit", "block", "first", "wants", "bytes"])


def search(group, width: int):
    """The repeated windows of a partition's segments, as ranges of their blocks."""
    segments = group.column("bytes").to_pylist()
    group = group.filter(pa.array(candidates(segments, width)))
    wants = group.column("wants").to_pylist()
    found = repeated_windows(group.column("bytes").to_pylist(), width) if len(wants) else []
    out: dict[tuple[int, int], tuple[list, list]] = {}
    for unit, block, first, want, hit in zip(group.column("unit").to_pylist(), group.column("block").to_pylist(), group.column("first").to_pylist(), wants, found):
        if want and hit.any():
            a, b = ranges_of(hit)
            lists = out.setdefault((unit, block), ([], []))
            lists[0].append(a + first)
            lists[1].append(b + first)
    packed = [np.stack([np.concatenate(a), np.concatenate(b)]).astype("<i8").tobytes() for a, b in out.values()]
    columns = [[2] * len(out), [b for _, b in out], [u for u, _ in out], [0] * len(out), packed, [b""] * len(out), [b""] * len(out)]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "part", "unit", "n", "keys", "side", "status"])


def hot_windows(block: Block, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of some segments."""
    n = block.last[take] - block.first[take] + 1
    start = np.repeat(block.first[take], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return start, block.hasher.of(start, start + block.width) if len(start) else np.zeros(0, np.uint64)


HEATED = "part long, unit long, n long, keys binary, counts binary"


def emit_hot(path: str, known: Known, width: int, bits: int) -> Iterator:
    """The hashes of a unit's windows that belong to hot anchors, those of each distinct segment once."""
    for number in known.blocks:
        block = Block(texts_of(load(path, number)), width, kept(path, number))
        state, sends = states(block, known)
        keys, counts = np.unique(hot_windows(block, np.flatnonzero(sends & ((state == HOT) | (state == WHOLE_HOT))))[1], return_counts=True)
        cut = _cut(keys, bits)
        columns = [[p for p, _, _ in cut], [known.unit] * len(cut), [b - a for _, a, b in cut], [pack_keys(keys[a:b]) for _, a, b in cut], [pack_counts(counts[a:b]) for _, a, b in cut]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()])], ["part", "unit", "n", "keys", "counts"])


def answer_hot(group):
    """For each unit, which of the window hashes that it sent stand for more than one window."""
    sizes, keys, counts = entries_of(group)
    distinct, total = totals(keys, counts)
    ends = np.cumsum(sizes).tolist()
    part = group.column("part")[0].as_py()
    of: dict[int, list] = {}
    for unit, a, b in zip(group.column("unit").to_pylist(), [0, *ends], ends):
        of.setdefault(unit, []).append(keys[a:b])
    rows = []
    for unit, sent in of.items():
        k = np.unique(np.concatenate(sent))
        k = k[total[np.searchsorted(distinct, k)] > 1]
        if len(k):
            rows.append((3, part, unit, len(k), pack_keys(k), b"", b""))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["kind", "part", "unit", "n", "keys", "side", "status"])


def covered(path: str, known: Known, number: int, width: int) -> tuple:
    """A block's rows, their bytes, and which of these a repeated window covers."""
    rows = load(path, number)
    block = Block(texts_of(rows), width, kept(path, number))
    state, _ = states(block, known)
    whole = np.isin(state, (WHOLE, WHOLE_PARTNER, WHOLE_HOT))
    starts, ends = [block.first[whole]], [block.last[whole] + 1]
    for a, b in known.ranges.get(number, []):
        starts.append(a)
        ends.append(b)
    if len(known.hot):
        start, keys = hot_windows(block, np.flatnonzero(state == HOT))
        start = start[known.hot[np.minimum(np.searchsorted(known.hot, keys), len(known.hot) - 1)] == keys]
        starts.append(start)
        ends.append(start + 1)
    change = np.zeros(len(block.buf) + 1, np.int64)
    np.add.at(change, np.concatenate(starts), 1)
    np.add.at(change, np.concatenate(ends) + width - 1, -1)
    return rows, block, np.cumsum(change[:-1]) > 0


def digest(path: str, known: Known, number: int, width: int):
    rows, block, gone = covered(path, known, number, width)
    removed, spans, sha = [], [], []
    for a, b in zip((block.end - block.size).tolist(), block.end.tolist()):
        g = gone[a:b]
        n = int(g.sum())
        removed.append(n)
        spans.append(len(ranges_of(g)[0]) if n else 0)
        sha.append(hashlib.sha256((block.buf[a:b][~g] if n else block.buf[a:b]).tobytes()).hexdigest())
    return pa.table({"doc_id": rows.column("doc_id"), "n_bytes": pa.array(block.size), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})


def kept_rows(path: str, known: Known, number: int, width: int):
    """The rows with their texts cut, and n_chars after them; a character of which only some bytes are covered stays."""
    rows, block, gone = covered(path, known, number, width)
    lead = np.flatnonzero((block.buf & 0xC0) != 0x80)  # first bytes of characters
    if len(lead):
        gone = np.repeat(np.logical_and.reduceat(gone, lead), np.diff(np.append(lead, len(block.buf))))
    out = []
    for t, a, b in zip(rows.column("text").to_pylist(), (block.end - block.size).tolist(), block.end.tolist()):
        g = gone[a:b]
        out.append(block.buf[a:b][~g].tobytes().decode("utf-8", "surrogatepass") if g.any() else t)
    for name, values in (("text", out), ("n_chars", [len(t or "") for t in out])):
        at = rows.schema.get_field_index(name)
        if at >= 0:
            rows = rows.set_column(at, rows.schema.field(at), pa.array(values, rows.schema.field(at).type))
    return rows


def remove_repeats(docs: DataFrame, width: int = 200, cut: bool = False, block_bytes: int = 1_500_000, part_entries: int = 1_000_000, part_bytes: int = 2_000_000, hot: int = 20_000) -> DataFrame:
    """What becomes of each row of docs(doc_id, text): (doc_id, n_bytes, n_removed, n_spans, kept_sha256), or with `cut` the rows themselves, all columns, their texts cut."""
    spark = docs.sparkSession
    ship(spark)
    path = work_path(spark, "suffix-blocks")
    docs = docs if cut else docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    result, schema = (kept_rows, docs.schema) if cut else (digest, SCHEMA)
    blocks = write_blocks(docs, path, block_bytes)
    n, size = blocks.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n:
        return spark.createDataFrame([], schema)
    bits = max(0, math.ceil(math.log2(max(1, size / 80 / part_entries))))  # an anchor holds about 80 windows
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # What travels is small, what is done for a unit isn't: a fixed number of tasks, which Spark won't join into few.
    tasks = min(n, max(2 * many, math.ceil(n / UNIT_BLOCKS)))
    units = blocks.select(F.pmod(F.xxhash64("block"), F.lit(tasks)).alias("unit"), "block").groupBy("unit").agg(F.sort_array(F.collect_list("block")).alias("blocks")).repartition(tasks, "unit")
    answers = units.mapInArrow(lambda b: send(path, b, width, bits), SENT).groupBy("kind", "part").applyInArrow(lambda g: answer(g, hot), ANSWERED)
    # A unit's own row names its blocks, and stands where nothing is answered.
    own = units.mapInArrow(_own_rows, ANSWERED)
    answers = materialise(answers.unionByName(own), "suffix-answers")
    shared, heated = answers.agg(F.sum("shared"), F.sum("heated")).first()
    parts = max(1, math.ceil(shared * (width + 80) / part_bytes))

    def emitted(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(path, Known(group), width, parts)

    def heated_windows(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit_hot(path, Known(group), width, bits)

    def finished(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(group)
        for number in known.blocks:
            yield from result(path, known, number, width).to_batches()

    of_unit = lambda df: df.repartition(tasks, "unit").groupBy("unit")
    answers = answers.drop("shared", "heated")
    everything = answers.unionByName(of_unit(answers).applyInArrow(emitted, SEGMENTS).groupBy("part").applyInArrow(lambda g: search(g, width), FOUND))
    if heated:
        everything = everything.unionByName(of_unit(answers).applyInArrow(heated_windows, HEATED).groupBy("part").applyInArrow(answer_hot, FOUND))
    return of_unit(everything).applyInArrow(finished, schema)


def _own_rows(batches: Iterator) -> Iterator:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = [(-1, 0, unit, len(blocks), np.array(blocks, "<i8").tobytes(), b"", b"", 0, 0) for unit, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["kind", "part", "unit", "n", "keys", "side", "status", "shared", "heated"])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
