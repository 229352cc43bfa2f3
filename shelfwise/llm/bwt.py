"""Burrows-Wheeler transforms of string collections, and their merge by interleave refinement."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

END = 0  # the symbol that closes a string; a byte b is symbol b + 1
FIRST_DEPTH = 4


@dataclass
class Shard:
    """The transform of some strings, each closed by END.

    ``bwt`` holds the symbol before each suffix in sorted order (END before a string's start), and
    ``starts`` the rows of the whole strings. Nothing else is kept: texts and suffix positions go.
    """

    bwt: np.ndarray
    starts: np.ndarray


def build(strings: list[bytes]) -> Shard:
    """Sort the suffixes of a small collection by doubling; END repeats for ever, equal suffixes go by position."""
    t = np.concatenate([np.frombuffer(s + b"\0", np.uint8).astype(np.int64) + 1 for s in strings])
    lengths = np.array([len(s) for s in strings])
    ends = np.cumsum(lengths + 1) - 1
    t[ends] = END
    n = len(t)
    last = np.repeat(ends, lengths + 1)  # a suffix's own END
    place = np.arange(n)
    rank = t.copy()
    for k in range(1, 6):  # six symbols of nine bits
        rank = rank << 9 | t[np.minimum(place + k, last)]
    depth, order = 6, np.argsort(rank, kind="stable")
    while True:
        sorted_ = rank[order]
        new = np.r_[True, sorted_[1:] != sorted_[:-1]]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = first
        open_ = ~(new & np.r_[new[1:], True])
        rows = np.flatnonzero(open_)
        if depth > lengths.max() or not len(rows):
            break
        # within each block of equal prefixes, order by the rank of what follows
        at = order[rows]
        key = rank[at] * n + rank[np.minimum(at + depth, last[at])]
        settle = np.argsort(key, kind="stable")
        order[rows] = at[settle]
        full = rank * n
        full[at] = key
        rank = full
        depth *= 2
    before = np.where(order > 0, t[order - 1], END)
    row_of = np.empty(n, np.int64)
    row_of[order] = place
    return Shard(before.astype(np.int16), row_of[ends - lengths])


def follow(shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """(first symbols, psi): psi gives the row of a suffix without its first symbol; END stays at itself.

    Rows that start with a symbol come in the order of the rows before which it stands, so a
    stable sort of the transform is the whole step.
    """
    psi = np.argsort(shard.bwt, kind="stable")
    first = shard.bwt[psi]
    closing = first == END
    psi[closing] = np.flatnonzero(closing)
    return first, psi


def merge_classes(shards: list[Shard], depth: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Interleave the shards' rows by their first ``depth`` symbols without sorting suffixes again.

    A row's block is the number of rows of all shards whose prefix is smaller, so it gives the
    interleaved place of the row's interval of equal prefixes. Within a shard blocks ascend with the
    rows. A refinement doubles the prefix length: the blocks of what follows, already known, split
    each block, and as every shard is sorted the new numbers come from merging ascending runs.
    Rows whose prefix nobody shares are settled and left out. Returns for each shard the blocks,
    and for each row how many rows share its prefix of ``depth`` symbols.
    """
    steps = [follow(s) for s in shards]
    sizes = [len(s.bwt) for s in shards]
    bounds = np.cumsum([0, *sizes])
    # rows of all shards in one array; psi leads within the own shard
    psi = np.concatenate([p + b for (_, p), b in zip(steps, bounds, strict=False)])
    key = np.concatenate([f for f, _ in steps]).astype(np.int64)
    symbols, hop = key, psi
    done = min(FIRST_DEPTH, depth)
    for _ in range(done - 1):
        key = key << 9 | symbols[hop]
        hop = psi[hop]
    reach = {done: hop}  # distance -> row of the suffix that many symbols on
    n = len(psi)
    block, shared = np.zeros(n, np.int64), np.full(n, n, np.int64)
    block, shared = _refine(np.arange(n), key, block, shared)
    while done < depth:
        step = min(done, depth - done)
        if step not in reach:
            reach[step] = _hops(reach, psi, step)
        rows = np.flatnonzero(shared > 1)
        if not len(rows):
            break
        key = block[rows] * n + block[reach[step][rows]]
        block, shared = _refine(rows, key, block, shared)
        done += step
        if done < depth and step == done // 2:
            reach[done] = reach[step][reach[step]]
    return np.split(block, bounds[1:-1]), np.split(shared, bounds[1:-1])


def _hops(reach: dict[int, np.ndarray], psi: np.ndarray, distance: int) -> np.ndarray:
    hop, left = None, distance
    for d in sorted(reach, reverse=True):
        while left >= d:
            hop = reach[d] if hop is None else reach[d][hop]
            left -= d
    for _ in range(left):
        hop = psi if hop is None else psi[hop]
    return hop


def _refine(rows: np.ndarray, key: np.ndarray, block: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New blocks of ``rows`` by ``key``, whose order refines the blocks' order."""
    merged = np.argsort(key, kind="stable")  # ascending runs, one per shard: a merge
    k = key[merged]
    m = len(k)
    new = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    count = np.diff(np.r_[new, m])
    own = rows[merged]
    old = block[own]
    opens = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
    base = np.repeat(opens, np.diff(np.r_[opens, m]))  # where the old block begins among these rows
    place = np.repeat(new, count)
    block, shared = block.copy(), shared.copy()
    block[own] = old + place - base
    shared[own] = np.repeat(count, count)
    return block, shared


def repeated_starts(strings: list[bytes], weights: list[int], wanted: list[int], depth: int, shard_bytes: int) -> list[np.ndarray]:
    """For each string, which of its first ``wanted`` suffixes share ``depth`` symbols with another suffix.

    Strings of weight w stand for w equal ones. Only suffixes among those wanted are compared, and
    each of them must have at least ``depth`` symbols.
    """
    shards, places, at = [], [], 0
    while at < len(strings):
        size, end = 0, at
        while end < len(strings) and (end == at or size + len(strings[end]) <= shard_bytes):
            size += len(strings[end])
            end += 1
        shards.append(build(strings[at:end]))
        places.append((at, end))
        at = end
    blocks, _ = merge_classes(shards, depth)
    owner, start, found = [], [], []
    for shard, block, (lo, hi) in zip(shards, blocks, places, strict=True):
        _, psi = follow(shard)
        rows, who, most = shard.starts, np.arange(lo, hi), np.array(wanted[lo:hi])
        for k in range(int(most.max(initial=0))):
            go = most > k
            rows, who, most = rows[go], who[go], most[go]
            owner.append(who)
            start.append(np.full(len(who), k))
            found.append(block[rows])
            rows = psi[rows]
    owner, start, found = np.concatenate(owner), np.concatenate(start), np.concatenate(found)
    _, which = np.unique(found, return_inverse=True)
    heavy = np.bincount(which, weights=np.array(weights, float)[owner])[which] >= 2
    out = [np.zeros(w, bool) for w in wanted]
    order = np.lexsort((start, owner))
    cuts = np.cumsum(wanted)[:-1]
    for i, part in enumerate(np.split(heavy[order], cuts)):
        out[i] = part
    return out
