"""A static binary-fuse filter over 64-bit digests, built and probed with numpy.

Three fingerprint slots per key lie in three consecutive segments; peeling finds for
every key a slot of its own. A probe is three reads and an exclusive or. Keys put in
are always found; another key is found with a chance of 2**-16.
"""

from __future__ import annotations

import numpy as np

_HEAD = np.dtype([("seed", "<u8"), ("segment", "<u4"), ("slots", "<u4")])


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _slots(h: np.ndarray, segment: int, slots: int) -> np.ndarray:
    """The three slots of each hash: a start segment, and an offset in each of three."""
    starts = slots // segment - 2
    first = ((h >> np.uint64(32)) * np.uint64(starts)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    inner = _mix(h, 0xD6E8FEB86659FD93)
    at = [
        (first + np.uint64(i)) * np.uint64(segment) + ((inner >> np.uint64(18 * i)) & mask)
        for i in range(3)
    ]
    return np.stack(at).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


def build(keys: np.ndarray) -> bytes:
    """The filter of distinct 64-bit keys. A seed under which the keys can't be peeled
    is replaced by the next; the table grows a little after every few failures."""
    keys = np.unique(keys.astype(np.uint64, copy=False))
    n = len(keys)
    segment = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    for attempt in range(64):
        load = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))) * (1 + 0.05 * (attempt // 4))
        slots = (max(1, int(np.ceil(n * load / segment))) + 2) * segment
        seed = (0x9E3779B97F4A7C15 * (attempt + 1)) & 0xFFFFFFFFFFFFFFFF
        h = _mix(keys, seed)
        at = _slots(h, segment, slots)
        order = _peel(at, slots)
        if order is not None:
            break
    else:
        raise RuntimeError("no seed lets the keys be peeled")
    table = np.zeros(slots, np.uint16)
    want = _prints(h)
    for who, own in reversed(order):  # later rounds first: their other slots are final
        a, b, c = at[:, who]
        table[own] = 0
        table[own] = want[who] ^ table[a] ^ table[b] ^ table[c]
    return np.array([(seed, segment, slots)], _HEAD).tobytes() + table.tobytes()


def _peel(at: np.ndarray, slots: int):
    """Rounds of (keys, the slot each owns): a slot that one key alone uses is its own.
    A key whose several slots are free at once takes one of them."""
    n = at.shape[1]
    count = np.zeros(slots, np.int64)
    total = np.zeros(slots, np.int64)  # exclusive or of the keys in a slot
    for row in at:
        np.add.at(count, row, 1)
        np.bitwise_xor.at(total, row, np.arange(n))
    rounds, left = [], n
    free = np.flatnonzero(count == 1)
    while len(free):
        who, first = np.unique(total[free], return_index=True)
        rounds.append((who, free[first]))
        left -= len(who)
        touched = at[:, who].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(total, touched, np.tile(who, 3))
        touched = np.unique(touched)
        free = touched[count[touched] == 1]
    return rounds if not left else None


def contains(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    head = np.frombuffer(filter_bytes, _HEAD, 1)[0]
    table = np.frombuffer(filter_bytes, np.uint16, offset=_HEAD.itemsize)
    h = _mix(keys.astype(np.uint64, copy=False), int(head["seed"]))
    a, b, c = _slots(h, int(head["segment"]), int(head["slots"]))
    return (table[a] ^ table[b] ^ table[c]) == _prints(h)
