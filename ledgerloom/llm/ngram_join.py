"""Jaccard self-join of word n-gram sets with signature trees.

Sets of equal content are one node from the start. Nodes that could reach the threshold
are brought together by keys; nodes that share a key are a group, and pairs of a group are
candidates. Neither kind of key loses a pair:

* Parts (high thresholds): the n-gram universe is split by hash into more parts than a
  linked pair can differ in, so the two agree in some whole parts. The fullest parts of a
  set are its keys, so many that one of those is among the keys of both.
* Prefixes (thresholds below PART_LEAST, where parts would be too short to tell texts
  apart): in any fixed order of the n-grams, a linked pair shares k among the first
  |x| - ceil(t |x|) + k of each. N-grams of many sets, by counts over all documents, come
  last in the order, so passages that many documents share make few candidates. The
  counts have a fixed size; what counts as many rises with what chance puts on a place.

Groups are never chained to clusters: a text is compared within groups it is in. Pairs of
small groups are listed, once each, and those with too few keys in common are left out.
First every set meets the sets that have the same first node in most of their keys, which
links most families of copies. Only pairs that have not met and are not linked by then,
through others, meet in a second step.

Where sets meet (a block of them, if there are many) they become leaves of a signature
tree: a leaf has a bitmap of its n-grams, an inner node the OR of its children's bitmaps
and the range of their sizes. Two trees are walked together; a pair of nodes is dropped
when the largest possible overlap of any two sets below them is too small, or when all
sets below are connected already. What remains is compared n-gram by n-gram.

Skew: a task gives the keys of equal sets once, so a hot group of copies has a few rows
per key and task. A large group is dealt into blocks by hash, and pairs of blocks are
groups of their own, but for blocks of one family; no task holds more than two blocks.
Texts are shuffled for candidates only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import bits
from ledgerloom.llm.common import free_name, pick, slices, staged, with_columns
from ledgerloom.llm.graph import components

# Size classes grow by this factor; a set joins all classes it may find a partner in.
CLASS_STEP = 1.4
# Parts per difference a pair may have: a few more, so that empty parts do no harm.
PART_ROOM = 1.15
# Sets, and n-grams, in a block of a cluster.
BLOCK_SETS, BLOCK_GRAMS = 1024, 2_000_000
FAN = 32
# Threshold from which parts serve as keys; places (as a power) that n-grams are counted on:
# 32 MB in a task and 4 MB of bits in the end, whatever the input.
PART_LEAST = 0.9
SHARED_BITS = 25
# Keys that the prefixes of a linked pair have in common at least, if their sets are so large;
# nodes of a group whose pairs are listed.
PREFIX_KEYS, PAIR_MOST = 4, 64

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """64-bit hashes of words, computed once per word; begun anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    def __init__(self, width: int):
        self.width, self.hashes = width, _Hashes()

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sorted distinct n-grams of each text as 64-bit hashes. A-Z are lowered and
        words split at [\\x20\\x09-\\x0D] (what bytes.lower and bytes.split do). A text of
        fewer words is one n-gram; one without words has none."""
        words = [t.encode().lower().split() if t else [] for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter((self.hashes[w] for ws in words for w in ws), np.uint64, int(counts.sum()))
        k, n = self.width, len(flat)
        rolled = np.zeros(max(0, n - k + 1), np.uint64)
        for i in range(k):
            rolled = rolled * _P + flat[i : n - k + 1 + i] if n >= k else rolled
        rolled = _mix(rolled + np.array([k], np.uint64) * _Q)
        made, at = [], 0
        for c in counts.tolist():
            if c >= k:
                made.append(np.unique(rolled[at : at + c - k + 1]))
            elif c:
                whole = np.array([c], np.uint64)
                for w in flat[at : at + c]:
                    whole = whole * _P + w
                made.append(_mix(whole + np.array([c], np.uint64) * _Q))
            else:
                made.append(np.zeros(0, np.uint64))
            at += c
        return made


def identity(grams: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(grams.tobytes())


def _classes(most: int) -> np.ndarray:
    """The smallest size of each class; class 0 begins at 1."""
    starts, x = [1], 1.0
    while starts[-1] <= most:
        x *= CLASS_STEP
        if int(np.ceil(x)) > starts[-1]:
            starts.append(int(np.ceil(x)))
    return np.array(starts, np.int64)


_STARTS = _classes(1 << 40)


def part_keys(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all sets, and the position of the set each belongs to. Sets with
    |a & b| * den >= num * |a | b| share a key. Parts of few n-grams, which chance gives to
    unlike sets, are keys only of sets that have too few others."""
    sizes = np.array([len(s) for s in sets], np.int64)
    own = np.searchsorted(_STARTS, sizes, "right") - 1
    who = np.arange(len(sets))[sizes > 0]
    lists, levels, up = [who], [own[who]], 1
    while len(upper := who[sizes[who] * den >= num * _STARTS[own[who] + up]]):  # may reach a set so many classes up
        lists.append(upper)
        levels.append(own[upper] + up)
        who, up = upper, up + 1
    owner, level = np.concatenate(lists), np.concatenate(levels)
    # a pair differs in at most (1 - t) / t of the smaller set, which is below the class end
    differ = (_STARTS[level + 1] - 1) * (den - num) // num
    parts = np.where(differ == 0, 1, np.ceil((differ + 1) * PART_ROOM)).astype(np.int64)
    base = np.cumsum(parts) - parts
    total = int(parts.sum())
    row = np.repeat(np.arange(len(owner)), parts)
    grams = np.concatenate([sets[w] for w in owner.tolist()] or [np.zeros(0, np.uint64)])
    of = np.repeat(np.arange(len(owner)), sizes[owner])
    at = base[of] + (grams % parts.astype(np.uint64)[of]).astype(np.int64)
    sums = np.zeros(total, np.uint64)
    np.add.at(sums, at, _mix(grams + _P))
    filled = np.bincount(at, minlength=total)
    place = np.arange(total) - base[row]
    keys = _mix(sums + place.astype(np.uint64) * _Q + _mix(level.astype(np.uint64) + _Q)[row])
    # in one order of all parts, the fullest first, a part that agrees is among the first of both
    ordered = np.lexsort((keys, -filled, row))
    use = ordered[place <= differ[row]]
    return keys[use], owner[row[use]]


def prefix_keys(sets: list[np.ndarray], num: int, den: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first n-grams of all sets, those that may be shared last, and the position of
    the set each belongs to. One that may be shared is a key for each size class the
    set can find a partner in, so that only sets of like size meet by it. A linked pair has
    PREFIX_KEYS keys in common, or as many as its smaller set can have."""
    keys, owner = [np.zeros(0, np.uint64)], []
    for i, own in enumerate(sets):
        n = len(own)
        if not n:
            continue
        place = place_of(own, len(shared) << 3)
        often = (shared[place >> 3] >> (place & 7).astype(np.uint8)) & np.uint8(1) == 1
        least = -(-num * n // den)
        ordered = np.concatenate([own[~often], own[often]])[: n - least + min(PREFIX_KEYS, least)]
        alone = min(len(ordered), int((~often).sum()))
        level = int(np.searchsorted(_STARTS, n, "right")) - 1
        top = int(np.searchsorted(_STARTS, n * den // num, "right")) - 1  # the class of the largest partner
        levels = range(level, top + 1)
        made = [_mix(ordered[:alone] + _Q)] + [_mix(_mix(ordered[alone:] + _P) + np.array([x], np.uint64) * _Q) for x in levels]
        keys.extend(made)
        owner.extend([i] * sum(map(len, made)))
    return np.concatenate(keys), np.array(owner, np.int64)


def place_of(grams: np.ndarray, places: int) -> np.ndarray:
    """Where n-grams are counted; ``places`` is a power of two."""
    return (grams >> np.uint64(65 - places.bit_length())).astype(np.int64)


def need(num: int, den: int, sizes: np.ndarray) -> np.ndarray:
    """The least overlap of two sets with this sum of sizes that links them."""
    return -((-num * sizes) // (num + den))


class Tree:
    """Signature tree of sets: per level bitmaps, size ranges and slack.

    ``slack`` is the most n-grams of a set that share a bit with another one of it."""

    def __init__(self, sets: list[np.ndarray], width: int):
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
        self.order, self.sets = np.array(order), [sets[i] for i in order]
        maps = np.zeros((len(sets), width // 64), np.uint64)
        for row, grams in enumerate(self.sets):
            place = (grams >> np.uint64(20)) % np.uint64(width)
            np.bitwise_or.at(maps[row], (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        sizes = np.array([len(s) for s in self.sets], np.int64)
        slack = sizes - np.bitwise_count(maps).sum(1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, slack = self.levels[-1]
            at = np.arange(0, len(maps), FAN)
            self.levels.append(
                (np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at))
            )

    def children(self, level: int, node: int) -> range:
        return range(node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][0])))

    def leaves(self, level: int, node: int) -> slice:
        return slice(node * FAN**level, min((node + 1) * FAN**level, len(self.sets)))


def find_links(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int, names: list | None = None) -> np.ndarray:
    """Component numbers of the sets (left, then right), by links inside ``left``, or
    between ``left`` and ``right`` if it is given. Members of one component get its
    smallest position. Sets that have one of ``names`` in common are linked already."""
    sets = left + (right or [])
    boss = np.arange(len(sets))
    if names:
        place: dict = {}
        boss = np.array([place.setdefault(name, i) for i, name in enumerate(names)])
    if not left or right is not None and not right:
        return boss
    most = max(map(len, sets))
    width = min(1 << 14, max(256, 1 << int(2 * most - 1).bit_length()))
    a = Tree(left, width)
    b = a if right is None else Tree(right, width)
    name_a, name_b = a.order, b.order + (0 if right is None else len(left))

    def bounds(i: range, j: range, la: int, lb: int) -> np.ndarray:
        """Can the sets below these nodes overlap enough? One answer for each pair."""
        ma, low_a, high_a, slack_a = (x[i.start : i.stop] for x in a.levels[la])
        mb, low_b, high_b, slack_b = (x[j.start : j.stop] for x in b.levels[lb])
        common = np.bitwise_count(ma[:, None] & mb[None]).sum(2).astype(np.int64)
        if la == lb == 0:
            bits_a, bits_b = high_a - slack_a, high_b - slack_b
            most = np.minimum(high_a[:, None] - (bits_a[:, None] - common), high_b[None] - (bits_b[None] - common))
        else:
            most = np.minimum(common + np.minimum(slack_a[:, None], slack_b[None]), np.minimum(high_a[:, None], high_b[None]))
        return most >= need(num, den, low_a[:, None] + low_b[None])

    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, i, lb, j = todo.pop()
        if la == lb == 0:
            x, y = name_a[i], name_b[j]
            if boss[x] != boss[y]:
                s, t = a.sets[i], b.sets[j]
                at = np.searchsorted(s, t)
                at[at == len(s)] = 0
                if int((s[at] == t).sum()) * den >= num * (len(s) + len(t) - int((s[at] == t).sum())):
                    lower, upper = sorted((boss[x], boss[y]))
                    boss[boss == upper] = lower
            continue
        below = np.concatenate([boss[name_a[a.leaves(la, i)]], boss[name_b[b.leaves(lb, j)]]])
        if (below == below[0]).all():
            continue
        go_a, go_b = la >= lb and la > 0, lb >= la and lb > 0
        rows = a.children(la, i) if go_a else range(i, i + 1)
        cols = b.children(lb, j) if go_b else range(j, j + 1)
        na, nb = la - go_a, lb - go_b
        for r, c in np.argwhere(bounds(rows, cols, na, nb))[::-1].tolist():
            p, q = rows[r], cols[c]
            if a is not b or na != nb or (p < q if na == 0 else p <= q):
                todo.append((na, p, nb, q))
    return boss


def describe(docs: DataFrame, width: int) -> DataFrame:
    """Add ``n_shingles`` and ``set_id`` (128 bits, null without words) to (doc_id, text)."""

    def make():
        shingler = Shingler(width)

        def run(texts: pa.Array) -> list[pa.Array]:
            sets = shingler.sets(texts.to_pylist())
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([identity(s) if len(s) else None for s in sets], pa.binary()),
            ]

        return run

    return with_columns(docs, ["text"], [("n_shingles", T.LongType()), ("set_id", T.BinaryType())], make)


def shared_grams(docs: DataFrame, width: int) -> np.ndarray:
    """A bitmap of the hash places that n-grams of many sets fall on, over all documents.

    Tasks count the n-grams of distinct sets on each place, up to 255; the counts of
    chunks of the places are summed by a grouping. A place that is above what the n-grams of
    single sets give it by chance (the median of its chunk, and two deviations of a Poisson
    count) has n-grams that many sets share, the more the fuller the places are. So the
    bitmap doesn't fill up, whatever the input; it only orders n-grams, so a place that is
    marked by chance or missed costs candidates, never links."""
    places, chunk = 1 << SHARED_BITS, 1 << 16

    def collect(batches):
        shingler, met = Shingler(width), set()
        counts = np.zeros(places, np.uint8)
        for batch in batches:
            for part in slices(batch):
                for grams in shingler.sets(part.column(0).to_pylist()):
                    if len(grams) and (own := identity(grams)) not in met:
                        met.add(own)
                        place, n = np.unique(place_of(grams, places), return_counts=True)
                        counts[place] = np.minimum(counts[place] + n, 255)
        if met:
            for i in range(0, len(counts), chunk):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // chunk], pa.int32()), pa.array([zlib.compress(counts[i : i + chunk].tobytes(), 1)], pa.binary())],
                    ["chunk", "counts"],
                )

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.int64)
        for batch in rows.to_batches(max_chunksize=64):
            for x in batch.column(batch.schema.get_field_index("counts")).to_pylist():
                total += np.frombuffer(zlib.decompress(x), np.uint8)
        middle = float(np.median(total))
        often = total >= max(2, np.ceil(middle + 2 * np.sqrt(middle) + 1))
        return pa.table(
            {"chunk": pa.array([key[0].as_py()], pa.int32()), "often": pa.array([np.packbits(often, bitorder="little").tobytes()], pa.binary())}
        )

    parts = docs.select("text").mapInArrow(collect, "chunk int, counts binary")
    rows = parts.groupBy("chunk").applyInArrow(merge, "chunk int, often binary").toArrow()
    made = np.zeros(places >> 3, np.uint8)
    for at, data in zip(rows.column("chunk").to_pylist(), rows.column("often").to_pylist()):
        made[at * (chunk >> 3) : (at + 1) * (chunk >> 3)] = np.frombuffer(data, np.uint8)
    return made


def keyed(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(key, node): the keys of every distinct set a task meets. A node is half of
    the set's id; should two sets share it, both are compared."""

    parts = num >= PART_LEAST * den
    shared = None if parts else shared_grams(docs, width)

    def step(batches):
        shingler, met = Shingler(width), set()
        for batch in batches:
            for part in slices(batch):
                sets = []
                for grams in shingler.sets(part.column(0).to_pylist()):
                    if len(grams) and (own := identity(grams)) not in met:
                        met.add(own)
                        sets.append((int.from_bytes(own[:8], "big", signed=True), grams))
                grams = [g for _, g in sets]
                keys, owner = part_keys(grams, num, den) if parts else prefix_keys(grams, num, den, shared)
                nodes = np.array([n for n, _ in sets], np.int64)[owner]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes)], ["key", "node"])

    return docs.select("text").mapInArrow(step, "key long, node long")


def members_of(docs: DataFrame, sets: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The sets of every group, a row each: g1, g2 (the group), n (its nodes), first (the
    smallest), keys, node, set_id, n_shingles. A group is the nodes that have some key;
    ``keys`` have the same nodes and are one group, named by 128 bits of its nodes. Groups
    of one node are left out."""
    per_key = "OVER (PARTITION BY key)"
    several = (
        keyed(docs, width, num, den)
        .select("key", "node", F.expr(f"min(node) {per_key}").alias("low"), F.expr(f"max(node) {per_key}").alias("high"))
        .filter("low < high").select("key", "node").distinct()
    )
    groups = several.select(
        *[F.expr(f"bit_xor(xxhash64(node, {i})) {per_key}").alias(f"g{i}") for i in (1, 2)],
        F.expr(f"count(*) {per_key}").alias("n"), F.expr(f"min(node) {per_key}").alias("first"), "node",
    ).groupBy("g1", "g2", "n", "first", "node").agg(F.count("*").alias("keys"))
    known = sets.select(node_of(F.col("set_id")).alias("node"), "set_id", "n_shingles")
    return staged(groups.join(known, "node"), "join-members")


def pairs_of(members: DataFrame, num: int, den: int) -> DataFrame:
    """(x, y, g1, g2, x_first, y_first): the pairs of sets within the groups of PAIR_MOST nodes
    or fewer, each once, with one of their groups and the keys of the groups that either is
    the first node of. Sizes that can't be linked are left out, and so are prefixes that
    have too few keys in common, as those of a linked pair have PREFIX_KEYS."""
    few = members.filter(F.col("n") <= PAIR_MOST).drop("n")
    x, y = few.alias("x"), few.alias("y")
    sizes = F.col("x.n_shingles"), F.col("y.n_shingles")
    both = x.join(
        y,
        (F.col("x.g1") == F.col("y.g1")) & (F.col("x.g2") == F.col("y.g2")) & (F.col("x.set_id") < F.col("y.set_id"))
        & (F.greatest(*sizes) * num <= F.least(*sizes) * den),
    )
    led = [F.sum(F.when(F.col(f"{c}.node") == F.col(f"{c}.first"), F.col(f"{c}.keys")).otherwise(0)).alias(f"{c}_first") for c in "xy"]
    pairs = both.groupBy(F.col("x.set_id").alias("x"), F.col("y.set_id").alias("y")).agg(
        F.sum("x.keys").alias("keys"), F.min(F.least(*sizes)).alias("least"), F.min(F.struct("x.g1", "x.g2")).alias("g"), *led
    )
    wanted = 1 if num >= PART_LEAST * den else F.least(F.lit(PREFIX_KEYS), F.ceil(F.col("least") * num / den))
    return staged(pairs.filter(F.col("keys") >= wanted).select("x", "y", "g.g1", "g.g2", "x_first", "y_first"), "join-pairs")


def node_of(set_id: Column) -> Column:
    return F.conv(F.substring(F.hex(set_id), 1, 16), 16, -10).cast("long")


def blocks_of(sets: Column, grams: Column) -> Column:
    return F.ceil(F.greatest(sets / BLOCK_SETS, grams / BLOCK_GRAMS)).cast("int")


def block_in(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("set_id"), blocks).cast("int")


def led(members: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of pairs and large groups: set_id, doc_id, n_shingles, node, lead, blocks, cell.
    ``lead`` is the node that is the first of most of a set's keys, null if it is its own;
    the sets of one lead are dealt into ``blocks``, a set into the one of its ``cell``."""
    large = members.filter(F.col("n") > PAIR_MOST)
    found = (
        pairs.select(F.col("y").alias("set_id"), node_of(F.col("x")).alias("lead"), F.col("x_first").alias("keys"))
        .unionByName(pairs.select(F.col("x").alias("set_id"), node_of(F.col("y")).alias("lead"), F.col("y_first").alias("keys")))
        .unionByName(large.select("set_id", F.col("first").alias("lead"), "keys"))
        .groupBy("set_id", "lead").agg(F.sum("keys").alias("keys"))
    )
    followed = F.when((F.col("keys") > 0) & (F.col("lead") != node_of(F.col("set_id"))), F.struct("keys", "lead"))
    best = found.groupBy("set_id").agg(F.max(followed)["lead"].alias("lead"))
    reps = sets.join(best, "set_id").select("set_id", "doc_id", "n_shingles", node_of(F.col("set_id")).alias("node"), "lead")
    reps = staged(reps, "join-led")
    size = reps.filter("lead is not null").groupBy("lead").agg(blocks_of(F.count("*"), F.sum("n_shingles")).alias("blocks"))
    return staged(reps.join(size, "lead", "left").withColumn("cell", block_in(F.col("blocks"))), "join-cells")


def around_first(reps: DataFrame) -> DataFrame:
    """The sets that have one lead, with the lead itself in each block."""
    near = reps.filter("lead is not null").select(F.col("lead").alias("g1"), F.col("cell").alias("i"), "doc_id", "set_id")
    size = reps.filter("lead is not null").select(F.col("lead").alias("node"), F.col("blocks").alias("most")).distinct()
    leads = reps.join(size, "node").select(
        F.col("node").alias("g1"), F.explode(F.sequence(F.lit(0), F.col("most") - 1)).alias("i"), "doc_id", "set_id"
    )
    i = F.col("i")
    return near.unionByName(leads).select(
        "g1", F.lit(0).cast("long").alias("g2"), "i", i.alias("j"), i.alias("block"), "doc_id", "set_id", F.col("set_id").alias("name")
    )


def other_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs that have not met and don't have one name; those of a group meet at once."""
    sides = [reps.select(*[F.col(c).alias(f"{p}_{c}") for c in ("set_id", "node", "lead", "cell", "name")]) for p in "ab"]
    joined = pairs.join(sides[0], F.col("x") == F.col("a_set_id")).join(sides[1], F.col("y") == F.col("b_set_id"))
    met = F.expr("(a_lead <=> b_lead and a_cell <=> b_cell and a_lead is not null) or a_lead <=> b_node or b_lead <=> a_node")
    rest = joined.filter((F.col("a_name") != F.col("b_name")) & ~met)
    own = rest.select("g1", "g2", F.explode(F.array("x", "y")).alias("set_id")).distinct().join(reps, "set_id")
    zero = F.lit(0)
    return own.select("g1", "g2", zero.alias("i"), zero.alias("j"), zero.alias("block"), "doc_id", "set_id", "name")


def large_groups(members: DataFrame, reps: DataFrame) -> DataFrame:
    """The sets of the large groups that have several names and have not all met. A group
    of several blocks has those of its largest name apart: any two blocks meet but two of
    that name."""
    large = members.filter(F.col("n") > PAIR_MOST).select("g1", "g2", "first", "set_id")
    met = large.join(reps, "set_id")
    group = ["g1", "g2"]
    near = F.col("node") != F.col("first")  # else it has met those it leads
    one = lambda c, *of: F.min(F.when(*of, c) if of else c).eqNullSafe(F.max(F.when(*of, c) if of else c))
    follows = F.coalesce("lead", "node")
    seen = met.groupBy(group).agg(
        ((one(follows) & one(F.col("cell"))) | (one(follows, near) & (F.min(F.when(near, follows)) == F.min("first")) & one(F.col("cell"), near))).alias("seen")
    )
    per = met.groupBy(*group, "name").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("grams"))
    size = per.groupBy(group).agg(
        F.max(F.struct("sets", "grams", "name")).alias("top"), F.count("*").alias("names"), F.sum("sets").alias("sets"), F.sum("grams").alias("grams")
    ).filter("names > 1")
    small = blocks_of(F.col("sets"), F.col("grams")) == 1
    rest = blocks_of(F.col("sets") - F.col("top.sets"), F.col("grams") - F.col("top.grams"))
    size = size.join(seen.filter(~F.coalesce("seen", F.lit(False))), group, "left_semi").select(
        *group, F.col("top.name").alias("top"),
        F.when(small, 0).otherwise(blocks_of(F.col("top.sets"), F.col("top.grams"))).alias("tops"),
        F.when(small, 1).otherwise(rest).alias("others"),
    )
    of_top = (F.col("tops") > 0) & (F.col("name") == F.col("top"))
    own = F.when(of_top, block_in(F.greatest("tops", F.lit(1)))).otherwise(F.col("tops") + block_in(F.col("others")))
    placed = met.join(size, group).withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.when(of_top, F.col("tops")).otherwise(0), F.col("tops") + F.col("others") - 1))
    )
    return placed.select(*group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "set_id", "name")


def verify(docs: DataFrame, dealt: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) between the names of linked sets that meet. ``dealt``: g1, g2, i, j (two
    blocks that meet), block (the one a set is in), doc_id, set_id, and a name that sets have
    in common which are known to be linked."""
    dealt = staged(dealt, "join-candidates")
    ids = staged(dealt.select(F.xxhash64("doc_id").alias("h")).distinct(), "join-dealt")
    likely = bits.prefilter(ids, "h", ids.count())
    texts = docs.filter(likely.holds(F.xxhash64("doc_id"))).withColumnRenamed("doc_id", "id")
    met = dealt.join(texts, F.col("doc_id").eqNullSafe(F.col("id"))).drop("doc_id", "id")

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        shingler, sides, seen = Shingler(width), {}, set()
        i, j = (k.as_py() for k in key[2:])
        for batch in rows.select(["block", "set_id", "text", "name"]).to_batches(max_chunksize=64):
            block, ids, names = (batch.column(c).to_pylist() for c in (0, 1, 3))
            for b, own, grams, name in zip(block, ids, shingler.sets(batch.column(2).to_pylist()), names):
                if own not in seen and identity(grams) == own:  # an id may have several texts
                    seen.add(own)
                    sides.setdefault(b, []).append((own, grams, name))
        left = sorted(sides.get(i, []), key=lambda x: x[0])
        right = sorted(sides.get(j, []), key=lambda x: x[0]) if j != i else None
        names = [n for _, _, n in left + (right or [])]
        boss = find_links([g for _, g, _ in left], None if right is None else [g for _, g, _ in right], num, den, names)
        pairs = {(names[x], names[y]) for x, y in enumerate(boss.tolist()) if names[x] != names[y]}
        return pa.table({"a": pa.array([x for x, _ in pairs], pa.binary()), "b": pa.array([y for _, y in pairs], pa.binary())})

    return met.groupBy("g1", "g2", "i", "j").applyInArrow(compare, "a binary, b binary")


def linked_sets(docs: DataFrame, sets: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(set_id, root) of the sets that are linked to another one."""
    members = members_of(docs, sets, width, num, den)
    pairs = pairs_of(members, num, den)
    reps = led(members, pairs, sets)
    near = components(verify(docs, around_first(reps), width, num, den)).withColumnRenamed("node", "set_id")
    reps = staged(
        reps.join(near, "set_id", "left").withColumn("name", F.coalesce("root", "set_id")).withColumn("tied", F.col("root").isNotNull()).drop("root"),
        "join-near",
    )
    rest = other_pairs(pairs, reps).unionByName(large_groups(members, reps))
    ends = components(verify(docs, rest, width, num, den)).withColumnRenamed("node", "name")
    found = reps.join(ends, "name", "left").filter(F.col("tied") | F.col("root").isNotNull())
    return found.select("set_id", F.coalesce("root", "name").alias("root"))


def grouped(plain: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The rows of (doc_id, text) as doc_id, n_shingles, set_id, and the sets that are
    linked or have several rows: set_id, doc_id (the smallest), docs, root."""
    described = staged(describe(plain, width).drop("text"), "join-sets")
    sets = staged(
        described.filter("set_id is not null").groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("docs"), F.max("n_shingles").alias("n_shingles")),
        "join-distinct",
    )
    roots = linked_sets(plain, sets, width, num, den)
    linked = sets.join(roots, "set_id", "left").filter("root is not null or docs > 1")
    return described, linked.select("set_id", "doc_id", "docs", F.coalesce("root", "set_id").alias("root"))


def join_similar(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when the Jaccard similarity of their sets of ``width``-word n-grams is
    at least ``num / den``; component_id is the smallest doc_id that links reach. Null
    and empty texts have no n-grams and no links: their component is their own id. Rows
    of equal text are linked; rows that share an id keep their own texts and sets. A null
    id is larger than any other; a component of null ids alone has a null id. An empty
    table gives no rows; other columns are ignored.
    """
    described, linked = grouped(pick(docs, ("doc_id", "long"), ("text", "string")), width, num, den)
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = staged(linked.join(least, "root").select("set_id", "component_id"), "join-components")
    return described.join(named, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component, with all columns, and all rows without words.

    Of a component that row stays which has the smallest id (a null id is larger than any
    other), then the smallest set, then the smallest text. What a row is removed for is
    its set, never its id: rows without an id go like others, and rows that share an id
    stay or go by their own texts.
    """
    described, linked = grouped(pick(docs, ("doc_id", "long"), ("text", "string")), width, num, den)
    linked = staged(linked, "join-linked")
    best = linked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_id")).alias("best"))
    named = staged(
        linked.join(best, "root").select(
            F.col("set_id").alias("__set"), F.col("doc_id").alias("__least"), F.col("docs").alias("__docs"),
            (F.col("set_id") == F.col("best.set_id")).alias("__best"),
        ),
        "join-best",
    )
    # only rows whose id occurs in a component are looked at again
    ids = described.join(linked.select("set_id"), "set_id").select(F.xxhash64("doc_id").alias("h")).distinct()
    ids = staged(ids, "join-ids")
    likely = bits.prefilter(ids, "h", ids.count())

    def make():
        shingler = Shingler(width)
        return lambda texts: [pa.array([identity(s) if len(s) else None for s in shingler.sets(texts.to_pylist())], pa.binary())]

    # the row is held in one column, so that no other can clash with its own
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    maybe = likely.holds(F.xxhash64(F.col("`doc_id`").cast("long")))
    own = free_name("own", docs.columns)
    known = with_columns(docs.filter(maybe), ["text"], [(own, T.BinaryType())], make).select(row, F.col(f"`{own}`").alias("own"))
    met = known.join(named, F.col("own") == F.col("__set"), "left")
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("__least"))
    stay = staged(met.filter(F.col("__set").isNull() | F.col("__best") & same).select("row", "__set", "__docs"), "join-stay")
    single = F.col("__set").isNull() | (F.col("__docs") == 1)
    plain = [F.col(f"row.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    order = F.struct(F.col("row.text").alias("text"), F.xxhash64(*plain))  # of rows of one id and set
    ones = stay.filter(~single).groupBy("__set").agg(F.min_by("row", order).alias("row")).select("row")
    rest = docs.filter(~maybe).select(row)
    return rest.unionByName(stay.filter(single).select("row")).unionByName(ones).select("row.*")
