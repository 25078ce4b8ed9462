"""Trie of the conversations' turn prefixes, as double arrays per prefix shard (operator 11).

1. Turns get their place in the conversation by range parts, so that a long conversation is spread.
2. A turn at its place is two 64-bit hashes; a prefix is known by the exclusive or of its turns, which adds up
   over any cut of a conversation. Conversations are cut into segments of ``SEGMENT`` turns; equal segments
   with equal turns before them become one row with a count, on the map side first.
3. Distinct segments are dealt by range in the order of their turns, so no common first turn fills a task. Each
   stretch of that order is a shard: its BASE and CHECK arrays are packed over dense turn numbers, walked by
   all its segments, and give its nodes. Only the first and the last path of a shard can lie in other shards
   too: those nodes are merged over all shards.
4. Sub-tries of later segments add their sums to the node they hang from by pointer doubling, in as
   many rounds as the number of segments of the longest conversation has binary digits.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_spark.llm.tasks import SPACE, begin, record, segments, ship
from registry_spark.sources.shared import written

SEGMENT = 64
# Turns of distinct segments that one pair of arrays holds.
SHARD = 1 << 18
# Slots for each of those turns; a stretch of segments whose arrays need more is cut in two.
ROOM = 4
# Slots in which a place for several children is looked for before the end is taken.
WINDOW = 1 << 12
# Places over all the array that are tried too for children of scattered numbers, and slots looked at in one step.
PLACES, LOOKS = 1 << 10, 1 << 14
# Segments of a conversation that one window adds up.
SPAN = 1 << 10
# Characters of a text that take part in dealing out turns of equal number.
TIE_CHARS = 32
# Conversation ids whose text is hashed as one piece.
ENDS = 1 << 14
NODE = "hi long, lo long, block long, depth long"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


class Crowded(Exception):
    """The arrays would take more slots than they may."""


class DoubleArray:
    """BASE and CHECK: the child of slot s by number c is base[s] + c, if check there is s. Slot 0 is the top."""

    def __init__(self, most: int | None = None):
        self.base = np.zeros(1, np.int64)
        self.check = np.full(1, -2, np.int64)  # -1: free
        self.free = 1  # no free slot lies before
        self.end = 1  # no other slot lies from here on; the arrays may be longer
        self.most = most

    def grow(self, size: int) -> None:
        if self.most is not None and size > self.most:
            raise Crowded
        more = size - len(self.check)
        if more > 0:
            more = max(more, len(self.check) // 2)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))
        self.end = max(self.end, size)

    def trim(self) -> None:
        self.base, self.check = self.base[: self.end].copy(), self.check[: self.end].copy()

    def place(self, parents: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Give all children of some slots a place; ``parents`` come in runs. Returns the children's slots."""
        first = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
        sizes = np.diff(np.append(first, len(parents)))
        slots = np.empty(len(parents), np.int64)
        for i in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")].tolist():
            some = numbers[first[i] : first[i] + sizes[i]]
            slots[first[i] : first[i] + sizes[i]] = self.fit(int(parents[first[i]]), some)
        alone = first[sizes == 1]
        if len(alone):
            # An only child fits any free slot: its parent's base follows from the slot.
            free = self.free + np.flatnonzero(self.check[self.free : self.end] == -1)[: len(alone)]
            past = np.arange(self.end, self.end + len(alone) - len(free))
            self.grow(self.end + len(past))
            free = np.concatenate((free, past))
            self.base[parents[alone]] = free - numbers[alone]
            self.check[free] = parents[alone]
            slots[alone] = free
        return slots

    def fit(self, parent: int, numbers: np.ndarray, tries: int = 256) -> np.ndarray:
        """First base among some at which every number meets a free slot, else one past the end."""
        low = int(numbers.min())
        gaps = numbers - low
        free = self.vacant()[:tries]
        start = self.first(free, gaps)
        if start is None and int(gaps.max()) >= 4 * len(gaps):
            # Past the end they would leave many slots free.
            start = self.first(np.arange(self.free, self.end, max(1, (self.end - self.free) // PLACES)), gaps)
        base = (self.end if start is None else start) - low
        self.grow(max(self.end, base + int(numbers.max()) + 1))
        self.base[parent] = base
        self.check[base + numbers] = parent
        return base + numbers

    def vacant(self) -> np.ndarray:
        """The first free slots: those of the first window that has any."""
        while self.free < self.end:
            found = np.flatnonzero(self.check[self.free : min(self.free + WINDOW, self.end)] == -1)
            if len(found):
                found += self.free
                self.free = int(found[0])
                return found
            self.free = min(self.free + WINDOW, self.end)
        return np.zeros(0, np.int64)

    def first(self, starts: np.ndarray, gaps: np.ndarray) -> int | None:
        """First of some slots from which all gaps lead to free slots."""
        at, n = 0, 2
        while len(starts) and at < len(gaps):
            n = max(1, min(2 * n, LOOKS // len(starts)))
            to = starts[:, None] + gaps[at : at + n]
            starts = starts[((to >= self.end) | (self.check[np.minimum(to, self.end - 1)] == -1)).all(1)]
            at += n
        return int(starts[0]) if len(starts) else None

    def step(self, slots: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Children of slots by number; -1 where there is none."""
        to = self.base[slots] + numbers
        inside = (to >= 0) & (to < len(self.check))
        found = np.where(inside, to, 0)
        return np.where(inside & (self.check[found] == slots), found, -1)


def dense(pairs: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Numbers of distinct rows, given in the ``order`` in which they are met first."""
    by = np.lexsort((order, pairs[:, 1], pairs[:, 0]))
    some = pairs[by]
    new = np.ones(len(some), bool)
    new[1:] = (some[1:] != some[:-1]).any(1)
    number = np.cumsum(new) - 1
    rank = np.empty(int(number[-1]) + 1 if len(number) else 0, np.int64)
    rank[np.argsort(order[by][new], kind="stable")] = np.arange(len(rank))
    out = np.empty(len(pairs), np.int64)
    out[by] = rank[number]
    return out


def pack(codes: np.ndarray, bounds: np.ndarray, most: int | None = None) -> DoubleArray:
    """Arrays of all prefixes of distinct sequences in lexical order, level by level; Crowded if above ``most`` slots."""
    trie, lengths = DoubleArray(most), np.diff(bounds)
    slot = np.zeros(len(lengths), np.int64)
    some = np.flatnonzero(lengths > 0)
    depth = 0
    while len(some):
        parents, numbers = slot[some], codes[bounds[some] + depth]
        new = np.ones(len(some), bool)
        new[1:] = (parents[1:] != parents[:-1]) | (numbers[1:] != numbers[:-1])
        slot[some] = trie.place(parents[new], numbers[new])[np.cumsum(new) - 1]
        depth += 1
        some = some[lengths[some] > depth]
    trie.trim()
    return trie


class Shard:
    """Nodes of a stretch of segments: packed, then walked by all segments, level by level."""

    def __init__(self, rows: pa.Table, most: int | None = None):
        column = lambda name: rows.column(name).combine_chunks()
        number = lambda name: column(name).to_numpy(zero_copy_only=False)
        path = column("path")
        turns = path.flatten()
        bounds = segments(np.diff(path.offsets.to_numpy()))
        hi, lo, words = (turns.field(n).to_numpy(zero_copy_only=False) for n in ("hi", "lo", "words"))
        tops = np.stack([number(n) for n in ("block", "prev_hi", "prev_lo")], 1)
        n, ended, conv = number("n"), number("ended"), number("conv_id")
        below = np.stack([number("below_leaves"), number("below_saved")], 1)
        lengths, count = np.diff(bounds), len(tops)
        # The sub-trie is the first number of a sequence, the turns are the others.
        new = np.ones(count, bool)
        new[1:] = (tops[1:] != tops[:-1]).any(1)
        sub = np.cumsum(new) - 1
        level = np.arange(len(hi)) - np.repeat(bounds[:-1], lengths)
        numbers = dense(np.stack([hi, lo], 1), level * count + np.repeat(np.arange(count), lengths))
        starts = segments(lengths + 1)
        codes = np.empty(int(starts[-1]), np.int64)
        codes[starts[:-1]] = sub + int(numbers.max(initial=-1)) + 1
        codes[np.arange(len(hi)) + np.repeat(np.arange(count), lengths) + 1] = numbers
        self.trie = pack(codes, starts, most)

        size = len(self.trie.check)
        self.n, self.ended = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.conv = np.full(size, np.iinfo(np.int64).max)
        self.depth, self.words, self.block = (np.zeros(size, np.int64) for _ in range(3))
        self.key = np.zeros((size, 2), np.int64)
        self.below = np.zeros((size, 2), np.int64)
        edge = np.zeros(size, bool)
        slot, key, some = np.zeros(count, np.int64), tops[:, 1:].copy(), np.arange(count)
        paths: list[list[int]] = [[], []]
        for depth in range(int(lengths.max(initial=0)) + 1):
            slot[some] = self.trie.step(slot[some], codes[starts[some] + depth])
            if depth:
                at = bounds[some] + depth - 1
                key[some, 0] ^= hi[at]
                key[some, 1] ^= lo[at]
                self.words[slot[some]] = words[at]
            np.add.at(self.n, slot[some], n[some])
            np.minimum.at(self.conv, slot[some], conv[some])
            self.key[slot[some]] = key[some]
            self.depth[slot[some]] = depth
            self.block[slot[some]] = tops[some, 0]
            for path, row in zip(paths, (0, count - 1)):
                if lengths[row] >= depth:
                    path.append(int(slot[row]))
            some = some[lengths[some] > depth]
        last = slot  # where each segment ends
        np.add.at(self.ended, last, ended)
        np.add.at(self.below, last, below)
        self.paths = paths
        edge[np.concatenate([np.array(p, np.int64) for p in paths])] = True
        self.edge = edge
        self.sums()

    def sums(self) -> None:
        """Sums over the nodes below that no other shard can hold, from the deepest level up by CHECK."""
        check = self.trie.check
        self.nodes = np.flatnonzero(check >= 0)
        size = len(check)
        parent = check[self.nodes]
        children = np.bincount(parent, minlength=size)
        inner = ~self.edge & (check >= 0)
        self.children = np.where(self.edge, np.bincount(parent[inner[self.nodes]], minlength=size), children)
        top = self.depth == 0
        leaf = inner & ~top & (children == 0) & (self.n == self.ended)
        own = inner & ~top
        self.leaves = np.where(own, leaf + self.below[:, 0], 0)
        self.saved = np.where(own, (self.n - 1) * self.words + self.below[:, 1], 0)
        deepest = self.depth[self.nodes].max(initial=0)
        for depth in range(int(deepest), 0, -1):
            some = self.nodes[self.depth[self.nodes] == depth]
            np.add.at(self.leaves, check[some], self.leaves[some])
            np.add.at(self.saved, check[some], self.saved[some])

    def table(self, number: int) -> pa.RecordBatch:
        """One row a node. ``shared`` nodes are to be merged: sub-trie tops and the first and last path."""
        s, check = self.nodes, self.trie.check
        up = check[s]
        shared = self.edge[s] | (self.depth[s] == 0)
        known = ~(self.edge[up] | (self.depth[up] == 0)) & ~shared
        above = {}
        for path in self.paths:
            for i, slot in enumerate(path):
                above[slot] = [{"hi": int(h), "lo": int(o)} for h, o in self.key[path[: i + 1]].tolist()]
        return record(
            shard=np.full(len(s), number), hi=self.key[s, 0], lo=self.key[s, 1], block=self.block[s], depth=self.depth[s],
            up_hi=self.key[up, 0], up_lo=self.key[up, 1], shared=shared, edge=self.edge[s],
            n=self.n[s], ended=self.ended[s], conv_id=self.conv[s], words=self.words[s], children=self.children[s],
            leaves=self.leaves[s], saved=self.saved[s], below_leaves=self.below[s, 0], below_saved=self.below[s, 1],
            up_conv=pa.array(self.conv[up], mask=~known),
            above=pa.array([above.get(i, []) for i in s.tolist()], pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int64())]))),
        )


SHARD_ROW = (
    f"shard long, {NODE}, up_hi long, up_lo long, shared boolean, edge boolean, n long, ended long, conv_id long, words long, "
    "children long, leaves long, saved long, below_leaves long, below_saved long, up_conv long, above array<struct<hi: long, lo: long>>"
)


def packed(rows: pa.Table, most: int, numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
    """Nodes of the rows' shard, or of those of its halves if its arrays would take more than ``most`` slots."""
    try:
        out = Shard(rows, most if rows.num_rows > 1 else None).table(next(numbers))
    except Crowded:
        out = None
    if out is not None:
        yield out
        return
    half = rows.num_rows // 2
    yield from packed(rows.slice(0, half), most, numbers)
    yield from packed(rows.slice(half), most, numbers)


def shard_rows(distinct: DataFrame, turns: int = SHARD) -> DataFrame:
    """Nodes of every shard of segments in lexical order; ``depth`` counts from the segment's start."""
    order = ["block", "prev_hi", "prev_lo", "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        numbers, held, size = itertools.count(TaskContext.get().partitionId() << 32), [], 0
        for batch in batches:
            lengths = np.diff(batch.column("path").offsets.to_numpy()) + 1
            part = (size + np.cumsum(lengths) - lengths) // turns
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]
            for a, b in zip(cuts, cuts[1:]):
                if held and size >= turns:
                    yield from packed(pa.Table.from_batches(held), ROOM * turns, numbers)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += int(lengths[a:b].sum())
        if held:
            yield from packed(pa.Table.from_batches(held), ROOM * turns, numbers)

    ship(distinct.sparkSession)
    return distinct.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SHARD_ROW)


def range_parts(rows: DataFrame, order: list[Column], deal: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows in order, with row and part, and where each conversation starts in each part: conv_id, part, first, n, before.

    Rows are dealt out by ``deal``, of which ``order`` is a refinement; rows alike in ``deal`` stay together.
    """
    key = F.col("conv_id")
    ordered = rows.repartitionByRange(key, *deal).sortWithinPartitions(key, *order)
    kept = [c for c in rows.columns if c not in ("turn", "role", "text")]
    ordered = written(ordered.select(*kept, F.monotonically_increasing_id().alias("row")).withColumn("part", F.shiftright("row", 33)))
    starts = ordered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ordered, written(starts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))


class PrefixTrie:
    """Trie of the turn prefixes of conversations, the first turns of which may come from another one.

    Turns are ordered by ``turn`` (NULL first), then by role and text, so ties have one order; NULL role or text
    is empty; repeated rows are turns of their own. Rows without a conversation id belong to no conversation
    and take no part. ``shared`` gives, for a conversation id, how many turns come first from which
    other conversation (all it has, if fewer; none, if there is no such conversation); its own turns
    follow from there on. A conversation without any turn left is a member of the top alone. An empty table
    gives no nodes. Other columns are not looked at. ``turns`` keeps the rebuilt turns.

    ``nodes``: one row a node with conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, and hi, lo, by which ``ends`` tells what conversations end there.
    """

    def __init__(
        self, conversations: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        shared: tuple[Column, Column] | None = None, segment: int = SEGMENT, shard: int = SHARD,
    ):
        self.segment = segment
        whole = lambda c: F.coalesce(F.col(c), F.lit(""))
        rows = conversations.filter(F.col(conversation).isNotNull()).select(
            F.col(conversation).cast("long").alias("conv_id"), F.col(turn).alias("turn"), whole(role).alias("role"), whole(text).alias("text")
        )
        known = rows.select(
            "*", F.xxhash64("role", "text").alias("hash1"), F.xxhash64(F.lit(1), "role", "text").alias("hash2"),
            F.regexp_count("text", F.lit(SPACE.replace("[", "[^"))).cast("long").alias("words"),
        )
        order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
        ordered, starts = range_parts(known, order, [order[0], F.col("role"), F.substring("text", 1, TIE_CHARS)])
        self.turns = written(self.rebuilt(ordered, starts, shared))
        self.segments = written(self.cut())
        self.nodes, self.ends = self.merged(shard)

    def rebuilt(self, ordered: DataFrame, starts: DataFrame, shared: tuple[Column, Column] | None) -> DataFrame:
        """Turns as rebuilt, and one row with ``length`` a conversation: conv_id, pos, hash1, hash2, words, length.

        What concerns a whole conversation comes to its turns with the starts of its parts, one row a part.
        """
        values = ["pos", "hash1", "hash2", "words"]
        base, n = shared or (F.col("conv_id"), F.lit(0))
        convs = starts.groupBy("conv_id").agg(F.sum("n").alias("own")).select("conv_id", "own", base.alias("base"), n.cast("long").alias("taken"))
        there = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
        convs = convs.join(there, "base", "left").withColumn("got", F.least(F.coalesce("there", F.lit(0)), "taken"))
        convs = written(convs.withColumn("length", F.col("got") + F.greatest(F.col("own") - F.col("taken"), F.lit(0))))
        given = convs.filter("got > 0").groupBy(F.col("base").alias("conv_id")).agg(F.max("got").alias("given"))
        starts = starts.select("conv_id", "part", "first", "before").join(convs.select("conv_id", "taken", "got"), "conv_id").join(given, "conv_id", "left")
        turns = ordered.join(starts, ["conv_id", "part"]).withColumn("pos", F.col("row") - F.col("first") + F.col("before"))
        # Own turns move up where the other conversation has fewer than are taken.
        mine = turns.filter("pos >= taken").withColumn("pos", F.col("pos") - F.col("taken") + F.col("got")).select("conv_id", *values)
        takers = convs.filter("got > 0").select("conv_id", F.col("base").alias("from"), "got")
        first = turns.filter("pos < given").select(F.col("conv_id").alias("from"), *values).join(takers, "from").filter("pos < got")
        some = mine.unionByName(first.select("conv_id", *values)).withColumn("length", F.lit(None).cast("long"))
        marks = convs.select("conv_id", F.lit(None).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(v) for v in values[1:]], "length")
        return some.unionByName(marks)

    def cut(self) -> DataFrame:
        """Segments: conv_id, block, path, ended, hi, lo of its turns, and prev_hi, prev_lo of all turns before."""
        at = F.coalesce(F.col("pos"), F.greatest(F.col("length") - 1, F.lit(0)))
        hashes = F.xxhash64("pos", "hash1", "hash2"), F.xxhash64(F.lit(1), "pos", "hash2", "hash1")
        turn = F.when(F.col("pos").isNotNull(), F.struct("pos", hashes[0].alias("hi"), hashes[1].alias("lo"), "words"))
        lane = lambda i: F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), hashes[i])), F.lit(0).cast("long"))
        blocks = self.turns.withColumn("block", F.floor(at / self.segment)).groupBy("conv_id", "block").agg(
            F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["words"].alias("words"))).alias("path"),
            F.count("length").alias("ended"), lane(0).alias("hi"), lane(1).alias("lo"),
        )
        blocks = written(blocks)
        zero = F.lit(0).cast("long")
        alone = blocks.filter("block = 0 AND ended = 1").withColumn("prev_hi", zero).withColumn("prev_lo", zero)
        long = blocks.filter("block > 0 OR ended = 0").withColumn("span", F.expr(f"block div {SPAN}"))
        inside = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        spans = long.groupBy("conv_id", "span").agg(*[F.bit_xor(c).alias(f"all_{c}") for c in ("hi", "lo")])
        across = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
        spans = spans.select("conv_id", "span", *[F.coalesce(F.bit_xor(f"all_{c}").over(across), zero).alias(f"old_{c}") for c in ("hi", "lo")])
        long = long.join(spans, ["conv_id", "span"])
        for c in ("hi", "lo"):
            long = long.withColumn(f"prev_{c}", F.col(f"old_{c}").bitwiseXOR(F.coalesce(F.bit_xor(c).over(inside), zero)))
        out = alone.unionByName(long.select(*alone.columns))
        return out.withColumn("hi", F.col("hi").bitwiseXOR(F.col("prev_hi"))).withColumn("lo", F.col("lo").bitwiseXOR(F.col("prev_lo")))

    def distinct(self) -> DataFrame:
        """Segments that differ, with their number of conversations."""
        keys = ["block", "prev_hi", "prev_lo", "hi", "lo", "path"]
        zero = F.lit(0).cast("long")
        return self.segments.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum("ended").alias("ended"), F.min("conv_id").alias("conv_id")
        ).withColumn("below_leaves", zero).withColumn("below_saved", zero)

    def merged(self, shard: int) -> tuple[DataFrame, DataFrame]:
        distinct = written(self.distinct())
        deepest = distinct.agg(F.max("block")).first()[0] or 0
        if deepest:
            later = written(shard_rows(distinct.filter("block > 0").drop("hi", "lo"), shard))
            sums = self.hanging(self.shared_nodes(later).filter("depth = 0"), distinct, int(deepest))
            distinct = distinct.drop("below_leaves", "below_saved").join(sums, ["hi", "lo"], "left").fillna(0, ["below_leaves", "below_saved"])
        rows = written(shard_rows(distinct.drop("hi", "lo"), shard))
        shared = written(self.shared_nodes(rows))
        return written(self.assembled(rows, shared)), self.segments.filter("ended = 1").select("hi", "lo", "conv_id")

    def shared_nodes(self, rows: DataFrame) -> DataFrame:
        """Nodes that several shards may hold, merged; there are at most two paths a shard, and the tops."""
        key = ["block", "hi", "lo", "depth"]
        some = rows.filter("shared").groupBy(*key).agg(
            *[F.sum(c).alias(c) for c in ("n", "ended", "children", "leaves", "saved", "below_leaves", "below_saved")],
            F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.max("up_hi").alias("up_hi"), F.max("up_lo").alias("up_lo"),
            F.max("edge").alias("edge"), F.max("above").alias("above"),
        )
        some = written(some)
        up = F.col("depth") - 1
        more = some.filter("edge AND depth > 0").groupBy("block", F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"), up.alias("depth"))
        some = some.join(more.agg(F.count(F.lit(1)).alias("more")), key, "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more")
        # What the merged nodes themselves add to every node above them, their own included.
        leaf = ((F.col("children") == 0) & (F.col("n") == F.col("ended"))).cast("long")
        own = some.filter("edge AND depth > 0").select(
            "block", F.posexplode("above").alias("depth", "at"),
            (leaf + F.col("below_leaves")).alias("own_leaves"), ((F.col("n") - 1) * F.col("words") + F.col("below_saved")).alias("own_saved"),
        )
        own = own.groupBy("block", F.col("at.hi").alias("hi"), F.col("at.lo").alias("lo"), F.col("depth").cast("long").alias("depth")).agg(
            F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved")
        )
        out = some.join(own, key, "left").fillna(0, ["own_leaves", "own_saved"])
        return out.withColumn("leaves", F.col("leaves") + F.col("own_leaves")).withColumn("saved", F.col("saved") + F.col("own_saved")).drop("own_leaves", "own_saved", "above")

    def hanging(self, tops: DataFrame, distinct: DataFrame, deepest: int) -> DataFrame:
        """Sums of everything that hangs from the end of a segment: hi, lo, below_leaves, below_saved."""
        up = distinct.filter("block > 0").select(F.col("block") + 1, "hi", "lo", F.col("prev_hi").alias("up_hi"), F.col("prev_lo").alias("up_lo")).distinct()
        up = up.toDF("block", "hi", "lo", "up_hi", "up_lo")
        now = written(tops.select("block", "hi", "lo", "leaves", "saved").join(up, ["block", "hi", "lo"], "left"))
        for step in range(max(0, (deepest - 1).bit_length())):
            far = 1 << step
            more = now.filter("up_hi IS NOT NULL").groupBy((F.col("block") - far).alias("block"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))
            more = more.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
            jump = now.select((F.col("block") + far).alias("block"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("up_hi").alias("far_hi"), F.col("up_lo").alias("far_lo"))
            joined = now.join(more, ["block", "hi", "lo"], "left").join(jump, ["block", "up_hi", "up_lo"], "left")
            now = written(joined.select(
                "block", "hi", "lo", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), F.col("far_hi").alias("up_hi"), F.col("far_lo").alias("up_lo"),
            ))
        return now.select("hi", "lo", F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))

    def assembled(self, rows: DataFrame, shared: DataFrame) -> DataFrame:
        """All nodes, those of one shard and the merged ones, with their parent's smallest member."""
        depth = F.col("block") * self.segment + F.col("depth")
        columns = ["block", "depth", "hi", "lo", "up_hi", "up_lo", "conv_id", "n", "ended", "children", "leaves", "saved"]
        tops = shared.filter("depth = 0")
        merged = shared.filter("depth > 0 OR block = 0").select(*columns)
        inner = rows.filter("NOT shared")
        # The end of a full segment has the children of the sub-trie that hangs from it, and gives that its member.
        ends = merged.unionByName(inner.select(*columns)).filter(f"depth = {self.segment}").select((F.col("block") + 1).alias("block"), "hi", "lo", "conv_id")
        member = tops.filter("block > 0").select("block", "hi", "lo").join(ends, ["block", "hi", "lo"])
        ups = shared.filter("depth > 0 OR block = 0").select("block", "depth", "hi", "lo", "conv_id").unionByName(member.select("block", F.lit(0).cast("long").alias("depth"), "hi", "lo", "conv_id"))
        up_key = ["block", "up_depth", "up_hi", "up_lo"]
        ups = ups.toDF("block", "up_depth", "up_hi", "up_lo", "found_conv")
        with_up = lambda df: df.withColumn("up_depth", F.col("depth") - 1)
        # Children of a merged node are many, but few in one shard: they are joined by shard.
        here = rows.filter("shared").select("shard", "block", F.col("depth").alias("up_depth"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo")).join(ups, up_key)
        inner = with_up(inner.select("shard", "up_conv", *columns))
        known = inner.filter("up_conv IS NOT NULL").withColumnRenamed("up_conv", "parent_conv_id")
        asked = inner.filter("up_conv IS NULL").drop("up_conv").join(here, ["shard", *up_key]).withColumnRenamed("found_conv", "parent_conv_id")
        merged = with_up(merged).join(ups, up_key, "left").withColumnRenamed("found_conv", "parent_conv_id")
        names = [*columns, "parent_conv_id"]
        nodes = known.select(*names).unionByName(asked.select(*names)).unionByName(merged.select(*names))
        hung = tops.filter("block > 0").select((F.col("block") - 1).alias("block"), F.lit(self.segment).cast("long").alias("depth"), "hi", "lo", F.col("children").alias("hung"))
        leaf_top = F.when((F.col("block") == 0) & (F.col("depth") == 0) & (F.col("children") == 0), 1).otherwise(0)
        return nodes.join(hung, ["block", "depth", "hi", "lo"], "left").select(
            "conv_id", depth.alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
            (F.col("children") + F.coalesce("hung", F.lit(0))).alias("n_children"), (F.col("leaves") + leaf_top).alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), "hi", "lo",
        )

    def with_digests(self) -> DataFrame:
        """The nodes with ``ends_sha256``: hash of the ascending ids of the conversations that end there, comma-joined.

        Ids are dealt by node and id and joined in pieces; one task then reads a node's pieces in order.
        """

        def run_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hi, lo, conv = (batch.column(i).to_numpy() for i in range(3))
                new = np.ones(len(hi), bool)
                new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
                run = np.cumsum(new)
                within = np.arange(len(hi)) - np.flatnonzero(new)[run - 1]
                first = np.flatnonzero(new | (within % ENDS == 0))
                cuts = [*first.tolist(), len(hi)]
                texts = list(map(str, conv.tolist()))
                yield record(hi=hi[first], lo=lo[first], first=conv[first], ids=[",".join(texts[a:b]) for a, b in zip(cuts, cuts[1:])])

        def run_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, state = None, None
            for batch in batches:
                out = []
                for hi, lo, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                    if key != (hi, lo):
                        if key:
                            out.append((*key, state.hexdigest()))
                        key, state = (hi, lo), hashlib.sha256(ids.encode())
                    else:
                        state.update(b"," + ids.encode())
                if out:
                    a, b, c = zip(*out)
                    yield record(hi=pa.array(a, pa.int64()), lo=pa.array(b, pa.int64()), ends_sha256=c)
            if key:
                yield record(hi=pa.array([key[0]], pa.int64()), lo=pa.array([key[1]], pa.int64()), ends_sha256=[state.hexdigest()])

        order = ["hi", "lo", "conv_id"]
        ends = self.ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        texts = ends.mapInArrow(run_pieces, "hi long, lo long, first long, ids string")
        hashes = texts.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").mapInArrow(run_hash, "hi long, lo long, ends_sha256 string")
        return self.nodes.join(hashes, ["hi", "lo"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_HASH))).drop("hi", "lo")
