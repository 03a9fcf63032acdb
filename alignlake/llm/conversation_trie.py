"""Prefix trie of conversations: double-array tries per prefix shard, joined by global merges.

A conversation is the sequence of its turns (role, text) in order of ``turn``, null first; rows of one turn stand in order of a hash of
role and text, so repeated rows are turns of their own. :func:`rebuilt` replaces the first turns of each conversation by those of
the first conversation of its block, as branches of a chat are stored. Every distinct start of a sequence is a node.

1. Texts become two 64-bit hashes and a word count before the first shuffle. Positions come from ranges of the order key, so a
   conversation of any length is cut into pieces of at most ``PIECE`` turns; each knows how deep and by which prefix it starts.
2. Pieces are range-partitioned by (prefix, path, conversation): a prefix shared by a third of all rows spreads over many
   partitions. A task cuts its rows into shards of about ``SHARD`` turns. A shard numbers its distinct turns densely, packs BASE and CHECK
   arrays (node s has child ``t = BASE[s] + code`` where ``CHECK[t] = s``) and walks all its pieces through them, which gives
   members, smallest member and ends of every node in the shard.
3. Nodes are known by the hash of their prefix at whatever piece or shard they are met, so the aggregates of
   nodes that shards share are merged by one grouping.
4. Sums over a subtree need no walk over it: a node is owned by its smallest member, so the owned nodes of a conversation are the end of
   its path. The sum over a subtree is the sum of the owned totals of its members, less what its owner owns above it.
5. The ids that end at a node are joined in blocks of ``BLOCK`` consecutive ids and hashed block after block in a stream.

Null role or text is the empty string. Rows without a conv_id belong to no conversation and are left out. Without rows there are no
nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alignlake.operators import ordering
from alignlake.session import written

PIECE = 256
SHARD = 100_000
BLOCK = 1 << 16
HEAD = 3  # most turns that a rebuilt conversation takes from the first one of its block
TRIES = 64
WORD = r"[^\x20\x09-\x0D]+"


class DoubleArray:
    """A trie over small integer codes: child ``t = base[s] + code`` of ``s`` exists where ``check[t] == s``."""

    def __init__(self, roots: int):
        self.base = np.zeros(max(roots, 16), np.int64)
        self.check = np.full(max(roots, 16), -1, np.int64)
        self.check[:roots] = -2
        self.low = roots

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))

    def _free(self, count: int) -> np.ndarray:
        """The ``count`` lowest free cells."""
        size = self.low + count
        while True:
            self._room(size)
            found = np.flatnonzero(self.check[self.low : size] == -1)[:count] + self.low
            if len(found) == count:
                return found
            size += 2 * (count - len(found)) + 16

    def add(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Cells of new children; pairs are distinct and sorted, and all children of a parent come in one call."""
        cells = np.empty(len(parents), np.int64)
        first = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        size = np.diff(np.append(first, len(parents)))
        for i, n in zip(first[size > 1], size[size > 1], strict=True):
            span = codes[i : i + n] - codes[i]
            for cell in self._free(TRIES):
                self._room(cell + span[-1] + 1)
                if (self.check[cell + span] == -1).all():
                    break
            else:
                cell = len(self.check)
                self._room(cell + span[-1] + 1)
            cells[i : i + n] = cell + span
            self.check[cell + span] = parents[i]
            while self.low < len(self.check) and self.check[self.low] != -1:
                self.low += 1
        alone = first[size == 1]
        if len(alone):
            cells[alone] = self._free(len(alone))
            self.check[cells[alone]] = parents[alone]
            self.low = int(cells[alone[-1]]) + 1
        self.base[parents] = cells - codes
        return cells

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children by these codes, -1 where there is none."""
        to = self.base[states] + codes
        inside = (states >= 0) & (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


def packed(roots: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> DoubleArray:
    """The trie of all sequences; ``roots`` numbers the root of each, ``codes`` holds them end to end."""
    trie = DoubleArray(int(roots.max()) + 1 if len(roots) else 0)
    width = int(codes.max()) + 1 if len(codes) else 1
    start = np.cumsum(sizes) - sizes
    at = roots.astype(np.int64)
    for level in range(int(sizes.max()) if len(sizes) else 0):
        live = np.flatnonzero(sizes > level)
        pairs, place = np.unique(at[live] * width + codes[start[live] + level], return_inverse=True)
        at[live] = trie.add(pairs // width, pairs % width)[place]
    return trie


def walked(trie: DoubleArray, roots: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The node of every position of every sequence."""
    nodes = np.empty(len(codes), np.int64)
    start = np.cumsum(sizes) - sizes
    at = roots.astype(np.int64)
    for level in range(int(sizes.max()) if len(sizes) else 0):
        live = np.flatnonzero(sizes > level)
        at[live] = nodes[start[live] + level] = trie.step(at[live], codes[start[live] + level])
    return nodes


def crc32_text(number: Column) -> Column:
    return F.crc32(number.cast("string").cast("binary"))


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, d1, d2, words): two hashes and the words of each turn, at its place in its conversation."""
    said = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text)]
    narrow = df.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(F.lit(1), *said).alias("d1"), F.xxhash64(F.lit(2), *said).alias("d2"),
        F.regexp_count(said[1], F.lit(WORD)).cast("bigint").alias("words"))
    return ordering.with_index(narrow, ["turn", "d1", "d2"], ["conv_id"], name="pos").drop("turn")


def pieces(said: DataFrame, head: Column, block: int = 20) -> DataFrame:
    """(conv_id, seg, turns) of rebuilt conversations: the first ``head`` turns of conversation ``c - c % block``, then the own turns after
    the first ``head``. Segment -1 holds the former, at most ``HEAD``, and exists for every conversation."""
    one = F.struct("pos", "d1", "d2", "words")
    heads = said.filter((F.col("conv_id") % block == 0) & (F.col("pos") < HEAD)).groupBy(F.col("conv_id").alias("origin")).agg(
        F.sort_array(F.collect_list(one)).alias("heads"))
    first = (
        said.filter("pos = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("origin"), head.cast("int").alias("take"))
        .join(heads, "origin", "left")
        .select("conv_id", F.lit(-1).cast("bigint").alias("seg"),
                F.coalesce(F.slice("heads", F.lit(1), F.col("take")), F.array().cast("array<struct<pos:bigint,d1:bigint,d2:bigint,words:bigint>>")).alias("turns")))
    rest = said.filter(F.col("pos") >= head).groupBy("conv_id", F.floor(F.col("pos") / PIECE).alias("seg")).agg(
        F.sort_array(F.collect_list(one)).alias("turns"))
    return first.unionByName(rest)


def placed(cut: DataFrame) -> DataFrame:
    """Pieces with their depth and prefix hash, the hashes of all their prefixes' last steps, and whether the conversation ends there."""
    series = Window.partitionBy("conv_id").orderBy("seg")
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))
    steps = lambda lane: F.transform("turns", lambda t, i: F.xxhash64(F.lit(lane), F.col("start") + i, t["d1"], t["d2"]))
    deep = cut.withColumn("start", F.coalesce(F.sum(F.size("turns")).over(before), F.lit(0)).cast("bigint")).withColumn(
        "total", F.sum(F.size("turns")).over(Window.partitionBy("conv_id")))
    hashed = deep.withColumn("a", steps(3)).withColumn("b", steps(4)).withColumn("xa", xor(F.col("a"))).withColumn("xb", xor(F.col("b")))
    return hashed.select(
        "conv_id", "seg", "start", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0).cast("bigint")).alias(to) for x, to in (("xa", "sa"), ("xb", "sb"))],
        "a", "b", F.col("turns.d1").alias("d1"), F.col("turns.d2").alias("d2"), F.col("turns.words").alias("words"),
        ((F.col("start") + F.size("turns") == F.col("total")) & ((F.size("turns") > 0) | (F.col("total") == 0))).alias("last"))


PARTS = ("a bigint, b bigint, depth bigint, pa bigint, pb bigint, words bigint, members bigint, conv_id bigint, ends bigint, "
         "walk_a array<bigint>, walk_b array<bigint>")


def shard_parts(batch: pa.Table) -> list[pa.RecordBatch]:
    """Nodes of one shard with its members, and the prefix hashes along each piece."""
    flat = lambda c: np.concatenate([np.asarray(x.flatten()) for x in batch.column(c).chunks]).astype(np.int64)
    col = lambda c: batch.column(c).to_numpy().astype(np.int64)
    conv, head, last = col("conv_id"), col("seg") == -1, np.asarray(batch.column("last").to_pylist(), bool)
    start, sa, sb = col("start"), col("sa"), col("sb")
    sizes = np.concatenate([np.diff(x.offsets.to_numpy()) for x in batch.column("a").chunks]).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.cumsum(sizes) - sizes
    words = flat("words")

    digests = np.stack([flat("d1"), flat("d2")], 1)
    codes = np.unique(np.ascontiguousarray(digests).view("V16").ravel(), return_inverse=True)[1].ravel() if len(digests) else np.empty(0, np.int64)
    roots = np.unique(np.ascontiguousarray(np.stack([sa, sb, start], 1)).view("V24").ravel(), return_inverse=True)[1].ravel()
    trie = packed(roots, codes, sizes)
    nodes = walked(trie, roots, codes, sizes)

    def prefixes(step: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.append(0, np.bitwise_xor.accumulate(step)) if len(step) else np.zeros(1, np.int64)
        reset = (run[offset] ^ begin)[owner]
        return run[1:] ^ reset, run[:-1] ^ reset

    (pa_, before_a), (pb_, before_b) = prefixes(flat("a"), sa), prefixes(flat("b"), sb)
    at, one, place = np.unique(nodes, return_index=True, return_inverse=True)
    members = np.bincount(place.ravel(), minlength=len(at))
    lowest = np.full(len(at), np.iinfo(np.int64).max)
    np.minimum.at(lowest, place.ravel(), conv[owner])
    ends = np.zeros(len(at), np.int64)
    closing = np.flatnonzero(last & (sizes > 0))
    np.add.at(ends, place.ravel()[offset[closing] + sizes[closing] - 1], 1)
    depth = start[owner] + np.arange(len(owner)) - offset[owner] + 1
    columns = [pa_[one], pb_[one], depth[one], before_a[one], before_b[one], words[one], members, lowest, ends]
    if head.any():
        top = [0, 0, 0, 0, 0, 0, int(head.sum()), int(conv[head].min()), int((last & head & (sizes == 0)).sum())]
        columns = [np.append(c, t) for c, t in zip(columns, top, strict=True)]
    names = [c.split()[0] for c in PARTS.split(", ")]
    n = len(columns[0])
    lists = pa.list_(pa.int64())
    rows = [pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(n, lists), pa.nulls(n, lists)], names)]

    # along a piece: the root, where it starts there, and every prefix
    ends_at = np.cumsum(sizes + head)
    def along(values: np.ndarray) -> pa.Array:
        out = np.zeros(len(values) + int(head.sum()), np.int64)
        out[np.arange(len(values)) + np.cumsum(head)[owner]] = values
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends_at), pa.int32()), pa.array(out))

    none = [pa.nulls(len(sizes), pa.int64()) for _ in range(7)]
    rows.append(pa.RecordBatch.from_arrays([*none, pa.array(conv), none[0], along(pa_), along(pb_)], names))
    return rows


def shard_nodes(cut: DataFrame) -> DataFrame:
    """Rows of ``PARTS``: partial nodes of every shard, then (conv_id, walk_a, walk_b) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns_held = [], 0
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                held.append(part)
                turns_held += len(part.column(part.schema.get_field_index("words")).flatten()) + part.num_rows
                if turns_held >= SHARD:
                    yield from shard_parts(pa.Table.from_batches(held))
                    held, turns_held = [], 0
        if held:
            yield from shard_parts(pa.Table.from_batches(held))

    keys = ["sa", "sb", F.slice("d1", 1, 8), "conv_id", "seg"]
    return cut.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, PARTS)


def ends_digests(ends: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ends_sha256): SHA-256 of the ascending, comma-joined ids per key."""
    blocks = ends.groupBy(*keys, F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            columns = [batch.column(i).to_pylist() for i in range(len(keys))]
            ids = batch.column(len(keys) + 1)
            for i, key in enumerate(zip(*columns, strict=True)):
                if key == now:
                    state.update(b",")
                else:
                    if state:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                state.update(ids[i].as_py().encode())
            yield out(done)
        yield out([(*now, state.hexdigest())] if state else [])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * len(keys) + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [*keys, "ends_sha256"])

    ordered = blocks.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "block")
    return ordered.mapInArrow(run, ", ".join(f"{k} bigint" for k in keys) + ", ends_sha256 string")


def trie_nodes(cut: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    whole = written(placed(cut), "pieces")
    parts = written(shard_nodes(whole), "shards")
    nodes = parts.filter("members IS NOT NULL").groupBy("a", "b", "depth").agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("words").alias("words"), F.sum("members").alias("n_convs"),
        F.min("conv_id").alias("owner"), F.sum("ends").alias("ends"))
    nodes = nodes.withColumn("leaf", (F.col("ends") == F.col("n_convs")).cast("bigint")).withColumn("own", (F.col("n_convs") - 1) * F.col("words"))
    nodes = written(ordering.with_running_total(nodes, "depth", ["owner"], weight=F.col("own"), name="above", total="owned"), "nodes")

    totals = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.max("owned").alias("owned"), F.max("leaf").alias("leaf")).filter(
        "owned > 0 OR leaf > 0")
    steps = parts.filter("members IS NULL").select("conv_id", F.explode(F.arrays_zip("walk_a", "walk_b")).alias("s"))
    below = steps.join(totals, "conv_id").groupBy(F.col("s.walk_a").alias("a"), F.col("s.walk_b").alias("b")).agg(
        F.sum("owned").alias("sum_owned"), F.sum("leaf").alias("sum_leaf"))
    children = nodes.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("children"))
    ends = whole.filter("last").select(
        "conv_id", *[F.aggregate(x, F.col(s), lambda p, q: p.bitwiseXOR(q)).alias(x) for x, s in (("a", "sa"), ("b", "sb"))])
    facts = {"depth": "bigint", "pa": "bigint", "pb": "bigint", "owner": "bigint", "n_convs": "bigint", "above": "bigint",
             "sum_owned": "bigint", "sum_leaf": "bigint", "children": "bigint", "ends_sha256": "string"}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select("a", "b", *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in facts.items()])

    rows = shaped(nodes)
    for more in (below, children, ends_digests(ends, ["a", "b"])):
        rows = rows.unionByName(shaped(more))
    merged = rows.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in facts])
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_conv_id"))
    return merged.join(parents, ["pa", "pb", "depth"], "left").select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("children", F.lit(0).cast("bigint")).alias("n_children"),
        F.col("sum_leaf").alias("n_leaves"), (F.col("sum_owned") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(df: DataFrame, head: Column | None = None, block: int = 20) -> DataFrame:
    """The nodes of all rebuilt conversations; ``head`` defaults to the CRC-32 of the decimal id, modulo 4."""
    said = written(turns(df), "turns")
    return trie_nodes(pieces(said, crc32_text(F.col("conv_id")) % 4 if head is None else head, block))
