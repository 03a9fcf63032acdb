"""Near-duplicate groups by SetSketch registers over word shingles.

1. Every text becomes its set of word shingles (64-bit hashes) and a SetSketch: for each register the
   minimum of an exponential variable over the set, on an exponentially spaced scale and truncated to
   0 .. q + 1. Registers of a union are the maxima of the registers, so sketches of parts can be merged.
2. Texts with equal sets are one class; its smallest id stands for it.
3. Bands of registers are bucket keys. Two sets at the wanted similarity share no bucket with a
   probability below ``(1 - 0.8 ** rows) ** bands``: 1.2e-5 at the threshold itself with the defaults, 1e-8 at 0.85.
4. Inside a bucket, each class is compared with one centre only, the member whose buckets are fullest. Classes that remain in different
   components are compared by centre: the Jaccard distance is a metric, so two stars can hold a link only
   if the distance of their centres is at most the wanted distance plus both radii. Such centres share one of their rarest
   shingles, early enough for what follows to suffice; they are joined on it, and texts that share a frequent template and no more never meet. Only stars that are near enough are
   opened, and their members compared in blocks (a matrix product for some hundred members at once).
5. A pair's similarity is first estimated jointly from both sketches by maximum likelihood; pairs far
   below the threshold are dropped, the rest is verified on the full sets.

Null texts and texts without words have the empty set: they link with nothing, are their own component
and are kept. Equal texts always meet in one class. Rows with the same id and words share a component, also where their texts differ. Rows with a
null id get a null component and are kept. Other columns of the input are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignlake.llm.components import components
from alignlake.session import written

BASE, RATE, TOP = 1.001, 20.0, 65534  # spacing b, rate a and truncation q of the registers
BANDS, ROWS = 48, 7
WORD_CACHE = 250_000
BLOCK = 1 << 17
PIECE = 2000  # rows in work at once
BLOCK_SHINGLES, COLUMNS = 20_000, 8192
RARITY = 1 << 18  # places of the table of shingle counts
SMALL = 16  # members up to which a star is opened at once
MARGIN = 0.15  # more than six standard deviations of an estimate from 336 registers at similarity 0.8


class _Words(dict):
    """Hash of a word, kept between texts; emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, words: dict, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole sequence where it is shorter."""
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    width = min(size, len(tokens))
    rolled = np.full(len(tokens) - width + 1, width, np.uint64)
    for k in range(width):
        rolled = _mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - width + 1 + k])
    return np.unique(rolled)


def registers(flat: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SetSketch registers (sets x count) of non-empty sets laid end to end."""
    seeds = np.random.default_rng(8).integers(1, 2**32, (2, count), dtype=np.uint32) | np.uint32(1)
    low = np.empty((len(starts), count), np.uint32)
    ends = np.append(starts[1:], len(flat))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BLOCK, "right")))
        x = (flat[starts[first] : ends[last - 1]] >> np.uint64(32)).astype(np.uint32)
        at = starts[first:last] - starts[first]
        h, t = np.empty_like(x), np.empty_like(x)
        for i in range(count):
            np.multiply(x, seeds[0, i], out=h)
            np.right_shift(h, np.uint32(15), out=t)
            np.bitwise_xor(h, t, out=h)
            np.multiply(h, seeds[1, i], out=h)
            np.right_shift(h, np.uint32(16), out=t)
            np.bitwise_xor(h, t, out=h)
            low[first:last, i] = np.minimum.reduceat(h, at)
        first = last
    exponential = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def band_keys(regs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(regs), bands), np.uint64)
    for j in range(bands):
        value = np.full(len(regs), j + 1, np.uint64)
        for k in range(j * rows, (j + 1) * rows):
            value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + regs[:, k])
        keys[:, j] = value
    return keys


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of sets, given their registers and sizes."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 201)[None, :] * most[:, None]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u[:, None] - v[:, None] * grid), p(v[:, None] - u[:, None] * grid)
    log = lambda x: np.log(np.maximum(x, 1e-300))
    score = above[:, None] * log(up) + below[:, None] * log(down) + same[:, None] * log(1 - up - down)
    return grid[np.arange(len(grid)), score.argmax(1)]


def sketches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5,
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, n_shingles, digest, registers, bands) of every row; the last two are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = _Words()
        for batch in (b.slice(i, PIECE) for b in batches for i in range(0, b.num_rows, PIECE)):
            sets = [shingle_set(t, words, shingle) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            regs, keys = [None] * len(sets), [None] * len(sets)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                made = registers(flat, np.append(0, np.cumsum(sizes[full])[:-1]), bands * rows)
                for i, r, k in zip(full, made, band_keys(made, bands, rows).view(np.int64), strict=True):
                    regs[i], keys[i] = r.tobytes(), k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array(regs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["node", "n_shingles", "digest", "registers", "bands"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(f"`{id_column}`").alias("node"), F.col(f"`{text_column}`").cast("binary").alias("text")).mapInArrow(
        run, f"node {kind}, n_shingles bigint, digest binary, registers binary, bands array<bigint>")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of a column of texts: the set, and its digest as its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = _Words()
        for batch in (b.slice(i, PIECE) for b in batches for i in range(0, b.num_rows, PIECE)):
            sets = [shingle_set(t, words, shingle) for t in batch.column(0).to_pylist()]
            names = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([names, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.select(F.col("text").cast("binary")).mapInArrow(run, "node binary, shingles array<bigint>")


def prefixes(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows of ``stars`` once per shingle that may be the first one that its centre shares with a set at least as similar as asked.

    Shingles are put in an order of rarity (by counts in a table of ``RARITY`` places, then by hash): two sets with a similarity of f
    share one among the first ``n - ceil(f * n) + 1`` of each. ``reach`` is the highest f for which a shingle is among these.
    What many sets have in common stands last, so sets that share no more than that never meet.
    """
    held = written(stars.join(sets, F.col("star") == F.col("node")).drop("node"), "star-sets")
    counts = held.select(F.explode("shingles").alias("s")).groupBy(F.col("s").bitwiseAND(F.lit(RARITY - 1)).alias("at")).agg(F.count("*").alias("n"))
    rarity = np.zeros(RARITY, np.int64)
    known = counts.toArrow()  # at most RARITY rows
    rarity[known.column("at").to_numpy()] = known.column("n").to_numpy()
    widest = float(held.agg(F.max("radius")).first()[0] or 0)
    names = [c for c in held.columns if c != "shingles"]
    radius = names.index("radius")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            rows, found, reach, sizes = [], [], [], []
            column, radii = batch.column(len(names)), batch.column(radius).to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                values = column[i].values.to_numpy(zero_copy_only=False)
                n = len(values)
                least = percent / 100 - radii[i] - widest - 1e-9
                size = min(n, n - int(np.ceil(max(least, 0) * n)) + 1)
                order = np.lexsort((values, rarity[values & (RARITY - 1)]))[:size]
                rows.append(np.full(size, i))
                found.append(values[order])
                reach.append((n - np.arange(size)) / n)
                sizes.append(np.full(size, n))
            if rows:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(take) for k in range(len(names))], pa.array(np.concatenate(found)), pa.array(np.concatenate(reach)),
                     pa.array(np.concatenate(sizes))],
                    [*names, "shingle", "reach", "held"])

    kinds = ", ".join(f"{c} {held.schema[c].dataType.simpleString()}" for c in names)
    return held.select(*names, "shingles").mapInArrow(run, f"{kinds}, shingle bigint, reach double, held bigint")


def estimated(pairs: DataFrame, nodes: DataFrame, floor) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is at least ``floor`` (a column) less the margin."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("registers").alias(f"r_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    both = pairs.withColumn("floor", floor).join(side("a"), "a").join(side("b"), "b")
    kept = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            regs = [np.frombuffer(b"".join(get(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("r_a", "r_b")]
            likely = np.concatenate([
                estimates(regs[0][i : i + 1024], regs[1][i : i + 1024],
                          get("n_a").to_numpy(zero_copy_only=False)[i : i + 1024].astype(float),
                          get("n_b").to_numpy(zero_copy_only=False)[i : i + 1024].astype(float))
                for i in range(0, batch.num_rows, 1024)])
            yield batch.select(kept).filter(pa.array(likely >= get("floor").to_numpy(zero_copy_only=False) - MARGIN))

    return both.mapInArrow(run, pairs.schema)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) with the sizes of intersection and union of their full sets."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("common", F.size(F.array_intersect("s_a", "s_b")))
    return both.select(*pairs.columns, "common", (F.size("s_a") + F.size("s_b") - F.col("common")).alias("total"))


def packed(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(host, members): the rows of a host in blocks of about ``BLOCK_SHINGLES`` shingles."""
    blocks = rows.groupBy("host").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))
    return (
        rows.select("host", "node", "away", "component", "similar").join(written(blocks, "blocks"), "host").join(sets, "node")
        .groupBy("host", F.pmod(F.xxhash64("node"), "blocks").alias("block"))
        .agg(F.collect_list(F.struct("node", "away", "component", "similar", "shingles")).alias("members"))
        .select("host", "members"))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two blocks of sets, by products of membership matrices."""
    ids, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    counts = np.zeros((len(left), len(right)))
    for low in range(0, len(ids), COLUMNS):
        part = (place >= low) & (place < low + COLUMNS)
        held = np.zeros((len(left) + len(right), min(COLUMNS, len(ids) - low)), np.float32)
        held[owner[part], place[part] - low] = 1
        counts += held[: len(left)] @ held[len(left) :].T
    return counts.astype(np.int64)


def block_links(hosts: DataFrame, guests: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the members of each host's blocks and the members of its guests' blocks."""
    both = hosts.select("host", F.col("members").alias("left")).join(guests.select("host", F.col("members").alias("right")), "host").drop("host")
    kind = hosts.schema["members"].dataType.elementType["node"].dataType.simpleString()

    def unpacked(column: pa.ListArray, row: int) -> tuple[pa.StructArray, list[np.ndarray]]:
        rows = column[row].values
        shingles = rows.field("shingles")
        ends = shingles.offsets.to_numpy()
        values = shingles.values.to_numpy(zero_copy_only=False)
        return rows, [values[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                (x, xs), (y, ys) = unpacked(batch.column(0), row), unpacked(batch.column(1), row)
                common = common_counts(xs, ys)
                total = np.array([len(s) for s in xs])[:, None] + np.array([len(s) for s in ys])[None, :] - common
                apart = np.array(x.field("component").to_pylist(), object)[:, None] != np.array(y.field("component").to_pylist(), object)[None, :]
                i, j = np.nonzero((100 * common >= percent * total) & apart)
                yield pa.RecordBatch.from_arrays([x.field("node").take(pa.array(i)), y.field("node").take(pa.array(j))], ["a", "b"])

    return both.mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: the component is the smallest id linked with it,
    directly or through others; links are pairs with ``100 * intersection >= percent * union``."""
    linked = F.col("common") * 100 >= F.col("total") * percent
    fits = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    wanted = percent / 100

    sketched = written(sketches(docs, id_column, text_column, shingle, bands, rows), "sketches")
    classes = written(sketched.filter("n_shingles > 0").groupBy("digest").agg(F.min("node").alias("first")), "classes")
    nodes = written(
        sketched.filter("n_shingles > 0").select(F.col("node").alias("id"), F.col("digest").alias("node"), "n_shingles", "registers", "bands")
        .join(classes.select(F.col("first").alias("id")).distinct(), "id", "left_semi").drop("id").dropDuplicates(["node"]), "nodes")

    rows_of = nodes.select("node", "n_shingles", F.explode("bands").alias("key"))
    # what was aggregated by a key is stored before it is joined on that key, so that a frequent key's rows can be split
    sizes = written(rows_of.select("key").groupBy("key").agg(F.count("*").alias("members")).filter("members > 1"), "sizes")
    met = written(rows_of.join(sizes, "key"), "met")
    # the centre of a bucket is its member with the fullest buckets: the one nearest to what its group has in common
    weight = met.groupBy("node").agg(F.sum("members").alias("weight"))
    met = met.join(weight, "node").select("key", "node", "n_shingles", "weight")
    centres = met.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("order"), "node", "n_shingles")).alias("centre"))
    shared = written(met.join(written(centres, "bucket-centres"), "key").drop("weight"), "shared")
    candidates = shared.select(F.col("node").alias("digest")).distinct().join(classes, "digest").select(F.col("first").alias("id")).distinct()
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    sets = written(shingle_sets(texts.join(candidates.hint("shuffle_hash"), "id", "left_semi"), shingle)
                   .dropDuplicates(["node"]), "sets")

    # each class with the centre that it shares most buckets with
    stars = (
        shared.filter((F.col("node") != F.col("centre.node")) & fits(F.col("n_shingles"), F.col("centre.n_shingles")))
        .groupBy(F.col("node").alias("a"), F.col("centre.node").alias("b")).agg(F.count("*").alias("n"))
        .groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b")))
    first = written(verified(estimated(stars, nodes, F.lit(wanted)), sets).filter(linked), "links")
    labels = components(first)

    # what shares a bucket but not yet a component
    star_of = first.select(F.col("a").alias("node"), F.col("b").alias("star"), (1 - F.col("common") / F.col("total")).alias("away"))
    starred = written(
        nodes.select("node", "n_shingles").join(labels, "node", "left").join(star_of, "node", "left").select(
            "node", "n_shingles", F.coalesce("component", "node").alias("component"), F.coalesce("star", "node").alias("star"),
            F.coalesce("away", F.lit(0.0)).alias("away")), "stars")
    # members of a small star stand for themselves, so that only large ones have a radius
    large = written(starred.groupBy("star").agg(F.count("*").alias("n")).filter(F.col("n") > SMALL).select("star"), "large")
    member = written(starred.join(large.withColumn("whole", F.lit(True)), "star", "left").select(
        "node", "n_shingles", "component", F.when(F.col("whole"), F.col("star")).otherwise(F.col("node")).alias("star"),
        F.when(F.col("whole"), F.col("away")).otherwise(0.0).alias("away")), "members")
    placed = shared.select("key", "node").join(member, "node")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    mixed = written(mixed, "mixed")
    star = written(placed.join(mixed, "key").groupBy("star").agg(F.min("component").alias("component")), "open-stars")
    reach = member.groupBy("star").agg(
        F.max("away").alias("radius"), F.min("n_shingles").alias("small"), F.max("n_shingles").alias("large"), F.count("*").alias("size"))
    met_at = prefixes(star.join(reach, "star"), sets, percent)
    often = written(met_at.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").select("shingle"), "shingles")
    met_at = written(met_at.join(often, "shingle"), "prefixes")
    facts = [c for c in met_at.columns if c not in ("shingle", "star")]
    floor = F.lit(wanted) - F.col("radius") - F.col("radius_2")

    def meetings(left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs of centres that share a shingle and may be near enough, each once."""
        right = right.select("shingle", *[F.col(c).alias(f"{c}_2") for c in ("star", *facts)])
        pairs = left.join(right, "shingle").filter(
            (F.col("star") != F.col("star_2")) & (F.col("component") != F.col("component_2"))
            & (F.col("large") * 100 >= F.col("small_2") * percent) & (F.col("large_2") * 100 >= F.col("small") * percent)
            & (F.col("reach") >= floor - 1e-9) & (F.col("reach_2") >= floor - 1e-9)
            # at the first shingle that two sets share, what is left of each still has to hold all that they share
            & (F.least(F.col("reach") * F.col("held"), F.col("reach_2") * F.col("held_2")) * (1 + floor) >= floor * (F.col("held") + F.col("held_2")) - 1e-6))
        ahead = F.col("star") < F.col("star_2")
        side = lambda c, d: F.when(ahead, F.col(c)).otherwise(F.col(d))
        return pairs.select(side("star", "star_2").alias("a"), side("star_2", "star").alias("b"), *[
            c for name in ("radius", "size") for c in (side(name, f"{name}_2").alias(name), side(f"{name}_2", name).alias(f"{name}_2"))])

    narrow = met_at.filter(F.col("reach") >= wanted - 1e-9)
    close = meetings(narrow, narrow).unionByName(meetings(met_at.filter("radius > 0"), met_at)).distinct()
    second = written(verified(estimated(close, nodes, floor), sets), "centres").withColumn("similar", F.col("common") / F.col("total"))
    links = first.select("a", "b").unionByName(second.filter(linked).select("a", "b"))

    # stars whose centres are apart, yet near enough that members may link
    apart = second.filter(~linked & (F.col("radius") + F.col("radius_2") > 0) & (F.col("similar") >= floor - 1e-9)).select(
        F.when(F.col("size") >= F.col("size_2"), F.col("a")).otherwise(F.col("b")).alias("host"),
        F.when(F.col("size") >= F.col("size_2"), F.col("b")).otherwise(F.col("a")).alias("guest"), "similar")
    hosts = apart.select("host").distinct().join(member, F.col("host") == F.col("star")).withColumn("similar", F.lit(0.0))
    guests = apart.join(member, F.col("guest") == F.col("star"))
    rest = block_links(packed(hosts, sets), packed(guests, sets), percent)

    # texts of one id belong together
    several = sketched.filter("n_shingles > 0 AND node IS NOT NULL").groupBy("node").agg(
        F.min("digest").alias("a"), F.max("digest").alias("z")).filter("a < z").select("node", "a")
    same_id = sketched.filter("n_shingles > 0").join(several, "node").select("a", F.col("digest").alias("b")).filter("a != b")
    labels = components(links.unionByName(rest).unionByName(same_id))

    named = classes.join(labels, F.col("digest") == F.col("node"), "left").select("digest", "first", F.coalesce("component", "digest").alias("component"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = written(named.join(written(lowest, "lowest"), "component").select("digest", "component_id"), "named")
    return (
        sketched.select("node", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest")).join(named, "digest", "left")
        .select(F.col("node").alias(id_column), "n_shingles",
                F.when(F.col("node").isNotNull(), F.coalesce("component_id", "node")).alias("component_id"))
        .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id"))))
