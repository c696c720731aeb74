"""Near-duplicate classes by HyperMinHash.

Each text's set of five-word shingles is hashed. The first eight bits of a hash choose one of 256 registers, and a
register keeps its least remaining hash in eight bits: the count of leading zeros and three bits of mantissa. What is
empty after that is filled from further hashes of the same shingles, so two texts agree in a register with the
probability of their similarity, however short they are. Six registers make a band key, and there are 80 bands; texts that
share a key are candidates. A pair at a similarity of 0.75 shares none with a probability of about one in a million.
Candidates whose collision-corrected estimate is far below the threshold go, the rest are confirmed on full sets.

Groups of copies may hold a third of all rows, so no bucket is expanded into pairs:

1. equal sets are one class, found by a hash of the set (an aggregate);
2. each bucket has a centre, the class that shares most buckets with others; each class meets the centre with which
   it shares most of its buckets, where that is confirmed;
3. in buckets that still hold several components, the classes outside the largest one are compared with all by their
   registers, in tiles of bounded size: at first each meets the one most like it, at last all that may be linked. Those of the last
   turn are confirmed within the tile: the texts of its classes come to parts of it, ``PART`` shingles at most (or one pair), and a part gives no
   more links than join its classes, so neither pairs nor links are written out for all of a group.

After step 3, two classes in one bucket are in one component or were found not linked.

Null ``doc_id``: the row comes back with no component and is kept. Null or empty text, or one without words: an
empty set, linked with nothing. Rows that repeat a ``doc_id`` count as one document with several texts. Other
columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import MIX_1, STEP, mixed, slices
from weftline.settings import written

WORDS = 5
PERCENT = 75
REGISTERS = 256
ZEROS, MANTISSA = 31, 3
BAND, BANDS = 6, 80
BLOCK = 256
"""Classes in a block; a tile holds two blocks of a bucket."""
NEAREST_ROUNDS = 2
SIGMAS = 5
PART = 2_000_000
"""Shingles of the classes of a tile that are confirmed together."""
SALTS = 16
"""Parts a group of equal sets is dealt to where its members are named."""
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(1, WORDS + 1)], np.uint64)


class _WordHashes(dict):
    """64-bit hashes of words, kept while they fit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


_hashes = _WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    if not n:
        return h
    if n < WORDS:
        return mixed(np.array([(h * _POWERS[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64))
    total = np.zeros(n - WORDS + 1, np.uint64)
    for i in range(WORDS):
        total += h[i : n - WORDS + 1 + i] * _POWERS[i]
    return np.unique(mixed(total))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers for each set, all 0 for an empty one: leading zeros and mantissa of the least hash."""
    out = np.zeros((len(sets), REGISTERS), np.uint8)
    full = np.uint64((1 << 64) - 1)
    for row, s in enumerate(sets):
        if not len(s):
            continue
        # The round in the top 16 bits, the hash in the others: what an earlier round fills, a later one leaves.
        least, turn = np.full(REGISTERS, full), 0
        while (least == full).any():
            turns = np.arange(turn, turn + max(1, 2048 // len(s)), dtype=np.uint64) if turn else np.zeros(1, np.uint64)
            h = mixed(s ^ mixed(turns * STEP)[:, None]) if turn else s[None, :]
            value = (turns[:, None] << np.uint64(48)) | (h & np.uint64((1 << 48) - 1))
            np.minimum.at(least, (h >> np.uint64(56)).astype(np.int64).ravel(), value.ravel())
            turn += len(turns)
        rest = (least & np.uint64((1 << 48) - 1)) | np.uint64(1)
        _, bits = np.frexp(rest.astype(np.float64))
        mantissa = ((rest << (64 - bits).astype(np.uint64)) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
        out[row] = (np.minimum(48 - bits, ZEROS).astype(np.uint64) << np.uint64(MANTISSA)) + mantissa
    return out


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Estimated similarity of register rows, less the registers expected to agree by chance."""
    zeros = np.arange(ZEROS + 1)

    def level(n: np.ndarray) -> np.ndarray:
        """Chance of each count of leading zeros, of the least of so many hashes."""
        x = np.maximum(n[..., None] / REGISTERS, 1)
        return np.exp(-x * 2.0 ** -(zeros + 1)) - np.exp(-x * 2.0**-zeros)

    chance = (level(n_a.astype(float)) * level(n_b.astype(float))).sum(-1) / (1 << MANTISSA)
    return np.maximum(0, ((a == b).mean(-1) - chance) / (1 - chance))


def passes(estimate: np.ndarray) -> np.ndarray:
    """False where the estimate lies further below the threshold than its error can explain."""
    p = PERCENT / 100
    return estimate >= p - SIGMAS * np.sqrt(p * (1 - p) / REGISTERS)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        sets = [shingles(t) for t in part.column("text").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        low = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
        high = np.array([mixed(s ^ STEP).sum(dtype=np.uint64) for s in sets], np.uint64)
        regs = registers(sets)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array([r.tobytes() for r in regs], pa.binary())],
            ["doc_id", "n_shingles", "set_hi", "set_lo", "regs"],
        )


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_sketch, "doc_id long, n_shingles long, set_hi long, set_lo long, regs binary")


def _as_registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), REGISTERS)


_CHOICE = np.array([np.random.default_rng(i).permutation(REGISTERS)[:BAND] for i in range(BANDS)])


def _band_keys(regs: np.ndarray) -> np.ndarray:
    """The key of each band (column) of each row: a hash of six registers of the band's own choice."""
    packed = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) << np.uint64(8 * BAND), (len(regs), BANDS)).copy()
    for i in range(BAND):
        packed |= regs[:, _CHOICE[:, i]].astype(np.uint64) << np.uint64(8 * i)
    return mixed(packed * MIX_1 + STEP)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            keys = _band_keys(_as_registers(part.column("regs")))
            ids = part.column("node").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, BANDS))], ["band", "node"])


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            estimate = estimates(*(_as_registers(batch.column(c)) for c in ("regs_a", "regs_b")), *(batch.column(c).to_numpy() for c in ("n_a", "n_b")))
            yield batch.select(["a", "b"]).filter(pa.array(passes(estimate)))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text_a"):
        good, last, set_a = [], None, None
        for i, (text_a, text_b) in enumerate(zip(part.column("text_a").to_pylist(), part.column("text_b").to_pylist(), strict=True)):
            if text_a != last:
                last, set_a = text_a, shingles(text_a)
            set_b = shingles(text_b)
            if _similar(set_a, set_b):
                good.append(i)
        yield part.select(["a", "b"]).take(pa.array(good, pa.int64()))


def _compared(tile: pa.Table, nearest: bool) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each class of a tile's left side, those of its right side in other components whose estimate passes, with
    their estimates: the nearest only, or else all whose first common band is this one, so that a pair comes once."""
    side = tile.column("side").to_numpy()
    regs = _as_registers(tile.column("regs").combine_chunks())
    n, label, node = (tile.column(c).to_numpy() for c in ("n", "label", "node"))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    out, keys, band = [], None, tile.column("band")[0].as_py()
    for i in left.tolist():
        other = right[label[right] != label[i]]
        if len(other):
            estimate = estimates(regs[i], regs[other], n[i : i + 1], n[other])
            hit = np.flatnonzero(passes(estimate))
            if nearest and len(hit):
                hit = hit[estimate[hit].argmax()][None]
            elif len(hit):
                keys = _band_keys(regs).view(np.int64) if keys is None else keys
                theirs = keys[other[hit]]
                first = (theirs == keys[i]).argmax(1)
                hit = hit[theirs[np.arange(len(hit)), first] == band]
            if len(hit):
                out.append((node[i], node[other[hit]], estimate[hit]))
    return out


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Table]]:
    """The tiles of a partition whose rows are sorted by tile (band, i, j), those that end in one batch together."""
    kept: pa.Table | None = None
    for batch in _with_end(batches):
        new = [] if batch is None else [pa.Table.from_batches([batch])]
        rows = pa.concat_tables([*([] if kept is None else [kept]), *new]) if new or kept is not None else None
        if rows is None or not rows.num_rows:
            continue
        keys = np.column_stack([rows.column(c).to_numpy() for c in ("band", "i", "j")])
        starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))
        last = len(starts) - 1 if batch is None else len(starts) - 2  # the last tile may go on in the next batch
        yield [rows.slice(starts[t], starts[t + 1] - starts[t]) for t in range(last)]
        kept = rows.slice(starts[last])


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class of the left sides, the nearest of each tile."""
    for tiles in _tiles(batches):
        found = [x for tile in tiles for x in _compared(tile, True)]
        if found:
            a, b, estimate = np.array([x[0] for x in found], np.int64), *(np.concatenate([x[k] for x in found]) for k in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(estimate)], ["a", "b", "estimate"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of each tile that may be linked, in parts of bounded size: a row for each class of a part, with those it is to be confirmed with."""
    names = ["band", "i", "j", "part", "node", "partners"]

    def rows(tile: pa.Table, part: int, asked: dict[int, list[int]], inside: set[int]) -> pa.RecordBatch:
        nodes = sorted(inside)
        where = [pa.array([tile.column(c)[0].as_py()] * len(nodes), pa.int64()) for c in ("band", "i", "j")]
        return pa.RecordBatch.from_arrays([*where, pa.array([part] * len(nodes), pa.int64()), pa.array(nodes, pa.int64()), pa.array([asked.get(x, []) for x in nodes], pa.list_(pa.int64()))], names)

    for tiles in _tiles(batches):
        for tile in tiles:
            size = dict(zip(tile.column("node").to_pylist(), tile.column("n").to_pylist(), strict=True))
            part, asked, inside, held = 0, {}, set(), 0
            done: set[tuple[int, int]] = set()
            for a, partners, _ in _compared(tile, False):
                for b in partners.tolist():
                    if (min(a, b), max(a, b)) in done:
                        continue  # both are on both sides of the tile
                    done.add((min(a, b), max(a, b)))
                    more = sum(size[x] for x in (a, b) if x not in inside)
                    if inside and held + more > PART:
                        yield rows(tile, part, asked, inside)
                        part, asked, inside, held = part + 1, {}, set(), 0
                        more = size[a] + size[b]
                    asked.setdefault(int(a), []).append(b)
                    inside |= {int(a), b}
                    held += more
            if inside:
                yield rows(tile, part, asked, inside)


def _confirm_part(rows: pa.Table) -> pa.Table:
    """Links that join the classes of a part as their confirmed pairs do; a pair that is joined already is not looked at again."""
    sets: dict[int, list[np.ndarray]] = {}
    asked: dict[int, list[int]] = {}
    for node, partners, text in zip(*(rows.column(c).to_pylist() for c in ("node", "partners", "text")), strict=True):
        sets.setdefault(node, []).append(shingles(text))
        asked[node] = partners
    root = {x: x for x in sets}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for a in sorted(asked):
        for b in asked[a]:
            if top(a) != top(b) and any(_similar(x, y) for x in sets[a] for y in sets[b]):
                root[top(a)] = top(b)
                links.append((a, b))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (node, label) after every edge's ends have got the same, least label. A label names a node."""
    ends = edges.join(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), "a").join(labels.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
    links = written(ends.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links")
    moved = None
    while not links.isEmpty():
        # Each root hooks onto its least neighbour; chains of hooks are then halved until they are flat.
        hooks = written(links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("to")), "hooks")
        while True:
            jump = hooks.join(hooks.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left")
            flat = written(jump.select("node", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("far")), "hooks")
            hooks = flat.select("node", "to")
            if flat.where("far").isEmpty():
                break
        at = lambda c: hooks.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        if moved is None:
            moved = hooks
        else:
            moved = moved.join(at("to"), "to", "left").select("node", F.coalesce("to_to", "to").alias("to")).unionByName(hooks)
        moved = written(moved, "moved")
        ends = links.join(at("u"), "u", "left").join(at("v"), "v", "left")
        ends = ends.select(F.coalesce("u_to", "u").alias("u"), F.coalesce("v_to", "v").alias("v")).where("u <> v")
        links = written(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    if moved is None:
        return labels
    joined = labels.join(moved.select(F.col("node").alias("label"), "to"), "label", "left")
    return written(joined.select("node", F.coalesce("to", "label").alias("label")), "labels")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of ``docs``: doc_id, n_shingles, component_id (the least doc_id reachable) and kept."""
    sketch = written(sketches(docs, doc_id, text), "sketches")
    # Only sets with several rows need a name, and a set's rows meet it in several tasks.
    filled = sketch.where("n_shingles > 0").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    equal = filled.groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).where("rows > 1 and least is not null")
    equal = equal.select("set_hi", "set_lo", "least", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    named = filled.join(equal, ["set_hi", "set_lo", "salt"], "left").withColumn("node", F.coalesce("least", "doc_id"))
    empty = sketch.where("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("node"))
    member = written(named.select("doc_id", "n_shingles", "node").unionByName(empty), "members")
    class_rows = named.where("doc_id = node").select("node", F.col("n_shingles").alias("n"), "set_hi", "set_lo", "regs").dropDuplicates(["node", "set_hi", "set_lo"])
    nodes = written(class_rows.select("node", "n", "regs"), "nodes")
    labels = nodes.select("node", F.col("node").alias("label")).distinct()

    bands = nodes.mapInArrow(_bands, "band long, node long")
    buckets = bands.groupBy("band").agg(F.count("*").alias("size"), F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("band", "size")
    bucket_rows = written(bands.join(buckets, "band").distinct(), "buckets")
    degree = bucket_rows.groupBy("node").agg(F.sum("size").alias("degree"))
    centers = bucket_rows.select("band", "node").join(degree, "node").groupBy("band").agg(F.max_by("node", F.struct("degree", "node")).alias("center"))
    involved = bucket_rows.select("node").distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    texts = written(texts.join(involved, "node", "left_semi"), "texts")

    def estimated(pairs: DataFrame) -> DataFrame:
        side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(_estimate, "a long, b long")

    def confirmed(pairs: DataFrame) -> DataFrame:
        side = lambda x: texts.select(F.col("node").alias(x), F.coalesce("text", F.lit("")).alias(f"text_{x}"))
        found = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
        return written(found.mapInArrow(_confirm, "a long, b long").distinct(), "confirmed")

    def star(rows: DataFrame) -> DataFrame:
        """The link of each class with the centre it shares most buckets with, where that is confirmed."""
        pairs = rows.where("node <> center").groupBy(F.col("node").alias("b"), F.col("center").alias("a")).count()
        return confirmed(estimated(pairs.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a"))))

    # Texts of one doc_id are one document, so their classes are one component.
    several = member.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most")
    twice = member.join(several, "doc_id").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    labels = components(star(bucket_rows.join(centers, "band")).unionByName(twice), labels)

    for turn in range(NEAREST_ROUNDS + 1):
        rows = bucket_rows.join(labels, "node")
        sizes = rows.groupBy("band", "label").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("band").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most")).where("most < all")
        blocks = lambda c: F.ceil(c / BLOCK)
        rows = written(rows.join(largest.select("band", "main", blocks(F.col("all") - F.col("most")).alias("down"), blocks(F.col("all")).alias("across")), "band"), "open")
        if rows.isEmpty():
            break
        own = lambda k: F.pmod(F.xxhash64("node"), F.col(k))
        every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.col(k) - 1))
        left = rows.where("label <> main").withColumn("side", F.lit(0)).withColumn("i", own("down")).withColumn("j", every("across"))
        right = rows.withColumn("side", F.lit(1)).withColumn("j", own("across")).withColumn("i", every("down"))
        tiles = left.unionByName(right).join(nodes, "node").select("band", "i", "j", "side", "node", "n", "label", "regs")
        tiles = tiles.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        if turn < NEAREST_ROUNDS:
            pairs = tiles.mapInArrow(_nearest, "a long, b long, estimate double").groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))
            links = confirmed(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        else:
            parts = tiles.mapInArrow(_parts, "band long, i long, j long, part long, node long, partners array<long>")
            parts = parts.join(texts.select("node", F.coalesce("text", F.lit("")).alias("text")), "node")
            links = written(parts.groupBy("band", "i", "j", "part").applyInArrow(_confirm_part, "a long, b long"), "confirmed")
        labels = components(links, labels)

    out = member.join(labels, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("label"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
