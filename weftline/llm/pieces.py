"""SentencePiece segmentations: distinct samples without replacement, by Gumbel-perturbed best-first search.

The lattice of a text is that of the model's pieces. No piece of a model crosses a space or a line end, so the lattice is
a chain of small ones, one a chunk. A piece's probability follows its rank in the model by Zipf's law with exponent
``ALPHA`` (the scores of a BPE model are ranks, not probabilities); a character that is no piece is spelled in bytes.

A segmentation with Gumbel noise added to its log probability is among the k largest with the probability of a sample
without replacement. The search keeps sets of segmentations, each with the largest perturbed value of its members,
which bounds them. The set with the largest value is taken, the member that has it is drawn by a forward-filtering
backward pass through the lattice, and what is left of the set is split by the chunk in which a member first departs
from the drawn one; the parts get Gumbel values below the drawn one's. So the values come out in falling order, and the
next one after the last sample is the threshold of the inclusion scores: 1 - exp(-exp(log_prob - threshold)).

Noise is a function of the row's key, so results do not depend on partitions. Decoding gives the text back exactly.
A null or empty text has one segmentation, the empty one. A text with fewer than k segmentations gives all of
them, with inclusion score 1. Segmentations whose share of a chunk is below double precision are not reached. Rows with one
key have the same noise; a null key is a key like others. Very long texts, spaceless ones too, are one lattice each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import MIX_1, MIX_2, STEP, lists, mixed, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SAMPLES = 2
SCHEMA = "sample int, ids array<int>, n_pieces int, log_prob double, perturbed double, inclusion double"
_UNUSED = -1e8
_BASE = np.uint64(0x100000001B3)
_SHORT = 24
_PER_CHARACTER = 1e10
"""Short chunks are built together; the factor keeps their masses between 1e-300 and 1e200."""


class Pieces:
    """The model's pieces with their probabilities. Bounded by the size of the model file."""

    def __init__(self, model: bytes, alpha: float = ALPHA):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        self.bytes_of = [b""] * len(ids)
        self.byte_id = [0] * 256
        usable = []
        for i in ids:
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_id[value], self.bytes_of[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.bytes_of[i] = piece.replace("▁", " ").encode()
                if sp.get_score(i) > _UNUSED:
                    usable.append((-sp.get_score(i), i, piece.replace("▁", " ")))
        usable.sort()
        weights = np.arange(2, len(usable) + 2, dtype=float) ** -alpha
        least = weights[-1] if len(weights) else 1.0
        total = weights.sum() + 256 * least
        self.byte_p = float(least / total)
        # A piece with an inner space or a line end would cross chunks; it is left out.
        self.known = {piece: (i, float(w / total)) for (_, i, piece), w in zip(usable, weights, strict=True) if " " not in piece[1:] and "\n" not in piece}
        self.longest = max(map(len, self.known), default=1)
        self.prefixes = {p[:n] for p in self.known for n in range(1, len(p) + 1)}
        # A table from hashes of pieces, with a chain where two fall on one slot; row 0 is no piece.
        self.hash = np.array([0, *(int(_prefix_hashes(np.array([[ord(c) for c in p]], np.uint64))[0, -1]) for p in self.known)], np.uint64)
        self.id = np.array([-1, *(i for i, _ in self.known.values())], np.int32)
        self.p = np.array([0.0, *(q for _, q in self.known.values())])
        self.slot, self.next = np.zeros(1 << 20, np.int32), np.zeros(len(self.hash), np.int32)
        for row, at in enumerate(_slots(self.hash).tolist()):
            if row:
                self.next[row], self.slot[at] = self.slot[at], row

    def find(self, h: np.ndarray) -> np.ndarray:
        """Rows of the pieces with these hashes, 0 where there is none."""
        row = self.slot[_slots(h)]
        out = np.where(self.hash[row] == h, row, 0)
        far = np.flatnonzero((out == 0) & (self.next[row] > 0))
        while len(far):
            row[far] = self.next[row[far]]
            out[far] = np.where(self.hash[row[far]] == h[far], row[far], 0)
            far = far[(out[far] == 0) & (self.next[row[far]] > 0)]
        return out

    def decoded(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")

    def spelled(self, entry: int) -> list[int]:
        """Ids of a lattice entry; a negative one is a character spelled in bytes."""
        return [entry] if entry >= 0 else [self.byte_id[b] for b in chr(-1 - entry).encode("utf-8", "surrogatepass")]


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of the prefixes of each row of characters, that of the empty one first."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + codes[:, i] + np.uint64(1)
    return out


def _slots(h: np.ndarray) -> np.ndarray:
    return ((h * STEP) >> np.uint64(44)).astype(np.int64)


class Lattices:
    """Lattices of distinct chunks, flat. A place of a chunk has a slot for each length of piece that may end there;
    it holds the piece and its share when the chunk's segmentations are drawn from its end."""

    def __init__(self, pieces: Pieces, chunks: pa.StringArray):
        self.pieces = pieces
        self.length = pc.utf8_length(chunks).to_numpy().astype(np.int64)
        most = int(self.length.max()) if len(self.length) else 0
        self.off = np.concatenate(([0, 0], np.cumsum(np.minimum(np.arange(1, most + 1), pieces.longest))))  # by place, from 1
        sizes = self.off[self.length + 1]
        self.base = np.cumsum(sizes) - sizes
        self.share, self.entry = np.zeros(int(sizes.sum())), np.full(int(sizes.sum()), -1, np.int32)
        self.paths = np.ones(len(chunks))
        characters = np.frombuffer("".join(chunks.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts = np.cumsum(self.length) - self.length
        for n in np.unique(self.length).tolist():
            rows = np.flatnonzero(self.length == n)
            if n <= _SHORT:
                self._build(rows, characters[starts[rows, None] + np.arange(n)])
            else:
                for row in rows.tolist():
                    self._build_long(row, chunks[row].as_py())

    def _spelled(self, character: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and probability of characters that are no piece."""
        size = 1 + (character > 0x7F).astype(np.int64) + (character > 0x7FF) + (character > 0xFFFF)
        single = np.array(self.pieces.byte_id, np.int32)[np.minimum(character, 0x7F).astype(np.int64)]
        return np.where(size == 1, single, -1 - character.astype(np.int32)), self.pieces.byte_p**size

    def _build(self, rows: np.ndarray, codes: np.ndarray) -> None:
        """Lattices of chunks of one length. All masses carry a factor for each character, which keeps them from vanishing."""
        n = codes.shape[1]
        h = _prefix_hashes(codes)
        forward, paths = np.zeros((n + 1, len(rows))), np.zeros((n + 1, len(rows)))
        forward[0] = paths[0] = 1
        share, entry = np.zeros((self.off[n + 1], len(rows))), np.full((self.off[n + 1], len(rows)), -1, np.int32)
        power = _BASE ** np.arange(self.pieces.longest + 1, dtype=np.uint64)
        for end in range(1, n + 1):
            at = self.off[end]
            for size in range(1, min(end, self.pieces.longest) + 1):
                found = self.pieces.find(h[:, end] - h[:, end - size] * power[size])
                p, e = self.pieces.p[found], self.pieces.id[found]
                if size == 1 and not found.all():
                    bare = np.flatnonzero(found == 0)
                    e[bare], p[bare] = self._spelled(codes[bare, end - 1])
                share[at + size - 1] = forward[end - size] * p * _PER_CHARACTER**size
                entry[at + size - 1] = e
                paths[end] += paths[end - size] * (p > 0)
            forward[end] = share[at : self.off[end + 1]].sum(0)
            share[at : self.off[end + 1]] /= forward[end]
        place = self.base[rows][:, None] + np.arange(self.off[n + 1])
        self.share[place], self.entry[place], self.paths[rows] = share.T, entry.T, paths[n]

    def _build_long(self, row: int, chunk: str) -> None:
        known, prefixes, longest = self.pieces.known, self.pieces.prefixes, self.pieces.longest
        base, n = int(self.base[row]), len(chunk)
        p = np.zeros(len(self.share[base : base + self.off[n + 1]]))
        for i in range(n):
            for j in range(i + 1, min(n, i + longest) + 1):
                part = chunk[i:j]
                if part not in prefixes:
                    break
                if found := known.get(part):
                    at = int(self.off[j]) + j - i - 1
                    self.entry[base + at], p[at] = found
            at = int(self.off[i + 1])
            if not p[at]:
                e, q = self._spelled(np.array([ord(chunk[i])], np.uint64))
                self.entry[base + at], p[at] = e[0], q[0]
        # Masses relative to 2 ** scale of their place.
        forward, scale, paths = np.ones(n + 1), np.zeros(n + 1), np.ones(n + 1)
        for end in range(1, n + 1):
            at, size = int(self.off[end]), min(end, longest)
            before = slice(end - size, end)
            q = p[at : at + size][::-1]
            top = scale[before].max()
            mass = forward[before] * q * np.exp2(scale[before] - top)
            total = mass.sum()
            while not total:  # what can end here lies far below the best of the places before it
                top -= 500
                mass = forward[before] * q * np.exp2(np.minimum(scale[before] - top, 1000))
                total = mass.sum()
            self.share[base + at : base + at + size] = (mass / total)[::-1]
            paths[end] = min(float((paths[before] * (q > 0)).sum()), 1e300)
            m, x = np.frexp(total)
            forward[end], scale[end] = m, top + x
        self.paths[row] = paths[n]

    def draw(self, kinds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A segmentation of each chunk: lattice slots, their count, log probability. ``keys`` seed the chunks' noise."""
        place, logs, counts = self.length[kinds], np.zeros(len(kinds)), np.zeros(len(kinds), np.int64)
        steps, busy, turn = [], np.arange(len(kinds)), 0
        while len(busy):
            at = self.base[kinds[busy]] + self.off[place[busy]]
            u = (mixed(keys[busy] + np.array([turn], np.uint64) * STEP) >> np.uint64(11)) * 2.0**-53
            last = at + np.minimum(place[busy], self.pieces.longest) - 1
            on = np.arange(len(busy))
            best = at.copy()
            while len(on):
                q = self.share[at[on]]
                u[on] -= q
                best[on] = np.where(q > 0, at[on], best[on])
                on = on[(u[on] >= 0) & (at[on] < last[on])]
                at[on] += 1
            logs[busy] += np.log(self.share[best])
            size = best - (self.base[kinds[busy]] + self.off[place[busy]]) + 1
            place[busy] -= size
            counts[busy] += 1
            steps.append((busy, best))
            busy = busy[place[busy] > 0]
            turn += 1
        ends = np.cumsum(counts)
        out = np.zeros(ends[-1] if len(ends) else 0, np.int64)
        for t, (who, at) in enumerate(steps):
            out[ends[who] - 1 - t] = at  # drawn from the end
        return out, counts, logs

    def draw_other(self, kind: int, taken: list[np.ndarray], u: Iterator[float]) -> tuple[np.ndarray, float] | None:
        """One segmentation of a chunk that is none of ``taken``, and its log probability; None if none has a share."""
        place, out, log, base = int(self.length[kind]), [], 0.0, int(self.base[kind])
        paths = [(p[::-1].tolist(), 0) for p in taken]
        while place > 0:
            first = base + int(self.off[place])
            shares = self.share[first : first + min(place, self.pieces.longest)].tolist()
            weight = list(shares)
            for path, i in paths:  # what of a slot's share is taken
                weight[path[i] - first] -= math.prod(self.share[path[i:]].tolist())
            weight = [w if w > 1e-15 else 0.0 for w in weight]
            if not sum(weight):
                return None
            aim = next(u) * sum(weight)
            chosen = max(i for i, w in enumerate(weight) if w)
            for i, w in enumerate(weight):
                aim -= w
                if aim < 0 and w:
                    chosen = i
                    break
            at = first + chosen
            paths = [(p, i + 1) for p, i in paths if p[i] == at and i + 1 < len(p)]
            out.append(at)
            log += math.log(shares[chosen])
            place -= chosen + 1
        return np.array(out[::-1], np.int64), log


def _chunks(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The chunks of all texts, each text with a space before it, and the number of each text's chunks.

    A chunk begins at a space, at a line end and after one. An empty text has none."""
    raw = [f" {t}".encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    sizes = np.array([len(x) for x in raw], np.int64)
    buffer = b"".join(raw)
    b = np.frombuffer(buffer, np.uint8)
    begins = (b == 32) | (b == 10)
    begins[1:] |= b[:-1] == 10
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(b)).astype(np.int32)
    chunks = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(buffer)).dictionary_encode()
    ends = np.cumsum(sizes)
    return chunks, np.searchsorted(starts, ends) - np.searchsorted(starts, ends - sizes)


def _below(mass: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values of sets with log mass ``mass``, given that they are below ``top``."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        free = mass - np.log(-np.log(u))
        return np.where(np.isneginf(mass), -np.inf, -np.logaddexp(-top, -free))


def _log_rest(log_taken: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(-np.expm1(np.minimum(log_taken, 0.0)), 0.0))


def _uniform(keys: np.ndarray) -> np.ndarray:
    return ((mixed(keys) >> np.uint64(11)) + 0.5) * 2.0**-53


def _stream(key: int) -> Iterator[float]:
    """Numbers between 0 and 1 by splitmix64."""
    whole = (1 << 64) - 1
    while True:
        key = (key + int(STEP)) & whole
        x = ((key ^ (key >> 30)) * int(MIX_1)) & whole
        x = ((x ^ (x >> 27)) * int(MIX_2)) & whole
        yield ((x ^ (x >> 31)) >> 11) * 2.0**-53


def samples(pieces: Pieces, texts: list[str], keys: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its samples, each (ids, log_prob, perturbed, inclusion)."""
    chunks, counts = _chunks(texts)
    lat = Lattices(pieces, chunks.dictionary)
    kinds = chunks.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    starts = np.cumsum(counts) - counts
    number = np.arange(len(kinds)) - starts[doc]
    noise = lambda round_, of: mixed(mixed(keys[doc[of]] + np.array([2 * round_], np.uint64) * STEP) ^ mixed(number[of].astype(np.uint64) + np.uint64(1)))

    pool, size = [], 0
    seg_at, seg_n, seg_log, node = [], [], [], []  # by round: each chunk's segmentation in the pool, and the value of the set it parts from
    excluded: dict[tuple[int, int], list[np.ndarray]] = {}
    top = -np.log(-np.log(_uniform(keys + STEP)))
    live = np.ones(len(texts), bool)
    departs = starts.copy()
    source = np.zeros(len(texts), np.int64)
    out: list[list[tuple[np.ndarray, float, float]]] = [[] for _ in texts]
    everything = np.arange(len(kinds))
    for r in range(k + 1):
        if r:
            # The set with the largest value, of all rounds so far, of each text.
            best = np.full(len(texts), -np.inf)
            for j, values in enumerate(node):
                if len(values):
                    most = np.full(len(texts), -np.inf)
                    np.maximum.at(most, doc, values)
                    better = most > best
                    best[better], source[better] = most[better], j
            live &= np.isfinite(best)
            top = np.where(live, best, -np.inf)
            if r == k or not live.any():
                break
            for j, values in enumerate(node):
                hit = np.flatnonzero((values == top[doc]) & (source[doc] == j) & live[doc])
                departs[doc[hit[::-1]]] = hit[::-1]
        fresh = everything if not r else everything[live[doc] & (everything > departs[doc])]
        entries, n, logs = lat.draw(kinds[fresh], noise(r, fresh))
        pool.append(entries)
        if r:
            at, each, log = (np.choose(source[doc], x) if len(x) > 1 else x[0].copy() for x in (seg_at, seg_n, seg_log))
        else:
            at, each, log = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64), np.zeros(len(kinds))
        at[fresh], each[fresh], log[fresh] = size + np.cumsum(n) - n, n, logs
        size += len(entries)
        flat = None
        if r:
            flat = np.concatenate(pool)
            more = []
            for d in np.flatnonzero(live).tolist():
                c, j = int(departs[d]), int(source[d])
                taken = excluded.setdefault((j, c), [flat[seg_at[j][c] : seg_at[j][c] + seg_n[j][c]]])
                found = lat.draw_other(int(kinds[c]), taken, _stream(int(noise(r, np.array([c]))[0])))
                if found is None:
                    live[d], node[j][c] = False, -np.inf
                    continue
                at[c], each[c], log[c] = size, len(found[0]), found[1]
                more.append(found[0])
                size += len(found[0])
                taken.append(found[0])
                # What is left of the set, below the value just drawn.
                before = float(log[starts[d] : c].sum())
                gone = float(np.logaddexp.reduce([np.log(lat.share[p]).sum() for p in taken]))
                mass = np.array([before + _log_rest(np.array([gone]))[0] if lat.paths[kinds[c]] > len(taken) else -np.inf])
                node[j][c] = _below(mass, top[d : d + 1], _uniform(noise(r, np.array([c])) + np.uint64(7)))[0]
            pool.extend(more)
        seg_at.append(at)
        seg_n.append(each)
        seg_log.append(log)
        # Sets that first depart from this sample in a chunk that was drawn anew.
        before = np.cumsum(log) - log
        before -= before[starts[doc]] if len(doc) else 0
        mass = np.where(lat.paths[kinds] > 1, before + _log_rest(log), -np.inf)
        values = np.full(len(kinds), -np.inf)
        values[fresh] = _below(mass[fresh], top[doc[fresh]], _uniform(noise(r, fresh) + np.uint64(7)))
        values[~live[doc]] = -np.inf
        node.append(values)
        # The sample itself.
        flat = np.concatenate(pool)
        ends = np.cumsum(each)
        index = np.repeat(at - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        ids = lat.entry[flat[index]]
        bounds = np.concatenate(([0], ends))[np.append(starts, len(each))]
        total = np.add.reduceat(np.append(log, 0.0), np.minimum(starts, len(log))) if len(starts) else np.zeros(0)
        spelled = len(ids) and ids.min() < 0
        for d in np.flatnonzero(live).tolist():
            own = ids[bounds[d] : bounds[d + 1]]
            if spelled and len(own) and own.min() < 0:
                own = np.array([x for e in own.tolist() for x in pieces.spelled(e)], np.int32)
            out[d].append((own, float(total[d]) if counts[d] else 0.0, float(top[d])))
    with np.errstate(over="ignore"):
        return [[(ids, log, value, float(-np.expm1(-np.exp(log - top[d]))) if np.isfinite(top[d]) else 1.0) for ids, log, value in out[d]] for d in range(len(texts))]


def _encode(broadcast, k: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = broadcast.value
        for part in slices(batches, "__text", 2 << 20):
            texts = part.column("__text").to_pylist()
            found = samples(pieces, texts, part.column("__key").to_numpy().view(np.uint64), k)
            n = np.array([len(x) for x in found], np.int64)
            rows = pa.array(np.repeat(np.arange(len(texts)), n))
            flat = [s for x in found for s in x]
            sizes = np.array([len(s[0]) for s in flat], np.int64)
            ids = lists(np.concatenate([s[0] for s in flat]).astype(np.int32), sizes)
            exact = [pieces.decoded(s[0].tolist()) == t for t, x in zip(texts, found, strict=True) for s in x]
            number = np.concatenate([np.arange(1, c + 1) for c in n]).astype(np.int32)
            values = [pa.array(np.array([s[i] for s in flat], float)) for i in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(rows) for c in keep), pa.array(number), ids, pa.array(sizes.astype(np.int32)), *values, pa.array(exact, pa.bool_())],
                [*keep, "sample", "ids", "n_pieces", "log_prob", "perturbed", "inclusion", "exact"],
            )

    return run


def pieces_of(spark, model: str = MODEL, alpha: float = ALPHA):
    """The broadcast pieces of a model file."""
    with open(model, "rb") as f:
        return spark.sparkContext.broadcast(Pieces(f.read(), alpha))


def encoded(docs: DataFrame, pieces, k: int = SAMPLES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of ``docs`` up to ``k`` rows, best perturbed value first: doc_id, sample (from 1), ids, n_pieces, log_prob,
    perturbed, inclusion, exact (whether the ids decode to the text)."""
    key = F.xxhash64(F.col(doc_id))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), key.alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return rows.mapInArrow(_encode(pieces, k, ["doc_id"]), f"doc_id long, {SCHEMA}, exact boolean")


def decoded(rows: DataFrame, pieces, ids: str = "ids") -> DataFrame:
    """``rows`` with the text that ``ids`` stand for, null where they are null, in ``text``."""
    own = rows.withColumn("text", F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if x is None else pieces.value.decoded(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)], batch.schema.names)

    return own.mapInArrow(run, own.schema)
