"""Language-model scores from a corpus: a trie of n-grams in Elias-Fano levels, written as files, mapped and asked by blocks of texts.

Every token of the training rows is counted, and every pair and triple of tokens, over the whole vocabulary. Words go by
62-bit hashes to ranges of hashes, which count them and give each an id, small ids to frequent words. Pairs and triples go
by ids to shards of contexts (the words before the last). N-grams met fewer than ``least`` times over all training rows (by
default once) are no part of the model, so words met fewer times share one id, 0, that counts in totals only; no other limit holds.

A shard sums the counts of its n-grams and writes one file: the contexts' words and the last words, each level a monotone
sequence in Elias-Fano (low bits packed, high bits as a bit vector) of values relative to their context, monotone pointers
from each node to the nodes after it, and codes of ``bits`` bits into two books of numbers: what a context gives to each
n-gram (absolute discounting) and what it leaves to the next lower order. The file lies in the shared folder and is mapped
where that folder is local. A query goes down the levels: in a node's range between two pointers it searches the successor
of the next word. A filter of eight bits or more an n-gram turns most others away before.

Texts are read once, into blocks of about ``BLOCK`` bytes. A block asks a shard once for each distinct n-gram it has, with
its own count from training rows, so a common n-gram weighs no more in a shard than a rare one. Contexts that may hold more
than 1 / ``hot`` of all n-grams are split by their last words over several shards; there are fewer than ``hot`` such words and
``hot`` squared such pairs, whose sums of parts are sent to all blocks. Nothing else is broadcast but two totals.

A book holds every number of its file where 2 ** ``bits`` are enough, else steps of equal width in the logarithm. Half a step,
twice a token, bounds what a score is off (``off_by``). Words' counts are exact, as the base score needs them.

Null text is empty: one end token. Null ``doc_id``: not trained on, not held out. Each row gives one row; repeated rows
are scored alike. An empty table gives an empty result. Texts that are not trained on are scored like the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import STEP, mixed, slices
from weftline.settings import shared_dir, written

VOCABULARY = 1 << 17
"""Words that a worker hashes at a time; the model holds all words."""
BLOCK = 8 << 20
BLOCKS_A_SHARD, BLOCKS_A_TASK = 2, 2
DISCOUNT = 0.75
BITS = 12
HOT = 1024
FOLDS, HELD_OUT = 7, 2
END = b""
_ONES = np.uint64((1 << 62) - 1)


def _hashes(words: list[bytes]) -> np.ndarray:
    return (np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64) & _ONES).astype(np.int64)


_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def distinct_tokens(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct tokens of all texts, the place of each token among them, and the number of each text's tokens."""
    # White space becomes blanks, a line end ends each text. A token begins at a line end and where blanks or one end.
    raw = [t.encode("utf-8", "surrogatepass").lower().translate(_SPACES) + b"\n" for t in texts]
    buffer = b"".join(raw)
    b = np.frombuffer(buffer, np.uint8)
    ends, blank = b == 10, b == 32
    begins = ends.copy()
    begins[1:] |= ~blank[1:] & (blank[:-1] | ends[:-1])
    begins[:1] |= ~blank[:1]
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(b)).astype(np.int32)
    found = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)]).dictionary_encode()
    # A token came with the blanks after it.
    words = [x.rstrip(b" \n") for x in found.dictionary.to_pylist()]
    stops = np.cumsum([len(x) for x in raw])
    return words, found.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(starts, np.append(0, stops)))


class EliasFano:
    """An increasing sequence of numbers, by packed low bits and a bit vector of high bits."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.low, self.high, self.zeros, self.filter = (arrays[k] for k in ("low", "high", "zeros", "filter"))
        self.n, self.bits, self.top = (int(x) for x in arrays["shape"])
        self.ones = 64 * np.arange(len(self.zeros)) - self.zeros

    @staticmethod
    def built(values: np.ndarray, filtered: bool = True) -> dict[str, np.ndarray]:
        n = len(values)
        most = int(values[-1]) if n else 0
        bits = max(0, ((most + 1) // max(n, 1)).bit_length() - 1)
        v = values.astype(np.uint64)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            part = v & np.uint64((1 << bits) - 1)
            np.bitwise_or.at(low, word, part << off)
            over = off + np.uint64(bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - off[over]))
        top = most >> bits
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((n + top + 1 + 63) // 64 * 64, np.uint8)
        flags[ones] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))))
        marks = np.zeros(1 << max(6, (16 * n).bit_length()) if filtered else 8, np.uint8)
        if filtered:
            marks[_mark(v, len(marks))] = 1
        return {"low": low, "high": high, "zeros": zeros.astype(np.uint32), "filter": np.packbits(marks, bitorder="little"), "shape": np.array([n, bits, top], np.int64)}

    def _select_zero(self, j: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, j, "right") - 1
        return self._select(~self.high[word], word * 64, (j - self.zeros[word]).astype(np.int64))

    @staticmethod
    def _select(rest: np.ndarray, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the set bit of each rank in the words ``rest``, which begin at the bits ``at``."""
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(rest & np.uint64((1 << width) - 1)).astype(np.int64)
            beyond = rank >= count
            rank = np.where(beyond, rank - count, rank)
            rest = np.where(beyond, rest >> np.uint64(width), rest)
            at = at + width * beyond
        return at

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        rest = np.where(off > 0, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> off) | rest) & np.uint64((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places of the sequence."""
        word = np.searchsorted(self.ones, i, "right") - 1
        at = self._select(self.high[word], word * 64, i - self.ones[word])
        return ((at - i) << self.bits) | self._low(i).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each number in the sequence, -1 where it is not there: the successor in the bucket of its high bits.

        A filter of sixteen bits a number turns most others away."""
        out = np.full(len(x), -1, np.int64)
        near = np.flatnonzero((x >= 0) & (x >> self.bits <= self.top)) if self.n else np.zeros(0, np.int64)
        mark = _mark(x[near].astype(np.uint64), 8 * len(self.filter))
        near = near[(self.filter[mark >> 3] >> (mark & 7).astype(np.uint8)) & 1 == 1]
        if not len(near):
            return out
        asked, back = np.unique(x[near], return_inverse=True)
        b = asked >> self.bits
        end = self._select_zero(b) - b
        begin = np.where(b > 0, self._select_zero(np.maximum(b - 1, 0)) - (b - 1), 0)
        want = (asked & ((1 << self.bits) - 1)).astype(np.uint64)
        lo, hi = begin.copy(), end.copy()
        while (busy := np.flatnonzero(lo < hi)).size:
            mid = (lo[busy] + hi[busy]) >> 1
            less = self._low(mid) < want[busy]
            lo[busy] = np.where(less, mid + 1, lo[busy])
            hi[busy] = np.where(less, hi[busy], mid)
        there = np.flatnonzero(lo < end)
        hit = there[self._low(lo[there]) == want[there]]
        place = np.full(len(asked), -1, np.int64)
        place[hit] = lo[hit]
        out[near] = place[back]
        return out


def _mark(x: np.ndarray, size: int) -> np.ndarray:
    return ((x * STEP) >> np.uint64(65 - size.bit_length())).astype(np.int64)


# --- blocks ----------------------------------------------------------------------------------------------------


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, as byte planes, without those above the largest number of a column."""
    head, planes = [len(columns)], []
    for column in columns:
        c = np.ascontiguousarray(column, np.int64)
        width = 8 if c.min(initial=0) < 0 else -(-int(c.max(initial=0)).bit_length() // 8)
        head += [len(c), width]
        planes += [np.ascontiguousarray(x) for x in c.view(np.uint8).reshape(-1, 8).T[:width]]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.array(head, np.int64).tobytes(), *planes]))


def _unpacked(blob: bytes) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = int(data[:8].view(np.int64)[0])
    at, out = 8 + 16 * n, []
    for size, width in data[8:at].view(np.int64).reshape(-1, 2).tolist():
        planes = np.zeros((size, 8), np.uint8)
        planes[:, :width] = data[at : at + size * width].reshape(width, size).T
        out.append(planes.view(np.int64).ravel())
        at += size * width
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=0)


def _stored(data: bytes, folder: str, ending: str) -> str:
    """A new file of the folder; gives its address."""
    system, path = pa.fs.FileSystem.from_uri(folder)
    name = f"{uuid.uuid4()}.{ending}"
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(data)
    return f"{folder}/{name}"


def _blocks(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Files of blocks: texts as places among the distinct words of their block."""
        at, kept, size = TaskContext.get().partitionId() << 33, [], 0

        def out() -> pa.RecordBatch:
            keys, place = np.unique(np.concatenate([k for k, *_ in kept]), return_inverse=True)
            moved, begin = [], 0
            for k, p, *_ in kept:
                moved.append(place[begin : begin + len(k)][p])
                begin += len(k)
            rest = [np.concatenate([x[i] for x in kept]) for i in range(2, 5)]
            # Frequent words first: small numbers pack well.
            word = np.concatenate(moved)
            order = np.argsort(-np.bincount(word, minlength=len(keys)), kind="stable")
            rank = np.empty(len(keys), np.int64)
            rank[order] = np.arange(len(keys))
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_stored(_packed(keys[order], rank[word], *rest), folder, "block")])], ["block", "path"])

        for part in slices(batches, "text"):
            texts = part.column("text")
            words, place, counts = distinct_tokens(texts.to_pylist())
            keys = np.concatenate([_hashes(words[i : i + VOCABULARY]) for i in range(0, len(words), VOCABULARY)])
            flag = lambda name: part.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = part.column("doc_id")
            flags = flag("train") + 2 * flag("held_out") + 4 * ids.is_null().to_numpy(zero_copy_only=False)
            kept.append((keys, place, counts, ids.fill_null(0).to_numpy(), flags))
            size += texts.nbytes
            if size >= BLOCK:
                yield out()
                at, kept, size = at + 1, [], 0
        if kept:
            yield out()

    return run


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their first words and of their last word."""
    return (mixed(a.astype(np.uint64) * STEP + b.astype(np.uint64)) >> np.uint64(2)).astype(np.int64)


# --- files of tries ---------------------------------------------------------------------------------------------


def _gram(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of columns of numbers."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mixed(out * STEP + c.astype(np.uint64) + np.uint64(1))
    return out


def _marks(hashes: np.ndarray) -> np.ndarray:
    marks = np.zeros(1 << max(6, (8 * len(hashes)).bit_length()), np.uint8)
    marks[_mark(hashes, len(marks))] = 1
    return np.packbits(marks, bitorder="little")


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _mark(hashes, 8 * len(marks))
    return (marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _coded(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A book of numbers, and the number's place in it for each value (all above 0): at most ``off_by`` off in the logarithm."""
    book, code = np.unique(values, return_inverse=True)
    if len(book) > 1 << bits:
        low, high = np.log10(book[0]), np.log10(book[-1])
        width = (high - low) / (1 << bits)
        code = np.minimum(((np.log10(values) - low) / width).astype(np.int64), (1 << bits) - 1)
        book = 10 ** (low + width * (np.arange(1 << bits) + 0.5))
    return book, code.astype(np.uint8 if bits <= 8 else np.uint16 if bits <= 16 else np.uint32)


def off_by(low: float, high: float, bits: int = BITS) -> float:
    """What the logarithm of a coded number between ``low`` and ``high`` is off at most."""
    return np.log10(high / low) / (2 << bits)


class Trie:
    """N-grams as levels of nodes: each level an increasing sequence, with the places where each node's successors begin."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        part = lambda name: EliasFano({k.rpartition(".")[2]: x for k, x in arrays.items() if k.startswith(f"{name}.")})
        self.levels = [(part(f"values{d}"), part(f"pointers{d}")) for d in range(int(arrays["depth"][0]))]
        self.width = int(arrays["depth"][1])
        self.books = [(arrays[f"book_{x}"], arrays[f"code_{x}"], arrays[f"marks_{x}"]) for x in ("given", "left")]

    @staticmethod
    def built(columns: list[np.ndarray], given: np.ndarray, left: np.ndarray, bits: int, width: int = 1) -> dict[str, np.ndarray]:
        """Of distinct n-grams in order: what its context gives to each, and what each context leaves, in the order of contexts."""
        out = {"depth": np.array([len(columns), width])}
        new, before = np.arange(len(given)) == 0, np.zeros(1, np.int64)
        for d, column in enumerate(columns):
            new |= np.diff(column, prepend=-1) != 0
            at = np.flatnonzero(new)
            pointers = np.append(np.searchsorted(at, before), len(at))
            values = column[at]
            if len(at):
                base = np.cumsum(values[pointers[1:] - 1] + 1)
                values = values + np.repeat(np.append(0, base[:-1]), np.diff(pointers))
                before = at
            for name, x in ((f"values{d}", values), (f"pointers{d}", pointers)):
                out |= {f"{name}.{k}": y for k, y in EliasFano.built(x, filtered=False).items()}
            if d == len(columns) - 2:
                contexts = [c[at] for c in columns[:-1]]
        for name, numbers, keys in (("given", given, columns), ("left", left, contexts)):
            out[f"book_{name}"], out[f"code_{name}"] = _coded(numbers, bits)
            out[f"marks_{name}"] = _marks(_gram(keys))
        return out

    @staticmethod
    def write(arrays: dict[str, np.ndarray], folder: str) -> str:
        """Built arrays as a new file in the folder; gives its address."""
        system, path = pa.fs.FileSystem.from_uri(folder)
        name = f"{uuid.uuid4()}.trie"
        data = pa.array([x.tobytes() + bytes(-x.nbytes % 8) for x in arrays.values()], pa.large_binary())
        rows = pa.table({"name": list(arrays), "type": [x.dtype.str for x in arrays.values()], "n": [len(x) for x in arrays.values()], "data": data})
        with system.open_output_stream(f"{path}/{name}") as out, pa.ipc.new_file(out, rows.schema) as file:
            file.write_table(rows)
        return f"{folder}/{name}"

    @classmethod
    def read(cls, uri: str) -> Trie:
        system, path = pa.fs.FileSystem.from_uri(uri)
        rows = pa.ipc.open_file(pa.memory_map(path) if isinstance(system, pa.fs.LocalFileSystem) else system.open_input_file(path)).get_batch(0)
        names, types, sizes = (rows.column(c).to_pylist() for c in ("name", "type", "n"))
        return cls({k: np.frombuffer(rows.column("data")[i].as_buffer(), t, n) for i, (k, t, n) in enumerate(zip(names, types, sizes, strict=True))})

    def _successor(self, depth: int, node: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The successor of each node that has a value, -1 where none has: searched between the node's two pointers."""
        values, pointers = self.levels[depth]
        out = np.full(len(node), -1, np.int64)
        if not values.n:
            return out
        begin, end = pointers.get(node), pointers.get(node + 1)
        want = value + np.where(begin > 0, values.get(np.maximum(begin - 1, 0)) + 1, 0)
        lo, hi = begin.copy(), end.copy()
        while (busy := np.flatnonzero(lo < hi)).size:
            mid = (lo[busy] + hi[busy]) >> 1
            less = values.get(mid) < want[busy]
            lo[busy] = np.where(less, mid + 1, lo[busy])
            hi[busy] = np.where(less, hi[busy], mid)
        there = np.flatnonzero(lo < end)
        hit = there[values.get(lo[there]) == want[there]]
        out[hit] = lo[hit]
        return out

    def find(self, columns: list[np.ndarray]) -> np.ndarray:
        """Place of each n-gram, or of each context if there is one column less, in its level; -1 where it is not there."""
        out = np.full(len(columns[0]), -1, np.int64)
        near = np.flatnonzero(_marked(self.books[len(self.levels) - len(columns)][2], _gram(columns)))
        place, new = np.zeros(len(near), np.int64), np.arange(len(near)) == 0
        for depth, column in enumerate(c[near] for c in columns):
            # Neighbours that agree so far are searched once.
            new |= np.diff(column, prepend=-1) != 0
            head = np.flatnonzero(new)
            node, found = place[head], np.full(len(head), -1, np.int64)
            there = np.flatnonzero(node >= 0)
            found[there] = self._successor(depth, node[there], column[head[there]])
            place = np.repeat(found, np.diff(np.append(head, len(near))))
        out[near] = place
        return out

    def numbers(self, columns: list[np.ndarray]) -> np.ndarray:
        """What its context gives to each n-gram (0 if it is not there), or what each context leaves (1 if it is not there)."""
        of = len(self.levels) - len(columns)
        book, code, _ = self.books[of]
        place = self.find(columns)
        out = np.full(len(place), float(of))
        out[place >= 0] = book[code[place[place >= 0]]]
        return out


# --- blocks and shards ------------------------------------------------------------------------------------------


class Block:
    """The rows of a block and its words: hashes of the distinct ones, and the place of each token among them."""

    def __init__(self, uri: str):
        system, path = pa.fs.FileSystem.from_uri(uri)
        with system.open_input_file(path) as file:
            words, place, self.counts, self.doc_id, flags = _unpacked(file.read())
        order = np.argsort(words)
        self.hashes = words[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.word = rank[place]
        self.train, self.held_out, self.no_id = flags & 1, flags & 2 != 0, flags & 4 != 0
        self.starts = np.cumsum(self.counts) - self.counts


_SPLIT = 9
_ROWS = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])
_ROW = "shard long, part long, block long, blob binary"


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ROWS)], schema=_ROWS)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> 30) * shards) >> 32


def _ask_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, path in zip(batch.column("block").to_pylist(), batch.column("path").to_pylist(), strict=True):
                block = Block(path)
                n = np.bincount(block.word, np.repeat(block.train, block.counts), len(block.hashes)).astype(np.int64)
                there, first = np.unique(_shard(block.hashes, shards), return_index=True)
                cuts = zip(there.tolist(), *(np.split(x, first[1:]) for x in (block.hashes, n)), strict=True)
                yield from _rows([(shard, 0, at, _packed(_steps(k), x)) for shard, k, x in cuts]).to_batches()

    return run


def _count_words(shards: int, least: int):
    def run(key: tuple, asked: pa.Table) -> pa.Table:
        """To each block, the id and the count of each word it asks for; ``total`` and ``distinct`` of all in the first row."""
        shard = key[0].as_py()
        blobs = [_unpacked(b) for b in asked.column("blob").to_pylist()]
        keys = [np.cumsum(steps) for steps, _ in blobs]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate([n for _, n in blobs]), len(every)).astype(np.int64)
        rank = np.empty(len(every), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(every))
        ids = np.where(counts >= least, 1 + rank * shards + shard, 0)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        out = [(shard, 0, at, _packed(ids[p], counts[p])) for at, p in zip(asked.column("block").to_pylist(), np.split(place, cuts), strict=True)]
        totals = np.zeros((2, len(out)), np.int64)
        totals[:, 0] = counts.sum(), np.count_nonzero(counts)
        return _rows(out).append_column("total", pa.array(totals[0])).append_column("distinct", pa.array(totals[1]))

    return run


class Known(Block):
    """A block whose words have ids: its distinct pairs (1) and triples (2), in order, where they begin, and their shards.

    Words of id 0 begin no pair and are no first or second word of a triple, as the model holds none of these."""

    def __init__(self, rows: pa.Table):
        self.parts: dict[int, list[tuple[int, bytes]]] = {}
        for shard, part, blob in zip(*(rows.column(c).to_pylist() for c in ("shard", "part", "blob")), strict=True):
            self.parts.setdefault(part, []).append((shard, blob))
        super().__init__(self.parts[-1][0][1].decode())
        ids, self.one = self.whole(0)
        self.ids = np.unique(np.append(ids, 0))
        local = np.searchsorted(self.ids, ids)
        self.n = np.zeros(len(self.ids), np.int64)
        self.n[local] = self.one
        w, size = local[self.word], len(self.ids)
        last = np.zeros(len(w) + 2, bool)
        last[self.starts + self.counts - 1] = last[len(w) :] = True
        two = np.flatnonzero(~last[: len(w)] & (w > 0))
        pairs, pair = np.unique(w[two] * size + w[two + 1], return_inverse=True)
        inner = ~last[two + 1] & (w[two + 1] > 0)
        three = two[inner]
        triples, triple = np.unique(pair[inner] * size + w[three + 2], return_inverse=True)
        a, b = np.divmod(pairs, size)
        context, c = np.divmod(triples, size)
        # For each order: where n-grams begin, which begins there, then for each distinct one its context, the context's words, the last word.
        self.grams = {1: (two, pair, a, [a], b), 2: (three, triple, context, [a[context], b[context]], c)}

    def whole(self, part: int) -> list[np.ndarray]:
        """What ranges or shards answered, in their order."""
        columns = [_unpacked(b) for _, b in sorted(self.parts.get(part, []), key=lambda x: x[0])]
        return [np.concatenate(x) for x in zip(*columns, strict=True)] if columns else [np.zeros(0, np.int64)] * 2

    def dealt(self, order: int, shards: int, total: int, hot: int):
        """N-grams by shard, part and context: their order, where contexts begin in it, and each context's shard and part."""
        _, _, context, words, last = self.grams[order]
        most = np.minimum.reduce([self.n[x] for x in words])
        parts = np.where(most * hot > total, -(-most * hot // max(total, 1)), 1)
        part = np.where(parts > 1, 1 + (mixed(self.ids[last].astype(np.uint64)) >> np.uint64(8)).astype(np.int64) % parts, 0)
        key = part
        for x in words:
            key = _joined(key, self.ids[x])
        shard = _shard(key, shards)
        by = shard * (part.max(initial=0) + 1) + part
        order_ = np.argsort(by.astype(np.uint16) if by.max(initial=0) < 1 << 16 else by, kind="stable")
        new = (np.diff(by[order_], prepend=-1) != 0) | (np.diff(context[order_], prepend=-1) != 0)
        heads = np.flatnonzero(new)
        return order_, heads, shard[order_[heads]], part[order_[heads]]


def _ask_grams(shards: int, total: int, hot: int):
    def run(rows: pa.Table) -> pa.Table:
        block, at, out = Known(rows), rows.column("block")[0].as_py(), []
        train = np.repeat(block.train, block.counts)
        for order, (begin, gram, context, words, last) in block.grams.items():
            if not len(begin):
                continue
            n = np.bincount(gram, train[begin], len(context)).astype(np.int64)
            sort, heads, shard, part = block.dealt(order, shards, total, hot)
            sizes = np.diff(np.append(heads, len(sort)))
            contexts = [block.ids[x[sort[heads]]] for x in words]
            contexts = [contexts[0], contexts[1] if order == 2 else np.zeros(0, np.int64), part, sizes]
            there, first = np.unique(shard, return_index=True)
            cuts = [np.split(x, first[1:]) if len(x) else [x] * len(there) for x in contexts]
            grams = [np.split(x[sort], heads[first[1:]]) for x in (block.ids[last], n)]
            out += [(s, order, at, _packed(_steps(a), *x)) for s, a, *x in zip(there.tolist(), *cuts, *grams, strict=True)]
        return _rows(out)

    return run


def _in_rows(values: np.ndarray) -> list[np.ndarray]:
    """Numbers, 0 or more, in single precision, as codes of a book of their own."""
    book, code = np.unique(values.astype(np.float32), return_inverse=True)
    return [code, _steps(book.view(np.int32).astype(np.int64))]


def _of_rows(code: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.cumsum(book).astype(np.int32).view(np.float32).astype(np.float64)[code]


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers, in the order of pairs."""
    if (int(a.max()) + 1) * (int(b.max()) + 1) >= 1 << 63:
        a, b = (np.unique(x, return_inverse=True)[1] for x in (a, b))
    return a * (b.max() + 1) + b


def _shard_tries(folder: str, least: int, bits: int):
    def run(key: tuple, asked: pa.Table) -> pa.Table:
        """Writes the shard's trie of one order and answers blocks from it: what is given to each n-gram, what each context leaves.

        Of contexts that are split, rows of ``_SPLIT`` hold the part's sums."""
        shard, order = key[0].as_py(), key[1].as_py()
        blobs = [_unpacked(b) for b in asked.column("blob").to_pylist()]
        joined = lambda i: np.concatenate([x[i] for x in blobs])
        a, b, part, sizes, w, n = np.concatenate([np.cumsum(x[0]) for x in blobs]), *(joined(i) for i in range(1, 6))
        width = int(part.max()) + 1
        columns = [a * width + part] if order == 1 else [a, b * width + part]
        _, one, context = np.unique(columns[0] if order == 1 else _both(*columns), return_index=True, return_inverse=True)
        columns = [x[one] for x in columns]
        every = np.repeat(context, sizes)
        _, first, gram = np.unique(_both(every, w), return_index=True, return_inverse=True)
        counts = np.bincount(gram, n, len(first)).astype(np.int64)
        node, last = every[first], w[first]
        total = np.bincount(node, counts, len(one))
        kept = np.flatnonzero((counts >= least) & (last > 0))
        used = np.bincount(node[kept], counts[kept] - DISCOUNT, len(one)) / np.maximum(total, 1)
        held = np.unique(node[kept])
        path = Trie.write(Trie.built([*(x[node[kept]] for x in columns), last[kept]], (counts[kept] - DISCOUNT) / total[node[kept]], 1 - used[held], bits, width), folder)
        trie = Trie.read(path)
        given, left = trie.numbers([*(x[node] for x in columns), last]), trie.numbers(columns)
        cuts = [np.cumsum([len(x[i]) for x in blobs])[:-1] for i in (5, 3)]
        answers = zip(asked.column("block").to_pylist(), np.split(gram, cuts[0]), np.split(context, cuts[1]), strict=True)
        out = [(shard, order, block, _packed(*_in_rows(given[g]), *_in_rows(left[c]))) for block, g, c in answers]
        if width > 1:
            split = np.flatnonzero((columns[-1] % width > 0) & (total > 0))
            one, two = columns[0][split] // (width if order == 1 else 1), columns[-1][split] // width
            out.append((shard, _SPLIT, -1, _packed(np.full(len(split), order), one, two, columns[-1][split] % width, total[split].astype(np.int64), (used * total)[split].view(np.int64))))
        return _rows(out).append_column("path", pa.array([path] + [None] * (len(out) - 1), pa.string()))

    return run


def _weights(blobs: list[bytes]) -> tuple[dict, dict]:
    """Of split contexts: the share of each part in the context's total, and what the context leaves."""
    rows = []
    for *whole, sums in map(_unpacked, blobs):
        rows += zip(*(x.tolist() for x in (*whole, sums.view(np.float64))), strict=True)
    totals, used = {}, {}
    for *context, _, n, u in rows:
        k = tuple(context)
        totals[k], used[k] = totals.get(k, 0) + n, used.get(k, 0.0) + u
    return {tuple(r[:4]): r[4] / totals[tuple(r[:3])] for r in rows}, {k: 1 - used[k] / n for k, n in totals.items()}


class Answered(Known):
    def numbers(self, order: int, shards: int, total: int, hot: int, share: dict, rest: dict) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct n-gram, what its context gives to it, and what the context leaves."""
        sort, heads, _, part = self.dealt(order, shards, total, hot)
        words = self.grams[order][3]
        answers = [_unpacked(b) for _, b in sorted(self.parts.get(order, []), key=lambda x: x[0])]
        given, left = (np.concatenate([_of_rows(*a[i : i + 2]) for a in answers]) if answers else np.zeros(0) for i in (0, 2))
        sizes = np.diff(np.append(heads, len(sort)))
        if len(split := np.flatnonzero(part)):
            weight = np.ones(len(heads))
            first, second = (self.ids[x[sort[heads[split]]]].tolist() for x in (words[0], words[-1]))
            for i, a, b, p in zip(split.tolist(), first, second, part[split].tolist(), strict=True):
                weight[i], left[i] = share.get((order, a, b, p), 0.0), rest.get((order, a, b), 1.0)
            given = given * np.repeat(weight, sizes)
        out = np.empty((2, len(sort)))
        out[:, sort] = given, np.repeat(left, sizes)
        return out[0], out[1]


def _score(shards: int, train_tokens: int, distinct: int, hot: int, weights: tuple[dict, dict]):
    def run(rows: pa.Table) -> pa.Table:
        block = Answered(rows)
        p1 = ((block.one + 1) / (train_tokens + distinct + 1))[block.word]
        p = p1.copy()
        for order in (1, 2):
            begin, gram, *_ = block.grams[order]
            given, left = block.numbers(order, shards, train_tokens, hot, *weights)
            p[begin + order] = given[gram] + left[gram] * p[begin + order]
        summed = lambda x: np.add.reduceat(x, block.starts)
        n = len(block.counts)
        return pa.table(
            {
                "doc_id": pa.array(block.doc_id, mask=block.no_id), "held_out": block.held_out, "n_tokens": block.counts, "n_known": summed((block.one > 0)[block.word].astype(np.int64)),
                "train_tokens": np.full(n, train_tokens), "base_score": summed(np.log10(p1)), "score": summed(np.log10(p)),
            }
        )

    return run


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 2, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """For each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    remainder = F.crc32(F.col(doc_id).cast("string")) % FOLDS
    false = lambda x: F.coalesce(x, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), false(remainder == HELD_OUT).alias("held_out"), false(remainder != HELD_OUT).alias("train"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    folder = f"{shared_dir(spark)}/ngrams-{uuid.uuid4()}"
    folder = folder if "://" in folder else f"file://{folder}"
    system, path = pa.fs.FileSystem.from_uri(folder)
    system.create_dir(path)

    # Blocks and tries are files; only their addresses, what blocks ask and what they are answered go between tasks.
    blocks = written(rows.mapInArrow(_blocks(folder), "block long, path string"), "blocks")
    least_tasks, n_blocks = int(spark.conf.get("spark.sql.shuffle.partitions")), blocks.count()
    shards, tasks = (max(least_tasks, -(-n_blocks // x)) for x in (BLOCKS_A_SHARD, BLOCKS_A_TASK))
    by_block = lambda frame: frame.repartition(tasks, "block").groupBy("block")
    by_shard = lambda frame: frame.repartition(2 * shards, "shard", "part").groupBy("shard", "part")
    own = blocks.select(F.lit(-1).cast("long").alias("shard"), F.lit(-1).cast("long").alias("part"), "block", F.col("path").cast("binary").alias("blob"))
    words = blocks.repartition(tasks, "block").mapInArrow(_ask_words(shards), _ROW)
    words = written(by_shard(words).applyInArrow(_count_words(shards, least), f"{_ROW}, total long, distinct long"), "words")
    n, v = (int(x) for x in words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first())
    known = own.unionByName(words.drop("total", "distinct"))
    asked = by_block(known).applyInArrow(_ask_grams(shards, n, hot), _ROW)
    answers = written(by_shard(asked).applyInArrow(_shard_tries(folder, least, bits), f"{_ROW}, path string"), "answers")
    # Fewer than hot words and hot squared pairs are split.
    weights = _weights([bytes(r.blob) for r in answers.where(F.col("part") == _SPLIT).select("blob").toLocalIterator()])
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_block(known.unionByName(answers.where(F.col("part") < _SPLIT).drop("path"))).applyInArrow(_score(shards, n, v, hot, weights), result)
