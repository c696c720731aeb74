"""Near-duplicates, neighbours, decontamination, WARC packages and preferences against brute force and SQL."""

import io
import random
import re
import struct
from collections import Counter
from hashlib import sha1

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import catalogue, decontam, minhash, neighbours, preference, warc

WORDS = [f"w{i}" for i in range(400)]


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


# --- near-duplicates -------------------------------------------------------------------------------------------


def brute_classes(docs):
    split = re.compile(rb"[^\x20\x09-\x0D]+")
    sets = []
    for _, text in docs:
        w = split.findall((text or "").encode().lower())
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b, both = sets[j], len(a & sets[j])
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = find(docs[i][0]), find(docs[j][0])
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for (d, _), s in zip(docs, sets, strict=True)}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(WORDS)
    return out


def check_classes(spark, docs):
    got = minhash.classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(got)} == brute_classes(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows_of(got))


def test_families_of_all_sizes(spark):
    rng, docs = random.Random(1), []
    for family in range(40):
        base = [rng.choice(WORDS) for _ in range(rng.choice([3, 5, 6, 9, 20, 80, 200]))]
        for _ in range(rng.randint(1, 6)):
            docs.append((len(docs) * 7 % 1009, " ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 25))))))
    check_classes(spark, docs)


def test_one_large_group_with_a_chain_and_a_shared_passage(spark):
    """More members than a bucket's classes are compared for at once, linked by near neighbours only."""
    rng = random.Random(2)
    base, docs = [rng.choice(WORDS) for _ in range(120)], []
    for i in range(150):
        docs.append((i, " ".join(base)))
        if i % 3 == 0:
            base = edited(rng, base, 1)
    passage = [rng.choice(WORDS) for _ in range(60)]
    docs += [(1000 + i, " ".join(passage + [rng.choice(WORDS) for _ in range(50)])) for i in range(100)]
    check_classes(spark, docs)


def test_classes_of_odd_rows(spark):
    schema = "doc_id long, text string, node string, band long, label int"
    docs = [(None, "a b c d e f", "x", 1, 1), (None, None, None, None, None), (1, None, "", 2, 2), (2, "", "", 2, 2), (3, "  \n\t ", "", 2, 2), (5, "a B c", "", 2, 2), (4, "A b C", "", 2, 2), (4, "A b C", "", 2, 2), (9, "x " * 30_000, "", 0, 0), (8, "X " * 29_000, "", 0, 0), (7, "a b c d", "", 0, 0), (6, "É é x y z q", "", 0, 0)]
    got = rows_of(minhash.classes(spark.createDataFrame(docs, schema)))
    assert len(got) == len(docs)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == Counter(
        [(None, 2, None, True), (None, 0, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 1, 4, False), (4, 1, 4, True), (4, 1, 4, True), (9, 1, 8, False), (8, 1, 8, True), (7, 1, 7, True), (6, 2, 6, True)]
    )
    assert rows_of(minhash.classes(spark.createDataFrame([], schema))) == []


def test_the_last_turn_alone_links_all(spark, monkeypatch):
    """Without turns before it, the last one finds what centres leave open."""
    monkeypatch.setattr(minhash, "NEAREST_ROUNDS", 0)
    rng = random.Random(4)
    base, docs = [rng.choice(WORDS) for _ in range(90)], []
    for i in range(120):
        docs.append((i, " ".join(base)))
        if i % 2 == 0:
            base = edited(rng, base, 1)
    check_classes(spark, docs)


def test_parts_of_a_tile_hold_every_pair(monkeypatch):
    monkeypatch.setattr(minhash, "PART", 100)
    regs = [r.tobytes() for r in np.repeat(np.random.default_rng(1).integers(1, 99, (2, minhash.REGISTERS)).astype(np.uint8), 10, axis=0)]
    band = minhash._band_keys(np.frombuffer(regs[0], np.uint8)[None]).view(np.int64)[0, 0].item()
    rows = [{"band": band, "i": 0, "j": 0, "side": side, "node": node, "n": 20 + node, "label": node, "regs": regs[node]} for side in (0, 1) for node in range(20)]
    tile = pa.Table.from_pylist(rows, pa.schema([(c, pa.int64()) for c in ("band", "i", "j", "side", "node", "n", "label")] + [("regs", pa.binary())]))
    got, sizes = [], Counter()
    for r in pa.Table.from_batches(minhash._parts(iter(tile.to_batches(max_chunksize=7)))).to_pylist():
        got += [frozenset((r["node"], b)) for b in r["partners"]]
        sizes[r["part"]] += 20 + r["node"]
    assert sorted(map(sorted, got)) == [[a, b] for a in range(10) for b in range(a + 1, 10)]
    assert len(sizes) > 1 and max(sizes.values()) <= 100


def test_a_part_gives_the_links_that_join_its_classes():
    texts = {1: "a b c d e f g h", 2: "A b c d e f g h", 3: "a b c d e f g h", 4: "p q r s t u", 5: None}
    rows = pa.table({"node": list(texts), "partners": pa.array([[2, 3, 4], [3, 4], [], [5], []], pa.list_(pa.int64())), "text": list(texts.values())})
    assert minhash._confirm_part(rows).to_pylist() == [{"a": 1, "b": 2}, {"a": 1, "b": 3}]


def test_texts_of_one_id_join_their_classes(spark):
    docs = [(2, "a b c d e f"), (1, "g h i j k l"), (1, "a b c d e f"), (0, "m n o p q r"), (3, "g h i j k l")]
    got = rows_of(minhash.classes(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(2, 1), (1, 1), (3, 1), (0, 0)}


def test_estimates_follow_similarity():
    rng = np.random.default_rng(0)
    for n in (4, 30, 1000):
        errors = []
        for _ in range(60):
            a = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            b = a.copy()
            rng.shuffle(b)
            b[: n // 4] = rng.integers(0, 1 << 64, n // 4, dtype=np.uint64)
            b = np.sort(b)
            regs = minhash.registers([a, b])
            both = len(np.intersect1d(a, b))
            truth = both / (2 * n - both)
            errors.append(minhash.estimates(regs[0], regs[1:], np.array([n]), np.array([n]))[0] - truth)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


# --- neighbours ------------------------------------------------------------------------------------------------


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):  # in order; sum() would compensate
        total += float(x) * float(y)
    return total


def brute_neighbours(rows):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and (i not in ok or v < ok[i]):
            ok[i] = v
    out = []
    for q, a in ok.items():
        if q % 20 == 0:
            near = sorted((-dot(a, b), c) for c, b in ok.items() if c != q and len(a) == len(b))
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(near[:20], 1)]
    return sorted(out)


@pytest.mark.parametrize("copies", [0, 150])
def test_neighbours_with_ties_and_odd_vectors(spark, copies, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATES", 64)
    monkeypatch.setattr(neighbours, "QUERIES", 8)
    rng = np.random.default_rng(3)
    rows = [(i, np.float32(rng.standard_normal(8)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(copies)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [None, *[1.0] * 7]), (2080, [float("inf")] * 8), (None, [1.0] * 8), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (2120, []), (40, rows[40][1])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, across int, score string")
    got = neighbours.nearest(frame, frame.vec_id % 20 == 0)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert sorted(tuple(r) for r in got.collect()) == brute_neighbours(rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(empty, empty.vec_id % 20 == 0).collect() == []


# --- decontamination -------------------------------------------------------------------------------------------


def test_clean_documents_keep_columns_of_any_name(spark):
    rows = [(1, "a b c", 7, "x", "y", 5), (2, "the planted words", 8, None, "z", 6), (3, None, 9, "x", "w", 7)]
    docs = spark.createDataFrame(rows, "__doc long, text string, __met long, __hits string, doc string, c1 long")
    items = spark.createDataFrame([("i", "planted words")], "item_id string, text string")
    got = decontam.clean(docs, items)
    assert got.schema == docs.schema and sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [rows[0], rows[2]]



def brute_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(decontam.UPPER, decontam.LOWER)))
    w, hit, met = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(10, len(iw))
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for p in range(len(w) - n + 1):
            if n and tuple(w[p : p + n]) in windows:
                hit |= set(range(p, p + n))
                met.add(item)
    ids = ",".join(sorted(str(i) for i in met if i is not None))
    from hashlib import sha256

    return len(w), len(hit), len(met), sha256(ids.encode()).hexdigest(), bool(hit)


def test_contamination_equals_brute_force(spark):
    rng, few = random.Random(5), ["the", "a", "of", "É", "x1", "ÿ"]
    items = [(i, " ".join(rng.choice(few + WORDS[:30]) for _ in range(rng.choice([1, 2, 4, 9, 10, 11, 14, 40])))) for i in range(30)]
    items += [(None, "q r s t u v w x y z a b"), (77, None), (78, " - "), (3, items[3][1]), (79, items[5][1])]
    docs = [(None, items[5][1]), (1, None), (2, ""), (3, "...")]
    for i in range(60):
        words = [rng.choice(few + WORDS[:30]) for _ in range(rng.randint(0, 200))]
        if i % 2:
            part = rng.choice(items)[1] or ""
            at = rng.randint(0, len(words))
            words[at:at] = part.upper().split() if i % 4 == 1 else part.split()[: rng.randint(1, 40)]
        docs.append((10 + i, rng.choice([" ", ", ", "\n", "\x00"]).join(words)))
    docs += [docs[-1], (500, "Q-R.S,T u v w x y\tz A b " * 50)]
    frame = spark.createDataFrame([(*d, "m", 1, "w") for d in docs], "doc_id long, text string, met string, doc int, item_id string")
    bench = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, doc_id string")
    got = decontam.contamination(frame, bench)
    expected = Counter((d, *brute_hits(t, items)) for d, t in docs)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == expected
    kept = decontam.clean(frame, bench)
    assert kept.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(d for d in docs if not brute_hits(d[1], items)[-1])
    none = spark.createDataFrame([], bench.schema)
    assert decontam.contamination(frame, none).where("contaminated").count() == 0
    assert decontam.contamination(spark.createDataFrame([], frame.schema), bench).count() == 0


# --- WARC packages ---------------------------------------------------------------------------------------------


def test_packages_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE", 3000)
    long = "<p>é" * 400
    pages = [(1, "http://a/", long), (5, "http://b/\r\nX: y", long), (3, None, long), (None, "u", long), (2, "u", "short"), (4, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "\x00\r\n\r\nWARC/1.1" * 200), (None, "u", "lone" * 300), (9, "u", "y" * 999), (10, "u", "y" * 999), (11, "u", "z" * 1000), (11, "u", "z" * 1000), (12, "u", "z" * 1000)]
    frame = spark.createDataFrame([(*p, "d", 1) for p in pages], "page_id long, url string, html string, digest string, size int")
    expected = []
    for page, _, html in pages:
        body = (html or "").encode()
        ids = [p for p, _, h in pages if (h or "").encode() == body and p is not None]
        last = max(ids) if len(body) >= 1000 and ids else page
        expected.append((page, len(body), sha1(body).hexdigest(), "response" if last == page else "revisit", None if last == page else last))
    packages = warc.write(frame)
    assert packages.count() > 1 and packages.agg({"records": "sum"}).first()[0] == len(pages)
    assert Counter(tuple(r) for r in warc.read(packages).collect()) == Counter(expected)
    assert warc.read(warc.write(spark.createDataFrame([], frame.schema))).collect() == []


def test_zip64_directory_is_read():
    """A package whose sizes and offsets all stand in ZIP64 records."""
    import zlib

    members = {warc.DATA: zlib.compress(b"x", wbits=31), warc.INDEX: b'{"page_id": 1, "offset": 0, "length": %d}\n' % len(zlib.compress(b"x", wbits=31))}
    out, central, full = b"some bytes before", b"", 0xFFFFFFFF
    for name, data in members.items():
        raw, at = name.encode(), len(out)
        crc = zlib.crc32(data)
        out += struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, crc, full, full, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
        extra = struct.pack("<HHHH", 0x5455, 4, 0, 0) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        central += struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, crc, full, full, len(raw), len(extra), 0, 0, 0, 0, full) + raw + extra
    start = len(out)
    out += central
    end = len(out)
    out += struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 2, 2, len(central), start)
    out += struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1) + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, full, full, 3) + b"end"
    source = io.BytesIO(out)

    def read(offset, length):
        source.seek(offset)
        return source.read(length)

    assert [raw for _, raw in warc.Package(read, len(out)).records()] == [b"x"]


def test_every_record_is_found_by_range():
    records = [(i, __import__("zlib").compress(b"r%d" % i * 50, wbits=31)) for i in range(500)]
    blob, reads = warc.package(records), []

    def read(offset, length):
        reads.append(length)
        return blob[offset : offset + length]

    found = [(x["page_id"], raw) for x, raw in warc.Package(read, len(blob)).records()]
    assert found == [(i, b"r%d" % i * 50) for i in range(500)]
    assert len(reads) < 12


# --- preferences -----------------------------------------------------------------------------------------------

TURNS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "yo"), (0, 2, "user", "more"), (0, 3, "assistant", "end"),
    (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "less"), (1, 3, "assistant", "end"),
    (2, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, None, None), (4, None, "assistant", "<|end|> x"), (None, 0, "user", "lost"),
    (6, 0, "system", ""), (6, 1, "assistant", "a"), (7, 0, "system", ""), (8, 0, "user", "é" * 50_000), (9, 0, "assistant", "é" * 50_000),
]


def test_preferences_equal_sql_and_assemble(spark):
    frame = spark.createDataFrame([(*t, 5, "s") for t in TURNS], "conv_id long, turn long, role string, text string, pair_id int, side string")
    got = preference.segments(frame, preference.neighbours(frame))
    con = duckdb.connect()
    columns = list(zip(*TURNS, strict=True))
    conversations = pa.table({"conv_id": pa.array(columns[0], pa.int64()), "turn": pa.array(columns[1], pa.int64()), "role": pa.array(columns[2], pa.string()), "text": pa.array(columns[3], pa.string())})
    con.register("conversations", conversations)
    result = con.execute(preference.SQL)
    names = [d[0] for d in result.description]
    assert got.columns == names
    assert Counter(tuple(r) for r in got.collect()) == Counter(result.fetchall())
    example = {r.pair_id: r for r in preference.examples(got).collect()}
    first = example[0]
    assert first.prompt == "<|turn|>user\nhi<|end|>\n<|turn|>assistant\nyo<|end|>\n"
    assert first.chosen == "<|turn|>user\nmore<|end|>\n<|turn|>assistant\nend<|end|>\n"
    assert [first.chosen[a:b] for a, b in first.chosen_trained] == ["end<|end|>"]
    assert example[1].chosen == example[1].rejected == "" and example[1].prompt.count("same") == 1
    assert "< |end|> x" in example[2].chosen and example[3].rejected == ""
    assert preference.segments(spark.createDataFrame([], frame.schema), preference.neighbours(spark.createDataFrame([], frame.schema))).collect() == []


def test_registered_examples_pair_completions_after_a_shared_prompt(spark):
    sf = "/root/testdata/sf0.01"
    said = {}
    for c, n, role, text in set(duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet' WHERE conv_id IS NOT NULL").fetchall()):
        said.setdefault(c, []).append((n if n is not None else preference.LAST, role or "unknown", text or ""))
    clean = lambda x: x.replace("<|", "< |")
    shown = lambda turns: "".join(f"<|turn|>{clean(r)}\n{clean(t)}<|end|>\n" for _, r, t in sorted(turns))
    last = {c: max((n, t) for n, r, t in turns if r == "assistant") for c, turns in said.items() if any(r == "assistant" for _, r, _ in turns)}
    expected = {}
    for c, (n, text) in last.items():
        if c ^ 1 in last and text != last[c ^ 1][1]:
            expected[c] = (shown(t for t in said[c] if t[0] < n), shown(t for t in said[c] if t[0] == n), shown([(n, "assistant", last[c ^ 1][1])]))
    got = catalogue.queries()["op8_examples"](spark, sf).collect()
    assert len(got) == len({r.pair_id for r in got}) == sum(c ^ 1 in last for c in last)
    for r in got:
        if r.pair_id in expected:
            assert (r.prompt, r.chosen, r.rejected) == expected[r.pair_id]
            for whole, spans in ((r.chosen, r.chosen_trained), (r.rejected, r.rejected_trained)):
                assert [whole[a:b] for a, b in spans] == [whole.removeprefix("<|turn|>assistant\n")[:-1]]
        else:
            assert r.chosen == r.rejected == ""
    assert sum(r.prompt != "" for r in got) > 0.5 * len(got)
