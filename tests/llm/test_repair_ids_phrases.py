"""Conversation repair, id files and phrases against brute force and exact round trips."""

import random
import zlib
from collections import Counter
from hashlib import md5, sha256

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import spark_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftline.llm import catalogue, common, idfiles, phrases, repair

SF = "/root/testdata/sf0.001"
ODD = [(None, "null id"), (1, None), (2, ""), (3, "  \n"), (5, "Haus und Hof. " * 20_000), (6, "x" * 30_000), (7, "日本🙂 ▁ A\x00b c d é"), (7, "日本🙂 ▁ A\x00b"), (7, "日本🙂 ▁ A\x00b"), (-8, "<|endoftext|>a <|startoftext|>\t\r\nÉ ΑΣ")]
ODD_SCHEMA = "doc_id long, text string, lang string, ids string, base long, row string, hash int, __group int, n int, words string, n_tokens string"


def odd(spark):
    return spark.createDataFrame([(*r, None if r[0] == 3 else "de", "s", 1, "r", 2, 3, 4, "w", "t") for r in ODD], ODD_SCHEMA)


# --- repair ----------------------------------------------------------------------------------------------------

DUE = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def brute_kinds(rows):
    seen, kinds = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "ok" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return kinds


def brute_repair(rows):
    """Cost, audit and hash by keeping the least (cost, audit) of each state, from the front."""
    if not rows:
        return 0, "", sha256(b"").hexdigest()

    def with_insertions(best):
        for _ in range(4):
            for state, (cost, audit, out) in list(best.items()):
                new = (cost + 5, audit + "I", [*out, NAME[DUE[state]] + ":"])
                if DUE[state] not in best or new[:2] < best[DUE[state]][:2]:
                    best[DUE[state]] = new
        return best

    best = with_insertions({"": (0, "", [])})
    for (role, text), kind in zip(rows, brute_kinds(rows), strict=True):
        following = {}
        for state, (cost, audit, out) in best.items():
            options = [(state, 2, "D", [])]
            if kind in ("ok", "truncated"):
                more = 5 if kind == "truncated" else 0
                options.append((DUE[state], 1 + more, "R", [f"{NAME[DUE[state]]}:{text}"]))
                if role[:1] == DUE[state] or (role[:1] == "s" and not state):
                    options.append((role[:1], more, "K", [f"{role}:{text}"]))
            for to, step, letter, said in options:
                new = (cost + step, audit + letter, out + said)
                if to not in following or new[:2] < following[to][:2]:
                    following[to] = new
        best = with_insertions(following)
    cost, audit, out = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    return cost, audit, sha256("\n".join(out).encode()).hexdigest()


def brute_conversation(rows):
    """A result row from (turn, role, text) after damage, in order."""
    said = [(role, text) for _, role, text in rows]
    kinds = Counter(brute_kinds(said))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False))
    return (gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, *brute_repair(said))


def brute_damage(rows):
    """Rows (conv_id, turn, role, text) as conversations after damage."""
    out = {}
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], md5((" " if r[3] is None else r[3]).encode()).hexdigest()))
    for conv, turn, role, text in ordered:
        own = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        own += [(turn, "user" if fate == 4 else role, text)] * ((fate != 0) + (fate == 3))
    return {k: brute_conversation(v) for k, v in out.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(frame):
    rows = frame.collect()
    out = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_repair_equals_brute_force_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = repaired(catalogue.op11_repair(spark, SF))
    assert got == brute_damage(rows) and len(got) > 10


def test_repair_of_odd_conversations(spark):
    rng = random.Random(5)
    rows = [(None, 1, "user", "Null id."), (None, None, None, None), (1, None, "user", "a."), (1, None, "assistant", "b."), (1, 3, "", "c"), (2, 2, "user", None), (3, 1, "tool", "x" * 200_000)]
    rows += [(k, t, rng.choice(["user", "assistant", "system", "sage", "", None]), rng.choice(["Yes.", "No!", "", " \t", "cut", None, f"{rng.random()}?"])) for k in range(10, 60) for t in [rng.choice([None, 1, 2, 3, 9]) for _ in range(rng.randint(1, 12))]]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "conv_id long, turn long, role string, text string, row string, fate int, copy string")
    assert repaired(repair.repairs(frame)) == brute_damage(rows)
    assert repaired(repair.repairs(frame.limit(0))) == {}


def rows_of(conversations):
    return [(k, i, role, text, role, "", i, 0) for k, v in conversations.items() for i, (role, text) in enumerate(v)]


ROWS = "conv_id long, turn long, role string, text string, by string, hash string, row long, copy int"


@pytest.mark.parametrize("size", [4, 9])
def test_long_conversations_are_stitched_from_chunks(spark, size):
    """All user turns (whose costs never settle), alternating ones, only blanks, repeats across chunks, and anything."""
    rng = random.Random(size)
    whole = {
        1: [("user", f"{i}.") for i in range(33)],
        2: [(("user", "assistant")[i % 2], f"{i}.") for i in range(30)],
        3: [("user", " ")] * 20,
        4: [("system", "s.")] + [(("assistant", "user")[i % 2], f"{i // 10}.") for i in range(50)],
        5: [(rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", f"{rng.random()}.", f"{rng.random()}"])) for _ in range(60)],
        6: [("user", "only.")],
        None: [(rng.choice(["user", "assistant"]), f"{rng.random()}") for _ in range(30)],
    }
    rows = spark.createDataFrame(rows_of(whole), ROWS)
    ids = spark.createDataFrame([(k,) for k in [*whole, 99]], "conv_id long")
    want = {k: brute_conversation([(i, r, t) for i, (r, t) in enumerate(v)]) for k, v in whole.items()} | {99: brute_conversation([])}
    assert repaired(repair.repairs(ids, rows, rows_of_chunk=size)) == want


def test_insertions_are_taken_where_they_are_cheapest(monkeypatch):
    """With the dealt costs a deletion is always cheaper; the machine itself takes an insertion where it is not."""
    end = repair._least(repair.INSERTED, np.array([[0], [repair.FAR], [repair.FAR], [0]]))[:, 0]
    assert end.tolist() == [0, 10, 5, 0] == repair.END.tolist()
    chunk = repair.Chunks([np.array([repair.USER], np.uint8)])
    monkeypatch.setattr(repair, "DELETE", 9)
    monkeypatch.setattr(repair, "ROW", np.array([repair._least(repair.INSERTED, repair._edits(c)) for c in range(12)]))
    ends = end[None, :, None].copy()
    before, now = chunk.backward(ends)
    letters, states = chunk.traced(before, ends, np.zeros(1, np.int64), np.ones(1, bool))
    assert (now[0, 0, 0], letters, states.tolist()) == (5, [b"KI"], [repair.ASSISTANT])
    assert repair.repaired(b"KI", 0, ["user"], ["x"]) == ["user:x", "assistant:"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 11), max_size=30), st.integers(0, 30))
def test_settled_costs_give_the_same_vectors(codes, cut):
    """Costs of a first part from unit vectors, without those left out, joined with the rest, are the costs of the whole."""
    codes = np.array(codes, np.uint8)
    _, whole = repair.Chunks([codes]).backward(repair.END[None, :, None].copy())
    _, rest = repair.Chunks([codes[cut:]]).backward(repair.END[None, :, None].copy())
    _, unit = repair.Chunks([codes[:cut]]).backward(repair.UNIT[None].copy())
    kept, done = repair._settled(unit[0])
    joined = repair._least(kept, rest[0])[:, 0]
    assert joined.tolist() == whole[0, :, 0].tolist()
    if done:
        assert repair._vector(kept.ravel().tolist()).tolist() == (joined - joined.min()).tolist()


# --- files of ids ----------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=1200))
def test_words_give_the_ids_back(ids):
    ids = np.array(ids, np.uint64)
    data, total, plain = idfiles.packed(ids)
    assert (idfiles.unpacked(data, total, plain, len(ids)) == ids).all() and total.sum() == len(data)


def test_words_hold_as_many_ids_as_fit():
    """Each word takes the selector of most values that fit, as packing one by one does."""
    rng = np.random.default_rng(3)
    ids = (rng.integers(0, 2**62, 5000, dtype=np.uint64) >> rng.integers(0, 64, 5000, dtype=np.uint64)).astype(np.uint64)
    data, total, plain = idfiles.packed(ids)
    words, at = 0, 0
    while at < len(ids):
        room = idfiles.BLOCK - at % idfiles.BLOCK
        fits = [int(n) for n, w in zip(idfiles.COUNT[1:], idfiles.WIDTH[1:], strict=True) if all(int(x).bit_length() <= w for x in ids[at : at + min(int(n), room)])]
        at += min(max(fits, default=1), room, len(ids) - at)
        words += 1
    assert plain.sum() == words


TOKENIZER = Tokenizer.from_file(public_tokenizers.path(idfiles.TOKENIZER))


def whole_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check_files(spark, docs, rows, encoder):
    """Digests and ids of ``rows`` (doc_id, text), whose order within one doc_id is free."""
    files = idfiles.write(docs, encoder)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in idfiles.digests(files).collect()))
    want = Counter((k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, ids in ((k, whole_ids(t)) for k, t in rows))
    assert Counter(x[1:] for x in got) == want
    assert [x[0] for x in got] == np.cumsum([0, *(x[2] for x in got)])[:-1].tolist()
    keys = [x[1] for x in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    lists = Counter((r.doc_id, tuple(r.ids)) for r in idfiles.read(files).collect())
    assert lists == Counter((k, tuple(whole_ids(t))) for k, t in rows)


def test_files_give_the_ids_of_whole_texts_in_order(spark, monkeypatch):
    encoder = idfiles.encoder_of(spark)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    check_files(spark, docs, rows, encoder)
    got = {r.doc_id: r.start for r in catalogue.op12_idfiles(spark, SF).collect()}
    at = 0
    for k, t in sorted(rows):
        assert got[k] == at
        at += len(whole_ids(t))


def test_files_of_odd_texts(spark):
    check_files(spark, odd(spark).repartition(3), ODD, idfiles.encoder_of(spark))
    check_files(spark, odd(spark), ODD, idfiles.encoder_of(spark, cut=b""))
    assert idfiles.digests(idfiles.write(odd(spark).limit(0), idfiles.encoder_of(spark))).collect() == []


def test_one_key_is_spread_over_tasks(spark):
    docs = spark.range(4000).selectExpr("5L AS doc_id", "'one text' AS text").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = idfiles.write(docs, idfiles.encoder_of(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(f.docs for f in files) == 4000 and max(f.docs for f in files) < 2000


def test_a_reader_takes_only_the_blocks_it_needs(tmp_path):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 50_000, n) for n in (3, 0, 700, 1, 5000, 0)]
    with open(tmp_path / "x", "wb") as out:
        writer = idfiles.Writer(out)
        writer.add([None, 1, 2, 3, 4, 5], np.array([len(t) for t in texts]), np.concatenate(texts))
        writer.close()
    read = []

    class Source:
        def size(self):
            return (tmp_path / "x").stat().st_size

        def read_at(self, length, offset):
            read.append(length)
            return (tmp_path / "x").read_bytes()[offset : offset + length]

    file = idfiles.Reader(Source())
    read.clear()
    assert file.span(int(file.starts[3]), int(file.starts[4])).tolist() == texts[3].tolist() and sum(read) < 8 * 256
    stretches = {}
    for doc, _, ids in file.documents():
        stretches.setdefault(doc, []).extend(ids.tolist())
    assert stretches == {i: t.tolist() for i, t in enumerate(texts)} and file.null.tolist() == [True] + [False] * 5


def test_sums_before_each_row(spark):
    rng = random.Random(2)
    rows = [(p, s, rng.randint(0, 9)) for p in range(0, 5000, 7) for s in range(rng.randint(1, 3))]
    frame = spark.createDataFrame(rows, "part int, seq int, n long").repartition(5)
    got = {(r.part, r.seq): r.base for r in common.based(frame, "n", "part", "seq").collect()}
    at = 0
    for p, s, n in sorted(rows):
        assert got[p, s] == at
        at += n


# --- phrases ---------------------------------------------------------------------------------------------------

sequences = st.dictionaries(st.lists(st.sampled_from(["", "a", "b", "ab", "\0", "\1x", "é"]), max_size=4).map(tuple), st.integers(1, 2**40), max_size=40)


def in_order(d):
    return sorted(d.items(), key=lambda x: x[0])


@settings(max_examples=100, deadline=None)
@given(sequences, sequences)
def test_transducers_hold_unite_and_compose(a, b):
    one, two = phrases.transducer(in_order(a)), phrases.transducer(in_order(b))
    assert list(phrases.Transducer.loaded(one.dumped()).paths()) == in_order(a)
    assert phrases.united([one.dumped(), two.dumped()]) == {k: a.get(k, 0) + b.get(k, 0) for k in {*a, *b}}
    assert list(one.composed(two)) == [(k, w, b[k]) for k, w in in_order(a) if k in b]


def test_equal_states_are_one():
    keys = [(x, y, z) for x in "abc" for y in "de" for z in "fgh"]
    assert len(phrases.transducer((k, 5) for k in keys).states) == 4


def test_phrases_of_odd_texts_equal_their_sql(spark):
    rng = random.Random(4)
    words = ["on", "the", "Whole", "é", "ON", "x\x00y", "it"]
    rows = [*ODD, *((i, "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", ",", " ; ", " "]) for _ in range(rng.randint(0, 90)))) for i in range(100, 160))]
    rows = [(k, t, rng.choice(["de", "en", None, "und"]), "s", 1, "r", 2, 3, 4, "w", "t") for k, t in rows]
    frame = spark.createDataFrame(rows, ODD_SCHEMA).repartition(3)
    sql = phrases.SQL.replace(f">= {phrases.LEAST})", ">= 6)").replace(f"<= {phrases.TOP}", "<= 12")
    connection = duckdb.connect()
    connection.register("documents", pa.table({"lang": [r[2] for r in rows], "text": [r[1] for r in rows]}))
    result = connection.execute(sql)
    columns = sorted(d[0] for d in result.description)
    want = Counter(tuple(dict(zip([d[0] for d in result.description], r, strict=True))[c] for c in columns) for r in result.fetchall())
    got_columns, got = spark_rows(phrases.collocations(frame, least=6, top=12))
    assert got_columns == columns and got == want and len(got) > 30
    assert phrases.collocations(frame.limit(0)).collect() == []


def test_slots_that_collide_change_no_count(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = spark_rows(phrases.collocations(docs, least=40))
    monkeypatch.setattr(phrases, "bitmap", lambda rows: np.full(phrases.SLOTS // 8, 255, np.uint8))
    assert spark_rows(phrases.collocations(docs, least=40)) == want and len(want[1]) > 10
