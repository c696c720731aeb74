"""Token counts, segmentations, languages, n-gram scores and quality against brute force and held-out rows."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from weftline.llm import attribution, catalogue, langid, ngram, pieces, quality
from weftline.llm.common import STEP, mixed

SF = "/root/testdata/sf0.01"
ODD = [(None, "null id"), (1, None), (2, ""), (3, "   "), (4, "123 !!"), (5, "Haus und Hof " * 20_000), (6, "x" * 30_000), (7, "日本🙂 ▁ a\x00b"), (7, "日本🙂 ▁ a\x00b"), (8, "a\n\n  b ")]
ODD_SCHEMA = "doc_id long, text string, lang string, score string, held_out int, row string, known int"


def odd(spark):
    return spark.createDataFrame([(*r, None if r[0] == 8 else "de", "s", 1, "r", 2) for r in ODD], ODD_SCHEMA)


# --- token counts ----------------------------------------------------------------------------------------------


def brute_counts(encoder, text, spans, rule):
    ids = encoder.encoding.encode_ordinary(text)
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    owner = [-1] * len(text)
    order = sorted(range(len(spans)), key=lambda i: spans[i])
    for i in order:
        for c in range(spans[i][0], min(len(text), spans[i][1])):
            owner[c] = i if owner[c] < 0 else owner[c]
    counts, outside, at = [0.0] * len(spans), 0, 0
    for t in ids:
        size = len(encoder.encoding.decode_single_token_bytes(t))
        met = [owner[c] for c in sorted(set(char_of[at : at + size]))]
        at += size
        inside = [x for x in met if x >= 0]
        if rule == "start":
            inside = [x for x in met[:1] if x >= 0]
        elif rule == "end":
            inside = [x for x in met[-1:] if x >= 0]
        elif rule == "largest" and inside:
            n = Counter(inside)
            inside = [min(n, key=lambda x, n=n: (-n[x], order.index(x)))]
        outside += not inside
        for x in inside:
            counts[x] += 1 / len(inside)
    return counts, outside


@pytest.mark.parametrize("rule", ["largest", "start", "end", "share"])
def test_tokens_go_to_sections_by_the_rule(spark, rule):
    rng, rows = random.Random(7), []
    for i in range(40):
        text = "".join(rng.choice(list("ab cd\n.é日🙂 ") + [" the", "and "]) for _ in range(rng.randint(0, 50)))
        cuts = [rng.randint(0, len(text)) for _ in range(2 * rng.randint(0, 4))]
        spans = [tuple(sorted(cuts[j : j + 2])) for j in range(0, len(cuts), 2)]
        rows.append((i, text, spans))
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start:int,end:int>>")
    encoder = attribution.encoder_of(spark)
    got = {}
    for r in attribution.by_section(frame, "spans", encoder, rule).collect():
        got[r.doc_id, r.section] = r.n_tokens
    encoder.value.load()
    for i, text, spans in rows:
        counts, outside = brute_counts(encoder.value, text, spans, rule)
        assert [got[i, s] for s in range(len(spans))] == pytest.approx(counts)
        assert got.get((i, -1), 0) == outside


def test_tokens_of_odd_texts_add_up(spark):
    encoder = attribution.encoder_of(spark)
    got = attribution.by_line(odd(spark), encoder).collect()
    encoder.value.load()
    total = Counter()
    for r in got:
        total[r.doc_id] += r.n_tokens
    for doc, text in dict(ODD).items():
        assert total[doc] == len(encoder.value.encoding.encode_ordinary(text or "")) * [d for d, _ in ODD].count(doc)
    assert [(r.start, r.end) for r in got if r.doc_id == 1] == [(0, 0)]
    assert sorted((r.start, r.end) for r in got if r.doc_id == 8) == [(0, 2), (2, 3), (3, 7)]
    nulls = spark.createDataFrame([(1, "ab cd", [(None, 2), (3, None)]), (2, "x", None)], "doc_id long, text string, spans array<struct<start:int,end:int>>")
    assert sum(r.n_tokens for r in attribution.by_section(nulls, "spans", encoder).collect()) == 3
    assert attribution.by_line(spark.createDataFrame([], ODD_SCHEMA), encoder).collect() == []


# --- segmentations ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL, "rb") as f:
        return pieces.Pieces(f.read())


def all_segmentations(model, text):
    if not text:
        return {(): 1.0}
    out = {}
    for n in range(1, len(text) + 1):
        if text[:n] in model.known:
            head, p = (model.known[text[:n]][0],), model.known[text[:n]][1]
        elif n == 1:
            raw = text[0].encode()
            head, p = tuple(model.byte_id[b] for b in raw), model.byte_p ** len(raw)
        else:
            continue
        for rest, q in all_segmentations(model, text[n:]).items():
            out[head + rest] = p * q
    return out


def test_samples_follow_the_lattice_without_replacement(model):
    text, n = "the inner é▁", 8000
    shares = all_segmentations(model, " " + text)
    total = sum(shares.values())
    shares = {s: p / total for s, p in shares.items()}
    found = pieces.samples(model, [text] * n, mixed(np.arange(n, dtype=np.uint64) * STEP), 3)
    first, second = (Counter(tuple(x[i][0].tolist()) for x in found) for i in (0, 1))
    assert sum(abs(first[s] / n - p) for s, p in shares.items()) / 2 < 0.02
    after = Counter()
    for a, p in shares.items():
        for b, q in shares.items():
            if a != b:
                after[b] += p * q / (1 - p)
    assert sum(abs(second[s] / n - p) for s, p in after.items()) / 2 < 0.03
    for x in found[:300]:
        assert len({tuple(s[0].tolist()) for s in x}) == 3 and x[0][2] > x[1][2] > x[2][2]
        assert all(s[1] == pytest.approx(math.log(shares[tuple(s[0].tolist())])) for s in x)
    # Weighted by their inclusion scores, samples give unbiased sums.
    assert np.mean([sum(math.exp(s[1]) / s[3] for s in x) for x in found]) == pytest.approx(1, abs=0.02)


def test_all_segmentations_of_a_small_text_are_given(model):
    every = all_segmentations(model, " ab\nc")
    ((*found,),) = pieces.samples(model, ["ab\nc"], np.array([5], np.uint64), 100)
    assert {tuple(s[0].tolist()) for s in found} == set(every) and len(found) == len(every)
    assert all(s[3] == 1.0 for s in found)


def test_encoding_round_trips_and_is_seeded_by_key(spark):
    shared = pieces.pieces_of(spark)
    got = pieces.encoded(odd(spark), shared, k=3)
    rows = got.collect()
    assert all(r.exact for r in rows)
    texts = {d: t or "" for d, t in ODD}
    assert {(r.doc_id, r.text) for r in pieces.decoded(got, shared).collect()} == set(texts.items())
    again = pieces.encoded(odd(spark).repartition(7), shared, k=3).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r["sample"], r.ids, r.log_prob, r.inclusion)
    assert sorted(map(key, rows), key=str) == sorted(map(key, again), key=str)
    assert [(r.n_pieces, r.inclusion) for r in rows if r.doc_id == 2] == [(0, 1.0)]
    assert pieces.encoded(spark.createDataFrame([], ODD_SCHEMA), shared).collect() == []


# --- languages -------------------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    got = catalogue.op3_langid(spark, SF).collect()
    assert {r.doc_id for r in got} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held) > 0


def test_languages_of_odd_texts(spark):
    got = langid.languages(odd(spark)).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in got) == Counter((d, "und" if d in (1, 2, 3, 4) else "de") for d, _ in ODD)
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    untaught = odd(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in langid.languages(untaught).collect()} == {"und"}
    kept = langid.accepted(odd(spark), langid.model_of(odd(spark)))
    assert kept.columns == odd(spark).columns and kept.count() == len(ODD) - 4
    assert langid.languages(spark.createDataFrame([], ODD_SCHEMA)).collect() == []


def test_letter_junk_and_unlearned_languages_are_not_accepted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(3)
    junk = [(-1 - i, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)), "xx") for i, n in enumerate([20, 50, 200] * 20)]
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa"
    junk += [(-1000 - i, " ".join(rng.choice(polish.split()) for _ in range(n)), "pl") for i, n in enumerate([20, 50, 200] * 20)]
    model = langid.model_of(docs)
    asked = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    kept = {r.doc_id for r in langid.accepted(asked, model).select("doc_id").collect()}
    sure = {r.doc_id for r in langid.predicted(docs, langid.model_of(docs, spread=False)).where(langid.held_out() & (langid.F.col("score") >= 0.5)).collect()}
    assert sum(d < 0 for d in kept) <= 0.05 * len(junk) and len(sure & kept) >= 0.98 * len(sure) > 0


def test_unseen_words_back_off_to_shorter_grams():
    model = langid.Model(["a", "b"], {"tion": 0}, {"on>": 1, "n>": 2, "o": 3}, np.array([[0.0, -9.0], [-1.0, -3.0], [-4.0, -2.0], [-5.0, -5.0], [-8.0, -8.0]]))
    total, n = model.sums("tion on un 77")
    # "on": <o is unknown, so o; <on is unknown, then on... up to n: none; on> is known. "un": u and n are never seen, n> is.
    on = np.mean([[-5.0, -5.0], [-8.0, -8.0], [-1.0, -3.0]], axis=0)
    un = np.mean([[-8.0, -8.0], [-8.0, -8.0], [-4.0, -2.0]], axis=0)
    assert n == 3 and total.tolist() == pytest.approx((np.array([0.0, -9.0]) + on + un).tolist())


def brute_languages(docs):
    """Languages and scores from counts of all words and n-grams in memory."""
    words, grams = {}, {}
    for d, text, lang in docs:
        if d is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            for w in langid.words_of(text):
                if any(c.isalpha() for c in w):
                    words.setdefault(w, Counter())[lang] += 1
    langs = sorted({x for c in words.values() for x in c})
    for w, c in words.items():
        for i in range(2, len(w) + 3):
            for size in range(1, min(4, i) + 1):
                grams.setdefault(f"<{w}>"[i - size : i], Counter()).update(c)
    by_size = [words, *({g: c for g, c in grams.items() if len(g) == n} for n in range(1, 5))]
    under = [[sum(c[x] for c in part.values()) + 0.5 * (len(part) + 1) for x in langs] for part in by_size]
    log = lambda c, n: [math.log((c[x] + 0.5) / under[n][i]) for i, x in enumerate(langs)]
    rows = [log(c, 0) for c in words.values()] + [log(c, len(g)) for g, c in grams.items()]
    rows.append([math.log(0.5 / max(map(max, under)))] * len(langs))
    model = langid.Model(langs, {w: i for i, w in enumerate(words)}, {g: len(words) + i for i, g in enumerate(grams)}, np.array(rows))
    out = []
    for d, text, _ in docs:
        total, n = model.sums(text)
        out.append((d, langs[int(total.argmax())] if n else "und", float(1 / np.exp(total - total.max()).sum()) if n else 0.0))
    return out


def test_languages_count_each_text_once(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    apart = langid.predicted(docs, langid.model_of(docs, spread=False)).select("doc_id", "lang_pred", "score")
    expected = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in apart.collect()}
    seen, count = spark.sparkContext.accumulator(0), langid._count_words

    def watched(batches):
        def each():
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return count(each())

    monkeypatch.setattr(langid, "_count_words", watched)
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.languages(docs).collect()}
    assert got == expected and seen.value == docs.count()


@pytest.mark.parametrize("head", [2, 600, langid.HEAD])
def test_languages_equal_brute_force_whatever_the_head_holds(spark, head):
    rng, rows = random.Random(11), []
    alphabets = {"a": "abcde", "b": "cdefgh", "c": "éabzß日"}
    for i in range(300):
        lang = rng.choice("abc")
        letters = alphabets[lang]
        text = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 8)))
        rows.append((i, text + rng.choice(["", " 12 ", " unmet", " ½ x"]), rng.choice([lang, lang, lang, None])))
    rows += [(None, "abc zzz", "b"), (7, "abc", "c"), (900, None, "a"), (901, "", "a"), (902, "x" * 5000 + " " + "qv" * 3000, None), (903, "İSTANBUL ǅ", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predicted(docs.select("doc_id", "text"), langid.model_of(docs, spread=False, head=head)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for (d, lang, score), (d2, lang2, score2) in zip(sorted(map(tuple, got), key=key), sorted(brute_languages(rows), key=key), strict=True):
        assert d == d2 and score == pytest.approx(score2, abs=1e-9) and (lang == lang2 or score < 0.51)


def test_many_languages(spark):
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)} common", f"l{i:03}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.languages(docs).collect()
    learned = {f"l{i:03}" for i in range(600) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len(got) == 600 and {r.lang_pred for r in got} <= learned
    assert all(r.lang_pred == f"l{r.doc_id:03}" for r in got if not r.held_out)


# --- n-gram scores ---------------------------------------------------------------------------------------------


def brute_scores(docs):
    tokens = [(d, ngram.tokens(t)) for d, t in docs]
    train = [t for d, t in tokens if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    c, c2, c3 = (Counter(g for t in train for g in zip(*(t[i:] for i in range(n)), strict=False)) for n in (1, 2, 3))
    c = {k[0]: n for k, n in c.items()}
    total, distinct = sum(c.values()), len(c)
    c2 = {k: n for k, n in c2.items() if n > 1}
    c3 = {k: n for k, n in c3.items() if n > 1 and k[:2] in c2 and k[1:] in c2}
    used1, used2 = Counter(), Counter()
    for k, n in c2.items():
        used1[k[0]] += (n - ngram.DISCOUNT) / c[k[0]]
    for k, n in c3.items():
        used2[k[:2]] += (n - ngram.DISCOUNT) / c2[k[:2]]
    p1 = lambda w: (c.get(w, 0) + 1) / (total + distinct + 1)
    p2 = lambda a, w: ((c2[a, w] - ngram.DISCOUNT) / c[a] if (a, w) in c2 else 0) + (1 - used1[a]) * p1(w)
    p3 = lambda a, b, w: ((c3[a, b, w] - ngram.DISCOUNT) / c2[a, b] if (a, b, w) in c3 else 0) + (1 - used2[a, b]) * p2(b, w) if (a, b) in c2 else p2(b, w)
    out = []
    for d, t in tokens:
        score = sum(math.log10(p1(w) if i == 0 else p2(t[0], w) if i == 1 else p3(t[i - 2], t[i - 1], w)) for i, w in enumerate(t))
        out.append((d, len(t), sum(w in c for w in t), total, sum(math.log10(p1(w)) for w in t), score))
    return out


@pytest.mark.parametrize("vocabulary", [1 << 17, 12])
def test_scores_equal_brute_force(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(ngram, "VOCABULARY", vocabulary)
    rng = random.Random(11)
    words = ["the", "The", "of", "a", *(f"w{i}" for i in range(30))]
    docs = [(i, " ".join(rng.choice(words[: rng.choice([3, 34])]) for _ in range(rng.randint(0, 60)))) for i in range(120)] + [(d, (t or "")[:2000] if t else t) for d, t in ODD]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, word string")
    got = sorted(((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.held_out) for r in ngram.scores(frame).collect()), key=lambda r: (r[0], r[4]))
    expected = sorted(((d if d is not None else -1, *rest) for d, *rest in brute_scores(docs)), key=lambda r: (r[0], r[4]))
    for g, e in zip(got, expected, strict=True):
        assert g[:4] == tuple(e[:4]) and g[4] == pytest.approx(e[4])
        assert g[6] == (g[0] >= 0 and zlib.crc32(str(g[0]).encode()) % 7 == 2)
        if vocabulary > 100:  # quantised to 8 bits
            assert g[5] == pytest.approx(e[5], abs=0.02 * g[1])
    assert ngram.scores(spark.createDataFrame([], frame.schema)).collect() == []


def test_no_limit_holds_for_words_or_grams(spark, monkeypatch):
    """Contexts of rare words count: with the smallest parameters, scores are those of the whole corpus."""
    for name in ("VOCABULARY", "GRAMS", "BLOCK"):
        monkeypatch.setattr(ngram, name, 12, raising=False)
    rng = random.Random(5)
    docs = [(i, " ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 90)))) for i in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in ngram.scores(frame).collect()}
    for d, n, known, total, base, score in brute_scores(docs):
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (n, known, total)
        assert (got[d].base_score, got[d].score) == (pytest.approx(base), pytest.approx(score))


@pytest.mark.parametrize(("bits", "hot"), [(16, 6), (16, 300), (6, 1024), (6, 40)])
def test_scores_with_split_contexts_and_small_books(spark, bits, hot):
    """Contexts split over shards change nothing; codes of few bits are off by twice half a step a token at most."""
    rng = random.Random(3)
    words = ["the", *(f"w{i}" for i in range(60))]
    docs = [(i, " ".join("the" if rng.random() < 0.34 else rng.choice(words[: rng.choice([4, 61])]) for _ in range(rng.randint(0, 80)))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in ngram.scores(frame, bits=bits, hot=hot).collect()}
    total = got[0].train_tokens
    # What is given lies between (2 - 0.75) of a context's total and 1, what is left between 0.75 of it and 1.
    each = 0 if bits == 16 else 2 * ngram.off_by((1 - ngram.DISCOUNT) / total, 1, bits)
    if bits < 16:
        assert 0 < each < 0.1
    for d, n, known, _, base, score in brute_scores(docs):
        assert (got[d].n_tokens, got[d].n_known) == (n, known)
        assert got[d].base_score == pytest.approx(base) and got[d].score == pytest.approx(score, rel=1e-6, abs=each * n)


def test_trie_files_are_searched_within_contexts(tmp_path):
    rng = random.Random(8)
    for depth, size, ids in ((2, 0, 5), (2, 1, 5), (2, 900, 40), (3, 3000, 20), (3, 2000, 1 << 34)):
        grams = sorted({tuple(rng.choice([1, rng.randint(0, ids)]) for _ in range(depth)) for _ in range(size)})
        contexts = sorted({g[:-1] for g in grams})
        columns = [np.array([g[i] for g in grams], np.int64) for i in range(depth)]
        given, left = np.array([rng.random() + 1e-9 for _ in grams]), np.array([rng.random() + 1e-9 for _ in contexts])
        trie = ngram.Trie.read(ngram.Trie.write(ngram.Trie.built(columns, given, left, 16), f"file://{tmp_path}"))
        for held, numbers, absent in ((grams, given, 0.0), (contexts, left, 1.0)):
            places = {g: i for i, g in enumerate(held)}
            ask = held + [(*g[:-1], g[-1] + 1) for g in held] + [(g[0] + 1, *g[1:]) for g in held] + [tuple(rng.randint(0, ids + 2) for _ in range(depth - (held is contexts))) for _ in range(200)]
            rng.shuffle(ask)
            asked = [np.array(c, np.int64) for c in zip(*ask, strict=True)]
            assert trie.find(asked).tolist() == [places.get(g, -1) for g in ask]
            assert trie.numbers(asked).tolist() == [numbers[places[g]] if g in places else absent for g in ask]


def test_codes_are_off_by_half_a_step():
    values = 10 ** -np.random.default_rng(4).uniform(0, 7, 5000)
    for bits in (2, 8, 13):
        book, code = ngram._coded(values, bits)
        assert len(book) <= 1 << bits
        assert np.abs(np.log10(book[code]) - np.log10(values)).max() <= (ngram.off_by(values.min(), values.max(), bits) + 1e-12 if bits < 13 else 0)


def test_elias_fano_finds_what_it_holds():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1, 1 << 40), (5, 5), (1000, 1 << 37), (5000, 6000), (3000, 1 << 58)):
        values = np.unique(rng.integers(0, top, n))
        level = ngram.EliasFano(ngram.EliasFano.built(values))
        ask = np.concatenate((values, values + 1, values - 1, rng.integers(0, max(top, 2), 50), [-1, 0, top]))
        place = {v: i for i, v in enumerate(values.tolist())}
        assert level.find(ask).tolist() == [place.get(x, -1) for x in ask.tolist()]


def test_a_model_predicts_better_than_its_base(spark):
    rows = [r for r in catalogue.op7_ngram(spark, SF).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# --- quality ---------------------------------------------------------------------------------------------------


def test_quality_agrees_with_labels(spark):
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    kept = {r.doc_id: r.kept for r in catalogue.op9_quality(spark, SF).collect()}
    good = [kept[d] for d, q in labels if q == 1]
    bad = [kept[d] for d, q in labels if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_toxic_documents_of_good_form_are_caught(spark):
    labels = duckdb.sql(f"SELECT doc_id, toxic, lang FROM '{SF}/labels.parquet' JOIN '{SF}/documents.parquet' USING (doc_id)").fetchall()
    toxic = {r.doc_id: r.toxic for r in catalogue.op9_quality(spark, SF).collect()}
    # The other languages' toxic documents hold invented words only, which no lexicon has.
    bad = [toxic[d] for d, x, lang in labels if x == 1 and lang == "en"]
    clean = [toxic[d] for d, x, _ in labels if x == 0]
    assert sum(bad) >= 0.9 * len(bad) > 0 and sum(clean) <= 0.01 * len(clean)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = {r.doc_id for r in quality.accepted(docs, quality.model_of(docs), toxic=False).collect()}
    assert left and not any(toxic[d] for d in left)


def test_quality_of_odd_texts(spark):
    got = quality.quality(odd(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in ODD)
    assert all(r.score == 0 and not r.kept for r in got if r.doc_id in (1, 2, 3))
    bare = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r.kept for r in quality.quality(bare).collect()] == [False, False]
    assert quality.quality(spark.createDataFrame([], ODD_SCHEMA)).collect() == []


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.8
    accuracy = np.linspace(0.65, 0.95, quality.LABELLERS)
    right = rng.random((len(truth), quality.LABELLERS)) < accuracy
    votes = np.where(right == truth[:, None], quality.GOOD, quality.BAD)
    votes[rng.random(votes.shape) < 0.2] = quality.NONE
    keys = votes @ (3 ** np.arange(quality.LABELLERS)[::-1])
    posterior = quality.posteriors(Counter(keys.tolist()))
    guess = np.array([posterior[k] for k in keys.tolist()]) > 0.5
    assert (guess == truth).mean() > 0.97
    assert quality.posteriors({}) == {}
