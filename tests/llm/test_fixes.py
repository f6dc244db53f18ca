"""Links by content, doubles, whole bin completion, token ids of every letter, pipeline stages on odd rows."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from strata.llm import hpyp, imatch, mixing, packing, pii, pq, setjoin, stages, toxicity
from strata.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ------------------------------------------------------------------ Jaccard join
def _texts():
    a, b = ([f"{k}{i}" for i in range(60)] for k in "ab")
    return " ".join(a), " ".join(b), " ".join([*a[:-1], "x"]), " ".join([*b[:-1], "y"])


def test_an_id_on_two_texts_keeps_both_links(spark):
    a, b, a2, b2 = _texts()
    df = spark.createDataFrame([(1, a), (1, b), (2, a2), (3, b2), (4, "a lone text of six words"), (None, a)], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in setjoin.join(df).collect()}
    assert got == {(1, 57): 1, (2, 57): 1, (3, 57): 1, (4, 3): 4, (None, 57): None}


def test_near_duplicates_stage_goes_by_text(spark):
    a, b, a2, b2 = _texts()
    rows = [(1, a, "en", "s", 1), (1, "one of a kind " * 20, "en", "s", 2), (2, a2, "en", "s", 3), (3, b, "en", "s", 4), (5, b2, None, None, None), (5, b, "en", "s", 4),
            (7, "seen twice on one id in all its words", "en", "b", 1), (7, "seen twice on one id in all its words", "de", "a", 1), (8, None, "en", "s", 0), (8, "", "en", "s", 0), (None, a, "en", "s", 1)]
    out = stages.near_duplicates(spark, spark.createDataFrame(rows, DOCS), "")
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")]
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([rows[0], rows[1], rows[3], rows[7], rows[8], rows[9], rows[10]], key=str)
    assert stages.near_duplicates(spark, spark.createDataFrame([], DOCS), "").count() == 0


# ------------------------------------------------------------------ product quantisation
def test_vectors_stay_doubles(spark):
    def turned(cosine):
        v = np.zeros(16)
        v[0], v[1] = cosine, math.sqrt(1 - cosine * cosine)
        return v.tolist()

    base = [1.0] + [0.0] * 15
    rows = [(1, base, 1), (2, turned(0.98 + 1e-10), 1), (3, base, 2), (4, turned(0.98 - 1e-10), 2), (5, [1e200] * 16, 3), (6, [1e200] * 16, 3), (7, [2e200] * 16, 3), (8, [1e-200] * 16, 3)]
    p = pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).toPandas().set_index("vec_id")
    assert p.n_links.loc[[1, 2, 3, 4]].tolist() == [1, 1, 0, 0]
    assert p.n_links.loc[[5, 6, 7, 8]].tolist() == [3] * 4 and p.component_id.loc[[5, 6, 7, 8]].tolist() == [5] * 4


# ------------------------------------------------------------------ packing
def test_fillings_of_three_pieces_are_offered():
    found, _ = packing.fillings(packing._Left([20, 15, 15, 15], 60), 45, 60, 256)
    assert found == [(0, (15, 15, 15)), (10, (20, 15))]
    assert packing.fillings(packing._Left([20, 15, 15, 15], 60), 45, 5, 256)[0] == [(0, (15, 15, 15))]
    assert packing.fillings(packing._Left([9, 5, 4, 3], 20), 9, 20, 256)[0] == [(0, (9,))]
    assert packing.fillings(packing._Left([], 60), 45, 60, 256)[0] == [(45, ())]


def _perfect(rng, bins, capacity, lo, hi):
    cuts = [np.sort(rng.choice(np.arange(1, capacity), rng.integers(lo, hi + 1) - 1, replace=False)) for _ in range(bins)]
    return [int(x) for c in cuts for x in np.diff([0, *c, capacity])]


def test_perfect_instances_are_packed_perfectly():
    rng, fit = np.random.default_rng(1), 0
    for _ in range(100):
        sizes = _perfect(rng, 8, 100, 2, 5)
        bins = packing.bin_completion(sizes, 100)
        assert len(bins) == 8 and sorted(x for b in bins for x in b) == sorted(sizes) and max(map(sum, bins)) <= 100
        fit += len(packing.best_fit_decreasing(sizes, 100)) == 8
    assert fit < 50


def test_large_instances_take_fewer_than_best_fit():
    rng = np.random.default_rng(4)
    sizes = [_perfect(rng, 60, 2048, 3, 8) for _ in range(5)]
    assert [len(packing.bin_completion(s, 2048)) for s in sizes] == [60] * 5
    assert sum(len(packing.best_fit_decreasing(s, 2048)) for s in sizes) > 300


def test_ids_of_every_letter():
    ids = packing._Ids(packing.tokenizer_json())
    for c in [*range(33, 0x600), *range(0x1E00, 0x2200), 0x212A, 0x4E2D, 0xAC00, 0x1F642, 0x10400]:
        for w in (chr(c), f"a{chr(c)}b", f"{chr(c)}stanbul,"):
            if len(w.encode().split()) == 1:
                want = ids.whole.encode(w, add_special_tokens=False).ids
                assert ids._word(w.encode()) == np.array(want, "<u4").tobytes(), hex(c)


# ------------------------------------------------------------------ stages
ODD = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "x y " * 30, "en", "a", 120), (2, "x y " * 30, "en", "a", 120), (3, "one two three", None, "b", 13), (4, "word " * 5000, "de", "c", 25_000)]


@pytest.mark.parametrize("name", ["near_duplicates", "pii", "mixing", "packing"])
def test_stages_on_odd_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    extra = spark.createDataFrame([(*r, 1, 2.0) for r in ODD], DOCS + ", mix_pass int, score double")
    bare = spark.createDataFrame(ODD, DOCS).drop("n_chars")
    for df in (extra, bare):
        out = stage(spark, df, "")
        if name != "packing":
            assert out.columns == df.columns
        assert out.count() >= 4
        if name == "mixing":
            assert "mix_pass" not in df.columns or {r.mix_pass for r in out.select("mix_pass").collect()} == {1}
        assert stage(spark, df.limit(0), "").count() == 0


def test_stages_follow_the_order_of_the_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]


def test_surrogates_stage_keeps_n_chars_true(spark):
    df = spark.createDataFrame([(1, "write to anna.smith@mail.com now", "en", "s", 32), (2, "nothing here", "en", "s", 12)], DOCS)
    out = stages.surrogates(spark, df, "").orderBy("doc_id").collect()
    assert out[1].text == "nothing here" and all(r.n_chars == len(r.text) for r in out) and "anna" not in out[0].text


# ------------------------------------------------------------------ Pitman-Yor model
def test_predictions_add_up_to_one():
    """Two buckets of words: with the sums of the same sweep, each context's probabilities of
    all known words and the unknown one add up to 1."""
    rng = np.random.default_rng(6)
    words, contexts = 40, 12
    count = rng.poisson(1.5, (words, contexts)) * (rng.random((words, contexts)) < 0.7)
    rows = []
    for k in range(2):
        mine = [w for w in range(k, words, 2) if count[w].any()]
        ctx = [np.flatnonzero(count[w]) for w in mine]
        columns = (mine, [len(c) for c in ctx], np.concatenate(ctx), np.concatenate([count[w][c] for w, c in zip(mine, ctx, strict=True)]), [], [], [])
        rows.append({f: hpyp._pack(np.array(x).astype(t)) for f, t, x in zip(hpyp._FIELDS, hpyp._TYPES, columns, strict=True)} | {"bucket": k})

    def shared(seats):
        cust, tabs = np.zeros(contexts), np.zeros(contexts)
        for s in seats:
            cust += np.bincount(s.ctx, s.count, contexts)
            tabs += np.bincount(s.ctx, s.tables, contexts)
        known = sum(len(s.words) for s in seats)
        root = sum(s.root().sum() for s in seats)
        tables = sum((s.root_tables if s.root_tables is not None else np.minimum(s.root(), 1)).sum() for s in seats)
        return hpyp.Shared(cust, tabs, known, int(count.sum()), root, tables, 0.7, 0.6)

    seats = [hpyp.Seating(r) for r in rows]
    state = shared(seats)
    for turn in range(4):
        for s in seats:
            s.sweep(state, turn)
        state = shared(seats)
        total, root = np.zeros(contexts), np.zeros(contexts)
        for s in seats:
            total += np.bincount(s.ctx, s.predict(state), contexts)
            p = s.root_prob(state, s.root_tables)
            root += p.sum() - np.bincount(s.ctx, p[s.word], contexts)  # words not seen in the context
        back = (state.strength + state.discount * state.tables[:contexts]) / (state.strength + state.customers[:contexts])
        unknown = (state.strength + state.root_discount * state.root_tables) / (state.known + 1) / (state.strength + state.root_customers)
        assert np.allclose(total + back * (root + unknown), 1, atol=1e-9)


def test_contexts_are_whole_and_sums_meet_across_buckets(spark):
    """The same seatings made in one place, with the totals of every context in one array."""
    rng = np.random.default_rng(11)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocab, 40, p=(q := 1 / np.arange(1, 301)) / q.sum())) for _ in range(120)] + ["", None, "unseen words only here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = hpyp.score(df).toPandas().set_index("doc_id")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row, tok, ctx, _ = hpyp._tokens(pa.array(texts, pa.string()))
    out = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))])
    contexts, ctx_at = np.unique(ctx, return_inverse=True)
    seats, pair_of = [], {}
    for k in range(buckets):
        seen = sorted({(int(t), int(c)) for t, c in zip(tok, ctx, strict=True) if t % np.uint64(buckets) == k})
        if not seen:
            continue
        for i, x in enumerate(seen):
            pair_of[x] = (len(seats), i)
        count = np.zeros(len(seen), int)
        for t, c, r in zip(tok.tolist(), ctx.tolist(), row.tolist(), strict=True):
            if (t, c) in pair_of and pair_of[t, c][0] == len(seats) and not out[r]:
                count[pair_of[t, c][1]] += 1
        own = np.array([t for t, _ in seen], np.uint64)
        at = np.searchsorted(contexts, np.array([c for _, c in seen], np.uint64))
        columns = (np.unique(own), np.unique(own, return_counts=True)[1], at, count, np.ones(len(seen)), [], [])
        seats.append(hpyp.Seating({f: hpyp._pack(np.array(x).astype(t)) for f, t, x in zip(hpyp._FIELDS, hpyp._TYPES, columns, strict=True)} | {"bucket": k}))

    def shared(d, rd):
        cust, tabs = (sum(np.bincount(s.ctx, x(s), len(contexts)) for s in seats) for x in (lambda s: s.count, lambda s: s.tables))
        root = sum(s.root().sum() for s in seats)
        tables = sum((np.minimum(s.root(), 1) if s.root_tables is None else s.root_tables).sum() for s in seats)
        return hpyp.Shared(cust, tabs, sum(int((s.train > 0).sum()) for s in seats), int(sum(s.count.sum() for s in seats)), root, tables, d, rd)

    once = [sum(int((x(s) == n).sum()) for s in seats) for x in (lambda s: s.count, lambda s: s.root()) for n in (1, 2)]
    d, rd = (min(0.95, max(0.05, a / (a + 2 * b))) if a else 0.5 for a, b in (once[:2], once[2:]))
    state, p = shared(d, rd), [0.0] * len(seats)
    for turn in range(3):
        for s in seats:
            s.sweep(state, turn)
        state = shared(d, rd)
        if turn:
            p = [a + s.predict(state) / 2 for a, s in zip(p, seats, strict=True)]
    want = np.zeros(len(texts))
    for t, c, r in zip(tok.tolist(), ctx.tolist(), row.tolist(), strict=True):
        b, i = pair_of[t, c]
        want[r] += math.log10(p[b][i])
    assert len(seats) > 1 and np.allclose(got.score.loc[range(len(texts))], want, rtol=0, atol=1e-9)
    assert got.held_out.loc[range(len(texts))].tolist() == out.tolist()


# ------------------------------------------------------------------ surrogates
def _replaced(spark, *texts, key=None):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.text for r in pii.replace(df, key=key).orderBy("i").collect()]


def test_spellings_of_one_number_are_one_entity(spark):
    (t,) = _replaced(spark, "4111 1111 1111 1111, 4111111111111111, 4111-1111-1111-1111; +49 30 1234567, +49-30-1234567, +49 (30) 1234567; DE89370400440532013000 DE89 3704 0044 0532 0130 00")
    cards, phones, ibans = t.split("; ")
    digits = [re.sub("[^0-9]", "", c) for c in cards.split(", ")]
    assert len(set(digits)) == 1 and digits[0] != "4" + "1" * 15 and [len(c) for c in cards.split(", ")] == [19, 16, 19]
    assert sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[0])) % 10 == 0
    phones = phones.split(", ")
    assert len({re.sub("[^0-9+]", "", p) for p in phones}) == 1 and all(p.startswith("+49") for p in phones)
    assert [re.sub("[0-9]", "9", p) for p in phones] == ["+99 99 9999999", "+99-99-9999999", "+99 (99) 9999999"] and "1234567" not in t
    whole, spaced = ibans[:22], ibans[23:]
    assert spaced.replace(" ", "") == whole != "DE89370400440532013000" and spaced[4] == " " and whole.startswith("DE")
    assert int("".join(str(int(c, 36)) for c in whole[4:] + whole[:4])) % 97 == 1


def test_names_are_bound_in_their_text(spark):
    one, other = _replaced(spark, "Mrs. Anna Smith came, then Anna Smith left; Smithson stayed, as did Smith.", "Smith is a smith, Anna is not.")
    given, surname = re.match(r"Mrs\. (\S+) (\S+) came", one).groups()
    assert one == f"Mrs. {given} {surname} came, then {given} {surname} left; Smithson stayed, as did {surname}." and "Anna" not in one
    assert other == "Smith is a smith, Anna is not."


def test_addresses(spark):
    a, b, c = _replaced(spark, "Anna.Smith@Mail.com and anna.smith@mail.com", "at 2001:db8:85a3:0:0:8a2e:370:7334 or fe80::1ff:fe23:4567:890a", "12:30:45, a::b is c++, 1:2")
    first, second = a.split(" and ")
    assert first == second and re.fullmatch(r"\w+\.\w+@\w+\.com", first) and "anna" not in second
    assert re.fullmatch(r"at [0-9a-f:]+ or [0-9a-f:]+", b) and "8a2e" not in b and "fe23" not in b
    assert c.startswith("12:30:45, ") and c.endswith(" is c++, 1:2")


def test_the_key_comes_from_outside(spark):
    text = "write to anna.smith@mail.com"
    default, mine = _replaced(spark, text)[0], _replaced(spark, text, key="k")[0]
    spark.conf.set(pii.KEY_CONF, "k")
    try:
        assert _replaced(spark, text)[0] == mine != default
    finally:
        spark.conf.unset(pii.KEY_CONF)


# ------------------------------------------------------------------ I-Match
def _xx(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed & (1 << 64) - 1)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def _terms(text):
    return {_xx(w.strip(".,;:!?\"'()[]").encode()) for w in re.split(r"[ \t-\r]+", text.lower())}


def _imatch(texts, fewest, most):
    """Lexicon and fingerprints by the definition, a text at a time."""
    df_of = {}
    for t in texts:
        for h in _terms(t):
            df_of[h] = df_of.get(h, 0) + 1
    lex = {h for h, c in df_of.items() if fewest * len(texts) <= c <= max(1.0, most * len(texts))}
    return lex, _by_lexicon(texts, lex)


def _by_lexicon(texts, lex):
    def hashed(t):
        ts = _terms(t)
        some, out = sorted(_xx(h.to_bytes(8, "little", signed=True), (7).to_bytes(4, "little")) for h in (ts & lex or ts)), []
        for level in range(imatch.LEVELS):
            if level:
                some = [h for h in some if h >> 2 * (level - 1) & 3 == 0]
            cells = [[h for h in some if (h >> 24) % imatch.CELLS == c] for c in range(imatch.CELLS)]
            out += [_xx(*[h.to_bytes(8, "little", signed=True) for h in c]) if c else 0 for c in cells]
        return out

    return [hashed(t) for t in texts]


def _alike(a, b):
    first = next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x == y == 0), 0)
    for start in (first // imatch.CELLS * imatch.CELLS, 0):
        pairs = [(x, y) for x, y in zip(a[start:], b[start:], strict=True) if x or y]
        if pairs:
            return sum(x == y for x, y in pairs) / len(pairs)
    return 1.0


def test_imatch_against_the_definition(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    local = sorted(map(tuple, df.collect()))
    texts = [t or "" for _, t in local]
    lex, fps = _imatch(texts, 0.02, 0.2)
    assert {h for g in imatch.lexicon(df, "text", 0.02, 0.2) for h in g} == lex and len(lex) > 100
    got = sorted(imatch.fingerprints(df, fewest=0.02, most=0.2).collect(), key=lambda r: r.doc_id)
    shown = lambda fp: "".join(f"{h & 0xFFFFFFFF:08x}" for h in fp)
    assert [r.fingerprint for r in got] == [shown(fp) for fp in fps]
    after = texts[1:] + texts[:1]
    changed = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, after, strict=True)]
    assert np.allclose([r.near_next for r in got], [_alike(a, b) for a, b in zip(fps, fps[1:] + fps[:1], strict=True)])
    edited = _by_lexicon(changed, lex)
    assert [r.edited_fingerprint for r in got] == [shown(fp) for fp in edited]
    assert np.allclose([r.near_edited for r in got], [_alike(a, b) for a, b in zip(fps, edited, strict=True)])


def test_imatch_next_rows_over_many_ranges(spark):
    rows = [(None, "first of all"), (3, "c d e"), (3, "a b"), (9, ""), (1, None), (7, "x " * 50), (5, "c d e")]
    d = spark.createDataFrame(rows, "doc_id long, text string").fillna("", "text")
    got = {(r.doc_id, r.text): r.next_text for r in imatch.with_next(d, lambda t: imatch.fingerprint(t, [[]]), range_bytes=8).collect()}
    order = [(None, "first of all"), (1, ""), (3, "a b"), (3, "c d e"), (5, "c d e"), (7, "x " * 50), (9, "")]
    assert got == {k: n[1] for k, n in zip(order, order[1:] + order[:1], strict=True)}


# ------------------------------------------------------------------ budgets and training
def test_mixing_refuses_a_budget_beyond_the_limit(spark):
    df = spark.createDataFrame([(i, "a b c d", "x" if i % 4 else "y") for i in range(40)], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="more than 3 times"):
        mixing.mix(df, budget=481, max_repeats=3.0)
    full = mixing.mix(df, budget=480, target_entropy=None, max_repeats=3.0).groupBy("doc_id").count().collect()
    assert [r["count"] for r in full] == [3] * 40  # three times the corpus: every document thrice
    assert mixing.mix(df.limit(0), budget=10).count() == 0


def test_toxicity_learns_the_same_from_any_layout(spark):
    words = np.random.default_rng(5).integers(0, 300, (200, 30))
    rows = [(i, " ".join([*(f"w{k}" for k in words[i]), "vile" if i % 2 else "mild"]), "x") for i in range(200)]
    docs = spark.createDataFrame([*rows, *rows[:9], (None, "vile", "x"), (900, None, "x"), (901, "", "x")], "doc_id long, text string, y string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(900, 1), (901, 0), (3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    one, many = toxicity.train(docs.coalesce(1), lab), toxicity.train(docs.orderBy(docs.text.desc()).repartition(7), lab)
    got, again = ({(r.doc_id, r.text): r.score for r in _scored(docs, m)} for m in (one, many))
    assert got == again and len(got) == 203
    wrong = [(i, t, s) for (i, t), s in got.items() if i is not None and i < 200 and (s >= 0.5) != (i % 2 == 1)]
    assert not wrong
    assert toxicity.train(docs, lab.filter("toxic = 1")) is None and toxicity.train(docs.limit(0), lab) is None
    assert toxicity.train(docs.filter("doc_id % 2 = 0"), lab) is None


def _scored(docs, model):
    out = toxicity.score(docs, model).select("doc_id", "score").distinct()
    return out.join(docs.select("doc_id", "text").distinct(), out.doc_id.eqNullSafe(docs.doc_id)).select(out.doc_id, "text", "score").collect()
