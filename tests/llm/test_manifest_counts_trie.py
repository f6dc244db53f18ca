"""Merkle manifest, token counts and prefix trie: against plain Python and DuckDB, and on odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pandas as pd
import pytest

from strata.llm import merkle, tokencount, trie

SF_SMALL = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------ manifest
def plain_manifest(rows, fanout=2):
    """rows: (doc_id, text, lang, source, n_chars)."""

    def leaf(i, text, lang, source, n):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])

    def tree(digests):
        paths, at, nodes = [[] for _ in digests], list(range(len(digests))), digests
        while len(nodes) > 1:
            for i, p in enumerate(at):
                run = nodes[p - p % fanout : p - p % fanout + fanout]
                paths[i].append((run[: p % fanout], run[p % fanout + 1 :]))
            nodes = [sha(*nodes[j : j + fanout]) for j in range(0, len(nodes), fanout)]
            at = [p // fanout for p in at]
        return nodes[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    root, tops = tree([trees[g][0] for g in langs])
    out = []
    for g, top in zip(langs, tops, strict=True):
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1], strict=True):
            i, text, lang, source, n = x[3]
            bent = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
            d = leaf(i, text, lang, source, n + 1) if bent else x[2]
            for left, right in path + top:
                d = sha(*left, d, *right)
            out.append((i, x[2], trees[g][0], root, sha(*[s for a, b in path + top for s in a + b]), d, d == root))
    return sorted(out, key=str)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(None, None, None, None, None), (None, "a", "en", "s", 1), (3, "", "", "", 0), (3, "", "", "", 0), (4, "ü" * 50_000, "Ä", "z", 7), (9, None, "de", None, None)]


def test_manifest_is_the_plain_tree(spark):
    rows = ODD + [(i, f"text {i}", ["en", "de", None, "en"][i % 4] if i < 700 else f"l{i}", "s", i) for i in range(720)]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], DOCS + ", __pos long, leaf long")
    for fanout in (2, 3):
        assert sorted(map(tuple, merkle.manifest(df, fanout).collect()), key=str) == plain_manifest(rows, fanout)


def test_manifest_of_one_and_of_none(spark):
    one = merkle.manifest(spark.createDataFrame([(1, "t", "en", "s", 1)], DOCS)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("") and one.verified
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0


# ------------------------------------------------------------------ token counts
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokencount.tokenizer_json())


def test_pattern_agrees_with_the_library_on_plain_blocks(library):
    find = tokencount.regex.compile(tokencount.PATTERN).finditer
    for lo, hi in tokencount.BLOCKS:
        for c in map(chr, range(lo, hi + 1)):
            x = f"a{c} 1{c} .{c}{c} {c}b"
            assert [e for _, (_, e) in library.pre_tokenizer.pre_tokenize_str(x)] == [m.end() for m in find(x)], hex(ord(c))


def test_counts_of_odd_texts(library, monkeypatch):
    monkeypatch.setattr(tokencount, "CHUNK", 7)  # many parts
    table = tokencount.Lengths({"ab": 1, " a": 1, "nonsense": 99})
    assert (table.get("ab"), table.get("nonsense"), table.get("a")) == (1, 99, None)
    counts, rng = tokencount.Counts(tokencount.tokenizer_json(), tokencount.Lengths({"ab": 1, " a": 1}), most=50), random.Random(3)
    some = [*"ab1.'s  \n\t\r", "　", "é", "中", "🙂", "́", " ", " ", "ǆ", "\U00010d40", "՘", "𝐀", "<|endoftext|>", "'ll", "한"]
    for _ in range(3000):
        x = "".join(rng.choice(some) for _ in range(rng.randint(0, 30)))
        assert counts.of(x) == len(library.encode(x, add_special_tokens=False).ids), repr(x)


def test_counts_query(spark, library):
    odd = [(None, None), (None, "a b"), (1, ""), (2, "x y "), (2, "x y "), (3, "z" * 100_000 + " y"), (4, "<|endoftext|> " * 3), (5, "w " * 513), (6, "🙂 中 \n")]
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = spark.createDataFrame([(*r, 1, "n") for r in odd + real], "doc_id long, text string, n_tokens int, n_bytes string")
    got = sorted(map(tuple, tokencount.count_tokens(df, table_size=500, sample_docs=20).collect()), key=str)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in odd + real]
    assert got == sorted([(*w, w[2] > 512) for w in want], key=str)
    assert tokencount.count_tokens(df.limit(0)).count() == 0


def test_frequent_pretokens_save_encodings(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    spec = spark.sparkContext.broadcast(tokencount.tokenizer_json())
    texts = [r.text for r in docs.collect()]
    plain, tiered = tokencount.Counts(spec.value), tokencount.Counts(spec.value, tokencount.frequent(docs, spec, 1000, 65536, 64))
    assert [plain.of(t) for t in texts] == [tiered.of(t) for t in texts]
    assert tiered.misses < plain.misses / 50


# ------------------------------------------------------------------ trie
def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        turns = convs.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
        up = min(members[k[:-1]]) if k else None
        out.append((min(members[k]), len(k), up, len(members[k]), len(kids[k]), leaves[k], saved[k], sha(",".join(map(str, sorted(ends[k]))))))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("parts", [1, 9])
def test_trie_is_the_plain_trie(spark, monkeypatch, parts):
    monkeypatch.setattr(trie, "FAN", 3)
    rng, rows = random.Random(5), [(None, 1, "u", "x"), (7, None, None, None), (7, None, None, None)]
    for c in [*range(300), -5, -105, 1000, 1099]:
        for t in range(rng.choice([0, 1, 2, 3, 4, 5, 7])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]) if rng.random() < 0.1 else "u", rng.choice(["x", "y", "", "héé", None]) if rng.random() < 0.5 else "x"))
    rows += [(2000 + k, t, "u", "x") for k in range(3) for t in range(100 * k + 150)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], TURNS + ", depth int, key string")
    assert sorted(map(tuple, trie.nodes(df, parts).collect()), key=str) == plain_trie(rows)


def test_trie_of_copies_and_of_none(spark):
    rows = [(c, t, "u", str(t)) for c in range(6, 3000) for t in range(7)]
    assert sorted(map(tuple, trie.nodes(spark.createDataFrame(rows, TURNS), 16).collect()), key=str) == plain_trie(rows)
    assert trie.nodes(spark.createDataFrame([], TURNS)).count() == 0


@pytest.mark.parametrize("op,table", [(merkle, "documents"), (trie, "conversations")])
def test_sql_states_the_same_rows(spark, op, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    want = con.execute(op.ORACLE).df()
    got = (merkle.manifest if op is merkle else trie.nodes)(spark.read.parquet(f"{SF_SMALL}/{table}.parquet")).toPandas()[list(want.columns)]
    key = list(want.columns)
    same = [d.sort_values(key).reset_index(drop=True) for d in (got, want)]
    pd.testing.assert_frame_equal(*same, check_dtype=False)
