"""Operators 8, 9 and 10 against brute force, and their defined cases."""

import hashlib
import os
import random
import re
import time

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderstream.llm import bpe, decontaminate, exact_dedup, queries

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, values, schema="doc_id long, text string, hash string, kept int"):
    return spark.createDataFrame([(*v, *[None] * (schema.count(",") + 1 - len(v))) for v in values], schema)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF01)
    want = con.execute(queries.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.select(columns)) == sorted(want.fetchall(), key=repr)


# ---- exact dedup ---------------------------------------------------------------

COPIES = [(1, "a"), (2, None), (3, "a"), (4, ""), (5, "b" * 300_000), (5, "b" * 300_000), (None, "c"), (7, "c"), (8, "A")]


def brute_groups(values, pick):
    groups = {}
    for i, t in values:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in values:
        ids = groups[t or ""]
        keep = pick(x for x in ids if x is not None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, keep, weak):
    digest = (lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)) if weak else exact_dedup.md5_128  # 16 values: collisions
    values = COPIES + [(100 + i, f"t{i % 23}") for i in range(60)]
    for floor in (50_000, 2):  # 2: the rows of most groups are spread
        got = exact_dedup.group_report(frame(spark, values), keep=keep, digest=digest, floor=floor)
        assert rows(got) == brute_groups(values, {"min": min, "max": max}[keep])


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    df = frame(spark, COPIES)
    kept = exact_dedup.deduplicate(df, keep="min")
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 7, 8]
    empty = df.where("false")
    assert exact_dedup.deduplicate(empty).count() == 0 and exact_dedup.group_report(empty).count() == 0


# ---- decontamination ------------------------------------------------------------

def brute_leaks(text, items, window):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit, names = set(), set()
    for item, t in items:
        iw = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        m = min(window, len(iw))
        for k in range(len(iw) - m + 1) if m else ():
            for i in range(len(w) - m + 1):
                if w[i:i + m] == iw[k:k + m]:
                    hit.update(range(i, i + m))
                    if item is not None:
                        names.add(str(item))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block_chars", [10**6, 30])
@pytest.mark.parametrize("window", [1, 2, 4, 10])
def test_leaks_equal_brute_force(spark, window, block_chars):
    rnd = random.Random(window)
    word = lambda: rnd.choice(["a", "B", "é", "cc", "9", "Ünd", "x-y"])
    items = [(i, " ".join(word() for _ in range(rnd.randint(0, 14)))) for i in range(9)] + [(None, "a B"), (20, None), (3, "a b")]
    docs = [(i, " ".join(word() for _ in range(rnd.randint(0, 60)))) for i in range(25)] + [(90, None), (91, ""), (92, "!? "), (1, "a b"), (1, "a b")]
    got = decontaminate.find_contamination(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"),
                                           window=window, block_chars=block_chars)
    mine = sorted((r.doc_id, r.n_words, sum(h.end - h.start for h in r.hits), list(r["items"])) for r in got.collect())
    assert mine == sorted((i, *brute_leaks(t, items, window)) for i, t in docs)


def test_long_text_in_pieces():
    items = [("i", b"one two three four five six seven eight nine ten eleven")]
    searchers = decontaminate.compile_items(items, 10)
    text = b"zz " * 50 + items[0][1] + b" yy" * 50
    whole = decontaminate.scan(text, searchers, 10)
    for size in (1, 7, 31, 64):
        assert decontaminate.scan(text, searchers, 10, piece=size) == whole
    assert whole[0] == 111 and whole[1] == [[50, 61]]


def test_no_benchmark(spark):
    got = decontaminate.find_contamination(frame(spark, [(1, "a b c")]), spark.createDataFrame([], "item_id long, text string"))
    assert [tuple(r) for r in got.collect()] == [(1, 3, [], [])]


# ---- BPE -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(queries.BPE_FILE))
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_library_on_odd_texts(library):
    with open(public_tokenizers.path(queries.BPE_FILE), encoding="utf-8") as f:
        encoder = bpe.read_encoder(f.read())
    encoder.words.most = 50  # forgetting must not change results
    pool = "aAbéÉßΣσςİı 0129²½Ⅷ　\n\t\x1c\x85'stre!?#<|startoftext|><|endoftext|>é漢字한👍🏽ﬁŁ"
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    texts += ["", " ", "<|endoftext|>", "x<|startoftext|>'s", "a" * 30_000, "ΟΔΟΣ ΟΔΟΣ"]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = encoder.encode(t)
        assert got == " ".join(map(str, want)), t
        assert encoder.decode(got) == library.decode(want, skip_special_tokens=False), t


def test_bpe_cuts_are_certain():
    with open(public_tokenizers.path(queries.BPE_FILE), encoding="utf-8") as f:
        e = bpe.read_encoder(f.read())
    for word in ("unzweifelhaft", "qxzjk", "antidisestablishment", "þorsteinn"):
        s = [e.letters[b] for b in word.encode()]
        s[-1] += bpe.MARK
        assert e.word(word) == e.merge(tuple(s))  # merging without any cut


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in queries.op9_bpe(spark, SF001).collect()}
    docs = spark.read.parquet(os.path.join(SF001, "documents.parquet")).collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_null_empty_and_no_rows(spark):
    df = frame(spark, [(1, None), (2, ""), (3, "Hello")])
    got = {r.doc_id: (list(r.ids), r.decoded) for r in bpe.encode(df, public_tokenizers.path(queries.BPE_FILE)).collect()}
    assert got[1] == got[2] == ([], "") and got[3][1] == "hello</w>"
    assert bpe.encode(df.where("false"), public_tokenizers.path(queries.BPE_FILE)).count() == 0


@pytest.mark.parametrize("block_chars", [10**6, 5])
def test_drop_contaminated(spark, block_chars):
    df = frame(spark, [(1, "x a b c y"), (2, None), (3, "a b"), (4, "q q"), (4, "q q")])
    items = spark.createDataFrame([(1, "A b c"), (2, "q r"), (3, None)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(df, items, window=10, block_chars=block_chars)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 4]


def test_long_unbroken_words():
    """Irregular characters without a break: equal to the library, and in seconds at 200,000."""
    path = public_tokenizers.path(queries.BPE_FILE)
    with open(path, encoding="utf-8") as f:
        encoder = bpe.read_encoder(f.read())
    library, rnd = Tokenizer.from_file(path), random.Random(9)
    library.no_truncation()
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "etaoinsrhé"):
        for n in (bpe.SHORT - 1, bpe.SHORT + 2, 300, 20_000):
            word = "".join(rnd.choice(letters) for _ in range(n))
            assert encoder.encode(word) == " ".join(map(str, library.encode(word, add_special_tokens=False).ids))
    begun = time.process_time()
    encoder.encode("".join(rnd.choice("etaoinsr") for _ in range(200_000)))
    assert time.process_time() - begun < 30
    assert all(len(w) <= bpe.LONG for w in encoder.words) and all(len(w) <= bpe.LONG for w in encoder.fragments)
