"""Phrases, packing and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from msgflow.llm import collocations, configurations, packing, periodic_runs
from msgflow.llm.queries import QUERIES
from msgflow.session import ship_package

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def ship(spark):
    ship_package(spark)


def store(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# Periodic runs -----------------------------------------------------------------


def plain_runs(words, exponent=4, least=6):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def codes_of(texts):
    return np.array([x for t in texts for x in t], dtype=np.int32), [len(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=6), max_size=4))
def test_runs_equal_the_plain_search(texts):
    texts = [[x for unit, times in t for x in unit * times] for t in texts]
    want, start = [], 0
    for t in texts:
        want += [(start + s, n, q) for s, n, q in plain_runs(t)]
        start += len(t)
    assert periodic_runs.Catchers().runs(*codes_of(texts)) == want


def test_runs_of_a_very_long_text_stay_few_steps(monkeypatch):
    calls = []
    agree = periodic_runs._agree
    monkeypatch.setattr(periodic_runs, "_agree", lambda *a: calls.append(1) or agree(*a))
    n = 1 << 18
    assert periodic_runs.Catchers().runs(np.zeros(n, dtype=np.int32), [n]) == [(0, n, 1)]
    assert len(calls) == 1
    with pytest.raises(ValueError, match="four periods"):
        periodic_runs.Catchers(exponent=3)


def plain_row(doc_id, text):
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join("%d,%d,%d\n" % r for r in runs)
    kept = " ".join(words[i] for i in range(n) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(listed), digest(kept))


def test_runs_query(spark, tmp_path):
    rnd = random.Random(3)
    texts = [None, "", " \n\t", "a a a a a a", "x " * 70, "one two\x0bthree\x0cfour\rfive", "é è é è é è é è é è", "a b " * 9]
    for _ in range(60):
        unit = [rnd.choice("abcde") for _ in range(rnd.randint(1, 12))]
        texts.append(" ".join(rnd.choices("abcdef", k=rnd.randint(0, 40)) + unit * rnd.randint(1, 9) + rnd.choices("ab", k=rnd.randint(0, 20))))
    texts.append(" ".join(rnd.choices(["a", "b", "c"], k=3000)) + " tick tock" * 4000)
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 1)] * 2 + [(None, "b b b b b b", None, None, None)]
    got = Counter(map(tuple, QUERIES["op13_periodic_runs"](spark, store(spark, tmp_path, rows)).collect()))
    small = [r for r in rows if len(r[1] or "") < 20_000]
    want = Counter(plain_row(r[0], r[1]) for r in small)
    assert {k: v for k, v in got.items() if k[0] != len(texts) - 1} == want
    (long,) = [k for k in got if k[0] == len(texts) - 1]
    assert long[3] >= 8000 and long[4] == 2


def test_runs_keep_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "z z z z z z z", "mine")], "doc_id long, text string, runs string")
    out = periodic_runs.periodic_runs(docs, ["doc_id", "runs"]).first()
    assert [tuple(r) for r in out.runs] == [(0, 7, 1)] and out.collapsed == "z" and out.n_words == 7
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# Packing -----------------------------------------------------------------------


VOCABULARY = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


def plain_ids(texts):
    tokenizer = Tokenizer.from_str(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


TRICKY = [
    None, "", " ", "Hello, World... it's DON'T can't. we'll!", "été T̈ J̌ W̊ ÉTÉ été.", "a b   c\x1cd\x85e",
    "<|endoftext|> <|startoftext|>x", "x" * 5000, "日本語 テキスト。 and русский, Ελληνικά ΣΑΣ.", "1234 5,678.90 a.b.c ... ?!", "tab\tnew\nline\r\x0b\x0c end",
    "ﬁ ǅ ẞ İstanbul. ß! ª º", "क़ ख़ नमस्ते.", "👍👍. naïve; co-op", "word. word, word! Word? word; WORD:",
]


def test_word_ids_equal_whole_texts(spark):
    known = packing.WordIds(VOCABULARY)
    got = [[*x.tolist(), 1] for x in known.of([packing.words_of((t or "").encode()) for t in TRICKY])]
    assert got == plain_ids(TRICKY)
    assert packing.splits_at_space(VOCABULARY)
    assert not packing.splits_at_space(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"))


def test_word_ids_stay_right_when_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 20)
    rnd = random.Random(1)
    texts = [" ".join("".join(rnd.choices("abcé", k=rnd.randint(1, 4))) + rnd.choice(["", ".", ","]) for _ in range(30)) for _ in range(40)]
    known = packing.WordIds(VOCABULARY)
    got = [[*x.tolist(), 1] for i in range(0, 40, 5) for x in known.of([packing.words_of(t.encode()) for t in texts[i : i + 5]])]
    assert got == plain_ids(texts)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=30))
def test_configurations_use_every_length_exactly(lengths):
    counts = np.zeros(65, dtype=np.int64)
    for n, k in lengths.items():
        counts[n] = k
    packed, bound = configurations.pack(counts, 64)
    used = Counter()
    for chosen, amount in packed:
        assert sum(chosen) <= 64 and amount > 0
        for n, k in Counter(chosen).items():
            used[n] += k * amount
    assert used == Counter({n: k for n, k in lengths.items()})
    assert sum(a for _, a in packed) >= bound - 1e-6


def test_configurations_are_close_to_the_bound():
    rng = np.random.default_rng(5)
    counts = np.bincount(rng.integers(1, 257, 20_000), minlength=257)
    packed, bound = configurations.pack(counts, 256)
    assert sum(a for _, a in packed) <= 1.006 * bound
    spread = np.bincount(rng.gamma(2, 300, 20_000).astype(int).clip(1, 4096), minlength=4097)
    packed, bound = configurations.pack(spread, 4096)
    assert sum(a for _, a in packed) <= bound + 2
    few = np.zeros(4097, dtype=np.int64)
    few[1000], few[3096], few[4096] = 5, 5, 2
    assert sum(a for _, a in configurations.pack(few, 4096)[0]) == 7


def check_packing(rows, texts, capacity):
    want = Counter()
    for doc_id, ids in texts:
        ids = np.array(ids, dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            body = ids[start : start + capacity]
            want[(doc_id, piece, start, len(body), zlib.crc32(body.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_query(spark, tmp_path):
    rnd = random.Random(2)
    texts = TRICKY + [" ".join(rnd.choices(["alpha", "Beta,", "gamma.", "qz"], k=rnd.choice([3, 50, 900, 9000]))) for _ in range(40)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(4, texts[4], "x", "y", 1)] * 3 + [(None, "null id", None, None, None)]
    out = QUERIES["op11_configuration_packing"](spark, store(spark, tmp_path, rows)).collect()
    ids = plain_ids([r[1] for r in rows])
    n = check_packing(out, list(zip([r[0] for r in rows], ids)), 4096)
    assert n <= -(-sum(map(len, ids)) // 4096) + 2


def test_packing_numbers_a_hot_length_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same words here").otherwise(F.repeat(F.lit("w "), F.col("id").cast("int"))).alias("text"))
    docs = docs.withColumn("sequence_id", F.lit("mine"))
    packed = packing.pack(docs, VOCABULARY, capacity=32, keep_ids=True)
    rows = packed.collect()
    ids = plain_ids([r.text for r in docs.collect()])
    n = check_packing(rows, list(zip(range(300), ids)), 32)
    whole = packing.sequences(packed).collect()
    assert len(whole) == n and sum(len(r.ids) for r in whole) == sum(map(len, ids))
    one = {(r.doc_id, r.piece): list(r.ids) for r in rows}
    for r in whole:
        for p in r.parts:
            body = one[(p.doc_id, p.piece)]
            assert list(r.ids[p.offset : p.offset + len(body)]) == body


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0


# Phrases -----------------------------------------------------------------------


def plain_phrases(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        wanted = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in wanted.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        best = []
        for p, a in wanted.items():
            if 100 * longer[p] >= 80 * a and longer[p]:
                continue
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return Counter(out)


def phrases_of(docs, **options):
    return Counter(map(tuple, collocations.collocations(docs, **options).collect()))


@pytest.mark.parametrize("seed", range(2))
def test_phrases_equal_the_plain_count(spark, monkeypatch, seed):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 3000)
    rnd = random.Random(seed)
    words = ["a", "b", "Cc", "dé", "e-e", "F", " x", "日", "g\x00h"]
    passage = " ".join(rnd.choices(words, k=60))
    rows = [(None, None), ("en", ""), ("en", None), ("fr", " .,; \n"), ("de", "a b c d")]
    for _ in range(120):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["en", "en", "fr", None]), rnd.choice([text, text + passage, passage])))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5).withColumn("phrase", F.lit(1))
    for least, top in ((5, 1000), (12, 7)):
        assert phrases_of(docs, least=least, top=top) == plain_phrases(rows, least, top)


def test_chunks_cover_every_word_once():
    rnd = random.Random(4)
    triggers = collocations._Triggers()
    words = [f"w{i}" for i in range(300)]
    text = " ".join(rnd.choices(words, k=5000)).encode()
    chunks = list(collocations.chunks_of(text, triggers))
    assert len(chunks) > 50
    assert b" ".join(w for tail, c in chunks for w in c.split()[: len(c.split()) - tail]) == b" ".join(text.split())
    again = list(collocations.chunks_of(b"other start " + text, triggers))
    assert len(set(chunks) & set(again)) >= len(set(chunks)) - 2


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9 * 10**18
    frequent = spark.createDataFrame(
        [("x", "a", 1, big), ("x", "b", 1, big - 2), ("x", "a b", 2, big - 4), ("x", "c", 1, big), ("x", "b c", 2, 80), ("x", "a b c", 3, 70)],
        "lang string, phrase string, k int, f long",
    )
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in collocations.scored(frequent).collect()}
    assert got["a b"] == (big - 4, big, big - 2, 2000000 * (big - 4) // (2 * big - 2))
    assert got["a b c"][3] == 0
    held = {r.phrase: r.longer for r in collocations.held_by_longer(frequent).collect()}
    assert held == {"a b": 70, "b c": 70}


def test_phrases_of_nothing(spark):
    assert phrases_of(spark.createDataFrame([], "lang string, text string")) == Counter()
    assert phrases_of(spark.createDataFrame([("en", "one two")], "lang string, text string")) == Counter()


def test_phrase_query_spans_a_very_long_text(spark, tmp_path):
    text = "the long road, " * 40_000
    rows = [(1, text, "en", None, None), (2, text, "en", None, None), (3, None, None, None, None)]
    out = QUERIES["op12_collocations"](spark, store(spark, tmp_path, rows)).collect()
    assert [(r.phrase, r.a, r.n) for r in out] == [("the long road", 80_000, 240_000)]


def test_totals_come_from_chunks_alone(spark):
    """Words of a language without its chunks' overlaps; a block's chunks come back without its words being numbered."""
    rows = [("a", "x y z. " + "the of and to in is " * 40), ("b", "p q, r"), (None, "the of and"), ("a", ""), ("c", None)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    packed = collocations.blocks(collocations.dictionary(docs, F.col("lang"), F.col("text")))
    got = {r["lang"]: r["n"] for r in collocations.totals(packed).collect()}
    assert got == {"a": 243, "b": 3, "und": 3}
    for r in packed.collect():
        row = r.asDict()
        chunks, meta = collocations.unpacked(row)
        block = collocations.Block(row)
        assert [block.words[i] for i in block.codes] == b" ".join(chunks).split(b" ")
        assert meta.shape == (3, len(chunks)) and int(block.own.sum()) == sum(len(c.split()) for c in chunks) - meta[1].sum()


def test_phrases_are_numbered_by_their_hashes():
    """Hashes that occur are found by their first bits; n-grams are told apart without a sort unless two share a hash."""
    rng = np.random.default_rng(8)
    for bits, n in ((63, 500), (20, 4000), (4, 9), (12, 0)):
        known = np.unique(rng.integers(0, 1 << bits, n).astype(np.uint64))
        keys = np.concatenate([known, rng.integers(0, 1 << bits, 300).astype(np.uint64)])
        want = {int(k): i for i, k in enumerate(known)}
        assert collocations.Places(known, bits).of(keys).tolist() == [want.get(int(k), -1) for k in keys]
    near = np.array([2, 0, 2, 1, 0])
    for pair in (np.array([7, 9, 7, 4, 9]), np.array([7, 9, 8, 4, 9])):
        first, number = collocations._numbered(near, pair, 4)
        assert pair[first][number].tolist() == pair.tolist() and len(first) == len(set(pair.tolist()))
        assert all(pair[:i].tolist().count(pair[i]) == 0 for i in first)


def test_naming_phrases_sorts_nothing(monkeypatch):
    """Without colliding hashes a block's phrases need neither a sort of their places nor a join of their words."""
    body = b"\n".join([b"one two three one two three", b"two three four", b"\xc3\xa9 one"])
    meta = np.array([(0, 0, 2), (1, 1, 1), (0, 0, 5)], dtype="<i8").T.tobytes()
    packed, extra = (pa.compress(x, codec="zstd", asbytes=True) for x in (body, meta))
    block = collocations.Block({"langs": ["a", "b"], "size": len(body), "body": packed, "meta": (3).to_bytes(8, "little") + extra})
    keys, _ = block.entries(40)

    def sort(*args, **kwargs):
        raise AssertionError("sorted")

    monkeypatch.setattr(np, "unique", sort)
    found = pa.Table.from_batches(list(block.phrases(keys, 40))).to_pylist()
    want = Counter()
    for lang, tail, n, line in (("a", 0, 2, body.split(b"\n")[0]), ("b", 1, 1, b"two three four"), ("a", 0, 5, b"\xc3\xa9 one")):
        words = line.decode().split()
        for i in range(len(words) - tail):
            want.update({(lang, " ".join(words[i:j]), j - i): n for j in range(i + 1, min(i + 4, len(words)) + 1)})
    assert {(r["lang"], r["phrase"], r["k"]): r["f"] for r in found} == dict(want)
