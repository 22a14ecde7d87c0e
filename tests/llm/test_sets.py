"""Near copies, decontamination, line windows: against plain versions, and the odd cases."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgflow.llm import decontaminate, jaccard_join, line_dedup
from msgflow.llm.components import components

SCHEMA = "doc_id long, text string, source string, size long, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA)


def plain_sets(rows):
    out = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        out[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return out


def plain_components(rows):
    sets = plain_sets(rows)
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def families(seed=5):
    """Texts of many lengths, with copies in which a share of the words is changed, and chains of such copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for length in (1, 3, 4, 5, 6, 7, 9, 12, 20, 40, 90, 200):
        base = [f"w{x}" for x in rng.integers(0, 400, length)]
        for share in (0.0, 0.0, 0.01, 0.02, 0.04, 0.05, 0.06, 0.1):
            words = [w if rng.random() > share else f"x{rng.integers(9999)}" for w in base]
            rows.append((len(rows) * 3 + 1, " ".join(words)))
            base = words if share in (0.02, 0.05) else base
    return rows


def test_join_finds_every_component(spark):
    rows = [*families(), (5000, None), (5001, ""), (5002, " \n"), (5003, "The End"), (5004, "the  end")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(frame(spark, rows)).collect()}
    assert got == plain_components(rows)


def test_join_blocks_of_a_family(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    rows = families(9)
    sets = [(i, jaccard_join.shingle_set(t, jaccard_join.WordHashes()).tobytes()) for i, t in rows if len(t.split()) > 5]
    table = spark.createDataFrame([(i, bytearray(x)) for i, x in sets], "id long, set binary")
    one = spark.createDataFrame([(i, sets[0][0]) for i, _ in sets[1:]], "u long, v long")
    found = components(jaccard_join._family_links(table, one, 2))
    got = {r["u"]: r["v"] for r in found.collect()}
    want = plain_components([(i, t) for i, t in rows if len(t.split()) > 5])
    assert {i: got.get(i, i) for i in want} == {i: c for i, (_, c) in want.items()}


def test_join_odd_rows(spark):
    same = "a b c d e f g"
    rows = [(7, same), (7, same), (7, "q r s t u v w"), (9, "q r s t u v w"), (None, same), (3, same)]
    got = Counter(tuple(r) for r in jaccard_join.linked(frame(spark, rows)).collect())
    assert got == Counter({(7, 3, 3): 3, (9, 3, 3): 1, (None, 3, None): 1, (3, 3, 3): 1})
    assert jaccard_join.linked(frame(spark, [])).collect() == []


def test_join_passage_that_all_share(spark, monkeypatch):
    """A text is one row of the count whatever the buckets, and a passage in every text makes no family of all."""
    passage = [f"p{k}" for k in range(12)]
    rows = []
    for k in range(30):
        own = [f"t{k}w{i}" for i in range(90)]
        rows += [(2 * k, " ".join(passage + own)), (2 * k + 1, " ".join(passage + own[:-1] + ["end"]))]
    counts, kept, links = {}, jaccard_join.stored, jaccard_join._family_links

    def stored(frame, purpose):
        out = kept(frame, purpose)
        counts[purpose] = out.count()
        return out

    def family_links(sets, families, buckets):
        counts["families"] = [r["count"] for r in families.groupBy("v").count().collect()]
        return links(sets, families, buckets)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    monkeypatch.setattr(jaccard_join, "_family_links", family_links)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(frame(spark, rows)).collect()}
    assert got == plain_components(rows)
    assert counts["signed"] == len(rows)
    assert counts["families"] == [1] * 30


def test_join_wants_the_rows_of_a_batch():
    info = np.zeros(2, dtype=jaccard_join.INFO).tobytes()
    row = {"batch": 1, "pieces": 2, "info": info, "owners": b"", "counts": b"", "signatures": b""}
    piece = row | {"pieces": None, "info": b""}
    whole = pa.Table.from_pylist([piece, row, piece], schema=jaccard_join.BACK)
    assert len(jaccard_join._able(whole)) == 2
    with pytest.raises(RuntimeError, match="another order"):
        jaccard_join._able(whole.slice(1))


def test_kept_signatures_meet():
    """Of any two linked sets each keeps a signature that the other keeps, by any order of how many have them."""
    rng = np.random.default_rng(2)
    for size in [*range(1, 40), 55, 120, 300]:
        one = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for _ in range(5):
            drop = rng.integers(0, size // 4 + 1)
            more = rng.integers(0, 2**63, max(0, (size - drop) * 4 // 3 - size)).astype(np.uint64)
            other = np.unique(np.concatenate([one[drop:], more]))
            common = len(np.intersect1d(one, other))
            if 100 * common < 75 * (len(one) + len(other) - common):
                continue
            salt = int(rng.integers(100))
            kept = []
            for shingles in (one, other):
                found = zip(jaccard_join.instances(len(shingles)), jaccard_join.signatures(shingles))
                by_number = {}
                for (n, _), (values, need) in found:
                    order = np.argsort(jaccard_join.mix(values, salt))
                    by_number[n] = set(values[order][: len(values) - need + 1].tolist())
                kept.append(by_number)
            assert any(kept[0][n] & kept[1][n] for n in kept[0].keys() & kept[1].keys())


def test_signatures_meet():
    """Any two linked sets share a signature in one of their instances, and as many as either needs."""
    rng = np.random.default_rng(1)
    for size in [*range(1, 40), 55, 120, 300]:
        one = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for _ in range(5):
            drop = rng.integers(0, size // 4 + 1)
            more = rng.integers(0, 2**63, max(0, (size - drop) * 4 // 3 - size)).astype(np.uint64)
            other = np.unique(np.concatenate([one[drop:], more]))
            common = len(np.intersect1d(one, other))
            if 100 * common < 75 * (len(one) + len(other) - common):
                continue
            numbers = {n: s for (n, _), s in zip(jaccard_join.instances(len(one)), jaccard_join.signatures(one))}
            agree = [
                len(np.intersect1d(numbers[n][0], s)) >= max(1, min(numbers[n][1], need))
                for (n, _), (s, need) in zip(jaccard_join.instances(len(other)), jaccard_join.signatures(other))
                if n in numbers
            ]
            assert any(agree)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r["u"]: r["v"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert components(edges.limit(0)).collect() == []


def test_containment(spark):
    item = " ".join(f"i{k}" for k in range(40))
    long_text = " ".join(f"t{k}" for k in range(3000)) + " " + item.upper() + " " + " ".join(f"u{k}" for k in range(3000))
    part = " ".join(f"i{k}" for k in range(30))  # 26 of 36 shingles: too few
    most = " ".join(f"i{k}" for k in range(31))  # 27 of 36: enough
    docs = frame(spark, [(1, long_text), (2, part), (3, most), (4, None), (5, ""), (None, item), (6, "two words"), (6, "two words")])
    items = spark.createDataFrame([(10, item), (11, "two words"), (12, None), (13, "")], "item_id long, text string")
    got = Counter((r["doc_id"], r["item_id"], r["n_shared"]) for r in decontaminate.contained(docs, items).collect())
    assert got == Counter({(1, 10, 36): 1, (3, 10, 27): 1, (None, 10, 36): 1, (6, 11, 1): 1})
    left = decontaminate.clean_documents(docs, items)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == [2, 4, 5]
    assert decontaminate.contained(docs.limit(0), items).collect() == []
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == 8


def plain_dedup(rows):
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = {}, defaultdict(set)
    for doc in docs:
        solid = [(k, line) for k, line in enumerate(doc[1].split("\n")) if line.strip()]
        for at in range(len(solid) - 2):
            window = tuple(x[1] for x in solid[at : at + 3])
            if seen.setdefault(window, (doc, at)) != (doc, at):
                out[doc].update(solid[at + k][0] for k in range(3))
    return {d: "\n".join(x for k, x in enumerate(d[1].split("\n")) if k not in out[d]) for d in docs}


def test_line_windows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " "], rng.integers(1, 14)))) for i in range(1, 40)]
    rows += [(40, None), (41, ""), (None, "p\nq\nr\ns"), (42, "p\nq\nr"), (42, "p\nq\nr"), (43, "a\n" * 500 + "z")]
    got = line_dedup.dedup_lines(frame(spark, rows), keep=["doc_id", "text"]).collect()
    want = plain_dedup(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["text_deduped"] == (None if r["text"] is None else want[(r["doc_id"], r["text"])])
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


def test_short_documents(spark):
    rows = [(1, "a\n\nb"), (2, "a\nb\n"), (2, "a\nb\n"), (3, "a"), (4, "a"), (5, "ab"), (6, "a\nb\nc"), (7, "z\na\nb\nc")]
    rows += [(8, ""), (9, " \n"), (10, None), (None, "ab")]
    got = line_dedup.dedup_lines(frame(spark, rows), keep=["doc_id"], short=True).collect()
    found = {r["doc_id"]: (r["text_deduped"], r["n_removed"], [tuple(x) for x in r["removed_spans"] or []]) for r in got}
    assert len(got) == len(rows)
    assert found == {
        1: ("a\n\nb", 0, []),
        2: ("", 2, [(0, 1)]),
        3: ("a", 0, []),
        4: ("", 1, [(0, 0)]),
        5: ("", 1, [(0, 0)]),
        6: ("a\nb\nc", 0, []),
        7: ("z", 3, [(1, 3)]),
        8: ("", 0, []),
        9: (" \n", 0, []),
        10: (None, 0, []),
        None: ("ab", 0, []),
    }


@pytest.mark.parametrize("text", [None, "", "x", "x y z", "a b c d e f"])
def test_shingles_match_plain(spark, text):
    got = frame(spark, [(1, text)]).select(F.size(F.array_distinct(decontaminate.shingles(F.col("text")))).alias("n")).first()
    assert got["n"] == len(plain_sets([(1, text)])[1])
