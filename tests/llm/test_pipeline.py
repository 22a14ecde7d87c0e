"""The near-copy stage of the corpus pipeline against brute force."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_near_copies(rows):
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for j, (b, _) in enumerate(rows):
        for i, (a, _) in enumerate(rows[:j]):
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                least, most = sorted((group[i], group[j]))
                group = [least if g == most else g for g in group]
    return rows, group


def test_near_copies_of_repeated_ids(spark):
    def text(tag, n=40, last=""):
        return " ".join(f"{tag}{k}" for k in range(n)) + last

    rows = [(5, text("a")), (5, text("b")), (3, text("b")), (6, text("c")), (6, text("c", last=" x")), (7, text("d"))]
    rows += [(7, text("d")), (8, None), (8, ""), (9, ""), (None, text("a")), (None, text("a")), (10, text("c", last=" y"))]
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in rows], SCHEMA)
    out = corpus_pipeline.near_copy_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    ordered, group = plain_near_copies(rows)
    assert set(got.values()) == {1} and set(got) <= set(rows)
    place = {r: g for r, g in zip(ordered, group)}
    assert Counter(place[r] for r in got) == Counter(set(group))
    least = {g: min((r[0] for r, h in place.items() if h == g), key=lambda i: (i is None, i)) for g in group}
    assert all(r[0] == least[place[r]] for r in got)
    assert (5, text("a")) in got and sum(i == 6 for i, _ in got) == 1
    assert corpus_pipeline.near_copy_stage(spark, docs.limit(0), "").collect() == []
