"""Suffix deduplication, the Jaccard join and decontamination against their plain versions."""

import random

import brute as B
import numpy as np
import pytest
from llm_fixtures import AWKWARD, awkward, documents, nothing, rows_by_id  # noqa: F401

from varsift.llm import decontaminate, jaccard_join, suffix_dedup
from varsift.llm.graph import components


def _texts(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# -- suffix deduplication ----------------------------------------------------------------------


def test_repeated_strings_equal_brute_force(documents):
    rows = _texts(documents)
    assert _sorted(suffix_dedup.contract(documents).collect()) == _sorted(B.repeats(rows))


def test_repeats_of_awkward_rows(awkward, nothing):
    assert _sorted(suffix_dedup.contract(awkward).collect()) == _sorted(B.repeats(AWKWARD))
    assert suffix_dedup.contract(nothing).collect() == []


@pytest.mark.parametrize("large", [2, suffix_dedup.LARGE_CLASS], ids=["by-windows", "in-buckets"])
def test_passages_in_many_settings(spark, monkeypatch, large):
    """Shared passages at all offsets, overlapping and cut; both ways of settling classes are exact."""
    monkeypatch.setattr(suffix_dedup, "LARGE_CLASS", large)
    rng = random.Random(5)
    pool = "".join(rng.choice("abcdefgh \n") for _ in range(6000))
    rows = []
    for k in range(60):
        a = rng.randrange(0, 5000)
        own = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 300)))
        rows.append((k, own + pool[a:a + rng.choice([399, 400, 401, 450, 900])] + own[::-1] + ("ab" * 300 if k % 9 == 0 else "")))
    assert _sorted(suffix_dedup.contract(_frame(spark, rows)).collect()) == _sorted(B.repeats(rows))


def test_multikey_sort_orders_rows_and_prefixes():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 24), dtype=np.uint8)
    group = rng.integers(0, 3, 300)
    order, common = suffix_dedup.multikey_sort(rows, group)
    keys = [(group[k], rows[k].tobytes()) for k in order]
    assert keys == sorted(keys)
    for i in range(1, 300):
        a, b = keys[i - 1], keys[i]
        want = -1 if a[0] != b[0] else next((j for j in range(24) if a[1][j] != b[1][j]), 24)
        assert common[i] == want


def test_long_text_in_pieces(monkeypatch):
    """Samples do not depend on how a text is cut into pieces."""
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 30000, dtype=np.uint8)
    at = np.array([0, 12000, 12000, 30000])

    def windows():
        out = {}
        for row, sample, first, last, lead, _ in suffix_dedup.samples(data, at):
            for k in range(len(row)):
                for w in range(first[k], last[k] + 1):
                    out[w] = (row[k], sample[k], lead[k])
        return out

    whole = windows()
    monkeypatch.setattr(suffix_dedup, "PIECE", 5000)
    assert windows() == whole
    assert len(whole) == (12000 - 399) + (18000 - 399)


# -- Jaccard join ------------------------------------------------------------------------------


def test_components_equal_brute_force(documents):
    assert rows_by_id(jaccard_join.classes(documents)) == B.components(_texts(documents))


def test_near_copies_and_ties(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows, k = [], 0
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 5, 6, 40, 120]))]
        for copy in range(12):
            own = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((k, " ".join(own).upper() if copy % 2 else "  ".join(own)))
            k += 1
    passage = " ".join(f"p{j}" for j in range(60))
    rows += [(k + j, passage + " " + " ".join(rng.choice(words) for _ in range(j))) for j in range(40)]
    assert rows_by_id(jaccard_join.classes(_frame(spark, rows))) == B.components(rows)


def test_classes_of_awkward_rows(awkward, nothing):
    got = _sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes(awkward).collect())
    sets = [(d, B.shingles(t)) for d, t in AWKWARD]
    same = {1: 1, 6: 1}
    assert got == _sorted((d, len(s), same.get(d, d)) for d, s in sets)
    assert jaccard_join.classes(nothing).collect() == []
    kept = jaccard_join.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]


def test_one_of_each_group_stays_when_ids_repeat_or_are_null(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    rows = [(1, a), (1, a), (1, b), (0, b), (5, b + " more"), (None, c), (None, c), (7, c), (None, d), (None, d + " more"), (9, ""), (9, "")]
    kept = [tuple(r) for r in jaccard_join.one_of_each(_frame(spark, rows).repartition(3)).collect()]
    named = [r for r in kept if r[0] is not None]
    assert _sorted(named) == _sorted([(1, a), (0, b), (7, c), (9, ""), (9, "")])
    assert len([r for r in kept if r[0] is None]) == 1 and {r[1][:2] for r in kept if r[0] is None} == {"d0"}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 101: 100, 102: 100}


def test_sure_pairs_follow_from_the_hub(spark):
    """Answers against a common hub decide pairs without reading the sets."""
    rows = [(1, 10, 100, 0, 10, 95, 100), (1, 11, 100, 0, 11, 96, 100), (1, 12, 100, 0, 12, 30, 100), (1, 13, 100, 0, 13, -1, 100)]
    frame = spark.createDataFrame(rows, "token long, node long, size int, pos int, comp long, inter int, hub_size int")
    got = {(r.a, r.b): r.sure for r in jaccard_join.open_pairs(frame.coalesce(1)).collect()}
    assert got[10, 11] is True  # at least 91 of 100 in common
    assert (10, 12) not in got and (11, 12) not in got  # at most 35 in common
    assert got[10, 13] is False


# -- decontamination ---------------------------------------------------------------------------


def test_contamination_equals_brute_force(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = _sorted(B.contamination(_texts(documents), items))
    assert any(r[-1] for r in want)
    assert _sorted(decontaminate.contract(documents, bench).collect()) == want


def test_contamination_edges(spark, awkward, nothing):
    items = [("b", "Four FIVE six"), ("a", "two three four five six seven eight nine ten eleven twelve"), ("c", ""), ("d", None),
             (None, "single"), ("e", "SINGLE!"), ("b", "nine ten"), ("f", "word word"), ("g", "\u4f60\u597d")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    known = [(i, t) for i, t in items if i is not None]
    assert _sorted(decontaminate.contract(awkward, bench).collect()) == _sorted(B.contamination(AWKWARD, known))
    assert decontaminate.contract(nothing, bench).collect() == []
    assert {r.n_items for r in decontaminate.contract(awkward, bench.where("false")).collect()} == {0}
    kept = decontaminate.without_contaminated(awkward, bench)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 4, 9, 10]


def test_contamination_in_blocks_of_items(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = _texts(documents)
    whole = decontaminate.contamination(documents, bench)
    cut = decontaminate.contamination(documents, bench, block_bytes=2000)
    assert len(rows) == cut.count()
    assert _sorted((r.doc_id, r.n_words, r.hits, sorted(r["items"])) for r in cut.collect()) == _sorted(
        (r.doc_id, r.n_words, r.hits, sorted(r["items"])) for r in whole.collect())


def test_blocks_of_items_keep_rows_with_equal_or_null_ids(spark):
    """The same rows whether the benchmark is one block or many."""
    items = [(f"i{k}", " ".join(f"w{k}x{j}" for j in range(12))) for k in range(40)]
    rows = [(1, items[0][1]), (1, items[1][1] + " and more"), (1, items[0][1]), (None, items[2][1]), (None, "nothing here"), (None, None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    frame = _frame(spark, rows).repartition(3)
    whole, cut = (decontaminate.contamination(frame, bench, block_bytes=size) for size in (1 << 20, 300))
    assert cut.columns == whole.columns
    got = [_sorted((r.doc_id, r.n_words, r.hits, sorted(r["items"])) for r in x.collect()) for x in (whole, cut)]
    assert got[0] == got[1] and len(got[1]) == len(rows)
