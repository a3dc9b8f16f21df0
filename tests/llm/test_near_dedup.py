import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from corpus_cases import BLANKS, LOWER, frame, prose, sorted_rows
from remitscope.llm import components, near_dedup


def shingles(text, size):
    words = BLANKS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def expected(rows, size, percent):
    """Rows as nodes; rows that share an id are one, null ids are told apart by their text."""
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if not sets[i] or not sets[j]:
            continue
        both = len(sets[i] & sets[j])
        near = 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
        if near or (rows[i][0] == rows[j][0] and rows[i][0] is not None):
            parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        if not sets[i]:
            out.append((doc_id, 0, doc_id, True))
            continue
        ids = [rows[j][0] for j in range(len(rows)) if sets[j] and root(j) == root(i)]
        least = min((x for x in ids if x is not None), default=None)
        out.append((doc_id, len(sets[i]), least, least is None or doc_id == least))
    return sorted_rows(out)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_awkward_rows(messy, messy_rows, size, percent):
    found = near_dedup.near_groups(messy, size, percent).collect()
    assert sorted_rows(map(tuple, found)) == expected(messy_rows, size, percent)


def test_no_rows(no_documents):
    assert near_dedup.near_groups(no_documents).count() == 0
    assert near_dedup.one_of_each(no_documents).count() == 0


def edited(seed, text, changes):
    draw, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_a_large_group_of_near_copies_beside_random_texts(spark):
    base = prose(7, 120)
    rows = [(i, edited(i, base, i % 9)) for i in range(150)]
    rows += [(200 + i, prose(100 + i // 2, 40 + i % 2)) for i in range(60)]
    found = near_dedup.near_groups(frame(spark, rows).repartition(6), 3, 85).collect()
    assert sorted_rows(map(tuple, found)) == expected(rows, 3, 85)


def test_large_buckets_meet_in_tiles(spark, monkeypatch):
    """Chains of edits whose ends are far apart, with buckets too large for the plain join."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near_dedup, "TILE_WORDS", 300)
    rows = []
    for chain in range(6):
        text = prose(chain, 100)
        for i in range(10):
            rows.append((100 * chain + (7 * i) % 10, text))
            text = edited(chain * 10 + i, text, 3)
    found = near_dedup.near_groups(frame(spark, rows), 3, 85).collect()
    assert sorted_rows(map(tuple, found)) == expected(rows, 3, 85)


def test_one_of_each_keeps_columns(messy, messy_rows):
    kept = near_dedup.one_of_each(messy, 3, 85)
    assert kept.columns == messy.columns
    wanted = [row[0] for row in expected(messy_rows, 3, 85) if row[3]]
    assert sorted_rows((row.doc_id,) for row in kept.collect()) == sorted_rows((i,) for i in wanted)


def test_registers_merge_and_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(5)
    elements = draw.integers(0, 2**63, 3000).astype(np.uint64)
    parts = [np.unique(elements[:2000]), np.unique(elements[1000:]), np.unique(elements)]
    one, two, union = near_dedup.registers(parts, 4096 // 32)
    assert (np.maximum(one, two) == union).all()
    agreeing = []
    for seed in range(60):
        fresh = np.random.default_rng(seed).integers(0, 2**63, 1150).astype(np.uint64)
        a, b = near_dedup.registers([np.unique(fresh[:1000]), np.unique(fresh[150:])])
        agreeing.append((a == b).mean())
    assert abs(np.mean(agreeing) - 850 / 1150) < 0.03


def test_likelihood_keeps_similar_pairs_and_drops_others():
    draw = np.random.default_rng(1)
    for shared, kept in ((920, True), (300, False)):
        fresh = draw.integers(0, 2**63, 2000 - shared).astype(np.uint64)
        sets = [np.unique(fresh[:1000]), np.unique(fresh[-1000:])]
        a, b = near_dedup.registers(sets)
        n = np.array([1000])
        assert near_dedup.plausible(a[None], b[None], n, n, 0.85).tolist() == [kept]


def test_short_texts_and_cases():
    one, same, two = near_dedup.shingle_sets(pa.array(["Ab  cD", "aB\tCd", None]), 3)
    assert one.tolist() == same.tolist() and len(one) == 1 and len(two) == 0


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(path + star + [(7, 7), (500, 500), (3, 2)], "u long, v long")
    found = {row.node: row.root for row in components.components(edges).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}
    assert components.components(edges.limit(0)).count() == 0
