import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressledger.llm.components import components
from pressledger.llm.shingle_join import ShingleJoin, excess, parity_distance, parity_maps, prefix_matches
from pressledger.llm.tables import ready

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1))) if words else frozenset()


def brute_force(rows, width, num, den):
    """(shingles, component) by doc_id, every pair compared."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed, n):
    """Families of near copies at several distances, exact copies, shared passages, short and empty texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["the", "of"] * 40
    passage = " ".join(rng.choices(words, k=60))
    rows, family = [], []
    for i in range(n):
        kind = rng.random()
        if family and kind < 0.5:
            text = rng.choice(family).split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                text[rng.randrange(len(text))] = rng.choice(["ZZ", "yy", f"n{i}"])
            text = " ".join(text)
        elif kind < 0.6:
            text = " ".join(rng.choices(words, k=rng.randrange(0, 14)))
        else:
            text = " ".join(rng.choices(words, k=rng.randrange(30, 200)))
            if rng.random() < 0.3:
                text += "\n" + passage
            family.append(text)
        rows.append((i * 7 % (n * 7), text.upper() if rng.random() < 0.05 else text))
    return rows


@pytest.mark.parametrize("seed,width,num,den", [(1, 3, 90, 100), (2, 5, 8, 10), (3, 1, 5, 10)])
def test_components_equal_brute_force(docs_of, seed, width, num, den):
    rows = corpus(seed, 160) + [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one"), (5004, "One"), (5005, "x " * 20000)]
    ready(docs_of(rows[:1]).sparkSession)
    got = ShingleJoin(docs_of(rows), width, num, den).components().collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(rows, width, num, den)
    assert len(got) == len(rows)


def test_a_large_group_of_near_copies(docs_of):
    rng = random.Random(5)
    base = [f"u{i}" for i in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(i % 4):
            text[rng.randrange(150)] = f"e{i}-{rng.random()}"
        rows.append((i, " ".join(text)))
    ready(docs_of(rows[:1]).sparkSession)
    join = ShingleJoin(docs_of(rows), 3, 90, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.components().collect()}
    assert got == brute_force(rows, 3, 90, 100)
    # links connect the group without being all its pairs
    assert join.links().count() < 300 * 12


def test_repeated_and_missing_ids_and_empty_table(docs_of, spark):
    ready(spark)
    text = " ".join(f"a{i}" for i in range(60))
    rows = [(9, text), (9, text), (4, text), (None, text), (7, "other words here and there now")]
    got = Counter((r.doc_id, r.component_id) for r in ShingleJoin(docs_of(rows), 3, 9, 10).components().collect())
    assert got == Counter({(9, 4): 2, (4, 4): 1, (7, 7): 1, (None, None): 1})
    assert ShingleJoin(docs_of(rows).where("false"), 3, 9, 10).components().count() == 0


def by_document(rows, width, num, den):
    """Components where rows that share a doc_id are one document, by comparing every two texts."""
    top = {i: i for i, _ in rows}
    single = brute_force(list(enumerate(t for _, t in rows)), width, num, den)
    changed = True
    while changed:
        changed = False
        for key in (lambda k: single[k][1], lambda k: rows[k][0] + 10**9):
            groups = defaultdict(list)
            for k, (i, t) in enumerate(rows):
                groups[key(k)].append(i)
            for ids in groups.values():
                low = min(top[i] for i in ids)
                for i in ids:
                    changed, top[i] = changed or top[i] != low, low
    return top


def test_rows_of_one_document_with_unlike_texts(docs_of, spark):
    ready(spark)
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (2, b), (6, ""), (6, a), (8, "x y z w"), (8, None)]
    got = {(r.doc_id, r.component_id) for r in ShingleJoin(docs_of(rows), 3, 9, 10).components().collect()}
    assert got == {(3, 2), (5, 2), (2, 2), (6, 2), (8, 8)}
    rng = random.Random(11)
    many = [(i % 70, t) for i, t in corpus(4, 140)]
    many += [(rng.randrange(70), t) for _, t in many[:30]] + [(rng.randrange(70), t + " tail") for _, t in many[30:50]]
    got = {(r.doc_id, r.component_id) for r in ShingleJoin(docs_of(many), 3, 9, 10).components().collect()}
    assert got == set(by_document(many, 3, 9, 10).items())


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(1)
    for n, m in ((40, 44), (500, 530), (3000, 2300)):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[: min(n, m) - 20], rng.integers(0, 2**63, max(m - n + 20, 0), dtype=np.uint64)])
        maps = parity_maps(np.r_[a, b], np.array([len(a), len(b)]))
        assert parity_distance(*maps) <= len(np.setxor1d(a, b))


def test_prefixes_grow_with_their_cost():
    frequent = np.r_[np.zeros(20), np.full(20, 1000.0)]
    cheap, dear = prefix_matches(frequent, np.array([5, 5]), np.array([15, 15]), np.array([0, 18]))
    assert cheap == 1 and dear > 1
    assert (excess(np.array([100, 101, 99, 5000])) > 0).tolist() == [False, False, False, True]


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 200)] + [(300, 301), (301, 302), (302, 300), (500, 500)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)]
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    wanted = {}
    for node in sorted(near):
        todo = [node] if node not in wanted else []
        while todo:
            x = todo.pop()
            if x not in wanted:
                wanted[x] = node
                todo += near[x]
    del wanted[500]
    got = components(spark.createDataFrame(links, "a long, b long").select(F.col("a"), F.col("b"))).collect()
    own = {n: c for n, c in wanted.items() if near[n] - {n}}
    assert {r.node: r.component for r in got} == own and len(got) == len(own)
