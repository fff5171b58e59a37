"""Neighbour forest and Jaccard join against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from panelspark import session
from panelspark.llm import jaccard, neighbours
from panelspark.llm.components import components
from panelspark.llm.queries import QUERIES
from panelspark.suite.registry import table

from cases import edge_docs, edge_rows, empty_docs, pairs

SF = "/root/testdata/sf0.01"


def nearest_of(ids, vectors, own, k):
    scores = (vectors * vectors[ids == own][0]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


@pytest.mark.parametrize("block_rows", [16_384, 120])
def test_recall_of_the_forest(spark, block_rows):
    vectors = table(spark, SF, "embeddings")
    rows = vectors.collect()
    ids, data = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, block_rows=block_rows).collect():
        found[r.query_id].append((r["rank"], r.id, r.score))
    asked = [i for i in ids if i % 20 == 0]
    assert sorted(found) == sorted(asked)
    hits = 0
    for own in asked:
        wanted = nearest_of(ids, data, own, 20)
        got = sorted(found[own])
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(s == (data[ids == i][0] * data[ids == own][0]).sum() for _, i, s in got)
        hits += len({i for i, _ in wanted} & {g[1] for g in got})
    assert hits / (20 * len(asked)) >= 0.95


def test_unusable_vectors_take_no_part_and_ties_go_to_smaller_ids(spark):
    v = [1.0, 2.0, 0.5]
    rows = [(i, v) for i in range(0, 30)] + [
        (40, None), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 2.0]), (100, [1.0, float("nan"), 2.0]),
        (120, [float("inf"), 1.0, 1.0]), (140, [1.0, 2.0]), (None, v), (0, v), (160, [-1.0, -2.0, -0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("clash"))
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5).collect():
        got[r.query_id].append((r["rank"], r.id))
    assert sorted(got) == [0, 20, 160]
    assert sorted(got[0]) == [(i, i) for i in range(1, 6)]
    assert sorted(got[20]) == [(i + 1, i) for i in range(5)]
    few = neighbours.nearest(df.where("vec_id < 4"), F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(r.id for r in few) == [1, 2, 3]
    assert neighbours.nearest(df.where("false"), F.lit(True)).count() == 0


def test_ranges_of_the_forest_are_common_prefixes():
    rng = np.random.default_rng(0)
    data = rng.normal(size=(300, 6))
    forest = neighbours.Forest(np.arange(300), data, 3, 10, 1)
    codes = np.take_along_axis(forest.sorted, np.argsort(forest.order, axis=1), axis=1)
    for depth in range(11):
        for tree in range(3):
            start, end = forest.ranges(tree, codes[tree, 7:8], depth)
            same = np.flatnonzero(codes[tree] >> np.uint64(10 - depth) == codes[tree, 7] >> np.uint64(10 - depth))
            assert sorted(forest.order[tree, start[0]:end[0]]) == same.tolist()


def plain_set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def plain_components(rows, percent=80):
    """Rows as (id, set size, smallest known id of the component), links found by trying all pairs with a common token."""
    sets = [plain_set(t) for _, t in rows]
    holders = defaultdict(list)
    for at, s in enumerate(sets):
        for token in s:
            holders[token].append(at)
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for at, s in enumerate(sets):
        for other, n in Counter(o for token in s for o in holders[token] if o > at).items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                root[find(at)] = find(other)
    least = defaultdict(list)
    for at, (i, _) in enumerate(rows):
        if i is not None:
            least[find(at)].append(i)
    return Counter((i, len(s), i if not s else min(least[find(at)], default=None))
                   for at, ((i, _), s) in enumerate(zip(rows, sets)))


def joined(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_jaccard_join_on_given_documents(spark):
    docs = table(spark, SF, "documents")
    got = QUERIES["op6_jaccard_join"](spark, SF)
    assert joined(got) == plain_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("block_sets, percent", [(4096, 80), (8, 80), (6, 60)])
def test_jaccard_join_on_families_around_the_threshold(spark, block_sets, percent):
    rng = random.Random(block_sets + percent)
    pool = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(4):
        base = [rng.choice(pool) for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(pool)
            if rng.random() < 0.2:
                copy = copy[:rng.randint(3, len(copy))]
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard.jaccard_components(df, percent=percent, block_sets=block_sets)
    assert joined(got) == plain_components(rows, percent)


def test_jaccard_join_reads_texts_in_small_portions(spark, monkeypatch):
    """Both readings of the texts, and nothing else, run with small batches; sets come as arrays, not as lists of numbers."""
    names, seen, kinds = list(session.SMALL_BATCHES), {}, set()
    settings = lambda: [spark.conf.get(name) for name in names]
    before, write, run = settings(), jaccard.materialize, jaccard.map_rows

    def rows(df, schema, work):
        kinds.update(type(row[-1]) for row in work(iter([{"id": 1, "th": 2, "text": b"a b c d e f g"}])))
        return run(df, schema, work)

    monkeypatch.setattr(jaccard, "materialize", lambda df, label: seen.setdefault(label, settings()) and write(df, label))
    monkeypatch.setattr(jaccard, "map_rows", rows)
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(3, text), (1, text + " x"), (2, "other words"), (4, None)], "doc_id bigint, text string")
    assert joined(jaccard.jaccard_components(docs)) == plain_components([(r.doc_id, r.text) for r in docs.collect()])
    assert {label for label, found in seen.items() if found == list(session.SMALL_BATCHES.values())} == {"listed", "sets"}
    assert settings() == before and kinds == {np.ndarray}


def test_jaccard_edge_rows(spark):
    docs = edge_docs(spark)
    assert joined(jaccard.jaccard_components(docs)) == plain_components(pairs(edge_rows()))
    assert jaccard.jaccard_components(empty_docs(spark)).count() == 0
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[5] == 1 and ids[6] == 1 and 7 not in ids and 2 ** 40 not in ids
    assert ids[0] == ids[1] == ids[2] == 1  # without words nothing is a duplicate
    assert jaccard.one_per_component(empty_docs(spark)).count() == 0


def test_tree_finds_every_point_that_may_link():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 4, (40, 16))
    counts = np.repeat(base, 8, axis=0) + rng.integers(0, 2, (320, 16))
    sizes = counts.sum(axis=1)
    tree = jaccard.CountTree(counts, sizes)
    assert sorted(tree.order) == list(range(320))
    for row in range(0, 320, 7):
        bound = np.minimum(counts, counts[row]).sum(axis=1)
        fits = (sizes * 100 >= 80 * sizes[row]) & (sizes[row] * 100 >= 80 * sizes)
        wanted = np.flatnonzero(fits & (bound >= jaccard.least_overlap(sizes[row], sizes, 80)))
        found, bounds = tree.search(row, 80)
        assert sorted(found) == [w for w in wanted if w != row]
        assert (bounds == bound[found]).all()


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 200)] + [(300, 300), (7, 7)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 200)}}
    assert components(df.where("false")).count() == 0
