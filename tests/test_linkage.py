"""Clusters, replaced keys, sets without common values, left-over rows and names in text against brute force."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import linkage as L


def test_components_of_shuffled_chains_rings_and_stars(spark):
    rng = random.Random(1)
    names = rng.sample(range(10**6), 3200)
    chain, ring, star = names[:3000], names[3000:3100], names[3100:]
    edges = [*zip(chain, chain[1:]), *zip(ring, [*ring[1:], ring[0]]), *((star[0], x) for x in star[1:])]
    edges += [(chain[5], chain[4]), (7_000_000, 7_000_000), (None, 3), (3, None)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in L.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {n: min(part) for part in (chain, ring, star) for n in part}


@pytest.mark.parametrize("edges", [[], [(4, 4)], [(None, None)]])
def test_components_without_edges(spark, edges):
    assert L.components(spark.createDataFrame(edges, "a long, b long")).count() == 0


def test_a_cluster_follows_links_that_are_not_direct(spark):
    """Each record agrees with the next in four of five columns, and with the one after that in fewer."""
    rows = [(i, "n", *(i // 5 + (k < i % 5) for k in range(5))) for i in range(40)] + [(40, "m", 0, 0, 0, 0, 0), (41, None, 0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "id long, name string, a int, b int, c int, d int, e int")
    got = {r.id: r.same_as for r in L.clusters(df, "id", "name", ["a", "b", "c", "d", "e"]).collect()}
    assert got == {**{i: 0 for i in range(40)}, 40: 40, 41: 41}


def test_closure_of_long_chains_and_trees(spark):
    rng = random.Random(2)
    names = rng.sample(range(10**6), 1000)
    pairs = [*zip(names[:600], names[1:600]), *((n, names[599]) for n in names[600:])]
    pairs += [pairs[0], (5_000_000, 5_000_000), (None, 1)]
    got = {r.old: r.new for r in L.closure(spark.createDataFrame(pairs, "old long, new long")).collect()}
    assert got == {n: names[599] for n in names if n != names[599]}
    assert L.closure(spark.createDataFrame([], "old long, new long")).count() == 0


@pytest.mark.parametrize(
    ("pairs", "what"),
    [([(1, 2), (2, 1)], "cycle"), ([(1, 2), (2, 3), (3, 1), (9, 1), (8, 7)], "cycle"), ([(1, 2), (2, 3), (3, 4), (4, 5), (5, 1)], "cycle"), ([(1, 2), (1, 3)], "several")],
)
def test_a_mapping_that_has_no_end_is_rejected(spark, pairs, what):
    with pytest.raises(ValueError, match=what):
        L.closure(spark.createDataFrame(pairs, "old long, new long"))


def test_conflicts_are_those_of_the_image(spark):
    rows = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (3, 11), (4, 10), (5, None), (1, None)], "plyr long, game long")
    other = spark.createDataFrame([(1,), (2,), (7,)], "plyr long")
    mapping = spark.createDataFrame([(2, 1), (3, 1), (5, 1)], "old long, new long")
    got = {tuple(r) for r in L.conflicts({"a": (rows, "plyr", ["plyr", "game"]), "b": (other, "plyr", ["plyr"])}, mapping).collect()}
    assert got == {("a", "1|10", 2, 2), ("a", "1|11", 2, 2), ("b", "1", 2, 2)}


def brute_disjoint(rows):
    return {(a, b) for a, n, g, s in rows for b, m, h, t in rows if n == m and None not in (n, g, h) and g < h and not {*(s or ())} & {*(t or ())}}


@pytest.mark.parametrize("low_bits", [1, 4, 6])
def test_disjoint_classes_expand_to_all_pairs_of_records(spark, low_bits):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), rng.choice(["x", "y", "z", None]), rng.choice([None, [], rng.sample(range(19), rng.randrange(1, 9))])) for i in range(150)]
    members = L.set_classes(spark.createDataFrame(rows, "id long, name string, team string, weeks array<int>"), "id", "name", "team", "weeks")
    of = collections.defaultdict(list)
    for r in members.collect():
        of[r.name, r.team, r.mask].append(r.id)
    got = []
    for r in L.disjoint_classes(members, "name", "team", low_bits).collect():
        a, b = of[r.name, r.team, r["mask"]], of[r.name, r.other_group, r.other_mask]
        assert (len(a), len(b)) == (r.n, r.other_n)
        got += [(x, y) for x in a for y in b]
    assert len(got) == len({*got}) and {*got} == brute_disjoint(rows)


@pytest.mark.parametrize("low_bits", [2, 6])
def test_disjoint_pairs_are_all_pairs_of_records(spark, low_bits):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), rng.choice(["x", "y", "z", None]), rng.choice([None, [], rng.sample(range(19), rng.randrange(1, 9))])) for i in range(150)]
    members = L.set_classes(spark.createDataFrame(rows, "id long, name string, team string, weeks array<int>"), "id", "name", "team", "weeks")
    got = [(r.id, r.other_id) for r in L.disjoint_pairs(members, "id", "name", "team", low_bits).collect()]
    assert len(got) == len({*got}) and {*got} == {(min(p), max(p)) for p in brute_disjoint(rows)}


def test_disjoint_sets_join_names_both_customers_of_every_pair(spark, sf):
    from tidemark.plans import registry

    months = collections.defaultdict(set)
    for r in spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", F.month("o_orderdate").alias("m")).collect():
        months[r.o_custkey].add(r.m)
    want = {(a, b) for a in months for b in months if a < b and a % 50 == b % 50 and a % 3 != b % 3 and not months[a] & months[b]}
    got = [tuple(r) for r in registry.queries()["disjoint_sets_join"](spark, sf).select("id", "other_id").collect()]
    assert len(got) == len({*got}) and {*got} == want


def test_a_frequent_name_makes_classes_and_no_pairs_of_records(spark):
    rows = spark.range(200_000).selectExpr("id", "if(id % 3 > 0, 'hot', cast(id as string)) AS name", "id % 2 AS team", "if(id % 2 = 0, array(1, 2), array(3)) AS weeks")
    found = L.disjoint_classes(L.set_classes(rows, "id", "name", "team", "weeks"), "name", "team").collect()
    assert [(r.name, r.n + r.other_n) for r in found] == [("hot", 133_333)]


def test_left_over_rows_are_as_many_as_the_counts_say(spark):
    left = [("a", i) for i in range(3)] + [("b", 1), (None, 1), (None, 2), ("c", None), ("c", None), ("c", None)] + [("hot", i) for i in range(5000)]
    right = [("a",), ("a",), ("b",), ("b",), (None,), ("c",), ("z",)] + [("hot",)] * 4990
    a, b = spark.createDataFrame(left, "k string, v int").repartition(4), spark.createDataFrame(right, "k string")
    got = L.left_over(a, b, ["k"], ["v"]).collect()
    counts = collections.Counter(r.k for r in got)
    assert counts == {"a": 1, None: 1, "c": 2, "hot": 10}
    assert {(r.k, r.n_left, r.n_right) for r in got} == {("a", 3, 2), (None, 2, 1), ("c", 3, 1), ("hot", 5000, 4990)}
    assert len({(r.k, r.v) for r in got if r.k == "hot"}) == 10


def test_names_in_text_by_tier_place_and_ties(spark):
    roster = spark.createDataFrame([("Al Smith", "A"), ("Al Q. Smith", "B"), ("Bo Rue", "C"), ("Cy Rue", "C"), ("Di Watts", "A"), ("Di Watts", "B"), ("Éva O’Hara", "D"), ("", "E"), (None, "E")], "name string, team string")
    texts = ["AL SMITH runs", "pass to al q. smith", "Rue and Watts", "x Watts", "Éva o’hara kicks", "Smith", "nobody", "", None, "Di Watts to Al Smith", "Bo Rue, Watts"]
    plays = spark.createDataFrame([*enumerate(texts)], "play long, text string")
    got = {r.play: (r.group, r.tier, r.gram, r.n_groups) for r in L.attributed(plays, "play", "text", L.name_index(roster, "name", "team")).collect()}
    none = (None, None, None, None)
    assert got == {
        0: ("A", 0, "al smith", 1), 1: ("B", 0, "al q smith", 1), 2: (None, 2, "watts", 2), 3: (None, 2, "watts", 2), 4: ("D", 0, "éva o’hara", 1), 5: (None, 2, "smith", 2),
        6: none, 7: none, 8: none, 9: (None, 0, "di watts", 2), 10: ("C", 0, "bo rue", 1),
    }


def test_duplicates_take_the_least_row_that_has_a_value(spark):
    rows = [(1, "n", 1, "U"), (2, "n", 1, "x"), (3, "n", 1, "y"), (4, "n", 2, "U"), (5, "m", 1, "U"), (6, None, 1, "U"), (7, None, 1, "x")]
    df = spark.createDataFrame(rows, "id long, name string, born int, tm string")
    assert [tuple(r) for r in L.duplicates(df, "id", ["name", "born"], "tm", "U").collect()] == [(1, 2)]


def test_written_rows_are_read_from_the_shared_folder(spark):
    df = L.written(spark.range(10).withColumn("x", F.lit("y")), "some")
    assert df.count() == 10 and df.inputFiles()
