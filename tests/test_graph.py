"""Walks compared with plain Python on small graphs."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webtab.operators import graph, layout
from webtab.operators.ranks import grouped_row_number
from webtab.session import cut
from webtab.sources.pages import seed_urls


def walk_by_hand(edges, seeds, cap, depth, known=None):
    """Reference walk: edges are (src, dst, pos[, probe])."""
    links = {}
    for e in sorted(set(edges), key=lambda e: e[2]):
        links.setdefault(e[0], []).append((e[1], e[3] if len(e) > 3 else e[1]))
    level = [(s, None) for s in seeds if known is None or s in known]
    visited = {s: (0, None) for s, _ in level}
    order = [s for s, _ in level]
    for d in range(1, depth + 1):
        found = {}
        for page in [u for u, _ in level]:
            offers = [t for t in links.get(page, []) if t[1] not in visited]
            for dst, _ in offers[:cap]:
                if dst not in visited and (known is None or dst in known):
                    found.setdefault(dst, page)
        level = list(found.items())
        for u, r in level:
            visited[u] = (d, r)
            order.append(u)
    return visited, order


def run(spark, edges, seeds, cap, depth, known=None):
    schema = "src string, dst string, pos int" + (", probe string" if edges and len(edges[0]) > 3 else "")
    df = spark.createDataFrame(edges, schema)
    nodes = spark.createDataFrame([(k,) for k in known], "url string") if known is not None else None
    found, offers = graph.bfs(df, seed_urls(spark, seeds), cap, depth, nodes)
    rows = found.orderBy(*graph.walk_order()).collect()
    return {r.url: (r.depth, r.referrer) for r in rows}, [r.url for r in rows], offers


SMALL = [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("a", "x", 3), ("b", "d", 0), ("c", "d", 0), ("c", "a", 1),
         ("d", "a", 0), ("d", "e", 1), ("e", "f", 0), ("b", "gone", 1), ("a", "b", 4)]


@pytest.mark.parametrize("cap,depth", [(5, 3), (2, 2), (5, 0), (None, 9)])
def test_small_graph(spark, cap, depth):
    want, order = walk_by_hand(SMALL, ["a"], cap, depth)
    got, got_order, _ = run(spark, SMALL, ["a"], cap, depth)
    assert got == want and got_order == order


def test_missing_pages_take_a_slot(spark):
    known = ["a", "c", "d", "e"]
    got, order, _ = run(spark, SMALL, ["a"], 2, 3, known)
    assert (got, order) == walk_by_hand(SMALL, ["a"], 2, 3, known)
    assert "b" not in got and got["c"] == (1, "a")


def test_probe_differs_from_target(spark):
    edges = [("a", "b", 0, "b#x"), ("a", "b", 1, "b"), ("a", "c", 2, "c"), ("b", "a", 0, "a#top"),
             ("b", "d", 1, "d"), ("c", "d", 0, "d#1"), ("d", "e", 0, "e")]
    for cap in (1, 2):
        got, order, _ = run(spark, edges, ["a"], cap, 3)
        assert (got, order) == walk_by_hand(edges, ["a"], cap, 3)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10 ** 6))
def test_random_graphs_and_partitionings(spark, seed):
    rng = random.Random(seed)
    names = [f"n{k}" for k in range(25)]
    edges = [(rng.choice(names[:5] if rng.random() < .3 else names), rng.choice(names), k) for k in range(120)]
    want, order = walk_by_hand(edges, ["n0", "n7"], 3, 3)
    df = spark.createDataFrame(edges, "src string, dst string, pos int")
    for parts in (1, 5)[seed % 2:]:
        found, _ = graph.bfs(df.repartition(parts), seed_urls(spark, ["n0", "n7"]), 3, 3)
        rows = found.orderBy(*graph.walk_order()).collect()
        assert [r.url for r in rows] == order
        assert {r.url: (r.depth, r.referrer) for r in rows} == want
        for r in rows:
            assert r.depth == 0 or want[r.referrer][0] == r.depth - 1


def test_copies_of_edges_change_nothing(spark):
    got, order, _ = run(spark, SMALL * 50, ["a"], 2, 3)
    assert (got, order) == walk_by_hand(SMALL, ["a"], 2, 3)


def test_large_link_cap_uses_salted_groups(spark):
    edges = spark.range(5000).selectExpr("'hub' AS src", "concat('t', id) AS dst", "cast(id AS int) AS pos")
    found, _ = graph.bfs(edges, seed_urls(spark, ["hub"]), 1500, 1)
    assert found.count() == 1501
    assert found.agg(F.max(F.get("path", F.lit(0)))).first()[0] == 1499


def test_group_limit_runs_before_the_shuffle(spark):
    edges = spark.createDataFrame(SMALL, "src string, dst string, pos int")
    plan = graph.first_per_group(edges, "src", F.col("pos"), 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_items(spark):
    got, _, _ = run(spark, SMALL, ["a"], 5, 3)
    found, _ = graph.bfs(spark.createDataFrame(SMALL, "src string, dst string, pos int"), seed_urls(spark, ["a"]))
    assert [r.url for r in graph.first_items(found, graph.walk_order(), 3).collect()] == ["a", "b", "c"]
    assert graph.first_items(found, graph.walk_order(), 0).count() == len(got)


def chain_rows(spark, edges, seeds, hops=None):
    e = spark.createDataFrame(edges, "src string, dst string")
    s = spark.createDataFrame([(x, x) for x in seeds], "seed string, url string")
    return sorted(tuple(r) for r in graph.follow_chain(e, s, hops).select("seed", "url", "hop").collect())


def test_chains(spark):
    line = [(f"p{k}", f"p{k + 1}") for k in range(22)]
    assert chain_rows(spark, line * 3, ["p0"]) == sorted(("p0", f"p{k}", k) for k in range(23))
    assert chain_rows(spark, line, ["p0", "p20"], 4) == sorted(
        [("p0", f"p{k}", k) for k in range(5)] + [("p20", "p20", 0), ("p20", "p21", 1), ("p20", "p22", 2)])
    assert chain_rows(spark, line, ["nowhere"]) == [("nowhere", "nowhere", 0)]


def test_chain_that_repeats(spark):
    ring = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("self", "self")]
    assert chain_rows(spark, ring, ["a", "self"]) == [
        ("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("self", "self", 0)]


def chains_by_hand(edges, seeds, hops=None):
    step, out = {}, []
    for a, b in sorted(edges, reverse=True):
        step[a] = b
    for seed, note in seeds:
        url, hop, before, seen = seed, 0, None, set()
        while url is not None and url not in seen and (hops is None or hop <= hops):
            out.append((seed, url, hop, before, note))
            seen.add(url)
            url, hop, before = step.get(url), hop + 1, url
    return sorted(out, key=repr)


@pytest.mark.parametrize("grouped", [1 << 16, 9])
def test_random_chains_that_merge_repeat_and_change_groups(spark, monkeypatch, grouped):
    """Pages of several folders; a link mostly leads to the next number, sometimes anywhere."""
    monkeypatch.setattr(graph, "GROUPED", grouped)
    rng = random.Random(grouped)
    names = [f"https://h/{d}/page-{k}.html" for d in "abc" for k in (*range(40), *range(4090, 4110))] + ["bare", "https://h/x/"]
    edges = [(a, b if rng.random() < 0.9 else rng.choice(names)) for a, b in zip(names, names[1:], strict=False) if rng.random() < 0.97]
    seeds = [(n, f"of {n}") for n in ["https://h/a/page-0.html", "https://h/a/page-7.html", "https://h/c/page-4091.html", "bare", "nowhere",
                                      *rng.sample(names, 6)]]
    seeds = sorted(set(seeds))
    e = spark.createDataFrame(edges + edges[:9], "src string, dst string").repartition(5)
    s = spark.createDataFrame([(n, n, note) for n, note in seeds], "seed string, url string, note string")
    for hops in (None, 13):
        got = sorted((tuple(r) for r in graph.follow_chain(e, s, hops).collect()), key=repr)
        assert got == chains_by_hand(edges, seeds, hops)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_level_moves_itself_and_not_the_links(spark, no_broadcast):
    links = layout.Divided(spark, "links", "key")
    links.append(spark.range(1000).selectExpr("concat('p', id % 100) AS key", "concat('p', id) AS dst"))
    level = spark.range(30).selectExpr("concat('p', id) AS key", "id AS path")
    joined = level.join(links.read(), "key")
    # the only exchange is that of the level
    assert plan_of(joined).count("Exchange hashpartitioning") == 1 and joined.count() == 300
    assert "SelectedBucketsCount: " in plan_of(level.join(links.read(["p1"]), "key"))
    assert links.read(["p1", "p2"]).count() == 20
    files = links.files()
    links.forget()
    assert files.count() == 1000 and not spark.catalog.tableExists(links.name)


def test_visited_pages_grow_by_level(spark, no_broadcast):
    seen = layout.Divided(spark, "visited", "url", "depth")
    for depth in range(3):
        seen.append(spark.range(50).selectExpr(f"concat('u', id + {depth * 50}) AS url", f"{depth} AS depth"))
    assert seen.read().count() == 150 and seen.read().filter("depth = 1").count() == 50
    probe = spark.range(200).selectExpr("concat('u', id) AS url")
    left = probe.join(seen.read(), "url", "left_anti")
    assert left.count() == 50 and plan_of(left).count("Exchange hashpartitioning") == 1
    seen.forget()


def test_filter_drops_rows_before_they_are_moved(spark, no_broadcast):
    known, probes = layout.AddressFilter(spark), spark.range(20_000).selectExpr("concat('https://h/', id) AS probe", "id")
    assert known.add(spark.range(0, 20_000, 100).selectExpr("concat('https://h/', id) AS url"), "url") == 200
    assert known.add(spark.range(50, 20_000, 1000).selectExpr("concat('https://h/', id) AS url"), "url") == 20
    tested = known.tested(probes, "probe")
    assert tested.columns == ["probe", "id", "doubtful"]
    doubtful = {r.id for r in tested.filter("doubtful").collect()}
    added = {*range(0, 20_000, 100), *range(50, 20_000, 1000)}
    # every added address is doubtful, and next to no other
    assert added <= doubtful and len(doubtful) < len(added) + 50
    visited = spark.createDataFrame([(f"https://h/{k}",) for k in added], "url string")
    new = graph.new_links(tested, visited)
    assert {r.id for r in new.collect()} == set(range(20_000)) - added
    # only what the filter lets through is exchanged
    moved = plan_of(graph.new_links(cut(tested, "tested"), visited)).split("Exchange hashpartitioning(probe")
    assert len(moved) == 2 and "Filter (isnotnull(doubtful" in moved[1].split("Exchange")[0]
    assert layout.AddressFilter(spark).tested(probes, "probe").filter("doubtful").isEmpty()


@pytest.mark.parametrize("filtered", [0, 9, 1 << 30])
def test_hot_pages_are_divided(spark, monkeypatch, filtered):
    """The walk is the same from whichever level on the filter is used."""
    monkeypatch.setattr(graph, "HOT_LINKS", 7)
    monkeypatch.setattr(graph, "FILTERED", filtered)
    edges = [("hub", f"n{k}", k) for k in range(60)] + [(f"n{k}", "hub", 0) for k in range(60)] + [(f"n{k}", f"n{k * 7 % 60}", 1) for k in range(60)]
    for cap in (4, None):
        want, order = walk_by_hand(edges, ["n3"], cap, 4)
        got, got_order, _ = run(spark, edges * 2, ["n3"], cap, 4)
        assert got == want and got_order == order


def test_first_items_takes_whole_ranges(spark):
    df = spark.range(3000).selectExpr("id * 7919 % 3000 AS k", "id").repartition(6)
    for limit in (1, 20, 1500, 2999, 3000, 9000):
        got = graph.first_items(df, [F.col("k")], limit)
        assert sorted(r.k for r in got.collect()) == list(range(min(limit, 3000)))
        assert "TakeOrdered" not in plan_of(got) and "GlobalLimit" not in plan_of(got)
    same = spark.range(100).selectExpr("1 AS k", "id")
    assert graph.first_items(same, [F.col("k")], 40).count() == 40


def test_degrees(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("b", "a")], "src string, dst string")
    assert sorted(tuple(r) for r in graph.degrees(e).collect()) == [("a", 2, 1), ("b", 1, 1), ("c", 0, 1)]


def test_grouped_row_number(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 7) END AS g")
    got = grouped_row_number(df, "g", "id", "n", span=50)
    groups = {}
    for r in sorted(got.collect()):
        groups.setdefault(r.g, []).append(r.n)
    assert all(v == list(range(1, len(v) + 1)) for v in groups.values()) and len(groups) == 8
