import random
from collections import Counter

from cases import rows

from tallywing.operators import in_degree, league_rank, orphans
from tallywing.plans import links
from tallywing.sources import edges_from_text, league_from_text

GRAPH = "1: 2 3 3\n2: 1\n4:\t4\n5:\n6 : 1  2 \n\nx: 1\n7: y 1\n6: 2\n 8:9\n"


def test_edges_hold_self_markers_and_duplicates(spark, write):
    got = Counter(rows(edges_from_text(spark, write("l.txt", GRAPH))))
    assert got == Counter(
        [(1, 1), (1, 2), (1, 3), (1, 3), (2, 2), (2, 1), (4, 4), (4, 4), (5, 5), (6, 6), (6, 1), (6, 2), (7, 7), (7, 1)]
        + [(6, 6), (6, 2), (8, 8), (8, 9)]
    )


def test_in_degree_counts_duplicates_but_no_self_links(spark, write):
    got = dict(rows(in_degree(edges_from_text(spark, write("l.txt", GRAPH)))))
    assert got == {1: 3, 2: 3, 3: 2, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 1}


def test_orphans_have_one_line_and_no_self_link(spark, write):
    assert rows(orphans(edges_from_text(spark, write("l.txt", GRAPH)))) == [(5,), (7,), (8,)]


def test_top_links_settle_ties_by_page(spark, write):
    got = [tuple(r) for r in links.top_popular_links(edges_from_text(spark, write("l.txt", GRAPH)), 3).collect()]
    assert got == [(3, 2), (1, 3), (2, 3)]


def test_league_shares_ranks_and_leaves_out_unknown_pages(spark, write):
    league = league_from_text(spark, write("league.txt", "1\n 2 \n2\n3\n4\n5\n99\n"))
    got = rows(links.popularity_league(edges_from_text(spark, write("l.txt", GRAPH)), league))
    assert got == [(1, 3), (2, 3), (3, 2), (4, 0), (5, 0)]


def test_rank_is_the_number_of_members_with_fewer_links(spark):
    rng = random.Random(3)
    edges = [(p, p) for p in range(40)] + [(rng.randrange(40), rng.randrange(40) // 3) for _ in range(300)]
    degree = {p: sum(1 for s, d in edges if d == p != s) for p in range(40)}
    members = sorted(rng.sample(range(40), 25))
    want = [(p, degree[p], sum(degree[q] < degree[p] for q in members)) for p in members]
    graph = spark.createDataFrame(edges, "src bigint, dst bigint")
    league = spark.createDataFrame([(p,) for p in members], "page bigint")
    assert sorted(rows(league_rank(graph, league))) == want
