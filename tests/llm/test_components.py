import random

from tripgrain.llm.components import connected_components


def test_against_a_plain_search(spark):
    chance = random.Random(1)
    links = [(chance.randrange(400), chance.randrange(400)) for _ in range(260)]
    links += [(1000 + i, 1001 + i) for i in range(120)] + [(5000, 5000 + i) for i in range(1, 80)]
    links += [(7, 7), (8, 9), (8, 9), (9, 8)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    lowest = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(lowest[a], lowest[b])
            changed |= lowest[a] != low or lowest[b] != low
            lowest[a] = lowest[b] = low
    alone = {n for n in lowest if all(a == b == n for a, b in links if n in (a, b))}
    assert found == {n: low for n, low in lowest.items() if n not in alone}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
