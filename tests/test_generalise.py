"""The finest publishable levels against all nodes of the lattice."""

from __future__ import annotations

import random
from itertools import product

import pytest
from helpers import rows

from carelake.operators import generalise
from carelake.operators.generalise import Hierarchy
from carelake.plans import gold

LEVELS = gold.COHORT_LEVELS


def cells(spark, chance, n, codes, regions):
    data = [(f"C{chance.randrange(codes)}", chance.choice([None, *range(0, 110, 3)]), chance.choice([None, *regions]),
             chance.choice("FM"), chance.randrange(1, 30)) for _ in range(n)]
    return spark.createDataFrame(data, "code_cim10 string, age int, region_code string, sex string, nb_patients bigint")


def brute(table, minimum):
    """(levels, cohorts) of the first node in order of loss whose cohorts all hold; nodes at which codes are too small apart."""
    data = [tuple(r) for r in table.collect()]
    whole = {}
    for code, *_, n in data:
        whole[code] = whole.get(code, 0) + n
    data = [d for d in data if whole[d[0]] >= minimum]
    spans = (1, 5, 10, 20, 40, None)
    for node in sorted(product(range(6), range(2), range(2)), key=lambda x: (x[0] + 5 * x[1] + 5 * x[2], x)):
        groups = {}
        for code, age, region, sex, n in data:
            years = spans[node[0]]
            start = age // years * years if years and age is not None else None
            band = "*" if years is None else "inconnu" if age is None else f"{start}" if years == 1 else f"{start}-{start + years - 1}"
            key = (code, band, "*" if node[1] else region, "*" if node[2] else sex)
            groups[key] = groups.get(key, 0) + n
        if all(n >= minimum for n in groups.values()):
            return node, sorted(((*k, n, *node) for k, n in groups.items()), key=repr)
    return None, []


@pytest.mark.parametrize(("n", "minimum", "regions"), [(40, 5, ["R1"]), (300, 20, ["R1", "R2"]), (300, 60, ["R1", "R2", "R3"]), (200, 200, ["R1"])])
def test_equals_all_nodes(spark, n, minimum, regions):
    table = cells(spark, random.Random(n + minimum), n, 4, regions).cache()
    node, wanted = brute(table, minimum)
    assert rows(gold.cohortes_generalisees(table, minimum)) == wanted
    assert node is not None


def test_small_pathologies_do_not_decide_over_the_others(spark):
    given = [("rare", 30, "R1", "F", 2), ("rare", 50, "R2", "M", 2), ("known", 30, "R1", "F", 9), (None, 31, None, None, 8)]
    table = spark.createDataFrame(given, "code_cim10 string, age int, region_code string, sex string, nb_patients bigint")
    assert rows(gold.cohortes_generalisees(table)) == [("known", "30", "R1", "F", 9, 0, 0, 0), (None, "31", None, None, 8, 0, 0, 0)]


def test_nothing_to_publish(spark):
    table = spark.createDataFrame([("a", 1, "R", "F", 4)], "code_cim10 string, age int, region_code string, sex string, nb_patients bigint")
    assert gold.cohortes_generalisees(table).isEmpty() and gold.cohortes_generalisees(table.limit(0)).isEmpty()
    assert generalise.generalised(table, LEVELS, [], "nb_patients").isEmpty()
    assert generalise.generalised(table, LEVELS, [], "nb_patients", 4).first().nb_patients == 4


def test_levels_follow_from_each_other(spark):
    table = spark.createDataFrame([(a,) for a in [None, *range(131)]], "age int")
    for below, above in zip(LEVELS[0].levels, LEVELS[0].levels[1:], strict=False):
        pairs = table.select(below(table.age).alias("b"), above(table.age).alias("a")).distinct()
        assert pairs.count() == pairs.select("b").distinct().count()


def test_the_walk_asks_about_few_nodes(spark, monkeypatch):
    asked = []
    rolled_up = generalise.rolled_up
    monkeypatch.setattr(generalise, "rolled_up", lambda *given: asked.append(given[2]) or rolled_up(*given))
    column = Hierarchy("sex", tuple([generalise.as_it_is] * 15 + [generalise.merged]))
    table = spark.createDataFrame([("F", 3), ("M", 3)], "sex string, nb_patients bigint")
    assert generalise.finest_node(table, [column], [], "nb_patients") == (15,)
    assert len(asked) <= 5  # of 16
