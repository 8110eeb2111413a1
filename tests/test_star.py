"""Star model on small tables: slicers through relationships, roles, totals evaluated again, odd keys."""

import pytest

from ledgerlake.operators.star import Base, Relationship, Star, evaluate

ROWS = [(1, 1, "p", 10, 100.0), (1, 2, "p", 11, 50.0), (2, 3, "q", 10, 30.0), (3, 3, "q", 12, 7.0), (3, 1, None, 12, 1.0), (None, 2, "z", 10, 2.0)]


@pytest.fixture(scope="module")
def star(spark):
    sales = spark.createDataFrame(ROWS, "ship int, ordered int, product string, client int, amount double")
    costs = spark.createDataFrame([(1, 40.0), (2, 4.0), (3, 0.5)], "day int, cost double")
    calendar = spark.createDataFrame([(1, 2001, 1), (2, 2001, 2), (3, 2002, 1)], "day int, year int, half int")
    products = spark.createDataFrame([("p", "red"), ("q", "blue")], "product string, colour string")
    return Star({"sales": sales, "costs": costs}, {"Cal": calendar, "Prod": products},
                [Relationship("sales", "ship", "Cal", "day"), Relationship("sales", "ordered", "Cal", "day", "ordered"),
                 Relationship("sales", "product", "Prod", "product"), Relationship("costs", "day", "Cal", "day")],
                {"b_amount": Base("sales", "amount"), "b_clients": Base("sales", "client", "distinct"), "b_cost": Base("costs", "cost"),
                 "b_selected": Base("sales", "amount", all_selected=True), "b_all": Base("sales", "amount", ignores=frozenset({"Prod.colour"}))})


M = [("amount", "b_amount"), ("clients", "b_clients"), ("cost", "b_cost"), ("per_client", "b_amount / b_clients"), ("share", "b_amount / b_selected"), ("whole", "b_all")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_slicer_reaches_related_facts(star):
    got = rows(evaluate(star, M, ["Cal.year"], {"Cal.half": [1], "Prod.colour": "red"}))
    # half 1 filters both facts, the colour sales only; the last measure ignores the colour
    assert got == [(0, 2001, 150.0, 2, 40.0, 75.0, 1.0, 150.0), (0, 2002, None, None, 0.5, None, None, 8.0)]


def test_fact_without_the_column_repeats(star):
    got = {r[1]: r[2:5] for r in rows(evaluate(star, M[:3], ["Prod.colour"]))}
    assert got == {"red": (150.0, 2, 44.5), "blue": (37.0, 2, 44.5), None: (3.0, 2, 44.5)}


def test_roles(star):
    by_order = {r[1]: r[2] for r in rows(evaluate(star, M[:1], ["Cal@ordered.year"]))}
    by_ship = {r[1]: r[2] for r in rows(evaluate(star, M[:1], ["Cal.year"]))}
    assert by_order == {2001: 153.0, 2002: 37.0} and by_ship == {2001: 180.0, 2002: 8.0, None: 2.0}
    both = {r[1:3]: r[3] for r in rows(evaluate(star, M[:1], ["Cal.year", "Cal@ordered.year"]))}
    assert both == {(2001, 2001): 150.0, (2001, 2002): 30.0, (2002, 2002): 7.0, (2002, 2001): 1.0, (None, 2001): 2.0}


def test_totals_are_evaluated_again(star):
    levels = [["Cal.year", "Prod.colour"], ["Cal.year"], ["Prod.colour"], []]
    got = rows(evaluate(star, M, ["Cal.year", "Prod.colour"], {"Prod.colour": ["red", "blue"]}, levels))
    by = {r[:3]: r[3:] for r in got}
    assert by[0, 2001, "red"] == (150.0, 2, 44.0, 75.0, 150 / 187, 180.0) and by[0, 2001, "blue"] == (30.0, 1, 44.0, 30.0, 30 / 187, 180.0)
    assert by[1, 2001, None] == (180.0, 2, 44.0, 90.0, 180 / 187, 180.0)  # client 10 counts once
    assert by[2, None, "blue"][:4] == (37.0, 2, 44.5, 18.5) and by[3, None, None][:5] == (187.0, 3, 44.5, 187 / 3, 1.0)
    assert len(got) == 3 + 2 + 2 + 1


def test_null_member_is_not_a_total(star):
    got = rows(evaluate(star, M[:1], ["Prod.colour"], levels=[["Prod.colour"], []]))
    assert (0, None, 3.0) in got and (1, None, 190.0) in got and len(got) == 4


def test_facts_are_read_once(star):
    plan = evaluate(star, M, ["Cal.year"], levels=[["Cal.year"], []])._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan  # what follows reads the written cubes


def test_nothing_selected(star):
    assert rows(evaluate(star, M[:3], ["Cal.year"], {"Prod.colour": ["green"]})) == [(0, 2001, None, None, 44.0), (0, 2002, None, None, 0.5)]


def test_errors(star, spark):
    for by, levels in ((["Cal.no"], None), (["year"], None), (["Cal.year"], [["Prod.colour"]])):
        with pytest.raises(ValueError):
            evaluate(star, M[:1], by, levels=levels)
    with pytest.raises(ValueError):
        evaluate(star, [("cost", "b_cost")], ["Prod.colour"])
    with pytest.raises(ValueError):
        Star(star.facts, star.dimensions, [Relationship("sales", "absent", "Cal", "day")])
