from __future__ import annotations

import random
from dataclasses import replace
from itertools import combinations, product

import pytest

from panelworks.operators import roster as r
from panelworks.operators.aggregates import roster_totals

SCHEMA = (
    "player_name string, position string, secondary_position string, price bigint, "
    "adjusted_predicted_score double, is_bye boolean, likely_to_play boolean"
)
RULES = r.RosterRules(slots={"A": 1, "B": 2}, flex=1, cap=1000)


def pool(spark, rows):
    return spark.createDataFrame([(n, p, s, c, float(v), False, True) for n, p, s, c, v in rows], SCHEMA)


PLAYERS = [
    ("a1", "A", None, 500, 90),
    ("a2", "A", "B", 200, 70),
    ("a3", "A", None, 100, 10),
    ("b1", "B", None, 400, 80),
    ("b2", "B", "A", 300, 60),
    ("b3", "B", None, 200, 55),
    ("b4", "B", None, 100, 20),
]


def chosen(df):
    return sorted((x["player_name"], x["assigned_position"]) for x in df.collect())


def test_best_per_slot_and_flex(spark):
    assert chosen(r.slot_topk(pool(spark, PLAYERS), RULES)) == [
        ("a1", "A"), ("a2", "FLEX"), ("b1", "B"), ("b2", "B"),
    ]


def test_locked_players_come_first(spark):
    rules = replace(RULES, locked=("a3", "b4"))
    assert chosen(r.slot_topk(pool(spark, PLAYERS), rules)) == [
        ("a1", "FLEX"), ("a3", "A"), ("b1", "B"), ("b4", "B"),
    ]


def test_the_cap_is_respected(spark):
    players = pool(spark, PLAYERS)
    roster = r.capped_roster(players, RULES)
    totals = roster_totals(roster, RULES.cap, "price", RULES.score).first()
    assert totals["players"] == RULES.size and totals["remaining"] >= 0
    assert all(x["holds"] for x in r.audit_roster(roster, players, RULES).collect())


def test_no_roster_within_the_cap_gives_none_and_the_audit_says_so(spark):
    rules = replace(RULES, cap=100)
    players = pool(spark, PLAYERS)
    roster = r.capped_roster(players, rules)
    assert roster.count() == 0
    audit = {x["rule"]: x["holds"] for x in r.audit_roster(roster, players, rules).collect()}
    assert not audit["size"] and audit["cap"]


def brute_force(rows, cap):
    """Best total over all rosters that use first positions only."""
    best = None
    for four in combinations(rows, 4):
        if sum(x[3] for x in four) > cap:
            continue
        slots = [x[1] for x in four]
        # one more than needed in either slot is the flex
        if (slots.count("A"), slots.count("B")) in ((2, 2), (1, 3)):
            score = sum(x[4] for x in four)
            best = score if best is None else max(best, score)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_rosters_against_brute_force(spark, seed):
    """Without a binding cap the roster is optimal, with one it is never above the optimum."""
    pick = random.Random(seed)
    rows = [(f"p{i:02d}", pick.choice("AB"), None, pick.randrange(50, 500), pick.randrange(100)) for i in range(12)]
    if sum(x[1] == "A" for x in rows) < 2 or sum(x[1] == "B" for x in rows) < 3:
        rows += [("x1", "A", None, 90, 5), ("x2", "A", None, 80, 5), ("y1", "B", None, 70, 5), ("y2", "B", None, 60, 5)]
    players = pool(spark, rows)

    def total(cap):
        roster = r.capped_roster(players, replace(RULES, cap=cap))
        return roster_totals(roster, cap, "price", RULES.score).first()["total_score"]

    assert total(10**6) == brute_force(rows, 10**6)
    for cap in (900, 500, 300):
        found, best = total(cap), brute_force(rows, cap)
        # empty only if no roster exists
        assert (found is None) == (best is None)
        assert found is None or found <= best


def both_positions_brute_force(rows, cap):
    """Best total over all rosters, with every way to place players in their slots."""
    best = None
    for four in combinations(rows, 4):
        if sum(x[3] for x in four) > cap:
            continue
        options = product(*[[s for s in (x[1], x[2], "FLEX") if s] for x in four])
        if any(sorted(places) == ["A", "B", "B", "FLEX"] for places in options):
            score = sum(x[4] for x in four)
            best = score if best is None else max(best, score)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_both_positions_against_brute_force(spark, seed):
    pick = random.Random(100 + seed)
    rows = [
        (f"p{i:02d}", pick.choice("ABZ"), pick.choice([None, "A", "B", "Z"]), pick.randrange(50, 500), pick.randrange(100))
        for i in range(11)
    ] + [("x1", "A", None, 90, 5), ("y1", "B", None, 70, 5), ("y2", "B", None, 60, 5)]
    players = pool(spark, rows)
    for cap in (10**6, 600, 250):
        rules = replace(RULES, cap=cap)
        roster = r.capped_roster(players, rules, both_positions=True)
        total = roster_totals(roster, cap, "price", RULES.score).first()["total_score"]
        best = both_positions_brute_force(rows, cap)
        if cap == 10**6:
            assert total == best
        assert (total is None) == (best is None)
        assert total is None or total <= best
        if total is not None:
            assert all(x["holds"] for x in r.audit_roster(roster, players, rules).collect())


def test_a_full_slot_moves_a_player_to_the_second_position():
    wishes = [("p", ("A", "B", "FLEX")), ("q", ("A", None, "FLEX")), ("r", ("A", None, "FLEX")), ("s", ("A", "FLEX"))]
    found = r.match_slots(wishes, {"A": 1, "B": 1, "FLEX": 1})
    assert sorted(found) == ["p", "q", "r"] and found["p"] == "B"


def test_locked_players_stay_in_matched_rosters(spark):
    rules = replace(RULES, locked=("a3", "b4"), cap=10**6)
    roster = r.capped_roster(pool(spark, PLAYERS), rules, both_positions=True)
    assert {"a3", "b4"} < {x["player_name"] for x in roster.collect()}


def test_scores_tie_by_name(spark):
    rows = [(n, "A", None, 10, 5) for n in ("z", "y", "x")] + [(n, "B", None, 10, 5) for n in "cdba"]
    assert chosen(r.slot_topk(pool(spark, rows), RULES)) == [
        ("a", "B"), ("b", "B"), ("c", "FLEX"), ("x", "A"),
    ]


def test_eligible_slots(spark):
    found = r.slot_eligibility(pool(spark, PLAYERS + [("u", "Z", None, 1, 1), ("v", "A", "A", 1, 1)]), RULES)
    pairs = sorted((x["player_name"], x["slot"]) for x in found.collect())
    assert pairs == [
        ("a1", "A"), ("a2", "A"), ("a2", "B"), ("a3", "A"), ("b1", "B"), ("b2", "A"), ("b2", "B"),
        ("b3", "B"), ("b4", "B"), ("v", "A"),
    ]


def test_the_audit_finds_every_fault(spark):
    players = pool(spark, PLAYERS)
    rules = replace(RULES, locked=("a1",), cap=10)
    bad = players.filter("player_name in ('a2', 'b1')").selectExpr(
        "* except (is_bye)", "true as is_bye", "'A' as assigned_position", "false as is_flex"
    )
    bad = bad.unionByName(bad.filter("player_name = 'a2'"))
    held = {x["rule"]: x["holds"] for x in r.audit_roster(bad, players, rules).collect()}
    assert set(held) == {
        "size", "cap", "flex", "repeated", "misplaced", "byes", "locked", "slot A", "slot B",
    }
    assert not any(held.values())


def test_totals_are_on_every_row(spark):
    roster = r.annotate_roster(r.slot_topk(pool(spark, PLAYERS), RULES), RULES)
    assert {(x["total_price"], x["remaining"], x["total_score"]) for x in roster.collect()} == {
        (1400, -400, 300.0)
    }


def test_each_task_forwards_a_few_rows_per_slot(spark):
    rows = r.contenders(pool(spark, PLAYERS), RULES, False)
    plan = r.penalised_rosters(rows, RULES, [0, 5])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("seed", range(3))
def test_gap_to_the_best_roster_on_pools_of_forty(spark, seed, record_property):
    """The result, the best roster there is, and the bound follow one another; the gap is reported."""
    pick = random.Random(20 + seed)
    rows = [(f"p{i:02d}", "AB"[i % 2], None, pick.randrange(50, 500), pick.randrange(100)) for i in range(40)]
    players = pool(spark, rows)
    for cap in (400, 700, 1000):
        rules = replace(RULES, cap=cap)
        found = r.capped_roster(players, rules).collect()
        total, best = sum(x["adjusted_predicted_score"] for x in found), brute_force(rows, cap)
        assert total <= best <= found[0]["score_bound"] + 1e-9
        record_property(f"gap {cap}", best - total)
        assert best - total <= 0.1 * best


@pytest.mark.parametrize("both", [False, True])
def test_the_penalty_is_the_least_whole_one_within_the_cap(spark, both):
    pick = random.Random(7)
    rows = [(f"p{i:02d}", "AB"[i % 2], "BA"[i % 2], pick.randrange(50, 500), pick.randrange(100)) for i in range(14)]
    few = r.contenders(pool(spark, rows), RULES, both).cache()
    make = r.matched_rosters if both else r.penalised_rosters
    rules = replace(RULES, cap=700)
    penalty, bound = r.cap_penalty(lambda penalties: make(few, rules, penalties), rules)

    def spent(p):
        return sum(x["price"] for x in make(few, rules, [p]).collect())

    assert spent(penalty) <= 700 and (penalty == 0 or spent(penalty - 1) > 700)
    sampled = {p: make(few, rules, [p]).collect() for p in (0, 1, penalty, 10 * penalty + 7, 1 << 30)}
    assert all(bound <= sum(x["_value"] for x in rows_) + p * 700 for p, rows_ in sampled.items())


def test_the_default_rules_are_a_squad_of_26():
    assert r.RosterRules().size == 26 and r.RosterRules().cap == 11_950_000
