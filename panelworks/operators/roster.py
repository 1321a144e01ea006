"""Slot-constrained rosters under a price cap.

The roster is found by price penalties: for a penalty ``p`` each slot takes the
players with the best ``score - p * price``. The roster of a penalty is
the best for that penalty, either over first positions alone, as plain window
ranks, or over both positions, by matching a bounded number of contenders. Its price
never grows with the penalty, so the range between the last whole penalty over the cap and
the first one within it is narrowed, a few dozen penalties a pass, until the two are neighbours; the roster of the
latter is taken. At the largest penalty only the price counts. That roster is the cheapest there is: if it is over
the cap, no full roster is within it, and if not, the result is never empty. For any penalty the value of its roster
plus the penalty times the cap is a bound on the points of every roster within the cap; the least of
them comes with the result. Scores and prices are integers inside the search, which makes it exact and repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.functions.scalars import literal_map
from panelworks.operators.joins import exclude_by_name, exclude_list
from panelworks.session import stored_table

# Players needed per slot and the price cap.
SLOTS = {"HOK": 2, "FRF": 4, "2RF": 6, "HFB": 2, "5_8": 2, "CTW": 7, "FLB": 2}
SALARY_CAP = 11_950_000
FLEX = "FLEX"

#: A penalty next to which no score counts, and how many parts a pass cuts the range of penalties into.
CHEAPEST = 1 << 30
WAYS = 64


@dataclass(frozen=True)
class RosterRules:
    slots: Mapping[str, int] = field(default_factory=lambda: dict(SLOTS))
    flex: int = 1
    cap: int = SALARY_CAP
    locked: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    player: str = "player_name"
    position: str = "position"
    secondary: str = "secondary_position"
    price: str = "price"
    score: str = "adjusted_predicted_score"

    @property
    def size(self) -> int:
        return sum(self.slots.values()) + self.flex

    @property
    def deepest(self) -> int:
        return max(self.slots.values()) + self.flex

    def is_locked(self) -> Column:
        return F.col(self.player).isin(*self.locked) if self.locked else F.lit(False)


def candidate_pool(
    predictions: DataFrame, rules: RosterRules, reserves: DataFrame | None = None
) -> DataFrame:
    """Likely players that are not reserves, not excluded and not in a bye."""
    pool = predictions.filter(F.col("likely_to_play") & ~F.col("is_bye"))
    if reserves is not None:
        listed = reserves.filter(F.col("status") == "reserve")
        pool = exclude_by_name(pool, listed, player=rules.player)
    return exclude_list(pool, rules.excluded, rules.player)


def slot_eligibility(pool: DataFrame, rules: RosterRules) -> DataFrame:
    """One row per player and slot the player may fill, with the slot's need."""
    both = F.array_distinct(F.array(F.col(rules.position), F.col(rules.secondary)))
    rows = pool.withColumn("slot", F.explode(both))
    return rows.withColumn("need", slot_need("slot", rules)).filter(F.col("need").isNotNull())


def slot_need(col: str, rules: RosterRules) -> Column:
    return F.try_element_at(literal_map(rules.slots), F.col(col))


def _fill_slots(pool: DataFrame, rules: RosterRules, value: str, per: list[str]) -> DataFrame:
    """Best players per slot, then the best of the rest as flex, for each ``per``.

    Only the top ``deepest`` rows of a slot can be chosen, and that limit applies
    in each map task before the shuffle, so a slot may hold any share of the rows.
    """
    best = [F.col("_locked").desc(), F.col(value).desc(), F.col(rules.player)]
    in_slot = Window.partitionBy(*per, rules.position).orderBy(*best)
    ranked = (
        pool.withColumn("_locked", rules.is_locked())
        .withColumn("_place", F.row_number().over(in_slot))
        .filter(F.col("_place") <= rules.deepest)
    )
    need = F.coalesce(slot_need(rules.position, rules), F.lit(0))
    spare = F.col("_place") - need
    ranked = ranked.withColumn("is_flex", spare > 0).filter(spare <= rules.flex)
    rest = Window.partitionBy(*per, "is_flex").orderBy(*best)
    return (
        ranked.withColumn("_rest", F.row_number().over(rest))
        .filter(~F.col("is_flex") | (F.col("_rest") <= rules.flex))
        .withColumn(
            "assigned_position",
            F.when(F.col("is_flex"), F.lit(FLEX)).otherwise(F.col(rules.position)),
        )
        .drop("_locked", "_place", "_rest")
    )


def slot_topk(pool: DataFrame, rules: RosterRules) -> DataFrame:
    """Locked players and best scores per slot plus the flex, price ignored."""
    return _fill_slots(pool, rules, rules.score, [])


def contenders(pool: DataFrame, rules: RosterRules, both_positions: bool) -> DataFrame:
    """Candidates that some penalty may choose, with their whole-number points.

    Of the candidates with the same positions and price, only so many of the best can be chosen under any penalty as
    the slots have room.
    """
    positions = [rules.position, *([rules.secondary] if both_positions else [])]
    most = rules.size if both_positions else rules.deepest
    alike = Window.partitionBy(*positions, rules.price).orderBy(
        F.col("_locked").desc(), F.col("_points").desc(), F.col(rules.player)
    )
    return (
        pool.withColumn("_points", F.round(F.col(rules.score) * 1000).cast("bigint"))
        .withColumn("_locked", rules.is_locked())
        .withColumn("_alike", F.row_number().over(alike))
        .filter(F.col("_alike") <= most)
        .drop("_alike", "_locked")
    )


def _valued(pool: DataFrame, rules: RosterRules, penalties: Sequence[int]) -> DataFrame:
    """Each contender once per price penalty (thousandths of a point per 1000 of price), with its value."""
    price = F.col(rules.price).cast("bigint")
    grid = F.array(*[F.lit(p).cast("bigint") for p in penalties])
    return pool.withColumn("penalty", F.explode(grid)).withColumn(
        "_value", F.col("_points") * 1000 - F.col("penalty") * price
    )


def penalised_rosters(pool: DataFrame, rules: RosterRules, penalties: Sequence[int]) -> DataFrame:
    """One roster of the contenders per price penalty, from first positions."""
    return _fill_slots(_valued(pool, rules, penalties), rules, "_value", ["penalty"])


def matched_rosters(pool: DataFrame, rules: RosterRules, penalties: Sequence[int]) -> DataFrame:
    """One roster of the contenders per price penalty, from first and second positions.

    For a given penalty the roster is the best there is. Only the ``size`` best
    players of a slot can be in it, so the matching sees at most
    (slots + 1) x size players per penalty, for any number of candidates.
    """
    best = [F.col("_locked").desc(), F.col("_value").desc(), F.col(rules.player)]
    positions = F.array(F.col(rules.position), F.col(rules.secondary))
    usable = F.filter(positions, lambda p: p.isin(*rules.slots))
    in_slot = Window.partitionBy("penalty", "_slot").orderBy(*best)
    best_of = (
        _valued(pool, rules, penalties)
        .withColumn("_locked", rules.is_locked())
        .withColumn("_slot", F.explode(F.array_union(usable, F.array(F.lit(FLEX)))))
        .withColumn("_place", F.row_number().over(in_slot))
        .filter(F.col("_place") <= rules.size)
        .drop("_slot", "_place")
    )
    # a contender of several slots is one; of two rows with one name the better one counts
    one = Window.partitionBy("penalty", rules.player).orderBy(
        F.col("_value").desc(), F.col(rules.price), F.col(rules.position), F.col(rules.secondary)
    )
    best_of = best_of.withColumn("_one", F.row_number().over(one)).filter("_one = 1").drop("_one")
    room = {**rules.slots, FLEX: rules.flex}

    def match(group: pd.DataFrame) -> pd.DataFrame:
        ranked = group.sort_values(["_locked", "_value", "player"], ascending=[False, False, True])
        wishes = zip(ranked["player"], ranked["first"], ranked["second"])
        assigned = match_slots(((name, (p, q, FLEX)) for name, p, q in wishes), room)
        return pd.DataFrame(
            [(ranked["penalty"].iloc[0], name, slot) for name, slot in assigned.items()],
            columns=["penalty", "player", "assigned_position"],
        )

    chosen = (
        best_of.select(
            "penalty",
            F.col(rules.player).alias("player"),
            F.col(rules.position).alias("first"),
            F.col(rules.secondary).alias("second"),
            "_locked",
            "_value",
        )
        .groupBy("penalty")
        .applyInPandas(match, "penalty bigint, player string, assigned_position string")
        .withColumnRenamed("player", rules.player)
    )
    rosters = best_of.join(chosen, ["penalty", rules.player])
    return rosters.withColumn("is_flex", F.col("assigned_position") == FLEX).drop("_locked")


def match_slots(
    wishes: Iterable[tuple[str, tuple[str | None, ...]]], room: Mapping[str, int]
) -> dict[str, str]:
    """Take players in order, each if there is a slot for all taken so far.

    A player who finds the slots full may move others to their other slots.
    Taking the best first this way gives the set of the highest total value.
    """
    slots: dict[str, list[str]] = {slot: [] for slot in room}
    wanted: dict[str, list[str]] = {}

    def place(player: str, tried: set[str]) -> bool:
        for slot in wanted[player]:
            if slot in tried:
                continue
            tried.add(slot)
            if len(slots[slot]) < room[slot]:
                slots[slot].append(player)
                return True
            for other in list(slots[slot]):
                if place(other, tried):
                    slots[slot].remove(other)
                    slots[slot].append(player)
                    return True
        return False

    for player, choices in wishes:
        wanted[player] = [slot for slot in dict.fromkeys(choices) if slot in slots]
        place(player, set())
    return {player: slot for slot, players in slots.items() for player in players}


def cap_penalty(
    rosters_of: Callable[[Sequence[int]], DataFrame], rules: RosterRules
) -> tuple[int, int] | None:
    """The least whole penalty whose roster is full and within the cap, and the bound on the points of any such
    roster, in millionths; None if there is no such roster.

    ``rosters_of`` gives the rosters of some penalties. The first pass tries the powers of two, each further one cuts
    the range that is left into ``WAYS`` parts; a pass brings one row per penalty to the driver.
    """
    tried = [0, *(1 << k for k in range(CHEAPEST.bit_length()))]
    over, bound = -1, None
    while True:
        totals = rosters_of(tried).groupBy("penalty").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(rules.price).cast("bigint")).alias("spent"),
            F.sum("_value").alias("value"),
        )
        found = {r["penalty"]: r for r in totals.collect()}
        full = [p for p in tried if p in found and found[p]["n"] == rules.size]
        within = [p for p in full if found[p]["spent"] <= rules.cap]
        if not within:
            return None
        first = min(within)
        over = max([over, *(p for p in full if p < first)])
        bounds = [found[p]["value"] + p * rules.cap for p in full if p in (over, first)]
        bound = min(bounds if bound is None else [bound, *bounds])
        if first - over == 1:
            return first, bound
        step = -(-(first - over - 1) // WAYS)
        tried = sorted({min(first, over + 1 + k * step) for k in range(WAYS + 1)})


def capped_roster(pool: DataFrame, rules: RosterRules, both_positions: bool = False) -> DataFrame:
    """The roster of the least penalty within the cap; empty only if no full roster is within it.

    ``score_bound`` is a total score that no roster within the cap exceeds, scores counted in thousandths.
    """
    few = stored_table(contenders(pool, rules, both_positions))
    make = matched_rosters if both_positions else penalised_rosters
    found = cap_penalty(lambda penalties: make(few, rules, penalties), rules)
    penalty, bound = found or (CHEAPEST, 0)
    roster = make(few, rules, [penalty]).drop("penalty", "_points", "_value")
    roster = roster.withColumn("score_bound", F.lit(bound / 1e6))
    return roster if found else roster.limit(0)


def audit_roster(roster: DataFrame, pool: DataFrame, rules: RosterRules) -> DataFrame:
    """One row per rule: what was found, what is needed, and whether it holds."""
    assigned = F.col("assigned_position")
    fits_slot = (
        (assigned == FLEX)
        | (assigned == F.col(rules.position))
        | F.coalesce(assigned == F.col(rules.secondary), F.lit(False))
    )
    measured = roster.agg(
        F.count(F.lit(1)).alias("size"),
        F.coalesce(F.sum(rules.price), F.lit(0)).cast("bigint").alias("price"),
        F.count_if(F.col("is_flex")).alias("flex"),
        (F.count(F.lit(1)) - F.count_distinct(rules.player)).alias("repeated"),
        F.count_if(~fits_slot).alias("misplaced"),
        F.count_if(F.col("is_bye")).alias("byes"),
        F.count_if(rules.is_locked()).alias("locked"),
        *[F.count_if(assigned == s).alias(f"slot {s}") for s in rules.slots],
    )
    wanted = pool.filter(rules.is_locked()).agg(F.count(F.lit(1)).alias("n")).scalar()

    def rule(name: str, found: str, needed: int | Column, at_most: bool = False) -> Column:
        need = F.lit(needed) if isinstance(needed, int) else needed
        holds = F.col(found) <= need if at_most else F.col(found) == need
        return F.struct(
            F.lit(name).alias("rule"),
            F.col(found).cast("bigint").alias("found"),
            need.cast("bigint").alias("needed"),
            holds.alias("holds"),
        )

    checks = [
        rule("size", "size", rules.size),
        rule("cap", "price", rules.cap, at_most=True),
        rule("flex", "flex", rules.flex),
        rule("repeated", "repeated", 0),
        rule("misplaced", "misplaced", 0),
        rule("byes", "byes", 0),
        rule("locked", "locked", wanted),
        *[rule(f"slot {s}", f"slot {s}", n) for s, n in rules.slots.items()],
    ]
    return measured.select(F.explode(F.array(*checks)).alias("_rule")).select("_rule.*")


def annotate_roster(roster: DataFrame, rules: RosterRules) -> DataFrame:
    """Roster rows with the totals of the whole roster."""
    everyone = Window.partitionBy(F.lit(0))
    total = F.sum(F.col(rules.price).cast("bigint")).over(everyone)
    return roster.select(
        "*",
        total.alias("total_price"),
        (F.lit(rules.cap) - total).alias("remaining"),
        F.sum(rules.score).over(everyone).alias("total_score"),
    )
