"""Column roles of a panel: one row per entity, season and sequence position."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Panel:
    """Names the columns an operator needs, so no operator hard-codes a domain.

    ``seq`` orders the rows of one (entity, season) and should end in a unique
    tie-breaker; ``timeline`` orders rows across seasons.
    """

    entity: tuple[str, ...] = ("player_name",)
    season: tuple[str, ...] = ("year",)
    seq: tuple[str, ...] = ("round",)
    round: str = "round"
    score: str = "score"
    break_even: str = "break_even"
    price: str = "price"
    price_change: str = "round_price_change"
    avg_score: str = "avg_score"
    mins: str = "mins"
    team: str = "team"
    opponent: str = "opponent"
    position: str = "primary_position"

    @property
    def keys(self) -> list[str]:
        return [*self.entity, *self.season]

    @property
    def timeline(self) -> list[str]:
        return [*self.season, *self.seq]
