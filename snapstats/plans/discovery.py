"""From fetched snapshots to the ids worth fetching next, and to the records that belong to them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from snapstats.operators.discover import (
    distinct_accounts,
    distinct_ids,
    distinct_in_order,
    request_grid,
    undiscovered,
)

PER_HERO_ENDPOINTS = ["ability_order_stats", "build_item_stats"]


class Discovery(NamedTuple):
    """Ids found, and the requests that follow from them.  An empty id frame leads to no requests."""

    heroes: DataFrame
    matches: DataFrame
    accounts: DataFrame
    hero_requests: DataFrame
    match_requests: DataFrame


def discover(hero_envelopes: DataFrame, listed_matches: DataFrame, match_details: DataFrame) -> Discovery:
    """Heroes from the hero snapshots, matches from the match list, accounts from the match details.

    Hero requests are one per hero and endpoint; match requests are the listed matches without details.
    """
    heroes = distinct_in_order(hero_envelopes, "hero_id")
    matches = distinct_ids(listed_matches, "match_id")
    return Discovery(
        heroes,
        matches,
        distinct_accounts(match_details),
        request_grid(heroes.select("hero_id"), PER_HERO_ENDPOINTS),
        undiscovered(matches, match_details, "match_id"),
    )
