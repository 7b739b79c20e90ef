"""Values that must equal those of the served data for results to be right.

Fixed values: endpoint modes, queryable collections, hero names and column labels.
"""

# Endpoint name -> processing mode.
ENDPOINT_MODES = {
    "hero_stats": "hero",
    "item_stats": "item",
    "hero_counter_stats": "generic",
    "hero_synergy_stats": "generic",
    "hero_comb_stats": "generic",
    "badge_distribution": "generic",
    "kill_death_stats": "generic",
    "player_performance_curve": "generic",
    "player_stat_metrics": "generic",
    "ability_order_stats": "generic",
    "build_item_stats": "generic",
    "search_builds": "generic",
    "bulk_metadata": "shallow",
    "match_metadata": "shallow",
    "hero_scoreboard": "generic",
    "player_scoreboard": "generic",
    "match_history": "shallow",
}

# Fixed values: (collection, category, needs a hero filter before it is shown).
QUERYABLE_COLLECTIONS = [
    ("hero_stats", "Heroes", False),
    ("item_stats", "Items", False),
    ("hero_counter_stats", "Matchups", False),
    ("hero_synergy_stats", "Matchups", False),
    ("ability_order_stats", "Builds", True),
    ("build_item_stats", "Builds", True),
    ("search_builds", "Builds", False),
    ("bulk_metadata", "Matches", False),
    ("match_metadata", "Matches", False),
    ("match_history", "Matches", False),
    ("hero_scoreboard", "Leaderboards", False),
    ("player_scoreboard", "Leaderboards", False),
    ("badge_distribution", "Analytics", False),
    ("player_performance_curve", "Analytics", False),
    ("player_stat_metrics", "Analytics", False),
]

# Hero id -> hero name.
HERO_NAMES = {
    1: "Infernus", 2: "Seven", 3: "Vindicta", 4: "Lady Geist", 6: "Abrams", 7: "Wraith",
    8: "McGinnis", 10: "Paradox", 11: "Dynamo", 12: "Kelvin", 13: "Haze", 14: "Holliday",
    15: "Bebop", 16: "Calico", 17: "Grey Talon", 18: "Mo & Krill", 19: "Shiv", 20: "Ivy",
    21: "Kali", 25: "Warden", 27: "Yamato", 31: "Lash", 35: "Viscous", 38: "Gunslinger",
    39: "The Boss", 47: "Tokamak", 48: "Wrecker", 49: "Rutger", 50: "Pocket", 51: "Thumper",
    52: "Mirage", 53: "Fathom", 54: "Cadence", 56: "Bomber", 57: "Shield Guy", 58: "Vyper",
    59: "Vandal", 60: "Sinclair", 61: "Trapper", 62: "Raven", 63: "Mina", 64: "Drifter",
    65: "Venator", 66: "Victor", 67: "Paige", 68: "Boho", 69: "The Doorman", 70: "Skyrunner",
    71: "Swan", 72: "Billy", 73: "Druid", 74: "Graf", 75: "Fortuna", 76: "Graves",
    77: "Apollo", 78: "Airheart", 79: "Rem", 80: "Silver", 81: "Celeste", 82: "Opera",
}

# Column name -> display label.
COLUMN_LABELS = {
    "hero_id": "Hero",
    "counter_hero_id": "Counter Hero",
    "synergy_hero_id": "Synergy Hero",
    "total_wins": "Wins",
    "total_losses": "Losses",
    "total_matches": "Matches",
    "win_rate": "Win Rate",
    "last_updated": "Last Updated",
    "fetched_at": "Fetched At",
    "item_id": "Item ID",
    "account_id": "Account ID",
    "match_id": "Match ID",
    "wins": "Wins",
    "losses": "Losses",
    "matches": "Matches",
}

# Win-rate bands in percent, page sizes, and the item count of one landing block.
HIGH_BAND_FROM = 52
MID_BAND_FROM = 48
PAGE_SIZE, MAX_PAGE_SIZE = 50, 200
TOP_SIZE, MAX_TOP_SIZE = 200, 500
BLOCK_ITEMS = 500

MISSING = "—"
ELLIPSIS = "…"
NAME_NOT_FOUND = "ID Not Found"
