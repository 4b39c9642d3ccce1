"""Row classifications (CASE chains) of the staging and analytics models.

All are plain ``when`` chains so they stay inside whole-stage codegen.  The
labels, codes and thresholds are fixed values of the source models and are
kept together here, in their original order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source models for identical results)
# ---------------------------------------------------------------------------

# Game length buckets, seconds, upper bound exclusive; the rest is 'very_long'.
DURATION_BUCKETS = [(900, "short"), (1800, "medium"), (2700, "long")]
DURATION_OTHER = "very_long"

# Queue id → label; any other id (or NULL) is 'Other'.
QUEUE_LABELS = [
    (420, "Ranked Solo/Duo"),
    (440, "Ranked Flex"),
    (400, "Normal Draft"),
    (430, "Normal Blind"),
    (450, "ARAM"),
]
QUEUE_OTHER = "Other"

# Team id → side.
TEAM_SIDES = [(100, "Blue"), (200, "Red")]
TEAM_OTHER = "Unknown"

# Raw role values → standardised role.  'Jungle' also needs lane = 'JUNGLE'.
ROLE_TOP = ["TOP"]
ROLE_JUNGLE = ["JUNGLE", "NONE"]
LANE_JUNGLE = "JUNGLE"
ROLE_MID = ["MIDDLE", "MID"]
ROLE_ADC = ["BOTTOM", "CARRY"]
ROLE_SUPPORT = ["UTILITY", "SUPPORT"]
ROLE_OTHER = "Unknown"
STANDARD_ROLES = ["Top", "Jungle", "Mid", "ADC", "Support", ROLE_OTHER]

# KDA rating: 'Perfect' needs deaths = 0 and kills + assists > 5; then the
# ratio (kills + assists) / deaths against these lower bounds; else 'Poor'.
KDA_PERFECT_MIN_TAKEDOWNS = 5
KDA_RATINGS = [(3, "Excellent"), (2, "Good"), (1, "Average")]
KDA_OTHER = "Poor"

# CS rating on the rounded cs per minute (lower bounds); else 'Poor'.
CS_RATINGS = [(8, "Excellent"), (6, "Good"), (4, "Average")]
CS_OTHER = "Poor"

# Champion tier: (min win rate, min games) → tier; else 'D'.
CHAMPION_TIERS = [(53, 50, "S"), (51, 30, "A"), (49, 20, "B"), (47, 10, "C")]
TIER_OTHER = "D"

# Skill tier from the KDA percentile (lower bounds); else 'Learning'.
SKILL_TIERS = [(0.9, "Elite"), (0.7, "Advanced"), (0.5, "Intermediate"),
               (0.3, "Beginner")]
SKILL_OTHER = "Learning"

# Activity from days since the last game (upper bounds, inclusive).
ACTIVITY = [(7, "Active"), (30, "Occasional")]
ACTIVITY_OTHER = "Inactive"

# Recent-games window of the player report, days.
RECENT_DAYS = 30

# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chain(pairs, other) -> Column:
    expr = None
    for cond, label in pairs:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(other)


def duration_bucket(seconds) -> Column:
    s = _col(seconds)
    return _chain([(s < bound, label) for bound, label in DURATION_BUCKETS],
                  DURATION_OTHER)


def queue_label(queue_id) -> Column:
    q = _col(queue_id)
    return _chain([(q == code, label) for code, label in QUEUE_LABELS], QUEUE_OTHER)


def team_side(team_id) -> Column:
    t = _col(team_id)
    return _chain([(t == code, label) for code, label in TEAM_SIDES], TEAM_OTHER)


def standardized_role(role, lane) -> Column:
    """Uses the raw role and lane (before any COALESCE)."""
    r, ln = _col(role), _col(lane)
    return _chain([
        (r.isin(ROLE_TOP), "Top"),
        (r.isin(ROLE_JUNGLE) & (ln == LANE_JUNGLE), "Jungle"),
        (r.isin(ROLE_MID), "Mid"),
        (r.isin(ROLE_ADC), "ADC"),
        (r.isin(ROLE_SUPPORT), "Support"),
    ], ROLE_OTHER)


def kda_rating(kills, deaths, assists) -> Column:
    """Exact comparison of the unrounded ratio: (k+a)/d >= x  ⇔  k+a >= x·d.

    deaths = 0 with few takedowns gives a NULL ratio and falls to 'Poor'.
    """
    k, d, a = _col(kills), _col(deaths), _col(assists)
    takedowns = k + a
    pairs = [((d == 0) & (takedowns > KDA_PERFECT_MIN_TAKEDOWNS), "Perfect")]
    pairs += [(((d > 0) & (takedowns >= d * bound))
               | ((d < 0) & (takedowns <= d * bound)), label)
              for bound, label in KDA_RATINGS]
    return _chain(pairs, KDA_OTHER)


def cs_rating(cs_per_min, scale: int = 0) -> Column:
    """On the rounded rate; ``scale`` > 0 when it is given as an integer
    ``rate × 10^scale``."""
    c = _col(cs_per_min)
    return _chain([(c >= bound * 10 ** scale, label) for bound, label in CS_RATINGS],
                  CS_OTHER)


def champion_tier(win_rate, total_games) -> Column:
    w, g = _col(win_rate), _col(total_games)
    return _chain([((w >= wr) & (g >= games), tier)
                   for wr, games, tier in CHAMPION_TIERS], TIER_OTHER)


def skill_tier(kda_percentile) -> Column:
    p = _col(kda_percentile)
    return _chain([(p >= bound, label) for bound, label in SKILL_TIERS], SKILL_OTHER)


def activity_status(days_since_last_game) -> Column:
    d = _col(days_since_last_game)
    return _chain([(d <= bound, label) for bound, label in ACTIVITY], ACTIVITY_OTHER)
