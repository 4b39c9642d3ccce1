"""DuckDB SQL that recomputes each registered query from the driver tables.

Used by ``__spark_entry__.oracle_sql()`` as the independent correctness check.
The stand-in raw tables are rebuilt with the same expressions as
``sources/adapter.py``; every model is then written as plain SQL.  Exact
rounding uses the integer half-up form (DuckDB would turn decimal division into
DOUBLE); decimals leave as DOUBLE, counts as BIGINT, matching the Spark side's
output boundary (``plans/registry.py``).
"""

from __future__ import annotations

AS_OF_DATE = "2001-11-05"


def hu(num: str, den: str) -> str:
    """round(num / den) half away from zero, integers (den may be NULL)."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
            f" * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))))")


def dec(q: str, scale: int) -> str:
    """Integer q as the double q / 10^scale."""
    return f"(CAST(({q}) AS DOUBLE) / {10 ** scale})" if scale else f"CAST(({q}) AS DOUBLE)"


def rmean(col: str, scale: int, in_scale: int = 0) -> str:
    """ROUND(AVG(col), scale) for an integer column holding col × 10^in_scale."""
    shift = scale - in_scale
    num = f"sum({col})" + (f" * {10 ** shift}" if shift > 0 else "")
    den = f"count({col})" + (f" * {10 ** (-shift)}" if shift < 0 else "")
    return dec(hu(num, den), scale)


RAW = """
raw_matches AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
         epoch_ms(o_orderdate) AS game_creation,
         CAST(((CAST(floor(o_totalprice) AS BIGINT) % 3600) + 3600) % 3600 AS INTEGER) AS game_duration,
         'CLASSIC' AS game_mode,
         'MATCHED_GAME' AS game_type,
         '14.' || CAST(month(o_orderdate) AS VARCHAR) AS game_version,
         CASE o_orderstatus WHEN 'F' THEN 'euw1' WHEN 'O' THEN 'na1' WHEN 'P' THEN 'kr' END AS platform_id,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 420 WHEN '2-HIGH' THEN 440
              WHEN '3-MEDIUM' THEN 400 WHEN '4-NOT SPECIFIED' THEN 450 WHEN '5-LOW' THEN 0 END
              AS INTEGER) AS queue_id,
         CAST(o_orderdate AS TIMESTAMP) AS loaded_at
  FROM orders
),
raw_lines AS (
  SELECT l.*, o.o_custkey, p.p_brand, p.p_size,
         CASE p.p_type WHEN 'ECONOMY' THEN 'TOP' WHEN 'LARGE' THEN 'JUNGLE'
              WHEN 'MEDIUM' THEN 'MIDDLE' WHEN 'PROMO' THEN 'BOTTOM'
              WHEN 'SMALL' THEN 'UTILITY' WHEN 'STANDARD' THEN '' END AS role_
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN part p ON l.l_partkey = p.p_partkey
),
raw_participants AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id,
         CAST(l_orderkey AS VARCHAR) AS match_id,
         CAST(o_custkey AS VARCHAR) AS puuid,
         CASE WHEN l_linenumber <> 7 THEN 'player_' || CAST(o_custkey AS VARCHAR) || '_' || l_returnflag END AS summoner_name,
         CAST(CAST(substr(p_brand, 7, 10) AS INTEGER) * 100 + p_size AS INTEGER) AS champion_id,
         p_brand || '_' || CAST(p_size AS VARCHAR) AS champion_name,
         CAST(CASE WHEN l_linenumber % 2 = 1 THEN 100 ELSE 200 END AS INTEGER) AS team_id,
         role_ AS role,
         CASE WHEN role_ = 'JUNGLE' AND l_returnflag <> 'R' THEN 'JUNGLE' ELSE '' END AS lane,
         CAST(floor(l_quantity) AS INTEGER) AS kills,
         CAST(l_linenumber - 1 AS INTEGER) AS deaths,
         CAST(round(l_discount * 100) AS INTEGER) AS assists,
         CAST(floor(l_extendedprice) AS INTEGER) AS gold_earned,
         CAST((l_partkey * 37 + l_suppkey) % 40000 AS INTEGER) AS total_damage_dealt,
         CAST((l_suppkey * 91 + l_partkey) % 40000 AS INTEGER) AS total_damage_taken,
         CAST(l_linenumber * 5 AS INTEGER) AS vision_score,
         CAST(floor(l_quantity) AS INTEGER) * 4 AS cs,
         l_linestatus = 'O' AS win,
         CAST(l_shipdate AS TIMESTAMP) AS loaded_at
  FROM raw_lines
)"""

STAGING = f"""
stg_matches AS (
  SELECT match_id,
         platform_id AS region,
         make_timestamp(CAST((game_creation // 1000) * 1000000 AS BIGINT)) AS game_datetime,
         CAST(make_timestamp(CAST((game_creation // 1000) * 1000000 AS BIGINT)) AS DATE) AS game_date,
         game_creation AS game_creation_timestamp,
         game_mode, game_type, queue_id, game_version,
         game_duration AS duration_seconds,
         {hu('game_duration * 10', '60')} AS dur10,
         CASE WHEN game_duration < 900 THEN 'short'
              WHEN game_duration < 1800 THEN 'medium'
              WHEN game_duration < 2700 THEN 'long'
              ELSE 'very_long' END AS game_length_category,
         CASE WHEN queue_id = 420 THEN 'Ranked Solo/Duo'
              WHEN queue_id = 440 THEN 'Ranked Flex'
              WHEN queue_id = 400 THEN 'Normal Draft'
              WHEN queue_id = 430 THEN 'Normal Blind'
              WHEN queue_id = 450 THEN 'ARAM'
              ELSE 'Other' END AS queue_type,
         loaded_at
  FROM raw_matches
  WHERE game_duration > 0 AND game_creation > 0
),
stg_p0 AS (
  SELECT p.id AS participant_id, p.match_id, p.puuid,
         COALESCE(p.summoner_name, 'Unknown') AS summoner_name,
         p.champion_id, p.champion_name, p.team_id,
         CASE WHEN p.team_id = 100 THEN 'Blue' WHEN p.team_id = 200 THEN 'Red' ELSE 'Unknown' END AS team_side,
         COALESCE(p.role, 'UNKNOWN') AS role,
         COALESCE(p.lane, 'UNKNOWN') AS lane,
         CASE WHEN p.role = 'TOP' THEN 'Top'
              WHEN p.role IN ('JUNGLE', 'NONE') AND p.lane = 'JUNGLE' THEN 'Jungle'
              WHEN p.role IN ('MIDDLE', 'MID') THEN 'Mid'
              WHEN p.role IN ('BOTTOM', 'CARRY') THEN 'ADC'
              WHEN p.role IN ('UTILITY', 'SUPPORT') THEN 'Support'
              ELSE 'Unknown' END AS standardized_role,
         p.kills, p.deaths, p.assists,
         CASE WHEN p.deaths = 0 THEN (p.kills + p.assists) * 100
              ELSE {hu('(p.kills + p.assists) * 100', 'p.deaths')} END AS kda100,
         CASE WHEN p.deaths = 0 AND (p.kills + p.assists) > 5 THEN 'Perfect'
              WHEN (p.kills + p.assists) / NULLIF(p.deaths, 0) >= 3 THEN 'Excellent'
              WHEN (p.kills + p.assists) / NULLIF(p.deaths, 0) >= 2 THEN 'Good'
              WHEN (p.kills + p.assists) / NULLIF(p.deaths, 0) >= 1 THEN 'Average'
              ELSE 'Poor' END AS kda_rating,
         p.gold_earned,
         p.total_damage_dealt AS damage_dealt,
         p.total_damage_taken AS damage_taken,
         p.cs AS total_cs,
         {hu('p.cs * 100', 'NULLIF(m.dur10, 0)')} AS cs_per_min10,
         p.vision_score,
         {hu('p.vision_score * 100', 'NULLIF(m.dur10, 0)')} AS vision_per_min10,
         p.win,
         {hu('p.gold_earned * 10', 'NULLIF(m.dur10, 0)')} AS gold_per_min,
         {hu('p.total_damage_dealt * 100', 'NULLIF(p.gold_earned, 0)')} AS damage_per_gold100,
         p.loaded_at
  FROM raw_participants p
  JOIN stg_matches m ON p.match_id = m.match_id
  WHERE p.kills >= 0 AND p.deaths >= 0 AND p.assists >= 0 AND p.champion_name IS NOT NULL
),
stg_participants AS (
  SELECT *,
         CASE WHEN cs_per_min10 >= 80 THEN 'Excellent'
              WHEN cs_per_min10 >= 60 THEN 'Good'
              WHEN cs_per_min10 >= 40 THEN 'Average'
              ELSE 'Poor' END AS cs_rating
  FROM stg_p0
)"""

CHAMPIONS = f"""
champ_mode AS (
  SELECT champion_name, champion_id, standardized_role AS most_played_role FROM (
    SELECT champion_name, champion_id, standardized_role,
           row_number() OVER (PARTITION BY champion_name, champion_id
                              ORDER BY count(*) DESC, standardized_role) AS rn
    FROM stg_participants WHERE standardized_role IS NOT NULL
    GROUP BY champion_name, champion_id, standardized_role) t
  WHERE rn = 1
),
dim_champions AS (
  SELECT a.*, m.most_played_role FROM (
    SELECT champion_name, champion_id,
           count(*) AS total_games,
           count(DISTINCT match_id) AS total_matches,
           CAST(sum(CASE WHEN win THEN 1 ELSE 0 END) AS BIGINT) AS total_wins,
           {hu('count_if(win) * 10000', 'count(*)')} AS win_rate100,
           {rmean('kills', 2)} AS avg_kills,
           {rmean('deaths', 2)} AS avg_deaths,
           {rmean('assists', 2)} AS avg_assists,
           {hu('sum(kda100)', 'count(kda100)')} AS avg_kda100,
           {rmean('total_cs', 1)} AS avg_cs,
           {rmean('cs_per_min10', 1, 1)} AS avg_cs_per_min,
           {rmean('damage_dealt', 0)} AS avg_damage_dealt,
           {rmean('damage_taken', 0)} AS avg_damage_taken,
           {rmean('gold_earned', 0)} AS avg_gold_earned,
           {rmean('vision_score', 1)} AS avg_vision_score,
           min(loaded_at) AS first_seen,
           max(loaded_at) AS last_seen,
           count(DISTINCT puuid) AS unique_players
    FROM stg_participants
    GROUP BY champion_name, champion_id) a
  LEFT JOIN champ_mode m
    ON a.champion_name IS NOT DISTINCT FROM m.champion_name
   AND a.champion_id IS NOT DISTINCT FROM m.champion_id
),
champion_stats AS (
  SELECT c.*,
         {hu('c.total_games * 10000', '(SELECT count(DISTINCT match_id) FROM stg_participants)')} AS pick_rate100,
         rank() OVER (ORDER BY c.win_rate100 DESC NULLS FIRST) AS winrate_rank,
         rank() OVER (ORDER BY c.total_games DESC NULLS FIRST) AS popularity_rank,
         CASE WHEN c.win_rate100 >= 5300 AND c.total_games >= 50 THEN 'S'
              WHEN c.win_rate100 >= 5100 AND c.total_games >= 30 THEN 'A'
              WHEN c.win_rate100 >= 4900 AND c.total_games >= 20 THEN 'B'
              WHEN c.win_rate100 >= 4700 AND c.total_games >= 10 THEN 'C'
              ELSE 'D' END AS tier
  FROM dim_champions c
)"""

SUMMONERS = f"""
player_role_mode AS (
  SELECT puuid, standardized_role AS preferred_role FROM (
    SELECT puuid, standardized_role,
           row_number() OVER (PARTITION BY puuid ORDER BY count(*) DESC, standardized_role) AS rn
    FROM stg_participants WHERE standardized_role IS NOT NULL
    GROUP BY puuid, standardized_role) t WHERE rn = 1
),
player_champ_mode AS (
  SELECT puuid, champion_name AS most_played_champion FROM (
    SELECT puuid, champion_name,
           row_number() OVER (PARTITION BY puuid ORDER BY count(*) DESC, champion_name) AS rn
    FROM stg_participants WHERE champion_name IS NOT NULL
    GROUP BY puuid, champion_name) t WHERE rn = 1
),
summ_agg AS (
  SELECT puuid,
         max(summoner_name) AS summoner_name,
         count(*) AS total_games,
         count(DISTINCT match_id) AS total_matches,
         count(DISTINCT champion_name) AS unique_champions_played,
         CAST(sum(CASE WHEN win THEN 1 ELSE 0 END) AS BIGINT) AS total_wins,
         {hu('count_if(win) * 10000', 'count(*)')} AS win_rate100,
         {rmean('kills', 2)} AS avg_kills,
         {rmean('deaths', 2)} AS avg_deaths,
         {rmean('assists', 2)} AS avg_assists,
         {hu('sum(kda100)', 'count(kda100)')} AS avg_kda100,
         {rmean('gold_earned', 0)} AS avg_gold,
         {rmean('gold_per_min', 0)} AS avg_gold_per_min,
         {rmean('damage_dealt', 0)} AS avg_damage,
         {rmean('damage_taken', 0)} AS avg_damage_taken,
         {rmean('total_cs', 1)} AS avg_cs,
         {rmean('cs_per_min10', 1, 1)} AS avg_cs_per_min,
         {rmean('vision_score', 1)} AS avg_vision_score,
         min(loaded_at) AS first_game,
         max(loaded_at) AS last_game,
         CAST(sum(kda100) AS DOUBLE) / (CAST(count(kda100) AS DOUBLE) * 100.0) AS kda_key,
         CAST(count_if(win) AS DOUBLE) / count(*) AS wr_key
  FROM stg_participants
  GROUP BY puuid
),
dim_summoners AS (
  SELECT a.*, r.preferred_role, c.most_played_champion,
         percent_rank() OVER (ORDER BY a.kda_key ASC NULLS LAST) AS kda_percentile,
         percent_rank() OVER (ORDER BY a.wr_key ASC NULLS LAST) AS winrate_percentile
  FROM summ_agg a
  LEFT JOIN player_role_mode r ON a.puuid IS NOT DISTINCT FROM r.puuid
  LEFT JOIN player_champ_mode c ON a.puuid IS NOT DISTINCT FROM c.puuid
),
recent AS (
  SELECT puuid, count(*) AS games_last_30_days
  FROM stg_participants
  WHERE loaded_at >= CAST(DATE '{AS_OF_DATE}' - INTERVAL 30 DAY AS TIMESTAMP)
  GROUP BY puuid
),
player_performance AS (
  SELECT p.*, COALESCE(r.games_last_30_days, 0) AS recent_games,
         CAST(ntile(10) OVER (ORDER BY p.avg_kda100 ASC NULLS LAST, p.puuid ASC NULLS LAST) AS INTEGER) AS kda_decile,
         CAST(ntile(10) OVER (ORDER BY p.win_rate100 ASC NULLS LAST, p.puuid ASC NULLS LAST) AS INTEGER) AS winrate_decile,
         CASE WHEN p.kda_percentile >= 0.9 THEN 'Elite'
              WHEN p.kda_percentile >= 0.7 THEN 'Advanced'
              WHEN p.kda_percentile >= 0.5 THEN 'Intermediate'
              WHEN p.kda_percentile >= 0.3 THEN 'Beginner'
              ELSE 'Learning' END AS skill_tier,
         CAST(DATE '{AS_OF_DATE}' - CAST(p.last_game AS DATE) AS INTEGER) AS days_since_last_game
  FROM dim_summoners p
  LEFT JOIN recent r ON p.puuid = r.puuid
)"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip().rstrip(",") for b in blocks)


BASE = with_ctes(RAW, STAGING)
CHAMP = with_ctes(RAW, STAGING, CHAMPIONS)
PLAYER = with_ctes(RAW, STAGING, SUMMONERS)
AS_OF_TS = f"TIMESTAMP '{AS_OF_DATE} 00:00:00'"


def queries() -> dict[str, str]:
    q: dict[str, str] = {}

    q["stg_matches"] = BASE + """
SELECT match_id, region, game_datetime, game_date, game_creation_timestamp,
       game_mode, game_type, queue_id, game_version, duration_seconds,
       """ + dec("dur10", 1) + """ AS duration_minutes,
       game_length_category, queue_type, loaded_at
FROM stg_matches"""
    q["sink_round_trip"] = q["stg_matches"]
    q["delete_by_queue"] = q["stg_matches"] + " WHERE queue_id IS NULL OR queue_id <> 420"
    q["run_variables"] = q["stg_matches"] + (
        " WHERE game_date >= DATE '1997-01-01' AND queue_id IN (420, 440)")


    q["stg_participants"] = BASE + f"""
SELECT participant_id, match_id, puuid, summoner_name, champion_id, champion_name,
       team_id, team_side, role, lane, standardized_role, kills, deaths, assists,
       {dec('kda100', 2)} AS kda, kda_rating, gold_earned, damage_dealt,
       damage_taken, total_cs, {dec('cs_per_min10', 1)} AS cs_per_min, cs_rating,
       vision_score, {dec('vision_per_min10', 1)} AS vision_per_min, win,
       {dec('gold_per_min', 0)} AS gold_per_min,
       {dec('damage_per_gold100', 2)} AS damage_per_gold, loaded_at
FROM stg_participants"""

    q["fact_matches"] = BASE + f"""
SELECT m.match_id, m.game_datetime, m.game_date, {dec('m.dur10', 1)} AS duration_minutes,
       m.game_length_category, m.queue_type, m.game_version, m.region,
       CAST(sum(p.kills) AS DOUBLE) / count(p.kills) AS avg_kills,
       CAST(sum(p.deaths) AS DOUBLE) / count(p.deaths) AS avg_deaths,
       CAST(sum(p.assists) AS DOUBLE) / count(p.assists) AS avg_assists,
       CAST(sum(p.total_cs) AS BIGINT) AS total_cs,
       CAST(sum(p.vision_score) AS DOUBLE) / count(p.vision_score) AS avg_vision_score,
       count(*) AS total_players,
       CAST(sum(CASE WHEN p.team_side = 'Blue' AND p.win THEN 1 ELSE 0 END) AS BIGINT) AS blue_wins,
       CAST(sum(CASE WHEN p.team_side = 'Red' AND p.win THEN 1 ELSE 0 END) AS BIGINT) AS red_wins,
       count(DISTINCT p.champion_name) AS unique_champions,
       m.loaded_at
FROM stg_matches m LEFT JOIN stg_participants p ON m.match_id = p.match_id
GROUP BY m.match_id, m.game_datetime, m.game_date, m.dur10, m.game_length_category,
         m.queue_type, m.game_version, m.region, m.loaded_at"""

    champ_cols = f"""champion_name, champion_id, total_games, total_matches, total_wins,
       {dec('win_rate100', 2)} AS win_rate, avg_kills, avg_deaths, avg_assists,
       {dec('avg_kda100', 2)} AS avg_kda, avg_cs, avg_cs_per_min, avg_damage_dealt,
       avg_damage_taken, avg_gold_earned, avg_vision_score, most_played_role,
       first_seen, last_seen, unique_players"""
    q["dim_champions"] = CHAMP + f"\nSELECT {champ_cols}\nFROM dim_champions"

    q["champion_stats"] = CHAMP + f"""
SELECT champion_name, champion_id, total_games, {dec('pick_rate100', 2)} AS pick_rate,
       {dec('win_rate100', 2)} AS win_rate, total_wins, winrate_rank, popularity_rank,
       avg_kills, avg_deaths, avg_assists, {dec('avg_kda100', 2)} AS avg_kda,
       avg_damage_dealt, avg_damage_taken, avg_gold_earned, avg_cs, avg_cs_per_min,
       avg_vision_score, most_played_role, tier, first_seen, last_seen,
       {AS_OF_TS} AS calculated_at
FROM champion_stats"""

    summ_cols = f"""puuid, summoner_name, total_games, total_matches, unique_champions_played,
       total_wins, {dec('win_rate100', 2)} AS win_rate, avg_kills, avg_deaths, avg_assists,
       {dec('avg_kda100', 2)} AS avg_kda, avg_gold, avg_gold_per_min, avg_damage,
       avg_damage_taken, avg_cs, avg_cs_per_min, avg_vision_score, preferred_role,
       most_played_champion, first_game, last_game, kda_percentile, winrate_percentile"""
    q["dim_summoners"] = PLAYER + f"\nSELECT {summ_cols}\nFROM dim_summoners"

    q["player_performance"] = PLAYER + f"""
SELECT puuid, summoner_name, total_games, recent_games, unique_champions_played,
       {dec('win_rate100', 2)} AS win_rate, total_wins, avg_kills, avg_deaths, avg_assists,
       {dec('avg_kda100', 2)} AS avg_kda, avg_gold, avg_gold_per_min, avg_damage,
       avg_damage_taken, avg_cs, avg_cs_per_min, avg_vision_score, preferred_role,
       most_played_champion, kda_decile, winrate_decile, skill_tier, first_game,
       last_game, days_since_last_game,
       CASE WHEN days_since_last_game <= 7 THEN 'Active'
            WHEN days_since_last_game <= 30 THEN 'Occasional'
            ELSE 'Inactive' END AS activity_status,
       {AS_OF_TS} AS calculated_at
FROM player_performance"""

    def top(where: str, order: str, fields: str, head: str = CHAMP) -> str:
        return head + f"""
SELECT CAST(row_number() OVER (ORDER BY {order}, champion_name ASC NULLS LAST,
                                  champion_id ASC NULLS LAST) AS INTEGER) AS position, {fields}
FROM champion_stats {where}
ORDER BY {order}, champion_name ASC NULLS LAST, champion_id ASC NULLS LAST
LIMIT 10"""

    q["meta_top_champions"] = top(
        "WHERE total_games >= 20", "win_rate100 DESC NULLS FIRST",
        f"champion_name AS champion, {dec('win_rate100', 2)} AS winrate, total_games AS games")
    q["meta_worst_champions"] = top(
        "WHERE total_games >= 20", "win_rate100 ASC NULLS LAST",
        f"champion_name AS champion, {dec('win_rate100', 2)} AS winrate, total_games AS games")
    q["meta_most_popular"] = top(
        "", "pick_rate100 DESC NULLS FIRST",
        f"champion_name AS champion, {dec('pick_rate100', 2)} AS pick_rate, "
        f"{dec('win_rate100', 2)} AS winrate")

    winrate, pick_rate = (f"CAST({c} / 100.0 AS DECIMAL(18, 2))"
                          for c in ("win_rate100", "pick_rate100"))

    def json_list(where: str, order: str, keys: list[tuple[str, str]]) -> str:
        fields = ", ".join(f"{expr} AS {key}" for key, expr in keys)
        inner = top(where, order, f"champion_name AS champion, {fields}", head="")
        text = " || ".join(f"""',"{key}":' || coalesce(CAST({key} AS VARCHAR), 'null')"""
                           for key, _ in keys)
        return f"""(SELECT '[' || string_agg('{{"champion":"' || champion || '"' || {text} || '}}',
                         ',' ORDER BY position) || ']' FROM ({inner}) t)"""

    def meta(extra: str) -> str:
        rows = f"WHERE total_games >= 20 {extra}"
        best = [("winrate", winrate), ("games", "total_games")]
        every = "WHERE true " + extra
        return CHAMP + f"""
SELECT {json_list(rows, "win_rate100 DESC NULLS FIRST", best)} AS top_champions,
       {json_list(rows, "win_rate100 ASC NULLS LAST", best)} AS worst_champions,
       {json_list(every, "pick_rate100 DESC NULLS FIRST",
                  [("pick_rate", pick_rate), ("winrate", winrate)])} AS most_popular_champions,
       CAST(sum(win_rate100) AS DOUBLE) / (count(*) * 100) AS global_avg_winrate,
       CAST(sum(avg_kda100) AS DOUBLE) / (count(*) * 100) AS global_avg_kda,
       count(*) AS total_champions_played,
       {AS_OF_TS} AS calculated_at
FROM champion_stats {every}"""

    q["meta_analysis"] = meta("")
    q["meta_analysis_small_samples"] = meta("AND total_games < 20")

    q["meta_global_stats"] = CHAMP + f"""
SELECT CAST(sum(win_rate100) AS DOUBLE) / (count(*) * 100) AS global_avg_winrate,
       CAST(sum(avg_kda100) AS DOUBLE) / (count(*) * 100) AS global_avg_kda,
       count(*) AS total_champions_played,
       {AS_OF_TS} AS calculated_at
FROM champion_stats"""

    q["role_distribution"] = CHAMP + """
SELECT most_played_role AS role, count(*) AS champion_count,
       CAST(sum(win_rate100) AS DOUBLE) / (count(*) * 100) AS avg_role_winrate
FROM champion_stats GROUP BY most_played_role"""

    q["rank_winrate"] = CHAMP + """
SELECT champion_name, champion_id, winrate_rank, popularity_rank FROM champion_stats"""

    q["percent_rank_kda"] = PLAYER + """
SELECT puuid, kda_percentile, winrate_percentile FROM dim_summoners"""

    q["ntile_kda"] = PLAYER + """
SELECT puuid, kda_decile, winrate_decile FROM player_performance"""

    q["mode_role"] = CHAMP + """
SELECT champion_name, champion_id, most_played_role FROM champ_mode"""

    q["stored_order"] = f"""
SELECT 'champion_stats' AS report, row_number() OVER (ORDER BY total_games DESC, champion_name) AS position,
       champion_name AS name, total_games FROM ({q["champion_stats"]})
UNION ALL
SELECT 'player_performance', row_number() OVER (ORDER BY total_games DESC, puuid), puuid, total_games
FROM ({q["player_performance"]})"""

    q["approx_unique_players"] = f"""
SELECT champion_name, champion_id, unique_players, TRUE AS within_bound FROM ({q["dim_champions"]})"""

    q.update(_loading_queries())
    q.update(_quality_queries())
    return q


DOCS = """
doc_orders AS (
  SELECT o.*,
         (o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW') AS empty_beside,
         (o.o_orderstatus = 'P' AND o.o_orderpriority = '4-NOT SPECIFIED') AS malformed_beside
  FROM orders o
),
doc_players AS (
  SELECT l.*, (l.role_ = 'JUNGLE' AND l.l_returnflag <> 'R') AS jungle_lane,
         '{"puuid":"' || l.o_custkey || '"'
         || CASE WHEN l.l_linenumber <= 4 THEN ',"riotIdGameName":"player_' || l.o_custkey || '"' ELSE '' END
         || CASE WHEN l.l_linenumber BETWEEN 3 AND 6 THEN ',"summonerName":"sn_' || l.o_custkey || '"' ELSE '' END
         || ',"championId":' || (CAST(substr(l.p_brand, 7, 10) AS INTEGER) * 100 + l.p_size)
         || ',"championName":"' || l.p_brand || '_' || l.p_size || '"'
         || ',"teamId":' || CASE WHEN l.l_linenumber % 2 = 1 THEN 100 ELSE 200 END
         || CASE WHEN l.role_ <> '' THEN ',"teamPosition":"' || l.role_ || '"' ELSE '' END
         || CASE WHEN l.role_ = 'JUNGLE' AND l.l_returnflag <> 'R' THEN ',"lane":"JUNGLE"' ELSE '' END
         || ',"kills":' || CAST(floor(l.l_quantity) AS INTEGER)
         || ',"deaths":' || (l.l_linenumber - 1)
         || ',"assists":' || CAST(round(l.l_discount * 100) AS INTEGER)
         || ',"goldEarned":' || CAST(floor(l.l_extendedprice) AS INTEGER)
         || ',"totalDamageDealtToChampions":' || (l.l_partkey * 37 + l.l_suppkey) % 40000
         || ',"totalDamageTaken":' || (l.l_suppkey * 91 + l.l_partkey) % 40000
         || ',"visionScore":' || l.l_linenumber * 5
         || ',"totalMinionsKilled":' || CAST(floor(l.l_quantity) AS INTEGER) * 3
         || ',"neutralMinionsKilled":' || CAST(floor(l.l_quantity) AS INTEGER)
         || ',"win":' || CASE WHEN l.l_linestatus = 'O' THEN 'true' ELSE 'false' END
         || CASE WHEN l.l_returnflag = 'R' THEN ',"lane":null' ELSE '' END
         || ',"item0":' || l.l_suppkey || '}' AS player_text
  FROM raw_lines l
),
doc_texts AS (
  SELECT r.match_id,
         '{"metadata":{"dataVersion":"2","matchId":"' || r.match_id || '"},"info":{"gameCreation":'
         || r.game_creation || ',"gameDuration":' || r.game_duration
         || ',"gameMode":"CLASSIC","gameType":"MATCHED_GAME","gameVersion":"' || r.game_version
         || '","platformId":"' || r.platform_id || '","queueId":' || r.queue_id || ',"participants":['
         || coalesce(string_agg(p.player_text, ',' ORDER BY p.l_linenumber, p.player_text), '')
         || ']}}' AS raw_data
  FROM raw_matches r LEFT JOIN doc_players p ON CAST(p.l_orderkey AS VARCHAR) = r.match_id
  GROUP BY r.match_id, r.game_creation, r.game_duration, r.game_version, r.platform_id, r.queue_id
)"""

LISTINGS = """
accounts AS (
  SELECT c_custkey, c_name AS name,
         CAST(c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END AS VARCHAR) AS tag,
         CASE WHEN c_custkey % 10 = 1 THEN 2 ELSE 1 END AS entries,
         CASE WHEN c_custkey % 5 = 0 THEN 'unknown player' WHEN c_custkey % 7 = 0 THEN 'no listing'
              ELSE 'processed' END AS outcome
  FROM customer
),
listed AS (
  SELECT r.match_id, CAST(r.match_id AS BIGINT) AS k, o.o_custkey + d.next AS player, r.game_creation, o.o_orderdate
  FROM raw_matches r JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = r.match_id, range(0, 2) d(next)
  WHERE r.queue_id = 420
),
newest AS (
  SELECT b.b, l.*, a.entries,
         row_number() OVER (PARTITION BY b.b, l.player ORDER BY l.game_creation DESC, l.match_id) AS rn
  FROM range(1, 3) b(b) JOIN listed l ON b.b = 2 OR l.o_orderdate < TIMESTAMP '1998-01-01'
       JOIN accounts a ON a.c_custkey = l.player AND a.outcome = 'processed'
),
requested AS (
  SELECT b, match_id, k, CAST(sum(entries) AS BIGINT) AS copies FROM newest WHERE rn <= 3 GROUP BY b, match_id, k
),
asked AS (
  SELECT r.*, CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN 'missing' WHEN k % 17 = 0 THEN 'error' ELSE 'inserted' END
              AS answer
  FROM requested r
),
outcomes AS (
  SELECT s.b, s.match_id, s.copies,
         CASE WHEN s.b = 2 AND f.match_id IS NOT NULL THEN 'skipped' ELSE s.answer END AS outcome
  FROM asked s LEFT JOIN asked f ON f.b = 1 AND f.match_id = s.match_id AND f.answer = 'inserted'
),
players_of AS (SELECT CAST(l_orderkey AS VARCHAR) AS match_id, count(*) AS n FROM raw_lines GROUP BY l_orderkey)"""

BATCH_LOADED = ("CASE WHEN v.o_orderdate < TIMESTAMP '1998-01-01' "
                "THEN TIMESTAMP '2001-11-05' ELSE TIMESTAMP '2001-11-06' END")

MATCH_COLS = ("r.match_id, r.game_creation, r.game_duration, r.game_mode, r.game_type, "
              "r.game_version, r.platform_id, r.queue_id")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


def _loading_queries() -> dict[str, str]:
    from ..sources.lookups import REGIONS, ROUTINGS
    base = with_ctes(RAW, DOCS)
    q: dict[str, str] = {}
    q["incremental_load"] = base + f"""
SELECT {MATCH_COLS}, t.raw_data, {BATCH_LOADED} AS loaded_at
FROM raw_matches r JOIN doc_orders v ON r.match_id = CAST(v.o_orderkey AS VARCHAR)
     JOIN doc_texts t ON t.match_id = r.match_id"""

    q["stream_incremental_load"] = base + f"""
SELECT {MATCH_COLS}, t.raw_data, TIMESTAMP '2001-11-07' AS loaded_at
FROM raw_matches r JOIN doc_texts t ON t.match_id = r.match_id"""

    q["explode_participants"] = base + f"""
SELECT CAST('0x' || substr(md5(CAST(l.l_orderkey AS VARCHAR) || ':' || (row_number() OVER (
              PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.player_text) - 1)), 1, 15)
            AS BIGINT) AS id,
       CAST(l.l_orderkey AS VARCHAR) AS match_id,
       CAST(l.o_custkey AS VARCHAR) AS puuid,
       CASE WHEN l.l_linenumber <= 4 THEN 'player_' || CAST(l.o_custkey AS VARCHAR)
            WHEN l.l_linenumber BETWEEN 3 AND 6 THEN 'sn_' || CAST(l.o_custkey AS VARCHAR)
            ELSE 'Unknown' END AS summoner_name,
       CAST(CAST(substr(l.p_brand, 7, 10) AS INTEGER) * 100 + l.p_size AS INTEGER) AS champion_id,
       l.p_brand || '_' || CAST(l.p_size AS VARCHAR) AS champion_name,
       CAST(CASE WHEN l.l_linenumber % 2 = 1 THEN 100 ELSE 200 END AS INTEGER) AS team_id,
       coalesce(l.role_, '') AS role,
       CASE WHEN l.jungle_lane THEN 'JUNGLE' WHEN l.l_returnflag = 'R' THEN NULL ELSE '' END AS lane,
       CAST(floor(l.l_quantity) AS INTEGER) AS kills,
       CAST(l.l_linenumber - 1 AS INTEGER) AS deaths,
       CAST(round(l.l_discount * 100) AS INTEGER) AS assists,
       CAST(floor(l.l_extendedprice) AS INTEGER) AS gold_earned,
       CAST((l.l_partkey * 37 + l.l_suppkey) % 40000 AS INTEGER) AS total_damage_dealt,
       CAST((l.l_suppkey * 91 + l.l_partkey) % 40000 AS INTEGER) AS total_damage_taken,
       CAST(l.l_linenumber * 5 AS INTEGER) AS vision_score,
       CAST(floor(l.l_quantity) AS INTEGER) * 4 AS cs,
       l.l_linestatus = 'O' AS win,
       l.player_text AS raw_data,
       {BATCH_LOADED} AS loaded_at
FROM doc_players l JOIN doc_orders v ON l.l_orderkey = v.o_orderkey"""

    q["load_inserted_ids"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS match_id FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'"""

    listings = with_ctes(RAW, LISTINGS)
    q["listing_outcomes"] = listings + """
SELECT o.b AS batch_id, o.match_id, o.copies, o.outcome,
       CAST(CASE WHEN o.outcome = 'inserted' THEN coalesce(p.n, 0) END AS INTEGER) AS participants
FROM outcomes o LEFT JOIN players_of p USING (match_id)"""

    q["listing_player_errors"] = listings + """
SELECT b.b AS batch_id, name, tag, CAST(entries AS BIGINT) AS entries, outcome AS error
FROM accounts, range(1, 3) b(b) WHERE outcome <> 'processed'"""

    q["listing_load_stats"] = listings + """,
per_player AS (
  SELECT CAST(sum(entries) FILTER (WHERE outcome = 'processed') AS BIGINT) AS processed,
         CAST(sum(entries) FILTER (WHERE outcome <> 'processed') AS BIGINT) AS failed FROM accounts
)
SELECT o.b AS batch_id, any_value(a.processed) AS summoners_processed,
       CAST(sum(copies) AS BIGINT) AS matches_found,
       count_if(outcome = 'inserted') AS matches_inserted,
       CAST(sum(CASE outcome WHEN 'skipped' THEN copies WHEN 'inserted' THEN copies - 1 ELSE 0 END) AS BIGINT)
         AS matches_skipped,
       CAST(sum(CASE WHEN outcome = 'inserted' THEN coalesce(p.n, 0) ELSE 0 END) AS BIGINT) AS participants_inserted,
       CAST(sum(CASE WHEN outcome = 'error' THEN copies ELSE 0 END) + any_value(a.failed) AS BIGINT) AS errors,
       any_value(a.failed) AS players_failed,
       CAST(sum(CASE WHEN outcome = 'missing' THEN copies ELSE 0 END) AS BIGINT) AS matches_missing
FROM outcomes o CROSS JOIN per_player a LEFT JOIN players_of p USING (match_id) GROUP BY o.b"""

    q["player_lookup"] = """
SELECT t.c_name AS name, CAST(t.tag AS VARCHAR) AS tag, CAST(a.c_custkey AS VARCHAR) AS puuid
FROM (SELECT c_name, c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END AS tag
      FROM customer) t
LEFT JOIN customer a ON a.c_name = t.c_name AND a.c_nationkey = t.tag"""

    q["load_stats"] = base + """,
batch_orders AS (
  SELECT 1 AS b, * FROM doc_orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT 2 AS b, * FROM doc_orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT 2 AS b, * FROM doc_orders WHERE year(o_orderdate) = 1999
),
lines_of AS (
  SELECT b, count(*) AS documents, count_if(empty_beside) AS empty, count_if(malformed_beside) AS bad
  FROM batch_orders GROUP BY b
),
ids_of AS (SELECT DISTINCT b, o_orderkey, o_custkey, o_orderdate FROM batch_orders),
new_of AS (
  SELECT b, o_orderkey FROM ids_of WHERE b = 1 OR o_orderdate >= TIMESTAMP '1998-01-01'
),
inserted AS (SELECT b, count(*) AS n FROM new_of GROUP BY b),
players_in AS (
  SELECT n.b, count(*) AS n FROM new_of n JOIN raw_lines l ON l.l_orderkey = n.o_orderkey GROUP BY n.b
),
players_seen AS (
  SELECT i.b, count(DISTINCT i.o_custkey) AS n
  FROM ids_of i JOIN raw_lines l ON l.l_orderkey = i.o_orderkey GROUP BY i.b
)
SELECT CAST(t.b AS BIGINT) AS batch_id,
       CAST(t.documents + t.empty + t.bad AS BIGINT) AS matches_found,
       i.n AS matches_inserted,
       CAST(t.documents - i.n AS BIGINT) AS matches_skipped,
       p.n AS participants_inserted,
       CAST(t.bad AS BIGINT) AS errors,
       CAST(t.empty AS BIGINT) AS empty_documents,
       s.n AS summoners_processed
FROM lines_of t JOIN inserted i ON i.b = t.b JOIN players_in p ON p.b = t.b
     JOIN players_seen s ON s.b = t.b"""

    q["anti_join_new_matches"] = with_ctes(RAW) + """
SELECT n.match_id, n.game_creation, n.game_duration, n.game_mode, n.game_type,
       n.game_version, n.platform_id, n.queue_id, n.loaded_at
FROM raw_matches n
WHERE n.loaded_at >= TIMESTAMP '1997-01-01'
  AND NOT EXISTS (SELECT 1 FROM raw_matches e
                  WHERE e.loaded_at < TIMESTAMP '1998-01-01' AND e.match_id = n.match_id)"""

    q["latest_n_per_player"] = with_ctes(RAW) + """
SELECT puuid, match_id, game_creation, CAST(rn AS INTEGER) AS rn FROM (
  SELECT pm.puuid, m.match_id, m.game_creation,
         row_number() OVER (PARTITION BY pm.puuid
                            ORDER BY m.game_creation DESC, m.match_id ASC) AS rn
  FROM (SELECT DISTINCT puuid, match_id FROM raw_participants) pm
  JOIN raw_matches m ON pm.match_id = m.match_id
  WHERE m.queue_id = 420) t
WHERE rn <= 20"""

    q["json_flatten_events"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

    q["queue_lookup_join"] = BASE + """
SELECT queue_type AS queue_label, count(*) AS matches FROM stg_matches GROUP BY queue_type"""

    routing_rows = [(pf, r) for r, pfs in ROUTINGS for pf in pfs]
    q["platform_routing_explode"] = BASE + f"""
SELECT r.routing, m.region, g.region_name, count(*) AS matches
FROM stg_matches m
LEFT JOIN (VALUES {_values(routing_rows)}) r(platform, routing) ON m.region = r.platform
LEFT JOIN (VALUES {_values(REGIONS)}) g(code, region_name) ON m.region = g.code
GROUP BY r.routing, m.region, g.region_name"""

    q["table_row_counts"] = with_ctes(RAW) + """
SELECT 'matches' AS table_name, count(*) AS row_count FROM raw_matches
UNION ALL
SELECT 'participants' AS table_name, count(*) AS row_count FROM raw_participants"""
    return q


def _count(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS check_name, (SELECT count(*) FROM ({sql}) t) AS failures"


def _quality_queries() -> dict[str, str]:
    allc = with_ctes(RAW, STAGING, CHAMPIONS, SUMMONERS)
    q: dict[str, str] = {}

    def dup(table, cols, skip_null=True):
        where = f"WHERE {cols} IS NOT NULL" if skip_null else ""
        return f"SELECT {cols} FROM {table} {where} GROUP BY {cols} HAVING count(*) > 1"

    def union(parts):
        return "\nUNION ALL\n".join(parts)

    q["dq_unique"] = allc + "\n" + union([
        _count("raw_matches.match_id", dup("raw_matches", "match_id")),
        _count("stg_matches.match_id", dup("stg_matches", "match_id")),
        _count("dim_champions.champion_name", dup("dim_champions", "champion_name")),
        _count("dim_summoners.puuid", dup("summ_agg", "puuid")),
    ])

    def nn(name, table, col):
        return _count(name, f"SELECT 1 FROM {table} WHERE {col} IS NULL")

    fact = ("SELECT m.match_id FROM stg_matches m LEFT JOIN stg_participants p "
            "ON m.match_id = p.match_id GROUP BY m.match_id, m.game_datetime, m.game_date, "
            "m.dur10, m.game_length_category, m.queue_type, m.game_version, m.region, "
            "m.loaded_at")
    q["dq_not_null"] = allc + "\n" + union([
        nn("raw_matches.match_id", "raw_matches", "match_id"),
        nn("raw_matches.game_creation", "raw_matches", "game_creation"),
        nn("raw_matches.game_duration", "raw_matches", "game_duration"),
        nn("raw_participants.match_id", "raw_participants", "match_id"),
        nn("raw_participants.champion_name", "raw_participants", "champion_name"),
        nn("stg_matches.match_id", "stg_matches", "match_id"),
        nn("stg_matches.duration_seconds", "stg_matches", "duration_seconds"),
        nn("stg_participants.kills", "stg_participants", "kills"),
        nn("stg_participants.deaths", "stg_participants", "deaths"),
        nn("stg_participants.kda", "stg_participants", "kda100"),
        nn("dim_champions.champion_name", "dim_champions", "champion_name"),
        nn("fact_matches.match_id", f"({fact}) f", "match_id"),
    ])

    def rel(name, parent):
        return _count(name, f"SELECT 1 FROM raw_participants c WHERE c.match_id IS NOT NULL "
                            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.match_id = c.match_id)")

    q["dq_relationships"] = allc + "\n" + union([
        rel("raw_participants.match_id->raw_matches", "raw_matches"),
        rel("raw_participants.match_id->stg_matches", "stg_matches"),
    ])

    def rng(name, table, col, lo, hi):
        return _count(name, f"SELECT 1 FROM {table} WHERE {col} < {lo} OR {col} > {hi}")

    q["dq_accepted_range"] = allc + "\n" + union([
        rng("stg_matches.duration_seconds", "stg_matches", "duration_seconds", 60, 10800),
        rng("stg_participants.kills", "stg_participants", "kills", 0, 100),
        rng("stg_participants.deaths", "stg_participants", "deaths", 0, 100),
    ])

    q["dq_unique_combination"] = allc + "\n" + union([
        _count("stg_matches(match_id)", dup("stg_matches", "match_id", skip_null=False)),
        _count("stg_participants(match_id,puuid)",
               dup("stg_participants", "match_id, puuid", skip_null=False)),
    ])
    return q
