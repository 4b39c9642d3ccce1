"""Stand-in raw tables built from the driver's TPC-H-style tables.

The test data holds no match telemetry, so these functions only reshape rows of
``orders``/``lineitem``/``part`` into the raw schemas (``raw.matches``,
``raw.participants``) the models read.  They do none of the models' work: every
cleaning, classification, join and aggregate runs afterwards in the library on
whatever rows arrive here.  All expressions are deterministic; the DuckDB
oracle repeats them (``plans/oracle_sql.py``).

Mapping:
  match        ← one order  (match_id = o_orderkey)
  participant  ← one line   (puuid = o_custkey, champion = p_brand × p_size)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed stand-in mappings (input shaping only).
PRIORITY_TO_QUEUE = [("1-URGENT", 420), ("2-HIGH", 440), ("3-MEDIUM", 400),
                     ("4-NOT SPECIFIED", 450), ("5-LOW", 0)]
STATUS_TO_PLATFORM = [("F", "euw1"), ("O", "na1"), ("P", "kr")]
TYPE_TO_ROLE = [("ECONOMY", "TOP"), ("LARGE", "JUNGLE"), ("MEDIUM", "MIDDLE"),
                ("PROMO", "BOTTOM"), ("SMALL", "UTILITY"), ("STANDARD", "")]


def _map(col, pairs, other=None):
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(other)


def raw_matches_from_orders(orders: DataFrame) -> DataFrame:
    o = orders
    return o.select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("game_creation"),
        F.pmod(F.floor("o_totalprice"), F.lit(3600)).cast("int").alias("game_duration"),
        F.lit("CLASSIC").alias("game_mode"),
        F.lit("MATCHED_GAME").alias("game_type"),
        F.concat(F.lit("14."), F.month("o_orderdate").cast("string")).alias("game_version"),
        _map(F.col("o_orderstatus"), STATUS_TO_PLATFORM).alias("platform_id"),
        _map(F.col("o_orderpriority"), PRIORITY_TO_QUEUE).cast("int").alias("queue_id"),
        F.lit(None).cast("string").alias("raw_data"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("loaded_at"),
    )


# Measures of a line and the bits they get in one long.
LINE_BITS = {"l_linenumber": 4, "_qty": 8, "_assists": 8, "_gold": 20, "_day": 16, "_win": 1, "_not_r": 1}


def _packed(lines: DataFrame) -> DataFrame:
    """``lines`` with their measures side by side in one long, ``_word``: a shuffle
    writes a few bytes for every column of a row.  Where one is NULL, too large or
    a time of day is there, ``_word`` is NULL and the columns travel as they are
    in ``_plain``."""
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    whole = {c: F.col(c).cast("long") for c in LINE_BITS if c != "_day"} | {"_day": day.cast("long")}
    fits = reduce(lambda a, b: a & b, [whole[c].between(0, (1 << n) - 1) for c, n in LINE_BITS.items()],
                  F.date_from_unix_date(day).cast("timestamp_ntz") == F.col("l_shipdate"))
    word = reduce(lambda w, c: F.shiftleft(w, LINE_BITS[c]).bitwiseOR(whole[c]), LINE_BITS, F.lit(0).cast("long"))
    plain = F.struct(*[c for c in LINE_BITS if c != "_day"], "l_shipdate")
    return lines.withColumn("_word", F.when(fits, word)) \
                .withColumn("_plain", F.when(F.col("_word").isNull(), plain))


def _unpacked() -> dict[str, Column]:
    """The columns that ``_packed`` took together."""
    out, at = {}, sum(LINE_BITS.values())
    for c, n in LINE_BITS.items():
        at -= n
        bits = F.shiftright("_word", at).bitwiseAND(F.lit((1 << n) - 1)).cast("int")
        name = "l_shipdate" if c == "_day" else c
        value = F.date_from_unix_date(bits).cast("timestamp_ntz") if c == "_day" else \
            bits == 1 if c in ("_win", "_not_r") else bits
        out[name] = F.when(F.col("_word").isNotNull(), value).otherwise(F.col("_plain")[name])
    return out


def raw_participants_from_lines(lineitem: DataFrame, orders: DataFrame,
                                part: DataFrame, packed: bool = False) -> DataFrame:
    """One participant per line; joins pick the player (order's customer) and
    the champion (part's brand and size).

    The order is joined last and on the match id itself: lines are dealt by the
    id while they are narrow (with ``packed``, their measures in one long), and
    whatever joins or groups participants by match finds them in place."""
    match = F.col("l_orderkey").cast("string").alias("_match")
    li = lineitem.select(
        "l_orderkey", match, "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("_flag"),
        (F.col("l_returnflag") != "R").alias("_not_r"),
        F.floor("l_quantity").cast("int").alias("_qty"),
        F.floor("l_extendedprice").cast("int").alias("_gold"),
        F.round(F.col("l_discount") * 100).cast("int").alias("_assists"),
        (F.col("l_linestatus") == "O").alias("_win"))
    measure = {c: F.col(c) for c in ("l_linenumber", "l_shipdate", "_not_r", "_qty", "_gold", "_assists", "_win")}
    if packed:
        li, measure = _packed(li), _unpacked()
    o = orders.select(F.col("o_orderkey").cast("string").alias("_of"), "o_custkey")
    p = part.select("p_partkey", "p_brand", "p_type", "p_size")
    dealt = F.pmod(F.col("l_partkey") * 37 + F.col("l_suppkey"), F.lit(40000)).cast("int")
    taken = F.pmod(F.col("l_suppkey") * 91 + F.col("l_partkey"), F.lit(40000)).cast("int")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    if packed:      # both are below 2 ** 16, or NULL alike
        j = j.withColumn("_damage", F.shiftleft(dealt.cast("long"), 16).bitwiseOR(taken.cast("long")))
        dealt = F.shiftright("_damage", 16).cast("int")
        taken = F.col("_damage").bitwiseAND(F.lit(0xffff)).cast("int")
    j = j.join(o, F.col("_match") == F.col("_of"), "inner")
    role = _map(F.col("p_type"), TYPE_TO_ROLE)
    qty, line = measure["_qty"], measure["l_linenumber"]
    return j.select(
        (F.col("l_orderkey") * 10 + line).cast("long").alias("id"),
        F.col("_match").alias("match_id"),
        F.col("o_custkey").cast("string").alias("puuid"),
        F.concat(F.lit("player_"), F.col("o_custkey").cast("string"),
                 F.lit("_"), F.col("_flag")).alias("summoner_name"),
        (F.substring("p_brand", 7, 10).cast("int") * 100 + F.col("p_size"))
        .cast("int").alias("champion_id"),
        F.concat(F.col("p_brand"), F.lit("_"), F.col("p_size").cast("string"))
        .alias("champion_name"),
        F.when(line % 2 == 1, 100).otherwise(200).cast("int")
        .alias("team_id"),
        role.alias("role"),
        F.when((role == "JUNGLE") & measure["_not_r"], "JUNGLE")
        .otherwise("").alias("lane"),
        qty.alias("kills"),
        (line - 1).cast("int").alias("deaths"),
        measure["_assists"].alias("assists"),
        measure["_gold"].alias("gold_earned"),
        dealt.alias("total_damage_dealt"),
        taken.alias("total_damage_taken"),
        (line * 5).cast("int").alias("vision_score"),
        (qty * 4).alias("cs"),
        measure["_win"].alias("win"),
        F.lit(None).cast("string").alias("raw_data"),
        measure["l_shipdate"].cast("timestamp_ntz").alias("loaded_at"),
    )


def load_raw(spark: SparkSession, sf_dir: str, dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    """(raw.matches, raw.participants) stand-ins for one scale factor; with
    ``dealt`` the participants are dealt by match at every size, also where the
    orders are few enough to be sent to all tasks, with their measures packed."""
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    matches = raw_matches_from_orders(orders)
    participants = raw_participants_from_lines(lineitem, orders.hint("merge") if dealt else orders,
                                               read_table(spark, sf_dir, "part"), packed=dealt)
    return matches, participants
