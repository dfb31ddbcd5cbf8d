"""Oracle SQL for the registered queries (DuckDB dialect, base tables only).

The views below restate the fixture mapping and the reference semantics in
plain SQL; each oracle inlines the views it needs as CTEs, in dependency
order.  They are the independent check of the DataFrame implementations and
are never executed by the library itself.

One deliberate difference from the simplest fixture formulation: the tracked
participant of a match is found by *name* with the last (highest participant
id) match winning, as the ingest program does, instead of assuming
participant 0.
"""

from __future__ import annotations

import re

# (name, body) in dependency order.
VIEWS: list[tuple[str, str]] = [
    ("champions", "SELECT p_partkey AS champion_key, p_brand AS champion FROM part WHERE p_size % 10 <> 0"),
    ("players", "SELECT c_custkey AS player_key, c_name AS player_name, c_custkey % 5 < 2 AS tracked FROM customer"),
    ("raw_match", """SELECT o_orderkey AS match_id, o_orderdate AS ts, o_custkey AS tracked_key,
       CAST(floor(o_totalprice / 100) AS BIGINT) AS game_duration,
       100 AS side0, CASE WHEN o_orderstatus = 'O' THEN 'Win' ELSE 'Fail' END AS win0,
       200 AS side1, CASE WHEN o_orderstatus = 'F' THEN 'Win' ELSE 'Fail' END AS win1
FROM orders WHERE o_custkey % 5 < 2"""),
    ("raw_participant", """SELECT match_id, 0 AS participant_id, tracked_key AS player_key, tracked_key AS champion_key,
       CASE WHEN tracked_key % 2 = 0 THEN 100 ELSE 200 END AS team_id
FROM raw_match
UNION ALL
SELECT l_orderkey, l_linenumber, min(l_partkey), min(l_suppkey),
       CASE WHEN l_linenumber % 2 = 1 THEN 100 ELSE 200 END
FROM lineitem WHERE l_orderkey IN (SELECT match_id FROM raw_match)
GROUP BY l_orderkey, l_linenumber"""),
    ("raw_ban", """SELECT l_orderkey AS match_id, l_linenumber AS pos,
       CASE WHEN min(l_quantity) = 1 THEN -1 ELSE min(l_suppkey) + 7 END AS champion_key
FROM lineitem WHERE l_orderkey IN (SELECT match_id FROM raw_match)
GROUP BY l_orderkey, l_linenumber"""),
    ("match_event", """SELECT match_id, ts, game_duration,
       CASE WHEN (CASE WHEN win0 = 'Win' THEN side0 ELSE side1 END) = 100 THEN 'Blue' ELSE 'Red' END AS winner
FROM raw_match"""),
    ("match_ban", """SELECT b.match_id, b.pos, coalesce(c.champion, 'None') AS champion
FROM raw_ban b LEFT JOIN champions c ON b.champion_key = c.champion_key"""),
    ("tracked", """SELECT m.match_id, m.tracked_key AS my_id, pl.player_name AS my_name,
       CASE WHEN (CASE WHEN m.win0 = 'Win' THEN m.side0 ELSE m.side1 END) = 100 THEN 100 ELSE 200 END AS win_team
FROM raw_match m JOIN players pl ON pl.player_key = m.tracked_key"""),
    ("ident", """SELECT p.match_id, p.participant_id, p.player_key AS his_id, coalesce(pl.player_name, '') AS his_name,
       coalesce(c.champion, 'None') AS his_champion, p.team_id
FROM raw_participant p
LEFT JOIN players pl ON pl.player_key = p.player_key
LEFT JOIN champions c ON c.champion_key = p.champion_key"""),
    ("me", """SELECT t.match_id, t.my_id, max(i.participant_id) AS me_pid
FROM tracked t JOIN ident i ON i.match_id = t.match_id AND i.his_name = t.my_name
GROUP BY t.match_id, t.my_id"""),
    ("match_edge", """SELECT t.match_id, i.participant_id, t.my_id, t.my_name, i.his_id, i.his_name,
       coalesce(mi.his_champion, 'None') AS my_champion, i.his_champion,
       CASE WHEN i.team_id = t.win_team THEN 'Win' ELSE 'Fail' END AS outcome,
       CASE WHEN i.team_id = mi.team_id THEN 'Together' ELSE 'Against' END AS competition
FROM tracked t
JOIN ident i ON i.match_id = t.match_id
LEFT JOIN me ON me.match_id = t.match_id AND me.my_id = t.my_id
LEFT JOIN ident mi ON mi.match_id = t.match_id AND mi.participant_id = me.me_pid
WHERE i.his_name <> t.my_name"""),
    ("edges", """SELECT CASE WHEN outcome <> 'Fail' THEN my_id ELSE his_id END AS src_id,
       CASE WHEN outcome <> 'Fail' THEN his_id ELSE my_id END AS dst_id,
       my_champion AS src_champ, his_champion AS dst_champ, competition AS side
FROM match_edge"""),
    ("vertices", """SELECT my_id AS id, my_name AS name, true AS tracking FROM match_edge
UNION
SELECT his_id, his_name, false FROM match_edge WHERE his_name <> ''"""),
    ("graph_vertices", """SELECT k.id, coalesce(v.name, 'Missing') AS name, coalesce(v.tracking, false) AS tracking
FROM (SELECT id FROM vertices UNION SELECT src_id FROM edges UNION SELECT dst_id FROM edges) k
LEFT JOIN (SELECT id, min(name) AS name, bool_or(tracking) AS tracking FROM vertices GROUP BY id) v ON v.id = k.id"""),
    ("ban_count", "SELECT champion, count(*) AS ban_count FROM match_ban GROUP BY champion"),
    ("top_bans", """SELECT champion, ban_count FROM ban_count WHERE champion <> '-1'
ORDER BY ban_count DESC, champion ASC LIMIT 3"""),
    ("banned_edges", """SELECT * FROM edges WHERE side = 'Against'
  AND (dst_champ IN (SELECT champion FROM top_bans) OR src_champ IN (SELECT champion FROM top_bans))"""),
    ("degree", """SELECT g.id, g.name, g.tracking, CAST(coalesce(i.n, 0) AS BIGINT) AS in_degree,
       CAST(coalesce(o.n, 0) AS BIGINT) AS out_degree
FROM graph_vertices g
LEFT JOIN (SELECT dst_id AS id, count(*) AS n FROM banned_edges GROUP BY dst_id) i ON i.id = g.id
LEFT JOIN (SELECT src_id AS id, count(*) AS n FROM banned_edges GROUP BY src_id) o ON o.id = g.id"""),
    ("events_matches", """SELECT ts, CAST(floor(value * 10) AS BIGINT) AS game_duration,
       CASE WHEN event_type IN ('click', 'view') THEN 'Red' ELSE 'Blue' END AS winner FROM events"""),
    ("sliding", """SELECT slot, CAST(sum(game_duration) AS BIGINT) AS duration,
       CAST(sum(CASE WHEN winner = 'Red' THEN 1 ELSE 0 END) AS BIGINT) AS red_win, count(*) AS tot_matches
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, e.ts) - o.i * INTERVAL 5 MINUTE AS slot, e.*
      FROM events_matches e, range(6) AS o(i)) x
GROUP BY slot"""),
]
_BODY = dict(VIEWS)
_ORDER = [n for n, _ in VIEWS]


def _deps(sql: str) -> set[str]:
    """Views referenced by a FROM / JOIN clause of ``sql``."""
    refs = set(re.findall(r"(?:from|join)\s+([a-z_]+)", sql, flags=re.IGNORECASE))
    return {n for n in _ORDER if n in refs}


def with_views(final_sql: str, instead: dict[str, str] | None = None, before: str = "") -> str:
    """Prefix ``final_sql`` with the CTEs it (transitively) needs.

    ``instead`` replaces the bodies of some views; ``before`` holds CTEs that stand in front.
    """
    body = _BODY | (instead or {})
    need: set[str] = set()
    todo = list(_deps(final_sql))
    while todo:
        n = todo.pop()
        if n in need:
            continue
        need.add(n)
        todo.extend(_deps(body[n]) - need)
    ctes = ([before] if before else []) + [f"{n} AS (\n{body[n]}\n)" for n in _ORDER if n in need]
    return (f"WITH {'RECURSIVE ' if before else ''}" + ",\n".join(ctes) + "\n" if ctes else "") + final_sql


FINAL: dict[str, str] = {
    "normalize_match_event": "SELECT * FROM match_event",
    "normalize_bans": "SELECT * FROM match_ban",
    "normalize_edges": "SELECT * FROM match_edge",
    "normalize_edges_skew_safe": "SELECT * FROM match_edge",
    "match_store_edges": "SELECT * FROM match_edge",
    "nested_event_roundtrip": """SELECT match_id, my_id, my_name, his_id, his_name, my_champion, his_champion,
       outcome, competition FROM match_edge""",
    "match_store_events": """SELECT match_id, my_id, my_name, his_id, his_name, my_champion, his_champion,
       outcome, competition FROM match_edge""",
    "raw_document_quarantine": """SELECT m.match_id, count(p.match_id) AS n_participants, false AS quarantined, false AS corrupt
FROM raw_match m LEFT JOIN raw_participant p ON p.match_id = m.match_id GROUP BY m.match_id
UNION ALL SELECT -1, 0, true, true FROM raw_match
UNION ALL SELECT match_id, 0, true, false FROM raw_match""",
    "json_root_variants": """SELECT t.match_id, t.my_id, v.variant, NOT v.ok AS quarantined, CASE WHEN NOT v.ok THEN x.reason END AS reason,
       CASE WHEN v.ok THEN m.game_duration ELSE -1 END AS game_duration,
       CASE WHEN v.ok THEN (CASE WHEN t.win_team = 100 THEN 'Blue' ELSE 'Red' END) END AS winner,
       CAST(CASE WHEN v.ok THEN coalesce(b.n, 0) ELSE 0 END AS BIGINT) AS n_bans,
       CAST(CASE WHEN v.ok THEN coalesce(e.n, 0) ELSE 0 END AS BIGINT) AS n_edges
FROM tracked t
JOIN raw_match m ON m.match_id = t.match_id
LEFT JOIN (SELECT match_id, count(*) AS n FROM match_ban GROUP BY match_id) b ON b.match_id = t.match_id
LEFT JOIN (SELECT match_id, my_id, count(*) AS n FROM match_edge GROUP BY match_id, my_id) e
       ON e.match_id = t.match_id AND e.my_id = t.my_id
CROSS JOIN (VALUES ('object', true, true, ''), ('array', true, true, ''), ('corrupt', false, false, 'unparsable'),
                   ('missing_key', false, false, 'no gameDuration'), ('missing_edge_key', false, true, 'incomplete edge'),
                   ('bad_ts', false, false, 'time'), ('huge_duration', false, false, 'duration'))
       x(variant, with_edges, without, reason)
CROSS JOIN LATERAL (SELECT x.variant, CASE WHEN e.n IS NULL THEN x.without ELSE x.with_edges END AS ok) v""",
    "event_unknown_fields": """SELECT t.match_id, CASE WHEN t.win_team = 100 THEN 'Blue' ELSE 'Red' END AS winner, t.match_id AS patch, 'x' AS region,
       CAST(coalesce(b.n, 0) AS BIGINT) AS n_bans
FROM tracked t LEFT JOIN (SELECT match_id, count(*) AS n FROM match_ban GROUP BY match_id) b ON b.match_id = t.match_id""",
    "match_list_slice": """SELECT player, poll,
       b0 + to_microseconds(poll * 8640000000) AS slice_begin,
       b0 + to_microseconds((poll + 1) * 8640000000) AS slice_end,
       CAST(row_number() OVER (PARTITION BY player, poll ORDER BY ts, game_id) - 1 AS BIGINT) AS idx,
       game_id, ts,
       CAST(count(*) OVER (PARTITION BY player, poll) AS BIGINT) AS end_index
FROM (SELECT e.user_id AS player, e.event_id AS game_id, e.ts, b.b0,
             CAST(floor((epoch_us(e.ts) - epoch_us(b.b0)) / 8640000000.0) AS BIGINT) AS poll
      FROM events e, (SELECT min(ts) AS b0 FROM events) b) g
WHERE poll >= 0""",
    "match_list_slice_queue": """SELECT player, poll,
       b0 + to_microseconds(poll * 8640000000) AS slice_begin,
       b0 + to_microseconds((poll + 1) * 8640000000) AS slice_end,
       CAST(row_number() OVER (PARTITION BY player, poll ORDER BY ts, game_id) - 1 AS BIGINT) AS idx,
       game_id, ts,
       CAST(count(*) OVER (PARTITION BY player, poll) AS BIGINT) AS end_index
FROM (SELECT e.user_id AS player, e.event_id AS game_id, e.ts, b.b0,
             CAST(floor((epoch_us(e.ts) - epoch_us(b.b0)) / 8640000000.0) AS BIGINT) AS poll
      FROM events e, (SELECT min(ts) AS b0 FROM events) b WHERE e.event_type = 'click') g
WHERE poll >= 0""",
    "match_list_documents": """SELECT CAST(player AS VARCHAR) AS account_id, CAST(idx AS INTEGER) AS idx, game_id, 420 AS queue,
       CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS game_ts
FROM (SELECT player, game_id, ts, row_number() OVER (PARTITION BY player, poll ORDER BY ts, game_id) - 1 AS idx,
             count(*) OVER (PARTITION BY player, poll) AS n
      FROM (SELECT e.user_id AS player, e.event_id AS game_id, e.ts,
                   CAST(floor((epoch_us(e.ts) - epoch_us(b.b0)) / 8640000000.0) AS BIGINT) AS poll
            FROM events e, (SELECT min(ts) AS b0 FROM events) b) g) s
WHERE idx < greatest(n - 1, 1)""",
    "poll_increment": """SELECT e.user_id AS player, e.event_id AS game_id, e.ts FROM events e
LEFT JOIN (SELECT user_id, max(ts) AS last_ts FROM events WHERE event_id % 2 = 0 AND user_id % 3 <> 0 GROUP BY user_id) c
       ON c.user_id IS NOT DISTINCT FROM e.user_id
WHERE CASE WHEN c.last_ts IS NULL THEN e.ts >= (SELECT min(ts) FROM events) ELSE e.ts > c.last_ts END""",
    "roster_documents": """SELECT n.name AS summoner_name, replace(n.name, ' ', '%20') AS url_name, CAST(max(CAST(c.c_custkey AS VARCHAR)) AS VARCHAR) AS account_id
FROM (SELECT replace(c_name, '#', ' ') AS name FROM customer ORDER BY 1 LIMIT 20) n
JOIN customer c ON replace(c.c_name, '#', ' ') = n.name GROUP BY n.name""",
    "stream_running_bans": """SELECT champion, count(*) AS n, CAST(1 AS BIGINT) AS first, count(*) AS last, count(*) AS steps
FROM match_ban GROUP BY champion""",
    "roster_accounts": """SELECT r.summoner_name, replace(r.summoner_name, ' ', '%20') AS url_name, a.account_id, r.rating
FROM (SELECT c_name AS summoner_name, c_acctbal AS rating FROM customer
      ORDER BY c_acctbal DESC, c_name ASC LIMIT 20) r
JOIN (SELECT c_name AS summoner_name, max(c_custkey) AS account_id FROM customer GROUP BY c_name) a
  ON a.summoner_name = r.summoner_name""",
    "champion_dimension": "SELECT champion_key, champion FROM champions",
    "oriented_edges": "SELECT * FROM edges",
    "vertex_extract": "SELECT * FROM vertices",
    "edge_csv_line": """SELECT match_id, participant_id,
       concat_ws(',', CAST(my_id AS VARCHAR), CAST(his_id AS VARCHAR), my_champion, his_champion,
                 CASE WHEN outcome <> 'Fail' THEN 'true' ELSE 'false' END, competition) AS line
FROM match_edge""",
    "edge_attr_map": """SELECT src_id, dst_id, coalesce(src_champ, 'No Champ') AS my_champion,
       coalesce(dst_champ, '') AS his_champion, coalesce(side, 'None') AS side
FROM edges""",
    "ban_counts": "SELECT * FROM ban_count",
    "ban_running_count": """SELECT match_id, pos, champion,
       CAST(count(*) OVER (PARTITION BY champion ORDER BY match_id, pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM match_ban""",
    "ban_counts_stream": "SELECT * FROM ban_count",
    "top_banned": "SELECT * FROM top_bans",
    "top_banned_chart": """SELECT champion, ban_count, row_number() OVER (ORDER BY ban_count ASC, champion DESC) AS chart_pos
FROM (SELECT * FROM ban_count WHERE champion <> '-1' ORDER BY ban_count DESC, champion ASC LIMIT 15) t""",
    "stats_sliding": "SELECT * FROM sliding",
    "stats_sliding_stream": "SELECT * FROM sliding",
    "stats_panes_stream": "SELECT * FROM sliding",
    "running_bans_state": """SELECT champion, count(*) AS n, CAST(1 AS BIGINT) AS first, count(*) AS last, count(*) AS steps
FROM (SELECT CASE WHEN (match_id + row_number() OVER (PARTITION BY match_id ORDER BY pos) - 1) % 3 = 0 THEN 'HOT' ELSE champion END AS champion
      FROM match_ban) b GROUP BY champion""",
    "match_list_arrivals": """SELECT CAST(tracked_key AS VARCHAR) AS account_id, match_id AS game_id,
       CASE WHEN match_id % 3 = 2 THEN 'pending' ELSE 'matched' END AS status FROM raw_match""",
    "poll_store": """SELECT user_id AS player, count(*) AS games, count(DISTINCT event_id) AS distinct_games, max(ts) AS last_ts
FROM events GROUP BY user_id""",
    "graph_export_merged": """SELECT v.id, v.name, CAST(coalesce(r.n, 0) AS BIGINT) AS n_rels FROM graph_vertices v
LEFT JOIN (SELECT src_id, count(*) AS n FROM (SELECT DISTINCT src_id, dst_id, coalesce(src_champ, 'No Champ') AS c FROM banned_edges) d GROUP BY src_id) r
       ON r.src_id = v.id
WHERE v.id % 3 <> 0 OR v.id % 2 = 0""",
    "edges_folded": "SELECT * FROM edges",
    "stats_upsert": "SELECT * FROM sliding",
    "graph_vertices": "SELECT * FROM graph_vertices",
    "graph_stats": """SELECT count(*) AS n_vertices,
       CAST(sum(CASE WHEN name = 'Missing' THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
       CAST(sum(CASE WHEN tracking THEN 1 ELSE 0 END) AS BIGINT) AS n_tracked
FROM graph_vertices""",
    "banned_subgraph": "SELECT * FROM banned_edges",
    "graph_degrees": "SELECT * FROM degree",
    "tracked_players_vs_banned": "SELECT * FROM degree WHERE tracking AND in_degree + out_degree > 0",
    "pattern_match_hop": """SELECT v.id, v.name, e.dst_id, coalesce(e.src_champ, 'No Champ') AS my_champion
FROM banned_edges e JOIN graph_vertices v ON v.id = e.src_id
WHERE coalesce(e.src_champ, 'No Champ') NOT IN (SELECT champion FROM top_bans)""",
    "graph_export_nodes": "SELECT DISTINCT id, name FROM graph_vertices",
    "graph_export_rels": """SELECT DISTINCT src_id, dst_id, coalesce(src_champ, 'No Champ') AS my_champion
FROM banned_edges""",
    "edges_csv_roundtrip": "SELECT * FROM edges",
    "vertices_csv_roundtrip": "SELECT * FROM vertices",
    "mart_avg_length": """SELECT CAST(sum(game_duration) AS BIGINT) AS total_length, count(*) AS total_matches,
       round(CAST(sum(game_duration) AS DOUBLE) / count(*) / 60, 6) AS avg_min,
       round(round(CAST(sum(game_duration) AS DOUBLE) / count(*) / 60, 6) - 25, 6) AS delta_min
FROM match_event""",
    "mart_win_share": """SELECT side, wins, round(CAST(wins AS DOUBLE) / total, 6) AS share
FROM (SELECT 'Red Side' AS side, CAST(sum(CASE WHEN winner = 'Red' THEN 1 ELSE 0 END) AS BIGINT) AS wins,
             count(*) AS total FROM match_event
      UNION ALL
      SELECT 'Blue Side', CAST(count(*) - sum(CASE WHEN winner = 'Red' THEN 1 ELSE 0 END) AS BIGINT),
             count(*) FROM match_event) s""",
    "mart_avg_length_slots": """SELECT CAST(sum(duration) AS BIGINT) AS total_length,
       CAST(sum(tot_matches) AS BIGINT) AS total_matches,
       round(CAST(sum(duration) AS DOUBLE) / sum(tot_matches) / 60, 6) AS avg_min,
       round(round(CAST(sum(duration) AS DOUBLE) / sum(tot_matches) / 60, 6) - 25, 6) AS delta_min
FROM sliding""",
    "mart_win_share_slots": """SELECT side, wins, round(CAST(wins AS DOUBLE) / total, 6) AS share
FROM (SELECT 'Red Side' AS side, CAST(sum(red_win) AS BIGINT) AS wins, CAST(sum(tot_matches) AS BIGINT) AS total
      FROM sliding
      UNION ALL
      SELECT 'Blue Side', CAST(sum(tot_matches) - sum(red_win) AS BIGINT), CAST(sum(tot_matches) AS BIGINT)
      FROM sliding) s""",
}


# The Scala 32-bit MurmurHash3 string hash in plain SQL: one mixing round per
# pair of characters (recursive CTE, 128-bit integers masked to 32 bits), the
# odd tail, then the finaliser.  ``ord`` equals the UTF-16 code unit for
# characters of the basic plane, which covers the player names of the tables.
HASH_CTES = """hashed_names AS (
SELECT c_custkey AS player_key, c_name AS player_name FROM customer UNION ALL SELECT -1, ''
),
it(player_key, player_name, n, i, h) AS (
  SELECT player_key, player_name, length(player_name), 0, CAST(4157243346 AS HUGEINT) FROM hashed_names
  UNION ALL
  SELECT player_key, player_name, n, i + 1, ((h2 * 5) + 3864292196) & 4294967295
  FROM (SELECT player_key, player_name, n, i, ((h1 << 13) | (h1 >> 19)) & 4294967295 AS h2
        FROM (SELECT player_key, player_name, n, i,
                     xor(h, (((((k1 << 15) | (k1 >> 17)) & 4294967295) * 461845907) & 4294967295)) AS h1
              FROM (SELECT player_key, player_name, n, i, h,
                           ((CAST(ord(substr(player_name, 2 * i + 1, 1)) AS HUGEINT) * 65536
                             + ord(substr(player_name, 2 * i + 2, 1))) * 3432918353) & 4294967295 AS k1
                    FROM it WHERE i < n // 2) a) b) c
),
last AS (SELECT player_key, player_name, n, h FROM it WHERE i = n // 2),
tail AS (SELECT player_key, player_name, n,
                CASE WHEN n % 2 = 1 THEN xor(h, (((((k1 << 15) | (k1 >> 17)) & 4294967295) * 461845907) & 4294967295))
                     ELSE h END AS h
         FROM (SELECT *, (CAST(ord(substr(player_name, n, 1)) AS HUGEINT) * 3432918353) & 4294967295 AS k1
               FROM last) t),
f1 AS (SELECT player_key, player_name, xor(h, n) AS h FROM tail),
f2 AS (SELECT player_key, player_name, (xor(h, h >> 16) * 2246822507) & 4294967295 AS h FROM f1),
f3 AS (SELECT player_key, player_name, (xor(h, h >> 13) * 3266489909) & 4294967295 AS h FROM f2),
f4 AS (SELECT player_key, player_name, xor(h, h >> 16) AS h FROM f3),
name_ids AS (SELECT player_key, player_name,
       CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS BIGINT) AS murmur3_id FROM f4)"""

# Edges and vertices whose ids are the hash of the players' names (unknown players share the empty name).
NAME_ID_VIEWS = {
    "edges": """SELECT CASE WHEN outcome <> 'Fail' THEN m.murmur3_id ELSE h.murmur3_id END AS src_id,
       CASE WHEN outcome <> 'Fail' THEN h.murmur3_id ELSE m.murmur3_id END AS dst_id,
       my_champion AS src_champ, his_champion AS dst_champ, competition AS side
FROM match_edge JOIN name_ids m ON m.player_name = my_name JOIN name_ids h ON h.player_name = his_name""",
    "vertices": """SELECT murmur3_id AS id, my_name AS name, true AS tracking FROM match_edge JOIN name_ids ON player_name = my_name
UNION
SELECT murmur3_id, his_name, false FROM match_edge JOIN name_ids ON player_name = his_name WHERE his_name <> ''""",
}

# Identities listed in the order of (id modulo 3, id): the last of a name is not the highest id.
LISTED_VIEWS = {"me": """SELECT t.match_id, t.my_id, arg_max(i.participant_id, (i.participant_id % 3) * 1000000 + i.participant_id) AS me_pid
FROM tracked t JOIN ident i ON i.match_id = t.match_id AND i.his_name = t.my_name
GROUP BY t.match_id, t.my_id"""}

# Every known tracked participant of a match is tracked.
FAN_OUT_VIEWS = {"tracked": """SELECT DISTINCT m.match_id, p.player_key AS my_id, pl.player_name AS my_name,
       CASE WHEN (CASE WHEN m.win0 = 'Win' THEN m.side0 ELSE m.side1 END) = 100 THEN 100 ELSE 200 END AS win_team
FROM raw_match m JOIN raw_participant p ON p.match_id = m.match_id
JOIN players pl ON pl.player_key = p.player_key AND pl.tracked"""}


def oracle_sql() -> dict[str, str]:
    out = {k: with_views(v) for k, v in FINAL.items()}
    out["pattern_match_hop_heavy"] = out["pattern_match_hop"]
    out["player_id_hash"] = f"WITH RECURSIVE {HASH_CTES}\nSELECT * FROM name_ids WHERE player_key >= 0"
    out["raw_document_edges"] = with_views("SELECT * FROM match_edge", LISTED_VIEWS)
    out["multi_tracked_edges"] = with_views("SELECT * FROM match_edge", FAN_OUT_VIEWS)
    named = {"stream_edges_name_id": "SELECT * FROM edges", "stream_vertices_name_id": "SELECT * FROM vertices",
             "stream_ingest_graph": "SELECT * FROM degree WHERE tracking AND in_degree + out_degree > 0",
             "graph_job_files": "SELECT * FROM degree WHERE tracking AND in_degree + out_degree > 0"}
    for name, final in named.items():
        out[name] = with_views(final, NAME_ID_VIEWS, HASH_CTES)
    return out
