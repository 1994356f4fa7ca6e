"""The named queries again, as SQL for an independent engine on the same tables."""

# Line items as the feed of plans/table_feed.py holds them.
_FEED = """
feed AS (
  SELECT l_orderkey || '-' || strftime(od, '%y%m%d%H%M') || '-' || l_linenumber AS stop_id,
         l_linestatus, o_orderpriority, l_returnflag, l_quantity, l_linenumber,
         l_orderkey, l_shipdate, l_partkey, l_suppkey, n_nationkey,
         'Berlin ' || n_name AS station, n_name AS file_station, month,
         CAST(l_partkey % 12 + 1 AS VARCHAR) AS platform,
         CASE WHEN l_quantity > 10 THEN n_name || '|' || l_returnflag END AS path,
         CASE WHEN l_returnflag = 'A' THEN CAST(l_suppkey % 9 + 1 AS VARCHAR) ELSE '' END AS other_platform,
         CASE WHEN l_quantity > 40 THEN n_name || '|' || l_linestatus ELSE '' END AS changed_path,
         CASE WHEN l_returnflag = 'R' AND l_quantity < 10 THEN sd END AS ct_cancelled,
         od + to_hours(l_linenumber) AS pt_arrival,
         CASE WHEN l_linenumber > 1 THEN od + to_hours(l_linenumber) + INTERVAL 5 MINUTE END AS pt_departure,
         CASE WHEN l_linestatus = 'O' THEN sd + to_hours(l_linenumber) END AS ct_arrival,
         CASE WHEN l_quantity > 25 THEN sd + to_minutes(CAST(l_quantity AS INT)) END AS ct_departure,
         l_returnflag = 'R' AND l_quantity < 10 AS flagged
  FROM (SELECT *, o_orderdate + INTERVAL 10 YEAR AS od, l_shipdate + INTERVAL 10 YEAR AS sd,
               CAST(date_trunc('month', o_orderdate + INTERVAL 10 YEAR) AS DATE) AS month
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
),
stops AS (
  SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_returnflag
                 WHEN l_linenumber > 1 THEN l_linestatus END AS train_line
  FROM feed
)"""

# The stops of the feed with their changes; documents follow each other by station.
_FACTS = """
first AS (
  SELECT * FROM stops
  QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY file_station, l_shipdate, l_partkey, l_suppkey) = 1),
folded AS (
  SELECT stop_id,
         arg_max(ct_arrival, (file_station, l_shipdate, l_partkey, l_suppkey)) FILTER (WHERE ct_arrival IS NOT NULL) AS new_arrival,
         arg_max(ct_departure, (file_station, l_shipdate, l_partkey, l_suppkey)) FILTER (WHERE ct_departure IS NOT NULL) AS new_departure,
         bool_or(flagged) AS cancelled
  FROM feed GROUP BY stop_id),
profiles AS (
  SELECT row_number() OVER (ORDER BY o_orderpriority, l_linestatus) AS profile_id, *
  FROM (SELECT DISTINCT o_orderpriority, l_linestatus FROM feed)),
facts AS (
  SELECT stop_id, o_orderpriority, l_linestatus, CAST(8000000 + n_nationkey AS BIGINT) AS station_eva,
         CAST(profile_id AS INT) AS profile_id, month AS date_id, train_line,
         pt_arrival AS planned_arrival, new_arrival AS actual_arrival,
         pt_departure AS planned_departure, new_departure AS actual_departure,
         CASE WHEN new_arrival IS NULL THEN 0 ELSE CAST(date_diff('minute', pt_arrival, new_arrival) AS INT)
         END AS arrival_delay_minutes,
         CASE WHEN new_departure IS NULL THEN 0 ELSE CAST(date_diff('minute', pt_departure, new_departure) AS INT)
         END AS departure_delay_minutes,
         cancelled AS is_cancelled
  FROM first JOIN folded USING (stop_id) JOIN profiles USING (o_orderpriority, l_linestatus)
)"""

_PLANNED_EVENTS = """
planned AS (
  SELECT stop_id AS sid, station, 'arrival' AS event_type, l_linestatus AS category,
         o_orderpriority AS number, '08' AS owner,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS line, pt_arrival AS planned_time,
         platform AS planned_platform, CAST(NULL AS VARCHAR) AS planned_path
  FROM feed
  UNION ALL
  SELECT stop_id, station, 'departure', l_linestatus, o_orderpriority, '08', l_linestatus,
         pt_departure, NULL, path
  FROM feed WHERE l_linenumber > 1
)"""

_CHANGED_EVENTS = """
changed AS (
  SELECT stop_id AS sid, station, 'arrival' AS event_type, '' AS line, ct_arrival AS changed_time,
         ct_cancelled AS cancellation_time,
         CASE WHEN flagged THEN 'c' ELSE '' END AS cancellation_status,
         '' AS planned_platform, changed_path
  FROM feed
  UNION ALL
  SELECT stop_id, station, 'departure', '7', ct_departure, NULL, '', other_platform, ''
  FROM feed WHERE l_quantity > 25
)"""

# How often stations follow each other in a trip, that is an order.
_NETWORK = """
network AS (
  SELECT src, dst, count(*) AS times FROM (
    SELECT upper(trim(station)) AS dst, lag(upper(trim(station))) OVER (
             PARTITION BY regexp_replace(sid, '-[0-9]+$', '')
             ORDER BY planned_time NULLS FIRST, event_type, sid, upper(trim(station))) AS src
    FROM planned)
  WHERE src IS NOT NULL GROUP BY src, dst)"""

_DICTIONARY = """
dictionary AS (
  SELECT lower(trim(regexp_replace(p_name, '[^\\p{L}\\p{N}_]', ' ', 'g'))) AS name, min(p_partkey) AS eva
  FROM part GROUP BY 1
  UNION ALL SELECT 'yorckstra_e__gro_g_rschenstra_e_', 8089051
)"""

_DAILY = """
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         avg(date_diff('second', o_orderdate, l_shipdate) / 60.0) AS avg_delay
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE o_orderpriority = '1-URGENT' AND l_returnflag <> 'R'
  GROUP BY 1
)"""

_FOLD = """
folded AS (
  SELECT user_id AS stop_id,
         arg_max(moved, event_id) FILTER (WHERE event_type = 'purchase') AS new_arrival,
         arg_max(moved, event_id) FILTER (WHERE event_type = 'click') AS new_departure,
         bool_or(event_type = 'error' AND value > 100) AS cancelled
  FROM (SELECT *, ts + to_minutes(CAST(floor(value) AS INT)) AS moved FROM events)
  GROUP BY user_id
)"""

_LINES = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def _ranked(where: str, direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("l_shipdate", "l_partkey", "l_suppkey"))
    return (
        f"SELECT {_LINES} FROM lineitem WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"
    )


_EDGES = """
linked AS (
  SELECT lag(l_partkey) OVER (PARTITION BY l_orderkey
                              ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS src,
         l_partkey AS dst
  FROM lineitem
),
edges AS (SELECT DISTINCT src, dst FROM linked WHERE src IS NOT NULL),
graph AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges)"""

ORACLES: dict[str, str] = {
    "daily_delay": f"WITH {_DAILY} SELECT date, round(avg_delay, 6) AS avg_delay FROM daily",
    "overall_delay": f"WITH {_DAILY} SELECT round(avg(avg_delay), 4) AS avg_delay FROM daily",
    "same_day_delay": """
        SELECT CAST(p.ts AS DATE) AS date,
               round(avg((epoch_us(date_trunc('second', c.ts)) - epoch_us(date_trunc('second', p.ts)))
                         / 60000000.0), 6) AS avg_delay
        FROM events p JOIN events c
          ON p.user_id = c.user_id AND CAST(p.ts AS DATE) = CAST(c.ts AS DATE)
        WHERE p.event_type = 'view' AND c.event_type NOT IN ('view', 'error')
        GROUP BY 1""",
    "mean_delay": """
        SELECT round(avg(l_discount + l_tax), 6) AS avg_delay
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        WHERE s_nationkey = 7 AND l_returnflag <> 'R'""",
    "count_cancelled": """
        SELECT count(*) AS cancelled FROM events
        WHERE CAST(ts AS DATE) = DATE '2024-01-27' AND event_type = 'error'
          AND (hour(ts) = 7 OR hour(ts + INTERVAL 30 MINUTE) = 7)""",
    "peak_departures": """
        WITH daily AS (
          SELECT user_id, CAST(ts AS DATE) AS date, hour(ts) < 9 AS morning, count(*) AS n
          FROM events WHERE event_type = 'view' AND hour(ts) IN (7, 8, 17, 18)
          GROUP BY ALL)
        SELECT user_id,
               round(avg(n) FILTER (WHERE morning), 6) AS morning_avg_departures,
               round(avg(n) FILTER (WHERE NOT morning), 6) AS evening_avg_departures
        FROM daily GROUP BY user_id""",
    "station_lookup": """
        SELECT CAST(n_nationkey AS BIGINT) AS station_eva, CAST(n_nationkey + 0.5 AS DOUBLE) AS latitude,
               CAST(n_regionkey AS DOUBLE) AS longitude
        FROM nation WHERE lower(n_name) = 'nation_7'""",
    "nearest": """
        SELECT s_suppkey,
               round(power(s_acctbal - 4500.0, 2) + power(s_nationkey - 12.0, 2), 4) AS distance_metric
        FROM supplier
        ORDER BY power(s_acctbal - 4500.0, 2) + power(s_nationkey - 12.0, 2) NULLS LAST, s_suppkey
        LIMIT 1""",
    "nearest_batch": """
        SELECT c_custkey, s_suppkey, round(d, 4) AS distance_metric
        FROM (SELECT c_custkey, s_suppkey,
                     (s_acctbal - c_acctbal) * (s_acctbal - c_acctbal)
                     + (s_nationkey - c_nationkey) * (s_nationkey - c_nationkey) AS d
              FROM customer CROSS JOIN supplier)
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) = 1""",
    "normalize_name": """
        SELECT doc_id,
               trim(replace(lower(trim(regexp_replace(text, '[^\\p{L}\\p{N}_]', ' ', 'g'))), 'the', '')) AS norm
        FROM documents""",
    "station_dictionary": f"WITH {_DICTIONARY} SELECT name, eva FROM dictionary",
    "fuzzy_resolve": f"""
        WITH {_DICTIONARY},
        messy AS (SELECT DISTINCT upper(translate(p_name, ' e', '_3')) AS name FROM part),
        normed AS (
          SELECT name, trim(replace(lower(trim(regexp_replace(name, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'))),
                                    'berlin', '')) AS norm
          FROM messy),
        scored AS (
          SELECT n.name, d.name AS match, d.eva,
                 CASE WHEN n.norm = d.name THEN 1.0
                      ELSE 1 - levenshtein(n.norm, d.name) / greatest(length(n.norm), length(d.name), 1)
                 END AS score
          FROM normed n, dictionary d)
        SELECT name, match, eva, round(score, 6) AS score FROM scored
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, match) = 1""",
    "resolve_station": """
        WITH roles AS (SELECT role, min(conv_id) AS eva FROM conversations GROUP BY role)
        SELECT conv_id, turn, eva AS station_eva FROM conversations JOIN roles USING (role)""",
    "keep_first": _ranked("true", "ASC"),
    "insert_absent": f"""
        WITH target AS (SELECT {_LINES} FROM lineitem WHERE l_returnflag <> 'N'),
        fresh AS ({_ranked("l_returnflag = 'N'", "ASC")})
        SELECT * FROM target
        UNION ALL SELECT * FROM fresh WHERE NOT EXISTS (
          SELECT 1 FROM target t
          WHERE t.l_orderkey = fresh.l_orderkey AND t.l_linenumber = fresh.l_linenumber)""",
    "upsert": f"""
        WITH target AS (SELECT {_LINES} FROM lineitem WHERE l_returnflag <> 'N'),
        fresh AS ({_ranked("l_returnflag = 'N'", "DESC")})
        SELECT * FROM fresh
        UNION ALL SELECT * FROM target WHERE NOT EXISTS (
          SELECT 1 FROM fresh f
          WHERE f.l_orderkey = target.l_orderkey AND f.l_linenumber = target.l_linenumber)""",
    "fold_changes": f"WITH {_FOLD} SELECT * FROM folded",
    "apply_changes": f"""
        WITH {_FOLD},
        stops AS (
          SELECT c_custkey AS stop_id, c_mktsegment = 'MACHINERY' AS was_cancelled,
                 CASE WHEN c_nationkey % 3 <> 0 THEN TIMESTAMP '2024-01-15 12:00:00' END AS planned_arrival,
                 TIMESTAMP '2024-01-15 12:01:30' AS planned_departure
          FROM customer)
        SELECT stop_id, planned_arrival, planned_departure,
               new_arrival AS actual_arrival, new_departure AS actual_departure,
               CASE WHEN new_arrival IS NULL THEN 0 ELSE
                 CAST(round((epoch_us(new_arrival) - epoch_us(planned_arrival)) / 60000000.0) AS INT)
               END AS arrival_delay_minutes,
               CASE WHEN new_departure IS NULL THEN 0 ELSE
                 CAST(round((epoch_us(new_departure) - epoch_us(planned_departure)) / 60000000.0) AS INT)
               END AS departure_delay_minutes,
               was_cancelled OR coalesce(cancelled, false) AS is_cancelled
        FROM stops LEFT JOIN folded USING (stop_id)""",
    "orphans": """
        SELECT c_custkey, c_nationkey FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
    "date_dim": """
        WITH ranges AS (
          SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
          FROM orders GROUP BY o_custkey),
        days AS (
          SELECT DISTINCT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_id
          FROM (SELECT DISTINCT a, b FROM ranges))
        SELECT date_id, CAST(year(date_id) AS INT) AS year, CAST(month(date_id) AS INT) AS month,
               CAST(day(date_id) AS INT) AS day, dayname(date_id) AS day_of_week
        FROM days""",
    "profile_dim": """
        SELECT CAST(row_number() OVER (ORDER BY train_number, train_type) AS INT) AS profile_id, *
        FROM (SELECT DISTINCT p_brand AS train_number, p_type AS train_type FROM part)""",
    "profile_dim_next": """
        WITH first AS (
          SELECT row_number() OVER (ORDER BY train_number, train_type) AS profile_id, *
          FROM (SELECT DISTINCT p_brand AS train_number, p_type AS train_type FROM part WHERE p_size > 45)),
        later AS (
          SELECT DISTINCT p_brand AS train_number, p_type AS train_type FROM part
          EXCEPT SELECT train_number, train_type FROM first),
        numbered AS (
          SELECT * FROM first
          UNION ALL
          SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY train_number, train_type), *
          FROM later)
        SELECT CAST(profile_id AS INT) AS profile_id, train_number, train_type FROM numbered""",
    "route_edges": f"WITH {_EDGES} SELECT src, dst FROM edges",
    "station_graph": f"WITH {_EDGES} SELECT src, dst FROM graph",
    "shortest_path": f"""
        WITH RECURSIVE {_EDGES},
        ends AS (SELECT min(l_partkey) AS low, max(l_partkey) AS high FROM lineitem),
        walk(node, hop) AS (
          SELECT low, 0 FROM ends
          UNION SELECT dst, hop + 1 FROM walk JOIN graph ON src = node WHERE hop < 15),
        reached AS (SELECT node, min(hop) AS hop FROM walk GROUP BY node),
        paths(node, hop, path) AS (
          SELECT low, 0, [low] FROM ends
          UNION ALL
          SELECT dst, hop, path FROM (
            SELECT g.dst, p.hop + 1 AS hop, list_append(p.path, g.dst) AS path,
                   row_number() OVER (PARTITION BY g.dst ORDER BY list_append(p.path, g.dst)) AS rank
            FROM paths p JOIN graph g ON g.src = p.node
            JOIN reached r ON r.node = g.dst AND r.hop = p.hop + 1)
          WHERE rank = 1)
        SELECT CAST(hop AS INT) AS hops, array_to_string(path, ' -> ') AS path
        FROM paths WHERE node = (SELECT high FROM ends)""",
    "quality_profile": """
        SELECT CAST(ts AS DATE) AS date, count(*) AS n_rows,
               count(*) FILTER (WHERE event_type = 'error') AS n_missing
        FROM events GROUP BY 1""",
    "quality_summary": """
        SELECT count(*) AS n_rows, count(DISTINCT CAST(ts AS DATE)) AS n_dates,
               count(*) FILTER (WHERE event_type = 'error') AS n_missing
        FROM events""",
    "partitioned_roundtrip": """
        SELECT *, CAST(ts AS DATE) AS date FROM events""",
    "unpivot_events": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'arrival' AS event_type,
               l_shipdate AS time, l_quantity AS amount
        FROM lineitem
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'departure', l_shipdate, l_extendedprice
        FROM lineitem WHERE l_returnflag <> 'N'""",
    "feed_time": """
        SELECT o_orderkey,
               make_timestamp(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate), 0, 0, 0)
                 AS year_first,
               make_timestamp(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate), 0, 0, 0)
                 AS day_first,
               CASE WHEN year(o_orderdate) % 100 BETWEEN 1 AND 28 THEN
                 make_timestamp(2000 + day(o_orderdate), month(o_orderdate), year(o_orderdate) % 100, 0, 0, 0)
               END AS misread,
               CAST(NULL AS TIMESTAMP) AS cut_off
        FROM orders""",
    "archive_members": f"""
        WITH {_FEED},
        numbered AS (
          SELECT month, l_orderkey // 4000000 AS low, file_station,
                 (row_number() OVER (PARTITION BY month, l_orderkey // 4000000, file_station) - 1) // 1000 AS part
          FROM feed)
        SELECT 'part' || (low // 4000000) || '_' || strftime(month, '%y%m%d') || '_' || strftime(last_day(month), '%y%m%d')
                 || '.tar.gz' AS archive,
               row_number() OVER (PARTITION BY month, low ORDER BY file_station, part) - 1 AS seq,
               strftime(month, '%y%m%d') || '_' || lpad(CAST(part AS VARCHAR), 4, '0') || '/'
                 || file_station || '_timetable.xml' AS member,
               month AS range_start, last_day(month) AS range_end, month AS snapshot_date,
               file_station, CAST(count(*) AS INT) AS n_stops
        FROM numbered GROUP BY month, low, file_station, part""",
    "planned_stops": f"""
        WITH {_FEED}
        SELECT stop_id, l_linestatus AS train_type, o_orderpriority AS train_number, train_line,
               month AS date_id, pt_arrival AS planned_arrival, pt_departure AS planned_departure, station
        FROM stops""",
    "stop_changes": f"""
        WITH {_FEED}
        SELECT stop_id, ct_arrival AS new_arrival, ct_departure AS new_departure, flagged AS cancelled
        FROM feed WHERE ct_arrival IS NOT NULL OR ct_departure IS NOT NULL OR flagged""",
    "planned_events": f"WITH {_FEED}, {_PLANNED_EVENTS} SELECT * FROM planned",
    "changed_events": f"WITH {_FEED}, {_CHANGED_EVENTS} SELECT * FROM changed",
    "station_dim": """
        SELECT CAST(8000000 + n_nationkey AS BIGINT) AS station_eva, lower(n_name) AS station_name,
               CAST(round(52 + n_nationkey / 100.0, 6) AS DOUBLE) AS latitude,
               CAST(round(13 + n_nationkey / 10.0, 6) AS DOUBLE) AS longitude
        FROM nation""",
    "ingest_facts": f"""
        WITH {_FEED}, {_FACTS}
        SELECT stop_id, station_eva, profile_id, date_id, train_line, planned_arrival, actual_arrival, planned_departure,
               actual_departure, arrival_delay_minutes, departure_delay_minutes, is_cancelled
        FROM facts""",
    "ingest_two_deliveries": f"""
        WITH {_FEED}, {_FACTS}
        SELECT o_orderpriority AS train_number, l_linestatus AS train_type,
               stop_id, station_eva, date_id, train_line, planned_arrival, actual_arrival, planned_departure,
               actual_departure, arrival_delay_minutes, departure_delay_minutes, is_cancelled
        FROM facts""",
    "ingest_cancelled": f"""
        WITH {_FEED},
        first AS (
          SELECT * FROM stops
          QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY file_station, l_shipdate, l_partkey, l_suppkey) = 1),
        ever AS (SELECT stop_id, bool_or(flagged) AS cancelled FROM feed GROUP BY stop_id)
        SELECT count(*) AS cancelled FROM first JOIN ever USING (stop_id)
        WHERE cancelled AND month = DATE '2006-03-01' AND (hour(pt_arrival) = 4 OR hour(pt_departure) = 4)""",
    "ingest_reports": f"""
        WITH {_FEED},
        parts AS (
          SELECT l_orderkey % 40 AS fault, month, l_orderkey // 4000000 AS low, file_station, count(*) AS n
          FROM feed GROUP BY ALL)
        SELECT 'corrupt_documents' AS report, CAST(2 * coalesce(sum(ceil(n / 1000.0)), 0) AS BIGINT) AS n_rows
        FROM parts WHERE fault = 3
        UNION ALL SELECT 'dropped_stations', count(*) FROM nation WHERE n_nationkey % 8 = 5
        UNION ALL SELECT 'orphan_stations', count(*) FROM feed WHERE l_orderkey % 40 = 17
        UNION ALL SELECT 'orphan_stops', count(*) FROM feed WHERE l_orderkey % 40 = 31
        UNION ALL SELECT 'stops_without_id', count(*) FROM feed WHERE l_orderkey % 40 = 23
        UNION ALL SELECT 'unresolved_documents', CAST(coalesce(sum(ceil(n / 1000.0)), 0) AS BIGINT)
        FROM (SELECT sum(n) AS n FROM parts WHERE fault = 11 GROUP BY month, low)""",
    "station_network": f"""
        WITH {_FEED}, {_PLANNED_EVENTS}, {_NETWORK}
        SELECT src, dst, times FROM network""",
    "station_path": f"""
        WITH RECURSIVE {_FEED}, {_PLANNED_EVENTS}, {_NETWORK},
        ends AS (SELECT min(src) AS low, max(src) AS high, avg(times) AS mean FROM network),
        rare AS (SELECT src, dst FROM network, ends WHERE times <= mean AND src <> dst),
        graph AS (SELECT src, dst FROM rare UNION SELECT dst, src FROM rare),
        walk(node, hop) AS (
          SELECT low, 0 FROM ends
          UNION SELECT dst, hop + 1 FROM walk JOIN graph ON src = node WHERE hop < 15),
        reached AS (SELECT node, min(hop) AS hop FROM walk GROUP BY node),
        paths(node, hop, path) AS (
          SELECT low, 0, [low] FROM ends
          UNION ALL
          SELECT dst, hop, path FROM (
            SELECT g.dst, p.hop + 1 AS hop, list_append(p.path, g.dst) AS path,
                   row_number() OVER (PARTITION BY g.dst ORDER BY list_append(p.path, g.dst)) AS rank
            FROM paths p JOIN graph g ON g.src = p.node
            JOIN reached r ON r.node = g.dst AND r.hop = p.hop + 1)
          WHERE rank = 1)
        SELECT CAST(hop AS INT) AS hops, array_to_string(path, ' -> ') AS path
        FROM paths WHERE node = (SELECT high FROM ends)""",
    "ingest_days": f"""
        WITH {_FEED},
        days AS (
          SELECT CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS date_id
          FROM (SELECT DISTINCT month FROM feed))
        SELECT date_id, CAST(year(date_id) AS INT) AS year, CAST(month(date_id) AS INT) AS month,
               CAST(day(date_id) AS INT) AS day, dayname(date_id) AS day_of_week
        FROM days""",
    "ingest_profiles": f"""
        WITH {_FEED}
        SELECT CAST(row_number() OVER (ORDER BY train_number, train_type) AS INT) AS profile_id, *
        FROM (SELECT DISTINCT o_orderpriority AS train_number, l_linestatus AS train_type FROM feed)""",
    "ingest_daily_delay": f"""
        WITH {_FEED}, {_PLANNED_EVENTS}, {_CHANGED_EVENTS}
        SELECT CAST(planned_time AS DATE) AS date,
               round(avg(date_diff('minute', planned_time, changed_time)), 6) AS avg_delay
        FROM planned JOIN changed USING (sid, station, event_type)
        WHERE station = 'Berlin NATION_8' AND cancellation_status <> 'c'
        GROUP BY 1""",
}
