"""The registered queries in SQL, over the same tables."""

from __future__ import annotations

from snapstats.fixed_values import HERO_NAMES

ORACLE_SQL: dict[str, str] = {}


def _snapshots(source: str, key: str, where: str = "true") -> str:
    """Monthly counters per key, as the Spark queries derive them."""
    return f"""
        SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%dT00:00:00+00:00') AS fetched_at,
               {source} AS {key},
               count(*) FILTER (l_returnflag = 'A') AS wins,
               count(*) FILTER (l_returnflag = 'R') AS losses
        FROM lineitem WHERE {where} GROUP BY 1, 2"""


def _win_rate(source: str, key: str, where: str = "true") -> str:
    """Half-up rounding in integers, because ``round`` of a double differs on exact ties."""
    return f"""
        SELECT {key}, w AS total_wins, l AS total_losses, w + l AS total_matches, last_updated,
               ((20000 * w + (w + l)) // (2 * (w + l)))::DOUBLE / 10000 AS win_rate
        FROM (SELECT {key}, sum(wins)::BIGINT AS w, sum(losses)::BIGINT AS l, max(fetched_at) AS last_updated
              FROM ({_snapshots(source, key, where)}) GROUP BY 1)
        WHERE w + l > 0"""


HERO = _win_rate("l_suppkey", "hero_id")
HERO_SNAPSHOTS = _snapshots("l_suppkey", "hero_id")
LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, "
    "l_shipdate"
)
STAMP_OF_DAY = "strftime({}, '%Y-%m-%dT00:00:00+00:00')"
K = "json_extract(props, '$.k')::BIGINT"

for _name in (
    "hero_win_rate",
    "hero_win_rate_legacy",
    "hero_win_rate_text_stamps",
    "hero_win_rate_from_files",
    "hero_win_rate_bronze",
    "streamed_win_rate",
):
    ORACLE_SQL[_name] = HERO

ORACLE_SQL |= {
    "item_win_rate": _win_rate("l_orderkey", "item_id"),
    "hero_win_rate_data_first": _win_rate("l_suppkey", "hero_id", "month(l_shipdate) % 2 = 1"),
    "bronze_date_range": _win_rate("l_suppkey", "hero_id", "year(l_shipdate) = 1997"),
    "counter_drift": f"""
        SELECT hero_id, w AS total_wins, l AS total_losses, m AS total_matches, last_updated,
               ((20000 * w + m) // (2 * m))::DOUBLE / 10000 AS win_rate
        FROM (SELECT CASE WHEN event_id % 3 = 0 OR event_type <> 'error' THEN event_id % 50 END AS hero_id,
                     sum(CASE WHEN event_id % 3 = 0 THEN 3 WHEN event_type <> 'click' THEN 1 END)::BIGINT AS w,
                     sum(CASE WHEN event_id % 3 = 0 THEN 3 ELSE 0 END)::BIGINT AS l,
                     sum(CASE WHEN event_id % 3 = 0 THEN 6 ELSE 2 END)::BIGINT AS m,
                     max({STAMP_OF_DAY.format('ts')}) AS last_updated FROM events GROUP BY 1)""",
    "rejected_counters": """
        SELECT count(*) AS records, 0::BIGINT AS rejected_wins, count(event_type) AS rejected_losses,
               0::BIGINT AS rejected_matches FROM events""",
}

# records
ORACLE_SQL |= {
    "generic_flatten": f"""
        SELECT {STAMP_OF_DAY.format('ts')} AS fetched_at, event_id, event_type, value, {K} AS props_k FROM events""",
    "streamed_flatten": f"""
        SELECT {STAMP_OF_DAY.format('ts')} AS fetched_at, event_id, event_type, value, {K} AS props_k FROM events""",
    "shallow_explode": f"""
        SELECT {STAMP_OF_DAY.format('l_shipdate')} AS fetched_at, l_orderkey AS match_id,
               CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE 0 END AS nested_players,
               CASE WHEN l_linenumber % 2 = 1 THEN 0 ELSE 2 END AS flat_players,
               l_suppkey AS first_account FROM lineitem""",
    "normalize_payload": f"""
        SELECT event_id, {K} AS k FROM events WHERE event_type NOT IN ('error', 'click')
        UNION ALL SELECT event_id, {K} AS k FROM events WHERE event_type = 'view'""",
    "payload_sizes": """
        SELECT event_id, (CASE event_type WHEN 'view' THEN 2 WHEN 'error' THEN 0 ELSE 1 END)::BIGINT AS record_count
        FROM events""",
    "non_empty_payloads": """
        SELECT event_id, (CASE event_type WHEN 'view' THEN 2 ELSE 1 END)::BIGINT AS record_count
        FROM events WHERE event_type NOT IN ('error', 'click')""",
    "inject_key": f"""
        SELECT {STAMP_OF_DAY.format('l_shipdate')} AS fetched_at, l_partkey AS account_id, l_orderkey AS match_id,
               l_suppkey AS hero_id FROM lineitem""",
    "record_counts": f"SELECT fetched_at, count(*) AS record_count FROM ({HERO_SNAPSHOTS}) GROUP BY 1",
    "envelope_paths": """
        SELECT DISTINCT strftime(date_trunc('month', l_shipdate), 'raw/hero_stats/%Y/%m/%d/%H%M%S.json') AS path
        FROM lineitem""",
    "landed_paths": """
        SELECT DISTINCT strftime(date_trunc('month', l_shipdate), 'raw/hero_stats/%Y/%m/%d/%H%M%S') || batch || '.json' AS path
        FROM (SELECT l_shipdate, '_batch' || (l_suppkey % 2 + 1) AS batch FROM lineitem UNION ALL SELECT l_shipdate, '' FROM lineitem)""",
    "stamps": """
        SELECT event_id,
               CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS stamp,
               epoch_us(ts) AS micros,
               strftime(ts, '%Y/%m/%d/%H%M%S') AS path,
               strftime(ts, '%-m/%-d/%Y, %-I:%M:%S %p') AS shown
        FROM events""",
    "jsonable_values": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
               printf('%.2f', o_totalprice) AS o_totalprice FROM orders""",
    "union_drift": """
        SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::INTEGER AS nation,
               c_custkey::VARCHAR AS code FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey, s_name FROM supplier""",
    "leading_integers": """
        SELECT p_partkey, (-p_size)::BIGINT AS signed, NULL::BIGINT AS "none", p_partkey AS hex,
               CASE WHEN p_size <= 15 THEN 1 - (1::BIGINT << (4 * p_size)) END AS long_hex FROM part""",
    "tuple_csv": """
        SELECT s_suppkey AS hero_id, s_nationkey::BIGINT AS players, floor(s_acctbal * 1000000)::BIGINT AS wins,
               s_name AS hero_name FROM supplier WHERE s_acctbal >= 0""",
}

# discovery
HISTORY = """
    SELECT l_partkey AS account_id, l_orderkey AS match_id, l_suppkey AS hero_id, l_linenumber AS line FROM lineitem"""
BLOCKS = """
    SELECT account_id, 1 + (row_number() OVER (ORDER BY left(md5(account_id::VARCHAR), 3), account_id) - 1) // 500
           AS block, count(*) OVER () AS items
    FROM (SELECT DISTINCT l_partkey AS account_id FROM lineitem)"""
SUFFIX = "CASE WHEN items > 500 THEN '_batch' || block ELSE '' END"

ORACLE_SQL |= {
    "discover_heroes": f"""
        WITH placed AS (
            SELECT *, row_number() OVER (PARTITION BY fetched_at, hero_id // 20000 ORDER BY hero_id) - 1 AS position
            FROM ({HERO_SNAPSHOTS}))
        SELECT hero_id, fetched_at AS first_fetched_at, position::INTEGER AS first_position FROM placed
        QUALIFY row_number() OVER (PARTITION BY hero_id ORDER BY fetched_at, position) = 1""",
    "discover_matches": "SELECT DISTINCT l_orderkey AS match_id FROM lineitem",
    "discover_accounts": "SELECT DISTINCT l_suppkey AS account_id FROM lineitem WHERE l_suppkey > 0",
    "discovery_totals": """
        SELECT count(DISTINCT l_orderkey) AS matches,
               count(DISTINCT l_suppkey) FILTER (l_suppkey > 0) AS accounts FROM lineitem""",
    "history_of_discovered": f"""
        SELECT * FROM ({HISTORY}) h
        WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey > 0 AND l_suppkey = h.account_id)""",
    "details_of_discovered": """
        SELECT l_orderkey AS match_id, count(*) AS records FROM lineitem
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F') GROUP BY 1""",
    "details_missing": """
        SELECT o_orderkey AS match_id FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "request_grid": """
        SELECT hero_id, endpoint FROM (SELECT DISTINCT l_suppkey AS hero_id FROM lineitem),
               (VALUES ('ability_order_stats'), ('build_item_stats')) AS e(endpoint)""",
    "discovered": """
        SELECT 'heroes' AS what, count(DISTINCT l_suppkey) AS n FROM lineitem
        UNION ALL SELECT 'matches', count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'accounts', count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey > 0
        UNION ALL SELECT 'hero_requests', 2 * count(DISTINCT l_suppkey) FROM lineitem
        UNION ALL SELECT 'match_requests', count(DISTINCT o_orderkey) FROM orders
                  WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "chunk_numbers": f"SELECT account_id, block, {SUFFIX} AS suffix FROM ({BLOCKS})",
    "chunk_totals": f"""
        SELECT block, {SUFFIX} AS suffix, count(*) AS records FROM ({BLOCKS}) b
        JOIN ({HISTORY}) h ON h.account_id = b.account_id GROUP BY 1, 2""",
    "landed_history": f"""
        SELECT '2026-04-05T10:00:00+00:00' AS fetched_at, account_id, match_id, hero_id, line::BIGINT AS line
        FROM ({HISTORY})""",
    "split_envelopes": f"""
        SELECT {STAMP_OF_DAY.format('ts')} AS fetched_at, count(*) AS records, true AS bounded
        FROM events GROUP BY 1""",
    "envelopes_by_bytes": """
        SELECT '2026-04-0' || day || 'T10:00:00+00:00' AS fetched_at, count(*) AS records,
               true AS bounded, true AS filled
        FROM documents, (VALUES (5), (6)) AS d(day) GROUP BY 1""",
}

# names
NAMES = "(SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation)"
ORACLE_SQL |= {
    "hero_names": f"""
        SELECT h.*, coalesce(name, 'Hero ' || hero_id) AS hero_name FROM ({HERO}) h
        LEFT JOIN {NAMES} d ON d.id = hero_id""",
    "all_hero_columns_named": f"""
        SELECT l_orderkey, l_linenumber, coalesce(a.name, 'Hero ' || l_suppkey) AS hero_id,
               coalesce(b.name, 'Hero ' || l_partkey) AS counter_hero_id,
               CASE WHEN l_returnflag = 'R' THEN coalesce(c.name, 'Hero ' || l_linenumber) ELSE '—' END
               AS synergy_hero_id
        FROM lineitem LEFT JOIN {NAMES} a ON a.id = l_suppkey LEFT JOIN {NAMES} b ON b.id = l_partkey
        LEFT JOIN {NAMES} c ON c.id = l_linenumber""",
    "names_or_not_found": """
        SELECT l_orderkey, l_linenumber, l_partkey, coalesce(s_name, 'ID Not Found') AS s_name
        FROM lineitem LEFT JOIN supplier ON s_suppkey = l_partkey""",
    "fixed_hero_names": f"""
        SELECT h.*, coalesce(name, 'Hero ' || hero_id) AS hero_name FROM ({HERO}) h
        LEFT JOIN (VALUES {', '.join(f"({n}, '{name.replace(chr(39), chr(39) * 2)}')" for n, name in HERO_NAMES.items())})
                  AS d(id, name) ON d.id = hero_id""",
    "hero_picker": f"""
        SELECT hero_id, coalesce(name, 'Hero ' || hero_id) AS hero_name FROM ({HERO}) h
        LEFT JOIN {NAMES} d ON d.id = hero_id ORDER BY 2""",
}

# collections
COUNTS = """
    SELECT * FROM (VALUES (0, 'nation', 'Geo', false, (SELECT count(*) FROM nation)),
        (1, 'region', 'Geo', false, (SELECT count(*) FROM region)),
        (2, 'supplier', 'Trade', false, (SELECT count(*) FROM supplier)),
        (3, 'part', 'Trade', false, (SELECT count(*) FROM part)),
        (4, 'lineitem', 'Trade', true, (SELECT count(*) FROM lineitem)),
        (5, 'missing', 'Trade', false, 0)) AS c(position, name, category, requires_hero, count)"""


def _ordered(rows: str, order: str, limit: int, offset: int = 0) -> str:
    """A page with the place of each row in it."""
    return f"""
        SELECT * REPLACE (position - {offset + 1} AS position)
        FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM {rows})
        WHERE position > {offset} AND position <= {offset + limit}"""


META = "SELECT true AS ok, '{0}' AS collection, count(*) AS total, {1} AS page, ceil(count(*) / {2})::INTEGER AS pages"

ORACLE_SQL |= {
    "top_heroes": _ordered(f"({HERO})", "win_rate DESC, hero_id", 25),
    "top_heroes_stored": _ordered(f"({HERO})", "total_wins, hero_id", 40),
    "top_heroes_meta": f"""
        SELECT least(count(*), 25)::BIGINT AS count,
               (SELECT last_updated FROM ({HERO}) ORDER BY total_wins, hero_id LIMIT 1) AS last_updated
        FROM ({HERO})""",
    "scoreboard": _ordered(f"({HERO})", "total_wins DESC, hero_id", 30),
    "browse_page": _ordered("lineitem", f"l_extendedprice DESC, {LINE_ORDER}", 200, 400),
    "browse_struct_page": _ordered(
        "lineitem",
        "l_returnflag NULLS FIRST, CASE WHEN l_linenumber > 1 THEN l_shipdate END NULLS FIRST, " + LINE_ORDER, 200, 4800),
    "browse_array_page": _ordered(
        "lineitem", "l_discount DESC, CASE WHEN l_linenumber > 2 THEN l_tax END DESC NULLS LAST, " + LINE_ORDER, 200, 4800),
    "browse_all_pages": "SELECT p_partkey, 1::BIGINT AS times FROM part",
    "browse_gate": """
        SELECT * FROM (VALUES ('match_history', '', 'HeroRequired', NULL), ('match_history', 'x', 'HeroRequired', NULL),
            ('match_history', '7', 'shown', (SELECT count(*) FROM lineitem WHERE l_suppkey = 7)),
            ('secret', '7', 'ValueError', NULL)) AS a(collection, hero, answer, total)""",
    "column_choices": """
        SELECT name, 'O ' || upper(name[3]) || name[4:] AS label, filled FROM (
            UNPIVOT (SELECT count(COLUMNS(*)) FROM orders) ON COLUMNS(*) INTO NAME name VALUE filled)""",
    "browse_deep_page": f"""
        SELECT * FROM lineitem ORDER BY l_extendedprice, {LINE_ORDER} LIMIT 200 OFFSET 49800""",
    "browse_hot_value_page": f"""
        SELECT * FROM lineitem ORDER BY l_returnflag DESC, {LINE_ORDER}, l_extendedprice LIMIT 150 OFFSET 29850""",
    "browse_meta": META.format("lineitem", 7, 50)
    + ', 50 AS "limit", greatest(least(count(*) - 300, 50), 0)::INTEGER AS count FROM lineitem',
    "browse_past_end_meta": META.format("part", 100000, 200) + ', 200 AS "limit", 0 AS count FROM part',
    "browse_hero_filter": f"""
        SELECT * FROM ({HISTORY}) WHERE hero_id = 7 ORDER BY match_id, account_id, line LIMIT 200""",
    "browse_missing_column": "SELECT * FROM part WHERE false",
    "browse_unknown_sort": "SELECT * FROM part ORDER BY p_partkey LIMIT 30 OFFSET 30",
    "search_page": """
        SELECT * FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 200 OFFSET 200)
        WHERE contains(lower(p_name), 'red') OR contains(lower(p_brand), 'red')
           OR contains(lower(p_type), 'red')""",
    "search_table": """
        SELECT * FROM part WHERE contains(p_partkey::VARCHAR, '19') OR contains(p_name, '19')
           OR contains(p_brand, '19') OR contains(p_type, '19') OR contains(p_size::VARCHAR, '19')
           OR contains(p_retailprice::VARCHAR, '19')""",
    "search_documents": """
        SELECT doc_id, lang, n_chars FROM documents
        WHERE contains(lower(text), 'data') OR contains(lower(lang), 'data') OR contains(lower(source), 'data')""",
    "search_indexed": """
        SELECT * FROM part WHERE contains(p_partkey::VARCHAR, '199') OR contains(p_name, '199')
           OR contains(p_brand, '199') OR contains(p_type, '199') OR contains(p_size::VARCHAR, '199')
           OR contains(p_retailprice::VARCHAR, '199')""",
    "search_indexed_documents": """
        SELECT doc_id, lang, n_chars FROM documents
        WHERE contains(lower(text), 'data') OR contains(lower(lang), 'data') OR contains(lower(source), 'data')""",
    "search_indexed_nested": """
        SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events
        WHERE (props::JSON->>'k')::BIGINT = 12 OR starts_with((props::JSON->>'k'), '12')""",
    "list_collections": COUNTS,
    "collections_nav": f"""
        SELECT min(position) OVER (PARTITION BY category) AS category_position, position, category, name,
               upper(left(name, 1)) || substr(name, 2) AS label,
               CASE WHEN count >= 1000000 THEN printf('%.1fM', count / 1000000)
                    WHEN count >= 1000 THEN floor(count / 1000 + 0.5)::BIGINT || 'k'
                    ELSE count::VARCHAR END AS count_label
        FROM ({COUNTS}) WHERE count <> 0""",
}

# the month whose stamp is unreadable counts, but is nobody's latest
ORACLE_SQL["streamed_win_rate_legacy"] = HERO.replace(
    "max(fetched_at)", f"max(fetched_at) FILTER (fetched_at > (SELECT min(fetched_at) FROM ({HERO_SNAPSHOTS})))")

# display
GROUPED = "CASE WHEN {0} >= 1000 THEN format('{{:,}}', {0}) ELSE {0}::VARCHAR END"
ORACLE_SQL |= {
    "report_of_odd_names": f"""
        SELECT * FROM (
            SELECT coalesce(name, 'Hero ' || hero_id) AS "Hero", {GROUPED.format('total_wins')} AS "Wins",
                   {GROUPED.format('total_losses')} AS "Wins (wins)", '_name ' || hero_id AS " Name",
                   '_hash ' || hero_id AS " Hash", '_file ' || hero_id AS " File", '_row ' || hero_id AS " Row",
                   '_salt ' || hero_id AS " Salt"
            FROM ({HERO}) h LEFT JOIN {NAMES} d ON d.id = hero_id
            WHERE contains(hero_id || ' ' || total_wins || ' ' || total_losses, '1')
            ORDER BY total_wins DESC, hero_id LIMIT 200)""",
    "report_view": f"""
        SELECT coalesce(name, 'Hero ' || hero_id) AS "Hero", {GROUPED.format('total_wins')} AS "Wins",
               {GROUPED.format('total_losses')} AS "Losses", {GROUPED.format('total_matches')} AS "Matches",
               strftime(strptime(left(last_updated, 19), '%Y-%m-%dT%H:%M:%S'), '%-m/%-d/%Y, %-I:%M:%S %p')
               AS "Last Updated",
               printf('%.2f%%', win_rate * 100) AS "Win Rate",
               CASE WHEN length(detail) > 80 THEN left(detail, 80) || '…' ELSE detail END AS "Detail"
        FROM (SELECT *, '{{"total_wins":' || total_wins || ',"note":"' || repeat('x', total_losses % 70) || '"}}'
              AS detail FROM ({HERO})) h LEFT JOIN {NAMES} d ON d.id = hero_id
        ORDER BY total_matches DESC, hero_id LIMIT 200""",
    "win_rate_band": f"""
        SELECT *, printf('%.2f%%', win_rate * 100) AS win_rate_text,
               CASE WHEN win_rate * 100 >= 52 THEN 'high' WHEN win_rate * 100 >= 48 THEN 'mid' ELSE 'low' END
               AS win_rate_band, least(win_rate * 100, 100.0::DOUBLE) AS win_rate_width
        FROM ({HERO})""",
    "display_numbers": """
        SELECT o_orderkey,
               CASE WHEN o_custkey >= 1000 THEN format('{:,}', o_custkey) ELSE o_custkey::VARCHAR END AS custkey,
               format('{:,}', floor(o_totalprice)::BIGINT)
               || rtrim(rtrim(substr(printf('%.2f', o_totalprice), -3), '0'), '.') AS price,
               rtrim(rtrim(printf('%.2f', o_totalprice), '0'), '.') AS plain,
               CASE WHEN n >= 1000000 THEN (n + 50000) // 1000000 || '.' || ((n + 50000) // 100000) % 10 || 'M'
                    WHEN n >= 1000 THEN (n + 500) // 1000 || 'k' ELSE n::VARCHAR END AS short,
               array_to_string(list_transform(
                   string_split(lower(regexp_replace(o_orderpriority, '[ -]', '_', 'g')), '_'),
                   lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS title,
               CASE WHEN length(js) > 60 THEN left(js, 60) || '…' ELSE js END AS nested
        FROM (SELECT *, floor(o_totalprice)::BIGINT * 7 AS n,
                     '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus
                     || '","o_orderpriority":"' || o_orderpriority || '"}' AS js FROM orders)""",
}

# jobs
REPORT = f"""
    SELECT * FROM (VALUES
        ('hero_stats', 'hero', 'OK', (SELECT count(*) FROM ({HERO})), 1, 0),
        ('item_stats', 'item', 'OK', (SELECT count(*) FROM ({_win_rate('l_orderkey', 'item_id')})), 0, 0),
        ('badge_distribution', 'generic', 'OK', (SELECT count(*) FROM events), 0, 1),
        ('bulk_metadata', 'shallow', 'SKIP', NULL, NULL, NULL),
        ('leaderboards', 'generic', 'SKIP', NULL, NULL, NULL),
        ('match_history', 'shallow', 'OK', (SELECT count(*) FROM lineitem), 0, 0)
    ) AS r(endpoint, mode, status, rows, rejected, corrupt)"""
ORACLE_SQL |= {
    "run_report": REPORT,
    "run_report_tallies": f"""
        SELECT status, count(*) AS endpoints, coalesce(sum(rows), 0)::BIGINT AS rows
        FROM ({REPORT}) WHERE endpoint <> 'leaderboards' GROUP BY 1""",
    "refreshed_twice": f"""
        WITH months AS (SELECT DISTINCT fetched_at, month(fetched_at[:10]::DATE) % 2 AS run FROM ({HERO_SNAPSHOTS})),
        history AS (SELECT l_linenumber % 2 AS run FROM lineitem)
        SELECT run, 'hero_stats' AS endpoint, 'OK' AS status, CASE run WHEN 0 THEN 'built' ELSE 'continued' END AS how,
               (SELECT count(*) FROM months m WHERE m.run = r.run) AS envelopes,
               CASE run WHEN 0 THEN (SELECT count(*) FROM ({_win_rate('l_suppkey', 'hero_id', 'month(l_shipdate) % 2 = 0')}))
                        ELSE (SELECT count(*) FROM ({HERO})) END AS rows
        FROM (VALUES (0), (1)) AS r(run)
        UNION ALL
        SELECT run, 'match_history', 'OK', CASE run WHEN 0 THEN 'built' ELSE 'continued' END, 1,
               (SELECT count(*) FROM history h WHERE h.run <= r.run) FROM (VALUES (0), (1)) AS r(run)
        UNION ALL
        SELECT run, 'badge_distribution', 'OK', 'built', run + 1,
               (SELECT count(*) FROM events WHERE event_id % 2 <= run) FROM (VALUES (0), (1)) AS r(run)""",
    "refreshed_twice_heroes": HERO,
    "refreshed_twice_events": f"""
        SELECT CASE event_id % 2 WHEN 0 THEN '2026-04-05' ELSE '2026-04-06' END || 'T10:00:00+00:00' AS fetched_at,
               event_id, event_type, CASE event_id % 2 WHEN 1 THEN value END AS value, {K} AS props_k FROM events""",
    "refreshed_history": ORACLE_SQL["landed_history"],
}

# continued refresh: backfills, replaced and removed files; published versions
EVENT_RUN = "2 - event_id % 3"
ORACLE_SQL |= {
    "refreshed_backfill_heroes": HERO,
    "refreshed_backfill_events": f"""
        SELECT '200' || (9 - ({EVENT_RUN})) || '-04-05T10:00:00+00:00' AS fetched_at, event_id, event_type,
               CASE event_id % 3 WHEN 0 THEN value END AS value, {K} AS props_k FROM events""",
    "refreshed_backfill": f"""
        WITH runs AS (SELECT * FROM (VALUES (0), (1), (2)) AS r(run)),
        months AS (SELECT DISTINCT fetched_at, CASE WHEN left(fetched_at, 4) >= '1997' THEN 0 WHEN left(fetched_at, 4) >= '1995' THEN 1 ELSE 2 END AS run
                   FROM ({HERO_SNAPSHOTS}))
        SELECT run, 'hero_stats' AS endpoint, 'OK' AS status, CASE run WHEN 0 THEN 'built' ELSE 'continued' END AS how,
               (SELECT count(*) FROM months m WHERE m.run = r.run) AS envelopes,
               CASE run WHEN 0 THEN (SELECT count(*) FROM ({_win_rate('l_suppkey', 'hero_id', 'year(l_shipdate) >= 1997')}))
                        WHEN 1 THEN (SELECT count(*) FROM ({_win_rate('l_suppkey', 'hero_id', 'year(l_shipdate) >= 1995')}))
                        ELSE (SELECT count(*) FROM ({HERO})) END AS rows, 0::BIGINT AS replaced, 0::BIGINT AS removed
        FROM runs r
        UNION ALL
        SELECT run, 'badge_distribution', 'OK', CASE run WHEN 1 THEN 'continued' ELSE 'built' END, CASE run WHEN 2 THEN 3 ELSE 1 END,
               (SELECT count(*) FROM events WHERE {EVENT_RUN} <= run), 0, 0 FROM runs""",
    "refreshed_replaced_heroes": _win_rate("l_suppkey", "hero_id", "month(l_shipdate) <= 7"),
    "refreshed_replaced_history": """
        SELECT CASE l_linenumber % 2 WHEN 0 THEN '2026-04-05' ELSE '2026-04-06' END || 'T10:00:00+00:00' AS fetched_at,
               l_partkey AS account_id, l_orderkey AS match_id, l_suppkey AS hero_id, l_linenumber AS line
        FROM lineitem WHERE l_linenumber % 2 = 1 OR l_linenumber % 4 = 2""",
    "refreshed_replaced": f"""
        WITH runs AS (SELECT * FROM (VALUES (0), (1), (2)) AS r(run))
        SELECT run, 'hero_stats' AS endpoint, 'OK' AS status, CASE run WHEN 0 THEN 'built' ELSE 'continued' END AS how,
               CASE run WHEN 0 THEN (SELECT count(*) FROM ({_win_rate('l_suppkey', 'hero_id', 'month(l_shipdate) <= 6 OR year(l_shipdate) >= 1995')}))
                        ELSE (SELECT count(*) FROM ({_win_rate('l_suppkey', 'hero_id', 'month(l_shipdate) <= 7')})) END AS rows
        FROM runs
        UNION ALL
        SELECT run, 'match_history', 'OK', CASE run WHEN 0 THEN 'built' ELSE 'continued' END,
               (SELECT count(*) FROM lineitem WHERE l_linenumber % 2 = 1 OR l_linenumber % 4 = 2 OR run = 0) FROM runs""",
    "list_published": """
        SELECT position::INTEGER AS position, name, 'Published' AS category, false AS requires_hero, count FROM (VALUES
            (0, 'nation', (SELECT count(*) FROM nation)), (1, 'supplier', (SELECT count(*) FROM supplier)),
            (2, 'orders', (SELECT count(*) FROM orders)), (3, 'events', (SELECT count(*) FROM events)), (4, 'missing', 0)) AS t(position, name, count)""",
    "browse_published_pages": """
        SELECT (n - 1) % 200 AS position, o_orderkey, o_custkey, o_totalprice, (1 + (n - 1) // 200)::INTEGER AS page, total,
               ceil(total / 200)::INTEGER AS pages
        FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n, count(*) OVER () AS total FROM orders)
        WHERE 1 + (n - 1) // 200 IN (1, 7, 70, 75, 76)""",
}

ORACLE_SQL["refreshed_variants"] = """
    SELECT 'badge_distribution' AS endpoint, 'generic' AS mode, 'OK' AS status, count(*)::BIGINT AS rows, '' AS message,
           0::BIGINT AS rejected, 0::BIGINT AS corrupt FROM events
    UNION ALL SELECT 'match_history', 'shallow', 'OK', count(*)::BIGINT, '', 0, 0 FROM lineitem
    UNION ALL SELECT 'player_scoreboards', 'shallow', 'SKIP', NULL, 'folder not found or empty', NULL, NULL"""
ORACLE_SQL["refreshed_variants_drift"] = """
    SELECT event_id, event_type, (props::JSON->>'k')::BIGINT AS props_k,
           CASE WHEN event_type = 'error' THEN '2026-04-06T10:00:00+00:00' ELSE '2026-04-05T10:00:00+00:00' END AS fetched_at,
           CASE WHEN event_type = 'error' THEN 'none for ' || event_id ELSE (event_id % 100)::VARCHAR END AS value,
           CASE WHEN event_type = 'error' THEN event_id % 3 END AS late
    FROM events"""
