"""DuckDB SQL giving the result of every query in the catalogue."""

from __future__ import annotations

# Named subqueries; each may use the ones before it.
CTES = {
    "users": """
        SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS user_id, c_name, c_acctbal, c_mktsegment, c_nationkey,
               n_name, n_regionkey, r_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "country_users": "SELECT user_id, r_name AS country_short FROM users",
    "seeds": "SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_acctbal > 9500",
    "locations": """
        SELECT n_name AS user_location, r_name AS country_short
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'""",
    "user_columns": """
        SELECT c_custkey, user_id,
               1400000000 + c_custkey * 3600 AS user_timestamp,
               c_acctbal < 0 AS user_default_profile_image,
               c_mktsegment AS user_description,
               CAST(floor(abs(c_acctbal)) AS BIGINT) AS user_favourites_count,
               CAST(c_nationkey AS BIGINT) AS user_followers_count,
               CAST(n_regionkey AS BIGINT) AS user_friends_count,
               c_mktsegment = 'BUILDING' AS user_geo_enabled,
               n_name AS user_location,
               c_name AS user_name,
               c_mktsegment = 'FURNITURE' AS user_notifications,
               'https://example.org/image/' || user_id AS user_profile_image_url_https,
               c_mktsegment = 'AUTOMOBILE' AS user_protected,
               lower(c_name) AS user_screen_name,
               c_custkey + 1 AS user_statuses_count,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'https://example.org/' || user_id END AS user_url,
               c_acctbal > 9500 AS user_verified
        FROM users""",
    "posts": """
        SELECT event_id, CAST(event_id AS VARCHAR) AS tweet_id,
               CAST(floor(epoch(ts)) AS BIGINT) AS tweet_timestamp,
               CAST(user_id AS VARCHAR) AS user_id,
               CASE WHEN event_type <> 'view' THEN NULL
                    WHEN event_id % 3 = 0 THEN [json_extract_string(props, '$.k'), CAST(user_id AS VARCHAR),
                                                json_extract_string(props, '$.k')]
                    ELSE [json_extract_string(props, '$.k')] END AS mentioned,
               CASE WHEN event_type = 'click' OR event_type = 'view' AND event_id % 2 = 0
                    THEN json_extract_string(props, '$.k') END AS tweet_retweeted_user_id,
               CASE WHEN event_type = 'purchase' THEN json_extract_string(props, '$.k') END
                   AS tweet_in_reply_to_user_id
        FROM events""",
    "flat_posts": """
        SELECT p.event_id, tweet_id, tweet_timestamp, event_type AS tweet_lang,
               event_type || ' ' || props AS tweet_text, tweet_retweeted_user_id, tweet_in_reply_to_user_id,
               array_to_string(mentioned, '|') AS tweet_mentioned_user_id,
               CASE WHEN event_type = 'view' THEN 'https://example.org/post/' || tweet_id
                    || '|https://example.org/user/' || p.user_id END AS tweet_urls,
               CASE WHEN event_type = 'signup' THEN '{"id":"' || c.c_nationkey || '","country_code":"' || r_name
                    || '","full_name":"' || n_name
                    || '","bounding_box":{"type":"Polygon","coordinates":[[[1,2],[3,4]]]}}' END AS tweet_place,
               CASE WHEN event_type = 'purchase' THEN value END AS tweet_longitude,
               CASE WHEN event_type = 'purchase' THEN -value END AS tweet_latitude,
               u.* EXCLUDE (c_custkey, user_statuses_count), p.event_id AS user_statuses_count
        FROM posts p JOIN events e ON p.event_id = e.event_id
             JOIN user_columns u ON u.c_custkey = e.user_id JOIN users c ON c.c_custkey = e.user_id""",
    "edges": """
        SELECT user_id, t.neighbor_id
        FROM (SELECT user_id, unnest(list_concat(coalesce(mentioned, []),
                                                 [tweet_retweeted_user_id, tweet_in_reply_to_user_id])) AS neighbor_id
              FROM posts) AS t
        WHERE t.neighbor_id IS NOT NULL""",
    "snowball": """
        SELECT neighbor_id AS user_id, l.country_short, count(*) AS n_users,
               count(DISTINCT e.user_id) AS n_authors
        FROM edges e JOIN users u ON u.user_id = e.user_id
             LEFT JOIN locations l ON l.user_location = u.n_name
        GROUP BY neighbor_id, l.country_short""",
    "latest": """
        SELECT * FROM (
            SELECT user_id, tweet_id, tweet_timestamp, count(*) OVER (PARTITION BY user_id) AS tweet_count,
                   row_number() OVER (PARTITION BY user_id ORDER BY tweet_timestamp DESC, event_id DESC) AS pick
            FROM posts) WHERE pick = 1""",
    "profiles": """
        SELECT tweet_id, tweet_timestamp, tweet_count,
               u.* EXCLUDE (c_custkey, user_statuses_count), CAST(tweet_id AS BIGINT) AS user_statuses_count,
               l.country_short
        FROM latest p JOIN user_columns u ON u.user_id = p.user_id
             LEFT JOIN locations l ON l.user_location = u.user_location""",
    "raw_users": """
        SELECT CASE WHEN c_acctbal >= 0 THEN user_id || '1' END AS tweet_id,
               CASE WHEN c_acctbal >= 0 THEN 1600000000 + CAST(floor(c_acctbal) AS BIGINT) END AS tweet_timestamp,
               u.* EXCLUDE (c_custkey)
        FROM user_columns u JOIN users USING (user_id)
        UNION ALL BY NAME
        SELECT CASE WHEN s_acctbal >= 0 THEN CAST(s_suppkey AS VARCHAR) || '2' END AS tweet_id,
               CASE WHEN s_acctbal >= 0 THEN 1600000000 + CAST(floor(s_acctbal) AS BIGINT) END AS tweet_timestamp,
               CAST(s_suppkey AS VARCHAR) AS user_id,
               1400000000 + s_suppkey * 3600 AS user_timestamp,
               s_acctbal < 0 AS user_default_profile_image,
               'SUPPLIER' AS user_description,
               CAST(floor(abs(s_acctbal)) AS BIGINT) AS user_favourites_count,
               CAST(s_nationkey AS BIGINT) AS user_followers_count,
               CAST(n_regionkey AS BIGINT) AS user_friends_count,
               FALSE AS user_geo_enabled,
               n_name AS user_location,
               s_name AS user_name,
               FALSE AS user_notifications,
               'https://example.org/image/' || CAST(s_suppkey AS VARCHAR) AS user_profile_image_url_https,
               FALSE AS user_protected,
               lower(s_name) AS user_screen_name,
               s_suppkey + 1 AS user_statuses_count,
               'https://example.org/' || CAST(s_suppkey AS VARCHAR) AS user_url,
               s_acctbal > 9500 AS user_verified
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "lookups": """
        SELECT r.* EXCLUDE (pick), l.country_short FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, user_location
                       ORDER BY tweet_timestamp DESC NULLS LAST, CAST(tweet_id AS BIGINT) DESC NULLS LAST,
                                user_statuses_count DESC) AS pick
            FROM raw_users) r LEFT JOIN locations l ON l.user_location = r.user_location
        WHERE pick = 1""",
    "looked_up": """
        SELECT user_id, country_short FROM (
            SELECT user_id, country_short,
                   row_number() OVER (PARTITION BY user_id
                       ORDER BY tweet_timestamp DESC NULLS LAST, CAST(tweet_id AS BIGINT) DESC NULLS LAST,
                                country_short DESC) AS pick
            FROM lookups WHERE country_short IS NOT NULL) WHERE pick = 1""",
    "timelines": """
        SELECT user_id, country_short, tweet_id, make_timestamp(tweet_timestamp * 1000000) AS tweet_timestamp
        FROM profiles WHERE country_short IS NOT NULL""",
    "batch": """
        SELECT b.user_id, country_short, tweet_id, tweet_timestamp,
               CAST(CASE WHEN s.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_seed
        FROM (SELECT * FROM timelines
              UNION ALL
              SELECT user_id, country_short, NULL, NULL FROM looked_up
              WHERE user_id NOT IN (SELECT user_id FROM timelines)) b
             LEFT JOIN seeds s ON s.user_id = b.user_id""",
    "fresh": "SELECT * FROM posts WHERE tweet_timestamp >= 1706572800",
    "friend_lists": "SELECT DISTINCT user_id, mentioned[1] AS friend_id FROM posts WHERE mentioned IS NOT NULL",
    "arrays": """
        SELECT *, ['sound', 'mistyped', 'nameless', 'broken'][user_followers_count % 4 + 1] AS kind,
               CAST(user_id AS BIGINT) // 10000 AS block
        FROM raw_users""",
    "laid_out": """
        SELECT CASE WHEN user_friends_count % 2 = 0 THEN 'XA' ELSE 'XB' END AS country_short,
               strftime(make_timestamp(tweet_timestamp * 1000000), '%d') || '2024' AS pull_date,
               CASE WHEN tweet_lang = 'view' THEN 'full' ELSE 'update' END AS pull_type
        FROM flat_posts""",
    "links": """
        SELECT CAST(page_id AS VARCHAR) AS tweet_id, upper(regexp_extract(url, '//[^/]+/([a-z]+)/', 1))
                   AS country_short,
               regexp_extract_all(html, 'href="([^"]+)"', 1) AS urls
        FROM pages
        WHERE regexp_extract(url, '//[^/]+/([a-z]+)/', 1) IN (SELECT lang FROM documents)""",
    "geocodes": "SELECT user_id, country_short FROM profiles UNION SELECT user_id, country_short FROM lookups",
}

WALK = """
    inside AS (SELECT user_id, country_short FROM country_users
               WHERE country_short IN ('AFRICA', 'AMERICA', 'EUROPE')),
    mentions AS (SELECT user_id, unnest(mentioned) AS neighbor_id FROM posts),
    inside_edges AS (
        SELECT DISTINCT a.country_short, m.user_id, m.neighbor_id
        FROM mentions m JOIN inside a ON a.user_id = m.user_id
             JOIN inside b ON b.user_id = m.neighbor_id AND b.country_short = a.country_short),
    walk(country_short, user_id, depth) AS (
        SELECT country_short, user_id, 0 FROM inside WHERE user_id IN (SELECT user_id FROM seeds)
        UNION
        SELECT e.country_short, e.neighbor_id, w.depth + 1
        FROM walk w JOIN inside_edges e ON e.user_id = w.user_id AND e.country_short = w.country_short
        WHERE w.depth < 4),
    members AS (SELECT country_short, user_id, CAST(min(depth) AS INTEGER) AS level
                FROM walk GROUP BY country_short, user_id)"""


def sql(body: str, *names: str) -> str:
    """``body`` after the named subqueries."""
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in names)
    return f"WITH {ctes}\n{body}" if names else body


def walk(body: str) -> str:
    names = ("users", "country_users", "seeds", "posts")
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in names)
    return f"WITH RECURSIVE {ctes},\n{WALK}\n{body}"


LOCATED = ("users", "locations", "user_columns", "posts")
FLAT = ("users", "user_columns", "posts", "flat_posts")
PROFILES = (*LOCATED, "latest", "profiles")
LOOKUPS = ("users", "locations", "user_columns", "raw_users", "lookups")
SNOWBALL = ("users", "locations", "posts", "edges", "snowball")
BATCH = (
    "users", "seeds", "locations", "user_columns", "posts", "latest", "profiles", "raw_users", "lookups",
    "looked_up", "timelines", "batch",
)
ARRAYS = ("users", "user_columns", "raw_users", "arrays")
WANTED = "country_short IN ('AFRICA', 'AMERICA', 'EUROPE')"
SHARDED = """
    SELECT *, CAST(ntile(7) OVER (PARTITION BY country_short ORDER BY md5(user_id || '0'), user_id) - 1
                   AS INTEGER) AS shard
    FROM {source}"""
NUMBERED = """
    SELECT *, row_number() OVER (PARTITION BY country_short, shard ORDER BY md5(user_id || '0'), user_id) - 1
                  AS shard_position
    FROM ({sharded})"""

FUNNEL = sql(
    f"""SELECT count(*) AS n_all,
               count(*) FILTER (a) AS n_in_countries,
               count(*) FILTER (a AND b) AS n_update,
               count(*) FILTER (a AND b AND c) AS n_before_max,
               count(*) FILTER (a AND b AND c AND d) AS n_after_min,
               count(*) FILTER (a AND b AND c AND d AND e) AS n_not_seed,
               count(DISTINCT CASE WHEN a AND b AND c AND d AND e THEN user_id END) AS n_unique
        FROM (SELECT user_id, {WANTED} AS a, tweet_timestamp IS NOT NULL AS b,
                     tweet_timestamp < TIMESTAMP '2024-01-30 18:00:00' AS c,
                     tweet_timestamp > TIMESTAMP '2024-01-29 06:00:00' AS d, is_seed = 0 AS e
              FROM batch)""",
    *BATCH,
)

ORACLE_SQL = {
    "snowball": sql("SELECT user_id, country_short, n_users FROM snowball", *SNOWBALL),
    "snowball_distinct_authors": sql("SELECT user_id, country_short, n_authors AS n_users FROM snowball", *SNOWBALL),
    "edge_counts": sql(
        "SELECT user_id, neighbor_id, count(*) AS n_edges FROM edges GROUP BY user_id, neighbor_id", "posts", "edges"
    ),
    "flatten_posts": sql("SELECT * EXCLUDE (event_id) FROM flat_posts", *FLAT),
    "extract_posts": sql(
        "SELECT * EXCLUDE (event_id) REPLACE (user_statuses_count + 1 AS user_statuses_count) FROM flat_posts", *FLAT
    ),
    "dedup_posts": sql("SELECT * EXCLUDE (event_id, mentioned) FROM posts", "posts"),
    "parse_created_at": sql(
        "SELECT tweet_id, tweet_timestamp, make_timestamp(tweet_timestamp * 1000000) AS posted_at FROM posts", "posts"
    ),
    "latest_per_user": sql("SELECT * EXCLUDE (pick) FROM latest", "posts", "latest"),
    "timeline_profiles": sql("SELECT * FROM profiles", *PROFILES),
    "flatten_users": sql("SELECT * FROM raw_users", "users", "user_columns", "raw_users"),
    "users_profiles": sql("SELECT * FROM lookups", *LOOKUPS),
    "geocode_left": sql(
        """SELECT l.country_short, count(*) AS n_users
           FROM raw_users r LEFT JOIN locations l ON l.user_location = r.user_location GROUP BY l.country_short""",
        *LOOKUPS,
    ),
    "geocode_inner_shuffled": sql(
        """SELECT l.country_short, count(*) AS n_users
           FROM raw_users r JOIN locations l ON l.user_location = r.user_location GROUP BY l.country_short""",
        *LOOKUPS,
    ),
    "users_batch": sql(
        """SELECT user_id FROM seeds UNION SELECT user_id FROM snowball
           EXCEPT
           SELECT user_id FROM users WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
        "users", "seeds", "locations", "posts", "edges", "snowball",
    ),
    "timeline_batch_v2": sql("SELECT * FROM batch", *BATCH),
    "timeline_batch_v1": sql(
        """SELECT g.user_id, g.country_short, g.n_users, p.tweet_id,
                  make_timestamp(p.tweet_timestamp * 1000000) AS tweet_timestamp
           FROM (SELECT user_id, country_short, CAST(NULL AS BIGINT) AS n_users FROM geocodes
                 UNION ALL
                 SELECT s.user_id, s.country_short, s.n_users FROM snowball s
                 WHERE NOT EXISTS (SELECT 1 FROM geocodes g
                                   WHERE g.user_id = s.user_id AND g.country_short = s.country_short)) g
                LEFT JOIN profiles p ON p.user_id = g.user_id
           WHERE g.country_short IS NOT NULL""",
        *PROFILES, "raw_users", "lookups", "edges", "snowball", "geocodes",
    ),
    "remaining_batch": sql(
        "SELECT * FROM batch WHERE user_id NOT IN (SELECT user_id FROM fresh)", *BATCH, "fresh"
    ),
    "network_batch": sql(
        """SELECT user_id FROM lookups WHERE country_short = 'AFRICA'
           EXCEPT SELECT user_id FROM friend_lists""",
        *LOOKUPS, "posts", "friend_lists",
    ),
    "network_batches": sql(
        f"""SELECT DISTINCT country_short, user_id FROM lookups l
            WHERE {WANTED} AND (country_short = 'AFRICA' OR user_id NOT IN
                (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'click'))""",
        *LOOKUPS,
    ),
    "level_members": walk("SELECT country_short, user_id, level FROM members"),
    "level_stats": walk(
        """SELECT country_short, count(*) FILTER (level = 0) AS n_seeds,
                  count(*) FILTER (level = 1) AS n_snowball_1,
                  count(*) FILTER (level = 2) AS n_snowball_2,
                  count(*) FILTER (level = 3) AS n_snowball_3,
                  count(*) FILTER (level = 4) AS n_snowball_4
           FROM (VALUES ('AFRICA'), ('AMERICA'), ('EUROPE'), ('NOWHERE')) AS asked(country_short)
                LEFT JOIN members USING (country_short)
           GROUP BY country_short"""
    ),
    "post_urls": sql(
        """SELECT tweet_id, urls[1] AS url, country_short FROM links
           WHERE country_short IN ('DE', 'EN', 'FR') AND len(urls) > 0""",
        "links",
    ),
    "post_urls_all": sql(
        "SELECT tweet_id, unnest(urls) AS url, country_short FROM links WHERE country_short IN ('EN', 'ES')", "links"
    ),
    "friend_edges": sql("SELECT user_id, friend_id FROM friend_lists", "posts", "friend_lists"),
    "follow_edges": sql(
        """SELECT user_id AS follower_id, json_extract_string(props, '$.k') AS followed_id
           FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, props FROM events WHERE event_type = 'view')
           WHERE followed_id IS NOT NULL
           UNION
           SELECT json_extract_string(props, '$.k'), CAST(user_id AS VARCHAR) FROM events
           WHERE event_type = 'click' AND json_extract_string(props, '$.k') IS NOT NULL"""
    ),
    "friend_map_users": sql("SELECT DISTINCT user_id FROM friend_lists", "posts", "friend_lists"),
    "select_work_full": sql(
        f"""{NUMBERED.format(sharded=SHARDED.format(source=f'''
            (SELECT * FROM batch WHERE {WANTED} AND tweet_timestamp IS NULL AND is_seed = 0)'''))}""",
        *BATCH,
    ),
    "select_work_update": sql(
        f"""{NUMBERED.format(sharded=SHARDED.format(source=f'''
            (SELECT * FROM batch WHERE {WANTED} AND tweet_timestamp < TIMESTAMP '2024-01-30 18:00:00'
                                   AND tweet_timestamp > TIMESTAMP '2024-01-29 06:00:00')'''))}""",
        *BATCH,
    ),
    "select_users": """
        SELECT * EXCLUDE (pick) FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tweet_timestamp DESC,
                       CAST(tweet_id AS BIGINT) DESC, country_short DESC) AS pick
            FROM (SELECT CAST(l_orderkey AS VARCHAR) AS user_id, l_returnflag AS country_short,
                         CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR)
                             AS tweet_id,
                         l_shipdate AS tweet_timestamp, CAST(l_tax = 0 AS INTEGER) AS is_seed
                  FROM lineitem)
            WHERE country_short IN ('A', 'R') AND is_seed = 0
              AND tweet_timestamp < TIMESTAMP '1999-07-01' AND tweet_timestamp > TIMESTAMP '1996-01-01')
        WHERE pick = 1""",
    "work_head": sql("SELECT * FROM batch ORDER BY user_id LIMIT 20", *BATCH),
    "shard_sizes": sql(
        f"""SELECT country_short, shard, count(*) AS n_users
            FROM ({SHARDED.format(source="country_users")}) GROUP BY country_short, shard""",
        "users", "country_users",
    ),
    "cut_shard_users": sql(SHARDED.format(source="country_users"), "users", "country_users"),
    "chunk_sizes": sql(
        f"""SELECT country_short, shard, CAST(shard_position // 20 AS INTEGER) AS chunk, count(*) AS n_ids,
                   string_agg(user_id, ',' ORDER BY shard_position) AS ids
            FROM ({NUMBERED.format(sharded=SHARDED.format(source="country_users"))})
            GROUP BY country_short, shard, CAST(shard_position // 20 AS INTEGER)""",
        "users", "country_users",
    ),
    "newer_than_mark": sql(
        """SELECT tweet_id, p.user_id, tweet_timestamp
           FROM posts p LEFT JOIN (SELECT user_id, max_by(event_id, (tweet_timestamp, event_id)) AS mark
                                   FROM posts WHERE tweet_timestamp < 1705708800 GROUP BY user_id) m
                ON m.user_id = p.user_id
           WHERE mark IS NULL OR event_id > mark""",
        "posts",
    ),
    "monthly_counts": """
        SELECT last_day(m.month) AS month_end, count(o_custkey) AS n_users
        FROM (SELECT CAST(unnest(generate_series(min(date_trunc('month', o_orderdate)),
                                                 max(date_trunc('month', o_orderdate)),
                                                 INTERVAL 1 MONTH)) AS DATE) AS month FROM orders) m
             LEFT JOIN orders ON date_trunc('month', o_orderdate) = m.month
        WHERE last_day(m.month) >= DATE '1996-07-01'
        GROUP BY m.month""",
    "request_estimate": sql(
        """SELECT u.user_id, count(tweet_id) AS n_tweets,
                  greatest(1, CAST(ceil(count(tweet_id) / 20) AS BIGINT)) AS n_requests
           FROM country_users u LEFT JOIN posts p ON p.user_id = u.user_id GROUP BY u.user_id""",
        "users", "country_users", "posts",
    ),
    "pull_coverage": sql(
        """SELECT country_short, pull_type, count(*) AS n_users_asked,
                  count(n) AS n_users_got, count(*) - count(n) AS n_users_missed,
                  CAST(coalesce(sum(n), 0) AS BIGINT) AS n_tweets
           FROM (SELECT country_short, CASE WHEN b.tweet_timestamp IS NOT NULL AND b.tweet_id IS NOT NULL THEN 'update' ELSE 'full' END
                            AS pull_type,
                        (SELECT nullif(count(*), 0) FROM fresh f WHERE f.user_id = b.user_id) AS n
                 FROM batch b)
           GROUP BY country_short, pull_type""",
        *BATCH, "fresh",
    ),
    "coverage_by_pull": sql(
        """SELECT country_short, pull_date, pull_type, any_value(asked) AS n_users_asked, count(*) AS n_users_got,
                  any_value(asked) - count(*) AS n_users_missed,
                  CAST(sum((n + 1) // 2) AS BIGINT) AS n_requests, CAST(sum(n) AS BIGINT) AS n_tweets
           FROM (SELECT country_short, pull_type, asked, user_id,
                        strftime(make_timestamp(CAST(f.tweet_timestamp AS BIGINT) * 1000000), '%d%m%Y') AS pull_date, count(*) AS n
                 FROM fresh f JOIN (
                     SELECT *, count(*) OVER (PARTITION BY country_short, pull_type) AS asked
                     FROM (SELECT DISTINCT user_id, country_short,
                                  CASE WHEN tweet_timestamp IS NOT NULL AND tweet_id IS NOT NULL THEN 'update' ELSE 'full' END AS pull_type
                           FROM batch)) USING (user_id)
                 GROUP BY ALL)
           WHERE country_short IS NOT NULL
           GROUP BY country_short, pull_date, pull_type""",
        *BATCH, "fresh",
    ),
    "lookup_coverage": sql(
        """SELECT count(*) AS n_users_asked, count(s_suppkey) AS n_users_got,
                  count(*) - count(s_suppkey) AS n_users_missed
           FROM (SELECT user_id FROM snowball UNION SELECT user_id FROM seeds) a
                LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = a.user_id""",
        *SNOWBALL, "seeds",
    ),
    "filter_funnel": FUNNEL,
    "observed_funnel": FUNNEL,
    "pull_manifest": sql(
        """SELECT country_short, pull_date, pull_type, count(*) AS n_files,
                  CAST(sum(users) AS BIGINT) AS n_users, CAST(sum(views) AS BIGINT) AS n_requests,
                  CAST(sum(posts) AS BIGINT) AS n_tweets
           FROM (SELECT chr(65 + n_regionkey // 26) || chr(65 + n_regionkey % 26) AS country_short, strftime(ts, '%d%m%Y') AS pull_date,
                        CASE WHEN c_mktsegment = 'BUILDING' THEN 'full' ELSE 'update' END AS pull_type,
                        c_mktsegment, count(DISTINCT u.user_id) AS users, count(*) AS posts,
                        count(*) FILTER (event_type = 'view') AS views
                 FROM events e JOIN users u ON u.c_custkey = e.user_id
                 GROUP BY ALL)
           GROUP BY country_short, pull_date, pull_type""",
        "users",
    ),
    "landing_round_trip": sql("SELECT * EXCLUDE (event_id) FROM flat_posts", *FLAT),
    "landing_files": sql(
        """SELECT country_short, pull_date, pull_type, count(*) AS n_records, count(*) AS n_in_place
           FROM laid_out GROUP BY ALL""",
        *FLAT, "laid_out",
    ),
    "landing_arrays": sql(
        """SELECT * EXCLUDE (kind, block) REPLACE (CASE WHEN kind = 'sound' THEN user_friends_count END AS user_friends_count)
           FROM arrays WHERE kind IN ('sound', 'mistyped')""",
        *ARRAYS,
    ),
    "landing_quarantine": sql(
        """SELECT kind, '{"followers_count":' || user_followers_count || ',"name":"' || user_name || '"}' AS bad_text
           FROM arrays WHERE kind = 'nameless'
           UNION ALL
           SELECT 'broken', '[' || string_agg(record, ',' ORDER BY record) || chr(10) FROM (
               SELECT user_followers_count AS nation, block, '{'
                   || CASE WHEN tweet_id IS NULL THEN '' ELSE '"status":{"id_str":"' || tweet_id || '","created_at":"'
                        || strftime(make_timestamp(tweet_timestamp * 1000000), '%a %b %d %H:%M:%S +0000 %Y') || '"},' END
                   || '"created_at":"' || strftime(make_timestamp(user_timestamp * 1000000), '%a %b %d %H:%M:%S +0000 %Y')
                   || '","default_profile_image":' || user_default_profile_image
                   || ',"description":"' || user_description || '","favourites_count":' || user_favourites_count
                   || ',"followers_count":' || user_followers_count || ',"friends_count":' || user_friends_count
                   || ',"geo_enabled":' || user_geo_enabled || ',"id_str":"' || user_id || '","location":"'
                   || user_location || '","name":"' || user_name || '","notifications":' || user_notifications
                   || ',"profile_image_url_https":"' || user_profile_image_url_https || '","protected":' || user_protected
                   || ',"screen_name":"' || user_screen_name || '","statuses_count":' || user_statuses_count
                   || CASE WHEN user_url IS NULL THEN '' ELSE ',"url":"' || user_url || '"' END
                   || ',"verified":' || user_verified || '}' AS record
               FROM arrays WHERE kind = 'broken')
           GROUP BY nation, block""",
        *ARRAYS,
    ),
    "landing_audit": sql(
        """SELECT kind, count(DISTINCT (user_followers_count, block)) AS n_files,
                  CAST(count(*) FILTER (kind IN ('sound', 'mistyped')) AS BIGINT) AS n_records,
                  CASE kind WHEN 'nameless' THEN count(*) WHEN 'broken' THEN count(DISTINCT (user_followers_count, block))
                            ELSE 0 END AS n_bad
           FROM arrays GROUP BY kind""",
        *ARRAYS,
    ),
    "landing_schema": """
        SELECT * FROM (VALUES ('created_at', 'string'), ('default_profile_image', 'boolean'), ('description', 'string'),
            ('favourites_count', 'bigint'), ('followers_count', 'bigint'), ('friends_count', 'bigint'),
            ('geo_enabled', 'boolean'), ('id_str', 'string'), ('location', 'string'), ('name', 'string'),
            ('notifications', 'boolean'), ('profile_image_url_https', 'string'), ('protected', 'boolean'),
            ('screen_name', 'string'), ('status', 'struct<created_at:string,id_str:string>'),
            ('statuses_count', 'bigint'), ('url', 'string'), ('verified', 'boolean')) AS t(name, type)
        WHERE EXISTS (FROM customer)""",
    "landing_drift": sql(
        """SELECT path, type_found, type_expected, CAST(count(f) AS BIGINT) AS n_records,
                  type_found <> type_expected AS is_drift
           FROM (SELECT e.path, e.type AS type_expected, f,
                        CASE WHEN e.path = '$.friends_count' AND kind = 'mistyped' THEN 'STRING' ELSE e.type END AS type_found
                 FROM (VALUES ('$', 'OBJECT'), ('$.created_at', 'STRING'), ('$.default_profile_image', 'BOOLEAN'),
                     ('$.description', 'STRING'), ('$.favourites_count', 'BIGINT'), ('$.followers_count', 'BIGINT'),
                     ('$.friends_count', 'BIGINT'), ('$.geo_enabled', 'BOOLEAN'), ('$.id_str', 'STRING'),
                     ('$.location', 'STRING'), ('$.name', 'STRING'), ('$.notifications', 'BOOLEAN'),
                     ('$.profile_image_url_https', 'STRING'), ('$.protected', 'BOOLEAN'), ('$.screen_name', 'STRING'),
                     ('$.status', 'OBJECT'), ('$.status.created_at', 'STRING'), ('$.status.id_str', 'STRING'),
                     ('$.statuses_count', 'BIGINT'), ('$.url', 'STRING'), ('$.verified', 'BOOLEAN')) AS e(path, type)
                      JOIN (SELECT *, 1 AS f FROM arrays WHERE kind <> 'broken') a
                        ON (kind <> 'nameless' OR e.path IN ('$', '$.name', '$.followers_count'))
                           AND (e.path NOT LIKE '$.status%' OR e.path = '$.statuses_count' OR tweet_id IS NOT NULL)
                           AND (e.path <> '$.url' OR user_url IS NOT NULL))
           GROUP BY path, type_found, type_expected""",
        *ARRAYS,
    ),
    "table_round_trip": """
        SELECT count(*) AS n_rows, CAST(sum(l_orderkey * l_linenumber) AS BIGINT) AS sum_keys,
               CAST(0 AS BIGINT) AS n_short, CAST(0 AS BIGINT) AS n_long FROM lineitem""",
    "friend_files": sql("SELECT user_id, friend_id FROM friend_lists", "posts", "friend_lists"),
    "hash_shard_users": sql(
        """SELECT *, CAST(CAST('0x' || substr(md5(user_id || '0'), 1, 15) AS BIGINT) % 7 AS INTEGER) AS shard
           FROM country_users""",
        "users", "country_users",
    ),
    "partitioned_round_trip": sql(
        "SELECT country_short, count(*) AS n_users FROM country_users GROUP BY country_short", "users", "country_users"
    ),
    "ids_round_trip": sql("SELECT user_id FROM seeds", "seeds"),
}

# The same results by another way.
ORACLE_SQL |= {
    "kept_newest": ORACLE_SQL["latest_per_user"],
    "kept_candidates": ORACLE_SQL["snowball"],
    "kept_newer": ORACLE_SQL["newer_than_mark"],
}
