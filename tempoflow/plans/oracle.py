"""Oracle SQL: the same questions in plain SQL over the same tables, written independently of the Spark plans."""

from __future__ import annotations

from tempoflow.plans.views import REQUESTS


def over(view: str, *ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([view.strip(), *[c.strip() for c in ctes]]) + "\n" + select.strip()


# Fixed values of the portable hash family: the prime 2^31 - 1 and the powers of 48271.
_POWERS = "[" + ", ".join(str(pow(48271, i + 1, 2147483647)) for i in range(128)) + "]"


def base(item: str) -> str:
    return f"(('0x' || substr(md5({item}), 1, 8))::BIGINT % 2147483646 + 1)"


def word(item: str, index: str = "i") -> str:
    """Word of the portable hash family."""
    return f"({base(item)} * {_POWERS}[({index} + 1)::INTEGER] % 2147483647)"


TRAILING = "(CASE WHEN w = 0 THEN 32 ELSE bit_count((w & -w) - 1) END)::INTEGER"
TIME = "strftime(timestamp, '%Y-%m-%d %H:%M:%S')"

ARTIST_STATS = """
SELECT artist, round(avg(popularity), 6) AS avg_popularity, round(avg(danceability), 6) AS avg_danceability,
       round(avg(energy), 6) AS avg_energy, count(*) AS track_count
FROM tracks GROUP BY artist"""

ARTIST_STATS_TOP = """
SELECT artist, round(avg(popularity), 2) AS avg_popularity, round(avg(danceability), 2) AS avg_danceability,
       round(avg(energy), 2) AS avg_energy, count(*) AS track_count
FROM tracks GROUP BY artist ORDER BY track_count DESC, artist LIMIT 5"""

GLOBAL_STATS = """
SELECT round(avg(popularity), 6) AS avg_popularity, round(avg(danceability), 6) AS avg_danceability,
       round(avg(energy), 6) AS avg_energy FROM tracks"""

TRENDING = """
SELECT name, artist, popularity, seq FROM tracks ORDER BY popularity DESC NULLS LAST, name, seq LIMIT 5"""

TOP_ARTISTS = "SELECT artist, count(*) AS track_count FROM tracks GROUP BY artist ORDER BY track_count DESC, artist LIMIT 5"

FEATURE_CORR = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS correlation FROM tracks"
    for i, a in enumerate(("popularity", "danceability", "energy", "tempo"))
    for b in ("popularity", "danceability", "energy", "tempo")[i + 1 :]
)

DISTRIBUTION = """
SELECT artist, count(*) AS track_count, round(count(*)::DOUBLE / sum(count(*)) OVER (), 9) AS share
FROM tracks GROUP BY artist"""

TRACK_HISTORY = """
SELECT name, count(*) AS history_entries, strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS last_seen
FROM tracks GROUP BY name"""

DEDUP = f"SELECT DISTINCT name, artist, {TIME} AS timestamp FROM tracks"

TRACK_ROWS = f"""
SELECT seq, name, artist, popularity::DOUBLE AS popularity, danceability, energy, tempo, {TIME} AS timestamp FROM tracks"""

FLATTEN = """
SELECT t.name, t.artist, t.popularity, (p.p_partkey * 7 % 101)::DOUBLE / 100 AS danceability,
       p.p_size::DOUBLE / 50 AS energy, p.p_retailprice / 10 AS tempo
FROM (SELECT l_partkey AS id, 'part_' || l_partkey AS name, 'supplier_' || l_suppkey AS artist,
             l_quantity::INTEGER AS popularity
      FROM lineitem WHERE l_returnflag <> 'R'
      UNION ALL
      SELECT l_suppkey, 'part_' || l_suppkey, 'supplier_' || l_suppkey, l_quantity::INTEGER FROM lineitem) t
JOIN part p ON p.p_partkey = t.id"""

# The watermark: the earlier of the newest rows on both sides, less the delay. Items that still wait for features are not out.
STREAM_FLATTEN = """
WITH items AS (
  SELECT l_partkey AS id, 'part_' || l_partkey AS name, 'supplier_' || l_suppkey AS artist, l_quantity::INTEGER AS popularity,
         l_shipdate AS since
  FROM lineitem WHERE l_returnflag <> 'R'
  UNION ALL
  SELECT l_suppkey, 'part_' || l_suppkey, 'supplier_' || l_suppkey, l_quantity::INTEGER, l_shipdate FROM lineitem),
features AS (
  SELECT l_partkey AS id, l_shipdate + to_hours((CASE WHEN l_partkey % 11 = 0 THEN 10 ELSE l_partkey % 7 END)::INTEGER) AS since,
         (l_partkey * 7 % 101)::DOUBLE / 100 AS danceability, l_quantity / 50 AS energy, (60 + l_partkey % 140)::DOUBLE AS tempo
  FROM lineitem WHERE l_linenumber <> 5),
mark AS (SELECT least((SELECT max(since) FROM items), (SELECT max(since) FROM features)) - INTERVAL 1470 MINUTES AS w)
SELECT strftime(i.since, '%Y-%m-%d %H:%M:%S') AS timestamp, name, artist, popularity, round(danceability, 9) AS danceability,
       round(energy, 9) AS energy, round(tempo, 9) AS tempo
FROM items i LEFT JOIN features f ON f.id = i.id AND f.since BETWEEN i.since AND i.since + INTERVAL 6 HOURS
WHERE f.id IS NOT NULL OR i.since + INTERVAL 6 HOURS < (SELECT w FROM mark)"""

# ---- sketches ----------------------------------------------------------------------------------------------------

FM_ZEROS = f"""
hashed AS (SELECT name, artist, i, {word('name')} AS w FROM tracks, range(32) r(i) WHERE name IS NOT NULL),
zeros AS (SELECT name, artist, i, w, {TRAILING} AS z FROM hashed)"""

FM_ESTIMATE = """
SELECT round(avg(r), 6) AS mean_zeros, round(pow(2, avg(r)), 6) AS estimate
FROM (SELECT i, max(z)::DOUBLE AS r FROM zeros GROUP BY i)"""

FM_REGISTERS = "SELECT i::INTEGER AS estimator, max(z) AS max_zeros FROM zeros GROUP BY i"

FM_BY_GROUP = """
SELECT artist, round(avg(r), 6) AS mean_zeros, round(pow(2, avg(r)), 6) AS estimate
FROM (SELECT artist, i, max(z)::DOUBLE AS r FROM zeros GROUP BY artist, i) GROUP BY artist"""

FM_ERROR = """
SELECT exact_count, round(estimate, 6) AS estimate, round(abs(estimate - exact_count) / exact_count * 100, 6) AS error_percent
FROM (SELECT (SELECT count(DISTINCT name) FROM tracks) AS exact_count, pow(2, avg(r)) AS estimate
      FROM (SELECT i, max(z)::DOUBLE AS r FROM zeros GROUP BY i))"""

FM_EXPLAIN = """
SELECT DISTINCT name AS item, i::INTEGER AS estimator, w AS hash_value, z AS trailing_zeros FROM zeros"""

FM_MERGE = f"""
WITH sources AS (
  SELECT 'events' AS source, 'track_' || user_id AS name FROM events
  UNION ALL SELECT 'orders', 'track_' || o_custkey FROM orders),
labelled AS (SELECT source, name FROM sources UNION ALL SELECT 'all', name FROM sources),
hashed AS (SELECT source, i, {word('name')} AS w FROM labelled, range(32) r(i)),
regs AS (SELECT source, i, max({TRAILING})::DOUBLE AS r FROM hashed GROUP BY source, i)
SELECT source, round(avg(r), 6) AS mean_zeros, round(pow(2, avg(r)), 6) AS estimate FROM regs GROUP BY source"""


def bloom(where: str = "popularity > 80", bits: int = 1000, hashes: int = 3) -> str:
    return f"""
members AS (SELECT DISTINCT name FROM tracks WHERE {where} AND name IS NOT NULL),
bits AS (SELECT DISTINCT {word('name')} % {bits} AS p FROM members, range({hashes}) r(i)),
universe AS (SELECT DISTINCT name FROM tracks WHERE name IS NOT NULL),
hits AS (
  SELECT name FROM universe, range({hashes}) r(i)
  WHERE {word('name')} % {bits} IN (SELECT p FROM bits)
  GROUP BY name HAVING count(*) = {hashes})"""


BLOOM_WORDS = "SELECT p // 32 AS word_no, bit_or(1::BIGINT << (p % 32)) AS word FROM bits GROUP BY p // 32"
BLOOM_BITS = "SELECT p AS position FROM bits"
BLOOM_PROBE = "SELECT seq, name FROM tracks WHERE name IN (SELECT name FROM hits)"
BLOOM_FPR = """
SELECT (SELECT count(*) FROM bits) AS bits_set, (SELECT count(*) FROM bits)::DOUBLE / 1000 AS fill_ratio,
       (SELECT count(*) FROM universe WHERE name NOT IN (SELECT name FROM members)) AS non_members,
       (SELECT count(*) FROM hits WHERE name NOT IN (SELECT name FROM members)) AS false_positives"""

RESERVOIR = """
SELECT seq, name, artist, popularity::DOUBLE AS popularity FROM tracks ORDER BY md5('0:' || seq), seq LIMIT 10"""

# ---- last N ------------------------------------------------------------------------------------------------------

BITS = """
bits AS (
  SELECT seq, artist, name,
         CASE WHEN popularity >= 80 THEN 1 ELSE 0 END AS popularity,
         CASE WHEN energy >= 0.8 THEN 1 ELSE 0 END AS energy,
         CASE WHEN danceability >= 0.8 THEN 1 ELSE 0 END AS danceability
  FROM tracks)"""

THRESHOLD_BITS = """
SELECT seq, name || ' by ' || artist AS track, popularity, energy, danceability FROM bits"""

WINDOW_ONES = """
SELECT artist, seq, row_number() OVER w AS arrival,
       (sum(popularity) OVER w)::BIGINT AS total_popularity, (sum(energy) OVER w)::BIGINT AS total_energy,
       (sum(danceability) OVER w)::BIGINT AS total_danceability,
       (sum(popularity) OVER f)::BIGINT AS recent_popularity, (sum(energy) OVER f)::BIGINT AS recent_energy,
       (sum(danceability) OVER f)::BIGINT AS recent_danceability
FROM bits
WINDOW w AS (PARTITION BY artist ORDER BY seq ROWS UNBOUNDED PRECEDING),
       f AS (PARTITION BY artist ORDER BY seq ROWS 99 PRECEDING)"""


def dgim(key: str) -> str:
    """Bucket tables built from every single one of the input."""
    return f"""
long AS (
  SELECT {key} AS k, seq, 'popularity' AS signal, popularity AS b FROM bits
  UNION ALL SELECT {key}, seq, 'energy', energy FROM bits
  UNION ALL SELECT {key}, seq, 'danceability', danceability FROM bits),
arrived AS (
  SELECT *, row_number() OVER (PARTITION BY k, signal ORDER BY seq) AS pos, count(*) OVER (PARTITION BY k, signal) AS t
  FROM long),
ones AS (
  SELECT *, row_number() OVER (PARTITION BY k, signal ORDER BY seq DESC) AS q, count(*) OVER (PARTITION BY k, signal) AS n
  FROM arrived WHERE b = 1),
leveled AS (
  SELECT k, signal, pos, t, q, n, min(j) AS level
  FROM ones, range(40) r(j)
  WHERE q <= (2::BIGINT << j) - 1 + ((n + 1) % (2::BIGINT << j))
  GROUP BY k, signal, pos, t, q, n),
placed AS (
  SELECT k, signal, t, level, 1::BIGINT << level AS size, pos,
         (q - 1 - CASE WHEN level = 0 THEN 0 ELSE (1::BIGINT << level) - 1 + ((n + 1) % (1::BIGINT << level)) END)
           // (1::BIGINT << level) AS slot
  FROM leveled),
buckets AS (
  SELECT k, signal, level, slot, size, max(pos) AS newest, max(t) AS t
  FROM placed GROUP BY k, signal, level, slot, size HAVING max(pos) > max(t) - 100),
estimates AS (
  SELECT k, signal, sum(size)::DOUBLE - arg_min(size, newest) / 2.0::DOUBLE AS estimate, count(*) AS bucket_count
  FROM buckets GROUP BY k, signal),
actuals AS (
  SELECT k, signal, max(t) AS t, sum(b) FILTER (pos > t - 100) AS actual FROM arrived GROUP BY k, signal)"""


DGIM_STATS = """
SELECT {key}a.signal, coalesce(e.estimate, 0)::DOUBLE AS estimated_count, a.actual::BIGINT AS actual_count,
       100::INTEGER AS window_size, a.t AS current_position, coalesce(e.bucket_count, 0)::BIGINT AS bucket_count
FROM actuals a LEFT JOIN estimates e ON e.k = a.k AND e.signal = a.signal"""

DGIM_BUCKETS = """
SELECT k AS artist, size AS bucket_size, (t - newest + 1)::INTEGER AS newest_age FROM buckets WHERE signal = 'energy'"""

DGIM_TIMELINE = """
running AS (
  SELECT artist, seq, row_number() OVER w AS arrival, (sum(energy) OVER w)::BIGINT AS n, (sum(energy) OVER f)::BIGINT AS c
  FROM bits
  WINDOW w AS (PARTITION BY artist ORDER BY seq ROWS UNBOUNDED PRECEDING),
         f AS (PARTITION BY artist ORDER BY seq ROWS 99 PRECEDING)),
leveled AS (
  SELECT artist, seq, arrival, n, c, min(j) AS level FROM running, range(8) r(j)
  WHERE c <= (2::BIGINT << j) - 1 + ((n + 1) % (2::BIGINT << j)) GROUP BY ALL),
placed AS (
  SELECT *, 1::BIGINT << level AS size,
         CASE WHEN level = 0 THEN 0 ELSE (1::BIGINT << level) - 1 + ((n + 1) % (1::BIGINT << level)) END AS base
  FROM leveled)"""

DGIM_TIMELINE_SELECT = """
SELECT artist, seq, arrival,
       CASE WHEN c = 0 THEN 0 ELSE (base + ((c - 1 - base) // size + 1) * size)::DOUBLE - size / 2.0::DOUBLE END::DOUBLE
         AS estimated_energy,
       c AS actual_energy
FROM placed"""

# ---- privacy -----------------------------------------------------------------------------------------------------


def _laplace(label: str, seed: int, scale: str) -> str:
    u = f"((({base(f"'{seed}:' || {label}")} * 48271 % 2147483647) % 2147483646 + 1) / 2147483647::DOUBLE - 0.5::DOUBLE)"
    return f"(-{scale} * sign({u}) * ln(1 - 2 * abs({u})))"


DP_STATS = "\nUNION ALL\n".join(
    f"SELECT '{m}' AS metric, round(coalesce(avg({m}), 0) + {_laplace(repr(m), 7, '2.0::DOUBLE')}, 6) AS private_average FROM tracks"
    for m in ("popularity", "danceability", "energy")
)

DP_ARTIST_STATS = f"""
sums AS (
  SELECT artist, count(*) AS n, sum(least(greatest(popularity, 0), 100))::DOUBLE AS popularity,
         sum(least(greatest(danceability, 0), 1)) AS danceability, sum(least(greatest(energy, 0), 1)) AS energy
  FROM tracks GROUP BY artist),
noisy AS (
  SELECT artist, greatest(n + {_laplace("artist || ':count'", 7, '8.0::DOUBLE')}, 1.0::DOUBLE) AS n,
         popularity + {_laplace("artist || ':popularity'", 7, '800.0::DOUBLE')} AS popularity,
         danceability + {_laplace("artist || ':danceability'", 7, '8.0::DOUBLE')} AS danceability,
         energy + {_laplace("artist || ':energy'", 7, '8.0::DOUBLE')} AS energy
  FROM sums)"""

DP_ARTIST_SELECT = """
SELECT artist, round(n, 6) AS private_count,
       round(least(greatest(popularity / n, 0), 100), 6) AS private_avg_popularity,
       round(least(greatest(danceability / n, 0), 1), 6) AS private_avg_danceability,
       round(least(greatest(energy / n, 0), 1), 6) AS private_avg_energy
FROM noisy"""


def _range(column: str) -> str:
    return (
        f"CASE WHEN min({column}) OVER c IS NULL THEN 'N/A' "
        f"ELSE printf('%.2f-%.2f', (min({column}) OVER c)::DOUBLE, (max({column}) OVER c)::DOUBLE) END AS {column}"
    )


def k_anonymity(k: int) -> str:
    return f"""
ranked AS (SELECT *, (row_number() OVER (ORDER BY coalesce(popularity, -1), seq) - 1) // {k} AS chunk FROM tracks),
anonymous AS (
  SELECT {_range('popularity')}, {_range('danceability')}, {_range('energy')}
  FROM ranked WINDOW c AS (PARTITION BY chunk) QUALIFY count(*) OVER c >= {k})"""


K_ANONYMITY = k_anonymity(2)

K_ANONYMITY_CHECK = """
SELECT count(*) AS classes, min(size) AS smallest_class, sum(size)::BIGINT AS rows_kept
FROM (SELECT count(*) AS size FROM anonymous GROUP BY popularity, danceability, energy)"""

RELEASE_CHECK = "SELECT true AS large_enough, true AS few_held, count(*) AS rows_seen FROM tracks"

# 40 steps have 6 levels; with four metrics a node gets a 24th of epsilon 0.5.
_NODE = "metric || ':' || level || ':' || before"
DP_RUNNING = f"""
SELECT step, metric, round(any_value(total) + sum({_laplace(_NODE, 7, '(48 * bound)::DOUBLE')}), 5) AS private_total
FROM (
  SELECT step, metric, total, bound, level, (step >> (level + 1)) << (level + 1) AS before
  FROM (
    SELECT step, metric, bound,
           coalesce((SELECT sum(CASE metric WHEN 'count' THEN 1 WHEN 'popularity' THEN least(greatest(popularity, 0), 100)
                                            WHEN 'danceability' THEN least(greatest(danceability, 0), 1)
                                            ELSE least(greatest(energy, 0), 1) END)::DOUBLE
                     FROM tracks WHERE date_diff('day', DATE '2023-12-31', timestamp::DATE) BETWEEN 1 AND step), 0) AS total
    FROM range(1, 41) s(step),
         (VALUES ('count', 1), ('popularity', 100), ('danceability', 1), ('energy', 1)) m(metric, bound)),
    range(6) l(level)
  WHERE (step >> level) % 2 = 1)
GROUP BY step, metric"""

# ---- similarity --------------------------------------------------------------------------------------------------


def levels(identity: str | None = "seq") -> str:
    item = f"{identity} AS item, " if identity else ""
    return f"""
lv AS (
  SELECT {item}round_even(coalesce(danceability, 0) * 100, 0)::BIGINT AS l0,
         round_even(coalesce(energy, 0) * 100, 0)::BIGINT AS l1,
         round_even(coalesce(tempo, 0) / 200 * 100, 0)::BIGINT AS l2
  FROM tracks),
tri AS (SELECT l0, l1, l2, count(*) AS items FROM lv GROUP BY l0, l1, l2)"""


FEATURE_VECTOR = """
SELECT seq, round(coalesce(danceability, 0), 9) AS f0, round(coalesce(energy, 0), 9) AS f1,
       round(coalesce(tempo, 0) / 200, 9) AS f2 FROM tracks"""
DISCRETISE = "SELECT item AS seq, l0 AS level_0, l1 AS level_1, l2 AS level_2 FROM lv"
TOKENS = "SELECT item AS seq, '0:' || l0 AS token_0, '1:' || l1 AS token_1, '2:' || l2 AS token_2 FROM lv"

JACCARD_GROUPS = "\nUNION ALL\n".join(
    f"""SELECT '{a}{b}|' || l{a} || '|' || l{b} AS shared_key, count(*) AS triples, sum(items)::BIGINT AS items,
       (sum(items)::HUGEINT * sum(items)::HUGEINT - sum(items::HUGEINT * items::HUGEINT))::DOUBLE / 2 AS half_pairs
FROM tri GROUP BY l{a}, l{b}"""
    for a, b in ((0, 1), (0, 2), (1, 2))
)

SHARED = "((a.l0 = b.l0)::INTEGER + (a.l1 = b.l1)::INTEGER + (a.l2 = b.l2)::INTEGER)"

PAIRS = f"""
pairs AS (
  SELECT DISTINCT a.item AS item, b.item AS other, {SHARED} AS s
  FROM lv a JOIN lv b ON a.l0 = b.l0 AND a.l1 = b.l1 AND a.item <> b.item
  UNION SELECT a.item, b.item, {SHARED} FROM lv a JOIN lv b ON a.l0 = b.l0 AND a.l2 = b.l2 AND a.item <> b.item
  UNION SELECT a.item, b.item, {SHARED} FROM lv a JOIN lv b ON a.l1 = b.l1 AND a.l2 = b.l2 AND a.item <> b.item)"""

PAIR_TOTALS = """
SELECT count(*) FILTER (s = 3)::DOUBLE AS identical_pairs, count(*) FILTER (s = 2)::DOUBLE AS half_pairs,
       count(*)::DOUBLE AS pairs FROM pairs WHERE item < other"""

SIMILAR_COUNTS = """
SELECT lv.item, count(p.other) FILTER (s = 3) AS identical, count(p.other) FILTER (s = 2) AS half_shared
FROM lv LEFT JOIN pairs p ON p.item = lv.item GROUP BY lv.item"""

def signatures(permutations: int) -> str:
    return f"""
tok AS (
  SELECT DISTINCT '0:' || l0 AS token FROM tri UNION SELECT DISTINCT '1:' || l1 FROM tri
  UNION SELECT DISTINCT '2:' || l2 FROM tri),
hashed AS (SELECT token, i, {word('token')} AS h FROM tok, range({permutations}) r(i)),
sig AS (
  SELECT l0, l1, l2, a.i, least(a.h, b.h, c.h) AS m FROM tri
  JOIN hashed a ON a.token = '0:' || l0
  JOIN hashed b ON b.token = '1:' || l1 AND b.i = a.i
  JOIN hashed c ON c.token = '2:' || l2 AND c.i = a.i)"""


MINHASH = """
SELECT l0 AS level_0, l1 AS level_1, l2 AS level_2, md5(string_agg(m::VARCHAR, '-' ORDER BY i)) AS signature
FROM sig GROUP BY l0, l1, l2"""


def banded(bands: int = 25, rows: int = 5) -> str:
    return signatures(bands * rows) + f""",
buckets AS (
  SELECT l0, l1, l2, (i // {rows})::INTEGER AS band,
         (i // {rows})::VARCHAR || '|' || string_agg(m::VARCHAR, '-' ORDER BY i) AS bucket
  FROM sig GROUP BY l0, l1, l2, i // {rows})"""


LSH_INDEX = """
SELECT l0 AS level_0, l1 AS level_1, l2 AS level_2, items, band, md5(bucket) AS bucket FROM buckets JOIN tri USING (l0, l1, l2)"""
LSH_CANDIDATES = LSH_INDEX + " QUALIFY sum(items) OVER (PARTITION BY bucket) > 1"

SONGS = "songs AS (SELECT * FROM tracks QUALIFY row_number() OVER (PARTITION BY name, artist ORDER BY seq DESC) = 1)"


def song_levels() -> str:
    return levels("name || '-' || artist").replace("FROM tracks)", "FROM songs)")


SONG_LEVELS = "SELECT item AS song_id, l0 AS level_0, l1 AS level_1, l2 AS level_2 FROM lv"
KEYED = "l0 AS level_0, l1 AS level_1, l2 AS level_2, items"
JACCARD_KEYS = "\nUNION ALL\n".join(
    f"SELECT '{a}{b}|' || l{a} || '|' || l{b} AS key, {KEYED} FROM tri" for a, b in ((0, 1), (0, 2), (1, 2))
)

# Per triple and position the three words, to see where the third token wins no minimum of a band of five.
SILENT = """
words AS (
  SELECT l0, l1, l2, items, a.i // 5 AS band, a.h AS h0, b.h AS h1, c.h AS h2 FROM tri
  JOIN hashed a ON a.token = '0:' || l0
  JOIN hashed b ON b.token = '1:' || l1 AND b.i = a.i
  JOIN hashed c ON c.token = '2:' || l2 AND c.i = a.i)"""
VERIFIED_KEYS = f"SELECT 'all|' || l0 || '|' || l1 || '|' || l2 AS key, {KEYED} FROM tri" + "".join(
    f"""
UNION ALL SELECT band || '|{a}{b}|' || l{a} || '|' || l{b} AS key, {KEYED} FROM words
GROUP BY band, l0, l1, l2, items HAVING bool_and(least(h{a}, h{b}) <= h{3 - a - b})"""
    for a, b in ((0, 1), (0, 2), (1, 2))
)

_USABLE = "danceability IS NOT NULL AND energy IS NOT NULL AND tempo IS NOT NULL"
KMEANS_CHECK = f"SELECT count(*) AS rows, 0::BIGINT AS misplaced, 3::BIGINT AS clusters FROM tracks WHERE {_USABLE}"
CLUSTER_CHECK = f"""
SELECT count(*) AS profile_rows, count(*) AS member_rows, count(DISTINCT name) AS names FROM tracks WHERE {_USABLE}"""
COUNT_CHECK = "SELECT count(DISTINCT name) AS exact_count, true AS within_bound FROM tracks"
HLL_CHECK = "SELECT artist, count(DISTINCT name) AS exact_count, true AS within_bound FROM tracks GROUP BY artist"
REJECTS = """
SELECT substr(props, 1, length(props) - 1) AS value, count(*) AS messages FROM events WHERE event_id % 3 = 0 GROUP BY 1
UNION ALL SELECT 'decoded', count(*) FROM events WHERE event_id % 3 <> 0"""

STREAM_REJECTS = """
WITH messages AS (
  SELECT event_id, event_id % 7 AS odd, event_id % 3 = 0 AS cut, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k FROM events),
judged AS (
  SELECT *, CASE WHEN odd = 1 THEN 'wrong type' WHEN odd = 2 THEN 'empty' WHEN odd = 3 THEN 'missing' WHEN cut THEN 'malformed'
                 ELSE 'decoded' END AS reason FROM messages)
SELECT reason, count(*) AS messages, sum(event_id)::BIGINT AS offsets, coalesce(sum(k) FILTER (reason = 'decoded'), 0)::BIGINT AS k
FROM judged GROUP BY reason"""

CANDIDATES = f"""
met AS (
  SELECT DISTINCT a.l0, a.l1, a.l2, b.l0 AS m0, b.l1 AS m1, b.l2 AS m2
  FROM buckets a JOIN buckets b ON a.bucket = b.bucket),
pairs AS (
  SELECT a.item, b.item AS other, {SHARED} AS s
  FROM met JOIN lv a ON a.l0 = met.l0 AND a.l1 = met.l1 AND a.l2 = met.l2
  JOIN lv b ON b.l0 = m0 AND b.l1 = m1 AND b.l2 = m2
  WHERE a.item <> b.item)"""

SIMILAR_TO = """
SELECT item AS probe, other AS similar_item, s::DOUBLE / (6 - s) AS jaccard
FROM pairs WHERE s >= 2 AND item IN (SELECT item FROM lv ORDER BY item LIMIT 2)"""

LATEST = f"""
SELECT name || '-' || artist AS song_id, seq, popularity::DOUBLE AS popularity, {TIME} AS timestamp
FROM tracks QUALIFY row_number() OVER (PARTITION BY name, artist ORDER BY seq DESC) = 1"""

# ---- unlearning --------------------------------------------------------------------------------------------------

GONE = f"""
{REQUESTS.strip()},
gone_tracks AS (SELECT item, min(timestamp) AS since FROM accepted WHERE type = 'track' GROUP BY item),
gone_artists AS (SELECT item, min(timestamp) AS since FROM accepted WHERE type = 'artist' GROUP BY item),
kept AS (
  SELECT * FROM tracks
  WHERE name NOT IN (SELECT item FROM gone_tracks) AND artist NOT IN (SELECT item FROM gone_artists)),
streamed AS (
  SELECT t.* FROM tracks t LEFT JOIN gone_tracks g ON g.item = t.name LEFT JOIN gone_artists h ON h.item = t.artist
  WHERE NOT coalesce(t.timestamp >= g.since, false) AND NOT coalesce(t.timestamp >= h.since, false))"""

FORGET_FILTER = "SELECT seq, name, artist FROM kept"
UNLEARNED = f"""
SELECT seq, name, artist, NULL::DOUBLE AS popularity, danceability, energy, NULL::DOUBLE AS tempo, {TIME} AS timestamp"""
UNLEARN_APPLY = UNLEARNED + " FROM kept"
_MASKED_FROM = "(SELECT min(timestamp) FROM accepted WHERE type = 'feature' AND item = '{}')"
UNLEARN_SINCE = "SELECT seq, name, artist, danceability, energy, " + TIME + " AS timestamp, " + ", ".join(
    f"CASE WHEN timestamp >= {_MASKED_FROM.format(c)} THEN NULL ELSE {c}::DOUBLE END AS {c}" for c in ("popularity", "tempo")
) + " FROM streamed"
ACTIVE_TRACKS = UNLEARNED + " FROM kept ORDER BY seq DESC LIMIT 100"
MASKED = f"""
SELECT seq, name, artist, popularity::DOUBLE AS popularity, NULL::DOUBLE AS danceability, energy, NULL::DOUBLE AS tempo, {TIME} AS timestamp
FROM tracks"""

AUDIT = """
SELECT type, count(*) AS entries, count(DISTINCT item) AS items,
       strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') AS first_request,
       strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS last_request
FROM accepted GROUP BY type"""

STATUS = """
SELECT (SELECT count(*) FROM gone_tracks) AS forgotten_tracks, (SELECT count(*) FROM gone_artists) AS forgotten_artists,
       (SELECT string_agg(DISTINCT item, ',' ORDER BY item) FROM accepted WHERE type = 'feature') AS masked_features,
       (SELECT count(*) FROM accepted) AS audit_entries, (SELECT count(*) FROM kept) AS processed_tracks,
       least((SELECT count(*) FROM kept), 100) AS active_tracks"""

VERIFY_ALL = """
SELECT least((SELECT count(*) FROM kept), 100) AS active_tracks, (SELECT count(*) FROM gone_tracks) AS forgotten_tracks,
       (SELECT count(*) FROM gone_artists) AS forgotten_artists,
       (SELECT count(DISTINCT item) FROM accepted WHERE type = 'feature')::INTEGER AS masked_features"""

VERIFY = """
SELECT t.name, t.name IN (SELECT item FROM gone_tracks) AS track_forgotten,
       bool_or(t.artist IN (SELECT item FROM gone_artists)) AS artist_forgotten,
       coalesce(max(h.n), 0) AS history_entries, strftime(max(h.last_seen), '%Y-%m-%d %H:%M:%S') AS last_seen
FROM tracks t LEFT JOIN (SELECT name, count(*) AS n, max(timestamp) AS last_seen FROM streamed GROUP BY name) h
  ON h.name = t.name
GROUP BY t.name"""

RESIDUE = """
SELECT (SELECT count(*) FROM streamed) AS stored_rows,
       (SELECT count(*) FROM streamed WHERE name IN (SELECT item FROM gone_tracks)
                                         OR artist IN (SELECT item FROM gone_artists)) AS residue_before,
       0::BIGINT AS residue_after"""

KEPT_HISTORY = TRACK_HISTORY.replace("FROM tracks", "FROM kept")
PURGED = f"""
SELECT seq, name, artist, popularity::DOUBLE AS popularity, danceability, energy, tempo, {TIME} AS timestamp FROM kept"""

# ---- time windows ------------------------------------------------------------------------------------------------

TUMBLING = """
SELECT strftime(date_trunc('day', timestamp), '%Y-%m-%d %H:%M:%S') AS window_start, artist,
       round(avg(popularity), 6) AS avg_popularity, count(*) AS track_count
FROM tracks GROUP BY ALL"""

SLIDING = """
SELECT strftime(date_trunc('day', timestamp) + to_hours((hour(timestamp) // 12) * 12) - to_hours(12 * b),
                '%Y-%m-%d %H:%M:%S') AS window_start,
       artist, round(avg(popularity), 6) AS avg_popularity, count(*) AS track_count
FROM tracks, range(2) r(b) GROUP BY ALL"""

SESSIONS = """
SELECT artist, strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS session_end, round(avg(popularity), 6) AS avg_popularity,
       count(*) AS track_count
FROM (SELECT *, sum(opens) OVER (PARTITION BY artist ORDER BY timestamp, seq ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER (PARTITION BY artist ORDER BY timestamp, seq)
                                <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS opens FROM tracks))
GROUP BY artist, session"""


def closed(query: str, column: str, length: str, delay: str = "1 DAY") -> str:
    """Rows of windows that the watermark has passed when the input ends."""
    return f"""
SELECT * FROM ({query.strip()})
WHERE {column}::TIMESTAMP + INTERVAL {length} <= (SELECT max(timestamp) FROM tracks) - INTERVAL {delay}"""
