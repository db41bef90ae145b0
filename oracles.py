"""The queries as DuckDB SQL over the same tables, for the side-by-side check.

Written apart from the Spark code; only the query parameters and the stop-word
lists are shared.
"""

from __future__ import annotations

from driftline.functions.stopwords import TOPIC_LANGUAGES, stop_words

WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NON_WS = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
TOKEN = r"[\p{L}\p{N}_]{2,}"
WORD = r"[\p{L}\p{N}_]+"
SENTENCE = r"[^.!?]*[\p{L}\p{N}_][^.!?]*"
NAME_LANGUAGES = ("italian", "english", "russian", "german", "spanish", "french")


def _word_list(languages) -> str:
    return "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in stop_words(languages)) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def cell(x: str) -> str:
    return f"(CASE WHEN lower({strip(x)}) NOT IN ('', 'none', 'nan') THEN {strip(x)} END)"


def iso(x: str) -> str:
    frac = f"CASE WHEN date_part('microsecond', {x}) % 1000000 <> 0 THEN strftime({x}, '.%f') ELSE '' END"
    return f"coalesce(strftime({x}, '%Y-%m-%dT%H:%M:%S') || {frac} || '+00:00', '')"


def with_ctes(select: str, *ctes: tuple[str, str], recursive: bool = False) -> str:
    keep = "" if recursive else "MATERIALIZED "
    body = ",\n".join(f"{name} AS {keep}({text})" for name, text in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{select}"


# --- tables ------------------------------------------------------------------

CHANNELS = """
SELECT p_partkey AS channel_id,
  CASE WHEN p_partkey % 7 = 3 THEN '' ELSE 'ch_' || p_partkey END AS username,
  CASE WHEN p_partkey % 11 = 4 THEN NULL WHEN p_partkey % 11 = 5 THEN '  '
       ELSE p_name || ' ' || lower(p_type) END AS title,
  p_partkey % 1000 AS participants_count,
  p_partkey % 2 AS broadcast, (p_partkey % 3 = 0)::BIGINT AS megagroup, (p_partkey % 5 = 0)::BIGINT AS verified,
  (p_partkey % 13 = 0)::BIGINT AS scam, (p_partkey % 17 = 0)::BIGINT AS fake
FROM part"""

POSTS = """
SELECT l_partkey AS channel_id, l_orderkey * 8 + l_linenumber AS message_id, l_shipdate AS date,
  l_returnflag = 'R' AS is_forwarded, l_suppkey AS from_id
FROM lineitem"""

RELATIONS = """
SELECT r.*, t.username AS channel_to_username, t.title AS channel_to_title,
  f.username AS channel_from_username, f.title AS channel_from_title
FROM (SELECT l_partkey AS channel_to_id,
        CASE WHEN (l_orderkey + l_linenumber) % 10 <> 0 THEN l_suppkey END AS channel_from_id,
        CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 AND l_linenumber % 2 = 0
             THEN 'Anon ' || l_returnflag ELSE '' END AS from_name_fallback,
        l_orderkey * 8 + l_linenumber AS target_message_id, l_shipdate AS target_message_date_utc
      FROM lineitem) r
LEFT JOIN channels t ON t.channel_id = r.channel_to_id
LEFT JOIN channels f ON f.channel_id = r.channel_from_id"""

LABELLED = f"""
SELECT *,
  coalesce({cell('channel_from_username')}, {cell('channel_from_title')}, {cell('from_name_fallback')},
           'channel_id:' || channel_from_id) AS source,
  coalesce({cell('channel_to_username')}, {cell('channel_to_title')}, 'channel_id:' || channel_to_id) AS target,
  channel_from_id IS NULL AS unresolved
FROM relations"""


def edges(unresolved: bool = False) -> str:
    keep = "" if unresolved else "NOT unresolved AND "
    return (
        "SELECT source, target, count(*)::BIGINT AS weight FROM labelled "
        f"WHERE {keep}source IS NOT NULL AND target IS NOT NULL GROUP BY source, target"
    )


def graph_ctes(unresolved: bool = False, min_weight: int = 1):
    return (
        ("channels", CHANNELS),
        ("relations", RELATIONS),
        ("labelled", LABELLED),
        ("all_edges", edges(unresolved)),
        ("edges", f"SELECT * FROM all_edges WHERE weight >= {min_weight}"),
    )


MESSAGES = """
SELECT doc_id AS message_id, source AS channel_username,
  CASE WHEN doc_id % 5 <> 3 THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id * 7) END AS date,
  CASE WHEN doc_id % 50 = 7 THEN NULL WHEN doc_id % 50 = 9 THEN '   '
       WHEN doc_id % 6 = 1 THEN text || ' https://t.me/x' || doc_id ELSE text END AS text,
  (doc_id * 37) % 1000 AS views, (doc_id * 13) % 50 AS forwards, doc_id % 4 = 0 AS is_forwarded,
  CASE WHEN doc_id % 4 = 0 THEN 'channel_id:' || (doc_id % 9) END AS forward_from_chat
FROM documents"""

HEADERS = """
SELECT event_id AS message_id, user_id::VARCHAR AS channel_username, ts AS date,
  CASE WHEN event_id % 8 <> 2 THEN props END AS text,
  CASE WHEN event_id % 8 <> 3 THEN event_id % 100 ELSE 0 END AS views,
  CASE WHEN event_id % 8 <> 5 THEN event_id % 10 ELSE 0 END AS forwards,
  event_id % 8 <> 0 AS is_forwarded,
  CASE event_id % 8 WHEN 1 THEN 'Name ' || user_id WHEN 2 THEN 'channel_id:' || event_id
    WHEN 3 THEN 'chat_id:' || event_id WHEN 4 THEN 'user_id:' || event_id WHEN 5 THEN 'channel_id:' || event_id
    WHEN 6 THEN 'saved_msg_id:' || event_id WHEN 7 THEN 'unknown_forward_source' END AS forward_from_chat
FROM events"""

RAW_REFS = """
SELECT p_partkey AS channel_id,
  CASE WHEN p_partkey % 12 = 6 THEN 'https://t.me/@ch_' || p_partkey
    WHEN p_partkey % 6 = 0 THEN '@ch_' || p_partkey WHEN p_partkey % 6 = 1 THEN '@@ch_' || p_partkey || ' '
    WHEN p_partkey % 6 = 2 THEN ' https://t.me/ch_' || p_partkey || ' '
    WHEN p_partkey % 6 = 3 THEN ' @ch_' || p_partkey WHEN p_partkey % 6 = 4 THEN '@' ELSE '  ' END AS raw
FROM part"""

NAMES = f"""
SELECT channel_id, title AS name, 'run_' || (channel_id % 3) AS source_file, 'title' AS name_kind
FROM channels WHERE title IS NOT NULL AND {strip('title')} <> ''"""


# --- term counts -------------------------------------------------------------


def grams(words: str, highest: int = 3) -> str:
    """List of 1- to ``highest``-grams of the list ``words``."""
    if highest == 1:
        return words
    parts = [words]
    for n in range(2, highest + 1):
        joined = " || ' ' || ".join(f"{words}[i + {k}]" for k in range(n))
        parts.append(f"list_transform(range(1, len({words}) - {n - 2}), lambda i: {joined})")
    return f"list_concat({', '.join(parts)})"


def term_ctes(docs: str, key: str, text: str, languages, highest: int = 3):
    """doc_words and terms(key, term, tf) of the table ``docs``."""
    stops = _word_list(languages) if languages else "[]::VARCHAR[]"
    return (
        ("stop_list", f"SELECT unnest({stops}) AS word"),
        (
            "positions",
            f"SELECT {key}, unnest(ws) AS word, unnest(range(len(ws))) AS pos "
            f"FROM (SELECT {key}, regexp_extract_all(lower({text}), '{TOKEN}') AS ws FROM {docs})",
        ),
        (
            "doc_words",
            f"SELECT {key}, list(word ORDER BY pos) AS ws FROM positions "
            f"WHERE word NOT IN (SELECT word FROM stop_list) GROUP BY {key}",
        ),
        ("grams", f"SELECT {key}, unnest({grams('ws', highest)}) AS term FROM doc_words"),
        ("terms", f"SELECT {key}, term, count(*)::BIGINT AS tf FROM grams GROUP BY {key}, term"),
    )


def vocab_cte(docs: str, min_df, max_df=None):
    n = f"(SELECT count(*) FROM {docs})"
    low = f"count(*) >= {min_df}" if isinstance(min_df, int) else f"count(*) >= {min_df}::DOUBLE * {n}"
    high = f" AND count(*) <= {max_df}::DOUBLE * {n}" if max_df is not None else ""
    return (
        "vocab",
        f"SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS frequency FROM terms GROUP BY term HAVING {low}{high}",
    )


def name_ctes():
    return (
        ("channels", CHANNELS),
        ("names", NAMES),
        *term_ctes("names", "channel_id", "name", NAME_LANGUAGES),
        vocab_cte("names", 0.01, 0.9),
    )


PAIRS = """
SELECT x.term AS a, y.term AS b, sum(x.tf * y.tf)::BIGINT AS weight
FROM kept x JOIN kept y ON x.{key} = y.{key} AND x.term <> y.term GROUP BY x.term, y.term"""


def pair_ctes(key: str):
    return (
        ("kept", "SELECT * FROM terms WHERE term IN (SELECT term FROM vocab)"),
        ("pairs", PAIRS.format(key=key)),
        ("n", "SELECT count(*)::BIGINT AS n FROM vocab"),
    )


def centrality_ctes(doublings: int = 5, hops: int = 14):
    """Distances by repeated doubling of the path length, path counts hop by hop, then all triples."""
    ctes = [("d0", "SELECT a AS s, b AS t, weight AS d FROM pairs UNION ALL SELECT term, term, 0 FROM vocab")]
    for i in range(doublings):
        ctes.append(
            (
                f"d{i + 1}",
                f"SELECT x.s, y.t, min(x.d + y.d) AS d FROM d{i} x JOIN d{i} y ON x.t = y.s GROUP BY x.s, y.t",
            )
        )
    ctes.append(("dist", f"SELECT * FROM d{doublings}"))
    ctes.append(
        (
            "steps",
            "SELECT x.s, p.a AS u, p.b AS t FROM dist x JOIN pairs p ON x.t = p.a "
            "JOIN dist y ON y.s = x.s AND y.t = p.b WHERE x.d + p.weight = y.d",
        )
    )
    ctes.append(("h0", "SELECT term AS s, term AS t, 1.0::DOUBLE AS n FROM vocab"))
    for i in range(hops):
        ctes.append(
            (
                f"h{i + 1}",
                f"SELECT h.s, e.t, sum(h.n) AS n FROM h{i} h JOIN steps e ON e.s = h.s AND e.u = h.t GROUP BY h.s, e.t",
            )
        )
    union = " UNION ALL ".join(f"SELECT * FROM h{i}" for i in range(1, hops + 1))
    ctes.append(("paths", f"SELECT s, t, sum(n) AS n FROM ({union}) GROUP BY s, t"))
    ctes.append(("reach", "SELECT paths.s, paths.t, d, n FROM paths JOIN dist USING (s, t)"))
    ctes.append(
        (
            "through",
            "SELECT x.t AS token, sum(x.n * y.n / z.n) AS total FROM reach x JOIN reach y ON y.s = x.t "
            "JOIN reach z ON z.s = x.s AND z.t = y.t AND z.d = x.d + y.d WHERE x.s <> y.t GROUP BY x.t",
        )
    )
    ctes.append(
        (
            "between",
            "SELECT v.term AS token, CASE WHEN n <= 2 THEN 0 ELSE coalesce(total, 0) / ((n - 1) * (n - 2)) END AS b "
            "FROM vocab v CROSS JOIN n LEFT JOIN through ON token = v.term",
        )
    )
    ctes.append(
        (
            "degree",
            "SELECT v.term AS token, CASE WHEN any_value(n) = 1 THEN 1.0 ELSE count(b) / (any_value(n) - 1)::DOUBLE END AS degree, "
            "coalesce(sum(weight), 0)::DOUBLE AS strength FROM vocab v CROSS JOIN n LEFT JOIN pairs ON a = v.term GROUP BY v.term",
        )
    )
    return tuple(ctes)


CENTRALITY = """
SELECT token, round(degree, 6) AS degree_centrality, round(b, 6) AS betweenness_centrality, round(strength, 6) AS weighted_degree
FROM degree JOIN between USING (token)"""

ZIPF = """
SELECT word, frequency, row_number() OVER (ORDER BY frequency DESC, word)::BIGINT AS rank FROM freq"""

FIT = """
SELECT regr_slope(ln(frequency), ln(rank)) AS slope, regr_intercept(ln(frequency), ln(rank)) AS intercept FROM ranked"""

FEATURES = f"""
SELECT names.*, len(regexp_extract_all(name, '{WORD}'))::BIGINT AS word_count, length(name)::BIGINT AS char_count,
  len(list_intersect(regexp_split_to_array(lower(name), '[^\\p{{L}}\\p{{N}}_]+'),
    ['il', 'lo', 'la', 'i', 'gli', 'le', 'un', 'uno', 'una', 'di', 'a', 'da', 'in', 'con', 'su', 'per', 'tra', 'fra',
     'new', 'small'])) > 0 AS has_article_or_preposition
FROM names"""


def histogram(table: str, columns=("word_count", "char_count"), bins: int = 20) -> str:
    parts = []
    for column in columns:
        parts.append(
            f"""SELECT '{column}' AS metric, bin, round(lo + (bin - 1) * (hi - lo) / {bins}, 6) AS lower,
  round(lo + bin * (hi - lo) / {bins}, 6) AS upper, count(v)::BIGINT AS n
FROM (SELECT CASE WHEN l = h THEN l - 0.5 ELSE l END AS lo, CASE WHEN l = h THEN h + 0.5 ELSE h END AS hi
      FROM (SELECT min({column})::DOUBLE AS l, max({column})::DOUBLE AS h FROM {table}))
CROSS JOIN (SELECT unnest(range(1, {bins + 1})) AS bin)
LEFT JOIN (SELECT {column} AS v FROM {table}) ON bin = least(floor({bins} * (v - lo) / (hi - lo)) + 1, {bins})
GROUP BY bin, lo, hi"""
        )
    return " UNION ALL ".join(parts)


CORPUS = f"""
SELECT sha256(text) AS doc_id, channel_username, message_id, date,
  regexp_replace(text, 'http{NON_WS}+|www{NON_WS}+|https{NON_WS}+', '', 'g') AS text
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY message_id) AS k FROM messages WHERE text IS NOT NULL)
WHERE k = 1 AND date IS NOT NULL AND {strip('text')} <> ''"""


def corpus_ctes():
    return (
        ("messages", MESSAGES),
        ("corpus", CORPUS),
        *term_ctes("corpus", "doc_id", "text", ("italian",)),
        vocab_cte("corpus", 5),
    )


LENGTHS = f"""
SELECT channel_username, message_id, len(regexp_extract_all(text, '{WORD}'))::BIGINT AS word_count, length(text)::BIGINT AS char_count,
  len(regexp_extract_all(text, '{SENTENCE}'))::BIGINT AS sentence_count,
  length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))::BIGINT AS letter_count
FROM messages WHERE text IS NOT NULL"""

HITS = """
SELECT m.*, keyword, keyword_no, row_number() OVER (PARTITION BY channel_username, keyword_no
    ORDER BY date DESC NULLS LAST, message_id DESC)::BIGINT AS rank
FROM messages m JOIN (VALUES (0, ''), (1, 'the'), (2, 'und')) k(keyword_no, keyword)
  ON contains(lower(coalesce(text, '')), lower(keyword))"""

COLLECTED = """
SELECT DISTINCT message_id, channel_username, date, text, views, forwards, is_forwarded, forward_from_chat
FROM hits WHERE rank <= 30 AND coalesce(text, '') <> ''
  AND date >= TIMESTAMP '2024-01-02 00:00:00' AND date <= TIMESTAMP '2024-02-15 23:59:59'"""

NEWEST = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY date DESC, message_id DESC)::BIGINT AS rank FROM posts)
WHERE rank <= 5"""


def record(date: str = "date") -> str:
    return f"message_id, channel_username, {iso(date)} AS date, text, views, forwards, is_forwarded, forward_from_chat"


# --- snowball ----------------------------------------------------------------


def walk(name: str, start: str, first: int | str, last: int, seen: str = "") -> tuple[str, str]:
    skip = f" AND f.from_id NOT IN (SELECT channel_id FROM {seen})" if seen else ""
    return (
        name,
        f"SELECT channel_id, {first} AS depth FROM {start} UNION "
        f"SELECT f.from_id, w.depth + 1 FROM {name} w JOIN forwards f ON f.channel_id = w.channel_id "
        f"WHERE w.depth <= {last} AND f.from_id IN (SELECT channel_id FROM channels){skip}",
    )


def snowball_ctes(max_depth: int = 2):
    return (
        ("channels", CHANNELS),
        ("posts", POSTS),
        ("newest", NEWEST),
        ("forwards", "SELECT * FROM newest WHERE is_forwarded"),
        ("seeds", "SELECT * FROM (VALUES ('101'), ('ch_102'), ('no_such_channel')) s(ref)"),
        (
            "resolved",
            "SELECT ref, channel_id FROM seeds LEFT JOIN channels ON (username <> '' AND username = ref) OR channel_id::VARCHAR = ref",
        ),
        ("seed_ids", "SELECT channel_id FROM resolved WHERE channel_id IS NOT NULL"),
        walk("walk", "seed_ids", 0, max_depth),
        ("reached", "SELECT channel_id, min(depth) AS depth FROM walk GROUP BY channel_id"),
    )


def channel_rows(reached: str, first: int | str, unresolved: str) -> str:
    flags = "coalesce(broadcast, 0)::BIGINT AS broadcast, megagroup, verified, scam, fake"
    return f"""
SELECT channel_id, coalesce(username, '') AS username, coalesce(title, '') AS title, (depth = {first})::BIGINT AS is_seed,
  depth::BIGINT AS discovered_depth, participants_count, {flags}, 'ok' AS resolution_status
FROM channels JOIN {reached} USING (channel_id)
UNION ALL
SELECT NULL, ref, '', 1, 0, 0, 0, 0, 0, 0, 0, 'seed_unresolved' FROM {unresolved}"""


SNOWBALL_RELATIONS = f"""
SELECT t.channel_id AS channel_to_id, coalesce(t.username, '') AS channel_to_username, coalesce(t.title, '') AS channel_to_title,
  f.from_id AS channel_from_id, coalesce(o.username, '') AS channel_from_username, coalesce(o.title, '') AS channel_from_title,
  '' AS from_name_fallback, f.message_id AS target_message_id, {iso('f.date')} AS target_message_date_utc,
  r.depth::BIGINT AS sampling_depth
FROM forwards f JOIN reached r ON r.channel_id = f.channel_id AND r.depth <= 2
JOIN channels t ON t.channel_id = f.channel_id LEFT JOIN channels o ON o.channel_id = f.from_id"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    # forward edges and graph
    sql["forward_edges"] = with_ctes("SELECT * FROM edges", *graph_ctes())
    sql["forward_edges_all"] = with_ctes("SELECT * FROM edges", *graph_ctes(unresolved=True))
    sql["relation_matrix_long"] = sql["forward_edges_all"]
    sql["relation_matrix_tiles"] = with_ctes(
        "SELECT source, target, coalesce(weight, 0)::BIGINT AS weight FROM (SELECT DISTINCT source FROM edges) CROSS JOIN (SELECT DISTINCT target FROM edges) "
        "LEFT JOIN edges USING (source, target)",
        *graph_ctes(unresolved=True),
    )
    sql["edge_labels"] = with_ctes(
        f"SELECT channel_to_id, target_message_id, {iso('target_message_date_utc')} AS target_message_date_utc, "
        "source, target, unresolved FROM labelled",
        *graph_ctes()[:3],
    )
    targets = [f"src{n}" for n in (0, 12, 16, 4, 8)]
    cells = ", ".join(f"count(*) FILTER (channel_username = '{t}')::BIGINT AS {t}" for t in targets)
    sql["relation_matrix"] = with_ctes(
        f"SELECT 'channel_id:' || (message_id % 9) AS source, {cells} FROM messages WHERE is_forwarded GROUP BY 1",
        ("messages", MESSAGES),
    )
    sql["relation_rows"] = with_ctes(
        "SELECT source, string_agg(target || '=' || weight, '|' ORDER BY target) AS cells FROM edges GROUP BY source", *graph_ctes()
    )
    sql["matrix_summary"] = with_ctes(
        "SELECT count(DISTINCT source)::BIGINT AS sources, count(DISTINCT target)::BIGINT AS targets, "
        "count(*)::BIGINT AS non_zero_cells FROM edges",
        *graph_ctes(),
    )
    sql["graph_nodes"] = with_ctes(
        """SELECT node AS Id, node AS Label, CASE kind WHEN 1 THEN 'channel' ELSE 'source' END AS node_type
FROM (SELECT node, kind, row_number() OVER (PARTITION BY node ORDER BY place DESC, kind DESC) AS k
      FROM (SELECT source AS node, place, 0 AS kind FROM numbered UNION ALL SELECT target, place, 1 FROM numbered))
WHERE k = 1""",
        *graph_ctes(min_weight=2),
        ("numbered", "SELECT *, row_number() OVER (ORDER BY weight DESC, source, target) AS place FROM edges"),
    )
    sql["graph_edges"] = with_ctes(
        "SELECT source AS Source, target AS Target, 'directed' AS Type, weight AS Weight FROM edges", *graph_ctes(min_weight=2)
    )
    sql["graph_summary"] = with_ctes(
        "SELECT (SELECT count(*) FROM (SELECT source FROM edges UNION SELECT target FROM edges))::BIGINT AS nodes, "
        "(SELECT count(*) FROM edges)::BIGINT AS edges",
        *graph_ctes(min_weight=2),
    )
    sql["top_edges"] = with_ctes("SELECT * FROM edges ORDER BY weight DESC, source, target LIMIT 5", *graph_ctes())

    # references, cells, dates
    bare = f"CASE WHEN starts_with({strip('raw')}, 'https://t.me/') THEN substr({strip('raw')}, 14) ELSE {strip('raw')} END"
    at_cut = f"regexp_replace({bare}, '^@', '')"
    sql["normalize_refs"] = with_ctes(f"SELECT channel_id, raw, {strip(at_cut)} AS ref FROM raw_refs", ("raw_refs", RAW_REFS))
    no_ats = "ltrim(raw, '@')"
    sql["normalize_names"] = with_ctes(f"SELECT channel_id, raw, {strip(no_ats)} AS name FROM raw_refs", ("raw_refs", RAW_REFS))
    numbers = """SELECT event_id, CASE event_id % 5 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN '  ' || user_id || ' '
  WHEN 2 THEN 'n/a' WHEN 3 THEN user_id || '.5' ELSE '-' || user_id END AS raw FROM events"""
    whole = "CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN trim(raw)::BIGINT END"
    sql["safe_int"] = with_ctes(
        f"SELECT event_id, raw, coalesce({whole}, 0) AS parsed, greatest(coalesce({whole}, 40), 1) AS at_least_one FROM numbers",
        ("numbers", numbers),
    )
    dates = """SELECT o_orderkey AS order_id, o_orderkey % 4 AS kind, strftime(o_orderdate, '%Y-%m-%d') AS day,
  lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS hour FROM orders"""
    raw = """CASE kind WHEN 0 THEN day WHEN 1 THEN day || 'T' || hour || ':15:00'
  WHEN 2 THEN day || 'T' || hour || ':15:00+02:00' ELSE day || ' ' || hour || ':15:00' END"""
    at = "(day || ' ' || hour || ':15:00')::TIMESTAMP - CASE WHEN kind = 2 THEN to_hours(2) ELSE to_hours(0) END"
    lower = f"CASE WHEN kind = 0 THEN day::TIMESTAMP ELSE {at} END"
    upper = f"CASE WHEN kind = 0 THEN day::TIMESTAMP + to_seconds(86399) ELSE {at} END"
    sql["date_bounds"] = with_ctes(
        f"SELECT order_id, raw, {iso('lo')} AS lower_bound, {iso('hi')} AS upper_bound "
        f"FROM (SELECT order_id, {raw} AS raw, {lower} AS lo, {upper} AS hi FROM dates)",
        ("dates", dates),
    )
    sql["forward_source"] = with_ctes("SELECT message_id, is_forwarded, forward_from_chat FROM headers", ("headers", HEADERS))

    # messages
    sql["channel_list"] = with_ctes(
        f"SELECT DISTINCT {strip(no_ats)} AS channel_username FROM raw_refs WHERE {strip(no_ats)} <> ''", ("raw_refs", RAW_REFS)
    )
    sql["pending_channels"] = with_ctes(
        "SELECT DISTINCT username AS channel_username FROM channels WHERE username <> '' AND channel_id NOT IN "
        "(SELECT l_partkey FROM lineitem WHERE l_shipdate <= TIMESTAMP '1995-01-01')",
        ("channels", CHANNELS),
    )
    sql["latest_posts"] = with_ctes(
        f"SELECT channel_id, message_id, {iso('date')} AS date, is_forwarded, from_id, rank FROM newest",
        ("posts", POSTS),
        ("newest", NEWEST),
    )
    sql["keyword_counts"] = with_ctes(
        f"SELECT keyword, count(*)::BIGINT AS posts FROM messages JOIN (SELECT unnest({_word_list(NAME_LANGUAGES)}) AS keyword) "
        "ON contains(lower(coalesce(text, '')), lower(keyword)) GROUP BY keyword",
        ("messages", MESSAGES),
    )
    sql["keyword_posts"] = with_ctes(
        "SELECT channel_username, keyword, message_id, rank FROM hits WHERE rank <= 10", ("messages", MESSAGES), ("hits", HITS)
    )
    sql["messages_in_range"] = with_ctes(
        f"SELECT channel_id, message_id, {iso('date')} AS date FROM posts "
        "WHERE date >= TIMESTAMP '1995-01-01 00:00:00' AND date <= TIMESTAMP '1996-12-31 23:59:59'",
        ("posts", POSTS),
    )
    collected = (("messages", MESSAGES), ("hits", HITS), ("collected", COLLECTED))
    sql["message_records"] = with_ctes(f"SELECT {record()} FROM collected", *collected)
    sql["channel_trace"] = with_ctes(
        "SELECT channel_username, count(*)::BIGINT AS messages_written FROM collected GROUP BY 1", *collected
    )
    sql["messages_per_channel"] = with_ctes(
        "SELECT channel_username, count(*)::BIGINT AS messages FROM messages GROUP BY 1", ("messages", MESSAGES)
    )
    sql["collection_totals"] = with_ctes(
        "SELECT count(*)::BIGINT AS messages, count(DISTINCT channel_username)::BIGINT AS channels, "
        "sum(views)::BIGINT AS total_views FROM messages",
        ("messages", MESSAGES),
    )
    sql["top_forward_sources"] = with_ctes(
        "SELECT forward_from_chat, count(*)::BIGINT AS messages FROM messages WHERE forward_from_chat IS NOT NULL "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
        ("messages", MESSAGES),
    )

    # snowball sampling
    missing = "(SELECT ref FROM resolved WHERE channel_id IS NULL)"
    sql["snowball_channels"] = with_ctes(
        f"SELECT *, 'channel:' || channel_id AS channel_key FROM ({channel_rows('reached', 0, missing)})",
        *snowball_ctes(),
        recursive=True,
    )
    sql["snowball_relations"] = with_ctes(SNOWBALL_RELATIONS, *snowball_ctes(), recursive=True)
    sql["snowball_restart"] = sql["snowball_relations"]
    sql["snowball_summary"] = with_ctes(
        "SELECT total_channels, seeds, total_channels - seeds AS discovered, relations FROM (SELECT "
        "(SELECT count(*) FROM reached) + (SELECT count(*) FROM resolved WHERE channel_id IS NULL) AS total_channels, "
        "(SELECT count(*) FROM seeds) AS seeds, (SELECT count(*) FROM rows_found) AS relations)",
        *snowball_ctes(),
        ("rows_found", SNOWBALL_RELATIONS),
        recursive=True,
    )
    earlier = """SELECT username, channel_id % 4 AS depth FROM channels WHERE channel_id % 3 <> 0
UNION ALL SELECT username, channel_id % 5 FROM channels WHERE channel_id % 2 = 0"""
    sql["resume_seeds"] = with_ctes(
        "SELECT username, min(depth)::BIGINT AS discovered_depth, (max(min(depth)) OVER ())::BIGINT AS previous_depth "
        "FROM earlier WHERE username <> '' GROUP BY username",
        ("channels", CHANNELS),
        ("earlier", earlier),
    )
    deepest = "(SELECT depth FROM deepest)"
    sql["snowball_resume"] = with_ctes(
        channel_rows("more", deepest, f"(SELECT ref FROM resolved WHERE channel_id IS NULL AND {deepest} = 0)"),
        *snowball_ctes(max_depth=1),
        ("known", "SELECT channel_id, depth FROM reached JOIN channels USING (channel_id) WHERE username <> ''"),
        (
            "deepest",
            "SELECT max(depth) AS depth FROM (SELECT depth FROM known UNION ALL SELECT 0 FROM resolved WHERE channel_id IS NULL)",
        ),
        ("at_start", f"SELECT channel_id FROM known WHERE depth = {deepest}"),
        ("visited", f"SELECT channel_id FROM known WHERE depth < {deepest}"),
        walk("walk_on", "at_start", deepest, 3, "visited"),
        ("more", "SELECT channel_id, min(depth) AS depth FROM walk_on GROUP BY channel_id"),
        recursive=True,
    )

    # stored tables
    stored = f"channel_id, {cell('username')} AS username, {cell('title')} AS title"
    sql["channels_scan"] = with_ctes(
        f"SELECT {stored}, 'r' || (channel_id % 3) AS source_file FROM channels", ("channels", CHANNELS)
    )
    text_columns = ("channel_to_username", "channel_to_title", "channel_from_username", "channel_from_title", "from_name_fallback")
    sql["relations_scan"] = with_ctes(
        "SELECT channel_to_id, channel_from_id, target_message_id, 0::BIGINT AS sampling_depth, "
        f"{iso('target_message_date_utc')} AS target_message_date_utc, "
        + ", ".join(f"{cell(c)} AS {c}" for c in text_columns)
        + " FROM relations",
        ("channels", CHANNELS),
        ("relations", RELATIONS),
    )
    sql["csv_roundtrip"] = with_ctes(
        f"SELECT message_id, channel_username, nullif({iso('date')}, '') AS date, nullif(text, '') AS text, views, forwards, "
        "is_forwarded, forward_from_chat FROM messages",
        ("messages", MESSAGES),
    )
    sql["latest_snapshot"] = with_ctes(f"SELECT channel_id, {cell('title')} AS title FROM channels", ("channels", CHANNELS))

    # channel names
    named = (("channels", CHANNELS), ("names", NAMES))
    sql["name_table"] = with_ctes("SELECT * FROM names", *named)
    featured = (*named, ("features", FEATURES))
    sql["name_features"] = with_ctes("SELECT * FROM features", *featured)
    stats = {
        "avg_words_per_name": "avg(word_count)",
        "avg_chars_per_name": "avg(char_count)",
        "pct_names_with_article_or_preposition": "avg(has_article_or_preposition::INT)",
    }
    sql["name_length_stats"] = with_ctes(
        " UNION ALL ".join(f"SELECT '{name}' AS metric, round({value}, 6) AS value FROM features" for name, value in stats.items()),
        *featured,
    )
    sql["length_histogram"] = with_ctes(histogram("features"), *featured)
    freq = ("freq", "SELECT term AS word, frequency FROM vocab")
    ranked = (*name_ctes(), freq, ("ranked", ZIPF))
    sql["name_summary"] = with_ctes(
        "SELECT (SELECT count(*) FROM channels)::BIGINT AS merged_csv_rows, count(*)::BIGINT AS names_analyzed, "
        + ", ".join(f"round({value}, 6) AS {name}" for name, value in stats.items())
        + ", (SELECT round(slope, 6) FROM fit) AS zipf_slope, (SELECT round(intercept, 6) FROM fit) AS zipf_intercept FROM features",
        *ranked,
        ("fit", FIT),
        ("features", FEATURES),
    )
    token_list = f"regexp_extract_all(lower(name), '{TOKEN}')"
    explode = "unnest(ws) AS token, unnest(range(len(ws)))::BIGINT AS position"
    sql["tokens"] = with_ctes(
        f"SELECT channel_id, {explode} FROM (SELECT channel_id, {token_list} AS ws FROM names)", *named
    )
    sql["tokens_clean"] = with_ctes(f"SELECT channel_id, {explode} FROM doc_words", *name_ctes())
    sql["ngrams"] = with_ctes("SELECT channel_id, term, tf FROM terms", *name_ctes())
    sql["stopwords"] = with_ctes(
        "SELECT word, count(*)::BIGINT AS occurrences FROM words WHERE word IN (SELECT word FROM stop_list) GROUP BY word",
        ("stop_list", f"SELECT unnest({_word_list(NAME_LANGUAGES)}) AS word"),
        ("words", f"SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS word FROM documents"),
    )
    sql["vocabulary"] = with_ctes("SELECT * FROM vocab", *name_ctes())
    sql["doc_terms"] = with_ctes(
        "SELECT name AS text, term, count(*)::BIGINT AS copies, any_value(tf)::BIGINT AS tf FROM terms JOIN names USING (channel_id) "
        "WHERE term IN (SELECT term FROM vocab) GROUP BY name, term",
        *name_ctes(),
    )
    sql["word_frequency"] = with_ctes("SELECT * FROM freq", *name_ctes(), freq)
    sql["top_tokens"] = with_ctes("SELECT * FROM freq ORDER BY frequency DESC, word LIMIT 25", *name_ctes(), freq)
    name_graph = (*name_ctes(), *pair_ctes("channel_id"))
    sql["word_cooccurrence"] = with_ctes("SELECT * FROM pairs", *name_graph)
    sql["word_graph"] = with_ctes("SELECT term AS a, b, weight FROM vocab LEFT JOIN pairs ON a = term", *name_graph)
    central = (*name_graph, *centrality_ctes())
    sql["word_degree"] = with_ctes(
        "SELECT token, round(degree, 6) AS degree_centrality, round(strength, 6) AS weighted_degree FROM degree", *central
    )
    sql["word_betweenness"] = with_ctes("SELECT token, round(b, 6) AS betweenness_centrality FROM between", *central)
    sql["word_centrality"] = with_ctes(CENTRALITY, *central)
    sql["word_files"] = sql["word_frequency"]
    sql["zipf_table"] = with_ctes(
        "SELECT word, frequency, rank, round(ln(rank), 6) AS log_rank, round(ln(frequency), 6) AS log_frequency FROM ranked", *ranked
    )
    rounded_fit = "SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fit"
    sql["zipf_fit"] = with_ctes(rounded_fit, *ranked, ("fit", FIT))

    # topics
    corpus = corpus_ctes()
    sql["topic_corpus"] = with_ctes(f"SELECT doc_id, channel_username, message_id, {iso('date')} AS date, text FROM corpus", *corpus[:2])
    sql["topic_corpus_scan"] = sql["topic_corpus"]
    weighted = (
        "SELECT doc_id, term, round(tf * (ln((1 + (SELECT count(*) FROM corpus)) / (1 + df)::DOUBLE) + 1), 6) AS weight "
        "FROM terms JOIN vocab USING (term)"
    )
    top = (
        "SELECT * FROM (SELECT doc_id, term, weight, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term)::BIGINT AS rank "
        "FROM weighted) WHERE rank <= 5"
    )
    sql["topic_keywords"] = with_ctes(top, *corpus, ("weighted", weighted))
    cosine = (
        "SELECT doc_id, term, round(list_cosine_similarity(dv.embedding::DOUBLE[], tv.embedding::DOUBLE[]), 6) AS weight "
        "FROM terms JOIN vocab USING (term) JOIN corpus USING (doc_id) JOIN embeddings dv ON dv.vec_id = message_id % (SELECT count(*) FROM embeddings) "
        "JOIN embeddings tv ON tv.vec_id = ('0x' || substr(md5(term), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings)"
    )
    sql["vector_keywords"] = with_ctes(top, *corpus, ("weighted", cosine))
    sql["topic_time_bins"] = with_ctes(
        "SELECT doc_id, least(floor(10 * (epoch(date) - lo) / (hi - lo)) + 1, 10)::BIGINT AS bin FROM corpus "
        "CROSS JOIN (SELECT min(epoch(date)) AS lo, max(epoch(date)) AS hi FROM corpus)",
        *corpus[:2],
    )

    # message texts
    words = ("freq", f"SELECT word, count(*)::BIGINT AS frequency FROM (SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS word FROM messages) GROUP BY word")
    sql["message_term_freq"] = with_ctes("SELECT * FROM freq", ("messages", MESSAGES), words)
    sql["message_zipf"] = with_ctes(rounded_fit, ("messages", MESSAGES), words, ("ranked", ZIPF), ("fit", FIT))
    sql["message_ngrams"] = with_ctes("SELECT * FROM vocab", *corpus)
    word_graph = (
        *corpus[:2],
        *term_ctes("corpus", "doc_id", "text", NAME_LANGUAGES, 1),
        vocab_cte("corpus", 0.1, 0.9),
        *pair_ctes("doc_id"),
        *centrality_ctes(),
    )
    sql["message_word_centrality"] = with_ctes(CENTRALITY, *word_graph)
    lengths = (("messages", MESSAGES), ("lengths", LENGTHS))
    sql["message_lengths"] = with_ctes("SELECT * FROM lengths", *lengths)
    sql["message_length_histogram"] = with_ctes(histogram("lengths"), *lengths)
    sql["sentence_length"] = with_ctes(
        "SELECT channel_username, message_id, word_count, sentence_count, CASE WHEN sentence_count > 0 THEN round(word_count / sentence_count, 6) END "
        "AS words_per_sentence FROM lengths",
        *lengths,
    )
    sql["letters_per_word"] = with_ctes(
        "SELECT channel_username, message_id, word_count, letter_count, CASE WHEN word_count > 0 THEN round(letter_count / word_count, 6) END "
        "AS letters_per_word FROM lengths",
        *lengths,
    )
    sql["gulpease"] = with_ctes(
        "SELECT channel_username, message_id, CASE WHEN word_count > 0 THEN round(89 + (300 * sentence_count - 10 * letter_count) / word_count, 6) END "
        "AS gulpease FROM lengths",
        *lengths,
    )

    # streams
    headers = ("headers", HEADERS)
    sql["stream_collect"] = with_ctes(
        f"SELECT {record()} FROM headers WHERE coalesce(text, '') <> '' AND date >= TIMESTAMP '2024-01-03 00:00:00'", headers
    )
    sql["stream_dedup"] = with_ctes(f"SELECT {record()} FROM headers WHERE coalesce(text, '') <> ''", headers)
    for same in ("stream_resume", "stream_dedup_merged", "stream_flush"):
        sql[same] = sql["stream_dedup"]
    sql["stream_trace"] = with_ctes(
        "SELECT channel_username, count(*)::BIGINT AS messages_written FROM headers WHERE coalesce(text, '') <> '' GROUP BY 1", headers
    )
    sql["stream_trace_merged"] = sql["stream_trace"]
    return sql
