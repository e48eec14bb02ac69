"""Expected rows of the registered queries as SQL, and the parameters both sides use."""

from __future__ import annotations

SPAN_S = 86_400
BUCKETS = 10
REPEAT_BUCKETS = 2
SEEDS = ["click_1", "error_7", "view_3"]
LOG_BLOCKS = 24
TOP_REFS = 12
TOP_DOCS = 3
USER_MIN_COUNT = 50
URL_MIN_COUNT = 40
URL_BUCKETS = 1 << 16
STREAM_DELAY_S = 3_600
MANY_CLUSTERS = 80
SKEWED_SPAN_S = 3_600
FEW_CLUSTERS = 5
SUGGESTIONS = 15
DOC_ROWS_PER_TASK = 60

# Pipeline defaults, stated again on purpose.
DEFAULT_SPAN_S = 600
PIPELINE_REFS = 80
DEFAULT_DOCS = 15
MIN_CLUSTERS = 20
EPSILON = 0.6
DOUBLINGS = 4
BOT = 71845


def _with(ctes: dict[str, str], select: str) -> str:
    # Named in the recursive steps, a table must not be computed again for each of them.
    body = ",\n".join(
        f"{name} AS {'' if '(' in name else 'MATERIALIZED '}({sql})" for name, sql in ctes.items()
    )
    return f"WITH RECURSIVE {body}\n{select}"


def _log(buckets: int = BUCKETS) -> dict[str, str]:
    return {
        "keyed": "SELECT *, CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) AS k FROM events",
        "log": f"""
            SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, event_id AS seq,
                   event_type || '_' || (k % {buckets}) AS query,
                   CASE WHEN event_type IN ('click', 'purchase') THEN 'd' || k ELSE '' END AS doc
            FROM keyed""",
    }


def _lines() -> dict[str, str]:
    def odd(low: int, value: str, otherwise: str) -> str:
        return f"CASE WHEN k BETWEEN {low} AND {low + 4} THEN {value} ELSE {otherwise} END"

    user = odd(0, "'u' || user_id", odd(5, f"'{BOT}'", "user_id::VARCHAR"))
    query = odd(10, "'-'", "event_type || ' ' || (k % 10)")
    time = odd(15, "'yesterday'", "strftime(ts, '%Y-%m-%d %H:%M:%S')")
    rank = "CASE WHEN event_type IN ('click', 'purchase') THEN k::VARCHAR ELSE '' END"
    url = "CASE WHEN event_type IN ('click', 'purchase') THEN 'http://site/' || k ELSE '' END"
    tail = odd(20, "chr(9) || chr(9)", "''")
    line = " || chr(9) || ".join(f"({part})" for part in (user, query, time, rank, url))
    return {
        "keyed": _log()["keyed"],
        "lines": f"SELECT {odd(25, user, f'{line} || {tail}')} AS value, event_id AS seq FROM keyed",
        "fields": """
            SELECT value, seq, string_split(regexp_replace(value, '\\t+$', ''), chr(9)) AS f
            FROM lines""",
        "typed": """
            SELECT value, seq, f[2] AS query, TRY_CAST(f[1] AS BIGINT) AS user_id,
                   try_strptime(f[3], '%Y-%m-%d %H:%M:%S') AS ts,
                   CASE WHEN len(f) = 5 THEN f[5] ELSE '' END AS doc
            FROM fields""",
        "parsed": f"""
            SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, seq, query, doc FROM typed
            WHERE query <> '-' AND user_id IS NOT NULL AND user_id <> {BOT} AND ts IS NOT NULL""",
        "rejected": f"""
            SELECT value FROM typed
            WHERE query IS NULL
               OR (query <> '-' AND (user_id IS NULL OR (user_id <> {BOT} AND ts IS NULL)))""",
    }


def _trail(buckets: int = BUCKETS) -> dict[str, str]:
    return _log(buckets) | {
        "marked": """
            SELECT *, lag(query, 1, '') OVER w AS prev_query, lag(doc, 1, '') OVER w AS prev_doc
            FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, seq)""",
        "trail": """
            SELECT user_id, ts_ms, seq, query, doc, prev_query FROM marked
            WHERE NOT (query = prev_query AND doc = prev_doc)""",
    }


def _sessions(span_s: int = SPAN_S, seeds: list[str] | None = None) -> dict[str, str]:
    expiry = (span_s + 1) * 1000
    names = ", ".join(f"'{seed}'" for seed in seeds or [])
    only = f"AND query IN ({names})" if seeds else ""
    return _trail() | {
        "candidates": f"""
            SELECT user_id, query, ts_ms, seq FROM trail WHERE query <> prev_query {only}""",
        "starts(user_id, query, ts_ms, seq)": f"""
            SELECT user_id, query, ts_ms, seq FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY user_id, query ORDER BY ts_ms, seq) AS rn
                FROM candidates) WHERE rn = 1
            UNION ALL
            SELECT user_id, query, ts_ms, seq FROM (
                SELECT c.*, row_number() OVER (
                    PARTITION BY s.user_id, s.query, s.ts_ms ORDER BY c.ts_ms, c.seq) AS rn
                FROM starts s JOIN candidates c
                  ON c.user_id = s.user_id AND c.query = s.query
                 AND c.ts_ms - s.ts_ms >= {expiry}) WHERE rn = 1""",
        "sessions": f"""
            SELECT s.user_id || '_' || s.seq AS session_id, s.user_id, s.query,
                   t.query AS refinement, t.doc, 1 AS count
            FROM starts s JOIN trail t
              ON t.user_id = s.user_id AND t.query <> s.query AND t.ts_ms - s.ts_ms < {expiry}
             AND (t.ts_ms > s.ts_ms OR (t.ts_ms = s.ts_ms AND t.seq > s.seq))""",
    }


def _counts(
    k: int = PIPELINE_REFS, docs_k: int | None = None, docs_of_top: bool = True
) -> dict[str, str]:
    top_only = "SEMI JOIN top_refs USING (query, refinement)" if docs_of_top else ""
    cut = f"WHERE rn <= {docs_k}" if docs_k else ""
    return _sessions() | {
        "single": "SELECT DISTINCT session_id, query, refinement, count FROM sessions",
        "ref_counts": """
            SELECT query, refinement, CAST(sum(count) AS BIGINT) AS count
            FROM single GROUP BY query, refinement""",
        "top_refs": f"""
            SELECT query, refinement, count FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY query ORDER BY count DESC, refinement) AS rn
                FROM ref_counts) WHERE rn <= {k}""",
        "top_single": "SELECT * FROM single SEMI JOIN top_refs USING (query, refinement)",
        "pairs": """
            SELECT a.query, a.refinement, b.refinement AS co_refinement, 1 AS count
            FROM top_single a JOIN top_single b
              ON a.session_id = b.session_id AND a.query = b.query
             AND a.refinement < b.refinement""",
        "co_occ": """
            SELECT query, refinement, co_refinement, CAST(sum(count) AS BIGINT) AS count
            FROM pairs GROUP BY query, refinement, co_refinement""",
        "clicks": f"""
            SELECT query, refinement, doc, count FROM sessions {top_only} WHERE doc <> ''""",
        "all_docs": """
            SELECT query, refinement, doc, CAST(sum(count) AS BIGINT) AS count
            FROM clicks GROUP BY query, refinement, doc""",
        "docs": f"""
            SELECT query, refinement, doc, count FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY query, refinement ORDER BY count DESC, doc) AS rn
                FROM all_docs) {cut}""",
        "both_ways": """
            SELECT query, refinement, co_refinement, count FROM co_occ
            UNION ALL SELECT query, co_refinement, refinement, count FROM co_occ""",
    }


def _walk(docs_k: int | None = None) -> dict[str, str]:
    ctes = _counts(docs_k=docs_k) | {
        "in_co": "SELECT * FROM both_ways WHERE query IN (SELECT query FROM docs)",
        "in_docs": "SELECT * FROM docs WHERE query IN (SELECT query FROM co_occ)",
        "refs": """
            SELECT query, refinement, sum(count) AS pair_sum,
                   count(*) OVER (PARTITION BY query) AS n_refs,
                   row_number() OVER (PARTITION BY query ORDER BY refinement) AS idx
            FROM in_co GROUP BY query, refinement""",
        "row_scale": f"""
            SELECT r.query, r.refinement, r.pair_sum, r.n_refs, d.doc_sum,
                   (1 - {EPSILON}::DOUBLE) + CASE WHEN d.doc_sum > 0 THEN {EPSILON}::DOUBLE ELSE 0 END
                   + 1::DOUBLE / r.n_refs AS scale
            FROM refs r LEFT JOIN (
                SELECT query, refinement, sum(count) AS doc_sum FROM in_docs
                GROUP BY query, refinement) d USING (query, refinement)""",
        "a0": f"""
            SELECT c.query, c.refinement AS src, c.co_refinement AS dst,
                   (1 - {EPSILON}::DOUBLE) * (c.count::DOUBLE / r.pair_sum) / r.scale AS p
            FROM in_co c JOIN row_scale r USING (query, refinement)""",
        "b0": f"""
            SELECT d.query, d.refinement AS src, d.doc AS dst,
                   {EPSILON}::DOUBLE * (d.count::DOUBLE / r.doc_sum) / r.scale AS p
            FROM in_docs d JOIN row_scale r USING (query, refinement)""",
        "transitions": """
            SELECT query, src, dst, 'ref' AS kind, p FROM a0
            UNION ALL SELECT query, src, dst, 'doc', p FROM b0
            UNION ALL SELECT query, refinement, '', 'topic', 1::DOUBLE / n_refs / scale
            FROM row_scale""",
    }
    for i in range(DOUBLINGS):
        ctes[f"b{i + 1}"] = f"""
            SELECT query, src, dst, sum(p) AS p FROM (
                SELECT * FROM b{i}
                UNION ALL
                SELECT a.query, a.src, b.dst, a.p * b.p
                FROM a{i} a JOIN b{i} b ON a.query = b.query AND a.dst = b.src)
            GROUP BY query, src, dst"""
        ctes[f"a{i + 1}"] = f"""
            SELECT x.query, x.src, y.dst, sum(x.p * y.p) AS p
            FROM a{i} x JOIN a{i} y ON x.query = y.query AND x.dst = y.src
            GROUP BY x.query, x.src, y.dst"""
    return ctes


def _similarity(mode: str, docs_k: int | None = None) -> dict[str, str]:
    return _walk(docs_k) | {
        "vectors": f"SELECT query, src AS refinement, dst AS doc, p FROM b{DOUBLINGS}",
        "norms": """
            SELECT query, refinement, sqrt(sum(p * p)) AS norm FROM vectors
            GROUP BY query, refinement""",
        "sims": f"""
            SELECT query, refinement, co_refinement, product / (x.norm * y.norm) AS similarity
            FROM (SELECT a.query, a.refinement, b.refinement AS co_refinement,
                         {mode}(a.p * b.p) AS product
                  FROM vectors a JOIN vectors b
                    ON a.query = b.query AND a.doc = b.doc AND a.refinement < b.refinement
                  GROUP BY a.query, a.refinement, b.refinement)
            JOIN norms x USING (query, refinement)
            JOIN (SELECT query, refinement AS co_refinement, norm FROM norms) y
              USING (query, co_refinement)""",
    }


def _clusters(
    mode: str = "max", docs_k: int | None = None, min_clusters: int = MIN_CLUSTERS
) -> dict[str, str]:
    """Complete-link merging: a cluster is named by the index of its latest member."""
    return _similarity(mode, docs_k) | {
        "pair_sim": """
            SELECT s.query, a.idx AS low, b.idx AS high, CASE WHEN s.similarity > 0 THEN round(s.similarity / pow(10, floor(log10(s.similarity))), 11)
                        * pow(10, floor(log10(s.similarity))) ELSE 0 END AS similarity
            FROM sims s
            JOIN refs a ON a.query = s.query AND a.refinement = s.refinement
            JOIN refs b ON b.query = s.query AND b.refinement = s.co_refinement""",
        "merging(query, step, idx, head)": f"""
            SELECT query, 0, idx, idx FROM refs
            UNION ALL
            SELECT m.query, m.step + 1, m.idx,
                   CASE WHEN m.head = best.low THEN best.high ELSE m.head END
            FROM merging m JOIN (
                SELECT query, low, high FROM (
                    SELECT query, low, high, score, row_number() OVER (
                        PARTITION BY query ORDER BY score DESC, high DESC, low DESC) AS rn
                    FROM (
                        SELECT x.query, x.head AS low, y.head AS high,
                               min(coalesce(p.similarity, 0)) AS score
                        FROM merging x
                        JOIN merging y ON x.query = y.query AND x.head < y.head
                        LEFT JOIN pair_sim p
                          ON p.query = x.query AND p.low = least(x.idx, y.idx)
                         AND p.high = greatest(x.idx, y.idx)
                        WHERE x.query IN (
                            SELECT query FROM merging GROUP BY query
                            HAVING count(DISTINCT head) > {min_clusters})
                        GROUP BY x.query, x.head, y.head))
                WHERE rn = 1 AND score > 0) best ON best.query = m.query""",
        "merged": """
            SELECT query, idx, head FROM (
                SELECT *, max(step) OVER (PARTITION BY query) AS last FROM merging)
            WHERE step = last""",
        "cluster_ids": """
            SELECT m.query,
                   CAST(dense_rank() OVER (PARTITION BY m.query ORDER BY m.head) - 1 AS INTEGER)
                       AS cluster_id,
                   r.refinement
            FROM merged m JOIN refs r ON r.query = m.query AND r.idx = m.idx""",
        "clusters": """
            SELECT c.query, c.cluster_id, c.refinement, t.count AS ref_count
            FROM cluster_ids c JOIN top_refs t USING (query, refinement)""",
    }


def _singletons() -> dict[str, str]:
    walk = _walk()
    needed = {name: sql for name, sql in walk.items() if not name[1:].isdigit()}
    return needed | {
        "cluster_ids": "SELECT query, CAST(idx - 1 AS INTEGER) AS cluster_id, refinement FROM refs",
        "clusters": """
            SELECT c.query, c.cluster_id, c.refinement, t.count AS ref_count
            FROM cluster_ids c JOIN top_refs t USING (query, refinement)""",
    }


def _uneven() -> dict[str, str]:
    power = "pow(10, (right(refinement, 1)::INTEGER + right(co_refinement, 1)::INTEGER) % 7)"
    return _clusters(min_clusters=FEW_CLUSTERS) | {
        "co_occ": f"""
            SELECT query, refinement, co_refinement, CAST(sum(count) * {power} AS BIGINT) AS count
            FROM pairs GROUP BY query, refinement, co_refinement""",
    }


def _file_sessions() -> dict[str, str]:
    numbered = "SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS place FROM lines"
    log = f"""
        SELECT user_id, ts_ms, place AS seq, query, doc
        FROM parsed JOIN ({numbered}) USING (seq)"""
    rest = {name: sql for name, sql in _sessions().items() if name not in ("keyed", "log")}
    return _lines() | {"log": log} | rest


def _skewed() -> dict[str, str]:
    ctes = _sessions(SKEWED_SPAN_S)
    skewed = "SELECT CASE WHEN seq % 3 = 0 THEN 1 ELSE user_id END AS user_id, ts_ms, seq, query, doc FROM log"
    named = {name: sql.replace("FROM log WINDOW", "FROM skewed WINDOW") for name, sql in ctes.items()}
    return {"keyed": named.pop("keyed"), "log": named.pop("log"), "skewed": skewed} | named


def _suggestions() -> dict[str, str]:
    return _clusters() | {
        "ranked": f"""
            SELECT * FROM (
                SELECT *, CAST(row_number() OVER (
                    PARTITION BY query ORDER BY ref_count DESC, cluster_id, refinement)
                    AS INTEGER) AS rank
                FROM clusters WHERE query IN (SELECT query FROM log WHERE doc <> ''))
            WHERE rank <= {SUGGESTIONS}""",
        "grouped": """
            SELECT query, min(rank) AS best, string_agg(refinement, ',' ORDER BY rank) AS members
            FROM ranked GROUP BY query, cluster_id""",
    }


def _tabs(*columns: str) -> str:
    return " || chr(9) || ".join(columns)


def all_queries() -> dict[str, str]:
    cluster_columns = "query, cluster_id, refinement, ref_count"
    rounded = "round({0}, 9) AS {0}"
    session_line = _tabs("session_id", "query", "refinement", "doc", "count")
    ref_line = _tabs("'q: ' || query", "'r: ' || refinement", "count")
    cluster_line = _tabs("query", "cluster_id", "refinement", "ref_count")
    report = "CASE WHEN count < 1000000 THEN lpad(count::VARCHAR, 6, ' ') ELSE count::VARCHAR END || chr(9) || key"
    trail = "SELECT user_id, ts_ms, seq, query, doc FROM trail"
    starts = "SELECT user_id, query, ts_ms, seq FROM starts"
    sessions = "SELECT * FROM sessions"
    transitions = f"SELECT query, src, dst, kind, {rounded.format('p')} FROM transitions"
    similar = f"SELECT query, refinement, co_refinement, {rounded.format('similarity')} FROM sims"

    def counted(source: str, key: str, min_count: int, where: str = "true") -> str:
        return f"""
            SELECT key, count, {report} AS line FROM (
                SELECT {key} AS key, count(*) AS count FROM {source}
                WHERE {where} AND {key} IS NOT NULL GROUP BY 1) WHERE count > {min_count}"""

    not_empty = "f[2] <> '-'"
    invalid = """
        SELECT session_id FROM sessions GROUP BY session_id
        HAVING count(*) = 1 AND max(doc) = ''"""
    return {
        "parse_log_lines": _with(_lines(), "SELECT * FROM parsed"),
        "rejected_rows": _with(_lines(), "SELECT * FROM rejected"),
        "read_query_log": _with(_lines(), "SELECT user_id, ts_ms, query, doc FROM parsed"),
        "read_rejected_rows": _with(_lines(), "SELECT * FROM rejected"),
        "log_files_rejected": _with(_lines(), "SELECT * FROM rejected"),
        "parse_log_lines_bot_table": _with(
            _lines(),
            """
            SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, seq, query, doc FROM typed
            WHERE query <> '-' AND user_id IS NOT NULL AND ts IS NOT NULL
              AND user_id NOT IN (SELECT user_id FROM events WHERE user_id % 10 = 7)""",
        ),
        "field_counts_event_type": counted("events", "event_type", 1000),
        "field_counts_user": counted("events", "user_id::VARCHAR", USER_MIN_COUNT),
        "field_counts_url": _with(_lines(), counted("fields", "f[5]", 0, not_empty)),
        "field_counts_frequent": _with(_lines(), counted("fields", "f[5]", URL_MIN_COUNT, not_empty)),
        "field_count_report": _with(
            _lines(), f"SELECT line AS value FROM ({counted('fields', 'f[2]', 0, not_empty)})"
        ),
        "sessions_of_files": _with(_file_sessions(), starts),
        "collapse_repeats": _with(_trail(REPEAT_BUCKETS), trail),
        "collapse_repeats_split": _with(_trail(REPEAT_BUCKETS), trail),
        "session_starts": _with(_sessions(), starts),
        "session_starts_split": _with(_sessions(), starts),
        "session_starts_stream": _with(
            _sessions(), f"{starts} WHERE ts_ms < (SELECT max(ts_ms) FROM log) - {STREAM_DELAY_S * 1000}"),
        "sessions": _with(_sessions(), sessions),
        "sessions_default_span": _with(_sessions(DEFAULT_SPAN_S), sessions),
        "sessions_seeded": _with(_sessions(seeds=SEEDS), sessions),
        "sessions_seed_table": _with(_sessions(seeds=SEEDS), sessions),
        "sessions_skewed": _with(_skewed(), sessions),
        "sessions_strict": _with(
            _sessions(), f"SELECT * FROM sessions WHERE session_id NOT IN ({invalid})"
        ),
        "sessions_split": _with(_sessions(), sessions),
        "distinct_session_refs": _with(_counts(), "SELECT * FROM single"),
        "first_session_refs_split": _with(_counts(), "SELECT * FROM single"),
        "refinement_counts": _with(_counts(), "SELECT * FROM ref_counts"),
        "top_refinements": _with(_counts(TOP_REFS), "SELECT * FROM top_refs"),
        "top_ref_session_rows": _with(_counts(TOP_REFS), "SELECT * FROM top_single"),
        "top_ref_click_rows": _with(_counts(TOP_REFS), "SELECT * FROM clicks"),
        "co_occurrences": _with(_counts(TOP_REFS), "SELECT * FROM pairs"),
        "co_occurrence_counts": _with(_counts(), "SELECT * FROM co_occ"),
        "symmetric_co_occ": _with(_counts(), "SELECT * FROM both_ways"),
        "doc_counts": _with(_counts(docs_of_top=False), "SELECT * FROM docs"),
        "top_docs": _with(_counts(docs_k=TOP_DOCS, docs_of_top=False), "SELECT * FROM docs"),
        "top_docs_default": _with(
            _counts(docs_k=DEFAULT_DOCS, docs_of_top=False), "SELECT * FROM docs"
        ),
        "top_docs_uncut": _with(_counts(docs_of_top=False), "SELECT * FROM docs"),
        "cluster_input_pairs": _with(
            _counts(), "SELECT * FROM co_occ WHERE query IN (SELECT query FROM docs)"
        ),
        "cluster_input_docs": _with(
            _counts(), "SELECT * FROM docs WHERE query IN (SELECT query FROM co_occ)"
        ),
        "row_normalise": _with(
            _counts(docs_of_top=False),
            """SELECT query, refinement, doc, count, round(count::DOUBLE / sum(count) OVER (
                   PARTITION BY query, refinement), 9) AS p FROM docs""",
        ),
        "transition_table": _with(_walk(), transitions),
        "absorption_vectors": _with(
            _similarity("max"), f"SELECT query, refinement, doc, {rounded.format('p')} FROM vectors"
        ),
        "ref_similarity_max": _with(_similarity("max"), similar),
        "ref_similarity_cosine": _with(_similarity("sum"), similar),
        "fused_similarity_max": _with(_similarity("max"), similar),
        "fused_similarity_cosine": _with(_similarity("sum"), similar),
        "cluster_ids": _with(_clusters(), "SELECT query, cluster_id, refinement FROM cluster_ids"),
        "clusters_singletons": _with(_singletons(), f"SELECT {cluster_columns} FROM clusters"),
        "clusters": _with(_clusters(), f"SELECT {cluster_columns} FROM clusters"),
        "clusters_in_parts": _with(_clusters(), f"SELECT {cluster_columns} FROM clusters"),
        "clusters_uneven": _with(_uneven(), "SELECT query, cluster_id, refinement FROM cluster_ids"),
        "clusters_cosine": _with(
            _clusters("sum", TOP_DOCS), f"SELECT {cluster_columns} FROM clusters"
        ),
        "suggestion_rows": _with(_suggestions(), f"SELECT {cluster_columns}, rank FROM ranked"),
        "suggestions_looked_up": _with(_suggestions(), f"SELECT {cluster_columns}, rank FROM ranked"),
        "suggestions": _with(
            _suggestions(),
            """SELECT query, string_agg(members, ';' ORDER BY best) AS suggestions
               FROM grouped GROUP BY query""",
        ),
        "suggestion_headlines": _with(
            _suggestions(),
            """SELECT query,
                      CAST(row_number() OVER (PARTITION BY query ORDER BY best) - 1 AS INTEGER)
                          AS position,
                      split_part(members, ',', 1) AS headline,
                      CASE WHEN strpos(members, ',') > 0
                           THEN substr(members, strpos(members, ',') + 1) ELSE '' END AS others
               FROM grouped""",
        ),
        "level_log_map": _with(
            _log(), f"SELECT {_tabs('user_id', 'ts_ms', 'query', 'doc')} AS value FROM log"
        ),
        "level_test": _with(_log(), "SELECT user_id::VARCHAR AS value FROM log"),
        "level_session_construction": _with(
            _sessions(), f"SELECT {session_line} AS value FROM sessions"
        ),
        "level_single_sessions": _with(
            _counts(),
            f"SELECT {session_line.replace('doc', chr(39) * 2)} AS value FROM single",
        ),
        "level_count_ref": _with(_counts(), f"SELECT {ref_line} AS value FROM ref_counts"),
        "level_top_count_ref": _with(_counts(), f"SELECT {ref_line} AS value FROM top_refs"),
        "level_cluster": _with(
            _clusters(),
            f"SELECT {_tabs('query', 'cluster_id', 'refinement')} AS value FROM cluster_ids",
        ),
        "level_whole": _with(_clusters(), f"SELECT {cluster_line} AS value FROM clusters"),
        "layout_co_occ": _with(
            _counts(),
            f"SELECT {_tabs('query', 'refinement', 'co_refinement', 'count')} AS value FROM co_occ",
        ),
        "layout_general": _with(
            _sessions(),
            f"SELECT {_tabs('session_id', 'query', 'refinement', 'count')} AS value FROM sessions",
        ),
        "roundtrip_sessions": _with(_sessions(), sessions),
        "roundtrip_clusters": _with(_singletons(), f"SELECT {cluster_columns} FROM clusters"),
        "roundtrip_parquet": _with(_counts(), "SELECT * FROM top_refs"),
        "roundtrip_suggestions": _with(_singletons(), f"SELECT {cluster_columns} FROM clusters"),
        "suggestions_replaced": _with(
            _singletons(),
            "SELECT query, cluster_id, refinement, CASE WHEN starts_with(query, 'click') THEN ref_count * 10 ELSE ref_count END AS ref_count FROM clusters",
        ),
        "suggestions_in_two_steps": _with(_singletons(), f"SELECT {cluster_columns} FROM clusters"),
    }
