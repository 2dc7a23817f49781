"""SQL for the queries that SQL can express, written for another engine."""

from __future__ import annotations

URL_FILTERS = r"""
WITH captures AS (
    SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS fetched_on,
           NULLIF(regexp_replace(regexp_replace(lower(regexp_replace(
               regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', '')), ':[0-9]*$', ''),
               '\.$', ''), '') AS host,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
listed AS (
    SELECT CASE page_id % 3
               WHEN 0 THEN 'host:' || host
               WHEN 1 THEN 'domain:' || regexp_replace(host, '^[^.]*\.', '')
               ELSE CASE WHEN regexp_extract(path, '^(/[^/]*/)', 1) <> ''
                         THEN 'path:' || host || regexp_extract(path, '^(/[^/]*/)', 1) END
           END AS key,
           CASE WHEN length(url) % 3 = 0 THEN 'block' ELSE 'release' END AS action,
           DATE '2024-01-01' + CAST(page_id * 53 % 365 AS INTEGER) AS day
    FROM captures
),
daily AS (
    SELECT key, day, min(action) AS action FROM listed WHERE key IS NOT NULL AND action IS NOT NULL GROUP BY key, day
),
intervals AS (
    SELECT key, action, day AS valid_from, lead(day) OVER (PARTITION BY key ORDER BY day) AS valid_to FROM daily
),
keyed AS (
    SELECT page_id, fetched_on, 'host:' || host AS key FROM captures
    UNION ALL
    SELECT page_id, fetched_on, 'domain:' || array_to_string(labels[i:], '.')
    FROM (SELECT page_id, fetched_on, string_split(host, '.') AS labels,
                 unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM captures)
    UNION ALL
    SELECT page_id, fetched_on, 'path:' || host || array_to_string(folders[:i], '/') || '/'
    FROM (SELECT page_id, fetched_on, host, string_split(path, '/') AS folders,
                 unnest(range(1, len(string_split(path, '/')))) AS i FROM captures)
),
hits AS (
    SELECT k.page_id, k.key, v.action
    FROM keyed k JOIN intervals v ON k.key = v.key AND v.valid_from <= k.fetched_on
     AND (v.valid_to IS NULL OR k.fetched_on < v.valid_to)
),
best AS (
    SELECT page_id, key AS rule FROM hits WHERE action = 'block'
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(key) DESC, key) = 1
)
SELECT c.page_id, c.host, c.fetched_on,
       (SELECT count(*) FROM hits h WHERE h.page_id = c.page_id) AS n_entries,
       b.rule IS NOT NULL AS blocked, b.rule
FROM captures c LEFT JOIN best b ON b.page_id = c.page_id
"""

WARC = """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
kept AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS stored
    FROM sized
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN stored IS NULL OR page_id IS NOT DISTINCT FROM stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM stored THEN stored END AS refers_to
FROM kept
"""

HARD_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
           CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
    FROM usable a JOIN usable c ON a.vec_id <> c.vec_id
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 5
"""

MULTI_INDEX = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS one, b.vec_id AS two FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
),
reach AS (
    SELECT vec_id AS one, vec_id AS two FROM embeddings
    UNION
    SELECT r.one, l.two FROM reach r JOIN links l ON r.two = l.one
),
least AS (SELECT one, min(two) AS component_id FROM reach GROUP BY one),
counts AS (SELECT one, count(*) AS n_links FROM links GROUP BY one)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.one = e.vec_id LEFT JOIN counts c ON c.one = e.vec_id
"""


def mixing(mix, domains: dict[str, list[str]], other: str) -> str:
    """The whole mix over documents: budgets level by level, then one window per leaf."""
    domain = " ".join(
        f"WHEN source IN ({', '.join(repr(s) for s in sources)}) THEN '{name}'" for name, sources in domains.items()
    )
    levels = ", ".join(mix.levels)
    parts = [
        f"""docs AS (
    SELECT doc_id, CASE {domain} ELSE '{other}' END AS domain, lang, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
    FROM documents
)""",
        f"""leaves AS (
    SELECT {levels}, sum(n_tokens)::HUGEINT AS supply, sum(n_tokens)::HUGEINT * {mix.max_epochs} AS cap
    FROM docs GROUP BY ALL
)""",
        f"""budgets0 AS (
    SELECT least(sum(supply) * {mix.budget_percent} // 100, sum(supply) * {mix.max_epochs})::HUGEINT AS budget FROM leaves
)""",
    ]
    for depth, level in enumerate(mix.levels, 1):
        path, parents = list(mix.levels[:depth]), list(mix.levels[: depth - 1])
        weight = " ".join(
            "WHEN " + " AND ".join(f"n.{n} = '{v}'" for n, v in zip(mix.levels, p)) + f" THEN {w}"
            for p, w in mix.weights.items()
            if len(p) == depth
        )
        weight = f"CASE {weight} ELSE {mix.default_weight} END" if weight else str(mix.default_weight)
        same = " AND ".join(f"n.{p} IS NOT DISTINCT FROM b.{p}" for p in parents) or "TRUE"
        family = "PARTITION BY " + (", ".join(parents) or "1")
        own = ", ".join(path)
        parts += [
            f"""nodes{depth} AS (
    SELECT n.*, b.budget, ({weight})::HUGEINT AS weight
    FROM (SELECT {own}, sum(cap)::HUGEINT AS cap FROM leaves GROUP BY ALL) n JOIN budgets{depth - 1} b ON {same}
)""",
            f"""filled{depth} AS (
    SELECT *, sum(cap) OVER w * weight + cap * (sum(weight) OVER ({family}) - sum(weight) OVER w) <= budget * weight AS is_full
    FROM nodes{depth}
    WINDOW w AS ({family} ORDER BY cap::DOUBLE / weight::DOUBLE, {level} NULLS FIRST ROWS UNBOUNDED PRECEDING)
)""",
            f"""claims{depth} AS (
    SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({family}) AS full_cap,
           sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS open_weight FROM filled{depth}
)""",
            f"""shares{depth} AS (
    SELECT *, CASE WHEN is_full THEN cap ELSE weight * (budget - full_cap) // open_weight END AS share,
           CASE WHEN is_full THEN -1 ELSE weight * (budget - full_cap) % open_weight END AS remainder FROM claims{depth}
)""",
            f"""budgets{depth} AS (
    SELECT {own}, (share + CASE WHEN NOT is_full
        AND row_number() OVER ({family} ORDER BY remainder DESC, {level} NULLS FIRST) <= budget - sum(share) OVER ({family})
        THEN 1 ELSE 0 END)::HUGEINT AS budget
    FROM shares{depth}
)""",
        ]
    on = " AND ".join(f"l.{c} IS NOT DISTINCT FROM b.{c}" for c in mix.levels)
    on_docs = " AND ".join(f"d.{c} IS NOT DISTINCT FROM p.{c}" for c in mix.levels)
    parts += [
        f"""plans AS (
    SELECT l.*, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS passes,
           CASE WHEN supply > 0 THEN budget % supply ELSE -1 END AS rest
    FROM leaves l JOIN budgets{len(mix.levels)} b ON {on}
)""",
        f"""keyed AS (
    SELECT d.*, p.passes, p.rest,
           ('0x' || substr(md5('{mix.seed}|' || p.passes || '|' || coalesce(d.doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
    FROM docs d JOIN plans p ON {on_docs}
)""",
        f"""placed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY {levels} ORDER BY place, doc_id NULLS FIRST) AS upto FROM keyed
)""",
    ]
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT doc_id, {levels}, n_tokens, (passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM placed WHERE passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""
    )
