"""SQL checks of the chunk plan: units cut, split and packed by recursion over rows, where the operator folds over arrays."""

from __future__ import annotations

from statuteloom.plans.text_queries import _LETTER, _REFS_OF_SECTION, norm
from statuteloom.plans.text_queries import ORACLES as TEXT

_OPENS = r"regexp_matches({0}, '(?i)^Illustrations?\b\.?\s*$|^Illustrations?\s*[.:—–-]')"
_IDS = "sec_id, grp, k, blk, item, number, in_force, kind, room"


def _words(c: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({c}, '[\s\p{{Z}}]+'), lambda w: w <> ''))"


def _lines(c: str) -> str:
    return f"list_filter(string_split({norm(c)}, chr(10)), lambda x: x <> '')"


def _once(c: str) -> str:
    """A list with each value once, in order."""
    return f"list_reduce(list_prepend([], list_transform(coalesce({c}, []), lambda r: [r])), lambda a, r: CASE WHEN list_contains(a, r[1]) THEN a ELSE list_concat(a, r) END)"


def _plan(budget: int) -> str:
    return rf"""
    WITH RECURSIVE head AS (
        SELECT h.sec_id, h.header, {_words("h.header")} AS used, {budget} - {_words("h.header")} AS room, coalesce(r.refs, []) AS refs
        FROM ({TEXT["headers"]}) h JOIN sections s USING (sec_id) LEFT JOIN {_REFS_OF_SECTION} r ON r.bns_section = s.section AND s.act = 'BNS'),
    cut AS (
        SELECT sec_id, {_lines("text")} AS p, 0 AS i, 1 AS nxt, -1 AS unit, CAST(NULL AS VARCHAR) AS number FROM sections WHERE text IS NOT NULL AND coalesce(len(subsections), 0) = 0
        UNION ALL
        SELECT sec_id, p, i + 1, nxt + s::INT, unit + (s OR unit < 0)::INT, CASE WHEN s THEN lab WHEN unit < 0 THEN NULL ELSE number END
        FROM (SELECT *, coalesce(TRY_CAST(nullif(lab, '') AS INT) = nxt, FALSE) AS s FROM (SELECT *, regexp_extract(p[i + 1], '^\(([0-9]{{1,3}})\)', 1) AS lab FROM cut WHERE i < len(p)))),
    subs AS (
        SELECT sec_id, unit AS k, number, TRUE AS in_force, list(p[i] ORDER BY i) AS p FROM cut WHERE i > 0 GROUP BY sec_id, unit, number
        UNION ALL
        SELECT sec_id, k, s.number, coalesce(s.in_force, TRUE), {_lines("s.text")} FROM (SELECT sec_id, unnest(subsections) AS s, generate_subscripts(subsections, 1) AS k FROM sections)),
    walk AS (
        SELECT sec_id, k, p, 0 AS i, 1 AS nxt, -1 AS blk, CAST(NULL AS VARCHAR) AS kind FROM subs
        UNION ALL
        SELECT sec_id, k, p, i + 1, nxt + clause::INT, blk + (opens OR resumes OR clause OR blk < 0)::INT,
               CASE WHEN opens THEN 'illustration' WHEN clause THEN 'clause' WHEN resumes OR blk < 0 THEN 'preamble' ELSE kind END
        FROM (SELECT *, (NOT opens AND kind = 'illustration' AND regexp_matches(line, '(?i)^(?:Explanation|Exception|Provided\b|\([0-9]{{1,3}}\)\s)')) IS TRUE AS resumes,
                     (NOT opens AND kind IS DISTINCT FROM 'illustration' AND {_LETTER.format("lab")} = nxt) IS TRUE AS clause
              FROM (SELECT *, p[i + 1] AS line, regexp_extract(p[i + 1], '^\(([a-z]{{1,3}})\)', 1) AS lab, {_OPENS.format("p[i + 1]")} AS opens FROM walk WHERE i < len(p)))),
    parts AS (SELECT sec_id, k, blk, kind, list(p[i] ORDER BY i) AS p FROM walk WHERE i > 0 GROUP BY sec_id, k, blk, kind),
    m AS (SELECT *, {_words("text")} AS n FROM (SELECT sec_id, k, array_to_string(flatten(list(p ORDER BY blk)), chr(10)) AS text FROM parts WHERE kind <> 'illustration' GROUP BY sec_id, k)
          JOIN (SELECT sec_id, k, number, in_force FROM subs) USING (sec_id, k)),
    whole AS (
        SELECT * FROM (SELECT sec_id, array_to_string(list(text ORDER BY k), chr(10)) AS text, list(number ORDER BY k) FILTER (number IS NOT NULL) AS subs, min_by(in_force, k) AS in_force, sum(n) AS n,
                              count(DISTINCT in_force) AS forces FROM m GROUP BY sec_id) JOIN head USING (sec_id) WHERE forces = 1 AND n <= room),
    items AS (
        SELECT sec_id, k, blk, CASE WHEN {_OPENS.format("p[1]")} THEN p[2:] ELSE p END AS p, 0 AS i, 1 AS nxt, 0 AS item FROM parts WHERE kind = 'illustration'
        UNION ALL
        SELECT sec_id, k, blk, p, i + 1, nxt + s::INT, item + (s OR item = 0)::INT
        FROM (SELECT *, ({_LETTER.format("lab")} = nxt) IS TRUE AS s FROM (SELECT *, regexp_extract(p[i + 1], '^\(([a-z]{{1,3}})\)', 1) AS lab FROM items WHERE i < len(p)))),
    raw AS (
        SELECT sec_id, 0 AS grp, k, 0 AS blk, 0 AS item, number, in_force, 'subsections' AS kind, room, text FROM m JOIN head USING (sec_id) WHERE n <= room
        UNION ALL SELECT sec_id, 0, k, blk, 0, number, in_force, 'clauses', room, array_to_string(p, chr(10)) FROM parts JOIN m USING (sec_id, k) JOIN head USING (sec_id) WHERE kind <> 'illustration' AND n > room
        UNION ALL SELECT sec_id, 1, k, blk, item, number, in_force, 'illustration', room - 1, text
            FROM (SELECT sec_id, k, blk, item, string_agg(p[i], chr(10) ORDER BY i) AS text FROM items WHERE i > 0 GROUP BY ALL) JOIN (SELECT sec_id, k, number, in_force FROM subs) USING (sec_id, k) JOIN head USING (sec_id)),
    paras AS (SELECT {_IDS}, unnest(a) AS t, generate_subscripts(a, 1) AS par FROM (
        SELECT *, CASE WHEN {_words("text")} <= room THEN [text] ELSE string_split(text, chr(10)) END AS a FROM raw WHERE grp = 1 OR sec_id NOT IN (SELECT sec_id FROM whole))),
    sens AS (SELECT {_IDS}, par, unnest(a) AS t, generate_subscripts(a, 1) AS sen FROM (
        SELECT *, CASE WHEN {_words("t")} <= room THEN [t] ELSE list_filter(string_split(regexp_replace(t, '([.;:])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') END AS a FROM paras)),
    half AS (
        SELECT {_IDS}, par, sen, string_split(t, ' ') AS w, 1 AS start_at, len(string_split(t, ' ')) AS n FROM sens
        UNION ALL
        SELECT {_IDS}, par, sen, w, start_at + right_half * (n // 2), CASE WHEN right_half = 1 THEN n - n // 2 ELSE n // 2 END FROM half, (VALUES (0), (1)) v(right_half) WHERE n > room AND n >= 2),
    units AS (SELECT *, {_words("text")} AS n FROM (SELECT sec_id, grp, number, in_force, kind, array_to_string(w[start_at : start_at + n - 1], ' ') AS text,
        row_number() OVER (PARTITION BY sec_id, grp ORDER BY k, blk, item, par, sen, start_at) AS i FROM half WHERE n <= room OR n < 2)),
    pack AS (
        SELECT sec_id, grp, i, 1 AS chunk, in_force, kind, used, used + grp + n AS tokens FROM units JOIN head USING (sec_id) WHERE i = 1
        UNION ALL
        SELECT sec_id, grp, i, chunk + (NOT j)::INT, in_force, kind, used, CASE WHEN j THEN tokens + n ELSE used + grp + n END
        FROM (SELECT u.sec_id, u.grp, u.i, u.n, u.in_force, u.kind, chunk, used, tokens, u.in_force = q.in_force AND u.kind = q.kind AND tokens + u.n <= {budget} AS j
              FROM pack q JOIN units u ON u.sec_id = q.sec_id AND u.grp = q.grp AND u.i = q.i + 1)),
    made AS (
        SELECT sec_id, 0 AS grp, 1 AS chunk, 'section' AS kind, in_force, used + n AS tokens, subs, text AS body FROM whole
        UNION ALL
        SELECT sec_id, grp, chunk, u.kind, u.in_force, max(tokens), list(number ORDER BY i) FILTER (number IS NOT NULL), CASE grp WHEN 1 THEN 'Illustrations' || chr(10) ELSE '' END || string_agg(text, chr(10) ORDER BY i)
        FROM pack JOIN units u USING (sec_id, grp, i) GROUP BY sec_id, grp, chunk, u.kind, u.in_force),
    planned AS (
        SELECT sec_id AS key, concat(act, '-', section, '-c', row_number() OVER (PARTITION BY sec_id ORDER BY grp, chunk)) AS chunk_id, act, section, {_once("subs")} AS subsections, made.kind AS chunk_type,
               refs AS old_refs, made.in_force AS in_force, CAST(tokens AS INT) AS tokens, page_start AS page, header, header || chr(10) || body AS text, tokens > {budget} AS over_budget
        FROM made JOIN head USING (sec_id) JOIN (SELECT sec_id, act, section, page_start FROM sections) USING (sec_id))"""


ORACLES = {
    "chunk_plan": f"{_plan(60)} SELECT * FROM planned",
    "chunk_stats": f"""{_plan(60)},
        placed AS (SELECT act, tokens, row_number() OVER (PARTITION BY act ORDER BY tokens) - 1 AS place, count(*) OVER (PARTITION BY act) AS n FROM planned)
        SELECT act, count(*) AS n_chunks, count(DISTINCT key) AS n_sections, max(tokens) AS max_tokens, round_even(avg(tokens), 1) AS mean_tokens, count(*) FILTER (over_budget) AS over_budget,
               (SELECT min(tokens) FROM placed p WHERE p.act = c.act AND place = least(n - 1, floor(0.5 * n))) AS p50, (SELECT min(tokens) FROM placed p WHERE p.act = c.act AND place = least(n - 1, floor(0.95 * n))) AS p95
        FROM planned c GROUP BY act""",
    "chunk_histogram": f"{_plan(350)} SELECT concat(low, '-', low + 49) AS label, count(*) AS n FROM (SELECT tokens // 50 * 50 AS low FROM planned) GROUP BY low",
}
