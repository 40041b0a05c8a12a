"""DuckDB SQL for the registered queries, written apart from the Spark plans: plain joins
and recursion where those use windows, buckets and folds."""

from __future__ import annotations

import re

from cuelake import schema
from cuelake.functions import linebreak, spoken
from cuelake.functions.text import INVERSION, TRIVIAL_REPLIES
from cuelake.plans.adapters import SQL as BASE


def _list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _lstrip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+', '')"


def _rstrip(x: str) -> str:
    return rf"regexp_replace({x}, '\s+$', '')"


def _vis(x: str) -> str:
    return f"(length({x}) - 2 * (length({x}) - length(replace({x}, '...', ''))) // 3)"


def _chars(x: str) -> str:
    return _vis(f"replace({x}, chr(10), '')")


def _dual(x: str) -> str:
    return rf"(CASE WHEN {x} LIKE '%' || chr(10) || '%' THEN {_lstrip(f'string_split({x}, chr(10))[2]')} LIKE '-%' ELSE regexp_matches({x}, '\s+-\s+') END)"


def _undash(x: str) -> str:
    return rf"regexp_replace({x}, '^-\s?', '')"


def _words(x: str) -> str:
    return rf"list_filter(string_split(regexp_replace({x}, '\s+', ' ', 'g'), ' '), lambda q: q <> '')"


def _fill(words: str) -> str:
    """Greedy lines of 42."""
    return f"coalesce(list_reduce({words}, lambda a, b: CASE WHEN length(string_split(a, chr(10))[-1]) + 1 + length(b) <= 42 THEN a || ' ' || b ELSE a || chr(10) || b END), '')"


def _wrap(x: str) -> str:
    w = _words(x)
    return f"(CASE WHEN coalesce(list_max(list_transform({w}, lambda q: length(q))), 0) <= 42 AND len(string_split({_fill(w)}, chr(10))) <= 2 THEN {_fill(w)} END)"


def _code(ms: str) -> str:
    return f"printf('%02d:%02d:%02d,%03d', greatest({ms}, 0) // 3600000, greatest({ms}, 0) // 60000 % 60, greatest({ms}, 0) // 1000 % 60, greatest({ms}, 0) % 1000)"


def _values(rows: list[tuple]) -> str:
    def one(v) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"

    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


_NL25 = schema.limits("nl", 25)
_GENRES = f"genres({', '.join(c.split()[0] for c in schema.GENRE_SCHEMA.split(', '))}) AS (VALUES {_values(schema.GENRES)})"
_FIX1 = "replace(replace(replace(text, '!', '.'), ';', '.'), '…', '...')"

# text -> lines broken at 42
_LENGTH = rf"""
{{out}} AS (
  SELECT * EXCLUDE (body, dashed, w, g, k), CASE WHEN {{src}} NOT LIKE '%' || chr(10) || '%' AND {_vis(_undash('{src}'))} > 42 AND {_vis('body')} > 42 THEN
      CASE WHEN trim(dashed || array_to_string(w[1:k], ' ')) <> '' AND dashed || array_to_string(w[1:k], ' ') <> dashed THEN
          dashed || array_to_string(w[1:k], ' ') || CASE WHEN k < len(w) AND trim(array_to_string(w[k + 1:], ' ')) <> '' THEN chr(10) || array_to_string(w[k + 1:], ' ') ELSE '' END
      ELSE array_to_string(w[k + 1:], ' ') END ELSE {{src}} END AS fixed
  FROM (SELECT *, CASE WHEN g < len(w) AND {_vis("array_to_string(w[1:g], ' ')")} > {_vis("array_to_string(w[g + 1:], ' ')")} THEN list_max(list_filter(range(0, g + 1), lambda j: j = 0 OR length(array_to_string(w[1:j], ' ')) <= length(array_to_string(w[j + 1:], ' ')))) ELSE g END AS k
    FROM (SELECT *, len(list_filter(range(1, len(w) + 1), lambda j: length(array_to_string(w[1:j], ' ')) <= 42)) AS g
      FROM (SELECT *, string_split(body, ' ') AS w FROM (SELECT *, CASE WHEN {{src}} LIKE '-%' THEN ltrim({{src}}[2:], ' ') ELSE {{src}} END AS body, CASE WHEN {{src}} LIKE '-%' THEN '-' ELSE '' END AS dashed FROM {{inp}}))))
)"""


def _dash(x: str) -> str:
    a, b = f"string_split({x}, chr(10))[1]", f"string_split({x}, chr(10))[2]"
    bare = "ltrim(ltrim({0}, '-'), ' ')"
    return f"(CASE WHEN len(string_split({x}, chr(10))) = 2 AND {_strip(b)} LIKE '-%' THEN CASE WHEN {a} LIKE '-%' THEN {bare.format(a)} ELSE {a} END || chr(10) || '-' || {bare.format(b)} ELSE {x} END)"


_SWAPPED = "swapped AS (SELECT title_id, pos, idx, CASE WHEN pos % 10 = 3 THEN start_ms - 4000 ELSE start_ms END AS start_ms, end_ms, text FROM cues)"

_FIXED = ",\n".join(
    [
        _SWAPPED,
        f"placed AS (SELECT title_id, old, idx, start_ms, end_ms, text, {_FIX1} AS t1, row_number() OVER (PARTITION BY title_id ORDER BY start_ms, old) AS pos FROM (SELECT *, row_number() OVER (PARTITION BY title_id ORDER BY pos) AS old FROM swapped WHERE {_strip('text')} <> ''))",
        _LENGTH.format(src="t1", inp="placed", out="lengthened").strip(),
        f"""timed_fix AS (SELECT *, lead(start_ms) OVER (PARTITION BY title_id ORDER BY pos) AS nxt FROM lengthened),
fixed_srt AS (
  SELECT title_id, pos, pos::INT AS idx, idx AS old_idx, start_ms, CASE WHEN nxt - end_ms < 120 AND greatest(0, nxt - 120) > start_ms THEN greatest(0, nxt - 120) ELSE end_ms END AS end_ms,
         {_dash('fixed')} AS text, text AS original_text, old <> pos AS moved, coalesce(nxt - end_ms < 120 AND greatest(0, nxt - 120) <= start_ms, false) AS unfixable FROM timed_fix
)""",
    ]
)


def _rule(code: str, severity: str, when: str, value: str = "0", line: str = "0", source: str = "r") -> str:
    return f"SELECT title_id, pos, idx, '{code}' AS code, '{severity}' AS severity, {line} AS line_no, ({value})::BIGINT AS value FROM {source} WHERE {when}"


def _rules() -> str:
    start, end = _lstrip("text"), _rstrip("pt")
    s_dots = f"({start} LIKE '...%' OR {start} LIKE '…%')"
    e_dots = f"({end} LIKE '%...' OR {end} LIKE '%…')"
    first = f"substr({start}, 1, 1)"
    long_pair = "cc <> '' AND pc <> '' AND cc <> pc AND length(cc) >= 15 AND length(pc) >= 15"
    parts = [
        _rule("empty", "error", "blank", source="p"),
        _rule("line_count", "error", "n > 2", "n"),
        _rule("cps_hard", "error", "dur > 0 AND ch * 1000 > 20 * dur", "ch * 1000000000 // dur"),
        _rule("cps_soft", "warning", "dur > 0 AND ch * 1000 > 17 * dur AND ch * 1000 <= 20 * dur", "ch * 1000000000 // dur"),
        _rule("duration_short", "warning", "dur < 840", "dur"),
        _rule("duration_long", "warning", "dur > 8000", "dur"),
        _rule("duration_invalid", "error", "dur <= 0", "dur"),
        _rule("overlap", "error", "gap < 0", "-gap"),
        _rule("gap_short", "warning", "gap >= 0 AND gap < 120", "gap"),
        _rule("order", "error", "start_ms < ps"),
        _rule("exclamation", "warning", "text LIKE '%!%'"),
        _rule("semicolon", "error", "text LIKE '%;%'"),
        _rule("smart_ellipsis", "warning", "text LIKE '%…%'"),
        _rule("ellipsis_open", "warning", f"{e_dots} AND NOT ({s_dots} OR (upper({first}) = {first} AND lower({first}) <> {first}) OR {first} = '-')"),
        _rule("ellipsis_lone", "warning", f"pt IS NOT NULL AND {s_dots} AND NOT {e_dots}"),
        _rule("first_dash", "warning", f"n = 2 AND {_strip('ls[1]')} LIKE '-%'"),
        _rule("duplicate", "error", "cc <> '' AND pc <> '' AND cc = pc"),
        _rule("inside_previous", "error", f"{long_pair} AND contains(pc, cc)"),
        _rule("contains_previous", "error", f"{long_pair} AND NOT contains(pc, cc) AND contains(cc, pc)"),
        _rule("line_length", "error", f"{_vis(_undash('l'))} > 42", _vis(_undash("l")), "i", "lined"),
        _rule("orphan_word", "warning", f"n > 1 AND length({_strip(_undash('l'))}) BETWEEN 1 AND 5 AND {_strip(_undash('l'))} NOT LIKE '% %'", f"length({_strip(_undash('l'))})", "i", "lined"),
        "SELECT title_id, pos, idx, 'sequence', 'warning', 0, k FROM (SELECT *, row_number() OVER (PARTITION BY title_id ORDER BY pos) AS f FROM (SELECT title_id, pos, idx, row_number() OVER (PARTITION BY title_id ORDER BY pos) AS k FROM swapped) WHERE idx <> k) WHERE f = 1",
    ]
    return (
        f"""{_SWAPPED}, p AS (
  SELECT *, {_strip('text')} = '' AS blank, end_ms - start_ms AS dur, start_ms - pe AS gap, {_chars('text')} AS ch, string_split(text, chr(10)) AS ls, len(string_split(text, chr(10))) AS n,
         regexp_replace(lower(text), '[.\\s]', '', 'g') AS cc, regexp_replace(lower(pt), '[.\\s]', '', 'g') AS pc
  FROM (SELECT *, lag(start_ms) OVER w AS ps, lag(end_ms) OVER w AS pe, lag(text) OVER w AS pt FROM swapped WINDOW w AS (PARTITION BY title_id ORDER BY pos))
), r AS (SELECT * FROM p WHERE NOT blank), lined AS (SELECT *, ls[i] AS l FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM r)), rules AS (
"""
        + "\nUNION ALL ".join(parts)
        + ")"
    )


_NEAR = """{out} AS (
  SELECT x.*, CASE WHEN b.t IS NULL OR a.t - x.{at} < x.{at} - b.t THEN a.t ELSE b.t END AS near FROM {src} x
  ASOF LEFT JOIN (SELECT DISTINCT {key}, {moment} AS t FROM {points}) b ON x.{key} = b.{key} AND x.{at} >= b.t
  ASOF LEFT JOIN (SELECT DISTINCT {key}, {moment} AS t FROM {points}) a ON x.{key} = a.{key} AND x.{at} <= a.t
)"""


def _near(out: str, src: str, points: str, at: str, moment: str, key: str = "title_id") -> str:
    return _NEAR.format(out=out, src=src, points=points, at=at, moment=moment, key=key)


# merging: one step for each cue of a title
_SC = "(m.mk = 'SC')"
_L = r"regexp_replace(" + r"trim(regexp_replace(g.txt, '\s+', ' ', 'g'))" + r", '\s*\.\.\.$', '')"
_R = r"regexp_replace(" + r"trim(regexp_replace(m.clean, '\s+', ' ', 'g'))" + r", '^\.\.\.\s*', '')"
_DUALTEXT = f"({_strip('g.txt')} || chr(10) || '-' || regexp_replace({_strip('m.clean')}, '^- *', ''))"
_JOIN = f"""CASE WHEN m.start_ms - g.last_end > 1000 OR m.end_ms - g.first_start > 7000 OR m.mk = 'NM' OR ({_SC} AND g.n > 1) THEN NULL
  WHEN {_SC} THEN CASE WHEN len(string_split({_DUALTEXT}, chr(10))) <= 2 AND list_max(list_transform(string_split({_DUALTEXT}, chr(10)), lambda q: {_vis('q')})) <= 42 THEN {_DUALTEXT} END
  WHEN {_dual('g.txt')} OR {_dual('m.clean')} THEN NULL ELSE {_wrap(f"{_L} || ' ' || {_R}")} END"""
_MERGED = rf"""m AS (
  SELECT title_id, row_number() OVER (PARTITION BY title_id ORDER BY pos) AS k, idx, start_ms, end_ms, regexp_extract(text, '^\s*\[(SC|NM)\]', 1) AS mk, regexp_replace(text, '^\s*\[(SC|NM)\]\s*', '') AS clean FROM marked
), g AS (
  SELECT title_id, k, 1 AS grp, start_ms AS first_start, end_ms AS last_end, clean AS txt, 1 AS n, idx::VARCHAR AS src, 0::BIGINT AS gap FROM m WHERE k = 1
  UNION ALL
  SELECT title_id, k, CASE WHEN t IS NULL THEN grp + 1 ELSE grp END, CASE WHEN t IS NULL THEN start_ms ELSE first_start END, end_ms, coalesce(t, clean), CASE WHEN t IS NULL THEN 1 ELSE n + 1 END,
         CASE WHEN t IS NULL THEN idx::VARCHAR ELSE src || ',' || idx END, CASE WHEN t IS NULL THEN 0 WHEN n = 1 THEN start_ms - last_end ELSE gap END
  FROM (SELECT m.title_id, m.k, m.idx, m.start_ms, m.end_ms, m.clean, g.grp, g.first_start, g.last_end, g.n, g.src, g.gap, {_JOIN} AS t FROM g JOIN m ON m.title_id = g.title_id AND m.k = g.k + 1)
), merged AS (
  SELECT title_id, grp::INT AS idx, first_start AS start_ms, last_end AS end_ms, txt AS text, n::INT AS source_count, src AS sources, gap AS gap_ms, last_end - first_start AS combined_duration_ms
  FROM (SELECT *, row_number() OVER (PARTITION BY title_id, grp ORDER BY k DESC) AS r FROM g) WHERE r = 1
)"""

_PROX = """prox AS (
  SELECT n.title_id, n.pos AS nl_pos, e.pos AS en_pos FROM nl n JOIN en e ON n.title_id = e.title_id AND e.start_ms BETWEEN n.start_ms - 500 AND n.end_ms + 500
)"""  # the fallback never applies: ends aren't before starts here

_DRAFTS = """near_en AS (
  SELECT n.title_id, n.pos AS nl_pos, arg_min(e.pos, (abs(e.start_ms - n.start_ms), e.pos)) AS en_pos, min(abs(e.start_ms - n.start_ms)) AS dist FROM nl n JOIN en e ON n.title_id = e.title_id GROUP BY 1, 2
), band AS (
  SELECT n.title_id, n.pos AS nl_pos, e.pos AS en_pos FROM nl n JOIN en e ON n.title_id = e.title_id AND abs(e.start_ms - n.start_ms) <= 500
), drafted AS (
  SELECT * FROM band UNION ALL SELECT title_id, nl_pos, en_pos FROM near_en x WHERE dist <= 1000 AND NOT EXISTS (SELECT 1 FROM band b WHERE b.title_id = x.title_id AND b.nl_pos = x.nl_pos)
), draft_rows AS (
  SELECT n.title_id, n.pos AS nl_pos, n.start_ms AS nl_start_ms, n.end_ms AS nl_end_ms, coalesce(string_agg(e.idx::VARCHAR, ',' ORDER BY e.pos), '') AS en_indices, arg_min(e.start_ms, e.pos) AS en_start_ms, arg_max(e.end_ms, e.pos) AS en_end_ms
  FROM nl n LEFT JOIN drafted x ON n.title_id = x.title_id AND n.pos = x.nl_pos LEFT JOIN en e ON x.title_id = e.title_id AND x.en_pos = e.pos GROUP BY 1, 2, 3, 4
)"""

_ENHANCED = f"""{_PROX}, {_DRAFTS}, reports AS (
  SELECT title_id, pos AS entry, start_ms + pos % 40 AS out_start, CASE WHEN nxt IS NULL OR pos % 4 <> 0 THEN [] ELSE [{{'s': start_ms, 'e': end_ms}}, {{'s': nxt, 'e': nxt_end}}] END AS tcs
  FROM (SELECT *, lead(start_ms) OVER w AS nxt, lead(end_ms) OVER w AS nxt_end FROM nl WINDOW w AS (PARTITION BY title_id ORDER BY pos))
), report_map AS (
  SELECT title_id, out_start, min(entry) AS entry, arg_max(tcs, entry) AS tcs FROM reports GROUP BY 1, 2
), draft_map AS (
  SELECT title_id, nl_start_ms, min(nl_pos) AS entry, arg_max(en_start_ms, nl_pos) AS a, arg_max(en_end_ms, nl_pos) AS b FROM draft_rows WHERE nl_pos % 3 <> 0 AND en_start_ms IS NOT NULL GROUP BY 1, 2
), hit AS (
  SELECT n.title_id, n.pos AS nl_pos, arg_min(r.tcs, r.entry) AS tcs FROM nl n JOIN report_map r ON n.title_id = r.title_id AND abs(n.start_ms - r.out_start) <= 50 GROUP BY 1, 2 HAVING len(arg_min(r.tcs, r.entry)) > 0
), win AS (
  SELECT title_id, nl_pos, w, tcs[w].s AS s, tcs[w].e AS e FROM (SELECT *, unnest(range(1, len(tcs) + 1)) AS w FROM hit)
), win_draft AS (
  SELECT x.title_id, nl_pos, w, arg_min(a, entry) AS a, arg_min(b, entry) AS b FROM win x JOIN draft_map d ON x.title_id = d.title_id AND abs(x.s - d.nl_start_ms) <= 50 GROUP BY 1, 2, 3
), win_hit AS (
  SELECT x.title_id, nl_pos, w, e.pos AS en_pos FROM win_draft x JOIN en e ON x.title_id = e.title_id AND e.start_ms BETWEEN a - 50 AND b + 50
), win_all AS (
  SELECT * FROM win_hit UNION ALL
  SELECT x.title_id, nl_pos, w, e.pos FROM win x JOIN en e ON x.title_id = e.title_id AND e.start_ms BETWEEN x.s - 500 AND x.e + 500 WHERE NOT EXISTS (SELECT 1 FROM win_hit h WHERE h.title_id = x.title_id AND h.nl_pos = x.nl_pos AND h.w = x.w)
), plain_hit AS (
  SELECT DISTINCT x.title_id, nl_pos, e.pos AS en_pos FROM (
    SELECT n.title_id, n.pos AS nl_pos, arg_min(a, entry) AS a, arg_min(b, entry) AS b FROM nl n JOIN draft_map d ON n.title_id = d.title_id AND abs(n.start_ms - d.nl_start_ms) <= 50
    WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.title_id = n.title_id AND h.nl_pos = n.pos) GROUP BY 1, 2) x JOIN en e ON x.title_id = e.title_id AND e.start_ms BETWEEN a - 50 AND b + 50
), enhanced AS (
  SELECT DISTINCT title_id, nl_pos, en_pos, 'merge' AS strategy FROM win_all
  UNION ALL SELECT h.title_id, h.nl_pos, x.en_pos, 'nearest' FROM hit h JOIN near_en x ON h.title_id = x.title_id AND h.nl_pos = x.nl_pos WHERE dist <= 500 AND NOT EXISTS (SELECT 1 FROM win_all w WHERE w.title_id = h.title_id AND w.nl_pos = h.nl_pos)
  UNION ALL SELECT *, 'draft' FROM plain_hit
  UNION ALL SELECT *, 'proximity' FROM prox p WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.title_id = p.title_id AND h.nl_pos = p.nl_pos) AND NOT EXISTS (SELECT 1 FROM plain_hit h WHERE h.title_id = p.title_id AND h.nl_pos = p.nl_pos)
)"""

_CARDS = f"""fx AS (
  SELECT title_id, pos, start_ms + (pos * 131) % 2600 AS start_ms, start_ms + (pos * 131) % 2600 + (pos * 67) % 1500 AS end_ms, text FROM en
), cards AS (
  SELECT * FROM fx f WHERE end_ms - start_ms >= 400 AND {_strip('text')} <> '' AND NOT EXISTS (SELECT 1 FROM en e WHERE e.title_id = f.title_id AND abs(e.start_ms - f.start_ms) <= 1500)
)"""

_SPEECH = """speech_runs AS (
  SELECT title_id, is_speech, min(frame_idx) AS a, max(frame_idx) + 1 AS b FROM (SELECT *, frame_idx - row_number() OVER (PARTITION BY title_id, is_speech ORDER BY frame_idx) AS island FROM frames) GROUP BY title_id, is_speech, island
), ends AS (
  SELECT title_id, min(a) FILTER (WHERE is_speech) AS lo, max(b) FILTER (WHERE is_speech) AS hi FROM speech_runs GROUP BY 1
), bridged AS (
  SELECT r.title_id, a, b, is_speech OR (b - a <= 7 AND a >= lo AND b <= hi) AS is_speech FROM speech_runs r JOIN ends e ON r.title_id = e.title_id
), smoothed AS (
  SELECT title_id, is_speech, min(a) AS first_frame, max(b) AS end_frame FROM (
    SELECT *, sum(new) OVER (PARTITION BY title_id ORDER BY a) AS g FROM (SELECT *, CASE WHEN is_speech = lag(is_speech) OVER (PARTITION BY title_id ORDER BY a) THEN 0 ELSE 1 END AS new FROM bridged)) GROUP BY title_id, is_speech, g
), segs AS (
  SELECT title_id, row_number() OVER (PARTITION BY title_id ORDER BY first_frame) AS seg_no, first_frame * 30 AS start_ms, end_frame * 30 AS end_ms FROM smoothed WHERE is_speech
)"""

_TRIM = f"""own AS (SELECT title_id, pos, idx, start_ms, end_ms, {_chars('text')} AS ch, lead(start_ms) OVER (PARTITION BY title_id ORDER BY pos) - 120 AS latest FROM en),
{_near('found', 'own', 'segs', 'end_ms', 'end_ms')}, dec AS (
  SELECT *, CASE WHEN abs(near - end_ms) <= 2000 THEN near END AS se, least(near + 250, coalesce(latest, near + 250)) AS want, start_ms + ch * 1000 // 17 AS target, least(start_ms + ch * 1000 // 17, coalesce(latest, start_ms + ch * 1000 // 17)) AS part FROM found
), trims AS (
  SELECT title_id, pos, idx, end_ms AS old_end_ms, reason, CASE WHEN reason IS NULL THEN CASE WHEN ch * 1000 <= 17 * (want - start_ms) THEN want ELSE part END END AS new_end_ms, CASE WHEN reason IS NULL THEN CASE WHEN ch * 1000 <= 17 * (want - start_ms) THEN 'full' ELSE 'partial' END END AS method
  FROM (SELECT *, CASE WHEN se IS NULL THEN 'no_transition' WHEN se > end_ms THEN 'speech_extends_past_cue' WHEN end_ms - se < 400 THEN 'below_min_trim' WHEN se + 250 >= end_ms THEN 'buffer_exceeds_current_end'
    WHEN se + 250 - start_ms < 840 THEN 'min_duration' WHEN want - start_ms < 840 THEN 'min_duration_after_gap_clamp' WHEN ch * 1000 <= 17 * (want - start_ms) THEN NULL
    WHEN target >= end_ms THEN CASE WHEN ch * 1000 > 20 * (want - start_ms) THEN 'cps_hard_limit' ELSE 'cps_soft_ceiling' END WHEN end_ms - target < 400 THEN 'partial_trim_too_small' WHEN part - start_ms < 840 THEN 'min_duration_partial' END AS reason FROM dec)
), decisions AS (
  SELECT title_id, pos, idx, old_end_ms, CASE method WHEN 'full' THEN 'trim' WHEN 'partial' THEN 'partial_trim' ELSE 'skip' END AS action, reason, new_end_ms, coalesce(old_end_ms - new_end_ms, 0) AS trim_ms, method FROM trims
)"""

_ANALYZED = f"""{_PROX}, {_SPEECH}, src AS (
  SELECT p.title_id, p.nl_pos AS pos, arg_min(e.start_ms, e.pos) AS en_start, arg_max(e.end_ms, e.pos) AS en_end FROM prox p JOIN en e ON p.title_id = e.title_id AND p.en_pos = e.pos GROUP BY 1, 2
), nlw AS (SELECT *, lag(end_ms) OVER w AS prev_end, lead(start_ms) OVER w AS next_start FROM nl WINDOW w AS (PARTITION BY title_id ORDER BY pos)),
{_near('n1', 'nlw', 'segs', 'end_ms', 'end_ms')}, n1b AS (SELECT * EXCLUDE (near), CASE WHEN abs(near - end_ms) <= 2000 THEN near END AS speech_end FROM n1),
{_near('n2', 'n1b', 'segs', 'start_ms', 'start_ms')}, an AS (
  SELECT n.title_id, n.pos, n.idx, n.start_ms AS nl_start, n.end_ms AS nl_end, en_start, en_end, speech_end, CASE WHEN abs(near - n.start_ms) <= 2000 THEN near END AS speech_start, speech_end - n.end_ms AS end_delta_ms,
         CASE WHEN abs(near - n.start_ms) <= 2000 THEN near END - n.start_ms AS start_delta_ms, CASE WHEN en_end <> 0 THEN n.end_ms - en_end END AS nl_end_vs_en, prev_end, next_start
  FROM n2 n LEFT JOIN src s ON n.title_id = s.title_id AND n.pos = s.pos
), iss AS (
  SELECT title_id, pos, idx, 'cuts_off_during_speech' AS type, CASE WHEN abs(nl_end - en_end) <= 200 THEN 'low' WHEN end_delta_ms > 1000 THEN 'high' ELSE 'medium' END AS severity FROM an WHERE end_delta_ms > 500 AND NOT coalesce(next_start <= speech_end OR next_start - nl_end <= 200, false)
  UNION ALL SELECT title_id, pos, idx, 'lingers_after_speech', CASE WHEN abs(nl_end - en_end) <= 200 THEN 'low' WHEN end_delta_ms < -1500 THEN 'high' ELSE 'medium' END FROM an WHERE end_delta_ms < -500
  UNION ALL SELECT title_id, pos, idx, 'late_start', CASE WHEN abs(nl_start - en_start) <= 200 THEN 'low' WHEN start_delta_ms < -1000 THEN 'high' ELSE 'medium' END FROM an WHERE start_delta_ms < -500 AND NOT coalesce(prev_end >= nl_start - 200, false)
  UNION ALL SELECT title_id, pos, idx, 'early_start', 'low' FROM an WHERE start_delta_ms > 1500
  UNION ALL SELECT title_id, pos, idx, 'missing_anticipation', CASE WHEN abs(nl_start - en_start) <= 200 THEN 'low' ELSE 'medium' END FROM an WHERE start_delta_ms BETWEEN -500 AND 0 AND NOT coalesce(prev_end >= nl_start - 200, false)
)"""



def _renamed(sql: str, **names: str) -> str:
    for old, new in names.items():
        sql = re.sub(rf"\b{old}\b", new, sql)
    return sql


#: The analysis again, of cues whose ends were trimmed.
_AGAIN = ", ".join(
    [
        _renamed(_TRIM, en="nl", own="own2", found="found2"),
        "nlt AS (SELECT n.title_id, n.pos, n.idx, n.start_ms, coalesce(d.new_end_ms, n.end_ms) AS end_ms, n.text FROM nl n JOIN decisions d ON n.title_id = d.title_id AND n.pos = d.pos)",
        _renamed(_ANALYZED.replace(_SPEECH + ", ", ""), nl="nlt", prox="prox2", src="src2", nlw="nlw2", n1="n12", n1b="n1b2", n2="n22", an="an2", iss="iss2"),
    ]
)
_LINK = "CASE pos % 5 WHEN 1 THEN ' maar ' WHEN 2 THEN ' de ' WHEN 3 THEN ' het Rode Kruis ' ELSE ' ' END"
_JOINED = rf"joined AS (SELECT title_id, pos, idx, start_ms, end_ms, trim(regexp_replace(text || {_LINK} || coalesce(lead(text) OVER (PARTITION BY title_id ORDER BY pos), ''), '\s+', ' ', 'g')) AS j FROM en)"


def _breaks(source: str, text: str) -> str:
    keep = " + ".join(f"CASE WHEN contains(lower(j), '{p.lower()}') AND NOT contains(lower(top), '{p.lower()}') AND NOT contains(lower(bottom), '{p.lower()}') THEN -10 ELSE 0 END" for p in linebreak.KEEP_TOGETHER)
    return f"""opts AS (
  SELECT *, length(top) AS a, length(bottom) AS b FROM (SELECT title_id, pos, j, w, k, array_to_string(w[1:k], ' ') AS top, array_to_string(w[k + 1:], ' ') AS bottom FROM (SELECT *, unnest(range(1, len(w))) AS k FROM (SELECT title_id, pos, {text} AS j, {_words(text)} AS w FROM {source})) WHERE length(j) > 42)
), scored AS (
  SELECT *, CASE WHEN 10 * a BETWEEN 6 * b AND 9 * b THEN 3 WHEN 10 * a > 9 * b AND 10 * a <= 11 * b THEN 2 WHEN 10 * a >= 4 * b AND 10 * a < 6 * b THEN 1 WHEN 10 * a > 11 * b THEN -1 ELSE 0 END + CASE WHEN 2 * a > 3 * b THEN -3 ELSE 0 END
    + CASE WHEN k = 1 AND a < 8 THEN -5 ELSE 0 END + CASE WHEN k = len(w) - 1 AND b < 8 THEN -5 ELSE 0 END + CASE WHEN right(w[k], 1) IN ('.', ',', ';', ':', '!', '?') THEN 4 ELSE 0 END
    + CASE WHEN lower(rtrim(ltrim(w[k + 1], '-'), '.,;:!?…')) IN ({_list(linebreak.BREAK_BEFORE)}) THEN 2 ELSE 0 END + CASE WHEN lower(rtrim(w[k], '.,;:!?…')) IN ({_list(linebreak.BIND_FORWARD)}) THEN -10 ELSE 0 END + {keep} AS score
  FROM opts WHERE a <= 42 AND b <= 42
), best AS (
  SELECT title_id, pos, top, bottom FROM (SELECT *, row_number() OVER (PARTITION BY title_id, pos ORDER BY score DESC, abs(a - b), k) AS r FROM scored) WHERE r = 1 AND score >= -5
)"""


def _balance(source: str) -> str:
    return f"""two AS (
  SELECT title_id, pos, idx, start_ms, end_ms, text, {_rstrip('ls[1]')} AS top, {_rstrip('ls[2]')} AS bot FROM (SELECT *, string_split(text, chr(10)) AS ls FROM {source}) WHERE len(ls) = 2 AND NOT {_dual('text')}
), sized AS (SELECT *, length(top) AS a, length(bot) AS b, len({_words('top')}) AS tw, len({_words('bot')}) AS bw, {_words('top')} AS w FROM two), flaws AS (
  SELECT title_id, pos, 'orphan_top' AS type, CASE WHEN tw = 1 THEN 'high' ELSE 'medium' END AS severity FROM sized WHERE a < 8 AND (tw = 1 OR (tw <= 2 AND b > 25))
  UNION ALL SELECT title_id, pos, 'orphan_bottom', CASE WHEN bw = 1 THEN 'high' ELSE 'medium' END FROM sized WHERE b < 8 AND (bw = 1 OR (bw <= 2 AND a > 25))
  UNION ALL SELECT title_id, pos, 'top_heavy', CASE WHEN a > 2 * b THEN 'high' ELSE 'medium' END FROM sized WHERE a > 0 AND b > 0 AND 2 * a > 3 * b AND a - b > 10
  UNION ALL SELECT title_id, pos, 'bad_break', 'high' FROM sized WHERE tw > 0 AND lower(rtrim(w[-1], '.,;:!?…')) IN ({_list(linebreak.BIND_FORWARD)})
)"""


_TWO_LINES = f"""{_JOINED}, broken AS (
  SELECT title_id, pos, idx, start_ms, end_ms, CASE WHEN len(w) >= 2 THEN array_to_string(w[1:k], ' ') || chr(10) || array_to_string(w[k + 1:], ' ') ELSE j END AS text
  FROM (SELECT *, greatest(least(pos % 6 + 1, len(w) - 1), 1) AS k FROM (SELECT *, {_words('j')} AS w FROM joined))
)"""
_REBALANCED = f"""{_TWO_LINES}, {_balance('broken')}, fulls AS (SELECT *, top || ' ' || bot AS f FROM sized), {_breaks('fulls', 'f')}, flagged AS (
  SELECT s.*, best.top AS bt, best.bottom AS bb, EXISTS (SELECT 1 FROM flaws x WHERE x.title_id = s.title_id AND x.pos = s.pos AND severity = 'high') AS is_high
  FROM fulls s LEFT JOIN best ON s.title_id = best.title_id AND s.pos = best.pos AND NOT (best.top = s.top AND best.bottom = s.bot)
  WHERE length(f) <= 42 OR EXISTS (SELECT 1 FROM flaws x WHERE x.title_id = s.title_id AND x.pos = s.pos)
), rebalanced AS (
  SELECT title_id, pos, idx, is_high, CASE WHEN length(f) <= 42 THEN 'unbroken' WHEN bt IS NULL THEN 'unfixable' WHEN fast THEN 'skipped_cps' ELSE 'fixed' END AS outcome, CASE WHEN length(f) <= 42 THEN f WHEN bt IS NOT NULL AND NOT fast THEN bt || chr(10) || bb ELSE text END AS text
  FROM (SELECT *, ({_vis('bt')} + {_vis('bb')}) * 1000 > 17 * CASE WHEN end_ms > start_ms THEN end_ms - start_ms ELSE 1000 END AS fast FROM flagged)
)"""

#: Close small gaps, then give fast cues time.
_CLOSED = "gc AS (SELECT *, lead(start_ms) OVER (PARTITION BY title_id ORDER BY pos) AS nxt FROM cues), closed AS (SELECT * EXCLUDE (end_ms), CASE WHEN ok THEN nxt - 120 ELSE end_ms END AS end_ms FROM (SELECT *, coalesce(nxt - end_ms > 0 AND nxt - end_ms < 1000 AND nxt - 120 > end_ms AND nxt - 120 - start_ms <= 7000, false) AS ok FROM gc))"
_EXTENDED = f"(SELECT *, end_ms <= start_ms OR {_chars('text')} * 1000 > 13 * (end_ms - start_ms) AS fast, CASE WHEN nxt IS NULL THEN start_ms + least({_chars('text')} * 10000 // 125, 7000) WHEN nxt - end_ms > 120 THEN least(start_ms + {_chars('text')} * 10000 // 125, nxt - 120, start_ms + 7000) END AS ne FROM closed)"

#: The whole chain, each step from the one before.
_CHAIN = rf"""{_FIXED.replace(_SWAPPED, r"""swapped AS (
  SELECT title_id, pos, idx, CASE WHEN pos % 10 = 3 THEN start_ms - 4000 ELSE start_ms END AS start_ms, end_ms,
         CASE WHEN pos % 29 = 11 THEN '' WHEN pos % 13 = 3 THEN text || '!' WHEN pos % 17 = 5 THEN text || ';' WHEN pos % 23 = 9 THEN text || ' ' || plain || ' ' || plain
              WHEN pos % 7 = 2 THEN regexp_replace(text, '^((?:\[(?:SC|NM)\] )?[^ ]+) ', '\1' || chr(10)) ELSE text END AS text
  FROM (SELECT *, regexp_replace(text, '^\[(SC|NM)\] ', '') AS plain FROM marked)
)""")}, {_renamed(_MERGED, marked="fixed_srt")}, mcues AS (SELECT title_id, idx::BIGINT AS pos, idx, start_ms, end_ms, text, source_count FROM merged), {_SPEECH}, {_renamed(_TRIM, en="mcues")}, tcues AS (
  SELECT x.title_id, x.pos, x.idx, start_ms, coalesce(new_end_ms, end_ms) AS end_ms, text, source_count, trim_ms FROM mcues x JOIN decisions y ON x.title_id = y.title_id AND x.pos = y.pos
), {_renamed(_CLOSED, cues="tcues")}, ecues AS (
  SELECT title_id, pos, idx, start_ms, CASE WHEN coalesce(fast AND ne > end_ms, false) THEN ne ELSE end_ms END AS end_ms, text, source_count, trim_ms, ok AS closed, coalesce(fast AND ne > end_ms, false) AS extended FROM {_EXTENDED}
), ccues AS (
  SELECT * FROM ecues UNION ALL SELECT title_id, max(pos) + 1, max(idx) + 1, arg_max(end_ms, pos) + 3000, arg_max(end_ms, pos) + 6000, 'Vertaald met zorg', NULL, NULL, NULL, NULL FROM ecues GROUP BY 1 HAVING NOT contains(lower(arg_max(text, pos)), 'vertaald met zorg')
), {_REBALANCED.replace(f"{_TWO_LINES}, {_balance('broken')}", _balance("ccues"))}, finished AS (
  SELECT c.title_id, c.pos, c.idx, start_ms, end_ms, coalesce(b.text, c.text) AS text, source_count, trim_ms, closed, extended, outcome AS balance FROM ccues c LEFT JOIN rebalanced b ON c.title_id = b.title_id AND c.pos = b.pos
)"""

_GROUPS = f"""nodes AS (
  SELECT title_id, 'e' AS side, pos, idx, start_ms, end_ms, text FROM en UNION ALL SELECT title_id, 'n', pos, idx, start_ms, end_ms, text FROM nl
), links AS (
  SELECT e.title_id, e.pos AS ep, n.pos AS np FROM en e JOIN nl n ON e.title_id = n.title_id AND least(e.end_ms, n.end_ms) > greatest(e.start_ms, n.start_ms)
  WHERE (least(e.end_ms, n.end_ms) - greatest(e.start_ms, n.start_ms)) * 100 >= 10 * greatest(1, least(e.end_ms - e.start_ms, n.end_ms - n.start_ms))
), reach(title_id, ep, root) AS (
  SELECT DISTINCT title_id, ep, ep FROM links UNION SELECT r.title_id, b.ep, r.root FROM reach r JOIN links a ON a.title_id = r.title_id AND a.ep = r.ep JOIN links b ON b.title_id = a.title_id AND b.np = a.np
), roots AS (SELECT title_id, ep, min(root) AS root FROM reach GROUP BY 1, 2), keyed AS (
  SELECT x.*, CASE WHEN side = 'e' THEN coalesce('g' || r.root, 'e' || pos) ELSE coalesce('g' || q.root, 'n' || pos) END AS group_key, {_chars('text')} AS ch, replace(text, chr(10), ' ') AS flat FROM nodes x
  LEFT JOIN roots r ON side = 'e' AND r.title_id = x.title_id AND r.ep = x.pos LEFT JOIN (SELECT l.title_id, l.np, min(r.root) AS root FROM links l JOIN roots r ON l.title_id = r.title_id AND l.ep = r.ep GROUP BY 1, 2) q ON side = 'n' AND q.title_id = x.title_id AND q.np = x.pos
), agg AS (
  SELECT title_id, group_key, count(*) FILTER (WHERE side = 'e') AS en_count, count(*) FILTER (WHERE side = 'n') AS nl_count, coalesce(string_agg(flat, ' ' ORDER BY start_ms, pos) FILTER (WHERE side = 'e'), '') AS en_text, coalesce(string_agg(flat, ' ' ORDER BY start_ms, pos) FILTER (WHERE side = 'n'), '') AS nl_text,
    coalesce(sum(ch) FILTER (WHERE side = 'e'), 0)::BIGINT AS en_chars, coalesce(sum(ch) FILTER (WHERE side = 'n'), 0)::BIGINT AS nl_chars, coalesce(first(idx ORDER BY start_ms, pos) FILTER (WHERE side = 'e'), 0) AS en_first, coalesce(first(idx ORDER BY start_ms, pos) FILTER (WHERE side = 'n'), 0) AS nl_first,
    coalesce(min(start_ms) FILTER (WHERE side = 'e'), min(start_ms)) AS at_ms, max(end_ms) - min(start_ms) AS span_ms, bool_or(side = 'n' AND {_dual('text')}) AS dual FROM keyed GROUP BY 1, 2
), groups AS (
  SELECT *, CASE WHEN en_count = 1 AND nl_count = 1 THEN '1:1' WHEN en_count > 1 AND nl_count = 1 THEN en_count || ':1 merge' WHEN en_count = 1 AND nl_count > 1 THEN '1:' || nl_count || ' split' ELSE en_count || ':' || nl_count || ' remap' END AS merge_type,
    CASE WHEN en_chars = 0 THEN 1000000 ELSE nl_chars * 1000000 // en_chars END AS ratio FROM agg
)"""

_LOW = "lower(nl_text)"


def _any(*parts: str, x: str = _LOW) -> str:
    return "(" + " OR ".join(f"contains({x}, '" + p.replace("'", "''") + "')" for p in parts) + ")"


def _register(x: str) -> str:
    low = f"lower({x})"
    you = _any(" je ", " jij ", " jouw ", x=low)
    return f"(CASE WHEN {_any(' u ', ' uw ', 'mylord', 'meneer', 'mevrouw', x=low)} THEN CASE WHEN {you} THEN 'mixed' ELSE 'formal' END WHEN {you} OR {_any(chr(32) + 'm' + chr(39) + 'n ', chr(32) + 'z' + chr(39) + 'n ', x=low)} THEN 'informal' END)"


_A, _B = f"list_distinct({_words('lower(en_text)')})", f"list_distinct({_words(_LOW)})"
_CATS = f"""cats AS (
  SELECT g.*, unnest(list_filter([CASE WHEN en_count >= 2 AND nl_count = 1 THEN 'merge' END, CASE WHEN en_count >= 3 AND nl_count <= 2 THEN 'heavy-merge' END,
    CASE WHEN en_chars > 0 AND nl_chars * 100 BETWEEN 40 * en_chars AND 65 * en_chars THEN 'strong-condensation' END, CASE WHEN en_chars > 0 AND nl_chars * 100 > 65 * en_chars AND nl_chars * 100 <= 80 * en_chars THEN 'condensation' END,
    CASE WHEN en_chars > 10 AND nl_chars * 100 > 115 * en_chars THEN 'expansion' END, CASE WHEN dual THEN 'dual-speaker' END,
    CASE WHEN en_count <= 2 AND nl_count <= 2 AND len({_A}) >= 3 AND len({_B}) >= 3 AND len(list_filter(list_intersect({_A}, {_B}), lambda q: NOT regexp_full_match(q, '[0-9]+'))) <= 1 AND abs(length(en_text) - length(nl_text)) * 2 < length(en_text) THEN 'idiom-candidate' END,
    'register-' || {_register('nl_text')}, CASE WHEN regexp_matches(nl_text, '{INVERSION}') THEN 'v2-inversion' END, CASE WHEN contains(nl_text, '...') THEN 'continuation' END], lambda q: q IS NOT NULL)) AS category FROM groups g
)"""

_SEGMENTS = """heard AS (
  SELECT title_id, pos, CASE WHEN pos % 3 = 0 OR pos % 5 = 0 AND i * 3 > n THEN -idx ELSE idx END AS idx, i AS word_no, 40 + 25 * i + (pos * 7) % 90 + CASE WHEN pos % 41 = 1 THEN 400 ELSE 0 END AS f FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM (SELECT *, len(string_split(text, ' ')) AS n FROM en))
), framed AS (
  SELECT *, greatest(0, start_ms - CASE WHEN p < start_ms THEN least((start_ms - p) // 2, 1500) ELSE 1500 END) AS ws, len(string_split(text, ' ')) AS we FROM (SELECT *, lag(end_ms) OVER (PARTITION BY title_id ORDER BY pos) AS p FROM en)
), corr AS (
  SELECT title_id, idx, s AS aligned_start_ms, e AS aligned_end_ms, s - start_ms AS start_delta_ms, e - end_ms AS end_delta_ms, we::INT AS words_expected, wf AS words_found, (wf * 1000 // we)::BIGINT AS confidence, abs(s - start_ms) > 150 OR abs(e - end_ms) > 150 AS significant
  FROM (SELECT x.title_id, x.idx, start_ms, end_ms, we, ws + 10 * min(f) AS s, ws + 10 * (max(f) + 18) AS e, count(*) AS wf FROM framed x JOIN heard h ON x.title_id = h.title_id AND x.idx = h.idx WHERE we >= 2 GROUP BY x.title_id, x.idx, start_ms, end_ms, we, ws) WHERE abs(s - start_ms) <= 3000 AND wf * 2 >= we
)"""

_GENRE_RANGE = "{p} BETWEEN {lo} * 10 AND {hi} * 10 AS in_range"


def _numbers() -> str:
    units, tens = _list(spoken.UNITS), _list(spoken.TENS)
    two = "CASE WHEN {0} < 20 THEN u[{0} + 1] WHEN {0} % 10 = 0 THEN t[{0} // 10 - 1] ELSE t[{0} // 10 - 1] || ' ' || u[{0} % 10 + 1] END"
    return f"""nums AS (SELECT n, [{units}] AS u, [{tens}] AS t FROM range(0, 10000) x(n)), spelled AS (
  SELECT n, CASE WHEN n < 100 THEN {two.format('n')} WHEN n = 100 THEN 'hundred' WHEN n = 1000 THEN 'thousand'
    WHEN n BETWEEN 101 AND 999 THEN u[n // 100 + 1] || ' hundred' || CASE WHEN n % 100 > 0 THEN ' and ' || {two.format('(n % 100)')} ELSE '' END
    WHEN n = 2000 THEN 'two thousand' WHEN n BETWEEN 2001 AND 2009 THEN 'two thousand and ' || u[n % 10 + 1]
    WHEN n BETWEEN 1900 AND 2099 THEN {two.format('(n // 100)')} || CASE WHEN n % 100 = 0 THEN ' hundred' ELSE ' ' || {two.format('(n % 100)')} END
    ELSE array_to_string(list_transform(string_split(n::VARCHAR, ''), lambda q: u[q::INT + 1]), ' ') END AS words FROM nums
)"""


def _events_near() -> str:
    return "ev AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms FROM events), k AS (SELECT * EXCLUDE (event_type) FROM ev WHERE event_type = 'purchase'), o AS (SELECT * FROM ev WHERE event_type <> 'purchase'), " + _near("f", "k", "o", "ms", "ms", "user_id")


def sql() -> dict[str, str]:
    def q(ctes: str, select: str, base: bool = True) -> str:
        parts = [x.strip().strip(",") for x in ((BASE if base else ""), ctes) if x.strip()]
        return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + select

    clean = f"clean AS (SELECT *, lead(start_ms) OVER w AS nxt, lead(idx) OVER w AS nidx FROM cues WHERE {_strip('text')} <> '' WINDOW w AS (PARTITION BY title_id ORDER BY pos))"
    gaps_closed = _CLOSED
    ch = _chars("text")
    measured = f"ms AS (SELECT title_id, pos, end_ms - start_ms AS duration_ms, {ch} AS chars, CASE WHEN end_ms > start_ms THEN {ch}::BIGINT * 1000000000 // (end_ms - start_ms) END AS micro_cps, len(string_split(text, chr(10)))::INT AS line_count, list_max(list_transform(string_split(text, chr(10)), lambda q: length(q)))::INT AS max_line_length FROM cues)"
    stats = "SELECT title_id, count(*) AS total_cues, sum(chars)::BIGINT AS total_chars, sum(duration_ms)::BIGINT AS total_duration_ms, max(micro_cps) AS cps_max, min(micro_cps) AS cps_min, (sum(micro_cps) // count(micro_cps))::BIGINT AS cps_avg, count(*) FILTER (WHERE duration_ms > 0 AND chars * 1000 > 17 * duration_ms) AS cps_above_soft, count(*) FILTER (WHERE duration_ms > 0 AND chars * 1000 > 20 * duration_ms) AS cps_above_hard FROM ms GROUP BY 1"
    block = f"idx || chr(13) || chr(10) || {_code('start_ms')} || ' --> ' || {_code('end_ms')} || chr(13) || chr(10) || replace(text, chr(10), chr(13) || chr(10)) || chr(13) || chr(10)"
    ext = """runs AS (SELECT c.*, least(coalesce(lead(start_ms) OVER (PARTITION BY title_id ORDER BY pos) - 125, e + 3000), e + 3000) AS mx FROM (SELECT *, greatest(end_ms - 900, start_ms + 200) AS e FROM en) c),
scan AS (SELECT title_id, pos, idx, e, mx, start_ms // 30 AS lo, (e + least(3000, mx - e + 500)) // 30 AS hi FROM runs WHERE mx > e),
fr AS (SELECT s.*, f.frame_idx AS f, f.is_speech, f.frame_idx - coalesce(max(CASE WHEN f.is_speech THEN f.frame_idx END) OVER (PARTITION BY s.title_id, s.pos ORDER BY f.frame_idx), lo - 1) AS quiet FROM scan s JOIN frames f ON s.title_id = f.title_id AND f.frame_idx >= lo AND f.frame_idx < hi),
st AS (SELECT title_id, pos, min(f) AS stop FROM fr WHERE NOT is_speech AND f * 30 > e AND quiet >= 10 GROUP BY 1, 2),
la AS (SELECT fr.title_id, fr.pos, idx, e, mx, max(CASE WHEN is_speech AND (stop IS NULL OR f < stop) THEN (f + 1) * 30 END) AS se FROM fr LEFT JOIN st ON fr.title_id = st.title_id AND fr.pos = st.pos GROUP BY ALL)"""
    o: dict[str, str] = {}
    o["cue_metrics"] = q(measured, "SELECT * FROM ms")
    o["timecode_roundtrip"] = q("", f"SELECT title_id, pos, {_code('start_ms * 7 - 5000')} AS code, greatest(start_ms * 7 - 5000, 0)::BIGINT AS back_ms, printf('%d:%02d:%02d', start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60) AS clock FROM cues")
    o["fix_text"] = q("", f"SELECT title_id, pos, {_dash('f')} AS fixed, len(regexp_extract_all(text, '[!;]'))::INT AS punctuation_fixes, len(regexp_extract_all(text, '…'))::INT AS ellipsis_fixes FROM (SELECT *, {_FIX1} AS f FROM cues)")
    o["fix_line_length"] = q(_LENGTH.format(src="text", inp="cues", out="lengthened"), "SELECT title_id, pos, fixed FROM lengthened")
    o["continuation_fix"] = q("", "SELECT title_id, pos, CASE WHEN text LIKE '%,' THEN text[:-2] || '...' ELSE text END AS fixed FROM cues")
    o["merge_markers"] = q("", "SELECT title_id, pos, CASE WHEN text LIKE '[SC]%' THEN 'SC' WHEN text LIKE '[NM]%' THEN 'NM' ELSE '' END AS marker, CASE WHEN text LIKE '[SC]%' OR text LIKE '[NM]%' THEN ltrim(text[5:]) ELSE text END AS clean FROM marked")
    o["trivial_replies"] = q("", f"SELECT title_id, pos, reply, lower(trim(rtrim({_strip('reply')}, '.?'))) IN ({_list(TRIVIAL_REPLIES)}) AS trivial FROM (SELECT title_id, pos, CASE pos % 4 WHEN 0 THEN 'Ja.' WHEN 1 THEN ' Dank je ' WHEN 2 THEN 'PRECIES?.' ELSE text END AS reply FROM cues)")
    o["wrap_text"] = q("", f"SELECT title_id, pos, {_wrap('x')} AS wrapped FROM (SELECT title_id, pos, concat_ws(' ', text, lead(text) OVER w, CASE WHEN pos % 3 = 0 THEN lead(text, 2) OVER w END) AS x FROM en WINDOW w AS (PARTITION BY title_id ORDER BY pos))")
    o["best_break"] = q(f"{_JOINED}, {_breaks('joined', 'j')}", "SELECT j.title_id, j.pos, top, bottom FROM joined j LEFT JOIN best b ON j.title_id = b.title_id AND j.pos = b.pos")
    o["number_words"] = q(_numbers(), "SELECT n::VARCHAR AS number, words FROM spelled WHERE n IN (SELECT o_orderkey % 2100 FROM orders)", base=False)
    o["normalize_words"] = q(_numbers(), "SELECT title_id, pos, array_to_string(list_filter(string_split('it is ' || lower(regexp_replace(text, '[^A-Za-z ]', '', 'g')) || ' do not count ' || words || ' we have said', ' '), lambda q: q <> ''), ' ') AS words FROM en JOIN spelled ON n = pos")
    plain = r"list_filter(string_split(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g'), ' '), lambda x: x <> '')"
    o["vocabulary_words"] = q(
        f"known AS (SELECT DISTINCT unnest({plain}) AS word FROM documents), placed AS (SELECT title_id, pos, generate_subscripts(w, 1) AS k, unnest(w) AS word FROM (SELECT title_id, pos, {plain} AS w FROM en))",
        "SELECT e.title_id, e.pos, coalesce(string_agg(p.word, ' ' ORDER BY k), '') AS kept, count(p.word)::INT AS n FROM en e LEFT JOIN (SELECT * FROM placed SEMI JOIN known USING (word)) p ON e.title_id = p.title_id AND e.pos = p.pos GROUP BY 1, 2",
    )
    o["phrase_lexicon"] = q(
        f"nlw AS (SELECT {plain} AS w FROM nl), phrases AS (SELECT DISTINCT n, array_to_string(w[k:k + n - 1], ' ') AS phrase FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS k FROM nlw, (VALUES (1), (2), (3)) v(n) WHERE len(w) >= n)), "
        f"chosen AS (SELECT n, phrase FROM phrases WHERE (length(phrase) + ascii(right(phrase, 1))) % 5 = 0), enw AS (SELECT title_id, pos, {plain} AS w FROM en), "
        "hits AS (SELECT title_id, pos, k - 1 AS place, g.n, phrase FROM (SELECT title_id, pos, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM enw, (VALUES (1), (2), (3)) v(n) WHERE len(w) >= n) g JOIN chosen c ON c.n = g.n AND c.phrase = array_to_string(w[k:k + g.n - 1], ' ')), "
        "best AS (SELECT title_id, pos, place, max(n) AS n FROM hits GROUP BY 1, 2, 3), "
        "taken AS (SELECT title_id, pos, min(place) AS place, arg_min(n, place) AS n FROM best GROUP BY 1, 2 UNION ALL SELECT t.title_id, t.pos, b.place, b.n FROM taken t, LATERAL (SELECT place, n FROM best b WHERE b.title_id = t.title_id AND b.pos = t.pos AND b.place >= t.place + t.n ORDER BY place LIMIT 1) b)",
        "SELECT h.title_id, h.pos, h.place::INT AS place, h.n::INT AS n, h.phrase, CASE WHEN h.n = 1 THEN 'word' ELSE 'expression' END AS kinds FROM taken t JOIN hits h ON t.title_id = h.title_id AND t.pos = h.pos AND t.place = h.place AND t.n = h.n",
    )
    o["register_detect"] = q("", f"SELECT title_id, pos, {_register('x')} AS register FROM (SELECT *, ' ' || text || ' ' AS x FROM nl)")
    o["imdb_id"] = "SELECT DISTINCT conv_id, CASE WHEN conv_id % 2 = 0 THEN lpad((conv_id * 7919 % 10000000)::VARCHAR, 7, '0') ELSE '' END AS imdb_id, CASE WHEN conv_id % 2 = 0 THEN 'Film ' || conv_id || ' [IMDB-tt' || lpad((conv_id * 7919 % 10000000)::VARCHAR, 7, '0') || ']' ELSE 'Film ' || conv_id END AS source_name, 'Film ' || conv_id || CASE WHEN conv_id % 2 = 0 THEN ' [IMDB-tt' || lpad((conv_id * 7919 % 10000000)::VARCHAR, 7, '0') || ']' ELSE ' [Bluray-1080p]' END || '.nl.srt' AS output_name FROM conversations"
    names = [c.split()[0] for c in schema.CONSTRAINTS_SCHEMA.split(", ")]
    o["fps_constraints"] = f"WITH c({', '.join(names)}) AS (VALUES {_values(schema.CONSTRAINTS)}) SELECT conv_id, r AS raw_fps, {', '.join('c.' + n for n in names[1:])} FROM (SELECT DISTINCT conv_id, ['23.976', '24000/1001', '25', '29.97'][conv_id % 4 + 1] AS r FROM conversations) x JOIN c ON c.lang = 'nl' AND c.fps = CASE WHEN r IN ('25', '29.97') THEN 25 ELSE 24 END"
    o["dual_speaker_share"] = q(_GENRES, f"SELECT title_id, total_cues, dual_cues, permille, genre, dual_cues * 100 BETWEEN dual_lo * total_cues AND dual_hi * total_cues AS in_range FROM (SELECT title_id, count(*) AS total_cues, count(*) FILTER (WHERE {_dual('text')}) AS dual_cues, round_even(count(*) FILTER (WHERE {_dual('text')}) * 1000 / count(*), 0)::BIGINT AS permille FROM cues GROUP BY 1), genres")
    o["parse_srt"] = q("", f"SELECT title_id, pos, idx, start_ms, end_ms, {_rstrip('text')} AS text FROM cues")
    o["srt_files"] = q("", f"SELECT title_id, 'en' AS lang, pos, idx, start_ms, end_ms, {_rstrip('text')} AS text FROM cues UNION ALL SELECT title_id, 'pt-br', pos, idx, start_ms, end_ms, {_rstrip('text')} FROM nl")
    o["encoding_detect"] = q(
        r"t AS (SELECT title_id, pos, title_id::BIGINT % 4 AS k, CASE title_id::BIGINT % 4 WHEN 2 THEN regexp_replace(text, '[^\x{0}-\x{FF}]', '', 'g') WHEN 3 THEN regexp_replace(text, '[^\x{0}-\x{7F}]', '', 'g') ELSE text END AS x FROM en)",
        "SELECT title_id, ['utf-8', 'utf-16le', 'iso-8859-1', 'windows-1250'][k + 1] AS encoding, true AS sure, md5(string_agg(x, chr(10) ORDER BY pos) || CASE k WHEN 2 THEN chr(10) || 'Où est passé le garçon ? Très fatigué à la forêt.' WHEN 3 THEN chr(10) || 'Chciałbym, żeby wszyscy ludzie byli szczęśliwi.' ELSE '' END) AS digest FROM t GROUP BY title_id, k",
    )
    o["parse_errors"] = q("", "SELECT title_id, pos::INT AS block, CASE WHEN pos % 7 = 0 THEN 'Insufficient lines' WHEN pos % 3 = 0 THEN 'Invalid index' ELSE 'Invalid timecode' END AS reason FROM en WHERE pos % 7 = 0 OR pos % 3 = 0 OR pos % 5 = 0")
    o["render_srt"] = q("", f"SELECT title_id, md5(c) AS digest, length(c)::INT AS n FROM (SELECT title_id, chr(65279) || string_agg({block}, chr(13) || chr(10) ORDER BY pos) AS c FROM cues GROUP BY 1)")
    o["extract_range"] = q("", "SELECT t.title_id, v.idx, c.pos, c.text, c.pos IS NOT NULL AS found FROM (SELECT DISTINCT title_id FROM cues) t CROSS JOIN (VALUES (10), (11), (12), (40), (55), (100)) v(idx) LEFT JOIN (SELECT title_id, idx, max(pos) AS pos, arg_max(text, pos) AS text FROM cues GROUP BY 1, 2) c ON t.title_id = c.title_id AND v.idx = c.idx")
    o["gap_stats"] = q("", "SELECT title_id, count(g) AS gaps, min(g) AS least, max(g) AS greatest, sum(g)::BIGINT AS total, count(*) FILTER (WHERE g < 0) AS overlaps FROM (SELECT title_id, start_ms - lag(end_ms) OVER (PARTITION BY title_id ORDER BY pos) AS g FROM cues) GROUP BY 1")
    o["renumber"] = q("", "SELECT title_id, count(*) AS cues, count(*) FILTER (WHERE idx <> k) AS gaps_found, max(k)::INT AS last_idx FROM (SELECT title_id, idx, row_number() OVER (PARTITION BY title_id ORDER BY pos) AS k FROM cues) GROUP BY 1")
    o["reorder"] = q(_SWAPPED, "SELECT title_id, row_number() OVER (PARTITION BY title_id ORDER BY start_ms, pos) AS pos, idx, start_ms, pos <> row_number() OVER (PARTITION BY title_id ORDER BY start_ms, pos) AS moved FROM swapped")
    o["fix_overlap"] = q(clean, "SELECT title_id, pos, idx, CASE WHEN nxt - end_ms < 120 THEN nidx END AS fixed_by, coalesce(nxt - end_ms < 120 AND greatest(0, nxt - 120) <= start_ms, false) AS unfixable, CASE WHEN nxt - end_ms < 120 AND greatest(0, nxt - 120) > start_ms THEN greatest(0, nxt - 120) ELSE end_ms END AS new_end_ms FROM clean")
    o["close_gaps"] = q(gaps_closed, "SELECT title_id, pos, end_ms, ok AS closed FROM closed")
    o["extend_cps"] = q(gaps_closed, f"SELECT title_id, pos, CASE WHEN coalesce(fast AND ne > end_ms, false) THEN ne ELSE end_ms END AS end_ms, coalesce(fast AND ne > end_ms, false) AS extended FROM {_EXTENDED}")
    o["shift_range"] = q("", "SELECT title_id, pos, start_ms - CASE WHEN idx BETWEEN 20 AND 40 THEN 250 ELSE 0 END AS start_ms, end_ms - CASE WHEN idx BETWEEN 20 AND 40 THEN 250 ELSE 0 END AS end_ms FROM cues")
    o["add_credit"] = q("", "SELECT title_id, n + CASE WHEN has THEN 0 ELSE 1 END AS cues, CASE WHEN has THEN 'VERTAALD MET ZORG.' ELSE 'Vertaald met zorg' END AS last_text, CASE WHEN has THEN s ELSE e + 3000 END AS last_start, CASE WHEN has THEN e ELSE e + 6000 END AS last_end FROM (SELECT title_id, title_id::INT % 3 = 0 AS has, count(*) AS n, arg_max(start_ms, pos) AS s, arg_max(end_ms, pos) AS e FROM cues GROUP BY 1)")
    o["fix_srt"] = q(_FIXED, "SELECT * FROM fixed_srt")
    o["unfixable_indices"] = q(_FIXED, f"SELECT title_id, idx FROM fixed_srt WHERE (end_ms > start_ms AND {ch} * 1000 > 20 * (end_ms - start_ms)) OR len(string_split(text, chr(10))) > 2 OR list_max(list_transform(string_split(text, chr(10)), lambda q: {_vis(_undash('q'))})) > 42")
    o["batch_plan"] = q("", "SELECT title_id, (pos - 1) // 200 AS batch, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n, (pos - 1) // 200 // 6 AS invocation FROM cues GROUP BY 1, 2, 6")
    o["alignment_corrections"] = q(_SEGMENTS, "SELECT * FROM corr")
    o["alignment_applied"] = q(_SEGMENTS, "SELECT title_id, pos, s AS start_ms, CASE WHEN e2 <= s THEN s + 500 ELSE e2 END AS end_ms, applied FROM (SELECT *, CASE WHEN e > lead(s) OVER (PARTITION BY title_id ORDER BY pos) THEN lead(s) OVER (PARTITION BY title_id ORDER BY pos) - 1 ELSE e END AS e2 FROM (SELECT n.title_id, n.pos, coalesce(aligned_start_ms, start_ms) AS s, coalesce(aligned_end_ms + 200, end_ms) AS e, aligned_start_ms IS NOT NULL AS applied FROM en n LEFT JOIN corr c ON n.title_id = c.title_id AND n.idx = c.idx AND significant))")
    o["validate_rules"] = q(_rules(), "SELECT * FROM rules")
    o["validation_stats"] = q(measured, stats)
    drift = "dev AS (SELECT n.title_id, n.pos, n.idx, min(abs(e.start_ms - n.start_ms)) AS d FROM nl n JOIN (SELECT title_id, start_ms + CASE WHEN pos BETWEEN 15 AND 24 THEN 36000000 ELSE 0 END AS start_ms FROM en) e ON n.title_id = e.title_id GROUP BY 1, 2, 3 HAVING min(abs(e.start_ms - n.start_ms)) >= 3000), isl AS (SELECT *, idx - row_number() OVER (PARTITION BY title_id ORDER BY pos) AS i FROM dev), drifting AS (SELECT title_id, min(idx) AS first_idx, max(idx) AS last_idx, (max(idx) - min(idx) + 1)::INT AS n_cues, max(d) AS max_deviation_ms, CASE WHEN max(d) >= 5000 AND max(idx) > min(idx) THEN 'error' ELSE 'warning' END AS severity FROM isl GROUP BY title_id, i)"
    unread = "unread AS (SELECT title_id, 'error' AS severity FROM en WHERE title_id LIKE '%3' AND (pos % 7 = 0 OR pos % 3 = 0 OR pos % 5 = 0))"
    o["validation_summary"] = q(
        f"{_rules()}, {drift}, {unread}, hits AS (SELECT title_id, severity FROM rules UNION ALL SELECT title_id, severity FROM drifting UNION ALL SELECT * FROM unread)",
        "SELECT c.title_id, total_cues, coalesce(e, 0) AS error_count, coalesce(w, 0) AS warning_count, coalesce(e, 0) = 0 AS valid FROM (SELECT title_id, count(*) AS total_cues FROM swapped GROUP BY 1) c LEFT JOIN (SELECT title_id, count(*) FILTER (WHERE severity = 'error') AS e, count(*) FILTER (WHERE severity = 'warning') AS w FROM hits GROUP BY 1) r ON c.title_id = r.title_id",
    )
    o["timing_drift"] = q(drift, "SELECT * FROM drifting")
    deltas = ", ".join(f"{f}({k}_delta_ms) FILTER (WHERE significant) AS {k}_{f}" for k in ("start", "end") for f in ("min", "max"))
    means = ", ".join(f"round_even(sum({k}_delta_ms) FILTER (WHERE significant) / count(*) FILTER (WHERE significant), 0)::BIGINT AS {k}_avg" for k in ("start", "end"))
    o["alignment_report"] = q(
        f"{_SEGMENTS}, said AS (SELECT x.title_id, x.idx, we, start_ms, ws, count(f) AS wf, ws + 10 * min(f) AS s FROM framed x LEFT JOIN heard h ON x.title_id = h.title_id AND x.idx = h.idx GROUP BY 1, 2, 3, 4, 5), told AS (SELECT title_id, count(*) AS total_cues, count(*) FILTER (WHERE short) AS skipped_short, count(*) FILTER (WHERE NOT short AND wf * 2 < we) AS skipped_confidence FROM (SELECT *, we < 2 OR wf = 0 OR abs(s - start_ms) > 3000 AS short FROM said) GROUP BY 1), moved AS (SELECT title_id, count(*) AS aligned, count(*) FILTER (WHERE significant) AS significant_n, {deltas}, {means} FROM corr GROUP BY 1)",
        "SELECT t.title_id, total_cues, coalesce(aligned, 0) AS aligned, skipped_short, skipped_confidence, coalesce(significant_n, 0) AS significant, start_min, start_max, end_min, end_max, start_avg, end_avg FROM told t LEFT JOIN moved m ON t.title_id = m.title_id",
    )
    o["stream_merge"] = q(_MERGED, "SELECT title_id, false AS late, start_ms, end_ms, text, source_count, sources, gap_ms FROM merged")
    o["resumable_batches"] = q("", f"SELECT title_id, pos, start_ms - lag(end_ms) OVER w AS gap_ms, ({' + '.join(f'coalesce((lag(text, {k}) OVER w = text)::INT, 0)' for k in (1, 2, 3))}) AS repeats FROM cues WINDOW w AS (PARTITION BY title_id ORDER BY pos)")
    o["merge_cues"] = q(_MERGED, "SELECT * FROM merged")
    merge_agg = "SELECT title_id, sum(source_count)::BIGINT AS source_cues, count(*) AS output_cues, count(*) FILTER (WHERE source_count > 1) AS merges, coalesce(sum(source_count) FILTER (WHERE source_count > 1), 0)::BIGINT AS cues_merged, round_even(count(*) * 1000 / sum(source_count), 0)::BIGINT AS ratio_permille FROM merged GROUP BY 1"
    o["merge_report_cues"] = q(_MERGED, "SELECT title_id, idx, text, CASE WHEN source_count > 1 THEN source_count END AS source_count, CASE WHEN source_count > 1 THEN sources END AS sources, CASE WHEN source_count > 1 THEN gap_ms END AS gap_ms FROM merged")
    o["merge_stats"] = q(f"{_MERGED}, {_GENRES}", f"SELECT x.*, genre, output_cues * 100 BETWEEN ratio_lo * source_cues AND ratio_hi * source_cues AS in_range FROM ({merge_agg}) x, genres")
    o["nearest_transition"] = q(_events_near(), "SELECT user_id, event_id, ms, CASE WHEN abs(near - ms) <= 3600000 THEN near END AS nearest_ms, CASE WHEN abs(near - ms) <= 3600000 THEN abs(near - ms) END AS distance_ms FROM f", base=False)
    o["match_proximity"] = q(_PROX, "SELECT * FROM prox")
    o["draft_mapping"] = q(_DRAFTS, "SELECT * FROM draft_rows")
    o["mapping_stats"] = q(_DRAFTS, "SELECT d.*, nl_cues - matched AS unmatched, en_cues FROM (SELECT title_id, count(*) AS nl_cues, count(en_start_ms) AS matched FROM draft_rows GROUP BY 1) d JOIN (SELECT title_id, count(*) AS en_cues FROM en GROUP BY 1) e ON d.title_id = e.title_id")
    o["match_enhanced"] = q(_ENHANCED, "SELECT * FROM enhanced")
    o["title_cards"] = q(_CARDS, "SELECT * FROM cards")
    o["title_card_union"] = q(_CARDS, "SELECT title_id, row_number() OVER (PARTITION BY title_id ORDER BY start_ms, k, pos)::INT AS idx, start_ms, end_ms, text FROM (SELECT 0 AS k, title_id, pos, start_ms, end_ms, text FROM en UNION ALL SELECT 1, title_id, pos, start_ms, end_ms, '[TITLE CARD: \"' || text || '\"]' FROM cards)")
    o["smooth_speech"] = q(_SPEECH, "SELECT title_id, is_speech, first_frame, end_frame FROM smoothed")
    o["speech_segments"] = q(_SPEECH, "SELECT * FROM segs")
    offsets = """off AS (
  SELECT title_id, pos, start_ms - (title_id::BIGINT * 7919 % 40001 - 20000) AS cs, end_ms - (title_id::BIGINT * 7919 % 40001 - 20000) AS ce FROM en
), voted AS (
  SELECT c.title_id, floor((s.start_ms - cs) / 200)::BIGINT AS bin, count(*) AS votes FROM off c JOIN segs s ON c.title_id = s.title_id AND abs(s.start_ms - cs) <= 60000 GROUP BY 1, 2
), cand AS (
  SELECT * FROM voted QUALIFY row_number() OVER (PARTITION BY title_id ORDER BY votes DESC, abs(bin), bin) <= 3
), near AS (
  SELECT k.title_id, bin, votes, cs, ce, s.start_ms AS ss, s.end_ms AS se FROM cand k JOIN off c ON k.title_id = c.title_id JOIN segs s ON k.title_id = s.title_id AND cs + bin * 200 - 600 < s.end_ms AND ce + bin * 200 + 600 > s.start_ms
), tried AS (
  SELECT DISTINCT title_id, bin, votes, at_ms FROM (SELECT title_id, bin, votes, unnest([bin * 200 - 600, bin * 200 + 600, ss - ce, ss - cs, se - ce, se - cs]) AS at_ms FROM near) WHERE at_ms BETWEEN bin * 200 - 600 AND bin * 200 + 600
), measured AS (
  SELECT t.title_id, t.bin, t.votes, at_ms, sum(greatest(0, least(ce + at_ms, se) - greatest(cs + at_ms, ss)))::BIGINT AS overlap_ms FROM tried t JOIN near n ON t.title_id = n.title_id AND t.bin = n.bin GROUP BY 1, 2, 3, 4
), offs AS (
  SELECT title_id, at_ms AS offset_ms, overlap_ms, overlap_ms * 1000 // (SELECT sum(ce - cs) FROM off o WHERE o.title_id = m.title_id)::BIGINT AS score, votes FROM measured m
  QUALIFY row_number() OVER (PARTITION BY title_id ORDER BY overlap_ms DESC, abs(at_ms), at_ms, votes DESC, abs(bin), bin) = 1
)"""
    o["title_offsets"] = q(f"{_SPEECH}, {offsets}", "SELECT * FROM offs")
    o["offset_applied"] = q(f"{_SPEECH}, {offsets}", "SELECT off.title_id, pos, greatest(0, cs + coalesce(offset_ms, 0)) AS start_ms, greatest(0, ce + coalesce(offset_ms, 0)) AS end_ms, coalesce(offset_ms, 0) AS offset_ms FROM off LEFT JOIN offs ON off.title_id = offs.title_id AND score >= 300")
    o["trim_to_speech"] = q(f"{_SPEECH}, {_TRIM}", "SELECT * FROM decisions")
    counted = "tc AS (SELECT title_id, action, reason, count(*) AS n, coalesce(sum(trim_ms), 0)::BIGINT AS ms FROM decisions GROUP BY 1, 2, 3)"
    o["trim_titles"] = q(
        f"{_SPEECH}, {_TRIM}, {counted}",
        "SELECT *, round_even(total_trim_ms / nullif(full_trims + partial_trims, 0), 0)::BIGINT AS avg_trim_ms FROM (SELECT title_id, sum(n)::BIGINT AS total_cues, coalesce(sum(n) FILTER (WHERE action = 'trim'), 0)::BIGINT AS full_trims, coalesce(sum(n) FILTER (WHERE action = 'partial_trim'), 0)::BIGINT AS partial_trims, coalesce(sum(n) FILTER (WHERE action = 'skip'), 0)::BIGINT AS skipped, "
        "coalesce(sum(ms) FILTER (WHERE action <> 'skip'), 0)::BIGINT AS total_trim_ms, coalesce(string_agg(reason || ': ' || n, ', ' ORDER BY n DESC, reason) FILTER (WHERE action = 'skip' AND reason IS NOT NULL), '') AS skip_reasons FROM tc GROUP BY 1)",
    )
    o["trim_summary"] = q(f"{_SPEECH}, {_TRIM}", "SELECT action, reason, count(*) AS n, sum(trim_ms)::BIGINT AS total_trim_ms, row_number() OVER (ORDER BY count(*) DESC, action, reason NULLS FIRST)::INT AS rank FROM decisions GROUP BY 1, 2")
    o["speech_extension"] = q(ext, "SELECT title_id, pos, idx, e AS old_end_ms, least(se + 100, mx) AS new_end_ms, least(se + 100, mx) - e AS extension_ms FROM la WHERE se > e AND least(se + 100, mx) - e > 50")
    o["report_objects"] = q(
        f"{_SPEECH}, {_TRIM}, {ext}, longer AS (SELECT title_id, idx, e AS old_end, least(se + 100, mx) AS new_end, least(se + 100, mx) - e AS ms FROM la WHERE se > e AND least(se + 100, mx) - e > 50), sizes AS (SELECT title_id, count(*) AS total_cues FROM en GROUP BY 1)",
        "SELECT s.title_id, 'trim' AS kind, total_cues, coalesce(n, 0) AS counted, idx AS cue_num, old_end_ms AS old_end, new_end_ms AS new_end, trim_ms AS ms FROM sizes s LEFT JOIN (SELECT title_id, count(*) AS n FROM decisions WHERE action = 'trim' GROUP BY 1) c ON s.title_id = c.title_id LEFT JOIN (SELECT * FROM decisions WHERE action <> 'skip') d ON s.title_id = d.title_id "
        "UNION ALL SELECT s.title_id, 'extension', total_cues, coalesce(n, 0), idx, old_end, new_end, ms FROM sizes s LEFT JOIN (SELECT title_id, count(*) AS n FROM longer GROUP BY 1) c ON s.title_id = c.title_id LEFT JOIN longer x ON s.title_id = x.title_id",
    )
    o["extension_report"] = q(
        ext,
        "SELECT c.title_id, total_cues, coalesce(n, 0) AS extended_cues, coalesce(t, 0)::BIGINT AS total_extension_ms, round_even(t / n, 0)::BIGINT AS avg_extension_ms FROM (SELECT title_id, count(*) AS total_cues FROM en GROUP BY 1) c LEFT JOIN (SELECT title_id, count(*) AS n, sum(least(se + 100, mx) - e) AS t FROM la WHERE se > e AND least(se + 100, mx) - e > 50 GROUP BY 1) x ON c.title_id = x.title_id",
    )
    o["linger_comparison"] = q(f"{_ANALYZED}, {_AGAIN}", "SELECT title_id, sum(b)::BIGINT AS before, sum(1 - b)::BIGINT AS after, (2 * sum(b) - count(*))::BIGINT AS fixed FROM (SELECT title_id, 1 AS b FROM iss WHERE type = 'lingers_after_speech' UNION ALL SELECT title_id, 0 FROM iss2 WHERE type = 'lingers_after_speech') GROUP BY 1")
    o["vad_analyze"] = q(_ANALYZED, "SELECT * EXCLUDE (prev_end, next_start) FROM an")
    o["vad_issues"] = q(_ANALYZED, "SELECT * FROM iss")
    o["vad_summary"] = q(
        _ANALYZED,
        "SELECT a.title_id, count(*) AS analyzed, count(w) AS flagged, sum(start_delta_ms)::BIGINT AS start_delta_sum, min(start_delta_ms) AS start_delta_min, max(start_delta_ms) AS start_delta_max, round_even(sum(start_delta_ms) / count(start_delta_ms), 0)::BIGINT AS start_delta_avg, round_even(sum(end_delta_ms) / count(end_delta_ms), 0)::BIGINT AS end_delta_avg, count(*) FILTER (WHERE w = 3) AS high, count(*) FILTER (WHERE w = 2) AS medium, count(*) FILTER (WHERE w = 1) AS low, sum(end_delta_ms)::BIGINT AS end_delta_sum, min(end_delta_ms) AS end_delta_min, max(end_delta_ms) AS end_delta_max, count(*) FILTER (WHERE start_delta_ms BETWEEN 1 AND 200) AS ideal, count(*) FILTER (WHERE start_delta_ms <= 0) AS without, count(*) FILTER (WHERE m) AS missing "
        "FROM an a LEFT JOIN (SELECT title_id, pos, max(CASE severity WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS w, bool_or(type = 'missing_anticipation') AS m FROM iss GROUP BY 1, 2) i ON a.title_id = i.title_id AND a.pos = i.pos GROUP BY 1",
    )
    judged = _renamed(_rules().replace(_SWAPPED, "judged AS (SELECT title_id, pos, idx, start_ms, end_ms, text FROM finished)"), swapped="judged").replace("dur > 8000", "dur > 7000")
    o["finished_cues"] = q(_CHAIN, "SELECT * FROM finished")
    o["finish_summary"] = q(
        f"{_CHAIN}, {judged}",
        "SELECT f.*, coalesce(e, 0) AS error_count, coalesce(w, 0) AS warning_count, coalesce(e, 0) = 0 AS valid FROM (SELECT title_id, count(*) AS total_cues, sum(source_count)::BIGINT AS source_cues, count(source_count) AS output_cues, count(*) FILTER (WHERE source_count > 1) AS merges, count(*) FILTER (WHERE trim_ms > 0) AS trimmed, sum(trim_ms)::BIGINT AS total_trim_ms, count(*) FILTER (WHERE closed) AS closed, count(*) FILTER (WHERE extended) AS extended, count(*) FILTER (WHERE balance IN ('unbroken', 'fixed')) AS rebalanced, round_even(count(source_count) * 1000 / sum(source_count), 0)::BIGINT AS ratio_permille FROM finished GROUP BY 1) f "
        "LEFT JOIN (SELECT title_id, count(*) FILTER (WHERE severity = 'error') AS e, count(*) FILTER (WHERE severity = 'warning') AS w FROM rules GROUP BY 1) r ON f.title_id = r.title_id",
    )
    o["line_balance"] = q(_balance("cues"), "SELECT * FROM flaws")
    o["rebalance"] = q(_REBALANCED, "SELECT * FROM rebalanced")
    o["balance_summary"] = q(_REBALANCED, "SELECT title_id, count(*) AS flagged, count(*) FILTER (WHERE is_high) AS high, " + ", ".join(f"count(*) FILTER (WHERE outcome = '{x}') AS {x}" for x in ("unbroken", "fixed", "skipped_cps", "unfixable")) + " FROM rebalanced GROUP BY 1")
    o["aligned_groups"] = q(_GROUPS, "SELECT * FROM groups")
    o["group_categories"] = q(f"{_GROUPS}, {_CATS}", "SELECT title_id, group_key, category FROM cats")
    o["pair_stats"] = q(f"{_GROUPS}, {_CATS}", "SELECT 'mapping' AS kind, merge_type AS name, count(*) AS n FROM groups GROUP BY 2 UNION ALL SELECT 'category', category, count(*) FROM cats GROUP BY 2")
    o["pair_summary"] = q(_GROUPS, "SELECT title_id, sum(en_count)::BIGINT AS en_cues, sum(nl_count)::BIGINT AS nl_cues, count(*) AS groups, CASE WHEN sum(en_count) > 0 THEN round_even(sum(nl_count) * 1000 / sum(en_count), 0) ELSE 0 END::BIGINT AS ratio_permille FROM groups GROUP BY 1")
    o["pair_distribution"] = q(f"{_GROUPS}, {_CATS}", "SELECT *, round_even(n * 100 / (sum(n) FILTER (WHERE kind = 'mapping') OVER (PARTITION BY title_id)), 0)::BIGINT AS percent, row_number() OVER (PARTITION BY title_id, kind ORDER BY n DESC, name)::INT AS rank FROM (SELECT title_id, 'mapping' AS kind, merge_type AS name, count(*) AS n FROM groups GROUP BY 1, 3 UNION ALL SELECT title_id, 'category', category, count(*) FROM cats GROUP BY 1, 3)")
    def ranked(name: str, table: str, column: str) -> str:
        return f"SELECT '{name}' AS metric, count(*) AS n, min({column}) AS least, max({column}) AS greatest, sum({column})::BIGINT AS total, list_sort(list({column}))[count(*) // 2 + 1] AS upper_median, list_sort(list({column}))[(95 * count(*) + 99) // 100] AS p95 FROM {table}"

    o["catalogue_order_stats"] = q(f"{measured}, {_GROUPS}", ranked("condensation", "groups WHERE en_chars > 20 AND nl_chars > 0", "ratio") + " UNION ALL " + ranked("micro_cps", "ms WHERE micro_cps IS NOT NULL", "micro_cps"))
    o["condensation_stats"] = q(_GROUPS, "SELECT title_id, count(*)::INT AS n, (sum(ratio) // count(*))::BIGINT AS mean, list_sort(list(ratio))[count(*) // 2 + 1] AS median, min(ratio) AS least, max(ratio) AS greatest FROM groups WHERE en_chars > 20 AND nl_chars > 0 GROUP BY 1")
    order = "CASE WHEN category LIKE '%condensation%' OR category LIKE '%merge%' THEN ratio WHEN category = 'expansion' THEN -ratio ELSE 0 END"
    o["exemplars_topk"] = q(f"{_GROUPS}, {_CATS}", f"SELECT title_id, category, rank, group_key, ratio FROM (SELECT *, row_number() OVER (PARTITION BY title_id, category ORDER BY {order}, at_ms, group_key)::INT AS rank FROM (SELECT *, bool_or(category = 'dual-speaker') OVER (PARTITION BY title_id, group_key) AS dd FROM cats) WHERE (en_chars >= 15 OR dd) AND category <> 'register-mixed') WHERE rank <= 5")
    o["quality_log"] = q(
        f"{measured}, {_MERGED}, {_rules()}, vs AS ({stats}), mg AS ({merge_agg})",
        "SELECT metric, value::BIGINT AS value FROM (SELECT 'cps_max' AS metric, max(cps_max) AS value FROM vs UNION ALL SELECT 'cps_above_soft', sum(cps_above_soft) FROM vs UNION ALL SELECT 'cps_above_hard', sum(cps_above_hard) FROM vs UNION ALL SELECT 'cps_avg', sum(micro_cps) // count(micro_cps) FROM ms UNION ALL SELECT 'source_cues', sum(source_cues) FROM mg UNION ALL SELECT 'output_cues', sum(output_cues) FROM mg UNION ALL SELECT 'merge_permille', round_even(sum(output_cues) * 1000 / sum(source_cues), 0) FROM mg UNION ALL SELECT 'hard_errors', count(*) FILTER (WHERE severity = 'error') FROM rules)",
    )
    o["session_cues"] = "SELECT user_id, epoch_us(min(ts)) // 1000 AS start_ms, epoch_us(max(ts)) // 1000 + 1800000 AS end_ms, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, s"
    return o
