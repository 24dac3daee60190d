"""SQL for the operators it can express."""

from __future__ import annotations

from flowlens.llm import audit, lines, mixing, quality

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def dropped_lines(table: str) -> str:
    """CTEs that end in `cleaned`: rid, text, n_lines, n_dropped of every row of `table` (rid, source, text)."""
    return rf"""
pages AS (SELECT coalesce(source, '') AS site, source IS NULL AS no_site, count(*) AS total FROM {table} GROUP BY ALL),
lines AS (
  SELECT rid, coalesce(source, '') AS site, source IS NULL AS no_site, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM {table} WHERE text IS NOT NULL),
often AS (
  SELECT site, no_site, line
  FROM (SELECT DISTINCT rid, site, no_site, line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))
  JOIN pages USING (site, no_site)
  GROUP BY site, no_site, line, total HAVING count(*) >= {lines.MIN_PAGES} AND count(*) > {lines.RATIO} * total),
marked AS (
  SELECT l.*, o.line IS NOT NULL AS dropped
  FROM lines l LEFT JOIN often o ON l.site = o.site AND l.no_site = o.no_site AND l.line = o.line),
joined AS (
  SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '') AS text, count(*) AS n_lines,
    count(*) FILTER (dropped) AS n_dropped
  FROM marked GROUP BY rid),
cleaned AS (
  SELECT rid, joined.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
  FROM (SELECT rid FROM {table}) LEFT JOIN joined USING (rid))"""


def judged(table: str) -> str:
    """CTEs that end in `verdicts`: rid, the base counts, base_failed and kept of every row of `table` (rid, text)."""
    newlines = "len(text) - len(replace(text, chr(10), ''))"
    return rf"""
worded AS (SELECT rid, text, {WORDS} AS ws, string_split(coalesce(text, ''), chr(10)) AS ls FROM {table}),
windows AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM worded)),
again AS (SELECT rid, k FROM windows GROUP BY rid, k HAVING count(*) > 1),
repeats AS (
  SELECT rid, count(DISTINCT i + j) AS n
  FROM windows JOIN again USING (rid, k), (SELECT unnest(range(0, 3)) AS j) GROUP BY rid),
counted AS (
  SELECT rid, coalesce(text, '') AS text, len(ws) AS n_words,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM worded LEFT JOIN repeats USING (rid)),
verdicts AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words
      OR word_chars < 2 * n_words OR word_chars > 20 * n_words
      OR 10 * n_symbols > 3 * n_words
      OR (n_dup_lines > 4 AND 2 * n_dup_lines > {newlines} + 1)
      OR 10 * len(regexp_extract_all(text, '(?m)^[ \t]*[-*\x{{2022}}]')) > 9 * ({newlines} + 1)
      OR 10 * len(regexp_extract_all(text, '(?m)(\.\.\.|\x{{2026}})[ \t]*$')) > 6 * ({newlines} + 1)
      OR 2 * len(regexp_extract_all(text, '\p{{L}}')) < word_chars
      OR 5 * len(regexp_extract_all(text, '[0-9]')) > 2 * word_chars) AS kept
  FROM counted)"""


def mixed(table: str) -> str:
    """CTEs that end in `chosen`: rid, size, source_size, target, copies of every row of `table` (rid, doc_id, source, text)."""
    turns = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    start = (
        f"md5(concat('{mixing.SEED}', CASE WHEN source IS NULL THEN ':n:' ELSE ':s:' END, coalesce(source, '')))[1:8]"
    )
    return f"""
sized AS (SELECT rid, doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM {table}),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(mixing.WEIGHTS)} {turns} END AS weight FROM sums),
roomy AS (SELECT *, CAST({mixing.CAP} * source_size AS DOUBLE) / CAST(weight AS DOUBLE) AS room FROM weighed),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - sum({mixing.CAP} * source_size) OVER w + {mixing.CAP} * source_size AS DOUBLE)
    / CAST(sum(weight) OVER () - sum(weight) OVER w + weight AS DOUBLE) AS level
  FROM roomy
  WINDOW w AS (ORDER BY room, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
aims AS (
  SELECT source, source_size, least(CAST({mixing.CAP} * source_size AS DOUBLE), max(level) OVER () * weight) AS target,
    CAST(('0x' || {start}) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS start
  FROM levels),
ranked AS (
  SELECT s.*, a.source_size, a.target, a.start, row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) - 1 AS rank,
    CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0 END AS rate
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
chosen AS (
  SELECT rid, doc_id, size, source_size, target,
    CAST(floor((rank + 1) * rate + start) - floor(rank * rate + start) AS BIGINT) AS copies
  FROM ranked)"""


def _audit() -> str:
    earlier = " + ".join(f"CASE WHEN contains(left(filter_order, step - 1), '{f}') THEN {1 << i} ELSE 0 END" for i, f in enumerate(audit.FILTERS))
    letters = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(audit.FILTERS))
    return rf"""WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
      + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
      + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
      + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
counts AS (SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL),
filters(f, bit) AS (VALUES {letters}),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, bit,
    {earlier} AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step) JOIN filters ON f = filter_order[step]),
sums AS (
  SELECT part, filter_order, step, letter,
    CAST(coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit != 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (mask & earlier != 0 AND mask & bit != 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit != 0 AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit != 0 AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, letter)
SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM sums"""


def _turns() -> str:
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, i: xor(z >> 1, (z & 1) * 3988292384))"
    codes = "list_transform(string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    crc = f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {codes}, lambda c, b: {byte}), 4294967295)"
    other = "CASE WHEN initial = '{}' THEN 0 ELSE 1 END + extra"
    user, assistant = other.format("u"), other.format("a")
    return rf"""WITH RECURSIVE
hurt AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS what FROM conversations),
rows AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, k,
    CASE WHEN what = 1 THEN '' WHEN what = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hurt, (VALUES (1), (2)) copies(k) WHERE what != 0 AND (k = 1 OR what = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), k) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, k) > 1 AS seen,
    left(role, 1) AS initial
  FROM rows),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed),
signs AS (
  SELECT conv_id, i, role, text, initial, fault IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra
  FROM faults),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faults GROUP BY conv_id),
back AS (
  SELECT conv_id, n + 1 AS i, [0, 10, 5, 0] AS v FROM facts
  UNION ALL
  SELECT conv_id, i, [least(w[1], 5 + w[3], 10 + w[4]), least(w[2], 5 + w[3], 10 + w[4]), least(w[3], 5 + w[4]), least(w[4], 5 + w[3])]
  FROM (
    SELECT s.conv_id, s.i, CASE WHEN goes THEN [2 + v[1], 2 + v[2], 2 + v[3], 2 + v[4]] ELSE [
      least(2 + v[1], {user} + v[3], CASE WHEN initial = 's' THEN extra + v[2] END),
      least(2 + v[2], {user} + v[3]), least(2 + v[3], {assistant} + v[4]), least(2 + v[4], {user} + v[3])] END AS w
    FROM back b JOIN signs s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i - 1)),
known AS (
  SELECT s.*, here.v AS here, behind.v AS behind
  FROM signs s JOIN back here ON here.conv_id IS NOT DISTINCT FROM s.conv_id AND here.i = s.i
  JOIN back behind ON behind.conv_id IS NOT DISTINCT FROM s.conv_id AND behind.i = s.i + 1),
walk AS (
  SELECT conv_id, n, CAST(1 AS BIGINT) AS i, 0 AS state, '' AS audit, CAST([] AS VARCHAR[]) AS kept FROM facts
  UNION ALL
  SELECT conv_id, n, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
    CASE edit WHEN 'D' THEN state WHEN 'K' THEN CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE next END,
    audit || edit,
    CASE edit WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, role || ':' || text)
      ELSE list_append(kept, CASE next WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END) END
  FROM (
    SELECT *, CASE WHEN i > n THEN 'I'
      WHEN 2 + behind[state + 1] = here[state + 1] THEN 'D'
      WHEN 5 + here[next + 1] = here[state + 1] THEN 'I'
      WHEN state = 0 AND initial = 's' AND extra + behind[2] = here[1] THEN 'K'
      WHEN initial = CASE next WHEN 2 THEN 'u' ELSE 'a' END THEN 'K'
      ELSE 'R' END AS edit
    FROM (
      SELECT w.*, CASE WHEN state = 2 THEN 3 ELSE 2 END AS next, initial, extra, role, text, here, behind
      FROM walk w LEFT JOIN known k ON k.conv_id IS NOT DISTINCT FROM w.conv_id AND k.i = w.i)
    WHERE i <= n OR state IN (1, 2))),
ended AS (SELECT * FROM walk WHERE i > n AND state IN (0, 3))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.v[1], 0) AS BIGINT) AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = 1
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""


NUMBERED = "d AS (SELECT row_number() OVER () AS rid, * FROM documents)"

SQL = {
    "op4_line_dedup": f"""WITH {NUMBERED},{dropped_lines("d")}
SELECT doc_id, c.text, c.n_lines, c.n_dropped FROM d JOIN cleaned c USING (rid)""",
    "op6_quality_rules": f"""WITH {NUMBERED},{judged("d")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM d JOIN verdicts USING (rid)""",
    "op10_mixing": f"""WITH {NUMBERED},{mixed("d")}
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM chosen""",
    "op11_filter_audit": _audit(),
    "op13_conversations": _turns(),
}
