"""DuckDB SQL with the rows of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# base32 has no function in DuckDB: the digest's hex digits are spelled out in
# bits, cut into fives and looked up in the alphabet.
ORACLE["op9_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS payload_bytes, upper(sha1(b)) AS hex FROM p
), bits AS (
  SELECT *, array_to_string([lpad(bin(('0x' || substr(hex, i + 1, 1))::INT), 4, '0') for i in range(40)], '') AS bit FROM d
), base AS (
  SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (16 * substr(bit, i * 5 + 1, 1)::INT + 8 * substr(bit, i * 5 + 2, 1)::INT + 4 * substr(bit, i * 5 + 3, 1)::INT
     + 2 * substr(bit, i * 5 + 4, 1)::INT + substr(bit, i * 5 + 5, 1)::INT) + 1, 1) for i in range(32)], '')
    AS payload_digest FROM bits
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS k,
         first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS f
  FROM base
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN f END AS refers_to
FROM ranked
"""


def _url_filter() -> str:
    """The two models level by level, their threshold and the verdicts."""
    from clipmart.llm import urlfilter as u

    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    rule = verdict = ""
    for v, host, path in sorted(u.RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        rule += f" WHEN {fits} THEN '{host}{path}'"
        verdict += f" WHEN {fits} THEN '{v}'"
    spot = lambda text: f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0)"
    substrings = lambda table, keep: f"""
  SELECT {keep}, substr(t, i, k) AS s
  FROM (SELECT *, text || chr(3) AS t FROM {table}) AS x,
       LATERAL (SELECT unnest(range(1, length(x.t) + 1)) AS i) AS starts, LATERAL (SELECT unnest(range(1, {u.ORDER + 2})) AS k) AS sizes
  WHERE i + k - 1 <= length(x.t)"""  # noqa: E731
    back = lambda t: f"ln({u.LAMBDA} / ({t} + {u.LAMBDA}))"
    p = lambda c: f"((c{c} + {u.LAMBDA} * q{c}) / (t{c} + {u.LAMBDA}))"
    levels = []
    for m in range(1, u.ORDER + 2):
        source = "SELECT *, 1 / 256.0::DOUBLE AS q0, 1 / 256.0::DOUBLE AS q1 FROM counts WHERE m = 1" if m == 1 else \
            f"SELECT c.*, b.p0 AS q0, b.p1 AS q1 FROM counts c JOIN level{m - 1} b ON b.s = substr(c.s, 2) WHERE c.m = {m}"
        levels.append(f"""level{m} AS MATERIALIZED (
  SELECT s, context, t0, t1, {p(0)} AS p0, {p(1)} AS p1,
         ln({p(0)}) - ln(q0) - {back('t0')} AS w0, ln({p(1)}) - ln(q1) - {back('t1')} AS w1 FROM ({source}))""")
    every = " UNION ALL ".join(f"SELECT * FROM level{m}" for m in range(1, u.ORDER + 2))
    return f"""
WITH urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{parts}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '{parts}', 2), '') AS path, row_number() OVER () AS n FROM pages
), judged AS (
  SELECT *, host || path AS text, CASE{rule} END AS rule, CASE{verdict} END AS ruled FROM urls
), known AS (
  SELECT DISTINCT text, ruled FROM judged WHERE ruled IS NOT NULL
), few AS MATERIALIZED (
  SELECT text, (ruled = 'allow')::INT AS ok, {spot("text || '|split'")} * {u.CALIBRATION} < 1 AS held FROM known
), train AS (SELECT * FROM few WHERE NOT held),
kept AS (
  SELECT s, sum(ok)::BIGINT AS c1, sum(1 - ok)::BIGINT AS c0 FROM ({substrings('train', 'ok')}) GROUP BY s
  HAVING length(s) < 3 OR count(*) >= {u.LEAST}
), counts AS MATERIALIZED (
  SELECT *, sum(c0) OVER w AS t0, sum(c1) OVER w AS t1
  FROM (SELECT *, length(s) AS m, substr(s, 1, length(s) - 1) AS context FROM kept) WINDOW w AS (PARTITION BY m, context)
), {', '.join(levels)},
model AS MATERIALIZED (
  SELECT s, sum(w) AS w FROM (
    SELECT s, w1 - w0 AS w FROM ({every})
    UNION ALL
    SELECT context, {back('max(t1)')} - {back('max(t0)')} FROM ({every}) GROUP BY context) GROUP BY s
), constant AS (SELECT coalesce(max(w), 0) AS w FROM model WHERE s = ''),
lookups AS (
  SELECT text, sum(coalesce(w, 0)) / (length(text) + 1) + (SELECT w FROM constant) AS score
  FROM ({substrings("(SELECT DISTINCT text FROM judged)", 'text')}) LEFT JOIN model USING (s) GROUP BY text
), bins AS (
  SELECT round(score * {u.BINS}) AS bin, sum(ok) AS good, sum(1 - ok) AS bad
  FROM few JOIN lookups USING (text) WHERE held GROUP BY 1
), edges AS (
  SELECT (coalesce(lag(bin) OVER o, bin - 1) + bin) / 2 AS edge FROM bins WINDOW o AS (ORDER BY bin)
  UNION ALL SELECT max(bin) + 1 FROM bins
), choices AS (
  SELECT edge, row_number() OVER (ORDER BY edge) - 1 AS k, count(*) OVER () AS n
  FROM (SELECT edge, coalesce(value, 0) AS value, max(coalesce(value, 0)) OVER () AS best FROM (
          SELECT edge, coalesce((SELECT sum(good) FROM bins WHERE bin > edge), 0) / (SELECT sum(good) FROM bins)
                     + coalesce((SELECT sum(bad) FROM bins WHERE bin < edge), 0) / (SELECT sum(bad) FROM bins) AS value
          FROM edges WHERE edge IS NOT NULL))
  WHERE value >= best - 1e-12
), threshold AS (
  SELECT CASE WHEN (SELECT least(sum(good), sum(bad)) FROM bins) > 0
              THEN coalesce((SELECT edge FROM choices WHERE k = n // 2), 0) / {u.BINS}.0 ELSE 0 END AS t
)
SELECT j.page_id, j.host, j.path, j.rule,
       CASE WHEN j.ruled IS NOT NULL THEN j.ruled
            WHEN (SELECT count(DISTINCT ruled) FROM known) < 2 THEN 'allow'
            WHEN l.score >= (SELECT t FROM threshold) THEN 'allow' ELSE 'block' END AS verdict
FROM judged j JOIN lookups l USING (text)
"""


ORACLE["op1_url_filter"] = _url_filter()
