"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from orebelt.llm.host_rank import DAMPING, DISTRUST_SHARE, HREF, Rule

STEPS = 200

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (hex)
"""


def _host(url: str) -> str:
    rest = f"substr({url}, strpos({url}, '://') + 3)"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"CASE WHEN strpos({url}, '://') > 0 THEN {lower.format(f"regexp_extract({rest}, '^([^/?#]*)', 1)")} ELSE '' END"


def host_rank(rules: Sequence[Rule]) -> str:
    """So many steps of the propagation that no rank changes any more; the query stops a little earlier."""
    longest = sorted(rules, key=lambda r: -len(r.text))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    rule = " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in longest)
    verdict = " ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in longest)
    href = HREF.replace("'", "''")
    return f"""
WITH RECURSIVE parts AS (
  SELECT page_id, html, {_host('url')} AS host,
    CASE WHEN strpos(url, '://') > 0
      THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), ruled AS (
  SELECT page_id, html, host, path, CASE {rule} END AS rule FROM parts
), judged AS (SELECT *, CASE {verdict} END AS said FROM ruled),
hrefs AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS href FROM judged),
targets AS (SELECT src, 'x:' || regexp_extract(href, '(//.*)', 1) AS url FROM hrefs),
links AS (
  SELECT DISTINCT src, {_host('url')} AS dst FROM targets
  WHERE src <> '' AND {_host('url')} <> '' AND src <> {_host('url')}
), both_ways AS (
  SELECT 'trust' AS kind, src AS host, dst FROM links UNION ALL SELECT 'distrust', dst, src FROM links
), ways AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY kind, host) AS share FROM both_ways),
counts AS (
  SELECT CASE WHEN said = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n
  FROM judged WHERE said IS NOT NULL GROUP BY 1, 2
), seeds AS (SELECT kind, host, n::DOUBLE / sum(n) OVER (PARTITION BY kind) AS rank FROM counts),
ranks AS (
  SELECT 0 AS step, kind, host, rank FROM seeds
  UNION ALL
  SELECT step + 1, kind, host, sum(rank) FROM (
    SELECT step, kind, dst AS host, rank * share * {DAMPING} AS rank FROM ranks JOIN ways USING (kind, host)
    UNION ALL
    SELECT step, s.kind, s.host, s.rank * (1 - {DAMPING}) FROM seeds s, (SELECT max(step) AS step FROM ranks)
  ) WHERE step < {STEPS} GROUP BY step, kind, host
), sums AS (
  SELECT host, sum(CASE kind WHEN 'trust' THEN rank ELSE 0 END) AS t,
    sum(CASE kind WHEN 'distrust' THEN rank ELSE 0 END) AS d FROM ranks WHERE step = {STEPS} GROUP BY host
)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN d > {DISTRUST_SHARE} * (t + d) THEN 'block' END, 'allow') AS verdict
FROM judged LEFT JOIN sums USING (host)
"""


def mix(weights: Sequence[int], most: int, block_words: int, shard_words: int, shard_rows: int, seed: str) -> str:
    """Targets from a running sum over the sources by the level at which they stop; every quotient is ranked.

    The share of all words is 3 / 2.
    """
    draw = "md5(concat_ws(':', '{}', {}, {}))".format
    number = "('0x' || substr({}, 1, 8))::BIGINT".format
    seats = """
    SELECT grp, part, count(*) AS quota FROM (
      SELECT grp, part, seats, row_number() OVER (PARTITION BY grp ORDER BY votes / (2 * k + 1) DESC, part) AS place
      FROM (SELECT *, unnest(range(least(seats, ceil(votes / total * seats)::BIGINT + parts + 2))) AS k FROM (
        SELECT v.*, s.seats, sum(votes) OVER (PARTITION BY grp) AS total, count(*) OVER (PARTITION BY grp) AS parts
        FROM {votes} v JOIN {seats} s USING (grp)) WHERE votes > 0)
    ) WHERE place <= seats GROUP BY grp, part""".format
    return f"""
WITH sizes AS (
  SELECT doc_id AS id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents
), sources AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS number
  FROM (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sizes GROUP BY source)
), weighed AS (SELECT *, {list(weights)}[(number % {len(weights)} + 1)::INT] AS weight, {most} * source_size AS cap FROM sources),
stops AS (
  SELECT *, cap / weight AS stop,
    coalesce(sum(cap) OVER (ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY cap / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
    sum(source_size) OVER () AS words FROM weighed
), level AS (
  SELECT (3 * words - 2 * capped)::BIGINT AS up, (2 * free)::BIGINT AS down FROM stops
  WHERE (3 * words - 2 * capped) / (2 * free) <= stop ORDER BY stop LIMIT 1
), targets AS (
  SELECT source, source_size, n, number, CASE WHEN weight * up >= cap::HUGEINT * down THEN cap::DOUBLE
    ELSE (weight * up)::DOUBLE / down::DOUBLE END AS target FROM weighed, level
), votes AS (SELECT 0 AS grp, number AS part, target AS votes FROM targets),
all_seats AS (SELECT 0 AS grp, floor(sum(target) / {block_words} + 0.5)::BIGINT AS seats FROM targets),
quotas AS ({seats(votes='votes', seats='all_seats')}),
docs AS (
  SELECT s.*, t.source_size, target, number, {draw(seed, "coalesce(id::VARCHAR, '-')", 'size')} AS draw,
    ceil(greatest(source_size / {shard_words}, n / {shard_rows}))::BIGINT AS shards
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), dealt AS (SELECT *, {number('draw')} % shards AS shard FROM docs),
sums AS (SELECT number AS grp, shard AS part, sum(size)::BIGINT AS words, sum(size)::DOUBLE AS votes FROM dealt WHERE size > 0 GROUP BY ALL),
source_seats AS (SELECT part AS grp, quota AS seats FROM quotas),
shard_quotas AS ({seats(votes='sums', seats='source_seats')}),
cut AS (
  SELECT grp AS number, part AS shard, words, greatest(floor(words / {block_words} + 0.5)::BIGINT, 1) AS blocks,
    coalesce(quota, 0) AS quota FROM sums LEFT JOIN shard_quotas USING (grp, part)
), runs AS (
  SELECT *, least(quota, {most} * blocks) // blocks AS passes, least(quota, {most} * blocks) % blocks AS more,
    {number(draw(seed, 'number', 'shard'))} % blocks AS first FROM cut
), spans AS (
  SELECT number, shard, passes, first * {block_words} AS a,
    CASE WHEN first + more >= blocks THEN words ELSE (first + more) * {block_words} END AS b,
    CASE WHEN first + more > blocks THEN (first + more - blocks) * {block_words} ELSE 0 END AS c FROM runs
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY number, shard ORDER BY draw, id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM dealt WHERE size > 0
)
SELECT id AS doc_id, size::BIGINT AS size, source_size, target, (passes * size
    + greatest(least(c - start, size), 0)
    + greatest(least(b - start, size), 0) - greatest(least(a - start, size), 0))::BIGINT AS taken
FROM placed JOIN spans USING (number, shard)
UNION ALL SELECT id, size, source_size, target, 0 FROM dealt WHERE size = 0
"""


FILTER_AUDIT = """
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
words AS (
  SELECT d.*, first, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words
  FROM docs d JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)
), masks AS (
  SELECT part, good, toxic, (len(words) < 100)::INT
    + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * (doc_id > first)::INT AS mask FROM words
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT [a, b, c, d, e] AS bits, a.letter || b.letter || c.letter || d.letter || e.letter AS name FROM (
    SELECT a, b, c, d, e FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31)
), steps AS (
  SELECT name, s AS step, substr(name, s, 1) AS letter, bits[s].bit AS bit,
    coalesce(list_sum(list_transform(bits[1:s - 1], lambda x: x.bit)), 0)::INT AS earlier
  FROM orders, range(1, 6) r(s)
), sums AS (
  SELECT part, name, step, letter,
    sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, name, step, letter
)
SELECT part, name AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM sums
"""


def collocations(least: int, top: int) -> str:
    """All phrases of up to three words are counted."""
    return f"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (SELECT lang, unnest(regexp_extract_all(text, '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM docs),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS p FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), f AS (SELECT lang, p, size, count(*) AS a FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
candidates AS (SELECT *, string_split(p, ' ') AS w FROM f WHERE size > 1 AND a >= {least}),
longer AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS p, a FROM candidates WHERE size = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE size = 3
  ) GROUP BY lang, p
), parts AS (
  SELECT lang, p, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS second
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), cuts AS (
  SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM parts c JOIN f l ON l.lang = c.lang AND l.p = c.first JOIN f r ON r.lang = c.lang AND r.p = c.second
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), ranked AS (
  SELECT lang, p AS phrase, a, l, r, score FROM weakest LEFT JOIN longer USING (lang, p)
  WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN n USING (lang) QUALIFY rank <= {top}
"""
