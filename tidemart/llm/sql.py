"""SQL that gives the rows of the operators' queries, where SQL can express them."""

from __future__ import annotations

from functools import reduce

from tidemart.llm import collocations, decontaminate, secrets, warc


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def decontaminated(size: int = decontaminate.WINDOW) -> str:
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
b AS (SELECT DISTINCT item_id, w, least(len(w), {size}) AS size
      FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
          FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT size FROM grams),
windows AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT r, i, size, item_id FROM windows JOIN grams USING (size, gram)),
touched AS (SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN touched USING (r) LEFT JOIN items USING (r)"""


def _found(kind: int, pattern: str, test: str = "true") -> str:
    p = _quoted(pattern)
    return f"""SELECT r, {kind} AS kind, x.s AS start, x.s + length(x.m) AS "end" FROM (
  SELECT r, unnest([{{'m': ms[i], 's': coalesce(list_sum([length(g) FOR g IN gs[1:i]]), 0)
      + coalesce(list_sum([length(m) FOR m IN ms[1:i - 1]]), 0)}} FOR i IN range(1, len(ms) + 1)]) AS x
  FROM (SELECT r, regexp_extract_all(t, {p}) AS ms, string_split_regex(t, {p}) AS gs FROM d
        WHERE regexp_matches(t, {p}))) WHERE {test}"""


def secrets_found(reach: int = secrets.REACH) -> str:
    tests = {
        "assign": f"length(regexp_extract(x.m, {_quoted(secrets.ASSIGN)}, 2)) >= 12",
        "bare": "regexp_matches(x.m, '[0-9]') AND regexp_matches(x.m, '[A-Z]') AND regexp_matches(x.m, '[a-z]')",
    }
    patterns = {
        "assign": secrets.ASSIGN, "access": secrets.ACCESS, "hex": secrets.HEX,
        "ident": secrets.IDENT, "bare": secrets.BARE, "endpoint": secrets.ENDPOINT,
    }
    parts = "\nUNION ALL\n".join(_found(secrets.KINDS.index(k), p, tests.get(k, "true")) for k, p in patterns.items())
    needs = ", ".join(
        f"({secrets.KINDS.index(k)}, {secrets.KINDS.index(n)})" for k, v in secrets.NEEDS.items() for n in v
    )
    names = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    label = f"{names}[kind + 1] || ':' || start || ':' || \"end\""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({parts}),
borders AS ({_found(-1, secrets.SCOPE)}),
scoped AS (SELECT p.*, (SELECT count(*) FROM borders b WHERE b.r = p.r AND b."end" <= p.start) AS scope FROM parts p),
needs(kind, other) AS (VALUES {needs}),
joined AS (SELECT DISTINCT w.r, w.kind, w.start, w."end" FROM scoped w JOIN needs n ON n.kind = w.kind
  JOIN scoped o ON o.r = w.r AND o.scope = w.scope AND o.kind = n.other AND abs(o.start - w.start) <= {reach}
  AND (o."end" <= w.start OR w."end" <= o.start)),
spans AS (SELECT r, kind, start, "end" FROM parts WHERE kind < 3 UNION ALL SELECT * FROM joined),
listed AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
  string_agg({label}, ',' ORDER BY start, kind, "end") FILTER (kind < 3) AS base,
  string_agg({label}, ',' ORDER BY start, kind, "end") AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)"""


def _urn(seed: str) -> str:
    h = f"sha256({seed})"
    parts = [f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return "'<urn:uuid:' || " + " || '-' || ".join(parts) + " || '>'"


def warc_derivatives() -> str:
    line = _quoted(warc.LINE)
    text = reduce(lambda t, s: f"regexp_replace({t}, {_quoted(s[0])}, {_quoted(s[1])}, 'g')", warc.STEPS, "payload")
    title = f"regexp_replace(regexp_extract(payload, {_quoted(warc.TITLE)}, 1), '[\\x20\\x09\\x0A\\x0D]+', ' ', 'g')"
    columns = "page_id, {kind} AS warc_type, {own} AS record_id, response_id AS refers_to, uri AS target_uri, source AS " \
              "payload_digest, {media} AS media, {block} AS block"
    conversion = columns.format(kind="'conversion'", own="conversion", media="'text/plain; charset=utf-8'", block="body")
    fields = f" || {line} || ".join([
        f"'title: ' || {title}",
        f"'links: ' || len(regexp_extract_all(payload, {_quoted(warc.LINK)}))",
        "'text-characters: ' || length(body)", "'conversion-record: ' || conversion", "'source-payload-digest: ' || source",
        "'source-header: HTTP/1.1 200 OK'", "'source-header: Content-Type: text/html; charset=utf-8'",
        "'source-header: Content-Length: ' || octet_length(encode(payload))", "''",
    ])
    metadata = columns.format(kind="'metadata'", own="metadata", media="'application/warc-fields'", block=fields)
    header = f" || {line} || ".join([
        _quoted(warc.VERSION), "'WARC-Type: ' || warc_type", "'WARC-Record-ID: ' || record_id", "'WARC-Refers-To: ' || refers_to",
        "'WARC-Target-URI: ' || target_uri", _quoted(f"WARC-Date: {warc.DATE}"),
        "'WARC-Refers-To-Payload-Digest: ' || payload_digest", "'WARC-Block-Digest: ' || block_digest",
        "'Content-Type: ' || media", "'Content-Length: ' || content_length", "''", "''",
    ])
    return f"""
WITH r AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS payload FROM pages),
i AS (SELECT *, {_urn("coalesce(CAST(page_id AS VARCHAR), '') || ' ' || uri")} AS response_id FROM r),
t AS (SELECT *, {_urn("response_id || ' conversion'")} AS conversion, {_urn("response_id || ' metadata'")} AS metadata,
  'sha256:' || sha256(payload) AS source, {text} AS body FROM i),
b AS (SELECT {conversion} FROM t UNION ALL SELECT {metadata} FROM t),
d AS (SELECT *, 'sha256:' || sha256(block) AS block_digest, octet_length(encode(block))::BIGINT AS content_length FROM b)
SELECT page_id, warc_type, record_id, refers_to, target_uri, payload_digest, block_digest, content_length,
  {header} AS header, block FROM d"""


def phrases(least: int = collocations.LEAST, top: int = collocations.TOP, percent: int = collocations.SUBSUMED_PERCENT) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
  SELECT coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang, unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents)),
words AS (SELECT lang, first, lead(first) OVER next AS second, lead(first, 2) OVER next AS third
  FROM (SELECT lang, p, unnest(w) AS first, generate_subscripts(w, 1) AS i FROM pieces)
  WINDOW next AS (PARTITION BY p ORDER BY i)),
f AS (SELECT lang, 1 AS size, first AS phrase, count(*) AS f FROM words GROUP BY ALL
  UNION ALL SELECT lang, 2, first || ' ' || second, count(*) FROM words WHERE second IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, first || ' ' || second || ' ' || third, count(*) FROM words WHERE third IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {least}),
parts AS MATERIALIZED (SELECT lang, phrase, a, cut, array_to_string(w[:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM c)),
heads AS MATERIALIZED (SELECT parts.*, f AS l FROM parts JOIN f ON f.lang = parts.lang AND f.phrase = head),
cuts AS (SELECT heads.lang, heads.phrase, a, cut, l, f AS r, 1000000::HUGEINT * a * a // (l::HUGEINT * f) AS score
  FROM heads JOIN f ON f.lang = heads.lang AND f.phrase = tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
subsumed AS (SELECT DISTINCT c.lang, c.phrase FROM c
  JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE size = 3) AS longer
    ON longer.lang = c.lang AND longer.part = c.phrase WHERE 100 * longer.a >= {percent} * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN subsumed USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""
