"""SQL for the registered queries, written independently of the operators."""

from __future__ import annotations

from webcorpus.plans.queries import (
    DEPTH,
    DOMAINS,
    GUARD,
    HREFS,
    LINK_SKIP,
    MAX_LENGTH,
    OVERLAP,
    SIZE,
    SKIP,
    TEXT_LIMIT,
)

STEP = SIZE - OVERLAP


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def scheme(u: str) -> str:
    return f"regexp_extract({u}, '^([a-z]+):', 1)"


def netloc(u: str) -> str:
    return f"regexp_extract({u}, '^[a-z]+://([^/?#]*)', 1)"


def path(u: str) -> str:
    return f"regexp_extract({u}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


def uquery(u: str) -> str:
    return f"regexp_extract({u}, '^[^?#]*[?]([^#]*)', 1)"


def fragment(u: str) -> str:
    return f"regexp_extract({u}, '#(.*)$', 1)"


def host(u: str) -> str:
    return f"replace(lower({netloc(u)}), 'www.', '')"


def norm(u: str) -> str:
    return f"('https://' || {host(u)} || rtrim(regexp_replace({path(u)}, ';[^/]*$', ''), '/'))"


def slug(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '[^A-Za-z0-9]+', '_', 'g'), '_'))"


def stem(u: str) -> str:
    return (
        f"({slug(f'''CASE WHEN {path(u)} = '' THEN 'root' ELSE {path(u)} END''')}"
        f" || CASE WHEN {fragment(u)} <> '' THEN '_' || {slug(fragment(u))} ELSE '' END)"
    )


def url_hash(u: str) -> str:
    return (
        f"md5({scheme(u)} || '://' || {host(u)} || rtrim({path(u)}, '/')"
        f" || '#' || {fragment(u)})"
    )


def base(u: str) -> str:
    name = f"regexp_extract({path(u)}, '([^/]*)$', 1)"
    return (
        f"(CASE WHEN {name} NOT LIKE '%.%' AND {path(u)} NOT LIKE '%/'"
        f" THEN rtrim({u}, '/') || '/' ELSE {u} END)"
    )


def skipped(u: str, patterns=SKIP) -> str:
    found = " OR ".join(f"regexp_matches({u}, '{p}')" for p in patterns)
    return f"({scheme(u)} NOT IN ('http', 'https') OR {found})"


def allowed(h: str) -> str:
    return "(" + " OR ".join(f"{h} = '{d}' OR {h} LIKE '%.{d}'" for d in DOMAINS) + ")"


def _entities(x: str) -> str:
    for entity, char in (
        ("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", " "),
        ("copy", "©"), ("middot", "·"), ("amp", "&"),
    ):
        x = f"regexp_replace({x}, '&{entity};?', '{char}', 'g')"
    return x


_HREFS = f"""
hrefs AS (
  SELECT DISTINCT page_id, url, {_entities("unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))")} AS href
  FROM pages)"""

# A site-relative href in normal form: only the path counts.
_HREF_PATH = "rtrim(regexp_replace(regexp_extract(href, '^([^?#]*)', 1), ';[^/]*$', ''), '/')"
_LINKS = f"""{_HREFS},
links AS (
  SELECT DISTINCT page_id, url AS src_url, {norm("url")} AS src_norm,
         'https://' || {host("url")} || {_HREF_PATH} AS dst_url
  FROM hrefs WHERE href <> '')"""

_DOCS = """docs AS (
  SELECT doc_id, 'https://corpus.example/' || source || '/' || doc_id AS url, text,
         'v' || (doc_id % 3) AS last_modified
  FROM documents)"""

_TOKEN = r"[^ \t\n\f\r]+[ \t\n\f\r]*|^[ \t\n\f\r]+"


def windows(source: str, keys: str) -> str:
    """windows(keys, chunk_index, chunk_total, content) over `text` of a relation."""
    return f"""
tokens AS (SELECT {keys}, regexp_extract_all(text, '{_TOKEN}') AS t FROM {source}),
numbered AS (
  SELECT *, ((len(t) + {STEP - 1}) // {STEP})::INTEGER AS chunk_total,
         unnest(range(1, (len(t) + {STEP - 1}) // {STEP} + 1))::INTEGER AS chunk_index
  FROM tokens),
windows AS (
  SELECT {keys}, chunk_index, chunk_total,
         array_to_string(t[(chunk_index - 1) * {STEP} + 1 : (chunk_index - 1) * {STEP} + {SIZE}], '') AS content
  FROM numbered)"""


def chunked(source: str) -> str:
    """chunks: records of a relation (url, text, last_modified)."""
    return f"""{windows(source, "url, last_modified")},
chunks AS (
  SELECT {stem("url")} || '_' || chunk_index || '_' || {url_hash("url")} || '.json' AS blob_name,
         url, {slug(path("url"))} AS title, chunk_index, chunk_total, content, last_modified
  FROM windows WHERE regexp_matches(content, '[^ \\t\\n\\f\\r]'))"""


_CHUNKS = f"WITH {_DOCS}, {chunked('docs')}"
_STORE = """
store AS (
  SELECT * REPLACE (CASE WHEN chunk_index % 3 = 1 THEN last_modified ELSE 'v-old' END AS last_modified)
  FROM chunks WHERE chunk_index % 3 <> 2
  UNION ALL
  SELECT * REPLACE ('stale_' || blob_name AS blob_name) FROM chunks WHERE chunk_index = 1),
actions AS (
  SELECT c.*, CASE WHEN s.blob_name IS NULL THEN 'insert'
                   WHEN c.last_modified = s.last_modified AND c.last_modified <> '' THEN 'skip'
                   ELSE 'update' END AS action
  FROM chunks c LEFT JOIN store s USING (blob_name))"""
_MERGED = f"""{_CHUNKS}, {_STORE}
SELECT * EXCLUDE (action) FROM actions WHERE action <> 'skip'
UNION ALL
SELECT * FROM store WHERE blob_name NOT IN (SELECT blob_name FROM actions WHERE action <> 'skip')"""


def line_filter(source: str, key: str, sequence: str = "") -> str:
    """lines: lines of `text` with `opens`, and the state before each line."""
    order = f"{sequence}, pos" if sequence else "pos"
    extra = f"{sequence}, " if sequence else ""
    return f"""
split_lines AS (
  SELECT {key}, {extra}unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM {source}),
events AS (
  SELECT *, CASE
    WHEN contains(lower(line), 'select language') OR (length(line) > 40 AND
         len(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: length(w) > 5)) > 4) THEN 1
    WHEN contains(lower(line), 'powered by translate') OR trim(line) = '' THEN -1 END AS event
  FROM split_lines),
states AS (
  SELECT *, last_value(event IGNORE NULLS) OVER (
    PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state
  FROM events),
kept AS (
  SELECT {key}, string_agg(line, chr(10) ORDER BY {order}) AS filtered
  FROM states WHERE coalesce(event, 0) <> 1 AND coalesce(state, -1) <> 1 GROUP BY {key})"""


_ARTICLES = f"""
bodies AS (
  SELECT page_id, url, regexp_extract(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
         '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
nodes AS (
  SELECT page_id, url, list_filter(list_transform(
      string_split({_entities("regexp_replace(body, '<[^>]*>', chr(1), 'g')")}, chr(1)),
      lambda n: trim(n, chr(32) || chr(10) || chr(9) || chr(13))), lambda n: n <> '') AS n
  FROM bodies),
articles AS (SELECT page_id, url, array_to_string(n, chr(10)) AS text FROM nodes)"""

_MAIN = f"""{_ARTICLES}, {line_filter("articles", "page_id")},
cleaned AS (
  SELECT page_id, url, CASE WHEN length(trim(coalesce(filtered, ''), chr(32) || chr(10))) > 200
         THEN trim(filtered, chr(32) || chr(10)) ELSE text END AS text
  FROM articles LEFT JOIN kept USING (page_id))"""


def truncated(text: str, limit: int) -> str:
    head = f"left({text}, {limit})"
    cut = f"regexp_extract({head}, '(?s)^(.+[. \\n])', 1)"
    return (
        f"CASE WHEN length({text}) <= {limit} THEN {text} WHEN {cut} <> ''"
        f" THEN trim({cut}, chr(32) || chr(10)) ELSE {head} END"
    )


_MAIN_WHOLE = f"WITH {_MAIN} SELECT page_id, text FROM cleaned"

_ATTEMPTS = """attempts AS (
  SELECT 'https://fetch.example/' || event_type || '/' || (event_id // 3) AS url,
         (event_id % 3 + 1)::INTEGER AS attempt,
         CASE WHEN event_id % 13 < 5 THEN 200 WHEN event_id % 13 = 5 THEN 404
              WHEN event_id % 13 = 6 THEN 403 WHEN event_id % 13 < 9 THEN 429
              WHEN event_id % 13 < 11 THEN 503 END::INTEGER AS status,
         CASE WHEN event_id % 4 = 0 THEN 'text/html' ELSE 'application/PDF' END AS content_type,
         CASE WHEN event_id % 13 >= 11 THEN 'timed out' END AS error
  FROM events)"""


def outcomes(limit: int) -> str:
    return f"""{_ATTEMPTS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY attempt) AS rn FROM attempts
  WHERE error IS NULL AND status <> 429 AND status < 500 AND attempt <= {limit}),
outcomes AS (
  SELECT u.url, attempt, status,
         CASE WHEN status IS NULL THEN 'failure' WHEN status = 404 THEN 'not_found'
              WHEN status >= 400 THEN 'failure' ELSE 'ok' END AS outcome,
         CASE WHEN status IS NULL THEN 'All fetch attempts failed or invalid HTML'
              WHEN status <> 404 AND status >= 400 THEN 'HTTP ' || status END AS reason
  FROM (SELECT DISTINCT url FROM attempts) u LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) r USING (url))"""


_GRAPH = f"""{_LINKS},
named AS (SELECT page_id, url, {norm("url")} AS norm_url FROM pages),
total AS (SELECT count(*) AS n FROM pages),
edges AS (
  SELECT a.norm_url AS src, b.norm_url AS dst
  FROM named a, total, named b
  WHERE b.page_id IN ((2 * a.page_id + 1) % n, (3 * a.page_id + 2) % n)
  UNION SELECT src_norm, dst_url FROM links),
roots AS (
  SELECT {norm("seed")} AS norm_url FROM (
    SELECT min(url) AS seed FROM pages GROUP BY {host("url")})),
walk AS (
  SELECT norm_url, 0 AS depth FROM roots
  UNION
  SELECT dst, depth + 1 FROM walk JOIN edges ON src = norm_url
  WHERE depth <= {DEPTH} AND NOT {skipped("norm_url")}),
frontier AS (
  SELECT norm_url, min(depth)::INTEGER AS depth,
         min(depth) <= {DEPTH} AND NOT {skipped("norm_url")} AS processed
  FROM walk GROUP BY norm_url)"""



def queue_levels() -> str:
    """CTEs level_0 .. of a walk over the numbered page graph in queue order."""
    out = f"""
named AS (SELECT page_id, url, {norm("url")} AS norm_url FROM pages),
total AS (SELECT count(*) AS n FROM pages),
level_0 AS (
  SELECT norm_url, min(url) AS url, 0 AS depth, row_number() OVER (ORDER BY min(url)) - 1 AS rank,
         NOT {skipped("norm_url")} AS processed
  FROM (SELECT seed AS url, {norm("seed")} AS norm_url FROM (
    SELECT min(url) AS seed FROM pages GROUP BY {host("url")})) GROUP BY norm_url)"""
    known = "SELECT norm_url, rank FROM level_0"
    for depth in range(1, DEPTH + 2):
        out += f""",
chosen_{depth} AS (
  SELECT rank, page_id FROM level_{depth - 1} AS l JOIN named AS p USING (norm_url) WHERE processed
  QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY p.url <> l.url, p.url) = 1),
found_{depth} AS (
  SELECT c.rank, 0 AS pos, t.* FROM chosen_{depth} AS c, total, named AS t WHERE t.page_id = (2 * c.page_id + 1) % n
  UNION ALL
  SELECT c.rank, 1, t.* FROM chosen_{depth} AS c, total, named AS t WHERE t.page_id = (3 * c.page_id + 2) % n),
first_{depth} AS (
  SELECT norm_url, url, rank, pos FROM found_{depth} WHERE norm_url NOT IN (SELECT norm_url FROM ({known}))
  QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY rank, pos, url) = 1),
level_{depth} AS (
  SELECT norm_url, url, {depth} AS depth,
    (SELECT count(*) FROM ({known})) + row_number() OVER (ORDER BY rank, pos, url) - 1 AS rank,
    {depth <= DEPTH} AND NOT {skipped("norm_url")} AS processed
  FROM first_{depth})"""
        known += f" UNION ALL SELECT norm_url, rank FROM level_{depth}"
    return out


_ROBOTS = f"""
robots AS (
  SELECT 'https://' || host AS base,
    CASE length(host) % 6 WHEN 0 THEN 404 WHEN 1 THEN 403 WHEN 2 THEN NULL WHEN 3 THEN 503 ELSE 200 END AS status,
    [['blank', '', ''], ['agent', 'OtherBot', ''], ['rule', 'f', '/'], ['blank', '', ''],
     ['agent', 'Mozilla', ''], ['agent', 'second', ''], ['rule', '', ''], ['rule', 't', '/en/' || low],
     ['rule', 'f', '/en/'], ['rule', 'f', '/de/' || high]] AS head,
    length(host) % 2 = 0 AS late
  FROM (SELECT {host("url")} AS host, min(regexp_extract(url, '/([0-9]+)', 1)) AS low,
               max(regexp_extract(url, '/([0-9]+)', 1)) AS high FROM pages GROUP BY 1)),
rules AS (
  SELECT base, unnest([1, 2, 2, 2, 2, 3]) AS group_no,
    unnest(['OtherBot', 'Mozilla second', 'Mozilla second', 'Mozilla second', 'Mozilla second', '*']) AS agents,
    unnest([2, 6, 7, 8, 9, 14]) AS rule_no,
    unnest([false, NULL, true, false, false, false]) AS allow,
    unnest(['/', NULL, head[8][3], '/en/', head[10][3], '/fr/']) AS prefix
  FROM robots WHERE status = 200
  UNION ALL
  SELECT base, 4, 'late', 16, true, '' FROM robots WHERE status = 200 AND late)"""

_CONV = "conv_id AS url"

_PDF = f"'https://' || {host('url')} || '/files/' || page_id || '.pdf'"
# A whole run: what is received, where the walk starts and goes, what is admitted.
_CRAWL = f"""{_MAIN}, {_LINKS}, {_ROBOTS},
named AS (SELECT page_id, url, {norm("url")} AS norm_url FROM pages),
total AS (SELECT count(*) AS n FROM pages),
received AS (
  SELECT * FROM named WHERE page_id % 20 NOT IN (5, 13, 15, 17, 19)),
start AS (
  SELECT norm_url, min(url) AS url FROM (
    SELECT norm_url, url FROM named WHERE NOT {skipped("url")}
    UNION ALL
    SELECT {norm("seed")}, seed FROM (
      SELECT regexp_extract(url, '^([a-z]+://[^/]*)', 1) || '/' AS seed FROM pages
      GROUP BY 1 HAVING bool_and({skipped("url")})))
  GROUP BY norm_url),
chosen AS (
  SELECT r.page_id, r.url, norm_url FROM received AS r LEFT JOIN start AS s USING (norm_url)
  QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY r.url <> coalesce(s.url, norm_url), r.url) = 1),
edges AS (
  SELECT * FROM (
    SELECT a.norm_url AS src, b.norm_url AS dst FROM chosen AS a, total, named AS b
    WHERE b.page_id IN ((2 * a.page_id + 1) % n, (3 * a.page_id + 2) % n)
    UNION SELECT a.norm_url, l.dst_url FROM chosen AS a JOIN links AS l USING (page_id)
    UNION SELECT norm_url, {_PDF} FROM chosen WHERE page_id % 3 = 0)
  WHERE NOT {skipped("dst")}),
known AS (SELECT norm_url AS u FROM start UNION SELECT dst FROM edges),
first_rule AS (
  SELECT u, min_by(allow, rule_no) AS allow FROM known
  JOIN rules ON base = 'https://' || {netloc("u")} AND group_no = 2 AND starts_with({path("u")}, prefix)
  GROUP BY u),
admitted AS (
  SELECT u FROM known LEFT JOIN robots ON base = 'https://' || {netloc("u")} LEFT JOIN first_rule USING (u)
  WHERE NOT {skipped("u")}
    AND CASE WHEN status IN (403, 503) THEN false ELSE coalesce(allow, true) END),
walk AS (
  SELECT norm_url, 0 AS depth FROM start
  UNION
  SELECT dst, depth + 1 FROM walk JOIN edges ON src = norm_url JOIN admitted ON u = norm_url
  WHERE depth <= 3),
processed AS (
  SELECT norm_url FROM walk JOIN admitted ON u = norm_url GROUP BY 1 HAVING min(depth) <= 3),
pdfs AS (SELECT page_id, {_PDF} AS url FROM pages WHERE page_id % 3 = 0),
crawled AS (
  SELECT norm_url AS url, text, NULL AS last_modified
  FROM chosen JOIN processed USING (norm_url) JOIN cleaned USING (page_id)
  UNION ALL
  SELECT p.url, d.text, NULL FROM pdfs AS p JOIN processed ON norm_url = p.url
  JOIN documents AS d ON doc_id = page_id WHERE page_id % 2 = 0 OR page_id % 5 <> 4)"""

ORACLES: dict[str, str] = {
    "url_normalize": f"SELECT page_id, {norm('url')} AS norm_url FROM pages",
    "url_normalize_keep_query": f"""
        SELECT page_id, {norm('url')} || CASE WHEN {uquery('url')} <> '' THEN '?' || {uquery('url')} ELSE '' END AS norm_url
        FROM pages""",
    "url_sanitize_title": f"SELECT page_id, {slug('url')} AS slug, {slug(path('url'))} AS title FROM pages",
    "url_blob_name": f"""
        SELECT page_id, {stem('url')} || '_' || {url_hash('url')} || '.json' AS doc_name,
               {stem('url')} || '_' || (page_id % 7 + 1) || '_' || {url_hash('url')} || '.json' AS chunk_name
        FROM pages""",
    "url_parts_host": f"""
        SELECT page_id, {scheme('url')} AS scheme, {netloc('url')} AS netloc, {path('url')} AS path,
               {uquery('url')} AS query, {fragment('url')} AS fragment, {host('url')} AS host
        FROM pages""",
    "url_directory_base": f"SELECT page_id, {base('url')} AS base FROM pages",
    "url_resolve": f"""
        WITH p AS (
          SELECT page_id, unnest([{_quoted(HREFS)}]) AS href, {scheme('url')} AS s, {netloc('url')} AS n,
                 {path('url')} AS p, {uquery('url')} AS q, regexp_extract({path('url')}, '^(.*/)', 1) AS d
          FROM pages)
        SELECT page_id, href, CASE
            WHEN href = 'mailto:q@z' OR href LIKE 'https:%' THEN href
            WHEN href LIKE '//%' THEN s || ':' || href
            WHEN href LIKE '/%' THEN s || '://' || n || href
            WHEN href LIKE '?%' THEN s || '://' || n || p || href
            WHEN href LIKE '#%' THEN s || '://' || n || p || CASE WHEN q <> '' THEN '?' || q ELSE '' END || href
            WHEN href LIKE '../%' THEN s || '://' || n || regexp_replace(d, '[^/]+/$', '') || href[4:]
            WHEN href LIKE './%' THEN s || '://' || n || d || href[3:]
            ELSE s || '://' || n || d || href END AS resolved
        FROM p""",
    "js_open": f"""
        WITH p AS (SELECT page_id, {slug(path('url'))} AS t FROM pages)
        SELECT page_id, unnest(['javascript:window.open(''' || t || '.pdf'')',
              'JavaScript:window.open("/d/' || t || '.XLSX","w")', 'javascript:window.open(''' || t || '.doc'')',
              'javascript:window.open(''' || t || '.docx")', 'javascript:show(''' || t || ''')']) AS href,
            unnest([t || '.pdf', '/d/' || t || '.XLSX', NULL, NULL, NULL]) AS target
        FROM p""",
    "real_link": f"""
        WITH {_HREFS},
        p AS (SELECT page_id, {slug(path('url'))} AS t, {base('url')} AS b FROM pages),
        s AS (SELECT *, {scheme('b')} || '://' || {netloc('b')} AS site,
                     regexp_extract({path('b')}, '^(.*/)', 1) AS d FROM p)
        SELECT page_id, href, 'https://' || {host('url')} || {_HREF_PATH} AS link FROM hrefs WHERE href <> ''
        UNION ALL
        SELECT page_id, ' #' || t, site || {path('b')}
               || CASE WHEN {uquery('b')} <> '' THEN '?' || {uquery('b')} ELSE '' END || '#' || t FROM s
        UNION ALL
        SELECT page_id, unnest(['javascript:window.open(''' || t || '.pdf'')',
              'JavaScript:window.open("/d/' || t || '.XLSX","w")', 'javascript:window.open(''' || t || '.doc'')',
              'javascript:window.open(''' || t || '.docx")', 'javascript:show(''' || t || ''')']),
            unnest([site || d || t || '.pdf', site || '/d/' || t || '.XLSX', NULL, NULL, NULL])
        FROM s""",
    "links_extract": f"WITH {_HREFS} SELECT page_id, href FROM hrefs WHERE href <> ''",
    "links_filtered": f"""
        WITH {_LINKS} SELECT src_url, src_norm, dst_url FROM links
        WHERE {allowed(host('dst_url'))} AND NOT {skipped('dst_url', LINK_SKIP)}""",
    "links_per_page": f"""
        WITH {_LINKS},
        raw AS (SELECT url AS src_url, count(*) AS raw_links FROM hrefs WHERE href <> '' GROUP BY 1),
        good AS (SELECT src_url, count(*) AS n FROM links
                 WHERE {allowed(host('dst_url'))} AND NOT {skipped('dst_url', LINK_SKIP)} GROUP BY 1)
        SELECT src_url, raw_links, coalesce(n, 0) AS kept_links FROM raw LEFT JOIN good USING (src_url)""",
    "links_distinct": f"WITH {_LINKS} SELECT DISTINCT dst_url AS dst_norm FROM links",
    "filter_skip": f"""
        SELECT page_id, 'raw' AS stage, url FROM pages WHERE NOT {skipped('url')}
        UNION ALL
        SELECT page_id, 'normal', u FROM (SELECT page_id, {norm('url')} AS u FROM pages) WHERE NOT {skipped('u')}""",
    "route_documents": f"""
        WITH u AS (
          SELECT page_id, {norm('url')} || ['.pdf', '.DOCX', '.xlsx', '.doc', '.xls', '', '.pdf'][page_id % 7 + 1] AS url
          FROM pages)
        SELECT page_id, url, CASE
            WHEN lower(url) LIKE '%.pdf' THEN 'pdf' WHEN lower(url) LIKE '%.docx' THEN 'docx'
            WHEN lower(url) LIKE '%.xlsx' THEN 'xlsx'
            WHEN lower(url) LIKE '%.doc' OR lower(url) LIKE '%.xls' THEN 'unsupported' ELSE 'html' END AS route,
          CASE
            WHEN lower(url) LIKE '%.docx' THEN 'docx' WHEN lower(url) LIKE '%.xlsx' THEN 'xlsx'
            WHEN lower(url) LIKE '%.doc' OR lower(url) LIKE '%.xls' THEN 'unsupported' ELSE 'html' END AS route_no_pdf
        FROM u""",
    "allow_domain_semi": f"""
        WITH d AS (
          SELECT DISTINCT regexp_extract({host('url')}, '([^.]+[.]example[.].*)$', 1) AS d
          FROM pages WHERE url LIKE 'http://%')
        SELECT page_id, url FROM pages
        WHERE EXISTS (SELECT 1 FROM d WHERE {host('url')} = d OR {host('url')} LIKE '%.' || d)""",
    "allow_domain_list": f"SELECT page_id, url FROM pages WHERE {allowed(host('url'))}",
    "seed_list": f"""
        SELECT url AS seed FROM pages UNION ALL SELECT 'https://' || {host('url')} || '/' FROM pages""",
    "allow_list": f"""
        SELECT array_to_string(string_split({host('url')}, '.')[1:2], '.') AS domain FROM pages
        UNION SELECT {host('url')} FROM pages""",
    "sitemap_or_seed": f"""
        WITH s AS (SELECT {host('url')} AS h, min(url) AS seed FROM pages GROUP BY 1),
        l AS (SELECT {host('url')} AS h, url AS loc FROM pages WHERE contains(url, '.html'))
        SELECT seed, coalesce(loc, seed) AS url, loc IS NOT NULL AS from_sitemap FROM s LEFT JOIN l USING (h)""",
    "sitemap_expand": f"""
        WITH p AS (
          SELECT page_id, url, 'https://' || {host('url')} || '/sitemap.xml' AS m,
                 'https://index.example.' || string_split({host('url')}, '.')[-1] || '/sitemap.xml' AS t
          FROM pages WHERE NOT {skipped('url')})
        SELECT unnest([m, t]) AS root, m AS sitemap_url, page_id AS pos, url AS loc FROM p""",
    "sitemap_xml": f"""
        WITH l AS (
          SELECT page_id, url, {_entities("unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))")} AS href,
                 generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS i
          FROM pages WHERE page_id % 5 <> 4 AND page_id % 7 <> 6),
        f AS (SELECT page_id, url, href, min(i) AS i FROM l WHERE href <> '' GROUP BY ALL)
        SELECT url AS sitemap_url, CASE WHEN page_id % 3 = 0 THEN 'index' ELSE 'urlset' END AS kind,
               (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INTEGER AS pos, href AS loc
        FROM f""",
    "bfs_frontier": f"WITH RECURSIVE {_GRAPH} SELECT norm_url, depth, processed FROM frontier",
    "bfs_order": f"WITH {queue_levels()} "
    + " UNION ALL ".join(
        f"SELECT rank, norm_url, url, depth::INTEGER AS depth, processed FROM level_{d}" for d in range(DEPTH + 2)
    ),
    "bfs_visited_count": f"""
        WITH RECURSIVE {_GRAPH} SELECT depth, processed, count(*) AS urls FROM frontier GROUP BY ALL""",
    "bfs_pending": f"""
        WITH RECURSIVE {_GRAPH} SELECT norm_url, depth FROM frontier
        WHERE norm_url NOT IN (SELECT norm_url FROM named)""",
    "main_text_column": _MAIN_WHOLE,
    "main_text_dom": _MAIN_WHOLE,
    "lang_block_filter": f"""
        WITH d AS (SELECT doc_id AS key, text FROM documents), {line_filter('d', 'key')}
        SELECT key, filtered AS text FROM kept""",
    "lang_block_conversations": f"""
        WITH {line_filter('conversations', 'conv_id', 'turn')}
        SELECT conv_id, filtered AS text FROM kept""",
    "lang_block_array": f"""
        WITH {line_filter('documents', 'doc_id')}
        SELECT doc_id, coalesce(filtered, '') AS filtered,
               CASE WHEN length(trim(coalesce(filtered, ''), chr(32) || chr(10))) > 200
                    THEN trim(filtered, chr(32) || chr(10)) ELSE text END AS text
        FROM documents LEFT JOIN kept USING (doc_id)""",
    "truncate_text": f"SELECT doc_id, {truncated('text', TEXT_LIMIT)} AS text FROM documents",
    "non_blank_lines": """
        WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[.,]')) AS part FROM documents)
        SELECT doc_id, count(*) AS parts FROM l WHERE regexp_matches(part, '\\S') GROUP BY doc_id""",
    "panes_dom": f"WITH {_ARTICLES} SELECT page_id, 'top' AS id, text FROM articles",
    "fragment_docs_dom": f"""
        WITH {_ARTICLES}
        SELECT page_id, {scheme('url')} || '://' || {netloc('url')} || {path(base('url'))}
            || CASE WHEN {uquery(base('url'))} <> '' THEN '?' || {uquery(base('url'))} ELSE '' END || '#top' AS url, text
        FROM articles""",
    "fragment_docs": f"""
        SELECT p.page_id, p.url, text FROM pages p JOIN documents d ON d.doc_id = p.page_id
        WHERE {fragment('p.url')} = CASE WHEN doc_id % 4 = 3 THEN 'end' ELSE 'top' END""",
    "token_counts": f"""
        SELECT doc_id, len(regexp_extract_all(text, '{_TOKEN}'))::INTEGER AS tokens FROM documents""",
    "token_windows": f"WITH {windows('documents', 'doc_id')} SELECT * FROM windows",
    "codec_windows": """
        WITH n AS (
          SELECT doc_id, text, ((length(text) + 599) // 600)::INTEGER AS chunk_total,
                 unnest(range(1, (length(text) + 599) // 600 + 1))::INTEGER AS chunk_index FROM documents)
        SELECT doc_id, chunk_index, chunk_total, substr(text, (chunk_index - 1) * 600 + 1, 700) AS content FROM n""",
    "chunk_totals": f"""
        WITH {_DOCS} SELECT url, ((len(regexp_extract_all(text, '{_TOKEN}')) + {STEP - 1}) // {STEP})::INTEGER AS chunk_total
        FROM docs""",
    "chunk_records": f"{_CHUNKS} SELECT * FROM chunks",
    "chunk_ids": f"{_CHUNKS} SELECT md5(url || '#' || chunk_index) AS id, url, chunk_index FROM chunks",
    "page_chunk_records": f"""
        WITH {_MAIN}, pagedocs AS (SELECT {norm('url')} AS url, text, 'v1' AS last_modified FROM cleaned),
        {chunked('pagedocs')} SELECT * FROM chunks""",
    "chunks_json": f"{_CHUNKS} SELECT url, chunk_index, content FROM chunks",
    "embed_guarded": f"""
        SELECT doc_id, len(regexp_extract_all(text, '{_TOKEN}')) <= {GUARD} AND regexp_matches(text, '\\S') AS embeddable
        FROM documents""",
    "embed_chunks": f"""
        {_CHUNKS}, g AS (
          SELECT url, chunk_index, CASE WHEN len(regexp_extract_all(content, '{_TOKEN}')) <= {SIZE} THEN content END AS c
          FROM chunks)
        SELECT url, chunk_index, (length(c) - length(replace(c, 'a', '')))::DOUBLE AS e0,
               (length(c) - length(replace(c, 'e', '')))::DOUBLE AS e1,
               (length(c) - length(replace(c, 'n', '')))::DOUBLE AS e2 FROM g""",
    "seen_anti": f"""
        {_CHUNKS} SELECT url, chunk_index, content FROM chunks WHERE chunk_index % 3 <> 1""",
    "seen_files": f"""
        {_CHUNKS} SELECT url, chunk_index, content FROM chunks WHERE chunk_index % 3 <> 1""",
    "upsert_actions": f"{_CHUNKS}, {_STORE} SELECT blob_name, last_modified, action FROM actions",
    "upsert_merged": _MERGED,
    "upsert_stored": _MERGED,
    "latest_version": """
        SELECT user_id, ts, event_id, event_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "fetch_outcomes": f"WITH {outcomes(3)} SELECT url, attempt, status, outcome, reason FROM outcomes",
    "failures": f"WITH {outcomes(2)} SELECT url, reason FROM outcomes WHERE outcome = 'failure'",
    "not_found": f"""
        WITH {outcomes(3)} SELECT '404_' || {slug(path('url'))} || '_' || md5(url) || '.json' AS blob_name,
               md5(url) AS id, url, '' AS content, 404 AS status FROM outcomes WHERE outcome = 'not_found'""",
    "pdf_accepted": f"""
        WITH {_ATTEMPTS} SELECT url, attempt FROM attempts WHERE status = 200 AND lower(content_type) LIKE '%pdf%'""",
    "pdf_retry_reconcile": f"""
        WITH {_ATTEMPTS},
        good AS (SELECT url, min(attempt) AS hit FROM attempts
                 WHERE status = 200 AND lower(content_type) LIKE '%pdf%' GROUP BY url)
        SELECT url, CASE WHEN error IS NOT NULL THEN 'PDF GET error: ' || error
                         ELSE 'PDF HTTP ' || status || ' (GET)' END AS reason
        FROM attempts a LEFT JOIN good USING (url)
        WHERE (hit IS NULL AND NOT coalesce(status = 200 AND lower(content_type) LIKE '%pdf%', false))
           OR (attempt < hit AND error IS NOT NULL)""",
    "pdf_size_cut": f"""
        SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN n_chars END AS length FROM documents
        WHERE doc_id % 5 = 0 OR n_chars <= {MAX_LENGTH}""",
    "header_lookup": """
        SELECT event_id, event_type AS x_type,
               CASE WHEN event_id % 4 < 2 THEN user_id::VARCHAR
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS last_modified
        FROM events""",
    "emitted_urls": f"{_CHUNKS} SELECT url FROM chunks",
    "emitted_urls_distinct": f"{_CHUNKS} SELECT DISTINCT url FROM chunks",
    "emitted_docs": f"""
        {_CHUNKS}, {_STORE} SELECT blob_name, url, chunk_index, content FROM actions WHERE action <> 'skip'""",
    "run_summary": f"""
        WITH {outcomes(3)} SELECT 'ok' AS status, count(*) AS visited,
               count(*) FILTER (WHERE outcome = 'failure') AS failed FROM outcomes""",
    "robots_rules_table": f"WITH {_ROBOTS} SELECT * FROM rules",
    "crawl_run": f"""
        WITH RECURSIVE {_CRAWL}, {chunked("crawled")}
        SELECT url, chunk_index, chunk_total, content, blob_name FROM chunks""",
    "crawl_failures": f"""
        WITH RECURSIVE {_CRAWL}
        SELECT url, CASE WHEN page_id % 20 = 19 THEN 'All fetch attempts failed or invalid HTML' ELSE 'HTTP 403' END AS reason
        FROM named JOIN processed USING (norm_url) WHERE page_id % 20 IN (15, 17, 19)
        UNION ALL
        SELECT url, unnest(['PDF HTTP 403 (GET)', 'PDF HTTP 404 (GET)']) FROM pdfs JOIN processed ON norm_url = url
        WHERE page_id % 2 = 1 AND page_id % 5 = 4""",
    "robots_allowed": f"""
        WITH {_ROBOTS}, u AS (SELECT page_id, {norm('url')} AS url FROM pages),
        hits AS (
          SELECT page_id, min_by(allow, rule_no) AS allow FROM u
          JOIN rules ON base = 'https://' || {netloc('u.url')} AND group_no = 2 AND starts_with({path('u.url')}, prefix)
          GROUP BY page_id)
        SELECT page_id, url, CASE WHEN status IN (403, 503) THEN false ELSE coalesce(allow, true) END AS allowed
        FROM u JOIN robots ON base = 'https://' || {netloc('u.url')} LEFT JOIN hits USING (page_id)""",
    "docx_assemble": """
        SELECT conv_id AS url, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1""",
    "xlsx_assemble": """
        WITH r AS (SELECT conv_id AS url, turn % 2 AS sheet_no, turn // 2 AS row_no, text FROM conversations)
        SELECT url, string_agg(text, chr(10) ORDER BY sheet_no, row_no) AS text FROM r WHERE row_no > 0 GROUP BY 1""",
    "pdf_assemble": """
        SELECT conv_id AS url, string_agg(CASE WHEN turn % 3 < 2 THEN text ELSE '' END, '' ORDER BY turn) AS text
        FROM conversations GROUP BY 1""",
    "docx_binary": "SELECT doc_id, text FROM documents WHERE regexp_matches(text, '\\S')",
    "xlsx_binary": """
        SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: l || ' x'), chr(10)) AS text
        FROM documents""",
    "stream_ingest": f"SELECT page_id, {norm('url')} AS norm_url FROM pages",
    "stream_dedup": f"SELECT DISTINCT {norm('url')} AS norm_url FROM pages",
    "stream_upsert": f"""
        WITH {_MAIN}, pagedocs AS (SELECT {norm('url')} AS url, text, 'v1' AS last_modified FROM cleaned),
        {chunked('pagedocs')}
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY blob_name ORDER BY content DESC) AS rn FROM chunks) WHERE rn = 1""",
    "stream_summary": f"""
        SELECT CASE WHEN {skipped('url')} THEN 'skipped' ELSE 'visited' END AS outcome, count(*) AS pages
        FROM pages GROUP BY 1""",
}
