"""The same results in plain SQL over the source tables, for checking."""

from __future__ import annotations

# ---- fragments --------------------------------------------------------------------
SHOP = "https://books.toscrape.com"
WIKI = "https://en.wikipedia.org"
SEED = "https://en.wikipedia.org/wiki/Doc_3"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def decode(x: str) -> str:
    for ref, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        x = f"replace({x}, '{ref}', '{char}')"
    return x


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '\\S+'))"


ANCHORS = """
WITH a AS (SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">[^<]*') AS xs FROM pages),
b AS (SELECT page_id, url, unnest(xs) AS x, generate_subscripts(xs, 1) AS k FROM a),
e AS (SELECT page_id, url, k, """ + decode("regexp_extract(x, '<a href=\"([^\"]*)\"', 1)") + """ AS h,
      """ + strip(decode("regexp_extract(x, '>([^<]*)$', 1)")) + """ AS label,
      regexp_extract(url, '^(https?://[^/]+)', 1) AS root FROM b),
r AS (SELECT page_id, url AS src, root || split_part(h, '#', 1) AS dst, min(k) AS k
      FROM e WHERE h LIKE '/%' GROUP BY ALL)
"""
ARTICLE_BODY = "regexp_extract(html, '<article>(.*)</article>', 1, 's')"
PLAIN_HTML = ("regexp_replace(regexp_replace(html, '<(script|style)>.*?</(script|style)>', '<\\1>', 'gs'),"
              " '<!--.*?-->', '', 'gs')")
PRICE = "'£' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)"
N_PAGES = "(SELECT max(p_partkey) // 20 + 1 FROM part)"


def listing(page: str) -> str:
    return f"'{SHOP}/catalogue/page-' || CAST({page} AS VARCHAR) || '.html'"


# ---- breadth-first walk --------------------------------------------------------------
def walk(edges: str, seed: str, nodes: str | None, cap: int | None = 5, depth: int = 3) -> str:
    """CTEs ``visited(url, depth, referrer, ord)`` and ``offers(src, dst, pos)``."""
    known = f" AND dst IN (SELECT url FROM ({nodes}))" if nodes else ""
    parts = [f"e AS MATERIALIZED ({edges})",
             f"v0 AS (SELECT {seed} AS url, 0 AS depth, CAST(NULL AS VARCHAR) AS referrer, 1 AS ord)"]
    for d in range(depth + 1):
        seen = " UNION ALL ".join(f"SELECT url FROM v{k}" for k in range(d + 1))
        parts.append(f"seen{d} AS ({seen})")
        parts.append(
            f"c{d} AS MATERIALIZED (SELECT * FROM (SELECT f.ord AS ford, f.url AS src, e.dst, e.pos, "
            f"row_number() OVER (PARTITION BY f.url ORDER BY e.pos) AS k FROM v{d} f JOIN e ON e.src = f.url "
            f"WHERE e.probe NOT IN (SELECT url FROM seen{d}))" + (f" WHERE k <= {cap})" if cap else ")"))
        if d < depth:
            parts.append(
                f"g{d} AS (SELECT dst, min(struct_pack(o := ford, p := pos)) AS m, "
                f"min_by(src, struct_pack(o := ford, p := pos)) AS ref FROM c{d} "
                f"WHERE dst NOT IN (SELECT url FROM seen{d}){known} GROUP BY dst)")
            parts.append(
                f"v{d + 1} AS MATERIALIZED (SELECT dst AS url, {d + 1} AS depth, ref AS referrer, "
                f"row_number() OVER (ORDER BY m.o, m.p) AS ord FROM g{d})")
    parts.append("visited AS (" + " UNION ALL ".join(f"SELECT * FROM v{k}" for k in range(depth + 1)) + ")")
    parts.append("offers AS (" + " UNION ALL ".join(
        f"SELECT src, dst, pos FROM c{k}" for k in range(depth + 1)) + ")")
    return ", ".join(parts)


LINK_ROWS = ("SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem UNION "
             "SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem")
LINK_EDGES = f"SELECT src, dst, dst AS probe, dst AS pos FROM ({LINK_ROWS})"
HUB_EDGES = f"""{LINK_EDGES} UNION SELECT 'a_hub', src, src, src FROM ({LINK_ROWS})
UNION SELECT src, 'a_hub', 'a_hub', 'a_hub' FROM ({LINK_ROWS})"""

# ---- articles -------------------------------------------------------------------------
N_DOCS = "(SELECT max(doc_id) + 1 FROM documents)"


def doc(k: int) -> str:
    return f"CAST((doc_id * 7 + {k}) % {N_DOCS} AS VARCHAR)"


def doc_url(k: int) -> str:
    return f"'{WIKI}/wiki/Doc_' || {doc(k)}"


URL = f"'{WIKI}/wiki/Doc_' || doc_id"
BODY = f"({strip('text')} || ' Doc ' || {doc(0)})"
SUMMARY = (f"CASE WHEN length({strip(BODY)}) <= 50 THEN '' WHEN length({strip(BODY)}) > 500 "
           f"THEN left({strip(BODY)}, 500) || '...' ELSE {strip(BODY)} END")
WORD_COUNT = (f"CAST(5 + {words('text')} + CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END "
              "+ CASE WHEN doc_id % 7 = 0 THEN 3 ELSE 0 END AS INTEGER)")
RELATED = " || ' | ' || ".join(
    [f"'Doc (' || {doc_url(0)} || ')'"]
    + [f"'Doc ' || {doc(k)} || ' (' || {doc_url(k)} || '{'#s' if k == 5 else ''})'"
       for k in (0, 1, 2, 4, 5, 6, 7)])
CONTENT_EDGES = " UNION ALL ".join(
    f"SELECT {URL} AS src, {doc_url(k)} AS dst, {doc_url(k)} || '{'#s' if k == 5 else ''}' AS probe, "
    f"{pos} AS pos FROM documents"
    for pos, k in enumerate((0, 0, 1, 2, 4, 5, 6, 7, 8)))
STRUCTURE_EDGES = " UNION ALL ".join(
    f"SELECT src, dst, dst AS probe, {k} AS pos FROM (SELECT {URL} AS src, "
    + (f"'{WIKI}/wiki/File:Doc_' || {doc(3)} || '.png'" if k == 3 else doc_url(k))
    + " AS dst FROM documents)"
    for k in range(9))
DOC_NODES = f"SELECT {URL} AS url FROM documents"
ARTICLE_FIELDS = f"""'Doc ' || doc_id AS judul, {SUMMARY} AS ringkasan, lang || ' | ' || source AS kategori,
    {URL} AS url, {WORD_COUNT} AS jumlah_kata, {RELATED} AS link_terkait"""
STRUCTURE_FIELDS = f"""'Doc ' || doc_id AS judul, {URL} AS url, 9 AS jumlah_link_internal,
    CAST(doc_id % 3 AS INTEGER) AS jumlah_link_eksternal,
    1 + CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END
        AS jumlah_section,
    CASE WHEN doc_id % 4 = 0 THEN 'Contents | ' ELSE '' END || 'History of ' || lang ||
        CASE WHEN doc_id % 2 = 0 THEN ' | ' ELSE '' END AS judul_section,
    doc_id % 3 = 0 AS ada_infobox, doc_id % 4 = 0 AS ada_toc,
    CAST(doc_id % 4 AS INTEGER) AS jumlah_gambar, CAST(doc_id % 5 + 1 AS INTEGER) AS jumlah_referensi,
    lang || ' | ' || source AS kategori, 2 AS jumlah_kategori, lang || ' portal' AS portal,
    doc_id % 11 = 0 OR doc_id % 13 = 0 OR contains(lower(text), 'disambiguation') AS ada_disambiguasi,
    'Doc ' || doc_id || ' - Wiki' AS title, lang, {URL} AS canonical,
    'From ' || source AS og_description"""

NAMESPACE = ("['Special:','User:','Talk:','File:','Wikipedia:','Help:','Template:','Portal:',"
             "'Category:','MediaWiki:','Module:',''][CAST(doc_id % 12 + 1 AS INTEGER)]")
ARTICLE_URLS = f"""SELECT doc_id, '{WIKI}/wiki/' || CASE WHEN doc_id % 2 = 0
    THEN {NAMESPACE} || 'Doc_' || doc_id ELSE 'Doc_' || doc_id || '_' || {NAMESPACE} END ||
    CASE WHEN doc_id % 5 = 0 THEN '?action=edit' ELSE '' END AS url FROM documents"""

DIRTY = f"""SELECT CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN NULL
    ELSE p_name END AS judul, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE {PRICE} END AS harga,
    p_size AS rating, p_size > 25 AS tersedia, 'Semua Kategori' AS kategori,
    '/item_' || p_partkey AS url FROM part"""

TYPE_PAGES = """k AS (SELECT p_type, lower(p_type) AS slug, count(*) AS n,
    CAST(ceil(count(*) / 20.0) AS INTEGER) AS np FROM part GROUP BY p_type),
t AS (SELECT *, unnest(range(1, np + 1)) AS i FROM k)"""


def type_url(slug: str, i: str) -> str:
    return (f"'{SHOP}/catalogue/category/books/' || {slug} || CASE WHEN {i} = 1 THEN '/index.html' "
            f"ELSE '/page-' || ({i}) || '.html' END")


def odd(null_text: str) -> str:
    return f"""CAST(p_partkey AS VARCHAR) AS id,
    ' "' || p_name || '", é' || chr(10) || '— ' || p_brand || ' ' AS judul,
    CASE WHEN p_partkey % 3 <> 0 THEN {PRICE} END AS harga,
    CASE WHEN p_partkey % 2 = 0 THEN p_type || ' | ' || p_brand ELSE {null_text} END AS kategori"""


STREAM_ITEMS = f"""
SELECT * FROM (SELECT page_id, {strip(decode("regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))} AS judul,
    url, CAST(len(regexp_extract_all(html, '<a href=')) AS INTEGER) AS n_links FROM pages)
WHERE judul <> '' AND url <> ''"""

METRICS = f"""
SELECT 'books' AS crawler, url, CAST(NULL AS VARCHAR) AS judul, CAST(NULL AS INTEGER) AS kedalaman, nomor AS nomor_halaman,
    CAST(NULL AS INTEGER) AS jumlah_halaman, CAST(NULL AS INTEGER) AS jumlah_kata, CAST(NULL AS INTEGER) AS jumlah_kategori,
    CAST(NULL AS INTEGER) AS jumlah_section, CAST(NULL AS INTEGER) AS jumlah_link_internal, CAST(NULL AS INTEGER) AS jumlah_link_eksternal
FROM (SELECT DISTINCT {listing('p_partkey // 20 + 1')} AS url, CAST(p_partkey // 20 + 1 AS VARCHAR) AS nomor FROM part)
UNION ALL SELECT 'books_structure', url, judul, kedalaman, nomor, total, NULL, NULL, NULL, NULL, NULL FROM (
    WITH {TYPE_PAGES} SELECT {type_url('slug', 'i')} AS url, p_type AS judul, 1 AS kedalaman, CAST(i AS VARCHAR) AS nomor, np AS total FROM t
    UNION ALL SELECT '{SHOP}/index.html', 'Home', 0, '1', CAST(ceil(sum(n) / 20.0) AS INTEGER) FROM k)
UNION ALL SELECT 'wikipedia', url, judul, depth, NULL, NULL, jumlah_kata, 2, NULL, NULL, NULL FROM (
    WITH {walk(CONTENT_EDGES, f"'{SEED}'", DOC_NODES)}, a AS (SELECT {ARTICLE_FIELDS} FROM documents)
    SELECT a.url, judul, depth, jumlah_kata FROM a JOIN visited v ON v.url = a.url)
UNION ALL SELECT 'wiki_structure', url, judul, depth, NULL, NULL, NULL, jumlah_kategori, jumlah_section, jumlah_link_internal,
    jumlah_link_eksternal FROM (
    WITH {walk(STRUCTURE_EDGES, f"'{SEED}'", DOC_NODES)}, a AS (SELECT {STRUCTURE_FIELDS} FROM documents)
    SELECT a.*, depth FROM a JOIN visited v ON v.url = a.url)"""

ORACLE: dict[str, str] = {
    "q_seed_pages": """
SELECT page_id, url, 0 AS kedalaman, CAST(NULL AS VARCHAR) AS url_induk FROM pages
WHERE regexp_extract(url, '^https?://[^/]+(/[a-z]+/[0-9]+)', 1) IN (
    SELECT '/' || lang || '/' || doc_id FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))""",
    "q_page_title": f"""
SELECT page_id, {strip(decode("regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))} AS title,
    {strip(decode("regexp_extract(html, '<h1>([^<]*)', 1)"))} AS judul FROM pages""",
    "q_page_meta": f"""
SELECT page_id, {strip(decode("regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))} AS title,
    regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, '' AS canonical, '' AS og_description
FROM pages""",
    "q_page_links": ANCHORS + """
SELECT page_id, src, dst,
    CAST(row_number() OVER (PARTITION BY page_id, src ORDER BY k) - 1 AS INTEGER) AS pos FROM r""",
    "q_page_link_counts": ANCHORS + """
SELECT p.page_id, CAST((SELECT count(*) FROM e WHERE e.page_id = p.page_id) AS INTEGER) AS n_links,
    CAST((SELECT count(*) FROM r WHERE r.page_id = p.page_id) AS INTEGER) AS n_internal,
    CAST((SELECT count(*) FROM e WHERE e.page_id = p.page_id AND h LIKE 'http%'
          AND NOT contains(h, 'wikipedia.org')) AS INTEGER) AS n_external FROM pages p""",
    "q_page_anchor_labels": ANCHORS + """
, l AS (SELECT page_id, label || ' (' || root || h || ')' AS label,
    row_number() OVER (PARTITION BY page_id ORDER BY k) AS n
    FROM e WHERE h LIKE '/%' AND NOT contains(h, ':') AND label <> '')
SELECT page_id, CAST(n - 1 AS INTEGER) AS pos, label FROM l WHERE n <= 10""",
    "q_page_headings": f"""
WITH h AS (SELECT page_id, regexp_extract_all(html, '<h[12]>([^<]*)', 1) AS xs FROM pages),
x AS (SELECT page_id, {strip(decode('unnest(xs)'))} AS heading, generate_subscripts(xs, 1) AS k FROM h)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS pos, heading
FROM x WHERE heading NOT IN ('See also', 'References', 'Notes', 'External links', 'Further reading',
    'Bibliography')""",
    "q_page_tag_counts": f"""
WITH p AS (SELECT {PLAIN_HTML} AS html FROM pages),
a AS (SELECT unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM p),
b AS (SELECT unnest(regexp_extract_all({ARTICLE_BODY}, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM p),
na AS (SELECT tag, count(*) AS n FROM a GROUP BY tag), nb AS (SELECT tag, count(*) AS n FROM b GROUP BY tag)
SELECT na.tag, na.n, coalesce(nb.n, 0) AS n_in_article FROM na LEFT JOIN nb ON na.tag = nb.tag""",
    "q_page_metrics": f"""
SELECT page_id, {strip(decode("regexp_extract(html, '<h1>([^<]*)', 1)"))} AS judul,
    CAST(coalesce(list_sum(list_transform(regexp_extract_all({ARTICLE_BODY}, '<p>([^<]*)', 1),
         lambda x: {words('x')})), 0) AS INTEGER) AS n_words,
    CAST(len(regexp_extract_all(html, '<h1>')) AS INTEGER) AS n_headings,
    CAST(len(regexp_extract_all(html, '<a href=')) AS INTEGER) AS n_links FROM pages""",
    "q_page_word_count": f"SELECT doc_id AS page_id, {WORD_COUNT} AS jumlah_kata FROM documents",
    "q_page_summary": f"SELECT doc_id AS page_id, {SUMMARY} AS ringkasan FROM documents",
    "q_page_allowed_host": """
WITH h AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host FROM pages)
SELECT * FROM h WHERE host IN ('example.com', 'example.org') OR host LIKE '%.example.com'
    OR host LIKE '%.example.org'""",
    "q_page_skip_tokens": f"""
SELECT * FROM ({ARTICLE_URLS}) WHERE NOT regexp_matches(url,
    'Special:|User:|Talk:|File:|Wikipedia:|Help:|Template:|Portal:|Category:|action=')""",
    "q_page_skip_prefix": f"""
SELECT * FROM ({ARTICLE_URLS}) WHERE NOT regexp_matches(url,
    '^{WIKI}/wiki/(Special|User|Talk|File|Wikipedia|Help|Template|Portal|Category|MediaWiki|Module):')""",
    "q_books_extract": f"""
SELECT p_partkey // 20 + 1 AS page_id,
    CAST(row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) AS INTEGER) AS card,
    p_name AS judul, {PRICE} AS harga, CAST(p_size % 6 AS INTEGER) AS rating, p_size > 25 AS tersedia,
    'Semua Kategori' AS kategori, '{SHOP}/catalogue/item_' || p_partkey || '/index.html' AS url FROM part""",
    "q_books_page_no": f"""
SELECT DISTINCT p_partkey // 20 + 1 AS page_id, {listing('p_partkey // 20 + 1')} AS url,
    CAST(p_partkey // 20 + 1 AS VARCHAR) AS nomor FROM part""",
    "q_books_next_edges": f"""
SELECT DISTINCT {listing('p_partkey // 20 + 1')} AS src, {listing('p_partkey // 20 + 2')} AS dst
FROM part WHERE p_partkey // 20 + 1 < {N_PAGES}""",
    "q_books_next_chain": f"""
SELECT DISTINCT {listing('p_partkey // 20 + 1')} AS url, CAST(p_partkey // 20 AS INTEGER) AS hop FROM part""",
    "q_books_crawl": f"""
SELECT p_name AS judul, {PRICE} AS harga, CAST(p_size % 6 AS INTEGER) AS rating, p_size > 25 AS tersedia,
    'Semua Kategori' AS kategori, '{SHOP}/catalogue/item_' || p_partkey || '/index.html' AS url FROM part""",
    "q_books_categories": f"""
SELECT '{SHOP}/index.html' AS home, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS pos,
    p_type AS nama, {type_url('lower(p_type)', '1')} AS url FROM part GROUP BY p_type""",
    "q_books_structure": f"""
WITH {TYPE_PAGES}
SELECT CASE WHEN i = 1 THEN 'kategori' ELSE 'listing' END AS tipe,
    CASE WHEN i = 1 THEN p_type ELSE p_type || ' — Halaman ' || i END AS nama,
    {type_url('slug', 'i')} AS url,
    CASE WHEN i = 1 THEN '{SHOP}/index.html' ELSE {type_url('slug', 'i - 1')} END AS url_induk,
    1 AS kedalaman, CAST(n AS INTEGER) AS jumlah_buku, np AS jumlah_halaman, CAST(i AS INTEGER) AS nomor_halaman,
    'breadcrumb:Home > Books' || CASE WHEN np > 1 THEN ' | pagination:prev=' ||
        CASE WHEN i > 1 THEN 'ada' ELSE 'tidak' END || ',next=' ||
        CASE WHEN i < np THEN 'ada' ELSE 'tidak' END ELSE '' END AS tag_navigasi,
    CASE WHEN i < np THEN {type_url('slug', 'i + 1')} ELSE '' END AS link_anak,
    p_type || ' | Shop' AS title, 'All of ' || p_type AS meta_description,
    'Home > Books > ' || p_type AS breadcrumb,
    CAST(CASE WHEN i < np THEN 20 ELSE n - 20 * (np - 1) END AS INTEGER) AS jumlah_artikel_di_halaman
FROM t
UNION ALL
SELECT 'home', 'Home', '{SHOP}/index.html', NULL, 0, CAST(sum(n) AS INTEGER),
    CAST(ceil(sum(n) / 20.0) AS INTEGER), 1, 'sidebar_kategori:' || (count(*) + 1) || ' item | header:ada',
    string_agg({type_url('slug', '1')}, ' | ' ORDER BY p_type), 'Home | Shop', '', NULL, 0 FROM k""",
    "q_articles_extract": f"SELECT doc_id AS page_id, {ARTICLE_FIELDS} FROM documents",
    "q_articles_crawl": f"""
WITH {walk(CONTENT_EDGES, f"'{SEED}'", DOC_NODES)}, a AS (SELECT {ARTICLE_FIELDS} FROM documents)
SELECT a.*, CAST(v.depth AS INTEGER) AS kedalaman FROM a JOIN visited v ON v.url = a.url""",
    "q_wiki_structure": f"SELECT doc_id AS page_id, {STRUCTURE_FIELDS} FROM documents",
    "q_wiki_structure_crawl": f"""
WITH {walk(STRUCTURE_EDGES, f"'{SEED}'", DOC_NODES)}, a AS (SELECT {STRUCTURE_FIELDS} FROM documents),
o AS (SELECT src, string_agg(dst, ' | ' ORDER BY pos) AS link_keluar FROM offers GROUP BY src)
SELECT a.*, CAST(v.depth AS INTEGER) AS kedalaman, v.referrer AS url_induk, v.referrer AS link_masuk_dari,
    coalesce(o.link_keluar, '') AS link_keluar
FROM a JOIN visited v ON v.url = a.url LEFT JOIN o ON o.src = a.url""",
    "q_bfs_nodes": f"""
WITH {walk(LINK_EDGES, "'s0'", None)} SELECT url, depth, referrer FROM visited""",
    "q_bfs_full": f"""
WITH {walk(LINK_EDGES, "'s0'", None, cap=None)} SELECT url, depth, referrer FROM visited""",
    "q_bfs_hub": f"""
WITH {walk(HUB_EDGES, "'s0'", None, cap=None)} SELECT url, depth, referrer FROM visited""",
    "q_bfs_limit": f"""
WITH {walk(LINK_EDGES, "'s0'", None)} SELECT url, depth FROM visited ORDER BY visited.depth, ord LIMIT 20""",
    "q_bfs_half": f"""
WITH {walk(LINK_EDGES, "'s0'", None, cap=None)} SELECT url, depth FROM (
    SELECT url, depth, row_number() OVER (ORDER BY depth, ord) AS k, count(*) OVER () AS n FROM visited) WHERE k <= n // 2""",
    "q_udtf_pages": ANCHORS + """
, hs AS (SELECT page_id, regexp_extract_all(html, '<h[123]>[^<]*') AS xs FROM pages),
x AS (SELECT page_id, unnest(xs) AS x, generate_subscripts(xs, 1) AS k FROM hs)
SELECT page_id, 'link' AS kind, CAST(k - 1 AS INTEGER) AS pos, h AS value, label FROM e
UNION ALL SELECT page_id, x[2:3], CAST(k - 1 AS INTEGER), """ + strip(decode("x[5:]")) + """, NULL FROM x""",
    "q_job_run": f"""
WITH {walk(CONTENT_EDGES, f"'{SEED}'", DOC_NODES, cap=2)}
SELECT url, 'Doc ' || replace(url, '{WIKI}/wiki/Doc_', '') AS judul, CAST(depth AS INTEGER) AS kedalaman FROM visited""",
    "q_run_summary": f"""
WITH c AS (SELECT count(*) AS n FROM ({DIRTY}) WHERE coalesce(judul, '') <> '' AND coalesce(harga, '') <> '')
SELECT item_type, n, 'books' AS crawler, '2024-01-02 03:04:05' AS started, '2024-01-02 03:05:35' AS ended, CAST(90 AS DOUBLE) AS seconds,
    '20240102_030405' AS stamp, 'output/books_20240102_030405.csv' AS path FROM c, (VALUES ('BookItem'), ('Total item')) t(item_type)""",
    "q_loose_lists": """
SELECT p_partkey, CAST(CASE p_partkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS INTEGER) AS n,
    CASE p_partkey % 3 WHEN 0 THEN p_type || ' | ' || p_brand WHEN 1 THEN p_name END AS links FROM part""",
    "q_crawl_metrics": METRICS,
    "q_crawl_totals": f"""
SELECT crawler, count(*) AS pages, CAST(max(CASE WHEN crawler = 'books' THEN (SELECT count(*) FROM part) ELSE n END) AS BIGINT) AS items,
    CAST(coalesce(sum(jumlah_kata), 0) AS BIGINT) AS words, CAST(coalesce(sum(jumlah_link_internal + jumlah_link_eksternal), 0) AS BIGINT) AS links,
    CAST(coalesce(max(kedalaman), 0) AS BIGINT) AS deepest
FROM (SELECT *, count(*) OVER (PARTITION BY crawler) AS n FROM ({METRICS})) GROUP BY crawler""",
    "q_graph_degrees": f"""
WITH e AS ({LINK_ROWS}), x AS (SELECT src AS url, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e)
SELECT url, CAST(sum(o) AS BIGINT) AS out_links, CAST(sum(i) AS BIGINT) AS in_links FROM x GROUP BY url""",
    "q_clean_strip": f"""
SELECT p_partkey, p_name AS judul, {PRICE} AS harga,
    ['', ' ', chr(9), chr(10), ' ' || chr(9) || chr(13) || chr(10) || ' '][CAST(p_partkey % 5 + 1 AS INTEGER)]
    || p_brand AS nama FROM part""",
    "q_regex_numbers": """
SELECT o_orderkey, CAST(regexp_extract(o_orderpriority, '\\d+') AS INTEGER) AS level,
    CAST(NULL AS INTEGER) AS no_number, split_part(o_orderpriority, '-', 2) AS level_name,
    CAST(o_orderkey AS VARCHAR) AS tail, CAST(o_orderkey AS INTEGER) AS page_total,
    CAST(ceil(o_orderkey / 20.0) AS INTEGER) AS pages_needed,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
    CAST(len(regexp_extract_all('a b ' || replace(o_orderpriority, '-', ' '), '\\S+')) AS INTEGER) AS n_words,
    o_orderpriority LIKE '1%' AS urgent, lower(left(o_orderpriority, 3)) AS code,
    CAST(length(o_orderpriority) AS INTEGER) AS n_chars FROM orders""",
    "q_validate_books": f"SELECT * FROM ({DIRTY}) WHERE coalesce(judul, '') <> '' AND coalesce(harga, '') <> ''",
    "q_reject_report": f"""
SELECT 'BookItem' AS item_type,
    concat_ws(',', CASE WHEN coalesce(judul, '') = '' THEN 'judul' END,
              CASE WHEN harga = '' THEN 'harga' END) AS reason, CAST(to_json(d) AS VARCHAR) AS item
FROM ({DIRTY}) d WHERE coalesce(judul, '') = '' OR harga = ''""",
    "q_sink_csv_roundtrip": f"""
SELECT {odd('NULL')}, CASE WHEN p_partkey % 4 <> 0 THEN CASE WHEN p_size > 25 THEN 'Ya' ELSE 'Tidak' END END AS tersedia,
    '{{"title":"' || p_name || '","n":' || CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS VARCHAR)
    ELSE 'null' END || '}}' AS meta_html FROM part""",
    "q_sink_jsonl_roundtrip": f"""
SELECT {odd("''")}, CASE WHEN p_partkey % 4 <> 0 THEN p_size > 25 END AS tersedia, p_name AS title,
    CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS n, p_partkey % 3 = 0 AS null_kept FROM part""",
    "q_sink_ordered": f"""
WITH {TYPE_PAGES}, x AS (
    SELECT -1 AS hop, -1 AS pos, 'Home' AS nama, '{SHOP}/index.html' AS url
    UNION ALL SELECT i - 1, pos, CASE WHEN i = 1 THEN p_type ELSE p_type || ' — Halaman ' || i END, {type_url('slug', 'i')}
    FROM t JOIN (SELECT p_type AS name, row_number() OVER (ORDER BY p_type) - 1 AS pos FROM k) ON name = p_type)
SELECT row_number() OVER (ORDER BY hop, pos, url) - 1 AS place, nama, url FROM x""",
    "q_item_stats": f"""
WITH {TYPE_PAGES}, c AS (
    SELECT 'BookItem' AS item_type, count(*) AS n FROM ({DIRTY})
        WHERE coalesce(judul, '') <> '' AND coalesce(harga, '') <> ''
    UNION ALL SELECT 'ArticleItem', count(*) FROM documents
    UNION ALL SELECT 'BookStructureItem', count(*) + 1 FROM t
    UNION ALL SELECT 'WikiStructureItem', count(*) FROM documents)
SELECT * FROM c UNION ALL SELECT 'Total item', CAST(sum(n) AS BIGINT) FROM c""",
    "q_stream_chain": f"""
SELECT *, judul AS csv_judul FROM ({STREAM_ITEMS})""",
    "q_stream_extract": STREAM_ITEMS,
    "q_stream_dedup": "SELECT DISTINCT h AS href FROM (" + ANCHORS + "SELECT h FROM e)",
    "q_stream_walk": f"""
WITH {walk(LINK_EDGES, "'s0'", None, cap=None)} SELECT url, depth, referrer FROM visited""",
    "q_stream_visits": """
WITH e AS (SELECT user_id, event_type, event_id // ((SELECT max(event_id) FROM events) // 4 + 1) AS batch,
        epoch_us(ts) - CASE WHEN event_id % 40 = 0 THEN 18000000000 ELSE 0 END AS us FROM events),
    w AS (SELECT batch, max(max(us) // 1000 * 1000 - 7200000000) OVER (ORDER BY batch) AS mark FROM e GROUP BY batch),
    a AS (SELECT e.* FROM e LEFT JOIN w ON w.batch = e.batch - 1 WHERE us > coalesce(mark, 0)),
    g AS (SELECT *, coalesce(us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_type) > 21600000000, true) AS opens FROM a),
    v AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY user_id ORDER BY us, event_type ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT CAST(user_id AS VARCHAR) AS key, min(us) AS first_us, min_by(event_type, us) AS first_referrer, max(us) AS last_us, count(*) AS n
FROM v GROUP BY user_id, k HAVING max(us) + 21600000000 <= (SELECT max(mark) FROM w)""",
    "q_stream_metrics": """
SELECT 0 AS batch, count(*) AS items, CAST(sum(n) AS BIGINT) AS links, max(n) AS most_links
FROM (SELECT len(regexp_extract_all(html, '<a href=')) AS n FROM pages)""",
    "q_stream_counts": """
SELECT 'ArticleItem' AS item_type, count(*) AS n FROM (@@)
UNION ALL SELECT 'WikiStructureItem', count(*) FROM pages""".replace("@@", STREAM_ITEMS),
}
