"""DuckDB SQL that gives each query of the catalog, for value checks on the same tables."""

from __future__ import annotations

import re

from linkloom.sources.derived import AGENT, DOC_ID_OFFSET, FOCUS, KEYWORDS, NOW  # noqa: F401

SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"


def domain(url: str) -> str:
    return f"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


def path(url: str) -> str:
    return f"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def canonical(url: str) -> str:
    cut = f"split_part(split_part(lower(trim({url})), '#', 1), '?', 1)"
    return rf"regexp_replace(regexp_replace({cut}, '/$', ''), '/[^/]*(?:index\.html|index\.htm|default\.asp|default\.aspx)$', '')"


def resolved(base: str, link: str) -> str:
    root = f"regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', 0)"
    return canonical(f"CASE WHEN starts_with({link}, '/') THEN {root} || {link} ELSE {link} END")


def url_type(url: str) -> str:
    low = f"lower({url})"
    kinds = {
        ("html", "htm"): "HTML", ("pdf",): "PDF", ("jpg", "jpeg", "png"): "BINARY", ("doc",): "DOC", ("docx",): "DOCX",
        ("ppt",): "PPT", ("pptx",): "PPTX",
    }
    whens = " ".join(rf"WHEN regexp_matches({low}, '\.(?:{'|'.join(names)})$') THEN '{code}'" for names, code in kinds.items())
    return f"CASE {whens} ELSE 'HTML' END"


def relevance(url: str) -> str:
    keywords = " OR ".join(f"contains({url}, '{word}')" for word in KEYWORDS)
    return f"CAST(({domain(url)} = '{FOCUS}')::INT + ({keywords})::INT AS INT)"


def clean(html: str) -> str:
    quoted = """(?:"[^"]*"|''[^'']*''|[^"''>])*>"""
    dropped = (
        r"(?is)(<!--.*?(?:-->|\z))|<script(?:[\s/][^>]*)?>.*?(?:</script\s*>|\z)|<style(?:[\s/][^>]*)?>.*?(?:</style\s*>|\z)"
        rf"|<meta[\s/]{quoted}|<meta>|</(?:script|style|meta)\s*>"
    )
    tags = rf"\s*(<!--(?s:.*?)(?:-->|\z)|</?[A-Za-z!]{quoted})\s*"
    kept = rf"regexp_replace({html}, '{dropped}', '\1', 'g')"
    lines = rf"regexp_replace({kept}, '{tags}', chr(10) || '\1' || chr(10), 'g')"
    text = f"trim(replace({lines}, '>' || chr(10) || chr(10) || '<', '>' || chr(10) || '<'), chr(10))"
    return f"replace(replace({text}, '&copy;', chr(169)), '&middot;', chr(183))"  # the entities of the test pages


def found(html: str, tag: str, attribute: str) -> str:
    visible = rf"regexp_replace({html}, '(?s)<!--.*?(?:-->|\z)', '', 'g')"
    pattern = rf"""(?i)<{tag}\b(?:"[^"]*"|[^">])*?\b{attribute}="([^"]*)\""""
    return f"unnest(regexp_extract_all({visible}, '{pattern}', 1))"


def dense(key: str, start: str = "0") -> str:
    return f"{start} + row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key})"


def after_start(seconds: str) -> str:
    return f"(TIMESTAMP '2024-01-01 00:00:00' + to_seconds({seconds}))"


CTES = {
    "fetched": f"""
        SELECT page_id AS id, url, html, CAST(CASE WHEN page_id % 17 = 0 THEN 500 ELSE 200 END AS INT) AS http_status_code,
            CASE WHEN page_id % 17 = 0 THEN NULL WHEN page_id % 10 = 7 THEN 'application/pdf' WHEN page_id % 10 = 8 THEN 'image/png'
                WHEN page_id % 10 = 9 THEN 'video/mp4' ELSE 'text/html; charset=utf-8' END AS content_type,
            '10.0.0.' || (page_id % 4) AS accessed_ip, {after_start('page_id * 7')} AS accessed_time
        FROM pages""",
    "robots": f"""
        SELECT domain, CASE length(domain) % 3
            WHEN 0 THEN 'User-agent: *' || chr(10) || 'Disallow: /en/' || chr(10) || 'Crawl-delay: 3'
            WHEN 1 THEN 'User-agent: *' || chr(10) || 'Disallow: /d' || chr(10) || 'Allow: /' || chr(10) || 'Sitemap: https://' || domain || '/sitemap.xml'
            END AS robots_content
        FROM (SELECT DISTINCT {domain('url')} AS domain FROM pages)""",
    "site": f"SELECT {dense('domain')} AS id, domain, robots_content, CAST(NULL AS VARCHAR) AS sitemap_content FROM robots",
    "robot_lines": """
        SELECT domain, i - 1 AS line_no, lower(trim(split_part(line, ':', 1))) AS key, trim(substr(line, strpos(line, ':') + 1)) AS value
        FROM (SELECT domain, unnest(string_split(robots_content, chr(10))) AS line,
                generate_subscripts(string_split(robots_content, chr(10)), 1) AS i
              FROM robots WHERE robots_content IS NOT NULL)""",
    "rules": """
        SELECT domain, CAST(line_no AS INT) AS line_no, value AS path, key = 'allow' OR value = '' AS allow
        FROM robot_lines WHERE key IN ('allow', 'disallow')""",
    "access": "SELECT '10.0.0.' || user_id AS accessed_ip, event_type || '.example.com' AS domain, ts AS accessed_time FROM events",
    "requests": """
        SELECT site_url, ip, robots_delay FROM (
            SELECT DISTINCT domain AS site_url, accessed_ip AS ip FROM access UNION ALL SELECT 'unseen.example.com', '10.0.0.0'
        ), (VALUES (CAST(NULL AS DOUBLE)), (3600.0), (86400.0)) AS d(robots_delay)""",
    "last": "SELECT accessed_ip, domain, max(accessed_time) AS accessed_time FROM access GROUP BY ALL",
    "docs": "SELECT doc_id AS id, 'https://docs.example.com/' || source || '/' || doc_id AS url, text AS html_content FROM documents",
    "hashed": f"""
        SELECT id, url, {after_start('id % 100')} AS accessed_time, sha256({clean('html_content')}) AS content_hash FROM docs""",
    "doc_page": """
        SELECT content_hash, min(id) AS id FROM hashed WHERE contains(url, '/src1/') OR contains(url, '/src2/') GROUP BY content_hash""",
    "marked": """
        SELECT h.id, h.content_hash, h.accessed_time,
            coalesce(k.id, first_value(h.id) OVER (PARTITION BY h.content_hash ORDER BY h.accessed_time, h.id)) AS original_id
        FROM hashed h LEFT JOIN doc_page k USING (content_hash)""",
    "cleaned": f"SELECT page_id, url, {clean('html')} AS html_content FROM pages",
    "written": f"SELECT DISTINCT page_id, url, replace(value, '&amp;', '&') AS value FROM (SELECT page_id, url, {found('html_content', 'a', 'href')} AS value FROM cleaned) WHERE value <> ''",
    "all_links": f"SELECT page_id, {resolved('url', 'value')} AS link FROM written",
    "links": "SELECT DISTINCT page_id, link FROM all_links",
    "scored": f"SELECT page_id, link AS url, {relevance('link')} AS relevance FROM links",
    "file_links": """
        SELECT page_id, link || (['', '.html', '.pdf', '.PNG', '.doc', '.docx', '.ppt', '.pptx', '.gif', '/robots.txt'])[(length(link) + page_id) % 10 + 1] AS link
        FROM links""",
    "known": f"SELECT min(page_id) AS id, {canonical('url')} AS url FROM pages GROUP BY 2",
    "mixed": """
        SELECT id, url, (['FRONTIER', 'HTML', 'FRONTIER', 'BINARY'])[id % 4 + 1] AS page_type_code,
            CASE WHEN id % 7 <> 0 THEN CAST(id % 5 AS INT) END AS relevance
        FROM known""",
    "fresh": f"""
        SELECT {dense('url', '(SELECT max(id) FROM known)')} AS id, url, relevance
        FROM (SELECT url, any_value(relevance) AS relevance FROM scored GROUP BY url) WHERE url NOT IN (SELECT url FROM known)""",
    "clicks": "SELECT event_id, event_type, user_id AS from_page, CAST(floor(value) AS BIGINT) AS to_page FROM events",
    "known_clicks": "SELECT DISTINCT from_page, to_page FROM clicks WHERE event_type = 'error'",
    "first_clicks": """
        SELECT from_page, to_page, min(event_id) AS event_id FROM clicks
        WHERE (from_page, to_page) NOT IN (SELECT (from_page, to_page) FROM known_clicks) GROUP BY ALL""",
    "singles": "SELECT page_id, link AS url FROM links UNION ALL SELECT id, url FROM known",
    "single_firsts": """
        SELECT url, arg_min(page_id, page_id) AS page_id FROM singles WHERE url NOT IN (SELECT url FROM known) GROUP BY url""",
    "bodies": """
        SELECT event_id, event_type, user_id, value, event_id % 6 AS kind FROM events""",
    "listed": f"""
        SELECT {domain('url')} AS domain, CAST(page_id AS INT) AS line_no, 'https://' || {domain('url')} || '/sitemap-' || page_id || '.xml' AS sitemap_url, page_id, url
        FROM pages""",
    "located": """
        SELECT sitemap_url, 0 AS position, url FROM listed WHERE page_id % 9 <> 0
        UNION ALL SELECT sitemap_url, 1, 'https://' || domain || '/d/' || page_id FROM listed WHERE page_id % 9 <> 0""",
    "tree": """
        SELECT page_id AS from_page, child AS to_page FROM (
            SELECT page_id, unnest([page_id * 2 + 1, page_id * 2 + 2, CASE WHEN page_id % 3 = 0 THEN 0 END]) AS child FROM pages
        ) WHERE child IN (SELECT page_id FROM pages)""",
    # The round: all responses of pages and documents at once, the first of each URL.
    "round_all": f"""
        SELECT id, {canonical('url')} AS url, html || '<a href="/files/' || (id % 30) || '.pdf">f</a><img src="/img/' || (id % 50) || '.png">' AS html FROM fetched
        UNION ALL SELECT id + {DOC_ID_OFFSET}, url, html_content FROM docs""",
    "round_in": f"""
        SELECT f.id, k.url, html || '<a href="/files/' || (f.id % 30) || '.pdf">f</a><img src="/img/' || (f.id % 50) || '.png">' AS html,
            http_status_code, content_type, accessed_ip, accessed_time
        FROM fetched f JOIN known k USING (id)
        UNION ALL
        SELECT id + {DOC_ID_OFFSET}, url, html_content, 200, 'text/html', '10.0.0.1', {after_start('id % 100')} FROM docs""",
    "round_site": f"""
        SELECT {dense('domain')} AS id, domain, robots_content,
            CASE WHEN robots_content IS NULL THEN NULL WHEN length(domain) % 3 = 1 THEN coalesce(content, '') ELSE '' END AS sitemap_content
        FROM (SELECT DISTINCT {domain('url')} AS domain FROM round_in) LEFT JOIN robots USING (domain)
        LEFT JOIN (SELECT domain, string_agg(url || ' ', '' ORDER BY position, url) AS content FROM round_located GROUP BY domain) USING (domain)""",
    "round_located": """
        SELECT domain, position, located.url FROM located JOIN listed USING (sitemap_url) WHERE length(domain) % 3 = 1""",
    "classed": f"""
        SELECT id, url, http_status_code, accessed_ip, accessed_time, {domain('url')} AS domain,
            CASE WHEN contains(content_type, 'text/html') AND http_status_code = 200 AND NOT ends_with(url, '.pdf') THEN {clean('html')} END AS html_content
        FROM round_in""",
    "round_marked": """
        SELECT *, first_value(id) OVER (PARTITION BY sha256(html_content) ORDER BY accessed_time, id) AS first_id FROM classed""",
    "round_pages": """
        SELECT m.*, s.id AS site_id, html_content IS NOT NULL AND first_id <> m.id AS is_duplicate
        FROM round_marked m JOIN round_site s USING (domain)""",
    "round_sources": "SELECT * FROM round_pages WHERE html_content IS NOT NULL AND NOT is_duplicate",
    "round_found": f"SELECT id AS page_id, accessed_time, url, replace(value, '&amp;', '&') AS value FROM (SELECT id, accessed_time, url, {found('html_content', 'a', 'href')} AS value FROM round_sources) WHERE value <> ''",
    "round_links": f"SELECT DISTINCT page_id, accessed_time, {resolved('url', 'value')} AS link FROM round_found",
    "round_allowed": f"""
        SELECT page_id, accessed_time, link, {url_type('link')} AS type FROM round_links l WHERE coalesce((
            SELECT arg_min(allow, line_no) FROM rules r WHERE r.domain = {domain('l.link')} AND starts_with({path('l.link')}, r.path)), true)""",
    "round_maps": f"""
        SELECT f.page_id, l.url AS raw, {canonical('l.url')} AS link FROM round_located l
        JOIN (SELECT domain, arg_min(id, (accessed_time, id)) AS page_id FROM round_pages GROUP BY domain) f USING (domain)
        WHERE coalesce((SELECT arg_min(allow, line_no) FROM rules r WHERE r.domain = {domain('l.url')} AND starts_with({path('l.url')}, r.path)), true)""",
    "round_scored": f"""
        SELECT p.accessed_time, m.page_id, 0 AS step, m.link AS url, 3 AS relevance FROM round_maps m JOIN round_pages p ON p.id = m.page_id
        UNION ALL SELECT accessed_time, page_id, 1, link, {relevance('link')} FROM round_allowed WHERE type = 'HTML'""",
    "round_fresh": f"""
        SELECT {dense('url', '(SELECT max(id) FROM round_in)')} AS id, url, CAST(relevance AS INT) AS relevance FROM (
            SELECT url, arg_min(relevance, (accessed_time, page_id, step, url)) AS relevance FROM round_scored
            WHERE url NOT IN (SELECT url FROM round_in) GROUP BY url)""",
}

ORACLE = {
    "page_source": "SELECT * FROM fetched",
    "site_append": "SELECT * FROM site",
    "frontier_append": f"SELECT {dense('url', '(SELECT max(id) FROM known)')} AS id, url, CAST(3 AS BIGINT) AS site_id, 'FRONTIER' AS page_type_code, CAST(NULL AS INT) AS relevance FROM single_firsts",
    "frontier_append_rejects": "SELECT page_id, url FROM singles WHERE (page_id, url) NOT IN (SELECT (page_id, url) FROM single_firsts)",
    "seed_frontier": f"SELECT {dense('url')} AS id, url, 'FRONTIER' AS page_type_code, CAST(3 AS INT) AS relevance FROM known",
    "link_batch_explode": "SELECT page_id AS from_page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY url) - 1 AS INT) AS position, url, relevance FROM scored",
    "page_data_append": f"""
        SELECT {dense('key')} AS id, page_id, data_type_code, true AS no_data FROM (
            SELECT DISTINCT page_id, {url_type('link')} AS data_type_code, page_id || ' ' || link AS key FROM file_links) WHERE data_type_code <> 'HTML'""",
    "image_append": f"""
        SELECT {dense('filename')} AS id, page_id, filename, 'image' AS content_type, md5(text) AS data_md5, TIMESTAMP '2024-01-01 00:00:00' AS accessed_time FROM (
            SELECT doc_id AS page_id, lang || '-' || doc_id || '.png' AS filename, text FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 13 <> 0)""",
    "image_append_rejects": "SELECT doc_id AS page_id, lang || '-' || doc_id || '.png' AS filename FROM documents WHERE doc_id % 11 = 0 OR doc_id % 13 = 0",
    "link_append_strict": "SELECT from_page, to_page FROM first_clicks",
    "link_append_strict_rejects": "SELECT event_id, from_page, to_page FROM clicks WHERE event_id NOT IN (SELECT event_id FROM first_clicks)",
    "snapshot_sink": "SELECT * FROM mixed",
    "domain_of": f"SELECT page_id, {domain('url')} AS domain FROM pages",
    "normalize_url": f"SELECT page_id, value AS link, {resolved('url', 'value')} AS url FROM (SELECT page_id, url, value FROM written UNION ALL SELECT page_id, url, url FROM pages)",
    "mime_class": """
        SELECT id, CASE WHEN contains(content_type, 'text/html') THEN 'HTML' WHEN contains(content_type, 'application/pdf') THEN 'BINARY'
            WHEN contains(content_type, 'image/') THEN 'IMAGE' WHEN contains(content_type, 'video/') THEN 'VIDEO' ELSE 'UNKNOWN' END AS class FROM fetched""",
    "url_type": f"SELECT page_id, link, {url_type('link')} AS type FROM file_links",
    "fetch_class": """
        SELECT id, class, CASE WHEN class = 'HTML' THEN 'HTML' ELSE 'BINARY' END AS page_type_code FROM (
            SELECT id, CASE WHEN http_status_code IN (500, 502, 503, 504) THEN NULL WHEN ends_with(url, '.pdf') OR content_type = 'application/pdf' THEN 'BINARY'
                WHEN contains(content_type, 'text/html') THEN 'HTML' WHEN contains(content_type, 'image/') THEN 'IMAGE' ELSE 'VIDEO' END AS class FROM fetched)""",
    "needs_render": """
        SELECT page_id, contains(h, 'data-placeholder') OR contains(lower(h), 'please enable javascript') AS needs_render FROM (
            SELECT page_id, html || CASE page_id % 13 WHEN 0 THEN '<div data-placeholder="x">' WHEN 1 THEN 'Please ENABLE JavaScript' ELSE 'DATA-PLACEHOLDER' END AS h FROM pages)""",
    "relevance": "SELECT * FROM scored",
    "link_route": f"""
        SELECT page_id, link, CASE WHEN type = 'HTML' THEN 'frontier' ELSE 'page_data' END AS route, CASE WHEN type <> 'HTML' THEN type END AS data_type_code,
            CASE WHEN type = 'HTML' THEN {relevance('link')} END AS relevance FROM (SELECT *, {url_type('link')} AS type FROM file_links)""",
    "href_filter": """
        SELECT * FROM (SELECT page_id, (['href', 'src', 'onclick'])[page_id % 3 + 1] AS kind, CASE WHEN length(value) % 5 <> 0 THEN value ELSE '' END AS value FROM written)
        WHERE kind = 'onclick' OR value <> ''""",
    "image_filename": "SELECT page_id, link, string_split(link, '/')[-1] AS filename FROM links",
    "same_site_links": """
        SELECT page_id, href, link FROM (
            SELECT page_id, href, CASE WHEN starts_with(href, '/') THEN root || href ELSE href END AS link, root FROM (
                SELECT page_id, href, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS root FROM (
                    SELECT page_id, url, value AS href FROM written UNION ALL SELECT page_id, url, url FROM pages
                    UNION ALL SELECT page_id, url, 'https://away.example/' || page_id FROM pages)))
        WHERE contains(link, root)""",
    "validate_rows": """
        SELECT event_id, event_type AS site_url, '10.0.0.' || user_id AS ip, CASE WHEN kind = 0 THEN floor(value) END AS robots_delay FROM bodies WHERE kind IN (0, 1, 2)""",
    "validate_rows_rejects": "SELECT event_id FROM bodies WHERE kind IN (3, 4, 5)",
    "payload_contracts": "SELECT event_id, from_page, to_page FROM clicks WHERE event_id % 3 <> 2",
    "length_checks": "SELECT id, CAST(length(html_content) AS INT) AS n_chars FROM docs WHERE length(html_content) > 3000",
    "access_join": """
        SELECT r.site_url, r.ip, a.accessed_time FROM access a JOIN (SELECT DISTINCT site_url, ip FROM requests) r
        ON r.ip = a.accessed_ip AND r.site_url = a.domain""",
    "access_join_like": """
        SELECT r.site_url, r.ip, a.domain, a.accessed_time FROM access a JOIN (
            SELECT DISTINCT substr(site_url, 3, 4) AS site_url, ip FROM requests UNION SELECT '_l%example', ip FROM requests
        ) r ON r.ip = a.accessed_ip AND a.domain LIKE '%' || r.site_url || '%'""",
    "url_to_id": """
        SELECT s.page_id AS from_page, p.id AS to_page FROM (SELECT page_id, url FROM scored UNION ALL SELECT id, url FROM known) s
        JOIN (SELECT id, url FROM known UNION ALL SELECT id, url FROM fresh) p USING (url)""",
    "frontier_insert_ignore": "SELECT id, url, CAST(NULL AS BIGINT) AS site_id, 'FRONTIER' AS page_type_code, relevance FROM fresh",
    "link_insert_ignore": "SELECT from_page, to_page FROM first_clicks",
    "site_lookup": """
        SELECT d AS domain, min(s.id) IS NOT NULL AS exists, min(s.id) AS site_id
        FROM (SELECT DISTINCT regexp_replace(domain, '^www[.]', '') AS d FROM robots) LEFT JOIN site s ON s.domain = d GROUP BY d""",
    "site_lookup_like": """
        SELECT d AS domain, min(s.id) IS NOT NULL AS exists, min(s.id) AS site_id FROM (
            SELECT DISTINCT unnest([upper(domain), split_part(domain, '.', 1) || '.' || split_part(domain, '.', 2), split_part(domain, '.', 1) || '%.example.__t']) AS d FROM robots
        ) LEFT JOIN site s ON s.domain ILIKE '%' || d || '%' GROUP BY d""",
    "site_get_or_create": f"SELECT {dense('domain', '(SELECT max(id) FROM site WHERE robots_content IS NOT NULL)')} AS id, domain, robots_content, '' AS sitemap_content FROM robots WHERE robots_content IS NULL",
    "hash_lookup": "SELECT h.id AS asked_id, p.id IS NOT NULL AS exists, p.id AS page_id FROM hashed h LEFT JOIN doc_page p USING (content_hash)",
    "page_update": """
        SELECT k.id, CASE WHEN k.id % 4 = 1 THEN CASE WHEN k.id % 8 = 1 THEN k.id END ELSE 7 END AS site_id,
            CASE k.id % 4 WHEN 0 THEN 'BINARY' WHEN 3 THEN 'FRONTIER' ELSE 'HTML' END AS page_type_code, k.url,
            CASE WHEN k.id % 4 IN (1, 2) THEN CAST(length(f.html) AS INT) END AS n_chars, CASE WHEN k.id % 4 <> 3 THEN f.http_status_code END AS http_status_code,
            CASE WHEN k.id % 4 <> 3 THEN f.accessed_time END AS accessed_time, CASE WHEN k.id % 4 <> 3 THEN f.accessed_ip END AS accessed_ip,
            CAST(3 AS INT) AS relevance, CASE WHEN k.id % 4 <> 3 THEN sha256(f.html) END AS content_hash
        FROM known k JOIN fetched f USING (id)""",
    "page_update_rejects": "SELECT id + CASE WHEN id % 4 = 3 THEN 1000000000000 ELSE 0 END AS id FROM fetched WHERE id % 4 = 3 OR id NOT IN (SELECT id FROM known)",
    "robots_allowed": f"""
        SELECT l.page_id, l.link, coalesce(arg_min(r.allow, r.line_no), true) AS allowed
        FROM (SELECT page_id, link FROM links UNION ALL SELECT id, url FROM known) l
        LEFT JOIN rules r ON r.domain = {domain('l.link')} AND starts_with({path('l.link')}, r.path) GROUP BY ALL""",
    "duplicate_link": "SELECT original_id AS from_page, id AS to_page FROM marked WHERE original_id <> id",
    "duplicate_update": f"""
        SELECT id, CASE WHEN original_id <> id THEN 'DUPLICATE' END AS page_type_code, CASE WHEN original_id = id THEN content_hash END AS content_hash,
            CASE WHEN original_id <> id THEN TIMESTAMP '{NOW}' END AS accessed_time FROM marked""",
    "fk_violations": """
        SELECT 'page.site_id' AS constraint, CAST(length(url) AS VARCHAR) AS value, count(*) AS n_rows FROM known WHERE length(url) NOT IN (SELECT id FROM site) GROUP BY ALL
        UNION ALL SELECT 'link.from_page', CAST(from_page AS VARCHAR), count(*) FROM clicks WHERE from_page NOT IN (SELECT id FROM known) GROUP BY ALL
        UNION ALL SELECT 'link.to_page', CAST(to_page AS VARCHAR), count(*) FROM clicks WHERE to_page NOT IN (SELECT id FROM known) GROUP BY ALL""",
    "unique_violations": """
        SELECT 'page.url' AS constraint, regexp_extract(url, '^([^/]*/){3}[^/]*', 0) AS value, count(*) AS n_rows FROM hashed GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT 'page.content_hash', content_hash, count(*) FROM hashed GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT 'link.from_page,to_page', from_page || ',' || to_page, count(*) FROM clicks GROUP BY ALL HAVING count(*) > 1""",
    "html_count": "SELECT count(*) AS html_page_count FROM mixed WHERE page_type_code = 'HTML'",
    "crawl_done": "SELECT count(*) > 25000 AS done FROM mixed WHERE page_type_code = 'HTML'",
    "last_access": "SELECT * FROM last",
    "politeness_delay": f"""
        SELECT site_url, ip, robots_delay, CASE WHEN passed < wait THEN wait - passed ELSE 0.0 END AS delay FROM (
            SELECT r.*, coalesce(robots_delay, 5.0) AS wait, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(l.accessed_time)) / 1e6 AS passed
            FROM requests r LEFT JOIN last l ON l.accessed_ip = r.ip AND l.domain = r.site_url)""",
    "politeness_delay_like": f"""
        SELECT site_url, ip, robots_delay, CASE WHEN passed < wait THEN wait - passed ELSE 0.0 END AS delay FROM (
            SELECT r.*, coalesce(robots_delay, 5.0) AS wait, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(latest)) / 1e6 AS passed FROM (
                SELECT r.site_url, r.ip, r.robots_delay, max(l.accessed_time) AS latest FROM (SELECT DISTINCT substr(site_url, 2, 3) AS site_url, ip, robots_delay FROM requests) r
                LEFT JOIN last l ON l.accessed_ip = r.ip AND l.domain LIKE '%' || r.site_url || '%' GROUP BY ALL) r)""",
    "distinct_links": "SELECT * FROM links",
    "sitemap_content": """
        SELECT domain, CASE WHEN robots_content IS NOT NULL THEN coalesce(content, '') END AS sitemap_content FROM robots LEFT JOIN (
            SELECT l.domain, string_agg(f.url || ' ', '' ORDER BY l.line_no, f.position) AS content FROM listed l JOIN located f USING (sitemap_url) GROUP BY l.domain) USING (domain)""",
    "sitemap_parts": """
        SELECT domain, part, string_agg(url || ' ', '' ORDER BY line_no, position) AS text FROM (
            SELECT l.domain, l.line_no, f.position, f.url, CAST((sum(strlen(f.url) + 1) OVER (PARTITION BY l.domain ORDER BY l.line_no, f.position) - strlen(f.url) - 1) // 100 AS BIGINT) AS part
            FROM listed l JOIN located f USING (sitemap_url) WHERE f.url IS NOT NULL) GROUP BY domain, part""",
    "mark_duplicates": """
        SELECT id, original_id, original_id <> id AS is_duplicate FROM (
            SELECT id, first_value(id) OVER (PARTITION BY content_hash ORDER BY accessed_time, id) AS original_id FROM hashed)""",
    "mark_duplicates_known": "SELECT id, original_id, original_id <> id AS is_duplicate FROM marked",
    "robots_rules": "SELECT * FROM rules",
    "crawl_delay": "SELECT domain, CAST(value AS BIGINT) AS crawl_delay FROM robot_lines WHERE key = 'crawl-delay'",
    "dense_ids": f"SELECT url, {dense('url')} AS id FROM pages",
    "frontier_topk": "SELECT id, url, relevance FROM mixed WHERE page_type_code = 'FRONTIER' ORDER BY relevance DESC NULLS FIRST, id LIMIT 20",
    "frontier_topk_large": """
        SELECT id, url, relevance FROM (SELECT *, row_number() OVER (ORDER BY relevance DESC NULLS FIRST, id) AS place, count(*) OVER () AS n FROM mixed WHERE page_type_code = 'FRONTIER')
        WHERE place <= n // 3""",
    "claim_due": f"""
        SELECT id, url, relevance FROM mixed WHERE page_type_code = 'FRONTIER' AND {domain('url')} NOT IN (
            SELECT s.domain FROM mixed m JOIN site s ON s.domain = {domain('m.url')}
            WHERE page_type_code <> 'FRONTIER' AND 7 - length(s.domain) % 7 < CASE WHEN length(s.domain) % 3 = 0 THEN 3 ELSE 5 END)""",
    "claim_schedule": f"""
        SELECT id, url, relevance, domain, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(starts + (place - 1) * delay) AS not_before FROM (
            SELECT m.*, row_number() OVER (PARTITION BY m.domain ORDER BY relevance DESC NULLS FIRST, id) AS place, d.delay, greatest(7, coalesce(a.last + d.delay, 7)) AS starts
            FROM (SELECT id, url, relevance, {domain('url')} AS domain FROM mixed WHERE page_type_code = 'FRONTIER') m
            JOIN (SELECT DISTINCT domain, CASE WHEN length(domain) % 3 = 0 AND domain IN (SELECT domain FROM site) THEN 3 ELSE 5 END AS delay
                  FROM (SELECT {domain('url')} AS domain FROM mixed)) d USING (domain)
            LEFT JOIN (SELECT DISTINCT s.domain, length(s.domain) % 7 AS last FROM mixed x JOIN site s ON s.domain = {domain('x.url')} WHERE page_type_code <> 'FRONTIER') a USING (domain)
        ) WHERE starts + (place - 1) * delay <= 16""",
    "last_page_access": """
        SELECT event_type AS accessed_ip, 'c' || c_nationkey || '.example' AS domain, max(ts) AS accessed_time
        FROM events JOIN customer ON c_custkey = user_id WHERE ts IS NOT NULL GROUP BY ALL""",
    "frontier_claim": f"""
        SELECT m.id, m.url, CASE WHEN c.id IS NULL THEN page_type_code ELSE 'CRAWLING' END AS page_type_code, CASE WHEN c.id IS NOT NULL THEN TIMESTAMP '{NOW}' END AS accessed_time
        FROM mixed m LEFT JOIN (SELECT id FROM mixed WHERE page_type_code = 'FRONTIER' ORDER BY relevance DESC NULLS FIRST, id LIMIT 20) c USING (id)""",
    "frontier_topk_per_site": f"""
        SELECT * FROM (SELECT id, url, relevance, {domain('url')} AS domain, CAST(row_number() OVER (PARTITION BY {domain('url')} ORDER BY relevance DESC NULLS FIRST, id) AS INT) AS rank
            FROM mixed WHERE page_type_code = 'FRONTIER') WHERE rank <= 2""",
    "stale_claims": f"SELECT id, url, {after_start('id')} AS accessed_time FROM mixed WHERE page_type_code = 'BINARY' AND {after_start('id')} < TIMESTAMP '2024-01-01 00:01:40'",
    "latest_access_top1": "SELECT * FROM access ORDER BY accessed_time DESC, accessed_ip, domain LIMIT 1",
    "any_first": "SELECT content_hash, min(id) AS id, arg_min(url, id) AS url FROM hashed GROUP BY content_hash",
    "union_state": "SELECT id, url, CAST(3 AS INT) AS relevance FROM known UNION ALL SELECT id, url, relevance FROM fresh",
    "except_existing": "SELECT DISTINCT link AS url FROM links WHERE link NOT IN (SELECT url FROM known)",
    "intersect_known": "SELECT url FROM known",
    "distinct_urls": "SELECT DISTINCT link FROM links",
    "clean_html": "SELECT page_id, html_content FROM cleaned",
    "content_hash": "SELECT id, content_hash FROM hashed",
    "extract_links": "SELECT * FROM all_links",
    "extract_images": f"""
        SELECT id AS page_id, {resolved('url', 'value')} AS link FROM (SELECT id, url, {found('h', 'img', 'src')} AS value FROM (SELECT id, url, {clean('html')} AS h FROM round_all)) WHERE value <> ''""",
    "robots_sitemaps": "SELECT domain, CAST(line_no AS INT) AS line_no, value AS sitemap_url FROM robot_lines WHERE key = 'sitemap'",
    "sitemap_urls": "SELECT sitemap_url, CAST(position AS INT) AS position, url FROM located",
    "sitemap_frontier": f"""
        SELECT domain, line_no, CAST(position AS INT) AS position, {canonical('f.url')} AS url, CAST(3 AS INT) AS relevance FROM listed JOIN located f USING (sitemap_url)
        WHERE coalesce((SELECT arg_min(allow, r.line_no) FROM rules r WHERE r.domain = {domain('f.url')} AND starts_with({path('f.url')}, r.path)), true)""",
    "crawl_round": """
        SELECT id, site_id, CASE WHEN is_duplicate THEN 'DUPLICATE' WHEN html_content IS NULL THEN 'BINARY' ELSE 'HTML' END AS page_type_code, url,
            CASE WHEN NOT is_duplicate THEN CAST(length(html_content) AS INT) END AS n_chars, http_status_code, accessed_time, accessed_ip, CAST(3 AS INT) AS relevance,
            CASE WHEN NOT is_duplicate THEN sha256(html_content) END AS content_hash
        FROM round_pages""",
    "crawl_round_frontier": "SELECT id, url, 'FRONTIER' AS page_type_code, relevance FROM round_fresh",
    "crawl_round_links": """
        SELECT DISTINCT s.page_id AS from_page, p.id AS to_page FROM round_scored s JOIN (SELECT id, url FROM round_fresh UNION ALL SELECT id, url FROM round_in) p USING (url)
        UNION SELECT first_id, id FROM round_pages WHERE is_duplicate""",
    "crawl_round_sites": "SELECT id, domain, robots_content, sitemap_content FROM round_site",
    "crawl_round_page_data": f"SELECT {dense('key')} AS id, page_id, type AS data_type_code FROM (SELECT DISTINCT page_id, type, lpad(CAST(page_id AS VARCHAR), 20, '0') || ' ' || link AS key FROM round_allowed WHERE type <> 'HTML')",
    "crawl_round_images": f"""
        SELECT {dense('key')} AS id, page_id, string_split(link, '/')[-1] AS filename, 'image' AS content_type, accessed_time FROM (
            SELECT DISTINCT page_id, link, accessed_time, lpad(CAST(page_id AS VARCHAR), 20, '0') || ' ' || link AS key FROM (
                SELECT id AS page_id, accessed_time, {resolved('url', 'value')} AS link FROM (
                    SELECT id, accessed_time, url, {found('html_content', 'img', 'src')} AS value FROM round_sources) WHERE value <> ''))""",
    # The second round finds no response for any URL that the first one added, and ends the crawl.
    "crawl_to_limit": """
        SELECT page_type_code, count(*) AS n_pages FROM (
            SELECT CASE WHEN is_duplicate THEN 'DUPLICATE' WHEN html_content IS NULL THEN 'BINARY' ELSE 'HTML' END AS page_type_code FROM round_pages
            UNION ALL SELECT 'BINARY' FROM round_fresh) GROUP BY 1""",
    "reachable_pages": """
        SELECT id, CAST(min(depth) AS INT) AS depth FROM reach GROUP BY id""",
    "stream_ingest": """
        SELECT id, url, CASE WHEN NOT is_html THEN 'BINARY' WHEN first_id = id THEN 'HTML' ELSE 'DUPLICATE' END AS page_type_code,
            CASE WHEN is_html AND first_id = id THEN content_hash END AS content_hash
        FROM (SELECT h.*, d.lang <> 'fr' AS is_html, first_value(h.id) OVER (PARTITION BY d.lang <> 'fr', content_hash ORDER BY accessed_time, h.id) AS first_id
              FROM hashed h JOIN documents d ON d.doc_id = h.id)""",
    "stream_first_seen": "SELECT DISTINCT content_hash FROM hashed h JOIN documents d ON d.doc_id = h.id WHERE d.lang <> 'fr'",
    "stream_stored_count": """
        SELECT CASE WHEN NOT is_html THEN 'BINARY' WHEN first_id = id THEN 'HTML' ELSE 'DUPLICATE' END AS page_type_code, count(*) AS n
        FROM (SELECT h.id, d.lang <> 'fr' AS is_html, first_value(h.id) OVER (PARTITION BY d.lang <> 'fr', content_hash ORDER BY accessed_time, h.id) AS first_id
              FROM hashed h JOIN documents d ON d.doc_id = h.id) GROUP BY 1""",
    "stream_html_count": "SELECT CASE WHEN lang = 'fr' THEN 'BINARY' ELSE 'HTML' END AS page_type_code, count(*) AS n FROM documents GROUP BY 1",
    "best_links": "SELECT url, relevance FROM (SELECT url, any_value(relevance) AS relevance FROM scored GROUP BY url) ORDER BY relevance DESC NULLS FIRST, url LIMIT 20",
}


def contracts() -> str:
    """Fields of each contract in order: R has to be there, N may be missing or null."""
    kinds = {"site": "RNN", "delay": "RRN", "page_frontier": "RR", "page": "RNNR", "page_data": "RRR", "image": "RRRRN", "link": "RR"}
    fits = {"R": "(0, 4)", "N": "(0, 2, 3, 4)"}
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, event_id FROM events WHERE " + " AND ".join(f"event_id // {5**i} % 5 IN {fits[f]}" for i, f in enumerate(fields))
        for kind, fields in kinds.items()
    )


ORACLE |= {
    "payload_contracts_tables": contracts(),
    "length_checks_tables": "SELECT 'site' AS table, event_id FROM events WHERE event_id % 700 > 500 UNION ALL SELECT 'image', event_id FROM events WHERE event_id % 700 > 255",
    "fk_violations_files": """
        SELECT 'page_data.page_id' AS constraint, CAST(user_id AS VARCHAR) AS value, count(*) AS n_rows FROM events WHERE user_id NOT IN (SELECT page_id FROM pages) GROUP BY ALL
        UNION ALL SELECT 'page_data.data_type_code', event_type, count(*) FROM events WHERE event_id % 3 = 2 GROUP BY ALL
        UNION ALL SELECT 'image.page_id', CAST(event_id % 400 AS VARCHAR), count(*) FROM events WHERE event_id % 400 NOT IN (SELECT page_id FROM pages) GROUP BY ALL""",
    "crawl_done_by_turn": """
        SELECT CAST(unnest([0, 9, 10]) AS INT) AS turn, unnest([n > 50, false, n > 50]) AS done FROM (SELECT count(*) AS n FROM mixed WHERE page_type_code = 'HTML')""",
}
# The same rows, found through the store's indexes.
ORACLE |= {f"{new}_indexed": ORACLE[old] for new, old in (("frontier_insert", "frontier_insert_ignore"), ("url_to_id", "url_to_id"), ("hash_lookup", "hash_lookup"))}
# Reachability has its own recursive part.
_REACH = f"""reach(id, depth) AS (
    SELECT page_id, 0 FROM pages WHERE {domain('url')} = '{FOCUS}'
    UNION SELECT tree.to_page, reach.depth + 1 FROM reach JOIN tree ON tree.from_page = reach.id WHERE reach.depth < 64)"""


def with_tables(select: str) -> str:
    """``select`` behind the derived tables that it uses, in order of need."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", text):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed[name] = None

    recursive = "FROM reach" in select
    visit(_REACH if recursive else select)
    parts = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in needed] + ([_REACH] if recursive else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {select}" if parts else select


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(select) for name, select in ORACLE.items()}
