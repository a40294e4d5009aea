"""DuckDB twins of the registered queries.

Every query is one SELECT over the driver's tables. Shared ``WITH`` parts are
put together from the snippets below; they restate ``checks.views`` in SQL.
"""

from __future__ import annotations

from pagesieve.functions import patterns as P

# --- derived inputs -----------------------------------------------------------
PAGES = r"""p AS (
  SELECT page_id, url, html, regexp_extract(html, '<html lang="(..)"', 1) AS lang,
         regexp_extract(url, '^https?://([^/?#]+)', 1) AS host
  FROM pages)"""

META_PAGES = PAGES + r""", mp AS (
  SELECT page_id, url, lang, host, replace(html, '<head>', '<head>' ||
    CASE WHEN ends_with(url, '#top') THEN '<meta name="description" content="Ten chars.">'
         WHEN ends_with(url, '.html') THEN '<meta name="description" content="A page kept at ' || host || '">'
         WHEN ends_with(url, '/') THEN '<meta name="description" content="' || host
              || '"><meta property="twitter:description" content="It''s the page of ' || host || ' again">'
         WHEN contains(url, 'utm_source') THEN '<meta content="content first, name behind" name="description">'
         WHEN contains(url, 'ref=') THEN '<meta name="title" content="">'
         ELSE '' END
    || '<meta name="author" content="Desk ' || host || '"><meta property="og:type" content="article">'
    || '<meta name="keywords" content="' || lang || ',' || host
    || '"><meta property="og:site_name" content="Site ' || host || '">') AS html
  FROM p)"""

TABLE_PAGES = PAGES + r""", tp AS (
  SELECT page_id, url, replace(html, '</article>',
    '<table><tr><th>Host</th><th>Lang</th></tr><tr><td>' || host || '</td><td>' || lang
    || '</td></tr></table></article>') AS html
  FROM p)"""

ARCHIVE = "'seg-' || lpad(CAST(page_id // 25 AS VARCHAR), 9, '0') || '.warc.gz'"

NOTES = PAGES + r""", nt AS (
  SELECT *, 'fetchTimeMs: ' || length(url) || chr(13) || chr(10) || 'charset-detected: UTF-8' || chr(13) || chr(10)
    || 'no colon here' || chr(13) || chr(10) || 'source: ' || url || chr(13) || chr(10)
    || CASE WHEN contains(url, 'ref=') THEN '' ELSE
       'languages-cld2: {"reliable":true,"text-bytes":' || length(html) || ',"languages":['
       || CASE WHEN ends_with(url, '/') THEN
            '{"code":"en","text-covered":0.5,"score":' || length(html) || '.0},{"code":"' || lang
            || '","text-covered":0.5,"score":' || length(html) || '.0}'
          ELSE '{"code":"' || lang || '","text-covered":0.8,"score":' || length(html)
            || '.0},{"code":"en","text-covered":0.12,"score":' || length(html) || '.0}' END
       || ']}' || chr(13) || chr(10) END AS note,
    CASE WHEN contains(url, 'ref=') THEN NULL WHEN ends_with(url, '/') THEN 'en' ELSE lang END AS dominant
  FROM p)"""

RECORDS = NOTES + rf""", rec AS (
  SELECT {ARCHIVE} AS warc_path, 2 * page_id AS rec_seq, 'response' AS rec_type,
         '<urn:md5:' || md5(url) || '>' AS record_id, url AS target_uri,
         CASE WHEN ends_with(url, '#top') THEN 'text/html; charset=utf-8'
              WHEN contains(url, 'ref=') THEN 'application/pdf' ELSE 'text/html' END AS content_type,
         html AS body, NULL AS dominant, lang, page_id
  FROM nt
  UNION ALL
  SELECT {ARCHIVE}, 2 * page_id + 1, 'metadata', '<urn:md5:' || md5(url || '!') || '>', url, NULL,
         note, dominant, lang, page_id
  FROM nt)"""

LEDGER = PAGES + rf""", mani AS (
  SELECT warc_path FROM (SELECT DISTINCT {ARCHIVE} AS warc_path, lang FROM p)),
led AS (
  SELECT warc_path, CASE WHEN substr(md5(warc_path), 1, 1) < '6' THEN 'ok' ELSE 'failed' END AS status
  FROM (SELECT DISTINCT warc_path FROM mani) WHERE substr(md5(warc_path), 1, 1) < 'a')"""


# --- page metadata --------------------------------------------------------------
def meta_pattern(names: str) -> str:
    return f"""<meta[^>]+(?:name|property)=["''](?:{names})["''][^>]+content=["''](.*?)["'']"""


def quoted(pattern: str) -> str:
    """A pattern inside a SQL string literal."""
    return pattern.replace("'", "''")


# the same names and pattern as the job's, from pagesieve/functions/patterns.py
DESCRIPTION = meta_pattern("|".join(P.DESCRIPTION_NAMES))
TITLE = meta_pattern("|".join(P.TITLE_NAMES))
CHARSET = quoted(P.DECLARED_CHARSET)


def longest(items: str) -> str:
    return f"list_sort(list_transform({items}, lambda x, i: {{'n': -strlen(x), 'i': i, 'x': x}}))[1].x"


def found(col: str, pattern: str, group: int = 1) -> str:
    return f"CASE WHEN regexp_matches({col}, '{pattern}') THEN regexp_extract({col}, '{pattern}', {group}) END"


def every(col: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({col}, '{pattern}', {group})"


META_DESCRIPTION = longest(every("html", DESCRIPTION))
META_TITLE = f"coalesce({longest(every('html', TITLE))}, {found('html', '<title>(.*?)</title>')})"
META_HEADING = longest(
    f"list_transform({every('html', '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>')}, "
    "lambda h: trim(regexp_replace(h, '<[^>]+>', '', 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))")

def probes(src: str) -> str:
    return rf"""probe AS (
  SELECT page_id, replace(coalesce(CASE WHEN length(d) > 10 THEN d END, CASE WHEN length(t) > 5 THEN t END,
                                   CASE WHEN length(h) > 10 THEN h END), chr(10), ' ') AS probe
  FROM (SELECT page_id, {META_DESCRIPTION} AS d, {META_TITLE} AS t, {META_HEADING} AS h FROM {src}))"""


# --- blocks -----------------------------------------------------------------------
BLOCK_TAGS = (
    "h[1-6]|p|li|tr|div|ul|ol|dl|dt|dd|table|thead|tbody|tfoot|caption|article|section|main|"
    "header|blockquote|pre|figure|figcaption|address|details|summary|fieldset|hr|br|body|html|center"
)
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", " "),
    ("&copy;", "©"), ("&middot;", "·"), ("&euro;", "€"), ("&amp;", "&"),
)
WIDE = r"\x{3040}-\x{30ff}\x{3400}-\x{9fff}"


def marked(html: str, formatting: bool = False, tables: bool = True) -> str:
    def gone(s, pattern, by="''"):
        return f"regexp_replace({s}, '{pattern}', {by}, 'g')"

    raw = "|".join(rf"<{tag}(?:[\s/][^>]*)?>.*?(?:</{tag}\s*>|\z)"
                   for tag in ("script", "style", "noscript", "template"))
    side = "|".join(rf"<{tag}(?:[\s/][^>]*)?>.*?</{tag}\s*>"
                    for tag in ("head", "nav", "footer", "aside", "form") + (() if tables else ("table",)))
    s = gone(html, r"[\x01-\x04]", "' '")
    s = gone(s, rf"(?is)<!--.*?(?:-->|\z)|{raw}")
    s = gone(s, rf"(?is){side}", "chr(1)")
    if formatting:
        s = gone(s, r"(?i)<(?:b|strong)(?:\s[^>]*)?>\s?([^<\s][^<]*)</(?:b|strong)\s*>", r"'**\1**'")
    s = gone(s, r"(?i)<a(?:\s[^>]*)?>", "chr(3)")
    s = gone(s, r"(?i)</a\s*>", "chr(4)")
    s = gone(s, r"(?i)<t[dh](?:[\s/][^>]*)?>", "' | '")
    s = gone(s, rf"(?i)<(?:/(?:{BLOCK_TAGS})\s*|({BLOCK_TAGS})(?:[\s/][^>]*)?)>", r"chr(1) || '\1' || chr(2)")
    return gone(s, r"<[a-zA-Z/!?][^>]*(?:>|\z)")


def one_blank(col: str, entities: bool = False) -> str:
    for name, char in ENTITIES if entities else ():
        col = f"replace({col}, '{name}', '{char}')"
    return f"trim(regexp_replace({col}, '[\\x00-\\x20]+', ' ', 'g'))"


def words(col: str) -> str:
    return (rf"CAST(len(regexp_extract_all({col}, '[^\s{WIDE}]+')) "
            rf"+ (len(regexp_extract_all({col}, '[{WIDE}]')) + 1) // 2 AS INTEGER)")


def blocks(src: str, name: str, formatting: bool = False, tables: bool = True) -> str:
    """CTEs ending in ``name``: page_id, pos, tag, text, words, link_words."""
    linked = "array_to_string(regexp_extract_all(body, chr(3) || '([^' || chr(3) || chr(4) || ']*)', 1), ' ')"
    return rf"""{name}_m AS (
  SELECT page_id, string_split({marked('html', formatting, tables)}, chr(1)) AS l FROM {src}),
{name}_c AS (SELECT page_id, unnest(l) AS piece, generate_subscripts(l, 1) AS i FROM {name}_m),
{name}_t AS (
  SELECT page_id, i, CASE WHEN contains(piece, chr(2)) THEN lower(split_part(piece, chr(2), 1)) ELSE '' END AS tag,
         CASE WHEN contains(piece, chr(2)) THEN split_part(piece, chr(2), 2) ELSE piece END AS body
  FROM {name}_c),
{name}_x AS (SELECT *, {one_blank("translate(body, chr(3) || chr(4), '')", True)} AS text FROM {name}_t),
{name} AS (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, tag, text,
         {words('text')} AS words,
         CASE WHEN contains(body, chr(3)) THEN {words(linked)} ELSE 0 END AS link_words
  FROM {name}_x WHERE text <> '')"""


def text_of(src: str, name: str, formatting: bool = False, tables: bool = True) -> str:
    """CTEs ending in ``name``: page_id, text; pages without content have no row."""
    line = "WHEN tag = 'tr' THEN text || ' |'"
    if formatting:
        line += (" WHEN regexp_matches(tag, '^h[1-6]$') THEN repeat('#', CAST(substr(tag, 2) AS INTEGER)) || ' ' || text"
                 " WHEN tag = 'li' THEN '- ' || text")
    return blocks(src, name + "_b", formatting, tables) + rf""",
{name}_d AS (SELECT *, link_words / greatest(words, 1) AS dens FROM {name}_b),
{name}_n AS (
  SELECT *, coalesce(lag(dens) OVER w, 0) AS prev_dens, coalesce(lag(words) OVER w, 0) AS prev_words,
         coalesce(lead(words) OVER w, 0) AS next_words
  FROM {name}_d WINDOW w AS (PARTITION BY page_id ORDER BY pos)),
{name} AS (
  SELECT page_id, string_agg(CASE {line} ELSE text END, chr(10) ORDER BY pos) AS text
  FROM {name}_n
  WHERE dens <= 0.333333 AND (tag = 'tr' OR CASE WHEN prev_dens <= 0.555556
        THEN words > 16 OR next_words > 15 OR prev_words > 4 ELSE words > 40 OR next_words > 17 END)
  GROUP BY page_id)"""


# --- language model -----------------------------------------------------------------
def grams(src: str, id_col: str, text: str, name: str) -> str:
    return rf"""{name}_n AS (
  SELECT {id_col} AS id, string_split(' ' || trim(regexp_replace(lower({text}), '[^\p{{L}}]+|[\x{{10000}}-\x{{10ffff}}]+', ' ', 'g')) || ' ', '') AS cs
  FROM {src}),
{name} AS (
  SELECT id, unnest(list_transform(range(1, len(cs) - 1), lambda i: cs[i] || cs[i+1] || cs[i+2])) AS gram FROM {name}_n)"""


PROFILE = grams("documents", "doc_id", "text", "tg") + r""",
cnt AS (SELECT lang, gram, count(*) AS c FROM tg JOIN documents ON doc_id = id GROUP BY lang, gram),
space AS (SELECT lang, sum(c) + (SELECT count(DISTINCT gram) FROM cnt) AS space FROM cnt GROUP BY lang),
prof AS (
  SELECT lang, gram, CAST(round(ln((c + 1) / space) * 1000000) AS BIGINT)
           - CAST(round(ln(1.0 / space) * 1000000) AS BIGINT) AS weight,
         CAST(round(ln(1.0 / space) * 1000000) AS BIGINT) AS default_weight
  FROM cnt JOIN space USING (lang))"""


def scores(gram_cte: str, name: str) -> str:
    """CTEs ending in ``name``: id, rank, code, prob."""
    return rf"""{name}_tf AS (SELECT id, gram, count(*) AS tf FROM {gram_cte} GROUP BY id, gram),
{name}_n AS (SELECT id, sum(tf) AS n FROM {name}_tf GROUP BY id),
{name}_h AS (SELECT id, lang, sum(tf * weight) AS s FROM {name}_tf JOIN prof USING (gram) GROUP BY id, lang),
{name}_s AS (
  SELECT n.id, d.lang AS code, coalesce(h.s, 0) + n.n * d.default_weight AS score
  FROM {name}_n n CROSS JOIN (SELECT DISTINCT lang, default_weight FROM prof) d
  LEFT JOIN {name}_h h ON h.id = n.id AND h.lang = d.lang),
{name}_e AS (
  SELECT id, code, score, exp((score - max(score) OVER (PARTITION BY id)) / 1000000.0) AS e FROM {name}_s),
{name} AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, code) AS INTEGER) AS rank, code,
         round(e / sum(e) OVER (PARTITION BY id), 6) AS prob
  FROM {name}_e)"""


# --- pairing ---------------------------------------------------------------------------
def pairs(target: str) -> str:
    return rf"""run AS (
  SELECT *, max(CASE WHEN rec_type = 'response' AND content_type = 'text/html' THEN rec_seq END)
         OVER (PARTITION BY warc_path ORDER BY rec_seq ROWS UNBOUNDED PRECEDING) AS held
  FROM rec),
pair AS (
  SELECT warc_path, held, min(rec_seq) AS pos FROM run
  WHERE rec_type = 'metadata' AND dominant = '{target}' AND held IS NOT NULL GROUP BY warc_path, held)"""


def fields(json_any: bool) -> str:
    kind = (
        "CASE WHEN json_valid(value) THEN CASE json_type(value) WHEN 'OBJECT' THEN 'object' WHEN 'UBIGINT' "
        "THEN 'number' WHEN 'BIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' ELSE 'other' END ELSE 'text' END"
        if json_any else
        "CASE WHEN starts_with(value, '{') AND ends_with(value, '}') THEN 'object' ELSE 'text' END"
    )
    return f"""WITH {NOTES}, ln AS (
  SELECT page_id, unnest(string_split(note, chr(13) || chr(10))) AS line FROM nt),
kv AS (SELECT page_id, trim(split_part(line, ':', 1)) AS key, trim(substr(line, strpos(line, ':') + 1)) AS value
       FROM ln WHERE contains(line, ':'))
SELECT page_id, key, value, {kind} AS kind FROM kv"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def simhash() -> str:
    sums = ", ".join(f"sum((hi >> {i}) & 1) AS h{i}, sum((lo >> {i}) & 1) AS l{i}" for i in range(32))

    def half(prefix):
        value = " + ".join(f"CASE WHEN {prefix}{i} * 2 > n THEN {1 << i} ELSE 0 END" for i in range(32))
        return f"printf('%08x', CAST({value} AS BIGINT))"

    return rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[^\s]+')) AS w FROM documents),
hashed AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) AS hi,
             CAST('0x' || substr(md5(w), 9, 8) AS BIGINT) AS lo FROM w),
v AS (SELECT doc_id, count(*) AS n, {sums} FROM hashed GROUP BY doc_id)
SELECT doc_id, {half('h')} || {half('l')} AS fingerprint FROM v"""


def _final(mode: str) -> str:
    base = [RECORDS, pairs("en"),
            """cand AS (
  SELECT r.page_id, p.warc_path, n.page_id AS note_page, n.target_uri AS note_uri, n.record_id AS note_id,
         length(n.target_uri) AS fetch_ms, r.target_uri AS url, r.body AS html
  FROM pair p JOIN rec r ON r.warc_path = p.warc_path AND r.rec_seq = p.held
              JOIN rec n ON n.warc_path = p.warc_path AND n.rec_seq = p.pos)""",
            probes("cand"), PROFILE, grams("probe", "page_id", "probe", "pg"), scores("pg", "sc")]
    if mode == "raw":
        return with_(*base) + """
SELECT base64(encode(html)) AS raw_data, 'base64' AS encoding, note_id AS note_record, CAST(fetch_ms AS VARCHAR) AS fetch_time,
       warc_path
FROM cand JOIN sc ON sc.id = page_id AND rank = 1 AND code = 'en'"""
    return with_(*base, text_of("cand", "rt"), text_of("cand", "mt", formatting=True)) + rf"""
SELECT {META_TITLE} AS title, host AS hostname, c.url AS source, rt.text AS raw_text, mt.text AS text,
       length(mt.text) < 400 AS rejected, CASE WHEN length(mt.text) < 400 THEN 'Too_Short' ELSE '' END AS rejected_reason,
       sc.code AS language_code, sc.prob AS language_prob, note_id AS note_record,
       CAST(fetch_ms AS VARCHAR) AS fetch_time, c.warc_path, '2024-07-08' AS filedate, '' AS comments
FROM (SELECT *, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM cand) c
JOIN sc ON sc.id = c.page_id AND rank = 1 AND sc.code = 'en'
JOIN rt ON rt.page_id = c.page_id JOIN mt ON mt.page_id = c.page_id"""


def oracle_sql() -> dict[str, str]:
    scan = with_(RECORDS) + """
SELECT warc_path, rec_seq, rec_type, record_id, target_uri, content_type, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       md5(body) AS payload_md5 FROM rec"""
    predicted = with_(PROFILE, scores("tg", "sc"))
    page_scores = [META_PAGES, probes("mp"), PROFILE, grams("probe", "page_id", "probe", "pg"),
                   scores("pg", "sc")]
    final_text = _final("text")
    return {
        "html_lang": f"SELECT page_id, {found('html', '<html.*lang=\"(.*?)\"')} AS html_lang FROM pages",
        "declared_charset": "SELECT page_id, coalesce(" + ", ".join(
            f"nullif(regexp_extract(html, '{CHARSET}', {g}), '')" for g in (1, 2, 3, 4)) + ") AS charset FROM pages",
        "meta_description": with_(META_PAGES) + f"SELECT page_id, {META_DESCRIPTION} AS description FROM mp",
        "meta_title": with_(META_PAGES) + f"SELECT page_id, {META_TITLE} AS title FROM mp",
        "meta_heading": f"SELECT page_id, {META_HEADING} AS heading FROM pages",
        "lang_probe_text": with_(META_PAGES, probes("mp")) + "SELECT page_id, probe FROM probe",
        "page_metadata": with_(META_PAGES) + rf"""
SELECT page_id, {META_TITLE} AS title, {longest(every('html', meta_pattern('author|article:author|dc.creator')))} AS author,
       host AS hostname, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS image,
       {longest(every('html', meta_pattern('og:type')))} AS pagetype, url AS source,
       coalesce({longest(every('html', meta_pattern('og:site_name|application-name')))}, host) AS source_hostname,
       {META_DESCRIPTION} AS excerpt, '' AS categories,
       array_to_string({every('html', meta_pattern('keywords|news_keywords|article:tag'))}, ',') AS tags,
       CAST(NULL AS VARCHAR) AS license FROM mp""",
        "is_utf8": r"""SELECT page_id, form, form = 'utf8' OR NOT regexp_matches(html, '[\x{80}-\x{ff}]') AS is_utf8
FROM pages, (SELECT unnest(['utf8', 'latin1']) AS form)""",
        "guess_charset": r"""SELECT page_id, form, CASE WHEN form = 'utf8' OR NOT regexp_matches(html, '[\x{80}-\x{ff}]')
       THEN 'utf-8' ELSE 'cp1252' END AS charset FROM pages, (SELECT unnest(['utf8', 'latin1']) AS form)""",
        "decode_text": r"""SELECT page_id, form, CASE form WHEN 'utf8' THEN html
       ELSE regexp_replace(html, '[^\x{00}-\x{ff}]', '?', 'g') END AS text
FROM pages, (SELECT unnest(['utf8', 'latin1']) AS form)""",
        "html_blocks": with_(blocks("pages", "b")) + "SELECT page_id, pos, tag, text, words, link_words FROM b",
        "main_text": with_(text_of("pages", "t"))
        + "SELECT p.page_id, t.text FROM pages p LEFT JOIN t ON t.page_id = p.page_id",
        "main_text_markdown": with_(text_of("pages", "t", formatting=True))
        + "SELECT p.page_id, t.text FROM pages p LEFT JOIN t ON t.page_id = p.page_id",
        "main_text_tables": with_(TABLE_PAGES, text_of("tp", "a"), text_of("tp", "b", tables=False)) + """
SELECT p.page_id, a.text AS with_tables, b.text AS without_tables
FROM pages p LEFT JOIN a ON a.page_id = p.page_id LEFT JOIN b ON b.page_id = p.page_id""",
        "raw_and_formatted_text": with_(text_of("pages", "a"), text_of("pages", "b", formatting=True)) + """
SELECT p.page_id, a.text AS raw_text, b.text AS text
FROM pages p LEFT JOIN a ON a.page_id = p.page_id LEFT JOIN b ON b.page_id = p.page_id""",
        "filter_extracted": with_(text_of("pages", "t")) + "SELECT page_id, length(text) AS n_chars FROM t",
        "size_guard": "SELECT page_id FROM pages WHERE strlen(html) <= 4000",
        "size_guard_report": """SELECT strlen(html) <= 4000 AS kept, count(*) AS pages, CAST(sum(strlen(html)) AS BIGINT) AS bytes
FROM pages GROUP BY 1""",
        "drop_repeated_blocks": with_(blocks("pages", "b")) + """
SELECT page_id, pos, text FROM b
WHERE length(text) < 20 OR text NOT IN (SELECT text FROM b GROUP BY text HAVING count(*) > 2)""",
        "flag_too_short": """SELECT doc_id, length(text) < 400 AS rejected,
CASE WHEN length(text) < 400 THEN 'Too_Short' ELSE '' END AS rejected_reason FROM documents""",
        "raw_projection": "SELECT page_id, base64(encode(html)) AS raw_data, 'base64' AS encoding FROM pages",
        "content_fingerprint": simhash(),
        "train_profile": with_(PROFILE) + "SELECT lang, gram, weight, default_weight FROM prof",
        "predict_language": predicted + "SELECT id AS doc_id, code, prob FROM sc WHERE rank = 1",
        "top_k_languages": predicted + "SELECT id AS doc_id, rank, code, prob FROM sc WHERE rank <= 3",
        "filter_predicted_language": with_(*page_scores)
        + "SELECT id AS page_id, code, prob FROM sc WHERE rank = 1 AND code = 'en'",
        "body_language_gate": with_(text_of("pages", "t"), PROFILE, grams("t", "page_id", "text", "pg"),
                                    scores("pg", "sc"))
        + "SELECT id AS page_id FROM sc WHERE rank = 1 AND code = 'en'",
        "label_cleanup": "SELECT doc_id, lang AS code FROM documents",
        "parse_fields": fields(False),
        "parse_fields_any_json": fields(True),
        "dominant_language": with_(NOTES) + "SELECT page_id, dominant AS code FROM nt",
        "filter_annotated": with_(NOTES) + "SELECT page_id FROM nt WHERE dominant IS NOT NULL",
        "filter_dominant_language": with_(NOTES) + "SELECT page_id FROM nt WHERE dominant = 'fr'",
        "filter_html_response": with_(RECORDS) + """SELECT warc_path, rec_seq, 'exact' AS rule FROM rec
WHERE rec_type = 'response' AND content_type = 'text/html'
UNION ALL SELECT warc_path, rec_seq, 'prefix' FROM rec WHERE rec_type = 'response' AND starts_with(content_type, 'text/html')""",
        "filter_metadata": with_(RECORDS) + "SELECT warc_path, rec_seq FROM rec WHERE rec_type = 'metadata'",
        "http_header_lookup": with_(RECORDS) + """SELECT warc_path, rec_seq, content_type FROM rec
WHERE rec_type = 'response'""",
        "rec_headers_map": with_(RECORDS) + """SELECT warc_path, rec_seq, rec_type AS warc_type, record_id, target_uri
FROM rec""",
        "lineage": with_(RECORDS) + "SELECT warc_path, count(*) AS records FROM rec GROUP BY warc_path",
        "warc_scan": scan,
        "carry_pair": with_(RECORDS, pairs("en")) + "SELECT warc_path, held, pos FROM pair",
        "keyed_pair": with_(RECORDS) + """SELECT r.warc_path, r.rec_seq AS held, n.record_id AS note_record
FROM rec r JOIN rec n ON n.page_id = r.page_id AND n.rec_type = 'metadata' AND n.dominant = 'en'
WHERE r.rec_type = 'response' AND r.content_type = 'text/html'""",
        "carry_pair_content_first": with_(RECORDS) + r""", run AS (
  SELECT *, max(CASE WHEN rec_type = 'response' AND content_type = 'text/html' AND lang = 'en' THEN rec_seq END)
         OVER (PARTITION BY warc_path ORDER BY rec_seq ROWS UNBOUNDED PRECEDING) AS held
  FROM rec),
closing AS (
  SELECT *, row_number() OVER (PARTITION BY warc_path, held ORDER BY rec_seq) AS rn FROM run
  WHERE rec_type = 'metadata' AND held IS NOT NULL AND (dominant IS NULL OR dominant = 'en'))
SELECT warc_path, held, rec_seq AS pos FROM closing WHERE rn = 1 AND dominant = 'en'""",
        "carry_pair_events": r"""WITH run AS (
  SELECT *, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS view_id
  FROM events WHERE event_type IN ('view', 'purchase')),
closing AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, view_id ORDER BY ts, event_id) AS rn FROM run
  WHERE event_type = 'purchase' AND view_id IS NOT NULL)
SELECT user_id, view_id, event_id AS purchase_id FROM closing WHERE rn = 1""",
        "manifest_scan": with_(LEDGER) + "SELECT warc_path FROM mani",
        "archive_location": with_(LEDGER)
        + "SELECT warc_path, 's3a://archive/' || warc_path AS location FROM mani",
        "ledger_scan": with_(LEDGER) + "SELECT warc_path FROM led",
        "ledger_distinct": with_(LEDGER) + "SELECT DISTINCT warc_path FROM mani",
        "pending_archives": with_(LEDGER) + """SELECT warc_path FROM mani
WHERE warc_path NOT IN (SELECT warc_path FROM led WHERE status = 'ok')""",
        "ledger_after_run": with_(LEDGER) + """SELECT warc_path, status, CAST(0 AS BIGINT) AS batch_id FROM led
UNION ALL SELECT DISTINCT warc_path, 'ok', CAST(1 AS BIGINT) FROM mani
WHERE warc_path NOT IN (SELECT warc_path FROM led WHERE status = 'ok')""",
        "run_summary": with_(LEDGER) + "SELECT status, count(*) AS archives FROM led GROUP BY status",
        "drop_failed_archives": with_(RECORDS) + f""", led AS (
  SELECT DISTINCT warc_path FROM rec WHERE substr(md5(warc_path), 1, 1) >= '6' AND substr(md5(warc_path), 1, 1) < 'a')
SELECT warc_path, rec_seq FROM rec WHERE warc_path NOT IN (SELECT warc_path FROM led)""",
        "final_document": final_text,
        "final_document_content_first": with_(
            RECORDS, "cand AS (SELECT page_id, body AS html FROM rec WHERE rec_type = 'response' AND content_type = 'text/html')",
            probes("cand"), PROFILE, grams("probe", "page_id", "probe", "pg"), scores("pg", "sc"),
            text_of("cand", "mt", formatting=True)) + r""", ok AS (
  SELECT page_id, text FROM mt JOIN sc ON sc.id = page_id AND rank = 1 AND code = 'en'),
run AS (
  SELECT rec.*, max(CASE WHEN rec_type = 'response' AND ok.page_id IS NOT NULL THEN rec_seq END)
         OVER (PARTITION BY warc_path ORDER BY rec_seq ROWS UNBOUNDED PRECEDING) AS held
  FROM rec LEFT JOIN ok ON ok.page_id = rec.page_id AND rec_type = 'response'),
closing AS (
  SELECT *, row_number() OVER (PARTITION BY warc_path, held ORDER BY rec_seq) AS rn FROM run
  WHERE rec_type = 'metadata' AND held IS NOT NULL AND (dominant IS NULL OR dominant = 'en'))
SELECT c.warc_path, p.record_id AS page_record, p.rec_type AS header_type, ok.text AS text,
       CAST(length(c.target_uri) AS VARCHAR) AS fetch_time
FROM closing c JOIN rec p ON p.warc_path = c.warc_path AND p.rec_seq = c.held JOIN ok ON ok.page_id = p.page_id
WHERE rn = 1 AND c.dominant = 'en'""",
        "final_document_raw": _final("raw"),
        "jsonl_roundtrip": """SELECT page_id, url, html, CAST(NULL AS VARCHAR) AS license FROM pages""",
        "shard_roundtrip": """SELECT fmt, page_id, url, md5(html) AS html_md5
FROM pages, (SELECT unnest(['parquet', 'jsonl.gz']) AS fmt)""",
        "stream_ingest": _final("raw"),
        "stream_resume": _final("raw"),
        "stream_ingest_replay": _final("raw"),
        "manifest_job": _final("raw"),
        "manifest_job_retry": _final("raw"),
    }
