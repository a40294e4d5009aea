"""Values that results depend on, stated plainly.

``(?d)`` makes ``.`` stop at a line feed only, which is how byte patterns
behave; Java would otherwise stop at carriage returns and U+0085 as well.
"""

# --- fixed values: names and patterns of the page-metadata lookups ----------
DESCRIPTION_NAMES = (
    "dc.description", "dc:description",
    "dcterms.abstract", "dcterms.description",
    "description", "sailthru.description", "twitter:description",
)
TITLE_NAMES = (
    "citation_title", "dc.title", "dcterms.title", "fb_title",
    "headline", "parsely-title", "sailthru.title", "shareaholic:title",
    "rbtitle", "title", "twitter:title",
)
HTML_LANG = r"""(?d)<html.*lang="(.*?)\""""
DECLARED_CHARSET = (
    r"""(?is)(?:<\?xml.*?encoding=["']([\w-]+)["']"""
    r"""|<meta[^>]+charset=["']([\w-]+)["']"""
    r"""|<meta[^>]+charset=([\w-]+)(?:\s|>)"""
    r"""|<meta\s+http-equiv=["'](?:Content-Type|content-type)["'][^>]+"""
    r"""content=["'].*?charset=([\w-]+)["'])"""
)
TITLE_TAG = r"(?d)<title>(.*?)</title>"
HEADING = r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"
ANY_TAG = r"<[^>]+>"

# thresholds, in characters
DESCRIPTION_OVER = 10
TITLE_OVER = 5
HEADING_OVER = 10
SHORT_TEXT_BELOW = 400

# constants in the output
REJECTED_SHORT = "Too_Short"
LABEL_PREFIX = "__label__"
HTML_CONTENT_TYPE = "text/html"
RAW_ENCODING = "base64"
LANGUAGE_KEY = "languages-cld2"


def meta_tag(names) -> str:
    """Pattern of a meta tag whose name/property precedes its content."""
    return (
        r"""(?d)<meta[^>]+(?:name|property)=["'](""" + "|".join(names)
        + r""")["'][^>]+content=["'](.*?)["']"""
    )


# --- end of fixed values ----------------------------------------------------

# bytes and characters removed by trimming
BYTE_SPACE = " \t\n\r\x0b\x0c"
TEXT_SPACE = (
    BYTE_SPACE + "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

DESCRIPTION_META = meta_tag(DESCRIPTION_NAMES)
TITLE_META = meta_tag(TITLE_NAMES)
