import random
import re

import pytest
from pyspark.sql import functions as F

from pagesieve.functions import annotation as A
from pagesieve.functions import htmlmeta as H
from pagesieve.functions import patterns as P
from pagesieve.functions.blocks import content_blocks, decode_entities, html_blocks, join_blocks, word_count
from pagesieve.functions.bytesview import byte_view, longest
from pagesieve.functions.charset import decode_text, guess_charset, is_utf8


def one(spark, value, column, kind="binary"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("x")).first()["x"]


def html(spark, fn, text):
    data = text if isinstance(text, bytes) else text.encode()
    return one(spark, data, fn(byte_view(F.col("v"))))


# --- page metadata ------------------------------------------------------------
def test_html_lang_takes_the_last_on_the_line(spark):
    assert html(spark, H.html_lang, '<html lang="ja"><p lang="en">') == "en"
    assert html(spark, H.html_lang, '<html lang="ja">\n<p lang="en">') == "ja"
    assert html(spark, H.html_lang, '<html lang="">') == ""
    assert html(spark, H.html_lang, "<html>") is None


@pytest.mark.parametrize("text,found", [
    ('<?xml version="1.0" encoding="euc-jp"?>', "euc-jp"),
    ("<META name=x charset='Shift_JIS'>", "Shift_JIS"),
    ("<meta charset=utf-8>", "utf-8"),
    ('<meta http-equiv="Content-Type" content="text/html; charset=iso-2022-jp">', "iso-2022-jp"),
    ("<meta name=x>", None),
])
def test_declared_charset(spark, text, found):
    assert html(spark, H.declared_charset, text) == found


def test_description_is_the_longest_by_bytes(spark):
    meta = '<meta name="{}" content="{}">'.format
    assert html(spark, H.meta_description, meta("description", "aaaaa") + meta("dc.description", "ééé")) == "ééé"
    assert html(spark, H.meta_description, meta("description", "first") + meta("dc.description", "equal")) == "first"
    assert html(spark, H.meta_description, meta("og:description", "no")) is None
    assert html(spark, H.meta_description, '<meta content="no" name="description">') is None
    assert html(spark, H.meta_description, '<meta name="description" content="It\'s">') == "It"
    assert html(spark, H.meta_description, '<META NAME="description" CONTENT="x">') is None
    assert html(spark, H.meta_description, '<meta name="description" content="a\nb">') is None
    assert html(spark, H.meta_description, '<meta name="dcXdescription" content="any byte for the dot">') \
        == "any byte for the dot"


def test_title_element_only_without_title_meta(spark):
    assert html(spark, H.meta_title, "<title>T</title>") == "T"
    assert html(spark, H.meta_title, '<meta name="title" content=""><title>T</title>') == ""
    assert html(spark, H.meta_title, '<meta property="twitter:title" content="M"><title>T</title>') == "M"
    assert html(spark, H.meta_title, "<TITLE>T</TITLE>") is None
    assert html(spark, H.meta_title, "<title>a\rb</title>") == "a\rb"
    assert html(spark, H.meta_title, "<title>a\nb</title>") is None


def test_heading(spark):
    assert html(spark, H.meta_heading, "<h1> a<b>b</b>\n</h1><H3 id=x>\tlonger one\x0b</H3>") == "longer one"
    assert html(spark, H.meta_heading, "<p>x</p>") is None


@pytest.mark.parametrize("d,t,h,chosen", [
    (10, 6, 11, "t"), (11, 6, 11, "d"), (0, 5, 11, "h"), (0, 5, 10, None), (10, 5, 10, None),
])
def test_probe_thresholds(spark, d, t, h, chosen):
    text = f'<meta name="description" content="{"d" * d}"><title>{"t" * t}</title><h1>{"h" * h}</h1>'
    got = html(spark, H.lang_probe_text, text)
    assert got == (chosen and chosen * {"d": d, "t": t, "h": h}[chosen])


def test_probe_counts_characters_and_replaces_line_feeds(spark):
    assert html(spark, H.lang_probe_text, f"<title>{'日' * 5}</title>") is None
    assert html(spark, H.lang_probe_text, f"<title>{'日' * 6}</title>") == "日" * 6
    assert html(spark, H.lang_probe_text, "<h1>first line\nsecond</h1>") == "first line second"


def test_byte_patterns_agree_with_another_engine(spark):
    """The same bytes through Python's own regular expressions."""
    rng = random.Random(7)
    bits = [b'<meta name="description" content="', b'<meta property="title" content="', b'">', b"'>", b"<title>",
            b"</title>", b"<h2 x>", b"</h2>", b"\r", b"\n", b"\xc2\x85", "日本".encode(), "日本".encode("cp932"),
            b"\x85", b"<b>", b" ", b"abc", b"<html lang=\"", b'"', b"<h1>", b"</H1>", b"\x0b"]
    docs = [b"".join(rng.choice(bits) for _ in range(rng.randrange(3, 30))) for _ in range(1500)]
    plain = {name: p.replace("(?d)", "").encode() for name, p in (
        ("lang", P.HTML_LANG), ("title", P.TITLE_TAG), ("desc", P.DESCRIPTION_META), ("head", P.HEADING))}
    view = byte_view(F.col("v"))
    got = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, v binary").select(
        "i", H.html_lang(view).alias("lang"),
        F.encode(F.regexp_extract(view, P.TITLE_TAG, 0), "ISO-8859-1").alias("title"),
        F.transform(F.regexp_extract_all(view, F.lit(P.DESCRIPTION_META), F.lit(2)),
                    lambda x: F.encode(x, "ISO-8859-1")).alias("desc"),
        F.transform(F.regexp_extract_all(view, F.lit(P.HEADING), F.lit(1)),
                    lambda x: F.encode(x, "ISO-8859-1")).alias("head"),
    ).orderBy("i").collect()
    for doc, row in zip(docs, got):
        m = re.search(plain["lang"], doc)
        assert row["lang"] == (m.group(1).decode("latin-1") if m else None)
        m = re.search(plain["title"], doc)
        assert bytes(row["title"]) == (m.group(0) if m else b"")
        assert [bytes(x) for x in row["desc"]] == [x[1] for x in re.findall(plain["desc"], doc)]
        assert [bytes(x) for x in row["head"]] == re.findall(plain["head"], doc)


def test_longest(spark):
    def of(items):
        return one(spark, items, longest(F.col("v")), "array<string>")
    assert of(["a", "bb", "cc"]) == "bb" and of([""]) == "" and of([]) is None


# --- charsets -------------------------------------------------------------------
@pytest.mark.parametrize("charset,name", [
    ("utf-8", "utf-8"), ("shift_jis", "cp932"), ("euc_jp", "euc_jp"), ("iso2022_jp", "iso2022_jp")])
def test_japanese_charsets(spark, charset, name):
    data = "日本語のページの題名です".encode(charset)
    assert one(spark, data, guess_charset(F.col("v"))) == name
    assert one(spark, data, decode_text(F.col("v"))) == "日本語のページの題名です"


def test_other_bytes(spark):
    for text in ("café au lait", "caféteria", "straße", "el niño", "déjà vu", "Ärger", "été"):
        assert one(spark, text.encode("cp1252"), decode_text(F.col("v"))) == text
    assert one(spark, b"a\xff\x81 b\xf8", guess_charset(F.col("v"))) is None
    assert one(spark, b"a\xff\x81 b\xf8", decode_text(F.col("v"))).startswith("a�")
    assert one(spark, b"", decode_text(F.col("v"))) == ""
    assert one(spark, b"\xe3\x81", is_utf8(F.col("v"))) is False
    assert one(spark, b"plain", is_utf8(F.col("v"))) is True


# --- annotations --------------------------------------------------------------------
def test_parse_fields(spark):
    note = ('a: 1\r\n b : x: y\r\nnone\r\nc: {"k": [1, 2]}\r\na: 2\r\nd: [3]\r\n　e　: z\r\nf:')
    braces = one(spark, note.encode(), F.to_json(A.parse_fields(F.col("v"))))
    anyjson = one(spark, note.encode(), F.to_json(A.parse_fields(F.col("v"), "any")))
    assert braces == '{"a":"2","b":"x: y","c":{"k":[1,2]},"d":"[3]","e":"z","f":""}'
    assert anyjson == '{"a":2,"b":"x: y","c":{"k":[1,2]},"d":[3],"e":"z","f":""}'
    with pytest.raises(ValueError):
        A.parse_fields(F.col("v"), "all")


def test_language_of_an_annotation(spark):
    def top(text):
        fields = A.raw_fields(F.col("v"))
        return one(spark, text.encode(), A.dominant_language(A.annotated_languages(fields)))

    def note(*pairs):
        listed = ",".join(f'{{"code":"{c}","text-covered":{t}}}' for c, t in pairs)
        return 'languages-cld2: {"reliable":true,"languages":[' + listed + "]}"

    assert top(note(("en", 0.2), ("ja", 0.5), ("fr", 0.5))) == "ja"
    assert top(note(("en", 1))) == "en"
    assert top(note()) is None and top("x: y") is None and top("languages-cld2: {broken}") is None


def test_malformed_fields(spark):
    def bad(text):
        return one(spark, text.encode(), A.malformed_fields(A.raw_fields(F.col("v"))))
    assert bad("a: {b}") and not bad('a: {"b": 1}\r\nc: [') and not bad("")


# --- blocks ---------------------------------------------------------------------------
def text_of(spark, page, formatting=False, tables=True):
    return one(spark, page, join_blocks(content_blocks(
        html_blocks(F.col("v"), formatting, tables)), formatting), "string")


def blocks_of(spark, page, **kw):
    return [(b["tag"], b["text"]) for b in one(spark, page, html_blocks(F.col("v"), **kw), "string")]


LONG = "This is a paragraph with more than sixteen words so that the rule takes it as content of the page."


def test_blocks_are_cut_at_block_tags(spark):
    page = "<body>lead<p>one <i>two</i>\n three</p>tail<ul><li>a<li>b</ul><div>x<br>y</div>"
    assert blocks_of(spark, page) == [
        ("body", "lead"), ("p", "one two three"), ("", "tail"), ("li", "a"), ("li", "b"), ("div", "x"), ("br", "y")]


def test_side_parts_and_raw_parts_go(spark):
    page = ("<head><title>t</title></head><script>if (a<b) '</p>'</script><STYLE>p{}</STYLE><!-- <p>no</p> -->"
            "<nav><p>menu</p></nav><p>kept</p><footer>foot</footer><script>open end <p>no")
    assert blocks_of(spark, page) == [("p", "kept")]


def test_entities(spark):
    def decoded(t):
        return one(spark, t, decode_entities(F.col("v")), "string")
    assert decoded("a &lt;b&gt; &amp;lt; &copy; &#39;&#x65E5;&#x1F600;&#0; &unknown;") == "a <b> &lt; © '日😀  &unknown;"


def test_tag_like_text_and_cut_tags(spark):
    assert blocks_of(spark, "<p>1 < 2 and 3 > 2</p><p>end<foot") == [("p", "1 < 2 and 3 > 2"), ("p", "end")]


def test_content_rule(spark):
    links = "".join(f'<li><a href="/{i}">menu entry number {i}</a></li>' for i in range(6))
    page = f"<ul>{links}</ul><h1>Head</h1><p>{LONG}</p><div>Short note.</div><p>" \
           f'<a href="/">{LONG}</a></p>'
    # behind links a short block needs more than 17 words after it: LONG has 19
    assert text_of(spark, page) == f"Head\n{LONG}\nShort note."
    page = f"<h2>Head</h2><p>{LONG}</p>"
    assert text_of(spark, page) == f"Head\n{LONG}"
    assert text_of(spark, page, formatting=True) == f"## Head\n{LONG}"
    assert text_of(spark, "<p></p>") is None


def test_formatting_and_tables(spark):
    page = (f"<p>{LONG} <b>strong</b> <strong>open</p><ul><li>{LONG}</li></ul>"
            "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>")
    assert text_of(spark, page, formatting=True) == f"{LONG} **strong** open\n- {LONG}\n| a | b |\n| 1 | 2 |"
    assert text_of(spark, page, tables=False) == f"{LONG} strong open\n{LONG}"


def test_words_of_scripts_without_blanks(spark):
    assert one(spark, "two words", word_count(F.col("v")), "string") == 2
    assert one(spark, "日本語の文章です abc", word_count(F.col("v")), "string") == 5
