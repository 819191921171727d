"""Links, title and visible text of an HTML string as Column expressions."""

from __future__ import annotations

from functools import reduce
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts the page profile reports for a missing and for an empty title.
NO_TITLE = "No title found"
EMPTY_TITLE = "None"
SAMPLE_CHARS = 500

# Attributes are matched with possessive repeats, one step per quoted value, so long tags
# neither backtrack nor recurse.
_ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
# Every pattern starts with the literal `<`, which lets the scanner skip plain text quickly.
_HIDDEN = (
    r"!--.*?-->"
    r"|script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|style\b[^>]*>.*?(?:</style\s*>|\z)"
)
_TOKEN = r"(?is)<(?:" + _HIDDEN + r"|[a-z]" + _ATTRIBUTES + r">)"
_ATTRIBUTE = r"""[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]*))?"""
_MARKUP = (
    r"(?is)<(?:"
    + _HIDDEN
    + r"|template\b[^>]*>.*?</template\s*>|!\[CDATA\[.*?\]\]>|![a-z][^>]*>|\?[^>]*>|/[a-z][^>]*>"
    + r"|[a-z]"
    + _ATTRIBUTES
    + ">)"
)
_TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"

# Names with their semicolon; some mean two characters.
_BY_NAME = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
# Numeric references to the C1 range mean Windows-1252 characters.
_BY_C1_CODE = {
    str(code): bytes([code]).decode("cp1252")
    for code in range(0x80, 0xA0)
    if bytes([code]).decode("cp1252", errors="ignore")
}


def _literal_map(values: dict[str, str]) -> Column:
    """Constant map from two joined strings; U+001F occurs in neither."""
    keys, texts = ("\x1f".join(side) for side in (values.keys(), values.values()))
    return F.map_from_arrays(F.split(F.lit(keys), "\x1f"), F.split(F.lit(texts), "\x1f"))


def _character(code: Column) -> Column:
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return (
        F.when(
            code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF),
            F.lit("�"),
        )
        .when(code.between(0x80, 0x9F), F.coalesce(
            F.try_element_at(_literal_map(_BY_C1_CODE), code.cast("string")), F.decode(utf32, "UTF-32")))
        .otherwise(F.decode(utf32, "UTF-32"))
    )


def decode_entities(text: Column) -> Column:
    """Replaces `&name;`, `&#n;` and `&#xh;`; unknown names stay as written."""

    def one(piece: Column) -> Column:
        name = F.regexp_extract(
            piece, r"^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);", 1
        )
        digits = F.regexp_replace(name, r"^#[xX]?", "")
        code = F.when(
            F.lower(name).startswith("#x"), F.conv(digits, 16, 10).try_cast("bigint")
        ).otherwise(digits.try_cast("bigint"))
        character = (
            F.when(name == "", F.lit(None).cast("string"))
            .when(name == "amp", F.lit("&"))
            .when(name.startswith("#"), _character(code))
            .otherwise(F.try_element_at(_literal_map(_BY_NAME), name))
        )
        rest = F.substr(piece, F.length(name) + 2)
        return F.when(character.isNull(), F.concat(F.lit("&"), piece)).otherwise(
            F.concat(character, rest)
        )

    pieces = F.split(text, "&")
    decoded = F.concat(
        F.element_at(pieces, 1),
        F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one), ""),
    )
    return F.when(text.contains("&"), decoded).otherwise(text)


def hrefs(html: Column) -> Column:
    """Array of the `href` values of all anchors, in page order, entities decoded.

    One scan yields comments, scripts, styles and tags; anchors are picked from that list,
    so link-like text inside the others is not mistaken for a link.
    """
    tokens = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))
    anchors = F.filter(tokens, lambda t: t.rlike(r"(?i)^<a[\s/]"))

    def href_of(tag: Column) -> Column:
        attributes = F.regexp_extract_all(
            F.regexp_replace(tag, r"(?i)^<a", ""), F.lit(_ATTRIBUTE), F.lit(0)
        )
        return F.element_at(
            F.concat(
                F.array(F.lit(None).cast("string")),
                F.filter(attributes, lambda a: a.rlike(r"(?i)^href(?:\s*=|$)")),
            ),
            -1,
        )

    found = F.filter(F.transform(anchors, href_of), lambda a: a.isNotNull())
    return F.transform(found, lambda a: decode_entities(_attribute_value(a)))


def _attribute_value(attribute: Column) -> Column:
    value = F.regexp_replace(attribute, r"(?is)^href(?:\s*=\s*)?", "")
    return F.regexp_replace(value, r"""(?s)^(?:"([^"]*)"|'([^']*)')$""", "$1$2")


def with_title_and_text(df: DataFrame, html: str = "html") -> DataFrame:
    """Adds `title` (or its fixed stand-ins) and `text`, the page without markup.

    Comments, scripts and styles belong to neither. Raw and decoded forms are separate
    projections, so that each regular expression runs once per page.
    """
    kept = df.columns
    steps = df.withColumn("_shown", F.regexp_replace(html, "(?is)<(?:" + _HIDDEN + ")", ""))
    steps = steps.withColumns({
        "_title": F.regexp_extract("_shown", _TITLE, 1),
        "_titled": F.contains(F.lower("_shown"), F.lit("</title")),
        "_text": F.regexp_replace("_shown", _MARKUP, ""),
    })
    # An empty match means either an empty title or none; only then is the test repeated.
    title = (
        F.when(F.col("_title") != "", decode_entities(F.col("_title")))
        .when(F.col("_titled") & F.col("_shown").rlike(_TITLE), F.lit(EMPTY_TITLE))
        .otherwise(F.lit(NO_TITLE))
    )
    return steps.select(*kept, title.alias("title"), decode_entities(F.col("_text")).alias("text"))


def escape(text: Column) -> Column:
    """Text made safe for use inside an HTML element or attribute."""
    pairs = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)
