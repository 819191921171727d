"""URL resolution, scope, document test and file naming as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Document suffix, and the URL schemes whose last path segment may carry
# `;parameters` (list of the Python standard library's URL parser).
DOCUMENT_SUFFIX = ".pdf"
PARAMETER_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "sip", "sips",
    "mms", "sftp", "tel",
)

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_ABSOLUTE = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"
_BRACKETED_HOST = r"^(?:[^@\[\]]*@)?\[(?:[0-9A-Fa-f:.%]+|[vV][0-9A-Fa-f]+\..+)\](?::[0-9]*)?$"


def root_url(base: Column, index: str) -> Column:
    """Base URL with exactly one trailing slash, followed by the index path."""
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/" + index))


def is_document(url: Column, suffix: str = DOCUMENT_SUFFIX) -> Column:
    """Whether the whole URL, query and fragment included, ends with the suffix."""
    return F.lower(url).endswith(suffix.lower())


def in_scope(url: Column, root: str, strict: bool = False) -> Column:
    """Whether the URL starts with the root; `strict` wants a boundary after it."""
    prefix = url.startswith(root)
    if not strict:
        return prefix
    following = F.substring(url, len(root) + 1, 1)
    return prefix & (following.isin("", "/", "?", "#") | F.lit(root.endswith("/")))


def scheme_of(url: Column) -> Column:
    """Lower-cased scheme, empty when there is none."""
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def host_of(url: Column) -> Column:
    """Authority part, lower-cased, empty when there is none."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """Path with `;parameters` of its last segment removed where the scheme has them."""
    path = F.regexp_extract(url, _ABSOLUTE + r"([^?#]*)", 1)
    return F.when(
        path.contains(";") & scheme_of(url).isin(*PARAMETER_SCHEMES),
        F.regexp_replace(path, r";[^/]*$", ""),
    ).otherwise(path)


def document_filename(url: Column) -> Column:
    """Last path segment; an empty one is replaced by a name made from the URL's MD5."""
    name = F.substring_index(path_of(url), "/", -1)
    fallback = F.concat(F.lit("document_"), F.left(F.md5(url), F.lit(8)), F.lit(".pdf"))
    return F.when(name == "", fallback).otherwise(name)


def url_category(url: Column, root: str) -> Column:
    """First path segment below the root; null when the URL is not below it."""
    prefix = root.rstrip("/") + "/"
    below = F.substring(F.regexp_extract(url, r"^[^?#]*", 0), len(prefix) + 1, 2**31 - 1)
    return F.when(
        url.startswith(prefix) & below.contains("/"), F.substring_index(below, "/", 1)
    )


def base_parts(base: Column) -> Column:
    """What resolution needs from a page's URL, as a struct computed once per page."""
    rest = F.regexp_replace(base, _ABSOLUTE, "")
    path = F.regexp_extract(rest, r"^[^?#]*", 0)
    authority = F.regexp_extract(base, _SCHEME + r"//([^/?#]*)", 2)
    return F.struct(
        scheme_of(base).alias("scheme"),
        F.when(authority != "", F.concat(scheme_of(base), F.lit("://"), authority)).alias("origin"),
        path.alias("path"),
        F.regexp_replace(_drop_empty_tail(F.regexp_extract(rest, r"\?[^#]*", 0)), r"#.*$", "")
        .alias("query"),
        F.when(path.contains("/"), F.regexp_extract(path, r"(?s)^.*/", 0))
        .otherwise(F.lit("/"))
        .alias("folder"),
        base.alias("url"),
    )


def _drop_empty_tail(tail: Column) -> Column:
    """A bare `?` or `#` carries nothing and is not written back."""
    return F.regexp_replace(F.regexp_replace(tail, r"^\?(?=#|$)", ""), r"^([^#]*)#$", "$1")


def _without_dots(path: Column, squeeze: Column) -> Column:
    """Removes `.` and `..` segments; `squeeze` also drops empty inner segments."""
    raw = F.split(path, "/")
    inner = F.filter(
        F.slice(raw, F.lit(2), F.greatest(F.size(raw) - 2, F.lit(0))), lambda s: s != ""
    )
    segments = F.when(
        squeeze, F.concat(F.slice(raw, 1, 1), inner, F.slice(raw, -1, 1))
    ).otherwise(raw)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    folder_end = F.element_at(segments, -1).isin(".", "..")
    joined = F.array_join(F.when(folder_end, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_links(
    df: DataFrame, base: str | Column, href: str = "href", target: str = "target_url"
) -> DataFrame:
    """Adds the absolute form of `href`, or null where the reference is malformed.

    `base` is the page's URL column, or the `base_parts` struct of it where that was computed
    before links were exploded. The work is laid out as a chain of projections, so that each
    intermediate string is computed once per row; segment folding runs only for paths that
    contain a dot segment or a doubled slash.
    """
    base = base_parts(F.col(base)) if isinstance(base, str) else base
    kept = df.columns
    c = F.col
    none = F.lit("")

    steps = df.withColumns({
        "_base": base,
        "_text": F.regexp_replace(F.regexp_replace(href, r"[\t\r\n]", ""), r"^[\x00-\x20]+", ""),
    })
    steps = steps.withColumn(
        "_scheme", F.when(c("_text").contains(":"), scheme_of(c("_text"))).otherwise(none)
    )
    steps = steps.withColumn(
        "_ref",
        F.when(c("_scheme") == "", c("_text")).otherwise(
            F.substr("_text", F.length("_scheme") + 2)
        ),
    )
    network = c("_ref").startswith("//")
    steps = steps.withColumn(
        "_host", F.when(network, F.regexp_extract("_ref", r"^//([^/?#]*)", 1)).otherwise(none)
    )
    steps = steps.withColumn(
        "_local",
        F.when(network, F.substr("_ref", F.length("_host") + 3)).otherwise(c("_ref")),
    )
    steps = steps.withColumn("_path", F.regexp_extract("_local", r"^[^?#]*", 0))
    steps = steps.withColumns({
        "_tail": _drop_empty_tail(F.substr("_local", F.length("_path") + 1)),
        "_params": F.when(
            c("_path").contains(";"), F.regexp_extract("_path", r";[^/]*$", 0)
        ).otherwise(none),
    })
    own = F.substr("_path", F.lit(1), F.length("_path") - F.length("_params"))
    rooted = c("_path").startswith("/")
    steps = steps.withColumn(
        "_merged", F.when(rooted, own).otherwise(F.concat(c("_base.folder"), own))
    )
    needs_fold = c("_merged").contains("/.") | (~rooted & c("_merged").contains("//"))
    path = F.when(needs_fold, _without_dots(c("_merged"), ~rooted)).otherwise(c("_merged"))

    malformed = (c("_host").contains("[") | c("_host").contains("]")) & ~c("_host").rlike(
        _BRACKETED_HOST
    )
    resolved = (
        F.when(malformed, F.lit(None).cast("string"))
        .when(c(href) == "", c("_base.url"))
        .when((c("_scheme") != "") & (c("_scheme") != c("_base.scheme")), c(href))
        .when(c("_base.origin").isNull(), F.when(c("_scheme") != "", c(href)))
        .when(
            c("_host") != "",
            F.concat("_base.scheme", F.lit("://"), "_host", "_path", "_tail"),
        )
        .when(
            c("_path") == "",
            F.concat(
                c("_base.origin"),
                c("_base.path"),
                F.when(c("_tail").startswith("?"), none).otherwise(c("_base.query")),
                c("_tail"),
            ),
        )
        .otherwise(F.concat(c("_base.origin"), path, c("_params"), c("_tail")))
    )
    return steps.select(*kept, resolved.alias(target))
