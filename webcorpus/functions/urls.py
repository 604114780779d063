"""URL algebra as Column expressions.

Every function maps string columns to a string column inside the JVM. Parts that
are used several times are bound once (`functions.text.let`), which Spark
interprets row by row; the rest is generated code. The dot-segment fold in
`resolve` runs only for paths that have dot segments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions.text import let, strip

# The generic URI syntax (RFC 3986, appendix B), one group each.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AFTER_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"
_PARTS = {
    "scheme": _SCHEME,
    "netloc": _AFTER_SCHEME + r"//([^/?#]*)",
    "raw_path": _AFTER_SCHEME + r"(?://[^/?#]*)?([^?#]*)",
    "query": r"^[^?#]*\?([^#]*)",
    "fragment": r"(?s)^[^#]*#(.*)$",
    "target": r"(?s)" + _AFTER_SCHEME + r"(?://[^/?#]*)?(.*)$",
}
_LAST_SEGMENT_PARAMS = r";[^/]*$"
_DOT_SEGMENT = r"(^|/)\.{1,2}(/|$)"

# A script link that opens a document, target in group 2.
JS_OPEN = r"""(?i)javascript:window\.open\((["'])(.+?\.(pdf|docx|xlsx|doc|xls))\1"""
REFUSED_SUFFIXES = (".doc", ".xls")

# Control characters and space, cut from the left of a URL before parsing.
_LEADING = "".join(map(chr, range(1, 33)))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _clean(url: Column) -> Column:
    return F.translate(F.ltrim(url, F.lit(_LEADING)), "\t\r\n", "")


def _part(url: Column, part: str) -> Column:
    found = F.regexp_extract(url, _PARTS[part], 1)
    return F.lower(found) if part == "scheme" else found


def _path(url: Column) -> Column:
    return F.regexp_replace(_part(url, "raw_path"), _LAST_SEGMENT_PARAMS, "")


def url_part(url: Column | str, part: str) -> Column:
    """One of scheme, netloc, path, raw_path, query, fragment, target.

    `path` is without the last segment's `;params`, `raw_path` with them;
    `target` is everything after the authority.
    """
    cleaned = _clean(_col(url))
    return _path(cleaned) if part == "path" else _part(cleaned, part)


def _bare_host(netloc: Column) -> Column:
    return F.replace(F.lower(netloc), F.lit("www."), F.lit(""))


def host_key(url: Column | str) -> Column:
    """Lower-case authority with every `www.` removed."""
    return _bare_host(url_part(url, "netloc"))


def _assemble(scheme: Column, netloc: Column, path: Column) -> Column:
    """scheme:[//netloc]path, the slashes left out for a path that is no path."""
    rooted = (netloc != "") | (path == "") | path.startswith("/")
    prefix = F.when(scheme == "", F.lit("")).otherwise(F.concat(scheme, F.lit(":")))
    slashes = F.when(
        rooted & ((scheme != "") | (netloc != "")), F.lit("//")
    ).otherwise(F.lit(""))
    return F.concat(prefix, slashes, netloc, path)


def normalize_url(url: Column | str, keep_query: bool = False) -> Column:
    """https, lower-case host without `www.`, no trailing slash, query or fragment."""
    cleaned = _clean(_col(url))
    normal = _assemble(
        F.lit("https"),
        _bare_host(_part(cleaned, "netloc")),
        F.rtrim(_path(cleaned), F.lit("/")),
    )
    if not keep_query:
        return normal
    query = _part(cleaned, "query")
    return F.concat(
        normal, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))
    )


def sanitize(text: Column | str) -> Column:
    """Lower-case slug: runs of other characters become one underscore."""
    slug = F.regexp_replace(_col(text), "[^A-Za-z0-9]+", "_")
    return F.lower(F.btrim(slug, F.lit("_")))


def title(url: Column | str) -> Column:
    return sanitize(url_part(url, "path"))


def blob_stem(url: Column | str) -> Column:
    """First part of a record key: slug of the path and of the fragment."""
    cleaned = _clean(_col(url))
    path, fragment = _path(cleaned), _part(cleaned, "fragment")
    stem = sanitize(F.when(path == "", F.lit("root")).otherwise(path))
    return F.when(
        fragment != "", F.concat(stem, F.lit("_"), sanitize(fragment))
    ).otherwise(stem)


def blob_hash(url: Column | str) -> Column:
    """Last part of a record key: md5 of the canonical URL and its fragment."""
    cleaned = _clean(_col(url))
    base = _assemble(
        _part(cleaned, "scheme"),
        _bare_host(_part(cleaned, "netloc")),
        F.rtrim(_path(cleaned), F.lit("/")),
    )
    return F.md5(F.concat(base, F.lit("#"), _part(cleaned, "fragment")))


def blob_name(url: Column | str, chunk_index: Column | None = None) -> Column:
    """Record key of a document, or of one of its chunks."""
    parts = [blob_stem(url), blob_hash(url)]
    if chunk_index is not None:
        parts.insert(1, chunk_index.cast("string"))
    return F.concat(F.concat_ws("_", *parts), F.lit(".json"))


def directory_base(url: Column | str) -> Column:
    """Complete a directory-like URL with a slash, so that links resolve below it."""
    url = _col(url)
    path = url_part(url, "path")
    basename = F.regexp_extract(path, "([^/]*)$", 1)
    is_directory = ~basename.contains(".") & ~path.endswith("/")
    return F.when(
        is_directory, F.concat(F.rtrim(url, F.lit("/")), F.lit("/"))
    ).otherwise(url)


def _fold_dots(path: Column) -> Column:
    """Apply `.` and `..` segments from left to right."""
    segments = F.split(path, "/")
    nothing = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        nothing,
        lambda done, seg: F.when(
            seg == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    closed = F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.array_join(closed, "/")


def _merge(base_path: Column, path: Column) -> Column:
    """Path of a reference below the directory of the base path."""
    directory = F.regexp_extract(base_path, "(?s)^(.*/)", 1)
    merged = F.when(path.startswith("/"), path).otherwise(
        F.regexp_replace(F.concat(directory, path), "/{2,}", "/")
    )
    folded = let(
        merged, lambda m: F.when(m.rlike(_DOT_SEGMENT), _fold_dots(m)).otherwise(m)
    )
    return F.coalesce(F.nullif(folded, F.lit("")), F.lit("/"))


def _rooted(netloc: Column, path: Column) -> Column:
    bare = (netloc != "") & (path != "") & ~path.startswith("/")
    return F.when(bare, F.concat(F.lit("/"), path)).otherwise(path)


def base_parts(base: Column | str) -> Column:
    """The parts of a base URL, for `resolve_from` and `real_link_from`."""
    base = _clean(_col(base))
    return F.struct(
        base.alias("url"),
        *[_part(base, part).alias(part) for part in ("scheme", "netloc", "raw_path", "query")],
    )


def _join(base: Column, ref: Column) -> Column:
    """Resolve from the parts of base and reference."""
    stays, no_path = ref["netloc"] != "", ref["raw_path"] == ""
    netloc = F.when(stays, ref["netloc"]).otherwise(base["netloc"])
    path = (
        F.when(stays, ref["raw_path"])
        .when(no_path, base["raw_path"])
        .otherwise(_merge(base["raw_path"], ref["raw_path"]))
    )
    query = F.when(
        ~stays & no_path & (ref["query"] == ""), base["query"]
    ).otherwise(ref["query"])
    tail = F.concat(
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(
            ref["fragment"] != "", F.concat(F.lit("#"), ref["fragment"])
        ).otherwise(F.lit("")),
    )
    located = F.struct(netloc.alias("netloc"), path.alias("path"))
    return let(
        located,
        lambda o: F.concat(
            _assemble(base["scheme"], o["netloc"], _rooted(o["netloc"], o["path"])), tail
        ),
    )


def resolve_from(base: Column, href: Column) -> Column:
    """Resolve a reference against the parts of a base URL."""

    def resolved(ref: Column) -> Column:
        foreign = (ref["scheme"] != "") & (ref["scheme"] != base["scheme"])
        return (
            F.when(ref["url"] == "", base["url"])
            .when(foreign, ref["url"])
            .when(ref["url"].isNotNull(), _join(base, ref))
        )

    def parts(url: Column) -> Column:
        names = ("scheme", "netloc", "raw_path", "query", "fragment")
        return F.struct(url.alias("url"), *[_part(url, name).alias(name) for name in names])

    return let(_clean(href), lambda url: let(parts(url), resolved))


def resolve(base: Column | str, href: Column | str) -> Column:
    """Resolve a reference against a base URL (RFC 3986 join)."""
    return let(base_parts(base), lambda parts: resolve_from(parts, _col(href)))


def js_open_target(href: Column | str) -> Column:
    """Document opened by a script link; null for any other script link."""
    target = F.regexp_extract(_col(href), JS_OPEN, 2)
    refused = F.lit(False)
    for suffix in REFUSED_SUFFIXES:
        refused = refused | F.lower(target).endswith(suffix)
    return F.when((target != "") & ~refused, target)


def real_link_from(base: Column, href: Column) -> Column:
    """`real_link` against the parts of a base URL."""

    def linked(link: Column) -> Column:
        script = F.lower(link).startswith("javascript:")
        target = F.when(script, js_open_target(link)).otherwise(link)
        kept = script | link.startswith("#")
        return let(
            resolve_from(base, target),
            lambda url: F.when(kept, url).otherwise(normalize_url(url)),
        )

    return F.when(href != "", let(strip(href), linked))


def real_link(base: Column | str, href: Column | str) -> Column:
    """Absolute link of an anchor: script targets and fragments kept, rest normalised."""
    return let(base_parts(base), lambda parts: real_link_from(parts, _col(href)))


def real_links(base: Column | str, hrefs: Column | str) -> Column:
    """Distinct links of a page's hrefs; the base is taken apart once per page."""
    return let(
        base_parts(base),
        lambda parts: F.array_distinct(
            F.array_compact(F.transform(_col(hrefs), lambda h: real_link_from(parts, h)))
        ),
    )
