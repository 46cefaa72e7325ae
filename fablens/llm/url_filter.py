"""URL rules, carried to a page's aliases over redirects and canonical links.

The verdict of a rule that fits an address is final. An address without a rule takes
the verdict of its equivalence class: the connected component over redirect and canonical-link edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fablens.llm.components import connected_components
from fablens.sources.shared import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (verdict, host, path): fits the host and its subdomains where the path starts so.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Hosts that send visitors on to the bare host, and query parameters that do not change the page.
MIRRORS = ("www", "m")
# Registries' own second labels: before a country's two letters no site's name but where names begin, so nothing is stripped down to it.
REGISTRY_LABELS = ("ac", "co", "com", "edu", "gob", "gov", "ne", "net", "or", "org")
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "ref")
# Named character references that stand in addresses; the ampersand is decoded last.
REFERENCES = {"sol": "/", "quest": "?", "equals": "=", "colon": ":", "num": "#", "period": ".", "quot": '"', "apos": "'"}
# The address in a refresh tag's content: after the delay, with or without "url=", quoted or bare.
REFRESH = r"""(?i)^[\s\d.]*(?:[;,]\s*(?:url\s*=\s*)?|url\s*=\s*)["']?([^"'\s]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fitting(host: Column, path: Column, rules: list[tuple[str, str, str]], value) -> Column:
    """The value of the longest rule that fits, else null. Of equally long rules allow comes first."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        _, name, begin = rule
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(begin)
        out = F.when(fits, value(rule)).otherwise(out)
    return out


def landing_url(url: Column) -> Column:
    """Where an address redirects by convention: https, bare host, no fragment, tracking, suffix or last slash. Other schemes than http stay what they are."""
    scheme = F.translate(F.regexp_extract(url, r"^([^:/?#]*)://", 1), UPPER, LOWER)
    scheme = F.when(scheme.isin("", "http", "https"), "https").otherwise(scheme)
    bare = F.regexp_replace(url_host(url), r":(?:80|443)$", "")
    stripped = F.regexp_replace(bare, rf"^(?:(?:{'|'.join(MIRRORS)})\.)+([^.]+\.)", "$1")
    host = F.when(stripped.rlike(rf"^(?:{'|'.join(REGISTRY_LABELS)})\.[a-z][a-z]$"), bare).otherwise(stripped)
    # Slashes go first: a pattern that ends in any number of them takes quadratic time on a long run.
    path = F.regexp_replace(F.rtrim(url_path(url), F.lit("/")), r"(?:/index)?(?:\.html?)?$", "")
    asked = F.regexp_extract(url, r"\?([^#]*)", 1)
    kept = F.array_join(
        F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING))), "&"
    )
    return F.concat(scheme, F.lit("://"), host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _decoded(text: Column) -> Column:
    """Character references decoded, once."""

    def number(held: Column, reference: Column) -> Column:
        digits = F.regexp_extract(reference, "([0-9A-Fa-f]+);", 1)
        code = F.when(F.lower(reference).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = code.between(0x21, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(code == 38, F.replace(held, reference, F.lit("&amp;"))).when(known, F.replace(held, reference, character)).otherwise(held)

    numbers = F.regexp_extract_all(text, F.lit("(&#(?:[xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});)"), F.lit(1))
    out = F.aggregate(F.array_distinct(numbers), text, number)
    for name, mark in REFERENCES.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(mark))
    return F.regexp_replace(out, "(?i)&amp;", "&")


def _without_dots(path: Column) -> Column:
    """A path that starts with a slash, its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/", -1)
    parts = F.slice(parts, 2, F.size(parts) - 1)
    plain = lambda p: F.regexp_replace(p, "(?i)%2e", ".")
    up = lambda held: F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda held, p: F.when(plain(p) == "..", up(held)).when(plain(p) == ".", held).otherwise(F.concat(held, F.array(p))),
    )
    ended = F.when(plain(F.element_at(parts, -1)).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), ended)


def _target(url: Column, found: Column) -> Column:
    """A link's absolute address, resolved against the page's; null where it names no page with a host."""
    scheme = F.regexp_extract(url, r"^([^:/?#]*)://", 1)
    site = F.concat(scheme, F.lit("://"), url_host(url))
    here = url_path(url)
    here = F.when(here == "", F.lit("/")).otherwise(here)
    path = F.regexp_extract(found, r"^([^?#]*)", 1)
    rest = F.regexp_extract(found, r"^[^?#]*(.*)$", 1)
    asked = F.regexp_extract(url, r"^[^#?]*(\?[^#]*)", 1)
    folder = F.regexp_extract(here, r"^(.*/)", 1)
    return (
        F.when(found.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), found)
        .when(found.startswith("//"), F.concat(scheme, F.lit(":"), found))
        .when(found.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(found.startswith("/"), F.concat(site, _without_dots(path), rest))
        .when(found.startswith("?"), F.concat(site, here, found))
        .when(found.startswith("#"), F.concat(site, here, asked, found))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, path)), rest))
    )


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, quoted or bare, character references decoded; empty where there is none."""
    value = """"[^"]*+"|'[^']*+'|[^\\s"'>]++"""
    # Other attributes are passed over whole, so that a name inside a value does not count.
    other = rf"""(?>[^\s"'>/=]+(?:\s*=\s*(?:{value}))?|[\s/"'=]+)*?"""
    found = F.regexp_extract(tag, rf"(?i)^<[a-z]+[\s/]+{other}(?<![^\s/\"']){name}\s*=\s*({value})", 1)
    return _decoded(F.trim(F.regexp_replace(found, """^["']|["']$""", "")))


def _tags(html: Column, name: str) -> Column:
    """All tags of a name; a quoted value may hold ``>``."""
    return F.regexp_extract_all(html, F.lit(rf"""(?i)(<{name}[\s/](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>)"""), F.lit(1))


def _links(html: Column) -> list[Column]:
    """Targets of a page's first canonical link and first refresh tag, in whatever order their attributes stand; null or empty without."""
    canonical = F.filter(_tags(html, "link"), lambda t: _attribute(t, "rel").rlike(r"(?i)(?:^|\s)canonical(?:\s|$)") & (_attribute(t, "href") != ""))
    refresh = F.filter(_tags(html, "meta"), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    named = F.transform(refresh, lambda t: F.trim(F.regexp_extract(_attribute(t, "content"), REFRESH, 1)))
    return [_attribute(F.get(canonical, 0), "href"), F.get(F.filter(named, lambda u: u != ""), 0)]


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges between addresses of one page: its landing address, canonical link and refresh target."""
    url, html = F.col("url"), F.col("html")
    pages = pages.select(F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).filter(url.contains("://"))
    links = [F.when(html.rlike(f"(?i){word}"), link) for word, link in zip(("canonical", "refresh"), _links(html))]
    base = F.when(html.rlike(r"(?i)<base\s") & html.rlike("(?i)canonical|refresh"), _attribute(F.get(_tags(html, "base"), 0), "href"))
    found = pages.select(url, landing_url(url).alias("landing"), links[0].alias("canonical"), links[1].alias("refresh"), base.alias("base"))
    found = found.withColumn("base", F.coalesce(F.when(F.col("base") != "", _target(url, F.col("base"))), url))
    targets = [F.when(F.col(c) != "", _target(F.col("base"), F.col(c))).alias(c) for c in ("canonical", "refresh")]
    found = found.select("url", "landing", *targets)
    landing, named = F.col("landing"), [F.when(F.col(c).isNotNull(), landing_url(F.col(c))) for c in ("canonical", "refresh")]
    ends = F.array(F.struct(url.alias("a"), landing.alias("b")), *[F.struct(landing.alias("a"), n.alias("b")) for n in named])
    return found.select(F.inline(ends)).filter(F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules: list[tuple[str, str, str]] = RULES,
    edges: DataFrame | None = None,
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` of every row.

    ``edges`` adds known redirects (two address columns) to those read from the pages. Without a rule of its own an address
    is blocked if its component holds a blocked address and no explicitly allowed one, else
    allowed: an explicit allow comes before any block that is only carried over. A null url, or one
    without ``://``, has empty host and path, no aliases and the verdict allow. Repeated rows are judged
    alike; an empty table gives no rows; other columns are not read. Long addresses are read whole.
    """
    links = alias_edges(pages, url_col, html_col)
    if edges is not None:
        links = links.union(edges)
    members = connected_components(links)
    ruled = _fitting(url_host(F.col("node")), url_path(F.col("node")), rules, lambda r: F.lit(r[0]))
    members = members.select("node", "component", ruled.alias("ruled"))
    classes = members.groupBy("component").agg(
        F.max(F.col("ruled") == "block").alias("blocked"), F.max(F.col("ruled") == "allow").alias("allowed")
    )
    classes = materialize(
        classes.filter(F.col("blocked") & ~F.coalesce(F.col("allowed"), F.lit(False))).select("component"), "blocked-classes"
    )
    carried = members.filter(F.col("ruled").isNull()).join(classes, "component").select("node")
    carried = materialize(carried, "blocked-aliases")
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    seen = pages.select(F.col(id_col), F.col(url_col).alias("address"), host.alias("host"), path.alias("path"))
    judged = seen.join(carried, F.col("address") == F.col("node"), "left")
    fit = lambda value: _fitting(F.col("host"), F.col("path"), rules, value)
    other = F.when(F.col("node").isNotNull(), "block").otherwise("allow")
    return judged.select(
        id_col,
        "host",
        "path",
        fit(lambda r: F.lit(r[1] + r[2])).alias("rule"),
        F.coalesce(fit(lambda r: F.lit(r[0])), other).alias("verdict"),
    )
