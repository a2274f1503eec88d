"""URL filtering with redirect equivalence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestfold.llm.common import ascii_lower, fits, let, lookup, spare, store, table
from nestfold.llm.components import connected_components
from nestfold.llm.registry import register

#: The rules (host, path, action).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one, or for null."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The address a page names as its own: https, host without ``www.`` or
    ``m.`` (if two labels stay), no fragment, no tracking parameters, no trailing slash."""
    rest = F.regexp_replace(after_scheme(url), r"#[\s\S]*$", "")
    host = F.regexp_replace(host_of(url), r"^(www|m)\.(?=[^.]+\.[^.])", "")
    tail = F.regexp_replace(rest, r"^[^/?]*", "")
    tail = F.regexp_replace(tail, r"([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    tail = F.regexp_replace(F.regexp_replace(tail, r"&&+", "&"), r"\?&", "?")
    tail = F.regexp_replace(F.regexp_replace(tail, r"[?&]+$", ""), r"/$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(F.lit("https://"), host, tail))


#: A link or meta tag; quoted values may hold anything.
TAG = r"""(?i)<(?:link|meta)\b(?:[^>"']|"[^"]*"|'[^']*')*>"""
#: An attribute and its value, with quotes if it has some.
ATTRIBUTE = r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
#: What stands before the address in a refresh.
DELAY = r"""(?i)^\s*[\d.]*\s*[;,]?\s*(?:url\s*=\s*)?["']?"""


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, in any order, case and quoting; null
    without it. Of equal names the first counts."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
    values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
    value = F.get(values, F.nullif(F.array_position(names, name), F.lit(0)).cast("int") - 1)
    return F.replace(F.regexp_replace(value, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&"))


def resolve(target: Column, base: Column) -> Column:
    """The address that ``target`` means on the page ``base``; null if it names
    no page (another kind of scheme, or nothing)."""
    t = F.trim(F.regexp_replace(target, r"[\t\r\n]", ""))
    scheme = F.substring_index(base, "://", 1)
    rest = after_scheme(base)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", "")
    own = F.regexp_replace(F.concat(F.when(t.startswith("/"), "").otherwise(folder), t), r"[?#][\s\S]*$", "")
    behind = F.regexp_extract(t, r"[?#][\s\S]*$", 0)
    # dot segments: a part is dropped, or takes the one before it along
    step = lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(x == ".", done).otherwise(F.concat(done, F.array(x)))
    ending = lambda parts: F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    joined = lambda parts: F.concat(F.array_join(F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step), "/"), ending(parts))
    own = let(own, lambda o: F.when(o.contains("./") | o.endswith("."), let(F.split(o, "/"), joined)).otherwise(o))
    known = F.instr(base, "://") > 0
    return (
        F.when(t.isNull() | (t == ""), None)
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(known & t.startswith("//"), F.concat(scheme, F.lit(":"), t))
        .when(known & t.startswith("#"), F.concat(root, path, query))
        .when(known & t.startswith("?"), F.concat(root, path, t))
        .when(known, F.concat(root, own, behind))
    )


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges ``u``, ``v`` between a page's url and each address it stands for:
    its canonical form, its canonical links, its refresh redirects. These
    targets are resolved against the page, and have edges to their own
    canonical forms."""
    src, tag = F.col(url), F.col("_tag")
    tags = pages.select(src.alias("u"), F.explode(F.regexp_extract_all(F.col(html), F.lit(TAG), F.lit(0))).alias("_tag"))
    linked = F.array_contains(F.split(F.lower(attribute(tag, "rel")), r"\s+"), "canonical")
    sent = F.lower(F.trim(attribute(tag, "http-equiv"))) == "refresh"
    to = F.regexp_extract(F.regexp_replace(attribute(tag, "content"), DELAY, ""), r"""^[^"']*""", 0)
    is_link = F.lower(F.substring(tag, 2, 4)) == "link"
    target = F.when(is_link & linked, attribute(tag, "href")).when(~is_link & sent & attribute(tag, "content").rlike(r"[;,]|(?i)url"), to)
    # stored between the steps, as projections that are merged repeat each other's expressions
    links = store(tags.select("u", target.alias("t")).where("t IS NOT NULL"), "urls-targets")
    links = store(links.select("u", resolve(F.col("t"), F.col("u")).alias("v")).where("v IS NOT NULL"), "urls-links")
    own = pages.select(src.alias("u"), canonical(src).alias("v")).unionByName(links.select(F.col("v").alias("u"), canonical(F.col("v")).alias("v")))
    return own.unionByName(links).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()


def matched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls(url)``, distinct, → ``url, host, path, rule, action`` of the
    longest rule that fits. ``rules(host, path, action)``: a rule fits its host
    and all subdomains if the url's path starts with the rule's; of equally
    long ones an allow wins, then the greater string."""
    split = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    wide = split.withColumn("suffix", F.explode(suffixes))
    named = rules.where("host IS NOT NULL AND action IS NOT NULL").select(
        F.col("host").alias("suffix"), F.coalesce("path", F.lit("")).alias("start"), "action"
    )
    hits = wide.join(F.broadcast(named) if fits(named) else named, "suffix").where(F.col("path").startswith(F.col("start")))
    rule = F.concat("suffix", "start")
    best = hits.groupBy("url").agg(F.max(F.struct(F.length(rule).alias("n"), (F.col("action") == "allow").alias("a"), rule.alias("rule"), F.col("action").alias("action"))).alias("b"))
    return split.join(best, "url", "left").select("url", "host", "path", F.col("b.rule").alias("rule"), F.col("b.action").alias("action"))


def filter_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added (columns
    of those names are replaced).

    A page that a rule fits gets that rule's verdict. ``edges(u, v)`` are
    redirects and canonical links between urls; addresses they connect are
    aliases. A page without a rule is blocked when a rule blocks one of its
    aliases and no rule allows any: an explicit allow goes before a block that
    was passed on. Otherwise it is allowed.

    Null urls and urls without ``://`` have empty host and path, fit no rule
    and have no aliases by canonical form. Repeated urls are judged once and
    joined back by ``lookup``, so one url may hold any share of the rows.
    """
    total, edges = pages.count(), store(edges, "urls-edges")
    known = pages.select(F.coalesce(F.col(url), F.lit("")).alias("url")).groupBy("url").agg(F.count("*").alias("held"))
    ends = edges.select(F.col("u").alias("url")).unionByName(edges.select(F.col("v").alias("url"))).select("url", F.lit(0).alias("held"))
    known = known.unionByName(ends).groupBy("url").agg(F.sum("held").alias("held"))
    known = store(known, "urls-known")
    judged = store(matched_rules(known.select("url"), rules), "urls-judged")

    member = connected_components(edges, "urls-components")
    aliased = judged.join(member.withColumnRenamed("node", "url"), "url", "left").withColumn("root", F.coalesce("root", "url"))
    groups = aliased.groupBy("root").agg(
        F.max(F.coalesce(F.col("action") == "allow", F.lit(False))).alias("any_allow"),
        F.max(F.coalesce(F.col("action") == "block", F.lit(False))).alias("any_block"),
    )
    passed_on = F.when(F.col("any_block") & ~F.col("any_allow"), "block").otherwise("allow")
    verdicts = aliased.join(groups, "root").select("url", "host", "path", "rule", F.coalesce("action", passed_on).alias("verdict"))
    verdicts = store(verdicts.join(known.where("held > 0"), "url"), "urls-verdicts")

    added = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in added]
    key, held = spare(pages, "_url"), spare(pages, "_held")
    rows = pages.select(*kept, F.coalesce(F.col(url), F.lit("")).alias(key))
    verdicts = verdicts.withColumnsRenamed({"url": key, "held": held})
    return lookup(rows, verdicts, key, held, total).select(*kept, *added)


@register(
    "op10_url_filter",
    r"""
    WITH RECURSIVE r(host, path, action) AS (VALUES
      ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    p AS (
      SELECT page_id, coalesce(url, '') AS url,
        CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    c AS (
      SELECT *, regexp_replace(lower(regexp_extract(rest, '^[^/?#]*')), '^(?:www|m)\.([^.]+\.[^.])', '\1') AS bare,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(rest, '#[\s\S]*$', ''), '^[^/?]*', ''),
          '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g'), '&&+', '&', 'g') AS tail FROM p),
    e AS (
      SELECT DISTINCT url AS u, 'https://' || bare || regexp_replace(regexp_replace(regexp_replace(tail, '\?&', '?', 'g'), '[?&]+$', ''), '/$', '') AS v
      FROM c WHERE contains(url, '://')),
    n AS (SELECT u AS url FROM e UNION SELECT v FROM e UNION SELECT url FROM p),
    reach(a, b) AS (
      SELECT url, url FROM n
      UNION SELECT reach.a, x.b FROM reach JOIN (SELECT u AS a, v AS b FROM e UNION SELECT v, u FROM e) x ON reach.b = x.a),
    h AS (
      SELECT url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM n),
    s AS (SELECT url, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM h),
    j AS (
      SELECT s.*, (SELECT max(struct_pack(l := length(r.host || r.path), rule := r.host || r.path, action := r.action)) FROM r
        WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)) AS m FROM s),
    g AS (SELECT reach.a AS url, bool_or(j.m.action = 'allow') AS any_allow, bool_or(j.m.action = 'block') AS any_block
      FROM reach JOIN j ON reach.b = j.url GROUP BY reach.a)
    SELECT page_id, host, path, j.m.rule AS rule,
      coalesce(j.m.action, CASE WHEN coalesce(any_block, false) AND NOT coalesce(any_allow, false) THEN 'block' ELSE 'allow' END) AS verdict
    FROM p JOIN j USING (url) JOIN g USING (url)
    """,
)
def op10_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES) + " AS t(host, path, action)")
    return filter_urls(pages.select("page_id", "url"), rules, page_edges(pages)).select("page_id", "host", "path", "rule", "verdict")
