"""Queries of the expression library: cells, hosts, denylists, page signals and markers, with their SQL.

The driver's tables hold no messy cells, so each query makes them from the keys of a whole table, a
different kind for each remainder; the SQL takes them apart by its own functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import hosts, html, rules
from .functions import terms as t
from .functions import text as tx
from .plans import crawl


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _literal(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _pick(key: str, values: Sequence[str]) -> str:
    """An SQL expression, for Spark and DuckDB alike: one of the values by the remainder of key."""
    whens = " ".join(f"WHEN {k} THEN {_literal(v)}" for k, v in enumerate(values))
    return f"CASE {key} % {len(values)} {whens} END"


# ---------------------------------------------------------------- cells

_CELLS = ("", " a | b||c |", "x, y\tz", "Acme  Inc., Beta;gamma|ACME INC.", "one", " , ; ")
_NUMBERS = ("0.9", " 12.5 ", "1e2", "abc", "1.5d", "", "-.5", "7.", "+3", "1_0")
_SURE = ("", "High", " med ", "low", "0.7", "x", "MID", " 0.91")
_NAMES = ("Www.Shop-1.example.net/path", "  ", "A..b", "__x__", "Ünï.example", "plain")


def cell_functions(spark, sf):
    rows = _t(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.expr(_pick("p_partkey", _CELLS)).alias("cell"),
        F.expr(_pick("p_partkey", _NUMBERS)).alias("number"),
        F.expr(_pick("p_partkey", _SURE)).alias("a"),
        F.expr(_pick("(p_partkey div 8)", _SURE)).alias("b"),
        F.expr(_pick("p_partkey", _NAMES)).alias("name"),
        F.col("p_name"),
    )
    c = F.col
    joined = lambda x: F.array_join(x, "#")
    return rows.select(
        "id",
        joined(tx.split_pipe(c("cell"))).alias("piped"),
        joined(tx.split_tokens(c("cell"))).alias("tokens"),
        joined(tx.legal_keys(c("cell"))).alias("legal"),
        tx.parse_float(c("number")).alias("number"),
        tx.confidence(c("a"), c("b")).alias("sure"),
        tx.norm_key(c("cell")).alias("key"),
        tx.first_nonempty(c("a"), c("cell"), c("p_name")).alias("first"),
        tx.slug_domain(c("name")).alias("slug"),
        tx.operator_id(c("name")).alias("operator"),
        tx.text(F.nullif(c("cell"), F.lit(""))).alias("text"),
        tx.blank(c("name")).alias("blank"),
        tx.norm_blob(c("a"), c("name"), c("cell")).alias("blob"),
    )


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _trim(x: str) -> str:
    return f"trim({x}, {_WHITE})"


def _parts(x: str, pattern: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({x}, '{pattern}'), lambda p: {_trim('p')}), lambda p: p <> '')"


def _number(x: str) -> str:
    return f"CASE WHEN regexp_full_match({_trim(x)}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN {_trim(x)}::DOUBLE END"


def _said(x: str) -> str:
    low = f"lower({_trim(x)})"
    return f"CASE WHEN {low} IN ('high', 'hi') THEN 0.92 WHEN {low} IN ('medium', 'med', 'mid') THEN 0.8 WHEN {low} = 'low' THEN -1 ELSE {_number(x)} END"


SQL_CELLS = f"""
WITH r AS (
  SELECT p_partkey AS id, {_pick("p_partkey", _CELLS)} AS cell, {_pick("p_partkey", _NUMBERS)} AS number, {_pick("p_partkey", _SURE)} AS a, {_pick("(p_partkey // 8)", _SURE)} AS b, {_pick("p_partkey", _NAMES)} AS name, p_name FROM part
),
s AS (
  SELECT *, coalesce({_said("a")}, {_said("b")}) AS said,
    trim(regexp_replace(regexp_replace(replace(string_split(lower({_trim("name")}), '/')[1], '.', '_'), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug FROM r
)
SELECT id, array_to_string({_parts("cell", "[|]")}, '#') AS piped, array_to_string({_parts("cell", "[|,\\s]+")}, '#') AS tokens,
  array_to_string(list_transform(list_sort(list_transform(list_distinct(ks), lambda k: {{'i': list_position(ks, k), 'k': k}})), lambda x: x.k), '#') AS legal,
  coalesce({_number("number")}, 0) AS number, CASE WHEN said >= 0 THEN said END AS sure, {_trim("regexp_replace(lower(cell), '\\s+', ' ', 'g')")} AS key,
  CASE WHEN {_trim("a")} <> '' THEN {_trim("a")} WHEN {_trim("cell")} <> '' THEN {_trim("cell")} ELSE {_trim("p_name")} END AS first, CASE WHEN slug = '' THEN 'unknown' ELSE slug END AS slug,
  'operator_' || CASE WHEN slug = '' THEN 'unknown' ELSE slug END AS operator, {_trim("cell")} AS text, {_trim("name")} = '' AS blank,
  {_trim("lower(concat_ws(' ', CASE WHEN " + _trim("a") + " <> '' THEN a END, CASE WHEN " + _trim("name") + " <> '' THEN name END, CASE WHEN " + _trim("cell") + " <> '' THEN cell END))")} AS blob
FROM (SELECT *, list_filter(list_transform(regexp_split_to_array(cell, '[|;,]+'), lambda p: {_trim("regexp_replace(lower(p), '\\s+', ' ', 'g')")}), lambda k: k <> '') AS ks FROM s)
"""

# ---------------------------------------------------------------- hosts

_FORMS = (
    "HTTPS://User:pw@WWW.{h}:8080/x",
    "http://{h}./a?b",
    "ftp://www.{h}/y",
    "http://[2001:db8::1]:80/z",
    "{h}/path",
    "https://www.{h}..",
    " Www.{h}.",
    "",
    "http://",
    "https://a@www.{h}#f",
    "www.{h}|b.{h}/x| C.{h}. |",
    "/pay/*, https://www.{h}:81/p cash.{h}/q http:///none",
)


def _forms(key: str, host: str) -> str:
    whens = " ".join(f"WHEN {k} THEN replace({_literal(v)}, '{{h}}', {host})" for k, v in enumerate(_FORMS))
    return f"CASE {key} % {len(_FORMS)} {whens} END"


def host_forms(spark, sf):
    """Every normaliser on addresses with user info, ports, trailing dots, IPv6 and without a scheme."""
    rows = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.expr(_forms("c_custkey", "lower(c_mktsegment) || '.example.net'")).alias("v"),
    )
    v = F.col("v")
    domains, patterns = hosts.pattern_cell(v)
    made = {
        f.__name__: f(v)
        for f in (
            hosts.seed_domain, hosts.plain_domain, hosts.monitor_host, hosts.crawl_host, hosts.signal_host,
            hosts.cluster_host, hosts.rule_domain,
        )
    }
    lists = {"seed_hosts": hosts.seed_hosts(v), "domains": domains, "patterns": patterns}
    return rows.select(
        "id",
        *(c.alias(k) for k, c in made.items()),
        *(F.array_join(c, " ").alias(k) for k, c in lists.items()),
        hosts.domain_shaped(hosts.plain_domain(v)).alias("shaped"),
    )


_NET = "regexp_extract({v}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?', 1)"
_SCHEME = "lower(regexp_extract({v}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"


def _clean(x: str) -> str:
    """Lower case, no blanks around, no trailing dots, no www."""
    return f"regexp_replace(rtrim({_trim(f'lower({x})')}, '.'), '^www[.]', '')"


def _seed(x: str) -> str:
    return f"CASE WHEN contains({_clean(x)}, '/') AND NOT contains({_clean(x)}, '://') THEN {_trim(f'split_part({_clean(x)}, chr(47), 1)')} ELSE {_clean(x)} END"


def _rule(x: str) -> str:
    return f"regexp_replace(split_part(rtrim({_trim(f'lower({x})')}, '.'), '/', 1), '^www[.]', '')"


SQL_FORMS = f"""
WITH r AS (SELECT c_custkey AS id, {_forms("c_custkey", "lower(c_mktsegment) || '.example.net'")} AS v FROM customer),
n AS (SELECT *, {_NET.format(v="v")} AS net, {_SCHEME.format(v="v")} AS scheme FROM r),
h AS (SELECT *, regexp_replace(net, '^.*@', '') AS bare FROM n),
p AS (SELECT *, split_part(bare, ':', 1) AS host, scheme IN ('http', 'https') AS web FROM h)
SELECT id, {_seed("v")} AS seed_domain, {_clean("v")} AS plain_domain,
  CASE WHEN web AND net <> '' THEN {_clean("CASE WHEN starts_with(bare, '[') THEN bare ELSE host END")} END AS monitor_host,
  CASE WHEN web AND {_clean("host")} <> '' THEN {_clean("host")} END AS crawl_host, CASE WHEN {_clean("host")} <> '' THEN {_clean("host")} END AS signal_host,
  split_part(regexp_replace(lower(net), '^www[.]', ''), ':', 1) AS cluster_host, {_rule("v")} AS rule_domain,
  array_to_string(list_filter(list_transform({_parts("v", "[|]")}, lambda s: {_rule("split_part(s, '/', 1)")}), lambda x: x <> ''), ' ') AS seed_hosts,
  array_to_string(list_transform(list_filter({_parts("v", "[|,\\s]+")}, lambda s: NOT starts_with(s, '/') AND (NOT contains(s, '://') OR regexp_replace({_NET.format(v="s")}, '^.*@', '') <> '')),
    lambda s: CASE WHEN contains(s, '://') THEN {_seed("split_part(regexp_replace(" + _NET.format(v="s") + ", '^.*@', ''), ':', 1)")} ELSE {_seed("s")} END), ' ') AS domains,
  array_to_string(list_filter({_parts("v", "[|,\\s]+")}, lambda s: starts_with(s, '/')), ' ') AS patterns,
  regexp_full_match({_clean("v")}, '([a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?[.])+[a-z]{{2,}}') AS shaped
FROM p
"""

_SERVERS = (
    "ns1.cloudflare.com",
    "Cloudflare.com.",
    "notcloudflare.com",
    "ns-1.awsdns-12.org",
    "xawsdns-1.org",
    "",
    "dns.example.net",
    "a.Google.com",
    "ns.registrar-servers.com.example",
    "domaincontrol.com",
)
_MAIL = (
    "aspmx.google.com",
    "mx.example.net",
    ".",
    "",
    "x.mail.protection.outlook.com.",
    "outlook.com.example",
    " googlemail.com ",
    "myoutlook.com",
)


def infrastructure_filters(spark, sf):
    rows = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.expr(_pick("s_suppkey", _SERVERS)).alias("a"),
        F.expr(_pick("(s_suppkey * 3 + 1)", _SERVERS)).alias("b"),
        F.expr(_pick("s_suppkey", _MAIL)).alias("m"),
    )
    c = F.col
    mx = F.array(
        F.struct(c("m").alias("host"), F.lit(10).alias("priority")),
        F.struct(F.lit("mail.example.org").alias("host"), F.lit(20).alias("priority")),
    )
    return rows.select(
        "id",
        hosts.noise_nameserver(c("a")).alias("noise"),
        hosts.noise_mx(c("m")).alias("mail_noise"),
        hosts.suffix_matches(F.lower("a"), ("cloudflare.com",)).alias("suffix"),
        F.array_join(hosts.signal_nameservers(F.array("a", "b")), " ").alias("servers"),
        F.array_join(hosts.signal_mx_hosts(mx), "|").alias("mail"),
    )


def _noise(x: str, suffixes: Sequence[str], label: str = "") -> str:
    h = f"rtrim({_trim(f'lower({x})')}, '.')"
    ends = " OR ".join(f"{h} = '{s}' OR {h} LIKE '%.{s}'" for s in suffixes)
    return f"({ends}{f' OR regexp_matches({h}, {_literal(label)})' if label else ''})"


_NS_NOISE = (
    "cloudflare.com", "googledomains.com", "google.com", "azure-dns.com", "dnsimple.com", "registrar-servers.com",
    "domaincontrol.com", "name-services.com",
)
_MX_NOISE = ("google.com", "googlemail.com", "outlook.com", "mail.protection.outlook.com")
SQL_INFRASTRUCTURE = f"""
WITH r AS (SELECT s_suppkey AS id, {_pick("s_suppkey", _SERVERS)} AS a, {_pick("(s_suppkey * 3 + 1)", _SERVERS)} AS b, {_pick("s_suppkey", _MAIL)} AS m FROM supplier)
SELECT id, {_noise("a", _NS_NOISE, "(^|[.])awsdns-")} AS noise, {_noise("m", _MX_NOISE)} AS mail_noise, lower(a) = 'cloudflare.com' OR lower(a) LIKE '%.cloudflare.com' AS suffix,
  concat_ws(' ', CASE WHEN a <> '' AND NOT {_noise("a", _NS_NOISE, "(^|[.])awsdns-")} THEN a END, CASE WHEN b <> '' AND NOT {_noise("b", _NS_NOISE, "(^|[.])awsdns-")} THEN b END) AS servers,
  concat_ws('|', CASE WHEN {_trim("m")} NOT IN ('', '.') AND NOT {_noise("m", _MX_NOISE)} THEN {_trim("m")} END, 'mail.example.org') AS mail
FROM r
"""

# ---------------------------------------------------------------- pages

#: What stands at the end of a page, by the remainder of its number.
_TAILS = (
    '<script src="https://widget.intercom.io/w/1.js"></script><iframe src="//www.tube.example/embed"></iframe>',
    '<script src="https://www.googletagmanager.com/gtm.js?x=1&amp;id=GTM-AB12"></script><script>gtag("config", "G-XY99Z"); a("UA-12-3")</script>',
    '<link rel="stylesheet" href="https://cdn.example.org/a.css"><img src="/local.png"><link rel="icon" href="https://no.example/i">',
    '<footer>  Run by   Example Holdings Ltd  </footer><a href="mailto:a@b.example">m</a><a href="#top">t</a>',
    '<a href="/Terms-of-use">t</a><a href="https://acme.zendesk.com/hc">h</a><script src="https://js.driftt.com/x"></script>',
    "<a href='/cashier/in'>c</a><a href='/Redeem'>r</a><a href=' JavaScript:x()'>j</a>",
)


def _tailed(spark, sf):
    pages = _t(spark, sf, "pages").withColumn("html", F.concat("html", F.expr(_pick("page_id", _TAILS))))
    return html.parsed(pages.select("page_id", "url", "html"))


def page_signals(spark, sf):
    """Scripts, iframes, assets, tags, widgets and flow paths of pages that end with some."""
    s = html.signals(F.col("page"), F.col("html"), ("the", "Über GmbH"))
    rows = _tailed(spark, sf).withColumn("s", s)
    joined = lambda x: F.array_join(x, " ")
    tech = {
        x: joined(F.col(f"s.technical.{x}"))
        for x in ("analytics_ids", "tag_manager_ids", "script_domains", "iframe_domains", "support_widget_providers")
    }
    found = F.filter("s.technical.asset_domains", lambda x: x == "cdn.example.org")
    return rows.select(
        "page_id",
        *(c.alias(k) for k, c in tech.items()),
        joined(found).alias("assets"),
        joined("s.flow.cashier_paths").alias("cashier"),
        joined("s.flow.redemption_paths").alias("redeem"),
        F.array_contains("s.content.footer_phrases", "Run by Example Holdings Ltd").alias("footer"),
    )


SQL_SIGNALS = """
SELECT page_id, CASE page_id % 6 WHEN 1 THEN 'g-xy99z ua-12-3' ELSE '' END AS analytics_ids, CASE page_id % 6 WHEN 1 THEN 'GTM-AB12' ELSE '' END AS tag_manager_ids,
  CASE page_id % 6 WHEN 0 THEN 'widget.intercom.io' WHEN 1 THEN 'googletagmanager.com' WHEN 4 THEN 'js.driftt.com' ELSE '' END AS script_domains, CASE page_id % 6 WHEN 0 THEN 'tube.example' ELSE '' END AS iframe_domains,
  CASE page_id % 6 WHEN 0 THEN 'intercom' WHEN 4 THEN 'drift' ELSE '' END AS support_widget_providers, CASE page_id % 6 WHEN 2 THEN 'cdn.example.org' ELSE '' END AS assets,
  CASE page_id % 6 WHEN 5 THEN '/cashier/in' ELSE '' END AS cashier, CASE page_id % 6 WHEN 5 THEN '/redeem' ELSE '' END AS redeem, page_id % 6 = 3 AS footer
FROM pages
"""


def crawler_links(spark, sf):
    """The crawler's links (mail addresses stay), and those to legal and support pages."""
    rows = _tailed(spark, sf).withColumn("l", html.links(F.col("page"), F.col("url"), limit=600, mail=True))
    return rows.select(
        "page_id",
        F.size("l").alias("n"),
        F.size(html.legal_urls(F.col("l"))).alias("n_legal"),
        F.array_join(html.support_urls(F.col("l")), " ").alias("support"),
        F.array_max("l").alias("greatest"),
    )


SQL_CRAWLER = f"""
WITH hrefs AS (
  SELECT page_id, regexp_extract(url, '^https?://[^/?#]*', 0) AS root, unnest(regexp_extract_all(html || {_pick("page_id", _TAILS)}, '<a [^>]*href=["'']([^"'']*)["'']', 1)) AS href FROM pages
),
l AS (
  SELECT page_id, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href ELSE root || href END AS link FROM (SELECT page_id, root, trim(href) AS href FROM hrefs)
  WHERE href <> '' AND NOT starts_with(href, '#') AND NOT contains(lower(href), 'javascript:')
),
g AS (
  SELECT page_id, count(*) AS n, count(DISTINCT lower(link)) FILTER (WHERE regexp_matches(link, '(?i)(terms|privacy|sweep|rules|policy|legal|responsible|eula|conditions)')) AS n_legal,
    coalesce(string_agg(DISTINCT link, ' ') FILTER (WHERE regexp_matches(regexp_extract(link, '//([^/?#]*)', 1), 'helpshift|zendesk|intercom|freshdesk')), '') AS support, max(link) AS greatest FROM l GROUP BY page_id
)
SELECT p.page_id, coalesce(n, 0)::INTEGER AS n, coalesce(n_legal, 0)::INTEGER AS n_legal, coalesce(support, '') AS support, greatest FROM pages p LEFT JOIN g ON g.page_id = p.page_id
"""

_PLACES = (
    "{k} Main Street, Salem, OR 97301",
    "no place",
    "{k} Elm Rd. Boston MA 02101-1234",
    "{k} Straße, Kiel, DE 24103x",
    "at {k} Oak Ave, Reno, NV 89501 and {k} Oak Ave, Reno, NV 89501 or 9 Pine, Troy, NY 12180.",
)


def address_hints(spark, sf):
    text = F.replace(F.expr(_pick("o_orderkey", _PLACES)), F.lit("{k}"), F.col("o_custkey").cast("string"))
    return _t(spark, sf, "orders").select("o_orderkey", F.array_join(html.address_hints(text), "|").alias("found"))


SQL_ADDRESSES = f"""
SELECT o_orderkey, array_to_string(list_sort(list_distinct(regexp_extract_all(replace({_pick("o_orderkey", _PLACES)}, '{{k}}', o_custkey::VARCHAR), '\\b\\d{{1,6}}\\s+[\\w\\sß]+,?\\s+[A-Za-z\\s]+,?\\s+[A-Z]{{2}}\\s+\\d{{5}}(-\\d{{4}})?\\b'))), '|') AS found FROM orders
"""

# ---------------------------------------------------------------- markers and terms as shipped

_DOMAINS = (
    "example.com", "a.example.org", "Localhost.", "shop.example.net", "", "my-placeholder.net", "tbd.io",
    "pending.example", " test ", "testing.io", "good.io",
)
_NOTES = (
    *t.INFERRED_MARKERS, *t.SECONDARY_MARKERS, *t.FIRST_PARTY_MARKERS, "confirmed by the site", "Confirmed",
    "unconfirmed terms", "nothing", "Redirects to", "formerly X", "Now At y",
)


def shipped_markers(spark, sf):
    """Evidence tiers and note rules with the shipped marker lists."""
    note = F.concat(F.lit("Seen "), F.expr(_pick("c_custkey", _NOTES)), F.lit(" x"))
    rows = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        note.alias("n"),
        F.expr(_pick("(c_custkey div 7)", ("", "news article", "direct fetch", "nothing"))).alias("s"),
        F.expr(_pick("c_custkey", _DOMAINS)).alias("d"),
        ((F.col("c_custkey") % 11) / 10).alias("sure"),
    )
    c = F.col
    tier = rules.evidence_tier(c("n"), c("s"))
    return rows.select(
        "id",
        tier.alias("tier"),
        rules.row_tier(c("n"), c("s"), c("sure")).alias("row_tier"),
        rules.tier_cap(tier).alias("cap"),
        rules.downgraded(rules.tier_level(tier)).alias("downgraded"),
        rules.weak_notes(c("n"), c("s")).alias("weak"),
        rules.redirect_shell(c("n"), c("s")).alias("redirect"),
        rules.placeholder_domain(c("d")).alias("placeholder"),
    )


def _any(x: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {_literal(w)})" for w in words) + ")"


SQL_MARKERS = f"""
WITH r AS (
  SELECT c_custkey AS id, 'Seen ' || {_pick("c_custkey", _NOTES)} || ' x' AS n, {_pick("(c_custkey // 7)", ("", "news article", "direct fetch", "nothing"))} AS s, rtrim(trim(lower({_pick("c_custkey", _DOMAINS)})), '.') AS d, (c_custkey % 11) / 10 AS sure FROM customer
),
b AS (SELECT *, lower(n || ' ' || s) AS blob FROM r),
q AS (
  SELECT *, CASE WHEN {_any("blob", t.INFERRED_MARKERS)} THEN 3 WHEN {_any("blob", t.SECONDARY_MARKERS)} THEN 2 WHEN (contains(blob, 'confirmed') AND {_any("blob", ("official", "terms", "site"))}) OR {_any("blob", t.FIRST_PARTY_MARKERS)} THEN 1 ELSE 3 END AS k FROM b
)
SELECT id, (['{t.FIRST}', '{t.SECONDARY}', '{t.INFERRED}'])[k] AS tier, (['{t.FIRST}', '{t.SECONDARY}', '{t.INFERRED}'])[CASE WHEN sure >= 0.9 AND k = 3 THEN 2 WHEN sure < 0.5 THEN 3 ELSE k END] AS row_tier,
  ([0.92, 0.78, 0.55])[k]::DOUBLE AS cap, CASE WHEN k = 1 THEN 'medium' ELSE 'low' END AS downgraded, {_any("trim(blob)", t.WEAK_NOTE_MARKERS)} AS weak, {_any("trim(blob)", t.REDIRECT_MARKERS)} AS redirect,
  d = '' OR d IN ('example.com', 'example.org', 'localhost', 'invalid', 'test') OR d LIKE '%.example.com' OR d LIKE '%.example.org' OR {_any("d", t.PLACEHOLDER_FRAGMENTS)} AS placeholder
FROM q
"""

_WORDS = (*t.OPERATOR_TERMS, *t.PROMOTER_TERMS, *t.PROVIDER_TERMS, *t.PAYMENT_TERMS, "nothing")


def shipped_terms(spark, sf):
    """Entity types by the shipped term lists, with every kind of hint."""
    one = lambda shift: F.expr(_pick(f"(p_partkey * {shift} + p_partkey div 9)", _WORDS))
    rows = _t(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat_ws(" and ", one(1), one(3), one(5)).alias("notes"),
    )
    k = F.col("id")
    kind, why = rules.entity_type(
        tx.norm_blob(F.col("notes"), F.lit(None)),
        raw_type=F.when(k % 10 == 0, " Provider").otherwise("x"),
        provider_type=F.when(k % 14 == 0, "slots"),
        pattern_fields=k % 15 == 0,
        promotes=k % 4,
        uses_provider=(k + 1) % 5,
        domain=F.when(k % 13 == 0, "nodot").otherwise("a.b"),
        legal_anchor=k % 3 == 0,
    )
    return rows.select(
        "id",
        kind.alias("kind"),
        F.size(why).alias("n_reasons"),
        F.element_at(why, -1).alias("last_reason"),
    )


def _hits(x: str, words: Sequence[str]) -> str:
    return "(" + " + ".join(f"contains({x}, {_literal(w)})::INTEGER" for w in words) + ")"


SQL_SHIPPED = f"""
WITH r AS (
  SELECT p_partkey AS id, trim(concat_ws(' and ', {", ".join(_pick(f"(p_partkey * {s} + p_partkey // 9)", _WORDS) for s in (1, 3, 5))})) AS s FROM part
),
c AS (
  SELECT id, {_hits("s", t.OPERATOR_TERMS)} AS op, {_hits("s", t.PROMOTER_TERMS)} AS pr, {_hits("s", t.PROVIDER_TERMS)} AS pv, {_hits("s", t.PAYMENT_TERMS)} AS pay, id % 10 = 0 AS raw, id % 14 = 0 AS typed, id % 15 = 0 AS pat, id % 4 >= 2 AS many, (id + 1) % 5 >= 2 AS uses,
    id % 13 = 0 AS flat, id % 3 = 0 AS anchor FROM r
),
p AS (
  SELECT *, 2 * op + CASE WHEN anchor THEN 2 ELSE 0 END AS a, 2 * pv + CASE WHEN raw THEN 6 ELSE 0 END + CASE WHEN typed THEN 4 ELSE 0 END + CASE WHEN uses THEN 6 ELSE 0 END AS b,
    2 * pay + CASE WHEN pat THEN 5 ELSE 0 END + CASE WHEN flat THEN 3 ELSE 0 END AS c, 2 * pr + CASE WHEN many THEN 6 ELSE 0 END AS d FROM c
),
m AS (SELECT *, greatest(a, b, c, d) AS top, CASE WHEN greatest(a, b, c, d) = 0 THEN 'unknown' WHEN a = greatest(a, b, c, d) THEN 'operator' WHEN b = greatest(a, b, c, d) THEN 'provider' WHEN c = greatest(a, b, c, d) THEN 'payment_path' ELSE 'promoter' END AS kind FROM p)
SELECT id, kind, (raw::INTEGER + anchor::INTEGER + typed::INTEGER + (op > 0)::INTEGER + (pr > 0)::INTEGER + (pv > 0)::INTEGER + (pay > 0)::INTEGER + pat::INTEGER + flat::INTEGER + many::INTEGER + uses::INTEGER + 1)::INTEGER AS n_reasons,
  CASE WHEN top = 0 THEN 'rule:insufficient_entity_type_signals' ELSE 'rule:selected_type:' || kind || '_score_' || top END AS last_reason
FROM m
"""


def known_domains(spark, sf):
    """The first entity of a known kind that names a domain has it."""
    kind = F.expr(_pick("s_suppkey", ("operator", "promoter", "provider", "payment_path", "other")))
    rows = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        kind.alias("entity_type"),
        F.array(
            F.concat(F.lit("d"), F.col("s_nationkey").cast("string"), F.lit(".example")),
            F.lit(""),
        ).alias("domains"),
        F.col("s_suppkey").alias("ordinal"),
    )
    return crawl.domain_index(rows).select("domain", "kind", "entity_id")


SQL_KNOWN = f"""
WITH s AS (SELECT s_suppkey AS k, 'd' || s_nationkey || '.example' AS domain, {_pick("s_suppkey", ("operator", "promoter", "provider", "payment_path", "other"))} AS kind FROM supplier WHERE s_suppkey % 5 < 4)
SELECT domain, min_by(kind, k) AS kind, min(k)::VARCHAR AS entity_id FROM s GROUP BY domain
"""

ALL: dict[str, tuple] = {
    "cell_functions": (cell_functions, SQL_CELLS),
    "host_forms": (host_forms, SQL_FORMS),
    "infrastructure_filters": (infrastructure_filters, SQL_INFRASTRUCTURE),
    "page_signals": (page_signals, SQL_SIGNALS),
    "crawler_links": (crawler_links, SQL_CRAWLER),
    "address_hints": (address_hints, SQL_ADDRESSES),
    "shipped_markers": (shipped_markers, SQL_MARKERS),
    "shipped_terms": (shipped_terms, SQL_SHIPPED),
    "known_domains": (known_domains, SQL_KNOWN),
}
