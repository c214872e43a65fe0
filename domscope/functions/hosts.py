"""Host normalisers and infrastructure denylists as Column builders.

The stages differ in small ways on purpose, so each keeps its own normaliser. URLs are taken apart by
the regular expression of RFC 3986, appendix B: parse_url() rejects hosts that occur in practice.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import split_on, split_tokens, strip

_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?.*$"

#: Shared infrastructure that says nothing about ownership.
NOISE_NAMESERVERS = (
    "cloudflare.com", "googledomains.com", "google.com", "azure-dns.com", "dnsimple.com", "registrar-servers.com",
    "domaincontrol.com", "name-services.com",
)
NOISE_NAMESERVER_LABELS = ("awsdns-",)
NOISE_MX = ("google.com", "googlemail.com", "outlook.com", "mail.protection.outlook.com")
#: Fixed value: what counts as a bare domain name.
DOMAIN_SHAPE = r"(?i)^([a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,}$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def no_www(h: Column) -> Column:
    return F.regexp_replace(h, r"^www\.", "")


def no_dots(h: Column) -> Column:
    return F.regexp_replace(h, r"\.+$", "")


def _no_user(h: Column) -> Column:
    return F.substring_index(h, "@", -1)


def _no_port(h: Column) -> Column:
    return F.substring_index(h, ":", 1)


def seed_domain(c: Column) -> Column:
    """Seed cells: stripped, without www. and, unless it is a URL, without a path."""
    h = no_www(no_dots(strip(F.lower(c))))
    return F.when(
        F.contains(h, F.lit("/")) & ~F.contains(h, F.lit("://")),
        strip(F.substring_index(h, "/", 1)),
    ).otherwise(h)


def plain_domain(c: Column) -> Column:
    """Stripped, lower case, without trailing dots and www.; no path rule (monitor, fingerprints, blocklist)."""
    return no_www(no_dots(strip(F.lower(F.coalesce(c, F.lit(""))))))


def monitor_host(url: Column) -> Column:
    """Host of an http(s) URL, null otherwise; a bracketed IPv6 host is kept whole."""
    h = _no_user(netloc(url))
    h = F.when(F.contains(h, F.lit(":")) & ~F.startswith(h, F.lit("[")), _no_port(h)).otherwise(h)
    return F.when(scheme(url).isin("http", "https") & (netloc(url) != ""), plain_domain(h))


def crawl_host(url: Column) -> Column:
    """Host of an http(s) URL for the crawler; null if nothing is left."""
    h = no_www(no_dots(F.lower(_no_port(_no_user(netloc(url))))))
    return F.when(scheme(url).isin("http", "https") & (h != ""), h)


def signal_host(url: Column) -> Column:
    """As crawl_host, for any scheme or none."""
    h = no_www(no_dots(F.lower(_no_port(_no_user(netloc(url))))))
    return F.when(h != "", h)


def cluster_host(url: Column) -> Column:
    """Redirect chains: user info and trailing dots stay."""
    return _no_port(no_www(F.lower(netloc(F.coalesce(url, F.lit(""))))))


def rule_domain(c: Column) -> Column:
    """Rules: the path goes before www. does."""
    return no_www(F.substring_index(no_dots(strip(F.lower(F.coalesce(c, F.lit(""))))), "/", 1))


def seed_hosts(cell: Column) -> Column:
    """Hosts of a piped cell."""
    return F.filter(
        F.transform(split_on(cell, "[|]"), lambda s: rule_domain(F.substring_index(s, "/", 1))),
        lambda h: h != "",
    )


def pattern_cell(cell: Column) -> tuple[Column, Column]:
    """(domains, path patterns) of a payment cell that mixes paths, URLs and hosts."""
    tokens = split_tokens(cell)
    patterns = F.filter(tokens, lambda t: F.startswith(t, F.lit("/")))
    url = lambda t: F.contains(t, F.lit("://"))
    host = lambda t: seed_domain(F.when(url(t), _no_port(_no_user(netloc(t)))).otherwise(t))
    usable = F.filter(tokens, lambda t: ~F.startswith(t, F.lit("/")) & (~url(t) | (_no_user(netloc(t)) != "")))
    return F.transform(usable, host), patterns


def suffix_matches(host: Column, suffixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | (host == s) | F.endswith(host, F.lit("." + s))
    return out


def _noise_form(c: Column) -> Column:
    return no_dots(strip(F.lower(F.coalesce(c, F.lit("")))))


def noise_nameserver(
    c: Column,
    suffixes: Sequence[str] = NOISE_NAMESERVERS,
    labels: Sequence[str] = NOISE_NAMESERVER_LABELS,
) -> Column:
    h = _noise_form(c)
    out = suffix_matches(h, suffixes)
    if labels:
        out = out | F.rlike(h, F.lit(r"(^|[.])(" + "|".join(re.escape(p) for p in labels) + ")"))
    return out


def noise_mx(c: Column, suffixes: Sequence[str] = NOISE_MX) -> Column:
    return suffix_matches(_noise_form(c), suffixes)


def signal_nameservers(values: Column, **lists) -> Column:
    return F.filter(values, lambda x: x.isNotNull() & (x != "") & ~noise_nameserver(x, **lists))


def signal_mx_hosts(mx: Column, **lists) -> Column:
    """Hosts of mx array<struct<host, ...>> without null MX and noise."""
    hosts = F.transform(mx, lambda m: F.coalesce(strip(m["host"]), F.lit("")))
    return F.filter(hosts, lambda h: ~h.isin("", ".") & ~noise_mx(h, **lists))


def domain_shaped(c: Column) -> Column:
    return c.rlike(DOMAIN_SHAPE)
