"""Signals of HTML pages. Tokenising needs Python's html.parser; it runs in Arrow batches, and all that
follows is Column expressions.

Defined results: null html is an empty page; a page that breaks the parser gives what was read before;
repeated pages give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hosts import netloc, signal_host
from .text import contains_any, dedupe_sorted, strings, strip

#: Patterns of addresses, legal pages and measuring ids.
LEGAL_PATH = r"(?i)(terms|privacy|sweep|rules|policy|legal|responsible|eula|conditions)"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
ADDRESS = r"(?U)\b\d{1,6}\s+[\w\s]+,?\s+[A-Za-z\s]+,?\s+[A-Z]{2}\s+\d{5}(-\d{4})?\b"
GTAG = r"(?i)gtag\(\s*['\"]config['\"]\s*,\s*['\"](G-[A-Z0-9]+)['\"]"
UNIVERSAL = r"(?i)['\"](UA-\d+-\d+)['\"]"
CONTAINER = r"(?i)[?&]id=(GTM-[A-Z0-9]+)"
SUPPORT_HOSTS = ("helpshift", "zendesk", "intercom", "freshdesk")

_FIELDS = ("scripts", "iframes", "assets", "inline", "title", "footer")
#: Anchors as written, and as absolute addresses (null where they can't be joined to the page's).
_ANCHORS = ("hrefs", "joined")
_PARSED = T.StructType(
    [
        *(T.StructField(f, T.ArrayType(T.StringType(), False), False) for f in _FIELDS),
        *(T.StructField(f, T.ArrayType(T.StringType()), False) for f in _ANCHORS),
    ]
)


class _Page(HTMLParser):
    """Collects source addresses, anchors, and the text of title, footer and inline scripts."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.depth = base, {"title": 0, "footer": 0, "script": 0}
        self.found: dict[str, list[str]] = {f: [] for f in (*_FIELDS, *_ANCHORS)}

    def _add(self, field: str, address: str) -> None:
        try:
            self.found[field].append(urljoin(self.base, address.strip()))
        except ValueError:
            return

    def handle_starttag(self, tag, attrs):
        have = {k.lower(): v or "" for k, v in attrs}
        src, href = have.get("src"), have.get("href")
        match tag:
            case "title":
                self.depth[tag] = 1
            case "footer":
                self.depth[tag] += 1
            case "script" if src:
                self._add("scripts", src)
            case "script":
                self.depth[tag] += 1
            case "iframe" if src:
                self._add("iframes", src)
            case "img" if src:
                self._add("assets", src)
            case "link" if href and any(x in have.get("rel", "").lower() for x in ("stylesheet", "preload")):
                self._add("assets", href)
            case "a" if href:
                self.found["hrefs"].append(href)
                try:
                    self.found["joined"].append(urljoin(self.base, href.strip()))
                except ValueError:
                    self.found["joined"].append(None)

    def handle_endtag(self, tag):
        if tag in self.depth and self.depth[tag]:
            self.depth[tag] = 0 if tag == "title" else self.depth[tag] - 1

    def handle_data(self, data):
        for tag in ("title", "footer"):
            if self.depth[tag] and data.strip():
                self.found[tag].append(data.strip())
        if self.depth["script"] and data:
            self.found["inline"].append(data)


def parse_page(html: str, base: str) -> dict[str, list[str]]:
    page = _Page(base)
    try:
        page.feed(html)
        page.close()
    except Exception:  # noqa: BLE001  whatever a broken page does to the parser
        pass
    return page.found


def parsed(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """pages with ``page``, the struct of lists of parse_page."""
    fields = [f for f in pages.schema.fields if f.name != "page"]
    schema = T.StructType([*fields, T.StructField("page", _PARSED, False)])
    arrow = pa.struct(
        [
            *(pa.field(f, pa.list_(pa.field("element", pa.string(), False)), False) for f in _FIELDS),
            *(pa.field(f, pa.list_(pa.string()), False) for f in _ANCHORS),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index
            made = [
                parse_page(h or "", u or "")
                for h, u in zip(b.column(at(html)).to_pylist(), b.column(at(url)).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(at(f.name)) for f in fields), pa.array(made, arrow)],
                names=[f.name for f in schema.fields],
            )

    return pages.mapInArrow(run, schema)


def links(page: Column, url: Column, *, limit: int = 800, mail: bool = False) -> Column:
    """Absolute links in page order. By default mailto: goes (monitor); with mail it stays (crawler),
    and an address that only contains javascript: goes as well. ``url``: what the page was parsed with."""
    rows = F.transform(
        F.arrays_zip(page["hrefs"], page["joined"]),
        lambda x: F.struct(strip(x["hrefs"]).alias("h"), x["joined"].alias("j")),
    )
    used = lambda h: (h != "") & ~F.startswith(h, F.lit("#"))
    if mail:
        kept = F.filter(rows, lambda x: used(x["h"]) & ~F.contains(F.lower(x["h"]), F.lit("javascript:")))
    else:
        kept = F.filter(
            rows,
            lambda x: used(x["h"]) & ~F.startswith(
                F.lower(x["h"]), F.lit("javascript:"),
            ) & ~F.startswith(F.lower(x["h"]), F.lit("mailto:")),
        )
    return _present(F.transform(F.slice(kept, 1, limit), lambda x: x["j"]))


def widget(host: Column) -> Column:
    h = F.lower(host)
    return (
        F.when(contains_any(h, ("intercom.io", "intercomcdn.com")), "intercom")
        .when(contains_any(h, ("zendesk",)), "zendesk")
        .when(contains_any(h, ("driftt.com", "drift.com")), "drift")
        .when(contains_any(h, ("livechatinc.com",)), "livechat")
    )


def _present(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def with_names(
    rows: DataFrame, html: str, providers: Sequence[str] | Callable[[Column], Column], into: str,
) -> tuple[DataFrame, Sequence[str] | Column]:
    """(rows, what ``signals`` takes): names by a function of lower-cased texts (``matching.finder``) are found in a
    column of their own."""
    if not callable(providers):
        return rows, providers
    return rows.withColumn(into, providers(F.lower(F.coalesce(F.col(html), F.lit(""))))), F.col(into)


def signals(page: Column, html: Column, providers: Sequence[str] | Column = ()) -> Column:
    """Struct of technical, content and flow lists; technical lists keep repeats, as they come. providers: the names
    to look for, or a column of those that were found (``with_names``)."""
    hosts = lambda f: _present(F.transform(page[f], signal_host))
    scripts = page["scripts"]
    ids = F.transform(
        F.flatten(
            F.transform(
                page["inline"],
                lambda s: F.concat(
                    F.regexp_extract_all(s, F.lit(GTAG), F.lit(1)),
                    F.regexp_extract_all(s, F.lit(UNIVERSAL), F.lit(1)),
                ),
            )
        ),
        F.lower,
    )
    tags = F.filter(
        F.transform(
            F.filter(scripts, lambda u: F.contains(F.lower(u), F.lit("googletagmanager.com"))),
            lambda u: F.regexp_extract(u, CONTAINER, 1),
        ),
        lambda x: x != "",
    )
    technical = F.struct(
        ids.alias("analytics_ids"),
        tags.alias("tag_manager_ids"),
        hosts("scripts").alias("script_domains"),
        hosts("iframes").alias("iframe_domains"),
        hosts("assets").alias("asset_domains"),
        _present(F.transform(hosts("scripts"), widget)).alias("support_widget_providers"),
    )
    words = F.filter(F.split(F.lower(F.array_join(page["title"], " ")), r"(?U)[^\w]+"), lambda w: F.length(w) >= 4)
    lines = F.filter(
        F.transform(page["footer"], lambda s: strip(F.regexp_replace(s, r"(?U)\s+", " "))),
        lambda s: F.length(s) >= 12,
    )
    low = F.lower(F.coalesce(html, F.lit("")))
    mentions = providers if isinstance(providers, Column) else F.filter(
        strings(*(p.strip() for p in providers)),
        lambda p: (F.length(p) >= 3) & F.contains(low, F.lower(p)),
    )
    content = F.struct(
        dedupe_sorted(words, True).alias("title_terms"),
        F.slice(
            dedupe_sorted(F.transform(lines, lambda s: F.substring(s, 1, 500)), False),
            1,
            20,
        ).alias("footer_phrases"),
        dedupe_sorted(mentions, False).alias("provider_mentions"),
    )
    quoted = lambda word: F.transform(
        F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(rf"(?i)['\"](/[^'\"]*{word}[^'\"]*)['\"]"), F.lit(1)),
        F.lower,
    )
    flow = F.struct(
        quoted("cashier").alias("cashier_paths"),
        strings().alias("signup_paths"),
        quoted("redeem").alias("redemption_paths"),
    )
    return F.struct(technical.alias("technical"), content.alias("content"), flow.alias("flow"))


def legal_urls(urls: Column) -> Column:
    return dedupe_sorted(F.filter(urls, lambda u: F.rlike(u, F.lit(LEGAL_PATH))), False)


def support_urls(urls: Column) -> Column:
    return dedupe_sorted(F.filter(urls, lambda u: contains_any(F.lower(netloc(u)), SUPPORT_HOSTS)), False)


def _found(c: Column, pattern: str, most: int) -> Column:
    return F.slice(
        F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0)))),
        1,
        most,
    )


def emails(c: Column, most: int = 20) -> Column:
    return _found(c, EMAIL, most)


def address_hints(c: Column, most: int = 10) -> Column:
    return _found(c, ADDRESS, most)
