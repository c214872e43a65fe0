"""Column expressions, one case list for each."""

import pytest
from pyspark.sql import functions as F

from domscope.functions import hosts, html, rules
from domscope.functions import terms as t
from domscope.functions import text as x


def _eval(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("r")).first()["r"]


CASES = [
    (x.split_pipe, " a | |b|", ["a", "b"]),
    (x.split_pipe, None, []),
    (x.split_tokens, " a,b | c\n d ", ["a", "b", "c", "d"]),
    (x.parse_float, " 1.5e1 ", 15.0),
    (x.parse_float, "0.9d", 0.0),
    (x.parse_float, "nope", 0.0),
    (x.parse_float, None, 0.0),
    (x.norm_key, "  ACME \t Ltd ", "acme ltd"),
    (x.legal_keys, "X, Inc.|y ;  ", ["x", "inc.", "y"]),
    (x.slug_domain, "A-b.Co.uk/x", "a_b_co_uk"),
    (x.slug_domain, " ", "unknown"),
    (x.operator_id, "stake.us", "operator_stake_us"),
    (x.text, None, ""),
    (x.text, " a\t", "a"),
    (hosts.seed_domain, " WWW.Example.com./a ", "example.com."),
    (hosts.seed_domain, "http://x/y", "http://x/y"),
    (hosts.plain_domain, " WWW.a.b. ", "a.b"),
    (hosts.plain_domain, None, ""),
    (hosts.monitor_host, "https://u:p@WWW.A.b:80/x", "a.b"),
    (hosts.monitor_host, "ftp://a.b", None),
    (hosts.monitor_host, "http://[::1]:80/", "[::1]:80"),
    (hosts.monitor_host, "/x", None),
    (hosts.crawl_host, "http://my_host.x:8/", "my_host.x"),
    (hosts.crawl_host, "http://", None),
    (hosts.signal_host, "//CDN.a.b/x.js", "cdn.a.b"),
    (hosts.signal_host, "x.js", None),
    (hosts.cluster_host, "http://u@www.a.b.:8/", "u@www.a.b."),
    (hosts.cluster_host, None, ""),
    (hosts.rule_domain, " www.A.b/x ", "a.b"),
    (hosts.seed_hosts, "www.a.b/x | | C.d.", ["a.b", "c.d"]),
    (hosts.noise_nameserver, "ns1.Cloudflare.com.", True),
    (hosts.noise_nameserver, "notcloudflare.com", False),
    (hosts.noise_nameserver, "ns-1.awsdns-07.net", True),
    (hosts.noise_nameserver, "xawsdns-1.net", False),
    (hosts.noise_nameserver, None, False),
    (hosts.noise_mx, "aspmx.l.google.com", True),
    (hosts.noise_mx, "mx.own.net", False),
    (hosts.domain_shaped, "a-b.co", True),
    (hosts.domain_shaped, "-a.co", False),
    (hosts.domain_shaped, "a", False),
    (lambda c: hosts.pattern_cell(c)[0], "/pay https://u@Pay.x:1/y www.z.q, mailto://", ["pay.x", "z.q"]),
    (lambda c: hosts.pattern_cell(c)[1], "/pay a.b /q", ["/pay", "/q"]),
    (rules.tier_level, "first_party_verified", "high"),
    (rules.tier_level, None, "low"),
    (rules.tier_rank, None, 10),
    (rules.tier_rank, "odd", 8),
    (rules.tier_rank, "pending", 5),
    (rules.placeholder_domain, "a.example.com", True),
    (rules.placeholder_domain, "tbd.net", True),
    (rules.placeholder_domain, None, True),
    (rules.placeholder_domain, "good.net", False),
    (html.widget, "static.intercomcdn.com", "intercom"),
    (html.widget, "js.drift.com", "drift"),
    (html.widget, "a.b", None),
    (html.emails, "x a@b.co, c@d.io a@b.co", ["a@b.co", "c@d.io"]),
    (html.address_hints, "at 12 Main Street, Springfield, IL 62704 now", ["12 Main Street, Springfield, IL 62704"]),
]


@pytest.mark.parametrize(("column", "value", "expected"), CASES)
def test_expression(spark, column, value, expected):
    assert _eval(spark, column, value) == expected


def test_lists(spark):
    values = ["b", "A", " a ", "", "B", "c", None]
    assert _eval(spark, lambda c: x.dedupe_sorted(c, False), values, "array<string>") == ["A", "b", "c"]
    assert _eval(spark, lambda c: x.dedupe_sorted(c, True), values, "array<string>") == ["a", "b", "c"]
    assert _eval(
        spark,
        lambda c: x.merge_lists(c, F.array(F.lit("Z"), F.lit("B")), False),
        values,
        "array<string>",
    ) == ["A", "b", "c", "Z"]
    assert _eval(
        spark,
        lambda c: x.merge_lists(c, F.lit(None).cast("array<string>"), True),
        None,
        "array<string>",
    ) == []
    assert _eval(
        spark,
        hosts.signal_nameservers,
        ["", "NS1.own.net", "a.google.com"],
        "array<string>",
    ) == ["NS1.own.net"]
    mx = [(None,), (".",), (" mx.own.net ",), ("aspmx.l.google.com",)]
    assert _eval(spark, hosts.signal_mx_hosts, mx, "array<struct<host:string>>") == ["mx.own.net"]


@pytest.mark.parametrize(
    ("cells", "expected"),
    [
        (("high", ""), 0.92), (("", "Mid"), 0.8), (("low", "0.9"), None), (("junk", "0.4"), 0.4), ((None, None), None),
        (("0.7", "high"), 0.7),
    ],
)
def test_confidence(spark, cells, expected):
    df = spark.createDataFrame([cells], "a string, b string")
    assert df.select(x.confidence(F.col("a"), F.col("b")).alias("r")).first()["r"] == expected


@pytest.mark.parametrize(
    ("notes", "sources", "expected"),
    [
        ("Confirmed on official site", "", t.FIRST),
        ("not verified; official site", "", t.INFERRED),
        ("per reporting", "", t.SECONDARY),
        ("it was reported ", "", t.SECONDARY),
        ("reported", None, t.SECONDARY),
        (None, None, t.INFERRED),
        ("unconfirmed", "site", t.FIRST),
        ("unlikely", "", t.INFERRED),
    ],
)
def test_evidence_tier(spark, notes, sources, expected):
    df = spark.createDataFrame([(notes, sources)], "n string, s string")
    assert df.select(rules.evidence_tier(F.col("n"), F.col("s")).alias("r")).first()["r"] == expected


def test_row_tier(spark):
    df = spark.createDataFrame([("x", 0.95), ("official site", 0.3), ("official site", None)], "n string, c double")
    assert [
        r[0] for r in df.select(rules.row_tier(F.col("n"), F.lit(""), F.col("c"))).collect()
    ] == [t.SECONDARY, t.INFERRED, t.FIRST]


def test_labels(spark):
    df = spark.createDataFrame([(s,) for s in (100, 80, 79, 50, 25, 24)], "s int")
    assert [r[0] for r in df.select(rules.score_label(F.col("s"))).collect()] == [
        "likely_same_network", "likely_same_network", "strong_affiliation", "strong_affiliation",
        "possible_affiliation", "weak_signal",
    ]


def test_term_hits(spark):
    assert _eval(spark, lambda c: x.term_hits(c, t.OPERATOR_TERMS), "a social casino, casino") == 2
    assert _eval(spark, lambda c: x.term_hits(c, t.OPERATOR_TERMS), None) == 0
    assert _eval(spark, lambda c: x.contains_any(c, ("a.b", "x y")), "a.b") is True
    assert _eval(spark, lambda c: x.contains_any(c, ("a.b",)), "aXb") is False


PAGE = """<html><head><title>Great Casino Slots</title><script src="https://www.googletagmanager.com/gtm.js?id=GTM-AB12"></script>
<script>gtag('config', 'G-XYZ9'); var u='UA-12-3';</script><script src="//js.intercomcdn.com/a.js"></script><link rel="stylesheet" href="/s.css"><link rel="icon" href="/i.ico"></head>
<body><img src="https://cdn.x.io/p.png"><iframe src="https://frame.y.io/"></iframe><a href="/terms">T</a><a href="#top">t</a><a href="javascript:void(0)">j</a><a href="mailto:a@b.co">m</a><a href="https://help.zendesk.com/x">h</a><a href="http://[bad">b</a>
<div data-x='/Cashier/home'></div><footer>Short<p>Operated by  Acme   Holdings Ltd.</p></footer></body></html>"""


def test_html(spark):
    pages = spark.createDataFrame(
        [("https://www.site.com/p", PAGE), ("https://empty.com", None)],
        "url string, html string",
    )
    rows = html.parsed(pages).withColumns(
        {
            "s": html.signals(F.col("page"), F.col("html"), ("Acme", "No")),
            "l": html.links(F.col("page"), F.col("url")),
            "m": html.links(F.col("page"), F.col("url"), mail=True),
            "one": html.links(F.col("page"), F.col("url"), limit=1),
        }
    )
    r, e = rows.withColumns({"legal": html.legal_urls(F.col("m")), "support": html.support_urls(F.col("m"))}).collect()
    tech = r["s"]["technical"]
    assert tech["tag_manager_ids"] == ["GTM-AB12"] and tech["analytics_ids"] == ["g-xyz9", "ua-12-3"]
    assert tech["script_domains"] == [
        "googletagmanager.com", "js.intercomcdn.com",
    ] and tech["support_widget_providers"] == ["intercom"]
    assert tech["iframe_domains"] == ["frame.y.io"] and sorted(tech["asset_domains"]) == ["cdn.x.io", "site.com"]
    assert r["s"]["content"]["title_terms"] == ["casino", "great", "slots"] and r["s"]["content"]["footer_phrases"] == [
        "Operated by Acme Holdings Ltd."
    ] and r["s"]["content"]["provider_mentions"] == ["Acme"]
    assert r["s"]["flow"]["cashier_paths"] == ["/cashier/home"]
    assert r["l"] == ["https://www.site.com/terms", "https://help.zendesk.com/x"] and r["m"] == [
        "https://www.site.com/terms", "mailto:a@b.co", "https://help.zendesk.com/x",
    ] and r["one"] == r["l"][:1]
    assert r["legal"] == ["https://www.site.com/terms"] and r["support"] == ["https://help.zendesk.com/x"]
    assert e["l"] == [] and e["s"]["content"]["title_terms"] == []


def _type(spark, **given):
    base = (
        {
            "blob": "", "raw_type": "", "provider_type": "", "pattern": False, "promotes": 0, "uses": 0,
            "domain": "a.b", "legal": False,
        }
        | given
    )
    df = spark.createDataFrame(
        [tuple(base.values())],
        "blob string, raw_type string, provider_type string, pattern boolean, promotes int, uses int, domain string, legal boolean",
    )
    c = F.col
    kind, why = rules.entity_type(
        c("blob"),
        raw_type=c("raw_type"),
        provider_type=c("provider_type"),
        pattern_fields=c("pattern"),
        promotes=c("promotes"),
        uses_provider=c("uses"),
        domain=c("domain"),
        legal_anchor=c("legal"),
    )
    return tuple(df.select(kind.alias("k"), why.alias("w")).first())


def test_entity_type(spark):
    assert _type(spark) == ("unknown", ["rule:insufficient_entity_type_signals"])
    assert _type(spark, blob="casino wallet") == (
        "operator",
        ["rule:operator_term_hits:1", "rule:payment_term_hits:1", "rule:selected_type:operator_score_2"],
    )
    assert _type(spark, raw_type=" Provider ")[0] == "provider"
    assert _type(spark, promotes=2, blob="reviews")[0] == "promoter"
    assert _type(spark, domain="nodots")[0] == "payment_path" and _type(spark, domain=" ")[0] == "unknown"
    assert _type(spark, legal=True, uses=2)[0] == "provider"


def test_promotion_and_blocking(spark):
    lit = F.lit
    base = {
        "kind": "operator", "tier": t.FIRST, "legal": True, "attach": False, "strong_cluster": False, "domain_ok": True,
        "weak": False, "contradictory": False, "little_signal": False, "notes": "",
    }

    def prom(**g):
        return tuple(
            spark.range(1).select(
                *(c.alias(str(i)) for i, c in enumerate(rules.promotion(**{k: lit(v) for k, v in (base | g).items()})))
            ).first()
        )

    assert prom() == ("promote_now", "rule:promotion_promote_first_party_strong_anchor")
    assert prom(contradictory=True)[0] == "reject_for_now" and prom(domain_ok=False)[1].endswith(
        "placeholder_or_missing"
    )
    assert prom(tier=t.SECONDARY, notes="HTTP 403")[1] == "rule:promotion_stage_403_secondary"
    assert prom(
        kind="unknown",
        tier=t.SECONDARY,
        strong_cluster=True,
    )[0] == "stage_only" and prom(kind="unknown")[0] == "reject_for_now"
    assert prom(weak=True) == (
        "stage_only",
        "rule:promotion_stage_mixed_or_inferred",
    ) and prom(tier=t.SECONDARY, legal=False, attach=True)[1].endswith("without_legal")
    base_b = {
        "kind": "operator", "tier": "", "legal_level": "low", "redirect": False, "evidence_only": False,
        "confirmed": False, "touches_confirmed": False, "hits": 0,
    }

    def block(**g):
        return tuple(
            spark.range(1).select(
                *(c.alias(str(i)) for i, c in enumerate(rules.blocking(**{k: lit(v) for k, v in (base_b | g).items()})))
            ).first()
        )

    assert block()[1] == [
        "rule:block_after_review_operator_mixed"
    ] and block(hits=4)[0] == "block_now" and block(hits=2)[0] == "block_after_review"
    assert block(tier=t.FIRST, redirect=True) == (
        "block_now",
        ["rule:block_now_redirect_shell_operator", "rule:block_now_operator_first_party"],
    )
    assert block(kind="provider", evidence_only=True)[1] == [
        "rule:block_do_not_evidence_only_provider"
    ] and block(kind="promoter", confirmed=True)[0] == "do_not_block"
    assert block(redirect=True)[0] == "block_after_review" and block(redirect=True, hits=2)[0] == "block_now" and block(
        touches_confirmed=True
    )[1] == [
        "rule:block_after_review_operator_cluster_known_family"
    ]
    assert block(kind="unknown", confirmed=True)[0] == "block_now" and block(kind="unknown")[0] == "do_not_block"


def test_field_confidence(spark):
    c = rules.field_confidence(
        F.lit(t.FIRST),
        F.lit(True),
        {"brand": F.lit(True), "parent_company": F.lit(True), "domain": F.lit(False)},
    )
    assert spark.range(1).select(c.alias("m")).first()["m"] == {
        "brand": "high", "domain": "low", "parent_company": "medium",
    }
