"""Stages on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from domscope.functions import terms as t
from domscope.plans import affiliations, cluster, crawl, enrich, publish, review, seeds, signing, staging
from domscope.schemas import DOMAIN_FINGERPRINT
from domscope.sources import files


def _csv(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


@pytest.fixture(scope="module")
def normalised(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("seeds")
    tables = {
        "operators": files.csv_table(
            spark,
            _csv(
                d,
                "o.csv",
                'id,name,domain,categories,status,confidence,legal_entity,jurisdictions,provider_names,notes,sources\no1,One,"www.One.com, one.net/x",a|b,,0.9,ACME  Ltd,US|CA,Studio X,"a ""quoted"" note",s1|s2\n,No id,x.com,,,,,,,,\no2,,two.com,,active,bad,acme ltd,,studio x,,\no3,Three,,,active,1,,,,,\no4,Four,one.com,,inactive,1,acme ltd,,,,\n',
            ),
            ["id", "name", "domain"],
        ),
        "providers": files.csv_table(
            spark,
            _csv(
                d,
                "p.csv",
                "id,name,domain,provider_type,status,confidence,blockable,notes,sources\np1,Studio X,,,active,0.8,No,,\np2,Other,other.io,studio,active,0.8,YES,,\n",
            ),
            ["id", "name", "domain"],
        ),
        "promoters": files.csv_table(
            spark,
            _csv(
                d,
                "r.csv",
                "id,name,domain,promoter_type,status,confidence,promotes_categories,notes,sources\nr1,Rev,rev.com,list,active,0.5,x|y,,\n",
            ),
            ["id", "domain"],
        ),
        "payment_paths": files.csv_table(
            spark,
            _csv(
                d,
                "y.csv",
                "id,name,domain_or_pattern,payment_type,status,confidence,notes,sources\ny1,Pay,/pay https://pay.me/x,,active,0.8,,\ny2,Low,low.me,,active,0.5,,\ny3,None, ,,active,0.5,,\n",
            ),
            ["id", "domain_or_pattern"],
        ),
        "relationships": files.csv_table(
            spark,
            _csv(
                d,
                "e.csv",
                "from_id,to_id,relationship,confidence,source,evidence_url,evidence_text\no1,p1,uses_provider,0.7,,http://x,\no2,p1,uses_provider,,s,,\nr1,o1,promotes,1,,,\no1,zz,,1,,,\n,o1,x,1,,,\n",
            ),
            ["from_id", "to_id"],
        ),
    }
    return seeds.normalise(tables, "T")


def test_normalise(normalised):
    ents = {r["id"]: r for r in normalised["entities"].collect()}
    assert list(ents) and set(ents) == {"o1", "o2", "o4", "p1", "p2", "r1", "y1", "y2"}
    o1 = ents["o1"]
    assert o1["domains"] == [
        "one.com", "one.net",
    ] and o1[
        "categories"
    ] == ["a", "b"] and o1["status"] == "active" and o1["confidence"] == 0.9 and o1["notes"] == 'a "quoted" note'
    assert ents["o2"]["name"] == "o2" and ents["o2"]["confidence"] == 0.0 and ents["p1"]["attributes"][
        "domains_pending_verification"
    ] and not ents["p1"]["attributes"]["blockable"] and ents["p1"]["attributes"]["provider_type"] == "unknown"
    assert ents["y1"]["domains"] == ["pay.me"] and ents["y1"]["attributes"]["path_patterns"] == ["/pay"]
    edges = {(r["from_id"], r["to_id"], r["source"]) for r in normalised["relationships"].collect()}
    assert edges == {("o1", "p1", "manual_seed"), ("o2", "p1", "s"), ("r1", "o1", "manual_seed")}
    assert [r["error"] for r in normalised["errors"].collect()] == ["unknown to_id: zz"]
    assert [
        (r["domain"], r["owners"]) for r in normalised["contested"].collect()
    ] == [("one.com", ["operator:o1", "operator:o4"])]


def test_affiliations(normalised):
    rows = affiliations.entity_affiliations(
        normalised["entities"], normalised["fingerprints"], normalised["relationships"],
    ).collect()
    got = {
        (r["left"], r["right"]): (r["score"], r["label"], [(e["type"], e["value"]) for e in r["evidence"]])
        for r in rows
    }
    assert got[("o1", "o2")] == (
        70,
        "strong_affiliation",
        [("shared_legal_entity", "ACME  Ltd"), ("shared_provider", "studio x")],
    )
    assert got[("o1", "p1")][2] == [("shared_provider", "studio x")] and not any("o4" in k for k in got)


def test_block_candidates(normalised):
    assert [
        r[0] for r in publish.block_candidates(normalised["entities"]).collect()
    ] == ["one.com", "one.net", "other.io", "pay.me", "two.com"]


def test_enrich(spark, normalised, tmp_path):
    partial = files.csv_table(
        spark,
        _csv(
            tmp_path,
            "f.csv",
            "entity_id,analytics_ids,title_terms,script_domains\no1,old,x,\no1,UA-1|ua-1,Term,CDN.x\nnew,,,a.b\n",
        ),
        ["entity_id"],
    )
    pages = spark.createDataFrame(
        [
            ("https://one.com/", "<title>Lucky Slots</title><script src='//cdn.y/a.js'></script>Studio X"),
            ("http://two.com/", "<title>Second Place</title>"),
        ],
        "url string, html string",
    )
    got = {
        r["entity_id"]: r
        for r in enrich.enrich(normalised["entities"], normalised["fingerprints"], partial, pages).collect()
    }
    assert "new" in got and got["new"]["technical"]["script_domains"] == ["a.b"]
    o1 = got["o1"]
    assert o1["technical"]["analytics_ids"] == ["ua-1"] and o1["technical"][
        "script_domains"
    ] == ["cdn.x", "cdn.y"] and o1["content"]["title_terms"] == [
        "lucky", "slots", "term",
    ] and o1["content"]["provider_mentions"] == ["Studio X"]
    assert got["o2"]["content"]["title_terms"] == ["place", "second"] and got["p2"]["content"]["title_terms"] == []


def _prints(spark, rows):
    return spark.createDataFrame(rows, DOMAIN_FINGERPRINT)


def test_domain_signals(spark):
    prints = _prints(spark, [
        ("a.com", ["b.com", "c.com"], ["ns1.rare.net", "ns.cloudflare.com"], [("mx.own.net", 1)], False, False),
        ("b.com", ["a.com"], ["NS1.rare.net"], [], False, False),
        ("c.com", [], ["ns.cloudflare.com"], [("MX.own.net", 5), (".", 0)], False, True),
        ("d.com", ["a.com"], [], [], True, False),
    ])
    got = {(r["left"], r["right"], r["type"]): r["shared"] for r in affiliations.signal_pairs(prints).collect()}
    assert got == {
        ("a.com", "b.com", "tls_san_reciprocal"): [],
        ("a.com", "c.com", "tls_san_one_way"): [],
        ("a.com", "b.com", "shared_nameserver_filtered"): ["ns1.rare.net"],
        ("a.com", "c.com", "shared_mx_filtered"): ["mx.own.net"],
    }
    first = affiliations.domain_affiliations(prints).collect()[0]
    assert (first["left"], first["right"], first["score"], first["label"]) == ("a.com", "b.com", 20, "weak_signal")
    assert [e["value"] for e in first["evidence"]] == ["ns1.rare.net", "a.com|b.com|reciprocal_san"]


def test_domain_records(spark):
    doc = {
        "WWW.A.com": {
            "san": "b.com",
            "dns": {"nameservers": ["n1"], "mx": [{"host": "m", "priority": 1}]},
            "tls": {"partial": True},
        },
        "bad": 5,
        "b.com": {"sans": [], "tls": {"sans": ["WWW.X.com.", " "]}, "partial": False},
        "a.com": {"nameservers": ["n2"]},
    }
    frame = spark.createDataFrame([(json.dumps(doc),), ("not json",), (None,)], "value string")
    got = {r["domain"]: r for r in files.domain_records(frame).collect()}
    assert set(got) == {"a.com", "b.com"} and got["b.com"]["sans"] == ["x.com"] and not got["b.com"]["tls_partial"]


def test_clusters(spark, normalised):
    ents = normalised["entities"]
    prints = normalised["fingerprints"].withColumn(
        "technical",
        F.struct(
            *(
                F.array(F.lit("cdn.a"), F.lit("cdn.b")).alias("script_domains")
                if x == "script_domains"
                else F.col(f"technical.{x}").alias(x)
                for x in normalised["fingerprints"].schema["technical"].dataType.fieldNames()
            )
        ),
    ).where("entity_id IN ('o2', 'r1')")
    staged = spark.createDataFrame(
        [
            ("s1", "S1.com", "Beta", "", 0),
            ("s2", "s2.com", " beta ", "", 1),
            ("s3", "s3.com", "acme LTD", "", 2),
            ("s4", "s4.com", "", "", 3),
        ],
        "candidate_id string, domain string, legal_entity string, parent_company string, ordinal long",
    )
    dump = spark.createDataFrame(
        [("s4.com", "x.com", "r", "n"), ("q.com", "q.com", "r", "")],
        "from_domain string, to_domain string, relationship string, notes string",
    )
    disc = spark.createDataFrame(
        [("d", ["http://www.u.com/a", "https://v.com/"]), ("e", ["http://u.com"])],
        "domain string, redirect_chain array<string>",
    )
    edges = cluster.evidence_edges(ents, prints, staged, dump=dump, discovered=disc)
    reasons = {(r["left"], r["right"]): r["reason"] for r in edges.collect()}
    assert reasons[
        ("rev.com", "two.com")
    ] == "script_domain_overlap" and reasons[
        ("s1.com", "s2.com")
    ] == "staged_same_legal_entity" and reasons[("u.com", "v.com")] == "discovery_redirect_chain" and reasons[
        ("s4.com", "x.com")
    ] == "affiliation_dump_pair"
    got = {r["cluster_id"]: r["members"] for r in cluster.clusters(edges).collect()}
    assert got["cluster-one.com"] == [
        "one.com", "rev.com", "s3.com", "two.com",
    ] and got["cluster-s1.com"] == ["s1.com", "s2.com"] and len(got) == 4


def test_monitor(spark, normalised):
    pages = spark.createDataFrame(
        [
            (
                0,
                "https://rev.com/a",
                '<a href="https://one.com/x">1</a><a href="https://newcasino.net/">n</a><a href="/in">i</a>',
            ),
            (1, "https://rev.com/b", '<a href="http://newcasino.net/z">n</a><a href="https://reviewbonus.io">r</a>'),
            (2, "https://one.com/", '<a href="https://two.com">t</a>'),
            (3, "https://x.com", None),
        ],
        "ordinal long, url string, html string",
    )
    found, edges = crawl.monitor(pages, normalised["entities"], "T", "run")
    got = {r["domain"]: r for r in found.collect()}
    assert set(got) == {"newcasino.net", "reviewbonus.io"} and got["newcasino.net"]["seen_on_urls"] == [
        "https://rev.com/a", "https://rev.com/b",
    ] and got["reviewbonus.io"]["bucket"] == "promoters"
    assert {
        (r["from_id"], r["to_id"], r["relationship"]) for r in edges.collect()
    } == {("r1", "o1", "promotes"), ("o1", "o2", "links_to")}


def test_discover(spark):
    link = lambda *hrefs: "".join(f'<a href="{h}">x</a>' for h in hrefs)
    pages = spark.createDataFrame(
        [
            ("http://a.com/", link("/1", "/2", "/2", "/3", "http://b.com/", "http://deny.com/"), "http://a.com/"),
            ("http://a.com/1", link("/4", "http://c.com"), "http://a.com/1"),
            ("http://a.com/2", link("/"), "http://a.com/2"),
            ("http://z.com/", link("http://b.com/x"), "http://z2.com/"),
        ],
        "url string, html string, final_url string",
    )
    starts = spark.createDataFrame(
        [("http://a.com/", 0), ("http://z.com/", 1), ("http://none.com/", 2)],
        "url string, ordinal long",
    )
    deny = spark.createDataFrame([("deny.com",)], "host string")
    domains, visits = crawl.discover(starts, pages, max_same_host_pages=3, deny=deny)
    got = {r["domain"]: (r["source_urls"], r["redirect_chain"]) for r in domains.collect()}
    assert set(got) == {
        "a.com", "b.com", "c.com", "z2.com",
    } and got["b.com"][0] == ["http://a.com/", "http://z.com/"] and got["z2.com"][1] == [
        "http://z.com/", "http://z2.com/",
    ]
    # Three links of a.com pass (a repeated one counts), so /3 and /4 stay out.
    assert {r["requested_url"] for r in visits.collect()} == {
        "http://a.com/", "http://a.com/1", "http://a.com/2", "http://z.com/", "http://none.com/",
    }
    assert [
        r[0] for r in crawl.worklist(domains, visits, 3).collect()
    ] == ["https://a.com/", "https://b.com/", "https://c.com/"]


def test_extract(spark):
    pages = spark.createDataFrame(
        [
            ("https://a.com/", None, 200, '<a href="/terms">t</a> mail x@y.co at official site'),
            ("https://b.com", "https://www.c.com/", 200, "hi"),
            ("https://d.com", None, -1, "x"),
            ("https://e.com", None, 200, ""),
        ],
        "url string, final_url string, status int, html string",
    )
    got = {r["domain"]: r for r in crawl.extract(pages, []).collect()}
    assert set(got) == {"a.com", "c.com"} and got["a.com"]["legal_policy_urls"] == [
        "https://a.com/terms"
    ] and got["a.com"]["contact_emails"] == ["x@y.co"] and got["a.com"]["evidence_tier"] == t.INFERRED


def test_lists(spark, tmp_path):
    lines = files.lines(spark, _csv(tmp_path, "u.txt", "# c\nhttp://a\n\n http://b \nWWW.C.com./x\n"))
    assert [
        r["url"] for r in crawl.seed_urls(lines).orderBy("ordinal").collect()
    ] == ["http://a", "http://b", "WWW.C.com./x"]
    assert "www.c.com" in {r["host"] for r in crawl.domain_list(lines).collect()}
    assert files.lines(spark, str(tmp_path / "none")).count() == 0 and files.csv_table(
        spark, str(tmp_path / "none"), ["a"],
    ).count() == 0


RESEARCH = "domain,brand,legal_entity,parent_company,notes,sources,provider_mentions,cashier_path\nA.com,,ACME,,confirmed on official site,s1|s2,Studio|X,/cash\n,,,,,,,\nb.com,Bee,acme ,,not verified,,,\nc.com,Cee,,Parent,,one,,\nd.com,Dee,x,PARENT,,,,\n"


def test_staging(spark, tmp_path):
    entities, prints = staging.stage(files.csv_table(spark, _csv(tmp_path, "r.csv", RESEARCH), ["domain", "brand"]))
    rows = {r["candidate_id"]: r for r in entities.collect()}
    assert set(rows) == {"research_0001", "research_0003", "research_0004", "research_0005"}
    assert rows[
        "research_0001"
    ]["brand"] == "A.com" and rows[
        "research_0001"
    ]["evidence_tier"] == t.FIRST and rows["research_0001"]["sources_list"] == ["s1", "s2"]
    assert {
        (r["from_candidate_id"], r["to_candidate_id"]) for r in staging.corporate_edges(entities).collect()
    } == {("research_0001", "research_0003"), ("research_0004", "research_0005")}
    dump = spark.createDataFrame(
        [("A.COM ", "b.com", "", None, "", "", 0), ("a.com", "zz", "r", 0.9, "", "", 1)],
        "from_domain string, to_domain string, relationship string, confidence double, notes string, sources string, ordinal long",
    )
    assert [
        (r["import_id"], r["relationship"], r["confidence"], r["resolution_status"])
        for r in staging.resolved_dump(dump, entities).orderBy("import_id").collect()
    ] == [("claude_aff_0000", "related_to", 0.5, "resolved"), ("claude_aff_0001", "r", 0.9, "unresolved_domain")]
    ok = entities.withColumn(
        "review_status",
        F.when(F.col("candidate_id") != "research_0005", "approved").otherwise("needs_review"),
    )
    rels = staging.corporate_edges(entities).withColumn("review_status", F.lit("approved"))
    ops, partial, edges = staging.promotion_preview(ok, prints, rels)
    assert {(r["id"], r["confidence"], r["status"]) for r in ops.collect()} == {
        ("operator_a_com", "0.85", "inactive"),
        ("operator_b_com", "0.55", "inactive"),
        ("operator_c_com", "0.55", "inactive"),
    }
    assert [
        (r["from_operator_id"], r["to_operator_id"]) for r in edges.collect()
    ] == [("operator_a_com", "operator_b_com")]
    assert {r["entity_id"]: r["provider_mentions"] for r in partial.collect()}["operator_a_com"] == "Studio|X"


def test_candidates(spark, tmp_path):
    text = "Brand,primary_domain,other_domains,notes,source_set,confidence,duplicate_group_id,canonical\nX,X.com/a,x2.com,n,batch,high,g1,\nY,y.com,,official site,batch,0.3,g1,yes\nZ,z.com,,,b,,g1,\nW,w.com,,,b,medium,g2,\n"
    ents = staging.candidate_entities(
        files.csv_table(spark, _csv(tmp_path, "c.csv", text), [], trimmed=True),
        "operator",
        "c.csv",
        "scout_operator",
    )
    rows = {r["candidate_id"]: r for r in ents.collect()}
    x = rows["scout_operator_0001"]
    assert (
        x["domain"], x["confidence"], x["evidence_tier"], x["alias_review_status"],
    ) == (
        "x.com", 0.92, t.SECONDARY, "needs_manual_verification",
    ) and rows["scout_operator_0002"]["evidence_tier"] == t.INFERRED
    dup = staging.duplicate_edges(ents, ["scout_row_index"])
    assert [
        (r["relationship_id"], r["from_candidate_id"], r["to_candidate_id"])
        for r in staging.numbered(dup, ["scout_row_index"]).orderBy("relationship_id").collect()
    ] == [
        ("scout_dup_0001", "scout_operator_0001", "scout_operator_0002"),
        ("scout_dup_0002", "scout_operator_0003", "scout_operator_0002"),
    ]
    many = spark.range(10_050).selectExpr(
        "'g' AS duplicate_group_id", "format_string('c%06d', id) AS candidate_id", "id = 3 AS is_canonical_candidate", "id AS row",
    )
    made = staging.numbered(staging.duplicate_edges(many, ["row"]), ["row"])
    assert "SinglePartition" not in made._jdf.queryExecution().toString()
    ids = [(r.relationship_id, r.from_candidate_id) for r in made.orderBy("ordinal").collect()]
    assert len(ids) == 10_049 and ids[9_999] == ("scout_dup_10000", "c010000") and ids[0][1] == "c000000" and ids[3][1] == "c000004"
    actions = staging.import_actions(ents)
    assert {r["candidate_id"][-1]: r["action"] for r in actions.collect()} == {
        "1": "needs_manual_verification",
        "2": "stage_only",
        "3": "stage_only",
        "4": "stage_only",
    }
    s = staging.import_summary(ents, actions, dup).first()
    assert (
        s["entities"], s["with_aliases"], s["duplicate_groups"], s["canonical"], s["duplicate_edges"],
    ) == (4, 1, 2, 1, 2)


def _review_inputs(spark):
    ent = "candidate_id string, domain string, brand string, legal_entity string, parent_company string, jurisdiction string, company_number string, notes string, sources string, evidence_tier string, review_status string, raw_row map<string,string>, ordinal long, rid long"
    staged = spark.createDataFrame(
        [
            (
                "c1", "new.com", "B", "ACME  Ltd, Other", "", "", "", "a social casino with slots", "src", t.FIRST, "",
                {}, 0, 0,
            ),
            ("c2", "pair.com", "B", "", "", "", "", "formerly old; poker casino", "", t.SECONDARY, "", {}, 1, 1),
            ("c3", "placeholder.com", "", "", "", "", "", "", "", t.INFERRED, "", {"entity_type": "provider"}, 2, 2),
            ("c4", "one.com", "", "", "", "", "", "", "", "", "", None, 3, 3),
        ],
        ent,
    )
    lists = lambda *names: "struct<" + ",".join(f"{n}:array<string>" for n in names) + ">"
    fp = f"candidate_id string, evidence_tier string, review_status string, technical {lists('analytics_ids', 'script_domains', 'support_widget_providers')}, content {lists('title_terms', 'footer_phrases', 'provider_mentions')}, flow {lists('cashier_paths')}, ordinal long"
    prints = spark.createDataFrame(
        [
            ("c1", t.FIRST, "", (["ua"], [], []), (["casino"], [], []), (["/cash"],), 0),
            ("orphan", t.SECONDARY, "", ([], ["s"], []), ([], [], []), ([],), 1),
        ],
        fp,
    )
    rels = spark.createDataFrame(
        [
            ("c1", "c2", "promotes", "", "", t.FIRST, "", 0),
            ("c1", "c3", "affiliate", "", "", "", "", 1),
            (None, None, "x", "a.com", "", "", "", 2),
        ],
        "from_candidate_id string, to_candidate_id string, relationship string, from_domain string, to_domain string, evidence_tier string, review_status string, ordinal long",
    ).withColumns({"sources": F.lit("s"), "notes": F.lit("n")})
    clusters = spark.createDataFrame(
        [
            ("cluster-pair.com", ["pair.com", "x.com"], 2, [(["pair.com", "x.com"], "other", "{}")], "inferred", "", 0),
            ("cluster-one.com", ["disc.com", "one.com"], 2, [], "inferred", "", 1),
        ],
        "cluster_id string, members array<string>, member_count int, evidence array<struct<domains:array<string>,reason:string,detail:string>>, evidence_tier string, review_status string, ordinal long",
    )
    ext = f"domain string, source_url string, evidence_tier string, review_status string, legal_policy_urls array<string>, support_help_urls array<string>, contact_emails array<string>, fingerprint struct<technical:{lists('script_domains')},content:{lists('title_terms', 'footer_phrases', 'bonus_terms')},flow:{lists('cashier_paths', 'redemption_paths')}>, ordinal long"
    extracted = spark.createDataFrame(
        [
            (
                "ext.com",
                "https://ext.com",
                t.SECONDARY,
                "",
                ["a", "b"],
                [],
                ["m"],
                ((["s1"],), (["sportsbook", "slots"], [], []), ([], [])),
                0,
            )
        ],
        ext,
    )
    disc = spark.createDataFrame(
        [("Disc.com", ["u1", "u2"], ["a", "b"], 0), ("disc.com", [], [], 1), ("", [], [], 2)],
        "domain string, source_urls array<string>, redirect_chain array<string>, ordinal long",
    )
    return staged, prints, rels, clusters, extracted, disc


def test_queue_and_decisions(spark, normalised):
    staged, prints, rels, clusters, extracted, disc = _review_inputs(spark)
    queue = review.review_queue(
        entities=staged,
        fingerprints=prints,
        relationships=rels,
        extracted=extracted,
        clusters=clusters,
        discovered=disc,
    )
    got = {(r["kind"], r["id"]): r["priority_score"] for r in queue.collect()}
    assert got[("staged_entity", "c1")] == 115 and got[("staged_fingerprint", "c1")] == 105 and got[
        ("staged_relationship", "None->None")
    ] == 18 and got[
        ("extracted_fingerprint", "ext.com")
    ] == 63 and got[("cluster", "cluster-pair.com")] == 20 and got[("discovered_domain", "disc.com")] == 41
    scores = [r["priority_score"] for r in queue.collect()]
    assert scores == sorted(scores, reverse=True)
    seeds_table = spark.createDataFrame(
        [("one.com|www.uno.com/x", ""), ("gone.com", "unknown")],
        "domain string, status string",
    )
    d = review.decisions(
        seeds=seeds_table,
        entities=normalised["entities"],
        staged=staged,
        fingerprints=prints,
        relationships=rels,
        clusters=clusters,
        queue=queue,
        extracted=extracted,
    )
    rows = d.collect()
    d = spark.createDataFrame(rows, d.schema)
    by = {r["record_id"]: r for r in rows}
    c1 = by["c1"]
    assert (
        c1["likely_entity_type"], c1["promotion_recommendation"], c1["cluster_recommendation"],
        c1["block_recommendation"],
    ) == ("operator", "promote_now", "attach_to_existing_cluster", "block_now")
    assert "rule:cluster_attach_shared_legal:o1,o2,o4" in c1[
        "reasoning"
    ] and "rule:multiple_promote_targets:2" in c1["reasoning"] and c1[
        "field_confidence"
    ]["analytics_ids"] == "high" and c1["field_confidence"]["support_widget"] == "low"
    c2 = by["c2"]
    assert (
        c2["cluster_recommendation"], c2["block_recommendation"], c2["promotion_recommendation"],
    ) == ("create_new_cluster_candidate", "block_now", "promote_now")
    assert by["c3"]["likely_entity_type"] == "provider" and by["c3"]["promotion_recommendation"] == "reject_for_now"
    assert by["c4"]["likely_entity_type"] == "operator" and by["c4"][
        "block_recommendation"
    ] == "block_now" and "rule:confirmed_operator_catalog_override_type" in by["c4"]["reasoning"]
    assert by["orphan"]["source_type"] == "fingerprint" and by["orphan"][
        "field_confidence"
    ]["script_domains"] == "medium" and by["orphan"][
        "promotion_recommendation"
    ] == "reject_for_now"
    assert by["c1->c2"]["likely_entity_type"] == "promoter" and by["relationship_0002"][
        "block_recommendation"
    ] == "do_not_block"
    assert by["cluster-one.com"][
        "cluster_recommendation"
    ] == "attach_to_existing_cluster" and by["cluster-one.com"][
        "block_recommendation"
    ] == "block_after_review" and by["cluster-pair.com"]["block_recommendation"] == "do_not_block"
    assert by["queue:discovered_domain:disc.com"]["cluster_recommendation"] == "attach_to_existing_cluster" and by[
        "queue:extracted_fingerprint:ext.com"
    ]["likely_entity_type"] == "operator"
    entries, domains = publish.reviewed_blocklist(d, staged, clusters)
    assert [r[0] for r in domains.collect()] == ["new.com", "one.com", "pair.com"]
    _, more = publish.reviewed_blocklist(d, staged, clusters, include_after_review=True)
    assert {"disc.com", "ext.com"} <= {r[0] for r in more.collect()}
    assert entries.columns == ["record_id", "source_type", "recommendation", "domain"]


def test_hosts_file(spark):
    assert [
        r[0] for r in publish.hosts_lines(spark.createDataFrame([("a.b",)], "domain string")).collect()
    ] == ["0.0.0.0 a.b", "0.0.0.0 www.a.b"]
    assert publish.between_markers("x\n# B\nold\n# E\ny", ["new"], "# B", "# E") == "x\n# B\nnew\n# E\ny\n"
    assert publish.between_markers("x", ["new"], "# B", "# E") == "x\n# B\nnew\n# E\n"
    with pytest.raises(ValueError):
        publish.between_markers("# B\n", [], "# B", "# E")


def test_signing(spark):
    keys = signing.Keys(spark)
    private, public = keys.generate()
    doc = signing.sign_envelope(keys, {"b": 1, "a": "é"}, private, "k1", "T")
    store = lambda **more: signing.TrustStore.parse(
        {
            "schema_version": 1,
            "updated_at": "T",
            "keys": [
                {
                    "key_id": "k1", "algorithm": "ed25519", "public_key_pem": public, "issued_at": "T",
                    "authorized_for": ["art"],
                }
                | more
            ],
        }
    )
    assert signing.verify_envelope(keys, doc, store(), "art") == {"b": 1, "a": "é"}
    assert signing.payload_hash({"b": 1, "a": "é"}) == signing.payload_hash({"a": "é", "b": 1})
    other = keys.generate()[1]
    seal = doc["signature"]
    cases = [
        (doc | {"payload": {"b": 2}}, store(), "art", signing.HashMismatchError),
        (doc, store(revoked_at="T"), "art", signing.RevokedKeyError),
        (doc, store(), "other", signing.UnauthorizedArtifactError),
        (doc, store(key_id="k2"), "art", signing.UntrustedKeyError),
        (doc, store(public_key_pem=other), "art", signing.SignatureVerificationError),
        (doc, store(public_key_pem="junk"), "art", signing.VerificationKeyError),
        ({"payload": {}}, store(), "art", signing.EnvelopeShapeError),
        ({**doc, "signature": seal | {"algorithm": "rsa"}}, store(), "art", signing.EnvelopeShapeError),
        ({**doc, "signature": seal | {"signature_b64": "AAAA"}}, store(), "art", signing.SignatureVerificationError),
    ]
    for envelope, trusted, artifact, error in cases:
        with pytest.raises(error):
            signing.verify_envelope(keys, envelope, trusted, artifact)
    assert signing.opened(
        keys,
        {"x": 1},
        store=None,
        artifact="art",
    ) == {"x": 1} and signing.opened(keys, doc, store=None, artifact="art") == doc["payload"]
    for given in ({"x": 1}, doc):
        with pytest.raises(signing.VerificationError):
            signing.opened(keys, given, store=None, artifact="art", require_signed=True)
    with pytest.raises(signing.TrustStoreError):
        signing.TrustStore.parse({"keys": []})
    with pytest.raises(signing.SigningKeyError):
        keys.sign(b"x", "junk")
    with pytest.raises(signing.CanonicalizationError):
        signing.canonical_bytes({"x": float("nan")})


def test_stream(spark, tmp_path):
    from domscope.streaming.sightings import unknown_sightings

    source = str(tmp_path / "in")
    spark.createDataFrame(
        [
            ("http://a.com/", '<a href="http://known.com">k</a><a href="http://new.com/1">n</a>', "2024-01-01 00:00:00"),
            ("http://a.com/2", '<a href="http://new.com/2">n</a>', "2024-01-01 05:00:00"),
        ],
        "url string, html string, at string",
    ).withColumn("seen_at", F.to_timestamp("at")).drop("at").write.parquet(source)
    pages = spark.readStream.schema("url string, html string, seen_at timestamp").parquet(source)
    out = unknown_sightings(pages, spark.createDataFrame([("known.com",)], "domain string"))
    q = out.writeStream.outputMode("complete").format("memory").queryName("sightings").start()
    q.processAllAvailable()
    q.stop()
    assert [(r["domain"], r["pages"]) for r in spark.table("sightings").collect()] == [("new.com", 2)]
