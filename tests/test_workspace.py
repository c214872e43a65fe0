"""The stages over a folder, from the command line's options to the documents."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from domscope import __main__ as cli
from domscope import workspace
from domscope.plans import signing
from domscope.sources import documents
from domscope.workspace import OPERATORS, PARTIAL, Workspace

SEEDS = {
    "operators": 'id,name,domain,categories,status,confidence,legal_entity,jurisdictions,provider_names,notes,sources\nop1,One,www.one.example,a|b,active,0.9,Acme Ltd,US,Studio X,"n, ""q""",s\nop2,Two,two.example,,active,0.8,ACME  LTD,,,,\nop3,Off,off.example,,inactive,0.8,,,,,\nop4,Same,one.example,,active,0.5,,,,,\n',
    "promoters": "id,name,domain,promoter_type,status,confidence,promotes_categories,notes,sources\npr1,Review,best-review.example,list,active,0.5,x,,\n",
    "providers": "id,name,domain,provider_type,status,confidence,blockable,notes,sources\npv1,Studio X,studio.example,slots,active,0.9,true,,\n",
    "payment_paths": "id,name,domain_or_pattern,payment_type,status,confidence,notes,sources\npy1,Pay,/pay pay.example,card,active,0.7,,\n",
    "relationships": "from_id,to_id,relationship,confidence,source,evidence_url,evidence_text\nop1,pv1,uses_provider,0.8,,,\nop1,gone,x,0.8,,,\n",
    "fingerprints_partial": "entity_id,script_domains,cashier_paths\nop1,CDN.example,/Pay\nop2,cdn.example,/pay\n",
}
RESEARCH = (
    "domain,brand,legal_entity,parent_company,notes,sources,cashier_path\nnew.example,New,Acme Ltd,Group A,official site of a casino,a|b,/pay\nother.example,Other,,Group A,not verified,c,\n,,,,,,\n,Only Brand,,,nothing,,\n"
)
IMPORT = "primary_domain,name,notes,confidence,duplicate_group_id,other_domains\nc1.example,C1,official site,high,g1,\nc2.example,C2,,0.7,g1,x.example\n"
PAGES = [
    (
        "https://best-review.example/",
        '<a href="https://one.example/x">a</a><a href="https://lucky-casino.example/">b</a><a href="/next">n</a><script src="https://cdn.example/a.js"></script>',
    ),
    (
        "https://best-review.example/next",
        '<a href="https://two.example/">c</a><title>Bonus Guide</title><footer>Run by somebody with care</footer>',
    ),
    ("https://one.example/", "<title>One Casino</title><script src='//cdn2.example/x'></script>"),
]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("work")
    for folder, tables in (
        ("seeds", SEEDS),
        ("research_candidates", {"fingerprint_dump": RESEARCH}),
        ("research_candidates/scout_import", {"operators_candidates": IMPORT}),
    ):
        (d / "data" / folder).mkdir(parents=True)
        for name, text in tables.items():
            (d / "data" / folder / f"{name}.csv").write_text(text, encoding="utf-8")
    (d / "data/seeds/seed_urls.txt").write_text("# seeds\nhttps://best-review.example/\n\n", encoding="utf-8")
    (d / "data/research_candidates/affiliations_dump.json").write_text(
        json.dumps(
            [
                {"left": "NEW.example", "right": "other.example"},
                {"from_domain": "new.example", "to_domain": "none.example", "confidence": 0.9},
            ]
        ),
        encoding="utf-8",
    )
    spark.createDataFrame(PAGES, "url string, html string").write.parquet(str(d / "pages"))
    return d


def _run(spark, root, *argv):
    return cli.run(
        spark,
        cli.parser().parse_args(
            [
                argv[0], "--root", str(root), "--run-time", "2026-01-02T03:04:05Z", "--pages", str(root / "pages"),
                *argv[1:],
            ]
        ),
    )


def _read(root, name):
    return json.loads((root / "data" / f"{name}.json").read_text(encoding="utf-8"))


def test_chain(spark, root, capsys):
    """Every stage in order, each from the documents of those before."""
    assert _run(spark, root, "normalize") == 0
    said = capsys.readouterr()
    assert "one.example belongs to operator:op1, operator:op4" in said.err and "unknown to_id: gone" in said.err and json.loads(
        said.out
    )[
        "entities"
    ] == 7
    ents = _read(root, "normalized/entities")
    assert [e["id"] for e in ents] == [
        "op1", "op2", "op3", "op4", "pr1", "pv1", "py1",
    ] and ents[0]["notes"] == 'n, "q"' and "promoter_type" not in ents[0][
        "attributes"
    ] and ents[0]["first_seen"] == "2026-01-02T03:04:05Z"
    for stage in (
        ["enrich", "--fetch"],
        ["affiliations"],
        ["export"],
        ["monitor"],
        ["discover"],
        ["extract", "--limit", "5"],
        ["import"],
        ["review-import"],
        ["stage"],
        ["cluster"],
        ["review-queue"],
        ["review-rules"],
        ["export-reviewed", "--include-after-review"],
        ["promote"],
    ):
        assert _run(spark, root, *stage) == 0, stage
    prints = {f["entity_id"]: f for f in _read(root, "normalized/fingerprints")}
    assert prints["op1"]["technical"]["script_domains"] == [
        "cdn.example", "cdn2.example",
    ] and prints["op2"]["flow"]["cashier_paths"] == ["/pay"]
    pair = _read(root, "normalized/affiliations")[0]
    assert (pair["left_id"], pair["right_id"], pair["score"], pair["label"]) == ("op1", "op2", 75, "strong_affiliation")
    block = _read(root, "published/block_candidates")
    assert block["domains"] == ["one.example", "studio.example", "two.example"] and [
        r["entity_id"] for r in block["source_entities"]
    ] == ["op1", "op2", "op4", "pv1"]
    assert _read(root, "published/intel_snapshot")["affiliations"][0] == pair
    assert [r["domain"] for r in _read(root, "candidates/operators_candidates")] == ["lucky-casino.example"]
    assert _read(root, "candidates/relationships_suggested")[0]["relationship"] == "promotes"
    assert {r["domain"] for r in _read(root, "candidates/discovered_domains")} == {
        "best-review.example", "one.example", "two.example", "lucky-casino.example",
    }
    assert {
        r["domain"] for r in _read(root, "research_candidates/extracted_fingerprints")["fingerprints"]
    } == {"best-review.example", "one.example"}
    staged = _read(root, "research_candidates/staged_from_scout/promotion_review_summary")
    assert staged["counts"]["duplicate_edges"] == 1 and staged[
        "duplicate_group_ids"
    ] == ["g1"] and staged["counts"]["by_hint"] == {"operator": 2}
    research = _read(root, "research_candidates/staged_entities")["entities"]
    assert [e["candidate_id"] for e in research] == ["research_0001", "research_0002", "research_0004"]
    edges = _read(root, "research_candidates/staged_relationships")["relationships"]
    assert [(e["from_candidate_id"], e["to_candidate_id"]) for e in edges] == [
        ("research_0001", "research_0002"),
        ("research_0001", "research_0002"),
        ("research_0001", None),
    ] and edges[1]["resolution_status"] == "resolved" and edges[2]["confidence"] == 0.9
    groups = _read(root, "research_candidates/staged_clusters")["clusters"]
    assert any({"one.example", "two.example", "new.example", "other.example"} <= set(g["members"]) for g in groups)
    queue = _read(root, "research_candidates/review_queue")
    scores = [i["priority_score"] for i in queue["items"]]
    assert queue["item_count"] == len(scores) and scores == sorted(scores, reverse=True)
    decisions = _read(root, "research_candidates/review_decisions")
    assert decisions["decision_count"] == len(decisions["decisions"]) > 5
    listed = _read(root, "published/reviewed_blocklist")
    lines = (root / "data/published/reviewed_domains.txt").read_text(encoding="utf-8").splitlines()
    assert lines[0].startswith("# Generated") and lines[1:] == listed["domains"] and listed["domain_count"] == len(
        listed["domains"]
    ) > 0
    for folder in ("enrichment", "monthly/2026-01", "discovery", "extraction", "clusters", "review_rules"):
        [report] = list((root / "reports" / folder).iterdir())
        assert json.loads(report.read_text(encoding="utf-8"))["generated_at"] == "2026-01-02T03:04:05Z"


def test_documents_are_those_expected(root):
    """Byte for byte; the expected documents were written by json.dumps and csv on the driver."""
    golden = Path(__file__).parent / "golden"
    names = [p.relative_to(golden) for p in golden.rglob("*") if p.is_file()]
    assert len(names) > 25
    for name in names:
        assert (root / name).read_bytes() == (golden / name).read_bytes(), name


def test_pages_are_parsed_once_and_nothing_is_collected(spark, root, monkeypatch):
    """Documents of a run are written from its tables; those of crawled pages from one table that holds them parsed."""
    plans = []
    write = documents._json_lines

    def seen(rows, table, *args):
        plans.append(table._jdf.queryExecution().optimizedPlan().toString())
        return write(rows, table, *args)

    monkeypatch.setattr(documents, "_json_lines", seen)
    monkeypatch.setattr(workspace, "rows_of", None)
    for stage in ("monitor", "extract", "affiliations", "export", "discover", "cluster", "review-queue"):
        assert _run(spark, root, stage) == 0
        if stage in ("monitor", "extract"):
            assert plans and not any("html#" in p for p in plans)
        plans.clear()


def test_a_failed_document_leaves_the_one_before(spark, tmp_path):
    path = str(tmp_path / "sub" / "d.json")
    documents.json_document(spark, path, {"a": 1})
    bad = documents.Rows(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")))
    with pytest.raises(Exception, match="no"):
        documents.json_document(spark, path, {"a": bad})
    assert [p.name for p in (tmp_path / "sub").iterdir()] == ["d.json"]
    assert json.loads((tmp_path / "sub" / "d.json").read_text()) == {"a": 1}


def test_documents_of_many_parts(spark, tmp_path):
    """Order, nesting, chained and empty tables, key order and counts, against json and csv."""
    table = spark.createDataFrame(
        [(i, f"n\n{i}é,\"", [1.5, 2.0], {"b": "x", "a": None}, '{"z": [1, {}], "a": 2}', (1, None)) for i in range(50)],
        "id int, name string, v array<double>, m map<string,string>, j string, s struct<x:int,y:string>",
    ).repartition(7)
    plain = [
        {"id": i, "name": f"n\n{i}é,\"", "v": [1.5, 2.0], "m": {"b": "x", "a": None}, "j": {"z": [1, {}], "a": 2}, "s": {"x": 1}}
        for i in range(50)
    ]
    rows = lambda df, **more: documents.Rows(df, order=["id"], sparse=["s"], parsed=["j"], **more)
    one = rows(table, metrics={"big": F.count_if(F.col("id") > 10)})
    value = {"z": {"rows": one, "none": rows(table.limit(0))}, "a": [1, {"k": []}], "e": {}, "n": lambda: one.counts["rows"]}
    value["two"] = [rows(table.where("id < 3")), rows(table.limit(0)), rows(table.where("id >= 48"))]
    value["ids"] = documents.Rows(table.select("id"), order=["id"], only="id")
    documents.json_document(spark, str(tmp_path / "d.json"), value)
    want = {"z": {"rows": plain, "none": []}, "a": [1, {"k": []}], "e": {}, "n": 50, "two": plain[:3] + plain[48:], "ids": [*range(50)]}
    assert (tmp_path / "d.json").read_text(encoding="utf-8") == json.dumps(want, indent=2, sort_keys=True) + "\n"
    assert one.counts == {"rows": 50, "big": 39} and rows(table.where("id = 1")).collected() == [plain[1]]
    unsorted = {"z": 1, "a": documents.Rows(table.select("name", "id").where("id = 1"))}
    documents.json_document(spark, str(tmp_path / "u.json"), unsorted, sort_keys=False)
    want = json.dumps({"z": 1, "a": [{"name": plain[1]["name"], "id": 1}]}, indent=2) + "\n"
    assert (tmp_path / "u.json").read_text(encoding="utf-8") == want
    documents.csv_document(spark, str(tmp_path / "d.csv"), documents.Rows(table, order=["id"]), ["name", "gone", "id"])
    with open(tmp_path / "d.csv", newline="", encoding="utf-8") as f:
        assert list(csv.DictReader(f)) == [{"name": r["name"], "gone": "", "id": str(r["id"])} for r in plain]


def test_promotion(spark, root):
    """Approved rows are previewed under fixed headers; seeds are never changed."""
    doc = _read(root, "research_candidates/staged_entities")
    doc["entities"][0]["review_status"] = "approved"
    (root / "data/research_candidates/staged_entities.json").write_text(json.dumps(doc), encoding="utf-8")
    before = (root / "data/seeds/operators.csv").read_text(encoding="utf-8")
    assert _run(spark, root, "promote", "--apply-to-seeds") == 2
    assert (root / "data/seeds/operators.csv").read_text(encoding="utf-8") == before
    rows = (
        root / "data/research_candidates/promotion_preview/proposed_operators.csv"
    ).read_text(encoding="utf-8").splitlines()
    assert rows[0] == ",".join(OPERATORS) and rows[1].startswith(
        "operator_new_example,New,new.example,,inactive,0.85,Acme Ltd"
    )
    prints = (
        root / "data/research_candidates/promotion_preview/proposed_fingerprints_partial.csv"
    ).read_text(encoding="utf-8").splitlines()
    assert prints[0] == ",".join(PARTIAL) and prints[1].startswith("operator_new_example,")


def test_signed_documents(spark, root, tmp_path, caplog):
    """Signed lists, and fingerprints that are signed, unsigned, tampered with or missing."""
    keys = signing.Keys(spark)
    private, public = keys.generate()
    for name, text in (("private.pem", private), ("public.pem", public)):
        (tmp_path / name).write_text(text, encoding="utf-8")
    work = Workspace(spark, root, run_time="2026-01-02T03:04:05Z")
    entry = signing.trust_entry(
        tmp_path / "public.pem",
        "k1",
        ["intel_block_candidates", "domain_fingerprints"],
        "2026-01-01T00:00:00Z",
    )
    (tmp_path / "store.json").write_text(
        json.dumps({"schema_version": 1, "updated_at": "t", "keys": [entry]}),
        encoding="utf-8",
    )
    store = signing.load_trust_store(tmp_path / "store.json")
    work.export(blocklist_key=str(tmp_path / "private.pem"), blocklist_key_id="k1")
    signed = _read(root, "published/block_candidates")
    assert signing.verify_envelope(keys, signed, store, "intel_block_candidates")["domains"] == [
        "one.example", "studio.example", "two.example",
    ]
    with pytest.raises(signing.SigningKeyError):
        work.export(snapshot_key=str(tmp_path / "none.pem"))

    records = {
        "one.example": {"sans": ["two.example"], "dns": {"nameservers": ["ns1.host.example"]}},
        "two.example": {"san": "one.example"},
        "bad": 3,
    }
    path = tmp_path / "prints.json"
    path.write_text(json.dumps(records), encoding="utf-8")
    assert {r["domain"] for r in work.domain_fingerprints(str(path)).collect()} == {"one.example", "two.example"}
    assert _run(spark, root, "domain-affiliations", "--fingerprints", str(path)) == 0
    assert [(r["left"], r["score"]) for r in _read(root, "normalized/domain_affiliations")] == [("one.example", 15)]
    assert _run(spark, root, "cluster", "--fingerprints", str(path)) == 0
    with pytest.raises(signing.EnvelopeShapeError):
        work.domain_fingerprints(str(path), require_signed=True)
    sealed = signing.sign_envelope(
        keys,
        {"artifact_type": "domain_fingerprints", "fingerprints": records},
        private,
        "k1",
        "t",
    )
    path.write_text(json.dumps(sealed), encoding="utf-8")
    trust = {"trust_store": str(tmp_path / "store.json"), "expected_key_id": "k1"}
    assert work.domain_fingerprints(str(path), require_signed=True, **trust).count() == 2
    with pytest.raises(signing.SignatureVerificationError, match="not by"):
        work.domain_fingerprints(str(path))
    assert work.domain_fingerprints(str(path), expected_key_id="k1").count() == 2 and "not checked" in caplog.text
    with pytest.raises(signing.VerificationKeyError):
        work.domain_fingerprints(str(path), expected_key_id="k1", require_signed=True)
    sealed["payload"]["fingerprints"]["three.example"] = {}
    path.write_text(json.dumps(sealed), encoding="utf-8")
    with pytest.raises(signing.HashMismatchError):
        work.domain_fingerprints(str(path), **trust)
    sealed["signature"]["key_id"] = " "
    path.write_text(json.dumps(sealed), encoding="utf-8")
    with pytest.raises(signing.EnvelopeShapeError):
        work.domain_fingerprints(str(path), **trust)
    for text in ("[1]", "{", None):
        if text is None:
            path.unlink()
        else:
            path.write_text(text, encoding="utf-8")
        assert work.domain_fingerprints(str(path)).count() == 0
    for text in ("{", "[]", '{"keys": []}'):
        (tmp_path / "store.json").write_text(text, encoding="utf-8")
        with pytest.raises(signing.TrustStoreError):
            signing.load_trust_store(tmp_path / "store.json")


def test_trust_entry(spark, tmp_path, capsys):
    _, public = signing.Keys(spark).generate()
    (tmp_path / "p.pem").write_text(public, encoding="utf-8")
    assert cli.main(
        [
            "trust-entry", "--pem", str(tmp_path / "p.pem"), "--key-id", "k", "--authorized-for", "a", "b",
            "--issued-at", "t",
        ]
    ) == 0
    entry = json.loads(capsys.readouterr().out)
    assert entry == {
        "key_id": "k", "algorithm": "ed25519", "public_key_pem": public, "issued_at": "t", "authorized_for": ["a", "b"],
        "revoked_at": None, "revocation_reason": None,
    }
    (tmp_path / "p.pem").write_text("no key", encoding="utf-8")
    assert cli.main(["trust-entry", "--pem", str(tmp_path / "p.pem"), "--key-id", "k", "--authorized-for", "a"]) == 1
    assert cli.main(["trust-entry", "--pem", str(tmp_path / "none"), "--key-id", "k", "--authorized-for", "a"]) == 1
