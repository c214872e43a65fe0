"""Stages from the command line: python -m domscope STAGE --root FOLDER [options]."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from .plans import signing
from .workspace import Workspace, utc_now

#: Methods of Workspace that take no option of their own.
PLAIN = ("normalize", "affiliations", "monitor", "review-import", "review-queue", "review-rules")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="domscope", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)

    def add(name: str, *options: tuple) -> argparse.ArgumentParser:
        one = stages.add_parser(name)
        one.add_argument("--root", default=".", help="folder with data and reports")
        one.add_argument("--run-time", help="stamp of the documents; now by default")
        one.add_argument("--pages", help="Parquet table of pages that stands for the web")
        for flags, kind in options:
            one.add_argument(flags, **kind)
        return one

    flag, number = {"action": "store_true"}, {"type": int}
    trust = (
        ("--trust-store", {}),
        ("--require-signed", flag),
        ("--expected-key-id", {"default": "scout-fingerprint-key-v1"}),
    )
    for name in PLAIN:
        add(name)
    add("enrich", ("--fetch", flag))
    add("domain-affiliations", ("--fingerprints", {"required": True}), *trust)
    dump = (
        "--dump",
        {"default": "affiliations_dump", "help": "name of the affiliation dump under research_candidates"},
    )
    add("cluster", dump, ("--min-script-overlap", number | {"default": 2}), ("--fingerprints", {}), *trust)
    add(
        "discover",
        ("--max-depth", number | {"default": 1}),
        ("--max-same-host-pages", number | {"default": 12}),
        ("--deny", {}),
        ("--allow", {}),
    )
    add("extract", ("--urls-file", {}), ("--limit", number | {"default": 30}))
    add(
        "fetch", ("--out", {"required": True}), ("--urls-file", {}), ("--timeout", {"type": float, "default": 20}),
        ("--pace", {"type": float, "default": 1.0}), ("--tries", {"type": int, "default": 3}),
    )
    add("import", ("--folder", {}))
    add("stage", ("--input-csv", {"default": "fingerprint_dump"}), dump)
    add("promote", ("--apply-to-seeds", flag))
    add(
        "export",
        ("--snapshot-key", {}),
        ("--snapshot-key-id", {"default": "intel-snapshot-key-v1"}),
        ("--blocklist-key", {}),
        ("--blocklist-key-id", {"default": "intel-blocklist-key-v1"}),
    )
    add("export-reviewed", ("--include-after-review", flag))
    key = stages.add_parser("trust-entry", help="print the trust store's entry of a public key file")
    for name, kind in (
        ("--pem", {"required": True}),
        ("--key-id", {"required": True}),
        ("--authorized-for", {"required": True, "nargs": "+"}),
        ("--issued-at", {}),
    ):
        key.add_argument(name, **kind)
    return top


def run(spark, given: argparse.Namespace) -> int:
    """0 if the stage ran, 2 if it was asked for what it never does."""
    options = dict(vars(given))
    stage = options.pop("stage")
    work = Workspace(spark, options.pop("root"), run_time=options.pop("run_time"), pages=options.pop("pages"))
    refused = options.pop("apply_to_seeds", False)
    if stage in ("cluster", "domain-affiliations"):
        trust = {k: options.pop(k) for k in ("trust_store", "require_signed", "expected_key_id")}
        path = options.pop("fingerprints")
        done = (
            work.cluster(**options, fingerprints=path, **(trust if path else {}))
            if stage == "cluster"
            else work.domain_affiliations(path, **trust)
        )
    else:
        done = getattr(work, {"import": "import_candidates"}.get(stage, stage.replace("-", "_")))(**options)
    for line in done.pop("warnings", []):
        print(f"warning: {line}", file=sys.stderr)
    print(json.dumps(done, sort_keys=True))
    if refused:
        print("error: seeds are never changed by this program; copy the previews after review", file=sys.stderr)
        return 2
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    given = parser().parse_args(argv)
    if given.stage == "trust-entry":
        try:
            entry = signing.trust_entry(given.pem, given.key_id, given.authorized_for, given.issued_at or utc_now())
        except signing.VerificationKeyError as e:
            print(f"error: {e}", file=sys.stderr)
            return 1
        print(json.dumps(entry, indent=2))
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("domscope").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return run(spark, given)


if __name__ == "__main__":
    sys.exit(main())
