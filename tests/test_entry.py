"""The driver contract."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(f) for f in entry.queries().values())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["left", "right", "n_shared", "value", "score", "label"] and df.count() > 0


def test_without_the_optional_part(tmp_path):
    """The entry imports and offers the other queries if the optional subpackage is gone."""
    for p in ROOT.iterdir():
        if p.name in ("domscope", "__spark_entry__.py"):
            (tmp_path / p.name).symlink_to(p) if p.is_file() else (tmp_path / p.name).mkdir()
    for p in (ROOT / "domscope").iterdir():
        if p.name != "llm":
            (tmp_path / "domscope" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'host_link_overlap' in q and 'pipeline' not in q and not any(x.startswith('op') for x in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True)
