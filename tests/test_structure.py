import ast
import importlib
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CORE = [p for p in (ROOT / "statuteloom").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]


def test_core_does_not_import_the_optional_part():
    for path in CORE:
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [f"{node.module}.{a.name}" for a in node.names] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_entry_without_the_optional_part(monkeypatch):
    for name in [m for m in sys.modules if m == "__spark_entry__" or m.startswith("statuteloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "statuteloom.llm", None)
    entry = importlib.import_module("__spark_entry__")
    assert "p1_found" in entry.queries() and "p2_found" not in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [("norm_text", "documents", {"doc_id", "text"}), ("parse_refs", "mapping_sample", {"row_id", "ipc_section"}), ("status_counts", "map_row", {"bns_section", "status"}), ("citation_density", "documents", {"text", "source"})],
)
def test_scans_read_only_what_is_used(spark, sf_dir, name, table, columns):
    from statuteloom.plans import catalogue

    plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and f"{table}.parquet" in line]
    assert scans
    for line in scans:
        read = line.rsplit("ReadSchema: struct<", 1)[1]
        assert {part.split(":")[0] for part in read.rstrip(">").split(",")} <= columns


def test_hot_side_is_broadcast_only_below_its_bound(spark):
    from statuteloom.session import small_side

    few, many = spark.range(5), spark.range(50)
    assert "LocalTableScan" in small_side(few, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Range" in small_side(many, 10)._jdf.queryExecution().executedPlan().toString()
    assert small_side(few.limit(0), 10).count() == 0
