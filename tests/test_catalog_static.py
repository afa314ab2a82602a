"""Static guard: every module attribute the catalog uses exists (no Spark needed)."""

import ast
import importlib
import pathlib

import pytest

CATALOG = pathlib.Path(__file__).resolve().parents[1] / "barlake" / "catalog"


def _aliases(tree: ast.Module, package: str) -> dict[str, str]:
    """alias -> absolute module for ``from ..x import y as Z`` / ``from ..x import y``."""
    out = {}
    for node in ast.walk(tree):
        if isinstance(node, ast.ImportFrom) and node.level:
            base = package.rsplit(".", node.level - 1)[0] if node.level > 1 else package
            mod = f"{base}.{node.module}" if node.module else base
            for a in node.names:
                full = f"{mod}.{a.name}"
                try:
                    importlib.import_module(full)
                except ImportError:
                    continue
                out[a.asname or a.name] = full
    return out


@pytest.mark.parametrize("path", sorted(CATALOG.glob("*_queries.py")), ids=lambda p: p.name)
def test_catalog_references_exist(path):
    tree = ast.parse(path.read_text())
    aliases = _aliases(tree, "barlake.catalog")
    missing = []
    for node in ast.walk(tree):
        if isinstance(node, ast.Attribute) and isinstance(node.value, ast.Name) and node.value.id in aliases:
            mod = importlib.import_module(aliases[node.value.id])
            if not hasattr(mod, node.attr):
                missing.append(f"{node.value.id}.{node.attr}")
    assert not missing, missing


def test_every_key_registered_once():
    import __spark_entry__ as E
    q = E.queries()
    assert len(q) == len(set(q)) and set(E.oracle_sql()) <= set(q)
