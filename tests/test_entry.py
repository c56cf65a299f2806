"""The driver's contract."""

import ast
import inspect

import __spark_entry__
from quizmill.plans.oracles import ORACLES
from quizmill.plans.queries import QUERIES


def test_names():
    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(QUERIES) <= set(found) and set(ORACLES) <= set(sql) <= set(found)
    assert set(QUERIES) == set(ORACLES)  # all of the library's own queries have SQL


def test_no_module_imports_the_optional_subpackage():
    """The library works without it: only the entry module knows it."""
    import pkgutil

    import quizmill

    for m in pkgutil.walk_packages(quizmill.__path__, "quizmill."):
        if m.name.startswith("quizmill.llm"):
            continue
        tree = ast.parse(inspect.getsource(__import__(m.name, fromlist=["_"])))
        names = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)] + [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
        assert not any("llm" in x.split(".") for x in names), m.name


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() == 12
