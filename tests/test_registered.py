"""Every registered query with SQL, run at the smallest scale and compared with it; no name is missing anywhere.

``VELA_ALL_QUERIES=1`` runs the queries without SQL too (fits and iterative models, about half an hour)."""
import builtins
import datetime
import importlib
import math
import os
import pkgutil
import types

import duckdb
import pytest

import vela
from vela.plans.checks import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def modules():
    """The library without the training-data part."""
    return [m.name for m in pkgutil.walk_packages(vela.__path__, "vela.") if not m.name.startswith("vela.llm")]


def globals_of(code):
    """Names that a code object and those inside it read as globals."""
    import dis
    for i in dis.get_instructions(code):
        if i.opname == "LOAD_GLOBAL":
            yield i.argval
    for c in code.co_consts:
        if isinstance(c, types.CodeType):
            yield from globals_of(c)


@pytest.mark.parametrize("name", modules())
def test_no_undefined_names(name):
    module = importlib.import_module(name)
    with open(module.__file__) as f:
        code = compile(f.read(), module.__file__, "exec")
    missing = {n for n in globals_of(code) if not hasattr(module, n) and not hasattr(builtins, n)}
    assert not missing


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("VELA_ALL_QUERIES") else sorted(ORACLES))
def test_registered_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, df.collect())
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        assert got == canonical([d[0] for d in cur.description], cur.fetchall())
