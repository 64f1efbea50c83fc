"""Builders as SQL functions: both forms give the same, quotes and all."""

import datetime as dt
from itertools import product

import pytest
from pyspark.sql import functions as F

from footlights.functions import sql
from footlights.operators import pages, sql_surface

TEXTS = ["Der Nußknacker (Ballet)", "Nussknacker", "it's a \\ \"test\"", "", None, "on tour", "Æon — x", "Jane Doe, John Roe & others", "https://www.Example.com/en/a%20b/?b=2&a=1&utm_source=x", "unsure 2026-01-02 x", "19:30", "Dance company", "Editor"]
VALUES = {"string": TEXTS, "int": [0, 1, None], "boolean": [True, False, None], "date": [dt.date(2026, 1, 10), None], "timestamp": [dt.datetime(2026, 1, 1, 19, 30, 5), None]}


@pytest.fixture(scope="module")
def own(spark):
    found = spark.newSession()
    sql_surface.create_scalar_functions(found)
    return found


@pytest.mark.parametrize("name", sorted(sql_surface.SCALAR))
def test_function_equals_builder(own, name):
    arguments, returns, build = sql_surface.SCALAR[name]
    fields = [a.split() for a in arguments.split(",")]
    rows = list(product(*[VALUES[t] for _, t in fields]))
    df = own.createDataFrame(rows, arguments)
    df.createOrReplaceTempView(f"given_{name}")
    names = ", ".join(n for n, _ in fields)
    got = own.sql(f"select {name}({names}) as r from given_{name}").collect()
    want = df.select(build(*[F.col(n) for n, _ in fields]).cast(returns).alias("r")).collect()
    assert got == want and len({str(r) for r in want}) > 1


def test_operators_and_quotes(own):
    c = F.when((F.col("a") - 1 > 2) & ~(F.col("a") == 9), F.concat(F.lit("-(=(it's \\"), F.col("b"), F.lit("')"))).otherwise(F.lit("or(1)"))
    df = own.createDataFrame([(4, "x"), (9, "y"), (1, "z")], "a int, b string")
    df.createOrReplaceTempView("quoted")
    assert own.sql(f"select {sql.sql_of(c)} as r from quoted").collect() == df.select(c.alias("r")).collect()


def test_body_is_seen_by_the_optimiser(own, tmp_path):
    """A function in a filter runs inside generated code and reads its own columns only."""
    own.createDataFrame([("a", "b", "c")], "t string, u string, v string").write.parquet(str(tmp_path / "t"))
    own.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("stored")
    plan = own.sql("select t from stored where slugify(t) = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<t:string>" in plan and "Python" not in plan


def test_events_at_any_depth(spark):
    """Fifty levels, lists in lists, broken blocks; the order of keys does not matter."""
    deep = '{"@type": "Event", "name": "end"}'
    for k in range(50):
        deep = f'{{"item": [[{deep}, 3, null, "x"]]}}' if k % 2 else f'{{"@type": ["Thing", "Festival"], "event": {deep}}}'
    block = '<script type="application/ld+json">{}</script>'
    rows = [(1, block.format(deep)), (2, block.format("{broken") + block.format('[{"@type": "Event"}]')), (3, ""), (4, None), (5, block.format('{"@type": 7, "item": null}'))]
    got = pages.extract_events(spark.createDataFrame(rows, "page_id int, html string")).collect()
    assert sum(r.page_id == 1 for r in got) == 26
    assert [(r.block, r.path) for r in got if r.page_id == 2] == [(1, "$[0]")]
    assert {r.page_id for r in got} == {1, 2}
    assert max((r.path for r in got), key=len).count(".item[0][0]") == 25
    assert pages.extract_events(spark.createDataFrame([], "page_id int, html string")).count() == 0
