"""The queries against DuckDB where SQL can express them."""

import builtins
import dis
import importlib
import types

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from lumagrid.llm import oracles, registry
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.01"


def global_names(code):
    """The global names that code and the functions inside it read."""
    yield from (step.argval for step in dis.get_instructions(code) if step.opname == "LOAD_GLOBAL")
    for inner in code.co_consts:
        if isinstance(inner, types.CodeType):
            yield from global_names(inner)


def unknown_names(module):
    with open(module.__file__) as source:
        code = compile(source.read(), module.__file__, "exec")
    return {n for n in global_names(code) if not hasattr(module, n) and not hasattr(builtins, n)}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_operator_has_one_query():
    names = [name for name in registry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert set(oracles.oracle_sql()) <= set(names)
    assert {*names, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", ["jaccard_join", "line_dedup"])
def test_all_names_exist(name):
    assert not unknown_names(importlib.import_module(f"lumagrid.llm.{name}"))


def test_all_names_exist_in_what_the_pipeline_chains(spark):
    modules = [getattr(corpus_pipeline, n) for n in vars(corpus_pipeline)]
    modules = [m for m in modules if isinstance(m, types.ModuleType) and m.__name__.startswith("lumagrid.")]
    assert {m.__name__.rpartition(".")[2] for m in modules} >= {"decontaminate", "jaccard_join", "line_dedup", "packing"}
    assert not {(m.__name__, n) for m in [corpus_pipeline, *modules] for n in unknown_names(m)}
    docs = spark.createDataFrame([(1, "a line of both\none"), (2, "a line of both\ntwo")], "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    lines = stages["line dedup"](spark, docs, SF)
    assert sorted(lines.collect()) == [(1, "a line of both\none"), (2, "two")]
    assert sorted(stages["n-gram Jaccard join"](spark, lines, SF).collect()) == sorted(lines.collect())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert_same(registry.queries()[name](spark, SF), con, oracles.oracle_sql()[name])
