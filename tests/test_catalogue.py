import pytest

from quern.plans import catalogue
from tests.oracle import database, expected, rows_of


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_matches_sql(spark, tiny, name):
    assert rows_of(catalogue.QUERIES[name](spark, tiny)) == expected(database(tiny), catalogue.SQL[name])


def test_every_query_has_sql():
    assert set(catalogue.SQL) == set(catalogue.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sections_are_normalised_once(spark, tiny):
    # converting and cleaning is one, normalising the other
    assert _plan(catalogue.QUERIES["text_record_path"](spark, tiny)).count("ArrowEvalPython") == 2


@pytest.mark.parametrize("name", ["quality_metrics_han", "normalize_full", "text_record_path"])
def test_han_lines_are_worked_out_once(spark, tiny, name):
    assert _plan(catalogue.QUERIES[name](spark, tiny)).count("translate(") == 1


def test_words_in_one_table_lookup_a_character(spark):
    text = spark.range(1).select(catalogue.F.lit("Ab1 é中\t\r\n\n 2 zZ_\n[`@{ k").alias("text"))
    assert text.select(catalogue._words()).first()[0] == "Ab\nzZ\nk"
    assert "a-z" not in str(catalogue._words())
