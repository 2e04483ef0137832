"""Fingerprints run in the JVM only; documents are shuffled once where blocks are used."""

import re

from turnloom.llm import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fingerprints_use_no_python(spark, sf_dir):
    assert not re.search("Python|Pandas|Arrow", plan(queries.op8_imatch(spark, sf_dir)))


def test_blocks_read_the_text_once(spark, sf_dir):
    df = queries.op5_substring_dedup(spark, sf_dir)
    df.collect()
    final = plan(df)
    assert final.split("Initial Plan")[0].count("ReusedExchange") >= 2
