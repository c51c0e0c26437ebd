"""Checks over sets of files and rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inventory(files: DataFrame, expected: int, names: int = 3) -> DataFrame:
    """split, n, ok, first and last names of files (split, file_name): a report of fixed length."""
    return files.groupBy("split").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set("file_name")), 1, names).alias("first_names")).withColumn("ok", F.col("n") == expected)


def manifest_checks(cases: DataFrame, old: str, gold: str) -> DataFrame:
    """id, check, text, ok for every text that a case asks for in the old and gold page."""
    wanted = [("old_contains", old, True), ("gold_not_contains", gold, False), ("required_texts", gold, True)]
    rows = None
    for column, html, there in wanted:
        if column in cases.columns:
            part = cases.select("id", F.lit(column).alias("check"), F.explode(column).alias("text")).withColumn("ok", F.contains(F.lit(html), F.col("text")) == F.lit(there))
            rows = part if rows is None else rows.unionByName(part)
    return rows


def rule_table_checks(rules: DataFrame, contracts: DataFrame, expected: int = 16) -> DataFrame:
    """One row: number of rules, repeated ids, contracts that do not parse, verdict."""
    repeated = rules.groupBy("id").count().where("count > 1").agg(F.count("*").alias("repeated"))
    broken = contracts.agg(F.sum((~F.col("parses")).cast("long")).alias("broken"))
    return rules.agg(F.count("*").alias("n")).crossJoin(repeated).crossJoin(broken).withColumn("ok", (F.col("n") == expected) & (F.col("repeated") == 0) & (F.col("broken") == 0))
