"""Texts of a large group of near copies are never dealt by their group."""

import re

from helpers import table
from sitewise.llm import simhash as H
from test_near_copies import planted


def test_texts_are_not_dealt_by_group(spark, monkeypatch):
    plans = []
    real = H.checkpoint
    monkeypatch.setattr(H, "checkpoint", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    monkeypatch.setattr(H, "MEMBERS", 8)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        H.near_copies(table(spark, planted()[80:])).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    across = [p for p in plans if "_across" in p]
    assert across and not [p for p in across if re.search(r"hashpartitioning\(comp#\d+L?, \d+\)", p)]
