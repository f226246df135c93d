"""Cases that only larger or uneven input shows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitewise.operators import gene_filter, resampling, trees
from sitewise.operators.columns import SpeciesIndex, columns_from_sequences
from sitewise.plans import pipeline
from sitewise.sources import alignments


def test_closure_of_a_deep_chain(spark):
    edges = spark.range(1000).select(F.col("id").cast("int").alias("node_id"), F.when(F.col("id") > 0, F.col("id") - 1).cast("int").alias("parent_id"),
                                     F.concat(F.lit("n"), F.col("id")).alias("name"), F.lit(0.5).alias("branch_length"))
    c = trees.closure(edges)
    row = c.agg(F.count("*").alias("n"), F.max("up").alias("up"), F.count_if((F.col("node") - F.col("ancestor") != F.col("up")) | (F.col("dist") != F.col("up") / 2)).alias("bad")).first()
    assert tuple(row) == (1000 * 1001 // 2, 999, 0)


def test_background_meets_every_scheme(spark):
    removed = spark.range(1500).select(F.concat(F.lit("s"), "id").alias("CAAP_Group"), F.lit("g1").alias("Gene"))
    out = gene_filter.cleaned_background(spark.createDataFrame([("g1",), ("g2",)], "Gene string"), removed)
    assert out.count() == 1500 and out.select("Gene").distinct().collect() == [("g2",)]
    assert gene_filter.cleaned_background(spark.createDataFrame([("g1",)], "Gene string"), removed.where("false")).count() == 0


def test_ragged_sequences_raise(spark):
    df = spark.createDataFrame([("g", "a", "A" * 130), ("g", "b", "C" * 64), ("h", "a", "AA"), ("h", "b", "DD")], "gene string, species string, seq string")
    index = SpeciesIndex.of(df)
    assert columns_from_sequences(df.where("gene = 'h'"), index).count() == 2
    with pytest.raises(PySparkException, match="unequal length"):
        columns_from_sequences(df, index).collect()


def test_maf_pads_absent_sources(spark):
    text = "##maf version=1\na score=1\ns x.1 0 3 + 9 ACD\ns y.1 0 3 + 9 ACE\n\na score=2\ns x.1 3 2 + 9 GG\n\na score=3\ns x.1 5 2 + 9 KL\ns y.1 3 2 + 9 KM\n"
    got = alignments.parse(spark.createDataFrame([("g", text)], "gene string, text string"), "maf").collect()
    assert {r["species"]: r["seq"] for r in got} == {"x.1": "ACDGGKL", "y.1": "ACE--KM"}


def test_last_record_of_a_name(spark):
    got = alignments.parse(spark.createDataFrame([("g", ">x\nAAA\n>x\nCCC\n")], "gene string, text string"), "fasta").collect()
    assert [r["seq"] for r in got] == ["CCC"]


def test_short_draws_and_unknown_strategies_raise(spark):
    species = spark.createDataFrame([("a",), ("b",), ("c",)], "species string")
    with pytest.raises(ValueError, match="asked of 3"):
        resampling.random_labels(resampling.cycles(spark, 2), species, 2, 3)
    config = spark.createDataFrame([("t", "a", 1, "1"), ("t", "b", 0, "1")], "trait string, species string, grp int, pair string")
    inputs = pipeline.Inputs(species.withColumn("gene", F.lit("g")).withColumn("seq", F.lit("A")), config, families=spark.createDataFrame([("a", "f"), ("c", "f"), ("b", "h")], "species string, family string"))
    with pytest.raises(ValueError, match="unknown"):
        pipeline.resample_stage(inputs, config, pipeline.Settings(cycles=2, resample_strategy="clade"))
    drawn = pipeline.resample_stage(inputs, config, pipeline.Settings(cycles=4, resample_strategy="family", include_b0=False)).collect()
    assert len(drawn) == 4 and all(r["fg"][0] in ("a", "c") and r["bg"] == ["b"] for r in drawn)
