"""Result store by gene, and the flat master table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of the master table before the columns of pairs, in this order (fixed values).
MASTER = ("gene msa_pos tag caas is_significant pvalue pvalue_boot pattern_type caap_group amino_encoded is_conserved_meta conserved_pair sig_hyp sig_perm sig_both "
          "change_top change_bottom change_side parallel_top parallel_bottom parallel_type low_confidence_nodes asr_is_conserved asr_root_conserved comments "
          "all_mrca_state all_mrca_posterior all_mrca_node").split()
PAIR = ("node", "state", "posterior")


class ResultStore:
    """Rows by gene and position in a folder of parquet buckets.

    A gene lies in one bucket, a folder chosen by its hash, sorted by gene and position.
    Writing a gene replaces all its rows, so writing again changes nothing; of other genes
    only those that share a bucket are written anew, and a bucket is replaced as a whole when
    the job commits.  Lookups read one bucket, and in it the row groups that may hold the row.
    The number of buckets belongs to the store and must not change.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, gene: str = "gene", position: str = "site"):
        self.spark, self.path, self.buckets, self.gene, self.position = spark, path, buckets, gene, position

    def _bucket(self, gene: Column) -> Column:
        return F.pmod(F.xxhash64(gene), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def put(self, rows: DataFrame) -> None:
        """Replace all rows of the genes in ``rows``; columns that older rows lack are null there.  Rows of a null gene are a gene's.

        An empty table writes nothing.
        """
        rows = rows.withColumn("bucket", self._bucket(F.col(self.gene)))
        if self.exists():
            touched = rows.select("bucket").distinct()
            genes = rows.select(F.col(self.gene).alias("_gene"), F.lit(True).alias("_new")).distinct()
            old = self.read(True).join(touched, "bucket", "left_semi")
            old = old.join(genes, F.col(self.gene).eqNullSafe(F.col("_gene")), "left_anti")
            rows = old.unionByName(rows, allowMissingColumns=True)
        out = rows.repartition("bucket").sortWithinPartitions("bucket", self.gene, self.position)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def read(self, bucket: bool = False) -> DataFrame:
        df = self.spark.read.option("mergeSchema", True).parquet(self.path)
        return df if bucket else df.drop("bucket")

    def lookup(self, gene: str, position: int | None = None) -> DataFrame:
        """Rows of a gene, or of a position in it, from its bucket alone."""
        number = self.spark.range(1).select(self._bucket(F.lit(gene))).first()[0]
        rows = self.read(True).where((F.col("bucket") == number) & (F.col(self.gene) == gene)).drop("bucket")
        return rows if position is None else rows.where(F.col(self.position) == position)


def cell(c: Column, kind: str) -> Column:
    """A value as flat text: lists by commas, truth values as words, empty for null, other nested values as JSON."""
    if kind == "boolean":
        text = F.when(c, "True").otherwise("False")
    elif kind.startswith("array<") and not kind.startswith(("array<struct", "array<array", "array<map")):
        text = F.array_join(F.transform(c, lambda x: x.cast("string")), ",", "None")
    elif kind.startswith(("array", "struct", "map")):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return F.when(c.isNull(), "").otherwise(text)


def master_table(sites: DataFrame, pairs: DataFrame, least: int = 1) -> DataFrame:
    """The master table as text: the fields of ``MASTER``, then node, state and posterior of each pair.

    ``sites`` has ``gene``, ``msa_pos`` and any other of the fields; absent ones are empty.
    ``pairs`` is ``gene, msa_pos, pair_id, node, state, posterior``; of repeated pairs one row
    counts.  The largest pair id, at least ``least``, says how many columns there are: one
    number that an aggregate brings to the driver.  A site's pairs become one map, from which
    every cell is taken, so each table is grouped once however many pairs there are.  Sites
    without pairs have empty cells, pairs without a site no row.
    """
    n = max(least, pairs.agg(F.max("pair_id")).first()[0] or 0)
    entry = F.struct(F.col("pair_id").alias("key"), F.struct(*PAIR).alias("value"))
    per = pairs.where("pair_id IS NOT NULL").groupBy("gene", "msa_pos", "pair_id").agg(*[F.max_by(F.col(c), F.struct(*PAIR)).alias(c) for c in PAIR])
    per = per.groupBy("gene", "msa_pos").agg(F.map_from_entries(F.collect_list(entry)).alias("_pairs"))  # a row for each pair of a site
    kinds, known = dict(sites.dtypes), dict(pairs.dtypes)
    rows = sites.join(per, ["gene", "msa_pos"], "left")
    at = lambda k: F.try_element_at("_pairs", F.lit(k).cast(known["pair_id"]))
    fixed = [cell(F.col(c), kinds[c]).alias(c) if c in kinds else F.lit("").alias(c) for c in MASTER]
    return rows.select(*fixed, *[cell(at(k)[c], known[c]).alias(f"mrca_{k}_{c}") for k in range(1, n + 1) for c in PAIR])


def write_master(table: DataFrame, path: str) -> None:
    """Comma-separated with a header, also without rows."""
    table.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
