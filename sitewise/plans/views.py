"""Domain views over the driver tables.

Each view is one SQL text that Spark and DuckDB both understand; ``{name}`` marks a
table or another view.  ``spark_view`` binds them to DataFrames lazily, ``with_views``
renders the same text as a WITH chain for the oracle.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitewise.session import dealt

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def _letter(expr: str) -> str:
    return f"substr('{_LETTERS}', CAST(1 + ({expr}) % 20 AS INT), 1)"


VIEWS: dict[str, str] = {
    # --- alignment side: one column per eight orders, 25 species ---------------
    "species": """
        SELECT n_nationkey AS species_id, n_name AS species, r_name AS taxon
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "config": """
        SELECT 'trait' AS trait, n_name AS species, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS grp,
               CAST((n_nationkey - n_nationkey % 2) / 2 + 1 AS INT) AS pair
        FROM {nation} WHERE n_nationkey < 10""",
    "raw_cells": f"""
        SELECT CAST((l_orderkey - l_orderkey % 8) / 8 AS BIGINT) AS col_id,
               (l_suppkey * 7 + l_linenumber + l_partkey) % 25 AS species_id,
               CAST(l_quantity AS BIGINT) AS q, l_linenumber AS ln
        FROM {{lineitem}}""",
    "cells": f"""
        SELECT concat('G', CAST(CAST((col_id - col_id % 20) / 20 AS BIGINT) AS VARCHAR(20))) AS gene,
               CAST(col_id % 20 AS INT) AS position,
               concat('NATION_', CAST(species_id AS VARCHAR(20))) AS species,
               chr(max(ascii(CASE WHEN q > 49 THEN '-' WHEN q > 48 THEN 'X'
                        WHEN q > 42 THEN {_letter('col_id + ln')}
                        WHEN col_id % 3 = 0 AND species_id < 10 AND species_id % 2 = 0 THEN {_letter('col_id + 7')}
                        ELSE {_letter('col_id')} END))) AS residue
        FROM {{raw_cells}}
        GROUP BY col_id, species_id""",
    "resamples": """
        SELECT cycle, species, rk FROM (
          SELECT concat('b_', CAST(s_suppkey AS VARCHAR(20))) AS cycle, n_name AS species,
                 row_number() OVER (PARTITION BY s_suppkey
                                    ORDER BY (n_nationkey * (1 + s_suppkey % 28) + s_suppkey) % 29) AS rk
          FROM {supplier} CROSS JOIN {nation}) t
        WHERE rk <= 8""",
    # --- discovery-like site table ---------------------------------------------
    "site_base": """
        SELECT l_partkey AS pk, CAST(l_orderkey % 500 AS INT) AS pos, l_linenumber % 6 AS g,
               min(l_discount) AS d, min(l_tax) AS t, CAST(max(l_quantity) AS BIGINT) AS q,
               min(l_suppkey) AS s, chr(min(ascii(l_returnflag))) AS rf, chr(max(ascii(l_linestatus))) AS ls
        FROM {lineitem}
        GROUP BY l_partkey, CAST(l_orderkey % 500 AS INT), l_linenumber % 6""",
    "sites": f"""
        SELECT concat('G', CAST(pk AS VARCHAR(20))) AS Gene, pos AS Position,
               CASE WHEN g = 0 THEN 'US' ELSE concat('GS', CAST(g - 1 AS VARCHAR(20))) END AS CAAP_Group,
               'acctbal' AS Trait, d AS Pvalue,
               CASE WHEN q % 17 = 0 THEN NULL ELSE t END AS pvalue_boot,
               CASE q % 5 WHEN 0 THEN 'convergent' WHEN 1 THEN 'codivergent' WHEN 2 THEN 'divergent'
                          WHEN 3 THEN 'ambiguous' ELSE 'no_change' END AS change_top,
               CASE s % 5 WHEN 0 THEN 'convergent' WHEN 1 THEN 'codivergent' WHEN 2 THEN 'divergent'
                          WHEN 3 THEN 'ambiguous' ELSE 'no_change' END AS change_bottom,
               CASE WHEN q % 5 < 3 AND s % 5 < 3 THEN 'both' WHEN q % 5 < 3 THEN 'top'
                    WHEN s % 5 < 3 THEN 'bottom' ELSE 'none' END AS change_side,
               CASE q % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'MIXED' ELSE NULL END AS parallel_top,
               CASE s % 4 WHEN 0 THEN 'parallel' WHEN 1 THEN 'nonparallel' WHEN 2 THEN 'mixed' ELSE '' END AS parallel_bottom,
               CASE (q + s) % 3 WHEN 0 THEN 'parallel_top' WHEN 1 THEN 'mixed_both' ELSE 'none' END AS parallel_type,
               CASE WHEN rf = 'R' THEN 'TRUE' ELSE 'false' END AS is_conserved_meta,
               CASE WHEN ls = 'F' THEN 'yes' ELSE 'no' END AS asr_is_conserved,
               CASE WHEN q % 2 = 0 THEN 'true' ELSE 'false' END AS asr_root_conserved,
               CASE q % 4 WHEN 0 THEN '1' WHEN 1 THEN '2,3' WHEN 2 THEN '' ELSE '3' END AS conserved_pair,
               CASE WHEN q % 13 = 0 THEN NULL ELSE CAST(q % 10 AS DOUBLE) / 10 END AS mrca_1_posterior,
               CAST(s % 10 AS DOUBLE) / 10 AS mrca_2_posterior,
               CASE WHEN s % 7 = 0 THEN NULL ELSE CAST((q + s) % 20 AS DOUBLE) / 20 END AS mrca_3_posterior,
               CAST((q * 3 + s) % 10 AS DOUBLE) / 10 AS all_mrca_posterior,
               CAST(1 + q % 3 AS VARCHAR(20)) AS Pattern,
               concat({_letter('q')}, {_letter('q + s % 2')}, {_letter('q')}, '/', {_letter('s')}, {_letter('q')}, {_letter('s + 1')}) AS caas,
               concat({_letter('q % 4')}, {_letter('q % 4 + s % 2')}, {_letter('q % 4')}, '/', {_letter('s % 4')}, {_letter('q % 4')}, {_letter('s % 4 + 1')}) AS amino_encoded
        FROM {{site_base}}""",
    "genes": """
        SELECT concat('G', CAST(p_partkey AS VARCHAR(20))) AS Gene,
               concat('chr', CASE WHEN p_size % 25 = 0 THEN 'X' WHEN p_size % 25 = 24 THEN 'Y'
                                  WHEN p_size % 25 = 23 THEN 'MT' ELSE CAST(p_size % 25 AS VARCHAR(20)) END) AS chr,
               (p_partkey % 1000) * 150000 + p_size * 1000 AS start_bp,
               (p_partkey % 1000) * 150000 + p_size * 1000 + (p_size * 10 + 50) * 3 AS end_bp,
               CAST(p_size * 10 + 50 AS BIGINT) AS Length
        FROM {part}""",
    "acc_sites": """
        SELECT Gene, CAST(Position % 20 AS INT) AS Position, CAAP_Group, min(change_side) AS change_side,
               min(is_conserved_meta) AS is_conserved_meta, min(asr_is_conserved) AS asr_is_conserved,
               min(concat('t', CAST(Position AS VARCHAR(20)))) AS tag
        FROM {sites} GROUP BY Gene, CAST(Position % 20 AS INT), CAAP_Group""",
    "draws": """
        SELECT concat('G', CAST(l_partkey AS VARCHAR(20))) AS gene, l_suppkey % 20 AS rand, count(*) AS c,
               CAST(sum(CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) AS BIGINT) AS hi
        FROM {lineitem} GROUP BY l_partkey, l_suppkey % 20""",
    # --- gene-level side tables -------------------------------------------------
    "fade": f"""
        SELECT concat('G', CAST(o_custkey AS VARCHAR(20))) AS gene, CAST(o_orderkey % 500 AS INT) AS site,
               {_letter('o_orderkey')} AS target_aa,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice / 2000 END AS bayes_factor,
               CASE WHEN o_orderstatus = 'F' THEN 'top' ELSE 'bottom' END AS direction
        FROM {{orders}}""",
    "rer": """
        SELECT concat('G', CAST(c_custkey AS VARCHAR(20))) AS gene, c_acctbal / 10000 AS Rho,
               CAST((c_custkey * 37) % 1000 AS DOUBLE) / 1000 AS P,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST((c_custkey * 53) % 1000 AS DOUBLE) / 1000 END AS p_perm
        FROM {customer}""",
    "accum": """
        SELECT concat('G', CAST(l_partkey AS VARCHAR(20))) AS Gene,
               CASE l_linenumber % 6 WHEN 0 THEN 'us' WHEN 1 THEN 'gs1' WHEN 2 THEN 'gs2' WHEN 3 THEN 'gs3'
                                     ELSE 'gs4' END AS scheme,
               min(l_discount * 10 + l_tax) AS pval
        FROM {lineitem} GROUP BY l_partkey, CASE l_linenumber % 6 WHEN 0 THEN 'us' WHEN 1 THEN 'gs1'
               WHEN 2 THEN 'gs2' WHEN 3 THEN 'gs3' ELSE 'gs4' END""",
    # --- traits: suppliers as species ------------------------------------------
    "traits": """
        SELECT concat('S', CAST(s_suppkey AS VARCHAR(20))) AS species, s_suppkey AS sid, n_name AS taxon,
               r_name AS clade, s_acctbal AS value, n_population, n_cases
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        JOIN (SELECT l_suppkey, count(*) AS n_population,
                     CAST(sum(CASE WHEN l_returnflag = 'R' AND l_discount < l_tax THEN 1 ELSE 0 END) AS BIGINT) AS n_cases
              FROM {lineitem} GROUP BY l_suppkey) c ON c.l_suppkey = s_suppkey""",
    "tree": """
        SELECT 0 AS node_id, CAST(NULL AS INT) AS parent_id, 'root' AS name, CAST(0 AS DOUBLE) AS branch_length
        UNION ALL
        SELECT 1 + r_regionkey, 0, r_name, CAST(1 + r_regionkey AS DOUBLE) / 4 FROM {region}
        UNION ALL
        SELECT 100 + n_nationkey, 1 + n_regionkey, n_name, CAST(1 + n_nationkey % 7 AS DOUBLE) / 8 FROM {nation}
        UNION ALL
        SELECT CAST(1000 + s_suppkey AS INT), 100 + s_nationkey, concat('S', CAST(s_suppkey AS VARCHAR(20))),
               CAST(1 + s_suppkey % 5 AS DOUBLE) / 16 FROM {supplier}""",
    # --- sets --------------------------------------------------------------------
    "gene_sets": """
        SELECT concat(lang, '_', source) AS set_name, lang AS db,
               concat('G', CAST((doc_id * 7 + n_chars) % 1000 AS VARCHAR(20))) AS gene
        FROM {documents} WHERE lang IS NOT NULL AND source IS NOT NULL
        GROUP BY concat(lang, '_', source), lang, concat('G', CAST((doc_id * 7 + n_chars) % 1000 AS VARCHAR(20)))""",
    "gene_lists": """
        SELECT DISTINCT concat('caas_', CASE WHEN change_side = 'both' THEN 'all' ELSE change_side END, '_',
                               lower(CAAP_Group)) AS gene_list, Gene AS gene
        FROM {sites} WHERE Pvalue <= 0.01 AND change_side <> 'none'""",
    "terms": """
        SELECT concat('caas_', CASE WHEN user_id % 3 = 0 THEN 'top' WHEN user_id % 3 = 1 THEN 'bottom' ELSE 'all' END,
                      '_', event_type) AS gene_list,
               concat('term', CAST(event_id % 211 AS VARCHAR(20))) AS term, event_type AS db,
               min(value / 1000) AS fdr
        FROM {events}
        GROUP BY concat('caas_', CASE WHEN user_id % 3 = 0 THEN 'top' WHEN user_id % 3 = 1 THEN 'bottom' ELSE 'all' END,
                      '_', event_type), concat('term', CAST(event_id % 211 AS VARCHAR(20))), event_type""",
    # --- variants ----------------------------------------------------------------
    "variants": f"""
        SELECT concat('chr', CAST(1 + l_partkey % 3 AS VARCHAR(20))) AS chr,
               l_partkey * 1500 + (l_orderkey % 500) * 3 + l_linenumber % 4 AS pos,
               CASE WHEN l_suppkey % 5 = 0 THEN 'A' ELSE {_letter('l_orderkey % 500')} END AS ref_aa,
               {_letter('CAST(l_quantity AS BIGINT) + l_linenumber')} AS alt_aa, l_extendedprice AS score
        FROM {{lineitem}}""",
    "queries": f"""
        SELECT concat(Gene, ':p.', CAST(Position AS VARCHAR(20))) AS query, Gene, Position, CAAP_Group, change_side, caas, amino_encoded,
               concat('chr', CAST(1 + CAST(substr(Gene, 2) AS BIGINT) % 3 AS VARCHAR(20)), ':g.',
                      CAST(CAST(substr(Gene, 2) AS BIGINT) * 1500 + Position * 3 AS VARCHAR(20)),
                      CASE WHEN Position % 4 = 0 THEN '' ELSE concat('_', CAST(CAST(substr(Gene, 2) AS BIGINT) * 1500 + Position * 3 + 2 AS VARCHAR(20))) END,
                      '/c.1/p.', CAST(Position AS VARCHAR(20)), {_letter('Position')}) AS coord
        FROM {{sites}}""",
    # --- ancestral posteriors ------------------------------------------------------
    "posteriors": f"""
        SELECT concat('G', CAST(l_partkey AS VARCHAR(20))) AS gene, CAST(100 + l_suppkey % 3 AS INT) AS node_id,
               CAST(l_orderkey % 500 AS INT) AS site, {_letter('l_linenumber')} AS aa,
               max(CAST(l_quantity AS DOUBLE)) / 50 AS p
        FROM {{lineitem}}
        GROUP BY l_partkey, CAST(100 + l_suppkey % 3 AS INT), CAST(l_orderkey % 500 AS INT), {_letter('l_linenumber')}""",
    "pair_states": f"""
        SELECT concat('G', CAST(l_partkey AS VARCHAR(20))) AS gene, CAST(l_orderkey % 500 AS INT) AS site,
               CAST(1 + l_linenumber % 3 AS INT) AS pair_id,
               CASE WHEN max(l_quantity) > 47 THEN NULL ELSE {_letter('CAST(max(l_quantity) AS BIGINT) % 3')} END AS focal_state,
               {_letter('max(l_suppkey) % 3')} AS mrca_state,
               CASE WHEN max(l_suppkey) % 11 = 0 THEN '-' ELSE {_letter('min(l_suppkey) % 4')} END AS top_tip,
               {_letter('CAST(min(l_quantity) AS BIGINT) % 4')} AS bottom_tip,
               max(l_discount) * 10 AS posterior
        FROM {{lineitem}}
        GROUP BY l_partkey, CAST(l_orderkey % 500 AS INT), CAST(1 + l_linenumber % 3 AS INT)""",
}

#: Views that group a table into about as many rows as it has: the table, and the column its rows are dealt by before.
DEALT = {"site_base": ("lineitem", "l_partkey")}

_REF = re.compile(r"\{(\w+)\}")


def dependencies(name_or_sql: str) -> list[str]:
    """Views needed by a view or an SQL text, in definition order."""
    seen: list[str] = []

    def visit(text: str) -> None:
        for ref in _REF.findall(text):
            if ref in VIEWS and ref not in seen:
                visit(VIEWS[ref])
                seen.append(ref)

    visit("{" + name_or_sql + "}" if name_or_sql in VIEWS else name_or_sql)
    return seen


def with_views(body: str) -> str:
    """Render ``body`` (using ``{view}`` marks) as one self-contained query."""
    ctes = [f"{v} AS ({_REF.sub(lambda m: m.group(1), VIEWS[v])})" for v in dependencies(body)]
    text = _REF.sub(lambda m: m.group(1), body).strip()
    if not ctes:
        return text
    if text.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + text[len("WITH RECURSIVE"):].lstrip()
    if text.upper().startswith("WITH"):
        return "WITH " + ",\n".join(ctes) + ",\n" + text[len("WITH"):].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + text


class Tables:
    """Lazily bound tables and views of one data directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._cache = spark, path, {}

    def __getattr__(self, name: str) -> DataFrame:
        cache = self.__dict__["_cache"]
        if name not in cache:
            if name in TABLES:
                cache[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
            elif name in VIEWS:
                refs = {r: getattr(self, r) for r in set(_REF.findall(VIEWS[name]))}
                if name in DEALT:
                    table, key = DEALT[name]
                    refs[table] = dealt(refs[table], key)
                cache[name] = self.spark.sql(VIEWS[name], **refs)
            else:
                raise AttributeError(name)
        return cache[name]

    def once(self, name: str, make: Callable[[Tables], DataFrame]) -> DataFrame:
        """What ``make`` returns, made at the first call under ``name`` and kept for the others."""
        cache = self.__dict__["_cache"]
        key = f"once {name}"
        if key not in cache:
            cache[key] = make(self)
        return cache[key]

    def sql(self, body: str, **extra: DataFrame) -> DataFrame:
        refs = {r: extra.get(r) if r in extra else getattr(self, r) for r in set(_REF.findall(body))}
        return self.spark.sql(body, **refs)
