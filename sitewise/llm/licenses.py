"""License scans: an exact set-similarity join of text blocks with notice templates.

Blocks of ``WIDTH`` words overlap by half, so that any notice of up to half a block lies whole
in one.  Template words are ordered by the number of documents that hold them, rarest first.
A block that holds ``least`` of a template's words must hold one of the template's first
``size - least + 1`` (prefix filter), must have ``least`` template words at all (length filter),
and from the places of the shared word in both orders must still be able to reach ``least``
(positional filter).  What is left is counted.  Expressions and joins only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import LOWER, UPPER
from sitewise.session import checkpoint

#: The phrases that always give their label.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Notices and the labels that they give.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
]
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WIDTH, CONTAINED, MOST_WORDS = 64, 0.8, 5000


def spaced(text: str) -> Column:
    """The words, each with a space on either side, so that a phrase is a substring and its places don't share characters."""
    joined = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP, "  "))
    return F.when(joined == "", "").otherwise(F.concat(F.lit(" "), joined, F.lit(" ")))


def word_list(s: Column) -> Column:
    return F.filter(F.split(F.trim(s), "  "), lambda w: w != "")


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _count(s: Column) -> Column:
    return F.size(word_list(s))


def base(df: DataFrame, spaced_words: str, n_words: str) -> DataFrame:
    """Add ``n_base``, ``first_word``, ``last_word`` and ``_base`` (labels) by the phrases."""
    s = F.col(spaced_words)
    n, first, last, labels = [], [], [], []
    for phrase, label in PHRASES:
        p = "".join(f" {w} " for w in phrase.split())
        places = ((F.length(s) - F.length(F.replace(s, F.lit(p), F.lit("")))) / len(p)).cast("long")
        n.append(places)
        some = F.contains(s, F.lit(p))
        first.append(F.when(some, _count(F.substring_index(s, p, 1)).cast("long")))
        last.append(F.when(some, (F.col(n_words) - _count(F.substring_index(s, p, -1)) - len(phrase.split())).cast("long")))
        labels.append(F.when(some, F.lit(label)))
    return df.withColumns({"n_base": sum(n[1:], n[0]), "first_word": F.least(*first), "last_word": F.greatest(*last), "_base": F.array_compact(F.array(*labels))})


def scan(df: DataFrame, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED) -> tuple[DataFrame, DataFrame]:
    """(rows, found): every row with a number and its phrase columns, and the blocks that hold a template.

    found: ``_row``, ``start`` (word), ``template`` (its number), ``label``, ``containment``.
    Null texts are empty and give nothing.  Repeated rows are found each.  The templates are a
    bounded input: at most ``MOST_WORDS`` different words.
    """
    sets = [list(dict.fromkeys(t.split())) for t, _ in templates]
    every = sorted({w for s in sets for w in s})
    if len(every) > MOST_WORDS or max(map(len, sets)) > WIDTH // 2:
        raise ValueError("the templates have too many words")
    words = df.select(word_list(spaced(text)).alias("w"))
    held = words.select(F.explode(F.array_intersect("w", _literal(every))).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in held.collect()}  # a number for each template word
    order = sorted(every, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ranks = [sorted(rank[w] for w in s) for s in sets]
    least = [math.ceil(round(contained * len(r), 9)) for r in ranks]
    prefixes = [r[: len(r) - a + 1] for r, a in zip(ranks, least)]
    first = [order[i] for i in sorted({i for p in prefixes for i in p})]
    rows = df.withColumn("_s", spaced(text)).withColumn("_w", word_list(F.col("_s"))).withColumn("n_words", F.size("_w").cast("long"))
    rows = base(rows, "_s", "n_words").withColumn("_row", F.monotonically_increasing_id())
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_w") - WIDTH // 2 - 1), F.lit(WIDTH // 2))
    numbers = F.create_map(*[F.lit(x) for w in order for x in (w, rank[w])])

    def block(i: Column) -> Column:
        inside = F.array_intersect(F.slice("_w", i + 1, WIDTH), _literal(order))
        return F.struct(i.alias("start"), F.array_sort(F.transform(inside, lambda w: F.element_at(numbers, w))).alias("ranks"))

    blocks = F.when(F.arrays_overlap("_w", _literal(first)), F.filter(F.transform(starts, block), lambda b: F.size(b["ranks"]) >= min(least)))
    rows = checkpoint(rows.withColumn("_blocks", blocks).drop("_s", "_w", text))
    spark = df.sparkSession
    index = spark.createDataFrame([(r, t, i, len(ranks[t]), least[t]) for t, p in enumerate(prefixes) for i, r in enumerate(p)], "r int, template int, i int, size int, least int")
    whole = spark.createDataFrame([(t, ranks[t], templates[t][1]) for t in range(len(templates))], "template int, own array<int>, label string")
    split = rows.where("_blocks IS NOT NULL").select("_row", F.explode("_blocks").alias("b")).select("_row", "b.start", "b.ranks")
    probes = split.select("_row", "start", "ranks", F.posexplode("ranks").alias("j", "r"))
    near = probes.join(F.broadcast(index), "r")  # both are bounded by the templates
    near = near.where(F.size("ranks") >= F.col("least")).where(F.least(F.col("size") - F.col("i"), F.size("ranks") - F.col("j")) >= F.col("least"))
    near = near.select("_row", "start", "ranks", "template", "size", "least").distinct()
    both = near.join(F.broadcast(whole), "template").withColumn("n", F.size(F.array_intersect("ranks", "own")))
    found = both.where("n >= least").select("_row", "start", "template", "label", (F.col("n") / F.col("size")).alias("containment"))
    return rows, found


def licenses(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Phrase places and labels of every row, and the labels that templates add.

    score: 1 with a phrase, else the largest containment found, else 0.
    """
    rows, found = scan(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    by_row = checkpoint(found.groupBy("_row").agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_best")))  # labels are few
    out = rows.join(by_row, "_row", "left")

    def text_of(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    more = F.coalesce("_more", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", text_of(F.col("_base")).alias("base_labels"), text_of(F.concat("_base", more)).alias("labels"),
                      F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))


def oracle(table: str = "documents") -> str:
    """The same in DuckDB's SQL, comparing every block with every template."""
    places = ", ".join(f"[i FOR i IN range(0, len(w) - {len(p.split()) - 1}) IF w[i + 1 : i + {len(p.split())}] = {p.split()}] AS p{k}" for k, (p, _) in enumerate(PHRASES))
    ks = range(len(PHRASES))
    labels = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{PHRASES[k][1]}' END" for k in ks)
    rows = ", ".join(f"('{label}', {list(dict.fromkeys(t.split()))}, {math.ceil(round(CONTAINED * len(set(t.split())), 9))})" for t, label in TEMPLATES)

    def joined(of: str) -> str:
        return f"coalesce(array_to_string(list_sort(list_distinct({of})), ','), '')"

    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS w FROM {table}),
p AS (SELECT *, {places} FROM d),
t(label, words, least) AS (VALUES {rows}),
b AS (SELECT row, unnest([list_distinct(w[i + 1 : i + {WIDTH}]) FOR i IN range(0, greatest(1, len(w) - {WIDTH // 2}), {WIDTH // 2})]) AS block FROM d),
f AS (SELECT row, label, len(list_intersect(block, words)) AS n, len(words) AS size, least FROM b, t),
g AS (SELECT row, list(label) AS more, max(n / size) AS best FROM f WHERE n >= least GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST({" + ".join(f"len(p{k})" for k in ks)} AS BIGINT) AS n_base,
  CAST(least({", ".join(f"list_min(p{k})" for k in ks)}) AS BIGINT) AS first_word, CAST(greatest({", ".join(f"list_max(p{k})" for k in ks)}) AS BIGINT) AS last_word,
  {joined(f"[x FOR x IN [{labels}] IF x IS NOT NULL]")} AS base_labels,
  {joined(f"[x FOR x IN list_concat([{labels}], coalesce(more, [])) IF x IS NOT NULL]")} AS labels,
  CASE WHEN {" + ".join(f"len(p{k})" for k in ks)} > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM p LEFT JOIN g USING (row)"""
