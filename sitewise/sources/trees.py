"""Newick text to edge tables, and reconstruction files to posteriors.

Tree texts, one a clade or gene, and reconstruction files, one a gene, are parsed inside
tasks; the one species tree of a command is a small file read on the driver.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_TOKEN = re.compile(r"[(),;]|:[^(),;]*|[^(),:;]+")


def newick_edges(text: str) -> list[tuple[int, int | None, str | None, float, str | None]]:
    """``(node_id, parent_id, name, branch_length, label)`` rows in post-order.

    Tips carry a name; what follows a closing bracket is an inner label.  All blanks
    are dropped and an unreadable length warns and counts as 0.
    """
    parent: list[int | None] = []
    depth, name, length, label = [], [], [], []

    def new(above: int | None) -> int:
        parent.append(above)
        depth.append(0 if above is None else depth[above] + 1)
        name.append(None)
        length.append(0.0)
        label.append(None)
        return len(parent) - 1

    current = new(None)
    closed = False
    for token in _TOKEN.findall(re.sub(r"\s", "", text)):
        if token == "(":
            current, closed = new(current), False
        elif token == ",":
            current, closed = new(parent[current]), False
        elif token == ")":
            current, closed = parent[current], True
        elif token == ";":
            break
        elif token[0] == ":":
            try:
                length[current] = float(token[1:])
            except ValueError:
                warnings.warn(f"unreadable branch length {token[1:]!r}", stacklevel=2)
        else:
            (label if closed else name)[current] = token
    # Nodes are in pre-order; what follows a second root is not below the first.
    n = next((i for i in range(1, len(parent)) if parent[i] is None), len(parent))
    size = [1] * n
    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
    number = [i + size[i] - 1 - depth[i] for i in range(n)]
    out: list = [None] * n
    for i, k in enumerate(number):
        out[k] = (k, None if i == 0 else number[parent[i]], name[i], length[i], label[i])
    return out


EDGE_SCHEMA = "node_id int, parent_id int, name string, branch_length double, label string"


def parse_newick(texts: DataFrame, key: str = "gene", text: str = "text") -> DataFrame:
    """``key``, the edges of ``EDGE_SCHEMA`` and ``parent``, the name or label above, of many Newick texts, each parsed in a task.

    Node ids count within a text, so a key with several texts should have a column to tell them
    apart in the key.  A null text has no edges, an empty one a nameless root.
    """
    kind = dict(texts.dtypes)[key]
    schema = f"k {kind}, {EDGE_SCHEMA}, parent string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, owner = batch.column(0), [], []

            def frame() -> pa.RecordBatch:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.string(), pa.string()))]
                return pa.RecordBatch.from_arrays([keys.take(pa.array(owner)), *columns], ["k", "node_id", "parent_id", "name", "branch_length", "label", "parent"])

            # A frame for each text costs more than its parsing, so texts share frames.
            for k, text in enumerate(batch.column(1).to_pylist()):
                if text is None:
                    continue
                edges = newick_edges(text)
                called = [e[2] if e[2] is not None else e[4] for e in edges]
                rows += [(*e, None if e[1] is None else called[e[1]]) for e in edges]
                owner += [k] * len(edges)
                if len(rows) >= FRAME:
                    yield frame()
                    rows, owner = [], []
            if rows:
                yield frame()

    rows = texts.select(texts[key].alias("k"), texts[text].alias("t"))
    return rows.mapInArrow(run, schema).withColumnRenamed("k", key)


def edge_frame(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame(newick_edges(text), EDGE_SCHEMA)


# Section markers of the reconstruction file.
START = "(1) Marginal reconstruction"
BEST = "Prob of best state at each node"
HEADER = "site   Freq   Data:"
ENDS = ["(2)", "List of extant", "TREE #", "Nodes", "tree with node"]
#: Rows from which on a frame of parsed files goes out.
FRAME = 20_000
_SITE = re.compile(r"^\s*(\d+)\s+(\d+)\s+(.*)")
_BEST_STATE = re.compile(r"^(\S+?)\(([^)]*)\)$")


def reconstruction_rows(text: str, node_ids: list[int]) -> Iterator[tuple[int, int, str, float]]:
    """``(node_id, site, residue, probability)`` of the best states, nodes in ascending order."""
    start = text.find(START)
    best = text.find(BEST, start) if start >= 0 else -1
    head = text.find(HEADER, best) if best >= 0 else -1
    if head < 0:
        raise ValueError("no marginal reconstruction section")
    body = text[head + len(HEADER):]
    cuts = [i for i in (body.find(m) for m in ENDS) if i >= 0]
    body = body[: min(cuts)] if cuts else body
    nodes = sorted(node_ids)
    for line in body.split("\n"):
        m = _SITE.match(line)
        if not m or ":" not in m.group(3):
            continue
        data, _, probs = m.group(3).partition(":")
        tokens = probs.strip().rstrip("$").split()[: len(data.strip())]
        for node, token in zip(nodes, tokens):
            t = _BEST_STATE.match(token)
            if t:
                try:
                    yield node, int(m.group(1)), t.group(1), float(t.group(2))
                except ValueError:
                    continue


def parse_reconstructions(texts: DataFrame, node_ids: list[int], positions: set[int] | None = None) -> DataFrame:
    """``gene, node_id, site, aa, p`` from ``gene, text`` rows, one file per row."""
    columns = ["gene", "node_id", "site", "aa", "p"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            # A frame for each file costs more than its parsing, so files share frames.
            for gene, text in zip(pdf["gene"], pdf["text"]):
                rows += [(gene, *r) for r in reconstruction_rows(text, node_ids) if positions is None or r[1] in positions]
                if len(rows) >= FRAME:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return texts.select("gene", "text").mapInPandas(run, "gene string, node_id int, site int, aa string, p double")
