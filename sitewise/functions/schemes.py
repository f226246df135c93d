"""Residue grouping schemes and their string encoders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 20 standard residues.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"

# Residues without a resolved identity, treated like gaps when
# group membership is decided.
AMBIGUOUS = "XBZJU"

# Code letter -> residues carrying that code, per scheme.
# US is the identity scheme, GS0 the random negative control.
PARTITIONS: dict[str, dict[str, str]] = {
    "US": {aa: aa for aa in RESIDUES},
    "GS0": {"a": "GWDC", "b": "PM", "c": "K", "d": "IQLS", "e": "EATVYF", "f": "NHR"},
    "GS1": {"t": "CV", "n": "AGPS", "p": "NDQE", "b": "RHK", "h": "ILMFWY", "o": "T"},
    "GS2": {"c": "C", "s": "AGV", "a": "DE", "n": "NQHW", "b": "RK", "h": "ILFP", "x": "YMTS"},
    "GS3": {"c": "C", "n": "AGPST", "s": "NDQE", "b": "RHK", "l": "ILMV", "g": "FWY"},
    "GS4": {
        "c": "C", "h": "AILV", "o": "ST", "p": "NQ", "a": "DE", "b": "RH",
        "g": "G", "r": "P", "k": "K", "m": "M", "f": "F", "y": "WY",
    },
}

# Scheme weights, integer form (position scores) and fractional
# form (accumulation and variant scores).
WEIGHTS_INT = {"US": 5, "GS4": 2, "GS3": 1, "GS2": 1, "GS1": 1}
WEIGHTS_FRACTION = {"US": 0.5, "GS4": 0.2, "GS3": 0.1, "GS2": 0.1, "GS1": 0.1, "GS0": 0.0}

SCHEMES = list(PARTITIONS)


def codes(scheme: str) -> str:
    """Code letters of ``scheme`` aligned with :data:`RESIDUES`."""
    by_residue = {aa: code for code, members in PARTITIONS[scheme].items() for aa in members}
    return "".join(by_residue[aa] for aa in RESIDUES)


def scheme_table(names: list[str] | None = None) -> Column:
    """Literal ``array<struct<scheme, codes>>`` to explode rows per scheme."""
    return F.array(
        *[F.struct(F.lit(s).alias("scheme"), F.lit(codes(s)).alias("codes")) for s in names or SCHEMES]
    )


def translate(text: Column, matching: Column, replace: Column) -> Column:
    return F.call_function("translate", text, matching, replace)


def known_only(text: Column) -> Column:
    """Drop every character that is not one of the 20 standard residues."""
    return F.regexp_replace(text, f"[^{RESIDUES}]", "")


def encode(text: Column, code_string: Column) -> Column:
    """Replace residues by group codes; unmapped characters are dropped."""
    return translate(known_only(text), F.lit(RESIDUES), code_string)


def encode_keep(text: Column, code_string: Column) -> Column:
    """Replace residues by group codes; an unmapped character stands for itself."""
    return translate(text, F.lit(RESIDUES), code_string)


def weight(group: Column, weights: dict) -> Column:
    """Look up a scheme weight; NULL for a scheme that has none."""
    out = None
    for name, value in weights.items():
        out = F.when(group == name, F.lit(value)) if out is None else out.when(group == name, F.lit(value))
    return out
