"""Scalar score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance_sigmoid(d: Column, middle: float = 9.0, slope: float = 1.0) -> Column:
    """1 / (1 + exp(slope * (d - middle))): small distances score high."""
    return 1 / (1 + F.exp(slope * (d - middle)))


def greedy_suspicion(d: Column, max_distance: int) -> Column:
    return 1 - d / (max_distance + 1)


def soft_weight(ood: Column, floor: float = 0.05) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(floor), 1 - ood))


def mislabel_gap(p: Column, label: Column) -> Column:
    return F.abs(p - label)


def self_confidence_gap(probs: Column, label: Column) -> Column:
    """1 - the probability of the given label; ``probs`` is an array by label."""
    return 1 - F.element_at(probs, (label + 1).cast("int"))


def uncertainty(p: Column) -> Column:
    return 1 - 2 * F.abs(p - 0.5)


def boosted(score: Column, flagged: Column, least: float = 0.7) -> Column:
    return F.when(flagged, F.greatest(score, F.lit(least))).otherwise(score)


def text_length(text: Column) -> Column:
    """Code points without white space (all kinds) at both ends; null counts 0."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / ((norm(a) + 1e-8) * (norm(b) + 1e-8))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x))


def with_suffix(name: Column, suffix: str = ".jpg") -> Column:
    return F.when(F.endswith(name, F.lit(suffix)), name).otherwise(F.concat(name, F.lit(suffix)))


def without_suffix(name: Column, suffix: str = ".jpg") -> Column:
    return F.replace(name, F.lit(suffix), F.lit(""))


def first_number(name: Column) -> Column:
    """The first run of digits as a number; null without one."""
    digits = F.regexp_extract(name, r"(\d+)", 1)
    return F.when(digits != "", digits).cast("long")
