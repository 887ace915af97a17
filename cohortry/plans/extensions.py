"""Registries: result summarizers by framework, reports by type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.flatten import flatten_answers

SUMMARIZERS: dict[str, Callable[[Column], Column]] = {}
REPORTS: dict[str, Callable[..., DataFrame]] = {}


def register_summarizer(framework_id: str, f: Callable[[Column], Column]) -> None:
    """``f`` takes a result's JSON to a map of answers."""
    SUMMARIZERS[framework_id] = f


def register_report(kind: str, f: Callable[..., DataFrame]) -> None:
    REPORTS[kind] = f


def summarize(framework: Column, result: Column) -> Column:
    """The answers by the summarizer of the row's framework; an unknown one gives null."""
    out = F.lit(None).cast("map<string,string>")
    for name, f in SUMMARIZERS.items():
        out = F.when(framework == name, f(result)).otherwise(out)
    return out


register_summarizer("survey", flatten_answers)
