"""What Spark made of a query: exchanges, joins, Python nodes, pushed filters and the columns read."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Plan:
    nodes: Counter
    pushed: tuple[str, ...]
    read: tuple[str, ...]

    @property
    def shuffles(self) -> int:
        return self.nodes["Exchange"]

    @property
    def python(self) -> int:
        return sum(n for name, n in self.nodes.items() if re.search("Python|Pandas|Arrow", name))

    @property
    def cartesian(self) -> int:
        """Joins without a key, other than against one broadcast side."""
        return self.nodes["CartesianProduct"]


def review(df: DataFrame) -> Plan:
    """The physical plan before it runs; adaptive execution may still turn a shuffled join into a broadcast."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    tree, _, details = text.partition("\n\n")
    nodes = Counter(m[1] for m in re.finditer(r"^[\s:+*|-]*(?:\*\s*)?([A-Z]\w+)(?: \w+)*? \(\d+\)", tree, re.MULTILINE))
    pushed = tuple(f for m in re.finditer(r"PushedFilters: \[([^\]]*)\]", details) for f in re.split(r", (?=[A-Z]\w*\()", m[1]) if f)
    read = tuple(c for m in re.finditer(r"ReadSchema: struct<([^\n]*)>", details) for c in re.findall(r"(\w+):", m[1]))
    return Plan(nodes, pushed, read)
