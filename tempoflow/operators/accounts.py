"""A privacy budget over many releases: an append-only account, and running sums by the binary-tree mechanism."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.operators.privacy import BOUNDS, Uniform, fresh_uniform, laplace
from tempoflow.session import checkpointed
from tempoflow.sources.store import Store

COUNT = "count"


class BudgetSpent(RuntimeError):
    """A release was refused: it would go beyond the account's budget."""


class PrivacyAccount:
    """What has been spent of a budget of epsilon, as an append-only table of entries.

    Two writers cannot spend the same rest: the later commit of one version is refused.
    """

    TABLE = "spent"

    def __init__(self, store: Store, budget: float):
        self.store, self.budget = store, budget

    def entries(self) -> DataFrame | None:
        version = self.store.version()
        return self.store.read(self.TABLE, version) if self.TABLE in version.schemas else None

    def spent(self) -> float:
        entries = self.entries()
        return 0.0 if entries is None else entries.agg(F.coalesce(F.sum("epsilon"), F.lit(0.0))).first()[0]

    def spend(self, epsilon: float, purpose: str) -> float:
        """Book ``epsilon`` before its release is made; returns what is left."""
        base = self.store.version()
        spent = self.spent()
        if epsilon <= 0 or spent + epsilon > self.budget * (1 + 1e-12):
            raise BudgetSpent(f"{purpose}: {epsilon} of {self.budget - spent} left")
        entry = self.store.spark.createDataFrame([(purpose, float(epsilon))], "purpose string, epsilon double")
        parts = [*base.tables.get(self.TABLE, []), self.store.write(entry.coalesce(1))]
        self.store.commit(base, {self.TABLE: parts}, {self.TABLE: entry.schema})
        return self.budget - spent - epsilon


def levels(horizon: int) -> int:
    """Nodes of the tree that one release of ``horizon`` can be in: what noise and epsilon are shared by."""
    return horizon.bit_length()


def nodes_of(t: Column, horizon: int) -> Column:
    """The nodes whose sums make up the first ``t`` steps: one per set bit, with its level and the steps before it."""
    at = F.transform(
        F.sequence(F.lit(0), F.lit(levels(horizon) - 1)),
        lambda level: F.struct(level.alias("level"), (F.call_function("shiftright", t, level + 1) * F.call_function("shiftleft", F.lit(1).cast("bigint"), level + 1)).alias("before")),
    )
    return F.filter(at, lambda node: F.call_function("shiftright", t, node["level"]) % 2 == 1)


def sensitivities() -> dict[str, float]:
    """How much one row can change each sum."""
    return {COUNT: 1.0} | {m: max(abs(lo), abs(hi)) for m, (lo, hi) in BOUNDS.items()}


def scale(metric: Column, horizon: int, epsilon: float) -> Column:
    """Noise of a node: a row is in one node of each level, in all metrics, and these share epsilon."""
    bounds = sensitivities()
    share = epsilon / (levels(horizon) * len(bounds))
    found = F.lit(None).cast("double")
    for name, bound in bounds.items():
        found = F.when(metric == name, F.lit(bound / share)).otherwise(found)
    return found


def step_sums(df: DataFrame, step: Column) -> DataFrame:
    """``step, metric, total``: the number of rows and the clipped sums of each step."""
    clipped = {m: F.least(F.greatest(F.col(m).cast("double"), F.lit(lo)), F.lit(hi)) for m, (lo, hi) in BOUNDS.items()}
    sums = df.groupBy(step.cast("bigint").alias("step")).agg(
        F.count(F.lit(1)).cast("double").alias(COUNT), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(m) for m, c in clipped.items()]
    )
    return sums.select("step", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("total")) for m in sensitivities()])))


def noises(nodes: DataFrame, horizon: int, epsilon: float, uniform: Uniform) -> DataFrame:
    """``metric, level, before, noise``: each node draws once, and all releases that it is part of share its number."""
    label = F.concat_ws(":", "metric", F.col("level").cast("string"), F.col("before").cast("string"))
    return nodes.withColumn("noise", laplace(uniform(label), scale(F.col("metric"), horizon, epsilon)))


def dp_running_stats(
    df: DataFrame, step: Column, horizon: int, epsilon: float = S.EPSILON, uniform: Uniform = fresh_uniform
) -> DataFrame:
    """``step, metric, private_total``: the sums up to each step from 1 to ``horizon``, all for one epsilon.

    Each release is the exact sum and the noise of at most log2(horizon) + 1 nodes, where noise for each release on its own
    would have to grow with their number. Steps without rows are released as well; rows of other steps are left out. The tables
    after the first grouping have one row per step and metric.
    """
    sums = step_sums(df.where(step.between(1, horizon)), step)
    metrics = F.explode(F.array(*[F.lit(m) for m in sensitivities()])).alias("metric")
    grid = df.sparkSession.range(1, horizon + 1).select(F.col("id").alias("step"), metrics)
    running = F.sum(F.coalesce("total", F.lit(0.0))).over(Window.partitionBy("metric").orderBy("step"))
    totals = grid.join(sums, ["step", "metric"], "left").select("step", "metric", running.alias("total"))
    parts = totals.select("step", "metric", "total", F.explode(nodes_of(F.col("step"), horizon)).alias("node")).select("step", "metric", "total", "node.*")
    drawn = checkpointed(noises(parts.select("metric", "level", "before").distinct(), horizon, epsilon, uniform))
    return (
        parts.join(drawn, ["metric", "level", "before"])
        .groupBy("step", "metric")
        .agg(F.first("total").alias("total"), F.sum("noise").alias("noise"))
        .select("step", "metric", (F.col("total") + F.col("noise")).alias("private_total"))
    )
