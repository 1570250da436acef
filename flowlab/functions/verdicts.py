"""Row-local verdicts and votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

# Upper bounds of the train - test accuracy gap.
EXCELLENT, GOOD, MILD = 0.02, 0.05, 0.10


def gap_verdict(gap: Column) -> Column:
    return (F.when(gap < EXCELLENT, "excellent").when(gap < GOOD, "good")
            .when(gap < MILD, "mild overfitting").otherwise("overfitting"))


def vote(votes: Sequence[Column]) -> Column:
    """The most frequent value, the smallest on a tie."""
    def support(v: Column) -> Column:
        same = [F.coalesce((v == other).cast("int"), F.lit(0)) for other in votes]
        return sum(same[1:], same[0])

    ballots = [F.struct((-support(v)).alias("n"), v.alias("v")) for v in votes]
    return (F.least(*ballots) if len(ballots) > 1 else ballots[0])["v"]


def top_probability(p: Column, is_vector: bool = False) -> Column:
    return F.array_max(vector_to_array(p) if is_vector else p)


def one_vs_rest_probability(raw: Column) -> Column:
    """Normalised class shares from per-class margins of boosted trees."""
    each = F.transform(raw, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))
    total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
    return F.transform(each, lambda x: F.try_divide(x, total))


def rules(cases: Sequence[tuple[str, object]], otherwise: object = None) -> Column:
    """The class of the first rule that holds."""
    out = None
    for expression, name in cases:
        c = F.expr(expression)
        out = F.when(c, F.lit(name)) if out is None else out.when(c, F.lit(name))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))
