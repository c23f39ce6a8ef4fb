"""What the operators of a query's plan did, from the metrics of the plan that ran."""


def _nodes(node):
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(node.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _nodes(node.plan())
    else:
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from _nodes(children.apply(i))


def _metric(df, name: str) -> list[int]:
    df.collect()
    found = [n.metrics().get(name) for n in _nodes(df._jdf.queryExecution().executedPlan())]
    return [int(m.get().value()) for m in found if m.isDefined()]


def most_rows(df) -> int:
    """Run ``df`` and return the most rows that any operator of its plan gave."""
    return max(_metric(df, "numOutputRows"))


def shuffled_bytes(df) -> int:
    """Run ``df`` and return the bytes that its exchanges wrote."""
    return sum(_metric(df, "shuffleBytesWritten"))
