"""Walk an executed physical plan, through query stages and subqueries."""


def _seq(java_seq):
    return [java_seq.apply(i) for i in range(java_seq.size())]


def nodes(df):
    """(name, text) of every node that ran; a reused exchange or subquery is one leaf."""
    df.collect()
    out = []

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        out.append((kind, node.simpleString(10_000)))
        if kind.startswith("Reused"):
            return
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        for child in _seq(node.children().toSeq()) + _seq(node.subqueries().toSeq()):
            visit(child)

    visit(df._jdf.queryExecution().executedPlan())
    return out


def count(df_or_nodes, kind, text=""):
    found = df_or_nodes if isinstance(df_or_nodes, list) else nodes(df_or_nodes)
    return sum(1 for k, t in found if k.startswith(kind) and text in t)
