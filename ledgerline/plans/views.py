"""Staging views as SQL text over the published raw tables.

A view must outlive the session that made it, so it is kept as text.  The
text is not written a second time: it is read off the staging plan, whose
select list and filter Spark prints as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


class NotAViewError(ValueError):
    pass


def view_sql(df: DataFrame, table: str) -> str:
    """The SELECT of a frame that is one projection of ``table``, filtered or not."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.nodeName() != "Project":
        raise NotAViewError(f"not a projection: {plan.nodeName()}")
    items = plan.projectList()
    select = ",\n       ".join(items.apply(i).sql() for i in range(items.size()))
    source, where = plan.child(), ""
    if source.nodeName() == "Filter":
        where = f"\nWHERE {source.condition().sql()}"
        source = source.child()
    if source.nodeName() != "SubqueryAlias":
        raise NotAViewError(f"not over a table: {source.nodeName()}")
    return f"SELECT {select}\nFROM {table}{where}"
