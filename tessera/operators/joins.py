"""Joins (J1, J2, J4).

Join strategy is left to Catalyst + AQE: with ``spark.sql.adaptive.enabled``
the runtime size of the aggregated right side decides between a broadcast
hash join and a sort-merge join, so nothing is broadcast on a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import q

NULLABLE_SIDE_KEY = "nullable_side"


def tag_nullable_side(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Mark every column (except ``keep``) as coming from the nullable side.

    The mark is a ``StructField.metadata`` entry; it survives filters, views,
    aliases and direct projection, and is dropped by expressions, exactly like
    a column that stops being a plain column reference.
    """
    keep = set(keep or [])
    cols = []
    for f in df.schema.fields:
        if f.name in keep:
            cols.append(F.col(q(f.name)))
        else:
            md = dict(f.metadata or {})
            md[NULLABLE_SIDE_KEY] = True
            cols.append(F.col(q(f.name)).alias(f.name, metadata=md))
    return df.select(*cols)


def left_join_tagged(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """J1 + J4: ``left LEFT JOIN right USING (on)``, right columns tagged."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(tag_nullable_side(right, keep=keys), on=keys, how="left")


def left_join_with_default(left: DataFrame, right: DataFrame, on: str | list[str],
                           defaults: dict[str, object]) -> DataFrame:
    """``LEFT JOIN ... USING`` keeping unmatched rows, with zero defaults.

    ``defaults`` maps a right-side column to the value shown when unmatched;
    the raw (un-defaulted) value stays available as ``_raw_<col>`` for callers
    that must distinguish "no match" from zero.
    """
    keys = [on] if isinstance(on, str) else list(on)
    joined = left.join(right, on=keys, how="left")
    for col, dflt in defaults.items():
        joined = (joined.withColumn(f"_raw_{col}", F.col(col))
                  .withColumn(col, F.coalesce(F.col(col), F.lit(dflt))))
    return joined


def is_nullable_side(df: DataFrame, column: str) -> bool:
    field = df.schema[column]
    return bool((field.metadata or {}).get(NULLABLE_SIDE_KEY, False))


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.length())]


def nullable_side_columns(df: DataFrame) -> set[str]:
    """J4 for any query, SQL text included: output columns that are plain columns of an outer join's nullable side.

    Reads the analysed plan that Spark has made of the query: the attributes of
    each nullable side, and the renamings between them and the output.  A column
    counts if nothing but renaming lies between, so ``coalesce`` and other
    expressions end it, as they drop the tag of :func:`tag_nullable_side`.
    Nothing runs.  Without access to the plan the result is empty.
    """
    frame = getattr(df, "_jdf", None)
    if frame is None:
        return set()
    nullable: set[int] = set()
    same: dict[int, list[int]] = {}
    defined: dict[int, list[int]] = {}
    used: list[tuple[int, list[int]]] = []

    def ids(attributes) -> list[int]:
        return [a.exprId().id() for a in _items(attributes)]

    def walk(plan) -> None:
        kind = plan.nodeName()
        if kind == "Join":
            sides = {"LeftOuter": [plan.right()], "RightOuter": [plan.left()], "FullOuter": [plan.left(), plan.right()]}
            for side in sides.get(plan.joinType().toString(), []):
                nullable.update(ids(side.output()))
        elif kind == "Project" or kind == "Aggregate":
            for e in _items(plan.projectList() if kind == "Project" else plan.aggregateExpressions()):
                if e.nodeName() == "Alias" and e.child().nodeName() == "AttributeReference":
                    same.setdefault(e.exprId().id(), []).append(e.child().exprId().id())
        elif kind == "Union":
            for branch in _items(plan.children()):
                for out, a in zip(ids(plan.output()), ids(branch.output()), strict=True):
                    same.setdefault(out, []).append(a)
        elif kind == "CTERelationDef":
            defined[plan.id()] = ids(plan.child().output())
        elif kind == "CTERelationRef":
            used.append((plan.cteId(), ids(plan.output())))
        for child in _items(plan.children()):
            walk(child)

    plan = frame.queryExecution().analyzed()
    walk(plan)
    for cte, out in used:
        for a, b in zip(out, defined.get(cte, []), strict=False):
            if a != b:
                same.setdefault(a, []).append(b)

    def from_side(start: int) -> bool:
        open_, seen = [start], set()
        while open_:
            a = open_.pop()
            if a in nullable:
                return True
            if a not in seen:
                seen.add(a)
                open_ += same.get(a, [])
        return False

    return {a.name() for a in _items(plan.output()) if from_side(a.exprId().id())}
