"""Guarded SQL: one query over whitelisted views, with a row cap.

Spark itself parses and resolves the text.  It is placed in a subquery, where only a query is grammatical: a command,
a second statement or SELECT INTO does not parse.  It is resolved, not yet planned, in a session of its own that holds
nothing but the views, and the resolved tree is walked: every leaf must lie below one of these views (or be the single
empty row, or a reference to a common table of the query, whose definition is walked too), and every expression must be
a built-in one that stays inside the query.  The cap is a limit on the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel import schemas as S
from cartwheel.session import tune

#: expressions that reach outside the query, by their class
OUTSIDE = {"CallMethodViaReflection": "reflect", "TryReflect": "try_reflect", "InputFileName": "input_file_name",
           "PythonUDF": "user function", "ScalaUDF": "user function"}
BUILT_IN = "org.apache.spark.sql.catalyst.expressions."
SUBQUERIES = ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery")
#: leaves that hold no data of anybody's
HARMLESS = ("OneRowRelation", "OneRowRelation$", "CTERelationRef")


class Refused(ValueError):
    """The statement was not run; ``reasons`` says why."""

    def __init__(self, reasons: list[str]):
        super().__init__("; ".join(reasons))
        self.reasons = reasons


@dataclass(frozen=True)
class Guarded:
    """A capped result.  ``rows`` holds ``cap`` rows at most; ``truncated`` tells whether there were more."""
    rows: DataFrame
    truncated: DataFrame
    relations: tuple[str, ...]


class _Walk:
    """What a resolved tree reads and what speaks against it."""

    def __init__(self, names: set[str]):
        self.names, self.read, self.reasons = names, set(), set()

    def plan(self, node) -> None:
        kind = _kind(node)
        if kind == "View" and node.isTempView() and not node.desc().identifier().database().isDefined():
            name = node.desc().identifier().table().lower()
            if name in self.names:
                self.read.add(name)
                return
        below = _items(node.children())
        if not below and kind not in HARMLESS:
            self.reasons.add("Table-valued function calls are not allowed." if kind in ("Range", "LocalRelation")
                             else f"Table not allowed or unknown: {node.simpleString(3).split(' ')[-1].lower()}")
        for expression in _items(node.expressions()):
            self.expression(expression)
        for child in below:
            self.plan(child)

    def expression(self, node) -> None:
        kind, whole = _kind(node), node.getClass().getName()
        if kind in OUTSIDE or not whole.startswith(BUILT_IN):
            self.reasons.add(f"Function not allowed: {OUTSIDE.get(kind, kind)}")
        if kind in SUBQUERIES:
            self.plan(node.plan())
        for child in _items(node.children()):
            self.expression(child)


def _asked(plan) -> set[str]:
    """What speaks against a plan as parsed: names of several parts (views have one) and computed names."""
    kind, found = _kind(plan), set()
    if kind == "UnresolvedRelation" and plan.multipartIdentifier().size() > 1:
        found.add("Table not allowed or unknown: " + ".".join(_items(plan.multipartIdentifier())).lower())
    if "WithUnresolvedIdentifier" in kind:
        found.add("Computed table names are not allowed.")
    for child in _items(plan.children()) + (_items(plan.innerChildren()) if kind == "UnresolvedWith" else []):
        found |= _asked(child)
    for expression in _items(plan.expressions()):
        found |= _asked_within(expression)
    return found


def _asked_within(expression) -> set[str]:
    kind = _kind(expression)
    found = {"Computed table names are not allowed."} if "WithUnresolvedIdentifier" in kind else set()
    if kind in SUBQUERIES:
        found |= _asked(expression.plan())
    for child in _items(expression.children()):
        found |= _asked_within(child)
    return found


def _kind(node) -> str:
    return node.getClass().getName().rsplit(".", 1)[-1]


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _refusal(error: PySparkException) -> Refused:
    """A missing relation by its name, any other error by its whole message."""
    if isinstance(error, AnalysisException) and error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
        name = error.getMessageParameters()["relationName"].replace("`", "").lower()
        return Refused([f"Table not allowed or unknown: {name}"])
    if isinstance(error, AnalysisException) and error.getCondition() == "UNRESOLVABLE_TABLE_VALUED_FUNCTION":
        return Refused(["Table-valued function calls are not allowed."])
    return Refused([str(error).strip()])


def _own_session(spark: SparkSession, views: Mapping[str, DataFrame]) -> SparkSession:
    """A session that knows the views by name and no other temporary view."""
    own = tune(spark.newSession())
    dataset = spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset
    for name, frame in views.items():
        plan = frame._jdf.queryExecution().analyzed()
        dataset.ofRows(own._jsparkSession, plan).createOrReplaceTempView(name)
    return own


def _without_schema(text: str, schema: str, names: Iterable[str]) -> str:
    """The text without the schema before the given names; literals, quoted names and comments stay as they are."""
    kept = r"""\br'[^']*'|\br"[^"]*"|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
    name = rf"\b{re.escape(schema)}\.(?=(?:{'|'.join(map(re.escape, names))})\b)"
    return re.sub(rf"({kept})|{name}", lambda m: m[1] or "", text, flags=re.IGNORECASE | re.DOTALL)


def guarded_sql(views: Mapping[str, DataFrame], sql: str, cap: int = S.ROW_CAP, schema: str = "gold") -> Guarded:
    """Run one SELECT (Spark SQL) over ``views`` or raise :class:`Refused`.

    The text may write the views' names with the ``schema`` in front.  The caller's session stays as it is.
    """
    body = sql.strip().rstrip(";").strip()
    if not body:
        raise Refused(["Empty SQL."])
    body = _without_schema(body, schema, views)
    own = _own_session(next(iter(views.values())).sparkSession, views)
    query = f"SELECT * FROM (\n{body}\n)"
    try:
        asked = _asked(own._jsparkSession.sessionState().sqlParser().parsePlan(query))
        result = None if asked else own.sql(query)
    except PySparkException as error:
        raise _refusal(error) from None
    if asked:
        raise Refused(sorted(asked))
    walk = _Walk({name.lower() for name in views})
    walk.plan(result._jdf.queryExecution().analyzed())
    if walk.reasons:
        raise Refused(sorted(walk.reasons))
    over = result.limit(cap + 1).agg((F.count(F.lit(1)) > cap).alias("Truncated"))
    return Guarded(result.limit(cap), over, tuple(sorted(walk.read)))
