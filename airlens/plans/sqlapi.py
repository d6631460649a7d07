"""Published views, read-only SQL over them, named selections and CSV export."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from py4j.java_gateway import is_instance_of
from pyspark import SparkContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from airlens.session import fresh_path
from airlens.sources.ingest import export_csv

# fixed values: tables a user may query by name
PUBLISHED_VIEWS = ("stg_atmo_daily", "stg_meteo_daily", "mart_atmo_commune", "mart_atmo_daily_national",
                   "mart_atmo_daily_departement", "mart_atmo_meteo_daily_departement")


def publish(tables: Mapping[str, DataFrame]) -> list[str]:
    """Register each table as a temporary view of the session under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


class NotAllowed(ValueError):
    """The query reads something else than the published tables, or calls Java."""


#: Expressions that run code of the caller's choice.
FOREIGN = ("CallMethodViaReflection", "ScalaUDF", "PythonUDF", "PythonUDAF", "ScalaAggregator", "ApplyFunctionExpression")
#: Leaves that hold no stored rows: a row without columns, VALUES, a reference to the query's own WITH.
HARMLESS = ("OneRowRelation", "LocalRelation", "CTERelationRef", "UnionLoopRef")


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _seq(values) -> list:
    return [values.apply(k) for k in range(values.length())]


def _nodes(plan, inside: Callable[[object], bool] = lambda node: True) -> Iterator[tuple[object, bool]]:
    """Every plan node (node, True) and expression (node, False) of a plan, its subqueries and WITH parts.

    ``inside``: whether to look below a plan node.
    """
    yield plan, True
    if not inside(plan):
        return
    waiting = _seq(plan.expressions())
    while waiting:
        e = waiting.pop()
        yield e, False
        waiting += _seq(e.children())
        if is_instance_of(SparkContext._gateway, e, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            yield from _nodes(e.plan(), inside)
    below = _seq(plan.children())
    if _kind(plan) == "UnresolvedWith":
        below += [part._2() for part in _seq(plan.cteRelations())]
    for child in below:
        yield from _nodes(child, inside)


def _check_parsed(spark: SparkSession, text: str) -> None:
    """Nothing that analysis itself would have to evaluate or read: names built at run time, table functions, paths."""
    for node, is_plan in _nodes(spark._jsparkSession.sessionState().sqlParser().parsePlan(text)):
        kind = _kind(node)
        if "UnresolvedIdentifier" in kind:
            raise NotAllowed("IDENTIFIER is not allowed")
        if "TableValuedFunction" in kind:
            raise NotAllowed("table functions are not allowed")
        if kind == "UnresolvedRelation" and node.multipartIdentifier().length() > 1:
            raise NotAllowed(f"not a published table: {node.name()}")
        if kind == "UnresolvedFunction" and _seq(node.nameParts())[-1].lower() in ("reflect", "try_reflect", "java_method"):
            raise NotAllowed("Java calls are not allowed")


def check_query(df: DataFrame, allowed: Sequence[str] = PUBLISHED_VIEWS) -> None:
    """Refuse an analysed query whose rows come from anything but ``allowed`` views, or that calls foreign code.

    The resolved plan is looked at, so it does not matter how a name was written or where a WITH hides it.
    """
    names = {a.lower() for a in allowed}

    def published(node) -> bool:
        if _kind(node) != "View":
            return False
        name = node.desc().identifier()
        return bool(node.isTempView()) and name.database().isEmpty() and name.table().lower() in names

    # a published view is taken as it is, whatever it reads
    for node, is_plan in _nodes(df._jdf.queryExecution().analyzed(), lambda n: not published(n)):
        kind = _kind(node).removesuffix("$")
        if not is_plan:
            if kind in FOREIGN:
                raise NotAllowed("Java calls and functions of the session are not allowed")
        elif kind == "View" and not published(node):
            raise NotAllowed(f"not a published table: {node.desc().identifier().table()}")
        elif kind != "View" and not node.children().length() and kind not in HARMLESS:
            raise NotAllowed(f"not a published table: {node.simpleString(5)}")


def read_only_sql(spark: SparkSession, text: str) -> DataFrame:
    """A user's query as a subquery, so only a query can run, over the published tables alone.

    A trailing ';' is dropped; the text is wrapped as ``SELECT * FROM (<text>)``
    on its own lines (a final comment cannot swallow the parenthesis). DDL,
    DML, SET, CACHE, SHOW or several statements do not parse there and fail.
    """
    q = text.strip()
    while q.endswith(";"):
        q = q[:-1].rstrip()
    wrapped = f"SELECT * FROM (\n{q}\n)"
    _check_parsed(spark, wrapped)
    df = spark.sql(wrapped)
    check_query(df)
    return df


def stored_result(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows of ``df`` in order, written once to the shared folder, and their number, counted on the way.

    Columns are stored by position (a result may repeat a name); a column of nulls only as text.
    """
    counted = Observation("console")
    columns = [F.col(f"c{k}").cast("string") if isinstance(f.dataType, NullType) else F.col(f"c{k}")
               for k, f in enumerate(df.schema.fields)]
    out = (df.toDF(*[f"c{k}" for k in range(len(df.columns))]).select(*columns, F.monotonically_increasing_id().alias("row"))
           .observe(counted, F.count(F.lit(1)).alias("n")))
    path = fresh_path(df.sparkSession, "console")
    out.write.parquet(path)
    stored = df.sparkSession.read.schema(out.schema).parquet(path).orderBy("row").drop("row")
    return stored.toDF(*df.columns), counted.get["n"]


def run_console(spark: SparkSession, text: str) -> dict:
    """A console query, run once: its stored result (all rows, for display by page or export), the exact counts, or the
    error text."""
    try:
        df, n = stored_result(read_only_sql(spark, text))
        return {"ok": True, "columns": df.columns, "data": df, "n_rows": n, "n_columns": len(df.columns), "error": None}
    except Exception as e:  # noqa: BLE001 - the console shows any error as text
        return {"ok": False, "columns": [], "data": None, "n_rows": 0, "n_columns": 0,
                "error": f"{type(e).__name__}: {e}"}


def page(result: DataFrame, number: int, rows: int = 1000) -> DataFrame:
    """A page (from 0) of a stored result, in its order."""
    return result.offset(number * rows).limit(rows)


def export_result(df: DataFrame, path: str) -> None:
    """Write a query result as CSV with a header."""
    export_csv(df, path)
